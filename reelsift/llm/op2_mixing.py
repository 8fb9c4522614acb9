"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Each source gets a target number of words, and shares it out among its documents by length: a long document is expected to
be taken less often than a short one. The whole part of a document's expected copies is certain, the rest is its
inclusion probability. Documents are ranked by random odds over inclusion odds, and the first ones in rank whose words
fit are taken. Cuts in rank are found from a histogram by source and rank, so a source that holds most rows is never
sorted in one task; each row then decides by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsift.shared import written

#: Cells of rank by source; only the cell that holds the cut is sorted.
CELLS = 1 << 16
#: Cells are summed in blocks of two to this power.
BLOCK_BITS = 8
#: A document of 2**k words has the weight LENGTHS - k, at least 1: whole numbers, so that sums don't depend on their order.
LENGTHS = 24
WORD = r"[^\x20\x09-\x0D]+"


def _shared(rows: DataFrame, by: list[str], total: str) -> DataFrame:
    """``rows`` and target: the share by weight of ``total`` (a column, equal within ``by``), none above limit, the rest reshared.

    Rows at their limit come first by limit over weight, so the level at which the others share is found in one pass in
    that order.
    """
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    order = part.orderBy(F.col("limit") / F.col("weight"), F.col("name").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    s = rows.withColumn("level", (F.col(total) - before) / rest).withColumn("place", F.row_number().over(order))
    fits = F.col("level") <= F.col("limit") / F.col("weight")
    s = s.withColumn("level", F.min(F.when(fits, F.struct("place", "level"))).over(part)["level"])
    return s.withColumn("target", F.coalesce(F.least("limit", F.col("level") * F.col("weight")), F.col("limit"))).drop("level", "place")


def _targets(sizes: DataFrame, weights: tuple[float, ...], total: float, most: float) -> DataFrame:
    """(s, length, source_size, target, copies): target words by source, and expected copies of its documents by length.

    ``sizes`` has s, length, words. There is one row for each source and length (below 64), so these tables are small.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("s").asc_nulls_last())
    each = sizes.groupBy("s").agg(F.sum("words").alias("source_size"))
    each = each.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights))).withColumn("limit", F.col("source_size") * float(most))
    share = F.sum("source_size").over(Window.partitionBy(F.lit(0))) * float(total)
    each = _shared(each.where("source_size > 0").withColumn("share", share).withColumn("name", F.col("s")), [], "share").select(F.col("s").alias("source"), "source_size", "target")
    lengths = sizes.join(each, F.col("s").eqNullSafe(F.col("source")), "left").select("s", "length", "words", F.coalesce("source_size", F.lit(0)).alias("source_size"), F.coalesce("target", F.lit(0.0)).alias("whole"))
    known = lengths.where("words > 0").withColumn("weight", F.greatest(F.lit(LENGTHS) - F.col("length"), F.lit(1)) * F.col("words").cast("double"))
    known = _shared(known.withColumn("limit", F.col("words") * float(most)).withColumn("name", F.col("length")), ["s"], "whole")
    known = known.select("s", "length", "source_size", F.col("whole").alias("target"), (F.col("target") / F.col("words")).alias("copies"))
    none = lengths.where("words = 0").select("s", "length", "source_size", F.col("whole").alias("target"), F.lit(0.0).alias("copies"))
    return known.unionByName(none)


def _ranked(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``rows`` (s, size, length, h) with their source's and length's numbers, certain copies (sure), rank and its cell."""
    of = targets.select(F.col("s").alias("ts"), F.col("length").alias("tl"), "source_size", "target", "copies")
    rows = rows.join(of, F.col("s").eqNullSafe(F.col("ts")) & (F.col("length") == F.col("tl"))).drop("ts", "tl")
    p = F.col("copies") - F.floor("copies")
    u = (F.conv(F.substring("h", 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    rank = F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))
    rows = rows.withColumn("sure", F.floor("copies").cast("int")).withColumn("rank", rank)
    return rows.withColumn("cell", F.floor(F.col("rank") / (1 + F.col("rank")) * CELLS).cast("int"))


def _inside() -> Column:
    """Whether a row comes before its source's cut in rank and fits."""
    at_cut = (F.col("cell") == F.col("cut")) & ((F.col("rank") < F.col("cut_rank")) | ((F.col("rank") == F.col("cut_rank")) & (F.col("h") <= F.col("cut_h"))))
    return F.coalesce(F.col("rank").isNotNull() & (F.col("size") <= F.col("fit")) & ((F.col("cell") < F.col("cut")) | at_cut), F.lit(False))


def _last(rows: DataFrame, at: str) -> DataFrame:
    """(s, ``at``, before, need): of ``rows`` (s, ``at``, need, start, words) the last of each source up to which, from start on, no more words come than needed."""
    before = F.col("start") + F.sum("words").over(Window.partitionBy("s").orderBy(at)) - F.col("words")
    last = F.max(F.when(F.col("before") <= F.col("need"), F.struct(at, "before", "need")))
    return rows.withColumn("before", before).groupBy("s").agg(last.alias("c")).select("s", "c.*")


def _cuts(ranked: DataFrame) -> DataFrame:
    """Where each source stops in rank, and how many words are still missing there."""
    sure = ranked.groupBy(F.col("s").alias("ns")).agg(F.first("target").alias("t"), F.sum(F.col("sure") * F.col("size")).alias("n"))
    sure = written(sure.select("ns", (F.col("t") - F.col("n")).alias("need")), "needs")
    # a document larger than what is needed can't be taken, and must not stop the others
    rows = ranked.where("rank is not null").join(sure, F.col("s").eqNullSafe(F.col("ns"))).where("size <= need")
    # blocks of cells first, then the cells of the block that holds the cut, so that no task sorts all cells of a source
    cells = written(rows.groupBy("s", "cell", "need").agg(F.sum("size").alias("words")).withColumn("block", F.shiftright("cell", BLOCK_BITS)), "cells")
    blocks = _last(cells.groupBy("s", "block", "need").agg(F.sum("words").alias("words")).withColumn("start", F.lit(0)), "block")
    inner = cells.join(blocks.select(F.col("s").alias("bs"), F.col("block").alias("held"), F.col("before").alias("start")), F.col("s").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("held")))
    cut = _last(inner, "cell").select(F.col("s").alias("t"), F.col("cell").alias("cut"), "before", F.col("need").alias("want"))
    cut = written(cut, "cut")
    near = rows.join(cut, F.col("s").eqNullSafe(F.col("t")) & (F.col("cell") == F.col("cut")))
    near = near.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("s").orderBy("rank", "h", "size")))
    stop = near.where("upto <= want").groupBy(F.col("s").alias("u")).agg(F.max(F.struct("rank", "h", "upto")).alias("stop"))
    out = sure.join(cut, F.col("ns").eqNullSafe(F.col("t")), "left").join(stop, F.col("ns").eqNullSafe(F.col("u")), "left")
    return out.select(
        F.col("ns").alias("t"), F.coalesce("cut", F.lit(-1)).alias("cut"), F.coalesce("stop.rank", F.lit(-1.0)).alias("cut_rank"), F.coalesce("stop.h", F.lit("")).alias("cut_h"),
        F.col("need").alias("fit"), (F.col("need") - F.coalesce("stop.upto", "before", F.lit(0))).alias("missing"), F.array().cast("array<string>").alias("more"),
    )


def _filled(ranked: DataFrame, cuts: DataFrame) -> DataFrame:
    """The document beyond the cut that brings its source nearest to its target, where one does, joins those taken."""
    rows = ranked.join(cuts, F.col("s").eqNullSafe(F.col("t")))
    free = F.col("rank").isNotNull() & ~_inside() & ~F.array_contains("more", F.col("h"))
    rows = rows.where(free & (F.col("size") > 0) & (F.col("size") < 2 * F.col("missing")))
    best = rows.groupBy(F.col("s").alias("u")).agg(F.min(F.struct(F.abs(F.col("size") - F.col("missing")).alias("off"), "rank", "h", "size")).alias("b"))
    out = cuts.join(best, F.col("t").eqNullSafe(F.col("u")), "left")
    more = F.when(F.col("b").isNotNull(), F.concat("more", F.array("b.h"))).otherwise(F.col("more"))
    return out.select("t", "cut", "cut_rank", "cut_h", "fit", (F.col("missing") - F.coalesce("b.size", F.lit(0))).alias("missing"), more.alias("more"))


def _copied(docs: DataFrame, key: str, text: str, source: str, weights: tuple[float, ...], total: float, most: float, seed: int, fills: int) -> DataFrame:
    """row (struct of all columns), size, source_size, target, expected (copies), taken copies (n) for each row of ``docs``."""
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    h = F.md5(F.concat(F.lit(f"{seed} "), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(" "), F.coalesce(F.col(text), F.lit(""))))
    length = F.when(F.col("size") > 0, F.length(F.bin("size")) - 1).otherwise(-1)
    rows = written(docs.select(F.col(source).alias("s"), size.alias("size"), h.alias("h")).withColumn("length", length), "sizes")
    targets = written(_targets(rows.groupBy("s", "length").agg(F.sum("size").alias("words")), weights, total, most), "targets")
    ranked = _ranked(rows, targets)
    cuts = written(_cuts(ranked), "cuts")
    for _ in range(fills):
        cuts = written(_filled(ranked, cuts), "cuts")
    whole = docs.select(F.struct("*").alias("row"), F.col(source).alias("s"), size.alias("size"), h.alias("h")).withColumn("length", length)
    whole = _ranked(whole, targets).join(cuts, F.col("s").eqNullSafe(F.col("t")), "left")
    one = _inside() | F.coalesce(F.array_contains("more", F.col("h")) & F.col("rank").isNotNull(), F.lit(False))
    return whole.select("row", "size", "source_size", "target", F.col("copies").alias("expected"), (F.col("sure") + one.cast("int")).alias("n"))


def mix_sources(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = (5, 2, 1), total: float = 1.5, most: float = 2.0, seed: int = 1, fills: int = 2,
) -> DataFrame:
    """All rows and columns of ``docs`` and size, source_size, taken (long), target, expected (double), copies (int).

    ``size`` counts the words of the text (null: 0). Sources in code point order, null last, get the weights in turn and
    share ``total`` times all words, none above ``most`` times its own. ``expected`` copies of a document fall with its
    length, none above ``most``, so that those of a source add up to its target. A document is taken ``copies`` times, so
    ``taken`` = ``copies`` x ``size``, at most ``most`` times its size rounded up. Documents that fit are taken in rank
    until one would pass the target, and up to ``fills`` documents that bring it nearest are added. Random numbers come
    from key, text and ``seed``, so reruns agree and repeated rows are taken alike. Texts without words are never taken. Columns of
    ``docs`` with the names above are replaced here; ``mixed`` keeps them. An empty table gives an empty table.
    """
    rows = _copied(docs, key, text, source, weights, total, most, seed, fills)
    made = ("size", "source_size", "target", "expected", "copies", "taken")
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in made]
    return rows.select(*own, "size", "source_size", "target", "expected", F.col("n").alias("copies"), (F.col("n") * F.col("size")).cast("long").alias("taken"))


def mixed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = (5, 2, 1), total: float = 1.5, most: float = 2.0, seed: int = 1, fills: int = 2,
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as many times as it is taken, with just the columns of ``docs``, whatever their names."""
    rows = _copied(docs, key, text, source, weights, total, most, seed, fills).where("n > 0")
    return rows.select(F.explode(F.array_repeat("row", F.col("n"))).alias("row")).select("row.*")
