"""MinHash near-dedup by BagMinHash: weighted-Jaccard signatures of word shingles, banded and verified on the multisets.

A shingle with count w has a Poisson process of unit rate on every level up to w. Levels lie in dyadic blocks [0,1),
[1,2), [2,4), ...: one process for a whole block with the block's rate, whose points also carry a level within the block
and count only below w, so texts with different counts see the same points. Points come in order of time, each with a
signature position; a position's value is its first point. A text stops when no later point can change a position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.components import components, hooked
from reelsift.llm.words import PLAIN, in_batches, inside, mix, text_slices, tokens, window_hashes
from reelsift.shared import release, written

WORDS = 5
SIMILARITY = 0.8
#: Bands of rows: a pair at similarity 0.8 shares a band with probability 0.9998.
BANDS, ROWS = 16, 4
#: Texts in a bucket that is compared throughout, and most ids of texts that go that are broadcast (16 MB).
FEW, MOST_SENT = 12, 1 << 20
#: Elements are counted in so many slots, to try rare ones first.
SLOT_BITS = 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes | None], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles of each text with repeats, the text of each, and the number of words by text.

    A text of fewer than ``words`` words, but not none, has one shingle of them all.
    """
    found = tokens(texts, PLAIN)
    begin = np.cumsum(found.counts) - found.counts
    own = window_hashes(found.ids, words)
    at = np.flatnonzero(inside(found.counts, words))
    values, text = own[at], np.searchsorted(begin + found.counts, at, side="right")
    short = np.flatnonzero((found.counts > 0) & (found.counts < words))
    if len(short):
        lone = [int(mix(np.array([np.bitwise_xor.reduce(mix(found.ids[begin[i] : begin[i] + found.counts[i]] + np.arange(1, found.counts[i] + 1, dtype=np.uint64) * _GOLDEN))]))[0]) for i in short]
        values, text = np.concatenate([values, np.array(lone, np.uint64)]), np.concatenate([text, short])
    return values, text, found.counts


def _counted(values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort([values, text])
    values, text = values[order], text[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(text) != 0) | (values[1:] != values[:-1])]) if len(values) else np.zeros(0, bool))
    return values[new], text[new], np.diff(np.append(new, len(values)))


def _uniform(seed: np.ndarray, step: int, lane: int) -> np.ndarray:
    return ((mix(seed + np.uint64((step * 4 + lane) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(values: np.ndarray, text: np.ndarray, counts: np.ndarray, n_texts: int, size: int) -> np.ndarray:
    """BagMinHash: for each text and position, the point that comes first (0 where a text has no shingles)."""
    first = np.full((n_texts, size), np.inf)
    point = np.zeros((n_texts, size), np.uint64)
    # one process for each shingle and block of levels it reaches
    level = np.where(counts > 1, np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 1)
    item = np.repeat(np.arange(len(values)), level)
    block = np.arange(len(item)) - np.repeat(np.cumsum(level) - level, level)
    low = np.where(block == 0, 0, 1 << np.maximum(block - 1, 0))
    rate = np.maximum(low, 1).astype(np.float64)
    seed = mix(values[item] + block.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    whose, weight, time = text[item], counts[item].astype(np.float64), np.zeros(len(item))
    step = 0
    while len(seed):
        time = time - np.log(_uniform(seed, step, 0)) / rate
        alive = time < first.max(axis=1)[whose]
        seed, rate, low, whose, weight, time = (x[alive] for x in (seed, rate, low, whose, weight, time))
        valid = np.flatnonzero(low + _uniform(seed, step, 2) * rate < weight)
        place = whose[valid] * size + (_uniform(seed[valid], step, 1) * size).astype(np.int64)
        name = mix(seed[valid] ^ np.uint64(step + 1))
        order = np.lexsort([name, time[valid], place])
        lead = order[np.concatenate([[True], np.diff(place[order]) != 0])] if len(order) else order
        better = lead[time[valid][lead] < first.ravel()[place[lead]]]
        first.ravel()[place[better]] = time[valid][better]
        point.ravel()[place[better]] = name[better]
        step += 1
    return point


def _sign_batches(batches: Iterator[pa.RecordBatch], words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """From text and its id: id, the number of shingles, a hash for each band."""
    for batch in batches:
        for a, b, (texts,) in text_slices(batch.column(0)):
            values, text, counts = _counted(*shingles(texts, words)[:2])
            point = signatures(values, text, counts, b - a, bands * rows).reshape(b - a, bands, rows)
            band = np.tile(np.arange(bands, dtype=np.uint64) * _GOLDEN, (b - a, 1))
            for i in range(rows):
                band = mix(band ^ point[:, :, i])
            total = np.bincount(text, counts, minlength=b - a).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a) * bands + 1, bands, dtype=np.int32)), pa.array(band.ravel().view(np.int64)))
            yield pa.record_batch([batch.column(1).slice(a, b - a), pa.array(total), lists], names=["id", "n", "bands"])


def _verify_batches(batches: Iterator[pa.RecordBatch], words: int, least: float) -> Iterator[pa.RecordBatch]:
    """From pairs and their texts: the pairs whose shingle multisets overlap enough."""
    for batch in batches:
        a, b = batch.column(0), batch.column(1)
        good: list[int] = []
        for s, e, (left, right) in text_slices(batch.column(2), batch.column(3)):
            texts = [*left, *right]
            index: dict[bytes, int] = {}
            place = [index.setdefault(x, len(index)) for x in texts]
            values, text, counts = _counted(*shingles([*index], words)[:2])
            bounds = np.searchsorted(text, np.arange(len(index) + 1))
            for i in range(e - s):
                x, y = place[i], place[e - s + i]
                v, w = values[bounds[x] : bounds[x + 1]], values[bounds[y] : bounds[y + 1]]
                c, d = counts[bounds[x] : bounds[x + 1]], counts[bounds[y] : bounds[y + 1]]
                where = np.searchsorted(w, v)
                where[where == len(w)] = 0
                both = np.flatnonzero(w[where] == v) if len(w) else np.empty(0, np.int64)
                shared = int(np.minimum(c[both], d[where[both]]).sum())
                if shared and shared >= least * (int(c.sum()) + int(d.sum()) - shared):
                    good.append(s + i)
        keep = pa.array(good, pa.int64())
        yield pa.record_batch([a.take(keep), b.take(keep)], names=["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """``pairs`` (a, b) of text ids with a similarity of ``least`` or more."""
    left = texts.select(F.col("id").alias("ia"), F.col("text").alias("xa"))
    right = texts.select(F.col("id").alias("ib"), F.col("text").alias("xb"))
    # texts are never broadcast, so that small and large inputs have one plan; pairs of one text are split by AQE
    rows = pairs.join(right.hint("merge"), F.col("b") == F.col("ib")).join(left.hint("merge"), F.col("a") == F.col("ia"))
    return in_batches(rows.select("a", "b", "xa", "xb"), lambda it: _verify_batches(it, words, least), "a long, b long")


def _elements(texts: list[bytes | None], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of each text as a set, a repeat being an element of its own: elements, text of each, elements by text."""
    values, text, counts = _counted(*shingles(texts, words)[:2])
    again = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    whose = np.repeat(text, counts)
    return mix(np.repeat(values, counts) + again.astype(np.uint64) * _GOLDEN), whose, np.bincount(whose, minlength=len(texts))


def _slot(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """From texts: how many elements fall into each slot."""
    total = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in batches:
        for _, _, (texts,) in text_slices(batch.column(0)):
            total += np.bincount(_slot(_elements(texts, words)[0]), minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["slot", "c"])


def _prefix_batches(batches: Iterator[pa.RecordBatch], words: int, least: float, often: np.ndarray) -> Iterator[pa.RecordBatch]:
    """From text, id and root: a text's rarest elements with id, root, n, place, and whether they are among the rarest for longer texts too."""
    for batch in batches:
        for a, b, (texts,) in text_slices(batch.column(0)):
            element, whose, n = _elements(texts, words)
            order = np.lexsort([element, often[_slot(element)], whose])
            element, whose = element[order], whose[order]
            place = np.arange(len(element)) - (np.cumsum(n) - n)[whose]
            # of a pair the longer text shares `least` of its own elements at least, the shorter one 2 * least / (1 + least)
            longer = n - np.ceil(n * least - 1e-6) + 1
            shorter = n - np.ceil(n * (2 * least / (1 + least)) - 1e-6) + 1
            at = np.flatnonzero(place < longer[whose])
            row = pa.array(whose[at] + a)
            yield pa.record_batch(
                [pa.array(element[at].view(np.int64)), batch.column(1).take(row), batch.column(2).take(row), pa.array(n[whose[at]].astype(np.int64)), pa.array(place[at].astype(np.int64)), pa.array(place[at] < shorter[whose[at]])],
                names=["e", "id", "root", "n", "place", "both"],
            )


def _shared_prefixes(rest: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """Pairs (a, b) of texts of different roots, among them every pair with a similarity of ``least`` or more.

    In any one order of all elements, two such texts share an element among the first few of each (prefix filter). Rare
    ones come first, so that what many texts have in common makes few pairs; the counts they are ordered by are those of
    slots, a table of fixed size, as the order matters for speed alone. Of the texts that share an element, those outside
    the root that has most of them are joined with all, so a large class costs what is not in it times its size.
    """
    spark = rest.sparkSession
    held = written(texts.join(rest.select(F.col("id").alias("w"), "root").hint("merge"), F.col("id") == F.col("w")).select("text", "id", "root"), "held")
    slots = in_batches(held.select("text"), lambda it: _count_batches(it, words), "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).toArrow()
    often = np.zeros(1 << SLOT_BITS, np.int64)
    often[slots["slot"].to_numpy()] = slots["c"].to_numpy()
    sent = spark.sparkContext.broadcast(often)
    first = written(in_batches(held, lambda it: _prefix_batches(it, words, least, sent.value), "e long, id long, root long, n long, place long, both boolean"), "prefixes")
    sent.destroy()
    release(held)
    by_root = first.groupBy("e", "root").agg(F.count(F.lit(1)).alias("k"))
    most = by_root.groupBy(F.col("e").alias("o")).agg(F.max(F.struct("k", "root")).alias("m"), F.count(F.lit(1)).alias("roots")).where("roots > 1").select("o", F.col("m.root").alias("major"))
    most = written(most, "most")
    first = written(first.join(most.hint("merge"), F.col("e") == F.col("o")).select("e", "id", "root", "n", "place", "both", "major"), "shared")
    minor = first.where("root <> major").select(F.col("e").alias("e2"), F.col("id").alias("id2"), F.col("root").alias("root2"), F.col("n").alias("n2"), F.col("place").alias("place2"), F.col("both").alias("both2"))
    longer = (F.col("n") > F.col("n2")) | (F.col("n") == F.col("n2")) & (F.col("id") > F.col("id2"))
    fits = F.when(longer, F.col("both2") & (F.col("n2") >= F.col("n") * least - 1e-9)).otherwise(F.col("both") & (F.col("n") >= F.col("n2") * least - 1e-9))
    # the first element that two texts share leaves room for all that they must share (positional filter)
    room = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2")) >= F.ceil((F.col("n") + F.col("n2")) * (least / (1 + least)) - 1e-6)
    met = first.join(minor.hint("merge"), (F.col("e") == F.col("e2")) & (F.col("root") != F.col("root2")) & fits & room)
    return met.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()


def _texts(docs: DataFrame, key: str, text: str, carried: F.Column) -> DataFrame:
    """Distinct texts with an id: t, text, first (struct<nameless, key>, the least key), copies, carried (of a row with that key).

    Copies are counted before anything is shuffled, so a text that most rows hold is one row of each task. A null text
    is one of its own for each key. Ids are given as the table is written, so all later plans read the same ones.
    """
    first = F.struct(F.col(key).isNull().alias("nameless"), F.col(key).alias("key"))
    t = F.coalesce(F.md5(text), F.concat(F.lit("null "), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = docs.select(t.alias("t"), F.col(text).alias("text"), first.alias("first"), carried.alias("carried"))
    out = rows.groupBy("t").agg(F.first("text").alias("text"), F.min("first").alias("first"), F.count(F.lit(1)).alias("copies"), F.min_by("carried", "first").alias("carried"))
    return written(out.withColumn("id", F.monotonically_increasing_id()), "texts")


def near_classes(texts: DataFrame, words: int = WORDS, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(node, root)``: the id of each distinct text with a near copy, and of its class's least text. ``texts`` has id and text.

    A band's bucket has a leader, the text that meets most others over all its buckets, and all its texts of similar
    length are compared with it. Then buckets of at most ``FEW`` texts are compared throughout, and larger ones with a
    second leader of another class. Texts of larger buckets that are still not one class are compared wherever they share
    a rare shingle, which all similar ones do, so no link within a bucket is lost, however many texts it has.
    """
    signed = in_batches(texts.where(F.col("text").isNotNull()).select("text", "id"), lambda it: _sign_batches(it, words, bands, rows), "id long, n long, bands array<long>")
    signed = written(signed.where("n > 0"), "signed")
    each = signed.select("id", "n", F.explode("bands").alias("band"))
    # what is joined with its own groups is written first, so that joins have plain exchanges and large buckets can be split
    full = written(each.groupBy("band").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("band").alias("o"), "k"), "full")
    member = written(each.join(full.hint("merge"), F.col("band") == F.col("o")).select("band", "k", "id", "n"), "buckets")
    release(signed)
    met = written(member.groupBy(F.col("id").alias("w")).agg(F.sum("k").alias("met")), "met")
    buckets, member = member, written(member.join(met.hint("merge"), F.col("id") == F.col("w")).select("band", "k", "id", "n", "met"), "members")
    release(buckets)
    some = written(texts.join(met.select("w").hint("merge"), F.col("id") == F.col("w"), "left_semi").select("id", "text"), "some")
    similar = lambda x, y: F.least(x, y) >= F.greatest(x, y) * least - 1e-9
    ends = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    top = F.max(F.struct("met", "id", "n"))
    lead = written(member.groupBy(F.col("band").alias("lb")).agg(top.alias("l")).select("lb", F.col("l.id").alias("li"), F.col("l.n").alias("ln")), "leaders")
    met_lead = member.join(lead.hint("merge"), F.col("band") == F.col("lb")).where((F.col("id") != F.col("li")) & similar(F.col("n"), F.col("ln")))
    pairs = written(met_lead.select(*ends("id", "li")).distinct(), "pairs")
    links = written(_verified(pairs, some, words, least), "links")

    def apart(known: DataFrame) -> DataFrame:
        """Members, with their roots, of buckets of several roots."""
        rooted = member.join(known.hint("merge"), F.col("id") == F.col("node"), "left").select("band", "k", "id", "n", "met", F.coalesce("root", "id").alias("root"))
        rooted = written(rooted, "rooted")
        split = written(rooted.groupBy(F.col("band").alias("o")).agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("o"), "split")
        return written(rooted.join(split.hint("merge"), F.col("band") == F.col("o"), "left_semi"), "apart")

    def compared(found: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links among pairs not compared before, and all pairs compared so far."""
        gone = before.select(F.col("a").alias("ga"), F.col("b").alias("gb"))
        new = written(found.distinct().join(gone.hint("merge"), (F.col("a") == F.col("ga")) & (F.col("b") == F.col("gb")), "left_anti"), "pairs")
        return written(_verified(new, some, words, least), "links"), before.unionByName(new)

    known = written(hooked(links), "hooked")
    split = apart(known)
    few = split.where((F.col("k") <= FEW) & (F.col("k") > 2))
    other = few.select(F.col("band").alias("band2"), F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("root").alias("root2"))
    within = few.join(other.hint("merge"), (F.col("band") == F.col("band2")) & (F.col("id") < F.col("id2")) & (F.col("root") != F.col("root2")) & similar(F.col("n"), F.col("n2")))
    many = split.where(F.col("k") > FEW)
    ruled = lead.join(known.hint("merge"), F.col("li") == F.col("node"), "left").select("lb", F.coalesce("root", "li").alias("lr"))
    second = many.join(ruled.hint("merge"), (F.col("band") == F.col("lb")) & (F.col("root") != F.col("lr"))).groupBy(F.col("band").alias("sb")).agg(F.max(F.struct("met", "id", "n", "root")).alias("l"))
    second = written(second, "second")
    met_second = many.join(second.hint("merge"), F.col("band") == F.col("sb")).where((F.col("root") != F.col("l.root")) & similar(F.col("n"), F.col("l.n")))
    new, pairs = compared(within.select(F.col("id").alias("a"), F.col("id2").alias("b")).unionByName(met_second.select(*ends("id", "l.id"))), pairs)
    classes = components(links.unionByName(new))
    left = split.where(F.col("k") > FEW).select("band", "id").join(classes.hint("merge"), F.col("id") == F.col("node"), "left").select("band", "id", F.coalesce("root", "id").alias("root"))
    left = written(left, "left")
    still = written(left.groupBy(F.col("band").alias("o")).agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("o"), "still")
    rest = written(left.join(still.hint("merge"), F.col("band") == F.col("o"), "left_semi").select("id", "root").distinct(), "rest")
    release(split)
    if rest.isEmpty():
        return classes
    new, _ = compared(_shared_prefixes(rest, some, words, least), pairs)
    return components(classes.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(new))


def _grouped(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """For each distinct text: id, t, class_id (the least key of its class), copies (rows of its class), leads (its row stays where one of a class does)."""
    rows = texts.select("id", "t", "first", "copies").join(classes.hint("merge"), F.col("id") == F.col("node"), "left").select("id", "t", "first", "copies", F.coalesce("root", "id").alias("class"))
    rows = written(rows, "rooted")
    # written, so that the join below has plain exchanges on both sides and a large class can be split
    sizes = written(rows.groupBy(F.col("class").alias("c")).agg(F.min(F.struct("first", "id")).alias("least"), F.sum("copies").alias("all")), "sizes")
    out = rows.join(sizes.hint("merge"), F.col("class") == F.col("c"))
    return out.select("id", "t", F.col("least.first.key").alias("class_id"), F.col("all").alias("copies"), (F.col("id") == F.col("least.id")).alias("leads"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``key``, class_id (the least key of its class, of the key's type) and copies (long, rows of the class) for all rows.

    Words are lower-cased runs of ASCII letters and digits and of all other scripts; two texts are near copies if the
    multisets of their 5-word shingles have a Jaccard similarity of 0.8 or more, and a class is all that such links
    connect, equal texts included. Links of texts that share none of the 16 bands' buckets may be unseen. Texts without
    words are only copies of equal texts. A null text is like no other, and its class is its own key. Repeated rows are
    copies. A class that holds only null keys has a null class_id. An empty table gives an empty table. Columns may have
    any names; other columns are not kept.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    texts = _texts(docs, "key", "text", F.lit(None).cast("boolean"))
    found = written(_grouped(texts, near_classes(texts, **settings)).select(F.col("t").alias("ft"), "class_id", "copies"), "classes")
    release(texts)
    t = F.coalesce(F.md5("text"), F.concat(F.lit("null "), F.coalesce(F.col("key").cast("string"), F.lit(""))))
    rows = docs.select("key", t.alias("t")).join(found.hint("merge"), F.col("t") == F.col("ft"))
    return rows.select(F.col("key").alias(key), "class_id", "copies")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of ``docs`` for each class: that of the least key, null keys last; of rows with that key, any one of the class.

    All columns are kept, whatever their names. Null texts are classes by key, see ``near_duplicates``. An empty table
    gives an empty table. Rows are judged one by one: of a key that other rows repeat with texts of other classes, each
    class's row stays.
    """
    texts = _texts(docs, key, text, F.struct("*"))
    found = _grouped(texts, near_classes(texts, **settings))
    gone = written(found.where("not leads").select(F.col("id").alias("gone")), "gone")
    # what goes is sent to where the texts are, unless it is large; then both sides are shuffled
    few = gone.limit(MOST_SENT + 1).count() <= MOST_SENT
    return texts.join(F.broadcast(gone) if few else gone.hint("merge"), F.col("id") == F.col("gone"), "left_anti").select("carried.*")
