"""Benchmark decontamination: windows of benchmark words are looked up in every text, hits are verified word by word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelsift.llm.words import PLAIN, Tokens, as_bytes, in_batches, inside, slices, tokens, unused, window_hashes
from reelsift.shared import written

WIDTH = 8
#: Words of benchmark text in one broadcast (about 50 MB); a larger benchmark takes several passes over the texts.
BLOCK_WORDS = 200_000


def _words(found: Tokens, start: int, width: int) -> bytes:
    return b" ".join(found.joined[a:b] for a, b in zip(found.starts[start : start + width], found.ends[start : start + width], strict=True)).lower()


def _block(items: list[tuple[str, bytes]], width: int) -> dict:
    """Windows by width: sorted hashes, and for each hash the windows' words with the items that have them."""
    by_width: dict[int, dict[int, dict[bytes, set[str]]]] = {}
    for item, text in items:
        found = tokens([text], PLAIN)
        w = min(width, len(found.ids))
        if w:
            for i, fp in enumerate(window_hashes(found.ids, w).tolist()):
                by_width.setdefault(w, {}).setdefault(fp, {}).setdefault(_words(found, i, w), set()).add(item)
    return {w: (np.array(sorted(x), np.uint64), [x[fp] for fp in sorted(x)]) for w, x in by_width.items()}


def _blocks(benchmark: DataFrame, item: str, text: str, width: int, block_words: int) -> Iterator[dict]:
    """The benchmark, a bounded part at a time on the driver."""
    some: list[tuple[str, bytes]] = []
    n = 0
    for row in benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")), F.coalesce(F.col(text), F.lit(""))).toLocalIterator():
        data = row[1].encode()
        size = len(tokens([data], PLAIN).ids)
        if some and n + size > block_words:
            yield _block(some, width)
            some, n = [], 0
        some.append((row[0], data))
        n += size
    if some:
        yield _block(some, width)


def _hits(found: Tokens, block: dict) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Whether each word lies in an occurring window, and the items by text."""
    step = np.zeros(len(found.ids) + 1, np.int32)
    items: dict[int, set[str]] = {}
    upto = np.cumsum(found.counts)
    for width, (fps, entries) in block.items():
        own = window_hashes(found.ids, width)
        if not len(own):
            continue
        at = np.searchsorted(fps, own)
        at[at == len(fps)] = 0
        for i in np.flatnonzero((fps[at] == own) & inside(found.counts, width)):
            if whose := entries[at[i]].get(_words(found, i, width)):
                step[i] += 1
                step[i + width] -= 1
                items.setdefault(int(np.searchsorted(upto, i, side="right")), set()).update(whose)
    return np.cumsum(step[:-1]) > 0, items


def _scan(batches: Iterator[pa.RecordBatch], block, last: bool) -> Iterator[pa.RecordBatch]:
    """Columns: those passed through, then text, hits (word numbers), items. The last pass replaces these by results."""
    for batch in batches:
        n = batch.num_columns
        texts, hits, items = as_bytes(batch.column(n - 3)), batch.column(n - 2), batch.column(n - 1)
        for a, b in slices(texts):
            found = tokens(texts[a:b], PLAIN)
            hit, named = _hits(found, block.value)
            begin = np.cumsum(found.counts) - found.counts
            for i in range(a, b):
                if hits[i].is_valid:
                    hit[begin[i - a] + hits[i].values.to_numpy()] = True
                if items[i].is_valid:
                    named.setdefault(i - a, set()).update(items[i].as_py())
            text_of = np.repeat(np.arange(b - a), found.counts)
            part = batch.slice(a, b - a)
            names = [sorted(named.get(i, ())) for i in range(b - a)]
            if not last:
                where = np.flatnonzero(hit)
                offsets = np.searchsorted(text_of[where], np.arange(b - a + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array((where - begin[text_of[where]]).astype(np.int32)))
                made = dict(zip(batch.schema.names[n - 3 :], (part.column(n - 3), lists, pa.array(names, pa.list_(pa.string()))), strict=True))
            else:
                made = {
                    "n_words": pa.array(found.counts, pa.int64()),
                    "n_hit": pa.array(np.bincount(text_of[hit], minlength=b - a), pa.int64()),
                    "items": pa.array(names, pa.list_(pa.string())),
                    "clean": _without(texts[a:b], found, hit),
                }
            yield pa.record_batch([*part.columns[: n - 3], *made.values()], names=[*part.schema.names[: n - 3], *made])


def _without(texts: list[bytes | None], found: Tokens, hit: np.ndarray) -> pa.Array:
    """The texts without the bytes from the first to the last word of each run of hit words."""
    offset = np.cumsum([0, *(len(x or b"") + 1 for x in texts)])
    out, begin = [], 0
    for i, text in enumerate(texts):
        own = hit[begin : begin + found.counts[i]]
        if text is not None and own.any():
            step = np.diff(np.concatenate([[0], own.view(np.int8), [0]]))
            first, last = np.flatnonzero(step == 1) + begin, np.flatnonzero(step == -1) - 1 + begin
            pieces, done = [], 0
            for s, e in zip(found.starts[first] - offset[i], found.ends[last] - offset[i], strict=True):
                pieces.append(text[done:s])
                done = e
            text = b"".join([*pieces, text[done:]])
        out.append(text)
        begin += found.counts[i]
    return pa.array(out, pa.binary()).cast(pa.string())


def _fields(ddl: str) -> list:
    return StructType.fromDDL(ddl).fields


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    width: int = WIDTH, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """All rows and columns of ``docs`` and n_words, n_hit (long), items (array<string>), clean (string).

    Words are lower-cased runs of ASCII letters and digits and of all other scripts. A window is ``width`` consecutive
    words of an item; an item of fewer words is one window; one without words is none. ``n_hit`` counts the words of a
    text inside any window that occurs in it, ``items`` are the items with such windows, in code point order, ``clean``
    is the text without the runs of hit words. Null and empty texts have no words; null stays null. Null item ids count
    as "null"; repeated items are one. Rows are judged one by one, so repeated rows get the same result. The benchmark
    goes to the executors in parts of about ``block_words`` words, and the texts are passed once for each part. An empty
    benchmark or table is fine. Columns with the names above are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_hit", "items", "clean")
    more = unused(docs.columns, "_text", "_hits", "_items")
    kinds = ("string", "array<int>", "array<string>")
    out = docs.select("*", F.col(text).alias(more[0]), *[F.lit(None).cast(k).alias(c) for c, k in zip(more[1:], kinds[1:], strict=True)])
    own = docs.schema.fields
    through = StructType([*own, *_fields(", ".join(f"{c} {k}" for c, k in zip(more, kinds, strict=True)))])
    result = StructType([*own, *_fields("n_words long, n_hit long, items array<string>, clean string")])
    held = None
    for part in _blocks(benchmark, item, item_text, width, block_words):
        if held is not None:  # one part is sent at a time; what a pass found is written
            sent = spark.sparkContext.broadcast(held)
            out = written(in_batches(out, lambda it, sent=sent: _scan(it, sent, False), through), "hits")
            sent.destroy()
        held = part
    last = spark.sparkContext.broadcast(held or {})
    return in_batches(out, lambda it: _scan(it, last, True), result)
