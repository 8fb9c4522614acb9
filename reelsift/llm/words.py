"""Words of whole texts as 64-bit hashes, in NumPy arrays, a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text handled at once by a Python worker; one longer text is handled alone.
SLICE_BYTES = 1 << 19

#: Most bytes of a batch that goes to a Python worker, but for one longer row. The executor holds each batch several times over.
BATCH_BYTES = 2 * SLICE_BYTES

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_RANDOM = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def _table(shown: dict[int, int]) -> np.ndarray:
    """A value for each byte: 0 separates words, other bytes count as the byte that ``shown`` gives."""
    out = np.zeros(256, np.uint64)
    for byte, as_byte in shown.items():
        out[byte] = _RANDOM[as_byte]
    return out


#: Words are runs outside x20 and x09-x0D, unchanged.
BLANKS = _table({b: b for b in range(256) if b != 32 and not 9 <= b <= 13})
#: Words are runs of ASCII letters and digits and of all bytes of other scripts; A-Z count as a-z.
PLAIN = _table({b: b + 32 if 65 <= b <= 90 else b for b in range(256) if b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122})


class Tokens(NamedTuple):
    """Hashes of all words, number of words by text, and where each word lies in ``joined``."""

    ids: np.ndarray
    counts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    joined: bytes


_grown: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_grown.get(base, ())) < n:
        out = np.full(max(n, SLICE_BYTES * 5 // 4), base, np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if n > 16 * SLICE_BYTES:  # one huge text; nothing that large is kept
            return out[:n]
        _grown[base] = out
    return _grown[base][:n]


def in_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with batches of a bounded number of bytes, for which it lowers the session's setting."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    now = str(conf.get(setting)).lower().removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        conf.set(setting, str(BATCH_BYTES))
    if any("." in c for c in df.columns):  # mapInArrow looks columns up by name, where a dot is a field; results go by place
        df = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return df.mapInArrow(work, schema)


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(taken: list[str], *names: str) -> list[str]:
    """The names, with marks added until no column has them (Spark doesn't tell case apart)."""
    have, out = {x.lower() for x in taken}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out


def as_bytes(column) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column."""
    return column.cast(pa.binary()).to_pylist()


def slices(texts: list[bytes | int | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows of about ``limit`` bytes; rows are texts or their sizes."""
    start = size = 0
    for i, text in enumerate(texts):
        size += text if isinstance(text, int) else len(text or b"")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def text_slices(column: pa.Array, *more: pa.Array) -> Iterator[tuple[int, int, list]]:
    """Bounds of consecutive rows of about ``SLICE_BYTES`` and their texts as bytes; only one slice is copied at a time."""
    columns = [column, *more]
    sizes = [pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False) for c in columns]
    for a, b in slices(sum(sizes).tolist() if len(column) else []):
        yield a, b, [as_bytes(c.slice(a, b - a)) for c in columns]


def _spans(values: np.ndarray, n: int, width: np.ndarray | int, starts: np.ndarray) -> np.ndarray:
    """Hash of ``width`` values from each start, by one running sum modulo 2**64."""
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(_INVERSE, n), out=sums[1:])
    return mix((sums[starts + width] - sums[starts]) * _powers(_BASE, n)[starts])


def tokens(texts: list[bytes | None], table: np.ndarray) -> Tokens:
    joined = b"\n".join(x or b"" for x in texts)
    values = table[np.frombuffer(joined, np.uint8)]
    edge = np.zeros(len(joined) + 2, np.int8)
    edge[1:-1] = values != 0
    step = np.diff(edge)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    ids = _spans(values, len(joined), ends - starts, starts) if len(starts) else np.empty(0, np.uint64)
    after = np.cumsum(np.fromiter((len(x or b"") + 1 for x in texts), np.int64, len(texts)))
    counts = np.diff(np.searchsorted(starts, after), prepend=0)
    return Tokens(ids, counts, starts, ends, joined)


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive ids; shorter input gives none."""
    if len(ids) < width:
        return np.empty(0, np.uint64)
    return _spans(ids, len(ids), width, np.arange(len(ids) - width + 1))


def range_hashes(ids: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """A hash of the ids of each range."""
    return _spans(ids, len(ids), widths, starts) if len(starts) else np.empty(0, np.uint64)


def inside(counts: np.ndarray, width: int) -> np.ndarray:
    """For each window of the joined texts, whether it lies in one text."""
    n = int(counts.sum()) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    return np.arange(n) + width <= np.repeat(np.cumsum(counts), counts)[:n]


def moving(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of each ``width`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        values = pick(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return pick(values[: len(values) - rest], values[rest:]) if rest else values
