"""Media columns: cropped and edited copies of images by local descriptors.

Corners are found in images, and in queries on several scales; round each, 128 comparisons of smoothed brightness, turned to
the patch's own direction, give a binary descriptor, which changes of brightness and contrast leave as it is. Descriptors
meet in an equi-join on four tables of 32 of their bits; a meeting tells scale, turn and shift, and image pairs of which
two corners agree on these roughly are candidates. For a candidate all corners are compared by Hamming distance, and it
is a copy if enough of them agree on one scale, turn and shift.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.words import in_batches
from reelsift.shared import release, written

#: Pixels round a corner that its descriptor sees, directions, least distance of corners and of a corner from the edge.
RADIUS, TURNS, APART, MARGIN = 20, 32, 4, 11
#: Sizes at which queries are described: copies of 0.6 to 1.7 times the size of the image are within a ninth of one.
SCALES = (1 / 1.5, 1 / 1.22, 1.0, 1.22, 1.5)
#: Most bits in which descriptors that agree differ, and such that make candidates; pixels by which places may differ; corners that must agree.
MOST_BITS, NEAR_BITS, NEAR, AGREE = 22, 16, 6, 5
_RNG = np.random.default_rng(8)
#: Tests, even over the disc that descriptors see: two points each.
_TESTS = (np.sqrt(_RNG.random((128, 2, 1))) * RADIUS) * np.stack([np.cos(a := _RNG.random((128, 2)) * 2 * np.pi), np.sin(a)], -1)
_ANGLES = np.arange(TURNS) * 2 * np.pi / TURNS
_SPIN = np.stack([np.stack([np.cos(_ANGLES), -np.sin(_ANGLES)], -1), np.stack([np.sin(_ANGLES), np.cos(_ANGLES)], -1)], -2)
#: For each direction, the tests' points (x, y).
_POINTS = np.rint(np.einsum("aij,tpj->atpi", _SPIN, _TESTS)).astype(np.int64)
_DISC = np.array([(y, x) for y in range(-RADIUS, RADIUS + 1) for x in range(-RADIUS, RADIUS + 1) if x * x + y * y <= RADIUS * RADIUS])
#: A corner: place (x, y) in the whole image, the scale it was found on, direction, descriptor.
POINT = np.dtype([("x", "<f4"), ("y", "<f4"), ("scale", "<i2"), ("turn", "<i2"), ("bits", "<u4", 4)])


def _box(x: np.ndarray, r: int) -> np.ndarray:
    p = np.cumsum(np.cumsum(np.pad(x, ((r + 1, r), (r + 1, r)), mode="edge"), 0), 1)
    k = 2 * r + 1
    p[0], p[:, 0] = p[0], p[:, 0]
    return (p[k:, k:] - p[:-k, k:] - p[k:, :-k] + p[:-k, :-k]) / (k * k)


def _greatest(x: np.ndarray, r: int) -> np.ndarray:
    """The greatest value at most ``r`` rows and columns away."""
    for axis in (0, 1):
        p = np.pad(x, [(r, r) if k == axis else (0, 0) for k in (0, 1)], constant_values=-np.inf)
        x = np.max([np.take(p, np.arange(k, k + x.shape[axis]), axis) for k in range(2 * r + 1)], axis=0)
    return x


def _resized(gray: np.ndarray, factor: float) -> np.ndarray:
    """Linear interpolation; smaller images are smoothed before."""
    if factor == 1:
        return gray
    if factor < 1:
        gray = _box(gray, 1)
    h, w = (max(1, round(n * factor)) for n in gray.shape)
    y, x = (np.clip((np.arange(n) + 0.5) / factor - 0.5, 0, m - 1) for n, m in zip((h, w), gray.shape, strict=True))
    y0, x0 = y.astype(np.int64), x.astype(np.int64)
    y1, x1 = np.minimum(y0 + 1, gray.shape[0] - 1), np.minimum(x0 + 1, gray.shape[1] - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    top = gray[y0][:, x0] * (1 - fx) + gray[y0][:, x1] * fx
    return top * (1 - fy) + (gray[y1][:, x0] * (1 - fx) + gray[y1][:, x1] * fx) * fy


def corners(gray: np.ndarray) -> np.ndarray:
    """All corners (y, x) that are the greatest in their surroundings, not too near the edge and not too weak for the image."""
    if min(gray.shape) <= 2 * MARGIN:
        return np.empty((0, 2), np.int64)
    gy, gx = np.gradient(gray)
    a, b, c = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
    strength = a * b - c * c - 0.05 * (a + b) ** 2
    inner = np.zeros(gray.shape, bool)
    inner[MARGIN:-MARGIN, MARGIN:-MARGIN] = True
    # a share of the strongest, so that noise in flat parts gives no corners and contrast doesn't matter
    least = max(1.0, 0.002 * float(strength[inner].max()))
    return np.argwhere((strength == _greatest(strength, APART)) & (strength > least) & inner)


def describe(gray: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Direction and 128 bits of each corner. Beyond the edge, the image goes on as it ends."""
    if not len(at):
        return np.empty(0, np.int64), np.empty((0, 4), np.uint32)
    soft = np.pad(_box(_box(gray, 1), 1), RADIUS, mode="edge")
    at = at + RADIUS
    disc = soft[at[:, None, 0] + _DISC[None, :, 0], at[:, None, 1] + _DISC[None, :, 1]]
    disc = disc - disc.mean(1, keepdims=True)
    turn = np.rint(np.arctan2(disc @ _DISC[:, 0], disc @ _DISC[:, 1]) / (2 * np.pi) * TURNS).astype(np.int64) % TURNS
    points = at[:, None, None, :] + _POINTS[turn][..., ::-1]
    values = soft[points[..., 0], points[..., 1]]
    # equal parts differ by noise alone, which is small beside the patch's own contrast
    bits = values[..., 1] - values[..., 0] > 0.2 * disc.std(1, keepdims=True)
    return turn, np.packbits(bits, axis=1).view(">u4").astype(np.uint32)


def points(gray: np.ndarray, scales: tuple[float, ...]) -> np.ndarray:
    """The corners of an image at some sizes; places are counted from the image's middle, in its own pixels."""
    out = []
    for k, factor in enumerate(scales):
        level = _box(_resized(gray, factor), 1)
        at = corners(level)
        own = np.zeros(len(at), POINT)
        own["turn"], own["bits"] = describe(level, at)
        own["y"], own["x"] = ((at + 0.5) / factor - np.array(gray.shape) / 2).T
        own["scale"] = k
        out.append(own)
    return np.concatenate(out)


def _describe_batches(batches: Iterator[pa.RecordBatch], scales: tuple[float, ...]) -> Iterator[pa.RecordBatch]:
    """From image, width, height and pixels: image and its corners as bytes; images without corners are left out."""
    for batch in batches:
        names, found = [], []
        for name, w, h, data in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3), strict=True):
            raw = data.as_py()
            if raw and w and h and len(raw) == w * h:
                own = points(np.frombuffer(raw, np.uint8).reshape(h, w).astype(np.float64), scales)
                if len(own):
                    names.append(name)
                    found.append(own.tobytes())
        yield pa.record_batch([pa.array(names, pa.string()), pa.array(found, pa.binary())], names=["image", "points"])


def _described(images: DataFrame, scales: tuple[float, ...]) -> DataFrame:
    """id (given as the table is written), image (its class) and points of each class once."""
    once = images.dropDuplicates(["class"]).select("class", "width", "height", "pixels")
    out = in_batches(once, lambda it: _describe_batches(it, scales), "image string, points binary")
    return written(out.select(F.monotonically_increasing_id().alias("id"), "image", "points"), "points")


_ROWS = "key long, b0 int, b1 int, b2 int, b3 int, id long, x float, y float, scale int, turn int"


def _table_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From id and points: a row for each corner and table, with the table's 32 bits (key) and all bits."""
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            part = batch.slice(a, 1024)
            each = [np.frombuffer(x, POINT) for x in part.column(1).to_pylist()]
            ids, own = np.repeat(part.column(0).to_numpy(), [len(x) for x in each]), np.concatenate(each)
            bits = [np.ascontiguousarray(own["bits"][:, k]).view(np.int32) for k in range(4)]
            for k in range(4):
                key = np.int64(k) << np.int64(32) | own["bits"][:, k].astype(np.int64)
                made = (key, *bits, ids, own["x"], own["y"], own["scale"].astype(np.int32), own["turn"].astype(np.int32))
                yield pa.record_batch([pa.array(x) for x in made], names=["key", "b0", "b1", "b2", "b3", "id", "x", "y", "scale", "turn"])


def _candidates(asked: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs (q, i) of which two corners of the query meet corners of the image at about the same scale, turn and shift."""
    left = in_batches(asked.select("id", "points"), _table_batches, _ROWS)
    right = in_batches(index.select("id", "points"), _table_batches, _ROWS).select(F.col("key").alias("key_i"), *[F.col(c).alias(f"{c}_i") for c in ("b0", "b1", "b2", "b3", "id", "x", "y", "turn")])
    apart = [F.col(f"b{k}").bitwiseXOR(F.col(f"b{k}_i")) for k in range(4)]
    table = F.shiftright("key", 32)
    # corners count in the first table that shows them, and only if they agree in most of all bits
    first = (table == 0) | ((apart[0] != 0) & ((table == 1) | ((apart[1] != 0) & ((table == 2) | (apart[2] != 0)))))
    near = F.bit_count(apart[0]) + F.bit_count(apart[1]) + F.bit_count(apart[2]) + F.bit_count(apart[3]) <= NEAR_BITS
    met = left.join(right.hint("merge"), (F.col("key") == F.col("key_i")) & first & near)
    turn = F.pmod(F.col("turn_i") - F.col("turn"), F.lit(TURNS))
    factor = F.element_at(F.array(*[F.lit(x) for x in SCALES]), F.col("scale") + 1)
    angle = turn * (2 * np.pi / TURNS)
    x = F.col("x_i") - factor * (F.cos(angle) * F.col("x") - F.sin(angle) * F.col("y"))
    y = F.col("y_i") - factor * (F.sin(angle) * F.col("x") + F.cos(angle) * F.col("y"))
    cell = lambda v: F.floor(v / (4 * NEAR)).cast("int")
    votes = met.select(F.col("id").alias("q"), F.col("id_i").alias("i"), "scale", F.floor(turn / 2).alias("turn"), cell(x).alias("cx"), cell(y).alias("cy"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    agreed = votes.groupBy("q", "i", "scale", "turn", "cx", "cy").agg(F.min("x").alias("x1"), F.max("x").alias("x2"), F.min("y").alias("y1"), F.max("y").alias("y2"))
    return agreed.where("x1 <> x2 or y1 <> y2").select("q", "i").distinct()


def agreeing(asked: np.ndarray, image: np.ndarray) -> int:
    """The most corners of an image that agree with corners of a query on one scale, turn and shift."""
    apart = np.bitwise_count(asked["bits"][:, None, :] ^ image["bits"][None, :, :]).sum(-1, dtype=np.int64)
    a, b = np.nonzero(apart <= MOST_BITS)
    if len(a) < AGREE:
        return 0
    p, r = asked[a], image[b]
    turn = (r["turn"].astype(np.int64) - p["turn"]) % TURNS
    at, to = np.stack([p["x"], p["y"]], 1).astype(float), np.stack([r["x"], r["y"]], 1).astype(float)
    order, best = np.argsort(apart[a, b], kind="stable"), 0
    for h in order:  # each meeting, the surest first, as a guess of all three
        if best >= (p["scale"] == p["scale"][h]).sum():
            continue
        moved = np.array(SCALES)[p["scale"][h]] * (at - at[h]) @ _SPIN[turn[h]].T + to[h]
        spread = NEAR + 0.12 * np.abs(at - at[h]).max(1)  # turns and scales are rounded
        off = np.abs((turn - turn[h] + TURNS // 2) % TURNS - TURNS // 2)
        good = (p["scale"] == p["scale"][h]) & (off <= 2) & (np.abs(moved - to).max(1) <= spread)
        best = max(best, min(len(np.unique(a[good])), len(np.unique(b[good]))))
    return best


def _compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From q, image and the points of both: q, image and n for copies."""
    for batch in batches:
        n = np.array([agreeing(np.frombuffer(a, POINT), np.frombuffer(b, POINT)) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)], np.int64)
        keep = pa.array(np.flatnonzero(n >= AGREE))
        yield pa.record_batch([batch.column(0).take(keep), batch.column(1).take(keep), pa.array(n).take(keep)], names=["q", "image", "n"])


def find_copies(images: DataFrame, queries: DataFrame, key: str = "id") -> DataFrame:
    """For each query: key, copies (array<string>, classes of images it is a crop or edit of, in order), n_points (long, most corners that agree).

    ``images`` and ``queries`` have the key, width, height (int) and pixels (binary, one byte each). Images of equal pixels
    are one class, named by the MD5 of its pixels and described once; see ``image_classes`` for its members. Null,
    empty and small images, or such as don't fit their size, have no corners and no copies. Repeated queries get the same
    result. Other columns are not looked at. An empty table gives an empty result.
    """
    index = _described(image_classes(images, key), (1.0,))
    asked = image_classes(queries, key)
    wanted = _described(asked, SCALES)
    pairs = written(_candidates(wanted, index), "pairs")
    left = wanted.select(F.col("id").alias("qi"), F.col("image").alias("q_image"), F.col("points").alias("q_points"))
    right = index.select(F.col("id").alias("ii"), F.col("image"), "points")
    both = pairs.join(right.hint("merge"), F.col("i") == F.col("ii")).join(left.hint("merge"), F.col("q") == F.col("qi"))
    matches = written(in_batches(both.select("q_image", "image", "q_points", "points"), _compare_batches, "q string, image string, n long"), "matches")
    release(pairs, index, wanted)
    found = matches.groupBy("q").agg(F.array_sort(F.collect_list("image")).alias("copies"), F.max("n").alias("n_points"))
    out = asked.select("id", "class").join(found, F.col("class") == F.col("q"), "left")
    return out.select(F.col("id").alias(key), F.coalesce("copies", F.array().cast("array<string>")).alias("copies"), F.coalesce("n_points", F.lit(0)).alias("n_points"))


def image_classes(images: DataFrame, key: str = "id") -> DataFrame:
    """Key as id, class (MD5 of size and pixels; null pixels: of none), width, height, pixels."""
    name = F.md5(F.concat(F.concat_ws("x", "width", "height").cast("binary"), F.coalesce("pixels", F.lit(b""))))
    return images.select(F.col(key).alias("id"), name.alias("class"), "width", "height", "pixels")


def _small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, as pixels take more than what they are made from."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def drawn(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cell: int = 12) -> DataFrame:
    """Gray images drawn from vectors, a square cell for each number in rows of the square root; null and empty ones have no pixels."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            pixels, sides = [], []
            for v in batch.column(1):
                own = np.array([0.0 if n is None else n for n in v.as_py() or []], float)
                side = int(np.ceil(np.sqrt(len(own))))
                x = np.zeros(side * side)
                x[: len(own)] = own
                sides.append(side * cell)
                pixels.append(np.kron(np.clip(128 + 400 * x, 0, 255).reshape(side, side), np.ones((cell, cell))).astype(np.uint8).tobytes() if side else None)
            width = pa.array(sides, pa.int32())
            yield pa.record_batch([batch.column(0), width, width, pa.array(pixels, pa.binary())], names=["id", "width", "height", "pixels"])

    return in_batches(vectors.select(F.col(key).cast("long"), vector), draw, "id long, width int, height int, pixels binary")


def edited(images: DataFrame, left: int = 12, top: int = 6, contrast: float = 0.8, light: float = 20) -> DataFrame:
    """The images without their left and top edges, and of less contrast; those without pixels stay so."""

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            ids, widths, heights, pixels = (c.to_pylist() for c in batch.columns)
            new = [np.clip(np.rint(np.frombuffer(p, np.uint8).reshape(h, w)[top:, left:] * contrast + light), 0, 255).astype(np.uint8).tobytes() if p else None for w, h, p in zip(widths, heights, pixels, strict=True)]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([max(0, w - left) for w in widths], pa.int32()), pa.array([max(0, h - top) for h in heights], pa.int32()), pa.array(new, pa.binary())], names=["id", "width", "height", "pixels"])

    return in_batches(images.select("id", "width", "height", "pixels"), edit, "id long, width int, height int, pixels binary")


def copy_search(vectors: DataFrame, every: int = 20) -> DataFrame:
    """Edited crops of the images drawn from every ``every``-th vector against all images: vec_id, n_copies, n_points, found (its own image is among the copies), n_members (vectors of its class)."""
    images = drawn(vectors)
    classes = written(image_classes(images).select("id", "class"), "classes")
    asked = edited(drawn(vectors.where(F.col("vec_id") % every == 0)))
    own = classes.select(F.col("id").alias("i"), "class").distinct()
    result = find_copies(images, asked).join(own, F.col("id") == F.col("i"))
    sizes = written(classes.groupBy(F.col("class").alias("c")).agg(F.count(F.lit(1)).alias("n_members")), "sizes")
    result = result.join(sizes, F.col("class") == F.col("c"))
    return result.select(F.col("id").alias("vec_id"), F.size("copies").cast("long").alias("n_copies"), "n_points", F.array_contains("copies", F.col("class")).alias("found"), "n_members")
