"""Audio quality from waveforms: frame energy as a window over samples, and scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions.numbers import clamp, rounded, weighted_mean

FRAME, HOP = 2048, 512
SILENCE_DB, CLIP_LEVEL = -40.0, 0.999
#: Weights of silence, energy and clipping.
WEIGHTS = (0.45, 0.30, 0.25)


def silence_score(ratio: Column) -> Column:
    return F.when(ratio <= 0.25, 1.0).otherwise(clamp((0.95 - ratio) / 0.70))


def energy_score(rms: Column) -> Column:
    quiet = clamp(rms / 0.005) * 0.5
    return F.when(rms <= 0, 0.0).when(rms < 0.005, quiet).when(rms < 0.02, 0.5 + 0.5 * (rms - 0.005) / 0.015).when(rms <= 0.30, 1.0).otherwise(clamp(1 - (rms - 0.30) / 0.70))


def audio_quality(silence: Column, rms: Column, clipping: Column, weights: tuple[float, float, float] = WEIGHTS) -> Column:
    return weighted_mean([(silence_score(silence), weights[0]), (energy_score(rms), weights[1]), (1 - clamp(clipping / 0.01), weights[2])])


def measured(samples, silence_db: float = SILENCE_DB, weights: tuple[float, float, float] = WEIGHTS) -> dict[str, float]:
    """The same facts of one clip's samples, an array, in NumPy; without samples it is an error."""
    x = np.asarray(samples, np.float64).ravel()
    if not x.size:
        raise ValueError("no samples")
    runs = np.zeros(x.size // HOP + 4)
    square = np.add.reduceat(x * x, np.arange(0, x.size, HOP))
    runs[2 : 2 + len(square)] = square
    frames = np.sqrt(np.convolve(runs, np.ones(FRAME // HOP), "valid")[: x.size // HOP + 1] / FRAME)
    silence, rms, clipping = float((frames < 10 ** (silence_db / 20)).mean()), float(frames.mean()), float((np.abs(x) >= CLIP_LEVEL).mean())
    quiet = 1.0 if silence <= 0.25 else float(np.clip((0.95 - silence) / 0.70, 0, 1))
    energy = float(np.interp(rms, [0, 0.005, 0.02, 0.30, 1.0], [0, 0.5, 1, 1, 0]))
    quality = float(np.average([quiet, energy, 1 - min(1.0, clipping / 0.01)], weights=weights))
    return {"silence_ratio": round(silence, 4), "rms": round(rms, 6), "clipping_ratio": round(clipping, 6), "audio_quality": round(quality, 4)}


def analyze(samples: DataFrame, clip: str = "clip_id", i: str = "i", x: str = "x", silence_db: float = SILENCE_DB, weights: tuple[float, float, float] = WEIGHTS) -> DataFrame:
    """silence_ratio, rms, clipping_ratio, audio_quality by clip, from one row for each sample.

    Frames of 2048 samples every 512, centred, with zeros beyond the ends; a clip of n samples has n // 512 + 1 of them.
    Squares are first added up in runs of 512 samples, of which a frame is four, so what is shuffled is 1/512 of the
    samples, and no clip is sorted.
    """
    rows = samples.select(F.col(clip).alias("c"), F.col(i).cast("long").alias("i"), F.col(x).cast("double").alias("x"))
    runs = rows.groupBy("c", F.floor(F.col("i") / HOP).alias("run")).agg(F.sum(F.col("x") * F.col("x")).alias("square"), F.count(F.lit(1)).alias("n"), F.sum((F.abs("x") >= CLIP_LEVEL).cast("int")).alias("clipped"))
    ends = runs.groupBy(F.col("c").alias("o")).agg(F.sum("n").alias("n"), F.sum("clipped").alias("clipped"))
    frames = runs.select("c", F.explode(F.sequence(F.col("run") - 1, F.col("run") + 2)).alias("k"), "square").groupBy("c", "k").agg(F.sqrt(F.sum("square") / FRAME).alias("e"))
    framed = frames.join(ends, F.col("c") == F.col("o")).where((F.col("k") >= 0) & (F.col("k") <= F.floor(F.col("n") / HOP)))
    level = 10 ** (silence_db / 20)
    out = framed.groupBy("c").agg(F.avg((F.col("e") < level).cast("int")).alias("silence"), F.avg("e").alias("rms"), (F.first("clipped") / F.first("n")).alias("clipping"))
    return out.select(
        F.col("c").alias(clip), rounded(F.col("silence"), 4).alias("silence_ratio"), rounded(F.col("rms"), 6).alias("rms"), rounded(F.col("clipping"), 6).alias("clipping_ratio"),
        rounded(audio_quality(F.col("silence"), F.col("rms"), F.col("clipping"), weights), 4).alias("audio_quality"),
    )
