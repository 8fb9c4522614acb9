"""A log-structured index of fingerprints: sorted immutable runs, merge-joined and compacted."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.shared import scratch_path, written


_RUN = "fp long, n int"


class FingerprintLog:
    """Runs of ``(fp long, n int)``, each sorted by ``fp`` in every file and never changed once written.

    ``add`` merge-joins a batch with the history, which gives what is repeated by now, and appends the batch as a run;
    beyond ``fanout`` runs, all are merged into one. ``n`` counts occurrences and stops at 2, which is all that
    deduplication asks. The runs are Parquet in the folder that all executors share; a log that is opened with the path
    and the runs of another goes on where that stopped.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = 2, runs: list[str] | None = None):
        self.spark, self.path, self.fanout = spark, path or scratch_path(spark, "log"), fanout
        self.runs = list(runs or [])
        self._made = 1 + max((int(x.rsplit("run", 1)[1]) for x in self.runs), default=-1)

    def _write(self, rows: DataFrame) -> str:
        run = f"{self.path}/run{self._made}"
        self._made += 1
        rows.sortWithinPartitions("fp").write.parquet(run)
        return run

    def _read(self, run: str) -> DataFrame:
        return self.spark.read.schema(_RUN).parquet(run)

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds a batch ``(fp, n)`` and returns ``fp`` for those of its fingerprints that are repeated, in it or with the history.

        Equal fingerprints are added up before and after the shuffle.
        """
        new = self._write(batch.groupBy("fp").agg(F.least(F.sum("n"), F.lit(2)).cast("int").alias("n")))
        own = self._read(new)
        out = own.where("n >= 2").select("fp").unionByName(self.seen(own.where("n < 2")))
        self.runs.append(new)
        if len(self.runs) > self.fanout:
            out = written(out, "repeated")  # reads runs that compaction leaves behind
            self.compact()
        return out

    def seen(self, batch: DataFrame) -> DataFrame:
        """``fp`` of the rows of ``batch`` that are in the history: a merge join with each run."""
        out = self.spark.createDataFrame([], "fp long")
        for run in self.runs:
            out = out.unionByName(batch.select("fp").join(self._read(run).select("fp").hint("merge"), "fp", "left_semi"))
        return out

    def merged(self) -> DataFrame:
        """All fingerprints with their counts."""
        out = self.spark.createDataFrame([], _RUN)
        for run in self.runs:
            out = out.unionByName(self._read(run))
        return out.groupBy("fp").agg(F.least(F.sum("n"), F.lit(2)).cast("int").alias("n"))

    def compact(self) -> None:
        """All runs as one. The old ones stay until the log's folder goes, so plans that read them still work."""
        self.runs = [self._write(self.merged())]


def bitmap(fps: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``2**bits`` bits with those of the fingerprints set.

    Its size doesn't depend on the number of fingerprints (8 MB for 26 bits), so it may go to the driver and to every
    executor; when it fills, it lets more through, and what it lets through is verified.
    """
    place = F.col("fp").bitwiseAND(F.lit((1 << bits) - 1))
    words = fps.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(fp & 63 as int))").alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[table["word"].to_numpy()] = table["bit"].to_numpy().view(np.uint64)
    return out


def in_bitmap(values: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    place = values & np.uint64((1 << bits) - 1)
    return (words[place >> np.uint64(6)] >> (values & np.uint64(63))) & np.uint64(1) != 0
