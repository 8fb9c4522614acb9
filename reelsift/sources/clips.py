"""Where clips come from and reports go: listings, archives, reports, ids. Sources are only ever read."""

from __future__ import annotations

import io
import posixpath
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelsift.functions.captions import extension, path_id, path_order, stem
from reelsift.shared import written

#: File name extensions of clips.
EXTENSIONS = ("mp4", "mov", "mkv", "webm", "avi", "m4v")


def normal_extensions(names: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(x for x in (n.strip().lower().lstrip(".") for n in names) if x)


def list_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(source, path, length) of all regular files under a folder of any store that Spark reads, empty ones and dotfiles too.

    The driver lists them, as for any table that Spark reads, 100,000 at a time.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    base = fs.makeQualified(fs_path).toString().rstrip("/")
    walk = fs.listFiles(fs_path, recursive)
    parts: list[DataFrame] = []
    rows: list[tuple[str, str, int]] = []

    def table() -> DataFrame:
        return spark.createDataFrame(rows, "source string, path string, length long")

    while walk.hasNext():
        status = walk.next()
        path = status.getPath().toString()
        rows.append((path[len(base) + 1 :], path, status.getLen()))
        if len(rows) == 100_000:  # bounded on the driver
            parts.append(table())
            rows = []
    parts.append(table())
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def clips_only(files: DataFrame, extensions: tuple[str, ...] = EXTENSIONS, output_dir: str | None = None) -> DataFrame:
    """Files with a clip's extension in any case that aren't inside the output folder."""
    out = files.where(extension(F.col("source")).isin(*normal_extensions(extensions)))
    if output_dir is not None:
        inside = F.col("path").startswith(output_dir.rstrip("/") + "/")
        out = out.where(~inside)
    return out


def identified(files: DataFrame, limit: int | None = None) -> DataFrame:
    """The first ``limit`` clips in path order with clip_idx and video_id.

    The id is the stem, or the whole path where stems repeat or an earlier clip has that id. Clips are numbered by ranges
    of paths and the number of clips before each range, so no task sees all of them.
    """
    if limit is not None:
        if limit < 1:
            raise ValueError("limit must be at least 1")
        files = files.orderBy(path_order(F.col("source"))).limit(limit)
    order = path_order(F.col("source"))
    rows = files.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id())
    rows = written(rows.withColumns({"_range": F.shiftright("_at", 33), "_stem": stem(F.col("source"))}), "ranges")
    sizes = rows.groupBy(F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_r", (F.sum("_n").over(Window.orderBy("_r")) - F.col("_n")).alias("_before"))
    stems = rows.groupBy(F.col("_stem").alias("_s")).agg(F.count(F.lit(1)).alias("_same"))
    rows = rows.join(F.broadcast(before), F.col("_range") == F.col("_r")).join(stems, F.col("_stem") == F.col("_s"))
    rows = rows.withColumn("clip_idx", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    rows = rows.withColumns({"_whole": path_id(F.col("source")), "_long": F.col("_same") > 1})
    rows = written(rows.drop("_at", "_range", "_r", "_before", "_s", "_same"), "clips")
    while True:  # a stem that is an earlier clip's whole path; a clip renamed so can stand in the way of a later one
        taken = rows.where("_long").groupBy(F.col("_whole").alias("_t")).agg(F.min("clip_idx").alias("_first"))
        met = rows.join(taken, ~F.col("_long") & (F.col("_stem") == F.col("_t")) & (F.col("_first") < F.col("clip_idx")), "left")
        if met.where("_t is not null").isEmpty():
            return rows.withColumn("video_id", F.when(F.col("_long"), F.col("_whole")).otherwise(F.col("_stem"))).drop("_stem", "_whole", "_long")
        rows = written(met.withColumn("_long", F.col("_long") | F.col("_t").isNotNull()).drop("_t", "_first"), "clips")


def safe_member(name: str) -> bool:
    return not name.startswith("/") and ".." not in name.split("/")


def _members(batches: Iterator[pd.DataFrame], extensions: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            with tarfile.open(fileobj=io.BytesIO(content)) as archive:
                for member in archive:
                    if not member.isfile():
                        continue
                    if not safe_member(member.name):
                        raise ValueError(f"unsafe path in archive: {member.name}")
                    if posixpath.splitext(member.name)[1].lower().lstrip(".") in extensions:
                        data = archive.extractfile(member).read()
                        yield pd.DataFrame([(member.name, f"{path}#{member.name}", len(data), data)], columns=["source", "path", "length", "content"])


def read_archives(spark: SparkSession, path: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """Clips inside tar files: links and other non-files are passed over, absolute and ".." names are an error."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    wanted = normal_extensions(extensions)
    return files.mapInPandas(lambda it: _members(it, wanted), "source string, path string, length long, content binary")


def write_reports(records: DataFrame, folder: str) -> None:
    """results.jsonl and results.parquet with a fixed schema and explicit nulls; each run replaces the last."""
    records.write.mode("overwrite").parquet(f"{folder}/results.parquet")
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/results.jsonl")


def guard_output(input_dir: str, output_dir: str) -> None:
    """The input must not be the output folder or lie inside it."""
    a, b = (posixpath.normpath(x) for x in (input_dir, output_dir))
    if a == b or a.startswith(b + "/"):
        raise ValueError("the input folder must not be inside the output folder")


def guard_prefix(prefix: str, remote_prefix: str = "") -> str:
    """A store prefix for clips: not empty, and not where the data versioning tool keeps its files."""
    own = prefix.strip().strip("/")
    reserved = {"files", "/".join(x for x in (remote_prefix.strip().strip("/"), "files") if x)}
    if not own or any(own == x or own.startswith(x + "/") for x in reserved):
        raise ValueError(f"prefix not allowed: {prefix!r}")
    return own
