"""Object stores, by any file system that Spark knows: reports and clips go up, clips come down, archives are tar files."""

from __future__ import annotations

import configparser
import io
import logging
import os
import posixpath
import tarfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.sources.clips import clips_only, guard_prefix, list_files, read_archives

#: The archive's name under the clips' prefix; the remote's name in the data versioning tool's settings.
ARCHIVE, REMOTE = "videos.tar", 'remote "s3"'
CHUNK = 1 << 22
_log = logging.getLogger(__name__)


def remote_settings(folder: str = ".") -> dict[str, str]:
    """bucket, prefix, endpoint and keys of the remote that the nearest folder upwards configures; {} where there is none."""
    at = os.path.abspath(folder)
    while not os.path.isfile(f"{at}/.dvc/config"):
        if at == os.path.dirname(at):
            return {}
        at = os.path.dirname(at)
    found = configparser.ConfigParser(interpolation=None)
    found.read([f"{at}/.dvc/config", f"{at}/.dvc/config.local"], encoding="utf-8")
    own = next((dict(found[x]) for x in found.sections() if REMOTE in x), {})
    url = own.get("url", "").strip()
    if not url.startswith("s3://") or not url[5:].split("/")[0]:
        return {}
    bucket, _, prefix = url[5:].partition("/")
    return {"bucket": bucket, "prefix": prefix.strip("/"), "endpoint": own.get("endpointurl", "").strip(), "key": own.get("access_key_id", "").strip(), "secret": own.get("secret_access_key", "").strip()}


def connect(spark: SparkSession, store, remote: dict[str, str]) -> None:
    """Tells Spark's s3a file system where the store is; keys of the environment come before those of the remote."""
    conf = spark._jsc.hadoopConfiguration()
    for name, value in (("endpoint", store.endpoint_url.strip() or remote.get("endpoint", "")), ("endpoint.region", store.region.strip())):
        if value:
            conf.set(f"fs.s3a.{name}", value)
    if remote.get("key") and not os.environ.get("AWS_ACCESS_KEY_ID"):
        conf.set("fs.s3a.access.key", remote["key"])
        conf.set("fs.s3a.secret.key", remote["secret"])


def clips_url(store, remote: dict[str, str], root: str | None = None) -> str:
    """Where clips are: ``root`` (default: the bucket) and the checked prefix; a bucket other than the remote's is logged."""
    if not store.enabled:
        raise ValueError("storage.enabled is false")
    if remote.get("bucket") and remote["bucket"] != store.bucket:
        _log.warning("storage.bucket is %s, the remote's bucket is %s", store.bucket, remote["bucket"])
    prefix = guard_prefix(store.videos_prefix, remote.get("prefix", ""))
    return f"{(root or 's3a://' + store.bucket).rstrip('/')}/{prefix}"


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _copy(spark: SparkSession, source: str, target: str) -> None:
    (a, from_fs), (b, to_fs) = _fs(spark, source), _fs(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, a, to_fs, b, False, True, spark._jsc.hadoopConfiguration())


def upload_reports(spark: SparkSession, folder: str, store, root: str | None = None) -> list[str]:
    """Copies the reports under the store's prefix; nothing where the store is off."""
    if not store.enabled:
        return []
    prefix = store.prefix.strip().strip("/")
    base = "/".join(x for x in ((root or f"s3a://{store.bucket}").rstrip("/"), prefix) if x)
    out = []
    for name in ("results.jsonl", "results.parquet"):
        _copy(spark, f"{folder}/{name}", f"{base}/{name}")
        out.append(f"{base}/{name}")
    return out


def _chunks(stream) -> Iterator[bytes]:
    while data := bytes(stream.readNBytes(CHUNK)):
        yield data


def upload_clips(spark: SparkSession, folder: str, settings, remote: dict[str, str] | None = None, root: str | None = None) -> list[str]:
    """Copies all clips of a folder to the store, as they are or in one tar file, a few MB at a time; none are an error."""
    base = clips_url(settings.storage, remote or {}, root)
    found = clips_only(list_files(spark, folder, settings.recursive), settings.extensions).orderBy("source")
    if found.isEmpty():
        raise FileNotFoundError(f"no clips in {folder}")
    if settings.storage.archive == "files":
        out = []
        for row in found.toLocalIterator():
            _copy(spark, row.path, f"{base}/{row.source}")
            out.append(f"{base}/{row.source}")
        return out
    target, fs = _fs(spark, f"{base}/{ARCHIVE}")
    stream = fs.create(target, True)
    for row in found.toLocalIterator():
        member = tarfile.TarInfo(row.source)
        member.size = row.length
        stream.write(bytearray(member.tobuf(tarfile.PAX_FORMAT)))
        path, own = _fs(spark, row.path)
        source = own.open(path)
        for data in _chunks(source):
            stream.write(bytearray(data))
        source.close()
        stream.write(bytearray(-row.length % tarfile.BLOCKSIZE))
    stream.write(bytearray(2 * tarfile.BLOCKSIZE))
    stream.close()
    return [f"{base}/{ARCHIVE}"]


def download_clips(spark: SparkSession, settings, folder: str, remote: dict[str, str] | None = None, root: str | None = None) -> DataFrame:
    """Copies all clips of the store to a folder that executors share and returns (source, path, length); none are an error.

    Directory marks, absolute and ".." names are passed over in a store; in an archive such names are an error.
    """
    base = clips_url(settings.storage, remote or {}, root)
    if settings.storage.archive == "tar":
        target, fs = _fs(spark, f"{base}/{ARCHIVE}")
        if not fs.exists(target):
            raise FileNotFoundError(f"no archive {base}/{ARCHIVE}; upload clips first")
        saved = read_archives(spark, f"{base}/{ARCHIVE}", settings.extensions)
        names = _unpacked(saved, folder)
    else:
        found = clips_only(list_files(spark, base), settings.extensions)
        safe = ~F.col("source").startswith("/") & ~F.array_contains(F.split("source", "/"), "..")
        names = 0
        for row in found.where(safe).toLocalIterator():
            _copy(spark, row.path, f"{folder}/{row.source}")
            names += 1
    if not names:
        raise FileNotFoundError(f"no clips in {base}")
    return clips_only(list_files(spark, folder), settings.extensions)


def _unpacked(members: DataFrame, folder: str) -> int:
    """Writes members (source, content) as files, by the executors that read them."""
    plain = folder.removeprefix("file://")

    def write(batches):
        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["source"], batch["content"], strict=True):
                path = posixpath.join(plain, name)
                os.makedirs(posixpath.dirname(path), exist_ok=True)
                with io.open(path, "wb") as out:
                    out.write(content)
            yield pd.DataFrame({"n": [len(batch)]})

    return members.select("source", "content").mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0
