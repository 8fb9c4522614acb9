"""Command line: ``python -m reelsift run`` and ``upload``. Wrong settings or input end with 2 and a line on stderr."""

from __future__ import annotations

import argparse
import importlib
import logging
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from reelsift.plans.batch import run_folder
from reelsift.plans.config import Settings, load_settings
from reelsift.shared import scratch_path
from reelsift.sources.media import Backends, default_backends, missing_tools
from reelsift.sources.storage import connect, download_clips, remote_settings, upload_clips, upload_reports


def _arguments() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="reelsift", description="Measures clips and applies an acceptance policy; sources are only read.")
    commands = out.add_subparsers(dest="command", required=True)
    run, upload = commands.add_parser("run", help="write reports of a folder's clips"), commands.add_parser("upload", help="copy a folder's clips to the store")
    for command in (run, upload):
        command.add_argument("--input", help="the folder of clips")
        command.add_argument("--config", type=Path, help="settings in YAML")
        command.add_argument("-v", "--verbose", action="store_true")
    run.add_argument("--from-storage", action="store_true", help="read the clips from the store")
    run.add_argument("--output-dir", help="the folder of reports")
    run.add_argument("--limit", type=int, help="only so many clips, first in path order")
    run.add_argument("--backends", help="module:name of Backends in place of ffprobe and ffmpeg")
    return out


def _backends(name: str | None) -> Backends:
    if name:
        module, _, attribute = name.partition(":")
        return getattr(importlib.import_module(module), attribute)
    if missing := missing_tools():
        raise RuntimeError(f"not in the PATH: {', '.join(missing)}")
    return default_backends()


def _run(spark: SparkSession, args: argparse.Namespace, settings: Settings) -> None:
    store = settings.storage
    if args.output_dir:
        settings.output_dir = args.output_dir
    store.read_videos = store.read_videos or args.from_storage
    if store.read_videos and not store.enabled:
        raise ValueError("storage.read_videos needs storage.enabled")
    if store.read_videos == bool(args.input):
        raise ValueError("give either --input or --from-storage")
    if args.limit is not None and args.limit < 1:
        raise ValueError("limit must be at least 1")
    backends, folder = _backends(args.backends), args.input
    if store.read_videos:
        remote = remote_settings()
        connect(spark, store, remote)
        folder = scratch_path(spark, "clips")
        download_clips(spark, settings, folder, remote)
    elif not Path(folder).is_dir() and "://" not in folder:
        raise FileNotFoundError(f"no folder {folder}")
    _, summary = run_folder(spark, folder, settings, backends, args.limit)
    row = summary.first()
    print(f"{row.total} clips: {row.accepted} accepted, {row.rejected} rejected, {row.errors} errors")
    for place in [f"{settings.output_dir}/results.jsonl", f"{settings.output_dir}/results.parquet", *upload_reports(spark, settings.output_dir, store)]:
        print(place)


def _upload(spark: SparkSession, args: argparse.Namespace, settings: Settings) -> None:
    if not args.input:
        raise ValueError("--input is needed")
    remote = remote_settings()
    connect(spark, settings.storage, remote)
    for place in upload_clips(spark, args.input, settings, remote):
        print(place)


def main(argv: list[str] | None = None) -> int:
    args = _arguments().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO, format="%(levelname)s %(message)s")
    try:
        settings = load_settings(args.config.read_text(encoding="utf-8") if args.config else "")
        spark = SparkSession.builder.appName("reelsift").getOrCreate()
        (_run if args.command == "run" else _upload)(spark, args, settings)
    except (ValueError, RuntimeError, OSError) as wrong:
        print(f"error: {wrong}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
