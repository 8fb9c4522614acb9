"""The batch: listed clips to records with technical, visual, audio, caption, content and duplicate facts, then the policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.functions.captions import collapse, reply_score
from reelsift.functions.probe import audio_window, frame_timestamps, parse_payload, technical_block, technical_reasons
from reelsift.operators.policy import apply_policy, run_summary
from reelsift.operators.similarity import annotate
from reelsift.plans.config import Settings
from reelsift.plans.extract import extract_facts, probe_clips
from reelsift.shared import written
from reelsift.sources.clips import clips_only, guard_output, identified, list_files, write_reports
from reelsift.sources.media import Backends

#: Blocks of a public record in order, and their fields.
PUBLIC = ("video_id", "source", "technical", "visual", "vlm", "video_text", "audio", "content", "deduplication", "filtering")
VISUAL = "struct<aesthetic_score:double,watermark_probability:double,text_area_ratio:double>"
VLM = "struct<caption:string,judge_model:string,judge_caption:string,semantic_consistency:double,temporal_coverage:double,completeness:double,hallucination:double>"
VIDEO_TEXT = "struct<model:string,cosine_similarity:double,caption_replaced:string,cosine_similarity_replaced:double>"
AUDIO = "struct<silence_ratio:double,rms:double,clipping_ratio:double,audio_quality:double>"


#: Most clips of a task that reads media; where there are fewer clips than cores would take, as many tasks as cores.
CLIPS_OF_TASK = 1000


def dealt(clips: DataFrame, count: int) -> DataFrame:
    """``clips`` spread evenly over tasks, however few files or partitions they come from: what a clip costs is not its row."""
    tasks = max(-(-count // CLIPS_OF_TASK), clips.sparkSession.sparkContext.defaultParallelism)
    return clips.repartition(tasks, "clip_idx")


def _filled(block: Column, kind: str) -> Column:
    """A block that wasn't measured has its fields, all null."""
    return F.coalesce(block, F.from_json(F.lit("{}"), kind)).cast(kind)


def vlm_block(caption: Column, judge_model: str, judge_caption: Column, reply: Column) -> Column:
    """The caption, and the judge's scores from its reply: all of them, or none."""
    names = ("semantic_consistency", "temporal_coverage", "completeness", "hallucination")
    scores = [reply_score(reply, x) for x in names]
    whole = scores[0].isNotNull() & scores[1].isNotNull() & scores[2].isNotNull() & scores[3].isNotNull()
    told = [F.when(whole, F.lit(judge_model)).alias("judge_model"), F.when(whole, collapse(judge_caption)).alias("judge_caption")]
    return F.struct(F.nullif(collapse(caption), F.lit("")).alias("caption"), *told, *[F.when(whole, F.bround(s, 4)).alias(x) for s, x in zip(scores, names, strict=True)])


def run_batch(clips: DataFrame, settings: Settings, backends: Backends) -> DataFrame:
    """Records with the public columns in fixed order.

    ``clips``: clip_idx, video_id, source, path, length, and payload where clips were probed already. Clips that can't be
    read, or whose length or video is unknown, get no media facts. A clip on which a stage fails in an unforeseen way is
    a record of nulls with the codes unreadable and processing_error.
    """
    policy = settings.technical()
    count = clips.count()
    clips = dealt(clips, count)
    if "payload" not in clips.columns:
        clips = probe_clips(clips, settings, backends)
    elif "probe_failed" not in clips.columns:
        clips = clips.withColumn("probe_failed", F.lit(None).cast("string"))
    probed = clips.withColumn("probe", parse_payload(F.col("payload"), F.col("length")))
    probed = probed.withColumn("probe", F.col("probe").withField("probe_error", F.coalesce("probe_failed", "probe.probe_error")))
    probed = probed.withColumn("technical_reasons", technical_reasons(F.col("probe"), policy))
    probed = probed.withColumn("technical", technical_block(F.col("probe"), F.col("technical_reasons"), policy.target_fps))
    p = F.col("probe")
    usable = p["probe_error"].isNull() & (p["file_size_bytes"] > 0) & p["duration_sec"].isNotNull() & p["video_codec"].isNotNull() & p["width"].isNotNull()
    rows = written(probed.select("clip_idx", "video_id", "source", "path", "probe", "technical_reasons", "technical", F.coalesce(usable, F.lit(False)).alias("usable")), "probed")
    window = audio_window(p["duration_sec"], settings.audio.max_analyze_sec)
    asked = rows.where("usable").select(
        "clip_idx", "path", F.col("technical.technical_ok").alias("technical_ok"), p["has_audio"].alias("has_audio"),
        frame_timestamps(p["duration_sec"], settings.frames.count).alias("times"), window["start"].alias("start"), window["length"].alias("length"),
    )
    facts = written(extract_facts(dealt(asked, count), settings, backends), "facts").withColumnRenamed("clip_idx", "f")
    rows = rows.join(facts, F.col("clip_idx") == F.col("f"), "left").withColumn("failed", F.coalesce("failed", F.lit(False)))
    none = F.from_json(F.lit('{"audio_present":false,"technical_ok":false}'), rows.schema["technical"].dataType)
    rows = rows.withColumns({
        "technical": F.when(F.col("failed"), none).otherwise(F.col("technical")), "technical_reasons": F.when(F.col("failed"), F.array(F.lit("unreadable"))).otherwise(F.col("technical_reasons")),
        "extract_errors": F.when(F.col("failed"), F.array(F.lit("processing_error"))).otherwise(F.col("errors")),
        "visual": _filled(F.col("visual"), VISUAL), "vlm": _filled(F.col("vlm"), VLM), "video_text": _filled(F.col("video_text"), VIDEO_TEXT), "audio": _filled(F.col("audio"), AUDIO),
    })
    d = settings.dedup
    groups = annotate(rows.select("clip_idx", "video_id", "embedding"), d.cluster_similarity, d.near_duplicate_similarity, settings.content.cluster_similarity)
    groups = groups.select(F.col("clip_idx").alias("g"), "canonical_id", F.col("content").alias("grouped"), "deduplication")
    rows = rows.join(groups, F.col("clip_idx") == F.col("g"))
    rows = rows.withColumn("content", F.struct("label", F.col("grouped.cluster_id").alias("cluster_id"), F.col("grouped.cluster_size").alias("cluster_size")))
    return apply_policy(rows, settings.policy()).select(*PUBLIC)


def run_folder(spark: SparkSession, folder: str, settings: Settings, backends: Backends, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Records of all clips in a folder, which are also written as reports to the output folder, and the run's summary."""
    guard_output(folder, settings.output_dir)
    clips = identified(clips_only(list_files(spark, folder, settings.recursive), settings.extensions, settings.output_dir), limit)
    records = written(run_batch(clips, settings, backends), "records")
    write_reports(records, settings.output_dir)
    return records, run_summary(records)
