"""The acceptance policy: an ordered list of reason codes, never a blended score. A metric that wasn't measured rejects nothing unless it is required."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions.probe import codes


@dataclass(frozen=True)
class FilterPolicy:
    """Thresholds; None switches a rule off."""

    min_aesthetic: float | None = 0.2
    max_watermark: float | None = 0.95
    max_text_area: float | None = 0.85
    require_visual: bool = False
    min_semantic_consistency: float | None = None
    min_temporal_coverage: float | None = None
    min_completeness: float | None = None
    max_hallucination: float | None = None
    require_vlm: bool = False
    min_video_text_cosine: float | None = None
    require_video_text: bool = False
    max_silence_ratio: float | None = 0.95
    min_rms: float | None = None
    max_clipping_ratio: float | None = 0.02
    reject_near_duplicates: bool = False
    reject_labels: tuple[str, ...] = ()
    require_content: bool = False


def _below(x: Column, least: float) -> Column:
    return ~F.isnan(x) & (x < least)


def _above(x: Column, most: float) -> Column:
    return ~F.isnan(x) & (x > most)


def rules(p: FilterPolicy) -> list[tuple[str, Column]]:
    """Codes and conditions in output order on a record's blocks; rules that are off are left out of the plan."""
    c = F.col
    sound = c("technical.audio_present")
    limits = [
        ("aesthetic_score_below_threshold", c("visual.aesthetic_score"), p.min_aesthetic, _below, None),
        ("watermark_probability_above_threshold", c("visual.watermark_probability"), p.max_watermark, _above, None),
        ("text_area_ratio_above_threshold", c("visual.text_area_ratio"), p.max_text_area, _above, None),
        ("visual_required_but_missing", c("visual.aesthetic_score").isNull() | c("visual.watermark_probability").isNull() | c("visual.text_area_ratio").isNull(), p.require_visual, None, None),
        ("semantic_consistency_below_threshold", c("vlm.semantic_consistency"), p.min_semantic_consistency, _below, None),
        ("temporal_coverage_below_threshold", c("vlm.temporal_coverage"), p.min_temporal_coverage, _below, None),
        ("completeness_below_threshold", c("vlm.completeness"), p.min_completeness, _below, None),
        ("hallucination_above_threshold", c("vlm.hallucination"), p.max_hallucination, _above, None),
        ("vlm_required_but_missing", c("vlm.caption").isNull(), p.require_vlm, None, None),
        ("video_text_cosine_below_threshold", c("video_text.cosine_similarity"), p.min_video_text_cosine, _below, None),
        ("video_text_required_but_missing", c("video_text.cosine_similarity").isNull(), p.require_video_text, None, None),
        ("silence_ratio_above_threshold", c("audio.silence_ratio"), p.max_silence_ratio, _above, sound),
        ("rms_below_threshold", c("audio.rms"), p.min_rms, _below, sound),
        ("clipping_ratio_above_threshold", c("audio.clipping_ratio"), p.max_clipping_ratio, _above, sound),
        ("near_duplicate", c("deduplication.is_near_duplicate") & (c("video_id") != c("canonical_id")), p.reject_near_duplicates, None, None),
        ("content_label_rejected", c("content.label").isin(*p.reject_labels), bool(p.reject_labels), None, None),
        ("content_required_but_missing", c("content.label").isNull(), p.require_content, None, None),
    ]
    out = []
    for code, x, limit, test, gate in limits:
        if limit is None or limit is False:
            continue
        condition = test(x, limit) if test else x
        out.append((code, condition if gate is None else gate & condition))
    return out


def apply_policy(records: DataFrame, policy: FilterPolicy) -> DataFrame:
    """Adds ``filtering`` (status, reasons) from technical_reasons, extract_errors and the policy's rules."""
    none = F.array().cast("array<string>")
    reasons = F.array_distinct(F.concat(F.coalesce("technical_reasons", none), F.coalesce("extract_errors", none), codes(rules(policy))))
    rows = records.withColumn("_reasons", reasons)
    status = F.when(F.size("_reasons") > 0, "rejected").otherwise("accepted")
    return rows.withColumn("filtering", F.struct(status.alias("status"), F.col("_reasons").alias("reasons"))).drop("_reasons")


def run_summary(records: DataFrame) -> DataFrame:
    """One row: total, accepted, rejected, errors."""
    return records.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("filtering.status") == "accepted").alias("accepted"), F.count_if(F.col("filtering.status") == "rejected").alias("rejected"),
        F.count_if(F.array_contains("filtering.reasons", "processing_error")).alias("errors"),
    )
