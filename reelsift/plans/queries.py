"""Registered queries of the engine's own operators, on facts derived from the given tables, with their SQL.

A view is one SQL text that Spark and DuckDB both run; a query applies the engine's operators to it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.functions import audio, captions, probe
from reelsift.functions.numbers import band_score, clamp, positive, positive_int, ratio, weighted_mean
from reelsift.functions.vision import measure_frames
from reelsift.operators.policy import FilterPolicy, apply_policy, run_summary
from reelsift.operators.similarity import annotate, cosine, nearest, norm, similarities, unit
from reelsift.plans.batch import AUDIO, VIDEO_TEXT, VISUAL, VLM, run_batch
from reelsift.plans.config import settings_from
from reelsift.sources.clips import clips_only, identified
from reelsift.sources.media import Backends

#: Facts of clips, with all the gaps and oddities that probes have.
CLIP = """
select p_partkey as clip_idx, concat('v', cast(p_partkey % 997 as string)) as video_id,
  case when p_partkey % 37 = 0 then 0 else p_partkey * 1000 end as size,
  case when p_partkey % 11 = 0 then null else cast(p_partkey % 700 as double) / 8 end as duration,
  case when p_partkey % 5 = 0 then null else cast(p_partkey % 690 as double) / 8 end as audio_duration,
  case when p_partkey % 23 = 0 then null else 64 * (p_size % 20 + 1) end as width,
  36 * (p_size % 20 + 1) as height,
  case when p_partkey % 13 = 0 then null else cast(p_partkey % 60 as double) end as fps,
  case when p_partkey % 29 = 0 then null when p_partkey % 4 = 0 then 'H265' when p_partkey % 4 = 1 then 'avc1' when p_partkey % 4 = 2 then 'vp9' else 'h264' end as codec,
  p_partkey % 5 <> 0 as has_audio
from part
"""

#: The same facts as probe payloads: a cover picture before the video stream, "0/0" rates, numbers as text.
PAYLOAD = f"""
select clip_idx, video_id, size, concat('{{"format":{{"format_name":"mov",', case when duration is null then '' else concat('"duration":"', cast(duration as string), '",') end, '"bit_rate":"N/A"}},"streams":[',
  '{{"codec_type":"video","codec_name":"png","width":1,"height":1,"disposition":{{"attached_pic":1}}}},',
  '{{"codec_type":"video",', case when codec is null then '' else concat('"codec_name":" ', codec, ' ",') end, case when width is null then '' else concat('"width":', cast(width as string), ',') end,
  '"height":"', cast(height as string), '","avg_frame_rate":"', case when fps is null then '0/0' else concat(cast(cast(fps as bigint) * 1000 as string), '/1000') end, '","r_frame_rate":"N/A","disposition":{{"attached_pic":0}}}}',
  case when has_audio then concat(',{{"codec_type":"audio","codec_name":"aac"', case when audio_duration is null then '' else concat(',"duration":"', cast(audio_duration as string), '"') end, '}}') else '' end, ']}}') as payload
from ({CLIP}) clip
"""

#: Metrics of clips, one in seven not measured.
METRIC = """
select o_orderkey as clip_idx, concat('v', cast(o_orderkey % 400 as string)) as video_id, concat('v', cast(o_orderkey % 100 as string)) as canonical_id,
  case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 100 as double) / 100 end as a,
  case when o_orderkey % 7 = 1 then null else cast(o_orderkey % 90 as double) / 100 end as b,
  case when o_orderkey % 7 = 2 then null else cast(o_orderkey % 80 as double) / 100 end as c,
  o_orderkey % 3 = 0 as flag, o_orderkey % 50 = 0 as broken, lower(substr(o_orderpriority, 3)) as label
from orders
"""

_CODEC = "case lower(codec) when 'h265' then 'hevc' when 'avc1' then 'h264' when 'avc' then 'h264' else lower(codec) end"


def _joined(*rules: str) -> str:
    """SQL for the texts that aren't null, joined by a comma in order."""
    return f"concat_ws(',', {', '.join(rules)})"


def _views(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    for name in tables:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(sql)


def _codes(name: str):
    return F.array_join(name, ",")


TECHNICAL = probe.TechnicalPolicy(min_duration=2.0, max_duration=60.0, min_width=256, min_height=200, min_fps=10.0, codecs=("h264", "hevc"), require_audio=True, max_av_duration_diff=1.5)


def probe_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _views(spark, sf_dir, PAYLOAD, "part").withColumn("p", probe.parse_payload(F.col("payload"), F.col("size")))
    names = ("duration_sec", "audio_duration_sec", "width", "height", "fps", "video_codec", "audio_codec", "has_audio", "format_name", "bit_rate", "probe_error")
    return rows.select("clip_idx", *[F.col(f"p.{x}").alias(x) for x in names])


def technical_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _views(spark, sf_dir, PAYLOAD, "part").withColumn("p", probe.parse_payload(F.col("payload"), F.col("size")))
    rows = rows.withColumn("reasons", probe.technical_reasons(F.col("p"), TECHNICAL))
    rows = rows.withColumn("t", probe.technical_block(F.col("p"), F.col("reasons"), TECHNICAL.target_fps))
    names = ("duration", "fps_original", "fps_processed", "codec", "audio_present", "audio_duration", "av_duration_diff", "technical_ok")
    return rows.select("clip_idx", *[F.col(f"t.{x}").alias(x) for x in names], _codes("reasons").alias("reasons"), probe.canonical_codec(F.col("t.codec")).alias("canonical_codec"))


def number_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "select p_partkey, case p_partkey % 8 when 0 then 'N/A' when 1 then '' when 2 then '0/0' when 3 then '1d' when 4 then cast(p_size as string) when 5 then concat(cast(p_size * 5 as string), '/4') when 6 then '-3' else '2.5' end as x from part"
    x = F.col("x")
    return _views(spark, sf_dir, sql, "part").select("p_partkey", positive(x).alias("positive"), positive_int(x).alias("positive_int"), ratio(x).alias("ratio"))


def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _views(spark, sf_dir, CLIP, "part")
    w = probe.audio_window(F.col("duration"), 30.0)
    t = probe.frame_timestamps(F.col("duration"), 4)
    return rows.select("clip_idx", F.size(t).alias("n"), F.get(t, F.lit(0)).alias("first"), F.get(t, F.lit(3)).alias("last"), w["start"].alias("start"), w["length"].alias("length"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _views(spark, sf_dir, METRIC, "orders")
    a, b = F.col("a"), F.col("b")
    return rows.select(
        "clip_idx", audio.silence_score(a).alias("silence"), audio.energy_score(a).alias("energy"), band_score(a, 0.18, 0.82).alias("band"),
        clamp(a * 3 - 1).alias("clamped"), weighted_mean([(a, 0.45), (b, 0.55)]).alias("mean"), captions.unit_score((a * 150).cast("string")).alias("unit"),
    )


POLICY = FilterPolicy(
    min_aesthetic=0.2, max_watermark=0.8, max_text_area=0.7, require_visual=True, min_semantic_consistency=0.1, min_temporal_coverage=0.15, min_completeness=0.05, max_hallucination=0.75,
    require_vlm=True, min_video_text_cosine=0.1, require_video_text=True, max_silence_ratio=0.9, min_rms=0.02, max_clipping_ratio=0.6, reject_labels=("low",), require_content=True, reject_near_duplicates=True,
)


def _records(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.select(
        "clip_idx", "video_id", "canonical_id", F.struct(c("flag").alias("audio_present")).alias("technical"),
        F.struct(c("a").alias("aesthetic_score"), c("b").alias("watermark_probability"), c("c").alias("text_area_ratio")).cast(VISUAL).alias("visual"),
        F.struct(F.when(c("a").isNotNull(), "said"), F.lit(None), F.lit(None), c("b"), c("c"), c("a"), c("b")).cast(VLM).alias("vlm"),
        F.struct(F.lit(None), c("c"), F.lit(None), F.lit(None)).cast(VIDEO_TEXT).alias("video_text"), F.struct(c("a"), c("b"), c("c"), F.lit(None)).cast(AUDIO).alias("audio"),
        F.struct(F.nullif(c("label"), F.lit("urgent")).alias("label")).alias("content"), F.struct(c("flag").alias("is_near_duplicate")).alias("deduplication"),
        F.when(c("broken"), F.array(F.lit("unreadable"))).alias("technical_reasons"), F.when(c("broken"), F.array(F.lit("processing_error"), F.lit("unreadable"))).alias("extract_errors"),
    )


def policy_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_policy(_records(_views(spark, sf_dir, METRIC, "orders")), POLICY)
    return out.select("clip_idx", F.col("filtering.status").alias("status"), _codes("filtering.reasons").alias("reasons"))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(apply_policy(_records(_views(spark, sf_dir, METRIC, "orders")), FilterPolicy(min_aesthetic=0.2, max_watermark=None, max_text_area=None, max_silence_ratio=None, max_clipping_ratio=None)))


def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_policy(_records(_views(spark, sf_dir, METRIC, "orders")), FilterPolicy(min_aesthetic=0.2, max_watermark=0.8, max_text_area=None, max_silence_ratio=None, max_clipping_ratio=None))
    return out.select(F.explode("filtering.reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


#: Rules of the caption query, in order; the second sees what the first made.
WORDS = {"the": "a", "a": "one", "idiot": "$person"}


def caption_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _views(spark, sf_dir, "select doc_id, translate(text, 'áéíóúñüöäßçèêëàâîïôûÁÉÍÓÚÑÜÖÄÇÈÊËÀÂÎÏÔÛ', 'aeiounuoasceeeaaiiouAEIOUNUOACEEEAAIIOU') as text from documents", "documents")
    changed = captions.replace_words(F.col("text"), WORDS)
    return rows.select("doc_id", F.sha2(changed, 256).alias("replaced"), captions.truncate(F.col("text"), 60).alias("short"), F.length(captions.collapse(F.col("text"))).alias("n"))


def labels_and_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _views(spark, sf_dir, """select event_id, concat(' ', upper(event_type), ' ') as raw, concat('Reply: ```json ', props, ' ``` done') as reply, props from events""", "events")
    k = F.try_variant_get(captions.json_object(F.col("reply")), "$.k", "int")
    return rows.select("event_id", captions.content_label(F.col("raw"), ("click", "view", "other")).alias("label"), k.alias("k"), captions.reply_score(F.col("reply"), "k").alias("score"))


def path_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "select concat('d', cast(p_partkey % 7 as string), '/c', cast(p_partkey div 3 as string), case when p_partkey % 5 = 0 then '__x' else '' end, case when p_partkey % 11 = 0 then '.txt' when p_partkey % 2 = 0 then '.MP4' else '.mov' end) as source from part"
    rows = _views(spark, sf_dir, sql, "part").withColumn("path", F.concat(F.lit("/in/"), F.col("source")))
    out = identified(clips_only(rows, output_dir="/in/d6"))
    return out.select("clip_idx", "video_id", "source", captions.object_key(F.lit(" /clips/ "), F.col("video_id")).alias("key"), captions.store_prefix(F.concat(F.lit("s3://b/"), F.col("source"), F.lit("/"))).alias("prefix"))


WAVE = """
select l_suppkey as clip_id, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber) - 1 as i,
  case when l_suppkey % 3 = 0 then l_discount / 20 when l_suppkey % 3 = 1 then l_tax * 12.5 else l_discount * l_tax end as x
from lineitem
"""


def audio_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.analyze(_views(spark, sf_dir, WAVE, "lineitem"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return rows.select(F.col("vec_id").alias("clip_idx"), F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("video_id"), "embedding")


def vector_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir).withColumn("w", F.reverse("embedding"))
    return v.select("clip_idx", F.round(norm(F.col("embedding")), 5).alias("norm"), F.round(cosine(F.col("embedding"), F.col("w")), 5).alias("cosine"), F.round(F.get(unit(F.col("w")), F.lit(0)), 5).alias("first"))


def nearest_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(similarities(_vectors(spark, sf_dir), 2.0)).select("clip_idx", "nearest_idx", F.round("sim", 4).alias("similarity"))


def similarity_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarities(_vectors(spark, sf_dir), 0.42).where("link").select("a", "b", F.round("sim", 4).alias("similarity"))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = annotate(_vectors(spark, sf_dir), 0.42, 0.45, 0.40)
    return out.select("clip_idx", "canonical_id", F.col("content.cluster_id").alias("content_id"), F.col("content.cluster_size").alias("content_size"), F.col("deduplication.cluster_id").alias("cluster_id"), F.col("deduplication.nearest_video_id").alias("nearest"), F.col("deduplication.is_near_duplicate").alias("near"))


def frame_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames drawn from embeddings: 8 x 8 cells of 4 pixels in three channels, two frames for each clip."""
    v = _vectors(spark, sf_dir).withColumn("turned", F.reverse("embedding"))
    cell = "cast(floor(least(255, greatest(0, 128 + 400 * cast({}[cast(i div 128 * 8 + i % 32 div 4 as int)] as double)))) as int)"
    rows = v.select("clip_idx", *[F.expr(f"transform(sequence(0, 1023), i -> {cell.format(x)})").alias(x) for x in ("embedding", "turned")])

    def frame(k: int, red: str, green: str):
        text = F.array_join(F.zip_with(red, green, lambda r, g: F.concat(*[F.lpad(F.hex(x), 2, "0") for x in (r, g, F.floor((r + g) / 2))])), "")
        return F.struct(F.lit(k).alias("frame"), F.lit(32).alias("width"), F.lit(32).alias("height"), F.unhex(text).alias("rgb"))

    found = measure_frames(rows.select(F.col("clip_idx").alias("clip"), F.array(frame(0, "embedding", "turned"), frame(1, "turned", "embedding")).alias("frames")))
    bins = F.get("embedding", F.lit(0)), F.get("embedding", F.lit(24))
    return found.select("clip", "aesthetic_score", "watermark_probability", "text_area_ratio", *[F.bround(x.cast("double"), 4).alias(f"bin{k}") for x, k in zip(bins, (0, 24), strict=True)], "error")


def _number(path: str) -> int:
    return int(path.rsplit("/", 1)[1].split(".")[0])


def _fails(k: int, every: int) -> None:
    if k % every == 0:
        raise RuntimeError("as drawn")


def _drawn_frames(settings):
    def frames(path, times):
        k = _number(path)
        _fails(k, 19)
        return [] if k % 17 == 0 else [np.full((16, 16, 3), (k * 37 % 256, k * 11 % 256, k * 53 % 256), np.uint8)] * len(times)

    return frames


def _drawn_judge(settings):
    def judge(frames, caption):
        k = int(frames[0][0, 0, 0])
        last = "" if k % 13 == 0 else ', "completeness": 0.5'
        return f'Scores: {{"semantic_consistency": {k % 100 / 100}, "temporal_coverage": 50, "hallucination": {k % 10 / 10}{last}}} done'

    return judge


def _drawn_audio(settings):
    def audio(path, start, length):
        k = _number(path)
        _fails(k, 37)
        return np.full(1024, k % 10 / 10)

    return audio


def _drawn_vector(settings):
    def see(path):
        k = _number(path)
        _fails(k, 31)
        return [1.0, k % 3, 0.0]

    return see


#: Tools that draw from a clip's number or first pixel what media and models would give, failures of each kind among it.
DRAWN = Backends(
    frames=_drawn_frames, judge=_drawn_judge, audio=_drawn_audio, see=_drawn_vector, caption=lambda s: lambda f: f"A man \n walks past number {f[0][0, 0, 1] % 5} " if f[0][0, 0, 1] % 23 else " ",
    describe=lambda s: lambda f: "He walks.  He stops.", classify=lambda s: lambda f, labels: '{"label": " Person\\n"}' if f[0][0, 0, 2] % 3 == 0 else '{"label": "nonsense"}' if f[0][0, 0, 2] % 3 == 1 else "none",
    read=lambda s: lambda text: [1.0, 1.0, float(len(text) % 2)],
)
BATCH = {
    "vlm": {"backend": "qwen_vl"}, "content": {"backend": "qwen_vl", "cluster_similarity": 0.9}, "video_text": {"backend": "internvideo2", "replace_words": {"man": "lady"}}, "dedup": {"cluster_similarity": 0.9},
    "filtering": {
        "min_duration": 2.0, "max_duration": 60.0, "min_height": 200, "min_fps": 10.0, "allowed_codecs": ["h264", "hevc"], "require_audio": True, "max_av_duration_diff": 1.5, "min_semantic_consistency": 0.3,
        "max_hallucination": 0.7, "min_video_text_cosine": 0.6, "require_vlm": True, "require_video_text": True, "reject_near_duplicates": True, "reject_labels": ["person"], "require_content": True,
    },
}


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch, from payloads to filtered records, with drawn media and models."""
    clips = _views(spark, sf_dir, PAYLOAD, "part").select("clip_idx", F.format_string("c%08d", "clip_idx").alias("video_id"), F.concat("clip_idx", F.lit(".mp4")).alias("source"), F.concat(F.lit("/in/"), "clip_idx", F.lit(".mp4")).alias("path"), F.col("size").alias("length"), "payload")
    out = run_batch(clips, settings_from(BATCH), DRAWN)
    return out.select(
        "video_id", "source", F.col("technical.technical_ok").alias("ok"), F.col("visual.aesthetic_score").alias("aesthetic"), F.col("vlm.judge_caption").alias("judge_caption"), F.col("vlm.hallucination").alias("hallucination"),
        F.col("video_text.cosine_similarity").alias("cosine"), F.col("video_text.caption_replaced").alias("replaced"), F.col("video_text.cosine_similarity_replaced").alias("cosine_replaced"), F.col("audio.rms").alias("rms"),
        F.col("audio.audio_quality").alias("audio_quality"), F.col("content.label").alias("label"), F.col("content.cluster_size").alias("size"), F.col("deduplication.is_near_duplicate").alias("near"),
        F.col("deduplication.nearest_video_id").alias("nearest"), F.col("filtering.status").alias("status"), _codes("filtering.reasons").alias("reasons"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (probe_fields, technical_rules, number_guards, timestamps, scores, policy_reasons, summary, reason_counts, caption_words, labels_and_replies, path_ids, audio_metrics, vector_math, nearest_clips, similarity_links, clusters, frame_metrics, batch)
}

_REASONS = f"""case when size <= 0 then 'unreadable' when codec is null or width is null then 'no_video_stream' else {_joined(
    "case when not coalesce(duration > 0, false) then 'duration_unknown' when duration < 2 then 'duration_too_short' when duration > 60 then 'duration_too_long' end",
    "case when width < 256 or height < 200 then 'resolution_too_small' end", "case when not coalesce(fps > 0, false) then 'fps_unknown' when fps < 10 then 'fps_too_low' end",
    f"case when {_CODEC} not in ('h264', 'hevc') then 'codec_not_allowed' end", "case when not has_audio then 'audio_required_but_missing' end",
    "case when has_audio and duration > 0 and audio_duration > 0 and abs(duration - audio_duration) > 1.5 then 'av_duration_mismatch' end",
)} end"""
_POS = "select clip_idx, video_id, size, case when duration > 0 then duration end as duration, case when audio_duration > 0 and has_audio then audio_duration end as audio_duration, width, height, case when fps > 0 then fps end as fps, codec, has_audio from"
_POLICY = _joined(
    "case when broken then 'unreadable' end", "case when broken then 'processing_error' end", "case when a < 0.2 then 'aesthetic_score_below_threshold' end", "case when b > 0.8 then 'watermark_probability_above_threshold' end",
    "case when c > 0.7 then 'text_area_ratio_above_threshold' end", "case when a is null or b is null or c is null then 'visual_required_but_missing' end", "case when b < 0.1 then 'semantic_consistency_below_threshold' end",
    "case when c < 0.15 then 'temporal_coverage_below_threshold' end", "case when a < 0.05 then 'completeness_below_threshold' end", "case when b > 0.75 then 'hallucination_above_threshold' end", "case when a is null then 'vlm_required_but_missing' end",
    "case when c < 0.1 then 'video_text_cosine_below_threshold' end", "case when c is null then 'video_text_required_but_missing' end", "case when flag and a > 0.9 then 'silence_ratio_above_threshold' end", "case when flag and b < 0.02 then 'rms_below_threshold' end",
    "case when flag and c > 0.6 then 'clipping_ratio_above_threshold' end", "case when flag and video_id <> canonical_id then 'near_duplicate' end", "case when nullif(label, 'urgent') = 'low' then 'content_label_rejected' end", "case when nullif(label, 'urgent') is null then 'content_required_but_missing' end",
)
_CLAMP = "greatest(0.0, least(1.0, {}))"
_ENERGY = f"case when rms <= 0 then 0.0 when rms < 0.005 then {_CLAMP.format('rms / 0.005')} * 0.5 when rms < 0.02 then 0.5 + 0.5 * (rms - 0.005) / 0.015 when rms <= 0.3 then 1.0 else {_CLAMP.format('1 - (rms - 0.3) / 0.7')} end"
_SILENCE = f"case when silence <= 0.25 then 1.0 else {_CLAMP.format('(0.95 - silence) / 0.7')} end"
_LINKS = "select x.vec_id as a, y.vec_id as b, list_dot_product(x.embedding::double[], y.embedding::double[]) as sim from embeddings x join embeddings y on x.vec_id <> y.vec_id"


def _roots(name: str, least: float) -> str:
    """Each row's least connected id, by walking links from every row."""
    return f"""{name}_walk as (select vec_id as clip, vec_id as seen from embeddings union select w.clip, l.b from {name}_walk w join links l on w.seen = l.a where l.sim >= {least}),
      {name} as (select clip, min(seen) as root from {name}_walk group by clip), {name}_size as (select root, count(*) as n, dense_rank() over (order by root) - 1 as id from {name} group by root)"""


#: The frames of ``frame_metrics`` as pixels, and each metric from its definition.
_FRAMES = """
with e as (select vec_id as clip, embedding as a, list_reverse(embedding) as b from embeddings),
g as (select unnest(range(0, 1024)) as i), f as (select unnest([0, 1]) as k),
v as (
  select clip, k, i // 32 as y, i % 32 as x, floor(least(255, greatest(0, 128 + 400 * (a[i // 128 * 8 + i % 32 // 4 + 1])::double)))::int as va,
    floor(least(255, greatest(0, 128 + 400 * (b[i // 128 * 8 + i % 32 // 4 + 1])::double)))::int as vb from e, g, f
),
p as (select clip, k, y, x, case k when 0 then va else vb end as r, case k when 0 then vb else va end as g, (va + vb) // 2 as b from v),
l as (select *, 0.299::float * r::float + 0.587::float * g::float + 0.114::float * b::float as l, r - g as rg, (r + g) / 2.0 - b as yb from p),
n as (
  select *, abs(lead(l) over (partition by clip, k, y order by x) - l) as step,
    coalesce(lag(l) over (partition by clip, k, y order by x), l) + coalesce(lead(l) over (partition by clip, k, y order by x), l)
    + coalesce(lag(l) over (partition by clip, k, x order by y), l) + coalesce(lead(l) over (partition by clip, k, x order by y), l) - 4 * l as bend from l
),
t as (select *, avg((step >= 25)::int) over (partition by clip, k, y) as share, max((step >= 25)::int) over (partition by clip, k, y order by x rows between 10 preceding and 10 following) as near from n),
c as (
  select clip, k, 1 - exp(-(sqrt(var_pop(rg) + var_pop(yb)) + 0.3 * sqrt(avg(rg) ** 2 + avg(yb) ** 2)) / 40) as color, greatest(0, least(1, (stddev_pop(l) - 8) / 40)) as contrast,
    1 - exp(-var_pop(bend) / 400) as sharp, greatest(0, least(1, least(avg(l) / 255 / 0.18, (1 - avg(l) / 255) / 0.18))) as exposure,
    sum(case when x < 31 and share > 0.05 and share < 0.35 then near else 0 end) / (32.0 * 31) as text,
    greatest(avg((step >= 20)::int) filter (y < 6 and x < 5), avg((step >= 20)::int) filter (y < 6 and x between 26 and 30), avg((step >= 20)::int) filter (y > 25 and x < 5), avg((step >= 20)::int) filter (y > 25 and x between 26 and 30)) as most,
    avg((step >= 20)::int) filter (y between 10 and 20 and x between 10 and 19) as middle from t group by clip, k
),
m as (select a.clip, avg(abs(a.l - b.l)) / 255 as move from l a join l b on a.clip = b.clip and a.k = 0 and b.k = 1 and a.y = b.y and a.x = b.x where (a.y < 6 or a.y > 25) and (a.x < 6 or a.x > 25) group by a.clip),
h as (select clip, ch, least(15, val * 16 // 255) as bin, count(*) as n from (select clip, unnest([0, 1, 2]) as ch, unnest([r, g, b]) as val from p where x % 8 = 0 and y % 8 = 0) z group by clip, ch, bin),
w as (select clip, sqrt(sum(n * n)) as len, coalesce(sum(n) filter (ch = 0 and bin = 0), 0) as b0, coalesce(sum(n) filter (ch = 1 and bin = 8), 0) as b24 from h group by clip)
select c.clip, round_even(avg(greatest(0, least(1, 0.35 * color + 0.25 * contrast + 0.2 * sharp + 0.2 * exposure))), 4)::double as aesthetic_score,
  round_even(avg(case when most < 0.02 then 0 else greatest(0, least(1, (most - middle) / most)) end) * (0.35 + 0.65 * greatest(0, least(1, 1 - any_value(move) / 0.12))), 4)::double as watermark_probability,
  round_even(avg(text), 4)::double as text_area_ratio, round_even(any_value(b0 / len), 4)::double as bin0, round_even(any_value(b24 / len), 4)::double as bin24, null::varchar as error
from c join m on m.clip = c.clip join w on w.clip = c.clip group by c.clip
"""

#: The whole batch from the clips' facts and the drawn tools' rules.
_BATCH = f"""
with c as (select * from ({_POS} ({CLIP}) x) y),
t as (select *, {_REASONS} as technical, not (size <= 0 or codec is null or width is null) and duration is not null as usable from c),
f as (select *, usable and clip_idx % 19 <> 0 and clip_idx % 17 <> 0 as seen, technical = '' as ok, clip_idx * 37 % 256 as r, clip_idx * 11 % 256 as g, clip_idx * 53 % 256 as b from t),
v as (
  select *, case when seen then 0.35 * (1 - exp(-0.3 * sqrt((r - g) ** 2 + ((r + g) / 2.0 - b) ** 2) / 40))
    + 0.2 * greatest(0, least(1, least((0.299 * r + 0.587 * g + 0.114 * b) / 255 / 0.18, (1 - (0.299 * r + 0.587 * g + 0.114 * b) / 255) / 0.18))) end as score,
    seen and ok and g % 23 <> 0 as told, least(15, r * 16 // 255) * 256 + least(15, g * 16 // 255) * 16 + least(15, b * 16 // 255) as hist from f
),
j as (select *, told and r % 13 <> 0 as judged, case when seen and ok and b % 3 = 0 then 'person' when seen and ok and b % 3 = 1 then 'other' end as label, told and clip_idx % 31 <> 0 as aligned, usable and has_audio and clip_idx % 37 <> 0 as heard, clip_idx % 10 / 10.0 as amp from v),
q as (
  select *, case when aligned then (1 + clip_idx % 3) / (sqrt(1 + (clip_idx % 3) ** 2) * sqrt(3)) end as cosine, case when aligned then (1 + clip_idx % 3) / (sqrt(1 + (clip_idx % 3) ** 2) * sqrt(2)) end as cosine2, case when heard then amp * sqrt(0.5) end as rms from j
),
n as (select clip_idx, count(*) over (partition by hist) as n, min(clip_idx) over (partition by hist) as least_, lead(clip_idx) over (partition by hist order by clip_idx) as next_ from v where seen),
s as (
  select a.clip_idx, arg_min(b.clip_idx, {{'d': -((a.hist // 256 = b.hist // 256)::int + (a.hist // 16 % 16 = b.hist // 16 % 16)::int + (a.hist % 16 = b.hist % 16)::int), 'i': b.clip_idx}}) as near
  from (select * from v where seen) a join (select * from v where seen) b on a.clip_idx <> b.clip_idx group by a.clip_idx
)
select format('c{{:08d}}', q.clip_idx) as video_id, q.clip_idx::varchar || '.mp4' as source, ok, round_even(score, 4)::double as aesthetic, case when judged then 'He walks. He stops.' end as judge_caption,
  case when judged then r % 10 / 10.0 end::double as hallucination, round_even(cosine, 4)::double as cosine, case when aligned then 'A lady walks past number ' || (g % 5) end as replaced, round_even(cosine2, 4)::double as cosine_replaced,
  round_even(rms, 6)::double as rms, case when heard then round_even(0.45 * (case when amp = 0 then 0 else 1 end) + 0.3 * (case when rms <= 0 then 0 when rms <= 0.3 then 1 else 1 - (rms - 0.3) / 0.7 end) + 0.25, 4) end::double as audio_quality,
  label, coalesce(n, 1)::int as size, coalesce(n > 1, false) as near, case when s.near is not null then format('c{{:08d}}', s.near) end as nearest, case when reasons = '' then 'accepted' else 'rejected' end as status, reasons
from (select *, {_joined(
    "nullif(technical, '')", "case when usable and not seen then 'frame_extraction_failed' end", "case when seen and ok and not judged then 'vlm_failed' end", "case when seen and ok and b % 3 = 2 then 'content_classification_failed' end",
    "case when usable and ok and clip_idx % 31 = 0 then 'video_text_failed' end", "case when usable and has_audio and not heard then 'audio_analysis_failed' end", "case when round_even(score, 4) < 0.2 then 'aesthetic_score_below_threshold' end",
    "case when judged and r % 100 / 100.0 < 0.3 then 'semantic_consistency_below_threshold' end", "case when judged and r % 10 / 10.0 > 0.7 then 'hallucination_above_threshold' end", "case when not told then 'vlm_required_but_missing' end",
    "case when round_even(cosine, 4) < 0.6 then 'video_text_cosine_below_threshold' end", "case when cosine is null then 'video_text_required_but_missing' end", "case when heard and amp = 0 then 'silence_ratio_above_threshold' end",
    "case when seen and clip_idx > (select least_ from n where n.clip_idx = q.clip_idx) then 'near_duplicate' end", "case when label = 'person' then 'content_label_rejected' end", "case when label is null then 'content_required_but_missing' end",
)} as reasons from q) q left join n on n.clip_idx = q.clip_idx left join s on s.clip_idx = q.clip_idx
"""

ORACLE_SQL: dict[str, str] = {
    "probe_fields": f"select clip_idx, duration as duration_sec, audio_duration as audio_duration_sec, cast(width as int) as width, cast(height as int) as height, fps, codec as video_codec, case when has_audio then 'aac' end as audio_codec, has_audio, 'mov' as format_name, cast(null as bigint) as bit_rate, cast(null as string) as probe_error from ({_POS} ({CLIP}) x) y",
    "technical_rules": f"select clip_idx, round_even(duration, 3) as duration, round_even(fps, 3) as fps_original, case when fps is not null then least(round_even(fps, 3), 24.0) end::double as fps_processed, {_CODEC} as codec, has_audio as audio_present, round_even(audio_duration, 3) as audio_duration, round_even(abs(duration - audio_duration), 3) as av_duration_diff, {_REASONS} = '' as technical_ok, {_REASONS} as reasons, {_CODEC} as canonical_codec from ({_POS} ({CLIP}) x) y",
    "number_guards": "select p_partkey, case p_partkey % 8 when 4 then p_size when 7 then 2.5 end::double as positive, case p_partkey % 8 when 4 then p_size when 7 then 2 end::bigint as positive_int, case p_partkey % 8 when 4 then p_size when 5 then p_size * 5 / 4 when 6 then -3 when 7 then 2.5 end::double as ratio from part",
    "timestamps": f"select clip_idx, case when duration > 0 then 4 else 0 end::int as n, case when duration > 0 then least(0.05, duration * 0.05) end::double as first, case when duration > 0 then least(0.05, duration * 0.05) + 3 * ((duration - 2 * least(0.05, duration * 0.05)) / 3) end::double as last, case when duration > 30 then (duration - 30) / 2 else 0 end::double as start, case when duration is null then 30 else least(30, duration) end::double as length from ({CLIP}) x",
    "scores": f"select clip_idx, case when a is null then null else {_SILENCE} end::double as silence, case when a is null then null else {_ENERGY} end::double as energy, case when a < 0.18 then a / 0.18 when a > 0.82 then (1.0 - a) / (1.0 - 0.82::double) when a is not null then 1 end::double as band, case when a is not null then {_CLAMP.format('a * 3 - 1')} end::double as clamped, 0.0::double + a * 0.45::double + b * 0.55::double as mean, case when a * 150 > 1 then case when a * 150 / 100 <= 1 then a * 150 / 100 end else a * 150 end::double as unit from (select *, a as silence, a as rms from ({METRIC}) x) y",
    "policy_reasons": f"select clip_idx, case when reasons = '' then 'accepted' else 'rejected' end as status, reasons from (select clip_idx, {_POLICY} as reasons from ({METRIC}) x) y",
    "summary": f"select count(*) as total, count(*) filter (not bad) as accepted, count(*) filter (bad) as rejected, count(*) filter (broken) as errors from (select broken, broken or coalesce(a < 0.2, false) as bad from ({METRIC}) x) y",
    "reason_counts": f"select reason, count(*) as n from (select unnest([case when broken then 'unreadable' end, case when broken then 'processing_error' end, case when a < 0.2 then 'aesthetic_score_below_threshold' end, case when b > 0.8 then 'watermark_probability_above_threshold' end]) as reason from ({METRIC}) x) y where reason is not null group by reason",
    "caption_words": r"with d as (select doc_id, translate(text, 'áéíóúñüöäßçèêëàâîïôûÁÉÍÓÚÑÜÖÄÇÈÊËÀÂÎÏÔÛ', 'aeiounuoasceeeaaiiouAEIOUNUOACEEEAAIIOU') as text from documents), e as (select *, trim(regexp_replace(text, '\s+', ' ', 'g')) as c from d) select doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(text, '\bthe\b', 'a', 'gi'), '\ba\b', 'one', 'gi'), '\bidiot\b', '$person', 'gi')) as replaced, case when length(c) <= 60 then c else left(c, 57) || '...' end as short, length(c)::int as n from e",
    "labels_and_replies": "select event_id, case when event_type in ('click', 'view', 'other') then event_type else 'other' end as label, json_extract(props, '$.k')::int as k, case when json_extract(props, '$.k')::double > 1 then case when json_extract(props, '$.k')::double <= 100 then json_extract(props, '$.k')::double / 100 end else json_extract(props, '$.k')::double end as score from events",
    "path_ids": """
        with s as (
          select concat('d', cast(p_partkey % 7 as string), '/c', cast(p_partkey // 3 as string), case when p_partkey % 5 = 0 then '__x' else '' end,
            case when p_partkey % 11 = 0 then '.txt' when p_partkey % 2 = 0 then '.MP4' else '.mov' end) as source from part
        ), k as (
          select source, split_part(split_part(source, '/', 2), '.', 1) as stem, split_part(source, '.', 1) as bare from s where source not like '%.txt' and source not like 'd6/%'
        ), n as (
          select *, count(*) over (partition by stem) as same, row_number() over (order by string_split(source, '/')) - 1 as clip_idx from k
        ), i as (select *, case when same > 1 then replace(bare, '/', '__') else stem end as id from n)
        select clip_idx, id as video_id, source, 'clips/' || id as key, source as prefix from i""",
    "audio_metrics": f"with w as ({WAVE}), n as (select clip_id, count(*) as n, avg(case when abs(x) >= 0.999 then 1 else 0 end) as clipping from w group by clip_id), e as (select clip_id, i, x from w union all select clip_id, n, 0.0 from n where n % 512 = 0), f as (select clip_id, i, sqrt(sum(x * x) over (partition by clip_id order by i range between 1024 preceding and 1023 following) / 2048) as e from e), m as (select f.clip_id, avg(case when e < 0.01 then 1 else 0 end) as silence, avg(e) as rms, any_value(clipping) as clipping from f join n using (clip_id) where i % 512 = 0 group by f.clip_id) select clip_id, round_even(silence, 4) as silence_ratio, round_even(rms, 6) as rms, round_even(clipping, 6) as clipping_ratio, round(({_SILENCE}) * 0.45 + ({_ENERGY}) * 0.3 + (1 - {_CLAMP.format('clipping / 0.01')}) * 0.25, 4) as audio_quality from m",
    "vector_math": "with v as (select vec_id, embedding::double[] as e, list_reverse(embedding)::double[] as w from embeddings) select vec_id as clip_idx, round(sqrt(list_dot_product(e, e)), 5) as norm, round(list_dot_product(e, w) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(w, w))), 5) as cosine, round(w[1] / sqrt(list_dot_product(w, w)), 5) as first from v",
    "nearest_clips": f"with links as ({_LINKS}), r as (select *, row_number() over (partition by a order by sim desc, b) as k from links) select a as clip_idx, b as nearest_idx, round(sim, 4) as similarity from r where k = 1",
    "similarity_links": f"select a, b, round(sim, 4) as similarity from ({_LINKS}) x where a < b and sim >= 0.42",
    "clusters": f"with recursive links as materialized ({_LINKS}), {_roots('content', 0.40)}, {_roots('clus', 0.42)}, {_roots('near', 0.45)}, best as (select a, b, sim, row_number() over (partition by a order by sim desc, b) as k from links) select e.vec_id as clip_idx, min('v' || e.vec_id::string) over (partition by near.root) as canonical_id, cs.id::int as content_id, cs.n::int as content_size, us.id::int as cluster_id, 'v' || best.b::string as nearest, best.sim >= 0.45 as near from embeddings e join content on content.clip = e.vec_id join content_size cs on cs.root = content.root join clus on clus.clip = e.vec_id join clus_size us on us.root = clus.root join near on near.clip = e.vec_id join best on best.a = e.vec_id and best.k = 1",
    "frame_metrics": _FRAMES,
    "batch": _BATCH,
}
