"""Probe payloads (container and stream facts as JSON) as columns, and the technical block with its reason codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelsift.functions.numbers import positive, positive_int, ratio, rounded, stripped

_STREAM = "codec_type string, codec_name string, width string, height string, avg_frame_rate string, r_frame_rate string, nb_frames string, duration string, pix_fmt string"
PAYLOAD = f"format struct<duration:string, format_name:string, bit_rate:string>, streams array<struct<{_STREAM.replace(' string', ':string')}, disposition:struct<attached_pic:string>>>"
#: Other names of codecs.
CODECS = {"h265": "hevc", "avc": "h264", "avc1": "h264"}


@dataclass(frozen=True)
class TechnicalPolicy:
    min_duration: float = 1.0
    max_duration: float = 7200.0
    min_width: int = 256
    min_height: int = 256
    min_fps: float = 8.0
    reject_unknown_fps: bool = True
    codecs: tuple[str, ...] = ("h264", "hevc", "vp9", "av1", "mpeg4")
    require_audio: bool = False
    max_av_duration_diff: float | None = 1.0
    target_fps: float = 24.0


def parse_payload(payload: Column, size: Column) -> Column:
    """A struct of the facts of one clip; a payload that is no JSON object gives ``probe_error``."""
    p = F.from_json(payload, PAYLOAD)
    streams = F.coalesce(p["streams"], F.array().cast("array<struct<%s,disposition:struct<attached_pic:string>>>" % _STREAM.replace(" string", ":string")))
    videos = F.filter(streams, lambda s: s["codec_type"] == "video")
    shown = F.filter(videos, lambda s: F.coalesce(s["disposition"]["attached_pic"], F.lit("0")).isin("0", "false"))
    video = F.coalesce(F.get(shown, F.lit(0)), F.get(videos, F.lit(0)))
    audio = F.get(F.filter(streams, lambda s: s["codec_type"] == "audio"), F.lit(0))
    duration = F.coalesce(positive(p["format"]["duration"]), positive(video["duration"]))
    rate = lambda x: F.when(ratio(x) > 0, ratio(x))
    fps = F.coalesce(rate(video["avg_frame_rate"]), rate(video["r_frame_rate"]), positive(video["nb_frames"]) / duration)
    # one whole object: keys may come again, and white space may be round it
    whole = payload.rlike(r"(?s)^\s*\{.*\}\s*$") & F.json_object_keys(payload).isNotNull()
    return F.struct(
        size.cast("long").alias("file_size_bytes"), duration.alias("duration_sec"), positive(audio["duration"]).alias("audio_duration_sec"),
        positive_int(video["width"]).cast("int").alias("width"), positive_int(video["height"]).cast("int").alias("height"), fps.alias("fps"),
        stripped(video["codec_name"]).alias("video_codec"), stripped(audio["codec_name"]).alias("audio_codec"), audio.isNotNull().alias("has_audio"),
        stripped(p["format"]["format_name"]).alias("format_name"), positive_int(p["format"]["bit_rate"]).alias("bit_rate"), stripped(video["pix_fmt"]).alias("pixel_format"),
        F.when(F.coalesce(~whole, F.lit(True)), "unreadable payload").alias("probe_error"),
    )


def canonical_codec(codec: Column) -> Column:
    out = F.lower(codec)
    for name, same in CODECS.items():
        out = F.when(F.lower(codec) == name, same).otherwise(out)
    return out


def processed_fps(fps: Column, target: float) -> Column:
    """Never above the source's own rate; unknown stays unknown."""
    return F.when(fps.isNotNull(), F.least(fps, F.lit(target)))


def technical_block(p: Column, reasons: Column, target_fps: float) -> Column:
    audio = F.when(p["has_audio"], p["audio_duration_sec"])
    return F.struct(
        rounded(p["duration_sec"], 3).alias("duration"), rounded(p["fps"], 3).alias("fps_original"), rounded(processed_fps(p["fps"], target_fps), 3).alias("fps_processed"),
        p["width"].alias("width"), p["height"].alias("height"), canonical_codec(p["video_codec"]).alias("codec"), p["has_audio"].alias("audio_present"),
        rounded(audio, 3).alias("audio_duration"), rounded(F.abs(p["duration_sec"] - audio), 3).alias("av_duration_diff"), (F.size(reasons) == 0).alias("technical_ok"),
    )


def codes(rules: list[tuple[str, Column]]) -> Column:
    """The codes whose condition is true, in order, each once."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_distinct(F.array_compact(F.array(*[F.when(rule, code) for code, rule in rules])))


def technical_reasons(p: Column, policy: TechnicalPolicy) -> Column:
    """Reason codes of the technical rules on unrounded facts; an unreadable clip, or one without video, has that code alone."""
    d, fps, codec = p["duration_sec"], p["fps"], canonical_codec(p["video_codec"])
    unreadable = (F.coalesce(p["file_size_bytes"], F.lit(0)) <= 0) | (F.coalesce(p["probe_error"], F.lit("")) != "")
    no_video = p["video_codec"].isNull() | p["width"].isNull() | p["height"].isNull()
    rules = [
        ("duration_unknown", d.isNull()), ("duration_too_short", d < policy.min_duration), ("duration_too_long", (d >= policy.min_duration) & (d > policy.max_duration)),
        ("resolution_too_small", (p["width"] < policy.min_width) | (p["height"] < policy.min_height)),
    ]
    if policy.reject_unknown_fps:
        rules.append(("fps_unknown", fps.isNull()))
    rules.append(("fps_too_low", fps < policy.min_fps))
    if policy.codecs:
        rules.append(("codec_not_allowed", ~codec.isin(*[CODECS.get(c.lower(), c.lower()) for c in policy.codecs])))
    if policy.require_audio:
        rules.append(("audio_required_but_missing", ~p["has_audio"]))
    if policy.max_av_duration_diff is not None:
        rules.append(("av_duration_mismatch", p["has_audio"] & (F.abs(d - p["audio_duration_sec"]) > policy.max_av_duration_diff)))
    return F.when(unreadable, F.array(F.lit("unreadable"))).when(no_video, F.array(F.lit("no_video_stream"))).otherwise(codes(rules))


def frame_timestamps(duration: Column, count: int) -> Column:
    """``count`` times spread evenly over the clip without its edges; one in the middle where that can't be."""
    margin = F.least(F.lit(0.05), duration * 0.05)
    step = (duration - 2 * margin) / max(1, count - 1)
    spread = F.transform(F.sequence(F.lit(0), F.lit(max(0, count - 1))), lambda i: margin + i * step)
    none = F.array().cast("array<double>")
    if count < 1:
        return none
    return F.when((duration <= 0) | duration.isNull(), none).when(F.lit(count == 1) | (step <= 0), F.array(duration / 2)).otherwise(spread)


def audio_window(duration: Column, most: float) -> Column:
    """Start and length of the centred part that is analysed."""
    return F.struct(F.when(duration > most, F.greatest(F.lit(0.0), (duration - most) / 2)).otherwise(0.0).alias("start"), F.least(F.lit(float(most)), duration).alias("length"))
