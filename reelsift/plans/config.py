"""Configuration from YAML: strict names and types, defaults for what is left out.

Each setting is a line of a table: its kind, its default, and what it must satisfy. The kinds' readers are shared.
"""

from __future__ import annotations

from collections.abc import Callable
from types import SimpleNamespace
from typing import Any

from reelsift.functions.probe import TechnicalPolicy
from reelsift.operators.policy import FilterPolicy
from reelsift.sources.clips import EXTENSIONS, normal_extensions


def _number(v: Any) -> float:
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        raise TypeError("a number")
    return float(v)


def _exactly(kind: type, what: str) -> Callable[[Any], Any]:
    def read(v: Any) -> Any:
        if type(v) is not kind:
            raise TypeError(what)
        return v

    return read


def _texts(v: Any) -> tuple[str, ...]:
    if not isinstance(v, list) or not all(isinstance(x, str) for x in v):
        raise TypeError("a list of texts")
    return tuple(v)


def _labels(v: Any) -> tuple[str, ...]:
    return tuple(x for x in (y.strip().lower() for y in _texts(v)) if x)


def _pairs(v: Any) -> dict[str, str]:
    if not isinstance(v, dict) or not all(isinstance(x, str) for pair in v.items() for x in pair):
        raise TypeError("a mapping of texts")
    return dict(v)


def _maybe(read: Callable[[Any], Any]) -> Callable[[Any], Any]:
    return lambda v: None if v is None else read(v)


WHOLE, FLAG, TEXT = _exactly(int, "a whole number"), _exactly(bool, "true or false"), _exactly(str, "a text")
LIMIT = _maybe(_number)


def _in(*options: str) -> tuple[Callable[[Any], bool], str]:
    return lambda v: v in options, "one of " + ", ".join(options)


def _range(low: float, high: float = float("inf")) -> tuple[Callable[[Any], bool], str]:
    return lambda v: v is None or low <= v <= high, f"from {low} to {high}"


_ABOVE_0 = (lambda v: v > 0, "over 0")
_FILLED = (lambda v: bool(v.strip()), "not blank")
_ANY = (lambda v: True, "")
_DEVICES = _in("auto", "cpu", "cuda", "mps")

#: Names of sections and settings, defaults and limits; users' files have these.
TABLE: dict[str, dict[str, tuple]] = {
    "": {
        "extensions": (_texts, EXTENSIONS, (lambda v: bool(normal_extensions(v)), "not empty")), "recursive": (FLAG, True, _ANY), "output_dir": (TEXT, "reports", _ANY),
        "target_fps": (_number, 24.0, _ABOVE_0), "probe_timeout_sec": (_number, 30.0, _ABOVE_0), "run_heavy_on_technical_fail": (FLAG, False, _ANY),
    },
    "frames": {"count": (WHOLE, 4, _range(1, 64)), "max_side": (WHOLE, 512, _range(32, 2048)), "timeout_sec": (_number, 30.0, _ABOVE_0)},
    "visual": {"backend": (TEXT, "heuristic", _in("heuristic", "qwen_vl"))},
    "qwen": {"model_id": (TEXT, "Qwen/Qwen3-VL-8B-Instruct", _ANY), "device": (TEXT, "auto", _DEVICES), "max_new_tokens": (WHOLE, 256, _range(16))},
    "vlm": {"backend": (TEXT, "off", _in("off", "qwen_vl")), "judge_model_id": (TEXT, "lmms-lab-encoder/LLaVA-OneVision-2-8B-Instruct", _FILLED)},
    "video_text": {
        "backend": (TEXT, "off", _in("off", "internvideo2")), "model_id": (TEXT, "OpenGVLab/InternVideo2-Stage2_1B-224p-f4", _ANY), "device": (TEXT, "auto", _DEVICES),
        "num_frames": (WHOLE, 4, _range(1, 16)), "replace_words": (_pairs, {}, (lambda v: all(x.strip() for x in v), "of words that aren't blank")),
    },
    "dedup": {"embedding": (TEXT, "frame_histogram", _in("frame_histogram", "internvideo2")), "cluster_similarity": (_number, 0.92, _range(-1, 1)), "near_duplicate_similarity": (_number, 0.98, _range(-1, 1))},
    "content": {
        "backend": (TEXT, "off", _in("off", "qwen_vl")), "cluster_similarity": (_number, 0.45, _range(-1, 1)),
        "labels": (_labels, ("person", "hands", "object", "screen", "scene", "text", "animation", "other"), (lambda v: "other" in v and len(set(v)) == len(v), "unique and hold other")),
    },
    "audio": {
        "sample_rate": (WHOLE, 16000, _range(8000)), "max_analyze_sec": (_number, 180.0, _ABOVE_0), "silence_threshold_db": (_number, -40.0, _ANY), "extract_timeout_sec": (_number, 120.0, _ABOVE_0),
        "weight_silence": (_number, 0.45, _range(0)), "weight_energy": (_number, 0.30, _range(0)), "weight_clipping": (_number, 0.25, _range(0)),
    },
    "filtering": {
        "min_duration": (_number, 1.0, _range(0)), "max_duration": (_number, 7200.0, _ANY), "min_fps": (_number, 8.0, _ABOVE_0), "min_width": (WHOLE, 256, _range(1)), "min_height": (WHOLE, 256, _range(1)),
        "allowed_codecs": (_texts, ("h264", "hevc", "vp9", "av1", "mpeg4"), _ANY), "max_av_duration_diff": (LIMIT, 1.0, _range(0)), "require_audio": (FLAG, False, _ANY), "reject_unknown_fps": (FLAG, True, _ANY),
        "min_aesthetic_score": (LIMIT, 0.2, _range(0, 1)), "max_watermark_probability": (LIMIT, 0.95, _range(0, 1)), "max_text_area_ratio": (LIMIT, 0.85, _range(0, 1)),
        "min_semantic_consistency": (LIMIT, None, _range(0, 1)), "min_temporal_coverage": (LIMIT, None, _range(0, 1)), "min_completeness": (LIMIT, None, _range(0, 1)), "max_hallucination": (LIMIT, None, _range(0, 1)),
        "min_video_text_cosine": (LIMIT, None, _range(-1, 1)), "max_silence_ratio": (LIMIT, 0.95, _range(0, 1)), "min_rms": (LIMIT, None, _range(0)), "max_clipping_ratio": (LIMIT, 0.02, _range(0, 1)),
        "reject_near_duplicates": (FLAG, False, _ANY), "reject_labels": (_labels, (), _ANY), "require_content": (FLAG, False, _ANY), "require_visual": (FLAG, False, _ANY), "require_vlm": (FLAG, False, _ANY),
        "require_video_text": (FLAG, False, _ANY),
    },
    "storage": {
        "enabled": (FLAG, False, _ANY), "bucket": (TEXT, "", _ANY), "prefix": (TEXT, "metadata", _ANY), "videos_prefix": (TEXT, "videos", _ANY), "archive": (TEXT, "tar", _in("files", "tar")),
        "endpoint_url": (TEXT, "", _ANY), "region": (TEXT, "", _ANY), "read_videos": (FLAG, False, _ANY),
    },
}


class Settings(SimpleNamespace):
    """All settings: those of no section, and a namespace for each section."""

    def technical(self) -> TechnicalPolicy:
        f = self.filtering
        return TechnicalPolicy(
            f.min_duration, f.max_duration, f.min_width, f.min_height, f.min_fps, f.reject_unknown_fps, tuple(x.lower() for x in f.allowed_codecs), f.require_audio, f.max_av_duration_diff, self.target_fps
        )

    def policy(self) -> FilterPolicy:
        f = self.filtering
        return FilterPolicy(
            f.min_aesthetic_score, f.max_watermark_probability, f.max_text_area_ratio, f.require_visual, f.min_semantic_consistency, f.min_temporal_coverage, f.min_completeness, f.max_hallucination, f.require_vlm,
            f.min_video_text_cosine, f.require_video_text, f.max_silence_ratio, f.min_rms, f.max_clipping_ratio, f.reject_near_duplicates, f.reject_labels, f.require_content,
        )


def load_settings(text: str = "") -> Settings:
    """Settings from YAML text; empty text gives the defaults."""
    import yaml

    return settings_from(yaml.safe_load(text) if text.strip() else {})


def settings_from(data: Any) -> Settings:
    """Settings from a mapping, checked one by one and then together."""
    data = {} if data is None else data
    if not isinstance(data, dict):
        raise ValueError("the settings must be a mapping")
    known = set(TABLE[""]) | set(TABLE) - {""}
    if unknown := sorted(map(str, set(data) - known)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    out = Settings()
    for section, table in TABLE.items():
        given = data.get(section, {}) if section else {k: v for k, v in data.items() if k in table}
        if not isinstance(given, dict):
            raise ValueError(f"{section} must be a mapping")
        if unknown := sorted(map(str, set(given) - set(table))):
            raise ValueError(f"unknown settings in {section}: {', '.join(unknown)}")
        values = {}
        for name, (read, default, (holds, what)) in table.items():
            where = f"{section}.{name}".lstrip(".")
            try:
                values[name] = read(given[name]) if name in given else default
            except TypeError as wrong:
                raise ValueError(f"{where} must be {wrong}") from None
            if not holds(values[name]):
                raise ValueError(f"{where} must be {what}")
        vars(out).update({section: SimpleNamespace(**values)} if section else values)
    return checked(out)


def checked(s: Settings) -> Settings:
    """What settings must satisfy together."""
    f, a, store = s.filtering, s.audio, s.storage
    tests = [
        (f.max_duration > f.min_duration, "filtering.max_duration must be over min_duration"), (a.weight_silence + a.weight_energy + a.weight_clipping > 0, "one weight of audio must be over 0"),
        (set(f.reject_labels) <= set(s.content.labels), "filtering.reject_labels must be in content.labels"),
        (s.vlm.backend == "off" or s.vlm.judge_model_id.strip() != s.qwen.model_id.strip(), "vlm.judge_model_id must not be qwen.model_id"),
        (store.enabled or not store.read_videos, "storage.read_videos needs storage.enabled"), (not store.enabled or bool(store.bucket.strip()), "storage.bucket must not be blank"),
        (not store.enabled or bool(store.videos_prefix.strip()), "storage.videos_prefix must not be blank"),
    ]
    for good, message in tests:
        if not good:
            raise ValueError(message)
    return s
