"""Facts that need a clip's media: frames, models and audio are read and measured where the clip's row is.

One Python stage does all of it, so frames and samples are never shuffled. A failure of one step is a code of its clip;
one that no step expects makes the whole clip a failed record.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from reelsift.functions import audio, vision
from reelsift.sources.media import Backends

#: Scores of a judge's and of a rater's reply.
JUDGED = ("semantic_consistency", "temporal_coverage", "completeness", "hallucination")
RATED = ("aesthetic_score", "watermark_probability", "text_area_ratio")
#: The name of the model of video and text vectors.
VECTOR_MODEL = "InternVideo2"
_TEXT, _DOUBLE = "string", "double"
FACTS = (
    "clip_idx long, visual struct<" + ",".join(f"{x}:double" for x in RATED) + ">, embedding array<float>, vlm struct<caption:string,judge_model:string,judge_caption:string," + ",".join(f"{x}:double" for x in JUDGED) + ">, "
    "video_text struct<model:string,cosine_similarity:double,caption_replaced:string,cosine_similarity_replaced:double>, audio struct<silence_ratio:double,rms:double,clipping_ratio:double,audio_quality:double>, "
    "label string, errors array<string>, failed boolean"
)


def reply_object(reply: str) -> dict:
    """The JSON object between the first and the last brace of a model's reply."""
    start, end = reply.find("{"), reply.rfind("}")
    if start < 0 or end < start:
        raise ValueError("no object in the reply")
    found = json.loads(reply[start : end + 1])
    if not isinstance(found, dict):
        raise ValueError("no object in the reply")
    return found


def reply_scores(reply: str, names: tuple[str, ...]) -> dict[str, float]:
    """All of the scores, from 0 to 1 or in percent; a missing or wrong one fails the reply as a whole."""
    found, out = reply_object(reply), {}
    for name in names:
        score = float(found[name])
        score = score / 100 if score > 1 else score
        if not 0 <= score <= 1:
            raise ValueError(f"{name} is not from 0 to 1")
        out[name] = score
    return out


def _one_line(text: str) -> str:
    text = " ".join(text.split())
    if not text:
        raise ValueError("an empty text")
    return text


def vector_cosine(a, b) -> float:
    x, y = (np.asarray(v, np.float32).ravel() for v in (a, b))
    if x.shape != y.shape or not x.size or not x.any() or not y.any():
        raise ValueError("vectors of unequal length, or a zero vector")
    return float(x / np.linalg.norm(x) @ (y / np.linalg.norm(y)))


class Clip:
    """The steps on one clip; each leaves its facts or its code."""

    def __init__(self, row, tools: SimpleNamespace, settings, replaced: Callable[[str], str]):
        self.row, self.tools, self.settings, self.replaced = row, tools, settings, replaced
        self.errors: list[str] = []
        self.visual = self.embedding = self.vlm = self.video_text = self.audio = self.label = None

    def step(self, code: str, work: Callable[[], object]):
        try:
            return work()
        except Exception:  # the contract: a step's failure is a code of its clip, and the batch goes on
            if code not in self.errors:
                self.errors.append(code)
            return None

    def run(self) -> Clip:
        s, tools, row = self.settings, self.tools, self.row
        heavy = row.technical_ok or s.run_heavy_on_technical_fail
        frames = []
        if tools.frames:
            frames = self.step("frame_extraction_failed", lambda: [vision.rgb(np.asarray(x)) for x in tools.frames(row.path, list(row.times))]) or []
            if not frames and not self.errors:
                self.errors.append("frame_extraction_failed")
        if frames:
            self.step("visual_extraction_failed", lambda: self.see_frames(frames))
            if heavy and s.vlm.backend != "off" and tools.caption and tools.judge:
                self.step("vlm_failed", lambda: self.caption(frames))
            if heavy and s.content.backend != "off" and tools.classify:
                self.step("content_classification_failed", lambda: self.classify(frames))
        wanted = s.video_text.backend != "off" or s.dedup.embedding != "frame_histogram"
        if heavy and wanted and tools.see:
            self.step("video_text_failed", self.align)
        if row.has_audio and tools.audio:
            self.step("audio_analysis_failed", lambda: self.hear(row.start, row.length))
        return self

    def see_frames(self, frames: list[np.ndarray]) -> None:
        if self.settings.dedup.embedding == "frame_histogram":
            self.embedding = vision.histogram(frames).tolist()
        if self.settings.visual.backend == "heuristic" or not self.tools.rate:
            score, mark, text = vision.measured(frames)
            self.visual = {"aesthetic_score": round(score, 4), "watermark_probability": round(mark, 4), "text_area_ratio": round(text, 4)}
        else:
            each = [reply_scores(self.tools.rate(x), RATED) for x in frames]
            self.visual = {k: round(sum(x[k] for x in each) / len(each), 4) for k in RATED}

    def caption(self, frames: list[np.ndarray]) -> None:
        said = _one_line(self.tools.caption(frames))
        self.vlm = dict.fromkeys(("judge_model", "judge_caption", *JUDGED)) | {"caption": said}
        own = _one_line(self.tools.describe(frames)) if self.tools.describe else None
        scores = reply_scores(self.tools.judge(frames, said), JUDGED)
        self.vlm |= {"judge_model": self.settings.vlm.judge_model_id, "judge_caption": own} | {k: round(v, 4) for k, v in scores.items()}

    def classify(self, frames: list[np.ndarray]) -> None:
        labels = self.settings.content.labels
        raw = str(reply_object(self.tools.classify(frames, labels))["label"]).strip().lower()
        if raw not in labels and "other" not in labels:
            raise ValueError("an unknown label")
        self.label = raw if raw in labels else "other"

    def align(self) -> None:
        s, seen = self.settings, self.tools.see(self.row.path)
        if s.dedup.embedding != "frame_histogram":
            self.embedding = [float(x) for x in np.asarray(seen).ravel()]
        said = (self.vlm or {}).get("caption")
        if s.video_text.backend == "off" or not said or not self.tools.read:
            return
        score = round(vector_cosine(seen, self.tools.read(said)), 4)
        self.video_text = {"model": VECTOR_MODEL, "cosine_similarity": score, "caption_replaced": None, "cosine_similarity_replaced": None}
        other = self.replaced(said)
        if other != said:
            score = round(vector_cosine(seen, self.tools.read(other)), 4)
            self.video_text |= {"caption_replaced": other, "cosine_similarity_replaced": score}

    def hear(self, start: float, length: float) -> None:
        a = self.settings.audio
        self.audio = audio.measured(self.tools.audio(self.row.path, start, length), a.silence_threshold_db, (a.weight_silence, a.weight_energy, a.weight_clipping))


def _replacer(rules: dict[str, str]) -> Callable[[str], str]:
    import re

    made = [(re.compile(rf"\b{re.escape(word)}\b", re.I), target) for word, target in rules.items()]

    def replaced(text: str) -> str:
        for word, target in made:
            text = word.sub(target, text)
        return text

    return replaced


def extract_facts(clips: DataFrame, settings, backends: Backends) -> DataFrame:
    """From (clip_idx, path, technical_ok, has_audio, times, start, length) of clips that can be read: the columns of ``FACTS``."""
    held: dict[str, SimpleNamespace] = {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if "tools" not in held:  # models are loaded once in each worker
            held["tools"] = SimpleNamespace(**{k: make(settings) if make else None for k, make in vars(backends).items()})
        replaced = _replacer(settings.video_text.replace_words)
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                try:
                    c = Clip(row, held["tools"], settings, replaced).run()
                    rows.append((row.clip_idx, c.visual, c.embedding, c.vlm, c.video_text, c.audio, c.label, c.errors, False))
                except Exception:  # the contract: whatever else goes wrong makes this clip a failed record
                    rows.append((row.clip_idx, None, None, None, None, None, None, [], True))
            yield pd.DataFrame(rows, columns=["clip_idx", "visual", "embedding", "vlm", "video_text", "audio", "label", "errors", "failed"])

    return clips.select("clip_idx", "path", "technical_ok", "has_audio", "times", "start", "length").mapInPandas(run, FACTS)


def probe_clips(clips: DataFrame, settings, backends: Backends) -> DataFrame:
    """``clips`` (with path) and payload, probe_failed (the tool's message where it failed)."""
    from pyspark.sql.types import StructType

    held: dict[str, Callable] = {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if "probe" not in held:
            held["probe"] = backends.probe(settings)
        for batch in batches:
            said = []
            for path in batch["path"]:
                try:
                    said.append((held["probe"](path), None))
                except Exception as wrong:  # the contract: a clip that can't be probed is a row with the message
                    said.append((None, str(wrong)[:400] or type(wrong).__name__))
            yield batch.assign(payload=[x for x, _ in said], probe_failed=[x for _, x in said])

    return clips.mapInPandas(run, StructType([*clips.schema.fields, *StructType.fromDDL("payload string, probe_failed string").fields]))
