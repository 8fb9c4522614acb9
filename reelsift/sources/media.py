"""Media tools as backends: each function builds, in a Python worker, a callable that reads one clip.

The defaults call ffprobe and ffmpeg, which must be in the PATH of every executor; any callable of the same form does.
"""

from __future__ import annotations

import re
import shutil
import subprocess
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: What is shown of a tool's message.
MESSAGE = 400


def _run(command: list[str], timeout: float) -> bytes:
    done = subprocess.run(command, capture_output=True, timeout=timeout, check=False)
    if done.returncode or not done.stdout:
        said = " ".join((done.stderr or done.stdout).decode(errors="replace").split())
        raise RuntimeError(said[: MESSAGE - 3] + "..." if len(said) > MESSAGE else said or f"{command[0]} failed")
    return done.stdout


def missing_tools(names: tuple[str, ...] = ("ffprobe", "ffmpeg")) -> list[str]:
    return [x for x in names if shutil.which(x) is None]


def ffprobe(settings) -> Callable[[str], str]:
    """From a path: the container's and streams' facts as JSON text."""
    return lambda path: _run(["ffprobe", "-v", "error", "-print_format", "json", "-show_format", "-show_streams", path], settings.probe_timeout_sec).decode()


def ffmpeg_frames(settings) -> Callable[[str, list[float]], list[np.ndarray]]:
    """From a path and times: the frames that could be read, as bytes (height, width, 3)."""
    side = settings.frames.max_side
    fit = f"scale={side}:{side}:force_original_aspect_ratio=decrease"

    def one(path: str, time: float) -> np.ndarray:
        return ppm(_run(["ffmpeg", "-v", "error", "-ss", f"{time:.3f}", "-i", path, "-frames:v", "1", "-vf", fit, "-f", "image2pipe", "-c:v", "ppm", "-"], settings.frames.timeout_sec))

    def read(path: str, times: list[float]) -> list[np.ndarray]:
        out = []
        for time in times:
            try:
                out.append(one(path, time))
            except (RuntimeError, ValueError, subprocess.TimeoutExpired):  # the other frames still count
                continue
        return out

    return read


def ppm(data: bytes) -> np.ndarray:
    """The pixels of a binary PPM image."""
    head = re.match(rb"P6\s+(\d+)\s+(\d+)\s+255\s", data)
    if not head:
        raise ValueError("no PPM image")
    width, height = int(head[1]), int(head[2])
    return np.frombuffer(data, np.uint8, width * height * 3, head.end()).reshape(height, width, 3)


def ffmpeg_audio(settings) -> Callable[[str, float, float], np.ndarray]:
    """From a path, start and length: mono samples."""
    rate = str(settings.audio.sample_rate)

    def read(path: str, start: float, length: float) -> np.ndarray:
        return np.frombuffer(_run(["ffmpeg", "-v", "error", "-ss", f"{start:.3f}", "-t", f"{length:.3f}", "-i", path, "-vn", "-ac", "1", "-ar", rate, "-f", "f32le", "-"], settings.audio.extract_timeout_sec), "<f4")

    return read


@dataclass(frozen=True)
class Backends:
    """Makers of callables, each called with the settings once in a Python worker. None: that stage is off.

    ``probe``: path -> JSON text. ``frames``: path, times -> arrays. ``audio``: path, start, length -> samples. Models:
    ``rate``: frame -> reply; ``caption``: frames -> text; ``describe``: frames -> the judge's own caption; ``judge``: frames,
    caption -> reply; ``classify``: frames, labels -> reply; ``see``: path -> vector; ``read``: text -> vector.
    """

    probe: Callable | None = None
    frames: Callable | None = None
    audio: Callable | None = None
    rate: Callable | None = None
    caption: Callable | None = None
    describe: Callable | None = None
    judge: Callable | None = None
    classify: Callable | None = None
    see: Callable | None = None
    read: Callable | None = None


def default_backends() -> Backends:
    return Backends(probe=ffprobe, frames=ffmpeg_frames, audio=ffmpeg_audio)
