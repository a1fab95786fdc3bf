"""Model plug-ins: their protocols, deterministic stand-ins, command adapters and the retry ladder.

A stage takes a *factory*; it is called once per Python worker, so a model loads
where it runs.  Models only see arrays; thresholds, suppression, windows and
composition stay in the plan.
"""

from __future__ import annotations

import shlex
import subprocess
import tempfile
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol

import numpy as np

from orbiscope.config import Config
from orbiscope.functions import kernels, png


class OutOfMemory(RuntimeError):
    """The model ran out of memory at every chunk size."""


@dataclass
class SemanticPrediction:
    labels: np.ndarray  # int32 (h, w)
    confidence: np.ndarray | None = None  # float (h, w)
    scores: np.ndarray | None = None  # float (classes, h, w)
    panoptic: np.ndarray | None = None  # int32 (h, w)
    segments: list[dict] = field(default_factory=list)


class SemanticParser(Protocol):
    model_id: str
    id2label: dict[int, str]

    def parse_face(self, face: str, rgb: np.ndarray) -> SemanticPrediction: ...


class Detector(Protocol):
    model_id: str

    def detect_face(self, face: str, rgb: np.ndarray) -> list[tuple[tuple[float, float, float, float], float, str]]: ...


class Refiner(Protocol):
    """``refine_face`` returns one (mask, score) per prompt, None for a prompt without a mask."""

    model_id: str

    def refine_face(self, face: str, rgb: np.ndarray, prompts: list[dict]) -> list[tuple[np.ndarray, float] | None]: ...


class SequenceSession(Protocol):
    """What a model remembers of one face over a sequence's frames."""

    def frame(
        self, frame: int, rgb: np.ndarray, prompts: list[tuple[int, dict, tuple[float, float]]]
    ) -> list[tuple[int, np.ndarray, float | None]]:
        """(track id, mask, score or None) of every track that the model sees in this frame.

        ``prompts`` are this frame's: (track id, prompt, point inside it).
        """
        ...


class SequenceRefiner(Protocol):
    """A refiner that follows masks over frames.

    Frames come one by one in order, so that a task holds one frame and the
    session.  Association, output filter and statuses stay in the plan.
    """

    model_id: str

    def open_sequence(self, face: str, config: Config) -> SequenceSession: ...


class VideoInpainter(Protocol):
    model_id: str

    def inpaint_clip(self, face: str, frames: list[np.ndarray], masks: list[np.ndarray], config: Config) -> list[np.ndarray]: ...


class ImageInpainter(Protocol):
    model_id: str

    def inpaint_image(self, face: str, image: np.ndarray, mask: np.ndarray, config: Config) -> np.ndarray: ...


# --- stand-ins -------------------------------------------------------------------------------------------------------


class BandParser:
    """Labels by gray value: a deterministic stand-in for a segmenter."""

    model_id = "stand-in/bands"
    id2label = {0: "road", 1: "car", 2: "building", 3: "sky"}

    def parse_face(self, face: str, rgb: np.ndarray) -> SemanticPrediction:
        gray = rgb.mean(axis=2)
        return SemanticPrediction(labels=(gray // 64).astype(np.int32), confidence=((gray % 64) / 64).astype(np.float32))


class BoxDetector:
    """One box around the bright pixels."""

    model_id = "stand-in/bright-box"

    def detect_face(self, face: str, rgb: np.ndarray):
        box = kernels.bounding_box(kernels.as_mask(rgb.mean(axis=2) > 200))
        return [] if box is None else [(box, 0.9, "car")]


class BoxRefiner:
    """The prompt's own box, joined with its prior mask."""

    model_id = "stand-in/box"

    def refine_face(self, face: str, rgb: np.ndarray, prompts: list[dict]):
        out = []
        for p in prompts:
            mask = np.zeros(rgb.shape[:2], np.uint8)
            x0, y0, x1, y1 = (int(round(p[c])) for c in ("x0", "y0", "x1", "y1"))
            mask[y0:y1, x0:x1] = 255
            if p.get("prior_mask") is not None:
                mask = np.maximum(mask, np.frombuffer(p["prior_mask"], np.uint8).reshape(mask.shape))
            out.append((mask, float(p["score"])))
        return out


class BoxSequenceRefiner:
    """Every track keeps the box of its last prompt; a deterministic stand-in for a video segmenter."""

    model_id = "stand-in/box-sequence"

    class Session:
        def __init__(self):
            self.boxes: dict[int, tuple[tuple[int, ...], float]] = {}

        def frame(self, frame, rgb, prompts):
            for track, p, _ in prompts:
                self.boxes[track] = tuple(int(round(p[c])) for c in ("x0", "y0", "x1", "y1")), float(p["score"])
            out = []
            for track, ((x0, y0, x1, y1), score) in self.boxes.items():
                mask = np.zeros(rgb.shape[:2], np.uint8)
                mask[y0:y1, x0:x1] = 255
                out.append((track, mask, score))
            return out

    def open_sequence(self, face, config):
        return self.Session()


class PassthroughVideo:
    """Returns the frames as they are (dry runs)."""

    model_id = "ProPainter/dry-run-passthrough"

    def inpaint_clip(self, face, frames, masks, config):
        return [f.copy() for f in frames]


class PassthroughImage:
    """Returns the image as it is (dry runs)."""

    model_id = "LaMa/dry-run-passthrough"

    def inpaint_image(self, face, image, mask, config):
        return image.copy()


# --- command adapters ------------------------------------------------------------------------------------------------


def _run(template: str, **places: str) -> None:
    done = subprocess.run(shlex.split(template.format(**places)), check=False, capture_output=True, text=True)
    if done.returncode:
        raise RuntimeError(f"command failed with exit code {done.returncode}: {done.stderr.strip()}")


def _read(path: Path, shape: tuple[int, ...]) -> np.ndarray:
    if not path.is_file():
        raise RuntimeError(f"command did not write {path.name}")
    out = png.decode(path.read_bytes())
    out = np.repeat(out[..., None], 3, axis=2) if out.ndim == 2 else out[..., :3]
    if out.shape != shape:
        raise RuntimeError(f"output shape {out.shape} does not match input shape {shape}")
    return out


@dataclass
class CommandVideo:
    """A program that reads numbered PNG frames and masks and writes numbered PNG frames."""

    command: str
    model_id: str = "ProPainter"

    def __post_init__(self):
        if not self.command:
            raise ValueError("a command with {frames_dir}, {masks_dir}, {output_dir}, {face_name}, {device} is needed")

    def inpaint_clip(self, face, frames, masks, config):
        if len(frames) != len(masks):
            raise RuntimeError("frame and mask counts differ")
        if not frames:
            return []
        with tempfile.TemporaryDirectory() as folder:
            places = {k: Path(folder, k) for k in ("frames", "masks", "output")}
            for p in places.values():
                p.mkdir()
            for i, (frame, mask) in enumerate(zip(frames, masks, strict=True)):
                (places["frames"] / f"{i:06d}.png").write_bytes(png.encode(frame))
                (places["masks"] / f"{i:06d}.png").write_bytes(png.encode(kernels.as_mask(mask > 0)))
            named = {f"{k}_dir": str(p) for k, p in places.items()}
            _run(self.command, **named, face_name=face, device=config.propainter_device)
            return [_read(places["output"] / f"{i:06d}.png", f.shape) for i, f in enumerate(frames)]


@dataclass
class CommandImage:
    """A program that reads one PNG image and mask and writes one PNG image."""

    command: str
    model_id: str = "LaMa"

    def __post_init__(self):
        if not self.command:
            raise ValueError("a command with {image_path}, {mask_path}, {output_path}, {output_dir}, {face_name}, {device} is needed")

    def inpaint_image(self, face, image, mask, config):
        with tempfile.TemporaryDirectory() as folder:
            where = {k: Path(folder, f"{k}.png") for k in ("image", "mask", "output")}
            where["image"].write_bytes(png.encode(image))
            where["mask"].write_bytes(png.encode(kernels.as_mask(mask > 0)))
            named = {f"{k}_path": str(p) for k, p in where.items()}
            _run(self.command, **named, output_dir=folder, face_name=face, device=config.lama_device)
            return _read(where["output"], image.shape)


# --- retry -----------------------------------------------------------------------------------------------------------


def is_out_of_memory(error: BaseException) -> bool:
    text = str(error).lower()
    return any(w in text for w in ("out of memory", "oom", "cuda memory"))


def chunk_sizes(first: int) -> list[int]:
    """The chunk size and its halves down to one."""
    sizes = [max(1, first)]
    while sizes[-1] > 1:
        sizes.append(sizes[-1] // 2)
    return sizes


def resolve_device(wanted: str, available: Callable[[str], bool] = lambda d: d == "cpu") -> str:
    """``auto`` is the first of cuda, mps and cpu that is available."""
    if wanted != "auto":
        return wanted
    return next((d for d in ("cuda", "mps", "cpu") if available(d)), "cpu")


def available_devices(device: str) -> bool:
    """Whether the installed array framework, if any, has the device."""
    if device == "cpu":
        return True
    try:
        import torch
    except ImportError:
        return False
    if device == "cuda":
        return torch.cuda.is_available()
    mps = getattr(torch.backends, "mps", None)
    return mps is not None and mps.is_available()


def plugin(spec: str, config: Config, device: str) -> Callable[[], object]:
    """A factory of the model that ``module:name`` builds from (config, device).

    It runs where the model is used; ``device`` is resolved there too.
    """
    module, _, name = spec.partition(":")
    if not module or not name:
        raise ValueError(f"a model is named as module:factory, not {spec!r}")

    def make():
        from importlib import import_module

        return getattr(import_module(module), name)(config, resolve_device(device, available_devices))

    return make


def inpaint_with_retries(backend: VideoInpainter, face: str, frames: list, masks: list, config: Config) -> list[np.ndarray]:
    """The clip in chunks; running out of memory starts it over with chunks of half the size, other errors do not."""
    last: BaseException | None = None
    for size in chunk_sizes(config.propainter_chunk_size):
        out: list[np.ndarray] = []
        try:
            for a in range(0, len(frames), size):
                made = backend.inpaint_clip(face, frames[a : a + size], masks[a : a + size], config)
                if len(made) != len(frames[a : a + size]):
                    raise RuntimeError(f"model returned {len(made)} frame(s) for {len(frames[a : a + size])} input frame(s)")
                out += made
            return out
        except Exception as error:  # noqa: BLE001
            if not is_out_of_memory(error):
                raise
            last = error
    raise OutOfMemory(f"out-of-memory during all retry levels: {last}")


def video_factory(config: Config) -> Callable[[], VideoInpainter] | None:
    """The configured video model: pass-through on a dry run, a command, or none."""
    if config.dry_run:
        return PassthroughVideo
    if config.propainter_command:
        command, model = config.propainter_command, config.propainter_model_id
        return lambda: CommandVideo(command, model)
    return None


def image_factory(config: Config) -> Callable[[], ImageInpainter] | None:
    if config.dry_run:
        return PassthroughImage
    if config.lama_command:
        command, model = config.lama_command, config.lama_model_id
        return lambda: CommandImage(command, model)
    return None
