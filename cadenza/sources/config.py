"""Settings of a frame-doubling job, from a dictionary or a YAML profile; unknown keys are refused."""
from __future__ import annotations

import dataclasses
import warnings


@dataclasses.dataclass
class JobConfig:
    """Names and defaults of the settings that double_frames() takes."""

    model: str = "blend"
    scene_threshold: float = 0.35
    transition_threshold: float = 0.12
    target_fps: float = 50.0
    cadence_filter: bool = False
    anti_flicker: bool = False
    batch_size: int | None = None


#: What a profile may also hold; a cluster's own settings and encoders take their place.
UNUSED = {
    "gpus", "chunk_size", "crf", "preset", "use_nvenc", "bitrate", "temp_dir", "weights", "resume", "fp16", "tta", "max_retries", "workers", "log_dir", "log_file", "deinterlace", "ball_refine", "scale",
    "target_resource_ratio", "post_deflicker", "resolution", "color_space", "pix_fmt", "audio",
}


def from_dict(values: dict) -> JobConfig:
    known = {f.name for f in dataclasses.fields(JobConfig)}
    if unknown := set(values) - known - UNUSED:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}; known are {', '.join(sorted(known | UNUSED))}")
    if idle := sorted(set(values) & UNUSED):
        warnings.warn(f"settings without effect here: {', '.join(idle)}")
    return JobConfig(**{k: v for k, v in values.items() if k in known})


def from_yaml(path: str) -> JobConfig:
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_dict(yaml.safe_load(f) or {})
