"""Settings of a run. They are read once and passed on; secrets are not among them."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class Settings:
    frames: str = "data"
    videos: str = "videos"
    mapping: str = "mapping.csv"
    interval_seconds: int = 10
    base_url: str = "http://localhost/"
    delete_downloaded_videos: bool = True
    logger_level: str = "info"
    num_images: int = 100
    local_output_root: str = "random_frames"
    day_nights: tuple[str, ...] = ()
    vehicles: tuple[str, ...] = ()
    video_ids: tuple[str, ...] = ()
    location_tree: Any = None
    images_per_folder: int = 1
    fill_images_per_folder: int = 5
    folders_per_city: int = 5000
    crawl_pages: int = 500
    balanced: bool = True
    save_manifest: bool = True
    strict_times: bool = True
    seed: str = "0"

    def __post_init__(self) -> None:
        if self.interval_seconds <= 0:
            raise ValueError("interval_seconds must be positive")
        if self.num_images <= 0:
            raise ValueError("num_images must be positive")
        if not self.base_url.strip():
            raise ValueError("base_url must be given")


def _object(path: str) -> dict:
    """The JSON object in a file; anything else is a ValueError that names the file."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8-sig"))
    except (OSError, ValueError) as e:
        raise ValueError(f"settings cannot be read from {path}: {e}") from e
    if not isinstance(found, dict):
        raise ValueError(f"settings in {path} are no object")
    return found


def read_settings(path: str, default: str | None = None) -> Settings:
    """Settings from a JSON object; names in any case, unknown ones are an error, missing ones take their default. With `default`, a file that a run
    ships with, it is an error too if one of both cannot be read or there are fewer entries than there."""
    given = _object(path)
    if default is not None and not complete(given, _object(default)):
        raise ValueError(f"settings in {path} have fewer entries than {default}")
    known = {f.name: f for f in fields(Settings)}
    values = {k.lower(): tuple(v) if isinstance(v, list) else v for k, v in given.items()}
    if wrong := sorted(set(values) - set(known)):
        raise ValueError(f"unknown settings: {', '.join(wrong)}")
    return Settings(**values)


def complete(given: dict, default: dict) -> bool:
    """Whether settings have at least as many entries as the default ones."""
    return len(given) >= len(default)
