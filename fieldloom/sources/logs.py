"""Logging of a run. Messages take their values as arguments, so braces and percent signs in values do no harm."""

from __future__ import annotations

import logging

LEVELS = {"debug": logging.DEBUG, "info": logging.INFO, "warning": logging.WARNING, "error": logging.ERROR, "critical": logging.CRITICAL}


def level_of(level: str | int) -> int:
    """A level by name in any case or by number up to 50; anything else is a ValueError."""
    if isinstance(level, str) and level.strip().lower() in LEVELS:
        return LEVELS[level.strip().lower()]
    if isinstance(level, int) and 0 < level <= 50:
        return level
    raise ValueError(f"not a log level: {level!r}")


def logger(name: str, level: str | int = "info", path: str | None = None) -> logging.Logger:
    """A logger to the screen and, if named, to a file."""
    log = logging.getLogger(name)
    log.setLevel(level_of(level))
    if not log.handlers:
        for handler in (logging.StreamHandler(), *([logging.FileHandler(path, encoding="utf-8")] if path else [])):
            handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
            log.addHandler(handler)
    return log
