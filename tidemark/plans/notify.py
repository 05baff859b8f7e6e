"""Notifications: hooks by channel, repeats of a failure within a minute dropped."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

COLOURS = {"success": "#36a64f", "partial_failure": "#ff9900", "failed": "#ff0000"}


@dataclass
class Notifier:
    channels: list[Callable[[dict], None]] = field(default_factory=list)
    window: float = 60.0
    clock: Callable[[], float] = time.monotonic
    _seen: dict[str, float] = field(default_factory=dict)

    def send(self, status: str, title: str, text: str = "") -> bool:
        now, key = self.clock(), f"{status}:{title}:{text}"
        if status != "success" and now - self._seen.get(key, float("-inf")) < self.window:
            return False
        self._seen[key] = now
        for channel in self.channels:
            channel({"status": status, "title": title, "text": text, "colour": COLOURS.get(status, "#808080")})
        return True
