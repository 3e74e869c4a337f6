"""Refreshing a downloaded extract: on the driver, by the server's Last-Modified."""

from __future__ import annotations

import shutil
from collections.abc import Callable
from pathlib import Path
from urllib.request import Request, urlopen


def remote_last_modified(url: str, opener: Callable = urlopen) -> str | None:
    try:
        with opener(Request(url, method="HEAD"), timeout=30) as answer:
            return answer.headers.get("Last-Modified")
    except OSError:
        return None


def is_current(target: Path, remote: str | None) -> bool:
    """Whether the file is there and its sidecar has the server's date (or the server says nothing)."""
    side = target.with_name(target.name + ".last-modified")
    return target.exists() and (remote is None or (side.exists() and side.read_text().strip() == remote))


def refresh(url: str, target: Path, force: bool = False, opener: Callable = urlopen) -> bool:
    """Downloads to a part file, keeps the file before as .bak, and notes the date. Returns whether
    it did."""
    remote = remote_last_modified(url, opener)
    if not force and is_current(target, remote):
        return False
    part = target.with_name(target.name + ".part")
    with opener(Request(url), timeout=60) as answer, part.open("wb") as out:
        shutil.copyfileobj(answer, out, 1 << 20)
    if target.exists():
        target.replace(target.with_name(target.name + ".bak"))
    part.replace(target)
    if remote:
        target.with_name(target.name + ".last-modified").write_text(remote)
    return True
