"""Files of releases on the driver: storage, manifests, versions, retention and freshness."""

from __future__ import annotations

import hashlib
import json
import re
import shutil
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from pathlib import Path


class LocalStorage:
    """Files below a root. Object stores are read through Spark's own s3a paths instead."""

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def list_files(self, folder: str = "", prefix: str = "", suffix: str = "") -> list[str]:
        base = self.root / folder
        return sorted(p.name for p in base.iterdir() if p.is_file() and p.name.startswith(prefix) and p.name.endswith(suffix)) if base.is_dir() else []

    def list_dirs(self, folder: str = "") -> list[str]:
        base = self.root / folder
        return sorted(p.name for p in base.iterdir() if p.is_dir()) if base.is_dir() else []

    def exists(self, path: str) -> bool:
        return (self.root / path).exists()

    def size(self, path: str) -> int:
        return (self.root / path).stat().st_size if self.exists(path) else 0

    def read_json(self, path: str) -> dict:
        return json.loads((self.root / path).read_text())

    def write_json(self, path: str, data: dict) -> None:
        target = self.root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(json.dumps(data, indent=4, ensure_ascii=False))

    def write_bytes(self, path: str, data: bytes) -> None:
        target = self.root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)

    def copy(self, src: str, dst: str) -> None:
        (self.root / dst).parent.mkdir(parents=True, exist_ok=True)
        shutil.copy(self.root / src, self.root / dst)

    def delete(self, path: str) -> None:
        target = self.root / path
        if target.is_dir():
            shutil.rmtree(target)
        else:
            target.unlink(missing_ok=True)


@dataclass
class Source:
    """What is known about a dataset."""

    name: str
    url: str = ""
    citation: str = ""
    suffix: str = "zip"
    downloaded: int | None = None
    processed: int | None = None
    extra: dict = field(default_factory=dict)

    def stale(self) -> bool:
        """Whether a download is newer than what was processed."""
        return self.downloaded is not None and (self.processed is None or self.downloaded > self.processed)


_DATED = re.compile(r"^(?P<name>.+)\.(?P<date>\d{8})(?P<suffix>\..+)?$")


def dated(names: list[str], name: str) -> list[tuple[int, str]]:
    """(date, file) of files called name.YYYYMMDD.suffix, newest last."""
    found = [(int(m["date"]), f) for f in names if (m := _DATED.match(f)) and m["name"] == name]
    return sorted(found)


def delete_older(storage: LocalStorage, folder: str, name: str, keep: int) -> list[str]:
    """Remove the dated files of a source older than ``keep``."""
    gone = [f for date, f in dated(storage.list_files(folder), name) if date < keep]
    for f in gone:
        storage.delete(f"{folder}/{f}" if folder else f)
    return gone


def release_version(dates: list[int]) -> str:
    """The newest date and twelve digits of a hash over all dates."""
    return f"{max(dates)}-{hashlib.md5(''.join(map(str, dates)).encode()).hexdigest()[:12]}"


def releases(storage: LocalStorage, folder: str = "") -> list[str]:
    return [d for d in storage.list_dirs(folder) if re.fullmatch(r"\d{8}-[0-9a-f]{12}", d) and storage.exists(f"{folder}/{d}/manifest.json" if folder else f"{d}/manifest.json")]


def latest_release(storage: LocalStorage, folder: str = "") -> str | None:
    return max(releases(storage, folder), default=None)


def previous_release(storage: LocalStorage, current: str, folder: str = "") -> str | None:
    return max((r for r in releases(storage, folder) if r < current), default=None)


class State:
    """What the last run knew of each source, kept in one JSON file: dates, versions and where an incremental source stopped."""

    def __init__(self, storage: LocalStorage, path: str = "state.json"):
        self.storage, self.path = storage, path

    def load(self) -> dict:
        return self.storage.read_json(self.path) if self.storage.exists(self.path) else {}

    def of(self, name: str) -> Source:
        held = self.load().get(name, {})
        known = {k: v for k, v in held.items() if k in ("url", "citation", "suffix", "downloaded", "processed")}
        return Source(name, **known, extra={k: v for k, v in held.items() if k not in known})

    def update(self, name: str, **values) -> None:
        """Set values of a source; others and other sources stay, and a value of None goes."""
        held = self.load()
        merged = held.get(name, {}) | values
        held[name] = {k: v for k, v in merged.items() if v is not None}
        self.storage.write_json(self.path, held)

    def advance(self, name: str, last_key: int, when: datetime | None = None) -> bool:
        """Move the last processed key of a source up; a lower one changes nothing."""
        if last_key <= (self.of(name).extra.get("last_key") or -1):
            return False
        self.update(name, last_key=last_key, last_request=(when or datetime.now(UTC)).isoformat())
        return True


def may_request(manifest: dict, now: datetime | None = None, hours: int = 24) -> bool:
    """Whether the last request in a manifest is long enough ago."""
    last = manifest.get("last_request")
    return last is None or (now or datetime.now(UTC)) - datetime.fromisoformat(last) >= timedelta(hours=hours)
