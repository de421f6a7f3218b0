"""Progress of a build: counters, phases and a heartbeat thread that writes key=value lines."""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import threading
import time
from dataclasses import dataclass, field

PREFIX = "MILLRACE_PROGRESS"
PHASES = ("ingest", "external_sort", "merge", "index_commit", "hash", "manifest", "verify", "package", "complete")
FIELDS = ("input_bytes", "input_lines", "raw_parsed", "accepted", "invalid_lines", "skipped", "skipped_invalid_barcode", "skipped_missing_name", "skipped_missing_nutrition", "skipped_validation", "sort_runs", "deduped_docs", "indexed_docs", "phase_bytes", "phase_files")


@dataclass
class ProgressOptions:
    """A line is due after so many records (0: never) or seconds."""

    record_interval: int = 100_000
    wall_seconds: float = 30.0

    def __post_init__(self):
        if self.wall_seconds <= 0:
            raise ValueError("progress interval must be greater than zero")


@dataclass
class Progress:
    """Counters of a run. A context manager: a background thread emits due lines until it is left."""

    options: ProgressOptions = field(default_factory=ProgressOptions)
    output: object = None

    def __post_init__(self):
        self.counters = dict.fromkeys(FIELDS, 0) | {"compressed_bytes": 0, "compressed_total": 0}
        self.phase, self.phases, self.records = "start", [], 0
        self.started = time.monotonic()
        self._last = (0, self.started)
        self._lock, self._stop, self._thread = threading.RLock(), threading.Event(), None

    def __enter__(self) -> Progress:
        self._thread = threading.Thread(target=self._beat, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.set_phase("complete")
        self._stop.set()
        if self._thread:
            self._thread.join()

    def _beat(self) -> None:
        while not self._stop.wait(min(self.options.wall_seconds, 1.0)):
            self.emit()

    def set_phase(self, phase: str) -> None:
        """Start a phase: its name cleaned, its own counters back to 0, and a line at once."""
        with self._lock:
            self.phase = re.sub(r"[^A-Za-z0-9_-]", "_", phase[:32]) or "unknown"
            self.phases.append(self.phase)
            self.counters |= {"phase_bytes": 0, "phase_files": 0}
            self.emit(force=True)

    def update(self, records: int | None = None, **counters: int) -> None:
        with self._lock:
            self.counters |= counters
            if records is not None:
                self.records = records
            self.emit()

    def emit(self, force: bool = False) -> bool:
        """Write a line if one is due."""
        with self._lock:
            now = time.monotonic()
            due = self.options.record_interval > 0 and self.records - self._last[0] >= self.options.record_interval
            if not (force or due or now - self._last[1] >= self.options.wall_seconds):
                return False
            elapsed = now - self.started
            rate = self.records / elapsed if elapsed > 0 else 0.0
            c = self.counters
            parts = [f"phase={self.phase}", f"elapsed_ms={int(elapsed * 1000)}", f"throughput_records_per_sec={rate:.2f}", f"compressed_bytes={c['compressed_bytes']}/{c['compressed_total']}"]
            print(PREFIX, *parts, *[f"{k}={c[k]}" for k in FIELDS], file=self.output or sys.stderr, flush=True)
            self._last = (self.records, now)
            return True


def atomic_write(path: str, text: str) -> None:
    """Write beside the target and rename, so that readers see the old or the new text."""
    fd, temporary = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(temporary, path)


def override_status(status: str, timestamp: str, state: str, exit_code: int | None = None) -> str:
    """A heartbeat with its time, state and exit code replaced."""
    patched = json.loads(status) | {"timestamp": timestamp, "state": state}
    if exit_code is not None:
        patched["exitCode"] = exit_code
    return json.dumps(patched)


def first_run(runs: list[dict], sha: str, not_before: str) -> dict | None:
    """The first listed run of a revision that started at this time or later."""
    return next((r for r in runs if r["headSha"] == sha and r["createdAt"] >= not_before), None)
