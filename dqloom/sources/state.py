"""The state of an endpoint between runs: watermark and cumulative counters, in one small JSON file swapped in whole."""

from __future__ import annotations

import json
import os
import tempfile
from dataclasses import asdict, dataclass, replace
from datetime import datetime
from pathlib import Path


@dataclass(frozen=True)
class RunState:
    api_id: str
    last_dtcr_processed: str | None = None
    last_run_status: str | None = None
    last_run_mode: str | None = None
    cumulative_rows: int = 0
    cumulative_outliers: int = 0
    cumulative_runs: int = 0
    first_run_datetime: str | None = None

    @property
    def watermark(self) -> datetime | None:
        return datetime.fromisoformat(self.last_dtcr_processed) if self.last_dtcr_processed else None


class StateStore:
    def __init__(self, folder: str):
        self.folder = Path(folder)

    def path(self, api_id: str) -> Path:
        return self.folder / f"state_{api_id.lower()}.json"

    def read(self, api_id: str) -> RunState:
        path = self.path(api_id)
        return RunState(**json.loads(path.read_text(encoding="utf-8"))) if path.exists() else RunState(api_id)

    def write(self, state: RunState) -> None:
        self.folder.mkdir(parents=True, exist_ok=True)
        with tempfile.NamedTemporaryFile("w", dir=self.folder, suffix=".tmp", delete=False, encoding="utf-8") as f:
            json.dump(asdict(state), f, ensure_ascii=False, indent=2)
        os.replace(f.name, self.path(state.api_id))

    def seed(self, api_id: str, watermark: datetime) -> bool:
        """A first watermark; an existing state is never overwritten."""
        if self.path(api_id).exists():
            return False
        self.write(RunState(api_id, last_dtcr_processed=watermark.isoformat()))
        return True


def advanced(state: RunState, ok: bool, mode: str, rows: int, outliers: int, latest: datetime | None, now: datetime) -> RunState:
    """The state after a run. The watermark moves on success alone, and only to a known time; the number of runs grows either way."""
    moved = latest.isoformat() if ok and latest is not None else state.last_dtcr_processed
    return replace(
        state, last_dtcr_processed=moved, last_run_status="OK" if ok else "KO", last_run_mode=mode,
        cumulative_rows=state.cumulative_rows + (rows if ok else 0), cumulative_outliers=state.cumulative_outliers + (outliers if ok else 0),
        cumulative_runs=state.cumulative_runs + 1, first_run_datetime=state.first_run_datetime or now.isoformat(),
    )
