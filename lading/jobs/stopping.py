"""The files of a run's journal: their names, the stop flag as tasks see it, and the line of runs."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from .store import ObjectRoot

JOURNAL_FOLDER = "journal"
SECONDS_BETWEEN_LOOKS = 1.0


def run_folder(run_id: str) -> str:
    return f"{JOURNAL_FOLDER}/run={run_id}"


@dataclass
class StopFlag:
    """Whether a run is to stop; looked up at most once a second, in tasks and on the driver."""

    store: str
    run_id: str
    _seen: bool = field(default=False, compare=False)
    _looked: float = field(default=float("-inf"), compare=False)

    def raised(self, now: bool = False) -> bool:
        at = time.monotonic()
        if not self._seen and (now or at - self._looked >= SECONDS_BETWEEN_LOOKS):
            self._looked = at
            self._seen = ObjectRoot(self.store).exists(f"{run_folder(self.run_id)}/stop")
        return self._seen


def request_stop(store: str, run_id: str) -> None:
    """Asks a run to stop after the objects it is copying."""
    ObjectRoot(store).write(f"{run_folder(run_id)}/stop", [b""])


def record_numbers(root: ObjectRoot, run_id: str) -> list[int]:
    try:
        names = [name for name, *_ in root.scan(run_folder(run_id))]
    except FileNotFoundError:
        return []
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]


def ancestors(store: str, run_id: str) -> list[str]:
    """The run and those it goes on from, the newest first."""
    root, found = ObjectRoot(store), []
    while run_id and run_id not in found:
        found.append(run_id)
        numbers = record_numbers(root, run_id)
        if not numbers:
            break
        text = b"".join(root.chunks(f"{run_folder(run_id)}/{max(numbers):06d}.json", 1 << 16))
        run_id = json.loads(text).get("resumed_from")
    return found
