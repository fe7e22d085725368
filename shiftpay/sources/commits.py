"""The commit log of a folder of tables: which folders of rows count.

Rows are written to folders of their own attempt, which nothing reads. What makes them part
of the tables is the next file of ``commits``, which holds the whole state: for every table
the folders that count. A file is created in one step and only if it is absent, so of two
writers that began with the same state one has to look at the other's changes first. A writer
that breaks off leaves folders that no state names, for ``clean`` to delete.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from shiftpay.sources import files

_TABLES = ("employees", "time_logs", "validation_errors", "payroll_summary", "log_ids")


@dataclass(frozen=True)
class State:
    """What the tables hold after commit ``revision``; the driver keeps it, so it has an
    entry a load and a week and nothing that grows with rows.

    ``loads`` has what each load number was; ``logs``, ``errors`` and ``ids`` the attempt whose
    rows count, by load; ``weeks`` the attempt that wrote a payroll week last. ``loose`` is
    the last commit that changed shifts or payroll without the other, 0 if there is none:
    from then on payroll can't be carried forward from what payroll rows hold.
    """

    revision: int = 0
    loads: dict[int, dict] = field(default_factory=dict)
    logs: dict[int, str] = field(default_factory=dict)
    errors: dict[int, str] = field(default_factory=dict)
    ids: dict[int, str] = field(default_factory=dict)
    weeks: dict[str, str] = field(default_factory=dict)
    employees: str | None = None
    loose: int = 0

    @property
    def next_load(self) -> int:
        return max(self.loads, default=0) + 1

    def attempts(self) -> set[str]:
        named = [self.logs, self.errors, self.ids, self.weeks]
        return {a for table in named for a in table.values()} | {self.employees or ""}


def _file(root: str, revision: int) -> str:
    return f"{root}/commits/{revision:012d}.json"


def latest(spark: SparkSession, root: str) -> State:
    names = [n for n in files.names(spark, f"{root}/commits") if n.endswith(".json")]
    if not names:
        return State()
    found = json.loads(files.read_text(spark, f"{root}/commits/{max(names)}"))
    # payroll of tables older than this field has no parts to go on from
    found.setdefault("loose", found["revision"] if found["logs"] else 0)
    by_load = {k: {int(n): v for n, v in found[k].items()} for k in ("loads", "logs", "errors", "ids")}
    return State(**(found | by_load))


def commit(
    spark: SparkSession,
    root: str,
    base: State,
    change: Callable[[State], State],
    holds: Callable[[State], bool],
) -> State | None:
    """Apply ``change`` to the state, from ``base`` on; None if that can't be done any more.

    Where another commit came first, ``holds`` says of the newer state whether what was
    written for ``base`` is still right; if so the change is applied to that one.
    """
    while True:
        state = replace(change(base), revision=base.revision + 1)
        if files.create_new(spark, _file(root, state.revision), json.dumps(asdict(state))):
            return state
        base = latest(spark, root)
        if not holds(base):
            return None


def clean(spark: SparkSession, root: str, hours: float = 24) -> int:
    """Delete attempts that the tables no longer name; how many there were.

    Those written to within the last ``hours`` stay: they may belong to a load that is
    still running, or to a reader of an earlier state.
    """
    before = (time.time() - 3600 * hours) * 1000
    kept, gone = latest(spark, root).attempts(), 0
    for table in _TABLES:
        for outer in files.folders(spark, f"{root}/{table}"):
            path = f"{root}/{table}/{outer}"
            inner = [f"{path}/{n}" for n in files.folders(spark, path)]
            for folder in [path] if outer.startswith("attempt=") else inner:
                name = folder.rpartition("attempt=")[2]
                if "/" not in name and name not in kept and files.changed_at(spark, folder) < before:
                    files.remove(spark, folder)
                    gone += 1
    return gone
