"""The log of a table: which folders belong to it, changed by atomic numbered entries.

    root/_log/<number>.json     the table's whole state after change ``number``

An entry is created only if its number is still free (``files.create_text``), and only after all the
data it names has been written. So a writer that dies leaves the state before; of two writers
that change the table at once, one gets the number and the other reads the new state, checks that
nothing it built on has changed, and tries the next number, or raises ``Conflict``. An entry holds one small value
per month and snapshot, nothing per file or row; spark ignores the folder when it reads the table.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from copy import deepcopy
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

from . import files

FOLDER = "_log"
#: Entries that ``prune`` leaves, for readers that look up an older state.
KEPT = 10

Section = dict[int, Any]


class Conflict(RuntimeError):
    """Another writer has changed what this one built on; nothing was changed."""


@dataclass(frozen=True)
class State:
    """What the newest entry says: named sections of values by month. Number 0: no entry yet."""

    number: int = 0
    sections: dict[str, Section] = field(default_factory=dict)

    def section(self, name: str) -> Section:
        return self.sections.get(name, {})


def _entry(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{number:020d}.json"


def read_state(spark: SparkSession, root: str) -> State:
    entries = files.matching(spark, f"{root.rstrip('/')}/{FOLDER}/*.json")
    if not entries:
        return State()
    number = int(entries[-1].rsplit("/", 1)[1].split(".")[0])
    held = json.loads(files.read_text(spark, entries[-1]))
    return State(number, {name: {int(k): v for k, v in s.items()} for name, s in held.items()})


def changed(before: State, now: State, section: str, months: Iterable[int] | None = None) -> list[int]:
    """The months (of ``months``, or all) whose value in the section is not what it was."""
    a, b = before.section(section), now.section(section)
    return sorted(m for m in (set(a) | set(b) if months is None else months) if a.get(m) != b.get(m))


def commit(spark: SparkSession, root: str, base: State, change: Callable[[dict[str, Section]], None],
           built_on: Callable[[State], list[int]] | None = None) -> State:
    """Append an entry: the newest state with ``change`` applied (to a copy of its sections). If others have
    committed since ``base``, ``built_on`` (given the newest state) lists the months that clash; any raises ``Conflict``."""
    now = base
    while True:
        clash = built_on(now) if built_on and now.number != base.number else []
        if clash:
            raise Conflict(f"{root}: another writer has changed months {clash}")
        sections = deepcopy(now.sections)
        change(sections)
        text = json.dumps({n: {str(k): v for k, v in sorted(s.items())} for n, s in sections.items()})
        if files.create_text(spark, _entry(root, now.number + 1), text):
            return State(now.number + 1, sections)
        now = read_state(spark, root)


def new_version() -> int:
    """A number that no other write has, growing with time."""
    return time.time_ns()


def prune(spark: SparkSession, root: str) -> None:
    """Delete all but the newest entries."""
    for path in files.matching(spark, f"{root.rstrip('/')}/{FOLDER}/*.json")[:-KEPT]:
        files.delete(spark, path)
