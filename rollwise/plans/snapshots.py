"""Edge snapshots of a table of daily stock: what each series holds at the edge of a month.

A *closing* of month c has the last daily row of every series in the months up to c, an *opening* of month o
the first one in the months from o on. With them the neighbours of a range of days are found from
the range's own months and one snapshot on either side, however long the table is. A
snapshot is one row per series, written below ``<root>/_edges/`` in a version folder, and counts once the
table's log names it; a change of the months it was made from takes it out of the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.inventory import INV_SERIES
from .tablelog import Section, State

CLOSINGS, OPENINGS = "closings", "openings"
#: The daily rows of a range while it is rebuilt: never named by the log.
DAYS = "days"


def snapshot_path(root: str, section: str, month: int, version: int) -> str:
    return f"{root.rstrip('/')}/_edges/{section}/{month}/{version}"


def write_snapshot(rows: DataFrame, root: str, section: str, month: int, version: int) -> DataFrame:
    """Write a snapshot (files sized by the rebalance) and read it back: later steps start from it."""
    path = snapshot_path(root, section, month, version)
    rows.hint("rebalance").write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def closing_before(state: State, month: int) -> int | None:
    """The newest closing of a month before ``month``."""
    return max((c for c in state.section(CLOSINGS) if c < month), default=None)


def opening_after(state: State, month: int) -> int | None:
    """The oldest opening of a month after ``month``."""
    return min((o for o in state.section(OPENINGS) if o > month), default=None)


def first_rows(rows: DataFrame) -> DataFrame:
    """The first row of every series: one candidate per series and task is shuffled."""
    rest = [c for c in rows.columns if c not in INV_SERIES]
    first = rows.groupBy(*INV_SERIES).agg(F.min_by(F.struct(*rest), "reportdate").alias("_r"))
    return first.select(*INV_SERIES, *[F.col("_r." + c).alias(c) for c in rest]).select(*rows.columns)


def drop_snapshots(sections: dict[str, Section], first: int, last: int) -> None:
    """Take out of a state what the months first..last are part of."""
    sections[CLOSINGS] = {c: v for c, v in sections.get(CLOSINGS, {}).items() if c < first}
    sections[OPENINGS] = {o: v for o, v in sections.get(OPENINGS, {}).items() if o > last}


def unused(spark: SparkSession, root: str, state: State, version_of=lambda v: v) -> list[str]:
    """Folders of snapshots that the log does not name."""
    from . import files
    held = {(s, m, version_of(v)) for s in (CLOSINGS, OPENINGS) for m, v in state.section(s).items()}
    out = []
    for path in files.matching(spark, f"{root.rstrip('/')}/_edges/*/*/*"):
        section, month, version = path.rsplit("/", 3)[1:]
        if version.isdigit() and (section, int(month), int(version)) not in held:
            out.append(path)
    return out
