"""Group-by with "any" attributes (as ``min``) and exact sums, hash-aggregated.

Spark's hash aggregation only holds fixed-width buffers; a ``min`` over a
string column makes the planner fall back to sort-based aggregation, which
sorts every input partition before combining it. Report attributes that are
text (category, names, codes) are, per group, almost always one or a few
values, so the rollup runs in two levels:

1. ``groupBy(keys + text attributes)`` with ``min`` of the numeric attributes
   and exact sums -- a hash aggregate with map-side combine over the raw rows;
2. ``groupBy(keys)`` with ``min`` of everything and the sums re-added -- over
   rows already reduced to about one per group.

The result equals a single ``groupBy(keys).agg(min(...), exact_sum(...))``:
the min over distinct values is the min over all values, and exact sums of
exact partial sums are exact. Sums travel as pairs of integers between the levels
and in partial rows (``functions.measures``); only the final rows hold doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from ..functions.measures import carried, state_columns, state_total, sum_states


#: Places rows as they will be stored; gives them and the columns they are sorted by, new ones and keys.
Arrange = Callable[[DataFrame], tuple[DataFrame, list[str]]]


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (StringType, BinaryType))


def has_states(df: DataFrame, sums: list[str]) -> bool:
    """Whether ``df`` holds partial rows (pairs) and not values of ``sums``."""
    return bool(sums) and state_columns(sums[0])[0] in df.columns


def _carry(df: DataFrame, sums: list[str]) -> DataFrame:
    made = {}
    for c in sums:
        whole, nano = state_columns(c)
        made[whole], made[nano] = carried(F.col(whole), F.col(nano))
    return df.withColumns(made)


def totals(df: DataFrame, sums: list[str]) -> DataFrame:
    """Partial columns turned into doubles."""
    drop = [x for c in sums for x in state_columns(c)]
    return df.withColumns({c: state_total(*(F.col(x) for x in state_columns(c))) for c in sums}).drop(*drop)


def rollup(lines: DataFrame, keys: list[str], mins: list[str], sums: list[str],
           cluster_by: list[str] | None = None, final: bool = True, states: bool = False,
           near: tuple[str, ...] = (), arrange: Arrange | None = None, counts: tuple[str, ...] = ()) -> DataFrame:
    """``lines``: rows with values, or partial rows. ``cluster_by``: a subset of ``keys`` to
    hash-partition the reduced level-1 rows by, when the next operator needs that
    clustering (e.g. a window over a series): one shuffle then serves both level 2 and
    that operator. ``final=False`` stops after level 1 (one shuffle): partial rows that
    may repeat a key (one per text variant); merging runs the full rollup again.
    ``states=True`` gives merged partial rows, one per key.

    Partial rows are about one per key and load, so they are not combined before their shuffle: it places
    them by ``cluster_by`` or the keys and one aggregation merges them there.
    ``near``: columns (that decide a key) by which a join may have placed the lines; as keys of level 1 they
    spare its shuffle. ``arrange``: places the level-1 rows as they will be stored, by columns that the keys
    decide; level 2 and the stored order then share one shuffle and one sort, and these columns stay in front.
    ``counts``: further columns of integers, added up."""
    text = [c for c in mins if _is_text(lines, c)]
    values = [c for c in mins if c not in text]
    pairs = lambda of: [s for c in sums for s in sum_states(c, of)]
    merging = has_states(lines, sums) and final
    out = lines if merging else lines.groupBy(*keys, *text, *near).agg(
        *[F.min(c).alias(c) for c in values], *pairs(has_states(lines, sums)), *[F.sum(c).alias(c) for c in counts]).drop(*near)
    if (text or near or merging or arrange) and final:
        first = []
        if arrange:
            out, first = arrange(out)
        else:
            out = out.repartition(*(cluster_by or keys))
        # sorted by its keys, so these begin with the order wanted
        out = out.groupBy(*first, *[k for k in keys if k not in first]).agg(
            *[F.min(c).alias(c) for c in mins], *pairs(True), *[F.sum(c).alias(c) for c in counts])
    return totals(out, sums) if final and not states else _carry(out, sums)


def state_order(columns: list[str], sums: list[str], states: bool) -> list[str]:
    """``columns`` of a report, its sums as they are named in final or in partial rows."""
    return [x for c in columns for x in (state_columns(c) if states and c in sums else [c])]
