"""Inclusive date windows of the dashboards, with month shifting.

Dashboard windows are written with a nominal day that may not exist
('2026-02-31'). We keep the nominal (year, month, day), shift months first and
clamp to the month's last day last, so February ends on the 28th/29th and the
previous month of a 02-31 window ends on January 31st.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parse(text: str) -> tuple[int, int, int]:
    y, m, d = (int(p) for p in text.strip().split("-"))
    if not (1 <= m <= 12 and 1 <= d <= 31):
        raise ValueError(f"not a nominal date: {text!r}")
    return y, m, d


def _clamp(y: int, m: int, d: int) -> dt.date:
    return dt.date(y, m, min(d, calendar.monthrange(y, m)[1]))


def _shift(y: int, m: int, months: int) -> tuple[int, int]:
    idx = y * 12 + (m - 1) + months
    return idx // 12, idx % 12 + 1


@dataclass(frozen=True)
class DateWindow:
    """``lo`` and ``hi`` are nominal 'YYYY-MM-DD' strings; both ends inclusive."""

    lo: str
    hi: str

    @property
    def start(self) -> dt.date:
        return _clamp(*_parse(self.lo))

    @property
    def end(self) -> dt.date:
        return _clamp(*_parse(self.hi))

    def shift_months(self, months: int) -> "DateWindow":
        out = []
        for text in (self.lo, self.hi):
            y, m, d = _parse(text)
            y, m = _shift(y, m, months)
            out.append(f"{y:04d}-{m:02d}-{d:02d}")
        return DateWindow(*out)

    # --- predicates -------------------------------------------------------
    def contains(self, date_col: Column) -> Column:
        """Inclusive predicate on a DATE column."""
        return date_col.between(F.lit(self.start), F.lit(self.end))

    def contains_ts(self, ts_col: Column) -> Column:
        """Whole days of the window on a TIMESTAMP column (pushdown friendly)."""
        lo = dt.datetime.combine(self.start, dt.time())
        hi = dt.datetime.combine(self.end + dt.timedelta(days=1), dt.time())
        return (ts_col >= F.lit(lo)) & (ts_col < F.lit(hi))

    def months(self) -> tuple[int, int]:
        """yyyymm bounds, for partition pruning of month-partitioned reports."""
        return self.start.year * 100 + self.start.month, self.end.year * 100 + self.end.month

    def sql(self, col: str) -> str:
        return f"{col} BETWEEN DATE '{self.start.isoformat()}' AND DATE '{self.end.isoformat()}'"


def month_window(first: int, last: int) -> DateWindow:
    """Whole months first..last (yyyymm, inclusive)."""
    return DateWindow(f"{first // 100:04d}-{first % 100:02d}-01", f"{last // 100:04d}-{last % 100:02d}-31")


def month_before(month: int) -> int:
    """The month (yyyymm) before."""
    y, m = _shift(*divmod(month, 100), -1)
    return y * 100 + m


def month_after(month: int) -> int:
    """The month (yyyymm) after."""
    y, m = _shift(*divmod(month, 100), 1)
    return y * 100 + m


def first_day(month: int) -> dt.date:
    return dt.date(month // 100, month % 100, 1)


def months_between(first: int, last: int) -> list[int]:
    """The months first..last (yyyymm, inclusive)."""
    out, (y, m) = [], divmod(first, 100)
    while y * 100 + m <= last:
        out.append(y * 100 + m)
        y, m = _shift(y, m, 1)
    return out
