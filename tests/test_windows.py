import datetime as dt

import pytest

from rollwise.windows import DateWindow


def test_nominal_31st_clamps_to_month_end():
    w = DateWindow("2026-02-02", "2026-02-31")
    assert w.start == dt.date(2026, 2, 2)
    assert w.end == dt.date(2026, 2, 28)


def test_leap_year_february():
    assert DateWindow("2024-02-01", "2024-02-31").end == dt.date(2024, 2, 29)


def test_shift_keeps_nominal_day_then_clamps():
    prev = DateWindow("2026-02-02", "2026-02-31").shift_months(-1)
    assert (prev.start, prev.end) == (dt.date(2026, 1, 2), dt.date(2026, 1, 31))


def test_shift_across_year():
    w = DateWindow("2026-01-15", "2026-01-31").shift_months(-1)
    assert (w.start, w.end) == (dt.date(2025, 12, 15), dt.date(2025, 12, 31))


def test_month_bounds_for_pruning():
    assert DateWindow("1998-01-20", "1998-03-02").months() == (199801, 199803)


def test_rejects_bad_text():
    with pytest.raises(ValueError):
        DateWindow("2026-13-01", "2026-13-02").start
