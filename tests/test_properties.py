"""Randomised checks against plain-Python restatements of the definitions."""

import datetime as dt
import itertools
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import line, order_lines
from tillroll import plans
from tillroll.operators.indicators import SLOT_COLUMNS, WEEKDAY_COLUMNS

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

day = st.integers(min_value=0, max_value=120).map(lambda n: dt.date(2015, 1, 1) + dt.timedelta(days=n))
raw_line = st.tuples(st.integers(1, 12), st.sampled_from(["A", "B", "C", "D", "E"]), day,
                     st.sampled_from(["u1", "u2", "u3"]), st.integers(-2, 5),
                     st.sampled_from(["1.00", "2.50", "10.00"]), st.integers(0, 23))
lines_strategy = st.lists(raw_line, min_size=1, max_size=40)


def _build(spark, raw):
    rows = []
    for order, product, d, email, qty, price, hour in raw:
        rows.append(line(f"#{order}", product, f"{d.isoformat()} {hour:02d}:30:00 -0500",
                         email=email, qty=qty, price=price, sku="s" + product))
    return order_lines(spark, rows)


@SETTINGS
@given(raw=lines_strategy)
def test_pairs_match_set_intersections(spark, raw):
    orders = defaultdict(set)
    for order, product, *_ in raw:
        orders[product].add(order)
    expect = {}
    for a, b in itertools.combinations(sorted(orders), 2):
        n = len(orders[a] & orders[b])
        if n:
            expect[(a, b)] = n
    got = {(r.product_1, r.product_2): r.n_orders for r in plans.bought_together(_build(spark, raw)).collect()}
    assert got == expect


@SETTINGS
@given(raw=lines_strategy)
def test_gaps_match_sorted_differences(spark, raw):
    dates = defaultdict(set)
    for _o, _p, d, email, *_ in raw:
        dates[email].add(d)
    expect = {}
    for email, ds in dates.items():
        s = sorted(ds)
        gaps = sum((b - a).days for a, b in zip(s, s[1:]))
        expect[email] = (len(s), gaps / len(s))
    got = {r.email: (r.n_dates, r.avg_gap) for r in plans.order_gap(_build(spark, raw)).collect()}
    assert got == expect


@SETTINGS
@given(raw=lines_strategy)
def test_cmgr_matches_densified_series(spark, raw):
    # Restatement over the dense month series: distinct (product, sku, date, revenue).
    distinct = {(p, "S" + p, d, qty * float(price)) for _o, p, d, _e, qty, price, _h in raw}
    months = sorted({d.replace(day=1) for *_x, d, _r in distinct})
    monthly, total = defaultdict(float), defaultdict(float)
    for p, s, d, r in distinct:
        monthly[(p, d.replace(day=1))] += r
        total[p] += r
    expect = {}
    for p in total:
        series = [max(monthly.get((p, m), 0.0), 0.0) if monthly.get((p, m), 0.0) > 0 else 0.0
                  for m in months]
        pos = [i for i, v in enumerate(series) if v != 0]
        if not pos:
            expect[p] = (None, 1)
            continue
        t = pos[0]
        n = len(months) - t
        y = total[p] / series[t]
        expect[p] = (None if (y < 0 and n > 1) else round((y ** (1.0 / n) - 1) * 100, 6), n)
    got = {r.product: (None if r.cmgr is None else round(r.cmgr, 6), r.n_periods)
           for r in plans.product_cmgr(_build(spark, raw)).collect()}
    assert got == expect


@SETTINGS
@given(raw=lines_strategy)
def test_habit_counts_are_consistent(spark, raw):
    lines = _build(spark, raw)
    prof = plans.day_hour_profile(lines).collect()
    for r in prof:
        assert sum(r[c] for c in WEEKDAY_COLUMNS) == sum(r[c] for c in SLOT_COLUMNS)
    weekly = plans.weekly_visits(lines).groupBy().sum("n_visits").collect()[0][0]
    stamps = {(email, d, hour) for _o, _p, d, email, _q, _pr, hour in raw}
    assert weekly == len(stamps)


@SETTINGS
@given(raw=lines_strategy)
def test_week_shares_sum_to_100(spark, raw):
    rows = plans.product_week_revenue(_build(spark, raw)).collect()
    total = sum(r.revenue for r in rows)
    if total:
        assert abs(sum(r.pct_total for r in rows) - 100.0) < 1e-6
