from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta
from itertools import pairwise

import pytest

from spanforge.llm import change_points as cp
from tests.llm.data import plain_rows
from tests.oracle import compare

SCHEMA = "vendor_id long, quantity int, flag string, shipped_at timestamp_ntz, days int, key string"
DAY0 = date(2024, 1, 1)


def cost(part):
    n, s, q = len(part), sum(part), sum(x * x for x in part)
    spread = 1 + (n * q - s * s) // (n * n)
    return s, spread, n * math.floor(1000 * math.log(spread))


def brute(values, least=5, penalty=10_000):
    """The best cut by trying all of them: least cost, then fewest segments, then earliest starts from the last backwards."""
    n, found = len(values), []

    def cuts(end):
        if end == 0:
            yield ()
        for begin in range(0, end - least + 1):
            for before in cuts(begin):
                yield (*before, begin)

    for starts in [(0,)] if n < least else cuts(n):
        bounds = [*starts, n]
        total = sum(cost(values[a:b])[2] for a, b in pairwise(bounds)) + penalty * (len(starts) - 1)
        found.append((total, len(starts), starts[::-1]))
    best, number, starts = min(found)
    bounds = [*starts[::-1], n]
    return [(k + 1, a, b - a, *cost(values[a:b]), number, best) for k, (a, b) in enumerate(pairwise(bounds))]


def series(spark, all_values, **how):
    rows = spark.createDataFrame([(i, 100, len(v), v) for i, v in enumerate(all_values)], "id long, first_day long, n_days long, days array<long>")
    out = {}
    for r in cp.segmented(rows, "id", **how).orderBy("id", "segment_no").collect():
        out.setdefault(r.id, []).append((r.segment_no, r.first_day - 100, r.n_days, r.total, r.spread, r.cost, r.n_segments, r.best_cost))
    return [out[i] for i in range(len(all_values))]


def drawn():
    rng = random.Random(13)
    out = [[7], [1, 2, 3, 4], [5] * 5, [0] * 9, [3] * 24, [1] * 10 + [90, 400] * 6, [9, 1] * 11]
    for _ in range(60):
        values = []
        while len(values) < rng.randint(1, 24):
            level, noise = rng.choice([0, 5, 100, 3000]), rng.choice([0, 0, 1, 50, 2000])
            values += [level + rng.randint(0, noise) for _ in range(rng.randint(1, 9))]
        out.append(values[:24])
    return out


def test_segments_equal_all_cuts(spark):
    values = drawn()
    assert series(spark, values) == [brute(v) for v in values]


def weighed(values, least=5, penalty=10_000):
    """The same by dynamic programming, for long series: (cost, segments, starts from the last) of every first part."""
    n = len(values)
    best = [(-penalty, 0, ())] + [None] * n
    for j in range(least, n + 1):
        found = [(best[i][0] + cost(values[i:j])[2] + penalty, best[i][1] + 1, (i, *best[i][2])) for i in range(j - least + 1) if best[i]]
        best[j] = min(found)
    total, number, starts = best[n]
    bounds = [*starts[::-1], n]
    return [(k + 1, a, b - a, *cost(values[a:b]), number, total) for k, (a, b) in enumerate(pairwise(bounds))]


def test_long_series(spark):
    """Here most places are passed over."""
    rng = random.Random(5)
    values = []
    for _ in range(12):
        one = []
        for _ in range(rng.choice([1, 2, 5, 9])):
            level, noise = rng.choice([0, 20, 300, 5000]), rng.choice([0, 1, 30, 400])
            one += [max(0, level + round(rng.gauss(0, noise))) for _ in range(rng.randint(3, 60))]
        values.append(one)
    values += [[0] * 90, [1, 2] * 50, [0] * 40 + [1] + [0] * 60, [rng.choice([0, 0, 0, 7]) for _ in range(160)]]
    assert series(spark, values) == [weighed(v) for v in values]
    assert series(spark, values[:6], least_days=3, penalty=900) == [weighed(v, 3, 900) for v in values[:6]]
    assert series(spark, values[:6], least_days=8, penalty=20_000) == [weighed(v, 8, 20_000) for v in values[:6]]


def test_ties_and_other_parameters(spark):
    values = [[3] * 20, [1, 1, 1, 5, 5, 5, 1, 1, 1], *drawn()[:20]]
    short = [v[:14] for v in values]
    for least, penalty in ((3, 0), (2, 700)):
        assert series(spark, short, least_days=least, penalty=penalty) == [brute(v, least, penalty) for v in short]


def test_large_values_are_folded_in_decimals(spark):
    values = [[x * 10**9 for x in v] for v in ([1, 5, 2, 8, 900] * 4, [0] * 8 + [7] * 12)]
    values.append([-5, 3, -10**12, 10**12] * 5)
    got = series(spark, values)
    assert got == [[(*r[:4], r[4] if r[4] < 1 << 63 else None, *r[5:]) for r in brute(v)] for v in values]
    assert any(r[4] is None for v in got for r in v)
    values = [[x * 10**6 for x in v] for v in ([1, 5, 2, 8, 900] * 4, [0] * 8 + [7] * 12)]
    assert series(spark, values) == [brute(v) for v in values]


def taken(rows):
    out = {}
    for vendor, quantity, flag, at, *_ in rows:
        if flag in ("kept", "swapped") and quantity is not None and at is not None:
            days = out.setdefault(vendor, {})
            days[at.date()] = days.get(at.date(), 0) + quantity
    return out


def test_rows_to_segments(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(900):
        at = datetime(2024, 1, 1) + timedelta(days=rng.randint(0, 20), seconds=rng.randint(0, 86399))
        rows.append((rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, 0, 1, 9, 50]), rng.choice(["kept", "swapped", "returned", None]), rng.choice([at, at, at, None]), 1, "x"))
    rows += rows[:100] + [(9, 4, "kept", datetime(2023, 12, 30, 23, 59), 1, "x"), (9, 2, "kept", datetime(2024, 1, 3), 1, "x"), (8, None, "kept", None, 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = cp.change_points(docs.where("flag in ('kept', 'swapped') and quantity is not null and shipped_at is not null"), "vendor_id", cp.F.unix_date(cp.F.to_date("shipped_at")), cp.F.col("quantity"))
    want = []
    for vendor, days in taken(rows).items():
        first, last = min(days), max(days)
        values = [days.get(first + timedelta(days=k), 0) for k in range((last - first).days + 1)]
        base = (first - date(1970, 1, 1)).days
        want += [(vendor, no, base + a, *rest) for no, a, *rest in brute(values)]
    assert plain_rows(got) == sorted(want, key=repr)


def test_empty_table(spark):
    assert cp.change_points(spark.createDataFrame([], SCHEMA), "vendor_id", cp.F.lit(1), cp.F.col("quantity")).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_equals_its_sql(spark, folder):
    compare(spark, cp.query, cp.ORACLE_SQL)
    plan = cp.query(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
