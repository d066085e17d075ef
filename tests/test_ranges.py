"""Ordered computations where one key has all rows, dealt over many ranges."""

import random

import pytest

from tickweave.operators import integrity, planning, ranges, segments

SHAPES = {"one key": lambda r: "a", "a hot key": lambda r: "h" if r.random() < 0.7 else r.choice(["a", "b", "x", None])}


@pytest.fixture(params=sorted(SHAPES))
def rows(request):
    r = random.Random(request.param)
    return [(SHAPES[request.param](r), i, r.choice([1, 1, 2, 3]), r.choice([None, 0, 1, 5, 40])) for i in range(400)]


def _frame(spark, rows, parts=5):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    return spark.createDataFrame(rows, "k string, o long, v long, s long").repartition(3)


@pytest.fixture(autouse=True)
def settings(spark):
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    yield
    for c, v in before.items():
        spark.conf.set(c, v)


def _by_key(rows):
    out = {}
    for k, o, v, s in sorted(rows, key=lambda x: x[1]):
        out.setdefault(k, []).append((o, v, s))
    return out


def test_placed_and_previous(spark, rows):
    df = _frame(spark, rows)
    got = {(r["k"], r["o"]): (r["n"], r["before"]) for r in ranges.placed(df, ["k"], ["o"], "s").collect()}
    last = {(r["k"], r["o"]): r["p"] for r in ranges.with_previous(df, ["k"], ["o"], "v", "p").collect()}
    for k, group in _by_key(rows).items():
        total, before = 0, None
        for n, (o, v, s) in enumerate(group):
            assert got[k, o] == (n, total) and last[k, o] == before
            total, before = total + (s or 0), v


def _runs(values, goes_on):
    out = []
    for v in values:
        if out and goes_on(v, out[-1][-1]):
            out[-1].append(v)
        else:
            out.append([v])
    return out


def test_runs_go_over_ranges(spark, rows):
    df = _frame(spark, rows)
    got = sorted((str(r["k"]), r["start"], r["length"]) for r in segments.contiguous_runs(df, "v", ["k"], "o").collect())
    want = sorted((str(k), x[0], len(x)) for k, g in _by_key(rows).items() for x in _runs([v for _, v, _ in g], lambda v, last: v == last + 1))
    assert got == want
    got = {r["k"]: (r["n_rows"], r["longest"]) for r in segments.longest_identical(df, "k", "o", "v").collect()}
    assert got == {k: (len(g), max(map(len, _runs([v for _, v, _ in g], lambda v, last: v == last)))) for k, g in _by_key(rows).items()}


def test_one_run_over_all_ranges(spark):
    df = _frame(spark, [("a", i, i, None) for i in range(300)] + [("b", i, 9, None) for i in range(200)])
    assert sorted(tuple(r) for r in segments.contiguous_runs(df, "v", ["k"], "o").where("length > 1").collect()) == [("a", 0, 300)]
    assert {r["k"]: r["longest"] for r in segments.longest_identical(df, "k", "o", "v").collect()} == {"a": 1, "b": 200}


@pytest.mark.parametrize("length,inclusive", [(5, True), (5, False), (1000, False)])
def test_busiest_window_over_blocks(spark, rows, length, inclusive, monkeypatch):
    monkeypatch.setattr(ranges.with_halo, "__defaults__", ("n", 16))
    got = {r["k"]: (r["start"], r["total"]) for r in segments.busiest_window(_frame(spark, rows), "k", "o", "s", length, inclusive).collect()}
    for k, g in _by_key(rows).items():
        values = [s or 0 for _, _, s in g]
        starts = [0, *range(1, len(values) - length + (1 if inclusive else 0))]
        best = max(starts, key=lambda i: (sum(values[i : i + length]), -i))
        assert got[k] == (best, sum(values[best : best + length]))


def test_distinct_values_by_bitmaps(spark, rows):
    rows = [(k, o, v if o % 9 else None, s) for k, o, v, s in rows] + [("z", 1000 + i, -40_000 * i, 1) for i in range(5)]
    got = {r["k"]: (r["csv_rows"], r["distinct_frames"], r["decreases"]) for r in integrity.tick_summary(_frame(spark, rows), "k", "o", "v").collect()}
    for k, g in _by_key(rows).items():
        values = [v for _, v, _ in g]
        fell = sum(a is not None and b is not None and b < a for a, b in zip(values, values[1:]))
        assert got[k] == (sum(v is not None for v in values), len({v for v in values if v is not None}), fell)


def _next_fit(sizes, cap):
    bins, at, total = [], 0, 0
    for s in sizes:
        if total > 0 and total + s > cap:
            at, total = at + 1, 0
        bins.append(at)
        total += s
    return bins


@pytest.mark.parametrize("block,cap", [(10, 40), (100_000, 7)])
def test_bins_over_blocks(spark, rows, block, cap):
    got = planning.next_fit(_frame(spark, rows), "k", ["o"], "s", cap, block).orderBy("o").collect()
    assert len(got) == len(rows)
    for k, g in _by_key(rows).items():
        assert [r["bin"] for r in got if r["k"] == k] == _next_fit([s or 0 for _, _, s in g], cap)


def test_one_host_with_all_items(spark):
    r = random.Random(1)
    rows = [("host", i, 0, r.choice([0, 0, 3, 9, 60])) for i in range(2000)]
    got = planning.next_fit(_frame(spark, rows), "k", ["o"], "s", 50, 100).orderBy("o").collect()
    assert [x["bin"] for x in got] == _next_fit([x[3] for x in rows], 50)
    assert [x["n"] for x in got] == list(range(2000))


def test_empty_tables(spark):
    df = _frame(spark, [])
    for out in (planning.next_fit(df, "k", ["o"], "s", 5), segments.longest_identical(df, "k", "o", "v"), segments.contiguous_runs(df, "v", ["k"], "o"), segments.busiest_window(df, "k", "o", "s", 3), integrity.tick_summary(df, "k", "o", "v")):
        assert out.count() == 0
