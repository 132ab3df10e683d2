"""Points in spans against all pairs, with hot bins, spans of all lengths and null ends."""

import random

from quire.operators import intervals


def test_same_as_all_pairs(spark):
    rng = random.Random(3)
    points = [(i, rng.randrange(3), rng.choice([-7, 0, 50, rng.randrange(-2000, 2000), rng.randrange(10**6)])) for i in range(400)] + [(900, 1, None), (901, None, 5)]
    spans = [(i, rng.randrange(3), a := rng.choice([-7, 50, rng.randrange(-3000, 3000)]), a + rng.choice([-1, 0, 3, 90, 5000, 10**6])) for i in range(150)] + [(900, 1, None, 5), (901, 1, 3, None), (902, None, 0, 9)]
    p, s = spark.createDataFrame(points, "p long, k long, at long"), spark.createDataFrame(spans, "s long, k long, low long, high long")
    fits = lambda x, y: None not in (x[2], y[2], y[3]) and y[2] <= x[2] <= y[3]
    for hot in (50_000, 20):
        got = sorted((r.p, r.s) for r in intervals.within(p, s, 10, ["k"], hot).collect())
        assert got == sorted((x[0], y[0]) for x in points for y in spans if fits(x, y) and x[1] == y[1] and x[1] is not None)
        got = sorted((r.p, r.s) for r in intervals.within(p.drop("k"), s.drop("k"), 10, hot=hot).collect())
        assert got == sorted((x[0], y[0]) for x in points for y in spans if fits(x, y))
    plan = intervals.within(p, s, 10, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_spans(spark):
    p, s = spark.createDataFrame([(1, 2)], "p long, at long"), spark.createDataFrame([(1, 5, 2)], "s long, low long, high long")
    assert intervals.within(p, s, 10).count() == 0
