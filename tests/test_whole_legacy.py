"""The older rules' folds run in batches of any size and never gather a vessel."""

import random

from seatracks.operators import legacy as L

from .test_operators import pings

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_batches_do_not_matter(spark):
    rng, rows = random.Random(7), []
    for v in range(30):
        t, lat = 0, 44.0
        for _ in range(rng.randrange(1, 60)):
            t += rng.choice([0, 60, 60, 60, 60, 4000])
            lat = round(lat + rng.choice([0, 0.00001, 0.003, 0.003, 0.003, 0.2]), 5)
            rows.append((v, t, 90 if rng.random() < 0.05 else lat, -63.0, rng.choice([0, 0, 0, 0, 5])))
    p = pings(spark, rows)
    before, got = spark.conf.get(KEY), []
    try:
        for n in ("10000", "1", "3"):
            spark.conf.set(KEY, n)
            points, rest = L.legacy_tracks(p, 1000, 160)
            clean = L.legacy_clean(p)
            got.append([sorted(map(repr, x.collect())) for x in (points, rest, *clean)])
    finally:
        spark.conf.set(KEY, before)
    assert got[0] == got[1] == got[2] and all(got[0])


def test_no_vessel_is_gathered(spark):
    for out in (L.legacy_tracks(pings(spark, [(1, 0, 44, -63)]), 1000, 160)[0], L.legacy_clean(pings(spark, [(1, 0, 44, -63)]))[0]):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" in plan and "FlatMapGroups" not in plan
