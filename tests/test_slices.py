"""Vessels cut into slices of time give the rows of whole ones; the older rule for ends; one pass for all outputs."""

import random

import pytest
from pyspark.sql import functions as F

from seatracks.operators import segment as S

from .test_operators import pings


def walks(spark, seed, vessels=25, most=60, steps=(0, 60, 60, 60, 4000)):
    rng, rows = random.Random(seed), []
    for v in range(vessels):
        t, lat = 0, 44.0
        for _ in range(rng.randrange(1, most)):
            t += rng.choice(steps)
            lat = round(lat + rng.choice([0, 0.00001, 0.003, 0.003, 0.003, 0.2, -0.2, 47]), 5)
            rows.append((v, t, lat if rng.random() > 0.05 else 95, -63.0))
    return pings(spark, rows).withColumn("mmsi", F.when(F.col("mmsi") > 0, F.col("mmsi")))  # one has no number


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("shifted", [False, True])
def test_slices_of_a_few_reports(spark, shifted):
    p = walks(spark, 1).cache()
    for run in (lambda s: S.point_to_point(p, 600, slice_s=s), lambda s: S.threshold_points(p, 600, 160, slice_s=s, shifted_ends=shifted)):
        whole, sliced = run(None), run(300)
        for a, b in zip(whole, sliced, strict=True):
            assert rows_of(a) == rows_of(b) and a.count()


def test_hot_vessels_only(spark):
    p = walks(spark, 2, vessels=8).unionByName(pings(spark, [(99, 60 * i, 44 + i * 0.002, -63) for i in range(600)]))
    run = lambda q, s: S.threshold_points(q, 600, 160, slice_s=s)
    for a, b in zip(run(p, None), S.hot_vessels(p, run, 300, share=4), strict=True):
        assert rows_of(a) == rows_of(b)


def test_one_scan_and_one_exchange(spark, tmp_path):
    walks(spark, 3, vessels=3).write.parquet(str(tmp_path / "p"))
    p = spark.read.parquet(str(tmp_path / "p"))
    points, discards = S.threshold_points(p, 600, 160)
    for df in (points, discards, S.point_to_point(p, 600)[1]):
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[-1]
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan parquet") == 1, plan


def test_a_slice_is_a_task_of_its_own(spark):
    """The vessel with most reports has as many groups as slices; no window holds more than one of them."""
    p = pings(spark, [(1, 60 * i, 44 + i * 0.001, -63) for i in range(1000)])
    points, _ = S.threshold_points(p, 600, 160, slice_s=3000)
    assert points.count() == 1000 and points.select("segidx").distinct().count() == 1
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(_v" in plan and "_slice" in plan


def ends(spark, lats, shifted):
    """Latitudes a minute apart; the threshold is 160 km/h, a step of 0.02 is 133."""
    points, discards = S.threshold_points(pings(spark, [(1, 60 * i, lat, -63) for i, lat in enumerate(lats)]), 600, 160, shifted_ends=shifted)
    return sorted(round(r.latitude, 2) for r in points.collect()), sorted((round(r.latitude, 2), r.reason) for r in discards.collect())


def test_fast_second_and_last_but_one_point(spark):
    first = [44.00, 44.50, 44.02, 44.04, 44.06, 44.08]  # the second is fast to and from
    assert ends(spark, first, False) == ([44.00, 44.02, 44.04, 44.06, 44.08], [(44.5, S.FAST)])
    assert ends(spark, first, True) == ([44.02, 44.04, 44.06, 44.08, 44.5], [(44.5, S.FAST)])  # 44.00 is lost
    last = [44.00, 44.02, 44.04, 44.06, 44.50, 44.08]
    assert ends(spark, last, False) == ([44.00, 44.02, 44.04, 44.06, 44.08], [(44.5, S.FAST)])
    assert ends(spark, last, True) == ([44.00, 44.02, 44.04, 44.06, 44.5], [(44.5, S.FAST)])
    inner = [44.00, 44.02, 44.50, 44.04, 44.06]
    assert ends(spark, inner, True) == ends(spark, inner, False)
    fast = [44.0, 45.0, 44.0, 45.0]
    want = ([], sorted([(44.0, S.FEW), (44.0, S.FAST), (45.0, S.FAST), (45.0, S.FEW)]))
    assert ends(spark, fast, False) == ends(spark, fast, True) == want


def test_chunks_are_the_track(spark):
    p = pings(spark, [(v, 60 * i, 44 + i * 0.01, -63 + v) for v, n in ((1, 1), (2, 4), (3, 5), (4, 9), (5, 23)) for i in range(n)]).withColumn("segidx", F.lit(0).cast("long"))
    chunks = S.track_chunks(p, size=4).collect()
    for v, n in ((1, 1), (2, 4), (3, 5), (4, 9), (5, 23)):
        mine = sorted((r.chunk, [q.y for q in r.vertices]) for r in chunks if r.mmsi == v)
        assert all(len(ys) <= 5 for _, ys in mine) and all(a[-1] == b[0] for (_, a), (_, b) in zip(mine, mine[1:], strict=False))
        assert [y for k, ys in mine for y in ys[k > 0 :]] == [44 + i * 0.01 for i in range(n)] and (n == 1 or all(len(ys) > 1 for _, ys in mine))
    lines = S.track_lines(S.build_tracks(p), S.track_chunks(p, size=4)).where("mmsi = 3").first()
    assert lines.wkt == "LINESTRING (" + ", ".join(f"-60.0 {44 + i * 0.01}" for i in range(5)) + ")" and lines.seg_pts == 5


def test_no_row_of_build_tracks_holds_a_track(spark):
    points = walks(spark, 5, vessels=2).withColumn("segidx", F.lit(0).cast("long"))
    assert "collect_list" not in S.build_tracks(points)._jdf.queryExecution().toString()
