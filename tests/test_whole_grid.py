"""The overlays keep every part of every segment."""

import math

from pyspark.sql import functions as F

from seatracks.plans import tracks as T

SF = "/root/testdata/sf0.001"


def test_clipped_lengths_add_up(spark):
    segments = {(r.mmsi, r.track_id): math.hypot(r.x2 - r.x1, r.y2 - r.y1) for r in T.q_p2p_segments(spark, SF).collect()}
    whole = T._grid(spark, SF)
    cut = T._interp_time(spark, SF).groupBy("mmsi", "track_id").agg(F.sum("grd_len_km").alias("km"), F.min("grid_id").alias("low"), F.max("grid_id").alias("high")).collect()
    assert {(r.mmsi, r.track_id) for r in cut} == {k for k, v in segments.items() if v > 0}
    assert all(math.isclose(r.km * 1000, segments[r.mmsi, r.track_id], rel_tol=1e-9) for r in cut)
    assert all(0 <= r.low <= r.high < whole.nx * whole.ny for r in cut)


def test_queries_of_the_grid(spark):
    km = sum(math.hypot(r.x2 - r.x1, r.y2 - r.y1) for r in T.q_p2p_segments(spark, SF).collect()) / 1000
    lengths, interp = T.q_grid_lengths(spark, SF).collect(), T.q_grid_interp(spark, SF).collect()
    timed, density = T.q_grid_interp_time(spark, SF).collect(), T.q_grid_density(spark, SF).collect()
    keys = sorted((r.mmsi, r.track_id, r.grid_id) for r in lengths)
    assert keys == sorted((r.mmsi, r.track_id, r.grid_id) for r in interp)
    with_length = {(r.mmsi, r.track_id, r.grid_id) for r in timed}
    assert with_length <= set(keys) and sum(r.n_lines for r in density) == len(timed) == len(with_length)
    assert abs(sum(r.total_len_km for r in density) - km) < 1e-6 * len(density)  # sums are rounded by cell


def test_lengths_carry_no_lines(spark):
    """Lengths by line and cell are sums of numbers: no column of vertices is shuffled or gathered."""
    import __spark_entry__ as entry

    plan = entry.queries()["grid_lengths"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
