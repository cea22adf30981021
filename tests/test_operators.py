"""Hand-made cases for the operators that SQL does not cover."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from seatracks.functions import geo
from seatracks.operators import decode as D
from seatracks.operators import encode as E
from seatracks.operators import grid as G
from seatracks.operators import legacy as L
from seatracks.operators import normalize as N
from seatracks.operators import segment as S
from seatracks.operators.layouts import LAYOUTS, LENGTHS, SHIP_TYPES, TEXT, fields, width
from seatracks.schema import PING
from seatracks.sources import readers as R
from seatracks.sources import writers as W
from seatracks.streaming import nm4 as ST

from .test_projections import transverse

T0 = dt.datetime(2020, 1, 1)


def pings(spark, rows):
    """(mmsi, seconds, latitude, longitude[, status])"""
    return spark.createDataFrame([(r[0], T0 + dt.timedelta(seconds=r[1]), 1, r[4] if len(r) > 4 else 0, 5.0, 0.0, 0.0, float(r[2]), float(r[3])) for r in rows], PING)


def test_point_to_point_cases(spark):
    p = pings(spark, [(1, 0, 44, -63), (2, 0, 91, -63), (2, 9, 44, -63), (3, 0, 44, -63), (3, 60, 44, -63), (3, 120, 44.01, -63), (3, 220, 44.02, -63), (3, 321, 44.03, -63)])
    pairs, discards = S.point_to_point(p, 100)
    assert sorted((r.mmsi, r.segidx, r.latitude) for r in pairs.collect()) == [(3, 0, 44.0), (3, 1, 44.01)]
    got = sorted((r.mmsi, r.reason) for r in discards.collect())
    assert got == sorted([(1, S.STRANDED), (2, S.OUT_OF_RANGE), (2, S.STRANDED), (3, S.DUPLICATE[0]), (3, S.DUPLICATE[1]), (3, S.LATE[0]), (3, S.LATE[1])])


def test_one_exchange_for_a_vessel_chain(spark):
    points, _ = S.threshold_points(pings(spark, [(1, 0, 44, -63)]), 100, 160)
    plan = S.build_tracks(points)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(mmsi") == 1


def test_threshold_points_against_a_plain_walk(spark):
    import random

    rng, rows = random.Random(4), []
    for v in range(60):
        t, lat = 0, 44.0
        for _ in range(rng.randrange(1, 25)):
            t += rng.choice([0, 60, 60, 60, 4000])
            lat = round(lat + rng.choice([0, 0.00001, 0.003, 0.003, 0.003, 0.2]), 5)
            rows.append((v, t, lat, -63.0))
    points, _ = S.threshold_points(pings(spark, rows), 600, 160)
    got = sorted((r.mmsi, (r.time - T0).total_seconds(), r.latitude, r.segidx) for r in points.collect())

    def km(a, b):
        return 2 * 6367 * math.asin(math.sin(abs(math.radians(a[2] - b[2])) / 2))

    want = []
    for v in range(60):
        mine = sorted({(i, r) for i, r in enumerate(rows) if r[0] == v}, key=lambda x: (x[1][1], x[1][2]))
        p = [r for _, r in mine]
        if len(p) < 3:
            continue
        good = [i for i in range(len(p) - 1) if p[i][1] != p[i + 1][1] and p[i][2] != p[i + 1][2]]
        if len(good) < 2:
            continue
        p = [p[i] for i in good] + [p[good[-1] + 1]]
        speed = [km(a, b) / (b[1] - a[1]) for a, b in zip(p, p[1:], strict=False)]
        p = [x for i, x in enumerate(p) if not (0 < i < len(p) - 1 and speed[i - 1] > 160 / 3600 and speed[i] > 160 / 3600)]
        if len(p) < 3:
            continue
        prior, seg = True, 0
        for i, x in enumerate(p):
            stop = i < len(p) - 1 and (km(x, p[i + 1]) / 1.852 / ((p[i + 1][1] - x[1]) / 3600) < 0.5 or p[i + 1][1] - x[1] > 600)
            if prior and (stop or i == len(p) - 1):
                continue
            want.append((v, float(x[1]), x[2], seg))
            seg, prior = seg + (stop and not prior), stop
    assert got == sorted(want) and got


def test_legacy_rules(spark):
    p = pings(spark, [(1, 0, 44, -63), (1, 0, 45, -63), (1, 60, 44, -63), (1, 120, 90, -63), (1, 180, 44.01, -63), (1, 240, 44.02, -63), (1, 300, 44.03, -63), (1, 5000, 44.04, -63), (1, 5060, 44.05, -63)])
    accepted, rest = L.legacy_clean(p)
    assert sorted(r.reason for r in rest.collect()) == [L.INVALID, L.STATIONARY, L.STATIONARY] and accepted.count() == 6
    good, bad = L.legacy_build_segments(L.legacy_point_to_point(accepted), 1000)
    assert good.count() == 4 and {r.reason: r.n for r in bad.collect()} == {"time": 1}
    points, orphans = L.legacy_tracks(p, 1000, 160)
    assert sorted((r.segidx, r.latitude) for r in points.collect()) == [(0, 44.0), (0, 44.01), (0, 44.02), (0, 44.03), (1, 44.04), (1, 44.05)]
    lines, dots = L.legacy_layers(points)
    assert sorted((r.track_id, r.seg_pts, r.bad_spd) for r in lines.collect()) == [(0, 4, 0), (1, 2, 0)] and dots.count() == 6
    spike = pings(spark, [(2, 0, 44, -63), (2, 60, 44.01, -63), (2, 120, 50, -63), (2, 180, 44.02, -63), (2, 240, 44.03, -63), (3, 0, 44, -63), (4, 0, 44, -63), (4, 60, 44.1, -63, 5)])
    points, orphans = L.legacy_tracks(spike, 1000, 160)
    assert sorted((r.mmsi, r.latitude, r.reason) for r in orphans.collect()) == [(2, 50.0, L.ORPHAN), (3, 44.0, L.ORPHAN), (4, 44.0, L.ORPHAN), (4, 44.1, L.ORPHAN)]


def test_projections(spark):
    one = spark.createDataFrame([(-63.0, 44.0)], "lon double, lat double")
    at = lambda epsg: [round(v, 2) for v in one.select(*geo.project_point("lon", "lat", epsg)).first()]
    assert at(4326) == [-63.0, 44.0] and at(3857) == [-7013127.92, 5465442.18]
    assert at(32620)[0] == 500000.0 and abs(at(32620)[1] - transverse(-63.0, 44.0, 20)[1]) < 0.01
    x, y = at(32720)
    assert y == round(at(32620)[1] + 1e7, 2)
    with pytest.raises(ValueError, match="EPSG"):
        geo.project_point("lon", "lat", 2154)


def test_grid_cases(spark):
    grid = G.Grid(0, 0, 1, 3, 3)
    line = lambda *v: [{"x": float(x), "y": float(y)} for x, y in v]
    data = [(1, line((0.2, 0.2), (0.8, 0.8))), (2, line((0.5, 0.5), (2.5, 0.5))), (3, line((0.5, 0.5), (1.5, 1.5))), (4, line((1, 0.2), (1, 0.8))), (5, line((5, 5), (6, 6))), (6, line((0.5, 0.5), (1.5, 0.5), (1.5, 2.5)))]
    lines = spark.createDataFrame(data, "id long, vertices array<struct<x:double,y:double>>")
    got = {(r.id, r.grid_id): round(r.grd_len_km * 1000, 6) for r in G.grid_length(lines, grid, ["id"]).collect()}
    d = round(math.sqrt(0.5), 6)
    want = {(1, 0): round(math.sqrt(0.72), 6), (2, 0): 0.5, (2, 3): 1.0, (2, 6): 0.5, (3, 0): d, (3, 4): d, (3, 1): 0.0, (3, 3): 0.0, (4, 0): 0.6, (4, 3): 0.6, (6, 0): 0.5, (6, 3): 1.0, (6, 4): 1.0, (6, 5): 0.5}
    assert got == want
    assert {(r.id, r.grid_id) for r in G.grid_intersect(lines, grid, ["id"]).collect()} == set(want)
    with pytest.raises(ValueError, match="EPSG"):
        G.grid_length(lines, grid, ["id"], lines_epsg=3857)
    made = G.make_grid(spark, 0, 2.5, 0, 2, 4326, 1)
    assert (made.nx, made.ny, made.xmin, made.ymin) == (3, 2, -0.25, 0.0) and made.cells(spark).count() == 6
    square = spark.createDataFrame([(7, line((0, 0), (1, 0), (1, 1), (0, 1)))], "cid long, vertices array<struct<x:double,y:double>>")
    seg = spark.createDataFrame([(1, -0.5, 0.5, 0.5, 0.5), (2, 3.0, 3.0, 4.0, 4.0)], "id long, x1 double, y1 double, x2 double, y2 double")
    assert [(r.id, r.grid_id, r.grd_len_km) for r in G.polygon_length(seg, square, "cid", 0.4).collect()] == [(1, 7, 0.0005)]


def sentence_lines(spark, rows):
    return spark.createDataFrame([("f", i, f"d{i}", s) for i, s in enumerate(rows)], "path string, line_no long, date string, sentence string")


def signed(body):
    x = 0
    for c in body:
        x ^= ord(c)
    return f"!{body}*{x:02X}"


def test_sentences_and_assembly(spark):
    rows = [signed("AIVDM,1,1,,A,1P000,0") + ",r003", "noise", signed("AIVDM,1,1,,A,1P000"), signed("AIVDM,1,1,,A,1P000,0")[:-2] + "ZZ", "!AIVDM,1,1,,A,1P000,0*00"]
    rows += [signed("AIVDM,2,1,1,A,aa,0"), signed("AIVDM,2,1,2,B,cc,0"), signed("AIVDM,2,2,1,A,bb,2"), signed("AIVDM,2,2,2,B,dd,1"), signed("AIVDM,3,1,3,A,ee,0"), signed("AIVDM,3,3,3,A,ff,0"), signed("AIVDM,2,2,4,B,gg,0")]
    ok, bad = D.verify_sentences(sentence_lines(spark, rows))
    assert {r.line_no: r.reject_reason for r in bad.collect()} == {1: "no sentence", 2: "too few tokens", 3: "no checksum", 4: "bad checksum"}
    assert sorted((r.line_no, r.payload, r.pad, r.date) for r in D.assemble(ok).collect()) == [(0, "1P000", 0, "d0"), (7, "aabb", 2, "d5"), (8, "ccdd", 1, "d6")]


def test_every_layout_round_trips(spark):
    chains = {
        "cnb": (2, ["cnb"]), "type4": (11, ["type4"]), "type7": (13, ["type7"]), "type8_dac1_fid11": (8, ["type8", "type8_dac1_fid11"]), "type6_dac235_fid10": (6, ["type6", "type6_dac235_fid10"]), "type9": (9, ["type9"]), "type15": (15, ["type15"]), "type16": (16, ["type16"]),
        "type18": (18, ["type18"]), "type19": (19, ["type19"]), "type20": (20, ["type20"]), "type21": (21, ["type21"]), "type22": (22, ["type22"]), "type23": (23, ["type23"]), "type24a": (24, ["type24", "type24a"]), "type27": (27, ["type27"]),
    }
    force = {"partno": 0, "dac": {"type8_dac1_fid11": 1, "type6_dac235_fid10": 235}, "fid": {"type8_dac1_fid11": 11, "type6_dac235_fid10": 10}, "epfd": 3, "stationtype": 7}
    for name, (kind, parts) in chains.items():
        values = {"msgtype": kind, "repeat": 1, "mmsi": 316000123}
        for k, f in enumerate(LAYOUTS[name][1][3:]):
            v = force.get(f.name, None)
            v = v.get(name, 0) if isinstance(v, dict) else v
            values[f.name] = v if v is not None else "AB C" if f.kind == "c" else -(k + 1) if f.kind == "s" else (k * 7 + 1) % (1 << min(f.width, 20))
        bits = E.bits_of(parts, {n: F.lit(v) for n, v in values.items()})
        low, high = LENGTHS[kind]
        n = max(low, min(E.bits_in(parts), high))  # some layouts are shorter or longer than their messages may be
        payload, pad = E.armour(F.rpad(F.substring("bits", 1, n), n, "0"), n)
        packet = D.once(D.once(spark.range(1), bits=bits), payload=payload).select(F.lit("f").alias("path"), F.lit(0).alias("line_no"), F.lit("r").alias("raw"), "payload", F.lit(pad).alias("pad"), F.lit("d").alias("date"))
        row = D.decode(packet, types=(kind,))[name].first().asDict()
        if name == "type21":
            values["name"] += values.pop("name_ext")
        inside = {f.name for f in LAYOUTS[name][1] if f.at + f.width <= n}
        assert {k: row[k] for k in values if k in inside} == {k: v for k, v in values.items() if k in inside}, name


def test_layout_facts():
    assert width(TEXT["cnb"]) == 130 and len(SHIP_TYPES) == 100 and SHIP_TYPES[52] == "Tug" and SHIP_TYPES[70] == "Cargo - all ships of this type"
    assert [f.at for f in fields("a:u2 _:3 b:s4", 38)] == [38, 43]
    assert set(range(1, 28)) - {t for types, _ in LAYOUTS.values() for t in types} == {26}


def test_failfast(spark):
    packet = spark.createDataFrame([("f", 0, "r", "1000", 0, "d")], "path string, line_no long, raw string, payload string, pad int, date string")
    assert D.malformed(packet).count() == 1 and D.decode(packet)["rejects"].count() == 1
    with pytest.raises(Exception, match="rejected message"):
        D.decode(packet, mode="failfast")["cnb"].select("status").collect()


def test_scalars(spark):
    df = spark.createDataFrame([("1.25E+1.0", "20150102T030405.600Z", "20150102_030405", "n/a")], "x string, t string, u string, s string")
    r = df.select(N.fix_exponent(F.col("x")).alias("x"), N.parse_ais_time(F.col("t")).alias("t"), N.parse_ais_time(F.col("u"), "_").alias("u"), N.parse_ais_time(F.col("t"), "round").alias("r"), N.parse_sog(F.col("s")).alias("s"), N.is_int32(F.lit("2147483648")).alias("i"), N.ewkt(F.lit(181.0), F.lit(1.0)).alias("w"), geo.point_wkt(F.lit(1.5), F.lit(2.0)).alias("p")).first()
    assert (r.x, r.t, r.u, r.s, r.i, r.w, r.p) == ("1.25E+1", dt.datetime(2015, 1, 2, 3, 4, 5), dt.datetime(2015, 1, 2, 3, 4, 5), 102.3, False, None, "POINT (1.500000 2.000000)")
    assert r.r == dt.datetime(2015, 1, 2, 3, 4, 6)


def test_receiver_dates_across_clock_changes(spark):
    log = ["!x", "01,11,15,01,30,00,AST data:", "!a", "", "01,07,15,12,00,00,ADT data:", "!b"]
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(log)], "path string, line_no long, line string")
    assert [(r.sentence, r.date) for r in R.receiver_dates(lines).orderBy("line_no").collect()] == [("!x", None), ("!a", "20151101T053000.000Z"), ("!b", "20150701T150000.000Z")]


def test_files_keep_their_order(spark, tmp_path):
    text = "".join(f"20150102T030405.000Z {signed(f'AIVDM,1,1,,A,{i},0')}\n" for i in range(3000))
    (tmp_path / "a.nm4").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        got = [(r.line_no, r.sentence) for r in R.read_nm4(spark, str(tmp_path / "a.nm4")).orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i + 1, signed(f"AIVDM,1,1,,A,{i},0")) for i in range(3000)]
    ee = spark.createDataFrame([("p", 1, "\\s:1,c:2*00\\!AIVDM,x")], "path string, line_no long, line string")
    assert R.sentences(ee, "ee").first().sentence == "!AIVDM,x"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, "a"), (4, 6, None)], "msgtype int, mmsi long, name string")
    W.write_by_message(df, str(tmp_path / "by"))
    assert {r.msg_group for r in spark.read.text(str(tmp_path / "by")).collect()} == {"1_2_3", "4_11"}
    assert sorted(r.value for r in W.format_messages(df, "dsv").collect()) == ["1|5|a", "4|6|"]
    seg = spark.createDataFrame([(1, "LINESTRING (1.0 2.0, 3.0 4.0)")], "mmsi long, wkt string")
    W.write_lines(seg, str(tmp_path / "g"), "geojsonl")
    assert '"coordinates":[[1.0,2.0],[3.0,4.0]]' in spark.read.text(str(tmp_path / "g")).first().value


def test_stream_assembly(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [signed("AIVDM,2,1,1,A,aa,0"), signed("AIVDM,2,2,1,A,bb,2"), signed("AIVDM,2,2,1,A,cc,0"), signed("AIVDM,1,1,,A,dd,0")]
    (tmp_path / "in" / "a.txt").write_text("".join(f"d{i} {s}\n" for i, s in enumerate(rows)))
    stream = ST.stream_nm4(spark, str(tmp_path / "in"))
    assert [r.payload for r in ST.run_available(ST.stream_packets(stream), str(tmp_path / "one")).collect()] == ["dd"]
    got = ST.run_available(ST.stream_assembled(stream), str(tmp_path / "two")).collect()
    assert [(r.payload, r.pad, r.date) for r in got] == [("aabb", 2, "d0")]
