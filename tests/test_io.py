"""Files written and read back; provider rules; inventories; datums."""

import os

import pytest
from pyspark.sql import functions as F

from seamark.functions import clock, text
from seamark.operators import datums, deployments, horizon, mesh, stations
from seamark.sinks import tables as sink_tables
from seamark.sinks import text as sink_text
from seamark.sources import control_files, model, payloads, polygons, providers, series_text, tables
from seamark.streaming import incremental

T0 = 1704067200


def test_series_files_round_trip(spark, series, tmp_path):
    df = series([1.23456, None, -1234.0, 7.0], step=360)
    path = str(tmp_path / "out")
    sink_text.write_lines(sink_text.series_lines(df, ["station_id"]), path, ["station_id"])
    back = series_text.parse_series(spark.read.text(path), keep=("station_id",)).orderBy("ts").collect()
    assert [r["value"] for r in back] == [1.2346, None, None, 7.0]
    assert [int(r["ts"].timestamp()) - T0 for r in back] == [0, 360, 720, 1080]


def test_series_line_format(spark, series):
    line = sink_text.series_lines(series([0.5]), ["station_id"]).first()["line"]
    assert line == "2460310.50000000 2024  1  1  0  0    0.5000"
    df = spark.createDataFrame([("a", T0, 0.5, 90.0)], "station_id string, t bigint, speed double, dir_deg double")
    line = sink_text.vector_lines(df.withColumn("ts", F.timestamp_seconds("t")), ["station_id"]).first()["line"]
    assert line.endswith("   0.5000   90.0000    0.5000    0.0000")


def test_read_series_takes_keys_from_the_file_name(spark, tmp_path):
    (tmp_path / "8551910_sysx_wl_nowcast.prd").write_text("2460310.5 2024 1 1 0 6  0.25\nbroken\n\n")
    r = series_text.read_series(spark, str(tmp_path)).collect()
    assert len(r) == 1
    assert (r[0]["station_id"], r[0]["system"], r[0]["variable"], r[0]["cast"], r[0]["value"]) == ("8551910", "sysx", "wl", "nowcast", 0.25)


def test_station_control_file(spark, tmp_path):
    (tmp_path / "x.ctl").write_text(
        'A1 A1_wl_sys_GAUGE "North Pier"\n  38.100 -75.200 -0.21  0.00  MLLW\n'
        'B2_b03 B2_b03_cu_sys_METER "Buoy (bin 03)"\n  38.5 -75.6 0.0  4.50  0.0  1.50  up\n'
        'C3 C3_wl_sys_GAUGE "Far"\n  39.0 -76.0 RANGE  0.00  NAVD88\n'
    )
    r = {x["station_id"]: x for x in control_files.read_station_control(spark, str(tmp_path)).collect()}
    assert r["A1"]["name"] == "North Pier" and r["A1"]["datum_shift"] == -0.21 and r["A1"]["source"] == "GAUGE"
    assert r["B2_b03"]["height_from_bottom"] == 1.5 and r["B2_b03"]["mounting"] == "up"
    assert r["C3"]["datum_shift"] is None and r["C3"]["shift_status"] == "RANGE"


def test_skill_tables_keep_the_last_row(spark, tmp_path):
    for name, v in (("a_wl_water_level_nowcast.csv", "1.0"), ("b_wl_water_level_nowcast.csv", "2.0"), ("c_temperature_forecast_b.csv", "3.0")):
        (tmp_path / name).write_text(f"ID,rmse\nS1,{v}\n")
    r = {(x["variable"], x["cast"]): x["rmse"] for x in tables.read_skill_tables(spark, str(tmp_path)).collect()}
    assert r == {("Water Level", "Nowcast"): "2.0", ("Temperature", "Forecast (B)"): "3.0"}


def test_thresholds_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text("name_var,X1,X2\nwl,0.2,0.6\n")
    r = {x["variable"]: x["x1"] for x in tables.read_thresholds(spark, str(tmp_path / "e.csv")).collect()}
    assert r["wl"] == 0.2 and r["salt"] == 3.5


def test_overrides_file(spark, tmp_path):
    (tmp_path / "bins.csv").write_text("# comment\nstation_id,bin,depth,orientation,name\nq1,1,4.5,up,\nq1,x,1,,\n,2,1,,\nq1,2,deep,,mid\n")
    r = {x["bin"]: x for x in tables.read_overrides(spark, str(tmp_path / "bins.csv")).collect()}
    assert set(r) == {1, 2} and r[1]["depth"] == 4.5 and r[2]["depth"] is None and r[2]["name"] == "mid"


def test_grid_json_round_trip_and_ascii(spark, tmp_path):
    rows = [("s", T0, i, j, 30.0 + i, -70.0 + j * 0.5, None if i == j else float(i * 10 + j)) for i in range(2) for j in range(3)]
    g = spark.createDataFrame(rows, "source string, t bigint, iy int, ix int, lat double, lon double, value double").withColumn("ts", F.timestamp_seconds("t"))
    j = sink_text.grid_json(g).first()["json"]
    (tmp_path / "f_20240101-06.json").write_text(j)
    back = payloads.read_grids(spark, str(tmp_path)).collect()
    assert sorted((r["iy"], r["ix"], r["lat"], r["lon"], r["value"]) for r in back if r["value"] is not None) == sorted(
        (i, k, a, o, v) for _, _, i, k, a, o, v in rows if v is not None
    )
    assert len(back) == 6 and back[0]["ts"].hour == 6
    body = [r["line"] for r in sink_text.ascii_rows(g, ["source"]).orderBy(F.desc("row_lat")).collect()]
    assert body == ["10 -9999 12", "-9999 1 2"]
    h = sink_text.ascii_header(g, ["source"]).first()
    assert (h["ncols"], h["nrows"], h["xllcorner"], h["cellsize"], h["dx"], h["dy"]) == (3, 2, -70.25, None, 0.5, 1.0)
    out = str(tmp_path / "asc")
    sink_text.write_ascii(g, out, ["source"])
    lines = [r["value"] for r in spark.read.text(out).collect()]
    assert lines[0] == "ncols        3" and lines[-2:] == body


@pytest.mark.parametrize("v,want", [(0.5, "0.5"), (0.0, "0"), (-9999.0, "-9999"), (12.345678, "12.3457"), (123456.0, "123456"), (0.001234567, "0.00123457"), (100.0, "100")])
def test_short_numbers(spark, v, want):
    d = spark.createDataFrame([(v,)], "v double")
    assert d.select(sink_text.short_number(F.col("v"))).first()[0] == want


def test_upsert_ignores_known_keys(spark):
    old = spark.createDataFrame([("wl", "a", 1)], "product string, station_id string, seq int")
    new = spark.createDataFrame([("wl", "a", 2), ("wl", "b", 4), ("wl", "b", 3)], old.schema)
    r = sink_tables.insert_or_ignore(old, new, ["product", "station_id"], "seq").collect()
    assert [(x["station_id"], x["seq"]) for x in r] == [("b", 3)]
    again = old.unionByName(spark.createDataFrame([("wl", "b", 3)], old.schema))
    assert sink_tables.insert_or_ignore(again, new, ["product", "station_id"]).count() == 0


def test_incremental_append_is_idempotent(spark, tmp_path):
    src, target, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    os.mkdir(src)
    with open(f"{src}/A1_wl.obs", "w") as f:
        f.write("2460310.5 2024 1 1 0 0 1.0\n2460310.5 2024 1 1 0 6 2.0\n")
    for name in ("ck1", "ck2"):  # a second query without history sees the same file again
        q = incremental.append_new(incremental.series_stream(spark, src), target, ["station_id", "ts"], checkpoint=ck + name)
        q.awaitTermination(60)
    rows = spark.read.parquet(target).orderBy("ts").collect()
    assert [(r["station_id"], r["value"]) for r in rows] == [("A1", 1.0), ("A1", 2.0)]


def test_buoy_temperature_prefers_the_ocean_sensor(spark):
    df = spark.createDataFrame([("b", 1, "MM", "12.0", "3"), ("b", 2, "20.5", "12.0", "3"), ("b", 3, "999", "12.0", "3")], "station_id string, ts int, OTMP string, WTMP string, DEPTH string")
    r = providers.buoy_rows(df, "temp").collect()
    assert [(x["ts"], x["value"], x["depth"]) for x in r] == [(2, 20.5, 3.0)]
    r = providers.buoy_rows(df.drop("OTMP"), "temp").collect()
    assert [x["value"] for x in r] == [12.0] * 3 and r[0]["depth"] == 0.0


def test_gauge_units(spark):
    df = spark.createDataFrame([("wl", "00065", 10.0), ("temp", "00011", 50.0), ("salt", "00095", 1000.0), ("cu", "70232", 1.0), ("temp", "00010", 9.0)], "variable string, code string, value double")
    r = {x["code"]: (round(x["value"], 6), x["datum"]) for x in providers.gauge_units(df).collect()}
    assert r == {"00065": (3.048, "NAVD88"), "00011": (10.0, None), "00095": (0.64, None), "70232": (0.5144, None), "00010": (9.0, None)}


def test_model_concat_keeps_last_or_first(spark):
    df = spark.createDataFrame([(1, T0 + 29, 1, 1.0), (1, T0, 2, 2.0), (1, T0 + 31, 2, 3.0)], "node_id int, t bigint, f int, value double").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    last = model.concat_runs(df, ["node_id"], cast="nowcast", file_order="f").orderBy("ts").collect()
    first = model.concat_runs(df, ["node_id"], cast="forecast_a", file_order="f").orderBy("ts").collect()
    assert [r["value"] for r in last] == [2.0, 3.0] and [r["value"] for r in first] == [1.0, 3.0]


def test_file_names_and_valid_times(spark):
    names = ["sys.t06z.20240102.fields.n003.nc", "sys.t06z.20240102.fields.f012.nc", "old.sys.fields.n006.20240102.t12z.nc", "sys.t00z.20240102.fields.hindcast.nc", "junk"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(clock.valid_time_of_file(F.col("name"))).collect()]
    assert [None if g is None else (g.day, g.hour) for g in got] == [(2, 3), (2, 18), (2, 12), (2, 0), None]


def test_wkt_main_ring(spark):
    df = spark.createDataFrame([("d", "POLYGON ((0 0, 4 0, 4 3, 0 3, 0 0), (1 1, 2 1, 1 2, 1 1))")], "domain string, wkt string")
    r = polygons.main_ring(polygons.parse_wkt(df)).first()
    assert r["ring"] == 0 and (r["lat_max"], r["lon_max"]) == (3.0, 4.0)


def test_two_stations_with_one_name_survive(spark):
    rows = [("G", "1", 1.0, 2.0, "Pier", True, None), ("G", "2", 1.005, 2.0, "Pier", False, False), ("G", "1", 9.0, 9.0, "Other", False, False)]
    df = spark.createDataFrame(rows, "Source string, ID string, X double, Y double, Name string, has_wl boolean, has_temp boolean").withColumn("seq", F.monotonically_increasing_id())
    r = {x["ID"]: x for x in stations.dedup_inventory(stations.merge_inventories(df), ["priority", "seq"]).collect()}
    assert set(r) == {"1", "2"} and r["1"]["X"] == 1.0 and r["1"]["has_wl"] and r["1"]["has_temp"] and not r["2"]["has_wl"]


def test_name_duplicates(spark):
    df = spark.createDataFrame([("41001", "41001 - east"), ("st1", "pier"), ("st2", "near 41001"), ("q", "quay")], "ID string, Name string").withColumn("n", F.monotonically_increasing_id())
    assert stations.drop_name_duplicates(df, order="n").count() == 3  # 'q' starts 'quay'; 41001 occurs further in


@pytest.mark.parametrize("raw,want", [("Horizontal", "side"), ("h", "side"), ("upward", "up"), (" D ", "down"), (None, "unknown"), ("", "unknown"), ("side-looking", "side")])
def test_mounting_symbols(spark, raw, want):
    d = spark.createDataFrame([(raw,)], "m string")
    assert d.select(text.mounting_symbol(F.col("m"))).first()[0] == want


def test_virtual_stations(spark):
    bins = spark.createDataFrame(
        [("q", "Pier", 1, 3.0, False, 1.0, "up"), ("q", "Pier", 2, None, True, 1.0, "up"), ("r", "Quay", 1, None, True, None, None)],
        "station_id string, name string, bin int, depth double, depth_unknown boolean, height_from_bottom double, mounting string",
    )
    over = spark.createDataFrame([("q", 2, 6.0, None, "deep"), ("q", 9, None, None, None)], "station_id string, bin int, depth double, orientation string, name string")
    out, absent = stations.virtual_stations(bins, over)
    r = {x["virtual_id"]: x for x in out.collect()}
    assert set(r) == {"q_b02", "r_b01"}
    assert r["q_b02"]["label"] == "Pier (bin 02 / deep)" and r["q_b02"]["depth"] == 6.0 and r["q_b02"]["height_from_bottom"] == 0.0
    assert r["r_b01"]["label"] == "Quay (bin 01, depth unknown)" and r["r_b01"]["mounting"] == "unknown"
    assert [(x["station_id"], x["bin"]) for x in absent.collect()] == [("q", 9)]


def test_bin_shift(spark):
    rows = [("a", 1, 1, 2.0), ("a", 1, 2, 4.0), ("a", 2, 1, 2.0), ("a", 2, 2, 4.5), ("b", 1, 1, 2.0), ("b", 2, 1, 2.0), ("c", 1, 1, 2.0), ("d", 1, 1, 2.0), ("d", 2, 2, 2.0)]
    df = spark.createDataFrame(rows, "station_id string, deployment int, bin int, distance double")
    r = {x["station_id"]: x["shifted"] for x in deployments.shifted_bins(df, ["station_id"]).collect()}
    assert r == {"a": True, "b": False, "c": False, "d": True}


def test_datum_shift_ignores_failure_codes(spark):
    d = spark.createDataFrame([(1.0, 0.25), (1.0, -9991.0), (1.0, 99999.0)], "v double, o double")
    assert [r[0] for r in d.select(datums.apply_shift(F.col("v"), F.col("o"))).collect()] == [0.75, 1.0, 1.0]


def test_sentinel_mask_and_report(spark):
    d = spark.createDataFrame([("s", "temp", -999.0), ("s", "temp", -596.9), ("s", "temp", 12.0), ("s", "salt", float("nan")), ("s", "zeta", 998.0)], "station_id string, var string, value double")
    got = [r["value"] for r in mesh.mask_unphysical(d).collect()]
    assert got == [None, None, 12.0, None, 998.0]
    r = {x["var"]: (x["n_fill"], x["n_blended"]) for x in mesh.mask_report(d, ["station_id"]).collect()}
    assert r == {"temp": (1, 1), "salt": (0, 0), "zeta": (0, 0)}


def test_lead_bins(spark):
    df = spark.createDataFrame([(T0 + h * 3600, T0, 1.0, 1.0) for h in (0, 5, 6, 47, 48, 49)], "t bigint, c bigint, obs double, model double").selectExpr(
        "timestamp_seconds(t) AS ts", "timestamp_seconds(c) AS cycle", "obs", "model"
    )
    got = [(r["lead_hour"], r["hour_bin"]) for r in horizon.add_lead(df, 48).orderBy("ts").collect()]
    assert got == [(0, 6), (5, 6), (6, 12), (47, 48), (48, 48)]


def test_wide_horizon_import(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "ts int, c1 double, c2 double")
    got = sorted((r["ts"], r["cycle"], r["model"]) for r in horizon.from_wide(df, ["ts"]).collect())
    assert got == [(1, "c1", 1.0), (2, "c1", 3.0), (2, "c2", 4.0)]


def test_majority_file_size(spark, tmp_path):
    for i, n in enumerate((5, 5, 3)):
        (tmp_path / f"f{i}.bin").write_bytes(b"x" * n)
    files = model.file_sizes(spark, str(tmp_path)).withColumn("dir", F.lit("d"))
    assert [r["length"] for r in model.majority_size(files, ["dir"]).collect()] == [5, 5]


def test_constituent_file(spark):
    from seamark.sinks import tables

    rows = [("a", 2, "S2", 0.25, 10.04, None, None, None, None, None), ("a", 1, "M2", 12345.5, 359.96, 1000.0, 1.0, -11345.5, 1.04, 0.00004)]
    table = spark.createDataFrame(rows, "station_id string, n int, constituent string, ref_amp double, ref_phase double, model_amp double, model_phase double, amp_diff double, phase_diff double, vector_diff double")
    stats = spark.createDataFrame([("a", 1, 0.5, None)], "station_id string, n_valid int, rmse_amp double, rmse_phase double")
    out = tables.constituent_file(table, ["station_id"], stats=stats, metadata={"Datum": "MSL"}).orderBy("part", "n")
    assert [r.line for r in out.collect()] == [
        "# Station: a",
        "# Datum: MSL",
        "N,Constituent,Ref_Amp,Ref_Phase,Model_Amp,Model_Phase,Amp_Diff,Phase_Diff,Vector_Diff",
        "1,M2,12345.5000,360.0,1000.0000,1.0,-11345.5000,1.0,0.0000",
        "2,S2,0.2500,10.0,,,,,",
        "",
        "# n_valid: 1",
        "# rmse_amp: 0.500000",
        "# rmse_phase: nan",
    ]


def test_fixed_decimals_round_the_binary_value(spark):
    from seamark.functions.rounding import fixed

    values = [0.01005, 0.0201 * 0.49999999999999994, 1234567.125, -0.00001, 2.5, 1e-9, -1234.56785, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fixed(F.col("v"), 4)).collect()]
    assert got == [None if v is None else f"{v:.4f}" for v in values]
