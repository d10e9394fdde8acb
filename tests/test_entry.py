"""The driver contract, and query results on the smallest tables against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import normal
from seamark.plans.demo import TABLES

SAMPLE = [
    "agg13_skill_scalar",
    "joi01_pair_scalar",
    "joi07_nearest_node",
    "joi18_event_pairing",
    "win01_bounded_gap_fill",
    "win15_merge_intervals",
    "har04_tide_prediction",
    "flt07_point_in_polygon",
    "agg31_ice_class_rmse",
    "src05_station_control",
]


def test_contract(spark):
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 200
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = entry.queries()[name](spark, sf_dir)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)

    def canon(rows):
        return sorted([tuple(normal(r[c]) for c in order) for r in rows], key=lambda r: tuple((x is not None, str(x)) for x in r))

    got = canon([r.asDict() for r in df.collect()])
    want = canon([dict(zip(names, r)) for r in cur.fetchall()])
    assert got == want
