"""Every stage of the pipeline against plain Python on what its predecessor kept; the registered queries."""

import brute
import corpus_pipeline
import duckdb
import pytest
from seamark.llm import catalog, quality, secrets
from seamark.llm.common import read, written
from test_sets import check_packed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages(spark, sf_dir):
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality rules", "line dedup", "near duplicates", "secret scan", "best-fit packing"]
    docs = read(spark, sf_dir, "documents")
    ratio = quality.fit(docs, read(spark, sf_dir, "labels"))
    good = {r.doc_id for r in quality.quality(docs, ratio).filter("kept").collect()}

    first = written(stage["quality rules"](spark, docs, sf_dir), "t")
    assert first.columns == COLUMNS and rows_of(first) == [r for r in rows_of(docs) if r[0] in good]

    second = written(stage["line dedup"](spark, first, sf_dir), "t")
    before = rows_of(first)
    want = sorted(((i, w[2]) for (i, _), w in zip(before, brute.dedup_lines(before))), key=str)
    assert second.columns == COLUMNS and rows_of(second) == want
    assert all(r.n_chars == len(r.text) for r in second.collect())

    third = written(stage["near duplicates"](spark, second, sf_dir), "t")
    before = rows_of(second)
    want = [r for r, (c, _) in zip(before, brute.similar(before)) if c == r[0]]
    assert third.columns == COLUMNS and rows_of(third) == want and len(want) < len(before)

    fourth = written(stage["secret scan"](spark, third, sf_dir), "t")
    assert fourth.columns == COLUMNS
    for (i, old), (j, new) in zip(rows_of(third), rows_of(fourth)):
        assert i == j and not brute.base_spans(new)
        assert (old == new) == (not brute.base_spans(old))
        assert old != new or secrets.MASK not in new
    packed = stage["best-fit packing"](spark, fourth, sf_dir)
    used, floor = check_packed(packed.collect(), rows_of(fourth))
    assert used <= 1.05 * floor + 1

    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, packed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()))


def test_stages_on_awkward_rows(spark, rows, sf_dir, tmp_path):
    plain = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 1) for i in range(10, 40)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (plain, plain.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, str(tmp_path)), "t")
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, plain, str(tmp_path)).count() >= 0


def test_quality_follows_the_labels(spark):
    """Labelled documents of a larger table: good ones that pass the base rules stay, bad ones go."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    judged = quality.quality(docs, quality.fit(docs, labels)).join(labels, "doc_id")
    assert judged.filter("quality = 1 AND NOT base_failed AND NOT kept").count() == 0
    assert judged.filter("quality = 0 AND kept").count() == 0


def test_registered():
    names = catalog.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(catalog.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cur = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(cur.fetchall(), key=str) == sorted((tuple(r) for r in catalog.queries()[name](spark, sf_dir).select(*names).collect()), key=str)
