"""The registered queries: rows, SQL where there is some, and the pipeline."""

import duckdb
import pytest
from helpers import jaccard_components, words

import corpus_pipeline as P
from stardw.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
ROWS = {"op4_warc": "pages", "op6_html_extraction": "pages", "op13_url_filter": "pages"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_a_row_for_every_row(spark, name):
    if name == "op11_collocations":  # a row for every phrase
        return
    df = QUERIES[name](spark, SF)
    assert df.count() == spark.read.parquet(f"{SF}/{ROWS.get(name, 'documents')}.parquet").count()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in df.select(*names).collect())


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in P.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "encoding"]
    from stardw.llm.quality import fit_quality_model, score_quality
    model = fit_quality_model(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in score_quality(docs, model).collect() if r.predicted}
    best = {}
    for i in good:
        k = (rows[i] or "").translate({x: x + 32 for x in range(65, 91)})
        best[k] = max(i, best.get(k, i))
    unique = set(best.values())
    comps = jaccard_components([(i, rows[i]) for i in unique], 80, 5)
    single = {i for i in unique if comps[i][1] == i}
    items = [" ".join(words(r.text, True)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [good, unique, single, {i for i in single if not any(x in " ".join(words(rows[i], True)) for x in items)}]
    for (name, stage), ids in zip(P.STAGES, want, strict=False):
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        got = {r.doc_id for r in docs.collect()}
        if name == "decontamination":  # brute force finds whole items in their own spelling only
            assert got <= ids and len(ids) - len(got) <= 4
        else:
            assert got == ids, name
    final = P.run(spark, SF)
    assert {r.doc_id for r in final.select("doc_id").collect()} == got
