"""The stages on a small table, and the registered SQL against DuckDB."""

import brute
import corpus_pipeline
import duckdb
import pytest
from conftest import key

from priceframe.llm import queries

SF = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    sql = con.execute(queries.ORACLE_SQL[name])
    order = [df.columns.index(d[0]) for d in sql.description]
    assert sorted(key(tuple(r)[k] for k in order) for r in df.collect()) == sorted(map(key, sql.fetchall()))


def test_stages_keep_columns(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_near_stage_leaves_one_of_each_group(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    kept = {r.doc_id for r in corpus_pipeline.dedup_near(spark, documents(spark), SF).collect()}
    assert kept == {r[0] for r in brute.near_duplicates(rows) if r[3]}


def test_contaminated_stage(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, documents(spark), SF).collect()}
    assert kept == {r[0] for r in brute.decontaminate(rows, items) if not r[-1]}


def repeated_lines(rows):
    """rows: id, text, ids distinct. The texts without the pairs of neighbouring lines seen before in order of id and line."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        lines = text.split("\n")
        gone = set()
        for k, pair in enumerate(zip(lines, lines[1:], strict=False)):
            gone |= {k, k + 1} if pair in seen else set()
            seen.add(pair)
        out[doc] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_line_stage_misses_no_short_passage(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect() if r.text is not None]
    for k in range(40):
        passage = [f"passage {k} line {j} " + "word " * 30 for j in range(2 + k % 3)]
        rows += [(10**6 + 100 * k + j, "\n".join([f"before {k} {j}", *passage, f"after {k} {j}"])) for j in range(3)]
    out = corpus_pipeline.dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[10**6 + 1] == "before 0 1\nafter 0 1" and texts == repeated_lines(rows)
