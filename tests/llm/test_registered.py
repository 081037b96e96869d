"""Registered corpus queries against DuckDB, or against what they must satisfy."""

import duckdb
import pytest

from tallyproof.llm.oracle import ORACLE
from tallyproof.llm.queries import QUERIES


def as_text(frame, columns):
    return frame[columns].astype(str).sort_values(columns).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, data, name):
    folder = data("0.001")
    got = QUERIES[name](spark, folder).toPandas()
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = con.execute(ORACLE[name]).fetchdf()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert as_text(got, columns).equals(as_text(want, columns))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op3_binary_code_links", "op13_setm_phrases"}))
def test_a_row_for_every_document(spark, data, name):
    folder = data("0.001")
    got = QUERIES[name](spark, folder)
    assert got.select("doc_id").distinct().count() == got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
