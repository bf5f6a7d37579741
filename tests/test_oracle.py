"""Every registered query against its SQL twin."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

# the optional subpackage has tests of its own
OWN = entry._llm()[0]
QUERIES = {name: query for name, query in entry.queries().items() if name not in OWN}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name not in OWN}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_names_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert columns == sorted(names)
    at = [names.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in at) for row in cursor.fetchall())
    found = Counter(tuple(row[c] for c in columns) for row in df.collect())
    assert found == expected


def test_classify_docs_fits_its_training_documents(spark, sf_dir):
    rows = QUERIES["classify_docs"](spark, sf_dir).where("split = 'train' AND label IS NOT NULL").collect()
    assert sum(r.prediction == r.label for r in rows) / len(rows) > 0.8


def test_entry_packs_whole_blocks(spark):
    df = entry.entry(spark)
    sizes = df.selectExpr("size(input_ids) AS n").distinct().collect()
    assert [r.n for r in sizes] == [128]
