"""The registered queries against their SQL, on the smallest data."""

from glob import glob
from pathlib import Path

import duckdb
import pytest
from conftest import SF_TINY

from __spark_entry__ import entry, oracle_sql, queries
from checks.verify import canonical


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob(f"{SF_TINY}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


#: Queries that SQL cannot express. Each is held against a plain computation in tests/llm.
BRUTE_FORCE = {
    "op3_quality",
    "op4_toxicity",
    "op5_packing",
    "op13_whitening",
    "pipeline",
}


def test_every_query_has_sql_or_a_plain_test():
    assert oracle_sql().keys() <= queries().keys()
    assert queries().keys() - oracle_sql().keys() <= BRUTE_FORCE


@pytest.mark.parametrize("name", oracle_sql())
def test_query_equals_sql(spark, db, name):
    frame = queries()[name](spark, SF_TINY)
    answer = db.execute(oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert canonical(frame.columns, frame.collect()) == canonical(columns, answer.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
