"""Every registered query against its DuckDB oracle on the smallest scale;
keys without an oracle must at least run and return rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from scripts.compare_oracle import duck_conn, rows_of

from conftest import SF_SMALL

KEYS = sorted(E.queries())
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_conn(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert rows, f"{key} returned no rows"
        return
    rel = duck.sql(ORACLE[key])
    assert sorted(cols) == sorted(rel.columns)
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    assert spark_types == duck_types
    assert rows_of(cols, rows) == rows_of(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["site_location", "lesion_label", "subject_count", "mean_age", "min_age",
                          "max_age", "flagged_for_review"]
    assert df.count() > 0


def test_every_oracle_key_is_registered():
    assert set(ORACLE) <= set(E.queries())
