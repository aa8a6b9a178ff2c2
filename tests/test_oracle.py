"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
import json
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sensorlake.plans.registry import QUERIES as OWN

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# the library's own queries; those of sensorlake.llm are tested in tests/llm
QUERIES = {k: v for k, v in E.queries().items() if k in OWN}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in OWN}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: json.dumps(t, default=str))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert missing == [], missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"time", "measurement", "location", "source", "data_key", "data_value"}


SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
                 "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP", "DateType()": "DATE",
                 "DecimalType(18,3)": "DECIMAL(18,3)"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    dtypes = dict(zip(duck.sql(ORACLE[name]).columns, map(str, duck.sql(ORACLE[name]).types)))
    stypes = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
    assert stypes == dtypes
    assert len(srows) == len(drows)
    assert _rows(scols, srows) == _rows(dcols, drows)
