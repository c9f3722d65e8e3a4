"""Every registered query with an oracle: Spark result == DuckDB result on sf0.001
(rows, column names, values after rounding to 6 decimals)."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF001

ORACLE = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF001)
    cols = sdf.columns
    srows = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=_key)
    rel = duck.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(dcols)
    order = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=_key)
    assert len(srows) == len(drows)
    assert srows == drows
    # column types agree too (the driver compares schemas)
    m = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}
    dtypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    for f in sdf.schema.fields:
        t = f.dataType.simpleString()
        assert m.get(t, t) == dtypes[f.name], (f.name, t, dtypes[f.name])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["cd_name", "pickup_datetime", "pickups"]
