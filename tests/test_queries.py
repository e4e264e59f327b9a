"""Every registered query of the library against its SQL twin, and the twins' column names and types."""

import duckdb
import pytest

from gridprep.plans import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    clean = lambda v: None if v is None else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(clean(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    cursor = duck.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    a, b = rows(df.columns, df.collect()), rows(names, cursor.fetchall())
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        for p, q in zip(x, y, strict=True):
            assert p == q or isinstance(p, float) and isinstance(q, float) and abs(p - q) <= 1e-5 * max(1, abs(p)), (x, y)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
