"""Vector codes against brute force and SQL."""

import hashlib
import math

import numpy as np
import pytest

from gridprep.llm import codes


def slow(rows, parts=16, entries=64, rounds=2):
    kept = sorted((i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v))
    w = len(kept[0][2]) // parts
    books = [[v[p * w : (p + 1) * w] for _, _, v in kept[:entries]] for p in range(parts)]

    def best(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))

    for turn in range(rounds + 1):
        found = [[best(v[p * w : (p + 1) * w], books[p]) for p in range(parts)] for _, _, v in kept]
        if turn == rounds:
            break
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p * w : (p + 1) * w] for (_, _, v), f in zip(kept, found, strict=True) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    error = [sum(d for d, _ in f) for f in found]
    by = {}
    for (_, label, _), e in zip(kept, error, strict=True):
        by[label] = by.get(label, 0) + e
    return sorted((i, "".join(f"{k:02x}" for _, k in f), e, by[label], sha) for (i, label, _), f, e in zip(kept, found, error, strict=True))


SCHEMA = "vec_id long, embedding array<float>, label int, code string, size int"


def results(df):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))


@pytest.mark.parametrize(("n", "dim"), [(300, 32), (20, 16), (1, 64)])
def test_against_brute_force(spark, n, dim):
    rng = np.random.default_rng(n)
    base = rng.normal(size=(max(1, n // 3), dim))
    rows = [(2**53 + 1 + 2 * i, [float(np.float32(x)) for x in base[i % len(base)] * rng.choice([1, 1, -0.5])], [None, 1, 1, 2][i % 4]) for i in range(n)]
    rows += [(-1, None, 1), (-2, [None] + [0.0] * (dim - 1), 1), (-3, [float("nan")] * dim, 2), (-4, [float("inf")] + [0.5] * (dim - 1), None)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(3)
    assert results(codes.code_report(df)) == slow(rows)


def test_odd_cases(spark):
    assert codes.code_report(spark.createDataFrame([], SCHEMA)).collect() == []
    # repeated ids, null ids, another length, a length that 16 doesn't divide, an empty vector, huge components
    rows = [(1, [0.5] * 18, 1), (1, [0.5] * 18, 1), (None, [0.25] * 18, None), (2, [1.0] * 16, 1), (3, [], 1), (4, [3e38] * 18, 1)]
    got = {(r.vec_id, r.code): r.error for r in codes.code_report(spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA)).collect()}
    assert got[2, None] is None and got[3, None] is None and len(got) == 5
    assert all(len(code) == 32 for i, code in got if i in (1, None, 4))


def test_pivots_prune_and_lose_nothing():
    rng = np.random.default_rng(5)
    centre = rng.integers(-400, 400, size=(64, 4))
    x = centre[rng.integers(0, 64, 5_000)] + rng.integers(-9, 10, size=(5_000, 4))
    entries = centre + rng.integers(-3, 4, size=centre.shape)
    entries[40] = entries[7]
    pivots = codes.choose_pivots(centre)
    near = np.sqrt(codes.distances(x, pivots)).astype(np.float32)
    code, d, evaluated = codes.nearest(x, near, entries, pivots)
    whole = codes.distances(x, entries)
    assert (code == whole.argmin(axis=1)).all() and (d == whole.min(axis=1)).all()
    assert evaluated < 0.2 * whole.size


def test_same_as_sql(spark, sf):
    import duckdb

    from gridprep.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert results(QUERIES["op12_vector_codes"](spark, sf)) == sorted(con.execute(ORACLE["op12_vector_codes"]).fetchall())
