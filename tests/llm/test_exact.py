"""Exact deduplication against brute force."""

import hashlib

from gridprep.llm import exact

BIG = 2**53 + 1


def expected(rows):
    norm = [(i, (t or "").encode().lower()) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t).hexdigest()
        stays = False
        for i in ids:
            kept = i == keep and not stays
            stays |= kept
            out.append((i, keep, len(ids), kept, sha))
    return sorted(out, key=repr)


def results(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


ROWS = [(1, "Same text"), (2, "same TEXT"), (3, "same  text"), (None, None), (None, ""), (7, None), (BIG, "ÄB"), (BIG + 2, "Äb"), (BIG + 2, "Äb"), (9, "äb"), (None, "lone"), (10, "x" * 2_000_000), (11, "X" * 2_000_000), (None, "n"), (None, "N")]


def test_groups(spark):
    df = spark.createDataFrame([(i, t, "q", 1, "r") for i, t in ROWS], "doc_id long, text string, digest string, __row int, maybe string")
    assert results(exact.exact_groups(df)) == expected(ROWS)


def test_hot_group_and_unique_rows(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 4000}") for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert results(exact.exact_groups(df)) == expected(rows)


def test_turns_give_the_same(spark):
    rows = [(i, f"text {i % 700}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(exact.may_repeat(exact.with_rows(exact.digests(df)), 1000, 1 << 12)) > 2
    assert results(exact.exact_groups(df, max_bits=1 << 12)) == expected(rows)


def test_few_unique_rows_are_held_up(spark):
    rows = [(i, f"text {i}") for i in range(20_000)] + [(i, "twice") for i in (50_000, 50_001)]
    stored = exact.with_rows(exact.digests(spark.createDataFrame(rows, "doc_id long, text string")))
    (tested,) = exact.may_repeat(stored, len(rows))
    held = tested.filter("maybe").collect()
    assert {50_000, 50_001} <= {r.doc_id for r in held}
    assert len(held) < 0.05 * len(rows)


def test_no_rows(spark):
    assert exact.exact_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_same_as_sql(spark, sf):
    import duckdb

    from gridprep.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = sorted(map(repr, map(tuple, QUERIES["op11_exact_dedup"](spark, sf).collect())))
    assert got == sorted(map(repr, con.execute(ORACLE["op11_exact_dedup"]).fetchall()))
