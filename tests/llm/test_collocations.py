"""Collocations against brute force and SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridprep.llm import collocations as co


def slow(rows, min_count, top, longest=4):
    counts = defaultdict(Counter)
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang or "und" if lang is None else lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        whole = Counter()
        for p, c in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    whole[p[i : i + k]] = max(whole[p[i : i + k]], c)
        found = []
        for p, a in often.items():
            if 100 * whole[p] >= 80 * a:
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def results(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(seed=1, docs=300):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["été", "Über", "\xa0x", "\x85", "a_b", "日本"]
    fixed = ["New York City", "once upon a time", "the the the", "of the", "Of The"]
    out = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randrange(60)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else vocab[min(len(vocab) - 1, int(rng.expovariate(0.1)))])
            parts.append(rng.choice([" "] * 8 + ["\t", "  ", ". ", ",", "\n", "!?", "\r\n", " \t "]))
        out.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), "".join(parts)))
    return [*out, ("en", None), ("en", ""), ("xx", "..."), (None, "the the " * 40), ("en", "long " * 30_000)]


@pytest.mark.parametrize(("head", "tile"), [(1 << 18, 2048), (40, 4), (0, 8), (1 << 18, 2)])
def test_against_brute_force(spark, head, tile):
    rows = corpus()
    df = spark.createDataFrame([(*r, 7, "q") for r in rows], "lang string, text string, f long, phrase string").repartition(5)
    assert results(co.collocations(df, min_count=8, top=40, head=head, tile=tile)) == slow(rows, 8, 40)


def test_counts_merged_in_several_steps(spark, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(co, "FAN_IN", 2)
    monkeypatch.setattr(co, "CHUNK", 2_000)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(9)
    assert results(co.collocations(df, min_count=5, top=1_000, tile=16)) == slow(rows, 5, 1_000)


def test_no_rows(spark):
    assert co.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert co.collocations(spark.createDataFrame([("en", "a b"), ("de", None)], "lang string, text string")).collect() == []


def test_dense_and_loose_tiles_agree():
    rng = np.random.default_rng(3)
    left, right = rng.zipf(1.3, 50_000) % 3000, rng.zipf(1.3, 50_000) % 3000
    want = Counter(zip(left.tolist(), right.tolist(), strict=True))
    for dense, least in ((0, 1), (3, 100), (50, 1)):
        tiles = co.Tiles(64, dense, least)
        for a in range(0, len(left), 7_000):
            tiles.add("en", left[a : a + 7_000], right[a : a + 7_000])
        got = Counter()
        for _, t, cells, n in tiles.drain():
            for c, k in zip(cells.tolist(), n.tolist(), strict=True):
                got[(t >> 20) * 64 + c // 64, (t & 0xFFFFF) * 64 + c % 64] += k
        assert got == want


def test_slices_of_long_texts():
    text = b"one two. three four\nfive six seven " * 50
    parts = list(co.slices(text, 40))
    assert b"".join(parts) == text and all(p[-1:] in b".\n" for p in parts[:-1])
    assert b"".join(co.slices(b"x " * 500, 40)) == b"x " * 500


def test_same_as_sql(spark):
    import duckdb

    from gridprep.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(ORACLE["op13_collocations"])
    names = [d[0] for d in want.description]
    got = QUERIES["op13_collocations"](spark, sf)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall()) and got.count() > 50
