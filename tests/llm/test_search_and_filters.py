"""URL filter, exact top-k, license scan, fingerprints and toxicity against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridprep.llm import licenses, syncmers, topk, toxicity, urls

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def slow_rule(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None, "allow"
    rest = url[at + 3 :]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fit, key=lambda x: len(x[0]), default=(None, "allow"))
    return host, path, rule[0], rule[1]


URLS = ["http://a.Example.COM/en/7?x", "http://example.com/en/71", "https://x.com/en/7", "http://notexample.com/en/", "http://b.net/de/8", "http://example.net/de/8", "http://EXAMPLE.net/de/", "ftp://o.org/es/#f", "org/es/", None, "", "://", "http://com/en/", "http://x.com?/en/", "http://a.com/EN/", "http://é.org/es/é", "http://a.com/x://b.org/es/"]


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, RULES).collect()}
    assert got == {i: slow_rule(u) for i, u in enumerate(URLS)}
    assert urls.judge_urls(df.filter("false"), RULES).count() == 0
    assert {r.verdict for r in urls.judge_urls(df, []).collect()} == {"allow"}


def test_rules_in_several_files(spark, monkeypatch):
    monkeypatch.setattr(urls, "FILE_RULES", 2)
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, RULES).collect()}
    assert got == {i: slow_rule(u) for i, u in enumerate(URLS)}


def test_hosts_of_many_labels(tmp_path):
    path = str(tmp_path / "r.bin")
    urls.DigestArray.write(path, [*RULES, ("", "/all", "block"), (".dot.com", "/", "block")])
    probe = lambda h, p: urls.DigestArray(path).probe([h], [p])[0][3]
    began = time.time()
    assert probe("a." * 500_000 + "com", "/en/x") == "com/en/" and probe("." * 500_000, "/en/") is None
    assert time.time() - began < 2
    assert probe("x..example.com", "/en/7") == "example.com/en/7" and probe("com", "/en/") == "com/en/" and probe("xcom", "/en/") is None


def test_digest_collisions_are_confirmed(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda x, *a: len(x))
    path = str(tmp_path / "r.bin")
    urls.DigestArray.write(path, [("a.com", "/x", "block"), ("b.com", "/x", "allow"), ("c.com", "/y", "block"), ("a.com", "/x", "allow")])
    assert urls.DigestArray(path).probe(["a.com", "b.com", "d.com", "z.c.com"], ["/x1", "/x", "/y", "/y"]) == [(7, 5, True, "a.com/x", "block"), (7, 5, False, "b.com/x", "allow"), (-1, -1, False, None, None), (7, 5, True, "c.com/y", "block")]


def slow_top(rows, queries, k):
    v = {i: [int(np.floor(256 * float(np.float32(x)))) for x in e] for i, e in rows if e and all(x is not None and np.isfinite(x) for x in e)}
    out = set()
    for q in queries:
        if q in v:
            scores = sorted((-sum(a * b for a, b in zip(v[q], w)), i) for i, w in v.items() if i != q and len(w) == len(v[q]))
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("shard_rows", [16, 10_000])
def test_top_k(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    rng = random.Random(4)
    rows = [(i, [rng.choice([rng.gauss(0, 1), 0.5]) for _ in range(6)]) for i in range(90)]
    rows += [(100 + i, rows[i][1]) for i in range(12)] + [(200, None), (201, []), (202, [None] * 6), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (205, [1.0, 2.0]), (206, [2.0, 1.0]), (207, [3e7] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    queries = [i for i, _ in rows if i % 5 == 0]
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.expr("vec_id % 5 = 0"), 4).collect()}
    assert got == slow_top(rows, queries, 4)
    assert topk.top_k(df.filter("false"), F.lit(True), 4).count() == 0


@pytest.mark.parametrize("shard_rows", [16, 10_000])
def test_top_k_of_repeated_rows(spark, monkeypatch, shard_rows):
    """Every row is a candidate, also where rows repeat an id; one vector makes up most of the table."""
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    rng = random.Random(6)
    rows = [(i // 2, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)] + [(500 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(100)] + [(3, [2.0**40, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df.repartition(3), F.expr("vec_id % 10 = 0 and vec_id < 600"), 3).collect())
    v = [[int(np.floor(256 * x)) for x in e] for _, e in rows]
    want = []
    for q, (i, _) in enumerate(rows):
        if i % 10 == 0 and i < 600:
            scores = sorted((-sum(a * b for a, b in zip(v[q], w)), rows[c][0]) for c, w in enumerate(v) if c != q)
            want += [(i, n, c, -s) for n, (s, c) in enumerate(scores[:3], 1)]
    assert got == sorted(want) and any(g[3] > 2**53 for g in got)


BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEXTS = ["", None, "MIT License", "the mit\nlicense, and mit-license; MITlicense mit  licenses", "GNU General Public License version 3 or any later version", "éMIT license mit licenseé", "Licensed under the Apache License, Version 2.0", "apache license mit license", "Creative Commons Attribution-NonCommercial 4.0", "SPDX-License-Identifier: GPL-2.0-only", "all rights reserved " * 3, "word " * 30_000 + "mit license", "İ MIT LİCENSE K license"]


def slow_base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for p, label in BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    return len(words), sorted(places)


def test_license_scan(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "mit license", 2)], "doc_id long, text string, phrases int")
    for r in licenses.license_scan(df).collect():
        text = TEXTS[r.doc_id] if r.doc_id is not None else "mit license"
        assert (r.n_words, sorted((p["first_word"], p["label"]) for p in r.phrases)) == slow_base(text), text[:50]
    labels = {r.doc_id: {d["label"] for d in r.detections} for r in licenses.license_scan(df).collect()}
    assert labels[4] == {"gpl-3.0-or-later"} and labels[6] == {"apache-2.0"} and labels[8] == {"cc-by-nc-4.0"} and labels[9] == {"gpl-2.0-only"} and not labels[0]
    assert len(licenses.rules()) > 200


def test_license_suppression():
    found = [(0, 10, 50, "a"), (2, 8, 60, "b"), (3, 7, 40, "c"), (0, 10, 50, "d"), (9, 12, 10, "e")]
    assert licenses.resolve(found) == [(0, 10, 50, "a"), (2, 8, 60, "b"), (9, 12, 10, "e")]


def slow_resolve(found):
    kept = []
    for d in sorted(set(found), key=lambda d: (-d[2], d[0] - d[1], d[0], d[3])):
        if not any(k[0] <= d[0] and d[1] <= k[1] for k in kept):
            kept.append(d)
    return sorted(kept)


def test_license_suppression_by_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        found = [(a, a + rng.randrange(1, 9), rng.choice([10, 20, 30]), rng.choice("ab")) for a in (rng.randrange(20) for _ in range(rng.randrange(15)))]
        assert licenses.resolve(found) == slow_resolve(found)


def test_every_keyword_is_in_its_matches():
    """The prefilter loses nothing: texts with each rule's words have its keyword."""
    rng = random.Random(5)
    texts = [words for _, _, words in licenses.CLAUSES] + TEXTS[2:11] + ["GPLv3", "LGPL-2.1+", "cc by-sa 4.0", "CeCILL-2.1", "the Artistic License 2.0", "https://www.creativecommons.org/licenses/by/4.0/", "Permission is hereby granted, free of charge, to any person obtaining a copy"]
    for text in texts:
        low = text.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})).encode()
        gaps = re.sub(rb" ", lambda _: rng.choice([b"  ", b"\n", b", ", b" "]), low)
        for raw in (low, gaps):
            view = raw.decode("latin-1")
            want = slow_resolve([(m.start(), m.end(), r.priority, r.label) for r in licenses.rules() for m in re.finditer(r.pattern, view)])
            assert licenses.scan(raw)[0] == want, text
    assert all(licenses.scan(words.encode())[0] for _, _, words in licenses.CLAUSES)


def test_license_query_by_brute_force(spark, sf):
    """All columns of the query, from every rule on every text without prefilter."""
    from gridprep.llm import queries

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in queries.op7_license_scan(spark, sf).collect()}
    every = [(r, re.compile(r.pattern)) for r in licenses.rules()]
    for d in docs.collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in d.text or "").encode()
        view = low.decode("latin-1")
        words = [m.start() for m in re.finditer(r"[0-9a-z\x80-\xff]+", view)]
        found = slow_resolve([(m.start(), m.end(), r.priority, r.label) for r, rx in every for m in rx.finditer(view)])
        n, base = slow_base(d.text)
        word = lambda x: sum(w <= x for w in words) - 1  # noqa: B023, E731
        covered = sum(word(e - 1) - word(a) + 1 for a, e, _, _ in found)
        r = got[d.doc_id]
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(base), ",".join(sorted({b[1] for b in base})))
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.labels == ",".join(sorted({b[1] for b in base} | {f[3] for f in found})) and r.score == pytest.approx(min(1.0, covered / n) if n else 0.0)


def test_license_dumps_are_linear():
    raw = b"licensed under the apache license version 2.0, gpl v3 or later. mit license " * 40_000
    began = time.time()
    found, places = licenses.scan(raw)
    assert len(found) == 120_000 and len(places) == 80_000
    licenses.scan(b"gpl" + b" " * 1_000_000 + b"x")
    assert time.time() - began < 20


def test_syncmer_places():
    rng = random.Random(1)
    texts = ["", "kurz", "x" * 50, "".join(rng.choice("abcde ") for _ in range(300)), "日本語" * 30]
    text, at, value = syncmers.anchors(texts)
    for i, t in enumerate(texts):
        order = sorted(at[text == i])
        assert len(order) == len(set(order)) and (len(t) >= syncmers.K or order == ([0] if t else []))
    # the definition, with the operator's hash of each inner substring
    t = texts[3]
    total = np.frombuffer(t.encode("utf-32-le"), "<u4")
    power, inverse = syncmers._powers(len(total) + 1)
    summed = np.concatenate(([np.uint64(0)], np.cumsum(syncmers.mix64(total.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)))
    smers = [int(syncmers.mix64(np.array([(summed[i + syncmers.S] - summed[i]) * inverse[i]]))[0]) for i in range(len(t) - syncmers.S + 1)]
    w = syncmers.K - syncmers.S + 1
    want = [i for i in range(len(t) - syncmers.K + 1) if min(smers[i : i + w]) in (smers[i], smers[i + w - 1])]
    assert sorted(at[text == 3]) == want
    # context-free: the same passage has the same anchors wherever it stands
    a = {(p - 7, v) for i, p, v in zip(*syncmers.anchors(["0123456" + t])) if p >= 7}
    assert {(p, v) for i, p, v in zip(text, at, value) if i == 3} == a


def test_every_text_has_an_anchor():
    rng = random.Random(3)
    for n in [1, 19, *range(20, 31)]:
        texts = ["".join(rng.choice("abcdefgh é") for _ in range(n)) for _ in range(200)]
        text, at, _ = syncmers.anchors(["", *texts, ""])
        assert set(text) == set(range(1, 201)) and (at >= 0).all()
        prints = syncmers.fingerprints(texts)
        assert (prints[0] != syncmers.EMPTY).any(1).all()
        other = [t[::-1] + "!" for t in texts]
        assert (syncmers.likeness(prints, syncmers.fingerprints(other)) < 1).all() and (syncmers.likeness(prints, prints) == 1).all()
    assert (syncmers.fingerprints(["", "x"])[0][0] == syncmers.EMPTY).all()


def slow_fingerprint(t):
    mask = (1 << 64) - 1

    def mix(x):
        for _ in range(2):
            x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & mask
        return x ^ (x >> 32)

    base = 0x9E3779B97F4A7C15
    summed = lambda x: sum(mix(ord(c) + 1) * pow(base, i, 1 << 64) for i, c in enumerate(x)) & mask
    k, s = syncmers.K, syncmers.S
    found = []
    for i in range(len(t) - k + 1):
        inner = [mix(summed(t[j : j + s])) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.append((i, mix((summed(t[i : i + k]) + k) & mask)))
    if t and not found:
        found = [(0, mix((summed(t) + len(t)) & mask))]
    bins = {}
    for i, v in found:
        bins[v >> 58] = min(bins.get(v >> 58, (1 << 16, 0)), (min(v >> 42 & 0xFFFF, 0xFFFE), i))
    order = sorted(bins, key=lambda b: bins[b][1])
    return {b: (bins[b][0], order.index(b)) for b in bins}


def slow_likeness(a, b):
    if not a and not b:
        return 1.0
    same = sorted((a[k][1], b[k][1]) for k in a if k in b and a[k][0] == b[k][0])
    best = []
    for i, (_, y) in enumerate(same):
        best.append(1 + max((best[j] for j in range(i) if same[j][1] < y), default=0))
    return max(best, default=0) / len(set(a) | set(b))


def test_fingerprints_and_likeness_by_brute_force(spark):
    rng = random.Random(12)
    new = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    texts = ["", new(10), new(24), new(25), "x" * 90, None] + [new(rng.randrange(30, 500)) for _ in range(14)]
    texts += [texts[8] + new(60), texts[8], texts[9][150:] + texts[9][:150], texts[9]]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in syncmers.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    own = [t or "" for t in texts]
    hexed = lambda f: "".join("%04x" % f.get(b, (0xFFFF, 0))[0] for b in range(64)) + "".join("%02x" % f.get(b, (0, 0xFF))[1] for b in range(64))
    prints = [slow_fingerprint(t) for t in own]
    for i, t in enumerate(own):
        following = own[(i + 1) % len(own)]
        n = len(t) // 4
        edited = slow_fingerprint(t[: len(t) - n] + following[:n] if n else t)
        r = got[i]
        assert r.fingerprint == hexed(prints[i]) and r.edited_fingerprint == hexed(edited), i
        assert r.near_edited == pytest.approx(slow_likeness(prints[i], edited)), i
        assert r.near_next == pytest.approx(slow_likeness(prints[i], prints[(i + 1) % len(own)])), i
    # order counts: the same passages the other way round are less alike than a text with a passage added
    assert got[20].near_next > 0.5 and got[22].near_next < got[20].near_next


@pytest.mark.parametrize("partitions", [1, 5])
def test_compare_with_next(spark, partitions):
    rng = random.Random(2)
    rows = [(i * 3, "".join(rng.choice("ab é") for _ in range(rng.randint(0, 120))), 1.0) for i in range(40)] + [(4, None, 1.0), (None, "first of all", 1.0), (30, "same id", 1.0), (9, "x" * 5000, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, near_next double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = sorted(((r.doc_id if r.doc_id is not None else -1, r.n_chars, r.edited_sha256) for r in syncmers.compare_with_next(df).collect()))
        assert syncmers.compare_with_next(df.filter("false")).count() == 0
        one = syncmers.compare_with_next(df.filter("doc_id = 12")).first()
        assert one.near_next == 1.0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    order = sorted(((i if i is not None else -1, t or "") for i, t, _ in rows))
    want = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        edited = t[: len(t) - n] + following[:n] if n else t
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert got == sorted(want)


def test_toxicity_held_out(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.1')}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.dropDuplicates(["doc_id"])
    train, held = known.filter("doc_id % 3 <> 0"), known.filter("doc_id % 3 = 0")
    chain = toxicity.fit_chain(docs, train, ["quality", "toxic"])
    out = toxicity.toxicity(docs.join(held.select("doc_id"), "doc_id", "left_semi"), chain).join(held, "doc_id").groupBy("toxic", "rejected").count().collect()
    n = {(r.toxic, r.rejected): r["count"] for r in out}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.85
    assert n.get((0, True), 0) / n[0, False] < 0.02
    kept = toxicity.drop_toxic(docs.limit(50), chain)
    assert kept.columns == docs.columns


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (2, None, 1), (None, "", 1)], "doc_id long, text string, rejected int")
    chain = toxicity.fit_chain(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), ["quality", "toxic"])
    assert [r.rejected for r in toxicity.toxicity(docs, chain).collect()] == [False] * 3
    assert toxicity.drop_toxic(docs, chain).count() == 3


def slow_logistic(x, y, l2=1.0):
    """The optimum by Newton steps on dense rows; the last column is the intercept, without a penalty."""
    x = np.column_stack((x, np.ones(len(x))))
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], l2)
    penalty[-1] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
    return w


def test_chain_by_brute_force(spark):
    """Out-of-fold inputs, weights and probabilities against dense Newton fits; repeated label rows, a very long text."""
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(160):
        toxic, good = rng.random() < 0.4, rng.random() < 0.5
        words = [rng.choice(["ab", "cd", "ef", "gh"]) for _ in range(12)] + (["zq"] if toxic and rng.random() < 0.9 or rng.random() < 0.1 else []) + (["ok"] if good and rng.random() < 0.8 else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels += [(i, int(good), int(toxic))] + ([(i, 0, 0)] if i % 9 == 0 else [])
    rows += [(500, "zq " * 400_000), (501, None), (502, "")]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(600, 1, 1), (None, 1, 1), (3, None, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit_chain(docs, known, ["quality", "toxic"], min_chi2=5.0)
    assert len(chain.vocabulary) >= 2
    y = {}
    for i, q, t in labels:
        y[i] = (max(q, y.get(i, (0, 0))[0]), max(t, y.get(i, (0, 0))[1]))
    ids = np.array(sorted(y))
    y = np.array([y[i] for i in ids], float)
    texts = dict(rows)
    at, col = chain.vectors([texts[i] for i in ids])
    x = np.zeros((len(ids), len(chain.vocabulary)))
    x[at, col] = 1
    fold = (toxicity.mix64(ids.astype(np.uint64)) % np.uint64(4)).astype(int)
    odds = lambda p: np.log(np.clip(p, 1e-4, 1 - 1e-4) / (1 - np.clip(p, 1e-4, 1 - 1e-4)))
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    held = np.zeros(len(ids))
    for f in range(4):
        w = slow_logistic(x[fold != f], y[fold != f, 0])
        held[fold == f] = sigmoid(np.column_stack((x[fold == f], np.ones((fold == f).sum()))) @ w)
    first, second = slow_logistic(x, y[:, 0]), slow_logistic(np.column_stack((x, odds(held))), y[:, 1])
    assert np.allclose(chain.weights[0], first, atol=2e-2) and np.allclose(chain.weights[1], second, atol=2e-2)
    p = sigmoid(np.column_stack((x, np.ones(len(x)))) @ first)
    want = np.column_stack((p, sigmoid(np.column_stack((x, odds(p), np.ones(len(x)))) @ second)))
    got = {r.doc_id: (r.p_quality, r.p_toxic, r.rejected) for r in toxicity.toxicity(docs, chain).collect()}
    assert np.allclose([got[i][:2] for i in ids], want, atol=1e-2)
    assert all(got[i][2] == (chain.probabilities([texts[i] or ""])[0, 1] >= chain.thresholds[1]) for i in got)


def test_linear_fit_separates():
    rng = np.random.default_rng(0)
    x = rng.random((400, 6)) < 0.3
    y = x[:, 2].astype(float)
    rows, cols = np.nonzero(x)
    w = toxicity.fit_linear(rows, cols, 6, np.zeros((400, 0)), y)
    assert w[2] > 3 and np.abs(np.delete(w[:6], 2)).max() < 1


def test_large_ids_stay_beside_null_ones(spark):
    big = [2**53 + 1, 2**53 + 3, None, -(2**62) - 1]
    df = spark.createDataFrame([(i, f"some text of number {i} under the mit license") for i in big], "doc_id long, text string").coalesce(1)
    for got in (licenses.license_scan(df), syncmers.compare_with_next(df), syncmers.syncmer_fingerprints(df), syncmers.syncmer_anchors(df).select("doc_id").distinct()):
        assert sorted(r.doc_id or 0 for r in got.collect()) == sorted(i or 0 for i in big)


def test_sample_is_bounded_where_labelled_ids_repeat(spark, monkeypatch):
    rows = [(i % 3, f"text {i} {'bad' if i % 3 == 1 else 'good'} words") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 0)], "doc_id long, toxic int")
    seen = []
    real = toxicity.fit_linear
    monkeypatch.setattr(toxicity, "fit_linear", lambda rows, cols, size, earlier, y: seen.append(len(y)) or real(rows, cols, size, earlier, y))
    toxicity.fit_chain(docs, labels, ["toxic"], max_rows=300, min_rows=1)
    assert max(seen) == 300
