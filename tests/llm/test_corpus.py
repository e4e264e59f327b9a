"""Joins, line dedup, mixing, packing, HTML and the pipeline against brute force."""

import random
import re
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridprep.llm import components, html, lines, mixing, ngram_join, packing
from gridprep.llm.common import tidy

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


@pytest.mark.parametrize("part", [30, 500_000])
def test_components(spark, monkeypatch, part):
    monkeypatch.setattr(components, "PART", part)
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(7, 7), (None, 3)]
    u = Union()
    for a, b in edges:
        if a is not None and a != b:
            u.join(a, b)
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: u.find(n) for n in list(u.up)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copy(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "w%d" % rng.randrange(10**6)
    return " ".join(words)


def corpus():
    rng = random.Random(9)
    new = lambda n: " ".join("w%d" % rng.randrange(3000) for _ in range(n))
    shared = new(60)
    texts = [new(rng.randrange(5, 200)) for _ in range(30)] + [new(40) + " " + shared for _ in range(10)]
    base = new(300)
    texts += [near_copy(rng, base, 4) for _ in range(40)] + [base] * 5 + [base.upper().replace(" ", ",\n")]
    short = new(40)
    texts += [short, near_copy(rng, short, 1), near_copy(rng, short, 2), "one two", "One, two!", "one", "", None, "...", "x " * 40_000]
    return texts


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("block", [8, 1024])
def test_ngram_classes(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = corpus()
    df = spark.createDataFrame([(i * 2, t, 5) for i, t in enumerate(texts)] + [(None, texts[0], 5)], "doc_id long, text string, class_id int")
    sets = [shingle_set(t) for t in texts]
    u, degree = Union(), Counter()
    for i in range(len(texts)):
        u.find(i)
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                u.join(i, j)
                degree[i] += 1
                degree[j] += 1
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_classes(df).collect())
    assert got == sorted([(i * 2, u.find(i) * 2, degree[i]) for i in range(len(texts))] + [(-1, None, 0)])
    kept = ngram_join.keep_one_of_each(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {u.find(i) * 2 for i in range(len(texts))} | {None}


def test_ngram_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.ngram_classes(df).count() == 0


def test_pruning_is_safe():
    assert list(ngram_join.least_matches()) == sorted(ngram_join.least_matches())
    assert ngram_join.least_matches()[-1] < 0.8 * ngram_join.HASHES


def slow_lines(rows):
    places = defaultdict(list)
    for i, t in rows:
        for n, x in enumerate((t or "").split("\n")):
            if x.strip(" \t\r"):
                places[x.strip(" \t\r")].append((i, n))
    own = {x: {x.lower()[k : k + 8] for k in range(max(1, len(x.lower()) - 7))} for x in places}
    u = Union()
    for x in own:
        u.find(x)
        for y in own:
            if x < y and len(own[x] & own[y]) >= 0.8 * len(own[x] | own[y]) - 1e-9:
                u.join(x, y)
    groups = defaultdict(list)
    for x, p in places.items():
        groups[u.find(x)] += p
    drop = defaultdict(list)
    for p in groups.values():
        for i, n in sorted(p)[1:]:
            drop[i].append(n)
    return {i: sorted(d) for i, d in drop.items()}


def test_lines(spark):
    rng = random.Random(3)
    new = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    common, long = new(8), new(60)
    rows = []
    for i in range(30):
        own = [new(rng.randrange(1, 20)) for _ in range(rng.randrange(1, 4))]
        if i % 3 == 0:
            own.append(common)
        if i % 4 == 0:
            own.append(near_copy(rng, long, i % 3))
        rows.append((i, "\n".join(own)))
    rows += [(40, rows[0][1]), (41, ""), (42, None), (43, "\n \n"), (44, "a\na\nA"), (45, "  " + common + "\t\r\nnew text of mine"), (46, "é\x85b"), (47, "z" * 50_000)]
    df = spark.createDataFrame([(i, t, "s", len(t or "")) for i, t in rows] + [(None, common, "s", 1)], "doc_id long, text string, source string, n_chars long")
    want = slow_lines(rows)
    got = {r.doc_id: (r.n_lines, r.n_kept, r.dropped) for r in lines.line_report(df).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, t in rows:
        n = len((t or "").split("\n"))
        assert got[i] == (n, n - len(want.get(i, [])), want.get(i, [])), i
    kept = lines.drop_repeated_lines(df)
    assert kept.columns == df.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert 40 not in texts and texts[None] == common and texts[41] == "" and texts[42] is None and texts[45] == "new text of mine"
    for r in kept.filter("doc_id < 30").collect():
        assert r.text == "\n".join(x for n, x in enumerate(dict(rows)[r.doc_id].split("\n")) if n not in want.get(r.doc_id, [])) and r.n_chars == len(r.text)
    assert lines.line_report(df.filter("false")).count() == 0


def test_lines_without_candidates(spark):
    # a batch in which no line has a partner, beside one that has
    rng = random.Random(4)
    new = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n))
    rows = [(i, new(12) + "\n" + new(15)) for i in range(40)]
    alone = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {(r.n_lines, r.n_kept) for r in lines.line_report(alone).collect()} == {(2, 2)}
    assert sorted(map(tuple, lines.drop_repeated_lines(alone).collect())) == rows
    pair = spark.createDataFrame([(100, rows[0][1].replace("\n", " more\n", 1)), (101, "")], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.dropped for r in lines.line_report(alone.unionByName(pair)).collect()}
    assert got.pop(100) == [0, 1] and not any(got.values())


def test_line_recall(spark):
    """Pairs of lines with a similarity just above the threshold meet."""
    rng = random.Random(8)
    grams = lambda x: {x[k : k + 8] for k in range(max(1, len(x) - 7))}
    pairs = []
    while len(pairs) < 1_500:
        x = "".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(20, 300))).strip()
        y = list(x)
        for _ in range(max(1, len(x) // 70)):
            y[rng.randrange(len(y))] = rng.choice("xyz")
        y = "".join(y)
        if 0.8 <= len(grams(x) & grams(y)) / len(grams(x) | grams(y)) <= 0.87:
            pairs.append((x, y))
    rows = [(2 * i + k, p[k]) for i, p in enumerate(pairs) for k in (0, 1)]
    got = {r.doc_id: r.dropped for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(bool(got[2 * i + 1]) for i in range(len(pairs))) >= 0.99 * len(pairs)
    assert not any(got[2 * i] for i in range(len(pairs)))


@pytest.mark.parametrize("block", [16, 1024])
def test_one_large_group_of_lines(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(6)
    base = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    rows = [(i, near_copy(rng, base, 1)) for i in range(150)] + [(500, "a line of its own")]
    got = {r.doc_id: r.dropped for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, d in got.items() if not d} == {0, 500}


def test_hubs_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB", 20)
    monkeypatch.setattr(components, "PART", 50)
    edges = [(0, i) for i in range(1, 400)] + [(1_000 + i, 1_001 + i) for i in range(30)] + [(399, 1_030)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {0} and len(got) == 431


SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def slow_targets(sizes, weights):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        out = {s: 3 * sizes[s] if s in capped else left * weight[s] / sum(weight[r] for r in rest) for s in order}
        above = {s for s in rest if out[s] > 3 * sizes[s] + 1e-9}
        if not above:
            return out
        capped |= above


def test_mix(spark):
    rng = random.Random(5)
    sources = ["b", "a", None, "é", "Z", "tiny", "empty"]
    rows = []
    for i in range(400):
        s = rng.choices(sources[:5], [20, 3, 3, 2, 1])[0]
        rows.append((i, " ".join("w%d" % k for k in range(rng.randrange(0, 400))), s))
    rows += [(1000, "a b\x0bc\xa0d", "tiny"), (1001, None, "empty"), (1002, "   ", "empty"), (None, "null id " * 20, "a"), (5, "repeated id", "b"), (5, "repeated id", "b")]
    df = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, rank int")
    out = mixing.mix_documents(df, [1, 2, 3]).collect()
    assert sorted((r.doc_id or -1, r.size) for r in out) == sorted((i or -1, len(SPACE.findall(t or ""))) for i, t, _ in rows)
    by_source, taken = Counter(), Counter()
    source = {(i, len(SPACE.findall(t or ""))): s for i, t, s in rows}
    for i, t, s in rows:
        by_source[s] += len(SPACE.findall(t or ""))
    want = slow_targets(dict(by_source), [1, 2, 3])
    for r in out:
        s = source[r.doc_id, r.size]
        assert r.source_size == by_source[s] and r.target == pytest.approx(want[s]) and r.taken <= 3 * r.size
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.05 * t, 3 * mixing.BLOCK_WORDS), (s, taken[s], t)
    again = mixing.mix_documents(df.repartition(7), [1, 2, 3]).collect()
    key = lambda r: (r.doc_id or -1, r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, out))
    assert mixing.mix_documents(df.filter("false")).count() == 0
    assert {r.taken for r in mixing.mix_documents(df.filter("source = 'empty'")).collect()} == {0}


def test_mixed_texts(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(50 + i)), "ab"[i % 2], 7) for i in range(60)] + [(100, "", "a", 0), (101, None, "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    out = mixing.mixed_texts(df, [1, 5])
    assert out.columns == df.columns
    got = out.collect()
    taken = {r.doc_id: r.taken for r in mixing.mix_documents(df, [1, 5]).collect()}
    words = Counter()
    for r in got:
        own = dict((i, t) for i, t, _, _ in rows)[r.doc_id]
        words[r.doc_id] += len((r.text or "").split())
        position = [int(w.partition("w")[2]) for w in (r.text or "").split()]
        assert position == sorted(set(position)) and (r.text == own or r.n_chars == len(r.text))
    assert {i: n for i, n in words.items() if n} == {i: n for i, n in taken.items() if n}
    assert sum(r.doc_id in (100, 101) for r in got) == 2


def test_mixed_texts_keep_every_row(spark):
    def text(k):
        return " ".join(f"r{k}w{i}" for i in range(70 + k))

    # rows without an id, and rows that repeat one with other texts; sizes tell the rows apart
    ids = [None] * 12 + [3] * 12 + list(range(20, 32))
    rows = [(i, text(k), "ab"[k % 2], 0) for k, i in enumerate(ids)] + [(None, "", "a", 0), (None, "", "a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)
    words = Counter()
    empty = 0
    for r in mixing.mixed_texts(df, [1, 1]).collect():
        own = (r.text or "").split()
        empty += not own
        k = {w.partition("w")[0] for w in own}
        assert len(k) <= 1  # a row's words are its own
        if own:
            n = int(k.pop()[1:])
            assert r.doc_id == ids[n]
            words[r.doc_id, 70 + n] += len(own)
    taken = {(r.doc_id, r.size): r.taken for r in mixing.mix_documents(df, [1, 1]).collect() if r.taken}
    assert words == taken and len(taken) > 24 and empty == 2


def test_near_copies_are_judged_by_row(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(1, one, "a"), (5, one, "a"), (5, two, "b"), (7, three, "a"), (7, three, "a"), (None, one, "a"), (None, one, "b"), (8, "", "a"), (8, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted(((r.doc_id or 0, r.text or "", r.source) for r in ngram_join.keep_one_of_each(df).collect()))
    assert kept == sorted([(1, one, "a"), (5, two, "b"), (7, three, "a"), (0, one, "a"), (0, one, "b"), (8, "", "a"), (8, "", "a")])


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 7, 10, 64, 1000, 1 << 20, 2147483629, 10**13 + 7):
        lo = max(0, n - 2000)
        frame = spark.range(lo, n).withColumn("n", F.lit(n).cast("long"))
        got = [r.p for r in mixing.permuted(frame, "id", "n", [F.lit(3), F.lit("s")], "p").collect()]
        assert len(set(got)) == n - lo and min(got) >= 0 and max(got) < n
        if n >= 1000:  # neighbours don't stay neighbours, and the order is no arithmetic sequence
            steps = Counter((b - a) % n for a, b in zip(got, got[1:]))
            assert max(steps.values()) < 0.02 * len(got) and len(steps) > 0.6 * len(got)


def test_plain_draws(spark):
    df = spark.createDataFrame([(i, "w " * 400, "ab"[i % 2]) for i in range(300)], "doc_id long, text string, source string")
    mix = mixing.plan_mix(df, [1, 3], residual=False)
    n = {r["rank"]: r["count"] for r in mix.slots.groupBy("rank").count().collect()}
    assert abs(n[1] / (n[0] + n[1]) - 0.75) < 0.05 and n[0] + n[1] == 1875


TOKENIZER = None


def tokenizer_path():
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


ODD = ["", "Hello, World!", "it's we're I'D", "ΣΑΣ Ὀδυσσεύς", "İstanbul ı", "é café", "a\xa0b　c\x1cd", "x<|endoftext|>y <|startoftext|>", "12345 ½ ² 日本語", "tab\tnew\nline", "ß ÀÉ ÿ", "'sam 'tis", "🙂🙂 ok", "<| a|>"]


def test_tokenizer_is_exact():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(tokenizer_path()), packing.WordTokenizer(tokenizer_path())
    rng = random.Random(8)
    letters = "abcXYZ'.,!?-0189 \n\t\xa0éÉßÿΣσ́İ½<|>日🙂"
    for text in ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def slow_best(at, cost, length):
    """The cheapest cost over all sets of windows."""
    place = [0, *at]
    best = [0.0] + [float("inf")] * len(at)
    for i in range(1, len(place)):
        for j in range(i):
            n = place[i] - place[j]
            if n <= length:
                pad = 0 if n in {1 << k for k in range(9, 20)} else length - n
                best[i] = min(best[i], best[j] + pad + cost[i - 1] + packing.WINDOW_COST)
    return best[-1]


def test_windows_are_cheapest():
    rng = random.Random(6)
    for _ in range(60):
        at = np.cumsum([rng.choice([rng.randrange(1, 500), 256, 512]) for _ in range(rng.randrange(1, 40))])
        cost = np.array([rng.choice([0.0, 1.0, 24.0]) for _ in at])
        ends = packing.best_windows(at, cost, 1024 + 100)
        fee = dict(zip(at.tolist(), cost.tolist()))
        total, a = 0.0, 0
        for e in ends:
            n = e - a
            assert n <= 1124
            total += (0 if n in (512, 1024) else 1124 - n) + fee[e] + packing.WINDOW_COST
            a = e
        assert total == pytest.approx(slow_best(at.tolist(), cost.tolist(), 1124))


def test_tokenizer_keeps_little():
    """Long words and words met once aren't kept: an executor's workers hold their caches as long as they live."""
    own = packing.WordTokenizer(tokenizer_path())
    rng = random.Random(4)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(5_000)) for _ in range(40)] + ["n%dx" % k for k in range(2_000)] + ["ab " * 3]
    for t in texts * 2:
        assert own.ids(t) == np.array(own.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    held = lambda d: sum(len(k) + len(v) for k, v in d.items())
    assert "ab" in own.words and held(own.words) + held(own.older) + held(own.parts) < 100_000
    once = packing.WordTokenizer(tokenizer_path())
    once.ids(" ".join(texts[40:2_040]))
    assert len(once.words) < 100


def test_tasks_give_memory_back():
    resident = lambda: int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024
    pins = []

    def run(batches):
        for _ in batches:
            held = [bytes(1_000 + k % 7) for k in range(100_000)]
            pins.append(bytes(1_003))
            del held
            yield None

    before = resident()
    assert len(list(tidy(run)([0, 1]))) == 2
    assert resident() - before < 50


def test_pack_round_trip(spark, monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(7)
    texts = ODD + [" ".join(rng.choice(["alpha", "beta.", "gamma!", "delta,"]) for _ in range(rng.choice([3, 50, 900, 5000]))) for _ in range(30)] + [None, "nodot " * 9000]
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)] + [(None, "null id", 1)], "doc_id long, text string, length int").repartition(3)
    out = packing.pack_documents(df, tokenizer_path()).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert len(docs) == len(texts) + 1
    for i, pieces in docs.items():
        ids = whole.encode((texts[i] if i is not None else "null id") or "", add_special_tokens=False).ids + [1]
        pieces.sort(key=lambda r: r.start)
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces]).tolist() == ids
        assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist() and {r.doc_tokens for r in pieces} == {len(ids)}
    tokens = padding = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        n = sum(r.length for r in pieces)
        assert [r.offset for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist() and 0 < n <= 2048
        tokens, padding = tokens + n, padding + (2048 - n if n & (n - 1) else 0)
    assert padding < 3 * 2048 + 0.05 * tokens
    assert packing.pack_documents(df.filter("false"), tokenizer_path()).count() == 0


def test_pack_long_text_without_marks():
    tokenizer = packing.WordTokenizer(tokenizer_path())
    ids = np.frombuffer(tokenizer.ids("word " * 310_000), "<u4")
    assert len(ids) > 300_000 and not tokenizer.sentence_ends()[ids].any()
    packer = packing.Packer(tokenizer.sentence_ends(), long_marks=tokenizer.long_marks())
    short = np.arange(2, 40, dtype="<u4")
    pieces = [*packer.add("short", short), *packer.add("long", ids), *packer.settle(True, True)]
    for doc, own in (("short", short), ("long", ids)):
        assert np.concatenate([p[2] for p in pieces if p[0] == doc]).tolist() == own.tolist()
    sizes = Counter()
    for p in pieces:
        sizes[p[3]] += len(p[2])
    assert max(sizes.values()) <= 2048


def test_marks_of_other_scripts():
    tokenizer = packing.WordTokenizer(tokenizer_path())
    for text, n in (("これは本です。次の文！", 2), ("यह है। और॥", 2), ("هل هذا؟ نعم۔", 2), ("No mark here", 0), ("One. Two?", 2)):
        ids = np.frombuffer(tokenizer.ids(text), "<u4")
        assert len(packing.after_marks(ids, tokenizer.sentence_ends(), tokenizer.long_marks())) == n, text


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><article>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a><li>B</ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>Head &amp; line</h1></header><p>One <b>two</b> &nbsp; three<br>four.<p>Five &lt;six&gt; &#233;</p><div class="ad-box">Buy</div><ul><li>i<li>j</ul>
<table><tr><td>c1<td>c2</tr></table><form><input value="x"><p>Mail</p></form><figure><figcaption>Cap</figcaption></figure><div hidden>no</div></article>
<section id="comments"><article>Nice post</article></section></main><aside>Side</aside><footer>&copy; me</footer></body></html>"""


def page_text(source):
    return "\n".join(html.decided(html.blocks(source)))


def test_blocks():
    assert page_text(PAGE) == "Head & line\nOne two three four.\nFive <six> é\ni\nj\nc1\nc2\nCap"
    assert page_text("") == "" and page_text("plain  text") == "plain text"
    assert page_text("<div class=ad>x<article><p>kept <a hre") == "kept"
    assert page_text("<nav>a</nav><footer>b</footer>") == ""


def slow_repeated(streams, run):
    own = list(dict.fromkeys(map(tuple, streams)))
    where = defaultdict(set)
    for k, s in enumerate(own):
        for i in range(len(s) - run + 1):
            where[s[i : i + run]].add(k)
    out = []
    for s in streams:
        s, cover = tuple(s), [False] * len(s)
        for i in range(len(s) - run + 1):
            if len(where[s[i : i + run]]) >= 2:
                cover[i : i + run] = [True] * run
        out.append(cover)
    return out


def test_repeated_runs():
    rng = random.Random(2)
    for _ in range(40):
        streams = [[rng.randrange(3) for _ in range(rng.randrange(0, 25))] for _ in range(5)]
        streams.append(list(streams[0]))
        got = html.repeated([np.array(s, np.uint64) for s in streams], 4, 2)
        assert [g.tolist() for g in got] == slow_repeated(streams, 4)


def test_extract_pages(spark):
    menu = " ".join(f"item{k}" for k in range(12))
    page = lambda k: f"<div>{menu}</div><p>{' '.join(f'p{k}w{i}' for i in range(30))}</p><div>{menu} end</div>"
    rows = [(k, "http://h.org/%d" % k, page(k), "x") for k in range(4)] + [(9, "http://h.org/9", PAGE, "x"), (10, None, None, "x"), (11, "http://h.org/0", page(0), "x"), (None, "http://o.org/", "<p>alone</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id if r.page_id is not None else -1, r.text, r.n_chars) for r in html.extract_pages(df).collect()))
    want = {k: " ".join(f"p{k}w{i}" for i in range(30)) for k in range(4)} | {9: page_text(PAGE), 10: "", 11: " ".join(f"p0w{i}" for i in range(30)), -1: "alone"}
    assert got == sorted((k, t, len(t)) for k, t in want.items())
    assert html.extract_pages(df.filter("false")).count() == 0


def test_large_hosts_give_the_same(spark, monkeypatch):
    menu = " ".join(f"item{k}" for k in range(12))
    page = lambda k: f"<div>{menu} only{k} here{k}</div><nav>{menu}</nav><p>{' '.join(f'p{k // 2}w{i}' if i < 9 else f'q{k}w{i}' for i in range(30))}</p>"
    rows = [(k, f"http://h.org/{k}", page(k)) for k in range(40)] + [(50, "http://h.org/x", page(0)), (51, "http://o.org/", "<p>alone here</p>"), (52, "http://h.org/a", f"<article>{menu}</article><p>{menu}</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {}
    for words in (400_000, 50):
        monkeypatch.setattr(html, "SHARD_WORDS", words)
        got[words] = sorted((r.page_id, r.text, r.n_boilerplate) for r in html.extract_pages(df).collect())
    assert got[50] == got[400_000]
    texts = {i: t for i, t, _ in got[50]}
    # the menu goes and what is unique in its block stays
    assert texts[6] == "only6 here6\n" + " ".join(f"q6w{i}" for i in range(9, 30)) and texts[51] == "alone here" and texts[52] == menu


def slow_extract(rows):
    """(page_id, text) by the definition: runs of eight words outside articles on two distinct pages of a host are boilerplate,
    and for articles those of open blocks."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall(t.translate(LOWER))
    where = defaultdict(set)
    found = []
    for i, url, source in rows:
        every = html.blocks(source or "")
        host = re.split(r"[/?#]", (url or "://").split("://", 1)[1])[0].lower()
        only = tuple(low(" ".join(t for k, t in every if k == "open")))
        others = tuple(low(" ".join(t for k, t in every if k == "chrome"))) + only
        for kind, words in (("outside", others), ("inside", only)):
            for j in range(len(words) - 7):
                where[kind, host, words[j : j + 8]].add(words)
        found.append((i, ("inside" if any(k == "article" for k, _ in every) else "outside", host), html.decided(every)))
    out = []
    for i, scope, texts in found:
        words = tuple(w for t in texts for w in low(t))
        gone = set()
        for j in range(len(words) - 7):
            if len(where[(*scope, words[j : j + 8])]) > 1:
                gone |= set(range(j, j + 8))
        kept, at = [], 0
        for t in texts:
            places = list(word.finditer(t))
            own = [at + k in gone for k in range(len(places))]
            at += len(places)
            if any(own):  # what stands between a removed word and the next goes as well
                starts = [m.start() for m in places] + [len(t)]
                pieces, piece = [], "" if own[0] else t[: starts[0]]
                for k in range(len(places)):
                    if own[k]:
                        pieces.append(piece)
                        piece = ""
                    else:
                        piece += t[starts[k] : starts[k + 1]]
                t = " ".join(p for p in (" ".join(x.split()) for x in [*pieces, piece]) if p)
            if t:
                kept.append(t)
        out.append((i, "\n".join(kept or texts)))
    return sorted(out)


@pytest.mark.parametrize("words", [400_000, 30])
def test_extract_by_brute_force(spark, monkeypatch, words):
    monkeypatch.setattr(html, "SHARD_WORDS", words)
    rng = random.Random(11)
    phrase = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(4)) for _ in range(9)) for _ in range(6)]
    own = lambda k: " ".join(f"own{k}w{i}," for i in range(rng.randrange(1, 20)))
    rows = []
    for k in range(80):
        part = lambda: rng.choice([own(k), rng.choice(phrase), own(k) + " " + rng.choice(phrase) + " " + own(k)])  # noqa: B023, E731
        body = f"<nav>{rng.choice(phrase)}</nav><p>{part()}</p>"
        body += f"<article><h1>{own(k)}</h1><p>{part()}</p><p>{part()} é{k}</p></article>" if k % 2 else f"<p>{part()}</p>"
        rows.append((k, f"http://{'AB'[k % 3 == 0]}.org/{k}", body + f"<footer>{part()}</footer>"))
    rows += [(100, rows[5][1], rows[5][2]), (101, "http://b.org/x", None), (102, "http://b.org/y", f"<article>{phrase[0]}</article>"), (103, None, "<p>no host</p>")]
    got = sorted((r.page_id, r.text) for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect())
    assert got == slow_extract(rows)


def test_the_array_decides_inside_articles(spark):
    """A notice without any mark in an article goes once it stands in open blocks on two pages of the host."""
    notice = "please support our work by sending a letter to the editor today"
    page = lambda k: f"<article><p>{' '.join(f'a{k}w{i}' for i in range(20))}</p><p>{notice}</p></article>"
    pages = [(k, f"http://h.org/{k}", page(k)) for k in range(6)]
    text = lambda rows: {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    before = text(pages)
    assert all(t.endswith(notice) for t in before.values())  # text of articles alone is no evidence
    after = text(pages + [(10 + k, f"http://h.org/n{k}", f"<article>page {k} of its own</article><p>{notice} {k}</p>") for k in range(2)])
    assert all(after[k] == before[k].removesuffix("\n" + notice) for k in range(6))
    quoted = text(pages + [(10 + k, f"http://h.org/n{k}", f"<article>page {k} of its own</article><div class=ad>{notice} {k}</div>") for k in range(2)])
    assert all(quoted[k] == before[k] for k in range(6))  # an advert that quotes articles


def test_long_pages_of_broken_tags():
    began = time.time()
    for source in ("<a " * 350_000, '<a "' * 250_000, "<a \"'>'>\"" * 100_000, "<div>" * 100_000 + "</span>" * 100_000 + "x", "<!--" * 200_000, "<p>x<" * 100_000, "<" * 10**6):
        html.blocks(source)
    assert time.time() - began < 20
    assert page_text("a < b <b>c</b> <a title='>' href=\"x\">d</a> <i \"odd>e") == "a < b c d e"


def test_extract_matches_the_articles(spark, sf):
    from html import unescape

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    texts = {r.page_id: r.text for r in html.extract_pages(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert texts[r.page_id] == "\n".join(x for x in parts if x)


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    own = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = own
        own = stage(spark, own, sf)
        assert own.columns == docs.columns, name
        if name != "mixing":
            assert own.select("doc_id").join(before, "doc_id", "left_anti").count() == 0
            assert own.count() >= 0.3 * before.count()
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert whole.filter("n <> m or n > 2048").count() == 0
    assert out.select("doc_id").join(docs, "doc_id", "left_anti").count() == 0


def test_sources_get_their_targets(spark):
    """Large and small sources beside each other: targets to within a block, documents within three times their size."""
    sizes = {"a": [50_000], "b": [60, 40], "c": [70], None: [6], "y": [1], "x": [162], "d": [500, 300, 200]}
    rows = [(k, s, " ".join(["w"] * n)) for s, ns in sizes.items() for k, n in enumerate(ns, 10 * len(s or ""))]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for seed in (0, 1, 2):
        got = mixing.mix_documents(df, [1, 2, 3], seed).collect()
        for source_size in {r.source_size for r in got}:
            own = [r for r in got if r.source_size == source_size]
            taken, target = sum(r.taken for r in own), own[0].target
            block = source_size / -(-source_size // 64)
            assert abs(taken - target) <= block / 2 + 3, (source_size, taken, target)
            assert taken or target < block
        assert all(r.taken <= 3 * r.size for r in got)


def test_mixed_texts_of_a_million_words(spark):
    long = " ".join(f"w{i}" for i in range(1_000_000))
    df = spark.createDataFrame([(2**53 + 1, long, "a"), (None, "few words here", "b"), (4, "", "b")], "doc_id long, text string, source string")
    began = time.time()
    got = mixing.mixed_texts(df, [1, 2]).collect()
    assert time.time() - began < 60
    words = [[int(w[1:]) for w in r.text.split()] for r in got if r.doc_id == 2**53 + 1]
    assert words and all(w == sorted(set(w)) for w in words) and max(map(len, words)) > 900_000


def test_large_ids_beside_null_ones(spark):
    big = [2**53 + 1, 2**53 + 3, None, -(2**62) - 1]
    text = "one two three four five six seven eight. " * 3
    df = spark.createDataFrame([(i, text + str(i)) for i in big], "doc_id long, text string").coalesce(1)
    want = Counter(big)
    assert Counter(r.doc_id for r in packing.pack_documents(df, tokenizer_path()).collect()) == want
    got = ngram_join.ngram_classes(df).collect()
    assert Counter(r.doc_id for r in got) == want and {r.class_id for r in got} <= set(big)


def test_columns_named_like_working_columns_stay(spark):
    names = ["__kept", "__id", "__gone", "__row", "__hash", "__turn", "__pieces", "words", "rank", "h", "node"]
    rows = [(i, f"line number {i}\nthe same line in all of them", "a", *(f"{n}{i}" for n in names)) for i in range(4)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    for f in (lines.drop_repeated_lines, ngram_join.keep_one_of_each, lambda d: mixing.mixed_texts(d, [1])):
        got = f(df)
        assert got.columns == df.columns
        assert {(r.doc_id, *(r[n] for n in names)) for r in got.collect()} == {(r[0], *r[3:]) for r in rows}


def test_names_inside_articles_cost_no_text():
    kept = ['<p class="related-work">X</p>', '<section class="flash-fiction">X</section>', '<div class="share-price">X</div>', '<h2 id="search">X</h2>', '<h2 id="privacy">X</h2>', '<h2 id="copyright">X</h2>', '<section id="privacy">X</section>', "<fieldset>X</fieldset>", "<math><mi>X</mi></math>", '<p id="ad">X</p>']
    for source in kept:
        assert html.decided(html.blocks(f"<article><p>one</p>{source}<p>two</p></article>")) == ["one", "X", "two"], source
    gone = ['<div class="ad">X</div>', '<div class="related-posts">X</div>', '<section id="comments">X</section>', '<div class="share-buttons">X</div>', "<aside>X</aside>", "<form>X</form>", '<div class="newsletter-box">X</div>', '<p class="advert">X</p>', "<nav>X</nav>", '<div role="navigation">X</div>', '<div class="comment-list">X</div>']
    for source in gone:
        assert html.decided(html.blocks(f"<article><p>one</p>{source}<p>two</p></article>")) == ["one", "two"], source


def test_heading_outside_the_content():
    page = '<header><h1>Site</h1></header><h1>Title</h1><p>by line</p><div class="post-content"><p>text</p></div><footer>f</footer>'
    assert html.decided(html.blocks(page)) == ["Title", "text"]
    assert html.decided(html.blocks("<h1>Title</h1><p>text</p>")) == ["Title", "text"]
    assert html.decided(html.blocks("<h1>Title</h1><article><h1>Title</h1><p>text</p></article>")) == ["Title", "text"]


def test_mismatched_tags_take_linear_time():
    for source in ("<b>" + "<div>" * 60_000 + "</b>" * 60_000 + "x", "<p>" + "<span><div>" * 60_000 + "</span>x" * 60_000, "<ul>" + "<li><b><td>" * 60_000 + "</b>" * 60_000, "<table>" + "<p><b>" * 60_000):
        began = time.time()
        html.blocks(source)
        assert time.time() - began < 8
