"""Line dedup and packing do their work in bulk, with the results of the plain way."""

import os
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridprep import session
from gridprep.llm import common, lines, mixing, ngram_join, packing


def near(rng, line, n):
    line = list(line)
    for _ in range(n):
        line[rng.randrange(len(line))] = rng.choice("xyz")
    return "".join(line)


def grams(x):
    x = x.lower()
    return {x[k : k + 8] for k in range(max(len(x) - 7, 1))}


def slow_labels(group, texts):
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if group[a] == group[b] and len(grams(texts[a]) & grams(texts[b])) >= 0.8 * len(grams(texts[a]) | grams(texts[b])):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return label


def candidates(rng, sizes):
    group, texts = [], []
    for g, m in enumerate(sizes):
        base = "".join(rng.choice("abcdefgh ÉΣ日🙂") for _ in range(rng.choice([5, 30, 200])))
        for _ in range(m):
            base = near(rng, base, 3) if rng.random() < 0.3 else base
            texts.append(near(rng, base, rng.choice([0, 1, 4])))
            group.append(g)
    return np.array(group), texts


def test_pairs_of_lines_are_not_searched(monkeypatch):
    """A group of two lines is compared by sorting, many at a time; only larger ones that differ from their first line are searched."""
    rng = random.Random(5)
    group, texts = candidates(rng, [2] * 60)
    monkeypatch.setattr(lines, "linked_groups", lambda *_: pytest.fail("searched"))
    pdf = pd.DataFrame({"label": group, "i": 0, "j": 0, "blocks": 1, "node": np.arange(len(texts)), "line": texts})
    got = pd.concat(lines._verified(0.8)(iter([pdf[:70], pdf[70:]])))
    label = slow_labels(group, texts)
    assert sorted(zip(got["a"], got["b"])) == [(k, x) for k, x in enumerate(label) if k != x] and 5 < len(got) < 60


@pytest.mark.parametrize("dense", [0, 8, 256])
def test_groups_of_lines(monkeypatch, dense):
    monkeypatch.setattr(lines, "DENSE", dense)
    rng = random.Random(6)
    group, texts = candidates(rng, [2, 3, 20, 40, 5, 1, 12])
    owner, value = lines.line_hashes(texts)
    assert lines.linked_groups(group, owner, value, 0.8).tolist() == slow_labels(group, texts)
    pdf = pd.DataFrame({"label": group, "i": 0, "j": 0, "blocks": 1, "node": np.arange(len(texts)), "line": texts})
    got = pd.concat(lines._verified(0.8)(iter([pdf])))
    assert sorted(zip(got["a"], got["b"])) == [(k, x) for k, x in enumerate(slow_labels(group, texts)) if k != x]


def test_places_are_those_of_spark(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(-(1 << 63), 1 << 63), rng.randrange(1 << 31)) for _ in range(50)] + [(0, 0), (7, 999), (-1, 1_000)]
    df = spark.createDataFrame(rows, "doc_id long, line_no int")
    both = df.select(F.xxhash64("doc_id"), "line_no", F.xxhash64("doc_id", "line_no")).collect()
    seed, number, want = (np.array(x) for x in zip(*both, strict=True))
    assert lines._with_int(seed.view(np.uint64), number).view(np.int64).tolist() == want.tolist()


def test_known_words_are_parts_of_others(monkeypatch):
    """The model isn't asked again for a word that stands alone elsewhere, and the ids stay exact."""
    import public_tokenizers

    own = packing.WordTokenizer(str(public_tokenizers.path("word_bpe_49k.json")))
    asked = []
    plain = own._tokens
    monkeypatch.setattr(own, "_tokens", lambda part: asked.append(part) or plain(part))
    for text in ("thonre thonre eauée eauée", "Thonre, (thonre) thonre's thonre. eauée! Eauée\x85日 <|thonre|>", "thonre " * 2_500 + "it's thonre-" * 1_200):
        before = len(asked)
        assert own.ids(text) == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert before == 0 or not {"thonre", "eauée"} & set(asked[before:])


def shuffle_files(spark):
    every = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in every.split("\n") if "/shuffle_" in f}


def gone(spark, before, most=0):
    """Whether Spark, which deletes them a moment later, leaves at most so many bytes of new shuffle files."""
    for _ in range(100):
        if sum(os.path.getsize(f) for f in shuffle_files(spark) - before if os.path.exists(f)) <= most:
            return True
        time.sleep(0.1)
    return False


def test_stored_steps_leave_no_shuffle_files(spark):
    df = spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffle_files(spark)
    first, second = common.cut(df), common.with_rows(df)
    assert gone(spark, before)
    # the frame itself can be computed again and again, and keeps its files for that
    want = [(k, 143 if k < 6 else 142) for k in range(7)]
    assert all(sorted(map(tuple, x.collect())) == want for x in (df, df, first, second.drop("__row")))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_line_classes_leave_their_result_only(spark):
    rng = random.Random(8)
    texts = ["\n".join(near(rng, "a line of some length that is nearly repeated", 1) for _ in range(4)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before, folders = shuffle_files(spark), list(session._FOLDERS)
    found, repeated = lines.line_classes(df)
    assert session._FOLDERS == folders
    assert gone(spark, before, 2_000)  # sums of one row
    assert found.count() == 120 and repeated.count() > 20


def test_joins_and_mixes_of_the_pipeline_leave_no_shuffle_files(spark):
    rng = random.Random(10)
    texts = [" ".join(rng.choice(["some", "words", "of", "texts", "that", "repeat"]) for _ in range(60)) for _ in range(40)]
    texts += [t + " more" for t in texts]
    df = spark.createDataFrame([(k, t, "ab"[k % 2]) for k, t in enumerate(texts)], "doc_id long, text string, source string")
    before = shuffle_files(spark)
    rows, nodes, found = ngram_join.links(df)
    assert gone(spark, before, 2_000) and rows.count() == nodes.count() == found.count() == 80
    before = shuffle_files(spark)
    mix = mixing.plan_mix(df, [1, 2])
    assert gone(spark, before, 2_000) and mix.slots.count() > 10


def test_signatures_travel_in_eight_longs(spark):
    """By 16 bits of each value: values that are equal give equal bands, and others don't."""
    rng = random.Random(9)
    texts = [near(rng, base, rng.choice([0, 1, 9])) for base in ("".join(rng.choice("abcdefgh ÉΣ日") for _ in range(n)) for n in (3, 20, 200, 70_000)) for _ in range(5)]
    sig, n = lines.signatures("\n".join(texts)), np.array([len(t) for t in texts])
    packed = lines._packed(sig, n)
    assert packed.shape == (8, len(texts))
    df = spark.createDataFrame([tuple(map(int, row)) for row in packed.T], ", ".join(f"{c} long" for c in lines._FOURS)).coalesce(1)
    got = df.select(F.array(*lines._keys()), lines._length()).collect()
    assert [r[1] for r in got] == n.tolist()
    bands = sig.reshape(len(texts), lines.BANDS, lines.ROWS)
    same = (bands[:, None] == bands[None]).all(3)
    keys = np.array([r[0] for r in got])
    assert ((keys[:, None] == keys[None]) == same).all() and len(texts) * lines.BANDS < same.sum() < same.size
    assert len(set(keys[0])) == lines.BANDS
