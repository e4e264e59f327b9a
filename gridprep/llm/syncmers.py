"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest (by hash) of its inner s-mers is its first or its last. This
depends on the k-mer alone, so equal passages give equal anchors at equal relative positions wherever they stand.
A fingerprint keeps, for each of 64 bins of the anchors' hashes, the smallest hash in the bin (16 bits of it) and the place
of that anchor among the bins' anchors in the order of the text. Two fingerprints match position by position: of the bins
on which they agree only those count whose anchors follow one another in both texts (the longest such chain). Their share
of all bins estimates how much of the texts is the same and in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridprep.llm.common import _powers, chunks, id_long, id_text, mix64, small_batches, text_column

K, S, BINS = 20, 8, 64
EMPTY = 0xFFFF


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by doubling."""
    n = len(x) - width + 1
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n])


def anchors(texts: list[str], k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of all closed syncmers. A text without any that isn't empty has one anchor, the whole of it."""
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum(lengths)
    power, inverse = _powers(len(points) + 1)
    total = np.concatenate(([np.uint64(0)], np.cumsum(mix64(points.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)))
    text, at, value = [], [], []
    bare = lengths > 0
    if len(points) >= k:
        smers = mix64((total[s:] - total[:-s]) * inverse[: len(points) - s + 1])
        width = k - s + 1
        least = _sliding_min(smers, width)
        starts = np.flatnonzero((least == smers[: len(least)]) | (least == smers[width - 1 :]))
        owner = np.searchsorted(ends, starts, side="right")
        inside = starts + k <= ends[owner]
        starts, owner = starts[inside], owner[inside]
        bare[owner] = False
        text.append(owner)
        at.append(starts - (ends - lengths)[owner])
        value.append(mix64((total[starts + k] - total[starts]) * inverse[starts] + np.uint64(k)))
    short = np.flatnonzero(bare)
    begin = (ends - lengths)[short]
    text.append(short)
    at.append(np.zeros(len(short), np.int64))
    value.append(mix64((total[ends[short]] - total[begin]) * inverse[begin] + lengths[short].astype(np.uint64)))
    return np.concatenate(text), np.concatenate(at), np.concatenate(value)


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bins, ranks), one row of each for every text: 16-bit hashes, 0xFFFF where a bin is empty, as all of an empty text's
    are; and the place of each bin's anchor among the bins' anchors, by position in the text, 0xFF where it is empty.

    Of several anchors with a bin's smallest hash the first one counts.
    """
    text, at, value = anchors(texts)
    bins = (value >> np.uint64(58)).astype(np.int64)
    small = np.minimum((value >> np.uint64(42)) & np.uint64(0xFFFF), np.uint64(EMPTY - 1))
    least = np.full(len(texts) * BINS, np.uint64(EMPTY) << np.uint64(48), np.uint64)
    np.minimum.at(least, text * BINS + bins, small << np.uint64(48) | at.astype(np.uint64))
    least = least.reshape(-1, BINS)
    hashes = (least >> np.uint64(48)).astype(np.uint16)
    place = np.where(hashes == EMPTY, np.uint64(2**48 - 1), least & np.uint64(2**48 - 1))
    ranks = np.empty(place.shape, np.uint8)
    np.put_along_axis(ranks, place.argsort(1, kind="stable"), np.arange(BINS, dtype=np.uint8)[None, :], 1)
    ranks[hashes == EMPTY] = 0xFF
    return hashes, ranks


def longest_chain(agree: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row the largest number of its agreeing bins that come in the same order by ``a`` and by ``b``."""
    n = agree.shape[1]
    order = np.where(agree, a, 0xFF).argsort(1, kind="stable")
    agree, b = np.take_along_axis(agree, order, 1), np.take_along_axis(b, order, 1).astype(np.int16)
    length = np.zeros(agree.shape, np.int16)
    for j in range(int(agree.sum(1).max(initial=0))):
        before = np.where(b[:, :j] < b[:, j : j + 1], length[:, :j], 0).max(1, initial=0)
        length[:, j] = np.where(agree[:, j], before + 1, 0)
    return length.max(1, initial=0) if n else np.zeros(len(agree), np.int16)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Share of the bins filled in either on which both agree, in the same order of the texts; 1 for two empty ones."""
    filled = (a[0] != EMPTY) | (b[0] != EMPTY)
    n = filled.sum(1)
    return np.where(n > 0, longest_chain((a[0] == b[0]) & filled, a[1], b[1]) / np.maximum(n, 1), 1.0)


def _hex(prints: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The bins' hashes, then their ranks."""
    return [h.astype(">u2").tobytes().hex() + r.tobytes().hex() for h, r in zip(*prints, strict=True)]


def syncmer_anchors(docs: DataFrame) -> DataFrame:
    """doc_id, position, hash of every anchor of every whole text, for positional matching; null and empty texts have none."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks(texts):
                text, at, value = anchors(texts[a:b])
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[a:b].to_numpy()[text], "position": at, "hash": value.view(np.int64)})

    return id_long(docs.select(id_text(), text_column(docs)).mapInPandas(run, "doc_id string, position long, hash long"))


def syncmer_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hex) of every whole text; null texts are empty, repeated rows give a row each."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def hexed(texts: pd.Series) -> pd.Series:
        texts = texts.tolist()
        return pd.Series([x for a, b in chunks(texts) for x in _hex(fingerprints(texts[a:b]))], dtype=object)

    return docs.select("doc_id", hexed(text_column(docs)).alias("fingerprint"))


SCHEMA = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order, the one after the last marked ``extra``: each with the next one's text."""
    ids: list = []
    texts: list[str] = []

    def flush(last: bool) -> pd.DataFrame:
        own, following = texts[:-1], texts[1:]
        edited = []
        for t, nxt in zip(own, following, strict=True):
            n = len(t) // 4
            edited.append(t[: len(t) - n] + nxt[:n] if n else t)
        prints = fingerprints(texts)
        changed = fingerprints(edited)
        own_prints = tuple(x[:-1] for x in prints)
        return pd.DataFrame({
            "doc_id": pd.Series(ids[: len(own)], dtype=object), "n_chars": [len(t) for t in own],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
            "fingerprint": _hex(own_prints), "edited_fingerprint": _hex(changed),
            "near_edited": likeness(own_prints, changed), "near_next": likeness(own_prints, tuple(x[1:] for x in prints)),
        })

    size, ended = 0, False
    for pdf in batches:
        for i, t, extra in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), pdf["extra"].tolist(), strict=True):
            if ended:
                break
            ids.append(i)
            texts.append(t)
            size += len(t)
            ended = bool(extra)
            if len(texts) > 1 and (size > 500_000 or ended):
                yield flush(ended)
                ids[:], texts[:], size = ids[-1:], texts[-1:], len(t)
    if not ended and len(texts) > 1:
        raise RuntimeError("the row after the last is missing")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document, by ascending doc_id.

    Edited: the last floor(n_chars / 4) code points give way to the first as many (or all) of the next document; after
    the last comes the first. Null texts are empty; a null doc_id comes first; rows of equal doc_id are in the order of
    their texts. A single document follows itself; no documents, no rows. Other columns are ignored.

    Rows are dealt by ranges of doc_id and sorted there, and the first row of each range also goes to the range before.
    """
    spark = docs.sparkSession
    small_batches(spark)
    low = -(1 << 63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs))
    key = F.coalesce("doc_id", F.lit(low))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.select(key.cast("double").alias("x")).approxQuantile("x", [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    splits = [-float("inf"), *sorted(set(cuts or [])), float("inf")]
    bucketed = rows.withColumn("key", key)
    if len(splits) > 2:
        bucketed = Bucketizer(splits=splits, inputCol="x", outputCol="b").transform(bucketed.withColumn("x", key.cast("double")))
        bucketed = bucketed.withColumn("part", F.col("b").cast("int")).drop("x", "b")
    else:
        bucketed = bucketed.withColumn("part", F.lit(0))
    # one row for each range at most
    heads = sorted((r["part"], r["head"]) for r in bucketed.groupBy("part").agg(F.min("key").alias("head")).collect())
    if not heads:
        return id_long(spark.createDataFrame([], SCHEMA))
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    also = F.broadcast(spark.createDataFrame(before, "key long, part_before int"))
    home = F.struct(F.col("part"), F.lit(0).alias("extra"))
    dealt = bucketed.join(also, "key", "left").withColumn("to", F.explode(F.when(F.col("part_before").isNull(), F.array(home)).otherwise(F.array(home, F.struct(F.col("part_before").alias("part"), F.lit(1).alias("extra"))))))
    dealt = dealt.select("doc_id", "key", "text", F.col("to.part").alias("part"), F.col("to.extra").alias("extra"))
    dealt = dealt.repartitionById(len(splits) - 1, F.col("part")).sortWithinPartitions("extra", "key", "text")
    return id_long(dealt.select(id_text(), "text", "extra").mapInPandas(_compared, SCHEMA))
