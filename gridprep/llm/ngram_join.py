"""N-gram Jaccard join with Bayesian candidate pruning.

Texts become sets of runs of five words. Equal sets are one node from the start, so copies are never compared with each
other. Banded MinHash values give candidate pairs; a pair's MinHash values are then compared a few at a time, and it is
dropped as soon as the posterior probability that its similarity reaches the threshold falls below a tolerance. The
pairs that are left are verified on the whole sets.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridprep.llm.common import _MULT, bits_of, chunks, cut, hits, id_long, id_text, mix64, shielded, small_batches, text_column, tidy, with_rows, word_shingles
from gridprep.llm.components import components, forest

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS, STEP = 24, 4, 8
HASHES = BANDS * ROWS
#: Posterior probability below which a pair is dropped.
TOLERANCE = 1e-6
#: Members of a bucket or candidate component compared in one task; larger ones are dealt out as pairs of blocks.
BLOCK = 1_024
#: Shingles or characters that make one member; longer texts count as several.
UNIT = 1_000

_A = (mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * _MULT) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (mix64(np.arange(1001, HASHES + 1001, dtype=np.uint64) * _MULT) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: list[str], size: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    values, first = word_shingles(texts, size)
    for a, b in zip(first, first[1:], strict=False):
        yield np.unique(values[a:b])


def minhash(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of MinHash values for each of the non-empty runs ``first[i]:first[i + 1]`` of hashes."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first) - 1, HASHES), np.uint32)
    for a in range(0, len(first) - 1, 512):
        b = min(a + 512, len(first) - 1)
        part, at = x[first[a] : first[b]], (first[a:b] - first[a])
        for k in range(HASHES):
            out[a:b, k] = np.minimum.reduceat(part * _A[k] + _B[k], at)
    return out


@lru_cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, bins: int = HASHES, step: int = STEP) -> tuple[int, ...]:
    """After ``step``, 2 ``step``, ... of ``bins`` values: the fewest matches with which a pair stays.

    With a uniform prior the similarity's posterior after m matches of n is Beta(m + 1, n - m + 1), and the probability
    that it is the threshold or more equals that of at most m successes in n + 1 trials at the threshold.
    """
    out = []
    for n in range(step, bins + 1, step):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def _pairs(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places within each of several runs that follow one another."""
    ends = np.cumsum(lengths)
    run_end = np.repeat(ends, lengths)
    at = np.arange(len(run_end))
    after = run_end - at - 1
    left = np.repeat(at, after)
    right = np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after) + left + 1
    return left, right


def pruned(sig: np.ndarray, left: np.ndarray, right: np.ndarray, least: tuple[int, ...], step: int = STEP) -> np.ndarray:
    """Which pairs are left after comparing their values ``step`` by step."""
    keep = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    for k, fewest in enumerate(least):
        part = slice(k * step, (k + 1) * step)
        matches = matches + (sig[left[keep], part] == sig[right[keep], part]).sum(1)
        good = matches >= fewest
        keep, matches = keep[good], matches[good]
    return keep


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts = pdf["text"].tolist()
        ids = pdf["doc_id"].to_numpy()
        others = [c for c in pdf.columns if c not in ("doc_id", "text")]
        for a, b in chunks(texts):
            sets = list(shingle_sets(texts[a:b]))
            n = np.array([len(s) for s in sets])
            full = np.flatnonzero(n)
            node = pd.array([None] * (b - a), "Int64")
            sig: list = [None] * (b - a)
            if len(full):
                first = np.concatenate(([0], np.cumsum(n[full])))
                found = minhash(np.concatenate([sets[i] for i in full]), first).view(np.int32)
                for i, row in zip(full, found, strict=True):
                    sig[i] = row.tobytes()
                    node[i] = np.uint64(xxhash.xxh64_intdigest(sets[i].tobytes())).astype(np.int64)
            yield pd.DataFrame({"doc_id": ids[a:b], "node": node, "n": n.astype(np.int64), "sig": pd.Series(sig, dtype=object)} | {c: pdf[c].iloc[a:b].to_numpy() for c in others})


def whole_runs(batches: Iterator[pd.DataFrame], keys: list[str], rows: int = 4_000, text: str | None = None, size: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Batches sorted by ``keys`` as frames that never end inside a run of equal keys, of about so many rows or, by the
    lengths in column ``text``, about so large."""
    held: list[pd.DataFrame] = []
    n = total = 0
    for pdf in batches:
        if not len(pdf):
            continue
        held.append(pdf)
        n += len(pdf)
        total += int(pdf[text].map(len).sum()) if text else 0
        if n >= rows or total >= size:
            every = pd.concat(held, ignore_index=True)
            done = (every[keys] != every[keys].iloc[-1]).any(axis=1).to_numpy()
            if done.any():
                yield every[done].reset_index(drop=True)
            held = [every[~done]]
            n = len(held[0])
            total = int(held[0][text].map(len).sum()) if text else 0
    if n:
        yield pd.concat(held, ignore_index=True)


#: Members from which a bucket is searched from member to member instead of by all its pairs at once.
LARGE = 64


def searched(sig: np.ndarray, part: np.ndarray, within: bool, loose: np.ndarray, least: tuple[int, ...], step: int) -> np.ndarray:
    """For each member of a bucket the first one it hangs together with by pairs that pruning leaves.

    Each member in turn meets only those that aren't reached yet, so a bucket of similar members takes few turns, and
    never holds more than a row of pairs. Two blocks (not ``within``) meet each other only.
    """
    label = np.full(len(sig), -1)
    unreached = np.arange(len(sig))
    while len(unreached):
        seed = unreached[0]
        label[seed], unreached, todo = seed, unreached[1:], [seed]
        while todo and len(unreached):
            k = todo.pop()
            others = unreached if within else unreached[part[unreached] != part[k]]
            near = np.ones(len(others), bool)
            if not loose[k]:
                hard = np.flatnonzero(~loose[others])
                near[hard] = False
                near[hard[pruned(sig, np.full(len(hard), k), others[hard], least, step)]] = True
            new = others[near]
            if len(new):
                label[new] = seed
                todo += new.tolist()
                unreached = unreached[label[unreached] < 0]
    return label


def bucket_forest(bins: int, step: int, least: tuple[int, ...], filled: int = 0, columns: list[str] | None = None):
    """Within each bucket (or pair of its blocks) the pairs that pruning leaves, as a forest: one row for each member at most.

    Signatures of fewer than ``filled`` distinct values tell too little: their pairs all stay. A signature is the binary
    column sig, or its values, of 16 bits each, stand four by four in the long ``columns``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_runs(batches, ["key", "i", "j"]):
            key = pdf[["key", "i", "j"]].to_numpy(np.int64)
            new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(1))))
            sig = np.ascontiguousarray(pdf[columns].to_numpy(np.int64)).view(np.uint16)[:, :bins] if columns else np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(len(pdf), bins)
            short = (np.diff(np.sort(sig, axis=1), axis=1) != 0).sum(1) + 1 < filled
            node, part = pdf["node"].to_numpy(np.int64), pdf["part"].to_numpy()
            sizes = np.diff(np.append(new, len(pdf)))
            a = 0
            while a < len(sizes):  # runs until about half a million pairs are together
                if sizes[a] > LARGE:
                    own = slice(new[a], new[a] + sizes[a])
                    label = searched(sig[own], part[own], key[new[a], 1] == key[new[a], 2], short[own], least, step)
                    joined = np.flatnonzero(label != np.arange(sizes[a]))
                    yield pd.DataFrame({"a": node[own][joined], "b": node[own][label[joined]]})
                    a += 1
                    continue
                b, pairs = a, 0
                while b < len(sizes) and sizes[b] <= LARGE and pairs < 500_000:
                    pairs += sizes[b] * (sizes[b] - 1) // 2
                    b += 1
                left, right = _pairs(sizes[a:b])
                left, right = left + new[a], right + new[a]
                across = (key[left, 1] == key[left, 2]) | (part[left] != part[right])
                left, right = left[across], right[across]
                loose = short[left] | short[right]
                hard = np.flatnonzero(~loose)
                keep = np.concatenate((np.flatnonzero(loose), hard[pruned(sig, left[hard], right[hard], least, step)]))
                label = forest(len(pdf), left[keep], right[keep])
                joined = np.flatnonzero(label != np.arange(len(pdf)))
                yield pd.DataFrame({"a": node[joined], "b": node[label[joined]]})
                a = b

    return run


def shared_counts(sets: list[np.ndarray], width: int = 4_096) -> np.ndarray:
    """How many shingles each two sets share: products of the incidence matrix, a block of columns at a time."""
    n = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), n)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    # a shingle of one set alone is shared by none
    often = np.bincount(column)[column] > 1
    row, column = row[often], np.unique(column[often], return_inverse=True)[1]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [c, c + width])
        block = np.zeros((len(sets), width), np.float32)
        block[row[a:b], column[a:b] - c] = 1
        shared += block @ block.T
    return shared


def _verified(threshold: float):
    """Within each candidate component (or pair of its blocks): for each member the documents it links to, and a forest."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(len(pdf), HASHES)
        node, part, copies = pdf["node"].to_numpy(np.int64), pdf["part"].to_numpy(), pdf["copies"].to_numpy(np.int64)
        within, least = pdf["i"].iloc[0] == pdf["j"].iloc[0], least_matches(threshold)
        sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        n = np.array([len(x) for x in sets])
        shared = shared_counts(sets)
        x, y = [], []
        for k in range(len(pdf) - 1):  # a row of pairs at a time
            other = np.arange(k + 1, len(pdf))
            if not within:
                other = other[part[other] != part[k]]
            other = other[pruned(sig, np.full(len(other), k), other, least)]
            both = shared[k, other]
            linked = other[both >= threshold * (n[k] + n[other] - both) - 1e-6]
            x.append(np.full(len(linked), k))
            y.append(linked)
        x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (x, y))
        partners = np.bincount(x, copies[y], len(pdf)) + np.bincount(y, copies[x], len(pdf))
        hit = np.flatnonzero(partners)
        whole = np.full(len(hit), pdf["blocks"].iloc[0] == 1)
        return pd.DataFrame({"a": node[hit], "b": node[forest(len(pdf), x, y)[hit]], "partners": partners[hit].astype(np.int64), "whole": whole})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_runs(batches, ["label", "i", "j"], 500, "shingles", 32_000_000):
            found = [one(g.reset_index(drop=True)) for _, g in pdf.groupby(["label", "i", "j"], sort=False)]
            yield pd.concat(found)

    return run


def _sets(shared):
    """The shingle sets of the documents whose id passes the sieve."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = np.array([xxhash.xxh64_intdigest(struct.pack("<q", x), 42) for x in pdf["doc_id"].tolist()], np.uint64)
            texts = [pdf["text"].iloc[i] for i in hits(shared.value, ids)]
            for a, b in chunks(texts):
                sets = [s for s in shingle_sets(texts[a:b]) if len(s)]
                node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                yield pd.DataFrame({"node": node, "shingles": pd.Series([s.tobytes() for s in sets], dtype=object)})

    return run


def dealt(members: DataFrame, keys: list[str]) -> DataFrame:
    """Members of each group ``keys[0]`` as rows of the pairs of blocks (i, j) they go to, sorted; ``size``: of the group.

    A group of up to BLOCK members has one block; no task compares more than two blocks at a time. ``blocks``: how many.
    """
    members = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("part", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    members = members.withColumn("__q", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.withColumn("i", F.least("part", "__q")).withColumn("j", F.greatest("part", "__q")).drop("__q", "size")
    shuffles = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # within a block by node: where groups overlap, their forests then tend to have the same roots
    return members.repartition(shuffles, *keys).sortWithinPartitions(*keys, "node")


def links(docs: DataFrame, threshold: float = THRESHOLD, keys: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, nodes, found): doc_id, node and ``keys`` (columns of longs) of each row; node, copies, first_id; and (a, b,
    partners, whole) rows: node a hangs together with b by links and has so many partners among those it was compared
    with here; ``whole``: these were all it could link to, and b is the same for all of its component.

    Nodes are distinct shingle sets, by a 64-bit digest. No pair is ever a row: groups are compared in tasks, block by
    block, and give as many rows as they have members.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs), *keys)
    rows = cut(id_long(own.withColumn("doc_id", id_text()).mapInPandas(tidy(_signed), "doc_id string, node long, n long, sig binary" + "".join(f", {k} long" for k in keys))))
    full = rows.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    nodes = cut(full.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"), F.min("n").alias("n"), F.min("sig").alias("sig")))
    # buckets: nodes that share all values of a band
    values = [F.xxhash64(F.lit(b), F.substring("sig", 4 * ROWS * b + 1, 4 * ROWS)) for b in range(BANDS)]
    bands = nodes.select("node", F.explode(F.array(*values)).alias("key"))
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = bands.join(buckets, "key").join(nodes.select("node", "sig"), "node")
    near = dealt(members, ["key", "i", "j"]).select("key", "i", "j", "part", "node", "sig").mapInPandas(tidy(bucket_forest(HASHES, STEP, least_matches(threshold))), "a long, b long")
    # candidates that hang together are verified together, each text's set brought once for each block it meets
    group = cut(components(near).join(nodes, "node"))
    sizes = group.groupBy("label").agg(F.sum(F.ceil(F.col("n") / UNIT)).alias("size"))
    sieve = spark.sparkContext.broadcast(bits_of(group, F.xxhash64("first_id")))
    sets = own.select("doc_id", "text").filter("doc_id is not null").mapInPandas(tidy(_sets(sieve)), "node long, shingles binary").dropDuplicates(["node"])
    brought = sets.join(group.join(sizes, "label"), "node")
    spread = dealt(brought, ["label", "i", "j"]).select("label", "i", "j", "blocks", "part", "node", "copies", "sig", "shingles")
    return rows.select("doc_id", "node", *keys), nodes.drop("sig", "n"), cut(spread.mapInPandas(tidy(_verified(threshold)), "a long, b long, partners long, whole boolean"))


def _labels(found: DataFrame) -> DataFrame:
    """(node, label) of the nodes with links: only groups of several blocks still need to be joined."""
    return found.filter("whole").select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(components(found.filter("not whole").select("a", "b")))


def ngram_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links: one row for each input row.

    n_links counts the other documents whose similarity is ``threshold`` or more, copies included; class_id is the
    smallest doc_id of those that hang together by links. Texts of fewer than five words are one run of all their
    words; texts without words (null, empty) have no links and are classes of their own. Rows with a null doc_id take no
    part: class null, no links. Rows repeating a doc_id are documents with their own texts. Other columns are ignored.
    """
    rows, nodes, found = links(docs, threshold)
    partners = found.groupBy(F.col("a").alias("node")).agg(F.sum("partners").alias("partners"))
    label = _labels(found)
    info = nodes.join(partners, "node", "left").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = info.groupBy("label").agg(F.min("first_id").alias("class_id"))
    info = info.join(least, "label").select("node", "class_id", (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"))
    # a third of all rows may share a node: rows are not moved by it where the skew shows, AQE splits them
    out = rows.join(info, "node", "left")
    alone = F.col("node").isNull() | F.col("doc_id").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, F.lit(0).cast("long")).otherwise(F.col("n_links")).alias("n_links"))


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Of each class the row with the smallest doc_id, and all rows with a null doc_id or no words, with all columns.

    Each row is judged by its own text, also where rows repeat a doc_id; of a class's rows with one doc_id one stays.
    """
    docs, back = shielded(docs, "doc_id", "text")
    own = with_rows(docs.withColumn("__hash", F.xxhash64(text_column(docs))))
    rows, nodes, found = links(own, threshold, ("__hash", "__row"))
    label = nodes.select("node").join(_labels(found), "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    members = rows.filter("node is not null and doc_id is not null").join(label, "node")
    first = members.groupBy("label").agg(F.min(F.struct("doc_id", "__hash", "__row")).alias("first")).select(F.col("first.__row").alias("__row"))
    gone = members.select("__row").join(first, "__row", "left_anti")
    return back(own.join(gone, "__row", "left_anti"))
