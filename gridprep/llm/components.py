"""Connected components as a distributed union-find: parts of the edge table are contracted inside tasks, and alternating
large-star and small-star steps join the parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridprep.llm.common import cut, tidy

#: A node with more neighbours than this, and than a thousandth of all edges, is a hub: there are at most 2,000 of them.
HUB = 1_000
#: Edges that one task contracts at a time.
PART = 500_000


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place it hangs together with by the pairs."""
    label = np.arange(n)
    while len(left):
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == label).all():
            break
        # pairs that agree have done their work, but for roots that go on to others
        label = new
    return label


def _contracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of a part as stars: each node but the smallest of its component there, tied to the smallest."""

    def stars(held: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(held, ignore_index=True)
        nodes, place = np.unique(pdf[["u", "v"]].to_numpy(np.int64), return_inverse=True)
        place = place.reshape(-1, 2)
        label = forest(len(nodes), place[:, 0], place[:, 1])
        tied = np.flatnonzero(label != np.arange(len(nodes)))
        return pd.DataFrame({"u": nodes[tied], "v": nodes[label[tied]]})

    held: list[pd.DataFrame] = []
    n = 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= 2 * PART:
            # a part much above the average: its stars so far, and no more edges than nodes, go on
            held = [stars(held)]
            n = 0
    if held:
        yield stars(held)


def _with_minimum(edges: DataFrame, least: DataFrame, n_edges: int) -> DataFrame:
    """``edges`` (u, v) with the ``m`` of u from ``least`` (u, m, degree); the edges of hubs aren't moved to one task.

    More than n / 1000 of n edges meet at no more than 2,000 nodes, so these few rows of ``least`` are broadcast; the
    other edges are shuffled by u, and no u of theirs has many.
    """
    rest = least.select("u", "m")
    if n_edges <= HUB:
        return edges.join(rest, "u")
    hubs = F.broadcast(least.filter(F.col("degree") > max(HUB, n_edges // 1_000)).select("u", F.col("m").alias("hub_m")))
    marked = edges.join(hubs, "u", "left")
    return marked.filter("hub_m is not null").select("u", "v", F.col("hub_m").alias("m")).unionByName(marked.filter("hub_m is null").drop("hub_m").join(rest, "u"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: longs); the label is the smallest node of the component.

    Edges are dealt out in parts of about PART, and each part is contracted in its task to stars around the smallest nodes
    of its components. Where there are several parts a round of two steps joins them. Large star: every node ties its
    larger neighbours to its smallest one; small star: every node ties its smaller neighbours, itself included, to the
    smallest. All of them keep the components; together they end in stars around the smallest nodes after few rounds.
    Minima are aggregated before any shuffle, and the edges of nodes with very many neighbours get theirs by broadcast, so
    no node is a large group. Loops, repeated and null edges don't matter; each round is cut off in the checkpoint folder.
    """

    def settled(df: DataFrame) -> tuple[DataFrame, tuple]:
        # a sum of hashes tells whether the set of edges has changed; as a decimal, since a sum of longs may overflow
        seen = Observation()
        done = cut(df.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")))
        return done, (seen.get["n"], seen.get["digest"])

    loose = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    e, before = settled(edges.filter(loose).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while before[0]:
        parts = -(-before[0] // PART)
        e = e.coalesce(parts).mapInPandas(tidy(_contracted), "u long, v long")
        if parts == 1:
            e = cut(e)
            break
        e = cut(e)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree")).select("u", F.least("u", "m").alias("m"), "degree")
        # e holds each edge from its larger to its smaller end: the latter's minimum is wanted
        larger = e.select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = _with_minimum(larger, least, before[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # a node and all its smaller neighbours meet at the smallest
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        e, now = settled(small.unionByName(least.select("u", F.col("m").alias("v"))))
        if now == before:
            break
        before = now
    stars = e.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
