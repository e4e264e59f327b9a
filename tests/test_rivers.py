"""Rivers in tiles: any tiles give what one tile gives, and what a walk gives."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridprep.operators import graph, rivers


def forest(rng, n):
    """A forest whose ways lead to smaller or larger ids, so they cross borders back and forth."""
    names = list(range(n))
    rng.shuffle(names)
    return [(names[i], -1 if i == 0 or rng.random() < 0.05 else names[rng.randrange(max(0, i - 6), i)]) for i in range(n)]


@pytest.fixture(scope="module")
def walked():
    rng = random.Random(4)
    edges = forest(rng, 150)
    nxt = dict(edges)
    down = {}
    for i in nxt:
        path, j = [], i
        while nxt[j] >= 0:
            j = nxt[j]
            path.append(j)
        down[i] = path
    return edges, down


@pytest.mark.parametrize("size", [1, 7, 40])
def test_tiles_against_walk(spark, walked, size):
    edges, down = walked
    tile = rivers.tile_of_ids(size)
    river = graph.river_graph(spark.createDataFrame(edges, "cell long, next_cell long"))
    labels = {r.cell: r for r in rivers.tree_labels(river, tile).collect()}
    assert {i: (r.outlet, r.depth) for i, r in labels.items()} == {i: (p[-1] if p else i, len(p)) for i, p in down.items()}
    for i in down:
        for j in down:
            same = labels[i].outlet == labels[j].outlet
            assert (same and labels[j].pre <= labels[i].pre < labels[j].pre + labels[j].upstream) == (i == j or j in down[i])
    area = {i: float(i % 9 + 1) for i in down}
    total = rivers.accumulate(river, spark.createDataFrame(list(area.items()), "cell long, area double"), tile=tile)
    for r in total.collect():
        assert r.area == pytest.approx(area[r.cell] + sum(area[j] for j in down if r.cell in down[j]))


@pytest.mark.parametrize("size", [5, 60])
def test_closure_in_tiles(spark, walked, size):
    edges, down = walked
    tile = rivers.tile_of_ids(size)
    river = graph.river_graph(spark.createDataFrame(edges, "cell long, next_cell long"))
    want = {(i, j, k + 1) for i, p in down.items() for k, j in enumerate(p)}
    assert sorted(map(tuple, rivers.closure(river, tile=tile).collect())) == sorted(want)
    some = spark.createDataFrame([(i,) for i in (3, 77, 149, 150, 999)], "cell long")
    assert sorted(map(tuple, rivers.closure(river, some, tile).collect())) == sorted(w for w in want if w[0] in (3, 77, 149))


def test_cycles_across_tiles(spark):
    df = spark.createDataFrame([(0, 10), (10, 20), (20, 0), (1, 0), (30, -1)], "cell long, next_cell long")
    river = graph.river_graph(df)
    for job in (lambda: rivers.outlets(river, rivers.tile_of_ids(10)), lambda: rivers.accumulate(river, df.select("cell", F.lit(1.0).alias("area")), tile=rivers.tile_of_ids(10)), lambda: rivers.closure(river, tile=rivers.tile_of_ids(10))):
        with pytest.raises(ValueError, match="cycle"):
            job()


def test_large_ids_and_missing_values(spark):
    big = 2**53 + 1
    river = spark.createDataFrame([(big, big + 2), (big + 2, None), (5, None)], "cell long, next_cell long")
    values = spark.createDataFrame([(big, 2.0), (big + 2, None)], "cell long, area double")
    assert {(r.cell, r.area) for r in rivers.accumulate(river, values).collect()} == {(big, 2.0), (big + 2, 2.0), (5, 0.0)}
    assert {(r.cell, r.outlet) for r in rivers.outlets(river).collect()} == {(big, big + 2), (big + 2, big + 2), (5, 5)}


def test_square_tiles_cover_the_grid(spark):
    cells = spark.range(37 * 23).select(rivers.tile_of_blocks(37, 8)(F.col("id")).alias("tile"))
    sizes = [r["count"] for r in cells.groupBy("tile").count().collect()]
    assert len(sizes) == 5 * 3 and max(sizes) == 64


def test_borders_are_what_is_shuffled(spark):
    """On a lattice the network that goes through doubling is as long as the tiles' borders, not as large as the tiles."""
    n = 64
    cells = spark.range(n * n).select(F.col("id").alias("cell"))
    river = cells.withColumn("next_cell", F.when(F.col("cell") % n > 0, F.col("cell") - 1))
    tiled = rivers.Tiled(river, tile=rivers.tile_of_blocks(n, 16))
    assert tiled.borders.count() == n * 3
    got = {r.cell: r.depth for r in tiled.down().collect()}
    assert got == {i: i % n for i in range(n * n)}


def test_local_sums():
    rng = np.random.default_rng(1)
    to = np.array([-1, *(rng.integers(0, i) for i in range(1, 500))])
    here, end, steps, lost = rivers.local_ways(np.arange(500), to)
    assert not lost.any() and (end == 0).all() and (here == to).all()
    assert rivers.gathered(here, steps, np.ones(500))[0] == 500
    assert (rivers.along(here, np.ones(500, np.int64)) == steps + 1).all()
