"""River networks solved tile by tile.

Cells fall into tiles of bounded size. A tile is solved in its task, in the order of the rivers: where each cell's way
leaves the tile, how far that is, and what gathers along it. What crosses a border between tiles makes a network of its own,
of the cells that are entered from other tiles, and only that small network goes through rounds of pointer doubling. Cells
are shuffled once, into tiles; after that a tile is a row of arrays, and only what crosses borders moves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridprep.session import arrow_rows, reliable_cut, stored

#: Ids of consecutive cells in a tile.
TILE = 1 << 16
CYCLE = "the river network has a cycle"

Tile = Callable[[Column], Column]


def tile_of_ids(size: int = TILE) -> Tile:
    """Tiles of consecutive ids; ids along the rows of a grid make stripes."""
    return lambda cell: F.floor(cell / F.lit(size)).cast("long")


def tile_of_blocks(ncol: int, side: int = 256) -> Tile:
    """Square tiles of a grid whose ids run along rows of ``ncol`` cells."""
    across = -(-ncol // side)
    return lambda cell: (F.floor(F.floor(cell / F.lit(ncol)) / F.lit(side)) * across + F.floor(F.pmod(cell, F.lit(ncol)) / F.lit(side))).cast("long")


def local_ways(cells: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For sorted cells and their next cells (negative: none): the place of the next one here or -1; the place where the way
    ends or leaves; the steps to it; and whether the way never ends."""
    n = len(cells)
    place = np.minimum(np.searchsorted(cells, to), n - 1)
    inside = (to >= 0) & (cells[place] == to)
    here = np.where(inside, place, -1)
    end = np.where(inside, place, np.arange(n))
    steps = inside.astype(np.int64)
    for _ in range(n.bit_length() + 1):
        further = end[end]
        if (further == end).all():
            break
        steps += steps[end]
        end = further
    return here, end, steps, inside[end]


def gathered(here: np.ndarray, steps: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sums of ``values`` over each place and all whose way inside the tile leads there."""
    out = values.copy()
    order = np.argsort(-steps, kind="stable")
    order = order[here[order] >= 0]
    edges = np.flatnonzero(np.diff(steps[order], prepend=-1, append=-1))
    for a, b in zip(edges, edges[1:], strict=False):
        own = order[a:b]
        np.add.at(out, here[own], out[own])
    return out


def along(here: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sums of ``values`` over each place and all on its way to where it leaves the tile."""
    total = values.copy()
    end = here.copy()
    while (moving := end >= 0).any():
        at = end[moving]
        total[moving] += total[at]
        end[moving] = end[at]
    return total


def _lists(**columns: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({k: [v] for k, v in columns.items()})


_TILED = "tile long, cell array<long>, here array<int>, end array<int>, onward array<long>, steps array<long>, value array<double>, weight array<long>, lost boolean, leaves boolean"


_BORDERS = "cell long, tile long, exit long, onward long, steps long, weight long"


class Tiled:
    """A network in tiles, and its borders.

    ``graph``: cell, next_cell (null: an outlet); ``values``: cell and ``value``, to be summed up; ``weights``: cell and
    weight, whole numbers to be summed down along the ways.
    """

    def __init__(self, graph: DataFrame, values: DataFrame | None = None, weights: DataFrame | None = None, tile: Tile | None = None) -> None:
        self.tile = tile or tile_of_ids()
        arrow_rows(graph.sparkSession, 32)
        # what belongs to a tile is sent to it side by side, without joins: steps (next cell), values, weights
        kinds = [graph.select("cell", F.lit(0).alias("kind"), F.coalesce("next_cell", F.lit(-1)).cast("long").alias("to"), F.lit(0.0).alias("x"))]
        if values is not None:
            kinds.append(values.select("cell", F.lit(1), F.lit(-1).cast("long"), F.col("value").cast("double")))
        if weights is not None:
            kinds.append(weights.select("cell", F.lit(2), F.col("weight").cast("long"), F.lit(0.0)))
        rows = kinds[0]
        for more in kinds[1:]:
            rows = rows.union(more)
        rows = rows.select(self.tile(F.col("cell")).alias("tile"), F.col("cell").cast("long").alias("cell"), "kind", "to", F.coalesce("x", F.lit(0.0)).alias("x"))

        def solved(pdf: pd.DataFrame) -> pd.DataFrame:
            kind, every = pdf["kind"].to_numpy(), pdf["cell"].to_numpy(np.int64)
            own = np.flatnonzero(kind == 0)
            own = own[np.argsort(every[own], kind="stable")]
            cells, to = every[own], pdf["to"].to_numpy(np.int64)[own]
            if not len(cells):
                return pd.DataFrame()
            value, weight = np.zeros(len(cells)), np.zeros(len(cells), np.int64)
            for k, out, column in ((1, value, "x"), (2, weight, "to")):
                given = np.flatnonzero(kind == k)
                at = np.minimum(np.searchsorted(cells, every[given]), len(cells) - 1)
                known = cells[at] == every[given]
                np.add.at(out, at[known], pdf[column].to_numpy()[given][known])
            here, end, steps, lost = local_ways(cells, to)
            onward = np.where(to[end] >= 0, to[end], -1)
            return _lists(tile=pdf["tile"].iloc[0], cell=cells, here=here.astype(np.int32), end=end.astype(np.int32), onward=onward, steps=steps, value=value, weight=weight, lost=bool(lost.any()), leaves=bool((onward >= 0).any()))

        self.tiles = stored(rows.groupBy("tile").applyInPandas(solved, _TILED))
        found = self.tiles.agg(F.bool_or("lost"), F.bool_or("leaves")).first()
        if found[0]:
            raise ValueError(CYCLE)
        #: Whether any way crosses a border; else there is nothing to do between tiles.
        self.crossed = bool(found[1])
        self.borders = self._borders() if self.crossed else graph.sparkSession.createDataFrame([], _BORDERS)

    def _borders(self) -> DataFrame:
        """cell (entered from another tile), tile, exit, onward (entered from there, or -1), steps and weight to the exit."""

        def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for onward in pdf["onward"]:
                    found = np.unique(onward)
                    yield pd.DataFrame({"cell": found[found >= 0]})

        def entered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for _, r in pdf.iterrows():
                    at = np.searchsorted(r["cell"], np.sort(r["wanted"]))
                    end, down = r["end"][at], along(r["here"], r["weight"])
                    yield pd.DataFrame({"cell": r["cell"][at], "tile": r["tile"], "exit": r["cell"][end], "onward": r["onward"][at], "steps": r["steps"][at], "weight": down[at]})

        wanted = self.tiles.select("onward").mapInPandas(left, "cell long").distinct()
        wanted = wanted.groupBy(self.tile(F.col("cell")).alias("tile")).agg(F.collect_list("cell").alias("wanted"))
        return stored(self.tiles.join(wanted, "tile").mapInPandas(entered, _BORDERS))

    def down(self) -> DataFrame:
        """cell, outlet, depth (steps to it) and the weights summed up from the cell to the outlet."""
        ends = "cell long, outlet long, depth long, weight long"
        plain = self.tiles.select("cell", "here", "end", "onward", "steps", "weight")
        if not self.crossed:
            return plain.mapInPandas(_spread_down, ends)
        state = self.borders.select("cell", F.when(F.col("onward") < 0, F.col("exit")).otherwise(F.col("onward")).alias("to"), (F.col("steps") + (F.col("onward") >= 0).cast("long")).alias("steps"), "weight", (F.col("onward") < 0).alias("done"))
        solved = _down_by_doubling(reliable_cut(state))
        # border cells' answers go to the tiles that are left towards them
        onward = self.tiles.select("tile", F.explode(F.array_distinct("onward")).alias("cell")).filter("cell >= 0").join(solved, "cell")
        known = onward.groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("cell", "outlet", "depth", "weight"))).alias("k"))
        known = known.select("tile", F.col("k.cell").alias("k_cell"), F.col("k.outlet").alias("k_outlet"), F.col("k.depth").alias("k_depth"), F.col("k.weight").alias("k_weight"))

        return self.tiles.join(known, "tile", "left").select(*plain.columns, "k_cell", "k_outlet", "k_depth", "k_weight").mapInPandas(_spread_down, ends)

    def up(self) -> DataFrame:
        """cell, value, upstream: the values summed up over the cell and all upstream, and how many cells these are."""

        total = "cell long, value double, upstream long"
        narrow = self.tiles.select("cell", "here", "onward", "steps", "value")
        if not self.crossed:
            return narrow.mapInPandas(_spread_up, total)

        def leaving(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for _, r in pdf.iterrows():
                    ends = np.flatnonzero((r["here"] < 0) & (r["onward"] >= 0))
                    value, n = (gathered(r["here"], r["steps"], x)[ends] for x in (r["value"], np.ones(len(r["here"]), np.int64)))
                    yield pd.DataFrame({"cell": r["onward"][ends], "value": value, "upstream": n})

        entering = narrow.mapInPandas(leaving, total).groupBy("cell").agg(F.sum("value").alias("value"), F.sum("upstream").alias("upstream"))
        edges = self.borders.select("cell", F.when(F.col("onward") >= 0, F.col("onward")).alias("next_cell"))
        inflow = _up_by_doubling(edges, entering)
        known = inflow.groupBy(self.tile(F.col("cell")).alias("tile")).agg(F.sort_array(F.collect_list(F.struct("cell", "value", "upstream"))).alias("k"))
        known = known.select("tile", F.col("k.cell").alias("k_cell"), F.col("k.value").alias("k_value"), F.col("k.upstream").alias("k_upstream"))
        return self.tiles.join(known, "tile", "left").select(*narrow.columns, "k_cell", "k_value", "k_upstream").mapInPandas(_spread_up, total)

    def closure(self, cells: DataFrame | None = None) -> DataFrame:
        """cell, down_cell, steps of every cell (or those of ``cells``): ways inside tiles, and the borders' own closure."""
        pairs = "cell long, down_cell long, steps long"

        def ways(r: pd.Series, at: np.ndarray) -> Iterator[pd.DataFrame]:
            """The places on the ways from ``at``, themselves included, a step of all of them at a time."""
            start, step = at, 0
            while len(at):
                yield pd.DataFrame({"cell": r["cell"][start], "down_cell": r["cell"][at], "steps": np.full(len(at), step, np.int64)})
                going = r["here"][at] >= 0
                start, at, step = start[going], r["here"][at][going], step + 1

        def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for _, r in pdf.iterrows():
                    at = np.arange(len(r["cell"])) if r["known"] is None else np.flatnonzero(np.isin(r["cell"], r["known"]))
                    for i, found in enumerate(ways(r, at)):
                        if i:
                            yield found

        def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for _, r in pdf.iterrows():
                    out = np.flatnonzero(r["onward"] >= 0)
                    if r["known"] is not None:
                        out = out[np.isin(r["cell"][out], r["known"])]
                    yield pd.DataFrame({"cell": r["cell"][out], "entry": r["onward"][out], "steps": r["steps"][out] + 1})

        def from_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for _, r in pdf.iterrows():
                    for found in ways(r, np.searchsorted(r["cell"], r["known"])):
                        yield found

        if cells is None:
            # of all cells
            asked = self.tiles.withColumn("known", F.lit(None).cast("array<long>"))
        else:
            known = cells.select("cell").distinct().groupBy(self.tile(F.col("cell")).alias("tile")).agg(F.sort_array(F.collect_list("cell")).alias("known"))
            asked = self.tiles.join(known, "tile")
        local = asked.select("cell", "here", "known").mapInPandas(inside, pairs)
        if not self.crossed:
            return local
        leaving = asked.select("cell", "onward", "steps", "known").mapInPandas(left, "cell long, entry long, steps long")
        edges = self.borders.select("cell", F.when(F.col("onward") >= 0, F.col("onward")).alias("to"), (F.col("steps") + 1).alias("steps"))
        reach = _closure_by_doubling(edges.filter("to is not null"))
        chain = reach.unionByName(self.borders.select("cell", F.col("cell").alias("down_cell"), F.lit(0).cast("long").alias("steps")))
        entries = self.borders.groupBy("tile").agg(F.sort_array(F.collect_list("cell")).alias("known"))
        tails = self.tiles.join(entries, "tile").select("cell", "here", "known").mapInPandas(from_entries, pairs)
        tails = tails.select(F.col("cell").alias("via"), "down_cell", F.col("steps").alias("more"))
        far = leaving.join(chain.select(F.col("cell").alias("entry"), F.col("down_cell").alias("via"), F.col("steps").alias("between")), "entry").join(tails, "via")
        return local.unionByName(far.select("cell", "down_cell", (F.col("steps") + F.col("between") + F.col("more")).alias("steps")))


def _spread_down(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """cell, outlet, depth, weight of tiles and what is known about the border cells that they are left towards."""
    for pdf in batches:
        for _, r in pdf.iterrows():
            outlet, depth, weight = r["cell"][r["end"]], r["steps"].copy(), along(r["here"], r["weight"])
            out = np.flatnonzero(r["onward"] >= 0)
            if len(out):
                at = np.searchsorted(r["k_cell"], r["onward"][out])
                outlet[out] = r["k_outlet"][at]
                depth[out] += 1 + r["k_depth"][at]
                weight[out] += r["k_weight"][at]
            yield pd.DataFrame({"cell": r["cell"], "outlet": outlet, "depth": depth, "weight": weight})


def _spread_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """cell, value, upstream of tiles and of what flows into them."""
    for pdf in batches:
        for _, r in pdf.iterrows():
            value, n = r["value"].copy(), np.ones(len(r["cell"]), np.int64)
            known = r.get("k_cell")
            if known is not None:
                at = np.searchsorted(r["cell"], known)
                value[at] += r["k_value"]
                n[at] += r["k_upstream"]
            yield pd.DataFrame({"cell": r["cell"], "value": gathered(r["here"], r["steps"], value), "upstream": gathered(r["here"], r["steps"], n)})


def _rounds(n: int) -> Iterator[int]:
    """Rounds of a doubling: a way without a cycle ends after as many as the number of cells has binary digits."""
    yield from range(max(1, n).bit_length() + 1)
    raise ValueError(CYCLE)


def _down_by_doubling(state: DataFrame) -> DataFrame:
    """cell, outlet, depth, weight from cell, to, steps, weight, done: where done, ``to`` is the outlet."""
    for _ in _rounds(state.count()):
        if state.filter(~F.col("done")).isEmpty():
            return state.select("cell", F.col("to").alias("outlet"), F.col("steps").alias("depth"), "weight")
        ahead = state.select(F.col("cell").alias("to"), F.col("to").alias("to2"), F.col("steps").alias("steps2"), F.col("weight").alias("weight2"), F.col("done").alias("done2"))
        moved = state.filter(~F.col("done")).join(ahead, "to")
        moved = moved.select("cell", F.col("to2").alias("to"), (F.col("steps") + F.col("steps2")).alias("steps"), (F.col("weight") + F.col("weight2")).alias("weight"), F.col("done2").alias("done"))
        state = reliable_cut(state.filter("done").unionByName(moved))
    return state


def _doubled(jump: DataFrame) -> DataFrame:
    return reliable_cut(jump.join(jump.select(F.col("cell").alias("to"), F.col("to").alias("to2")), "to").select("cell", F.col("to2").alias("to")))


def _up_by_doubling(edges: DataFrame, values: DataFrame) -> DataFrame:
    """cell, value, upstream: those of ``values`` summed up over all upstream cells of ``edges`` (cell, next_cell)."""
    names = ["value", "upstream"]
    acc = reliable_cut(edges.select("cell").join(values, "cell", "left").fillna(0, names).select("cell", *names))
    jump = reliable_cut(edges.filter("next_cell is not null").select("cell", F.col("next_cell").alias("to")))
    for _ in _rounds(jump.count()):
        if jump.isEmpty():
            return acc
        got = jump.join(acc, "cell").groupBy(F.col("to").alias("cell")).agg(*(F.sum(n).alias(f"more_{n}") for n in names))
        acc = reliable_cut(acc.join(got, "cell", "left").select("cell", *((F.col(n) + F.coalesce(f"more_{n}", F.lit(0))).alias(n) for n in names)))
        jump = _doubled(jump)
    return acc


def _closure_by_doubling(edges: DataFrame) -> DataFrame:
    """cell, down_cell, steps for edges of cell, to, steps."""
    jump = reliable_cut(edges)
    pairs = jump.select("cell", F.col("to").alias("down_cell"), "steps")
    for _ in _rounds(jump.count()):
        if jump.isEmpty():
            return pairs
        ahead = jump.select(F.col("cell").alias("down_cell"), "to", F.col("steps").alias("more"))
        far = pairs.join(ahead, "down_cell").select("cell", F.col("to").alias("down_cell"), (F.col("steps") + F.col("more")).alias("steps"))
        pairs = reliable_cut(pairs.unionByName(far))
        jump = reliable_cut(jump.join(jump.select(F.col("cell").alias("to"), F.col("to").alias("to2"), F.col("steps").alias("more")), "to").select("cell", F.col("to2").alias("to"), (F.col("steps") + F.col("more")).alias("steps")))
    return pairs


def outlets(graph: DataFrame, tile: Tile | None = None) -> DataFrame:
    """cell, outlet, depth (steps to it). A cycle is an error."""
    return Tiled(graph, tile=tile).down().select("cell", "outlet", "depth")


def accumulate(graph: DataFrame, values: DataFrame, value: str = "area", tile: Tile | None = None) -> DataFrame:
    """cell and the sum of ``value`` over itself and all cells upstream. A cycle is an error."""
    tiled = Tiled(graph, values.select("cell", F.col(value).alias("value")), tile=tile)
    return tiled.up().select("cell", F.col("value").alias(value))


def closure(graph: DataFrame, cells: DataFrame | None = None, tile: Tile | None = None) -> DataFrame:
    """cell, down_cell, steps: every cell downstream of each cell (of ``cells``, if given). A cycle is an error.

    The result has as many rows as the depths add up to: ask for the cells in play only, or for labels.
    """
    return Tiled(graph, tile=tile).closure(cells)


def tree_labels(graph: DataFrame, tile: Tile | None = None, values: DataFrame | None = None) -> DataFrame:
    """cell, outlet, depth, pre, upstream, value: numbers by which "downstream of" is a comparison.

    ``pre`` numbers the cells of a basin from its outlet upwards, each cell before all that drain into it, branch by branch
    (of smaller cells first); ``upstream`` counts a cell and all that drain into it. So d lies downstream of c, or is c, if
    both have one outlet and pre(d) <= pre(c) < pre(d) + upstream(d). ``value`` sums up ``values`` (cell, value) like
    ``upstream``; without them it is 0.
    """
    sums = stored(Tiled(graph, values, tile=tile).up())
    # a cell's number is its parent's, and one more, and the sizes of the branches before its own
    earlier = Window.partitionBy("next_cell").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    branches = graph.filter("next_cell is not null").join(sums.select("cell", "upstream"), "cell")
    steps = branches.select("cell", (F.lit(1) + F.coalesce(F.sum("upstream").over(earlier), F.lit(0))).alias("weight"))
    placed = Tiled(graph, weights=steps, tile=tile).down()
    return stored(placed.select("cell", "outlet", "depth", F.col("weight").alias("pre")).join(sums, "cell"))


def is_downstream(of: str, cell: str) -> Column:
    """Whether the labels of struct column ``cell`` are downstream of, or the same as, those of struct ``of``."""
    up, down = F.col(of), F.col(cell)
    return (up["outlet"] == down["outlet"]) & (down["pre"] <= up["pre"]) & (up["pre"] < down["pre"] + down["upstream"])


def labelled(df: DataFrame, labels: DataFrame, columns: Sequence[str] = ("cell", "other")) -> DataFrame:
    """A table with the labels of its cell columns as structs ``__cell``, ``__other``, where it has none yet; null for cells
    without labels. The labels grow with the network, so they aren't broadcast."""
    for c in columns:
        if f"__{c}" not in df.columns:
            own = labels.select(F.col("cell").alias(c), F.struct("outlet", "pre", "upstream", "value").alias(f"__{c}"))
            df = df.join(own.hint("merge"), c, "left")
    return df


def unrelated(pairs: DataFrame, graph: DataFrame, tile: Tile | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Pairs (cell, other, ...) of which neither is downstream of the other, nor the same; ``labels``: of tree_labels.

    Pairs that have columns ``__cell`` and ``__other`` of ``labelled`` are judged as they are: where cells are fewer than
    pairs, label them first."""
    if not {"__cell", "__other"} <= set(pairs.columns):
        labels = tree_labels(graph, tile) if labels is None else labels
    related = is_downstream("__cell", "__other") | is_downstream("__other", "__cell")
    return labelled(pairs, labels).filter(~F.coalesce(related, F.lit(False))).select(*pairs.columns)
