"""The smallest square window around a cell that holds a source, read from a bit map of the lattice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridprep.session import arrow_rows

#: Cells of a lattice whose bit map (an eighth of a byte a cell, 128 MB) all tasks may have.
MAX_CELLS = 1 << 30
SCHEMA = "cell long, gcol int, grow int, sc int, sr int, window long"


class Presence:
    """Which cells of a lattice hold a source, row by row; ``wraps``: the columns go round."""

    def __init__(self, bits: np.ndarray, first_col: int, first_row: int, ncol: int, wraps: bool) -> None:
        self.bits, self.first_col, self.first_row, self.ncol, self.wraps = bits, first_col, first_row, ncol, wraps
        self.kept: dict[int, np.ndarray] = {}

    def columns(self, row: int) -> np.ndarray:
        """The columns of a row that hold a source, ascending; on a lattice that wraps once more to the west and to the east."""
        if row not in self.kept:
            at = row - self.first_row
            found = np.zeros(0, np.int64)
            if 0 <= at < len(self.bits):
                found = np.flatnonzero(np.unpackbits(self.bits[at].view(np.uint8), bitorder="little")) + self.first_col
            if len(self.kept) > 4_096:
                self.kept.clear()
            self.kept[row] = np.concatenate((found - self.ncol, found, found + self.ncol)) if self.wraps else found
        return self.kept[row]

    def gap(self, row: int, cols: np.ndarray) -> np.ndarray:
        """How far the nearest source of a row is from each column; very far where the row has none."""
        have = self.columns(row)
        if not len(have):
            return np.full(len(cols), 1 << 40)
        at = np.searchsorted(have, cols)
        return np.minimum(np.abs(have[np.minimum(at, len(have) - 1)] - cols), np.abs(have[np.maximum(at - 1, 0)] - cols))

    def windows(self, row: int, cols: np.ndarray, limit: int) -> np.ndarray:
        """The cells to each side of the smallest window with a source around each column of a row; above ``limit``: none."""
        best = self.gap(row, cols)
        step = 1
        while step <= limit and (best > step).any():
            for other in (row - step, row + step):
                near = self.gap(other, cols)
                np.minimum(best, np.maximum(near, step), out=best)
            step += 1
        return best

    def sources(self, row: int, cols: np.ndarray, window: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(places in ``cols``, row, columns) of the sources at the edge of each window, where all that it holds are."""
        half = self.ncol // 2 if self.wraps else 1 << 40
        for step in range(int(window.max(initial=-1)) + 1):
            for other in {row - step, row + step}:
                have = self.columns(other)
                if not len(have):
                    continue
                # the upper and lower edge: all columns of the window
                at = np.flatnonzero(window == step)
                west, east = np.minimum(window[at], (self.ncol - 1) // 2 if self.wraps else 1 << 40), np.minimum(window[at], half)
                a, b = np.searchsorted(have, cols[at] - west), np.searchsorted(have, cols[at] + east, side="right")
                n = b - a
                if n.sum():
                    yield np.repeat(at, n), other, have[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
                # the sides
                at = np.flatnonzero(window > step)
                for k, side in enumerate((cols[at] - window[at], cols[at] + window[at])):
                    place = np.minimum(np.searchsorted(have, side), len(have) - 1)
                    # on a lattice that wraps both sides may be one column, or none where the window goes all round
                    hit = (have[place] == side) & (window[at] <= half) & ((k == 0) | (2 * window[at] != self.ncol) | (not self.wraps))
                    if hit.any():
                        yield at[hit], other, side[hit]


def presence(sources: DataFrame, ncol: int, wraps: bool, max_cells: int = MAX_CELLS) -> Presence | None:
    """The bit map of ``sources`` (gcol, grow), or none if their lattice has more than ``max_cells`` cells.

    Its size depends on the lattice alone: a bit a cell, brought together in words of 64.
    """
    edge = sources.agg(F.min("gcol"), F.max("gcol"), F.min("grow"), F.max("grow")).first()
    if edge[0] is None:
        return Presence(np.zeros((0, 1), np.uint64), 0, 0, ncol, wraps)
    words, rows = (edge[1] - edge[0]) // 64 + 1, edge[3] - edge[2] + 1
    if words * rows * 64 > max_cells:
        return None
    col = F.col("gcol") - edge[0]
    word = F.struct((F.col("grow") - edge[2]).cast("int").alias("r"), F.floor(col / 64).cast("int").alias("w")).alias("k")
    got = sources.groupBy(word).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (col % 64).cast("int"))).alias("bits")).select("k.r", "k.w", "bits").toPandas()
    bits = np.zeros((rows, words), np.uint64)
    bits[got["r"].to_numpy(np.int64), got["w"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return Presence(bits, edge[0], edge[2], ncol, wraps)


def nearest_sources(missing: DataFrame, have: Presence, limit: int) -> DataFrame:
    """cell, gcol, grow, sc, sr, window: a row for each source in the smallest window of each missing cell, row by row of the
    lattice; with nulls where no window of up to ``limit`` cells to each side holds one."""
    arrow_rows(missing.sparkSession)
    shared = missing.sparkSession.sparkContext.broadcast(have)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        have = shared.value
        for pdf in batches:
            cells, cols, rows = (pdf[c].to_numpy(np.int64) for c in ("cell", "gcol", "grow"))
            window = np.zeros(len(pdf), np.int64)
            met: list[tuple[np.ndarray, ...]] = []
            edges = np.flatnonzero(np.diff(rows, prepend=rows[:1] - 1, append=rows[-1:] + 1))
            for a, b in zip(edges, edges[1:], strict=False):
                row = int(rows[a])
                window[a:b] = have.windows(row, cols[a:b], limit)
                found = a + np.flatnonzero(window[a:b] <= limit)
                met += [(found[at], np.full(len(at), sr), sc) for at, sr, sc in have.sources(row, cols[found], window[found])]
            at, sr, sc = (np.concatenate([m[k] for m in met]).astype(np.int64) if met else np.zeros(0, np.int64) for k in range(3))
            if have.wraps:
                sc = sc % have.ncol
            none = np.flatnonzero(window > limit)
            every = np.concatenate((at, none))
            gone = [None] * len(none)
            yield pd.DataFrame({"cell": cells[every], "gcol": cols[every], "grow": rows[every], "sc": pd.array([*sc, *gone], "Int64"), "sr": pd.array([*sr, *gone], "Int64"), "window": pd.array([*window[at], *gone], "Int64")})

    own = missing.select(F.col("cell").cast("long").alias("cell"), F.col("gcol").cast("int").alias("gcol"), F.col("grow").cast("int").alias("grow"))
    return own.repartition("grow").sortWithinPartitions("grow").mapInPandas(run, SCHEMA)
