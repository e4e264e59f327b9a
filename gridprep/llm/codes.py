"""Compression of vectors to codes of their parts, with nearest entries found by fixed pivots.

Vectors of integers are cut into parts, and each part position has a codebook that a few rounds of assigning and averaging
improve. Distances from every part to a few fixed pivots of its position are computed once and kept. In each round only the
pivots' distances to the current entries are new: the difference of two such distances is a lower bound of the distance
between part and entry. Entries are tried in the order of their bounds, and none whose bound is above the best distance so
far is evaluated; the evaluations themselves are exact sums of integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gridprep.llm.common import cut, small_batches, with_group_values

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
PIVOTS = 4
#: Components are kept inside this range, so that sums of squares are exact in 64 bits.
MOST = 1 << 25
#: Vectors that are assigned at once.
ROWS = 2_048
#: Share of two distances by which their difference may be off in 32-bit floats; twice what it can be.
SLACK = 1e-6


@dataclass
class Codes:
    """``rows``: vec_id, label, code (bytes), error; ``books``: for each part position its entries, one a row."""

    rows: DataFrame
    books: list[np.ndarray]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for book in self.books for x in book.ravel()).encode()).hexdigest()


def bounds(length: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin and end: equal ones, or as nearly equal as the length allows."""
    return [p * length // parts for p in range(parts + 1)]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to each entry."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        out += np.square(x[:, j, None] - entries[None, :, j])
    return out


def choose_pivots(entries: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """The first entry and then, each time, the one farthest from the pivots so far."""
    if not len(entries):
        return entries
    chosen = [0]
    near = distances(entries, entries[:1])[:, 0]
    while len(chosen) < min(n, len(entries)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each row (of equal ones the first), its squared distance, and how many pairs were evaluated."""
    n = len(x)
    of_pivots = np.sqrt(distances(pivots, entries).astype(np.float64))
    low = np.zeros((n, len(entries)))
    for p in range(len(pivots)):
        own = to_pivots[:, p, None].astype(np.float64)
        np.maximum(low, np.abs(own - of_pivots[p]) - SLACK * (own + of_pivots[p]), out=low)
    np.square(low, out=low)
    order = np.argsort(low, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max)
    code = np.zeros(n, np.int64)
    open_rows = np.arange(n)
    evaluated = 0
    for turn in range(len(entries)):
        entry = order[open_rows, turn]
        # bounds only grow from here on: a row that is done stays done; an equal distance may still have a smaller index
        going = low[open_rows, entry] <= best[open_rows]
        open_rows, entry = open_rows[going], entry[going]
        if not len(open_rows):
            break
        d = np.square(x[open_rows] - entries[entry]).sum(axis=1)
        evaluated += len(open_rows)
        better = (d < best[open_rows]) | (d == best[open_rows]) & (entry < code[open_rows])
        at = open_rows[better]
        best[at], code[at] = d[better], entry[better]
    return code, best, evaluated


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, q: the components as floor(scale * x), of the vectors without null or non-finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    clipped = lambda x: F.greatest(F.lit(float(-MOST)), F.least(F.lit(float(MOST)), x.cast("double") * float(scale)))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return vectors.filter(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.transform("embedding", lambda x: F.floor(clipped(x)).cast("int")).alias("q")
    )


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codes of ``vectors`` (vec_id, embedding, label if there is one).

    Vectors that are null or hold null or non-finite components take no part. The codebooks begin with the ``entries``
    smallest vec_ids (null ids last, of equal ids the smaller vector first); their first vector's length is that of all:
    vectors of another length have null codes and errors. Lengths that ``parts`` doesn't divide give parts as nearly equal
    as they can be. Components beyond 2^25 after scaling count as 2^25. Other columns are ignored; no vectors, no codes.
    """
    if entries > 256:
        raise ValueError("a code is a byte: at most 256 entries")
    small_batches(vectors.sparkSession, ROWS)
    whole = integer_vectors(vectors, scale)
    kind = whole.schema["label"].dataType.simpleString()
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    if not first:
        return Codes(whole.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")), [np.zeros((0, 0), np.int64)] * parts)
    length = len(first[0]["q"])
    edges = bounds(length, parts)
    seeds = np.array([r["q"] for r in first if len(r["q"]) == length], np.int64).reshape(-1, length)
    own = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
    books = [seeds[:, s].copy() for s in own]
    pivots = [choose_pivots(book) for book in books]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunked(batches):
            x = _matrix(batch.column("q"), length).astype(np.int64)
            near = np.concatenate([np.sqrt(distances(x[:, s], p).astype(np.float64)) for s, p in zip(own, pivots, strict=True)], axis=1)
            width = near.shape[1]
            near = pa.ListArray.from_arrays(np.arange(0, near.size + 1, width, np.int32), pa.array(near.astype(np.float32).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, near], ["vec_id", "label", "q", "near"])

    table = cut(whole.filter(F.size("q") == length).mapInArrow(measured, f"vec_id long, label {kind}, q array<int>, near array<float>"))
    n_pivots = len(pivots[0])

    def assigned(batch: pa.RecordBatch, books: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        x = _matrix(batch.column("q"), length).astype(np.int64)
        near = _matrix(batch.column("near"), parts * n_pivots)
        for p, s in enumerate(own):
            code, error, _ = nearest(x[:, s], near[:, p * n_pivots : (p + 1) * n_pivots], books[p], pivots[p])
            yield p, x[:, s], code, error

    def sums_with(books: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = [np.zeros(len(b), np.int64) for b in books]
            total = [np.zeros(b.shape, np.int64) for b in books]
            for batch in _chunked(batches):
                for p, x, code, _ in assigned(batch, books):
                    count[p] += np.bincount(code, minlength=len(books[p]))
                    np.add.at(total[p], code, x)
            for p in range(parts):
                for e in np.flatnonzero(count[p]):
                    values = np.append(total[p][e], count[p][e])
                    k = len(values)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(k, v, np.int32)) for v in (p, e)] + [pa.array(np.arange(k, dtype=np.int32)), pa.array(values)], ["part", "entry", "place", "value"])

        return run

    def coded_with(books: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _chunked(batches):
                code = np.zeros((batch.num_rows, parts), np.uint8)
                error = np.zeros(batch.num_rows, np.int64)
                for p, _, c, e in assigned(batch, books):
                    code[:, p] = c
                    error += e
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([r.tobytes() for r in code], pa.binary()), pa.array(error)], ["vec_id", "label", "code", "error"])

        return run

    for _ in range(rounds):
        # one number for each component of the codebooks, and how many parts each entry has
        made = table.mapInArrow(sums_with(books), "part int, entry int, place int, value long").groupBy("part", "entry", "place").agg(F.sum("value").alias("value")).toPandas()
        books = [b.copy() for b in books]
        for (p, e), rows in made.groupby(["part", "entry"]):
            values = rows.sort_values("place")["value"].to_numpy(np.int64)
            books[p][e] = values[:-1] // values[-1]
    coded = table.mapInArrow(coded_with(books), f"vec_id long, label {kind}, code binary, error long")
    odd = whole.filter(F.size("q") != length).select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    return Codes(coded.unionByName(odd), books)


def code_report(vectors: DataFrame) -> DataFrame:
    """vec_id, code (hex), error, label_error (the errors of all vectors with the label, nulls together), codebooks_sha256;
    see compress for all cases."""
    codes = compress(vectors)
    if not len(codes.books[0]):
        kinds = StructType([StructField("vec_id", LongType())])
        return vectors.sparkSession.createDataFrame([], kinds).selectExpr("vec_id", "'' AS code", "0L AS error", "0L AS label_error", "'' AS codebooks_sha256")
    rows = cut(codes.rows)
    groups = cut(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("size")))
    rows = with_group_values(rows, groups, ["label"], "size", rows.count())
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))
