"""Exact deduplication by two passes over Bloom filters: only rows whose digest may be repeated are shuffled.

The first pass sets bits for each row's digest and remembers which bits were set twice; a digest that is there twice has
set all its bits twice. The second pass asks for every row whether all its bits were set twice. A row with a bit that was
set once is unique for certain and goes straight through; the others, few more than the repeated ones, are grouped by
their whole digests, which decides exactly.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridprep.llm.common import cut, small_batches, with_group_values, with_rows

#: Bits of the filter for each row, in two halves with one bit of a digest each: about 2.4 % of unique rows are held up.
ROW_BITS = 12
#: Bits of the largest filter, 256 MB; more rows take several filters in turn, by a part of their digests.
MAX_BITS = 1 << 31
#: Pieces of each half in which tasks send their bits.
SEGMENTS = 128


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (SHA-256 of the text in UTF-8 with A-Z in lower case; null texts are empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashlib.sha256(t.as_py().lower()).digest() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "digest"])

    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, "doc_id long, digest binary")


def _parts(column: pa.Array) -> np.ndarray:
    """The digests as rows of four unsigned 64-bit numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 4)


def _places(parts: np.ndarray, half: int) -> np.ndarray:
    """(2, n): the bit of each digest in each half of the filter."""
    return (parts[:, :2].T & np.uint64(half - 1)).astype(np.int64)


class SetTwice:
    """Which bits were set once and which more often."""

    def __init__(self, n: int) -> None:
        self.once, self.twice = np.zeros(n, bool), np.zeros(n, bool)

    def add(self, places: np.ndarray) -> None:
        places, n = np.unique(places, return_counts=True)
        self.twice[places[n > 1]] = True
        self.twice[places[self.once[places]]] = True
        self.once[places] = True

    def merge(self, once: np.ndarray, twice: np.ndarray) -> None:
        self.twice |= twice | (self.once & once)
        self.once |= once


def twice_set(rows: DataFrame, half: int) -> np.ndarray:
    """The packed bits that two rows or more of ``rows`` (digest) have set, in both halves of ``half`` bits each.

    Tasks send the places of their bits, in segments, and each segment's are merged in one task.
    """
    width = max(8, half // SEGMENTS)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for side, places in enumerate(np.concatenate(held, axis=1)):
                values, n = np.unique(places, return_counts=True)
                edges = np.searchsorted(values, np.arange(0, half + 1, width))
                for k in np.flatnonzero(np.diff(edges)):
                    own = slice(edges[k], edges[k + 1])
                    at = (values[own] - k * width).astype("<u4")
                    yield pa.RecordBatch.from_pydict({"segment": pa.array([side * SEGMENTS + int(k)], pa.int32()), "once": [at.tobytes()], "twice": [at[n[own] > 1].tobytes()]})

        held, n = [], 0
        for batch in batches:
            held.append(_places(_parts(batch.column(0)), half))
            n += batch.num_rows
            if n >= 4_000_000:
                yield from piece(held)
                held, n = [], 0
        if held:
            yield from piece(held)

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        have: SetTwice | None = None
        at = None
        for pdf in batches:
            for segment, once, twice in zip(pdf["segment"].tolist(), pdf["once"], pdf["twice"], strict=True):
                if segment != at:
                    if have is not None:
                        yield pd.DataFrame({"segment": [at], "bits": [np.packbits(have.twice, bitorder="little").tobytes()]})
                    have, at = SetTwice(width), segment
                have.add(np.frombuffer(once, "<u4").astype(np.int64))
                have.twice[np.frombuffer(twice, "<u4").astype(np.int64)] = True
        if have is not None:
            yield pd.DataFrame({"segment": [at], "bits": [np.packbits(have.twice, bitorder="little").tobytes()]})

    sides = rows.select("digest").mapInArrow(sent, "segment int, once binary, twice binary")
    bits = sides.repartition("segment").sortWithinPartitions("segment").mapInPandas(merged, "segment int, bits binary")
    out = np.zeros((2 * SEGMENTS, width // 8), np.uint8)
    for row in bits.toLocalIterator():
        out[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(2, -1)[:, : half // 8]


def may_repeat(rows: DataFrame, n_rows: int, max_bits: int = MAX_BITS) -> list[DataFrame]:
    """``rows`` (with digest) with a column ``maybe``: false only where no other row has the digest.

    The filter has ROW_BITS for each row and at most ``max_bits``; beyond that rows are taken in turns by a part of their
    digests, a frame for each. The driver writes a filter to a file that Spark hands to the executors, which map it.
    """
    half = 1 << max(10, ((n_rows * ROW_BITS) // 2 - 1).bit_length() if n_rows else 0)
    turns = -(-2 * half // max_bits)
    half = min(half, max(1 << 10, 1 << (max_bits // 2).bit_length() - 1))
    spark = rows.sparkSession
    out = []
    names = [f.name for f in rows.schema]
    for turn in range(turns):
        own = rows
        if turns > 1:
            # the last bytes of the digest, which the filter doesn't use
            own = rows.filter(F.pmod(F.conv(F.hex(F.substring("digest", 29, 4)), 16, 10).cast("long"), F.lit(turns)) == turn)
        folder = tempfile.mkdtemp(prefix="gridprep-filter-")
        name = f"twice-{uuid.uuid4().hex}.bin"
        twice_set(own, half).tofile(os.path.join(folder, name))
        spark.sparkContext.addFile(os.path.join(folder, name))

        def tested(batches: Iterator[pa.RecordBatch], name: str = name) -> Iterator[pa.RecordBatch]:
            bits = np.memmap(SparkFiles.get(name), np.uint8, "r").reshape(2, -1)
            at = names.index("digest")
            for batch in batches:
                places = _places(_parts(batch.column(at)), half)
                found = np.ones(batch.num_rows, bool)
                for side in (0, 1):
                    found &= (bits[side][places[side] >> 3] >> (places[side] & 7).astype(np.uint8) & 1).astype(bool)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*names, "maybe"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        out.append(own.mapInArrow(tested, f"{kinds}, maybe boolean"))
    return out


def exact_groups(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs`` (doc_id, text).

    Texts are equal if they are identical with A-Z in lower case; null counts as empty. Of equal texts the row with the
    largest doc_id stays, null ids being smaller than all others; of several rows with that id exactly one. keep_id is
    the id of the row that stays, null where the group has no other. Other columns are ignored; no rows, no groups.
    """
    rows = with_rows(digests(docs))
    n = rows.count()
    tested = may_repeat(rows, n, max_bits)
    out = []
    for frame in tested:
        sha = F.lower(F.hex("digest")).alias("text_sha256")
        through = frame.filter(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
        held = cut(frame.filter("maybe").select("doc_id", "__row", "digest"))
        best = F.max(F.struct("doc_id", (-F.col("__row")).alias("row"))).alias("best")
        groups = cut(held.groupBy("digest").agg(best, F.count(F.lit(1)).alias("group_size")))
        rest = with_group_values(held, groups, ["digest"], "group_size", n)
        out += [through, rest.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("best.row") == -F.col("__row")).alias("kept"), sha)]
    whole = out[0]
    for frame in out[1:]:
        whole = whole.unionByName(frame)
    return whole
