"""What several operators share: cutting lineage, bounded batches, vectorised hashing of words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridprep.session import new_folder, shared_folder

#: Characters handled at once by the vectorised helpers; a longer text is a chunk of its own.
CHUNK_CHARS = 1_000_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; only where none is set (tests, one machine), one of our own."""
    return shared_folder(spark)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is computed by a frame made in here leaves no shuffle files behind. Otherwise they stay until the driver happens
    to collect its garbage, those of all steps so far beside each other."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed now and kept in the shared checkpoint folder: lost executors lose nothing."""
    checkpoint_dir(df.sparkSession)
    with passing_shuffles(df.sparkSession):
        # a frame of its own, with shuffles of its own: ``df`` may be computed again
        return df.select("*").checkpoint(eager=True)


def with_rows(df: DataFrame, name: str = "__row", dictionary: bool = True, path: str | None = None) -> DataFrame:
    """``df`` with a number of its own for each row, written once to the shared folder: every reading has the same.

    Columns of hashes are written faster without trying a dictionary. ``path``: a new folder that the caller releases."""
    numbered = df.withColumn(name, F.monotonically_increasing_id())
    path = path or new_folder(df.sparkSession, "rows")
    with passing_shuffles(df.sparkSession):
        numbered.write.option("parquet.enable.dictionary", dictionary).parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def shielded(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but the ``used`` ones under names that clash with none of ours, and what gives the columns
    of ``df`` back, in order and under their names."""
    names = [c if c in used else f"in_{i}" for i, c in enumerate(df.columns)]
    return df.toDF(*names), lambda out: out.select(*(F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True)))


def with_group_values(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, n_rows: int) -> DataFrame:
    """``rows`` with the values of their groups (one row for each combination of ``keys``, nulls being equal).

    ``size`` is the column of ``groups`` with the rows of each. Groups of more than a thousandth of the ``n_rows`` rows, of
    which there are at most a thousand, are broadcast; only the rows of the others are shuffled, so no group is a large
    part of a task. ``groups`` should be a stored table: it is read twice.
    """
    large = F.col(size) > max(1_000, n_rows // 1_000)
    values = [c for c in groups.columns if c not in keys]
    packed = groups.select(*(F.col(k).alias(f"__{k}") for k in keys), F.struct(*values).alias("__values"), large.alias("__large"))
    hot = F.broadcast(packed.filter("__large").select(*(F.col(f"__{k}").alias(f"__hot_{k}") for k in keys), F.col("__values").alias("__hot")))

    def same(prefix: str) -> Column:
        found = F.lit(True)
        for k in keys:
            found = found & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
        return found

    marked = rows.join(hot, same("__hot_"), "left")
    first = marked.filter("__hot is not null").select(*rows.columns, F.col("__hot").alias("__values"))
    second = marked.filter("__hot is null").select(*rows.columns).join(packed.filter("not __large"), same("__")).select(*rows.columns, "__values")
    return first.unionByName(second).select(*rows.columns, *(F.col(f"__values.{v}").alias(v) for v in values))


#: Words of 64 bits in a sieve: 8 MB.
SIEVE_WORDS = 1 << 20


def sieve_words(n: int, most: int = 1 << 23) -> int:
    """The size of a sieve for n rows: 16 bits or more a row, up to 64 MB."""
    return min(most, max(1 << 10, 1 << (-(-n // 4) - 1).bit_length())) if n else 1 << 10


def bits_of(wanted: DataFrame, h: Column, words: int = SIEVE_WORDS) -> np.ndarray:
    """A bit for each value of the hash ``h``, in a table of ``words`` words: rows whose bit is missing needn't be moved to
    be joined.

    When very many rows are wanted it lets more of the others pass, and at worst all; the join decides.
    """
    word, bit = F.pmod(F.shiftright(h, 6), F.lit(words)), F.pmod(h, F.lit(64)).cast("int")
    out = np.zeros(words, np.int64)
    with passing_shuffles(wanted.sparkSession):
        found = wanted.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
        got = found.toPandas()
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def hits(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The places of the hashes whose bit is set in a sieve."""
    word = (h.view(np.int64) >> 6) % len(table)
    return np.flatnonzero(table[word] >> (h % np.uint64(64)) & np.uint64(1))


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of at most so many rows, so that very long texts can't fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def give_back() -> None:
    """Gives the system the memory that this process has freed; its allocators would keep it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries than glibc have no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The same step of mapInPandas, with what its task has freed given back before and after: Spark keeps an executor's
    Python workers, several for each core, for the tasks of later stages."""

    def tidied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        yield from run(batches)
        give_back()

    return tidied


def id_text(name: str = "doc_id") -> Column:
    """An id as text: pandas makes doubles of a batch of longs with a null among them, and of large ids others."""
    return F.col(name).cast("long").cast("string").alias(name)


def id_long(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """Ids that went through pandas as text as longs again."""
    return df.withColumn(name, F.col(name).cast("long"))


def text_column(df: DataFrame, name: str = "text"):
    """Null texts count as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def chunks(texts: pd.Series | list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of whole texts with about ``limit`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: One pseudorandom 64-bit value for each byte; letters count as lower case.
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _MULT)
_BYTE[65:91] = _BYTE[97:123]
#: Word bytes: digits, letters and everything outside ASCII (the bytes of UTF-8 from 0x80).
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base mod 2^64 and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        base = int(_MULT) | 1
        inverse = pow(base, -1, 1 << 64)
        _POWERS[:] = [np.concatenate(([np.uint64(1)], np.full(n - 1, b, np.uint64))).cumprod(dtype=np.uint64) for b in (base, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


class Words:
    """The words of several texts as hashes: ``hash``, and for text i the words ``first[i]:first[i + 1]``.

    A word is a maximal run of ASCII letters and digits or characters from U+0080; A-Z count as a-z.
    ``start`` and ``end`` are byte positions in ``data``, the UTF-8 bytes of the texts joined by one blank.
    """

    def __init__(self, texts: list[str], hashed: bool = True) -> None:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw]))).astype(np.int64)
        inside = _WORD[self.data]
        step = np.diff(np.concatenate(([False], inside)).astype(np.int8))
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        self.first = np.searchsorted(self.start, self.offset)
        if hashed:
            power, inverse = _powers(len(self.data) + 1)
            total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[self.data] * power[:-1], dtype=np.uint64)))
            self.hash = mix64((total[self.end] - total[self.start]) * inverse[self.start])


def word_shingles(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words and where each text's begin; a shorter text has one run, of all its words."""
    w = Words(texts)
    n = np.diff(w.first)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    first = np.concatenate(([0], np.cumsum(counts)))
    # position of each shingle's first word
    at = np.arange(first[-1]) - np.repeat(first[:-1], counts) + np.repeat(w.first[:-1], counts)
    length = np.repeat(np.minimum(n, size), counts)
    out = np.zeros(len(at), np.uint64)
    padded = np.concatenate((w.hash, np.zeros(size, np.uint64)))
    for j in range(size):
        out = np.where(j < length, mix64(out * _MULT + padded[at + j]), out)
    return out, first
