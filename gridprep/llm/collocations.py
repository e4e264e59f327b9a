"""Phrase collocations by direct-address tiling.

Words get ids by their frequency. A pair of ids is a cell of a square, the square falls into tiles, and a tile is counted
by direct addressing: with a dense ``bincount`` where it has many pairs, as sorted coordinates where it has few. Pairs
that are frequent enough are ranked by frequency in turn, and such a ranked phrase takes the left side of the square with
the word after it on the right: that counts phrases of three and four words, and so on. A phrase is only counted where
both phrases one word shorter inside it are frequent, since no phrase is more frequent than its parts.

Ids are for the most frequent words and phrases, in a table of bounded size that all tasks have. Phrases with others are
counted by their words, dealt out by hash; where the shorter ones inside them aren't in the table a sieve of bounded size, which never
says no to a frequent one, decides whether they are looked at. So counts are exact whatever the table holds.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridprep.llm.common import _MULT, bits_of, cut, hits, mix64, sieve_words, small_batches

#: Words, and phrases of each length, that get ids at most.
HEAD = 1 << 18
#: Ids along the side of a tile.
TILE = 2_048
#: Tiles nearest to the origin in both directions, where the frequent ids are, are dealt out in so many strips.
NEAR, STRIPS = 4, 32
#: Dense tiles that a task holds at a time, and pairs of a chunk from which a tile becomes dense.
DENSE, DENSE_HITS = 4, 1 << 16
#: Bytes of a language's text that a task counts at once, cells in a row that it sends, and coordinates it holds.
CHUNK, SLICE, LOOSE = 8 << 20, 1 << 15, 4_000_000
#: Tasks whose counts of a tile are merged at a time.
FAN_IN = 256

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _BREAK.copy()
_GAP[[*b" \t"]] = True
_BREAKS = b".,;:!?\n\x0b\x0c\r"


@dataclass
class Head:
    """The ranked words and phrases of one language. ``shown[k]`` holds the phrases of k words in the order of their ranks;
    ``codes[k]`` the sorted pairs (rank of all words but the last, rank of the last) for k > 1, and ``ranks[k]`` theirs."""

    shown: dict[int, pa.Array] = field(default_factory=dict)
    codes: dict[int, np.ndarray] = field(default_factory=dict)
    ranks: dict[int, np.ndarray] = field(default_factory=dict)

    def add(self, k: int, phrases: list[str]) -> None:
        """The phrases of k words by falling frequency; those whose beginning or last word has no rank get none."""
        if k == 1:
            self.shown[1] = pa.array(phrases, pa.string())
            return
        start = self._ranks_of(k - 1, [p.rpartition(" ")[0] for p in phrases])
        last = self._ranks_of(1, [p.rpartition(" ")[2] for p in phrases])
        has = np.flatnonzero((start >= 0) & (last >= 0))
        code = start[has] << 32 | last[has]
        order = np.argsort(code)
        self.shown[k] = pa.array(phrases, pa.string()).take(pa.array(has))
        self.codes[k], self.ranks[k] = code[order], order.astype(np.int64)

    def _ranks_of(self, k: int, phrases: list[str]) -> np.ndarray:
        return ranks_in(pa.array(phrases, pa.string()), self.shown.get(k, pa.array([], pa.string())))


def ranks_in(values: pa.Array, ranked: pa.Array) -> np.ndarray:
    """The place of each value in ``ranked``, or -1."""
    return pc.fill_null(pc.index_in(values, value_set=ranked), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(text: bytes, limit: int = CHUNK) -> Iterator[bytes]:
    """A text in parts that end at breaks between pieces, of about ``limit`` bytes where there are breaks."""
    at = 0
    while len(text) - at > limit:
        end = max(text.rfind(bytes([b]), at, at + limit) for b in _BREAKS)
        if end <= at:
            end = min((x for b in _BREAKS if (x := text.find(bytes([b]), at + limit)) >= 0), default=len(text) - 1)
        yield text[at : end + 1]
        at = end + 1
    yield text[at:]


def by_language(batches: Iterator[pa.RecordBatch], limit: int = CHUNK) -> Iterator[tuple[str, list[bytes]]]:
    """Whole texts (lang, text) in lower case, language by language, in chunks of about ``limit`` bytes."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size: dict[str, int] = defaultdict(int)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for part in slices(text.as_py().lower(), limit):
                held[lang].append(part)
                size[lang] += len(part) + 1
                if size[lang] >= limit:
                    yield lang, held.pop(lang)
                    del size[lang]
        while sum(size.values()) > 4 * limit:
            lang = max(size, key=size.__getitem__)
            yield lang, held.pop(lang)
            del size[lang]
    yield from held.items()


class Words:
    """The words of texts: ``ids`` into ``shown`` in their order, and ``joined``: whether a word and the next are in one piece."""

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        inside = ~_GAP[data]
        step = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        breaks = np.flatnonzero(_BREAK[data])
        self.joined = np.searchsorted(breaks, end[:-1]) == np.searchsorted(breaks, start[1:])
        offsets = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        encoded = words.dictionary_encode()
        self.shown, self.ids = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)

    def spans(self, k: int) -> np.ndarray:
        """Whether k words from each place on are in one piece."""
        n = max(0, len(self.ids) - k + 1)
        out = np.ones(n, bool)
        for j in range(k - 1):
            out &= self.joined[j : j + n]
        return out


def text_rows(docs: DataFrame) -> DataFrame:
    """lang (null: und), text as bytes (null: empty)."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b"")).alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase, f: how often each word occurs; with a null phrase, all words of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in by_language(batches):
            words = Words(texts)
            n = len(words.shown)
            shown = pa.concat_arrays([words.shown, pa.array([None], pa.string())])
            count = np.append(np.bincount(words.ids, minlength=n), len(words.ids))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (n + 1), pa.string()), shown, pa.array(count)], ["lang", "phrase", "f"])

    parts = text_rows(docs).mapInArrow(run, "lang string, phrase string, f long")
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def most_frequent(phrases: DataFrame, limit: int) -> pd.DataFrame:
    """The rows of ``phrases`` (lang, phrase, f) with the largest f, at most ``limit``, by falling f; all of equal f or none."""
    level = F.floor(F.log2("f") * 64)
    counts = phrases.groupBy(level.alias("level")).count().toPandas().sort_values("level", ascending=False)
    inside = counts[counts["count"].cumsum() <= limit]["level"]
    if not len(inside):
        return pd.DataFrame({"lang": [], "phrase": []})
    got = phrases.filter(level >= int(inside.min())).toPandas()
    return got.sort_values(["f", "lang", "phrase"], ascending=[False, True, True])


def word_hash(lang: str, words: list[str]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), seed) for w in words), np.uint64, len(words))


def joined_hash(words: list[np.ndarray]) -> np.ndarray:
    """The hash of a phrase from those of its words, one array for each place."""
    out = np.zeros(len(words[0]), np.uint64)
    for w in words:
        out = mix64(out * _MULT + w)
    return out


def phrase_hashes(phrases: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, own in pdf.groupby("lang"):
                parts = [p.split(" ") for p in own["phrase"]]
                yield pd.DataFrame({"h": joined_hash([word_hash(lang, [p[j] for p in parts]) for j in range(k)]).view(np.int64)})

    return phrases.select("lang", "phrase").mapInPandas(run, "h long")


class Tiles:
    """Counts of pairs of ranks in the tiles of each language's square."""

    def __init__(self, side: int, dense: int = DENSE, dense_hits: int = DENSE_HITS) -> None:
        self.side, self.most, self.dense_hits = side, dense, dense_hits
        self.dense: dict[tuple[str, int], np.ndarray] = {}
        self.loose: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        self.held = 0

    def add(self, lang: str, left: np.ndarray, right: np.ndarray) -> None:
        cells = self.side * self.side
        tile = (left // self.side) << 20 | right // self.side
        cell = left % self.side * self.side + right % self.side
        tiles, hit = np.unique(tile, return_counts=True)
        for t in tiles[np.argsort(-hit)][: self.most]:
            full = (lang, int(t)) in self.dense
            if full or len(self.dense) < self.most and (tile == t).sum() >= self.dense_hits:
                own = tile == t
                count = np.bincount(cell[own], minlength=cells)
                if full:
                    self.dense[lang, int(t)] += count
                else:
                    self.dense[lang, int(t)] = count
                tile, cell = tile[~own], cell[~own]
        values, n = np.unique(tile * cells + cell, return_counts=True)
        self.loose[lang].append((values, n))
        self.held += len(values)
        if self.held > LOOSE:
            self.loose = defaultdict(list, {k: [merged(v)] for k, v in self.loose.items()})
            self.held = sum(len(v[0][0]) for v in self.loose.values())

    def full(self) -> bool:
        return self.held > LOOSE // 2

    def drain(self) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
        """(lang, tile, cells, counts) of all tiles, which are empty then."""
        for (lang, t), count in self.dense.items():
            at = np.flatnonzero(count)
            yield lang, t, at, count[at]
        cells = self.side * self.side
        for lang, held in self.loose.items():
            values, n = merged(held)
            tile = values // cells
            edges = np.flatnonzero(np.diff(tile, prepend=-1, append=-1))
            for a, b in zip(edges, edges[1:], strict=False):
                yield lang, int(tile[a]), values[a:b] - tile[a] * cells, n[a:b]
        self.dense.clear()
        self.loose.clear()
        self.held = 0


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted coordinates and their counts, from several such lists."""
    if len(held) == 1:
        return held[0]
    values, n = np.concatenate([v for v, _ in held]), np.concatenate([n for _, n in held])
    order = np.argsort(values, kind="stable")
    values, n = values[order], n[order]
    first = np.flatnonzero(np.diff(values, prepend=-1))
    return values[first], np.add.reduceat(n, first) if len(first) else n


TILE_SCHEMA = "lang string, tile long, strip int, salt int, cells binary, counts binary"


def _tile_rows(lang: str, tile: int, cells: np.ndarray, counts: np.ndarray, salt: int) -> list[tuple]:
    """Rows of TILE_SCHEMA; tiles near the origin fall into strips, whatever they hold, so all tasks agree."""
    near = tile >> 20 < NEAR and tile & 0xFFFFF < NEAR
    out = []
    for strip in range(STRIPS if near else 1):
        own = np.flatnonzero(cells % STRIPS == strip) if near else np.arange(len(cells))
        for a in range(0, len(own), SLICE):
            part = own[a : a + SLICE]
            out.append((lang, tile, strip, salt, np.diff(cells[part], prepend=0).astype("<u4").tobytes(), counts[part].astype("<i8").tobytes()))
    return out


def summed_phrases(held: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """Each distinct phrase with the sum of its counts."""
    encoded = pa.concat_arrays([p for p, _ in held]).dictionary_encode()
    total = np.zeros(len(encoded.dictionary), np.int64)
    np.add.at(total, encoded.indices.to_numpy(), np.concatenate([n for _, n in held]))
    return encoded.dictionary, total


def _phrase_rows(lang: str, phrases: pa.Array, counts: np.ndarray, buckets: int, salt: int) -> list[tuple]:
    """Rows of TILE_SCHEMA for phrases without ranks: a line each in ``cells``, and a bucket b as tile -1 - b."""
    shown = [p.encode("utf-8", "surrogatepass") for p in phrases.to_pylist()]
    bucket = np.fromiter((xxhash.xxh32_intdigest(p) % buckets for p in shown), np.int64, len(shown))
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    out = []
    for a, b in zip(edges, edges[1:], strict=False):
        for c in range(a, b, SLICE):
            own = order[c : min(b, c + SLICE)]
            out.append((lang, -1 - int(bucket[own[0]]), 0, salt, b"\n".join(shown[i] for i in own), counts[own].astype("<i8").tobytes()))
    return out


_NAMES = ["lang", "tile", "strip", "salt", "cells", "counts"]
_KINDS = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of TILE_SCHEMA in batches of bounded size."""
    at = size = 0
    for i, row in enumerate(rows):
        size += len(row[4]) + len(row[5])
        if size > CHUNK or i - at >= 5_000 or i + 1 == len(rows):
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows[at : i + 1]], kind) for j, kind in enumerate(_KINDS)], _NAMES)
            at, size = i + 1, 0


class Counter:
    """Counts the phrases of k words in chunks of texts: in tiles where they have ranks, as they are where they haven't."""

    def __init__(self, k: int, heads: dict[str, Head], sieve: np.ndarray | None, tile: int) -> None:
        self.k, self.heads, self.sieve = k, heads, sieve
        self.tiles = Tiles(tile)
        self.rest: dict[str, list[tuple[pa.Array, np.ndarray]]] = defaultdict(list)
        self.n_rest = 0

    def positions(self, lang: str, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of phrases whose parts may be frequent; the rank of all words but the last, and of the last, or -1."""
        k, head = self.k, self.heads.get(lang, Head())
        none = pa.array([], pa.string())
        word = ranks_in(words.shown, head.shown.get(1, none))[words.ids] if len(words.ids) else np.zeros(0, np.int64)
        rank = word
        for m in range(2, k):
            n = max(0, len(words.ids) - m + 1)
            code = np.where(words.spans(m) & (rank[:n] >= 0) & (word[m - 1 :] >= 0), rank[:n] << 32 | word[m - 1 :], -1)
            codes = head.codes.get(m, np.zeros(0, np.int64))
            at = np.searchsorted(codes, code)
            found = np.zeros(n, bool) if not len(codes) else codes[np.minimum(at, len(codes) - 1)] == code
            rank = np.full(n, -1, np.int64)
            rank[found] = head.ranks[m][at[found]] if len(codes) else 0
        # rank: of the phrase of k - 1 words from each place on
        known = rank >= 0
        if self.sieve is not None and len(known):
            h = word_hash(lang, words.shown.to_pylist())[words.ids]
            n = len(known)
            own = np.flatnonzero(~known & words.spans(k - 1))
            known[own[hits(self.sieve, joined_hash([h[j : j + n][own] for j in range(k - 1)]))]] = True
        n = max(0, len(words.ids) - k + 1)
        at = np.flatnonzero(words.spans(k) & known[:n] & known[1 : n + 1])
        return at, rank[at], word[at + k - 1]

    def add(self, lang: str, texts: list[bytes]) -> None:
        words = Words(texts)
        at, left, right = self.positions(lang, words)
        ranked = (left >= 0) & (right >= 0)
        if ranked.any():
            self.tiles.add(lang, left[ranked], right[ranked])
        rest = at[~ranked]
        if not len(rest):
            return
        code = words.ids[rest]
        for j in range(1, self.k):
            code = np.unique(code, return_inverse=True)[1] * len(words.shown) + words.ids[rest + j]
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        places = rest[first]
        columns = [words.shown.take(pa.array(words.ids[places + j])) for j in range(self.k)]
        self.rest[lang].append((pc.binary_join_element_wise(*columns, " "), n))
        self.n_rest += len(n)

    def full(self) -> bool:
        return self.tiles.full() or self.n_rest > LOOSE // 4

    def drain(self, buckets: int, salt: int) -> Iterator[pa.RecordBatch]:
        """All counts as rows of TILE_SCHEMA; none are held then."""
        rows: list[tuple] = []
        for found in self.tiles.drain():
            rows += _tile_rows(*found, salt)
            if sum(len(r[5]) for r in rows[-STRIPS:]) > CHUNK or len(rows) > 5_000:
                yield from _batches(rows)
                rows = []
        for lang, held in self.rest.items():
            rows += _phrase_rows(lang, *summed_phrases(held), buckets, salt)
        yield from _batches(rows)
        self.rest.clear()
        self.n_rest = 0


def phrase_counts(docs: DataFrame, k: int, heads: dict[str, Head], sieve: np.ndarray | None, min_count: int, tile: int) -> DataFrame:
    """lang, phrase, f of the phrases of k words with f of at least ``min_count``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((heads, sieve))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(k, *shared.value, tile)
        salt = TaskContext.get().partitionId() // FAN_IN
        for lang, texts in by_language(batches):
            counter.add(lang, texts)
            if counter.full():
                yield from counter.drain(buckets, salt)
        yield from counter.drain(buckets, salt)

    def summed(final: bool):
        """Adds up the counts of each strip of a tile and of each bucket of phrases; in the end as phrases."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ranked = shared.value[0] if final else {}
            at, held, n = None, [], 0

            def given() -> Iterator[pa.RecordBatch]:
                lang, t, strip, salt = at
                if t < 0:
                    phrases, counts = summed_phrases(held)
                    if not final:
                        yield from _batches(_phrase_rows(lang, phrases, counts, buckets, salt // FAN_IN))
                        return
                    often = np.flatnonzero(counts >= min_count)
                    phrases = phrases.take(pa.array(often))
                else:
                    cells, counts = merged(held)
                    if not final:
                        parts = [slice(a, a + SLICE) for a in range(0, len(cells), SLICE)]
                        yield from _batches([(lang, t, strip, salt // FAN_IN, np.diff(cells[p], prepend=0).astype("<u4").tobytes(), counts[p].astype("<i8").tobytes()) for p in parts])
                        return
                    often = np.flatnonzero(counts >= min_count)
                    left, right = (t >> 20) * tile + cells[often] // tile, (t & 0xFFFFF) * tile + cells[often] % tile
                    shown = ranked[lang].shown if len(often) else {}
                    phrases = pc.binary_join_element_wise(shown[k - 1].take(pa.array(left)), shown[1].take(pa.array(right)), " ") if len(often) else []
                if len(often):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(often), pa.string()), phrases, pa.array(counts[often])], ["lang", "phrase", "f"])

            for batch in batches:
                for row in batch.to_pylist():
                    key = (row["lang"], row["tile"], row["strip"], row["salt"])
                    if key != at:
                        if held:
                            yield from given()
                        at, held, n = key, [], 0
                    counts = np.frombuffer(row["counts"], "<i8")
                    if row["tile"] < 0:
                        held.append((pa.array(row["cells"].split(b"\n"), pa.binary()).cast(pa.string()), counts))
                    else:
                        held.append((np.cumsum(np.frombuffer(row["cells"], "<u4"), dtype=np.int64), counts))
                    n += len(counts)
                    if n > LOOSE:
                        held = [summed_phrases(held) if row["tile"] < 0 else merged(held)]
                        n = 0
            if held:
                yield from given()

        return run

    small_batches(spark)
    source = text_rows(docs)
    tiles = source.mapInArrow(counted, TILE_SCHEMA)
    salts = -(-source.rdd.getNumPartitions() // FAN_IN)
    keys = ["lang", "tile", "strip", "salt"]
    while salts > 1:
        tiles = tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(summed(False), TILE_SCHEMA)
        salts = -(-salts // FAN_IN)
    tiles = tiles.withColumn("salt", F.lit(0)).repartition(*keys).sortWithinPartitions(*keys)
    found = cut(tiles.mapInArrow(summed(True), "lang string, phrase string, f long"))
    shared.destroy()
    return found


def frequent_phrases(docs: DataFrame, min_count: int = 30, longest: int = 4, head: int = HEAD, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all words, and (lang, phrase, k, f) of every phrase of up to ``longest`` words that is there ``min_count``
    times or more."""
    counts = cut(word_counts(docs).filter(F.col("phrase").isNull() | (F.col("f") >= min_count)))
    words = counts.filter("phrase is null").select("lang", F.col("f").alias("n"))
    level = counts.filter("phrase is not null")
    levels = [level.withColumn("k", F.lit(1))]
    heads: dict[str, Head] = {}
    for k in range(2, longest + 1):
        n = level.count()
        ranked = most_frequent(level, head)
        given = 0
        for lang, own in ranked.groupby("lang", sort=False):
            heads.setdefault(lang, Head()).add(k - 1, own["phrase"].tolist())
            given += len(heads[lang].shown[k - 1])
        sieve = bits_of(phrase_hashes(level, k - 1), F.col("h"), sieve_words(n)) if given < n else None
        level = phrase_counts(docs, k, heads, sieve, min_count, tile)
        levels.append(level.withColumn("k", F.lit(k)))
    whole = levels[0]
    for more in levels[1:]:
        whole = whole.unionByName(more)
    return words, whole.select("lang", "phrase", "k", "f")


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases of two words or more that are no mere part of a longer one.

    Each cut of a phrase into two gives a score, and the lowest counts, of equal ones the first cut's. A phrase goes that
    lies inside a longer one which is there at least 0.8 times as often.
    """
    words = F.split("phrase", " ")
    part = lambda first, n: F.array_join(F.slice(words, first, n), " ")
    longer = phrases.filter("k > 1").withColumnRenamed("f", "a")
    cuts = longer.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "k", "a", "cut", part(1, F.col("cut")).alias("start"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    known = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("start"), F.col("f").alias("l")), ["lang", "start"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = "decimal(20,0)"
    score = F.expr(f"(cast(a as {exact}) * cast(2000000 as decimal(7,0))) div (cast(l as {exact}) + cast(r as {exact}))")
    best = F.min(F.struct(score.cast("long").alias("score"), "cut", "l", "r")).alias("best")
    found = cuts.groupBy("lang", "phrase", "k", "a").agg(best)
    inner = phrases.filter("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    inner = inner.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    inner = inner.select("lang", part(F.col("first"), F.col("size")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("whole"))
    found = found.join(inner, ["lang", "phrase"], "left")
    mere = F.col("whole").cast(exact) * 100 >= F.col("a").cast(exact) * 80
    return found.filter(F.col("whole").isNull() | ~mere).select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))


def first_of_each(rows: DataFrame, key: str, order: list, top: int) -> DataFrame:
    """The first ``top`` rows of each key with their ``rank`` from 1, without gathering a key in one task: all rows are sorted
    by range, and a key's rows in the parts before give the rest of the rank."""

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        seen: dict[str, int] = {}
        for pdf in batches:
            place = pdf.groupby(key).cumcount() + pdf[key].map(seen).fillna(0).astype("int64")
            for name, n in pdf[key].value_counts().items():
                seen[name] = seen.get(name, 0) + int(n)
            out = pdf.assign(part=np.int32(part), place=place.astype("int64"))
            yield out[out["place"] < top]

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    numbered = cut(rows.orderBy(key, *order).mapInPandas(placed, f"{kinds}, part int, place long"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = numbered.groupBy(key, "part").count().withColumn("begin", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    ranked = numbered.join(begins, [key, "part"]).withColumn("rank", F.col("begin") + F.col("place") + 1)
    return ranked.filter(F.col("rank") <= top).select(*rows.columns, "rank")


def collocations(docs: DataFrame, min_count: int = 30, top: int = 2000, longest: int = 4, head: int = HEAD, tile: int = TILE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language of ``docs`` (lang, text).

    Texts are taken in lower case (A-Z), pieces end at ``.,;:!?`` and line breaks, and words at blanks and tabs. Null
    languages count as ``und``, null texts as empty; repeated rows count each time, other columns are ignored. a, l, r are
    how often the phrase and the two sides of its cut occur, n all words of the language. A language without a phrase that
    occurs ``min_count`` times has no rows. Order: score and a descending, phrase ascending by its bytes.
    """
    words, phrases = frequent_phrases(docs, min_count, longest, head, tile)
    best = first_of_each(scored(phrases), "lang", [F.col("score").desc(), F.col("a").desc(), "phrase"], top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
