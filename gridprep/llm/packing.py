"""Packing: order-preserving dynamic programming over window cuts.

The token stream of the documents, in their order, is cut into windows of at most ``length`` tokens. Cuts lie at document
ends or at sentence ends (inside a sentence only where it is longer than a quarter of a window), and the cheapest set of
cuts is chosen: each window costs its padding, and a cut inside a document costs a truncation penalty. With S the tokens
before a cut, best[i] = penalty[i] + length - S[i] + min over j in reach of (best[j] + S[j]): a sliding minimum, kept in a
monotone queue. A window whose length is a power of two needs no padding, which adds a few transitions of fixed length.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterator, Sequence
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gridprep.llm.common import id_long, id_text, small_batches, text_column, tidy

LENGTH, END_ID = 2_048, 1
#: Costs in tokens of a cut at a sentence end and inside a sentence, and of a window as such.
SENTENCE_COST, INSIDE_COST, WINDOW_COST = 1.0, 24.0, 4.0
#: Tokens that the dynamic programme looks at before it settles all windows but the last.
HORIZON = 262_144
#: Marks that end a sentence; those of other scripts are often several ids.
MARKS = (".", "!", "?", "...", "!!", "??", *"…。．｡！？؟۔։।॥።။។")
#: Words that a tokenizer's cache takes up before the older half of it goes, and parts before all go; the longest that it
#: takes. A worker keeps the cache between tasks, and an executor has several workers, so it has to be small.
CACHE, LONGEST = 150_000, 64
#: Bytes of the sieve of words met once, which aren't kept yet.
MET = 1 << 21

_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -     　]")
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
#: Parts of lower-cased words that stand in a row with a space between them, and these spaces.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]| |[^a-zß-öø-ÿ0-9 ]+")


class WordTokenizer:
    """Token ids of texts by a tokenizer file whose tokens never span white space, with every distinct word done once.

    Texts fall into words at ASCII white space. Words of ASCII and common Latin letters fall into the tokenizer's own
    parts, those of a text that aren't known yet all at once; its model then takes new parts one by one. Any other word
    goes through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # the model's own cache only costs time behind those below
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)
        # the byte-level alphabet: printable bytes stand for themselves, the others for code points from 256
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.alphabet = "".join(names[b] for b in range(256))
        # each id's bytes, which words of one token share
        self.id_bytes = [pack("<I", k) for k in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.parts: dict[str, bytes] = {}
        # words met lately, and those met before them
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # a byte for each value of a word's hash: words met once, which most never are again
        self.met = bytearray(MET)

    def _tokens(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
        ids = self.id_bytes
        return b"".join([ids[t.id] for t in self.model.tokenize(shown)])

    def _part(self, part: str, whole: bool) -> bytes:
        """A part that has no ids in the caches; ``whole``: it is a word, which is kept as such."""
        found = self._tokens(part)
        if not whole and len(part) <= LONGEST and self._again(part):
            if len(self.parts) >= CACHE:
                self.parts.clear()
            self.parts[part] = found
        return found

    def _fill(self, words: list[str], found: list[bytes | None]) -> None:
        """Puts the ids of the words that have none into ``found``: the plain ones go through the patterns together."""
        plain: list[int] = []
        for k in [k for k, x in enumerate(found) if x is None]:
            word = words[k]
            ids = self.older.get(word)
            if ids is not None:
                found[k] = self._kept(word, ids)
            # an angle and a bar may begin a special token
            elif _PLAIN.fullmatch(word) and "<|" not in word:
                plain.append(k)
            else:
                found[k] = self._new(word, np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes())
        # not very many at a time: their parts are all in memory
        for a in range(0, len(plain), 1_000):
            some = plain[a : a + 1_000]
            own: list[bytes] = []
            at = 0
            word = words[some[0]]
            kept, kept_parts, older = self.words.get, self.parts.get, self.older.get
            for part in _PARTS.findall((" ".join([words[k] for k in some]) + " ").lower()):
                if part != " ":
                    # a part that stands alone elsewhere has the same ids there
                    own.append(kept(part) or kept_parts(part) or older(part) or self._part(part, part == word))
                    continue
                found[some[at]] = self._new(word, own[0] if len(own) == 1 else b"".join(own))
                own = []
                at += 1
                if at < len(some):
                    word = words[some[at]]

    def _new(self, word: str, found: bytes) -> bytes:
        return self._kept(word, found) if len(word) <= LONGEST and self._again(word) else found

    def _again(self, word: str) -> bool:
        """Whether the word was met before, or another of its hash."""
        at = hash(word) % MET
        again, self.met[at] = self.met[at], 1
        return bool(again)

    def _kept(self, word: str, found: bytes) -> bytes:
        if len(self.words) >= CACHE:
            self.words, self.older = {}, self.words
            self.met = bytearray(MET)
        self.words[word] = found
        return found

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        words = [w for w in re.split("[\t-\r ]+", text) if w] if _ODD_SPACE.search(text) else text.split()
        found = list(map(self.words.get, words))
        if None in found:
            self._fill(words, found)
        return b"".join(found)

    def sentence_ends(self) -> np.ndarray:
        """For each id whether it ends a sentence."""
        out = np.zeros(max(self.tokenizer.get_vocab_size(with_added_tokens=True), END_ID + 1), bool)
        for mark in MARKS:
            ids = self.tokenizer.encode(mark, add_special_tokens=False).ids
            if len(ids) == 1:
                out[ids[0]] = True
        return out

    def long_marks(self) -> list[list[int]]:
        """The ids of each mark that is several ids."""
        return [ids for mark in MARKS if len(ids := self.tokenizer.encode(mark, add_special_tokens=False).ids) > 1]


@lru_cache(maxsize=1)
def tokenizer_for(path: str) -> WordTokenizer:
    """One tokenizer for each worker process, whose tasks share its cache."""
    return WordTokenizer(path)


def after_marks(ids: np.ndarray, sentence_end: np.ndarray, long_marks: Sequence[list[int]] = ()) -> np.ndarray:
    """The places behind sentence marks, ascending."""
    found = sentence_end[ids]
    for mark in long_marks:
        at = np.flatnonzero(ids == mark[-1])
        at = at[at >= len(mark) - 1]
        for back, wanted in enumerate(mark[-2::-1], 1):
            at = at[ids[at - back] == wanted]
        found[at] = True
    return np.flatnonzero(found) + 1


def cuts(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, length: int, long_marks: Sequence[list[int]] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end (tokens before it, ascending) and what each costs; the last is the end of ``ids``."""
    docs = np.asarray(doc_ends, np.int64)
    sentences = after_marks(ids, sentence_end, long_marks)
    sentences = sentences[~np.isin(sentences, docs)]
    at = np.concatenate((docs, sentences))
    cost = np.concatenate((np.zeros(len(docs)), np.full(len(sentences), SENTENCE_COST)))
    order = np.argsort(at, kind="stable")
    at, cost = at[order], cost[order]
    # a long document's part may end anywhere: its tail is a gap as well
    if len(ids) and (not len(at) or at[-1] != len(ids)):
        at, cost = np.append(at, len(ids)), np.append(cost, INSIDE_COST)
    gap = np.diff(np.concatenate(([0], at)))
    step = length // 4
    wide = np.flatnonzero(gap > step)
    inner = [np.arange(at[k] - gap[k] + step, at[k], step) for k in wide]
    if inner:
        more = np.concatenate(inner)
        at, cost = np.concatenate((at, more)), np.concatenate((cost, np.full(len(more), INSIDE_COST)))
        order = np.argsort(at, kind="stable")
        at, cost = at[order], cost[order]
    return at, cost


def best_windows(at: np.ndarray, cost: np.ndarray, length: int) -> list[int]:
    """The ends of the cheapest windows; the last of ``at`` is one of them."""
    place = [0, *at.tolist()]
    fee = [0.0, *cost.tolist()]
    best = [0.0] * len(place)
    back = [0] * len(place)
    index = {s: i for i, s in enumerate(place)}
    powers = [1 << k for k in range(9, length.bit_length()) if 1 << k < length]
    queue: deque[int] = deque([0])
    value = [0.0] * len(place)
    for i in range(1, len(place)):
        s = place[i]
        reach = s - length
        while place[queue[0]] < reach:
            queue.popleft()
        j = queue[0]
        low = value[j] + length - s
        for p in powers:
            k = index.get(s - p)
            if k is not None and best[k] < low:
                low, j = best[k], k
        best[i] = low + fee[i] + WINDOW_COST
        back[i] = j
        value[i] = v = best[i] + s
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(i)
    ends = []
    i = len(place) - 1
    while i:
        ends.append(place[i])
        i = back[i]
    return ends[::-1]


class Packer:
    """Takes documents one by one; gives (document, start, ids, sequence, offset) pieces as soon as they are settled."""

    def __init__(self, sentence_end: np.ndarray, length: int = LENGTH, horizon: int = HORIZON, long_marks: Sequence[list[int]] = ()) -> None:
        self.sentence_end, self.length, self.horizon = sentence_end, length, max(horizon, 2 * length)
        self.long_marks = long_marks
        self.docs: list[tuple[object, int, np.ndarray]] = []  # document, its tokens settled before, the rest
        self.held, self.sequence = 0, 0

    def add(self, doc: object, ids: np.ndarray) -> Iterator[tuple]:
        # a very long document is settled in parts as well
        for a in range(0, len(ids), self.horizon):
            self.docs.append((doc, a, ids[a : a + self.horizon]))
            self.held += len(self.docs[-1][2])
            if self.held >= self.horizon:
                yield from self.settle(a + self.horizon >= len(ids), False)

    def settle(self, whole: bool, last: bool) -> Iterator[tuple]:
        """Packs what is held; unless it's the last, the final window stays open."""
        if not self.docs:
            return
        ids = np.concatenate([d[2] for d in self.docs])
        ends = np.cumsum([len(d[2]) for d in self.docs])
        real = [k + 1 == len(self.docs) and whole or k + 1 < len(self.docs) and self.docs[k + 1][0] is not self.docs[k][0] for k in range(len(self.docs))]
        at, cost = cuts(ids, ends[np.array(real, bool)], self.sentence_end, self.length, self.long_marks)
        windows = best_windows(at, cost, self.length)
        if not last:
            windows = windows[:-1]
        k, begin = 0, 0
        for start, end in zip([0, *windows], windows, strict=False):
            while begin < end:
                doc, before, own = self.docs[k]
                first = int(ends[k]) - len(own)
                stop = min(end, int(ends[k]))
                yield doc, before + begin - first, ids[begin:stop], self.sequence, begin - start
                begin = stop
                if begin == int(ends[k]):
                    k += 1
            self.sequence += 1
        rest = []
        for i in range(k, len(self.docs)):
            doc, before, own = self.docs[i]
            skip = max(0, begin - (int(ends[i]) - len(own)))
            rest.append((doc, before + skip, own[skip:]))
        self.docs = [d for d in rest if len(d[2])]
        self.held = sum(len(d[2]) for d in self.docs)


SCHEMA = "doc_id string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset.

    A document's tokens are its text's ids and then id 1, so null and empty texts have one token. The documents of an
    input partition follow one another in their order; sequence ids hold the partition, so they are unique. Each id lies
    in exactly one piece. Repeated rows are documents of their own; other columns are ignored; no rows, no pieces.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = tokenizer_for(tokenizer_path)
        packer = Packer(tokenizer.sentence_ends(), length, long_marks=tokenizer.long_marks())
        base = TaskContext.get().partitionId() << 36
        names = ["doc", "start", "ids", "sequence_id", "offset"]

        def frame(pieces: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(pieces, columns=names)
            return pd.DataFrame({
                "doc_id": pd.Series([d[0] for d in out["doc"]], dtype=object), "start": out["start"].astype("int64"), "length": [len(x) for x in out["ids"]],
                "ids": [x.astype("<u4").tobytes() for x in out["ids"]], "doc_tokens": [d[1] for d in out["doc"]],
                "sequence_id": base + out["sequence_id"].astype("int64"), "offset": out["offset"].astype("int64"),
            })

        end = np.array([END_ID], "<u4").tobytes()
        pieces: list[tuple] = []
        for pdf in batches:
            for i, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
                ids = np.frombuffer(tokenizer.ids(text) + end, "<u4")
                pieces += packer.add((i, len(ids)), ids)
                if len(pieces) >= 1_000:
                    yield frame(pieces)
                    pieces = []
        pieces += packer.settle(True, True)
        if pieces:
            yield frame(pieces)

    return id_long(docs.select(id_text(), text_column(docs)).mapInPandas(tidy(run), SCHEMA))
