"""Toxicity by a classifier chain: linear models in sequence, later ones fed the earlier categories' probabilities.

Features are the presence of words and of word beginnings, hashed to 64 bits. The model is fitted on a bounded sample of
labelled rows (``max_rows``, those with the smallest hash of doc_id), with the features that a chi-square test against a
category lets through. While fitting, what a later model gets from an earlier one are out-of-fold predictions, so it
learns how far they can be trusted. Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridprep.llm.common import _BYTE, _powers, Words, chunks, cut, mix64, small_batches, text_column, tidy, with_rows

#: Lengths in bytes of the word beginnings that count as features beside the word itself.
PREFIXES = (4, 5, 6)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, maybe repeated: each word's hash and those of its beginnings."""
    w = Words(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(w.first))
    power, inverse = _powers(len(w.data) + 1)
    total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[w.data] * power[:-1], dtype=np.uint64)))
    docs, found = [doc], [w.hash]
    for n in PREFIXES:
        long = np.flatnonzero(w.end - w.start > n)
        at = w.start[long]
        found.append(mix64((total[at + n] - total[at]) * inverse[at] + np.uint64(n)))
        docs.append(doc[long])
    return np.concatenate(docs), np.concatenate(found)


@dataclass
class Chain:
    """A fitted chain: one weight vector for each category, over the features and the earlier probabilities."""

    categories: list[str]
    vocabulary: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: list[np.ndarray] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    fitted: bool = False

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of the ones of the presence matrix."""
        doc, found = features(texts)
        if not len(self.vocabulary) or not len(found):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.zeros(1 << 16, bool)
        maybe[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        keep = maybe[(found & np.uint64(0xFFFF)).astype(np.int64)]
        doc, found = doc[keep], found[keep]
        at = np.minimum(np.searchsorted(self.vocabulary, found), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == found
        pair = np.unique(doc[hit] * np.int64(len(self.vocabulary)) + at[hit])
        return pair // len(self.vocabulary), pair % len(self.vocabulary)

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """One row for each text, one column for each category; zeros if nothing was fitted."""
        out = np.zeros((len(texts), len(self.categories)))
        if self.fitted:
            rows, cols = self.vectors(texts)
            for k, w in enumerate(self.weights):
                out[:, k] = _sigmoid(_margin(w, rows, cols, len(texts), out[:, :k]))
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _margin(w: np.ndarray, rows: np.ndarray, cols: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
    """Weights: those of the features, of the earlier categories' log-odds, and the intercept."""
    size = len(w) - earlier.shape[1] - 1
    return np.bincount(rows, w[cols], minlength=n)[:n] + _logit(earlier) @ w[size:-1] + w[-1]


def fit_linear(rows: np.ndarray, cols: np.ndarray, size: int, earlier: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 40) -> np.ndarray:
    """Logistic regression with an L2 penalty, by limited-memory quasi-Newton steps with backtracking."""
    n, k = earlier.shape
    odds = _logit(earlier)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        margin = _margin(w, rows, cols, n, earlier)
        residual = _sigmoid(margin) - y
        grad = np.concatenate((np.bincount(cols, residual[rows], minlength=size)[:size], odds.T @ residual, [residual.sum()]))
        grad[:-1] += l2 * w[:-1]
        return float(np.logaddexp(0, margin).sum() - y @ margin + l2 / 2 * (w[:-1] ** 2).sum()), grad

    w = np.zeros(size + k + 1)
    w[-1] = _logit(np.array([y.mean() if n else 0.5]))[0]
    value, grad = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, t in reversed(past):
            alphas.append((s @ q) / (s @ t))
            q -= alphas[-1] * t
        if past:
            s, t = past[-1]
            q *= (s @ t) / (t @ t)
        else:
            q /= max(1.0, float(np.abs(grad).sum()))
        for (s, t), a in zip(past, reversed(alphas), strict=True):
            q += (a - (t @ q) / (s @ t)) * s
        rate, slope = 1.0, float(grad @ q)
        while rate > 1e-6 and (new := loss(w - rate * q))[0] > value - 1e-4 * rate * slope:
            rate /= 2
        if rate <= 1e-6 or slope < 1e-9 * max(1.0, value):
            break
        if (step := -rate * q) @ (change := new[1] - grad) > 0:
            past = [*past[-7:], (step, change)]
        w, (value, grad) = w + step, new
    return w


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the highest F1 on out-of-fold predictions, halfway between neighbours, but 0.3 at least."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + max(1, y.sum()))
    k = int(np.argmax(f1)) if len(y) else 0
    if not len(y) or not y.sum():
        return 0.5
    following = p[order[k + 1]] if k + 1 < len(y) else 0.0
    return float(min(0.9, max(0.3, (p[order[k]] + following) / 2)))


def _counted(categories: list[str]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            labels = pdf[categories].to_numpy(np.int64)
            for a, b in chunks(texts):
                doc, found = features(texts[a:b])
                values, inverse = np.unique(found, return_inverse=True)
                pair = np.unique(inverse * np.int64(b - a) + doc)
                value, doc = pair // (b - a), pair % (b - a)
                out = {"feature": values.view(np.int64), "n": np.bincount(value, minlength=len(values))}
                for k, c in enumerate(categories):
                    out[f"y_{k}"] = np.bincount(value, labels[a:b][doc, k], minlength=len(values)).astype(np.int64)
                yield pd.DataFrame(out)

    return count


def fit_chain(docs: DataFrame, labels: DataFrame, categories: list[str], max_rows: int = 20_000, folds: int = 4, min_rows: int = 5, min_chi2: float = 20.0, max_features: int = 600) -> Chain:
    """Fits a chain over ``categories`` (0/1 columns of ``labels``), in this order.

    At most ``max_rows`` labelled rows are used, chosen by hash of doc_id and then of the text, however many rows repeat an
    id; rows with a null label, id or text don't count.
    Of the features in at least ``min_rows`` of them, those with a chi-square of ``min_chi2`` against a category are
    used, the ``max_features`` best of each category. With no labelled rows the chain gives 0 for everything. Repeated
    labels of a document: the largest value counts.
    """
    small_batches(docs.sparkSession)
    chain = Chain(list(categories))
    names = [f"y_{k}" for k in range(len(categories))]
    known = labels.dropna(subset=["doc_id", *categories]).groupBy("doc_id").agg(*(F.max(F.col(c).cast("int")).alias(n) for c, n in zip(categories, names, strict=True)))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # bounded by max_rows, so it may be broadcast; read once, as the fit goes over these rows several times
    found = docs.filter(F.col("text").isNotNull()).select("doc_id", text_column(docs)).join(F.broadcast(chosen), "doc_id")
    sample = with_rows(found.withColumn("__order", F.xxhash64("doc_id")).withColumn("__next", F.xxhash64("text")))
    if sample.count() > max_rows:
        # rows may repeat labelled ids: the bound holds for the rows, whose places alone are sorted
        place = F.struct("__order", "__next", "__row")
        last = sample.select(place.alias("p")).orderBy("p").limit(max_rows).agg(F.max("p")).first()[0]
        sample = sample.filter(place <= F.struct(*(F.lit(x).cast("long").alias(n) for n, x in last.asDict().items())))
    sample = sample.drop("__order", "__next", "__row")
    counts = sample.mapInPandas(tidy(_counted(names)), "feature long, n long, " + ", ".join(f"{n} long" for n in names))
    counts = counts.groupBy("feature").agg(F.sum("n").alias("n"), *(F.sum(n).alias(n) for n in names)).filter(F.col("n") >= min_rows)
    total = sample.agg(F.count(F.lit(1)).alias("n"), *(F.sum(n).alias(n) for n in names)).first()
    if not total["n"]:
        return chain
    counts = cut(counts)
    vocabulary: set[int] = set()
    for n in names:
        rows, pos, used = float(total["n"]), float(total[n]), F.col("n").cast("double")
        expected = used * pos / rows
        spread = used * (pos / rows) * (1 - pos / rows) * (1 - used / rows)
        score = F.when(spread > 0, (F.col(n) - expected) ** 2 / spread)
        best = counts.select("feature", score.alias("chi2")).filter(F.col("chi2") >= min_chi2).orderBy(F.desc("chi2"), "feature").limit(max_features)
        vocabulary |= {r["feature"] for r in best.collect()}
    chain.vocabulary = np.sort(np.array(sorted(vocabulary), np.int64).view(np.uint64))

    def vectorised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks(texts):
                r, c = chain.vectors(texts[a:b])
                ones = np.split(c, np.searchsorted(r, np.arange(1, b - a)))
                yield pdf.iloc[a:b][["doc_id", *names]].assign(ones=[o.tolist() for o in ones])

    data = sample.mapInPandas(tidy(vectorised), "doc_id long, " + ", ".join(f"{n} int" for n in names) + ", ones array<int>").toPandas().sort_values("doc_id", kind="stable")
    n = len(data)
    per_row = data["ones"].map(len).to_numpy(np.int64)
    rows = np.repeat(np.arange(n), per_row)
    cols = np.concatenate([np.asarray(o, np.int64) for o in data["ones"]]) if n else np.zeros(0, np.int64)
    fold = (mix64(data["doc_id"].to_numpy(np.int64).view(np.uint64)) % np.uint64(folds)).astype(np.int64)
    size = len(chain.vocabulary)
    earlier = np.zeros((n, 0))
    for name in names:
        y = data[name].to_numpy(np.float64)
        held = np.zeros(n)
        for f in range(folds):
            out, to = np.flatnonzero(fold == f), np.full(n, -1)
            rest = np.flatnonzero(fold != f)
            to[rest] = np.arange(len(rest))
            m = to[rows] >= 0
            w = fit_linear(to[rows[m]], cols[m], size, earlier[rest], y[rest])
            held[out] = _sigmoid(_margin(w, rows, cols, n, earlier))[out]
        chain.weights.append(fit_linear(rows, cols, size, earlier, y))
        chain.thresholds.append(_best_threshold(held, y))
        earlier = np.column_stack((earlier, held))
    chain.fitted = True
    return chain


def probability(chain: Chain, text: Column | str = "text") -> Column:
    """The categories' probabilities of a text, in order, as an array; null texts count as empty."""

    @F.pandas_udf("array<double>")
    def scored(texts: pd.Series) -> pd.Series:
        texts = texts.fillna("").tolist()
        return pd.Series([p.tolist() for a, b in chunks(texts) for p in chain.probabilities(texts[a:b])])

    return scored(text)


def toxicity(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, the probability of each category as p_<category>, and the decision on the last category as ``rejected``.

    One row for each input row, repeated ids included; null ids stay null; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    scored = docs.select("doc_id", probability(chain, F.col("text").cast("string")).alias("p"))
    last = len(chain.categories) - 1
    limit = chain.thresholds[last] if chain.fitted else 2.0
    return scored.select("doc_id", *(F.round(F.col("p")[k], 6).alias(f"p_{c}") for k, c in enumerate(chain.categories)), (F.col("p")[last] >= limit).alias("rejected"))


def drop_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows that the chain's last category doesn't reject, with all their columns."""
    small_batches(docs.sparkSession)
    if not chain.fitted:
        return docs
    return docs.filter(probability(chain, F.col("text").cast("string"))[len(chain.categories) - 1] < chain.thresholds[-1])
