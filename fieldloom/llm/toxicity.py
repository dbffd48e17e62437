"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other. Each model is a logistic regression over the presence of word features; the
later ones also get the earlier categories' probabilities. Word weights are held at zero or above, so a model adds up what speaks for its
category and no amount of harmless text around an insult takes that away; what the words do not say, the constant and the earlier
probabilities do, whose weights are free. For training, those come from models of other folds (out of fold),
so that a later model sees them as uncertain as they will be on new documents. The threshold is set on such predictions too.

The fit takes at most `most` labelled rows, those whose ids hash lowest, and each model the FEATURES words that speak most; these are the only bounds, and every
document is scored by its whole text. Defined cases: null text is empty; texts of any length are read whole, a slice of rows at a time; labels of a null id or a null value are left out; of repeated labels the
largest value counts; repeated documents get the same scores; of the features that speak equally much the smaller hash comes first; of a labelled id on several rows the smallest text counts; an empty table of documents gives an empty one; without labelled rows every probability is 0; a category with one
value only gets that value's share. Other columns, whatever their names, are carried along or left out by `keep`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import coded_words, give_back, hold_only, slices, with_columns


@dataclass(frozen=True)
class Category:
    name: str
    label: str
    positive: int = 1


CHAIN = (Category("low_quality", "quality", 0), Category("toxic", "toxic", 1))
MOST_LABELLED, FOLDS, FEATURES, LEAST, STEPS, DECAY = 8000, 5, 4096, 3, 400, 0.05
STRIP = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum()) + "¡¿«»„“”‘’…"


def features(word: str) -> list[int]:
    """Hashes of a word's features: itself, its beginnings, its end, and how it is written."""
    low = word.lower().strip(STRIP)
    out = [crc32(low.encode("utf-8", "surrogatepass"))] if low else []
    for n in (4, 5, 6):
        if len(low) > n:
            out.append(crc32(f"^{low[:n]}".encode("utf-8", "surrogatepass")))
    if len(low) > 4:
        out.append(crc32(f"{low[-4:]}$".encode("utf-8", "surrogatepass")))
    if word and not word[-1].isalnum():
        out.append(crc32(f"!{word[-2:]}".encode("utf-8", "surrogatepass")))
    if len(word) > 2 and word.isupper():
        out.append(crc32(b"UPPER"))
    return out


@dataclass
class Linear:
    """Weights by feature hash, of the earlier probabilities, and the constant."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    chained: np.ndarray = field(default_factory=lambda: np.zeros(0))
    constant: float = -np.inf

    def probability(self, rows: np.ndarray, hashes: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
        """rows, hashes: which document has which feature, each pair once."""
        if not np.isfinite(self.constant):
            return np.full(n, 0.0 if self.constant < 0 else 1.0)
        score = np.full(n, self.constant) + earlier[:, : len(self.chained)] @ self.chained
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            score += np.bincount(rows[known], weights=self.weights[at[known]], minlength=n)
        return 1 / (1 + np.exp(-np.clip(score, -40, 40)))


def fit(rows: np.ndarray, columns: np.ndarray, distinct: np.ndarray, y: np.ndarray, earlier: np.ndarray, most: int = FEATURES) -> Linear:
    """Picks the features that speak most for the category and fits a logistic regression over them. Their weights are not
    negative, so that harmless words around it cannot outweigh an insult. columns: places in `distinct`."""
    n, positive = len(y), y.mean() if len(y) else 0.0
    if not n or positive in (0.0, 1.0):
        return Linear(constant=np.inf if positive else -np.inf)
    every, ones = np.bincount(columns, minlength=len(distinct)), np.bincount(columns, weights=y[rows], minlength=len(distinct))
    z = (ones - every * positive) / np.sqrt(every * positive * (1 - positive) * (1 - every / (n + 1)) + 1e-9)
    z[every < LEAST] = 0
    pick = np.lexsort((distinct, -z))[:most]
    pick = np.sort(pick[z[pick] > 3])
    place = np.full(len(distinct), -1)
    place[pick] = np.arange(len(pick))
    known = place[columns] >= 0
    r, c, k, more = rows[known], place[columns[known]], len(pick), earlier.shape[1]
    theta = np.zeros(k + more + 1)
    theta[-1] = np.log(positive / (1 - positive))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        score = np.bincount(r, weights=theta[c], minlength=n) + earlier @ theta[k : k + more] + theta[-1]
        error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - y) / n
        slope = np.concatenate([np.bincount(c, weights=error[r], minlength=k), earlier.T @ error, [error.sum()]])
        slope[:-1] += DECAY / n * theta[:-1]
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        theta[:k] = np.maximum(theta[:k], 0)
    return Linear(distinct[pick], theta[:k], theta[k : k + more], float(theta[-1]))


def cutoff(p: np.ndarray, y: np.ndarray) -> float:
    """Where out-of-fold probabilities part the classes best (by F1; the middle of the gap), between 0.05 and 0.5."""
    order = np.argsort(p, kind="stable")
    p, y = p[order], y[order]
    if not y.sum():
        return 0.5
    right = y[::-1].cumsum()[::-1]
    f1 = 2 * right / (y.sum() + np.arange(len(y), 0, -1))
    i = len(f1) - 1 - int(np.argmax(f1[::-1]))
    return float(np.clip((p[i] + (p[i - 1] if i else 0)) / 2, 0.05, 0.5))


@dataclass
class Chain:
    models: list[Linear]
    threshold: float = 0.5


def fit_chain(rows: np.ndarray, hashes: np.ndarray, labels: list[np.ndarray], fold: np.ndarray) -> Chain:
    """One model for each category; labels hold nan where unknown. rows, hashes: which document has which feature."""
    n, models, earlier, threshold = len(fold), [], np.zeros((len(fold), 0)), 0.5
    distinct, count = np.unique(hashes, return_counts=True)
    distinct = distinct[count >= LEAST]
    columns = np.searchsorted(distinct, hashes).astype(np.int32)
    often = distinct[np.minimum(columns, max(0, len(distinct) - 1))] == hashes if len(distinct) else np.zeros(len(hashes), bool)
    rows, columns = rows[often].astype(np.int32), columns[often]
    del hashes, often, count
    for y in labels:
        known = ~np.isnan(y)
        outside = np.zeros(n)

        def among(chosen: np.ndarray) -> Linear:
            mine = chosen[rows]
            return fit((np.cumsum(chosen, dtype=np.int32) - 1)[rows[mine]], columns[mine], distinct, y[chosen], earlier[chosen])

        for f in range(FOLDS):
            there = fold == f
            if there.any():
                mine = there[rows]
                outside[there] = among(known & ~there).probability((np.cumsum(there) - 1)[rows[mine]], distinct[columns[mine]], int(there.sum()), earlier[there])
        models.append(among(known))
        threshold = cutoff(outside[known], y[known])
        earlier = np.column_stack([earlier, outside])
    return Chain(models, threshold)


def feature_lists(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """`keep` and the distinct feature hashes of each text."""

    def make():
        def each(part: pa.RecordBatch) -> dict[str, pa.Array]:
            words, codes, starts = coded_words(part.column(text))
            by_word = [features(w) for w in words]
            lists = [sorted({h for c in np.unique(codes[a:b]) for h in by_word[c]}) for a, b in zip(starts, starts[1:])]
            return {"features": pa.array(lists, pa.list_(pa.int64()))}

        return each

    return with_columns(docs, text, [("features", T.ArrayType(T.LongType()))], make, keep)


def train(docs: DataFrame, labels: DataFrame, chain: tuple[Category, ...] = CHAIN, doc_id: str = "doc_id", text: str = "text", most: int = MOST_LABELLED) -> Chain:
    values = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("labelled_id")).agg(*(F.max(F.when(F.col(c.label).isNotNull(), (F.col(c.label) == c.positive).cast("double"))).alias(f"y{i}") for i, c in enumerate(chain)))
    # bounded by `most` rows, so it can be broadcast
    sample = F.broadcast(values.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(most))
    texts = docs.select(F.col(doc_id).alias("labelled_id"), F.col(text).alias("t")).join(sample, "labelled_id")
    ys = [f"y{i}" for i in range(len(chain))]
    # of a labelled id that stands on several rows the smallest text counts
    texts = texts.groupBy("labelled_id", *ys).agg(F.min("t").alias("t")).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "labelled_id"), F.lit(FOLDS)))
    # one task of an executor fits them, which the limit brings together; the driver only gets the weights
    fits = feature_lists(texts, "t", ["labelled_id", "fold", *ys]).limit(most).mapInArrow(_fit_task(ys), "model int, hashes array<long>, weights array<double>, chained array<double>, constant double, threshold double")
    got = sorted(fits.collect(), key=lambda r: r.model)
    if not got:
        return Chain([Linear() for _ in chain])
    return Chain([Linear(np.array(r.hashes, np.int64), np.array(r.weights, float), np.array(r.chained, float), r.constant) for r in got], got[0].threshold)


def _fit_task(ys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only()
        parts = [(b.select(["labelled_id", "fold", *ys]), b.column("features").flatten().to_numpy().astype(np.uint32), np.diff(b.column("features").offsets.to_numpy())) for b in batches if b.num_rows]
        if not parts:
            return
        about = pa.Table.from_batches([p[0] for p in parts]).combine_chunks()
        order = pc.sort_indices(about.column("labelled_id")).to_numpy()
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        rows, hashes = np.repeat(place, np.concatenate([p[2] for p in parts])), np.concatenate([p[1] for p in parts])
        parts.clear()
        about = about.take(order)
        give_back()
        chain = fit_chain(rows, hashes, [about.column(y).to_numpy(zero_copy_only=False).astype(float) for y in ys], about.column("fold").to_numpy())
        columns = [[i for i, _ in enumerate(chain.models)], [m.hashes.astype(np.int64) for m in chain.models], [m.weights for m in chain.models], [m.chained for m in chain.models], [float(m.constant) for m in chain.models], [chain.threshold] * len(chain.models)]
        types = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64()]
        del rows, hashes
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["model", "hashes", "weights", "chained", "constant", "threshold"])

    return run


def scorer(chain: Chain, text: str):
    """Returns the function that gives each category's probabilities for a slice of rows."""
    wanted = set(np.concatenate([m.hashes for m in chain.models]).tolist())

    def each(part: pa.RecordBatch) -> np.ndarray:
        words, codes, starts = coded_words(part.column(text))
        n = part.num_rows
        own = [[h for h in features(w) if h in wanted] for w in words]
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter((h for hs in own for h in hs), np.int64, int(sizes.sum()))
        at = np.flatnonzero(sizes[codes]) if len(codes) else np.zeros(0, np.int64)
        docs = np.searchsorted(starts, at, "right") - 1
        pairs = np.unique(docs * max(1, len(words)) + codes[at]) if len(at) else np.zeros(0, np.int64)
        docs, code = pairs // max(1, len(words)), pairs % max(1, len(words))
        first = np.cumsum(sizes) - sizes
        take = np.repeat(first[code] - (np.cumsum(sizes[code]) - sizes[code]), sizes[code]) + np.arange(int(sizes[code].sum()))
        both = np.unique(np.repeat(docs, sizes[code]) << 32 | flat[take])  # each feature once in a document
        rows, hashes = both >> 32, both & 0xFFFFFFFF
        earlier = np.zeros((n, 0))
        for model in chain.models:
            earlier = np.column_stack([earlier, model.probability(rows, hashes, n, earlier)])
        return earlier

    return each


def score(docs: DataFrame, fitted: Chain, chain: tuple[Category, ...] = CHAIN, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds p_<category> for each category of the chain, and `rejected`: whether the last category's reaches the fitted threshold."""

    def make():
        each = scorer(fitted, text)

        def out(part: pa.RecordBatch) -> dict[str, pa.Array]:
            p = each(part)
            return {f"p_{c.name}": pa.array(p[:, i]) for i, c in enumerate(chain)} | {"rejected": pa.array(p[:, -1] >= fitted.threshold)}

        return out

    return with_columns(docs, text, [*((f"p_{c.name}", T.DoubleType()) for c in chain), ("rejected", T.BooleanType())], make, keep)


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that the chain does not reject, with their own columns only."""
    fitted = train(docs, labels, text=text)

    def run(batches):
        hold_only()
        each = scorer(fitted, text)
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(each(part)[:, -1] < fitted.threshold))
        give_back()

    return docs.mapInArrow(run, docs.schema)
