"""Toxicity scores from a counterfactual-regularised classifier.

Features are the words of a text and the beginnings of its words, present or
not. Counts per label over all labelled rows choose the vocabulary. The
classifier is a logistic regression; for each labelled text that names a group
of people, the terms are swapped for those of other groups, and the squared
change of the score under the swap is added to the loss. Weights that hang on
the mention of a group are thereby driven together and towards what the rest
of the text carries, so neutral mentions are not flagged.

The fit uses a bounded sample of labelled rows (``FIT_ROWS``); counts, the
vocabulary and the scores cover everything.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from ..operators.sizes import broadcast_if_small
from .common import fold, fresh, hash_share, prepare, stored

#: Labelled rows the classifier is fitted on, at most; taken by smallest hash of the id.
FIT_ROWS = 20_000
#: Entries of the fitted rows that one step of the fit computes on at a time.
FIT_ENTRIES = 1 << 17
#: Features kept, by how far their presence tells the labels apart.
FEATURES = 6_000
PREFIXES = (4, 5, 6)
FOLDS = 5
THRESHOLD = 0.5
#: Weight of the counterfactual penalty against the loss.
PENALTY = 1.0
RIDGE = 1e-4

# Terms for groups of people, in sets whose members may stand for each other.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "straight", "lesbian", "bisexual", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young", "elderly", "teenage"),
    ("disabled", "deaf", "blind", "autistic"),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros"),
)

_LETTERS = regex.compile(r"\p{L}+")


def features(text: str) -> set[str]:
    """Words of a text (runs of letters, lower case) and the beginnings of longer ones, marked by a star."""
    found = set(_LETTERS.findall(text.lower()))
    starts = {w[:k] + "*" for w in found for k in PREFIXES if len(w) > k}
    return found | starts


def swapped(text: str, groups: Sequence[Sequence[str]] = IDENTITY_TERMS) -> list[set[str]]:
    """Features of the text with each identity term moved one and two places on within its set; none without a term."""
    at = {term: (group, i) for group in groups for i, term in enumerate(group)}
    found = set(_LETTERS.findall(text.lower()))
    named = found & at.keys()
    if not named:
        return []
    out = []
    for step in (1, 2):
        moved = {at[w][0][(at[w][1] + step) % len(at[w][0])] for w in named}
        ws = (found - named) | moved
        out.append(ws | {w[:k] + "*" for w in ws for k in PREFIXES if len(w) > k})
    return out


@dataclass(frozen=True)
class Model:
    """Weights by feature, plus a bias."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str) -> float:
        total = self.bias + sum(map(self.weights.__getitem__, features(text) & self.weights.keys()))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``y`` of labelled rows outside the held-out fold."""
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).filter("y in (0, 1)")
    marks = marks.groupBy("doc_id").agg(F.max("y").alias("y")).filter(fold("doc_id", FOLDS) != 0)
    # A small set of labels goes to the texts; a larger one meets them in a shuffle.
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(broadcast_if_small(marks), "doc_id")


def vocabulary(rows: DataFrame, size: int = FEATURES) -> dict[str, float]:
    """The ``size`` features that tell the labels apart best, from counts over all ``rows``, with how well they do (at most 1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: dict[str, list[int]] = {}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for f in features(text):
                    tally.setdefault(f, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(tally), pa.string()),
                    pa.array([v[0] for v in tally.values()], pa.int64()),
                    pa.array([v[1] for v in tally.values()], pa.int64()),
                ],
                names=["feature", "n0", "n1"],
            )

    counted = rows.select("text", "y").mapInArrow(count, "feature string, n0 long, n1 long")
    counted = counted.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    total = rows.agg(F.sum(1 - F.col("y")).alias("t0"), F.sum("y").alias("t1")).first()
    t0, t1 = float(total["t0"] or 0) + 1, float(total["t1"] or 0) + 1
    p0, p1 = F.col("n0") / t0, F.col("n1") / t1
    # A two-proportion statistic: large where the shares differ by more than chance.
    spread = (p1 - p0) ** 2 / ((F.col("n0") + F.col("n1") + 1) / (t0 + t1))
    best = counted.withColumn("gain", spread).orderBy(F.desc("gain"), "feature").limit(size)
    gains = {r["feature"]: r["gain"] for r in best.select("feature", "gain").collect()}
    top = max(gains.values(), default=1.0)
    return {f: (g / top) ** 0.5 for f, g in gains.items() if g > 0}


def fit(rows: DataFrame, groups: Sequence[Sequence[str]] = IDENTITY_TERMS, penalty: float = PENALTY) -> Model:
    """Fit on at most ``FIT_ROWS`` of ``rows``; without rows of both labels every text scores by the share of label 1."""
    vocab = vocabulary(rows)
    at = {f: i for i, f in enumerate(vocab)}
    shared = rows.sparkSession.sparkContext.broadcast(at)

    @F.arrow_udf("array<array<int>>")
    def vectors(texts: pa.Array) -> pa.Array:
        known = shared.value
        out = []
        for text in texts.to_pylist():
            sets = [features(text), *swapped(text, groups)]
            out.append([sorted(known[f] for f in s & known.keys()) for s in sets])
        return pa.array(out, pa.list_(pa.list_(pa.int32())))

    # The share leaves a few more rows than wanted, so that only few are turned and sorted.
    sample = rows.filter(hash_share(1.1 * FIT_ROWS / max(rows.count(), 1), "doc_id", "text"))
    sample = sample.select(F.xxhash64("doc_id", "text").alias("h"), "y", vectors("text").alias("v"))
    got = sample.orderBy("h", "y").limit(FIT_ROWS).toArrow()
    y = got.column("y").to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model({}, float(np.log(share / (1 - share))))
    of_row = got.column("v").combine_chunks()
    columns, ends, starts = of_row.values.values.to_numpy(), of_row.values.offsets.to_numpy(), of_row.offsets.to_numpy()
    sets = [columns[a:b] for a, b in zip(ends, ends[1:])]
    plain = [sets[a] for a in starts[:-1]]
    pairs = [(i, sets[k]) for i, (a, b) in enumerate(zip(starts, starts[1:])) for k in range(a + 1, b)]
    scale = np.array(list(vocab.values()))
    weights, bias = _descend(plain, y, pairs, scale, penalty)
    return Model({f: float(w) for f, w in zip(vocab, weights) if w}, float(bias))


def _parts(sets: list[np.ndarray]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of sets with about ``FIT_ENTRIES`` entries: first set, number of sets, and of each entry the set within the run and the column."""
    sizes = np.array([len(s) for s in sets], np.int64)
    run = (np.cumsum(sizes) - sizes) // FIT_ENTRIES
    edges = [*np.flatnonzero(np.diff(run, prepend=-1)).tolist(), len(sets)]
    return [
        (a, b - a, np.repeat(np.arange(b - a, dtype=np.int32), sizes[a:b]), np.concatenate(sets[a:b], dtype=np.int32))
        for a, b in zip(edges, edges[1:])
    ]


def _descend(plain, y, pairs, scale, penalty, steps: int = 300, ridge: float = RIDGE, rate: float = 0.1):
    """Adam on log loss + penalty * mean squared score change under swaps + ridge; the rarer label weighs more.

    A feature counts as ``scale`` when present, so one that tells little has to
    pay more for the same weight; returns weights for presence.
    """
    n = len(scale)
    own = _parts(plain)
    which = np.array([i for i, _ in pairs], np.int64)
    other = _parts([s for _, s in pairs])
    share = y.mean()
    importance = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    importance /= importance.sum()
    w = np.zeros(n + 1)
    m, v = np.zeros(n + 1), np.zeros(n + 1)

    def scores(parts, count):
        total = np.zeros(count)
        for at, k, r, c in parts:
            total[at : at + k] = np.bincount(r, w[c] * scale[c], k)
        return 1 / (1 + np.exp(-np.clip(total + w[n], -30, 30)))

    def gradient(parts, g):
        total = np.zeros(n)
        for at, k, r, c in parts:
            np.add.at(total, c.astype(np.intp), g[at : at + k][r] * scale[c])
        return total

    for step in range(1, steps + 1):
        p = scores(own, len(y))
        g = importance * (p - y)
        if len(which):
            p2 = scores(other, len(which))
            change = 2 * penalty / len(y) * (p[which] - p2)
            g = g + np.bincount(which, change, len(y)) * p * (1 - p)
            g2 = -change * p2 * (1 - p2)
        grad = np.append(gradient(own, g), g.sum())
        if len(which):
            grad += np.append(gradient(other, g2), g2.sum())
        grad[:n] += ridge * w[:n]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:n] * scale, w[n]


def scored(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """``docs`` plus ``column``, the score of each whole text (null: empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t) for t in texts.to_pylist()], pa.float64())

    return docs.withColumn(column, score(F.coalesce("text", F.lit(""))))


def train(docs: DataFrame, labels: DataFrame, groups: Sequence[Sequence[str]] = IDENTITY_TERMS) -> Model:
    """Fit on the labelled rows of ``docs``. Rows with another label than 0 or 1 are ignored; of several labels 1 counts."""
    prepare(docs.sparkSession)
    return fit(stored(labelled(docs, labels), "labelled"), groups)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Null texts score as empty ones; a null id belongs to the held-out fold.
    Repeated rows score alike. Other columns are never read. An empty table
    gives an empty result.
    """
    model = train(docs, labels)
    slim = scored(docs.select("doc_id", "text"), model, "score")
    return slim.select(
        "doc_id",
        (fold("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic, columns unchanged; rules for odd rows as in ``toxicity_scores``."""
    model = train(docs, labels)
    name = fresh(docs.columns)
    return scored(docs, model, name).filter(F.col(name) < THRESHOLD).drop(name)
