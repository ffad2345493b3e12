"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models over words and
word beginnings, each with its count and its share of the text; each model also
sees the probabilities of the categories before it. In training these come out
of fold: a row's earlier probabilities are predicted by models that did not see
the row. The last category decides.

A label table may bring a column per category. Where it has only the final
label, a row counts for an earlier category if it is labelled toxic and holds a
word of that category's list.

Fitting reads at most ``MAX_ROWS`` labelled documents, chosen by a hash of
their id; words are chosen by chi-squared over them. Scoring is row by row over
whole texts: no shuffle, and only the fitted weights (a few hundred numbers)
travel.

Defined results: null or empty texts and texts without words say nothing, and
their probabilities are 0; null ids are scored; labels with a null id or label are not used, an id
labelled twice counts as toxic if any label says so; without labelled rows, or
with one class only, every probability is the share of that class; ties in the
choice of words go to the smaller digest; repeated rows are each returned; an
empty table gives an empty result. ``score`` ignores other columns,
``drop_toxic`` carries them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from glosswork.llm import words as w
from glosswork.session import stage

MAX_ROWS = 8000
WORDS = 96
BEGINNING = 6  # bytes
MIN_DOCS = 5
FOLDS = 5
PENALTY = 1.0
THRESHOLD = 0.5
# Short public word lists that name the earlier categories.
CATEGORIES: dict[str, tuple[str, ...]] = {
    "insult": ("idiot", "moron", "stupid", "loser", "clown", "fool", "dumb", "imbecile", "jerk"),
    "contempt": ("trash", "scum", "worthless", "pathetic", "garbage", "useless", "filth"),
    "disgust": ("disgusting", "gross", "vile", "sick", "revolting", "repulsive"),
}
FINAL = "toxic"


@dataclass
class Chain:
    """Word digests (sorted) and one weight vector per category, in order."""

    names: list[str]
    digests: np.ndarray
    weights: list[np.ndarray]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, one column per category."""
        for weight in self.weights:
            x = np.column_stack([x, _sigmoid(x @ weight[:-1] + weight[-1])])
        return x[:, 2 * len(self.digests) :]

    def score(self, texts: pa.Array) -> np.ndarray:
        parts = [self.predict(x) * (n > 0)[:, None] for x, n in _features(texts, self.digests)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.names)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


_BEGINS = np.uint64(0x5851F42D4C957F2D)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of words and word beginnings, their text numbers, words per text."""
    starts, ends, doc = w.find(data, offsets, w.PUNCTUATION)
    long = ends - starts >= BEGINNING
    begins = w.digests(data, starts[long], starts[long] + BEGINNING) ^ _BEGINS
    found = np.concatenate([w.digests(data, starts, ends), begins])
    return found, np.concatenate([doc, doc[long]]), np.bincount(doc, minlength=len(offsets) - 1)


def features(texts: pa.Array, digests: np.ndarray) -> Iterator[np.ndarray]:
    """For runs of texts, count and share (logarithms) of the pieces with these sorted digests."""
    return (x for x, _ in _features(texts, digests))


def _features(texts: pa.Array, digests: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The features, and the number of words of each text."""
    for _, data, offsets in w.chunks(texts):
        found, doc, n_words = pieces(data, offsets)
        shape = (len(offsets) - 1, len(digests))
        count = np.zeros(shape)
        if len(digests):
            at = np.minimum(np.searchsorted(digests, found), len(digests) - 1)
            hit = digests[at] == found
            cell = doc[hit] * len(digests) + at[hit]
            count = np.bincount(cell, minlength=shape[0] * shape[1]).reshape(shape).astype(float)
        yield np.hstack([np.log1p(count), np.log1p(100 * count / np.maximum(n_words, 1)[:, None])]), n_words


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 12) -> np.ndarray:
    """Weights and intercept by Newton steps; the intercept is not penalised."""
    share = float(y.mean()) if len(y) else 0.0
    weight = np.zeros(x.shape[1] + 1)
    weight[-1] = np.log((share + 1e-6) / (1 - share + 1e-6))
    if share in (0.0, 1.0):
        return weight
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-9
    for _ in range(steps):
        p = _sigmoid(x @ weight)
        slope = x.T @ (p - y) + ridge * weight
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(curve, slope)
        weight -= move
        if np.abs(move).max() < 1e-6:
            break
    return weight


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> list[np.ndarray]:
    """One weight vector per column of ``labels``; earlier probabilities out of fold."""
    weights = []
    for k in range(labels.shape[1]):
        weights.append(fit_logistic(x, labels[:, k]))
        unseen = np.zeros(len(x))
        for f in np.unique(fold):
            own = fold == f
            model = fit_logistic(x[~own], labels[~own, k])
            unseen[own] = _sigmoid(x[own] @ model[:-1] + model[-1])
        x = np.column_stack([x, unseen])
    return weights


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, wanted: list[str], max_rows: int) -> DataFrame:
    """``id, text`` and labels of at most ``max_rows`` labelled documents."""
    marks = [F.max(F.col(c).cast("int")).alias(c) for c in wanted]
    # Twice the share of ids that is needed, so that few rows meet in the cut.
    share = F.lit(min(1 << 40, 2 * max_rows * (1 << 40) // max(1, labels.count())))
    chosen = (
        labels.filter(F.col(id_col).isNotNull() & F.col(FINAL).isNotNull())
        .filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 40)) < share)
        .groupBy(F.col(id_col).alias("id"))
        .agg(*marks)
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), "id")  # at most max_rows narrow rows


def _pieces_of(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """``id``, labels, ``text`` and the distinct digests of its words and beginnings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for _, data, offsets in w.chunks(batch.column(1)):
                found, doc, _ = pieces(data, offsets)
                order = np.argsort(doc, kind="stable")
                found = found[order].view(np.int64)
                cut = np.searchsorted(doc[order], np.arange(len(offsets)))
                lists += [np.unique(found[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.list_(pa.int64()))], names=["id", "text", *wanted, "pieces"]
            )

    id_type = rows.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {id_type}, text string", *[f"{c} int" for c in wanted], "pieces array<bigint>"])
    return rows.mapInArrow(run, schema)


def _features_of(rows: DataFrame, digests: np.ndarray, wanted: list[str]) -> DataFrame:
    """``id``, labels and the features of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.vstack([*features(batch.column(1), digests), np.zeros((0, 2 * len(digests)))])
            columns = [batch.column(0), *batch.columns[2:], pa.array(list(x), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *wanted, "x"])

    id_type = rows.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {id_type}", *[f"{c} int" for c in wanted], "x array<double>"])
    return rows.select("id", "text", *wanted).mapInArrow(run, schema)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    categories: Mapping[str, tuple[str, ...]] | None = None,
    max_rows: int = MAX_ROWS,
) -> Chain:
    """Fit the chain on at most ``max_rows`` labelled documents."""
    categories = CATEGORIES if categories is None else categories
    given = [c for c in categories if c in labels.columns]
    wanted = [*given, FINAL]
    sample = stage(_pieces_of(_sample(docs, labels, id_col, text_col, wanted, max_rows), wanted), "labelled")
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(FINAL), F.lit(0)).alias("t")).first()
    n, t = max(1, size["n"]), size["t"]
    a, b = F.col("a"), F.col("b")
    counts = (
        sample.select(FINAL, F.explode("pieces").alias("piece"))
        .groupBy("piece")
        .agg(F.sum(FINAL).alias("a"), F.count(F.lit(1)).alias("b"))
        .filter(b >= MIN_DOCS)
    )
    gap = a - b * (t / n)
    best = counts.orderBy(F.desc(gap * gap / (b * (1 - b / (n + 1)))), "piece").limit(WORDS).select("piece").collect()
    listed = {name: np.array([w.digest_of(x) for x in categories[name]], np.uint64) for name in categories}
    picked = [np.array([r["piece"] for r in best], np.int64).view(np.uint64), *listed.values()]
    digests = np.unique(np.concatenate(picked))
    rows = _features_of(sample, digests, wanted).collect()  # at most max_rows
    rows.sort(key=lambda r: (str(r["id"]), r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), 2 * len(digests))
    marks = np.zeros((len(rows), len(categories) + 1))
    for k, name in enumerate(categories):
        has = (x[:, np.searchsorted(digests, listed[name])] > 0).any(axis=1)
        for i, r in enumerate(rows):
            marks[i, k] = (r[name] or 0) if name in given else r[FINAL] * has[i]
    marks[:, -1] = [r[FINAL] for r in rows]
    fold = np.arange(len(rows)) % FOLDS
    return Chain([*categories, FINAL], digests, fit_chain(x, marks, fold))


def score(
    docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Per document: id, a probability per category, ``rejected``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.score(batch.column(1))
            columns = [batch.column(0), *[pa.array(p[:, k]) for k in range(p.shape[1])]]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *chain.names])

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, " + ", ".join(f"`{name}` double" for name in chain.names)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, schema).withColumn("rejected", F.col(chain.names[-1]) >= threshold)
    return scored.withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(chain.score(batch.column(at))[:, -1] < threshold))

    return docs.mapInArrow(run, docs.schema)
