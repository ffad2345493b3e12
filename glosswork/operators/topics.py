"""Topics: k-means groups with noise, class-based TF-IDF words, labels."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from glosswork.fixed_values import LABEL_WORDS, SEED, SMALLEST_TOPIC, TERM_MIN_DOCS
from glosswork.functions.text import content_tokens, counted, topic_label, uni_and_bigrams
from glosswork.operators import density
from glosswork.operators.vector_search import nearest
from glosswork.session import stage


def reduce_dimensions(vectors: DataFrame, k: int = 5) -> DataFrame:
    """Principal components of the embeddings, ``k`` per document."""
    points = vectors.select("abstract_id", array_to_vector("embedding").alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="reduced").fit(points)
    return model.transform(points).select(
        "abstract_id", vector_to_array("reduced").alias("embedding")
    )


def predict(model: PipelineModel, vectors: DataFrame) -> DataFrame:
    """The model's own placement: ``abstract_id, topic_id``."""
    points = vectors.filter(has_direction(F.col("embedding")))
    points = points.select("abstract_id", array_to_vector("embedding").alias("features"))
    return model.transform(points).select("abstract_id", "topic_id")


def has_direction(vector: Column) -> Column:
    """False for the zero vector of a text without words."""
    return F.exists(vector, lambda x: x != 0)


def fit_topics(vectors: DataFrame, k: int, reduce_to: int | None = None, seed: int = SEED) -> PipelineModel:
    """K-means by cosine, as rows are assigned, after PCA if ``reduce_to`` is given."""
    vectors = vectors.filter(has_direction(F.col("embedding")))
    points = vectors.select("abstract_id", array_to_vector("embedding").alias("features"))
    stages = []
    column = "features"
    if reduce_to:
        stages.append(PCA(k=reduce_to, inputCol=column, outputCol="reduced"))
        column = "reduced"
    stages.append(KMeans(k=k, seed=seed, featuresCol=column, predictionCol="topic_id", distanceMeasure="cosine"))
    return Pipeline(stages=stages).fit(points)


def centroids_of(model: PipelineModel) -> list[list[float]]:
    return [list(map(float, c)) for c in model.stages[-1].clusterCenters()]


def project(model: PipelineModel, vectors: DataFrame) -> DataFrame:
    """The vectors in the space the model clusters in."""
    points = vectors.withColumn("features", array_to_vector("embedding"))
    for step in model.stages[:-1]:
        points = step.transform(points)
    column = model.stages[-1].getFeaturesCol()
    return points.select("abstract_id", vector_to_array(column).alias("embedding"))


def assign_topics(
    vectors: DataFrame, centroids: list[list[float]], ids: list[int] | None = None
) -> DataFrame:
    """Nearest centroid by cosine: ``abstract_id, topic_id, topic_score``.

    A zero vector is near nothing: topic -1 with score 0.
    """
    best = F.get(nearest(F.col("embedding"), centroids, 1, ids), F.lit(0))
    known = has_direction(F.col("embedding"))
    return vectors.select("abstract_id", known.alias("known"), best.alias("best")).select(
        "abstract_id",
        F.when(F.col("known"), F.col("best.id")).otherwise(-1).alias("topic_id"),
        F.when(F.col("known"), F.round("best.similarity", 4)).otherwise(0.0).alias("topic_score"),
    )


def small_topics(assigned: DataFrame, min_size: int = SMALLEST_TOPIC) -> list[int]:
    """Topics with fewer rows; at most one number per topic reaches the driver."""
    counts = assigned.groupBy("topic_id").agg(F.count("*").alias("n"))
    return [r["topic_id"] for r in counts.filter(F.col("n") < min_size).collect()]


def below_floor(assigned: DataFrame, min_score: float | None) -> DataFrame:
    """Rows under the score floor become -1."""
    if min_score is None:
        return assigned
    far = F.col("topic_score") < min_score
    return assigned.withColumn("topic_id", F.when(far, -1).otherwise(F.col("topic_id")))


def mark_noise(
    assigned: DataFrame, min_size: int = SMALLEST_TOPIC, min_score: float | None = None
) -> DataFrame:
    """Rows under the score floor, and topics left too small, become -1.

    The rows are written once, then counted and marked; no assignment runs twice.
    """
    rows = stage(below_floor(assigned, min_score), "assigned")
    return apply_merge(rows, {topic: -1 for topic in small_topics(rows, min_size)})


def merge_similar(
    centroids: list[list[float]], threshold: float, ids: list[int] | None = None
) -> dict[int, int]:
    """Topic -> topic after merging all chains of centroids with a cosine of at
    least ``threshold``; a merged topic takes the lowest id. One row per topic."""
    names = list(ids if ids is not None else range(len(centroids)))
    matrix = np.array(centroids, dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
    close = np.round(unit @ unit.T, 6) >= threshold
    np.fill_diagonal(close, True)
    group = np.array(names)
    while True:
        lowest = np.array([group[row].min() for row in close])
        if (lowest == group).all():
            return {n: int(g) for n, g in zip(names, group)}
        group = lowest


def apply_merge(assigned: DataFrame, mapping: dict[int, int]) -> DataFrame:
    """Topics renamed by the map; one entry per renamed topic."""
    moved = {a: b for a, b in mapping.items() if a != b}
    if not moved:
        return assigned
    table = F.create_map(*[F.lit(x) for pair in sorted(moved.items()) for x in pair])
    topic = F.coalesce(F.element_at(table, F.col("topic_id")), F.col("topic_id"))
    return assigned.withColumn("topic_id", topic.cast("int"))


def term_counts(docs: DataFrame) -> DataFrame:
    """Words and word pairs per topic: ``topic_id, term, tf, n_docs``.

    Stop words go first, then pairs are formed. Terms are counted inside each
    document, then per task before the shuffle, so a topic with a third of all
    documents is no hot key. Texts that share an id and topic count as one.
    """
    texts = docs.groupBy("abstract_id", "topic_id").agg(F.collect_list("summary").alias("texts"))
    terms = F.flatten(F.transform("texts", lambda t: uni_and_bigrams(content_tokens(t))))
    per_doc = texts.select("topic_id", terms.alias("terms")).select("topic_id", F.inline(counted(F.col("terms"))))
    return per_doc.groupBy("topic_id", "term").agg(F.sum("n").alias("tf"), F.count("*").alias("n_docs"))


def document_frequency(docs: DataFrame, min_docs: int = TERM_MIN_DOCS) -> DataFrame:
    """Terms found in at least ``min_docs`` documents."""
    return (
        term_counts(docs)
        .groupBy("term")
        .agg(F.sum("n_docs").alias("df"))
        .filter(F.col("df") >= min_docs)
    )


def topic_terms(docs: DataFrame, min_docs: int = TERM_MIN_DOCS) -> DataFrame:
    """Class-based TF-IDF (Grootendorst 2022): ``topic_id, term, weight``.

    weight = share of the term in its topic * ln(1 + mean topic size / total).
    A term's window holds one row per topic at most; the counts are written
    once and read for sizes and weights.
    """
    of_term = Window.partitionBy("term")
    counts = (
        stage(term_counts(docs), "term-counts")
        .withColumn("df", F.sum("n_docs").over(of_term))
        .withColumn("total", F.sum("tf").over(of_term))
        .filter(F.col("df") >= min_docs)
    )
    sizes = counts.groupBy("topic_id").agg(F.sum("tf").alias("size"))
    mean_size = sizes.agg(F.avg("size").alias("m")).scalar()
    weight = (
        F.col("tf").cast("double") / F.col("size") * F.ln(1 + mean_size / F.col("total"))
    )
    return counts.join(sizes, "topic_id").select("topic_id", "term", weight.alias("weight"))


def top_words(terms: DataFrame, n: int = LABEL_WORDS) -> DataFrame:
    """First ``n`` terms per topic: ``topic_id, words``.

    Two terms whose weights agree to nine digits are ordered by the term.
    """
    order = Window.partitionBy("topic_id").orderBy(F.desc(F.round("weight", 9)), F.asc("term"))
    ranked = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    ordered = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy("topic_id").agg(F.transform(ordered, lambda t: t["term"]).alias("words"))


def topic_labels(assigned: DataFrame, terms: DataFrame, n: int = LABEL_WORDS) -> DataFrame:
    """``topic_id, topic_label`` for every topic that has documents."""
    ids = assigned.select("topic_id").distinct()
    named = ids.join(top_words(terms, n), "topic_id", "left")
    return named.select("topic_id", topic_label(F.col("topic_id"), F.col("words")).alias("topic_label"))


def term_similarity(terms: DataFrame) -> DataFrame:
    """``a, b, cosine`` of the term weights of two topics that share a term, a < b.

    Products are added up by term, merged per task. A term of all topics gives
    a sum for every two of them: their number is that of topics, not of rows.
    """
    of_topic = terms.groupBy("topic_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    left = terms.select("term", F.col("topic_id").alias("a"), F.col("weight").alias("x"))
    right = terms.select("term", F.col("topic_id").alias("b"), F.col("weight").alias("y"))
    dots = left.join(right, "term").filter("a < b").groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    for end in ("a", "b"):
        dots = dots.join(of_topic.select(F.col("topic_id").alias(end), F.col("norm").alias(f"norm_{end}")), end)
    cosine = F.least(F.lit(1.0), F.round(F.try_divide(F.col("dot"), F.col("norm_a") * F.col("norm_b")), 6))
    return dots.select("a", "b", cosine.alias("cosine")).filter("cosine IS NOT NULL")


def merge_by_terms(terms: DataFrame, threshold: float | None = None) -> DataFrame:
    """``topic_id, merged``: topics with similar words, under the lowest number among them.

    With a ``threshold``, chains of topics with that cosine merge. Without one
    the data choose the cut: topics that form a density cluster of two or more
    by their words merge, all others stay. Noise is never merged.
    """
    terms = terms.filter("topic_id >= 0")
    pairs = stage(term_similarity(terms), "topic-pairs")
    ids = terms.select("topic_id").distinct()
    if threshold is not None:
        edges = pairs.select((1 - F.col("cosine")).alias("w"), "a", "b")
        grouped = density.single_linkage(edges.filter(F.col("w") <= 1 - threshold + 1e-9), 2.0)
        grouped = grouped.select(F.col("abstract_id").alias("topic_id"), F.col("component").alias("merged"))
    else:
        near = pairs.select(F.col("a").alias("abstract_id"), F.col("b").alias("neighbour"), density.distance("cosine"))
        near = near.unionByName(near.select(F.col("neighbour").alias("abstract_id"), F.col("abstract_id").alias("neighbour"), "distance"))
        found = density.density_clusters(near, min_size=2, min_samples=1).points.filter("topic_id >= 0")
        least = F.min("abstract_id").over(Window.partitionBy("topic_id"))
        grouped = found.select(F.col("abstract_id").alias("topic"), least.alias("merged")).withColumnRenamed("topic", "topic_id")
    return ids.join(grouped, "topic_id", "left").select("topic_id", F.coalesce("merged", "topic_id").alias("merged"))
