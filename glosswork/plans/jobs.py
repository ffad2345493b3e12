"""The batch jobs: ingest, enrich, model topics, verify."""

from __future__ import annotations

from collections.abc import Callable

from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from glosswork.fixed_values import ROUGE_GATE, SMALLEST_TOPIC
from glosswork.operators import density, reduction, vector_search
from glosswork.operators.embed import hash_embedding, term_counts, term_idf
from glosswork.operators.fulltext import build_index, index_exists, merge_index, read_index, write_index
from glosswork.operators.ingest import (
    distinct_documents,
    ingest_accounting,
    new_documents,
    with_content_id,
)
from glosswork.operators.quality import gate_accounting, passes_gate, with_rouge
from glosswork.operators.stats import verify_report
from glosswork.operators.summarize import extractive_summary
from glosswork.operators.topics import (
    apply_merge,
    assign_topics,
    below_floor,
    centroids_of,
    fit_topics,
    merge_by_terms,
    merge_similar,
    project,
    small_topics,
    topic_labels,
    topic_terms,
)
from glosswork.operators.upsert import insert_if_absent
from glosswork.session import drop_staged, stage
from glosswork.sources.tables import append_table, known_ids, read_table, table_exists

Summarizer = Callable[[DataFrame], DataFrame]
Embedder = Callable[[DataFrame], DataFrame]


def ingest(corpus: DataFrame, known: DataFrame) -> DataFrame:
    """New documents of a corpus: one row per text that is not stored yet."""
    return new_documents(distinct_documents(with_content_id(corpus)), known)


def enrich(
    spark: SparkSession,
    root: str,
    corpus: DataFrame,
    summarize: Summarizer = extractive_summary,
    threshold: float = ROUGE_GATE,
    embed: Embedder | None = None,
) -> DataFrame:
    """Ingest, summarize, score, gate and store. Returns one row of counts.

    New rows are written once, with their summary and score, before they are
    filtered, so no model or scorer runs twice; the copy goes when the tables
    are written. Blocked ids are stored too: the next run skips them. Where a
    topic model is stored, new summaries are embedded in its space and get its
    topics.
    """
    known = known_ids(spark, root, threshold)
    rows = with_content_id(corpus)
    seen = ingest_accounting(rows, known).first()
    status = "nothing new" if seen["new"] == 0 else "done"
    total = kept = blocked = 0
    if seen["new"]:
        scored = stage(with_rouge(summarize(ingest(corpus, known))), "scored")
        passed = passes_gate(F.col("rouge_score"), threshold)
        append_table(scored.filter(passed), root, "summaries")
        append_table(scored.filter(~passed).withColumn("threshold", F.lit(threshold)), root, "rejected")
        total, kept, blocked = gate_accounting(scored, threshold).first()
        drop_staged(scored)
        if latest_version(spark, root) is not None:
            store_new_topics(spark, root, embed)
    row = (status, seen["loaded"], seen["skipped"], seen["new"], total, kept, blocked)
    columns = "status string, loaded long, skipped long, new long, total long, kept long, blocked long"
    return spark.createDataFrame([row], columns)


def index_new(spark: SparkSession, root: str, stemmed: bool = True) -> DataFrame:
    """Add the summaries that the stored full-text index lacks, and merge small
    batches of it. Returns the number of summaries."""
    path = f"{root}/index"
    fresh = read_table(spark, root, "summaries").select("abstract_id", "summary", "rouge_score")
    if index_exists(spark, path):
        fresh = new_documents(fresh, read_index(spark, path).documents)
    fresh = stage(fresh, "fresh")
    added = fresh.count()
    if added:
        write_index(build_index(fresh, stemmed), path)
        merge_index(spark, path)
    drop_staged(fresh)
    return spark.createDataFrame([(added,)], "indexed long")


def search_index(spark: SparkSession, root: str):
    """The stored full-text index."""
    return read_index(spark, f"{root}/index")


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The newest topic model; reads one row per centroid and version."""
    return read_table(spark, root, "topic_rules").agg(F.max("model_version")).first()[0]


def latest_topics(spark: SparkSession, root: str) -> DataFrame:
    newest = latest_version(spark, root)
    topics = read_table(spark, root, "topics")
    return topics.filter(F.col("model_version") == F.lit(newest)).drop("model_version")


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    """Stored summaries with their latest topic columns."""
    return read_table(spark, root, "summaries").join(
        latest_topics(spark, root), "abstract_id", "left"
    )


def store_idf(spark: SparkSession, root: str) -> DataFrame:
    """The term weights of the store, from the summaries of the first call on.

    They fix the space of the hashed embedding: vectors of all runs compare.
    """
    if not table_exists(spark, f"{root}/idf") or read_table(spark, root, "idf").isEmpty():
        summaries = read_table(spark, root, "summaries")
        append_table(term_idf(term_counts(summaries), summaries), root, "idf")
    return read_table(spark, root, "idf")


def embed_new(spark: SparkSession, root: str, embed: Embedder | None = None) -> None:
    """Embed the summaries that have no stored vector, and store theirs."""
    embed = embed or partial(hash_embedding, idf=store_idf(spark, root))
    summaries = read_table(spark, root, "summaries").select("abstract_id", "summary")
    fresh = new_documents(summaries, read_table(spark, root, "vectors"))
    vectors = stage(embed(fresh), "vectors")
    append_table(insert_if_absent(vectors, read_table(spark, root, "vectors")), root, "vectors")
    drop_staged(vectors)


def model_topics(
    spark: SparkSession,
    root: str,
    k: int | None = None,
    embed: Embedder | None = None,
    reduce_to: int | None = None,
    min_size: int = SMALLEST_TOPIC,
    min_score: float | None = None,
    merge_at: float | None = None,
    neighbours: int = density.NEIGHBOURS,
    min_samples: int = density.MIN_SAMPLES,
    merge_terms: bool = False,
) -> DataFrame:
    """Embed new summaries, fit topics over all vectors, label and store them.

    Without ``k``, density decides how many topics there are and what is noise,
    and the topic score is the strength of membership; ``k`` asks for k-means.
    ``reduce_to`` coordinates take the place of the vectors before: those of the
    neighbour graph for density, principal components for k-means.
    With ``merge_terms``, topics whose words form a cluster become one.
    Stored per version: the model, the topic of every centroid after merging
    and the noise rule, the terms and the labels. Returns the labels. Centroids
    and topic numbers are all that reaches the driver.
    """
    embed_new(spark, root, embed)
    vectors = read_table(spark, root, "vectors")
    version = (latest_version(spark, root) or 0) + 1
    if k is None:
        if merge_at is not None:
            raise ValueError("merge_at belongs to k-means")
        near = density.neighbour_table(vectors, neighbours)
        if reduce_to:
            layout = reduction.graph_layout(stage(near, "near"), reduce_to)
            layout.write.mode("overwrite").parquet(f"{_model_path(root, version)}/layout")
            near = reduction.layout_neighbours(spark.read.parquet(f"{_model_path(root, version)}/layout"), neighbours)
        fitted = density.density_clusters(near, min_size, min_samples)
        fitted.points.write.mode("overwrite").parquet(f"{_model_path(root, version)}/points")
        fitted.branches.write.mode("overwrite").parquet(f"{_model_path(root, version)}/branches")
        settings = spark.createDataFrame([(neighbours, min_samples)], "neighbours int, min_samples int")
        settings.write.mode("overwrite").parquet(f"{_model_path(root, version)}/settings")
        assigned = _with_noise(vectors, density.density_topics(fitted.points))
        assigned = stage(below_floor(assigned, min_score), "assigned")
        return _store_topics(spark, root, version, assigned, {-1: -1}, min_score, merge_terms)
    model = fit_topics(vectors, k, reduce_to)
    model.write().overwrite().save(_model_path(root, version))
    centroids = centroids_of(model)
    rule = merge_similar(centroids, merge_at) if merge_at is not None else {i: i for i in range(len(centroids))}
    merged = apply_merge(assign_topics(project(model, vectors), centroids), rule)
    assigned = stage(below_floor(merged, min_score), "assigned")
    small = set(small_topics(assigned, min_size))
    rule = {c: -1 if t in small else t for c, t in rule.items()}
    assigned = apply_merge(assigned, {t: -1 for t in small})
    return _store_topics(spark, root, version, assigned, rule, min_score, merge_terms)


def _model_path(root: str, version: int) -> str:
    return f"{root}/models/version={version}"


def _with_noise(vectors: DataFrame, assigned: DataFrame) -> DataFrame:
    """A topic for every vector; those that nothing is near are noise."""
    out = vectors.select("abstract_id").join(assigned, "abstract_id", "left")
    return out.select(
        "abstract_id",
        F.coalesce("topic_id", F.lit(-1)).alias("topic_id"),
        F.coalesce("topic_score", F.lit(0.0)).alias("topic_score"),
    )


def _store_topics(
    spark: SparkSession,
    root: str,
    version: int,
    assigned: DataFrame,
    rule: dict[int, int],
    min_score: float | None,
    merge_terms: bool,
) -> DataFrame:
    """Terms, labels, topics and, last, the rule of a version."""
    summaries = read_table(spark, root, "summaries").select("abstract_id", "summary")
    if merge_terms:
        found = merge_by_terms(topic_terms(summaries.join(assigned, "abstract_id")))
        merged = {r["topic_id"]: r["merged"] for r in found.collect()}  # one row per topic
        assigned = apply_merge(assigned, merged)
        rule = merged | {c: merged.get(t, t) for c, t in rule.items()}
    terms = stage(topic_terms(summaries.join(assigned, "abstract_id")), "terms")
    labels = topic_labels(assigned, terms).withColumn("model_version", F.lit(version))
    terms.write.mode("overwrite").parquet(f"{root}/topic_terms/version={version}")
    append_table(labels, root, "topic_labels")
    rows = [(c, t, min_score, version) for c, t in sorted(rule.items())]
    rules = spark.createDataFrame(rows, "centroid int, topic_id int, min_score double, model_version int")
    labels = _labels(spark, root, version)
    append_table(assigned.join(labels, "topic_id").withColumn("model_version", F.lit(version)), root, "topics")
    append_table(rules, root, "topic_rules")  # last: now the version counts
    drop_staged(terms)
    return labels


def _labels(spark: SparkSession, root: str, version: int) -> DataFrame:
    labels = read_table(spark, root, "topic_labels").filter(F.col("model_version") == version)
    return labels.drop("model_version")


def assign_new(
    spark: SparkSession, root: str, version: int, embed: Embedder | None = None
) -> DataFrame:
    """Topics of a saved model for summaries it has not seen.

    The stored rule of the version applies: merged centroids, noise, the score
    floor. ``embed`` must place texts in the space the model was fitted in; the
    default uses the stored term weights.
    """
    embed_new(spark, root, embed)
    known = read_table(spark, root, "topics").filter(F.col("model_version") == version)
    fresh = new_documents(read_table(spark, root, "vectors"), known)
    rules = read_table(spark, root, "topic_rules").filter(F.col("model_version") == version).collect()
    path = _model_path(root, version)
    if table_exists(spark, f"{path}/points"):
        assigned = _placed(spark, root, path, fresh)
    else:
        model = PipelineModel.load(path)
        assigned = assign_topics(project(model, fresh), centroids_of(model))
    assigned = apply_merge(assigned, {r["centroid"]: r["topic_id"] for r in rules})
    assigned = below_floor(assigned, rules[0]["min_score"] if rules else None)
    label = F.when(F.col("topic_id") == -1, F.lit("outlier")).otherwise(F.col("topic_label"))
    joined = assigned.join(_labels(spark, root, version), "topic_id", "left")
    return joined.withColumn("topic_label", label)


def _placed(spark: SparkSession, root: str, path: str, fresh: DataFrame) -> DataFrame:
    """Topics of a density model for vectors it has not seen, through their neighbours among those it has."""
    settings = spark.read.parquet(f"{path}/settings").first()
    points, branches = (spark.read.parquet(f"{path}/{name}") for name in ("points", "branches"))
    model = density.DensityModel(points, branches, settings["min_samples"])
    seen = read_table(spark, root, "vectors").join(points.select("abstract_id"), "abstract_id", "left_semi")
    fresh = stage(fresh, "fresh")
    near = density.neighbour_table(seen, settings["neighbours"], of=fresh)
    if table_exists(spark, f"{path}/layout"):
        layout = spark.read.parquet(f"{path}/layout")
        at = stage(reduction.place_in_layout(near, layout), "at")
        near = reduction.layout_neighbours(layout, settings["neighbours"], of=at)
    near = stage(near, "near")
    return _with_noise(fresh, density.density_topics(density.place(model, near)))


def store_new_topics(spark: SparkSession, root: str, embed: Embedder | None = None) -> None:
    """Topics of the latest model for the summaries stored since it was fitted."""
    version = latest_version(spark, root)
    found = stage(assign_new(spark, root, version, embed).withColumn("model_version", F.lit(version)), "assigned")
    append_table(found, root, "topics")
    drop_staged(found)


def store_cells(spark: SparkSession, root: str, n_cells: int = 100) -> None:
    """Fit cells over the stored vectors and store the vectors by cell.

    The centroids, one row per cell, go beside them.
    """
    vectors = read_table(spark, root, "vectors").select(
        "abstract_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding")
    )
    fitted = vectors.filter(F.exists("embedding", lambda x: x != 0))
    centroids = vector_search.fit_cells(fitted, n_cells)
    vector_search.write_cells(vector_search.with_cell(vectors, centroids), f"{root}/cells", "overwrite")
    rows = [(i, c) for i, c in enumerate(centroids)]
    spark.createDataFrame(rows, "cell int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(
        f"{root}/centroids"
    )


def search_cells(spark: SparkSession, root: str, queries: DataFrame, n_probe: int, k: int) -> DataFrame:
    """Approximate search in the stored cells."""
    rows = spark.read.parquet(f"{root}/centroids").collect()
    stored = spark.read.parquet(f"{root}/cells")
    return vector_search.vector_search_cells(
        stored, queries, [r["centroid"] for r in rows], n_probe, k, [r["cell"] for r in rows]
    )


def verify(spark: SparkSession, root: str) -> DataFrame:
    return verify_report(read_summaries(spark, root), read_table(spark, root, "vectors"))
