"""Staged retrieval, re-ranking, search, context blocks and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from glosswork.fixed_values import (
    BLANK_QUERY_REPLY,
    CANDIDATES,
    ENOUGH_HITS,
    KEYWORD_RELEVANCE,
    PROMPT_HEAD,
    PROMPT_MIDDLE,
    PROMPT_TAIL,
    SAFETY_RELEVANCE,
    SEARCH_TOP_K,
    TOP_K,
    TOPIC_KEYWORDS,
)
from glosswork.functions.text import context_line, detect_topic, is_blank, query_terms
from glosswork.operators.fulltext import (
    TermIndex,
    analyzed_terms,
    build_index,
    by_quality,
    by_relevance,
    first_per_query,
    fulltext_candidates,
    keyword_candidates,
    match_all_terms,
    quality_top,
)
from glosswork.session import stage

TopicMap = Sequence[tuple[str, str]]


def route_topic(queries: DataFrame, topic_map: TopicMap = TOPIC_KEYWORDS) -> DataFrame:
    return queries.withColumn("topic_hint", detect_topic(F.col("query"), topic_map))


def _short_of_hits(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Queries with fewer than ENOUGH_HITS rows in ``hits``."""
    enough = hits.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= ENOUGH_HITS)
    return queries.join(enough, "query_id", "left_anti")


def retrieval_cascade(
    docs: DataFrame, queries: DataFrame, index: TermIndex | None = None
) -> DataFrame:
    """Hits per query: full text, then keywords, then best quality.

    A later stage runs only for queries still under four hits, and adds only
    documents not found before. The hits of a stage, a few rows per query, are
    staged for the next. Returns ``query_id, abstract_id, stage,
    relevance, rouge_score``.
    """
    columns = ["query_id", "abstract_id", "stage", "relevance", "rouge_score"]
    key = ["query_id", "abstract_id"]
    index = index or build_index(docs)
    found = fulltext_candidates(index, docs, queries, CANDIDATES)
    found = stage(found.withColumn("stage", F.lit(1)).select(columns), "found")

    short = _short_of_hits(queries, found)
    by_keyword = keyword_candidates(index, short)
    by_keyword = by_keyword.join(found.select(key), key, "left_anti")
    by_keyword = by_keyword.withColumns(
        {"stage": F.lit(2), "relevance": F.lit(KEYWORD_RELEVANCE)}
    ).select(columns)
    found = found.unionByName(stage(by_keyword, "keyword"))

    short = _short_of_hits(queries, found)
    best = quality_top(docs.select("abstract_id", "rouge_score"), TOP_K)
    rows = best.agg(F.collect_list(F.struct("abstract_id", "rouge_score"))).scalar()
    safety = (
        short.select("query_id", F.explode(rows).alias("doc"))
        .select("query_id", "doc.*")
        .join(found.select(key), key, "left_anti")
        .withColumns({"stage": F.lit(3), "relevance": F.lit(SAFETY_RELEVANCE)})
        .select(columns)
    )
    return found.unionByName(safety)


def rerank(hits: DataFrame, docs: DataFrame, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """Topic match first, then quality; relevance is not used again."""
    rows = hits.select("query_id", "abstract_id", "stage", "relevance").join(
        docs.select("abstract_id", "summary", "rouge_score", "topic_label"), "abstract_id"
    )
    rows = rows.join(queries.select("query_id", "topic_hint"), "query_id")
    boost = F.when(F.col("topic_label") == F.col("topic_hint"), 1).otherwise(0)
    return first_per_query(rows, k, boost.desc(), *by_quality())


def retrieve(
    docs: DataFrame,
    queries: DataFrame,
    index: TermIndex | None = None,
    topic_map: TopicMap = TOPIC_KEYWORDS,
) -> DataFrame:
    """Ranked rows per query: route, cascade, re-rank."""
    routed = route_topic(queries, topic_map)
    hits = retrieval_cascade(docs, queries, index)
    return rerank(hits, docs, routed)


def context_blocks(ranked: DataFrame) -> DataFrame:
    """One text per query: the ranked rows joined by a blank line."""
    line = context_line(F.col("topic_label"), F.col("rouge_score"), F.col("summary"))
    lines = F.sort_array(F.collect_list(F.struct("rank", line.alias("line"))))
    return ranked.groupBy("query_id").agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n\n").alias("context"),
        F.count("*").alias("sources"),
    )


def build_prompts(
    docs: DataFrame,
    queries: DataFrame,
    index: TermIndex | None = None,
    topic_map: TopicMap = TOPIC_KEYWORDS,
) -> DataFrame:
    """One row per query: prompt, hint and source count.

    A blank query gets the fixed reply in ``reply`` and no prompt.
    """
    asked = queries.filter(~is_blank(F.col("query")))
    contexts = context_blocks(retrieve(docs, asked, index, topic_map))
    blank = is_blank(F.col("query"))
    context = F.coalesce(F.col("context"), F.lit(""))
    prompt = F.concat(
        F.lit(PROMPT_HEAD), context, F.lit(PROMPT_MIDDLE), F.col("query"), F.lit(PROMPT_TAIL)
    )
    return (
        route_topic(queries, topic_map)
        .join(contexts, "query_id", "left")
        .select(
            "query_id",
            F.when(~blank, prompt).alias("prompt"),
            F.when(~blank, F.col("topic_hint")).alias("topic_hint"),
            F.coalesce("sources", F.lit(0)).alias("sources"),
            F.when(blank, F.lit(BLANK_QUERY_REPLY)).alias("reply"),
        )
    )


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = SEARCH_TOP_K,
    index: TermIndex | None = None,
    topic_map: TopicMap = TOPIC_KEYWORDS,
) -> DataFrame:
    """Best ``k`` full-text hits per query by relevance.

    Only a query without any word of three letters falls back to the best
    documents by quality, with relevance 0. A query without hits has one row
    with its hint and no document.
    """
    index = index or build_index(docs)
    hits = match_all_terms(index, analyzed_terms(queries, index.stemmed))
    ranked = first_per_query(hits, k, by_relevance(), F.asc("abstract_id"))
    shown = ["query_id", "rank", "abstract_id", "summary", "rouge_score", "topic_label", "relevance"]
    ranked = ranked.join(
        docs.select("abstract_id", "summary", "rouge_score", "topic_label"), "abstract_id"
    ).select(shown)

    wordless = queries.filter(F.coalesce(F.size(query_terms(F.col("query"))), F.lit(0)) <= 0)
    best = quality_top(docs.select("abstract_id", "summary", "rouge_score", "topic_label"), k)
    worst = F.coalesce(-F.col("rouge_score").cast("double"), F.lit(float("inf")))
    doc = F.struct(worst.alias("worst"), *best.columns)
    rows = best.agg(F.sort_array(F.collect_list(doc))).scalar()
    fallback = wordless.select("query_id", F.posexplode(rows).alias("pos", "doc")).select(
        "query_id", "doc.*", (F.col("pos") + 1).alias("rank"), F.lit(0.0).alias("relevance")
    )
    hints = route_topic(queries, topic_map).select("query_id", "topic_hint")
    return (
        hints.join(ranked.unionByName(fallback.select(shown)), "query_id", "left")
        .select(
            "query_id",
            "rank",
            "abstract_id",
            "summary",
            F.round(F.col("rouge_score").cast("double"), 3).alias("rouge_score"),
            F.col("topic_label").alias("topic"),
            F.round("relevance", 4).alias("relevance"),
            "topic_hint",
        )
    )
