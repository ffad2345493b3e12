"""Full-text search: postings, all-terms match, BM25, keyword fallback.

Documents come as ``abstract_id, summary, ...``; queries as
``query_id, query``. All operators answer the whole query table at once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F, types as T

from glosswork.fixed_values import BM25_B, BM25_K1, CANDIDATES, KEYWORD_MIN_LENGTH
from glosswork.functions.stemming import stem_counts, stem_terms
from glosswork.functions.text import (
    fallback_keywords,
    is_stop_word,
    query_terms,
    tokens,
)
from glosswork.session import delete_folder, shuffles_dropped, stage
from glosswork.sources import manifest

# Tokens per term bucket of a stored batch; the number of buckets follows.
BUCKET_TOKENS = 1 << 26
# So many batches of about one size become one.
FAN = 8
SALTS = 8
# Up to so many terms of queries go to the postings, so that only postings of those are shuffled.
SENT_TERMS = 1 << 18


@dataclass
class TermIndex:
    """Inverted index as tables and what they were built with."""

    postings: DataFrame  # term, abstract_id, tf, doc_len
    terms: DataFrame  # term, df; of a stored index one row per term and batch
    totals: DataFrame  # one row: n_docs, mean_len
    word_top: DataFrame  # term, abstract_id, rouge_score: best documents of whole words, stop words too
    grams: DataFrame  # gram, term: the words of word_top by the runs of four characters they hold
    documents: DataFrame  # abstract_id of the documents in the index
    stemmed: bool
    kept: int  # documents per word in word_top
    gram_sizes: DataFrame | None = None  # gram, n: stored indexes only
    buckets: tuple[int, ...] = ()  # numbers of buckets in use: stored indexes only


def document_frequencies(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def build_index(docs: DataFrame, stemmed: bool = True, kept: int = CANDIDATES) -> TermIndex:
    """Postings of every non-stop word of every summary.

    Stop words go before any shuffle. Terms are counted per document first;
    on a frame partitioned by ``abstract_id`` that needs no shuffle. Distinct
    words are stemmed once per document, and equal stems are added up there.
    """
    words = docs.select("abstract_id", tokens(F.col("summary")).alias("words"))
    rows = (
        words.select("abstract_id", F.size("words").alias("doc_len"), F.explode("words").alias("term"))
        .filter(~is_stop_word(F.col("term")))
        .groupBy("abstract_id", "doc_len", "term")
        .agg(F.count("*").cast("int").alias("tf"))
    )
    if stemmed:
        listed = rows.groupBy("abstract_id", "doc_len").agg(F.collect_list("term").alias("t"), F.collect_list("tf").alias("n"))
        pairs = F.explode(stem_counts(F.col("t"), F.col("n"))).alias("p")
        rows = listed.select("abstract_id", "doc_len", pairs).select("abstract_id", "doc_len", "p.term", "p.tf")
    postings = rows.select("term", "abstract_id", "tf", "doc_len")
    word_top = best_per_word(docs, kept)
    return TermIndex(
        postings,
        document_frequencies(postings),
        words.agg(F.count("*").alias("n_docs"), F.avg(F.size("words")).alias("mean_len")),
        word_top,
        word_grams(word_top),
        docs.select("abstract_id"),
        stemmed,
        kept,
    )


def term_bucket(term: Column, buckets: int) -> Column:
    """The bucket of a term among ``buckets``, a power of two.

    Buckets are numbered from ``buckets`` on, so that batches cut into
    different numbers of buckets share no bucket number.
    """
    return (F.lit(buckets) + F.pmod(F.xxhash64(term), F.lit(buckets))).cast("int")


def _bucket_keys(index: TermIndex, column: str) -> list[str]:
    return ["term_bucket", column] if index.buckets else [column]


def _with_buckets(index: TermIndex, rows: DataFrame, column: str) -> DataFrame:
    """A row for each bucket of a stored index in which ``column`` may lie."""
    if not index.buckets:
        return rows
    numbers = F.array(*[term_bucket(F.col(column), b) for b in index.buckets])
    return rows.withColumn("term_bucket", F.explode(numbers))


def write_index(index: TermIndex, path: str) -> None:
    """Add an index of new documents to the index stored at ``path``.

    A batch has as many term buckets as its own tokens need. It becomes visible
    with the list of batches that names it, which is written last.
    """
    spark = index.postings.sparkSession
    own = index.totals.first()
    published = _published(spark, path)
    if published and (index.stemmed, index.kept) != (published[0]["stemmed"], published[0]["kept"]):
        raise ValueError("the stored index was built with other settings")
    n_tokens = (own["mean_len"] or 0.0) * own["n_docs"]
    batch, buckets = _write_batch(path, n_tokens, index.postings, index.word_top, index.documents)
    row = (batch, own["n_docs"], n_tokens, buckets, index.stemmed, index.kept)
    _publish(spark, path, [*map(tuple, published), row])


def _write_batch(
    path: str, n_tokens: float, postings: DataFrame, word_top: DataFrame, documents: DataFrame
) -> tuple[str, int]:
    """Write the tables of one batch; returns its name and number of buckets.

    Rows are rebalanced by bucket, so a bucket with a term of a third of all
    documents is written by many tasks. Frequencies and grams come from the
    rows just written.
    """
    spark = postings.sparkSession
    batch, buckets = f"b{uuid.uuid4().hex}", 1 << int(n_tokens // BUCKET_TOKENS).bit_length()
    target = lambda name: f"{path}/{name}/batch={batch}"

    def written(rows: DataFrame, name: str) -> DataFrame:
        fields = [*rows.schema.fields, T.StructField("term_bucket", T.IntegerType())]
        return spark.read.schema(T.StructType(fields)).parquet(target(name)).drop("term_bucket")

    def write(name: str, rows: DataFrame, key: str) -> DataFrame:
        (
            rows.withColumn("term_bucket", term_bucket(F.col(key), buckets))
            .hint("rebalance", "term_bucket")
            .sortWithinPartitions("term_bucket", key)
            .write.partitionBy("term_bucket")
            .option("compression", "zstd")
            .parquet(target(name))
        )
        return written(rows, name)

    with shuffles_dropped(spark):
        write("terms", document_frequencies(write("postings", postings, "term")), "term")
        grams = write("grams", word_grams(write("word_top", word_top, "term")), "gram")
        write("gram_sizes", grams.groupBy("gram").agg(F.count("*").alias("n")), "gram")
        documents.write.option("compression", "zstd").parquet(target("documents"))
    return batch, buckets


_STORED = ("postings", "terms", "word_top", "grams", "gram_sizes", "documents")
_TOTALS = "batch string, n_docs long, sum_len double, buckets int, stemmed boolean, kept int"
_TERMS = "term string, df long, batch string, term_bucket int"
_GRAMS = "gram string, term string, batch string, term_bucket int"
_GRAM_SIZES = "gram string, n long, batch string, term_bucket int"


def index_exists(spark: SparkSession, path: str) -> bool:
    return bool(_published(spark, path))


def _published(spark: SparkSession, path: str) -> list[Row]:
    """One row per batch of a stored index."""
    return manifest.newest(spark, f"{path}/totals", _TOTALS)


def _publish(spark: SparkSession, path: str, batches: list[tuple]) -> None:
    manifest.publish(spark, f"{path}/totals", _TOTALS, batches)


def read_index(spark: SparkSession, path: str) -> TermIndex:
    """The stored index over all published batches."""
    published = _published(spark, path)
    if not published:
        raise ValueError(f"no index at {path}")
    totals = spark.createDataFrame(published, _TOTALS).agg(
        F.sum("n_docs").alias("n_docs"),
        F.try_divide(F.sum("sum_len"), F.sum("n_docs")).alias("mean_len"),
        F.max("buckets").alias("buckets"),
    )
    part = partial(_batches, spark, path, [r["batch"] for r in published])
    return TermIndex(
        part("postings"),
        part("terms", _TERMS),
        totals,
        part("word_top"),
        part("grams", _GRAMS),
        part("documents"),
        published[0]["stemmed"],
        published[0]["kept"],
        part("gram_sizes", _GRAM_SIZES),
        tuple(sorted({r["buckets"] for r in published})),
    )


def _batches(spark: SparkSession, path: str, batches: list[str], name: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{path}/{name}").filter(F.col("batch").isin(batches)).drop("batch")


def merge_index(spark: SparkSession, path: str, fan: int = FAN) -> int:
    """Merge stored batches until fewer than ``fan`` of about one size are left.

    Sizes count as alike between two powers of ``fan`` tokens, so a posting is
    rewritten once per power, and the number of batches grows with the
    logarithm of the index. A merged batch is cut into the buckets its tokens
    need. Searches give the same before and after: terms keep their summed
    frequencies, words their best documents. Merged batches are deleted by the
    next call, so that running searches end. Returns the number of batches.
    """
    versions = manifest.versions(spark, f"{path}/totals", _TOTALS)
    if not versions:
        return 0
    live = versions.pop(max(versions))
    _drop_versions(spark, path, versions, {r["batch"] for r in live})
    while group := _alike(live, fan):
        part = partial(_batches, spark, path, [r["batch"] for r in group])
        kept, n_tokens = group[0]["kept"], sum(r["sum_len"] for r in group)
        postings, top = part("postings").drop("term_bucket"), part("word_top").drop("term_bucket")
        batch, buckets = _write_batch(path, n_tokens, postings, _best_of_words(top, kept), part("documents"))
        n_docs = sum(r["n_docs"] for r in group)
        merged = Row(batch=batch, n_docs=n_docs, sum_len=n_tokens, buckets=buckets, stemmed=group[0]["stemmed"], kept=kept)
        live = [r for r in live if r not in group] + [merged]
        _publish(spark, path, [tuple(r) for r in live])
    return len(live)


def _alike(batches: list[Row], fan: int) -> list[Row]:
    """The batches of the lowest size that has ``fan`` of them, or none."""
    sizes: dict[int, list[Row]] = {}
    for r in batches:
        size = 0
        while r["sum_len"] >= fan ** (size + 1):
            size += 1
        sizes.setdefault(size, []).append(r)
    return next((group for _, group in sorted(sizes.items()) if len(group) >= fan), [])


def _drop_versions(spark: SparkSession, path: str, versions: dict[int, list[Row]], live: set[str]) -> None:
    """Delete old lists of batches and the batches that only they name."""
    for batch in {r["batch"] for rows in versions.values() for r in rows} - live:
        for name in _STORED:
            delete_folder(spark, f"{path}/{name}/batch={batch}")
    for version in versions:
        delete_folder(spark, f"{path}/totals/version={version}")


def analyzed_terms(queries: DataFrame, stemmed: bool = True) -> DataFrame:
    """Distinct ``query_id, term`` after stop words (and stemming)."""
    words = F.filter(query_terms(F.col("query")), lambda t: ~is_stop_word(t))
    if stemmed:
        words = stem_terms(words)
    return queries.select("query_id", F.explode(F.array_distinct(words)).alias("term"))


def bm25(tf: Column, df: Column, doc_len: Column, n_docs: Column, mean_len: Column) -> Column:
    idf = F.ln(1 + (n_docs - df + 0.5) / (df + 0.5))
    norm = BM25_K1 * (1 - BM25_B + BM25_B * doc_len / mean_len)
    return idf * tf * (BM25_K1 + 1) / (tf + norm)


def _asked_sets(index: TermIndex, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries by term set, and the terms of each distinct set, rarest first.

    A set goes by its lowest query, so no row per document carries its terms.
    Sets with a term that no document holds are dropped.
    """
    sets = terms.groupBy("query_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    first = F.min(F.struct("query_id")).over(Window.partitionBy("terms"))
    sets = sets.select("query_id", first.alias("set"), "terms")
    asked = sets.filter(F.col("set") == F.struct("query_id"))
    asked = asked.select("set", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))
    sets = sets.select("query_id", "set")
    wanted = _with_buckets(index, terms.select("term").distinct(), "term")
    held = index.terms.join(wanted, _bucket_keys(index, "term"))
    known = held.groupBy("term").agg(F.sum("df").alias("df"))
    of_set = Window.partitionBy("set")
    found = (
        asked.join(known, "term")
        .withColumn("n_known", F.count("*").over(of_set))
        .filter(F.col("n_known") == F.col("n_terms"))
        .withColumn("place", F.row_number().over(of_set.orderBy("df", "term")))
        .select("set", "term", "df", "n_terms", "place")
    )
    return sets, found


def _of_terms(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` without those of other terms, which stay out of the shuffle; all rows where the terms are many."""
    terms = found.select("term").distinct()
    if terms.limit(SENT_TERMS + 1).count() > SENT_TERMS:
        return rows
    return rows.join(F.broadcast(terms), "term", "left_semi")


def rarest_term_hits(index: TermIndex, found: DataFrame) -> DataFrame:
    """``set, abstract_id`` for the documents of each set's rarest term, with
    the number of buckets of their batch where the index is stored.

    The salt splits a term that a third of all documents hold.
    """
    keys = _bucket_keys(index, "term")
    salt = F.pmod(F.xxhash64("abstract_id"), F.lit(SALTS)).cast("int")
    first = _with_buckets(index, found.filter("place = 1"), "term").select(
        "set", *keys, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    rows = _of_terms(index.postings, found.filter("place = 1"))
    rows = rows.select(*keys, "abstract_id", salt.alias("salt"))
    hits = rows.join(first, [*keys, "salt"])
    level = [_level(F.col("term_bucket")).alias("level")] if index.buckets else []
    return hits.select("set", "abstract_id", *level)


def _level(bucket: Column) -> Column:
    """Equal for the buckets of equally cut batches."""
    return F.length(F.bin(bucket))


def match_all_terms(index: TermIndex, terms: DataFrame) -> DataFrame:
    """Documents that hold every term of a query, with BM25 ``relevance``.

    ``terms`` is ``query_id, term``. Equal term sets are answered once. A set
    starts from the documents of its rarest term, and only those look up the
    other terms, by (term, document), which is no hot key. What is asked is
    written once: it holds the frequencies, which take a pass over the postings.
    """
    sets, found = _asked_sets(index, terms)
    found = stage(found, "asked")
    totals = index.totals.select("n_docs", "mean_len")
    n_docs = totals.select("n_docs").scalar()
    mean_len = totals.select("mean_len").scalar()
    part = bm25(F.col("tf"), F.col("df"), F.col("doc_len"), n_docs, mean_len)
    asked, keys = _with_buckets(index, found.drop("place"), "term"), ["set"]
    if index.buckets:
        asked, keys = asked.withColumn("level", _level(F.col("term_bucket"))), ["set", "level"]
    wanted = rarest_term_hits(index, found).join(asked, keys)
    hits = (
        _of_terms(index.postings, found)
        .join(wanted, [*_bucket_keys(index, "term"), "abstract_id"])
        .groupBy("set", "abstract_id")
        .agg(F.count("*").alias("n"), F.first("n_terms").alias("n_terms"), F.sum(part).alias("relevance"))
        .filter(F.col("n") == F.col("n_terms"))
    )
    return sets.join(hits, "set").select("query_id", "abstract_id", "relevance")


def first_per_query(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each query.

    Spark applies the limit per task before the shuffle, so a query that
    matches a third of all documents sends ``k`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def by_relevance() -> Column:
    """Sums that differ only in the order of their parts rank as equal."""
    return F.desc(F.round("relevance", 6))


def by_quality() -> list[Column]:
    return [F.desc_nulls_last("rouge_score"), F.asc("abstract_id")]


def fulltext_candidates(
    index: TermIndex, docs: DataFrame, queries: DataFrame, k: int = CANDIDATES
) -> DataFrame:
    """Best ``k`` all-terms matches per query by relevance, then quality."""
    hits = match_all_terms(index, analyzed_terms(queries, index.stemmed))
    scored = hits.join(docs.select("abstract_id", "rouge_score"), "abstract_id")
    return first_per_query(scored, k, by_relevance(), *by_quality()).drop("rank")


def _grams(term: Column) -> Column:
    width = KEYWORD_MIN_LENGTH
    starts = F.sequence(F.lit(1), F.length(term) - width + 1)
    return F.array_distinct(F.transform(starts, lambda i: F.substring(term, i, F.lit(width))))


def best_per_word(docs: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """The best ``k`` documents of every word by quality, stop words too:
    ``term, abstract_id, rouge_score``. Spark cuts to ``k`` per task first."""
    words = docs.select(
        F.explode(F.array_distinct(tokens(F.col("summary")))).alias("term"),
        "abstract_id",
        "rouge_score",
    ).filter(F.length("term") >= KEYWORD_MIN_LENGTH)
    return _best_of_words(words, k)


def _best_of_words(rows: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("term").orderBy(*by_quality()))
    return rows.withColumn("place", rank).filter(F.col("place") <= k).drop("place")


def word_grams(word_top: DataFrame) -> DataFrame:
    """``gram, term``: every run of four characters of every word."""
    return word_top.select("term").distinct().select(F.explode(_grams(F.col("term"))).alias("gram"), "term")


def query_keywords(queries: DataFrame) -> DataFrame:
    """Distinct ``query_id, keyword``."""
    return queries.select(
        "query_id", F.explode(F.array_distinct(fallback_keywords(F.col("query")))).alias("keyword")
    )


def keyword_terms(index: TermIndex, keywords: DataFrame) -> DataFrame:
    """Distinct ``keyword, term``: words of the index that contain a keyword.

    A keyword holds only letters and digits, so it occurs in a text exactly if
    it occurs inside one word of it. Words and keywords meet on a run of four
    characters, not pair by pair, and each keyword once: on its rarest run
    where the index is stored, and then only the buckets of that run are read.
    """
    asked = keywords.select("keyword").distinct()
    keys = _bucket_keys(index, "gram")
    if index.gram_sizes is None:
        met = asked.withColumn("gram", F.substring("keyword", 1, KEYWORD_MIN_LENGTH))
    else:
        runs = asked.withColumn("gram", F.explode(_grams(F.col("keyword"))))
        sizes = _with_buckets(index, runs, "gram").join(index.gram_sizes, keys)
        per_run = sizes.groupBy("keyword", "gram").agg(F.sum("n").alias("n"))
        rarest = per_run.groupBy("keyword").agg(F.count("*").alias("held"), F.min(F.struct("n", "gram")).alias("rarest"))
        met = rarest.filter(F.col("held") == F.size(_grams(F.col("keyword")))).select("keyword", "rarest.gram")
    return (
        index.grams.join(_with_buckets(index, met, "gram"), keys)
        .filter(F.contains(F.col("term"), F.col("keyword")))
        .select("keyword", "term")
        .distinct()
    )


def _best_documents(rows: DataFrame, group: str, k: int) -> DataFrame:
    """The best ``k`` documents of each group, each once; cut per task first."""
    best = F.dense_rank().over(Window.partitionBy(group).orderBy(*by_quality()))
    return (
        rows.select(group, "abstract_id", "rouge_score")
        .withColumn("rank", best)
        .filter(F.col("rank") <= k)
        .drop("rank")
        .distinct()
    )


def keyword_candidates(index: TermIndex, queries: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """Best ``k`` keyword matches per query by quality, any case.

    Only quality orders the result, so the best ``k`` documents of a query are
    among the best ``k`` of each word that contains one of its keywords. Those
    are kept with the index, whatever the frequency of the word.
    """
    if k > index.kept:
        raise ValueError(f"the index keeps {index.kept} documents per word, not {k}")
    asked, keys = query_keywords(queries), _bucket_keys(index, "term")
    # A word meets every keyword it contains: a fixed number of tasks, as the
    # size of what goes into the join says little about what comes out.
    tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = _with_buckets(index, keyword_terms(index, asked), "term").repartition(tasks, *keys)
    per_keyword = _best_documents(index.word_top.join(wanted, keys), "keyword", k)
    return _best_documents(per_keyword.join(asked, "keyword"), "query_id", k)


def quality_top(docs: DataFrame, k: int) -> DataFrame:
    return docs.orderBy(*by_quality()).limit(k)


