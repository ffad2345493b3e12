import pytest
from pyspark.sql import functions as F, types as T

from glosswork.operators import retrieval
from glosswork.plans import jobs
from glosswork.session import drop_staged, stage, staging_root
from glosswork.sources import tables
from glosswork.streaming.ingest_stream import append_new, start_ingest

TOPIC_A = "Radiation of the {0} tumor was measured in patients. The {0} tumor shrank after radiation."
TOPIC_B = "Vitamin intake of infants rose with {0} milk. Infants given {0} milk had more vitamin."
NAMES = "ab bc cd de ef fg gh hi ij jk kl lm".split()


@pytest.fixture
def corpus(spark):
    texts = [TOPIC_A.format(n) for n in NAMES] + [TOPIC_B.format(n) for n in NAMES]
    texts += [texts[0], None, " ".join(f"word{i}" for i in range(5000))]
    return spark.createDataFrame([(t,) for t in texts], "abstract string")


def test_enrich_twice_adds_nothing(spark, corpus, tmp_path):
    root = str(tmp_path / "store")
    tables.setup_tables(spark, root)
    tables.setup_tables(spark, root)
    first = jobs.enrich(spark, root, corpus).first()
    assert tuple(first) == ("done", 26, 0, 26, 25, 24, 1)
    again = jobs.enrich(spark, root, corpus).first()
    assert tuple(again) == ("nothing new", 26, 26, 0, 0, 0, 0)
    stored = tables.read_table(spark, root, "summaries")
    assert stored.count() == stored.select("abstract_id").distinct().count() == 24
    assert stored.filter(F.col("rouge_score") < 0.15).count() == 0
    assert tables.read_table(spark, root, "rejected").count() == 1


def test_topics_end_to_end(spark, corpus, tmp_path):
    root = str(tmp_path / "store")
    jobs.enrich(spark, root, corpus)
    labels = jobs.model_topics(spark, root, 2, min_size=5).collect()
    assert len(labels) == 2
    read = jobs.read_summaries(spark, root)
    groups = read.groupBy("topic_id").agg(F.collect_set(F.contains("summary", F.lit("milk")))).collect()
    assert sorted(len(g[1]) for g in groups) == [1, 1]
    report = jobs.verify(spark, root).first()
    assert (report["records"], report["vectors"], report["topics"]) == (24, 24, 2)
    # A second run stores a new version, and no vector twice.
    jobs.model_topics(spark, root, 2, min_size=5)
    assert jobs.read_summaries(spark, root).count() == 24
    assert tables.read_table(spark, root, "vectors").count() == 24
    assert tables.read_table(spark, root, "topics").count() == 48
    # Everything is assigned by version 1, so a saved model finds nothing new.
    assert jobs.assign_new(spark, root, 1).count() == 0

    queries = spark.createDataFrame([(1, "radiation tumor")], "query_id int, query string")
    ranked = retrieval.retrieve(jobs.read_summaries(spark, root), queries).collect()
    assert len(ranked) == 8 and all("tumor" in r["summary"] for r in ranked)


def test_density_finds_the_number_of_topics(spark, corpus, tmp_path):
    root = str(tmp_path / "store")
    old = corpus.filter(~F.contains("abstract", F.lit("lm ")) | F.col("abstract").isNull())

    def embed(docs):
        """Two directions, one per topic, with a little of each text's own."""
        own = [F.pmod(F.xxhash64(F.lit(i), "summary"), F.lit(1000)) / 4000 for i in (0, 1)]
        milk, tumor = (F.contains("summary", F.lit(x)).cast("double") for x in ("milk", "tumor"))
        return docs.select("abstract_id", F.array(milk + own[0] * tumor, tumor + own[0] * milk, own[1] * (milk + tumor)).alias("embedding"))

    jobs.enrich(spark, root, old)
    labels = jobs.model_topics(spark, root, embed=embed, min_size=5, neighbours=8, min_samples=3).collect()
    assert {r["topic_id"] for r in labels} - {-1} == {0, 1}
    extra = spark.createDataFrame([("Of the and.",)], "abstract string")
    jobs.enrich(spark, root, corpus.unionByName(extra), embed=embed)
    read = {r["summary"]: r for r in jobs.read_summaries(spark, root).collect()}
    assert len(read) == 25 and all(r["topic_label"] is not None for r in read.values())
    assert (read["Of the and."]["topic_id"], read["Of the and."]["topic_score"]) == (-1, 0.0)
    for text in (TOPIC_A, TOPIC_B):
        rows = [read[text.format(n)] for n in NAMES]
        found = {r["topic_id"] for r in rows} - {-1}
        assert len(found) == 1 and read[text.format("lm")]["topic_id"] in found
        assert all(0 < r["topic_score"] <= 1 for r in rows if r["topic_id"] >= 0)
    assert read[TOPIC_A.format("lm")]["topic_id"] != read[TOPIC_B.format("lm")]["topic_id"]
    assert jobs.assign_new(spark, root, 1, embed).count() == 0
    # The same over two coordinates of the neighbour graph; a text that comes later is placed among its neighbours.
    jobs.model_topics(spark, root, embed=embed, min_size=5, neighbours=8, min_samples=3, reduce_to=2)
    late = spark.createDataFrame([(TOPIC_A.format("zz"),)], "abstract string")
    jobs.enrich(spark, root, late, embed=embed)
    read = jobs.read_summaries(spark, root).collect()
    assert len(read) == 26 and all(r["topic_label"] is not None for r in read)
    families = {t: {r["topic_id"] for r in read if t in r["summary"]} - {-1} for t in ("milk", "tumor")}
    assert families["milk"] and families["tumor"] and not families["milk"] & families["tumor"]
    assert spark.read.parquet(f"{root}/models/version=2/layout").count() == 24
    with pytest.raises(ValueError, match="k-means"):
        jobs.model_topics(spark, root, merge_at=0.5)


def test_all_small_topics_are_outliers(spark, corpus, tmp_path):
    root = str(tmp_path / "store")
    jobs.enrich(spark, root, corpus)
    labels = jobs.model_topics(spark, root, 2, min_size=100, merge_at=0.99, reduce_to=3).collect()
    assert [tuple(r) for r in labels] == [(-1, "outlier")]


def test_topics_with_the_same_words_become_one(spark, corpus, tmp_path):
    root = str(tmp_path / "store")
    old = corpus.filter(~F.contains("abstract", F.lit("lm ")) | F.col("abstract").isNull())
    jobs.enrich(spark, root, old)
    labels = jobs.model_topics(spark, root, 4, min_size=1, merge_terms=True).collect()
    assert len(labels) == 2
    jobs.enrich(spark, root, corpus)
    read = {r["summary"]: r["topic_id"] for r in jobs.read_summaries(spark, root).collect()}
    for text in (TOPIC_A, TOPIC_B):
        assert len({read[text.format(n)] for n in NAMES}) == 1
    assert len(set(read.values())) == 2


def test_new_rows_get_topics_after_a_merge(spark, corpus, tmp_path):
    root = str(tmp_path / "store")
    old = corpus.filter(~F.contains("abstract", F.lit("lm ")) | F.col("abstract").isNull())
    jobs.enrich(spark, root, old)
    jobs.model_topics(spark, root, 4, min_size=3, merge_at=0.5)
    extra = spark.createDataFrame([("Of the and.",)], "abstract string")  # no content words
    assert jobs.enrich(spark, root, corpus.unionByName(extra)).first()["kept"] == 3
    read = jobs.read_summaries(spark, root).collect()
    assert len(read) == 25
    assert all(r["topic_id"] is not None and r["topic_label"] is not None for r in read)
    topic = {r["summary"]: (r["topic_id"], r["topic_label"]) for r in read}
    assert topic["Of the and."] == (-1, "outlier")
    assert topic[TOPIC_A.format("lm")] == topic[TOPIC_A.format("ab")]
    assert topic[TOPIC_B.format("lm")] == topic[TOPIC_B.format("ab")]
    assert tables.read_table(spark, root, "vectors").count() == 25
    # Reads of one version skip the others.
    plan = jobs.latest_topics(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model_version" in plan


def test_index_follows_the_store(spark, corpus, tmp_path):
    root = str(tmp_path / "store")
    old = corpus.filter(~F.contains("abstract", F.lit("lm ")) | F.col("abstract").isNull())
    queries = spark.createDataFrame([(1, "tumors lm"), (2, "milk")], "query_id int, query string")

    def hits():
        docs, index = jobs.read_summaries(spark, root), jobs.search_index(spark, root)
        rows = retrieval.search(docs, queries, 30, index).filter("abstract_id IS NOT NULL").collect()
        return {i: sum(r["query_id"] == i for r in rows) for i in (1, 2)}

    for batch, found in ((old, {1: 11, 2: 11}), (corpus, {1: 12, 2: 12})):
        jobs.enrich(spark, root, batch)
        assert jobs.index_new(spark, root).first()["indexed"] > 0
        assert hits() == found
    assert jobs.index_new(spark, root).first()["indexed"] == 0


def test_stored_cells(spark, corpus, tmp_path):
    root = str(tmp_path / "store")
    jobs.enrich(spark, root, corpus)
    jobs.embed_new(spark, root)
    jobs.store_cells(spark, root, 2)
    vectors = tables.read_table(spark, root, "vectors")
    queries = vectors.select(F.col("abstract_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    hits = jobs.search_cells(spark, root, queries, 2, 1).collect()
    assert len(hits) == 24 and all(r["query_id"] == r["abstract_id"] for r in hits)


def test_a_lower_gate_lets_blocked_rows_in(spark, corpus, tmp_path):
    root = str(tmp_path / "store")
    assert jobs.enrich(spark, root, corpus).first()["blocked"] == 1
    assert jobs.enrich(spark, root, corpus, threshold=0.0).first()["kept"] == 1
    assert tables.read_table(spark, root, "summaries").count() == 25


def test_staged_tables_are_deleted(spark):
    staged = stage(spark.range(3), "gone")
    path = staged.staged_at
    drop_staged(staged)
    assert not tables.table_exists(spark, path)
    with pytest.raises(ValueError):
        drop_staged(spark.range(3))


def test_reading_tables_that_do_not_exist(spark, tmp_path):
    for name, schema in tables.TABLES.items():
        empty = tables.read_table(spark, str(tmp_path / "none"), name)
        assert empty.count() == 0 and empty.columns == schema.names


def test_read_corpus(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, content string").write.parquet(path)
    first = tables.read_corpus(spark, path, first=2, order_by="id")
    assert [r["abstract"] for r in first.collect()] == ["a", "b"]
    assert tables.read_corpus(spark, path).count() == 3
    with pytest.raises(KeyError):
        tables.read_corpus(spark, path, "body")


def test_stage_uses_the_session_folder(spark):
    df = spark.range(5)
    out = stage(df, "numbers")
    assert sorted(r[0] for r in out.collect()) == list(range(5))
    assert staging_root(spark).rstrip("/") in out.inputFiles()[0].replace("file://", "")


def test_stream_ingest(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = T.StructType([T.StructField("content", T.StringType())])

    def add(*texts):
        spark.createDataFrame([(t,) for t in texts], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        query = start_ingest(spark, source, schema, checkpoint, append_new(target), files_per_batch=1)
        query.awaitTermination()
        return sorted(r["abstract"] for r in spark.read.parquet(target).collect())

    add("a", "b", "a")
    add("b", "c", None)
    assert run() == ["a", "b", "c"]
    assert run() == ["a", "b", "c"]
    add("d", "a")
    assert run() == ["a", "b", "c", "d"]


def test_stream_with_enrich(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "store", "check"))
    schema = T.StructType([T.StructField("content", T.StringType())])
    rows = [(TOPIC_A.format(n),) for n in NAMES]
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(source)
    query = start_ingest(
        spark, source, schema, checkpoint, lambda batch: jobs.enrich(batch.sparkSession, root, batch)
    )
    query.awaitTermination()
    assert tables.read_table(spark, root, "summaries").count() == len(NAMES)
