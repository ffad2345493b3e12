import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from glosswork.functions.rouge import rouge_l_f
from glosswork.functions.text import counted, segments
from glosswork.operators import embed, ingest, quality, stats, summarize, topics, upsert
from glosswork.operators import vector_search as vs


def corpus(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, abstract string")


def docs_of(spark, texts):
    return ingest.distinct_documents(ingest.with_content_id(corpus(spark, texts)))


# --- ingest ---


def test_missing_text_column(spark):
    with pytest.raises(KeyError):
        ingest.normalize_corpus(corpus(spark, ["a"]), "content")


def test_one_row_per_text(spark):
    rows = ingest.with_content_id(corpus(spark, ["same", "same", "same ", None, ""]))
    out = ingest.distinct_documents(rows, "doc_id", ["doc_id"]).collect()
    assert sorted((r["abstract"], r["doc_id"]) for r in out) == [("", 4), ("same", 0), ("same ", 2)]
    assert {len(r["abstract_id"]) for r in out} == {32}


def test_copies_are_merged_before_the_shuffle(spark, plan):
    text = plan(ingest.distinct_documents(ingest.with_content_id(corpus(spark, ["a"]))))
    assert text.index("partial_first") > text.index("Exchange hashpartitioning")


def test_accounting(spark):
    rows = ingest.with_content_id(corpus(spark, ["a", "a", "b", "c"]))
    known = ingest.with_content_id(corpus(spark, ["a", "a", "z"]))
    assert tuple(ingest.ingest_accounting(rows, known).first()) == (4, 2, 2)
    assert tuple(ingest.ingest_accounting(rows.limit(0), known).first()) == (0, 0, 0)


# --- summaries and gate ---


def test_no_word_of_a_text_becomes_a_row(spark, plan):
    docs = docs_of(spark, ["One two. Two three."])
    text = plan(summarize.extractive_summary(docs))
    assert "Generate" not in text and "Join" not in text and "Window" not in text


def test_segments_weigh_by_the_counts_of_their_words(spark):
    texts = ["The apple. Apple APPLE pear the. \u212aiwi kiwi! 12 a.", "", "...", "the of and."]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    found = rows.select("t", summarize.score_segments(segments(F.col("t"))).alias("s")).collect()
    by_text = {r["t"]: r["s"] and [(-s["order"], s["pos"], s["words"]) for s in r["s"]] for r in found}
    assert by_text[texts[0]] == [(1.5, 0, 2), (1.75, 1, 4), (2.0, 2, 2), (0.5, 3, 2)]
    assert by_text[""] == by_text["..."] == []
    assert by_text["the of and."] == [(0.0, 0, 3)]
    assert by_text[None] is None


def test_counted_words_of_a_row(spark):
    rows = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, ["x"]), (4, None)], "id int, w array<string>")
    found = {r["id"]: [tuple(x) for x in r["c"]] for r in rows.select("id", counted(F.col("w")).alias("c")).collect()}
    assert found == {1: [("a", 1), ("b", 2)], 2: [], 3: [("x", 1)], 4: []}


def test_terms_are_counted_inside_documents(spark, plan):
    rows = [("a", 1, "red fox red"), ("a", 1, "red hen"), ("b", 1, "red fox"), (None, 2, "hen"), (None, 2, "hen"), ("c", 2, None)]
    docs = spark.createDataFrame(rows, "abstract_id string, topic_id int, summary string")
    found = topics.term_counts(docs)
    assert {(r["topic_id"], r["term"]): (r["tf"], r["n_docs"]) for r in found.collect()} == {
        (1, "red"): (4, 2), (1, "fox"): (2, 2), (1, "hen"): (1, 1), (1, "red fox"): (2, 2), (1, "fox red"): (1, 1),
        (1, "red hen"): (1, 1), (2, "hen"): (2, 1),
    }
    assert not re.search(r"HashAggregate\(keys=\[abstract_id#\d+, topic_id#\d+, term", plan(found))


def test_summary_length_and_order(spark):
    sentences = [f"alpha beta{i} gamma{i} delta." for i in range(60)]
    texts = [" ".join(sentences), "Short one. Two.", "", "the of and", "x " * 500]
    rows = summarize.extractive_summary(docs_of(spark, texts)).collect()
    by_text = {r["abstract"]: r["summary"] for r in rows}
    assert len(rows) == 5
    picked = by_text[texts[0]]
    assert 60 <= len(picked.split()) <= 100
    found = [texts[0].index(s + ".") for s in picked.rstrip(".").split(". ")]
    assert found == sorted(found)
    assert by_text["Short one. Two."] == "Short one. Two."
    assert by_text[""] == ""
    assert by_text["the of and"] == "the of and"
    # Two segments of 40 words, then the last one, of 20.
    assert len(by_text["x " * 500].split()) == 100


def test_summary_is_a_subsequence(spark):
    text = "One two three. " * 100 + "Four five, six! " * 50
    row = summarize.extractive_summary(docs_of(spark, [text])).first()
    m, n = len(row["summary"].split()), len(text.split())
    assert rouge_l_f(text, row["summary"]) == pytest.approx(2 * m / (m + n))


def test_model_summary_loads_once_per_task(spark):
    def load():
        return lambda texts: [t.upper() for t in texts]

    rows = summarize.model_summary(docs_of(spark, ["ab", "cd"]), load).collect()
    assert sorted(r["summary"] for r in rows) == ["AB", "CD"]


def test_gate_edges(spark):
    scores = spark.createDataFrame([(0.1499,), (0.15,), (0.1501,), (None,)], "rouge_score double")
    kept = sorted(r[0] for r in quality.quality_gate(scores).collect())
    assert kept == [0.15, 0.1501]
    assert tuple(quality.gate_accounting(scores).first()) == (4, 2, 2)


def test_gate_runs_the_scorer_once(spark, plan):
    df = docs_of(spark, ["a b c"]).withColumn("summary", F.col("abstract"))
    assert plan(quality.quality_gate(quality.with_rouge(df))).count("ArrowEvalPython") == 1


def test_extracts_are_scored_without_being_kept(spark):
    """Only the score is asked for, so the summary is computed inside the scorer's argument."""
    texts = [" ".join(f"alpha beta{i} gamma{i} delta." for i in range(60)), "Short one. Two.", "", "the of and", "x " * 900]
    rows = summarize.extractive_summary(docs_of(spark, texts)).collect()
    expected = sorted(rouge_l_f(r["abstract"], r["summary"]) for r in rows)
    scored = quality.with_rouge(summarize.extractive_summary(docs_of(spark, texts)))
    found = sorted(r["rouge_score"] for r in scored.select("abstract_id", "rouge_score").collect())
    assert found == pytest.approx(expected)
    kept = sum(x >= 0.15 for x in expected)
    assert quality.quality_gate(scored).select("abstract_id").count() == kept
    assert tuple(quality.gate_accounting(scored).first()) == (5, kept, 5 - kept)


# --- statistics ---


def test_stats(spark):
    schema = "abstract_id string, rouge_score double, topic_id int, topic_label string"
    rows = [("a", 0.2, 1, "x"), ("b", 0.4, 1, "x"), ("c", None, 2, "y"), ("d", 0.5, None, None)]
    s = spark.createDataFrame(rows, schema)
    v = spark.createDataFrame([("a",)], "abstract_id string")
    assert [tuple(r) for r in stats.topic_stats(s).collect()] == [
        (1, "x", 2, 0.3), (2, "y", 1, None), (None, None, 1, 0.5),
    ]
    out = stats.corpus_stats(s, v).first()
    assert (out["count"], out["avg_rouge"], out["vectors"], out["topics"]) == (
        4, 0.367, 1, {"x": 2, "y": 1},
    )
    empty = stats.corpus_stats(s.limit(0), v).first()
    assert (empty["count"], empty["avg_rouge"], empty["topics"]) == (0, 0.0, {})
    assert tuple(stats.verify_report(s, v).first()) == (4, 1, 0.367, 2)


# --- vectors ---


@pytest.fixture(scope="module")
def space(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(300, 8)).astype("float32")
    points[50] = points[10]  # equal vectors: ties go to the lower id
    rows = [(i, [float(x) for x in p], i % 3 if i > 100 else 0) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "abstract_id long, embedding array<float>, cell int")
    queries = vectors.filter("abstract_id < 20").select(
        F.col("abstract_id").alias("query_id"), F.col("embedding").alias("query_vector")
    )
    return points, vectors.repartition(5), queries


def brute(points, query_ids, k, allowed=None):
    out = {}
    for q in query_ids:
        sims = np.round(points.astype("float64") @ points[q].astype("float64"), 6)
        ids = [i for i in range(len(points)) if allowed is None or i in allowed[q]]
        out[q] = sorted(ids, key=lambda i: (-sims[i], i))[:k]
    return out


def ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["abstract_id"])
    return out


@pytest.mark.parametrize("query_block,vector_block", [(4, 70), (1024, 20_000)])
def test_exact_search(space, monkeypatch, query_block, vector_block):
    points, vectors, queries = space
    monkeypatch.setattr(vs, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(vs, "VECTOR_BLOCK", vector_block)
    got = ranked(vs.vector_search(vectors, queries, 4))
    assert got == brute(points, range(20), 4)


def test_only_near_scores_are_rounded(monkeypatch):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(5000, 8))
    points[70] = points[10]  # equal vectors: ties go to the lower id
    ids, rounded, real = np.arange(5000).astype(object), [], np.round
    monkeypatch.setattr(vs.np, "round", lambda a, *d: (rounded.append(np.size(a)), real(a, *d))[1])
    rows = vs._block_top_k(ids, points, ids[:40], points[:40], 4)
    monkeypatch.undo()
    got = {q: list(r["abstract_id"]) for q, r in rows.groupby("query_id")}
    assert got == brute(points, range(40), 4)
    assert sum(rounded) < 40 * 5000 / 50
    points[33, 0] = np.nan  # no number: nobody's neighbour
    rows = vs._block_top_k(ids, points, ids[:40], points[:40], 4)
    assert 33 not in set(rows["abstract_id"]) | set(rows["query_id"])


def test_few_queries_leave_the_vectors_where_they_are(spark, space, plan, tmp_path):
    points, vectors, queries = space
    vectors.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    text = plan(vs.vector_search(stored, queries, 4))
    assert "Exchange" not in text[text.index("MapInPandas") :]
    assert ranked(vs.vector_search(stored.repartition(50), queries, 4)) == brute(points, range(20), 4)


def test_vectors_are_shuffled_once_and_not_repeated(space, plan, monkeypatch):
    _, vectors, queries = space
    monkeypatch.setattr(vs, "QUERY_BLOCK", 4)  # 20 queries are many
    text = plan(vs.vector_search(vectors, queries, 4))
    start = text.index("MapInPandas")
    assert text[start:].count("Generate explode(sequence") == 1  # query blocks only


def test_cell_search(space, monkeypatch):
    points, vectors, queries = space
    monkeypatch.setattr(vs, "VECTOR_BLOCK", 50)
    rows = vs.mean_vectors(vectors, "cell").orderBy("cell").collect()
    centroids = [r["centroid"] for r in rows]
    cells = {r["abstract_id"]: r["cell"] for r in vectors.collect()}
    unit = np.array(centroids) / np.linalg.norm(centroids, axis=1, keepdims=True)
    allowed = {}
    for q in range(20):
        sims = np.round(unit @ (points[q] / np.linalg.norm(points[q])), 6)
        near = set(np.argsort(-sims, kind="stable")[:2])
        allowed[q] = {i for i in cells if cells[i] in near}
    got = ranked(vs.vector_search_cells(vectors, queries, centroids, 2, 4))
    assert got == brute(points, range(20), 4, allowed)


def test_all_cells_equal_exact_search(space):
    points, vectors, queries = space
    centroids = vs.fit_cells(vectors, 6)
    placed = vs.with_cell(vectors.drop("cell"), centroids)
    assert ranked(vs.vector_search_cells(placed, queries, centroids, 6, 3)) == brute(points, range(20), 3)


def test_stored_cells_are_pruned(spark, space, plan, tmp_path):
    points, vectors, queries = space
    vs.write_cells(vectors, str(tmp_path / "cells"))
    stored = spark.read.parquet(str(tmp_path / "cells"))
    rows = vs.mean_vectors(vectors, "cell").orderBy("cell").collect()
    hits = vs.vector_search_cells(stored, queries.limit(1), [r["centroid"] for r in rows], 1, 3)
    assert "dynamicpruning" in plan(hits)
    assert hits.count() == 3


def test_no_queries(space):
    _, vectors, queries = space
    assert vs.vector_search(vectors, queries.limit(0)).count() == 0


def test_search_has_no_pair_table(space, plan):
    _, vectors, queries = space
    text = plan(vs.vector_search(vectors, queries, 3))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_summaries_are_joined_before_the_cut(spark, space):
    points, vectors, queries = space
    rows = [(i, f"s{i}", 0.5, "x") for i in range(0, 300, 2)]
    docs = spark.createDataFrame(rows, "abstract_id long, summary string, rouge_score double, topic_label string")
    got = ranked(vs.summary_search(vectors, queries, docs, 3))
    assert got == brute(points, range(20), 3, {q: set(range(0, 300, 2)) for q in range(20)})


def test_recall(spark):
    frame = lambda rows: spark.createDataFrame(rows, "query_id int, abstract_id int")
    exact = frame([(1, 1), (1, 2), (2, 1), (2, 3)])
    assert vs.recall(frame([(1, 1), (2, 3), (2, 4)]), exact).first()["recall"] == 0.5


# --- embeddings ---


def test_hash_embedding_is_unit_and_separates(spark):
    docs = spark.createDataFrame(
        [("a", "cancer radiation therapy"), ("b", "cancer radiation dose"), ("c", "milk vitamin infant"),
         ("d", "the of and")],
        "abstract_id string, summary string",
    )
    rows = {r[0]: np.array(r[1]) for r in embed.hash_embedding(docs, 64).collect()}
    assert set(rows) == {"a", "b", "c", "d"} and len(rows["d"]) == 64 and not rows["d"].any()
    assert all(len(v) == 64 and abs(np.linalg.norm(v) - 1) < 1e-9 for k, v in rows.items() if k != "d")
    assert rows["a"] @ rows["b"] > rows["a"] @ rows["c"]


def test_embedding_is_tf_idf_in_a_fixed_space(spark):
    docs = spark.createDataFrame(
        [("a", "lung lung cancer"), ("b", "cancer"), ("c", "cancer milk")], "abstract_id string, summary string"
    )
    counts = embed.term_counts(docs)
    idf = embed.term_idf(counts, docs)
    assert {r["term"]: round(r["idf"], 9) for r in idf.collect()} == {
        "lung": round(float(np.log(4 / 2)) + 1, 9), "milk": round(float(np.log(4 / 2)) + 1, 9), "cancer": 1.0,
    }
    whole = {r[0]: np.array(r[1]) for r in embed.hash_embedding(docs, 512).collect()}
    lung = 2 * (np.log(2) + 1)
    assert sorted(abs(whole["a"][whole["a"] != 0])) == pytest.approx(sorted([lung, 1] / np.hypot(lung, 1)))
    # Alone, a text lands where it lands with its corpus; unknown words get a weight too.
    alone = embed.hash_embedding(docs.filter("abstract_id = 'a'"), 512, idf).first()["embedding"]
    assert alone == pytest.approx(whole["a"].tolist())
    new = spark.createDataFrame([("n", "unknownword")], "abstract_id string, summary string")
    assert np.linalg.norm(embed.hash_embedding(new, 512, idf).first()["embedding"]) == pytest.approx(1)


def test_model_embedding(spark):
    docs = spark.createDataFrame([("a", "xx")], "abstract_id string, summary string")
    out = embed.model_embedding(docs, lambda: lambda texts: [[3.0, 4.0] for _ in texts])
    assert out.first()["embedding"] == pytest.approx([0.6, 0.8])


# --- topics ---


def test_small_topics_become_noise(spark):
    rows = [(f"a{i}", 0, 0.9) for i in range(12)] + [(f"b{i}", 1, 0.9) for i in range(3)]
    rows += [("c", 0, 0.1)]
    assigned = spark.createDataFrame(rows, "abstract_id string, topic_id int, topic_score double")
    out = {r["abstract_id"]: r["topic_id"] for r in topics.mark_noise(assigned, 10, 0.5).collect()}
    assert {out[f"a{i}"] for i in range(12)} == {0}
    assert out["b0"] == out["c"] == -1
    assert len(out) == 16


def test_noise_runs_the_assignment_once(spark, plan):
    assigned = spark.createDataFrame([("a", 0, 0.9)], "abstract_id string, topic_id int, topic_score double")
    assert "ArrowEvalPython" not in plan(topics.mark_noise(assigned))


def test_apply_merge(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "abstract_id string, topic_id int")
    assert [r["topic_id"] for r in topics.apply_merge(rows, {1: 5, 2: 2}).orderBy("abstract_id").collect()] == [5, 2, None]


def test_merge_chains():
    turn = lambda d: [float(np.cos(np.radians(d))), float(np.sin(np.radians(d)))]
    centroids = [turn(0), turn(20), turn(40), turn(170)]
    assert topics.merge_similar(centroids, 0.9) == {0: 0, 1: 0, 2: 0, 3: 3}
    assert topics.merge_similar(centroids, 0.9, [7, 5, 9, 2]) == {7: 5, 5: 5, 9: 5, 2: 2}


def test_topics_merge_by_their_words(spark):
    shared = {0: "abcd", 1: "abce", 2: "abcf", 3: "pqrs", 4: "pqrt", 5: "xyz", -1: "abcd"}
    rows = [(t, w, 1.0 + 0.1 * i + 0.01 * t) for t, words in shared.items() for i, w in enumerate(words)]
    terms = spark.createDataFrame(rows, "topic_id int, term string, weight double")
    weights = {t: {w: x for own, w, x in rows if own == t} for t in shared}
    norm = {t: sum(x * x for x in v.values()) ** 0.5 for t, v in weights.items()}
    want = {}
    for a in weights:
        for b in weights:
            dot = sum(x * weights[b].get(w, 0) for w, x in weights[a].items())
            if a < b and dot:
                want[a, b] = dot / norm[a] / norm[b]
    got = {(r.a, r.b): r.cosine for r in topics.term_similarity(terms).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    merged = lambda **how: {r.topic_id: r.merged for r in topics.merge_by_terms(terms, **how).collect()}
    assert merged(threshold=0.5) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5}
    assert merged(threshold=1.0) == {t: t for t in range(6)}
    assert merged() == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5}
    assert topics.merge_by_terms(terms.limit(0)).count() == 0


def test_topic_words(spark):
    rows = [("1", 0, "lung cancer lung cancer"), ("2", 0, "lung cancer"), ("3", 1, "milk lung"), ("4", 1, "milk")]
    docs = spark.createDataFrame(rows, "abstract_id string, topic_id int, summary string")
    labels = {r[0]: r[1] for r in topics.topic_labels(docs, topics.topic_terms(docs)).collect()}
    assert labels[0] == "cancer_lung cancer_lung"
    assert labels[1].startswith("milk_")
    df = {r["term"]: r["df"] for r in topics.document_frequency(docs).collect()}
    assert df == {"lung": 3, "cancer": 2, "lung cancer": 2, "milk": 2}


def test_wordless_topic_gets_its_number(spark):
    docs = spark.createDataFrame([("1", 5, "the"), ("2", -1, "x")], "abstract_id string, topic_id int, summary string")
    labels = {r[0]: r[1] for r in topics.topic_labels(docs, topics.topic_terms(docs)).collect()}
    assert labels == {5: "topic_5", -1: "outlier"}


def test_kmeans_finds_separate_groups(spark):
    rng = np.random.default_rng(3)
    rows = [
        (f"{g}-{i}", [float(x) for x in np.eye(4)[g] + rng.normal(scale=0.02, size=4)])
        for g in range(3) for i in range(20)
    ]
    vectors = spark.createDataFrame(rows, "abstract_id string, embedding array<double>")
    for reduce_to in (None, 3):
        model = topics.fit_topics(vectors, 3, reduce_to)
        out = topics.assign_topics(topics.project(model, vectors), topics.centroids_of(model)).collect()
        groups = {(r["abstract_id"][0], r["topic_id"]) for r in out}
        assert len(groups) == 3
        own = {r["abstract_id"]: r["topic_id"] for r in topics.predict(model, vectors).collect()}
        assert own == {r["abstract_id"]: r["topic_id"] for r in out}
    assert len(topics.reduce_dimensions(vectors, 2).first()["embedding"]) == 2


# --- keyed writes ---


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "abstract_id string, v int")
    stored = spark.createDataFrame([("a", 9)], "abstract_id string, v int")
    assert [tuple(r) for r in upsert.insert_if_absent(new, stored).collect()] == [("b", 2)]


def test_update_by_key(spark):
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "abstract_id string, t int, l string")
    updates = spark.createDataFrame([("b", None, "z"), ("c", 3, "w")], "abstract_id string, t int, l string")
    out = sorted(tuple(r) for r in upsert.update_by_key(stored, updates, ["t", "l"]).collect())
    assert out == [("a", 1, "x"), ("b", None, "z")]
    # One row per id, whatever the updates repeat.
    again = updates.unionByName(spark.createDataFrame([("b", 7, "q"), ("b", 7, "r")], updates.schema))
    out = sorted(tuple(r) for r in upsert.update_by_key(stored, again, ["t", "l"]).collect())
    assert out == [("a", 1, "x"), ("b", 7, "r")]
