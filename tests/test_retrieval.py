import random

import pytest
from pyspark.sql import Row, functions as F

from glosswork.fixed_values import STOP_WORDS, TOPIC_KEYWORDS
from glosswork.operators import fulltext, retrieval

SCHEMA = "abstract_id string, summary string, rouge_score double, topic_label string"


def make_docs(n=60, seed=5):
    rng = random.Random(seed)
    words = "cancer lung milk heart dose trial plasma urine joint salt the of with from".split()
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(3, 12)))
        if i < 3:
            text += " rareword"
        if i < 20:
            text += " Common"
        if 30 <= i < 34:
            text += " fourfold"
        if i == 40:
            text += " preglucosetail"
        score = None if i == 7 else round(rng.random(), 2)
        rows.append((f"d{i:02d}", text, score, rng.choice(["cancer_radiation_patients", "x", "", None])))
    return rows


ROWS = make_docs()
QUERIES = [
    (1, "absentword glucose"),  # keyword hit only
    (2, "rareword"),  # three full-text hits, filled up
    (3, "fourfold"),  # four hits, enough
    (4, "common"),  # twenty hits, cut to sixteen
    (5, "of a is"),  # words too short or stop words
    (6, "zzzzz qqqqq"),  # nothing matches
    (7, "Cancer, lung!"),
    (8, "with the"),  # stop words only
    (9, "   "),
    (10, "rarewor"),  # part of a word
]


@pytest.fixture(scope="module")
def data(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    queries = spark.createDataFrame(QUERIES, "query_id int, query string")
    return docs, queries


def clean(query, longer_than):
    kept = "".join(c for c in query if c.isalnum() or c.isspace())
    return [w for w in kept.lower().split() if len(w) > longer_than]


def by_quality(rows):
    return sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))


def brute_full_text(query):
    terms = {w for w in clean(query, 2) if w not in STOP_WORDS}
    if not terms:
        return set()
    return {r[0] for r in ROWS if terms <= set(r[1].lower().split())}


def brute_keyword(query):
    keywords = clean(query, 3)
    hits = [r for r in ROWS if any(k in r[1].lower() for k in keywords)]
    return [r[0] for r in by_quality(hits)[:16]]


def test_full_text_match(data):
    docs, queries = data
    index = fulltext.build_index(docs, stemmed=False)
    got = {}
    for r in fulltext.match_all_terms(index, fulltext.analyzed_terms(queries, stemmed=False)).collect():
        got.setdefault(r["query_id"], set()).add(r["abstract_id"])
    assert got == {i: brute_full_text(q) for i, q in QUERIES if brute_full_text(q)}


def test_bm25_value(spark):
    docs = spark.createDataFrame([("a", "cat dog cat", 0.5), ("b", "dog", 0.5)],
                                 "abstract_id string, summary string, rouge_score double")
    queries = spark.createDataFrame([(1, "cats cat")], "query_id int, query string")
    index = fulltext.build_index(docs, stemmed=True)
    row = fulltext.match_all_terms(index, fulltext.analyzed_terms(queries, stemmed=True)).first()
    # N = 2, df = 1, tf = 2, length 3, mean length 2
    expected = 0.693147 * 2 * 2.2 / (2 + 1.2 * (0.25 + 0.75 * 1.5))
    assert row["relevance"] == pytest.approx(expected, abs=1e-5)


def hits_of(index, queries):
    terms = fulltext.analyzed_terms(queries, index.stemmed)
    rows = fulltext.match_all_terms(index, terms).collect()
    return sorted((r["query_id"], r["abstract_id"], round(r["relevance"], 6)) for r in rows)


@pytest.mark.parametrize("stemmed", [False, True])
def test_stored_index_in_two_batches_gives_the_same_matches(spark, data, tmp_path, stemmed, monkeypatch):
    docs, queries = data
    monkeypatch.setattr(fulltext, "BUCKET_TOKENS", 50)
    index = fulltext.build_index(docs, stemmed)
    path = str(tmp_path / "index")
    for part in (docs.filter("abstract_id < 'd25'"), docs.filter("abstract_id >= 'd25'")):
        fulltext.write_index(fulltext.build_index(part, stemmed), path)
    stored = fulltext.read_index(spark, path)
    assert stored.stemmed == stemmed and stored.totals.first()["buckets"] > 1
    assert hits_of(stored, queries) == hits_of(index, queries) != []
    keyword = lambda i: sorted(map(tuple, fulltext.keyword_candidates(i, queries).collect()), key=str)
    assert keyword(stored) == keyword(index)
    assert stored.documents.count() == len(ROWS)
    with pytest.raises(ValueError):
        fulltext.write_index(fulltext.build_index(docs, not stemmed), path)


def test_an_unpublished_batch_is_not_seen(spark, data, tmp_path):
    docs, queries = data
    path = str(tmp_path / "index")
    index = fulltext.build_index(docs)
    fulltext.write_index(index, path)
    before = hits_of(fulltext.read_index(spark, path), queries)
    rows = spark.read.parquet(f"{path}/postings").drop("batch").withColumn("batch", F.lit("half"))
    rows.write.mode("append").partitionBy("batch", "term_bucket").parquet(f"{path}/postings")
    assert hits_of(fulltext.read_index(spark, path), queries) == before


def test_stored_index_reads_only_the_buckets_asked_for(spark, data, plan, tmp_path, monkeypatch):
    docs, queries = data
    monkeypatch.setattr(fulltext, "BUCKET_TOKENS", 50)
    fulltext.write_index(fulltext.build_index(docs), str(tmp_path / "index"))
    stored = fulltext.read_index(spark, str(tmp_path / "index"))
    hits = fulltext.match_all_terms(stored, fulltext.analyzed_terms(queries))
    assert "dynamicpruning" in plan(hits)
    assert "dynamicpruning" in plan(fulltext.keyword_candidates(stored, queries))


def test_search_starts_from_the_rarest_term(spark):
    rows = [(f"d{i:03d}", "common" + (" frequent" if i % 2 else "") + (" rare" if i < 3 else ""), 0.5) for i in range(90)]
    docs = spark.createDataFrame(rows, "abstract_id string, summary string, rouge_score double")
    queries = spark.createDataFrame([(1, "common frequent rare"), (2, "rare common frequent"), (3, "common")],
                                    "query_id int, query string")
    index = fulltext.build_index(docs)
    sets, found = fulltext._asked_sets(index, fulltext.analyzed_terms(queries))
    assert sets.count() == 3 and found.select("set").distinct().count() == 2
    first = fulltext.rarest_term_hits(index, found)
    assert first.count() == 3 + 90
    assert [x[:2] for x in hits_of(index, queries) if x[0] < 3] == [(1, "d001"), (2, "d001")]


def test_equal_stems_meet_inside_their_document(spark, plan):
    rows = [("d1", "cats cat running runs run the", 0.5), ("d2", "cat", 0.5), ("d3", None, 0.5), ("d4", "the of", 0.5)]
    docs = spark.createDataFrame(rows, "abstract_id string, summary string, rouge_score double")
    postings = fulltext.build_index(docs.repartition("abstract_id")).postings
    assert plan(postings).count("Exchange hashpartitioning") == 1  # that of the documents
    got = sorted((r["abstract_id"], r["term"], r["tf"], r["doc_len"]) for r in postings.collect())
    assert got == [("d1", "cat", 2, 6), ("d1", "run", 3, 6), ("d2", "cat", 1, 1)]


@pytest.mark.parametrize("stored", [False, True])
def test_postings_of_other_terms_stay_out_of_the_shuffle(spark, data, plan, tmp_path, monkeypatch, stored):
    docs, queries = data
    index = fulltext.build_index(docs)
    if stored:
        fulltext.write_index(index, str(tmp_path / "index"))
        index = fulltext.read_index(spark, str(tmp_path / "index"))
    terms = fulltext.analyzed_terms(queries, index.stemmed)
    assert plan(fulltext.match_all_terms(index, terms)).count("LeftSemi") >= 2
    few = hits_of(index, queries)
    monkeypatch.setattr(fulltext, "SENT_TERMS", 1)
    assert "LeftSemi" not in plan(fulltext.match_all_terms(index, terms))
    assert hits_of(index, queries) == few != []


def test_an_index_write_leaves_no_shuffle_files(spark, data, tmp_path):
    docs, _ = data
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    seen, real = [], fulltext.document_frequencies
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(fulltext, "document_frequencies", lambda p: (seen.append(spark.conf.get(key)), real(p))[1])
        index = fulltext.build_index(docs)
        fulltext.write_index(index, str(tmp_path / "index"))
    assert seen[-1] == "true" and spark.conf.get(key, None) == before
    files = list((tmp_path / "index" / "postings").rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)


def test_candidates_are_cut_per_task(data, plan):
    docs, queries = data
    text = plan(fulltext.fulltext_candidates(fulltext.build_index(docs), docs, queries))
    assert "WindowGroupLimit" in text


def test_keyword_candidates(data):
    docs, queries = data
    got = {}
    hits = fulltext.keyword_candidates(fulltext.build_index(docs), queries)
    for r in hits.collect():
        got.setdefault(r["query_id"], []).append((r["rouge_score"] is None, -(r["rouge_score"] or 0), r["abstract_id"]))
    got = {q: [x[2] for x in sorted(rows)] for q, rows in got.items()}
    assert got == {i: brute_keyword(q) for i, q in QUERIES if brute_keyword(q)}
    # Also a document far from the best.
    assert brute_keyword("preglucose") == ["d40"]


def test_keywords_with_many_tied_scores(spark):
    rows = [(f"d{i:03d}", "tiedword" + ("s" if i % 3 else "") + f" word{i % 7}", [1.0, None, 0.5][i % 3]) for i in range(200)]
    docs = spark.createDataFrame(rows, "abstract_id string, summary string, rouge_score double")
    queries = spark.createDataFrame([(1, "tiedword"), (2, "tied word3")], "query_id int, query string")
    got = {}
    for r in fulltext.keyword_candidates(fulltext.build_index(docs), queries).collect():
        got.setdefault(r["query_id"], set()).add(r["abstract_id"])
    best = [r[0] for r in by_quality(rows)]
    assert got == {1: set(best[:16]), 2: set(best[:16])}
    with pytest.raises(ValueError):
        fulltext.keyword_candidates(fulltext.build_index(docs), queries, 17)


def expected_cascade():
    best = [r[0] for r in by_quality(ROWS)[:8]]
    out = {}
    for i, q in QUERIES:
        full = brute_full_text(q)
        stages = {d: 1 for d in full}
        if len(stages) < 4:
            for d in brute_keyword(q):
                stages.setdefault(d, 2)
        if len(stages) < 4:
            for d in best:
                stages.setdefault(d, 3)
        out[i] = stages
    return out


def test_cascade(data):
    docs, queries = data
    rows = retrieval.retrieval_cascade(docs, queries, fulltext.build_index(docs, stemmed=False)).collect()
    got = {}
    for r in rows:
        assert r["abstract_id"] not in got.setdefault(r["query_id"], {})
        got[r["query_id"]][r["abstract_id"]] = r["stage"]
    expected = expected_cascade()
    assert len(got[4]) == 16 and set(got[4]) <= set(expected[4])
    assert len(got[3]) == 4
    for i in got:
        if len(expected[i]) <= 16:
            assert got[i] == expected[i], i
    relevance = {r["stage"]: r["relevance"] for r in rows if r["stage"] > 1}
    assert relevance == {2: 0.1, 3: 0.05}


def test_rerank_puts_topic_first_then_quality(data):
    docs, queries = data
    rows = retrieval.retrieve(docs, queries).filter("query_id = 7").orderBy("rank").collect()
    labels = {r[0]: r[3] for r in ROWS}
    scores = {r[0]: r[2] for r in ROWS}
    assert len(rows) <= 8 and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    keys = [
        (labels[r["abstract_id"]] != "cancer_radiation_patients",
         scores[r["abstract_id"]] is None, -(scores[r["abstract_id"]] or 0), r["abstract_id"])
        for r in rows
    ]
    assert keys == sorted(keys)


def test_prompts(data):
    docs, queries = data
    rows = {r["query_id"]: r for r in retrieval.build_prompts(docs, queries).collect()}
    assert len(rows) == len(QUERIES)
    assert rows[9]["prompt"] is None and rows[9]["reply"] == "Please enter a query."
    assert rows[7]["topic_hint"] == "cancer_radiation_patients"
    assert rows[3]["sources"] == 4 and rows[3]["prompt"].count("[Topic: ") == 4
    assert rows[3]["prompt"].endswith(
        "answer this question:\nfourfold\n\nReference specific findings from the summaries."
    )
    assert rows[6]["sources"] == 8


def test_search(data):
    docs, queries = data
    got = {}
    hints = {}
    index = fulltext.build_index(docs, stemmed=False)
    for r in retrieval.search(docs, queries, index=index).orderBy("query_id", "rank").collect():
        hints[r["query_id"]] = r["topic_hint"]
        if r["abstract_id"] is not None:
            got.setdefault(r["query_id"], []).append(r)
    # Every query has its hint, also without hits.
    assert set(hints) == {i for i, _ in QUERIES}
    assert hints[1] == dict(TOPIC_KEYWORDS)["glucose"]
    expected = {i: min(5, len(brute_full_text(q))) for i, q in QUERIES if brute_full_text(q)}
    expected |= {i: 5 for i, q in QUERIES if not clean(q, 2)}
    assert {i: len(rows) for i, rows in got.items()} == expected
    # No word of three letters: best quality with relevance 0. Stop words only: nothing.
    assert [r["abstract_id"] for r in got[9]] == [r[0] for r in by_quality(ROWS)[:5]]
    assert {r["relevance"] for r in got[9]} == {0.0}
    assert 8 not in got and 6 not in got
    assert got[7][0]["topic_hint"] == dict(TOPIC_KEYWORDS)["cancer"]


def test_stemmed_cascade_finds_other_forms(spark, data):
    docs, _ = data
    queries = spark.createDataFrame([(1, "cancers")], "query_id int, query string")
    rows = retrieval.retrieval_cascade(docs, queries).collect()
    assert {r["stage"] for r in rows} == {1}


def test_no_unbounded_pair_join(data, plan):
    docs, queries = data
    for df in (
        fulltext.match_all_terms(fulltext.build_index(docs), fulltext.analyzed_terms(queries)),
        fulltext.keyword_candidates(fulltext.build_index(docs), queries),
        retrieval.search(docs, queries),
    ):
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_null_scores_sort_last(data):
    docs, _ = data
    order = [r["rouge_score"] for r in fulltext.quality_top(docs.select("abstract_id", "rouge_score"), 60).collect()]
    assert order[-1] is None and order[0] == max(x for x in order if x is not None)
    assert docs.filter(F.col("rouge_score").isNull()).count() == 1


def keyword_hits(index, queries):
    return sorted(map(tuple, fulltext.keyword_candidates(index, queries).collect()), key=str)


def test_merged_batches_give_the_same_hits(spark, data, tmp_path, monkeypatch):
    docs, queries = data
    monkeypatch.setattr(fulltext, "BUCKET_TOKENS", 50)
    path, whole = str(tmp_path / "index"), fulltext.build_index(docs)
    folders = lambda name: {p.name for p in (tmp_path / "index" / name).glob("batch=*")}
    for low, high in (("d00", "d03"), ("d03", "d20"), ("d20", "d40"), ("d40", "e")):
        part = docs.filter((F.col("abstract_id") >= low) & (F.col("abstract_id") < high))
        fulltext.write_index(fulltext.build_index(part), path)
    before = fulltext.read_index(spark, path)
    assert len(before.buckets) > 1 and before.buckets[0] == 1
    assert fulltext.merge_index(spark, path, fan=3) == 2
    after = fulltext.read_index(spark, path)
    assert after.buckets[-1] > before.buckets[-1]
    assert hits_of(before, queries) == hits_of(after, queries) == hits_of(whole, queries) != []
    assert keyword_hits(before, queries) == keyword_hits(after, queries) == keyword_hits(whole, queries) != []
    assert sorted(after.documents.collect()) == sorted(docs.select("abstract_id").collect())
    # Searches that began before the merge still find their batches; the next call deletes them.
    assert len(folders("postings")) == 5
    assert fulltext.merge_index(spark, path, fan=3) == 2
    assert all(len(folders(name)) == 2 for name in fulltext._STORED)
    assert hits_of(fulltext.read_index(spark, path), queries) == hits_of(whole, queries)


def test_batches_stay_few():
    batch = lambda i, n: Row(batch=i, n_docs=1, sum_len=float(n), buckets=1, stemmed=True, kept=16)
    live, rewritten, most = [], 0, 0
    for i in range(1000):
        live.append(batch(i, 100 + i % 7))
        while group := fulltext._alike(live, 8):
            rewritten += sum(r.sum_len for r in group)
            live = [r for r in live if r not in group] + [batch(f"{i}m", sum(r.sum_len for r in group))]
        most = max(most, len(live))
    assert most <= 7 * 4 and rewritten <= 4 * sum(100 + i % 7 for i in range(1000))


def test_keywords_meet_words_on_their_rarest_run(spark, plan, tmp_path):
    rows = [(f"d{i}", f"common{chr(97 + i % 26)}{chr(97 + i // 26)} {'uncommonly' if i == 5 else 'x'}", 0.5) for i in range(60)]
    docs = spark.createDataFrame(rows, "abstract_id string, summary string, rouge_score double")
    asked = [(1, "commonly"), (2, "common"), (3, "commonzz"), (4, "zzzz")]
    keywords = spark.createDataFrame(asked, "query_id int, keyword string")
    path = str(tmp_path / "index")
    for low in (True, False):
        part = docs.filter((F.col("abstract_id") < "d3") == F.lit(low))
        fulltext.write_index(fulltext.build_index(part), path)
    stored = fulltext.read_index(spark, path)
    found = fulltext.keyword_terms(stored, keywords)
    want = {(k, w) for _, k in asked for _, text, _ in rows for w in text.split() if k in w}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert set(map(tuple, fulltext.keyword_terms(fulltext.build_index(docs), keywords).collect())) == want
    assert "word_top" not in plan(found)


def test_words_meet_keywords_in_a_fixed_number_of_tasks(spark, plan):
    docs = spark.createDataFrame([("a", "nation station", 0.5)], "abstract_id string, summary string, rouge_score double")
    queries = spark.createDataFrame([(1, "tion")], "query_id int, query string")
    text = plan(fulltext.keyword_candidates(fulltext.build_index(docs, False), queries))
    assert "REPARTITION_BY_NUM" in text


def test_rows_per_document_do_not_carry_the_terms_of_a_set(spark):
    docs = spark.createDataFrame(
        [("a", "red green blue cat", 0.5), ("b", "red green dog", 0.4)], "abstract_id string, summary string, rouge_score double"
    )
    index = fulltext.build_index(docs, stemmed=False)
    asked = [(1, "red"), (1, "green"), (2, "green"), (2, "red"), (3, "cat"), (None, "blue"), (None, "red"), (4, "red"), (4, "cow")]
    terms = spark.createDataFrame(asked, "query_id int, term string")
    found = fulltext._asked_sets(index, terms)[1]
    assert "array" not in fulltext.rarest_term_hits(index, found).schema["set"].dataType.simpleString()
    got = fulltext.match_all_terms(index, terms).select("query_id", "abstract_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (None, "a")], key=str
    )
