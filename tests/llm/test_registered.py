"""The registered queries and the pipeline over a small table, against brute force."""

import hashlib
import os
import random
import re

import duckdb
import pytest

import corpus_pipeline
from glosswork.llm import registered
from glosswork.session import stage

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
RUDE = ["idiot", "moron", "trash", "scum", "loser"]


def prose(rng, n):
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ren", "tu"]) for _ in range(rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with every planted case, and what should become of each."""
    root, rng = str(tmp_path_factory.mktemp("tables")), random.Random(21)
    items = [(i, prose(rng, 30)) for i in range(6)]
    rows, labels, fate = [], [], {}

    def add(text, what):
        i = len(rows)
        rows.append((i, text, "en", f"src{i % 3}", None if text is None else len(text)))
        fate[i] = what
        return i

    for _ in range(120):
        labels.append((add(prose(rng, rng.randint(30, 200)), "kept"), 1, 0))
    for _ in range(60):
        words = prose(rng, 60).split()
        for _ in range(5):
            words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        labels.append((add(" ".join(words), "toxic"), 0, 1))
    for i in range(0, 40):
        add(rows[i][1], "copy")
    for i in range(40, 70):
        words = rows[i][1].split()
        words[len(words) // 2] = "changed"
        near = len(words) >= 60  # one word touches five shingles of a side
        add(" ".join(words), "near" if near else "open")
    for k, (_, text) in enumerate(items):
        add(prose(rng, 40) + " " + text.upper() + " " + prose(rng, 20), "leak")
        add(prose(rng, 40) + " " + text.replace("a", "b", 2) + " " + prose(rng, k), "leak")
    add(None, "empty"), add("", "copy of empty")
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    turns = [(c, t, "assistant" if t % 2 else "user", prose(rng, 5) if t != 3 else None) for c in range(9) for t in range(4)]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(
        f"{root}/conversations.parquet"
    )
    html = [prose(rng, 30) for _ in range(4)]
    pages = [(p, f"http://x/{p}", html[p % 4] if p % 5 else None) for p in range(30)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{root}/pages.parquet")
    vectors = [(v, [rng.gauss(v % 5, 1) for _ in range(63 if v == 9 else 64)], v % 5) for v in range(60)]
    spark.createDataFrame(vectors + [(60, None, 0)], "vec_id bigint, embedding array<float>, label int").write.parquet(
        f"{root}/embeddings.parquet"
    )
    return root, rows, fate


def test_stages_do_their_work_and_keep_the_rest(spark, folder):
    root, rows, fate = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    names, kept = docs.columns, [{r[0] for r in rows}]
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, root), name)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "byte_bpe":
            assert docs.columns == names
    of = lambda what: {i for i, x in fate.items() if x == what}
    toxic, exact, near, leak, last = (kept[k] - kept[k + 1] for k in range(5))
    assert toxic == of("toxic")
    assert exact == of("copy") | of("copy of empty")
    assert of("near") <= near <= of("near") | of("open")
    assert leak == of("leak") and last == set()
    assert of("kept") <= kept[-1]
    texts = {r[0]: r[1] or "" for r in rows}
    for r in docs.collect():
        assert r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_applies_all_stages(spark, folder):
    root, _, fate = folder
    got = {r.doc_id for r in corpus_pipeline.run(spark, root).collect()}
    assert {i for i, x in fate.items() if x == "kept"} <= got
    assert not got & {i for i, x in fate.items() if x in ("toxic", "copy", "near", "leak")}


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([str(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_queries_match_their_sql(spark, folder, name):
    root = folder[0]
    frame = registered.queries()[name](spark, root)
    con = duckdb.connect()
    for table in os.listdir(root):
        con.execute(f"CREATE VIEW {table.split('.')[0]} AS SELECT * FROM '{root}/{table}/*.parquet'")
    found = con.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert comparable(frame.columns, frame.collect()) == comparable(columns, found.fetchall())


def test_every_query_returns_its_rows(spark, folder):
    root, rows, fate = folder
    got = {n: f(spark, root).collect() for n, f in registered.queries().items()}
    ids = sorted(r[0] for r in rows)
    for name in ("op1_toxicity", "op3_near_dedup", "op4_lm_scoring", "op5_byte_bpe", "op6_exact_dedup", "op7_secret_scans", "op12_external_shuffle"):
        assert sorted(r.doc_id for r in got[name]) == ids, name
    assert {r.doc_id for r in got["op10_decontamination"]} == {i for i, x in fate.items() if x == "leak"}
    assert {r.doc_id for r in got["op1_toxicity"] if r.rejected} == {i for i, x in fate.items() if x == "toxic"}
    assert got["op2_license_scans"] == []
    for n in got:
        assert re.match(r"op\d+_", n)
