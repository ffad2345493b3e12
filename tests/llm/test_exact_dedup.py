import hashlib

from glosswork.llm.exact_dedup import drop_copies, exact_groups

ROWS = [(5, "a"), (3, "a"), (9, "a"), (4, None), (1, ""), (2, "b "), (2, "b "), (7, "b"), (None, "a"), (None, "z")]


def brute(rows, pick):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        keep = pick(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups(docs):
    for keep, pick in (("smallest", min), ("largest", max)):
        got = [tuple(r) for r in exact_groups(docs(ROWS), keep=keep).collect()]
        assert sorted(got, key=str) == brute(ROWS, pick)


def test_clashing_columns_and_empty(spark, docs):
    frame = spark.createDataFrame(
        [(1, "x", "k"), (2, "x", "l")], "doc_id bigint, text string, keep_id string"
    ).selectExpr("*", "'h' AS hash", "1 AS id", "2 AS group_size")
    assert [r.keep_id for r in exact_groups(frame).collect()] == [1, 1]
    assert drop_copies(frame).columns == frame.columns
    assert [tuple(r) for r in drop_copies(frame).collect()] == [(1, "x", "k", "h", 1, 2)]
    assert exact_groups(docs([])).count() == 0 and drop_copies(docs([])).count() == 0


def test_drop_copies_keeps_one_row_per_text(docs):
    got = sorted(((r.doc_id, r.text) for r in drop_copies(docs(ROWS)).collect()), key=str)
    assert got == sorted([(3, "a"), (1, ""), (2, "b "), (7, "b"), (None, "z")], key=str)
    got = sorted(((r.doc_id, r.text) for r in drop_copies(docs(ROWS), keep="largest").collect()), key=str)
    assert got == sorted([(9, "a"), (4, None), (2, "b "), (7, "b"), (None, "z")], key=str)


def test_equal_hashes_with_different_bytes_stay_apart(docs, monkeypatch):
    from pyspark.sql import functions as F

    from glosswork.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "content_hash", lambda text: F.length(text))
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_groups(docs([(1, "ab"), (2, "cd"), (3, "ab")])).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2)}
