import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from glosswork.llm import collocations as c
from glosswork.llm import words as w


def pieces(text):
    low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
    return [[x for x in re.split("[ \t]+", p) if x] for p in re.split("[.,;:!?\n-\r]", low)]


def brute(rows, min_count=30, top=2000):
    out = []
    rows = [(text, "und" if lang is None else lang) for text, lang in rows]
    for lang in {r[1] for r in rows}:
        f = Counter()
        for text, own in rows:
            if own == lang:
                for p in pieces(text):
                    f.update(tuple(p[i : i + k]) for k in range(1, 5) for i in range(len(p) - k + 1))
        chosen = {g: a for g, a in f.items() if len(g) > 1 and a >= min_count}
        n = sum(a for g, a in f.items() if len(g) == 1)
        inside = Counter()
        for g, a in chosen.items():
            for i in range(len(g)):
                for j in range(i + 2, len(g) + 1):
                    if j - i < len(g):
                        inside[g[i:j]] = max(inside[g[i:j]], a)
        ranked = []
        for g, a in chosen.items():
            if inside[g] and 100 * inside[g] >= 80 * a:
                continue
            cut = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            ranked.append((-cut[0], -a, " ".join(g).encode(), f[g[: cut[1]]], f[g[cut[1] :]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, w1 string, n int")


def made(seed, texts, vocabulary):
    rng = random.Random(seed)
    names = [f"{a}{b}" for a in "abcdeÄß" for b in "xyzé"][:vocabulary]
    rows = []
    for i in range(texts):
        n = rng.choice([0, 1, 3, 40, 200])
        text = "".join(rng.choice(names) + rng.choice([" ", " ", "\t ", ", ", ".", "\n", "! "]) for _ in range(n))
        rows.append((text.upper() if i % 5 == 0 else text, rng.choice(["en", "de", None, "und", "e n+%\n\\", ""])))
    return rows + [(None, "en"), ("", None), (" . ,", "de"), ("only", "xx")] + rows[:20]


@pytest.mark.parametrize("seed,vocabulary,least", [(1, 6, 30), (2, 24, 5), (3, 3, 30)])
def test_as_brute_force(spark, seed, vocabulary, least):
    rows = made(seed, 120, vocabulary)
    got = sorted(tuple(r) for r in c.collocations(table(spark, rows), min_count=least, top=50).collect())
    assert got == brute(rows, least, 50)
    assert got


def test_slices_do_not_change_counts(spark, monkeypatch):
    rows = made(4, 60, 5) + [("ax bx " * 3000 + ". " + "cy " * 500, "en")]
    texts = pa.array([r[0] for r in rows])
    data, offsets = w.buffers(texts)
    monkeypatch.setattr(c, "SLICE_BYTES", 100)
    cuts = list(c._slices(data, offsets))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:], strict=False))
    ends = {int(x) for x in offsets}
    assert all(b in ends or c._CLASS[data[b - 1]] == c._END for _, b in cuts)
    number = c.np.zeros(len(rows), c.np.int64)
    total = Counter()
    for start, end in cuts:
        low, high = c.np.searchsorted(offsets[1:], [start, end], side="right")
        found = c._count(data[start:end], c.np.minimum(offsets[1 + low : 2 + high], end) - start, number[low : high + 1])
        if found:
            known, columns, counts = found
            for *places, n in zip(*columns[1:], counts, strict=True):
                total[tuple(known[int(p)].as_py() for p in places)] += int(n)
    want = Counter()
    for text, _ in rows:
        for p in pieces(text):
            want.update(tuple((p + [""] * 3)[i : i + 4]) for i in range(len(p)))
    assert total == want


def test_hot_pairs_stream_and_keep_their_counts(spark):
    """One pair starts most windows; tasks hold few rows of it and counts stay exact."""
    rng = random.Random(9)
    rows = [(" ".join(f"hot pair v{rng.randrange(40)} u{rng.randrange(400)}." for _ in range(50)), "en") for _ in range(60)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = sorted(tuple(r) for r in c.collocations(table(spark, rows), min_count=12).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == brute(rows, 12)


def test_hot_words_are_those_of_a_sample(spark, monkeypatch):
    monkeypatch.setattr(c, "SAMPLE", 0.999)
    monkeypatch.setattr(c, "HOT", 10)
    rows = [("the x%d y%d. the z%d" % (i, i, i), "en") for i in range(300)]
    assert sorted(c.hot_words(table(spark, rows))) == ["the"]
    rows += made(5, 40, 9)
    assert sorted(tuple(r) for r in c.collocations(table(spark, rows), min_count=9).collect()) == brute(rows, 9)
    keys = c.windows(table(spark, rows), hot=["the"]).selectExpr("split(key, '[\\n ]') AS w", "part").collect()
    assert len({r.part for r in keys if r.w[1] == "the"}) > 500
    parts = {(*r.w[:2], r.part) for r in keys if r.w[1] != "the"}
    assert len(parts) == len({p[:2] for p in parts})


def test_arithmetic_passes_64_bits_and_long_texts(spark):
    from pyspark.sql import functions as F

    a = 5 * 10**12
    text = "aa bb " * 200_000 + "."
    got = c.collocations(table(spark, [(text, "en")])).collect()
    assert [(r.phrase, r.a) for r in got] == [(p, n) for _, _, p, n, *_ in brute([(text, "en")])]
    whole = spark.range(1).select(
        F.expr(f"CAST(2000000 AS DECIMAL(18,0)) * CAST({a}L * 4000 AS DECIMAL(20,0)) DIV (CAST({a}L AS DECIMAL(20,0)) + {a}L)").alias("s")
    )
    assert whole.first().s == 2_000_000 * a * 4000 // (2 * a)


def test_empty_table(spark):
    out = c.collocations(table(spark, []))
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.count() == 0
