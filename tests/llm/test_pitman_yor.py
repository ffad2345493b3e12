import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from glosswork.llm import pitman_yor as py


def remainder():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7


def tokens(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def corpus(rng, n):
    """Words follow each other: a model of contexts beats single words."""
    follow = {i: [rng.randrange(60) for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(n):
        at, words = rng.randrange(60), []
        for _ in range(rng.randint(0, 120)):
            words.append(f"W{at}" if rng.random() < 0.2 else f"w{at}")
            at = rng.choice(follow[at])
        rows.append((i, " ".join(words)))
    return rows


def base(rows):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = collections.Counter(x for i, t in rows if not held[i] for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, t in rows:
        own = tokens(t)
        score = sum(math.log10((counts[x] + 1) / (n + 1 * (v + 1))) for x in own)
        out[i] = (held[i], len(own), sum(counts[x] > 0 for x in own), n, pytest.approx(score, rel=1e-9))
    return out


def test_counts_base_and_held_out_gain(docs):
    rows = corpus(random.Random(3), 300) + [(900, None), (901, ""), (902, "unseen words here"), (903, "the " * 9000)]
    got = py.score(docs(rows), remainder() == 2).collect()
    assert {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == base(rows)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(held) > 20 and sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_null_and_repeated_ids(docs):
    rows = corpus(random.Random(4), 30)
    odd = [*rows, rows[5], rows[5], (None, "w1 w2")]
    got = py.score(docs(odd), remainder() == 2).collect()
    assert len(got) == len(odd)
    same = {(r.n_tokens, round(r.score, 9)) for r in got if r.doc_id == rows[5][0]}
    assert len(same) == 1 and same.pop()[0] == len(tokens(rows[5][1]))
    assert [r.n_tokens for r in got if r.doc_id is None] == [3]


def test_empty_and_nothing_to_learn_from(docs):
    assert py.score(docs([]), F.lit(False)).count() == 0
    r = py.score(docs([(1, "a b")]), F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def sampled(seed=0):
    rng = np.random.default_rng(seed)
    pair = np.unique(rng.integers(0, 40, 600) * py.FINE + rng.integers(0, py.FINE, 600))
    count = rng.geometric(0.4, len(pair)).astype(np.int64)
    totals = py.first_totals(pair, count)
    return pair, count, totals


def test_probabilities_add_up_to_one():
    pair, count, totals = sampled()
    vocabulary = len(np.unique(pair // py.FINE))
    states = list(py.sample(0, pair, count, totals, 1, 2))
    for state in states:
        own = py.totals_of(pair, count, state[0], *state[1:4], *state[5:])
        own[py.ONCE :] = totals[py.ONCE :]
        predict = py.Predictor(40 + 1, pair, count, state, own)  # the last word was never seen
        words = [*np.unique(pair // py.FINE), 40]
        for cls in (0, 7, 500, 1023):
            word = np.array(words)
            p = predict(word, np.full(len(word), cls), py._places(pair, word, np.full(len(word), cls)))
            assert len(words) == vocabulary + 1 and p.min() > 0 and p.sum() == pytest.approx(1)


def test_seating_keeps_every_customer():
    rng = np.random.default_rng(1)
    customers = np.concatenate([rng.geometric(0.3, 500), [5000, 20000, 1]])
    fresh = rng.random(len(customers)) * 3
    seats = py.Seating(customers, 0.5, fresh, rng)
    for _ in range(30):
        assert (np.bincount(seats.owner, seats.size, len(customers)) == customers).all()
        assert seats.size.min() > 0 and (np.diff(seats.owner) >= 0).all()
        assert (seats.tables() <= customers).all() and seats.tables().min() >= 1
        seats.move(fresh)


def test_moves_reach_the_distribution_of_the_restaurant():
    """Three customers of one word: the number of tables has a known law."""
    d, fresh, n = 0.4, 0.7, 4000
    weight = collections.Counter()
    for second in (0, 1):
        for third in (0, 1):
            t, p = 1, 1.0
            for seated, opens in ((1, second), (2, third)):
                p *= fresh if opens else seated - d * t
                t += opens
            weight[t] += p
    total = sum(weight.values())
    seats = py.Seating(np.full(n, 3), d, np.full(n, fresh), np.random.default_rng(2))
    for _ in range(60):
        seats.move(np.full(n, fresh))
    share = collections.Counter(seats.tables().tolist())
    for t in (1, 2, 3):
        assert share[t] / n == pytest.approx(weight[t] / total, abs=0.03)


def test_pack():
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.uint16), np.array([True, False])]
    for a, b in zip(arrays, py.unpack(py.pack(*arrays), np.uint64, np.uint16, np.bool_), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()


def test_tokens_before_have_restaurants_of_their_own(docs):
    """Two words whose digests share the first ten bits are told apart."""
    from glosswork.llm import words

    first = lambda x: int(words.mix(np.array([words.digest_of(x)], np.uint64))[0]) >> 54
    names = {}
    for i in range(200):
        if (a := names.setdefault(first(f"a{i}"), f"a{i}")) != f"a{i}":
            b = f"a{i}"
            break
    rows = [(i, f"{a} x" if i % 2 else f"{b} y") for i in range(200)]
    rows += [(1000, f"{a} x"), (1001, f"{a} y"), (1002, f"{b} x"), (1003, f"{b} y")]
    got = {r.doc_id: r.score for r in py.score(docs(rows), F.col("doc_id") >= 1000).collect()}
    assert got[1000] > got[1001] + 1 and got[1003] > got[1002] + 1


def test_frequent_words_are_scored_alike_on_every_way(docs, monkeypatch):
    """Words counted apart, by the token before, or with all their tokens have about the same probabilities."""
    rows = corpus(random.Random(5), 400)
    by_way = []
    for hot in (512, 40, 2):
        monkeypatch.setattr(py, "HOT", hot)
        got = py.score(docs(rows), remainder() == 2).collect()
        by_way.append((len(py.hot_words(docs(rows).selectExpr("doc_id AS id", "text", "false AS held"))), sum(r.score for r in got)))
        assert {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == base(rows)
    assert by_way[0][0] > by_way[1][0] > by_way[2][0] == 2
    assert all(score == pytest.approx(by_way[0][1], rel=0.01) for _, score in by_way)


def test_memory_of_a_run_of_documents():
    """Runs are short, and the arrays they are made of are gone when a run is handed on."""
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["ab cde f " * 10_000] * 200)  # 18 MB
    list(py.runs(texts.slice(0, 1)))
    tracemalloc.start()
    n = most = 0
    for _, rows, token, before, doc in py.runs(texts):
        n += rows
        most = max(most, len(token))
        held = tracemalloc.get_traced_memory()[0]
        assert held < 1.5 * (token.nbytes + before.nbytes + doc.nbytes)
        del token, before, doc
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 200 and most < 3_500_000
    assert peak < 150e6
