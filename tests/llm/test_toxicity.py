import random

import numpy as np
import pyarrow as pa

from glosswork.llm import toxicity as t

LABELS = "doc_id bigint, toxic int, insult int"
PLAIN = "the cat sat on a mat and saw one bird near that green tree while rain fell over town".split()
RUDE = ["idiot", "moron", "trash", "scum"]


def corpus(rng, n, prefix="nichtsnutz"):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = [rng.choice(PLAIN) for _ in range(rng.randint(20, 200))]
        for _ in range(rng.randint(3, 8) * toxic):
            rude = rng.choice(RUDE) if i % 8 else prefix + rng.choice(("ig", "e", "er"))
            text.insert(rng.randrange(len(text)), rng.choice((rude, rude.upper() + "!", rude + ",")))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame([(i, x) for i, x in labels], "doc_id bigint, toxic int")


def test_held_out_accuracy(spark, docs):
    rows, labels = corpus(random.Random(1), 900)
    train = [x for x in labels if x[0] % 3]
    chain = t.fit(docs(rows), label_frame(spark, train))
    assert chain.names == ["insult", "contempt", "disgust", "toxic"]
    got = {r.doc_id: r for r in t.score(docs(rows), chain).collect()}
    held = [(i, x) for i, x in labels if i % 3 == 0]
    wrong = [i for i, x in held if got[i].rejected != bool(x)]
    assert len(wrong) <= 0.02 * len(held)
    kept = {r.doc_id for r in t.drop_toxic(docs(rows), chain).collect()}
    assert kept == {i for i, r in got.items() if not r.rejected}


def test_edge_cases(spark, docs):
    rows, labels = corpus(random.Random(2), 200)
    odd = [(900, None), (901, ""), (902, "?!"), (None, "idiot moron trash scum idiot"), (3, rows[3][1]), (3, rows[3][1])]
    labels += [(None, 1), (901, None), (902, 0), (902, 1), (5000, 1)]
    frame = label_frame(spark, labels)
    chain = t.fit(docs(rows), frame)
    got = t.score(docs(odd), chain).collect()
    assert len(got) == 6 and all(0 <= r.toxic <= 1 for r in got)
    assert len({round(r.toxic, 12) for r in got if r.doc_id in (900, 901, 902)}) == 1
    assert t.score(docs([]), chain).count() == 0 and t.drop_toxic(docs([]), chain).count() == 0
    again = t.fit(docs(rows), frame)
    assert all(np.allclose(a, b) for a, b in zip(chain.weights, again.weights, strict=True))


def test_no_or_one_sided_labels(spark, docs):
    rows, _ = corpus(random.Random(3), 40)
    none = t.fit(docs(rows), label_frame(spark, []))
    assert all(r.toxic < 0.51 for r in t.score(docs(rows), none).collect())
    clean = t.fit(docs(rows), label_frame(spark, [(i, 0) for i in range(40)]))
    assert not any(r.rejected for r in t.score(docs(rows), clean).collect())


def test_given_category_columns_and_bound(spark, docs):
    rows, labels = corpus(random.Random(4), 300)
    frame = spark.createDataFrame([(i, x, x) for i, x in labels], LABELS)
    chain = t.fit(docs(rows), frame, categories={"insult": ("idiot",)}, max_rows=120)
    assert chain.names == ["insult", "toxic"]
    got = {r.doc_id: r for r in t.score(docs(rows), chain).collect()}
    assert sum((got[i].insult >= 0.5) != bool(x) for i, x in labels) <= 0.05 * len(labels)


def test_earlier_probabilities_are_out_of_fold():
    """A feature that only memorises rows must not reach later models as truth."""
    rng = np.random.default_rng(0)
    n = 200
    x = np.eye(n)
    first, second = rng.integers(0, 2, n).astype(float), rng.integers(0, 2, n).astype(float)
    second = first  # a leak would give the chained probability a large weight
    weights = t.fit_chain(x, np.column_stack([first, second]), np.arange(n) % t.FOLDS)
    assert abs(weights[1][n]) < 3


def test_features_count_words_and_beginnings():
    digests = np.unique(np.array([t.w.digest_of("idiot"), t.w.digest_of("achlic") ^ int(t._BEGINS)], np.uint64))
    x = np.vstack(list(t.features(pa.array(["Idiot! idiot, x achlich ACHLICHE achli", None]), digests)))
    assert sorted(np.round(np.expm1(x[0, :2])).tolist()) == [2, 2] and not x[1].any()
