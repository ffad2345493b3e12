import random

import pytest
from pyspark.sql import functions as F

from glosswork.fixed_values import TOPIC_KEYWORDS
from glosswork.functions import text as tx, vectors as vec
from glosswork.functions.rouge import lcs_length, rouge_l, rouge_l_f
from glosswork.functions.stemming import stem, stem_terms


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "word, expected",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("agreed", "agre"),
        ("plastered", "plaster"), ("sing", "sing"), ("conflated", "conflat"), ("hopping", "hop"),
        ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"),
        ("relational", "relat"), ("rational", "ration"), ("vietnamization", "vietnam"),
        ("triplicate", "triplic"), ("adoption", "adopt"), ("controll", "control"),
        ("generalizations", "gener"), ("oscillators", "oscil"), ("patients", "patient"),
    ],
)
def test_stem(word, expected):
    assert stem(word) == expected


def test_stem_column(spark):
    words = spark.createDataFrame([(["ponies", "cats"],), ([],), (None,)], "w array<string>")
    rows = [r[0] for r in words.select(stem_terms(F.col("w"))).collect()]
    assert rows == [["poni", "cat"], [], None]


def test_lcs_known_pairs():
    assert lcs_length("ABCBDAB", "BDCABA") == 4
    assert lcs_length("abc", "") == 0
    assert rouge_l_f("the same text", "the same text") == 1.0
    assert rouge_l_f("left side", "other words") == 0.0


def test_lcs_against_table():
    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rng = random.Random(1)
    for _ in range(300):
        a = rng.choices("abcd", k=rng.randint(0, 90))
        b = rng.choices("abcd", k=rng.randint(0, 90))
        assert lcs_length(a, b) == table(a, b)


def test_rouge_column(spark):
    pairs = spark.createDataFrame(
        [("running dogs bark", "run dog"), (None, "x"), ("", "")], "a string, b string"
    )
    rows = [r[0] for r in pairs.select(rouge_l(F.col("a"), F.col("b"))).collect()]
    # Only words of more than three letters are stemmed: dogs -> dog, running -> run.
    assert rows[0] == pytest.approx(0.8)
    assert rows[1:] == [0.0, 0.0]


@pytest.mark.parametrize(
    "query, terms",
    [
        ("x-ray of Heart!", ["xray", "heart"]),
        ("50%_a  cancer", ["50a", "cancer"]),
        ("café très bon", ["caf", "trs", "bon"]),
        ("one\ttwo\x0bthree four five", ["one", "two", "three", "four", "five"]),
        ("a an of", []),
        ("", []),
    ],
)
def test_query_terms(spark, query, terms):
    assert one(spark, query, tx.query_terms) == terms


def test_fallback_keywords(spark):
    assert one(spark, "The lung Xray, now", tx.fallback_keywords) == ["lung", "xray"]


@pytest.mark.parametrize(
    "query, label",
    [
        ("pressure of the lung", "patients_pressure_angina"),
        ("plunge", "pulmonary_training_chest"),
        ("CANCER", "cancer_radiation_patients"),
        ("nothing here", None),
        ("blood GLUCOSE", "glucose_cholesterol_blood glucose"),
    ],
)
def test_detect_topic(spark, query, label):
    assert one(spark, query, tx.detect_topic) == label


def test_topic_map_size():
    assert len(TOPIC_KEYWORDS) == 30
    assert len({label for _, label in TOPIC_KEYWORDS}) == 12


@pytest.mark.parametrize("query, blank", [(" \t\n", True), (" ", True), (None, True), (" a", False)])
def test_blank(spark, query, blank):
    assert one(spark, query, tx.is_blank) is blank


def test_segments(spark):
    long = " ".join(f"w{i}" for i in range(100))
    assert one(spark, "One two. Three!\nFour", tx.segments) == ["One two.", "Three!", "Four"]
    assert [len(s.split()) for s in one(spark, long, tx.segments)] == [40, 40, 20]
    assert one(spark, "...", tx.segments) == []


def test_uni_and_bigrams(spark):
    assert one(spark, ["a", "b", "c"], tx.uni_and_bigrams, "array<string>") == [
        "a", "b", "c", "a b", "b c",
    ]
    assert one(spark, ["a"], tx.uni_and_bigrams, "array<string>") == ["a"]
    assert one(spark, [], tx.uni_and_bigrams, "array<string>") == []


def test_keyword_filter(spark):
    df = spark.createDataFrame([("A Lungful",), ("heart",), ("none",)], "t string")
    assert df.filter(tx.keyword_filter(F.col("t"), ["lung", "heart"])).count() == 2
    assert df.filter(tx.keyword_filter(F.col("t"), [])).count() == 0


def test_all_terms_filter(spark):
    df = spark.createDataFrame([("A lung, the heart",), ("lungs heart",), ("heart lung x",)], "t string")
    assert df.filter(tx.all_terms_filter(F.col("t"), "Lung! of the Heart lung")).count() == 2
    assert df.filter(tx.all_terms_filter(F.col("t"), "of the")).count() == 0


def test_context_line(spark):
    df = spark.createDataFrame([("", 0.12345, "text"), (None, 1.0, "x")], "l string, r double, s string")
    rows = [r[0] for r in df.select(tx.context_line(F.col("l"), F.col("r"), F.col("s"))).collect()]
    assert rows == ["[Topic: general | ROUGE-L: 0.123]\ntext", "[Topic: general | ROUGE-L: 1.0]\nx"]


def test_rounding(spark):
    df = spark.createDataFrame([(0.0125, 2.5)], "a double, b double")
    assert tuple(df.select(F.round("a", 3), F.round("b", 0)).first()) == (0.013, 3.0)


def test_topic_label_and_score(spark):
    df = spark.createDataFrame(
        [(-1, ["a"]), (3, ["x", "y z"]), (4, None), (5, [])], "id int, w array<string>"
    )
    rows = [r[0] for r in df.select(tx.topic_label(F.col("id"), F.col("w"))).collect()]
    assert rows == ["outlier", "x_y z", "topic_4", "topic_5"]
    assert one(spark, [0.1, 0.77777], tx.topic_score, "array<double>") == 0.7778


def test_vectors(spark):
    assert one(spark, [3.0, 4.0], vec.l2_normalize, "array<float>") == [0.6, 0.8]
    assert one(spark, [0.0, 0.0], vec.l2_normalize, "array<float>") == [0.0, 0.0]
    back = one(spark, [1e-5, -0.25], lambda v: vec.text_to_vector(vec.vector_to_text(v)), "array<float>")
    assert back == pytest.approx([1e-5, -0.25])
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0])], "a array<float>, b array<float>")
    assert df.select(vec.inner_product(F.col("a"), F.col("b"))).first()[0] == 11.0
