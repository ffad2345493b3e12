import hashlib
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from glosswork.llm import bpe


@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.read_ranks(spark, P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(9)
    odd = [
        None, "", " ", "\n\n  x", "it's we'LL 12345 ½ ①", "naïve Straße 你好 \U0001f600\U0001f468‍\U0001f469", "\x00\x1c\x85  a",
        "<|endoftext|>", "\t\ttab \r\n end  ", "a" * 5000, "ab" * 3000 + "é" * 700, "́̀x", "ſK", "​ 　 x",
    ]
    for _ in range(30):
        odd.append("".join(chr(rng.choice((rng.randrange(32, 127), rng.randrange(160, 0x2000)))) for _ in range(60)))
    return odd


def test_ids_and_bytes_match_the_library(docs, ranks, library):
    rows = list(enumerate(texts())) + [(3, "again"), (None, "x y z")]
    encoded = bpe.encode(docs(rows), ranks, P.PATTERN)
    got = encoded.withColumn("back", bpe.decode(F.col("ids"), ranks)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), tuple(r.ids), bytes(r.back)) for r in got) == want


def test_digests(docs, ranks, library):
    rows = list(enumerate(texts()))
    for r in bpe.digests(bpe.encode(docs(rows), ranks, P.PATTERN), ranks).collect():
        text = rows[r.doc_id][1] or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_folded_merges_match_the_library(spark, ranks, library):
    words = sorted({x for t in texts() if t and len(t) < 200 for x in regex.findall(P.PATTERN, t)})
    frame = spark.createDataFrame([(x,) for x in [*words, *words[:5], "", None]], "word string")
    folded = bpe.fold_words(frame, bpe.RankMap(ranks))
    got = {r.word: list(r.ids) for r in folded.collect()}
    assert got == {x: library.encode_ordinary(x) for x in words}


def test_long_words_use_the_same_merges(ranks, library):
    rng = random.Random(1)
    for n in (65, 100, 400, 2000):
        data = bytes(rng.choice(b"abcdeth ") for _ in range(n)).replace(b" ", b"t")
        assert bpe._merge_long(data, ranks) == library._encode_single_piece(data)
        short = data[:60]
        assert bpe.merge_bytes(short, ranks) == bpe._merge_long(short, ranks) == library._encode_single_piece(short)


def test_table_of_frequent_words_does_not_change_the_result(docs, ranks, monkeypatch):
    rows = [(i, "the cat and the hat unfrequentable" * (i % 3 + 1)) for i in range(9)]
    with_table = sorted(map(str, bpe.encode(docs(rows), ranks, P.PATTERN).collect()))
    monkeypatch.setattr(bpe, "frequent_words", lambda *a: {})
    assert sorted(map(str, bpe.encode(docs(rows), ranks, P.PATTERN).collect())) == with_table


def test_empty(docs, ranks):
    assert bpe.digests(bpe.encode(docs([]), ranks, P.PATTERN), ranks).count() == 0
