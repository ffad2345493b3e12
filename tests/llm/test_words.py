import re

import numpy as np
import pyarrow as pa
from hypothesis import given, strategies as st

from glosswork.llm import words as w


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé ß\t\n\x0b\xa0Z."))))
def test_words_match_the_pattern(texts):
    found = [[] for _ in texts]
    for row, data, offsets in w.chunks(pa.array(texts, pa.string()), size=8):
        starts, ends, doc = w.find(data, offsets)
        for s, e, d, h in zip(starts, ends, doc, w.digests(data, starts, ends), strict=True):
            word = lower(data[s:e].tobytes().decode())
            assert int(h) == w.digest_of(word)
            found[row + d].append(word)
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")) for t in texts]


def test_digests_differ():
    words = [f"w{i}" for i in range(20000)] + ["a" * n for n in range(1, 300)]
    assert len({w.digest_of(x) for x in words}) == len(words)


def test_long_texts_exceed_a_chunk():
    texts = pa.array(["x " * 1_000_000, None, "", "y"])
    counts = np.zeros(4, int)
    for row, data, offsets in w.chunks(texts):
        _, _, doc = w.find(data, offsets)
        counts[row : row + len(offsets) - 1] += np.bincount(doc, minlength=len(offsets) - 1)
    assert counts.tolist() == [1_000_000, 0, 0, 1]
