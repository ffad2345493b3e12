"""ROUGE-L F-measure (Lin 2004) as an Arrow-batched column function."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from glosswork.functions.stemming import stem
from glosswork.functions.text import TOKEN

_TOKEN = re.compile(TOKEN)
STEM_LONGER_THAN = 3


def lcs_length(a: Sequence[str], b: Sequence[str]) -> int:
    """Longest common subsequence; one bit per word of ``b`` (Hyyro 2004)."""
    places: dict[str, int] = {}
    for i, word in enumerate(b):
        places[word] = places.get(word, 0) | (1 << i)
    full = (1 << len(b)) - 1
    row = full
    for word in a:
        match = places.get(word, 0)
        if match:
            common = row & match
            row = ((row + common) | (row - common)) & full
    return len(b) - row.bit_count()


def rouge_words(text: str | None, stemmed: bool) -> list[str]:
    words = _TOKEN.findall(text.lower()) if text else []
    if stemmed:
        words = [stem(w) if len(w) > STEM_LONGER_THAN else w for w in words]
    return words


def rouge_l_f(target: str | None, summary: str | None, stemmed: bool = True) -> float:
    a, b = rouge_words(target, stemmed), rouge_words(summary, stemmed)
    if not a or not b:
        return 0.0
    return 2.0 * lcs_length(a, b) / (len(a) + len(b))


def rouge_l(target: Column, summary: Column, stemmed: bool = True) -> Column:
    """Score column; NULL text counts as empty text and scores 0.

    Marked nondeterministic so that a filter on the score is not moved below
    the projection, which would run the scorer twice.
    """

    @F.pandas_udf(T.FloatType())
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for targets, summaries in batches:
            yield pd.Series(
                [rouge_l_f(t, s, stemmed) for t, s in zip(targets, summaries)], dtype="float32"
            )

    return score.asNondeterministic()(target, summary)
