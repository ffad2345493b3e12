"""Summaries: extractive by default, a caller's model as a plug-in."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from glosswork.fixed_values import STOP_WORDS, SUMMARY_MAX_WORDS
from glosswork.functions.text import TOKEN, segments, tokens

_TOKEN = re.compile(TOKEN)


def _weights(parts: Sequence[str]) -> list[dict[str, int]]:
    """Of each lower-case segment of a text: its words, and their summed counts in the text."""
    words = [_TOKEN.findall(part) for part in parts]
    counts = Counter(chain.from_iterable(words))
    for stop in STOP_WORDS:
        counts.pop(stop, None)
    return [{"weight": sum(counts[w] for w in ws), "words": len(ws)} for ws in words]


def score_segments(parts: Column) -> Column:
    """Per segment: mean in-document frequency of its words, stop words as 0.

    The weights (Luhn 1958) need no corpus statistics: a text is weighed by
    itself where it is read, and no word of it becomes a row. Marked
    nondeterministic so that the weights are not taken again for each use.
    """

    @F.pandas_udf("array<struct<weight: bigint, words: int>>")
    def weights(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_weights(p) if p is not None else None for p in batch], dtype="object")

    weighed = F.transform(
        weights.asNondeterministic()(F.transform(parts, F.lower)),
        lambda s, i: F.struct(
            (-(s["weight"].cast("double") / s["words"])).alias("order"), i.alias("pos"), s["words"].alias("words")
        ),
    )
    return F.filter(weighed, lambda s: s["words"] > 0)


def _fill(ranked: Column, budget: int) -> Column:
    """Positions of the best segments that together fit the word budget."""
    start = F.struct(
        F.lit(0).alias("words"), F.array().cast("array<int>").alias("picks")
    )

    def add(acc: Column, s: Column) -> Column:
        total = acc["words"] + s["words"]
        taken = F.struct(
            total.alias("words"), F.concat(acc["picks"], F.array(s["pos"])).alias("picks")
        )
        return F.when(total <= budget, taken).otherwise(acc)

    return F.aggregate(ranked, start, add, lambda acc: acc["picks"])


def extractive_summary(docs: DataFrame, max_words: int = SUMMARY_MAX_WORDS) -> DataFrame:
    """Add ``summary``: best segments in text order, at most ``max_words`` words.

    A segment has at most 40 words, so the summary has at least 60 words
    wherever the text has. ``docs`` needs unique ids.
    """
    picks = _fill(F.sort_array("_scores"), max_words)
    start = F.struct(picks.alias("picks"), F.lit(0).alias("pos"), F.array().cast("array<string>").alias("taken"))

    # Not a filter inside a lambda of the picks: a scorer that takes the summary stays unevaluated over that.
    def take(acc: Column, s: Column) -> Column:
        picked = F.array_contains(acc["picks"], acc["pos"])
        taken = F.when(picked, F.concat(acc["taken"], F.array(s))).otherwise(acc["taken"])
        return F.struct(acc["picks"].alias("picks"), (acc["pos"] + 1).alias("pos"), taken.alias("taken"))

    chosen = F.aggregate(segments(F.col("abstract")), start, take, lambda acc: F.array_join(acc["taken"], " "))
    scored = docs.withColumn("_scores", score_segments(segments(F.col("abstract"))))
    return scored.withColumn("summary", F.coalesce(chosen, F.lit(""))).drop("_scores")


def lead_summary(docs: DataFrame, max_words: int = SUMMARY_MAX_WORDS) -> DataFrame:
    """Add ``summary``: the first segments, up to ``max_words`` words. No shuffle."""
    parts = F.transform(
        segments(F.col("abstract")), lambda s: F.struct(s.alias("segment"), F.size(tokens(s)).alias("words"))
    )
    start = F.struct(F.lit(0).alias("words"), F.array().cast("array<string>").alias("taken"))

    def add(acc: Column, s: Column) -> Column:
        total = acc["words"] + s["words"]
        taken = F.when(total <= max_words, F.concat(acc["taken"], F.array(s["segment"]))).otherwise(acc["taken"])
        return F.struct(total.alias("words"), taken.alias("taken"))

    lead = F.aggregate(parts, start, add, lambda acc: F.array_join(acc["taken"], " "))
    return docs.withColumn("summary", F.coalesce(lead, F.lit("")))


def model_summary(
    docs: DataFrame, load_model: Callable[[], Callable[[Sequence[str]], Sequence[str]]]
) -> DataFrame:
    """Add ``summary`` from a caller's model, loaded once per task.

    ``load_model`` runs on the executor and returns a function from a batch of
    texts to their summaries. Write the result before filtering on it.
    """

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in batches:
            yield pd.Series(list(model(batch.tolist())), dtype="object")

    return docs.withColumn("summary", run.asNondeterministic()(F.col("abstract")))
