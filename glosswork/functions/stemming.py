"""Porter stemming (Porter 1980, with the usual later extensions).

A small per-word helper; ``stem_terms`` is the Arrow-batched column form.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Words whose stem is given, not derived (fixed values).
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix -> replacement where the rest has measure > 0 (fixed values).
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
# Suffixes dropped where the rest has measure > 1 (fixed values).
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """The word as consonants (c) and vowels (v)."""
    shape = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and shape[-1:] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _swap(word: str, rules: list[tuple[str, str]]) -> str:
    for suffix, replacement in rules:
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            return rest + replacement if _measure(rest) > 0 else word
    return word


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        rest = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(rest):
            if rest.endswith(("at", "bl", "iz")):
                return rest + "e"
            if rest[-2:-1] == rest[-1:] and _shape(rest)[-1] == "c":
                return rest if rest[-1] in "lsz" else rest[:-1]
            return rest + "e" if _measure(rest) == 1 and _short_end(rest) else rest
    return word


def _derived(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _derived(word[:-2])
    if word.endswith("logi") and not word.endswith(tuple(s for s, _ in STEP_2)):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _swap(word, STEP_2)


def _residue(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            fits = suffix != "ion" or rest.endswith(("s", "t"))
            if suffix == "ion" and not fits:
                continue
            return rest if _measure(rest) > 1 else word
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        rest = word[:-1]
        m = _measure(rest)
        if m > 1 or (m == 1 and not _short_end(rest)):
            word = rest
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=1 << 18)
def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    return _tidy(_residue(_swap(_derived(word), STEP_3)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stem_arrays(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(lambda words: None if words is None else [stem(w) for w in words])


def stem_terms(words: Column) -> Column:
    """Stem every word of an array column."""
    return _stem_arrays(words)


_COUNTED = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())]))


@F.pandas_udf(_COUNTED)
def _stem_counts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    def added(words: Sequence[str], counts: Sequence[int]) -> list[dict]:
        total: dict[str, int] = {}
        for word, n in zip(words, counts):
            term = stem(word)
            total[term] = total.get(term, 0) + int(n)
        return [{"term": term, "tf": n} for term, n in total.items()]

    for words, counts in batches:
        yield pd.Series([None if w is None else added(w, n) for w, n in zip(words, counts)], dtype="object")


def stem_counts(words: Column, counts: Column) -> Column:
    """The distinct stems of an array of words with their summed counts, ``term, tf``.

    Marked nondeterministic so that it does not run for each use.
    """
    return _stem_counts.asNondeterministic()(words, counts)
