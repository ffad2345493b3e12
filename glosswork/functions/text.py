"""Column functions over text: tokens, query terms, sentences, n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from glosswork.fixed_values import (
    KEYWORD_MIN_LENGTH,
    STOP_WORDS,
    TERM_MIN_LENGTH,
    TOPIC_KEYWORDS,
)

TOKEN = "[a-z0-9]+"
# Whitespace outside ASCII, and the ASCII separators that Java's \s leaves out.
WIDE_SPACE = "[\\x0b\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
SEGMENT_WORDS = 40
# A sentence ends at . ! ? or a line break; a run of 40 words without an end is cut.
SEGMENT = (
    r"[^a-zA-Z0-9.!?\n]*(?:[a-zA-Z0-9]+[^a-zA-Z0-9.!?\n]*){1,%d}[.!?]*" % SEGMENT_WORDS
)


def content_id(text: Column) -> Column:
    return F.md5(F.encode(text, "UTF-8"))


def tokens(text: Column) -> Column:
    """Lower-case ASCII letter and digit runs, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def is_stop_word(term: Column) -> Column:
    return term.isin(*STOP_WORDS)


def content_tokens(text: Column) -> Column:
    return F.filter(tokens(text), lambda t: ~is_stop_word(t))


def segments(text: Column) -> Column:
    """Sentences, each of at most SEGMENT_WORDS words."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(SEGMENT), F.lit(0)), lambda s: F.trim(s)
    )


def clean_query(query: Column) -> Column:
    """Delete all but ASCII letters, digits and whitespace."""
    spaced = F.regexp_replace(query, WIDE_SPACE, " ")
    return F.regexp_replace(spaced, r"[^a-zA-Z0-9\s]", "")


def query_words(query: Column, min_length: int) -> Column:
    words = F.split(F.lower(clean_query(query)), r"\s+")
    return F.filter(words, lambda w: F.length(w) >= min_length)


def query_terms(query: Column) -> Column:
    return query_words(query, TERM_MIN_LENGTH)


def fallback_keywords(query: Column) -> Column:
    return query_words(query, KEYWORD_MIN_LENGTH)


def is_blank(query: Column) -> Column:
    """NULL, empty or nothing but whitespace."""
    return F.coalesce(F.trim(F.regexp_replace(query, WIDE_SPACE + r"|\s", " ")), F.lit("")) == ""


def counted(words: Column) -> Column:
    """The distinct words of an array with their counts, ``term, n``, by sorting.

    Counts inside a row need no rows per word and no memory beyond the row.
    """

    def runs(s: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(s))
        starts = F.filter(places, lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)))
        return let(starts, lambda at: F.zip_with(
            at,
            F.concat(F.slice(at, 2, F.size(at)), F.array(F.size(s) + 1)),
            lambda a, b: F.struct(F.get(s, a - 1).alias("term"), (b - a).alias("n")),
        ))

    none = F.array().cast("array<struct<term: string, n: int>>")
    return F.when(F.size(words) > 0, let(F.sort_array(words), runs)).otherwise(none)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def uni_and_bigrams(words: Column) -> Column:
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(words, pairs)


def detect_topic(
    query: Column, topic_map: Sequence[tuple[str, str]] = TOPIC_KEYWORDS
) -> Column:
    """Label of the first keyword, in map order, that occurs in the query."""
    lowered = F.lower(query)
    return F.coalesce(
        *[F.when(F.contains(lowered, F.lit(k)), F.lit(label)) for k, label in topic_map]
    )


def keyword_filter(text: Column, keywords: Sequence[str]) -> Column:
    """True where any keyword occurs in the text, upper or lower case."""
    hit = F.lit(False)
    for keyword in keywords:
        hit = hit | text.ilike(f"%{keyword}%")
    return hit


def all_terms_filter(text: Column, query: str) -> Column:
    """True where the text holds every search term of one query, by a scan.

    For a single query this beats building an index.
    """
    words = "".join(c for c in query if c.isspace() or (c.isascii() and c.isalnum())).lower().split()
    terms = {w for w in words if len(w) >= TERM_MIN_LENGTH} - set(STOP_WORDS)
    if not terms:
        return F.lit(False)
    wanted = F.array(*[F.lit(t) for t in sorted(terms)])
    return F.size(F.array_intersect(wanted, tokens(text))) == len(terms)


def label_or_general(label: Column) -> Column:
    return F.coalesce(F.nullif(label, F.lit("")), F.lit("general"))


def context_line(label: Column, rouge: Column, summary: Column) -> Column:
    score = F.coalesce(F.round(rouge.cast("double"), 3).cast("string"), F.lit("n/a"))
    return F.concat(
        F.lit("[Topic: "),
        label_or_general(label),
        F.lit(" | ROUGE-L: "),
        score,
        F.lit("]\n"),
        F.coalesce(summary, F.lit("")),
    )


def topic_label(topic_id: Column, words: Column) -> Column:
    """Top words joined by ``_``; fixed names for noise and wordless topics."""
    named = F.when(F.size(words) > 0, F.array_join(words, "_"))
    return F.when(topic_id == -1, F.lit("outlier")).otherwise(
        F.coalesce(named, F.concat(F.lit("topic_"), topic_id.cast("string")))
    )


def topic_score(probabilities: Column) -> Column:
    return F.round(F.array_max(probabilities).cast("double"), 4)


def preview(text: Column, width: int = 80) -> Column:
    return F.substring(text, 1, width)
