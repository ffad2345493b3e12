"""Phrase collocations per language, from counts of the longest windows alone.

Every word starts one window: itself and the words that lead it by one, two and
three places, padded with the empty string where its piece ends. Only these
windows are counted. A phrase of fewer words is a prefix of windows, so ROLLUP
over the window columns sums the counts of all shorter phrases, down to the
number of words of a language; there is no pass per phrase length.

Windows are counted per slice of text where it is read, and shuffled by
language and first word, as one string each, in sorted order. There,
continuations that stay under ``min_count`` turn into padding before ROLLUP
sees them: they have no frequent phrase of their own, and all shorter prefixes
keep their counts. Words that start many windows of a sample of the texts are
dealt by their second word too, and are left to ROLLUP. A pair that a third of
all rows share streams through in sorted order, holding fewer than
``min_count`` rows at a time.

A candidate is a phrase of two to four words with a count of ``min_count`` or
more. Both parts of each of its cuts are as frequent, so their counts come from
the same table by joins on (language, phrase). All arithmetic is on integers,
products on decimals.

Defined results: null and empty texts have no words; a null language is
``und``; repeated rows count each; ties rank by count, then by the bytes of the
phrase; a language with fewer candidates than ``top`` gives them all; an empty
table gives an empty result; other columns are ignored. Texts are cut at piece
ends only, so a very long text takes no more memory than its longest piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from glosswork.llm import words as w
from glosswork.session import stage

SLICE_BYTES = 4 << 20
SALTS = 64
SAMPLE = 0.02  # of the texts, to find hot words
HOT = 1000
WORDS = ["w1", "w2", "w3", "w4"]
_WORD, _BLANK, _END = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of about ``SLICE_BYTES`` that end where a piece or a text ends."""
    start, size = 0, len(data)
    while start < size:
        end = start + SLICE_BYTES
        if end >= size:
            end = size
        else:
            text = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
            marks = np.flatnonzero(_CLASS[data[max(start, text) : end]] == _END)
            if len(marks):
                end = max(start, text) + int(marks[-1]) + 1
            elif text > start:
                end = text
            else:  # one piece is longer: take it whole
                end = int(offsets[np.searchsorted(offsets, end, side="right")])
                at = start + SLICE_BYTES
                while at < end:
                    marks = np.flatnonzero(_CLASS[data[at : min(at + SLICE_BYTES, end)]] == _END)
                    if len(marks):
                        end = at + int(marks[0]) + 1
                        break
                    at += SLICE_BYTES
        yield start, end
        start = end


def _count(data: np.ndarray, ends: np.ndarray, langs: np.ndarray) -> tuple[pa.Array, list, np.ndarray] | None:
    """The words of a slice, sorted, and its distinct windows as places in them, with counts.

    ``ends`` are the ends of its texts, ``langs`` their languages as numbers.
    """
    kind = _CLASS[data]
    word = kind == _WORD
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = ends[(ends > 0) & (ends < len(data))]
    first[inner] |= word[inner]
    last[inner - 1] |= word[inner - 1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return None
    text = np.searchsorted(ends, starts, side="right")
    piece = np.cumsum(kind == _END, dtype=np.int32)[starts] + text
    at = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)]).astype(np.int32)
    spelled = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(_LOWER[data[word]]))
    coded = spelled.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(1, len(order) + 1)
    known = pa.concat_arrays([pa.array([""]), coded.dictionary.take(order)])

    lead = [place[coded.indices.to_numpy()]]
    for step in range(1, 4):
        column = np.zeros(len(starts), np.int64)
        if len(starts) > step:
            column[:-step] = np.where(piece[step:] == piece[:-step], lead[0][step:], 0)
        lead.append(column)
    high, low, lang = lead[0] << 31 | lead[1], lead[2] << 31 | lead[3], langs[text]
    by = np.lexsort((low, high, lang))
    high, low, lang = high[by], low[by], lang[by]
    same = (high[1:] == high[:-1]) & (low[1:] == low[:-1]) & (lang[1:] == lang[:-1])
    new = np.flatnonzero(np.concatenate([[True], ~same]))
    counts = np.diff(np.append(new, len(by)))
    return known, [lang[new], *(column[by[new]] for column in lead)], counts


def _digests(strings: pa.Array) -> np.ndarray:
    data, offsets = w.buffers(strings)
    return w.digests(data, offsets[:-1], offsets[1:]) if len(data) else np.zeros(len(strings), np.uint64)


def windows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", hot: list[str] = ()) -> DataFrame:
    """``key, part, n``: padded windows, counted per slice of text.

    A key is the quoted language, a line feed and the words, each with a blank behind
    it, so that windows with a common beginning are neighbours in the order of
    keys. ``part`` follows language and first word, and the second word where
    the first is ``hot``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            number = langs.indices.to_numpy(zero_copy_only=False)
            named = pa.array([quote(x, safe="") + "\n" for x in langs.dictionary.to_pylist()], pa.string())
            lang_digest = _digests(named)
            data, offsets = w.buffers(batch.column(1))
            if len(data):
                data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
            for start, end in _slices(data, offsets):
                low, high = np.searchsorted(offsets[1:], [start, end], side="right")
                ends = np.minimum(offsets[1 + low : 2 + high], end) - start
                found = _count(data[start:end], ends, number[low : high + 1])
                if found is None:
                    continue
                known, (lang, *lead), counts = found
                digest = _digests(known)
                salted = pc.is_in(known, value_set=pa.array(hot, pa.string())).to_numpy(zero_copy_only=False)
                part = lang_digest[lang] + w.mix(digest[lead[0]])
                part[salted[lead[0]]] += digest[lead[1]][salted[lead[0]]] * np.uint64(3)
                spaced = pc.binary_join_element_wise(known.slice(1), pa.array([""] * (len(known) - 1)), " ")
                spaced = pa.concat_arrays([pa.array([""]), spaced])
                words = [spaced.take(pa.array(column)) for column in lead]
                key = pc.binary_join_element_wise(named.take(pa.array(lang)), *words, "")
                part = (w.mix(part) >> np.uint64(33)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([key, pa.array(part), pa.array(counts)], names=["key", "part", "n"])

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    rows = docs.select(lang, F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "key string, part int, n bigint")


def hot_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[str]:
    """Words that start more than one in ``HOT`` windows of a sample: at most ``HOT`` of them.

    They only decide how the shuffle is dealt, not what is counted.
    """
    some = windows(docs.sample(SAMPLE, seed=1), text_col, lang_col)
    word = F.substring_index(F.substring_index("key", "\n", -1), " ", 1).alias("word")
    some = stage(some.groupBy(word).agg(F.sum("n").alias("n")), "sample")
    total = some.agg(F.sum("n")).first()[0] or 0
    return [r["word"] for r in some.filter(F.col("n") * HOT > total).collect()]


def _fields(key: pa.Array) -> list[pa.Array]:
    """Language and four words of keys; the empty string where a window is padded."""
    halves = pc.split_pattern(key, "\n").flatten()
    lang, words = halves.take(pa.array(np.arange(0, len(halves), 2))), halves.take(pa.array(np.arange(1, len(halves), 2)))
    lists = pc.split_pattern(words, " ")
    starts, flat = lists.offsets.to_numpy(), lists.flatten()
    sizes = np.diff(starts) - 1  # the last part, behind the last blank, is empty
    none = starts[1:] - 1
    return [lang, *(flat.take(pa.array(np.where(sizes > i, starts[:-1] + i, none) - starts[0])) for i in range(4))]


def _settle(counted: DataFrame, min_count: int, hot: list[str]) -> DataFrame:
    """``lang, w1, w2, w3, w4, n``: windows with rare continuations turned into padding."""
    out = pa.schema([(name, pa.string()) for name in ("lang", *WORDS)] + [("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sent = None, np.zeros(5, np.int64)  # rows not settled; what left already of their groups

        def settle(rows: pa.Table, final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, sent
            marks, seen = [], np.zeros(len(rows), bool)
            seen[0] = True
            for column in (c.combine_chunks() for c in rows.columns[:5]):
                if len(rows) > 1:
                    seen[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(rows) - 1)).to_numpy(zero_copy_only=False)
                marks.append(seen.copy())
            at = np.flatnonzero(marks[4])
            n = np.add.reduceat(rows["n"].to_numpy(), at)
            rows = rows.take(pa.array(at)).combine_chunks()
            group = [np.cumsum(m[at]) - 1 for m in marks]  # of equal languages, then of one to four words
            many, keep = [], 0
            for size in range(1, 5):
                total = np.bincount(group[size], n).astype(np.int64)
                total[0] += sent[size]
                many.append(total[group[size]] >= min_count)
                if size == 1:  # the windows of a hot word lie in several tasks
                    many[0] |= pc.is_in(rows["w1"], value_set=pa.array(hot, pa.string())).to_numpy(zero_copy_only=False)
                keep = keep + many[-1]
            stop = len(at)
            if not final:
                low = next((size for size in (1, 2, 3) if not many[size - 1][-1]), 4)
                stop = int(np.searchsorted(group[low], group[low][-1]))
                for size in range(1, 4):
                    past = int(n[np.searchsorted(group[size], group[size][-1]) : stop].sum())
                    sent[size] = past + (sent[size] if group[size][-1] == 0 else 0)
                held = rows.slice(stop).set_column(5, "n", pa.array(n[stop:]))
            for size in range(5):
                mine = np.flatnonzero(keep[:stop] == size)
                if not len(mine):
                    continue
                g = group[size][mine]
                new = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
                picked = rows.take(pa.array(mine[new]))
                columns = [c.combine_chunks() for c in picked.columns[: 1 + size]]
                pad = pa.array([""] * len(new), pa.string())
                sums = pa.array(np.add.reduceat(n[mine], new))
                yield pa.RecordBatch.from_arrays([*columns, *[pad] * (4 - size), sums], schema=out)

        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_arrays([*_fields(batch.column(0)), batch.column(1)], schema=out)
                yield from settle(rows if held is None else pa.concat_tables([held, rows]).combine_chunks(), False)
        if held is not None:
            yield from settle(held, True)

    rows = counted.repartition("part").select("key", "n").sortWithinPartitions("key")
    return rows.mapInArrow(run, "lang string, w1 string, w2 string, w3 string, w4 string, n bigint")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30) -> DataFrame:
    """``lang, w1..w4, size, phrase, f``: phrases of one to four words with at least ``min_count`` occurrences.

    ``size`` 0 is the row of all words of a language; words beyond ``size`` are null.
    """
    hot = hot_words(docs, text_col, lang_col)
    settled = _settle(windows(docs, text_col, lang_col, hot), min_count, hot)
    sums = settled.rollup("lang", *WORDS).agg(F.sum("n").alias("f")).filter("lang IS NOT NULL")
    size = sum((F.col(c).isNotNull().cast("int") for c in WORDS), F.lit(0))
    ended = F.coalesce(*[F.col(c) for c in reversed(WORDS)]) == ""
    sums = sums.withColumn("size", size).filter((F.col("size") == 0) | (~ended & (F.col("f") >= min_count)))
    return sums.select(F.url_decode("lang").alias("lang"), *WORDS, "size", F.concat_ws(" ", *WORDS).alias("phrase"), "f")


def _joined(first: int, size: int):
    return F.concat_ws(" ", *WORDS[first : first + size])


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = 30,
    top: int = 2000,
    scale: int = 2_000_000,
    contained: int = 80,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of every language.

    ``score`` is floor(scale * a / (l + r)) of the lowest-scoring cut, the one
    with the shortest first part among equals. Phrases inside a longer
    candidate with at least ``contained`` percent of their count are left out.
    """
    counts = stage(phrase_counts(docs, text_col, lang_col, min_count), "phrases")
    chosen = counts.filter("size > 1")
    exact = lambda c: F.col(c).cast("decimal(20,0)")

    cuts = []
    for k in (1, 2, 3):
        parts = F.struct(F.lit(k).alias("k"), _joined(0, k).alias("left"), _joined(k, 4).alias("right"))
        cuts.append(F.when(F.col("size") > k, parts))
    cut = chosen.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.array_compact(F.array(*cuts))).alias("cut"))
    cut = cut.select("lang", "phrase", "a", "cut.*")
    parts = counts.filter("size BETWEEN 1 AND 3")
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cut = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    whole = F.expr(f"CAST({scale} AS DECIMAL(18,0)) * CAST(a AS DECIMAL(20,0)) DIV (CAST(l AS DECIMAL(20,0)) + r)")
    scored = cut.withColumn("score", whole.cast("bigint")).groupBy("lang", "phrase", "a")
    scored = scored.agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    inner = []
    for first, size in ((0, 2), (1, 2), (2, 2), (0, 3), (1, 3)):
        fits = (F.col("size") > size) & (F.col("size") >= first + size)
        inner.append(F.when(fits, _joined(first, size)))
    longer = chosen.filter("size > 2").select("lang", "f", F.explode(F.array_compact(F.array(*inner))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("over"))
    held = F.col("over").isNotNull() & (100 * exact("over") >= contained * exact("a"))
    scored = scored.join(longer, ["lang", "phrase"], "left").filter(~held)

    rows = scored.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of every part of a language first, so that no task sees all of them.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("part")
    rows = rows.withColumn("part", part)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
    rows = rows.filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    total = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    rows = rows.filter(F.col("rank") <= top).join(total, "lang")
    return rows.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
