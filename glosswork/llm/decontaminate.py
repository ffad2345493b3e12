"""Benchmark passages in documents: q-gram lemma filter and banded alignment.

Benchmark items are cut into windows of ``window`` characters every ``stride``
(short items are one window). A window of m characters counts as present with
at most k = floor(rate * m) edits, and q must be short enough for that (an
error says so). By the q-gram lemma such an occurrence shares
at least m + 1 - q - k * q character q-grams with the window, all on diagonals
(text position minus window position) that differ by at most 2k. Shared q-grams
are therefore counted in overlapping bands of diagonals, twice as wide as that
and one such width apart, so that every occurrence has all its q-grams in some
band; bands below the bound are dropped and the rest verified by aligning the
window inside the band with free ends in the text.

Documents are never shuffled: every row is scanned whole by the task that reads
it. The windows of one block of benchmark text (``BLOCK_CHARS`` characters at
most) are broadcast; a larger benchmark takes several passes over the documents.

Letters A-Z count as lower case and every white-space character as a blank;
other characters count as they are, one code point each.

Defined results: null or empty texts and null or empty items match nothing; an
item shorter than q is looked for verbatim; an item that occurs under several
ids is reported for each; repeated rows are each reported; with an empty
benchmark no document is contaminated; other columns are ignored by
``find_passages`` and carried by ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from glosswork.llm import words as w

Q = 10  # at a rate of 0.05, short enough for every length that allows edits
RATE = 0.05
WINDOW, STRIDE = 80, 40
BLOCK_CHARS = 1 << 21
HITS = 1 << 21
FILTER_BITS = 22
_U = np.uint64
_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13, 28, 29, 30, 31]] = 32
_WIDE_SPACE = np.array([0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_NO_CHAR = np.uint32(0xFFFFFFFF)

FOUND = "start int, end int, edits int, windows int, item_windows int"


def characters(text: str) -> np.ndarray:
    """Code points with case and white space folded."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = points < 128
    out = np.where(low, _FOLD[np.where(low, points, 0)], points)
    out[np.isin(points, _WIDE_SPACE)] = 32
    return out


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    """Digest of the q-gram at every position; the last q - 1 positions have none."""
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(w.mix(points.astype(np.uint64) + _U(1)) * w.powers(_STEP, len(points)), out=total[1:])
    if len(points) < q:
        return np.zeros(0, np.uint64)
    return (total[q:] - total[:-q]) * w.powers(_BACK, len(points) + 1)[: len(points) - q + 1]


@dataclass
class Index:
    """q-grams of the windows of one block of items."""

    q: int
    items: list  # item id per window
    windows: list[np.ndarray]
    shift: np.ndarray  # position of the window in its item
    edits: np.ndarray  # budget per window
    least: np.ndarray  # shared q-grams that an occurrence has at least
    per_item: np.ndarray  # number of windows of the window's item
    keys: np.ndarray  # sorted q-gram digests
    window_of: np.ndarray
    place: np.ndarray
    filter: np.ndarray


def build_index(items: list[tuple], q: int = Q, rate: float = RATE, window: int = WINDOW, stride: int = STRIDE) -> Index:
    ids, windows, shift, per_item = [], [], [], []
    for item, text in items:
        points = characters(text)
        starts = list(range(0, max(1, len(points) - window + 1), stride))
        if len(points) > window and starts[-1] != len(points) - window:
            starts.append(len(points) - window)
        for s in starts:
            ids.append(item)
            windows.append(points[s : s + window])
            shift.append(s)
            per_item.append(len(starts))
    size = np.array([len(x) for x in windows], np.int64)
    edits = (size * rate).astype(np.int64)
    if (edits > np.maximum(0, (size - q) // q)).any():
        raise ValueError("q is too long for the edits that short windows allow")
    keys, window_of, place = [], [], []
    for number, points in enumerate(windows):
        grams = _grams(points, min(q, len(points)))
        keys.append(grams)
        window_of.append(np.full(len(grams), number))
        place.append(np.arange(len(grams)))
    keys, window_of, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, window_of, place))
    keys = keys.astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[w.mix(keys) >> _U(64 - FILTER_BITS)] = True
    least = np.maximum(1, size + 1 - q - edits * q)
    return Index(
        q, ids, windows, np.array(shift), edits, least, np.array(per_item), keys,
        window_of[order].astype(np.int32), place[order].astype(np.int32), seen,
    )


def _hits(index: Index, q: int, points: np.ndarray, docs: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Slices of (document, window, diagonal) for shared q-grams of length ``q``."""
    grams = _grams(points, q)
    at = np.flatnonzero(index.filter[w.mix(grams) >> _U(64 - FILTER_BITS)])
    at = at[at + q <= ends[docs[at]]]
    lo = np.searchsorted(index.keys, grams[at], side="left")
    hi = np.searchsorted(index.keys, grams[at], side="right")
    at, lo, count = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
    # Slices hold whole documents: bands never span two slices.
    total = np.cumsum(count)
    first = 0
    while first < len(at):
        last = int(np.searchsorted(total, (total[first - 1] if first else 0) + HITS, side="right"))
        last = max(last, first + 1)
        if last < len(at):
            begin = int(np.searchsorted(at, starts[docs[at[last]]]))
            last = begin if begin > first else int(np.searchsorted(at, ends[docs[at[last]]]))
        n = count[first:last]
        which = np.repeat(np.arange(first, last), n)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        entry = lo[which] + inside
        doc = docs[at[which]]
        yield doc, index.window_of[entry], at[which] - starts[doc] - index.place[entry]
        first = last


def _bands(index: Index, doc: np.ndarray, window: np.ndarray, diagonal: np.ndarray):
    """(document, window, first diagonal) of the bands that meet the bound."""
    width = 2 * index.edits[window] + 1
    low = diagonal // width
    doc, window = np.concatenate([doc, doc]), np.concatenate([window, window])
    band = np.concatenate([low, low - 1])
    order = np.lexsort((band, window, doc))
    doc, window, band = doc[order], window[order], band[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (window[1:] != window[:-1]) | (band[1:] != band[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(doc)))
    first = first[count >= index.least[window[first]]]
    return doc[first], window[first], band[first] * (2 * index.edits[window[first]] + 1)


def align(patterns: list[np.ndarray], texts: list[np.ndarray], low: np.ndarray, edits: int):
    """Fewest edits of each pattern inside its band, with the start and end in the text.

    The band holds the diagonals from ``low`` over two widths of 2 * edits + 1,
    widened by ``edits`` on both sides; all pairs advance together, one
    pattern character at a time.
    """
    n, width = len(patterns), 2 * (2 * edits + 1) + 2 * edits
    low = low - edits
    longest = max(len(p) for p in patterns)
    size = np.array([len(p) for p in patterns])
    pattern = np.full((n, longest), _NO_CHAR - np.uint32(1), np.uint32)
    text = np.full((n, longest + width), _NO_CHAR, np.uint32)
    for i, (p, t) in enumerate(zip(patterns, texts, strict=True)):
        pattern[i, : len(p)] = p
        a, b = max(0, int(low[i])), min(len(t), int(low[i]) + longest + width)
        if b > a:
            text[i, a - int(low[i]) : b - int(low[i])] = t[a:b]
    # A cell holds edits * one + the offset at which its alignment starts.
    one = np.int64(width + 1)
    offset = np.arange(width, dtype=np.int64)
    cell = np.tile(offset, (n, 1))
    out = np.zeros((n, 3), np.int64)
    for j in range(longest):
        step = cell + one * (text[:, j : j + width] != pattern[:, j : j + 1])
        step[:, :-1] = np.minimum(step[:, :-1], cell[:, 1:] + one)
        cell = np.minimum.accumulate(step - one * offset, axis=1) + one * offset
        done = np.flatnonzero(size == j + 1)
        if len(done):
            best = cell[done].argmin(axis=1)
            value = cell[done, best]
            out[done, 0] = value // one
            out[done, 1] = low[done] + value % one
            out[done, 2] = low[done] + best + j + 1
    return out


def scan(index: Index, texts: list[str]) -> Iterator[tuple[int, object, int, int, int, int, int]]:
    """(text number, item, start, end, edits, windows found, windows of the item)."""
    row, n = 0, len(texts)
    while row < n and index.windows:
        parts, size, first = [], 0, row
        while row < n and (size < w.CHUNK_BYTES or not parts):
            parts.append(characters(texts[row] or ""))
            size += len(parts[-1])
            row += 1
        yield from ((first + d, *rest) for d, *rest in _scan_chunk(index, parts))


def _scan_chunk(index: Index, parts: list[np.ndarray]) -> Iterator[tuple]:
    points = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - np.array([len(p) for p in parts])
    docs = np.repeat(np.arange(len(parts)), ends - starts)
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for q in sorted({min(index.q, len(x)) for x in index.windows if len(x)}):
        for hits in _hits(index, q, points, docs, starts, ends):
            doc, window, low = _bands(index, *hits)
            for k in np.unique(index.edits[window]):
                chosen = np.flatnonzero(index.edits[window] == k)
                for lo in range(0, len(chosen), 512):
                    some = chosen[lo : lo + 512]
                    aligned = align(
                        [index.windows[x] for x in window[some]], [parts[d] for d in doc[some]], low[some], int(k)
                    )
                    for (edits, start, end), d, x in zip(aligned, doc[some], window[some], strict=True):
                        if edits <= k:
                            hit = (int(edits), max(0, int(start)), min(len(parts[d]), int(end)))
                            found[d, x] = min(found.get((d, x), hit), hit)
    by_item: dict[tuple, list] = {}
    for (d, x), (edits, start, end) in found.items():
        by_item.setdefault((int(d), index.items[x]), []).append((edits, start, end, int(index.per_item[x])))
    for (d, item), hits in sorted(by_item.items(), key=lambda x: (x[0][0], str(x[0][1]))):
        yield (
            d, item, min(h[1] for h in hits), max(h[2] for h in hits), min(h[0] for h in hits), len(hits), hits[0][3],
        )


def blocks(benchmark: DataFrame, item_col: str, text_col: str, **sizes) -> Iterator[Broadcast]:
    """Broadcast indexes over at most BLOCK_CHARS characters of items (one item at least)."""
    context = benchmark.sparkSession.sparkContext
    held, size = [], 0
    items = benchmark.select(item_col, F.col(text_col).cast("string")).filter(F.length(text_col) > 0)
    for item, text in items.orderBy(item_col).toLocalIterator():
        if held and size + len(text) > BLOCK_CHARS:
            yield context.broadcast(build_index(held, **sizes))
            held, size = [], 0
        held.append((item, text))
        size += len(text)
    if held:
        yield context.broadcast(build_index(held, **sizes))


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    **sizes,
) -> DataFrame:
    """One row per document and item with a shared passage.

    ``start`` and ``end`` span the passages found, ``edits`` is the fewest edits
    of a window, ``windows`` counts the item's windows that occur.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {id_type}, item {item_type}, {FOUND}"

    def search(shared: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(scan(shared.value, batch.column(1).to_pylist()))
                taken = batch.column(0).take(pa.array([f[0] for f in found], pa.int32()))
                columns = [taken, pa.array([f[1] for f in found])] if found else [taken, pa.nulls(0)]
                columns += [pa.array([f[i] for f in found], pa.int32()) for i in range(2, 7)]
                if not found:
                    continue
                names = ["id", "item", "start", "end", "edits", "windows", "item_windows"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for shared in blocks(benchmark, item_col, item_text_col, **sizes):
        out = out.unionByName(rows.mapInArrow(search(shared), schema))
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    **sizes,
) -> DataFrame:
    """The rows of ``docs`` without a passage of any item, with all their columns."""

    def keep(shared: Broadcast, at: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in scan(shared.value, batch.column(at).to_pylist())]] = False
                yield batch.filter(pa.array(clean))

        return run

    for shared in blocks(benchmark, item_col, item_text_col, **sizes):
        docs = docs.mapInArrow(keep(shared, docs.columns.index(text_col)), docs.schema)
    return docs
