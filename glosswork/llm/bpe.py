"""Byte-level BPE: texts to token ids by merge ranks, and back.

Spark folds ranked merges over the bytes of distinct words with higher-order
functions: a word is an array of one-byte pieces; each step looks up the ranks
of all neighbours in a literal rank map and joins the best pair, leftmost
first, until no pair has a rank. The rank map is two literal arrays addressed
by two CRC-32 slots (a key sits in one of them), so a look-up does not depend
on the size of the vocabulary. Bytes are carried as the 256 first code points.

The fold costs about 100 microseconds a word, so it serves the distinct words
of ``fold_words`` and the table of frequent words (at most ``FREQUENT``, from
about ``SAMPLE`` documents chosen by hash), which is broadcast. Other words are
merged by the same rule in the tasks that meet them and remembered there; the
result does not depend on which words are in the table. Texts are never
shuffled, nor are tokens.

Decoding is a Spark expression that concatenates the binary pieces of the ids.

Defined results: a null or empty text has no tokens; repeated rows are each
returned; words with equal frequency enter the table by their text; an empty
table gives an empty result; special tokens are ordinary text; other columns
are ignored.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FREQUENT = 1 << 15
SAMPLE = 4000
LONGEST = 32  # bytes of a word in the table of frequent words
REMEMBERED = 1 << 17  # words a task remembers
SLOT_BITS = 17
_BREAK = "Ā"  # outside the 256 characters that stand for bytes


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The rank file: a line of base64 bytes and rank per vocabulary entry.

    A path without a scheme is a file of the driver.
    """
    if "://" in path:
        lines = [r["value"] for r in spark.read.text(path).collect()]
    else:
        with open(path) as file:
            lines = file.readlines()
    return {base64.b64decode(piece): int(rank) for piece, rank in map(str.split, filter(str.strip, lines))}


def _slots(key: str) -> tuple[int, int]:
    code = zlib.crc32(key.encode())
    return code & ((1 << SLOT_BITS) - 1), code >> (32 - SLOT_BITS)


def _placed(keys: list[str]) -> list[str | None]:
    """Every key in one of its two slots."""
    table: list[str | None] = [None] * (1 << SLOT_BITS)
    for key in keys:
        moving, at = key, _slots(key)[0]
        for _ in range(1000):
            moving, table[at] = table[at], moving
            if moving is None:
                break
            one, two = _slots(moving)
            at = two if at == one else one
        else:
            raise ValueError("the vocabulary does not fit the slots")
    return table


class RankMap:
    """The rank map as one literal that ``use`` binds for any number of look-ups."""

    def __init__(self, ranks: dict[bytes, int]):
        by_text = {piece.decode("latin-1"): rank for piece, rank in ranks.items()}
        table = _placed(list(by_text))
        keys = F.split(F.lit(_BREAK.join(key or "" for key in table)), _BREAK, -1)
        numbers = ",".join("-1" if key is None else str(by_text[key]) for key in table)
        self.literal = F.struct(keys.alias("keys"), F.split(F.lit(numbers), ",", -1).cast("array<int>").alias("ranks"))

    def use(self, body) -> Column:
        """``body(rank)``, where ``rank(piece)`` is null for unknown pieces."""

        def bound(table: Column) -> Column:
            def rank(piece: Column) -> Column:
                code = F.crc32(piece.cast("binary"))
                one = code.bitwiseAND((1 << SLOT_BITS) - 1).cast("int")
                two = F.shiftright(code, 32 - SLOT_BITS).cast("int")
                keys, ranks = table["keys"], table["ranks"]
                return F.when(keys[one] == piece, ranks[one]).when(keys[two] == piece, ranks[two])

            return body(rank)

        return _let(self.literal, bound)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fold_word(word: Column, table: RankMap) -> Column:
    """Token ids of a word by folded merges."""
    as_bytes = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")

    def body(rank) -> Column:
        def merge(state: Column) -> Column:
            joined = F.zip_with(
                F.slice(state, 1, F.size(state) - 1), F.slice(state, 2, F.size(state) - 1), lambda a, b: F.concat(a, b)
            )
            return _let(joined, lambda pairs: _let(F.transform(pairs, rank), lambda ranks: best(state, pairs, ranks)))

        def best(state: Column, pairs: Column, ranks: Column) -> Column:
            least = F.array_min(ranks)
            return F.when(least.isNull(), state).otherwise(
                _let(
                    F.array_position(ranks, least).cast("int"),
                    lambda at: F.concat(
                        F.slice(state, 1, at - 1),
                        F.array(F.element_at(pairs, at)),
                        F.slice(state, at + 2, F.size(state)),
                    ),
                )
            )

        def fold(pieces: Column) -> Column:
            folded = F.aggregate(
                F.sequence(F.lit(2), F.greatest(F.size(pieces), F.lit(2))),
                pieces,
                lambda state, _: F.when(F.size(state) < 2, state).otherwise(merge(state)),
            )
            return F.transform(folded, rank)

        return _let(
            rank(as_bytes), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(fold(F.split(as_bytes, "")))
        )

    return table.use(body)


def fold_words(words: DataFrame, table: RankMap, word_col: str = "word") -> DataFrame:
    """``word, ids`` for the distinct non-empty words of a column."""
    distinct = words.filter(F.length(word_col) > 0).select(F.col(word_col).alias("word")).distinct()
    return distinct.select("word", fold_word(F.col("word"), table).alias("ids"))


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one word by the same merges."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 2 * LONGEST:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    found = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
    while known := [r for r in found if r is not None]:
        at = found.index(min(known))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del found[at]
        if at < len(found):
            found[at] = ranks.get(parts[at] + parts[at + 1])
        if at:
            found[at - 1] = ranks.get(parts[at - 1] + parts[at])
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge_bytes``, with a heap of pairs, for words of any length."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(piece[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        alive[j], end[i] = False, stop
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class _Memory(dict):
    """Packed ids of words, merged when first met; holds at most ``REMEMBERED`` new words."""

    def __init__(self, frequent: dict[str, bytes], ranks: dict[bytes, int]):
        super().__init__(frequent)
        self.frequent, self.ranks = frequent, ranks

    def __missing__(self, word: str) -> bytes:
        data = word.encode()
        ids = _packed(merge_bytes(data, self.ranks))
        if len(data) <= 2 * LONGEST:
            if len(self) >= REMEMBERED + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[word] = ids
        return ids


def frequent_words(
    docs: DataFrame, id_col: str, text_col: str, pattern: str, table: RankMap
) -> dict[str, bytes]:
    """Packed ids of the most frequent words of a bounded sample of documents.

    A hash of id and text picks about SAMPLE documents where they are read.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("t"), F.xxhash64(id_col, text_col).alias("h"))
    share = F.lit(max(1, SAMPLE * (1 << 40) // max(1, docs.count())))
    sample = rows.filter(F.pmod("h", F.lit(1 << 40)) < share).select("t").limit(2 * SAMPLE)
    word = F.explode(F.regexp_extract_all("t", F.lit(f"(?U){pattern}"), F.lit(0)))
    counts = sample.select(word.alias("word")).filter(F.octet_length("word").between(1, LONGEST)).groupBy("word").count()
    best = counts.orderBy(F.desc("count"), "word").limit(FREQUENT).select("word")
    return {r["word"]: _packed(r["ids"]) for r in fold_words(best, table).collect()}


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id and ``ids``, the tokens of its whole text."""
    context = docs.sparkSession.sparkContext
    frequent = frequent_words(docs, id_col, text_col, pattern, RankMap(ranks))
    shared = context.broadcast((frequent, ranks))  # at most FREQUENT words and the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, memory = regex.compile(pattern).findall, _Memory(*shared.value)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                ids = [
                    b"".join([memory[word] for word in find(text.as_py() or "")]) for text in part.column(1)
                ]
                offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                flat = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(ids))])
                lists = pa.ListArray.from_arrays(pa.array(offsets), flat)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["id", "ids"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col)


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids: its binary pieces one after the other."""
    by_id = [""] * (max(ranks.values(), default=0) + 1)
    for piece, rank in ranks.items():
        by_id[rank] = piece.hex()
    pieces = F.split(F.lit(",".join(by_id)), ",", -1)
    return F.unhex(F.array_join(F.transform(ids, lambda i: pieces[i]), ""))


def digests(
    encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", keep_ids: bool = False
) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded bytes."""
    return encoded.select(
        id_col,
        *(["ids"] if keep_ids else []),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )
