"""Language model scores from a hierarchical Pitman-Yor model.

Restaurants. A token is predicted by the restaurant of the token before it,
one for every token that comes before another; its parent is the restaurant of
all tokens; the base is uniform over the training vocabulary and one unknown
token. Customers of a restaurant sit at tables that serve one word; every table
is a customer of the parent. Discounts follow from the counts of words seen
once and twice.

Gibbs sampling. Customers are seated in turn, then single customers are taken
from their table and seated anew in proportion to table sizes less the discount,
or at a new table in proportion to the parent's probability of the word. Words
are independent given the totals of the restaurants, so each task samples the
words of its bucket. Totals are exchanged between passes: those of every
context by shuffles to where its parts meet and back, those of the restaurant of
all tokens as a few numbers; within a pass they are held fixed. Probabilities
are averaged over the samples, each with its own totals, so that they add up to
one.

Flow. Tasks pack the tokens of a run of documents by word bucket: word digest,
document, digest of the token before. One shuffle brings a word's tokens and its
training counts together; they are stored by bucket, so that totals join them
without another shuffle. There the word is sampled and its tokens are scored,
and sums per document return. Words that hold more than 1 / ``HOT`` of all
tokens (fewer than HOT words, found by counting) go to the bucket of the token
before them, and the restaurant of all tokens gets their tables as totals; where
the token before is such a word too, or the start of a text, counts go instead
of tokens, and the documents are scored where they are read, from a table of
HOT x HOT probabilities at most. Buckets number ``spark.sql.shuffle.partitions``.
Staged tables carry every pass, so a lost executor repeats tasks only; random
numbers are seeded by bucket.

Defined results: a null or empty text is one end token; ids are expected to be
unique, rows that share an id (or have none) are scored together and each gets
the mean; without training documents every probability is uniform; an empty
table gives an empty result; other columns are ignored. Words are known by
64-bit digests.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from glosswork.llm import words as w
from glosswork.session import delete_folder, drop_staged, stage, staging_root

FINE = 1024  # contexts, where no other number is given
HOT = 512
RUN_BYTES = 8 << 20
STRENGTH = 1.0
BURN_IN, SAMPLES, MOVES = 1, 3, 4
_U = np.uint64
_random = np.random.default_rng(20240331)
START, END = (int(x) for x in _random.integers(1, 1 << 63, 2, dtype=np.uint64))
# Totals in one vector: customers and tables of every context, then these.
C0, T0, ONCE, VOCABULARY = -7, -6, -5, -1
_SHARED = 7


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; bytes of equal weight lie together."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], np.int64)
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *planes]))


def unpack(blob: bytes, *dtypes) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * (1 + len(dtypes)), []
    for size, dtype in zip(np.frombuffer(body, np.int64, len(dtypes), 8), dtypes, strict=True):
        planes = np.frombuffer(body, np.uint8, int(size), at).reshape(np.dtype(dtype).itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel())
        at += int(size)
    return out


def _steps(ordered: np.ndarray) -> np.ndarray:
    """Differences of ordered numbers, which pack better; ``np.cumsum`` undoes it."""
    return np.diff(ordered, prepend=ordered.dtype.type(0))


def _sum(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=steps.dtype)


def runs(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, number of rows; token, token before and row of every token."""
    held: list[tuple] = []
    size = first = rows = 0
    for row, data, offsets in w.chunks(texts):
        starts, ends, doc = w.find(data, offsets)
        n = len(offsets) - 1
        token = np.full(len(starts) + n, _U(END))
        owner = np.empty(len(token), np.int64)
        at = np.arange(len(starts)) + doc
        token[at] = w.digests(data, starts, ends)
        last = np.cumsum(np.bincount(doc, minlength=n) + 1) - 1
        owner[at], owner[last] = doc, np.arange(n)
        before = np.empty(len(token), np.uint64)
        before[1:] = token[:-1]
        before[np.concatenate([[0], last[:-1] + 1])] = _U(START)
        held.append((token, before, (owner + rows).astype(np.uint32)))
        size, rows = size + len(data), rows + n
        if size >= RUN_BYTES:
            yield first, rows, *_taken(held)
            size, first, rows = 0, row + n, 0
        del token, owner, before, starts, ends, doc, at
    if held:
        yield first, rows, *_taken(held)


def _taken(held: list[tuple]) -> list[np.ndarray]:
    """The parts of a run, each joined; ``held`` is empty afterwards."""
    columns = [list(x) for x in zip(*held, strict=True)]
    held.clear()
    out = []
    for i in range(len(columns)):
        out.append(np.concatenate(columns[i]))
        columns[i] = None
    return out


def bucket_of(token: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets follow the order of the digests."""
    return (((token >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def hot_words(rows: DataFrame) -> list[int]:
    """Digests of words with more than 1 / HOT of all tokens, of the end token and of the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, token, _, _ in runs(batch.column(1)):
                word, count = np.unique(token, return_counts=True)
                heavy = count * HOT > len(token)
                word, count = np.append(word[heavy].view(np.int64), 0), np.append(count[heavy], len(token))
                total = np.arange(len(word)) == len(word) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word), pa.array(count), pa.array(total)], names=["word", "n", "total"]
                )

    found = rows.mapInArrow(run, "word bigint, n bigint, total boolean").groupBy("word", "total").agg(F.sum("n").alias("n"))
    size = F.max(F.when(F.col("total"), F.col("n")))
    # A word above the share is heavy in some run, where it is counted; few enough rows remain.
    found = stage(found, "heavy")
    n = found.agg(size.alias("n")).first()["n"] or 0
    heavy = found.filter(~F.col("total") & (F.col("n") * HOT > n)).select("word").collect()
    return sorted({START, END, *(r["word"] % (1 << 64) for r in heavy)})


def _find(common: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places among the hot words, and whether they are that word."""
    place = np.minimum(np.searchsorted(common, digest), len(common) - 1)
    return place, common[place] == digest


def _packed(rows: DataFrame, hot: list[int], buckets: int, keys: list[int]) -> DataFrame:
    """One row per run and bucket: packed tokens, and counts of hot words after hot words.

    A run is known by a digest of its ids and tokens. Its ids go to one bucket.
    """
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.array(hot, np.uint64)
        for batch in batches:
            for first, n, token, before, doc in runs(batch.column(1)):
                ids = batch.column(0).slice(first, n)
                name = hashlib.blake2b(token, digest_size=16)
                name.update(str(ids.to_pylist()).encode())
                name = name.digest()
                owner = int.from_bytes(name[:4], "little") % buckets
                held = batch.column(2).slice(first, n).to_numpy(zero_copy_only=False)
                (place, is_hot), (above, follows) = _find(common, token), _find(common, before)
                both = is_hot & follows
                learnt = both & ~held[doc]
                pair, times = np.unique(place[learnt] * len(common) + above[learnt], return_counts=True)
                hot_word, hot_before = common[pair // len(common)], common[pair % len(common)]
                hot_bucket = bucket_of(hot_before, buckets)
                del place, above, follows, learnt
                token, before, doc, is_hot = token[~both], before[~both], doc[~both], is_hot[~both]
                target = bucket_of(np.where(is_hot, before, token), buckets).astype(np.int32)
                del both, is_hot
                order = np.lexsort((token, target))
                token, before, doc, target = token[order], before[order], doc[order], target[order]
                cut = np.searchsorted(target, np.arange(buckets + 1))
                del order, target
                out: dict[str, list] = {"key": [], "ids": [], "tokens": [], "counts": []}
                for b in range(buckets):
                    part = slice(cut[b], cut[b + 1])
                    mine = hot_bucket == b
                    if b != owner and cut[b] == cut[b + 1] and not mine.any():
                        continue
                    own = token[part]
                    new = np.ones(len(own), bool)
                    new[1:] = own[1:] != own[:-1]
                    begin = np.flatnonzero(new)
                    there, local = np.unique(doc[part], return_inverse=True)
                    contexts, at = np.unique(before[part], return_inverse=True)
                    out["key"].append(keys[b])
                    out["ids"].append(ids.to_pylist() if b == owner else None)
                    out["tokens"].append(
                        pack(
                            _steps(own[begin]), np.diff(np.append(begin, len(own))).astype(np.uint32), local.astype(np.uint32),
                            _steps(contexts), at.astype(np.uint32), _steps(there.astype(np.uint32)), held[there],
                        )
                    )
                    out["counts"].append(pack(hot_word[mine], hot_before[mine], times[mine].astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["key"], pa.int32()), pa.array([name] * len(out["key"]), pa.binary()),
                        pa.array(out["ids"], pa.list_(ids.type)),
                        pa.array(out["tokens"], pa.binary()), pa.array(out["counts"], pa.binary()),
                    ],
                    names=["key", "run", "ids", "tokens", "counts"],
                )

    return rows.mapInArrow(run, f"key int, run binary, ids array<{id_type}>, tokens binary, counts binary")


def _even_keys(spark, buckets: int) -> list[int]:
    """One key per bucket such that hash partitioning gives each a partition of its own."""
    found = spark.range(64 * buckets).select(
        F.col("id").cast("int").alias("key"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(buckets)).alias("p")
    )
    by = {r["p"]: r["key"] for r in found.groupBy("p").agg(F.min("key").alias("key")).collect()}
    spare = iter(range(64 * buckets, 65 * buckets))
    return [by.get(p) if p in by else next(spare) for p in range(buckets)]


def _gathered(packed: DataFrame, hot: list[int], buckets: int) -> DataFrame:
    """One row per bucket: pairs of word and token before, tokens of all documents, totals.

    Pairs are ``word * number of contexts + context``, with their training
    count; ``tokens`` has the number of tokens of every pair and their documents;
    ``docs`` the run and the row in it of every document of the bucket; ``hot``
    the places of hot words among the bucket's words and contexts.
    """
    id_type = packed.schema["ids"].dataType.elementType

    def join(key: int, blobs: list[tuple], ids_of) -> pa.RecordBatch:
        words, times, docs, contexts, above, held, run_of, row_of, counts = [], [], [], [], [], [], [], [], []
        shift = known = 0
        for number, (_, tokens, hot_counts) in enumerate(blobs):
            word, n, doc, context, at, there, out = unpack(
                tokens, np.uint64, np.uint32, np.uint32, np.uint64, np.uint32, np.uint32, np.bool_
            )
            words.append(_sum(word))
            times.append(n)
            docs.append(doc + np.uint32(shift))
            contexts.append(_sum(context))
            above.append(at + np.uint32(known))
            held.append(out)
            run_of.append(np.full(len(there), number, np.uint32))
            row_of.append(_sum(there))
            shift, known = shift + len(there), known + len(context)
            counts.append(unpack(hot_counts, np.uint64, np.uint64, np.int64))
        words, times, doc, contexts, above, held = (np.concatenate(x) for x in (words, times, docs, contexts, above, held))
        hot_word, hot_before, hot_times = (np.concatenate(x) for x in zip(*counts, strict=True))
        vocabulary, index = np.unique(np.concatenate([words, hot_word]), return_inverse=True)
        before, place = np.unique(np.concatenate([contexts, hot_before]), return_inverse=True)
        wide = len(before)
        token = np.repeat(index[: len(words)], times) * wide + place[: len(contexts)][above]
        order = np.argsort(token, kind="stable")
        token, doc = token[order], doc[order]
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        learnt = np.concatenate([[0], np.cumsum(~held[doc])])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(token)) if len(begin) else begin
        # Tokens of hot words after hot words are only counted.
        pair, at = np.unique(
            np.concatenate([token[begin], index[len(words) :] * wide + place[len(contexts) :]]), return_inverse=True
        )
        weight = np.concatenate([learnt[end] - learnt[begin], hot_times])
        count = np.bincount(at, weight, len(pair)).astype(np.int64)
        each = np.bincount(at[: len(begin)], end - begin, len(pair)).astype(np.uint32)
        common = np.array(hot, np.uint64)
        hot_at = [np.flatnonzero(np.isin(x, common)) for x in (vocabulary, before)]
        which = [np.searchsorted(common, x[y]) for x, y in zip((vocabulary, before), hot_at, strict=True)]
        columns = [
            pa.array([key], pa.int32()),
            pa.array([len(vocabulary)], pa.int64()),
            pa.array([pack(_steps(pair), count)], pa.binary()),
            pa.array([pack(_steps(before))], pa.binary()),
            pa.array([pack(*(x.astype(np.int64) for x in (hot_at[0], which[0], hot_at[1], which[1])))], pa.binary()),
            pa.array([[b[0] for b in blobs]], pa.list_(pa.binary())),
            ids_of,
            pa.array([pack(np.concatenate(run_of), np.concatenate(row_of))], pa.binary()),
            pa.array([pack(each, doc.astype(np.uint32))], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(
            columns, names=["key", "words", "pairs", "before", "hot", "runs", "ids", "docs", "tokens"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs, ids, kind = None, [], [], None

        def done() -> pa.RecordBatch:
            return join(current, blobs, pa.array([ids], pa.list_(kind)))

        for batch in batches:
            kind = batch.schema.field("ids").type
            for row in range(batch.num_rows):
                key = batch.column(0)[row].as_py()
                if key != current and blobs:
                    yield done()
                    blobs, ids = [], []
                current = key
                name, own, tokens, counts = (batch.column(c)[row].as_py() for c in (1, 2, 3, 4))
                blobs.append((name, tokens, counts))
                ids.append(own)
        if blobs:
            yield done()

    together = packed.repartition(buckets, "key").sortWithinPartitions("key")
    ids = f"array<array<{id_type.simpleString()}>>"
    return together.mapInArrow(
        run,
        f"key int, words bigint, pairs binary, before binary, hot binary, runs array<binary>, ids {ids}, docs binary, tokens binary",
    )


def _stored(gathered: DataFrame, buckets: int) -> tuple[DataFrame, str, str]:
    """``gathered`` as a table bucketed by key, its name and folder."""
    spark, name = gathered.sparkSession, f"gathered_{uuid.uuid4().hex}"
    path = f"{staging_root(spark)}/{name}"
    gathered.write.bucketBy(buckets, "key").sortBy("key").option("path", path).saveAsTable(name)
    return spark.table(name), name, path


def _trained(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the training tokens, and their counts."""
    pair, count = unpack(blob, np.int64, np.int64)
    return _sum(pair)[count > 0], count[count > 0]


def _parents(pair: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of sorted pairs, and for each pair the place of its word."""
    return np.unique(pair // wide, return_inverse=True)


def first_totals(pair: np.ndarray, count: np.ndarray, wide: int = FINE) -> np.ndarray:
    """Totals when every word has one table per restaurant."""
    root, to_root = _parents(pair, wide)
    in_root = np.bincount(to_root, minlength=len(root))
    out = totals_of(pair, count, np.ones(len(pair)), root, in_root, np.ones(len(root)), wide)
    for k, customers in enumerate((count, in_root)):
        out[ONCE + 2 * k], out[ONCE + 2 * k + 1] = (customers == 1).sum(), (customers == 2).sum()
    out[VOCABULARY] = len(root)
    return out


def totals_of(pair, count, tables, root, in_root, root_tables, wide: int = FINE) -> np.ndarray:
    out = np.zeros(2 * wide + _SHARED)
    out[:wide] = np.bincount(pair % wide, count, wide)
    out[wide : 2 * wide] = np.bincount(pair % wide, tables, wide)
    out[C0], out[T0] = in_root.sum(), root_tables.sum()
    return out


def discounts(totals: np.ndarray) -> list[float]:
    """Of the contexts and of all tokens: n1 / (n1 + 2 n2), kept inside (0, 1)."""
    once, twice = totals[ONCE:VOCABULARY:2], totals[ONCE + 1 : VOCABULARY : 2]
    return [float(x) for x in np.clip(once / np.maximum(1, once + 2 * twice), 0.1, 0.95)]


class Seating:
    """Tables of many (restaurant, word) pairs, as one array of sizes sorted by pair."""

    def __init__(self, customers: np.ndarray, discount: float, fresh: np.ndarray, rng: np.random.Generator):
        """Seat customers in turn; ``fresh`` is each pair's weight of a new table.

        The first of a pair opens a table. Later ones come singly, and in larger
        parties once many are seated; a party's newcomers to old tables spread
        in proportion to the weights.
        """
        self.n, self.discount, self.rng = len(customers), discount, rng
        self.customers = customers.astype(np.int64)
        self.owner, self.size = np.arange(self.n), np.ones(self.n, np.int64)
        seated = np.ones(self.n, np.int64)
        while len(busy := np.flatnonzero(seated < self.customers)):
            party = np.minimum(self.customers[busy] - seated[busy], np.maximum(1, seated[busy] // 4))
            old = seated[busy] - discount * np.bincount(self.owner, minlength=self.n)[busy]
            opened = rng.binomial(party, fresh[busy] / (fresh[busy] + old))
            self._join(busy, party - opened)
            self._open(np.repeat(busy, opened))
            seated[busy] += party

    def _open(self, owners: np.ndarray) -> None:
        if len(owners):
            owner = np.concatenate([self.owner, owners])
            order = np.argsort(owner, kind="stable")
            self.owner, self.size = owner[order], np.concatenate([self.size, np.ones(len(owners), np.int64)])[order]

    def _pick(self, pairs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """One table of each pair, in proportion to ``weight``."""
        total = np.concatenate([[0.0], np.cumsum(weight)])
        tables = self.tables()
        last = np.cumsum(tables)[pairs]
        first = last - tables[pairs]
        draw = total[first] + self.rng.random(len(pairs)) * (total[last] - total[first])
        return np.clip(np.searchsorted(total, draw, side="right") - 1, first, last - 1)

    def _join(self, pairs: np.ndarray, party: np.ndarray) -> None:
        weight = np.maximum(self.size - self.discount, 0)
        many = party > 1
        if many.any():
            each = np.zeros(self.n)
            each[pairs[many]] = party[many]
            total = np.bincount(self.owner, weight, self.n)
            share = (weight * (each / np.maximum(total, 1e-9))[self.owner]).astype(np.int64)
            rest = party[many] - np.bincount(self.owner, share, self.n)[pairs[many]].astype(np.int64)
            self.size += share
            np.add.at(self.size, self._pick(pairs[many], weight), rest)
        if (party == 1).any():
            np.add.at(self.size, self._pick(pairs[party == 1], weight), 1)

    def move(self, fresh: np.ndarray) -> None:
        """Take one customer of every pair from its table and seat it anew."""
        pairs = np.flatnonzero(self.customers > 1)
        if not len(pairs):
            return
        left = self._pick(pairs, self.size.astype(float))
        self.size[left] -= 1
        weight = np.where(self.size > 0, self.size - self.discount, 0.0)
        old = np.bincount(self.owner, weight, self.n)[pairs]
        opens = self.rng.random(len(pairs)) * (old + fresh[pairs]) >= old
        np.add.at(self.size, self._pick(pairs[~opens], weight), 1)
        kept = self.size > 0
        self.owner, self.size = self.owner[kept], self.size[kept]
        self._open(pairs[opens])

    def tables(self) -> np.ndarray:
        return np.bincount(self.owner, minlength=self.n)


class Tables:
    """Tables of all pairs; pairs with one customer have one table and are not seated."""

    def __init__(self, customers: np.ndarray, discount: float, fresh: np.ndarray, rng: np.random.Generator):
        self.several = np.flatnonzero(customers > 1)
        self.n = len(customers)
        self.seats = Seating(customers[self.several], discount, fresh[self.several], rng)

    def move(self, fresh: np.ndarray) -> None:
        self.seats.move(fresh[self.several])

    def tables(self) -> np.ndarray:
        out = np.ones(self.n, np.int64)
        out[self.several] = self.seats.tables()
        return out


def sample(
    key: int, pair: np.ndarray, count: np.ndarray, totals: np.ndarray, burn_in: int, samples: int, wide: int = FINE,
    fixed: np.ndarray | None = None,
):
    """After ``burn_in`` sweeps, tables, and words with their customers and tables, for each sample.

    ``totals`` are those of all buckets; they set the weights of new tables.
    ``fixed`` has the probability of each word among all tokens that other
    buckets seat too, and is nan for the others.
    """
    rng = np.random.default_rng([20240401, key])
    root, to_root = _parents(pair, wide)
    d_fine, d_root = discounts(totals)
    uniform = 1 / (totals[VOCABULARY] + 1)
    open_fine = (STRENGTH + d_fine * totals[wide : 2 * wide])[pair % wide]
    open_root = STRENGTH + d_root * totals[T0]
    in_root, root_tables = np.bincount(to_root, minlength=len(root)), np.ones(len(root))
    alone = np.ones(len(root), bool) if fixed is None else np.isnan(fixed)
    fine = None
    for sweep in range(burn_in + samples):
        at_root = (in_root - d_root * root_tables + open_root * uniform) / (STRENGTH + totals[C0])
        if fixed is not None:
            at_root = np.where(alone, at_root, fixed)
        fresh = open_fine * at_root[to_root]
        if fine is None:
            fine = Tables(count, d_fine, fresh, rng)
        for _ in range(MOVES):
            fine.move(fresh)
        tables = fine.tables()
        in_root = np.bincount(to_root, tables, len(root)).astype(np.int64)
        fresh = np.full(len(root), open_root * uniform)
        seats = Tables(np.where(alone, in_root, 1), d_root, fresh, rng)
        for _ in range(MOVES):
            seats.move(fresh)
        root_tables = seats.tables()
        if sweep >= burn_in:
            yield tables, root, in_root, root_tables


def _summed(rows: DataFrame, buckets: int) -> np.ndarray:
    """Sum of the column ``totals`` of all buckets, by way of a square root of their number of tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.column(0):
                own = row.values.to_numpy()
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["totals"])

    some = rows.select("totals").repartition(max(1, int(buckets**0.5)))
    found = [np.array(r["totals"]) for r in some.mapInArrow(add, "totals array<double>").collect()]
    return np.sum(found, axis=0) if found else np.zeros(0)


# A row to where a context's parts meet; the sums of a bucket; its seating; its pairs of hot words.
_SENT = "key int, place int, part int, contexts binary, sums array<double>, state binary, hot binary"
_KINDS = {"key": pa.int32(), "place": pa.int32(), "part": pa.int32(), "contexts": pa.binary(), "sums": pa.list_(pa.float64()), "state": pa.binary(), "hot": pa.binary()}


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kind) for c, kind in _KINDS.items()], names=list(_KINDS))


def _first(gathered: DataFrame, hot: list[int], buckets: int, keys: list[int]) -> DataFrame:
    """What buckets send before the first pass: digests, customers and tables of contexts; sums.

    Sums: what all tokens' restaurant has of words of one bucket, customers,
    then customers of it and training counts of hot words, and customers and
    tables of hot contexts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, pairs, before, hot_at in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                pair, count = _trained(pairs)
                before = _sum(unpack(before, np.uint64)[0])
                wide = max(1, len(before))
                word_at, word, context_at, context = unpack(hot_at, *[np.int64] * 4)
                totals = first_totals(pair, count, wide)
                root, to_root = _parents(pair, wide)
                in_root = np.bincount(to_root, minlength=len(root))
                alone = ~np.isin(root, word_at)
                sums = np.zeros((5, len(hot)))
                many = np.searchsorted(word_at, root[~alone])
                sums[0, word[many]] = in_root[~alone]
                sums[1, word[many]] = np.bincount(to_root, count, len(root))[~alone]
                sums[2, context], sums[3, context] = totals[:wide][context_at], totals[wide : 2 * wide][context_at]
                own = totals[C0:].copy()
                own[0], own[1] = in_root[alone].sum(), alone.sum()
                own[4:] = (in_root[alone] == 1).sum(), (in_root[alone] == 2).sum(), alone.sum()
                rows = [{"key": key, "sums": [*own, float(count.sum()), *sums[:4].ravel()]}]
                cut = np.searchsorted(bucket_of(before, buckets), np.arange(buckets + 1))
                for p in np.flatnonzero(np.diff(cut)):
                    at = slice(cut[p], cut[p + 1])
                    parts = (totals[:wide][at].astype(np.int64), totals[wide : 2 * wide][at].astype(np.int64))
                    rows.append({"key": key, "place": p, "part": keys[p], "contexts": pack(_steps(before[at]), *parts)})
                yield _rows(rows)

    return gathered.select("key", "pairs", "before", "hot").mapInArrow(run, _SENT)


def _exchanged(sent: DataFrame, buckets: int, samples: int, first: bool = False) -> DataFrame:
    """``key, totals``: per bucket, the totals of its contexts over all buckets.

    The parts of a context meet in one task, by digest when they meet first;
    then every bucket knows the number of its contexts there.
    """
    kinds = [np.uint64 if first else np.uint32, *[np.int64] * (1 + samples)]

    def add(rows: list[tuple]) -> pa.RecordBatch:
        parts = [unpack(blob, *kinds) for _, _, blob in rows]
        at = [_sum(x[0]) for x in parts]
        cut = np.cumsum([0, *map(len, at)])
        at = np.concatenate(at)
        if first:
            _, at = np.unique(at, return_inverse=True)
        sums = [np.concatenate(x) for x in list(zip(*parts, strict=True))[1:]]
        for k in range(0 if first else 1, len(sums)):
            sums[k] = np.bincount(at, sums[k]).astype(np.int64)[at]
        blobs = [pack(_steps(at[a:b].astype(np.uint32)), *(x[a:b] for x in sums)) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array(blobs, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "place", "contexts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for part, *row in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if part != current and rows:
                    yield add(rows)
                    rows = []
                current = part
                rows.append(row)
        if rows:
            yield add(rows)

    met = sent.filter("part IS NOT NULL").select("part", "key", "place", "contexts").repartition(buckets, "part")
    back = met.sortWithinPartitions("part").mapInArrow(run, "key int, place int, contexts binary")
    return back.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "contexts"))).alias("totals"))


def _of_contexts(totals: list[dict] | None, samples: int) -> tuple[list[int], list[np.ndarray]]:
    """Places and, over all contexts of a bucket, their numbers there, customers and tables by sample."""
    parts = [unpack(x["contexts"], np.uint32, *[np.int64] * (1 + samples)) for x in totals or []]
    if not parts:
        return [], [np.zeros(1, np.int64)] * (2 + samples)
    spread = np.repeat([x["place"] for x in totals], [len(x[0]) for x in parts])
    return spread, [np.concatenate([_sum(x[0]) for x in parts]), *(np.concatenate(x) for x in list(zip(*parts, strict=True))[1:])]


class Shared:
    """What every bucket knows after a pass: totals of the restaurant of all tokens, probabilities of hot words in it."""

    def __init__(self, totals: np.ndarray, in_root: np.ndarray, seed: int):
        """``totals`` of the words of one bucket each; ``in_root`` are the customers that hot words are."""
        self.totals = totals.copy()
        self.totals[C0] += in_root.sum()
        d_root, held = discounts(self.totals)[1], np.flatnonzero(in_root > 0)
        tables = np.zeros(len(in_root))
        if len(held):
            weight = np.full(len(held), (STRENGTH + d_root * self.totals[T0]) / (totals[VOCABULARY] + 1))
            seats = Tables(in_root[held].astype(np.int64), d_root, weight, np.random.default_rng([20240402, seed]))
            tables[held] = seats.tables()
        self.totals[T0] += tables.sum()
        base = (STRENGTH + d_root * self.totals[T0]) / (totals[VOCABULARY] + 1)
        self.p = (in_root - d_root * tables + base) / (STRENGTH + self.totals[C0])


def _fixed(words: np.ndarray, hot_at: np.ndarray, which: np.ndarray, shared: Shared) -> np.ndarray:
    """Probabilities of hot words among ``words``, nan for others."""
    out = np.full(len(words), np.nan)
    mine = np.isin(words, hot_at)
    out[mine] = shared.p[which[np.searchsorted(hot_at, words[mine])]]
    return out


def _resampled(gathered: DataFrame, totals: DataFrame, shared: Shared, burn_in: int, samples: int, hot: list[int], keys: list[int]) -> DataFrame:
    """What buckets send after a pass: tables of contexts, sums, seatings and pairs of hot words, by sample.

    Sums: customers and tables that all tokens' restaurant has of words of one
    bucket, then customers of it that hot words are, and tables of hot contexts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, pairs, hot_at, of in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                pair, count = _trained(pairs)
                word_at, word, context_at, context = unpack(hot_at, *[np.int64] * 4)
                spread, (number, customers, tables_before) = _of_contexts(of, 1)
                wide = len(number)
                every = np.concatenate([customers, tables_before, shared.totals[C0:]])
                fixed = _fixed(_parents(pair, wide)[0], word_at, word, shared)
                found, sums, state = [], [], []
                for tables, root, in_root, root_tables in sample(key, pair, count, every, burn_in, samples, wide, fixed):
                    found.append(np.bincount(pair % wide, tables, wide).astype(np.int64))
                    alone, own = np.isnan(fixed), np.zeros((2, len(hot)))
                    own[0, word[np.searchsorted(word_at, root[~alone])]] = in_root[~alone]
                    own[1, context] = found[-1][context_at]
                    sums += [in_root[alone].sum(), root_tables[alone].sum(), *own.ravel()]
                    state += [tables.astype(np.uint32), root_tables.astype(np.uint32)]
                w_hot, c_hot = np.isin(pair // wide, word_at), np.isin(pair % wide, context_at)
                both = np.flatnonzero(w_hot & c_hot)
                pick = [word[np.searchsorted(word_at, pair[both] // wide)], context[np.searchsorted(context_at, pair[both] % wide)]]
                pick += [count[both], *(x[both] for x in state[::2])]
                rows = [{"key": key, "sums": sums}, {"key": key, "state": pack(*state)}]
                rows.append({"key": key, "hot": pack(*(x.astype(np.int64) for x in pick))})
                cut = np.searchsorted(spread, np.arange(len(keys) + 1))
                for p in np.flatnonzero(np.diff(cut)):
                    at = slice(cut[p], cut[p + 1])
                    blob = pack(_steps(number[at].astype(np.uint32)), customers[at], *(x[at] for x in found))
                    rows.append({"key": key, "place": p, "part": keys[p], "contexts": blob})
                yield _rows(rows)

    joined = gathered.select("key", "pairs", "hot").join(totals.hint("merge"), "key", "left")
    return stage(joined.select("key", "pairs", "hot", "totals").mapInArrow(run, _SENT), "resampled")


def _sums(sent: DataFrame, buckets: int, size: int) -> np.ndarray:
    found = _summed(sent.filter("sums IS NOT NULL").select(F.col("sums").alias("totals")), buckets)
    return found if len(found) else np.zeros(size)


def _after(sent: DataFrame, first: np.ndarray, samples: int, hot: list[int], buckets: int) -> tuple[list[Shared], np.ndarray]:
    """By sample, what every bucket knows, and the tables of hot contexts."""
    by_sample = _sums(sent, buckets, samples * (2 + 2 * len(hot))).reshape(samples, 2 + 2 * len(hot))
    out = []
    for seed, own in enumerate(by_sample):
        totals = first.copy()
        totals[C0], totals[T0] = own[:2]
        out.append(Shared(totals, own[2 : 2 + len(hot)], seed))
    return out, by_sample[:, 2 + len(hot) :]


def _hot_probabilities(sent: DataFrame, shared: list[Shared], customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Averaged probabilities of hot words after hot words (fewer than (HOT + 2) squared numbers)."""
    n = len(customers)
    p, rows = np.zeros((n, n)), []
    for r in sent.filter("hot IS NOT NULL").select("hot").collect():
        rows.append(unpack(r["hot"], *[np.int64] * (3 + len(shared))))
    for k, own in enumerate(shared):
        d_fine = discounts(own.totals)[0]
        p += own.p[:, None] * ((STRENGTH + d_fine * tables[k]) / (STRENGTH + customers))
        for word, context, count, *by_sample in rows:
            p[word, context] += (count - d_fine * by_sample[k]) / (STRENGTH + customers[context])
    return p / len(shared)


class Predictor:
    """Probabilities of the words of a bucket under one sample."""

    def __init__(self, n_words: int, pair: np.ndarray, count: np.ndarray, state, totals: np.ndarray, fixed: np.ndarray | None = None):
        tables, root, in_root, root_tables = state
        wide = (len(totals) - _SHARED) // 2
        d_fine, d_root = discounts(totals)
        scale = STRENGTH + totals[C0]
        self.at_root = np.full(n_words, (STRENGTH + d_root * totals[T0]) / scale / (totals[VOCABULARY] + 1))
        self.at_root[root] += (in_root - d_root * root_tables) / scale
        if fixed is not None:
            self.at_root = np.where(np.isnan(fixed), self.at_root, fixed)
        scale = STRENGTH + totals[:wide]
        self.back = (STRENGTH + d_fine * totals[wide : 2 * wide]) / scale
        self.own = np.append((count - d_fine * tables) / scale[pair % wide], 0.0)

    def __call__(self, word: np.ndarray, context: np.ndarray, place: np.ndarray) -> np.ndarray:
        """``place`` is the number of the pair (word, context), or the last one if it has none."""
        return self.back[context] * self.at_root[word] + self.own[place]


def _places(pair: np.ndarray, word: np.ndarray, context: np.ndarray, wide: int = FINE) -> np.ndarray:
    if not len(pair):
        return np.zeros(len(word), np.int64)
    wanted = word.astype(np.int64) * wide + context
    at = np.minimum(np.searchsorted(pair, wanted), len(pair) - 1)
    return np.where(pair[at] == wanted, at, len(pair))


def _scored(gathered: DataFrame, totals: DataFrame, states: DataFrame, shared: list[Shared], seen_hot: np.ndarray) -> DataFrame:
    """Packed sums per run and bucket; the ids come with one of a run's rows.

    Parts of ``score`` travel in single precision: seven digits of each.
    """
    id_type = gathered.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n_words, pairs, hot_at, names, ids, docs, tokens, of, state = (batch.column(c)[row].as_py() for c in range(9))
                (every, count), (each, doc) = unpack(pairs, np.int64, np.int64), unpack(tokens, np.uint32, np.uint32)
                every = _sum(every)
                pair, learnt = every[count > 0], count[count > 0]
                run_of, row_of = unpack(docs, np.uint32, np.uint32)
                word_at, which, _, _ = unpack(hot_at, *[np.int64] * 4)
                _, (_, customers, *tables_of) = _of_contexts(of, len(shared))
                wide = len(customers)
                word, context = every // wide, every % wide
                place = _places(pair, word, context, wide)
                root, to_root = _parents(pair, wide)
                p, seats = np.zeros(len(every)), unpack(state, *[np.uint32] * (2 * len(shared)))
                for k, own in enumerate(shared):
                    tables, root_tables = seats[2 * k : 2 * k + 2]
                    in_root = np.bincount(to_root, tables, len(root))
                    all_totals = np.concatenate([customers, tables_of[k], own.totals[C0:]])
                    fixed = _fixed(np.arange(n_words), word_at, which, own)
                    p += Predictor(n_words, pair, learnt, (tables, root, in_root, root_tables), all_totals, fixed)(word, context, place)
                seen = np.bincount(word, count, n_words)
                seen[word_at] = seen_hot[which]
                n = len(run_of)
                of_pair = (np.log10(seen + 1)[word], np.log10(np.maximum(p, 1e-300) / len(shared)), (seen == 0)[word])
                sums = [np.bincount(doc, np.repeat(x, each), n).astype(float) for x in of_pair]
                cut = np.searchsorted(run_of, np.arange(len(names) + 1))
                blobs = [
                    pack(
                        np.diff(row_of[a:b], prepend=np.uint32(0)), sums[0][a:b],
                        sums[1][a:b].astype(np.float32), sums[2][a:b].astype(np.uint32),
                    )
                    for a, b in zip(cut[:-1], cut[1:], strict=True)
                ]
                kind = batch.schema.field("ids").type.value_type
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(ids, kind), pa.array(blobs, pa.binary())],
                    names=["run", "ids", "sums"],
                )

    wanted = ["words", "pairs", "hot", "runs", "ids", "docs", "tokens"]
    joined = gathered.select("key", *wanted).join(totals.hint("merge"), "key", "left").join(states.hint("merge"), "key", "left")
    return joined.select(*wanted, "totals", "state").mapInArrow(run, f"run binary, ids {id_type}, sums binary")


def _per_document(scored: DataFrame) -> DataFrame:
    """Sums of each run's documents over all buckets."""
    id_type = scored.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, parts, kind = None, None, [], None

        def done() -> pa.RecordBatch:
            if ids is None:
                raise ValueError("a run without its ids")
            sums = np.zeros((3, len(ids)))
            for blob in parts:
                step, base, score, unknown = unpack(blob, np.uint32, np.float64, np.float32, np.uint32)
                at = np.cumsum(step)
                for k, x in enumerate((base, score, unknown)):
                    sums[k][at] += x
            columns = [pa.array(ids, kind.value_type), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2].astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["id", "base", "score", "unknown"])

        for batch in batches:
            kind = batch.schema.field("ids").type
            for name, own, blob in zip(*(batch.column(c) for c in range(3)), strict=True):
                name = name.as_py()
                if name != current and parts:
                    yield done()
                    ids, parts = None, []
                current = name
                ids = own.as_py() if own.is_valid else ids
                parts.append(blob.as_py())
        if parts:
            yield done()

    together = scored.repartition("run").sortWithinPartitions("run")
    return together.mapInArrow(run, f"id {id_type}, base double, score double, unknown bigint")


def _hot_sums(rows: DataFrame, hot: list[int], p: np.ndarray, seen: np.ndarray) -> DataFrame:
    """Per document: tokens, and the sums over its hot words after hot words."""
    id_type = rows.schema["id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast((np.array(hot, np.uint64), np.log10(p), np.log10(seen + 1), seen > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, log_p, log_seen, known = shared.value
        for batch in batches:
            for first, n, token, before, doc in runs(batch.column(1)):
                size = np.bincount(doc, minlength=n)
                (place, is_hot), (above, follows) = _find(common, token), _find(common, before)
                both = is_hot & follows
                place, above, doc = place[both], above[both], doc[both]
                sums = [np.bincount(doc, x, n).astype(float) for x in (log_seen[place], log_p[place, above], ~known[place])]
                columns = [
                    batch.column(0).slice(first, n), pa.array(size), pa.array(sums[0]), pa.array(sums[1]),
                    pa.array(sums[2].astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "tokens", "base", "score", "unknown"])

    return rows.mapInArrow(run, f"id {id_type}, tokens bigint, base double, score double, unknown bigint")


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigrams) and ``score``, both log10 probabilities.

    The model learns from the rows where the column expression ``held_out`` is
    false and scores all.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held")
    )
    hot, keys = hot_words(rows), _even_keys(spark, buckets)
    gathered, table, path = _stored(_gathered(_packed(rows, hot, buckets, keys), hot, buckets), buckets)
    sent = stage(_first(gathered, hot, buckets, keys), "sent")
    sums, n_hot = _sums(sent, buckets, _SHARED + 1 + 4 * len(hot)), len(hot)
    first, n = sums[:_SHARED], sums[_SHARED]
    in_root, seen, customers, _ = sums[_SHARED + 1 :].reshape(4, n_hot)
    first[ONCE + 2] += (in_root == 1).sum()
    first[ONCE + 3] += (in_root == 2).sum()
    first[VOCABULARY] += (seen > 0).sum()
    vocabulary = first[VOCABULARY]
    # One pass settles the totals, the next samples.
    settled = _resampled(gathered, _exchanged(sent, buckets, 1, True), Shared(first, in_root, 0), 0, 1, hot, keys)
    known = _after(settled, first, 1, hot, buckets)[0][0]
    sampled = _resampled(gathered, _exchanged(settled, buckets, 1), known, BURN_IN, SAMPLES, hot, keys)
    shared, tables = _after(sampled, first, SAMPLES, hot, buckets)
    p = _hot_probabilities(sampled, shared, customers, tables)
    states = sampled.filter("state IS NOT NULL").select("key", "state")
    scored = _scored(gathered, _exchanged(sampled, buckets, SAMPLES), states, shared, seen)
    parts = stage(_per_document(scored), "parts").select(
        "id", F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("tokens"), "base", "score", "unknown"
    )
    drop_staged(sent, settled, sampled)
    spark.sql(f"DROP TABLE {table}")
    delete_folder(spark, path)
    local = _hot_sums(rows.select("id", "text"), hot, p, seen).withColumn("rows", F.lit(1).cast("bigint"))
    summed = local.unionByName(parts).groupBy("id").agg(*[F.sum(c).alias(c) for c in ("rows", "tokens", "base", "score", "unknown")])
    marks = rows.select("id", "held")
    mean = lambda c: F.col(c) / F.col("rows")
    out = summed.select(
        "id",
        (F.col("tokens") / F.col("rows")).cast("bigint").alias("n_tokens"),
        ((F.col("tokens") - F.col("unknown")) / F.col("rows")).cast("bigint").alias("n_known"),
        F.lit(int(n)).cast("bigint").alias("train_tokens"),
        (mean("base") - mean("tokens") * F.lit(float(np.log10(n + vocabulary + 1)))).alias("base_score"),
        mean("score").alias("score"),
    )
    joined = marks.join(out.withColumnRenamed("id", "own"), F.col("id").eqNullSafe(F.col("own")))
    return joined.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
