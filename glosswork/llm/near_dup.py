"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of word shingles. Equal sets merge first. Every set gets
minwise tokens; a tree starts with all sets in one node and branches a node
by the tokens at positions that the node's path selects: one position, and with
probability 1/threshold - 1 a second, so that a similar pair is expected to
stay together in one child at every level. Nodes of at most ``LEAF`` sets stop
branching and are compared exhaustively by sketches of 256 tokens at four bits;
pairs that may reach the threshold (but for a chance of 1 in 4,000) are
confirmed on the full sets. Independent trees repeat this: with 16 trees a pair
at the threshold is missed about once in 1,000 times when its nodes branch
eight levels, far less in smaller nodes.

Only (path, id, signs) rows take part in branching, counts per node merge per
task, and nodes of one set leave at once. Nodes of at most ``WHOLE`` sets get
their tokens and are branched to the end in one task each, as nothing outside a
node decides what is below it; only larger ones need a shuffle per level. Large nodes are measured before they
are branched: the signs are ``SIGNS`` bits of the tokens, and the squares of
their sums give the mean similarity of two sets of the node. Copies that each
share the part ``threshold`` of one text have that squared; near it (``ALIKE``)
the node is a hot group of near copies, which more branching would only repeat
in every child: it ends, by itself and at any level. Ending early loses no
pair, as the node is then compared whole. Such a node
is ordered by further tokens, dealt over tasks by range, and every set is
compared with the ``LEAF`` that follow it, in another order in every tree. That
only joins most of a group cheaply: afterwards large nodes that share sets form
a group, and all sets of a group that are not yet in one component are compared
in blocks, with the full sets in the same task. Sets outside the largest
component of a group meet every set of it once, so the cost is their number
times the size of the group; only a forest of confirmed links leaves a task.

Joins whose sides grow with the corpus are sort-merge joins at every size, and
adaptive execution splits their hot keys.

All candidate pairs of one task first shrink to a spanning forest of the most
similar ones. When some of its links fail on the full sets, the members of small
nodes that still have a candidate in another component meet once more, with
their full sets in the same task, so the forest loses no link: what is shuffled
follows the members of nodes, not their pairs, and only confirmed links leave.
Large nodes need no such round, as their groups are compared whole.

Defined results: null or empty texts and texts without words have no shingles
and are linked with nothing; texts with fewer words than a shingle have the
whole sequence as their one shingle; equal sets share a component; repeated
rows are each returned; a null id is linked with nothing and kept; an empty
table gives an empty result; other columns are ignored. Shingles are compared
by 64-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from glosswork.llm import words as w
from glosswork.llm.components import components, measured
from glosswork.session import drop_staged, stage

TOKENS = 128  # of which paths choose
SKETCH = 256  # tokens of the sketch, four bits each
TREES = 16
LEVELS = 12
LEAF = 64
SIGNS = 64
ALIKE = 0.85  # of the threshold squared; strangers in a node and the estimate take the rest
WHOLE = 16384  # sets of a node that one task branches to its end, at 512 bytes each
BLOCK = 1024  # sets of a group on each side of a comparison
ORDER = 8
SURE = 3.5
LIKELY = 1.5
_U = np.uint64
_random = np.random.default_rng(20240301)
_XOR = _random.integers(0, 1 << 32, SKETCH, dtype=np.uint32)
_ODD = _random.integers(0, 1 << 31, SKETCH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_ORDER_AT = _random.integers(0, TOKENS, (1024, ORDER))


def shingles(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of rows: the first row, distinct shingle digests, offsets per row.

    The digests of a row are sorted.
    """
    for row, data, offsets in w.chunks(texts):
        starts, ends, doc = w.find(data, offsets)
        n_docs = len(offsets) - 1
        counts = np.bincount(doc, minlength=n_docs)
        digest = w.digests(data, starts, ends)
        if len(digest) >= width:
            n = len(digest) - width + 1
            whole = doc[:n] == doc[width - 1 :]
            made = np.zeros(n, np.uint64)
            for i in range(width):
                made += digest[i : n + i] * _PLACE[i]
            made, owner = w.mix(made[whole]), doc[:n][whole]
        else:
            made, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        first = np.concatenate([[0], np.cumsum(counts)])
        sets = np.bincount(owner, minlength=n_docs)
        at = np.concatenate([[0], np.cumsum(sets)])
        parts, lengths = [], np.zeros(n_docs, np.int64)
        for d in range(n_docs):
            if sets[d]:
                own = np.sort(made[at[d] : at[d + 1]])
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif counts[d]:
                few = digest[first[d] : first[d + 1]]
                terms = np.append(few * _PLACE[: len(few)], _PLACE[63:] * _U(len(few)))
                own = w.mix(terms.sum(dtype=np.uint64, keepdims=True))
            else:
                continue
            parts.append(own)
            lengths[d] = len(own)
        joined = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        yield row, joined, np.concatenate([[0], np.cumsum(lengths)])


def minwise(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of SKETCH minwise tokens for the sets that are not empty."""
    full = offsets[:-1][offsets[:-1] < offsets[1:]]
    out = np.zeros((len(full), SKETCH), np.uint32)
    if len(full):
        x = (sets >> _U(32)).astype(np.uint32)
        for j in range(SKETCH):
            out[:, j] = np.minimum.reduceat((x ^ _XOR[j]) * _ODD[j], full)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Fixed-length rows of bytes as a binary array."""
    rows = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _rows(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Rows of a binary array of equal lengths."""
    if not len(column):
        return np.zeros((0, width), dtype)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def describe(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id, n, digest, tokens, sketch`` per row; the last three null for empty sets."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets, offsets in shingles(batch.column(1), width):
                size = np.diff(offsets)
                tokens = minwise(sets, offsets)
                place = pa.array(np.cumsum(size > 0) - 1, mask=size == 0)
                nibble = ((tokens * np.uint32(0x9E3779B1)) >> np.uint32(28)).astype(np.uint8)
                sketch = nibble[:, ::2] << 4 | nibble[:, 1::2]
                tokens = tokens[:, :TOKENS]
                digest = [
                    hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() if b > a else None
                    for a, b in zip(offsets[:-1], offsets[1:], strict=True)
                ]
                columns = [
                    batch.column(0).slice(row, len(size)),
                    pa.array(size),
                    pa.array(digest, pa.binary()),
                    _binary(tokens).take(place) if len(tokens) else pa.nulls(len(size), pa.binary()),
                    _binary(sketch).take(place) if len(tokens) else pa.nulls(len(size), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "digest", "tokens", "sketch"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, n bigint, digest binary, tokens binary, sketch binary")


def _children(path: np.ndarray, tokens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Child paths and the rows they come from; the path alone selects the positions."""
    rows = np.arange(len(path))
    draw = w.mix(path + _PLACE[0])
    second = (draw >> _U(40)).astype(np.float64) / (1 << 24) < 1 / threshold - 1
    one = (draw % _U(TOKENS)).astype(np.int64)
    two = (one + 1 + ((draw >> _U(16)) % _U(TOKENS - 1)).astype(np.int64)) % TOKENS
    rows = np.concatenate([rows, rows[second]])
    at = np.concatenate([one, two[second]])
    token = tokens[rows, at].astype(np.uint64)
    return w.mix(path[rows] * _PLACE[1] + token * _PLACE[2] + at.astype(np.uint64) * _PLACE[3]), rows


def _signs(tokens: np.ndarray) -> np.ndarray:
    """One bit of each of the first SIGNS tokens, as a number per set."""
    bits = ((tokens[:, :SIGNS] * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(">i8")[:, 0].astype(np.int64)


def _branch(rows: DataFrame, threshold: float, trees: int | None) -> DataFrame:
    """Children of nodes ``path, id, tree, tokens``, or of the root of every tree."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            named = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023, E731
            ids, tokens = named("id"), _rows(named("tokens"), np.uint32, TOKENS)
            n = len(ids)
            signs = _signs(tokens)
            if trees is None:
                each = [(named("path").to_numpy().view(np.uint64), named("tree").to_numpy())]
            else:
                roots = w.mix(np.arange(1, trees + 1, dtype=np.uint64) * _PLACE[4])
                each = [(np.full(n, root), np.full(n, t)) for t, root in enumerate(roots)]
            for path, tree in each:
                made, taken = _children(path, tokens, threshold)
                columns = [
                    pa.array(made.view(np.int64)),
                    ids.take(pa.array(taken)),
                    pa.array(tree[taken].astype(np.int32)),
                    pa.array(signs[taken]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "id", "tree", "signs"])

    return rows.mapInArrow(run, f"path bigint, id {id_type}, tree int, signs bigint")


def _likeness(large: DataFrame) -> DataFrame:
    """``path, like``: the mean similarity of two sets of a node, estimated from sums of signs.

    The product of two signs is 1 where the tokens agree and 0 on average
    elsewhere; over all pairs it is the square of the sum of the signs.
    """
    sums = [F.sum(F.getbit("signs", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(SIGNS)]
    n = F.col("n").cast("double")
    square = F.aggregate(
        F.array(*[F.col(f"s{i}") for i in range(SIGNS)]), F.lit(0.0), lambda sum_, x: sum_ + (2 * x - n) * (2 * x - n)
    )
    nodes_ = large.groupBy("path").agg(F.count(F.lit(1)).alias("n"), *sums)
    return nodes_.select("path", ((square / SIGNS - n) / (n * (n - 1))).alias("like"))


def _alike(signs: np.ndarray) -> float:
    """The same estimate over the sets of one node."""
    n = len(signs)
    ones = np.unpackbits(signs.astype(">i8").view(np.uint8).reshape(n, -1), axis=1).sum(axis=0, dtype=np.int64)
    return (((2 * ones - n) ** 2).sum() / SIGNS - n) / (n * (n - 1))


def _grown(
    path: np.ndarray, tokens: np.ndarray, threshold: float, level: int, levels: int, leaf: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The nodes below one node: their paths, rows and whether they are large.

    ``path`` is that of the node, once for every row of ``tokens``.
    """
    signs = _signs(tokens)
    open_ = [(path, np.arange(len(path)))]
    while open_:
        ended, going = [], []
        for own, rows in open_:
            if level >= levels or _alike(signs[rows]) >= ALIKE * threshold * threshold:
                yield own, rows, np.ones(len(rows), bool)
            else:
                going.append((own, rows))
        open_, level = [], level + 1
        for own, rows in going:
            made, taken = _children(own, tokens[rows], threshold)
            order = np.argsort(made, kind="stable")
            made, taken = made[order], rows[taken[order]]
            cut = np.append(np.flatnonzero(np.concatenate([[True], made[1:] != made[:-1]])), len(made))
            size = np.repeat(np.diff(cut), np.diff(cut))
            small = (size > 1) & (size <= leaf)
            ended.append((made[small], taken[small]))
            open_ += [(made[a:b], taken[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True) if b - a > leaf]
        if ended:
            own, rows = (np.concatenate(x) for x in zip(*ended, strict=True))
            yield own, rows, np.zeros(len(rows), bool)


def _below(middle: DataFrame, threshold: float, levels: int, leaf: int) -> DataFrame:
    """Rows ``path, id, tree, dense`` of the nodes below those of ``path, id, tree, level, tokens``, each in one task."""
    id_type = middle.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(node: pa.Table) -> Iterator[pa.RecordBatch]:
            node = node.combine_chunks()
            path, tokens = node["path"].to_numpy().view(np.uint64), _rows(node["tokens"].combine_chunks(), np.uint32, TOKENS)
            for made, rows, dense in _grown(path, tokens, threshold, node["level"][0].as_py(), levels, leaf):
                taken = node.select(["id", "tree"]).take(pa.array(rows)).combine_chunks()
                columns = [pa.array(made.view(np.int64)), *(c.combine_chunks() for c in taken.columns), pa.array(dense)]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "id", "tree", "dense"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            path = rows["path"].to_numpy()
            cut = np.append(np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]])), len(path))
            for a, b in zip(cut[:-2], cut[1:-1], strict=True):
                yield from done(rows.slice(a, b - a))
            held = rows.slice(cut[-2])
        if held is not None:
            yield from done(held)

    together = middle.repartition("path").sortWithinPartitions("path")
    return together.mapInArrow(run, f"path bigint, id {id_type}, tree int, dense boolean")


def nodes(
    sets: DataFrame, threshold: float, trees: int = TREES, levels: int = LEVELS, leaf: int = LEAF, whole: int = WHOLE
) -> tuple[DataFrame, DataFrame | None]:
    """Rows ``path, id, tree`` of the leaves, and of large nodes that are branched no further.

    Nodes of more than ``whole`` sets are branched level by level over all
    tasks; smaller ones, with all below them, in one task each.
    """
    tokens = sets.select("id", "tokens")
    rows = _branch(tokens, threshold, trees)
    leaves: list[DataFrame] = []
    middle: list[DataFrame] = []
    dense: list[DataFrame] = []
    for level in range(1, levels + 1):
        rows = stage(rows, "paths")
        sized = rows.groupBy("path").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        sized = rows.join(sized.hint("merge"), "path")
        fits = (F.col("members") > leaf) & (F.col("members") <= whole)
        sized, seen = measured(sized, "sized", large=F.count_if(F.col("members") > max(leaf, whole)), fits=F.count_if(fits))
        drop_staged(rows)
        leaves.append(sized.filter(F.col("members") <= leaf).select("path", "id", "tree"))
        if seen["fits"]:
            middle.append(sized.filter(fits).select("path", "id", "tree", F.lit(level).alias("level")))
        if not seen["large"]:
            break
        large = sized.filter(F.col("members") > max(leaf, whole))
        if level == levels:
            dense.append(large.select("path", "id", "tree"))
            break
        hot = F.col("like") >= ALIKE * threshold * threshold
        large = large.join(_likeness(large).hint("merge"), "path").select("path", "id", "tree", hot.alias("hot"))
        large, seen = measured(large, "large", hot=F.count_if("hot"), going=F.count_if(~F.col("hot")))
        if seen["hot"]:
            dense.append(large.filter("hot").select("path", "id", "tree"))
        if not seen["going"]:
            break
        going = large.filter(~F.col("hot")).select("path", "id", "tree")
        rows = _branch(going.join(tokens.hint("merge"), "id"), threshold, None)
    if middle:
        below = _below(_union(middle).join(tokens.hint("merge"), "id"), threshold, levels, leaf)
        below, seen = measured(below, "below", dense=F.count_if("dense"))
        leaves.append(below.filter(~F.col("dense")).select("path", "id", "tree"))
        if seen["dense"]:
            dense.append(below.filter("dense").select("path", "id", "tree"))
    return _union(leaves), _union(dense) if dense else None


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


class _Forest:
    """Union-find over the ids of one task."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        root = x
        while (up := self.up.get(root, root)) != root:
            root = up
        while (up := self.up.get(x, x)) != root:
            self.up[x], x = root, up
        return root

    def link(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[b] = a
        return a != b


def _least(threshold: float, margin: float = SURE) -> float:
    """Agreeing tokens of the sketches of a pair that may reach the threshold."""
    agree = threshold + (1 - threshold) / 16
    return SKETCH * (agree - margin * (agree * (1 - agree) / SKETCH) ** 0.5)


def _similar(path, code, sizes, sketch, label, new, threshold: float, leaf: int) -> tuple[np.ndarray, ...]:
    """Rows ``left, right`` of one path that may reach the threshold, and their agreeing tokens.

    Rows before ``new`` were compared with each other before. ``code`` numbers
    the ids; ``label`` rules out pairs inside one component.
    """
    least = _least(threshold)
    found = [(np.zeros(0, np.int64),) * 3]
    for step in range(1, leaf + 1):
        if step >= len(path):
            break
        left = np.flatnonzero(path[:-step] == path[step:])
        if not len(left):
            break
        left = left[left + step >= new]
        right = left + step
        fit = np.minimum(sizes[left], sizes[right]) >= threshold * np.maximum(sizes[left], sizes[right])
        fit &= code[left] != code[right]
        if label is not None:
            fit &= label[left] != label[right]
        left, right = left[fit], right[fit]
        for lo in range(0, len(left), 8192):
            a, b = left[lo : lo + 8192], right[lo : lo + 8192]
            apart = sketch[a] ^ sketch[b]
            same = ((apart & 0xF0) == 0).sum(axis=1) + ((apart & 0x0F) == 0).sum(axis=1)
            hit = same >= least
            found.append((a[hit], b[hit], same[hit]))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> list[int]:
    """Numbers of the links of a forest over nodes 0 to n - 1; earlier links come first."""
    up, taken = np.arange(n), []
    for start in range(0, len(a), max(n, 1)):
        while ((above := up[up]) != up).any():
            up = above
        run = slice(start, start + n)
        open_ = np.flatnonzero(up[a[run]] != up[b[run]]) + start
        for i in open_:
            x, y = a[i], b[i]
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            if x != y:
                up[y] = x
                taken.append(int(i))
    return taken


def _members(batches: Iterator[pa.RecordBatch], leaf: int) -> Iterator[tuple]:
    """Runs of rows sorted by path with the number of rows that were in the run before.

    The last rows of a run's last path, ``leaf`` at most, come again with the next.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        new = held.num_rows if held is not None else 0
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        path = rows["path"].to_numpy()
        yield rows, path, _rows(rows["sketch"].combine_chunks(), np.uint8, SKETCH // 2), new
        tail = min(leaf, len(path))
        while path[len(path) - tail] != path[-1]:
            tail -= 1
        held = rows.slice(len(path) - tail)


def candidates(members: DataFrame, threshold: float, leaf: int = LEAF) -> DataFrame:
    """A forest of pairs ``a, b`` of the rows of equal paths, read in the order given.

    Pairs that most likely reach the threshold come first, in the order of
    their ids, so that all trees link the sets of a group to the same few.
    """
    id_type = members.schema["id"].dataType.simpleString()
    likely = int(np.ceil(_least(threshold, -LIKELY)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, path, sketch, new in _members(batches, leaf):
            ids, code = np.unique(rows["id"].to_numpy(), return_inverse=True)
            left, right, same = _similar(path, code, rows["n"].to_numpy(), sketch, None, new, threshold, leaf)
            a, b = np.minimum(code[left], code[right]), np.maximum(code[left], code[right])
            order = np.lexsort((b, a, -np.minimum(same, likely)))
            a, b = a[order], b[order]
            taken = _spanning(a, b, len(ids))
            kind = rows.schema.field("id").type
            columns = [pa.array(ids[side[taken]], kind) for side in (a, b)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return members.mapInArrow(run, f"a {id_type}, b {id_type}")


def _open(members: DataFrame, threshold: float, leaf: int = LEAF) -> DataFrame:
    """``path, id, n, label, sketch`` of the rows with a candidate of another label in their path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, path, sketch, new in _members(batches, leaf):
            code = [np.unique(rows[name].to_numpy(), return_inverse=True)[1] for name in ("id", "label")]
            left, right, _ = _similar(path, code[0], rows["n"].to_numpy(), sketch, code[1], new, threshold, leaf)
            yield from rows.take(pa.array(np.unique(np.concatenate([left, right])))).to_batches()

    return members.mapInArrow(run, members.schema)


def confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """``a, b, linked`` with the exact similarity of the full sets, row by row in Spark."""
    left = full.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = full.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    both = both.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("c"))
    return both.select("a", "b", (100 * F.col("c") >= percent * (F.col("n") + F.col("m") - F.col("c"))).alias("linked"))


def _full_sets(docs: DataFrame, id_col: str, text_col: str, width: int, ids: DataFrame) -> DataFrame:
    """``id, shingles`` of the rows with these ids."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets, offsets in shingles(batch.column(1), width):
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(sets.view(np.int64)))
                columns = [batch.column(0).slice(row, len(lists)), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "shingles"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(ids.hint("merge"), "id", "left_semi").mapInArrow(run, f"id {id_type}, shingles array<bigint>")


def _groups(dense: DataFrame) -> DataFrame:
    """``id, grp``: the sets of large nodes, nodes that share a set in one group."""
    first = dense.groupBy("path").agg(F.min("id").alias("first"))
    met = dense.select("path", "id").join(first.hint("merge"), "path").select("id", "first").distinct()
    return components(met, "id", "first").select(F.col("node").alias("id"), F.col("component").alias("grp"))


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Rows ``id, grp, label`` by pairs of blocks ``grp, u, v``.

    Side 0 holds the sets outside the largest component of the group, side 1
    all sets; every set of one side meets every set of the other in one block.
    """
    sizes = members.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("grp").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most")
    )
    rows = members.join(sizes.filter("all > most").hint("merge"), "grp")
    at = F.xxhash64("id")
    many = lambda n: F.ceil(n / block).cast("int")
    u, v = many(F.col("all") - F.col("most")), many(F.col("all"))
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    few = rows.filter("label <> main").select("grp", F.pmod(at, u).cast("int").alias("u"), each(v).alias("v"), F.lit(0).alias("side"), "id", "label")
    every = rows.select("grp", each(u).alias("u"), F.pmod(at, v).cast("int").alias("v"), F.lit(1).alias("side"), "id", "label")
    return few.unionByName(every)


def _linked(blocks: DataFrame, threshold: float, percent: int) -> DataFrame:
    """Links ``a, b`` between different labels, confirmed on the full sets: a forest per task.

    Rows ``grp, u, v, side, id, label, n, sketch, shingles``, sorted by the first
    four. Rows of side 1 meet those of side 0, rows of side 2 all before them.
    """
    id_type = blocks.schema["id"].dataType.simpleString()
    least = _least(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, left, trees = None, [], _Forest()
        for batch in batches:
            links = []
            sketch = _rows(batch.column(7), np.uint8, SKETCH // 2)
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            side, ids, label = (batch.column(i).to_pylist() for i in (3, 4, 5))
            sizes, sets = batch.column(6).to_numpy(), batch.column(8)
            for i in range(batch.num_rows):
                if keys[i] != key:
                    key, left, packed = keys[i], [], None
                if side[i] == 0:
                    left.append((ids[i], label[i], sizes[i], sketch[i], sets[i].values.to_numpy()))
                    packed = None
                    continue
                if side[i] == 2:
                    left.append((ids[i], label[i], sizes[i], sketch[i], sets[i].values.to_numpy()))
                if len(left) < side[i]:
                    continue
                if packed is None or side[i] == 2:
                    packed = np.stack([x[3] for x in left]), np.array([x[2] for x in left])
                apart = packed[0] ^ sketch[i]
                same = ((apart & 0xF0) == 0).sum(axis=1) + ((apart & 0x0F) == 0).sum(axis=1)
                fit = np.minimum(packed[1], sizes[i]) >= threshold * np.maximum(packed[1], sizes[i])
                own = None
                hits = np.flatnonzero(fit & (same >= least))
                for h in hits[np.argsort(-same[hits], kind="stable")]:
                    other, named, n, _, theirs = left[h]
                    if named == label[i] or trees.find(named) == trees.find(label[i]):
                        continue
                    own = sets[i].values.to_numpy() if own is None else own
                    common = len(np.intersect1d(own, theirs, assume_unique=True))
                    if 100 * common >= percent * (len(own) + len(theirs) - common):
                        trees.link(named, label[i])
                        links.append((min(other, ids[i]), max(other, ids[i])))
            kind = batch.schema.field("id").type
            columns = {"a": [x[0] for x in links], "b": [x[1] for x in links]}
            yield pa.RecordBatch.from_pydict(columns, schema=pa.schema([("a", kind), ("b", kind)]))

    return blocks.mapInArrow(run, f"a {id_type}, b {id_type}")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    trees: int = TREES,
    levels: int = LEVELS,
    leaf: int = LEAF,
    block: int = BLOCK,
) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` (smallest id linked), ``kept``.

    Documents are linked when 100 * |intersection| >= percent * |union|.
    """
    threshold = percent / 100
    described = stage(describe(docs, id_col, text_col, width), "described")
    sets = described.filter("n > 0 AND id IS NOT NULL")
    classes = stage(sets.groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    chosen = sets.join(classes.hint("merge"), [sets.digest == classes.digest, sets.id == classes.rep], "left_semi")
    chosen = stage(chosen.select("id", "n", "tokens", "sketch"), "chosen")

    leaves, dense = nodes(chosen, threshold, trees, levels, leaf)
    sketches = chosen.select("id", "n", "sketch")
    leaves = stage(leaves.join(sketches.hint("merge"), "id").select("path", "id", "n", "sketch"), "leaves")
    dense = stage(_ordered(dense, chosen), "dense") if dense is not None else None

    pairs = candidates(leaves.repartition("path").sortWithinPartitions("path", "id"), threshold, leaf)
    if dense is not None:
        ordered = dense.repartitionByRange("path", "place", "id").sortWithinPartitions("path", "place", "id")
        pairs = pairs.unionByName(candidates(ordered.select("path", "id", "n", "sketch"), threshold, leaf))
    pairs = stage(pairs.distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    full = _full_sets(docs, id_col, text_col, width, ids)
    checked, seen = measured(confirm(pairs, stage(full, "full"), percent), "checked", failed=F.count_if(~F.col("linked")))
    links = checked.filter("linked").select("a", "b")
    named = components(links)
    label = named.select(F.col("node").alias("id"), F.col("component").alias("label"))
    more: list[tuple[DataFrame, dict]] = []
    if seen["failed"]:
        rows = leaves.join(label.hint("merge"), "id", "left").withColumn("label", F.coalesce("label", "id"))
        rows = rows.select("path", "id", "n", "label", "sketch").repartition("path").sortWithinPartitions("path", "id")
        rows = stage(_open(rows, threshold, leaf), "open")
        sets_of = _full_sets(docs, id_col, text_col, width, rows.select("id").distinct()).distinct()
        rows = rows.join(sets_of.hint("merge"), "id")
        none = F.lit(0)
        rows = rows.select(F.col("path").alias("grp"), none.alias("u"), none.alias("v"), F.lit(2).alias("side"), "id", "label", "n", "sketch", "shingles")
        rows = rows.repartition("grp").sortWithinPartitions("grp", "u", "v", "side", "id")
        more.append(measured(_linked(rows, threshold, percent), "linked", n=F.count(F.lit(1))))
    if dense is not None:
        members = stage(_groups(dense), "groups").join(label.hint("merge"), "id", "left")
        members = stage(members.withColumn("label", F.coalesce("label", "id")), "members")
        blocks = stage(_blocks(members, block), "blocks")
        sides = _full_sets(docs, id_col, text_col, width, blocks.select("id").distinct()).distinct()
        sides = stage(sides.join(sketches.hint("merge"), "id"), "sides")
        blocks = blocks.join(sides.hint("merge"), "id")
        blocks = blocks.select("grp", "u", "v", "side", "id", "label", "n", "sketch", "shingles")
        blocks = blocks.repartition("grp", "u", "v").sortWithinPartitions("grp", "u", "v", "side", "id")
        more.append(measured(_linked(blocks, threshold, percent), "linked", n=F.count(F.lit(1))))
    found = [links for links, seen in more if seen["n"]]
    if found:
        known = named.select(F.col("node").alias("a"), F.col("component").alias("b"))
        named = components(_union([known, *found]))

    named = classes.join(named, classes.rep == named.node, "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    out = described.select("id", "n", "digest").join(named.hint("merge"), "digest", "left")
    component = F.coalesce(F.when(F.col("id").isNotNull(), F.col("component")), F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _ordered(large: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of large nodes with a place among their node by further tokens."""
    id_type = chosen.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _rows(batch.column(5), np.uint32, TOKENS)
            at = _ORDER_AT[batch.column(2).to_numpy() % len(_ORDER_AT)]
            place = tokens[np.arange(len(tokens))[:, None], at].astype(">u4")
            columns = [*batch.columns[:2], batch.column(3), batch.column(4), _binary(place)]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "id", "n", "sketch", "place"])

    rows = large.join(chosen.hint("merge"), "id").select("path", "id", "tree", "n", "sketch", "tokens")
    return rows.mapInArrow(run, f"path bigint, id {id_type}, n bigint, sketch binary, place binary")
