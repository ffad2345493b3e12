import random

import pytest

from glosswork.llm import decontaminate as d


def edit_distance_in(pattern, text):
    """Fewest edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def fold(text):
    return "".join(c.lower() if c.isascii() else c for c in text).replace("\n", " ").replace("\t", " ")


def windows(text, window=d.WINDOW, stride=d.STRIDE):
    starts = list(range(0, max(1, len(text) - window + 1), stride))
    if len(text) > window and starts[-1] != len(text) - window:
        starts.append(len(text) - window)
    return [text[s : s + window] for s in starts]


def brute(rows, items):
    out = set()
    for i, text in rows:
        for item, passage in items:
            for piece in windows(fold(passage or "")) if passage else []:
                budget = int(len(piece) * d.RATE)
                if text and edit_distance_in(piece, fold(text)) <= budget:
                    out.add((i, item))
    return out


def words(rng, n):
    return " ".join("".join(rng.choice(["th", "on", "er", "é", "an"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(max(1, len(out)))
        out[at : at + rng.choice((0, 1))] = rng.choice(("", "x", "yz"))[:1]
    return "".join(out)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, start string")


def test_matches_brute_force(spark, docs):
    rng = random.Random(11)
    items = [(i, words(rng, n)) for i, n in enumerate((8, 15, 20, 30, 2, 1))] + [(6, None), (7, ""), (8, "abcdefghijk")]
    rows = []
    for i in range(60):
        passage = items[i % 6][1]
        cut = passage if i % 3 else passage[: max(1, len(passage) * 3 // 4)]
        text = words(rng, rng.randint(0, 20)) + " " + edited(rng, cut, i // 10) + words(rng, rng.randint(0, 20))
        rows.append((i, text if i % 7 else passage.upper().replace(" ", "\n")))
    rows += [(100, None), (101, ""), (102, "xx abcdefghijk"), (103, "xxabcdefghij k"), (104, items[3][1]), (104, items[3][1])]
    got = d.find_passages(docs(rows), items_frame(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(rows, items)
    assert sum(r.doc_id == 104 and r.item_id == 3 for r in got) == 2
    full = next(r for r in got if (r.doc_id, r.item_id) == (104, 3))
    assert (full.start, full.end, full.edits, full.windows) == (0, len(items[3][1]), 0, full.item_windows)


def test_alignment_is_banded_edit_distance():
    import numpy as np

    rng = random.Random(2)
    for _ in range(40):
        pattern = words(rng, 5)
        text = words(rng, rng.randint(0, 4)) + edited(rng, pattern, rng.randint(0, 4)) + words(rng, rng.randint(0, 4))
        k = 4
        best = edit_distance_in(pattern, text)
        found = min(
            int(d.align([d.characters(pattern)], [d.characters(text)], np.array([low]), k)[0, 0])
            for low in range(-2 * k, len(text), 2 * k + 1)
        )
        assert found == best if best <= k else found >= min(best, k + 1)


def test_blocks_and_drop(spark, docs, monkeypatch):
    rng = random.Random(4)
    items = [(i, words(rng, 12)) for i in range(5)]
    rows = [(i, words(rng, 20) + (items[i % 5][1] if i % 2 else "")) for i in range(20)] + [(20, None), (None, "x")]
    monkeypatch.setattr(d, "BLOCK_CHARS", 50)
    assert {(r.doc_id, r.item_id) for r in d.find_passages(docs(rows), items_frame(spark, items)).collect()} == {
        (i, i % 5) for i in range(1, 20, 2)
    }
    kept = d.drop_contaminated(docs(rows), items_frame(spark, items))
    assert kept.columns == docs([]).columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(map(str, [*range(0, 21, 2), None]))


def test_periodic_text_in_small_slices(spark, docs, monkeypatch):
    monkeypatch.setattr(d, "HITS", 100)
    items = [(1, "ab" * 40), (2, "a" * 30)]
    rows = [(1, "ab" * 500), (2, "a" * 300), (3, "ba" * 39), (4, "ab" * 38), (5, "b" * 200), (6, "ab" * 30)]
    got = {(r.doc_id, r.item_id) for r in d.find_passages(docs(rows), items_frame(spark, items)).collect()}
    assert got == brute(rows, items)
    index = d.build_index([(1, "ab" * 40), (2, "a" * 30)])
    assert {(f[0], f[1]) for f in d.scan(index, [t for _, t in rows])} == {(i - 1, x) for i, x in brute(rows, items)}


def test_empty(spark, docs):
    some = docs([(1, "x" * 100)])
    assert d.find_passages(docs([]), items_frame(spark, [(1, "y" * 90)])).count() == 0
    assert d.find_passages(some, items_frame(spark, [])).count() == 0
    assert d.drop_contaminated(some, items_frame(spark, [])).count() == 1


def test_short_passages_have_their_full_budget(spark, docs):
    rng = random.Random(3)
    items = [(n, words(rng, 12)[:n].strip().ljust(n, "q")) for n in range(18, 46)]
    rows = [(n, f"zz {t[: n // 2]}#{t[n // 2 + 1 :]} zz") for n, t in items]
    found = {(r.doc_id, r.item_id) for r in d.find_passages(docs(rows), items_frame(spark, items)).collect()}
    assert found == brute(rows, items) and {(n, n) for n in range(20, 46)} <= found and (19, 19) not in found


def test_grams_too_long_for_the_budget_are_told():
    with pytest.raises(ValueError, match="too long"):
        d.build_index([(0, "abcdefghijklmnopqrst")], q=12)
