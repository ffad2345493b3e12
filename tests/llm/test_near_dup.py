import random
import re
from itertools import combinations

import pytest

from glosswork.llm import near_dup
from glosswork.llm.components import components
from glosswork.llm.near_dup import describe, near_duplicates, nodes


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def corpus(rng, groups=25, copies=4, edits=(0, 1, 3, 6, 12)):
    rows, words = [], [f"w{i}" for i in range(400)]
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice((5, 40, 120)))]
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.choice(edits)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((rng.randrange(10**9), " ".join(text)))
    return rows


def run(frame, **more):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame, **more).collect()}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_components_match_brute_force(docs, width, percent):
    rows = corpus(random.Random(width))
    assert run(docs(rows), width=width, percent=percent) == brute(rows, width, percent)


def test_edge_cases(docs):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two "), (8, "two one"),
        (9, "a b c d e f g h i j " * 300), (10, "a b c d e f g h i j " * 200), (11, "é É"), (12, "É é"),
    ]
    got = run(docs(rows), width=3, percent=85)
    assert got == brute(rows, 3, 85)
    assert got[1] == (0, 1, True) and got[5][1] == 4 and got[7][1] == 6 and got[10][1] == 9


def test_null_and_repeated_ids(docs):
    text = "a b c d e f"
    got = near_duplicates(docs([(2, text), (2, text), (None, text), (5, text)]), width=3, percent=85).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == [
        (2, 2, True), (2, 2, True), (5, 2, False), (None, None, True)
    ]


def test_a_large_group_of_near_copies(docs):
    """Nodes that never get small: ordered, compared with the rows that follow."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(1000)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(150):
        text = list(base)
        text[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    for i in range(150, 190):  # borderline members
        text = list(base)
        for _ in range(4):
            text[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    assert run(docs(rows), width=3, percent=85, levels=2, leaf=8) == brute(rows, 3, 85)


def test_near_copies_far_apart_in_a_large_node(docs):
    """All texts share most words, so nodes stay large; only planted pairs are linked."""
    rng = random.Random(11)
    shared = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        own = [f"x{rng.randrange(10**6)}" for _ in range(45)]
        other = list(own)
        for at in rng.sample(range(45), 3):
            other[at] = f"y{rng.randrange(10**6)}"
        rows += [(i, " ".join(shared + own)), (1000 + i, " ".join(shared + other))]
    want = brute(rows, 3, 85)
    assert sum(not kept for _, _, kept in want.values()) > 100
    got = run(docs(rows), width=3, percent=85, trees=4, levels=1, leaf=2, block=50)
    assert got == want


def test_a_hot_group_does_not_end_the_branching_of_others(docs):
    """Near copies that stay together end as they are; texts that share half their words branch on beside them."""
    rng = random.Random(13)
    base, shared = [f"b{i}" for i in range(150)], [f"s{i}" for i in range(150)]
    hot = [(i, " ".join(base + [f"h{i}"])) for i in range(200)]
    other = [(1000 + i, " ".join(shared + [f"o{rng.randrange(10**6)}" for _ in range(50)])) for i in range(60)]

    def sizes(rows):
        sets = describe(docs(rows), "doc_id", "text", 3).select("id", "tokens")
        leaves, dense = nodes(sets, 0.85, trees=4, leaf=8)
        count = lambda frame: sorted(frame.filter("id >= 1000").groupBy("path").count().collect())
        return count(leaves), [] if dense is None else count(dense), dense is not None and dense.count()

    beside, alone = sizes(hot + other), sizes(other)
    assert beside[2] >= 200
    assert sum(r["count"] for r in beside[1]) <= sum(r["count"] for r in alone[1])
    assert beside[0] and max((r["count"] for r in beside[1]), default=0) < 40


def test_empty_and_clashing_columns(spark, docs):
    assert near_duplicates(docs([])).count() == 0
    frame = spark.createDataFrame(
        [(1, "a b c d e f", 5), (2, "a b c d e f", 6)], "doc_id bigint, text string, n bigint"
    ).selectExpr("*", "'x' AS digest", "'y' AS id", "'z' AS component")
    assert run(frame) == {1: (2, 1, True), 2: (2, 1, False)}


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(60)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    up = {x: x for p in links for x in p if x is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    linked = {x for a, b in links if a is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_hot_group_is_branched_no_further_than_its_first_nodes(docs):
    """Its copies come once per tree and position, not again for every level."""
    rng = random.Random(17)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(300):
        text = list(base)
        for at in rng.sample(range(200), rng.choice((1, 2, 4))):
            text[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(f"y{rng.randrange(10**6)}" for _ in range(60))) for i in range(700)]
    sets = describe(docs(rows), "doc_id", "text", 3).select("id", "tokens")
    leaves, dense = nodes(sets, 0.85, trees=16, leaf=32)
    copies = dense.filter("id < 1000").count() + leaves.filter("id < 1000").count()
    assert dense.filter("id >= 1000").count() == 0
    assert 300 * 16 / 2 < copies < 300 * 16 * 1.25


def test_small_nodes_are_branched_in_one_task_with_the_same_nodes(docs, monkeypatch):
    """No shuffle per level: what is below a node is the same wherever it is branched."""
    rng = random.Random(23)
    shared = [f"s{i}" for i in range(100)]
    rows = [(i, " ".join(shared + [f"o{rng.randrange(10**6)}" for _ in range(60)])) for i in range(80)]
    rows += [(1000 + i, " ".join([f"b{j}" for j in range(150)] + [f"h{i}"])) for i in range(40)]
    sets = describe(docs(rows), "doc_id", "text", 3).select("id", "tokens").cache()
    staged = []
    monkeypatch.setattr(near_dup, "stage", lambda df, name, stage=near_dup.stage: staged.append(name) or stage(df, name))

    def found(whole):
        staged.clear()
        parts = nodes(sets, 0.85, trees=4, levels=6, leaf=8, whole=whole)
        return [sorted(map(tuple, x.select("path", "id", "tree").collect())) for x in parts], staged.count("paths")

    (by_level, levels), (in_tasks, once) = found(8), found(1000)
    assert by_level == in_tasks and by_level[0] and by_level[1]
    assert levels > 3 and once == 1


def test_rounds_of_components_are_few_and_short(spark, monkeypatch):
    """A round is two joins of stored tables, whose hot keys Spark can split, and chains halve in it."""
    from glosswork.llm import components as module

    plans = []

    def kept(df, name, stage=module.stage):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return stage(df, name)

    monkeypatch.setattr(module, "stage", kept)
    links = [(i, i + 1) for i in range(256)] + [(1000, 1001 + i) for i in range(300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(257)} | {1000 + i: 1000 for i in range(301)}
    rounds = [plan for name, plan in plans if name == "links"][1:]
    assert 1 < len(rounds) <= 11
    assert all(plan.count("Join ") == 2 and "Aggregate" not in plan for plan in rounds)
