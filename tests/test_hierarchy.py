import random

import pytest

from arbor.operators import hierarchy as hi
from arbor.operators import skew
from arbor.operators.hierarchy import descendant_lists, descendants, hierarchy, loop_nodes, resolve

SCHEMA = "scope int, id long, parent long, weight double, root string, d int"


def brute(links):
    """Paths, loops and numbers of descendants by walking up from every node."""
    parent = {(s, i): p for s, i, p in links}
    paths, loops = {}, set()
    for key in parent:
        s, at, seen = key[0], key[1], []
        while at is not None and (s, at) in parent and at not in seen:
            seen.append(at)
            at = parent[(s, at)]
        if at in seen:
            if at == key[1]:
                loops.add(key)
            paths[key] = None
        else:
            paths[key] = seen[::-1]
    below = dict.fromkeys(parent, 0)
    for s, i in parent:
        at, seen = parent[(s, i)], set()
        while at is not None and (s, at) in parent and at not in seen and at != i:
            below[(s, at)] += 1
            seen.add(at)
            at = parent[(s, at)]
    return paths, loops, below


def run(spark, links):
    df = spark.createDataFrame([(s, i, p, float(i % 3), "x", 1) for s, i, p in links], SCHEMA)
    return resolve(df)


def check(spark, links):
    paths, loops, below = brute(links)
    peeled = run(spark, links)
    assert {(r.scope, r.id) for r in loop_nodes(peeled).collect()} == loops
    tree = hierarchy(peeled)
    rows = {(r.scope, r.id): r for r in tree.collect()}
    assert set(rows) == set(paths) - loops
    for key, r in rows.items():
        assert r.path == paths[key]
        assert r.n_descendants == below[key]
        if r.path is None:
            assert r.root is None and r.depth is None
        else:
            assert r.root == r.path[0] and r.depth == len(r.path) - 1
    pairs = sorted((r.scope, r.id, r.descendant, r.distance) for r in descendants(tree).collect())
    assert pairs == sorted((s, a, i, len(p) - 1 - k) for (s, i), p in paths.items() if p for k, a in enumerate(p[:-1]))


def test_loops_tails_selfloops_and_dangling(spark):
    check(spark, [
        (0, 1, 2), (0, 2, 3), (0, 3, 1), (0, 4, 1), (0, 5, 4),  # a loop of three, with a tail
        (0, 6, 6), (0, 7, 6), (0, 20, 21), (0, 21, 20), (0, 19, 21),  # one of one, one of two
        (0, 8, 99), (0, 9, 8), (0, 10, 9),  # a parent without a row
        (0, 11, None), (0, 12, 11), (0, 13, 12), (0, 14, 12), (0, 15, 14),
        (1, 1, None), (1, 2, 1), (1, 3, 2),  # the same ids in another scope
    ])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    check(spark, [(rng.randrange(2), i, rng.choice([None, *range(60)])) for i in range(60)])


def test_deep_chain_and_star(spark):
    check(spark, [(0, i, i + 1 if i < 70 else None) for i in range(1, 71)] + [(0, 100 + i, 35) for i in range(300)])


def test_empty(spark):
    peeled = resolve(spark.createDataFrame([], SCHEMA))
    assert loop_nodes(peeled).count() == 0
    assert hierarchy(peeled).count() == 0
    assert hierarchy(peeled, with_path=False).columns == ["scope", "id", "root", "depth", "n_descendants"]


def test_lists_sent_up_and_plain_peeling(spark):
    """Lists that are sent up hold the pairs of the paths; peeling a level per round gives the same, with more rounds."""
    links = [(0, i, i + 1 if i < 20 else None) for i in range(1, 21)] + [(0, 100 + i, 5 + i % 9) for i in range(40)] + [(0, 200 + i, 100 + i // 2) for i in range(60)]
    links += [(1, 1, 2), (1, 2, 1), (1, 3, 1), (1, 4, 3), (2, 7, 7), (2, 8, 7), (3, 1, 9)]
    paths, loops, _ = brute(links)
    want = sorted((s, a, i, len(p) - 1 - k) for (s, i), p in paths.items() if p for k, a in enumerate(p[:-1]))
    rounds = []
    for chained, tail in ((True, 0), (False, 0), (True, 60), (False, 30)):
        peeled = resolve(spark.createDataFrame([(s, i, p, float(i % 3), "x", 1) for s, i, p in links], SCHEMA), chained, tail)
        rounds.append(len(peeled.rounds))
        assert {(r.scope, r.id) for r in loop_nodes(peeled).collect()} == loops
        assert {(r.scope, r.id): r.path for r in hierarchy(peeled).collect()} == {k: p for k, p in paths.items() if k not in loops}
        assert sorted((r.scope, r.id, r.descendant, r.distance) for r in descendant_lists(peeled).collect()) == want
    assert rounds[0] < 5 and rounds[1] >= 20 and rounds[2] <= rounds[0] and rounds[3] < rounds[1]


def test_loop_of_many(spark):
    """Loops longer than a job's pointers reach, some hanging on nothing but themselves."""
    links = [(0, i, (i + 1) % 70) for i in range(70)] + [(0, 100 + i, i) for i in range(70)] + [(0, 300, 300)]
    check(spark, links)


def test_hot_parents_are_salted(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_HOT", 3)
    monkeypatch.setattr(hi, "TAIL", 0)
    check(spark, [(0, 1, None), (0, 2, 1), (0, 3, 2)] + [(0, 10 + i, 1 + i % 3) for i in range(60)] + [(0, 100 + i, 10) for i in range(9)] + [(1, 1, 1)] + [(1, 2 + i, 1) for i in range(9)])


def test_empty_lists(spark):
    assert descendant_lists(resolve(spark.createDataFrame([], SCHEMA))).count() == 0
