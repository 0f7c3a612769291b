"""Operators on pairs of texts, against comparing all pairs."""

import random
import tracemalloc

import numpy as np
import pytest
from helpers import components, documents, shingles
from hypothesis import given, settings
from hypothesis import strategies as st

from docquarry.llm import decontaminate, jaccard
from docquarry.llm.shingles import shingle_sets


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbé \n\t\x0b\x1c　"), max_size=30), min_size=1, max_size=6), st.sampled_from([1, 3, 5]))
def test_shingle_hashes_stand_for_shingles(texts, width):
    found = shingle_sets([t.encode() for t in texts], width)
    expected = [shingles(t, width) for t in texts]
    assert [len(f) for f in found] == [len(e) for e in expected]
    for f, e in zip(found, expected):
        for g, d in zip(found, expected):
            assert len(np.intersect1d(f, g)) == len(e & d)


def near_copies(seed, n_families=12, copies=6, length=60, edits=3):
    """Texts in families of near copies, exact copies among them, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=20))
    rows = []
    for _ in range(n_families):
        words = rng.choices(vocabulary, k=rng.randint(3, length))
        for _ in range(copies):
            mine = list(words)
            for _ in range(rng.randint(0, edits)):
                mine[rng.randrange(len(mine))] = rng.choice(vocabulary)
            rows.append(" ".join(mine) + (" " + passage if rng.random() < 0.2 else ""))
    rng.shuffle(rows)
    return list(enumerate(rows))


ODD = [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "One"), (905, "two words"), (906, "x " * 4000), (907, "X " * 3999)]


@pytest.mark.parametrize("width, share", [(3, (9, 10)), (5, (4, 5)), (2, (1, 2))])
@pytest.mark.parametrize("group", [1024, 4])
def test_components_equal_all_pairs(spark, monkeypatch, width, share, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "TASK_EDGES", 20 if group == 4 else 1_000_000)
    rows = near_copies(width * 7 + group) + ODD
    expected = components(rows, width, *share)
    found = jaccard.component_ids(documents(spark, rows).repartition(5), width, share).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert len(found) == len(rows)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10_000), st.sampled_from([(9, 10), (4, 5), (1, 2)]))
def test_linked_sets_share_a_key(size, seed, share):
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 1 << 63, size + 200, dtype=np.uint64))
    a = np.sort(rng.choice(pool, size, replace=False))
    dropped = rng.integers(0, max(1, size // 4) + 1)
    added = rng.integers(0, max(1, size // 4) + 1)
    b = np.union1d(rng.choice(a, size - min(dropped, size - 1), replace=False), rng.choice(pool, added, replace=False))
    if jaccard.linked(a, b, share) and not np.array_equal(a, b):
        assert len(np.intersect1d(jaccard.group_keys(a, share), jaccard.group_keys(b, share)))


@pytest.mark.parametrize("n, split", [(3, None), (40, None), (300, None), (300, 120), (50, 1)])
def test_tree_gives_every_pair_that_the_bound_allows(n, split):
    rng = np.random.default_rng(n)
    base = np.unique(rng.integers(0, 1 << 62, 120, dtype=np.uint64))
    sets = [np.sort(rng.choice(base, rng.integers(20, 100), replace=False)) for _ in range(n)]
    encoded = [jaccard.point_of(s) for s in sets]
    points = jaccard.points_of(encoded)
    a, b, _ = jaccard.near_pairs(encoded, split, (4, 5))
    found = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())}
    assert len(found) == len(a)
    expected = set()
    for j in range(n):
        for i in range(j):
            if split is None or i < split <= j:
                bound = np.minimum(points[i], points[j]).sum()
                if 9 * bound >= 4 * (points[i].sum() + points[j].sum()):
                    expected.add((i, j))
    assert found == expected


def test_folded_points_keep_the_bound():
    small, large = np.arange(1, 40, dtype=np.uint64), np.arange(1, 3000, dtype=np.uint64)
    points = jaccard.points_of([jaccard.point_of(small), jaccard.point_of(large)])
    assert points.sum(1).tolist() == [39, 2999]
    assert np.minimum(*points).sum() == 39


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_lowest_node_reached(edges):
    ends = np.array(edges, np.int64).reshape(-1, 2)
    label = list(range(31))
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert jaccard.lowest_reached(ends[:, 0], ends[:, 1], 31).tolist() == label


@pytest.mark.parametrize("task_edges", [2, 1_000_000])
@pytest.mark.parametrize("edges", [[], [(1, 1)], [(3, 1), (1, 2), (7, 9), (9, 8), (2, 5), (3, 3), (5, 3), (12, 8), (0, 11)]])
def test_stars_give_components(spark, monkeypatch, edges, task_edges):
    monkeypatch.setattr(jaccard, "TASK_EDGES", task_edges)
    found = {r["node"]: r["component"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label


@pytest.mark.parametrize("task_edges", [10, 1_000_000])
def test_a_long_chain_is_one_component(spark, monkeypatch, task_edges):
    monkeypatch.setattr(jaccard, "TASK_EDGES", task_edges)
    edges = spark.range(200).selectExpr("(id * 37) % 201 as a", "((id + 1) * 37) % 201 as b")
    found = jaccard.components(edges).collect()
    assert len(found) == 201
    assert {r["component"] for r in found} == {0}


def test_repeated_rows_missing_ids_and_extra_columns(spark):
    text = "a b c d e f g h"
    rows = [(3, text, 1), (3, text, 1), (5, text.upper(), 2), (None, text, 3), (None, None, 4), (1, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest long")
    found = sorted(map(tuple, jaccard.component_ids(docs).collect()), key=repr)
    assert found == sorted([(3, 6, 3), (3, 6, 3), (5, 6, 3), (None, 6, None), (None, 0, None), (1, 0, 1)], key=repr)
    kept = sorted(map(tuple, jaccard.without_repeats(docs).collect()), key=repr)
    assert kept == sorted([(3, text, 1), (None, text, 3), (None, None, 4), (1, "", 5)], key=repr)


def test_no_rows_no_links(spark):
    assert jaccard.component_ids(documents(spark, [])).count() == 0
    assert jaccard.without_repeats(documents(spark, [])).count() == 0
    assert decontaminate.matches(documents(spark, []), spark.createDataFrame([], "item_id long, text string")).count() == 0


# --- benchmark items ---


def held(docs, items, width=5):
    found = []
    for i, text in docs:
        for j, item in items:
            own = shingles(item, width)
            if own:
                size = min(width, len(next(iter(own))))
                shared = len(own & shingles(text, size)) if len(shingles(text, size)) and len(next(iter(shingles(text, size)))) == size else 0
                if 5 * shared >= 4 * len(own):
                    found.append((i, j, len(own), shared, shared / len(own)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 24, 200])
def test_items_in_documents_equal_all_pairs(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "\t"), (0, items[0][1]), (None, items[1][1].upper())]
    docs = []
    for i in range(80):
        words = rng.choices(vocabulary, k=rng.randint(0, 300))
        if i % 2:
            cut = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, 2)):
                if cut:
                    cut[rng.randrange(len(cut))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = cut[: max(1, len(cut) - rng.randint(0, 4))]
        docs.append((i, " ".join(words)))
    docs += [(200, None), (201, ""), (7, docs[7][1]), (202, "filler " * 20_000 + items[2][1] + " filler" * 5)]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    frame = documents(spark, docs).repartition(4)
    found = sorted(map(tuple, decontaminate.matches(frame, benchmark).collect()), key=repr)
    assert found == held(docs, items)
    assert any(i == 202 for i, *_ in found)
    dirty = {i for i, *_ in found}
    clean = decontaminate.without_items(frame, benchmark)
    assert clean.columns == frame.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _ in docs if i not in dirty)


def test_items_that_repeat_an_id_with_a_null_text(spark):
    items = [(1, None), (1, "one two three"), (None, None), (None, "four five"), (2, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = documents(spark, [(7, "one two three four five"), (8, None)])
    found = decontaminate.matches(frame, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(7, 1), (7, None)}
    nothing = benchmark.where("text is null")
    assert decontaminate.matches(frame, nothing).count() == 0


def test_pairs_of_long_sets_take_bounded_memory(monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS", 100)
    rng = np.random.default_rng(4)
    base = rng.integers(1, 2**63, 20_000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base, rng.integers(1, 2**63, 10, dtype=np.uint64)])) for _ in range(64)]
    points = [jaccard.point_of(s) for s in sets]
    tracemalloc.start()
    a, b, _ = jaccard.near_pairs(points, None, (9, 10))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(a) == 64 * 63 // 2
    assert peak < 30 << 20  # all pairs of points at once are 33 MB in each array
    one, other = jaccard.links(np.arange(64), sets, None, (9, 10))
    assert jaccard.lowest_reached(one, other, 64).tolist() == [0] * 64 and len(one) == 63
