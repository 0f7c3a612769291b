"""Classifiers and neighbour search: held-out accuracy, recall, and the exact parts against brute force."""

import pickle
from collections import Counter

import numpy as np
import pytest
from helpers import documents

from docquarry.llm import catalog, neighbours, quality, toxicity
from docquarry.llm.common import table

SF_DIR = "/root/testdata/sf0.01"


def ranked_right(scores, labels):
    """The share of (0, 1) pairs that the scores order, ties counted half."""
    zeros, ones = scores[labels == 0], scores[labels == 1]
    return float(np.mean((ones[:, None] > zeros) + 0.5 * (ones[:, None] == zeros)))


@pytest.mark.parametrize("query, label, least", [("op9_quality", "quality", 0.97), ("op7_toxicity", "toxic", 0.9)])
def test_held_out_rows_are_ranked(spark, query, label, least):
    scored = catalog.QUERIES[query](spark, SF_DIR)
    rows = scored.join(table(spark, SF_DIR, "labels"), "doc_id").where("held_out").toPandas()
    assert scored.count() == table(spark, SF_DIR, "documents").count()
    assert rows["score"].between(0, 1).all()
    assert ranked_right(rows["score"].to_numpy(), rows[label].to_numpy()) >= least


def test_held_out_labels_teach_nothing(spark):
    docs = table(spark, SF_DIR, "documents").limit(300)
    labels = table(spark, SF_DIR, "labels")
    turned = labels.selectExpr(
        "doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality"
    )
    one, other = (quality.fit(docs, some) for some in (labels, turned))
    assert np.array_equal(one.scores, other.scores)


ODD = [(1, None), (2, ""), (3, " . "), (None, "good words"), (5, "bad " * 50_000), (5, "bad " * 50_000), (6, "🙂 é")]


def odd_labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("rows", [[], [(i, 1, 0, "clash") for i in range(9)], [(i, i % 2, i % 2, None) for i in range(9)], [(None, 1, 1, "")]])
def test_odd_rows_get_a_score(spark, rows):
    docs, labels = documents(spark, ODD), odd_labels(spark, rows)
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        found = module.score(docs, module.fit(docs, labels, label)).collect()
        assert len(found) == len(ODD)
        assert all(0 <= r["score"] <= 1 for r in found)
        assert len({r["score"] for r in found if r["doc_id"] == 5}) == 1
        assert module.score(documents(spark, []), module.fit(docs, labels, label)).count() == 0


def test_rejected_rows_go_with_all_columns_kept(spark):
    docs = documents(spark, ODD)
    model = quality.Model(np.zeros(1 << 10, np.float32), -2.0, 3.0)
    kept = quality.without_rejected(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]  # " . " is a word here


def test_subword_vectors_learn_word_pairs_and_characters():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(200)]
    plain = [" ".join(rng.choice(words, 30)) for _ in range(60)]
    again = [" ".join(w for w in rng.choice(words, 10) for _ in range(3)) for _ in range(60)]
    model = quality.train([t.encode() for t in plain[:40] + again[:40]], [1] * 40 + [0] * 40, bits=14)
    odds = quality.log_odds(model, [t.encode() for t in plain[40:] + again[40:]])
    assert odds[:20].min() > odds[20:].max()


@pytest.fixture(scope="module")
def index():
    rng = np.random.default_rng(1)
    words = [f"term{i}" for i in range(120)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 40))) for _ in range(500)] + ["unknown"]
    labels = [int(rng.random() < (0.9 if {"term7", "term8", "term9"} & set(text.split()) else 0.05)) for text in texts]
    number = toxicity.choose_terms(texts, labels, most=150, least=2)
    terms, df = toxicity.Terms(number), np.zeros(len(number), np.int64)
    df += np.bincount(terms.counts(texts)[0], minlength=len(df))
    built = [toxicity.build(list(range(500, 1001)), texts, labels, {0: 700, 1: 300}, number, df, len(texts), share) for share in (8, 3, 0)]
    return built, texts, labels, df


def dense_vectors(built, texts, df):
    idf = np.log((1 + len(texts)) / (1 + df)) + 1
    dense = np.zeros((len(texts), len(idf)))
    for i, text in enumerate(texts):
        for word in text.split():
            for term in toxicity.terms_of(word):
                if term in built.number:
                    dense[i, built.number[term]] += 1
    dense = np.where(dense > 0, 1 + np.log(np.maximum(dense, 1)), 0) * idf
    return dense / np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)


def ordered(cosines, k=toxicity.NEIGHBOURS, without=None):
    exact = cosines.round(12)
    return [j for j in np.lexsort((np.arange(len(exact)), -exact)) if exact[j] > 0 and j != without][:k]


def test_block_bounds_lose_no_neighbour(index):
    builds, texts, _, df = index
    for built in builds:
        dense = dense_vectors(built, texts, df)
        terms = toxicity.Terms(built.number)
        present, counts, ends = terms.counts(texts)
        weights = toxicity.weighted(present, counts, ends, built.idf)
        sums = toxicity.column_sums(built, present, weights, ends)
        for i in range(0, len(texts), 7):
            own = slice(ends[i - 1] if i else 0, ends[i])
            if own.start == own.stop:
                continue
            best, cosines = toxicity.nearest(built, present[own], weights[own], sums[i], 12)
            expected = ordered(dense @ dense[i], 12)
            assert (built.ids[best] - 500).tolist() == expected
            assert np.allclose(cosines, (dense @ dense[i])[expected])


def test_scores_equal_a_plain_version(index):
    """Votes and the calibrated curve from dense cosines, end to end."""
    builds, texts, labels, df = index
    built = toxicity.calibrate(builds[0], most=10_000)
    dense, marks = dense_vectors(built, texts, df), np.array(labels)
    stands = np.array([700 / labels.count(0), 300 / labels.count(1)])[marks]
    usable = dense.any(1)

    def vote(cosines, without=None):
        best = [j for j in ordered(np.where(usable, cosines, 0), without=without)]
        votes = cosines[best] ** 2 * stands[best] / stands[usable].mean()
        return (votes @ marks[best] + toxicity.PRIOR * built.base) / (votes.sum() + toxicity.PRIOR)

    raw = np.array([vote(dense @ dense[i], i) for i in np.flatnonzero(usable)])
    weight = np.array([stands[usable & (marks == c)].sum() / (usable & (marks == c)).sum() for c in (0, 1)])[marks[usable]]
    weight /= weight.mean()
    odds = np.log(raw) - np.log1p(-raw)

    def loss(slope, offset):
        z = slope * odds + offset
        return (weight * (np.logaddexp(0, z) - marks[usable] * z)).sum() + ((slope - 1) ** 2 + offset**2) / 2

    best = loss(built.slope, built.offset)
    assert built.slope > 0.05
    assert all(best <= loss(built.slope + a, built.offset + b) for a, b in ((0.02, 0), (-0.02, 0), (0, 0.02), (0, -0.02)))
    asked = texts[::9] + ["term1 term2 new words", "", None]
    found = toxicity.searched(built, toxicity.Terms(built.number), asked)
    for (score, _), i in zip(found, range(0, len(texts), 9)):
        expected = vote(dense @ dense[i]) if usable[i] else built.base
        z = built.slope * (np.log(expected) - np.log1p(-expected)) + built.offset
        assert score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def test_scores_are_calibrated(spark):
    scored = catalog.QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.1")
    rows = scored.join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("held_out").toPandas()
    bins = np.minimum((rows["score"] * 5).astype(int), 4)
    error = sum(abs(rows["score"][bins == b].mean() - rows["toxic"][bins == b].mean()) * (bins == b).mean() for b in set(bins))
    assert error <= 0.08


def test_every_term_of_the_examples_counts(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(600)) for i in range(10)]
    assert toxicity.choose_terms(texts, [0, 1] * 5).keys() == {t for text in texts for w in text.split() for t in toxicity.terms_of(w)}
    # A word of a single example is evidence; of these ids only 6 is held out.
    rows = [(i, f"common word{i}" + " zorgle" * (i == 4)) for i in range(1, 10) if i != 6] + [(6, "zorgle")]
    docs = documents(spark, rows)
    labels = odd_labels(spark, [(i, 0, int(i == 4), "") for i, _ in rows])
    found = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert [e["doc_id"] for e in found[6]["evidence"]] == [4]
    assert found[6]["score"] > 0.5


def test_terms_are_counted_without_a_memory_of_words(monkeypatch):
    texts = [None, "", "(Naïveté), naïveté! abcd~ abcdef .. --x", "日本語日本語日本語 é\n\tİstanbul abcdef", "zorgle, " * 40 + "abcde"]
    expected = [Counter(t for w in (text or "").lower().split() for t in toxicity.terms_of(w)) for text in texts]
    number = {t: i for i, t in enumerate(sorted(set().union(*expected) - {"x", "abcde~"}))}
    terms = toxicity.Terms(number)
    size = len(pickle.dumps(terms))
    for portion in (toxicity.PORTION, 16):
        monkeypatch.setattr(toxicity, "PORTION", portion)
        found, counts, ends = terms.counts(texts)
        for text, plain, part, times in zip(texts, expected, np.split(found, ends[:-1]), np.split(counts, ends[:-1])):
            assert list(zip(part.tolist(), times.tolist())) == sorted((number[t], n) for t, n in plain.items() if t in number), text
    terms.counts([" ".join(f"new{i}" for i in range(5000))])
    assert len(pickle.dumps(terms)) == size  # workers hold nothing that grows with the words they have seen


def test_votes_follow_the_nearest(index):
    built = index[0][0]
    ones = np.flatnonzero(built.labels == 1)[:5]
    assert toxicity.vote(built, ones, np.ones(5)) > 0.9
    assert toxicity.vote(built, ones[:0], np.ones(0)) == pytest.approx(built.base)


# --- nearest neighbours ---


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, part int")


def brute(rows, k):
    usable = [(i, np.array(v, np.float64)) for i, v, _ in rows]
    for q, x in usable:
        if q % 100 == 0:
            far = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in usable if i != q)
            yield from ((q, rank, i, d) for rank, (d, i) in enumerate(far[:k], 1))


def test_recall_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 200)
    monkeypatch.setattr(neighbours, "CELL_ROWS", 150)
    monkeypatch.setattr(neighbours, "CELL_QUERIES", 4)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 16)) * 3
    rows = [(i, (centres[rng.integers(40)] + rng.standard_normal(16)).astype(np.float32).tolist(), 0) for i in range(5000)]
    rows[3000:3050] = [(i, rows[0][1], 0) for i in range(3000, 3050)]
    found = {(r["query_id"], r["vec_id"]): (r["rank"], r["score"]) for r in neighbours.search(vectors(spark, rows), "vec_id % 100 = 0", sample=2000).collect()}
    expected = {(q, i): (rank, d) for q, rank, i, d in brute(rows, 10)}
    shared = expected.keys() & found.keys()
    assert len(found) == len(expected)
    assert len(shared) >= 0.9 * len(expected)
    assert all(found[p][1] == pytest.approx(expected[p][1], rel=1e-12, abs=1e-12) for p in shared)
    # The hot vector: the smallest ids of its copies, without the query's own.
    assert [i for (q, i), (rank, _) in sorted(found.items(), key=lambda x: x[1]) if q == 0] == list(range(3000, 3010))
    assert [i for (q, i), (rank, _) in sorted(found.items(), key=lambda x: x[1]) if q == 3000] == [0, *range(3001, 3010)]


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((8, 8)) * 8
    points = np.concatenate([c + rng.standard_normal((100, 8)) for c in centres])
    graph = neighbours.neighbour_graph(points, 10)
    part = neighbours.balanced_parts(graph, 8)
    assert np.bincount(part).tolist() == [100] * 8
    assert (part[graph] != part[:, None]).mean() < 0.35


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [0.0, 0.0], 1), (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1),
        (6, [inf, 1.0], 1), (7, [1.0], 1), (8, [], 1), (None, [1.0, 1.0], 1), (100, [2.0, 0.0], None), (200, [0.0, 0.0], 1),
    ]
    found = sorted(map(tuple, neighbours.search(vectors(spark, rows), "vec_id % 100 = 0").collect()))
    assert found == [(0, 1, 1, 1.0), (0, 2, 100, 1.0), (100, 1, 1, 0.0), (100, 2, 0, 1.0)]


def test_repeated_query_rows_take_no_places(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(1, 21)]
    rows += [(100, [1.5, 1.0], 0)] * 2 + [(200, [18.5, 1.0], 0)] * 12 + [(201, [18.5, 1.0], 0), (5, [5.0, 1.0], 0)]
    found = sorted(map(tuple, neighbours.search(vectors(spark, rows), "vec_id % 100 = 0").collect()))
    assert found == sorted(set(brute(rows, 10)))
    assert len(found) == 20


def test_huge_vectors_keep_their_rows(spark):
    rows = [(i, [float(i) * 1e200, 1e200], 0) for i in range(1, 21)] + [(100, [3.5e200, 1e200], 0), (200, [-1.7e308, 1e308], 0), (201, [1.7e308, 1e308], 0)]
    found = sorted(map(tuple, neighbours.search(vectors(spark, rows).selectExpr("vec_id", "embedding"), "vec_id % 100 = 0").collect()))
    nearest = [r for r in found if r[0] == 100]
    assert [r[2] for r in nearest] == sorted(range(1, 21), key=lambda i: (abs(float(i) * 1e200 - 3.5e200), i))[:10]
    assert nearest[0][3] == pytest.approx(0.5e200) and len(found) == 20


def test_recall_on_the_given_embeddings(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings", "vec_id", "embedding").where("vec_id is not null and embedding is not null").collect()
    known = np.array([r["embedding"] for r in rows], np.float64)
    ids = np.array([r["vec_id"] for r in rows])
    expected = set()
    for i in np.flatnonzero(ids % 100 == 0):
        far = np.sqrt(((known - known[i]) ** 2).sum(1))
        far[i] = np.inf
        expected |= {(int(ids[i]), int(ids[j])) for j in np.lexsort((ids, far))[:10]}
    found = {(r["query_id"], r["vec_id"]) for r in catalog.QUERIES["op8_nearest_neighbours"](spark, "/root/testdata/sf0.1").collect()}
    assert len(found) == len(expected)
    assert len(found & expected) >= 0.95 * len(expected)


def test_no_vectors(spark):
    assert neighbours.search(vectors(spark, []), "vec_id % 100 = 0").count() == 0
    assert neighbours.search(vectors(spark, [(100, [1.0], 1)]), "vec_id % 100 = 0").count() == 0
