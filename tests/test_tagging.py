import hashlib
import time
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.config import Settings
from docquarry.operators import labels, svm
from docquarry.operators.svm import LinearModel
from docquarry.operators.tfidf import TfidfModel, count_threshold, fit_tfidf, gram_counts, long_weights, vocabulary, with_grams
from docquarry.plans import catalog
from docquarry.plans.pipeline import sign_coefficients


def corpus_of(spark, docs):
    rows = [(f"d{i}", i, tags, text.split()) for i, (text, tags) in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id string, row_no long, tags array<string>, tokens array<string>")


def test_label_vocabulary(spark):
    corpus = corpus_of(spark, [("a", ["x", "x"]), ("a", ["y"]), ("a", ["z", "y"]), ("a", []), ("a", ["w"])])
    rows = [(r.label, r.n, r["rank"]) for r in labels.top_labels(corpus, Settings(top_labels=3)).orderBy("rank").collect()]
    assert rows == [("x", 2, 1), ("y", 2, 2), ("w", 1, 3)]
    kept = labels.binarized(labels.with_kept_tags(corpus, ["x", "y", "w"]), ["x", "y", "w"])
    got = {r.doc_id: (r.kept_tags, r.targets) for r in kept.collect()}
    assert got == {"d0": (["x", "x"], [0]), "d1": (["y"], [1]), "d2": (["y"], [1]), "d4": (["w"], [2])}


@pytest.mark.parametrize("n", [0, 1, 4, 5, 997])
def test_exact_split(spark, n):
    docs = spark.range(n).select(F.col("id").cast("string").alias("doc_id"), F.lit("x").alias("place"))
    rows = labels.with_exact_split(docs.select("doc_id"))
    one = {r.doc_id for r in rows.where("is_test").collect()}
    assert len(one) == -(-n // 5) and rows.count() == n
    digest = {str(i): int(hashlib.md5(f"{i}|42".encode()).hexdigest()[:13], 16) for i in range(n)}
    assert one == set(sorted(digest, key=lambda i: (digest[i], i))[: len(one)])
    assert one == {r.doc_id for r in labels.with_exact_split(docs.select("doc_id").repartition(7)).where("is_test").collect()}


def test_split_does_not_depend_on_partitions(spark):
    docs = corpus_of(spark, [("a", [])] * 500)
    one = {r.doc_id: r.is_test for r in labels.with_split(docs).collect()}
    two = {r.doc_id: r.is_test for r in labels.with_split(docs.repartition(13)).collect()}
    assert one == two and 60 < sum(one.values()) < 140
    train, test = labels.random_split(docs)
    assert train.count() + test.count() == 500


def test_idf_and_unit_length(spark):
    corpus = corpus_of(spark, [("aa bb", []), ("bb cc", []), ("dd", []), ("", [])])
    model = fit_tfidf(corpus.where("doc_id <> 'd3'"), Settings(ngram_max=1))
    idf = {r.gram: r.idf for r in model.table.collect()}
    assert idf["aa"] == pytest.approx(1.693147, abs=1e-6) and idf["bb"] == pytest.approx(1.287682, abs=1e-6)
    vectors = model.transform(with_grams(corpus, Settings(ngram_max=1)))
    assert vectors.count() == 4
    assert vectors.where("doc_id = 'd3'").first().indices == []
    lengths = long_weights(vectors, model).groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert len(lengths) == 3 and all(r.n == pytest.approx(1.0) for r in lengths)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 6, 50])
def test_vocabulary_cut(spark, size):
    corpus = corpus_of(spark, [("aa aa aa bb bb cc cc dd ee ff", []), ("zz", []), ("aa", [])])
    counts = gram_counts(with_grams(corpus, Settings(ngram_max=1)))
    got = [r.gram for r in vocabulary(counts, 3, Settings(max_features=size)).orderBy("idx").collect()]
    assert got == ["aa", "bb", "cc", "dd", "ee", "ff", "zz"][:size]
    assert count_threshold(counts, size) == [4, 2, 2, 1, 1, 1, 1][min(size, 7) - 1]


def toy(spark, n=60, features=30, seed=3):
    rng = np.random.default_rng(seed)
    matrix = np.where(rng.random((n, features)) < 0.3, rng.random((n, features)), 0.0)
    signs = np.column_stack([matrix[:, 0] > matrix[:, 1], matrix[:, 2] > 0, np.zeros(n, bool), np.ones(n, bool)])
    rows = [
        (f"d{i}", [int(j) for j in np.flatnonzero(matrix[i])], [float(v) for v in matrix[i][matrix[i] > 0]],
         [int(t) for t in np.flatnonzero(signs[i])])
        for i in range(n)
    ]
    schema = "doc_id string, indices array<int>, values array<double>, targets array<int>"
    return spark.createDataFrame(rows, schema).repartition(5), matrix, np.where(signs, 1.0, -1.0)


def objective(matrix, sign, w, b, c=1.0):
    return 0.5 * (w @ w + b * b) + c * np.square(np.maximum(0, 1 - sign * (matrix @ w + b))).sum()


def plain_solver(matrix, sign, steps=20000):
    """Gradient descent with a fixed step below the inverse curvature."""
    wide = np.column_stack([matrix, np.ones(len(matrix))])
    step = 1.0 / (1.0 + 2.0 * np.linalg.norm(wide, 2) ** 2)
    point = np.zeros(wide.shape[1])
    for _ in range(steps):
        short = np.maximum(0, 1 - sign * (wide @ point))
        point -= step * (point - 2.0 * wide.T @ (sign * short))
    return objective(matrix, sign, point[:-1], point[-1])


def test_fit_reaches_the_optimum(spark):
    train, matrix, signs = toy(spark)
    model, values = svm.fit_model(train, ["a", "b", "never", "always"], matrix.shape[1])
    for label in (0, 1):
        best = plain_solver(matrix, signs[:, label])
        ours = objective(matrix, signs[:, label], model.weights[label], model.intercepts[label])
        assert ours == pytest.approx(values[label]) and ours <= best * (1 + 1e-5)
    assert model.intercepts[2] == -np.inf and model.intercepts[3] == np.inf


def test_merging_sums_of_many_tasks(spark, monkeypatch):
    train, matrix, _ = toy(spark)
    weights, intercepts = np.full((2, matrix.shape[1]), 0.1), np.array([0.2, -0.1])
    whole = svm.loss_and_gradient(svm.sparse_blocks(train.coalesce(1)), np.array([0, 1]), 4, weights, intercepts, 1.0)
    for width in (2, 64):
        monkeypatch.setattr(svm, "MERGE_WIDTH", width)
        parts = svm.loss_and_gradient(svm.sparse_blocks(train), np.array([0, 1]), 4, weights, intercepts, 1.0)
        for one, other in zip(whole, parts):
            assert other == pytest.approx(one)


def test_separable_corpus_is_learnt(spark):
    docs = [("wine beer juice", ["drink"]), ("beer wine", ["drink"]), ("steel iron", ["metal"]),
            ("iron copper steel", ["metal"]), ("wine steel", ["drink", "metal"])] * 4
    corpus = corpus_of(spark, docs)
    names = labels.label_names(labels.top_labels(corpus))
    tfidf = fit_tfidf(corpus)
    kept = labels.binarized(labels.with_kept_tags(corpus, names), names)
    vectors = tfidf.transform(with_grams(corpus))
    model, _ = svm.fit_model(vectors.join(kept.select("doc_id", "targets"), "doc_id"), names, tfidf.size,
                             Settings(svc_c=10.0))
    predicted = {r.doc_id: sorted(r.labels) for r in svm.predict(vectors, model).collect()}
    assert predicted == {f"d{i}": sorted(tags) for i, (_, tags) in enumerate(docs)}


def test_margins_match_a_dense_product(spark):
    train, matrix, _ = toy(spark, n=150)
    rng = np.random.default_rng(5)
    model = LinearModel(["a", "b"], rng.normal(size=(2, matrix.shape[1])), np.array([0.5, -np.inf]))
    got = {r.doc_id: r.margins for r in svm.with_margins(train, model).collect()}
    for i in range(150):
        assert got[f"d{i}"][0] == pytest.approx(matrix[i] @ model.weights[0] + 0.5)
        assert got[f"d{i}"][1] == -np.inf
    assert all("b" not in r.labels for r in svm.predict(train, model).collect())


def test_model_table_round_trip(spark, tmp_path):
    model = LinearModel(["a", "b"], np.array([[0.0, 1.5], [2.0, 0.0]]), np.array([0.5, -1.0]))
    model.to_table(spark).write.parquet(str(tmp_path / "m"))
    again = LinearModel.from_table(spark.read.parquet(str(tmp_path / "m")))
    assert again.labels == model.labels
    assert np.array_equal(again.weights, model.weights) and np.array_equal(again.intercepts, model.intercepts)
    words = spark.createDataFrame([(0, "x"), (1, "y")], "idx int, gram string")
    rows = sorted(tuple(r) for r in svm.coefficient_rows(model.to_table(spark), words).collect())
    assert rows == [("a", "y", 1.5), ("b", "x", 2.0)]


def frequent_and_rare(spark, n=400, features=600, seed=7):
    """Rows of unit length whose features fall off in frequency like words, with labels that follow nothing."""
    rng = np.random.default_rng(seed)
    matrix = np.where(rng.random((n, features)) < 8.0 / (8.0 + np.arange(features)), rng.random((n, features)) + 0.1, 0.0)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    rows = [
        (f"d{i}", [int(j) for j in np.flatnonzero(row)], [float(v) for v in row[row > 0]],
         [t for t in range(3) if rng.random() < 0.2])
        for i, row in enumerate(matrix)
    ]
    schema = "doc_id string, indices array<int>, values array<double>, targets array<int>"
    return spark.createDataFrame(rows, schema).coalesce(2), matrix


def test_curvature_of_a_small_space_is_exact(spark):
    train, matrix, _ = toy(spark)
    values, vectors, rest = svm.curvature(svm.sparse_blocks(train), matrix.shape[1])
    wide = np.column_stack([matrix, np.ones(len(matrix))])
    assert rest == 0.0 and vectors.T @ vectors == pytest.approx(np.eye(len(values)), abs=1e-9)
    assert vectors @ np.diag(values) @ vectors.T == pytest.approx(wide.T @ wide, abs=1e-6)


def test_fit_takes_few_passes(spark, monkeypatch):
    train, matrix = frequent_and_rare(spark)
    passes, plain = [], svm.loss_and_gradient
    monkeypatch.setattr(svm, "loss_and_gradient", lambda *args: passes.append(1) or plain(*args))
    model, _ = svm.fit_model(train, ["a", "b", "c"], matrix.shape[1])
    assert model.converged.all() and len(passes) <= 20


def test_sign_coefficients_count_documents_row_by_row(spark):
    corpus = corpus_of(spark, [("aa bb aa", ["x", "x"]), ("aa", ["x", "y"]), ("bb", ["y"]), ("bb cc", ["y"]), ("", ["y"])])
    tfidf = fit_tfidf(corpus, Settings(ngram_max=1))
    train = with_grams(corpus.withColumn("kept_tags", F.col("tags")), Settings(ngram_max=1))
    signs = sign_coefficients(train, tfidf.table, 5)
    grams = {r.idx: r.gram for r in tfidf.table.collect()}
    assert {(r.label, grams[r.idx]): r.coef for r in signs.collect()} == {
        ("x", "aa"): 1.0, ("x", "bb"): -1.0, ("y", "aa"): -1.0, ("y", "bb"): -1.0, ("y", "cc"): 1.0,
    }
    assert "hashpartitioning(doc_id" not in signs._jdf.queryExecution().executedPlan().toString()


def test_vectors_are_made_row_by_row(spark):
    corpus = corpus_of(spark, [("aa bb aa", []), ("bb cc dd", []), ("", []), ("aa bb cc", [])])
    model = fit_tfidf(corpus, Settings(max_features=5))
    rows = with_grams(corpus_of(spark, [("aa bb aa bb", []), ("zz yy", []), ("", []), ("dd cc bb aa", [])]))
    rows = rows.unionByName(rows.limit(1).withColumns({"doc_id": F.lit(None).cast("string"), "grams": F.lit(None).cast("array<string>")}))
    placed = model.transform(rows)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Generate" not in plan

    def entries(found):
        return {r.doc_id: sorted((i, round(v, 12)) for i, v in zip(r.indices, r["values"])) for r in found.collect()}

    assert placed.schema["indices"].dataType.simpleString() == "array<int>"
    assert entries(placed) == entries(model.transform(rows, settings=Settings(broadcast_rows=0)))
    assert sum(len(found) > 0 for found in entries(placed).values()) == 2 and len(entries(placed)) == 5


def test_vectors_are_made_once(spark):
    corpus = corpus_of(spark, [("aa bb aa", ["x"]), ("bb cc", ["y"]), ("", ["y"])])
    model = fit_tfidf(corpus)
    train = with_grams(corpus.withColumn("kept_tags", F.col("tags")))
    for plan in (long_weights(model.transform(train), model), sign_coefficients(train, model.table, 3)):
        shown = plan._jdf.queryExecution().optimizedPlan().toString()
        assert shown.count("ArrowEvalPython") == 1


def test_fit_has_at_most_a_task_for_each_core(spark, monkeypatch):
    train, matrix, _ = toy(spark)
    tasks, plain = [], svm.sparse_blocks
    monkeypatch.setattr(svm, "sparse_blocks", lambda rows: tasks.append(rows.rdd.getNumPartitions()) or plain(rows))
    model, _ = svm.fit_model(train.repartition(40), ["a", "b", "never", "always"], matrix.shape[1])
    assert tasks == [spark.sparkContext.defaultParallelism] and model.converged.all()


def test_blocks_hold_entries_once_and_bounded_cells(spark):
    # Entries of one feature add up; rows without entries, null ones too, count.
    rows = [([2, 0, 2], [1.0, 2.0, 3.0], [0]), ([], [], []), (None, None, None), ([1], [5.0], [1, 0])] + [([], [], [])] * 1500
    train = spark.createDataFrame(rows, "indices array<int>, values array<double>, targets array<int>").coalesce(1)
    packed = svm.sparse_blocks(train)
    assert packed.columns == ["features", "cells", "values", "targets", "target_ends"]
    batch = packed.toArrow().combine_chunks().to_batches()[0]
    blocks = [svm._Block(batch, i) for i in range(batch.num_rows)]
    assert sum(b.size for b in blocks) == 1504 and all(b.size <= svm.DENSE_ROWS for b in blocks)
    at = np.eye(4)
    assert blocks[0].times(at)[:4].tolist() == [[2, 0, 4, 0], [0] * 4, [0] * 4, [0, 5, 0, 0]]
    assert blocks[0].transposed_times(blocks[0].times(at))[:3].tolist() == [[4, 0, 8, 0], [0, 25, 0, 0], [8, 0, 16, 0]]
    assert blocks[0].signs(2)[:4].tolist() == [[1, -1], [-1, -1], [-1, -1], [1, 1]]


@pytest.mark.parametrize("together", [1, 32])
def test_optimality_has_a_row_for_each_document(spark, monkeypatch, together):
    train, matrix, signs = toy(spark)
    train = train.unionByName(spark.createDataFrame([("empty", [], [], [0, 3])], train.schema))
    names = ["a", "it's b", "never", "always"]
    grams = spark.createDataFrame([(i, f"g{i}") for i in range(matrix.shape[1])], "idx int, gram string")
    model, _ = svm.fit_model(train, names, matrix.shape[1])
    held = {}
    plain = catalog.store
    monkeypatch.setattr(catalog, "store", lambda df, name, **more: held.setdefault(name, []).append(plain(df, name, **more)) or held[name][-1])
    monkeypatch.setattr(catalog, "TOGETHER", together, raising=False)

    def checked(weights):
        moved = LinearModel(names, weights, model.intercepts)
        stub = SimpleNamespace(spark=spark, fitted=(moved, None), training_table=train, tfidf=TfidfModel(grams, matrix.shape[1]))
        return {r.label: r.converged for r in catalog.svc_optimality(stub).collect()}

    assert checked(model.weights) == {"a": True, "it's b": True}
    assert all(part.count() == 61 for part in held["pulls"])
    weights = model.weights.copy()
    weights[1, 0] += 0.01
    assert checked(weights) == {"a": True, "it's b": False}


def test_passes_leave_no_shuffle_files(spark):
    train, matrix, _ = toy(spark)
    blocks = svm.sparse_blocks(train).cache()
    weights, intercepts = np.full((2, matrix.shape[1]), 0.1), np.array([0.2, -0.1])
    kept = spark.conf.get(svm.DROP_SHUFFLES)

    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").split(",")
        return {name for name in held if "shuffle_" in name}

    svm.loss_and_gradient(blocks, np.array([0, 1]), 4, weights, intercepts, 1.0)
    there = files()
    for _ in range(3):
        svm.loss_and_gradient(blocks, np.array([0, 1]), 4, weights, intercepts, 1.0)
    for _ in range(100):  # files go in the background
        if files() <= there:
            break
        time.sleep(0.1)
    assert files() <= there and spark.conf.get(svm.DROP_SHUFFLES) == kept
    blocks.unpersist()
