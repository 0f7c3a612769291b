import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.config import Settings
from docquarry.operators import index as indexing
from docquarry.operators import retrieve, search
from docquarry.operators.clean import blank_to_null, clean_acts
from docquarry.operators.corpus import build_corpus, last_copy, with_query_tokens, with_tokens
from docquarry.operators.svm import LinearModel, predict
from docquarry.operators.tfidf import fit_tfidf, with_grams
from docquarry.session import join_hot, spread, store
from docquarry.sources import tables


def corpus_of(spark, docs):
    rows = [(doc_id, place, [], tokens) for place, (doc_id, tokens) in enumerate(docs)]
    frame = spark.createDataFrame(rows, "doc_id string, row_no long, tags array<string>, tokens array<string>")
    return store(frame, "corpus", bucket_by="doc_id")


@pytest.fixture(scope="module")
def small(spark):
    return indexing.build_index(
        corpus_of(spark, [("d1", ["a", "a", "b"]), ("d2", ["b", "c"]), ("d3", ["c"])])
    )


def queries_of(spark, rows):
    return spark.createDataFrame(rows, "qid string, tokens array<string>")


def scores_of(spark, index, tokens, settings=Settings()):
    terms = retrieve.weighted_terms(queries_of(spark, [("q", tokens)]), index)
    return {r.doc_id: r.score for r in retrieve.bm25_scores(terms, index, settings).collect()}


def test_hand_computed_scores(spark, small):
    assert small.total_documents == 3 and small.avgdl == 2.0
    got = scores_of(spark, small, ["a", "c"])
    assert got == {"d1": pytest.approx(1.207174, abs=1e-6), "d3": pytest.approx(0.606456, abs=1e-6),
                   "d2": pytest.approx(0.470004, abs=1e-6)}
    assert scores_of(spark, small, ["a", "a", "c"])["d1"] == pytest.approx(2.414349, abs=1e-6)


def test_salted_join_gives_the_same_scores(spark, small):
    assert scores_of(spark, small, ["a", "b", "c"], Settings(broadcast_rows=0)) == pytest.approx(
        scores_of(spark, small, ["a", "b", "c"])
    )


def test_salted_join_keeps_every_pair(spark):
    large = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z")], "k long, w string")
    expected = sorted(tuple(r) for r in large.join(small, "k").collect())
    assert sorted(tuple(r) for r in join_hot(large, small, "k", "v", 0).collect()) == expected


def test_empty_corpus(spark):
    index = indexing.build_index(corpus_of(spark, []).where("false"))
    assert (index.total_documents, index.avgdl) == (0, 0.0)
    assert scores_of(spark, index, ["a"]) == {}


def test_top_k_ties_and_prefixes(spark):
    rows = [("q", f"d{i}", float(i % 3)) for i in range(20)]
    scores = spark.createDataFrame(rows, "qid string, doc_id string, score double")
    five = [r.doc_id for r in retrieve.top_k(scores, 5).orderBy("rank").collect()]
    six = [r.doc_id for r in retrieve.top_k(scores.repartition(7), 6).orderBy("rank").collect()]
    assert five == ["d11", "d14", "d17", "d2", "d5"]
    assert six[:5] == five


def test_overwriting_postings(spark):
    rows = [("x", 1, ["a", "a", "b"]), ("x", 2, ["a", "c"]), ("", 3, ["d"]), ("", 4, ["d", "d"])]
    tokens = spark.createDataFrame(rows, "doc_id string, row_no long, tokens array<string>")
    got = {(r.doc_id, r.term): r.tf for r in indexing.overwriting_postings(tokens, "row_no").collect()}
    assert got == {("x", "a"): 1, ("x", "b"): 1, ("x", "c"): 1, ("", "d"): 2}
    lengths = {r.doc_id: r.length for r in indexing.overwriting_lengths(tokens, "row_no").collect()}
    assert lengths == {"x": 2, "": 2}


def test_last_copy_of_a_common_id(spark):
    frame = spark.range(900).select(F.when(F.col("id") % 3 == 0, "").otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = last_copy(frame, "k", "id")
    assert got.count() == 601
    assert got.where("k = ''").first().id == 897
    assert "WindowGroupLimit" in got._jdf.queryExecution().toString()


def test_scoring_shuffles_only_the_best_rows(spark, small):
    terms = retrieve.weighted_terms(queries_of(spark, [("q", ["a", "c"])]), small)
    plan = retrieve.top_k(retrieve.bm25_scores(terms, small), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan


def test_scan_of_postings_names_the_terms(spark, small):
    terms = retrieve.weighted_terms(queries_of(spark, [("q", ["a", "c"])]), small)
    plan = retrieve.bm25_scores(terms, small)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,a)" in plan and "EqualTo(term,c)" in plan


def test_term_ranges_hold_all_terms(spark):
    rng = np.random.default_rng(1)
    words = sorted({"".join(rng.choice(list("abcé日🙂"), rng.integers(1, 5))) for _ in range(300)}, key=str.encode)
    terms = spark.createDataFrame([(w,) for w in words], "term string")
    for most in (1, 3, 64):
        ranges = retrieve.term_ranges(terms, most)
        assert len(ranges) <= most
        assert all(any(low.encode() <= w.encode() <= high.encode() for low, high in ranges) for w in words)
        assert all(a[1].encode() < b[0].encode() for a, b in zip(ranges, ranges[1:]))
    assert retrieve.term_ranges(terms.where("false")) == []


def test_restricted_scores_need_no_shuffle(spark, small):
    labels = spark.createDataFrame([("d1", ["x", "y"]), ("d2", ["x"]), ("d3", []), ("d9", ["y"])], "doc_id string, labels array<string>")
    held = store(labels, "held", bucket_by="doc_id")
    wanted = spark.createDataFrame([("q", "x"), ("q", "y"), ("r", "y")], "qid string, label string")
    terms = retrieve.weighted_terms(queries_of(spark, [("q", ["a", "c"]), ("r", ["zebra"])]), small)
    found = retrieve.restricted_scores(wanted, held, retrieve.bm25_scores(terms, small))
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    scores = scores_of(spark, small, ["a", "c"])
    expected = {("q", "d1"): scores["d1"], ("q", "d2"): scores["d2"], ("q", "d9"): 0.0, ("r", "d1"): 0.0, ("r", "d9"): 0.0}
    for settings in (Settings(), Settings(broadcast_rows=0)):
        found = retrieve.restricted_scores(wanted, held, retrieve.bm25_scores(terms, small), settings)
        assert {(r.qid, r.doc_id): r.score for r in found.collect()} == pytest.approx(expected)


def test_overwriting_postings_shuffle_once(spark):
    rows = [(f"d{i % 7}", i, list("abcab"[: i % 6])) for i in range(60)]
    tokens = spark.createDataFrame(rows, "doc_id string, row_no long, tokens array<string>").repartition(4)
    found = indexing.overwriting_postings(store(tokens, "copies"), "row_no")
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    expected = {}
    for doc, _, held in sorted(rows, key=lambda r: r[1]):
        expected |= {(doc, t): held.count(t) for t in held}
    assert {(r.doc_id, r.term): r.tf for r in found.collect()} == expected


def test_saved_index_needs_no_shuffle_after_loading(spark, small, tmp_path):
    tables.save_index(small, str(tmp_path / "index"))
    loaded = tables.load_index(spark, str(tmp_path / "index"))
    assert scores_of(spark, loaded, ["a", "c"]) == scores_of(spark, small, ["a", "c"])
    terms = retrieve.weighted_terms(queries_of(spark, [("q", ["a", "c"])]), loaded)
    plan = retrieve.bm25_scores(terms, loaded)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


ACTS = [
    (1, "D1", "Apple trade and apple import", "Fruit"),
    (2, "D2", "Apple juice import", "Fruit; Drink"),
    (3, "D3", "Wine and beer export", "Drink"),
    (4, "D4", "Beer tax", "Drink; Tax"),
    (5, "D5", "Steel duty", "Tax;"),
    (6, "D6", "NA", "Tax"),
]


@pytest.fixture(scope="module")
def engine(spark):
    raw = spark.createDataFrame(ACTS, "row_no long, CELEX string, act_raw_text string, EUROVOC string")
    columns = ["CELEX", "act_raw_text", "EUROVOC"]
    corpus = build_corpus(clean_acts(blank_to_null(raw, columns), columns, carry=["row_no"]), "row_no")
    index = indexing.build_index(corpus)
    tfidf = fit_tfidf(corpus)
    place = {r.gram: r.idx for r in tfidf.table.collect()}
    rows = [("fruit", place["apple"], 1.0), ("drink", place["beer"], 1.0), ("drink", place["juice"], 1.0)]
    coefficients = spark.createDataFrame(rows, "label string, idx int, coef double")
    model = LinearModel.from_coefficients(["fruit", "drink", "tax law"], coefficients, tfidf.size)
    tagger = search.Tagger(tfidf, model)
    tag_index = search.build_tag_index(tfidf.transform(with_grams(corpus)), model)
    return index, tag_index, tagger


def answers(spark, engine, rows, **options):
    queries = spark.createDataFrame(rows, "qid string, raw_query string, target_label string")
    found = search.responses(search.search(queries, *engine, **options)).collect()
    return {r.qid: r for r in found}


def test_search_methods(spark, engine):
    got = answers(spark, engine, [
        ("target", "steel", "FRUIT"),
        ("tags", "beer and apple", None),
        ("words", "steel duty 2024", "unknown"),
        ("nothing", "of the", None),
        ("blank", "", ""),
        ("no hit", "zebra", None),
        ("empty label", "steel", "tax_law"),
    ])
    assert {qid: r.method for qid, r in got.items()} == {
        "target": "classifier_eval", "tags": "ml_prediction + bm25", "words": "boolean_only",
        "nothing": "none", "blank": "none", "no hit": "boolean_only", "empty label": "classifier_eval",
    }
    # No document of the label holds a query token: all score 0.0 in id order.
    assert [tuple(r) for r in got["target"].top_results] == [("d1", 0.0), ("d2", 0.0)]
    assert got["target"].predicted_tags == ["fruit"]
    assert got["tags"].predicted_tags == ["fruit", "drink"] and got["tags"].total_hits == 4
    assert {r.doc_id for r in got["tags"].top_results} == {"d1", "d2", "d3", "d4"}
    assert got["words"].query_tokens == ["steel", "duty", "2024"]
    assert [r.doc_id for r in got["words"].top_results] == ["d5"]
    for qid in ("nothing", "blank", "no hit", "empty label"):
        assert (got[qid].total_hits, got[qid].top_results) == (0, [])


def test_tags_without_documents_fall_back_to_words(spark, engine):
    index, tag_index, tagger = engine
    hidden = search.TagIndex(
        tag_index.doc_labels.withColumn("labels", F.array().cast("array<string>")), tag_index.combos.where("false"),
        tag_index.heads.where("false"),
    )
    got = answers(spark, (index, hidden, tagger), [("q", "beer", None)])["q"]
    assert got.method == "boolean_fallback" and {r.doc_id for r in got.top_results} == {"d3", "d4"}


def test_zero_scores_fill_up_after_scored_documents(spark, engine):
    for k in (1, 2, 3, 4, 10):
        got = answers(spark, engine, [("q", "wine beer apple", None)], k=k)["q"]
        found = [r.doc_id for r in got.top_results]
        assert got.total_hits == 4 and len(found) == min(k, 4)
        assert found == [r.doc_id for r in answers(spark, engine, [("q", "wine beer apple", None)])["q"].top_results][:k]
    got = answers(spark, engine, [("q", "juice", None)], k=3)["q"]
    assert [r.doc_id for r in got.top_results] == ["d2", "d3", "d4"]
    assert got.top_results[0].score > 0 and got.top_results[1].score == 0.0


def test_strict_labels(spark, engine):
    assert answers(spark, engine, [("q", "steel", "tax_law")], strict_label_match=True)["q"].method == "boolean_only"
    assert answers(spark, engine, [("q", "steel", "tax law")], strict_label_match=True)["q"].method == "classifier_eval"


def test_idf_formula(spark, small):
    row = retrieve.idf_table(small.doc_freq, small.total_documents).where("term = 'a'").first()
    assert row.idf == pytest.approx(math.log((3 - 1 + 0.5) / 1.5 + 1))


def test_saved_tagger_and_tag_index(spark, engine, tmp_path):
    index, tag_index, tagger = engine
    tables.save_tagger(tagger, str(tmp_path / "tagger"))
    tables.save_tag_index(tag_index, str(tmp_path / "tags"))
    again = (index, tables.load_tag_index(spark, str(tmp_path / "tags")), tables.load_tagger(spark, str(tmp_path / "tagger")))
    query = [("q", "beer and apple", None)]
    assert answers(spark, again, query) == answers(spark, engine, query)


def test_a_killed_write_leaves_the_old_version(spark, small, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    tables.save_index(small, path)
    other = indexing.build_index(corpus_of(spark, [("d7", ["a", "z"])]))
    write = tables._save_by_document
    monkeypatch.setattr(tables, "_save_by_document", lambda df, place, by: write(df, place, by) and exec("raise KeyboardInterrupt"))
    with pytest.raises(KeyboardInterrupt):
        tables.save_index(other, path)
    monkeypatch.undo()
    assert len(list((tmp_path / "index" / "versions").iterdir())) == 2
    assert tables.load_index(spark, path).total_documents == 3
    held = tables.load_index(spark, path)
    tables.save_index(other, path)
    # The killed write is gone; a reader of the version before may go on.
    assert len(tables.versions(spark, path)) == len(list((tmp_path / "index" / "versions").iterdir())) == 2
    assert tables.load_index(spark, path).total_documents == 1
    assert scores_of(spark, held, ["a", "c"]) == scores_of(spark, small, ["a", "c"])
    tables.save_index(other, path)
    assert len(tables.versions(spark, path)) == 2


def test_overwriting_index_keeps_terms_of_earlier_copies(spark):
    rows = [("d1", 1, ["a", "a", "b"]), ("d1", 2, ["b", "c", "c", "c"]), ("d2", 3, ["c"])]
    built = indexing.build_index(spark.createDataFrame(rows, "doc_id string, n int, tokens array<string>"), "overwrite", "n")
    found = {(r.doc_id, r.term): (r.tf, r.length) for r in built.postings.collect()}
    assert found == {("d1", "a"): (2, 4), ("d1", "b"): (1, 4), ("d1", "c"): (3, 4), ("d2", "c"): (1, 1)}
    assert (built.total_documents, built.avgdl) == (3, 8 / 3)


def test_lemmas_serve_documents_and_queries(spark):
    lemmas = spark.createDataFrame([("went", "go"), ("mice", "mouse")], "surface string, lemma string")
    acts = spark.createDataFrame([("d1", 1, "mice went 7 farms", [])], "CELEX string, row_no long, act_raw_text string, EUROVOC array<string>")
    assert build_corpus(acts, "row_no", lemmas=lemmas).first().tokens == ["mouse", "go", "farm"]
    queries = spark.createDataFrame([("q", "Mice went 42 times"), ("e", "")], "qid string, raw_query string")
    found = {r.qid: r.tokens for r in with_query_tokens(queries, lemmas=lemmas).collect()}
    assert found == {"q": ["mouse", "go", "42", "time"], "e": []}


def test_missing_and_restricted_tag_index(spark, tmp_path):
    assert tables.load_tag_index(spark, str(tmp_path / "nothing"), missing_ok=True).label_index().count() == 0
    rows = spark.createDataFrame([("d1", ["x", "y"]), ("d2", ["x"]), ("d3", [])], "doc_id string, labels array<string>")
    index = search.TagIndex(rows, rows, rows)
    only = spark.createDataFrame([("d2",), ("d3",)], "doc_id string")
    assert [tuple(r) for r in index.label_index(only).collect()] == [("x", "d2")]


def test_no_labels_to_predict(spark):
    rows = spark.createDataFrame([("d1", [0], [1.0]), ("d2", [], [])], "doc_id string, indices array<int>, values array<double>")
    model = LinearModel([], np.zeros((0, 1)), np.zeros(0))
    assert sorted((r.doc_id, r.labels) for r in predict(rows, model).collect()) == [("d1", []), ("d2", [])]


def test_spreading_rows_starts_no_job(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "rows"))
    read = spark.read.parquet(str(tmp_path / "rows"))  # reading the schema is a job of its own
    spark.sparkContext.setJobGroup("spread", "plans only")
    rows = spread(read, "id")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("spread")
    assert rows.count() == 10


def test_tag_set_hits_meet_label_sets_once(spark):
    names = [f"l{i:02}" for i in range(70)]
    sets = [names[i: i + 1 + i % 5] for i in range(70)] + [[names[0], names[69]], ["other"]]
    combos = spark.createDataFrame([(held, n + 1) for n, held in enumerate(sets)], "labels array<string>, n long")
    wanted = [[names[3]], names[60:], names, [names[69], names[1]], ["unheld"], names[60:]]
    found = search.tag_set_hits(spark.createDataFrame([(w,) for w in wanted], "tags array<string>"), combos)
    expected = {tuple(w): sum(n + 1 for n, held in enumerate(sets) if set(w) & set(held)) for w in wanted}
    assert {tuple(r.tags): r.tag_hits for r in found.collect()} == {w: n for w, n in expected.items() if n}
    assert "hashpartitioning(label#" not in found._jdf.queryExecution().executedPlan().toString()
    assert search.tag_set_hits(spark.createDataFrame([], "tags array<string>"), combos).count() == 0


def test_queries_that_share_an_id_have_one_vector(spark):
    model = fit_tfidf(spark.createDataFrame([("d", ["aa", "bb"])], "doc_id string, tokens array<string>"), Settings(ngram_max=1))
    queries = spark.createDataFrame([("q", "aa"), ("q", "bb"), ("n", None)], "qid string, raw_query string")
    found = {r.qid: sorted(r.indices) for r in search.query_vectors(queries, model, settings=Settings(ngram_max=1)).collect()}
    assert found == {"q": [0, 1], "n": []}


def test_postings_of_ids_that_come_once_are_not_shuffled(spark, monkeypatch):
    # Ids that come once, that repeat, that are empty or null, and that share a bit of a small map with others.
    ids = [f"d{i}" for i in range(300)] + [f"d{i}" for i in range(0, 300, 30)] + ["", "", None, None]
    rows = [(doc, i, list("abcab"[: 1 + i % 5])) for i, doc in enumerate(ids)]
    tokens = spark.createDataFrame(rows, "doc_id string, row_no long, tokens array<string>").repartition(4)
    tokens = store(tokens, "copies")
    expected = {}
    for doc, _, held in rows:
        expected |= {(doc, t): held.count(t) for t in held}
    repeats = indexing.repeated_ids(tokens)
    marked = {r.doc_id for r in tokens.where(repeats).collect()}
    assert {doc for doc in ids if ids.count(doc) > 1} <= marked and len(marked) < 30
    found = indexing.overwriting_postings(tokens, "row_no")
    assert {(r.doc_id, r.term): r.tf for r in found.collect()} == expected and found.count() == len(expected)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("Aggregate") == 1
    plain = indexing.repeated_ids
    monkeypatch.setattr(indexing, "repeated_ids", lambda rows: plain(rows, bits=3))
    found = indexing.overwriting_postings(tokens, "row_no")
    assert {(r.doc_id, r.term): r.tf for r in found.collect()} == expected and found.count() == len(expected)


def test_rows_are_told_apart_before_they_are_tokenized(spark):
    rows = [("x", 1, "aa bb"), ("x", 2, "aa"), ("y", 3, "cc")]
    texts = spark.createDataFrame(rows, "doc_id string, row_no long, act_raw_text string")
    found = indexing.overwriting_postings(with_tokens(texts).drop("act_raw_text"), "row_no")
    assert sorted((r.doc_id, r.term, r.tf) for r in found.collect()) == [("x", "aa", 1), ("x", "bb", 1), ("y", "cc", 1)]
    # Each copy of the rows is filtered first: the test of the ids stands below the splitting of the texts.
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    split = [i for i, line in enumerate(plan) if "ArrowEvalPython [kept(" in line]
    told = [i for i, line in enumerate(plan) if "ArrowEvalPython [marked(" in line]
    assert len(split) == len(told) == 2 and all(a < b for a, b in zip(split, told))
