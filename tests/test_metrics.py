import math

import pytest

from docquarry.operators import judgments, ranking_metrics, tagging_metrics
from docquarry.operators import profile
from docquarry.operators.profile import column_types, describe_numbers, first_rows, null_profile


def pairs(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, label string")


def test_multi_label_averages(spark):
    truth = pairs(spark, [("1", "a"), ("1", "c"), ("2", "b")])
    predicted = pairs(spark, [("1", "a"), ("1", "b")])
    labels = spark.createDataFrame([("a",), ("b",), ("c",)], "label string")
    cells = tagging_metrics.outcome_cells(truth, predicted)
    report = {r.average: r for r in tagging_metrics.average_report(cells, labels, 3).collect()}
    assert report["micro"].precision == pytest.approx(0.5)
    assert report["micro"].recall == pytest.approx(1 / 3)
    assert report["micro"].f1 == pytest.approx(0.4)
    for name in ("precision", "recall", "f1"):
        assert report["samples"][name] == pytest.approx(1 / 6)
        assert report["macro"][name] == pytest.approx(1 / 3)
    assert {r.support for r in report.values()} == {3}
    assert tagging_metrics.hamming_loss(cells, 3, 3).first().hamming_loss == pytest.approx(1 / 3)
    rows = {r.label: r for r in tagging_metrics.label_report(cells, labels).collect()}
    assert (rows["a"].precision, rows["b"].precision, rows["c"].recall) == (1.0, 0.0, 0.0)


def test_no_predictions_and_no_truth(spark):
    labels = spark.createDataFrame([("a",)], "label string")
    cells = tagging_metrics.outcome_cells(pairs(spark, []), pairs(spark, []))
    report = tagging_metrics.average_report(cells, labels, 2).collect()
    assert all(r[name] == 0.0 for r in report for name in ("precision", "recall", "f1"))
    assert tagging_metrics.hamming_loss(cells, 2, 1).first().hamming_loss == 0.0


def test_ranking_by_hand(spark):
    run = spark.createDataFrame(
        [("q", "1", 1), ("q", "2", 2), ("q", "3", 3), ("z", "5", 1)], "qid string, doc_id string, rank int"
    )
    judged = spark.createDataFrame(
        [("q", "1", 1), ("q", "3", 1), ("q", "9", 1), ("none", "1", 1), ("z", "5", 0)],
        "qid string, doc_id string, rel int",
    )
    got = {r.qid: r for r in ranking_metrics.query_metrics(run, judged).collect()}
    q = got["q"]
    assert (q.map, q.mrr, q.precision_10) == (pytest.approx(5 / 9), 1.0, pytest.approx(0.2))
    assert q.recall_10 == pytest.approx(2 / 3) and q.ndcg_10 == pytest.approx(0.703918, abs=1e-6)
    assert q.f1_10 == pytest.approx(2 * 0.2 * (2 / 3) / (0.2 + 2 / 3))
    for qid in ("none", "z"):
        assert all(got[qid][name] == 0.0 for name in q.asDict() if name != "qid")
    means = {r.metric: r.value for r in ranking_metrics.mean_metrics(ranking_metrics.query_metrics(run, judged)).collect()}
    assert means["queries"] == 3.0 and means["map"] == pytest.approx(5 / 27)


def test_graded_relevance(spark):
    run = spark.createDataFrame([("q", "a", 1), ("q", "b", 2)], "qid string, doc_id string, rank int")
    judged = spark.createDataFrame([("q", "a", 1), ("q", "b", 3)], "qid string, doc_id string, rel int")
    gain, ideal = 1 + 3 / math.log2(3), 3 + 1 / math.log2(3)
    assert ranking_metrics.query_metrics(run, judged).first().ndcg_10 == pytest.approx(gain / ideal)


def test_judgment_rules(spark):
    lines = spark.createDataFrame(
        [(1, "sea_fish 7 1"), (2, "too few"), (3, "Sea_Fish 7 2 "), (4, "other 7 1"), (5, "tax\t8  0"), (6, "tax 9 1")],
        "line_no int, line string",
    )
    ids = spark.createDataFrame(
        [(1, "7", "X7"), (2, "8", "old"), (3, "8", "NEW"), (4, "8", "Null"), (5, "9", ""), (6, "", "x")],
        "row int, DocID string, CelexID string",
    )
    vocabulary = spark.createDataFrame([("sea fish",), ("tax",)], "label string")
    parsed = judgments.parse_judgments(lines, "line_no")
    assert parsed.count() == 5
    assert judgments.skipped_judgments(parsed, vocabulary).first().skipped == 1
    mapped = judgments.mapped_judgments(
        judgments.vocabulary_judgments(parsed, vocabulary), judgments.clean_id_map(ids, "row")
    )
    final = {(r.qid, r.doc_id): r.rel for r in judgments.final_judgments(mapped, "line_no").collect()}
    assert final == {("sea fish", "x7"): 2, ("tax", "new"): 0}
    assert [r.qid for r in judgments.evaluation_queries(mapped, "line_no", 1).collect()] == ["sea fish"]


@pytest.mark.parametrize("rows", [1, 4, 1001])
def test_exact_quartiles(spark, rows):
    frame = spark.range(rows).selectExpr("cast((id * 7919) % 1013 as int) as a", "if(id = 0, null, id / 3.0D) as b", "'x' as c")
    pandas = frame.toPandas()[["a", "b"]].describe()
    for row in describe_numbers(frame).collect():
        expected = pandas[row.column_name]
        if expected["count"] == 0:
            continue
        for name, key in (("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("mean", "mean"), ("min", "min"), ("max", "max")):
            assert row[name] == pytest.approx(expected[key])
        assert row["count"] == expected["count"]


def test_quartiles_of_a_long_skewed_column(spark):
    # Above a million rows the approximate brackets are used; a third of the rows share a value.
    frame = spark.range(1_500_000).selectExpr("if(id % 3 = 0, 5.0D, (id * 7919) % 1000003 / 7.0D) as a")
    row = describe_numbers(frame).first()
    expected = frame.toPandas()["a"].quantile([0.25, 0.5, 0.75]).tolist()
    assert [row.q25, row.q50, row.q75] == pytest.approx(expected)


def test_profile_rows(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = {r.column_name: (r.rows, r.non_null, r.type) for r in null_profile(frame).collect()}
    assert got == {"a": (2, 2, "int"), "b": (2, 1, "string")}
    assert [tuple(r) for r in column_types(frame).collect()] == [(0, "a", "int"), (1, "b", "string")]
    assert [r.a for r in first_rows(frame, "a", 1).collect()] == [1]


@pytest.mark.parametrize("cuts", [1, 3, 63])
def test_order_statistics_of_skewed_values(spark, cuts):
    values = [0.0] * 400 + [10.0 ** (i % 300) for i in range(300)] + [-(2.0 ** -i) for i in range(300)] + [float("inf")]
    rows = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0)], "column_name string, value double").repartition(5)
    ordered, wanted = sorted(values), [0, 1, 250, 300, 500, 699, 700, 701, 999, 1000]
    found = profile.order_statistics(rows, [("a", rank) for rank in wanted] + [("b", 0)], cuts)
    assert found["b", 0] == (7.0, 0)
    assert {rank: found["a", rank] for rank in wanted} == {rank: (ordered[rank], ordered.index(ordered[rank])) for rank in wanted}


def test_selection_sorts_no_values(spark, monkeypatch):
    """Every job of a selection aggregates: no plan sorts, and none ranks with a window."""
    kind = type(spark.range(1))
    plans, collect = [], kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    frame = spark.range(5000).selectExpr("cast(exp(id % 700) as double) as a")
    describe_numbers(frame)
    assert len(plans) > 2 and not any("Sort [" in p or "Window" in p for p in plans)


def test_only_kept_judgments_need_a_number(spark):
    lines = [(1, "known a one"), (2, "unknown a high"), (3, "known b 2"), (4, "known gone x")]
    parsed = judgments.parse_judgments(spark.createDataFrame(lines[1:], "line_no int, line string"), "line_no")
    vocabulary = spark.createDataFrame([("known",)], "label string")
    ids = spark.createDataFrame([("a", "A"), ("b", "B")], "source_id string, doc_id string")
    kept = judgments.vocabulary_judgments(parsed, vocabulary)
    assert [(r.doc_id, r.rel) for r in judgments.mapped_judgments(kept, ids).collect()] == [("B", 2)]


def test_all_judged_queries_are_evaluated(spark):
    rows = spark.range(700).selectExpr("concat('q', id) as qid", "id as line_no")
    assert judgments.evaluation_queries(rows, "line_no").count() == 700
    assert judgments.evaluation_queries(rows, "line_no", 500).count() == 500
