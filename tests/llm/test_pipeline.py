"""Every stage of the pipeline against a plain version on its own input, and the stages together."""

import zlib

import numpy as np
import pytest
from helpers import components, documents, shingles
from test_secrets import base_spans, entropy_spans

import corpus_pipeline
from docquarry.llm import quality, tokens
from docquarry.llm.common import store, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def passed(spark):
    """The rows before the first stage and after each, by stage name."""
    found, docs = {"documents": table(spark, SF_DIR, "documents")}, table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = store(stage(spark, docs, SF_DIR), name)
    return {name: rows.collect() for name, rows in found.items()}


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_stages_keep_the_columns(passed):
    for name in list(passed)[:-1]:
        assert list(passed[name][0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_rejected_documents_go(spark, passed):
    docs = table(spark, SF_DIR, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, SF_DIR, "labels"))).collect()
    assert texts(passed["quality"]).keys() == {r["doc_id"] for r in scored if r["score"] >= quality.CUT}
    assert len(passed["quality"]) < len(passed["documents"])


def test_one_document_of_each_group_stays(passed):
    expected = components(list(texts(passed["quality"]).items()), 5, 4, 5)
    assert texts(passed["near_duplicates"]).keys() == {i for i, (_, head) in expected.items() if i == head}
    assert len(passed["near_duplicates"]) < len(passed["quality"])


def test_documents_with_items_go(spark, passed):
    items = [shingles(r["text"], 5) for r in table(spark, SF_DIR, "benchmark").collect()]
    before = texts(passed["near_duplicates"])
    dirty = {i for i, t in before.items() if any(5 * len(s & shingles(t, 5)) >= 4 * len(s) for s in items if s)}
    assert texts(passed["decontamination"]).keys() == before.keys() - dirty
    assert dirty


def test_secrets_are_replaced(passed):
    before, after = texts(passed["decontamination"]), passed["secrets"]
    for row in after:
        clean, at = "", 0
        for start, _, end, _ in sorted(base_spans(before[row["doc_id"]]) + entropy_spans(before[row["doc_id"]])):
            if start >= at:
                clean += before[row["doc_id"]][at:start] + "[secret]"
            at = max(at, end)
        assert row["text"] == clean + before[row["doc_id"]][at:]
        assert row["n_chars"] == len(row["text"])
    assert len(after) == len(before)


def test_every_id_is_packed_once(passed):
    encoder = tokens.encoder(tokens.vocabulary_path("byte_bpe_50k.json"), False).tokenizer
    left, end = texts(passed["secrets"]), {}
    sums = dict.fromkeys(left, 0)
    for row in sorted(passed["packing"], key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == end.get(row["sequence_id"], 0)
        end[row["sequence_id"]] = row["offset"] + row["length"]
        ids = np.array([*encoder.encode(left[row["doc_id"]], add_special_tokens=False).ids, 1], "<u4")
        assert row["ids_crc32"] == zlib.crc32(ids[row["start"]: row["start"] + row["length"]].tobytes())
        sums[row["doc_id"]] += row["length"]
        assert row["doc_tokens"] == len(ids)
    assert all(sums.values()) and max(end.values()) <= 2048
    assert sum(2048 - e for e in end.values() if e & (e - 1)) <= 0.02 * sum(end.values())


def test_run_gives_the_same_pieces(spark, passed):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(tuple(r[c] for c in columns) for r in found) == sorted(tuple(r[c] for c in columns) for r in passed["packing"])


def test_odd_rows_pass_the_stages(spark):
    """Which rows and texts are left after each stage; the classifier's verdict on them is read from its scores."""
    long, secret = "word " * 30_000, "token = kJ8f2Lq0ZpX7vB3nR6tY1wS5"
    rows = [(1, None), (2, ""), (3, long), (4, "a b c d e f"), (4, "a b c d e f"), (None, "lost"), (5, "A B C D E F"), (6, secret)]
    model = quality.fit(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    odds = {t: o for t, o in zip([t for _, t in rows], quality.log_odds(model, [t.encode() if t else None for _, t in rows]))}
    least = np.log(quality.CUT / (1 - quality.CUT))
    first = [(i, t) for i, t in rows if odds[t] >= least]
    for some in (rows, []):
        docs, left = documents(spark, some).withColumnRenamed("lang", "digest").withColumnRenamed("source", "own_id"), {}
        for name, stage in corpus_pipeline.STAGES:
            if name == "quality":  # learnt from the given documents
                docs = quality.without_rejected(docs, model)
            else:
                docs = stage(spark, docs, SF_DIR)
            docs = store(docs, name)
            left[name] = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr) if name != "packing" else docs.collect()
        if not some:
            assert not any(left.values())
            continue
        assert left["quality"] == sorted(first, key=repr)
        # Of equal texts, and of rows of an id, one is left; texts without words and rows without an id all stay.
        once = {t.lower() if t and t.strip() else (i, t): (i, t) for i, t in reversed(first) if i is not None} | {(i, t): (i, t) for i, t in first if i is None}
        assert left["near_duplicates"] == sorted(once.values(), key=repr) == left["decontamination"]
        assert left["secrets"] == sorted(((i, "[secret]" if t == secret else t) for i, t in once.values()), key=repr)
        assert {r["doc_id"] for r in left["packing"]} == {i for i, _ in once.values()}


