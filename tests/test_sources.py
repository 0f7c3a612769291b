import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docquarry.operators.clean import clean_acts, dropped_counts, preview_rows
from docquarry.operators.corpus import last_copy, with_tokens
from docquarry.operators.judgments import clean_id_map
from docquarry.sources import files, tables

CSV = '''CELEX,act_raw_text,EUROVOC,extra
A1,"line one
said ""two"", three",Tax; Sea Fish ;;,1
A2,NA,x,2
A3,,y,NA
A4,na plain text,null,4
'''


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "acts.csv"
    path.write_text(CSV)
    return str(path)


COLUMNS = ["CELEX", "act_raw_text", "EUROVOC"]


def test_csv_rules(spark, csv_file):
    raw = files.read_acts(spark, csv_file, COLUMNS)
    assert tuple(dropped_counts(raw).first()) == (4, 2, 2)
    rows = clean_acts(raw, COLUMNS).orderBy("CELEX").collect()
    assert [tuple(r) for r in rows] == [
        ("a1", 'line one\nsaid "two", three', ["tax", "sea fish"]),
        ("a4", "na plain text", []),
    ]


def test_column_pruning_reaches_the_scan(spark, csv_file):
    plan = files.read_acts(spark, csv_file, ["CELEX"]).select("CELEX")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<CELEX:string>" in plan


def test_tags_are_optional(spark, csv_file):
    raw = files.read_acts(spark, csv_file, ["CELEX", "act_raw_text"])
    assert clean_acts(raw, ["CELEX", "act_raw_text"]).columns == ["CELEX", "act_raw_text"]


def test_literal_nan_tag(spark):
    frame = spark.createDataFrame([("x", "t", "NaN"), ("y", "t", "a;a; b")], "CELEX string, act_raw_text string, EUROVOC string")
    got = [r.EUROVOC for r in clean_acts(frame, COLUMNS).orderBy("CELEX").collect()]
    assert got == [[], ["a", "a", "b"]]


def test_missing_sources_and_columns(spark, csv_file, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_acts(spark, str(tmp_path / "absent.csv"))
    assert files.or_none(lambda: files.read_head(spark, str(tmp_path / "absent.csv"))) is None
    with pytest.raises(ValueError):
        files.read_acts(spark, csv_file, ["CELEX", "no such column"])


def test_wide_types(spark, tmp_path):
    (tmp_path / "wide.csv").write_text(
        "CELEX,date_publication,n,share,flag,none,mixed\n"
        "a,20010101,0012,1.5,True,,1\nb,NA,NaN,2,False,,x\nc,20020202,7,-1e3,True,NA,2\n"
    )
    wide = files.read_wide_acts(spark, str(tmp_path / "wide.csv"))
    assert dict(wide.dtypes) == {
        "CELEX": "string", "date_publication": "string", "n": "bigint", "share": "double",
        "flag": "boolean", "none": "string", "mixed": "string",
    }
    rows = wide.orderBy("CELEX").collect()
    assert [r.n for r in rows] == [12, None, 7] and [r.share for r in rows] == [1.5, 2.0, -1000.0]
    assert rows[0].date_publication == "20010101"


def test_head_and_preview(spark, csv_file):
    assert files.read_head(spark, csv_file, 2).count() == 2
    frame = spark.createDataFrame([("x" * 151,), ("y" * 150,), (None,)], "act_raw_text string")
    got = [(r.id, r.preview, r.tags) for r in preview_rows(frame).collect()]
    assert got == [("N/A", "x" * 150 + "...", "N/A"), ("N/A", "y" * 150, "N/A"), ("N/A", None, "N/A")]


def test_file_order_over_several_files(spark, tmp_path):
    (tmp_path / "ids").mkdir()
    (tmp_path / "ids" / "1.csv").write_text("DocID,CelexID\n7,first\n8,only\n7,second\n")
    (tmp_path / "ids" / "2.csv").write_text("DocID,CelexID\n7,third\n")
    rows = files.read_id_map(spark, str(tmp_path / "ids"))
    got = {r.DocID: r.CelexID for r in last_copy(rows.repartition(4), "DocID", "row_order").collect()}
    assert got == {"7": "third", "8": "only"}


def test_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "q.txt").write_text("".join(f"label {i} 1\n" for i in range(500)))
    lines = files.read_judgment_lines(spark, str(tmp_path / "q.txt"))
    got = [r.line.split()[1] for r in lines.repartition(6).orderBy("row_order").collect()]
    assert got == [str(i) for i in range(500)]


def test_corpus_round_trip(spark, csv_file, tmp_path):
    corpus = with_tokens(clean_acts(files.read_acts(spark, csv_file, COLUMNS), COLUMNS))
    tables.save_corpus(corpus, str(tmp_path / "corpus"))
    again = tables.load_corpus(spark, str(tmp_path / "corpus"))
    assert again.dtypes == corpus.dtypes
    assert again.exceptAll(corpus).count() == 0 and again.count() == corpus.count()
    assert again.select(F.max(F.size("tokens"))).first()[0] == 5  # line one said two three


def test_numbered_files_are_read_in_the_order_of_their_numbers(spark, tmp_path):
    for name, target in (("2", "old"), ("10", "new")):
        (tmp_path / f"{name}.csv").write_text(f"DocID,CelexID\nx,{target}\n")
    found = clean_id_map(files.read_id_map(spark, str(tmp_path / "*.csv")), "row_order")
    assert [(r.source_id, r.doc_id) for r in found.collect()] == [("x", "new")]
