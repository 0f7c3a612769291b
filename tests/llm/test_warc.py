import pytest

from docquarry.llm import warc
from docquarry.llm.common import shared_path

PAGES = "page_id long, url string, html string, record_type string"


def round_trip(spark, rows, **options):
    folder = shared_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), folder, **options)
    return warc.read_pages(spark, folder).collect()


@pytest.mark.parametrize("payload", [b"", b"a", b"WARC/1.1\r\n" * 50, b"x" * 100_000, b"WARC/1.1", b"ab\r\n0\r\n\r\nWARC/1.1"])
def test_framing_round_trip(payload):
    framed = warc.chunked(payload, 777)
    assert warc.dechunked(framed) == payload
    assert warc.VERSION not in framed


def test_cut_framing_is_noticed():
    with pytest.raises(ValueError):
        warc.dechunked(warc.chunked(b"abcdef")[:-9])


def test_pages_come_back_whole(spark):
    long = "é🙂WARC/1.1\r\n\r\n" * 20_000
    rows = [
        (5, "http://a b\r\nc", "same", "x"), (3, None, "same", "x"), (9, "u", "same", None), (1, "u", None, "x"), (2, "u", "", "x"),
        (7, "u", long, "x"), (8, "u", long, "x"), (10, "u", "other\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "x"),
    ]
    found = {r["page_id"]: r for r in round_trip(spark, rows, segment_bytes=5000)}
    assert len(found) == len(rows)
    first = {"same": 3, "": 1, long: 7, rows[-1][2]: 10}
    for page, _, html, _ in rows:
        row, html = found[page], html or ""
        assert row["problem"] is None
        assert row["payload_bytes"] == len(html.encode())
        assert row["payload_digest"] == warc.payload_digest(html.encode())
        revisit = first[html] != page
        assert row["record_type"] == ("revisit" if revisit else "response")
        assert row["refers_to"] == (first[html] if revisit else None)
        assert row["payload"] == (None if revisit else html.encode())
    assert found[7]["n_segments"] > 10


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "u", "a", None)] * 2 + [(2, "u", "a", None), (None, "u", "a", None), (None, "u", "b", None), (None, "u", "b", None)]
    found = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in round_trip(spark, rows, segment_bytes=40)), key=repr)
    assert found == sorted(
        [(1, "response", None)] * 2 + [(2, "revisit", 1), (None, "revisit", 1)] + [(None, "response", None)] * 2, key=repr
    )


def test_small_payloads_may_stay_responses(spark):
    rows = [(1, "u", "ab", None), (2, "u", "ab", None), (3, "u", "abc", None), (4, "u", "abc", None)]
    found = {r["page_id"]: r["record_type"] for r in round_trip(spark, rows, least_bytes=3)}
    assert found == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_no_pages(spark):
    folder = shared_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], PAGES), folder)
    assert warc.read_pages(spark, folder).count() == 0


def test_damage_is_reported(spark, tmp_path):
    records = [bytes(r) + b"\r\n" for r in warc.records_of(4, "u", b"payload" * 100, None, False, "0.0", 200)]
    (tmp_path / "a.warc").write_bytes(b"".join(records[:1] + records[2:]))
    (tmp_path / "b.warc").write_bytes(b"".join(warc.records_of(5, "u", b"whole", None, False, "0.1", 9999))[:-8] + b"\r\n")
    found = {r["page_id"]: r["problem"] for r in warc.read_pages(spark, str(tmp_path)).collect()}
    assert found[4] == "segment is missing"
    assert found[5] == "block length"


def test_payload_cut_short_in_total(spark, tmp_path):
    records = [bytes(r) + b"\r\n" for r in warc.records_of(4, "u", b"payload" * 100, None, False, "0.0", 200)]
    records[-1] = records[-1].replace(b"Total-Length: ", b"Total-Length: 9")
    (tmp_path / "a.warc").write_bytes(b"".join(reversed(records)))
    assert warc.read_pages(spark, str(tmp_path)).collect()[0]["problem"] == "total length"
