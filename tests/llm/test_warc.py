import gzip
import hashlib
import io

import pytest

from lading.llm import warc
from lading.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, refers_to string, payload int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)


def expected(rows):
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(first.get(body, i), i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        least = first.get(body)
        again = least is not None and (i is None or i > least)
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", least if again else None))
    return sorted(out, key=str)


def test_reader_goes_through_members_in_turn():
    data = b"".join(warc.page_record(i, f"http://a/{i}\r\nX: y", f"<p>{i}é</p>".encode() * 50, 1 if i == 3 else None, "2024-01-01T00:00:00Z") for i in range(5))
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 5
    small = warc.READ_BYTES
    try:
        warc.READ_BYTES = 7
        records = list(warc.read_records(io.BytesIO(data)))
    finally:
        warc.READ_BYTES = small
    assert [r.kind for r in records] == ["response"] * 3 + ["revisit", "response"]
    assert [r.payload for r in records] == [b"" if i == 3 else f"<p>{i}é</p>".encode() * 50 for i in range(5)]
    assert records[0].headers["warc-target-uri"] == "http://a/0 X: y"


@pytest.mark.parametrize("fault", ["digest", "length", "cut", "version"])
def test_faults_are_found(fault):
    good = gzip.decompress(warc.page_record(1, "u", b"payload" * 20, None, "d"))
    if fault == "digest":
        data = gzip.compress(good.replace(b"payloadpayload", b"payloadPayload", 1))
    elif fault == "length":
        data = gzip.compress(good[:-6] + good[-4:])
    elif fault == "cut":
        data = gzip.compress(good)[:-20]
    else:
        data = gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n")
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data)))


def test_edge_rows(spark, tmp_path):
    long = "<p>" + "é" * 400_000 + "</p>"
    rows = [
        (1, "http://a", long), (2, "http://b", long), (3, None, None), (4, "http://c", ""), (5, "http://d", "x" * 99),
        (6, "http://e", "x" * 99), (7, "http://f", "x" * 100), (8, None, "x" * 100), (8, None, "x" * 100),
        (None, "http://g", "x" * 100), (None, None, "y" * 200), (None, None, "y" * 200), (7, "http://f", "x" * 100),
    ]
    made = warc.with_roles(pages(spark, rows))
    files = warc.write_archives(made, str(tmp_path / "w"), file_bytes=1000)
    assert files.count() > 1
    got = warc.read_archives(files).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], key=str) == expected(rows)
    assert {bytes(r["payload"]).decode() for r in got if r["page_id"] == 1} == {long}
    assert sorted(str(r["url"]) for r in got) == sorted(str(u) for _, u, _ in rows)
    assert warc.archived(spark, pages(spark, [])).collect() == []


def test_query_on_whole_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op3_warc"](spark, data).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == expected(rows)
