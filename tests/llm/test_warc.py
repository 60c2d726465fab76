import hashlib

import pytest

from stayvalue.llm import warc

PAGES = "page_id long, url string, html string"
FALSE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def plain(rows):
    """(page_id, bytes, digest, type, refers_to), sorted."""
    data = [(i, (html or "").encode()) for i, _, html in rows]
    out = []
    for i, payload in data:
        ids = [j for j, other in data if other == payload and j is not None]
        first = min(ids) if ids and len(payload) >= 100 else None
        revisit = first is not None and first != i
        digest = hashlib.sha256(payload).hexdigest()
        out.append((i, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


ODD = [
    (1, "http://a/1", "x" * 150), (2, "http://a/2", "x" * 150), (3, "http://a/3\r\nX: y", "short"),
    (4, None, "short"), (5, "u", None), (6, "u", ""), (7, "u", FALSE * 3), (8, "u", "a\n" + FALSE),
    (9, "u", "\r\n\r\n" * 30), (10, "u", "\r\nWARC/1.1\r\nContent-Length: 999999\r\n\r\nzz"),
    (11, "u", "é" * 3000 + "\n" + FALSE + "ü" * 3000), (None, "u", "x" * 150), (12, "u", "WARC/1.0"),
    (13, "u", "line\r" * 40), (14, "u", FALSE + "tail without end"), (-5, "u", "neg" * 50),
]


def test_round_trip_of_odd_pages(spark):
    pages = spark.createDataFrame(ODD, PAGES).coalesce(1)
    assert result(warc.round_trip(pages)) == plain(ODD)


@pytest.mark.parametrize("size", ["700b", "1k", "5k"])
def test_records_across_splits(spark, conf, tmp_path, size):
    """Splits end anywhere: in headers, payloads and look-alikes."""
    rows = [(i, f"http://a/{i}", (FALSE if i % 5 == 0 else "") + f"{i} " * (i * 7 % 900)) for i in range(60)]
    rows += [(i + 100, u, h) for i, u, h in ODD[:-1] if i is not None]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    conf(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="1b",
         spark__sql__files__minPartitionNum="1")
    path = str(tmp_path / "w")
    warc.write_warc(pages, path)
    assert warc.segments(spark, path, False).select("start").distinct().count() > 5
    assert result(warc.round_trip(pages)) == plain(rows)


def test_payloads_and_fields_come_back(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(spark.createDataFrame(ODD, PAGES).coalesce(2), path)
    records = {r.record_id: r for r in warc.read_warc(spark, path).collect() if r.record_type == "response"}
    for i, url, html in ODD:
        if i in (2, None):
            continue
        record = records[f"<urn:page:{i}>"]
        assert bytes(record.payload) == (html or "").encode()
        assert record.target_uri == (url and url.replace("\r", "%0D").replace("\n", "%0A"))


def test_broken_chain_is_an_error(spark, tmp_path):
    path = tmp_path / "w"
    path.mkdir()
    (path / "a.warc").write_bytes(FALSE.encode() + b"junk\r\n" + FALSE.encode())
    with pytest.raises(ValueError, match="breaks"):
        warc.read_warc(spark, str(path))


def test_foreign_archive(spark, tmp_path):
    path = tmp_path / "w"
    path.mkdir()
    body = b"HTTP/1.1 200 OK\r\n\r\n\x00\xff binary"
    record = b"WARC/1.0\r\nwarc-type: response\r\ncontent-length:%d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    (path / "a.warc").write_bytes(record * 3)
    rows = warc.read_warc(spark, str(path)).collect()
    assert [bytes(r.payload) for r in rows] == [body] * 3
    assert {r.record_type for r in rows} == {"response"}


def test_empty_table_and_repeated_rows(spark):
    pages = spark.createDataFrame(ODD[:2] * 2, PAGES)
    assert [r[3] for r in result(warc.round_trip(pages))].count("response") == 2
    assert warc.round_trip(pages.limit(0)).collect() == []
