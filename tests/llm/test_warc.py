import gzip
import hashlib

import pytest

from binledger.llm import warc


def test_reader_takes_any_pieces():
    data = b"".join(warc.page_record(i, "http://x/\n y", p, r) for i, p, r in
                    [(1, b"", None), (2, "hé\r\n\r\n".encode() * 50_000, None), (3, b"\r\n\r\n", 2)])
    for size in (1, 7, 65_536, len(data)):
        got = list(warc.records(data[k : k + size] for k in range(0, len(data), size)))
        assert [r.headers["warc-type"] for r in got] == ["response", "response", "revisit"]
        assert got[0].payload == b"" and got[1].payload == "hé\r\n\r\n".encode() * 50_000
        assert got[2].headers["warc-refers-to"] == "<urn:page:2>"
        assert got[2].headers["warc-target-uri"] == "http://x/ y"
    # one gzip member per record: any gzip reader sees the whole archive
    assert gzip.decompress(data).count(b"WARC/1.0\r\n") == 3


def test_damage_is_seen():
    record = warc.page_record(1, "u", b"payload", None)
    with pytest.raises(ValueError):
        list(warc.records([record[:-9]]))
    plain = gzip.decompress(record)
    for bad in (plain.replace(b"payload", b"pAyload"), plain.replace(b"Content-Length: 7\r\n\r\n", b"Content-Length: 8\r\n\r\n")):
        with pytest.raises(ValueError):
            list(warc.records([gzip.compress(bad)]))
    with pytest.raises(ValueError):
        list(warc.records([b"no gzip at all"]))


def test_archive_round_trip(spark, frame):
    pages = frame(
        [(5, "u5", "same"), (3, "u3", "same"), (4, None, None), (9, "u9", ""), (7, "u7", "é" * 70_000), (7, "u7", "other")],
        "page_id long, url string, html string",
    )
    rows = warc.read_warc(warc.archive(spark, pages)).collect()
    got = {(r.record_id, r.payload_bytes): r for r in rows}
    assert len(rows) == 6
    assert got["<urn:page:5>", 4].record_type == "revisit" and got["<urn:page:5>", 4].refers_to == "<urn:page:3>"
    assert got["<urn:page:3>", 4].payload == "same"
    assert got["<urn:page:9>", 0].refers_to == "<urn:page:4>"
    assert got["<urn:page:7>", 140_000].payload == "é" * 70_000
    for r in rows:
        if r.payload is not None:
            assert r.payload_digest == warc.digest(r.payload.encode())
    assert warc.digest(b"") == __import__("base64").b32encode(hashlib.sha1(b"").digest()).decode()


def test_no_pages(spark, frame):
    assert warc.read_warc(warc.archive(spark, frame([], "page_id long, url string, html string"))).count() == 0


def test_rows_without_id_repeated_ids_and_clashing_columns(spark, frame):
    from pyspark.sql import functions as F

    pages = frame(
        [(None, "u", "same"), (3, "u3", "same"), (None, "v", "lone"), (None, "v", "lone"), (None, None, None), (3, "u3", "same")],
        "page_id long, url string, html string",
    )
    for name in ("_digest", "_first", "refers_to", "path", "record_id"):
        pages = pages.withColumn(name, F.lit("x"))
    got = warc.read_warc(warc.archive(spark, pages)).collect()
    assert len(got) == 6 and len({r.record_id for r in got}) == 5  # the two rows of page 3 share theirs
    kinds = sorted((r.target_uri, r.record_type, r.refers_to) for r in got)
    assert kinds == [("", "response", None), ("u", "revisit", "<urn:page:3>"), ("u3", "response", None),
                     ("u3", "response", None), ("v", "response", None), ("v", "response", None)]
