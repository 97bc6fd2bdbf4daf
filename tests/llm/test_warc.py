import base64
import gzip
import hashlib

import pytest

from yieldcast.llm import warc as W
from yieldcast.llm.common import scratch_path


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    out = []
    for i, _, h in rows:
        same = [j for j, _, x in rows if (x or "") == (h or "")]
        size = len((h or "").encode())
        copy = size >= least and i != max(same)
        out.append((i, size, digest(h), "revisit" if copy else "response", max(same) if copy else None))
    return sorted(out)


ROWS = [(1, "http://a.example/", "<p>one</p>"), (2, None, None), (3, "https://b.example/x y\r\nz", ""), (4, "", "<p>one</p>"),
        (5, "http://a.example/", "line\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n é漢"), (6, "http://c.example", "<p>one</p>"),
        (7, "x", "y" * 300_000)]


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows], "page_id long, url string, html string, type string")


@pytest.mark.parametrize("least", [0, 8])
def test_round_trip(spark, least):
    got = sorted(tuple(r) for r in W.round_trip(table(spark, ROWS).repartition(3), least_bytes=least).collect())
    assert got == brute(ROWS, least)


def test_repeated_rows_and_empty_table(spark):
    got = W.round_trip(table(spark, [(9, "u", "<p>x</p>")] * 30)).collect()
    assert len(got) == 30 and sum(r.record_type == "response" for r in got) == 1
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {9}
    assert W.round_trip(table(spark, [])).collect() == []


def test_records_and_payloads_come_back(spark):
    path = W.write_archives(W.capture_records(table(spark, ROWS)), scratch_path(spark, "warc"), records_per_file=4)
    captures = W.assemble(W.read_records(spark, path)).collect()
    assert len(captures) == len(ROWS)
    by_id = {}
    for c in captures:
        fields = dict(p.split(":", 1) for p in c.metadata.fields.strip("{}").replace('"', "").split(",") if p.startswith("page-id"))
        by_id[int(fields["page-id"])] = c
        assert c.request.target_uri == c.response.target_uri
    for i, _, h in ROWS:
        r = by_id[i].response
        assert r.payload_bytes == len((h or "").encode())
        if r.type == "response":
            assert bytes(r.payload) == (h or "").encode() and by_id[i].original is None
        else:
            assert r.payload is None and by_id[i].original is not None


def test_missing_partners_stay_null(spark):
    rows = [("<a>", "response", None, None), ("<b>", "response", None, None), ("<r>", "request", "<a>", None), ("<m>", "metadata", "<gone>", None)]
    df = spark.createDataFrame([(i, t, c, f, "u", None, None, 1, {}, None) for i, t, c, f in rows], W.RECORD)
    got = {c.response.record_id: c for c in W.assemble(df).collect()}
    assert got["<a>"].request is not None and got["<a>"].metadata is None
    assert got["<b>"].request is None and len(got) == 2


def test_parser_reads_members_and_refuses_damage():
    one = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <x>\r\nContent-Length: 4\r\n\r\nab\r\n\r\n\r\n"
    data = gzip.decompress(gzip.compress(one) + gzip.compress(one))
    assert [b for _, b in W.parse_records(data)] == [b"ab\r\n"] * 2
    with pytest.raises(ValueError):
        list(W.parse_records(one[:-7]))
    with pytest.raises(ValueError):
        list(W.parse_records(b"junk\r\n\r\n"))
