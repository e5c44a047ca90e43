import gzip
import hashlib
from collections import defaultdict

import pytest

from leadpanel.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload_digest string, winner int"
BIG, OTHER = "é" * 600, "b" * 1500


def brute(rows, least=1000):
    best = defaultdict(list)
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            best[html or ""].append(page_id)
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        winner = max(best[html or ""], default=None)
        revisit = len(data) >= least and winner is not None and winner != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", winner if revisit else None))
    return sorted(out, key=repr)


def run(spark, rows, path):
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path)
    back = warc.resolve_revisits(warc.read_archives(spark, path))
    return sorted(map(tuple, back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = [
    (1, "http://a/", BIG, "x", 1), (2, None, BIG, None, None), (3, "http://a b\r\nX: y", BIG, None, None), (4, "u", "small", None, None),
    (5, "u", "small", None, None), (6, "u", None, None, None), (7, "u", "", None, None), (8, "u", OTHER, None, None),
    (8, "u", OTHER, None, None), (9, "u", "x" * 999, None, None), (10, "u", "x" * 999, None, None), (None, "u", BIG, None, None),
    (None, "u", "only null " * 200, None, None), (11, "u", "WARC/1.1\r\n\r\n" * 200, None, None), (12, "u", "long " * 100_000, None, None),
    (-3, "u", "x" * 1000, None, None), (-2, "u", "x" * 1000, None, None),
]


def test_round_trip(spark, tmp_path):
    assert run(spark, ROWS, str(tmp_path / "out")) == brute(ROWS)


def test_empty_table(spark, tmp_path):
    assert run(spark, [], str(tmp_path / "out")) == []


def test_archives_are_warc_files(spark, tmp_path):
    path = tmp_path / "out"
    warc.write_archives(spark.createDataFrame(ROWS, SCHEMA), str(path))
    text = b"".join(gzip.decompress(p.read_bytes()) for p in path.glob("part-*"))
    rest, records = text, 0
    while rest:
        head, _, rest = rest.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and fields[b"WARC-Type"] in (b"response", b"revisit")
        size = int(fields[b"Content-Length"])
        assert rest[size:size + 4] == b"\r\n\r\n"
        rest, records = rest[size + 4:], records + 1
    assert records == len(ROWS)


def test_payloads_are_stored_once(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write_archives(spark.createDataFrame(ROWS, SCHEMA), path)
    rows = warc.read_archives(spark, path, with_payload=True).collect()
    assert sum(bytes(r["payload"]) == BIG.encode() for r in rows) == 1
    assert all(not r["payload"] for r in rows if r["record_type"] == "revisit")


def test_broken_archives_are_refused():
    whole = warc._record(1, "u", "text", 4, hashlib.sha1(b"text").hexdigest(), None) + warc._END
    assert len(list(warc.parse_archive(memoryview(whole)))) == 1
    with pytest.raises(ValueError):
        list(warc.parse_archive(memoryview(whole[:-30])))
    wrong = warc._record(1, "u", "text", 4, hashlib.sha1(b"other").hexdigest(), None)
    with pytest.raises(ValueError):
        list(warc.parse_archive(memoryview(wrong)))
