import base64
import gzip
import hashlib
import io
import random
from collections import Counter

import pytest

from quillmark.llm import warc


def plain(rows, least):
    last = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        last[raw] = max([x for x in (last.get(raw), page) if x is not None], default=None)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        again = len(raw) >= least and page != last[raw]
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", last[raw] if again else None, True))
    return Counter(out)


ROWS = [(1, "http://a/\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "x" * 5000), (6, "u", "\r\n\r\nWARC/1.1\r\n" * 40), (7, "u", "<p>é</p>"), (7, "u", "<p>é</p>"), (None, "u", "<p>é</p>"), (8, "u", "日" * 2000)]


@pytest.mark.parametrize("chunk,least", [(7, 0), (1 << 20, 0), (64, 10)])
def test_archive_pages(spark, chunk, least):
    df = spark.createDataFrame([(*r, "extra") for r in ROWS], "page_id long, url string, html string, sha1 string")
    got = warc.archive_pages(df.repartition(3), least, chunk).collect()
    assert Counter(map(tuple, got)) == plain(ROWS, least)


def test_chunks_carry_digests_and_bytes(spark, tmp_path):
    r = random.Random(1)
    html = {i: "".join(r.choice("aé日\n") for _ in range(r.randrange(3000))) for i in range(30)}
    df = spark.createDataFrame([(i, "u", h) for i, h in html.items()], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.to_chunks(warc.with_roles(df), 100), str(tmp_path), file_bytes=2000)
    assert manifest.count() > 3 and manifest.groupBy().sum("records").first()[0] == 30
    rows = sorted(warc.read_chunks(manifest, 100).collect(), key=lambda x: (int(x.record_id), x.chunk_no))
    for i, h in html.items():
        own, raw = [x for x in rows if x.record_id == str(i)], h.encode()
        assert b"".join(x.data for x in own) == raw and [x.chunk_no for x in own] == list(range(len(own)))
        assert all(len(x.data) <= 100 and x.digest == base64.b32encode(hashlib.sha1(raw[: x.end_byte]).digest()).decode() for x in own)
        assert [x.last for x in own] == [False] * (len(own) - 1) + [True]


def test_files_are_plain_gzip_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/", "hello")], "page_id long, url string, html string")
    path = warc.write_archives(warc.to_chunks(warc.with_roles(df)), str(tmp_path)).first().path
    text = gzip.open(path).read().decode()
    assert text.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith("\r\n\r\nhello\r\n\r\n")


def test_damage_is_found():
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\n")), 10))


def test_empty(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
