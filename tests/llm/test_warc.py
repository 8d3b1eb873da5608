import base64
import hashlib
import random

import pytest

from tidemark.llm import warc
from tidemark.session import scratch_path

FAKE = warc.MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
PAGES = [
    (0, "http://a/", "x"), (1, None, None), (2, "http://b/ c\r\nWARC-Type: resource", ""), (3, "u", "x"), (4, "u", warc.MAGIC),
    (5, "u", FAKE + FAKE), (6, "u", "y" + FAKE), (7, "u", warc.MAGIC * 5 + "é" * 100), (8, "u", warc.MAGIC + warc.MAGIC[:5]),
    (9, "u", warc.MAGIC), (9, "u", warc.MAGIC), (11, "u", "long " * 50_000), (None, "u", "x"), (None, "u", "alone"), (12, "u", "\r\n\r\n"),
]


def expected(rows, least=0):
    digests = [(i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) for i, _, h in rows]
    last = {}
    for i, _, d in digests:
        last[d] = max((x for x in (last.get(d), i) if x is not None), default=None)
    out = []
    for i, n, d in digests:
        first = n < least or last[d] is None or i == last[d]
        out.append((i, n, d, "response" if first else "revisit", None if first else last[d]))
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r) for r in frame.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("split", ["128m", "1999b"])
def test_round_trip_with_magic_in_payloads(spark, split):
    rng = random.Random(1)
    rows = PAGES + [
        (20 + k, "u", "".join(rng.choice(["a", "\r\n", warc.MAGIC, FAKE, "ü", "z" * 300]) for _ in range(rng.randint(0, 30)))) for k in range(40)
    ]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2).selectExpr("*", "'clash' AS payload", "1 AS digest", "2 AS refers_to")
        assert result(warc.round_trip(pages, scratch_path(spark, "warc"))) == expected(rows)
        assert result(warc.round_trip(pages, scratch_path(spark, "warc"), min_bytes=3)) == expected(rows, 3)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_are_plain_warc(spark):
    import os
    import re

    path = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(PAGES[:10], "page_id long, url string, html string").coalesce(1), path)
    data = b"".join(open(os.path.join(path, f), "rb").read() for f in sorted(os.listdir(path)) if f.startswith("part"))
    at, count = 0, 0
    while at < len(data):
        assert data[at:at + 10] == warc.MAGIC.encode()
        end = data.index(b"\r\n\r\n", at)
        size = int(re.search(rb"\r\nContent-Length: (\d+)", data[at:end])[1])
        at, count = end + 4 + size + 4, count + 1
        assert data[at - 4:at] == b"\r\n\r\n"
    assert (at, count) == (len(data), 10)


def test_broken_chain_and_foreign_start(spark, tmp_path):
    good = FAKE
    (tmp_path / "a.warc").write_bytes((good + good).encode())
    (tmp_path / "b.warc").write_bytes(("junk" + good).encode())
    (tmp_path / "c.warc").write_bytes((good + good.replace("5", "50") + good + good).encode())
    (tmp_path / "d.warc").write_bytes(b"")
    # a has two records, c one before its wrong length and the wrong one, whose payload isn't there.
    assert warc.read_records(spark, str(tmp_path)).where("payload_bytes IS NOT NULL").count() >= 3


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages, scratch_path(spark, "warc")).count() == 0
