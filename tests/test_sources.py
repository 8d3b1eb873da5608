"""Files read in many tasks give the same rows as in one."""

import csv
import random
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import archives, byte_ranges, tables

NOTES = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("size", T.DoubleType())])


@pytest.fixture
def small_splits(spark):
    """Splits of 200 bytes."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def notes(count, seed):
    rng = random.Random(seed)
    words = ["plain", 'a "quoted" word', "two\nlines", "comma, here", "\n\n", '"', "x" * 700, "ü日本", '","', "tail\r\nof windows"]
    return [(i, " ".join(rng.choices(words, k=rng.randint(1, 4))), rng.random()) for i in range(count)]


def write(path, rows, terminator="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=terminator, quoting=quoting)
        out.writerow(["id", "note", "size"])
        out.writerows(rows)


@pytest.mark.parametrize("terminator", ["\n", "\r\n"])
def test_quoted_lines_across_splits(small_splits, tmp_path, terminator):
    want = []
    for n in range(3):
        rows = notes(60, n)
        want += rows
        write(tmp_path / f"{n}.csv", rows, terminator, csv.QUOTE_ALL if n == 2 else csv.QUOTE_MINIMAL)
    scan = byte_ranges.lines(small_splits, str(tmp_path))
    assert scan.select("file", "start").distinct().count() > 30 and scan.rdd.getNumPartitions() > 30
    got = tables.read_csv(small_splits, str(tmp_path), NOTES).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_one_record_over_many_splits(small_splits, tmp_path):
    rows = [(1, "first", 0.5), (2, "\n".join("line %d" % i for i in range(2000)), 1.0), (3, None, 2.0)]
    write(tmp_path / "long.csv", rows)
    got = tables.read_csv(small_splits, str(tmp_path), NOTES).collect()
    assert sorted(tuple(r) for r in got) == rows


def test_same_rows_as_the_one_task_reader(small_splits, tmp_path):
    rows = notes(80, 9)
    write(tmp_path / "a.csv", [(i, note.replace("\r\n", "\n"), size) for i, note, size in rows])
    one = small_splits.read.schema(NOTES).option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    many = tables.read_csv(small_splits, str(tmp_path), NOTES)
    assert many.exceptAll(one).isEmpty() and one.exceptAll(many).isEmpty() and one.count() == 80


def test_header_blank_lines_and_no_last_line_feed(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,size\n1,a,1.5\n\n2,"b\n\nc",2.5\n\n3,,')
    (tmp_path / "b.csv").write_text("id,note,size")
    (tmp_path / "c.csv").write_text("")
    got = tables.read_csv(small_splits, str(tmp_path), NOTES).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a", 1.5), (2, "b\n\nc", 2.5), (3, None, None)]


def test_bad_rows_and_open_quotes_stop_the_job(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text("id,note,size\n1,a,many\n")
    with pytest.raises(Exception):
        tables.read_csv(small_splits, str(tmp_path), NOTES).collect()
    (tmp_path / "a.csv").write_text('id,note,size\n1,"a,1\n')
    with pytest.raises(Exception, match="does not end"):
        tables.read_csv(small_splits, str(tmp_path), NOTES).collect()


def test_splits_without_line_feeds_in_quotes_are_read_as_lines(small_splits, tmp_path):
    want = [(i, 'a "quoted", word' if i % 3 else None, i / 4) for i in range(200)]
    write(tmp_path / "plain.csv", want)
    plan = tables.read_csv(small_splits, str(tmp_path), NOTES)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan
    # One split holds line feeds in quotes; all others are read as before.
    want += [(1000 + i, "two\nlines" if i == 50 else "one", 0.5) for i in range(100)]
    write(tmp_path / "mixed.csv", want[200:], "\r\n")
    mixed = tables.read_csv(small_splits, str(tmp_path), NOTES)
    assert "MapInArrow" in mixed._jdf.queryExecution().toString()
    assert sorted(map(str, mixed.collect())) == sorted(map(str, (Row(id=i, note=n, size=z) for i, n, z in want)))


def test_rows_like_the_header_are_rows(small_splits, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b")])
    (tmp_path / "again.csv").write_text("a,b\na,b\n" + "x,y\n" * 100 + "a,b\n")
    (tmp_path / "other.csv").write_text("c,d\na,b\n")
    (tmp_path / "blank.csv").write_text("\na,b\n1,2\n")
    got = sorted(tuple(r) for r in tables.read_csv(small_splits, str(tmp_path), schema).collect())
    assert got == sorted([("a", "b")] * 4 + [("x", "y")] * 100 + [("1", "2")])


TIMES = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType()), T.StructField("to", T.TimestampNTZType())])


def test_timestamps_by_their_format_only(spark, tmp_path):
    good = ["1,2024-02-29 23:59:59,2024-01-01 00:00:00.000001", "2,,0001-01-01 00:00:00", '3,"9999-12-31 23:59:59.999999",""', "4,,2024-01-01 00:00:00.1"]
    (tmp_path / "good.csv").write_text("id,at,to\n" + "\n".join(good))
    rows = sorted(tuple(r) for r in tables.read_csv(spark, str(tmp_path), TIMES).collect())
    assert rows == [(1, datetime(2024, 2, 29, 23, 59, 59), datetime(2024, 1, 1, 0, 0, 0, 1)), (2, None, datetime(1, 1, 1)),
                    (3, datetime(9999, 12, 31, 23, 59, 59, 999999), None), (4, None, datetime(2024, 1, 1, 0, 0, 0, 100000))]
    for k, bad in enumerate(["2024-02-30 00:00:00", "2024-01-01", "2024-01-01T00:00:00", "2024-01-01 24:00:00", " 2024-01-01 00:00:00", "noon"]):
        (tmp_path / f"bad{k}").mkdir()
        (tmp_path / f"bad{k}" / "bad.csv").write_text(f"id,at,to\n1,,{bad}\n")
        with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
            tables.read_csv(spark, str(tmp_path / f"bad{k}"), TIMES).collect()


def test_pieces_are_the_file(small_splits, tmp_path):
    rng = random.Random(1)
    files = {"a.bin": rng.randbytes(5000), "b.bin": b"\n\n\n", "c.bin": b"x", "d.bin": b"ends with a line feed\n", "e.bin": bytes(range(256)) * 9}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    for piece in (1, 300, 1 << 20):
        found = {name: bytearray(len(data)) for name, data in files.items()}
        total = 0
        rows = byte_ranges.lines(small_splits, str(tmp_path), "*.bin")
        for r in byte_ranges.pieces(rows, byte_ranges.byte_splits(rows), piece).collect():
            name = r["file"].rsplit("/", 1)[1]
            found[name][r["offset"]:r["offset"] + len(r["data"])] = r["data"]
            total += len(r["data"])
        assert found == files and total == sum(map(len, files.values()))


def packed(path, members, compression=zipfile.ZIP_DEFLATED, comment=b""):
    with zipfile.ZipFile(path, "w", compression) as archive:
        archive.comment = comment
        archive.writestr("folder/", "")
        for name, text in members.items():
            archive.writestr(name, text)


def test_members_of_archives_are_read_by_many_tasks(small_splits, tmp_path, monkeypatch):
    rng = random.Random(2)
    want = []
    for a, kind in enumerate(("deflated", "stored", "zip64", "empty")):
        if kind == "zip64":
            # The library then writes the long forms of sizes, offsets and counts.
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 20)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
        members = {}
        for m in range(0 if kind == "empty" else 25):
            rows = [(1000 * a + 20 * m + k, rng.randbytes(rng.randrange(60)).hex() + '\n"\n,', k / 4) for k in range(rng.randrange(20))]
            want += rows
            lines = ["id,note,size"] + ["%d,\"%s\",%s" % (i, note.replace('"', '""'), size) for i, note, size in rows]
            members[f"übung-{m}.csv"] = "\n".join(lines) + "\n" * (m % 2)
        packed(tmp_path / f"{kind}.zip", members, zipfile.ZIP_STORED if kind == "stored" else zipfile.ZIP_DEFLATED, b"note" * a)
    got = archives.read_zip_csv(small_splits, str(tmp_path), NOTES).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r["id"], r["note"], r["size"]) for r in got) == sorted(want)
    assert len({r["task"] for r in got}) > 2 and {r["member"] for r in got} <= {f"übung-{m}.csv" for m in range(25)}


def test_fields_of_any_length(spark, tmp_path):
    packed(tmp_path / "a.zip", {"a.csv": "id,note,size\n1," + "y" * 200_000 + ",2\n2," + "z" * 3_000_000 + ",\n"})
    got = archives.read_zip_csv(spark, str(tmp_path), NOTES).collect()
    assert sorted((r["id"], len(r["note"]), r["size"]) for r in got) == [(1, 200_000, 2.0), (2, 3_000_000, None)]


def test_written_archives_are_valid_and_come_back(spark, tmp_path):
    rows = [(i, note, size) for i, note, size in notes(300, 5)] + [(900, None, None)]
    frame = spark.createDataFrame(rows, NOTES).repartition(3)
    archives.write_zip_csv(frame, str(tmp_path / "z"), batch_rows=20)
    files = [f for f in (tmp_path / "z").iterdir() if f.name.startswith("part-")]
    for file in files:
        with zipfile.ZipFile(file) as archive:
            assert archive.testzip() is None and len(archive.namelist()) > 1
    got = archives.read_zip_csv(spark, str(tmp_path / "z"), NOTES, archives.WRITTEN).drop("archive", "member").collect()
    assert len(files) == 3 and sorted(tuple(r) for r in got) == sorted(rows, key=lambda r: r[0])


def test_damaged_archives_stop_the_job(spark, tmp_path):
    packed(tmp_path / "a.zip", {"a.csv": "id,note,size\n" + "1,abc,2\n" * 50})
    data = bytearray((tmp_path / "a.zip").read_bytes())
    (tmp_path / "a.zip").write_bytes(data[:-30])
    with pytest.raises(Exception, match="no zip archive"):
        archives.read_zip_csv(spark, str(tmp_path), NOTES).collect()
    packed(tmp_path / "a.zip", {"a.csv": "id,note,size\n" + "1,abc,2\n" * 50}, zipfile.ZIP_STORED)
    data = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "a.zip").write_bytes(data.replace(b"1,abc,2", b"1,abd,2", 1))
    with pytest.raises(Exception, match="damaged"):
        archives.read_zip_csv(spark, str(tmp_path), NOTES).collect()
