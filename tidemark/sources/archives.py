"""CSV members of zip archives, read by byte ranges.

The end of an archive names its central directory, and the directory the place of every member. The
archives' bytes come in pieces from many tasks; each piece is cut at the members' bounds, and the
parts of a member meet, in order, in the task that unpacks it as a stream. So the work is spread by
member, an archive may be larger than any task's memory, and so may a member.
"""

from __future__ import annotations

import csv
import io
import itertools
import struct
import sys
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.attach import attach
from ..session import stored
from .byte_ranges import byte_splits, lines, pieces

RECORDS = "archive string, member string, record bigint, fields array<string>"
BATCH_ROWS, BATCH_CHARS = 5_000, 4_000_000
# Members and pieces meet by blocks of this size.
BLOCK_BYTES = 1 << 20
# What Spark's text writer calls its files.
WRITTEN = "part-*"
# Members that are sent to every task; beyond, both sides are shuffled by block.
BROADCAST_MEMBERS = 50_000
# The signatures and sizes of the format's structures.
END_MARK, END_SIZE, LOCATOR_MARK, LOCATOR_SIZE, END64_MARK = b"PK\x05\x06", 22, b"PK\x06\x07", 20, b"PK\x06\x06"
ENTRY_MARK, ENTRY_SIZE, LOCAL_MARK, LOCAL_SIZE = b"PK\x01\x02", 46, b"PK\x03\x04", 30
# The end structure, the longest comment, and the long forms before it.
TAIL_BYTES = END_SIZE + 65_535 + LOCATOR_SIZE + 4_096


def _directory_place(tail: bytes, offset: int, name: str) -> tuple[int, int]:
    """(offset, size) of the central directory, from an archive's last bytes, which start at `offset`."""
    at = len(tail)
    while (at := tail.rfind(END_MARK, 0, at)) >= 0:
        if at + END_SIZE <= len(tail) and at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] <= len(tail):
            break
    if at < 0:
        raise ValueError(f"no zip archive: {name}")
    size, place = struct.unpack_from("<II", tail, at + 12)
    before = at - LOCATOR_SIZE
    if before >= 0 and tail[before:before + 4] == LOCATOR_MARK:
        long_end = struct.unpack_from("<Q", tail, before + 8)[0] - offset
        if long_end < 0 or tail[long_end:long_end + 4] != END64_MARK:
            raise ValueError(f"no zip archive: {name}")
        size, place = struct.unpack_from("<QQ", tail, long_end + 40)
    return place, size


def _directories(tails: DataFrame) -> DataFrame:
    """(file, place, bytes) of each archive's central directory."""

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("offset")
        name = rows["file"].iloc[0]
        place, size = _directory_place(b"".join(rows["data"]), int(rows["offset"].iloc[0]), name)
        return pd.DataFrame({"file": [name], "place": [place], "bytes": [size]})

    return tails.select("file", "offset", "data").groupBy("file").applyInPandas(find, "file string, place bigint, bytes bigint")


class _Bytes(io.RawIOBase):
    """The joined chunks of an iterator as a stream."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.rest = chunks, b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.rest:
            found = next(self.chunks, None)
            if found is None:
                return 0
            self.rest = found
        count = min(len(target), len(self.rest))
        target[:count], self.rest = self.rest[:count], self.rest[count:]
        return count


def _by_key(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Sorted rows, one group after another, each as a stream."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return itertools.groupby(rows, key=lambda row: tuple(row[k] for k in keys))


def _long_form(extra: bytes, fields: list[int]) -> list[int]:
    """Replace the values that are too large for the short fields, in order, from the extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            long = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(long) if value == 0xFFFFFFFF else value for value in fields]
        at += 4 + size
    return fields


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that central directories list."""
    schema = pa.schema([
        ("file", pa.string()), ("member", pa.string()), ("method", pa.int32()), ("crc", pa.int64()), ("packed", pa.int64()), ("offset", pa.int64()),
    ])
    for (file,), rows in _by_key(batches, "file"):
        source, out = io.BufferedReader(_Bytes(row["data"] for row in rows)), []
        while (head := source.read(ENTRY_SIZE)):
            if len(head) < ENTRY_SIZE or head[:4] != ENTRY_MARK:
                raise ValueError(f"damaged directory in {file}")
            flags, method = struct.unpack_from("<HH", head, 8)
            crc, packed, size = struct.unpack_from("<III", head, 16)
            lengths = struct.unpack_from("<HHH", head, 28)
            name, extra, _ = (source.read(n) for n in lengths)
            size, packed, offset = _long_form(extra, [size, packed, struct.unpack_from("<I", head, 42)[0]])
            if flags & 1 or method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                raise ValueError(f"encrypted or packed in an unknown way: {file}")
            out.append({
                "file": file, "member": name.decode("utf-8" if flags & 0x800 else "cp437"), "method": method, "crc": crc,
                "packed": packed, "offset": offset,
            })
            if len(out) == BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)


def _overlap(have: DataFrame, wanted: DataFrame, broadcast: bool) -> DataFrame:
    """Cut pieces (file, offset, data) at the bounds of ranges (file, from, to): adds `at` and `part`."""
    block = lambda first, last: F.explode(F.sequence(F.floor(first / BLOCK_BYTES), F.floor((last - 1) / BLOCK_BYTES)))
    end = F.col("offset") + F.octet_length("data")
    left = have.where(F.octet_length("data") > 0).withColumn("end", end).withColumn("block", block(F.col("offset"), F.col("end")))
    right = wanted.where("to > from").withColumn("block", block(F.col("from"), F.col("to")))
    joined = left.join(F.broadcast(right) if broadcast else right, ["file", "block"])
    first = F.greatest("offset", "from", F.col("block") * BLOCK_BYTES)
    last = F.least("end", "to", (F.col("block") + 1) * BLOCK_BYTES)
    cut = joined.withColumn("at", first).where(last > F.col("at"))
    part = F.substring("data", (F.col("at") - F.col("offset") + 1).cast("int"), (last - F.col("at")).cast("int"))
    return cut.select(*wanted.columns, "at", part.alias("part"))


def _scan(spark: SparkSession, path: str, glob: str) -> tuple[DataFrame, DataFrame]:
    rows = lines(spark, path, glob)
    return rows, byte_splits(rows)


def _catalog(rows: DataFrame, splits: DataFrame) -> DataFrame:
    last = F.max("until").over(Window.partitionBy("file"))
    ends = splits.withColumn("last", last).where(F.col("until") > F.col("last") - TAIL_BYTES)
    tails = pieces(rows, ends).where(F.col("offset") + F.octet_length("data") > F.col("size") - TAIL_BYTES)
    found = stored(_directories(tails))
    near = attach(splits, found, ["file"]).where("before < place + bytes AND until > place")
    wanted = found.select("file", F.col("place").alias("from"), (F.col("place") + F.col("bytes")).alias("to"))
    parts = _overlap(pieces(rows, near), wanted, found.limit(BROADCAST_MEMBERS + 1).count() <= BROADCAST_MEMBERS)
    listed = parts.select("file", "at", F.col("part").alias("data")).repartition("file").sortWithinPartitions("file", "at").mapInArrow(
        _entries, "file string, member string, method int, crc bigint, packed bigint, offset bigint"
    )
    # A member's bytes reach to the next one's, the last one's to the directory.
    after = F.lead("offset").over(Window.partitionBy("file").orderBy("offset"))
    placed = attach(listed.withColumn("after", after), found, ["file"])
    return stored(placed.select(
        "file", "member", "method", "crc", "packed", F.col("offset").alias("from"), F.coalesce("after", "place").alias("to"),
    ))


def zip_catalog(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(archive, member, packed): the members of every zip file below `path`, folders left out."""
    listed = _catalog(*_scan(spark, path, glob)).where("NOT endswith(member, '/')")
    return listed.select(F.col("file").alias("archive"), "member", "packed")


def _unpacked(rows: Iterator[dict]) -> Iterator[bytes]:
    """The content of a member, from its parts in order."""
    head, left, crc, row = b"", None, 0, None
    for row in rows:
        data = row["part"]
        if left is None:
            head += data
            if len(head) < LOCAL_SIZE:
                continue
            start = LOCAL_SIZE + sum(struct.unpack_from("<HH", head, 26))
            if len(head) < start:
                continue
            if head[:4] != LOCAL_MARK:
                raise ValueError(f"damaged member {row['member']} in {row['file']}")
            data, left = head[start:], row["packed"]
            unpack = zlib.decompressobj(-15) if row["method"] == zipfile.ZIP_DEFLATED else None
        data, left = data[:left], left - min(left, len(data))
        found = unpack.decompress(data) if unpack else data
        crc = zlib.crc32(found, crc)
        yield found
    rest = unpack.flush() if left is not None and unpack else b""
    yield rest
    if left != 0 or zlib.crc32(rest, crc) != row["crc"]:
        raise ValueError(f"damaged member {row['member']} in {row['file']}")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Stream the records of all members, a bounded batch at a time."""
    # A field may be as long as memory allows.
    csv.field_size_limit(sys.maxsize)
    names = ["archive", "member", "record", "fields"]
    for (file, member, _), parts in _by_key(batches, "file", "member", "from"):
        rows, chars = [], 0
        text = io.TextIOWrapper(io.BufferedReader(_Bytes(_unpacked(parts))), encoding="utf-8", newline="")
        for number, fields in enumerate(csv.reader(text)):
            rows.append((file, member, number, fields))
            chars += sum(map(len, fields))
            if len(rows) == BATCH_ROWS or chars > BATCH_CHARS:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
                rows, chars = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])


def unzip_records(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(archive, member, record, fields): every CSV record of every member below `path`, members in parallel."""
    rows, splits = _scan(spark, path, glob)
    members = _catalog(rows, splits).where("NOT endswith(member, '/')")
    parts = _overlap(pieces(rows, splits), members, members.limit(BROADCAST_MEMBERS + 1).count() <= BROADCAST_MEMBERS)
    # Unpacking costs far more than its bytes tell, so the tasks are not merged by size.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = parts.repartition(tasks, "file", "member", "from").sortWithinPartitions("file", "member", "from", "at")
    return together.mapInArrow(_records, RECORDS)


def read_zip_csv(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.zip") -> DataFrame:
    """Typed rows of the archived CSV files, whose first record is a header. An empty field is NULL."""
    records = unzip_records(spark, path, glob).where(F.col("record") > 0)
    return records.select("archive", "member", *[
        F.nullif(F.get("fields", F.lit(i)), F.lit("")).cast(f.dataType).alias(f.name)
        for i, f in enumerate(schema.fields)
    ])


class _Sink:
    """Takes a stream's bytes and gives them out in rows that end before a line feed."""

    def __init__(self):
        self.held, self.size = [], 0

    def write(self, data) -> int:
        self.held.append(bytes(data))
        self.size += len(data)
        return len(data)

    def flush(self) -> None:
        pass

    def rows(self) -> Iterator[bytes]:
        data = b"".join(self.held)
        cut = data.rfind(b"\n")
        if cut >= 0:
            yield data[:cut]
        self.held = [data[cut + 1:]]
        self.size = len(self.held[0])


def write_zip_csv(rows: DataFrame, path: str, batch_rows: int = BATCH_ROWS) -> None:
    """Write the rows as zip archives of CSV files: an archive per task, a member for each batch of rows.

    Archives are written as they grow, through Spark's own writer, which names them `part-*`.
    """
    names = rows.columns

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sink, archive, number = _Sink(), None, 0
        for batch in batches:
            for at in range(0, len(batch), batch_rows):
                archive = archive or zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                archive.writestr(f"rows-{number}.csv", batch.iloc[at:at + batch_rows].to_csv(index=False, header=names, lineterminator="\n"))
                number += 1
                if sink.size >= BLOCK_BYTES:
                    yield pd.DataFrame({"value": list(sink.rows())})
        if archive:
            # The writer ends each row with a line feed; the last one is the archive's comment.
            archive.comment = b"\n"
            archive.close()
            yield pd.DataFrame({"value": list(sink.rows())})

    packed = rows.mapInPandas(pack, "value binary").select(F.col("value").cast("string").alias("value"))
    packed.write.option("lineSep", "\n").option("compression", "none").text(path)
