"""Large files in many tasks: what each split of a file holds, tied together by small prefix sums.

A text scan with a fixed line feed cuts any file, text or binary, into splits and rows without
changing a byte, through Spark's own readers. A row doesn't know its place, but what comes before a
split is the sum over the splits before it: of bytes, which gives offsets, or of quotes, whose parity
tells whether the split starts inside a quoted value. One row per split carries this, so it is small
whatever the file's size, and the rows themselves are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored

# Bytes that neighbouring rows are joined to.
PIECE_BYTES = 1 << 20
# A record, or the part of one that an earlier split begins (its end or what lies between), or that
# this split begins and another ends.
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3


def lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, size, start, value): the bytes between line feeds, with the split that they begin in."""
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"), "value",
    )


def split_sums(rows: DataFrame, amount: Column) -> DataFrame:
    """(file, start, before, until): the sum of `amount` over all earlier splits of the file, and with this one."""
    sums = rows.groupBy("file", "start").agg(F.sum(amount).alias("amount"))
    so_far = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.sum("amount").over(so_far)
    return stored(sums.select("file", "start", (until - F.col("amount")).alias("before"), until.alias("until")))


def _with_splits(rows: DataFrame, splits: DataFrame, how: str) -> DataFrame:
    """Add the columns of the splits. A broadcast join keeps the rows where they are and in order; it
    holds one row for each split, of the scan's `maxPartitionBytes`, whatever the rows."""
    return rows.join(F.broadcast(splits), ["file", "start"], how)


def byte_splits(rows: DataFrame) -> DataFrame:
    """(file, start, before, until): the offsets at which the splits' rows begin and end."""
    return split_sums(rows, F.octet_length("value") + 1)


def pieces(rows: DataFrame, splits: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(file, size, offset, data): the bytes of the given splits in pieces of about `piece_bytes`."""
    placed = _with_splits(rows, splits.select("file", "start", "before"), "inner")
    schema = pa.schema([("file", pa.string()), ("size", pa.int64()), ("offset", pa.int64()), ("data", pa.binary())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, offset, held, count = None, 0, [], 0

        def flush():
            nonlocal offset, held, count
            # The last row of a file has no line feed if the file doesn't end with one.
            data = b"".join(held)[:split[2] - offset]
            out = pa.RecordBatch.from_pylist([{"file": split[0], "size": split[2], "offset": offset, "data": data}], schema)
            offset, held, count = offset + len(data), [], 0
            return out

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("file", "start", "size", "before", "value")]
            for file, start, size, before, value in zip(*columns):
                if split is None or split[:2] != (file, start):
                    if held:
                        yield flush()
                    split, offset = (file, start, size), before
                held += (value, b"\n")
                count += len(value) + 1
                if count >= piece_bytes:
                    yield flush()
        if held:
            yield flush()

    columns = placed.select("file", "start", "size", "before", F.col("value").cast("binary").alias("value"))
    return columns.mapInArrow(join, "file string, size bigint, offset bigint, data binary")


def _cut(fragments: bool):
    """The whole records of each split, or the parts of those that begin or end elsewhere.

    `n` numbers the records that begin in a split.
    """
    schema = pa.schema([
        ("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()), ("value", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, odd, number, inherited, out = None, [], 0, 0, False, []

        def add(kind: int, parts: list[str]):
            if (kind == WHOLE) != fragments:
                out.append((*split, kind, number, parts[0] if len(parts) == 1 else "\n".join(parts)))

        def emit():
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            starts, files = batch.column("start").to_numpy(), batch.column("file").dictionary_encode()
            turns = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files.indices.to_numpy()) != 0)) + 1
            for at, end in zip([0, *turns.tolist()], [*turns.tolist(), len(starts)]):
                here = files[at].as_py(), int(starts[at])
                if here != split:
                    if held:
                        add(MIDDLE if inherited else TAIL, held)
                    inherited = batch.column("inside")[at].as_py()
                    split, held, odd, number = here, [], int(inherited), 0
                values = batch.column("value").slice(at, end - at)
                after = (odd + np.cumsum(pc.count_substring(values, '"').to_numpy(zero_copy_only=False))) % 2
                odd, values, begin = int(after[-1]), values.to_pylist(), 0
                for last in np.flatnonzero(after == 0).tolist():
                    add(HEAD if inherited else WHOLE, held + values[begin:last + 1])
                    begin, held, number, inherited = last + 1, [], number + (not inherited), False
                held += values[begin:]
            if out:
                yield emit()
        if held:
            add(MIDDLE if inherited else TAIL, held)
        if out:
            yield emit()

    return run


def _quote_splits(rows: DataFrame, header: str | None) -> DataFrame:
    """(file, start, inside, plain) of every split: whether it starts inside a quoted value, and
    whether its lines are its records: no value in it holds a line feed, and the line `header` is
    the first one of a file and no other in that split."""
    quotes = F.when(F.contains("value", F.lit('"')), F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).otherwise(0)
    counted = rows.select("file", "start", quotes.alias("quotes"), _is_header(header).alias("header"),
                          F.monotonically_increasing_id().alias("at"))
    sums = stored(counted.groupBy("file", "start").agg(
        F.sum("quotes").alias("amount"), F.max(F.col("quotes") % 2).alias("odd"),
        F.min_by("header", "at").alias("begins"), F.count_if("header").alias("headers")))
    so_far = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (F.sum("amount").over(so_far) - F.col("amount")) % 2 == 1
    headed = (F.col("start") > 0) | (F.col("begins") & (F.col("headers") == 1))
    return stored(sums.select("file", "start", "odd", inside.alias("inside"), headed.alias("headed")).select(
        "file", "start", "inside", (~F.col("inside") & (F.col("odd") == 0) & F.col("headed")).alias("plain")))


def _is_header(header: str | None) -> Column:
    return F.lit(False) if header is None else F.col("value").isin(header, header + "\r")


def quoted_records(spark: SparkSession, path: str, glob: str | None = None, header: str | None = None) -> DataFrame:
    """(file, first, value): the records of quoted text files, which may hold line feeds in quotes.

    A line feed ends a record if an even number of quotes lies before it. Each split counts its
    quotes; the parity of all earlier ones tells how it starts. A split without line feeds in quotes is
    taken line by line as it is read; where a file begins, if its first line is the given `header`.
    In the others whole records stay in their task, and the parts of a record that crosses splits, at
    most two for each split, are joined. `first` marks each file's first record. No row of the scans
    is shuffled; there are two of them if no value holds a line feed.
    """
    rows = lines(spark, path, glob).drop("size")
    splits = _quote_splits(rows, header)
    kinds = {r["plain"] for r in splits.select("plain").distinct().collect()}
    if True not in kinds:
        return _without_return(_cut_records(rows, splits))
    plain = _with_splits(rows, splits.where("plain").select("file", "start"), "inner") if False in kinds else rows
    direct = plain.select("file", ((F.col("start") == 0) & _is_header(header)).alias("first"), "value")
    if False in kinds:
        direct = direct.unionByName(_cut_records(rows, splits.where(~F.col("plain"))))
    return _without_return(direct)


def _without_return(records: DataFrame) -> DataFrame:
    value = F.when(F.endswith("value", F.lit("\r")), F.col("value").substr(F.lit(1), F.length("value") - 1)).otherwise(F.col("value"))
    return records.select("file", "first", value.alias("value"))


def _cut_records(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, first, value) of the records that begin in the given splits, or end in them."""
    placed = _with_splits(rows, splits.select("file", "start", "inside"), "inner")
    columns = "file string, start bigint, kind int, n bigint, value string"
    whole = placed.mapInArrow(_cut(False), columns)
    parts = stored(placed.mapInArrow(_cut(True), columns))
    earlier = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.when(F.col("kind") == TAIL, F.col("start"))
    owned = parts.select("file", "start", "kind", F.last(begun, ignorenulls=True).over(earlier).alias("owner"))
    part = F.struct("start", "kind", "value")
    joined = parts.join(owned, ["file", "start", "kind"]).groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(part)).alias("parts"), F.max(F.when(F.col("kind") == TAIL, F.col("n"))).alias("n"),
        F.max(F.col("kind") == HEAD).alias("ends"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    unended = F.raise_error(F.concat(F.lit("a quoted value does not end in "), F.col("file"))).cast("string")
    crossing = joined.select("file", F.col("owner").alias("start"), "n", F.when(F.col("ends"), text).otherwise(unended).alias("value"))
    records = whole.select("file", "start", "n", "value").unionByName(crossing)
    return records.select("file", ((F.col("start") == 0) & (F.col("n") == 0)).alias("first"), "value")
