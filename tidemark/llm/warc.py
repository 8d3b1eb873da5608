"""WARC archives written and read by Spark, with the record boundaries verified as a chain.

Writing: one uncompressed WARC 1.1 file per task. Pages with equal payloads get one response record,
that of the largest id; the others become revisit records without payload.

Reading splits files anywhere. The text source with the version line as delimiter gives one row for
each place where a record might start, and its length in bytes; the running sum within a split and
over the splits of a file is the row's place in the file. A candidate's header tells where its
successor must start. Candidates form chains:

1. inside a split, a task follows each candidate to the first place outside the split;
2. between splits, pointer jumping from the start of each file doubles its reach per round, over one
   row for each place where a chain enters a split;
3. each split marks what is reachable from its entries.

A version line inside a payload starts a candidate that nothing reaches, and is dropped. Its record
then spans several rows; these are collected in a second pass over the files that hold such records.

Defined results: a NULL payload counts as empty; among equal payloads a row with NULL id is a
revisit, or a response where no row has an id; rows that repeat the largest id are all responses.
A NULL url is left out of the header, blanks and control characters in it are percent-encoded. Bytes
after a broken chain or in a file that doesn't start with a record are not read. An empty table
gives no records.
Payloads of any length are written whole; of equal payloads the largest id is the response; an empty
table gives no records.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.attach import attach
from tidemark.session import stored

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DATE = "2000-01-01T00:00:00Z"
ID_PREFIX = "urn:page:"


def payload_digest(octets: Column) -> Column:
    """Bare upper-case base32 SHA-1: eight groups of five hexadecimal digits, four letters each."""
    digits = F.sha1(octets)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), CONV32, BASE32)


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, payload) with digest, payload_bytes and `refers_to` for revisits."""
    named = pages.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": payload_digest(F.col("payload").cast("binary"))})
    groups = named.where(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes").agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("rows")
    )
    several = stored(groups.where("rows > 1 AND last IS NOT NULL").select("digest", "payload_bytes", "last"))
    joined = attach(named, several, ["digest", "payload_bytes"])
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))).drop("last")


def _record(kind: str) -> Column:
    """The bytes of a page's record, without the last line feed, which the writer adds."""
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    reference = lambda c: F.concat(F.lit(f"<{ID_PREFIX}"), F.col(c).cast("string"), F.lit(">\r\n"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END),
    )
    block = http if kind == "revisit" else F.concat(http, F.col("payload"))
    optional = lambda column: F.coalesce(column, F.lit(""))
    return F.concat(
        F.lit(f"{MAGIC}WARC-Type: {kind}\r\n"),
        optional(F.concat(F.lit("WARC-Record-ID: "), reference("page_id"))),
        optional(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n"))),
        F.lit(f"WARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
        *([F.lit("WARC-Refers-To: "), reference("refers_to"), F.lit(f"WARC-Profile: {PROFILE}\r\n")] if kind == "revisit" else []),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END), block, F.lit("\r\n\r"),
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write (page_id, url, html) as WARC files below `path`."""
    source = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    planned = plan_records(source, min_bytes)
    lines = planned.select(F.when(F.col("refers_to").isNull(), _record("response")).otherwise(_record("revisit")).alias("value"))
    lines.write.option("lineSep", "\n").text(path)


def _field(head: Column, name: str) -> Column:
    """A header field's value, NULL if it is missing."""
    found = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*?)[ \t]*(?:\r\n|$)", 1)
    return F.when(found != "", found)


def _number(head: Column, name: str) -> Column:
    return F.regexp_extract(_field(head, name), rf"^<{ID_PREFIX}(-?[0-9]+)>$", 1).try_cast("long")


def parse(rows: DataFrame) -> DataFrame:
    """Add what the header in `value` says, and the payload's size and digest if it is all there."""
    size, head = F.octet_length("value"), F.substring_index("value", END, 1)
    first = rows.withColumns({"__head": head, "__size": size})
    second = first.withColumns({
        "head_bytes": F.when(F.octet_length("__head") < F.col("__size"), F.octet_length("__head") + 4).cast("long"),
        "block_bytes": _field(F.col("__head"), "Content-Length").try_cast("long"),
        "record_type": _field(F.col("__head"), "WARC-Type"),
        "page_id": _number(F.col("__head"), "WARC-Record-ID"),
        "refers_to": _number(F.col("__head"), "WARC-Refers-To"),
        "said_digest": F.regexp_extract(_field(F.col("__head"), "WARC-Payload-Digest"), "^sha1:(.*)$", 1),
    }).withColumn("whole", F.coalesce(F.col("head_bytes") + F.col("block_bytes") <= F.col("__size"), F.lit(False)))
    octets = F.col("value").cast("binary")
    block = F.when(F.col("whole"), F.substr(octets, (F.col("head_bytes") + 1).cast("int"), F.col("block_bytes").cast("int")))
    third = second.withColumn("__block", block)
    http = F.octet_length(F.substring_index(F.col("__block").cast("string"), END, 1)) + 4
    fourth = third.withColumn("__payload", F.substr("__block", (http + 1).cast("int"), F.octet_length("__block")))
    return fourth.withColumns({
        "payload_bytes": F.octet_length("__payload").cast("long"), "payload_digest": payload_digest(F.col("__payload")),
    }).drop("__head", "__size", "__block", "__payload")


def rows_between_magic(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, n, value, bytes): what lies between version lines, in order of n by split."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("n"), "value",
        (F.octet_length("value") + len(MAGIC)).cast("long").alias("bytes"),
    )


def _located(rows: DataFrame) -> DataFrame:
    """Add `offset`, the place in the file of the version line before each row."""
    inside = Window.partitionBy("file", "split").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("file", "split").agg(F.sum("bytes").alias("size"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(sizes.select("file", "split", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")))
    local = rows.withColumn("__inside", F.coalesce(F.sum("bytes").over(inside), F.lit(0)))
    return attach(local, bases, ["file", "split"]).withColumn(
        "offset", F.col("base") + F.col("__inside") - len(MAGIC)
    ).drop("base", "__inside")


def _exits(rows):
    """Where each candidate's chain leaves its split."""
    rows = rows.sort_values("offset", ascending=False)
    out: dict[int, int] = {}
    for offset, successor in zip(rows["offset"].tolist(), rows["successor"].tolist()):
        out[offset] = out.get(successor, successor)
    return pd.DataFrame({"file": rows["file"].astype(object), "offset": list(out), "exit": list(out.values())})


def _marked(rows):
    """The candidates of a split that its entries reach."""
    rows = rows.sort_values("offset")
    open_ends, found = set(), []
    for offset, successor, entry in zip(*(rows[c].tolist() for c in ("offset", "successor", "entry"))):
        if entry or offset in open_ends:
            open_ends.add(successor)
            found.append(offset)
    return pd.DataFrame({"file": rows["file"].iloc[:len(found)].astype(object), "offset": found})


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates (file, split, offset, successor) on the chains from 0."""
    exits = stored(candidates.groupBy("file", "split").applyInPandas(_exits, "file string, offset bigint, exit bigint"))
    places = exits.select("file", F.col("exit").alias("at")).unionByName(exits.where("offset = 0").select("file", F.col("offset").alias("at"))).distinct()
    jump = stored(places.join(exits.withColumnRenamed("offset", "at"), ["file", "at"]).select("file", "at", F.col("exit").alias("to")))
    reached = jump.where("at = 0").select("file", "at")
    while True:
        ahead = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        grown = stored(reached.unionByName(ahead).distinct())
        jump = stored(jump.join(jump.select("file", F.col("at").alias("to"), F.col("to").alias("end")), ["file", "to"]).select("file", "at", F.col("end").alias("to")))
        reached = grown
        if jump.isEmpty():
            break
    # A chain's last jump ends where no candidate is; that place falls out here.
    entries = reached.withColumnRenamed("at", "offset").withColumn("entry", F.lit(True))
    flagged = candidates.join(entries, ["file", "offset"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return flagged.groupBy("file", "split").applyInPandas(_marked, "file string, offset bigint")


RECORD = ("record_type", "page_id", "refers_to", "said_digest", "payload_bytes", "payload_digest")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records on the verified chains of all files below `path`, one row each."""
    rows = rows_between_magic(spark, path)
    header = stored(parse(rows).drop("value"))
    successor = F.col("offset") + len(MAGIC) + F.col("head_bytes") + F.col("block_bytes") + len(END)
    placed = stored(_located(header).withColumn("successor", successor))
    candidates = placed.where("offset >= 0 AND successor IS NOT NULL").select("file", "split", "offset", "successor")
    kept = stored(reachable(candidates))
    records = placed.join(kept, ["file", "offset"], "left_semi")
    single = records.where("whole").select(*RECORD)
    cut = records.where("NOT whole").select("file", "offset", "successor")
    files = [r["file"] for r in cut.select("file").distinct().toLocalIterator()]
    if not files:
        return single
    # Rows from a cut record's version line up to its successor belong to it.
    latest = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    heads = placed.where("offset >= 0").select("file", "offset").join(kept.withColumn("head", F.col("offset")), ["file", "offset"], "left")
    owned = heads.withColumn("head", F.last("head", ignorenulls=True).over(latest))
    pieces = owned.join(cut.select("file", F.col("offset").alias("head")), ["file", "head"])
    again = _located(rows_between_magic(spark, files)).join(pieces, ["file", "offset"])
    joined = again.groupBy("file", "head").agg(F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("parts"))
    whole = joined.select(F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC).alias("value"))
    return single.unionByName(parse(whole).select(*RECORD))


def resolve(records: DataFrame) -> DataFrame:
    """Give revisits the payload size and digest of the response that they refer to."""
    responses = records.where("record_type = 'response'")
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    asked = revisits.select(F.col("refers_to").alias("page_id"), F.col("said_digest").alias("payload_digest")).distinct()
    found = responses.select("page_id", "payload_digest", "payload_bytes").distinct().join(asked, ["page_id", "payload_digest"])
    found = stored(found.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("said_digest"), "payload_bytes", "payload_digest"))
    return responses.unionByName(attach(revisits, found, ["refers_to", "said_digest"]).select(responses.columns))


def round_trip(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write the pages to `path`, read the archives back: one row per record."""
    write_archives(pages, path, min_bytes)
    records = stored(read_records(pages.sparkSession, path))
    return resolve(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
