"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts up to `ORDER` bytes with counts of the bytes that follow.
In a context seen n times with d different successors (method C), a successor seen c times has
probability c / (n + d); the escape, d / (n + d), passes to the context without its first byte, and
below the empty context all 256 bytes are equally likely. Statistics are frozen after training, so a
text's exact code length in a language is the sum of -log2 of these probabilities over its bytes,
and depends only on how often each run of ORDER + 1 bytes occurs.

Training counts byte runs of every length in Spark, over all training rows, per language; partial
counts are combined before they move. Every run is kept, however rare: code lengths in all languages
are joined level by level into stored tables, one row for each known run and one for each context's
escape. The tables are dealt by run into parts of bounded size, which the workers read one after
another. Scoring streams whole texts in batches, looks up the distinct runs of a batch in the parts,
and weighs the code lengths by how often each document holds the run; a run that no language knows
takes the escape path through the tables.

The prediction is the language with the shortest code; the score is its posterior under equal
priors, with the code lengths per byte scaled to a text of `SCORE_BYTES` bytes at most, so that long
texts don't saturate. Ties go to the smaller language name.

Defined results: a NULL text or one without a letter gets `und` and score 0; without any training
row all texts do. Text is lower-cased and a digit counts as 0 before bytes are taken, in training
and prediction alike. Repeated rows are scored one by one; ids may be NULL or repeat.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 3
# Code lengths (runs times languages) of one part of a table, that a worker holds for good, and of
# the runs that a worker looks up at once.
PART_CELLS = 4_000_000
HELD_CELLS = 16_000_000
BATCH_CELLS = 8_000_000
SCORE_BYTES = 200
# Bytes that stand before a text: three blanks.
LEAD = b"   "
UNDETERMINED = "und"
DIGITS = str.maketrans("0123456789", "0" * 10)


def normal_bytes(text: str) -> bytes:
    return LEAD + text.lower().translate(DIGITS).encode("utf-8", "replace")


def runs(data: bytes, length: int) -> np.ndarray:
    """The byte runs of a length that end at each byte after the lead, as numbers."""
    octets = np.frombuffer(data, dtype=np.uint8)
    n = len(octets) - len(LEAD)
    out = np.zeros(n, dtype=np.uint32)
    for k in range(length):
        at = len(LEAD) - length + 1 + k
        out = out << np.uint32(8) | octets[at:at + n]
    return out


def count_runs(training: DataFrame) -> DataFrame:
    """(lang, run, n): runs of ORDER + 1 bytes with counts, for rows (text, lang)."""
    schema = pa.schema([("lang", pa.string()), ("run", pa.int64()), ("n", pa.int64())])

    def count(batches):
        # The texts of a language are joined up to this many bytes before they are counted.
        limit, waiting, sizes = 8_000_000, {}, {}

        def flush(lang):
            found, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            sizes.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found)), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], schema=schema
            )

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = runs(normal_bytes(text), ORDER + 1)
                waiting.setdefault(lang, []).append(found)
                sizes[lang] = sizes.get(lang, 0) + len(found)
                if sizes[lang] >= limit:
                    yield flush(lang)
        for lang in sorted(waiting):
            yield flush(lang)

    some = training.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counted = some.mapInArrow(count, "lang string, run bigint, n bigint")
    return counted.groupBy("lang", "run").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Frozen code lengths: known runs of ORDER + 1 bytes, and the trees for unknown ones."""

    langs: list[str]
    trees: list[list[dict]]  # per language and run length 1 to ORDER + 1: run -> count
    totals: list[list[dict]]  # per language and context length 0 to ORDER: context -> (n, d)
    first: np.ndarray  # place of each known run of ORDER bytes, 0 for unknown, by its number
    second: np.ndarray  # row of the code table, by place and last byte; 0 for unknown
    codes: np.ndarray  # rows of code lengths in bits, one per language

    def code_length(self, lang: int, run: int) -> float:
        """Bits of the last byte of a run after the bytes before it."""
        bits = 0.0
        for context_bytes in range(ORDER, -1, -1):
            tail = run & ((1 << 8 * (context_bytes + 1)) - 1)
            seen = self.totals[lang][context_bytes].get(tail >> 8)
            if seen is None:
                continue
            n, d = seen
            c = self.trees[lang][context_bytes].get(tail)
            if c:
                return bits - math.log2(c / (n + d))
            bits -= math.log2(d / (n + d))
        return bits + 8.0


def freeze(counts: list[tuple[list[str], np.ndarray, np.ndarray]]) -> Model:
    """A model from the columns (lang, run, n) of each run length."""
    langs = sorted({lang for part in counts for lang in part[0]})
    number = {lang: k for k, lang in enumerate(langs)}
    trees = [[{} for _ in range(ORDER + 1)] for _ in langs]
    totals = [[{} for _ in range(ORDER + 1)] for _ in langs]
    for context_bytes, part in enumerate(counts):
        for lang, run, n in zip(part[0], part[1].tolist(), part[2].tolist()):
            trees[number[lang]][context_bytes][run] = n
            total = totals[number[lang]][context_bytes]
            n_before, d_before = total.get(run >> 8, (0, 0))
            total[run >> 8] = (n_before + n, d_before + 1)
    known = sorted({run for t in trees for run in t[ORDER]})
    contexts = sorted({run >> 8 for run in known})
    first = np.zeros(1 << 8 * ORDER, dtype=np.int32)
    first[contexts] = np.arange(1, len(contexts) + 1)
    model = Model(langs, trees, totals, first, np.zeros((len(contexts) + 1) * 256, dtype=np.int32), np.zeros((len(known) + 1, len(langs))))
    for row, run in enumerate(known, 1):
        model.second[int(first[run >> 8]) * 256 + (run & 255)] = row
        model.codes[row] = [model.code_length(k, run) for k in range(len(langs))]
    return model


def train(training: DataFrame, max_nodes: int | None = None) -> list[tuple[list[str], np.ndarray, np.ndarray]]:
    """The frozen counts, columns (lang, run, n) for each run length, brought to the driver.

    With `max_nodes` the most frequent runs of each length, at most so many for all languages
    together. `identify` uses the whole tables of `code_tables` instead.
    """
    from tidemark.session import stored

    longest = stored(count_runs(training))
    out = []
    for length in range(1, ORDER + 2):
        short = F.col("run").bitwiseAND(F.lit((1 << 8 * length) - 1)).alias("run")
        table = stored(longest.groupBy("lang", short).agg(F.sum("n").alias("n")))
        # Runs by steps of their count: the least count that keeps the tree within its bound.
        step = F.floor(16 * F.log2("n")).cast("int").alias("step")
        least, kept = 0, 0
        for row in table.groupBy(step).count().orderBy(F.desc("step")).collect():
            kept += row["count"]
            if max_nodes is not None and kept > max_nodes:
                least = row["step"] + 1
                break
        best = table.where(F.floor(16 * F.log2("n")).cast("int") >= least).orderBy("lang", "run").toArrow()
        out.append((best["lang"].to_pylist(), best["run"].to_numpy(), best["n"].to_numpy()))
    return out


def _by_language(rows: DataFrame, key: str, langs: list[str], columns: list[str]) -> DataFrame:
    """One row per key, each column an array over the languages, 0 where a language has no row."""
    entries = F.collect_list(F.struct("lang", F.struct(*columns).alias("of")))
    wide = rows.groupBy(key).agg(F.map_from_entries(entries).alias("entries"))
    names = F.array(*map(F.lit, langs))
    of = lambda c: F.transform(names, lambda x: F.coalesce(F.try_element_at("entries", x)[c], F.lit(0)))
    return wide.select(key, *(of(c).alias(c) for c in columns))


def code_tables(longest: DataFrame, langs: list[str]) -> list[tuple[DataFrame, DataFrame]]:
    """For each run length from 1: (run, bits) of the runs that any language knows, with their code
    lengths, and (run, bits) of their contexts, with the code lengths of the escapes.

    `longest` has stored counts (lang, run, n); `bits` is an array over the languages. A run's code
    needs its context, and the code of the run without its first byte; both are known where it is.
    """
    from tidemark.session import stored

    out = []
    for length in range(1, ORDER + 2):
        run = F.col("run").bitwiseAND(F.lit((1 << 8 * length) - 1)).alias("run")
        counts = longest.groupBy("lang", run).agg(F.sum("n").alias("c"))
        context = F.shiftright("run", 8).alias("context")
        totals = counts.groupBy("lang", context).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("d"))
        contexts = stored(_by_language(totals, "context", langs, ["n", "d"]))
        escape = F.transform(F.arrays_zip("n", "d"), lambda x: F.when(x["n"] > 0, -F.log2(x["d"] / (x["n"] + x["d"]))).otherwise(0.0))
        known = _by_language(counts, "run", langs, ["c"]).withColumn("context", context).join(contexts, "context")
        if out:
            shorter = out[-1][0].select(F.col("run").alias("tail"), F.col("bits").alias("below"))
            known = known.withColumn("tail", F.col("run").bitwiseAND(F.lit((1 << 8 * (length - 1)) - 1))).join(shorter, "tail")
        else:
            known = known.withColumn("below", F.array_repeat(F.lit(8.0), len(langs)))
        bits = F.transform(
            F.arrays_zip("c", "n", "d", "below"),
            lambda x: F.when(x["c"] > 0, -F.log2(x["c"] / (x["n"] + x["d"])))
            .when(x["n"] > 0, x["below"] - F.log2(x["d"] / (x["n"] + x["d"]))).otherwise(x["below"]),
        )
        known = stored(known.select("run", bits.alias("bits")))
        out.append((known, contexts.select(F.col("context").alias("run"), escape.alias("bits"))))
    return out


def _parts(rows: DataFrame, width: int, cells: int) -> tuple[list, int]:
    """Broadcast (runs in order, code lengths) of a table, at most about `cells` each, and the table's cells."""
    total = rows.count() * width
    parts = max(1, -(-total // cells)) | 1
    out = []
    for part in range(parts):
        table = rows.where(F.col("run") % parts == part).toArrow()
        run = table["run"].to_numpy()
        bits = table["bits"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(run), width)
        order = np.argsort(run)
        out.append(rows.sparkSession.sparkContext.broadcast((run[order].astype(np.uint32), bits[order])))
    return out, total


def _lookup(tables: list, width: int, hold: bool):
    """A function from distinct runs to their code lengths (run, language)."""

    def add(parts, wanted, at, out):
        """Add the code lengths of the wanted runs to rows `at`; returns which were found."""
        found = np.zeros(len(wanted), dtype=bool)
        for part in parts:
            run, bits = part.value
            if not hold:
                # The worker reads the part again from its disk for the next batch.
                vars(part).pop("_value", None)
            if not len(run):
                continue
            place = np.minimum(np.searchsorted(run, wanted), len(run) - 1)
            hit = run[place] == wanted
            out[at[hit]] += bits[place[hit]]
            found |= hit
        return found

    def code_lengths(wanted):
        out, at = np.zeros((len(wanted), width)), np.arange(len(wanted))
        for length in range(ORDER + 1, 0, -1):
            known, escapes = tables[length - 1]
            unknown = ~add(known, wanted, at, out)
            wanted, at = wanted[unknown], at[unknown]
            if not len(wanted):
                return out
            add(escapes, wanted >> np.uint32(8), at, out)
            wanted = wanted & np.uint32((1 << 8 * (length - 1)) - 1)
        out[at] += 8.0
        return out

    return code_lengths


def _scored(docs: DataFrame, langs: list[str], lookup, id_column: str, text: str) -> DataFrame:
    """(id, lang_pred, score) of every row; `lookup()` makes a worker's function from runs to code lengths."""
    limit = max(100_000, BATCH_CELLS // max(1, len(langs)))

    def score(batches):
        code_lengths, waiting, size = None, [], 0

        def flush():
            nonlocal code_lengths
            code_lengths = code_lengths or lookup()
            lang, posterior = [UNDETERMINED] * len(waiting), [0.0] * len(waiting)
            some = [k for k, (_, run, _) in enumerate(waiting) if run is not None]
            if some:
                distinct, place = np.unique(np.concatenate([waiting[k][1] for k in some]), return_inverse=True)
                costs, start = code_lengths(distinct), 0
                for k in some:
                    _, run, n = waiting[k]
                    bits = n @ costs[place[start:start + len(run)]]
                    start += len(run)
                    best, length = int(np.argmin(bits)), int(n.sum())
                    scaled = (bits[best] - bits) / length * min(length, SCORE_BYTES)
                    lang[k], posterior[k] = langs[best], float(1 / np.exp2(scaled).sum())
            return pd.DataFrame({"key": [key for key, _, _ in waiting], "lang_pred": lang, "score": posterior})

        for batch in batches:
            for key, body in zip(batch["key"], batch["text"]):
                run = n = None
                if langs and body and any(map(str.isalpha, body)):
                    run, n = np.unique(runs(normal_bytes(body), ORDER + 1), return_counts=True)
                    size += len(run)
                waiting.append((key, run, n))
                if size >= limit or len(waiting) >= 10_000:
                    yield flush()
                    waiting, size = [], 0
        if waiting:
            yield flush()

    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(f"`{id_column}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    scored = source.mapInPandas(score, "key string, lang_pred string, score double")
    return scored.select(F.col("key").cast(kind).alias(id_column), "lang_pred", "score")


def predict(docs: DataFrame, counts: list, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row, by the counts of `train`."""
    packed = docs.sparkSession.sparkContext.broadcast(counts)

    def lookup():
        model = freeze(packed.value)

        def code_lengths(wanted):
            rows = model.second[model.first[wanted >> np.uint32(8)].astype(np.int64) * 256 + (wanted & np.uint32(255))]
            out = model.codes[rows]
            for k in np.flatnonzero(rows == 0).tolist():
                out[k] = [model.code_length(i, int(wanted[k])) for i in range(len(model.langs))]
            return out

        return code_lengths

    return _scored(docs, sorted({lang for part in counts for lang in part[0]}), lookup, id_column, text)


def predict_whole(docs: DataFrame, longest: DataFrame, id_column: str = "doc_id", text: str = "text", cells: int = PART_CELLS) -> DataFrame:
    """(id, lang_pred, score) of every row, by all runs of the stored counts of `count_runs`."""
    langs = sorted(r["lang"] for r in longest.select("lang").distinct().collect())
    tables, held = [], 0
    if langs:
        for known, escapes in code_tables(longest, langs):
            (a, m), (b, n) = (_parts(rows, len(langs), cells) for rows in (known, escapes))
            tables.append((a, b))
            held += m + n
    return _scored(docs, langs, lambda: _lookup(tables, len(langs), held <= HELD_CELLS), id_column, text)


def held_out(id_column: Column) -> Column:
    """Rows kept from training: crc32 of the id as text has remainder 2 by 4."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score): learn from the rows not held out, predict all."""
    from tidemark.session import stored

    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    longest = stored(count_runs(rows.where(~held_out(F.col("id")))))
    scored = predict_whole(rows.select("id", "text"), longest, "id")
    return scored.select(F.col("id").alias(id_column), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
