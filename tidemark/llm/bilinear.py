"""A log-bilinear language model, trained by noise-contrastive estimation in numpy.

The vocabulary is every word of the training texts and a text's end, without a limit. A word belongs to
a class: the most frequent words and the end own one each, all others share `ENDINGS` classes by their
last two bytes. A token's probability is that of its class after the two classes before it, times its
share of the class by smoothed counts; each shared class keeps one place for unknown words with its
endings. The neural part has thus a fixed size, `CLASSES` by `WIDTH`, and the counts cover all words.

The two context vectors pass through one matrix each and are added; their product with a class's output
vector, plus its bias, is the class's score. Training tells each next class from `NOISE` classes drawn
by frequency: every task takes its share of all training texts from the same parameters in shuffled
minibatches, the tasks' results are averaged by Spark, weighted by tokens, and this is repeated
`ROUNDS` times. As contexts are pairs of classes, one batched matrix product per class gives the exact
normaliser of every possible context, so scores are true log-probabilities: over all words and the
places of unknown ones they add up to 1.

1. Tasks turn texts into numbers of words, block by block, and write each block's distinct words with
   their training counts.
2. Spark adds the counts up; each block gets back the count and class of every word it holds.
3. Blocks are written as sequences of classes, with the sums that need counts only.
4. Training rounds and scoring read these sequences; the parameters are all that is broadcast.

A word is one row per block, however frequent, and texts never move as a whole. Random draws are seeded
by round and task: a lost task repeats its work.

Defined results: a NULL or empty text is its end alone; without training texts all words are unknown.
Words of equal counts are ordered by their bytes. Rows with a NULL id aren't held out; ids may repeat,
each row is scored. Very long texts are scored whole. Only the two named columns are read, whatever
others are called; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import pack_numbers, unpack_numbers
from tidemark.session import scratch_path, stored

CLASSES, ENDINGS, WIDTH = 1024, 256, 16
NOISE, BATCH, ROUNDS, RATE = 32, 1024, 2, 0.2
# What a word's count is raised by, as in the base score.
SMOOTHING = 0.1
# Characters of a block and of the texts of one row.
BLOCK_CHARS, ROW_CHARS, ROW_DOCS = 32_000_000, 1_000_000, 4096
WORD_ROWS = 65_536
# Stands for a text's end; no word holds a line break. Its class is 0.
END = b"\n"


def tokens(text: str | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, and the end."""
    return [*(text or "").encode().lower().split(), END]


@dataclass
class Parameters:
    inner: np.ndarray  # vectors of classes as context
    outer: np.ndarray  # vectors of classes as next class
    bias: np.ndarray
    near: np.ndarray  # matrix of the class just before
    far: np.ndarray  # matrix of the class before that

    def rows(self) -> np.ndarray:
        """All parameters as rows of WIDTH + 1 numbers; the last is the bias."""
        flat = np.concatenate([self.inner, self.outer, self.near, self.far])
        last = np.zeros((len(flat), 1), dtype=flat.dtype)
        last[len(self.inner):len(self.inner) + len(self.bias), 0] = self.bias
        return np.concatenate([flat, last], axis=1)

    @staticmethod
    def of_rows(rows: np.ndarray, classes: int) -> Parameters:
        width = rows.shape[1] - 1
        cut = lambda at, n: np.ascontiguousarray(rows[at:at + n, :width], dtype=np.float32)
        return Parameters(
            cut(0, classes), cut(classes, classes), rows[classes:2 * classes, width].astype(np.float32),
            cut(2 * classes, width), cut(2 * classes + width, width),
        )


def first_parameters(frequency: np.ndarray, width: int = WIDTH) -> Parameters:
    """Small random vectors, matrices near the identity, and biases that give the frequencies."""
    rng, classes = np.random.default_rng(0), len(frequency)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    same = np.eye(width, dtype=np.float32)
    return Parameters(small(classes, width), small(classes, width), np.log(frequency).astype(np.float32), same.copy(), 0.5 * same)


def _by_row(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices and the sums of their rows, as differences of running sums over the sorted rows."""
    order = np.argsort(index, kind="stable")
    found = index.take(order)
    ends = np.flatnonzero(np.concatenate([found[1:] != found[:-1], [True]]))
    sums = np.cumsum(values.take(order, axis=0), axis=0).take(ends, axis=0)
    sums[1:] -= sums[:-1].copy()
    return found.take(ends), sums


def _chance(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), which doesn't overflow."""
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Trainer:
    """Noise-contrastive steps on a copy of the parameters, with step sizes by past gradients."""

    def __init__(self, start: Parameters, frequency: np.ndarray, seed: tuple, noise: int = NOISE, rate: float = RATE):
        self.p = Parameters(*(x.copy() for x in vars(start).values()))
        self.past = Parameters(*(np.full_like(x, 1e-3) for x in vars(start).values()))
        self.noise, self.rate, self.rng = noise, np.float32(rate), np.random.default_rng(seed)
        self.cumulated = np.cumsum(frequency)
        self.offset = (np.log(frequency) + math.log(noise)).astype(np.float32)
        self.seen = 0

    def _move(self, name: str, index, gradient) -> None:
        past, value = getattr(self.past, name), getattr(self.p, name)
        if index is ...:
            past += gradient * gradient
            value -= self.rate * gradient / np.sqrt(past)
            return
        rows = past.take(index, axis=0)
        rows += gradient * gradient
        past[index] = rows
        np.sqrt(rows, out=rows)
        np.divide(gradient, rows, out=rows)
        rows *= self.rate
        value[index] = value.take(index, axis=0) - rows

    def step(self, near: np.ndarray, far: np.ndarray, after: np.ndarray) -> None:
        """One minibatch: the classes before and the class that follows."""
        p, n = self.p, np.float32(1 / len(after))
        drawn = np.searchsorted(self.cumulated, self.rng.random(self.noise) * self.cumulated[-1])
        drawn = np.minimum(drawn, len(p.bias) - 1).astype(after.dtype)
        a, b = p.inner.take(near, axis=0), p.inner.take(far, axis=0)
        out, wrong = p.outer.take(after, axis=0), p.outer.take(drawn, axis=0)
        context = a @ p.near + b @ p.far
        # Probability that the true class is noise, and that each noise class is true.
        right = np.einsum("ij,ij->i", context, out) + (p.bias - self.offset).take(after)
        false = context @ wrong.T + (p.bias - self.offset).take(drawn)
        up, down = -n * _chance(-right), n * _chance(false)
        back = up[:, None] * out + down @ wrong
        moves = [
            ("near", ..., a.T @ back), ("far", ..., b.T @ back),
            ("inner", *_by_row(np.concatenate([near, far]), np.concatenate([back @ p.near.T, back @ p.far.T]))),
        ]
        both = np.empty((len(after) + len(drawn), context.shape[1] + 1), dtype=context.dtype)
        both[:len(after), :-1], both[:len(after), -1] = up[:, None] * context, up
        both[len(after):, :-1], both[len(after):, -1] = down.T @ context, down.sum(axis=0)
        index, sums = _by_row(np.concatenate([after, drawn]), both)
        moves += [("outer", index, sums[:, :-1]), ("bias", index, sums[:, -1])]
        for move in moves:
            self._move(*move)

    def train(self, near, far, after, batch: int = BATCH) -> None:
        """All tokens once, in random order."""
        order = self.rng.permutation(len(after))
        self.seen += len(after)
        # Small numbers sort faster.
        near, far, after = (x.astype(np.uint16 if len(self.p.bias) <= 65_536 else np.int64) for x in (near, far, after))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            self.step(near[some], far[some], after[some])


def contexts(after: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes before each token of texts that follow one another; before a text stand ends."""
    near = np.concatenate([[0], after[:-1]])
    far = np.concatenate([[0], near[:-1]])
    # A text's end is class 0, so only the class before it must be hidden from the next text.
    far[np.cumsum(sizes) - sizes] = 0
    return near, far


def log_normalisers(p: Parameters, far: int) -> np.ndarray:
    """The logarithm of the sum over all classes, for each class before after the class `far`."""
    scores = (p.inner @ p.near + p.inner[far] @ p.far) @ p.outer.T + p.bias
    most = scores.max(axis=1, keepdims=True)
    return np.log(np.exp(scores - most).sum(axis=1, dtype=np.float64)) + most[:, 0]


def class_of(word: Column, own: Column, classes: int, endings: int) -> Column:
    ending = F.pmod(F.crc32(F.substring(word, -2, 2)), F.lit(endings))
    return F.coalesce(own, ending + (classes - endings)).cast("int")


def write_words(docs: DataFrame, path: str, id_column: str, text: str, trains: Column, block_chars: int) -> DataFrame:
    """Write texts as numbers of words, block by block, and the blocks' distinct words.

    A row holds either `words` with their training `counts` and the number of the first, or a batch
    of documents: keys, whether they train, tokens, and the `numbers` by position.
    """
    longs = pa.list_(pa.int64())
    schema = pa.schema([
        ("block", pa.int64()), ("first", pa.int64()), ("words", pa.list_(pa.binary())), ("counts", longs),
        ("keys", pa.list_(pa.string())), ("trains", pa.list_(pa.bool_())), ("sizes", longs), ("numbers", pa.binary()),
    ])

    def run(source):
        part, serial, chars, fresh = TaskContext.get().partitionId(), 0, 0, 0
        held, some, found = [], [], []

        def close():
            held.append(([k for k, *_ in some], [t for _, t, _ in some], [n for *_, n in some], pa.array(found, pa.binary())))
            some.clear()
            found.clear()

        def flush():
            block, number = part << 32 | serial, pa.chunked_array([w for *_, w in held]).dictionary_encode()
            words = number.chunk(number.num_chunks - 1).dictionary
            counts = np.zeros(len(words), dtype=np.int64)
            for (keys, trains, sizes, _), chunk in zip(held, number.chunks):
                own = chunk.indices.to_numpy().astype(np.int64)
                counts += np.bincount(own[np.repeat(trains, sizes)], minlength=len(words))
                yield pa.RecordBatch.from_pylist([{
                    "block": block, "keys": keys, "trains": trains, "sizes": sizes, "numbers": pack_numbers(own),
                }], schema)
            for at in range(0, len(words), WORD_ROWS):
                yield pa.RecordBatch.from_pylist([{
                    "block": block, "first": at, "words": words.slice(at, WORD_ROWS).to_pylist(), "counts": counts[at:at + WORD_ROWS],
                }], schema)

        for batch in source:
            for key, train, body in zip(*(batch.column(k).to_pylist() for k in range(3))):
                own = tokens(body)
                some.append((key, train, len(own)))
                found += own
                fresh += len(body or "")
                if fresh >= ROW_CHARS or len(some) >= ROW_DOCS:
                    close()
                    chars, fresh = chars + fresh, 0
                if chars >= block_chars:
                    yield from flush()
                    held.clear()
                    chars, serial = 0, serial + 1
        if some:
            close()
        if held:
            yield from flush()

    columns = (
        "block bigint, first bigint, words array<binary>, counts array<bigint>, keys array<string>, trains array<boolean>, "
        "sizes array<bigint>, numbers binary"
    )
    source = docs.select(F.col(f"`{id_column}`").cast("string").alias("key"), trains.alias("trains"), F.col(f"`{text}`").alias("text"))
    source.mapInArrow(run, columns).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


@dataclass
class Vocabulary:
    """Counts of the training texts: all words as a stored table (word, c), and the classes' sums."""

    words: DataFrame
    own: DataFrame  # (word, own): the words with a class of their own
    total: int
    distinct: int
    class_count: np.ndarray
    class_words: np.ndarray
    endings: int

    @property
    def frequency(self) -> np.ndarray:
        return (self.class_count + 1.0) / (self.class_count.sum() + len(self.class_count))

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1)))

    def within(self, count: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its class; a class of one word has no other."""
        shared = np.log10((count + SMOOTHING) / (self.class_count[of] + SMOOTHING * (self.class_words[of] + 1)))
        return np.where(of < len(self.class_count) - self.endings, 0.0, shared)


def _named_words(blocks: DataFrame) -> DataFrame:
    """(block, number, word, n): the distinct words of each block."""
    rows = blocks.where("words IS NOT NULL").select("block", "first", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    return rows.select("block", (F.col("first") + F.col("at")).alias("number"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))


def vocabulary(blocks: DataFrame, classes: int = CLASSES, endings: int = ENDINGS) -> Vocabulary:
    """Add the blocks' counts up and give the most frequent words classes of their own."""
    words = stored(_named_words(blocks).groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"))
    most = words.where(F.col("word") != F.lit(END)).orderBy(F.desc("c"), "word").limit(classes - endings - 1).collect()
    own = [(END, 0)] + [(r["word"], k) for k, r in enumerate(most, 1)]
    own = blocks.sparkSession.createDataFrame([(bytes(w), k) for w, k in own], "word binary, own int")
    of = class_of(F.col("word"), F.col("own"), classes, endings).alias("class")
    by_class = words.join(F.broadcast(own), "word", "left").groupBy(of).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
    count, distinct = np.zeros(classes, dtype=np.int64), np.zeros(classes, dtype=np.int64)
    for r in by_class.collect():
        count[r["class"]], distinct[r["class"]] = r["n"], r["v"]
    return Vocabulary(words, own, int(count.sum()), int(distinct.sum()), count, distinct, endings)


def _sequences(known: Vocabulary, schema: pa.Schema):
    """Replace a block's word numbers by classes and add up what depends on counts alone."""
    table = Vocabulary(None, None, known.total, known.distinct, known.class_count, known.class_words, known.endings)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        count, of = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        number = right["number"].to_numpy()
        count[number], of[number] = right["c"].to_numpy(), right["class"].to_numpy()
        base, within, out = table.base(count), table.within(count, of), []
        for row in left.to_pylist():
            own, sizes = unpack_numbers(row["numbers"]), np.array(row["sizes"], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            out.append({
                "keys": row["keys"], "trains": row["trains"], "sizes": sizes, "classes": pack_numbers(of[own]),
                "known": np.add.reduceat((count > 0).astype(np.int64)[own], starts),
                "base": np.add.reduceat(base[own], starts), "within": np.add.reduceat(within[own], starts),
            })
        return pa.Table.from_pylist(out, schema)

    return join


def write_sequences(blocks: DataFrame, known: Vocabulary, path: str) -> DataFrame:
    """Write (keys, trains, sizes, classes, known, base, within): batches of texts as classes."""
    of = class_of(F.col("word"), F.col("own"), len(known.class_count), known.endings).alias("class")
    named = _named_words(blocks).select("block", "number", "word").join(known.words, "word", "left").join(F.broadcast(known.own), "word", "left")
    named = named.select("block", "number", F.coalesce("c", F.lit(0)).cast("long").alias("c"), of)
    longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
    schema = pa.schema([
        ("keys", pa.list_(pa.string())), ("trains", pa.list_(pa.bool_())), ("sizes", longs), ("classes", pa.binary()),
        ("known", longs), ("base", doubles), ("within", doubles),
    ])
    columns = (
        "keys array<string>, trains array<boolean>, sizes array<bigint>, classes binary, known array<bigint>, "
        "base array<double>, within array<double>"
    )
    batches = blocks.where("keys IS NOT NULL").select(F.col("block").alias("owner"), "keys", "trains", "sizes", "numbers")
    batches.groupBy("owner").cogroup(named.groupBy("block")).applyInArrow(_sequences(known, schema), columns).write.parquet(path)
    return blocks.sparkSession.read.parquet(path)


def train_round(sequences: DataFrame, start: Parameters, frequency: np.ndarray, number: int) -> Parameters:
    """Every task trains on its share of the training texts; the average of all, weighted by tokens."""
    width = start.inner.shape[1] + 1
    schema = pa.schema([("slot", pa.int32()), ("weight", pa.float64()), ("row", pa.list_(pa.float32()))])

    def run(batches):
        trainer = Trainer(start, frequency, (number, TaskContext.get().partitionId()))
        for batch in batches:
            for row in batch.to_pylist():
                sizes, train = np.array(row["sizes"], dtype=np.int64), np.array(row["trains"], dtype=bool)
                after = unpack_numbers(row["classes"]).astype(np.int64)[np.repeat(train, sizes)]
                if len(after):
                    trainer.train(*contexts(after, sizes[train]), after)
        if trainer.seen:
            rows = trainer.p.rows()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(len(rows)), pa.int32()), pa.array(np.full(len(rows), float(trainer.seen))),
                pa.array(list(rows), pa.list_(pa.float32())),
            ], schema=schema)

    trained = sequences.select("trains", "sizes", "classes").mapInArrow(run, "slot int, weight double, row array<float>")
    mean = [(F.sum(F.col("row")[k] * F.col("weight")) / F.sum("weight")).alias(f"c{k}") for k in range(width)]
    found = trained.groupBy("slot").agg(*mean).orderBy("slot").collect()
    return Parameters.of_rows(np.array([r[1:] for r in found], dtype=np.float64), len(start.bias)) if found else start


def normaliser_table(spark: SparkSession, p: Parameters) -> np.ndarray:
    """(far, near): the logarithms of the sums over all classes, for every context."""
    schema = pa.schema([("far", pa.int64()), ("row", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            far = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(far, pa.int64()), pa.array([log_normalisers(p, k) for k in far], pa.list_(pa.float64()))], schema=schema)

    parts = max(1, len(p.bias) // 32)
    found = spark.range(0, len(p.bias), 1, parts).mapInArrow(run, "far bigint, row array<double>").orderBy("far").toArrow()
    return found["row"].combine_chunks().flatten().to_numpy().reshape(len(p.bias), -1).astype(np.float32)


def score_sequences(sequences: DataFrame, p: Parameters, train_tokens: int) -> DataFrame:
    """(key, trains, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    spark = sequences.sparkSession
    # Both have a fixed size.
    shared = spark.sparkContext.broadcast((p.inner @ p.near, p.inner @ p.far, p.outer, p.bias, normaliser_table(spark, p)))
    names = ["key", "trains", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    types = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(batches):
        by_near, by_far, outer, bias, normaliser = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                sizes, after = np.array(row["sizes"], dtype=np.int64), unpack_numbers(row["classes"]).astype(np.int64)
                near, far = contexts(after, sizes)
                bits = np.empty(len(after))
                for at in range(0, len(after), 100_000):
                    n, f, a = near[at:at + 100_000], far[at:at + 100_000], after[at:at + 100_000]
                    bits[at:at + 100_000] = np.einsum("ij,ij->i", by_near[n] + by_far[f], outer[a]) + bias[a] - normaliser[f, n]
                score = np.add.reduceat(bits, np.cumsum(sizes) - sizes) / math.log(10) + np.array(row["within"])
                values = (row["keys"], row["trains"], sizes, row["known"], [train_tokens] * len(sizes), row["base"], score)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

    return sequences.mapInArrow(
        run, "key string, trains boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def held_out(id_column: Column) -> Column:
    """Rows kept from training: crc32 of the id as text is divisible by 10."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def prepare(
    docs: DataFrame, id_column: str, text: str, trains: Column, classes: int, endings: int, block_chars: int,
) -> tuple[DataFrame, Vocabulary]:
    """The stored sequences of classes of all texts and the vocabulary of the training ones."""
    spark = docs.sparkSession
    blocks = write_words(docs, scratch_path(spark, "words"), id_column, text, trains, block_chars)
    known = vocabulary(blocks, classes, endings)
    return write_sequences(blocks, known, scratch_path(spark, "classes")), known


def language_scores(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", held: Column | None = None, classes: int = CLASSES,
    endings: int = ENDINGS, width: int = WIDTH, rounds: int = ROUNDS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): learn from the rows not held out, score all.

    Scores are log10 probabilities of whole texts; the base is that of independent words.
    """
    held = held_out(F.col(f"`{id_column}`")) if held is None else held
    sequences, known = prepare(docs, id_column, text, ~held, classes, endings, block_chars)
    p = first_parameters(known.frequency, width)
    for number in range(rounds):
        p = train_round(sequences, p, known.frequency, number)
    scored = score_sequences(sequences, p, known.total)
    kind = docs.schema[id_column].dataType.simpleString()
    return scored.select(F.col("key").cast(kind).alias(id_column), (~F.col("trains")).alias("held_out"), *scored.columns[2:])
