"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

1. Every document is tokenised and cut into pieces of at most `capacity` tokens; full pieces are
   sequences of their own. From here on only (id, piece, length) moves.
2. Pieces are dealt to groups of bounded size by a hash of their key. On each group several islands
   evolve a population of packings. The genes are whole sequences: crossover injects well-filled
   sequences of one parent into the other, removes sequences that now hold a piece twice, and
   places the displaced pieces: first in exchange for shorter ones that they fill a sequence better
   than, then by best fit or by new sequences that one or two pieces complete. Mutation dissolves
   sequences that aren't full in the same way. After each epoch an island sends its elite to the next.
3. Each group's best packing keeps its well-filled sequences. The emptiest sixteenth is dealt to
   fewer groups and packed again, until one group is left; that one keeps all.

A group has at most `group_pieces` pieces on average, so no task grows with the corpus, and a level
passes on only what its groups couldn't fill, so levels shrink geometrically. An island stops once
it reaches the lower bound ceil(total / capacity), which no packing can beat. All random draws are
seeded by group, island and epoch: a lost task packs the same way again.

Defined results: a NULL or empty text is one piece with the end token alone; repeated rows are
packed as often as they occur; a NULL id is a value like others.
Texts of any length are encoded whole; pieces of equal length are placed in the order of their numbers;
an empty table gives no rows, and columns other than the id and the text are not read.
"""

from __future__ import annotations

import random
import struct
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokenizer
from tidemark.session import stored

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 4000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 40
POPULATION = 6
# One in so many of a group's sequences, the emptiest ones, is passed on to the next level.
RETRY = 16
# Generations without a better packing after which an island waits for its epoch to end.
PATIENCE = 20


def cut_pieces(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document's tokens and the end token.

    The first piece of a long document takes the remainder, the others are full.
    """
    path = path or tokenizer.default_path()

    def cut(batches):
        encode = tokenizer.whole_texts(path)
        for batch in batches:
            out = []
            for key, body in zip(batch["key"], batch["text"]):
                ids = encode(body) if body else []
                ids.append(END_ID)
                data, start, piece = struct.pack(f"<{len(ids)}I", *ids), 0, 0
                while start < len(ids):
                    length = (len(ids) - start - 1) % capacity + 1 if start == 0 else capacity
                    row = (key, piece, start, length, zlib.crc32(data[4 * start:4 * (start + length)]))
                    out.append((*row, ids[start:start + length]) if with_ids else row)
                    start, piece = start + length, piece + 1
            yield pd.DataFrame(out, columns=["key", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    source = docs.select(F.col(f"`{id_column}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    columns = "key string, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    kind = docs.schema[id_column].dataType.simpleString()
    cut_up = source.mapInPandas(cut, columns)
    return cut_up.select(F.col("key").cast(kind).alias(id_column), *cut_up.columns[1:])


class Packing:
    """Sequences of piece numbers with their filling, for pieces of given lengths."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.fill: list[int] = []

    def copy_of(self, bins: list[list[int]]) -> None:
        for members in bins:
            self.bins.append(members)
            self.fill.append(sum(map(self.lengths.__getitem__, members)))

    def best_fit(self, pieces: list[int]) -> None:
        """Put each piece into the fullest sequence that has room; longest first."""
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        open_rooms = 0
        for number, filled in enumerate(self.fill):
            left = self.capacity - filled
            if left:
                room[left].append(number)
                open_rooms |= 1 << left
        owned = set()
        for piece in sorted(pieces, key=self.lengths.__getitem__, reverse=True):
            length = self.lengths[piece]
            fits = open_rooms >> length
            if fits:
                left = length + (fits & -fits).bit_length() - 1
                number = room[left].pop()
                if not room[left]:
                    open_rooms ^= 1 << left
                if number not in owned:
                    owned.add(number)
                    self.bins[number] = list(self.bins[number])
                self.bins[number].append(piece)
                self.fill[number] += length
            else:
                left, number = self.capacity, len(self.bins)
                owned.add(number)
                self.bins.append([piece])
                self.fill.append(length)
            left -= length
            if left:
                room[left].append(number)
                open_rooms |= 1 << left

    def swap(self, displaced: list[int], numbers: list[int]) -> list[int]:
        """Fill the given sequences better: a displaced piece takes the place of a shorter one that
        leaves just room for it. Returns the pieces that are displaced then, shorter ones."""
        by_length: dict[int, list[int]] = {}
        held = 0
        for piece in displaced:
            by_length.setdefault(self.lengths[piece], []).append(piece)
            held |= 1 << self.lengths[piece]
        for number in numbers:
            room = self.capacity - self.fill[number]
            if not room:
                continue
            best = None
            for place, piece in enumerate(self.bins[number]):
                length = self.lengths[piece]
                # The longest displaced piece that fits in this one's place.
                fits = held & ((1 << (length + room + 1)) - 1)
                gain = fits.bit_length() - 1 - length
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, place
                    if gain == room:
                        break
            if best:
                gain, place = best
                members = list(self.bins[number])
                piece = members[place]
                length = self.lengths[piece] + gain
                members[place] = by_length[length].pop()
                if not by_length[length]:
                    held ^= 1 << length
                by_length.setdefault(length - gain, []).append(piece)
                held |= 1 << (length - gain)
                self.bins[number], self.fill[number] = members, self.fill[number] + gain
        return [p for pieces in by_length.values() for p in pieces]

    def complete(self, pieces: list[int], skip: float = 0.0, rng: random.Random | None = None) -> None:
        """New sequences, one after another: the longest piece left, then the one or two pieces that fill
        what room is left best, until none fits. With `skip` a seed is passed over now and then."""
        by_length: dict[int, list[int]] = {}
        for piece in pieces:
            by_length.setdefault(self.lengths[piece], []).append(piece)
        held = sum(1 << length for length in by_length)

        def take(length: int) -> int:
            nonlocal held
            piece = by_length[length].pop()
            if not by_length[length]:
                held ^= 1 << length
            return piece

        while held:
            length = held.bit_length() - 1
            while rng and rng.random() < skip and (shorter := held & ((1 << length) - 1)):
                length = shorter.bit_length() - 1
            members, room = [take(length)], self.capacity - length
            while (fits := held & ((1 << (room + 1)) - 1)):
                one = first = fits.bit_length() - 1
                best, chosen = one, (one,)
                # Pairs, longer piece first; shorter ones can't beat the best found any more.
                while best < room and 2 * first > best:
                    rest = min(room - first, first)
                    others = held & ((1 << (rest + 1)) - 1)
                    if len(by_length[first]) == 1:
                        others &= ~(1 << first)
                    if others and first + others.bit_length() - 1 > best:
                        best, chosen = first + others.bit_length() - 1, (first, others.bit_length() - 1)
                    below = held & ((1 << first) - 1)
                    if not below:
                        break
                    first = below.bit_length() - 1
                members += map(take, chosen)
                room -= best
            self.bins.append(members)
            self.fill.append(self.capacity - room)

    def score(self) -> tuple[int, int]:
        """Fewer sequences first; then uneven filling, which leaves room to close one."""
        return len(self.bins), -sum(f * f for f in self.fill)


def crossover(a: Packing, b: Packing, rng: random.Random) -> Packing:
    """Inject a run of a's best-filled sequences into b."""
    order = sorted(range(len(a.bins)), key=lambda k: (-a.fill[k], rng.random()))
    chosen = order[:rng.randint(1, max(1, len(order) // 2))]
    injected = [a.bins[k] for k in chosen]
    taken = {p for members in injected for p in members}
    kept, displaced = [], []
    for members in b.bins:
        if taken.isdisjoint(members):
            kept.append(members)
        else:
            displaced += [p for p in members if p not in taken]
    child = Packing(a.lengths, a.capacity)
    child.copy_of(injected + kept)
    refill(child, displaced, rng)
    return child


def refill(packing: Packing, displaced: list[int], rng: random.Random) -> None:
    """Place displaced pieces: in exchange for shorter ones, then where they fit best or in new sequences."""
    open_bins = [k for k, filled in enumerate(packing.fill) if filled < packing.capacity]
    rng.shuffle(open_bins)
    left = packing.swap(displaced, open_bins)
    if rng.random() < 0.5:
        packing.best_fit(left)
    else:
        packing.complete(left, 0.2, rng)


def mutate(packing: Packing, rng: random.Random) -> Packing:
    """Dissolve the emptiest sequence and some that aren't full; place their pieces anew."""
    emptiest = min(range(len(packing.bins)), key=packing.fill.__getitem__)
    loose = [k for k, filled in enumerate(packing.fill) if filled < packing.capacity]
    gone = {emptiest, *rng.sample(loose, min(len(loose), rng.randint(2, 40)))}
    child = Packing(packing.lengths, packing.capacity)
    child.copy_of([m for k, m in enumerate(packing.bins) if k not in gone])
    refill(child, [p for k in sorted(gone) for p in packing.bins[k]], rng)
    return child


def evolve(lengths, capacity, elites, seed, generations=GENERATIONS, population=POPULATION) -> Packing:
    """One epoch of one island; `elites` are packings from the epoch before, its own and migrated."""
    rng, bound = random.Random(seed), -(-sum(lengths) // capacity)
    people = []
    for bins in elites:
        person = Packing(lengths, capacity)
        person.copy_of(bins)
        people.append(person)
    if not people:
        people.append(Packing(lengths, capacity))
        people[0].best_fit(list(range(len(lengths))))
        if len(people[0].bins) > bound:
            people.append(Packing(lengths, capacity))
            people[1].complete(list(range(len(lengths))))
    best, idle = min(people, key=Packing.score), 0
    while len(people) < population and len(best.bins) > bound:
        people.append(mutate(rng.choice(people), rng))
    for _ in range(generations):
        best = min(people, key=Packing.score)
        if len(best.bins) <= bound or idle >= PATIENCE:
            break
        a, b = (min(rng.sample(people, min(2, len(people))), key=Packing.score) for _ in range(2))
        people.append(mutate(crossover(a, b, rng), rng))
        people.sort(key=Packing.score)
        del people[population:]
        idle = 0 if people[0].score() < best.score() else idle + 1
    return min(people, key=Packing.score)


def _epoch(capacity: int, epoch: int):
    """Evolve one island of one group; its rows carry the elite's sequence numbers.

    A row holds one piece with its place in each packing that the island knows: `own` and
    `migrated`, -1 before the first epoch.
    """

    def run(key, rows):
        rows = rows.sort_values(["length", "item"], ascending=[False, True], kind="stable").reset_index(drop=True)
        lengths, items = rows["length"].tolist(), rows["item"].tolist()
        elites = []
        for column in ("own", "migrated"):
            if rows[column].iloc[0] >= 0:
                members: dict[int, list[int]] = {}
                for k, number in enumerate(rows[column].tolist()):
                    members.setdefault(number, []).append(k)
                elites.append(list(members.values()))
        found = evolve(lengths, capacity, elites, f"{key[0]}-{key[1]}-{epoch}")
        number, name, offset, retry = ([0] * len(lengths) for _ in range(4))
        by_filling = sorted(range(len(found.bins)), key=lambda k: (found.fill[k], k))
        emptiest = set(by_filling[:-(-len(found.bins) // RETRY)])
        for n, members in enumerate(found.bins):
            at, smallest = 0, min(items[k] for k in members)
            for k in members:
                number[k], name[k], offset[k], retry[k] = n, smallest, at, n in emptiest
                at += lengths[k]
        return pd.DataFrame({
            "grp": rows["grp"], "island": rows["island"], "item": items, "length": lengths, "own": number,
            "sequence_id": name, "offset": offset, "retry": retry, "n_bins": len(found.bins),
            "uneven": float(-found.score()[1]),
        })

    return run


def pack_level(pieces: DataFrame, groups: int, capacity: int, level: int, islands: int, epochs: int) -> DataFrame:
    """(item, length, sequence_id, offset, retry): the best packing of each group's islands."""
    base = pieces.select(
        "item", "length", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(groups)).cast("int").alias("grp"),
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.lit(-1).alias("own"), F.lit(-1).alias("migrated"),
    )
    columns = (
        "grp int, island int, item bigint, length bigint, own int, sequence_id bigint, offset bigint, "
        "retry boolean, n_bins int, uneven double"
    )
    for epoch in range(epochs):
        out = stored(base.groupBy("grp", "island").applyInPandas(_epoch(capacity, epoch), columns))
        if epoch < epochs - 1:
            next_island = F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island")
            sent = out.select("grp", next_island, "item", F.col("own").alias("migrated"))
            base = out.select("grp", "island", "item", "length", "own").join(sent, ["grp", "island", "item"])
    scores = out.groupBy("grp", "island").agg(F.first("n_bins").alias("n"), (-F.first("uneven")).alias("u"))
    best = scores.groupBy("grp").agg(F.min(F.struct("n", "u", "island"))["island"].alias("island"))
    return out.join(best, ["grp", "island"]).select("item", "length", "sequence_id", "offset", "retry")


def place(
    pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, islands: int = ISLANDS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """(item, sequence_id, offset) for pieces (item, length): item is unique, length 1 to capacity.

    A sequence bears the number of its smallest item.
    """
    full = F.col("length") == capacity
    done = pieces.where(full).select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, level = pieces.where(~full).select("item", "length"), 0
    count, before = rest.count(), None
    while count:
        groups = -(-count // group_pieces)
        if before is not None:
            groups = max(1, min(groups, before // 2))
        packed = stored(pack_level(rest, groups, capacity, level, islands, epochs))
        closed = packed if groups == 1 else packed.where("NOT retry")
        done = done.unionByName(closed.select("item", "sequence_id", "offset"))
        if groups == 1:
            break
        rest = packed.where("retry").select("item", "length")
        count, before, level = rest.count(), groups, level + 1
    return done


def pack(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None,
    group_pieces: int = GROUP_PIECES, islands: int = ISLANDS, epochs: int = EPOCHS,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    raw = cut_pieces(docs, id_column, text, capacity, path)
    # Numbers for pieces: the partition and the place in it, fixed by the checkpoint.
    pieces = stored(raw.withColumn("item", F.monotonically_increasing_id()))
    placed = place(pieces.select("item", "length"), capacity, group_pieces, islands, epochs)
    joined = pieces.join(placed, "item")
    return joined.select(
        id_column, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def sequences(pieces: DataFrame, placed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(sequence_id, ids): the packed sequences, from `cut_pieces(with_ids=True)` and `pack`."""
    joined = placed.join(pieces.select(id_column, "piece", "ids"), [id_column, "piece"])
    parts = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
