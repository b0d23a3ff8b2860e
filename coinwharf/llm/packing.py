"""Best-fit packing by a grouping genetic algorithm on islands.

Texts are encoded and cut into pieces of at most ``capacity`` tokens; pieces are then packed
into as few sequences as can be found. A piece of full length is a sequence of its own. The
others are dealt into blocks of about BLOCK pieces, sorted by length and in turn, so that all blocks
hold like lengths; on every block ISLANDS islands breed solutions. A solution is a set of bins (sequences). Crossover injects the well-filled bins
of one parent into the other, removes bins of the other that hold a piece twice, and best-fits
the displaced pieces. After each epoch the best solution of each island migrates to the next
island of its block. An island stops once it needs no more bins than its tokens fill. Bins that
are not nearly full are taken apart in the end and packed again, in rounds over ever fewer blocks,
until one block is left; where that is nearly all of them, only the emptier half of the bins goes
on to the next round. All steps are groups of bounded size; random choices are seeded by block,
island and epoch, so a lost task repeats its result.

Defined cases: a null or empty text is one piece with the end id only; repeated rows and equal
ids stay separate pieces; a null id stays null; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coinwharf.llm.common import id_and_text, slices
from coinwharf.llm.tokens import encoder
from coinwharf.session import staged

BLOCK, ISLANDS, EPOCHS, PARENTS, GENERATIONS = 1024, 2, 2, 4, 5
#: Bins at least this full stay as they are when a round ends.
GOOD_FILL = 0.998
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, end_id: int, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc_ids = batch.column("id").to_pylist()
            doc, piece, start, length, crc, ids = [], [], [], [], [], []
            for doc_id, found in zip(doc_ids, encoder(path, True).encode(batch.column("text"))):
                whole = np.append(found, np.uint32(end_id)).astype("<u4")
                at, end = 0, (len(whole) - 1) % capacity + 1
                number = 0
                while at < len(whole):
                    doc.append(doc_id)
                    piece.append(number)
                    start.append(at)
                    length.append(end - at)
                    crc.append(zlib.crc32(whole[at:end]))
                    if keep_ids:
                        ids.append(whole[at:end].view("<i4"))
                    at, end, number = end, end + capacity, number + 1
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def cut_texts(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece of each whole text: PIECES, and the ids themselves if asked for.

    The ids of a text and ``end_id`` after them are cut so that all pieces but the first have
    ``capacity`` ids.
    """
    schema = PIECES + (", ids array<int>" if keep_ids else "")
    return id_and_text(docs, id_col, text_col).mapInArrow(_cut(tokenizer, end_id, capacity, keep_ids), schema)


class Bins:
    """Bins of pieces and their free room, with the best fit found by one bit operation."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.members: dict[int, list[int]] = {}
        self.room: dict[int, int] = {}
        self.by_room: dict[int, set[int]] = {}
        self.rooms = 0  # bit r is set while a bin has room r
        self.next = 0

    def _place(self, bin_: int, room: int) -> None:
        self.room[bin_] = room
        self.by_room.setdefault(room, set()).add(bin_)
        self.rooms |= 1 << room

    def _lift(self, bin_: int) -> int:
        room = self.room.pop(bin_)
        same = self.by_room[room]
        same.remove(bin_)
        if not same:
            self.rooms &= ~(1 << room)
        return room

    def add(self, members: list[int]) -> None:
        self.members[self.next] = members
        self._place(self.next, self.capacity - sum(self.sizes[i] for i in members))
        self.next += 1

    def drop(self, bin_: int) -> list[int]:
        self._lift(bin_)
        return self.members.pop(bin_)

    def best_fit(self, pieces: list[int]) -> None:
        """Each piece, in the order given, into the fullest bin that still takes it."""
        for i in pieces:
            size = self.sizes[i]
            fits = self.rooms >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                bin_ = min(self.by_room[room])
                self._lift(bin_)
                self.members[bin_].append(i)
                self._place(bin_, room - size)
            else:
                self.add([i])

    def solution(self) -> list[list[int]]:
        return [self.members[b] for b in sorted(self.members)]


def score(bins: list[list[int]], sizes: list[int], capacity: int) -> float:
    """Mean squared fill: fewer and fuller bins are better."""
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(len(bins), 1)


def _packed(sizes: list[int], capacity: int, order: list[int]) -> list[list[int]]:
    bins = Bins(sizes, capacity)
    bins.best_fit(order)
    return bins.solution()


def _child(one: list[list[int]], two: list[list[int]], sizes: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Injects well-filled bins of ``two`` into ``one`` and best-fits what they displace."""
    fill = sorted(two, key=lambda b: -sum(sizes[i] for i in b))
    injected = [b for b in fill[: max(1, len(fill) // 2)] if rng.random() < 0.6] or fill[:1]
    taken = {i for b in injected for i in b}
    bins, displaced = Bins(sizes, capacity), []
    for b in injected:
        bins.add(list(b))
    for b in one:
        if taken.isdisjoint(b) and rng.random() > 0.02:  # now and then a sound bin is opened too
            bins.add(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    displaced.sort(key=lambda i: -sizes[i])
    bins.best_fit(displaced)
    return bins.solution()


def solved(bins: list[list[int]], sizes: list[int], capacity: int) -> bool:
    """Whether more breeding is in vain, as no fewer bins can hold the tokens."""
    return sum(capacity - sum(sizes[i] for i in b) for b in bins) < capacity


def evolve(sizes: list[int], capacity: int, seeds: list[list[list[int]]], rng: random.Random) -> list[list[int]]:
    """The best solution an island finds, from the solutions that it starts with and its own."""
    falling = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    island = list(seeds) or [_packed(sizes, capacity, falling)]
    best = min(island, key=lambda s: (len(s), -score(s, sizes, capacity)))
    if solved(best, sizes, capacity):
        return best
    while len(island) < PARENTS:
        noisy = sorted(range(len(sizes)), key=lambda i: -sizes[i] * rng.uniform(0.7, 1.3))
        island.append(_packed(sizes, capacity, noisy))
    for _ in range(GENERATIONS):
        for _ in range(PARENTS):
            one, two = rng.sample(island, 2)
            island.append(_child(one, two, sizes, capacity, rng))
        island.sort(key=lambda s: (len(s), -score(s, sizes, capacity)))
        island = island[:PARENTS]
        if solved(island[0], sizes, capacity):
            break
    return island[0]


def _island(capacity: int, epoch: int):
    """One epoch of one island: ``own`` and ``guest`` hold the bin of each piece in its own best
    solution and in its neighbour's, null before the first epoch."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid").reset_index(drop=True)
        block, island = int(rows["block"].iloc[0]), int(rows["island"].iloc[0])
        sizes = rows["length"].tolist()
        seeds = []
        for column in ("own", "guest"):
            if rows[column].notna().all():
                bins: dict[int, list[int]] = {}
                for i, b in enumerate(rows[column].astype("int64").tolist()):
                    bins.setdefault(b, []).append(i)
                seeds.append(list(bins.values()))
        best = evolve(sizes, capacity, seeds, random.Random(f"{block} {island} {epoch}"))
        bin_, offset, fill = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for number, members in enumerate(best):
            at = 0
            for i in members:
                bin_[i], offset[i] = number, at
                at += sizes[i]
            fill[members] = at
        return pd.DataFrame(
            {"uid": rows["uid"], "length": rows["length"], "block": block, "island": island, "bin": bin_, "offset": offset, "fill": fill, "bins": len(best), "done": solved(best, sizes, capacity)}
        )

    return run


_SOLVED = "uid long, length long, block long, island int, bin long, offset long, fill long, bins long, done boolean"


def _dealt(pieces: DataFrame, blocks: int) -> DataFrame:
    """The pieces with a ``block``: sorted by length in each partition and dealt in turn, each
    partition from another block on."""
    turn = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(blocks))
    return pieces.sortWithinPartitions("length", "uid").select("uid", "length", ((turn + first) % blocks).alias("block"))


def _solve(pieces: DataFrame, capacity: int, blocks: int) -> DataFrame:
    """The best island's solution of every block, for written pieces ``uid``, ``length``."""
    dealt = _dealt(pieces, blocks)
    state = dealt.select("*", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.lit(None).cast("long").alias("own"), F.lit(None).cast("long").alias("guest"))
    for epoch in range(EPOCHS):
        found = staged(state.groupBy("block", "island").applyInPandas(_island(capacity, epoch), _SOLVED), "islands")
        if epoch + 1 == EPOCHS or found.where(~F.col("done")).isEmpty():
            break
        home = found.select("uid", "length", "block", "island", F.col("bin").alias("own"))
        guests = found.select("uid", "block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("bin").alias("guest"))
        state = home.join(guests, ["block", "island", "uid"])
    best = found.groupBy("block", "island").agg(F.min("bins").alias("bins")).groupBy("block").agg(F.min_by("island", F.struct("bins", "island")).alias("island"))
    return found.join(best, ["block", "island"], "left_semi").select("uid", "length", "block", "bin", "offset", "fill")


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs a ``length`` of 1 to ``capacity``."""
    pieces = staged(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity).select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = pieces.where(F.col("length") < capacity).select("uid", "length")
    placed, turn = [full], 0
    count = left.count()
    while count:
        blocks = max(1, -(-count // BLOCK))
        found = _solve(left, capacity, blocks)
        last = blocks == 1
        number = (F.lit(turn).cast("long") * (1 << 56)) + F.col("block") * (1 << 20) + F.col("bin")
        if last:
            placed.append(found.select("uid", number.alias("sequence_id"), "offset"))
            break
        found = staged(found, "solved")
        sound = F.col("fill") >= int(capacity * GOOD_FILL)
        open_bins = found.where(~sound)
        fewer = open_bins.count()
        if fewer > 0.9 * count:  # nearly nothing packs well: the fuller half of the bins stays, so that rounds end
            fills = open_bins.where(F.col("offset") == 0).agg(F.expr(f"percentile_approx(fill, 0.5, {capacity})"))
            sound = F.col("fill") >= fills.first()[0]
            fewer = found.where(~sound).count()
        placed.append(found.where(sound).select("uid", number.alias("sequence_id"), "offset"))
        left, count, turn = found.where(~sound).select("uid", "length"), fewer, turn + 1
    places = placed[0]
    for more in placed[1:]:
        places = places.unionByName(more)
    return pieces.join(places, "uid").drop("uid")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and the packed ``ids`` of each sequence, for pieces that kept their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
