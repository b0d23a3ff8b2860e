"""SimHash near copies by Golay-code fuzzy hashing.

A fingerprint has 64 bits; bit b is set if it is set in over half of the hashes of the text's
word shingles. Fingerprints that differ in at most 3 bits are linked, and documents whose
fingerprints hang together form a group.

Candidates: the fingerprint is cut into three segments of 23, 23 and 18 bits. Three errors over
three segments leave two segments with at most one error each. A segment decodes to the index of
the nearest Golay codeword; after one error it decodes to one of up to six indices, which are
known beforehand. So every fingerprint is stored under its own index pair for each two segments
and looked up under all near index pairs; every link within 3 bits is met. Candidates are then
verified by counting bits.

Equal fingerprints are merged before anything else, so exact copies cost one row. A key under
which many fingerprints are stored is split into blocks, which are compared in one go each and
give a spanning set of links instead of all pairs.

Defined cases: a null or empty text has fingerprint zero, linked like any other; rows that
share an id take part one by one and get the smallest id of their group; a null id counts as
no id and its row gets the smallest id of the others (null if none has one); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from coinwharf.llm import golay
from coinwharf.llm.common import hot_values, id_and_text, slices, with_row_keys, without_ids
from coinwharf.llm.components import components
from coinwharf.session import staged

SEGMENTS = ((0, 23), (23, 23), (46, 18))  # lowest bit, bits
MAX_BITS = 3
#: More fingerprints than this under one key are compared in blocks of this many.
HOT_KEY, BLOCK = 32, 2048


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """The fingerprint of a UTF-8 text, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id`` and ``fp`` (64 bits as a signed long) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), pa.array(found)], ["id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "id long, fp long")


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    bits = fps.view(np.uint64)
    return [((bits >> np.uint64(low)) & np.uint64((1 << n) - 1)).astype(np.int64) for low, n in SEGMENTS]


def _pair_key(pair: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return pair << 24 | first << 12 | second


def _stored_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.asarray(batch.column("fp"))
        own = [golay.own_index(s) for s in _segments(fps)]
        for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
            yield pa.RecordBatch.from_arrays([pa.array(_pair_key(pair, own[i], own[j])), pa.array(fps)], ["key", "fp"])


def _lookup_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.asarray(batch.column("fp"))
        near = [golay.near_indices(s) for s in _segments(fps)]
        for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
            (a, na), (b, nb) = near[i], near[j]
            for x in range(a.shape[1]):
                for y in range(b.shape[1]):
                    at = np.flatnonzero((na > x) & (nb > y))
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(_pair_key(pair, a[at, x], b[at, y])), pa.array(fps[at])], ["key", "fp"])


def _link_block(block: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of the fingerprints of one block that are near a looked-up one."""
    fps = np.unique(block["fp"].to_numpy())
    asked = np.unique(block.loc[block["asked"], "fp"].to_numpy())
    stored = np.unique(block.loc[~block["asked"], "fp"].to_numpy())
    near = np.bitwise_count(asked.view(np.uint64)[:, None] ^ stored.view(np.uint64)[None, :]) <= MAX_BITS
    q, s = np.searchsorted(fps, asked), np.searchsorted(fps, stored)
    label = np.arange(len(fps))
    none = len(fps)
    while True:
        old = label.copy()
        label[q] = np.minimum(label[q], np.where(near, label[s][None, :], none).min(axis=1, initial=none))
        label[s] = np.minimum(label[s], np.where(near, label[q][:, None], none).min(axis=0, initial=none))
        label = np.minimum(label, label[label])
        if (label == old).all():
            break
    off = label != np.arange(len(fps))
    return pd.DataFrame({"a": fps[label[off]], "b": fps[off]})


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a``, ``b`` between different fingerprints, enough to join all that are within
    ``max_bits`` bits. ``prints`` holds each fingerprint once, in column ``fp``."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"links of more than {MAX_BITS} bits are not met by these keys")
    within = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    stored = prints.mapInArrow(_stored_keys, "key long, fp long")
    lookup = prints.mapInArrow(_lookup_keys, "key long, fp long")
    crowds = staged(stored.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_KEY), "crowds")
    crowded = not crowds.isEmpty()
    single = stored.join(crowds, "key", "left_anti") if crowded else stored
    links = (
        lookup.withColumnRenamed("fp", "a").join(single.withColumnRenamed("fp", "b"), "key").where("a <> b").where(within).select("a", "b")
    )
    if not crowded:
        return links
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    asked = staged(lookup.join(crowds, "key"), "asked")
    sizes = asked.groupBy("key").agg(F.count("*").alias("m"))
    place = lambda n: F.pmod(F.xxhash64("fp"), F.col(n).cast("long")).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sized = lambda rows: rows.join(crowds.join(sizes, "key").select("key", blocks("n").alias("across"), blocks("m").alias("down")), "key")
    left = sized(asked.select("key", "fp")).select("key", "fp", F.lit(True).alias("asked"), place("down").alias("row"), spread("across").alias("column"))
    right = sized(stored).select("key", "fp", F.lit(False).alias("asked"), spread("down").alias("row"), place("across").alias("column"))
    dense = left.unionByName(right).groupBy("key", "row", "column").applyInPandas(_link_block, "a long, b long")
    return links.union(dense)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """``id``, ``fp`` and ``group`` (the smallest id of the row's group) for every row."""
    rows = staged(fingerprints(docs, id_col, text_col, shingle), "prints")
    prints = staged(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = components(near_links(prints, max_bits))
    placed = prints.join(roots, prints["fp"] == roots["node"]).select("fp", "root", "first")
    groups = staged(placed.groupBy("root").agg(F.min("first").alias("group")).join(placed.select("fp", "root"), "root").select("fp", "group"), "groups")
    every = staged(prints.join(groups, "fp", "left").select("fp", F.coalesce("group", "first").alias("group")), "every")
    # a fingerprint with very many rows is one of at most 1000: these are joined by broadcast
    hot = staged(hot_values(rows, "fp"), "hot")
    wide = rows.join(F.broadcast(hot.join(every, "fp")), "fp")
    rest = rows.join(F.broadcast(hot), "fp", "left_anti").join(every, "fp")
    return wide.union(rest).select("id", "fp", "group")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One row, all columns, of each group: the one with its smallest id, of several the first
    written. A row without an id stays only where no row of its group has one."""
    keyed, key = with_row_keys(docs)
    groups = near_groups(keyed, key, text_col, shingle, max_bits).select("id", "group")
    named = keyed.select(F.col(key).alias("row"), F.col(id_col).alias("name"))
    order = F.struct(F.col("name").isNull().alias("unnamed"), "name", "id")
    members = staged(groups.join(named, groups["id"] == named["row"]).select("id", "group", order.alias("place")), "members")
    first = members.groupBy("group").agg(F.min("place")["id"].alias("first")).select("first")
    gone = members.select("id").join(first, members["id"] == first["first"], "left_anti")
    return without_ids(keyed, gone, key).drop(key)
