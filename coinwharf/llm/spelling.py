"""Spelling variants: words one edit apart, found with k-d trees over letter-count vectors.

A word's vector counts its letters. One replaced letter moves it by an L1 distance of 2, one
inserted or deleted letter by 1. So the words near one of length L are among those of length L
within 2 and those of length L - 1 or L + 1 within 1: one k-d tree per length, searched once by the
words of its own length and once by those one letter longer. A tree splits its words where a
letter's count reaches a threshold; a node is left out of a search when its box (least and greatest
count of each letter) is farther away than the radius. What remains is verified letter by letter.

Counts are kept as bits, one for each threshold that a count has reached. The L1 distance of two
vectors is then the number of differing bits, and that to a box the number of bits that all its
words have and the query lacks, or the other way round. Rare letters share dimensions and counts end
at a greatest threshold, which can only make distances smaller, so no pair is lost.

Spark deals the work by the upper part of each tree, which is fitted on a sample of at most
``SAMPLE`` words, chosen by a hash. A word is stored in its leaf and sent as a query to all leaves
its radius reaches. Each leaf then builds the lower part of its tree and streams its queries. Leaves
that turn out larger than ``MAX_HOME`` words are dealt into parts, each of which gets the queries.

Defined cases: a null text has no words; a null id is written as nothing where ids enter a hash;
equal rows count each; very long texts count whole; an empty table gives no words; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coinwharf.session import staged

LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS, MIN_COUNT, SLIP = 5, 3, 97
#: Words the upper parts of the trees are fitted on; words of a leaf, as estimated from them; words
#: that a task keeps at a time; words of a node that is not split further.
SAMPLE, LEAF, MAX_HOME, BUCKET = 200_000, 64_000, 200_000, 48
#: Dimensions: a to z and this many shared ones for all other letters; thresholds of each.
OTHERS, THRESHOLDS = 6, 4
BITS = (26 + OTHERS) * THRESHOLDS
PAIRS_AT_ONCE = 1 << 22
HOME, SAME, LONGER = 0, 1, 2


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, slip: int | None = SLIP) -> DataFrame:
    """``word`` and ``n``: how often each word of at least some letters occurs in all texts.

    With ``slip``, one occurrence in about that many loses a letter, by a rule on the document's id
    and the word, which gives a text without errors known misspellings.
    """
    id_text = F.coalesce(docs[id_col].cast("string"), F.lit(""))
    lower = F.translate(docs[text_col], UPPER, LOWER)
    words = docs.select(id_text.alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(LETTERS), F.lit(0))).alias("word"))
    # deleting a letter leaves no word long enough of one that is too short
    words = words.where(F.length("word") >= min_letters)
    if slip:
        words = words.withColumn("hash", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        at = F.pmod("hash", F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
        words = words.select(F.when(F.pmod("hash", F.lit(slip)) == 0, cut).otherwise(F.col("word")).alias("word"))
    return words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


# -- letter-count vectors and trees over them ----------------------------------------------


def codes(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of letter numbers, all below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def vectors(letters: np.ndarray) -> np.ndarray:
    """Rows of two 64-bit numbers: for each dimension and threshold, whether the count reaches it."""
    dim = np.where(letters >= 128, 26 + letters % OTHERS, letters - ord("a")).astype(np.int64)
    rows = np.arange(len(letters))
    counts = np.zeros((len(letters), 26 + OTHERS), np.uint8)
    for column in range(letters.shape[1]):
        counts[rows, dim[:, column]] += 1
    bits = counts[:, :, None] > np.arange(THRESHOLDS)
    return np.packbits(bits.reshape(len(letters), BITS), axis=1, bitorder="little").view(np.uint64)


def _flags(points: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(points).view(np.uint8), axis=1, bitorder="little")


def _even_bit(flags: np.ndarray) -> int:
    """The bit that splits rows most evenly, or -1 if none does."""
    set_ = flags.sum(axis=0, dtype=np.int64)
    smaller = np.minimum(set_, len(flags) - set_)
    best = int(smaller.argmax())
    return best if smaller[best] else -1


def distance_to_box(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How far each query's counts are outside a box, in L1."""
    outside = np.bitwise_count(low & ~queries) + np.bitwise_count(queries & ~high)
    return outside.sum(axis=1)


@dataclass
class Node:
    """A box, and either two nodes or places of points."""

    low: np.ndarray
    high: np.ndarray
    children: tuple[Node, Node] | None = None
    places: np.ndarray | None = None


def grown(points: np.ndarray, bucket: int) -> Node:
    """A tree whose boxes are as tight as their points allow."""

    def node(places: np.ndarray, flags: np.ndarray) -> Node:
        mine = points[places]
        made = Node(np.bitwise_and.reduce(mine, axis=0), np.bitwise_or.reduce(mine, axis=0))
        bit = _even_bit(flags) if len(places) > bucket else -1
        if bit < 0:
            made.places = places
        else:
            set_ = flags[:, bit] == 1
            made.children = (node(places[~set_], flags[~set_]), node(places[set_], flags[set_]))
        return made

    return node(np.arange(len(points)), _flags(points))


def within(tree: Node, points: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) places of all pairs within a radius, some at a time."""
    waiting = [(tree, np.arange(len(queries)))]
    while waiting:
        node, asked = waiting.pop()
        asked = asked[distance_to_box(queries[asked], node.low, node.high) <= radius]
        if not len(asked):
            continue
        if node.children:
            waiting += [(child, asked) for child in node.children]
            continue
        mine = points[node.places]
        step = max(PAIRS_AT_ONCE // len(mine), 1)
        for start in range(0, len(asked), step):
            some = queries[asked[start : start + step]]
            apart = np.bitwise_count(some[:, 0, None] ^ mine[None, :, 0])
            apart += np.bitwise_count(some[:, 1, None] ^ mine[None, :, 1])
            q, p = np.nonzero(apart <= radius)
            yield asked[start + q], node.places[p]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ at exactly one place."""
    return (a != b).sum(axis=1) == 1


def one_deleted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether deleting one letter of the longer rows gives the shorter ones: some beginning is the
    same in place, and all after it one place on."""
    starts = np.logical_and.accumulate(longer[:, :-1] == shorter, axis=1)
    ends = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1)
    return starts.sum(axis=1) + ends.sum(axis=1) >= shorter.shape[1]


# -- the upper parts of the trees: who goes where -------------------------------------------


class Deal:
    """The leaves of each length's tree, from sampled words."""

    def __init__(self, words: list[str], share: float, leaf: int = LEAF):
        self.leaves: dict[int, tuple[np.ndarray, np.ndarray, list[int]]] = {}
        number = 0
        for length in sorted(set(map(len, words))):
            flags = _flags(vectors(codes([w for w in words if len(w) == length], length)))
            boxes: list[tuple[np.ndarray, np.ndarray]] = []
            waiting = [(flags, np.zeros(BITS, np.uint8), np.ones(BITS, np.uint8))]
            while waiting:
                flags, low, high = waiting.pop()
                bit = _even_bit(flags) if len(flags) / share > leaf else -1
                if bit < 0:
                    boxes.append((low, high))
                    continue
                first = bit - bit % THRESHOLDS
                more, fewer = low.copy(), high.copy()
                more[first : bit + 1] = 1
                fewer[bit : first + THRESHOLDS] = 0
                waiting += [(flags[flags[:, bit] == 1], more, high), (flags[flags[:, bit] == 0], low, fewer)]
            pack = lambda rows: np.packbits(np.array(rows), axis=1, bitorder="little").view(np.uint64)
            self.leaves[length] = pack([b[0] for b in boxes]), pack([b[1] for b in boxes]), list(range(number, number + len(boxes)))
            number += len(boxes)

    def reached(self, points: np.ndarray, length: int, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf of a length with the places of the points whose radius reaches it.

        A length of which no word was sampled has one leaf, numbered below zero.
        """
        if length not in self.leaves:
            yield -length, np.arange(len(points))
            return
        for low, high, number in zip(*self.leaves[length]):
            found = np.flatnonzero(distance_to_box(points, low, high) <= radius)
            if len(found):
                yield number, found


def _dealt(sent, parts: dict[int, int]):
    """Words to the leaf that stores them and to those that they are asked in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = sent.value
        for batch in batches:
            words = np.array(batch.column("word").to_pylist(), object)
            n, hashes = np.asarray(batch.column("n")), np.asarray(batch.column("hash"))
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                points = vectors(codes(words[mine].tolist(), int(length)))
                for role, of, radius in ((HOME, length, 0), (SAME, length, 2), (LONGER, length - 1, 1)):
                    for leaf, at in deal.reached(points, int(of), radius) if of > 0 else ():
                        rows, of_leaf = mine[at], parts.get(leaf, 1)
                        for part in [None] if role == HOME else range(of_leaf):
                            dealt = hashes[rows] % of_leaf if part is None else np.full(len(rows), part)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(rows), leaf, np.int32)), pa.array(dealt.astype(np.int32)), pa.array(np.full(len(rows), role, np.int32)), pa.array(words[rows].tolist(), pa.string()), pa.array(n[rows])],
                                ["leaf", "part", "role", "word", "n"],
                            )

    return run


DEALT = "leaf int, part int, role int, word string, n long"
EDGES = "word string, near string, near_n long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows with equal leaf, part, role and length, which the sort put together."""
    for batch in batches:
        keys = np.stack([*(np.asarray(batch.column(c)) for c in ("leaf", "part", "role")), np.asarray(pa.compute.utf8_length(batch.column("word")))], axis=1)
        starts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
        for start, end in zip(starts[:-1], starts[1:]):
            if end > start:
                yield tuple(keys[start].tolist()), batch.slice(start, end - start)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per leaf and part: the stored words, which come first, then the queries as they stream by."""
    place, words, counts, tree = None, [], [], None
    for (leaf, part, role, length), batch in _runs(batches):
        if place != (leaf, part):
            place, words, counts, tree = (leaf, part), [], [], None
        if role == HOME:
            words += batch.column("word").to_pylist()
            counts.append(np.asarray(batch.column("n")))
            continue
        if not words:
            continue
        if tree is None:
            home, home_n, names = codes(words, len(words[0])), np.concatenate(counts), np.array(words, object)
            points = vectors(home)
            tree = grown(points, BUCKET)
        asked, asked_n = batch.column("word").to_pylist(), np.asarray(batch.column("n"))
        letters, asked = codes(asked, length), np.array(asked, object)
        test = one_replaced if role == SAME else one_deleted
        for q, p in within(tree, points, vectors(letters), 2 if role == SAME else 1):
            near = test(letters[q], home[p])
            q, p = q[near], p[near]
            if not len(q):
                continue
            yield _edges(asked[q], names[p], home_n[p])
            if role == LONGER:
                yield _edges(names[p], asked[q], asked_n[q])


def _edges(words: np.ndarray, near: np.ndarray, near_n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words.tolist(), pa.string()), pa.array(near.tolist(), pa.string()), pa.array(near_n)], ["word", "near", "near_n"])


def near_words(counts: DataFrame, sample: int = SAMPLE, leaf: int = LEAF, max_home: int = MAX_HOME) -> DataFrame:
    """``word``, ``near``, ``near_n``: every ordered pair of words exactly one edit apart.

    ``counts`` has distinct words (``word``, of the letters a to z and U+00C0 to U+00FF) and ``n``.
    """
    spark = counts.sparkSession
    words = counts.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 40)).alias("hash"))
    share = min(1.0, sample / max(counts.count(), 1))
    sampled = words.where(F.col("hash") < int(share * (1 << 40))).select("word").toArrow()  # about ``sample`` rows
    deal = spark.sparkContext.broadcast(Deal(sampled.column("word").to_pylist(), share, leaf))
    homes = lambda parts: words.mapInArrow(_dealt(deal, parts), DEALT)
    stored = staged(homes({}), "dealt")
    # more than max_home words in one leaf are rare: the sample missed them, or they are anagrams
    large = stored.where(F.col("role") == HOME).groupBy("leaf").count().where(F.col("count") > max_home).collect()
    if large:
        stored = staged(homes({r["leaf"]: -(-r["count"] // max_home) for r in large}), "dealt")
    ordered = stored.repartition("leaf", "part").sortWithinPartitions("leaf", "part", "role")
    return ordered.mapInArrow(_searched, EDGES)


# -- forms and roots ---------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the end of each word's chain of forms.

    Each step of a chain at least doubles the count, so chains are short; each round doubles the
    steps that a word has looked ahead.
    """
    ahead = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not ahead.where("moved").isEmpty():
        next_ = ahead.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = ahead.join(next_, ahead["root"] == next_["at"], "left")
        ahead = staged(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
    return ahead.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int | None = SLIP, **sizes: int) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    The form is the near word that occurs most (of equals the first in code-point order), if at
    least twice as often as the word; the root is the last of the chain of forms.
    """
    counts = staged(word_counts(docs, id_col, text_col, slip=slip), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(counts, **sizes).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = counts.join(near, "word", "left")
    is_form = -F.col("best.less") >= 2 * F.col("n")
    variants = staged(
        found.select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(variants.where("form is not null").select("word", "form"))
    return variants.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
