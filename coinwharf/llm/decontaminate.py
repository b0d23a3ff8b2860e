"""Benchmark passages in documents, by pigeonhole edit matching.

Items and texts are reduced to lower-case words with one blank between. An item of m characters
may have up to k = rate * m edits (a character put in, left out or replaced). It is cut into
k + 1 pieces; k edits leave one piece untouched, so all pieces are looked for at once, exactly
(Aho-Corasick). A hit is verified from the piece upwards: two neighbouring groups of pieces with
a joint budget of a + b + 1 cannot both exceed theirs (a and b), so a hit is dropped as soon as
the group around it exceeds its budget. The last group is the whole item; its distance is exact
(Myers' bit-parallel algorithm), and so are the bounds that are returned.

Items are the stated queries: they go out in blocks of bounded size, each block to all documents.

Defined cases: null and empty texts and items match nothing; an item shorter than ``SHORT``
after reduction matches whole words without edits only, and is no evidence that a document holds a
benchmark (``without_benchmark`` leaves it out); equal items are each reported; equal rows or ids
of documents are reported each; an empty table gives no rows; other columns are ignored. Where
an item occurs more than once in a text, the place with the fewest edits counts, then the first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame

from coinwharf.llm.common import id_and_text, text_slices, with_row_keys, without_ids

RATE = 0.1
#: Characters of an item from which a passage near to it, in the middle of a word too, is evidence.
SHORT = 20
#: Characters of items in one block, which a worker holds as one automaton.
BLOCK_CHARS = 1_000_000
MATCHES = "doc_id long, item_id long, edits int, start long, end long"

_WORD = re.compile(r"[^\W_]+")


def lower(text: str) -> str:
    """Lower case, code point by code point where the length would change."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(one if len(one := c.lower()) == 1 else c for c in text)


def reduced(text: str) -> str:
    return " ".join(_WORD.findall(lower(text)))


def letter_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_end(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Fewest edits between the pattern and any part of the text, and the first end of such a part."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, edits = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        more, less = minus | (full & ~(horizontal | plus)), plus & horizontal
        if more & top:
            edits += 1
        elif less & top:
            edits -= 1
            if edits < best:
                best, at = edits, j + 1
        more, less = more << 1 & full, less << 1 & full
        plus, minus = less | (full & ~(vertical | more)), more & vertical
    return best, at


class Item:
    """An item's pieces and, per piece, the groups around it from small to whole."""

    def __init__(self, item_id: int, pattern: str, rate: float):
        self.id, self.pattern = item_id, pattern
        self.short = len(pattern) < SHORT
        self.budget = 0 if self.short else min(int(len(pattern) * rate), len(pattern) - 1)
        n = self.budget + 1
        self.bounds = [len(pattern) * j // n for j in range(n + 1)]
        self.around: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        self._split(0, n)
        self.masks: dict[tuple[int, int], dict[str, int]] = {}

    def _split(self, low: int, high: int) -> None:
        if high - low > 1:
            middle = (low + high) // 2
            self._split(low, middle)
            self._split(middle, high)
            for piece in range(low, high):
                self.around[piece].append((self.bounds[low], self.bounds[high], high - low - 1))

    def pieces(self) -> list[str]:
        return [self.pattern[a:b] for a, b in zip(self.bounds, self.bounds[1:])]

    def _distance(self, a: int, b: int, text: str) -> tuple[int, int]:
        if (a, b) not in self.masks:
            self.masks[a, b] = letter_masks(self.pattern[a:b])
        return best_end(self.masks[a, b], b - a, text)

    def _near(self, piece: int, text: str, at: int) -> bool:
        """Whether the smallest group can hold: cut into budget + 1 parts, what the piece leaves
        of it has one part untouched nearby."""
        a, b, k = self.around[piece][0]
        start, end = self.bounds[piece], self.bounds[piece + 1]
        a, b = (end, b) if start == a else (a, start) if end == b else (a, b)
        around = text[max(0, at + a - start - k) : at + b - start + k]
        n = k + 1
        return any(self.pattern[a + (b - a) * j // n : a + (b - a) * (j + 1) // n] in around for j in range(n))

    def verify(self, piece: int, text: str, at: int) -> tuple[int, int, int] | None:
        """Edits, start and end of the item around a hit of a piece at ``at``, if within budget."""
        start = self.bounds[piece]
        if not self.budget:
            end = at + len(self.pattern)
            cut = self.short and (at and text[at - 1] != " " or end < len(text) and text[end] != " ")
            return None if cut else (0, at, end)
        if not self._near(piece, text, at):
            return None
        for a, b, k in self.around[piece]:
            low = max(0, at + a - start - k)
            edits, end = self._distance(a, b, text[low : at + b - start + k])
            if edits > k:
                return None
        end += low
        back = text[max(0, end - len(self.pattern) - self.budget) : end][::-1]
        _, length = best_end(letter_masks(self.pattern[::-1]), len(self.pattern), back)
        return edits, end - length, end


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [Item(i, p, rate) for i, p in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, item in enumerate(self.items):
            for piece, part in enumerate(item.pieces()):
                places.setdefault(part, []).append((number, piece))
        self.pieces = ahocorasick.Automaton()
        for part, found in places.items():
            self.pieces.add_word(part, (len(part), found))
        self.pieces.make_automaton()

    def matches(self, text: str) -> dict[int, tuple[int, int, int]]:
        """By item number: edits, start and end in the reduced text."""
        best: dict[int, tuple[int, int, int]] = {}
        known: set[tuple[int, int]] = set()  # an item and where it would begin, if verified there
        for last, (length, found) in self.pieces.iter(text):
            at = last + 1 - length
            for number, piece in found:
                item = self.items[number]
                origin = (number, at - item.bounds[piece])
                if number in best and (best[number][0] == 0 or origin in known):
                    continue
                if place := item.verify(piece, text, at):
                    known.add(origin)
                    if number not in best or place[:2] < best[number][:2]:
                        best[number] = place
        return best


def _offsets(text: str, low: int, high: int) -> tuple[int, int]:
    """Code points of the original text for a place in its reduced form."""
    at, start, end = 0, None, 0
    for found in _WORD.finditer(lower(text)):
        size = found.end() - found.start()
        if start is None and at + size > low:
            start = found.start() + max(0, low - at)
        if at < high:
            end = found.start() + min(size, high - at)
        else:
            break
        at += size + 1
    return start or 0, end


_MATCHERS: dict[str, Matcher] = {}


def _search(items, key: str, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MATCHERS:
            _MATCHERS.clear()
            _MATCHERS[key] = Matcher(items.value, rate)
        matcher = _MATCHERS[key]
        for batch, texts in text_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("id").to_pylist(), texts):
                for number, (edits, low, high) in matcher.matches(reduced(text)).items():
                    rows.append((doc_id, matcher.items[number].id, edits, *_offsets(text, low, high)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "edits", "start", "end"])

    return run


def _blocks(items: DataFrame, id_col: str, text_col: str, min_chars: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for row in id_and_text(items, id_col, text_col).toLocalIterator():
        pattern = reduced(row["text"])
        if len(pattern) >= min_chars:
            block.append((row["id"], pattern))
            size += len(pattern)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def benchmark_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", rate: float = RATE, min_chars: int = 1) -> DataFrame:
    """One row per document and item found in it: MATCHES. Offsets are code points of the text."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    found = []
    for number, block in enumerate(_blocks(items, item_id_col, item_text_col, min_chars)):
        sent = spark.sparkContext.broadcast(block)
        found.append(rows.mapInArrow(_search(sent, f"{spark.sparkContext.applicationId} {id(sent)} {number}", rate), MATCHES))
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], MATCHES)


def without_benchmark(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, all columns, that hold no item of ``SHORT`` characters or more, each row by
    itself whatever its id."""
    keyed, key = with_row_keys(docs)
    found = benchmark_matches(keyed, items, **{"min_chars": SHORT} | options | {"id_col": key}).select("doc_id")
    return without_ids(keyed, found, key).drop(key)
