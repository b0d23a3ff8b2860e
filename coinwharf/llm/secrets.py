"""Secrets in texts: fixed formats, and values in credential context that are costly to guess.

The base kinds are ``assign`` (a credential word, a sign and a value), ``access`` (access key
ids) and ``hex`` (long hexadecimal runs). The kind ``guess`` adds values that stand in a wider
credential context and would take at least ``least`` guesses (as a power of ten). Guesses are
those of the cheapest segmentation of the value into common words, dates, repeats, keyboard
walks and brute-force spans, found by dynamic programming over its end positions. After a sign the
guesses alone decide; after a blank (``is``, ``bearer``) the value must also have two kinds of
characters, as words of a sentence do not. A value partly held by base spans is added whole.

Defined cases: a null text is empty and has no spans; equal rows give equal results each; very
long values are segmented whole; an empty table gives no rows; other columns are ignored, and
``redacted`` keeps them.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coinwharf.llm.common import id_and_text, text_slices

LEAST_GUESSES = 10.0

# fixed values: the base patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code|key)?|pwd|(?:client[\x20_-]?|shared[\x20_-]?)?secret|(?:auth|access|refresh)?[\x20_-]?token"""
    r"""|(?:api|access|private|secret|signing|encryption)[\x20_-]?key|authorization|bearer|credentials?|login|pin[\x20_-]?code)"""
    r"""["'`]?(?:\x20{0,3}(?::=|=>|[:=])\x20{0,3}|(?P<prose>\x20is\x20|(?<=bearer)\x20))["'`]?(?P<value>[^\s"'`<>]{6,})""",
    re.ASCII | re.IGNORECASE,
)
#: A text without any of these has no credential context.
MARKS = ("pass", "secret", "token", "key", "pwd", "authorization", "bearer", "credential", "login", "pin")

# fixed values: words that guessers try first, in this order
WORDS = (
    "password pass admin welcome login master hello secret letmein dragon monkey shadow sunshine princess football baseball"
    " superman batman trustno iloveyou love angel ashley michael jordan hunter killer soccer hockey george charlie andrew thomas"
    " robert daniel jessica jennifer michelle computer internet test guest user root default change changeme example sample demo"
    " temp system server service database access token key your the and summer winter spring autumn january february march april"
    " may june july august september october november december monday tuesday wednesday thursday friday saturday sunday"
    " red blue green black white orange purple yellow silver gold star moon sun fire water earth cat dog horse tiger lion"
    " freedom money power magic secure security private public office company google apple amazon windows linux oracle"
    " here value string text none null true false todo insert replace placeholder redacted hidden enter"
).split()
RANK = {word: rank + 1 for rank, word in enumerate(WORDS)}
LONGEST = max(map(len, WORDS))
PLAIN = str.maketrans("4@3105$7!", "aaeiosst" + "i")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
DATE = re.compile(r"(?=((?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\2(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\3(?:19|20)\d\d))")
YEAR = re.compile(r"(?=((?:19|20)\d\d))")
#: Powers of ten: a date of two centuries, a year, one character by brute force, one more segment.
DATE_COST, YEAR_COST, CHAR_COST, SEGMENT_COST = math.log10(200 * 365), math.log10(200), 1.0, 0.3


def _neighbours() -> set[tuple[str, str]]:
    """Pairs of keys that touch on the keyboard, and pairs that follow in the alphabet or digits."""
    pairs = set()
    for y, row in enumerate(ROWS):
        for x, key in enumerate(row):
            for dy, dx in ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)):
                if 0 <= y + dy < len(ROWS) and 0 <= x + dx < len(ROWS[y + dy]):
                    pairs.add((key, ROWS[y + dy][x + dx]))
    for line in ("abcdefghijklmnopqrstuvwxyz", "0123456789"):
        pairs |= {*zip(line, line[1:]), *zip(line[1:], line)}
    return pairs


NEXT = _neighbours()


def _segments(value: str) -> Iterator[tuple[int, int, float]]:
    """Start, end and cost (power of ten of guesses) of every segment that is no brute force."""
    low = value.lower()
    plain = low.translate(PLAIN)
    for text, extra in ((low, 0.0), (plain, 0.3)) if plain != low else ((low, 0.0),):
        for start in range(len(text)):
            for end in range(start + 3, min(len(text), start + LONGEST) + 1):
                if rank := RANK.get(text[start:end]):
                    mixed = 0.0 if value[start:end] in (low[start:end], value[start:end].capitalize()) else 0.7
                    yield start, end, math.log10(rank + 1) + extra + mixed
    for pattern, cost in ((DATE, DATE_COST), (YEAR, YEAR_COST)):
        for found in pattern.finditer(value):
            yield found.start(1), found.end(1), cost
    start = 0
    for i in range(1, len(low) + 1):
        if i == len(low) or (low[i - 1], low[i]) not in NEXT:
            if i - start >= 3:
                yield start, i, math.log10(50 * (i - start)) + 0.2 * (i - start)
            start = i
    for unit in range(1, 9):
        start = 0
        for i in range(unit, len(value) + 1):
            if i == len(value) or value[i] != value[i - unit]:
                if i - start >= 2 * unit and i - start >= 3:
                    yield start, i, unit * CHAR_COST + math.log10((i - start) // unit + 1)
                start = i - unit + 1


def guesses(value: str) -> float:
    """The guesses for a value, as a power of ten: the cheapest way to cut it up."""
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, end, cost in _segments(value):
        ends.setdefault(end, []).append((start, cost))
    best = [0.0] + [math.inf] * len(value)  # of any segmentation that ends here
    brute = [math.inf] * (len(value) + 1)  # of those whose last segment is brute force
    for end in range(1, len(value) + 1):
        brute[end] = min(best[end - 1] + SEGMENT_COST, brute[end - 1]) + CHAR_COST
        best[end] = min([brute[end], *(best[start] + SEGMENT_COST + cost for start, cost in ends.get(end, ()))])
    return best[-1]


def _mixed(value: str) -> bool:
    """Whether a value has two kinds of characters, as words of a sentence do not."""
    letters = value.strip("-_.,;:!?()[]{}")
    return sum((any(c.islower() for c in letters[1:]), any(c.isupper() for c in letters[1:]), any(c.isdigit() for c in letters))) >= 2 or any(c in "#$%&*+=@^~|\\" for c in letters)


class _Cover:
    """Spans joined where they touch or overlap, so that one look-up tells what holds a value."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda s: s[1]):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def holds(self, start: int, end: int) -> bool:
        """Whether spans together hold all from start to end."""
        at = bisect_right(self.starts, start) - 1
        return at >= 0 and end <= self.ends[at]


KINDS = ("assign", "access", "hex", "guess")


def find_secrets(text: str, least: float = LEAST_GUESSES) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points, end exclusive) of all spans, by start, then kind."""
    low = text.lower()
    marked = any(mark in low for mark in MARKS)
    spans = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if marked:
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
        base = _Cover(spans)
        for m in CONTEXT.finditer(text):
            value = m["value"].rstrip(".,;:!?)]}")
            start, end = m.start("value"), m.start("value") + len(value)
            if len(value) >= 6 and not base.holds(start, end) and (not m["prose"] or _mixed(value)) and guesses(value) >= least:
                spans.append(("guess", start, end))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked(text: str, spans: list[tuple[str, int, int]], mask: str) -> str:
    """The text with every run of touching or overlapping spans replaced by ``mask``."""
    parts, at, until = [], 0, -1
    for _, start, end in spans:
        if start > until:
            parts += [text[at:start], mask]
        at = until = max(end, until)
    return "".join(parts) + text[at:]


_FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"


def _scan(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            found = [find_secrets(t, least) for t in texts]
            base = [[s for s in spans if s[0] != "guess"] for spans in found]
            count = lambda kind: pa.array([sum(s[0] == kind for s in spans) for spans in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").cast(pa.int64()),
                    *map(count, KINDS[:3]),
                    pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]),
                    pa.array([_joined(s) for s in found]),
                    count("guess"),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"],
            )

    return run


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_GUESSES) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, all spans and the count of guessed ones."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_scan(least), _FOUND)


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", least: float = LEAST_GUESSES, mask: str = "[SECRET]") -> DataFrame:
    """The documents, same columns, with secrets masked and ``length_col`` counted anew where
    something was masked. Null texts stay null."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text_col):
            new = [masked(t, spans, mask) if t and (spans := find_secrets(t, least)) else t for t in texts]
            yield batch.set_column(at, text_col, pa.array(new, pa.string()))

    out = docs.mapInArrow(run, docs.schema)
    if length_col and length_col in docs.columns:
        out = out.withColumn(length_col, F.char_length(text_col).cast(docs.schema[length_col].dataType))
    return out
