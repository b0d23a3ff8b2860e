"""Tokens of two tokenizers linked by the bytes they stand for.

Each tokenizer gives a matrix with a row per token and a column per byte of the text, one where the
token holds the byte, stored as compressed sparse rows (``Csr``). The product A·Bᵀ, formed row by row
as Gustavson does (row i is the sum of the rows of Bᵀ that row i of A names), has the tokens that
share a byte: the overlap links. As tokens follow each other, an A token whose first partner comes
after all partners of the token before it begins a new group: there both tokenizers end a token.
The matrices of token ids by groups, multiplied in the same way, have the shared-group links: for
each pair of ids, how many pairs of their occurrences lie in one group. No pair of occurrences is
ever written out, so a long group costs its different ids, not its tokens squared.

Both tokenizers cut a text before a single blank or line feed between other letters, and before a
full stop or comma between a letter and one of these (A by its pattern, B as none of its pieces has
a letter before them, which is checked), so texts are taken apart there and each distinct chunk is
aligned once. A text of which a chunk does not come
back byte by byte is aligned as a whole; if it does not come back either, it has no tokens.

How many documents hold a pair of ids is counted over the corpus. Documents are worked on in blocks
that each keep a dictionary of their pairs; only dictionaries are shuffled to be counted, so a pair
that is in every document is one row per block. The counts go back to the blocks the same way.

Defined cases: null and empty texts have no tokens; equal rows and ids count as documents of their
own; strings of special tokens are plain text; very long texts are aligned whole; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from coinwharf.llm.bpe import byte_letters
from coinwharf.llm.common import id_and_text, text_slices
from coinwharf.session import staged

#: Ids of B fit into this many bits of a pair's key.
B_BITS = 20
#: Products that are formed at a time; chunks, pairs and letters a worker remembers; pairs of a block;
#: pairs of a dictionary row.
EXPANDED, MAX_CHUNKS, MAX_KEPT, BLOCK_PAIRS, DICTIONARY_ROW = 1 << 20, 300_000, 1 << 24, 2_000_000, 100_000
#: Chunks that are aligned together, and that are encoded as one line.
TOGETHER, LINE = 20_000, 500
#: A chunk that can stand in a line: a blank, then none.
PLAIN = re.compile(r" [^\s▁\0\x1c-\x1f]+")
#: Letters after which a full stop or comma is cut off.
LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"
STOPS = re.compile(LETTER + "[.,]")
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Texts with other than single blanks and line feeds between words.
ODD = re.compile("[ \\n]{2}|[\\0\\t\\x0b-\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]|^[ \\n]|[ \\n]\\Z")


@dataclass
class Csr:
    """A sparse matrix of whole numbers: row i has ``columns[starts[i]:starts[i + 1]]``, in order."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @staticmethod
    def of(rows: np.ndarray, columns: np.ndarray, height: int, width: int, values: np.ndarray | None = None) -> Csr:
        """From entries in any order; entries of one place are added."""
        values = np.ones(len(rows), np.int64) if values is None else values
        places = rows * width + columns
        order = np.argsort(places, kind="stable")
        places, values = places[order], values[order]
        first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1]))) if len(places) else np.empty(0, np.int64)
        places, values = places[first], np.add.reduceat(values, first) if len(first) else values
        starts = np.concatenate(([0], np.cumsum(np.bincount(places // width, minlength=height))))
        return Csr(starts, places % width, values, width)

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.height), np.diff(self.starts))

    def transposed(self) -> Csr:
        return Csr.of(self.columns, self.rows(), self.width, self.height, self.values)

    def times(self, other: Csr) -> Csr:
        """The product, by rows: row i adds up the rows of ``other`` that this row i names, each times
        its value there. Some rows are done at a time, so that few products wait to be added."""
        sizes = np.diff(other.starts)[self.columns]
        before = np.concatenate(([0], np.cumsum(sizes)))
        done = before[self.starts]
        parts, row = [], 0
        while row < self.height:
            end = max(row + 1, int(np.searchsorted(done, done[row] + EXPANDED, "right")) - 1)
            a, b = self.starts[row], self.starts[end]
            size = sizes[a:b]
            at = np.repeat(other.starts[self.columns[a:b]] - (before[a:b] - before[a]), size) + np.arange(before[b] - before[a])
            of_row = np.repeat(np.repeat(np.arange(end - row), np.diff(self.starts[row : end + 1])), size)
            parts.append(Csr.of(of_row, other.columns[at], end - row, other.width, np.repeat(self.values[a:b], size) * other.values[at]))
            row = end
        if not parts:
            return Csr(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), other.width)
        ends = np.cumsum([0, *(len(p.columns) for p in parts)])
        starts = np.concatenate([[0], *(p.starts[1:] + e for p, e in zip(parts, ends))])
        return Csr(starts, np.concatenate([p.columns for p in parts]), np.concatenate([p.values for p in parts]), other.width)


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens by bytes: each token holds the ``lengths`` bytes after those before it."""
    size = int(lengths.sum())
    starts = np.concatenate(([0], np.cumsum(lengths)))
    return Csr(starts, np.arange(size), np.ones(size, np.int64), size)


def groups(overlap: Csr, count_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A token and of each B token, from the overlap links."""
    first, last = overlap.columns[overlap.starts[:-1]], overlap.columns[overlap.starts[1:] - 1]
    of_a = np.concatenate(([0], np.cumsum(first[1:] > last[:-1]))) if len(first) else first
    of_b = np.zeros(count_b, np.int64)
    of_b[overlap.columns] = of_a[overlap.rows()]
    return of_a, of_b


class Tokenizers:
    """The two tokenizers of files A (tokenizers library) and B (sentencepiece), and their tokens' bytes."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(map(byte_of.__getitem__, token))
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            plain = b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace("▁", " ").encode()
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else plain)
        self.blank_b, self.feed_b = self.b.piece_to_id("▁"), self.b.encode("\n")
        if any("▁" in p.lstrip("▁") or "\n" in p or STOPS.search(p) for p in map(self.b.id_to_piece, range(len(self.bytes_b)))):
            raise ValueError("the pieces of B must end where words and clauses do")
        self.lengths_a, self.lengths_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        self.begins_a, self.begins_b = (np.array([t.startswith(b" ") for t in side]) for side in (self.bytes_a, self.bytes_b))
        # ids as they are written, before another one of the group and at its end
        self.written_a, self.written_b = (np.array([f"{i}{c}" for i in range(n) for c in f",{end}"], object) for n, end in ((len(self.bytes_a), "|"), (len(self.bytes_b), ";")))

    def _one_by_one(self, pieces: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of pieces. B puts a blank before a text: it stands for the piece's own, or is
        dropped, where need be with a line feed that keeps it apart."""
        of_a = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        of_b = self.b.encode([p[1:] if p[0] == " " else p if p[0] == "\n" else "\n" + p for p in pieces], num_threads=1)
        for piece, a, b in zip(pieces, of_a, of_b):
            extra = [] if piece[0] == " " else [self.blank_b] if piece[0] == "\n" else self.feed_b
            yield a, b[len(extra) :] if b[: len(extra)] == extra else []

    def _come_back(self, text: str, of_a: Sequence[int], of_b: Sequence[int]) -> bool:
        encoded = text.encode()
        return b"".join(map(self.bytes_a.__getitem__, of_a)) == encoded == b"".join(map(self.bytes_b.__getitem__, of_b))

    def encode(self, pieces: list[str]) -> tuple[list[str], list[np.ndarray]]:
        """Those pieces that come back byte by byte, and the ids of A, how many each piece has, and
        the same of B. Plain ones are encoded many in a line, in which blanks show where each begins."""
        plain = [p for p in pieces if PLAIN.fullmatch(p)]
        single = [p for p in pieces if not PLAIN.fullmatch(p)]
        kept: list[str] = []
        parts: list[list[np.ndarray]] = [[], [], [], []]
        lines = [plain[i : i + LINE] for i in range(0, len(plain), LINE)]
        texts = ["".join(line) for line in lines]
        lines_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        for line, text, a, b in zip(lines, texts, lines_a, self.b.encode([t[1:] for t in texts], num_threads=1)):
            ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
            starts = [np.flatnonzero(begins[ids]) for begins, ids in ((self.begins_a, ids_a), (self.begins_b, ids_b))]
            if not len(starts[0]) == len(starts[1]) == len(line) or not self._come_back(text, a, b):
                single += line
                continue
            kept += line
            for part, value in zip(parts, (ids_a, np.diff(starts[0], append=len(a)), ids_b, np.diff(starts[1], append=len(b)))):
                part.append(value)
        for piece, (a, b) in zip(single, self._one_by_one(single) if single else ()):
            if self._come_back(piece, a, b):
                kept.append(piece)
                for part, value in zip(parts, (a, [len(a)], b, [len(b)])):
                    part.append(np.array(value, np.int64))
        return kept, [np.concatenate([np.empty(0, np.int64), *part]) for part in parts]


@dataclass
class Aligned:
    """Pieces of text, each with its tokens, groups and links."""

    counts: np.ndarray  # per piece: A tokens, B tokens, groups, links
    written: list[str]  # per piece: a1,a2|b1;a3|b2,b3
    pairs: Csr  # per piece: links of each pair of ids, by the pair's key


def align(tokenizers: Tokenizers, ids_a: np.ndarray, sizes_a: np.ndarray, ids_b: np.ndarray, sizes_b: np.ndarray) -> Aligned:
    """Groups and links of pieces (one at least) whose tokens come back byte by byte."""
    pieces = len(sizes_a)
    piece_a = np.repeat(np.arange(pieces), sizes_a)
    holds_a, holds_b = incidence(tokenizers.lengths_a[ids_a]), incidence(tokenizers.lengths_b[ids_b])
    group_a, group_b = groups(holds_a.times(holds_b.transposed()), len(ids_b))
    n_groups = int(group_a[-1]) + 1

    # rows: the different A ids of each piece; columns: groups. The other way round for B.
    row_keys, rows = np.unique(piece_a * len(tokenizers.bytes_a) + ids_a, return_inverse=True)
    by_group = Csr.of(group_b, ids_b, n_groups, len(tokenizers.bytes_b))
    links = Csr.of(rows, group_a, len(row_keys), n_groups).times(by_group)
    of_piece, a = row_keys // len(tokenizers.bytes_a), row_keys % len(tokenizers.bytes_a)
    starts = links.starts[np.searchsorted(of_piece, np.arange(pieces + 1))]
    pairs = Csr(starts, (a[links.rows()] << B_BITS) | links.columns, links.values, 1 << 40)

    # each piece ends a group, so groups belong to one piece
    ends = np.cumsum(sizes_a)
    firsts = group_a[ends - sizes_a]
    products = np.bincount(group_a, minlength=n_groups) * np.bincount(group_b, minlength=n_groups)
    counts = np.stack([sizes_a, sizes_b, np.diff(firsts, append=n_groups), np.add.reduceat(products, firsts)], axis=1)

    # all ids in the order in which they are written, each with what follows it
    last = lambda group: np.concatenate((group[1:] != group[:-1], [True])).astype(np.int64)
    ids = np.concatenate((tokenizers.written_a[2 * ids_a + last(group_a)], tokenizers.written_b[2 * ids_b + last(group_b)]))
    parts = ids[np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")].tolist()
    borders = [0, *np.cumsum(sizes_a + sizes_b).tolist()]
    return Aligned(counts, ["".join(parts[s:e])[:-1] for s, e in zip(borders[:-1], borders[1:])], pairs)


class Aligner:
    """Aligns whole texts, each distinct chunk once."""

    def __init__(self, path_a: str, path_b: str):
        self.tokenizers = Tokenizers(path_a, path_b)
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.written: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)
        self.pairs = Csr(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), 1 << 40)
        self.letters = 0

    def _learn(self, pieces: list[str]) -> None:
        """Align pieces and remember them; one that does not come back is remembered as place -1."""
        counts, pairs = [self.counts], [self.pairs]
        for i in range(0, len(pieces), TOGETHER):
            some = pieces[i : i + TOGETHER]
            self.index.update(dict.fromkeys(some, -1))
            kept, tokens = self.tokenizers.encode(some)
            if kept:
                new = align(self.tokenizers, *tokens)
                self.index.update(zip(kept, range(len(self.written), len(self.written) + len(kept))))
                self.written += new.written
                self.letters += sum(map(len, new.written))
                counts.append(new.counts)
                pairs.append(new.pairs)
        self.counts = np.concatenate(counts)
        ends = np.cumsum([0, *(len(p.columns) for p in pairs)])
        starts = np.concatenate([[0], *(p.starts[1:] + e for p, e in zip(pairs, ends))])
        self.pairs = Csr(starts, np.concatenate([p.columns for p in pairs]), np.concatenate([p.values for p in pairs]), 1 << 40)

    def places(self, texts: list[str]) -> list[np.ndarray | None]:
        """The places of each text's pieces among those remembered; None for a text without tokens."""
        if len(self.index) > MAX_CHUNKS or len(self.pairs.columns) + self.letters > MAX_KEPT:
            self._forget()
        odd = [bool(ODD.search(t)) for t in texts]
        marked = pa.array([" " + t for t, o in zip(texts, odd) if t and not o], pa.string())
        marked = pc.replace_substring(pc.replace_substring(marked, " ", "\0 "), "\n", "\0\n")
        lists = pc.split_pattern(pc.replace_substring_regex(marked, f"({LETTER})([.,])(\\x00|$)", "\\1\0\\2\\3"), "\0")
        coded = lists.values.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        cut = {i: CUT.split(" " + t) for i, (t, o) in enumerate(zip(texts, odd)) if t and o}
        known = self.index
        wanted = dict.fromkeys(p for some in (pieces, *cut.values()) for p in some if p and p not in known)
        if wanted:
            self._learn(list(wanted))
        of_piece = np.fromiter((known[p] if p else -2 for p in pieces), np.int64, len(pieces))
        at = of_piece[np.asarray(coded.indices, np.int64)]
        offsets = np.asarray(lists.offsets)
        plain = iter([at[s + 1 : e] for s, e in zip(offsets[:-1], offsets[1:])])  # a mark stands first
        found: list[np.ndarray | None] = []
        for i, text in enumerate(texts):
            places = np.empty(0, np.int64) if not text else np.fromiter(map(known.__getitem__, cut[i]), np.int64) if odd[i] else next(plain)
            if len(places) and places.min() < 0:  # as a whole, which may be a chunk already
                if " " + text not in known:
                    self._learn([" " + text])
                places = np.array([known[" " + text]])
            found.append(places if len(places) and places.min() >= 0 else None)
        return found

    def document(self, at: np.ndarray) -> tuple[np.ndarray, str, np.ndarray, np.ndarray]:
        """Counts, groups, and the keys and links of the pairs of a text with these pieces."""
        different, times = np.unique(at, return_counts=True)
        starts, sizes = self.pairs.starts[different], np.diff(self.pairs.starts)[different]
        places = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        keys, links = self.pairs.columns[places], self.pairs.values[places] * np.repeat(times, sizes)
        order = np.argsort(keys, kind="stable")
        keys, links = keys[order], links[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return self.counts[at].sum(axis=0), ";".join(map(self.written.__getitem__, at.tolist())), keys[first], np.add.reduceat(links, first)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner of two files; kept from task to task."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def aligned_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``groups``: the ids of each group, written ``a1,a2|b1;a3|b2,b3``; empty without tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = aligner(path_a, path_b)
        for batch, texts in text_slices(batches):
            written = ["" if at is None else ";".join(map(one.written.__getitem__, at.tolist())) for at in one.places(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), pa.array(written, pa.string())], ["doc_id", "groups"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, groups string")


# -- blocks of documents and their dictionaries ----------------------------------------------

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string())]
    + [("places", pa.list_(pa.int32())), ("links", pa.list_(pa.int64())), ("start", pa.int32()), ("keys", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))]
)
BLOCKS_DDL = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places array<int>, links array<long>, start int, keys array<long>, docs array<int>"


def _lists(values: np.ndarray, sizes: Sequence[int], kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(values, kind))


def _batch(size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in BLOCKS], schema=BLOCKS)


def _block(number: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """A block's documents, whose pairs are places in its dictionary, and the dictionary."""
    sizes = [len(r[3]) for r in rows]
    keys = np.concatenate([np.empty(0, np.int64), *(r[3] for r in rows)])
    keys, places, docs = np.unique(keys, return_inverse=True, return_counts=True)
    links = np.concatenate([np.empty(0, np.int64), *(r[4] for r in rows)])
    ends = np.cumsum([0, *sizes])
    start = 0
    while start < len(rows):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + DICTIONARY_ROW, "right")) - 1)
        counts = np.array([r[1] for r in rows[start:end]], np.int64).reshape(-1, 4)
        span = slice(ends[start], ends[end])
        yield _batch(
            end - start,
            block=pa.array(np.full(end - start, number)),
            doc_id=pa.array([r[0] for r in rows[start:end]], pa.int64()),
            groups_sha256=pa.array([r[2] for r in rows[start:end]], pa.string()),
            places=_lists(places[span].astype(np.int32), sizes[start:end], pa.int32()),
            links=_lists(links[span], sizes[start:end], pa.int64()),
            **{c: pa.array(counts[:, i]) for i, c in enumerate(COUNTS)},
        )
        start = end
    for start in range(0, len(keys), DICTIONARY_ROW):
        some = slice(start, start + DICTIONARY_ROW)
        size = len(keys[some])
        yield _batch(1, block=pa.array([number]), start=pa.array([start], pa.int32()), keys=_lists(keys[some], [size], pa.int64()), docs=_lists(docs[some].astype(np.int32), [size], pa.int32()))


def _linked(path_a: str, path_b: str, block_pairs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = aligner(path_a, path_b)
        number, rows, pairs = TaskContext.get().partitionId() << 32, [], 0
        none = np.empty(0, np.int64)
        for batch, texts in text_slices(batches):
            for doc_id, at in zip(batch.column("id").to_pylist(), one.places(texts)):
                if at is None:
                    rows.append((doc_id, np.zeros(4, np.int64), "", none, none))
                else:
                    counts, written, keys, links = one.document(at)
                    rows.append((doc_id, counts, hashlib.sha256(written.encode()).hexdigest(), keys, links))
                    pairs += len(keys)
                if pairs >= block_pairs:
                    yield from _block(number, rows)
                    number, rows, pairs = number + 1, [], 0
        if rows:
            yield from _block(number, rows)

    return run


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _rated(documents: pa.Table, dictionary: pa.Table) -> pa.Table:
    """A block's documents with the counts of their pairs looked up."""
    order = np.argsort(np.asarray(dictionary.column("place").combine_chunks()))
    count = np.asarray(dictionary.column("n").combine_chunks())[order]
    best = np.asarray(dictionary.column("best").combine_chunks().cast(pa.int64()))[order]
    places, links = (documents.column(c).combine_chunks() for c in ("places", "links"))
    starts = np.asarray(places.offsets)
    at, times = np.asarray(places.values), np.asarray(links.values)
    summed = lambda values: np.diff(np.concatenate(([0], np.cumsum(values)))[starts])
    found = {"n_best": pa.array(summed(times * best[at])), "count_sum": pa.array(summed(times * count[at]))}
    names = [part.split(" ")[0] for part in RESULT.split(", ")]
    return pa.table([found[n] if n in found else documents.column(n) for n in names], names=names)


def token_links(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Per document: its tokens of both kinds, groups, shared-group links, how many of them are with
    the B id that the corpus links most with their A id (``n_best``), the sum over links of the number
    of documents that hold their pair (``count_sum``), and the SHA-256 of its groups as written."""
    linked = staged(id_and_text(docs, id_col, text_col).mapInArrow(_linked(path_a, path_b, block_pairs), BLOCKS_DDL), "linked")
    entries = linked.where("keys is not null").select("block", "start", F.posexplode(F.arrays_zip("keys", "docs")).alias("at", "entry"))
    entries = entries.select("block", (F.col("start") + F.col("at")).alias("place"), F.col("entry.keys").alias("key"), F.col("entry.docs").alias("docs"))
    counts = staged(entries.groupBy("key").agg(F.sum("docs").alias("n")), "pairs")
    counts = counts.withColumn("a", F.shiftright("key", B_BITS))
    greatest = counts.groupBy("a").agg(F.max("n").alias("greatest"))  # one row per id of A
    counts = counts.join(F.broadcast(greatest), "a").select("key", "n", (F.col("n") == F.col("greatest")).alias("best"))
    dictionary = entries.select("block", "place", "key").join(counts, "key").select("block", "place", "n", "best")
    documents = linked.where("keys is null").select(F.col("block").alias("of_block"), "doc_id", *COUNTS, "groups_sha256", "places", "links")
    return documents.groupBy("of_block").cogroup(dictionary.groupBy("block")).applyInArrow(_rated, RESULT)
