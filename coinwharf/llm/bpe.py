"""Exact byte-pair encoding by backtracking over token matches, and decoding by an offset table.

A list of tokens is the encoding of its text exactly if each token is the encoding of itself and
each two neighbours are that of their joint text, that is, if no merge would cross the border
between them. So an encoder need not replay merges. It takes the longest token at a place (an
Aho-Corasick automaton over reversed tokens and the reversed word finds the longest one at every
place in one pass), goes on if it can stand after the token before, else tries the next shorter
token that is a beginning of this one, and steps back where none is left. A prefix of the word has
one encoding only, so a place that was stepped back from is never entered again: the work grows with
the length of the word. Whether two tokens can stand side by side is answered once a pair and
worker, from the merges along the right edge of the one and the left edge of the other.

``Bpe`` reads a tokenizer file of byte-level BPE with or without a mark at word ends. Texts are cut
into words as the file says (normalisation, splitting at a pattern), special tokens in a text first;
words met before are not encoded again. Decoding joins the tokens' texts, which lie one after the
other in one array, by blanks, as the tokenizers library does for a file that names no decoder.

Defined cases: a null text is empty and has no ids; its decoded text is empty; equal rows stay
separate; very long texts and words are encoded whole; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from coinwharf.llm.common import id_and_text, text_slices

#: Words and pairs of tokens a worker remembers before it starts anew; longer words are not kept.
MAX_WORDS, MAX_PAIRS, LONG_WORD = 400_000, 2_000_000, 100
#: Ids that are decoded at a time.
DECODED_IDS = 200_000
#: Letters that every version of Unicode normalises, cuts and lower-cases alike; texts with others
#: are cut by the tokenizers library itself.
SETTLED = regex.compile("[\\x00-\\u012f\\u0131-\\u02af\\u2010-\\u2027\\u2030-\\u205e]*+")
BLANK = "\\x09-\\x0d\\x20\\x85\\xa0"
#: The last letter of a word, where a file marks word ends: letters moved out of the others' way.
ENDED = 0x1000
NEVER = 1 << 40


def byte_letters() -> list[str]:
    """The letter by which byte-level files write each byte: printable ones as they are, the others
    counted on from 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Merges:
    """Tokens by their letters, and which of them can stand side by side."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str | None):
        self.end = end
        inner = lambda t: t[: -len(end) - 1] + chr(ord(t[-len(end) - 1]) + ENDED) if end and t.endswith(end) and len(t) > len(end) else t
        size = max(vocab.values()) + 1
        self.letters: list[str] = [""] * size
        for token, i in vocab.items():
            self.letters[i] = inner(token)
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.made: dict[int, int] = {}
        self.size = size
        for rank, pair in enumerate(merges):
            a, b = pair if not isinstance(pair, str) else pair.split(" ")
            whole = vocab[(a[: -len(end)] if end and a.endswith(end) and len(a) > len(end) else a) + b]
            a, b = vocab[a], vocab[b]
            if max(self.rank[a], self.rank[b]) >= rank or self.rank[whole] >= 0:
                raise ValueError("merges must follow those of their parts, one for each token")
            self.rank[whole], self.left[whole], self.right[whole] = rank, a, b
            self.made[a * size + b] = whole
        self.fits: dict[int, bool] = {}
        self.usable = [False] * size
        base = [i for i in range(size) if len(self.letters[i]) == 1]
        for i in base:
            self.usable[i] = True
        for i in sorted((i for i in range(size) if self.rank[i] >= 0), key=self.rank.__getitem__):
            a, b = self.left[i], self.right[i]
            self.usable[i] = self.usable[a] and self.usable[b] and self.crossing(a, b) == i

    def _edge(self, token: int, inward: list[int]) -> list[int]:
        """A token and the parts at one of its edges, the smallest first."""
        parts = [token]
        while (token := inward[token]) >= 0:
            parts.append(token)
        return parts[::-1]

    def crossing(self, a: int, b: int) -> int:
        """The first token that merges across the border of two tokens, or -1.

        At any time one part of ``a`` and one of ``b`` meet at the border. Merges come in order of
        rank, the one furthest left first among equals: so the part on the left grows before a merge
        of the same rank crosses the border, the part on the right after it.
        """
        xs, ys, rank, made, size = self._edge(a, self.right), self._edge(b, self.left), self.rank, self.made, self.size
        i = j = 0
        while True:
            x_grows = rank[xs[i + 1]] if i + 1 < len(xs) else NEVER
            y_grows = rank[ys[j + 1]] if j + 1 < len(ys) else NEVER
            joint = made.get(xs[i] * size + ys[j], -1)
            if joint >= 0 and rank[joint] < x_grows and rank[joint] <= y_grows:
                return joint
            if x_grows == y_grows == NEVER:
                return -1
            if x_grows <= y_grows:
                i += 1
            else:
                j += 1

    def fit(self, a: int, b: int) -> bool:
        key = a * self.size + b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > MAX_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self.crossing(a, b) < 0
        return known


class Bpe:
    """Encoder and decoder of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            document = json.load(file)
        model = document["model"]
        self.vocab = model["vocab"]
        self.merges = Merges(self.vocab, model["merges"], model.get("end_of_word_suffix"))
        letters = self.merges.letters
        self.lengths = list(map(len, letters))
        self.automaton = ahocorasick.Automaton()
        by_letters = {}
        for i, token in enumerate(letters):
            if self.merges.usable[i]:
                by_letters[token] = i
                self.automaton.add_word(token[::-1], (len(token), i))
        self.automaton.make_automaton()
        # the longest token that is a proper beginning of each
        self.shorter = [next((by_letters[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by_letters), -1) for t in letters]
        self.byte_letter = {b: c for b, c in enumerate(byte_letters())}
        self._load_cutting(document, Tokenizer.from_file(path))
        self._load_texts(document)
        self.words: dict[str, np.ndarray] = {}

    # -- cutting texts into words -------------------------------------------------

    def _load_cutting(self, document: dict, library) -> None:
        """Special tokens, the pattern of words, and what is done to texts before."""
        self.special = {t["content"]: t["id"] for t in document["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in document["added_tokens"]):
            raise ValueError("special tokens must be plain strings")
        parts = (document["normalizer"] or {}).get("normalizers", [])
        steps = document["pre_tokenizer"].get("pretokenizers", [])
        if [p["type"] for p in parts] != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError("texts must be normalised, lower-cased and split at a pattern")
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.word_pattern = regex.compile(steps[0]["pattern"]["Regex"].replace("\\s", BLANK))
        self.library = library

    def cut(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if SETTLED.fullmatch(text):
            return self.word_pattern.findall(text.lower())
        plain = self.library.normalizer.normalize_str(text)
        back = {c: b for b, c in self.byte_letter.items()}
        return [bytes(map(back.__getitem__, w)).decode("utf-8") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    # -- encoding -------------------------------------------------------------------

    def _letters(self, word: str) -> str:
        written = "".join(map(self.byte_letter.__getitem__, word.encode("utf-8")))
        return written[:-1] + chr(ord(written[-1]) + ENDED) if self.merges.end else written

    def encode_word(self, word: str) -> list[int]:
        """The tokens of one word; see the head of this module."""
        letters = self._letters(word)
        size = len(letters)
        longest, found = [-1] * size, [0] * size
        for at, (length, token) in self.automaton.iter(letters[::-1]):
            start = size - 1 - at
            if length > found[start]:
                longest[start], found[start] = token, length
        lengths, shorter, fit = self.lengths, self.shorter, self.merges.fit
        left = bytearray(size + 1)  # places that were stepped back from
        tokens: list[int] = []
        place, token = 0, longest[0]
        while place < size:
            end = place + lengths[token]
            if not left[end] and (not tokens or fit(tokens[-1], token)):
                tokens.append(token)
                place = end
                token = longest[place] if place < size else -1
                continue
            token = shorter[token]
            while token < 0:
                left[place] = 1
                token = tokens.pop()
                place -= lengths[token]
                token = shorter[token]
        return tokens

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, special tokens in it included."""
        if "<" in text and (pieces := self.special_pattern.split(text)) and len(pieces) > 1:
            ids = [self._plain(p) if i % 2 == 0 else np.array([self.special[p]], np.int32) for i, p in enumerate(pieces)]
            return np.concatenate(ids)
        return self._plain(text)

    def _plain(self, text: str) -> np.ndarray:
        words = self.cut(text)
        known = self.words
        if len(known) > MAX_WORDS:
            known.clear()
        found = list(map(known.get, words))
        if None in found:
            fresh: dict[str, list[int]] = {}
            for i, word in enumerate(words):
                if found[i] is None:
                    ids = fresh.get(word)
                    if ids is None:
                        ids = fresh[word] = self.encode_word(word)
                        if len(word) <= LONG_WORD:
                            known[word] = ids
                    found[i] = ids
        return np.fromiter(chain.from_iterable(found), np.int32)

    # -- decoding ----------------------------------------------------------------------

    def _load_texts(self, document: dict) -> None:
        """All tokens' texts, a blank after each, in one array, and where each begins."""
        if document.get("decoder"):
            raise ValueError("a file with a decoder of its own is not supported")
        texts = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        joined = [texts.get(i, "").encode("utf-8") + b" " for i in range(max(texts) + 1)]
        self.texts = np.frombuffer(b"".join(joined), np.uint8)
        self.begins = np.concatenate(([0], np.cumsum(list(map(len, joined))))).astype(np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, in UTF-8."""
        parts = []
        for at in range(0, len(ids), DECODED_IDS):
            some = ids[at : at + DECODED_IDS]
            lengths = self.begins[some + 1] - self.begins[some]
            ends = np.cumsum(lengths, dtype=np.int32)
            places = np.repeat(self.begins[some] - (ends - lengths), lengths)
            places += np.arange(len(places), dtype=np.int32)
            parts.append(self.texts[places].tobytes())
        return b"".join(parts)[:-1]


_BPES: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    """This worker's coder of a file; kept from task to task."""
    if path not in _BPES:
        _BPES[path] = Bpe(path)
    return _BPES[path]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


def _text_array(coder: Bpe, ids: list[np.ndarray]) -> pa.Array:
    return pa.array([coder.decode(some) for some in ids], pa.binary()).cast(pa.string())


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the ``ids`` of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path)
        for batch, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), _lists(list(map(coder.encode, texts)))], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path)
        for batch in batches:
            lists = batch.column("ids")
            values, offsets = np.asarray(lists.values), np.asarray(lists.offsets)
            start = 0
            while start < len(lists):
                end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + DECODED_IDS, "right")) - 1)
                ids = [values[offsets[i] : offsets[i + 1]] for i in range(start, end)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, end - start), _lists(ids), _text_array(coder, ids)], ["doc_id", "ids", "text"])
                start = end

    return rows.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(run, "doc_id long, ids array<int>, text string")


def there_and_back(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` and the decoded ``text`` of each whole text, by one worker in one go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path)
        for batch, texts in text_slices(batches):
            ids = list(map(coder.encode, texts))
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), _lists(ids), _text_array(coder, ids)], ["doc_id", "ids", "text"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values, offsets = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
        digests = [hashlib.sha256(values[a:b].tobytes()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(digests), batch.column("decoded_sha256")], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids as little-endian 32-bit numbers and of the text."""
    hashed = rows.select("doc_id", "ids", F.sha2("text", 256).alias("decoded_sha256"))
    return hashed.mapInArrow(_digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
