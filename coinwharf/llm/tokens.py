"""Token ids of whole texts, by the tokenizers library, each distinct chunk encoded once."""

from __future__ import annotations

import os
from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct chunks a worker remembers before it starts anew; bounds its memory.
MAX_CHUNKS = 300_000
#: A word of its own between chunks; chunks that hold it are encoded one by one.
MARK = "\x01"
#: Texts that are encoded whole: empty, other white space than single blanks and line feeds
#: between words, a zero character, or the one letter whose lower case ends in a mark.
ODD = "^$|[ \\n][ \\n]|^[ \\n]|[ \\n]$|[\\x00\\t\\x0b-\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{130}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


class Encoder:
    """Encodes texts with a tokenizer file.

    A tokenizer cuts a text at white space before it merges anything. So where a text has
    only single blanks and line feeds between its words, its ids are those of its chunks in
    order, and a chunk met before needs no second encoding. Any other text is encoded whole.

    ``keeps_blanks``: whether the tokenizer gives ids to white space (a blank then belongs to
    the word after it); otherwise it drops white space.
    """

    def __init__(self, path: str, keeps_blanks: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_blanks = keeps_blanks
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if keeps_blanks:
            blank = self.tokenizer.id_to_token(self.tokenizer.encode(" ", add_special_tokens=False).ids[0])
            self.begins[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(blank)]] = True
        else:
            self.begins[self.tokenizer.encode(MARK, add_special_tokens=False).ids] = True
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)  # of chunk k in ids; k + 1 ends it

    def _chunks(self, texts: pa.Array) -> pa.ListArray:
        """The chunks of texts that have single blanks and line feeds only.

        A single full stop or comma between a word and white space is a chunk of its own, as it
        is never merged with the word. Where blanks are dropped, so is the case of A to Z.
        """
        if self.keeps_blanks:
            marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
            return pc.split_pattern(pc.replace_substring_regex(marked, "([\\pL\\pN])([.,])(\\x00|$)", "\\1\0\\2\\3"), "\0")
        plain = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
        return pc.split_pattern(pc.replace_substring_regex(plain, "([\\pL\\pN])([.,])( |$)", "\\1 \\2\\3"), " ")

    def _lines(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks, and each one's number of ids, from lines of many chunks at a time.

        Where blanks are kept, only the first id of a chunk begins with a blank. Else a mark
        stands before each chunk; it has an id of its own.
        """
        join = "" if self.keeps_blanks else f" {MARK} "
        lines = [join[1:] + join.join(chunks[i : i + 500]) for i in range(0, len(chunks), 500)]
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate(found)
        first = self.begins[ids]
        starts = np.append(np.flatnonzero(first), len(ids))
        if self.keeps_blanks:
            return ids, np.diff(starts)
        return ids[~first], np.diff(starts) - 1

    def _learn(self, chunks: list[str]) -> None:
        plain = (lambda c: c[0] == " " and len(c) > 1 and "<|" not in c) if self.keeps_blanks else (lambda c: MARK not in c and "<|" not in c)
        many, few = [c for c in chunks if plain(c)], [c for c in chunks if not plain(c)]
        parts = [self._lines(many)] if many else []
        if few:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(few, add_special_tokens=False)]
            parts.append((np.array([i for ids in found for i in ids], np.uint32), np.array(list(map(len, found)), np.int64)))
        ids, lengths = (np.concatenate(x) for x in zip(*parts))
        if len(lengths) != len(chunks):
            raise ValueError("the tokenizer does not cut at white space as it should")
        known, used = len(self.index), int(self.starts[len(self.index)])
        if used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, max(2 * len(self.ids), used + len(ids)))
        if known + len(chunks) + 1 > len(self.starts):
            self.starts = np.resize(self.starts, max(2 * len(self.starts), known + len(chunks) + 1))
        self.ids[used : used + len(ids)] = ids
        self.starts[known + 1 : known + len(chunks) + 1] = used + np.cumsum(lengths)
        self.index.update(zip(many + few, range(known, known + len(chunks))))

    def encode(self, texts: pa.Array | Sequence[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        odd = np.array(pc.match_substring_regex(texts, ODD), bool)
        lists = self._chunks(texts.filter(pa.array(~odd)))
        coded = lists.values.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.index) > MAX_CHUNKS:
            self._forget()
        known = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        if len(unknown := np.flatnonzero(known < 0)):
            missing = [distinct[k] for k in unknown]
            self._learn(missing)
            known[unknown] = np.fromiter(map(self.index.get, missing), np.int64, len(missing))
        at = known[np.asarray(coded.indices)]
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(lengths)
        places = np.repeat((self.starts[at] - (ends - lengths)).astype(np.int32), lengths)
        places += np.arange(len(places), dtype=np.int32)
        flat = self.ids[places]
        plain = iter(np.split(flat, np.concatenate(([0], ends))[np.asarray(lists.offsets)][1:-1])) if len(lists) else iter(())
        return [self._whole(texts[i].as_py()) if odd[i] else next(plain) for i in range(len(texts))]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keeps_blanks: bool) -> Encoder:
    """This worker's encoder for a tokenizer file; kept from task to task."""
    key = (path, keeps_blanks)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, keeps_blanks)
    return _ENCODERS[key]
