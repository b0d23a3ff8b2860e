"""The backtracking encoder against the tokenizers library and against merging step by step."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coinwharf.llm import bpe, queries
from coinwharf.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "a", "<|endoftext|>", "x<|endoftext|>y <|startoftext|> <|END", "ΑΣ ΣΑΣ İstanbul", "don't we'LL 'S", "é é ﬁ ÅÅ",
    "中文字 \U0001f642\U0001f44d\U0001f3fd", "\x1c\x1d a\x85b\xa0c d", "a" * 5000, "²³¼ ١٢ ⅷ", "\x00a\x00", "</w> w</w>",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def coder():
    return bpe.Bpe(PATH)


def assert_same(coder, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert coder.encode(text).tolist() == want
    assert coder.decode(np.array(want, np.int32)).decode() == library.decode(want, skip_special_tokens=False)


def test_same_as_the_library_on_odd_texts(coder, library):
    rng = random.Random(1)
    letters = "aeinst'<|>ABÉß·\n\t 019-_.“”​́ſKΣ日"
    texts = [*ODD, *("".join(rng.choices(letters, k=rng.randint(1, 80))) for _ in range(800)), *("".join(rng.choices("aeinsthro", k=rng.randint(1, 400))) for _ in range(300))]
    for text in texts:
        assert_same(coder, library, text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_same_as_the_library_on_any_text(text):
    assert_same(bpe.bpe(PATH), _library(), text)


def _library(cache={}):  # noqa: B006
    if not cache:
        cache["it"] = Tokenizer.from_file(PATH)
    return cache["it"]


def merged(word, ranks):
    """Byte-pair encoding as defined: the pair of least rank, the first such, until none is left."""
    parts = list(word)
    while pairs := [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]:
        at = min(pairs)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def test_pairs_fit_as_in_merging_step_by_step():
    """Small made-up vocabularies, where steps back are frequent."""
    rng = random.Random(7)
    backs = 0
    for _ in range(60):
        vocab, merges = {c: i for i, c in enumerate("abc")}, []
        while len(merges) < 25:
            a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
            if len(a + b) < 7 and a + b not in vocab:
                merges.append((a, b))
                vocab[a + b] = len(vocab)
        ranks = {pair: i for i, pair in enumerate(merges)}
        rules = bpe.Merges(vocab, merges, None)
        tokens = {i: t for t, i in vocab.items()}
        for i, t in tokens.items():
            assert rules.usable[i] == (merged(t, ranks) == [t])
        usable = [i for i in tokens if rules.usable[i]]
        for a in usable:
            for b in usable:
                assert rules.fit(a, b) == (merged(tokens[a] + tokens[b], ranks) == [tokens[a], tokens[b]])
        one = bpe.Bpe.__new__(bpe.Bpe)
        one.merges, one.lengths, one._letters = rules, list(map(len, rules.letters)), lambda w: w
        one.automaton = bpe.ahocorasick.Automaton()
        for i in usable:
            one.automaton.add_word(tokens[i][::-1], (len(tokens[i]), i))
        one.automaton.make_automaton()
        by = {tokens[i]: i for i in usable}
        one.shorter = [next((by[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by), -1) for t in rules.letters]
        for _ in range(60):
            word = "".join(rng.choices("abc", k=rng.randint(1, 40)))
            got = [tokens[i] for i in one.encode_word(word)]
            assert got == merged(word, ranks)
            backs += len(got[0]) < max(len(t) for i, t in tokens.items() if rules.usable[i] and word.startswith(t))
    assert backs > 100


def test_a_long_word_takes_linear_time(coder, library):
    word = "abcdefgh" * 30000
    assert coder.encode(word).tolist() == library.encode(word, add_special_tokens=False).ids


def test_rows_of_the_query(spark, library):
    want = {}
    for r in table(spark, SF_DIR, "documents").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = queries.QUERIES["op13_bpe"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


def test_defined_cases(spark, library):
    rows = [(1, None), (2, ""), (2, ""), (None, "one two"), (4, "word " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(n) for n in ("id", "ids", "n_tokens")])
    both = bpe.there_and_back(docs, PATH).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], len(r["ids"])) for r in both if r["doc_id"]) == [(False, 1, 0), (False, 2, 0), (False, 2, 0), (False, 4, 30000)]
    assert [r["text"] for r in both if r["doc_id"] is None] == [library.decode(library.encode("one two").ids)]
    one_by_one = bpe.decoded(bpe.encoded(docs, PATH), PATH).collect()
    key = lambda r: (str(r["doc_id"]), len(r["ids"]))
    assert sorted(one_by_one, key=key) == sorted(both, key=key)
    assert bpe.digests(bpe.there_and_back(docs.where("doc_id < 0"), PATH)).count() == 0
    assert bpe.digests(bpe.there_and_back(docs, PATH)).where("doc_id = 1").first()[1:] == (0, *[hashlib.sha256(b"").hexdigest()] * 2)
