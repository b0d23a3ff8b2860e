"""Spelling variants against a brute-force version that compares all words with all."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from coinwharf.llm import queries, spelling
from coinwharf.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, near):
    forms = {}
    for w, n in counts.items():
        best = min(((-counts[x], x) for x in near[w]), default=None)
        forms[w] = best[1] if best and -best[0] >= 2 * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None))
    return rows


def neighbours(counts):
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    near = {w: set() for w in counts}
    for length, words in by_length.items():
        for a in words:
            for b in words:
                if one_edit(a, b):
                    near[a].add(b)
            for b in by_length.get(length + 1, ()):
                if one_edit(a, b):
                    near[a].add(b)
                    near[b].add(a)
    return near


@pytest.fixture(scope="module")
def expected(spark):
    counts = counted([(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()])
    return brute(counts, neighbours(counts))


def test_rows_of_the_query(spark, expected):
    got = queries.QUERIES["op12_spelling"](spark, SF_DIR)
    assert got.columns == COLUMNS and set(map(tuple, got.collect())) == expected and got.count() == len(expected)
    assert sum(r[1] is not None and r[1] != r[2] for r in expected) > 5


def test_many_leaves_and_parts_give_the_same_rows(spark, expected):
    docs = table(spark, SF_DIR, "documents")
    got = spelling.spelling_variants(docs, sample=300, leaf=20, max_home=15)
    assert set(map(tuple, got.collect())) == expected and got.count() == len(expected)


def test_trees_find_all_pairs_within_a_radius():
    rng = random.Random(2)
    for length, letters in ((5, "abc"), (8, "aeinstràÿ"), (12, "ab")):
        words = sorted({"".join(rng.choices(letters, k=length)) for _ in range(600)})
        counts = np.array([[w.count(c) for c in letters] for w in words])
        points = spelling.vectors(spelling.codes(words, length))
        for radius in (1, 2):
            pairs = list(spelling.within(spelling.grown(points, 8), points, points, radius))
            found = [(a, b) for q, p in pairs for a, b in zip(q.tolist(), p.tolist())]
            assert len(found) == len(set(found))
            apart = np.abs(counts[:, None] - counts[None]).sum(axis=2)
            # shared dimensions and the greatest threshold only add pairs
            assert set(zip(*map(np.ndarray.tolist, np.nonzero(apart <= radius)))) <= set(found)
            if letters == "abc":
                assert len(found) < len(words) ** 2 // 2


def test_letter_order_is_verified():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ("".join(rng.choices("ab", k=n)) for n in (6, 6))
        assert spelling.one_replaced(spelling.codes([a], 6), spelling.codes([b], 6))[0] == one_edit(a, b)
        c = "".join(rng.choices("ab", k=7))
        assert spelling.one_deleted(spelling.codes([c], 7), spelling.codes([a], 6))[0] == one_edit(a, c)


def test_defined_cases(spark):
    one = "bright brightt brigt bright Bright bright bright brightt brightt brigt brigt sight " * 1000
    rows = [(1, None), (2, ""), (3, one), (3, one), (None, "ÀÉÎÕÜ àéîõü ÀÉÎÕÜ ÀÉÎÕÜx ÀÉÎÕÜ"), (5, "four 12 a-b ﬁnger_ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(n) for n in ("id", "word", "n", "hash", "near", "at")])
    counts = counted(rows)
    assert set(map(tuple, spelling.spelling_variants(docs).collect())) == brute(counts, neighbours(counts))
    assert spelling.spelling_variants(docs.where("doc_id < 0")).count() == 0
    plain = {r["word"]: r["n"] for r in spelling.spelling_variants(docs, slip=None).collect()}
    assert plain["bright"] == 10_000 and plain["ÀÉÎÕÜ"] == 3 and "four" not in plain


def test_chains_of_forms_end_at_their_root(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w5"), ("y", "z")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "z" if w == "y" else "w37" for w, _ in chain}
