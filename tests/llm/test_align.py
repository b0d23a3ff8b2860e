"""Links between the tokens of two tokenizers against plain loops over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coinwharf.llm import align, queries
from coinwharf.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
PATHS = tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  a", "\n", "\nword two", "a  b   c", "a\tb \t c", "trailing \n", "<|endoftext|> <s> </s> <0x41>", "a▁b c", "plain words\nand lines",
    "é ﬁ 中文 \U0001f642\U0001f44d\U0001f3fd", "\x00a b", "don't we'll 's", "a\x85b c\xa0d", " " * 300 + "x" + "\n" * 70, "12345 67 8.9", "x y z　w", "=" * 900 + "-" * 900,
    "one, two. three", "3, 4. 5 x², y³. z,", ", a ,b", "ends with a stop.", "a.\nb,\nc", "., . ,", "no.no,no", "a, ▁b, c.", "𐐀. é, ß.",
]


@pytest.fixture(scope="module")
def tokens():
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def both(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        return list(zip(ids_a, bytes_a)), list(zip(ids_b, bytes_b))

    return both


def grouped(text, tokens):
    """The groups of a text as lists of ids, or None without tokens."""
    if not text:
        return None
    a, b = tokens(text)
    if b"".join(x for _, x in a) != (" " + text).encode() or b"".join(x for _, x in b) != (" " + text).encode():
        return None
    found, ends = [], []
    for side in (a, b):
        at, of = 0, []
        for i, x in side:
            at += len(x)
            of.append((at, i))
        ends.append(of)
    cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    start = 0
    for cut in cuts:
        found.append(tuple([i for e, i in side if start < e <= cut] for side in ends))
        start = cut
    return found


def brute(rows, tokens):
    per_doc = [(doc_id, grouped(text, tokens)) for doc_id, text in rows]
    held = Counter(pair for _, g in per_doc if g for pair in {(x, y) for a, b in g for x in a for y in b})
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for doc_id, g in per_doc:
        if not g:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for a, b in g for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_rows_of_the_query(spark, tokens):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]
    got = queries.QUERIES["op11_alignment"](spark, SF_DIR)
    assert got.columns == COLUMNS and sorted(map(tuple, got.collect()), key=repr) == brute(rows, tokens)


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = "aeinst  \n\n\t019-_.,'“▁é中\xa0<|>"
    return ["".join(rng.choices(letters, k=rng.randint(1, 80))) for _ in range(n)]


def test_odd_texts_in_small_blocks(spark, tokens):
    rows = [*enumerate(ODD), (3, "  a"), (None, "plain words\nand lines"), *enumerate(random_texts(400, 4), 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(n) for n in ("id", "block", "key", "n", "a", "keys", "links")])
    want = brute(rows, tokens)
    got = sorted(map(tuple, align.token_links(docs, *PATHS, block_pairs=200).collect()), key=repr)
    assert got == want and sum(r[1] == 0 for r in want) > 5
    written = {r["doc_id"]: r["groups"] for r in align.aligned_groups(docs, *PATHS).collect()}
    assert all(hashlib.sha256(written[r[0]].encode()).hexdigest() == r[7] for r in want if r[7] and r[0] is not None) and written[0] == ""
    assert align.token_links(docs.where("doc_id < 0"), *PATHS).count() == 0


def test_products_by_rows_are_matrix_products():
    rng = np.random.default_rng(1)
    for height, middle, width in ((1, 1, 1), (7, 5, 9), (40, 30, 20), (3, 0, 4)):
        a, b = (rng.integers(0, 3, size) * rng.integers(0, 2, size) for size in ((height, middle), (middle, width)))
        sparse = [align.Csr.of(*np.nonzero(m), *m.shape, m[np.nonzero(m)]) for m in (a, b)]
        for limit in (1, 10, 1 << 20):
            align.EXPANDED, kept = limit, align.EXPANDED
            product = sparse[0].times(sparse[1])
            align.EXPANDED = kept
            dense = np.zeros((height, width), int)
            dense[product.rows(), product.columns] = product.values
            assert (dense == a @ b).all()
        assert (sparse[0].transposed().rows() == np.nonzero(a.T)[0]).all()


def test_overlap_links_share_a_byte(tokens):
    kit = align.Tokenizers(*PATHS)
    for text in ["unbelievable antidisestablishmentarianism", "12345678 éééé", *random_texts(50, 9)]:
        kept, (of_a, _, of_b, _) = kit.encode([" " + text])
        if not kept:
            continue
        overlap = align.incidence(kit.lengths_a[of_a]).times(align.incidence(kit.lengths_b[of_b]).transposed())
        spans = [np.cumsum([0, *lengths[ids]]) for lengths, ids in ((kit.lengths_a, of_a), (kit.lengths_b, of_b))]
        want = [(i, j) for i in range(len(of_a)) for j in range(len(of_b)) if max(spans[0][i], spans[1][j]) < min(spans[0][i + 1], spans[1][j + 1])]
        assert list(zip(overlap.rows().tolist(), overlap.columns.tolist())) == want


def test_a_long_group_costs_its_ids_not_its_tokens_squared(spark):
    """Tokens of the two never end together inside these runs, or rarely."""
    rows = [(1, "7" * 300_000), (2, "ab" * 200_000), (3, " " + "​" * 100_000)]
    got = {r["doc_id"]: r for r in align.token_links(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS).collect()}
    for doc_id, text in rows:
        written = align.Aligner(*PATHS)
        groups = [g.split("|") for g in written.written[written.places([text])[0][0]].split(";")]
        sizes = [(len(a.split(",")), len(b.split(","))) for a, b in groups]
        assert got[doc_id]["n_links"] == sum(a * b for a, b in sizes) and got[doc_id]["n_groups"] == len(groups)
