"""Each text operator against a brute-force version, and its defined edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coinwharf.llm import decontaminate, htmltext, licenses, packing, pii, quality, secrets, simhash, token_files, toxicity
from coinwharf.llm.common import table
from coinwharf.llm.components import components
from coinwharf.llm.tokens import Encoder

SF_DIR = "/root/testdata/sf0.001"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = "word " * 30000
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, "one two three"), (5, "one two three"), (None, "one two four"), (7, LONG), (8, "token = 'ab12cd34ef' end")]


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF_DIR, "documents")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls, empty and long texts, repeated rows, and columns with the operators' own names."""
    names = ("id", "fp", "kept", "n_words", "uid", "length", "words", "toxic", "score", "found", "rows", "gone_id", "a", "key")
    return spark.createDataFrame(EDGES, "doc_id long, text string").select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="module")
def nothing(edges):
    return edges.where("doc_id < 0")


# --- benchmark decontamination


def edits_within(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
        row, best = new, min(best, new[-1])
    return best


def test_bit_parallel_distance_is_exact():
    rng = random.Random(3)
    for _ in range(300):
        pattern, text = ("".join(rng.choices("abc ", k=rng.randint(1, n))) for n in (90, 120))
        edits, end = decontaminate.best_end(decontaminate.letter_masks(pattern), len(pattern), text)
        assert edits == edits_within(pattern, text)
        assert edits == len(pattern) or edits_within(pattern, text[:end]) == edits


def changed(text, edits, rng):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        rng.choice([lambda: out.__setitem__(at, "z"), lambda: out.insert(at, "q"), lambda: out.pop(at)])()
    return "".join(out)


def test_matches_are_those_of_brute_force():
    rng = random.Random(5)
    words = ["".join(rng.choices("aeioust", k=rng.randint(2, 6))) for _ in range(60)]
    sentence = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, sentence(rng.randint(6, 30))) for i in range(25)]
    matcher = decontaminate.Matcher(items, 0.1)
    hits = 0
    for _ in range(60):
        item = rng.choice(items)[1]
        text = decontaminate.reduced(sentence(20) + " " + changed(item, rng.randint(0, int(len(item) * 0.14)), rng) + " " + sentence(20))
        found = matcher.matches(text)
        for number, (_, pattern) in enumerate(items):
            edits = edits_within(pattern, text)
            assert (number in found) == (edits <= int(len(pattern) * 0.1))
            if number in found:
                hits += 1
                least, start, end = found[number]
                assert least == edits == edits_within(pattern, text[start:end])
    assert hits > 30


def test_matches_on_tables(spark, documents, texts):
    items = table(spark, SF_DIR, "benchmark")
    found = decontaminate.benchmark_matches(documents, items).collect()
    exact = {(d, i["item_id"]) for i in items.collect() for d, t in texts.items() if decontaminate.reduced(i["text"]) in decontaminate.reduced(t)}
    assert exact <= {(r["doc_id"], r["item_id"]) for r in found}
    by_id = {i["item_id"]: i["text"] for i in items.collect()}
    for r in found:
        assert edits_within(decontaminate.reduced(by_id[r["item_id"]]), decontaminate.reduced(texts[r["doc_id"]][r["start"] : r["end"]])) == r["edits"]
    left = {r["doc_id"] for r in decontaminate.without_benchmark(documents, items).collect()}
    assert left == set(texts) - {r["doc_id"] for r in found}


def test_matches_edges(spark, edges, nothing):
    items = spark.createDataFrame([(1, "word word word word word word"), (2, None), (3, "a"), (4, "word word word word word word")], "item_id long, text string")
    got = decontaminate.benchmark_matches(edges, items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in got) == [(7, 1, 0), (7, 4, 0)]
    assert decontaminate.benchmark_matches(nothing, items).count() == 0
    assert decontaminate.benchmark_matches(edges, items.limit(0)).count() == 0
    left = decontaminate.without_benchmark(edges, items)
    assert left.columns == edges.columns and left.count() == len(EDGES) - 1


# --- secrets


def base_spans(text):
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII | re.IGNORECASE):
        if len(m[2]) >= 6:
            spans.append(("assign", *m.span()))
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))


def test_secrets_base_spans(documents, texts):
    for r in secrets.secret_spans(documents).collect():
        spans = base_spans(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r["spans"].split(",")) | {""}


def cheapest(value):
    """Guess cost over every segmentation, for short values."""
    costs = {}
    for start, end, cost in secrets._segments(value):
        costs[start, end] = min(cost, costs.get((start, end), 1e9))
    best = 1e9
    for cuts in itertools.product((0, 1), repeat=len(value) - 1):
        edges = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(value)]
        best = min(best, sum(secrets.SEGMENT_COST + min(costs.get((a, b), 1e9), (b - a) * secrets.CHAR_COST) for a, b in zip(edges, edges[1:])))
    return best


@pytest.mark.parametrize("value", ["a", "password1", "qwerty12", "aaaaaaaa", "x9f3k2qz", "p@ssword", "ababab", "19870314", "dragon99"])
def test_guesses_are_the_cheapest_segmentation(value):
    assert secrets.guesses(value) == pytest.approx(cheapest(value))


def test_guessed_secrets_and_masks(spark, edges, nothing):
    text = 'the client_secret => "k9$Xv2!qLm#8Zt" and Bearer eyJhbGci0iJIUzI1NiJ9xyz, but the secret is something and token is password1'
    kinds = [s[0] for s in secrets.find_secrets(text)]
    assert kinds == ["guess", "guess"]
    assert "k9$" not in secrets.masked(text, secrets.find_secrets(text), "[SECRET]")
    got = secrets.secret_spans(edges).collect()
    assert len(got) == len(EDGES) and sum(r["n_assign"] for r in got) == 1
    out = secrets.redacted(edges.withColumn("n_chars", F.lit(0).cast("long")))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[8]["text"] == "[SECRET]' end" and rows[8]["n_chars"] == 13 and rows[1]["text"] is None
    assert secrets.secret_spans(nothing).count() == 0


# --- quality rules


def plain_measures(text):
    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_and_verdicts(documents, texts):
    for r in quality.quality(documents).collect():
        expected = plain_measures(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)


def test_em_recovers_planted_accuracies(spark):
    rng = random.Random(1)
    accuracy = {"x": 0.9, "y": 0.8, "z": 0.7}
    rows = Counter()
    for _ in range(20000):
        truth = 1 if rng.random() < 0.7 else -1
        rows[tuple(truth if rng.random() < a else -truth for a in accuracy.values())] += 1
    patterns = spark.createDataFrame([(*k, n) for k, n in rows.items()], "vote_x int, vote_y int, vote_z int, n long")
    model = quality.VoteModel(list(accuracy)).fit(patterns, 200)
    assert model.good == pytest.approx(0.7, abs=0.05)
    for name, a in accuracy.items():
        assert model.like[name][1][0] == pytest.approx(a, abs=0.06)


def test_quality_edges(edges, nothing):
    got = quality.quality(edges).collect()
    assert len(got) == len(EDGES) and not any(r["kept"] for r in got if r["doc_id"] != 7)
    long = next(r for r in got if r["doc_id"] == 7)
    assert long["n_words"] == long["n_repeat_words"] == 30000 and long["base_failed"]
    assert quality.quality(nothing).count() == 0 and quality.kept_documents(edges).columns == edges.columns


# --- packing


def test_packing(spark, documents, texts):
    plain = Tokenizer.from_file(BYTE)
    packed = packing.pack(packing.cut_texts(documents, BYTE, 0, 512, keep_ids=True), 512)
    rows = packed.collect()
    places = {}
    for r in rows:
        ids = plain.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [0]
        own = ids[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own)) and r["ids"] == own
        assert r["length"] == 512 or r["piece"] == 0
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    total = 0
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
        total += at
    assert sum(r["length"] for r in rows) == sum(len(plain.encode(t, add_special_tokens=False).ids) + 1 for t in texts.values())
    assert len(places) <= 1.01 * -(-total // 512) + 1
    assert {len(r["ids"]) for r in packing.sequences(packed).collect()} == {sum(n for _, n in p) for p in places.values()}


def test_breeding_never_loses_pieces_and_beats_no_bound():
    rng = random.Random(2)
    for _ in range(20):
        sizes = [rng.choice([rng.randint(1, 60), rng.randint(1, 20)]) for _ in range(60)]
        best = packing.evolve(sizes, 64, [], rng)
        assert sorted(i for b in best for i in b) == list(range(60))
        assert all(sum(sizes[i] for i in b) <= 64 for b in best)
        assert len(best) <= len(packing._packed(sizes, 64, sorted(range(60), key=lambda i: -sizes[i])))
    # pairs that fill a bin each, which falling best fit alone need not find
    assert len(packing.evolve([30, 34, 20, 44, 12, 52, 10, 54], 64, [], rng)) == 4


def test_packing_of_lengths_that_pair_up(spark):
    """Six blocks of which every piece needs one of the other length: a sequence for each pair."""
    rows = spark.range(0, 6000, 1, 3).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, 1100).otherwise(900).cast("long").alias("length"))
    packed = packing.pack(rows, 2048).collect()
    assert len(packed) == 6000 and len({r["sequence_id"] for r in packed}) == 3000
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == 6000


def test_packing_goes_on_where_nothing_fills_well(spark):
    """Bins of two that are never nearly full: rounds end, and all pieces are placed once."""
    rows = spark.range(0, 5000, 1, 3).select(F.col("id").alias("doc_id"), (F.col("id") % 7 + 700).alias("length"))
    packed = packing.pack(rows, 2048).collect()
    assert sorted(r["doc_id"] for r in packed) == list(range(5000))
    assert len({r["sequence_id"] for r in packed}) == 2500


def test_packing_edges(edges, nothing):
    got = packing.pack(packing.cut_texts(edges, BYTE, 0, 2048), 2048).collect()
    assert sum(r["piece"] == 0 for r in got) == len(EDGES)
    assert sum(r["length"] == 2048 for r in got) >= 14
    assert packing.pack(packing.cut_texts(nothing, BYTE, 0, 2048), 2048).count() == 0


# --- tokens and their files


@pytest.mark.parametrize(("path", "keeps"), [(BYTE, True), (WORD, False)])
def test_encoder_equals_the_library(path, keeps, texts):
    rng = random.Random(4)
    alphabet = ["a", "É", "1", ".", ",", "'s", " ", "\n", "B", "...", "́", "İ", "\x01", "\0", "\t", "\x1c", "\x85", "　", "<|endoftext|>", "Σ", "가"]
    odd = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(8000)]
    own, plain = Encoder(path, keeps), Tokenizer.from_file(path)
    for some in ([*texts.values()], odd):
        assert [ids.tolist() for ids in own.encode(some)] == [e.ids for e in plain.encode_batch(some, add_special_tokens=False)]


def test_token_files(spark, documents, texts, folder):
    token_files.write_tokens(documents, f"{folder}/t", WORD, 1, parts=4)
    stored = token_files.read_tokens(spark, f"{folder}/t")
    plain, at = Tokenizer.from_file(WORD), 0
    got = {r["doc_id"]: r for r in token_files.token_digests(stored).collect()}
    for doc_id in sorted(texts):
        ids = plain.encode(texts[doc_id], add_special_tokens=False).ids + [1]
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        at += len(ids)
    assert len(got) == len(texts)


def test_look_up_skips_row_groups_by_their_ranges_and_bloom_filters(spark, folder):
    docs = spark.range(0, 24000, 2, 3).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    token_files.write_tokens(docs, f"{folder}/t", WORD, 1, parts=2)

    def read(ids):
        found = token_files.look_up(spark, f"{folder}/t", ids)
        rows = found.collect()
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return [r["doc_id"] for r in rows], leaf.metrics().apply("numOutputRows").value()

    assert read([6000]) == ([6000], 1000)  # one group of 1000 rows of 12,000
    assert sorted(read([2, 23998])[0]) == [2, 23998] and read([2, 23998])[1] <= 2000  # a last group may be shorter
    # absent ids within the range of every group: their Bloom filters rule nearly all out
    read_rows = [read([i])[1] for i in range(1001, 21001, 1000)]
    assert sum(read_rows) <= 2000


def test_equal_rows_share_no_part_alone(spark, folder):
    """A third of all rows without id and text are dealt over the parts."""
    docs = spark.range(0, 9000, 1, 3).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("a b")).alias("text"))
    token_files.write_tokens(docs, f"{folder}/t", WORD, 1, parts=6)
    stored = token_files.read_tokens(spark, f"{folder}/t")
    assert max(r["count"] for r in stored.groupBy("part").count().collect()) < 2500
    rows = token_files.token_digests(stored).orderBy("start").collect()
    assert [r["start"] for r in rows] == [0, *itertools.accumulate([r["n_tokens"] for r in rows])][:-1]
    assert [r["doc_id"] for r in rows] == [None] * 3000 + [i for i in range(9000) if i % 3]


def test_token_files_edges(spark, edges, nothing, folder):
    token_files.write_tokens(edges, f"{folder}/t", WORD, 1)
    rows = token_files.token_digests(token_files.read_tokens(spark, f"{folder}/t")).orderBy("start").collect()
    assert [r["start"] for r in rows] == [0, *itertools.accumulate([r["n_tokens"] for r in rows])][:-1]
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 5, 7, 8] and rows[1]["n_tokens"] == 1
    token_files.write_tokens(nothing, f"{folder}/e", WORD, 1)
    assert token_files.read_tokens(spark, f"{folder}/e").count() == 0


# --- SimHash


def plain_print(text):
    words = [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    group = {}
    left = set(prints)
    while left:
        seed = left.pop()
        reached, todo = {seed}, [seed]
        while todo:
            at = todo.pop()
            near = {p for p in left if (p ^ at).bit_count() <= 3}
            left -= near
            reached |= near
            todo += near
        group |= dict.fromkeys(reached, min(reached, key=lambda p: prints[p]))
    return {p: prints[g] for p, g in group.items()}


def check_groups(rows, texts):
    prints = {i: plain_print(t) for i, t in texts.items()}
    first = {}
    for i, p in prints.items():
        first[p] = min(i, first.get(p, i))
    groups = plain_groups(first)
    assert {(r["id"], r["fp"] % (1 << 64), r["group"]) for r in rows} == {(i, p, groups[p]) for i, p in prints.items()}


def test_simhash_groups(documents, texts):
    check_groups(simhash.near_groups(documents).collect(), texts)


def test_simhash_crowded_keys(spark):
    """Many fingerprints under the same keys: chains and clusters go through the block path."""
    rng = random.Random(7)
    prints = set()
    for _ in range(3):
        base = rng.getrandbits(64)
        for _ in range(500):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    root = {r["node"] % (1 << 64): r["root"] for r in components(links).collect()}
    expected = plain_groups({p: p for p in prints})
    for one, two in itertools.combinations(prints, 2):
        same = one in root and root[one] == root.get(two)
        assert same == (expected[one] == expected[two])


def test_simhash_edges(edges, nothing):
    rows = simhash.near_groups(edges).collect()
    assert sorted((r["id"], r["group"]) for r in rows if r["id"] in (1, 2, 3)) == [(1, 1), (2, 1), (3, 1)]
    assert [r["group"] for r in rows if r["id"] == 5] == [4, 4]
    assert simhash.near_groups(nothing).count() == 0
    kept = simhash.one_of_each_group(edges)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 7, 8]


def test_one_row_stays_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (3, "x y z w")], "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.one_of_each_group(docs).collect()) == [(1, "a b c d"), (3, "x y z w")]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5)]
    root = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({root[i] for i in range(301)}) == 1 and len({root[2000 + i] for i in range(300)} | {root[1000]}) == 1
    assert root[0] != root[1000]
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


# --- licences


def test_licenses(documents, texts):
    known = licenses.Templates(licenses.TEMPLATES, licenses.LEAST_DICE)
    got = {(r["doc_id"], r["start"], r["end"]): r for r in licenses.license_notices(documents).collect()}
    for i, t in texts.items():
        at = 0
        for line in t.split("\n"):
            pairs = licenses.bigrams(licenses.words_of(line))
            best = max((licenses.dice(pairs, b, sum(pairs.values()) + n) for _, b, n in known.all), default=0)
            if best >= licenses.LEAST_DICE:
                assert any(d == i and a <= at and at + len(line) <= b for d, a, b in got)
            at += len(line) + 1
    assert {r["license"] for r in got.values()} >= {"MIT", "Apache-2.0"}


def test_licenses_over_lines_and_edges(spark, edges, nothing):
    mit = next(t for name, t in licenses.TEMPLATES if t.startswith("Permission is hereby granted, free"))
    words = mit.split()
    wrapped = "Some prose here.\n" + "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12)) + "\nMore prose."
    found = licenses.Templates(licenses.TEMPLATES, 0.8).notices(wrapped)
    assert [(n, d) for n, d, _, _ in found] == [("MIT", 1.0)] and wrapped[found[0][2] : found[0][3]].split() == words
    assert licenses.license_notices(edges).count() == 0 and licenses.license_notices(nothing).count() == 0


# --- personal data


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_feistel_is_a_permutation(spark):
    for a, b in ((189, 773), (10, 100), (1, 7)):
        big = lambda n: F.lit(n).cast("bigint")
        got = [r[0] for r in spark.range(a * b).select(pii.permuted(F.col("id"), big(a), big(b), "key", "kind")).collect()]
        assert sorted(got) == list(range(a * b))


def test_pseudonyms_keep_format_and_link(spark, edges, nothing):
    text = "+1 (988) 555-2485 4041894974608795 4041-8949-7460-8795 4041894974608796 70.123.182.155 1987-02-28 28.02.1987 1987-02-30 123-45-6789 000-12-3456 a.b@x.org 4.0."
    rows = pii.pseudonymised(spark.createDataFrame([(1, text), (2, f"so {text} it was")], "doc_id long, text string"), "k").orderBy("doc_id").collect()
    assert rows[1]["text"] == f"so {rows[0]['text']} it was"
    new, old = rows[0]["text"].split(" "), text.split(" ")
    assert re.sub("[0-9]", "9", " ".join(new[:-2])) == re.sub("[0-9]", "9", " ".join(old[:-2])) and new[-2].endswith("@x.org")
    assert luhn(new[3]) and new[3] != old[3] and new[4].replace("-", "") == new[3]
    for same in (5, 9, 11):  # what fails its check stays
        assert new[same] == old[same]
    other = pii.pseudonymised(spark.createDataFrame([(1, text)], "doc_id long, text string"), "another").first()["text"]
    assert other != rows[0]["text"]
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymised(edges, "k").collect()}
    assert got[1] == "" and got[7] == LONG and pii.pseudonymised(nothing, "k").count() == 0


def test_no_personal_data_is_left(documents, texts):
    for r in pii.pseudonymised(documents, "k").collect():
        old = texts[r["doc_id"]]
        for name in ("email", "ip", "phone"):
            for value in re.findall(f"(?:{pii.PATTERNS[name]})", old):
                assert value not in r["text"]
        if not re.search(pii.ANY, old):
            assert r["text"] == old


# --- toxicity


def test_toxic_expressions_are_found(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices(["an", "ti", "on", "er", "st"], k=3)) for _ in range(300)]
    rows = []
    for i in range(600):
        toxic = i % 5 == 0
        text = [*rng.choices(words, k=40), *(["qux" + "".join(rng.choices(["an", "ti"], k=2))] if toxic else [])]
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.toxicity(docs.drop("toxic"), docs.select("doc_id", "toxic")).join(docs.select("doc_id", F.col("toxic").alias("label")), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == r["label"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_sent_and_joined_differences_give_the_same_scores(spark, edges):
    docs = edges.select("doc_id", "text").unionByName(spark.createDataFrame([(90 + i, t) for i, t in enumerate(["ab> a>b <x> vile vile", "kind words", "vile words ..."])], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, int(i in (90, 92))) for i in (1, 4, 7, 90, 91, 92)], "doc_id long, toxic int")
    sent, joined = (sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["score"], r["top"], r["mean"]) for r in toxicity.toxicity(docs, labels, max_sent=n).collect()) for n in (10**6, 0))
    assert len(sent) == len(joined) == docs.count()
    for one, two in zip(sent, joined):
        assert one == pytest.approx(two, abs=1e-9)


def test_shared_backoff_sums_to_one(spark):
    words = ["^anti$", "^onan$", "^tion$"]
    grams = spark.createDataFrame([(g,) for g in {g for w in words for g in toxicity.grams_of(w)}], "gram string")
    shared = {r["gram"]: r["shared"] for r in toxicity._shared(grams).collect()}
    assert sum(p for g, p in shared.items() if len(g) == 1) == pytest.approx(1)
    assert all(0 < p <= 1 for p in shared.values())


def test_toxicity_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(edges, labels).collect()
    assert len(got) == len(EDGES) and all(r["score"] is not None for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    assert toxicity.toxicity(nothing, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(edges, labels.limit(0)).collect()} == {0.5}


# --- pages


def test_pages_of_the_table(spark):
    rows = {r["page_id"]: r["html"] for r in table(spark, SF_DIR, "pages").collect()}
    for r in htmltext.page_texts(table(spark, SF_DIR, "pages")).collect():
        import html

        body = rows[r["page_id"]].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


PAGE = (
    "<body><header><a href=/>Home</a></header><div class='menu'><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul></div>"
    "<div class='story'><h2>A title</h2><p>First paragraph, with some words, and more of them.<p>Second &amp; longer paragraph;\n it goes on, and on.</p><ul><li>short</li></ul></div>"
    "<div id='comments'><p>A reader's remark, which is long, and has commas, too.</p></div><form>Mail <input></form><aside>Side</aside><footer>Imprint, address.</footer></body>"
)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, "A title\n\nFirst paragraph, with some words, and more of them.\n\nSecond & longer paragraph; it goes on, and on.\n\nshort"),
        ("", ""),
        ("<script>var a = '<p>';</script>", ""),
        ("plain &lt;text&gt;", "plain <text>"),
        ("<p>a <b>b</p>c<br>d</div> e", "a b\n\nc d e"),
        ("<p>one<!-- <p>two", "one"),
        ("a < b", "a < b"),
    ],
)
def test_page_cases(page, text):
    assert htmltext.main_text(page) == text


def test_page_edges(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>a</p>" * 20000, "x"), (None, "u", "", "x")], "page_id long, url string, html string, text string")
    got = htmltext.page_texts(pages).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 20000 + 2 * 19999]
    assert htmltext.page_texts(pages.where("page_id < 0")).count() == 0


def _luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_pii_finds_cards_beside_other_digits_and_american_dates(spark):
    card, other = "4111 1111 1111 1111", "5500-0055-5555-5559"
    beside = ["card {} 05/27", "{} 123", "12 {}", "12-{} 0527 123.", "{} 03/05/1980", "{} 555-123-4567", "{} 123-45-6789", "{} 10.0.0.1", "{} 123@example.com", f"{other} {{}}", "1 2 3 4 5 {} 6 7 8"]
    beside = [b.format(c) for b in beside for c in (card, card.replace(" ", ""), card.replace(" ", "-"))]
    rows = pii.pseudonymised(spark.createDataFrame(list(enumerate(beside)), "doc_id long, text string"), "k").orderBy("doc_id").collect()
    plain = re.sub(r"\D", "", pii.pseudonymised(spark.createDataFrame([(1, card)], "doc_id long, text string"), "k").first()["text"])
    for old, r in zip(beside, rows):
        new = re.sub("[ -]", "", r["text"])
        assert "4111111111111111" not in new and plain in new and _luhn(plain), (old, r["text"])
        assert re.sub("[0-9]", "", old) == re.sub("[0-9]", "", r["text"]) or "@" in old
        assert r["n_card"] == 1 + (other in old) and ("555555555559" in new) is False
        assert all(r[f"n_{kind}"] == 1 for kind, value in (("date", "03/05/1980"), ("phone", "555-123-4567"), ("ssn", "123-45-6789"), ("ip", "10.0.0.1"), ("email", "@")) if value in old)
    # what follows the card and is no value stays
    assert rows[0]["text"].endswith(" 05/27") and rows[3]["text"].endswith(" 123") and rows[6]["text"].startswith("12 ")

    days = [f"{m:02}/{d:02}/{y}" for y in (1800, 1980, 2000, 2199) for m in range(1, 13) for d in range(13, 32)]
    got = pii.pseudonymised(spark.createDataFrame([(i, f"on {d}.") for i, d in enumerate(days)], "doc_id long, text string"), "k").orderBy("doc_id").collect()
    for d, r in zip(days, got):
        real = int(d[3:5]) <= (29 if int(d[6:]) == 2000 or d[6:] == "1980" else 28) or d[:2] != "02" and (int(d[3:5]) <= 30 or d[:2] in ("01", "03", "05", "07", "08", "10", "12"))
        assert r["n_date"] == (r["text"] != f"on {d}.") == real, (d, r["text"])
        assert not real or re.fullmatch(r"on (0[1-9]|1[0-2])/(1[3-9]|2\d|3[01])/(1[89]|20|21)\d\d\.", r["text"])
    assert len({r["text"] for r in got}) == len(days)


def test_pii_numbers_days_after_the_twelfth_one_to_one(spark):
    late = spark.range(9 * 9833).select(F.col("id"), pii._late_day(F.col("id")).alias("day"))
    assert late.select("day").distinct().count() == 9 * 9833 and late.where(F.dayofmonth("day") <= 12).count() == 0
    assert late.agg(F.min("day").cast("string"), F.max("day").cast("string")).first()[:] == ("1800-01-13", "2199-12-31")


def test_licenses_within_lines_and_across_unknown_lines():
    known = licenses.Templates(licenses.TEMPLATES, 0.8)
    prose = "Some longer prose about the weather of last year, told by an old man. "
    inline = f"{prose}Licensed under the MIT License. {prose}"
    assert [(n, d, inline[a:b]) for n, d, a, b in known.notices(inline)] == [("MIT", 1.0, "Licensed under the MIT License.")]
    mit = next(t for name, t in licenses.TEMPLATES if t.startswith("Permission is hereby granted, free"))
    one_line = f"{prose * 30}{mit} {prose * 30}\u0130"
    assert [(n, d, one_line[a:b]) for n, d, a, b in known.notices(one_line)] == [("MIT", 1.0, mit)]
    half = len(mit) // 2
    halves = mit[: mit.index(" ", half)] + "\nfoo\nbar baz\n" + mit[mit.index(" ", half) + 1 :]
    (name, d, a, b), = known.notices(f"{prose}\n{halves}\n{prose}")
    assert name == "MIT" and d > 0.97 and (f"{prose}\n{halves}\n{prose}")[a:b] == halves
    single = mit.replace("NONINFRINGEMENT. ", "\nNONINFRINGEMENT.\n")
    assert [(n, d) for n, d, _, _ in known.notices(single)] == [("MIT", 1.0)]


def test_licenses_match_every_window_by_brute_force():
    rng = random.Random(5)
    known = licenses.Templates((("A", "a b c d e f"), ("B", "c d c d g")), 0.8)
    for _ in range(300):
        words = rng.choices("abcdefgx", k=14) if rng.random() < 0.3 else [w if rng.random() < 0.85 else "x" for w in rng.choice(("xxabcdefxx", "xcdcdgxabcdef", "abcdcdgef"))]
        text = "".join(w + rng.choice(" \n") for w in words)
        every = [known.best(licenses.bigrams(words[i:j]), j - i - 1) for i in range(len(words)) for j in range(i + 2, len(words) + 1)]
        got, best = known.notices(text), max((e[0] for e in every if e), default=0)
        assert bool(got) == bool(best) and all(known.best(licenses.bigrams(licenses.words_of(text[a:b])), len(licenses.words_of(text[a:b])) - 1)[0] == d for _, d, a, b in got)


def test_licenses_know_the_standard_notices():
    known = licenses.Templates(licenses.TEMPLATES, 0.8)
    for start, name in (("Redistribution and use", "BSD-3-Clause"), ("Redistribution and use", "BSD-2-Clause"), ("This program is free software;", "GPL-2.0"), ("This program is free software:", "GPL-3.0")):
        for notice in [t for n, t in licenses.TEMPLATES if n == name and t.startswith(start)][-1:]:
            (got, d, _, _), = known.notices(f"Some prose, then {notice} And more of it.")  # a line that matches as a whole
            assert got == name and d > 0.95


STORY = "<p>First paragraph, with some words, and more of them.</p><p>Second, longer paragraph; it goes on, and on, and on.</p>"
STORY_TEXT = "First paragraph, with some words, and more of them.\n\nSecond, longer paragraph; it goes on, and on, and on."


@pytest.mark.parametrize("name", ["has-sidebar", "no-comments", "content with-menu", "article-share-enabled", "sidebar", "comments", "page-header"])
def test_a_name_on_the_wrapper_does_not_drop_the_page(name):
    for wrapped in (f"<article>{STORY}</article>", f"<main>{STORY}</main>", STORY):
        page = f"<body><div class='{name}'>{wrapped}<div class='ad'>Buy this.</div></div><footer>Imprint.</footer></body>"
        assert htmltext.main_text(page) == STORY_TEXT


def test_marked_parts_beside_the_article_are_left_out():
    for name in ("main-menu", "sidebar-left", "site-footer", "post-comments", "social-share", "ad_slot", "related"):
        for part in ("<p>A remark, which is short.</p>", "<article>Another story.</article>"):
            page = f"<body><div><article>{STORY}</article><div class='{name}'>{part}</div></div></body>"
            assert htmltext.main_text(page) == STORY_TEXT
    assert htmltext.main_text(f"<body><div>{STORY}<div id='comments'>{STORY * 3}</div></div></body>") == STORY_TEXT


LINKS = "<ul><li><a>One source</a></li><li><a>Two source</a></li><li><a>Three source</a></li></ul>"
LINK_TEXT = "One source\n\nTwo source\n\nThree source"
LONG_STORY = STORY * 20
LONG_STORY_TEXT = "\n\n".join([STORY_TEXT] * 20)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<html><head><title>T</title><meta name=a><body><header>Top</header>{STORY}</body>", STORY_TEXT),
        (f"<head><title>T</title><link rel=x><div>{STORY}</div>", STORY_TEXT),
        ("<head><script>var a = '</scripts>';</script>plain text", "plain text"),
        (f"<head><title>T</title></head><body><style>a</styles> b</style>{STORY}</body>", STORY_TEXT),
        (f"<html><head><style>a</style></head><body>{STORY}<head>x</body>", f"{STORY_TEXT}\n\nx"),
        (f"<body><div><h1>A headline</h1></div><div><p>A lead, which says it all, in one sentence, not too long.</p></div><div>{LONG_STORY}</div></body>", f"A headline\n\nA lead, which says it all, in one sentence, not too long.\n\n{LONG_STORY_TEXT}"),
        (f"<body><article>{STORY}{LINKS}</article></body>", f"{STORY_TEXT}\n\n{LINK_TEXT}"),
        (f"<body><div>{LINKS}</div><div>{STORY}<h2>References</h2>{LINKS}</div><div>{LINKS}</div></body>", f"{STORY_TEXT}\n\nReferences\n\n{LINK_TEXT}"),
        (f"<body>{LINKS}{STORY}{LINKS}{STORY}{LINKS}</body>", f"{STORY_TEXT}\n\n{LINK_TEXT}\n\n{STORY_TEXT}"),
    ],
)
def test_open_heads_leads_and_lists_of_links(page, text):
    assert htmltext.main_text(page) == text


def test_guessed_values_beyond_base_spans_and_of_one_kind_of_characters():
    text = "password: Abcdef1!xyz9Q#77 and more"
    spans = secrets.find_secrets(text)
    assert ("guess", 10, 26) in spans and secrets.masked(text, spans, "[X]") == "[X] and more"
    held = "password: Abcdef1xyz9Q77 and more"
    assert [kind for kind, _, _ in secrets.find_secrets(held)] == ["assign"]
    for sign in ("=", ": ", " => ", " := "):
        text = f"pwd{sign}qzkxvbnwtrplmhg"
        assert secrets.find_secrets(text) == [("guess", 3 + len(sign), len(text))]
    assert secrets.find_secrets("The passphrase is unfortunately lost, pwd=passwordpassword") == []


def test_stages_decide_on_rows_and_not_on_ids(spark, documents):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, row_key string")
    of = lambda df: sorted(r["row_key"] for r in df.collect())
    x, y = "alpha beta gamma delta epsilon zeta eta", "one whole other text about rivers and hills far away"
    assert of(simhash.one_of_each_group(frame([(3, x, "a"), (5, x, "b"), (5, y, "c"), (None, x, "d"), (None, y + " z", "e"), (None, y + " z", "f")]))) in (["a", "c", "e"], ["a", "c", "f"])
    assert of(simhash.one_of_each_group(frame([(9, x, "a"), (2, x, "b"), (4, x, "c")]))) == ["b"]
    items = spark.createDataFrame([(1, x)], "item_id long, text string")
    assert of(decontaminate.without_benchmark(frame([(5, x, "a"), (5, y, "b"), (None, f"so {x} too", "c"), (None, y, "d")]), items)) == ["b", "d"]
    judged = quality.quality(documents)
    good, bad = (documents.join(judged.where(kept).select("doc_id"), "doc_id").select("text").first()[0] for kept in ("kept", "not kept"))
    several = frame([(100_000 + i, r["text"], "x") for i, r in enumerate(documents.select("text").collect())] + [(5, good, "a"), (5, bad, "b"), (None, good, "c"), (None, bad, "d")])
    assert [k for k in of(quality.kept_documents(several)) if k != "x"] == ["a", "c"]


def test_pii_of_endless_values_keeps_its_depth(spark):
    """Each text would overflow the stack, or take hours, if depth or work grew with its square."""
    n = 200_000
    texts = ["x a@" + "b." * n + "com y", "a@" + "ab." * n, "a@" + "b" * n, "a." * n, "1.2.3.4." * (n // 4), "+1 " * n, "4111 1111 1111 1111 " * (n // 20)]
    rows = pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").orderBy("doc_id").collect()
    assert rows[0]["text"] == texts[0] and [r["n_email"] for r in rows] == [0, 1, 0, 0, 0, 0, 0]
    assert rows[1]["text"].endswith(texts[1][1:]) and rows[6]["n_card"] == n // 20


def test_short_items_match_whole_words(spark):
    items = spark.createDataFrame([(1, "Boiling point?"), (2, "ab"), (3, "a long enough item of words"), (4, ""), (5, "İİ")], "item_id long, text string")
    rows = [(1, "The boiling  POINT, ab."), (2, "boiling points, cab abc"), (3, "İİİİ a long enough item of wordz"), (4, None), (5, "İİ boiling point")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["edits"], r["start"], r["end"]) for r in decontaminate.benchmark_matches(docs, items).collect()}
    assert got == {(1, 1): (0, 4, 18), (1, 2): (0, 20, 22), (3, 3): (1, 5, 31), (5, 5): (0, 0, 2), (5, 1): (0, 3, 16)}
    # in the pipeline only passages long enough to be evidence count
    assert {r["doc_id"] for r in decontaminate.without_benchmark(docs, items).collect()} == {1, 2, 4, 5}


def test_values_beside_many_spans_take_linear_time():
    rng = random.Random(4)
    for _ in range(300):
        spans = [("hex", a, a + rng.randint(1, 9)) for a in rng.choices(range(60), k=rng.randint(0, 12))]
        cover = secrets._Cover(spans)
        start = rng.randrange(60)
        end = start + rng.randint(1, 15)
        held = all(any(a <= at < b for _, a, b in spans) for at in range(start, end))
        assert cover.holds(start, end) == held
    line = "password: Zq8#kLm2!xWv\n"
    short, long = (len(secrets.find_secrets(line * n)) for n in (10, 20_000))
    assert long == 2000 * short


def test_formulas_and_fallbacks_stay_in_the_text():
    page = "<article><p>The energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>E=mc^2</annotation></math> here, and more.</p><p><object data=x>Fallback text.</object></p></article>"
    assert htmltext.main_text(page) == "The energy is E=mc2 here, and more.\n\nFallback text."


def test_deep_and_unclosed_markup_takes_linear_time():
    for part, n in (("<div>", 100_000), ("<font>", 100_000), ("<div>text, more. ", 30_000), ("<li>a ", 30_000), ("</b>", 100_000)):
        assert len(htmltext.main_text(part * n + "end of it, all.")) >= 15
    assert len(htmltext.main_text("<font>" * 30_000 + "<p>x</p>" * 30_000)) == 30_000 * 3 - 2
