"""Toxicity by class-conditional Kneser-Ney models of letters in words.

Two models, of toxic and of ordinary labelled texts, give the probability of each letter of a
word after up to ORDER - 1 letters before it (``^`` opens a word, ``$`` closes it). Both share
their lower orders: Kneser-Ney continuation counts of all labelled texts, so an expression that
is rare in either class is smoothed alike and says little. A word's log-likelihoods are
normalised by its length; a text is judged by the largest difference of a word and by the
difference of the whole text, put on a scale of 0 to 1 by a logistic curve.

Counts are summed by Spark over all labelled texts, and the differences of log-likelihoods keep
every letter sequence that was seen, however many. Up to MAX_SENT of them are sent to the
executors; a longer table stays in files and is joined to the different words of all texts.
Both ways give the same evidence (letter sequences are told apart by 64-bit hashes when sent).
The logistic curve is fitted on at most FIT_ROWS labelled rows.

Defined cases: null and empty texts have no words and get the score of no evidence; an id with
several labels counts as toxic if one says so; null labels or ids are no labels; without any
label of one class all scores are the same; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from coinwharf.llm.common import id_and_text, text_slices
from coinwharf.session import staged

ORDER, DISCOUNT = 6, 0.75
#: Differences (12 bytes each) that may go to every executor; more are joined by shuffle.
MAX_SENT = 4_000_000
#: Labelled rows that the logistic curve is fitted on, the first by a hash of the id.
FIT_ROWS = 20_000
#: Labels are joined by broadcast up to this many rows (16 bytes each), else by shuffle.
BROADCAST_LABELS = 1_000_000
#: Words whose difference a worker remembers before it starts anew.
MAX_WORDS = 300_000
#: Stands for any letter not seen after a context; no word holds white space.
UNSEEN = "\n"
EDGES = ".,;:!?()[]{}\"'`*#$%&|<>"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def opened(word: str) -> str:
    return f"^{word.strip(EDGES)}$"


def grams_of(word: str) -> list[str]:
    """Each letter of an opened word with the up to ORDER - 1 letters before it."""
    size = len(word)
    return [word[:end] for end in range(2, min(size, ORDER) + 1)] + [word[end - ORDER : end] for end in range(ORDER + 1, size + 1)]


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: tuple[Counter, Counter] = (Counter(), Counter())
    for batch, texts in text_slices(batches):
        for text, toxic in zip(texts, batch.column("toxic").to_pylist()):
            words[toxic].update(words_of(text))
        if sum(map(len, words)) > 1_000_000:
            yield _grams_batch(words)
            words = (Counter(), Counter())
    yield _grams_batch(words)


def _grams_batch(words: tuple[Counter, Counter]) -> pa.RecordBatch:
    counts: tuple[dict, dict] = ({}, {})
    for own, found in zip(counts, words):
        for word, n in found.items():
            for gram in grams_of(opened(word)):
                own[gram] = own.get(gram, 0) + n
    grams = list(counts[0].keys() | counts[1].keys())
    return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), *[pa.array([c.get(g, 0) for g in grams], pa.int64()) for c in counts]], ["gram", "ordinary", "toxic"])


def _context(gram: str | Column = "gram") -> Column:
    return F.substring(gram, 1, F.char_length(gram) - 1) if isinstance(gram, Column) else F.expr(f"substring({gram}, 1, char_length({gram}) - 1)")


def _shared(grams: DataFrame) -> DataFrame:
    """``gram``, ``shared``: the probability of the last letter after the others, from how many
    different letters precede; ``grams`` lists the different grams one letter longer or more."""
    size = F.char_length("gram")
    shorten = lambda rows: rows.select(F.expr("substring(gram, 2)").alias("gram")).where(size >= 1).groupBy("gram").agg(F.count("*").alias("n"))
    longest, levels = ORDER - 1, {}
    seen = staged(shorten(grams), "continued")
    for length in range(longest, 0, -1):
        levels[length] = seen.where(size == length)
        if length > 1:
            both = seen.where(size < length).unionByName(shorten(levels[length]))
            seen = staged(both.groupBy("gram").agg(F.sum("n").alias("n")), f"continued{length}")
    total = levels[1].agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
    lower = levels[1].crossJoin(F.broadcast(total)).select("gram", ((F.col("n") + 0.5) / (F.col("all") + 0.5 * F.col("kinds"))).alias("shared"))  # one row
    found = [staged(lower, "shared1")]
    for length in range(2, longest + 1):
        own = levels[length].withColumn("context", _context())
        around = own.groupBy("context").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        rows = own.join(around, "context").withColumn("rest", F.expr("substring(gram, 2)"))
        below = found[-1].select(F.col("gram").alias("rest"), F.col("shared").alias("below"))
        value = (F.greatest(F.col("n") - DISCOUNT, F.lit(0)) + DISCOUNT * F.col("kinds") * F.col("below")) / F.col("all")
        found.append(staged(rows.join(below, "rest").select("gram", value.alias("shared")), f"shared{length}"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def differences(grams: DataFrame) -> DataFrame:
    """``key``, ``n``, ``difference``: log-likelihoods of toxic minus ordinary texts for each gram
    that was seen, and (key with UNSEEN after it) for any other letter after a context."""
    rows = grams.withColumn("context", _context())
    number = lambda c: F.sum(F.when(F.col(c) > 0, 1).otherwise(0))
    contexts = rows.groupBy("context").agg(
        F.sum("ordinary").alias("all_ordinary"), F.sum("toxic").alias("all_toxic"), number("ordinary").alias("kinds_ordinary"), number("toxic").alias("kinds_toxic")
    )
    # a context a class has hardly seen leaves its weight to the shared counts
    rest = lambda c: (DISCOUNT * F.col(f"kinds_{c}") + 1) / (F.col(f"all_{c}") + 1)
    shared = _shared(grams.select("gram")).withColumnRenamed("gram", "rest")
    joined = rows.join(contexts, "context").withColumn("rest", F.expr("substring(gram, 2)")).join(shared, "rest")
    like = lambda c: F.greatest(F.col(c) - DISCOUNT, F.lit(0)) / (F.col(f"all_{c}") + 1) + rest(c) * F.col("shared")
    seen = joined.select(F.col("gram").alias("key"), (F.col("ordinary") + F.col("toxic")).alias("n"), F.log(like("toxic") / like("ordinary")).alias("difference"))
    unseen = contexts.select(F.concat("context", F.lit(UNSEEN)).alias("key"), (F.col("all_ordinary") + F.col("all_toxic")).alias("n"), F.log(rest("toxic") / rest("ordinary")).alias("difference"))
    return seen.unionByName(unseen)


def difference_table(differences_: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted key hashes and their differences, of at most MAX_SENT rows."""
    found = differences_.select(F.xxhash64("key").alias("hash"), F.col("difference").cast("float").alias("difference")).toArrow()
    hashes = np.asarray(found["hash"]).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.asarray(found["difference"])[order]


def _looked_up(keys: list[str], table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The difference of each key, NaN where it has none; equal keys are looked up once."""
    hashes, values = table
    if not len(hashes) or not keys:
        return np.full(len(keys), np.nan, np.float32)
    coded = pa.array(keys, pa.string()).dictionary_encode()
    different = coded.dictionary.cast(pa.binary()).to_pylist()
    asked = np.fromiter(map(xxhash.xxh64_intdigest, different, repeat(42)), np.uint64, len(different))
    at = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
    return np.where(hashes[at] == asked, values[at], np.float32(np.nan))[np.asarray(coded.indices)]


def word_differences(words: list[str], table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per opened word the sum of its letters' differences, and the number of its letters."""
    grams = [grams_of(word) for word in words]
    letters = np.fromiter(map(len, grams), np.int64, len(grams))
    flat = [gram for of_word in grams for gram in of_word]
    values = _looked_up(flat, table).astype(np.float64)
    if len(missing := np.flatnonzero(np.isnan(values))):
        values[missing] = _looked_up([flat[i][:-1] + UNSEEN for i in missing], table)
    return np.bincount(np.repeat(np.arange(len(grams)), letters), np.nan_to_num(values), len(grams)), letters


_KNOWN: dict[str, dict[str, tuple[float, int, float]]] = {}


def _evidence(table, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _KNOWN:
            _KNOWN.clear()
            _KNOWN[key] = {}
        known, differences_ = _KNOWN[key], table.value
        for batch, texts in text_slices(batches):
            if len(known) > MAX_WORDS:
                known.clear()
            top, mean = [], []
            counted = [Counter(words_of(text)) for text in texts]
            new = [word for word in set().union(*counted) if word not in known]
            for at in range(0, len(new), 20_000):
                part = new[at : at + 20_000]
                forms = [opened(word) for word in part]
                index = {form: i for i, form in enumerate(dict.fromkeys(forms))}
                sums, letters = (x.tolist() for x in word_differences(list(index), differences_))
                for word, form in zip(part, forms):
                    i = index[form]
                    known[word] = sums[i], letters[i], sums[i] / letters[i] if letters[i] else 0.0
            for counts in counted:
                best, total, size = 0.0, 0.0, 0
                for word, n in counts.items():
                    value, letters, mean_value = known[word]
                    if mean_value > best:
                        best = mean_value
                    total, size = total + n * value, size + n * letters
                top.append(best)
                mean.append(total / size if size else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), pa.array(top, pa.float64()), pa.array(mean, pa.float64())], ["doc_id", "top", "mean"])

    return run


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its different words, opened, and how often each occurs; one empty row at least."""
    for batch, texts in text_slices(batches):
        for uid, doc_id, text in zip(batch.column("uid").to_pylist(), batch.column("id").to_pylist(), texts):
            counts: dict[str, int] = {"": 0}
            for word, n in Counter(words_of(text)).items():
                counts[opened(word)] = counts.get(opened(word), 0) + n
            rows = len(counts)
            columns = [pa.array([uid] * rows, pa.int64()), pa.array([doc_id] * rows, pa.int64()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["uid", "doc_id", "word", "n"])


def _word_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 5_000):
            rows = [(word, gram) for word in batch.column("word").slice(at, 5_000).to_pylist() for gram in grams_of(word)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows) if rows else ((), ()))], ["word", "gram"])


def joined_evidence(rows: DataFrame, differences_: DataFrame) -> DataFrame:
    """The evidence of every text (``doc_id``, ``top``, ``mean``) by joins, for any number of
    differences. A word that very many texts hold is a skewed join that adaptive execution splits."""
    uses = staged(rows.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(_text_words, "uid long, doc_id long, word string, n long"), "uses")
    grams = uses.select("word").where("word <> ''").distinct().mapInArrow(_word_grams, "word string, gram string")
    value = differences_.select("key", F.col("difference").cast("float").cast("double").alias("difference"))
    seen = grams.join(value.withColumnRenamed("key", "gram"), "gram", "left")
    other = value.select(F.col("key").alias("other"), F.col("difference").alias("instead"))
    settled = seen.withColumn("other", F.concat(_context(), F.lit(UNSEEN))).join(other, "other", "left")
    words = settled.groupBy("word").agg(F.sum(F.coalesce("difference", "instead", F.lit(0.0))).alias("value"), F.count("*").alias("letters"))
    valued = uses.join(staged(words, "words"), "word", "left")
    sums = valued.groupBy("uid", "doc_id").agg(
        F.greatest(F.max(F.col("value") / F.col("letters")), F.lit(0.0)).alias("top"),
        F.sum(F.col("n") * F.col("value")).alias("value"),
        F.sum(F.col("n") * F.col("letters")).alias("size"),
    )
    return sums.select("doc_id", "top", F.coalesce(F.col("value") / F.col("size"), F.lit(0.0)).alias("mean"))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Weights of a logistic curve with a little ridge, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS, max_sent: int = MAX_SENT) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and the evidence ``top`` and ``mean``
    of every text; only labels of rows that are not held out are learnt."""
    spark = docs.sparkSession
    known = (
        labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("toxic"))
        .where("label_id is not null and toxic is not null")
        .where(~held_out(F.col("label_id")))
        .groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    known = staged(known, "labels")
    few = known.count() <= BROADCAST_LABELS
    learnt = F.broadcast(known) if few else known
    rows = id_and_text(docs, id_col, text_col)
    grams = rows.join(learnt, rows["id"] == known["label_id"]).select("id", "text", "toxic").mapInArrow(_count_grams, "gram string, ordinary long, toxic long")
    grams = staged(grams.where("gram <> ''").groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "grams")
    found = staged(differences(grams), "differences")
    if found.count() <= max_sent:
        table = spark.sparkContext.broadcast(difference_table(found))
        evidence = staged(rows.mapInArrow(_evidence(table, f"{spark.sparkContext.applicationId} {id(table)}"), "doc_id long, top double, mean double"), "evidence")
        table.destroy()
    else:
        evidence = staged(joined_evidence(rows, found), "evidence")
    sample = evidence.join(learnt, evidence["doc_id"] == known["label_id"]).select("doc_id", "top", "mean", "toxic")
    fit = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "top", "mean").limit(fit_rows).toArrow()
    x = np.column_stack([np.ones(len(fit)), np.asarray(fit["top"], float), np.asarray(fit["mean"], float)])
    w = [float(v) for v in (_logistic(x, np.asarray(fit["toxic"], float)) if len(fit) else np.zeros(3))]
    score = 1 / (1 + F.exp(-(F.lit(w[0]) + w[1] * F.col("top") + w[2] * F.col("mean"))))
    judged = evidence.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), "top", "mean")
    return judged.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "top", "mean")
