"""Quality rules under weak supervision, in DataFrame functions only.

Each rule looks at a text's statistics and votes good (1), bad (-1) or abstains (0). Votes are
gathered into a table of vote patterns, of which there are at most 3 to the number of rules.
Expectation maximisation over that table estimates how often good and bad texts get each vote
from each rule, and how many texts are good; a text is kept if its posterior probability to be
good is at least one half. So a rule that others contradict counts little, and no single rule
rejects a text. Only two base rules reject outright: too few words, or mostly repeated ones.

Defined cases: a null text has no words and fails the base rules; equal texts get equal
verdicts; very long texts are measured whole; an empty table gives no rows; other columns are
ignored. Words are runs of anything but blanks and control white space (9 to 13).
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from coinwharf.llm.common import with_row_keys, without_ids
from coinwharf.session import staged

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = SYMBOLS + "{}[]\\/^~_=+@`"
SENTENCE_ENDS = ".!?"
DIGITS = "0123456789"
ROUNDS = 30


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(windows: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, from the hashes of all windows.

    Windows are sorted with their places; those equal to a neighbour are repeated. Their places,
    sorted again, each cover three words or as far as the next one.
    """
    many = F.lit(1 << 30)
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    none = F.array(F.lit(None).cast("struct<h:bigint,p:int>"))

    def starts(places: Column) -> Column:
        later = F.zip_with(places, F.slice(places, 2, many), lambda a, b: F.when(a["h"] == b["h"], a["p"]))
        earlier = F.zip_with(places, F.concat(none, places), lambda a, b: F.when(a["h"] == b["h"], a["p"]))
        return F.sort_array(F.array_distinct(F.array_compact(F.concat(later, earlier))))

    def covered(found: Column) -> Column:
        spans = F.zip_with(found, F.slice(found, 2, many), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(spans, F.lit(0), lambda total, x: total + x)

    return F.when(F.size(windows) > F.size(F.array_distinct(windows)), _let(_let(placed, starts), covered)).otherwise(0)


def _word_counts(hashes: Column) -> Column:
    """Distinct words, and words in repeated windows, from the hashes of all words in order."""
    many = F.lit(1 << 30)
    pairs = F.zip_with(hashes, F.slice(hashes, 2, many), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    windows = F.zip_with(pairs, F.slice(hashes, 3, many), lambda p, c: F.xxhash64(p["a"], p["b"], c))
    inner = F.slice(windows, 1, F.greatest(F.size(hashes) - 2, F.lit(0)))
    return F.struct(F.size(F.array_distinct(hashes)).alias("distinct"), _let(inner, _repeat_words).alias("repeated"))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of every whole text that the rules look at.

    Words and windows are compared by 64-bit hashes within a text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    words = F.array_remove(F.split("text", "[ \\t-\\r]+"), "")
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(_without(line, WHITE)) > 0)
    count = lambda of: (F.char_length("text") - F.char_length(_without(F.col("text"), of)))
    got = rows.select(
        "doc_id",
        (F.char_length("text") - count(WHITE)).alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        count(MARKS).alias("n_marks"),
        count(SENTENCE_ENDS).alias("n_ends"),
        count(DIGITS).alias("n_digits"),
        F.regexp_count("text", F.lit("[" + SYMBOLS + "]+")).alias("n_symbol_runs"),
        _let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct"))).alias("lines"),
        _let(F.transform(words, lambda w: F.xxhash64(w)), lambda x: F.struct(F.size(x).alias("n"), _word_counts(x).alias("counts"))).alias("words"),
    )
    long = lambda c: F.col(c).cast("long")
    return got.select(
        "doc_id",
        long("words.n").alias("n_words"),
        *[long(c).alias(c) for c in ("word_chars", "n_symbols")],
        (F.col("lines.all") - F.col("lines.distinct")).cast("long").alias("n_dup_lines"),
        long("words.counts.repeated").alias("n_repeat_words"),
        long("lines.all").alias("n_lines"),
        long("words.counts.distinct").alias("n_distinct"),
        *[long(c).alias(c) for c in ("n_marks", "n_ends", "n_digits", "n_symbol_runs")],
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes, by name, over the columns of ``measures``; no words abstain throughout."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean, symbols = F.col("word_chars") / words, F.col("n_symbols") / words
    repeated, sentence = F.col("n_repeat_words") / words, words / F.greatest(F.col("n_ends"), F.lit(1))
    lines, distinct = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("n_distinct") / F.sqrt(words)
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    runs, marks, digits = F.col("n_symbol_runs") / words, F.col("n_marks") / chars, F.col("n_digits") / chars
    return {
        "symbols": _vote(symbols < 0.02, symbols > 0.1),
        "symbol_runs": _vote(runs < 0.02, runs > 0.08),
        "marks": _vote(marks < 0.01, marks > 0.03),
        "mean_word": _vote(mean.between(3.5, 9), (mean < 2.5) | (mean > 12)),
        "repeats": _vote(repeated < 0.1, repeated > 0.3),
        "lines": _vote(lines < 0.05, lines > 0.3),
        "sentences": _vote(sentence.between(3, 40), sentence > 80),
        "digits": _vote(digits < 0.05, digits > 0.2),
        "variety": _vote(distinct > 3, distinct < 1.5),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


class VoteModel:
    """The share of good texts, and for good and bad texts how likely each rule gives each vote."""

    def __init__(self, names: list[str]):
        self.names = names
        self.good = 0.8
        # where EM starts: a rule that votes is right seven times in ten, and abstains as often for both
        self.like = {name: {1: (0.5, 0.2), 0: (0.3, 0.3), -1: (0.2, 0.5)} for name in names}

    def log_odds(self) -> Column:
        """Log of the odds that a text with these votes (columns ``vote_<rule>``) is good."""
        terms = [F.lit(math.log(self.good / (1 - self.good)))]
        for name in self.names:
            weight = {v: math.log(g / b) for v, (g, b) in self.like[name].items()}
            vote = F.col(f"vote_{name}")
            terms.append(F.when(vote == 1, weight[1]).when(vote == -1, weight[-1]).otherwise(weight[0]))
        return reduce(add, terms)

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))

    def fit(self, patterns: DataFrame, rounds: int = ROUNDS) -> VoteModel:
        """EM over vote patterns with their counts ``n``: at most 3 to the number of rules rows."""
        for _ in range(rounds):
            share = self.posterior()
            sums = [F.sum(F.col("n") * share).alias("good"), F.sum("n").alias("all")]
            for name in self.names:
                for vote, label in ((1, "p"), (0, "z"), (-1, "m")):
                    hit = F.when(F.col(f"vote_{name}") == vote, F.col("n")).otherwise(0)
                    sums += [F.sum(hit * share).alias(f"{name}_{label}_good"), F.sum(hit).alias(f"{name}_{label}_all")]
            got = patterns.agg(*sums).first()
            if not got["all"]:
                return self
            good, bad = got["good"], got["all"] - got["good"]
            before, self.good = self.good, min(max((good + 1) / (got["all"] + 2), 0.02), 0.98)
            for name in self.names:
                for vote, label in ((1, "p"), (0, "z"), (-1, "m")):
                    of_good, of_all = got[f"{name}_{label}_good"], got[f"{name}_{label}_all"]
                    self.like[name][vote] = ((of_good + 1) / (good + 3), (of_all - of_good + 1) / (bad + 3))
            if abs(self.good - before) < 1e-6:
                break
        return self


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """The statistics, ``base_failed``, ``posterior`` and ``kept`` of every row."""
    votes = rules()
    measured = staged(measures(docs, id_col, text_col), "measures")
    voted = measured.select("*", *[vote.alias(f"vote_{name}") for name, vote in votes.items()])
    patterns = staged(voted.groupBy(*[f"vote_{name}" for name in votes]).agg(F.count("*").alias("n")).coalesce(1), "votes")
    model = VoteModel(list(votes)).fit(patterns, rounds)
    judged = voted.select("*", base_failed().alias("base_failed"), model.posterior().alias("posterior"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose text is kept, each judged by itself whatever its id."""
    keyed, key = with_row_keys(docs)
    return without_ids(keyed, quality(keyed, key, text_col).where("not kept").select("doc_id"), key).drop(key)
