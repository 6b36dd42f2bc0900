"""Quality rules as voters: weak supervision in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation-maximisation over
the counts of vote patterns, at most 3^rules rows, estimates each rule's accuracy and the share of
good documents. The posterior probability of good decides. With the ranges below, one bad vote against
five good ones rejects unless the share of good documents is about 0.78 to 0.89 or more.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import spool

SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts for each row of `docs`, over the whole text; a null text counts as without words.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word, equal
    to an earlier one), n_repeat_words (words in 8-word windows that occur twice or more in the
    text), n_lines (with a word), n_chars, n_upper (capitals A-Z), n_distinct (different words).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.trim(F.col("text"), F.lit(SPACES))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_BREAK))
    )
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    counted = base.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    windows = F.when(
        F.col("n_words") > WINDOW,
        F.transform(
            F.sequence(F.lit(1), (F.col("n_words") - WINDOW + 1).cast("int")),
            lambda i: F.xxhash64(*[F.element_at("hashes", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    viewed = counted.select(
        "*",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    ).drop("lines", "hashes")
    return viewed.withColumn(
        "sorted",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    ).drop("windows").withColumn("n_repeat_words", _covered("sorted")).drop("sorted")


def _covered(column: str) -> Column:
    """Words under repeated windows, from the windows sorted by hash and place; null: none."""
    n = F.size(column)
    at = lambda i: F.element_at(column, i)
    same = lambda i, j: at(i)["h"] == at(j)["h"]
    places = F.array_sort(
        F.transform(
            F.filter(
                F.sequence(F.lit(1), n),
                lambda i: ((i > 1) & same(i, F.greatest(i - 1, F.lit(1))))
                | ((i < n) & same(i, F.least(i + 1, n))),
            ),
            lambda i: at(i)["i"],
        )
    )
    total = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("words"), F.lit(-WINDOW).alias("last")),
        lambda s, p: F.struct(
            (s["words"] + F.least(F.lit(WINDOW), p - s["last"])).alias("words"), p.alias("last")
        ),
        lambda s: s["words"],
    )
    return F.when(F.col(column).isNull(), F.lit(0).cast("long")).otherwise(total)


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules, as columns over the counts of `measures`; shares are of words or characters."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    symbols, caps = F.col("n_symbols") / words, F.col("n_upper") / chars
    repeats, length = F.col("n_repeat_words") / words, F.col("word_chars") / words
    variety = F.col("n_distinct") / words
    lines = F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))
    return {
        "symbols": vote(symbols < 0.05, symbols > 0.3),
        "capitals": vote(caps < 0.15, caps > 0.5),
        "repeated_words": vote(repeats < 0.1, repeats > 0.3),
        "repeated_lines": vote(lines < 0.2, (lines > 0.5) & (F.col("n_lines") >= 5)),
        "word_length": vote((length >= 3) & (length <= 10), (length < 2) | (length > 15)),
        "variety": vote(variety > 0.35, (variety < 0.25) & (F.col("n_words") >= 40)),
    }


def posterior(prior: float, accuracy: dict[str, tuple[float, float]]) -> Column:
    """Probability of good given the votes, with votes independent given the truth; `accuracy` has
    for each rule its accuracy on good and on bad documents on which it votes."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for name, (on_good, on_bad) in accuracy.items():
        odds = odds + (
            F.when(F.col(name) == 1, math.log(on_good / (1 - on_bad)))
            .when(F.col(name) == -1, math.log((1 - on_good) / on_bad))
            .otherwise(0.0)
        )
    return 1 / (1 + F.exp(-odds))


#: What the estimate starts from, and how many documents or votes that start counts for.
START_SHARE, START_GOOD, START_BAD, START_COUNT = 0.8, 0.995, 0.25, 5.0
#: Each rule looks for one fault of several: it rarely accuses a good document, and passes the
#: bad ones that have another fault. Votes are then never explained the other way round. The ranges
#: are narrow: with 0.5 to 0.9999 on good and any accuracy on bad documents, and the start counted for
#: up to a fifth of the rows, the most frequent fault becomes a trait of good documents and passes.
GOOD_RANGE, BAD_RANGE = (0.995, 0.999), (0.15, 0.35)


def estimate(
    votes: DataFrame, names: list[str], rounds: int = 20, tolerance: float = 1e-4
) -> tuple[float, dict[str, tuple[float, float]]]:
    """(share of good, accuracies of each rule when it votes) by expectation-maximisation.

    Every round is one aggregate over the table of vote patterns that returns one row. The start
    says which side is good; it also counts as a few votes, so that a rule that hardly votes stays
    near it. Accuracies stay within GOOD_RANGE and BAD_RANGE. Without rows: the start.
    """
    patterns = spool(votes.groupBy(*names).agg(F.count("*").alias("n")), "patterns")  # at most 3^rules rows
    prior, accuracy = START_SHARE, dict.fromkeys(names, (START_GOOD, START_BAD))

    def inside(x: float, low: float, high: float) -> float:
        return min(high, max(low, x))

    for _ in range(rounds):
        good = posterior(prior, accuracy)
        sums = [F.sum("n").alias("all"), F.sum(F.col("n") * good).alias("good")]
        for name in names:
            for side, share in (("good", good), ("bad", 1 - good)):
                right = F.col(name) == (1 if side == "good" else -1)
                sums.append(F.sum(F.when(right, F.col("n") * share).otherwise(0.0)).alias(f"right_{side}_{name}"))
                sums.append(F.sum(F.when(F.col(name) != 0, F.col("n") * share).otherwise(0.0)).alias(f"votes_{side}_{name}"))
        row = patterns.agg(*sums).first()
        if not row["all"]:
            break
        share = lambda part, whole, start: (part + START_COUNT * start) / (whole + START_COUNT)
        new_prior = inside(share(row["good"], row["all"], START_SHARE), 0.05, 0.99)
        new = {
            k: (
                inside(share(row[f"right_good_{k}"], row[f"votes_good_{k}"], START_GOOD), *GOOD_RANGE),
                inside(share(row[f"right_bad_{k}"], row[f"votes_bad_{k}"], START_BAD), *BAD_RANGE),
            )
            for k in names
        }
        moved = max(abs(new_prior - prior), *(abs(x - y) for k in names for x, y in zip(new[k], accuracy[k], strict=True)))
        prior, accuracy = new_prior, new
        if moved < tolerance:
            break
    return prior, accuracy


def quality_by_votes(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts of `measures`, the votes, `posterior`, base_failed and kept for each row.

    base_failed: fewer than 20 words, or over 30 % of the words repeat in 8-word windows. kept is
    false for those and else says whether the posterior reaches the threshold. A null or empty
    text has no words and fails; repeated rows and null ids are judged one by one; ties cannot
    arise, as no row is ranked. Without rows the result is empty.
    """
    counted = spool(measures(docs, id_col, text_col), "measures")
    all_rules = rules()
    voted = counted.select("*", *[c.alias(f"vote_{k}") for k, c in all_rules.items()])
    names = [f"vote_{k}" for k in all_rules]
    good = posterior(*estimate(voted, names))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return voted.withColumn("posterior", good).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)
    )
