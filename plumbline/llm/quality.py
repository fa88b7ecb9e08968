"""Quality filter: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, boxed, stage, thin, words_of

SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the and of to in is that it for with was on are as be this by at from or an not have "
    "der die und das ist den von mit für auf dem ein eine nicht im zu des sich als auch "
    "le la les des et de du un une est que qui dans pour pas sur avec elle au en "
    "el los las que y del se por con una no su para al lo como más"
).split()
#: A word as prose has it: letters, perhaps joined, perhaps with one closing mark.
PLAIN_WORD = r"^[(\"'\u00ab\u201c]?\p{L}+([-'\u2019]\p{L}+)*[.,;:!?)\"'\u00bb\u201d]?$"
_UPPER = string.ascii_uppercase + "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"


def text_facts(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """``rows`` with the columns the rules look at, in place of the text.

    Everything is an expression on one row: the words and the sorted three-word
    windows live only inside the row, so nothing is shuffled.
    """
    text = F.col(text_col)
    other = [c for c in rows.columns if c != text_col]
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE, "") != "")
    step = rows.select(*other, text_col, words_of(text).alias("w"), lines.alias("l"))
    windows = F.when(
        F.size("w") >= 3,
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size("w") - 3),
                lambda i: F.struct(
                    F.concat_ws(" ", *[F.get("w", i + k) for k in range(3)]).alias("s"),
                    i.alias("i"),
                ),
            )
        ),
    ).otherwise(F.expr("array()").cast("array<struct<s:string,i:int>>"))
    bare = F.translate(text, SPACE, "")
    step = step.select(
        *other,
        F.size("w").cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(bare) - F.length(F.translate(bare, _UPPER, ""))).cast("long").alias("n_upper"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.size(F.filter("w", lambda x: x.isin(*sorted(set(FUNCTION_WORDS))))).cast("long")
        .alias("n_function"),
        F.size(F.filter("w", lambda x: x.rlike(PLAIN_WORD))).cast("long").alias("n_plain"),
        windows.alias("v"),
    )

    def same(x, i):
        return F.coalesce(x["s"] == F.get("v", i)["s"], F.lit(False))

    twice = F.filter("v", lambda x, i: same(x, i - 1) | same(x, i + 1))
    covered = F.flatten(
        F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
    )
    return step.withColumn(
        "n_repeat_words", F.size(F.array_distinct(covered)).cast("long")
    ).drop("v")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Vote:
    """``good`` and ``bad`` are conditions in SQL; where neither holds the rule abstains."""

    name: str
    good: str
    bad: str


#: Thresholds are shares of words, letters or lines; several rules only ever accuse.
RULES = (
    Vote("function words", "n_function >= 0.08 * n_words", "n_function < 0.02 * n_words"),
    Vote("plain words", "n_plain >= 0.9 * n_words", "n_plain < 0.7 * n_words"),
    Vote("symbols", "false", "n_symbols > 0.2 * n_words"),
    Vote("capitals", "n_upper < 0.15 * word_chars", "n_upper > 0.4 * word_chars"),
    Vote("lines", "false", "n_lines >= 4 and n_dup_lines > 0.3 * n_lines"),
    Vote("windows", "false", "n_repeat_words > 0.3 * n_words"),
    Vote("vocabulary", "n_distinct > least(0.3 * n_words, 120)", "n_distinct < least(0.2 * n_words, 20)"),
    Vote("length", "word_chars between 3 * n_words and 10 * n_words",
         "word_chars < 2 * n_words or word_chars > 20 * n_words"),
)
#: Shares of (good, abstain, bad) votes that a rule starts with, by class.
START = {"good": (0.6, 0.35, 0.05), "bad": (0.1, 0.4, 0.5)}
#: Votes of evidence that this start is worth.
START_WEIGHT = 20.0


def _vote_names(rules) -> list[str]:
    return [f"vote_{k}" for k in range(len(rules))]


def with_votes(facts: DataFrame, rules: tuple[Vote, ...] = RULES) -> DataFrame:
    """One column per rule: 1 good, -1 bad, 0 abstains."""
    votes = {
        name: F.expr(f"cast(case when {r.bad} then -1 when {r.good} then 1 else 0 end as int)")
        for name, r in zip(_vote_names(rules), rules)
    }
    return facts.withColumns(votes)


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents and, per rule, the log odds that each vote speaks for good."""

    prior: float
    weights: tuple[dict[int, float], ...]

    def log_odds(self, votes) -> float:
        start = math.log(self.prior / (1 - self.prior))
        return start + sum(w[v] for w, v in zip(self.weights, votes))

    def posterior(self, names: list[str]) -> Column:
        """Chance that the document is good, from its vote columns."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, w in zip(names, self.weights):
            total = total + F.when(F.col(name) > 0, w[1]).when(F.col(name) < 0, w[-1]).otherwise(w[0])
        return 1 / (1 + F.exp(-total))


def fit_votes(
    patterns: dict[tuple[int, ...], int], n_rules: int, share: float = 0.8, rounds: int = 200
) -> VoteModel:
    """Expectation-maximisation over vote patterns and their counts.

    ``share`` is the share of good ones that it starts with.

    Each round computes the chance of every pattern to be good, then each rule's
    shares of right, missing and wrong votes in both classes. ``START`` keeps
    "good" from turning into "bad" and stands alone where there are no patterns.
    """
    outcomes = (1, 0, -1)

    def weights(good, bad):
        return tuple(
            {v: math.log(g[v] / sum(g.values()) * sum(b.values()) / b[v]) for v in outcomes}
            for g, b in zip(good, bad)
        )

    def fresh(kind):
        return [
            {v: START_WEIGHT * p for v, p in zip(outcomes, START[kind])} for _ in range(n_rules)
        ]

    total = sum(patterns.values())
    ordered = sorted(patterns.items())
    model = VoteModel(share, weights(fresh("good"), fresh("bad")))
    for _ in range(rounds):
        good, bad, mass = fresh("good"), fresh("bad"), 0.0
        for votes, count in ordered:
            p = 1 / (1 + math.exp(min(700.0, -model.log_odds(votes))))
            mass += p * count
            for k, vote in enumerate(votes):
                good[k][vote] += p * count
                bad[k][vote] += (1 - p) * count
        before, model = model, VoteModel(
            (mass + share * START_WEIGHT) / (total + START_WEIGHT), weights(good, bad)
        )
        if all(abs(a[v] - b[v]) < 1e-9 for a, b in zip(before.weights, model.weights) for v in a):
            break
    return model


def vote_model(voted: DataFrame, rules: tuple[Vote, ...] = RULES) -> VoteModel:
    """Fit on every document of 50 words or more; shorter ones fail whatever the votes.

    The driver gets one number per vote pattern, at most 3 ** rules of them.
    """
    names = _vote_names(rules)
    rows = voted.filter("n_words >= 50").groupBy(*names).count().collect()
    return fit_votes({tuple(r[n] for n in names): r["count"] for r in rows}, len(names))


def judge(voted: DataFrame, rules: tuple[Vote, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """``voted`` with ``base_failed, p_good, kept``."""
    model = vote_model(voted, rules)
    return (
        voted.withColumn("p_good", model.posterior(_vote_names(rules)))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
        .drop(*_vote_names(rules))
    )


def quality(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """One row per input row: ``doc_id``, the counts, ``p_good, base_failed, kept``.

    A null text counts as empty and fails the base rules, as does any text under
    50 words. Repeated rows are judged alike. Other columns are ignored. An empty
    table gives an empty result. The counts are written once; the votes are
    counted and applied on that thin table.
    """
    facts = stage(text_facts(thin(df, id_col, text_col)), "facts")
    return judge(with_votes(facts), threshold=threshold)


def filter_quality(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The input rows that ``quality`` keeps, with their own columns only."""
    rows = boxed(df, id_col, text_col).select("row", "text")
    facts = stage(text_facts(rows), "facts")
    kept = judge(with_votes(facts), threshold=threshold).filter("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in df.columns])
