"""Quality rules as weak supervision: rules vote, EM weighs them, a posterior decides.

Every rule reads the figures of one text and votes good (1), bad (-1) or abstains (0).
Expectation maximisation over the counts of the vote patterns estimates how often each
rule is right on good and on bad documents, and how many documents are good. A
document's posterior probability of being good then follows from its votes alone.

Only DataFrame functions touch rows. What reaches the driver is one row per vote
pattern, at most 3 to the number of rules, whatever the table's size; what goes back
are two numbers per rule, as literals.

Defined cases: a null or empty text has no words, fails the base rule and is not kept;
a table without documents gives an empty result; rows are judged one by one, so repeated
rows and ids have equal verdicts. Extra columns are ignored by :func:`judged`.
Windows of eight words are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import WORD, kept

#: Words in a repeated window.
WINDOW = 8
SYMBOLS = r"[^#*$%&|<>]+"
LETTERLESS = r"[\p{L}]+"


@dataclass(frozen=True)
class Rule:
    """``value`` (SQL over the figures): ``good`` and ``bad`` are conditions on it."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("symbols", "n_symbols = 0 AND n_words >= 20", "n_symbols > 0.05 * word_chars"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 12 * n_words AND n_words >= 20", "word_chars > 20 * n_words OR word_chars < 2 * n_words"),
    Rule("duplicate_lines", "n_dup_lines = 0 AND n_lines > 1", "n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("repeated_windows", "n_repeat_words = 0 AND n_words >= 50", "4 * n_repeat_words > n_words"),
    Rule("letters", "10 * n_letters >= 9 * word_chars AND n_words > 0", "10 * n_letters < 7 * word_chars"),
    Rule("distinct_words", "2 * n_distinct >= n_words AND n_words >= 20", "5 * n_distinct < n_words AND n_words >= 50"),
)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a window of WINDOW words found twice or more.

    Windows are hashed and sorted with their places; neighbours of equal hash repeat.
    Linear arithmetic over the sorted places of the repeats then counts covered words.
    Texts without a repeat, nearly all, stop after a set of long values.
    """

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    def covered(keys: Column) -> Column:
        placed = F.array_sort(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))

        def repeats(rows: Column) -> Column:
            last = F.size(rows) - 1
            same = lambda i, j: F.get(rows, i)["key"] == F.get(rows, j)["key"]
            return F.filter(
                rows,
                lambda _, i: ((i > 0) & F.coalesce(same(i, i - 1), F.lit(False)))
                | ((i < last) & F.coalesce(same(i, i + 1), F.lit(False))),
            )

        found = bound(placed, repeats)
        places = F.array_sort(F.transform(found, lambda row: row["at"]))
        gaps = lambda at: F.aggregate(
            F.transform(
                at,
                lambda here, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - here, F.lit(WINDOW))),
            ),
            F.lit(0).cast("long"),
            lambda total, gap: total + gap,
        )
        return bound(places, gaps)

    def counted(keys: Column) -> Column:
        clean = F.size(F.array_distinct(keys)) == F.size(keys)
        return F.when(clean, F.lit(0).cast("long")).otherwise(covered(keys))

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) > WINDOW, bound(bound(hashes, windows), counted)).otherwise(F.lit(0).cast("long"))


def figures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its id and the figures that rules read."""
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        F.col(doc_id).alias("doc_id"),
        body.alias("body"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(body, "\n", -1), lambda line: line.rlike(WORD)).alias("lines"),
    )
    long = lambda column: column.cast("long")
    joined = F.concat_ws("", "words")
    return split.select(
        "doc_id",
        long(F.size("words")).alias("n_words"),
        long(F.length(joined)).alias("word_chars"),
        long(F.length(F.regexp_replace("body", SYMBOLS, ""))).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        long(F.size("lines")).alias("n_lines"),
        long(F.length("body") - F.length(F.regexp_replace("body", LETTERLESS, ""))).alias("n_letters"),
        long(F.size(F.array_distinct("words"))).alias("n_distinct"),
    )


def vote(rule: Rule) -> Column:
    return F.when(F.expr(rule.bad), -1).when(F.expr(rule.good), 1).otherwise(0)


@dataclass(frozen=True)
class Accuracies:
    """Share of good documents; per rule the rates of its good and bad votes, among good
    documents and among bad ones."""

    prior: float
    on_good: tuple[tuple[float, float], ...]
    on_bad: tuple[tuple[float, float], ...]

    def evidence(self) -> tuple[float, list[tuple[float, float]]]:
        """Log odds of the prior, and what each rule's good and bad vote adds.

        A rule counts as no worse than chance: its good vote never lowers the odds and
        its bad vote never raises them. That also names the two hidden classes.
        """
        each = [
            (max(0.0, math.log(g[0] / b[0])), min(0.0, math.log(g[1] / b[1])))
            for g, b in zip(self.on_good, self.on_bad, strict=True)
        ]
        return math.log(self.prior / (1 - self.prior)), each


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 200) -> Accuracies:
    """EM over (votes, count); half a vote of each kind smooths every rate."""
    state = Accuracies(0.8, ((0.8, 0.05),) * rules, ((0.5, 0.3),) * rules)
    for _ in range(rounds):
        base, weights = state.evidence()
        good, bad = 1.5, 1.5
        tallies = [[0.5, 0.5, 0.5, 0.5] for _ in range(rules)]
        for votes, count in patterns:
            odds = base + sum(weights[j][0 if v > 0 else 1] for j, v in enumerate(votes) if v)
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            good += count * p
            bad += count * (1 - p)
            for tally, v in zip(tallies, votes, strict=True):
                if v:
                    tally[0 if v > 0 else 1] += count * p
                    tally[2 if v > 0 else 3] += count * (1 - p)
        state = Accuracies(
            good / (good + bad),
            tuple((t[0] / good, t[1] / good) for t in tallies),
            tuple((t[2] / bad, t[3] / bad) for t in tallies),
        )
    return state


def posterior(accuracies: Accuracies, rules: tuple[Rule, ...]) -> Column:
    base, weights = accuracies.evidence()
    odds = F.lit(base)
    for rule, (up, down) in zip(rules, weights, strict=True):
        v = F.col(f"vote_{rule.name}")
        odds = odds + F.when(v > 0, up).when(v < 0, down).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judged(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    least: float = 0.5,
) -> DataFrame:
    """Per document its figures, base_failed, posterior (p_good), kept and the votes."""
    read = figures(docs, doc_id, text)
    voted = kept(read.select("*", *[vote(rule).alias(f"vote_{rule.name}") for rule in rules]), "quality")
    names = [f"vote_{rule.name}" for rule in rules]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    # What the base rule refuses is decided; its many like votes would hide the rest.
    patterns = [
        (tuple(row[name] for name in names), row["seen"])
        for row in voted.where(~failed).groupBy(*names).agg(F.count("*").alias("seen")).collect()
    ]
    accuracies = estimate(patterns, len(rules))
    scored = voted.select("*", failed.alias("base_failed"), posterior(accuracies, rules).alias("p_good"))
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("p_good") >= least)).alias("kept"),
        "p_good",
        *names,
    )
