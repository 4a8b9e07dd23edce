"""Quality rules as weak supervision.

Rules vote for (1) or against (-1) a document or abstain (0). Documents with
the same votes are alike, so the corpus is summed up by the count of each vote
pattern, of which there are at most 3 to the power of the rules. On these counts
expectation-maximisation estimates how often each rule is right and how many
documents are good; the posterior probability that a document is good replaces
the demand that it pass every rule.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import col, unused
from millrace.session import materialise

#: What separates words, as a Java pattern and as characters; symbols.
_BLANKS = "[\\x20\\x09-\\x0D]+"
_BLANK_CHARS = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_digits", "n_stops"]


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def with_metrics(df: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The rows with the counts of ``METRICS``; a NULL text has none of anything.

    ``columns`` are those to keep (all); a column called like a metric is replaced.
    """
    keep = [c for c in (df.columns if columns is None else columns) if c not in METRICS]
    body, words, lines, grams, n, at = unused(df.select(*[col(c) for c in keep]), "body__", "words__", "lines__", "grams__", "n__", "at__")
    kept = [col(c) for c in keep]
    rows = df.select(*kept, F.coalesce(col(text), F.lit("")).alias(body))
    rows = rows.select(
        *kept, body,
        F.array_remove(F.split(body, _BLANKS), "").alias(words),
        F.filter(F.split(body, "\n"), lambda line: F.length(_without(line, _BLANK_CHARS)) > 0).alias(lines),
    )
    size = F.length(body)
    bare = F.length(_without(F.col(body), _BLANK_CHARS))
    rows = rows.select(
        *kept, words,
        F.size(words).alias(n),
        F.size(words).cast("long").alias("n_words"),
        bare.cast("long").alias("word_chars"),
        (size - F.length(_without(F.col(body), _SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
        (size - F.length(_without(F.col(body), "0123456789"))).cast("long").alias("n_digits"),
        (size - F.length(_without(F.col(body), ".!?"))).cast("long").alias("n_stops"),
    )
    others = [m for m in METRICS if m != "n_repeat_words"]
    windows = F.greatest(F.col(n) - 2, F.lit(0))
    # Sorted windows of three words with their places: equal ones are neighbours.
    zipped = F.arrays_zip(*[F.slice(words, k, windows).alias(f"w{k}") for k in (1, 2, 3)], F.when(windows > 0, F.sequence(F.lit(0), windows - 1)).otherwise(F.array().cast("array<int>")).alias("i"))
    rows = rows.select(*kept, *others, F.sort_array(zipped).alias(grams))

    def alike(a: Column, b: Column) -> Column:
        return (a["w1"] == b["w1"]) & (a["w2"] == b["w2"]) & (a["w3"] == b["w3"])

    def repeated(x: Column, i: Column) -> Column:
        return F.coalesce(alike(x, F.get(grams, i + 1)), F.lit(False)) | F.coalesce(alike(x, F.get(grams, i - 1)), F.lit(False))

    rows = rows.select(*kept, *others, F.sort_array(F.transform(F.filter(grams, repeated), lambda x: x["i"])).alias(at))
    steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select(*kept, *others, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Votes 1 where ``good`` holds, else -1 where ``bad`` holds, else abstains (0).

    Most rules know one defect and abstain where they don't find it: that a
    document lacks one defect says nothing about another.
    """

    name: str
    bad: str
    good: str = "false"

    def vote(self) -> Column:
        return F.when(F.coalesce(F.expr(self.good), F.lit(False)), 1).when(F.coalesce(F.expr(self.bad), F.lit(False)), -1).otherwise(0)


#: Rules that vote for a document look at all defects: that it lacks one says nothing about another.
_CLEAN = "50 * n_symbols <= n_words and 100 * n_repeat_words <= 20 * n_words and 10 * n_dup_lines <= n_lines"
RULES = (
    Rule("length", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 45 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines and n_lines >= 10"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 14 * n_words"),
    Rule("digits", "10 * n_digits > 3 * word_chars"),
    Rule("sentences", "n_words > 200 * n_stops", f"n_words <= 60 * n_stops and n_words >= 50 and {_CLEAN}"),
    Rule("vocabulary", "n_distinct_words * 10 < n_words and n_distinct_words < 100", f"n_distinct_words * 3 >= n_words and n_words >= 80 and {_CLEAN}"),
)
#: A rule's accuracy to begin with, its bounds, and the share of all documents that the beginning is worth.
ACCURACY, LEAST, MOST, SHARE = 0.8, 0.6, 0.99, 0.01
#: The share of good documents that a document without votes is thought to be from.
BALANCE = 0.5


@dataclass(frozen=True)
class Model:
    """Each rule's accuracy: how often it is right when it votes."""

    accuracies: tuple[float, ...]
    balance: float
    rounds: int

    def posterior(self, votes: Sequence[Column]) -> Column:
        odds = F.lit(math.log(self.balance / (1 - self.balance)))
        for vote, a in zip(votes, self.accuracies):
            odds += vote * F.lit(math.log(a / (1 - a)))
        return 1 / (1 + F.exp(-odds))


def fit(patterns: Sequence[tuple[tuple[int, ...], int]], rounds: int = 200, tolerance: float = 1e-9, balance: float = BALANCE) -> Model:
    """Expectation-maximisation over (votes, documents).

    A rule's accuracy is the share of its votes that agree with what the
    documents are thought to be, and that in turn follows from all votes on
    them. Accuracies start at ``ACCURACY`` and stay within ``LEAST`` and
    ``MOST``. The balance of good and bad is given, not learned: learned, it
    would outvote every rule where bad documents are rare. No documents leave
    the accuracies as they start.
    """
    rules, total = len(patterns[0][0]) if patterns else 0, sum(n for _, n in patterns)
    accuracies, done = [ACCURACY] * rules, 0
    for done in range(1, rounds + 1 if total else 1):
        right, voted = [SHARE * total * ACCURACY] * rules, [SHARE * total] * rules
        for votes, n in patterns:
            odds = math.log(balance / (1 - balance)) + sum(v * math.log(a / (1 - a)) for v, a in zip(votes, accuracies))
            good = 1 / (1 + math.exp(-odds))
            for j, v in enumerate(votes):
                if v:
                    right[j] += n * (good if v > 0 else 1 - good)
                    voted[j] += n
        new = [min(MOST, max(LEAST, r / v)) for r, v in zip(right, voted)]
        moved = max((abs(a - b) for a, b in zip(new, accuracies)), default=0.0)
        accuracies = new
        if moved < tolerance:
            break
    return Model(tuple(accuracies), balance, done)


def judge(df: DataFrame, text: str = "text", columns: list[str] | None = None, rules: Sequence[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """The rows with metrics, votes (``votes``), ``posterior``, ``base_failed`` and ``kept``.

    ``kept`` is false where the base rule fails, else whether the posterior
    reaches ``threshold``. Rows are written once, in ``columns`` (all), with
    their counts. NULL and empty texts fail the base rule. Equal rows are
    judged alike. Columns called like a result are replaced. An empty table
    gives no rows.
    """
    own = ["votes", "posterior", "base_failed", "kept"]
    keep = [c for c in (df.columns if columns is None else columns) if c not in [*METRICS, *own]]
    rows = with_metrics(df, text, keep).withColumn("votes", F.array(*[r.vote() for r in rules]))
    rows = materialise(rows, "judged", compression="zstd")
    counts = rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    model = fit([(tuple(r["votes"]), r["n"]) for r in counts.orderBy("votes").collect()])
    posterior = model.posterior([F.col("votes")[i] for i in range(len(rules))])
    rows = rows.withColumns({"posterior": posterior, "base_failed": base_failed()})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
