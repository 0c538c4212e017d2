"""Quality filtering by weak supervision, with DataFrame expressions only.

Each rule votes that a document is good (1) or bad (-1), or abstains (0). Equal vote patterns
are counted, an expectation-maximisation on those counts (at most 3 to the number of rules)
estimates how each rule votes on good and on bad documents, and the posterior
probability of being good is a column again. No labels are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import written

# Fixed values of the contract.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "[#*$%&|<>]"
WINDOW_WORDS, FEWEST_WORDS, MOST_REPEATED = 8, 20, 30

MARKS = r"""[!"#$%&*/<=>\[\\\]^_`{|}~]"""
UPPER = "[A-Z]"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Further counts that only the rules use.
MORE = ("n_lines", "n_other", "n_upper", "n_marks", "n_stops", "n_distinct")


@dataclass(frozen=True)
class Rule:
    """``good`` and ``bad`` are SQL conditions on the counts in struct ``q``; neither: abstain."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "q.n_words >= 60", "q.n_words < 12"),
    Rule("word_length", "q.word_chars between 3 * q.n_words and 8 * q.n_words",
         "q.word_chars < 2 * q.n_words or q.word_chars > 16 * q.n_words"),
    Rule("symbols", "false", "q.n_symbols > 0.2 * q.n_words"),
    Rule("characters", "q.n_other <= 0.02 * q.word_chars", "q.n_other > 0.06 * q.word_chars"),
    Rule("capitals", "false", "q.n_upper > 0.3 * q.word_chars"),
    Rule("marks", "false", "q.n_marks > 0.2 * q.n_words"),
    Rule("lines", "false", "q.n_dup_lines > 0.6 * q.n_lines"),
    Rule("repeats", "false", "q.n_repeat_words > 0.28 * q.n_words"),
    Rule("variety", "false", "q.n_words >= 25 and q.n_distinct < 0.12 * q.n_words"),
    Rule("sentences", "q.n_stops between 0.03 * q.n_words and 0.5 * q.n_words",
         "q.n_words >= 40 and q.n_stops < 0.002 * q.n_words"),
)


def _count(pattern: str) -> Column:
    return F.regexp_count("__t", F.lit(pattern))


def counts(docs: DataFrame) -> DataFrame:
    """Add struct ``q`` with FEATURES and MORE (long) of each whole ``text``; null counts as empty.

    n_repeat_words: words are hashed in the row, then windows of eight as pairs of pairs of
    pairs; a text without two equal windows, which most are, stops there. Otherwise windows are
    sorted by hash with their places, equal neighbours keep their places, and the words they
    cover are counted.
    """
    spaces = F.lit(SPACE_CHARS)
    steps = docs.withColumn("__t", F.coalesce(F.col("text").cast("string"), F.lit("")))
    steps = steps.withColumn("__b", F.btrim("__t", spaces))
    steps = steps.withColumn("__w", F.when(F.col("__b") == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split("__b", SPACE_CLASS), lambda x: F.xxhash64(x))))
    steps = steps.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, spaces) != ""))
    steps = steps.withColumn("__2", F.expr("transform(__w, (x, i) -> xxhash64(x, get(__w, i + 1)))"))
    last = WINDOW_WORDS - 1
    steps = steps.withColumn("__h", F.when(F.size("__w") > last, F.slice(F.expr(
        "transform(__2, (x, i) -> xxhash64(x, get(__2, i + 2), get(__2, i + 4), get(__2, i + 6)))"),
        1, F.size("__w") - last)).otherwise(F.array().cast("array<bigint>")))
    repeated = """aggregate(
        transform(array(sort_array(transform(array(sort_array(transform(__h, (x, i) -> struct(x, i)))), s ->
            transform(filter(sequence(0, size(s) - 1), k ->
                coalesce(get(s, k - 1).x = get(s, k).x, false) or coalesce(get(s, k + 1).x = get(s, k).x, false)),
                k -> get(s, k).i))[0])),
            p -> aggregate(transform(p, (x, i) -> least(%d, coalesce(get(p, i + 1) - x, %d))), 0L, (a, b) -> a + b)),
        0L, (a, b) -> a + b)""" % (WINDOW_WORDS, WINDOW_WORDS)
    steps = steps.withColumn("__r", F.when(F.size(F.array_distinct("__h")) == F.size("__h"), F.lit(0).cast("long"))
                             .otherwise(F.expr(repeated)))
    longs = {
        "n_words": F.size("__w"), "word_chars": F.length("__t") - _count(SPACE_CLASS[:-1]), "n_symbols": _count(SYMBOLS),
        "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")), "n_repeat_words": F.col("__r"),
        "n_lines": F.size("__l"), "n_other": _count(MARKS), "n_upper": _count(UPPER), "n_marks": _count("!"),
        "n_stops": _count("[.?]"), "n_distinct": F.size(F.array_distinct("__w")),
    }
    q = F.struct(*[longs[n].cast("long").alias(n) for n in FEATURES + MORE])
    return steps.withColumn("q", q).drop("__t", "__b", "__w", "__l", "__2", "__h", "__r")


def vote(rule: Rule) -> Column:
    return F.expr(f"CASE WHEN {rule.bad} THEN -1 WHEN {rule.good} THEN 1 ELSE 0 END")


def base_failed() -> Column:
    return (F.col("q.n_words") < FEWEST_WORDS) | (
        100 * F.col("q.n_repeat_words") > MOST_REPEATED * F.col("q.n_words"))


@dataclass(frozen=True)
class Model:
    """P(good) and, per rule, P(vote | good) and P(vote | bad) for the votes -1, 0, 1."""

    good: float
    on_good: tuple[tuple[float, float, float], ...]
    on_bad: tuple[tuple[float, float, float], ...]

    def weight(self, rule: int, cast: int) -> float:
        """Log-odds that a vote adds; an abstention says nothing."""
        if not cast:
            return 0.0
        return math.log(self.on_good[rule][cast + 1] / self.on_bad[rule][cast + 1])

    def log_odds(self, votes: list[Column]) -> Column:
        out = F.lit(math.log(self.good / (1 - self.good)))
        for r, v in enumerate(votes):
            out = out + F.when(v == 1, self.weight(r, 1)).when(v == -1, self.weight(r, -1)).otherwise(0.0)
        return out


# Where estimation starts: a rule votes bad on 20 of 100 bad and 1 of 1000 good documents.
START_GOOD, START_BAD = (0.001, 0.2, 0.799), (0.2, 0.16, 0.64)
# Share of good documents before any vote is seen. Abstentions say nothing, so it is not estimated.
SHARE_GOOD = 0.8


def estimate(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 200, held: float = 20.0,
             good: float = SHARE_GOOD) -> Model:
    """Expectation-maximisation on counted vote patterns.

    Each rate is held near its start by ``held`` votes, so none reaches 0 or 1. Without any
    pattern the starting rates come back.
    """
    on_good, on_bad = [START_GOOD] * n_rules, [START_BAD] * n_rules
    for _ in range(rounds):
        model = Model(good, tuple(on_good), tuple(on_bad))
        sums = [0.0, 0.0]
        cast = [[[0.0] * 3 for _ in range(n_rules)] for _ in range(2)]
        for votes, n in patterns:
            z = math.log(good / (1 - good)) + sum(model.weight(r, v) for r, v in enumerate(votes))
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))
            for kind, share in ((0, n * p), (1, n * (1 - p))):
                sums[kind] += share
                for r, v in enumerate(votes):
                    cast[kind][r][v + 1] += share
        on_good, on_bad = (
            [tuple((x + held * s) / (sums[kind] + held) for x, s in zip(row, start)) for row in cast[kind]]
            for kind, start in ((0, START_GOOD), (1, START_BAD)))
        moved = [abs(x - y) for a, b in ((model.on_good, on_good), (model.on_bad, on_bad))
                 for p, q in zip(a, b) for x, y in zip(p, q)]
        if max(moved, default=0.0) < 1e-9:
            break
    return Model(good, tuple(on_good), tuple(on_bad))


def fit(counted: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """Estimate the rules' rates over all rows of a table that has ``q``."""
    votes = [vote(r).cast("int").alias(f"v{i}") for i, r in enumerate(rules)]
    rows = counted.select(*votes).groupBy(*[f"v{i}" for i in range(len(rules))]).count().collect()
    return estimate(sorted((tuple(r[:-1]), r[-1]) for r in rows), len(rules))


def posterior(model: Model, rules: tuple[Rule, ...] = RULES) -> Column:
    """Probability that a row with ``q`` is good."""
    return 1 / (1 + F.exp(-model.log_odds([vote(r) for r in rules])))


def _verdict(model: Model, rules: tuple[Rule, ...], threshold: float) -> Column:
    p = posterior(model, rules)
    return F.struct("q.*", base_failed().alias("base_failed"), p.alias("posterior"),
                    (~base_failed() & (p >= threshold)).alias("kept"))


def verdicts(docs: DataFrame, *keys: str, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """(keys, the counts, base_failed, posterior, kept) of every row of a table with ``text``.

    The texts are read once; the counts are written to the shared folder, the rules' rates are
    estimated from all of them, and the verdicts come from the written counts. Null and empty
    texts fail the base rule, repeated rows are judged alike, null keys stay null, an empty
    table gives no rows.
    """
    counted = written(counts(docs.select(*keys, "text")).select(*keys, "q"), "counts")
    return counted.withColumn("__v", _verdict(fit(counted, rules), rules, threshold)).select(*keys, "__v.*")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are judged good, with all columns of ``docs``, whatever their names.

    The texts are read twice, once to count votes and once to judge, so that no second copy of
    them is written. Nothing but vote patterns is shuffled.
    """
    # A generator between the counts and the filter keeps the optimizer from working out every
    # count anew wherever the filter names it.
    model = fit(_fenced(counts(docs.select("text")), "q"), rules)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text")
    return _fenced(counts(inner), "__row", "q").where(_verdict(model, rules, threshold)["kept"]).select("__row.*")


def _fenced(counted: DataFrame, *columns: str) -> DataFrame:
    return counted.select(*[c for c in columns if c != "q"], F.explode(F.array("q")).alias("q"))
