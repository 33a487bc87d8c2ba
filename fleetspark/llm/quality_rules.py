"""Quality rules as weak supervision.

Each rule votes good (1) or bad (-1) on a document, or abstains (0).
Expectation-maximisation estimates how often each rule is right on good and on
bad documents, from the votes alone, and the posterior probability of "good"
replaces an all-must-pass filter.

The rules see whole texts and are computed row by row with built-in functions.
The estimation needs only the counts of the vote patterns (at most 3 to the
power of the number of rules, whatever the corpus), so each of its rounds is an
aggregation over a small table and returns one row of sums.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import WORD_RUN, discard, text_or_empty, where_computed, words_of, written

SYMBOLS = "#*$%&|<>"
SYMBOL_RUN = r"[#*$%&|<>]{2,}"
#: Letters with the marks that prose puts around a word.
PLAIN = r"""^[("'«„“‘¿¡]*\p{L}[\p{L}\p{M}'’-]*[.,;:?!)"'»”’]{0,3}$"""
WINDOW = 5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, else bad where ``bad`` holds, else abstains."""

    name: str
    good: str
    bad: str

    def vote(self) -> Column:
        return F.when(F.expr(self.good), 1).when(F.expr(self.bad), -1).otherwise(0).cast("tinyint")


#: SQL conditions over the statistics of ``with_stats``; a null condition abstains.
RULES = (
    Rule("length", "n_words >= 40", "n_words < 15"),
    Rule("symbols", "100 * n_symbols <= n_words", "20 * n_symbols > n_words"),
    Rule("symbol_runs", "n_symbol_runs = 0", "20 * n_symbol_runs > n_words"),
    Rule("lone_marks", "50 * n_marks <= n_words", "10 * n_marks > n_words"),
    Rule("plain_words", "4 * n_plain >= 3 * n_words", "2 * n_plain < n_words"),
    Rule("line_copies", "20 * n_dup_lines <= n_lines", "4 * n_dup_lines > n_lines"),
    Rule("repeats", "25 * n_repeat_words <= n_words", "10 * n_repeat_words > n_words"),
    Rule("capitals", "4 * n_upper <= n_letters and n_letters > 0", "2 * n_upper > n_letters"),
    Rule("sentences", "60 * n_stops >= n_words and 2 * n_stops <= n_words", "200 * n_stops < n_words or n_stops > n_words"),
    Rule("shouting", "50 * n_shouts <= n_words", "10 * n_shouts > n_words"),
)


def _chars(text: Column, of: str) -> Column:
    """How many characters of ``text`` are in the string ``of``."""
    return (F.length(text) - F.length(F.translate(text, of, ""))).cast("long")


def _repeated_positions(ranked: Column) -> Column:
    """Ascending start positions of windows that occur twice or more; ``ranked`` is the sorted column of (h, i).

    It must be a column, not an expression: a lambda would compute it again for each element.
    """
    alike = lambda x, y: x["h"].eqNullSafe(y["h"])
    marked = F.transform(
        ranked,
        lambda x, j: F.when((j > 0) & alike(x, F.get(ranked, j - 1)) | alike(x, F.get(ranked, j + 1)), x["i"]),
    )
    return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))


def _covered(starts: Column) -> Column:
    """Words that windows at these ascending starts cover together."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        starts,
        zero,
        lambda a, s: F.struct((a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n"), s.alias("last")),
        lambda a: a["n"],
    )


def with_stats(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and the statistics that the rules read.

    Null texts count as empty. Windows of five words are compared by a 64-bit
    hash inside one document; no row leaves its place.
    """
    none = F.array().cast("array<bigint>")
    df = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], text_or_empty(text_col).alias("_t"))
    df = df.withColumn("_w", words_of(F.col("_t")))
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    df = df.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD_RUN)))
    df = df.withColumn(
        "_g",
        F.when(
            F.size("_h") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("_h") - WINDOW),
                lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(none),
    )
    df = df.withColumn("_g", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.col("_g")).otherwise(none))
    df = df.withColumn("_r", F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_p", _repeated_positions(F.col("_r")))
    text = F.col("_t")
    letters = F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long")
    return df.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        F.size("_w").cast("long").alias("n_words"),
        (F.length(text) - _chars(text, " \t\n\x0b\f\r")).cast("long").alias("word_chars"),
        _chars(text, SYMBOLS).alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("_p")).alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        letters.alias("n_letters"),
        F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        (F.size(F.split(text, SYMBOL_RUN)) - 1).cast("long").alias("n_symbol_runs"),
        F.size(F.filter("_w", lambda w: ~w.rlike(r"[\p{L}\p{N}]"))).cast("long").alias("n_marks"),
        F.size(F.filter("_w", lambda w: w.rlike(PLAIN))).cast("long").alias("n_plain"),
        _chars(text, ".?;:").alias("n_stops"),
        _chars(text, "!").alias("n_shouts"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


#: Where the estimation starts: most documents are good, and rules say bad of few good ones but miss many bad ones.
PRIOR, RIGHT_GOOD, RIGHT_BAD = 0.8, 0.95, 0.6


@dataclass
class LabelModel:
    """Estimated share of good documents, and per rule the chance to be right on good and on bad ones."""

    prior: float
    right_good: list[float]
    right_bad: list[float]

    def posterior(self, votes: list[Column]) -> Column:
        """Probability of "good" given vote columns; abstentions say nothing."""
        logit = F.lit(math.log(self.prior / (1 - self.prior)))
        for v, p, q in zip(votes, self.right_good, self.right_bad, strict=True):
            up, down = math.log(p / (1 - q)), math.log((1 - p) / q)
            logit = logit + F.when(v == 1, F.lit(up)).when(v == -1, F.lit(down)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once: lambdas compute plain expressions again wherever they stand."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fit(patterns: DataFrame, n_rules: int, rounds: int = 25, strength: float = 50.0) -> LabelModel:
    """Expectation-maximisation over counted vote patterns (columns v0.., n).

    The patterns, at most 3 ** n_rules, become one array, and one expression
    does all rounds on it. ``strength`` pseudo-votes at the starting values steady rules that
    seldom vote. Rules are right on good documents more often than not (0.55 to
    0.99), so that "good" cannot come to mean "bad"; a rule that says good of
    nearly every document is seldom right on bad ones (down to 0.05), and its
    vote then weighs little. An empty table gives the starting values.
    """
    rules = F.sequence(F.lit(0), F.lit(n_rules - 1))
    bound = lambda x, lo, hi: F.greatest(F.lit(lo), F.least(F.lit(hi), x))
    total = lambda xs, of: F.aggregate(xs, F.lit(0.0), lambda a, x: a + of(x))
    shrunk = lambda part, whole, at: (part + at * strength) / (whole + strength)

    def good(x: Column, m: Column) -> Column:
        """Expected number of good documents among those of a pattern."""

        def weight(j: Column) -> Column:
            v, p, q = F.get(x["v"], j), F.get(m["p"], j), F.get(m["q"], j)
            return F.when(v == 1, F.log(p / (1 - q))).when(v == -1, F.log((1 - p) / q)).otherwise(F.lit(0.0))

        logit = F.log(m["prior"] / (1 - m["prior"])) + total(rules, weight)
        return x["n"] / (1 + F.exp(-logit))

    def accuracies(xs: Column, vote: int, count: str, at: float, least: float) -> Column:
        right = lambda j: total(F.filter(xs, lambda x: F.get(x["v"], j) == vote), lambda x: x[count])
        voted = lambda j: total(F.filter(xs, lambda x: F.get(x["v"], j) != 0), lambda x: x[count])
        return F.transform(rules, lambda j: bound(shrunk(right(j), voted(j), at), least, 0.99))

    def maximised(xs: Column) -> Column:
        return F.struct(
            bound(shrunk(total(xs, lambda x: x["good"]), total(xs, lambda x: x["n"]), PRIOR), 0.05, 0.95).alias("prior"),
            accuracies(xs, 1, "good", RIGHT_GOOD, 0.55).alias("p"),
            accuracies(xs, -1, "bad", RIGHT_BAD, 0.05).alias("q"),
        )

    def one_round(m: Column, _: Column) -> Column:
        split = F.transform(
            F.col("patterns"),
            lambda x: _bind(good(x, m), lambda g: F.struct(x["n"].alias("n"), x["v"].alias("v"), g.alias("good"), (x["n"] - g).alias("bad"))),
        )
        return _bind(split, maximised)

    start = F.struct(F.lit(PRIOR).alias("prior"), F.array_repeat(F.lit(RIGHT_GOOD), n_rules).alias("p"), F.array_repeat(F.lit(RIGHT_BAD), n_rules).alias("q"))
    votes = F.array(*[F.col(f"v{j}").cast("int") for j in range(n_rules)])
    one = patterns.agg(F.sort_array(F.collect_list(F.struct(votes.alias("v"), F.col("n").cast("double").alias("n")))).alias("patterns"))
    model = one.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, one_round).alias("m")).first()["m"]
    return LabelModel(model["prior"], list(model["p"]), list(model["q"]))


def _votes(rules: tuple[Rule, ...]) -> list[Column]:
    return [r.vote().alias(f"v{j}") for j, r in enumerate(rules)]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, the statistics, ``base_failed``, ``posterior`` and ``kept``.

    The accuracies come from the documents that pass the base rules: what those
    rules reject needs no verdict and would be a group of its own.

    Defined cases: a null text is empty (no words, so ``base_failed``); repeated
    rows each get their row; a null id stays null; an empty table gives no
    rows; other columns are ignored, whatever their names.
    """
    stats = with_stats(docs, text_col, (id_col,))
    rows = written(stats.select(id_col, *STATS, base_failed().alias("base_failed"), *_votes(rules)), "quality-votes")
    columns = [f"v{j}" for j in range(len(rules))]
    patterns = written(rows.filter("not base_failed").groupBy(*columns).agg(F.count("*").alias("n")).coalesce(1), "quality-patterns")
    posterior = F.round(fit(patterns, len(rules)).posterior([F.col(c) for c in columns]), 9)
    return rows.select(id_col, *STATS, "base_failed", posterior.alias("posterior")).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns.

    The statistics are computed once: rows that pass the base rules are written
    with their votes, the votes are counted, and the rows read back are filtered.
    Defined cases are those of ``quality_rules``: null, empty and wordless texts
    fail the base rules and go, repeated rows stay or go together.
    """
    kept = tuple(docs.columns)
    names = [f"c{i}" for i in range(len(kept))]
    renamed = docs.toDF(*names)
    stats = with_stats(renamed, names[kept.index(text_col)], tuple(names))
    columns = [f"v{j}" for j in range(len(rules))]
    voted = stats.select(*names, base_failed().alias("base_failed"), *_votes(rules))
    good = written(where_computed(voted, ~F.col("base_failed")).drop("base_failed"), "quality-good")
    patterns = written(good.groupBy(*columns).agg(F.count("*").alias("n")).coalesce(1), "quality-patterns")
    posterior = fit(patterns, len(rules)).posterior([F.col(c) for c in columns])
    discard(patterns)
    return good.filter(F.round(posterior, 9) >= threshold).select(*names).toDF(*kept)
