"""Quality rules learned as decision lists.

Statistics of a text are Spark expressions. From labelled statistics, sequential
covering grows conjunctions of thresholds that catch poor texts, prunes each on
rows it was not grown on, and leaves an ordered list of conditions that becomes
one Spark CASE expression. Everything runs on DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import SPACE_PATTERN, let, plain_text, quoted
from facetforge.storage import materialise

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Cuts tried for a feature: these quantiles of the poor and of the good rows.
POOR_QUANTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9)
GOOD_QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999)
# A list has at most so many rules of so many conditions; a rule must be right
# for this share of the pruning rows it catches, and catch this many.
MAX_RULES = 8
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_CAUGHT = 5

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """How many words stand in a 3-word window that occurs again in the text.

    Windows become numbers with their hash above and their place below; sorted,
    equal windows are neighbours. Their words are compared, so equal hashes of
    different windows do not count unless such a stranger stands between.
    """

    def count(w: Column) -> Column:
        n = F.size(w)
        bits = F.length(F.bin(n))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1

        def window(i: Column) -> Column:
            hashed = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            return F.call_function("shiftleft", hashed, bits).bitwiseOR(i.cast("bigint"))

        def equal(a: Column, b: Column) -> Column:
            """Whether two windows are the same; false if b is none."""
            high = F.call_function("shiftrightunsigned", a, bits) == F.call_function(
                "shiftrightunsigned", b, bits
            )
            p, q = (x.bitwiseAND(mask).cast("int") for x in (a, b))
            same = [F.get(w, p + k) == F.get(w, q + k) for k in range(3)]
            return F.coalesce(high & same[0] & same[1] & same[2], F.lit(False))

        def covered(keys: Column) -> Column:
            again = F.filter(
                keys,
                lambda x, i: equal(x, F.get(keys, i - 1)) | equal(x, F.get(keys, i + 1)),
            )
            places = F.transform(again, lambda x: x.bitwiseAND(mask))
            return F.size(
                F.array_distinct(
                    F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))
                )
            )

        windows = F.transform(F.sequence(F.lit(0), n - 3), window)
        return F.when(n >= 3, let(F.sort_array(windows), covered)).otherwise(0)

    return let(words, count)


def text_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_upper and n_marks (all long) of the whole text, and base_failed.

    Words stand between white space. word_chars counts code points in words,
    n_symbols the characters ``#*$%&|<>``, n_dup_lines the lines with a word that
    equal an earlier line, n_repeat_words the words in 3-word windows found twice
    or more, n_upper A-Z, n_marks ``!``. NULL and empty texts have zeros and
    fail the base rules. Columns of the input with these names are replaced.
    """
    text = plain_text(text_column)
    new = [*STATISTICS, "n_upper", "n_marks", "base_failed"]
    kept = [quoted(c) for c in docs.columns if c.lower() not in new]
    words = F.array_remove(F.split(text, SPACE_PATTERN), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))

    def occurrences(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    counted = docs.select(
        *kept,
        of_words.alias("_of_words"),
        occurrences(f"[{SYMBOLS}]").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
        occurrences("[A-Z]").alias("n_upper"),
        occurrences("!").alias("n_marks"),
    )
    n_words, repeat = F.col("_of_words.n_words"), F.col("_of_words.n_repeat_words")
    return counted.select(
        *kept,
        n_words.cast("long").alias("n_words"),
        F.col("_of_words.word_chars").cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        repeat.cast("long").alias("n_repeat_words"),
        "n_upper",
        "n_marks",
        ((n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)).alias(
            "base_failed"
        ),
    )


def features() -> dict[str, Column]:
    """What the rules may look at: shares, so that length alone decides little."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "chars_per_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "marks_per_word": F.col("n_marks") / words,
        "upper_share": F.col("n_upper") / chars,
        "repeat_share": F.col("n_repeat_words") / words,
        "dup_lines_per_word": F.col("n_dup_lines") / words,
    }


@dataclass(frozen=True)
class Condition:
    """feature >= cut, or feature < cut."""

    feature: str
    at_least: bool
    cut: float

    def column(self, values: dict[str, Column]) -> Column:
        value = values[self.feature]
        return value >= F.lit(self.cut) if self.at_least else value < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.cut:g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order, each a conjunction that marks a text as poor. The first
    that holds decides; texts that none catches are good."""

    rules: tuple[tuple[Condition, ...], ...]

    def rule_number(self, values: dict[str, Column]) -> Column:
        """Number of the first rule that holds, from 1; 0 if none does."""
        branches = [
            (F.lit(i + 1), _all_of(rule, values)) for i, rule in enumerate(self.rules)
        ]
        if not branches:
            return F.lit(0)
        number, holds = branches[0]
        chain = F.when(holds, number)
        for number, holds in branches[1:]:
            chain = chain.when(holds, number)
        return chain.otherwise(0)

    def __str__(self) -> str:
        lines = [" and ".join(map(str, rule)) + ": poor" for rule in self.rules]
        return "\n".join([*lines, "else: good"])


def _all_of(rule: tuple[Condition, ...], values: dict[str, Column]) -> Column:
    holds = F.lit(True)
    for condition in rule:
        holds = holds & F.coalesce(condition.column(values), F.lit(False))
    return holds


def _cuts(labelled: DataFrame, names: list[str]) -> dict[str, list[float]]:
    """Candidate cuts of each feature, from quantile sketches."""

    def quantiles(name: str, poor: bool, at: tuple[float, ...]) -> Column:
        value = F.when(F.col("poor") == poor, F.col(name))
        return F.percentile_approx(value, F.array(*map(F.lit, at)), F.lit(10_000))

    row = labelled.agg(
        *[
            F.concat(
                F.coalesce(quantiles(n, True, POOR_QUANTILES), F.array().cast("array<double>")),
                F.coalesce(quantiles(n, False, GOOD_QUANTILES), F.array().cast("array<double>")),
            ).alias(n)
            for n in names
        ]
    ).first()
    return {n: sorted(set(row[n])) for n in names}


def learn_decision_list(
    statistics: DataFrame,
    poor: Column,
    id_column: str = "doc_id",
    max_rules: int = MAX_RULES,
    max_conditions: int = MAX_CONDITIONS,
    min_precision: float = MIN_PRECISION,
    min_caught: int = MIN_CAUGHT,
) -> DecisionList:
    """Rules that catch rows where ``poor`` is true; rows where it is NULL are
    left out.

    All labelled rows count. They are reduced once to counts of cells (which
    cuts each feature reaches); each step then sums cells by feature and cut,
    so only features x cuts numbers come to the driver. Two thirds of the rows,
    by hash of the id, grow rules; the rest prune them. Without rows of both
    kinds the list is empty, and every text is good.
    """
    values = features()
    names = list(values)
    part = F.when(F.pmod(F.xxhash64(quoted(id_column)), F.lit(3)) == 0, "prune").otherwise("grow")
    labelled = materialise(
        statistics.select(
            poor.alias("poor"), part.alias("part"), *[c.alias(n) for n, c in values.items()]
        ).filter(F.col("poor").isNotNull()),
        "labelled",
    )
    cuts = _cuts(labelled, names)

    def reached(name: str) -> Column:
        """How many cuts of the feature the row reaches."""
        steps = [F.when(F.col(name) >= F.lit(c), 1).otherwise(0) for c in cuts[name]]
        return sum(steps, F.lit(0)).alias(name)

    cells = materialise(
        labelled.select("part", "poor", *[reached(n) for n in names])
        .groupBy("part", *names)
        .agg(F.count_if("poor").alias("bad"), F.count_if(~F.col("poor")).alias("good")),
        "cells",
    )
    # In cells, a condition compares the number of cuts reached.
    place = {n: {c: i + 1 for i, c in enumerate(cuts[n])} for n in names}

    def holds(rule) -> Column:
        found = F.lit(True)
        for c in rule:
            level = F.lit(place[c.feature][c.cut])
            found = found & (F.col(c.feature) >= level if c.at_least else F.col(c.feature) < level)
        return found

    def totals(rows: DataFrame) -> tuple[int, int]:
        bad, good = rows.agg(F.sum("bad"), F.sum("good")).first()
        return bad or 0, good or 0

    def best_condition(rows: DataFrame, bad: int, good: int) -> Condition | None:
        """The condition with the largest gain (as in FOIL) on these rows."""
        level = F.explode(
            F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names])
        )
        sums = (
            rows.select(level.alias("l"), "bad", "good")
            .groupBy("l.f", "l.b")
            .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
            .collect()
        )
        before = math.log2((bad + 1) / (bad + good + 2))
        best, chosen = 1e-9, None
        for n in names:
            for cut, step in place[n].items():
                for at_least in (True, False):
                    side = [r for r in sums if r["f"] == n and (r["b"] >= step) == at_least]
                    p, q = sum(r["bad"] for r in side), sum(r["good"] for r in side)
                    gain = p * (math.log2((p + 1) / (p + q + 2)) - before)
                    if gain > best:
                        best, chosen = gain, Condition(n, at_least, cut)
        return chosen

    rules: list[tuple[Condition, ...]] = []
    left = cells
    while len(rules) < max_rules:
        growing, pruning = (left.filter(F.col("part") == p) for p in ("grow", "prune"))
        rule: list[Condition] = []
        bad, good = totals(growing)
        while bad and good and len(rule) < max_conditions:
            found = best_condition(growing.filter(holds(rule)), bad, good)
            if found is None:
                break
            rule.append(found)
            bad, good = totals(growing.filter(holds(rule)))
        # Keep the beginning of the rule that does best on the pruning rows.
        sides = pruning.agg(
            *[
                F.coalesce(F.sum(F.when(holds(rule[: i + 1]), F.col(side))), F.lit(0))
                for i in range(len(rule))
                for side in ("bad", "good")
            ]
        ).first() if rule else ()
        scored = []
        for i in range(len(rule)):
            p, q = sides[2 * i], sides[2 * i + 1]
            if p >= min_caught and p >= min_precision * (p + q):
                scored.append(((p - q) / (p + q), p, -i))
        if not scored:
            break
        rule = rule[: 1 - max(scored)[2]]
        rules.append(tuple(rule))
        left = left.filter(~holds(rule))
    return DecisionList(tuple(rules))


def judge(statistics: DataFrame, rules: DecisionList) -> DataFrame:
    """Statistics with rule (the number of the first rule that holds, 0 if none)
    and kept: neither the base rules nor a learned rule speak against the text."""
    number = rules.rule_number(features())
    columns = [quoted(c) for c in statistics.columns if c.lower() not in ("rule", "kept")]
    return statistics.select(
        *columns, number.alias("rule"), (~F.col("base_failed") & (number == 0)).alias("kept")
    )


def label_poor(statistics: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Statistics with the column poor from labels (id, quality): true if any
    label of the id has quality 0, NULL without a label. Texts that fail the
    base rules are not labelled; no rule is needed for them."""
    known = labels.groupBy(quoted(id_column).alias("_label_id")).agg(
        (F.min("quality") == 0).alias("_label_poor")
    )
    poor = F.when(~F.col("base_failed"), F.col("_label_poor"))
    return statistics.join(known, quoted(id_column) == F.col("_label_id"), "left").select(
        *[quoted(c) for c in statistics.columns if c.lower() != "poor"], poor.alias("poor")
    )
