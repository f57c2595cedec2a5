"""Quality rules as a short-circuit cascade, in built-in expressions only.

A rule rejects a document. The verdict is the same in any order, as one rejection is enough; the
order sets the cost. ``plan`` measures each rule on a sample and puts first the rule that rejects
most per unit of cost among the documents still there. ``cascade`` is one ``CASE``: a rule is not
evaluated for a document that an earlier one has rejected, nor are the measures only it needs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, let, words

SAMPLE_ROWS = 1000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")  # measures that the digest returns
OF_WORDS = {"n_words", "word_chars", "n_repeat_words"}  # measures of a text's words


def _windows(found: Column) -> Column:
    """The hash of the three words from each place; the last two places have no window."""
    return F.slice(
        F.transform(found, lambda w, i: F.xxhash64(w, F.get(found, i + 1), F.get(found, i + 2))), 1, F.size(found) - 2
    )


def _neighbours_equal(sorted_values: Column, key: Callable[[Column], Column]) -> Column:
    """Those of a sorted array whose key is that of the one before or after."""

    def repeated(value, at):
        before, after = F.get(sorted_values, at - 1), F.get(sorted_values, at + 1)
        return F.coalesce(key(before) == key(value), F.lit(False)) | F.coalesce(key(after) == key(value), F.lit(False))

    return F.filter(sorted_values, repeated)


def repeated_words(found: Column) -> Column:
    """Words that stand in a three-word window which the array holds twice or more.

    Hashes sorted with their places name the candidates; the windows themselves then decide.
    """

    def candidates(hashes):
        bits = F.length(F.bin(F.size(hashes).cast("bigint")))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
        packed = F.transform(hashes, lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("bigint")))
        return let(
            F.sort_array(packed),
            lambda s: F.transform(
                _neighbours_equal(s, lambda v: F.call_function("shiftright", v, bits)),
                lambda v: v.bitwiseAND(mask).cast("int"),
            ),
        )

    def certain(places):
        windows = F.transform(
            places,
            lambda i: F.struct(
                F.concat_ws(" ", F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)).alias("t"), i.alias("i")
            ),
        )
        return let(F.sort_array(windows), lambda s: F.transform(_neighbours_equal(s, lambda e: e["t"]), lambda e: e["i"]))

    def covered(places):
        steps = F.transform(places, lambda i, k: F.least(F.coalesce(F.get(places, k + 1) - i, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)

    # Without three words there is no window; slice needs a length that is not negative.
    return F.when(F.size(found) < 3, F.lit(0).cast("bigint")).otherwise(
        let(
            _windows(found),
            lambda h: let(candidates(h), lambda c: let(F.sort_array(certain(c)), covered)),
        )
    )


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


class Measures:
    """What rules may ask about a document: an expression per measure, made only when asked for.

    ``given`` names columns that hold a measure already.
    """

    def __init__(self, text: Column, found: Column | None, given: Iterable[str] = ()):
        # found is used many times, so it must be a column or a bound variable.
        self.text, self.found, self.given = F.coalesce(text, F.lit("")), found, set(given)

    def __getattr__(self, name: str) -> Column:
        if name in self.__dict__.get("given", ()):
            return F.col(name)
        make = {
            "n_words": lambda: F.size(self.found).cast("bigint"),
            "word_chars": lambda: F.length(F.array_join(self.found, "")).cast("bigint"),
            "n_symbols": lambda: self._removed(r"[#*$%&|<>]+"),
            "n_lines": lambda: F.size(_lines(self.text)).cast("bigint"),
            "n_dup_lines": lambda: let(
                _lines(self.text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")
            ),
            "n_repeat_words": lambda: repeated_words(self.found),
            "n_letters": lambda: F.length(F.regexp_replace(self.text, r"\P{L}+", "")).cast("bigint"),
            "n_upper": lambda: self._removed("[A-Z]+"),
        }.get(name)
        if make is None:
            raise AttributeError(name)
        return make()

    def _removed(self, pattern: str) -> Column:
        return (F.length(self.text) - F.length(F.regexp_replace(self.text, pattern, ""))).cast("bigint")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], Column]


BASE_RULES = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
RULES = BASE_RULES + (
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > m.n_lines),
    Rule("word_length", lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 15 * m.n_words)),
    Rule("few_letters", lambda m: 10 * m.n_letters < 6 * m.word_chars),
    Rule("shouting", lambda m: 2 * m.n_upper > m.n_letters),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float  # seconds for the sample
    rejected: float  # share of the sample


def estimate(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, given=()) -> tuple:
    """Cost and selectivity of each rule on a sample, and how often each pattern of verdicts occurs.

    The sample is the first ``sample_rows`` rows, so it costs a few input splits at any size. It
    decides the order of the rules and nothing else.
    """
    sample = docs.select(text, *given).limit(sample_rows).persist()
    verdicts = {f"r{i}": rejected_by([rule], text, given).isNotNull() for i, rule in enumerate(rules)}
    patterns = sample.select(*[v.alias(k) for k, v in verdicts.items()]).groupBy(*verdicts).count().collect()

    def seconds(column: Column) -> float:
        took = []
        for _ in range(2):
            start = time.perf_counter()
            sample.select(column.alias("x")).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        return min(took)

    idle = seconds(rejected_by([], text, given).isNotNull())  # the words, which the rules share
    costs = [max(seconds(v) - idle, 1e-4) for v in verdicts.values()]
    sample.unpersist()
    counts = {tuple(bool(row[k]) for k in verdicts): row["count"] for row in patterns}
    total = max(1, sum(counts.values()))
    rejected = [sum(n for p, n in counts.items() if p[i]) / total for i in range(len(rules))]
    return [Estimate(*x) for x in zip(rules, costs, rejected, strict=True)], counts


def order(estimates: list[Estimate], counts: dict) -> list[Rule]:
    """The rules by rejections per cost, each among the documents that those before it leave."""
    left, alive, chosen = list(range(len(estimates))), dict(counts), []
    while left:
        rate = {i: sum(n for p, n in alive.items() if p[i]) / estimates[i].cost for i in left}
        best = max(left, key=lambda i: (rate[i], -estimates[i].cost, -i))
        chosen.append(estimates[best].rule)
        left.remove(best)
        alive = {p: n for p, n in alive.items() if not p[best]}
    return chosen


def plan(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, given=()) -> list[Rule]:
    return order(*estimate(docs, rules, text, sample_rows, given))


def rejected_by(rules: Iterable[Rule], text: str = "text", given=()) -> Column:
    """The first of the rules that rejects a document, null if none does. What is ``given`` is not computed anew,
    and the words are not found where all measures of them are given."""

    def cascade(found):
        measures = Measures(F.col(text), found, given)
        chain = F.when(F.lit(False), F.lit(""))  # a chain to hang the rules on
        for rule in rules:
            chain = chain.when(rule.rejects(measures), F.lit(rule.name))
        return chain

    return cascade(None) if set(given) >= OF_WORDS else let(words(F.col(text)), cascade)


def keep(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, all columns as they are.

    A null text has no words. Repeated rows are judged alike; other columns are not looked at.
    An empty table stays empty.
    """
    return docs.where(rejected_by(plan(docs, rules, text, sample_rows), text).isNull())


def _counted(docs: DataFrame) -> DataFrame:
    """The rows, which have a ``text``, with the measures of ``BASE``."""
    found = docs.withColumn("found", words(F.col("text")))
    measures = Measures(F.col("text"), F.col("found"))
    return found.select(*docs.columns, *[getattr(measures, name).alias(name) for name in BASE])


def digest(docs: DataFrame) -> DataFrame:
    """Counts of every document with the base verdict and that of the whole cascade.

    One row per input row: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``. A null text counts as empty and fails.
    """
    counted = _counted(docs.select("doc_id", "text"))
    failed = rejected_by(BASE_RULES, given=BASE).isNotNull()
    # The order is that of rules as they run here: on counted rows that the base rules leave.
    sample = _counted(docs.select("text").limit(SAMPLE_ROWS)).where(~failed)
    ordered = plan(sample, RULES[len(BASE_RULES) :], given=BASE)
    kept = ~failed & rejected_by(ordered, given=BASE).isNull()
    return counted.select("doc_id", *BASE, failed.alias("base_failed"), kept.alias("kept"))
