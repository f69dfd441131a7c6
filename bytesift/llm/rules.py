"""Quality rules as a short-circuit cascade, in Spark's own expressions only.

Each rule says when a text is rejected.  On a sample of the corpus every rule is
timed and its share of rejections is counted, among the rows that the rules before
it let through; the cascade asks the rules in order of rejections per cost, and a
row that one rule rejects is not shown to the next.
The order changes what a run costs, never what it keeps.
"""

from __future__ import annotations

import statistics
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bytesift.llm.store import WORD, stored

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEATED = 30  # of 100 words
# Rows of the sample on which rules are measured, about, and how often each is timed.
SAMPLE_ROWS = 2000
TIMES = 5


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over ``text`` and the measured columns; NULL rejects nothing."""

    name: str
    rejects: str


@dataclass(frozen=True)
class Measured:
    rule: Rule
    cost: float
    selectivity: float


# The rules of this repository, on the columns of ``measures``.
RULES = [
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("capitals", "length(regexp_replace(text, '[^A-Z]', '')) * 100 > 40 * word_chars"),
    Rule("few_letters", "length(regexp_replace(text, '[\\\\p{L}]', '')) * 100 > 60 * char_length(text)"),
    Rule("ellipsis", "10 * regexp_count(text, '[.][.][.][ \\\\t]*(\\\\n|$)') > 4 * n_lines"),
]

_NO_WORD = r"'[\\x20\\x09-\\x0D]+'"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def measures(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with what the rules look at, texts read whole.

    n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines and
    n_repeat_words; all 0 for a NULL or empty text.  A word is in n_repeat_words
    if a window of 8 words around it stands twice in the text.  Windows are
    compared by 64-bit hashes; only a text in which a hash repeats is looked at
    closer: its windows are sorted with their places, and the places of those
    with an equal neighbour tell which words are covered.
    """
    w = REPEAT_WINDOW
    window = ", ".join(f"h[i + {k}]" for k in range(w))
    hashes = _let("transform(_words, x -> xxhash64(x))", "h", f"transform(sequence(0, n_words - {w}), i -> xxhash64({window}))")
    same = "(i > 0 AND s[i - 1].h = x.h) OR (i + 1 < size(s) AND s[i + 1].h = x.h)"
    at = f"array_sort(transform(filter(s, (x, i) -> {same}), x -> x.i))"
    places = _let("sort_array(transform(_hashes, (x, i) -> named_struct('h', x, 'i', i)))", "s", at)
    covered = f"aggregate(sequence(1, size(p) - 1), {w}L, (a, i) -> a + least({w}, p[i] - p[i - 1]))"
    step1 = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "*", F.expr(f"array_remove(split(text, {_NO_WORD}), '')").alias("_words"),
        F.expr(r"filter(split(text, '\\n'), l -> rlike(l, '[^\\x20\\x09-\\x0D]'))").alias("_lines"),
    )
    step2 = step1.select(
        "doc_id", "text", "_words",
        F.size("_words").alias("n_words"),
        F.expr("CAST(char_length(array_join(_words, '')) AS BIGINT)").alias("word_chars"),
        F.expr("CAST(char_length(text) - char_length(regexp_replace(text, '[#*$%&|<>]', '')) AS BIGINT)").alias("n_symbols"),
        F.expr("CAST(size(_lines) AS BIGINT)").alias("n_lines"),
        F.expr("CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT)").alias("n_dup_lines"),
    )
    step3 = step2.withColumn("_hashes", F.expr(f"CASE WHEN n_words > {w} THEN {hashes} END"))
    repeated = f"CASE WHEN size(array_distinct(_hashes)) < size(_hashes) THEN {_let(places, 'p', covered)} ELSE 0L END"
    step4 = step3.withColumn("n_repeat_words", F.expr(repeated))
    return step4.withColumn("n_words", F.col("n_words").cast("long")).drop("_words", "_hashes")


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words")


def measure_rules(
    measured: DataFrame, rules: list[Rule] = RULES, rows: int = SAMPLE_ROWS, seed: int = 1, times: int = TIMES
) -> list[Measured]:
    """The rules in the order to ask them, with their cost and selectivity there.

    Costs and rejections come from a sample of about ``rows`` rows.  Only rows that
    pass the base are in it, as only these are ever asked.  They are stored first, so
    that a rule's time is its own; all rules are timed in turn, ``times`` over, the
    median of a pass without any rule is subtracted from a rule's median, and a rule
    within that pass's noise costs the noise.
    """
    total = measured.count()
    sample = measured if total <= rows else measured.sample(rows / total, seed)
    sample = stored(sample.where(~base_failed()), "rule-sample")

    def timed(condition: str) -> float:
        began = time.perf_counter()
        sample.agg(F.count_if(F.expr(condition))).first()
        return time.perf_counter() - began

    conditions = ["text IS NULL", *(rule.rejects for rule in rules)]
    for condition in conditions:  # not counted: compiles each pass
        timed(condition)
    spent = [[timed(c) for c in conditions] for _ in range(times)]
    idle, *each = [statistics.median(column) for column in zip(*spent)]
    noise = max(statistics.median(abs(row[0] - idle) for row in spent), 1e-4)
    by = F.array(*(F.coalesce(F.expr(rule.rejects), F.lit(False)) for rule in rules))
    together = {tuple(r["by"]): r["n"] for r in sample.groupBy(by.alias("by")).agg(F.count("*").alias("n")).collect()}
    return greedy(rules, [max(cost - idle, noise) for cost in each], together)


def in_order(measured: list[Measured]) -> list[Rule]:
    """Most rejections per cost first; ties by name."""
    return [m.rule for m in sorted(measured, key=lambda m: (-m.selectivity / m.cost, m.rule.name))]


def greedy(rules: list[Rule], costs: list[float], together: dict[tuple[bool, ...], int]) -> list[Measured]:
    """The rules in turn, each the best for the rows that those before it let through.

    ``together`` counts the rows by which of ``rules`` reject them.  A rule that only
    rejects what an earlier one has rejected comes late, however much it rejects alone.
    """
    left, out = dict(enumerate(rules)), []
    while left:
        alive = max(1, sum(together.values()))
        shares = {i: sum(n for by, n in together.items() if by[i]) / alive for i in left}
        made = {i: Measured(rule, costs[i], shares[i]) for i, rule in left.items()}
        first = in_order(list(made.values()))[0]
        i = next(i for i, rule in left.items() if rule == first)
        out.append(made[i])
        del left[i]
        together = {by: n for by, n in together.items() if not by[i]}
    return out


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects a row, NULL if none does.

    CASE evaluates its branches one after the other and stops at the first that
    holds, so later rules cost nothing for a row that is already rejected.
    """
    branches = " ".join(f"WHEN {rule.rejects} THEN '{rule.name}'" for rule in rules)
    return F.expr(f"CASE {branches} END") if rules else F.lit(None).cast("string")


def judge(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Each row of ``docs(doc_id, text)`` with its measures, base_failed,
    rejected_by (the first rule of the cascade that rejects it) and kept.

    ``rules`` in the order to ask them; by default RULES, ordered by measuring a
    sample.  A NULL text counts as empty and fails; repeated rows and NULL ids
    come out as they came in; other columns are not looked at.
    """
    measured = measures(docs)
    if rules is None:
        # the measures are taken once for a sample of documents, not for all
        total = docs.count()
        some = docs if total <= SAMPLE_ROWS else docs.sample(SAMPLE_ROWS / total, 1)
        rules = [m.rule for m in measure_rules(measures(some))]
    failed = measured.withColumn("base_failed", base_failed())
    asked = failed.withColumn("rejected_by", F.when(~F.col("base_failed"), cascade(rules)))
    return asked.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()).drop("text")
