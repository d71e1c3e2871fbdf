"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps what was measured and one bit for each rule that fails.
Policies are versioned sets of rules: applying one, or asking what each of its rules costs, only looks at the bits.
Everything here is DataFrame expressions.

Cases: a null text has no words, so it fails ``too_short``; an empty text likewise. Repeated rows are judged row by
row. Columns other than the id and the text are neither read nor returned, so their names cannot clash.
Windows of eight words are compared by 64-bit hashes of the hashes of their words, within one document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import bind

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that the text holds twice or more."""

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeated(ordered: Column) -> Column:
        def twin(entry: Column, i: Column) -> Column:
            same = [F.coalesce(F.get(ordered, i + k)["h"] == entry["h"], F.lit(False)) for k in (-1, 1)]
            return same[0] | same[1]

        return bind(F.sort_array(F.transform(F.filter(ordered, twin), lambda e: e["p"])), covered)

    def of_windows(windows: Column) -> Column:
        pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(
            F.size(F.array_distinct(windows)) < F.size(windows), bind(F.sort_array(pairs), repeated)
        ).otherwise(0)

    def of_hashes(hashes: Column) -> Column:
        starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
        return bind(F.transform(starts, lambda _, i: F.xxhash64(F.slice(hashes, i + 1, F.lit(WINDOW)))), of_windows)

    return bind(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def measurements(text: Column) -> Column:
    """A struct of everything the rules look at."""
    whole = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        bind(F.array_remove(F.split(whole, SPACE), ""), of_words).alias("words"),
        bind(lines, of_lines).alias("lines"),
        (F.length(whole) - F.length(F.regexp_replace(whole, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.length(whole) - F.length(F.replace(whole, F.lit("!"), F.lit("")))).cast("long").alias("n_exclaim"),
    )


MEASURED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaim"]


@dataclass(frozen=True)
class Rule:
    """A named condition under which a document fails; its bit never changes once ledgers are written."""

    name: str
    bit: int
    fails: Callable[[], Column]


RULES = [
    Rule("too_short", 0, lambda: F.col("n_words") < 20),
    Rule("repeated_windows", 1, lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    Rule("symbols", 2, lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("repeated_lines", 3, lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("word_length", 4, lambda: (F.col("word_chars") > 14 * F.col("n_words")) | (F.col("word_chars") < 2 * F.col("n_words"))),
    Rule("shouting", 5, lambda: 2 * F.col("n_exclaim") > F.col("n_words")),
]

#: Policies by version: the rules that a document must not fail.
POLICIES = {
    "base": ("too_short", "repeated_windows"),
    "prose-1": ("too_short", "repeated_windows", "symbols", "repeated_lines"),
    "prose-2": ("too_short", "repeated_windows", "symbols", "repeated_lines", "word_length", "shouting"),
}


def mask(policy: str, rules: list[Rule] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[name] for name in POLICIES[policy])


def ledger(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its measurements and ``fail_bits``."""
    measured = docs.select(F.col(id_col).alias("doc_id"), measurements(F.col(text_col)).alias("m")).select(
        "doc_id",
        *(F.col(f"m.words.{c}") for c in ("n_words", "word_chars", "n_repeat_words")),
        *(F.col(f"m.lines.{c}") for c in ("n_lines", "n_dup_lines")),
        "m.n_symbols",
        "m.n_exclaim",
    )
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(0).cast("long"))
    return measured.select("doc_id", *MEASURED, bits.alias("fail_bits"))


def apply_policy(entries: DataFrame, policy: str) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy."""
    return entries.withColumns(
        {
            "base_failed": F.col("fail_bits").bitwiseAND(F.lit(mask("base"))) != 0,
            "kept": F.col("fail_bits").bitwiseAND(F.lit(mask(policy) | mask("base"))) == 0,
        }
    )


def ablations(entries: DataFrame, policy: str, rules: list[Rule] = RULES) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail nothing else, and that are kept without it.

    Documents are first counted per bit pattern (at most 2^rules rows), so a rule costs no further pass.
    """
    named = [r for r in rules if r.name in POLICIES[policy]]
    patterns = (
        entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("bits"))
        .agg(F.count("*").alias("n"))
    )
    each = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in named)))
    has = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0
    return (
        patterns.select("bits", "n", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(has, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(has & rest, F.col("n")).otherwise(0)).alias("failed_alone"),
            F.sum(F.when(rest, F.col("n")).otherwise(0)).alias("kept_without"),
        )
    )
