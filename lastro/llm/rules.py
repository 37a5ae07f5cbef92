"""Quality rules kept as a ledger of failure bits, with versioned policies and ablations."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.text import WHITE, text_of, words

#: Name of a rule and the measurements with which a document fails it; the place is its bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "5 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 30 * n_words",
    "exclamations": "3 * n_exclaimed > n_words",
}


@dataclass(frozen=True)
class Policy:
    """A version of the filter: the rules that count."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << bit for bit, name in enumerate(RULES) if name in self.rules)


POLICIES: Mapping[str, Policy] = {
    "base": Policy("base", ("few_words", "repeated_windows")),
    "v1": Policy("v1", tuple(RULES)),
}


def measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows with their measurements in a struct ``_m``; no shuffle, every rule's inputs measured once.

    ``n_repeat_words`` counts the words in 3-word windows that occur twice or more in a text: windows are
    hashed to 64 bits with their place, sorted, and a window counts when a neighbour has its hash.
    """
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), text_of(docs[text_column]).alias("_t"))
    held = held.withColumn("_w", words(F.col("_t")))
    held = held.withColumn(
        "_s",
        F.expr(
            "CASE WHEN size(_w) < 4 THEN cast(array() AS array<struct<h: bigint, p: int>>) ELSE sort_array("
            "transform(sequence(0, size(_w) - 3), i -> struct(xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2)) AS h,"
            " i AS p))) END"
        ),
    )
    held = held.withColumn(
        "_p", F.expr("transform(filter(_s, (x, k) -> x.h = get(_s, k - 1).h OR x.h = get(_s, k + 1).h), x -> x.p)")
    )
    held = held.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.trim(x, F.lit(WHITE)) != ""))
    return held.select(
        "_row",
        F.struct(
            F.size("_w").cast("long").alias("n_words"),
            F.expr("aggregate(_w, 0L, (a, x) -> a + length(x))").alias("word_chars"),
            F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            F.expr("size(array_distinct(flatten(transform(_p, p -> array(p, p + 1, p + 2)))))")
            .cast("long").alias("n_repeat_words"),
            F.size("_l").cast("long").alias("n_lines"),
            F.expr("size(filter(_w, x -> endswith(x, '!')))").cast("long").alias("n_exclaimed"),
        ).alias("_m"),
    )


def failure_bits(measured: Column) -> Column:
    """One bit per rule, set where the rule fails."""
    bits = F.lit(0).cast("long")
    for bit, condition in enumerate(RULES.values()):
        failed = F.expr(_on_struct(condition))
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def _on_struct(condition: str) -> str:
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaimed"):
        condition = condition.replace(name, f"_m.{name}")
    return condition


def ledger(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``_row`` (all input columns), ``_m`` (measurements) and ``_bits`` (failed rules).

    Null and empty texts measure zero and fail ``few_words``.  The input columns stay inside ``_row``, so
    names cannot clash.  Repeated rows each get their own ledger row; an empty table gives an empty ledger.
    """
    measured = measures(docs, text_column)
    # Always true, but not known before a row is read: a filter on the bits stays above them.  Pushed below, it would
    # be rewritten on the text and build the arrays of a text anew for each of their elements.
    once = F.monotonically_increasing_id() >= 0
    return measured.withColumn("_bits", F.when(once, failure_bits(F.col("_m"))))


def passes(bits: Column, policy: Policy) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policy(docs: DataFrame, policy: Policy, text_column: str = "text") -> DataFrame:
    """The documents that no rule of the policy rejects, with their own columns."""
    return ledger(docs, text_column).where(passes(F.col("_bits"), policy)).select("_row.*")


def ablations(bits: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: rows it fails, rows only it fails, rows kept when it is left out.

    ``bits`` needs the column ``_bits``.  Equal bit patterns are counted first (at most 2^rules rows).
    """
    patterns = bits.groupBy("_bits").agg(F.count("*").alias("n"))
    parts = []
    for bit, name in enumerate(RULES):
        if name in policy.rules:
            own, mask = F.lit(1 << bit).cast("long"), F.lit(policy.mask).cast("long")
            parts.append(F.struct(
                F.lit(name).alias("rule"),
                F.when(F.col("_bits").bitwiseAND(own) != 0, F.col("n")).otherwise(0).alias("failed"),
                F.when(F.col("_bits").bitwiseAND(mask) == own, F.col("n")).otherwise(0).alias("only"),
                F.when(F.col("_bits").bitwiseAND(mask.bitwiseXOR(own)) == 0, F.col("n")).otherwise(0).alias("kept"),
            ))
    one = patterns.select(F.explode(F.array(*parts)).alias("x"))
    return one.groupBy(F.col("x.rule").alias("rule")).agg(
        F.sum("x.failed").alias("n_failed"),
        F.sum("x.only").alias("n_failed_only_this"),
        F.sum("x.kept").alias("n_kept_without"),
    )
