"""Quality rules as a ledger of failure bits, read by versioned policies.

Each document is measured once. Every rule turns the measurements into one bit
(set when the rule fails), so a policy is a mask, a verdict is ``bits & mask``
and an ablation is counting over the few distinct values of ``bits``.

Defined cases: a null text has no words and no lines; a document without words
fails ``too_few_words`` only. Repeated rows and null ids are measured like any
other row. Input columns called like the column added are replaced by it; other
columns stay.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_alpha_words")
_MEASURES = pa.struct([(name, pa.int64()) for name in _NAMES])


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str


#: Position in the tuple is the bit. A rule is only ever appended, so stored ledgers stay readable.
RULES: tuple[Rule, ...] = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "n_words > 0 and word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("few_letters", "100 * n_alpha_words < 70 * n_words"),
    Rule("too_many_words", "n_words > 100000"),
)

#: Policies by version: the rules that reject. Version 1 is the base alone.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("too_few_words", "repeated_windows"),
    "v2": ("too_few_words", "repeated_windows", "symbols", "short_words", "long_words", "repeated_lines", "few_letters"),
}


def measured(text: str | None) -> dict[str, int]:
    """The measurements of one text."""
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    seen: set[str] = set()
    lines = repeats = 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            lines += 1
            repeats += line in seen
            seen.add(line)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(map(text.count, _SYMBOLS)),
            "n_lines": lines, "n_dup_lines": repeats, "n_repeat_words": _repeat_words(words),
            "n_alpha_words": sum(map(str.isalpha, (w.strip(".,;:!?'\"()[]-") for w in words)))}


def _repeat_words(words: list[str]) -> int:
    """Words inside a window of three words that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    once: set[tuple] = set()
    again = {w for w in windows if w in once or once.add(w)}
    covered, end = 0, 0
    for i, window in enumerate(windows):
        if window in again:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


@F.arrow_udf(StructType([StructField(name, LongType()) for name in _NAMES]))
def _measure(texts: pa.Array) -> pa.Array:
    return pa.array([measured(t) for t in texts.to_pylist()], _MEASURES)


_measure = _measure.asNondeterministic()  # a filter on the result must not run it a second time


def mask(rules: tuple[str, ...]) -> int:
    """The bits of the rules called so."""
    at = {r.name: i for i, r in enumerate(RULES)}
    return sum(1 << at[name] for name in set(rules))


def ledger(docs: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with a struct of all measurements and ``bits``, one bit per failed rule."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()]
    found = docs.select(*kept, _measure(F.col(f"`{text}`")).alias(into))
    bits = sum((F.when(F.expr(re.sub(r"\b(n_\w+|word_chars)\b", rf"`{into}`.\1", rule.fails)), F.lit(1 << i)).otherwise(F.lit(0))
                for i, rule in enumerate(RULES)), F.lit(0))
    return found.withColumn(into, F.col(f"`{into}`").withField("bits", bits.cast("long")))


def accepts(policy: str, into: str = "quality") -> Column:
    """True for documents without a failed rule of the policy."""
    return F.col(f"`{into}`.bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(ledgers: DataFrame, policy: str, into: str = "quality") -> DataFrame:
    """For each rule of the policy: documents failing it, and those that only it rejects.

    The documents are first counted by ``bits``; everything after works on at most
    two to the power of the number of rules rows.
    """
    chosen = POLICIES[policy]
    whole = mask(chosen)
    counts = ledgers.groupBy(F.col(f"`{into}`.bits").alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("long").alias("bit")) for r in chosen])
    each = counts.select("n", F.col("bits").bitwiseAND(F.lit(whole)).alias("bits"), F.inline(rules))
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
        F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("n_rejected"))
