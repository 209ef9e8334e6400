"""Quality rules kept as a ledger of failure bits.

Every rule is evaluated once per document. The ledger holds the measurements and one 64-bit mask
with a bit per failed rule. Policies, which are named and versioned sets of rules, then decide by
mask arithmetic alone, and ablations (what would a policy keep without rule r?) are counted for
all rules in one aggregate over the masks, without looking at a text again. All of it is built-in
column functions; nothing is shuffled but the sums of an ablation.

Defined results: a null text counts as empty; an empty text has no words, fails ``few_words`` and
no ratio rule. Measurements are of whole texts of any length. Columns other than those named are
passed over; repeated rows are judged each for itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BLANKS = r"[ \t\n\u000B\f\r]+"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A document fails a rule when ``fails``, SQL over the measurements, is true."""

    bit: int
    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """The rules that count; a document is kept when none of them failed."""

    version: str
    rules: tuple[str, ...]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _window_hash(words: Column, i: Column) -> Column:
    return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))


def _repeated_words(words: Column) -> Column:
    """Number of words that lie in a three-word window that occurs twice or more.

    Most texts have no such window, which their number of distinct hashes tells. For the others
    the hashes are sorted with their positions, so that equal windows are neighbours; the
    positions of those, and the two after each, are counted once.
    """
    places = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(places, lambda i: _window_hash(words, i))
    windows = F.transform(
        places, lambda i: F.struct(_window_hash(words, i).alias("h"), i.alias("i"))
    )

    def covered(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, k: (x["h"] == F.get(ordered, k + 1)["h"])
            | ((k > 0) & (x["h"] == F.get(ordered, F.greatest(k - 1, F.lit(0)))["h"])),
        )
        return F.size(F.array_distinct(F.flatten(
            F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        )))

    return (
        F.when(F.size(words) < 4, F.lit(0))
        .when(F.size(F.array_distinct(hashes)) == F.size(words) - 2, F.lit(0))
        .otherwise(_let(F.sort_array(windows), covered))
    )


def measure(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: its id and the measurements."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def measured(words: Column) -> Column:
        lines = _let(
            F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^ \t\n\u000B\f\r]")),
            lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")),
        )
        upper = F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", ""))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long")
            .alias("n_symbols"),
            lines.alias("lines"),
            _repeated_words(words).cast("long").alias("n_repeat_words"),
            upper.cast("long").alias("n_upper"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
        )

    # The generator is a barrier: the measurements are made once, however often they are named.
    words = F.array_remove(F.split(whole, BLANKS), "")
    return docs.select(
        F.col(id_column), F.inline(F.transform(F.array(words), measured))
    ).select(
        id_column, "n_words", "word_chars", "n_symbols",
        F.col("lines.n").cast("long").alias("n_lines"),
        (F.col("lines.n") - F.col("lines.d")).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "n_upper", "n_distinct_words",
    )


def standard_rules() -> tuple[Rule, ...]:
    """The rules this package ships. Bits are never reused for another meaning."""
    return (
        Rule(0, "few_words", "n_words < 50"),
        Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
        Rule(2, "long_words", "word_chars > 20 * n_words"),
        Rule(3, "short_words", "word_chars < 2 * n_words"),
        Rule(4, "symbols", "5 * n_symbols > n_words"),
        Rule(5, "repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
        Rule(6, "capitals", "2 * n_upper > word_chars"),
        Rule(7, "few_distinct_words", "n_distinct_words * n_distinct_words < n_words"),
    )


BASE = Policy("base-1", ("few_words", "repeated_windows"))
STANDARD = Policy("standard-1", tuple(r.name for r in standard_rules()))


def ledger(measured: DataFrame, rules: Iterable[Rule] | None = None) -> DataFrame:
    """Adds ``failed``, a mask with the bit of every rule that the document fails."""
    mask = F.lit(0).cast("long")
    for rule in rules or standard_rules():
        bit = F.when(F.coalesce(F.expr(rule.fails), F.lit(False)), F.lit(1 << rule.bit)).otherwise(0)
        mask = mask.bitwiseOR(bit.cast("long"))
    return measured.withColumn("failed", mask)


def policy_mask(policy: Policy, rules: Iterable[Rule] | None = None) -> int:
    bits = {r.name: 1 << r.bit for r in rules or standard_rules()}
    return sum(bits[name] for name in policy.rules)


def fails(policy: Policy, rules: Iterable[Rule] | None = None) -> Column:
    """Whether the policy rejects the row of a ledger."""
    return F.col("failed").bitwiseAND(F.lit(policy_mask(policy, rules)).cast("long")) != 0


def ablations(
    entries: DataFrame, policy: Policy, rules: Iterable[Rule] | None = None
) -> DataFrame:
    """Per rule of the policy: documents failing it, failing it alone, kept with and without it.

    One aggregate over the masks; a rule's ``only`` is what it alone keeps out.
    """
    mask = policy_mask(policy, rules)
    bits = {r.name: 1 << r.bit for r in rules or standard_rules() if r.name in policy.rules}
    hit = F.col("failed").bitwiseAND(F.lit(mask).cast("long"))
    sums = entries.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(hit == 0).alias("kept"),
        *[F.count_if(hit.bitwiseAND(F.lit(b).cast("long")) != 0).alias(f"any_{b}")
          for b in bits.values()],
        *[F.count_if(hit == b).alias(f"only_{b}") for b in bits.values()],
    )
    rows = F.array(*[
        F.struct(
            F.lit(policy.version).alias("policy"), F.lit(name).alias("rule"),
            F.col(f"any_{b}").alias("failed"), F.col(f"only_{b}").alias("only"),
            F.col("kept"), (F.col("kept") + F.col(f"only_{b}")).alias("kept_without"),
            F.col("documents"),
        )
        for name, b in bits.items()
    ])
    return sums.select(F.inline(rows))
