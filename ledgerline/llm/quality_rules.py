"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements
and one bit per failed rule; policies (versioned sets of rules) are applied to the
bits afterwards, and ablations (what a policy would keep without one of its
rules) are bitwise counts over the distinct masks, without touching a text again.

Only DataFrame functions; the ledger is one projection of the scan, without a
shuffle. ``store`` writes it once; policies and ablations read its few numbers from there.
Words are maximal runs without ASCII white space.

Defined results: null text has no words; empty text has one empty line; repeated
rows get a ledger row each; null ids are kept; other columns are ignored; an
empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import SPACES, let, written

#: The symbol characters that count as noise.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where ``fails`` (an expression over the measurements) holds."""
    name: str
    fails: str


#: Order gives the bit. New rules go to the end, so stored masks keep their meaning.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbol_noise", "100 * n_symbols > 5 * n_chars"),
    Rule("repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    Rule("shouting", "10 * n_upper_words > 5 * n_words"),
    Rule("exclamations", "100 * n_exclamations > 5 * n_chars"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("no_letters", "10 * n_letter_words < 4 * n_words"),
)

#: policy -> version -> names of its rules.
POLICIES = {
    "base": {1: ("too_few_words", "repeated_words")},
    "prose": {
        1: ("too_few_words", "repeated_words", "symbol_noise", "repeated_lines"),
        2: tuple(r.name for r in RULES),
    },
}


def bit(rule: str, rules: tuple[Rule, ...] = RULES) -> int:
    return 1 << [r.name for r in rules].index(rule)


def mask(policy: str, version: int, rules: tuple[Rule, ...] = RULES) -> int:
    """The bits of a policy's rules."""
    return sum(bit(name, rules) for name in POLICIES[policy][version])


def _covered(starts: Column, size: int) -> Column:
    """Positions covered by windows of ``size`` at the ascending ``starts``."""
    steps = F.zip_with(F.slice(starts, F.lit(2), F.size(starts)),
                       F.slice(starts, F.lit(1), F.greatest(F.size(starts) - 1, F.lit(0))),
                       lambda b, a: F.least(b - a, F.lit(size)))
    return F.when(F.size(starts) > 0,
                  F.aggregate(steps, F.lit(size), lambda acc, x: acc + x)).otherwise(F.lit(0))


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words inside windows of ``size`` words that occur twice or more.

    Window hashes are sorted with their places; equal neighbours are repeats.
    """
    def places(w: Column) -> Column:
        hashed = F.transform(
            F.sequence(F.lit(1), F.size(w) - (size - 1)),
            lambda i: F.struct(F.xxhash64(*[w[i - 1 + k] for k in range(size)]).alias("h"),
                               i.alias("i")))
        return let(F.sort_array(hashed), _repeats)

    def _repeats(s: Column) -> Column:
        last = F.size(s) - 1
        found = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"]))
                         | ((j < last) & (F.get(s, j + 1)["h"] == x["h"])))
        return let(F.sort_array(F.transform(found, lambda x: x["i"])),
                   lambda starts: _covered(starts, size))

    return F.when(F.size(words) >= size, places(words)).otherwise(F.lit(0))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements that the rules refer to, one row per document."""
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    words = F.filter(F.split("_text", "[ \\t-\\r]+"), lambda w: w != "")
    lines = F.split("_text", "\n", -1)
    has_word = lambda x: F.length(F.translate(x, SPACES, "")) > 0
    without = lambda chars: F.length(F.translate("_text", chars, ""))

    def line_counts(x: Column) -> Column:
        return F.struct(F.size(x).alias("all"),
                        (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))

    def word_counts(w: Column) -> Column:
        upper = F.filter(w, lambda x: (F.length(x) > 1) & (x == F.upper(x)) & (x != F.lower(x)))
        letters = F.filter(w, lambda x: F.lower(x) != F.upper(x))
        return F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeat"),
                        F.size(upper).alias("upper"), F.size(letters).alias("letters"))

    return (
        base.withColumns({"_w": let(words, word_counts),
                          "_l": let(F.filter(lines, has_word), line_counts)})
        .select("doc_id", F.col("_w.n").cast("long").alias("n_words"),
                without(SPACES).cast("long").alias("word_chars"),
                (F.length("_text") - without(SYMBOLS)).cast("long").alias("n_symbols"),
                F.col("_l.dup").cast("long").alias("n_dup_lines"),
                F.col("_w.repeat").cast("long").alias("n_repeat_words"),
                F.length("_text").cast("long").alias("n_chars"),
                F.col("_l.all").cast("long").alias("n_lines"),
                F.col("_w.upper").cast("long").alias("n_upper_words"),
                F.col("_w.letters").cast("long").alias("n_letter_words"),
                (F.length("_text") - without("!")).cast("long").alias("n_exclamations")))


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, **cols) -> DataFrame:
    """Measurements plus ``fail_bits``: bit k is set where rule k fails."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << k).cast("long"))
                              .otherwise(F.lit(0).cast("long")))
    return measure(docs, **cols).withColumn("fail_bits", bits)


def store(docs: DataFrame, rules: tuple[Rule, ...] = RULES, **cols) -> DataFrame:
    """The ledger as a written table: no later step evaluates a rule again."""
    return written(ledger(docs, rules, **cols), "quality-ledger")


def apply_policy(ledger_rows: DataFrame, policy: str, version: int,
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with ``kept``: none of the policy's rules failed."""
    bits = F.lit(mask(policy, version, rules)).cast("long")
    return ledger_rows.withColumn("kept", F.col("fail_bits").bitwiseAND(bits) == 0)


def ablations(ledger_rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per policy, version and rule: documents kept, failed by the rule, failed by
    it alone, and kept without it. Masks are counted first; only the distinct
    masks (at most two to the number of rules) meet the policies."""
    masks = ledger_rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("docs"))
    rows = [{"policy": p, "version": v, "rule": name, "policy_bits": mask(p, v, rules),
             "rule_bit": bit(name, rules)}
            for p, versions in POLICIES.items() for v, names in versions.items() for name in names]
    literal = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in r.items()]) for r in rows])
    hit = F.col("fail_bits").bitwiseAND(F.col("p.policy_bits"))
    of_rule = F.col("fail_bits").bitwiseAND(F.col("p.rule_bit"))
    total = lambda when: F.sum(F.when(when, F.col("docs")).otherwise(0)).alias
    return (masks.select("fail_bits", "docs", F.explode(literal).alias("p"))
            .groupBy("p.policy", "p.version", "p.rule")
            .agg(total(hit == 0)("kept"), total(of_rule != 0)("failed"),
                 total((of_rule != 0) & (hit == F.col("p.rule_bit")))("failed_alone"),
                 total((hit == 0) | (hit == F.col("p.rule_bit")))("kept_without")))
