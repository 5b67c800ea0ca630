"""Quality rules as a bitmask ledger.

Every measurement is taken once and every rule evaluated once: the ledger holds, for each document, the
measurements and ``failures``, a bit for each rule that it fails.  A policy is a named, versioned set of
rules, so applying one is a bitwise AND with its mask, and a new policy or an
ablation never reads the texts again.  All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basket.llm.common import filtered

#: Rule name -> SQL condition over the measurements that means "fails".  The position is the bit:
#: append new rules, never reorder.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}

#: Policy version -> the rules it applies.
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "full-1": tuple(RULES),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Spaces that separate words: ASCII 0x20 and 0x09 to 0x0D.
_SPACE = r"[\\x20\\x09-\\x0D]"
# A window's hash keeps its high 40 bits; the low 24 carry its place in the text.
_PLACE = (1 << 24) - 1


def mask(policy: str) -> int:
    return sum(BITS[r] for r in POLICIES[policy])


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements of each whole text (null: empty), all long.

    ``n_repeat_words`` counts the words inside 3-word windows that occur twice or more
    (the first occurrence included).  Window hashes, sorted with their places, find the
    candidates; the windows' words then decide, so a hash collision cannot change the count.
    Texts of 2**24 words and more skip the hash step and compare all windows.
    """
    cols = [c for c in docs.columns if c.lower() not in {*MEASURES, "failures"}]
    # The steps' own names begin with an underscore: such columns of the documents stand aside.
    own = {c: f"own{c}" if c.startswith("_") else c for c in cols}
    docs, cols = docs.select(*cols).withColumnsRenamed(own), list(own.values())
    steps = [
        ("_t", "coalesce(text, '')"),
        ("_w", f"filter(split(_t, '{_SPACE}+'), w -> w <> '')"),
        ("_l", f"filter(split(_t, '\\\\n', -1), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"),
        ("_n", "size(_w)"),
        (
            "_g",
            "CASE WHEN _n BETWEEN 3 AND {p} THEN sort_array(transform(sequence(0, _n - 3), i -> "
            "xxhash64(_w[i], _w[i + 1], _w[i + 2]) & ~{p}L | i)) ELSE array() END".format(p=_PLACE),
        ),
        (
            "_c",
            "CASE WHEN _n > {p} THEN sequence(0, _n - 3) ELSE transform(filter(_g, (x, i) -> "
            "coalesce(x >> 24 = get(_g, i - 1) >> 24, false) OR coalesce(x >> 24 = get(_g, i + 1) >> 24, false)), "
            "x -> CAST(x & {p}L AS INT)) END".format(p=_PLACE),
        ),
        ("_e", "sort_array(transform(_c, p -> struct(concat_ws(' ', _w[p], _w[p + 1], _w[p + 2]) AS g, p AS p)))"),
        (
            "_p",
            "sort_array(transform(filter(_e, (x, i) -> coalesce(x.g = get(_e, i - 1).g, false) "
            "OR coalesce(x.g = get(_e, i + 1).g, false)), x -> x.p))",
        ),
    ]
    out = docs.select(*cols)
    for name, expression in steps:
        out = out.withColumn(name, F.expr(expression))
    covered = "aggregate(_p, struct(0L AS n, 0 AS e), (a, p) -> struct(a.n + p + 3 - greatest(p, a.e) AS n, p + 3 AS e)).n"
    measured = F.struct(
        F.expr("CAST(_n AS BIGINT)").alias("n_words"),
        F.expr("CAST(char_length(array_join(_w, '')) AS BIGINT)").alias("word_chars"),
        F.expr("CAST(regexp_count(_t, '[#*$%&|<>]') AS BIGINT)").alias("n_symbols"),
        F.expr("CAST(size(_l) AS BIGINT)").alias("n_lines"),
        F.expr("CAST(size(_l) - size(array_distinct(_l)) AS BIGINT)").alias("n_dup_lines"),
        F.expr(f"CASE WHEN size(_p) = 0 THEN 0L ELSE {covered} END").alias("n_repeat_words"),
    )
    # One measured row per document through a generator: a filter on a measurement is then not pushed
    # below the steps, where it would evaluate them again inside one another.
    return out.select(*cols, F.explode(F.array(measured)).alias("_m")).select(
        *[F.col(aside).alias(c) for c, aside in own.items()], "_m.*"
    )


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements and ``failures``, one bit for each rule of ``RULES`` that fails.

    Null and empty texts measure zero and so fail ``few_words``.  Repeated rows get a row
    each; an empty table gives none; columns of those names in ``docs`` are replaced.
    """
    bits = [f"CASE WHEN {condition} THEN {BITS[name]}L ELSE 0L END" for name, condition in RULES.items()]
    return measure(docs).withColumn("failures", F.expr(" | ".join(bits)))


def passes(policy: str, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(docs: DataFrame, policy: str = "full-1") -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    return filtered(docs, {*MEASURES, "failures"}, lambda d: ledger(d).filter(passes(policy)))


def ablations(found: DataFrame, policy: str = "full-1") -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and kept if it were dropped.

    ``found`` is a ledger.  One pass groups documents by their masked failure bits (at most
    two to the number of rules), and everything else is bit arithmetic over those counts.
    """
    bits = F.col("failures").bitwiseAND(F.lit(mask(policy))).alias("bits")
    groups = found.groupBy(bits).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit")) for r in POLICIES[policy]]))
    per = groups.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", F.col("r.bit").cast("long").alias("bit"))

    def total(condition: str) -> Column:
        return F.coalesce(F.sum(F.expr(f"CASE WHEN {condition} THEN n END")), F.lit(0)).cast("long")

    return per.groupBy("rule").agg(
        total("bits & bit <> 0").alias("n_failed"),
        total("bits = bit").alias("n_failed_alone"),
        total("bits & ~bit = 0").alias("n_kept_without"),
    )
