"""Operator 10: quality rules kept as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measurements
and one failure bit per rule. Policies are versioned sets of rules applied to
the stored bits, and ablations are bitwise aggregates over the ledger, so a
new policy never reads a text again. One pass over the table, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torque.llm.columns import WHITE, let, words

SYMBOLS = "#*$%&|<>"
POSITION_BITS = 24               # word positions packed beside a hash while sorting


@dataclass(frozen=True)
class Rule:
    name: str
    failed: str                  # SQL over the measurements, in whole numbers
    base: bool = False


# The order fixes the bits; new rules are appended.
RULES = [
    Rule("few_words", "n_words < 50", base=True),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words", base=True),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("capitals", "100 * n_capitals > 40 * word_chars"),
]
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}
BASE_MASK = sum(BIT[r.name] for r in RULES if r.base)
# version -> rules that reject a document
POLICIES = {
    1: ["few_words", "repeated_words"],
    2: ["few_words", "repeated_words", "symbols", "word_length"],
    3: [rule.name for rule in RULES],
}


def policy_mask(version: int) -> int:
    return sum(BIT[name] for name in POLICIES[version])


def _repeated_positions(hashes: Column) -> Column:
    """Positions whose hash occurs at least twice, ascending.

    Long arrays sort fast only as plain numbers, so the position rides in the
    low bits; neighbours are then compared by their full hashes. Where neighbours
    differ only in those low bits, different hashes may lie mixed, and pairs are sorted.
    """
    low = (1 << POSITION_BITS) - 1

    def packed(h: Column) -> Column:
        rows = F.sort_array(F.transform(h, lambda v, i: v.bitwiseAND(F.lit(~low)).bitwiseOR(
            i.cast("long"))))
        full = lambda v: F.get(h, v.bitwiseAND(F.lit(low)).cast("int"))
        high = lambda v: v.bitwiseAND(F.lit(~low))
        mixed = lambda s: F.size(F.filter(s, lambda v, i: (
            high(v) == high(F.get(s, i + 1))) & (full(v) != full(F.get(s, i + 1))))) > 0
        kept = lambda s: F.filter(s, lambda v, i: (
            full(v) == full(F.get(s, i + 1))) | (full(v) == full(F.get(s, i - 1))))
        return let(rows, lambda s: F.when(mixed(s), paired(h)).otherwise(F.sort_array(
            F.transform(kept(s), lambda v: v.bitwiseAND(F.lit(low))))))

    def paired(h: Column) -> Column:
        rows = F.sort_array(F.transform(h, lambda v, i: F.struct(
            v.alias("h"), i.cast("long").alias("p"))))
        kept = let(rows, lambda s: F.filter(s, lambda v, i: (v["h"] == F.get(s, i + 1)["h"])
                                            | (v["h"] == F.get(s, i - 1)["h"])))
        return F.sort_array(F.transform(kept, lambda v: v["p"]))

    return let(hashes, lambda h: F.when(F.size(h) < low, packed(h)).otherwise(paired(h)))


def repeated_words(w: Column) -> Column:
    """Words inside 3-word windows found at least twice (the first one included)."""
    hashed = F.transform(w, lambda x: F.xxhash64(x))
    windows = let(hashed, lambda h: F.when(F.size(h) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(h) - 3),
        lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))))
    at = _repeated_positions(F.coalesce(windows, F.array().cast("array<bigint>")))
    gaps = let(at, lambda p: F.transform(p, lambda v, i: F.least(
        F.lit(3).cast("long"), v - F.coalesce(F.get(p, i - 1), v - 3))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All measurements of every document in one pass."""
    text = F.coalesce(F.col("text"), F.lit(""))
    dropped = lambda chars: F.char_length(F.translate(text, chars, ""))
    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    n_chars = F.char_length(text)
    lines = F.filter(F.split(text, "\n", -1),
                     lambda x: F.char_length(F.translate(x, WHITE, "")) > 0)
    sized = lambda c: c.cast("long")
    counted = let(words(text), lambda w: F.struct(
        sized(F.size(w)).alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(
        sized(F.size(x)).alias("n_lines"),
        sized(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .select("doc_id", counted.alias("_w"), by_line.alias("_l"),
                    sized(dropped(WHITE)).alias("word_chars"),
                    sized(n_chars - dropped(SYMBOLS)).alias("n_symbols"),
                    sized(n_chars - dropped(capitals)).alias("n_capitals"))
            .select("doc_id", "_w.n_words", "word_chars", "n_symbols", "_l.n_dup_lines",
                    "_w.n_repeat_words", "_l.n_lines", "n_capitals"))


def quality_ledger(docs: DataFrame, version: int = 3, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Measurements, ``failed_mask`` (a bit per failed rule) and verdicts.

    ``base_failed`` is set by the base rules, ``kept`` by the policy of the
    given version; base rules belong to every policy.

    Null and empty texts have no words: all measurements are 0 and the rule on
    few words fails. Repeated windows are compared by 64-bit hashes within one
    text. Null and repeated ids pass through row by row; an empty table gives
    an empty ledger; other columns are not read.
    """
    bits = [F.when(F.expr(rule.failed), F.lit(BIT[rule.name])).otherwise(F.lit(0))
            for rule in RULES]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    ledger = measure(docs, id_col, text_col).withColumn("failed_mask", mask)
    hit = lambda m: F.col("failed_mask").bitwiseAND(F.lit(m)) != 0
    return (ledger.withColumn("base_failed", hit(BASE_MASK))
            .withColumn("kept", ~hit(BASE_MASK | policy_mask(version))))


def ablations(ledger: DataFrame, version: int = 3) -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it rejects, and that
    stay without it. The ledger is first counted per mask (at most 2^rules rows)."""
    spark, mask = ledger.sparkSession, BASE_MASK | policy_mask(version)
    by_mask = ledger.groupBy(F.col("failed_mask").bitwiseAND(F.lit(mask)).alias("m")).agg(
        F.count(F.lit(1)).alias("n"))
    rules = spark.createDataFrame([(r.name, BIT[r.name]) for r in RULES if BIT[r.name] & mask],
                                  "rule string, bit int")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    per_mask = by_mask.select("n", "m", F.explode(F.array(
        *[F.lit(BIT[r.name]) for r in RULES if BIT[r.name] & mask])).alias("bit"))
    counted = per_mask.groupBy("bit").agg(
        total(F.col("m").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(F.col("m") == F.col("bit")).alias("n_only"),
        total(F.col("m").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"))
    return (rules.join(counted, "bit", "left").select(
        "rule", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
                  for c in ("n_failed", "n_only", "n_kept_without")]))


ORACLE = r"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
      FROM base),
win AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i:
            struct_pack(p := i, g := ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS x FROM w),
rep AS (SELECT doc_id, x.p AS p FROM win
        QUALIFY count(*) OVER (PARTITION BY doc_id, x.g) > 1),
cov AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM rep, range(3) r(k) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM base),
dl AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS d FROM ln
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(d, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
        coalesce(n_lines, 0)::BIGINT AS n_lines,
        length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
      FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN dl USING (doc_id)),
f AS (SELECT *, ((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 8 ELSE 0 END)
        + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 16 ELSE 0 END)
        + (CASE WHEN 100 * n_capitals > 40 * word_chars THEN 32 ELSE 0 END))::INTEGER AS failed_mask
      FROM m)
SELECT *, failed_mask & 3 <> 0 AS base_failed, failed_mask = 0 AS kept FROM f
"""
