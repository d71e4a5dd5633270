"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per rule; policies, which
are versioned sets of rules, and ablations are then bit operations on the ledger and never read a text again.

Defined results: a null text is empty (all measurements 0, too few words); repeated rows are judged alike, one row each; a
null id stays null; an empty table gives an empty ledger. Other columns are ignored, or kept as they are by `passing`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import WORD, packed, whole_text

#: Rule names in the order of their bits, with the SQL condition under which a document fails.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars > 20 * n_words OR word_chars < 2 * n_words",
    "shouting": "2 * n_exclaims > n_words",
    "capitals": "2 * n_capitals > word_chars",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: the rules that reject."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
STRICT = Policy("strict-1", tuple(RULES))

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaims", "n_capitals")

_INNER = r"[^\\x20\\x09-\\x0D]"


def _without(name: str, characters: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{characters}', '')) AS {name}"


def measured(rows: DataFrame, hash_bits: int = 64) -> DataFrame:
    """Add the measurements to rows with a text column `t`.

    Words of repeated 3-word windows: each window is one long, the leading bits of its hash above its position, so that
    sorting the longs brings equal windows together in about n log n steps. Where neighbours agree in the hash, their words
    are compared; should two different windows ever agree, the document is done again by the words themselves. `hash_bits`
    leading bits are used, less those of the position.
    """
    keep = rows.columns
    words = rows.withColumn("w", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))
    lined = words.selectExpr(
        *keep,
        "w",
        "size(w) AS n",
        f"filter(split(t, '\\n', -1), l -> l RLIKE '{_INNER}') AS lines",
        f"(1L << greatest(length(bin(size(w))), {64 - hash_bits})) - 1 AS low",
        "length(array_join(w, '')) AS word_chars",
        _without("n_symbols", "[#*$%&|<>]"),
        _without("n_exclaims", "!"),
        _without("n_capitals", "[A-Z]"),
    )
    done = ["w", "n", "low", "word_chars", "n_symbols", "n_exclaims", "n_capitals"]
    windows = lined.selectExpr(
        *keep,
        *done,
        "size(lines) AS n_lines",
        "size(lines) - size(array_distinct(lines)) AS n_dup_lines",
        """CASE WHEN n < 4 THEN array() ELSE sort_array(transform(sequence(0, n - 3),
             i -> (xxhash64(get(w, i), get(w, i + 1), get(w, i + 2)) & ~low) | i)) END AS p""",
    )
    done += ["n_lines", "n_dup_lines"]
    same = "get(p, {0}) IS NOT NULL AND (x & ~low) = (get(p, {0}) & ~low)"
    paired = windows.selectExpr(*keep, *done, f"filter(p, (x, i) -> ({same.format('i - 1')}) OR ({same.format('i + 1')})) AS p")
    at = "cast(x & low AS int)"
    before = "cast(get(p, i - 1) & low AS int)"
    differ = " OR ".join(f"get(w, {at} + {k}) != get(w, {before} + {k})" for k in range(3))
    clash = f"exists(transform(p, (x, i) -> i > 0 AND (x & ~low) = (get(p, i - 1) & ~low) AND ({differ})), b -> b)"
    text = "concat_ws(' ', get(w, i), get(w, i + 1), get(w, i + 2))"
    by_words = f"sort_array(transform(sequence(0, n - 3), i -> struct({text} AS g, i AS i)))"
    # Sorted once and bound to a name: equal windows are neighbours there.
    exact = f"""transform(array({by_words}), s -> transform(filter(transform(s, (y, k) -> struct(y.g AS g, y.i AS i, k AS k)),
                 y -> get(s, y.k - 1).g = y.g OR get(s, y.k + 1).g = y.g), y -> y.i))[0]"""
    placed = paired.selectExpr(
        *keep, *done, f"sort_array(CASE WHEN {clash} THEN {exact} ELSE transform(p, x -> {at}) END) AS p"
    )
    covered = "aggregate(transform(p, (x, i) -> least(3, coalesce(get(p, i + 1) - x, 3))), 0, (a, b) -> a + b)"
    longs = [f"cast({m} AS bigint) AS {m}" for m in MEASURES if m not in ("n_words", "n_repeat_words")]
    return placed.selectExpr(
        *keep, "cast(n AS bigint) AS n_words", *longs, f"cast({covered} AS bigint) AS n_repeat_words"
    )


def _with_bits(rows: DataFrame) -> DataFrame:
    bits = " | ".join(f"(CASE WHEN {c} THEN {BIT[n]}L ELSE 0L END)" for n, c in RULES.items())
    return measured(rows).withColumn("failed_bits", F.expr(bits))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and failed_bits of every document."""
    return _with_bits(docs.select("doc_id", whole_text().alias("t"))).select("doc_id", *MEASURES, "failed_bits")


def verdicts(entries: DataFrame, *policies: Policy) -> DataFrame:
    """Add one boolean `kept_<version>` per policy to ledger rows."""
    kept = {f"kept_{p.version}": F.col("failed_bits").bitwiseAND(F.lit(p.mask)) == 0 for p in policies}
    return entries.withColumns(kept)


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: documents it fails, and documents that only it rejects and that would come back without it.

    Ledger rows are first counted by their masked bits, of which there are at most 2 to the number of rules.
    """
    masked = entries.select(F.col("failed_bits").bitwiseAND(F.lit(policy.mask)).alias("bits"))
    counted = masked.groupBy("bits").agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("bigint").alias("bit")) for r in policy.rules]))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    return (
        counted.select("bits", "n", rules.alias("r"))
        .groupBy(F.lit(policy.version).alias("version"), F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(alone, F.col("n"))), F.lit(0)).alias("n_only"),
        )
    )


def passing(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The rows of `docs` that the policy keeps, with their own columns."""
    judged = _with_bits(packed(docs, t=whole_text())).select("row", "failed_bits", F.monotonically_increasing_id().alias("n"))
    # The row number keeps the filter above the measurements; pushed below them, it would repeat them many times over.
    return judged.filter((F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) == 0) & (F.col("n") >= 0)).select("row.*")


def query(spark, folder):
    entries = verdicts(ledger(spark.read.parquet(f"{folder}/documents.parquet")), BASE, STRICT)
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("kept_base")).alias("base_failed"),
        (F.col("kept_base") & F.col("kept_strict-1")).alias("kept"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), m AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM m, range(3) k(k) GROUP BY doc_id
), x AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, len(regexp_extract_all(t, '!')) AS n_exclaims, len(regexp_extract_all(t, '[A-Z]')) AS n_capitals
  FROM d LEFT JOIN r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines
            OR word_chars > 20 * n_words OR word_chars < 2 * n_words OR 2 * n_exclaims > n_words OR 2 * n_capitals > word_chars) AS kept
FROM x
"""
