"""Line deduplication: lines that several documents share stay only in the document with the largest id.

Each line long enough becomes a 128-bit hash with its document and position; texts never take part. The hashes are
partitioned by range and, within a hash, sorted by document (largest first) and position, so that one pass streams the first
occurrence of each line per document. A hash that very many documents share is cut into slices that may lie in different
partitions; slices are counted where they are and meet as one row each. The result is one compressed keep bitmap per
document that loses lines: its runs of kept lines, as Roaring bitmaps store runs.

Defined results: a null or empty text has one empty line; rows with the same id and text are one document and get the same
result, as do all their lines; a null id is one document, smaller than any other; an empty table gives an empty result.
Other columns are ignored, or kept as they are by `deduplicated`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.common import packed, saved, whole_text

SLICES = 32

_STRIPPED = r"trim(BOTH ' \t\n\u000B\u000C\r' FROM l)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: lower() of a text of single bytes changes A-Z only.
_LOWERED = f"CASE WHEN octet_length(k) = length(k) THEN lower(k) ELSE translate(k, '{_UPPER}', '{_UPPER.lower()}') END"
_LINES = r"split(t, '\n', -1)"
KEY = ["doc_id", "text_hash"]


def occurrences(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """doc_id, text_hash, n_lines, at, h1 and h2 of every line whose key has at least `min_chars` characters."""
    texts = docs.select("doc_id", whole_text().alias("t"))
    lines = texts.selectExpr("doc_id", "xxhash64(t) AS text_hash", f"{_LINES} AS lines")
    keys = f"filter(transform(lines, (l, i) -> struct(i AS at, {_STRIPPED} AS k)), s -> length(s.k) >= {int(min_chars)})"
    long_lines = lines.selectExpr("doc_id", "text_hash", "size(lines) AS n_lines", f"inline({keys})")
    return long_lines.selectExpr("doc_id", "text_hash", "n_lines", "at", f"{_LOWERED} AS k").selectExpr(
        "doc_id", "text_hash", "n_lines", "at", "xxhash64(k) AS h1", "xxhash64(1, k) AS h2"
    )


def shared(found: DataFrame, min_docs: int = 3) -> DataFrame:
    """h1, h2 and keeper (largest document id) of the lines found in at least `min_docs` documents."""
    sliced = found.select("h1", "h2", "doc_id", "at", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).alias("slice"))
    runs = Window.partitionBy("h1", "h2", "slice").orderBy(F.desc("doc_id"), "at")
    firsts = (
        sliced.repartitionByRange("h1", "h2", "slice")
        .withColumn("n", F.row_number().over(runs))
        .withColumn("previous", F.lag("doc_id").over(runs))
        .filter((F.col("n") == 1) | ~F.col("doc_id").eqNullSafe(F.col("previous")))
    )
    counted = firsts.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
    return counted.filter(F.col("n_docs") >= min_docs).drop("n_docs")


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, text_hash, n_dropped and keep (runs of kept lines: start, length) of the documents that lose lines."""
    found = saved(occurrences(docs, min_chars))
    lost = found.join(shared(found, min_docs), ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = lost.groupBy(*KEY).agg(F.max("n_lines").alias("n"), F.sort_array(F.collect_set("at")).alias("gone"))
    edges = gone.selectExpr(*KEY, "size(gone) AS n_dropped", "concat(array(-1), gone, array(n)) AS e")
    runs = "transform(e, (x, i) -> struct(x + 1 AS start, coalesce(get(e, i + 1) - x - 1, 0) AS length))"
    return edges.selectExpr(*KEY, "cast(n_dropped AS bigint) AS n_dropped", f"filter({runs}, r -> r.length > 0) AS keep")


def applied(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Add kept (text), n_lines and n_dropped to rows with doc_id and t, the text."""
    left = rows.withColumn("text_hash", F.xxhash64("t")).alias("l")
    right = bitmaps.alias("r")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.text_hash") == F.col("r.text_hash"))
    joined = left.join(right, same, "left").select("l.*", "r.keep", "r.n_dropped").drop("text_hash")
    rest = f"array_join(flatten(transform(keep, r -> slice({_LINES}, r.start + 1, r.length))), '\\n')"
    return joined.withColumns({
        "n_lines": F.expr(r"length(t) - length(replace(t, '\n', '')) + 1").cast("bigint"),
        "kept": F.expr(f"CASE WHEN keep IS NULL THEN t ELSE {rest} END"),
        "n_dropped": F.coalesce("n_dropped", F.lit(0).cast("bigint")),
    })


def deduplicated(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """`docs` with the shared lines removed from their texts; a text that loses nothing stays as it is, null too."""
    rows = packed(docs, doc_id=F.col("doc_id"), t=whole_text())
    done = applied(rows, keep_bitmaps(docs, min_chars, min_docs))
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row.text"))
    return done.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    done = applied(docs.select("doc_id", whole_text().alias("t")), keep_bitmaps(docs))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, i, a[i] AS line,
         translate(trim(a[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))
), s AS (
  SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (doc_id != keeper)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM l LEFT JOIN s USING (k) GROUP BY doc_id
"""
