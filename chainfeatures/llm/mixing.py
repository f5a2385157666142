"""Mixing sources to target weights by systematic sampling (DataFrame API only).

Every source gets a target number of words: a share of all words by weight, held
below ``max_repeat`` times the words it has; what that cap cuts off goes to the
other sources by weight until no source is above its cap.  Documents of a source
then get the same expected number of copies ``c = target / source_size``.  They are
laid out on a line, each ``c`` long, in an order close to their size; one random
offset is added, and a document is emitted once for every integer boundary that
its stretch crosses, i.e. ``floor(c*r + u) - floor(c*(r-1) + u)`` times for the
document of rank ``r``.

The order is by size class first, which makes the sample stratified by size: the
words taken from a source stay within about one document of each size class of
the target.  The running sums are two-level, so no source is ever one task: ranks inside
(source, size class, salt) blocks, plus the blocks' offsets, of which there is a
bounded number for each source.

Defined cases: null or empty text has size 0 and takes no words; a null source is a
source of its own, last in order; repeated rows are separate documents; an empty
table gives an empty result; a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table

#: A word: a run of characters other than space and the control blanks 09-0D.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: Rows for which one more salt per size class is used.
ROWS_PER_SALT = 2_000_000
LEAST_SALTS = 8
_HEX = 0xFFFF


def _md5_number(col: Column) -> Column:
    return F.conv(F.substring(F.md5(col), 1, 4), 16, 10).cast("int")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``sizes(source, source_size)`` -> the same plus ``target``.

    The repeated resharing has a closed form: sorted by ``cap / weight``, the capped
    sources are a prefix, and each other source gets ``level * weight`` with
    ``level = (total - caps before) / (weights from here on)``.  One row per source,
    so the global window here is over the sources, never over documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("__ratio", "__pos")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("__pos") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = (sizes.withColumn("__pos", F.row_number().over(by_name))
         .withColumn("__w", w)
         .withColumn("__cap", F.lit(float(max_repeat)) * F.col("source_size"))
         .withColumn("__ratio", F.col("__cap") / F.col("__w")))
    everything = Window.partitionBy(F.lit(1))
    s = (s.withColumn("__total", F.sum("source_size").over(everything))
         .withColumn("__before", F.coalesce(F.sum("__cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("__from", F.sum("__w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("__level", (F.col("__total") - F.col("__before")) / F.col("__from"))
         .withColumn("__rank", F.row_number().over(by_ratio)))
    # the first source that its share does not fill has the final level
    level = F.min_by("__level", F.when(F.col("__ratio") >= F.col("__level"), F.col("__rank"))).over(everything)
    return (s.withColumn("target", F.coalesce(F.least(F.col("__cap"), level * F.col("__w")), F.col("__cap")))
            .select("source", "source_size", "target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, max_repeat: float = MAX_REPEAT, seed: int = 7,
                keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``
    and the ``keep`` columns of ``docs`` as a struct ``row``."""
    spark = docs.sparkSession
    full = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.md5(F.col(text_col).cast("string")), F.lit("")).alias("__tie"),
        *([F.struct(*[F.col(c) for c in keep]).alias("row")] if keep else []))
    # size class: number of digits and the first two of them, so classes are at most 10 % wide
    digits = F.col("size").cast("string")
    full = (full.withColumn("__src", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")))  # a key without nulls
            .withColumn("__class", F.length(digits) * 100 + F.rpad(F.substring(digits, 1, 2), 2, "0").cast("int")))
    # ids and sizes are written once; the texts are not counted again for the sums
    slim = shared_table(full.select("doc_id", "source", "__src", "size", "__class", "__tie"), "mix-sizes")
    salts = max(LEAST_SALTS, -(-slim.count() // ROWS_PER_SALT))
    # rows that share an id and a size differ by the text
    salt = F.pmod(_md5_number(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "__tie")), F.lit(min(salts, _HEX)))
    slim = slim.withColumn("__salt", salt)
    d = full.withColumn("__salt", salt) if keep else slim

    blocks = slim.groupBy("source", "__src", "__class", "__salt").agg(F.count(F.lit(1)).alias("__n"), F.sum("size").alias("__words"))
    targets = source_targets(blocks.groupBy("source").agg(F.sum("__words").alias("source_size")), weights, max_repeat)
    before = Window.partitionBy("__src").orderBy("__class", "__salt").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.pmod(_md5_number(F.concat_ws("|", F.lit(str(seed)), "__src")), F.lit(1 << 16)) / F.lit(float(1 << 16))
    blocks = (blocks.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
              .join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
              .select("__src", "__class", "__salt", "__before", "source_size", "target",
                      F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("__c"),
                      offset.alias("__u")))
    inside = Window.partitionBy("__src", "__class", "__salt").orderBy("size", F.col("doc_id").asc_nulls_last(), "__tie")
    j = d.withColumn("__r", F.row_number().over(inside)).join(blocks, ["__src", "__class", "__salt"])
    r = F.col("__before") + F.col("__r")
    copies = F.floor(F.col("__c") * r + F.col("__u")) - F.floor(F.col("__c") * (r - 1) + F.col("__u"))
    return j.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col("size")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken", *(["row"] if keep else []))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """The mixed corpus itself: every kept row once for each copy it got."""
    return (mixed.filter(F.col("copies") > 0)
            .select(F.col("row"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__k"))
            .select("row.*"))


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


#: The same result in DuckDB SQL, written from the rules: ranks by one global sort of
#: each source, and the targets by resharing round after round.
OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(md5(text), '') AS tie
  FROM documents),
n AS (SELECT greatest(8, ceil(count(*) / 2000000.0))::INT AS salts FROM d),
e AS (
  SELECT d.*, length(size::VARCHAR) * 100 + rpad(substr(size::VARCHAR, 1, 2), 2, '0')::INT AS class,
         ('0x' || md5(coalesce(doc_id::VARCHAR, '') || '|' || tie)[1:4])::INT % least(n.salts, 65535) AS salt
  FROM d, n),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS w
  FROM e GROUP BY source),
r AS (
  SELECT 0 AS i, source, source_size, w, FALSE AS full_, 0.0::DOUBLE AS target FROM s
  UNION ALL
  SELECT i + 1, source, source_size, w, full_ OR share >= 3.0 * source_size,
         CASE WHEN full_ OR share >= 3.0 * source_size THEN 3.0 * source_size ELSE share END
  FROM (SELECT *, (sum(source_size) OVER () - sum(CASE WHEN full_ THEN 3.0 * source_size ELSE 0 END) OVER ()) * w
                  / nullif(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER (), 0) AS share FROM r)
  WHERE i < 64),
t AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS c,
             (('0x' || md5('7|' || coalesce('s' || source, ''))[1:4])::INT % 65536) / 65536.0::DOUBLE AS u
      FROM r WHERE i = 64),
k AS (SELECT e.*, row_number() OVER (PARTITION BY source ORDER BY class, salt, size, doc_id NULLS LAST, tie) AS rk FROM e)
SELECT k.doc_id, k.size, t.source_size, t.target,
       ((floor(t.c * rk + t.u) - floor(t.c * (rk - 1) + t.u)) * k.size)::BIGINT AS taken,
       k.source, (floor(t.c * rk + t.u) - floor(t.c * (rk - 1) + t.u))::BIGINT AS copies
FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
"""
