"""Mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions.

Only DataFrame operations. Sources weigh 5, 2, 1, 5, ... in code-point order, null last; their targets share
``share`` times all words, clamped at ``max_epochs`` times the source's own words, the excess redistributed by
weight until none is above. A source is then taken ``whole`` times and once more in part: its documents in a seeded
pseudo-random order up to the remaining number of words; the document at the cut is taken in part (its first words),
so a source's taken words are its target rounded down.

Results for odd input: null or empty text has size 0 and is never taken; an absent source is a source of its own, the
last; an absent id is ordered as the empty text; repeated rows are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cirrus.llm.common import stored, table, with_rank, word_count

#: Hex digits of the order key that name its bucket: 4096 buckets for each source.
BUCKET_DIGITS = 3


def water_fill(sources: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """sources (.., source_size, weight) with column ``target``. Sends two sums a round to the driver."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    goal = share * total
    rem, wsum = 0.0, 1
    level = None
    while True:
        over = F.lit(False) if level is None else (
            F.col("weight") * F.lit(rem) / F.lit(float(wsum)) >= max_epochs * F.col("source_size"))
        row = sources.select("source_size", "weight", over.alias("over")).agg(
            F.sum(F.when(F.col("over"), max_epochs * F.col("source_size")).otherwise(0)).alias("clamped"),
            F.sum(F.when(~F.col("over"), F.col("weight")).otherwise(0)).alias("free"),
            F.count_if("over").alias("n")).first()
        if row["n"] is not None and row["n"] == level:
            break
        level, rem, wsum = row["n"], float(goal - (row["clamped"] or 0)), row["free"] or 0
        if not wsum:
            return sources.withColumn("target", (max_epochs * F.col("source_size")).cast("double"))
    share_of = F.col("weight") * F.lit(rem) / F.lit(float(wsum))
    cap = (max_epochs * F.col("source_size")).cast("double")
    return sources.withColumn("target", F.when(share_of >= cap, cap).otherwise(share_of))


def plan(docs: DataFrame, share: float = 1.5, max_epochs: int = 2, weights: tuple[int, ...] = (5, 2, 1),
         seed: str = "mix-7") -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, taken (words), whole (repetitions)."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    base = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("k"),
                              F.xxhash64(F.coalesce("text", F.lit(""))).alias("_th")), "mix_base")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_rank(sizes, "mix_sources", F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    targets = water_fill(stored(ranked.withColumn("weight", weight), "mix_ranked"), share, max_epochs)
    targets = targets.withColumn("quota", F.floor("target")).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0)).withColumn(
        "rest", F.col("quota") - F.col("whole") * F.col("source_size"))

    bucket = F.substring("k", 1, BUCKET_DIGITS)
    sums = base.groupBy("source", bucket.alias("b")).agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("b")) - F.col("n")
    cut = _by_source(sums.withColumn("before", before), targets.select("source", "rest")).where(
        "before <= rest AND before + n > rest").select("source", F.col("b").alias("cut"), "before")
    limits = stored(_by_source(targets, cut, "left"), "mix_limits")  # without a cut, rest is 0 only for size 0
    rows = _by_source(base, limits).withColumn("b", bucket)
    inside = F.sum("size").over(Window.partitionBy("source").orderBy("k", "doc_id", "_th").rowsBetween(
        Window.unboundedPreceding, -1))
    at_cut = rows.where("b = cut").withColumn("part", F.least(F.col("size"), F.greatest(
        F.lit(0), F.col("rest") - F.col("before") - F.coalesce(inside, F.lit(0)))))
    plain = rows.where("cut IS NULL OR b <> cut").withColumn(
        "part", F.when(F.col("b") < F.col("cut"), F.col("size")).otherwise(0))
    return plain.unionByName(at_cut).select(
        "doc_id", "source", "_th", "size", "source_size", "target",
        (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken"),
        F.col("whole").cast("int").alias("whole"), F.col("part").cast("long").alias("part"))


def _by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    right = right.withColumnRenamed("source", "_s")
    return left.join(right, left["source"].eqNullSafe(right["_s"]), how).drop("_s")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: each row ``whole`` times, and once more cut after its ``part`` words.

    Columns as in ``docs``. Documents that are not taken go. Repeated rows (same id and text) are paired by number."""
    chosen = stored(plan(docs, **options).where("taken > 0"), "mix_plan").select(
        F.col("doc_id").alias("to_id"), F.col("_th").alias("to_th"), "size", "whole", "part")
    # The rows travel as one struct, so their own column names cannot clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own_th"))
    same = "row.doc_id <=> to_id AND own_th = to_th"
    if not chosen.groupBy("to_id", "to_th").count().where("count > 1").isEmpty():
        chosen = chosen.withColumn("to_n", F.row_number().over(
            Window.partitionBy("to_id", "to_th").orderBy(F.desc("whole"), F.desc("part"))))
        rows = rows.withColumn("own_n", F.row_number().over(
            Window.partitionBy("row.doc_id", "own_th").orderBy(F.lit(0))))
        same += " AND own_n = to_n"
    copies = F.concat(F.array_repeat(F.col("size"), F.col("whole")),
                      F.when(F.col("part") > 0, F.array("part")).otherwise(F.array().cast("array<bigint>")))
    taken = rows.join(chosen, F.expr(same)).select("row", "size", F.explode(copies).alias("take"))
    pieces = F.regexp_extract_all("row.text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(pieces, F.lit(1), F.col("take").cast("int")), "")
    text = F.when(F.col("take") < F.col("size"), head).otherwise(F.col("row.text"))
    return taken.select(*(text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def query(spark, sf_dir):
    return plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


ORACLE = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix-7') AS k FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT] AS weight
  FROM base GROUP BY source),
fill AS (
  SELECT 0 AS step, 1.5::DOUBLE * (SELECT sum(source_size) FROM src)::DOUBLE AS rem,
         (SELECT sum(weight) FROM src)::DOUBLE AS wsum
  UNION ALL
  SELECT step + 1,
         1.5::DOUBLE * (SELECT sum(source_size) FROM src)::DOUBLE
           - (SELECT coalesce(sum(2 * source_size) FILTER (weight * rem / wsum >= 2 * source_size), 0) FROM src)::DOUBLE,
         (SELECT coalesce(sum(weight) FILTER (NOT weight * rem / wsum >= 2 * source_size), 0) FROM src)::DOUBLE
  FROM fill WHERE step < 60 AND wsum > 0),
last AS (SELECT rem, wsum FROM fill ORDER BY step DESC LIMIT 1),
goal AS (
  SELECT source, source_size,
         CASE WHEN wsum = 0 OR weight * rem / wsum >= 2 * source_size THEN (2 * source_size)::DOUBLE
              ELSE weight * rem / wsum END AS target
  FROM src, last),
quota AS (
  SELECT *, floor(target)::BIGINT AS q,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole FROM goal),
cum AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM base)
SELECT c.doc_id, c.size, q.source_size, q.target, c.source,
       (q.whole * c.size + greatest(0, least(c.size, q.q - q.whole * q.source_size - c.before)))::BIGINT AS taken
FROM cum c JOIN quota q ON c.source IS NOT DISTINCT FROM q.source
"""
