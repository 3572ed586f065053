"""Dimension joins.

Broadcasting is never forced: the planner broadcasts a side only when its size
estimate is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks
with the real shuffle sizes at runtime; beyond that the join is a sort-merge
join with AQE skew splitting, or, for tables joined again and again, one
between stored tables bucketed alike (``copartition``), which shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, key: str = "city_id", how: str = "inner") -> DataFrame:
    """Equi-join of a fact with a dimension on one key. Spark broadcasts a side below its own threshold, at run time
    too; beyond it the join is shuffled, with adaptive splitting of hot keys."""
    return fact.join(dim, key, how)


def scalar_lookup(df: DataFrame, dim: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """Correlated scalar subquery ``(SELECT value FROM dim WHERE dim.key = df.key)``.

    No matching row -> NULL; more than one matching row -> runtime error, as
    the SQL form. Decorrelated into one aggregate + left join (no per-row work)."""
    one = (dim.groupBy(key)
           .agg(F.count(F.lit(1)).alias("_lookup_n"), F.max(value).alias("_lookup_v")))
    return (df.join(one, key, "left")
            .withColumn(alias, F.when(F.col("_lookup_n") > 1,
                                      F.raise_error(F.lit(f"scalar lookup of {value} returned more than one row")))
                        .otherwise(F.col("_lookup_v")))
            .drop("_lookup_n", "_lookup_v"))


SALT = "_salt"


def _tables(spark: SparkSession, name: str) -> list[int]:
    """Numbers of the stored pairs of ``name``, oldest first."""
    zone, _, leaf = name.rpartition(".")
    fact = f"{leaf}_fact_v"
    names = spark.sql(f"SHOW TABLES IN {zone or spark.catalog.currentDatabase()}").select("tableName").collect()
    return sorted(int(t[len(fact):]) for t, in names if t.startswith(fact) and t[len(fact):].isdigit())


def copartition(fact: DataFrame, dim: DataFrame, name: str, path: str, key: str = "city_id", buckets: int = 64,
                keep: int = 2) -> DataFrame:
    """Store a fact and a dimension too large to broadcast as tables bucketed alike, and return their join.

    Rows are bucketed and sorted by the key and a salt. A key with more rows than an even bucket, and a fact's NULL key,
    is split over as many salts as it fills buckets; the dimension's rows of such a key (fewer than ``buckets`` keys) are
    repeated once for each. Both sides of the join then lie in equal buckets: it shuffles nothing, and no bucket holds a
    hot key whole. A row's salt is the hash of its columns, so a task that runs again gives it the same one; rows that are
    equal in every column stay together.

    The view ``name`` joins the newest pair and moves to it in one catalog change, once both tables are written; the
    ``keep`` newest pairs stay for readers that have started."""
    spark = fact.sparkSession
    counts = fact.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    rows = fact.count()
    even = max(1, -(-rows // buckets))
    # At most ``buckets`` keys have more rows than an even bucket; NULL counts as such a key with all buckets.
    hot = F.broadcast(counts.where(F.col("_n") > even).select("_key", F.ceil(F.col("_n") / even).cast("int").alias("_split")))
    split = F.when(F.col(key).isNull(), F.lit(buckets)).otherwise(F.coalesce("_split", F.lit(1)))
    salted = fact.join(hot, F.col(key) == F.col("_key"), "left").withColumn(
        SALT, F.pmod(F.xxhash64(*fact.columns), split).cast("int")).drop("_key", "_split")
    spread = dim.join(hot, F.col(key) == F.col("_key"), "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce("_split", F.lit(1)) - 1))).drop("_key", "_split")
    taken = _tables(spark, name)
    version = max(taken, default=-1) + 1
    for side, df in (("fact", salted), ("dim", spread)):
        (df.repartition(buckets, key, SALT).write.bucketBy(buckets, key, SALT).sortBy(key, SALT).mode("overwrite")
         .option("path", f"{path.rstrip('/')}/{side}_v{version}").saveAsTable(f"{name}_{side}_v{version}"))
    own = ", ".join(f"f.`{c}`" for c in fact.columns)
    more = "".join(f", d.`{c}`" for c in dim.columns if c != key)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {own}{more} FROM {name}_fact_v{version} f "
              f"JOIN {name}_dim_v{version} d ON f.`{key}` = d.`{key}` AND f.{SALT} = d.{SALT}")
    for old in taken[:-keep + 1 or None]:
        for side in ("fact", "dim"):
            spark.sql(f"DROP TABLE IF EXISTS {name}_{side}_v{old}")
    return spark.table(name)
