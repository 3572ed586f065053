"""Exact distinct counts without a set in one buffer: mergeable bitmaps over a dictionary.

Every distinct value gets a dense id once (``extend_dictionary``). A state row is one key's bitmap for one bucket of
32,768 ids, so that the values of a key meet in no single row or task, whatever their number: bitmaps are made and merged
by aggregate functions that fold inside the tasks, and a count adds the bits of a key's buckets. States of any split of
the rows merge to the state of them all, and states by a finer key (a day) roll up to a coarser one.

A bitmap has 4 KB however few values it holds: this form is for keys with many values; sets (``incremental``) are smaller
for a few. NULL values are not counted, NULL keys are keys of their own, and a key with NULL values only has no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cirrus.operators.quality import surrogate_key


def extend_dictionary(dictionary: DataFrame | None, changes: DataFrame, value: str, path: str | None = None) -> DataFrame:
    """(value, value_id): the dictionary with the values of ``changes`` that it lacks, numbered on from its last id.

    The new entries are stored at ``path`` (a scratch table without it), for ids must not change once bitmaps use them."""
    values = changes.select(F.col(value).alias("value")).where("value IS NOT NULL").distinct()
    if dictionary is None:
        return surrogate_key(values, ["value"], "value_id", path=path)
    last = dictionary.agg(F.coalesce(F.max("value_id"), F.lit(0))).first()[0]
    new = values.join(dictionary.select("value"), "value", "left_anti")
    return dictionary.unionByName(surrogate_key(new, ["value"], "value_id", start=last, path=path))


def partial_bitmaps(changes: DataFrame, dictionary: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, bucket, bits) of ``changes``, whose values the dictionary holds. Pairs of key and value are made distinct
    before they meet the dictionary, so a hot value costs that join one row a key."""
    pairs = changes.select(*keys, F.col(value).alias("value")).where("value IS NOT NULL").distinct()
    return pairs.join(dictionary, "value").groupBy(*keys, F.bitmap_bucket_number("value_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("value_id")).alias("bits"))


def combine_bitmaps(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One state out of many, also out of states with more key columns than ``keys`` (a roll-up)."""
    return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def merge_bitmaps(state: DataFrame, changes: DataFrame, dictionary: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    return combine_bitmaps(state.select(*keys, "bucket", "bits").unionByName(
        partial_bitmaps(changes, dictionary, value, keys)), keys)


def count_bitmaps(state: DataFrame, keys: Sequence[str] = (), alias: str = "distinct_count") -> DataFrame:
    """The number of distinct values of each key (of all rows without ``keys``)."""
    return state.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(alias))
