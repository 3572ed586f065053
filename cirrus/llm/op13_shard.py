"""Sharding by balanced label propagation: linked documents move to their neighbours' shards under capacity quotas.

Documents of one group (equal texts) are linked. Every document starts in a pseudo-random shard; the documents of a group
that share a shard are one parcel (group, shard, size of a document, number), so a group is at most one row a shard,
however many copies it has. A round has two steps, each a few joins and sums over the parcels:

* propagate: a group keeps as many home shards as its bytes need (one, unless it is larger than a shard), those that
  hold most of it; its other parcels ask to move to a home. A shard takes what its quota leaves room for, the largest
  groups first, and parts of a parcel where the whole does not fit.
* balance: shards above the mean give whole groups (no link is cut), and only then parts of groups that are spread
  anyway, to shards below it. Prefix sums of what is given are laid along the shards' deficits. This is repeated with
  smaller and smaller parcels until the shards are even or nothing small enough is left.

Rounds end when hardly a document moves any more (``settled``), or after ``rounds``. Then the documents are numbered inside their groups and
dealt out to the parcels. Sums over a shard's parcels run in buckets; what the driver reads is one row a shard.

Results for odd input: a null text has no bytes and is the empty text's group; absent and repeated ids and repeated rows
are documents of their own; an empty table gives no rows; other columns play no part, whatever their names; a document
larger than a shard's even part fills a shard beyond it, as documents are whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrus.llm.common import sorted_rows, spans, stored, table

#: Buckets of a shard for running sums (for each power of two of parcel sizes, where those come first).
BUCKETS = 1024
#: What the law that the shards follow is called: sizes are near equal.
LAW = "bytes"


def _loads(parcels: DataFrame, shards: int) -> list[int]:
    """Bytes of each shard: one row a shard goes to the driver."""
    held = {r["shard"]: r["load"] for r in parcels.groupBy("shard").agg(F.sum(F.col("size") * F.col("n")).alias("load")).collect()}
    return [held.get(i, 0) for i in range(shards)]


def _at(values: list, index: str) -> Column:
    return F.get(F.array(*(F.lit(int(v)).cast("long") for v in values)), F.col(index).cast("int"))


def _merged(parcels: DataFrame) -> DataFrame:
    return parcels.groupBy("g", "size", "shard", "solo").agg(F.sum("n").alias("n")).where("n > 0")


def _running(rows: DataFrame, by: str, value: Column, order: list[Column]) -> DataFrame:
    """Adds ``start``, the sum of ``value`` over the rows of the same ``by`` before this one; ``order`` begins with a bucket.

    A bucket of one ``by`` is summed in one task, and the buckets' totals, ``BUCKETS`` at most, give the offsets."""
    rows = rows.withColumn("_v", value).withColumn("_b", order[0])
    totals = rows.groupBy(by, "_b").agg(F.sum("_v").alias("_t")).select(
        by, "_b", (F.sum("_t").over(Window.partitionBy(by).orderBy("_b")) - F.col("_t")).alias("_o"))
    inside = Window.partitionBy(by, "_b").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_s", F.sum("_v").over(inside) - F.col("_v")).join(totals, [by, "_b"]).withColumn(
        "start", F.col("_s") + F.col("_o")).drop("_v", "_b", "_s", "_o")


def _mixed(*columns: str, seed: int) -> Column:
    return F.xxhash64(*columns, F.lit(seed))


def propagate(parcels: DataFrame, shards: int, seed: int) -> tuple[DataFrame, int]:
    """One round of moves towards a group's home shards: (parcels, documents moved).

    A shard's quota is the mean. Of what it holds only cut groups count against it: whole groups can still leave it at no
    cost, and ``balance`` makes them so."""
    linked = parcels.where("NOT solo")
    mean = max(1, -(-sum(_loads(parcels, shards)) // shards))
    # Shards that a few large groups fill are no home for small ones.
    large = F.col("size") * F.col("n") >= mean / 8
    full = [int(x > 0.8 * mean) for x in _loads(linked.where(large), shards)]
    heaviest = Window.partitionBy("g").orderBy((_at(full, "shard") == 1) & ~large, F.desc("n"),
                                               _mixed("g", "shard", seed=0), "shard")
    whole = Window.partitionBy("g")
    ranked = stored(
        linked.withColumn("place", F.row_number().over(heaviest))
        .withColumn("homes", F.ceil(F.sum(F.col("size") * F.col("n")).over(whole) / F.lit(mean)))
        .withColumn("labels", F.array_sort(F.collect_list(F.struct("place", "shard")).over(whole))), "shard_ranked")
    pinned = _loads(ranked.where("place <= homes AND (homes > 1 OR size(labels) > 1)"), shards)
    wishes = ranked.where("place > homes").select(
        "g", "size", "shard", "n", F.expr(f"labels[cast((place - 1 + {seed}) % homes as int)].shard").alias("to"))
    # Of a shard's room the groups with the largest parcels (by powers of two) take first.
    gain = (F.lit(63) - F.floor(F.log2("n"))) * BUCKETS + F.pmod(_mixed("g", seed=seed), F.lit(BUCKETS))
    asked = _running(wishes, "to", F.col("size") * F.col("n"), [gain, F.col("g"), F.col("shard")])
    free = F.lit(mean) - _at(pinned, "to") - F.col("start")
    moves = stored(asked.withColumn("m", F.least(F.col("n"), F.floor(free / F.col("size")))).where("m > 0").select(
        "g", "size", "shard", "to", "m"), "shard_moves")
    moved = moves.agg(F.sum("m")).first()[0] or 0
    if not moved:
        return parcels, 0
    after = _merged(linked.unionByName(_moved(moves.withColumn("solo", F.lit(False)))))
    return stored(parcels.where("solo").unionByName(after), "shard_parcels"), moved


def _moved(moves: DataFrame) -> DataFrame:
    """What moves of m documents (g, size, solo, shard, to, m) add to the parcels."""
    return moves.select("g", "size", "shard", "solo", (-F.col("m")).alias("n")).unionByName(
        moves.select("g", "size", F.col("to").alias("shard"), "solo", F.col("m").alias("n")))


def balance(parcels: DataFrame, shards: int, seed: int, steps: int, even: float, cuts: int = 0) -> DataFrame:
    """Move parcels from shards above the mean to shards below, smaller ones at each step, until all are ``even``.

    Documents of cut groups stay, but in the last ``cuts`` of the steps and where a shard is far above the mean."""
    was, cutting = None, False
    for step in range(steps):
        loads = _loads(parcels, shards)
        total = sum(loads)
        goals = [total // shards + (i < total % shards) for i in range(shards)]
        surplus = [max(0, x - y) for x, y in zip(loads, goals)]
        deficit = [max(0, y - x) for x, y in zip(loads, goals)]
        stuck = loads == was
        if max(surplus + deficit) <= even * max(goals) or stuck and (cutting or not cuts):
            break
        was, cutting = loads, cutting or stuck or step >= steps - cuts
        # Only groups that lie in one shard move without a cut; one larger than a shard has to be cut.
        group = Window.partitionBy("g")
        spread = (F.count(F.lit(1)).over(group) > 1) | (F.sum(F.col("size") * F.col("n")).over(group) > max(goals))
        held = parcels.where("solo").withColumn("spread", F.lit(False)).unionByName(
            parcels.where("NOT solo").withColumn("spread", spread)).where(_at(surplus, "shard") > 0)
        if not cutting:
            held = held.where(~F.col("spread") | (_at(surplus, "shard") > max(goals) // 4))
        # A whole group moves whole, documents of a spread one move alone, and after all others.
        unit = F.when(F.col("spread"), F.col("size")).otherwise(F.col("size") * F.col("n"))
        bucket = F.pmod(_mixed("g", seed=seed * 100 + step), F.lit(BUCKETS)) + F.when(F.col("spread"), BUCKETS).otherwise(0)
        given = _running(held.where(unit <= F.least(F.lit(max(deficit)), _at(surplus, "shard"))), "shard", F.col("size") * F.col("n"), [bucket, F.col("g")])
        left = _at(surplus, "shard") - F.col("start")
        count = F.when(F.col("spread"), F.least(F.col("n"), F.floor(left / F.col("size")))).when(
            left >= F.col("size") * F.col("n"), F.col("n"))
        given = given.withColumn("m", count.cast("long")).where("m > 0")
        # Surpluses end to end, and deficits end to end: a byte given at x goes to the shard whose deficit covers x.
        before = [sum(surplus[:i]) for i in range(shards)]
        ends = [sum(deficit[: i + 1]) for i in range(shards)]
        edges = F.array(*(F.lit(e).cast("long") for e in ends))
        low = _at(before, "shard") + F.col("start")
        high = low + F.col("size") * F.col("m")
        # A whole group goes where its middle lies; a spread parcel is cut where deficits end.
        middle = F.size(F.filter(edges, lambda e: e <= (low + high) / 2))
        one = F.array(F.struct(F.least(F.lit(shards - 1), middle).alias("to"), F.col("m").alias("m")))
        parts = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.struct(i.alias("to"), F.floor((
            F.least(high, F.get(edges, i)) - F.greatest(low, F.coalesce(F.get(edges, i - 1), F.lit(0)))) / F.col("size")).alias("m")))
        to = F.when(F.col("spread"), F.filter(parts, lambda c: c["m"] > 0)).otherwise(one)
        moves = stored(given.select("g", "size", "solo", "shard", F.explode(to).alias("x")).select(
            "g", "size", "solo", "shard", "x.to", "x.m"), "shard_given")
        parcels = stored(_merged(parcels.unionByName(_moved(moves))), "shard_balanced")
    return parcels


def assign(docs: DataFrame, shards: int = 24, rounds: int = 6, steps: int = 8, even: float = 0.002,
           settled: float = 0.002, seed: int = 13) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, shard, slot (0, 1, .. in its shard)."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    # A group is named by 96 bits of digests, and its texts have one length.
    base = docs.select("doc_id", F.struct(F.xxhash64(text).alias("h"), F.crc32(text).alias("c")).alias("g"),
                       (F.octet_length(text) + 8).cast("long").alias("size"))
    rows = sorted_rows(base, "shard_rows", ["g", "size", "doc_id"], "doc_id", "g", "size")
    parts = stored(spans(rows, "g", "size"), "shard_spans")
    first = F.pmod(F.xxhash64("doc_id", "g"), F.lit(shards)).cast("int")
    alone = F.sum("n").over(Window.partitionBy("g", "size")) == 1
    parcels = stored(rows.groupBy("g", "size", first.alias("shard")).agg(F.count(F.lit(1)).alias("n")).select(
        "g", "size", "shard", "n", alone.alias("solo")), "shard_first")
    total = rows.count()
    for turn in range(rounds):
        parcels, moved = propagate(parcels, shards, seed + turn)
        if moved:
            parcels = balance(parcels, shards, seed + turn, 2, 0.1)
        if moved <= settled * total:
            break
    parcels = balance(parcels, shards, seed + rounds, steps, even, cuts=2)
    # A parcel's first slot, and the documents of its group before it.
    slots = _running(parcels, "shard", F.col("n"), [F.pmod(_mixed("g", seed=0), F.lit(BUCKETS)), F.col("g"), F.col("size")])
    upto = F.sum("n").over(Window.partitionBy("g", "size").orderBy("shard"))
    dealt = slots.withColumn("first", upto - F.col("n")).groupBy("g", "size").agg(
        F.array_sort(F.collect_list(F.struct("first", "n", "shard", "start"))).alias("parcels"))
    # The groups' parcels go to the groups' spans, then to the documents by group and partition: no group meets in one task.
    placed = rows.join(parts.join(dealt, ["g", "size"]), ["g", "size", "_part"]).withColumn(
        "i", F.col("_before") + F.col("_pos") - F.col("_lo"))
    mine = F.element_at(F.filter("parcels", lambda p: p["first"] <= F.col("i")), -1)
    return placed.withColumn("mine", mine).select(
        "doc_id", "size", F.col("g.c").alias("text_crc32"), F.col("mine.shard").alias("shard"),
        (F.col("mine.start") + F.col("i") - F.col("mine.first")).alias("slot"))


def query(spark, sf_dir):
    return assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
