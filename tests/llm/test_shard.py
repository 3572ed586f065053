import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cirrus.llm import op13_shard as M


def check(docs, got, shards):
    """Every document once, sizes and digests of its text, gapless slots; (bytes of each shard, shards of each text)."""
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
    slots, held, spread = defaultdict(list), Counter(), defaultdict(Counter)
    for r in got:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        held[r["shard"]] += r["size"]
        spread[(r["size"], r["text_crc32"])][r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return [held[i] for i in range(shards)], spread


def test_copies_meet_and_shards_are_even(spark):
    """A third of the rows are one text, hundreds of texts have copies; none of those is cut, the large one only as needed."""
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text in a third of all rows").when(
            F.col("id") % 3 == 1, F.concat(F.lit("copy "), F.repeat(F.lit("ab"), (F.col("id") % 40).cast("int")),
                                           (F.col("id") % 300).cast("string")))
        .otherwise(F.concat(F.lit("alone "), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")), F.col("id").cast("string"))).alias("text"))
    got = M.assign(docs).collect()
    loads, spread = check(docs.collect(), got, 24)
    mean = sum(loads) / 24
    assert max(abs(x - mean) for x in loads) < 0.02 * mean
    hot = max(spread.values(), key=lambda c: sum(c.values()))
    homes = -(-sum(hot.values()) // int(mean))  # as many shards as it needs hold nearly all of it
    assert sum(n for _, n in hot.most_common(homes)) > 0.95 * sum(hot.values())
    # A text that is spread over shards loses links: hardly any but the large one's.
    cut = sum(sum(c.values()) - max(c.values()) for c in spread.values() if c is not hot)
    assert cut < 0.01 * sum(loads)


def test_repeated_ids_do_not_fill_one_shard(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"),
                                    F.when(F.col("id") % 2 == 0, "again").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("text"))
    got = M.assign(docs, shards=5).collect()
    loads, _ = check(docs.collect(), got, 5)
    assert sorted(map(str, got)) == sorted(map(str, M.assign(docs.repartition(3, "text"), shards=5).collect()))
    assert max(loads) - min(loads) < 0.05 * sum(loads) / 5


def test_odd_documents(spark, odd_docs, no_docs):
    wide = odd_docs.withColumn("g", F.lit("x")).withColumn("size", F.lit(1)).withColumn("shard", F.lit(2)).withColumn("_part", F.lit(3))
    got = M.assign(wide).collect()
    _, spread = check(odd_docs.collect(), got, 24)
    assert all(len(c) == 1 for c in spread.values())
    assert M.assign(no_docs).count() == 0
    check([{"doc_id": 1, "text": "a"}], M.assign(spark.createDataFrame([(1, "a")], "doc_id long, text string"), shards=1).collect(), 1)


def test_propagation_keeps_to_the_quota(spark):
    """One group of a third of the bytes and many small ones, spread evenly: homes are filled up to the mean."""
    rows = [((0, 0), 10, s, 250, False) for s in range(8)] + [((g, 0), 10, s, 2, False) for g in range(1, 251) for s in range(8)]
    parcels = spark.createDataFrame(rows, "g struct<h:long,c:long>, size long, shard int, n long, solo boolean")
    after = parcels
    for turn in range(3):
        after, moved = M.propagate(after, 8, seed=turn)
        assert turn or moved
    hot = {r["shard"]: r["n"] for r in after.where("g.h = 0").collect()}
    mean = sum(r[1] * r[3] for r in rows) // 8
    assert after.agg(F.sum("n")).first()[0] == sum(r[3] for r in rows) and after.where("n <= 0").isEmpty()
    assert len(hot) == 3 and all(10 * n <= mean for n in hot.values())


def test_balance_moves_whole_groups_first(spark):
    rows = [((g, 0), 10, 0, 2, False) for g in range(50)] + [((g, 1), 10, s, 3, False) for g in range(5) for s in (0, 1)]
    parcels = spark.createDataFrame(rows, "g struct<h:long,c:long>, size long, shard int, n long, solo boolean")
    after = M.balance(parcels, 2, seed=1, steps=8, even=0.0)
    loads = M._loads(after, 2)
    assert abs(loads[0] - loads[1]) <= 20
    assert after.where("g.c = 0").groupBy("g").count().where("count > 1").isEmpty()
