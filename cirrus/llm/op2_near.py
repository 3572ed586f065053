"""MinHash near-duplicates, verified by odd sketches and on full sets.

A document's set holds its distinct ``words``-word shingles as 64-bit hashes. Equal sets are one node, named by a 64-bit
hash. ``bands x rows``
MinHash samples give the band keys; the same samples, folded into a parity bitmap of ``bits`` bits, are the node's odd
sketch: the population count of the XOR of two sketches estimates a high similarity closely. Candidates that share a
band are confirmed on their full sets, exactly; of the last, widest set of candidates only those whose estimate is not
far below the threshold (five and more standard errors of slack).

No bucket is expanded into all its pairs. Its members are compared with one leader, the node that shares most buckets
(in a group of copies the text they were copied from), and in a second round those left over with the most central of
themselves; confirmed links join components. Two members x and y of one bucket that are still apart share at most
``min(|x & L|, |y & L|)`` shingles of the leader's set L, and others only outside L. So they can meet the threshold in
two ways only: they are small enough for the leader's part alone (joined by leader and size), or they share a shingle
outside L (joined by leader and shingle, on the shortest prefix that must hold one, and only where the first shared
shingle leaves room for enough others behind it). Those pairs, few in a group of n
copies, are then estimated and confirmed; no link between members of a bucket is left out.

With 64 bands of 8 a pair at similarity 0.8 misses every band with probability below 1e-5.

Results for odd input: null or empty texts have an empty set and link with nothing; shorter texts than a shingle are
one whole sequence; documents without id link by their sets, but a component is named by the smallest id in it (null if
none); rows that repeat an id are one node of the graph when their sets are equal; repeated rows each get their result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cirrus.llm.common import SPACE_WORD, components, lower_ascii, small_batches, stored, table, word_count, word_hashes

MASK = (1 << 64) - 1
#: splitmix64 constants (fixed values).
GOLDEN, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


def shingle_set(hashes: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct shingles of a document's word hashes (uint64); a shorter text is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(words, n)
    acc = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        acc = mix(acc * np.uint64(GOLDEN) + hashes[i: n - size + 1 + i])
    return np.unique(acc)


class Sketcher:
    def __init__(self, bands: int, rows: int, bits: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.k, self.bands, self.rows, self.bits = bands * rows, bands, rows, bits
        self.a = rng.integers(0, 1 << 32, self.k, dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, self.k, dtype=np.uint32)
        self.salt = mix(np.arange(1, self.k + 1, dtype=np.uint64) * np.uint64(GOLDEN))

    def minima(self, items: np.ndarray) -> np.ndarray:
        """The k samples: smallest value of each hash function over the set."""
        x = (items >> np.uint64(32)).astype(np.uint32)[:, None]
        low = np.full(self.k, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 64):
            block = x[i: i + 64] * self.a
            block += self.b
            np.minimum(low, block.min(0), out=low)
        return low

    def sketch(self, minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys and the odd sketch, both int64."""
        sample = mix(minima.astype(np.uint64) ^ self.salt)
        odd = np.bincount((sample % np.uint64(self.bits)).astype(np.int64), minlength=self.bits) & 1
        keys = np.zeros(self.bands, np.uint64)
        for row in sample.reshape(self.bands, self.rows).T:
            keys = mix(keys * np.uint64(GOLDEN) + row)
        return keys.view(np.int64), np.packbits(odd.astype(np.uint8)).view(np.int64)

    def limit(self, similarity: float) -> int:
        """Largest XOR population count expected at this similarity."""
        differing = 2 * self.k * (1 - similarity)
        return int(np.ceil(self.bits / 2 * (1 - (1 - 2 / self.bits) ** differing)))


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("h", word_hashes(lower_ascii(F.col("text")), SPACE_WORD)).drop("text")


def describe(docs: DataFrame, sketcher: Sketcher, words: int) -> DataFrame:
    """doc_id, _th, n_shingles, node (hash of the set, null if empty), keys (band keys), odd (the odd sketch)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            flat, ends = np.asarray(column("h").flatten()).view(np.uint64), np.asarray(column("h").offsets)
            size, node, keys, odd = [], [], [], []
            for a, b in zip(ends[:-1] - ends[0], ends[1:] - ends[0], strict=True):
                items = shingle_set(flat[a:b], words)
                size.append(len(items))
                if len(items):
                    k, o = sketcher.sketch(sketcher.minima(items))
                    name = mix(np.array([mix(items).sum(), len(items)], np.uint64)).sum()
                    keys.append(k)
                    odd.append(o)
                    node.append(int(name.view(np.int64)))
                else:
                    keys.append(None)
                    odd.append(None)
                    node.append(None)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [column("doc_id"), column("_th"), pa.array(size, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(keys, lists), pa.array(odd, lists)], ["doc_id", "_th", "n_shingles", "node", "keys", "odd"])

    small_batches(docs.sparkSession)
    return _hashed(docs).mapInArrow(
        run, f"doc_id {kind}, _th long, n_shingles long, node long, keys array<long>, odd array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, items): the full sets of the wanted nodes (node, rep_id, rep_th)."""
    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "items": [
                shingle_set(np.asarray(h, np.int64).view(np.uint64), words).view(np.int64) for h in batch["h"]]})

    texts = docs.join(wanted, F.expr("_th = rep_th AND doc_id <=> rep_id")).select("node", "text")
    return _hashed(texts).mapInPandas(run, "node long, items array<long>").dropDuplicates(["node"])


def _ends(pairs: DataFrame) -> DataFrame:
    """(node): every node of the pairs (u, v)."""
    return pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()


def _renamed(df: DataFrame, end: str) -> DataFrame:
    return df.select(*(F.col(c).alias(c + end) for c in df.columns))


class Links:
    """The nodes of a corpus, their full sets where wanted, and the links found so far."""

    def __init__(self, docs: DataFrame, sketcher: Sketcher, words: int, percent: int, slack: float):
        self.docs, self.sketcher, self.words, self.percent, self.slack = docs, sketcher, words, percent, slack
        self.described = stored(describe(docs, sketcher, words), "near_described")
        rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th"))
        self.nodes = stored(self.described.where("n_shingles > 0").groupBy("node").agg(
            rep.alias("r"), F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies")).select(
            "node", "n", "copies", F.col("r.doc_id").alias("rep_id"), F.col("r._th").alias("rep_th")), "near_nodes")
        self.sets, self.links, self.labels = None, None, None

    def buckets(self) -> DataFrame:
        """(key, node, rank): buckets of two nodes or more; rank orders their members, the most central first."""
        own = Window.partitionBy("key")
        shared = self.described.where("n_shingles > 0").select("node", F.explode("keys").alias("key")).withColumn(
            "n", F.count(F.lit(1)).over(own)).withColumn("lo", F.min("node").over(own)).withColumn(
            "hi", F.max("node").over(own)).where("lo < hi").select("key", "node", "n").distinct()
        shared = stored(shared, "near_buckets")
        central = shared.groupBy("node").agg(F.struct((-F.sum("n")).alias("s"), F.col("node").alias("i")).alias("rank"))
        return shared.drop("n").join(central, "node")

    def want(self, nodes: DataFrame) -> None:
        """Make the full sets of these nodes (node) available, those that are not there yet."""
        if self.sets is not None:
            nodes = nodes.join(self.sets.select("node"), "node", "left_anti")
        wanted = stored(self.nodes.select("node", "rep_id", "rep_th", "n").join(nodes, "node"), "near_wanted")
        # While few nodes are wanted, a Bloom filter of them (built by Spark, up to its size limit) keeps the other
        # texts out of the shuffle.
        spark, name = self.docs.sparkSession, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
        before = spark.conf.get(name)
        try:
            spark.conf.set(name, "0")
            more = stored(_sets(self.docs, wanted.where("n > 0"), self.words), "near_sets")
        finally:
            spark.conf.set(name, before)
        self.sets = more if self.sets is None else self.sets.union(more)

    def compare(self, pairs: DataFrame) -> DataFrame:
        """pairs (u, v) with nu, nv, c (shared shingles) and d: a prefix of v's shingles outside u, in hash order."""
        a, b = _renamed(self.sets, "_u"), _renamed(self.sets, "_v")
        full = pairs.join(a, F.col("u") == F.col("node_u")).join(b, F.col("v") == F.col("node_v"))
        outside = F.array_sort(F.array_except("items_v", "items_u"))
        allowed = F.floor(F.size("items_v") * F.lit(100 - self.percent) / 100) + 1
        return full.select("u", "v", F.size("items_u").alias("nu"), F.size("items_v").alias("nv"),
                           F.slice(outside, F.lit(1), allowed.cast("int")).alias("d"),
                           F.size(F.array_intersect("items_u", "items_v")).alias("c"))

    def meets(self, a: str = "nu", b: str = "nv") -> str:
        return f"100 * c >= {self.percent} * ({a} + {b} - c)"

    def add(self, linked: DataFrame) -> None:
        """Take in confirmed links (u, v)."""
        self.links = linked if self.links is None else self.links.union(linked)
        self.labels = components(self.links, "near_components")

    def labelled(self, df: DataFrame, node: str, name: str) -> DataFrame:
        """df with the component of the column ``node`` as ``name``."""
        if self.labels is None:
            return df.withColumn(name, F.col(node))
        own = self.labels.select(F.col("node").alias("_node"), F.col("component").alias("_label"))
        return df.join(own, F.col(node) == F.col("_node"), "left").withColumn(
            name, F.coalesce("_label", node)).drop("_node", "_label")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that may meet the threshold by size and odd sketch."""
        sketch = self.described.where("n_shingles > 0").select("node", "odd").join(
            _ends(pairs), "node").groupBy("node").agg(
            F.first("odd").alias("odd"))
        sketch = stored(sketch, "near_sketches")
        side = lambda c: _renamed(sketch, f"_{c}")
        differing = F.aggregate(F.zip_with("odd_u", "odd_v", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
                                lambda a, x: a + x)
        most = self.sketcher.limit(self.percent / 100 - self.slack)
        return pairs.join(side("u"), F.col("u") == F.col("node_u")).join(side("v"), F.col("v") == F.col("node_v")).where(
            differing <= most).select("u", "v")

    def star(self, members: DataFrame, name: str) -> DataFrame:
        """members (key, node, rank): every member against its bucket's leader; takes in the links."""
        lead = F.min("rank").over(Window.partitionBy("key"))
        pairs = stored(members.withColumn("lead", lead).where("lead.i <> node").select(
            F.col("lead.i").alias("u"), F.col("node").alias("v")).distinct(), "near_star")
        self.want(_ends(pairs))
        compared = stored(self.compare(pairs), name)
        self.add(compared.where(self.meets()).select("u", "v"))
        return compared

    def rest(self, compared: DataFrame) -> DataFrame:
        """Pairs (u, v) of one star that are apart and can still meet the threshold (see the module's text)."""
        p, q = self.percent, 100 + self.percent
        apart = self.labelled(self.labelled(compared, "u", "cu"), "v", "cv")
        apart = stored(apart.select("u", "v", F.col("nv").alias("n"), "c", "d", "cv", (F.col("cu") != F.col("cv")).alias("out")),
                       "near_apart")
        leaders = apart.where("out").select("u").distinct()
        every = apart.join(leaders, "u").select("u", F.col("v").alias("y"), F.col("n").alias("ny"), F.col("c").alias("cy"),
                                                F.col("cv").alias("ly"), F.col("d").alias("dy"))
        out = apart.where("out").select("u", F.col("v").alias("x"), F.col("n").alias("nx"), F.col("c").alias("cx"),
                                        F.col("cv").alias("lx"), F.col("d").alias("dx"))
        sizes = out.drop("dx").withColumn("lo", F.expr(f"cast(ceil(nx * {p} / 100) as int)")).withColumn(
            "hi", F.expr(f"least(cast(floor(cx * {q} / {p}) as int) - nx, cast(floor(nx * 100 / {p}) as int))")).where(
            "lo <= hi").withColumn("ny", F.explode(F.expr("sequence(lo, hi)")))
        small = sizes.join(every.drop("dy"), ["u", "ny"]).where(
            f"lx <> ly AND {q} * cy >= {p} * (nx + ny)").select("x", "y")
        # A shingle that members of one component only hold joins nothing. Of the shingles that a pair shares outside L, the
        # first in hash order bounds their number by what follows it on either side; below the bound a pair is no link.
        held = every.select("u", "ly", F.explode("dy").alias("s")).groupBy("u", "s").agg(
            F.min("ly").alias("lo"), F.max("ly").alias("hi")).where("lo <> hi").select("u", "s")
        marks = lambda df, x: df.select(
            "u", x, f"l{x}", f"n{x}", f"c{x}", F.posexplode(f"d{x}").alias(f"i{x}", "s")).join(held, ["u", "s"]).withColumn(
            f"r{x}", F.expr(f"n{x} - c{x} - i{x}"))
        shared = marks(out, "x").join(marks(every, "y"), ["u", "s"]).where(
            f"lx <> ly AND 100 * least(nx, ny) >= {p} * greatest(nx, ny) AND "
            f"{q} * (least(cx, cy) + least(rx, ry)) >= {p} * (nx + ny)").select("x", "y")
        return small.union(shared).select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 64, rows: int = 8,
                    bits: int = 1024, slack: float = 0.15) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept, copies (documents of its node), component, _th.

    component numbers the groups of this run, also of documents without id; it is null for empty sets."""
    docs = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_th"))
    found = Links(docs, Sketcher(bands, rows, bits), words, percent, slack)
    buckets = stored(found.buckets(), "near_ranked")
    if not buckets.isEmpty():
        first = found.star(buckets, "near_compared")
        own = Window.partitionBy("key")
        members = found.labelled(buckets, "node", "comp").withColumn("top", F.min(F.struct("rank", "comp")).over(own))
        left = stored(members.where("comp <> top.comp").select("key", "node", "rank"), "near_left")
        if not left.isEmpty():
            found.star(left, "near_second")
            pairs = stored(found.rest(first), "near_rest")
            pairs = stored(found.estimated(pairs), "near_estimated")
            found.want(_ends(pairs))
            found.add(stored(found.compare(pairs).where(found.meets()).select("u", "v"), "near_last"))

    named = found.labelled(found.nodes, "node", "component")
    least = named.groupBy("component").agg(F.min("rep_id").alias("component_id"))
    named = named.select("node", "copies", "component").join(least, "component")
    out = found.described.select("doc_id", "_th", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
                      F.coalesce("copies", F.lit(1)).alias("copies"), "component", "_th")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: the smallest id of each group stays (else the smallest text hash).

    Documents without words are in no group and stay; of exactly repeated rows one stays."""
    found = stored(near_duplicates(docs, **options).select("doc_id", "component", "_th"), "near_found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th"))
    keep = found.where("component IS NOT NULL").groupBy("component").agg(first.alias("r")).select("r.doc_id", "r._th")
    keep = keep.unionByName(found.where("component IS NULL").select("doc_id", "_th"))
    keep = keep.select(F.col("doc_id").alias("keep_id"), F.col("_th").alias("keep_th")).distinct()
    digest = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    left = docs.join(keep, docs["doc_id"].eqNullSafe(keep["keep_id"]) & (digest == keep["keep_th"]), "left_semi")
    twins = found.where("component IS NOT NULL").groupBy("doc_id", "_th").count().where("count > 1")
    if twins.isEmpty():
        return left
    wordless = word_count(F.col("text")) == 0
    return left.where(~wordless).dropDuplicates(["doc_id", "text"]).unionByName(left.where(wordless))


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=2).drop("_th", "component")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w),
pair AS (SELECT doc_id, x, lead(x) OVER (PARTITION BY doc_id ORDER BY i) AS y,
                count(*) OVER (PARTITION BY doc_id) AS n FROM word),
sh AS (SELECT DISTINCT doc_id, CASE WHEN y IS NULL THEN x ELSE x || ' ' || y END AS s FROM pair WHERE y IS NOT NULL OR n = 1),
num AS (SELECT doc_id, s, dense_rank() OVER (ORDER BY s) AS k FROM sh),
size AS (SELECT doc_id, count(*) AS n, sum(hash(s) % 1000000007) AS h FROM num GROUP BY doc_id),
node AS (SELECT n, h, min(doc_id) AS rep FROM size GROUP BY n, h),
rare AS (SELECT k, count(*) AS df FROM num JOIN node ON doc_id = rep GROUP BY k HAVING count(*) > 1),
ranked AS (SELECT doc_id, num.k, df, row_number() OVER (PARTITION BY doc_id ORDER BY df, num.k) AS r, n
           FROM num JOIN node ON doc_id = rep JOIN size USING (doc_id, n, h) LEFT JOIN rare USING (k)),
cand AS (SELECT DISTINCT a.doc_id AS u, b.doc_id AS v FROM ranked a JOIN ranked b ON a.k = b.k AND a.doc_id < b.doc_id
         WHERE a.r <= a.n // 5 + 1 AND b.r <= b.n // 5 + 1 AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
inter AS (SELECT u, v, count(*) AS c FROM cand JOIN num a ON a.doc_id = u JOIN num b ON b.doc_id = v AND b.k = a.k
          GROUP BY u, v),
link AS (SELECT u, v FROM inter JOIN size a ON a.doc_id = u JOIN size b ON b.doc_id = v
         WHERE 100 * c >= 80 * (a.n + b.n - c)),
edge AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
reach AS (SELECT rep AS a, rep AS b FROM node UNION SELECT a, v FROM reach JOIN edge ON b = u),
comp AS (SELECT a AS rep, min(b) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, w.doc_id) AS component_id,
       coalesce(c, w.doc_id) = w.doc_id AS kept,
       coalesce(count(*) OVER (PARTITION BY coalesce(rep, -1 - w.doc_id)), 1)::BIGINT AS copies
FROM w LEFT JOIN size USING (doc_id) LEFT JOIN node USING (n, h) LEFT JOIN comp USING (rep)
"""
