"""Benchmark decontamination by winnowing.

Only DataFrame operations. Words are hashed, every ``k`` consecutive word hashes to one gram hash, and of each run of
``n - k + 1`` grams (one window of ``n`` words) the smallest is a fingerprint. Equal windows have equal fingerprints at
equal offsets, so joining the documents' fingerprints with the benchmark's finds every shared window. Hits are then
extended: all document windows around a hit are compared with the benchmark's windows word by word.

An item shorter than ``n`` words is one window of its own length; each length that occurs (at most n - 1) is searched
with k equal to that length, in the same pass over the texts, which also counts their words. The benchmark's windows are joined, never collected.

Results for odd input: null or empty texts have no words; an item without words has no window; an absent item id counts
as the empty text; repeated items count once; documents with equal or absent ids are told apart by their texts;
repeated rows each get their result; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import ALNUM_WORD, keyed, let, lower_ascii, same_row, stored, table, words

#: Join keys that the documents' word counts are spread over.
COUNTS = 1024


def item_words(text: str) -> Column:
    return words(lower_ascii(F.col(text)), ALNUM_WORD)


def fingerprints(h: Column, n: int, k: int) -> Column:
    """Selected grams of a text's word hashes as longs: 32 bits of hash, then the gram's first word.

    Hash and position share one long, so the smallest of a window is its smallest hash, leftmost first."""
    span = n - k + 1

    def select(grams):
        least = lambda i: F.array_min(F.slice(grams, i, span))
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(grams) - (span - 1)), least))

    gram = lambda i: F.shiftleft(F.xxhash64(F.slice(h, i, k)), 32).bitwiseOR((i - 1).cast("long"))
    every = F.transform(F.sequence(F.lit(1), F.size(h) - (k - 1)), gram)
    return F.when(F.size(h) >= n, let(every, select) if span > 1 else every)


def hash_of(gram: Column) -> Column:
    return F.shiftright(gram, 32).cast("int")


def _marks(h: Column, m: int, n: int, k: int) -> Column:
    """The fingerprints for windows of m words: structs of m, fp (hash) and p (first word)."""
    found = F.coalesce(fingerprints(h, m, k if m == n else m), F.array().cast("array<bigint>"))
    return F.transform(found, lambda g: F.struct(
        F.lit(m).alias("m"), hash_of(g).alias("fp"), g.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("p")))


def _hashes(text: str) -> Column:
    return F.transform(item_words(text), lambda x: F.xxhash64(x))


def _found(docs: DataFrame, bench: DataFrame, lengths: list[int], n: int, k: int) -> DataFrame:
    """(doc_id, _th, m, p) by one pass over the texts: for each row of ``docs`` its number of words (m = 0, p the number),
    and each of its fingerprints that the benchmark has for windows of m words (p its first word).

    The number travels with the fingerprints, through the same join; the benchmark's side has a row for each of its keys."""
    def own(h):
        count = F.struct(F.lit(0).alias("m"), F.pmod("_th", F.lit(COUNTS)).cast("int").alias("fp"), F.size(h).alias("p"))
        return F.concat(F.array(count), *(_marks(h, m, n, k) for m in lengths))

    marks = docs.sparkSession.range(COUNTS).select(F.lit(0).alias("m"), F.col("id").cast("int").alias("fp"))
    for m in lengths:
        marks = marks.union(bench.where(F.col("m") == m).select(F.explode(
            let(_hashes("text"), lambda h: _marks(h, m, n, k))).alias("x")).select("x.m", "x.fp").distinct())
    rows = docs.select("doc_id", "_th", F.explode(let(_hashes("text"), own)).alias("x")).select("doc_id", "_th", "x.*")
    return stored(rows.join(marks, ["m", "fp"]).select("doc_id", "_th", "m", "p"), "bench_found")


def shared_windows(docs: DataFrame, items: DataFrame, n: int = 13, k: int = 7) -> tuple[DataFrame, DataFrame]:
    """(doc_id, _th, s, e, item): document words s .. e - 1 equal a window of the item; and (doc_id, _th, n_words) of each
    row. docs: keyed()."""
    bench = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").withColumn(
        "m", F.least(F.size(item_words("text")), F.lit(n))).where("m > 0")
    lengths = sorted(r[0] for r in bench.select("m").distinct().collect())
    found = _found(docs, bench, lengths, n, k)
    join = lambda w, i, m: F.array_join(F.slice(w, i, m), " ")
    windows = bench.select("item", F.explode(let(item_words("text"), lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - F.col("m") + 1), lambda i: join(w, i, F.col("m"))))).alias("win")).distinct()
    hits = found.where("m > 0").groupBy(F.col("doc_id").alias("_d"), F.col("_th").alias("_t")).agg(
        F.collect_set(F.struct("m", "p")).alias("pos"))

    def around(w):
        # A fingerprint's gram lies anywhere in a window of n words, and fills a shorter one.
        starts = F.array_distinct(F.flatten(F.transform("pos", lambda x: F.transform(F.sequence(
            F.greatest(F.lit(0), x["p"] - F.when(x["m"] == n, n - k).otherwise(0)), F.least(x["p"], F.size(w) - x["m"])),
            lambda s: F.struct(x["m"].alias("m"), s.alias("s"))))))
        return F.transform(starts, lambda x: F.struct(
            x["s"].alias("s"), (x["s"] + x["m"]).alias("e"), join(w, x["s"] + 1, x["m"]).alias("win")))

    near = docs.join(hits, F.expr("doc_id <=> _d AND _th = _t")).select(
        "doc_id", "_th", F.explode(let(item_words("text"), around)).alias("x"))
    spans = near.select("doc_id", "_th", "x.*").join(windows, "win").drop("win")
    return spans, found.where("m = 0").select("doc_id", "_th", F.col("p").cast("long").alias("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 13, k: int = 7, share: int = 20) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, _th.

    A word inside any occurrence of an item's window is hit; a document is contaminated if it has hits and
    ``share * n_hit >= n_words``."""
    docs = keyed(docs)
    spans = F.sort_array(F.collect_set(F.struct("s", "e")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"),
                              F.greatest(a["end"], x["e"]).cast("long").alias("end")), lambda a: a["n"])
    shared, sizes = shared_windows(docs, items, n, k)
    hits = shared.groupBy(
        "doc_id", "_th").agg(spans.alias("spans"), F.sort_array(F.collect_set("item")).alias("items")).select(
        "doc_id", "_th", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    n_hit = F.coalesce(hits["n_hit"], F.lit(0)).cast("long")
    return sizes.join(hits, same_row(sizes, hits), "left").select(
        sizes["doc_id"], sizes["_th"], "n_words", n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def query(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_th")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS m, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS t
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
dword AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
d13 AS (SELECT doc_id, i, list(x) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS w
        FROM dword),
dw AS (SELECT doc_id, i, m, array_to_string(w[1 : m], ' ') AS t FROM d13, sizes WHERE len(w) >= m),
hit AS (SELECT doc_id, i, dw.m, item FROM dw JOIN win ON dw.m = win.m AND dw.t = win.t),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY encode(item))) AS items_sha256
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
