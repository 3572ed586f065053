"""Substring dedup by compacting a token de Bruijn graph.

Of the k-grams inside a window of ``width`` words the smallest (by hash, leftmost) is its anchor; consecutive windows
with one anchor form a segment. Equal windows have equal anchors at equal offsets. The graph's nodes are the anchors,
its edges lead from each segment of a text to the next: a de Bruijn graph of the texts' k-grams, thinned to the anchors.

1. Anchors that occur once end all repeats; they are counted with partial aggregation and dropped by a join.
2. Compaction. An anchor whose segment and whose neighbours on both sides are the same wherever it occurs is unbranched;
   neighbouring unbranched anchors are joined into one path, which then has the same extent at every occurrence. Where
   an anchor branches, its windows stay single.
3. Verification. Paths and single windows are named by the hash of their words and counted by source coordinate; those
   with two or more are repeated, and the words they cover are removed.

Hashes have 64 bits. Results for odd input: null or empty texts have no words; a text shorter than the window keeps
all; all occurrences of a repeated passage go, the first one too, and so do whole repeated documents; rows with equal
or absent ids are told apart by their texts, exactly repeated rows count as several sources and each get their result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import small_batches, stored, table, word_hashes
from cirrus.llm.op2_near import GOLDEN, mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))


class Rolling:
    """Hashes of all runs of consecutive words, from prefix sums modulo 2**64."""

    powers = np.ones(1, np.uint64)
    inverses = np.ones(1, np.uint64)

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        if len(Rolling.powers) <= n:
            size = 2 * n + 1024
            for name, base in (("powers", BASE), ("inverses", INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(Rolling, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(hashes.view(np.uint64) ^ np.uint64(GOLDEN)) * Rolling.powers[:n], out=self.sums[1:])

    def runs(self, start: np.ndarray, size) -> np.ndarray:
        """One hash for each run of ``size`` words from ``start``."""
        own = (self.sums[start + size] - self.sums[start]) * Rolling.inverses[start]
        return mix(own + np.asarray(size).astype(np.uint64) * np.uint64(GOLDEN))


def segments(rolling: Rolling, n: int, width: int, k: int):
    """(anchor position, anchor hash, first window, windows) of each segment of a text of n >= width words."""
    grams = rolling.runs(np.arange(n - k + 1), k)
    span = width - k + 1
    anchor = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(1) + np.arange(n - width + 1)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return anchor[first], grams[anchor[first]], first, np.diff(np.r_[first, len(anchor)])


def _hashed(docs: DataFrame, *keep: str) -> DataFrame:
    return docs.select(*keep, word_hashes(F.col("text")).alias("h"))


def anchors(docs: DataFrame, width: int, k: int) -> DataFrame:
    """(key, a, c, p): the anchors of each text, in order: hash, hash of the segment's words, position."""
    def run(batches):
        for batch in batches:
            out = []
            for key, h in zip(batch["key"], batch["h"], strict=True):
                if len(h) >= width:
                    rolling = Rolling(np.asarray(h, np.int64))
                    pos, name, first, count = segments(rolling, len(h), width, k)
                    content = rolling.runs(first, count + (width - 1))
                    out.append((key, name.view(np.int64), content.view(np.int64), pos.astype(np.int32)))
            if out:
                yield pd.DataFrame(out, columns=["key", "a", "c", "p"])

    return _hashed(docs, "key").mapInPandas(run, "key long, a array<long>, c array<long>, p array<int>")


def repeated_anchors(found: DataFrame) -> DataFrame:
    """(key, ps, free): positions of the anchors that occur twice, and which of them are unbranched."""
    each = found.select("key", F.explode(F.transform(F.sequence(F.lit(1), F.size("a")), lambda i: F.struct(
        F.element_at("a", i).alias("a"), F.element_at("p", i).alias("p"),
        F.xxhash64(F.element_at("c", i), F.when(i > 1, F.element_at("a", F.greatest(i - 1, F.lit(1)))).otherwise(0),
                   F.when(i < F.size("a"), F.element_at("a", F.least(i + 1, F.size("a")))).otherwise(0)).alias("sign")))).alias("x"))
    each = each.select("key", "x.a", "x.p", "x.sign")
    twice = stored(each.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("sign").alias("lo"), F.max("sign").alias("hi")).where(
        "n > 1").select("a", (F.col("lo") == F.col("hi")).alias("free")), "substring_twice")
    return each.select("key", "a", "p").join(twice, "a").groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("p", "free"))).alias("ps")).select(
        "key", F.col("ps.p").alias("ps"), F.col("ps.free").alias("free"))


def units(docs: DataFrame, wanted: DataFrame, width: int, k: int) -> DataFrame:
    """(key, s, n, e): compacted paths and single windows: first window, windows, hash of their words."""
    def run(batches):
        for batch in batches:
            keys, starts, counts, names = [], [], [], []
            for key, h, ps, free in zip(batch["key"], batch["h"], batch["ps"], batch["free"], strict=True):
                h = np.asarray(h, np.int64)
                if len(h) < width:
                    continue
                rolling = Rolling(h)
                pos, _, first, count = segments(rolling, len(h), width, k)
                kind = np.zeros(len(pos), np.int8)  # 1 branching, 2 unbranched
                at = np.searchsorted(pos, ps)
                known = (at < len(pos)) & (pos[np.minimum(at, len(pos) - 1)] == ps)
                kind[at[known]] = 1 + np.asarray(free, bool)[known]
                path = kind == 2
                heads = np.flatnonzero(path & ~np.r_[False, path[:-1]])
                tails = np.flatnonzero(path & ~np.r_[path[1:], False])
                single = np.flatnonzero(kind == 1)
                s = np.concatenate([first[heads], *(np.arange(first[i], first[i] + count[i]) for i in single)])
                n = np.concatenate([first[tails] + count[tails] - first[heads], np.ones(count[single].sum(), np.int64)])
                keys.append(np.full(len(s), key, np.int64))
                starts.append(s)
                counts.append(n)
                names.append(rolling.runs(s.astype(np.int64), n + (width - 1)).view(np.int64))
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys), "s": np.concatenate(starts), "n": np.concatenate(counts),
                                    "e": np.concatenate(names)})

    return _hashed(docs.join(wanted, "key"), "key", "ps", "free").mapInPandas(run, "key long, s int, n int, e long")


def repeated_spans(docs: DataFrame, width: int = 50, k: int = 0) -> DataFrame:
    """(key, spans: array of (s, n)): the verified paths and windows of each text. docs: key, text."""
    k = k or max(1, width * 2 // 5)
    small_batches(docs.sparkSession)
    found = stored(anchors(docs, width, k), "substring_anchors")
    wanted = stored(repeated_anchors(found), "substring_wanted")
    parts = stored(units(docs, wanted, width, k), "substring_units")
    # Stored first: a join of two plain shuffles, of which Spark splits the hot partitions.
    real = stored(parts.groupBy("e").agg(F.count(F.lit(1)).alias("sources")).where("sources > 1").select("e"),
                  "substring_real")
    return stored(parts.join(real, "e").groupBy("key").agg(F.collect_set(F.struct("s", "n")).alias("spans")),
                  "substring_spans")


def dedup(docs: DataFrame, width: int = 50, k: int = 0) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept (text: kept words joined by one space), kept_sha256."""
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"))
    spans = repeated_spans(docs.select("key", "text"), width, k)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            out = []
            for text, spans in zip(column("text").to_pylist(), column("spans").to_pylist(), strict=True):
                words = WORD.findall(text or "")
                total = len(words)
                if spans is not None:
                    gone = np.zeros(total + 1, np.int64)
                    for x in spans:
                        gone[x["s"]] += 1
                        gone[x["s"] + x["n"] + width - 1] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]
                kept = " ".join(words)
                out.append((total, total - len(words), kept, hashlib.sha256(kept.encode("utf-8", "replace")).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [column("doc_id"), *(pa.array([r[i] for r in out], t) for i, t in enumerate(kinds))],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return docs.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept string, kept_sha256 string")


def query(spark, sf_dir):
    return dedup(table(spark, sf_dir, "documents"), width=35).drop("kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
win AS (SELECT doc_id, x, i, list(x) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS l
        FROM word),
h AS (SELECT doc_id, x, i, len(l) AS n, md5(array_to_string(l, ' ')) AS t FROM win),
rep AS (SELECT t FROM h WHERE n = 35 GROUP BY t HAVING count(*) > 1),
mark AS (SELECT doc_id, x, i, n = 35 AND t IN (SELECT t FROM rep) AS r FROM h),
cov AS (SELECT doc_id, x, i, bool_or(r) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
        FROM mark),
agg AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS kept
        FROM cov GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN agg USING (doc_id)
"""
