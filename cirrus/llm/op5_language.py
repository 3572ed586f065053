"""Language by compression: the language whose dictionary makes a text smallest.

Each language learned has a raw-content zstandard dictionary of up to ``dict_bytes`` bytes of its own training texts
(the bound is a parameter; the texts are chosen by their hashes, long ones give a piece). A text is compressed whole, in blocks, with every
dictionary; the smallest total names the language. ``margin`` is the distance to the runner-up in share of the best;
the general operator rejects margins under ``reject`` by answering ``und`` (column ``rejected`` says so).

Results for odd input: a text that is null or has no letter is ``und`` with score 0; equal sizes go to the language
that comes first by name; training rows without language are not learned from; without training rows all are ``und``;
repeated rows each get their answer.
"""

from __future__ import annotations

import math

import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cirrus.llm.common import from_texts, id_fold, table

#: Bytes compressed at a time; a block is small enough that the dictionary matters, large enough to be quick.
BLOCK = 4096
LEVEL = 6


def learn(docs: DataFrame, dict_bytes: int = 112 << 10, languages: int = 256, most: int = 512) -> dict[str, bytes]:
    """Dictionary bytes by language, from rows (doc_id, text, lang). At most ``languages`` languages, the commonest.

    Each language takes up to ``most`` texts in the order of their hashes until ``dict_bytes`` are full. A text above a
    quarter of that size gives one piece of a sixteenth as many characters, at a place chosen by its hash: no single
    document fills a dictionary, and a language that has only long texts is learned like the others."""
    longest, piece = dict_bytes // 4, max(1, dict_bytes // 16)
    rows = docs.where("lang IS NOT NULL AND octet_length(text) > 0").select(
        "lang", "text", F.xxhash64("text").alias("k"), F.octet_length("text").alias("n"))
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    order = Window.partitionBy("lang").orderBy("k")
    # Chosen on hashes and sizes alone (copies of a text count once); then only the chosen texts are moved. The smallest
    # hashes are first found in 64 parts of a language, so that the last window reads at most 64 * most of its rows.
    part = Window.partitionBy("lang", F.pmod("k", F.lit(64))).orderBy("k")
    sized = rows.groupBy("lang", "k").agg(F.max(F.when(F.col("n") <= longest, F.col("n")).otherwise(piece)).alias("n"))
    sized = sized.withColumn("i", F.row_number().over(part)).where(F.col("i") <= most)
    sized = sized.withColumn("i", F.row_number().over(order)).where(F.col("i") <= most)
    sized = sized.withColumn("before", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))).where(
        F.coalesce("before", F.lit(0)) < dict_bytes)
    cuts = sized.groupBy("lang").agg(F.max("k").alias("cut")).join(common.select("lang"), "lang")
    room = F.char_length("text") - piece
    cut = F.substring("text", F.when(room > 0, F.pmod("k", room + 1)).otherwise(0).cast("int") + 1, F.lit(piece))
    few = rows.join(F.broadcast(cuts), "lang").where(F.col("k") <= F.col("cut")).withColumn(
        "text", F.when(F.col("n") <= longest, F.col("text")).otherwise(cut)).groupBy("lang", "k").agg(F.min("text").alias("text"))
    texts: dict[str, bytearray] = {}
    for r in few.orderBy("lang", "k").collect():
        texts.setdefault(r["lang"], bytearray()).extend(r["text"].lower().encode() + b"\n")
    return {k: bytes(v[:dict_bytes]) for k, v in texts.items()}


class Sizes:
    """Compressed sizes of a text under every dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.packers = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                         write_checksum=False, write_dict_id=False))

    def __call__(self, text: str) -> list[int]:
        raw = text.lower().encode("utf-8", "replace")
        blocks = [raw[i: i + BLOCK] for i in range(0, len(raw), BLOCK)]
        return [sum(len(p.compress(b)) for b in blocks) for p in self.packers]

    def answer(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (probability of the best against the others by size per word-sized unit) and margin."""
        if not self.names or not text or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0
        sizes = self(text)
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        rest = [s for i, s in enumerate(sizes) if i != best]
        if not rest:
            return self.names[best], 1.0, 1.0
        # A few bytes of difference decide a short text; a long one needs a share of its length.
        unit = 1.5 + 0.003 * sizes[best]
        share = 1 / (1 + sum(math.exp(-min(700.0, (s - sizes[best]) / unit)) for s in rest))
        return self.names[best], share, (min(rest) - sizes[best]) / max(1, sizes[best])


def classify(docs: DataFrame, dictionaries: dict[str, bytes], *keep: str, reject: float = 0.01) -> DataFrame:
    """The named columns of ``docs``, nearest (smallest language), lang_pred (und where rejected), score, rejected."""
    def work():
        sizes = Sizes(dictionaries)

        def columns(texts):
            got = [sizes.answer(t) for t in texts]
            low = [g[2] < reject for g in got]
            return ([g[0] for g in got], ["und" if r else g[0] for g, r in zip(got, low, strict=True)],
                    [g[1] for g in got], low)
        return columns

    return from_texts(docs, work, "nearest string, lang_pred string, score double, rejected boolean", *keep)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(id_fold(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang"))
    return classify(docs, model, "doc_id").select(
        "doc_id", (id_fold(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("nearest").alias("lang_pred"),
        "score", "rejected")
