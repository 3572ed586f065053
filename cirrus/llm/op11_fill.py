"""Fill-in-the-middle transformation: texts cut at unit ends that are found eight bytes at a time.

The UTF-8 bytes of a whole Arrow batch are viewed as little-endian 64-bit words. The bytes that end a unit (a line, or a
code point) are marked by arithmetic on the words, their number in each word is a ``bitwise_count``, and running sums of
those counts give the marks before any byte. The end of a text's k-th unit is selected by a binary search of the running
sums for its word and by prefix sums inside the word. Characters of a piece are counted in the same way, as the bytes
that begin a code point. No text is decoded, and no loop runs over its bytes.

A text is cut at two pseudo-random unit ends, drawn from the digest of its id, and written as plain text,
prefix-suffix-middle or suffix-prefix-middle. The word arrays hold ``BATCH_BYTES`` of text at a time, or one text if that
is longer; an Arrow batch is bounded by the session (``spark.sql.execution.arrow.maxBytesPerBatch``). Everything but the
cutting (digests, drawing, rebuilding) is done by Spark's own functions.

Results for odd input: a null text is empty and plain with no unit; a text that holds a mark of the format stays plain;
an absent id is drawn as the empty text; the draws depend on the id alone, so rows that repeat it share them and repeated
rows stay rows; an empty table gives no rows; columns that are not asked for play no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from cirrus.llm.common import table

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "7:"

BATCH_BYTES = 16 << 20
ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
LINE_FEEDS = np.uint64(0x0A) * ONES
SEVEN, EIGHT, TOP_BYTE = np.uint64(7), np.uint64(8), np.uint64(56)


def line_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed, exactly: no carry crosses a byte."""
    x = words ^ LINE_FEEDS
    return ~(((x & LOW7) + LOW7) | x) & HIGH


def char_starts(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that begins a code point: all but 10xxxxxx."""
    return (~words | (words << np.uint64(1))) & HIGH


class Marks:
    """Marked bytes of a word array: how many lie before a byte, and where the r-th is."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before each of ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = self.marks[word] & ((np.uint64(1) << (byte << np.uint64(3))) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, r: np.ndarray) -> np.ndarray:
        """Byte of the r-th mark (from 0): its word by binary search, then the bytes whose prefix sum is at most the rest."""
        word = np.searchsorted(self.before, r, side="right") - 1
        rest = (r - self.before[word]).astype(np.uint64)
        sums = (self.marks[word] >> SEVEN) * ONES
        at_most = ((rest * ONES | HIGH) - sums) & HIGH
        return (word << 3) + np.bitwise_count(at_most)


def as_words(data: memoryview) -> np.ndarray:
    """The bytes as little-endian words, and at least one zero byte behind them."""
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return padded.view("<u8")


class Units:
    """The units of texts that lie end to end in ``data``; text i is the bytes ``offsets[i]`` to ``offsets[i + 1]``."""

    def __init__(self, data: memoryview, offsets: np.ndarray, unit: str = "line"):
        words = as_words(data)
        self.start, self.end = offsets[:-1], offsets[1:]
        self.chars = Marks(char_starts(words))
        if unit == "line":
            ends = line_ends(words)
        elif unit == "char":  # a byte ends a code point if the next one begins one
            starts = self.chars.marks
            ends = ((starts >> EIGHT) | (np.append(starts[1:], HIGH) << TOP_BYTE)) & HIGH
        else:
            raise ValueError(f"unit must be line or char, not {unit}")
        self.ends = Marks(ends)
        last = np.maximum(self.end - 1, self.start)
        self.first = self.ends.rank(self.start)
        #: Unit ends before the last byte; that byte ends the last unit, marked or not.
        self.inner = self.ends.rank(last) - self.first
        self.n = self.inner + (self.end > self.start)

    def after(self, k: np.ndarray) -> np.ndarray:
        """Byte after each text's first k units (0 <= k <= n)."""
        inner = (k > 0) & (k <= self.inner)
        out = np.where(k > 0, self.end, self.start)
        out[inner] = self.ends.select(self.first[inner] + k[inner] - 1) + 1
        return out

    def char_count(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.chars.rank(b) - self.chars.rank(a)


def slices(texts: pa.BinaryArray, most: int):
    """(first row, rows, their bytes, offsets in those) in pieces of at most ``most`` bytes, or one row if that is longer."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    data = memoryview(texts.buffers()[2] or b"")
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j - i, data[int(offsets[i]): int(offsets[j])], offsets[i: j + 1] - offsets[i]
        i = j


def pieces(texts: pa.BinaryArray, draw: list[np.ndarray], unit: str, most: int = BATCH_BYTES):
    """(n units, prefix, middle, suffix, characters of the first two) of each text, cut at its two drawn unit ends."""
    for i, rows, data, offsets in slices(texts, most):
        found = Units(data, offsets, unit)
        one, two = (d[i: i + rows] % (found.n + 1) for d in draw)
        a, b = found.after(np.minimum(one, two)), found.after(np.maximum(one, two))
        counts = found.char_count(found.start, a), found.char_count(a, b)
        for n, s, x, y, e, before, inside in zip(*(v.tolist() for v in (found.n, found.start, a, b, found.end, *counts)),
                                                 strict=True):
            yield n, data[s:x], data[x:y], data[y:e], before, inside


def draws(doc_id: Column, seed: str) -> list[Column]:
    """The first four 8-digit groups of the seeded digest of an id, as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, unit: str = "line", rate: int = 100, spm_rate: int = 50, seed: str = SEED,
              keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and n (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain), output.

    ``rate`` percent of the texts that can be transformed are, and ``spm_rate`` percent of those put the suffix first."""
    text = F.coalesce("text", F.lit(""))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    plain = (text == "") | (h3 % 100 >= rate)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(text, F.lit(mark))
    form = F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    # Kept columns travel as one struct, so their names cannot clash with those used here.
    rows = docs.select(F.struct(*keep).alias("row"), text.cast("binary").alias("text"), h1.alias("h1"), h2.alias("h2"),
                       form.alias("form"))
    schema = T.StructType([rows.schema["row"]]).add("n", "long").add("form", "string").add("prefix_chars", "long").add(
        "middle_chars", "long").add("output", "binary")
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))

    def run(batches):
        for batch in batches:
            row, texts, h1, h2, form = batch.columns
            made = {"n": [], "prefix": [], "middle": [], "output": []}
            for f, (n, before, inside, after, chars, inner) in zip(
                    form.to_pylist(), pieces(texts, [h1.to_numpy(), h2.to_numpy()], unit), strict=True):
                parts = {"plain": (before, inside, after), "psm": (p, before, s, after, m, inside),
                         "spm": (s, after, p, before, m, inside)}[f]
                made["n"].append(n)
                made["prefix"].append(None if f == "plain" else chars)
                made["middle"].append(None if f == "plain" else inner)
                made["output"].append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(made["n"], pa.int64()), form, pa.array(made["prefix"], pa.int64()),
                 pa.array(made["middle"], pa.int64()), pa.array(made["output"], pa.binary())], schema.names)

    return rows.mapInArrow(run, schema).select("row.*", "n", "form", "prefix_chars", "middle_chars",
                                               F.col("output").cast("string").alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output and its form stand for. Pieces hold no mark, so each mark is found once."""
    start = F.when(form == "spm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    inner = F.when(form == "spm", F.lit(PREFIX)).otherwise(F.lit(SUFFIX))
    one = F.split_part(F.split_part(output, start, F.lit(2)), inner, F.lit(1))
    two = F.split_part(F.split_part(output, inner, F.lit(2)), F.lit(MIDDLE), F.lit(1))
    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    return F.when(form == "plain", output).when(form == "spm", F.concat(two, middle, one)).otherwise(
        F.concat(one, middle, two))


def query(spark, sf_dir):
    made = transform(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                       digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units FROM t),
d AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS one,
         ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS two,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:least(one, two)], '') AS prefix,
         array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
         array_to_string(units[greatest(one, two) + 1:], '') AS suffix
  FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
