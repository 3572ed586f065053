import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cirrus.llm import op11_fill as M

texts = st.lists(st.text(st.sampled_from("\n\r a\u0080éਊ日\U0001F600<P>"), max_size=30), max_size=12)
UNITS = {"line": lambda t: re.findall(r"[^\n]*\n|[^\n]+", t), "char": list}


def brute(doc_id, text, unit="line", seed="7:"):
    """n, form, prefix_chars, middle_chars, output by the definition, one text at a time."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    units = UNITS[unit](text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(texts, st.sampled_from(["line", "char"]), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1), st.sampled_from([1, 40, 1 << 20]))
def test_pieces_equal_units(found, unit, one, two, most):
    array = pa.array([t.encode() for t in ["skipped", *found]], pa.binary()).slice(1)
    draws = [np.full(len(found), d, np.int64) for d in (one, two)]
    for t, (n, p, m, s, chars, inner) in zip(found, M.pieces(array, draws, unit, most), strict=True):
        units = UNITS[unit](t)
        a, b = sorted((one % (len(units) + 1), two % (len(units) + 1)))
        want = ["".join(x) for x in (units[:a], units[a:b], units[b:])]
        assert [bytes(x).decode() for x in (p, m, s)] == want
        assert (n, chars, inner) == (len(units), len(want[0]), len(want[1]))


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=70))
def test_marks_rank_and_select(data):
    for marks, is_marked in ((M.line_ends, lambda x: x == 10), (M.char_starts, lambda x: x & 0xC0 != 0x80)):
        at = [i for i, x in enumerate(data) if is_marked(x)]
        found = M.Marks(marks(M.as_words(memoryview(data))))
        assert found.rank(np.arange(len(data) + 1)).tolist() == [sum(i < j for i in at) for j in range(len(data) + 1)]
        assert found.select(np.arange(len(at))).tolist() == at


def test_odd_documents_and_clashing_columns(spark, odd_docs, no_docs):
    more = spark.createDataFrame([(20, "a <S> b\nc", "en", "a", 1), (21, "a\nb\n", None, None, 1), (21, "a\nb\n", None, None, 1)],
                                 odd_docs.schema)
    docs = odd_docs.unionByName(more)
    wide = docs.withColumn("n", F.lit("x")).withColumn("output", F.lit(1)).withColumn("row", F.lit(2)).withColumn("h1", F.lit(3))
    for unit in ("line", "char"):
        got = M.transform(wide, unit)
        rebuilt = got.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
        key = lambda rows: sorted(map(repr, rows))
        assert key((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rebuilt) == key(
            (r["doc_id"], *brute(r["doc_id"], r["text"], unit)) for r in docs.collect())
        assert key((r["doc_id"], r["back"]) for r in rebuilt) == key((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert M.transform(wide, keep=("doc_id", "source", "h1")).columns[:3] == ["doc_id", "source", "h1"]
    assert M.transform(no_docs).count() == 0


def test_rates(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc").alias("text"))
    share = {r["form"]: r["count"] for r in M.transform(docs, rate=50, spm_rate=0).groupBy("form").count().collect()}
    assert set(share) == {"plain", "psm"} and 150 < share["plain"] < 250
