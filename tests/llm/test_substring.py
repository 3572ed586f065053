import random
from collections import Counter

from pyspark.sql import functions as F

from cirrus.llm import op3_substring as S


def brute(texts, width):
    words = [(t or "").split() for t in texts]
    seen = Counter(tuple(w[i: i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i: i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_against_brute_force(spark):
    rng = random.Random(2)
    passages = [[f"p{rng.randrange(50)}" for _ in range(rng.choice([7, 8, 9, 20, 60]))] for _ in range(8)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts += rng.choice(passages) if rng.random() < 0.6 else [f"q{rng.randrange(3000)}" for _ in range(rng.randrange(20))]
        texts.append(" ".join(parts))
    texts += [texts[0], "a " * 40, "a b " * 30, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for width in (8, 12):
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in S.dedup(df, width).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, width)


def test_odd_rows(spark, odd_docs, no_docs):
    got = S.dedup(odd_docs.withColumn("key", F.lit(1)).withColumn("spans", F.lit(1)), 8).collect()
    texts = [r["text"] for r in odd_docs.collect()]
    assert sorted((r["n_words"], r["n_removed"], r["kept"]) for r in got) == sorted(brute(texts, 8))
    assert S.dedup(no_docs).count() == 0
