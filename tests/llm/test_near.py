import random

from pyspark.sql import functions as F

from cirrus.llm import op2_near as N

from .conftest import DOCS


def brute(docs, words, percent):
    sets = {}
    for i, text in docs:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        n = min(words, len(w))
        sets[i] = {tuple(w[j: j + n]) for j in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                i, j = sorted((find(a), find(b)))
                root[j] = i
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_against_all_pairs(spark):
    rng = random.Random(1)
    docs = []
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(80)]
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 3, 5, 8])):
                copy[rng.randrange(80)] = f"e{rng.randrange(1000)}"
            docs.append((len(docs), " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for words in (2, 5):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(df, words=words).collect()}
        assert got == brute(docs, words, 80)


def test_odd_sketch_estimates_high_similarity():
    import numpy as np
    s = N.Sketcher(64, 8, 1024)
    rng = np.random.default_rng(0)
    for j in (0.8, 0.9):
        both, own = int(4000 * j), int(4000 * (1 - j) / 2)
        x = rng.integers(0, 1 << 63, both + 2 * own).astype(np.uint64)
        odd = [s.sketch(s.minima(p))[1].view(np.uint8) for p in (x[: both + own], np.r_[x[:both], x[both + own:]])]
        apart = int(np.unpackbits(odd[0] ^ odd[1]).sum())
        assert s.limit(j + 0.07) < apart < s.limit(j - 0.07)


def test_odd_rows(spark, odd_docs, no_docs):
    got = N.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[2]["component_id"] == 1 and by[3]["n_shingles"] == 0 and by[3]["component_id"] == 3 and by[5]["kept"]
    kept = N.one_of_each(odd_docs.withColumn("component", F.lit(1)).withColumn("_th", F.lit(2)))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8, 9, 10, 9007199254740993]
    assert kept.columns == [*odd_docs.columns, "component", "_th"]
    assert N.near_duplicates(no_docs).count() == 0 and N.one_of_each(no_docs).count() == 0
