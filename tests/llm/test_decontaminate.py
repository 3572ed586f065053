import random
import re

from pyspark.sql import functions as F

from cirrus.llm import op4_decontaminate as D


def brute(docs, items, n=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        w = cut(text)
        m = min(n, len(w))
        for i in range(len(w) - m + 1) if w else ():
            windows.setdefault(tuple(w[i: i + m]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w, hit, found = cut(text), set(), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if got := windows.get(tuple(w[i: i + m])):
                    hit.update(range(i, i + m))
                    found |= got
        out[doc] = (len(w), len(hit), len(found), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def test_against_brute_force_with_short_items(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 12, 13, 14, 40]))) for i in range(14)] + [(90, ""), (91, None)]
    docs = []
    for i in range(60):
        w = say(rng.randrange(0, 80)).split()
        for _ in range(rng.randrange(3)):
            part = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(part) + 1)
            w[rng.randrange(len(w) + 1):0] = [x.upper() for x in part[a: a + rng.randrange(30)]]
        docs.append((i, ", ".join(w)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in D.decontaminate(d, b).collect()}
    assert got == brute(docs, items)


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "word1 other1 word2 other2 " * 5), (1, None), (None, "No id, but text!")],
                                  "item_id long, text string")
    got = D.decontaminate(odd_docs.withColumn("pos", F.lit(1)).withColumn("item", F.lit(1)), bench).collect()
    assert len(got) == odd_docs.count()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in got if r["doc_id"] is None and r["n_words"]] == [(5, 4, True)]
    assert D.decontaminate(odd_docs, bench.limit(0)).where("contaminated").count() == 0
    assert D.decontaminate(no_docs, bench).count() == 0
