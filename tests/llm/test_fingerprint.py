import hashlib
import random
import re

from pyspark.sql import functions as F

from cirrus.llm import op7_fingerprint as P


def parts(text):
    return {p.rstrip(" ") for p in re.findall(r"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1,24}", text)}


def near(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_against_brute_force(spark):
    rng = random.Random(4)
    texts = {i: " ".join(f"w{rng.randrange(300)}{chr(10) if rng.random() < .1 else ''}" for _ in range(rng.choice([0, 1, 30, 400, 4000])))
             for i in range(0, 60, 2)}
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    ids = sorted(texts, reverse=True)
    for r in P.fingerprints(df).collect():
        t, nxt = texts[r["doc_id"]], texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        k = len(t) // 3
        e = t[: len(t) - k] + nxt[:k]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert abs(r["near_edited"] - near(parts(t), parts(e))) < 1e-12
        assert abs(r["near_next"] - near(parts(t), parts(nxt))) < 1e-12


def test_odd_rows(spark, odd_docs, no_docs):
    wide = odd_docs.withColumn("a", F.lit(1)).withColumn("x", F.lit(1)).withColumn("to_id", F.lit(1))
    got = P.fingerprints(wide).collect()
    assert len(got) == odd_docs.count()
    ones = [r for r in got if r["doc_id"] == 1]
    assert len(ones) == 2 and ones[0] == ones[1]
    one = P.fingerprints(odd_docs.where("doc_id = 2")).first()
    assert one["near_next"] == 1.0
    assert P.fingerprints(no_docs).count() == 0


def test_returned_fingerprints_give_the_likeness(spark):
    rng = random.Random(5)
    data = [(i, "\n".join(f"line {k} {rng.randrange(10**6)} {i}" for k in range(n))) for i, n in enumerate([1, 40, 41, 300, 2000])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    cell = "array<struct<c: long, k: long, x: long>>"
    signed = lambda h: int(h, 16) - (int(h, 16) >> 63 << 64)
    table = lambda t: [tuple(map(signed, c.split("."))) for c in t.split(":")]
    # Versions of one text that differ in 6 lines, compared by the returned text only.
    other = spark.createDataFrame([(i, "\n".join([f"new {k} {i}" for k in range(3)] + t.split("\n")[3:]))
                                   for i, t in data], "doc_id long, text string")
    a, b = ({r["doc_id"]: table(r["fingerprint"]) for r in P.fingerprints(d).collect()} for d in (df, other))
    for i, t in data:
        mine = len(t.split("\n"))
        assert sum(c for c, _, _ in a[i]) == 3 * mine and len(a[i]) >= P.CELLS * mine / P.LOAD
    got = spark.createDataFrame([(i, a[i], b[i]) for i in a], f"i long, t {cell}, u {cell}").selectExpr(
        "i", f"{P.difference('t', 'u')} AS d", f"{P.difference('t', 'transform(t, y -> y)')} AS same").collect()
    assert {r["i"]: r["d"] for r in got} == {i: 4 if i == 0 else 6 for i in a} and all(r["same"] == 0 for r in got)


def test_only_stuck_groups_are_built_again(spark, monkeypatch):
    """Three long texts, the next one all other: most groups peel by the returned tables, only the digests of the others are
    dealt again, and of these only those that are stuck once more."""
    texts = {i: "\n".join(f"line {k} of {i}" if k % 2 else f"line {k}" for k in range(1500)) for i in range(3)}
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    seen, levels, real, keep = [], [], P.differing, P.stored
    monkeypatch.setattr(P, "differing", lambda pairs: (seen.extend(pairs.collect()), real(pairs))[1])
    monkeypatch.setattr(P, "stored", lambda d, name: levels.append(name) or keep(d, name))
    got = {r["doc_id"]: r for r in P.fingerprints(df).collect()}
    for i, t in texts.items():
        a, b = parts(t), parts(texts[(i - 1) % 3])
        assert abs(got[i]["near_next"] - len(a & b) / len(a | b)) < 1e-12
    assert seen and max(len(r["a"]) + len(r["b"]) for r in seen) < 100  # not 3,000
    assert len({(r["doc_id"], r["kind"]) for r in seen}) < len(seen) < 6 * 256  # several groups of a pair, not all
    assert all((x ^ y) >> 7 & 127 == 0 for r in seen for x in r["a"] for y in r["a"])  # whole groups of 128 or 256
    assert "fingerprint_level" in levels


def test_differing_deals_digests_of_one_group_anew(spark):
    """Digests that agree in the bits that deal a text's own groups, in several rows of one id."""
    rows = [(i, [(k << 20) + i for k in range(n)], [(k << 20) + i for k in range(2, n + 3)]) for i, n in ((1, 60), (1, 9), (2, 0), (3, 2))]
    df = spark.createDataFrame(rows, "id long, a array<long>, b array<long>")
    assert {r["id"]: r["d"] for r in P.differing(df).collect()} == {1: 10, 2: 1, 3: 5}
