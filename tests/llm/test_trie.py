import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

from cirrus.llm import op12_trie as M

COLS = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    """The trie by walking every prefix of every conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    convs = dict(own)
    if rebuild:
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % 4
            convs[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + v[h:]
    nodes = {}
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            nodes.setdefault(tuple(convs[c][:d]), []).append(c)
    words = lambda t: len(re.findall(rb"[^\x20\x09-\x0D]+", t))
    out = []
    for p, m in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        kids = lambda q: sum(len(x) == len(q) + 1 and x[: len(q)] == q for x in nodes)
        out.append((m[0], len(p), nodes[p[:-1]][0] if p else None, len(m), kids(p), sum(not kids(q) for q in below),
                    sum((len(nodes[q]) - 1) * words(q[-1][1]) for q in below if q),
                    hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(p)).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [(0, 0, "user", "hi there"), (0, 1, "assistant", None), (0, 1, "assistant", "b"), (0, 1, "assistant", "a"),
       (3, None, "user", "first"), (3, 0, None, "x y z"), (3, 0, None, "x y z"), (5, 0, "user", ""), (21, 0, "user", "alone"),
       (None, 0, "user", "no id"), (-7, 0, "user", "hi there"), (-7, 1, "assistant", "ok"), (40, 5, "user", "hi there"),
       (9007199254740993, 0, "user", "hi there"), (41, 0, "a", "bc"), (42, 0, "ab", "c"), (43, 0, "user", "w " * 50000)]


def test_odd_conversations(spark):
    df = spark.createDataFrame(ODD, COLS)
    wide = df.withColumn("depth", df["turn"]).withColumn("len", df["turn"]).withColumn("a", df["text"]).withColumn("_part", df["turn"])
    assert rows_of(M.trie(*M.regrouped(wide))) == brute(ODD)
    assert rows_of(M.trie(*M.as_they_are(wide))) == brute(ODD, rebuild=False)
    assert M.trie(*M.regrouped(df.limit(0))).count() == 0


@pytest.mark.parametrize("block", [2, 7, 4096])
def test_shared_prefixes(spark, block, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 3)
    pick = random.Random(block)
    rows = [(c, t, pick.choice("ua"), pick.choice(["x", "y y"]) if t < 4 else f"{pick.random()}")
            for c in range(60) for t in range(pick.randint(1, 8))]
    rows += [(c, t, "u", "same words") for c in range(100, 130) for t in range(5)]
    assert rows_of(M.trie(*M.regrouped(spark.createDataFrame(rows, COLS)), block)) == brute(rows)


def test_ranks_of_a_shuffled_list(spark):
    order = list(range(500))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, [*order[1:], M.LAST])), "arc long, succ long")
    assert {r["arc"]: r["pos"] for r in M.list_rank(links, 40).collect()} == {a: i for i, a in enumerate(order)}


def test_chains_of_a_block():
    got = M.chains(pd.DataFrame({"arc": [5, 1, 3, 9], "succ": [9, 5, 77, -1], "w": [2, 1, 4, 8]})).set_index("arc")
    assert got["head"].to_dict() == {1: 1, 3: 3, 5: 1, 9: 1} and got["off"].to_dict() == {1: 0, 3: 0, 5: 1, 9: 3}
    assert got.loc[1, ["succ", "w"]].tolist() == [-1, 11] and got.loc[3, ["succ", "w"]].tolist() == [77, 4]
