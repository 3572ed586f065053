import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cirrus.llm import op8_score as S

from .conftest import SF


def test_words_cut_in_blocks_as_alone():
    cut = S.Subwords()
    tokenizer, blocks = cut.t, []
    odd = ["", "a\u00a0b", "\u2003", "x\x85y", "\x1cz", "\u0120", "\u0120the", "'s", "it's", "<|endoftext|>", "na\u00efve", "\U0001f600!",
           "e\u0301", "\u65e5\u672c\u8a9e", "3.14", "\x00", "a\u200bb", "the"]
    for items in ([], [""], odd, odd[::-1], ["the", "cat's"] * 200 + ["a\u00a0b"] + ["zq1x2vk,"] * 130):
        alone = [tokenizer.encode(" " + w, add_special_tokens=False).ids or [0] for w in items]
        ids, starts = cut(items)
        assert ids.tolist() == [x for a in alone for x in a]
        assert starts.tolist() == [sum(map(len, alone[:i])) for i in range(len(alone))]
        assert len(starts) == len(items)
    batch = tokenizer.encode_batch_fast
    cut.t = type("Seen", (), {"encode_batch_fast": lambda self, part, **k: (blocks.extend(part), batch(part, **k))[1]})()
    cut(["word"] * 1000)
    assert len(blocks) == 16  # not 1,000


def test_gradients():
    rng = np.random.default_rng(0)
    net = S.Attention()
    x = rng.normal(0, 1, (2, S.WINDOW, S.DIM)).astype(np.float32)
    y, use = rng.integers(0, S.CLASSES, (2, S.WINDOW)), np.ones((2, S.WINDOW), np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    _, grad = net.step(x.astype(np.float64), y, use)
    for name, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, eps = net.p[name][at], 1e-5
        net.p[name][at] = old + eps
        up = net.step(x, y, use)[0]
        net.p[name][at] = old - eps
        down = net.step(x, y, use)[0]
        net.p[name][at] = old
        assert abs((up - down) / (2 * eps) - g[at]) < 1e-3 * max(1, abs(g[at])), name


def test_scoring_takes_two_classes_and_one_tokenizer():
    """A pass over the texts needs the log-probabilities of two classes only, and a process loads the tokenizer once."""
    h, klass = np.random.default_rng(1).normal(0, 1, (50, S.HIDDEN)).astype(np.float32), np.arange(50) % S.CLASSES
    net = S.Attention()
    whole = net.log_classes(h)
    own, rare = net.log_at(h, klass)
    assert np.allclose(own, whole[np.arange(50), klass], atol=1e-5) and np.allclose(rare, whole[:, S.RARE], atol=1e-5)
    assert S.subwords(S.TOKENIZER) is S.subwords(S.TOKENIZER)


def test_windows_score_each_position_once():
    for sizes in ([1], [31, 32, 33], [56, 57, 200, 1]):
        at, valid, scored = S.windows(np.array(sizes))
        assert Counter(at[scored].tolist()) == Counter(range(sum(sizes))) and not (scored & ~valid).any()


def test_base_score_and_gain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    train = docs.where(S.id_fold(F.col("doc_id"), 5) != 1)
    counts, n = Counter(), 0
    for r in train.collect():
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]).split()
        counts.update(w)
        n += len(w) + 1
    ends, v = train.count(), len(counts) + 1
    got = {r["doc_id"]: r for r in S.score(docs, train, top=500).collect()}
    for r in docs.collect():
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]).split()
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w) + math.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(w) + 1, sum(x in counts for x in w) + 1, n)
        assert abs(g["base_score"] - base) < 1e-6 * abs(base)
    assert sum(g["score"] for g in got.values()) > sum(g["base_score"] for g in got.values())


def test_invented_words_score_below_every_ordinary_text(spark):
    """Ordinary: at least half the tokens are known (some held-out texts here are mostly of unseen words themselves)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    train = docs.where(S.id_fold(F.col("doc_id"), 5) != 1)
    invented = spark.createDataFrame(
        [(-i, " ".join(f"zq{i}x{j}vk" for j in range(n))) for i, n in ((1, 5), (2, 60), (3, 400))], "doc_id long, text string")
    got = S.score(docs.union(invented), train).collect()
    mean = lambda r: r["score"] / r["n_tokens"]
    ordinary = [r for r in got if r["doc_id"] >= 0 and 2 * r["n_known"] >= r["n_tokens"]]
    assert len(ordinary) > 150
    assert max(mean(r) for r in got if r["doc_id"] < 0) < min(map(mean, ordinary))


def test_odd_rows(spark, odd_docs, no_docs):
    got = S.score(odd_docs.withColumn("h", F.lit(1)).withColumn("rare", F.lit(1)), odd_docs.where("doc_id < 6"), top=20).collect()
    assert len(got) == odd_docs.count() and all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    ones = [r for r in got if r["doc_id"] == 1]
    assert len(ones) == 2 and abs(ones[0]["score"] - ones[1]["score"]) < 1e-5 * abs(ones[0]["score"])
    assert S.score(no_docs, odd_docs, top=20).count() == 0
    alone = S.score(odd_docs, no_docs, top=20).collect()
    assert len(alone) == odd_docs.count() and all(r["n_known"] == 0 for r in alone)


def test_top_only_moves_the_lookup(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    train = docs.where(S.id_fold(F.col("doc_id"), 5) != 1)
    few, all_ = ({r["doc_id"]: r for r in S.score(docs, train, top=t).collect()} for t in (10, 1 << 18))
    for k, r in all_.items():
        for name in ("n_known", "base_score", "score", "spelled_score"):
            assert abs(few[k][name] - r[name]) < 1e-5 * abs(r[name]), name


def test_every_text_trains_the_model(spark):
    """Long texts, repeated and missing ones: neighbours, clusters, spelling and windows of all, not of a sample."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"Wo{rng.integers(0, 9)}x{rng.zipf(1.3) % 500}" for _ in range(n)) for n in (0, 1, 40, 400, 6000)]
    texts = [*texts, texts[2], texts[4], None, "once upon"]
    train = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    split, cut = [(t or "").lower().split() for t in texts], S.subwords(S.TOKENIZER)
    counts, size = Counter(w for t in split for w in t), cut.size
    subs = [cut(t)[0].tolist() for t in split]
    columns = np.argsort(-np.bincount([x for t in subs for x in t], minlength=size), kind="stable")[:S.NEIGHBOURS].tolist()
    near = Counter()
    for t in subs:
        near.update((a, b) for i, a in enumerate(t) for b in t[max(0, i - S.GAP): i] + t[i + 1: i + 1 + S.GAP])
    seen, whole = {}, {"neighbours": S.neighbours, "trained": S.trained, "of_types": S.of_types}
    try:
        for name, f in whole.items():
            setattr(S, name, lambda *a, n=name, f=f: seen.setdefault(n, []).append(f(*a)) or seen[n][-1])
        sent = S.vocabulary(train, 20)
        scorer = S.learn(train, sent[0], sent[1], sent[2], sent[5], 1, S.TOKENIZER)
    finally:
        for name, f in whole.items():
            setattr(S, name, f)
    got = {(int(x), columns[j]): int(n) for who, rows in seen["neighbours"][0] for x, row in zip(who, rows) for j, n in enumerate(row) if n}
    assert got == {k: n for k, n in near.items() if k[1] in columns}
    assert seen["trained"] == [len(S.windows(np.array([len(t) + 1 for t in split]))[0])]
    once = [w for w, n in counts.items() if n == 1]
    spelled = np.bincount(cut(once)[0], minlength=size) + 1.0
    assert np.allclose(scorer.spell, np.log10(spelled / (spelled.sum() + len(once) + 1)))
    alone = set(scorer.alone)
    assert len(alone) == S.ALONE and min(counts[w] for w in alone) >= max(n for w, n in counts.items() if w not in alone)
    assert len(seen["of_types"]) == S.ROUNDS + 1
    for moved in seen["of_types"][:-1]:
        assert moved[:, 0].sum() == sum(n for w, n in counts.items() if n > 1 and w not in alone)
    assert seen["of_types"][-1].sum() == sum(n for w, n in counts.items() if 1 < n < sent[2] and w not in alone)


def test_order_is_learned_from_texts_outside_the_sample(spark):
    """Texts above 24,000 bytes give no first weights; the attention learns their words' order all the same."""
    names = [f"{a}{b}" for a in "ka lo mi nu re".split() for b in "st pf rg nd lt".split()]
    turn = [" ".join(names[(i + j) % 25] for j in range(6500)) for i in range(30)]
    rng = np.random.default_rng(1)
    mixed = [" ".join(rng.permutation(t.split()[:500])) for t in turn[:5]]
    train = spark.createDataFrame([(i, t) for i, t in enumerate(turn)], "doc_id long, text string")
    asked = spark.createDataFrame([(i, " ".join(t.split()[:500])) for i, t in enumerate(turn[:5])] + [
        (-1 - i, t) for i, t in enumerate(mixed)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in S.score(asked, train).collect()}
    assert min(v for k, v in got.items() if k >= 0) > max(v for k, v in got.items() if k < 0) + 1
