"""Toxicity by maximum-scoring segments.

Learning: document counts of words in toxic and other labelled documents (exact copies count once) give each word a
log-odds ratio under an informative Dirichlet prior (the corpus' own word shares plus a flat part); its token score is
the lower confidence bound of that ratio, where positive. All other tokens cost a small drift.

Scoring: one linear scan of a document's tokens finds all maximal scoring segments (Ruzzo and Tompa). With lambda and K
of the score distribution of clean text, a segment of score S in n tokens is expected ``K n exp(-lambda S)`` times by
chance (extreme-value statistics); segments below ``expect`` are significant. The logarithm of the best and of the
pooled segment expectations is turned into a probability by a logistic curve fitted to the training labels.

Learning uses at most ``sample`` labelled rows, chosen by a hash of the id, and at most ``lexicon`` words: both bounds
are parameters. Scoring reads every whole text.

Results for odd input: null or empty texts have no tokens and get the curve's value for no segment; unlabelled or
null-labelled rows are never learned from; without training rows of both kinds all scores are 0; repeated rows each
get their score; ties among equal segments do not matter to the score.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import ALNUM_WORD, from_texts, id_fold, lower_ascii, small_batches, table, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TO_LOWER = {c: c + 32 for c in range(65, 91)}


def learn(docs: DataFrame, labels: DataFrame, sample: int = 20000, lexicon: int = 4096, prior: float = 1000.0,
          flat: float = 0.5, bound: float = 1.96, drift: float = 0.05) -> dict:
    """The model: token scores, drift, lambda, K and the logistic curve."""
    chosen = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.join(F.broadcast(chosen), "doc_id").select("toxic", lower_ascii(F.col("text")).alias("text"))
    once = texts.groupBy(F.xxhash64("text").alias("h"), "toxic").agg(F.first("text").alias("text"))
    once = once.select("toxic", F.array_distinct(words(F.col("text"), ALNUM_WORD)).alias("w")).persist()
    try:
        rows = once.groupBy("toxic").agg(F.sum(F.size("w")).alias("n")).collect()
        n = {r["toxic"]: float(r["n"] or 0) for r in rows}
        if not (n.get(0) and n.get(1)):
            return {"scores": {}, "drift": drift, "lam": 1.0, "k": 1.0, "curve": None}
        counts = once.select("toxic", F.explode("w").alias("word")).groupBy("word").agg(
            F.sum("toxic").alias("y1"), F.sum(1 - F.col("toxic")).alias("y0"))
        alpha = flat + prior * (F.col("y0") + F.col("y1")) / (n[0] + n[1])
        a1, a0 = F.col("y1") + alpha, F.col("y0") + alpha
        ratio = F.log(a1 / (n[1] + prior - a1)) - F.log(a0 / (n[0] + prior - a0))
        low = ratio - bound * F.sqrt(1 / a1 + 1 / a0)
        best = counts.select("word", "y1", "y0", low.alias("s")).where("s > 0.5").orderBy(
            F.desc("s"), "word").limit(lexicon).collect()
    finally:
        once.unpersist()
    scores = {r["word"]: float(r["s"]) for r in best}
    # Shares of scored tokens in clean text: lambda solves sum(share * exp(lambda * score)) = 1.
    share = np.array([r["y0"] + flat for r in best] or [flat]) / (n[0] + flat * max(1, len(best)))
    value = np.array(list(scores.values()) or [1.0])
    lam = _root(lambda x: float(share @ np.exp(np.minimum(x * value, 500.0)) + (1 - share.sum()) * math.exp(-x * drift) - 1))
    model = {"scores": scores, "drift": drift, "lam": lam, "k": float(share.sum()), "curve": None}
    features = texts.mapInPandas(_features(model), "x double, y double, toxic int").toPandas()
    if len(features):
        model["curve"] = _logistic(features[["x", "y"]].to_numpy(), features["toxic"].to_numpy(float))
    return model


def _root(f, low: float = 1e-3, high: float = 20.0) -> float:
    if f(high) < 0:
        return high
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Newton steps for a ridge logistic regression with intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6, ridge, ridge])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(h, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def segments(found: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score), in linear time.

    found: (position, score) of the tokens with positive score, in order; every other token costs ``drift``.
    Ruzzo and Tompa's scan: each candidate keeps the running total before (l) and after it (r)."""
    stack: list[list] = []  # start, end, l, r, index of the nearest earlier candidate with smaller l
    total, last = 0.0, -1
    for pos, score in found:
        total -= drift * (pos - last - 1)
        last = pos
        own = [pos, pos, total, total + score, 0]
        total += score
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= own[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= own[3]:
                own[4] = j
                stack.append(own)
                break
            own[0], own[2] = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, r - left) for a, b, left, r, _ in stack]


def evidence(text: str, model: dict, expect: float = 0.05) -> tuple[float, float, list]:
    """-log10 of the best segment's expectation, log of the significant ones pooled, and those segments."""
    tokens = WORD.findall(text)
    scores = model["scores"]
    found = [(i, scores[t]) for i, t in enumerate(tokens) if t in scores]
    if not found:
        return 0.0, 0.0, []
    space = math.log(max(model["k"], 1e-9) * len(tokens))
    out = [(a, b, s, (model["lam"] * s - space) / math.log(10)) for a, b, s in segments(found, model["drift"])]
    good = [x for x in out if x[3] > -math.log10(expect)]
    best = min(30.0, max(x[3] for x in out))
    return max(0.0, best), math.log1p(sum(min(30.0, x[3]) for x in good)), good


def probability(best: float, pooled: float, model: dict) -> float:
    if not model["curve"]:
        return 0.0
    a, b, c = model["curve"]
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * best + c * pooled))))


def _features(model: dict):
    def run(batches):
        for batch in batches:
            rows = [evidence(t or "", model)[:2] for t in batch["text"]]
            yield pd.DataFrame({"x": [r[0] for r in rows], "y": [r[1] for r in rows], "toxic": batch["toxic"]})
    return run


def score(docs: DataFrame, model: dict, *keep: str) -> DataFrame:
    """The named columns of ``docs``, score and segments ("first-last" token numbers of significant passages)."""
    def work():
        def columns(texts):
            found = [evidence(t.translate(TO_LOWER) if t else "", model) for t in texts]
            return ([probability(x, y, model) for x, y, _ in found],
                    [",".join(f"{a}-{b}" for a, b, *_ in s) for _, _, s in found])
        return columns

    return from_texts(docs, work, "score double, segments string", *keep)


def clean(docs: DataFrame, model: dict, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, as they are."""
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([
                probability(*evidence(t.translate(TO_LOWER) if t else "", model)[:2], model) < threshold for t in texts],
                pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def training(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels whose crc32(doc_id) mod 3 is not 1, and all documents."""
    return docs.select("doc_id", "text"), labels.where(
        F.col("doc_id").isNotNull() & (id_fold(F.col("doc_id"), 3) != 1)).select("doc_id", "toxic")


def query(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(*training(docs, labels))
    return score(docs, model, "doc_id").select(
        "doc_id", (id_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "segments")
