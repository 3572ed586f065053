"""Scoring texts with a small causal self-attention model trained in numpy.

Tokens are words and one end for each text. The corpus is counted whole: every training word's count comes from one
aggregation, so what scoring gathers grows with the corpus. ``top`` bounds the words sent to the tasks with their
counts; all other words are scored through joins with the counts. It does not enter the model: a text's score is the
same whether a word's count is sent or joined.

The attention reads word vectors: a word's input is the mean of its subwords' vectors (from their co-occurrence in all
training texts), one masked self-attention layer looks back over the window, and the output is a distribution
over word classes: the ``ALONE`` commonest words, clusters of the other words seen twice or more (by their vectors), the
words seen once, the end. A word's probability is its class' probability times its share of the class' training tokens.
The class of words seen once also keeps as many tokens for unseen words, so it is trained at every size of the corpus;
``score`` takes as many unseen words as there are words seen once, each as likely as one of those. ``spelled_score``
tells them apart by their subwords' probabilities instead. Windows of ``WINDOW`` tokens overlap by ``CONTEXT``; each token is scored once, with at least that much
context except at the text's start.

Every part of the model is fitted on all training texts: the subwords' neighbours are counted in every text, the clusters
weigh every word seen twice or more, the spelling counts every word seen once, and each window of each text is a training
example once. For that the texts are stored as word numbers, in blocks that a hash deals to shards; each shard's task trains on its
windows from the same weights, and the weights are averaged by the shards' windows. A few whole texts give these first weights.

Words are joined by 64-bit hashes. Results for odd input: null or empty texts have the end token only; without training
texts all words are unknown; repeated rows each get their score; ids may be absent or repeated.
"""

from __future__ import annotations

import copy
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import id_fold, keyed, lower_ascii, sample_of_texts, small_batches, stored, table, words

WINDOW, CONTEXT = 32, 8
DIM, HIDDEN, CLASSES = 16, 24, 64
#: The most frequent words that are classes of their own; then clusters, the rare class and the end of a text.
ALONE = 30
RARE, END = CLASSES - 2, CLASSES - 1
#: Neighbours of a subword: at most GAP away, among the commonest subwords. Their counts are summed in BLOCKS ranges of subwords.
GAP, NEIGHBOURS, BLOCKS = 6, 200, 1024
#: Windows of a training step over all texts, blocks of texts in a shard, rounds of the clustering.
BATCH, SHARD, ROUNDS = 96, 16, 12
#: Sums of exp stay in 32-bit floats below this.
SAFE = 40.0
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


#: Words that are cut alone: without a character, or with white space of another kind than divides words.
ALONE_CUT = re.compile(r"\s|^$")
BLOCK = 64


class Subwords:
    """Subword ids of words, each word with a leading space.

    Words are cut in blocks joined by spaces, as the tokenizer never crosses a space; a word begins at each subword that
    begins with one."""

    def __init__(self, path: str = TOKENIZER):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.t.encode_special_tokens = True
        self.size = self.t.get_vocab_size()
        self.begins = np.array([(self.t.id_to_token(i) or "").startswith("\u0120") for i in range(self.size)], bool)

    def __call__(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the start of each word's."""
        apart = [i for i, w in enumerate(items) if ALONE_CUT.search(w)]
        ids, sizes, done = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for i in [*apart, len(items)]:
            whole = [" " + " ".join(items[j: min(j + BLOCK, i)]) for j in range(done, i, BLOCK)]
            ids.extend(np.array(e.ids, np.int64) for e in self.t.encode_batch_fast(whole, add_special_tokens=False))
            run = np.concatenate(ids[-len(whole):]) if whole else ids[0]
            sizes.append(np.diff(np.r_[np.flatnonzero(self.begins[run]), len(run)]))
            if i < len(items):
                ids.append(np.array(self.t.encode(" " + items[i], add_special_tokens=False).ids or [0], np.int64))
                sizes.append(np.array([len(ids[-1])]))
            done = i + 1
        return np.concatenate(ids), np.cumsum(np.r_[0, np.concatenate(sizes)])[:-1] if items else np.zeros(0, np.int64)


@lru_cache(maxsize=1)
def keep_freed() -> None:
    """Once an array of this size was freed, glibc keeps smaller ones for the next instead of returning them page by page."""
    np.empty(8 << 20, np.uint8)


def planes(a: np.ndarray) -> bytes:
    """32-bit numbers, all first bytes before all second ones and so on: mostly small, they compress to half."""
    return a.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<i4").ravel()


@lru_cache(maxsize=1)
def subwords(path: str) -> Subwords:
    """The tokenizer of this process: loading it takes longer than a small task's words."""
    keep_freed()
    return Subwords(path)


def means(table_: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros((0, table_.shape[1]), np.float32)
    sizes = np.diff(np.r_[starts, len(ids)])
    return (np.add.reduceat(table_[ids], starts, 0) / sizes[:, None]).astype(np.float32)


def add_neighbours(near: np.ndarray, ids: np.ndarray, column: np.ndarray) -> None:
    """Adds to ``near`` (a subword's counts by column, end to end) the pairs of subwords at most GAP apart.

    ids: texts with GAP of the last subword, which stands for none, before and after each."""
    at = np.flatnonzero(column[ids] >= 0)
    by, base = column[ids[at]], ids * NEIGHBOURS
    one = near.dtype.type(1)  # of another type, numpy takes twenty times as long
    for gap in range(1, GAP + 1):
        np.add.at(near, base[at - gap] + by, one)
        np.add.at(near, base[at + gap] + by, one)


def subword_vectors(blocks: list[tuple[np.ndarray, np.ndarray]], size: int, dim: int) -> np.ndarray:
    """Vectors of subwords from the positive mutual information with their neighbours among the commonest subwords.

    blocks: subwords, and the counts of their neighbours."""
    column = sum((near.sum(0, dtype=np.float64) for _, near in blocks), np.zeros(NEIGHBOURS))
    total = column.sum() + 1e-9

    def positive(near):
        info = near.sum(1, keepdims=True, dtype=np.float64) * column / total
        return np.log(np.maximum((near + 1e-9) / (info + 1e-9), 1.0)) * (near > 0)

    gram = np.zeros((NEIGHBOURS, NEIGHBOURS))
    for _, near in blocks:
        part = positive(near)
        gram += part.T @ part
    axes = np.linalg.eigh(gram)[1][:, ::-1][:, :dim]
    out = np.zeros((size, dim), np.float32)
    for who, near in blocks:
        own = positive(near) @ axes
        norm = np.linalg.norm(own, axis=1, keepdims=True)
        out[who] = own / np.maximum(norm, 1e-6) * (norm > 0)
    return out


def numbered(items: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct items, and each item's place among them."""
    place: dict[str, int] = {}
    where = np.fromiter((place.setdefault(w, len(place)) for w in items), np.int64, len(items))
    return list(place), where


class Attention:
    """One layer of masked self-attention over a window, then a distribution over classes for the next token."""

    def __init__(self, dim: int = DIM, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 2):
        rng = np.random.default_rng(seed)
        f = lambda *s: (rng.normal(0, 1, s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"qkv": f(dim, 3 * dim), "far": np.zeros(WINDOW, np.float32), "ws": f(dim, hidden), "wz": f(dim, hidden),
                  "bh": np.zeros(hidden, np.float32), "wo": f(hidden, classes) * 0.3, "bo": np.zeros(classes, np.float32)}
        self.dim = dim
        self.apart = np.maximum(np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :], 0)
        self.hidden_from = np.where(np.tri(WINDOW, dtype=bool), 0, -1e9).astype(np.float32)

    def forward(self, x: np.ndarray):
        p, d = self.p, self.dim
        qkv = x @ p["qkv"]
        q, k, v = qkv[..., :d], qkv[..., d: 2 * d], qkv[..., 2 * d:]
        s = q @ np.ascontiguousarray(k.transpose(0, 2, 1))
        s *= np.float32(d**-0.5)
        s += p["far"][self.apart] + self.hidden_from
        # The largest of each row is taken off only where exp could overflow: it costs more than all the rest.
        most = np.linalg.norm(p["qkv"][:, :d] @ p["qkv"][:, d: 2 * d].T) * d**-0.5 * float((x * x @ np.ones(d, x.dtype)).max(initial=0))
        if not most + np.abs(p["far"]).max() < SAFE:
            s -= s.max(2, keepdims=True)
        a = np.exp(s, out=s)
        a /= (a @ np.ones(a.shape[2], a.dtype))[..., None]
        z = a @ v
        h = np.tanh(x @ p["ws"] + z @ p["wz"] + p["bh"])
        return h, (q, k, v, a, z)

    def outputs(self, h: np.ndarray) -> np.ndarray:
        """Logarithms of the classes' weights, none too large for exp."""
        o = h @ self.p["wo"]
        o += self.p["bo"]
        if not (np.abs(self.p["wo"]).sum(0) + np.abs(self.p["bo"])).max() < SAFE:  # h is between -1 and 1
            o -= o.max(-1, keepdims=True)
        return o

    def log_classes(self, h: np.ndarray) -> np.ndarray:
        o = self.outputs(h)
        return o - np.log(np.exp(o).sum(-1, keepdims=True))

    def log_at(self, h: np.ndarray, klass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``log_classes`` at one class for each row, and at the class of words seen once."""
        o = self.outputs(h)
        own, rare = o[np.arange(len(o)), klass], o[:, RARE].copy()
        whole = np.log(np.exp(o, out=o) @ np.ones(o.shape[1], o.dtype))
        return own - whole, rare - whole

    def step(self, x: np.ndarray, y: np.ndarray, use: np.ndarray):
        """Mean loss over the used positions and gradients."""
        p, d = self.p, self.dim
        h, (q, k, v, a, z) = self.forward(x)
        flat = lambda m: m.reshape(-1, m.shape[-1])
        fh, share = flat(h), (use.ravel() / use.sum()).astype(h.dtype)
        do, own = self.outputs(fh), (np.arange(fh.shape[0]), y.ravel())
        right = do[own]
        whole = np.exp(do, out=do) @ np.ones(do.shape[1], do.dtype)
        loss = ((np.log(whole) - right) * share).sum()
        do *= (share / whole)[:, None]
        do[own] -= share
        g = {"wo": fh.T @ do, "bo": do.sum(0)}
        dh = (do @ p["wo"].T).reshape(h.shape)
        dh *= 1 - h * h
        g |= {"ws": flat(x).T @ flat(dh), "wz": flat(z).T @ flat(dh), "bh": flat(dh).sum(0)}
        dz = dh @ p["wz"].T
        ds, dv = dz @ np.ascontiguousarray(v.transpose(0, 2, 1)), a.transpose(0, 2, 1) @ dz
        ds -= (ds * a @ np.ones(a.shape[2], a.dtype))[..., None]
        ds *= a
        g["far"] = np.bincount(self.apart.ravel(), (ds.sum(0) * np.tri(WINDOW)).ravel(), WINDOW).astype(np.float32)
        ds *= np.float32(d**-0.5)
        g["qkv"] = flat(x).T @ flat(np.concatenate([ds @ k, ds.transpose(0, 2, 1) @ q, dv], 2))
        return float(loss), g

    def train(self, x, y, use, steps: int = 300, batch: int = 48, rate: float = 0.02) -> list[float]:
        rng = np.random.default_rng(4)
        rows = (rng.integers(0, len(x), batch) for _ in range(steps))
        return self.fit(((x[r], y[r], use[r]) for r in rows), steps, rate)

    def fit(self, batches, steps: int, rate: float = 0.02) -> list[float]:
        """One step for each of the batches (x, y, use)."""
        losses = []
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for i, one in enumerate(batches, 1):
            loss, grad = self.step(*one)
            losses.append(loss)
            lr = rate * (1 - i / (steps + 1))
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= (lr * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        return losses

    def weights(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)]).astype(np.float64)

    def take(self, weights: np.ndarray) -> None:
        for k in sorted(self.p):
            part, weights = np.split(weights, [self.p[k].size])
            self.p[k] = part.reshape(self.p[k].shape).astype(np.float32)


def windows(sizes: np.ndarray):
    """Overlapping windows over texts of these token counts, laid end to end.

    Returns (rows of positions (windows, WINDOW), valid, scored): each position of a text is scored in one window."""
    step = WINDOW - CONTEXT
    count = 1 + np.maximum(0, -(-(sizes - WINDOW) // step))
    base = np.r_[0, np.cumsum(sizes)[:-1]]
    doc = np.repeat(np.arange(len(sizes)), count)
    turn = np.arange(count.sum()) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count)
    at = turn[:, None] * step + np.arange(WINDOW)[None, :]
    valid = at < sizes[doc][:, None]
    scored = valid & ((turn[:, None] == 0) | (np.arange(WINDOW)[None, :] >= CONTEXT))
    return base[doc][:, None] + np.where(valid, at, 0), valid, scored


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The nearest centre of each vector; the same in every batch: a fast product's rounding decides no near tie."""
    near = x @ centre.T * 2 - (centre**2).sum(1)
    out, rows = near.argmax(1), np.arange(len(x))
    best = near[rows, out]
    near[rows, out] = -np.inf
    close = np.flatnonzero(best - near.max(1) < 1e-4)
    for i in range(0, len(close), 256):  # small enough for the cache
        some = close[i: i + 256]
        apart = x[some, None, :].astype(np.float64) - centre
        apart *= apart
        out[some] = apart.sum(2).argmin(1)
    return out


class Scorer:
    """Everything a task needs; its size is bounded by the parameters, not by the corpus."""

    def __init__(self, vectors: np.ndarray, alone: list[str], centre: np.ndarray, spelled: np.ndarray, ends: int, path: str):
        """alone: the commonest words; spelled: subwords of the ``ends`` words seen once."""
        self.path, self.vectors, self.centre = path, vectors, centre
        self.alone = {w: i for i, w in enumerate(alone)}
        # Subwords of the words seen once, and one end of the word, with add-one counts.
        spelled = spelled + 1.0
        self.spell = np.log10(spelled / (spelled.sum() + ends + 1))
        self.spell_end = float(np.log10((ends + 1.0) / (spelled.sum() + ends + 1)))
        self.start = np.full(DIM, 0.1, np.float32)
        self.net = Attention()

    def begin(self, sample: list[list[str]], once: set[str], cut: Subwords) -> None:
        """The first weights, from a few whole texts. once: their words of the class of words seen once."""
        distinct, where = numbered([w for text in sample for w in text])
        x, klass = self.look(distinct, cut)
        klass[[i for i, w in enumerate(distinct) if w in once]] = RARE
        if sample:
            xs, ks, at, valid, scored = self.examples(x[where], klass[where], np.array([len(text) for text in sample]))
            self.net.train(xs[at] * valid[..., None], ks[at], scored.astype(np.float32))

    def examples(self, x: np.ndarray, klass: np.ndarray, sizes: np.ndarray):
        """Inputs and target classes of texts of these words, end to end, and their windows.

        Inputs are the tokens before: a start, then all words; targets are all words, then the end."""
        begin = np.r_[0, np.cumsum(sizes)]
        return (np.insert(x, begin[:-1], self.start, axis=0), np.insert(klass, begin[1:], END).astype(np.int64),
                *windows(sizes + 1))

    def classes(self, items: list[str], x: np.ndarray) -> np.ndarray:
        """Classes of words, with their vectors, that training has twice or more."""
        out = ALONE + nearest(x, self.centre)
        for i, w in enumerate(items):
            if w in self.alone:
                out[i] = self.alone[w]
        return out

    def look(self, items: list[str], cut: Subwords) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and classes of words."""
        x = np.concatenate([np.zeros((0, DIM), np.float32), *(
            means(self.vectors, *cut(items[i: i + 20000])) for i in range(0, len(items), 20000))])
        return x, self.classes(items, x)

    def hold(self, names: list[str], count: np.ndarray, others: np.ndarray, once: int, once_names: np.ndarray, cut: Subwords) -> None:
        """Takes the words sent to the tasks. others: training tokens by class of the words seen twice or more that are
        not sent; once: the number of words that training has once; once_names: which of the names train their class."""
        self.count = count
        self.x, klass = self.look(names, cut)
        self.klass = np.where(count > 1, klass, RARE).astype(np.int16)
        self.target = np.where(once_names, RARE, klass).astype(np.int16)
        self.weight = np.log10(np.maximum(others + np.bincount(self.klass, count, CLASSES), 1))
        self.share = np.where(count > 1, np.log10(count) - self.weight[self.klass], -np.log10(max(2, 2 * once)))

    def inputs(self, number: np.ndarray, rest: pa.StringArray, cut: Subwords):
        """Input vectors; numbers below 0 take the words of ``rest`` in order. And those words' classes, if seen twice or
        more, and spelling probabilities."""
        x = self.x[np.maximum(number, 0)] if len(self.x) else np.zeros((len(number), DIM), np.float32)
        if not len(rest):
            return x, np.zeros(0, np.int64), np.zeros(0)
        coded = rest.dictionary_encode()
        distinct, where = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        ids, starts = cut(distinct)
        own = means(self.vectors, ids, starts)
        x[number < 0] = own[where]
        return x, self.classes(distinct, own)[where], (np.add.reduceat(self.spell[ids], starts) + self.spell_end)[where]


def vocabulary(train: DataFrame, top: int):
    """(counts (word, h, c) of all training words; the commonest words as a pandas table (word, h, c), the least count of
    one; totals)."""
    counts = stored(train.select(F.explode(words(lower_ascii(F.col("text")))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("c")).select("word", F.xxhash64("word").alias("h"), "c"), "score_counts")
    # The least count of a common word, from the counts of counts (small): at most ``top`` words have it.
    sizes = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()
    least, room = 1 << 62, top
    for r in sorted(sizes, key=lambda r: -r["c"]):
        if r["n"] > room:
            break
        least, room = r["c"], room - r["n"]
    common = counts.where(F.col("c") >= least).select("word", "h", "c").toPandas().sort_values(
        ["c", "word"], ascending=[False, True])
    tokens = sum(r["c"] * r["n"] for r in sizes)
    types = sum(r["n"] for r in sizes)
    once = sum(r["n"] for r in sizes if r["c"] == 1)
    return counts, common, least, tokens, types, once


def by_hash(common) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of these words in order, and the words' numbers."""
    hashes = common["h"].to_numpy(np.int64)
    order = np.argsort(hashes)
    return hashes[order], order


def looked_up(hashes: np.ndarray, order: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' numbers by their hashes, -1 for others, and where the others are."""
    if not len(hashes):
        return np.full(len(flat), -1), np.arange(len(flat))
    place = np.minimum(np.searchsorted(hashes, flat), len(hashes) - 1)
    number = np.where(hashes[place] == flat, order[place], -1)
    return number, np.flatnonzero(number < 0)


def cut_types(types: DataFrame, least: int, path: str) -> DataFrame:
    """The subwords of training words (word, c, alone, single), each word cut once, stored. A row holds either

    ids, lens, c, kind: subwords, their number, tokens and kind of many words seen twice or more that are not alone; kind: 1
    where the clusters are made of it, 2 where it is not sent to the tasks; or
    subword, tokens, spelled, ends: a task's subwords, their training tokens and number in single words; these words."""
    small_batches(types.sparkSession, 10000)

    def run(batches):
        cut = subwords(path)
        tokens, spelled, ends = np.zeros(cut.size), np.zeros(cut.size), 0
        names = ["ids", "lens", "c", "kind", "subword", "tokens", "spelled", "ends"]
        for batch in batches:
            ids, starts = cut(batch.column(0).to_pylist())
            lens = np.diff(np.r_[starts, len(ids)])
            c, alone, single = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            tokens += np.bincount(ids, np.repeat(c, lens), cut.size)
            spelled += np.bincount(ids[np.repeat(single, lens)], minlength=cut.size)
            ends += int(single.sum())
            more = (c > 1) & ~alone
            kind = (~single + 2 * (c < least)).astype(np.int8)
            blobs = (ids[np.repeat(more, lens)].astype(np.int32), lens[more].astype(np.int32), c[more].astype(np.int64), kind[more])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([v.tobytes()], pa.binary()) for v in blobs), pa.nulls(1, pa.list_(pa.int32())),
                 *(pa.nulls(1, pa.list_(pa.int64())) for _ in range(2)), pa.nulls(1, pa.int64())], names)
        some = np.flatnonzero(tokens)
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(1, pa.binary()) for _ in range(4)), pa.array([some.astype(np.int32)], pa.list_(pa.int32())),
             *(pa.array([v[some].astype(np.int64)], pa.list_(pa.int64())) for v in (tokens, spelled)), pa.array([ends], pa.int64())], names)

    return stored(types.select("word", "c", "alone", "single").mapInArrow(
        run, "ids binary, lens binary, c binary, kind binary, subword array<int>, tokens array<long>, spelled array<long>, ends long"),
        "score_types")


def of_types(cut: DataFrame, vectors, centre: np.ndarray, work) -> np.ndarray:
    """The sum over all blocks of ``cut_types`` of ``work(x, c, kind, centre)``, an array as long as the centres."""

    def run(batches):
        keep_freed()
        found = 0.0
        for batch in batches:
            for ids, lens, c, kind in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                lens = np.frombuffer(lens, np.int32)
                x = means(vectors.value, np.frombuffer(ids, np.int32), np.cumsum(np.r_[0, lens])[:-1])
                found = found + work(x, np.frombuffer(c, np.int64).astype(np.float64), np.frombuffer(kind, np.int8), centre)
        if not np.isscalar(found):
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["v"])

    rows = cut.where("ids IS NOT NULL").select("ids", "lens", "c", "kind").mapInArrow(run, "v binary").collect()
    return sum((np.frombuffer(r["v"]).reshape(len(centre), -1) for r in rows), np.zeros((len(centre), 1)))


def _moved(x, c, kind, centre):
    """Each centre's words: their weight, and their vectors' weighted sum."""
    weight = c * (kind & 1)
    own = (x @ centre.T * 2 - (centre**2).sum(1)).argmax(1)
    return np.stack([np.bincount(own, v, len(centre)) for v in (weight, *(x.T * weight))], 1)


def _tokens(x, c, kind, centre):
    """Each centre's tokens of words that are not sent to the tasks."""
    return np.bincount(nearest(x, centre), c * (kind >> 1), len(centre))[:, None]


def centres(types: DataFrame, cut: DataFrame, vectors, path: str, k: int) -> np.ndarray:
    """Weighted k-means of all words that are neither alone nor single, by their vectors."""
    # The first centres: k words drawn by their counts, the same in every run.
    u = (F.pmod(F.xxhash64("word", F.lit(9)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    first = types.where("c > 1 AND NOT alone AND NOT single").select("word", (-F.log(u) / F.col("c")).alias("at")).orderBy("at", "word").limit(k).collect()
    centre = means(vectors.value, *subwords(path)([r["word"] for r in first])) if first else np.zeros((1, DIM), np.float32)
    for _ in range(ROUNDS if len(first) == k else 0):
        moved = of_types(cut, vectors, centre, _moved)
        full = moved[:, 0] > 0
        centre[full] = moved[full, 1:] / moved[full, :1]
    return centre


def coded_texts(train: DataFrame, shared) -> DataFrame:
    """The training texts as word numbers, and their subwords' neighbours, stored. A row holds either

    key, number, sizes, ids, lens, alone, h: a block of texts: its words' numbers and the texts' sizes; numbers from -1 down
    are words that were not sent to the tasks, with their subwords, the number of these, class (-1: not alone) and hash; or
    block, who, near: a task's counts of the neighbours of one range of subwords."""
    small_batches(train.sparkSession, 250)

    def run(batches):
        path, hashes, order, sent, sent_lens, column, alone = shared.value
        cut = subwords(path)
        none = cut.size
        near, met = np.zeros((none + 1) * NEIGHBOURS, np.int32), 0
        for i, batch in enumerate(batches):
            w, h = (batch.column(batch.schema.get_field_index(c)) for c in ("w", "h"))
            flat, sizes = np.asarray(h.flatten()), np.diff(np.asarray(h.offsets)).astype(np.int64)
            number, rest_at = looked_up(hashes, order, flat)
            coded = w.flatten().take(pa.array(rest_at)).dictionary_encode()
            where = coded.indices.to_numpy()
            number[rest_at] = -1 - where
            own = np.zeros(len(coded.dictionary), np.int64)
            own[where] = flat[rest_at]
            names = coded.dictionary.to_pylist()
            ids, starts = cut(names)
            lens = np.diff(np.r_[starts, len(ids)])
            fixed = np.array([alone.get(w, -1) for w in names], np.int64)
            # The words' subwords in a row, none before and after each text.
            every, sub = np.concatenate([sent_lens, lens, [GAP]]), np.concatenate([sent, ids, np.full(GAP, none)])
            at = np.full(len(flat) + len(sizes) + 1, len(every) - 1)
            at[np.arange(len(flat)) + np.repeat(np.arange(len(sizes)), sizes) + 1] = np.where(
                number < 0, len(sent_lens) - 1 - number, number)
            size = every[at]
            begin = np.cumsum(every) - every
            text = sub[np.repeat(begin[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            add_neighbours(near, text, column)
            met += len(text)
            if met > 1 << 27:  # before 32 bits overflow
                yield from _near_rows(near.reshape(-1, NEIGHBOURS)[:none])
                near[:], met = 0, 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([(TaskContext.get().partitionId() << 33) + i], pa.int64()),
                 *(pa.array([planes(v)], pa.binary()) for v in (number, sizes, ids, lens, fixed)),
                 pa.array([own], pa.list_(pa.int64())), pa.nulls(1, pa.int32()), *(pa.nulls(1, pa.binary()) for _ in range(2))],
                CODED)
        yield from _near_rows(near.reshape(-1, NEIGHBOURS)[:none])

    word = words(lower_ascii(F.col("text")))
    return stored(train.select(word.alias("w")).select("w", F.transform("w", lambda x: F.xxhash64(x)).alias("h")).mapInArrow(
        run, "key long, number binary, sizes binary, ids binary, lens binary, alone binary, h array<long>, block int, who binary, near binary"),
        "score_texts")


CODED = ["key", "number", "sizes", "ids", "lens", "alone", "h", "block", "who", "near"]


def _near_rows(near: np.ndarray):
    """Rows of ``coded_texts``: the subwords of each range that have neighbours."""
    some = np.flatnonzero(near.any(1))
    block = some // -(-len(near) // BLOCKS)
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    ranges = np.split(some, cuts[1:])
    for i in range(0, len(cuts), 128):
        part = ranges[i: i + 128]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(part), pa.int64()), *(pa.nulls(len(part), pa.binary()) for _ in range(5)),
             pa.nulls(len(part), pa.list_(pa.int64())), pa.array(block[cuts[i: i + 128]].astype(np.int32)),
             pa.array([who.astype(np.int32).tobytes() for who in part], pa.binary()),
             pa.array([near[who].tobytes() for who in part], pa.binary())], CODED)


def _near_sum(parts: pa.Table) -> pa.Table:
    """One range's neighbours: the sum of its tasks' counts."""
    who = [np.frombuffer(v.as_py(), np.int32) for v in parts["who"]]
    every = np.unique(np.concatenate(who))
    total = np.zeros((len(every), NEIGHBOURS), np.int64)
    for w, near in zip(who, parts["near"], strict=True):
        total[np.searchsorted(every, w)] += np.frombuffer(near.as_py(), np.int32).reshape(-1, NEIGHBOURS)
    return pa.table({"who": pa.array([every.tobytes()], pa.binary()), "near": pa.array([total.tobytes()], pa.binary())})


def neighbours(coded: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Subwords and the counts of their neighbours in all training texts; bounded by the tokenizer's subwords."""
    rows = coded.where("block IS NOT NULL").select("block", "who", "near").groupBy("block").applyInArrow(
        lambda parts: _near_sum(parts), "who binary, near binary").collect()
    found = [(np.frombuffer(r["who"], np.int32), np.frombuffer(r["near"], np.int64).reshape(-1, NEIGHBOURS)) for r in rows]
    return sorted(found, key=lambda f: f[0][0])


def trained(coded: DataFrame, single: DataFrame, scorer: Scorer) -> int:
    """Trains the attention on all texts of ``coded_texts`` and returns the number of their windows; single: hashes of words,
    not sent to the tasks, of the class of words seen once."""
    blocks = coded.where("key IS NOT NULL")
    n = blocks.count()
    if not n:
        return 0
    spark = coded.sparkSession
    shared = spark.sparkContext.broadcast(scorer)
    shard = F.pmod(F.xxhash64("key"), F.lit(max(1, round(n / SHARD)))).alias("shard")
    once = blocks.select(shard, "key", F.posexplode("h").alias("j", "h")).join(single, "h", "left_semi").select(
        F.col("shard").alias("of"), F.col("key").alias("at"), "j")
    own = blocks.select(shard, "key", "number", "sizes", "ids", "lens", "alone").groupBy("shard").cogroup(once.groupBy("of")).applyInArrow(
        _shard(shared), "n long, w array<double>")
    whole = own.select("n", F.posexplode("w").alias("i", "w")).groupBy("i").agg(
        (F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w"), F.sum("n").alias("n")).collect()
    scorer.net.take(np.array([r["w"] for r in sorted(whole, key=lambda r: r["i"])]))
    shared.destroy()
    return whole[0]["n"]


def _shard(shared):
    def run(blocks: pa.Table, once: pa.Table) -> pa.Table:
        keep_freed()
        scorer = shared.value
        net = copy.deepcopy(scorer.net)
        blocks = blocks.sort_by("key")
        keys, js = np.asarray(once["at"]), np.asarray(once["j"])
        order = np.argsort(keys, kind="stable")
        keys, js = keys[order], js[order]
        sizes = [unplanes(v.as_py()).astype(np.int64) for v in blocks["sizes"]]
        count = [len(windows(s + 1)[0]) for s in sizes]

        def batches():
            for b, key in enumerate(blocks["key"].to_pylist()):
                number, ids, lens, alone = (unplanes(blocks[c][b].as_py()) for c in ("number", "ids", "lens", "alone"))
                own = means(scorer.vectors, ids, np.cumsum(np.r_[0, lens])[:-1])
                klass = np.where(alone < 0, ALONE + nearest(own, scorer.centre), alone)
                klass[js[np.searchsorted(keys, key): np.searchsorted(keys, key, "right")]] = RARE
                x = np.concatenate([scorer.x, own])
                place = np.where(number < 0, len(scorer.x) - 1 - number, number)
                xs, ks, at, valid, scored = scorer.examples(x[place], np.concatenate([scorer.target, klass])[place], sizes[b])
                turn = np.random.default_rng(b).permutation(len(at))
                for i in range(0, len(turn), BATCH):
                    rows = turn[i: i + BATCH]
                    yield xs[at[rows]] * valid[rows, :, None], ks[at[rows]], scored[rows].astype(np.float32)

        net.fit(batches(), sum(-(-c // BATCH) for c in count))
        return pa.table({"n": pa.array([sum(count)], pa.int64()), "w": pa.array([net.weights()], pa.list_(pa.float64()))})
    return run


def learn(train: DataFrame, counts: DataFrame, common, least: int, once: int, sample: int, path: str) -> Scorer:
    """The model of all training texts."""
    spark, cut = train.sparkSession, subwords(path)
    first = counts.where("c > 1").orderBy(F.desc("c"), "word").limit(ALONE).collect()
    alone = {r["word"]: i for i, r in enumerate(first)}
    is_alone = F.col("word").isin(list(alone)) if alone else F.lit(False)
    # Without a word seen once, a hash fold of the words stands for them, so that their class is trained.
    single = F.col("c") == 1 if once else (F.crc32(F.col("word").cast("binary")) % 32 == 0) & ~is_alone
    types = counts.withColumn("alone", is_alone).withColumn("single", single)
    subs = cut_types(types, least, path)
    use = subs.where("subword IS NOT NULL")
    ends = use.agg(F.sum("ends")).first()[0] or 0
    tokens, spelled = np.zeros(cut.size), np.zeros(cut.size)
    for r in use.select(F.explode(F.arrays_zip("subword", "tokens", "spelled")).alias("r")).groupBy("r.subword").agg(
            F.sum("r.tokens").alias("t"), F.sum("r.spelled").alias("s")).toLocalIterator():
        tokens[r["subword"]], spelled[r["subword"]] = r["t"], r["s"]
    column = np.full(cut.size + 1, -1)
    commonest = np.argsort(-tokens, kind="stable")[:NEIGHBOURS]
    column[commonest] = np.arange(len(commonest))

    names, count = common["word"].tolist(), common["c"].to_numpy(np.float64)
    ids, starts = cut(names)
    sent = spark.sparkContext.broadcast((
        path, *by_hash(common), ids.astype(np.int32), np.diff(np.r_[starts, len(ids)]).astype(np.int32), column, alone))
    coded = coded_texts(train, sent)
    sent.destroy()
    vectors = subword_vectors(neighbours(coded), cut.size, DIM)
    held = spark.sparkContext.broadcast(vectors)
    scorer = Scorer(vectors, list(alone), centres(types, subs, held, path, CLASSES - 2 - ALONE), spelled, ends, path)
    others = np.zeros(CLASSES)
    others[ALONE: ALONE + len(scorer.centre)] += of_types(subs, held, scorer.centre, _tokens).ravel()
    others[:len(first)] += [r["c"] * (r["c"] < least) for r in first]
    held.destroy()
    once_names = count == 1 if once else np.array([w not in alone and zlib.crc32(w.encode()) % 32 == 0 for w in names], bool)
    scorer.hold(names, count, others, once, once_names, cut)

    some = stored(sample_of_texts(train.where(F.octet_length("text").between(1, 24000)), sample).select(
        "h", words(lower_ascii(F.col("text"))).alias("w")), "score_sample")
    asked = F.broadcast(some.select(F.explode("w").alias("word")).distinct())  # bounded by ``sample``
    rare = {r["word"] for r in types.where("single").select("word").join(asked, "word", "left_semi").collect()}
    scorer.begin([r["w"] for r in some.orderBy("h").collect()], rare, cut)
    trained(coded, types.where("single").where(F.col("c") < least).select("h"), scorer)
    return scorer


def score(docs: DataFrame, train: DataFrame, top: int = 1 << 18, sample: int = 500, path: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, spelled_score of each text, learned from ``train``.

    sample: whole training texts (at most 24,000 bytes long, by hash of the text) that the attention's first weights come
    from; it is then trained on all texts."""
    spark = docs.sparkSession
    counts, common, least, tokens, types, once = vocabulary(train, top)
    rest = counts.where(F.col("c") < least).select("h", "c")
    ends = train.count()
    total, kinds = tokens + ends, types + (ends > 0)
    spare = total + 0.5 * (kinds + 1)
    scorer = learn(train, counts, common, least, once, sample, path)
    shared = spark.sparkContext.broadcast((scorer, *by_hash(common)))
    base_end = float(np.log10((ends + 0.5) / spare))
    docs = keyed(docs)
    small_batches(spark, 250)
    own = stored(docs.select("doc_id", "_th", words(lower_ascii(F.col("text"))).alias("w")).select(
        "doc_id", "_th", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h")).mapInArrow(
        _pass(shared, spare), f"doc_id {dict(docs.dtypes)['doc_id']}, _th long, n long, known long, base double, "
        "score double, rest array<struct<h: long, p: float, r: float, s: float>>"), "score_own")
    # The tokens of the class of words seen once: theirs, and as many for unseen words, each priced like one of them. The
    # spelled score shares the unseen words' half by their spelling instead.
    single = -float(np.log10(max(2, 2 * once)))
    half = float(np.log10(0.5)) if once else 0.0
    each = own.select("doc_id", "_th", F.explode("rest").alias("r")).select("doc_id", "_th", "r.*")
    seen = each.join(rest, "h", "left").groupBy(F.col("doc_id").alias("_d"), F.col("_th").alias("_t")).agg(
        F.count("c").alias("k"), F.count(F.lit(1)).alias("m"),
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + 0.5) / spare)).alias("b"),
        F.sum(F.when(F.coalesce("c", F.lit(1)) == 1, F.col("r") + F.lit(single))
              .otherwise(F.col("p") + F.log10("c"))).alias("v"),
        F.sum(F.when(F.col("c").isNull(), F.col("s") + F.lit(half - single)).otherwise(0.0)).alias("p"))
    once_each = own.drop("rest")
    joined = once_each.join(seen, F.expr("doc_id <=> _d AND _th = _t"), "left")
    # Rows that repeat id and text share one group: divide by their number.
    twins = own.groupBy("doc_id", "_th").count().where("count > 1")
    if not twins.isEmpty():
        again = twins.select(F.col("doc_id").alias("_e"), F.col("_th").alias("_u"), F.col("count").alias("q"))
        joined = joined.join(again, F.expr("doc_id <=> _e AND _th = _u"), "left")
    else:
        joined = joined.withColumn("q", F.lit(1))
    part = lambda c: F.coalesce(F.col(c) / F.coalesce("q", F.lit(1)), F.lit(0.0))
    return joined.select(
        "doc_id", (F.col("n") + 1).alias("n_tokens"), (F.col("known") + part("k") + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + part("b") + base_end).alias("base_score"),
        (F.col("score") + part("v")).alias("score"),
        (F.col("score") + part("v") + part("p")).alias("spelled_score"))


def _pass(shared, spare: float):
    def run(batches):
        scorer, hashes, order = shared.value
        cut = subwords(scorer.path)
        base = np.log10((scorer.count + 0.5) / spare)
        for batch in batches:
            yield _scored(scorer, cut, hashes, order, base, batch)
    return run


def _scored(scorer: Scorer, cut: Subwords, hashes, order, base, batch) -> pa.RecordBatch:
    col = lambda name: batch.column(batch.schema.get_field_index(name))
    flat = np.asarray(col("h").flatten())
    sizes = np.diff(np.asarray(col("h").offsets)).astype(np.int64)
    number, rest_at = looked_up(hashes, order, flat)
    found = number >= 0
    x, klass, spelled = scorer.inputs(number, col("w").flatten().take(pa.array(rest_at)), cut)
    doc = np.repeat(np.arange(len(sizes)), sizes)

    # Inputs are the tokens before: a start, then all words; targets are all words, then the end.
    full = sizes + 1
    begin = np.r_[0, np.cumsum(full)[:-1]]
    inside = np.arange(len(flat)) + doc
    ins = np.empty((full.sum(), DIM), np.float32)
    ins[begin] = scorer.start
    ins[inside + 1] = x
    target = np.full(full.sum(), END, np.int64)
    own = scorer.klass[np.maximum(number, 0)].astype(np.int64) if len(scorer.klass) else np.zeros(len(flat), np.int64)
    own[rest_at] = klass
    target[inside] = own
    value, rare = np.zeros(full.sum()), np.zeros(full.sum())
    at, valid, scored = windows(full)
    for i in range(0, len(at), 256):
        rows, use = at[i: i + 256], scored[i: i + 256]
        h, _ = scorer.net.forward(ins[rows] * valid[i: i + 256, :, None])
        where = rows[use]
        value[where], rare[where] = scorer.net.log_at(h[use], target[where])
    value /= np.log(10)
    # What the join with the counts chooses from: the word's class, or that of words seen once.
    at = inside[rest_at]
    known_part, rare_part = value[at] - scorer.weight[klass], rare[at] / np.log(10)
    value[at] = 0
    total = np.add.reduceat(value, begin) if len(begin) else np.zeros(0)
    per_doc = lambda v, d: np.bincount(d, v, len(sizes)).astype(np.float64)
    top = number[found]
    total = total + per_doc(scorer.share[top] if len(top) else np.zeros(0), doc[found])
    rest_sizes = np.bincount(doc[rest_at], minlength=len(sizes))
    rest = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(rest_sizes)].astype(np.int32)), pa.StructArray.from_arrays(
            [pa.array(flat[rest_at]), *(pa.array(v, pa.float32()) for v in (known_part, rare_part, spelled))],
            ["h", "p", "r", "s"]))
    return pa.RecordBatch.from_arrays(
        [col("doc_id"), col("_th"), pa.array(sizes), pa.array(np.bincount(doc[found], minlength=len(sizes))),
         pa.array(per_doc(base[top] if len(top) else np.zeros(0), doc[found])), pa.array(total), rest],
        ["doc_id", "_th", "n", "known", "base", "score", "rest"])


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = docs.where(id_fold(F.col("doc_id"), 5) != 1)
    return score(docs, train).withColumn("held_out", id_fold(F.col("doc_id"), 5) == 1)
