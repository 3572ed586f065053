"""Personal data: fixed patterns, and spans added by a character-level BiLSTM-CRF.

Base spans come from the patterns (email, ip, card, phone). The model is trained on pieces of text round digits and at
signs (a bounded choice by hash, half of them with base spans): the pieces themselves, pieces whose span is written in
another form (national numbers, other separators, spelled-out addresses; ``forms``), and pieces whose span gives way to
something alike that is none (dates, versions, order numbers, handles; ``near_misses``). It then runs over
every text: windows of 64 characters every 32, decoded with the CRF. Every span holds a digit, an at sign or an "at"
that is bracketed or followed by "dot", so windows without any of these hold none and are skipped. The windows' spans are
reconciled over the whole text: each window answers for its middle half, touching spans of a kind join, edges grow to
whole words and numbers, the longest runs of words that pass the kind's test (digits, check sum, range, shape of an
address) are taken from left to right, and what overlaps a base span or an earlier span goes.

Offsets count code points. Results for odd input: null or empty text has no spans; without training pieces only base
spans are given; very long runs of digits or name characters are scanned in linear time; repeated rows each get theirs.
"""

from __future__ import annotations

import hashlib
import heapq
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.bilstm_crf import Model, classes_of
from cirrus.llm.common import from_texts, small_batches, stored, table

#: Fixed order of the kinds.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
# A match starts at the first digit of a run and takes whole runs, so one attempt a run is enough.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]|[\[({<] ?[Aa][Tt] ?[\])}>]|\b[Aa][Tt] [A-Za-z0-9-]+ [Dd][Oo][Tt] ")
AT = re.compile(r"\s*[\[({<] ?at ?[\])}>]\s*|\s+at\s+|\s*@\s*", re.IGNORECASE)
DOT = re.compile(r"\s*[\[({<] ?(?:dot|\.) ?[\])}>]\s*|\s+dot\s+", re.IGNORECASE)
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
WIDTH, STRIDE = 64, 32


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def emails(text: str):
    """Leftmost matches: the run of name characters before an at sign, back to the previous match's end."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    found = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not ANCHOR.search(text):
        return found
    found += [(1, *m.span()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
    for m in CARD.finditer(text):
        d = digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return found


def plausible(kind: int, s: str) -> bool:
    """The test of the kind, which a span that only the model found must pass however it is written."""
    d = digits(s)
    if kind == 0:
        return bool(ADDRESS.fullmatch(DOT.sub(".", AT.sub("@", s))))
    if re.search(r"[^0-9 ().\[\]{}/_\-]", DOT.sub(".", s)):
        return False
    if kind == 1:
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(map(small, parts))
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d) and len(set(d)) > 1
    # A date has eight digits: a number without a country's prefix needs nine.
    return (8 if s.startswith("00") else 9) <= len(d) <= 15 and len(set(d)) > 2


def starts_of(text: str) -> list[int]:
    """Starts of the windows with an anchor character, on a grid of STRIDE over the whole text."""
    found = set()
    for m in ANCHOR.finditer(text):
        j = m.start() // STRIDE
        found.add(j * STRIDE)
        found.add((j - 1) * STRIDE)
    return sorted(found)  # may begin before the text: the first characters then sit in a window's middle


def window(codes: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(WIDTH, np.int16)
    a, b = max(0, start), min(len(codes), start + WIDTH)
    out[a - start: b - start] = codes[a:b]
    return out


def tags_of(spans: list[tuple[int, int, int]], start: int) -> np.ndarray:
    out = np.zeros(WIDTH, np.int8)
    for kind, a, b in spans:
        a, b = a - start, b - start
        if b <= 0 or a >= WIDTH:
            continue
        out[max(0, a): min(WIDTH, b)] = 2 + 2 * kind
        out[max(0, a)] = 1 + 2 * kind
    return out


def _number(rng: random.Random, n: int, first: str = "123456789") -> str:
    return rng.choice(first) + "".join(rng.choices("0123456789", k=n - 1))


def _grouped(rng: random.Random, d: str, sizes, between: str) -> str:
    """The digits in groups of the given sizes, each parted from the next by one of the characters of ``between``."""
    out, at = d[: sizes[0]], sizes[0]
    for n in sizes[1:]:
        out, at = out + rng.choice(between) + d[at: at + n], at + n
    return out


def forms(kind: int, s: str, rng: random.Random) -> list[str]:
    """Other ways to write a span of this kind, with other digits: what the patterns do not know."""
    if kind == 0:
        name, _, host = s.partition("@")
        name = rng.choice([name, re.sub("[0-9]+", "", name).strip(".") or name, name + _number(rng, 2)])
        at = rng.choice([" [at] ", "[at]", " (at) ", "(at)", " at ", " @ ", " {at} "])
        dot = rng.choice([".", " [dot] ", "[dot]", " (dot) ", " dot "]) if at != " at " else " dot "
        return [name + at + host.replace(".", dot), f"{name}{at}{rng.choice(['mail', 'post', 'corp', 'web-shop'])}{dot}"
                f"{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es'])}"]
    if kind == 1:
        parts = [str(rng.randint(0, 255)) for _ in range(4)]
        return [between.join(parts) for between in ("[.]", " . ", " dot ", "(.)")] + ["[.]".join([".".join(parts[:3]), parts[3]])]
    if kind == 2:
        d = _number(rng, 15)
        d += next(c for c in "0123456789" if luhn(d + c))
        return [_grouped(rng, d, (4, 4, 4, 4), c) for c in "./_"] + [_grouped(rng, d, (4, 4, 4, 4), "./_")]
    # How national and international numbers are grouped.
    return [_grouped(rng, _number(rng, 10, "23456789"), (3, 3, 4), rng.choice((" ", "-", ".", "/", " -./"))),
            f"({_number(rng, 3)}) {_grouped(rng, _number(rng, 7), (3, 4), ' -.')}",
            _grouped(rng, "1" + _number(rng, 10), (1, 3, 3, 4), rng.choice((" ", "-", "."))),
            "00" + _grouped(rng, _number(rng, 11), (2, *rng.choice(((2, 7), (3, 6), (3, 3, 3)))), " -"),
            _grouped(rng, "0" + _number(rng, rng.randint(8, 10)), (rng.randint(3, 5), 9), " /-"),
            "0" + _grouped(rng, _number(rng, 9), (1, 2, 2, 2, 2), rng.choice((" ", ".", "-"))),
            "00" + s[1:] if s.startswith("+") else s]


def near_misses(rng: random.Random) -> list[str]:
    """Written like personal data, but none. (Check sums and ranges are not for the model: the kind's test knows them.)"""
    year, month, day = rng.randint(1900, 2040), rng.randint(1, 12), rng.randint(1, 28)
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstu", k=rng.randint(3, 8)))
    return [f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{day}/{month}/{year}",
            f"{year}-{month:02}-{day:02} {rng.randint(0, 23):02}:{rng.randint(0, 59):02}:{rng.randint(0, 59):02}",
            f"{year}-{year + rng.randint(1, 9)}", f"{rng.randint(0, 23):02}:{rng.randint(0, 59):02}",
            f"{rng.randint(0, 40)}.{rng.randint(0, 40)}.{rng.randint(0, 40)}", f"v{rng.randint(1, 9)}.{rng.randint(0, 20)}",
            _number(rng, rng.randint(1, 14)), _number(rng, rng.randint(4, 9)) + "." + _number(rng, 2),
            _grouped(rng, _number(rng, 9), (3, 3, 3), ","), _grouped(rng, _number(rng, 9), (3, 3, 3), " "),
            _grouped(rng, "978" + _number(rng, 10), (3, 1, 2, 6, 1), "-"), f"No. {_grouped(rng, _number(rng, 9), (2, 5, 2), '-')}",
            f"{word()} [at] {word()}", f"@{word()}{rng.randint(1, 99)}", f"{word()} @ {rng.randint(1, 99)}", f"{word()}@{word()}",
            f"{word()} at {word()} {word()}", f"{word()}={_number(rng, 6)}{word()}{_number(rng, 4)}",
            "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=16))]


def pieces_of(text: str) -> list[str]:
    """The text round its anchors: 64 characters to both sides, neighbours together up to 256 characters."""
    out, lo, hi = [], None, 0
    for m in ANCHOR.finditer(text):
        if lo is not None and m.end() - lo <= 4 * WIDTH - WIDTH and m.start() <= hi:
            hi = m.end() + WIDTH
            continue
        if lo is not None:
            out.append(text[lo: hi])
        lo, hi = max(0, m.start() - WIDTH), m.end() + WIDTH
    return [*out, text[lo: hi]] if lo is not None else out


def _digest(piece: str) -> int:
    return int.from_bytes(hashlib.blake2b(piece.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _pieces(n: int):
    """Of each task's pieces the ``n`` with the smallest hashes, with base spans and without; each piece once."""
    def run(batches):
        best: list[dict[int, str]] = [{}, {}]
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for piece in pieces_of(text):
                    best[bool(base_spans(piece))][_digest(piece)] = piece
            for i, found in enumerate(best):
                if len(found) > 4 * n:
                    best[i] = {k: found[k] for k in heapq.nsmallest(n, found)}
        rows = [(bool(i), k, found[k]) for i, found in enumerate(best) for k in heapq.nsmallest(n, found)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.string())], ["marked", "k", "piece"])
    return run


def training_windows(pieces: list[str], windows: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """At most ``windows`` windows and their tags: half of them of pieces with a span in another form, a quarter with
    something alike in a span's place, the rest of pieces as they are (more of these where no piece has a span)."""
    rng = random.Random(seed)
    spans = {p: base_spans(p) for p in pieces}
    marked = [p for p in pieces if spans[p]]
    found: list[dict[tuple[bytes, bytes], None]] = [{}, {}, {}]

    def add(into, text, marks):
        codes = classes_of(text)
        for s in starts_of(text):
            into.setdefault((window(codes, s).tobytes(), tags_of(marks, s).tobytes()))

    for p in pieces:
        if len(found[0]) < windows:
            add(found[0], p, spans[p])
    for sort in (1, 2):
        tries = 0
        while marked and len(found[sort]) < windows // (2 * sort) and tries < windows:
            p = marked[tries % len(marked)]
            kind, a, b = rng.choice(spans[p])
            tries += 1
            new = rng.choice(forms(kind, p[a:b], rng) if sort == 1 else near_misses(rng))
            lo = max(0, a - rng.randint(0, WIDTH))
            text = p[lo:a] + new + p[b: b + WIDTH]
            own = (kind, a - lo, a - lo + len(new))
            marks = base_spans(text)
            if sort == 1:
                marks = [own, *(m for m in marks if m[2] <= own[1] or m[1] >= own[2])]
            add(found[sort], text, marks)
    chosen = [*found[1], *found[2]][:windows]
    chosen += list(found[0])[: max(windows // 4, windows - len(chosen))]
    rng.shuffle(chosen)
    chosen = chosen[:windows]
    return (np.stack([np.frombuffer(x, np.int16) for x, _ in chosen]),
            np.stack([np.frombuffer(y, np.int8) for _, y in chosen]).astype(np.int64))


def learn(docs: DataFrame, sample: int = 3000, windows: int = 12000, steps: int = 800) -> Model | None:
    """Trains on at most ``windows`` windows of at most ``sample`` pieces of texts of any length (at most 256 characters
    each, and what a match adds), half of them with base spans where there are as many."""
    small_batches(docs.sparkSession)
    some = docs.where(F.col("text").rlike(ANCHOR.pattern)).select("text")
    found = stored(some.mapInArrow(_pieces(sample), "marked boolean, k long, piece string"), "pieces")
    half = [found.where(F.col("marked") == m).distinct().orderBy("k", "piece").limit(sample // 2).collect() for m in (True, False)]
    pieces = [r["piece"] for rows in half for r in rows]
    if not pieces:
        return None
    x, y = training_windows(pieces, windows)
    model = Model(len(KINDS), hidden=24)
    model.train(x, y, steps)
    return model


def model_spans(texts: list[str], model: Model, chunk: int = 2048) -> list[list[tuple[int, int, int]]]:
    """Reconciled spans of the model for each text."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    codes: list = []
    where: list[tuple[int, int]] = []

    def flush():
        for (i, s), path in zip(where, model.decode(np.stack(codes)), strict=True):
            t = 0
            while t < WIDTH:
                if path[t] == 0:
                    t += 1
                    continue
                kind, a = (int(path[t]) - 1) // 2, t
                t += 1
                while t < WIDTH and path[t] == 2 + 2 * kind:
                    t += 1
                # The span belongs to a window if a part of it lies in the window's middle half.
                if t > WIDTH // 4 and a < 3 * WIDTH // 4:
                    found[i].append((kind, max(0, s + a), min(len(texts[i]), s + t)))
        codes.clear()
        where.clear()

    for i, text in enumerate(texts):
        starts = starts_of(text)
        if starts:
            all_ = classes_of(text)
            for s in starts:
                codes.append(window(all_, s))
                where.append((i, s))
                if len(codes) >= chunk:
                    flush()
    if codes:
        flush()
    return [_joined(spans) for spans in found]


def _joined(spans):
    out: list[tuple[int, int, int]] = []
    for kind, a, b in sorted(spans):
        if out and out[-1][0] == kind and a <= out[-1][2]:
            out[-1] = (kind, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((kind, a, b))
    return out


def whole(text: str, kind: int, a: int, b: int) -> tuple[int, int]:
    """The span without white space and points at its edges, grown by at most a window to whole words (email) or numbers."""
    while a < b and (text[a].isspace() or text[a] in ".,;:-/_"):
        a += 1
    while b > a and (text[b - 1].isspace() or text[b - 1] in ".,;:-/_"):
        b -= 1
    if a >= b:
        return a, b
    inside = LOCAL.__contains__ if kind == 0 else "0123456789".__contains__
    lo, hi = max(0, a - WIDTH), min(len(text), b + WIDTH)
    while a > lo and inside(text[a]) and inside(text[a - 1]):
        a -= 1
    while b < hi and inside(text[b - 1]) and inside(text[b]):
        b += 1
    if kind == 0:
        while b > a and text[b - 1] in ".-":
            b -= 1
    elif a and text[a - 1] == "(" and ")" in text[a:b] and "(" not in text[a:b]:
        a -= 1
    return a, b


def kind_of(kind: int, s: str) -> int | None:
    """The kind whose test the span passes: the model's, or for digits that it took for another kind card, then phone."""
    if plausible(kind, s):
        return kind
    if kind and plausible(2, s):
        return 2
    return 3 if kind in (1, 2) and len(digits(s)) <= 12 and s.count(".") < 3 and plausible(3, s) else None


def settled(text: str, kind: int, a: int, b: int):
    """The spans in a tagged stretch: from left to right, each the longest run of words that passes its kind's test.

    Windows may run over a span's edge, so a stretch can hold words too many or more than one span."""
    words = [(a + m.start(), a + m.end()) for m in re.finditer(r"\S+", text[a:b])]
    i = 0
    while i < len(words):
        for j in range(min(len(words), i + WIDTH // 4) - 1, i - 1, -1):
            x, y = whole(text, kind, words[i][0], words[j][1])
            found = kind_of(kind, text[x:y]) if 0 < y - x <= 2 * WIDTH else None
            if found is not None:
                yield found, x, y
                i = j
                break
        i += 1


def all_spans(texts: list[str], model: Model | None):
    """For each text its base spans, and base and added spans together, by kind, then start."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return base, base
    every = []
    for text, own, extra in zip(texts, base, model_spans(texts, model), strict=True):
        kept, taken = list(own), sorted((a, b) for _, a, b in own)
        for kind, a, b in extra:
            for span in settled(text, kind, *whole(text, kind, a, b)):
                if not any(x < span[2] and span[1] < y for x, y in taken):
                    kept.append(span)
                    taken.append(span[1:])
        every.append(sorted(kept))
    return base, every


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """The named columns of ``docs``, n_email .. n_phone (base spans), base, spans (as text) and n_added."""
    def work():
        def columns(texts):
            base, every = all_spans([t or "" for t in texts], model)
            return (*([sum(s[0] == i for s in b) for b in base] for i in range(len(KINDS))), [*map(joined, base)],
                    [*map(joined, every)], [len(e) - len(b) for b, e in zip(base, every, strict=True)])
        return columns

    made = ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string, n_added long"
    return from_texts(docs, work, made, *keep)


def redact(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, e.g. ``[EMAIL]``; all other columns stay."""
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            _, every = all_spans([t or "" for t in texts], model)
            clean = [_masked(t, spans) if t else t for t, spans in zip(texts, every, strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.column(at).type))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def _masked(text: str, spans) -> str:
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        out += [text[at:a], f"[{KINDS[kind].upper()}]"] if a >= at else []
        at = b
    return "".join([*out, text[at:]])


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, learn(docs), "doc_id").select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")
