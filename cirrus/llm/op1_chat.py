"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as ``<|turn|>role<|says|>text<|end|>`` for each turn. A control string inside a role or text
(the template's own and those of common chat formats) is broken by a backslash after its first character, wherever it
starts, and backslashes are doubled; so the rendering is reversible and only the template makes control tokens.
The rendering is encoded once with offsets, the template's marks as single tokens; token spans and the sorted spans of
the assistants' texts are intersected by binary search. That gives the token mask, and the masked text is read back
from the token offsets.

A conversation's rows are brought together in order by one shuffle and streamed: a task holds a block of turns of at
most ``BLOCK`` characters, or one turn if that is longer, never a whole long conversation. Marks are tokens of their
own, so blocks cut before a mark encode as the whole rendering does.

Results for odd input: null roles and texts are empty; rows without conv_id form one conversation; turns that tie are
ordered by role, then text; repeated rows are turns; a conversation without assistant has an empty mask; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import small_batches, table

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: Control strings that no rendered text may hold.
CONTROLS = (TURN, SAYS, END, "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>",
            "<</SYS>>")
STARTS = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.S)
MARKS = re.compile("|".join(map(re.escape, (TURN, SAYS, END))))
BLOCK = 1 << 20
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def escape(text: str) -> str:
    return STARTS.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"{TURN}{escape(role)}{SAYS}{escape(text)}{END}" for role, text in turns)


def parse(rendered: str) -> list[tuple[str, int, int]]:
    """(role, start, end of the escaped text) of each turn, by the template's marks alone."""
    marks = [(m[0], m.start(), m.end()) for m in MARKS.finditer(rendered)]
    return [(unescape(rendered[a[2]: b[1]]), b[2], c[1])
            for a, b, c in zip(marks[::3], marks[1::3], marks[2::3], strict=True)]


def load(path: str = TOKENIZER):
    from tokenizers import AddedToken, Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets keep leading spaces
    t.add_special_tokens([AddedToken(m, normalized=False) for m in (TURN, SAYS, END)])
    return t


def mask(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(first token, last token + 1, start, end) of each non-empty span: the tokens that touch it, by binary search.

    Offsets are sorted; characters split over tokens repeat an offset. start and end are what those tokens cover of it."""
    starts, ends = [a for a, _ in offsets], [b for _, b in offsets]
    out = []
    for a, b in spans:
        i, j = bisect_right(ends, a), bisect_left(starts, b)
        if a < b and i < j:
            out.append((i, j, max(a, starts[i]), min(b, ends[j - 1])))
    return out


class Reader:
    """Digests of a conversation, read back from its rendered and encoded blocks."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars, self.tokens, self.loss_tokens = conv_id, 0, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, rendered: str, offsets: list[tuple[int, int]]) -> None:
        turns = parse(rendered)
        for role, a, b in turns:
            self.all.update(f"{role}\n{unescape(rendered[a:b])}\n".encode("utf-8", "surrogatepass"))
        for i, j, a, b in mask(offsets, [(a, b) for role, a, b in turns if role == "assistant"]):
            text = unescape(rendered[a:b])
            self.loss.update(text.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(text)
            self.loss_tokens += j - i
        self.turns += len(turns)
        self.chars += len(rendered)
        self.tokens += len(offsets)

    def row(self):
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.tokens, self.loss_tokens)


SUMMARY = ("conv_id {0}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "n_tokens long, loss_tokens long")


def _blocks(batches):
    """(conv_id, block of turns, is the conversation's last) of rows sorted by conversation and turn."""
    conv, block, size, any_ = None, [], 0, False
    for batch in batches:
        for c, role, text in zip(batch["conv_id"], batch["role"], batch["text"], strict=True):
            role, text = role or "", text or ""
            new = not any_ or c != conv
            if any_ and (new or size + len(text) > BLOCK):
                yield conv, block, new
                block, size = [], 0
            conv, any_ = c, True
            block.append((role, text))
            size += len(role) + len(text)
    if any_:
        yield conv, block, True


def _turns(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    # Ids travel as text: beside a missing one pandas would round whole numbers.
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("string").alias("conv_id"), "role", "text")


def summaries(conversations: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """One row a conversation: digests of its turns and of the masked text, and sizes."""
    def run(batches):
        tokenizer, reader, rows = load(path), None, []
        for conv, block, last in _blocks(batches):
            reader = reader or Reader(conv)
            rendered = render(block)
            reader.take(rendered, tokenizer.encode(rendered).offsets)
            if last:
                rows.append(reader.row())
                reader = None
            if len(rows) >= 1000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)

    kind = dict(conversations.dtypes)["conv_id"]
    names = [c.split(" ")[0] for c in SUMMARY.split(", ")]
    small_batches(conversations.sparkSession)
    return _turns(conversations).mapInPandas(run, SUMMARY.format("string")).withColumn(
        "conv_id", F.col("conv_id").cast(kind))


def formatted(conversations: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """The formatted blocks: conv_id, block, rendered, ids (token ids) and loss (0 or 1 for each token)."""
    def run(batches):
        tokenizer, number = load(path), 0
        for conv, block, last in _blocks(batches):
            rendered = render(block)
            code = tokenizer.encode(rendered)
            loss = [0] * len(code.ids)
            for i, j, *_ in mask(code.offsets, [(a, b) for role, a, b in parse(rendered) if role == "assistant"]):
                loss[i:j] = [1] * (j - i)
            yield pd.DataFrame({"conv_id": [conv], "block": [number], "rendered": [rendered], "ids": [code.ids],
                                "loss": [loss]})
            number = 0 if last else number + 1

    kind = dict(conversations.dtypes)["conv_id"]
    small_batches(conversations.sparkSession)
    return _turns(conversations).mapInPandas(
        run, "conv_id string, block int, rendered string, ids array<int>, loss array<tinyint>").withColumn(
        "conv_id", F.col("conv_id").cast(kind))


def query(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema)
    return summaries(rows.unionByName(extra)).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _escaped_length(column: str) -> str:
    """SQL: length of a text once escaped (no control string overlaps itself or another)."""
    added = "".join(f" + (length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in CONTROLS)
    return f"(2 * length({column}) - length(replace({column}, '\\', '')){added})"


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, encode(role), encode(text))) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, encode(role), encode(text)) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum({len(TURN + SAYS + END)} + {_escaped_length('role')} + {_escaped_length('text')})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
