"""Conversation prefix trie by the Euler-tour technique.

Every distinct sequence of a conversation's first d turns is a node, named by a 128-bit digest that is the exclusive or of
its turns' digests, each taken with its place; so prefixes are running sums, also of a conversation of any length. Each
node gives an enter and an exit arc, and each arc its successor: the first child's enter arc or the own exit arc; the next
sibling's enter arc or the parent's exit arc. The tour is ranked as a linked list: chains inside blocks of neighbouring
arcs are contracted by pointer doubling, what is left is contracted again, with random mates spliced out where blocks do
not shorten the list, until one element is left; then the positions are handed back down. What a subtree holds is the
difference of two prefix sums, at a node's exit and enter arc.

Nodes are numbered by (smallest member, depth). A conversation owns a path of nodes, so neighbouring numbers are mostly
neighbours in the tour and blocks contract well. No conversation, node, parent or sibling list is gathered in one task:
turns and siblings are numbered in range partitions, members are aggregated before the shuffle, and the ids that end at a
node are joined in chunks of ``CHUNK`` and digested as a stream.

Results for odd input: rows without conv_id belong to no conversation and are left out; null roles and texts are empty;
turns are ordered by turn (null first), ties by role, then text; repeated rows are turns; an empty table gives no rows;
other columns play no part, whatever their names. Two texts whose 128-bit digests are equal would be one node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrus.llm.common import numbered, sorted_rows, spans, stored, table, word_count

#: Arcs of a block that is contracted in one task, and positions of a bucket of the prefix sums.
BLOCK = 4096
#: Turns of a conversation, and ids that end at a node, that are handled together.
CHUNK = 1024
LAST = -1


def turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, _part, _pos, a, b, words) of the turns, digests for texts, and their ``spans`` by conversation."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = sorted_rows(rows, "trie_turns", ["conv_id", "turn", "role", "text"], "conv_id",
                       F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(2), "text", "role").alias("b"),
                       word_count(F.col("text")).alias("words"))
    return rows, spans(rows, "conv_id")


def as_they_are(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two tables that ``trie`` takes: turns (conv_id, depth, a, b, words, len) and conversations (conv_id, len)."""
    rows, parts = turns(conversations)
    made = stored(rows.join(parts, ["conv_id", "_part"]).select(
        "conv_id", (F.col("_before") + F.col("_pos") - F.col("_lo") + 1).alias("depth"), "a", "b", "words",
        F.col("_total").alias("len")), "trie_rows")
    return made, parts.groupBy("conv_id").agg(F.max("_total").alias("len"))


def regrouped(conversations: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """The tables of ``trie`` for conversations whose first turns are those of their group's first conversation.

    h = crc32 of the decimal id modulo ``most``; a conversation's first h turns give way to the first h turns (or all, if
    there are fewer) of conversation ``conv_id - conv_id % group``, if there is one."""
    rows, parts = turns(conversations)
    parts = stored(parts, "trie_parts")
    sizes = parts.groupBy("conv_id").agg(F.max("_total").alias("n"))
    lenders = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    plan = stored(
        sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
        .join(lenders, "base", "left").withColumn("borrowed", F.least("h", F.coalesce("base_n", F.lit(0))))
        .select("conv_id", "base", "h", "borrowed", (F.col("borrowed") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("len")),
        "trie_plan")
    # The plan goes to the few rows of ``parts`` first, so that no long conversation's turns meet at its key.
    placed = stored(
        rows.join(parts.join(plan, "conv_id"), ["conv_id", "_part"])
        .withColumn("i", F.col("_before") + F.col("_pos") - F.col("_lo"))
        .select("conv_id", "i", "a", "b", "words", "h", "borrowed", "len"), "trie_placed")
    own = placed.where("i >= h").select("conv_id", (F.col("borrowed") + F.col("i") - F.col("h") + 1).alias("depth"), "a", "b",
                                        "words", "len")
    lent = placed.where((F.col("i") < most - 1) & (F.col("conv_id") % group == 0)).select(
        F.col("conv_id").alias("base"), "i", "a", "b", "words")
    got = plan.where("borrowed > 0").join(lent, "base").where("i < borrowed").select(
        "conv_id", (F.col("i") + 1).alias("depth"), "a", "b", "words", "len")
    return own.unionByName(got), plan.select("conv_id", "len")


def members(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, len, words, ka, kb, pa, pb): the node of every prefix of every conversation, and its parent."""
    at = rows.select("*", F.xxhash64("depth", "a", "b").alias("za"), F.xxhash64("b", "depth", "a").alias("zb"),
                     F.expr(f"(depth - 1) div {CHUNK}").alias("chunk"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # Long conversations: what the chunks before give.
    carried = at.where(F.col("len") > CHUNK).groupBy("conv_id", "chunk").agg(
        F.bit_xor("za").alias("xa"), F.bit_xor("zb").alias("xb")).select(
        "conv_id", "chunk", F.bit_xor("xa").over(before).alias("ca"), F.bit_xor("xb").over(before).alias("cb")).where(
        "chunk > 0")
    nodes = at.withColumn("ka", F.bit_xor("za").over(inside)).withColumn("kb", F.bit_xor("zb").over(inside)).join(
        carried, ["conv_id", "chunk"], "left")
    for k, c in (("ka", "ca"), ("kb", "cb")):
        nodes = nodes.withColumn(k, F.col(k).bitwiseXOR(F.coalesce(c, F.lit(0))))
    nodes = nodes.select("conv_id", "depth", "len", "words", "ka", "kb", F.col("ka").bitwiseXOR(F.col("za")).alias("pa"),
                         F.col("kb").bitwiseXOR(F.col("zb")).alias("pb"))
    zero = F.lit(0).cast("long")
    return nodes.unionByName(convs.select("conv_id", zero.alias("depth"), "len", zero.alias("words"), zero.alias("ka"),
                                          zero.alias("kb"), zero.alias("pa"), zero.alias("pb")))


def tree(found: DataFrame) -> DataFrame:
    """One row a node: id, parent, first (child), next (sibling), n_children and what its members give."""
    nodes = found.groupBy("depth", "ka", "kb").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"))
    nodes = numbered(nodes, "trie_nodes", ["conv_id", "depth"], "*").withColumnRenamed("_rank", "id")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
                           F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # Children of one parent may be most of all nodes: adaptive execution splits them here, as nothing below needs their key.
    linked = nodes.where("depth > 0").select("id", "depth", "pa", "pb").join(parents, ["depth", "pa", "pb"])
    kids = sorted_rows(linked, "trie_children", ["parent", "id"], "parent", "id", "parent_conv_id")
    order = Window.partitionBy("_part").orderBy("_pos")
    following = Window.orderBy("_part")  # one row a partition
    heads = kids.where("_pos = 0").select("_part", F.lead("parent").over(following).alias("then_parent"),
                                          F.lead("id").over(following).alias("then_id"))
    siblings = kids.select("id", "parent", "parent_conv_id", "_part", F.lead("parent").over(order).alias("to_parent"),
                           F.lead("id").over(order).alias("to_id")).join(heads, "_part").select(
        "id", "parent", "parent_conv_id",
        F.when(F.coalesce("to_parent", "then_parent") == F.col("parent"), F.coalesce("to_id", "then_id")).alias("next"))
    first = kids.groupBy(F.col("parent").alias("id")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n_children"))
    return stored(nodes.drop("pa", "pb").join(siblings, "id", "left").join(first, "id", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "trie_tree")


def arcs(nodes: DataFrame) -> DataFrame:
    """(arc, succ, leaves, saved): arc 2 * id enters a node and 2 * id + 1 leaves it; the root's exit has no successor."""
    enter, leave = F.col("id") * 2, F.col("id") * 2 + 1
    two = F.array(
        F.struct(enter.alias("arc"), F.coalesce(F.col("first") * 2, leave).alias("succ"),
                 (F.col("n_children") == 0).cast("long").alias("leaves"),
                 ((F.col("n_convs") - 1) * F.col("words")).alias("saved")),
        F.struct(leave.alias("arc"), F.coalesce(F.col("next") * 2, F.col("parent") * 2 + 1, F.lit(LAST)).alias("succ"),
                 F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")))
    return nodes.select(F.explode(two).alias("x")).select("x.*")


def chains(block: pd.DataFrame) -> pd.DataFrame:
    """Contract the chains inside a block of a linked list (arc, succ, w): each arc's chain head and distance from it; the
    head's row has what follows the chain and the chain's length."""
    block = block.sort_values("arc")
    arc, succ, w = (block[c].to_numpy() for c in ("arc", "succ", "w"))
    n = len(arc)
    at = np.minimum(np.searchsorted(arc, succ), n - 1)
    local = np.flatnonzero(arc[at] == succ)
    head, off = np.arange(n), np.zeros(n, np.int64)
    head[at[local]], off[at[local]] = local, w[local]
    while True:  # pointer doubling: at most log2(n) rounds, as a list has no cycle
        up = head[head]
        if np.array_equal(up, head):
            break
        off, head = off + off[head], up
    is_local = np.zeros(n, bool)
    is_local[local] = True
    ends = np.flatnonzero(~is_local)  # the last arc of each chain
    after, length = np.zeros(n, np.int64), np.zeros(n, np.int64)
    after[head[ends]], length[head[ends]] = succ[ends], off[ends] + w[ends]
    return pd.DataFrame({"arc": arc, "head": arc[head], "off": off, "succ": after, "w": length})


def list_rank(links: DataFrame, block: int = BLOCK) -> DataFrame:
    """(arc, pos): the position of each element of one linked list (arc, succ; ``LAST`` ends it), numbered 0, 1, ..

    Sends two counts a round to the driver."""
    levels = []
    links = links.select("arc", "succ", F.lit(1).cast("long").alias("w"))
    size, dense = links.count(), True
    while size > 1 or not levels:
        if size <= block:
            grouped = links.withColumn("block", F.lit(0))
        elif dense:  # the first list's arcs are 0, 1, ..
            grouped = links.withColumn("block", F.expr(f"arc div {block}"))
        else:
            grouped = numbered(links, "trie_links", ["arc"], "*").withColumn("block", F.expr(f"_rank div {block}"))
        local = stored(grouped.select("block", "arc", "succ", "w").groupBy("block").applyInPandas(
            chains, "arc long, head long, off long, succ long, w long"), "trie_chains")
        levels.append(local.select("arc", "head", "off"))
        links = local.where("arc = head").select("arc", "succ", "w")
        was, size, dense = size, links.count(), False
        if size > block and size > was // 2:
            links, spliced = mates(links, len(levels))
            levels.append(spliced)
            size = links.count()
    found = links.select("arc", F.lit(0).cast("long").alias("pos"))
    for level in reversed(levels):
        up = found.select(F.col("arc").alias("head"), "pos")
        found = stored(level.join(up, "head").select("arc", (F.col("pos") + F.col("off")).alias("pos")), "trie_pos")
    return found


def mates(links: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Splice out every element that tossed 0 behind one that tossed 1, a quarter of them: (links left, level)."""
    toss = lambda c: F.xxhash64(c, F.lit(seed)).bitwiseAND(F.lit(1))
    gone = links.select(F.col("arc").alias("succ"), F.col("succ").alias("then"), F.col("w").alias("more"))
    taken = stored(links.where((F.col("succ") != LAST) & (toss("arc") == 1) & (toss("succ") == 0)).join(gone, "succ"),
                   "trie_mates")
    rest = links.join(taken.select(F.col("succ").alias("arc")), "arc", "left_anti").join(
        taken.select("arc", "then", "more"), "arc", "left").select(
        "arc", F.coalesce("then", "succ").alias("succ"), (F.col("w") + F.coalesce("more", F.lit(0))).alias("w"))
    rest = stored(rest, "trie_rest")
    zero = F.lit(0).cast("long")
    return rest, taken.select(F.col("succ").alias("arc"), F.col("arc").alias("head"), F.col("w").alias("off")).unionByName(
        rest.select("arc", F.col("arc").alias("head"), zero.alias("off")))


def subtree_sums(tour: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, n_leaves, saved_tokens) from the prefix sums at the two arcs of each node."""
    ranked = stored(tour.join(list_rank(tour, block), "arc").withColumn("bucket", F.expr(f"pos div {block}")), "trie_tour")
    earlier = Window.orderBy("bucket")  # one row for ``block`` arcs
    offsets = ranked.groupBy("bucket").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).select(
        "bucket", (F.sum("l").over(earlier) - F.col("l")).alias("l0"), (F.sum("s").over(earlier) - F.col("s")).alias("s0"))
    inside = Window.partitionBy("bucket").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sums = ranked.select("arc", "bucket", "leaves", "saved", F.sum("leaves").over(inside).alias("l"),
                         F.sum("saved").over(inside).alias("s")).join(offsets, "bucket")

    def held(total: str, offset: str, own: str) -> Column:
        upto = F.col(total) + F.col(offset)
        return F.sum(F.when(F.col("arc") % 2 == 1, upto).otherwise(F.col(own) - upto))

    return sums.groupBy(F.expr("arc div 2").alias("id")).agg(
        held("l", "l0", "leaves").alias("n_leaves"), held("s", "s0", "saved").alias("saved_tokens"))


def ends(found: DataFrame) -> DataFrame:
    """(depth, ka, kb, ends_sha256): the digest of the ids, in order, of the conversations that end at a node."""
    rows = sorted_rows(found.where("depth = len"), "trie_ends", ["depth", "ka", "kb", "conv_id"], "depth", "ka", "kb", "conv_id")
    key = ["depth", "ka", "kb"]
    chunks = rows.groupBy(*key, "_part", F.expr(f"_pos div {CHUNK}").alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches):
        now, digest, made = None, None, []
        for batch in batches:
            for *node, ids in zip(*(batch[c] for c in (*key, "ids")), strict=True):
                if node != now:
                    if now:
                        made.append((*now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if made:
                yield pd.DataFrame(made, columns=[*key, "ends_sha256"])
                made = []
        if now:
            yield pd.DataFrame([(*now, digest.hexdigest())], columns=[*key, "ends_sha256"])

    return chunks.repartition(*key).sortWithinPartitions(*key, "_part", "chunk").select(*key, "ids").mapInPandas(
        run, "depth long, ka long, kb long, ends_sha256 string")


def trie(rows: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a node of the trie of ``rows`` (conv_id, depth, a, b, words, len) and ``convs`` (conv_id, len)."""
    found = stored(members(rows, convs), "trie_members")
    nodes = tree(found)
    if nodes.isEmpty():
        sums = nodes.select("id", F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    else:
        sums = subtree_sums(stored(arcs(nodes), "trie_arcs"), block)
    return nodes.join(sums, "id").join(ends(found), ["depth", "ka", "kb"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def query(spark, sf_dir):
    return trie(*regrouped(table(spark, sf_dir, "conversations")))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(coalesce(role, '')),
                            encode(coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS n,
         xor(4294967295::UBIGINT, list_reduce(
           [4294967295::UBIGINT] || list_transform(range(1, len(conv_id::VARCHAR) + 1),
                                                   lambda k: ascii(substr(conv_id::VARCHAR, k::INT, 1))::UBIGINT),
           lambda x, b: list_reduce([xor(x, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                                    lambda y, z: xor(y >> 1, (y & 1) * 3988292384::UBIGINT)))) % 4 AS h
  FROM t GROUP BY conv_id),
p AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0))::BIGINT AS borrowed,
         (least(c.h, coalesce(b.n, 0)) + greatest(0, c.n::BIGINT - c.h::BIGINT))::BIGINT AS length
  FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (
  SELECT p.conv_id, t.i + 1 AS depth, role, text, length FROM p JOIN t ON t.conv_id = p.base AND t.i < p.borrowed
  UNION ALL
  SELECT p.conv_id, p.borrowed + t.i - p.h::BIGINT + 1, role, text, length FROM p JOIN t ON t.conv_id = p.conv_id AND t.i >= p.h),
k AS (
  SELECT conv_id, depth, length, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS turns
  FROM r
  UNION ALL SELECT conv_id, 0, length, 0, [] FROM p),
m AS (SELECT conv_id, depth, length, words, min(conv_id) OVER (PARTITION BY turns) AS owner FROM k),
n AS (
  SELECT owner, depth, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM m GROUP BY owner, depth),
f AS (SELECT n.*, m.owner AS parent FROM n LEFT JOIN m ON m.conv_id = n.owner AND m.depth = n.depth - 1),
g AS (
  SELECT f.*, coalesce(x.n_children, 0) AS n_children
  FROM f LEFT JOIN (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM f WHERE parent IS NOT NULL GROUP BY ALL) x
    ON x.parent = f.owner AND x.depth = f.depth),
s AS (
  SELECT m.owner, m.depth, count(*) FILTER (g.n_children = 0) AS n_leaves, sum((g.n_convs - 1) * g.words) AS saved_tokens
  FROM g JOIN m ON m.conv_id = g.owner AND m.depth <= g.depth GROUP BY m.owner, m.depth)
SELECT g.owner AS conv_id, g.depth::BIGINT AS depth, g.parent AS parent_conv_id, g.n_convs::BIGINT AS n_convs,
       g.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, g.ends_sha256
FROM g JOIN s ON s.owner = g.owner AND s.depth = g.depth
"""
