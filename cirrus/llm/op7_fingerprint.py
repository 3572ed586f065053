"""Document fingerprints by invertible Bloom lookup tables over paragraph digests.

Only DataFrame operations. A text's paragraphs (lines, cut after every ``PIECE`` words) have 64-bit digests. They are
dealt by hash over groups of 24 cells, as many groups as the least power of two with at most ``LOAD`` digests a group on
average. A group's cells are in three parts of eight; a digest enters one cell of each part, adding to its count and
XORing its key and check fields. The fingerprint is all these cells, group by group, written as text. A digest's cell in
its group does not depend on the number of groups, so a table folds to half the groups by adding the two halves' cells.

Two versions are compared by their fingerprints' cells: the larger table is folded to the groups of the smaller, the
cells are subtracted and peeled: a cell with count +1 or -1 whose check fits its key gives up one differing digest,
which is taken out of its other cells, until nothing is left. The number of recovered digests d gives the likeness
(|A| + |B| - d) / (|A| + |B| + d). The groups are peeled one by one, and d is the sum over them. Only for a group that
does not peel empty are larger tables built, of the digests of both in it, dealt anew by other hashes, and four times the
groups at each further failure.

Results for odd input: null text is empty; an empty text has an empty table, and two empty ones are alike (1.0); the
next document of the last in descending order is the first, a single document is its own next; documents with equal
ids are ordered by their texts' hashes, absent ids last; repeated rows are one document with as many result rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrus.llm.common import ranged, stored, table

PIECE = 24
PIECES = r"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1,%d}" % PIECE
PART, CELLS = 8, 24
#: Digests of a document for each group of cells.
LOAD = 8
EMPTY = "named_struct('c', 0L, 'k', 0L, 'x', 0L)"


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIECES), F.lit(0)),
                                        lambda p: F.xxhash64(F.rtrim(p))))


def cells(keys: str, seed: int = 0) -> str:
    """SQL: the 24 cells of an array of digests."""
    hashed = (f"transform({keys}, d -> named_struct('k', d, 'h', xxhash64(d, {seed}), "
              f"'x', xxhash64(d, {seed}, 'check')))")
    mine = f"filter(w, y -> pmod(shiftright(y.h, 8 * (i div {PART})), {PART}) = i % {PART})"
    return (f"transform(array({hashed}), w -> transform(sequence(0, {CELLS - 1}), i -> aggregate({mine}, {EMPTY}, "
            f"(s, y) -> named_struct('c', s.c + 1, 'k', s.k ^ y.k, 'x', s.x ^ y.x))))[0]")


def dealt(keys: str, n: str, seed: int = 0) -> str:
    """SQL: an array of digests dealt over ``n`` groups, by their own bits or, with a seed, by a hash. Sorted with a mark
    ahead of each group, so that the work does not grow with the groups times the digests."""
    bits = f"xxhash64(d, 'group', {seed})" if seed else "d"
    marked = (f"sort_array(concat(transform({keys}, d -> named_struct('g', cast(pmod(shiftright({bits}, 7), {n}) as int), "
              f"'e', 1, 'd', d)), transform(sequence(0, {n}), g -> named_struct('g', g, 'e', 0, 'd', 0L))))")
    marks = "filter(transform(v, (y, i) -> IF(y.e = 0, i, -1)), i -> i >= 0)"
    return (f"IF({n} = 1, array({keys}), transform(array({marked}), v -> transform(array({marks}), m -> transform("
            f"sequence(0, size(m) - 2), g -> transform(slice(v, m[g] + 2, m[g + 1] - m[g] - 1), y -> y.d)))[0])[0])")


def cell_table(keys: str) -> str:
    """SQL: the cells of all groups of a document's digests, group by group."""
    n = f"transform(array({keys}), k -> cast(pow(2, ceil(log2(greatest(size(k), {LOAD}) / {LOAD}D))) as int))[0]"
    return f"flatten(transform(transform(array({n}), n -> {dealt(keys, 'n')})[0], u -> {cells('u')}))"


def folded(t: str, size: str) -> str:
    """SQL: a table folded to ``size`` cells."""
    return (f"IF(size({t}) = {size}, {t}, transform(sequence(0, {size} - 1), j -> aggregate(sequence(j, size({t}) - 1, "
            f"{size}), {EMPTY}, (s, i) -> named_struct('c', s.c + {t}[i].c, 'k', s.k ^ {t}[i].k, 'x', s.x ^ {t}[i].x))))")


LESS = "(p, q) -> named_struct('c', p.c - q.c, 'k', p.k ^ q.k, 'x', p.x ^ q.x)"


def differences(t: str, u: str) -> str:
    """SQL: the numbers of digests that the groups of two tables (columns or lambda variables) differ in, null for a group
    that does not peel."""
    less = f"zip_with({folded(t, 'm')}, {folded(u, 'm')}, {LESS})"
    group = f"transform(array(slice(l, g * {CELLS} + 1, {CELLS})), z -> {peeled(0)})[0]"
    return (f"transform(transform(array(least(size({t}), size({u}))), m -> {less}), l -> transform(sequence(0, size(l) div "
            f"{CELLS} - 1), g -> {group}))[0]")


def difference(t: str, u: str) -> str:
    """SQL: the number of digests that two tables differ in, null if they do not peel."""
    return (f"transform(array({differences(t, u)}), p -> IF(exists(p, x -> x IS NULL), CAST(NULL AS INT), "
            f"aggregate(p, 0, (s, x) -> s + x)))[0]")


def peeled(seed: int) -> str:
    """SQL: the number of digests peeled from the difference ``z`` of two tables, null if it does not empty."""
    pure = f"filter(s.t, y -> abs(y.c) = 1 AND xxhash64(y.k, {seed}, 'check') = y.x)"
    found = f"array_distinct(transform({pure}, y -> named_struct('c', y.c, 'k', y.k)))"
    cell = f"pmod(shiftright(xxhash64(q.k, {seed}), 8 * (j div {PART})), {PART})"
    taken = (f"transform(s.t, (y, j) -> aggregate(filter(p, q -> {cell} = j % {PART}), y, (o, q) -> named_struct("
             f"'c', o.c - q.c, 'k', o.k ^ q.k, 'x', o.x ^ xxhash64(q.k, {seed}, 'check'))))")
    step = (f"transform(array({found}), p -> IF(size(p) = 0, named_struct('t', s.t, 'n', s.n, 'f', true), "
            f"named_struct('t', {taken}, 'n', s.n + size(p), 'f', false)))[0]")
    empty = "forall(s.t, y -> y.c = 0 AND y.k = 0 AND y.x = 0)"
    return (f"aggregate(sequence(1, {CELLS}), named_struct('t', z, 'n', 0, 'f', false), "
            f"(s, r) -> IF(s.f, s, {step}), s -> IF({empty}, s.n, CAST(NULL AS INT)))")


def written(keys: str) -> Column:
    """A table as text: count, key and check of each cell in hexadecimal digits."""
    return F.expr(f"array_join(transform({cell_table(keys)}, y -> concat(lower(hex(y.c)), '.', lower(hex(y.k)), '.', "
                  "lower(hex(y.x)))), ':')")


def differing(pairs: DataFrame) -> DataFrame:
    """pairs (id columns.., a, b: digests) with d, the size of the symmetric difference, recovered by peeling; the sum over
    the rows of an id.

    For what did not peel in the pairs' own tables: the groups are as many as both together need, and only the digests of
    a group that is stuck again are dealt once more."""
    ids = [c for c in pairs.columns if c not in ("a", "b")]
    part, done, level = pairs, None, 1
    while True:
        load = 16 / 4**level
        groups = f"greatest(1, cast(ceil((size(a) + size(b)) / {load}) as int))"
        less = f"zip_with({cells('v.a', level)}, {cells('v.b', level)}, {LESS})"
        each = (f"transform(zip_with({dealt('a', 'n', level)}, {dealt('b', 'n', level)}, (p, q) -> named_struct('a', p, 'b', q)), "
                f"v -> named_struct('d', transform(array({less}), z -> {peeled(level)})[0], 'v', v))")
        got = part.withColumn("n", F.expr(groups)).select(*ids, F.expr(
            f"transform(array({each}), g -> named_struct('d', aggregate(g, 0L, (s, x) -> s + coalesce(x.d, 0)), "
            f"'left', transform(filter(g, x -> x.d IS NULL), x -> x.v)))[0]").alias("r"))
        got = stored(got, "fingerprint_level")
        sums = got.select(*ids, "r.d")
        done = sums if done is None else done.union(sums)
        part = got.where("size(r.left) > 0").select(*ids, F.explode("r.left").alias("v")).select(*ids, "v.a", "v.b")
        if part.isEmpty():
            return done.groupBy(*ids).agg(F.sum("d").alias("d"))
        level += 1


def successors(docs: DataFrame) -> DataFrame:
    """(doc_id, _th, n, next_id, next_th): each distinct document and its next by descending id, cyclically."""
    order = (F.col("doc_id").desc_nulls_last(), F.col("_th").desc())
    part = ranged(docs.select("doc_id", "_th", "n").distinct(), "fingerprint_order", *order)
    inside = Window.partitionBy("_part").orderBy(*order)
    rows = part.withColumn("nx", F.lead(F.struct("doc_id", "_th")).over(inside))
    heads = part.withColumn("i", F.row_number().over(inside)).where("i = 1").select(
        "_part", F.struct("doc_id", "_th").alias("h"))
    by_part = Window.orderBy("_part")  # one row for each partition
    heads = heads.withColumn("after", F.coalesce(F.lead("h").over(by_part), F.first("h").over(
        by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))).select("_part", "after")
    return rows.join(heads, "_part").select(
        "doc_id", "_th", "n", F.coalesce("nx", "after").alias("nx")).select(
        "doc_id", "_th", "n", F.col("nx.doc_id").alias("next_id"), F.col("nx._th").alias("next_th"))


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, _th, n_chars, edited_sha256 and the digests a (text), e (edited text), x (next text) of every row.

    The edited text has its last third (rounded down) replaced by as many first characters of the next document."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_th"))
    order = stored(successors(docs.withColumn("n", F.char_length("text"))), "fingerprint_next")
    # What a document hands to the one before it: the characters needed there, and its digests.
    wish = order.select(F.col("next_id").alias("w_id"), F.col("next_th").alias("w_th"), F.col("doc_id").alias("to_id"),
                        F.col("_th").alias("to_th"), F.expr("n div 3").cast("int").alias("need"))
    gift = docs.dropDuplicates(["doc_id", "_th"]) if _repeated(docs) else docs
    gift = gift.join(wish, F.expr("doc_id <=> w_id AND _th = w_th")).select(
        "to_id", "to_th", F.substring("text", F.lit(1), F.col("need")).alias("head"), digests(F.col("text")).alias("x"))
    both = docs.join(gift, F.expr("doc_id <=> to_id AND _th = to_th"))
    n = F.char_length("text")
    made = F.concat(F.substring("text", F.lit(1), n - F.expr("char_length(text) div 3").cast("int")), "head")
    return both.select("doc_id", "_th", n.cast("long").alias("n_chars"), "text", "x", made.alias("edited")).select(
        "doc_id", "_th", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("a"),
        digests(F.col("edited")).alias("e"), "x")


def _repeated(docs: DataFrame) -> bool:
    return not docs.groupBy("doc_id", "_th").count().where("count > 1").isEmpty()


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_chars, edited_sha256, the two fingerprints, near_edited, near_next."""
    made = stored(edited(docs), "fingerprint_made")
    once = made.dropDuplicates(["doc_id", "_th"]) if _repeated(made) else made
    # By the documents' own tables; a is compared twice.
    own = once.select("doc_id", "_th", F.expr(
        f"transform(array({cell_table('a')}), t -> named_struct("
        f"'edited', transform(array({cell_table('e')}), u -> {differences('t', 'u')})[0], "
        f"'next', transform(array({cell_table('x')}), u -> {differences('t', 'u')})[0]))[0]").alias("v")).select(
        "doc_id", "_th", F.explode(F.create_map(
            F.lit("edited"), F.col("v.edited"), F.lit("next"), F.col("v.next"))).alias("kind", "d"))
    own = stored(own, "fingerprint_own")
    found = own.select("doc_id", "_th", "kind", F.expr("aggregate(d, 0L, (s, x) -> s + coalesce(x, 0))").alias("d"))
    # The groups that did not peel: which of how many.
    stuck = F.filter(F.transform("d", lambda x, i: F.when(x.isNull(), i)), lambda i: i.isNotNull())
    left = own.where(F.exists("d", lambda x: x.isNull())).select(
        F.col("doc_id").alias("_d"), F.col("_th").alias("_t"), F.struct("kind", F.size("d").alias("n"), stuck.alias("g")).alias("k"))
    if not left.isEmpty():
        left = left.groupBy("_d", "_t").agg(F.collect_list("k").alias("kinds"))
        pairs = once.join(left, F.expr("doc_id <=> _d AND _th = _t")).select(
            "doc_id", "_th", F.explode("kinds").alias("k"), "a", "e", "x").select(
            "doc_id", "_th", "k.kind", "k.n", "k.g", "a", F.expr("IF(k.kind = 'edited', e, x)").alias("b"))
        some = lambda c: f"transform(array({dealt(c, 'n')}), z -> transform(g, i -> z[i]))[0]"
        pairs = pairs.select("doc_id", "_th", "kind", F.explode(F.arrays_zip(
            F.expr(some("a")).alias("a"), F.expr(some("b")).alias("b"))).alias("v")).select("doc_id", "_th", "kind", "v.a", "v.b")
        # Small rows with much work each, so they are dealt over all tasks.
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pairs = stored(pairs, "fingerprint_stuck").repartition(parts)
        found = found.union(differing(pairs).select("doc_id", "_th", "kind", "d"))
    found = found.groupBy(F.col("doc_id").alias("_d"), F.col("_th").alias("_t")).agg(
        *(F.sum(F.when(F.col("kind") == k, F.col("d"))).alias(f"d_{k}") for k in ("edited", "next")))

    def near(other: str, d: str) -> Column:
        both = F.size("a") + F.size(other)
        return F.when(both == 0, 1.0).otherwise((both - F.col(d)) / (both + F.col(d))).cast("double")

    return made.join(found, F.expr("doc_id <=> _d AND _th = _t")).select(
        "doc_id", "n_chars", "edited_sha256", written("a").alias("fingerprint"), written("e").alias("edited_fingerprint"),
        near("e", "d_edited").alias("near_edited"), near("x", "d_next").alias("near_next"))


def query(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))
