"""Merkle manifest of a data set: a hash tree per language, a tree over the languages, and every document's proof.

A leaf is the SHA-256 of a document's encoded columns.  Within a language the
leaves stand in order of doc_id; while several nodes remain, every two
consecutive ones (a last one alone too) become the hash of their digests.  The
languages' roots, in order of language, form a tree of the same kind.

Building: leaves get their places from a range partitioning and the running
sum of the range sizes, and trees grow ``BITS`` levels at a time, each task
hashing blocks of at most 2^BITS neighbouring nodes, so no language is ever in
one task.  Proving: every node holds its sibling as a segment of length one
and points to its parent.  A self-join doubles the distance of all pointers:
the segment of the node pointed to is put behind the own one.  After
log2(height) joins every leaf points to the root and holds its whole proof.
Only nodes that a later join reads are kept (those whose level the distance
divides).  Where more than 2^BITS leaves point to one node, the node is laid
out once per block of leaves, so no join key has more than 2^BITS rows.

Defined cases: nulls in any column are encoded as ``-``; a null doc_id stands
first and counts as the empty text where its checksum is needed; a null
language is a tree of its own, first in order; documents of equal doc_id stand
in order of their leaves, and wholly equal rows are leaves of their own; an
empty table has no rows and no root; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_bounded, cut_lineage, partitions_for, release
from .common import crc_of, documents

BITS = 12  # levels grown at a time, and leaves (as a power of two) under one join key
COLUMNS = (("doc_id", "long"), ("source", "string"), ("lang", "string"), ("n_chars", "long"), ("text", "string"))
NODE = "tree int, n long, rises int, level int, idx long, open boolean, own struct<id:long,digest:binary,other:binary>, digest binary, sibling binary"


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(changed: dict[str, Column] | None = None) -> Column:
    """Digest (binary) of a document, with some columns replaced."""
    parts = [encoded((changed or {}).get(c, F.col(c)).cast(t)) for c, t in COLUMNS]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def tampered_leaf() -> Column:
    """The leaf with one more character counted, where 7 divides the checksum of the doc_id and there is a count; else null."""
    return F.when((crc_of("doc_id", 7) == 0) & F.col("n_chars").isNotNull(),
                  leaf({"n_chars": F.col("n_chars").cast("long") + 1}))


def _numbered(ordered: DataFrame) -> DataFrame:
    """``number``: the row's place in the whole, from ``at`` (range and place within it, as the ranges were written)."""
    part = F.shiftright("at", 33)
    starts, total = [], 0
    for p, rows in ordered.groupBy(part).count().orderBy(part).collect():  # one row per range
        starts.append((p, total))
        total += rows
    offsets = F.broadcast(ordered.sparkSession.createDataFrame(starts, "range long, start long"))
    return ordered.join(offsets, part == F.col("range")) \
        .withColumn("number", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at", "range", "start")


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves: tree, n, idx, own; trees: tree, lang, n), from rows of lang, id, digest and other."""
    spark = rows.sparkSession
    stored = cut_lineage(rows.withColumn("salt", F.monotonically_increasing_id()))  # equal rows differ by their salt
    keys = ["lang", "id", "digest", "salt"]
    ranged = stored.repartitionByRange(partitions_for(spark, stored.count()), *keys).sortWithinPartitions(*keys)
    ordered = cut_lineage(ranged.drop("salt").withColumn("at", F.monotonically_increasing_id()))
    release(stored)
    place = _numbered(ordered).withColumnRenamed("number", "place")
    firsts = cut_lineage(place.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")))
    ranks = cut_lineage(firsts.repartitionByRange(partitions_for(spark, firsts.count()), "first").sortWithinPartitions("first")
                        .withColumn("at", F.monotonically_increasing_id()))
    release(firsts)
    trees = _numbered(ranks).select(F.col("number").cast("int").alias("tree"), F.col("lang").alias("tree_lang"), "n", "first")
    leaves = place.join(broadcast_if_bounded(trees), F.col("lang").eqNullSafe(F.col("tree_lang"))) \
        .select("tree", "n", (F.col("place") - F.col("first")).alias("idx"), F.struct("id", "digest", "other").alias("own"))
    return leaves, trees.select("tree", F.col("tree_lang").alias("lang"), "n")


def _height(n: int) -> int:
    return (n - 1).bit_length()


def _grower(level: int, bits: int):
    """Hashes one block: its nodes of ``bits`` levels with their siblings, and its top (``open`` unless it is the root)."""

    def grow(block: pa.Table) -> pa.Table:
        block = block.sort_by("idx").combine_chunks()
        tree, n, at = (block[c][0].as_py() for c in ("tree", "n", "idx"))
        height = _height(n)
        digest = [d.hex() for d in block["digest"].to_pylist()]
        out: dict[str, list] = {c: [] for c in ("level", "idx", "open", "digest", "sibling")}
        at_level = level
        while True:
            top = at_level >= min(level + bits, height)
            out["level"] += [at_level] * len(digest)
            out["idx"] += range(at, at + len(digest))
            out["open"] += [top and at_level < height] * len(digest)
            raw = [bytes.fromhex(d) for d in digest]
            out["digest"] += raw
            out["sibling"] += [None] * len(raw) if top else [raw[j ^ 1] if j ^ 1 < len(raw) else None for j in range(len(raw))]
            if top:
                break
            digest = [hashlib.sha256("".join(digest[j:j + 2]).encode()).hexdigest() for j in range(0, len(digest), 2)]
            at, at_level = at >> 1, at_level + 1
        rows = len(out["idx"])
        own = pa.concat_arrays([block["own"].chunk(0), pa.nulls(rows - len(block), block["own"].type)])
        return pa.table([pa.array([tree] * rows, pa.int32()), pa.array([n] * rows, pa.int64()), pa.array([height] * rows, pa.int32()),
                         pa.array(out["level"], pa.int32()),
                         pa.array(out["idx"], pa.int64()), pa.array(out["open"]), own, pa.array(out["digest"], pa.binary()),
                         pa.array(out["sibling"], pa.binary())], names=["tree", "n", "rises", "level", "idx", "open", "own", "digest", "sibling"])

    return grow


def grown(leaves: DataFrame, height: int, bits: int) -> list[DataFrame]:
    """All nodes of all trees, as written tables, one per ``bits`` levels."""
    front = leaves.withColumn("digest", F.col("own.digest"))
    tables = []
    for level in range(0, max(height, 1), bits):
        nodes = front.select("tree", "n", "idx", "own", "digest", F.shiftright("idx", bits).alias("block"))
        tables.append(cut_lineage(nodes.groupBy("tree", "block").applyInArrow(_grower(level, bits), NODE)))
        front = tables[-1].filter("open").select("tree", "n", "idx", F.lit(None).cast("struct<id:long,digest:binary,other:binary>").alias("own"), "digest")
    return tables


def proofs(leaves: DataFrame, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(tree, n, idx, own, segment: the siblings from the leaf to the root, null where there is none; tree, root)."""
    bits = BITS if bits is None else bits
    largest = leaves.agg(F.max("n")).first()[0] or 1
    height = _height(largest)
    tables = grown(leaves, height, bits)
    nodes = tables[0]
    for t in tables[1:]:
        nodes = nodes.unionByName(t)
    # an open node stands again, with its sibling, in the next table
    nodes = nodes.filter("not open")
    roots = cut_lineage(nodes.filter("level = rises").select("tree", F.col("digest").alias("root")))
    ends = F.when(F.col("level") < F.col("rises"), F.array("sibling")).otherwise(F.array().cast("array<binary>"))
    now = nodes.filter("level = 0 or level < rises").select("tree", "n", "level", "idx", "own", ends.alias("segment"))
    far, before = 1, tables
    while far < height:
        left = now.filter(F.col("level") % (2 * far) == 0)
        right = now.filter(F.col("level") % (2 * far) == far).select("tree", "n", "level", "idx", F.col("segment").alias("more"))
        left = left.withColumn("up", F.col("level") + far)
        if far <= bits:
            left = left.withColumn("key", F.shiftright("idx", far))
            right = right.withColumn("key", F.col("idx"))
        else:
            # one row per block of 2^bits leaves below the node
            left = left.withColumn("key", F.expr(f"shiftright(shiftleft(idx, level), {bits})"))
            right = right.withColumn("key", F.explode(F.expr(
                f"sequence(shiftleft(idx, level - {bits}), least(shiftleft(idx + 1, level - {bits}) - 1, shiftright(n - 1, {bits})))")))
        right = right.select(F.col("tree").alias("rt"), F.col("level").alias("rl"), F.col("key").alias("rk"), "more")
        joined = left.join(right, (F.col("tree") == F.col("rt")) & (F.col("up") == F.col("rl")) & (F.col("key") == F.col("rk")), "left")
        longer = F.concat("segment", F.coalesce("more", F.array().cast("array<binary>")))
        now = cut_lineage(joined.select("tree", "n", "level", "idx", "own", longer.alias("segment")))
        for t in before:
            release(t)
        before = [now]
        far *= 2
    return now.filter("level = 0").drop("level"), roots


def folded(start: Column, segment: str, idx: str) -> Column:
    """The root (hex) that a node (hex) and its siblings give; the bits of ``idx`` tell on which side the siblings stand."""
    steps = F.transform(segment, lambda s, i: F.struct(
        F.lower(F.hex(s)).alias("s"), (F.call_function("shiftright", F.col(idx), i).bitwiseAND(F.lit(1)) == 1).alias("right")))
    text = lambda a, x: F.when(x["s"].isNull(), a).when(x["right"], F.concat(x["s"], a)).otherwise(F.concat(a, x["s"]))
    return F.aggregate(steps, start, lambda a, x: F.sha2(text(a, x).cast("binary"), 256))


def manifest(docs: DataFrame, bits: int | None = None) -> DataFrame:
    """One row per document: doc_id, lang, leaf, tampered (another leaf to prove, or null), place (in its tree), segment,
    tree, trees, subroot, root, top_segment; digests as hex."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("id"),
                       leaf().alias("digest"), tampered_leaf().alias("other"))
    leaves, trees = placed(rows)
    within, subroots = proofs(leaves, bits)
    count = trees.count()
    tops = trees.join(subroots, "tree")
    top_leaves = tops.select(F.lit(0).alias("tree"), F.lit(count).cast("long").alias("n"), F.col("tree").cast("long").alias("idx"),
                             F.struct(F.col("tree").cast("long").alias("id"), F.col("root").alias("digest"),
                                      F.lit(None).cast("binary").alias("other")).alias("own"))
    above, root = proofs(top_leaves, bits)
    top = above.join(root, "tree").select(
        F.col("own.id").cast("int").alias("tree"), F.lit(count).alias("trees"), F.col("own.digest").alias("subroot"), "root",
        F.col("segment").alias("top_segment")).join(trees.select("tree", "lang"), "tree")
    hexed = lambda c: F.lower(F.hex(c))
    return within.join(broadcast_if_bounded(cut_lineage(top)), "tree").select(
        F.col("own.id").alias("doc_id"), "lang", hexed("own.digest").alias("leaf"), hexed("own.other").alias("tampered"),
        F.col("idx").alias("place"), "segment", "tree", "trees", hexed("subroot").alias("subroot"), hexed("root").alias("root"), "top_segment")


def op13_merkle_manifest(spark, sf_dir) -> DataFrame:
    rows = manifest(documents(spark, sf_dir))
    siblings = F.array_join(F.transform(F.filter(F.concat("segment", "top_segment"), lambda s: s.isNotNull()), lambda s: F.lower(F.hex(s))), "")
    rows = rows.withColumn("proof_sha256", F.sha2(siblings.cast("binary"), 256)) \
               .withColumn("folded_root", folded(folded(F.coalesce("tampered", "leaf"), "segment", "place"), "top_segment", "tree"))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


ORACLE_SQL = r"""
with recursive
e as (select *, coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id::varchar, '-')
             || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') as head,
             coalesce(octet_length(encode(text)) || ':' || text, '-') as tail,
             xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(coalesce(doc_id::varchar, ''), ''), lambda c: coalesce(ascii(nullif(c, '')), 0)::ubigint)),
                 lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]), lambda x, i: xor(x >> 1, 3988292384::ubigint * (x & 1)))), 4294967295::ubigint) as crc
      from documents),
l as (select doc_id, lang, sha256(head || coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars::varchar, '-') || tail) as leaf,
             case when crc % 7 = 0 and n_chars is not null
                  then sha256(head || octet_length(encode((n_chars + 1)::varchar)) || ':' || (n_chars + 1)::varchar || tail) end as other from e),
d as (select *, row_number() over () as r, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n from l),
t as (select lang, 0 as lev, pos as idx, leaf as h, n as c from d
      union all
      select lang, lev + 1, idx // 2, sha256(string_agg(h, '' order by idx)), any_value((c + 1) // 2) from t where c > 1 group by lang, lev, idx // 2),
s as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from t where c = 1),
u as (select 0 as lev, pos as idx, subroot as h, n as c from s
      union all
      select lev + 1, idx // 2, sha256(string_agg(h, '' order by idx)), any_value((c + 1) // 2) from u where c > 1 group by lev, idx // 2),
low as (select r, string_agg(h, '' order by lev) as p from d join t on t.lang is not distinct from d.lang and t.idx = xor(d.pos >> lev, 1::bigint) and c > 1 group by r),
high as (select s.lang, string_agg(h, '' order by lev) as p from s join u on u.idx = xor(s.pos >> lev, 1::bigint) and c > 1 group by s.lang),
f as (select r, lang, pos as idx, n as c, 0 as lev, coalesce(other, leaf) as h from d
      union all
      select f.r, f.lang, f.idx // 2, (f.c + 1) // 2, f.lev + 1,
             sha256(case when f.idx % 2 = 1 then coalesce(t.h, '') || f.h else f.h || coalesce(t.h, '') end)
      from f left join t on t.lang is not distinct from f.lang and t.lev = f.lev and t.idx = xor(f.idx, 1::bigint) where f.c > 1),
g as (select f.r, s.pos as idx, s.n as c, 0 as lev, f.h from f join s on s.lang is not distinct from f.lang where f.c = 1
      union all
      select g.r, g.idx // 2, (g.c + 1) // 2, g.lev + 1,
             sha256(case when g.idx % 2 = 1 then coalesce(u.h, '') || g.h else g.h || coalesce(u.h, '') end)
      from g left join u on u.lev = g.lev and u.idx = xor(g.idx, 1::bigint) where g.c > 1)
select doc_id, leaf, subroot, root.h as root, sha256(coalesce(low.p, '') || coalesce(high.p, '')) as proof_sha256, g.h as folded_root, g.h = root.h as verified
from d join s on s.lang is not distinct from d.lang join (select h from u where c = 1) root on true
left join low on low.r = d.r left join high on high.lang is not distinct from d.lang join g on g.r = d.r and g.c = 1"""
