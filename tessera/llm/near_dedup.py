"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles.  In each of ``trees``
independent trees documents branch by their minwise token of each level (two
sets of similarity J take the same branch with probability J); a node with
more than ``leaf`` documents branches once more, down to ``LEVELS`` levels.
Documents that share a node are candidates; every candidate link is confirmed
on the full sets.  With similarity 0.8 a pair meets in one tree with
probability 0.64 at two levels and 0.41 at four, and in none of 20 with
probability 1e-9 and 3e-5; the sketches miss such a pair with probability 5e-5.

No node emits all its pairs.  First every member is compared with one pivot of its
node, and the confirmed links are closed to components.  Nodes that still span
several components are cut into cells of at most two blocks, each of about
``BLOCK`` members and ``BLOCK_BYTES`` bytes of sets.  In a cell every two
members of different components are compared by sketch (16 bits of each of
``SKETCH`` minwise values); members with a partner are brought together with
their full sets, and the cell confirms its candidates on these and returns a
spanning forest of the links found.  So nodes of any size are compared
exhaustively, but for pairs already inside one component, which cannot change
the result.  Equal sets are reduced to one representative beforehand.

Defined cases: null or empty texts and texts without a word have empty sets,
``n_shingles`` 0, and link with nothing; a text with fewer words than a
shingle is one shingle; rows that share a doc_id are one document, whose links
are those of all its texts, so they stand or fall together (``n_shingles`` is
each row's own); a null doc_id is in no component and is kept; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import cut_lineage, release
from .common import documents, gather, id_text
from .words import Chunk, Spans, combine, mix, per_row_sum, row_of, text_chunks

TREES, LEVELS, FIRST, LEAF, BLOCK = 20, 4, 2, 64, 512
SKETCH = 256
BLOCK_BYTES = 16 << 20
FILTER_BITS = 1 << 26    # of the bitmap of wanted documents, 8 MB whatever the input
_rng = np.random.RandomState(7)
_XOR = _rng.randint(0, 1 << 63, (TREES * LEVELS + SKETCH,), dtype=np.uint64) * np.uint64(2)
_MUL = _rng.randint(0, 1 << 63, (TREES * LEVELS + SKETCH,), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(ch: Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row: (hashes, first)."""
    low = ch.lowered()
    starts, ends, first = low.words()
    h, row = Spans(low.data).hash(starts, ends), row_of(first)
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < k))
    whole = np.empty(len(short), np.uint64)
    for i, r in enumerate(short):
        w = h[first[r]:first[r + 1]]
        acc = np.full(1, len(w), np.uint64)
        for x in w:
            acc = combine(acc, np.full(1, x, np.uint64))
        whole[i] = acc[0]
    if len(h) >= k:
        inside = np.flatnonzero(row[:len(row) - k + 1] == row[k - 1:])
        s = h[inside]
        for j in range(1, k):
            s = combine(s, h[inside + j])
        srow = row[inside]
    else:
        s, srow = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    s, srow = np.concatenate([s, whole]), np.concatenate([srow, short])
    key = combine(s, srow.astype(np.uint64))
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    keep = order[new]
    keep = keep[np.argsort(srow[keep], kind="stable")]
    return s[keep], np.searchsorted(srow[keep], np.arange(ch.rows + 1))


def _fingerprint(s: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each row's set that, with its size, stand for the set."""
    with np.errstate(over="ignore"):
        return per_row_sum(mix(s).view(np.int64), first), per_row_sum(mix(s ^ _XOR[0]).view(np.int64), first)


def _sketch(k: int):
    def run(batches):
        for b in batches:
            ids = b.column(0)
            for ch in text_chunks(b.column(1)):
                s, first = shingle_sets(ch, k)
                n = np.diff(first)
                full = np.flatnonzero(n)
                sig = np.zeros((ch.rows, TREES * LEVELS), np.uint64)
                low = np.zeros((ch.rows, SKETCH), np.uint16)
                with np.errstate(over="ignore"):
                    for i in range(TREES * LEVELS + SKETCH if len(full) else 0):
                        m = np.minimum.reduceat((s ^ _XOR[i]) * _MUL[i], first[full])
                        if i < TREES * LEVELS:
                            sig[full, i] = m
                        else:
                            low[full, i - TREES * LEVELS] = mix(m) & np.uint64(0xFFFF)
                    fa, fb = _fingerprint(s, first)
                raw, short = (x.view(np.uint8).reshape(ch.rows, -1) for x in (sig, low))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(ch.first, ch.rows), pa.array(n.astype(np.int64)), pa.array(fa), pa.array(fb),
                     pa.array([x.tobytes() for x in raw], pa.binary()), pa.array([x.tobytes() for x in short], pa.binary())],
                    ["doc_id", "n_shingles", "fa", "fb", "path", "sig"])
    return run


def _branch(batches):
    """One row per document and tree: the node at the first depth, and the tokens of the deeper levels."""
    for b in batches:
        if not b.num_rows:
            continue
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint64).reshape(b.num_rows, TREES, LEVELS)
        node = mix(sig[:, :, 0] + np.arange(1, TREES + 1, dtype=np.uint64))
        for d in range(1, FIRST):
            node = combine(node, sig[:, :, d])
        cols = [np.repeat(b.column(0).to_numpy(zero_copy_only=False), TREES), node.reshape(-1).view(np.int64),
                *(sig[:, :, d].reshape(-1).view(np.int64) for d in range(FIRST, LEVELS))]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols],
                                         ["c", "node", *(f"t{d}" for d in range(FIRST, LEVELS))])


def _alike(least: int):
    """Pairs whose sketches share at least so many minwise tokens."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(b.num_rows, -1) for i in (2, 3))
                ok = pa.array((x == y).sum(1) >= least)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["a", "b"])
    return run


def _runs(batches):
    """Consecutive rows with equal first column, as one batch each; the input is sorted by it."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        t = t.combine_chunks()
        key = t.column(0).to_numpy()
        cut = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
        for lo, hi in zip(cut[:-1], cut[1:]):
            yield t.slice(lo, hi - lo)
        held = t.slice(cut[-1]) if len(cut) else None
    if held is not None and held.num_rows:
        yield held


def _sides(block):
    """The two blocks of a cell; both are the same in a cell of one block."""
    return np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max()), block.min() == block.max()


def _partners(least: int):
    """The rows of a cell whose sketch agrees with that of a row of another component."""
    def run(batches):
        for t in _runs(batches):
            comp = t.column(2).to_numpy()
            sig = np.frombuffer(b"".join(t.column(4).to_pylist()), np.uint16).reshape(t.num_rows, -1)
            left, right, _ = _sides(t.column(3).to_numpy())
            keep = np.zeros(t.num_rows, bool)
            for i in left:
                o = right[comp[right] != comp[i]]
                near = o[(sig[o] == sig[i]).sum(1) >= least]
                keep[near] = True
                keep[i] |= len(near) > 0
            yield from t.filter(pa.array(keep)).to_batches()
    return run


def _cell_links(least: int, percent: int):
    """A spanning forest of the links of a cell between different components, confirmed on full sets."""
    def run(batches):
        for t in _runs(batches):
            c, comp = t.column(1).to_numpy(), t.column(2).to_numpy()
            left, right, same_block = _sides(t.column(3).to_numpy())
            sig = np.frombuffer(b"".join(t.column(4).to_pylist()), np.uint16).reshape(t.num_rows, -1)
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column(5)]
            n = np.array([len(x) for x in sets])
            first = np.cumsum(n) - n
            flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
            mark = np.zeros(flat.max() + 1, bool)
            lab = np.unique(comp, return_inverse=True)[1]
            a, b = [], []
            for i in left:
                o = right[(lab[right] != lab[i]) & (100 * np.minimum(n[right], n[i]) >= percent * np.maximum(n[right], n[i]))]
                o = o[o > i] if same_block else o
                o = o[(sig[o] == sig[i]).sum(1) >= least]
                if not len(o):
                    continue
                own = flat[first[i]:first[i] + n[i]]
                mark[own] = True
                begin = np.cumsum(n[o]) - n[o]
                at = np.repeat(first[o] - begin, n[o]) + np.arange(n[o].sum())
                inter = np.add.reduceat(mark[flat[at]].astype(np.int64), begin)
                mark[own] = False
                o = o[100 * inter >= percent * (n[i] + n[o] - inter)]
                if len(o):
                    new, one = np.unique(lab[o], return_index=True)
                    a.append(np.full(len(one), c[i]))
                    b.append(c[o[one]])
                    lab[np.isin(lab, new)] = lab[i]
            if a:
                yield _pair_batch(a, b)
    return run


def _pair_batch(a, b):
    x, y = np.concatenate(a), np.concatenate(b)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["src", "dst"])


def _sets(k: int, wanted):
    """Sorted shingles of the rows whose id may be wanted, and the fingerprint of their set."""
    def run(batches):
        for b in batches:
            mark = b.column(2).to_numpy()
            b = b.filter(pa.array((wanted.value[mark >> 3] >> (mark & 7) & 1).astype(bool)))
            for ch in text_chunks(b.column(1)):
                s, first = shingle_sets(ch, k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(ch.first, ch.rows), pa.array(np.diff(first).astype(np.int64)),
                     *map(pa.array, _fingerprint(s, first)),
                     pa.array([np.sort(s[first[r]:first[r + 1]]).tobytes() for r in range(ch.rows)], pa.binary())],
                    ["doc_id", "n_shingles", "fa", "fb", "s"])
    return run


def _confirm(percent: int):
    def run(batches):
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                ok[i] = 100 * inter >= percent * (len(x) + len(y) - inter)
            ok = pa.array(ok)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["src", "dst"])
    return run


def _tree_nodes(reps: DataFrame) -> DataFrame:
    """(node, c): members of every node with at least two documents, oversized nodes branched further."""
    rest = [f"t{d}" for d in range(FIRST, LEVELS)]
    rows = reps.select("c", "path").mapInArrow(_branch, "c long, node long, " + ", ".join(f"{t} long" for t in rest))
    for i in range(len(rest) + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        rows = rows.join(sizes, "node")
        if i < len(rest):
            deeper = F.col("m") > LEAF
            rows = rows.select("c", F.when(deeper, F.xxhash64("node", rest[i])).otherwise(F.col("node")).alias("node"), *rest)
    return rows.select("node", "c")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept.

    Links: 100 * intersection >= percent * union of the shingle sets.
    """
    spark = docs.sparkSession
    base = id_text(docs)
    sketch = cut_lineage(base.mapInArrow(_sketch(shingle), "doc_id long, n_shingles long, fa long, fb long, path binary, sig binary"))
    real = sketch.filter("n_shingles > 0 and doc_id is not null")
    same = ["fa", "fb", "n_shingles"]
    reps = cut_lineage(real.groupBy(*same).agg(F.min(F.struct("doc_id", "path", "sig")).alias("m"))
                       .select(*same, F.col("m.doc_id").alias("c"), F.col("m.doc_id").alias("doc_id"), "m.path", "m.sig"))
    # classes go by their smallest doc_id; where several texts of one id would, all but one go by a number from the end of the range
    shared = reps.groupBy("c").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct(*same)).alias("own")).filter("m > 1")
    if shared.limit(1).count():
        other = F.col("own").isNotNull() & (F.struct(*same) != F.col("own"))
        renamed = reps.join(shared.select("c", "own"), "c", "left") \
            .withColumn("c", F.when(other, F.lit((1 << 63) - 1) - F.monotonically_increasing_id()).otherwise(F.col("c"))).drop("own")
        renamed = cut_lineage(renamed)
        release(reps)
        reps = renamed
    # the classes of every document; a document with several texts ties their classes together
    of = cut_lineage(real.select("doc_id", *same).join(reps.select(*same, "c"), same).select("doc_id", "c"))
    tied = of.groupBy("doc_id").agg(F.min("c").alias("src"), F.max("c").alias("dst")).filter("src <> dst").select("doc_id", "src")
    tied = of.join(tied, "doc_id").filter("c <> src").select("src", F.col("c").alias("dst")).distinct()
    nodes = cut_lineage(_tree_nodes(reps))
    wanted = nodes.select("c").distinct()
    needed = cut_lineage(reps.join(wanted, "c", "left_semi").select("c", "doc_id", *same))
    # a bitmap of hashed ids spares most documents the way through the shuffle; the join then is exact
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
    # bucket k holds the numbers from (k - 1) * 32768 + 1 on, so numbers are counted from 1
    parts = needed.groupBy(F.bitmap_bucket_number(mark + 1).alias("k")) \
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position(mark + 1)).alias("b"))
    for k, b in parts.collect():
        bitmap[(k - 1) * 4096:k * 4096] = np.frombuffer(b, np.uint8)
    bits = spark.sparkContext.broadcast(bitmap)
    found = base.filter("doc_id is not null").withColumn("mark", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))) \
                .mapInArrow(_sets(shingle, bits), "doc_id long, n_shingles long, fa long, fb long, s binary")
    # rows that share id and set are alike, so which of them stays does not matter
    sets = cut_lineage(found.join(needed, ["doc_id", *same]).select("c", "s").dropDuplicates(["c"]))
    release(needed)
    gather(spark)
    sigs = cut_lineage(reps.join(wanted, "c", "left_semi").select("c", "sig", "n_shingles"))
    # the sketches of a pair at similarity p agree in SKETCH * p places on average; 3.9 standard deviations below are let through
    n, p = SKETCH, percent / 100
    least = max(1, int(n * p - 3.9 * (n * p * (1 - p)) ** 0.5))

    def confirmed(pairs: DataFrame) -> DataFrame:
        return cut_lineage(
            pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("x")), "a")
                 .join(sets.select(F.col("c").alias("b"), F.col("s").alias("y")), "b")
                 .select("a", "b", "x", "y").mapInArrow(_confirm(percent), "src long, dst long"))

    def components(links: DataFrame) -> DataFrame:
        ends = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        return cut_lineage(connected_components(ends, links).select(F.col("id").alias("c"), F.col("component").alias("comp")))

    # one pivot a node
    pivots = nodes.groupBy("node").agg(F.min(F.struct(F.xxhash64("node", "c").alias("h"), "c")).alias("m"))
    stars = nodes.join(pivots.select("node", F.col("m.c").alias("p")), "node").filter("c <> p") \
                 .select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()
    stars = stars.join(sigs.select(F.col("c").alias("a"), F.col("sig").alias("x")), "a") \
                 .join(sigs.select(F.col("c").alias("b"), F.col("sig").alias("y")), "b") \
                 .select("a", "b", "x", "y").mapInArrow(_alike(least), "a long, b long")
    starred = confirmed(stars)
    links = cut_lineage(starred.unionByName(tied))
    release(starred)
    comp = components(links)
    gather(spark)
    # the rest of every node that spans several components, in cells; blocks are bounded in members and in bytes of sets
    member = cut_lineage(nodes.join(comp, "c", "left").join(sigs.select("c", "n_shingles"), "c")
                         .select("node", "c", F.coalesce("comp", "c").alias("comp"), "n_shingles"))
    mixed = member.groupBy("node").agg(F.count(F.lit(1)).alias("m"), (8 * F.sum("n_shingles")).alias("w"),
                                       F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
                  .filter("lo <> hi").select("node", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("w") / BLOCK_BYTES)).alias("n"))
    cells = member.join(mixed, "node").withColumn("i", F.pmod(F.xxhash64("c"), F.col("n"))) \
                  .withColumn("j", F.explode(F.expr("sequence(0L, n - 1)"))) \
                  .withColumn("cell", F.xxhash64("node", F.least("i", "j"), F.greatest("i", "j"))) \
                  .join(sigs.select("c", "sig"), "c").select("cell", "c", "comp", "i", "sig")
    live = cut_lineage(cells.repartition("cell").sortWithinPartitions("cell")
                            .mapInArrow(_partners(least), "cell long, c long, comp long, i long, sig binary"))
    release(member)
    more = cut_lineage(live.join(sets, "c").select("cell", "c", "comp", "i", "sig", "s")
                           .repartition("cell").sortWithinPartitions("cell")
                           .mapInArrow(_cell_links(least, percent), "src long, dst long").distinct())
    release(live)
    if more.limit(1).count():
        found_all = cut_lineage(links.unionByName(more))
        release(links)
        release(comp)
        links = found_all
        comp = components(links)
    release(more)
    gather(spark)
    out = of.join(comp, "c", "left").groupBy("doc_id").agg(F.min(F.coalesce("comp", "c")).alias("component_id"))
    out = cut_lineage(out.filter("doc_id <> component_id"))
    for t in (nodes, sets, sigs, links, comp, reps, of):
        release(t)
    return (sketch.select("doc_id", "n_shingles").join(out, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.col("component_id").isNull().alias("kept")))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that a smaller doc_id of their group stands for (pipeline stage)."""
    gone = near_duplicates(docs, shingle, percent).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    # all columns of the documents travel in one struct, so none can clash with the operator's own
    rows = docs.select(F.struct("*").alias("_row"))
    return rows.join(gone, F.col("_row.doc_id").cast("long") == F.col("_gone"), "left_anti").select("_row.*")


def op10_near_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)


ORACLE_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, case when len(ws) < 4 then array_to_string(ws, ' ')
                              else concat_ws(' ', ws[i], ws[i + 1], ws[i + 2], ws[i + 3]) end as g
      from w, unnest(range(1, greatest(len(ws) - 2, 2))) u(i) where len(ws) > 0),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as i from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 80 * (x.n + y.n - i)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as v, doc_id as c from n union select e.b, r.c from r join e on e.a = r.v),
k as (select v, min(c) as c from r group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(k.c, d.doc_id) as component_id,
       d.doc_id = coalesce(k.c, d.doc_id) as kept
from documents d left join n on n.doc_id = d.doc_id left join k on k.v = d.doc_id"""
