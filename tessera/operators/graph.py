"""Graph operators on two DataFrames: ``vertices(id, ...)`` and ``edges(src, dst, weight)``
(G1-G8, A7, A10).  Iterations run on the driver as a loop of DataFrame steps,
one counting action per step, lineage cut through the shared checkpoint
folder every step; edges that every step reads are written once, bucketed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import bucketed, cut_lineage, drop_bucketed, release
from .stats import degrees


# G1 ---------------------------------------------------------------------------
def to_undirected(edges: DataFrame, src: str = "src", dst: str = "dst",
                  extra: list[str] | None = None) -> DataFrame:
    """Drop self loops, add the reversed copy of every edge, distinct."""
    extra = extra or []
    e = edges.filter(F.col(src) != F.col(dst))
    fwd = e.select(F.col(src).alias("src"), F.col(dst).alias("dst"), *extra)
    rev = e.select(F.col(dst).alias("src"), F.col(src).alias("dst"), *extra)
    return fwd.unionByName(rev).distinct()


# G2 ---------------------------------------------------------------------------
def canonical_edges(edges: DataFrame, weight: str | None = "weight", src: str = "src",
                    dst: str = "dst") -> DataFrame:
    """(min id, max id) per edge, parallel edges merged with weights summed."""
    a, b = F.least(src, dst), F.greatest(src, dst)
    g = edges.groupBy(a.alias("src"), b.alias("dst"))
    if weight:
        return g.agg(F.sum(weight).alias("weight"))
    return g.agg(F.count(F.lit(1)).alias("weight"))


def _both_ways(edges: DataFrame, weight: str | None = None) -> DataFrame:
    w = [F.col(weight).alias("weight")] if weight else []
    return edges.select("src", "dst", *w).unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *w))


# A7 ---------------------------------------------------------------------------
def min_incoming(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """Per destination, the smallest incoming weight and the smallest source
    achieving it: ``min(struct(weight, src))``."""
    m = edges.groupBy("dst").agg(F.min(F.struct(F.col(weight).alias("w"), F.col("src").alias("s"))).alias("m"))
    return m.select(F.col("dst").alias("id"), F.col("m.w").alias("min_weight"), F.col("m.s").alias("from_id"))


# G3 ---------------------------------------------------------------------------
MERGE_EVERY = 8  # steps after which the improvements so far become one table


def _latest(tables: list[DataFrame]) -> DataFrame:
    """Of all recorded distances of a vertex the one of the last step."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    best = rows.groupBy("id").agg(F.max_by(F.struct("d", "level", "pred"), "step").alias("b"), F.max("step").alias("step"))
    return best.select("id", "b.d", "b.level", "b.pred", "step")


def shortest_paths(vertices: DataFrame, edges: DataFrame, origin, weight: str = "weight",
                   max_iter: int | None = None, merge_every: int = MERGE_EVERY) -> DataFrame:
    """Single-source shortest paths following src -> dst.

    Frontier relaxation: only vertices whose distance improved in the last
    step send candidates.  A step writes the improved vertices alone; what is
    known of the candidates is looked up in the tables of the earlier steps,
    which become one table every ``merge_every`` steps.  The edges are written
    once, bucketed by their source, so no step shuffles them.

    Result ``id, distance, predecessor`` for every vertex; unreachable vertices
    get null distance and predecessor.  Of several predecessors the smallest
    strictly nearer one is kept; one at the same distance (an edge of weight 0)
    only if no nearer one exists, so following predecessors always leads to the
    origin.  A negative weight is an error.
    """
    e = bucketed(edges.select("src", "dst", F.col(weight).alias("w")), "src")
    if e.filter("w < 0").limit(1).count():
        drop_bucketed(e)
        raise ValueError("shortest paths need weights of 0 or more")
    wtype = e.schema["w"].dataType
    # best known distance, whether the predecessor is as far, predecessor, step of the improvement
    frontier = cut_lineage(vertices.filter(F.col("id") == F.lit(origin)).select(
        "id", F.lit(0).cast(wtype).alias("d"), F.lit(False).alias("level"), F.lit(None).cast("long").alias("pred"), F.lit(0).alias("step")))
    base, recent, step = None, [frontier], 0
    while max_iter is None or step < max_iter:
        step += 1
        cand = (frontier.select("id", "d").join(e, F.col("id") == F.col("src"))
                .groupBy(F.col("dst").alias("id"))
                .agg(F.min(F.struct((F.col("d") + F.col("w")).alias("d"), (F.col("w") == 0).alias("level"),
                                    F.col("src").alias("pred"))).alias("c")))
        now = F.struct("d", "level", "pred")
        looked = cand.join(_latest(recent).select("id", now.alias("r")), "id", "left")
        if base is not None:
            looked = looked.join(base.select("id", now.alias("b")), "id", "left")
        k = F.coalesce("r", "b") if base is not None else F.col("r")
        better = k.isNull() | (F.col("c.d") < k["d"]) | (
            (F.col("c.d") == k["d"]) & k["pred"].isNotNull() & ~F.col("c.level") & (k["level"] | (F.col("c.pred") < k["pred"])))
        frontier = cut_lineage(looked.filter(better).select("id", "c.*", F.lit(step).alias("step")))
        if frontier.limit(1).count() == 0:
            release(frontier)
            break
        recent.append(frontier)
        if len(recent) > merge_every:
            merged = bucketed(_latest([*recent, base] if base is not None else recent), "id")
            if base is not None:
                drop_bucketed(base)
            for t in recent[:-1]:
                release(t)
            base, recent = merged, [frontier]   # the frontier's rows stand in both, alike
    drop_bucketed(e)
    best = cut_lineage(_latest([*recent, base] if base is not None else recent))
    for t in recent:
        release(t)
    if base is not None:
        drop_bucketed(base)
    return (vertices.select("id").join(best.select("id", "d", "pred"), "id", "left")
            .select("id", F.col("d").alias("distance"), F.col("pred").alias("predecessor")))


# G4 ---------------------------------------------------------------------------
def label_propagation(vertices: DataFrame, edges: DataFrame, steps: int) -> DataFrame:
    """Each step every vertex takes the most frequent label among its
    neighbours (messages along both directions of every edge); ties go to
    the smallest label; a vertex without neighbours keeps its label."""
    labels = vertices.select("id", F.col("id").alias("label"))
    # written once: the steps read the edges, not the plan that makes them
    both = bucketed(_both_ways(edges.select("src", "dst")), "src")
    for _ in range(steps):
        msgs = both.join(labels.select(F.col("id").alias("src"), "label"), "src") \
                   .groupBy(F.col("dst").alias("id"), "label").agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy("id").orderBy(F.col("n").desc(), F.col("label").asc())
        top = msgs.withColumn("r", F.row_number().over(w)).filter("r = 1").select("id", F.col("label").alias("nl"))
        prev = labels
        labels = cut_lineage(labels.join(top, "id", "left")
                             .select("id", F.coalesce("nl", "label").alias("label")))
        release(prev)
    drop_bucketed(both)
    return labels


# G5 ---------------------------------------------------------------------------
def triangles(edges: DataFrame) -> DataFrame:
    """Triangles through each vertex (undirected, duplicates and loops ignored).

    Edges are oriented from the lower-degree end to the higher-degree end
    (ties by id) so a vertex's out-list is at most sqrt(2m) long even when
    its degree is huge; each triangle is found once at its lowest end.
    """
    canon = canonical_edges(edges.filter(F.col("src") != F.col("dst")), weight=None).select("src", "dst")
    deg = _both_ways(canon).groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("deg"))
    d1 = deg.select(F.col("id").alias("src"), F.col("deg").alias("ds"))
    d2 = deg.select(F.col("id").alias("dst"), F.col("deg").alias("dd"))
    e = canon.join(d1, "src").join(d2, "dst")
    src_first = (F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd")) & (F.col("src") < F.col("dst")))
    oriented = e.select(F.when(src_first, F.col("src")).otherwise(F.col("dst")).alias("u"),
                        F.when(src_first, F.col("dst")).otherwise(F.col("src")).alias("v"))
    o2 = oriented.select(F.col("u"), F.col("v").alias("w"))
    wedges = oriented.join(o2, "u").filter(F.col("v") < F.col("w"))
    closing = canon.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    tri = wedges.join(closing, (F.least("v", "w") == F.col("a")) & (F.greatest("v", "w") == F.col("b"))) \
                .select("u", "v", "w")
    per = tri.select(F.explode(F.array("u", "v", "w")).alias("id")).groupBy("id").agg(
        F.count(F.lit(1)).alias("triangles"))
    return per


def local_clustering(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Triangles / (d(d-1)/2), 0 when d < 2; d = in-degree of the mirrored graph."""
    mirrored = to_undirected(edges)
    deg = degrees(mirrored).select("id", F.col("in_degree").alias("degree"))
    tri = triangles(edges)
    out = vertices.select("id").join(deg, "id", "left").join(tri, "id", "left") \
                  .fillna(0, ["degree", "triangles"])
    pairs = F.col("degree") * (F.col("degree") - 1) / 2
    return out.select("id", F.col("degree").cast("long").alias("degree"),
                      F.col("triangles").cast("long").alias("triangles"),
                      F.when(F.col("degree") < 2, F.lit(0.0)).otherwise(F.col("triangles") / pairs).alias("coefficient"))


def global_clustering(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Sum of triangles over sum of d(d-1)/2; 0 when the denominator is 0."""
    loc = local_clustering(vertices, edges)
    agg = loc.agg(F.sum("triangles").alias("t"), F.sum(F.col("degree") * (F.col("degree") - 1) / 2).alias("p"))
    return agg.select(F.col("t").cast("long").alias("triangles"), F.col("p").cast("long").alias("pairs"),
                      F.coalesce(F.col("t") / F.nullif(F.col("p"), F.lit(0)), F.lit(0.0)).alias("coefficient"))


# G8 ---------------------------------------------------------------------------
def _canon_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return (df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
              .filter(F.col("a") != F.col("b")).distinct())


def _fingerprint(pairs: DataFrame) -> tuple:
    """Row count and order-free hash sum of a pair table, in one pass."""
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Undirected components; component id = smallest vertex id in it.

    Alternates the large-star and small-star rewrites (Kiveris et al., 2014):
    O(log^2 n) rounds, every round a few aggregates and joins, no vertex ever
    gathers its neighbour list.  Runs until a round leaves the edge set as it
    was (same count and hash sum); there is no limit on the rounds.
    """
    cur = cut_lineage(_canon_pairs(edges, "src", "dst"))
    state = _fingerprint(cur)
    while True:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # large star: connect every larger neighbour of u to the minimum of u's closed neighbourhood
        m = both.groupBy("u").agg(F.min("v").alias("mv")).select("u", F.least("u", "mv").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(m, "u").select("v", "m")
        large = _canon_pairs(large, "v", "m")
        # small star: connect u and its smaller neighbours to the minimum among them
        sb = large.select(F.col("b").alias("u"), F.col("a").alias("v"))  # v < u by construction
        sm = sb.groupBy("u").agg(F.min("v").alias("m"))
        small = sb.join(sm, "u").select("v", "m").unionByName(sm.select(F.col("u").alias("v"), "m"))
        nxt = cut_lineage(_canon_pairs(small, "v", "m"))
        release(cur)
        cur, before, state = nxt, state, _fingerprint(nxt)
        if state == before:
            break
    root = cur.select(F.col("b").alias("id"), F.col("a").alias("c")).unionByName(
        cur.select(F.col("a").alias("id"), F.col("a").alias("c"))).groupBy("id").agg(F.min("c").alias("c"))
    return (vertices.select("id").join(root, "id", "left")
            .select("id", F.coalesce("c", "id").alias("component")))
