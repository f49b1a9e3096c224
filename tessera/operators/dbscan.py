"""Density clustering of 2-D points.

Points live on a grid of side eps/sqrt(2): any two points of one cell are
within eps, so a cell holding >= minPoints points makes all its points core
without a distance computed, and all cores of a cell belong to one cluster.
Everything else is decided between a cell and its 5x5 neighbourhood through
:func:`blocks.chunked_cogroup` (bounded groups, no pair rows emitted):

1. neighbour counts for points of sparse cells -> core flags;
2. one link per pair of neighbouring core cells that hold two cores within eps;
3. connected components over core cells -> clusters (id = smallest core id);
4. every non-core point joins the cluster of its nearest core within eps
   (ties -> smallest cluster), otherwise it is noise.

Semantics kept from the reference: a point counts itself, distances are
Euclidean on (x, y), bounds are closed (<= eps).  Mended: every input row
appears exactly once; a border point never stays noise; noise has a null
cluster.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import GROUP_ROWS, chunk_count, chunked_cogroup
from .graph import connected_components
from .ordered import running_totals
from .stats import grid_cell_counts
from ..session import cut_lineage, release

def _pack(cx, cy):
    """One exact key of a cell or tile, whatever the size of its numbers."""
    return F.concat_ws(":", cx, cy)


def side_of(eps: float) -> float:
    return eps / math.sqrt(2.0) * (1.0 - 1e-12)


def _grid(points: DataFrame, eps: float, x: str, y: str, id_col: str) -> DataFrame:
    side = side_of(eps)
    return points.select(F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"),
                         F.col(y).cast("double").alias("y")) \
        .withColumn("cx", F.floor(F.col("x") / side).cast("bigint")) \
        .withColumn("cy", F.floor(F.col("y") / side).cast("bigint")) \
        .withColumn("cell", _pack(F.col("cx"), F.col("cy")))


def _tile_of(c, tile: int):
    return F.floor(F.col(c) / F.lit(tile)).cast("bigint")


def _candidates(df: DataFrame, tile: int) -> DataFrame:
    """Candidate side: every point keyed by the tile (tile x tile cells) holding its cell."""
    return df.withColumn("key", _pack(_tile_of("cx", tile), _tile_of("cy", tile)))


def _route(df: DataFrame, tile: int) -> DataFrame:
    """Query side: one row per tile touched by the point's 5x5 cell neighbourhood
    (at most 4 tiles when tile >= 4), so each (point, candidate) pair meets once."""
    lo_x = F.floor((F.col("cx") - 2) / F.lit(tile)).cast("bigint")
    hi_x = F.floor((F.col("cx") + 2) / F.lit(tile)).cast("bigint")
    lo_y = F.floor((F.col("cy") - 2) / F.lit(tile)).cast("bigint")
    hi_y = F.floor((F.col("cy") + 2) / F.lit(tile)).cast("bigint")
    return (df.withColumn("_tx", F.explode(F.sequence(lo_x, hi_x)))
              .withColumn("_ty", F.explode(F.sequence(lo_y, hi_y)))
              .withColumn("key", _pack(F.col("_tx"), F.col("_ty"))).drop("_tx", "_ty"))


_SUB = 4  # sub-cells per cell side used to certify links without point pairs


def _certain_table(spark, eps: float, side: float) -> DataFrame:
    """Fixed table (24 offsets x 16 sub-cells = 384 rows): for cell offset
    (dx, dy) and sub-cell i of the lower cell, the mask of sub-cells j of the
    other cell whose farthest corners are within eps -- any occupied such
    pair links the two cells for certain."""
    sub = side / _SUB
    rows = []
    for dx in range(-2, 3):
        for dy in range(-2, 3):
            if dx == 0 and dy == 0:
                continue
            for ia in range(_SUB):
                for ja in range(_SUB):
                    mask = 0
                    for ib in range(_SUB):
                        for jb in range(_SUB):
                            mx = max(abs(_SUB * dx + ib + 1 - ia), abs(_SUB * dx + ib - ia - 1))
                            my = max(abs(_SUB * dy + jb + 1 - ja), abs(_SUB * dy + jb - ja - 1))
                            if sub * math.sqrt(mx * mx + my * my) <= eps * (1 - 1e-9):
                                mask |= 1 << (ib * _SUB + jb)
                    rows.append((dx, dy, ia * _SUB + ja, mask))
    return spark.createDataFrame(rows, "dx long, dy long, i int, jmask long")


def _core_cell_links(core: DataFrame, eps: float, side: float, block_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs (src < dst) of neighbouring core cells holding two cores within eps.

    Stage 1 settles most pairs from sub-cell occupancy masks alone (a bitwise
    test per pair).  For the open rest, stage 2 reduces either cell to the few
    points that can reach the other (:func:`front_of`), in work linear in the
    cell's size, and compares only those; a link exists exactly if two of them
    are within eps.  Returns the links and the written tables they come from.
    """
    spark = core.sparkSession
    subi = F.least(F.lit(_SUB - 1), F.greatest(F.lit(0), F.floor((F.col("x") / side - F.col("cx")) * _SUB))).cast("int")
    subj = F.least(F.lit(_SUB - 1), F.greatest(F.lit(0), F.floor((F.col("y") / side - F.col("cy")) * _SUB))).cast("int")
    occ = core.groupBy("cell", "cx", "cy").agg(
        F.bit_or(F.pow(F.lit(2.0), subi * _SUB + subj).cast("long")).alias("mask"))
    offs = F.explode(F.array(*[F.struct(F.lit(dx).cast("long").alias("dx"), F.lit(dy).cast("long").alias("dy"))
                               for dx in range(-2, 3) for dy in range(-2, 3) if (dx, dy) != (0, 0)]))
    other = occ.select(F.col("cell").alias("dst"), F.col("mask").alias("mask_b"))
    pairs = (occ.select(F.col("cell").alias("src"), "cx", "cy", F.col("mask").alias("mask_a"), offs.alias("o"))
             .select("src", "mask_a", F.col("o.dx").alias("dx"), F.col("o.dy").alias("dy"),
                     _pack(F.col("cx") + F.col("o.dx"), F.col("cy") + F.col("o.dy")).alias("dst"))
             .filter(F.col("dst") > F.col("src"))
             .join(other, "dst"))
    bits = F.expr(f"filter(sequence(0, {_SUB * _SUB - 1}), b -> (shiftright(mask_a, b) & 1) = 1)")
    table = F.broadcast(_certain_table(spark, eps, side))  # fixed 384 rows
    certain = (pairs.select("src", "dst", "dx", "dy", "mask_b", F.explode(bits).alias("i"))
               .join(table, ["dx", "dy", "i"])
               .filter(F.col("mask_b").bitwiseAND(F.col("jmask")) != 0)
               .select("src", "dst").distinct())
    certain = cut_lineage(certain)
    open_pairs = cut_lineage(pairs.select("src", "dst", "dx", "dy").join(certain, ["src", "dst"], "left_anti"))
    # two cells lie on either side of a line: the side each must show the other
    a_side = F.when(F.col("dx") > 0, "right").when(F.col("dx") < 0, "left").when(F.col("dy") > 0, "up").otherwise("down")
    b_side = F.when(F.col("dx") > 0, "left").when(F.col("dx") < 0, "right").when(F.col("dy") > 0, "down").otherwise("up")
    sided = open_pairs.select("src", "dst", a_side.alias("a_side"), b_side.alias("b_side"))
    sides = sided.select(F.col("src").alias("cell"), F.col("a_side").alias("side")) \
        .unionByName(sided.select(F.col("dst").alias("cell"), F.col("b_side").alias("side"))).distinct()
    front = _fronts(core.select("cell", "cx", "cy", "id", "x", "y").join(sides, "cell"), eps, block_rows)
    q = sided.join(front.select(F.col("cell").alias("src"), F.col("side").alias("a_side"), "cx", "cy", "id", "x", "y"), ["src", "a_side"])
    c = sided.join(front.select(F.col("cell").alias("dst"), F.col("side").alias("b_side"), "id", "x", "y"), ["dst", "b_side"]) \
        .join(occ.select(F.col("cell").alias("src"), "cx", "cy"), "src")
    near = cut_lineage(_closest(q, c, block_rows).groupBy("src", "dst").agg(F.min("d").alias("d")))
    links = certain.unionByName(near.filter(F.col("d") <= eps).select("src", "dst"))
    # a closest distance within rounding of eps is decided by all points
    doubt = near.filter((F.col("d") > eps) & (F.col("d") <= eps * (1 + 1e-9))).select("src", "dst")
    if doubt.limit(1).count():
        pts = core.select("cell", "cx", "cy", "id", "x", "y")
        q = doubt.join(pts.withColumnRenamed("cell", "src"), "src")
        c = doubt.join(pts.select(F.col("cell").alias("dst"), "id", "x", "y"), "dst").join(occ.select(F.col("cell").alias("src"), "cx", "cy"), "src")
        links = links.unionByName(_closest(q, c, block_rows).filter(F.col("d") <= eps).select("src", "dst").distinct())
    return links, [certain, open_pairs, front, near]


FEW = 64  # points of a cell that are compared as they are
_TURN = {"right": lambda x, y: (x, y), "left": lambda x, y: (-x, y), "up": lambda x, y: (y, x), "down": lambda x, y: (-y, x)}


def front_of(x: np.ndarray, y: np.ndarray, eps: float) -> list[int]:
    """The points whose eps-circle reaches furthest to the right at some height.

    A point to the right of all of them is within eps of one of them exactly
    if it is within eps of one of these.  Right halves of circles of one
    radius cross at most once, the lower centre being ahead below the crossing,
    so one pass over the centres by height keeps them on a stack.  All heights
    are less than eps apart (one cell).
    """
    x, y = x - x.min(), y - y.min()
    order = np.lexsort((-x, y))
    keep: list[int] = []
    cross: list[float] = []      # cross[i]: height from which keep[i] is ahead of keep[i - 1]
    xs, ys = x.tolist(), y.tolist()
    for i in order.tolist():
        xi, yi = xs[i], ys[i]
        if keep and ys[keep[-1]] == yi:
            continue             # same height, further left
        at = -math.inf
        while keep:
            t = keep[-1]
            dx, dy = xi - xs[t], yi - ys[t]
            s = math.hypot(dx, dy)
            h = math.sqrt(max(eps * eps - s * s / 4, 0.0))
            cut_x = (xi + xs[t]) / 2 + h * dy / s
            if cut_x < xi:
                at = yi - eps    # ahead wherever both are
            elif cut_x < xs[t]:
                at = ys[t] + eps  # behind wherever both are
            else:
                at = (yi + ys[t]) / 2 - h * dx / s
            if len(keep) > 1 and at <= cross[-1]:
                keep.pop()
                cross.pop()
            else:
                break
        keep.append(i)
        cross.append(at if len(keep) > 1 else -math.inf)
    return keep


def _fronts(points: DataFrame, eps: float, block_rows: int) -> DataFrame:
    """For each (cell, side) the points of :func:`front_of`, written.

    Cells are cut into chunks (:func:`blocks.chunk_count`) whose fronts are taken
    side by side; the fronts of the fronts follow until a cell's fit one chunk or
    no longer shrink, so a cell with any share of the points is many small tasks.
    """
    keys = ["cell", "side"]

    def run(pdf):
        turn = _TURN[pdf["side"].iat[0]]
        return pdf.iloc[front_of(*turn(pdf["x"].to_numpy(), pdf["y"].to_numpy()), eps)]

    now, rows, turn = cut_lineage(points.select("cell", "side", "cx", "cy", "id", "x", "y")), None, 0
    columns = now.columns
    while True:
        plan = now.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("chunks", chunk_count(F.col("n"), block_rows))
        size = plan.agg(F.max("n").alias("most"), F.max("chunks").alias("chunks"), F.sum("n").alias("n")).first()
        if size["n"] is None or size["most"] <= FEW or rows is not None and size["n"] > 0.9 * rows:
            return now
        rows, turn = size["n"], turn + 1
        planned = now.join(plan, keys)
        chunked = planned.filter(F.col("n") > FEW).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(turn)), F.col("chunks")).cast("int"))
        chunked = chunked.select(*columns, "chunk")
        fronts = chunked.groupBy(*keys, "chunk").applyInPandas(run, chunked.schema).select(*columns)
        nxt = cut_lineage(planned.filter(F.col("n") <= FEW).select(*columns).unionByName(fronts))
        release(now)
        now = nxt
        if size["chunks"] == 1:  # every cell was one chunk: its front is final
            return now


_COMPARED = 1 << 20   # distances of a group computed at a time


def _closest(q: DataFrame, c: DataFrame, block_rows: int) -> DataFrame:
    """Smallest distance between the points of each pair (src, dst), per crossing of two chunks of a pair.

    Only points of one pair meet: either side of a pair is cut into chunks (:func:`blocks.chunk_count`), and the
    crossings of its chunks, mostly one, are dealt whole into groups of about ``max(block_rows, GROUP_ROWS)`` rows a side.
    """
    pair = ["src", "dst"]
    plan = (q.groupBy(*pair).agg(F.count(F.lit(1)).alias("nl")).join(c.groupBy(*pair).agg(F.count(F.lit(1)).alias("nr")), pair)
             .withColumn("lch", chunk_count(F.col("nl"), block_rows)).withColumn("rch", chunk_count(F.col("nr"), block_rows)))
    rows = plan.agg(F.sum(F.col("nl") * F.col("rch")), F.sum(F.col("nr") * F.col("lch"))).first()
    groups = max(1, -(-max(rows[0] or 0, rows[1] or 0) // max(block_rows, GROUP_ROWS)))

    def dealt(df, own, other, seed):
        chunk = F.pmod(F.xxhash64("id", F.lit(seed)), F.col(f"{own}ch")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}ch") - 1))
        return df.select(*pair, "id", "x", "y").join(plan, pair).withColumn(own, chunk).withColumn(other, every) \
            .select(F.pmod(F.xxhash64(*pair, "l", "r"), F.lit(groups)).alias("key"), *pair, "l", "r", "x", "y")

    def run(lpdf, rpdf):
        lp, rp = (pd.MultiIndex.from_frame(p[["src", "dst", "l", "r"]]) for p in (lpdf, rpdf))
        codes, names = pd.factorize(lp.append(rp))
        (lat, lstart, ln), (rat, rstart, rn) = (_by_code(x, len(names)) for x in (codes[:len(lpdf)], codes[len(lpdf):]))
        lx, ly, rx, ry = lpdf["x"].to_numpy()[lat], lpdf["y"].to_numpy()[lat], rpdf["x"].to_numpy()[rat], rpdf["y"].to_numpy()[rat]
        least = np.full(len(names), np.inf)
        of = np.repeat(np.arange(len(names)), ln)                 # crossing of each left row, ascending
        ends = np.cumsum(rn[of])
        a = 0
        while a < len(of):                                        # left rows whose distances fit _COMPARED, one at least
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _COMPARED, "right")))
            n = rn[of[a:b]]
            left = np.repeat(np.arange(a, b), n)
            right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(rstart[of[a:b]], n)
            dx, dy = lx[left] - rx[right], ly[left] - ry[right]
            np.minimum.at(least, of[left], np.sqrt(dx * dx + dy * dy))
            a = b
        found = np.flatnonzero(np.isfinite(least))
        # a group in which no crossing has both sides gives an empty frame, whose keys must still be text for Arrow
        src, dst = (np.array([names[i][j] for i in found], dtype=object) for j in (0, 1))
        return pd.DataFrame({"src": src, "dst": dst, "d": least[found]})

    schema = T.StructType([T.StructField("src", T.StringType()), T.StructField("dst", T.StringType()), T.StructField("d", T.DoubleType())])
    # fresh attribute ids: both sides derive from one table
    L, R = (x.select(*[F.col(n).alias(n) for n in x.columns]) for x in (dealt(q, "l", "r", 11), dealt(c, "r", "l", 12)))
    return L.groupBy("key").cogroup(R.groupBy("key")).applyInPandas(run, schema)


def _by_code(codes, n):
    """Rows in order of their code, and where each code's rows begin and how many they are."""
    size = np.bincount(codes, minlength=n)
    return np.argsort(codes, kind="stable"), np.cumsum(size) - size, size


def _d(lpdf, rpdf):
    lx, ly = lpdf["x"].to_numpy()[:, None], lpdf["y"].to_numpy()[:, None]
    rx, ry = rpdf["x"].to_numpy()[None, :], rpdf["y"].to_numpy()[None, :]
    dx, dy = lx - rx, ly - ry
    return np.sqrt(dx * dx + dy * dy)


def dbscan(points: DataFrame, eps: float, min_points: int, *, x: str = "x", y: str = "y",
           id_col: str = "id", block_rows: int = 2048, tile: int = 8) -> DataFrame:
    """``id, x, y, flag ('core' | 'border' | 'noise'), cluster`` for every point."""
    g = _grid(points, eps, x, y, id_col)
    cells = g.groupBy("cell").agg(F.count(F.lit(1)).alias("n_cell"))
    g = cut_lineage(g.join(cells, "cell"))
    dense = g.filter(F.col("n_cell") >= min_points)
    sparse = g.filter(F.col("n_cell") < min_points)

    # 1. neighbour counts for points of sparse cells
    def count_fn(lpdf, rpdf):
        within = _d(lpdf, rpdf) <= eps
        return pd.DataFrame({"id": lpdf["id"].to_numpy(), "n": within.sum(1).astype(np.int64)})

    cnt_schema = T.StructType([T.StructField("id", g.schema["id"].dataType), T.StructField("n", T.LongType())])
    cand = _candidates(g, tile).select("key", "id", "x", "y")
    partial = chunked_cogroup(_route(sparse.select("id", "x", "y", "cx", "cy"), tile).select("key", "id", "x", "y"),
                              cand, "key", count_fn, cnt_schema, "id", "id", block_rows)
    sparse_core = partial.groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_points).select("id")
    core = cut_lineage(dense.select("id", "x", "y", "cx", "cy", "cell").unionByName(
        sparse.join(sparse_core, "id", "left_semi").select("id", "x", "y", "cx", "cy", "cell")))

    # 2. links between neighbouring core cells (exact, no quadratic step for crowded cells)
    links, steps = _core_cell_links(core, eps, side_of(eps), block_rows)

    # 3. clusters = components of the core-cell graph; id = smallest core id
    core_cells = core.select(F.col("cell").alias("id")).distinct()
    comp = connected_components(core_cells, links).select(F.col("id").alias("cell"), "component")
    labelled = core.join(comp, "cell")
    cluster_of = labelled.groupBy("component").agg(F.min("id").alias("cluster"))
    core_l = cut_lineage(labelled.join(cluster_of, "component")
                         .select("id", "x", "y", "cx", "cy", "cell", "cluster"))

    # 4. borders: nearest core within eps, ties -> smallest cluster
    def border_fn(lpdf, rpdf):
        d = _d(lpdf, rpdf)
        cl = rpdf["cluster"].to_numpy()
        key_d = np.where(d <= eps, np.round(d, 9), np.inf)
        order = np.lexsort((np.broadcast_to(cl, d.shape), key_d), axis=1)[:, 0]
        best = key_d[np.arange(len(lpdf)), order]
        ok = np.isfinite(best)
        return pd.DataFrame({"id": lpdf["id"].to_numpy()[ok], "d": best[ok], "cluster": cl[order][ok]})

    b_schema = T.StructType([T.StructField("id", g.schema["id"].dataType), T.StructField("d", T.DoubleType()),
                             T.StructField("cluster", core_l.schema["cluster"].dataType)])
    non_core = g.select("id", "x", "y", "cx", "cy", "cell").join(core.select("id"), "id", "left_anti")
    bc = chunked_cogroup(_route(non_core, tile).select("key", "id", "x", "y"),
                         _candidates(core_l, tile).select("key", "id", "x", "y", "cluster"),
                         "key", border_fn, b_schema, "id", "id", block_rows)
    border = bc.groupBy("id").agg(F.min(F.struct("d", "cluster")).alias("m")).select("id", F.col("m.cluster").alias("cluster"))

    out = g.select("id", "x", "y") \
        .join(core_l.select("id", F.col("cluster").alias("core_cluster")), "id", "left") \
        .join(border.select("id", F.col("cluster").alias("border_cluster")), "id", "left")
    flag = F.when(F.col("core_cluster").isNotNull(), "core").when(F.col("border_cluster").isNotNull(), "border") \
            .otherwise("noise")
    out = cut_lineage(out.select("id", "x", "y", flag.alias("flag"), F.coalesce("core_cluster", "border_cluster").alias("cluster")))
    for t in (g, core, core_l, *steps):
        release(t)
    return out


def neighbour_counts(points: DataFrame, eps: float, *, x: str = "x", y: str = "y", id_col: str = "id", tile: int = 8,
                     block_rows: int = 2048) -> DataFrame:
    """``id, neighbours``: points within eps of each point, itself included."""
    g = _grid(points, eps, x, y, id_col)

    def count_fn(lpdf, rpdf):
        return pd.DataFrame({"id": lpdf["id"].to_numpy(), "n": (_d(lpdf, rpdf) <= eps).sum(1).astype(np.int64)})

    schema = T.StructType([T.StructField("id", g.schema["id"].dataType), T.StructField("n", T.LongType())])
    part = chunked_cogroup(_route(g, tile).select("key", "id", "x", "y"), _candidates(g, tile).select("key", "id", "x", "y"),
                           "key", count_fn, schema, "id", "id", block_rows)
    return part.groupBy("id").agg(F.sum("n").alias("neighbours"))


def dbscan_flags(points: DataFrame, eps: float, min_points: int, **kw) -> DataFrame:
    """Core / border / noise flag per point."""
    return dbscan(points, eps, min_points, **kw).select("id", "flag")


def merge_local_clusters(links: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """D3: local cluster ids linked by shared points -> one global id each
    (smallest local id of the component).  ``links(src, dst)`` are pairs of
    local cluster ids; ``members(id)`` optionally lists all local ids."""
    ids = links.select(F.col("src").alias("id")).unionByName(links.select(F.col("dst").alias("id")))
    if members is not None:
        ids = ids.unionByName(members.select("id"))
    return connected_components(ids.distinct(), links).select(
        F.col("id").alias("local_id"), F.col("component").alias("global_id"))


def cell_clusters(points: DataFrame, eps: float, min_points: int, **kw) -> DataFrame:
    """D3 as used by D1: cluster of every grid cell (side eps/sqrt 2) holding a core."""
    side = eps / math.sqrt(2.0) * (1.0 - 1e-12)
    d = dbscan(points, eps, min_points, **kw).filter(F.col("flag") == "core")
    return d.select(F.floor(F.col("x") / side).cast("bigint").alias("cx"),
                    F.floor(F.col("y") / side).cast("bigint").alias("cy"), "cluster").distinct()


# D4 ---------------------------------------------------------------------------
def even_split(points: DataFrame, eps: float, max_points: int, *, x: str = "x", y: str = "y", with_cells: bool = False):
    """Count-balanced rectangles over cells of side 2*eps.

    Start from the bounding box of occupied cells; while a rectangle holds
    more than ``max_points`` points and is wider or taller than 2 cells,
    cut it on the cell line whose lower part is closest to half its count
    (ties: x lines before y lines, lower line first).  Empty rectangles are
    dropped.  Cell counts and region labels stay DataFrames; the counts below
    all lines of a level come from one distributed running sum.  Output in coordinates:
    ``region, x1, y1, x2, y2, n``; with ``with_cells`` also the cells (``cx, cy, n, region``).
    """
    size = 2.0 * eps
    cells = grid_cell_counts(points, size, x, y).withColumn("region", F.lit("r"))
    bbox = cells.agg(F.min("cx").alias("x1"), F.min("cy").alias("y1"),
                     (F.max("cx") + 1).alias("x2"), (F.max("cy") + 1).alias("y2"), F.sum("n").alias("n"))
    regions = bbox.select(F.lit("r").alias("region"), "x1", "y1", "x2", "y2", "n")
    regions = cut_lineage(regions)
    cells = cut_lineage(cells)
    while True:
        active = regions.filter((F.col("n") > max_points) &
                                (((F.col("x2") - F.col("x1")) > 2) | ((F.col("y2") - F.col("y1")) > 2)))
        if active.limit(1).count() == 0:
            break
        cand = []
        for axis, lo, hi, c in (("x", "x1", "x2", "cx"), ("y", "y1", "y2", "cy")):
            per_line = cells.join(active.select("region", lo), "region").groupBy("region", F.col(c).alias("line"), lo).agg(F.sum("n").alias("line_n"))
            # a line at the lower border counts too, so that a cut right above it is considered
            per_line = per_line.select("region", "line", "line_n").unionByName(
                active.select("region", F.col(lo).alias("line"), F.lit(0).cast("bigint").alias("line_n"))) \
                .groupBy("region", "line").agg(F.sum("line_n").alias("line_n"))
            # one running sum over all regions, line after line; a region's own sum starts at its first line
            total = running_totals(per_line, [F.col("region").asc(), F.col("line").asc()], ["line_n"])
            start = total.groupBy("region").agg(F.min(F.col("line_n_cum") - F.col("line_n")).alias("start"))
            below = total.join(start, "region").select("region", (F.col("line") + 1).alias("line"), (F.col("line_n_cum") - F.col("start")).alias("below"))
            cand.append(below.join(active.select("region", hi, "n"), "region").filter(F.col("line") < F.col(hi))
                        .select("region", F.abs(F.floor(F.col("n") / 2) - F.col("below")).alias("cost"),
                                F.lit(0 if axis == "x" else 1).alias("axis"), "line"))
        best = cand[0].unionByName(cand[1]).groupBy("region").agg(F.min(F.struct("cost", "axis", "line")).alias("b")) \
            .select("region", "b.axis", "b.line")
        # relabel cells of split regions and rebuild region rectangles
        cj = cells.join(best, "region", "left")
        side_lo = F.when(F.col("axis") == 0, F.col("cx") < F.col("line")).otherwise(F.col("cy") < F.col("line"))
        old_cells, cells = cells, cut_lineage(cj.withColumn("region", F.when(F.col("line").isNull(), F.col("region"))
                                          .otherwise(F.concat("region", F.when(side_lo, F.lit("0")).otherwise(F.lit("1")))))
                            .drop("axis", "line"))
        rj = regions.join(best, "region", "left")
        keep = rj.filter(F.col("line").isNull()).select("region", "x1", "y1", "x2", "y2", "n")
        sp = rj.filter(F.col("line").isNotNull())
        lo_part = sp.select(F.concat("region", F.lit("0")).alias("region"), "x1", "y1",
                            F.when(F.col("axis") == 0, F.col("line")).otherwise(F.col("x2")).alias("x2"),
                            F.when(F.col("axis") == 1, F.col("line")).otherwise(F.col("y2")).alias("y2"))
        hi_part = sp.select(F.concat("region", F.lit("1")).alias("region"),
                            F.when(F.col("axis") == 0, F.col("line")).otherwise(F.col("x1")).alias("x1"),
                            F.when(F.col("axis") == 1, F.col("line")).otherwise(F.col("y1")).alias("y1"), "x2", "y2")
        counts = cells.groupBy("region").agg(F.sum("n").alias("n"))
        parts = lo_part.unionByName(hi_part).join(counts, "region", "left").fillna(0, ["n"])
        old_regions, regions = regions, cut_lineage(keep.unionByName(parts))
        release(old_regions)
        release(old_cells)
    out = regions.filter(F.col("n") > 0).select(
        "region", (F.col("x1") * size).alias("x1"), (F.col("y1") * size).alias("y1"),
        (F.col("x2") * size).alias("x2"), (F.col("y2") * size).alias("y2"), F.col("n").cast("long").alias("n"))
    return (out, cells) if with_cells else out
