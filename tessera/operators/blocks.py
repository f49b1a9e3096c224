"""Top-k search between two vector tables.

For every query row, the k best rows of a candidate table under Euclidean
distance (smallest first) or inner product (largest first).  No cross join
and no all-pairs row output:

* A candidate table counted to be small (vectors and carried columns under a
  byte bound) is sent once as a broadcast matrix and every query batch is
  scored with numpy inside ``mapInPandas`` -- no shuffle at all.
* A larger one is dealt into slices below the bound, written once.  Each slice is
  broadcast, and one after the other is merged into each query's running top-k; a
  pass over the queries takes as many slices as the default bound holds.  The
  queries are mapped over, never shuffled, and the candidates are shuffled
  once.  This serves inner products and Euclidean search without pivots.
* Euclidean search with pivots deals the candidates out to their nearest pivot
  and sends a query only to the pivots it cannot rule out; each pivot is cut
  into chunks on both sides (of ``block_rows`` rows, larger ones where a row would
  be copied into many chunks, below the byte bound), scored by a cogrouped
  ``applyInPandas`` that emits at most k rows per query, and a final
  ``row_number() <= k`` (planned as a WindowGroupLimit) merges them.  Where the
  byte bound would have rows copied into many more chunks, the pivots'
  candidates are broadcast in slices as above, and a query meets those of the
  pivots it visits.

Whatever is scored in a task is scored in tiles of bounded size against the
queries' running top-k (:class:`Search`); no matrix of a batch's queries by all
candidates of a broadcast is held.

Pivot routing keeps the result exact: a query visits pivot j only when
``d(q, p_j) - r_j`` (r_j: its largest member distance) and the plane between p_j
and its nearest pivot are no further than an upper bound on the query's k-th
distance (from the pivots' members and from 4,096 candidates).  Both sides are computed from coordinate
differences, so their error is relative to the distances, wherever the data
lie, and the comparison allows for it (:func:`_slack`).  Thousands of pivots
are searched through groups of pivots: a group whose centre is too far for all
its pivots is never looked into.  With a ``tau`` buffer instead, a query visits
only pivots within ``tau`` of its nearest one (approximate search).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import DEFAULT_BROADCAST_BYTES, cut_lineage, release, scratch_path

_ROUND = 9          # ties are broken on score rounded to 9 digits, then by id


def vector_array(df: DataFrame, col: str) -> Column:
    """A features column as array<double>: an array of numbers, or an ml Vector."""
    if df.schema[col].dataType.simpleString() == "vector":
        from pyspark.ml.functions import vector_to_array
        return vector_to_array(F.col(col))
    return F.col(col).cast("array<double>")


def _matrix(series: pd.Series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series.values])


_PAIRS = 1 << 21    # query-candidate pairs scored at a time, whatever the size of either side
_TILE = 2048        # candidates of such a tile, unless one quota block holds more
_PIECE_BYTES = 16 * 1024 * 1024   # candidates read by the driver at a time where slices are smaller


class Search:
    """Running top-k of some queries among some candidates, in memory that does not grow with their product.

    Pairs are looked at in tiles.  One matrix product gives a tile's approximate
    scores; every candidate whose approximate score lies within the product's
    rounding error (and the tie rounding) of the query's k-th so far is scored
    exactly, so the result, ties by id included, is the one of scoring every
    pair exactly.  Euclidean vectors are centred on the tile's mean first, which
    keeps the error small for data far from the origin.

    ``bound`` gives costs (distance, or less the inner product) that k candidates
    elsewhere already reach.  With ``quota`` (block of each candidate, n, total)
    only the best ``ceil(n * block size / total)`` of each block count.
    """

    def __init__(self, Q, qids, Tm, tids, k, metric, exclude_self, max_distance, min_positive, bound=None, quota=None):
        self.Q, self.qids, self.Tm, self.tids = Q, qids, Tm, tids
        self.k, self.l2, self.exclude_self, self.min_positive = k, metric == "l2", exclude_self, min_positive
        self.max_distance = max_distance if self.l2 else None
        self.bound = np.full(len(Q), np.inf) if bound is None else bound
        self.cost = np.full((len(Q), k), np.inf)          # best first
        self.place = np.full((len(Q), k), -1)             # candidate numbers, -1: none
        self.codes = tids if tids.dtype.kind in "iu" else np.unique(tids, return_inverse=True)[1]
        self.quota = quota

    def kth(self) -> np.ndarray:
        """Cost of the k-th best known, infinite where fewer are."""
        return np.minimum(self.cost[:, -1], self.bound)

    def _tiles(self, cols: np.ndarray):
        """Pieces of ``cols`` and, with a quota, the block number and the quota of each candidate."""
        if self.quota is None:
            for a in range(0, len(cols), _TILE):
                yield cols[a:a + _TILE], None, None
            return
        blocks, n, total = self.quota
        cols = cols[np.argsort(blocks[cols], kind="stable")]
        of = blocks[cols]
        edge = np.r_[np.flatnonzero(np.r_[True, of[1:] != of[:-1]]), len(cols)]
        size = np.diff(edge)
        number = np.repeat(np.arange(len(size)), size)
        keep = np.repeat(np.maximum(1, -(-n * size // max(total, 1))), size)
        i = 0
        while i < len(size):
            j = max(i + 1, int(np.searchsorted(edge, edge[i] + _TILE, "right")) - 1)   # whole blocks
            at = slice(edge[i], edge[j])
            yield cols[at], number[at], keep[at]
            i = j

    def look(self, rows: np.ndarray | None = None, cols: np.ndarray | None = None) -> None:
        """Take the candidates ``cols`` into account for the queries ``rows``."""
        rows = np.arange(len(self.Q)) if rows is None else rows
        cols = np.arange(len(self.Tm)) if cols is None else cols
        if not len(rows):
            return
        for at, number, keep in self._tiles(cols):
            T, same = self.Tm[at], 0
            if self.exclude_self:
                same = np.unique(self.codes[at], return_counts=True)[1].max()
            mid = T.mean(0) if self.l2 else None
            step = max(1, _PAIRS // len(at))
            for a in range(0, len(rows), step):
                self._tile(rows[a:a + step], at, T, mid, same, number, keep)

    def _tile(self, rows, at, T, mid, same, number, keep) -> None:
        Q = self.Q[rows]
        unit = 4.0 * (Q.shape[1] + 4) * np.finfo(np.float64).eps
        tie = 2.0 * 10.0 ** -_ROUND
        kth = self.kth()[rows]
        if self.l2:
            q0, t0 = Q - mid, T - mid
            qq, tt = (q0 * q0).sum(1), (t0 * t0).sum(1)
            # centring rounds each coordinate relative to its size before it
            shift = unit * (np.abs(Q).max(initial=0.0) + np.abs(T).max(initial=0.0) + np.abs(mid).max(initial=0.0))
            big = np.sqrt(qq.max()) + np.sqrt(tt.max())
            error = unit * (qq + tt.max()) + 4 * shift * (big + shift) * Q.shape[1]
            approx = np.c_[-2.0 * q0, np.ones(len(q0))] @ np.c_[t0, tt].T    # less qq
            if self.max_distance is not None:
                kth = np.minimum(kth, self.max_distance)
            limit = (kth * (1 + unit) + tie) ** 2 + error - qq
        else:
            error = unit * (np.abs(Q).sum(1) * np.abs(T).max(initial=0.0))
            approx = Q @ T.T
            np.negative(approx, out=approx)
            limit = kth + np.abs(kth) * unit + error + tie
            limit[np.isinf(kth)] = np.inf
        near = approx <= limit[:, None]
        # queries that lack a k-th yet: the tile's own candidates limit each other
        open_ = np.flatnonzero(np.isinf(self.kth()[rows]))
        open_ = open_[near[open_].sum(1) > 4 * self.k + same]
        if len(open_):
            some, err = approx[open_] + (qq[open_][:, None] if self.l2 else 0.0), error[open_][:, None]
            # possible copies of the query do not count towards the k-th when zero distances are left out
            counted = np.where(some <= 2 * err, np.inf, some) if self.l2 and self.min_positive else some
            edge = [0, len(at)] if number is None else np.r_[np.flatnonzero(np.r_[True, number[1:] != number[:-1]]), len(at)]
            for x, y in zip(edge, edge[1:]):
                want = (self.k if keep is None else min(self.k, keep[x])) + same
                if want < y - x:
                    own = np.partition(counted[:, x:y], want - 1, axis=1)[:, want - 1:want]
                    own = (np.sqrt(np.maximum(own + err, 0.0)) + tie) ** 2 + err if self.l2 else own + 2 * err + tie
                    near[open_, x:y] &= some[:, x:y] <= own
        r, c = np.divmod(np.flatnonzero(near), len(at))   # one dimension is several times faster than two
        if self.exclude_self and len(r):
            other = self.qids[rows[r]] != self.tids[at[c]]
            r, c = r[other], c[other]
        val = np.empty(len(r))
        step = max(1, (1 << 20) // max(1, Q.shape[1]))
        for s in range(0, len(r), step):
            x, y = Q[r[s:s + step]], T[c[s:s + step]]
            if self.l2:
                d = x - y
                val[s:s + step] = np.sqrt((d * d).sum(1))
            else:
                val[s:s + step] = (x * y).sum(1)
        ok = np.isfinite(val)
        if self.max_distance is not None:
            ok &= val <= self.max_distance
        if self.l2 and self.min_positive:
            ok &= val > 0.0
        r, c, cost = r[ok], c[ok], (val if self.l2 else -val)[ok]
        if number is not None and len(r):
            order = np.lexsort((self.codes[at[c]], np.round(cost, _ROUND), number[c], r))
            r, c, cost = r[order], c[order], cost[order]
            first = np.r_[True, (r[1:] != r[:-1]) | (number[c][1:] != number[c][:-1])]
            begin = np.flatnonzero(first)
            best = np.arange(len(r)) - np.repeat(begin, np.diff(np.r_[begin, len(r)])) < keep[c]
            r, c, cost = r[best], c[best], cost[best]
        if len(r):
            self._merge(rows[r], at[c], cost)

    def _merge(self, r, place, cost) -> None:
        touched = np.unique(r)
        i, j = np.nonzero(self.place[touched] >= 0)
        old = touched[i]
        r, place, cost = np.r_[old, r], np.r_[self.place[old, j], place], np.r_[self.cost[old, j], cost]
        order = np.lexsort((self.codes[place], np.round(cost, _ROUND), r))
        r, place, cost = r[order], place[order], cost[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r, "left")
        best = rank < self.k
        self.place[touched], self.cost[touched] = -1, np.inf
        self.place[r[best], rank[best]], self.cost[r[best], rank[best]] = place[best], cost[best]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, candidate number, value), by query, best first."""
        r, j = np.nonzero(self.place >= 0)
        cost = self.cost[r, j]
        return r, self.place[r, j], cost if self.l2 else -cost


def _score_block(Q, qids, Tm, tids, **opts):
    """The k best candidates of every query: (query number, candidate number, value)."""
    found = Search(Q, qids, Tm, tids, **opts)
    if len(Q) and len(Tm):
        found.look()
    return found.result()


def _out_schema(qid_type, tid_type, aux_fields, value_name):
    fields = [T.StructField("qid", qid_type), T.StructField("tid", tid_type),
              T.StructField(value_name, T.DoubleType())]
    return T.StructType(fields + list(aux_fields))


def top_k(query: DataFrame, cand: DataFrame, k: int, *, qid: str = "id", tid: str = "id",
          qvec: str = "features", tvec: str = "features", metric: str = "l2",
          aux: list[str] | None = None, exclude_self: bool = False,
          max_distance: float | None = None, min_positive: bool = False,
          pivots: int = 0, tau: float | None = None, block_rows: int = 4096, leaf_rows: int = 0,
          broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, seed: int = 7,
          chunk_by_id: str | None = None, chunk_quota: tuple[int, int] | None = None,
          force_blocked: bool = False) -> DataFrame:
    """Long-form top-k: ``qid, tid, <distance|score>, rank, aux...``.

    ``force_blocked`` skips the single broadcast; ``block_rows`` then bounds a
    slice.  ``leaf_rows`` > 0 cuts a pivot's chunk into leaves of that many
    candidates by their coordinates and their distance to the pivot, of which a
    query looks only into those that can hold one of its k best.  ``chunk_by_id`` / ``chunk_quota`` give the per-block quota mode used
    by approximate recommendation: ``chunk_by_id`` names a column with the block
    number of each candidate, and with quota (n, total) each block keeps
    ``ceil(n * block size / total)`` per query before the final top-k.
    """
    if metric not in ("l2", "dot"):
        raise ValueError("metric must be 'l2' or 'dot'")
    aux = aux or []
    value_name = "distance" if metric == "l2" else "score"
    qfields = {f.name: f.dataType for f in query.schema.fields}
    cfields = {f.name: f for f in cand.schema.fields}
    aux_fields = [T.StructField(f"aux_{a}", cfields[a].dataType) for a in aux]
    schema = _out_schema(qfields[qid], cfields[tid].dataType, aux_fields, value_name)
    q = query.select(F.col(qid).alias("_qid"), vector_array(query, qvec).alias("_qv"))
    c = cand.select(F.col(tid).alias("_tid"), vector_array(cand, tvec).alias("_tv"),
                    *[F.col(a).alias(f"aux_{a}") for a in aux],
                    *([F.col(chunk_by_id).cast("long").alias("_blk")] if chunk_by_id else []))
    opts = dict(k=k, metric=metric, exclude_self=exclude_self, max_distance=max_distance,
                min_positive=min_positive)
    if not force_blocked and not chunk_by_id:
        small = _collect_if_small(c, broadcast_bytes)
        if small is not None:
            # every query row meets all candidates in its own batch: the
            # ranking is final there, no shuffle afterwards
            return _broadcast_path(q, small, schema, aux, opts)
    if metric == "l2" and pivots > 1:
        first = c.select(F.size("_tv").alias("d")).first()
        # no more pivots than the broadcast bound holds; a plan matter only, unless tau limits the visits
        pivots = min(pivots, broadcast_bytes // (8 * max(int(first["d"] or 0), 1))) if first else 0
    if metric == "l2" and pivots > 1:
        long = _routed_path(q, c, schema, aux, opts, pivots, tau, block_rows, leaf_rows, seed, broadcast_bytes)
        return _rank(long, k, metric, value_name)
    return _sliced_path(q, c, schema, aux, opts, broadcast_bytes, block_rows if force_blocked else None, chunk_quota)


def _rank(long: DataFrame, k: int, metric: str, value_name: str) -> DataFrame:
    key = F.round(F.col(value_name), _ROUND)
    w = Window.partitionBy("qid").orderBy(key.asc() if metric == "l2" else key.desc(), F.col("tid"))
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _row_bytes(c: DataFrame) -> Column:
    """Bytes of a candidate row in memory: its vector and all carried columns."""
    total = F.coalesce(F.size("_tv"), F.lit(0)).cast("long") * 8 + 64
    for f in c.schema.fields:
        if f.name.startswith("aux_"):
            size = F.octet_length(F.col(f.name).cast("string")) if f.dataType.typeName() not in ("binary",) else F.octet_length(f.name)
            total = total + F.coalesce(size, F.lit(0)).cast("long") + 56
    return total


def _collect_if_small(c: DataFrame, max_bytes: int):
    """The candidate table as a pandas frame, only if provably under ``max_bytes``."""
    first = c.select(F.size("_tv").alias("d")).first()
    if first is None:
        return c.toPandas()
    max_rows = max_bytes // (8 * max(int(first["d"] or 0), 1) + 64)
    seen = c.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(c)).alias("b")).first()
    if seen["n"] > max_rows or seen["b"] > max_bytes:
        return None
    return c.toPandas()


def _broadcast_path(q: DataFrame, small: pd.DataFrame, schema, aux, opts) -> DataFrame:
    spark = q.sparkSession
    tids = small["_tid"].to_numpy()
    Tm = _matrix(small["_tv"])
    aux_cols = {f"aux_{a}": small[f"aux_{a}"].to_numpy() for a in aux}
    bc = spark.sparkContext.broadcast((tids, Tm, aux_cols))
    schema = T.StructType(schema.fields[:3] + [T.StructField("rank", T.IntegerType())] + schema.fields[3:])
    names = [f.name for f in schema.fields]

    def run(batches):
        tids_, Tm_, aux_ = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            Q = _matrix(pdf["_qv"])
            qids = pdf["_qid"].to_numpy()
            r, ci, v = _score_block(Q, qids, Tm_, tids_, **opts)
            # rows come out grouped by query, best first
            starts = np.r_[0, np.nonzero(np.diff(r))[0] + 1] if len(r) else np.zeros(0, int)
            rank = np.arange(len(r)) - np.repeat(starts, np.diff(np.r_[starts, len(r)])) + 1
            out = {"qid": qids[r], "tid": tids_[ci], names[2]: v, "rank": rank.astype(np.int32)}
            for a, arr in aux_.items():
                out[a] = arr[ci]
            yield pd.DataFrame(out, columns=names)

    return q.mapInPandas(run, schema)


# successive slices ---------------------------------------------------------------
def _sliced_path(q, c, schema, aux, opts, max_bytes, max_rows, quota, route=None) -> DataFrame:
    """One broadcast slice of the candidates after the other, merged into each query's running top-k.

    A slice stays below ``max_bytes`` (and ``max_rows``) and is a broadcast of its own.  A pass over the queries takes a
    round of slices, as many as the default bound holds together, and its tasks read one after the other; the number
    of passes, each of which writes the queries, follows the bytes of the candidates and not the number of slices.
    With ``route`` (:class:`_Route`) the candidates have pivots, and a query meets those of the pivots it has to visit.
    """
    spark = q.sparkSession
    stored = cut_lineage(c.withColumn("_bytes", _row_bytes(c)).withColumn("_row", F.monotonically_increasing_id()))
    size = stored.agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("b")).first()
    # the driver holds a piece at a time: one slice, or several small ones
    piece = max(max_bytes, min(_PIECE_BYTES, DEFAULT_BROADCAST_BYTES))
    pieces = max(1, math.ceil((size["b"] or 0) / piece))
    step = max(1, DEFAULT_BROADCAST_BYTES // piece)     # pieces of a round
    table = stored
    if pieces > 1:
        # whole blocks share a slice where a quota needs them together; else the row number deals the rows evenly
        key = F.pmod(F.col("_blk"), F.lit(pieces)) if quota else F.pmod(F.xxhash64("_row"), F.lit(pieces))
        path = scratch_path(spark, "pieces")
        stored.withColumn("_piece", key.cast("int")).repartition(pieces, "_piece").write.partitionBy("_piece").parquet(path)
        release(stored)
        table = spark.read.parquet(path)
        table._tessera_path = path
    names = [f.name for f in schema.fields]
    lists = [T.StructField(f"_top_{f.name}", T.ArrayType(f.dataType)) for f in schema.fields[1:]]
    state = T.StructType(q.schema.fields + lists)
    final = T.StructType(schema.fields[:3] + [T.StructField("rank", T.IntegerType())] + schema.fields[3:])
    now, before = q, None
    for j in range(0, pieces, step):
        shared = []
        for i in range(j, min(j + step, pieces)):
            part = (table.filter(F.col("_piece") == i).drop("_piece") if pieces > 1 else table).drop("_row").toPandas()
            shared += [spark.sparkContext.broadcast(x) for x in _slices(part, max_bytes, max_rows, quota is not None)]
            del part
        last = j + step >= pieces
        now = now.mapInPandas(_slice_run(shared, names, opts, quota, final if last else None, route), final if last else state)
        if not last:
            now = cut_lineage(now)
            for x in shared:
                x.destroy()  # the pass is written
            release(before)
            before = now
    release(table)  # every slice has been read and sent
    return now


def _slices(part: pd.DataFrame, max_bytes: int, max_rows: int | None, blocks: bool):
    """The candidates of a piece in slices within the bounds (one row, or one block, at least): columns as arrays.
    Those of a pivot follow one another by their distance to it."""
    if blocks:
        part = part.sort_values("_blk", kind="stable")
    elif "_pid" in part:
        part = part.sort_values(["_pid", "_pd"])
    ends = np.cumsum(part["_bytes"].to_numpy(dtype=np.int64))
    of = part["_blk"].to_numpy() if blocks else np.arange(len(part))
    cuts = np.r_[np.flatnonzero(of[1:] != of[:-1]) + 1, len(of)]      # where a slice may end
    part = part.drop(columns="_bytes")
    a = 0
    while a < len(part):
        most = np.searchsorted(ends, (ends[a - 1] if a else 0) + max_bytes, "right")
        most = min(most, a + max_rows) if max_rows else most
        b = int(cuts[max(np.searchsorted(cuts, most, "right") - 1, np.searchsorted(cuts, a, "right"))])
        yield {c: _matrix(part[c].iloc[a:b]) if c == "_tv" else part[c].iloc[a:b].to_numpy() for c in part.columns}
        a = b


class _Running:
    """The k best rows so far of each query of a batch: candidate id, value and carried columns."""

    def __init__(self, rows: int, k: int, metric: str):
        self.k, self.sign = k, 1.0 if metric == "l2" else -1.0
        self.bound = np.full(rows, np.inf)       # cost of the k-th, infinite where fewer are
        self.r = self.place = np.zeros(0, int)   # query number and rank of each row held
        self.cols = None

    def add(self, r: np.ndarray, cols: list[np.ndarray]) -> None:
        if not len(r):
            return
        if self.cols is None:
            self.cols = [x[:0] for x in cols]
        touched = np.zeros(len(self.bound), bool)
        touched[r] = True
        mine = touched[self.r]
        r = np.concatenate([self.r[mine], r])
        cols = [np.concatenate([x[mine], y]) for x, y in zip(self.cols, cols)]
        cost = self.sign * cols[1].astype(np.float64)
        order = np.lexsort((cols[0], np.round(cost, _ROUND), r))
        place = np.arange(len(r)) - np.searchsorted(r[order], r[order], "left")
        order, place = order[place < self.k], place[place < self.k]
        full = order[place == self.k - 1]
        self.bound[r[full]] = cost[full]
        self.cols = [np.concatenate([x[~mine], y[order]]) for x, y in zip(self.cols, cols)]
        self.r, self.place = np.concatenate([self.r[~mine], r[order]]), np.concatenate([self.place[~mine], place])

    def rows(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(query number, rank from 0, columns), by query, best first."""
        order = np.lexsort((self.place, self.r))
        return self.r[order], self.place[order], [x[order] for x in self.cols]


def _tile_parts(shared):
    """The slices in turn, small ones joined to tiles; a slice that was one of several is not kept after its turn."""
    held, rows = [], 0
    for x in shared:
        part = x.value
        if len(shared) > 1:
            x.__dict__.pop("_value", None)      # its file is read again for the next batch
        if held and rows + len(part["_tid"]) > _TILE:
            yield _joined(held)
            held, rows = [], 0
        held.append(part)
        rows += len(part["_tid"])
    if held:
        yield _joined(held)


def _joined(parts):
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


class _Route:
    """The pivots each query of a batch has to visit, in a search by slices."""

    def __init__(self, shared, sizes, some_cands, tau, leaf_rows):
        self.shared, self.sizes, self.some_cands, self.tau, self.leaf_rows = shared, sizes, some_cands, tau, leaf_rows

    def plan(self, Q, qids, opts) -> tuple[list[np.ndarray], np.ndarray]:
        """Rows that visit each pivot, and the upper bound on each row's k-th distance."""
        rows, pids, bound = [], [], []
        for a in range(0, len(Q), _STEP):
            r, p, b = _visits(Q[a:a + _STEP], qids[a:a + _STEP], self.shared.value, self.sizes.value, self.some_cands.value, opts, self.tau)
            rows.append(r + a), pids.append(p), bound.append(b)
        rows, pids = np.concatenate(rows), np.concatenate(pids)
        order = np.lexsort((rows, pids))
        return np.split(rows[order], np.searchsorted(pids[order], np.arange(1, len(self.shared.value.pivots)))), np.concatenate(bound)

    def score(self, Q, qids, part, visitors, bound, opts):
        """What :func:`_score_block` gives, pivot by pivot."""
        pid = part["_pid"]
        edge = np.r_[np.flatnonzero(np.r_[True, pid[1:] != pid[:-1]]), len(pid)] if len(pid) else [0]
        for a, b in zip(edge, edge[1:]):
            rows = visitors[pid[a]]
            if len(rows):
                r, ci, v = _score_rings(Q[rows], qids[rows], part["_tv"][a:b], part["_tid"][a:b], self.shared.value.pivots[pid[a]],
                                        part["_pd"][a:b], self.leaf_rows, opts, bound[rows])
                yield rows[r], ci + a, v


def _slice_run(shared, names, opts, quota, final, route=None):
    """Scores the slices and merges them with the ``_top_*`` lists of the queries; gives rows at the end, else lists."""
    tops = [f"_top_{n}" for n in names[1:]]

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            Q, qids = _matrix(pdf["_qv"]), pdf["_qid"].to_numpy()
            best = _Running(len(pdf), opts["k"], opts["metric"])
            if tops[0] in pdf:
                size = pdf[tops[0]].map(len).to_numpy()
                best.add(np.repeat(np.arange(len(pdf)), size), [_flat(pdf[t], int(size.sum())) for t in tops])
            visitors, most = route.plan(Q, qids, opts) if route else (None, np.inf)
            for part in _tile_parts(shared):
                blocks = {"quota": (part["_blk"], *quota)} if quota else {}
                bound = np.minimum(best.bound, most)
                for r, ci, v in (route.score(Q, qids, part, visitors, bound, opts) if route else
                                 [_score_block(Q, qids, part["_tv"], part["_tid"], bound=bound, **blocks, **opts)]):
                    best.add(r, [part["_tid"][ci], v] + [part[n][ci] for n in names[3:]])
            if best.cols is None:
                best.cols = [np.zeros(0) for _ in tops]
            r, place, cols = best.rows()
            if final is not None:
                out = {"qid": qids[r], "tid": cols[0], names[2]: cols[1].astype(np.float64), "rank": (place + 1).astype(np.int32)}
                out.update(zip(names[3:], cols[2:]))
                yield pd.DataFrame(out, columns=[f.name for f in final.fields])
            else:
                ends = np.searchsorted(r, np.arange(len(pdf) + 1))
                out = {"_qid": pdf["_qid"], "_qv": pdf["_qv"]}
                for t, x in zip(tops, cols):
                    out[t] = [x[a:b] for a, b in zip(ends, ends[1:])]
                yield pd.DataFrame(out)

    return run


def _flat(lists: pd.Series, size: int) -> np.ndarray:
    """The items of all lists in a row."""
    return np.concatenate([np.asarray(x) for x in lists if len(x)]) if size else np.zeros(0)


# pivots ----------------------------------------------------------------------------
def _distances(X: np.ndarray, P: np.ndarray) -> np.ndarray:
    """Euclidean distances from coordinate differences (no cancellation far from the origin)."""
    out = np.empty((len(X), len(P)))
    for j in range(len(P)):
        d = X - P[j]
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


def _slack(dims: int) -> float:
    """Relative error allowed for a distance computed from differences, several times its bound."""
    return 8.0 * (dims + 8) * np.finfo(np.float64).eps


class PivotTree:
    """Pivots in groups around centres: the nearest pivots and the pivots within reach, most groups left unopened."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        m = len(pivots)
        self.centres = pivots[:max(1, int(math.sqrt(m)))]
        group = np.argmin(_distances(pivots, self.centres), axis=1)
        self.groups = [np.flatnonzero(group == g) for g in range(len(self.centres))]
        self.reach = np.array([_distances(pivots[g], self.centres[i:i + 1]).max(initial=0.0) for i, g in enumerate(self.groups)])

    def nearest(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and distance of the nearest pivot of every row, ties to the smallest number."""
        to = _distances(X, self.centres)
        slack = _slack(X.shape[1])
        best, at = np.full(len(X), np.inf), np.full(len(X), len(self.pivots))
        for g in np.argsort(to.min(axis=0, initial=np.inf)):
            members = self.groups[g]
            rows = np.flatnonzero(to[:, g] - self.reach[g] - slack * (to[:, g] + self.reach[g]) <= best)
            if not len(rows) or not len(members):
                continue
            d = _distances(X[rows], self.pivots[members])
            j = np.argmin(d, axis=1)
            dist, number = d[np.arange(len(rows)), j], members[j]
            better = (dist < best[rows]) | ((dist == best[rows]) & (number < at[rows]))
            best[rows[better]], at[rows[better]] = dist[better], number[better]
        return at, best

    def kth_bound(self, X: np.ndarray, count: np.ndarray, radius: np.ndarray, need: int, at: np.ndarray) -> np.ndarray:
        """An upper bound on the distance of the ``need``-th candidate: members of the pivots around the nearest one."""
        bound = np.full(len(X), np.inf)
        home = np.empty(len(self.pivots), int)
        for g, members in enumerate(self.groups):
            home[members] = g
        for g in np.unique(home[at]):
            rows = np.flatnonzero(home[at] == g)
            members = self.groups[g]
            far = _distances(X[rows], self.pivots[members]) + radius[members]
            order = np.argsort(far, axis=1)
            filled = np.cumsum(count[members][order], axis=1) >= need
            pos = np.argmax(filled, axis=1)
            ok = filled[np.arange(len(rows)), pos]
            bound[rows[ok]] = far[np.arange(len(rows)), order[np.arange(len(rows)), pos]][ok]
        return bound

    def within(self, X: np.ndarray, bound: np.ndarray, radius: np.ndarray, count: np.ndarray,
               home: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, pivot) pairs whose members may lie within the row's bound; pivots without members are left out.

        With ``home`` (:meth:`nearest` of the rows) a row is also held against the plane between a pivot and its
        nearest one: no member of the pivot lies on the row's side of it.
        """
        to = _distances(X, self.centres)
        slack, rows, numbers = _slack(X.shape[1]), [], []
        for g, members in enumerate(self.groups):
            members = members[count[members] > 0]
            if not len(members):
                continue
            far = self.reach[g] + radius[members].max()
            near = np.flatnonzero(to[:, g] - far - slack * (to[:, g] + far) <= bound * (1 + slack) + _TIE)
            d = _distances(X[near], self.pivots[members])
            r, j = np.nonzero(d - radius[members] - slack * (d + radius[members]) <= (bound[near] * (1 + slack) + _TIE)[:, None])
            if home is not None:
                own, rest, here, there = home[0][near[r]], home[1][near[r]], d[r, j], radius[members[j]]
                apart = self.pivots[members[j]] - self.pivots[own]
                apart = np.sqrt(np.einsum("ij,ij->i", apart, apart))
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = ((here - rest) * (here + rest) / 2 - slack * ((here + rest) ** 2 + (there + apart) ** 2)) / apart
                keep = ~((apart > 0) & (plane * (1 - slack) > bound[near[r]] * (1 + slack) + _TIE))
                r, j = r[keep], j[keep]
            rows.append(near[r])
            numbers.append(members[j])
        return (np.concatenate(rows), np.concatenate(numbers)) if rows else (np.zeros(0, int), np.zeros(0, int))


_TIE = 2.0 * 10.0 ** -_ROUND  # candidates that only the rounding of ties brings level
_STEP = 2000                  # rows of a batch routed at a time
_BOUND_ROWS = 4096            # candidates that bound the queries' k-th distances


def _assign_pivots(c: DataFrame, shared) -> DataFrame:
    schema = T.StructType(c.schema.fields + [T.StructField("_pid", T.IntegerType()), T.StructField("_pd", T.DoubleType())])

    def run(batches):
        tree = shared.value
        for pdf in batches:
            for a in range(0, len(pdf), _STEP):
                some = pdf.iloc[a:a + _STEP].copy()
                at, dist = tree.nearest(_matrix(some["_tv"]))
                some["_pid"], some["_pd"] = at.astype(np.int32), dist
                yield some

    return c.mapInPandas(run, schema)


def _route_queries(q: DataFrame, shared, sizes, some_cands, opts, tau, whole: bool = True) -> DataFrame:
    """Query rows with each pivot to visit (``_pid``) and an upper bound on their k-th distance (``_ub``); else the
    number of visits only (``_pid``, ``n``, to be summed)."""
    pid = T.StructField("_pid", T.IntegerType())
    schema = T.StructType(q.schema.fields + [pid, T.StructField("_ub", T.DoubleType())] if whole else [pid, T.StructField("n", T.LongType())])

    def run(batches):
        for pdf in batches:
            for a in range(0, len(pdf), _STEP):
                some = pdf.iloc[a:a + _STEP]
                rows, pids, bound = _visits(_matrix(some["_qv"]), some["_qid"].to_numpy(), shared.value, sizes.value, some_cands.value, opts, tau)
                if not whole:
                    number, n = np.unique(pids, return_counts=True)
                    yield pd.DataFrame({"_pid": number.astype(np.int32), "n": n.astype(np.int64)})
                    continue
                out = some.iloc[rows].copy()
                out["_pid"], out["_ub"] = pids.astype(np.int32), bound[rows]
                yield out

    return q.mapInPandas(run, schema)


def _visits(X, qids, tree, sizes, some_cands, opts, tau):
    """(row, pivot) pairs to visit, and an upper bound on each row's k-th distance: from the pivots' members and from
    the k-th of some of the candidates."""
    count, radius = sizes
    at, dist = tree.nearest(X)
    if tau is not None:
        return *tree.within(X, dist + tau, np.zeros_like(radius), count), np.full(len(X), np.inf)
    bound = tree.kth_bound(X, count, radius, opts["k"] + (1 if opts["exclude_self"] else 0), at)
    found = Search(X, qids, *some_cands, **opts)
    found.look()
    # both are computed distances: what they bound may be off by rounding, which the tests against them allow for
    bound = np.minimum(bound, found.kth())
    if opts["max_distance"] is not None:
        bound = np.minimum(bound, opts["max_distance"])
    return *tree.within(X, bound, radius, count, (at, dist)), bound


def _leaves(Tm: np.ndarray, Q: np.ndarray, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Candidates split at medians of their widest coordinate into leaves of at most ``rows``, equal ones kept together,
    and the queries that fall into each: (candidate numbers, query numbers)."""
    out, stack = [], [(np.arange(len(Tm)), np.arange(len(Q)))]
    while stack:
        c, q = stack.pop()
        if len(c) > rows:
            T = Tm[c]
            lo, hi = T.min(0), T.max(0)
            dim = int(np.argmax(hi - lo))
            if hi[dim] > lo[dim]:
                x, y = T[:, dim], Q[q, dim]
                cut = np.partition(x, len(x) // 2)[len(x) // 2]
                left, low = (x < cut, y < cut) if cut > lo[dim] else (x <= cut, y <= cut)
                stack += [(c[~left], q[~low]), (c[left], q[low])]
                continue
        out.append((c, q))
    return out


_TRIED = 8  # leaves after which the search may turn to all candidates


def _score_rings(Q, qids, Tm, tids, pivot, pd_, leaf_rows, opts, bound=None):
    """``_score_block`` over leaves of candidates: a query's own leaf first, then those its k-th distance reaches.

    Leaves are split by the coordinates and by the distance to the pivot (rings).  A leaf whose box lies further from
    the queries' box than their k-th distance so far holds none of their best, nor does one whose ring does:
    d(q, c) is at least |d(q, p) - d(c, p)|.  Where this leaves too much of the candidates, all are looked at.
    """
    if leaf_rows <= 0 or len(tids) <= leaf_rows or not len(Q):
        return _score_block(Q, qids, Tm, tids, bound=bound, **opts)
    found = Search(Q, qids, Tm, tids, bound=bound, **opts)
    slack = _slack(Q.shape[1])
    cap = np.inf if opts["max_distance"] is None else opts["max_distance"]
    A, B = np.c_[Tm, pd_], np.c_[Q, _distances(Q, pivot[None, :])[:, 0]]
    leaves = _leaves(A, B, max(leaf_rows, 2 * opts["k"] + 2))
    lo, hi = (np.stack([f(A[c], axis=0) for c, _ in leaves]) for f in (np.min, np.max))
    mine = [(i, q) for i, (_, q) in enumerate(leaves) if len(q)]
    looked = done = 0
    for n, (i, q) in enumerate(mine):
        if n >= _TRIED and 4 * looked > done * len(tids):
            found.look(np.concatenate([q for _, q in mine[n:]]))
            break
        own = leaves[i][0]
        found.look(q, own)
        low, high = B[q].min(0), B[q].max(0)
        limit = np.minimum(found.kth()[q], cap) * (1 + slack) + _TIE
        near = ~_apart(lo, hi, low, high, slack, limit.max())    # not a number: never ruled out
        near[i] = False
        near = np.flatnonzero(near)
        if len(near) > 1 and len(near) * len(q) * A.shape[1] <= _PAIRS:
            x = B[q][:, None, :]
            near = near[~_apart(lo[near], hi[near], x, x, slack, limit[:, None]).all(axis=0)]
        cols = np.concatenate([leaves[j][0] for j in near]) if len(near) else own[:0]
        if len(cols):
            found.look(q, cols)
        looked, done = looked + len(q) * (len(own) + len(cols)), done + len(q)
    return found.result()


def _apart(lo, hi, low, high, slack, limit):
    """Whether boxes (last coordinate: distance to the pivot) are certainly further apart than ``limit``."""
    gap = np.maximum(np.maximum(lo - high, low - hi), 0.0)
    ring = gap[..., -1] - slack * (np.abs(hi[..., -1]) + np.abs(high[..., -1]))
    gap = gap[..., :-1]
    return (np.sqrt((gap * gap).sum(-1)) * (1 - slack) > limit) | (ring > limit)


# Copies of a row among the groups of one pivot as long as these fit the byte bound: a query row meets the pivot's
# chunks of candidates (and may visit every pivot), a candidate row has one pivot and meets its chunks of queries.
_QUERY_COPIES, _CANDIDATE_COPIES = 2, 16


def _chunks(rows: int, copies: int, least: int, most: int) -> int:
    """Number of chunks: of ``least`` rows, but at most ``copies`` chunks unless one would exceed ``most`` rows."""
    size = max(least, -(-rows // copies))
    return max(1, -(-rows // max(1, min(size, max(least, most)))))


def _copies(visits: dict, counts: np.ndarray, block_rows: int, most: int, queries: int) -> float:
    """Copies of a query row and of a candidate row, on average, that groups of the pivots' chunks would take."""
    asked = sum(n * _chunks(int(counts[p]), _QUERY_COPIES, block_rows, most) for p, n in visits.items())
    offered = sum(int(counts[p]) * _chunks(n, _CANDIDATE_COPIES, block_rows, most) for p, n in visits.items())
    return asked / max(1, queries) + offered / max(1, int(counts.sum()))


def _routed_path(q, c, schema, aux, opts, pivots, tau, block_rows, leaf_rows, seed, broadcast_bytes=DEFAULT_BROADCAST_BYTES):
    spark = q.sparkSession
    from .features import unit_hash
    # pivots: the first rows of a seeded id-hash order (reproducible anywhere)
    dims = int(c.select(F.size("_tv").alias("d")).first()["d"]) if pivots else 0
    some = max(pivots, min(_BOUND_ROWS, broadcast_bytes // (8 * dims + 64)) if tau is None else 0)
    sample = c.select("_tid", "_tv").orderBy(unit_hash("_tid", seed), F.col("_tid")).limit(some).toPandas()
    if len(sample) == 0:
        return spark.createDataFrame([], schema)
    pv = _matrix(sample["_tv"].iloc[:pivots])
    shared = spark.sparkContext.broadcast(PivotTree(pv))
    # k of these bound a query's k-th distance before any pivot is visited
    some_cands = spark.sparkContext.broadcast((_matrix(sample["_tv"]), sample["_tid"].to_numpy()))
    # written once: the sizes, the chunk plan and the search read the same assignment
    ca = cut_lineage(_assign_pivots(c, shared))
    st = ca.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.max("_pd").alias("r")).toPandas()
    counts = np.zeros(len(pv), dtype=np.int64)
    radius = np.zeros(len(pv))
    counts[st["_pid"].to_numpy()] = st["n"].to_numpy()
    radius[st["_pid"].to_numpy()] = st["r"].to_numpy()
    sizes = spark.sparkContext.broadcast((counts, radius))
    # rows of a group: block_rows, and more where a row would be copied into many groups, up to the byte bound
    most = max(1, broadcast_bytes // 2 // (8 * max(pv.shape[1], 1) + 64))
    if max(_chunks(int(n), _QUERY_COPIES, block_rows, most) for n in counts) > _QUERY_COPIES:
        # the byte bound asks for more copies than that: if the queries visit many such pivots, the candidates are sent
        # to the queries in slices instead, and no row is copied
        visits = dict(_route_queries(q, shared, sizes, some_cands, opts, tau, False).groupBy("_pid").agg(F.sum("n")).collect())
        if _copies(visits, counts, block_rows, most, q.count()) > _QUERY_COPIES + _CANDIDATE_COPIES:
            found = _sliced_path(q, ca, schema, aux, opts, broadcast_bytes, None, None, _Route(shared, sizes, some_cands, tau, leaf_rows))
            release(ca)
            return found.drop("rank")
    qa = cut_lineage(_route_queries(q, shared, sizes, some_cands, opts, tau))
    # Partition sizes: one small row per pivot reaches the driver.
    visits = dict(qa.groupBy("_pid").count().collect())
    plan = [(int(p), _chunks(int(counts[p]), _QUERY_COPIES, block_rows, most), _chunks(int(n), _CANDIDATE_COPIES, block_rows, most))
            for p, n in visits.items() if counts[p]]
    if not plan:
        return spark.createDataFrame([], schema)
    plan = F.broadcast(spark.createDataFrame(plan, "_pid int, tchunks int, qchunks int"))  # bounded by the pivot count
    tchunk = F.pmod(F.xxhash64("_tid", F.lit(seed + 1)), F.col("tchunks")).cast("int")
    qchunk = F.pmod(F.xxhash64("_qid", F.lit(seed + 2)), F.col("qchunks")).cast("int")
    ck = (ca.join(plan, "_pid").withColumn("_tc", tchunk)
          .withColumn("_qc", F.explode(F.sequence(F.lit(0), F.col("qchunks") - 1))).drop("tchunks", "qchunks"))
    qk = (qa.join(plan, "_pid").withColumn("_qc", qchunk)
          .withColumn("_tc", F.explode(F.sequence(F.lit(0), F.col("tchunks") - 1))).drop("tchunks", "qchunks"))
    names = [f.name for f in schema.fields]
    aux_names = [f"aux_{a}" for a in aux]

    def group(key, qpdf, cpdf):
        if len(qpdf) == 0 or len(cpdf) == 0:
            return pd.DataFrame({n: [] for n in names}, dtype=object)
        tids = cpdf["_tid"].to_numpy()
        qids = qpdf["_qid"].to_numpy()
        r, ci, v = _score_rings(_matrix(qpdf["_qv"]), qids, _matrix(cpdf["_tv"]), tids, pv[key[0]], cpdf["_pd"].to_numpy(), leaf_rows, opts,
                                qpdf["_ub"].to_numpy())
        out = {"qid": qids[r], "tid": tids[ci], names[2]: v}
        for a in aux_names:
            out[a] = cpdf[a].to_numpy()[ci]
        return pd.DataFrame(out, columns=names)

    keys = ["_pid", "_qc", "_tc"]
    return qk.groupBy(*keys).cogroup(ck.groupBy(*keys)).applyInPandas(group, schema)


GROUP_ROWS = 2048    # rows a side of a group of :func:`chunked_cogroup` may always have
_GROUP_COPIES = 8    # chunks of a side that a row of the other is copied into as long as they are of that size


def chunk_count(n: Column, block_rows: int) -> Column:
    """Number of chunks of ``n`` rows: of ``block_rows`` rows, but at most ``_GROUP_COPIES`` chunks unless one would exceed
    ``GROUP_ROWS`` (or ``block_rows``) rows."""
    size = F.greatest(F.lit(block_rows), F.least(F.lit(GROUP_ROWS), F.ceil(n / _GROUP_COPIES)))
    return F.ceil(n / size).cast("int")


def chunked_cogroup(left: DataFrame, right: DataFrame, key, fn, schema,
                    lid: str, rid: str, block_rows: int = GROUP_ROWS, seed: int = 11) -> DataFrame:
    """Cogroup two keyed tables with every key cut into bounded chunks.

    Rows of a key are split into chunks (:func:`chunk_count`) per side by
    id hash; each left chunk meets each right chunk of the same key once, so
    no group holds more than about ``max(block_rows, GROUP_ROWS)`` rows per side
    whatever the key skew, and a row is copied into few groups below that size.
    The per-key chunk plan stays a DataFrame (the key count grows
    with the data and is never collected).  ``fn(left_pdf, right_pdf)``
    returns a pandas frame with ``schema``.
    """
    key = [key] if isinstance(key, str) else list(key)
    lc = left.groupBy(*key).agg(F.count(F.lit(1)).alias("_nl"))
    rc = right.groupBy(*key).agg(F.count(F.lit(1)).alias("_nr"))
    plan = lc.join(rc, key).select(*key, chunk_count(F.col("_nl"), block_rows).alias("_lch"), chunk_count(F.col("_nr"), block_rows).alias("_rch"))
    L = (left.join(plan, key)
         .withColumn("_lc", F.pmod(F.xxhash64(lid, F.lit(seed)), F.col("_lch")).cast("int"))
         .withColumn("_rc", F.explode(F.sequence(F.lit(0), F.col("_rch") - 1)))
         .withColumn("_rc", F.col("_rc").cast("int"))
         .drop("_lch", "_rch"))
    R = (right.join(plan, key)
         .withColumn("_rc", F.pmod(F.xxhash64(rid, F.lit(seed + 1)), F.col("_rch")).cast("int"))
         .withColumn("_lc", F.explode(F.sequence(F.lit(0), F.col("_lch") - 1)))
         .withColumn("_lc", F.col("_lc").cast("int"))
         .drop("_lch", "_rch"))
    names = [f.name for f in schema.fields]

    def run(lpdf, rpdf):
        if len(lpdf) == 0 or len(rpdf) == 0:
            return pd.DataFrame({n: [] for n in names}, dtype=object)
        return fn(lpdf, rpdf)

    keys = key + ["_lc", "_rc"]
    # fresh attribute ids: both sides often derive from one table (self joins)
    L = L.select(*[F.col(c).alias(c) for c in L.columns])
    R = R.select(*[F.col(c).alias(c) for c in R.columns])
    return L.groupBy(*keys).cogroup(R.groupBy(*keys)).applyInPandas(run, schema)
