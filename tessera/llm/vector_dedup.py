"""Near-duplicate vectors by inverted lists and product quantisation.

Coarse centroids and, for the residuals, one codebook per subspace are fitted
on a bounded sample (``SAMPLE`` vectors drawn by a hash of the id); then every
vector is indexed: its home list, its residual codes, and the exact length of
what the codes miss.  A vector searches the lists whose border lies close
enough: moving to a neighbour at the least cosine shifts a vector along the
direction between two centroids by about step / sqrt(dimensions), and lists
within ``SIGMAS`` such shifts are probed.  A pair is found if either of the two
probes the other's home list, and then counts for both.  In a list the
table-lookup distance between the searching vector and a member's codes, less
the member's missing length, is a lower bound of their distance; pairs that
pass it are confirmed by the exact cosine in double precision.

Lists are searched in cells of at most about ``CELL`` members by ``CELL``
searching vectors, so a list that holds a third of all vectors is spread over
many tasks; a cell returns link counts and a spanning forest of the links
found, never the pairs.  Equal vectors are indexed once, with their number.

Defined cases: vectors that are null, empty or zero, or hold a null or
non-finite component, and vectors without an id, link with nothing; vectors
of different dimension never link; repeated rows count as separate vectors;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import cut_lineage
from .common import documents

SAMPLE = 20_000
SUBSPACES, CODES, ROUNDS = 16, 256, 8
MAX_LISTS = 4096
SIGMAS = 2.2
CELL = 2048


def _assign(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.RandomState(seed)
    k = max(1, min(k, len(x)))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        a = _assign(x, c)
        n = np.bincount(a, minlength=k)
        order = np.argsort(a, kind="stable")
        cut = np.concatenate([[0], np.cumsum(n)])[:-1]
        full = n > 0
        c[full] = np.add.reduceat(x[order], cut[full], axis=0) / n[full][:, None]
    return c


class Index:
    """Coarse centroids, codebooks and the probe rule."""

    def __init__(self, sample: np.ndarray, lists: int, least: float):
        d = sample.shape[1]
        self.least, self.step = least, float(np.sqrt(max(0.0, 2 - 2 * least)))
        self.reach = SIGMAS * self.step / np.sqrt(d)
        self.coarse = _kmeans(sample, lists, 1)
        self.apart = np.sqrt(np.maximum(((self.coarse[:, None] - self.coarse[None]) ** 2).sum(2), 1e-12)) \
            if len(self.coarse) <= 512 else None
        self.parts = np.array_split(np.arange(d), min(SUBSPACES, d))
        rest = sample - self.coarse[_assign(sample, self.coarse)]
        self.books = [_kmeans(np.ascontiguousarray(rest[:, p]), CODES, 2 + i) for i, p in enumerate(self.parts)]

    def describe(self, x: np.ndarray):
        """(home, probed lists, codes, missing length) of unit vectors."""
        score = (self.coarse * self.coarse).sum(1) - 2 * (x @ self.coarse.T)
        home = score.argmin(1)
        rest = x - self.coarse[home]
        codes = np.stack([_assign(rest[:, p], b) for p, b in zip(self.parts, self.books)], axis=1).astype(np.uint8)
        miss = np.sqrt(sum(((rest[:, p] - b[codes[:, i]]) ** 2).sum(1) for i, (p, b) in enumerate(zip(self.parts, self.books))))
        gap = score - score[np.arange(len(x)), home][:, None]
        if self.apart is not None:
            apart = self.apart[home]
        else:
            cc = (self.coarse * self.coarse).sum(1)
            apart = np.sqrt(np.maximum(cc[home][:, None] + cc[None] - 2 * self.coarse[home] @ self.coarse.T, 1e-12))
        near = gap <= 2 * self.reach * apart
        near[np.arange(len(x)), home] = True
        return home, [np.flatnonzero(r).astype(np.int32) for r in near], codes, miss

    def lookup(self, q: np.ndarray, ls: int, codes: np.ndarray) -> np.ndarray:
        """Squared table-lookup distances of searching vectors to a list's coded members."""
        c = self.coarse[ls]
        own = np.zeros(len(codes), np.float32)
        out = np.repeat((((q - c) ** 2).sum(1))[:, None], len(codes), axis=1).astype(np.float32)
        for i, (p, b) in enumerate(zip(self.parts, self.books)):
            own += (2 * (b @ c[p]) + (b * b).sum(1)).astype(np.float32)[codes[:, i]]
            table = (-2 * (q[:, p] @ b.T)).astype(np.float32)
            out += np.take(table, codes[:, i], axis=1)
        return out + own


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of n nodes over the links a - b."""
    lab = np.arange(n)
    while True:
        m = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def _rows(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _read(dtype):
    """Valid vectors as raw bytes, their dimension and a 128-bit digest."""
    def run(batches):
        for b in batches:
            keep, raw, dim, k1, k2 = [], [], [], [], []
            for i, v in enumerate(b.column(1)):
                if not v.is_valid or not len(v) or not b.column(0)[i].is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(dtype) + dtype(0)   # -0.0 becomes 0.0
                with np.errstate(over="ignore"):
                    norm = np.sqrt((x.astype(np.float64) ** 2).sum())
                if not (np.isfinite(norm) and norm > 0):
                    continue
                data = x.tobytes()
                d = np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), np.int64)
                keep.append(i)
                raw.append(data)
                dim.append(len(x))
                k1.append(d[0])
                k2.append(d[1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int64())), pa.array(raw, pa.binary()), pa.array(dim, pa.int32()),
                 pa.array(k1, pa.int64()), pa.array(k2, pa.int64())], ["vec_id", "raw", "dim", "k1", "k2"])
    return run


def _describe(shared, dtype):
    def run(batches):
        ix: Index = shared.value
        for b in batches:
            if b.num_rows:
                home, probes, codes, miss = ix.describe(_unit(_rows(b.column(2), dtype)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array(home.astype(np.int32)), pa.array(probes, pa.list_(pa.int32())),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(miss)],
                    ["id", "n", "raw", "home", "probes", "codes", "miss"])
    return run


def _search(shared, dtype):
    """One cell: members of one list against vectors that probe it."""
    def run(key, t):
        ix: Index = shared.value
        ls = key[0].as_py()
        role = t["role"].to_numpy()
        empty = pa.table([pa.array([], pa.int64())] * 3, names=["id", "links", "root"])
        mt, qt = t.filter(pa.array(role == 0)), t.filter(pa.array(role == 1))
        if not mt.num_rows or not qt.num_rows:
            return empty
        mid, qid = mt["id"].to_numpy(), qt["id"].to_numpy()
        mn, qn = mt["n"].to_numpy(), qt["n"].to_numpy()
        mx, qx = _unit(_rows(mt["raw"], dtype)), _unit(_rows(qt["raw"], dtype))
        codes, miss = _rows(mt["codes"], np.uint8), mt["miss"].to_numpy()
        bound = (ix.step + miss + 1e-4) ** 2
        found_q, found_m = [], []
        for lo in range(0, len(qid), 256):
            q, m = np.nonzero(ix.lookup(qx[lo:lo + 256], ls, codes) <= bound[None])
            q += lo
            for s in range(0, len(q), 1 << 17):
                a, b = q[s:s + (1 << 17)], m[s:s + (1 << 17)]
                ok = ((qx[a] * mx[b]).sum(1) >= ix.least) & (qid[a] != mid[b])
                found_q.append(a[ok])
                found_m.append(b[ok])
        q, m = np.concatenate(found_q), np.concatenate(found_m)
        if not len(q):
            return empty
        links = np.bincount(q, weights=mn[m], minlength=len(qid)).astype(np.int64)
        # a member that does not probe the searcher's home list learns of the link here
        home = qt["home"].to_numpy()
        probed = np.zeros((len(mid), len(ix.coarse)), bool)
        for i, p in enumerate(mt["probes"].to_pylist()):
            probed[i, p] = True
        alone = ~probed[m, home[q]]
        back = np.bincount(m[alone], weights=qn[q[alone]], minlength=len(mid)).astype(np.int64)
        ids, at = np.unique(np.concatenate([qid, mid]), return_inverse=True)
        lab = _forest(at[:len(qid)][q], at[len(qid):][m], len(ids))
        total = np.bincount(at, weights=np.concatenate([links, back]), minlength=len(ids)).astype(np.int64)
        hit = np.flatnonzero((total > 0) | (lab != np.arange(len(ids))))
        return pa.table([pa.array(ids[hit]), pa.array(total[hit]), pa.array(ids[lab[hit]])], names=["id", "links", "root"])
    return run


def _links_of(classes: DataFrame, least: float, dtype, elem: str) -> DataFrame:
    """(id, links, root) contributions for the distinct vectors of one dimension."""
    spark = classes.sparkSession
    n = classes.count()
    draw = F.col("u") < SAMPLE / max(n, 1)
    sample = classes.withColumn("u", F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)).filter(draw) \
                    .select("raw").toArrow()["raw"].combine_chunks()
    if not len(sample):
        sample = classes.select("raw").limit(SAMPLE).toArrow()["raw"].combine_chunks()
    x = _unit(_rows(sample, dtype))
    shared = spark.sparkContext.broadcast(Index(x, int(np.clip(np.sqrt(n), 1, MAX_LISTS)), least))
    indexed = cut_lineage(classes.select("id", "n", "raw").mapInArrow(
        _describe(shared, dtype), "id long, n long, raw binary, home int, probes array<int>, codes binary, miss double"))
    # one row per list, at most MAX_LISTS
    homes = indexed.groupBy(F.col("home").alias("list")).agg(F.ceil(F.count(F.lit(1)) / CELL).alias("h"))
    probing = indexed.select(F.explode("probes").alias("list")).groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("q"))
    plan = F.broadcast(cut_lineage(homes.join(probing, "list")))
    member = indexed.withColumn("list", F.col("home")).join(plan, "list").withColumn("hc", F.pmod(F.xxhash64("id"), F.col("h"))) \
        .select("list", "hc", F.explode(F.expr("sequence(0L, q - 1)")).alias("qc"), F.lit(0).alias("role"),
                "id", "n", "raw", "home", "probes", "codes", "miss")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("probes", "array<int>"), ("codes", "binary"), ("miss", "double"))]
    searcher = indexed.select(F.explode("probes").alias("list"), "id", "n", "raw", "home").join(plan, "list") \
        .withColumn("qc", F.pmod(F.xxhash64("id", F.lit(3)), F.col("q"))) \
        .select("list", F.explode(F.expr("sequence(0L, h - 1)")).alias("hc"), "qc", F.lit(1).alias("role"), "id", "n", "raw", "home", *nothing)
    return member.unionByName(searcher).groupBy("list", "hc", "qc").applyInArrow(_search(shared, dtype), "id long, links long, root long")


def near_vectors(vectors: DataFrame, least: float = 0.9, column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``."""
    elem = vectors.schema[column].dataType.elementType.simpleString()
    dtype = np.float32 if elem == "float" else np.float64
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col(column).cast(f"array<{'float' if elem == 'float' else 'double'}>").alias("v"))
    valid = cut_lineage(base.mapInArrow(_read(dtype), "vec_id long, raw binary, dim int, k1 long, k2 long"))
    classes = cut_lineage(valid.groupBy("dim", "k1", "k2").agg(F.min(F.struct("vec_id", "raw")).alias("m"), F.count(F.lit(1)).alias("n"))
                          .select("dim", "k1", "k2", F.col("m.vec_id").alias("id"), F.col("m.raw").alias("raw"), "n"))
    found = None
    for (dim,) in classes.select("dim").distinct().orderBy("dim").collect():     # the dimensions in use, usually one
        part = _links_of(classes.filter(F.col("dim") == dim), least, dtype, elem)
        found = part if found is None else found.unionByName(part)
    members = valid.select("vec_id", "dim", "k1", "k2").join(classes.select("dim", "k1", "k2", "id", "n"), ["dim", "k1", "k2"])
    if found is None:
        out = members.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    else:
        found = cut_lineage(found)
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        edges = cut_lineage(found.filter("id <> root").select(F.col("id").alias("src"), F.col("root").alias("dst")).distinct())
        ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        comp = connected_components(ends, edges)
        out = members.join(links, "id", "left").join(comp, "id", "left") \
            .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"))
    out = cut_lineage(out)
    lone = base.filter("vec_id is null").select("vec_id").unionByName(
        base.filter("vec_id is not null").select("vec_id").exceptAll(valid.select("vec_id")))
    lone = lone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op5_vector_dedup(spark, sf_dir) -> DataFrame:
    return near_vectors(documents(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings
                     where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                       and list_sum(list_transform(embedding::double[], lambda x: x * x)) > 0),
p as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_cosine_similarity(a.e, b.e) >= 0.9),
r as (select vec_id as v, vec_id as c from v union select p.b, r.c from r join p on p.a = r.v),
k as (select v, min(c) as c from r group by 1),
n as (select a, count(*) as n from p group by 1)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(c, vec_id) as component_id, vec_id = coalesce(c, vec_id) as kept
from embeddings left join n on n.a = vec_id left join k on k.v = vec_id"""
