"""Language-model scores from a weighted backoff automaton of word pairs.

States are the empty history, the start of a text and every known word; the
state after a token is that token.  State h has an arc for every word w seen
after it, of weight (c(hw) + m p(w)) / (c(h) + m), and a failure arc to the
empty history of weight m / (c(h) + m); the empty history has an arc for
every word, of weight p(w) = (c(w) + 1) / (N + V + 1), and one for all
unknown words, 1 / (N + V + 1).  The weights leaving a state sum to one.  A
text is read once from left to right; the log weights of the arcs taken are
its score.

The automaton grows with the corpus and is not broadcast.  Its *core* (arcs
among the ``CORE`` most frequent words, and the counts of the ``HOT`` most
frequent words, both of fixed size) is; a traversal step inside the core is
scored where the text is read.  Every other step is sent, as a few packed
bytes, to the bucket that owns its arc: steps on a rare word go to the word's
bucket, where the word's own count meets too, steps on a frequent word to the
bucket of the arc, so no bucket holds all steps of a frequent word or pair.
The bucket counts the arcs over the training texts, weighs each step and
returns sums per text.  The same bucket pass thus builds and applies the arcs,
and one corpus pass of steps is all that is shuffled.

Defined cases: a null text counts as empty and consists of its end alone;
with no training texts N = V = 0 and every token is unknown; results are per
row, so repeated rows and null ids (which count as the empty id text for
the hold-out rule) are kept; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .common import crc_mod, documents, gather, id_text
from .words import Chunk, Spans, combine, mix, sum_by_row, text_chunks

END, START = np.uint64(0x1D8AF066F0E1B0A7), np.uint64(0x6F4A91B7C3D2E581)
HOT, CORE = 1 << 17, 1024
PRIOR = 100.0           # m: weight of the word distribution in every state
STEPS_A_BUCKET = 3_000_000
LEAST_BUCKETS = 48
BLOCK_BYTES = 6 << 20   # text read before steps are packed
MAX_ROWS = 1 << 15      # rows of a block: row number and training flag share 16 bits


def tokens(ch: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, state before it, row) for every step of the chunk's texts, ends included."""
    low = ch.lowered()
    starts, ends, first = low.words()
    h = Spans(low.data).hash(starts, ends)
    n = np.diff(first) + 1
    border = np.concatenate([[0], np.cumsum(n)])
    tok = np.empty(border[-1], np.uint64)
    last = np.zeros(border[-1], bool)
    last[border[1:] - 1] = True
    tok[last] = END
    tok[~last] = h
    state = np.empty_like(tok)
    state[1:] = tok[:-1]
    state[border[:-1]] = START
    return tok, state, np.repeat(np.arange(ch.rows), n)


def _blocks(batches, mod: int, out: int):
    """(ids, training flag, chunk) for bounded runs of rows."""
    for b in batches:
        train = crc_mod(b.column(0), mod) != out
        for ch in text_chunks(b.column(1)):
            for lo in range(0, ch.rows, MAX_ROWS):
                hi = min(lo + MAX_ROWS, ch.rows)
                o = ch.offsets[lo:hi + 1]
                yield (b.column(0).slice(ch.first + lo, hi - lo), train[ch.first + lo:ch.first + hi],
                       Chunk(0, ch.data[o[0]:o[-1]], o - o[0]))


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k = k[order]
    cut = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, int)
    return k[cut], (np.add.reduceat(c[order], cut) if len(cut) else c)


def _count(batches, keys_of, names: list[str], most: int = 2_000_000):
    """Counts of the keys of all blocks, merged up to ``most`` entries at a time."""
    keys, counts, size = [], [], 0
    for block in batches:
        k, c = np.unique(keys_of(*block), return_counts=True)
        keys.append(k)
        counts.append(c)
        size += len(k)
        if size > most:
            k, c = _merge(keys, counts)
            keys, counts, size = [k], [c], len(k)
            if size > most // 2:
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names)
                keys, counts, size = [], [], 0
    if keys:
        k, c = _merge(keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names)


class Automaton:
    """What every task knows of the automaton: totals, frequent words, arcs among the most frequent."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n: int, v: int, prior: float):
        order = np.argsort(-counts, kind="stable")
        top = np.argsort(words)
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        self.words, self.rank = words[top], rank[top]      # sorted hashes and their ranks
        self.counts = counts[order]                          # by rank
        self.n, self.v, self.prior = n, v, prior
        self.side = min(CORE, len(words)) + 1                # the last core state is the start
        self.arcs = np.zeros(0, np.int64)

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """Rank of each frequent word, -1 for the others."""
        if not len(self.words):
            return np.full(len(h), -1, np.int32)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.rank[at], -1)

    def core(self, tok: np.ndarray, state: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(steps inside the core, their arc numbers)."""
        before = np.empty_like(rank)
        before[1:] = rank[:-1]
        start = state == START
        before[start] = self.side - 1
        ok = (rank >= 0) & (rank < self.side - 1) & (before >= 0) & ((before < self.side - 1) | start)
        at = np.flatnonzero(ok)
        return at, before[at].astype(np.int64) * self.side + rank[at]

    def p(self, count: np.ndarray) -> np.ndarray:
        return (count + 1.0) / (self.n + self.v + 1.0)

    def arc(self, pair: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of an arc's weight without its state's total; pair 0 is the failure path."""
        return np.log10(pair + self.prior * self.p(count))

    def leave(self, count: np.ndarray) -> np.ndarray:
        """log10 of a state's total, which every arc out of it divides by."""
        return np.log10(count + self.prior)


def _steps(shared, mod: int, out: int, buckets: int):
    """Per block: one row of local sums (bucket -1), and one row of packed steps per bucket."""
    def run(batches):
        a: Automaton = shared.value
        part, serial = TaskContext.get().partitionId(), 0
        ends = a.counts[a.ranks(np.array([END]))[0]] if a.n else 0   # the start state is left once a text
        held, size, rows = [], 0, 0

        def flush():
            nonlocal held, size, rows, serial
            block = part << 32 | serial
            serial += 1
            ids = pa.concat_arrays([x[0].cast(pa.int64()) for x in held])
            train = np.concatenate([x[1] for x in held])
            cols = [tokens(x[2]) for x in held]
            shift = np.concatenate([[0], np.cumsum([len(x[1]) for x in held])])
            tok, state = np.concatenate([c[0] for c in cols]), np.concatenate([c[1] for c in cols])
            row = np.concatenate([c[2] + s for c, s in zip(cols, shift)])
            held, size, rows = [], 0, 0
            rank = a.ranks(tok)
            hot = rank >= 0
            count = a.counts[rank[hot]] if len(a.counts) else np.zeros(0, np.int64)
            n = len(train)
            base = sum_by_row(row[hot], np.log10(a.p(count)), n)
            known = np.bincount(row[hot], minlength=n)
            passed = tok[hot] != END                       # the state a word leads to is left once
            score = -sum_by_row(row[hot][passed], a.leave(count[passed]), n) - a.leave(np.array(ends))
            at, arc = a.core(tok, state, rank)
            inside = np.zeros(len(tok), bool)
            inside[at] = True
            score += sum_by_row(row[at], a.arc(a.arcs[arc], a.counts[rank[at]]), n)
            local = np.rec.fromarrays([base, score, known, np.bincount(row, minlength=n), train],
                                      dtype=[("base", "f8"), ("score", "f8"), ("known", "i8"), ("n", "i8"), ("train", "?")])
            yield block, -1, ids, local
            flag = (row | (train[row].astype(np.int64) << 15)).astype(np.uint16)
            for kind in (0, 1):                            # 0: frequent word, by arc; 1: rare word, by word
                sel = np.flatnonzero(~inside & (hot if kind == 0 else ~hot))
                key = combine(state[sel], tok[sel]) if kind == 0 else mix(tok[sel])
                bucket = (key >> np.uint64(40)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                sel, bucket = sel[order], bucket[order]
                where = np.searchsorted(bucket, np.arange(buckets + 1))
                for b in range(buckets):
                    s = sel[where[b]:where[b + 1]]
                    if len(s):
                        word = rank[s].astype(np.uint32).tobytes() if kind == 0 else tok[s].tobytes()
                        before = np.ascontiguousarray(state[s].view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                        yield block, b, kind, (flag[s].tobytes(), word, before)

        for ids, train, ch in _blocks(batches, mod, out):
            if held and (size + len(ch.data) > BLOCK_BYTES or rows + ch.rows > MAX_ROWS):
                yield from _packed(flush())
            held.append((ids, train, ch))
            size += len(ch.data)
            rows += ch.rows
        if held:
            yield from _packed(flush())
    return run


_STEP = "block long, bucket int, kind int, flag binary, word binary, state binary"


def _packed(rows):
    """Record batches of step rows; the local row carries ids and sums in its binaries."""
    cols: list[list] = [[] for _ in range(6)]
    for block, bucket, kind, data in rows:
        if bucket == -1:
            valid = np.array([x is not None for x in kind.to_pylist()])
            ids = np.array([0 if x is None else x for x in kind.to_pylist()], np.int64)
            values = [block, bucket, -1, data.tobytes(), ids.tobytes(), valid.tobytes()]
        else:
            values = [block, bucket, kind, *data]
        for c, v in zip(cols, values):
            c.append(v)
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                     ["block", "bucket", "kind", "flag", "word", "state"])


_LOCAL = np.dtype([("base", "f8"), ("score", "f8"), ("known", "i8"), ("n", "i8"), ("train", "?")])
_BACK = np.dtype([("row", "u2"), ("known", "u2"), ("score", "f8"), ("base", "f8")])


def _training_count(key: np.ndarray, train: np.ndarray) -> np.ndarray:
    """For every item the number of training items with its key."""
    order = np.argsort(key)
    k = key[order]
    new = np.append(True, k[1:] != k[:-1])
    group = np.cumsum(new) - 1
    out = np.empty(len(key), np.int64)
    out[order] = np.bincount(group, weights=train[order])[group].astype(np.int64)
    return out


def _weigh(shared):
    """All steps of one bucket: count its arcs and rare words, weigh the steps, sum them per block and row."""
    def run(key, table):
        a: Automaton = shared.value
        blocks, back = [], []
        for kind in (0, 1):
            t = table.filter(pa.compute.equal(table["kind"], kind))
            if not t.num_rows:
                continue
            flag = [np.frombuffer(x.as_buffer(), np.uint16) for x in t["flag"]]
            length = np.array([len(f) for f in flag])
            flags = np.concatenate(flag)
            row, train = flags & np.uint16(0x7FFF), (flags >> np.uint16(15)).astype(np.float64)
            word = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32 if kind == 0 else np.uint64) for x in t["word"]])
            raw = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in t["state"]]).reshape(-1, 6)
            state = np.zeros((len(raw), 8), np.uint8)
            state[:, :6] = raw
            pair = _training_count(combine(state.view(np.uint64).reshape(-1), word.astype(np.uint64)), train)
            count = a.counts[word] if kind == 0 else _training_count(word, train)
            score = a.arc(pair, count)
            base = np.zeros(len(score))
            if kind == 1:
                base = np.log10(a.p(count))
                score = score - a.leave(count)              # a rare word is never the end
            known = (count > 0) if kind == 1 else np.zeros(len(score), bool)
            lo = 0
            for block, n in zip(t["block"].to_pylist(), length.tolist()):
                r = row[lo:lo + n]
                hit = np.flatnonzero(np.bincount(r))
                out = np.zeros(len(hit), _BACK)
                out["row"] = hit
                out["score"] = np.bincount(r, weights=score[lo:lo + n])[hit]
                out["base"] = np.bincount(r, weights=base[lo:lo + n])[hit]
                # at most 65535 at once; a longer text's rare words count in several rows
                k = np.bincount(r, weights=known[lo:lo + n])[hit].astype(np.int64)
                blocks.append(block)
                out["known"] = np.minimum(k, 65535)
                back.append(out.tobytes())
                while (k := k - 65535).max(initial=0) > 0:
                    more = np.zeros((k > 0).sum(), _BACK)
                    more["row"], more["known"] = hit[k > 0], np.minimum(k[k > 0], 65535)
                    blocks.append(block)
                    back.append(more.tobytes())
                    k = np.maximum(k, 0)
                lo += n
        return pa.table([pa.array(blocks, pa.int64()), pa.array([1] * len(blocks), pa.int32()), pa.array(back, pa.binary()),
                         pa.array([None] * len(blocks), pa.binary()), pa.array([None] * len(blocks), pa.binary())],
                        names=["block", "kind", "sums", "ids", "valid"])
    return run


def _total(key, table):
    """The texts of one block: local sums plus what the buckets returned."""
    kind = table["kind"].to_pylist()
    at = kind.index(-1)
    local = np.frombuffer(table["sums"][at].as_buffer(), _LOCAL)
    ids = np.frombuffer(table["ids"][at].as_buffer(), np.int64)
    valid = np.frombuffer(table["valid"][at].as_buffer(), bool)
    n = len(local)
    back = [np.frombuffer(x.as_buffer(), _BACK) for k, x in zip(kind, table["sums"]) if k != -1]
    back = np.concatenate(back) if back else np.zeros(0, _BACK)
    order = np.lexsort((back["base"], back["score"], back["row"]))   # the same sum whatever the order of arrival
    back = back[order]
    add = lambda name: np.bincount(back["row"], weights=back[name], minlength=n)
    return pa.table([pa.array(ids, mask=~valid), pa.array(~local["train"]), pa.array(local["n"].astype(np.int64)),
                     pa.array((local["known"] + add("known")).astype(np.int64)),
                     pa.array(local["base"] + add("base")), pa.array(local["score"] + add("score"))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and counts of at most ``most`` of the most frequent words: all from the least count that fits."""
    level = F.floor(F.log2("c") * 32).cast("int")
    hist = sorted(counts.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    total, least = 0, None
    for level_, n in hist:
        if total + n > most:
            break
        total, least = total + n, level_
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    t = counts.filter(level >= least).toArrow()
    return t["w"].to_numpy().view(np.uint64), t["c"].to_numpy()


def score_documents(docs: DataFrame, mod: int = 7, out: int = 2, prior: float = PRIOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned from rows with crc32(id) % mod != out."""
    spark = docs.sparkSession
    base = id_text(docs)

    def words(batches):
        yield from _count((x for x in _blocks(batches, mod, out)), lambda ids, train, ch: _trained(tokens(ch), train)[0], ["w", "c"])

    counts = cut_lineage(base.mapInArrow(words, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")))
    v, n = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    gather(spark)
    words_, counts_ = frequent(counts, HOT)
    # the end of a text is a token like any other, but must be known to every task
    if n and not (words_ == END).any():
        c = counts.filter(F.col("w") == int(END.astype(np.int64))).first()[1]
        words_, counts_ = np.append(words_, END), np.append(counts_, c)
    automaton = Automaton(words_, counts_, n, v, prior)
    light = spark.sparkContext.broadcast(automaton)

    def arcs(batches):
        a = light.value

        def keys(ids, train, ch):
            tok, state, _ = _trained(tokens(ch), train)
            return a.core(tok, state, a.ranks(tok))[1].view(np.uint64)
        yield from _count(_blocks(batches, mod, out), keys, ["k", "c"])

    found = base.mapInArrow(arcs, "k long, c long").groupBy("k").agg(F.sum("c").alias("c")).toArrow()
    dense = np.zeros(automaton.side ** 2, np.int64)
    dense[found["k"].to_numpy()] = found["c"].to_numpy()
    automaton.arcs = dense
    shared = spark.sparkContext.broadcast(automaton)
    release(counts)
    gather(spark)

    buckets = max(LEAST_BUCKETS, math.ceil(n / STEPS_A_BUCKET))
    steps = base.mapInArrow(_steps(shared, mod, out, buckets), _STEP)
    local = F.col("bucket") == -1
    # local rows spread over the blocks instead of meeting in one bucket
    group = F.when(local, -1 - F.pmod("block", F.lit(buckets))).otherwise(F.col("bucket"))
    weigh = _weigh(shared)

    def bucket(key, table):
        mine = table.filter(pa.compute.equal(table["bucket"], -1))
        if mine.num_rows:
            return pa.table([mine["block"], mine["kind"], mine["flag"], mine["word"], mine["state"]],
                            names=["block", "kind", "sums", "ids", "valid"])
        return weigh(key, table)

    back = steps.withColumn("g", group).groupBy("g").applyInArrow(bucket, "block long, kind int, sums binary, ids binary, valid binary")
    return back.groupBy("block").applyInArrow(
        _total, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double") \
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _trained(steps, train):
    tok, state, row = steps
    keep = train[row]
    return tok[keep], state[keep], row[keep]


def op1_lm_score(spark, sf_dir) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


ORACLE_SQL = None
