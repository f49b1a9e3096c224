"""Toxicity scores of texts restored through a noisy channel.

Writers disguise words by look-alike characters (``1d10t``), by spacing
(``i d i o t``) and by repetition (``idiooot``, ``iddiot``), or by several of
these at once (``1 d d 1 0 t``).  Every suspicious span is
read as a lattice: each observed character stands for itself, for a letter it
resembles, or for nothing (a repeated letter or a separator); a separator may
also stay as a word border (``a l o s e r`` is ``a loser``).  Viterbi
decoding finds the most likely path under the channel's costs and a character
trigram model of the corpus' ordinary words.  The restored text is then
scored: words and word beginnings whose rate differs between toxic and clean
labelled texts carry log ratios, and a logistic model over the text's sums of
them gives the probability.

Character model, lexicon and logistic weights are fitted on all labelled rows,
one of each group of look-alike texts: counts and Newton sums are added up by
Spark; what is broadcast or collected is bounded by fixed table sizes.

Defined cases: a null or empty text has no evidence and gets the score that
the model gives to that; with no usable labels every score is 0; rows are
independent, so null ids (which count as the empty id text for the hold-out
rule) and repeated rows are kept; documents are never multiplied by repeated
label rows, and rows with null labels are not learned from; other columns are
not read by ``score`` and are kept by ``keep_clean``.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import DICTIONARY_ROWS, cut_lineage, release
from .common import crc_mod, crc_of, documents, gather, id_text
from .lm_score import _merge
from .near_dedup import shingle_sets
from .words import _LOWER, Chunk, Spans, combine, row_of, text_chunks

TASK_ROWS = 4_000        # labelled rows of a task
ASKED = 2_000_000        # units of toxic texts looked up in clean ones at a time
HELD = 2_000_000         # counts that a task merges before it hands some on
LEXICON = 4096
LEAST_TEXTS = 3          # toxic texts that must hold a lexicon entry
LEAST_RATIO = 3.0
PREFIXES = (4, 5, 6, 7, 8, 9)

# Look-alikes of the channel: fixed values.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
COST_LOOK, COST_REPEAT, COST_DROP, COST_DIGIT = 1.0, 0.7, 1.5, 7.0
COST_TWICE = 4.0         # a character written twice; letters and digits cost COST_REPEAT each from three on
COST_KEPT, COST_MARK = 7.0, 0.5      # a symbol that means itself; "!" at the end, or another one of three and more
COST_GAP = 1.0           # a separator put between two letters of a word
# a separator that is a word border, after a word of two and more letters (then two words in a row are spaced);
# after one letter it is plain text
COST_BORDER = 6.0
COST_NUMBER = 0.5        # a digit in a span of digits
_SEPARATORS = " .-_*"

_LETTER = "a-zß-öø-ÿ"
_SYMBOL = "@$!|+"
_ANY = f"[{_LETTER}0-9{_SYMBOL}]"
_SUSPICIOUS = re.compile(
    rf"(?<!{_ANY})(?:({_ANY})\1*(?:[ .\-_*]({_ANY})\2*){{2,}}(?![{_SYMBOL}]*[{_LETTER}0-9])"   # s p a c e d
    rf"|(?={_ANY}*?(?:[{_LETTER}][01345789{_SYMBOL}]+(?![0-9])|[{_LETTER}][0-9{_SYMBOL}]+[{_LETTER}]|(?<![0-9{_SYMBOL}])[0-9{_SYMBOL}]++[{_LETTER}]|([{_LETTER}])\3)){_ANY}+)")
CLASSES = 96


def _class(b: np.ndarray) -> np.ndarray:
    """Byte classes of the character model: 0 border, 1-26 letters, 27-90 continuation bytes, 91-95 leading bytes."""
    return _CLASS[b]


_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[128:192] = np.arange(27, 91)
_CLASS[192:256] = 91 + np.arange(64) % 5


class Channel:
    """The character model and the lattice decoder."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(CLASSES, CLASSES, CLASSES).astype(np.float64)
        uni = (c.sum((0, 1)) + 0.5) / (c.sum() + 0.5 * CLASSES)
        bi = (c.sum(0) + 2 * uni) / (c.sum(0).sum(1, keepdims=True) + 2)
        tri = (c + 2 * bi[None]) / (c.sum(2, keepdims=True) + 2)
        self.open((-np.log(tri)).astype(np.float32))

    def open(self, cost: np.ndarray) -> Channel:
        self.cost = cost
        self.flat = memoryview(cost.reshape(-1))
        self.decode = lru_cache(100_000)(self._decode)
        self.word = lru_cache(400_000)(self._word)
        return self

    def _word(self, token: bytes) -> bytes | None:
        """The restoration of one lower-cased token, null if it stays as it is."""
        new = self.restore(token.decode()).encode()
        return None if new == token else new

    def _decode(self, seen: str) -> str:
        """The most likely restoration of one suspicious span."""
        letters = [x for x in seen if x not in _SEPARATORS]
        runs = [n for _, g in groupby(letters) for n in [len(list(g))] for _ in range(n)]
        number = all(x.isdigit() for x in letters)
        alpha = [i for i, x in enumerate(letters) if x.isalpha()]
        flat = self.flat
        paths = {(0, 0): (0.0, "")}
        nth = -1
        for ch in seen:
            options = []
            again = None
            if ch in _SEPARATORS:
                options += [("", COST_GAP), (ch, 0.0)]
            else:
                nth += 1
                again = COST_REPEAT if runs[nth] > 2 and ch.isalnum() else COST_TWICE
                if ch.isalpha():
                    options.append((ch, 0.0))
                else:
                    options += [(x, COST_LOOK) for x in LOOKS.get(ch, "")]
                    if ch.isdigit():
                        options.append((ch, COST_NUMBER if number else COST_DIGIT))
                    elif alpha and alpha[0] < nth < alpha[-1]:
                        options.append(("", COST_DROP))
                    else:
                        ends = nth and not any(map(str.isalnum, letters[nth:]))
                        options.append((ch, COST_MARK if (ends if ch == "!" else runs[nth] > 2) else COST_KEPT))
            same = ch if ch.isalpha() else LOOKS.get(ch, "")
            options = [(x, [int(k) for k in _CLASS[list(x.encode())]], extra) for x, extra in options]
            new: dict = {}
            for (p, q), (cost, out) in paths.items():
                # a letter like the last one read may be its repetition
                for x, classes, extra in options + [("", (), again)] if again and out and out[-1] in same else options:
                    a, b, total = p, q, cost + extra
                    if x == ch and x in _SEPARATORS and out[-2:].isalpha() and len(out) > 1:
                        total += COST_BORDER
                    for c in classes:
                        if out and not b and not c:      # one border, however wide
                            continue
                        total += flat[(a * CLASSES + b) * CLASSES + c]
                        a, b = b, c
                    state = (a, b)
                    if state not in new or (total, out + x) < new[state]:
                        new[state] = (total, out + x)
            paths = new
        return min((c + float(self.cost[p, q, 0]), out) for (p, q), (c, out) in paths.items())[1]

    def restore(self, text: str) -> str:
        """The lower-cased text with every suspicious span decoded."""
        return _SUSPICIOUS.sub(lambda m: self.decode(m[0]), text.lower())


_AL = np.zeros(256, bool)
_AL[97:123] = _AL[65:91] = _AL[128:] = True


_PART = np.zeros(256, bool)     # bytes of the pattern's characters; a letter beyond ASCII is 0xC3 and one more
_PART[[*range(48, 58), *range(97, 123), *(ord(c) for c in _SYMBOL), 0xC3]] = True
_GAP = np.zeros(256, bool)
_GAP[[ord(c) for c in _SEPARATORS]] = True


def _lower(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in lower case, letters of U+00C0 to U+00DE too, and which bytes belong to other characters beyond ASCII."""
    low = _LOWER[data]
    second = np.zeros(len(low), bool)
    second[1:] = low[:-1] == 0xC3
    up = second & (low >= 0x80) & (low <= 0x9E) & (low != 0x97)
    low[up] += 0x20
    letter = second & (low >= 0x9F) & (low <= 0xBF) & (low != 0xB7)
    first = np.zeros(len(low), bool)
    first[:-1] = letter[1:]
    return low, (low >= 0x80) & ~letter & ~first


def _scan(low: np.ndarray, other: np.ndarray, offsets: np.ndarray):
    """(start, end) of the tokens that may be suspicious, and the rows that may hold a spaced span.

    A token is a run of the pattern's characters within a row.  It may be
    suspicious if a look-alike stands beside a letter or a letter twice; a row
    may hold a spaced span if three single characters (or one repeated) follow
    each other with one separator between them.
    """
    n = len(low)
    part = _PART[low]
    cont = np.zeros(n, bool)
    cont[1:] = (low[:-1] == 0xC3) & ~other[:-1]
    part = (part | cont) & ~other
    new = part.copy()
    new[1:] &= ~part[:-1]
    begin = offsets[:-1][offsets[:-1] < n]
    new[begin] = part[begin]
    start = np.flatnonzero(new)
    if not len(start):
        return start, start, start
    stop = part.copy()
    stop[:-1] &= ~part[1:] | new[1:]
    end = np.flatnonzero(stop) + 1
    # one place per character
    place = np.flatnonzero(part & ~cont)
    wide = low[place] == 0xC3
    letter = wide | ((low[place] >= 97) & (low[place] <= 122))
    value = low[place].astype(np.int16)
    value[wide] = low[place[wide] + 1]
    value[wide] += 256
    inside = np.ones(len(place), bool)          # follows a character of the same token
    first = np.searchsorted(place, start)
    inside[first] = False
    equal = np.zeros(len(place), bool)
    equal[1:] = inside[1:] & (value[1:] == value[:-1])
    mixed = np.zeros(len(place), bool)
    mixed[1:] = inside[1:] & (letter[1:] != letter[:-1])
    odd = np.add.reduceat((mixed | (equal & letter)).astype(np.int64), first) > 0
    solid = letter | ((low[place] >= 48) & (low[place] <= 57))   # symbols behind a single character do not count
    single = np.add.reduceat((inside & ~equal & solid).astype(np.int64), first) == 0
    row = np.searchsorted(offsets, start, "right") - 1
    follows = np.zeros(len(start), bool)        # one separator after the token before, in one row
    follows[1:] = (start[1:] - end[:-1] == 1) & _GAP[low[start[1:] - 1]] & (row[1:] == row[:-1])
    spaced = np.zeros(len(start), bool)
    spaced[2:] = single[2:] & single[1:-1] & single[:-2] & follows[2:] & follows[1:-1]
    return start[odd], end[odd], np.unique(row[spaced])


def restored(ch: Chunk, channel: Channel) -> Chunk:
    """The chunk with its suspicious spans decoded and everything in lower case.

    A token outside spaced spans is decoded once and remembered; rows that may
    hold a spaced span, or an upper-case letter beyond U+00DE, are read whole.
    """
    low, other = _lower(ch.data)
    start, end, whole = _scan(low, other, ch.offsets)
    # other characters may change in lower case (and be two bytes): such rows are read whole as well
    if other.any():
        at = np.unique(np.searchsorted(ch.offsets, np.flatnonzero(other & (low != 0xC3)), "right") - 1)
        raw, off = ch.data.tobytes(), ch.offsets
        rows = [r for r in at.tolist() if (t := raw[off[r]:off[r + 1]].decode("utf-8", "replace")).lower().encode() != low[off[r]:off[r + 1]].tobytes()]
        whole = np.union1d(whole, np.array(rows, np.int64))
    if not len(start) and not len(whole):
        return Chunk(ch.first, low, ch.offsets)
    skip = np.zeros(ch.rows, bool)
    skip[whole] = True
    row = np.searchsorted(ch.offsets, start, "right") - 1
    keep = ~skip[row]
    raw, word = low.tobytes(), channel.word
    change = [(a, b, new) for a, b in zip(start[keep].tolist(), end[keep].tolist()) if (new := word(raw[a:b])) is not None]
    for r in whole.tolist():
        a, b = int(ch.offsets[r]), int(ch.offsets[r + 1])
        change.append((a, b, channel.restore(ch.data[a:b].tobytes().decode("utf-8", "replace")).encode()))
    if not change:
        return Chunk(ch.first, low, ch.offsets)
    change.sort()
    parts, at = [], 0
    grown = np.zeros(len(low) + 1, np.int64)     # how much longer the text is behind each byte
    for a, b, new in change:
        parts += [raw[at:a], new]
        grown[b] += len(new) - (b - a)
        at = b
    parts.append(raw[at:])
    return Chunk(ch.first, np.frombuffer(b"".join(parts), np.uint8), ch.offsets + np.cumsum(grown)[ch.offsets])


def _cores(ch: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words less what is no letter or digit at their edges."""
    starts, ends, first = ch.words()
    b = ch.data
    good = _AL[b] | ((b >= 48) & (b <= 57))
    at = np.arange(len(b))
    after = np.minimum.accumulate(np.where(good, at, len(b))[::-1])[::-1] if len(b) else at
    upto = np.maximum.accumulate(np.where(good, at, -1)) if len(b) else at
    s, e = after[starts], upto[ends - 1] + 1
    ok = s < e
    ok &= (s < ends) & (e > starts)
    return s[ok], e[ok], row_of(first)[ok]


def _units(ch: Chunk):
    """Hashes of the words (whole, and each long enough beginning), with their word numbers."""
    s, e, row = _cores(ch)
    spans = Spans(ch.data)
    yield combine(spans.hash(s, e), np.full(len(s), 1, np.uint64)), np.arange(len(s)), row
    for n in PREFIXES:
        at = np.flatnonzero(e - s >= n)
        yield spans.hash(s[at], s[at] + n), at, row


class Lexicon:
    """Units, their log ratios, and a small bitmap that rules most words out."""

    def __init__(self, units: np.ndarray, ratio: np.ndarray):
        order = np.argsort(units)
        self.units, self.ratio = units[order], ratio[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(units & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in h, entry numbers) of the lexicon's units."""
        at = np.flatnonzero(self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(at) or not len(self.units):
            return at[:0], at[:0]
        i = np.minimum(np.searchsorted(self.units, h[at]), len(self.units) - 1)
        ok = self.units[i] == h[at]
        return at[ok], i[ok]


def features(ch: Chunk, lexicon: Lexicon) -> np.ndarray:
    """Per row: number of words, sum of the words' best log ratios, number of words with one, sum of its strong ones."""
    best, row = None, None
    for h, word, row in _units(ch):
        if best is None:
            best = np.zeros(len(h))
        at, i = lexicon.find(h)
        np.maximum.at(best, word[at], lexicon.ratio[i])
    n = np.bincount(row, minlength=ch.rows)
    total = np.bincount(row, weights=best, minlength=ch.rows)
    hits = np.bincount(row, weights=best > 0, minlength=ch.rows)
    strong = np.bincount(row, weights=best * (best > 3.5), minlength=ch.rows)
    return np.stack([n, total, hits, strong], axis=1).astype(np.float64)


def _design(f: np.ndarray) -> np.ndarray:
    n, total, hits, strong = f.T
    n1 = n + 1
    return np.stack([np.ones(len(f)), np.log1p(total), np.log1p(hits), np.log1p(strong), total / n1 * 10, hits / n1 * 10,
                     strong / n1 * 10, np.log(n1), np.log1p(hits) * np.log(n1) / 5, np.log1p(strong) * np.log(n1) / 5], axis=1)


def _fit(measured: DataFrame) -> np.ndarray:
    """Logistic weights by Newton steps with a small ridge; gradient and Hessian are summed task by task."""
    def sums(w):
        def run(batches):
            g, h = np.zeros(len(w)), np.zeros((len(w), len(w)))
            for b in batches:
                y = b.column(0).to_numpy().astype(np.float64)
                x = _design(np.stack([c.to_numpy() for c in b.columns[1:]], axis=1))
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                g += x.T @ (p - y)
                h += (x * (p * (1 - p))[:, None]).T @ x
            yield pa.RecordBatch.from_arrays([pa.array([np.r_[g, h.ravel()].tolist()], pa.list_(pa.float64()))], ["s"])
        return run

    k = _design(np.zeros((1, 4))).shape[1]
    w = np.zeros(k)
    for _ in range(30):
        total = sum(np.array(r["s"]) for r in measured.mapInArrow(sums(w), "s array<double>").collect())   # 110 numbers a task
        g, h = total[:k] + 1e-2 * w, total[k:].reshape(k, k) + 1e-2 * np.eye(k)
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, channel: Channel | None, lexicon: Lexicon | None, weights: np.ndarray | None):
        self.channel, self.lexicon, self.weights = channel, lexicon, weights

    def score(self, ch: Chunk) -> np.ndarray:
        if self.weights is None:
            return np.zeros(ch.rows)
        x = _design(features(restored(ch, self.channel), self.lexicon))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _labelled(docs: DataFrame, labels: DataFrame, mod: int, out: int) -> DataFrame:
    """doc_id, text, toxic of the labelled training rows, one for each value of a minwise shingle."""
    spark = docs.sparkSession
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
                .filter("toxic is not null and doc_id is not null").filter(crc_of("doc_id", mod) != out) \
                .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = lab.count()
    few = n <= DICTIONARY_ROWS
    known = id_text(docs).join(F.broadcast(lab) if few else lab, "doc_id")

    def minwise(batches):
        for b in batches:
            for ch in text_chunks(b.column(1)):
                s, first = shingle_sets(ch, 5)
                key = np.zeros(ch.rows, np.uint64)
                full = np.flatnonzero(np.diff(first))
                if len(full):
                    key[full] = np.minimum.reduceat(s, first[full])
                cols = [c.slice(ch.first, ch.rows) for c in b.columns]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(key.view(np.int64))], ["doc_id", "text", "toxic", "m"])

    rows = known.select("doc_id", "text", "toxic").mapInArrow(minwise, "doc_id long, text string, toxic int, m long")
    stored = None if few else cut_lineage(rows)
    if stored is not None:
        gather(spark)     # all texts were shuffled for the join
        rows = stored
    one = rows.groupBy("m").agg(F.min(F.struct("doc_id", "toxic", "text")).alias("r"))
    out_ = cut_lineage(one.select("r.doc_id", "r.text", "r.toxic").repartition(max(8, spark.sparkContext.defaultParallelism, -(-n // TASK_ROWS))))
    release(stored)
    return out_


def _counts(held: list) -> tuple[list, int]:
    """The held (units, counts, text counts) merged into one, and its length."""
    k, c = _merge([h[0] for h in held], [h[1] for h in held])
    _, d = _merge([h[0] for h in held], [h[2] for h in held])
    return [(k, c, d)], len(k)


def learn(docs: DataFrame, labels: DataFrame, mod: int = 5, out: int = 0) -> Model:
    """Channel, lexicon and weights from the labelled rows with crc32(id) % mod != out."""
    spark = docs.sparkSession
    rows = _labelled(docs, labels, mod, out)
    per_class = dict(rows.groupBy("toxic").count().collect())
    if not per_class.get(1) or not per_class.get(0):
        release(rows)
        return Model(None, None, None)

    def characters(batches):
        total = np.zeros(CLASSES ** 3, np.int64)
        for b in batches:
            for ch in text_chunks(b.column(1)):
                c = np.concatenate([[0, 0], _CLASS[_LOWER[ch.data]]])
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES ** 3)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["k", "c"])

    t = rows.mapInArrow(characters, "k long, c long").groupBy("k").agg(F.sum("c").alias("c")).toArrow()
    counts = np.zeros(CLASSES ** 3, np.int64)
    counts[t["k"].to_numpy()] = t["c"].to_numpy()
    channel = Channel(counts)
    light = spark.sparkContext.broadcast(counts)

    def restore(batches):
        channel = Channel(light.value)
        for b in batches:
            for ch in text_chunks(b.column(1)):
                r = restored(ch, channel)
                text = pa.LargeStringArray.from_buffers(r.rows, pa.py_buffer(r.offsets.astype(np.int64)), pa.py_buffer(r.data.tobytes()))
                yield pa.RecordBatch.from_arrays([b.column(2).slice(ch.first, ch.rows), text.cast(pa.string())], ["toxic", "text"])

    # every text is restored once, the passes below read the result
    raw, rows = rows, cut_lineage(rows.mapInArrow(restore, "toxic int, text string"))
    release(raw)

    def units(wanted):
        def run(batches):
            want = wanted.value if wanted is not None else None
            held: list = []
            size = words = 0
            names = ["u", "c", "d"]
            for b in batches:
                for ch in text_chunks(b.column(1)):
                    for i, (h, word, row) in enumerate(_units(ch)):
                        if i == 0:
                            words += len(h)
                        r = row[word]
                        if want is not None:
                            at, _ = want.find(h)
                            h, r = h[at], r[at]
                        u, c = np.unique(h, return_counts=True)
                        pairs = np.unique(combine(h, r.astype(np.uint64)), return_index=True)[1]
                        held.append((u, c, np.unique(h[pairs], return_counts=True)[1]))
                        size += len(u)
                    if size > HELD:
                        held, size = _counts(held)
                        if size > HELD // 2:
                            yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), *map(pa.array, held[0][1:])], names)
                            held, size = [], 0
            if held:
                (k, c, d), = _counts(held)[0]
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c), pa.array(d)], names)
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([words]), pa.array([0])], names)
        return run

    def counted(part: DataFrame, wanted) -> DataFrame:
        return part.mapInArrow(units(wanted), "u long, c long, d long").groupBy("u").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))

    def number_of_words(table: DataFrame) -> float:
        return float(table.filter("u = 0").agg(F.sum("c")).first()[0] or 0)

    # units of toxic texts first, then only those in clean texts, a bounded number at a time
    toxic = cut_lineage(counted(rows.filter("toxic = 1"), None).filter((F.col("d") >= LEAST_TEXTS) | (F.col("u") == 0)))
    nt = number_of_words(toxic)
    slices = max(1, -(-toxic.count() // ASKED))
    parts = []
    for j in range(slices):
        u = toxic.filter((F.col("u") != 0) & (F.pmod(F.xxhash64("u"), F.lit(slices)) == j)).select("u").toArrow()["u"].to_numpy().view(np.uint64)
        asked = spark.sparkContext.broadcast(Lexicon(u, np.zeros(len(u))))
        parts.append(cut_lineage(counted(rows.filter("toxic = 0"), asked)))
    nc = number_of_words(parts[0])
    clean = parts[0]
    for p in parts[1:]:
        clean = clean.unionByName(p)
    both = toxic.filter("u != 0").join(clean.filter("u != 0").select("u", F.col("c").alias("cc")), "u", "left")
    # a unit counts with the lower end of its ratio
    ratio = F.log(((F.col("c") + 0.5) / (nt + 1)) / ((F.coalesce("cc", F.lit(0)) + 0.5) / (nc + 1))) - 1.0 / F.sqrt("d")
    best = both.select("u", "d", ratio.alias("ratio")).filter(F.col("ratio") >= float(np.log(LEAST_RATIO))) \
               .orderBy((F.col("ratio") * F.log1p("d")).desc(), "u").limit(LEXICON).toArrow()
    lexicon = Lexicon(best["u"].to_numpy().view(np.uint64), best["ratio"].to_numpy())
    for p in (toxic, *parts):
        release(p)
    shared = spark.sparkContext.broadcast(lexicon)

    def measure(batches):
        lexicon = shared.value
        for b in batches:
            for ch in text_chunks(b.column(1)):
                f = features(ch, lexicon)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(ch.first, ch.rows), *(pa.array(c) for c in f.T)],
                                                 ["toxic", "n", "total", "hits", "strong"])

    measured = cut_lineage(rows.mapInArrow(measure, "toxic int, n double, total double, hits double, strong double"))
    weights = _fit(measured)
    release(rows)
    release(measured)
    return Model(channel, lexicon, weights)


def _share(spark, model: Model):
    return spark.sparkContext.broadcast((model.channel and model.channel.cost, model.lexicon, model.weights))


def _open(shared) -> Model:
    cost, lexicon, weights = shared.value
    channel = None
    if cost is not None:
        channel = Channel.__new__(Channel).open(cost)
    return Model(channel, lexicon, weights)


def score(docs: DataFrame, model: Model, mod: int = 5, out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = _share(docs.sparkSession, model)

    def run(batches):
        m = _open(shared)
        for b in batches:
            held = crc_mod(b.column(0), mod) == out
            for ch in text_chunks(b.column(1)):
                p = m.score(ch)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(ch.first, ch.rows), pa.array(held[ch.first:ch.first + ch.rows]),
                                                  pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                                 ["doc_id", "held_out", "score", "predicted"])

    return id_text(docs).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def deobfuscate(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the restored text."""
    shared = _share(docs.sparkSession, model)

    def run(batches):
        m = _open(shared)
        for b in batches:
            for ch in text_chunks(b.column(1)):
                r = restored(ch, m.channel) if m.channel else ch.lowered()
                text = r.data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(ch.first, ch.rows), pa.array([text[x:y].decode() for x, y in zip(r.offsets[:-1], r.offsets[1:])], pa.string())],
                    ["doc_id", "restored"])

    return id_text(docs).mapInArrow(run, "doc_id long, restored string")


def keep_clean(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents that score below ``least``, with all their columns (pipeline stage)."""
    shared = _share(docs.sparkSession, model)
    packed = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches):
        m = _open(shared)
        for b in batches:
            ok = [m.score(ch) < least for ch in text_chunks(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(np.concatenate(ok) if ok else np.zeros(0, bool)))], ["row"])

    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}").select("row.*")


def op7_toxicity(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, learn(docs, documents(spark, sf_dir, "labels")))


ORACLE_SQL = None
