"""Language identification with language-bitmask n-gram filters.

For every language the n-grams (windows of four bytes of the lower-cased text,
anything but letters read as a space) that make up at least ``MIN_SHARE`` of
its training windows, and at least ``MIN_RATIO`` of the share they have in
any language, form its set.  All sets live in one bit-sliced Bloom filter: a
slot holds one bit per language, and the AND of an n-gram's slots is the mask
of all languages that contain it.  A text's windows are looked up once; the
number of set bits per language, less the false positives that the fill of
the language's slice makes likely, over the share of windows a text of that
language is expected to hit, is its evidence, and the largest wins.

The sets are bounded by 1 / MIN_SHARE n-grams a language, whatever the corpus.
Counting is distributed and covers all training texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if no training row has a language; ties go to the first
language in code-point order; rows are independent, so null ids (which count
as the empty id text for the hold-out rule) and repeated rows are kept; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .common import crc_mod, documents, id_text
from .lm_score import _merge
from .words import Chunk, mix, row_of, text_chunks

MIN_SHARE = 2e-5
MIN_RATIO = 0.25
SLOTS = 1 << 20
HASHES = 3

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def windows(ch: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of all four-byte windows inside the texts that hold no two spaces in a row."""
    b = _FOLD[ch.data]
    if len(b) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    capital = (ch.data[1:] >= 0x80) & (ch.data[1:] <= 0x9E) & (ch.data[:-1] == 0xC3) & (ch.data[1:] != 0x97)
    b[1:][capital] += 32                                # Latin-1 capitals
    w = b.astype(np.uint32)
    key = w[:-3] | w[1:-2] << np.uint32(8) | w[2:-1] << np.uint32(16) | w[3:] << np.uint32(24)
    row = row_of(ch.offsets)
    space = b == 32
    pair = space[:-1] & space[1:]
    ok = ~(pair[:-2] | pair[1:-1] | pair[2:]) & (row[:-3] == row[3:])
    return key[ok], row[:-3][ok]


def _counts(mod: int, out: int):
    """(lang, key, count) of the training rows, merged per task."""
    def run(batches):
        held: dict[str, tuple[list, list]] = {}
        size = 0

        def flush():
            for lang, (k, c) in sorted(held.items()):
                k, c = _merge(k, c)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.astype(np.int64)), pa.array(c)],
                                                 ["lang", "key", "c"])

        for b in batches:
            train = crc_mod(b.column(0), mod) != out
            lang = b.column(2).to_pylist()
            for ch in text_chunks(b.column(1)):
                key, row = windows(ch)
                mine = lang[ch.first:ch.first + ch.rows]
                names = sorted({x for x in mine if x is not None})
                number = np.array([names.index(x) if x is not None else -1 for x in mine])
                number[~train[ch.first:ch.first + ch.rows]] = -1
                for i, name in enumerate(names):
                    k, c = np.unique(key[number[row] == i], return_counts=True)
                    ks, cs = held.setdefault(name, ([], []))
                    ks.append(k)
                    cs.append(c)
                    if len(ks) > 16:
                        k, c = _merge(ks, cs)
                        held[name] = ([k], [c])
            size = sum(len(k) for ks, _ in held.values() for k in ks)
            if size > 4_000_000:
                yield from flush()
                held.clear()
        yield from flush()
    return run


class Filters:
    """The bit-sliced filter of all languages."""

    def __init__(self, languages: list[str], sets: list[np.ndarray], expected: np.ndarray):
        self.languages, self.expected = languages, np.maximum(expected, 1e-9)
        self.words = max(1, -(-len(languages) // 8))          # bytes of a mask
        self.slots = np.zeros((SLOTS, self.words), np.uint8)
        for i, keys in enumerate(sets):
            for s in self._places(keys):
                self.slots[s, i // 8] |= np.uint8(1 << i % 8)
        fill = np.array([((self.slots[:, i // 8] >> (i % 8)) & 1).mean() for i in range(len(languages))])
        self.false = fill ** HASHES
        self.bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)

    @staticmethod
    def _places(keys: np.ndarray):
        h = mix(keys.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        return [((h >> np.uint64(21 * i)) % np.uint64(SLOTS)).astype(np.int64) for i in range(HASHES)]

    def evidence(self, key: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Per row and language the corrected share of windows that the language contains."""
        n = np.maximum(np.bincount(row, minlength=rows), 1)[:, None]
        hits = np.zeros((rows, self.words * 8), np.int64)
        places = self._places(key)
        for w in range(self.words):
            mask = self.slots[places[0], w]
            for p in places[1:]:
                mask = mask & self.slots[p, w]
            hits[:, 8 * w:8 * w + 8] = np.bincount(row * 256 + mask, minlength=rows * 256).reshape(rows, 256) @ self.bits
        hits = hits[:, :len(self.languages)]
        true = (hits - n * self.false) / (1 - np.minimum(self.false, 0.999999))
        return np.maximum(true / n, 0) / self.expected


def learn(docs: DataFrame, mod: int = 4, out: int = 2) -> Filters:
    """Filters from the rows with a language and crc32(id) % mod != out."""
    rows = id_text(docs, F.col("lang").cast("string").alias("lang")).filter("lang is not null")
    counts = cut_lineage(rows.mapInArrow(_counts(mod, out), "lang string, key long, c long")
                         .groupBy("lang", "key").agg(F.sum("c").alias("c")))
    totals = counts.groupBy("lang").agg(F.sum("c").alias("total"))        # one row per language
    share = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("c") / F.col("total"))
    best = share.groupBy("key").agg(F.max("share").alias("best")).filter(F.col("best") >= MIN_SHARE)
    kept = share.filter(F.col("share") >= MIN_SHARE).join(best, "key").filter(F.col("share") >= MIN_RATIO * F.col("best"))
    t = kept.select("lang", "key", "share").toArrow()                     # at most 1 / MIN_SHARE rows a language
    release(counts)
    lang = np.array(t["lang"].to_pylist(), object)
    key, part = t["key"].to_numpy(), t["share"].to_numpy()
    names = sorted(set(lang.tolist()))
    return Filters(names, [key[lang == x] for x in names], np.array([part[lang == x].sum() for x in names]))


def predict(docs: DataFrame, filters: Filters, mod: int = 4, out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    rows = id_text(docs).withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def run(batches):
        f: Filters = shared.value
        names = np.array([*f.languages, "und"], object)
        for b in batches:
            held = crc_mod(b.column(0), mod) == out
            letters = b.column(2).to_numpy(zero_copy_only=False)
            for ch in text_chunks(b.column(1)):
                part = slice(ch.first, ch.first + ch.rows)
                if len(f.languages):
                    e = f.evidence(*windows(ch), ch.rows)
                    at = e.argmax(1)
                    total = e.sum(1)
                    score = np.where(total > 0, e.max(1) / np.maximum(total, 1e-300), 1 / len(f.languages))
                else:
                    at, score = np.zeros(ch.rows, np.int64), np.zeros(ch.rows)
                known = letters[part] & (len(f.languages) > 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(ch.first, ch.rows), pa.array(held[part]),
                     pa.array(names[np.where(known, at, len(f.languages))], pa.string()), pa.array(np.where(known, score, 0.0))],
                    ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op2_language_id(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, learn(docs))


ORACLE_SQL = None
