"""Exact token counts at every prefix of every text, for a byte-level BPE vocabulary.

The encoding of a string ends in one definite token, and cutting that token
off leaves the encoding of the shorter string.  So one pass over a string
finds, for every prefix, its last token (the one vocabulary entry that ends
there and may follow the last token of the prefix before it) and its count:
the count of the prefix before it plus one.  Two entries may stand side by
side if the library's model gives exactly these two for their joined text.

A text is first cut into pre-tokens as the vocabulary's pattern cuts it; the
distinct pre-tokens of a batch are worked out once and remembered.  The count
of a text prefix is the count of the pre-tokens before it plus that of the
prefix of the pre-token it ends in, but for three kinds of place where the
prefix is cut otherwise than the whole text: the end of a run of white space
(the whole run is one pre-token there), inside the contractions of three
characters, and inside a special token, which is plain text until it is
complete.  The stored counts then answer, without encoding anything again,
how many tokens the first n characters have (``tokens_at``) and how many
characters fit a budget (``longest_within``).

Defined cases: a null text counts as empty and has the single prefix count 0;
an empty table gives no rows; null ids and repeated rows pass through row by
row; bytes that are no UTF-8 count as the replacement character; other columns
are not read by ``prefix_counts`` and are kept by ``truncate``.  Texts of any
length are counted whole; a long one is worked on in parts cut before white
space, where the pattern always cuts.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .byte_bpe import byte_characters
from .common import documents
from .words import Chunk, text_chunks

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
CACHED = 600_000  # pre-tokens and entry pairs a Python worker remembers; a memory bound, not a limit on texts
PART = 2 << 20    # bytes of a long text worked on at a time
SPACE, LETTER, NUMBER, OTHER, SPECIAL, UNSEEN = range(6)
# fixed values: the contractions of the pattern
SHORT = "stmd"
LONG = ("re", "ve", "ll")
LONG_BYTES = {b"'" + c.encode() for c in LONG}


class Counter:
    """Prefix counts over one vocabulary file of the tokenizers library."""

    def __init__(self, source: str):
        spec = json.loads(source)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] \
                or spec["model"]["type"] != "BPE":
            raise ValueError("prefix counts need a byte-level BPE file without a normaliser")
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = self.tokenizer.model.tokenize
        self.entries = list(spec["model"]["vocab"])
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special_bytes = {t.encode() for t in self.specials}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.trie: list = [{}, -1]  # of the entries' bytes: children by byte, and the entry that ends here
        for i, e in enumerate(self.entries):
            node = self.trie
            for c in e:
                node = node[0].setdefault(byte_of[c], [{}, -1])
            node[1] = i
        self.classes = np.full(0x110000, UNSEEN, np.uint8)
        self.pairs: dict[int, bool] = {}
        self.place: dict[bytes, int] = {}        # of a pre-token's counts in `flat`
        self.flat = np.zeros(0, np.int32)

    # -- one pre-token ------------------------------------------------------
    def _may_follow(self, a: int, b: int) -> bool:
        left = self.entries[a] if a >= 0 else ""
        out = self.merge(left + self.entries[b])
        return len(out) == (2 if left else 1) and (not left or out[0].value == left)

    def byte_counts(self, piece: bytes) -> list[int]:
        """Token counts of all byte prefixes of one pre-token, the empty one included."""
        n = len(piece)
        last, count, pairs = [-2] * (n + 1), [0] * (n + 1), self.pairs
        last[0] = -1
        for at in range(n):
            before, next_count = last[at], count[at] + 1
            children, end = self.trie[0], at
            while end < n and (child := children.get(piece[end])) is not None:
                children, entry = child
                end += 1
                if entry < 0 or last[end] != -2:
                    continue
                key = before << 32 | entry
                if (fits := pairs.get(key)) is None:
                    fits = pairs[key] = self._may_follow(before, entry)
                if fits:
                    last[end], count[end] = entry, next_count
        return count

    def _learn(self, pieces: list[bytes]) -> None:
        """Work out the pre-tokens that are not remembered."""
        if len(self.place) > CACHED:
            self.place.clear()
            self.flat = np.zeros(0, np.int32)
        if len(self.pairs) > CACHED:
            self.pairs.clear()
        new, base = [], len(self.flat)
        for piece in pieces:
            if piece in self.place:
                continue
            self.place[piece] = base + len(new)
            if piece in self.special_bytes:
                new += [1] * len(piece.decode())  # inside it, `counts` puts the counts of plain text
                continue
            count = self.byte_counts(piece)
            if piece.isascii():
                new += count[1:]
                if piece in LONG_BYTES:
                    new[-2] = 2
            else:
                new += [count[i] for i in range(1, len(piece)) if piece[i] & 0xC0 != 0x80]
                new.append(count[-1])
        if new:
            self.flat = np.concatenate([self.flat, np.array(new, np.int32)])

    # -- many texts ---------------------------------------------------------
    def _class_of(self, points: np.ndarray) -> np.ndarray:
        found = self.classes[points]
        for c in np.unique(points[found == UNSEEN]).tolist():
            ch = chr(c)
            self.classes[c] = next((k for k, probe in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.cut(probe + ch)) == 1), SPACE)
        return self.classes[points]

    def _pieces(self, text: str, borders: np.ndarray):
        """Start flags of pre-tokens, classes, and (first, last) characters of white-space runs that the pattern splits."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(points)
        cls = self._class_of(points)
        forced = np.zeros(n + 1, bool)
        forced[borders] = True
        forced[n] = True
        specials = []
        for sp in self.specials:
            at = text.find(sp)
            while at >= 0:
                # the text of a row may not reach into the next one, nor may special tokens overlap
                if not forced[at + 1:at + len(sp)].any() and not (cls[at:at + len(sp)] == SPECIAL).any():
                    cls[at:at + len(sp)] = SPECIAL
                    forced[at] = forced[at + len(sp)] = True
                    specials.append((at, at + len(sp)))
                    at = text.find(sp, at + len(sp))
                else:
                    at = text.find(sp, at + 1)
        start = forced.copy()
        start[1:n] |= cls[1:] != cls[:-1]
        run = np.flatnonzero(start)
        first, last = run[:-1], run[1:] - 1
        inner = (cls[first] == SPACE) & ~forced[last + 1]
        first, last = first[inner], last[inner]
        start[last] = True
        start[last[points[last] == 32] + 1] = False
        quote = np.flatnonzero(start[:n] & (points == 39))
        quote = quote[(quote + 1 < n) & ~forced[np.minimum(quote + 1, n)]]
        one = quote[np.isin(points[quote + 1], [ord(c) for c in SHORT])]
        two = quote[(quote + 2 < n) & ~forced[np.minimum(quote + 2, n)]]
        two = two[np.isin(points[two + 1].astype(np.int64) << 21 | points[np.minimum(two + 2, n - 1)], [ord(a) << 21 | ord(b) for a, b in LONG])]
        start[one + 1] = False
        start[one + 2] = True
        start[two + 1] = False
        start[two + 3] = True
        split = last > first
        return start[:n], cls, first[split], last[split], sorted(specials)

    def counts(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the counts of its prefixes of 1, 2, ... characters."""
        text = "".join(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        rows = np.concatenate([[0], np.cumsum(lengths)])
        if not text:
            return [np.zeros(0, np.int32) for _ in texts]
        start, cls, run_first, run_last, specials = self._pieces(text, rows)
        raw = text.encode()
        at_byte = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        at_byte = np.append(at_byte, len(raw))
        begin = np.flatnonzero(start)
        border = np.append(begin, len(start))
        spans = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(at_byte[border].astype(np.int64)), pa.py_buffer(raw)])
        coded = spans.dictionary_encode()
        code = coded.indices.to_numpy()
        values = coded.dictionary.to_pylist()
        piece_of = np.searchsorted(begin, run_first)
        runs = [raw[a:b] for a, b in zip(at_byte[run_first].tolist(), at_byte[run_last + 1].tolist())]
        self._learn(values + list(set(runs)))
        where = np.fromiter(map(self.place.__getitem__, values), np.int64, len(values))[code]
        length = np.diff(border)
        total = self.flat[where + length - 1].astype(np.int64)
        before = np.cumsum(total) - total                       # tokens of the pre-tokens before, over all texts
        out = self.flat[np.arange(len(start)) + np.repeat(where - begin, length)] + np.repeat(before, length)
        if runs:
            ends = np.fromiter(map(self.place.__getitem__, runs), np.int64, len(runs)) + run_last - run_first
            out[run_last] = before[piece_of] + self.flat[ends]
        for s, e in specials:
            # plain text until complete: count again from the letters or digits before it, or the border before those
            k = int(np.searchsorted(begin, s))
            low = int(rows[np.searchsorted(rows, s, "right") - 1])
            while k > 0 and begin[k - 1] >= low and cls[border[k] - 1] in (SPACE, OTHER):
                k -= 1
            if k > 0 and begin[k - 1] >= low and cls[border[k] - 1] != SPECIAL:
                k -= 1
            for p in range(s + 1, e):
                out[p - 1] = before[k] + len(self.tokenizer.encode(text[begin[k]:p], add_special_tokens=False).ids)
        ahead = np.append(before, before[-1] + total[-1])[np.searchsorted(border, rows)]
        return [(out[a:b] - base).astype(np.int32) for a, b, base in zip(rows, rows[1:], ahead)]

    def long_counts(self, text: str) -> np.ndarray:
        """``counts`` of one long text, a part at a time; a part ends before white space that follows other text."""
        parts, at, base = [], 0, 0
        while at < len(text):
            to = at + PART
            while to < len(text) and not (text[to] == " " and text[to - 1] not in " \t\n\r\x0b\x0c" and self._class_of(
                    np.array([ord(text[to - 1])]))[0] != SPACE):
                to += 1
            part = self.counts([text[at:to]])[0].astype(np.int64) + base
            parts.append(part.astype(np.int32))
            base, at = int(part[-1]), to
        return np.concatenate(parts)


def _texts(chunk: Chunk) -> list[str]:
    raw, off = chunk.data.tobytes(), chunk.offsets.tolist()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(off, off[1:])]


_counters: dict[int, Counter] = {}


def _counter(shared) -> Counter:
    key = hash(shared.value)
    if key not in _counters:
        _counters[key] = Counter(shared.value)
    return _counters[key]


def _share(spark, path: str | None):
    """The vocabulary file (a few megabytes, whatever the data) as a broadcast."""
    import public_tokenizers
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def with_prefix_counts(docs: DataFrame, path: str | None = None, kept: tuple[str, ...] = ("*",)) -> DataFrame:
    """The rows of ``docs`` (the columns ``kept``, in the struct ``row``), ``n_bytes`` and ``prefix``: token counts of
    the prefixes of 0, 1, 2, ... characters (array<int>)."""
    shared = _share(docs.sparkSession, path)
    packed = docs.select(F.struct(*kept).alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches):
        counter = _counter(shared)
        for b in batches:
            at = 0
            for ch in text_chunks(b.column(1), PART):
                texts = _texts(ch)
                each = [counter.long_counts(texts[0])] if ch.rows == 1 and len(texts[0]) > PART else counter.counts(texts)
                values = np.concatenate([x for e in each for x in (np.zeros(1, np.int32), e)])
                first = np.concatenate([[0], np.cumsum([len(e) + 1 for e in each])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, ch.rows), pa.array(np.diff(ch.offsets)), pa.ListArray.from_arrays(pa.array(first), pa.array(values))],
                    ["row", "n_bytes", "prefix"])
                at += ch.rows

    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, n_bytes long, prefix array<int>")


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, prefix; write it once and ask ``tokens_at`` and ``longest_within`` as often as needed."""
    return with_prefix_counts(docs, path, ("doc_id",)).select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_bytes", "prefix")


def tokens_at(chars: Column | int, prefix: str = "prefix") -> Column:
    """Tokens of the first ``chars`` characters; of the whole text if it has no more."""
    n = chars if isinstance(chars, Column) else F.lit(chars)
    return F.element_at(prefix, F.least(F.greatest(n, F.lit(0)) + 1, F.size(prefix)).cast("int")).cast("long")


def longest_within(budget: Column | int, prefix: str = "prefix") -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens (null below 0 tokens).

    Counts can fall by one where characters join into one token, so all
    prefixes are looked at and the longest that fits is the answer.
    """
    k = budget if isinstance(budget, Column) else F.lit(budget)
    fits = F.array_max(F.transform(prefix, lambda c, i: F.when(c <= k, i)))
    return F.when(F.element_at(prefix, -1) <= k, F.size(prefix) - 1).otherwise(fits).cast("long")


def truncate(docs: DataFrame, budget: int, path: str | None = None) -> DataFrame:
    """The documents, each text cut to its longest prefix of at most ``budget`` tokens."""
    out = with_prefix_counts(docs, path).withColumn("_fit", longest_within(budget))
    text = F.substring(F.col("row.text").cast("string"), F.lit(1), F.col("_fit").cast("int"))
    return out.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op12_token_counts(spark, sf_dir) -> DataFrame:
    out = prefix_counts(documents(spark, sf_dir))
    n = F.element_at("prefix", -1).cast("long")
    return out.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > LIMIT).alias("over_limit"),
                      longest_within(LIMIT).alias("chars_within_limit"))


ORACLE_SQL = None
