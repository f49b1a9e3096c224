"""Byte-level BPE through a sentencepiece model written straight from a rank file.

Every vocabulary entry is mapped byte by byte to printable characters and
becomes a piece with score -rank, so the highest-scoring merge is the one of
lowest rank; the normaliser is the identity (no prefix space, no space
escape), and piece ids equal ranks.  Texts are cut into pre-tokens by the
vocabulary's pattern; a pre-token that is itself an entry is that entry, any
other is merged by sentencepiece.  Decoding maps ids back to their bytes.

Defined cases: a null text counts as empty and has no ids; an empty table
gives no rows; null ids and repeated rows pass through row by row; other
columns are not read by ``encode`` and are kept by ``encode_all``; columns of the
names that ``with_tokens`` adds are replaced by it; bytes that are no UTF-8 are
encoded as the replacement character (the round trip then fails and says so).
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, id_text
from .words import text_chunks

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHED = 300_000  # pre-tokens whose ids a Python worker remembers; a memory bound, not a limit on texts


def byte_characters() -> list[str]:
    """A printable character for every byte: itself where it is printable, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries in rank order."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    entries = [b""] * len(pairs)
    for token, rank in pairs:
        entries[int(rank)] = base64.b64decode(token)
    return entries


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _flag(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def model_proto(entries: list[bytes]) -> bytes:
    """The serialised sentencepiece model: one normal piece per entry, ids = ranks, the unknown piece last."""
    chars = byte_characters()
    out = bytearray()
    for rank, entry in enumerate(entries):
        piece = "".join(chars[b] for b in entry).encode()
        out += _field(1, _field(1, piece) + b"\x15" + struct.pack("<f", -rank) + _flag(3, 1))
    out += _field(1, _field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _flag(3, 2))
    out += _field(2, _flag(3, 2) + _flag(40, len(entries)) + b"".join(_varint(n << 3) + _varint((1 << 64) - 1) for n in (41, 42, 43)))
    out += _field(3, _field(1, b"identity") + _flag(3, 0) + _flag(4, 0) + _flag(5, 0))
    return bytes(out)


class Codec:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, entries: list[bytes], proto: bytes, pattern: str):
        chars = byte_characters()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.split = regex.compile(pattern).findall
        self.table = {b: chars[b] for b in range(256)}
        self.whole = {e: np.int32(i).tobytes() for i, e in enumerate(entries)}
        self.known: dict[str, bytes] = {}
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) + len(pieces) > CACHED:
            self.known.clear()
        rest = []
        for p in pieces:
            if (one := self.whole.get(p.encode())) is not None:
                self.known[p] = one
            else:
                rest.append(p)
        if rest:
            mapped = [p.encode().decode("latin-1").translate(self.table) for p in rest]
            for p, ids in zip(rest, self.sp.encode(mapped, out_type=int, num_threads=1), strict=True):
                self.known[p] = np.array(ids, np.int32).tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the borders of the texts."""
        raw = []
        for t in texts:
            pieces = self.split(t)
            try:
                ids = b"".join(map(self.known.__getitem__, pieces))
            except KeyError:
                self._learn({p for p in pieces if p not in self.known})
                if any(p not in self.known for p in pieces):  # the memory was cleared meanwhile
                    self._learn(set(pieces))
                ids = b"".join(map(self.known.__getitem__, pieces))
            raw.append(ids)
        first = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw], dtype=np.int64)])
        return np.frombuffer(b"".join(raw), np.int32), first

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids in a row, and the borders of the texts."""
        n = self.lengths[ids]
        end = np.cumsum(n)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.starts[ids] - (end - n), n)
        return self.bytes[at], np.concatenate([[0], end])[first]


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    entries, proto, pattern = shared.value
    key = hash((proto, pattern))
    if key not in _codecs:
        _codecs[key] = Codec(entries, proto, pattern)
    return _codecs[key]


def _share(spark, path: str | None, pattern: str | None):
    """The vocabulary (some 50,000 short entries, whatever the data) as a broadcast."""
    import public_tokenizers
    entries = read_ranks(path or public_tokenizers.path(VOCABULARY))
    return spark.sparkContext.broadcast((entries, model_proto(entries), pattern or public_tokenizers.PATTERN))


def encode_all(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The rows of ``docs`` (all columns, in the struct ``row``), ``ids`` (array<int>) and ``decoded`` (binary)."""
    shared = _share(docs.sparkSession, path, pattern)
    packed = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches):
        codec = _codec(shared)
        for b in batches:
            at = 0
            for ch in text_chunks(b.column(1)):
                raw, off = ch.data.tobytes(), ch.offsets.tolist()
                ids, first = codec.encode([raw[x:y].decode("utf-8", "replace") for x, y in zip(off, off[1:])])
                data, border = codec.decode(ids, first)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, ch.rows),
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)),
                     pa.BinaryArray.from_buffers(pa.binary(), ch.rows, [None, pa.py_buffer(border.astype(np.int32)), pa.py_buffer(data)])],
                    ["row", "ids", "decoded"])
                at += ch.rows

    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, ids array<int>, decoded binary")


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids, decoded."""
    return encode_all(id_text(docs), path, pattern).select("row.doc_id", "ids", "decoded")


def with_tokens(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The documents with ``token_ids``, ``n_tokens`` and ``round_trip``: whether decoding gives the text back (pipeline stage)."""
    out = encode_all(docs, path, pattern)
    own = ("token_ids", "n_tokens", "round_trip")
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in own], F.col("ids").alias("token_ids"), F.size("ids").cast("long").alias("n_tokens"),
                      (F.col("decoded") == F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("round_trip"))


def op8_byte_bpe(spark, sf_dir) -> DataFrame:
    out = encode(documents(spark, sf_dir))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


ORACLE_SQL = None
