"""Ranked lexical search: the k best documents for every item, scored once per class of equal documents.

Terms are runs of ASCII letters, digits and all non-ASCII characters, A-Z
lower-cased.  With N documents that have a term, L terms in all, n terms in a
document, df documents holding a term and tf its occurrences in a document,
a term weighs w = floor(1000 ln((2N+2)/(2df+1))), a document has
m = 10 + (90 n N) div L, and its score for an item is the sum over the item's
distinct terms of w * ((10^9 tf) div (1000 tf + 8 m)), in integers.

1. Each document is restricted to the items' vocabulary: its sorted term
   numbers and their counts, packed, beside n.  One pass over the texts,
   written once; N, L and df are counts over all documents.
2. Documents with the same packed vector and the same m score alike for every
   item: they are brought together by a hash of both and compared in full, and
   the smallest doc_id stands for the class.  A class keeps its k smallest
   doc_ids (a later member can be in no result of k rows), which are taken
   before the shuffle, so a text copied any number of times is no hot group.
3. The classes are scored in blocks against the items' posting lists, and each
   task hands on its k best classes per item, a tie going to the smaller
   doc_id; of all tasks' classes the k best are kept and opened into their
   members by ascending doc_id.

All sums stay below 2^53, so they are exact in doubles.  The vocabulary is
sent to the tasks; items are worked on in blocks whose terms are counted
beforehand, so its size is bounded whatever the number of items is.

Defined cases: rows of one item_id (null is one) are one item with all their
terms; null and empty texts have no terms and are found by nothing; a null
doc_id comes after all others; repeated rows are members like any other; no
items, no documents or no common term give no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .common import documents, id_text
from .words import text_chunks

BEST = 10
ITEM_TERMS = 250_000       # distinct (item, term) pairs worked on at a time; more items are taken in more blocks
PAIRS = 2_000_000          # contributions summed at a time in a task
IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _terms(ch) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """All spans of a chunk of lower-cased texts, alternately terms and gaps, which spans are terms, and the row of each span."""
    data, off = ch.data, ch.offsets
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(0, bool), np.zeros(0, np.int64)
    flag = IS_TERM[data]
    edge = np.zeros(len(data), bool)
    edge[0] = True
    edge[1:] = flag[1:] != flag[:-1]
    edge[off[off < len(data)]] = True
    start = np.flatnonzero(edge)
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(np.append(start, len(data)).astype(np.int64)), pa.py_buffer(data)])
    return spans, flag[start], np.searchsorted(off, start, "right") - 1


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term (binary): the distinct terms of every item."""
    src = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for b in batches:
            at = 0
            for ch in text_chunks(b.column(1)):
                spans, is_term, row = _terms(ch.lowered())
                keep = pa.array(np.flatnonzero(is_term))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, ch.rows).take(pa.array(row[is_term])),
                                                  spans.take(keep).cast(pa.binary())], ["item_id", "term"])
                at += ch.rows

    return src.mapInArrow(run, "item_id long, term binary").distinct()


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms in all), terms (their sorted numbers in the vocabulary, packed as int32), counts (likewise)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = pa.array(shared.value, pa.large_binary())
        for b in batches:
            at = 0
            for ch in text_chunks(b.column(1)):
                spans, is_term, row = _terms(ch.lowered())
                n = np.bincount(row[is_term], minlength=ch.rows).astype(np.int64)
                number = pc.index_in(spans, known).fill_null(-1).to_numpy()
                hit = is_term & (number >= 0)
                key, tf = np.unique(row[hit] * len(known) + number[hit], return_counts=True)
                r, term = key // max(len(known), 1), key % max(len(known), 1)
                border = np.searchsorted(r, np.arange(ch.rows + 1)).astype(np.int32) * 4
                packed = [pa.BinaryArray.from_buffers(pa.binary(), ch.rows, [None, pa.py_buffer(border), pa.py_buffer(x.astype("<i4"))])
                          for x in (term, tf)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, ch.rows), pa.array(n), *packed], ["doc_id", "n", "terms", "counts"])
                at += ch.rows

    return id_text(docs).mapInArrow(run, "doc_id long, n long, terms binary, counts binary")


def document_frequency(vecs: DataFrame, size: int) -> np.ndarray:
    """For each term of the vocabulary the documents that hold it; each batch is counted before the shuffle."""

    def run(batches):
        for b in batches:
            df = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4"), minlength=size)
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])

    out = np.zeros(size, np.int64)
    counts = vecs.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for term, df in counts.collect():  # at most one row per vocabulary term
        out[term] = df
    return out


def classes(vecs: DataFrame, n_docs: int, n_terms: int, best: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the written table of both; members: class, member, place; representatives: class, doc_id, m, terms, counts), a class being equal vectors and m."""
    m = F.expr(f"10 + (90 * n * {n_docs}L) div {max(n_terms, 1)}L")
    rows = vecs.filter(F.octet_length("terms") > 0).select("doc_id", m.alias("m"), "terms", "counts")
    rows = rows.withColumn("hash", F.xxhash64("m", "terms", "counts")).withColumn("row", F.monotonically_increasing_id())
    # the hash brings them together, the other columns verify that they are equal
    same = Window.partitionBy("hash", "m", "terms", "counts").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    upto = same.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = rows.withColumn("place", F.row_number().over(same)).withColumn("class", F.first("row").over(upto)).filter(F.col("place") <= best)
    first = F.col("place") == 1
    kept = cut_lineage(kept.select("class", "doc_id", "place", "m", F.when(first, F.col("terms")).alias("terms"),
                                   F.when(first, F.col("counts")).alias("counts")))
    return kept, kept.select("class", F.col("doc_id").alias("member"), "place"), kept.filter(first).drop("place")


def _best_rows(item, score, doc, null, best):
    """Of parallel arrays, sorted by item, the ``best`` rows of each item: high scores first, then small doc_ids, nulls last."""
    order = np.lexsort((doc, null, -score, item))
    item = item[order]
    place = np.arange(len(item)) - np.searchsorted(item, item, "left")
    return order[place < best]


def best_classes(representatives: DataFrame, weights: np.ndarray, posting: np.ndarray, item: np.ndarray, best: int) -> DataFrame:
    """item (number), score, doc_id, class: each task's best classes for every item.

    ``item[posting[t]:posting[t + 1]]`` are the items with term t.
    """
    shared = representatives.sparkSession.sparkContext.broadcast((weights, posting, item))
    pairs = PAIRS

    def block(b, weights, posting, item):
        """(item, score, row) of every class and item with a score."""
        raw = b.column(2).to_pylist()
        size = np.array([len(x) // 4 for x in raw])
        term = np.frombuffer(b"".join(raw), "<i4").astype(np.int64)
        tf = np.frombuffer(b"".join(b.column(3).to_pylist()), "<i4").astype(np.int64)
        row = np.repeat(np.arange(len(raw)), size)
        m = b.column(1).to_numpy()[row]
        part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        items = int(item.max()) + 1
        cost = posting[term + 1] - posting[term]
        upto = np.concatenate([[0], np.cumsum(cost)])
        ends = np.cumsum(size)
        first = 0
        while first < len(raw):  # some rows at a time, at least one
            begin = ends[first] - size[first]
            last = int(np.searchsorted(upto[ends], upto[begin] + pairs, "right"))
            last = min(max(last, first + 1), max(first + 1, first + (1 << 22) // items), len(raw))
            s, e = begin, ends[last - 1]
            n = cost[s:e]
            at = np.repeat(posting[term[s:e]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            cell = np.repeat((row[s:e] - first) * items, n) + item[at]
            total = np.bincount(cell, weights=np.repeat(part[s:e], n))
            hit = np.flatnonzero(total)
            yield hit % items, total[hit].astype(np.int64), hit // items + first
            first = last

    def run(batches):
        weights, posting, item = shared.value
        held = None  # the best so far: item numbers, scores, and a table of their classes
        for b in batches:
            if not b.num_rows or not len(item):
                continue
            doc = b.column(0).fill_null(0).to_numpy()
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            for its, score, row in block(b, weights, posting, item):
                if held is not None:
                    # a class below the worst kept one of a full item cannot enter
                    full = np.bincount(held[0], minlength=int(item.max()) + 1) >= best
                    low = np.full(len(full), np.iinfo(np.int64).max)
                    np.minimum.at(low, held[0], held[1])
                    enter = ~full[its] | (score >= low[its])
                    its, score, row = its[enter], score[enter], row[enter]
                top = _best_rows(its, score, doc[row], null[row], best)
                its, score, row = its[top], score[top], row[top]
                rows = pa.Table.from_batches([b]).select(["doc_id", "class"]).take(pa.array(row))
                if held is not None:
                    its, score = np.concatenate([held[0], its]), np.concatenate([held[1], score])
                    rows = pa.concat_tables([held[2], rows])
                    ids = rows.column(0)
                    top = _best_rows(its, score, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(), best)
                    its, score, rows = its[top], score[top], rows.take(pa.array(top))
                held = its, score, rows.combine_chunks()
        if held is not None:
            out = held[2].append_column("item", pa.array(held[0].astype(np.int64))).append_column("score", pa.array(held[1]))
            yield from out.to_batches()

    return representatives.select("doc_id", "m", "terms", "counts", "class").mapInArrow(run, "doc_id long, class long, item long, score long")


def _search_block(docs: DataFrame, terms: DataFrame, best: int) -> DataFrame:
    """The result for the items of one block; ``terms`` are its (item_id, term) pairs, of a number checked before."""
    spark = docs.sparkSession
    pairs = terms.toPandas()
    names = pairs["item_id"].astype("Int64")
    ids = names.drop_duplicates().reset_index(drop=True)
    number = {None if i is None or i != i else int(i): k for k, i in enumerate(ids.astype(object).where(ids.notna(), None))}
    vocabulary = sorted({bytes(t) for t in pairs["term"]})
    place = {t: k for k, t in enumerate(vocabulary)}
    term = np.array([place[bytes(t)] for t in pairs["term"]], np.int64)
    item = np.array([number[None if i is None else int(i)] for i in names.astype(object).where(names.notna(), None)], np.int64)
    order = np.lexsort((item, term))
    posting = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
    vecs = cut_lineage(vectors(docs, vocabulary))
    n_docs, n_terms = vecs.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequency(vecs, len(vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    kept, members, representatives = classes(vecs, n_docs, n_terms, best)
    found = best_classes(representatives, weights, posting, item[order], best)
    ranked = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") <= best).select("item", "score", "class")
    opened = top.join(members, "class")
    ranked = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("member").asc_nulls_last())
    opened = opened.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= best)
    named = spark.createDataFrame([(k, i) for i, k in number.items()], "number long, item_id long")  # the items of this block
    out = cut_lineage(opened.join(F.broadcast(named), F.col("item") == F.col("number"))
                      .select("item_id", "rank", F.col("member").alias("doc_id"), "score"))
    release(vecs)
    release(kept)
    return out


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of every item with a score above 0."""
    terms = cut_lineage(item_terms(items))
    size = terms.count()
    if not size:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    blocks = math.ceil(size / ITEM_TERMS)
    parts = []
    for k in range(blocks):
        part = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else terms
        if part.limit(1).count():
            parts.append(_search_block(docs, part, best))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op11_lexical_search(spark, sf_dir) -> DataFrame:
    return search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
with low as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws, row_number() over () as r from documents),
ask as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
k as (select count(*) filter (len(ws) > 0)::bigint as n_docs, sum(len(ws))::bigint as n_terms from low),
m as (select r, doc_id, 10 + (90 * len(ws)::bigint * n_docs) // n_terms as m from low, k where len(ws) > 0),
tf as (select r, term, count(*)::bigint as tf from (select r, unnest(ws) as term from low) group by all),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w from tf, k group by term, n_docs),
s as (select item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
      from ask join tf using (term) join w using (term) join m using (r) group by item_id, r)
select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
from s join m using (r) where score > 0 qualify rank <= 10"""
