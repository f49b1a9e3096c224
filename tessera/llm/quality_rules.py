"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps one failure bit
per rule beside the measurements.  A *policy* (a version name and a set of
rules) is applied afterwards by one bitwise AND, so trying another policy, or
asking what each rule costs, never reads the texts again.

Defined cases: a null text counts as empty (no words); an empty text fails
``few_words`` only; rows are independent, so repeated rows get equal
results and null ids pass through; an empty table gives an empty ledger;
other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, id_text
from .words import Spans, combine, per_row_sum, row_of, text_chunks

SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ASCII_LETTER = _UPPER.copy()
_ASCII_LETTER[97:123] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_distinct_words", "n_letters", "n_upper")

# rule name -> condition on the measurements that *fails* a document; the
# position is the bit.  New rules are appended, bits are never reused.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 40 * n_lines",
    "word_length": "word_chars > 12 * n_words or word_chars < 2 * n_words",
    "few_letters": "100 * n_letters < 70 * word_chars",
    "few_distinct_words": "100 * n_distinct_words < 10 * n_words",
    "capitals": "100 * n_upper > 70 * n_letters",
}
BASE_RULES = ("few_words", "repeated_windows")

POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE_RULES,
    "v1": tuple(RULES),
}
CURRENT = "v1"


def policy_mask(policy: str | tuple[str, ...]) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(1 << list(RULES).index(n) for n in names)


def _measure(column) -> dict[str, np.ndarray]:
    out: dict[str, list[np.ndarray]] = {m: [] for m in MEASURES}
    for ch in text_chunks(column):
        starts, ends, first = ch.words()
        spans, b = Spans(ch.data), ch.data
        h, row = spans.hash(starts, ends), row_of(first)
        nonspace = np.zeros(len(b) + 1, np.int8)
        np.add.at(nonspace, starts, 1)
        np.add.at(nonspace, ends, -1)
        inword = np.cumsum(nonspace[:-1], dtype=np.int8).astype(bool)
        head = (b & 0xC0) != 0x80
        out["n_words"].append(np.diff(first))
        out["word_chars"].append(ch.per_row(inword & head))
        out["n_symbols"].append(ch.per_row(_SYMBOL[b]))
        out["n_letters"].append(ch.per_row(_ASCII_LETTER[b] | (inword & (b >= 0xC0))))
        out["n_upper"].append(ch.per_row(_UPPER[b]))
        out["n_distinct_words"].append(_distinct(h, row, ch.rows))
        # lines with a word
        cut = np.flatnonzero(b == 10)
        ls = np.union1d(ch.offsets[:-1], cut + 1)
        ls = ls[ls < len(b)]
        le = np.append(ls[1:], len(b))
        le = le - ((le > ls) & (le > 0) & (b[np.maximum(le, 1) - 1] == 10)) if len(ls) else le
        worded = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
        ls, le = ls[worded], le[worded]
        lrow = np.searchsorted(ch.offsets, ls, "right") - 1
        n_lines = np.bincount(lrow, minlength=ch.rows)
        out["n_lines"].append(n_lines)
        out["n_dup_lines"].append(n_lines - _distinct(spans.hash(ls, le), lrow, ch.rows))
        # words inside a window of three that the text holds twice or more
        covered = np.zeros(len(h), bool)
        if len(h) >= 3:
            inside = np.flatnonzero(row[:-2] == row[2:])
            key = combine(combine(combine(h[inside], h[inside + 1]), h[inside + 2]), row[inside].astype(np.uint64))
            order = np.argsort(key)
            same = key[order[1:]] == key[order[:-1]]
            twice = np.zeros(len(key), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            at = inside[twice]
            for k in range(3):
                covered[at + k] = True
        out["n_repeat_words"].append(per_row_sum(covered, first))
    return {m: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for m, v in out.items()}


def _distinct(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct hashes in each row."""
    key = combine(h, row.astype(np.uint64))
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.bincount(row[order[new]], minlength=rows)


def fail_bits():
    """The ledger's bits as one long expression over the measurements."""
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
            for i, cond in enumerate(RULES.values())]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` rows with all their columns in the struct ``row`` and the measurements beside it."""
    packed = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for b in batches:
            m = _measure(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[k]) for k in MEASURES)], ["row", *MEASURES])

    schema = f"row {packed.schema['row'].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES)
    return packed.mapInArrow(run, schema)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``fail_bits``, one row per document."""
    return measure(id_text(docs)).select(F.col("row.doc_id").alias("doc_id"), *MEASURES, fail_bits().alias("fail_bits"))


def apply_policy(led: DataFrame, policy: str | tuple[str, ...] = CURRENT) -> DataFrame:
    """Adds ``kept``: no rule of the policy failed."""
    return led.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy_mask(policy))) == 0)


def ablation(led: DataFrame, policy: str | tuple[str, ...] = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, and documents that only it rejects.

    The ledger is first reduced to one count per bit pattern (at most
    2^rules rows); every figure then follows from bitwise tests.
    """
    mask = policy_mask(policy)
    names = POLICIES[policy] if isinstance(policy, str) else policy
    patterns = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    aggs = [F.array(*[F.struct(
        F.lit(n).alias("rule"),
        F.coalesce(F.sum(F.when(F.col("p").bitwiseAND(F.lit(policy_mask((n,)))) != 0, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("p") == policy_mask((n,)), F.col("n"))), F.lit(0)).alias("only_by_it"))
        for n in names]).alias("a")]
    return patterns.agg(*aggs).select(F.explode("a").alias("r")).select("r.rule", "r.failed", "r.only_by_it")


def keep_good(docs: DataFrame, policy: str | tuple[str, ...] = CURRENT) -> DataFrame:
    """The documents that the policy keeps, with all their columns (pipeline stage)."""
    mask = F.lit(policy_mask(policy))
    return measure(docs).filter(fail_bits().bitwiseAND(mask) == 0).select("row.*")


def op9_quality_rules(spark, sf_dir) -> DataFrame:
    led = apply_policy(ledger(documents(spark, sf_dir)))
    base = F.col("fail_bits").bitwiseAND(F.lit(policy_mask("base"))) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), "kept", "fail_bits")


def _sql() -> str:
    bits = " + ".join(f"case when {c} then {1 << i} else 0 end" for i, c in enumerate(RULES.values()))
    return rf"""
with w as (select doc_id, coalesce(text, '') as t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
           from documents),
windows as (select doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] as g from w, unnest(range(1, len(ws) - 1)) u(i)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from windows) where c > 1),
rep as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by 1),
m as (select w.doc_id, len(ws)::bigint as n_words,
       coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
       length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
       (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
       coalesce(n_repeat_words, 0)::bigint as n_repeat_words, len(ls)::bigint as n_lines,
       len(list_distinct(ws))::bigint as n_distinct_words,
       length(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g'))::bigint as n_letters,
       length(regexp_replace(t, '[^A-Z]', '', 'g'))::bigint as n_upper
      from w left join rep using (doc_id)),
b as (select *, ({bits})::bigint as fail_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & {policy_mask("base")}) <> 0 as base_failed,
       (fail_bits & {policy_mask(CURRENT)}) = 0 as kept, fail_bits from b"""


ORACLE_SQL = _sql()
