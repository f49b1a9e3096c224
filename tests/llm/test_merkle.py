"""The manifest against a plain program and against its SQL twin, in blocks of few and of many nodes, and its edge cases."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle

SF = "/root/testdata/sf0.001"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _tree(leaves):
    """(root, siblings of every leaf from the lowest level up; None where there is none)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([_h(*low[i:i + 2]) for i in range(0, len(low), 2)])
    paths = [[(lv[(i >> k) ^ 1] if (i >> k) ^ 1 < len(lv) else None) for k, lv in enumerate(levels[:-1])] for i in range(len(leaves))]
    return levels[-1][0], paths


def _fold(h, path, i):
    for s in path:
        h = _h(h) if s is None else _h(s, h) if i & 1 else _h(h, s)
        i >>= 1
    return h


def _brute(rows):
    """rows of doc_id, text, lang, source, n_chars -> the query's rows."""
    if not rows:
        return []
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    leaf = lambda r, more=0: _h(*map(_enc, (r[0], r[3], r[2], r[4] if r[4] is None else r[4] + more, r[1])))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: sorted(langs[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in names}
    built = {x: _tree([leaf(r) for r in trees[x]]) for x in names}
    root, tops = _tree([built[x][0] for x in names])
    out = []
    for j, x in enumerate(names):
        for i, (r, path) in enumerate(zip(trees[x], built[x][1])):
            bad = zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 0 and r[4] is not None
            f = _fold(_fold(leaf(r, int(bad)), path, i), tops[j], j)
            out.append((r[0], leaf(r), built[x][0], root, _h(*[s for s in path + tops[j] if s]), f, f == root))
    return sorted(out, key=repr)


def _run(spark, df, tmp_path, bits, monkeypatch):
    monkeypatch.setattr(merkle, "BITS", bits)
    path = str(tmp_path / "sf")
    df.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return sorted(map(tuple, merkle.op13_merkle_manifest(spark, path).collect()), key=repr)


@pytest.mark.parametrize("bits", [2, 12])
def test_brute_force(spark, tmp_path, monkeypatch, bits):
    rows = [(i, f"text {i}", ["en", "en", "en", "de", "é", "Z"][i % 6], None if i % 5 else "s", i if i % 4 else None) for i in range(1, 150)]
    rows += [(500, "t", None, None, 3), (501, None, None, "s", 3), (600, "alone", "zz", "s", 1)]
    rows += [(None, None, None, None, None)] * 2 + [(7, "again", "en", "s", 7)] + [(8, "same", "en", "s", 8)] * 3 + [(9, "", "", "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("tree", "salt", "at", "id", "digest", "segment", "n"):
        df = df.withColumn(name, F.lit("other"))
    got = _run(spark, df, tmp_path, bits, monkeypatch)
    assert got == _brute(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_small_tables(spark, tmp_path, monkeypatch):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for k, rows in enumerate(([], [(1, "a", "en", "s", 1)], [(1, "a", "en", "s", 1), (2, "b", "de", "s", 1)])):
        df = spark.createDataFrame(rows, schema)
        assert _run(spark, df, tmp_path / str(k), 12, monkeypatch) == _brute(rows)


def test_matches_sql(spark):
    from ..oracle_check import canon
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert canon(merkle.op13_merkle_manifest(spark, SF).toPandas()) == canon(con.execute(merkle.ORACLE_SQL).df())
