"""One id with several texts, row order, and clashing columns in near-duplicate detection."""

import random

from pyspark.sql import functions as F

from tessera.llm import near_dedup


def _text(seed, n=60):
    r = random.Random(seed)
    return " ".join(f"w{r.randint(0, 10**6)}" for _ in range(n))


def _near(text):
    return text.rsplit(" ", 1)[0] + " changed"


def _brute(rows, k=4, percent=80):
    sets = {}
    for i, (d, t) in enumerate(rows):
        w = (t or "").split()
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    comp = {d: d for d, _ in rows if d is not None}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in sets:
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(rows[i][0]), root(rows[j][0])))
                comp[y] = x
    return sorted(((d if d is not None else -1), len(sets[i]), root(d) if d is not None else -1) for i, (d, _) in enumerate(rows))


def _run(spark, rows):
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 4, 80).collect()
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in out)
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1) for r in out)


def test_one_id_with_two_texts_links_through_both(spark):
    a, b, x, y = (_text(s) for s in range(4))
    rows = [(1, a), (1, b), (2, _near(a)), (3, _near(b)),            # the id is the smallest of both classes
            (5, x), (5, y), (4, x), (6, _near(y)), (9, "z"), (9, "z"), (10, None), (None, a), (11, _near(_text(9)))]
    want = _brute(rows)
    assert {d: c for d, _, c in want}[3] == 1 and {d: c for d, _, c in want}[6] == 4
    assert _run(spark, rows) == want
    assert _run(spark, rows[::-1]) == want


def test_stage_keeps_clashing_columns(spark):
    a = _text(1)
    df = spark.createDataFrame([(1, a), (2, _near(a)), (3, _text(2))], "doc_id long, text string")
    for name in ("_gone", "c", "s", "node", "_row", "kept"):
        df = df.withColumn(name, F.lit(5))
    out = near_dedup.keep_one(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3]
