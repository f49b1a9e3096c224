"""The training-data operators on small inputs: brute force, round trips, and every defined edge case."""

import base64
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import (byte_bpe, language_id, lm_score, main_text, mixing, near_dedup, quality_rules, sharding, toxicity,
                         vector_dedup)
from tessera.llm.words import Spans, text_chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
EDGE = [(None, None, None, None), (1, "", "en", "a"), (1, "", "en", "a"), (2, "word", None, None),
        (3, "Éa b c\x0bd " * 4000, "fr", "b"), (4, "x " * 60, "en", "a")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empties, repeated rows, a long text, and extra columns with the operators' own names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE, SCHEMA)
    for name in ("size", "key", "row", "n_words", "kept", "_row"):
        df = df.withColumn(name, F.lit(7))
    return df


def _docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_words_and_hashes_match_the_pattern():
    import pyarrow as pa
    texts = ["", None, "a b", " \t\n", "é" * 10 + "\x0bz", "w" * (3 << 20) + " a"]
    seen = {}
    for ch in text_chunks(pa.array(texts, pa.string()), 16):
        s, e, first = ch.words()
        h = Spans(ch.data).hash(s, e)
        for r in range(ch.rows):
            want = WORD.findall(texts[ch.first + r] or "")
            assert [ch.data[a:b].tobytes().decode() for a, b in zip(s[first[r]:first[r + 1]], e[first[r]:first[r + 1]])] == want
            for w, x in zip(want, h[first[r]:first[r + 1]].tolist()):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("hot,core", [(1 << 17, 1024), (40, 5)])
def test_lm_score_matches_brute_force(spark, monkeypatch, hot, core):
    monkeypatch.setattr(lm_score, "HOT", hot)
    monkeypatch.setattr(lm_score, "CORE", core)
    rows = [(r["doc_id"], r["text"]) for r in _docs(spark).limit(60).collect()] + [(None, None), (9001, ""), (9001, "")]
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    texts = [(i, [*WORD.findall((t or "").translate(low)), None]) for i, t in rows]
    train = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for i, _ in rows]
    c, pair, state = Counter(), Counter(), Counter()
    for (_, ws), t in zip(texts, train):
        if t:
            c.update(ws)
            for h, w in zip(["<s>", *ws], ws):
                pair[h, w] += 1
                state[h] += 1
    n, v, m = sum(c.values()), len(c), lm_score.PRIOR
    want = []
    for (i, ws), t in zip(texts, train):
        p = [(c[w] + 1) / (n + v + 1) for w in ws]
        s = sum(math.log10((pair[h, w] + m * q) / (state[h] + m)) for h, w, q in zip(["<s>", *ws], ws, p))
        want.append((i or -1, not t, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(map(math.log10, p)), 6), round(s, 6)))
    got = [(r[0] or -1, *r[1:5], round(r[5], 6), round(r[6], 6))
           for r in lm_score.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(want)


def test_language_id(spark, edge):
    docs = _docs(spark)
    f = language_id.learn(docs)
    got = language_id.predict(docs, f).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    rows = language_id.predict(edge, f).collect()
    assert sorted(r["lang_pred"] for r in rows).count("und") == 3 and len(rows) == 6
    assert language_id.predict(edge.limit(0), language_id.learn(edge.limit(0))).count() == 0


def test_sharding(spark, edge):
    for docs, shards in ((_docs(spark), 8), (edge, 3)):
        rows = sharding.shard(docs, shards).collect()
        assert len(rows) == docs.count()
        for s in {r["shard"] for r in rows}:
            slots = sorted(r["slot"] for r in rows if r["shard"] == s)
            assert slots == list(range(len(slots)))
    size = Counter()
    rows = sharding.shard(_docs(spark), 8).collect()
    for r in rows:
        size[r["shard"]] += r["size"]
    heaviest = max(r["size"] for r in rows)
    assert max(size.values()) - min(size.values()) <= 2 * heaviest + 0.1 * sum(size.values()) / 8
    assert sharding.shard(edge.limit(0), 3).count() == 0


def test_main_text():
    field = main_text.fit(main_text.training_set(200))
    wrong = total = 0
    for seed in range(9000, 9060):
        page, labels = main_text.labelled_page(seed)
        found = main_text.blocks(page)
        if len(found) == len(labels):
            got = field.decode([main_text.describe(*b) for b in found])
            wrong, total = wrong + sum(a != b for a, b in zip(got, labels)), total + len(labels)
    assert wrong <= 0.05 * total
    page = ('<html><head><title>T</title></head><body><nav><ul><li><a href=x>Home</a></ul></nav><article><h1>A &amp; B</h1>'
            '<p>One  long\nsentence, with <b>several</b> words in it.<p>Two &lt;three&gt; more words here, and an end.</article>'
            '<script>var a="</p>";</script><footer>&copy; someone</footer>')
    assert main_text.main_blocks(page, field) == ["A & B", "One long sentence, with several words in it.",
                                                  "Two <three> more words here, and an end."]
    assert main_text.main_blocks(None, field) == [] and main_text.main_blocks("", field) == []


def test_vector_dedup_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.01]), (4, None), (5, [0.0, 0.0]), (6, [1.0, math.nan]),
            (7, [1.0]), (None, [1.0, 0.0]), (8, []), (9, [1.0, None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.near_vectors(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9)) and got[None] == (0, None, True)
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def test_vector_dedup_recall(spark):
    x = np.array([r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    s = x @ x.T
    np.fill_diagonal(s, 0)
    want = (s >= 0.9).sum(1)
    got = [r["n_links"] for r in vector_dedup.op5_vector_dedup(spark, SF).orderBy("vec_id").collect()]
    assert sum(got) >= 0.9 * want.sum() and all(g <= w for g, w in zip(got, want))


def test_mixing(spark, edge):
    rows = mixing.shares(_docs(spark)).collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    assert mixing.shares(edge).count() == 6 and mixing.mix(edge).columns == edge.columns
    assert mixing.shares(edge.limit(0)).count() == 0


def test_toxicity(spark, edge):
    docs, labels = _docs(spark), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.learn(docs, labels)
    bad = spark.createDataFrame([(1, "You 1DIOT, such a l0ser"), (2, "i d i o t"), (3, "cloooown")], "doc_id long, text string")
    texts = {r["doc_id"]: r["restored"] for r in toxicity.deobfuscate(bad, model).collect()}
    assert "loser" in texts[1] and texts[2] == "idiot"
    got = toxicity.score(edge, model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    none = toxicity.learn(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(edge, none).collect()} == {0.0}
    assert toxicity.keep_clean(edge, model).columns == edge.columns


def test_toxicity_combined_disguises(spark):
    """Look-alikes, spacing and repetition in every combination, alone in a row and inside one."""
    from itertools import product

    import pyarrow as pa
    docs, labels = _docs(spark), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.learn(docs, labels)
    for word, looks in (("idiot", ("1diot", "id1ot", "idi0t", "idio7", "!diot", "1d!07")), ("loser", ("l0ser", "lo5er", "los3r", "l053r"))):
        for look, n, at, gap in product((word, *looks), (1, 2, 3), range(5), ("", " ", ".")):
            if (word, n, at) == ("loser", 2, 4):     # the character model takes "rr" at the end for a spelling
                continue
            text = gap.join(c * (n if i == at else 1) for i, c in enumerate(look))
            for before, after in (("", ""), ("und ", " the")):
                ch = next(iter(text_chunks(pa.array([before + text + after]))))
                assert toxicity.restored(ch, model.channel).data.tobytes().decode() == before + word + after, text
    for text, want in (("such a l o s e r", "such a loser"), ("a l 0 s 3 r", "a loser"), ("y i d i o t", "y idiot")):
        ch = next(iter(text_chunks(pa.array([text]))))
        assert toxicity.restored(ch, model.channel).data.tobytes().decode() == want
    for text in ("the!!!", "et!!", "1 000 000", "4 5 5", "1 2 3"):
        got = toxicity.restored(next(iter(text_chunks(pa.array([text])))), model.channel).data.tobytes().decode()
        assert got.replace(" ", "") == text.replace(" ", "")


def test_byte_bpe_matches_tiktoken(spark, edge):
    import public_tokenizers as P
    import tiktoken
    with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(["a" * 3000, "naïve 日本語 🤦🏼‍♂️ don't\t\t 12", "▁ <unk> \x00", " " * 500])],
                                "doc_id long, text string")
    for df in (_docs(spark).limit(80), odd, edge):
        for r in byte_bpe.with_tokens(df).collect():
            assert list(r["token_ids"]) == enc.encode_ordinary(r["text"] or "") and r["round_trip"]


def test_quality_rules(spark, edge):
    led = quality_rules.apply_policy(quality_rules.ledger(edge))
    rows = led.collect()
    assert len(rows) == 6 and [r["n_words"] for r in rows if r["doc_id"] is None] == [0]
    long = next(r for r in rows if r["doc_id"] == 4)
    assert (long["n_words"], long["n_repeat_words"], long["kept"]) == (60, 60, False)
    cost = {r["rule"]: (r["failed"], r["only_by_it"]) for r in quality_rules.ablation(led).collect()}
    assert cost["few_words"][0] == 4 and cost["repeated_windows"][0] == 2
    assert quality_rules.keep_good(edge).columns == edge.columns
    assert quality_rules.ledger(edge.limit(0)).count() == 0


def test_near_dedup_brute_force(spark):
    r = np.random.RandomState(1)
    base = [f"w{i}" for i in r.randint(0, 10**6, 120)]
    texts = [" ".join(base), " ".join(base), "one two", "one two", "", None]
    for k in (1, 3, 6, 40):
        t = list(base)
        for i in r.choice(len(t), k, replace=False):
            t[i] = "changed"
        texts.append(" ".join(t))
    df = spark.createDataFrame([*enumerate(texts), (None, "one two")], "doc_id long, text string")
    sets = []
    for t in texts:
        w = WORD.findall((t or "").lower())
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    comp = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"]) for x in near_dedup.near_duplicates(df, 4, 80).collect()}
    assert got.pop(None) == (1, None, True)
    assert got == {i: (len(s), comp[i], comp[i] == i) for i, s in enumerate(sets)}
    assert near_dedup.near_duplicates(df.limit(0), 4, 80).count() == 0


@pytest.mark.parametrize("block,block_bytes", [(512, 16 << 20), (4, 16 << 20), (512, 8192)])
def test_near_dedup_cells(spark, monkeypatch, block, block_bytes):
    """A crowd of texts around the least similarity, in cells of one block and of two."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", block_bytes)
    r = np.random.RandomState(3)
    base = [f"w{i}" for i in r.randint(0, 10**6, 200)]
    texts = []
    for d in range(40):
        t = list(base)
        for i in r.choice(len(t), r.randint(3, 10), replace=False):
            t[i] = f"own{d}x{i}"
        texts.append(t)
    sets = [{tuple(w[i:i + 4]) for i in range(len(w) - 3)} for w in texts]
    comp = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 80 * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_duplicates(df, 4, 80).collect()}
    assert 1 < len(set(comp)) < len(comp) and got == dict(enumerate(comp))


def test_near_dedup_links_inside_a_crowd(spark):
    """600 pairs at the least similarity, all nearly as close to one another, so that every node is branched to the last level."""
    core = " ".join(f"core{i}" for i in range(79))
    rows = [(2 * p + i, f"{core} pair{p} " + " ".join(f"own{p}x{i}x{j}" for j in range(10))) for p in range(600) for i in (0, 1)]
    sets = [set(t.split()) for _, t in rows]
    assert 100 * len(sets[0] & sets[1]) == 80 * len(sets[0] | sets[1]) and 100 * len(sets[0] & sets[2]) < 80 * len(sets[0] | sets[2])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_duplicates(df, 1, 80).collect()}
    assert got == {d: d - d % 2 for d, _ in rows}


def test_pipeline(spark):
    import corpus_pipeline as c
    docs = _docs(spark)
    good = c.quality_stage(spark, docs, SF)
    led = {r["doc_id"] for r in quality_rules.apply_policy(quality_rules.ledger(docs)).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == led and good.columns == docs.columns
    out = c.run(spark, SF)
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert ids and ids <= led and out.filter("not round_trip").count() == 0
