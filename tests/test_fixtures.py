"""Hand-checked small inputs (answers worked out by hand) and the semantics notes."""


import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import evaluate as ev
from tessera.operators import graph as G
from tessera.operators import stats as A
from tessera.sources import files as src

# three triangles in a row and a tail
LETTER_EDGES = [(1, 2, 4.0), (1, 3, 1.0), (2, 3, 2.0), (2, 4, 5.0), (3, 4, 9.0), (3, 5, 12.0), (4, 5, 3.0), (5, 6, 2.0)]


@pytest.fixture(scope="module")
def letters(spark):
    v = spark.createDataFrame([(i, chr(64 + i)) for i in range(1, 7)], "id long, name string")
    e = spark.createDataFrame(LETTER_EDGES, "src long, dst long, weight double")
    return v, G.to_undirected(e, extra=["weight"])


def test_precision_by_threshold(spark):
    rows = [(0.9, 1.0), (0.9, 0.0), (0.7, 1.0), (0.5, 0.0), (0.5, 0.0), (0.2, 1.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    got = {r["threshold"]: r["precision"] for r in ev.precision_by_threshold(df).collect()}
    assert got == pytest.approx({0.9: 1 / 2, 0.7: 2 / 3, 0.5: 2 / 5, 0.2: 1 / 2})


def test_people_predicate(spark):
    people = spark.createDataFrame([(1, "Ana", 19), (2, "Bela", 44), (3, "Cyr", 30), (4, "Dov", 31)],
                                   "id long, name string, age int")
    got = sorted((r["name"], r["age"]) for r in people.filter("age > 30").select("name", "age").collect())
    assert got == [("Bela", 44), ("Dov", 31)]


def test_shortest_paths_letters(spark, letters):
    v, e = letters
    got = {r["id"]: (r["distance"], r["predecessor"]) for r in G.shortest_paths(v, e, 1).collect()}
    assert got == {1: (0, None), 2: (3, 3), 3: (1, 1), 4: (8, 2), 5: (11, 4), 6: (13, 5)}


def test_unreachable_is_null(spark):
    v = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    e = spark.createDataFrame([(1, 2, 1.0)], "src long, dst long, weight double")
    got = {r["id"]: r["distance"] for r in G.shortest_paths(v, e, 1).collect()}
    assert got == {1: 0.0, 2: 1.0, 3: None}


def test_triangles_and_clustering(spark, letters):
    v, e = letters
    loc = {r["id"]: (r["degree"], r["triangles"], r["coefficient"]) for r in G.local_clustering(v, e).collect()}
    want = {1: (2, 1, 1.0), 2: (3, 2, 2 / 3), 3: (4, 3, 0.5), 4: (3, 2, 2 / 3), 5: (3, 1, 1 / 3), 6: (1, 0, 0.0)}
    for k, (d, t, c) in want.items():
        assert loc[k][0] == d and loc[k][1] == t and loc[k][2] == pytest.approx(c)
    gl = G.global_clustering(v, e).first()
    assert gl["coefficient"] == pytest.approx(9 / 16)


def test_label_propagation_isolated_keeps_label(spark):
    v = spark.createDataFrame([(1,), (2,), (3,), (9,)], "id long")
    e = spark.createDataFrame([(1, 2), (2, 3), (1, 3)], "src long, dst long")
    got = {r["id"]: r["label"] for r in G.label_propagation(v, e, 1).collect()}
    assert got[9] == 9
    # each of 1,2,3 sees two distinct labels once: ties go to the smallest
    assert got == {1: 2, 2: 1, 3: 1, 9: 9}


def test_components_match_union_find(spark):
    import random
    rnd = random.Random(3)
    n = 200
    pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(150)]
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for i in range(n):
        comp.setdefault(find(i), []).append(i)
    want = {i: min(members) for members in comp.values() for i in members}
    v = spark.range(n).select(F.col("id"))
    e = spark.createDataFrame(pairs, "src long, dst long")
    got = {r["id"]: r["component"] for r in G.connected_components(v, e).collect()}
    assert got == want


def test_edge_list_parsing(spark, tmp_path):
    p = tmp_path / "edges.txt"
    p.write_text("1,2\n 3 , 4 , 9\n\n5,6,7\n")
    got = sorted(tuple(r) for r in src.read_edge_list(spark, str(p)).collect())
    assert got == [(1, 2, 1), (3, 4, 9), (5, 6, 7)]
    bad = tmp_path / "bad.txt"
    bad.write_text("1,2,3,4\n")
    with pytest.raises(Exception):
        src.read_edge_list(spark, str(bad)).collect()
    ips = tmp_path / "ips.txt"
    ips.write_text("10.0.0.1,10.0.0.2\n")
    got = src.read_edge_list(spark, str(ips), ip_ids=True).first()
    assert (got["src"], got["dst"], got["weight"]) == (167772161, 167772162, 1)


def test_ipv4_round_trip_and_error(spark):
    df = spark.createDataFrame([(167772160 + 5,), (4294967295,)], "v long")
    out = df.select(S.long_to_ipv4("v").alias("ip")).select("ip", S.ipv4_to_long("ip").alias("back")).collect()
    assert [(r["ip"], r["back"]) for r in out] == [("10.0.0.5", 167772165), ("255.255.255.255", 4294967295)]
    bad = spark.createDataFrame([("1.2.3",)], "ip string")
    with pytest.raises(Exception):
        bad.select(S.ipv4_to_long("ip")).collect()


def test_label_histogram_rules(spark):
    rows = [(0.0, 1.0), (2.0, 2.0), (2.0, 0.0), (1.5, 1.0), (-1.0, 1.0), (4.0, 0.5)]
    df = spark.createDataFrame(rows, "label double, w double")
    h = {r["cls"]: (r["n"], r["weight_sum"]) for r in A.label_histogram(df, "label", "w").collect()}
    assert h == {0: (1, 1.0), 1: (0, 0.0), 2: (1, 2.0), 3: (0, 0.0), 4: (1, 0.5)}
    assert A.invalid_label_count(df, "label", "w").first()["invalid"] == 2
    neg = spark.createDataFrame([(1.0, -1.0)], "label double, w double")
    with pytest.raises(Exception):
        A.label_histogram(neg, "label", "w").collect()


def test_headerless_read_of_header_file_gives_null_row(spark, tmp_path):
    p = tmp_path / "iris.csv"
    p.write_text("sepal_length,label\n5.1,0\n4.9,1\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("sepal_length", T.DoubleType()), T.StructField("label", T.DoubleType())])
    headerless = src.read_csv_schema(spark, str(p), schema, header=False).collect()
    assert len(headerless) == 3 and headerless[0]["sepal_length"] is None
    with_header = src.read_csv_schema(spark, str(p), schema, header=True).collect()
    assert [(r[0], r[1]) for r in with_header] == [(5.1, 0.0), (4.9, 1.0)]


def test_schema_document_round_trip():
    from pyspark.sql import types as T
    st = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("num", T.DecimalType(6, 0)),
                       T.StructField("new1", T.StringType())])
    assert src.schema_from_json(src.schema_to_json(st)) == st


def test_onehot_label(spark):
    lines = spark.createDataFrame([("1.0,2.0,3,4.0",), ("0.5,0.0,0,1.0",)], "value string")
    out = src.csv_to_onehot(lines, label_index=2, num_classes=4).collect()
    assert out[0]["features"] == [1.0, 2.0, 4.0] and out[0]["onehot"] == [0, 0, 0, 1]
    assert out[1]["label"] == 0 and out[1]["onehot"] == [1, 0, 0, 0]


def test_top_k_exact_with_copies_and_offset(spark):
    from tessera.operators import blocks
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(200)], "id long, v array<double>")
    for forced in (False, True):
        got = blocks.top_k(same.limit(1), same, 5, qid="id", tid="id", qvec="v", tvec="v", metric="l2",
                           block_rows=64, force_blocked=forced)
        assert sorted(r["tid"] for r in got.collect()) == [0, 1, 2, 3, 4]
    far = [(i, [1.7e9 + i * 0.5, 1.7e9 - i * 0.25]) for i in range(120)]
    f = spark.createDataFrame(far, "id long, v array<double>")
    got = {(r["qid"], r["rank"]): r["tid"] for r in blocks.top_k(f, f, 2, qid="id", tid="id", qvec="v", tvec="v",
                                                                 metric="l2", exclude_self=True).collect()}
    assert all(got[i, 1] == i - 1 and got[i, 2] == i + 1 for i in range(1, 119))
    copies = spark.createDataFrame([(i, [0.0]) for i in range(30)] + [(30, [3.0]), (31, [5.0])], "id long, v array<double>")
    near = blocks.top_k(copies, copies, 1, qid="id", tid="id", qvec="v", tvec="v", metric="l2", min_positive=True).collect()
    assert len(near) == 32 and {r["tid"] for r in near if r["qid"] < 30} == {30}


def test_classifier_rejects_labels_that_are_no_class(spark):
    from tessera.operators.knn import KNNParams, knn_classify
    t = spark.createDataFrame([(1, [0.0], 1.5), (2, [1.0], 0.0)], "id long, features array<double>, label double")
    with pytest.raises(ValueError):
        knn_classify(t, t, KNNParams(k=1, label_col="label"))


def test_class_count_metadata(spark):
    from pyspark.ml.feature import StringIndexer
    from tessera.operators.features import class_count_from_metadata
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "s string")
    idx = StringIndexer(inputCol="s", outputCol="label").fit(df).transform(df)
    assert class_count_from_metadata(idx, "label") == 3
    assert class_count_from_metadata(df.withColumn("x", F.lit(1.0)), "x") is None
