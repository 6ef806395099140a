from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from tamarack.operators import dedupe, harvest, ids, labels, qa, sampling, splits
from tamarack.operators.components import hash_to_min
from tamarack.operators.latest import latest
from tamarack.plans.ranking import hash_order, hash_rank
from tamarack.plans.skew import lookup_join


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(f"n{rng.randint(0, 150):03d}", f"n{rng.randint(0, 150):03d}") for _ in range(110)] + [("hub", f"n{k:03d}") for k in range(0, 40)] + [("x", None), ("s", "s")]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None:
            parent[find(a)] = find(b)
    groups = {}
    for x in list(parent):
        groups.setdefault(find(x), []).append(x)
    want = {x: min(g) for g in groups.values() for x in g}
    got = {r["node"]: r["component"] for r in hash_to_min(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == want
    assert hash_to_min(spark.createDataFrame([], "a string, b string")).count() == 0


def test_lookup_join_with_a_hot_key(spark, monkeypatch):
    import tamarack.plans.skew as skew

    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    left = spark.createDataFrame([("hot", k) for k in range(100)] + [("cold", 100), (None, 101), ("gone", 102)], "k string, i int")
    right = spark.createDataFrame([("hot", 100, "H"), ("cold", 1, "C")], "k string, n long, v string")
    got = {r["i"]: r["v"] for r in lookup_join(left, right, "k", "n", 103, F.col("i")).collect()}
    assert got == {**dict.fromkeys(range(100), "H"), 100: "C", 101: None, 102: None}


def test_split_join_with_a_hot_key(spark, monkeypatch):
    import tamarack.plans.skew as skew

    monkeypatch.setattr(skew, "SPLIT_ROWS", 10)
    left = spark.createDataFrame([("hot", k) for k in range(100)] + [("cold", 100), (None, 101), ("gone", 102)], "k string, i int")
    right = spark.createDataFrame([("hot", k) for k in range(7)] + [("cold", 8), (None, 9)], "k string, j int")
    got = sorted((r["k"], r["i"], r["j"]) for r in skew.split_join(left, right, "k", 103, F.col("i")).collect())
    assert got == sorted([("hot", i, j) for i in range(100) for j in range(7)] + [("cold", 100, 8)])


def test_hash_rank_is_a_rank(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id").withColumn("h", hash_order(1, F.col("id").cast("string")))
    rows = hash_rank(df, ["g"], "h").collect()
    for g in range(3):
        own = sorted((r["h"], r["rank"]) for r in rows if r["g"] == g)
        assert [r for _, r in own] == list(range(1, len(own) + 1))


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y"), (None, 9, "z")], "k string, n long, v string")
    assert sorted(tuple(r) for r in latest(df, "k", "n").collect()) == [("a", 3, None), ("b", 2, "y")]


def test_exact_marks(spark):
    df = spark.createDataFrame([("c", "A  b", ""), ("a", "a B", ""), ("b", "a b", "old"), ("d", None, ""), ("e", "z", "")], "doc_id string, t string, was string")
    got = {r["doc_id"]: (r["duplicate_of"], r["group_size"]) for r in dedupe.mark_exact(df, "doc_id", F.col("t"), "was").collect()}
    assert got == {"a": (None, 3), "b": ("old", 3), "c": ("a", 3), "e": (None, 1)}


def _cos(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))


def test_cosine_pairs_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "BLOCK", 7)
    rng = random.Random(1)
    vectors = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(40)] + [[0.0] * 6]
    vectors[3] = [x * 2 for x in vectors[9]]
    df = spark.createDataFrame([*enumerate(vectors), (99, None), (3, vectors[3])], "i int, v array<double>")
    got = {(r["a"], r["b"]): r["similarity"] for r in dedupe.cosine_pairs(df, "i", "v", 0.6).collect()}
    want = {(a, b): _cos(vectors[a], vectors[b]) for a in range(40) for b in range(a + 1, 40) if _cos(vectors[a], vectors[b]) >= 0.6}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    near = {(r["a"], r["b"]) for r in dedupe.cosine_pairs_lsh(df, "i", "v", 0.95, tables=20, bits=4).collect()}
    assert (3, 9) in near and near <= {k for k, v in want.items() if v >= 0.95}


def test_clusters_and_semantic_duplicates(spark):
    pairs = spark.createDataFrame([(1, 2, 0.99), (2, 3, 0.93), (7, 8, 0.985), (5, 6, 0.91), (10, 11, 0.90)], "a long, b long, similarity double")
    got = {r["id"]: r["cluster"] for r in dedupe.near_clusters(pairs).collect()}
    assert got == {1: "ndc_001", 2: "ndc_001", 3: "ndc_001", 5: "ndc_002", 6: "ndc_002", 7: "ndc_003", 8: "ndc_003"}
    marks = spark.createDataFrame([(7, 1)], "id long, duplicate_of long")
    assert sorted(tuple(r) for r in dedupe.semantic_duplicates(pairs, marks).collect()) == [(2, 1)]


def test_topics(spark):
    rows = [
        ("Indigenous people", "x", "unlabeled", "indigenous_health"),
        ("vaccine and outbreak", "Cancer care", "public_health", "cancer"),
        ("vaccine only", "Children's Health", "unlabeled", "public_health"),
        ("MÉTIS nation", None, "indigenous_health", "indigenous_health"),
        ("nothing", "Study of opioid use", "public_health", "public_health"),
        (None, None, "unlabeled", "unlabeled"),
    ]
    df = spark.createDataFrame(rows, "card string, title string, c string, t string")
    got = labels.with_topics(df, "card", "title", content_first="cf", title_first="tf").collect()
    for r in got:
        assert (r["cf"], r["tf"]) == (r["c"], r["t"])


def test_rules_document():
    rules, fallback, exempt = labels.rules_from({"topics": [{"code": "a", "keywords": ["x"]}], "fallback": "none", "title_exempt_studies": ["Y Z"]})
    assert rules == (("a", (), ("x",)),) and fallback == "none" and exempt == ("y z",)


def test_stakeholders_fall_back_in_order(spark):
    lookup = spark.createDataFrame([("A / B", "whole"), ("B", "bee"), ("C", "cee"), ("C", "cee")], "org string, stakeholder_type string")
    rows = [(1, "A / B"), (2, "X / C / B"), (3, "Tremblay, Anne"), (4, "Tremblay Dionne, Anne"), (5, None), (6, ""), (7, "C")]
    got = {r["i"]: r["stakeholder_type"] for r in labels.stakeholders(spark.createDataFrame(rows, "i int, o string"), "o", lookup).collect()}
    assert got == {1: "whole", 2: "cee", 3: "individual", 4: None, 5: None, 6: None, 7: "cee"}


def test_procedural_selection(spark):
    studies = spark.createDataFrame([("1", "Briefing on X"), ("2", "Briefing on Y"), ("3", "Study of Bill C-2"), ("4", "Cancer")], "study_id string, title string")
    listed = spark.createDataFrame([(" 2 ",)], "study_activity_id string")
    got = {r["study_id"]: (r["reason"], r["kept"]) for r in harvest.select_studies(studies, listed).collect()}
    assert got == {"1": ("starts_with:Briefing on", False), "2": (None, True), "3": ("contains:Bill C-", False), "4": (None, True)}


def _split_tables(spark):
    rows = [(f"d{k:02d}", "t1" if k < 12 else "t2", "") for k in range(20)] + [("e1", "t1", "c1"), ("e2", "t2", "c1"), ("e3", "t2", "c1"), ("g1", "t1", "c2"), ("e4", "t1", "c2")]
    corpus = spark.createDataFrame(rows, "doc_id string, topic_seed string, near_dup_cluster string")
    return corpus, spark.createDataFrame([("g1",), ("d00",)], "doc_id string"), spark.createDataFrame([("d01",)], "doc_id string")


def test_splits(spark):
    corpus, gold, dups = _split_tables(spark)
    assert [r[0] for r in splits.contaminated_clusters(corpus, gold, dups).collect()] == ["c2"]
    kept = splits.eligible(corpus, gold, dups)
    assert kept.count() == 21
    units = {r["unit"]: (r["topic"], r["n_docs"]) for r in splits.split_units(kept).collect()}
    assert units["c:c1"] == ("t2", 3) and len(units) == 19
    for split in (splits.train_dev(kept), splits.train_dev_seeded(kept)):
        counts = {r["topic"]: (r["n_units"], r["dev"] + r["train"]) for r in splits.topic_counts(split).collect()}
        assert counts == {"t1": (10, 10), "t2": (9, 11)}
        assert all(r["n_broken"] == 0 for r in splits.checks(split, corpus, gold, dups).collect())
        assert split.filter("split = 'dev'").select("unit").distinct().count() == 2


def test_seeded_split_follows_one_generator_through_the_topics(spark):
    rows = [(f"d{k:02d}", "abc"[k % 3], "") for k in range(31)]
    got = splits.train_dev_seeded(spark.createDataFrame(rows, "doc_id string, topic_seed string, near_dup_cluster string"), seed=42).collect()
    rng, dev = random.Random(42), set()
    for topic in "abc":
        own = sorted(d for d, t, _ in rows if t == topic)
        rng.shuffle(own)
        dev |= set(own[: max(1, round(len(own) * 0.1))])
    assert {r["doc_id"] for r in got if r["split"] == "dev"} == dev and len(got) == 31


def test_allocation(spark):
    df = spark.createDataFrame([("a", 3), ("b", 10), ("c", 40), ("d", 200)], "t string, n long")
    got = {r["t"]: r["quota"] for r in sampling.allocate(df, "t", "n", "t", 180, 10).collect()}
    assert got["a"] == 3 and got["b"] == 10 and sum(got.values()) == 180
    small = {r["t"]: r["quota"] for r in sampling.allocate(df, "t", "n", "t", 5, 10).collect()}
    assert small == {"a": 3, "b": 10, "c": 10, "d": 10}


def test_distribution_and_percentiles(spark):
    df = spark.createDataFrame([(v,) for v in (10, 1, 3, 2, 4)], "v int")
    row = qa.distribution(df, F.col("v")).first()
    assert (row["min"], row["p25"], row["median"], row["p75"], row["p95"], row["max"]) == (1, 1, 3, 7, 14, 10)
    got = qa.index_percentiles(df, F.col("v"), p50=0.5, p90=0.9).first()
    assert (got["p50"], got["p90"], got["mean"]) == (3, 10, 4.0)
    assert qa.distribution(df.limit(0), F.col("v")).first()["min"] is None


def test_next_ids_fill_gaps(spark, monkeypatch):
    monkeypatch.setattr(ids, "RANGE", 4)
    used = spark.createDataFrame([(f"p_{n:04d}",) for n in (1, 2, 4, 5, 6, 7, 8, 9, 12)] + [("p_10001",), ("q_x",)], "u string")
    new = spark.createDataFrame([("p", k) for k in range(5)] + [("q", 7), (None, 8)], "prefix string, key long")
    got = ids.next_ids(new, used, "prefix", "key", "u").collect()
    assert sorted(r["new_id"] for r in got) == ["p_0003", "p_0010", "p_0011", "p_0013", "p_0014", "q_0001"]


def test_value_counts_and_pivot(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "y")], "r string, c string")
    assert {(r["field"], r["value"]): r["n_rows"] for r in qa.value_counts(df, "c").collect()} == {("c", "x"): 1, ("c", "unknown"): 1, ("c", "y"): 1}
    assert {r["r"]: r["total"] for r in qa.pivot_counts(df, "r", "c", ["x", "y"]).collect()} == {"a": 2, None: 2}


def test_ids_outgrow_their_digits(spark, monkeypatch):
    monkeypatch.setattr(ids, "RANGE", 50)
    new = spark.createDataFrame([("p", k) for k in range(120)], "prefix string, key long")
    got = {r["new_id"] for r in ids.next_ids(new, spark.createDataFrame([("p_07",)], "u string"), "prefix", "key", "u", digits=2).collect()}
    assert got == {f"p_{n:02d}" for n in range(1, 122) if n != 7}


def test_last_lookup_row_wins(spark):
    lookup = spark.createDataFrame([("A", "z", 1), ("A", "b", 2)], "org string, stakeholder_type string, line long")
    docs = spark.createDataFrame([(1, "A")], "i int, o string")
    assert [labels.stakeholders(docs, "o", lookup, order).first()["stakeholder_type"] for order in ("line", None)] == ["b", "z"]
