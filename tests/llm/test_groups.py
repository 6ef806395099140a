"""Splits, quota samples, names and near-duplicates against brute force and on hard rows."""

from __future__ import annotations

import math
import random
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamarack.llm import names, near_duplicates, quota_sample, splits
from tamarack.llm.flow import Flow

REC = "doc_id string, near_dup_cluster string, org string, topic_seed string, group_id string, id string, k string"


def _records(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], REC)


ROWS = [
    ("a", "c1", None, "t"),
    ("b", "c1", "X / Y", "t"),
    ("c", None, "Y", "u"),
    ("d", "", "", None),
    ("e", " ", "Z", "t"),
    ("e", " ", "Z", "t"),
    ("f", "c2", "W / Z", "t"),
    (None, "c2", "Q", "t"),
    ("g", "c:1", None, "t"),
]


def test_tied_groups(spark):
    got = {r["doc_id"]: (r["group_id"], r["group_rows"]) for r in splits.tied_groups(_records(spark, ROWS)).collect()}
    assert got == {"a": ("a", 3), "b": ("a", 3), "c": ("a", 3), "d": ("d", 1), "e": ("e", 2), "f": ("e", 2), "g": ("g", 1)}
    assert splits.tied_groups(_records(spark, ROWS).limit(0)).count() == 0


def test_splits_keep_groups_and_shares(spark):
    rng = random.Random(2)
    rows = [(f"r{k:04d}", f"c{rng.randint(0, 40)}" if rng.random() < 0.2 else None, "Hub" if k % 3 == 0 else None, rng.choice("tuv")) for k in range(3000)]
    grouped = splits.tied_groups(_records(spark, rows), keep=("topic_seed",))
    targets = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]
    out = splits.assign_splits(grouped, targets, "topic_seed").collect()
    assert len(out) == 3000
    by_group = {}
    for r in out:
        by_group.setdefault(r["group_id"], set()).add(r["split_name"])
    assert all(len(v) == 1 for v in by_group.values())
    for name, share in targets:
        assert abs(sum(r["split_name"] == name for r in out) / 3000 - share) < 0.03


def test_repeated_ids_tie_all_their_keys(spark):
    rows = [("a", "c1", "X", "t"), ("a", "c2", None, "t"), ("a", None, "M", "t"), ("a", None, None, "t"), ("b", "c2", None, "t"), ("c", None, "M", "t"), ("d", "c9", None, "t"), ("e", None, " / ".join(f"o{k}" for k in range(300)), "t"), ("f", None, "o299", "t")]
    got = {r["doc_id"]: (r["group_id"], r["group_rows"]) for r in splits.tied_groups(_records(spark, rows)).collect()}
    assert got == {"a": ("a", 3), "b": ("a", 3), "c": ("a", 3), "d": ("d", 1), "e": ("e", 2), "f": ("e", 2)}


@pytest.mark.parametrize("giant", [0.05, 0.3, 0.9])
def test_giants_keep_the_shares(spark, giant):
    n = 2000
    rows = [(f"r{k:04d}", None, "Hub" if k < giant * n else f"s{k // 8}" if k % 3 else None, "t") for k in range(n)]
    grouped = splits.tied_groups(_records(spark, rows), keep=("topic_seed",))
    out = splits.assign_splits(grouped, [("train", 0.8), ("validation", 0.1), ("test", 0.1)], "topic_seed").collect()
    sizes = {s: sum(r["split_name"] == s for r in out) / n for s in ("train", "validation", "test")}
    assert len({r["split_name"] for r in out if r["group_id"] == "r0000"}) == 1
    assert sizes["train"] >= 0.77 if giant < 0.9 else sizes["train"] >= 0.9


def test_splits_of_nothing(spark):
    grouped = splits.tied_groups(_records(spark, ROWS).limit(0), keep=("topic_seed",))
    assert splits.assign_splits(grouped, [("train", 1.0)], "topic_seed").count() == 0


def test_flow_is_cheapest():
    net = Flow()
    cheap, dear = net.arc("s", "a", 3, 1), net.arc("s", "b", 5, 2)
    net.arc("a", "t", 10, 0)
    net.arc("b", "t", 2, 0)
    net.arc("b", "a", 9, 4)
    assert net.send("s", "t", 7) == 7
    assert (net.used(cheap), net.used(dear)) == (3, 4)
    assert net.send("s", "t", 9) == 1


def test_quotas_report_and_draw(spark):
    rows = [(f"r{k}", None, None, "Big topic" if k < 60 else "small") for k in range(64)] + [(f"c{k}", f"cl{k % 5}", None, "big-Topic ") for k in range(20)] + [("r1", None, None, "big topic"), ("n", None, None, None)]
    records = _records(spark, rows).withColumn("topic_seed", splits.canonical_topic(F.col("topic_seed")))
    units = quota_sample.units_of(records, "doc_id", "topic_seed", "near_dup_cluster")
    assert {(r["category"], r["kind"]): r["count"] for r in units.groupBy("category", "kind").count().collect()} == {("big_topic", "single"): 60, ("big_topic", "cluster"): 5, ("small", "single"): 4}
    targets = spark.createDataFrame([(1, "big_topic", 0.75, 0, 40), (1, "small", 0.25, 0, 40), (2, "big_topic", 1.0, 66, 10), (2, "absent", 0.0, 0, 10), (3, "small", 0.1001, 0, 40)], "plan_id long, category string, share double, min_rows long, sample_rows long")
    quotas, report = quota_sample.solve(units, targets)
    got = {(r["plan_id"], r["category"]): (r["drawn"], r["shortfall"]) for r in report.collect()}
    # what a short category leaves over goes to the others, so plan 1 still draws its 40 rows
    assert got == {(1, "big_topic"): (36, 0), (1, "small"): (4, 6), (2, "big_topic"): (65, 1), (2, "absent"): (0, 0), (3, "small"): (4, 1)}
    drawn = quota_sample.draw(units, quotas).collect()
    assert len(drawn) == len({(r["plan_id"], r["id"]) for r in drawn}) == sum(d for d, _ in got.values())


def _best(total, floors, targets, units):
    """The least sum of squared distances from the targets, each in shares of its target, over all draws of ``total``."""
    ranges = [range(f, u + 1) for f, u in zip(floors, units, strict=True)]
    found = [d for d in product(*ranges) if sum(d) == total]
    return min(found, key=lambda d: sum((x - t) ** 2 / max(t, 1) for x, t in zip(d, targets, strict=True)), default=None)


def test_quotas_keep_total_floors_and_shares():
    rng = random.Random(4)
    for _ in range(60):
        shares = [rng.random() for _ in range(3)]
        shares = [x / sum(shares) for x in shares]
        size, floors, units = rng.randint(5, 30), [rng.choice([0, 0, 2, 6]) for _ in range(3)], [rng.randint(0, 30) for _ in range(3)]
        targets = [{"plan_id": 1, "category": c, "share": s, "min_rows": f, "sample_rows": size} for c, s, f in zip("abc", shares, floors, strict=True)]
        quotas, report = quota_sample.plan_quotas(targets, {(c, k): u // 2 + (u % 2) * (k == "single") for c, u in zip("abc", units, strict=True) for k in quota_sample.KINDS})
        drawn = [r[5] for r in report]
        kept = [min(f, u) for f, u in zip(floors, units, strict=True)]
        assert all(k <= d <= u for k, d, u in zip(kept, drawn, units, strict=True))
        assert sum(drawn) == min(max(size, sum(kept)), sum(units)) == sum(q[3] for q in quotas)
        assert [r[6] for r in report] == [max(0, math.ceil(max(s * size, f) - 1e-9) - u) for s, f, u in zip(shares, floors, units, strict=True)]
        best = _best(sum(drawn), kept, [s * size for s in shares], units)
        assert all(abs(x - y) <= max(2, 0.2 * y) for x, y in zip(drawn, best, strict=True)), (drawn, best)
        assert abs(sum(r[8] for r in report) - (1 if sum(drawn) else 0)) < 1e-9


def test_floor_that_binds_takes_from_the_others():
    targets = [{"plan_id": 1, "category": c, "share": s, "min_rows": f, "sample_rows": 100} for c, s, f in (("a", 0.9, 0), ("b", 0.1, 50))]
    _, report = quota_sample.plan_quotas(targets, {(c, "single"): 1000 for c in "ab"})
    assert [(r[5], r[6]) for r in report] == [(50, 0), (50, 0)]
    doubled, _ = quota_sample.plan_quotas([{"plan_id": 1, "category": "a", "share": 0.5, "min_rows": m, "sample_rows": 10} for m in (0, 3)], {("a", "single"): 50})
    assert doubled == [(1, "a", "single", 10)]


def test_quotas_of_nothing(spark):
    units = quota_sample.units_of(_records(spark, ROWS).limit(0), "doc_id", "topic_seed", "near_dup_cluster")
    targets = spark.createDataFrame([(1, "t", 1.0, 0, 5)], "plan_id long, category string, share double, min_rows long, sample_rows long")
    quotas, report = quota_sample.solve(units, targets)
    assert report.first()["shortfall"] == 5 and quota_sample.draw(units, quotas).count() == 0
    assert quota_sample.solve(units, targets.limit(0))[1].count() == 0


SAME = [
    ["Canadian Dental Hygiene Policy Alliance", "Can. Dental Hygiene Policy Allnce", "CANADIAN DENTAL HYGIENE POLICY ALLIANCE", "Alliance of Canadian Dental Hygiene Policy", "Dental Hygiene Policy Alliance, Canadian", "The Canadian Dental Hygiene Policy Alliance", "Canadian Dental Hygiene Policy Alliance (CDHPA)", "CDHPA", "Canadain Dental Hygeine Policy Alliance", "Canadian Dental Hygiene Policy Alliance, Inc."],
    ["Canadian Dental Hygiene Policy Council"],
    ["National Dental Hygiene Policy Alliance", "Nat'l Dental Hygiene  Policy Alliance"],
    ["Oxenford Rural Sleep Network", "Oxenford Rural Sleep", "Oxenford - Rural Sleep Ntwk."],
    ["Oxenford Family Sleep Network"],
    ["Margaret Embrewell-Plonellini", "Embrewell Plonellini, Maggie", "M. Embrewell-Plonellini", "Mx. Margaret H. Embrewell-Plonellini", "Embrewell Plonellini Margaret", "margaret embrewell plonellini", "Margaret Embrewel-Plonellini"],
    ["Margaret Embrewell-Stovander"],
    ["Zoé Isterander-Selvetti", "Zoe Isterander Selvetti"],
    ["James Abromont-Karstardic", "Jim Abromont-Karstardic"],
    ["Jennifer Abromont-Karstardic"],
    ["J. Abromont-Karstardic"],
    ["x"],
    ["…"],
]


def test_name_variants(spark):
    rows = [(n, "clash") for g in SAME for n in g] * 2 + [(None, ""), ("", ""), ("  ", "")]
    got = names.link_names(spark.createDataFrame(rows, "org string, name string"), "org").collect()
    entity = {r["name"]: r["entity"] for r in got}
    assert len(entity) == len(got) == sum(map(len, SAME))
    assert sorted(sorted(n for n in entity if entity[n] == e) for e in set(entity.values())) == sorted(map(sorted, SAME))
    assert names.link_names(spark.createDataFrame([], "org string"), "org").count() == 0


def test_slips():
    assert [names.slips(a, b) for a, b in (("abc", "abc"), ("abc", "acb"), ("abc", "ab"), ("abcd", "badc"), ("abc", "xyz"), ("a", "abcd"))] == [0, 1, 1, 2, 3, 3]


def _texts():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    out = []
    for k in range(60):
        base = [rng.choice(words) for _ in range(60)]
        out.append((f"d{k:03d}", " ".join(base)))
        for v in range(2):
            copy = list(base)
            for _ in range(rng.randint(1, 12)):
                copy[rng.randrange(60)] = rng.choice(words)
            out.append((f"d{k:03d}v{v}", ", ".join(copy).upper()))
    return out + [("copy1", "One two three four"), ("copy2", "one, TWO three: four!"), ("copy2", "one, TWO three: four!"), ("short", "one two"), ("none", None), ("empty", ""), (None, "one two three four")]


def _jaccard(texts, size):
    sets = {}
    for key, t in texts:
        w = "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
        if key and len(w) >= size:
            sets[key] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    return {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in combinations(sorted(sets), 2)}


@pytest.mark.parametrize(("threshold", "size"), [(0.5, 3), (0.8, 5)])
def test_near_duplicates_against_brute_force(spark, threshold, size):
    texts = _texts()
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts], "k string, t string, id string, num int")
    members, links = near_duplicates.similar_classes(df, "k", "t", threshold, size)
    got = {tuple(r) for r in near_duplicates.similar_pairs(members, links).collect()}
    want = {p for p, j in _jaccard(texts, size).items() if j >= threshold}
    assert got <= want and len(got) >= 0.95 * len(want)
    if size == 3:
        assert ("copy1", "copy2") in got


def test_long_runs_lose_nothing(spark):
    body = " ".join(f"w{k}" for k in range(100))
    df = spark.createDataFrame([(f"d{k:02d}", f"{body} extra{k}") for k in range(12)] + [(f"c{k}", body) for k in range(5)], "k string, t string")
    members, links = near_duplicates.similar_classes(df, "k", "t", 0.8, 5, long_run=3)
    assert near_duplicates.similar_pairs(members, links).count() == 17 * 16 // 2


def test_near_duplicates_of_nothing(spark):
    members, links = near_duplicates.similar_classes(spark.createDataFrame([], "k string, t string"), "k", "t")
    assert members.count() == 0 and links.count() == 0


def test_bands_keep_the_miss_probability():
    for threshold in (0.5, 0.8):
        for rows in (3, near_duplicates.ROWS, 8):
            assert (1 - threshold**rows) ** near_duplicates.bands_for(rows, threshold) <= near_duplicates.MISS_AT_THRESHOLD


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_classes_that_share_a_number_are_compared(spark, bits):
    body = " ".join(f"w{k}" for k in range(100))
    df = spark.createDataFrame([(f"d{k:02d}", f"{body} extra{k}") for k in range(6)] + [("z", "something else that is long enough to have shingles")], "k string, t string")
    members, links = near_duplicates.similar_classes(df, "k", "t", 0.8, 5, number_bits=bits)
    assert near_duplicates.similar_pairs(members, links).count() == 15


def test_short_names_go_to_the_clear_winner(spark):
    def entities(rows):
        return {r["name"]: r["entity"] for r in names.link_names(spark.createDataFrame([(n,) for n in rows], "org string"), "org").collect()}

    many = ["Oxenford Rural Sleep Network", "The Oxenford Rural Sleep Network", "Oxenford Rural Sleep Network Inc.", "Oxenford  Rural Sleep Ntwk."]
    other = "Orchard Regional Seniors Network"
    got = entities([*many, other, "ORSN"])
    assert len({got[n] for n in [*many, "ORSN"]}) == 1 and got[other] == other
    # without a clear winner the short form stays alone
    got = entities([many[0], many[1], other, "ORSN"])
    assert got["ORSN"] == "ORSN" and got[many[0]] == got[many[1]] != got[other]


def test_given_names_outside_all_lists_and_names_without_words(spark):
    rows = ["Kwame Owusu", "K. Owusu", "Owusu, Kwame", "Tane Rangihau", "Tui Rangihau", "T. Rangihau", "The", "Inc.", "???", "---"]
    got = {r["name"]: (r["entity"], r["score"]) for r in names.link_names(spark.createDataFrame([(n,) for n in rows], "org string"), "org").collect()}
    assert {got[n][0] for n in rows[:3]} == {"K. Owusu"} and got["K. Owusu"][1] == 1
    # two people offer the initial, and none has a clear lead
    assert got["T. Rangihau"] == ("T. Rangihau", 0)
    assert all(got[n][0] == n for n in rows[3:])


def _bucket(n, near, seed=5):
    """One part's entries under one band key: random sketches, of which each of the first ``near`` is one bit off the next number's."""
    rng = np.random.default_rng(seed)
    e = rng.integers(0, 1 << 64, (n, 1 + near_duplicates.SKETCH_WORDS), dtype=np.uint64)
    e[:, 0] = (np.uint64(9) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    for k in range(0, 2 * near, 2):
        e[k + 1, 1:] = e[k, 1:]
        e[k + 1, 1] ^= np.uint64(1)
    return rng.permutation(np.concatenate([e, e[:7]]))


@pytest.mark.parametrize(("n", "long_run"), [(40, 4000), (500, 4000), (500, 100), (70, 3)])
def test_chance_candidates_never_leave_their_bucket(n, long_run):
    e = _bucket(n, 20)
    want = [(k << 32) | (k + 1) for k in range(0, 40, 2)]
    pairs, runs = near_duplicates._pairs_in(e, long_run, 67)
    assert pairs.tolist() == (want if n <= long_run else [])
    # what leaves the task that met the entries is the likely pairs, or a run too long for it, once each
    emitted = list(near_duplicates._bucket_pairs(long_run, 67)(iter([pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([e.tobytes()])], ["part", "entries"])])))
    rows = [r for b in emitted for r in b.to_pylist()]
    assert sum(len(r["pairs"] or b"") for r in rows) == 8 * len(pairs)
    assert sum(len(r["entries"] or b"") for r in rows) == (n * near_duplicates.ENTRY_BYTES if n > long_run else 0)
    blocks = [r["entries"] for r in rows if r["entries"]]
    held = pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*[(x, y) for k, x in enumerate(blocks) for y in blocks[k:]], strict=True)] or [pa.array([], pa.binary())] * 2, ["x", "y"])
    met = [v for b in near_duplicates._block_pairs(67)(iter([held])) for v in np.frombuffer(b.column(0)[0].as_py(), np.uint64).tolist()]
    assert sorted({*met, *pairs.tolist()}) == want


def test_ids_in_several_classes_pair_once(spark):
    body = " ".join(f"w{k}" for k in range(100))
    rows = [("a", body), ("a", f"{body} more"), ("a", f"{body} most"), ("b", body), ("b", f"{body} more"), ("c", body), ("c", body), ("d", f"{body} else"), ("e", "nothing like any of the others here")]
    members, links = near_duplicates.similar_classes(spark.createDataFrame(rows, "k string, t string"), "k", "t")
    assert sorted(map(tuple, near_duplicates.similar_pairs(members, links).collect())) == list(combinations("abcd", 2))


def test_chance_candidates_are_not_written(spark, tmp_path):
    # each two of the texts have a third of their words in common, so that about 40,000 pairs share a band and none is near
    shared = " ".join(f"w{k}" for k in range(100))
    df = spark.createDataFrame([(f"d{d:03d}", f"{shared} " + " ".join(f"x{d}y{k}" for k in range(100))) for d in range(400)], "k string, t string")
    context = spark.sparkContext
    before = context.getCheckpointDir()
    context.setCheckpointDir(str(tmp_path / "checkpoints"))
    try:
        members, links = near_duplicates.similar_classes(df, "k", "t", 0.5, 3)
        assert members.count() == 400 and links.count() == 0
        assert sum(p.stat().st_size for p in tmp_path.rglob("part-*")) < 400 * 1000
    finally:
        context.setCheckpointDir(before or str(tmp_path / "later"))
