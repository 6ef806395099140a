"""Samples that match target category proportions (problem 2).

The records are counted by cell (category x kind of unit). On the driver the counts and the targets of a
plan make a small network: one arc carries the plan's total, a category's arcs carry its floor, its target
and, at a cost that rises with the distance from the target, what it may take over from others; cells carry
what is available. The minimum-cost flow keeps the total and the floors wherever the units allow it and
spreads what a short category leaves over; slack arcs give the shortfalls. Cell quotas are rounded at random
and drawn by hash order: one histogram of hash buckets finds the bucket in which each quota ends.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.functions.basic import nonblank
from tamarack.llm.flow import Flow
from tamarack.llm.splits import canonical_topic
from tamarack.plans.lineage import cut
from tamarack.sources.tables import table

KINDS = ("single", "cluster")
#: Hash buckets of a cell's histogram; the last bucket that a quota touches holds about 1/BUCKETS of the cell.
BUCKETS = 4096
#: The units of a category are priced by how much of its target is drawn already, in steps of 1/STEPS of the target, beyond it of an eighth of what is drawn, up to MOST times it.
STEPS, MOST = 16, 64
#: Each unit that a slack arc carries costs more than any other way through the network.
SLACK_COST = 1_000_000
#: Plans are small: more targets than this are refused, as they go through the driver.
MOST_TARGETS = 100_000
QUOTA_SCHEMA = "plan_id long, category string, kind string, quota long"
REPORT_SCHEMA = "plan_id long, category string, need double, need_units long, units long, drawn long, shortfall long, target_share double, achieved_share double"


def units_of(records: DataFrame, id_col: str, category_col: str, cluster_col: str) -> DataFrame:
    """Sampling units: one per record without cluster and one per cluster in each category it occurs in.

    Rows: category, kind, unit, id (the smallest record id of the unit). Repeated rows count once;
    rows without id or category make no unit. Columns with other names are ignored.
    """
    base = records.select(F.col(id_col).cast("string").alias("id"), F.col(category_col).alias("category"), nonblank(F.col(cluster_col)).alias("cl")).filter("id is not null and category is not null")
    unit = F.coalesce(F.concat(F.lit("c:"), "cl"), F.concat(F.lit("r:"), "id"))
    return base.groupBy("category", F.when(F.col("cl").isNull(), KINDS[0]).otherwise(KINDS[1]).alias("kind"), unit.alias("unit")).agg(F.min("id").alias("id"))


def _u(*parts: object) -> float:
    """A uniform number in [0, 1) that depends only on the parts."""
    return int.from_bytes(hashlib.blake2b("|".join(map(str, parts)).encode(), digest_size=7).digest(), "big") / 2**56


def _rounded(parts: dict[str, float], total: int, seed: tuple) -> dict[str, int]:
    """Integers near the parts with the given sum: floors, then the rest by a random draw on the fractions."""
    out = {k: math.floor(v + 1e-9) for k, v in parts.items()}
    order = sorted(parts, key=lambda k: (-(max(0.0, parts[k] - out[k]) + 1e-12) / -math.log(_u(*seed, k) + 1e-18), k))
    for k in order[: max(0, total - sum(out.values()))]:
        out[k] += 1
    return out


def _prices(floor: int, margin: int, total: int) -> list[tuple[int, int]]:
    """(units, price) of the arcs by which a category is drawn: its floor is free, then the price rises with the part of the margin drawn."""
    out, at, step = [(floor, 0)], floor, max(1, margin // STEPS)
    while margin and at < min(total, MOST * margin):
        after = min(at + step, margin) if at < margin else at + max(step, at // 8)
        out.append((after - at, 1 + 1000 * at // margin))
        at = after
    return [*out, (total, 1 + 1000 * MOST)]


def _flow(total: int, margin: dict[str, int], floors: dict[str, int], asked: dict[str, int], counts: dict[tuple[str, str], int]) -> tuple[dict[str, int], dict[str, int]]:
    """(drawn, shortfall) by category of one plan.

    The draw: ``total`` units go through the categories to the cells, each at the price of its part of the
    margin, so what floors take and short categories leave over is spread in proportion. The test: what is
    asked of a category goes to its cells' units, the rest over slack.
    """
    net, taken, slack = Flow(), {}, {}
    net.arc("source", "plan", total, 0)
    for c, m in margin.items():
        taken[c] = [net.arc("plan", ("draw", c), n, price) for n, price in _prices(floors[c], m, total)]
        net.arc("source", ("test", c), asked[c], 0)
        slack[c] = net.arc(("test", c), "sink", asked[c], SLACK_COST)
        for k in KINDS:
            for use in ("draw", "test"):
                net.arc((use, c), (use, c, k), counts.get((c, k), 0), 0)
                net.arc((use, c, k), "sink", counts.get((c, k), 0), 0)
    net.send("source", "sink", total + sum(asked.values()))
    return {c: sum(map(net.used, taken[c])) for c in margin}, {c: net.used(slack[c]) for c in margin}


def plan_quotas(targets: list[dict], counts: dict[tuple[str, str], int], seed: int = 42) -> tuple[list[tuple], list[tuple]]:
    """Quotas by plan and cell, and the report by plan and category.

    ``targets``: dicts with plan_id, category, share, min_rows, sample_rows; shares of repeated targets of a
    plan and category add up, of the other figures the greatest counts. ``counts``: units by (category, kind).
    The rows drawn are sample_rows, or the share of them that the targets cover, or the sum of the floors where that is
    more, as far as there are units. A category falls short where its units are fewer than the greater of share x
    sample_rows, not rounded, and min_rows; the shortfall is counted against that need, rounded up.
    """
    quotas, report = [], []
    for plan in sorted({t["plan_id"] for t in targets}):
        rows = [t for t in targets if t["plan_id"] == plan]
        size = max(int(t["sample_rows"]) for t in rows)
        names = sorted({t["category"] for t in rows})
        share = {c: sum(float(t["share"]) for t in rows if t["category"] == c) for c in names}
        floors = {c: max(int(t["min_rows"]) for t in rows if t["category"] == c) for c in names}
        units = {c: sum(counts.get((c, k), 0) for k in KINDS) for c in names}
        need = {c: max(share[c] * size, float(floors[c])) for c in names}
        total = round(size * min(1.0, sum(share.values())))
        margin = _rounded({c: share[c] * size for c in names}, total, (seed, plan))
        kept = {c: min(floors[c], units[c]) for c in names}
        drawn, short = _flow(max(total, sum(kept.values())), margin, kept, {c: math.ceil(need[c] - 1e-9) for c in names}, counts)
        whole = sum(drawn.values())
        for c in names:
            cells = _rounded({k: drawn[c] * counts.get((c, k), 0) / max(1, units[c]) for k in KINDS}, drawn[c], (seed, plan, c))
            quotas += [(plan, c, k, q) for k, q in cells.items() if q]
            report.append((plan, c, need[c], math.ceil(need[c] - 1e-9), units[c], drawn[c], short[c], share[c], drawn[c] / whole if whole else 0.0))
    return quotas, report


def solve(units: DataFrame, targets: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(quotas, report) of the targets; the driver gets one row per target, at most MOST_TARGETS, and one per cell of a target's category."""
    spark = units.sparkSession
    wanted = [r.asDict() for r in targets.limit(MOST_TARGETS + 1).collect()]
    if len(wanted) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    listed = spark.createDataFrame(sorted({(t["category"],) for t in wanted}), "category string")
    cells = units.join(F.broadcast(listed), "category", "left_semi").groupBy("category", "kind").count()
    counts = {(r["category"], r["kind"]): r["count"] for r in cells.collect()}
    quotas, report = plan_quotas(wanted, counts, seed)
    return spark.createDataFrame(quotas, QUOTA_SCHEMA), spark.createDataFrame(report, REPORT_SCHEMA)


def draw(units: DataFrame, quotas: DataFrame, seed: int = 42) -> DataFrame:
    """Rows (plan_id, category, kind, id): for each quota that many units of its cell, by hash order.

    Units are counted once by cell and bucket; each plan goes through the buckets from a place of its own.
    ``quotas`` comes from ``solve``, which bounds its rows.
    """
    placed = units.withColumn("h", F.xxhash64(F.lit(seed), "unit")).withColumn("b", F.pmod(F.shiftright("h", 20), F.lit(BUCKETS)))
    sizes = placed.groupBy("category", "kind", "b").count()
    turn = F.pmod(F.col("b") + F.xxhash64(F.lit(seed), "plan_id"), F.lit(BUCKETS))
    turned = sizes.join(F.broadcast(quotas), ["category", "kind"]).withColumn("place", turn)
    before = F.coalesce(F.sum("count").over(W.partitionBy("plan_id", "category", "kind").orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edges = turned.withColumn("before", before).filter(F.col("before") < F.col("quota")).select("plan_id", "category", "kind", "b", (F.col("quota") - F.col("before")).alias("room"), (F.col("quota") - F.col("before") < F.col("count")).alias("partial"))
    inside = placed.join(edges, ["category", "kind", "b"])
    whole = inside.filter("not partial")
    last = inside.filter("partial").withColumn("rn", F.row_number().over(W.partitionBy("plan_id", "category", "kind", "b").orderBy("h", "unit"))).filter("rn <= room").drop("rn")
    return whole.unionByName(last).select("plan_id", "category", "kind", "id")


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    records = table(spark, sf, "corpus_fixture", "doc_id", "topic_seed", "near_dup_cluster")
    units = units_of(records.withColumn("topic_seed", canonical_topic(F.col("topic_seed"))), "doc_id", "topic_seed", "near_dup_cluster")
    raw = table(spark, sf, "topic_targets").filter("plan_id is not null and target_share is not null")
    targets = raw.select("plan_id", canonical_topic(F.col("topic_seed")).alias("category"), F.col("target_share").alias("share"), F.coalesce("min_rows", F.lit(0)).alias("min_rows"), F.coalesce("sample_rows", F.lit(0)).alias("sample_rows")).filter("category is not null").distinct()
    return units, targets


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    units, targets = _inputs(spark, sf)
    _, report = solve(units, targets)
    return report.filter("shortfall > 0").select("plan_id", F.col("category").alias("topic_seed"))


def p2_report(spark: SparkSession, sf: str) -> DataFrame:
    units, targets = _inputs(spark, sf)
    return solve(units, targets)[1]


def p2_sample(spark: SparkSession, sf: str) -> DataFrame:
    units, targets = _inputs(spark, sf)
    units = cut(units)
    quotas, _ = solve(units, targets)
    return draw(units, quotas).select("plan_id", F.col("category").alias("topic_seed"), F.col("id").alias("doc_id"))
