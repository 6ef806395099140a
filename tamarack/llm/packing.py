"""Filling fixed-capacity containers with items (problem 8).

Bounded-space online packing. While a partition's texts are sized in tokens, every plan keeps a fixed
number of open windows: an item goes to the window it fits best; when none fits, the fullest window
is emitted and a new one opened. What is open at the end of a partition is merged with the leftovers
of other partitions by the same rule, in rounds that shrink the number of tasks, so no task ever
holds more than a bounded number of windows at once.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm.bpe import DEFAULT_TOKENIZERS, token_counter
from tamarack.plans.lineage import cut
from tamarack.sources.tables import table, text_table

#: Windows a plan keeps open in a partition.
OPEN_WINDOWS = 64
#: Plans that can be packed at once.
MOST_PLANS = 1000
#: Tasks whose leftovers one task of the next round merges.
FAN_IN = 64

PIECES = "plan_id long, doc_id long, piece_no int, first_token long, n_tokens long, window_id string"
WINDOWS = "plan_id long, window_id string, used long, capacity long"


class Windows:
    """Open windows of one plan, by free space; ids are made from a prefix that is unique to task and round."""

    def __init__(self, capacity: int, prefix: str, most: int = OPEN_WINDOWS) -> None:
        self.capacity, self.prefix, self.most, self.made = capacity, prefix, most, 0
        self.free: list[tuple[int, str]] = []

    def fresh(self) -> str:
        self.made += 1
        return f"{self.prefix}-{self.made}"

    def place(self, size: int) -> tuple[str, tuple[str, int] | None]:
        """(window of an item of ``size`` tokens, the window emitted for it as (id, used) if any)."""
        k, gone = bisect_left(self.free, (size, "")), None
        if k < len(self.free):
            room, name = self.free.pop(k)
        else:
            if len(self.free) >= self.most:
                room, name = self.free.pop(0)
                gone = (name, self.capacity - room)
            room, name = self.capacity, self.fresh()
        insort(self.free, (room - size, name))
        return name, gone

    def rest(self) -> list[tuple[str, int]]:
        return [(name, self.capacity - room) for room, name in self.free]


def _pack_partition(plans: list[tuple[int, str, int]], folder: str):
    """Sizes and packs the texts of one partition; kind 0 rows are pieces, kind 1 rows the windows left open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        counters = {name: token_counter(name, folder) for name in {p[1] for p in plans}}
        open_ = {plan: Windows(capacity, f"{plan}-0-{part}") for plan, _, capacity in plans}
        schema = pa.schema([("kind", pa.int32()), ("plan_id", pa.int64()), ("doc_id", pa.int64()), ("piece_no", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int64()), ("window_id", pa.string())])
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sizes = {name: count(text) if text else 0 for name, count in counters.items()}
                for plan, name, capacity in plans:
                    size, first, piece = sizes[name], 0, 0
                    while True:
                        n = min(capacity, size - first)
                        if n == capacity and size > capacity:
                            window = open_[plan].fresh()
                        else:
                            window, _ = open_[plan].place(n)
                        for c, v in zip(cols, (0, plan, doc, piece, first, n, window), strict=True):
                            c.append(v)
                        first, piece = first + n, piece + 1
                        if first >= size:
                            break
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)
        left = [(plan, name, used) for plan, w in open_.items() for name, used in w.rest()]
        if left:
            columns = [[1] * len(left), [x[0] for x in left], [None] * len(left), [None] * len(left), [None] * len(left), [x[2] for x in left], [x[1] for x in left]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return run


def _merge_round(number: int, capacities: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        open_: dict[int, Windows] = {}
        out: list[tuple] = []
        for batch in batches:
            for plan, window, used in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                w = open_.setdefault(plan, Windows(capacities[plan], f"{plan}-{number}-{part}"))
                into, gone = w.place(used)
                out.append((0, plan, window, into, used))
        out += [(1, plan, None, name, used) for plan, w in open_.items() for name, used in w.rest()]
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["kind", "plan_id", "window_id", "into", "used"])

    return run


def pack(docs: DataFrame, plans: list[tuple[int, str, int]], id_col: str = "doc_id", text_col: str = "text", folder: str = DEFAULT_TOKENIZERS) -> DataFrame:
    """Rows (plan_id, doc_id, piece_no, first_token, n_tokens, container_id) for every document and plan.

    ``plans``: (plan_id, tokenizer_name, capacity), capacity > 0. A document longer than the capacity
    is cut into full containers and one last piece that is packed like any item; others stay whole.
    Null and empty texts have size 0 and share a container. Repeated rows are packed once each, other
    columns are ignored, an empty table or no plans give an empty result.
    """
    spark = docs.sparkSession
    if any(c < 1 for _, _, c in plans):
        raise ValueError("a container's capacity must be positive")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    packed = cut(source.mapInArrow(_pack_partition(plans, folder), "kind int, plan_id long, doc_id long, piece_no int, first_token long, n_tokens long, window_id string"))
    pieces = packed.filter("kind = 0").drop("kind")
    left = packed.filter("kind = 1").select("plan_id", "window_id", F.col("n_tokens").alias("used"))
    capacities = {p: c for p, _, c in plans}
    tasks, number, moves = packed.rdd.getNumPartitions(), 0, None
    while True:
        tasks, number = max(1, -(-tasks // FAN_IN)), number + 1
        ordered = left.repartition(tasks, F.xxhash64("window_id")).sortWithinPartitions("plan_id", F.desc("used"), "window_id")
        done = cut(ordered.mapInArrow(_merge_round(number, capacities), "kind int, plan_id long, window_id string, into string, used long"))
        step = done.filter("kind = 0").select("window_id", "into")
        moves = step if moves is None else moves.join(step.select(F.col("window_id").alias("into"), F.col("into").alias("next")), "into", "left").select("window_id", F.coalesce("next", "into").alias("into"))
        if tasks == 1:
            break
        left = done.filter("kind = 1").select("plan_id", F.col("into").alias("window_id"), "used")
    return pieces.join(moves, "window_id", "left").select("plan_id", "doc_id", "piece_no", "first_token", "n_tokens", F.coalesce("into", "window_id").alias("container_id"))


def _plans(spark: SparkSession, sf: str) -> list[tuple[int, str, int]]:
    """The plans, a table of fixed size; more than MOST_PLANS are refused, as every task holds windows of each."""
    rows = table(spark, sf, "pack_plan").dropna().distinct().orderBy("plan_id").limit(MOST_PLANS + 1).collect()
    if len(rows) > MOST_PLANS:
        raise ValueError(f"more than {MOST_PLANS} plans")
    return [(r["plan_id"], r["tokenizer_name"], r["capacity_tokens"]) for r in rows]


def p8_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Every piece of every document with its container, for each plan."""
    return pack(text_table(spark, sf, "documents", "doc_id", "text"), _plans(spark, sf))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    """By plan: documents, pieces, tokens, containers, the least number of containers that could hold the tokens, and the share of space used."""
    plans = spark.createDataFrame([(p, c) for p, _, c in _plans(spark, sf)], "plan_id long, capacity long")
    by_container = p8_packed(spark, sf).groupBy("plan_id", "container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("n"), F.sum((F.col("piece_no") == 0).cast("long")).alias("docs"))
    out = by_container.join(F.broadcast(plans), "plan_id").groupBy("plan_id", "capacity").agg(F.sum("docs").alias("documents"), F.sum("n").alias("pieces"), F.sum("used").alias("tokens"), F.count("*").alias("containers"), F.max("used").alias("fullest"))
    return out.withColumn("least_containers", F.ceil(F.col("tokens") / F.col("capacity"))).withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity")))
