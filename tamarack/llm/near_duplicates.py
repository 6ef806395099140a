"""Near-duplicate records by circulant MinHash (problem 5).

Two permutations give every signature coordinate: the first scatters a record's word shingles over
a circle, the second, shifted by k places, gives coordinate k. Coordinates are banded; records that
share a band are candidates, sketches of further coordinates drop the unlikely ones, and the rest is
verified by the exact Jaccard similarity of the shingle sets. Records with the same words in the
same order form one class from the start, so copies never meet each other in a bucket.

Chance candidates grow with the square of the records, so they must never be written: a band entry
carries its record's sketch, and a candidate is dropped where it is met. Entries travel as packed
arrays, a few bands at a time, and the files of a step are deleted before the next.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache, reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.operators.components import hash_to_min
from tamarack.plans.lineage import cut, cut_clean, forget
from tamarack.plans.skew import split_join
from tamarack.sources.tables import text_table

#: Places on the circle; collisions of a record's shingles are about its size squared over this.
CIRCLE = 1 << 20
#: Coordinates whose lowest bits make the sketch; they start at this shift and take no part in bands.
SKETCH_BITS, SKETCH_SHIFT = 256, 4096
SKETCH_WORDS = SKETCH_BITS // 64
#: Standard deviations by which a pair at the threshold may fall short of its expected sketch agreement.
SKETCH_SLACK = 3.6
#: A pair at the threshold is missed by all bands with at most this probability.
MISS_AT_THRESHOLD = 0.02
#: Coordinates of a band. More of them make fewer chance candidates and more bands.
ROWS = 4
#: Bytes of a band entry: the key's remainder, the record's number and its sketch.
ENTRY_BYTES = 8 + SKETCH_BITS // 8
#: At most so many bands are on disk at a time, at ENTRY_BYTES a band and record.
BANDS_AT_ONCE = 16
#: Shingles whose coordinates are looked up at a time, so that a long text needs no more memory than a short one.
SHINGLES_AT_ONCE = 1 << 16
#: Parts of band entries are at least so many, so that small inputs keep all cores busy.
MOST_CORES = 256
#: Bytes of band entries that make one part, which one task holds and sorts at a time.
PART_BYTES = 32 << 20
#: Runs of one band key longer than this are cut into blocks of as many, and the pairs of blocks dealt out to all tasks.
LONG_RUN = 4000
#: Entries that are held at once against all others of their run; shorter runs are compared together, by distance.
STRIP = 64

_LOW = np.uint64(0xFFFFFFFF)
_ODD = re.compile(r"[^\x00-\x7f\w]")
_ALNUM = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def bands_for(rows: int, threshold: float) -> int:
    """Bands of ``rows`` coordinates that miss a pair at the threshold with at most MISS_AT_THRESHOLD."""
    hit = threshold**rows
    return max(1, int(np.ceil(np.log(MISS_AT_THRESHOLD) / np.log1p(-hit)))) if hit < 1 else 1


@cache
def _circle(width: int, shift: int) -> np.ndarray:
    """Row i holds coordinates shift .. shift + width - 1 of place i."""
    order = np.random.default_rng(20_240_501).permutation(CIRCLE).astype(np.uint32)
    turned = np.roll(order, -shift)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([turned, turned[:width]]), width)


def _split(text: str) -> list[bytes]:
    """Maximal runs of letters and digits, lower-cased, in UTF-8: all else becomes blanks, first outside ASCII, then inside."""
    low = text.lower()
    return (low if low.isascii() else _ODD.sub(" ", low)).encode("utf-8", "surrogatepass").translate(_ALNUM).split()


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 2_000_000:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


@cache
def _words(_: str) -> _Words:
    return _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _prepared(texts: list[str | None], size: int) -> list[tuple[bytes, np.ndarray] | None]:
    """The class and the 64-bit shingle hashes, in order, of each text; None for texts with fewer than ``size`` words."""
    known = _words("")
    counts, flat = [], []
    for t in texts:
        found = _split(t) if t else []
        counts.append(len(found))
        flat.extend(map(known.__getitem__, found))
    h = np.array(flat, dtype=np.uint64)
    if len(h) < size:
        return [None] * len(texts)
    with np.errstate(over="ignore"):
        mixed = np.zeros(len(h) - size + 1, dtype=np.uint64)
        for k in range(size):
            mixed = _mixed(mixed + h[k : len(h) - size + 1 + k])
    out, at = [], 0
    for n in counts:
        out.append((hashlib.blake2b(h[at : at + n].tobytes(), digest_size=16).digest(), mixed[at : at + n - size + 1]) if n >= size else None)
        at += n
    return out


def _signatures(sets: list[np.ndarray], width: int, shift: int) -> np.ndarray:
    """The coordinates of sets of shingles, given by the upper 32 bits of their hashes."""
    circle = _circle(width, shift)
    out = np.empty((len(sets), width), dtype=np.uint32)
    for k, s in enumerate(sets):
        places = (s >> np.uint32(12)).astype(np.intp)
        circle[places[:SHINGLES_AT_ONCE]].min(axis=0, out=out[k])
        for at in range(SHINGLES_AT_ONCE, len(places), SHINGLES_AT_ONCE):
            np.minimum(out[k], circle[places[at : at + SHINGLES_AT_ONCE]].min(axis=0), out=out[k])
    return out


def _distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values of a non-empty array, in order; faster than np.unique on short ones."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]]


def _number(c: bytes, bits: int = 32) -> int:
    return int.from_bytes(c[:4], "little") >> (32 - bits)


def _describe(size: int, bits: int):
    """id, class, number (32 bits of the class), sketch and set (upper 32 bits of the distinct shingles) of each record that has shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(key, *p) for key, p in zip(batch.column(0).to_pylist(), _prepared(batch.column(1).to_pylist(), size), strict=True) if p]
            sets = [_distinct((m[2] >> np.uint64(32)).astype(np.uint32)) for m in made]
            sketches = np.packbits(_signatures(sets, SKETCH_BITS, SKETCH_SHIFT) & 1, axis=1)
            numbers = [_number(m[1], bits) for m in made]
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.binary()), pa.array(numbers, pa.int64()), pa.array([k.tobytes() for k in sketches], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], ["id", "class", "num", "sketch", "set"])

    return run


def _band_chunks(rows: int, first: int, bands: int, parts: int):
    """Entries of some bands by part: arrays of 32-bit key remainders with record numbers, and sketches; a class counts once in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = _mixed(np.arange(first + 1, first + bands + 1, dtype=np.uint64))
        for batch in batches:
            once = {c: k for k, c in enumerate(batch.column(0).to_pylist())}
            if not once:
                continue
            batch = batch.take(pa.array(list(once.values()), pa.int64()))
            numbers = np.array(batch.column(1).to_pylist(), dtype=np.uint64)
            sketches = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(-1, SKETCH_WORDS)
            sets = [np.frombuffer(x, np.uint32) for x in batch.column(3).to_pylist()]
            sig = _signatures(sets, rows * bands, rows * first).reshape(len(sets), bands, rows).astype(np.uint64)
            with np.errstate(over="ignore"):
                key = np.broadcast_to(salt, (len(sets), bands)).copy()
                for k in range(rows):
                    key = _mixed(key + sig[:, :, k])
            key = key.ravel()
            part = ((key >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
            entry = np.column_stack([(key << np.uint64(32)) | np.repeat(numbers, bands), np.repeat(sketches, bands, axis=0)])
            order = np.argsort(part, kind="stable")
            part, entry = part[order], entry[order]
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            blocks = [entry[a:b].tobytes() for a, b in pairwise([*starts.tolist(), len(entry)])]
            yield pa.RecordBatch.from_arrays([pa.array(part[starts]), pa.array(blocks, pa.binary())], ["part", "entries"])

    return run


def _entries(block: bytes) -> np.ndarray:
    return np.frombuffer(block, np.uint64).reshape(-1, 1 + SKETCH_WORDS)


def _alike(a: np.ndarray, b: np.ndarray, most_apart: int) -> np.ndarray:
    """Pairs of entries of different numbers whose sketches differ in at most ``most_apart`` bits, smaller number first; fields are the first axis."""
    apart = np.bitwise_count(a[1] ^ b[1]).astype(np.uint16)
    for k in range(2, 1 + SKETCH_WORDS):
        apart += np.bitwise_count(a[k] ^ b[k])
    ok = np.nonzero(apart <= most_apart)
    x, y = (np.broadcast_to(e[0] & _LOW, apart.shape)[ok] for e in (a, b))
    return ((np.minimum(x, y) << np.uint64(32)) | np.maximum(x, y))[x != y]


def _block_alike(a: np.ndarray, b: np.ndarray, most_apart: int) -> np.ndarray:
    """Such pairs of each entry of ``a`` with each of ``b``; if they are one and the same, each two are compared once or a few times."""
    same, out = a is b, [np.zeros(0, np.uint64)]
    for k in range(0, a.shape[1], STRIP):
        out.append(_alike(a[:, k : k + STRIP, None], b[:, None, k * same :], most_apart))
    return np.unique(np.concatenate(out))


def _pairs_in(e: np.ndarray, long_run: int, most_apart: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(likely pairs as first << 32 | second, long runs) of one part's entries."""
    order = np.argsort(e[:, 0])
    key = e[order, 0] >> np.uint64(32)
    same = key[1:] == key[:-1]
    e = e[order[np.r_[same, False] | np.r_[False, same]]]
    # a class that several batches brought stands here several times
    again = np.flatnonzero(e[1:, 0] == e[:-1, 0])
    e = np.delete(e, again[(e[again + 1] == e[again]).all(axis=1)], axis=0)
    key = e[:, 0] >> np.uint64(32)
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True]) if len(e) else np.zeros(1, np.int64)
    length = np.diff(edge)
    fields = np.ascontiguousarray(e.T)
    after = np.repeat(edge[1:], length) - np.arange(1, len(e) + 1)
    after[np.repeat(length > min(STRIP, long_run), length)] = 0
    out, at, d = [np.zeros(0, np.uint64)], np.flatnonzero(after), 1
    while len(at):
        out.append(_alike(fields[:, at], fields[:, at + d], most_apart))
        d += 1
        at = at[after[at] >= d]
    for k in np.flatnonzero((length > STRIP) & (length <= long_run)):
        run = fields[:, edge[k] : edge[k + 1]]
        out.append(_block_alike(run, run, most_apart))
    return np.unique(np.concatenate(out)), [e[edge[k] : edge[k + 1]] for k in np.flatnonzero(length > long_run)]


def _bucket_pairs(long_run: int, most_apart: int):
    """Likely pairs of the parts of one task, packed; rows come sorted by part. Long runs come out as blocks of entries."""

    def emit(part: int, held: list[bytes]) -> pa.RecordBatch:
        pairs, runs = _pairs_in(_entries(b"".join(held)), long_run, most_apart)
        rows = [(pairs.tobytes(), None, None, None, None)] if len(pairs) else []
        for run in runs:
            cut_at = range(0, len(run), long_run)
            key = int(part) << 32 | int(run[0, 0] >> np.uint64(32))
            rows += [(None, key, k, len(cut_at), run[a : a + long_run].tobytes()) for k, a in enumerate(cut_at)]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["pairs", "key", "block", "blocks", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for part, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != current and held:
                    yield emit(current, held)
                    held = []
                current = part
                held.append(entries)
        if held:
            yield emit(current, held)

    return run


def _block_pairs(most_apart: int):
    """Likely pairs, packed, between two blocks of a long run; a block beside itself has its own pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                a = np.ascontiguousarray(_entries(x.as_py()).T)
                b = a if x == y else np.ascontiguousarray(_entries(y.as_py()).T)
                yield pa.RecordBatch.from_arrays([pa.array([_block_alike(a, b, most_apart).tobytes()], pa.binary())], ["pairs"])

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array((pairs >> np.uint64(32)).astype(np.int64)), pa.array((pairs & _LOW).astype(np.int64))], ["a", "b"])


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                both = np.sort(np.concatenate([a, b]))
                common = int((both[1:] == both[:-1]).sum())
                sims.append(common / (len(a) + len(b) - common))
            sim = np.array(sims, dtype=np.float64)
            keep = pa.array(sim >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(sim[sim >= threshold])], ["class_a", "class_b", "similarity"])

    return run


def similar_classes(records: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, shingle: int = 5, rows: int = ROWS, long_run: int = LONG_RUN, number_bits: int = 32) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has (class, id) of each record with at least ``shingle`` words, links the class pairs at or above the threshold.

    Equal word sequences make one class. Null, empty and shorter texts have no class. Repeated rows
    count once; other columns are ignored; an empty table gives empty results. Every pair of classes
    at the threshold is found with probability 1 - MISS_AT_THRESHOLD, of higher similarity with more;
    the reported similarity counts shingles by 32 bits of their hashes, which for sets of n and m
    shingles is off by one with probability n * m / 2**32. Shape and rules are the same at every size.
    """
    source = records.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null and text is not null")
    info = cut(source.mapInArrow(_describe(shingle, number_bits), "id string, class binary, num long, sketch binary, set binary"))
    named = cut_clean(info.select("class", "num", "id").distinct())
    bands = bands_for(rows, threshold)
    passes = -(-bands // BANDS_AT_ONCE)
    firsts = [bands * k // passes for k in range(passes + 1)]
    parts = max(MOST_CORES, -(-named.count() * -(-bands // passes) * ENTRY_BYTES // PART_BYTES))
    expected = SKETCH_BITS * (1 + threshold) / 2
    most_apart = SKETCH_BITS - int(expected - SKETCH_SLACK * (expected * (1 - threshold) / 2) ** 0.5)
    found = []
    for first, end in pairwise(firsts):
        chunks = info.select("class", "num", "sketch", "set").mapInArrow(_band_chunks(rows, first, end - first, parts), "part int, entries binary")
        met = chunks.repartition("part").sortWithinPartitions("part").mapInArrow(_bucket_pairs(long_run, most_apart), "pairs binary, key long, block int, blocks int, entries binary")
        found.append(cut_clean(met))
    likely_in = reduce(DataFrame.unionByName, found)
    direct = likely_in.filter("pairs is not null").select("pairs")
    # every block of a long run is held against itself and each later one, each two of them wherever there is room
    hot = likely_in.filter("entries is not null")
    left = hot.select("key", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), F.col("entries").alias("x"))
    right = hot.select("key", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"), F.col("entries").alias("y"))
    in_runs = left.join(right, ["key", "i", "j"]).select("x", "y").mapInArrow(_block_pairs(most_apart), "pairs binary")
    alike = direct.unionByName(in_runs).mapInArrow(_unpacked, "a long, b long")
    # classes that share a number look like one in a bucket, so they are all compared
    shared = named.select("num", "class").distinct().groupBy("num").count().filter("count > 1").select(F.col("num").alias("a"), F.col("num").alias("b"))
    likely = cut_clean(alike.unionByName(shared).distinct())
    for past in found:
        forget(past)
    # one set of each class that is in a likely pair
    wanted = likely.select(F.explode(F.array("a", "b")).alias("num")).distinct()
    sets = cut_clean(info.select("num", "class", "set").join(wanted, "num", "left_semi").groupBy("num", "class").agg(F.first("set").alias("set")))
    forget(info)
    one = likely.join(sets.select(F.col("num").alias("a"), F.col("class").alias("class_a"), F.col("set").alias("set_a")), "a")
    both = one.join(sets.select(F.col("num").alias("b"), F.col("class").alias("class_b"), F.col("set").alias("set_b")), "b")
    both = both.filter((F.col("a") < F.col("b")) | (F.col("class_a") < F.col("class_b")))
    links = cut_clean(both.select("class_a", "class_b", "set_a", "set_b").mapInArrow(_verify(threshold), "class_a binary, class_b binary, similarity double"))
    for past in (likely, sets):
        forget(past)
    return named.select("class", "id"), links


def _across(left: DataFrame, right: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs of a record of ``left`` and one of ``right`` whose classes are linked in this order; classes of many copies are dealt out."""
    one = split_join(left.toDF("class_a", "a"), links, "class_a", left.count(), F.col("a")).select("a", "class_b")
    return split_join(right.toDF("class_b", "b"), one, "class_b", right.count(), F.col("b")).select("a", "b")


def _within(left: DataFrame, right: DataFrame) -> DataFrame:
    return split_join(left.toDF("class", "a"), right.toDF("class", "b"), "class", left.count(), F.col("a")).select("a", "b")


def similar_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """All record pairs (a < b) of linked classes and within classes.

    Only an id that stands in several classes can bring a pair twice, so only the pairs of such ids are made distinct.
    """
    named = links.select("class_a", "class_b")
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    repeated = members.groupBy("id").count().filter("count > 1")
    several = cut_clean(members.join(repeated, "id", "left_semi").select("class", "id"))
    if several.isEmpty():
        return _across(members, members, named).select(*ordered).unionByName(_within(members, members).filter("a < b"))
    single = members.join(several.select("id").distinct(), "id", "left_anti").select("class", "id")
    once = _across(single, single, named).select(*ordered).unionByName(_within(single, single).filter("a < b"))
    both_ways = named.unionByName(named.select(F.col("class_b").alias("class_a"), F.col("class_a").alias("class_b")))
    again = _across(several, members, both_ways).unionByName(_within(several, members))
    return once.unionByName(again.filter("a <> b").select(*ordered).distinct())


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    members, links = similar_classes(text_table(spark, sf, "corpus_fixture", "doc_id", "card_text"), "doc_id", "card_text", threshold=0.5, shingle=3)
    return similar_pairs(members, links).toDF("doc_a", "doc_b")


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    """One row per record with shingles: its group (smallest id linked directly or indirectly), its class's links and its copies."""
    members, links = similar_classes(text_table(spark, sf, "corpus_fixture", "doc_id", "card_text"), "doc_id", "card_text", threshold=0.5, shingle=3)
    named = links.select(F.hex("class_a").alias("a"), F.hex("class_b").alias("b"))
    comps = hash_to_min(named)
    degree = named.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count("*").alias("n_links"))
    of = members.select(F.hex("class").alias("c"), "id")
    classes = of.groupBy("c").agg(F.min("id").alias("least"), F.count("*").alias("n_copies")).join(comps, F.col("c") == F.col("node"), "left").join(degree, "c", "left").select("c", "least", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "c").alias("component"))
    heads = classes.groupBy("component").agg(F.min("least").alias("group_id"))
    return of.join(classes.join(heads, "component"), "c").select(F.col("id").alias("doc_id"), "group_id", "n_links", "n_copies")
