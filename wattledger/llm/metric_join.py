"""Exact n-gram Jaccard join in the metric space of shingle sets, and its components.

Two sets link when 100 * intersection >= percent * union, that is, within r = 1 - percent / 100 of each other under the
Jaccard distance. The join divides the space
by pivots, level by level:

1. Pivots of the first level are single shingles. A set that holds shingle s lies at 1 - 1/n from {s}, and every other
   set at 1, so the nearest pivots of a set are its own shingles, and ties go to the first in one global order, rare
   shingles before frequent ones. Its Voronoi region is that of its first shingle. Sets near a boundary are replicated:
   a set of n shingles goes to the regions of its first n - ceil(percent n / 100) + 1 shingles. Two linked sets always
   meet in a region, because those beyond that window alone are too few to bring them within r. The region of a rare
   shingle holds few sets, ``REGION`` at most, and its pairs are listed at once.
2. Regions of frequent shingles, and all others that hold more sets than that, such as thousands of near copies, are
   joined again with whole documents as pivots. Each region takes the set with most frequent shingles as its pivot, each set goes to the
   pivot that it meets in most regions, and that distance is computed exactly. Sets that are linked by then need no
   comparison with each other for the components; pairs of different components that meet in such a region are listed,
   unless the triangle inequality, by exact distances to a common pivot, rules them out, or their rare shingles do. A
   set with all its rare shingles in its window, as any in the region of a frequent shingle, can have only frequent ones
   in common with a set that it hasn't met elsewhere. Such regions are cut into bands of sizes; sets near the edge of a
   band, within a quarter, are in both.
3. Listed pairs whose sizes and number of meetings leave room for enough common shingles are decided exactly.

Documents as pivots can't come first: most pairs of documents share nothing and lie at distance 1, where the triangle
inequality tells nothing and every window is the whole space.

Rarity is a matter of speed and not of the result; the bound on a region is on the sets in it, whatever the data's size.
Shingles are counted in a table of ``2 ** CELL_BITS`` cells, and one
bit for each cell, 1 MB in all, says which are frequent; only that goes to the tasks. Equal sets are one class from the
start. A class is known by a 64-bit hash of its set and the set's size; the smallest doc_id goes before them in its name,
(doc_id, k, n), so that names are in the order of documents and classes that share a doc_id stay apart.

Defined results: null and empty texts, and texts of white space, have no shingles and link with nothing; rows that
repeat a doc_id each give a row, and share a component only as their texts do; a null doc_id takes no part and gives a
null component. Extra columns are ignored; an empty table gives no rows. Components and classes are given by their
smallest doc_id: if that has several texts, two of them can have the same number, but ``one_of_each`` keeps them apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType
from pyspark.sql.window import Window

from .common import as_row, forget, keep, release, salted_join, text_slices
from .shingles import fingerprint, shingle_sets

PERCENT = 80
CELL_BITS = 23
RANGES = 1024
SLICE = 512 << 10
SALTS = 64
NAME = "struct<doc_id: long, k: long, n: int>"
LEAST_FREQUENT = 64  # so much above its share, at least, a cell holds frequent shingles
BANDS = 4  # sizes that differ by up to so many steps of a quarter share a band
LEAST_STAR = 256  # a class with more neighbours than this and than a thousandth of all is dealt over tasks
MOST_HELD = 1_500_000  # meetings that a task holds before it counts them by pair
REGION = 128  # no more sets than this are compared pair by pair


def window_size(n: np.ndarray, percent: int) -> np.ndarray:
    """In how many regions a set of n shingles is: those after them alone can't be enough of the union."""
    return n - -(-percent * n // 100) + 1


def _given(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _version(text) -> Column:
    """What tells the texts of one doc_id apart."""
    return F.xxhash64(F.col(text).cast("string"))


def _cells(sets: np.ndarray) -> np.ndarray:
    return (sets >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def summarise(docs: DataFrame) -> DataFrame:
    """A row (doc_id, version, k, n) for each document, and rows (range, counts) of how often each cell's shingles occur in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << CELL_BITS, np.uint8)
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                sets, bounds = shingle_sets(part["text"])
                cells, counts = np.unique(_cells(sets), return_counts=True)
                table[cells] = np.minimum(table[cells] + counts, 255)
                n = len(part)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["version"], pa.array(fingerprint(sets, bounds)), pa.array(np.diff(bounds).astype(np.int32)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        rows = table.reshape(RANGES, -1)
        used = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(used), pa.int64()) for _ in range(3)), pa.nulls(len(used), pa.int32()), pa.array(used.astype(np.int32)), pa.array([rows[i].tobytes() for i in used], pa.binary())], names)

    names = ["doc_id", "version", "k", "n", "range", "counts"]
    return _given(docs).withColumn("version", _version("text")).mapInArrow(run, "doc_id long, version long, k long, n int, range int, counts binary")


def frequent_cells(counts: DataFrame, total: int, least: int = LEAST_FREQUENT) -> np.ndarray:
    """A bit for each cell: whether its shingles are frequent. ``total`` is the number of all shingles in all sets.

    A cell is frequent if it holds clearly more than its share; the sums run in the tasks and 1 MB comes back.
    """
    mean = total / (1 << CELL_BITS)
    most = int(mean + max(least, 8 * math.sqrt(mean)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch["range"].to_pylist(), batch["counts"], strict=True):
                row = np.frombuffer(blob.as_buffer(), np.uint8)
                if i in sums:
                    sums[i] += row
                else:
                    sums[i] = row.astype(np.int64)
        ids = sorted(sums)
        bits = [np.packbits(sums[i] > most).tobytes() for i in ids]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(bits, pa.binary())], ["range", "bits"])

    table = np.zeros((RANGES, (1 << CELL_BITS) // RANGES // 8), np.uint8)
    for row in counts.repartition("range").mapInArrow(add, "range int, bits binary").collect():
        table[row["range"]] = np.frombuffer(row["bits"], np.uint8)
    return table.ravel()


def replicate(docs: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """(h, k, n, w, plain, hot): each class in each region of its window.

    ``w`` is how many regions of frequent shingles the class is in, ``plain`` how many shingles of the set are rare, and
    ``hot`` whether h is frequent.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # 1 MB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        passed: set[tuple[int, int]] = set()
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                sets, bounds = shingle_sets(part["text"])
                cells = _cells(sets)
                hot = bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1
                keys, sizes = fingerprint(sets, bounds), np.diff(bounds)
                take = window_size(sizes, percent)
                out: list[tuple] = []
                for i, (key, n, count) in enumerate(zip(keys.tolist(), sizes.tolist(), take.tolist(), strict=True)):
                    if not n or (key, n) in passed:
                        continue
                    if len(passed) < 200_000:  # copies in one task are replicated once
                        passed.add((key, n))
                    own, warm = sets[bounds[i] : bounds[i + 1]], hot[bounds[i] : bounds[i + 1]]
                    order = np.argsort(warm, kind="stable")[:count]
                    out.append((own[order], warm[order], key, n, n - int(warm.sum()), int(warm[order].sum())))
                if not out:
                    continue
                lengths = [len(o[0]) for o in out]
                spread = lambda j, kind: np.repeat(np.array([o[j] for o in out], kind), lengths)
                columns = [np.concatenate([o[0] for o in out]).view(np.int64), spread(2, np.int64), spread(3, np.int32), spread(5, np.int32), spread(4, np.int32), np.concatenate([o[1] for o in out]).astype(bool)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "k", "n", "w", "plain", "hot"])

    return _given(docs).mapInArrow(run, "h long, k long, n int, w int, plain int, hot boolean")


def join_rare(rows: DataFrame, percent: int, region: int = REGION) -> DataFrame:
    """Pairs (k, n, w, k2, n2, w2, c) that meet c times in small regions of rare shingles, and rows of the other regions.

    The latter are (h, k, n, w, plain, hot), with k2 null; ``w`` is how many regions of frequent shingles a set is in. A
    region of at most ``region`` sets is joined in one task; rows of frequent shingles are spread over ``SALTS`` tasks and
    pass, and so do those of larger regions of rare ones.
    """
    schema = "h long, k long, n int, w int, plain int, hot boolean, k2 long, n2 int, w2 int, c int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs = None, _Pairs(percent, region)
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])]).combine_chunks()
            last = table["h"][-1].as_py()
            ends = int(np.searchsorted(np.asarray(table["h"]), last, "left"))  # the last region may go on
            held = table.slice(ends)
            yield from pairs.take(table.slice(0, ends))
        if held is not None:
            yield from pairs.take(held.combine_chunks())
        yield from pairs.flush()

    salt = F.when(F.col("hot"), F.pmod("k", F.lit(SALTS))).otherwise(F.lit(0))
    return rows.repartition("h", salt).sortWithinPartitions("h", "k", "n").mapInArrow(run, schema)


class _Pairs:
    """Meetings of the sets of one task, counted by pair before they leave it."""

    names = ("k", "n", "w", "k2", "n2", "w2")
    kinds = (np.int64, np.int32, np.int32, np.int64, np.int32, np.int32)

    def __init__(self, percent: int, region: int):
        self.percent, self.region, self.held, self.size = percent, region, [], 0

    def take(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(table):
            return
        h, k, n = (np.asarray(table[c]) for c in ("h", "k", "n"))
        hot = np.asarray(table["hot"])
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        fresh = new_h | np.concatenate([[True], (k[1:] != k[:-1]) | (n[1:] != n[:-1])])  # copies of a set count once
        held = np.add.reduceat(fresh.astype(np.int64), np.flatnonzero(new_h))
        warm = fresh & (hot | np.repeat(held > self.region, np.diff(np.flatnonzero(np.append(new_h, True)))))
        if warm.any():
            kept = table.filter(pa.array(warm))
            empty = [pa.nulls(len(kept), t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int32())]
            columns = [*(kept[c].combine_chunks() for c in ("h", "k", "n", "w", "plain", "hot")), *empty]
            yield pa.RecordBatch.from_arrays(columns, ["h", "k", "n", "w", "plain", "hot", "k2", "n2", "w2", "c"])
        cold = fresh & ~warm
        h, k, n, w = h[cold], k[cold], n[cold], np.asarray(table["w"])[cold]
        if not len(h):
            return
        edges = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
        sizes = np.diff(edges)
        for size in np.unique(sizes[sizes > 1]).tolist():
            starts = edges[:-1][sizes == size]
            x, y = np.triu_indices(size, 1)
            block = max(1, MOST_HELD // 4 // len(x))
            for i in range(0, len(starts), block):
                at = starts[i : i + block, None]
                a, b = (at + x).ravel(), (at + y).ravel()
                fits = np.minimum(n[a], n[b]).astype(np.int64) * 100 >= np.maximum(n[a], n[b]).astype(np.int64) * self.percent
                a, b = a[fits], b[fits]
                found = np.zeros(len(a), [*zip(self.names, self.kinds, strict=True), ("c", np.int32)])
                for name, values in zip((*self.names, "c"), (k[a], n[a], w[a], k[b], n[b], w[b], 1), strict=True):
                    found[name] = values
                self.held.append(found)
                self.size += len(found)
                if self.size > MOST_HELD:
                    self._count()
                    if self.size > MOST_HELD // 2:
                        yield from self.flush()

    def _count(self) -> None:
        rows = np.concatenate(self.held)
        order = np.lexsort((rows["n2"], rows["n"], rows["k2"], rows["k"]))
        rows = rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = np.any([rows[c][1:] != rows[c][:-1] for c in ("k", "k2", "n", "n2")], axis=0)
        counts = np.add.reduceat(rows["c"], np.flatnonzero(new)) if len(rows) else rows["c"]
        rows = rows[new]
        rows["c"] = counts
        self.held, self.size = [rows], len(rows)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        self._count()
        rows, self.held, self.size = self.held[0], [], 0
        for i in range(0, len(rows), 100_000):
            part = rows[i : i + 100_000]
            empty = [pa.nulls(len(part), t) for t in (pa.int64(), pa.int32(), pa.bool_())]
            columns = [empty[0], *(pa.array(part[c].copy()) for c in ("k", "n", "w")), *empty[1:], *(pa.array(part[c].copy()) for c in ("k2", "n2", "w2", "c"))]
            yield pa.RecordBatch.from_arrays(columns, ["h", "k", "n", "w", "plain", "hot", "k2", "n2", "w2", "c"])


def _sizes_fit(percent: int):
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def _meet_enough(percent: int, more):
    """Whether a pair with c counted meetings, and at most ``more`` others, can have enough common shingles.

    Common shingles are met in a region, or lie after the window of the set whose window ends first in the order.
    """
    need = F.ceil((F.col("na") + F.col("nb")) * percent / F.lit(100 + percent) - F.lit(1e-9))
    beyond = lambda n: F.ceil(F.col(n) * percent / 100.0 - 1e-9) - 1
    return F.col("c") + more + F.greatest(beyond("na"), beyond("nb")) >= need


def fetch_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, s): the shingle sets, as binary, of the classes whose names are ``wanted``; each from its first document.

    A table of ``2 ** CELL_BITS`` bits, filled in the tasks, keeps most other documents from being shuffled.
    """
    cell = lambda doc_id: F.pmod(F.xxhash64(doc_id), F.lit(1 << CELL_BITS)).cast("int")
    width = (1 << CELL_BITS) // RANGES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.asarray(batch["cell"])
            for i in np.unique(cells // width).tolist():
                row = np.zeros(width, np.uint8)
                row[cells[cells // width == i] % width] = 1
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([np.packbits(row).tobytes()], pa.binary())], ["range", "bits"])

    bits = np.zeros((RANGES, width // 8), np.uint8)
    cells = wanted.select(cell("id.doc_id").alias("cell")).withColumn("r", F.floor(F.col("cell") / width)).distinct().repartition("r").sortWithinPartitions("cell").select("cell")
    for row in cells.mapInArrow(pack, "range int, bits binary").collect():  # 2 MB at most, whatever the data
        bits[row["range"]] |= np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits.ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            cells = np.asarray(batch["cell"])
            hit = table[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1
            few = batch.filter(pa.array(hit.astype(bool)))
            for part in text_slices(few, "text", SLICE):
                sets, bounds = shingle_sets(part["text"])
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([sets[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()), pa.array(fingerprint(sets, bounds))], ["doc_id", "s", "k"])

    given = _given(docs).where("doc_id is not null").withColumn("cell", cell("doc_id"))
    found = given.mapInArrow(run, "doc_id long, s binary, k long")
    # a doc_id can have several texts, and a text can be there more than once under it
    named = wanted.select("id", F.col("id.doc_id").alias("doc_id"), F.col("id.k").alias("k"), F.col("id.n").alias("_n"))
    same = found.join(named, ["doc_id", "k"]).where(F.octet_length("s") == 8 * F.col("_n"))
    return same.select("id", "s").dropDuplicates(["id"])


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, total): intersection and union sizes of the pairs' sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, total = [], []
            for one, two in zip(batch["sa"], batch["sb"], strict=True):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                same = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                common.append(same)
                total.append(len(x) + len(y) - same)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(common, pa.int32()), pa.array(total, pa.int32())], ["a", "b", "common", "total"])

    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, f"a {NAME}, b {NAME}, common int, total int")


def _signature(edges: DataFrame) -> tuple:
    """The number of edges and 128 bits that tell their set."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest name that each linked class reaches, by alternating large and small stars."""
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    told = _signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("rows"))
        large = salted_join(both.where("v > u"), low, ["u"], "rows", ["v"], 2 * told[0], LEAST_STAR).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = keep(large, "stars")
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows"))
        small = salted_join(large, low, ["u"], "rows", ["v"], told[0], LEAST_STAR).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        small = keep(small, "stars")
        forget(large)
        forget(edges)
        edges, before, told = small, told, _signature(small)
        if told == before:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def classes_and_links(docs: DataFrame, percent: int = PERCENT, least: int = LEAST_FREQUENT, region: int = REGION) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(members, classes, links, edges): (doc_id, version, k, n), (k, n, id, copies), links between classes (a, b, common, total), and (a, b).

    ``id`` is the name of a class, (smallest doc_id, k, n). The links join all classes of each component, though not every
    pair; ``edges`` join the same classes and are fewer, where components have been found on the way.
    """
    summary = keep(summarise(docs), "summary")
    members = summary.where("range is null").select("doc_id", "version", "k", "n")
    classes = keep(members.where("n > 0 and doc_id is not null").groupBy("k", "n").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).select("k", "n", F.struct("doc_id", "k", "n").alias("id"), "copies"), "classes")
    total = members.agg(F.sum("n")).first()[0] or 0
    frequent = frequent_cells(summary.where("range is not null").select("range", "counts"), total, least)
    met = keep(join_rare(replicate(docs, frequent, percent), percent, region), "meetings")
    release(docs.sparkSession)
    name = classes.select("k", "n", "id")

    # large regions of rare shingles are left to document pivots, too: ``over`` counts those that a set is in
    dense = met.where("k2 is null")
    over = keep(dense.where("not hot").groupBy("k", "n").agg(F.count("*").cast("int").alias("over")), "large-regions")
    counted = not over.isEmpty()

    # pairs that meet where small regions are: sets can have met as often again in other regions as both are there
    rare = met.where("k2 is not null").groupBy("k", "n", "w", "k2", "n2", "w2").agg(F.sum("c").alias("c")).withColumnsRenamed({"n": "na", "n2": "nb"})
    more = F.least("w", "w2")
    if counted:
        rare = rare.join(over.select("k", F.col("n").alias("na"), F.col("over").alias("o")), ["k", "na"], "left").join(over.select(F.col("k").alias("k2"), F.col("n").alias("nb"), F.col("over").alias("o2")), ["k2", "nb"], "left")
        more = F.least(F.col("w") + F.coalesce("o", F.lit(0)), F.col("w2") + F.coalesce("o2", F.lit(0)))
    rare = rare.where(_meet_enough(percent, more)).select("k", "na", "k2", "nb")
    rare = rare.join(name.select("k", F.col("n").alias("na"), F.col("id").alias("x")), ["k", "na"]).join(name.select(F.col("k").alias("k2"), F.col("n").alias("nb"), F.col("id").alias("y")), ["k2", "nb"])
    rare = rare.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    # elsewhere each set with the document pivot that it meets most
    dense = dense.join(name, ["k", "n"])
    dense = dense.join(over, ["k", "n"], "left").withColumn("over", F.coalesce("over", F.lit(0))) if counted else dense.withColumn("over", F.lit(0))
    # common shingles of sets that haven't met in a small region: frequent ones and those of large regions, if no rare one lies behind the window
    common = F.when(F.col("plain") <= _window("n", percent), F.col("n") - F.col("plain") + F.col("over")).otherwise(F.col("n"))
    dense = keep(dense.select("h", "id", "n", (F.col("w") + F.col("over")).alias("w"), "plain", common.cast("int").alias("f")), "dense")
    pivots = dense.groupBy("h").agg(F.min(F.struct("plain", "id", "n")).alias("p"), F.max("id").alias("most"), F.min("id").alias("least")).where("most <> least").select("h", "p")
    star = dense.join(pivots, "h").where("id <> p.id").select("id", "p", F.col("n").alias("na"), F.col("p.n").alias("nb")).where(_sizes_fit(percent))
    star = star.groupBy("id", F.col("p.id").alias("pivot")).agg(F.count("*").alias("c")).groupBy("id").agg(F.min(F.struct(-F.col("c"), "pivot")).alias("x"))
    star = keep(star.select("id", F.col("x.pivot").alias("pivot")), "nearest")
    first = keep(rare.unionByName(star.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))).distinct(), "pairs")
    forget(met)
    del rare, pivots, met
    release(docs.sparkSession)
    decided = _decide(docs, first)
    within = F.col("common") * 100 >= F.col("total") * percent
    linked = decided.where(within)
    if dense.isEmpty():
        return members, classes, linked, linked.select("a", "b")
    so_far = keep(components(linked), "components")
    later = _between_components(dense, star, decided, so_far, first, percent)
    edges = so_far.select(F.col("component").alias("a"), F.col("id").alias("b"))
    if later.isEmpty():
        return members, classes, linked, edges
    more_links = _decide(docs, later).where(within)
    return members, classes, linked.unionByName(more_links), edges.unionByName(more_links.select("a", "b"))


def _decide(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, common, total) of the pairs, written."""
    wanted = keep(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "wanted")
    sets = keep(fetch_sets(docs, wanted), "sets")
    decided = keep(distances(pairs, sets), "decided")
    forget(sets)
    forget(wanted)
    del sets, wanted
    release(docs.sparkSession)
    return decided


def _window(n: str, percent: int) -> Column:
    """``window_size`` of a column."""
    return F.col(n) - F.ceil(F.col(n) * percent / 100.0 - 1e-9) + 1


def _between_components(dense: DataFrame, star: DataFrame, decided: DataFrame, so_far: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs that meet in regions left to document pivots, aren't connected yet, may link, and aren't among ``first``."""
    distance = decided.select("a", "b", (1 - F.col("common") / F.col("total")).alias("d"))
    away = star.select("id", "pivot", F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).join(distance, ["a", "b"]).select("id", "pivot", "d")
    told = dense.join(so_far, "id", "left").join(away, "id", "left").withColumn("comp", F.coalesce("component", "id"))
    told = keep(told.select("h", "id", "n", "w", "f", "comp", "pivot", "d"), "told")
    forget(dense)
    sizes = told.groupBy("h", "comp").agg(F.count("*").alias("c"))
    largest = keep(sizes.groupBy("h").agg(F.max(F.struct("c", "comp")).alias("x"), F.count("*").alias("comps")).where("comps > 1").select("h", F.col("x.comp").alias("big")), "largest")
    # sizes of linked sets differ by one step at most; a little more is allowed for rounding
    place = F.log("n") / math.log(100 / percent)
    band = lambda step: F.floor((F.col("place") + step) / BANDS)
    mixed = keep(told.join(largest, "h").withColumn("place", place), "mixed")
    forget(told)
    named = lambda side: [F.col(c).alias(f"{c[0]}{side}") for c in ("id", "n", "w", "comp", "f")] + [F.col("pivot").alias(f"p{side}"), F.col("d").alias(f"d{side}")]
    left = mixed.where("comp <> big").select("h", "big", band(0).alias("band"), *named("a"))
    right = mixed.select("h", F.explode(F.sequence(band(-1 - 1e-9), band(1 + 1e-9))).alias("band"), *named("b"))
    apart = ((F.col("pa") == F.col("pb")) & (F.abs(F.col("da") - F.col("db")) > 1 - percent / 100 + 1e-9)) | (F.col("pa") == F.col("ib")) | (F.col("pb") == F.col("ia"))
    once = (F.col("cb") == F.col("big")) | (F.col("ia") < F.col("ib"))
    shared = F.least("fa", "fb") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    pairs = left.join(right, ["h", "band"]).where((F.col("ca") != F.col("cb")) & once & shared & _sizes_fit(percent) & ~F.coalesce(apart, F.lit(False)))
    # which side a set is on changes with the largest component of a region, so a pair is put in one order before it is counted
    turned = F.col("ia") > F.col("ib")
    ordered = [F.when(turned, F.col(f"{c}{y}")).otherwise(F.col(f"{c}{x}")).alias(f"{c}{x}") for c in "inw" for x, y in ("ab", "ba")]
    counted = pairs.select(*ordered).groupBy("ia", "ib", "na", "nb", "wa", "wb").agg(F.count("*").alias("c"))
    # they may have met elsewhere as often as their windows have other regions
    more = F.least(_window("na", percent) - F.col("wa"), _window("nb", percent) - F.col("wb"))
    found = counted.where(_meet_enough(percent, more)).select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    later = keep(found.join(first, ["a", "b"], "left_anti"), "pairs")
    forget(mixed)
    del left, right, pairs, counted, found, mixed, told
    release(later.sparkSession)
    return later


def _with_components(docs: DataFrame, percent: int, least: int, region: int) -> DataFrame:
    """(doc_id, version, k, n, component, id, copies) of each document; the last three are null where there are no shingles."""
    members, classes, _, edges = classes_and_links(docs, percent, least, region)
    named = classes.join(components(edges), "id", "left").select("k", "n", F.coalesce("component", "id").alias("component"), "id", "copies")
    return members.join(named, ["k", "n"], "left")


def join_components(docs: DataFrame, percent: int = PERCENT, least: int = LEAST_FREQUENT, region: int = REGION) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, copies) of each document."""
    out = _with_components(docs, percent, least, region)
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component.doc_id", "doc_id")).alias("component_id"), F.coalesce("id.doc_id", "doc_id").alias("class_id"), F.coalesce("copies", F.lit(1)).alias("copies"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component, the first by doc_id and class; rows without shingles or doc_id all stay."""
    found = _with_components(docs, percent, LEAST_FREQUENT, REGION).where("doc_id is not null and n > 0")
    found = keep(found.groupBy("doc_id", "version", "k", "n", "component").agg(F.count("*").alias("rows")), "members")
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "k", "n", "version")).alias("x")).select("x.doc_id", "x.version")
    key = ["doc_id", "version"]
    given = docs.select(as_row(docs).alias("row")).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), _version("row.text").alias("version"))
    kept = given.join(found.join(first, key, "left_anti").select(*key), key, "left_anti")
    # rows can repeat both the doc_id and the text of the one that stays
    again = keep(found.where("rows > 1").join(first, key, "left_semi").select(*key), "repeated")
    if again.isEmpty():
        return kept.select("row.*")
    flat = [F.col("row").getField(c) for c in docs.columns if not isinstance(docs.schema[c].dataType, (MapType, VariantType))]
    order = Window.partitionBy(*key).orderBy(F.xxhash64(*flat))
    one = given.join(again, key).withColumn("place", F.row_number().over(order)).where("place = 1").select("row.*")
    return kept.join(again, key, "left_anti").select("row.*").unionByName(one)
