"""Approximate nearest neighbours by additive quantisation.

A unit vector is written as a sum of one codeword from each of ``BOOKS`` codebooks over all dimensions. The codebooks
begin as k-means of residuals and are then refitted together by least squares, on a sample of at most ``MOST_SAMPLE``
vectors. Codes come from a beam search over the books. A vector is stored as one byte for each book and the norm of
its approximation. A query makes a table of its products with all codewords; the score of a stored vector is a sum of
table entries over its norm, an estimate of the cosine. The best ``SHORTLIST`` of each query are ranked again by
their exact cosine, and with them all whose score is within ``TIE`` of the last, which rounding alone tells apart: among
more near copies than that the shortlist grows. The class of the query itself is always ranked.

How far estimates mislead depends on the rows: in dense clusters many vectors lie nearer to each other than codes can tell.
So the shortlist's length is measured: up to ``PROBES`` queries are compared with all vectors, and the list is made so
long that it holds ``FOUND`` of their truly nearest; ``SHORTLIST`` is the least.

Queries are taken in blocks of about ``BLOCK`` vectors, each of which goes to the tasks, runs against all codes and is
released before the next. The scan of all codes for each query is the method's cost: a byte and an addition for a book.
Equal vectors are one class: only its first is encoded, and only as many copies as can be returned are looked at, those
with the smallest ids.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do those whose
length isn't the most frequent one, nor rows without an id; of equal scores the smaller id comes first; a repeated id
is one vector, its first in the order of the components; fewer candidates than asked for give fewer rows; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import forget, keep

BOOKS = 24
WORDS = 64
BEAM = 6
MOST_SAMPLE = 16_384
SHORTLIST = 256  # at least, and all that ties with its last
PROBES = 512  # queries that the list's length is measured on
FOUND = 0.99  # of their nearest must be in the list
HELD = 1 << 20  # scores that a task holds for a block of queries
TIE = 4e-6  # sums of BOOKS float32 products differ by less than this for the same cosine
BLOCK = 4096
CODES_PER_TASK = 1 << 15


def _flat(column: pa.Array, dtype) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=dtype).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the rows of ``x`` by beam search, and the squared norms of what they stand for."""
    n, m = len(x), len(books)
    squares = (books**2).sum(2)
    residual = x[:, None, :].astype(np.float32)
    codes = np.zeros((n, 1, m), np.uint8)
    rows = np.arange(n)[:, None]
    for j in range(m):
        width = residual.shape[1]
        # the error that each beam has after each codeword, up to what the codeword doesn't change
        own = np.einsum("nbd,nbd->nb", residual, residual)
        gain = own[:, :, None] + squares[j] - 2 * (residual.reshape(n * width, -1) @ books[j].T).reshape(n, width, -1)
        gain = gain.reshape(n, -1)
        take = min(beam, gain.shape[1])
        best = np.argpartition(gain, take - 1, axis=1)[:, :take]
        order = np.lexsort((best, gain[rows, best]))
        best = best[rows, order]
        parent, word = best // squares.shape[1], best % squares.shape[1]
        residual = residual[rows, parent] - books[j][word]
        codes = codes[rows, parent]
        codes[:, :, j] = word
    made = x - residual[:, 0]
    return codes[:, 0], np.einsum("nd,nd->n", made, made)


def fit_books(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 2, seed: int = 11) -> np.ndarray:
    """Codebooks of shape (books, words, dimensions): residual k-means, then least squares over all books at once."""
    rng = np.random.default_rng(seed)
    n, d = sample.shape
    words = max(1, min(words, n))
    out = np.zeros((books, words, d), np.float32)
    residual = sample.astype(np.float32)
    for j in range(books):
        centres = residual[rng.choice(n, words, replace=False)].copy()
        for _ in range(6):
            near = np.argmin((centres**2).sum(1) - 2 * residual @ centres.T, axis=1)
            counts = np.bincount(near, minlength=words)
            sums = np.zeros((words, d), np.float64)
            np.add.at(sums, near, residual)
            used = counts > 0
            centres[used] = sums[used] / counts[used, None]
            centres[~used] = residual[rng.choice(n, int((~used).sum()))]
        near = np.argmin((centres**2).sum(1) - 2 * residual @ centres.T, axis=1)
        out[j], residual = centres, residual - centres[near]
    for _ in range(rounds):
        codes, _ = encode(sample, out)
        at = codes.astype(np.int64) + words * np.arange(books)
        normal = np.zeros((books * words, books * words), np.float32)
        for i in range(books):
            for j in range(books):
                pairs = np.bincount(codes[:, i].astype(np.int64) * words + codes[:, j], minlength=words * words)
                normal[i * words : (i + 1) * words, j * words : (j + 1) * words] = pairs.reshape(words, words)
        target = np.zeros((books * words, d), np.float32)
        for i in range(books):
            np.add.at(target, at[:, i], sample.astype(np.float32))
        # a small pull towards the present codewords keeps the system regular
        pull = np.float32(0.05 * max(1, n // words))
        normal[np.diag_indices_from(normal)] += pull
        out = np.linalg.solve(normal, target + pull * out.reshape(-1, d)).reshape(books, words, d).astype(np.float32)
    return out


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, one for each id, as doubles."""
    kept = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    kept = kept.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    sizes = kept.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    kept = kept.where(F.size("v") == (sizes["size"] if sizes else 0))
    return kept.groupBy("vec_id").agg(F.min("v").alias("v"))


def _keyed(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("key", F.concat_ws("-", F.xxhash64("v"), F.hash("v")))


def _classes(vectors: DataFrame, copies: int) -> DataFrame:
    """(key, vec_id, v, place): the first ``copies`` ids of each class of equal vectors."""
    order = Window.partitionBy("key").orderBy("vec_id")
    return _keyed(vectors).withColumn("place", F.row_number().over(order)).where(F.col("place") <= copies)


def build_index(firsts: DataFrame, books: np.ndarray, beam: int = BEAM) -> DataFrame:
    """(vec_id, codes, norm) of each vector (vec_id, v)."""
    shared = firsts.sparkSession.sparkContext.broadcast(books)  # as large as BOOKS, WORDS and the dimensions say

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.slice(i, 1024)
                codes, norms = encode(_unit(_flat(part["v"], np.float64)).astype(np.float32), shared.value, beam)
                yield pa.RecordBatch.from_arrays([part["vec_id"], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(np.sqrt(np.maximum(norms, 1e-12)).astype(np.float32))], ["vec_id", "codes", "norm"])

    return firsts.select("vec_id", "v").mapInArrow(run, "vec_id long, codes binary, norm float")


def scan(index: DataFrame, queries: list[tuple[int, list[float]]], books: np.ndarray, shortlist: int) -> DataFrame:
    """(query_id, ids, scores): the best codes of each task for each query of a block; written, so that the block can go."""
    ids = np.array([q for q, _ in queries], np.int64)
    unit = _unit(np.array([v for _, v in queries], np.float64)).astype(np.float32)
    shared = index.sparkSession.sparkContext.broadcast((ids, unit, books))  # BLOCK vectors at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, unit, books = shared.value
        tables = np.einsum("qd,mwd->mqw", unit, books, optimize=True).astype(np.float32)
        best = np.full((len(ids), 0), 0, np.float32)
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))  # query, vector, score
        for batch in batches:
            for i in range(0, len(batch), 2048):  # with a full block of queries, some 35 MB of scores
                part = batch.slice(i, 2048)
                codes = np.frombuffer(b"".join(part["codes"].to_pylist()), np.uint8).reshape(len(part), -1)
                scores = np.take(tables[0], codes[:, 0], axis=1)
                for m in range(1, len(books)):
                    scores += np.take(tables[m], codes[:, m], axis=1)
                scores /= np.asarray(part["norm"], np.float32)
                best = np.concatenate([best, scores], 1)
                least = np.full(len(ids), -np.inf, np.float32)
                if best.shape[1] > shortlist:
                    best = -np.partition(-best, shortlist - 1, axis=1)[:, :shortlist]
                    least = best[:, -1] - np.float32(TIE)
                q, v = np.nonzero(scores >= least[:, None])
                still = held[2] >= least[held[0]]
                new = (q, np.asarray(part["vec_id"], np.int64)[v], scores[q, v])
                held = tuple(np.concatenate([x[still], y]) for x, y in zip(held, new, strict=True))
        yield from _lists(ids, *held)

    out = keep(index.mapInArrow(run, "query_id long, ids array<long>, scores array<float>"), "scans")
    shared.destroy()
    return out


def nearest(firsts: DataFrame, probes: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """(query_id, vec_id): the ``k`` vectors of the largest cosine for each probe, itself left out, by comparing it with all."""
    ids, unit = np.array([q for q, _ in probes], np.int64), _unit(np.array([v for _, v in probes], np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, names = np.zeros((len(ids), 0)), np.zeros((len(ids), 0), np.int64)
        for batch in batches:
            for i in range(0, len(batch), 2048):
                part = batch.slice(i, 2048)
                own = np.asarray(part["vec_id"], np.int64)
                scores = unit @ _unit(_flat(part["v"], np.float64)).T
                scores[ids[:, None] == own] = -np.inf
                best, names = np.concatenate([best, scores], 1), np.concatenate([names, np.broadcast_to(own, scores.shape)], 1)
                if best.shape[1] > k:
                    at = np.argpartition(-best, k - 1, axis=1)[:, :k]
                    best, names = np.take_along_axis(best, at, 1), np.take_along_axis(names, at, 1)
        if best.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, best.shape[1])), pa.array(names.ravel()), pa.array(best.ravel())], ["query_id", "vec_id", "score"])

    found = firsts.select("vec_id", "v").mapInArrow(run, "query_id long, vec_id long, score double").where(F.col("score") > -2)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("query_id", "vec_id")


def _estimates(unit: np.ndarray, codes: np.ndarray, norms: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The scores of all codes for all queries."""
    tables = np.einsum("qd,mwd->mqw", unit, books, optimize=True).astype(np.float32)
    scores = np.take(tables[0], codes[:, 0], axis=1)
    for m in range(1, len(books)):
        scores += np.take(tables[m], codes[:, m], axis=1)
    return scores / norms


def measured_shortlist(index: DataFrame, firsts: DataFrame, probes: list[tuple[int, list[float]]], books: np.ndarray, k: int, share: float = FOUND) -> int:
    """How long the list must be so that it holds ``share`` of the probes' truly nearest vectors."""
    true = nearest(firsts, probes, k)
    rows = index.join(F.broadcast(true), "vec_id").select("query_id", "codes", "norm").collect()  # k rows for each probe
    if not rows:
        return 0
    place = {q: i for i, (q, _) in enumerate(probes)}
    unit = _unit(np.array([v for _, v in probes], np.float64)).astype(np.float32)
    least = [_estimates(unit[place[r["query_id"]], None], np.frombuffer(r["codes"], np.uint8)[None], np.float32(r["norm"]), books)[0, 0] for r in rows]
    asked = np.array([place[r["query_id"]] for r in rows])
    least = np.array(least, np.float32) - np.float32(TIE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = np.zeros(len(asked), np.int64)
        for batch in batches:
            for i in range(0, len(batch), 2048):
                part = batch.slice(i, 2048)
                codes = np.frombuffer(b"".join(part["codes"].to_pylist()), np.uint8).reshape(len(part), -1)
                scores = np.sort(_estimates(unit, codes, np.asarray(part["norm"], np.float32), books), axis=1)
                before += [len(part) - np.searchsorted(scores[q], x, "left") for q, x in zip(asked, least, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(asked))), pa.array(before)], ["pair", "before"])

    counts = index.mapInArrow(run, "pair long, before long").groupBy("pair").agg(F.sum("before").alias("n")).toPandas()["n"].sort_values().to_numpy()
    return int(counts[min(len(counts) - 1, int(np.ceil(share * len(counts))) - 1)])


def _lists(ids: np.ndarray, q: np.ndarray, names: np.ndarray, scores: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(q, kind="stable")
    bounds = np.searchsorted(q[order], np.arange(len(ids) + 1))
    for i in range(0, len(ids) if len(q) else 0, 64):
        own = bounds[i : i + 65]
        at, some = pa.array((own - own[0]).astype(np.int32)), order[own[0] : own[-1]]
        lists = [pa.ListArray.from_arrays(at, pa.array(x[some])) for x in (names, scores)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[i : i + 64]), *lists], ["query_id", "ids", "scores"])


def shortlists(scanned: DataFrame, shortlist: int) -> DataFrame:
    """(query_id, vec_id): the best of all tasks for each query, and what ties with the last of them."""
    pairs = scanned.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query_id", "x.ids", "x.scores")
    own = Window.partitionBy("query_id")
    placed = pairs.withColumn("place", F.row_number().over(own.orderBy(F.desc("scores"), "ids")))
    least = F.max(F.when(F.col("place") == shortlist, F.col("scores"))).over(own) - F.lit(TIE)
    return placed.withColumn("least", least).where((F.col("place") <= shortlist) | (F.col("scores") >= F.col("least"))).select("query_id", F.col("ids").alias("vec_id"))


def cosines(pairs: DataFrame) -> DataFrame:
    """(query_id, vec_id, key, score) of (query_id, q, vec_id, v, key), in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            q, v = _flat(batch["q"], np.float64), _flat(batch["v"], np.float64)
            # scaled by a power of two, which rounds nothing, so that no square overflows or vanishes
            q, v = (np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) for x in (q, v))
            score = (q * v).sum(1) / np.sqrt((q * q).sum(1) * (v * v).sum(1))
            yield pa.RecordBatch.from_arrays([batch["query_id"], batch["vec_id"], batch["key"], pa.array(score)], ["query_id", "vec_id", "key", "score"])

    return pairs.select("query_id", "vec_id", "key", "q", "v").mapInArrow(run, "query_id long, vec_id long, key string, score double")


def search(table: DataFrame, every: int = 50, k: int = 5, shortlist: int = SHORTLIST, share: float = FOUND) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each vector whose id is divisible by ``every``.

    The list of each query is ``shortlist`` long at least, and as long as ``share`` of the nearest asks for; a share of 0 measures nothing.
    """
    spark = table.sparkSession
    vectors = keep(valid_vectors(table), "vectors")
    held = keep(_classes(vectors, k + 1), "vector-classes")
    firsts = held.where("place = 1")
    sample = firsts.orderBy(F.xxhash64("vec_id"), "vec_id").limit(MOST_SAMPLE).select("v").toArrow()["v"].combine_chunks()
    out = "query_id long, rank int, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], out)
    books = fit_books(_unit(_flat(sample, np.float64)))
    index = keep(build_index(firsts, books), "codes")
    tasks = max(1, -(-index.count() // CODES_PER_TASK))
    # written as it is dealt: blocks of queries read it again and again, and nothing is shuffled for them
    dealt = keep(index.repartition(max(tasks, spark.sparkContext.defaultParallelism)), "dealt-codes")
    forget(index)
    asked = vectors.where(F.pmod("vec_id", F.lit(every)) == 0)
    if share:
        probes = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBES).collect()
        if probes:
            shortlist = max(shortlist, measured_shortlist(dealt, firsts, [(r["vec_id"], r["v"]) for r in probes], books, k, share))
    blocks = -(-asked.count() // max(64, min(BLOCK, HELD // shortlist)))
    scanned = None
    for block in range(blocks):
        # one block of queries is on the driver at a time
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect()
        if rows:
            part = scan(dealt, [(r["vec_id"], r["v"]) for r in rows], books, shortlist)
            scanned = part if scanned is None else scanned.unionByName(part)
    if scanned is None:
        return spark.createDataFrame([], out)
    pairs = shortlists(scanned, shortlist)
    # the class that holds the query itself is always looked at, for the query's copies
    own = _keyed(asked).select("key", F.col("vec_id").alias("query_id")).join(firsts.select("key", "vec_id"), "key").select("query_id", "vec_id")
    pairs = pairs.unionByName(own).distinct()
    full = pairs.join(firsts.select("vec_id", "v", "key"), "vec_id").join(asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query_id")
    scored = cosines(full)
    copies = held.select("key", F.col("vec_id").alias("copy"))
    everyone = scored.join(copies, "key").where("copy <> query_id").select("query_id", F.col("copy").alias("vec_id"), "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return everyone.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
