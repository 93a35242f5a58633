"""Compression of vectors to one byte a part, by integer codebooks.

Components become integers, ``floor(1024 * x)``, and vectors are cut into ``PARTS`` consecutive parts. Each part position
has a codebook of up to ``ENTRIES`` entries, which begins as that part of the vectors with the smallest ids. In each round
every part goes to the nearest entry of its codebook, and entries become the mean of their parts, rounded down; entries
without parts stay. All arithmetic is exact: results don't depend on how rows are dealt over tasks.

The codebooks are broadcast: their size is ``ENTRIES`` vectors, whatever the table holds. A task takes Arrow batches,
computes all squared distances of a part as |x|^2 - 2xc + |c|^2 with one product of integer matrices, and takes the first
least. It adds up its parts by entry, so that what is shuffled in a round is one row for each task, part, entry and
position; the grouped sums, as many as the codebooks have components, come back to the driver.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do those whose length
isn't the most frequent one (of equally frequent ones the shortest); a length that four doesn't divide is cut as evenly as
can be; rows without ``vec_id`` come after all others; of rows with one id the vector that is less comes first; repeated
rows count as often as they stand there; with fewer than 256 rows the codebooks are that much smaller; an empty table gives
no rows; a component whose square could leave 64 bits ends the job with a message; extra columns, of any name, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, salted_join

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
ROWS_AT_ONCE = 2048  # with 256 entries, 4 MB of distances


def whole_vectors(table: DataFrame, vector: str = "embedding", others: tuple[str, ...] = ()) -> DataFrame:
    """(vec_id, v, others): the integer components of the vectors that take part."""
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    given = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"), *others).where(F.col("x").isNotNull() & finite)
    lengths = given.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    given = given.where(F.size("x") == (lengths["size"] if lengths else 0))
    most = float(1 << 31) / max(1, lengths["size"] if lengths else 1)  # sums of squares of twice this stay below 2^63
    inside = F.forall("x", lambda c: F.abs(c * SCALE) < most)
    checked = F.when(inside, F.transform("x", lambda c: F.floor(c * SCALE).cast("long"))).otherwise(F.raise_error(F.lit(f"a component times {SCALE} isn't below {most:.0f}: its squares could leave 64 bits")))
    return given.select("vec_id", checked.alias("v"), *others)


def cuts(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(i * length // parts, (i + 1) * length // parts) for i in range(parts)]


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """A matrix for each part position: that part of the vectors with the smallest ids."""
    rows = np.array([r["v"] for r in vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()], np.int64)
    return [np.ascontiguousarray(rows[:, a:b]) for a, b in cuts(rows.shape[1] if rows.ndim == 2 else 0, parts)] if len(rows) else []


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each row of ``x`` and its squared distance."""
    apart = (book * book).sum(1) - 2 * (x @ book.T)
    code = apart.argmin(1)
    return code, apart[np.arange(len(x)), code] + (x * x).sum(1)


def _grouped(x: np.ndarray, code: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and sum of the rows of ``x`` for each code."""
    order = np.argsort(code, kind="stable")
    counts = np.bincount(code, minlength=entries)
    used = np.flatnonzero(counts)
    sums = np.zeros((entries, x.shape[1]), np.int64)
    if len(used):
        sums[used] = np.add.reduceat(x[order], (np.cumsum(counts) - counts)[used])
    return counts, sums


def refine(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros_like(b) for b in books]
        for batch in batches:
            for i in range(0, len(batch), ROWS_AT_ONCE):
                rows, at = _matrix(batch["v"].slice(i, ROWS_AT_ONCE)), 0
                for p, book in enumerate(books):
                    x = rows[:, at : at + book.shape[1]]
                    n, s = _grouped(x, nearest(x, book)[0], len(book))
                    counts[p] += n
                    sums[p] += s
                    at += book.shape[1]
        for p in range(len(books)):
            used = np.flatnonzero(counts[p])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[p][used]), pa.array(sums[p][used].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    partial = vectors.select("v").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    merged = partial.select("part", "entry", "n", F.posexplode("sums").alias("place", "s")).groupBy("part", "entry", "place").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).toArrow()
    sent.destroy()
    out = [b.copy() for b in books]
    part, entry, place, s, n = (np.asarray(merged[c].combine_chunks()) for c in ("part", "entry", "place", "s", "n"))
    for p in range(len(books)):
        own = part == p
        out[p][entry[own], place[own]] = s[own] // n[own]  # rounds down, below zero too
    return out


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    books = first_books(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = refine(vectors, books)
    return books


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The columns of ``vectors`` but ``v``, with ``codes`` (a byte for each part) and ``error`` (squared distance over all parts)."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)
    others = [c for c in vectors.columns if c != "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(i, ROWS_AT_ONCE)
                rows, at = _matrix(part["v"]), 0
                codes, error = np.zeros((len(part), len(sent.value)), np.uint8), np.zeros(len(part), np.int64)
                for p, book in enumerate(sent.value):
                    codes[:, p], apart = nearest(rows[:, at : at + book.shape[1]], book)
                    error += apart
                    at += book.shape[1]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in others), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], [*others, "codes", "error"])

    return vectors.mapInArrow(run, vectors.drop("v").schema.add("codes", "binary").add("error", "long"))


def decode(codes: Column, books: list[np.ndarray]) -> Column:
    """The integer vector that a column of codes stands for."""

    def entry(p: int) -> Column:
        book = F.array(*(F.array(*(F.lit(int(c)) for c in row)).cast("array<bigint>") for row in books[p]))
        return F.get(book, F.conv(F.hex(F.substring(codes, p + 1, 1)), 16, 10).cast("int"))

    return F.concat(*(entry(p) for p in range(len(books))))


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal text, by part, entry and place."""
    return hashlib.sha256(",".join(str(c) for b in books for c in b.reshape(-1).tolist()).encode()).hexdigest()


def compress(table: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each vector that takes part.

    ``code`` has two hexadecimal digits a part; ``label_error`` sums ``error`` over the rows of equal ``label``, nulls together.
    """
    vectors = keep(whole_vectors(table, others=("label",)), "vectors")
    books = fit(vectors)
    # null labels are a key of their own
    keyed = encode(vectors, books).select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", F.coalesce(F.col("label").cast("string"), F.lit("")).alias("label"), F.col("label").isNull().alias("none"))
    coded = keep(keyed, "codes")
    sums = coded.groupBy("label", "none").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows"))
    joined = salted_join(coded, sums, ["label", "none"], "rows", ["vec_id", "code"], coded.count())
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
