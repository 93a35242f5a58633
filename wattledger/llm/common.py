"""Helpers shared by the corpus operators: shared scratch tables and columnar encoding caches."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder, and the setting with it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="wattledger-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a table that ``keep`` wrote and that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results have been written.

    It does so once the driver's JVM has collected the plans that name them, which comes late where the driver has little to do.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def as_row(df: DataFrame) -> Column:
    """The whole row as one struct, so that an operator's own columns can't clash with the given ones."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def salted_join(many: DataFrame, one: DataFrame, keys: list[str], rows: str, spread: list[str], total: int, least: int = 1000, share: int = 1000) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has a row for each key, that no single key can bring into one task.

    The column ``rows`` of ``one`` tells how many rows of ``many`` a key has, and ``total`` how many there are. Keys of more
    than a ``share``-th of all, so at most ``share`` keys, are dealt over several tasks by the columns ``spread``; only these
    few are broadcast.
    """
    bound = max(least, total // share)
    salts = F.ceil(F.col(rows) / bound).cast("int")
    hot = F.broadcast(one.where(F.col(rows) > bound).select(*keys, salts.alias("salts")))
    salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.col("salts"))).cast("int")
    copies = F.when(F.col(rows) > bound, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))
    dealt = many.join(hot, keys, "left").withColumn("salt", salt).drop("salts")
    return dealt.join(one.select(*one.columns, F.explode(copies).alias("salt")).drop(rows), [*keys, "salt"]).drop("salt")


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``most_bytes`` of text, one row at least, so that memory stays bounded."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


class SegmentEncoder:
    """Encodes each distinct segment once and assembles whole texts from the cached ids.

    ``encode`` maps one string to its ids. Segments are encoded many at a time, joined by ``mark``, a string whose one
    id tells where a segment ends; those that hold ``mark`` or anything of ``alone`` are encoded by themselves, and so
    are all if ``mark`` has no id of its own; ``joined`` segments are encoded at a time. At ``most`` entries the cache goes
    on with those that were met again after they were learned, if they are half of it at most.
    """

    def __init__(self, encode: Callable[[str], list[int]], mark: str, alone: tuple[str, ...] = (), most: int = 700_000, joined: int = 2000):
        self.encode, self.mark, self.alone, self.most, self.joined = encode, mark, (mark.strip(" "), *alone), most, joined
        found = encode(mark)
        self.mark_id = found[0] if len(found) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.where: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.counts = np.zeros(1 << 14, np.int32)
        self.again = np.zeros(1 << 14, bool)
        self.used = 0

    def _forget(self) -> None:
        """Leave out what was learned and never met again."""
        kept = np.flatnonzero(self.again[: len(self.where)])
        if 2 * len(kept) > self.most:
            self._clear()
            return
        words = list(compress(self.where, self.again.tolist()))
        ids, counts = self._gather(kept)
        self._clear()
        self._add(words, ids, counts)

    def _learn(self, segments: list[str]) -> None:
        odd = [] if self.mark_id is not None else segments
        for i in range(0, 0 if odd else len(segments), self.joined):
            some = segments[i : i + self.joined]
            joined = self.mark.join(some)
            if joined.count(self.alone[0]) >= len(some) or any(x in joined for x in self.alone[1:]):
                odd = odd + [s for s in some if any(x in s for x in self.alone)]
                some = [s for s in some if not any(x in s for x in self.alone)]
                joined = self.mark.join(some)
            if some:
                ids = np.array(self.encode(joined), np.uint32)
                ends = np.flatnonzero(ids == self.mark_id)
                if len(ends) != len(some) - 1:
                    raise ValueError("the mark isn't encoded alone")
                self._add(some, np.delete(ids, ends), np.diff(ends, prepend=-1, append=len(ids)) - 1)
        for s in odd:
            ids = np.array(self.encode(s), np.uint32)
            self._add([s], ids, np.array([len(ids)]))

    def _add(self, segments: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n, total = len(self.where), self.used + len(ids)
        while total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(segments) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        self.flat[self.used : total] = ids
        self.starts[n : n + len(segments)] = self.used + np.cumsum(counts) - counts
        self.counts[n : n + len(segments)] = counts
        self.where.update(zip(segments, range(n, n + len(segments)), strict=True))
        self.used = total

    def __call__(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, one after the other, and how many each segment has."""
        coded = segments.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.where) + len(words) > self.most and self.where:
            self._forget()
        known = len(self.where)
        if missing := [w for w in words if w not in self.where]:
            self._learn(missing)
        slots = np.fromiter(map(self.where.__getitem__, words), np.int64, len(words))
        self.again[slots[slots < known]] = True
        return self._gather(slots[np.asarray(coded.indices, dtype=np.int64)] if len(segments) else np.zeros(0, np.int64))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[at].astype(np.int64)
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        gather = np.repeat(self.starts[at] - (ends - counts), counts)
        gather += np.arange(total)
        return self.flat[gather], counts


def string_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Buffer | None, int]:
    """The UTF-8 bytes of a string array without nulls, the bounds of its texts in them, and the buffer and where they begin in it."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = texts.buffers()[2]
    first, last = int(bounds[0]), int(bounds[-1])
    raw = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return raw, bounds - first, data, first


def cut_at(mark: np.ndarray, bounds: np.ndarray, data: pa.Buffer | None, first: int) -> tuple[pa.Array, np.ndarray]:
    """The texts cut wherever ``mark`` is set, and the bounds of each text among the cuts; no byte is copied."""
    mark[bounds] = True
    ends = np.flatnonzero(mark)
    cuts = pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer((ends + first).astype(np.int32)), data or pa.py_buffer(b"")])
    return cuts, np.searchsorted(ends, bounds)


def with_marks(ids: np.ndarray, bounds: np.ndarray, first: int | None, last: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Put ``first`` before and ``last`` after the ids of each text; ``bounds`` has one more entry than there are texts."""
    n = len(bounds) - 1
    extra = (first is not None) + (last is not None)
    out_bounds = bounds + extra * np.arange(n + 1)
    out = np.empty(len(ids) + extra * n, ids.dtype)
    spread = np.arange(len(ids)) + np.repeat(extra * np.arange(n) + (first is not None), np.diff(bounds))
    out[spread] = ids
    if first is not None:
        out[out_bounds[:-1]] = first
    if last is not None:
        out[out_bounds[1:] - 1] = last
    return out, out_bounds
