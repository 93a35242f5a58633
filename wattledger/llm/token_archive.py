"""Token-id shards with Elias-Fano encoded document boundaries.

A shard is one file: a header, the ascending doc ids and the document boundaries, both as Elias-Fano
sequences with a sampled select structure, and the concatenated ids as 16- or 32-bit little-endian integers.
Documents go to shards by ranges of doc_id, so that shard order and order inside a shard make one global order.
Reading goes through the select structure, a few hundred documents at a time.

Defined results: a null text counts as empty and yields the end id alone; rows that repeat a doc_id are all
kept, ordered by their ids; rows whose doc_id is null come first and read back as null; an empty table gives
no shard and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import io
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SegmentEncoder, cut_at, keep, scratch_path, string_bytes, text_slices, with_marks

MAGIC = b"EFTOKEN1"
HEADER = struct.Struct("<8sBxxxIQQ")  # magic, bytes an id, rows without doc id, documents, ids
SAMPLE = 256  # one select sample for so many set bits
SHARD_BYTES = 16 << 20  # of ids, about
MOST_RANGES = 1 << 16  # of ids, each sorted in one task
TASK_BYTES = 64 << 20  # what a task reads back, about
SLICE_BYTES = 2 << 20  # of text that is encoded at a time, about
PIECES = 350_000  # distinct pieces of text whose ids a Python worker remembers
JOINED = 100  # pieces in one call of the tokenizer, which takes longer than in step for longer texts


class EliasFano:
    """A non-decreasing sequence in n * (2 + log2(universe / n)) bits, and 32 bits more for every ``SAMPLE`` values."""

    HEAD = struct.Struct("<QQBxxxI")  # values, smallest value, low bits, words of the upper part

    def __init__(self, n: int, base: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.base, self.low_bits, self.low, self.high, self.samples = n, base, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        base = int(values[0])
        rest = values.astype(np.uint64) - np.uint64(base % (1 << 64))
        low_bits = max(0, (int(rest[-1]) // n).bit_length() - 1)
        bits = (rest[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        at = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        plain = np.zeros((int(at[-1]) // 64 + 1) * 64, np.uint8)
        plain[at] = 1
        high = np.packbits(plain, bitorder="little").view(np.uint64)
        return cls(n, base, low_bits, low, high, at[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = self.HEAD.pack(self.n, self.base % (1 << 64), self.low_bits, len(self.high))
        return head + struct.pack("<Q", len(self.low)) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, source) -> EliasFano:
        n, base, low_bits, words = cls.HEAD.unpack(source.read(cls.HEAD.size))
        (size,) = struct.unpack("<Q", source.read(8))
        low = np.frombuffer(source.read(size), np.uint8)
        high = np.frombuffer(source.read(8 * words), np.uint64)
        samples = np.frombuffer(source.read(4 * -(-n // SAMPLE)), np.uint32)
        return cls(n, base - (1 << 64) * (base >> 63), low_bits, low, high, samples)

    def select(self, i: int) -> int:
        """The i-th value; it reads the words between two samples at most."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        word, bit = divmod(int(self.samples[i // SAMPLE]), 64)
        left, more = int(self.high[word]) >> bit << bit, i % SAMPLE
        while more >= left.bit_count():
            more -= left.bit_count()
            word += 1
            left = int(self.high[word])
        for _ in range(more):
            left &= left - 1
        at = 64 * word + (left & -left).bit_length() - 1
        first = i * self.low_bits
        raw = int.from_bytes(self.low[first // 8 : (first + self.low_bits) // 8 + 1].tobytes(), "little")
        return self.base + (((at - i) << self.low_bits) | ((raw >> first % 8) & ((1 << self.low_bits) - 1)))

    def select_run(self, first: int, count: int) -> np.ndarray:
        """The values from place ``first`` on, ``count`` at most; only their own words and bits are unpacked."""
        count = min(count, self.n - first)
        if count <= 0:
            return np.zeros(0, np.int64)
        sample, last = first // SAMPLE, (first + count - 1) // SAMPLE + 1
        begin = int(self.samples[sample]) // 64
        end = int(self.samples[last]) // 64 + 1 if last < len(self.samples) else len(self.high)
        at = np.flatnonzero(np.unpackbits(self.high[begin:end].view(np.uint8), bitorder="little")) + 64 * begin
        skip = int(np.searchsorted(at, int(self.samples[sample]))) + first - sample * SAMPLE
        upper = (at[skip : skip + count] - np.arange(first, first + count)).astype(np.uint64)
        bit = first * self.low_bits
        bits = np.unpackbits(self.low[bit // 8 : (bit + count * self.low_bits + 7) // 8], bitorder="little")[bit % 8 :][: count * self.low_bits].reshape(count, self.low_bits)
        lower = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return ((upper << np.uint64(self.low_bits)) + lower + np.uint64(self.base % (1 << 64))).astype(np.int64)

    def find(self, value: int) -> int:
        """The first place with a value of at least ``value``, by halving."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if self.select(middle) < value:
                low = middle + 1
            else:
                high = middle
        return low


_encoders: dict[str, SegmentEncoder] = {}


def _encoder(path: str) -> SegmentEncoder:
    """One for each Python worker and tokenizer file."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _encoders[path] = SegmentEncoder(lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, " \x01 ", tuple(t.content for t in tokenizer.get_added_tokens_decoder().values()), PIECES, JOINED)
    return _encoders[path]


_WHITE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_SIGN = np.array([32 < i < 127 and not chr(i).isalnum() for i in range(256)])


def encode_batch(texts: pa.Array, encoder: SegmentEncoder, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts with the end id after each, and the bounds between texts.

    Texts are cut before ASCII white space, and between an ASCII letter and an ASCII sign after it. The tokenizer
    drops white space before it forms words, none of its words goes on from a letter to a sign, and no added token
    holds white space; so the ids of the cuts are those of the text. All white space counts as a blank to it, so here, too.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    added = np.asarray(pc.match_substring(texts, "<|")).any()
    if not added:
        texts = pc.ascii_lower(texts)  # the tokenizer lower-cases what isn't an added token
    raw, bounds, _, _ = string_bytes(texts)
    raw = np.where(_WHITE[raw], np.uint8(32), raw)
    mark = np.zeros(len(raw) + 1, bool)
    white = raw == 32
    mark[1:-1] = (white[1:] & ~white[:-1]) | (_LETTER[raw[:-1]] & _SIGN[raw[1:]])
    if added:  # these have letters before a sign
        mark[1:-1] = white[1:] & ~white[:-1]
    cuts, edges = cut_at(mark, bounds, pa.py_buffer(raw), 0)
    ids, counts = encoder(cuts)
    passed = np.concatenate([[0], np.cumsum(counts)])
    return with_marks(ids, passed[edges], None, end_id)


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int, width: int = 2) -> DataFrame:
    """(doc_id, ids): the ids of each whole text and the end id, as little-endian integers of ``width`` bytes."""
    kind = {2: np.dtype("<u2"), 4: np.dtype("<u4")}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                ids, bounds = encode_batch(part["text"], encoder, end_id)
                if width == 2 and len(ids) and ids.max() >= 1 << 16:
                    raise ValueError("an id needs more than 16 bits: write with width=4")
                data = pa.py_buffer(ids.astype(kind))
                packed = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(bounds.astype(np.int64) * width), data])
                yield pa.RecordBatch.from_arrays([part["doc_id"], packed.cast(pa.binary())], ["doc_id", "ids"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, ids binary")


def write_shard(doc_ids: list[int | None], blobs: list[bytes], width: int) -> bytes:
    nulls = sum(x is None for x in doc_ids)
    counts = np.fromiter((len(b) // width for b in blobs), np.int64, len(blobs))
    out = io.BytesIO()
    out.write(HEADER.pack(MAGIC, width, nulls, len(blobs), int(counts.sum())))
    out.write(EliasFano.build(np.array([x for x in doc_ids if x is not None], np.int64)).to_bytes())
    out.write(EliasFano.build(np.concatenate([[0], np.cumsum(counts)])).to_bytes())
    out.writelines(blobs)
    return out.getvalue()


class Shard:
    """An opened shard; ``bounds.select(i)`` gives the place of document i without a table of offsets."""

    def __init__(self, source):
        magic, self.width, self.nulls, self.n_docs, self.n_ids = HEADER.unpack(source.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.doc_ids = EliasFano.read(source)
        self.bounds = EliasFano.read(source)
        self.source, self.begin = source, source.tell()

    def _read(self, first: int, last: int) -> np.ndarray:
        self.source.seek(self.begin + first * self.width)
        return np.frombuffer(self.source.read((last - first) * self.width), f"<u{self.width}")

    def ids(self, i: int) -> np.ndarray:
        return self._read(self.bounds.select(i), self.bounds.select(i + 1))

    def documents(self, step: int = SAMPLE) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """(doc ids, bounds, ids) of ``step`` documents at a time, in order; bounds count from the start of the shard."""
        for i in range(0, self.n_docs, step):
            bounds = self.bounds.select_run(i, step + 1)
            nulls = min(max(0, self.nulls - i), len(bounds) - 1)
            named = self.doc_ids.select_run(max(0, i - self.nulls), len(bounds) - 1 - nulls)
            yield [None] * nulls + named.tolist(), bounds, self._read(int(bounds[0]), int(bounds[-1]))

    def places(self, doc_id: int) -> range:
        """Where the documents of this id are in the shard."""
        return range(self.nulls + self.doc_ids.find(doc_id), self.nulls + self.doc_ids.find(doc_id + 1))


def _cuts(docs: DataFrame, least_bytes: int) -> list[int]:
    """Ascending ids where ranges end, at most about ``MOST_RANGES``, so that between two of them lie about ``least_bytes`` of text, or one id alone.

    Text is summed by equal ranges of ids. A range that holds too much is divided again, so that gaps and clusters
    of ids don't matter; what comes to the driver is a row for each range, a few for each cut.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).alias("size")).where("doc_id is not null")
    low, high, total = sized.agg(F.min("doc_id"), F.max("doc_id"), F.sum("size")).first()
    if low is None:
        return []
    most = max(least_bytes, total // MOST_RANGES)
    done: list[tuple[int, int]] = []  # last id of a range, and its bytes
    todo = [(low, high, total)]
    while todo:
        edges = np.array([r[:2] for r in sorted(todo)], np.int64).reshape(-1, 2)
        widths = [-(-(b - a + 1) // max(16, 4 * -(-size // most))) for a, b, size in sorted(todo)]

        def part(batches: Iterator[pa.RecordBatch], edges=edges, widths=np.array(widths, np.uint64)) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, sizes = np.asarray(batch["doc_id"], np.int64), np.asarray(batch["size"], np.int64)
                own = np.searchsorted(edges[:, 0], ids, "right") - 1
                inside = (own >= 0) & (ids <= edges[np.maximum(own, 0), 1])
                own, ids, sizes = own[inside], ids[inside], sizes[inside]
                # unsigned, as ids can be further apart than a signed number tells
                cell = (ids.astype(np.uint64) - edges[own, 0].astype(np.uint64)) // widths[own]
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(sizes)], ["own", "cell", "size"])

        found = sized.mapInArrow(part, "own int, cell int, size long").groupBy("own", "cell").agg(F.sum("size").alias("size")).collect()
        todo = []
        for r in found:
            first = int(edges[r["own"], 0]) + r["cell"] * widths[r["own"]]
            last = min(first + widths[r["own"]] - 1, int(edges[r["own"], 1]))
            if r["size"] > most and last > first:
                todo.append((first, last, r["size"]))
            else:
                done.append((last, r["size"]))
    cuts, held, before = [], 0, low
    for last, size in sorted(done):
        if held and held + size > most:
            cuts.append(before)
            held = 0
        held += size
        before = last
    return cuts


def write_archive(encoded: DataFrame, cuts: list[int], folder: str, width: int = 2, most_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write (doc_id, ids) as shards in ``folder``; one manifest row for each shard, with its place in the order.

    A task takes the ids between two of ``cuts``, sorted, and closes a shard at ``most_bytes`` of ids, so that it holds
    no more than a shard, however often an id is repeated. A shard is written under a temporary name and then moved to
    the name of its range and number, so that a repeated task leaves the same files.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(cuts, np.int64)
        for batch in batches:
            ids = np.asarray(pc.fill_null(batch["doc_id"], np.iinfo(np.int64).min), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(edges, ids, "left").astype(np.int32)), *batch.columns], ["range", *batch.schema.names])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)

        def finish():
            name = f"shard-{own:06d}-{number:05d}.eft"
            hidden = f"{root}/.{uuid.uuid4().hex}"
            with files.open_output_stream(hidden) as out:
                out.write(write_shard(ids, blobs, width))
            files.move(hidden, f"{root}/{name}")
            values = {"range": own, "number": number, "path": f"{folder}/{name}", "n_docs": len(ids), "n_ids": size // width}
            return pa.RecordBatch.from_pylist([values], _MANIFEST)

        own, number, size, ids, blobs = None, 0, 0, [], []
        for batch in batches:
            for i, doc_id, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (i != own or size + len(blob) > most_bytes):
                    yield finish()
                    number, size, ids, blobs = (number + 1 if i == own else 0), 0, [], []
                own = i
                ids.append(doc_id)
                blobs.append(blob)
                size += len(blob)
        if ids:
            yield finish()

    placed = encoded.mapInArrow(place, "range int, doc_id long, ids binary")
    dealt = placed.repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions("range", F.col("doc_id").asc_nulls_first(), "ids")
    manifest = keep(dealt.mapInArrow(store, "range int, number int, path string, n_docs long, n_ids long"), "token-manifest")
    order = Window.orderBy("range", "number")  # a row for each shard, not for each document
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("shard", (F.row_number().over(order) - 1).cast("int")).withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


_MANIFEST = pa.schema([("range", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _spread(manifest: DataFrame, width: int = 4) -> DataFrame:
    """The shards dealt evenly over tasks that read about ``TASK_BYTES`` each; a number that is given isn't coalesced."""
    found = manifest.agg(F.count("*").alias("shards"), F.sum("n_ids").alias("ids")).first()
    many = max(4 * manifest.sparkSession.sparkContext.defaultParallelism, -(-(found["ids"] or 0) * width // TASK_BYTES))
    tasks = max(1, min(found["shards"], many))
    return manifest.repartitionById(tasks, F.pmod("shard", F.lit(tasks)))


def read_archive(manifest: DataFrame) -> DataFrame:
    """One row for each document, read from the files: doc_id, start, n_tokens, ids_crc32 (ids as 32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist(), strict=True):
                files, name = pafs.FileSystem.from_uri(path)
                with files.open_input_file(name) as source:
                    for doc_ids, bounds, ids in Shard(source).documents():
                        at = (bounds - bounds[0]).tolist()
                        crcs = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(at[:-1], at[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _spread(manifest).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the documents whose ids are ``wanted``, by select in the shards of their ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, asked in zip(batch["path"].to_pylist(), batch["asked"].to_pylist(), strict=True):
                files, name = pafs.FileSystem.from_uri(path)
                with files.open_input_file(name) as source:
                    shard = Shard(source)
                    rows = [(i, shard.ids(at).astype(np.int64)) for i in asked for at in shard.places(i)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.list_(pa.int64()))], ["doc_id", "ids"])

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch["path"].to_pylist():
                files, name = pafs.FileSystem.from_uri(path)
                with files.open_input_file(name) as source:
                    own = Shard(source).doc_ids
                    rows.append((own.select(0), own.select(own.n - 1)) if own.n else (None, None))
            yield pa.RecordBatch.from_arrays([batch["path"], *(pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1))], ["path", "low", "high"])

    edges = keep(_spread(manifest).mapInArrow(spans, "path string, low long, high long"), "shard-spans")
    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    met = asked.join(edges, F.col("doc_id").between(F.col("low"), F.col("high")))
    return met.groupBy("path").agg(F.collect_list("doc_id").alias("asked")).mapInArrow(run, "doc_id long, ids array<long>")


def archive_documents(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, width: int = 2, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode ``docs`` and write the shards; returns the manifest for ``read_archive``."""
    encoded = encode_documents(docs, tokenizer_path, end_id, width)
    # a text has fewer bytes of ids than of characters
    return write_archive(encoded, _cuts(docs, 2 * shard_bytes), folder or scratch_path(docs.sparkSession, "token-archive"), width, shard_bytes)
