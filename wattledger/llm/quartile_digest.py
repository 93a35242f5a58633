"""Document fingerprints by quartile buckets of hashed byte triplets.

The UTF-8 bytes of a text, with two zero bytes before and behind them, are read as overlapping triplets. Each triplet is
hashed to one of ``BUCKETS`` buckets and counted. A bucket's code is the number of quartiles of all counts that it lies
above, 0 to 3. The digest is hexadecimal: two digits for the length, one each for the first and second quartile in
sixteenths of the third, then two bits a bucket, bucket 0 first and its code in the highest bits.

Two digests differ by 0, 1, 2 or 6 for codes that are 0, 1, 2 or 3 apart, by what the quartile digits differ and by at
most ``MOST_LENGTH`` for the length. The sum is bounded by ``MOST``, about twice what unrelated texts have, and the
likeness is one minus its share of the bound: 1 for equal texts, about a half for unrelated ones.

``with_next`` compares each text with the next in ascending order of ``doc_id`` and with an edited text made of both. Rows
are dealt into ranges of ids and sorted there, texts move once, and each task reads its range as a stream. The last text
of a range meets the first of the next one in a join with a row for each range.

Defined results: a null text counts as empty; an empty text has three zero digits of header and codes from its two
triplets of zeros; rows without ``doc_id`` come after all others; rows of one id are ordered by a hash of the text and by
the text; repeated rows stay repeated; a table of one row is its own next; an empty table gives no rows; texts of any
length are read whole, a megabyte of triplets at a time; extra columns, of any name, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import as_row, keep, text_slices

BUCKETS = 256
FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)  # a triplet's hash is the sum of its bytes times these, modulo 2^32; the bucket is the top byte
STEPS = (0, 1, 2, 6)
MOST_LENGTH = 16
MOST = 832
_PIECE = 1 << 20

_TABLES = [(np.arange(256, dtype=np.uint64) * f).astype(np.uint32) for f in FACTORS]
_STEPS = np.array(STEPS)


def bucket_counts(raw: bytes) -> np.ndarray:
    """How many triplets of the padded bytes fall into each bucket."""
    padded = np.frombuffer(b"".join((b"\0\0", raw, b"\0\0")), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for i in range(0, len(padded) - 2, _PIECE):
        part = padded[i : i + _PIECE + 2]
        counts += np.bincount((_TABLES[0][part[:-2]] + _TABLES[1][part[1:-1]] + _TABLES[2][part[2:]]) >> np.uint32(24), minlength=BUCKETS)
    return counts


def length_code(n: int) -> int:
    """Four steps for each doubling: the number of binary digits and the two digits after the first."""
    digits = n.bit_length()
    return 4 * digits + ((n << 2 >> (digits - 1)) & 3) if n else 0


def digest(raw: bytes) -> np.ndarray:
    """Header (length, first and second quartile in sixteenths of the third) and codes, as small integers."""
    counts = bucket_counts(raw)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].tolist()
    shares = [min(15, 16 * q // q3) if q3 else 0 for q in (q1, q2)]
    codes = (counts > q1).astype(np.int64) + (counts > q2) + (counts > q3)
    return np.concatenate([[length_code(len(raw)), *shares], codes])


def to_text(d: np.ndarray) -> str:
    return f"{d[0]:02x}{d[1]:x}{d[2]:x}" + (d[3:].reshape(-1, 4) @ [64, 16, 4, 1]).astype(np.uint8).tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    body = np.frombuffer(bytes.fromhex(fingerprint[4:]), np.uint8)
    codes = (body[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3
    return np.concatenate([[int(fingerprint[:2], 16), int(fingerprint[2], 16), int(fingerprint[3], 16)], codes.reshape(-1)]).astype(np.int64)


def score(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two digests."""
    apart = np.abs(a - b)
    found = int(_STEPS[apart[3:]].sum() + apart[1] + apart[2] + min(apart[0], MOST_LENGTH))
    return 1 - min(found, MOST) / MOST


def fingerprints(docs: DataFrame) -> DataFrame:
    """(row, fingerprint): every row of ``docs`` as one struct and the digest of its text."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: to_text(digest((t or "").encode())))

    return docs.select(as_row(docs).alias("row"), of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The likeness of two columns of fingerprints; null where one of them is."""

    @F.pandas_udf("double")
    def of(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([score(from_text(x), from_text(y)) if isinstance(x, str) and isinstance(y, str) else None for x, y in zip(left, right, strict=True)], dtype="float64")

    return of(a, b)


def _cut(raw: bytes, chars: int) -> int:
    """Where the first ``chars`` code points of ``raw`` end, in bytes; its length, if it has fewer."""
    start = 0
    while start < len(raw):
        lead = (np.frombuffer(raw, np.uint8, min(_PIECE, len(raw) - start), start) & 0xC0) != 0x80
        here = int(np.count_nonzero(lead))
        if chars < here:
            return start + int(np.flatnonzero(lead)[chars])
        chars -= here
        start += len(lead)
    return len(raw)


def _chars(raw: bytes) -> int:
    return sum(int(np.count_nonzero((np.frombuffer(raw, np.uint8, min(_PIECE, len(raw) - i), i) & 0xC0) != 0x80)) for i in range(0, len(raw), _PIECE))


def edited(raw: bytes, following: bytes) -> bytes:
    """The last half of the code points of ``raw`` replaced by as many of the first of ``following``, or all."""
    chars = _chars(raw)
    half = chars // 2
    return raw[: _cut(raw, chars - half)] + following[: _cut(following, half)]


FOUND = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


class _Pairs:
    """Results of texts, each with the next one of a stream."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, raw: bytes, own: np.ndarray, following: bytes, other: np.ndarray) -> None:
        mixed = edited(raw, following)
        changed = digest(mixed)
        self.rows.append((doc_id, _chars(raw), hashlib.sha256(mixed).hexdigest(), to_text(own), to_text(changed), score(own, changed), score(own, other)))

    def batch(self, schema: pa.Schema, *more: list) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [[] for _ in FOUND.split(",")]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*columns, *more], schema, strict=True)], schema=schema)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_ENDS = pa.schema([*_SCHEMA, ("part", pa.int32()), ("first", pa.string()), ("last", pa.string())])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All texts of a sorted range but the last with their next ones; the last row of the output holds the first and last text."""
    pairs, first, held, part = _Pairs(), None, None, None
    for batch in batches:
        for some in text_slices(batch, "text"):
            for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                raw = text.encode()
                now = (doc_id, raw, digest(raw))
                if held is None:
                    first, part = text, some["part"][0].as_py()
                else:
                    pairs.add(*held, *now[1:])
                held = now
            n = len(pairs.rows)
            yield pairs.batch(_ENDS, [None] * n, [None] * n, [None] * n)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((held[0], None, None, None, None, None, None, part, first, held[1].decode()), _ENDS, strict=True)], schema=_ENDS)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            doc_id, last, first = (batch[c][i].as_py() for c in ("doc_id", "last", "first"))
            pairs = _Pairs()
            pairs.add(doc_id, last.encode(), digest(last.encode()), first.encode(), digest(first.encode()))
            yield pairs.batch(_SCHEMA)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("hash")]
    ranged = texts.withColumn("hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    found = keep(ranged.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(_stream, f"{FOUND}, part int, first string, last string"), "digests")
    # a row for each range: the last text of one and the first of the next that has rows
    ends = found.where("part is not null")
    order = Window.orderBy("part")
    lone = F.first("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = ends.select("part").withColumn("follows", F.coalesce(F.lead("part").over(order), lone))
    met = ends.select("part", "doc_id", "last").join(following, "part").join(ends.select(F.col("part").alias("follows"), "first"), "follows")
    done = found.where("part is null").select(*_SCHEMA.names)
    return done.unionByName(met.select("doc_id", "last", "first").mapInArrow(_meet, FOUND))
