"""Fill-in-the-middle transformation with big integers as bit vectors.

A text is cut into units: runs of ASCII letters, and single code points that are none. ``bytes.translate`` turns its UTF-8
bytes into one digit a byte for each of two classes, ASCII letters and bytes that continue a code point, and each becomes
an integer with one bit a byte, the first byte highest. A byte begins a unit if it is neither a letter nor a continuing
byte, or if it is a letter and the bit before it isn't: a shift and three boolean operations for the whole text. The
number of units is a ``bit_count``; the place of the k-th is found by halving the integer again and again, each time going
on with the half that holds it, so that a text is read a constant number of times.

Four numbers from a digest of seed and ``doc_id`` choose the two cuts and the form, so that a rerun gives the same rows.
Rows are independent of each other; nothing is shuffled.

Forms: ``plain``, the text as it is; ``psm``, ``<P>prefix<S>suffix<M>middle``; ``spm``, ``<S>suffix<P>prefix<M>middle``. Texts that are
empty or hold a mark stay plain, so an output can always be read back (``restore``).

Defined results: a null text counts as empty, 0 units and plain; a null ``doc_id`` draws its numbers from the seed and
nothing else; repeated rows give repeated results; an empty table gives no rows; a text of any length is one row and is
cut whole; extra columns, of any name, come back in ``row``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import as_row, text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100: from here on a text stays plain
SUFFIX_FIRST = 20  # of 100 transformed texts
SEED = 1

_LETTER = bytes(48 + (65 <= b <= 90 or 97 <= b <= 122) for b in range(256))
_INNER = bytes(48 + (b & 0xC0 == 0x80) for b in range(256))


class Units:
    """The units of a text, as bits over its bytes."""

    def __init__(self, raw: bytes):
        self.size = len(raw)
        letters, self.inner = (int(raw.translate(t) or b"0", 2) for t in (_LETTER, _INNER))
        every = (1 << self.size) - 1
        self.begins = every & ~self.inner & ~(letters & (letters >> 1))
        self.n = self.begins.bit_count()

    def offset(self, k: int) -> int:
        """Where the first ``k`` units end, in bytes."""
        if k >= self.n:
            return self.size
        bits, width, at, left = self.begins, self.size, 0, k
        while width > 1:
            low = width // 2
            high = bits >> low
            found = high.bit_count()
            if left < found:
                bits, width = high, width - low
            else:
                bits, width, at, left = bits & ((1 << low) - 1), low, at + width - low, left - found
        return at

    def chars(self, start: int, end: int) -> int:
        """Code points that begin in bytes ``start`` to ``end``."""
        width = end - start
        return width - ((self.inner >> (self.size - end)) & ((1 << width) - 1)).bit_count()


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers of a row."""
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(drawn[i : i + 4]) for i in (0, 4, 8, 12)]


def transformed(doc_id: int | None, text: str, seed: int = SEED) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    raw = text.encode()
    units = Units(raw)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= PLAIN_FROM:
        return units.n, "plain", None, None, text
    a, b = (units.offset(k) for k in sorted((h1 % (units.n + 1), h2 % (units.n + 1))))
    prefix, middle, suffix = (x.decode() for x in (raw[:a], raw[a:b], raw[b:]))
    form = "spm" if h4 % 100 < SUFFIX_FIRST else "psm"
    parts = (SUFFIX, suffix, PREFIX, prefix) if form == "spm" else (PREFIX, prefix, SUFFIX, suffix)
    return units.n, form, units.chars(0, a), units.chars(a, b), "".join((*parts, MIDDLE, middle))


_FOUND = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output); the two counts are null where the form is plain.

    ``row`` holds all columns but the text, from which ``output`` is made.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = [transformed(d, t or "", seed) for d, t in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True)]
                made = [pa.array(list(c), f.type) for c, f in zip(zip(*found, strict=True), _FOUND, strict=True)]
                yield pa.RecordBatch.from_arrays([part["row"], *made], names=["row", *_FOUND.names])

    given = docs.select(as_row(docs.drop("text")).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, output string")
    return given.mapInArrow(run, StructType([given.schema["row"], *made.fields]))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    parts = F.split(output, "<[PSM]>")
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
