"""Substring deduplication by hashing lines and sentences.

A text is cut into units: lines, and inside them sentences. A unit is normalised (lower case, single spaces) and hashed
to 128 bits. Digests are grouped over all documents; the occurrence with the lowest rank, by doc_id and place, is kept
and every other one is a repeat. Repeats that follow each other form a run, with its place in the original text. All runs
are reported and removed, unless the caller asks for a least number of words, to leave stock phrases alone.

Digests are combined before the shuffle, so that a line in a third of all documents costs a row for each task. Only
repeated digests are joined back. Those of more than a thousandth of all repeats, which are at most a thousand, are
dealt over many tasks by a salt.

Defined results: null and empty texts have no units; rows with a null doc_id are left as they are and count for
nothing; rows that repeat both doc_id and text are one document; rows that share a doc_id but not the text are
ranked by their text's hash. Extra columns, of any name, are kept by ``remove_repeats``. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import as_row, keep, salted_join, text_slices

SHARE = 1000  # a digest of more than one in so many repeats is dealt over several tasks
LEAST_SHARE = 1000
_UNIT = re.compile(r"(?=\S)(?:[^\n.!?]+|[.!?](?!\s))*[.!?]?")


def unit_spans(text: str) -> list[tuple[int, int]]:
    """The places of lines and sentences; a sign ends a sentence where white space follows."""
    return [m.span() for m in _UNIT.finditer(text)]


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, version, hi, lo, place, start, end, words) of every unit; ``version`` is the hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                hashes, counts, spans, sizes = [], [], [], []
                for text in part["text"].to_pylist():
                    own = unit_spans(text) if text else []
                    for a, b in own:
                        words = text[a:b].lower().split()
                        hashes.append(digest(" ".join(words).encode("utf-8", "surrogatepass")))
                        counts.append(len(words))
                    spans += own
                    sizes.append(len(own))
                pairs = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                at = np.repeat(np.arange(len(part)), sizes)
                place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                where = np.array(spans, np.int32).reshape(-1, 2)
                columns = [part["doc_id"].take(pa.array(at)), part["version"].take(pa.array(at)), *(pa.array(pairs[:, i].copy()) for i in (0, 1)), pa.array(place.astype(np.int32)), *(pa.array(where[:, i].copy()) for i in (0, 1)), pa.array(counts, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "version", "hi", "lo", "place", "start", "end", "words"])

    text = F.col("text").cast("string")
    given = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("version"))
    return given.mapInArrow(run, "doc_id long, version long, hi long, lo long, place int, start int, end int, words int")


def repeated_runs(docs: DataFrame, min_words: int = 1) -> DataFrame:
    """(doc_id, version, start, end, n_units, n_words, kept_in): each run to remove, and the documents that keep its units."""
    found = units(docs)
    ranked = found.select("hi", "lo", F.struct("doc_id", "version", "place").alias("rank"))
    first = ranked.groupBy("hi", "lo").agg(F.min("rank").alias("first"), F.max("rank").alias("last"), F.count("*").alias("n"))
    first = keep(first.where("first <> last").select("hi", "lo", "first", "n"), "repeated-units")
    total = first.agg(F.sum("n")).first()[0] or 0
    later = salted_join(found, first, ["hi", "lo"], "n", ["doc_id", "version", "place"], total, LEAST_SHARE, SHARE).where("struct(doc_id, version, place) > first")
    # the same document twice in the table gives the same unit twice
    later = later.select("doc_id", "version", "place", "start", "end", "words", F.col("first.doc_id").alias("kept")).dropDuplicates(["doc_id", "version", "place"])
    order = Window.partitionBy("doc_id", "version").orderBy("place")
    runs = later.withColumn("run", F.col("place") - F.row_number().over(order)).groupBy("doc_id", "version", "run")
    whole = runs.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_units"), F.sum("words").alias("n_words"), F.sort_array(F.collect_set("kept")).alias("kept_in"))
    return whole.where(F.col("n_words") >= min_words).drop("run")


def remove_repeats(docs: DataFrame, min_words: int = 1) -> DataFrame:
    """The documents without their repeated runs; one that nothing is left of goes. ``n_chars`` follows if there is one."""
    spans = repeated_runs(docs, min_words).groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    text = F.col("row.text").cast("string")
    given = docs.select(as_row(docs).alias("row")).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"))
    joined = given.join(spans, ["doc_id", "version"], "left")
    # what stands between the runs, in order; places are counted in code points on both sides
    edges = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length(text)))
    between = F.array_join(F.zip_with(edges, ends, lambda a, b: F.substring(text, a + 1, b - a)), "")
    cut = joined.withColumn("left", F.when(F.col("spans").isNotNull(), between)).where(F.col("left").isNull() | F.col("left").rlike(r"\S"))

    def value(c: str) -> Column:
        old = F.col("row").getField(c)
        if c not in ("text", "n_chars"):
            return old.alias(c)
        new = F.col("left") if c == "text" else F.length("left")
        return F.when(F.col("left").isNull(), old).otherwise(new.cast(docs.schema[c].dataType)).alias(c)

    return cut.select(*map(value, docs.columns))
