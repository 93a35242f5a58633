"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as lower-case words with single spaces between them. A test item of m characters may differ by
k = m // ``chars_per_edit`` edits; cut into k + 1 pieces, at least one piece of every such occurrence is intact. All
pieces of the items form one automaton, which finds their exact places in a text in one pass; around each place
Myers' bit-parallel matching then decides whether the item occurs with at most k edits, and where.

The items are a query set: they are taken in blocks of at most about ``BLOCK_BYTES``, each of which is sent to the tasks
and run against all documents.

Defined results: an item without words, or null, matches nothing; items with equal words all match; null and empty
texts match nothing; rows that repeat a document repeat its matches; a null doc_id stays null; extra columns are
ignored; without items or documents there are no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
CHARS_PER_EDIT = 25
_GAPS = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")
# lower-casing these depends on what stands around them, or gives two characters; everything else keeps its place
_STEADY = str.maketrans({"İ": "i", "Σ": "σ", "ς": "σ"})


def lower(text: str) -> str:
    """Lower case of the same length as ``text``, so that a place in one is that place in the other."""
    return text.translate(_STEADY).lower()


def words_of(text: str) -> str:
    """The text as it is compared, with a space at either end."""
    return _GAPS.sub(" ", f" {lower(text)} ")


def word_places(text: str) -> list[int]:
    """For each character of ``words_of(text)`` the place in ``text`` that it comes from; for a space, where the word before it ends."""
    places = [0]
    for found in _WORD.finditer(lower(text)):
        places.extend(range(found.start(), found.end() + 1))
    return places


def span_of(words: str, first: int, last: int, places: list[int]) -> tuple[int, int]:
    """Where the characters ``first`` to ``last`` of the words stand in the text, without spaces at either end."""
    while first < last and words[first] == " ":
        first += 1
    while last > first and words[last - 1] == " ":
        last -= 1
    return (places[first], places[last - 1] + 1) if last > first else (places[first], places[first])


def best_match(pattern: str, window: str, most: int, codes: dict[str, int] | None = None) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of ``pattern`` that ends in ``window``, the first of equals, within ``most`` edits."""
    codes = pattern_codes(pattern) if codes is None else codes
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << m - 1
    plus, minus, score = full, 0, m
    best = None
    for i, char in enumerate(window):
        eq = codes.get(char, 0)
        x = eq | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        hp = minus | (full & ~(d0 | plus))
        hn = plus & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & full, hn << 1 & full
        plus = hn | (full & ~(d0 | hp))
        minus = hp & d0
        if score <= most and (best is None or score < best[0]):
            best = score, i + 1
    return best


def pattern_codes(pattern: str) -> dict[str, int]:
    codes: dict[str, int] = {}
    for i, char in enumerate(pattern):
        codes[char] = codes.get(char, 0) | 1 << i
    return codes


class Items:
    """A block of test items, with the automaton of their pieces; built once in each task."""

    def __init__(self, rows: list[tuple[int, str]], chars_per_edit: int):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in rows:
            pattern = words_of(text or "")
            if not pattern.strip():
                continue
            k = len(pattern) // chars_per_edit
            edges = [len(pattern) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(edges, edges[1:], strict=False):
                pieces.setdefault(pattern[a:b], []).append((len(self.items), a))
            self.items.append((item_id, pattern, k, pattern_codes(pattern), pattern_codes(pattern[::-1])))
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, first, last) of each match in ``text``, places in characters of the text as given."""
        if not self.items or not text:
            return []
        words = words_of(text)
        spots: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(words):
            for i, offset in where:
                spots.setdefault(i, set()).add(end + 1 - size - offset)
        found = []
        for i, starts in sorted(spots.items()):
            item_id, pattern, k, codes, back = self.items[i]
            done = -1
            for start in sorted(starts):
                if start + len(pattern) - k <= done:
                    continue  # inside a match that has been reported
                first = max(0, start - k)
                window = words[first : start + len(pattern) + k]
                if best := best_match(pattern, window, k, codes):
                    distance, end = best
                    size = best_match(pattern[::-1], window[:end][::-1], distance, back)[1]
                    done = first + end
                    found.append((item_id, distance, done - size, done))
        if found:
            places = word_places(text)
            found = [(i, d, *span_of(words, a, b, places)) for i, d, a, b in found]
        return found


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_bytes``, the only part of the data that comes to the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    for block in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def matches(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, start, end): where each document holds a test item."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for rows in _blocks(benchmark, block_bytes):
        part = given.mapInArrow(_matcher(rows, chars_per_edit), "doc_id long, item_id long, distance int, start int, end int")
        out = part if out is None else out.unionByName(part)
    return out


def _matcher(rows: list[tuple[int, str]], chars_per_edit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Items(rows, chars_per_edit)
        for batch in batches:
            hits = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                hits += [(doc_id, *hit) for hit in block.find(text.as_py() or "")]
            columns = list(zip(*hits, strict=True)) if hits else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "distance", "start", "end"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that hold no test item, with all their columns; no document is shuffled."""

    def keeper(rows: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Items(rows, chars_per_edit)
            for batch in batches:
                yield batch.filter(pa.array([not block.find(t.as_py() or "") for t in batch["text"]], pa.bool_()))

        return run

    for rows in _blocks(benchmark, block_bytes):
        docs = docs.mapInArrow(keeper(rows), docs.schema)
    return docs
