"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

Features of a text: the density of a lexicon's words in all words, in sentences and in their longest run without one;
how near lexicon words stand to second-person words; shares of capitals, exclamation and question marks, repeated
letters, and words with digits or signs inside; and the share of obfuscated lexicon words, found after signs and digits
are read as the letters they stand for. The lexicon is learned from the training rows: words, and beginnings of words,
that toxic rows hold much oftener than others.

Training uses at most ``MOST_ROWS`` labelled rows, taken by the lowest hash of their ids; of these a fifth fits the
calibration and the others the trees. Scoring is one pass over the documents.

Defined results: null and empty texts get the score of a text without any feature; a labelled row without a document
or with a null label is not used; with labels of one kind only, every score is that kind's share; repeated rows are
scored alike; extra columns, of any name, are kept out of the features. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_row, keep, text_slices

MOST_ROWS = 20_000
MOST_TERMS = 4_000  # of the lexicon
BEGINNINGS = (4, 5, 6, 7)
# fixed values: second-person words, and signs that stand for letters
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine tu te toi ton ta tes vous votre vos usted ustedes tú ti tuyo".split())
_LEET = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "*": "", ".": "", "-": "", "_": ""})
_WORD = re.compile(r"\w+")
_TOKEN = re.compile(r"[^\s]+")
_SENTENCE = re.compile(r"[.!?\n]+")
_REPEAT = re.compile(r"(\w)\1\1")
_MIXED = re.compile(r"(?<=\w)[@$*!|0-9_.\-]+(?=\w)")
FEATURES = ("hits", "density", "distinct", "sentences", "densest", "near_you", "beginnings", "obfuscated", "capitals", "shouted", "bangs", "signs", "repeats", "mixed", "words")


class Lexicon:
    """Whole words and beginnings of words, with a weight each."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]):
        self.words, self.beginnings = words, beginnings

    @classmethod
    def learn(cls, rows: DataFrame, toxic: int, clean: int, least: int = 3, ratio: float = 8.0, most: int = MOST_TERMS) -> Lexicon:
        """Terms that at least ``least`` toxic rows hold, ``ratio`` times as often as clean rows do; the ``most`` clearest."""
        words = rows.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), F.lit(0)))).alias("word"))
        starts = [F.when(F.length("word") > k, F.struct(F.substring("word", 1, k).alias("term"), F.lit(True).alias("begins"))) for k in BEGINNINGS]
        whole = F.struct(F.col("word").alias("term"), F.lit(False).alias("begins"))
        # a beginning counts once for each word that it begins, which favours none of the two kinds of rows
        terms = words.select("toxic", F.explode(F.array_compact(F.array(whole, *starts))).alias("t"))
        counts = terms.groupBy("t.term", "t.begins").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        odds = (F.col("bad") / F.lit(max(1, toxic))) / ((F.col("good") + 0.5) / F.lit(max(1, clean)))
        clear = counts.where(F.col("bad") >= F.when(F.col("begins"), 2 * least).otherwise(least)).withColumn("odds", odds).where(F.col("odds") >= ratio)
        found = clear.orderBy(F.desc(F.col("bad") * F.log("odds")), "term", "begins").limit(most).collect()
        beginnings = {r["term"]: math.log(r["odds"]) for r in found if r["begins"]}
        # of nested beginnings the shortest suffices
        beginnings = {b: w for b, w in beginnings.items() if not any(b[:k] in beginnings for k in BEGINNINGS if k < len(b))}
        return cls({r["term"]: math.log(r["odds"]) for r in found if not r["begins"]}, beginnings)


_marks: list[np.ndarray] = []


def _signs() -> np.ndarray:
    """For each code point: 1 for a letter, 2 more for a capital, 4 more for what can be in a word. Made once in each worker."""
    if not _marks:
        every = [chr(i) for i in range(0x110000)]
        of = lambda f: np.fromiter(map(f, every), np.uint8, len(every))
        _marks.append(of(str.isalpha) + 2 * of(str.isupper) + 4 * of(lambda c: c.isalnum() or c == "_"))
    return _marks[0]


def capitals_of(text: str) -> tuple[int, int, int]:
    """(letters, capitals, words of three and more letters that are all capitals)."""
    kind = _signs()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    upper = np.zeros(len(kind) + 2, bool)
    upper[1:-1] = kind & 2
    word = np.zeros(len(kind) + 2, bool)
    word[1:-1] = kind & 4
    edge = np.flatnonzero(upper[1:] != upper[:-1])
    starts, ends = edge[::2] + 1, edge[1::2] + 1
    shouted = (ends - starts >= 3) & ~word[starts - 1] & ~word[ends]
    return int((kind & 1).sum()), int(upper.sum()), int(shouted.sum())


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one whole text, in the order of ``FEATURES``."""
    low = text.lower()
    words = _WORD.findall(low)
    n = max(1, len(words))
    table, starts = lexicon.words, lexicon.beginnings
    distinct = set(words)
    bad = {w for w in distinct if w in table}
    begun = {w for w in distinct if any(w[:k] in starts for k in BEGINNINGS if len(w) > k)} if starts else set()
    places = [i for i, w in enumerate(words) if w in bad] if bad else []
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON] if places else []
    near = 0.0
    if places and second:
        at = np.searchsorted(second, places)
        right = np.abs(np.take([*second, 10**9], at) - places)
        left = np.abs(np.array(places) - np.take([-(10**9), *second], at))
        near = float((1 / np.maximum(1, np.minimum(left, right))).sum())
    sentences = hit = 0
    densest = 0.0
    if bad or begun:
        for part in _SENTENCE.split(low):
            own = _WORD.findall(part)
            if own:
                k = sum(w in bad or w in begun for w in own)
                sentences, hit = sentences + 1, hit + (k > 0)
                densest = max(densest, k / len(own))
    mixed = [t for t in _TOKEN.findall(low) if _MIXED.search(t)] if _MIXED.search(low) else []
    hidden = sum(t.translate(_LEET).strip(",;:()\"'?") in table for t in mixed)
    letters, capitals, shouted = capitals_of(text)
    bangs = text.count("!")
    signs = bangs + sum(text.count(c) for c in "?*#$%&@~")
    weight = sum(table[w] for w in bad)
    return [
        weight, len(places) / n, len(bad), hit / max(1, sentences), densest, near / n * 100, len(begun) / n, hidden / n * 100,
        capitals / max(1, letters), shouted / n, bangs / n, signs / n, len(_REPEAT.findall(low)) / n, len(mixed) / n, float(np.log1p(len(words))),
    ]


def with_features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(row, one double for each feature); ``row`` is the given row, and its ``text`` is what is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch["text"], pa.array(range(len(batch)))], ["text", "at"])
            for part in text_slices(texts, "text"):
                rows = np.array([features(t or "", lexicon) for t in part["text"].to_pylist()], np.float64).reshape(len(part), len(FEATURES))
                own = batch["row"].slice(part["at"][0].as_py(), len(part))
                yield pa.RecordBatch.from_arrays([own, *(pa.array(rows[:, i].copy()) for i in range(len(FEATURES)))], ["row", *FEATURES])

    given = docs.select(as_row(docs).alias("row")).select("row", F.col("row.text").cast("string").alias("text"))
    return given.mapInArrow(run, T.StructType([given.schema["row"], *(T.StructField(f, T.DoubleType()) for f in FEATURES)]))


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, trees, steps, share: float = 0.0):
        self.lexicon, self.trees, self.steps, self.share = lexicon, trees, steps, share

    def score(self, docs: DataFrame) -> DataFrame:
        """(row, score): the given row, and the calibrated chance of label 1."""
        found = with_features(docs, self.lexicon)
        if self.trees is None:
            return found.select("row", F.lit(self.share).alias("score"))
        return self.steps.transform(_raw(self.trees, found)).select("row", "score")


def _assembled(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)


def _raw(trees, found: DataFrame) -> DataFrame:
    return trees.transform(_assembled(found)).withColumn("raw", vector_to_array("p")[1])


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, trees: int = 20, depth: int = 3, seed: int = 7) -> ToxicityModel:
    """Fit lexicon, trees and calibration on labelled rows (doc_id, toxic), at most ``most_rows`` of them."""
    wanted = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    chosen = keep(wanted.orderBy(order, "doc_id", "toxic").limit(most_rows), "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = keep(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic", F.pmod(order, F.lit(5)).alias("part")), "training")
    fit = rows.where("part <> 0")
    counts = {r["toxic"]: r["n"] for r in fit.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return ToxicityModel(Lexicon({}, {}), None, None, float(counts.get(1, 0) > 0))
    lexicon = Lexicon.learn(fit, counts[1], counts[0])
    put = keep(with_features(rows.select("text", "toxic", "part"), lexicon).select(F.col("row.toxic").cast("double").alias("toxic"), "row.part", *FEATURES), "training-features").cache()
    ready = _assembled(put.where("part <> 0").coalesce(4)).cache()
    booster = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed, minInstancesPerNode=5, predictionCol="y")
    booster = booster.setProbabilityCol("p").setRawPredictionCol("r")
    model = booster.fit(ready)
    held = _raw(model, put.where("part = 0")).select("raw", "toxic").cache()
    if held.count() < 50:
        held = _raw(model, put).select("raw", "toxic")
    steps = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="score").fit(held)
    put.unpersist(), ready.unpersist(), held.unpersist()
    return ToxicityModel(lexicon, model, steps)


def held_out(doc_id):
    """Rows whose label is never learned from: crc32 of the id as text, divided by five, leaves nothing."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document, learned from the rows that aren't held out."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = model.score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return scored.select("row.doc_id", F.coalesce(held_out(F.col("row.doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
