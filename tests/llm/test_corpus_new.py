"""Fingerprints, integer codebooks and fill-in-the-middle against plain versions, and on odd rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattledger.llm import fill_middle, quartile_digest, queries, vector_codes

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, row int, hash string, part int, last string, fingerprint string, n long, form string, output string"
LONG = "ein langer Text, ünïcode 🙂 words " * 20_000
ODD = [(i, t, 1, "h", 2, "l", "f", 3, "g", "o") for i, t in [(3, None), (1, ""), (2, "a"), (2, "b"), (2, "b"), (5, LONG), (None, "no id"), (None, None), (-7, "é🙂x"), (9, "holds <S> a mark"), (10, " \n\t"), (11, "Wörter und words 12")]]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def plain_digest(text):
    """A digest by counting one triplet after the other."""
    raw = b"\0\0" + text.encode() + b"\0\0"
    counts = collections.Counter(((raw[i] * 0x9E3779B1 + raw[i + 1] * 0x85EBCA6B + raw[i + 2] * 0xC2B2AE35) % 2**32) >> 24 for i in range(len(raw) - 2))
    every = [counts[b] for b in range(256)]
    q = [sorted(every)[i] for i in (63, 127, 191)]
    n = len(text.encode())
    bits = f"{n:b}00"
    size = 4 * n.bit_length() + int(bits[1:3], 2) if n else 0
    codes = [sum(c > x for x in q) for c in every]
    shares = [min(15, 16 * x // q[2]) if q[2] else 0 for x in q[:2]]
    body = "".join(f"{codes[i] << 6 | codes[i + 1] << 4 | codes[i + 2] << 2 | codes[i + 3]:02x}" for i in range(0, 256, 4))
    return f"{size:02x}{shares[0]:x}{shares[1]:x}{body}", (size, *shares), codes


def plain_likeness(a, b):
    (_, (s, *p), c), (_, (t, *q), d) = a, b
    apart = sum((0, 1, 2, 6)[abs(x - y)] for x, y in zip(c, d, strict=True)) + sum(abs(x - y) for x, y in zip(p, q, strict=True)) + min(16, abs(s - t))
    return 1 - min(apart, 832) / 832


def plain_pairs(rows):
    """What ``with_next`` gives for (doc_id, text) rows in order."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        n = len(text)
        edited = text[: n - n // 2] + following[: n // 2]
        own, changed, other = map(plain_digest, (text, edited, following))
        out.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), own[0], changed[0], plain_likeness(own, changed), plain_likeness(own, other)))
    return out


def test_fingerprints_are_the_plain_ones(spark, odd):
    for docs in (documents(spark), odd, odd.limit(1), odd.where("doc_id = 2").limit(0)):
        found = [tuple(r) for r in quartile_digest.with_next(docs).collect()]
        rows = [(r["doc_id"], r["text"] or "") for r in docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("hash", F.xxhash64("text")).orderBy(F.col("doc_id").asc_nulls_last(), "hash", "text").collect()]
        assert sorted(map(repr, found)) == sorted(map(repr, plain_pairs(rows)))


def test_ranges_meet_at_their_ends(spark):
    """Many small ranges, some of one row: each document still meets the next one."""
    rng = random.Random(5)
    rows = [(i * 3, "".join(rng.choice("abcdé 🙂") for _ in range(rng.randrange(40)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wide = df.unionByName(df.limit(0)).repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = [tuple(r) for r in quartile_digest.with_next(wide).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(found) == plain_pairs(rows)


def test_fingerprints_tell_edited_from_other_texts(spark):
    rows = quartile_digest.with_next(documents(spark)).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))
    texts = collections.defaultdict(set)
    for r in quartile_digest.fingerprints(documents(spark)).select("row.text", "fingerprint").collect():
        texts[r["text"]].add(r["fingerprint"])
    assert all(len(f) == 1 for f in texts.values())
    text = documents(spark).orderBy(F.desc(F.length("text"))).first()["text"]
    near = spark.createDataFrame([(text, text), (text, text[:-40] + "another end of the text, forty letters.."), (text, None)], "a string, b string")
    made = quartile_digest.fingerprints(near.withColumnRenamed("a", "text")).select("fingerprint", F.col("row.b").alias("text"))
    both = quartile_digest.fingerprints(made.withColumnRenamed("fingerprint", "first"))
    found = both.select(quartile_digest.likeness(F.col("row.first"), F.when(F.col("row.text").isNotNull(), F.col("fingerprint")))).collect()
    assert found[0][0] == 1.0 and found[1][0] > 0.95 and found[2][0] is None


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """(vec_id, code, error) and the digest of the books, in whole numbers of Python."""
    kept = sorted((((i is None, i or 0), [int(np.floor(1024 * float(x))) for x in v], i) for i, v in rows), key=lambda r: r[:2])
    d = len(kept[0][1]) if kept else 0
    cuts = [(p * d // parts, (p + 1) * d // parts) for p in range(parts)]
    books = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in cuts]

    def near(x, book):
        return min((sum((p - q) ** 2 for p, q in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            groups = collections.defaultdict(list)
            for _, v, _ in kept:
                groups[near(v[a:b], books[p])[1]].append(v[a:b])
            for e, xs in groups.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = []
    for _, v, i in kept:
        found = [near(v[a:b], books[p]) for p, (a, b) in enumerate(cuts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(x for x, _ in found)))
    return out, hashlib.sha256(",".join(str(c) for book in books for row in book for c in row).encode()).hexdigest()


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(9, d))
    return [(int(i), (base[rng.integers(9)] + (0.0 if i % 7 == 0 else 0.1) * rng.normal(size=d)).astype(np.float32).tolist(), ("x", "y", None)[i % 3]) for i in rng.permutation(n)]


@pytest.mark.parametrize(("n", "d"), [(400, 8), (300, 6), (20, 3), (5, 0)])
def test_codes_are_exact(spark, n, d):
    rows = vectors(n, d, n)
    odd = [(1000, None, "x"), (1001, [float("nan")] * d or None, "x"), (1002, [float("inf")] * d or None, None), (1003, [None] * d or None, "y"), (1004, [1.0] * (d + 1), "y")]
    twice = [rows[0], (rows[1][0], [-x for x in rows[1][1]], "y"), (None, rows[2][1], None)]
    df = spark.createDataFrame([(*r, i, "c", b"b") for i, r in enumerate(rows + odd + twice)], "vec_id long, embedding array<float>, label string, part int, code string, codes binary").repartition(5)
    found = vector_codes.compress(df).collect()
    wanted, digest = plain_codes([r[:2] for r in rows + twice])
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in found), key=repr) == sorted(wanted, key=repr)
    assert {r["codebooks_sha256"] for r in found} == {digest}
    labels = collections.defaultdict(list)
    for i, _, label in rows + twice:
        labels[label].append(i)
    sums = collections.Counter(r["label_error"] for r in found)
    errors = collections.defaultdict(list)
    for i, _, e in wanted:
        errors[i].append(e)
    if all(len(e) == 1 or len(set(e)) == 1 for e in errors.values()):
        assert sums == sum((collections.Counter({sum(errors[i][0] for i in ids): len(ids)}) for ids in labels.values()), collections.Counter())


def test_codes_of_few_rows_and_decoding(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(none).collect() == []
    df = spark.createDataFrame([(i, [i / 4, -i / 8, 0.0, 1.0, 2.0], i % 2) for i in range(12)], "vec_id long, embedding array<double>, label int")
    whole = vector_codes.whole_vectors(df)
    books = vector_codes.fit(whole)
    coded = vector_codes.encode(whole, books)
    back = coded.join(whole, "vec_id").select("error", "v", vector_codes.decode(F.col("codes"), books).alias("d")).collect()
    assert all(sum((a - b) ** 2 for a, b in zip(r["v"], r["d"], strict=True)) == r["error"] == 0 for r in back)
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.compress(df.withColumn("embedding", F.transform("embedding", lambda x: x * 1e12))).collect()


def plain_middle(doc_id, text):
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_middles_are_the_plain_ones_and_restore(spark, odd):
    rng = random.Random(3)
    more = spark.createDataFrame([(i, "".join(rng.choice("aZ é🙂<P>SM\n1") for _ in range(rng.randrange(30)))) for i in range(400)], "doc_id long, text string")
    for docs in (documents(spark), odd, more):
        rows = fill_middle.transform(docs).select("*", fill_middle.restore(F.col("output"), F.col("form")).alias("restored")).collect()
        texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
        wanted = [plain_middle(*t) for t in texts]
        assert sorted((tuple((r["row"]["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])) for r in rows), key=repr) == sorted(wanted, key=repr)
        assert sorted(((r["row"]["doc_id"], r["restored"]) for r in rows), key=repr) == sorted(texts, key=repr)
    assert {w[2] for w in wanted} == {"plain", "psm", "spm"}
    assert fill_middle.transform(odd.limit(0)).count() == 0
    assert fill_middle.transform(odd).first()["row"].asDict().keys() == set(odd.columns) - {"text"}


@pytest.mark.parametrize("text", ["", "a", "é", "ab cd", "🙂🙂", "x1" * 500, "é" * 33 + "abc" * 50 + "\n"])
def test_units_are_found_by_halving(text):
    units = fill_middle.Units(text.encode())
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    assert units.n == len(tokens)
    for k in range(len(tokens) + 1):
        end = units.offset(k)
        assert text.encode()[:end].decode() == "".join(tokens[:k]) and units.chars(0, end) == len("".join(tokens[:k]))


def test_new_queries_cover_their_tables(spark):
    for name, table in (("op11_quartile_digest", "documents"), ("op12_vector_codes", "embeddings"), ("op13_fill_middle", "documents")):
        assert queries.queries()[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
