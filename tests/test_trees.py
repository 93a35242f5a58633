"""Documents unfolded and written again, typed export, and trees of digests."""

import datetime
import decimal
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattledger.functions import maps
from wattledger.operators import documents, profiling, reconcile, trees

TEXTS = [
    '{"b": 1.50, "a":{"x": [1e2, {"q":null},[]],"y":1.10,"e":{}}, "s":"a\\n\\u00e9\\"", "n":null, "l":[ 1, "2", {"a.b":[[1,2],[3]]} ], "":0}',
    "5", ' -1.50e3 ', '"x"', "[]", "{}", "no json", None, "[[[[1]]]]", '{"k-1":"-2","":"5","\\ue000x":-7,"d":"1e5, 2","t":true}',
]


def compact(text):
    """The same JSON without white space, numbers as written."""
    number = type("Number", (float,), {})
    load = lambda t: json.loads(t, parse_float=lambda s: number_of(s), parse_int=lambda s: number_of(s))
    kept = {}

    def number_of(s):
        n = number(s)
        kept[id(n)] = (n, s)
        return n

    def show(x):
        if isinstance(x, number):
            return kept[id(x)][1]
        if isinstance(x, dict):
            return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{show(v)}" for k, v in x.items()) + "}"
        return "[" + ",".join(map(show, x)) + "]" if isinstance(x, list) else json.dumps(x, ensure_ascii=False)

    return show(load(text))


def test_documents_come_back_as_they_were_written(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, doc string")
    found = {r["id"]: r["w"] for r in trees.unfold(df, "doc", as_written=True).select("id", trees.written(F.col("_nodes")).alias("w")).collect()}
    assert found == {i: None if t in (None, "no json") else compact(t) for i, t in enumerate(TEXTS)}
    values = {r["id"]: r["w"] for r in trees.unfold(df, "doc").select("id", trees.written(F.col("_nodes")).alias("w")).collect()}
    assert all(json.loads(values[i]) == json.loads(t) for i, t in enumerate(TEXTS) if t not in (None, "no json"))
    deep = '{"a":' * 30 + "[1e3]" + "}" * 30
    assert trees.unfold(spark.createDataFrame([(deep,)], "doc string"), "doc", as_written=True).select(trees.written(F.col("_nodes"))).first()[0] == deep


LEAVES = st.one_of(st.none(), st.booleans(), st.integers(-(2**60), 2**60), st.text(max_size=6))
NAMES = st.text(alphabet="ab._'[]\"\\é", max_size=3)
VALUES = st.recursive(LEAVES, lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(NAMES, inner, max_size=3)), max_leaves=12)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.data_too_large])
@given(st.lists(VALUES, min_size=20, max_size=40))
def test_any_document_comes_back(spark, values):
    df = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)], "id int, doc string")
    for r in trees.unfold(df, "doc", as_written=True).select("id", trees.written(F.col("_nodes")).alias("w")).collect():
        assert json.loads(r["w"]) == values[r["id"]]


def test_an_inventory_counts_what_documents_hold(spark):
    """Skeletons stand for documents: the inventory is that of all documents unfolded."""
    long = "x\\\" " * 100_000
    texts = [t for t in TEXTS if t] + ['{"a":1.0,"b":-0,"c":12345678901234567890,"d":1e5,"e":0.1234567890123456789}', '{"a":false,"false":[1,2.5,null,"1.5",true,-3],"-1":{"2.5":7}}', json.dumps({"t": long, "n": [1] * 5000}), '{"a":01}', '{"a":1,"a":2}', '{"a":"b\\\\","c":"\\\\\\"1,2"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "id int, doc string")
    found = {r["path"]: (r["documents"], r["missing"], r["nulls"], set(r["types"])) for r in profiling.field_inventory(df, "doc", "id").collect()}
    wanted = {}
    for r in profiling.paths(df, "doc", "id").collect():
        wanted.setdefault(r["path"], {}).setdefault(r["id"], set()).add(r["type"])
    assert found == {p: (len(d), len(texts) * 3 - len(d), sum("VOID" in t for t in d.values()), set().union(*d.values())) for p, d in wanted.items()}


def test_fields_are_removed_by_their_own_names(spark):
    text = '{"a":[{"geometry":{"b":1e2}},2.50],"x.geometry":{"y":1},"geometry":[1],"c":{"geometry":null}}'
    df = spark.createDataFrame([(1, text), (2, "no json"), (3, None)], "id int, doc string")
    assert {r["id"]: r["doc"] for r in documents.without_keys(df, "doc").collect()} == {1: '{"a":[{},2.50],"x.geometry":{"y":1},"c":{}}', 2: "no json", 3: None}
    assert sorted(r["path"] for r in documents.forbidden_paths(df, "doc", "id").collect()) == ["a[].geometry", "c.geometry", "geometry"]
    found = {r["path"]: (r["documents"], r["missing"], r["nulls"], r["types"]) for r in profiling.field_inventory(df, "doc", "id").collect()}
    assert found["a[]"] == (1, 2, 0, ["DECIMAL", "OBJECT"]) and found["c.geometry"] == (1, 2, 1, ["VOID"]) and found["['x.geometry'].y"] == (1, 2, 0, ["BIGINT"])
    values = {(r["path"], r["type"]): r["value"] for r in profiling.paths(spark.createDataFrame([(1, '{"a":"x\\"y","b":[1,null,true]}')], "id int, doc string"), "doc", "id").collect()}
    assert values == {("a", "STRING"): 'x"y', ("b", "ARRAY"): None, ("b[]", "BIGINT"): "1", ("b[]", "VOID"): None, ("b[]", "BOOLEAN"): "true"}


def test_typed_documents_come_back_with_their_types(spark):
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 6)
    columns = "id int, ts timestamp, dt date, bin binary, f float, d double, dec decimal(5,2), whole decimal(5,2), n long, nest array<array<int>>, m map<string,string>, s string, b boolean"
    rows = spark.createDataFrame(
        [(1, at, at.date(), bytearray(b"\x00\xffx"), 1.5, 100.0, decimal.Decimal("2.50"), decimal.Decimal("3.00"), 7, [[1, 2], []], {"a": None}, 't"x', True), (2, None, None, None, float("nan"), float("inf"), None, None, None, None, {}, "", None)], columns
    )
    fields = F.struct(*rows.columns, F.create_map(F.lit(trees.REFERENCE), F.lit("a/b")).alias("ref"), F.struct(F.lit(1).alias("__type"), F.lit("q").alias("___type")).alias("odd"), F.col("ts").cast("timestamp_ntz").alias("ntz"))
    given_ = rows.select("id", F.to_variant_object(fields).alias("v")).unionByName(spark.range(3, 6).select(F.col("id").cast("int").alias("id"), F.when(F.col("id") == 3, F.parse_json(F.lit("5"))).when(F.col("id") == 4, F.parse_json(F.lit("[]"))).alias("v")))
    told = trees.unfold(given_, "v").select("id", "v", trees.written(trees.typed(F.col("_nodes"))).alias("j"))
    first = json.loads(told.where("id = 1").first()["j"])
    assert first["ts"] == {"__type": "timestamp", "value": "2024-01-02 03:04:05.000006+00:00"} and first["n"] == 7 and first["d"] == {"__type": "double", "value": "100.0"}
    assert first["bin"] == {"__type": "bytes", "value": "AP94"} and first["ref"] == {"__type": "reference", "path": "a/b"} and first["odd"] == {"___type": 1, "____type": "q"}
    back = told.join(trees.from_typed(told, "j", "id"), "id")
    assert {r["id"]: r["same"] for r in back.select("id", maps.same_variant(F.col("v"), F.col("document")).alias("same")).collect()} == dict.fromkeys(range(1, 6), True)
    kinds = back.where("id = 1").select(F.schema_of_variant("v").alias("a"), F.schema_of_variant("document").alias("b")).first()
    assert kinds["a"] == kinds["b"]


@pytest.mark.parametrize("n", [0, 50, 6000])
def test_digest_trees_name_what_differs(spark, tmp_path, n):
    rows = spark.range(n).select(F.format_string("%05d", "id").alias("id"), (F.col("id") * 3).alias("v"))
    same = reconcile.write_tree(rows, f"file://{tmp_path}/a", "id", ["v"])
    assert reconcile.differing_branches(spark, same, reconcile.write_tree(rows.repartition(3), f"file://{tmp_path}/b", "id", ["v"])) == []
    if not n:
        return
    changed = rows.withColumn("v", F.when(F.col("id") == "00007", -1).otherwise(F.col("v")))
    other = reconcile.write_tree(changed, f"file://{tmp_path}/c", "id", ["v"])
    assert len(reconcile.differing_branches(spark, same, other)) == 1
    found = reconcile.tree_differences(spark, same, other)
    assert [tuple(r) for r in found.collect()] == [("00007", "differs")]
    scans = [line for line in found._jdf.queryExecution().toString().splitlines() if "PartitionFilters: [" in line]
    assert scans and all("branch" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    grown = changed.where("id <> '00009'").unionByName(spark.range(9000 if n > 50 else 60).select(F.format_string("n%05d", "id").alias("id"), F.col("id").alias("v")))
    more = reconcile.write_tree(grown, f"file://{tmp_path}/d", "id", ["v"])
    wanted = {("00007", "differs"), ("00009", "left_only")} | {(f"n{i:05d}", "right_only") for i in range(9000 if n > 50 else 60)}
    assert {tuple(r) for r in reconcile.tree_differences(spark, same, more).collect()} == wanted
