"""Numbers of equal purchases over runs of a stream, and files of several encodings in one folder."""

import pytest
from pyspark.sql import functions as F

from wattledger.operators import facts, validate
from wattledger.sources import delimited
from wattledger.streaming import duplicates
from wattledger.streaming.duplicates import read_numbered, with_stream_ids, write_numbered

SCHEMA = "lm string, ym string, amount long, row int"
KEY = ["lm", "ym", "amount"]


def test_numbers_go_on_after_a_restart(spark, tmp_path):
    """Three runs, each from the state that the one before left: the ids of one batch over all rows."""
    rows = [("A", f"2024-0{1 + i % 3}", i % 4, i) for i in range(60)] + [("B", None, None, 100 + i) for i in range(3)]
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    for part in (rows[:20], rows[20:21], rows[21:]):
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(source)
        stream = with_stream_ids(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 10).parquet(source), ["row"], KEY, "2024-01")
        write_numbered(stream, out, state).awaitTermination()
    write_numbered(stream, out, state).awaitTermination()  # nothing new, nothing changes
    found, conflicts = read_numbered(stream, out)
    every = spark.createDataFrame(rows, SCHEMA)
    wanted = facts.with_atomic_ids(every.where("ym > '2024-01' or ym is null"), ["row"], tuple(KEY))
    assert sorted(map(repr, found.select("row", "atomicId").collect())) == sorted(map(repr, wanted.select("row", "atomicId").collect()))
    late = conflicts.collect()
    assert {r["row"] for r in late} == {r[3] for r in rows if r[1] == "2024-01"} and {r["code"] for r in late} == {"CLOSED_MONTH"}


def test_numbers_go_on_over_many_micro_batches(spark, tmp_path, monkeypatch):
    """Counts of all keys are written together now and then; rows stay in Spark, so that no key costs a call of Python."""
    monkeypatch.setattr(duplicates, "EVERY", 3)
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    rows = [("A", "2024-02", i % 3, i) for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).repartition(8).write.parquet(source)
    stream = with_stream_ids(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), ["row"], KEY)
    write_numbered(stream, out, state, 2).awaitTermination()
    found = [r[0] for r in read_numbered(stream, out)[0].select("atomicId").collect()]
    wanted = facts.with_atomic_ids(spark.createDataFrame(rows, SCHEMA), ["row"], tuple(KEY))
    assert sorted(found) == sorted(r[0] for r in wanted.select("atomicId").collect())
    assert "MapInPandas" not in (plan := stream._jdf.queryExecution().toString()) and "State" not in plan


def test_each_file_is_read_in_its_encoding(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_bytes("﻿id, name\n1,Zoë\n2,NA\n".encode())
    (folder / "b.csv").write_bytes("id,name\n3,Müller\n4,\"x, y\"\n".encode("latin-1"))
    (folder / "c.csv").write_bytes('id,name\n5,"two\nlines é"\n6,z\n'.encode())
    found = delimited.read_csv(spark, f"file://{folder}", ["id", "name"], "line")
    assert sorted(map(tuple, found.collect())) == [("1", "Zoë", 1), ("2", None, 2), ("3", "Müller", 1), ("4", "x, y", 2), ("5", "two\nlines é", 1), ("6", "z", 2)]
    traits = {r["file"][-5]: (r["encoding"], r["broken"]) for r in delimited.file_traits(spark, f"file://{folder}").collect()}
    assert traits == {"a": ("UTF-8", False), "b": ("ISO-8859-1", False), "c": ("UTF-8", True)}
    (folder / "d.csv").write_bytes("id,other\n7,Ö\n".encode("latin-1"))
    with pytest.raises(validate.ContractError, match="columns"):
        delimited.read_csv(spark, f"file://{folder}", ["id", "name"]).count()
    assert delimited.read_csv(spark, f"file://{folder}/a.csv").where(F.col("name") == "Zoë").count() == 1
