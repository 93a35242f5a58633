"""The versioned store: commits that name a version, reads that open few files, refreshes against other writers."""

import pytest
from pyspark.sql import functions as F

from wattledger import pipelines
from wattledger.operators import sampling, upsert, validate
from wattledger.sources import sinks, store

SCHEMA = "id string, lm string, months map<string,bigint>"


@pytest.fixture
def made(spark, tmp_path):
    rows = spark.range(1000).select(F.format_string("%04d", "id").alias("id"), F.concat(F.lit("L"), F.col("id") % 4).alias("lm"), F.create_map(F.lit("2024-01"), F.col("id")).alias("months"))
    return store.create(rows, f"file://{tmp_path}/s", "id", rows_per_file=100)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_commits_merge_and_old_versions_stay(spark, made):
    extra = spark.createDataFrame([("0005", "X", {"a": 1}), ("5000", "Y", None)], SCHEMA)
    second = store.commit(made, extra, spark.createDataFrame([("0006",), ("9999",)], "id string"))
    third = store.commit(second, spark.createDataFrame([("0006", "back", {})], SCHEMA), spark.createDataFrame([("0005",)], "id string"))
    assert [store.read(spark, v).count() for v in (made, second, third)] == [1000, 1000, 1000]
    rows = {r["id"]: r for r in store.read(spark, second, token=True).collect()}
    assert rows["0005"]["lm"] == "X" and rows["0005"][store.TOKEN] == 2 and rows["0004"][store.TOKEN] == 1 and "0006" not in rows and rows["5000"]["months"] is None
    rows = {r["id"]: r for r in store.read(spark, store.version(spark, made.path), token=True).collect()}
    assert "0005" not in rows and rows["0006"]["lm"] == "back" and rows["0006"][store.TOKEN] == 3
    packed = store.compact(spark, third)
    again = {r["id"]: r for r in store.read(spark, packed, token=True).collect()}
    assert again == rows and len(packed.parts) == 1 and store.version(spark, made.path, 2).number == 2
    assert store.read(spark, store.commit(packed, spark.createDataFrame([], SCHEMA))).count() == 1000  # an empty commit is a version too
    with pytest.raises(validate.ContractError, match="no such version"):
        store.version(spark, made.path, 99)


def test_of_two_commits_on_one_version_one_fails(spark, made, monkeypatch):
    one = spark.createDataFrame([("0001", "A", {})], SCHEMA)
    store.commit(made, one)
    with pytest.raises(validate.ContractError, match="planned on version 1"):
        store.commit(made, one)
    # the second writer looks before the first one's entry is there
    seen = store.version(spark, made.path)
    store.commit(seen, one)
    monkeypatch.setattr(store, "pointer", lambda *_: (seen.number, seen.entry))
    with pytest.raises(validate.ContractError, match="another writer"):
        store.commit(seen, one.withColumn("lm", F.lit("lost")))
    monkeypatch.undo()
    assert store.read(spark, store.version(spark, made.path), {"id": "0001"}).first()["lm"] == "A"


def test_commits_refuse_null_and_repeated_keys(spark, made):
    for rows in ([(None, "A", {})], [("1", "A", {}), ("1", "B", {})]):
        with pytest.raises(validate.ContractError, match="null or repeated"):
            store.commit(made, spark.createDataFrame(rows, SCHEMA))
    assert store.version(spark, made.path).number == 1


def test_reads_open_the_files_that_they_need(spark, made, tmp_path):
    whole = store.read(spark, made)
    assert len(whole.inputFiles()) >= 8
    part = store.read(spark, made, {"id": ("0150", "0160")}, ["id"])
    assert len(part.inputFiles()) <= 2 and ids(part) == [f"{i:04d}" for i in range(150, 161)]
    months = spark.range(1200).select(F.format_string("%05d", "id").alias("k"), F.format_string("2024-%02d", F.col("id") % 12 + 1).alias("ym"))
    seen = store.create(months, f"file://{tmp_path}/m", "k", ["ym"], rows_per_file=50)
    one = store.read(spark, seen, {"ym": "2024-05"})
    assert one.count() == 100 and len(one.inputFiles()) <= 4 < len(store.read(spark, seen).inputFiles())
    # a row that has left the month lies in a delta, and its old form doesn't come back
    gone = store.commit(seen, spark.createDataFrame([("00004", "2024-06"), ("00005", "2024-05")], "k string, ym string"))
    assert {r["k"] for r in store.read(spark, gone, {"ym": "2024-05"}).collect()} == {r["k"] for r in one.collect()} - {"00004"} | {"00005"}


def test_points_open_no_more_files_than_keys(spark, made, monkeypatch):
    second = store.commit(made, spark.createDataFrame([("0300", "X", {})], SCHEMA), spark.createDataFrame([("0301",)], "id string"))
    asked = spark.createDataFrame([("0300",), ("0301",), ("0300",), ("7777",), (None,)], "id string")
    files = store._names(store._candidates(spark, second, asked.where("id is not null")))
    assert 1 <= len(files) <= 4
    found = {r["id"]: (r["lm"], r["found"]) for r in store.get(spark, second, asked).collect()}
    assert found == {"0300": ("X", True), "0301": (None, False), "7777": (None, False), None: (None, False)}
    some = spark.range(0, 1000, 3).select(F.format_string("%04d", "id").alias("id"))
    by_file = sorted(map(repr, store.get(spark, second, some).collect()))
    assert sum(r["found"] for r in store.get(spark, second, some).collect()) == 334
    monkeypatch.setattr(store, "MOST_POINTS", 0)
    assert sorted(map(repr, store.get(spark, second, some).collect())) == by_file


def test_windows_and_pages(spark, made):
    live = {f"{i:04d}" for i in range(1000)} - {f"{i:04d}" for i in range(150, 320)} | {"0151x", "5000"}
    gone = spark.range(150, 320).select(F.format_string("%04d", "id").alias("id"))
    seen = store.commit(made, spark.createDataFrame([("0151x", "N", {}), ("5000", "N", {})], SCHEMA), gone)
    anchors = [(a,) for a in ("", "0149", "0151", "0990", "4999", "9")]
    found = store.windows(spark, seen, spark.createDataFrame(anchors, "anchor string"), 7)
    got = {}
    for r in found.orderBy("anchor", "place").collect():
        got.setdefault(r["anchor"], []).append(r["row"]["id"])
    assert got == {a: w for (a,) in anchors if (w := sorted(x for x in live if x >= a)[:7])}
    assert [r["id"] for r in store.page(spark, seen, "0998", 5).collect()] == ["0998", "0999", "5000"]
    one = store.windows(spark, made, spark.createDataFrame([("0500",)], "anchor string"), 5)
    assert one.count() == 5
    drawn = [r["anchor"] for r in sampling.key_anchors(store.read(spark, made), "id", 50, 3).collect()]
    assert drawn == [r["anchor"] for r in sampling.key_anchors(store.read(spark, made), "id", 50, 3).collect()] and len(set(drawn)) > 30 and all("0000" <= a <= "0999" for a in drawn)


def expected(spark, *rows):
    return spark.createDataFrame([(i, lm, {"2024-01": int(i), **more}) for i, lm, more in rows], SCHEMA)


def test_a_refresh_writes_patches_only_and_verifies(spark, made):
    wanted = expected(spark, ("0001", "L1", {"2024-02": 5}), ("0002", "L2", {}), ("7000", "N", {}))
    told = pipelines.refresh_store(spark, made.path, wanted, ["lm"], [], ["months"], preflight_only=True).first()
    assert told["verdict"] == "PREFLIGHT_PASSED" and store.version(spark, made.path).number == 1
    told = pipelines.refresh_store(spark, made.path, wanted, ["lm"], [], ["months"]).first()
    assert (told["created"], told["updated"], told["unchanged"], told["version"], told["differing"], told["preserved"], told["verdict"]) == (1, 1, 1, 2, 0, 0, "PASS")
    now = store.version(spark, made.path)
    assert now.parts[-1]["rows"] == 2 and store.read(spark, now, {"id": "0001"}).first()["months"] == {"2024-01": 1, "2024-02": 5}
    with pytest.raises(validate.ContractError, match="blocked"):
        pipelines.refresh_store(spark, made.path, expected(spark, ("0001", "moved", {"2024-02": 5})), ["lm"], [], ["months"])


@pytest.mark.parametrize("kind", ["store", "table"])
def test_a_refresh_meets_another_writer(spark, made, tmp_path, monkeypatch, kind):
    """Another commit between plan and write: it survives, and the plan fails if one of its documents has moved."""
    path = f"file://{tmp_path}/t" if kind == "table" else made.path
    if kind == "table":
        sinks.guarded_write(store.read(spark, made), path)
    run = pipelines.refresh if kind == "table" else pipelines.refresh_store
    args = ("id", ["lm"], [], ["months"]) if kind == "table" else (["lm"], [], ["months"])
    rows = lambda: sinks.read_table(spark, path) if kind == "table" else store.read(spark, store.version(spark, path))

    def interleaved(*others):
        gate = upsert.require_gate

        def write_first(plan):
            monkeypatch.setattr(upsert, "require_gate", gate)
            added = expected(spark, *others)
            if kind == "table":
                sinks.guarded_write(sinks.read_table(spark, path).join(added, "id", "left_anti").unionByName(added), path, replace=True)
            else:
                store.commit(store.version(spark, path), added)
            return gate(plan)

        monkeypatch.setattr(upsert, "require_gate", write_first)

    wanted = expected(spark, ("0001", "L1", {"2024-02": 5}))
    interleaved(("0001", "L1", {"2024-09": 9}), ("8000", "N", {}))
    with pytest.raises(validate.ContractError, match="moved since the plan"):
        run(spark, path, wanted, *args)
    assert rows().where("id = '0001'").first()["months"] == {"2024-01": 1, "2024-09": 9} and rows().where("id = '8000'").count() == 1
    interleaved(("0003", "L3", {"2024-09": 9}), ("8001", "N", {}))
    again = expected(spark, ("0001", "L1", {"2024-09": 9, "2024-10": 1}))
    assert run(spark, path, again, *args).first()["verdict"] == "PASS"
    months = {r["id"]: r["months"] for r in rows().where("id in ('0001', '0003', '8001')").collect()}
    assert months == {"0001": {"2024-01": 1, "2024-09": 9, "2024-10": 1}, "0003": {"2024-01": 3, "2024-09": 9}, "8001": {"2024-01": 8001}}


def test_a_migration_is_executed_and_verified(spark, tmp_path):
    old = '{"lmPcode":"LM","meterNo":{"raw":"M1","normalized":"M1"},"meterType":"electricity","customerNo":"","accountNo":"","astId":"A","metadata":{"createdAt":"2024-01-01T00:00:00Z"}}'
    path = f"file://{tmp_path}/masters"
    store.create(spark.createDataFrame([("M1", old, 1), ("M2", old.replace("M1", "M2").replace('"LM"', '""'), 2)], "masterId string, doc string, n int"), path, "masterId")
    assert pipelines.migrate_store(spark, path, "doc", preflight_only=True).first()["verdict"] == "BLOCKED"
    with pytest.raises(validate.ContractError, match="blocked"):
        pipelines.migrate_store(spark, path, "doc")
    assert store.version(spark, path).number == 1
    store.commit(store.version(spark, path), deleted=spark.createDataFrame([("M2",)], "masterId string"))
    told = pipelines.migrate_store(spark, path, "doc").first()
    assert (told["planned"], told["updated"], told["left"], told["touched"], told["verdict"]) == (1, 1, 0, 0, "PASS")
    assert pipelines.migrate_store(spark, path, "doc").first()["unchanged"] == 1
    assert store.read(spark, store.version(spark, path)).first()["n"] == 1
