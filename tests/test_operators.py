"""Rules, folds, plans, sources and sinks on small tables."""

import hashlib
import json
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wattledger import pipelines
from wattledger.functions import maps as M
from wattledger.functions import numbering
from wattledger.functions import scalars as S
from wattledger.operators import address, aggregates, entities, evidence, execution, facts, linkage, population, profiling, reconcile, records, upsert, validate, wide
from wattledger.plans import reports
from wattledger.sources import delimited, sinks, workbook
from wattledger.streaming import windows


def values(spark, items, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, c string")
    return [r[0] for r in df.select("i", column.alias("v")).orderBy("i").select("v").collect()]


def test_money(spark):
    given = ["R 1 234,50", "1,234", "1,234.50", "12.345", "-0.005", ".5", "1e3", "", None, "abc", "1 000", "1.2.3", "R", "12R5"]
    assert values(spark, given, S.money_cents("c")) == [123450, 123, 123450, 1235, -1, 50, 100000, None, None, None, 100000, None, None, 12500]
    assert values(spark, ["R12", "12R5"], S.money_cents("c", drop_every_r=False)) == [1200, None]
    assert values(spark, ["", "5", "5.004", "5.0000001", "-1"], S.workbook_cents("c")) == [0, 500, None, 500, None]


def test_meters_and_keys(spark):
    given = [" 0123.0 ", "ab 12.0", "12 34", None]
    assert values(spark, given, S.raw_meter_no("c")) == ["0123", "AB12.0", "1234", ""]
    assert values(spark, given, S.meter_no("c")) == ["0123.0", "AB12.0", "1234", ""]
    assert values(spark, ["007.0", "0", "00A", None], S.parcel_no("c")) == ["7", "0", "00A", ""]
    assert values(spark, ["' 12.0", "a b"], S.account_no("c")) == ["12", "ab"]
    assert values(spark, ["cat3 x", "NORMAL", " ", None, "CAT9"], S.category_bucket("c")) == ["CAT3", "NORMAL", "MISSING", "MISSING", "OTHER"]


def test_times_and_months(spark):
    time = S.day_first_time("c")
    assert values(spark, ["1/2/2026 3:04", "01/02/2026 03:04:05", "31/02/2026 1:00", "x", None], S.iso_text(time)) == ["2026-02-01T03:04:00", "2026-02-01T03:04:05", None, None, None]
    assert values(spark, ["2026-01-01T00:00:00Z", "2026-01-01T00:00:00"], S.zoned_time("c").isNotNull()) == [True, False]
    assert values(spark, ["2025-12"], S.next_month("c")) == ["2026-01"]
    assert values(spark, ["45292"], S.serial_month(F.col("c").cast("double"))) == ["2024-01"]


def test_spending_groups_at_their_edges(spark):
    edges = ["0", "9999", "10000", "29999", "30000", "49999", "50000", "99999", "100000"]
    assert values(spark, edges, S.spending_group(F.col("c").cast("bigint"))) == ["GR1", "GR1", "GR2", "GR2", "GR3", "GR3", "GR4", "GR4", "GR5"]


RAW = "CDUToggle string, VendingNo_3 string, TransactionDateTime_2 string, Amount string, RefundAmount string, CostOfUnits_2 string, VAT string, sourceRow int"


def test_portal_rules_each(spark):
    good = ["", "M1", "1/6/2026 10:00", "1,15", "0", "1", "0.15"]
    cases = {
        "": {}, "invalid_transaction_datetime": {2: "x"}, "transaction_month_mismatch": {2: "1/7/2026 10:00"}, "blank_meter_number": {1: " "}, "meter_group_mismatch": {0: "M2"},
        "invalid_amount": {3: "x"}, "invalid_cost": {5: ""}, "invalid_vat": {6: None}, "invalid_refund_amount": {4: "n"}, "negative_amount;amount_cost_vat_reconciliation_failed": {3: "-1.15"},
        "negative_cost;amount_cost_vat_reconciliation_failed": {5: "-1"}, "negative_vat;amount_cost_vat_reconciliation_failed": {6: "-1"}, "non_zero_refund_requires_separate_design": {4: "1"}, "amount_cost_vat_reconciliation_failed": {3: "9"},
    }
    rows = [[changes.get(i, v) for i, v in enumerate(good)] + [n] for n, changes in enumerate(cases.values())]
    found = facts.stage_portal(spark.createDataFrame(rows, RAW), "LM", "2026-06")
    assert {r["sourceRow"]: r["rejectReason"] for r in found.rejected.collect()} == {i: c for i, c in enumerate(cases) if c}
    assert [tuple(r) for r in found.valid.collect()] == [("LM", "1/6/2026 10:00", "M1", "1.15", "1.00", "0.15", 0)]
    with pytest.raises(validate.ContractError):
        found.require_clean()


def test_staged_rows_to_facts(spark):
    row = ("LM", "1/6/2026 10:00", "m 1", "R1.15", "1", "0.15")
    staged = spark.createDataFrame([(*row, 1), (*row, 2), ("", *row[1:], 3)], "lmPcode string, txAt string, meterNo string, amountTotalC string, costC string, vatC string, sourceRow int")
    found = facts.atomic_facts(staged, "P", "LM", "2026-06", "f.csv", 0)
    ids = [r["atomicId"] for r in found.valid.orderBy("sourceRow").collect()]
    assert ids[1] == ids[0] + "__2" and found.valid.columns == list(facts.ATOMIC_COLUMNS)
    assert found.rejected.first()["rejectReason"] == "blank_lmPcode;lmPcode_filename_or_argument_mismatch"
    assert facts.id_mismatches(found.valid).count() == 0
    validate.require_all(found.valid, facts.fact_checks("LM", "2026-06"))


LISTED = "meterNo string, meterNoRaw string, customerNo string, accountNo string, accountStatus string, lastPurchaseDate string, sourceRow int"


def fold(spark, rows, step=entities.fold_customers):
    return step(spark.createDataFrame([("M", "M", *r, i) for i, r in enumerate(rows)], LISTED)).first()


def test_customer_duplicates(spark):
    assert fold(spark, [("M", "M", "", ""), ("C", "C", "", "")])["customerNo"] == "C"
    kept = fold(spark, [("C", "C", "", ""), ("M", "M", "", "2026-01-01")])
    assert (kept["customerNo"], kept["placeholder"], kept["lastPurchaseDate"]) == ("C", 1, "")
    assert fold(spark, [("C", "C", "Block Purchases", ""), ("D", "D", "Active", "")])["customerNo"] == "D"
    late = fold(spark, [("C", "C", "", "2026-01-01"), ("D", "D", "", "2026-02-01"), ("E", "E", "", "2026-01-15")])
    assert (late["customerNo"], late["latest"], late["errors"]) == ("D", 2, 0)
    assert fold(spark, [("C", "C", "", ""), ("D", "D", "", "")])["errors"] == 1
    filled = fold(spark, [("C", "", "", ""), ("C", "A", "", "2026-01-01")])
    assert (filled["accountNo"], filled["lastPurchaseDate"], filled["listed"]) == ("A", "2026-01-01", 2)
    with pytest.raises(validate.ContractError):
        entities.require_resolved(entities.fold_customers(spark.createDataFrame([("M", "M", "C", "C", "", "", 0), ("M", "M", "D", "D", "", "", 1)], LISTED)))


def test_npr_duplicates(spark):
    blank = fold(spark, [("C", "", "", ""), ("", "", "", "2026-01-01")], entities.fold_npr)
    assert (blank["customerNo"], blank["lastPurchaseDate"]) == ("C", "")
    assert fold(spark, [("M", "", "", ""), ("C", "", "", "")], entities.fold_npr)["customerNo"] == "C"
    assert fold(spark, [("C", "", "", "2026-01-01"), ("D", "", "", "2026-01-01")], entities.fold_npr)["errors"] == 1


# more lines beside those of the registered query
MORE_ADDRESSES = [
    ("12 SMITH STREET, FLAT 3", "", "12", "Smith", "Street"), ("12 SMITH FLAT 3", "", "12", "Smith", "-"), ("12 SMITH ROAD", "STREET", "12", "Smith", "Road"), ("PLOT 5 FARM", "", "", "", address.ROLE), ("5 AND 7 MAIN", "", "", "", address.CONFLICT),
    ("WHITE HOUSE 5", "7 MAIN", "7", "Main", "-"), ("  12b   o'neil-smith ", "", "12B", "O'neil-smith", "-"), ("12 MAIN", "PHASE 3", "12", "Main", "-"), ("12 MAIN", "3 PHASE TWO", "", "", address.CONFLICT), (None, None, "", "", address.NO_NUMBER), ("5", "", "", "", address.NO_NUMBER), ("", "SHOP 4", "4", "Shop", "-"),
]


def test_addresses(spark):
    lines = [*reports.ADDRESSES, *MORE_ADDRESSES]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, *_) in enumerate(lines)], "i int, addressLine1 string, addressLine2 string")
    rows = address.enrich(df, places=reports.PLACES).orderBy("i").select("adr.*")
    found = [(r["strNo"], r["strName"], r["reason"] or r["strType"]) for r in rows.collect()]
    assert found == [tuple(x[2:]) for x in lines]
    assert sum(r["n"] for r in address.report(address.enrich(df)).collect()) == len(lines)
    assert rows.select(address.address_valid(F.col("strNo"), F.col("strName"), F.col("strType")).alias("ok")).where("ok").count() == len(lines)
    wrong = spark.createDataFrame([("42", "", "-"), ("", "", "Street"), ("x", "Main", "-"), ("42", "Main", "Alley")], "a string, b string, c string")
    assert wrong.where(address.address_valid(F.col("a"), F.col("b"), F.col("c"))).count() == 0


def test_append_only_histories(spark):
    df = spark.sql("select map('a', 1, 'b', 2) as o, map('a', 1, 'b', 2, 'c', 3) as n, map('a', 9) as x")
    r = df.select(M.extend_history(F.col("o"), F.col("n")).alias("g"), M.extend_history(F.col("o"), F.col("x")).alias("b"), M.changed_keys(F.col("o"), F.col("x")).alias("k"), M.map_total(F.col("n")).alias("t"), M.maps_equal(F.col("o"), F.col("o")).alias("e")).first()
    assert r["g"]["value"] == {"a": 1, "b": 2, "c": 3} and r["g"]["conflicts"] == []
    assert r["b"]["value"] == {"a": 1, "b": 2} and r["b"]["conflicts"] == ["a"] and r["k"] == ["a", "b"] and r["t"] == 6 and r["e"]


def test_fields_at_any_depth(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":[{"c":{"d":{"e":{"f":[[1,"x"],null]}}}}]}}'), (2, '{"a":1}'), (3, "no json"), (4, None)], "id int, doc string")
    found = {(r["path"], r["type"], r["value"]) for r in profiling.paths(df, "doc", "id").collect()}
    assert ("a.b[].c.d.e.f[][]", "BIGINT", "1") in found and ("a.b[].c.d.e.f[][]", "STRING", "x") in found and ("a.b[].c.d.e.f[]", "VOID", None) in found
    assert {r["path"]: r["documents"] for r in profiling.field_inventory(df, "doc", "id").collect()}["a"] == 2


def test_digests_tell_values_apart(spark):
    digest = lambda rows: reconcile.digest(spark.createDataFrame(rows, "a string, b string"), ["a", "b"]).first()["digest"]
    rows = [("a", "b"), (None, "b"), ("", "b"), ("a1:b", ""), ("-", "b"), ("␀", "b")]
    assert len({digest([r]) for r in rows}) == len(rows)
    assert digest(rows) == digest(rows[::-1]) != digest(rows[:-1])


def test_recovery_wants_the_same_ids_everywhere(spark):
    before = spark.createDataFrame([("a", {"x": "1"}, "v"), ("b", {"x": "1"}, "v")], "masterId string, fields map<string,string>, token string")
    plan = spark.createDataFrame([("a", "UPDATED", "v", {"x": "2"}), ("c", "UPDATED", "v", {"x": "2"})], "masterId string, classification string, token string, patch map<string,string>")
    now = spark.createDataFrame([("a", {"x": "2"}), ("b", {"x": "1"}), ("c", {"x": "2"})], "masterId string, fields map<string,string>")
    found = upsert.recovery(before, plan, now)
    assert {r["masterId"]: r["outcome"] for r in found.collect()} == {"a": "RESTORE", "b": "NOT_IN_PLAN", "c": "BEFORE_IMAGE_MISSING"}
    with pytest.raises(validate.ContractError):
        upsert.require_recoverable(found)
    upsert.require_recoverable(found.where("masterId = 'a'"))


def test_type_strict_equality(spark):
    r = spark.sql("select parse_json('{\"a\":1}') as a, parse_json('{\"a\":1.0}') as b, parse_json('{\"a\":true}') as c").select(M.same_variant(F.col("a"), F.col("a")), M.same_variant(F.col("a"), F.col("b")), M.same_variant(F.col("a"), F.col("c"))).first()
    assert tuple(r) == (True, False, False)


def test_one_conflict_blocks_the_plan(spark):
    expected = spark.range(1, 2001).select(F.col("id").cast("string").alias("id"), F.lit("LM").alias("lm"), F.col("id").alias("v"))
    existing = expected.withColumn("lm", F.when(F.col("id") == "1800", "X").otherwise(F.col("lm"))).withColumn("v", F.lit(0).cast("long"))
    plan = upsert.classify(expected, existing, "id", ["lm"], ["v"], [])
    found = upsert.gate(plan).first()
    assert (found["planned"], found["conflict"], found["may_write"]) == (2000, 1, False)
    with pytest.raises(validate.ContractError):
        upsert.require_gate(plan)
    good = upsert.require_gate(plan.where("id <> '1800'"))
    written = upsert.apply_plan(good, expected, existing, "id")
    assert upsert.verify(expected.where("id <> '1800'"), written, "id", ["lm", "v"]).first()["verdict"] == "PASS"
    again = upsert.classify(expected.where("id <> '1800'"), written, "id", ["lm"], ["v"], [])
    assert [r["classification"] for r in again.select("classification").distinct().collect()] == ["UNCHANGED"]


def test_a_month_is_refreshed_or_left_alone(spark, tmp_path):
    path = f"file://{tmp_path}/sales"
    rows = lambda *x: spark.createDataFrame([(i, lm, {"2024-01": 1, **more}) for i, lm, more in x], "id string, lm string, months map<string,bigint>")
    sinks.guarded_write(rows(("a", "L", {}), ("b", "L", {})), path)
    wanted = rows(("a", "L", {"2024-02": 2}), ("b", "L", {}), ("c", "L", {}))
    told = pipelines.refresh(spark, path, wanted, "id", ["lm"], [], ["months"], preflight_only=True).first()
    assert (told["created"], told["updated"], told["unchanged"], told["written"]) == (1, 1, 1, False) and sinks.read_table(spark, path).count() == 2
    told = pipelines.refresh(spark, path, wanted, "id", ["lm"], [], ["months"]).first()
    assert (told["written"], told["verdict"]) == (True, "PASS")
    assert {r["id"]: r["months"] for r in sinks.read_table(spark, path).collect()} == {"a": {"2024-01": 1, "2024-02": 2}, "b": {"2024-01": 1}, "c": {"2024-01": 1}}
    with pytest.raises(validate.ContractError, match="blocked"):
        pipelines.refresh(spark, path, rows(("a", "M", {"2024-02": 2})), "id", ["lm"], [], ["months"])
    with pytest.raises(validate.ContractError, match="rehearsal"):  # lm isn't owned and isn't an identity here
        pipelines.refresh(spark, path, rows(("a", "M", {"2024-02": 2, "2024-03": 3})), "id", [], [], ["months"])
    assert sinks.read_table(spark, path).count() == 3
    folder = f"file://{tmp_path}/all"
    assert pipelines.initial_load(spark, {"sales": (wanted.drop("months"), "id")}, folder).first()["rows"] == 3
    with pytest.raises(validate.ContractError, match="loaded before"):
        pipelines.initial_load(spark, {"sales": (wanted.drop("months"), "id")}, folder)
    with pytest.raises(validate.ContractError, match="unique"):
        pipelines.initial_load(spark, {"sales": (wanted.drop("months").unionByName(wanted.drop("months")), "id")}, folder + "2")
    report = spark.createDataFrame([("build", "dev", "PASS", "a" * 64), ("verify", "dev", "FAIL", "b" * 64)], "stage string, mode string, status string, fingerprint string")
    pipelines.require_report(report, "build", "dev")
    for stage, mode in (("verify", "dev"), ("build", "live"), ("none", "dev")):
        with pytest.raises(validate.ContractError):
            pipelines.require_report(report, stage, mode)


@pytest.mark.parametrize("broken_at", [None, 9_800])
def test_waves_of_a_large_plan_stop_at_the_first_that_fails(spark, broken_at):
    plan = spark.range(1, 10_217).select(F.format_string("M%05d", "id").alias("id"), F.lit("UPDATED").alias("classification"), F.lit("t").alias("token"))
    store = plan.select("id", F.when(F.col("id") == f"M{broken_at or 0:05d}", "u").otherwise("t").alias("token"), F.lit("old").alias("v"))
    after, evidence_ = execution.execute(plan, plan.select("id", F.lit("new").alias("v")), store, "id")
    found = evidence_.orderBy("wave").collect()
    assert [r["operations"] for r in found] == [400] * 25 + [216]
    states = [r["state"] for r in found]
    assert states == (["COMMITTED"] * 26 if broken_at is None else ["COMMITTED"] * 24 + ["FAILED", "NOT_ATTEMPTED"])
    assert after.where("v = 'new'").count() == (10_216 if broken_at is None else 9_600) and after.count() == 10_216
    ids = [f"M{i:05d}" for i in range(1, 401)]
    assert found[0]["idsSha256"] == hashlib.sha256(json.dumps(ids, separators=(",", ":")).encode()).hexdigest()
    retried = execution.retry_outcomes(plan, store, "id").groupBy("outcome", "attempts").count().collect()
    assert {(r[0], r[1]): r[2] for r in retried} == ({("COMMITTED", 1): 10_216} if broken_at is None else {("COMMITTED", 1): 9_816, ("COMMITTED", 2): 399, ("CONFLICT", 2): 1})
    with pytest.raises(validate.ContractError):
        execution.operations(plan.withColumn("classification", F.lit("CONFLICT")), store, "id")


def test_contracts_of_frames_and_arguments(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    assert validate.require_columns(df, ["id", "v"]) is df and validate.require_columns(df, ["v"], exact=False) is df
    validate.require_same_ids(df, df.where("true"), "id")
    upsert.create_only(df, df.where("id = 'x'"), "id")
    for bad in (lambda: validate.require_columns(df, ["v", "id"]), lambda: validate.require_same_ids(df, df.limit(1), "id"), lambda: upsert.create_only(df, df, "id"), lambda: evidence.require_month("2024-13"), lambda: evidence.require_sha("a"), lambda: evidence.require_scope("live", "dev", ["live"]), lambda: evidence.require_scope("x", "x", ["live"])):
        with pytest.raises(validate.ContractError):
            bad()
    assert evidence.require_month("2024-12") and evidence.require_sha("a" * 64) and evidence.require_scope("dev", "dev", ["dev"])
    patches = df.withColumn("updates", F.create_map(F.lit("months.2024-01"), F.lit("1")))
    validate.require_paths(patches, "updates", ["months"])
    with pytest.raises(validate.ContractError):
        validate.require_paths(patches, "updates", ["adr"])
    with pytest.raises(validate.ContractError, match="2024-05"):
        delimited.require_complete(spark.createDataFrame([("2024-05", 2)], "ym string, files int"))
    path = f"file://{tmp_path}/facts"
    sinks.write_partitioned(df.withColumn("ym", F.lit("2024-01")), path)
    assert spark.read.parquet(path).where("ym = '2024-01'").count() == 2 and (tmp_path / "facts" / "ym=2024-01").exists()
    evidence.require_chain(evidence.manifest("a", df).unionByName(evidence.manifest("b", df, evidence.manifest("a", df))), ["a", "b"])
    with pytest.raises(validate.ContractError):
        evidence.require_chain(evidence.manifest("a", df), ["a", "b"])
    nested = df.select(F.col("id").alias("masterId"), F.col("id").alias("meterNoRaw"), F.lit("LM").alias("lmPcode"), F.lit("water").alias("meterType"), F.lit("C").alias("customerNo"), F.lit(None).cast("string").alias("accountNo"), F.lit("").alias("salesId"))
    told = nested.select(records.master_document("conlog").alias("d")).where("d.meterNo.raw = 'a'").first()["d"].asDict(True)
    assert told == {"lmPcode": "LM", "meterNo": {"raw": "a", "normalized": "a"}, "meterType": "water", "customerNo": "C", "accountNo": "", "refs": {"asts": {"id": ""}, "sales": {"id": "", "provider": ""}}}


def test_headers_of_supplier_sheets():
    text = list(records.HEADERS)
    assert records.layout_errors([*text, 45292, 45323, None, 45292, 45323]) == []
    assert records.layout_errors([*text[1:], "x", 45292, None, 45292]) == ["TEXT_HEADERS_DIFFER"]
    assert records.layout_errors([*text, 45292, 45323]) == ["NO_SPACER"]
    assert records.layout_errors([*text, 45292, 45323, None, 45292]) == ["BLOCKS_DIFFER"]
    assert records.layout_errors([*text, 45292, 45383, None, 45292, 45383]) == ["MONTHS_NOT_CONTIGUOUS"]
    assert records.layout_errors([*text, "x", None, "x"]) == ["NOT_A_MONTH"]
    with pytest.raises(validate.ContractError):
        records.require_layout(text)


def test_waves_and_numbers(spark):
    df = spark.range(10_216).select(F.format_string("M%05d", "id").alias("id"))
    sizes = {r["wave"]: r["count"] for r in numbering.waves(df, "id").groupBy("wave").count().collect()}
    assert sizes == {i: 400 for i in range(1, 26)} | {26: 216}
    assert numbering.global_row_number(df.limit(0), "id").count() == 0
    odd = df.unionByName(spark.range(30).select(F.lit(None).cast("string").alias("id"))).unionByName(df.limit(5)).repartition(7)
    found = numbering.global_row_number(odd, "id", rows=500).orderBy("rn").collect()
    assert [r["rn"] for r in found] == list(range(1, len(found) + 1))
    assert [r["id"] or "" for r in found] == sorted(r["id"] or "" for r in found)


def test_snapshots(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "meterNo string")
    found = {r[0]: r[1] for r in population.snapshot_delta(ids("a", "b", "c"), ids("a", "b"), ids("b", "c", "d")).collect()}
    assert found == {"a": "missing", "b": "unchanged", "c": "known_addition", "d": "created"}
    with pytest.raises(validate.ContractError):
        population.require_subset(ids("z"), ids("a"))
    with pytest.raises(validate.ContractError):
        population.require_one_to_one(spark.createDataFrame([("a", "x"), ("a", "y")], "predecessor string, successor string"))
    with pytest.raises(validate.ContractError):
        wide.require_known(ids("q"), ids("a"))


def test_rollups_agree_on_random_purchases(spark):
    rows = spark.range(3000).select(F.concat(F.lit("L"), (F.rand(1) * 3).cast("int")).alias("lmPcode"), F.concat(F.lit("M"), (F.rand(2) * 50).cast("int")).alias("meterNo"), F.concat(F.lit("2026-0"), (1 + F.rand(3) * 4).cast("int")).alias("ym"), (F.rand(4) * 30000).cast("bigint").alias("costC"), (F.rand(5) * 900).cast("bigint").alias("vatC"), F.col("id").alias("txAtMs"))
    rows = rows.withColumn("amountTotalC", F.col("costC") + F.col("vatC")).cache()
    monthly = aggregates.monthly_meters(rows)
    reconcile.require_equal_rollups(monthly, aggregates.monthly_municipalities(rows), aggregates.monthly_groups(monthly))
    with pytest.raises(validate.ContractError):
        reconcile.require_equal_rollups(monthly, aggregates.monthly_municipalities(rows.where("txAtMs > 5")), aggregates.monthly_groups(monthly))
    assert reconcile.digest(rows, rows.columns).first() == reconcile.digest(rows.repartition(7), rows.columns).first()


def test_csv_sources(spark, tmp_path):
    path = tmp_path / "sales__LM1__2026-06__2.csv"
    path.write_bytes("﻿A  x,B\n1,NA\n\"a, b\",é\n".encode())
    df = delimited.read_csv(spark, str(path), row_number="sourceRow")
    assert [tuple(r) for r in df.orderBy("sourceRow").collect()] == [("1", None, 1), ("a, b", "é", 2)] and df.columns[0] == "A x"
    latin = tmp_path / "latin.csv"
    latin.write_bytes("A\né\n".encode("latin-1"))
    assert delimited.read_csv(spark, str(latin)).first()[0] == "é"
    with pytest.raises(validate.ContractError):
        delimited.read_csv(spark, str(latin), ["B"])
    months = delimited.discover_months(spark, str(tmp_path), "2026-05", "2026-06")
    assert {r["ym"]: r["files"] for r in months.collect()} == {"2026-05": 0, "2026-06": 1}
    before = delimited.file_digests(spark, str(path))
    assert len(before.first()["sha256"]) == 64
    before = spark.createDataFrame(before.collect(), before.schema)
    delimited.require_unchanged(spark, str(path), before)
    broken = tmp_path / "broken.csv"
    broken.write_text('A,B\n1,"two\nlines"\n3,4\n')
    assert delimited.has_broken_lines(spark, str(broken)) and not delimited.has_broken_lines(spark, str(path))
    assert [tuple(r) for r in delimited.read_csv(spark, str(broken), row_number="n").orderBy("n").collect()] == [("1", "two\nlines", 1), ("3", "4", 2)]
    digests, rows = delimited.snapshot(spark, str(broken))
    path.write_text("other")
    with pytest.raises(validate.ContractError, match="changed"):
        delimited.require_unchanged(spark, str(path), before)
    assert digests.first()["sha256"] == hashlib.sha256(broken.read_bytes()).hexdigest()
    assert [r["record"] for r in rows.orderBy("row").collect()] == [["A", "B"], ["1", "two\nlines"], ["3", "4"]]


def test_rows_of_a_file_in_many_tasks_keep_their_numbers(spark, tmp_path):
    path = tmp_path / "many.csv"
    path.write_text("A,B\n" + "".join(f"{i},x{i}\n" for i in range(1, 40_001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = delimited.read_csv(spark, str(path), row_number="n")
        assert df.where("cast(A as bigint) <> n").count() == 0 and df.count() == 40_000
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a":1}\n\n[2]\n{"a":')
    good, bad = delimited.split_json_lines(spark, str(path), "a int")
    assert [r["a"] for r in good.collect()] == [1] and sorted(r["code"] for r in bad.collect()) == ["INVALID_JSON", "NOT_AN_OBJECT"]
    assert sorted((r["line"], r["code"]) for r in bad.collect()) == [(3, "NOT_AN_OBJECT"), (4, "INVALID_JSON")]
    with pytest.raises(Exception, match="line 2: blank line"):
        delimited.read_json_lines(spark, str(path), "a int").collect()
    path.write_text('{"a":1}\n\n{"a":2}\n')
    assert delimited.read_json_lines(spark, str(path), "a int", "lenient").count() == 2


def make_workbook(path, rows):
    letters = "ABCDEFGH"
    cell = lambda r, c, v: f'<c r="{letters[c]}{r}"' + (f' t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f"><v>{v}</v></c>")
    body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows, 1))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="END" sheetId="1" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        book.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')


def test_workbooks(spark, tmp_path):
    path = str(tmp_path / "b.xlsx")
    make_workbook(path, [["MeterNumber", 45292, 45323, None, 45292, 45323], ["007", 10.5, 0, None, 1.5, 0], ["008", None, 3, None, None, 0.5]])
    cells = workbook.read_workbooks(spark, path, "END")
    found = {r["MeterNumber"]: r for r in workbook.records(cells, {"MeterNumber": 1}).collect()}
    assert found["007"]["monthlySalesC"] == {"2024-01": 1050, "2024-02": 0} and found["008"]["monthlyUnits"] == {"2024-02": Decimal("0.5")}
    spark.dataSource.register(workbook.WorkbookSource)
    assert spark.read.format("workbook").option("columns", "A").load(path).count() == 3


def test_sheets_keep_their_contract(spark, tmp_path):
    path, text = str(tmp_path / "s.xlsx"), ["A", "B"]
    make_workbook(path, [[*text, 45292, 45323, None, 45292, 45323], ["007", "x", 10.5, 0, None, 1.5, 0]])
    cells = workbook.read_workbooks(spark, path, "END")
    assert [c["number"] if c and c["text"] is None else c and c["text"] for c in workbook.headers(cells).first()["header"]] == ["A", "B", 45292.0, 45323.0, None, 45292.0, 45323.0]
    assert workbook.require_layout(cells, lambda h: records.layout_errors(h, text)) is cells
    with pytest.raises(validate.ContractError, match="TEXT_HEADERS_DIFFER"):
        workbook.require_layout(cells, records.layout_errors)
    path = str(tmp_path / "c.xlsx")
    make_workbook(path, [["MeterNumber", "August_2026_Category", "Risk_Tier", "Risk_Score", "CorrectedMeterNumber"], ["007", "CAT1 x", "HIGH", 3, None], [" 8 ", "NORMAL", "LOW", 0, "0 8"]])
    cells = workbook.read_workbooks(spark, path, "END")
    found = workbook.categories(cells, "August_2026").orderBy("row").collect()
    assert [(r["meterNo"], r["value"]["leakageCategory"], r["value"]["riskScore"]) for r in found] == [("007", "CAT1 x", 3), ("08", "NORMAL", 0)]
    with pytest.raises(validate.ContractError, match="MISSING_July_2026_Category"):
        workbook.categories(cells, "July_2026")


def test_guarded_writes_and_publishing(spark, tmp_path, monkeypatch):
    df, other = spark.range(5), spark.range(6)
    path = f"file://{tmp_path}/t"
    assert [sinks.guarded_write(df, path), sinks.guarded_write(df.repartition(3), path)] == ["MISSING", "IDENTICAL"]
    with pytest.raises(validate.ContractError):
        sinks.guarded_write(other, path)
    assert sinks.read_table(spark, path).count() == 5
    with monkeypatch.context() as broken:  # a crash before the last step loses nothing
        broken.setattr(sinks, "move", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.guarded_write(other, path, replace=True)
    assert sinks.read_table(spark, path).count() == 5
    assert sinks.guarded_write(other, path, replace=True, evidence={"month": "2024-01"}) == "DIFFERENT" and sinks.read_table(spark, path).count() == 6
    assert sinks.pointer(spark, f"{path}/_entries")[1]["month"] == "2024-01"
    folder = f"file://{tmp_path}/pub"
    first = sinks.publish({"t": df}, folder, None)
    assert sinks.publish({"t": other}, folder, first) != first
    with pytest.raises(validate.ContractError):
        sinks.publish({"t": df}, folder, first)
    seen = sinks.pointer(spark, f"{folder}/current")
    with monkeypatch.context() as late:  # two publishers have seen the same pointer: the second fails
        late.setattr(sinks, "pointer", lambda s, f, real=sinks.pointer: (seen[0] - 1, {"version": first}) if f.endswith("/current") else real(s, f))
        with pytest.raises(validate.ContractError, match="another writer"):
            sinks.publish({"t": df}, folder, first)
    assert sinks.pointer(spark, f"{folder}/current") == seen


def test_verified_csv_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", text\nof lines', ["x"]), (2, None, []), (3, "", None)], "a int, b string, c array<string>")
    path = f"file://{tmp_path}/out"
    assert sinks.write_verified_csv(df, path)
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).where("a = 1").first()["b"] == 'a "quoted", text\nof lines'
    with pytest.raises(validate.ContractError, match="there already"):
        sinks.write_verified_csv(df, path)
    assert sinks.write_rejections(df.withColumn("rejectReason", F.lit("r")).limit(0), f"file://{tmp_path}/none") == 0 and not (tmp_path / "none").exists()
    assert sinks.write_rejections(df.withColumn("rejectReason", F.lit("r")), f"file://{tmp_path}/bad") == 3
    told = {r["output"]: r["rows"] for r in sinks.run_summary({"x": df, "y": df.limit(1)}, month="2024-01").collect()}
    assert told == {"x": 3, "y": 1}
    sinks.write_json_lines(df, f"file://{tmp_path}/lines")
    assert delimited.read_json_lines(spark, f"{tmp_path}/lines", "a int, b string, c array<string>").orderBy("a").collect() == df.orderBy("a").collect()
    (tmp_path / "m.json").write_text('{"rows": 3}')
    manifests = delimited.read_manifest(spark, f"{tmp_path}/m.json")
    ok = manifests.select("path", "sha256")
    assert delimited.verified(manifests, ok).count() == 1
    with pytest.raises(validate.ContractError, match="evidence"):
        delimited.verified(manifests, ok.withColumn("sha256", F.lit("0")))


def test_stream_windows(spark, tmp_path):
    rows = spark.sql("select timestamp'2024-01-01 00:10:00' as ts, 'a' as event_type, 1.5D as value union all select timestamp'2024-01-01 00:20:00', 'a', 2.0D")
    rows.write.parquet(str(tmp_path / "in"))
    held = []
    stream = windows.tumbling(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), late="1 hour")
    query = stream.writeStream.outputMode("complete").foreachBatch(lambda df, _: held.extend(df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [tuple(r) for r in held][-1] == ("2024-01-01T00:00:00", "a", 2, 350)


def test_stream_batches_are_written_once(spark, tmp_path):
    spark.createDataFrame([("a", "2024-01"), ("b", "2024-03")], "meterNo string, ym string").write.parquet(str(tmp_path / "in"))
    held = {}
    for _ in range(2):  # a second run finds nothing new
        stream = spark.readStream.schema("meterNo string, ym string").parquet(str(tmp_path / "in"))
        query = windows.append_batches(stream, str(tmp_path / "cp"), lambda df, i: held.setdefault(i, windows.split_closed(df, "2024-02")[0].collect()))
        query.awaitTermination(120)
    assert [[r["meterNo"] for r in rows] for rows in held.values()] == [["b"]]


def test_links_keep_every_meter(spark):
    meters = spark.createDataFrame([("1", "A"), ("2", ""), ("3", "Z"), ("4", "B")], "meterNo string, accountNo string")
    bridge = spark.createDataFrame([("A", "K1"), ("A", "K1"), ("B", "K1"), ("B", "K2"), ("", "K1")], "accountNo string, gisKey string")
    lookup = spark.createDataFrame([("K10", "E1")], "gisKey string, erfId string")
    found = {r["meterNo"]: (r["erfId"], r["detailStatus"], r["rule"]) for r in linkage.link_meters(meters, bridge, lookup).collect()}
    assert found == {"1": ("E1", "EXACT_ONE_TO_ONE", "APPEND_ONE_TRAILING_ZERO"), "2": (None, "BLANK_ACCOUNT", "NONE"), "3": (None, "ACCOUNT_NOT_IN_BRIDGE", "NONE"), "4": (None, "ACCOUNT_MULTIPLE_GIS_KEYS", "NONE")}
