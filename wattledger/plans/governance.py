"""Queries on documents, plans in waves, workbook baselines, and the evidence that runs rest on. States are built from the data so that each rule is broken by some rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattledger import pipelines
from wattledger.functions import maps as M
from wattledger.functions import scalars as S
from wattledger.functions.numbering import global_row_number, waves
from wattledger.operators import aggregates, documents, evidence, execution, reconcile, records, upsert, validate, wide
from wattledger.operators.address import address_valid
from wattledger.plans.changes import _STORE, BEFORE, CUT, _documents, _plan
from wattledger.plans.registry import query
from wattledger.plans.tables import FACTS, METERS, MONTHLY, PROVIDER, meters, purchases, table
from wattledger.scratch import keep, spread
from wattledger.streaming import windows


def _n() -> Column:
    """A meter's number, by which faults are dealt."""
    return F.col("c_custkey")


def _ids(spark: SparkSession, folder: str, key: str = "masterId") -> DataFrame:
    return spread(meters(spark, folder).withColumnRenamed("meterNo", key))


def _fault(cases: dict[int, Column | str], otherwise: Column | str, by: int = 40) -> Column:
    """A value by the meter's number, so that every fault occurs."""
    put = lambda v: F.lit(v) if isinstance(v, str) else v
    out = put(otherwise)
    for n, value in cases.items():
        out = F.when(_n() % by == n, put(value)).otherwise(out)
    return out


def _sql_fault(cases: dict[int, str], otherwise: str, by: int = 40, column: str = "c_custkey") -> str:
    return "case " + " ".join(f"when {column} % {by} = {n} then {v}" for n, v in cases.items()) + f" else {otherwise} end"


# plans in waves: some documents have moved since the plan was made
_SIZE = 50
_MOVED = 331
_OPS = f"""{_STORE}, p as (select meter, state, case when state = 'CREATED' then null else old_last end as token from plan where state <> 'CONFLICT'),
w as (select *, cast((row_number() over (order by meter) + {_SIZE - 1}) // {_SIZE} as bigint) as wave from p), ops as (select meter, state, wave, state = 'UPDATED' and cast(meter as bigint) % {_MOVED} = {_MOVED - 1} as failed from w where state in ('CREATED', 'UPDATED'))"""


def _wave_plan(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    sides = _documents(spark, folder)
    existing = sides[1].select("meterNo", "lastMonth")
    # read twice, by the gate and by the numbering
    plan = keep(_plan(spark, folder, sides).select("meterNo", "classification").where("classification <> 'CONFLICT'").join(existing.select("meterNo", F.col("lastMonth").alias("token")), "meterNo", "left"), "plan")
    moved = F.col("meterNo").cast("bigint") % _MOVED == _MOVED - 1
    return plan, existing.select("meterNo", F.when(moved, "moved").otherwise(F.col("lastMonth")).alias("token"))


@query(f"""with {_OPS}, ev as (select wave, count(*) as operations, count_if(state = 'CREATED') as created, count_if(state = 'UPDATED') as updated, min(meter) as first_id, max(meter) as last_id, sha256('["' || string_agg(meter, '","' order by meter) || '"]') as ids, count_if(failed) as changed from ops group by wave),
f as (select min(wave) filter (where changed > 0) as fw from ev)
select wave, operations, created, updated, first_id as "firstId", last_id as "lastId", ids as "idsSha256", changed, case when fw is null or wave < fw then 'COMMITTED' when wave = fw then 'FAILED' else 'NOT_ATTEMPTED' end as state from ev, f""")
def wave_execution(spark: SparkSession, folder: str) -> DataFrame:
    plan, store = _wave_plan(spark, folder)
    return execution.wave_evidence(execution.operations(plan, store, "meterNo", _SIZE), "meterNo")


@query(f"""with {_OPS}, b as (select wave, count_if(failed) as bad from ops group by wave)
select meter as "meterNo", wave, case when failed then 'CONFLICT' else 'COMMITTED' end as outcome, case when bad > 0 then 2 else 1 end as attempts from ops join b using (wave)""")
def wave_retry(spark: SparkSession, folder: str) -> DataFrame:
    plan, store = _wave_plan(spark, folder)
    return execution.retry_outcomes(plan, store, "meterNo", _SIZE)


@query(f"""with {METERS}, p as (select meter, c_custkey, cast((row_number() over (order by meter) + 19) // 20 as bigint) as wave from meters), s as (select *, case when c_custkey % 97 = 1 then 'PAIR_INCOMPLETE' when c_custkey % 89 = 1 then 'PAIR_CHANGED' else 'READY' end as state from p),
b as (select wave, count_if(state <> 'READY') as bad from s group by wave)
select meter as "masterId", wave, case when bad = 0 then 'COMMITTED' when state = 'READY' then 'ROLLED_BACK' else state end as outcome from s join b using (wave)""")
def pair_transactions(spark: SparkSession, folder: str) -> DataFrame:
    known = _ids(spark, folder)
    pairs = known.select("masterId", F.lit("t").alias("leftToken"), F.lit("t").alias("rightToken"))
    left = known.select("masterId", F.when(_n() % 89 == 1, "u").otherwise("t").alias("token"))
    return execution.apply_pairs(pairs, left, known.where(_n() % 97 != 1).select("masterId", F.lit("t").alias("token")), "masterId", 20)


@query(f"""with {METERS} select meter as "masterId", case when c_custkey % 3 = 0 then 'old' else 'new' end as source from meters""")
def seeded_store(spark: SparkSession, folder: str) -> DataFrame:
    known = _ids(spark, folder)
    return execution.seed(known.select("masterId", F.lit("new").alias("source")), known.where(_n() % 3 == 0).select("masterId", F.lit("old").alias("source")), "masterId")


@query(f"""with {METERS}, asked as (select distinct o_custkey from orders where o_orderstatus = 'F') select lpad(cast(o_custkey as varchar), 11, '0') as "masterId", m.lm as "lmPcode", m.meter is not null as found from asked left join (select * from meters where balance >= 0) m on c_custkey = o_custkey""")
def bulk_get(spark: SparkSession, folder: str) -> DataFrame:
    asked = table(spark, folder, "orders").where("o_orderstatus = 'F'").select(F.lpad(F.col("o_custkey").cast("string"), 11, "0").alias("masterId"))
    return execution.bulk_get(asked, _ids(spark, folder).where("balanceC >= 0").select("masterId", "lmPcode"), "masterId")


@query(f"""with {_STORE}, p as (select state, n.lm <> coalesce(o.lm, n.lm) as moved from plan left join old o using (meter) join new n using (meter) where plan.state <> 'CONFLICT')
select (select count(*) from old) + count_if(state = 'CREATED') as documents, count_if(state in ('CREATED', 'UPDATED')) as writes, cast(0 as bigint) as lost, cast(0 as bigint) as "unplannedCreates", count_if(state = 'UPDATED' and o.meter is not null) as "otherFieldsChanged", cast(0 as bigint) as "unplannedUpdates", cast(0 as bigint) as "residualDifferences"
from plan left join old o using (meter) where state <> 'CONFLICT'""")
def plan_rehearsal(spark: SparkSession, folder: str) -> DataFrame:
    """A plan that also stamps a field which it doesn't own: every update breaks that rule, and no other rule is broken."""
    expected, existing = _documents(spark, folder)
    flat = lambda df, stamp: df.select("meterNo", "lmPcode", "lastMonth", F.to_json(F.array_sort(F.map_entries("monthlyTotalsC"))).alias("months"), F.lit(stamp).alias("stamp"))
    return execution.rehearsal(_plan(spark, folder).where("classification <> 'CONFLICT'"), flat(expected, "b"), flat(existing, "a"), "meterNo", ["lastMonth", "months", "lmPcode"])


def _fields() -> Column:
    return F.create_map(F.lit("name"), F.col("name"), F.lit("months.1998-05"), F.lit("1"), F.lit("months.1998-06"), F.lit("2"), F.lit("adr.strNo"), _n().cast("string"), F.lit("adr"), F.lit("x"))


def _flat_entries(m: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")


@query(f"""with {METERS} select meter as "masterId", case when c_custkey % 2 = 0 then 'adr=y|months.1998-05=1|months.1998-06=3|name=' || name else 'adr=x|adr.strNo=' || c_custkey || '|months=none|name=' || name end as patched, 'months.1998-06=2|name=' || name as remaining,
  sha256('[{{"key":"months.1998-05","value":"1"}},{{"key":"months.1998-06","value":"2"}},{{"key":"name","value":"' || name || '"}}]') as preserved from meters""")
def patched_documents(spark: SparkSession, folder: str) -> DataFrame:
    patch = F.when(_n() % 2 == 0, F.create_map(F.lit("months.1998-06"), F.lit("3"), F.lit("adr"), F.lit("y"))).otherwise(F.create_map(F.lit("months"), F.lit("none")))
    gone = F.array(F.lit("adr"), F.lit("months.1998-05"))
    return _ids(spark, folder).select("masterId", _flat_entries(documents.apply_patch(_fields(), patch)).alias("patched"), _flat_entries(documents.delete_paths(_fields(), gone)).alias("remaining"), documents.preserved_digest(_fields(), ["adr"]).alias("preserved"))


@query("""select event_id, event_type as type, 'BIGINT' as kind, cast(null as varchar) as missing from events""")
def nested_values(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.parse_json(F.concat(F.lit('{"event":{"type":"'), "event_type", F.lit('","user.id":'), F.col("user_id").cast("string"), F.lit("}}")))
    rows = table(spark, folder, "events").select("event_id", doc.alias("v"))
    return rows.select("event_id", documents.value_at(F.col("v"), "event.type").alias("type"), F.regexp_extract(F.schema_of_variant(F.try_variant_get("v", "$['event']['user.id']", "variant")), "^[A-Z]+", 0).alias("kind"), documents.value_at(F.col("v"), "event.user.id").alias("missing"))


_GEO = {0: '{"a":{"geometry":{"type":"Polygon","coordinates":[[1,2]]}}}', 1: '{"list":[{"b":1,"geometry":null},{"c":{"d":{"e":{"Geometry":3}}}}]}', 2: '{"geometryType":"Polygon","a":[1,[2]]}'}
_GEO_SQL = ", ".join(f"({n}, '{p}')" for n, ps in {0: ("a.geometry", "a.geometry.coordinates"), 1: ("list[].geometry", "list[].c.d.e.Geometry")}.items() for p in ps)


def _geo(spark: SparkSession, folder: str) -> DataFrame:
    return _ids(spark, folder).select("masterId", _fault(_GEO, "no json", 4).alias("doc"))


@query(f"""with {METERS}, g as (select * from (values {_GEO_SQL}) v(n, path)) select meter as "masterId", path from meters join g on c_custkey % 4 = n""")
def geometry_paths(spark: SparkSession, folder: str) -> DataFrame:
    return documents.forbidden_paths(_geo(spark, folder), "doc", "masterId")


@query(f"""with {METERS} select meter as "masterId", {_sql_fault({0: "'{\"a\":{}}'", 1: "'{\"list\":[{\"b\":1},{\"c\":{\"d\":{\"e\":{}}}}]}'", 2: f"'{_GEO[2]}'"}, "'no json'", 4)} as doc, {_sql_fault({2: "'a[]'"}, "''", 4)} as nested from meters""")
def geometry_stripped(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without geometry, and where arrays hold arrays once it is gone."""
    clean = keep(documents.without_keys(keep(_geo(spark, folder), "given"), "doc"), "clean")
    nested = documents.nested_arrays(clean, "doc", "masterId").groupBy("masterId").agg(F.array_join(F.array_sort(F.collect_set("path")), "|").alias("nested"))
    return clean.join(nested, "masterId", "left").na.fill("", ["nested"])


# one fault for each remainder: what stands in the document, and the codes that it must give
_SALES_DOC = {
    "master": '{"id":"@","visibility":"VISIBLE"}', "meterNo": '"@"', "meterNoNormalized": '"@"', "provider": '"conlog"', "customerNo": '"C"', "accountNo": '""', "totalAmountC": "30", "monthlyTotalsC": '{"2024-01":10,"2024-02":20,"2024-03":0}',
    "lastPurchaseAtISO": '"2024-02-10T08:00:00Z"', "daysSinceLastPurchase": "5",
}
_SALES_FAULTS: dict[int, tuple[dict[str, str | None], tuple[str, ...]]] = {
    1: ({"accountNo": None, "extra": "1"}, ("ACCOUNT_NO_NOT_STRING", "ROOT_MISSING_FIELD:accountNo", "ROOT_UNEXPECTED_FIELD:extra")), 2: ({"master": '"x"'}, ("MASTER_NOT_MAP",)),
    3: ({"master": '{"visibility":"HIDDEN","z":1}'}, ("MASTER_MISSING_ID", "MASTER_UNEXPECTED_FIELD:z", "MASTER_VISIBILITY_INVALID_VALUE:HIDDEN")), 4: ({"master": '{"id":7}'}, ("MASTER_ID_NOT_STRING", "MASTER_VISIBILITY_MISSING")),
    5: ({"master": '{"id":"a-b","visibility":1}'}, ("IDENTITY_DOCUMENT_ID_VS_MASTER_ID_MISMATCH", "IDENTITY_MASTER_ID_VS_METER_NO_NORMALIZED_MISMATCH", "MASTER_ID_NOT_CANONICAL", "MASTER_VISIBILITY_NOT_STRING")),
    6: ({"meterNo": "12"}, ("METER_NO_NOT_STRING",)), 7: ({"meterNo": '""'}, ("IDENTITY_METER_NO_NORMALIZATION_MISMATCH", "METER_NO_BLANK")), 8: ({"meterNoNormalized": "1"}, ("METER_NO_NORMALIZED_NOT_STRING",)),
    9: ({"meterNoNormalized": '"x y"'}, ("IDENTITY_DOCUMENT_ID_VS_METER_NO_NORMALIZED_MISMATCH", "IDENTITY_MASTER_ID_VS_METER_NO_NORMALIZED_MISMATCH", "IDENTITY_METER_NO_NORMALIZATION_MISMATCH", "METER_NO_NORMALIZED_NOT_CANONICAL")),
    10: ({"provider": '"other"', "customerNo": "null"}, ("CUSTOMER_NO_NOT_STRING", "PROVIDER_NOT_CONLOG:other")), 11: ({"provider": "1"}, ("PROVIDER_NOT_STRING",)), 12: ({"totalAmountC": "30.5"}, ("TOTAL_AMOUNT_C_NOT_INTEGER",)),
    13: ({"totalAmountC": "-1"}, ("TOTAL_AMOUNT_C_DOES_NOT_EQUAL_MONTHLY_SUM", "TOTAL_AMOUNT_C_NEGATIVE")), 14: ({"monthlyTotalsC": "[]"}, ("MONTHLY_TOTALS_C_NOT_MAP",)), 15: ({"monthlyTotalsC": "{}", "totalAmountC": "0", "lastPurchaseAtISO": "null", "daysSinceLastPurchase": "null"}, ("MONTHLY_TOTALS_C_EMPTY",)),
    16: ({"monthlyTotalsC": '{"2024-01":10,"2024-02":20,"2024-04":0}'}, ("MONTH_RANGE_NOT_CONTIGUOUS",)), 17: ({"monthlyTotalsC": '{"2024-1":10,"2024-02":20}'}, ("MONTH_KEY_INVALID:2024-1", "MONTH_RANGE_NOT_CONTIGUOUS")),
    18: ({"monthlyTotalsC": '{"2024-01":10.5,"2024-02":20}'}, ("MONTH_VALUE_NOT_INTEGER:2024-01",)), 19: ({"monthlyTotalsC": '{"2024-01":-10,"2024-02":40}'}, ("MONTH_VALUE_NEGATIVE:2024-01",)), 20: ({"lastPurchaseAtISO": '"2024-01-10T08:00:00Z"'}, ("LAST_PURCHASE_MONTH_MISMATCH:2024-01->2024-02",)),
    21: ({"lastPurchaseAtISO": '"2024-02-10T08:00:00"'}, ("LAST_PURCHASE_AT_ISO_INVALID_OR_TIMEZONE_FREE",)), 22: ({"lastPurchaseAtISO": "1"}, ("LAST_PURCHASE_AT_ISO_INVALID_TYPE", "POSITIVE_TOTAL_LAST_PURCHASE_MISSING")),
    23: ({"daysSinceLastPurchase": '"5"'}, ("DAYS_SINCE_LAST_PURCHASE_INVALID_TYPE", "POSITIVE_TOTAL_DAYS_SINCE_MISSING")), 24: ({"daysSinceLastPurchase": "-5"}, ("DAYS_SINCE_LAST_PURCHASE_NEGATIVE",)),
    25: ({"totalAmountC": "0", "monthlyTotalsC": '{"2024-01":0}'}, ("ZERO_TOTAL_DAYS_SINCE_NOT_NULL", "ZERO_TOTAL_LAST_PURCHASE_NOT_NULL")), 26: ({"lastPurchaseAtISO": "null", "daysSinceLastPurchase": "null"}, ("POSITIVE_TOTAL_DAYS_SINCE_MISSING", "POSITIVE_TOTAL_LAST_PURCHASE_MISSING")),
}


def _filled(doc: dict[str, str | None]) -> Column:
    text = "{" + ",".join(f'"{k}":{v}' for k, v in doc.items() if v is not None) + "}"
    return F.replace(F.lit(text), F.lit("@"), F.col("masterId"))


@query(f"""with {METERS} select meter as "masterId", {_sql_fault({n: f"'{'|'.join(codes)}'" for n, (_, codes) in _SALES_FAULTS.items()}, "''")} as issues from meters""")
def sales_document_issues(spark: SparkSession, folder: str) -> DataFrame:
    doc = _fault({n: _filled(_SALES_DOC | change) for n, (change, _) in _SALES_FAULTS.items()}, _filled(_SALES_DOC))
    return documents.assess_sales(_ids(spark, folder).select("masterId", doc.alias("doc")), "doc", "masterId").select("masterId", F.array_join("issues", "|").alias("issues"))


_MASTER_DOC = {
    "lmPcode": '"LM"', "meterNo": '{"raw":"@","normalized":"@"}', "meterType": '"electricity"', "customerNo": '"C"', "accountNo": '""', "refs": '{"asts":{"id":""},"sales":{"id":"@","provider":"conlog"}}',
    "metadata": '{"createdAt":"2024-01-01T00:00:00Z","createdByUid":"u","createdByUser":"v","updatedAt":"2024-01-02T00:00:00Z","updatedByUid":"u","updatedByUser":"v"}',
}
_STORED_FAULTS: dict[int, tuple[dict[str, str | None], str]] = {
    1: ({"meterType": None}, "MM_CANONICAL_FIELD_MISSING"), 2: ({"extra": "1"}, "MM_DOCUMENT_SHAPE_UNSAFE"), 3: ({"meterNo": '"@"'}, "MM_DOCUMENT_SHAPE_UNSAFE"), 4: ({"meterNo": '{"raw":"@"}'}, "MM_CANONICAL_FIELD_MISSING"), 5: ({"refs": '{"asts":{"id":7},"sales":{"id":"","provider":""}}'}, "MM_AST_REFERENCE_CONFLICT"),
    6: ({"customerNo": "7"}, "MM_GOVERNED_FIELD_TYPE_INVALID"), 7: ({"metadata": _MASTER_DOC["metadata"].replace("2024-01-01T00:00:00Z", "yesterday")}, "MM_GOVERNED_FIELD_TYPE_INVALID"), 8: ({"metadata": _MASTER_DOC["metadata"].replace('"createdByUid":"u"', '"createdByUid":" "')}, "MM_CREATED_METADATA_INVALID"),
    9: ({"meterNo": '{"raw":"@","normalized":"X"}'}, "MM_NORMALIZED_IDENTITY_CONFLICT"), 10: ({"meterNo": '{"raw":" ","normalized":"@"}'}, "MM_CANONICAL_FIELD_MISSING"), 11: ({"meterNo": '{"raw":"X","normalized":"@"}'}, "MM_RAW_IDENTITY_CONFLICT"), 12: ({"lmPcode": '"OTHER"'}, "MM_LM_CONFLICT"),
    13: ({"meterType": '"water"'}, "MM_METER_TYPE_CONFLICT"), 14: ({"refs": '{"asts":{"id":""},"sales":{"id":"X","provider":"conlog"}}'}, "MM_SALES_REFERENCE_CONFLICT"), 15: ({"refs": '{"asts":{"id":""},"sales":{"id":"@","provider":"other"}}'}, "MM_SALES_PROVIDER_CONFLICT"),
    16: ({"refs": '{"asts":{"id":""},"sales":{"id":"@","provider":""}}'}, "MM_SALES_REFERENCE_PAIR_CONFLICT"), 17: ({"customerNo": '"OLD"'}, "MM_SALES_FIELDS_UPDATED"), 18: ({"refs": '{"asts":{"id":""},"sales":{"id":"","provider":""}}'}, "MM_SALES_FIELDS_UPDATED"),
}


@query(f"""with {METERS} select meter as "masterId", {_sql_fault({n: f"'{code}'" for n, (_, code) in _STORED_FAULTS.items()} | {19: "'MM_MISSING'"}, "'MM_VALUES_UNCHANGED'")} as code from meters""")
def stored_master_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming master rows against stored documents as JSON, each with one fault."""
    doc = _fault({n: _filled(_MASTER_DOC | change) for n, (change, _) in _STORED_FAULTS.items()}, _filled(_MASTER_DOC))
    known = _ids(spark, folder)
    stored = documents.unfold_masters(known.where(_n() % 40 != 19).select("masterId", doc.alias("doc")), "doc")
    incoming = known.select("masterId", F.col("masterId").alias("meterNoRaw"), F.lit("LM").alias("lmPcode"), F.lit("electricity").alias("meterType"), F.lit("C").alias("customerNo"), F.lit("").alias("accountNo"), F.col("masterId").alias("salesId"), F.lit("conlog").alias("salesProvider"))
    return upsert.refresh_masters(incoming, stored).select("masterId", "code")


_OLD_FAULTS: dict[int, tuple[dict[str, str | None], str, str]] = {
    1: ({"meterNo": '"@"', "refs": None, "astId": '"A1"', "salesId": '"@"', "salesProvider": '"CONLOG"'}, "UPDATED", ""), 2: ({"lmPcode": None, "parents": '{"lmPcode":"lm"}'}, "UPDATED", ""), 3: ({"parents": '{"lmPcode":"XX"}'}, "CONFLICT", "MM_LM_CONFLICT"),
    4: ({"lmPcode": '""'}, "CONFLICT", "MM_CANONICAL_FIELD_MISSING"), 5: ({"type": '"water"'}, "CONFLICT", "MM_METER_TYPE_CONFLICT"), 6: ({"customerNo": '{"x":1}'}, "CONFLICT", "MM_GOVERNED_FIELD_TYPE_INVALID"), 7: ({"meterNo": "[1]"}, "CONFLICT", "MM_DOCUMENT_SHAPE_UNSAFE"), 8: ({"astId": '"B"', "refs": '{"asts":{"id":"A"},"sales":{"id":"","provider":""}}'}, "CONFLICT", "MM_AST_REFERENCE_CONFLICT"),
    9: ({"salesId": '"OTHER"'}, "CONFLICT", "MM_SALES_REFERENCE_CONFLICT"), 10: ({"refs": '{"asts":{"id":""},"sales":{"id":"","provider":"conlog"}}'}, "CONFLICT", "MM_SALES_PROVIDER_CONFLICT"), 11: ({"meterNo": '{"raw":"77","normalized":"@"}'}, "CONFLICT", "MM_NORMALIZED_IDENTITY_CONFLICT"),
    12: ({"metadata": '{"createdByUid":"u"}'}, "CONFLICT", "MM_CREATED_METADATA_INVALID"), 13: ({"lmPcode": '"A"', "parents": '{"lmPcode":"B"}', "meterType": '"gas"'}, "CONFLICT", "MM_CANONICAL_FIELD_MISSING|MM_LM_CONFLICT"), 14: ({"legacy": "true"}, "UPDATED", ""),
}


def _as_sql(doc: dict[str, str]) -> str:
    return "'" + ",".join(f'"{k}":{v}' for k, v in doc.items()) + "'"


@query(f"""with {METERS} select meter as "masterId", {_sql_fault({n: f"'{s}'" for n, (_, s, _) in _OLD_FAULTS.items()}, "'UNCHANGED'")} as classification, {_sql_fault({n: f"'{c}'" for n, (_, _, c) in _OLD_FAULTS.items()}, "''")} as conflicts,
  case when {_sql_fault({n: f"'{s}'" for n, (_, s, _) in _OLD_FAULTS.items()}, "'UNCHANGED'")} <> 'CONFLICT' then replace('{{' || {_sql_fault({1: _as_sql(_MASTER_DOC | {"refs": '{"asts":{"id":"A1"},"sales":{"id":"@","provider":"conlog"}}'}), 2: _as_sql(_MASTER_DOC | {"lmPcode": '"LM"'})}, _as_sql(_MASTER_DOC))} || '}}', '@', meter) end as canonical from meters""")
def canonical_masters(spark: SparkSession, folder: str) -> DataFrame:
    """Old master documents to canonical ones, or why they can't be brought there."""
    doc = _fault({n: _filled(_MASTER_DOC | change) for n, (change, _, _) in _OLD_FAULTS.items()}, _filled(_MASTER_DOC))
    return documents.migration_plan(_ids(spark, folder).select("masterId", doc.alias("doc")), "doc").select("masterId", "classification", F.array_join("conflicts", "|").alias("conflicts"), "canonical")


_PSD = {
    1: "SEVERAL_CANDIDATES|GPS_WITHOUT_ONE_CANDIDATE", 2: "CANDIDATE_COUNT_MISMATCH", 3: "CANDIDATE_WITHOUT_GPS", 4: "GPS_STATUS_NOT_SINGLE", 5: "WRONG_MUNICIPALITY", 6: "BLANK_ERF_ID", 7: "BLANK_WARD", 8: "INVALID_COORDINATES", 9: "SALES_OR_UNITS_MISSING", 10: "BATCH_IDS_NOT_A_LIST", 11: "BLANK_METER_NUMBER",
    12: "CANDIDATES_NOT_A_LIST|CANDIDATE_COUNT_MISMATCH|GPS_WITHOUT_ONE_CANDIDATE",
}


def _psd(spark: SparkSession, folder: str) -> DataFrame:
    text = lambda n, bad, good: F.when(_n() % 40 == n, bad).otherwise(good)
    one = F.struct(text(6, "", F.col("name")).alias("ErfId"), text(5, "OTHER", "lm").alias("LmPcode"), text(7, "", "3").alias("WardNumber"), F.lit("W").alias("WardPcode"), text(8, F.lit(91.0), F.lit(1.5)).alias("Latitude"), F.lit(2.5).alias("Longitude"))
    listed = F.when(_n() % 40 == 12, None).when(_n() % 40 == 1, F.array(one, one)).otherwise(F.array(one))
    none = F.create_map(F.lit("2024-01"), F.lit(1))
    return _ids(spark, folder).select(
        text(11, " ", F.col("masterId")).alias("MeterNumber"), listed.alias("ErfCandidates"), F.when(_n() % 40 == 1, 2).when(_n() % 40 == 2, 5).otherwise(1).alias("ErfCandidateCount"), (_n() % 40 != 3).alias("HasUsableGps"), text(4, "NO", "MATCHED_SINGLE_GPS").alias("GpsMatchStatus"),
        F.when(_n() % 40 != 9, none).alias("Sales"), none.alias("Units"), F.when(_n() % 40 != 10, F.array(F.lit("b"))).alias("trnBatchIds"), "masterId",
    )


@query(f"""with {METERS} select meter as "masterId", {_sql_fault({n: f"'{c}'" for n, c in _PSD.items()}, "''")} as issues from meters""")
def psd_validation(spark: SparkSession, folder: str) -> DataFrame:
    return _psd(spark, folder).select("masterId", F.array_join(validate.reasons(documents.psd_rules("LM")), "|").alias("issues"))


@query(f"""with {METERS}, p as (select * from meters where c_custkey % 40 not in (11, 12)), two as (select meter, name, 1 as place, c_custkey from p union all select meter, name, 2, c_custkey from p where c_custkey % 40 = 1)
select 'candidates' as output, meter as "MeterNumber", place, case when c_custkey % 40 = 6 then '' else name end as detail from two union all select 'unmatched', meter, 0, 'MATCHED_SINGLE_GPS' from p where c_custkey % 40 = 3""")
def psd_outputs(spark: SparkSession, folder: str) -> DataFrame:
    out = documents.psd_outputs(_psd(spark, folder).where(~(_number_of("masterId") % 40).isin(11, 12)))
    found = out["candidates"].select(F.lit("candidates").alias("output"), "MeterNumber", "place", F.col("ErfId").alias("detail"))
    return found.unionByName(out["unmatched"].select(F.lit("unmatched").alias("output"), "MeterNumber", F.lit(0).alias("place"), F.col("GpsMatchStatus").alias("detail")))


def _number_of(key: str) -> Column:
    return F.col(key).cast("bigint")


# the workbook to the baseline
_MONTHS_SQL = {"b": "'2024-01=10|2024-02=20'", "u": "'2024-01=10|2024-02=20|2024-03=30'"}


def _month_map(kind: str, **values: Column | int) -> Column:
    return F.create_map(*(x for k, v in values.items() for x in (F.lit(k[1:].replace("_", "-")), F.lit(v).cast(kind) if isinstance(v, int) else v.cast(kind))))


def _books(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    known = meters(spark, folder).withColumn("sourceRow", _n())
    units = "decimal(18,1)"
    odd = F.when(_n() % 10 == 3, _month_map(units, m2024_01=1)).otherwise(_month_map(units, m2024_01=1, m2024_02=2))
    baseline = known.where(_n() % 10 != 9).select("meterNo", _month_map("bigint", m2024_01=10, m2024_02=20).alias("monthlySalesC"), odd.alias("monthlyUnits"), F.lit("2024-02").alias("salesPeriodTo"), "sourceRow")
    late = F.when(_n() % 10 == 1, 21).otherwise(20)
    sales = F.when(_n() % 10 == 2, _month_map("bigint", m2024_01=10, m2024_02=20)).otherwise(_month_map("bigint", m2024_01=10, m2024_02=late, m2024_03=30, m2024_04=40))
    workbook = known.select(
        "meterNo", F.col("meterNo").alias("MeterNumber"), *(F.lit(f" {h.lower()} ").alias(h) for h in records.HEADERS if h != "MeterNumber"), "sourceRow", sales.alias("monthlySalesC"),
        F.when(_n() % 10 == 2, _month_map(units, m2024_01=1, m2024_02=2)).otherwise(_month_map(units, m2024_01=1, m2024_02=2, m2024_03=3, m2024_04=4)).alias("monthlyUnits"),
    )
    return baseline, workbook


@query(f"""with {METERS} select meter as "meterNo", {_sql_fault({1: "'CONFLICT'", 2: "'UNCHANGED'", 3: "'CONFLICT'"}, "'UPDATED'", 10)} as state, {_sql_fault({1: "'2024-02'", 3: "'sales and units'"}, "''", 10)} as conflicts, {_sql_fault({1: "0", 2: "0", 3: "0"}, "1", 10)} as added,
  cast({_sql_fault({1: "30", 2: "30", 3: "30"}, "60", 10)} as bigint) as "totalSalesC", {_sql_fault({1: "'2024-02'", 2: "'2024-02'", 3: "'2024-02'"}, "'2024-03'", 10)} as "salesPeriodTo", {_sql_fault({n: _MONTHS_SQL["b"] for n in (1, 2, 3)}, _MONTHS_SQL["u"], 10)} as months from meters where c_custkey % 10 <> 9""")
def baseline_extension(spark: SparkSession, folder: str) -> DataFrame:
    found = records.extend_baseline(*_books(spark, folder), "2024-03")
    return found.select("meterNo", "state", F.array_join("conflicts", "|").alias("conflicts"), "added", "totalSalesC", "salesPeriodTo", _flat_entries(F.transform_values("monthlySalesC", lambda k, v: v.cast("string"))).alias("months"))


@query(f"""with {METERS} select meter as "meterNo", 'accountnumber' as "accountNo", 'surname' as "customerName", 'standnumber' as "standNumber", '' as "riskTier", '2024-01' as "salesPeriodFrom", '2024-03' as "salesPeriodTo", cast(60 as bigint) as "totalSalesC", cast(6 as decimal(28,1)) as "totalUnits", false as "hasUsableGps", 43 as fields
from meters where c_custkey % 10 = 9""")
def new_baseline_records(spark: SparkSession, folder: str) -> DataFrame:
    baseline, workbook = _books(spark, folder)
    made = records.new_records(workbook.join(baseline.select("meterNo"), "meterNo", "left_anti"), "LM", PROVIDER, "2024-03", "book.xlsx")
    return made.select("meterNo", "accountNo", "customerName", "standNumber", "riskTier", "salesPeriodFrom", "salesPeriodTo", "totalSalesC", "totalUnits", "hasUsableGps", F.lit(len(made.columns)).alias("fields"))


@query(f"""with {METERS} select meter as "meterNo", c_custkey % 10 = 9 as "isNew", row_number() over (order by c_custkey % 10 = 9, case when c_custkey % 10 = 9 then c_custkey end, meter) as place from meters""")
def baseline_order(spark: SparkSession, folder: str) -> DataFrame:
    """The places of the sorted output are numbered here only to be compared."""
    baseline, workbook = _books(spark, folder)
    ordered = records.output_order(workbook.select("meterNo", "sourceRow"), baseline)
    key = F.concat(F.when(F.col("isNew"), "1").otherwise("0"), F.when(F.col("isNew"), F.lpad(F.col("sourceRow").cast("string"), 12, "0")).otherwise(""), "meterNo")
    return global_row_number(ordered.withColumn("_key", key), "_key", "place").select("meterNo", "isNew", "place")


@query(f"""with {METERS} select meter as "meterNo", ' addressline1 ' as "addressLine1", ' addressline2 ' as "addressLine2", ' town ' as town, ' postaladdress1 ' as "postalAddress1", ' postaladdress2 ' as "postalAddress2", ' postaladdresstown ' as "postalAddressTown", ' standnumber ' as "standNumber" from meters""")
def raw_addresses(spark: SparkSession, folder: str) -> DataFrame:
    _, workbook = _books(spark, folder)
    return records.raw_address(workbook.withColumnsRenamed({f[0].upper() + f[1:]: f for f in records.ADDRESS_FIELDS}), "meterNo")


@query(f"""with {FACTS}, k as (select distinct meter from facts where ym < '{CUT}'), p as (select distinct meter from facts where ym = '{BEFORE}'), c as (select distinct meter from facts where ym = '{CUT}'), rep as (select meter as a, lpad(cast(cast(meter as bigint) + 1 as varchar), 11, '0') as b from p where meter not in (select meter from c)),
ids as (select meter from k union select meter from p union select meter from c), f as (select meter, meter in (select meter from k) as k, meter in (select meter from p) as p, meter in (select meter from c) as c, meter in (select a from rep) as r, meter in (select b from rep) as s from ids),
n as (select count_if(k) as cumulative, count_if(p) as previous, count_if(c) as current, count_if(p and c) as unchanged, count_if(c and not p) as additions, count_if(p and not c) as missing, count_if(c and not k) as creates, count_if(c and not k and s) as "replacementCreates", count_if(c and not k and not s) as "newCreates",
  count_if(p and not c and r) as replaced, count_if(p and not c and not r) as removed, count_if(k or c) as "cumulativeAfter" from f)
select *, true as "cumulativeHolds", true as "currentHolds", true as "previousHolds", true as "createsHold", true as "outgoingHolds" from n""")
def population_accounts(spark: SparkSession, folder: str) -> DataFrame:
    rows = purchases(spark, folder).select("meterNo", "ym")
    before, now = rows.where(F.col("ym") == BEFORE), rows.where(F.col("ym") == CUT)
    gone = before.join(now.select("meterNo"), "meterNo", "left_anti").select("meterNo").distinct()
    pairs = gone.select(F.col("meterNo").alias("predecessor"), F.lpad((F.col("meterNo").cast("bigint") + 1).cast("string"), 11, "0").alias("successor"))
    return records.population_accounts(rows.where(F.col("ym") < CUT), before, now, pairs)


@query(f"""with {MONTHLY}, s as (select meter, ym, case when ym = '{CUT}' then amount + 1 else amount end as amount from monthly where ym <> '{BEFORE}'), m as (select meter, ym, amount from monthly where ym <> '1998-04')
select coalesce(m.meter, s.meter) as "meterNo", coalesce(m.ym, s.ym) as ym, m.amount as "monthlyC", s.amount as "sourceC" from m full outer join s on m.meter = s.meter and m.ym = s.ym where coalesce(m.amount, 0) <> coalesce(s.amount, 0)""")
def source_differences(spark: SparkSession, folder: str) -> DataFrame:
    monthly = aggregates.monthly_meters(purchases(spark, folder))
    changed = monthly.where(F.col("ym") != BEFORE).withColumn("amountTotalC", F.when(F.col("ym") == CUT, F.col("amountTotalC") + 1).otherwise(F.col("amountTotalC")))
    source = wide.month_maps(changed).withColumnRenamed("monthlyTotalsC", "monthlySalesC")
    return records.source_differences(monthly.where("ym <> '1998-04'"), source)


@query(f"""with {MONTHLY}, r as (select *, case when balance < 0 then '' else meter end as m2, case when segment = 'BUILDING' then -amount else amount end as a2 from monthly join (select meter, balance, segment from meters) using (meter) where ym in ('{CUT}', '{BEFORE}')), c as (select m2, count(*) as n from r group by m2)
select (select count(*) from c) as meters, count(*) as rows, cast(sum(a2) as bigint) as "amountTotalC", cast(count(*) as decimal(28,1)) as "unitsTotal", (select cast(sum(n - 1) as bigint) from c) as "repeatedMeters", cast(count_if(lm <> 'NATION_1') as bigint) as "otherMunicipality", cast(count_if(ym <> '{CUT}') as bigint) as "otherMonth",
  cast(count_if(a2 < 0) as bigint) as negative, cast(count_if(m2 = '') as bigint) as "blankMeter" from r""")
def source_evidence(spark: SparkSession, folder: str) -> DataFrame:
    rows = aggregates.monthly_meters(purchases(spark, folder)).where(F.col("ym").isin(CUT, BEFORE)).join(meters(spark, folder).select("meterNo", "balanceC", "segment"), "meterNo")
    built = rows.select("lmPcode", F.when(F.col("balanceC") < 0, "").otherwise(F.col("meterNo")).alias("meterNo"), "ym", F.when(F.col("segment") == "BUILDING", -F.col("amountTotalC")).otherwise(F.col("amountTotalC")).alias("amountTotalC"), F.lit(1).cast("decimal(18,1)").alias("unitsTotal"))
    return records.source_evidence(built, CUT, "NATION_1")


@query(f"""with {FACTS} select meter as "meterNo", ym, sha256('{{"atomicId":"' || l_orderkey || '","parents":{{"lmPcode":"' || lm || '"}},"meter":{{"meterNo":"' || meter || '"}},"time":{{"txAtISO":"' || iso || '","txAtMs":' || ms || ',"ym":"' || ym || '","y":' || year(o_orderdate) || ',"m":' || month(o_orderdate) || '}},"money":{{"amountTotalC":' || amount || ',"costC":' || cost || ',"vatC":' || vat || '}}}}') as document from facts""")
def atomic_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = purchases(spark, folder).withColumn("atomicId", F.col("l_orderkey").cast("string"))
    return rows.select("meterNo", "ym", F.sha2(F.to_json(records.atomic_document(rows)), 256).alias("document"))


# evidence
@query("""select 'atomic' as stage, 'FINGERPRINT_MISMATCH' as code, cast(null as varchar) as input union all select 'wide', 'INPUT_DIGEST_MISMATCH', 'monthly' union all select 'wide', 'INPUT_UNKNOWN', 'other' union all select 'upload', 'STAGE_MISSING', null union all select 'master', 'INPUT_NOT_EARLIER', 'wide'""")
def manifest_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Manifests of three stages over the data, with one fault of each kind put in."""
    rows = purchases(spark, folder)
    atomic = evidence.manifest("atomic", rows.select("meterNo", "txAtISO", "amountTotalC"))
    monthly = evidence.manifest("monthly", aggregates.monthly_meters(rows).select("id", "amountTotalC"), atomic)
    with_other = monthly.unionByName(monthly.withColumn("stage", F.lit("other")))
    wide_ = evidence.manifest("wide", wide.month_maps(aggregates.monthly_meters(rows)).select("meterNo", "totalC"), with_other.withColumn("digest", F.concat("digest", F.lit("0"))))
    master = evidence.manifest("master", meters(spark, folder).select("meterNo", "lmPcode"), wide_)
    forged = atomic.withColumn("rows", F.col("rows") + 1)
    return evidence.chain_errors(forged.unionByName(monthly).unionByName(wide_).unionByName(master), ["atomic", "monthly", "master", "wide", "upload"])


@query(f"""with {METERS} select count(*) as ids, sha256('["' || string_agg(meter, '","' order by meter) || '"]') as sha256 from meters where balance < 0""")
def sorted_id_digest(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.sorted_id_digest(meters(spark, folder).where("balanceC < 0"), "meterNo")


@query("""select n_name as stage, case when n_nationkey % 4 = 0 then 'UNKNOWN_STAGE' when n_nationkey % 4 = 1 then 'FINGERPRINT_CHANGED' when n_nationkey % 4 = 2 then 'ALREADY_COMPLETE' else 'MAY_RESUME' end as state from nation""")
def resume_contract(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("n_nationkey")
    rows = table(spark, folder, "nation")
    report = rows.select(F.col("n_name").alias("stage"), F.when(n % 4 == 1, "old").otherwise("now").alias("fingerprint"), F.when(n % 4 == 2, "PASS").otherwise("STOPPED").alias("status"))
    return evidence.resume_allowed(report, rows.where(n % 4 != 0).select(F.col("n_name").alias("stage"), F.lit("now").alias("fingerprint")))


_GOOD = "a" * 64
_MONTH_FAULTS: dict[str, tuple[str, str]] = {  # code: the column that is changed, and what it becomes
    "MONTH_INVALID": ("month", "'1998-13'"), "SNAPSHOT_SHA_INVALID": ("snapshotSha256", "'x'"), "SOURCE_SHA_INVALID": ("sourceSha256", "'x'"), "COMPLETENESS_NOT_ATTESTED": ("complete", "false"), "REPORT_NOT_PASSED": ("status", "'FAIL'"), "PREFLIGHT_ONLY": ("preflightOnly", "true"),
    "GATE_NOT_PASSED": ("gatePassed", "false"), "REPORT_OF_ANOTHER_MONTH": ("governedMonth", "'1998-02'"), "REPORT_OF_ANOTHER_SNAPSHOT": ("populationSnapshotSha256", "'x'"), "CATEGORY_PACKAGE_MISSING": ("categoryPackageSha256", "''"), "CONFLICTS_OR_FAILURES": ("failures", "1"),
    "WRITE_IMBALANCE": ("writeAttempts", "0"), "WAVES_PARTIAL": ("wavesCommitted", "0"), "NOT_FULLY_VERIFIED": ("verified", "0"), "PRESERVATION_BROKEN": ("preservedAfter", "''"), "RECOVERY_EVIDENCE_MISSING": ("recoverySha256", "''"), "PLAN_EVIDENCE_MISSING": ("planSha256", "''"), "SCOPE_SHA_MISMATCH": ("scopeSha256", "''"),
    "MEMBERS_OUTSIDE_SCOPE": ("members", "array('ZZ')"), "MEMBERS_NOT_CANONICAL": ("members", "array('a b')"), "MEMBERS_NOT_SORTED_AND_UNIQUE": ("members", "array('B', 'A')"), "REPLACEMENT_NOT_TERMINAL": ("replacements", "array(struct('A' as predecessor, 'B' as successor))"), "CLASSIFICATION_INCOMPLETE": ("inspected", "1"), "COUNTER_INVALID": ("unchanged", "null"),
}


def _months_run(spark: SparkSession, folder: str) -> DataFrame:
    """A report for each month with purchases of 1997 and 1998 over two small scopes; all sound."""
    months = purchases(spark, folder).where("ym between '1997-01' and '1998-03'").select("ym").distinct()
    scope = F.array(F.lit("A"), F.lit("B"))
    last = months.select(F.col("ym").alias("month"), F.sha2("ym", 256).alias("snapshotSha256"), F.when(F.col("ym") > "1997-01", F.sha2(S.next_month("ym", -1), 256)).alias("previousSnapshotSha256"))
    fixed = {
        "sourceSha256": _GOOD, "complete": True, "status": "PASS", "result": "REFRESH_VERIFIED", "preflightOnly": False, "gatePassed": True, "categoryPackageSha256": _GOOD, "rowsRead": 2, "inspected": 2, "created": 1, "updated": 0, "unchanged": 1, "conflicts": 0, "failures": 0, "writeAttempts": 1, "writeSuccesses": 1,
        "wavesAttempted": 1, "wavesCommitted": 1, "verification": "PASS", "verified": 2, "preservedBefore": _GOOD, "preservedAfter": _GOOD, "recoverySha256": _GOOD, "recoveryRecords": 2, "planSha256": _GOOD, "planRecords": 2,
    }
    none = F.array().cast("array<struct<predecessor: string, successor: string>>")
    return last.select("*", F.col("month").alias("governedMonth"), F.col("snapshotSha256").alias("populationSnapshotSha256"), scope.alias("members"), scope.alias("scope"), F.sha2(F.to_json(scope), 256).alias("scopeSha256"), none.alias("replacements"), *(F.lit(v).alias(k) for k, v in fixed.items()))


_ALSO = {  # codes that a fault gives beside its own
    "MONTH_INVALID": ("REPORT_OF_ANOTHER_MONTH",), "SNAPSHOT_SHA_INVALID": ("REPORT_OF_ANOTHER_SNAPSHOT",), "MEMBERS_NOT_CANONICAL": ("MEMBERS_OUTSIDE_SCOPE",), "COUNTER_INVALID": (),
}


@query("select * from (values " + ", ".join(f"('{code}', '{'|'.join(sorted((code, *_ALSO.get(code, ()))))}')" for code in _MONTH_FAULTS) + ", ('none', '')) v(fault, issues)")
def executed_months(spark: SparkSession, folder: str) -> DataFrame:
    """One month's report, sound and with each fault."""
    sound = _months_run(spark, folder).where("month = '1997-01'")
    faults = spark.createDataFrame([(c,) for c in (*_MONTH_FAULTS, "none")], "fault string")
    rows = sound.join(F.broadcast(faults))
    by_column: dict[str, list[tuple[str, str]]] = {}
    for code, (column, value) in _MONTH_FAULTS.items():
        by_column.setdefault(column, []).append((code, value))
    for column, changes in by_column.items():
        new = F.col(column)
        for code, value in changes:
            new = F.when(F.col("fault") == code, F.expr(value)).otherwise(new)
        rows = rows.withColumn(column, new)
    return rows.select("fault", F.array_join(F.array_sort(validate.reasons(evidence.executed_month_rules())), "|").alias("issues"))


@query(f"""with {FACTS} select ym as month, sha256(ym) as "snapshotSha256", case when ym >= '1997-09' then 'BLOCKED' else 'PUBLISHED' end as state from facts where ym between '1997-01' and '1998-03' group by ym""")
def month_publication(spark: SparkSession, folder: str) -> DataFrame:
    rows = _months_run(spark, folder)
    return evidence.publication(rows.withColumn("gatePassed", F.col("month") != "1997-09"), "1997-01")


@query(f"""with {METERS}, l as (select *, c_custkey % 20 as k from meters), p as (select meter, k from l where k <> 2)
select meter as "meterNo", case k when 1 then 'NOT_A_MEMBER' when 2 then 'MEMBER_NOT_LISTED' when 3 then 'LISTED_TWICE' when 4 then 'VALUE_AND_EXCEPTION' when 5 then 'NEITHER_VALUE_NOR_EXCEPTION' when 6 then 'VALUE_INVALID' when 7 then 'NO_HISTORY' end as code from l where k between 1 and 7""")
def package_admission(spark: SparkSession, folder: str) -> DataFrame:
    known, k = meters(spark, folder), _n() % 20
    listed = known.where(k != 2).select("meterNo", F.when(k == 5, None).when(k == 8, None).when(k == 6, "what").otherwise("CAT2 x").alias("value"), F.when(k.isin(4, 8), "GONE").alias("exception"), k.alias("k"))
    package = listed.unionByName(listed.where("k = 3")).drop("k")
    before = known.where(k != 7).select("meterNo", F.lit("2024-01").alias("ym"))
    return evidence.admit_package(package, known.where(k != 1).select("meterNo"), before, "2024-02")


@query(f"""with {MONTHLY}, r as (select meter, ym, amount as v from monthly where ym >= '1998-01'), nxt as (select meter, strftime(cast(ym || '-01' as date) + interval 1 month, '%Y-%m') as ym, v as old from r), b as (select coalesce(r.meter, nxt.meter) as meter, coalesce(r.ym, nxt.ym) as ym, v, old from r full outer join nxt on r.meter = nxt.meter and r.ym = nxt.ym),
h as (select *, sha256(concat_ws('|', length(meter), meter, v)) as h from b)
select ym as month, count(v) as members, count_if(old is null) as added, count_if(v is null) as removed, count(*) filter (where v <> old) as changed, concat_ws('-', {", ".join(f"cast(sum(cast(('0x' || substr(h, {8 * i + 1}, 8)) as bigint)) as varchar)" for i in range(4))}) as "packageSha256" from h where ym in (select ym from r) group by ym""")
def release_months(spark: SparkSession, folder: str) -> DataFrame:
    rows = aggregates.monthly_meters(purchases(spark, folder)).where("ym >= '1998-01'")
    return evidence.released_months(rows, rows.withColumnRenamed("amountTotalC", "value"))


@query(f"""with {FACTS}, p as (select distinct meter, ym, c_custkey from facts), c as (select ym, count(*) as planned, count_if(c_custkey % 50 = 1 and ym >= '1998-02') as conflicts from p group by ym), f as (select min(ym) filter (where conflicts > 0) as fm from c)
select ym, planned, conflicts, case when fm is null or ym < fm then 'PASS' when ym = fm then 'FAIL' else 'NOT_RUN' end as state from c, f""")
def month_sweep(spark: SparkSession, folder: str) -> DataFrame:
    plan = purchases(spark, folder).select("meterNo", "ym", "c_custkey").distinct().withColumn("classification", F.when((_n() % 50 == 1) & (F.col("ym") >= "1998-02"), "CONFLICT").otherwise("UPDATED"))
    return pipelines.sweep(plan)


# contracts of single values
@query(f"""with {METERS} select c_custkey as id, {_sql_fault({0: "''", 1: "'Nan x'"}, "name", 5)} as safe, cast({_sql_fault({1: "c_custkey", 2: "null"}, "null", 5)} as bigint) as whole, cast({_sql_fault({3: "c_custkey + 0.5"}, "null", 5)} as decimal(18,1)) as units, {_sql_fault({4: "''"}, "'1998-02-03 00:00'", 5)} as day,
  {_sql_fault({0: "'-12.5'", 1: "'100'", 2: "'0.05'"}, "'7'", 5)} as plain, '3.5' as shown, 'b|a' as listed, c_custkey % 5 <> 2 as agree, cast(case when c_custkey % 5 = 3 then -c_custkey end as bigint) as negative from meters""")
def strict_values(spark: SparkSession, folder: str) -> DataFrame:
    number = _n().cast("string")
    decimal = _fault({0: F.lit("-12.5000"), 1: F.lit("100.0000"), 2: F.lit("0.0500")}, F.lit("7.0000"), 5).cast("decimal(18,4)")
    iso = _fault({0: F.lit(""), 1: F.lit(" "), 2: F.lit("1998-01-01T00:00:01Z")}, F.lit("1998-01-01T00:00:00Z"), 5)
    ms = F.when((_n() % 5).isin(0, 1), None).otherwise(F.lit(883612800000))
    return meters(spark, folder).select(
        _n().alias("id"), S.safe_text(_fault({0: F.lit(" NaN "), 1: F.lit("Nan x")}, F.col("name"), 5)).alias("safe"), S.strict_int(_fault({1: F.concat(F.lit(" "), number), 2: F.lit("1.0"), 3: F.lit("-5")}, F.lit("x"), 5)).alias("whole"),
        S.strict_units(_fault({3: F.concat(number, F.lit(".5")), 4: F.lit("1.55")}, F.lit("-1"), 5)).alias("units"), S.real_date(_fault({4: F.lit("1900-01-01 00:00")}, F.lit("1998-02-03 00:00"), 5)).alias("day"), S.plain_decimal(decimal).alias("plain"), S.units_text(F.lit(3.5)).alias("shown"),
        S.join_distinct(F.array(F.lit("b"), F.lit(""), F.lit(None).cast("string"), F.lit("a"), F.lit("b"))).alias("listed"), S.iso_ms_agree(iso, ms).alias("agree"), S.strict_int(_fault({3: F.concat(F.lit("-"), number)}, F.lit("x"), 5), negative=True).alias("negative"),
    )


@query(f"""with {METERS} select meter as "meterNo", c_custkey % 4 <> 1 as keys, c_custkey % 4 <> 2 as inside, c_custkey % 4 <> 3 as same, cast(case when c_custkey % 4 = 1 then 0 else 20 end as bigint) as "amount_2024_02_C", '2024-01=10|2024-02=' || case when c_custkey % 4 = 1 then 0 else 20 end as again, {_sql_fault({0: "true", 1: "false", 2: "false"}, "false", 4)} as history from meters""")
def map_contracts(spark: SparkSession, folder: str) -> DataFrame:
    months = ["2024-01", "2024-02"]
    full, short = _month_map("bigint", m2024_01=10, m2024_02=20), _month_map("bigint", m2024_01=10)
    value = lambda category, score: F.struct(F.lit(category).alias("leakageCategory"), F.lit("HIGH").alias("riskTier"), F.lit(score).alias("riskScore"))
    history = F.when(_n() % 4 == 1, F.create_map(F.lit("2024-13"), value("CAT1", 1))).when(_n() % 4 == 2, F.create_map(F.lit("2024-01"), value("NAv", 1))).when(_n() % 4 == 3, F.create_map(F.lit("2024-01"), value("CAT1", -1))).otherwise(F.create_map(F.lit("2024-01"), value("CAT1", 0)))
    rows = meters(spark, folder).select("meterNo", F.when(_n() % 4 == 1, short).otherwise(full).alias("m"), history.alias("h"), "c_custkey")
    told = rows.select("*", M.keys_equal(F.col("m"), full).alias("keys"), M.months_inside(F.col("m"), F.lit("2024-01"), F.when(_n() % 4 == 2, "2024-01").otherwise("2024-02")).alias("inside"), M.maps_equal(full, F.when(_n() % 4 == 3, short).otherwise(full)).alias("same"), validate.history_valid(F.col("h")).alias("history"))
    flat = M.to_wide(told, "m", months)
    return flat.select("meterNo", "keys", "inside", "same", "amount_2024_02_C", _flat_entries(F.transform_values(M.from_wide(months), lambda k, v: v.cast("string"))).alias("again"), "history")


@query(f"""with {MONTHLY} select cast(count_if(balance >= 0) as bigint) as total_differs, cast(count_if(segment = 'BUILDING') as bigint) as negative_month from meters where meter in (select meter from monthly)""")
def wide_output_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Wide rows whose total is one too much, and some with a negative month that their total allows for."""
    months = ["1998-05", "1998-06"]
    flat = wide.pivot_months(aggregates.monthly_meters(purchases(spark, folder)), months).join(meters(spark, folder), "meterNo")
    first, second = (F.col(M.month_column(m)) for m in months)
    made = flat.withColumn(M.month_column("1998-05"), F.when(F.col("segment") == "BUILDING", F.lit(-5)).otherwise(first))
    return validate.assertions(made.withColumn("totalC", F.col(M.month_column("1998-05")) + second + F.when(F.col("balanceC") >= 0, 1).otherwise(0)), wide.output_checks(months))


_PARCEL_FAULTS = {1: "missing_erf_id", 2: "missing_parcel_key", 3: "missing_erf_number", 4: "missing_municipality", 5: "invalid_centroid", 6: "invalid_geometry", 7: "invalid_centroid"}


@query(f"""with {METERS} select meter as "masterId", {_sql_fault({n: f"'{c}'" for n, c in _PARCEL_FAULTS.items()}, "''", 10)} as reason, {_sql_fault({6: "'geometry'"}, "''", 10)} as forbidden from meters""")
def parcel_records(spark: SparkSession, folder: str) -> DataFrame:
    blank = lambda n, good: F.when(_n() % 10 == n, " ").otherwise(good)
    rows = _ids(spark, folder).select(
        "masterId", blank(1, F.col("name")).alias("erfId"), blank(2, F.col("masterId")).alias("prclKey"), blank(3, F.lit("12.0")).alias("erfNo"), blank(4, F.col("lmPcode")).alias("lmPcode"), F.when(_n() % 10 == 5, float("nan")).otherwise(1.5).alias("lat"),
        F.when(_n() % 10 == 7, 180.5).otherwise(2.5).alias("lng"), F.when(_n() % 10 == 6, '{"type":"Point"}').when(_n() % 10 == 8, '{"type":"MultiPolygon"}').alias("geometry"), F.when(_n() % 10 == 6, '{"a":1,"geometry":2}').otherwise('{"a":1}').alias("doc"),
    )
    return rows.select("masterId", F.array_join(validate.reasons(validate.parcel_rules()), ";").alias("reason"), F.array_join(validate.forbidden_keys(F.col("doc"), documents.GEOMETRY), "|").alias("forbidden"))


@query(f"""with {FACTS} select meter as "meterNo", ym, case when ym <= '{CUT}' then 'CLOSED_MONTH' else 'OPEN' end as code, count(*) as n from facts where ym >= '1998-01' group by all""")
def closed_months(spark: SparkSession, folder: str) -> DataFrame:
    open_, late = windows.split_closed(purchases(spark, folder).where("ym >= '1998-01'").select("meterNo", "ym"), CUT)
    return open_.withColumn("code", F.lit("OPEN")).unionByName(late).groupBy("meterNo", "ym", "code").agg(F.count("*").alias("n"))


@query(f"""with {METERS}, k as (select meter, cast((row_number() over (order by meter) + 9) // 10 as bigint) as page from meters) select page, count(*) as n, min(meter) as first, max(meter) as last from k group by page""")
def key_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All windows of ten keys, from which bounded samples are taken."""
    return waves(meters(spark, folder).select("meterNo"), "meterNo", 10, "page").groupBy("page").agg(F.count("*").alias("n"), F.min("meterNo").alias("first"), F.max("meterNo").alias("last"))


@query(f"""with {METERS}, s as (select lm, c_custkey, row_number() over (partition by lm order by c_custkey) as n from meters), b as (select lm, case when n = 3 then 2 when n = 5 then 500 when n = 6 then 0 else n end as v from s),
c as (select lm, v, count(*) as k from b group by all)
select lm as "lmPcode", cast(sum(k) as bigint) as rows, cast(sum(k - 1) as bigint) as repeated, count_if(v < 1) as invalid, cast(max(v) - count(v) + count_if(v < 1) as bigint) as missing from c group by lm""")
def sequence_check(spark: SparkSession, folder: str) -> DataFrame:
    numbered = meters(spark, folder).withColumn("n", F.row_number().over(Window.partitionBy("lmPcode").orderBy("c_custkey")))
    broken = numbered.withColumn("n", F.when(F.col("n") == 3, 2).when(F.col("n") == 5, 500).when(F.col("n") == 6, 0).otherwise(F.col("n")))
    return validate.sequence_errors(broken, "n", ["lmPcode"])


@query(f"""with {MONTHLY}, m as (select meter, cast(sum(amount) as bigint) as total from monthly group by meter) select meter as "meterNo", total as "mapTotalC", total + case when cast(meter as bigint) % 9 = 0 then 1 else 0 end as "declaredC" from m where cast(meter as bigint) % 9 = 0""")
def declared_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Meters whose declared total isn't the sum of their months."""
    maps = wide.month_maps(aggregates.monthly_meters(purchases(spark, folder)))
    told = maps.withColumn("declaredC", F.col("totalC") + F.when(F.col("meterNo").cast("bigint") % 9 == 0, 1).otherwise(0)).withColumn("mapTotalC", M.map_total(F.col("monthlyTotalsC")))
    return told.where(F.col("mapTotalC") != F.col("declaredC")).select("meterNo", "mapTotalC", "declaredC")


_FLAT = {"id": '"@"', "amountTotalC": "5", "ym": '"1998-06"'}
_FLAT_FAULTS: dict[int, tuple[dict[str, str | None], str, str]] = {
    1: ({"ym": None}, "CONFLICT", "ym"), 2: ({"extra": "1"}, "CONFLICT", "extra"), 3: ({"amountTotalC": '"5"'}, "CONFLICT", "amountTotalC"), 4: ({"amountTotalC": "5.5", "ym": "6"}, "CONFLICT", "amountTotalC|ym"), 5: ({"amountTotalC": "6"}, "UPDATED", "amountTotalC"), 6: ({"ym": '"1998-07"'}, "CONFLICT", "ym"),
}


@query(f"""with {METERS} select meter as "masterId", {_sql_fault({n: f"'{s}'" for n, (_, s, _) in _FLAT_FAULTS.items()} | {7: "'CREATED'"}, "'UNCHANGED'")} as classification, {_sql_fault({n: f"'{f}'" for n, (_, _, f) in _FLAT_FAULTS.items()}, "''")} as fields from meters""")
def monthly_refresh_stages(spark: SparkSession, folder: str) -> DataFrame:
    """Stored monthly documents as JSON: shape first, then types, fixed fields and mutable ones."""
    doc = _fault({n: _filled(_FLAT | change) for n, (change, _, _) in _FLAT_FAULTS.items()}, _filled(_FLAT))
    known = _ids(spark, folder)
    stored = known.where(_n() % 40 != 7).select("masterId", doc.alias("doc"))
    codes = documents.stored_codes(stored, "doc", "masterId", {"id": "STRING", "amountTotalC": "BIGINT", "ym": "STRING"})
    v = F.try_parse_json("doc")
    existing = stored.select("masterId", documents.value_at(v, "ym").alias("ym"), documents.value_at(v, "amountTotalC").alias("amountTotalC"))
    expected = known.select("masterId", F.lit("1998-06").alias("ym"), F.lit("5").alias("amountTotalC"))
    return upsert.refresh_monthly(expected, existing, "masterId", ["ym"], ["amountTotalC"], codes).select("masterId", "classification", F.array_join("fields", "|").alias("fields"))


@query(f"""with {METERS} select meter as "masterId", case when c_custkey % 4 = 1 then 'CONFLICT' when c_custkey % 4 = 2 then 'CONFLICT' else 'UNCHANGED' end as classification, case when c_custkey % 4 = 1 then 'visibility invalid' when c_custkey % 4 = 2 then 'address incomplete' end as reason from meters""")
def conflict_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Stored values that are none of an enumeration, and addresses that hold only a part."""
    known = _ids(spark, folder)
    rows = lambda visibility, name: known.select("masterId", "lmPcode", visibility.alias("visibility"), F.struct(F.lit("1").alias("strNo"), name.alias("strName"), F.lit("-").alias("strType")).alias("adr"))
    checks = [
        ("visibility invalid", ~F.coalesce(F.col("old.visibility").isin(*documents.VISIBILITIES), F.lit(False))),
        ("address incomplete", ~F.coalesce(address_valid(F.col("old.adr.strNo"), F.col("old.adr.strName"), F.col("old.adr.strType")), F.lit(False))),
    ]
    existing = rows(F.when(_n() % 4 == 1, "HIDDEN").otherwise("VISIBLE"), F.when(_n() % 4 == 2, "").otherwise("Main"))
    return upsert.classify(rows(F.lit("VISIBLE"), F.lit("Main")), existing, "masterId", ["lmPcode"], [], [], checks).select("masterId", "classification", "reason")
