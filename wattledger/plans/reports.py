"""Queries on scalars, samples, document profiles and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions import maps as M
from wattledger.functions import numbering
from wattledger.functions import scalars as S
from wattledger.operators import address, aggregates, profiling, sampling
from wattledger.plans.registry import query
from wattledger.plans.tables import FACTS, METERS, meters, purchases, table
from wattledger.streaming import windows


@query(r"""with r as (select c_custkey, ' 0' || lower(c_mktsegment) || ' ' || c_custkey || '.0' as t, ' 00' || c_custkey || '.0 ' as d from customer)
select c_custkey as id, upper(regexp_replace(t, '\s+', '', 'g')) as plain, regexp_replace(upper(regexp_replace(d, '\s+', '', 'g')), '^(\d+)\.0$', '\1') as repaired, cast(c_custkey as varchar) as parcel from r""")
def normalize_meter(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer")
    number = F.col("c_custkey").cast("string")
    mixed = F.concat(F.lit(" 0"), F.lower("c_mktsegment"), F.lit(" "), number, F.lit(".0"))
    digits = F.concat(F.lit(" 00"), number, F.lit(".0 "))
    return rows.select(F.col("c_custkey").alias("id"), S.meter_no(mixed).alias("plain"), S.raw_meter_no(digits).alias("repaired"), S.parcel_no(digits).alias("parcel"))


_CENTS = "cast(round(cast(l_extendedprice as decimal(18,4)) * 100) as bigint)"


@query(f"""select l_orderkey as id, case when l_returnflag = 'A' then {_CENTS} when l_returnflag = 'N' and l_linestatus = 'F' then 100000000 + {_CENTS} % 100000 when l_returnflag = 'N' then -{_CENTS} else null end as cents from lineitem""")
def parse_money(spark: SparkSession, folder: str) -> DataFrame:
    """Decimal commas, grouped thousands with currency, negative amounts, and texts that are none."""
    c = S.cents("l_extendedprice")
    text = lambda whole, part: F.format_string("%d" + "%s" + "%02d", whole, F.lit(","), part)
    grouped = F.format_string("R 1,000,%03d.%02d", F.expr("cast(c % 100000 as bigint) div 100"), F.expr("c % 100"))
    rows = table(spark, folder, "lineitem").withColumn("c", c)
    raw = F.when(F.col("l_returnflag") == "A", text(F.expr("c div 100"), F.expr("c % 100"))).when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), grouped).when(F.col("l_returnflag") == "N", F.concat(F.lit("-"), (F.col("c").cast("decimal(18,2)") / 100).cast("decimal(18,2)").cast("string"))).otherwise("n/a")
    return rows.select(F.col("l_orderkey").alias("id"), S.money_cents(raw).alias("cents"))


@query("""select o_orderkey as id, case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') end as iso, case when o_orderstatus <> 'P' then epoch_ms(o_orderdate) end as ms from orders""")
def parse_datetime(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders")
    day = F.col("o_orderdate")
    raw = F.when(F.col("o_orderstatus") == "F", F.date_format(day, "dd/MM/yyyy HH:mm:ss")).when(F.col("o_orderstatus") == "O", F.date_format(day, "d/M/yyyy H:mm")).otherwise(F.concat(F.lit("31/02/"), F.date_format(day, "yyyy"), F.lit(" 10:00")))
    time = S.day_first_time(raw)
    return rows.select(F.col("o_orderkey").alias("id"), S.iso_text(time).alias("iso"), S.wall_clock_ms(time).alias("ms"))


@query("""select distinct strftime(o_orderdate, '%Y-%m') as ym, strftime(date_trunc('month', o_orderdate) - interval 1 month, '%Y-%m') as previous, strftime(date_trunc('month', o_orderdate) + interval 1 month, '%Y-%m') as following,
  cast(date_diff('month', date '1995-01-01', o_orderdate) + 1 as integer) as nth from orders""")
def month_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    months = table(spark, folder, "orders").select(S.month_of("o_orderdate").alias("ym")).distinct()
    return months.select("ym", S.next_month("ym", -1).alias("previous"), S.next_month("ym").alias("following"), F.size(S.month_range(F.lit("1995-01"), "ym")).alias("nth"))


@query("""select c_custkey as id, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || ' Of ' || c_name as shown, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') as key, 'lm__' || c_custkey || '__1998-06' as doc, sha1(c_name || '|' || c_custkey) as hash from customer""")
def text_keys(spark: SparkSession, folder: str) -> DataFrame:
    shown = S.display_name(F.concat("c_mktsegment", F.lit("  OF "), "c_name"))
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), shown.alias("shown"), S.name_key("c_name").alias("key"), S.doc_id(F.lit("lm"), "c_custkey", F.lit("1998-06")).alias("doc"), S.content_hash("c_name", "c_custkey").alias("hash"))


@query("""select case when substr(o_orderpriority, 1, 1) = '1' then 'CAT1' when substr(o_orderpriority, 1, 1) = '2' then 'NORMAL' when substr(o_orderpriority, 1, 1) = '3' then 'MISSING' else 'OTHER' end as bucket, count(*) as n from orders group by 1""")
def category_buckets(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.substring("o_orderpriority", 1, 1)
    text = F.when(kind == "1", F.concat(F.lit("cat1 - "), "o_orderpriority")).when(kind == "2", "Normal use").when(kind == "3", "  ").otherwise(F.col("o_orderpriority"))
    return aggregates.histogram(table(spark, folder, "orders"), S.category_bucket(text).alias("bucket"))


@query("""select n_nationkey as id, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') as digest from nation""")
def canonical_json_digest(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), F.sha2(S.canonical_json(["n_regionkey", "n_name", "n_nationkey"]), 256).alias("digest"))


@query(f"""with {FACTS}, a as (select meter, list_sort(list(distinct l_returnflag)) as x from facts where ym < '1998-01' group by meter), b as (select meter, list_sort(list(distinct l_returnflag)) as x from facts where ym >= '1998-01' group by meter)
select meter as "meterNo", array_to_string(list_sort(list_concat(list_filter(a.x, lambda v: not list_contains(b.x, v)), list_filter(b.x, lambda v: not list_contains(a.x, v)))), '|') as difference from a join b using (meter)""")
def field_symmetric_difference(spark: SparkSession, folder: str) -> DataFrame:
    rows = purchases(spark, folder)
    names = lambda df, n: df.groupBy("meterNo").agg(F.collect_set("l_returnflag").alias(n))
    both = names(rows.where("ym < '1998-01'"), "a").join(names(rows.where("ym >= '1998-01'"), "b"), "meterNo")
    return both.select("meterNo", F.array_join(M.field_difference(F.col("a"), F.col("b")), "|").alias("difference"))


@query(f"""with {METERS}, t as (select *, row_number() over (partition by lm order by meter) as turn from meters) select lm as "lmPcode", meter as "meterNo", cast(turn as integer) as turn from t order by turn, lm limit 100""")
def round_robin_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.round_robin(meters(spark, folder), "lmPcode", "meterNo", 100).select("lmPcode", "meterNo", "turn")


@query(f"""with {METERS}, n as (select meter, row_number() over (order by meter) as rn, count(*) over () as n from meters) select meter as "meterNo", rn from n where rn in (1, n // 2 + 1, n)""")
def positional_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.first_middle_last(meters(spark, folder).select("meterNo"), "meterNo").select("meterNo", "rn")


@query(f"""with {METERS}, n as (select meter, row_number() over (order by meter) as rn, count(*) over () as n from meters) select meter as "meterNo", rn from n where rn in (select cast(round_even(i * (n - 1) / 6, 0) as bigint) + 1 from range(7) r(i))""")
def even_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.evenly_spaced(meters(spark, folder).select("meterNo"), "meterNo").select("meterNo", "rn")


@query("""select o_orderkey as id, cast((row_number() over (order by o_orderkey) + 399) // 400 as bigint) as wave from orders""")
def wave_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return numbering.waves(table(spark, folder, "orders").select(F.col("o_orderkey").alias("id")), "id")


@query("""with t as (select l_returnflag, l_linestatus, l_linenumber, count(*) as n, count(distinct l_orderkey) as orders from lineitem group by all) select l_returnflag as flag, l_linestatus as status, l_linenumber as line, n, orders from t order by orders desc, n desc, flag, status, line limit 10""")
def topk_paths(spark: SparkSession, folder: str) -> DataFrame:
    per_order = table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_linenumber").alias("line"), "l_orderkey").agg(F.count("*").alias("k"))
    return per_order.groupBy("flag", "status", "line").agg(F.sum("k").alias("n"), F.count("*").alias("orders")).orderBy(F.desc("orders"), F.desc("n"), "flag", "status", "line").limit(10)


@query(f"""with {METERS}, t as (select *, row_number() over (partition by segment order by sha1('7|' || meter), meter) as place from meters) select segment, meter as "meterNo", cast(place as integer) as place from t where place <= 20""")
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified(meters(spark, folder), "segment", "meterNo", 20, 7).select("segment", "meterNo", "place")


@query(f"""with {METERS} select meter as "meterNo" from meters order by sha1('11|' || meter), meter limit 50""")
def seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.seeded(meters(spark, folder), "meterNo", 50, 11).select("meterNo")


@query("""select o_orderkey as id, o_custkey as custkey from orders where o_orderkey >= 50 order by o_orderkey limit 25""")
def key_range_page(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.page(table(spark, folder, "orders"), "o_orderkey", 50, 25).select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("custkey"))


_PARTS = f"""{METERS}, parts as (select meter, 'negative' as source, 2 as p from meters where balance < 0 union all select meter, 'building', 1 from meters where segment = 'BUILDING' union all select meter, 'first', 3 from meters where lm = 'NATION_0')"""


def _parts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    known = meters(spark, folder)
    return {"building": known.where("segment = 'BUILDING'"), "negative": known.where("balanceC < 0"), "first": known.where("lmPcode = 'NATION_0'")}


@query(f"""with {_PARTS} select meter as "meterNo", array_to_string(list_sort(list(source)), '|') as sources from parts group by meter""")
def candidate_provenance(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.merged_candidates(_parts(spark, folder), "meterNo").withColumn("sources", F.array_join("sources", "|"))


@query(f"""with {_PARTS} select meter as "meterNo", cast(min(p) as integer) as priority, arg_min(source, p) as source from parts group by meter""")
def first_reason(spark: SparkSession, folder: str) -> DataFrame:
    out = None
    for p, (name, part) in enumerate(_parts(spark, folder).items(), 1):
        one = part.select("meterNo", F.lit(p).alias("priority"), F.lit(name).alias("source"))
        out = one if out is None else out.unionByName(one)
    return sampling.first_reason(out, "meterNo", "priority")


@query("""with d as (select event_id, '{"event":{"type":"' || event_type || '","user":' || user_id || '},"props":' || props || case when value > 50 then ',"tags":["hot",null]' else '' end || '}' as j from events),
f as (select event_id, unnest([{'p': 'event', 't': 'OBJECT'}, {'p': 'event.type', 't': 'STRING'}, {'p': 'event.user', 't': 'BIGINT'}, {'p': 'props', 't': 'OBJECT'}, {'p': 'props.k', 't': 'BIGINT'}]) as e from d
  union all select event_id, unnest([{'p': 'tags', 't': 'ARRAY'}, {'p': 'tags[]', 't': 'STRING|VOID'}]) from d where contains(j, '"tags"'))
select e.p as path, count(*) as documents, (select count(*) from events) - count(*) as missing, case when e.p = 'tags[]' then count(*) else 0 end as nulls, min(e.t) as types from f group by e.p""")
def field_inventory(spark: SparkSession, folder: str) -> DataFrame:
    found = profiling.field_inventory(_events(spark, folder), "doc", "event_id")
    return found.withColumn("types", F.array_join("types", "|"))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    tags = F.when(F.col("value") > 50, ',"tags":["hot",null]').otherwise("")
    doc = F.concat(F.lit('{"event":{"type":"'), "event_type", F.lit('","user":'), F.col("user_id").cast("string"), F.lit('},"props":'), "props", tags, F.lit("}"))
    return table(spark, folder, "events").select("event_id", doc.alias("doc"))


@query("""select case when value > 50 then 'event|props|tags' else 'event|props' end as shape, count(*) as n from events group by 1""")
def shape_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.histogram(_events(spark, folder), profiling.shape(F.col("doc")).alias("shape"))


@query("""with k as (select distinct cast(c_custkey as varchar) as v from customer), p as (select 'event.user' as path, cast(user_id as varchar) as v from events union all select 'props.k', json_extract_string(props, '$.k') from events)
select path, count(distinct v) as matched_keys, count(*) as matched_rows from p where v in (select v from k) group by path order by 2 desc, 3 desc, 1 limit 10""")
def key_path_detection(spark: SparkSession, folder: str) -> DataFrame:
    found = profiling.paths(_events(spark, folder), "doc", "event_id")
    return profiling.rank_key_paths(found, table(spark, folder, "customer"), "c_custkey")


@query("""select count(*) as documents, max(strlen('{"event_type":"' || event_type || '","user_id":' || user_id || '}')) as largest, count_if(strlen('{"event_type":"' || event_type || '","user_id":' || user_id || '}') > 40) as too_large from events""")
def document_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.document_sizes(table(spark, folder, "events"), ["user_id", "event_type"], 40)


@query("""with i as (select doc_id, array_to_string(list_filter([case when text is null or trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') = '' then 'EMPTY_TEXT' end, case when coalesce(length(text), 0) <> n_chars then 'N_CHARS_MISMATCH' end,
  case when lang is null or lang = '' then 'NO_LANGUAGE' end, case when source is null or source = '' then 'NO_SOURCE' end, case when length(text) > 20000 then 'LONG_TEXT' end, case when contains(text, chr(65533)) then 'REPLACEMENT_CHARACTER' end], lambda x: x is not null), ';') as issues from documents)
select issues, count(*) as n from i group by issues""")
def document_issue_codes(spark: SparkSession, folder: str) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    rules = [
        ("EMPTY_TEXT", ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")), ("N_CHARS_MISMATCH", F.coalesce(F.length("text"), F.lit(0)) != F.col("n_chars")), ("NO_LANGUAGE", blank("lang")), ("NO_SOURCE", blank("source")),
        ("LONG_TEXT", F.length("text") > 20000), ("REPLACEMENT_CHARACTER", F.col("text").contains("�")),
    ]
    return aggregates.histogram(table(spark, folder, "documents"), F.array_join(profiling.issues(rules), ";").alias("issues"))


# fixed values: forms of single places, and address lines with what they must give; what is in the parser holds everywhere
PLACES = address.Places(
    forms=(("ZIGO SITHOLE", "N,?A?[UV]", "compound_zigo"), ("NDUMENI", "N,?AU", "compound_ndumeni"), ("BENVILLE", "N#N$", "benville_unit_suffix")),
    not_streets=("CRAIG H", "ROADS IN EXT"), buildings=("WHITE ",), trusted=(("16A", "NDUMENI"),), units=("VNW+V",),
)
# (line 1, line 2, number, name, type or reason)
ADDRESSES = (
    ("34 BULWER", "", "34", "Bulwer", "-"), ("MC KENZIE 45B", "SHOP NO 2", "45B", "Mc Kenzie", "-"), ("42 MC KENZIE STREET", "SHOP 2", "42", "Mc Kenzie", "Street"), ("42 MCKENZIE", "STREET", "42", "Mckenzie", "Street"),
    ("45 GLADSTONE STR", "FLAT NO 3", "45", "Gladstone", "Street"), ("12 ALBATROSS CR", "", "12", "Albatross", "Crescent"), ("EVENTIDE MEWS H24", "103 MCKENZIE", "103", "Mckenzie", "-"), ("51 A WILLSON", "", "51A", "Willson", "-"),
    ("MBASA 13TH 506", "SIBONGILE", "506", "Mbasa 13th", "-"), ("17 PH0LI", "", "17", "Ph0li", "-"), ("ZIGO SITHOLE 168, FAM UNIT 56", "", "168", "Zigo Sithole", "-"), ("BLOCK 42 SIBONGILE", "168 ZIGO SITHOLE", "168", "Zigo Sithole", "-"),
    ("NDUMENI 16A , FAM UNIT NO 41", "", "16A", "Ndumeni", "-"), ("MBELE (GLENCOE) 06", "", "06", "Mbele", "-"), ("BENVILLE 3 NO 7", "", "3", "Benville", "-"), ("MAIN ROAD 5", "", "5", "Main", "Road"),
    ("41 & 43 MAGNOLIA", "", "", "", address.CONFLICT), ("MGADI 577-1", "", "", "", address.CONFLICT), ("562/1 MNGADI", "", "", "", address.CONFLICT), ("SMITH 5", "7 MAIN", "", "", address.CONFLICT), ("0 ZIGA SITHOLE", "", "", "", address.ZERO),
    ("FAMILY UNIT NO 9", "", "", "", address.UNIT_ONLY), ("CRAIG H 12", "", "", "", address.ROLE), ("AIRFIELD HANGER", "VICTORIA STREET", "", "", address.NO_NUMBER), ("13TH AVENUE", "", "", "", address.NO_NUMBER),
)


@query(f"""with {METERS}, told as (select line1, line2, no, name, kind from (values {", ".join(repr(a) for a in ADDRESSES)}) v(line1, line2, no, name, kind)),
built as (select case segment when 'BUILDING' then c_custkey || ' BUILDING STR' when 'MACHINERY' then 'MACHINERY ' || c_custkey when 'FURNITURE' then 'FAMILY UNIT NO ' || c_custkey when 'HOUSEHOLD' then c_custkey || ' & 9 MAIN' else 'SHOP' end as line1,
    case segment when 'AUTOMOBILE' then c_custkey || ' LONG AVE' else '' end as line2,
    case when c_custkey = 0 or segment in ('FURNITURE', 'HOUSEHOLD') then '' else cast(c_custkey as varchar) end as no, case when c_custkey = 0 then '' when segment = 'BUILDING' then 'Building' when segment = 'MACHINERY' then 'Machinery' when segment = 'AUTOMOBILE' then 'Long' else '' end as name,
    case when segment = 'FURNITURE' and c_custkey > 0 then '{address.UNIT_ONLY}' when segment = 'HOUSEHOLD' and c_custkey > 0 then '{address.CONFLICT}' when c_custkey = 0 then case when segment in ('BUILDING', 'HOUSEHOLD', 'AUTOMOBILE') then '{address.ZERO}' else '{address.NO_NUMBER}' end
      when segment = 'BUILDING' then 'Street' when segment = 'AUTOMOBILE' then 'Avenue' else '-' end as kind from meters)
select line1, line2, no as "strNo", name as "strName", case when no = '' then '-' else kind end as "strType", case when no = '' then 'UNRESOLVED' else 'ENRICHABLE' end as status, case when no = '' then kind end as reason from (select * from told union all select * from built)""")
def address_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Listed addresses, and some built from customers in five forms."""
    known = meters(spark, folder)
    number, street = F.col("c_custkey").cast("string"), F.col("segment")
    line1 = F.when(street == "BUILDING", F.concat(number, F.lit(" "), street, F.lit(" STR"))).when(street == "MACHINERY", F.concat(street, F.lit(" "), number)).when(street == "FURNITURE", F.concat(F.lit("FAMILY UNIT NO "), number)).when(street == "HOUSEHOLD", F.concat(number, F.lit(" & 9 MAIN"))).otherwise("SHOP")
    line2 = F.when(street == "AUTOMOBILE", F.concat(number, F.lit(" LONG AVE"))).otherwise("")
    listed = spark.createDataFrame([a[:2] for a in ADDRESSES], "line1 string, line2 string")
    rows = known.select(line1.alias("line1"), line2.alias("line2")).unionByName(listed)
    return address.enrich(rows, "line1", "line2", PLACES).select("line1", "line2", "adr.strNo", "adr.strName", "adr.strType", "adr.status", "adr.reason")


@query("""select strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%dT%H:%M:%S') as window_start, event_type as kind, count(*) as n, cast(sum(cast(round(cast(value as decimal(18,4)) * 100) as bigint)) as bigint) as value_c from events group by 1, 2""")
def events_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    return windows.tumbling(table(spark, folder, "events"))
