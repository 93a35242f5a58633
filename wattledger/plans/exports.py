"""Queries on documents that leave the store with their types and come back, and on where two states differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions import maps as M
from wattledger.operators import reconcile, trees
from wattledger.plans.changes import _STORE, _documents
from wattledger.plans.registry import query
from wattledger.plans.stores import _MAPS, _months, _place
from wattledger.plans.tables import FACTS, meter_text, purchases, table
from wattledger.scratch import keep, spread
from wattledger.sources.delimited import read_csv


@query(f"""with {FACTS}, m as (select meter, c_custkey, name, max(o_orderdate) as latest, min(o_orderdate) as earliest, count(*) as n, list_sort(list(distinct [y, m])) as months from (select *, year(o_orderdate) as y, month(o_orderdate) as m from facts) group by meter, c_custkey, name)
select meter as "masterId", '{{"at":{{"__type":"timestamp","value":"' || strftime(latest, '%Y-%m-%d %H:%M:%S') || '+00:00"}},"day":{{"__type":"date","value":"' || strftime(earliest, '%Y-%m-%d') || '"}},"inner":{{"___type":"own","local":{{"__type":"datetime","value":"' || strftime(latest, '%Y-%m-%d %H:%M:%S') || '"}}}},"months":' || replace(cast(months as varchar), ' ', '')
  || ',"n":' || n || ',"name":{{"__type":"bytes","value":"' || base64(encode(name)) || '"}},"ref":{{"path":"masters/' || meter || '","__type":"reference"}},"share":{{"__type":"double","value":"' || cast((c_custkey % 8 + 1) / 4.0 as double) || '"}},"void":null}}' as document, true as same from m""")
def typed_export(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of times, bytes, lists of lists, references and numbers of two kinds as tagged JSON, and whether reading it back gives the same variant."""
    # by month first: sets of arrays would be gathered from all purchases, by sorting them
    by_month = purchases(spark, folder).groupBy("meterNo", "c_custkey", "name", "y", "m").agg(F.max("_t").alias("at"), F.min("_t").alias("day"), F.count("*").alias("n"))
    rows = by_month.groupBy("meterNo", "c_custkey", "name").agg(F.max("at").alias("at"), F.min("day").cast("date").alias("day"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.array("y", "m"))).alias("months"))
    inner = F.struct(F.lit("own").alias(trees.TAG), F.col("at").cast("timestamp_ntz").alias("local"))
    reference = F.create_map(F.lit(trees.REFERENCE), F.concat(F.lit("masters/"), "meterNo"))
    fields = F.struct("at", "day", inner.alias("inner"), "months", "n", F.col("name").cast("binary").alias("name"), reference.alias("ref"), ((F.col("c_custkey") % 8 + 1) / F.lit(4.0)).cast("double").alias("share"), F.lit(None).cast("string").alias("void"))
    given = keep(rows.select(F.col("meterNo").alias("masterId"), F.to_variant_object(fields).alias("v")), "given")
    told = keep(trees.unfold(spread(given), "v").select("masterId", "v", trees.written(trees.typed(F.col("_nodes"))).alias("document")), "told")
    back = trees.from_typed(spread(told), "document", "masterId").withColumnRenamed("document", "back")
    return told.join(back, "masterId").select("masterId", "document", M.same_variant(F.col("v"), F.col("back")).alias("same"))


@query(f"""with {_STORE}, {_MAPS}, a as (select o.meter, o.lm, o.last, m.months from old o join om2 m using (meter)), b as (select n.meter, n.lm, n.last, m.months from new n join nm2 m using (meter))
select coalesce(a.meter, b.meter) as "meterNo", case when a.meter is null then 'right_only' when b.meter is null then 'left_only' else 'differs' end as side from a full outer join b using (meter) where a.meter is null or b.meter is null or (a.lm, a.last, a.months) is distinct from (b.lm, b.last, b.months)""")
def differing_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Where two states of a store differ: their trees of digests are descended, and ids read only below branches that aren't equal."""
    flat = lambda df: df.select("meterNo", "lmPcode", "lastMonth", _months().alias("months"))
    expected, existing = _documents(spark, folder)
    left, right = (reconcile.write_tree(flat(df), _place(spark, "tree"), "meterNo", ["lmPcode", "lastMonth", "months"]) for df in (existing, expected))
    return reconcile.tree_differences(spark, left, right)


@query("""select lpad(cast(c_custkey as varchar), 11, '0') as meter, case when c_custkey % 3 = 0 then null when c_custkey % 5 = 0 then 'two
lines, "' || c_name || '"' else c_name || ' Zoë Müller' end as name, cast(c_acctbal as varchar) as balance from customer""")
def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as CSV in two encodings and with broken lines, and read back from one folder, each file in its own encoding."""
    rows = table(spark, folder, "customer")
    name = F.when(F.col("c_custkey") % 3 == 0, "NA").when(F.col("c_custkey") % 5 == 0, F.concat(F.lit('two\nlines, "'), "c_name", F.lit('"'))).otherwise(F.concat("c_name", F.lit(" Zoë Müller")))
    told = rows.select(meter_text("c_custkey").alias("meter"), name.alias("name"), F.col("c_acctbal").cast("string").alias("balance"), "c_custkey")
    path = _place(spark, "csv")
    kinds = {"UTF-8": F.col("c_custkey") % 2 == 0, "ISO-8859-1": (F.col("c_custkey") % 2 == 1) & (F.col("c_custkey") % 5 > 0), "latin1": (F.col("c_custkey") % 2 == 1) & (F.col("c_custkey") % 5 == 0)}
    for encoding, which in kinds.items():
        told.where(which).drop("c_custkey").write.option("header", True).option("encoding", "ISO-8859-1" if encoding == "latin1" else encoding).option("escape", '"').csv(f"{path}/{encoding}")
    return read_csv(spark, f"{path}/*", ["meter", "name", "balance"])
