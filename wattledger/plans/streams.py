"""Queries over streams of files that arrive one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.plans.registry import query
from wattledger.plans.stores import _place
from wattledger.plans.tables import FACTS, purchases
from wattledger.scratch import keep
from wattledger.streaming.duplicates import read_numbered, with_stream_ids, write_numbered

_CLOSED = "1992-12"
ARRIVALS = ("1994-05", "1996-08", "9999-12")  # the last month of each file set, so that two years lie in two of them


@query(f"""with {FACTS}, open as (select *, sha1(concat_ws('|', lm, meter, y)) as h, row_number() over (partition by lm, meter, y order by ym, ms, amount, cost) as nth from (select *, year(o_orderdate) as y from facts) where ym > '{_CLOSED}')
select case when nth = 1 then h else h || '__' || nth end as id, meter as "meterNo", iso as "txAtISO", amount as "amountTotalC", cast(null as varchar) as code from open
union all select null, meter, iso, amount, 'CLOSED_MONTH' from facts where ym <= '{_CLOSED}'""")
def stream_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of a meter's purchases in a year, handed out over three runs of a stream that goes on from its state: those of one batch; closed months are set aside."""
    rows = keep(purchases(spark, folder).select("lmPcode", "meterNo", "ym", "y", "txAtISO", "txAtMs", "amountTotalC", "costC"), "arriving")
    arriving, out, state = (_place(spark, n) for n in ("arriving", "numbered", "state"))
    before = ""
    for last in ARRIVALS:
        part = rows.where((F.col("ym") > before) & (F.col("ym") <= last))
        part.write.mode("append").parquet(arriving)
        before = last
        stream = with_stream_ids(spark.readStream.schema(rows.schema).parquet(arriving), ["ym", "txAtMs", "amountTotalC", "costC"], ["lmPcode", "meterNo", "y"], _CLOSED)
        write_numbered(stream, out, state, 4 * spark.sparkContext.defaultParallelism).awaitTermination()
    facts, conflicts = read_numbered(stream, out)
    none = F.lit(None).cast("string")
    shown = lambda df, id_, code: df.select(id_.alias("id"), "meterNo", "txAtISO", "amountTotalC", code.alias("code"))
    return shown(facts, F.col("atomicId"), none).unionByName(shown(conflicts, none, F.col("code")))
