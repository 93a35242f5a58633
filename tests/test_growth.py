"""Work that must not stay in one task, and tables that must not be read more than once."""

from wattledger.plans import changes, governance
from wattledger.scratch import spread

FOLDER = "/root/testdata/sf0.001"


def test_documents_of_a_small_file_are_dealt_over_tasks(spark):
    many = 4 * spark.sparkContext.defaultParallelism
    assert spread(spark.range(1000).coalesce(1)).rdd.getNumPartitions() == many
    for rows in (governance._ids(spark, FOLDER), governance._geo(spark, FOLDER)):
        assert rows.rdd.getNumPartitions() == many


def test_both_states_of_the_store_come_from_one_pass_over_the_purchases(spark):
    sides = changes._documents(spark, FOLDER)
    for df in (*sides, changes._plan(spark, FOLDER, sides), *governance._wave_plan(spark, FOLDER)):
        assert not any("lineitem" in f for f in df.inputFiles())


def test_migration_plan_reads_documents_once(spark):
    """One row for each document, also of a repeated key, without meeting the documents with themselves; equal texts and equal contents are both unchanged."""
    import json

    from wattledger.operators import documents
    from wattledger.plans.governance import _MASTER_DOC

    whole = lambda key: "{" + ",".join(f'"{k}":{v}' for k, v in _MASTER_DOC.items()).replace("@", key) + "}"
    turned = json.dumps(dict(reversed(json.loads(whole("00000000002")).items())))
    rows = [("00000000001", whole("00000000001")), ("00000000001", "{}"), ("00000000002", turned), ("00000000003", whole("00000000003").replace('{"', '{"legacy":true,"', 1)), ("00000000004", "not json"), (None, whole("x"))]
    plan = documents.migration_plan(spark.createDataFrame(rows, "masterId string, doc string"), "doc")
    assert sorted((r["masterId"], r["classification"]) for r in plan.collect()) == [("00000000001", "CONFLICT"), ("00000000001", "UNCHANGED"), ("00000000002", "UNCHANGED"), ("00000000003", "UPDATED"), ("00000000004", "CONFLICT")]
    assert "Join" not in plan._jdf.queryExecution().executedPlan().toString()
