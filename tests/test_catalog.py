"""Tables by name, replacements that are stopped half-way, and the resume block from footers."""

import pytest
from pyspark.sql import functions as F

from transferlens.sources import catalog, files, metadata, raw_logs, transfers
from tests.test_sources import blocks_of, log, logs_of, shown


def decoded(spark, *logs):
    return raw_logs.decode_transfers(logs_of(spark, *logs), blocks_of(spark, *range(200)))


@pytest.fixture(params=["path", "name"])
def table(spark, tmp_path, request):
    name = str(tmp_path / "table") if request.param == "path" else "ledger_of_tests"
    yield name
    if request.param == "name":
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_tables_by_name_or_path(spark, table):
    t = decoded(spark, log(1, 0, 1), log(50, 0, 2))
    both = t.unionByName(t.withColumn("chain_id", F.lit(10).cast("bigint")))
    assert not catalog.table_exists(spark, table) and transfers.drop_chain(spark, table, 10) == 0 and transfers.resume_block(spark, table, 10) == 0
    transfers.write_transfers(both, table)
    assert catalog.table_exists(spark, table)
    assert (table in catalog.list_tables(spark, pattern="ledger_*")) == catalog.is_name(table)
    assert transfers.resume_block(spark, table, 10) == 50 and transfers.resume_block(spark, table, 1) == 0
    transfers.write_transfers(decoded(spark, log(60, 0, 3)), table)
    assert shown(transfers.read_transfers(spark, table, 130)) == [(1, 0, "1"), (50, 0, "2"), (60, 0, "3")]
    assert transfers.drop_chain(spark, table, 10) == 2 and transfers.drop_chain(spark, table, 10) == 0
    assert {r.chain_id for r in transfers.read_transfers(spark, table).collect()} == {130}
    assert files.names(spark, f"{catalog.location(spark, table)}/chain_id=10") == []
    assert transfers.replace_last_block(spark, table, decoded(spark, log(60, 0, 4), log(61, 0, 5)), 130) == 60
    assert shown(transfers.read_transfers(spark, table)) == [(1, 0, "1"), (50, 0, "2"), (60, 0, "4"), (61, 0, "5")]


def test_metadata_by_name(spark):
    m = spark.createDataFrame([(c, f"0x{c}", "n", "s", 1) for c in (1, 10)], "chain_id bigint, contract_address string, name string, symbol string, decimals smallint")
    try:
        metadata.write_metadata(m.withColumn("created_at", F.current_timestamp()), "names_of_tests")
        metadata.write_metadata(m.filter("chain_id = 1").withColumn("name", F.lit("new")).withColumn("created_at", F.current_timestamp()), "names_of_tests")
        found = {(r.chain_id, r.name) for r in metadata.read_metadata(spark, "names_of_tests").collect()}
        assert found == {(1, "new"), (10, "n")}
    finally:
        spark.sql("DROP TABLE IF EXISTS names_of_tests")
    assert catalog.database_exists(spark, "default") and not catalog.database_exists(spark, "none")


class Stopped(Exception):
    pass


STEPS = ["staged", "recorded", "overwritten", "dropped", "closed"]


@pytest.mark.parametrize("step", STEPS)
def test_a_stopped_replacement_is_undone_or_finished(spark, table, monkeypatch, step):
    if catalog.is_name(table) and step != "overwritten":
        pytest.skip("the steps that do not depend on the catalog are tested by path")
    # Block 100 is the last one, and half of it moves to another day.
    transfers.write_transfers(decoded(spark, log(1, 0, 1), log(98, 0, 2), log(100, 0, 3), log(100, 1, 4)), table)
    before = shown(transfers.read_transfers(spark, table))
    new = decoded(spark, log(100, 0, 5), log(130, 0, 6)).withColumn("block_timestamp", F.expr("block_timestamp + INTERVAL 5 DAY"))
    after = sorted([(1, 0, "1"), (98, 0, "2"), (100, 0, "5"), (130, 0, "6")])

    def stop(*_, **__):
        raise Stopped

    with monkeypatch.context() as patch:
        if step == "staged":
            patch.setattr(files, "put_text", stop)
        elif step == "recorded":
            real, calls = transfers._save, []
            patch.setattr(transfers, "_save", lambda t, path, mode: stop() if mode == "overwrite" else real(t, path, mode))
        elif step == "overwritten":
            patch.setattr(catalog, "drop_partitions", stop)
        elif step == "dropped":
            patch.setattr(files, "delete", stop)
        else:
            real, calls = files.delete, []
            patch.setattr(files, "delete", lambda spark, path: stop() if calls else calls.append(real(spark, path)))
        with pytest.raises(Stopped):
            transfers.replace_last_block(spark, table, new, 130)
    assert shown(transfers.read_transfers(spark, table)) == (before if step == "staged" else after)
    assert files.names(spark, f"{catalog.location(spark, table)}/{transfers.PENDING}") == []
    assert transfers.replace_last_block(spark, table, new, 130) == (100 if step == "staged" else 130)
    assert shown(transfers.read_transfers(spark, table)) == after


def test_a_writer_finishes_what_is_pending_first(spark, table, monkeypatch):
    transfers.write_transfers(decoded(spark, log(1, 0, 1), log(2, 0, 2)), table)
    with monkeypatch.context() as patch:
        patch.setattr(transfers, "finish_pending", lambda *_: None)
        transfers.replace_last_block(spark, table, decoded(spark, log(2, 0, 3)), 130)
    transfers.write_transfers(decoded(spark, log(2, 1, 4)), table)
    assert shown(transfers.read_transfers(spark, table)) == [(1, 0, "1"), (2, 0, "3"), (2, 1, "4")]


def test_the_resume_block_reads_footers_only(spark, tmp_path):
    path = str(tmp_path / "table")
    transfers.write_transfers(decoded(spark, *(log(b, 0, 1) for b in range(1, 150, 7))), path)
    plan = catalog.highest(spark, path, "block_number", {"chain_id": 130})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(block_number)]" in text and plan.first()["highest"] == 148
    assert transfers.resume_block(spark, path, 130) == 148
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown", "false") == "false"
