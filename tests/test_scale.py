"""What a task holds, reads and writes does not grow with the input; nothing wide is cached."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import queries, views
from tests.test_sources import blocks_of, log, logs_of, shown
from transferlens import session
from transferlens.functions.amounts import U256Amounts, u256_from_hex, u256_from_text
from transferlens.sources import files, raw_logs, transfers
from transferlens.streaming.ingest import ingest_stream
from transferlens.streaming.kept import keep_aggregates, kept_balances

U = U256Amounts()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_cache(self, *_):
    raise AssertionError("nothing wide is cached")


def test_shuffles_get_as_many_partitions_as_rows_fill(spark, sf_dir, monkeypatch):
    df = spark.range(90)
    assert session.spread(df, 90, "id") is df
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    assert session.spread(df, 90, "id").rdd.getNumPartitions() == 9
    assert session.spread(df, 40, "id") is df
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    rows = views.table(spark, sf_dir, "lineitem").count()
    for view in (views.transfers, views.chain_transfers):
        assert executed(view(spark, sf_dir)).count(f"{-(-rows // 100)})") >= 2


def test_ingest_spread_by_rows_caches_nothing_and_lands_each_log_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 2)
    monkeypatch.setattr(DataFrame, "persist", no_cache)
    logs, blocks, table, rejects, checkpoint = (str(tmp_path / n) for n in ("logs", "blocks", "table", "rejects", "checkpoint"))
    first = [log(b, i, 10 * b + i) for b in range(1, 5) for i in range(3)]
    bad = [log(1, None, 6), log(1, 7, 7, data="0x01"), log(2, 9, 1, topics=None)]
    for known, delivered in ((range(1, 3), [*first, first[0], *bad]), (range(3, 6), [*first, log(5, 0, 50), log(5, 0, 50)])):
        blocks_of(spark, *known).write.mode("append").parquet(blocks)
        logs_of(spark, *delivered).write.mode("append").parquet(logs)
        ingest_stream(spark, logs, blocks, table, checkpoint, rejects_path=rejects).awaitTermination()
    expected = [(b, i, str(10 * b + i)) for b in range(1, 5) for i in range(3)] + [(5, 0, "50")]
    assert shown(transfers.read_transfers(spark, table)) == expected
    wanted = raw_logs.decode_rejects(logs_of(spark, *bad))
    found = spark.read.parquet(rejects).drop("batch")
    assert found.columns == wanted.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert not files.exists(spark, f"{checkpoint}/staged")


def test_kept_aggregates_cache_nothing(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(DataFrame, "persist", no_cache)
    table, kept = str(tmp_path / "table"), str(tmp_path / "kept")
    t = rows([("t", "a", "b", "5", "2024-01-01 00:00:00"), ("t", "b", "c", "2", "2024-01-02 00:00:00")])
    transfers.write_transfers(t.withColumn("transaction_hash", F.lit("0x")), table)
    keep_aggregates(spark, table, kept).awaitTermination()
    found = kept_balances(spark, kept).select("address", U.to_text(F.col("balance")).alias("balance")).collect()
    assert sorted(map(tuple, found)) == [("b", "3"), ("c", "2")]


def test_amounts_go_to_and_from_text_without_decimals(spark):
    values = [0, 7, 2**63 - 1, 2**63, 2**120, 10**77, 2**256 - 1]
    df = spark.createDataFrame([(str(v), format(v, "064x")) for v in values], "t string, h string").repartition(2)
    text = df.select("t", U.to_text(u256_from_hex(F.col("h"))).alias("of_hex"), U.to_text(u256_from_text(F.col("t"))).alias("of_text"))
    assert "decimal" not in executed(text).lower()
    assert all(r.of_hex == r.of_text == r.t for r in text.collect())
    for wrong in ("-1234567", " 12345678", "12x"):
        with pytest.raises(PySparkException):
            spark.createDataFrame([(wrong,)], "t string").select(u256_from_text(F.col("t"))).collect()


def test_replaced_rows_are_dealt_once(spark, rows, tmp_path, monkeypatch):
    path, saved, real = str(tmp_path / "table"), [], transfers._save
    old = rows([("t", "a", "b", str(i), f"2024-01-0{i} 00:00:00") for i in range(1, 4)]).withColumn("transaction_hash", F.lit("0x"))
    transfers.write_transfers(old.filter("block_number < 12"), path)
    monkeypatch.setattr(transfers, "_save", lambda t, to, mode: (saved.append(to), real(t, to, mode)))
    assert transfers.replace_last_block(spark, path, old, 130) == 11
    assert saved == [path] and shown(transfers.read_transfers(spark, path)) == shown(old)


def test_logs_are_staged_compressed(spark, sf_dir):
    assert all(f.endswith(".json.gz") for f in queries.raw_logs_source(spark, sf_dir).inputFiles())
