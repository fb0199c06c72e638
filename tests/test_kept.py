"""Kept balances and day sketches against the whole table, over batches out of time order, replays and merges."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from transferlens.functions.amounts import amounts_of
from transferlens.operators.ledger import token_balances
from transferlens.schema import ZERO_ADDRESS
from transferlens.sources import transfers
from transferlens.streaming.kept import kept_activity, kept_balances, keep_aggregates, merge_kept


def shown(balances):
    text = amounts_of(balances, "balance").to_text(F.col("balance"))
    return {(r.contract_address, r.address): r.x for r in balances.select("contract_address", "address", text.alias("x")).collect()}


def landed(rows, day, moves):
    t = rows([(token, a, b, str(v), f"{day} 10:00:00") for token, a, b, v in moves])
    return t.withColumn("transaction_hash", F.lit("0x1"))


def test_balances_over_batches_replays_and_merges(spark, rows, tmp_path):
    table, kept = str(tmp_path / "table"), str(tmp_path / "kept")
    assert kept_balances(spark, kept).isEmpty() and merge_kept(spark, kept) == 0
    rng = np.random.default_rng(3)
    accounts = [ZERO_ADDRESS, "a", "b", "c", "d"]
    for step, day in enumerate(["2024-03-05", "2024-01-31", "2024-02-10", "2024-02-09", "2023-12-31"]):
        moves = [(f"t{rng.integers(3)}", *map(str, rng.choice(accounts, 2)), 2**200 + int(rng.integers(9))) for _ in range(40)]
        transfers.write_transfers(landed(rows, day, moves), table)
        keep_aggregates(spark, table, kept).awaitTermination()
        whole = shown(token_balances(transfers.read_transfers(spark, table)))
        assert whole and shown(kept_balances(spark, kept, 130)) == whole
        if step == 2:
            assert merge_kept(spark, kept) == 2 and merge_kept(spark, kept) == 0
            assert shown(kept_balances(spark, kept)) == whole
    assert kept_balances(spark, kept, 1).isEmpty()
    # The last batch is replayed if its commit is lost, and counts once; also if it had not been written to its end.
    last = max(int(n) for n in os.listdir(f"{kept}/checkpoint/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.unlink(f"{kept}/checkpoint/commits/{name}")
    os.unlink(f"{kept}/balances/batch={last}/_SUCCESS")
    assert shown(kept_balances(spark, kept)) != whole
    keep_aggregates(spark, table, kept).awaitTermination()
    assert shown(kept_balances(spark, kept)) == whole
    assert kept_activity(spark, kept, period="year").agg(F.sum("transfers")).first()[0] == 200


def test_a_stopped_merge_changes_nothing(spark, rows, tmp_path, monkeypatch):
    from transferlens.streaming import kept as module

    table, kept = str(tmp_path / "table"), str(tmp_path / "kept")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        transfers.write_transfers(landed(rows, day, [("t", ZERO_ADDRESS, "a", 5)]), table)
        keep_aggregates(spark, table, kept).awaitTermination()

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(module.files, "delete", stop)
        with pytest.raises(KeyboardInterrupt):
            merge_kept(spark, kept)
    assert shown(kept_balances(spark, kept)) == {("t", "a"): "15"}
    merge_kept(spark, kept)
    assert shown(kept_balances(spark, kept)) == {("t", "a"): "15"}
    assert sorted(os.listdir(f"{kept}/balances")) == ["batch=2", "upto=1"]


def test_months_from_sketches_alone(spark, tmp_path):
    table, kept = str(tmp_path / "table"), str(tmp_path / "kept")
    users = F.concat(F.lit("0x"), F.lpad(F.hex(F.pmod(F.xxhash64("id"), F.lit(30_000))), 40, "0"))
    t = spark.range(120_000).select(
        F.lit(130).cast("bigint").alias("chain_id"), F.col("id").alias("block_number"), F.lit(0).cast("bigint").alias("log_index"),
        F.lit("0x1").alias("transaction_hash"), F.concat(F.lit("t"), F.col("id") % 7).alias("contract_address"),
        users.alias("from_address"), F.lit("b").alias("to_address"),
        F.struct(*(F.lit(0).cast("bigint").alias(f"w{i}") for i in range(4)), F.col("id").alias("w4")).alias("value"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 60 * 86400).alias("block_timestamp"),
    )
    for odd in (1, 0):
        transfers.write_transfers(t.filter(F.col("block_number") % 2 == odd), table)
        keep_aggregates(spark, table, kept).awaitTermination()
    months = kept_activity(spark, kept, period="month", chain_id=130)
    assert table not in months._jdf.queryExecution().toString()
    exact = {
        r.m: r
        for r in t.groupBy(F.trunc("block_timestamp", "month").alias("m"))
        .agg(F.count("*").alias("n"), F.countDistinct("from_address").alias("u"), F.percentile("block_number", F.array(F.lit(0.5), F.lit(0.9))).alias("q"))
        .collect()
    }
    found = months.collect()
    assert {r.period for r in found} == set(exact) and len(found) == 2
    for row in found:
        want = exact[row.period]
        assert (row.transfers, row.active_tokens, row.unique_receivers) == (want.n, 7, 1)
        assert row.unique_senders == pytest.approx(want.u, rel=0.03)
        assert row.size_quantiles[:2] == pytest.approx(list(want.q), rel=0.03)
