"""Decoding, landing, resuming and metadata on small hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from transferlens.functions.amounts import amounts_of
from transferlens.schema import BLOCKS, RAW_LOGS, TRANSFER_TOPIC, check_chain, with_chain
from transferlens.sources import metadata, raw_logs, transfers
from transferlens.streaming.ingest import ingest_stream

A, B, TOKEN = ("0x" + c * 40 for c in "abc")


def word(n):
    return "0x" + format(n, "064x")


def padded(address):
    return "0x" + address[2:].rjust(64, "0")


def log(block, index, value, **changes):
    base = {
        "block_number": block,
        "log_index": index,
        "transaction_hash": word(block or 0),
        "address": TOKEN.upper().replace("0X", "0x"),
        "topics": [TRANSFER_TOPIC, padded(A), padded(B)],
        "data": word(value),
    }
    return tuple({**base, **changes}[f.name] for f in RAW_LOGS.fields)


def logs_of(spark, *logs):
    return spark.createDataFrame(list(logs), RAW_LOGS)


def blocks_of(spark, *numbers):
    return spark.createDataFrame([(n, 1_700_000_000 + n * 3600) for n in numbers], BLOCKS)


def shown(t):
    t = t.withColumn("value", amounts_of(t).to_text(F.col("value")))
    return sorted((r.block_number, r.log_index, r.value) for r in t.collect())


def test_decode_and_rejects(spark):
    logs = logs_of(
        spark,
        log(1, 0, 2**256 - 1),
        log(1, 1, 0, transaction_hash=None, address=None),
        log(1, None, 6),
        log(None, 7, 6),
        log(2, 0, 5, topics=[TRANSFER_TOPIC, padded(A), padded(B), word(9)]),
        log(2, 1, 5, data="0x01"),
        log(2, 2, 5, data=None),
        log(2, 3, 5, topics=[TRANSFER_TOPIC, None, padded(B)]),
        log(2, 4, 5, topics=None),
        log(2, 5, 5, topics=[word(1), padded(A), padded(B)]),
        log(3, 0, 7),
    )
    decoded = raw_logs.decode_transfers(logs, blocks_of(spark, 1, 2))
    assert shown(decoded) == [(1, 0, str(2**256 - 1)), (1, 1, "0"), (3, 0, "7")]
    by_value = {r.block_number: r for r in decoded.filter("value.w4 <> 0").collect()}
    first = by_value[1]
    assert (first.contract_address, first.from_address, first.to_address) == (TOKEN, A, B)
    assert first.chain_id == 130 and first.block_timestamp is not None
    # Block 3 has no block row: the time is the current one.
    assert by_value[3].block_timestamp.year >= 2024
    default = decoded.filter("value.w4 = 0").first()
    assert (default.transaction_hash, default.contract_address, default.log_index) == ("0x0", "0x0", 1)
    rejects = {r.log_index: r.reason for r in raw_logs.decode_rejects(logs).collect()}
    assert rejects == {
        0: "topic count is not 3",
        1: "data is not a 32-byte word",
        2: "data is not a 32-byte word",
        3: "topic is not a 32-byte word",
        None: "block number or log index is missing",
        7: "block number or log index is missing",
    }


def test_stream_with_late_duplicates_and_lost_checkpoint(spark, tmp_path):
    logs, blocks, table = (str(tmp_path / name) for name in ("logs", "blocks", "table"))

    def deliver(checkpoint, *batch):
        if batch:
            logs_of(spark, *batch).coalesce(1).write.mode("append").parquet(logs)
        query = ingest_stream(spark, logs, blocks, table, str(tmp_path / checkpoint), max_files=1)
        query.awaitTermination()
        return query

    blocks_of(spark, *range(1, 60)).write.parquet(blocks)
    first = [log(b, i, b * 10 + i) for b in range(1, 4) for i in range(2)]
    query = deliver("one", *first)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 6
    # The same logs again, two days of block time later, with new ones and a duplicate inside the batch.
    deliver("one", *first, log(55, 0, 1), log(55, 0, 1))
    deliver("one")
    expected = sorted((r[0], r[1], str(int(r[5], 16))) for r in [*first, log(55, 0, 1)])
    assert shown(transfers.read_transfers(spark, table)) == expected
    # A lost checkpoint reads every file again and still lands nothing twice.
    deliver("two")
    assert shown(transfers.read_transfers(spark, table)) == expected
    stats = transfers.ingest_stats(transfers.read_transfers(spark, table)).first()
    assert stats.total_events == 7 and stats.last_block == 55


def test_stream_logs_wait_for_their_block(spark, tmp_path):
    logs, blocks, table = (str(tmp_path / name) for name in ("logs", "blocks", "table"))

    def run(*batch, checkpoint="one"):
        if batch:
            logs_of(spark, *batch).coalesce(1).write.mode("append").parquet(logs)
        ingest_stream(spark, logs, blocks, table, str(tmp_path / checkpoint)).awaitTermination()
        t = transfers.read_transfers(spark, table)
        times = {r.block_number: r.s for r in t.selectExpr("block_number", "unix_timestamp(cast(block_timestamp AS timestamp)) AS s").collect()}
        assert all(s == 1_700_000_000 + n * 3600 for n, s in times.items())
        return shown(t)

    blocks_of(spark, 1).write.parquet(blocks)
    assert run(log(1, 0, 1), log(2, 0, 2), log(3, 0, 3), log(3, 0, 3)) == [(1, 0, "1")]
    assert run() == [(1, 0, "1")]
    blocks_of(spark, 2).write.mode("append").parquet(blocks)
    # Without new logs the next run lands what waited, once; with new logs the rest goes on waiting.
    assert run() == [(1, 0, "1"), (2, 0, "2")]
    for n in range(2):
        run(log(1, n + 1, 9))
    blocks_of(spark, 3).write.mode("append").parquet(blocks)
    everything = [(1, 0, "1"), (1, 1, "9"), (1, 2, "9"), (2, 0, "2"), (3, 0, "3")]
    assert run() == everything
    assert run(log(1, 0, 1)) == everything


def test_stream_lands_rejects_and_tells_totals(spark, tmp_path):
    logs, blocks, table, rejects = (str(tmp_path / name) for name in ("logs", "blocks", "table", "rejects"))
    blocks_of(spark, 1).write.parquet(blocks)
    batch = [log(1, 0, 4), log(1, 1, 5), log(1, None, 6), log(1, 2, 7, data="0x01"), log(1, 3, 8, topics=[word(1)])]
    logs_of(spark, *batch).coalesce(1).write.parquet(logs)
    query = ingest_stream(spark, logs, blocks, table, str(tmp_path / "checkpoint"), rejects_path=rejects)
    query.awaitTermination()
    assert sorted(r.reason for r in spark.read.parquet(rejects).collect()) == [
        "block number or log index is missing", "data is not a 32-byte word"]
    told = [p["observedMetrics"]["ingest"] for p in query.recentProgress if "ingest" in p["observedMetrics"]]
    assert [(int(m.events), int(m.rejects), int(m.total_value_12)) for m in told] == [(2, 2, 9)]
    assert shown(transfers.read_transfers(spark, table)) == [(1, 0, "4"), (1, 1, "5")]


def test_resume_after_cut_equals_one_run(spark, tmp_path):
    everything = raw_logs.decode_transfers(
        logs_of(spark, *(log(b, i, b * 10 + i) for b in range(1, 60, 7) for i in range(3))),
        blocks_of(spark, *range(60)),
    )
    path = str(tmp_path / "table")
    assert transfers.replace_last_block(spark, path, everything.filter("block_number < 1"), 130) == 0
    cut = everything.filter("block_number < 22 OR (block_number = 22 AND log_index = 0)")
    assert transfers.replace_last_block(spark, path, cut, 130) == 0
    assert transfers.replace_last_block(spark, path, everything, 130) == 22
    assert shown(transfers.read_transfers(spark, path)) == shown(everything)
    old = transfers.read_transfers(spark, path).drop("db_write_timestamp", "block_date")
    assert shown(transfers.replace_from_block(old, everything.select(*old.columns))) == shown(everything)
    empty = transfers.resume_point(old.limit(0)).first()
    assert empty.resume_block == 0


def test_day_and_chain_prune_partitions(spark, tmp_path):
    from transferlens.plans import activity

    t = raw_logs.decode_transfers(logs_of(spark, log(1, 0, 1), log(50, 0, 2)), blocks_of(spark, 1, 50))
    path = str(tmp_path / "table")
    transfers.write_transfers(t, path)
    landed = transfers.read_transfers(spark, path, 130)
    plans = [
        activity.today_activity(landed, day="2023-11-14"),
        activity.trending_tokens(landed, landed.selectExpr("contract_address", "'' AS name", "'' AS symbol"), as_of="2023-11-16 00:00:00"),
        activity.activity_between(landed, "2023-11-14 00:00:00", "2023-11-15 00:00:00"),
    ]
    for plan in plans:
        text = plan._jdf.queryExecution().executedPlan().toString()
        filters = text.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        assert "chain_id" in filters and "block_date" in filters
    text = activity.token_profile(landed, TOKEN)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(contract_address" in text


def test_drop_chain(spark, tmp_path):
    t = raw_logs.decode_transfers(logs_of(spark, log(1, 0, 1), log(50, 0, 2)), blocks_of(spark, 1, 50))
    both = t.unionByName(t.withColumn("chain_id", F.lit(10).cast("bigint")))
    path = str(tmp_path / "table")
    assert transfers.drop_chain(spark, path, 10) == 0
    transfers.write_transfers(both, path)
    assert transfers.drop_chain(spark, path, 1) == 0
    assert transfers.drop_chain(spark, path, 10) == 2
    assert {r.chain_id for r in transfers.read_transfers(spark, path).collect()} == {130}
    assert transfers.without_chain(both, 10).count() == 2
    with pytest.raises(ValueError):
        transfers.drop_chain(spark, path, 5)


def test_registry(spark):
    assert check_chain(8453) == 8453
    with pytest.raises(ValueError):
        check_chain(2)
    named = with_chain(spark.createDataFrame([(1,), (3,)], "chain_id bigint")).collect()
    assert {r.chain_id: r.chain_name for r in named} == {1: "Ethereum", 3: None}


def test_metadata_files(spark, tmp_path):
    good = {"name": "Good", "symbol": "GD", "decimals": 0}
    (tmp_path / "tokenMetadata_130.json").write_text(
        json.dumps(
            {
                "0xAbC": good,
                "0xabc": {**good, "name": "Later"},
                "0x1": {**good, "name": ""},
                "0x2": {"name": "x", "decimals": 1},
                "0x3": {**good, "decimals": "18"},
            },
            indent=1,
        )
    )
    (tmp_path / "tokenMetadata_10.json").write_text("not json")
    (tmp_path / "tokenMetadata_1.json").mkdir()
    for i in range(2):
        (tmp_path / "tokenMetadata_1.json" / f"{i}.json").write_text(json.dumps({f"0x{i}": good}))
    (tmp_path / "other.json").write_text("{}")
    loaded = metadata.load_metadata(spark, str(tmp_path))
    found = sorted((r.chain_id, r.contract_address, r.name, r.symbol, r.decimals) for r in loaded.collect())
    assert found == [(1, "0x0", "Good", "GD", 0), (1, "0x1", "Good", "GD", 0), (130, "0xabc", "Good", "GD", 0)]
    rejects = {(r.chain_id, r.contract_address): r.reason for r in metadata.metadata_rejects(spark, str(tmp_path)).collect()}
    assert rejects == {
        (10, None): "file is not a JSON object of tokens",
        (130, "0x1"): "name is missing or empty",
        (130, "0x2"): "symbol is missing or empty",
        (130, "0x3"): "decimals is not a number",
    }
    summary = {r.chain_id: (r.token_count, r.unique_symbols) for r in metadata.metadata_summary(loaded).collect()}
    assert summary == {1: (2, 1), 130: (1, 1)}


def test_a_last_block_that_moves_to_another_day_leaves_no_rows(spark, rows, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "moved")
    old = rows([("t", "a", "b", "1", "2024-01-01 00:00:00"), ("t", "a", "b", "2", "2024-01-02 00:00:00")])
    old = old.withColumn("transaction_hash", F.lit(None).cast("string"))
    transfers.write_transfers(old, path)
    before = {r.block_number: r.db_write_timestamp for r in transfers.read_transfers(spark, path, 130).collect()}
    new = old.filter("block_number = 11").withColumn("block_timestamp", F.to_timestamp(F.lit("2024-01-03 00:00:00")))
    assert transfers.replace_last_block(spark, path, new, 130) == 11
    after = transfers.read_transfers(spark, path, 130).collect()
    assert sorted((r.block_number, str(r.block_date)) for r in after) == [(10, "2024-01-01"), (11, "2024-01-03")]
    assert {r.block_number: r.db_write_timestamp for r in after}[10] == before[10]


def test_metadata_of_other_chains_stays(spark, tmp_path):
    import json

    folder, table = tmp_path / "in", str(tmp_path / "names")
    folder.mkdir()
    for chain, decimals in ((1, 18.0), (130, 6)):
        (folder / f"tokenMetadata_{chain}.json").write_text(json.dumps({"0xA": {"name": "A", "symbol": "A", "decimals": decimals}}))
    metadata.write_metadata(metadata.load_metadata(spark, str(folder)), table)
    (folder / "tokenMetadata_130.json").unlink()
    (folder / "tokenMetadata_1.json").write_text(json.dumps({"0xB": {"name": "B", "symbol": "B", "decimals": 8}, "0xC": {"name": "C", "symbol": "C", "decimals": 1.5}}))
    metadata.write_metadata(metadata.load_metadata(spark, str(folder)), table)
    found = {(r.chain_id, r.contract_address, r.decimals) for r in metadata.read_metadata(spark, table).collect()}
    assert found == {(1, "0xb", 8), (130, "0xa", 6)}
    assert [r.reason for r in metadata.metadata_rejects(spark, str(folder)).collect()] == ["decimals is not a whole number of 16 bits"]
