"""Running totals over several runs, replays and a listener, against the batch result."""

import os
import time

from pyspark.sql import functions as F

from transferlens.functions.amounts import amounts_of
from transferlens.sources import raw_logs
from transferlens.streaming.ingest import ingest_stream
from transferlens.streaming.totals import RunningTotals, ingest_totals
from tests.test_sources import blocks_of, log, logs_of, word


def kept(spark, checkpoint):
    totals = ingest_totals(spark, checkpoint)
    row = totals.withColumn("total_value", amounts_of(totals, "total_value").to_text(F.col("total_value"))).first()
    return row.events, row.rejects, int(row.total_value)


def test_totals_over_runs_replays_and_a_listener(spark, tmp_path):
    logs, blocks, table, checkpoint = (str(tmp_path / name) for name in ("logs", "blocks", "table", "checkpoint"))
    blocks_of(spark, *range(20)).write.parquet(blocks)
    assert kept(spark, checkpoint) == (0, 0, 0)
    runs = [
        [log(1, 0, 2**256 - 1), log(1, 1, 2**255), log(1, None, 6), log(1, 2, 7, data="0x01"), log(1, 3, 8, topics=[word(1)])],
        [log(2, i, 2**200 + i) for i in range(9)] + [log(2, 10, 5, topics=None)],
        [log(3, 0, 2**256 - 1), log(1, 0, 2**256 - 1)],
    ]
    listener, delivered = RunningTotals.since(spark, checkpoint), []
    spark.streams.addListener(listener)
    try:
        for run in runs:
            delivered += run
            # Two files, and so two batches, to a run.
            logs_of(spark, *run).repartition(2).write.mode("append").parquet(logs)
            ingest_stream(spark, logs, blocks, table, checkpoint, max_files=1).awaitTermination()
            whole = raw_logs.transfer_logs(logs_of(spark, *delivered))
            events = [int(r.data, 16) for r in whole.filter(raw_logs.decodable()).collect()]
            wanted = (len(events), raw_logs.decode_rejects(whole).count(), sum(events))
            assert kept(spark, checkpoint) == wanted and wanted[2] > 2**256
        for _ in range(100):
            if (listener.events, listener.rejects, listener.total_value) == wanted:
                break
            time.sleep(0.1)
        assert (listener.events, listener.rejects, listener.total_value) == wanted
    finally:
        spark.streams.removeListener(listener)
    # The last batch is replayed if its commit is lost, and counts once.
    last = max((int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()))
    for name in (str(last), f".{last}.crc"):
        os.unlink(f"{checkpoint}/commits/{name}")
    ingest_stream(spark, logs, blocks, table, checkpoint).awaitTermination()
    assert kept(spark, checkpoint) == wanted
    again = RunningTotals.since(spark, checkpoint)
    assert (again.events, again.rejects, again.total_value) == wanted
    assert len(os.listdir(f"{checkpoint}/totals")) <= 2
