"""The command line, end to end."""

import json

import pytest

from tests.test_sources import blocks_of, log, logs_of
from transferlens.__main__ import arguments, main


def test_jobs(spark, tmp_path, capsys):
    paths = {name: str(tmp_path / name) for name in ("logs", "blocks", "table", "checkpoint", "files", "names", "out")}
    logs_of(spark, log(1, 0, 5), log(1, 1, 6)).write.parquet(paths["logs"])
    blocks_of(spark, 1).write.parquet(paths["blocks"])
    (tmp_path / "files").mkdir()
    token = {"0x" + "C" * 40: {"name": "Token", "symbol": "TOK", "decimals": 18}}
    (tmp_path / "files" / "tokenMetadata_130.json").write_text(json.dumps(token))

    stored = ["--table", paths["table"]]
    main(["ingest", "--logs", paths["logs"], "--blocks", paths["blocks"], "--checkpoint", paths["checkpoint"], *stored])
    main(["load-metadata", "--files", paths["files"], "--metadata", paths["names"]])
    options = ["--metadata", paths["names"], "--output", paths["out"], "--parameters", '{"limit": 1}']
    main(["query", "top_active_tokens", *stored, *options])
    row = spark.read.parquet(paths["out"]).first()
    assert (row.symbol, row.transfer_count, row.total_volume.w4) == ("TOK", 2, 11)
    main(["drop-chain", "--chain", "130", *stored])
    assert "2 transfers removed" in capsys.readouterr().out


def test_unknown_chain_is_refused():
    with pytest.raises(SystemExit):
        arguments(["drop-chain", "--chain", "5", "--table", "x"])
