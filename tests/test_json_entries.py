"""Metadata files cut into many byte ranges, against Python's JSON parser."""

import json
import random

import pytest
from pyspark.sql import functions as F

from transferlens.sources import json_entries, metadata

ODD = ["}", "{", '"', "\\", "}, ", '","0x1":{', '}, "0x1": {', "a\\\"}", "é}", "\n", "{\"a\":1}", "0x2", ":{", "", "x" * 100]


@pytest.fixture
def ranges(spark):
    """Sets the size of byte ranges for a test."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield cut
    for name, value in held.items():
        spark.conf.set(name, value)


def entry(rng):
    data = {"name": rng.choice(["Token", *ODD]), "symbol": rng.choice(["TOK", *ODD]), "decimals": rng.choice([18, 6, 0, 18.0, 1.5, "18", None, -3, 10**9, 1e2])}
    if rng.random() < 0.3:
        data["extra"] = rng.choice([{"a": {"b": [1, {"c": "}"}]}}, [], {}, {"0x9": {"name": "inner"}, "0x8": {}}, "}" * 3])
    return data


def wanted(token, data):
    """What a token is rejected for, or its row."""
    if not isinstance(data, dict):
        return "entry is not a JSON object"
    number = data.get("decimals")
    if not data.get("name"):
        return "name is missing or empty"
    if not data.get("symbol"):
        return "symbol is missing or empty"
    if not isinstance(number, (int, float)):
        return "decimals is not a number"
    if number != int(number) or not -32768 <= number <= 32767:
        return "decimals is not a whole number of 16 bits"
    return data["name"], data["symbol"], int(number)


def compare(spark, folder, objects):
    rows, rejects = set(), set()
    for chain, tokens in objects.items():
        for token, data in tokens.items():
            found = wanted(token, data)
            (rejects if isinstance(found, str) else rows).add((chain, token, found))
    loaded = metadata.load_metadata(spark, str(folder)).collect()
    assert {(r.chain_id, r.contract_address, (r.name, r.symbol, r.decimals)) for r in loaded} == rows and len(loaded) == len(rows)
    left = metadata.metadata_rejects(spark, str(folder)).collect()
    assert {(r.chain_id, r.contract_address, r.reason) for r in left} == rejects and len(left) == len(rejects)


@pytest.mark.parametrize("size", [37, 1000])
def test_ranges_cut_anywhere_change_nothing(spark, tmp_path, ranges, size):
    ranges(size)
    rng = random.Random(5)
    objects = {chain: {f"0x{i:x}": entry(rng) for i in range(1, 60)} for chain in (1, 10, 130)}
    objects[56] = {f"0x{i:x}": rng.choice([5, None, "}", [], [{"name": "}"}], entry(rng)]) for i in range(1, 30)}
    for chain, tokens in objects.items():
        text = json.dumps(tokens, indent=rng.choice([None, 1]), ensure_ascii=chain != 10)
        (tmp_path / f"tokenMetadata_{chain}.json").write_text(text + rng.choice(["", "\n", " \n\n"]))
    compare(spark, tmp_path, objects)


def test_a_large_file_loads_in_many_tasks(spark, tmp_path, ranges):
    ranges(1 << 20)
    tokens = {f"0x{i:040x}": {"name": f"Token {i} }}{{", "symbol": f"T{i}", "decimals": i % 19} for i in range(120_000)}
    (tmp_path / "tokenMetadata_1.json").write_text(json.dumps(tokens))
    pieces = json_entries.read_pieces(spark, str(tmp_path), metadata.FILE_NAME)
    assert pieces.rdd.getNumPartitions() >= 10
    loaded = metadata.load_metadata(spark, str(tmp_path))
    assert loaded.agg(F.count("*"), F.sum("decimals"), F.count_distinct("contract_address")).first()[:] == (120_000, sum(i % 19 for i in range(120_000)), 120_000)
    assert metadata.metadata_rejects(spark, str(tmp_path)).isEmpty()


BROKEN = {
    "a quote is missing": '"0x2": {"name": "No end, "symbol": "B", "decimals": 1}',
    "a brace is missing": '"0x2": {"name": "B", "symbol": "B", "decimals": 1',
    "a brace too many": '"0x2": {"name": "B", "symbol": "B", "decimals": 1}}',
    "no value": '"0x2": {"name": "B", "symbol": "B", "decimals": }',
    "no comma": '"0x2": {"name": "B" "symbol": "B", "decimals": 1}',
    "a bare word": '"0x2": {"name": oops, "symbol": "B", "decimals": 1}',
}


@pytest.mark.parametrize("size", [23, 10_000])
def test_a_broken_entry_costs_itself_alone(spark, tmp_path, ranges, size):
    ranges(size)
    good = '"0x{}": {{"name": "Good }}", "symbol": "G", "decimals": 1}}'
    for chain, (why, broken) in enumerate(BROKEN.items(), 1):
        for file, entries in enumerate([[good.format(1), broken, good.format(3), good.format(4)], [good.format(5), good.format(6), broken], [broken, good.format(7)]]):
            folder = tmp_path / f"tokenMetadata_{chain}.json"
            folder.mkdir(exist_ok=True)
            if "a brace" in why and entries[-1] == broken:
                entries.pop()  # at the end of a file it could as well be a brace of the object
            (folder / f"{file}.json").write_text("{" + ",\n".join(entries) + "}" + "\n" * file)
    loaded = metadata.load_metadata(spark, str(tmp_path)).collect()
    found = {(r.chain_id, r.contract_address) for r in loaded}
    rejects = {(r.chain_id, r.contract_address, r.reason) for r in metadata.metadata_rejects(spark, str(tmp_path)).collect()}
    for chain, why in enumerate(BROKEN, 1):
        assert {t for c, t in found if c == chain} == {f"0x{i}" for i in (1, 3, 4, 5, 6, 7)}, why
        assert {(t, r) for c, t, r in rejects if c == chain} == {("0x2", "entry is not valid JSON")}, why


def test_files_without_entries(spark, tmp_path):
    texts = {1: "not json", 10: "{}", 56: "[1, 2]", 130: " \n", 137: "5", 8453: ""}
    for chain, text in texts.items():
        (tmp_path / f"tokenMetadata_{chain}.json").write_text(text)
    assert metadata.load_metadata(spark, str(tmp_path)).isEmpty()
    rejects = metadata.metadata_rejects(spark, str(tmp_path)).collect()
    # An empty file has nothing to read and nothing to reject.
    assert sorted(r.chain_id for r in rejects) == [1, 10, 56, 130, 137]
    assert {(r.contract_address, r.reason) for r in rejects} == {(None, "file is not a JSON object of tokens")}
