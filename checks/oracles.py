"""Reference SQL (DuckDB) for every registered query, over the same driver tables."""

from __future__ import annotations

from checks.queries import TOKEN, USER
from checks.views import AS_OF, BURST, CENTS, PERIOD, SPREAD, TODAY, TOKEN as TOKEN_KEY
from transferlens.schema import CHAINS, TRANSFER_TOPIC, ZERO_ADDRESS


def _hex(number: str, width: int) -> str:
    return f"lpad(lower(hex(cast({number} AS BIGINT))), {width}, '0')"


def _addr(number: str) -> str:
    return f"'0x' || {_hex(number, 40)}"


TRANSFERS = f"""
transfers AS (
  SELECT l_orderkey AS block_number, cast(l_linenumber AS BIGINT) AS log_index,
         {_addr(TOKEN_KEY)} AS contract_address, {_addr('l_suppkey')} AS from_address,
         {_addr('o_custkey')} AS to_address,
         cast(cast({CENTS} AS BIGINT) AS DECIMAL(38,0)) AS value,
         timestamp '2024-01-01 00:00:00' + to_seconds(
           CASE WHEN l_suppkey % 10 = 1 THEN {BURST} ELSE {SPREAD} END) AS block_timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

PARTS = """
parts AS (
  SELECT p_partkey, p_size, CASE WHEN p_size = 41 THEN '' ELSE p_name END AS name,
         CASE WHEN p_size = 13 THEN '' WHEN p_partkey % 6 = 0 THEN 'USD' || p_partkey
              WHEN p_partkey % 6 = 1 THEN 'usdc' ELSE p_brand END AS symbol,
         cast(CASE p_partkey % 5 WHEN 0 THEN 6 WHEN 1 THEN 8 WHEN 2 THEN 9 ELSE 18 END AS SMALLINT) AS decimals
  FROM part
)"""

METADATA = f"""{PARTS},
metadata AS (
  SELECT {_addr('p_partkey + 1000')} AS contract_address, name, symbol, decimals
  FROM parts WHERE p_size NOT IN (41, 13, 29)
)"""

CHAIN = f"""
lines AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_suppkey, o_custkey,
         {TOKEN_KEY} AS token, cast({CENTS} AS BIGINT) AS cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
chain AS (
  SELECT cast(130 AS BIGINT) AS chain_id, l_orderkey AS block_number,
         timestamp '2024-01-01 00:00:00' + to_seconds((l_orderkey * 7919) % {PERIOD}) AS block_timestamp,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, token, l_suppkey, o_custkey, cents, l_returnflag) - 1 AS log_index,
         '0x' || {_hex('l_orderkey', 64)} AS transaction_hash,
         {_addr('token')} AS contract_address, {_addr('l_suppkey')} AS from_address,
         {_addr('o_custkey')} AS to_address, cents, l_linenumber, l_returnflag
  FROM lines
)"""

LOGS = f"""{CHAIN},
logs AS (
  SELECT block_number, log_index, transaction_hash, '0x' || upper(substr(contract_address, 3)) AS address,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN '0x' || repeat('1', 64)
              ELSE '{TRANSFER_TOPIC}' END AS topic0,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 5 THEN from_address
              ELSE '0x' || lpad(substr(from_address, 3), 64, '0') END AS topic1,
         '0x' || lpad(substr(to_address, 3), 64, '0') AS topic2,
         CASE WHEN l_linenumber = 7 THEN ',0x' || {_hex('cents', 64)} ELSE '' END AS more,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN substr('0x' || {_hex('cents', 64)}, 1, 40)
              ELSE '0x' || {_hex('cents', 64)} END AS data
  FROM chain
)"""

DECODED = f"""{CHAIN},
decoded AS (
  SELECT chain_id, block_number, block_timestamp, log_index, transaction_hash, contract_address,
         from_address, to_address, cast(cents AS VARCHAR) AS value
  FROM chain
  WHERE l_linenumber <> 7 AND NOT (l_returnflag = 'R' AND l_linenumber IN (4, 5, 6))
)"""

UNTIDY = f"""{CHAIN},
untidy AS (
  SELECT block_number, log_index,
         CASE WHEN l_linenumber = 5 THEN transaction_hash || repeat(l_returnflag, 90)
              ELSE transaction_hash END AS transaction_hash,
         contract_address,
         CASE WHEN l_linenumber = 3 THEN from_address || 'ffff' ELSE from_address END AS from_address,
         CASE WHEN l_linenumber <> 2 THEN to_address END AS to_address,
         CASE WHEN l_linenumber = 6 THEN cast(cents || repeat('0', 25) AS DECIMAL(38,0))
              ELSE cast(cents AS DECIMAL(38,0)) END AS value
  FROM chain
)"""

DOCUMENTS = f"""{PARTS},
entries AS (
  SELECT CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 130 ELSE 8453 END AS chain_id, p_size, p_partkey,
         name, symbol, decimals
  FROM parts
),
loaded AS (
  SELECT cast(chain_id AS BIGINT) AS chain_id, {_addr('p_partkey + 1000')} AS contract_address, name, symbol, decimals
  FROM entries WHERE p_size NOT IN (41, 13, 29)
)"""

LEDGER = f"""{TRANSFERS},
balances AS (
  SELECT contract_address, address, cast(sum(delta) AS DECIMAL(38,0)) AS balance
  FROM (SELECT contract_address, to_address AS address, value AS delta FROM transfers
        UNION ALL
        SELECT contract_address, from_address, -value FROM transfers)
  WHERE address <> '{ZERO_ADDRESS}'
  GROUP BY contract_address, address
  HAVING sum(delta) > 0
)"""

# Amounts beyond DuckDB's integers, as two numbers: the value is upper * 10^58 + lower.
HUGE = f"""{METADATA},
{TRANSFERS},
huge AS (
  SELECT *, cast(value AS HUGEINT) * 100000000000 + block_number AS upper, cast(value AS HUGEINT) * 10000000000 + log_index AS lower
  FROM transfers
)"""

ALL_CHAINS = f"""{TRANSFERS},
chains AS (
  SELECT * REPLACE (block_number AS block_number),
         CASE cast('0x' || right(contract_address, 8) AS BIGINT) % 3
              WHEN 0 THEN 1 WHEN 1 THEN 130 ELSE 8453 END AS chain_id
  FROM transfers
)"""

REGISTRY = "registry(chain_id, chain_name) AS (VALUES " + ", ".join(
    f"({i}, '{name}')" for i, name in CHAINS.items()
) + ")"

VOLUME = "cast(sum(value) AS DECIMAL(38,0))"
SECONDS_SPAN = "date_diff('second', min(block_timestamp), max(block_timestamp))"


def _mean(count: str = "count(*)") -> str:
    return f"round(cast(sum(value) AS DOUBLE) / {count}, 4)"


# Amount columns, printed as digits.
AMOUNTS = {
    "sanitize_transfers": ["value"],
    "ecosystem_summary": ["total_volume"],
    "top_active_tokens": ["total_volume"],
    "daily_activity": ["daily_volume"],
    "today_activity": ["today_volume"],
    "trending_tokens": ["recent_volume"],
    "monthly_growth": ["monthly_volume"],
    "token_profile": ["total_volume"],
    "user_activity": ["total_value"],
    "activity_between": ["daily_volume"],
    "volume_leaders": ["total_volume", "largest_transfer"],
    "whale_transfers": ["value"],
    "minting_activity": ["total_minted"],
    "top_senders": ["total_sent_volume"],
    "top_receivers": ["total_received_volume"],
    "holder_distribution": ["balance"],
    "user_portfolio": ["balance"],
    "token_concentration": ["top_10_holders_balance"],
    "airdrop_candidates": ["total_distributed"],
    "token_balances": ["balance"],
    "stream_daily_activity": ["daily_volume"],
}


def _printed(sql: str, amounts: list[str]) -> str:
    casts = ", ".join(f"cast({name} AS VARCHAR) AS {name}" for name in amounts)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})" if amounts else sql


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()


def _since(days: int) -> str:
    end = f"timestamp '{AS_OF}'"
    return f"(block_timestamp >= {end} - INTERVAL {days} DAY AND block_timestamp <= {end})"


def _before(days: int) -> str:
    return f"block_timestamp < timestamp '{AS_OF}' - INTERVAL {days} DAY"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # jobs
    sql["raw_logs_source"] = _with(
        LOGS,
        body=f"""SELECT block_number, log_index, transaction_hash, address,
                 topic0 || ',' || topic1 || ',' || topic2 || more AS topics, data
          FROM logs WHERE topic0 = '{TRANSFER_TOPIC}'""",
    )
    sql["decode_transfers"] = _with(DECODED, body="SELECT * FROM decoded")
    sql["ingest_stream"] = sql["decode_transfers"]
    sql["decode_rejects"] = _with(
        LOGS,
        body=f"""SELECT block_number, log_index, transaction_hash, address,
                 topic0 || ',' || topic1 || ',' || topic2 || more AS topics, data,
                 CASE WHEN more <> '' THEN 'topic count is not 3'
                      WHEN length(topic1) <> 66 THEN 'topic is not a 32-byte word'
                      ELSE 'data is not a 32-byte word' END AS reason
          FROM logs
          WHERE topic0 = '{TRANSFER_TOPIC}' AND (more <> '' OR length(topic1) <> 66 OR length(data) <> 66)""",
    )
    sql["ingest_rejects"] = sql["decode_rejects"]
    sql["sanitize_transfers"] = _with(
        UNTIDY,
        body="""SELECT block_number, log_index, substr(transaction_hash, 1, 66) AS transaction_hash,
                 contract_address, substr(from_address, 1, 42) AS from_address,
                 coalesce(to_address, '') AS to_address, value
          FROM untidy""",
    )
    sql["oversize_audit"] = _with(
        UNTIDY,
        body="""SELECT block_number, log_index, 'transaction_hash' AS field,
                 cast(length(transaction_hash) AS INTEGER) AS length, substr(transaction_hash, 1, 50) AS sample
          FROM untidy WHERE length(transaction_hash) > 100
          UNION ALL
          SELECT block_number, log_index, 'value', cast(length(cast(value AS VARCHAR)) AS INTEGER),
                 cast(value AS VARCHAR)
          FROM untidy WHERE value > 1000000000000000000000000000000""",
    )
    chain_rows = """SELECT chain_id, block_number, block_timestamp, log_index, transaction_hash,
                           contract_address, from_address, to_address, cast(cents AS VARCHAR) AS value"""
    sql["write_transfers"] = _with(
        CHAIN, body=chain_rows + ", cast(block_timestamp AS DATE) AS block_date FROM chain"
    )
    sql["replace_last_block"] = _with(CHAIN, body=chain_rows + " FROM chain")
    sql["resume_point"] = _with(
        TRANSFERS, body="SELECT coalesce(max(block_number), 0) AS resume_block FROM transfers"
    )
    sql["ingest_stats"] = _with(
        CHAIN,
        body="""SELECT count(*) AS total_events, cast(cast(sum(cents) AS DECIMAL(38,0)) AS VARCHAR) AS total_value,
                 max(block_number) AS last_block,
                 round(cast(count(*) AS DOUBLE) / date_diff('second', date_trunc('day', min(block_timestamp)),
                       date_trunc('day', max(block_timestamp))), 4) AS events_per_second
          FROM chain""",
    )
    decodable = "l_linenumber <> 7 AND NOT (l_returnflag = 'R' AND l_linenumber IN (4, 5, 6))"
    sql["ingest_totals"] = _with(
        CHAIN,
        body=f"""SELECT count(*) FILTER ({decodable}) AS events,
                 count(*) FILTER (NOT ({decodable}) AND NOT (l_returnflag = 'R' AND l_linenumber = 4)) AS rejects,
                 cast(cast(sum(cents) FILTER ({decodable}) AS DECIMAL(38,0)) AS VARCHAR) AS total_value
          FROM chain""",
    )
    sql["resume_block"] = _with(CHAIN, body="SELECT max(block_number) AS resume_block FROM chain")
    sql["catalog_table"] = _with(
        ALL_CHAINS,
        body=f"""SELECT cast(chain_id AS BIGINT) AS chain_id, count(*) AS transfers, max(block_number) AS last_block,
                 cast({VOLUME} AS VARCHAR) AS total_value
          FROM chains WHERE chain_id <> 8453 GROUP BY chain_id""",
    )
    sql["load_metadata"] = _with(DOCUMENTS, body="SELECT * FROM loaded")
    sql["metadata_rejects"] = _with(
        DOCUMENTS,
        body=f"""SELECT cast(chain_id AS BIGINT) AS chain_id,
                 '0x' || upper({_hex('p_partkey + 1000', 40)}) AS contract_address, name, symbol,
                 CASE WHEN p_size <> 29 THEN decimals END AS decimals,
                 CASE p_size WHEN 41 THEN 'name is missing or empty' WHEN 13 THEN 'symbol is missing or empty'
                      ELSE 'decimals is not a number' END AS reason
          FROM entries WHERE p_size IN (41, 13, 29)""",
    )
    sql["metadata_chain_summary"] = _with(
        DOCUMENTS,
        body="""SELECT chain_id, count(*) AS token_count, count(DISTINCT symbol) AS unique_symbols
          FROM loaded GROUP BY chain_id""",
    )
    sql["chain_registry"] = _with(
        ALL_CHAINS,
        REGISTRY,
        body="""SELECT counts.chain_id, chain_name, transfers, chain_name IS NOT NULL AS known
          FROM (SELECT cast(CASE WHEN log_index = 7 THEN 999 ELSE chain_id END AS BIGINT) AS chain_id,
                       count(*) AS transfers
                FROM chains GROUP BY 1) counts
          LEFT JOIN registry ON counts.chain_id = registry.chain_id""",
    )
    sql["drop_chain"] = _with(
        ALL_CHAINS,
        body="""SELECT cast(chain_id AS BIGINT) AS chain_id, count(*) AS transfers FROM chains
          WHERE chain_id <> 8453 GROUP BY chain_id""",
    )

    # activity
    sql["ecosystem_summary"] = _with(
        TRANSFERS,
        body=f"""SELECT count(*) AS total_transfers, count(DISTINCT contract_address) AS unique_tokens,
                 count(DISTINCT from_address) AS unique_senders, count(DISTINCT to_address) AS unique_receivers,
                 {VOLUME} AS total_volume, min(block_timestamp) AS earliest_activity,
                 max(block_timestamp) AS latest_activity
          FROM transfers""",
    )
    sql["top_active_tokens"] = _with(
        TRANSFERS,
        METADATA,
        body=f"""SELECT contract_address, name, symbol, count(*) AS transfer_count,
                 count(DISTINCT from_address) AS unique_senders, count(DISTINCT to_address) AS unique_receivers,
                 {VOLUME} AS total_volume
          FROM transfers LEFT JOIN metadata USING (contract_address)
          GROUP BY contract_address, name, symbol
          ORDER BY transfer_count DESC, contract_address LIMIT 20""",
    )
    sql["daily_activity"] = _with(
        TRANSFERS,
        body=f"""SELECT cast(block_timestamp AS DATE) AS date, count(*) AS daily_transfers,
                 count(DISTINCT contract_address) AS active_tokens, count(DISTINCT from_address) AS unique_users,
                 {VOLUME} AS daily_volume
          FROM transfers WHERE {_since(30)}
          GROUP BY 1 ORDER BY date DESC LIMIT 30""",
    )
    sql["hourly_pattern"] = _with(
        TRANSFERS,
        body=f"""SELECT hour(block_timestamp) AS hour_of_day, count(*) AS transfer_count,
                 count(DISTINCT from_address) AS unique_users, {_mean()} AS avg_transfer_value
          FROM transfers WHERE {_since(7)} GROUP BY 1""",
    )
    sql["today_activity"] = _with(
        TRANSFERS,
        body=f"""SELECT contract_address, count(*) AS today_transfers,
                 count(DISTINCT from_address) AS unique_senders, {VOLUME} AS today_volume
          FROM transfers WHERE cast(block_timestamp AS DATE) = date '{TODAY}'
          GROUP BY contract_address ORDER BY today_transfers DESC, contract_address LIMIT 15""",
    )
    sql["trending_tokens"] = _with(
        TRANSFERS,
        METADATA,
        body=f"""SELECT contract_address, name, symbol, count(*) AS recent_transfers,
                 count(DISTINCT from_address) AS recent_users, {VOLUME} AS recent_volume
          FROM transfers LEFT JOIN metadata USING (contract_address) WHERE {_since(7)}
          GROUP BY contract_address, name, symbol
          ORDER BY recent_transfers DESC, contract_address LIMIT 20""",
    )
    sql["monthly_growth"] = _with(
        TRANSFERS,
        body=f"""SELECT cast(year(block_timestamp) * 100 + month(block_timestamp) AS INTEGER) AS month,
                 count(*) AS monthly_transfers, count(DISTINCT contract_address) AS active_tokens,
                 count(DISTINCT from_address) AS active_users, {VOLUME} AS monthly_volume
          FROM transfers GROUP BY 1 ORDER BY month DESC LIMIT 12""",
    )
    sql["day_of_week_pattern"] = _with(
        TRANSFERS,
        body=f"""SELECT dayname(block_timestamp) AS day_name, count(*) AS transfers,
                 count(DISTINCT from_address) AS unique_users, {_mean()} AS avg_transfer_value
          FROM transfers WHERE {_since(30)} GROUP BY 1""",
    )
    sql["chain_overview"] = _with(
        ALL_CHAINS,
        REGISTRY,
        body="""SELECT chain_name, cast(chain_id AS BIGINT) AS chain_id, count(*) AS total_transfers,
                 count(DISTINCT contract_address) AS unique_tokens, count(DISTINCT from_address) AS unique_senders,
                 count(DISTINCT to_address) AS unique_receivers, min(block_timestamp) AS earliest_activity,
                 max(block_timestamp) AS latest_activity
          FROM chains JOIN registry USING (chain_id) GROUP BY chain_id, chain_name""",
    )
    sql["token_profile"] = _with(
        TRANSFERS,
        body=f"""SELECT count(*) AS total_transfers, count(DISTINCT from_address) AS unique_senders,
                 count(DISTINCT to_address) AS unique_receivers, {VOLUME} AS total_volume,
                 min(block_timestamp) AS first_transfer, max(block_timestamp) AS latest_transfer,
                 {_mean()} AS average_transfer
          FROM transfers WHERE contract_address = '{TOKEN}'""",
    )
    sql["user_activity"] = _with(
        TRANSFERS,
        body=f"""SELECT 'Sent' AS direction, count(*) AS transaction_count,
                 count(DISTINCT contract_address) AS unique_tokens, coalesce({VOLUME}, 0) AS total_value
          FROM transfers WHERE from_address = '{USER}'
          UNION ALL
          SELECT 'Received', count(*), count(DISTINCT contract_address), coalesce({VOLUME}, 0)
          FROM transfers WHERE to_address = '{USER}'""",
    )
    sql["activity_between"] = _with(
        TRANSFERS,
        body=f"""SELECT cast(block_timestamp AS DATE) AS date, count(*) AS daily_transfers,
                 count(DISTINCT contract_address) AS active_tokens, {VOLUME} AS daily_volume
          FROM transfers
          WHERE block_timestamp BETWEEN timestamp '2024-02-01 00:00:00' AND timestamp '2024-03-15 12:00:00'
          GROUP BY 1""",
    )

    # tokens
    leaders = """SELECT contract_address, name, symbol, decimals, count(*) AS transfer_count,
                 {total} AS total_volume, {mean} AS avg_transfer_size, {largest} AS largest_transfer
          FROM transfers LEFT JOIN metadata USING (contract_address)
          GROUP BY contract_address, name, symbol, decimals
          ORDER BY sum(value) DESC, contract_address LIMIT 20"""
    sql["volume_leaders"] = _with(
        TRANSFERS, METADATA, body=leaders.format(total=VOLUME, mean=_mean(), largest="max(value)")
    )
    sql["volume_leaders_u256"] = _with(
        TRANSFERS,
        METADATA,
        body=leaders.format(
            total=f"cast({VOLUME} AS VARCHAR)", mean=_mean(), largest="cast(max(value) AS VARCHAR)"
        ),
    )
    quantile = "round(quantile_cont(cast(value AS DOUBLE), {q}), 4)"
    sql["transfer_size_distribution"] = _with(
        TRANSFERS,
        METADATA,
        body=f"""SELECT contract_address, symbol, count(*) AS transfers,
                 {quantile.format(q=0.5)} AS median_transfer, {quantile.format(q=0.9)} AS p90_transfer,
                 {quantile.format(q=0.99)} AS p99_transfer
          FROM transfers LEFT JOIN metadata USING (contract_address)
          GROUP BY contract_address, symbol HAVING count(*) > 1000
          ORDER BY transfers DESC, contract_address LIMIT 15""",
    )
    sql["whale_transfers"] = _with(
        TRANSFERS,
        METADATA,
        body="""SELECT contract_address, symbol, from_address, to_address, value, block_timestamp
          FROM transfers LEFT JOIN metadata USING (contract_address)
          WHERE cast(value AS DOUBLE) > (SELECT quantile_cont(cast(value AS DOUBLE), 0.999) FROM transfers)
          ORDER BY value DESC, contract_address, block_timestamp, from_address, to_address LIMIT 50""",
    )
    sql["fastest_growing"] = _with(
        TRANSFERS,
        METADATA,
        body=f"""SELECT contract_address, symbol, recent_transfers, historical_transfers,
                 round(cast(recent_transfers AS DOUBLE) / historical_transfers * 100, 4) AS growth_rate_percent
          FROM (SELECT contract_address, count(*) FILTER ({_since(30)}) AS recent_transfers,
                       count(*) FILTER ({_before(30)}) AS historical_transfers
                FROM transfers GROUP BY contract_address) tokens
          LEFT JOIN metadata USING (contract_address)
          WHERE recent_transfers > 100 AND historical_transfers > 100
          ORDER BY cast(recent_transfers AS DOUBLE) / historical_transfers * 100 DESC, contract_address LIMIT 20""",
    )
    sql["minting_activity"] = _with(
        TRANSFERS,
        METADATA,
        body=f"""SELECT contract_address, name, symbol, count(*) AS mint_events, {VOLUME} AS total_minted,
                 count(DISTINCT to_address) AS unique_recipients
          FROM transfers LEFT JOIN metadata USING (contract_address)
          WHERE from_address = '{ZERO_ADDRESS}'
          GROUP BY contract_address, name, symbol ORDER BY total_minted DESC, contract_address LIMIT 20""",
    )
    sql["token_velocity"] = _with(
        TRANSFERS,
        METADATA,
        body=f"""SELECT contract_address, symbol, transfers, unique_addresses,
                 round(cast(transfers AS DOUBLE) / unique_addresses, 4) AS velocity_ratio,
                 round(per_hour, 4) AS transfers_per_hour
          FROM (SELECT contract_address, symbol, count(*) AS transfers,
                       count(DISTINCT from_address) + count(DISTINCT to_address) AS unique_addresses,
                       cast(count(*) AS DOUBLE) / (cast({SECONDS_SPAN} AS DOUBLE) / 3600.0) AS per_hour
                FROM transfers LEFT JOIN metadata USING (contract_address)
                GROUP BY contract_address, symbol HAVING count(*) >= 1000)
          ORDER BY per_hour DESC NULLS LAST, contract_address LIMIT 25""",
    )

    # holders
    for key, column, count, used, volume in (
        ("top_senders", "from_address", "transactions_sent", "tokens_used", "total_sent_volume"),
        ("top_receivers", "to_address", "transactions_received", "tokens_received", "total_received_volume"),
    ):
        sql[key] = _with(
            TRANSFERS,
            body=f"""SELECT {column}, count(*) AS {count}, count(DISTINCT contract_address) AS {used},
                     {VOLUME} AS {volume}
              FROM transfers GROUP BY {column} HAVING count(*) > 10
              ORDER BY {count} DESC, {column} LIMIT 50""",
        )
    sql["multi_token_users"] = _with(
        TRANSFERS,
        body="""SELECT address, max(token_count) AS max_token_count,
                 cast(sum(interactions) AS BIGINT) AS total_interactions
          FROM (SELECT from_address AS address, count(DISTINCT contract_address) AS token_count,
                       count(*) AS interactions
                FROM transfers GROUP BY from_address
                UNION ALL
                SELECT to_address, count(DISTINCT contract_address), count(*) FROM transfers GROUP BY to_address)
          GROUP BY address HAVING max(token_count) >= 5
          ORDER BY max_token_count DESC, total_interactions DESC, address LIMIT 30""",
    )
    sql["token_balances"] = _with(LEDGER, body="SELECT * FROM balances")
    sql["token_balances_u256"] = _with(
        LEDGER, body="SELECT contract_address, address, cast(balance AS VARCHAR) AS balance FROM balances"
    )
    sql["volume_leaders_huge"] = _with(
        HUGE,
        body="""SELECT contract_address, name, symbol, decimals, transfer_count,
                 ltrim(u || lpad(cast(l AS VARCHAR), 58, '0'), '0') AS total_volume, ltrim(largest, '0') AS largest_transfer
          FROM (SELECT contract_address, count(*) AS transfer_count, sum(upper) AS u, sum(lower) AS l,
                       max(lpad(cast(upper AS VARCHAR), 20, '0') || lpad(cast(lower AS VARCHAR), 58, '0')) AS largest
                FROM huge GROUP BY contract_address)
          LEFT JOIN metadata USING (contract_address)
          ORDER BY u DESC, l DESC, contract_address LIMIT 20""",
    )
    sql["token_balances_huge"] = _with(
        HUGE,
        body=f"""SELECT contract_address, address, ltrim(
                 CASE WHEN l >= 0 THEN u || lpad(cast(l AS VARCHAR), 58, '0')
                      ELSE (u - 1) || repeat('9', 20) || lpad(cast(100000000000000000000000000000000000000::HUGEINT + l AS VARCHAR), 38, '0') END,
                 '0') AS balance
          FROM (SELECT contract_address, address, sum(u) AS u, sum(l) AS l
                FROM (SELECT contract_address, to_address AS address, upper AS u, lower AS l FROM huge
                      UNION ALL
                      SELECT contract_address, from_address, -upper, -lower FROM huge)
                WHERE address <> '{ZERO_ADDRESS}' GROUP BY contract_address, address)
          WHERE u > 0 OR (u = 0 AND l > 0)""",
    )
    sql["kept_balances"] = sql["token_balances_u256"]
    sql["holder_distribution"] = _with(
        LEDGER,
        body=f"""SELECT address AS holder_address, balance,
                 round(cast(balance AS DOUBLE) * 100.0 / sum(cast(balance AS DOUBLE)) OVER (), 4)
                   AS percentage_of_supply
          FROM balances WHERE contract_address = '{TOKEN}'
          ORDER BY balance DESC, holder_address LIMIT 100""",
    )
    sql["user_portfolio"] = _with(
        TRANSFERS,
        METADATA,
        body=f"""SELECT contract_address, name, symbol, cast(sum(delta) AS DECIMAL(38,0)) AS balance
          FROM (SELECT contract_address, value AS delta FROM transfers WHERE to_address = '{USER}'
                UNION ALL
                SELECT contract_address, -value FROM transfers WHERE from_address = '{USER}')
          LEFT JOIN metadata USING (contract_address)
          GROUP BY contract_address, name, symbol HAVING sum(delta) > 0
          ORDER BY balance DESC, contract_address LIMIT 50""",
    )
    sql["token_concentration"] = _with(
        LEDGER,
        METADATA,
        body="""SELECT contract_address, symbol, total_holders, top_10_holders_balance,
                 round(cast(top_10_holders_balance AS DOUBLE) * 100.0 / cast(supply AS DOUBLE), 4)
                   AS concentration_percent
          FROM (SELECT contract_address, count(*) AS total_holders, sum(balance) AS supply,
                       cast(sum(balance) FILTER (place <= 10) AS DECIMAL(38,0)) AS top_10_holders_balance
                FROM (SELECT *, row_number() OVER (PARTITION BY contract_address
                                                   ORDER BY balance DESC, address) AS place
                      FROM balances)
                GROUP BY contract_address HAVING count(*) >= 50)
          LEFT JOIN metadata USING (contract_address)
          ORDER BY cast(top_10_holders_balance AS DOUBLE) * 100.0 / cast(supply AS DOUBLE) DESC, contract_address
          LIMIT 20""",
    )
    sql["airdrop_candidates"] = _with(
        TRANSFERS,
        METADATA,
        body=f"""SELECT contract_address, symbol, from_address AS distributor,
                 count(DISTINCT to_address) AS unique_recipients, count(*) AS total_distributions,
                 {VOLUME} AS total_distributed, min(block_timestamp) AS first_distribution,
                 max(block_timestamp) AS last_distribution
          FROM transfers LEFT JOIN metadata USING (contract_address)
          GROUP BY contract_address, symbol, from_address
          HAVING count(DISTINCT to_address) >= 50 AND count(*) >= 50
             AND {SECONDS_SPAN} <= 7 * 86400
          ORDER BY unique_recipients DESC, contract_address, distributor LIMIT 25""",
    )

    # discovery
    sql["symbol_search"] = _with(
        METADATA,
        body="""SELECT 'Unichain' AS chain_name, contract_address, name, symbol, decimals,
                 count(*) OVER () AS total_usdc_variants
          FROM metadata WHERE symbol ILIKE '%USDC%' OR symbol ILIKE '%USD%' OR name ILIKE '%USD%'""",
    )
    sql["metadata_overview"] = _with(
        METADATA,
        body="""SELECT count(*) AS total_tokens, count(DISTINCT symbol) AS unique_symbols,
                 round(avg(decimals), 4) AS avg_decimals,
                 count(*) FILTER (decimals = 18) AS tokens_18_decimals,
                 count(*) FILTER (decimals = 6) AS tokens_6_decimals,
                 count(*) FILTER (decimals NOT IN (18, 6, 8)) AS unusual_decimals
          FROM metadata""",
    )
    sql["unusual_decimals"] = _with(
        METADATA,
        body="""SELECT contract_address, name, symbol, decimals FROM metadata
          WHERE decimals NOT IN (18, 6, 8) ORDER BY decimals DESC, contract_address LIMIT 20""",
    )
    sql["popular_symbols"] = _with(
        METADATA,
        body="""SELECT symbol, count(*) AS token_count, string_agg(name, ', ' ORDER BY name) AS token_names
          FROM metadata WHERE symbol <> '' GROUP BY symbol HAVING count(*) > 1
          ORDER BY token_count DESC, symbol LIMIT 20""",
    )

    # streams: a day is final once the watermark, the latest time less an hour, has passed its end
    closed = """(SELECT *, cast(block_timestamp AS DATE) AS date FROM transfers) days
          WHERE date + INTERVAL 1 DAY <= (SELECT max(block_timestamp) - INTERVAL 1 HOUR FROM transfers)
          GROUP BY date"""
    sql["stream_daily_activity"] = _with(
        TRANSFERS,
        body=f"SELECT date, count(*) AS daily_transfers, {VOLUME} AS daily_volume FROM {closed}",
    )
    sql["stream_daily_users"] = _with(
        TRANSFERS, body=f"SELECT date, count(DISTINCT from_address) AS unique_users FROM {closed}"
    )
    return {name: _printed(text, AMOUNTS.get(name, [])) for name, text in sql.items()}
