"""Edge cases of the analytics, equality of both amount forms, and plan shapes."""

import datetime

import pytest
from pyspark.sql import functions as F

from bench import PARAMETERS
from checks import queries, views
from transferlens.functions.amounts import amounts_of
from transferlens.operators.ledger import token_balances
from transferlens.operators.ranking import first_per_group
from transferlens.plans import activity, discovery, holders, tokens
from transferlens.plans.catalog import ANALYTICS, run_analytic
from transferlens.schema import ZERO_ADDRESS
from tests.compare import spark_rows

T0, T1 = "2024-01-01 00:00:00", "2024-01-02 06:30:00"
BIG = str(2**255)


def text(df, *columns):
    return df.withColumns({c: amounts_of(df, c).to_text(F.col(c)) for c in columns})


@pytest.mark.parametrize("amounts", ["u256", "decimal38"])
def test_ledger_and_holders(rows, amounts):
    t = rows(
        [
            ("t", ZERO_ADDRESS, "a", "100", T0),
            ("t", "a", "b", "40", T0),
            ("t", "b", "b", "5", T0),
            ("t", "b", ZERO_ADDRESS, "10", T0),
            ("t", "c", "d", "7", T0),
            ("u", "a", "b", "3", T0),
        ],
        amounts,
    )
    balances = {(r.contract_address, r.address): r.balance for r in text(token_balances(t), "balance").collect()}
    assert balances == {("t", "a"): "60", ("t", "b"): "30", ("t", "d"): "7", ("u", "b"): "3"}
    shares = text(holders.holder_distribution(t, "t", limit=2), "balance").collect()
    assert [(r.holder_address, r.balance) for r in shares] == [("a", "60"), ("b", "30")]
    assert shares[0].percentage_of_supply == pytest.approx(6000 / 97)
    assert holders.holder_distribution(t, "none").count() == 0


def test_256_bit_totals(rows, names):
    t = rows([("t", "a", "b", BIG, T0), ("t", "c", "b", BIG, T0), ("t", "c", "b", "1", T0)])
    m = names(("t", "Token", "TOK", 18))
    summary = text(activity.ecosystem_summary(t), "total_volume").first()
    assert (summary.total_volume, summary.unique_senders, summary.unique_receivers) == (str(2**256 + 1), 2, 1)
    leader = text(tokens.volume_leaders(t, m), "total_volume", "largest_transfer").first()
    assert (leader.total_volume, leader.largest_transfer, leader.transfer_count) == (str(2**256 + 1), BIG, 3)
    assert leader.avg_transfer_size == pytest.approx(2**256 / 3)
    portfolio = text(holders.user_portfolio(t, m, "b"), "balance").collect()
    assert [(r.symbol, r.balance) for r in portfolio] == [("TOK", str(2**256 + 1))]


def test_missing_metadata(rows, names):
    t, m = rows([("x", "a", "b", "1", T0)]), names(("t", "Token", "TOK", 18))
    assert tokens.volume_leaders(t, m).first().symbol is None
    row = tokens.volume_leaders(t, m, missing="default").first()
    assert (row.name, row.symbol, row.decimals) == ("", "", 0)
    with pytest.raises(ValueError):
        tokens.volume_leaders(t, m, missing="other")


def test_no_transfers(rows, names):
    t, m = rows([("t", "a", "b", "1", T0)]).limit(0), names(("t", "Token", "TOK", 18))
    assert activity.ecosystem_summary(t).first().total_transfers == 0
    profile = text(activity.token_profile(t, "t"), "total_volume").first()
    assert (profile.total_volume, profile.average_transfer, profile.first_transfer) == ("0", None, None)
    sides = text(activity.user_activity(t, "a"), "total_value").collect()
    assert [(r.direction, r.transaction_count, r.total_value) for r in sides] == [("Sent", 0, "0"), ("Received", 0, "0")]
    assert tokens.whale_transfers(t, m).count() == 0


def test_self_transfer_counts_on_both_sides(rows):
    t = rows([("t", "a", "a", "4", T0), ("u", "a", "b", "1", T0)])
    sides = {r.direction: r for r in text(activity.user_activity(t, "a"), "total_value").collect()}
    assert (sides["Sent"].transaction_count, sides["Sent"].unique_tokens, sides["Sent"].total_value) == (2, 2, "5")
    assert (sides["Received"].transaction_count, sides["Received"].total_value) == (1, "4")
    users = {r.address: r for r in holders.multi_token_users(t, min_tokens=1).collect()}
    assert (users["a"].max_token_count, users["a"].total_interactions) == (2, 3)


def test_velocity_of_one_instant_is_null_and_last(rows, names):
    t = rows([("x", "a", "b", "1", T0), ("y", "a", "b", "1", T0), ("y", "a", "c", "1", T1)])
    found = tokens.token_velocity(t, names(("t", "n", "s", 1)), min_transfers=1).collect()
    assert [(r.contract_address, r.transfers_per_hour is None) for r in found] == [("y", False), ("x", True)]
    assert found[0].transfers_per_hour == pytest.approx(2 / 30.5) and found[0].unique_addresses == 3


def test_ties_break_on_the_key(rows):
    t = rows([(f"t{i}", f"s{i}", f"r{i}", "1", T0) for i in range(9, 0, -1)])
    assert [r.from_address for r in holders.top_senders(t, min_transfers=0, limit=3).collect()] == ["s1", "s2", "s3"]
    assert holders.top_senders(t, min_transfers=0, limit=None).count() == 9


def test_airdrop_span(rows, names):
    m = names(("t", "Token", "TOK", 18))
    short = [("t", "a", f"r{i}", "1", "2024-01-01 00:00:00") for i in range(3)]
    at_limit = [*short, ("t", "a", "r9", "1", "2024-01-08 00:00:00")]
    beyond = [*short, ("t", "a", "r9", "1", "2024-01-08 00:00:01")]
    found = [
        holders.airdrop_candidates(rows(d), m, min_recipients=4, min_transfers=4).count() for d in (at_limit, beyond)
    ]
    assert found == [1, 0]


def test_bounds_of_time_filters(rows):
    t = rows([("t", "a", "b", "1", x) for x in ("2024-01-01 00:00:00", "2024-01-01 23:59:59", "2024-01-03 00:00:00")])
    days = activity.activity_between(t, "2024-01-01 00:00:00", "2024-01-03 00:00:00").collect()
    assert [(r.date, r.daily_transfers) for r in days] == [(datetime.date(2024, 1, 3), 1), (datetime.date(2024, 1, 1), 2)]
    assert activity.today_activity(t, day="2024-01-01").first().today_transfers == 2
    assert [r.daily_transfers for r in activity.daily_activity(t, as_of="2024-01-02 00:00:00", days=1).collect()] == [2]
    assert [r.daily_transfers for r in activity.daily_activity(t, as_of="2024-01-03 00:00:00", days=3).collect()] == [1, 2]
    assert [r.day_name for r in activity.day_of_week_pattern(t, as_of="2024-01-04 00:00:00").collect()] == ["Monday", "Wednesday"]
    assert activity.daily_activity(t).count() == 0


def test_null_keys_count_exactly_and_approximately(rows, names):
    t = rows([(None, "a", "b", "1", "2024-01-01 00:00:00"), ("t", "a", "c", "2", "2024-01-01 00:00:00")])
    for approx in (False, True):
        found = activity.top_active_tokens(t, names(("x", "X", "X", 1)), approx=approx).collect()
        assert {r.contract_address for r in found} == {None, "t"}


def test_popular_symbols_repeat_equal_names(names):
    m = names(("1", "B", "S", 1), ("2", "A", "S", 1), ("3", "B", "S", 1), ("4", "C", "T", 1), ("5", "D", "", 1), ("6", "E", "", 1))
    assert [tuple(r) for r in discovery.popular_symbols(m).collect()] == [("S", 3, "A, B, B")]


def test_concentration(rows, names):
    t = rows([("t", ZERO_ADDRESS, f"h{i:02}", str(100 - i), T0) for i in range(60)])
    row = text(holders.token_concentration(t, names(("t", "Token", "TOK", 18))), "top_10_holders_balance").first()
    assert (row.total_holders, row.top_10_holders_balance) == (60, str(sum(range(91, 101))))
    assert row.concentration_percent == pytest.approx(95500 / sum(range(41, 101)))


@pytest.mark.parametrize("name", sorted(set(ANALYTICS)))
def test_amount_forms_agree_and_plans_scale(spark, sf_dir, name):
    t, m = views.transfers(spark, sf_dir), views.metadata(spark, sf_dir)
    narrow = run_analytic(name, t, m, **PARAMETERS[name])
    wide = run_analytic(name, queries.wide(t), m, **PARAMETERS[name])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert banned not in plan
    amounts = [f.name for f in wide.schema if f.dataType.typeName() == "struct"]
    as_text = wide.withColumns({c: amounts_of(wide, c).to_text(F.col(c)) for c in amounts})
    assert spark_rows(queries.rounded(as_text)) == spark_rows(queries.rounded(narrow))


def test_ranking_limits_groups_before_its_shuffle(spark, sf_dir):
    plan = holders.token_concentration(views.transfers(spark, sf_dir), views.metadata(spark, sf_dir))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_generated_methods_are_compiled(spark, sf_dir):
    """The JVM leaves methods above 8,000 bytes to its interpreter."""
    t, m = queries.wide(views.transfers(spark, sf_dir)), views.metadata(spark, sf_dir)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution, "debug.package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in sorted(ANALYTICS):
            plan = run_analytic(name, t, m, **PARAMETERS[name])._jdf.queryExecution().executedPlan()
            stages = debug.codegenStringSeq(plan)
            assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000, name
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("k", [1, 3, 10, 5000])
def test_first_rows_of_hot_and_small_groups(spark, k):
    """Ties, a hot group and groups of fewer than k rows, against sorting."""
    data = [("hot", f"a{i:05}", (i * 7919) % 50) for i in range(20_000)] + [("small", f"b{i}", i) for i in range(4)] + [(None, "c", 1)]
    df = spark.createDataFrame(data, "g string, address string, v int").repartition(5)
    rows = first_per_group(df, "g", "address", [F.desc("v"), "address"], k, F.lit(20_000).cast("bigint"))
    found = {(r.g, r.address) for r in rows.collect()}
    wanted = set()
    for g in ("hot", "small", None):
        wanted |= {(g, a) for _, a in sorted((-v, a) for h, a, v in data if h == g)[:k]}
    assert found == wanted and rows.columns == df.columns


def test_concentration_at_any_number_of_holders(rows, names):
    t = rows([("t", ZERO_ADDRESS, f"h{i:04}", str(1 + i % 97), T0) for i in range(3000)])
    m = names(("t", "Token", "TOK", 18))
    balances = sorted((1 + i % 97 for i in range(3000)), reverse=True)
    for k in (10, 2000, 5000):
        row = text(holders.token_concentration(t, m, top_holders=k), f"top_{k}_holders_balance").first()
        assert row[f"top_{k}_holders_balance"] == str(sum(balances[:k]))
    plan = holders.token_concentration(t, m, top_holders=5000)._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert len(sorts) == 2 and sum("_part" in line.split("row_number()")[1] for line in sorts) >= 1


def test_approximate_distinct_counts(spark, sf_dir):
    t = views.transfers(spark, sf_dir)
    exact, sketch = activity.ecosystem_summary(t).first(), activity.ecosystem_summary(t, approx=True).first()
    assert sketch.unique_receivers == pytest.approx(exact.unique_receivers, rel=0.1)
    assert "Expand" not in activity.ecosystem_summary(t, approx=True)._jdf.queryExecution().executedPlan().toString()
