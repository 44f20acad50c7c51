from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import policy
from shelfcast.operators.policy import Scenario

START = dt.date(2025, 5, 2)
TEST = "product_id string, date date, actual_demand double, forecast double"


def flat(spark, days=20, demand=100.0):
    rows = [("P1", START + dt.timedelta(days=i), demand, 100.0) for i in range(days)]
    return spark.createDataFrame(rows, TEST)


def deviations(spark, **values):
    return spark.createDataFrame(
        [(k, v, 240) for k, v in values.items()], "product_id string, error_std double, oof_rows bigint"
    )


def run(spark, scenario=Scenario("s"), lead=3, review=7, test=None):
    found = policy.evaluate_policy(
        flat(spark) if test is None else test, deviations(spark, P1=10.0), [scenario], lead, review
    )
    return found.first()


@pytest.mark.parametrize(
    ("scenario", "lead", "review", "expected"),
    [
        (Scenario("base"), 3, 7, (542.1775813927782, 0, 100.0, 0.0, 1500.0, 1052.2, 52.2)),
        (Scenario("x", 1.2), 3, 7, (451.30654883566694, 1, 95.0, 27.8, 1772.2, 1052.2, 52.2)),
        (Scenario("c", capacity_fraction=0.7), 3, 7,
         (295.08836883621956, 2, 90.0, 163.5, 1336.5, 1052.2, 52.2)),
        (Scenario("lead4"), 4, 7, (569.724309040864, 0, 100.0, 0.0, 1500.0, 1154.7, 54.7)),
        (Scenario("lead0"), 0, 7, (120.279213821398, 13, 35.0, 1256.3, 743.7, 743.7, 43.7)),
        (Scenario("daily"), 3, 1, (148.0, 0, 100.0, 0.0, 2000.0, 433.0, 33.0)),
    ],
)
def test_hand_cases(spark, scenario, lead, review, expected):
    r = run(spark, scenario, lead, review)
    assert r.avg_inventory == pytest.approx(expected[0], rel=1e-12)
    assert (
        r.stockout_days, r.service_level_pct, r.lost_units, r.total_units_ordered,
        r.reorder_point, r.safety_stock,
    ) == expected[1:]


def by_the_rules(demands, target, capacity, start, lead, review):
    """The stock rules for one product, day by day."""
    stock, open_orders, result = start, [], {"stockouts": 0, "lost": 0.0, "ordered": 0.0, "levels": 0.0}
    for day, demand in enumerate(demands):
        stock += sum(q for due, q in open_orders if due == day)
        open_orders = [o for o in open_orders if o[0] != day]
        if demand > stock:
            result["stockouts"] += 1
            result["lost"] += demand - stock
        stock = max(stock - demand, 0.0)
        result["levels"] += stock
        position = stock + sum(q for _, q in open_orders)
        if day % review == 0 and position < target:
            amount = max(target - position, 0.0)
            if capacity is not None:
                amount = min(amount, max(capacity - position, 0.0))
            if amount > 0:
                open_orders.append((day + lead, amount))
                result["ordered"] += amount
    return result


@pytest.mark.parametrize(("lead", "review"), [(3, 7), (9, 2), (0, 1), (5, 5), (14, 3)])
def test_fold_follows_the_rules_for_many_products(spark, lead, review):
    """Also with several open orders at once, which the default lead and review never have."""
    source = random.Random(lead * 31 + review)
    demand = {f"P{p}": [round(source.expovariate(1 / 40), 3) for _ in range(45)] for p in range(6)}
    rows = [
        (p, START + dt.timedelta(days=i), v, 30.0 + 3 * int(p[1:]))
        for p, values in demand.items() for i, v in enumerate(values)
    ]
    source.shuffle(rows)
    test = spark.createDataFrame(rows, TEST).repartition(3)
    stats = deviations(spark, **{p: 5.0 + int(p[1:]) for p in demand})
    scenarios = [
        Scenario("a"), Scenario("b", 1.5), Scenario("c", spike=True),
        Scenario("d", capacity_fraction=0.6), Scenario("e", starting_inventory=50.0),
        Scenario("f", capacity_fraction=0.4, starting_inventory=1e6),
    ]
    products = policy.attach_error_stats(policy.collect_days(test), stats)
    parameters = policy.policy_parameters(policy.expand_scenarios(products, scenarios), lead, review)
    folded = policy.replenishment_fold(parameters, lead, review).collect()
    assert len(folded) == 36
    named = {s.name: s for s in scenarios}
    for r in folded:
        s = named[r.scenario]
        values = [
            v * (3 if s.spike and 22 <= i < 27 else 1) * s.multiplier
            for i, v in enumerate(demand[r.product_id])
        ]
        start = r.target_level if s.starting_inventory is None else s.starting_inventory
        if r.inventory_capacity is not None:
            start = min(start, r.inventory_capacity)
        expected = by_the_rules(values, r.target_level, r.inventory_capacity, start, lead, review)
        assert r._end.stockouts == expected["stockouts"]
        for name in ("lost", "ordered", "levels"):
            assert r._end[name] == pytest.approx(expected[name], rel=1e-9, abs=1e-6)


def test_multiplier_changes_demand_only(spark):
    plain, more = run(spark), run(spark, Scenario("s", 1.5))
    assert plain.reorder_point == more.reorder_point
    assert plain.avg_daily_forecast == more.avg_daily_forecast
    assert more.lost_units > plain.lost_units


def test_capacity_bounds_the_stock(spark):
    r = run(spark, Scenario("s", capacity_fraction=0.5))
    assert r.inventory_capacity == pytest.approx(r.target_level / 2, abs=0.1)
    assert r.avg_inventory <= r.inventory_capacity
    assert run(spark).inventory_capacity is None


@pytest.mark.parametrize(
    ("scenario", "lead", "review"),
    [
        (Scenario("s", 0.0), 3, 7), (Scenario("s", -1.0), 3, 7), (Scenario("s"), -1, 7),
        (Scenario("s"), 3, 0), (Scenario("s"), 3, -7), (Scenario("s", capacity_fraction=0.0), 3, 7),
        (Scenario("s", capacity_fraction=-0.1), 3, 7), (Scenario("s", capacity_fraction=1.1), 3, 7),
    ],
)
def test_bad_parameters_raise(spark, scenario, lead, review):
    with pytest.raises(ValueError):
        run(spark, scenario, lead, review)


def test_bad_inputs_raise(spark):
    with pytest.raises(ValueError, match="no rows"):
        run(spark, test=flat(spark, 0))
    with pytest.raises(ValueError, match="forecast"):
        run(spark, test=flat(spark).drop("forecast"))
    with pytest.raises(ValueError, match="Duplicate"):
        run(spark, test=flat(spark).union(flat(spark, 1)))
    other = flat(spark).withColumn("product_id", F.lit("P2"))
    with pytest.raises(ValueError, match="P2"):
        run(spark, test=flat(spark).union(other))
    with pytest.raises(ValueError, match="deviation"):
        policy.evaluate_policy(flat(spark), deviations(spark, P1=None), [Scenario("s")])


def test_spike_hits_five_rows_from_the_middle(spark):
    rows = sorted(policy.apply_spike(flat(spark, 21)).collect(), key=lambda r: r.date)
    assert [i for i, r in enumerate(rows) if r.actual_demand == 300.0] == [10, 11, 12, 13, 14]
    short = sorted(policy.apply_spike(flat(spark, 4)).collect(), key=lambda r: r.date)
    assert [r.actual_demand for r in short] == [100.0, 100.0, 300.0, 300.0]


# Published sensitivity summary and its published costs.
Z_SUMMARY = [
    (1.28, 60, 1117.3, 187209.7, 15977.4), (1.65, 60, 699.6, 187627.4, 16841.1),
    (2.05, 60, 404.5, 187922.5, 17795.9),
]
COSTS = {
    1.28: (958644.0, 22346.0, 18720.97, 999710.97),
    1.65: (1010466.0, 13992.0, 18762.74, 1043220.74),
    2.05: (1067754.0, 8090.0, 18792.25, 1094636.25),
}


def summary(spark, rows=Z_SUMMARY):
    return spark.createDataFrame(
        rows, "z_score double, test_days int, total_lost_units double, "
        "total_units_ordered double, total_average_inventory double"
    )


def test_published_costs(spark):
    rows = policy.cost_table(policy.validate_z_set(summary(spark))).collect()
    assert {
        r.z_score: (r.holding_cost, r.stockout_cost, r.ordering_cost, r.total_cost) for r in rows
    } == COSTS
    for r in rows:
        parts = r.holding_cost + r.stockout_cost + r.ordering_cost
        assert r.total_cost == pytest.approx(parts, abs=0.02)


def test_z_values_must_be_the_expected_ones(spark):
    with pytest.raises(ValueError, match="z values"):
        policy.validate_z_set(summary(spark, Z_SUMMARY[:2]))
    with pytest.raises(ValueError, match="z values"):
        policy.validate_z_set(summary(spark, [*Z_SUMMARY, (3.0, 60, 1.0, 1.0, 1.0)]))
    with pytest.raises(ValueError, match="test_days"):
        policy.validate_z_set(summary(spark).drop("test_days"))


def test_more_safety_never_loses_more(spark):
    source = random.Random(5)
    rows = [
        (p, START + dt.timedelta(days=i), source.uniform(0, 200), 100.0)
        for p in ("P1", "P2") for i in range(60)
    ]
    test = spark.createDataFrame(rows, TEST)
    found = policy.z_sensitivity(test, deviations(spark, P1=40.0, P2=60.0)).orderBy("z_score").collect()
    assert [r.z_score for r in found] == [1.28, 1.65, 2.05]
    assert [r.products for r in found] == [2, 2, 2]
    lost = [r.total_lost_units for r in found]
    assert lost == sorted(lost, reverse=True)


def test_portfolio_counts(spark):
    rows = [
        ("P1", "s", 1.65, None, 4.0, 100.0, 100.0, 0.0, 10.0, 5.0, 20.0),
        ("P2", "s", 1.65, None, 6.0, 50.0, 94.0, 2.5, 20.0, 7.0, 30.0),
        ("P3", "s", 1.65, None, 8.0, 25.0, 89.0, 1.5, 30.0, 9.0, 40.0),
    ]
    df = spark.createDataFrame(
        rows,
        "product_id string, scenario string, z_score double, capacity_fraction double, "
        "oof_error_std double, avg_inventory double, service_level_pct double, lost_units double, "
        "total_units_ordered double, safety_stock double, reorder_point double",
    )
    r = policy.portfolio_summary(df).first()
    assert (r.products, r.products_below_90pct_service, r.products_below_95pct_service) == (3, 1, 2)
    assert (r.total_lost_units, r.total_units_ordered, r.total_average_inventory) == (4.0, 60.0, 175.0)
    assert (r.mean_service_level_pct, r.mean_safety_stock, r.mean_oof_error_std) == (94.33, 7.0, 6.0)
