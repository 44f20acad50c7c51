"""Replenishment policy evaluation for every product and scenario at once.

The stock of a product depends on its own past only, so a product's days are collected into one
ordered array (at most one row per day of the evaluated horizon) and folded inside the JVM. The
days are collected once per product; scenarios are added after that, so they cost no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.contracts import assert_unique_key, require_columns
from shelfcast.functions.numeric import fixed

LEAD_DAYS = 3
REVIEW_DAYS = 7
SERVICE_Z = 1.65
# Z scores of the sensitivity run, and unit costs.
Z_VALUES = (1.28, 1.65, 2.05)
HOLDING_COST = 1.00
STOCKOUT_COST = 20.00
ORDERING_COST = 0.10
SPIKE_FACTOR = 3.0
SPIKE_ROWS = 5


@dataclass(frozen=True)
class Scenario:
    name: str
    multiplier: float = 1.0
    spike: bool = False
    capacity_fraction: float | None = None
    z: float = SERVICE_Z
    starting_inventory: float | None = None


# The five stress scenarios.
SCENARIOS = (
    Scenario("A - Normal demand"),
    Scenario("B - Demand +10%", multiplier=1.10),
    Scenario("C - Demand +20%", multiplier=1.20),
    Scenario("D - Unexpected 3x five-day spike", spike=True),
    Scenario("E - Inventory capacity at 70% of target", capacity_fraction=0.70),
)


def validate_policy(
    scenarios: Iterable[Scenario], lead: int = LEAD_DAYS, review: int = REVIEW_DAYS
) -> None:
    """Raise ``ValueError`` for parameters outside their range."""
    if lead < 0:
        raise ValueError(f"A lead time cannot be negative: {lead}")
    if review <= 0:
        raise ValueError(f"A review period needs at least one day: {review}")
    for scenario in scenarios:
        if scenario.multiplier <= 0:
            raise ValueError(f"Scenario {scenario.name!r}: demand multiplier has to be positive")
        fraction = scenario.capacity_fraction
        if fraction is not None and not 0 < fraction <= 1:
            raise ValueError(f"Scenario {scenario.name!r}: capacity fraction outside (0, 1]")


def error_stats(oof: DataFrame) -> DataFrame:
    """Sample deviation and number of the out-of-fold errors per product."""
    return (
        oof.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.stddev_samp("error").alias("error_std"), F.count("*").alias("oof_rows"))
    )


def require_error_stats(stats: DataFrame) -> DataFrame:
    if not stats.where(F.col("error_std").isNull()).isEmpty():
        raise ValueError("A product has too few out-of-fold errors for a deviation.")
    return stats


def attach_error_stats(test: DataFrame, stats: DataFrame, check: bool = True) -> DataFrame:
    """Add each product's estimate; with ``check``, raise unless every product has exactly one."""
    if check:
        assert_unique_key(stats, ["product_id"], "error statistics")
        lacking = test.select("product_id").join(
            stats.where(F.col("error_std").isNotNull()), "product_id", "left_anti"
        )
        if not lacking.isEmpty():
            raise ValueError(f"No error estimate for product {lacking.first()['product_id']}.")
    return test.join(stats, "product_id", "left")


def collect_days(test: DataFrame) -> DataFrame:
    """One row per product with its days in date order, as an array.

    ``test`` holds ``actual_demand`` and ``forecast`` per product and day, so an array is as long
    as the evaluated horizon.
    """
    require_columns(test, ("product_id", "date", "actual_demand", "forecast"))
    day = F.struct(
        "date", F.col("actual_demand").cast("double").alias("demand"), F.col("forecast").alias("forecast")
    )
    return (
        test.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.array_sort(F.collect_list(day)).alias("days"),
            F.avg("forecast").alias("avg_daily_forecast"),
        )
    )


def expand_scenarios(products: DataFrame, scenarios: Sequence[Scenario] = SCENARIOS) -> DataFrame:
    """Repeat every product row once per scenario."""
    rows = [
        F.struct(
            F.lit(s.name).alias("scenario"),
            F.lit(float(s.multiplier)).alias("multiplier"),
            F.lit(s.spike).alias("spike"),
            F.lit(s.capacity_fraction).cast("double").alias("capacity_fraction"),
            F.lit(float(s.z)).alias("z_score"),
            F.lit(s.starting_inventory).cast("double").alias("starting_inventory"),
        )
        for s in scenarios
    ]
    return products.withColumn("_s", F.explode(F.array(*rows))).select(
        *products.columns, "_s.*"
    )


def policy_parameters(
    products: DataFrame, lead: int = LEAD_DAYS, review: int = REVIEW_DAYS
) -> DataFrame:
    """Safety stock, reorder point, target and capacity from the mean forecast and error spread."""
    period = lead + review
    safety = F.col("z_score") * F.col("error_std") * F.sqrt(F.lit(float(period)))
    return (
        products.withColumn("protection_period_days", F.lit(period))
        .withColumn("safety_stock", safety)
        .withColumn(
            "reorder_point", F.col("avg_daily_forecast") * period + F.col("safety_stock")
        )
        .withColumn("target_level", F.col("reorder_point"))
        .withColumn("inventory_capacity", F.col("target_level") * F.col("capacity_fraction"))
    )


def _spiked(days: Column, spike: Column, demand, first: Column) -> Column:
    """Triple the demand of five rows from position ``first`` on, where ``spike`` is set."""

    def one(day: Column, i: Column) -> Column:
        hit = spike & (i >= first) & (i < first + SPIKE_ROWS)
        return demand(day, F.when(hit, F.lit(SPIKE_FACTOR)).otherwise(F.lit(1.0)))

    return F.transform(days, one)


def apply_spike(test: DataFrame) -> DataFrame:
    """Daily rows with the demand of the five rows from the middle of the horizon tripled."""
    products = collect_days(test)
    first = F.floor(F.size("days") / 2).cast("int")
    days = _spiked(
        F.col("days"),
        F.lit(True),
        lambda d, factor: F.struct(
            d["date"].alias("date"),
            (d["demand"] * factor).alias("actual_demand"),
            d["forecast"].alias("forecast"),
        ),
        first,
    )
    return products.select("product_id", F.explode(days).alias("d")).select("product_id", "d.*")


def _let(binding: Column, body) -> Column:
    """Evaluate ``binding`` once and use it several times inside ``body``."""
    return F.transform(F.array(binding), body)[0]


def _sum(quantities: Column) -> Column:
    return F.aggregate(quantities, F.lit(0.0), lambda total, order: total + order["quantity"])


def replenishment_fold(
    products: DataFrame, lead: int = LEAD_DAYS, review: int = REVIEW_DAYS
) -> DataFrame:
    """Run the stock of every row through its days.

    On each day, orders due arrive, demand is served (what is missing is lost), the stock level is
    recorded, and every ``review`` days, from the first on, a position below the reorder point is
    ordered up to the target or the capacity. With ``lead`` 0 an order is dated on a day whose
    arrivals are already in, so it never arrives and stays open.
    """
    capacity = F.col("inventory_capacity")
    start = F.coalesce(F.col("starting_inventory"), F.col("target_level"))
    start = F.when(capacity.isNull(), start).otherwise(F.least(start, capacity))
    initial = F.struct(
        F.lit(0).alias("day"),
        start.alias("stock"),
        F.lit(None).cast("array<struct<arrives:int,quantity:double>>").alias("open"),
        F.lit(0).alias("stockouts"),
        F.lit(0.0).alias("lost"),
        F.lit(0.0).alias("ordered"),
        F.lit(0.0).alias("levels"),
    )
    initial = initial.withField("open", F.filter(F.array(F.struct(
        F.lit(0).alias("arrives"), F.lit(0.0).alias("quantity")
    )), lambda order: F.lit(False)))

    def step(state: Column, demand: Column) -> Column:
        due = F.filter(state["open"], lambda o: o["arrives"] == state["day"])
        served = F.struct(
            (state["stock"] + _sum(due)).alias("available"),
            F.filter(state["open"], lambda o: o["arrives"] != state["day"]).alias("open"),
        )

        def after_sales(s: Column) -> Column:
            left = F.greatest(s["available"] - demand, F.lit(0.0))
            position = left + _sum(s["open"])
            return _let(
                F.struct(left.alias("left"), position.alias("position")),
                lambda p: after_review(s, p),
            )

        def after_review(s: Column, p: Column) -> Column:
            wanted = F.greatest(F.col("target_level") - p["position"], F.lit(0.0))
            room = F.greatest(capacity - p["position"], F.lit(0.0))
            amount = F.when(
                (state["day"] % review == 0) & (p["position"] < F.col("reorder_point")),
                F.when(capacity.isNull(), wanted).otherwise(F.least(wanted, room)),
            ).otherwise(F.lit(0.0))
            return _let(amount, lambda q: next_state(s, p, q))

        def next_state(s: Column, p: Column, q: Column) -> Column:
            order = F.struct((state["day"] + lead).alias("arrives"), q.alias("quantity"))
            short = demand > s["available"]
            return F.struct(
                (state["day"] + 1).alias("day"),
                p["left"].alias("stock"),
                F.when(q > 0, F.concat(s["open"], F.array(order)))
                .otherwise(s["open"])
                .alias("open"),
                (state["stockouts"] + F.when(short, 1).otherwise(0)).alias("stockouts"),
                (state["lost"] + F.when(short, demand - s["available"]).otherwise(0.0)).alias("lost"),
                (state["ordered"] + q).alias("ordered"),
                (state["levels"] + p["left"]).alias("levels"),
            )

        return _let(served, after_sales)

    first = F.floor(F.size("days") / 2).cast("int")
    demands = _spiked(
        F.col("days"),
        F.col("spike"),
        lambda d, factor: d["demand"] * factor * F.col("multiplier"),
        first,
    )
    folded = products.withColumn("_demands", demands).withColumn(
        "_end", F.aggregate("_demands", initial, step)
    )
    return folded.drop("_demands")


def policy_kpis(folded: DataFrame, rounded: bool = True) -> DataFrame:
    """Service and stock figures from the final state of the fold."""

    def report(column: Column, places: int) -> Column:
        return fixed(column, places) if rounded else column

    n_days = F.size("days")
    service = 100 * (1 - F.col("_end.stockouts") / n_days)
    extra = [c for c in ("oof_rows",) if c in folded.columns]
    return folded.select(
        "product_id",
        "scenario",
        "z_score",
        "capacity_fraction",
        F.col("error_std").alias("oof_error_std"),
        *extra,
        (F.col("_end.levels") / n_days).alias("avg_inventory"),
        F.col("_end.stockouts").alias("stockout_days"),
        report(service, 2).alias("service_level_pct"),
        report(F.col("_end.lost"), 1).alias("lost_units"),
        report(F.col("_end.ordered"), 1).alias("total_units_ordered"),
        report(F.col("avg_daily_forecast"), 2).alias("avg_daily_forecast"),
        "protection_period_days",
        report(F.col("reorder_point"), 1).alias("reorder_point"),
        report(F.col("target_level"), 1).alias("target_level"),
        report(F.col("safety_stock"), 1).alias("safety_stock"),
        report(F.col("inventory_capacity"), 1).alias("inventory_capacity"),
    )


def evaluate_policy(
    test: DataFrame,
    stats: DataFrame,
    scenarios: Sequence[Scenario] = SCENARIOS,
    lead: int = LEAD_DAYS,
    review: int = REVIEW_DAYS,
    check: bool = True,
    rounded: bool = True,
) -> DataFrame:
    """Policy figures per product and scenario.

    ``test`` holds ``product_id, date, actual_demand, forecast`` and ``stats`` one error estimate per
    product. With ``check``, missing rows, repeated days and missing estimates raise.
    """
    validate_policy(scenarios, lead, review)
    require_columns(test, ("product_id", "date", "actual_demand", "forecast"))
    if check:
        if test.isEmpty():
            raise ValueError("Policy input holds no rows.")
        assert_unique_key(test, ["product_id", "date"], "policy input")
        require_error_stats(stats)
    products = attach_error_stats(collect_days(test), stats, check)
    parameters = policy_parameters(expand_scenarios(products, scenarios), lead, review)
    return policy_kpis(replenishment_fold(parameters, lead, review), rounded)


def normal_by_product(test: DataFrame, stats: DataFrame, check: bool = True) -> DataFrame:
    return evaluate_policy(test, stats, [Scenario("A - Normal demand")], check=check)


def z_scenarios(z_values: Sequence[float] = Z_VALUES) -> list[Scenario]:
    return [Scenario("A - Normal demand", z=z) for z in z_values]


def portfolio_summary(results: DataFrame, keys: Sequence[str] = ("scenario",), days: int = 60,
                      lead: int = LEAD_DAYS, review: int = REVIEW_DAYS) -> DataFrame:
    """Products rolled up to one row per scenario; each product has one row in each scenario."""
    fixed_columns = [c for c in ("z_score", "capacity_fraction") if c not in keys]
    return results.groupBy(*keys).agg(
        F.count("product_id").alias("products"),
        F.lit(days).alias("test_days"),
        F.lit(lead).alias("lead_time_days"),
        F.lit(review).alias("review_period_days"),
        F.lit(lead + review).alias("protection_period_days"),
        *[fixed(F.max(c), 2).alias(c) for c in fixed_columns],
        fixed(F.avg("service_level_pct"), 2).alias("mean_service_level_pct"),
        F.count_if(F.col("service_level_pct") < 90).alias("products_below_90pct_service"),
        F.count_if(F.col("service_level_pct") < 95).alias("products_below_95pct_service"),
        fixed(F.sum("lost_units"), 1).alias("total_lost_units"),
        fixed(F.sum("total_units_ordered"), 1).alias("total_units_ordered"),
        fixed(F.sum("avg_inventory"), 1).alias("total_average_inventory"),
        fixed(F.avg("safety_stock"), 1).alias("mean_safety_stock"),
        fixed(F.avg("reorder_point"), 1).alias("mean_reorder_point"),
        fixed(F.avg("oof_error_std"), 2).alias("mean_oof_error_std"),
    )


def z_sensitivity(
    test: DataFrame, stats: DataFrame, z_values: Sequence[float] = Z_VALUES, check: bool = True
) -> DataFrame:
    """Normal demand under several safety factors, rolled up per z."""
    results = evaluate_policy(test, stats, z_scenarios(z_values), check=check)
    return portfolio_summary(results, ["z_score"])


COST_COLUMNS = (
    "z_score",
    "test_days",
    "total_lost_units",
    "total_units_ordered",
    "total_average_inventory",
)


def validate_z_set(summary: DataFrame, expected: Sequence[float] = Z_VALUES) -> DataFrame:
    """Return ``summary`` unchanged, or raise unless its z values are exactly the expected ones."""
    require_columns(summary, COST_COLUMNS)
    rows = summary.select(fixed("z_score", 2).alias("z")).distinct().limit(len(expected) + 1)
    found = {row["z"] for row in rows.collect()}
    if found != {round(z, 2) for z in expected}:
        raise ValueError(f"Expected z values {sorted(expected)}, found {sorted(found)}")
    return summary


def cost_table(summary: DataFrame) -> DataFrame:
    """Holding, stockout and ordering cost; the total is summed before rounding."""
    costs = {
        "holding_cost": F.col("total_average_inventory") * F.col("test_days") * HOLDING_COST,
        "stockout_cost": F.col("total_lost_units") * STOCKOUT_COST,
        "ordering_cost": F.col("total_units_ordered") * ORDERING_COST,
    }
    total = costs["holding_cost"] + costs["stockout_cost"] + costs["ordering_cost"]
    return require_columns(summary, COST_COLUMNS).withColumns(
        {
            **{name: fixed(cost, 2) for name, cost in costs.items()},
            "total_cost": fixed(total, 2),
        }
    )
