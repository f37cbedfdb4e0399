import datetime as dt

from conftest import cash, day, plan, rows
from pyspark.sql import functions as F

from stocktake.functions import scalar as S
from stocktake.operators.membership import not_in
from stocktake.plans import basics, ranking, sales
from stocktake.sources.tables import Retail


def by(df, key, *columns):
    return {r[0]: tuple(r[1:]) for r in rows(df, key, *columns)}


def test_revenue_by_region(shop):
    got = rows(sales.revenue_by_region(shop))
    assert got == [
        ("North", 1, cash("500.00"), cash("500.00")),
        ("West", 6, cash("340.05"), cash("56.68")),  # 56.675, away from zero
    ]


def test_lifetime_value_keeps_everyone(shop):
    got = by(sales.customer_lifetime_value(shop), "customer_id", "total_orders", "lifetime_value")
    assert got[5] == (0, cash("0.00")) and got[2] == (2, cash("1499.00")) and len(got) == 6


def test_anti_joins(shop):
    never = sales.never_ordered(shop.customers, shop.orders)
    assert sorted(r[0] for r in rows(never, "customer_id")) == [5, 6]
    assert "LeftAnti" in plan(never)
    assert rows(sales.never_sold(shop.products, shop.items), "product_id") == [(5,)]


def test_top_customers_weighting(shop):
    got = by(sales.top_customers_by_spend(shop), "customer_id", "total_orders", "total_spent",
             "avg_order_value", "avg_per_order")
    # order 1 has two lines and counts twice in the weighted average
    assert got[1] == (4, cash("200.05"), cash("60.01"), cash("50.01"))
    assert got[2] == (2, cash("450.00"), cash("749.50"), cash("749.50"))  # order 6 has no line
    assert got[5] == (0, None, None, None)


def test_previous_order_pairs_match_theta_join(shop):
    o = [tuple(r) for r in shop.orders.select("order_id", "customer_id", "order_date").collect()]
    want = sorted(
        (a[0], b[0]) for a in o for b in o
        if a[1] == b[1] and b[2] < a[2]
        and not any(c[1] == a[1] and b[2] < c[2] < a[2] for c in o)
    )
    for hot_rows in (1000, 0):
        got = ranking.previous_order_pairs(shop.orders, hot_rows)
        assert sorted(rows(got, "order_id", "previous_order_id")) == want
    assert (4, 2) in want and (4, 3) in want  # a tie on the previous date gives two rows


def test_order_gaps(shop):
    got = by(ranking.order_gaps(shop.orders), "order_id", "prev_order_date", "days_between_orders")
    assert got[1] == (None, None)
    assert got[3] == (day("2023-02-05"), 0)
    assert got[4] == (day("2023-02-05"), 55)


def test_rank_and_tiers(shop):
    ranked = by(ranking.spending_rank(shop), "customer_name", "total_spent", "spending_rank")
    assert ranked["Bob"] == (cash("500.00"), 1) and ranked["Fay"] == (cash("0.00"), 6)
    tiers = by(ranking.spending_tiers(shop.customers, shop.sales), "customer_name", "customer_tier")
    assert [tiers[n][0] for n in ("Bob", "Ann", "Cid", "Dan", "Eda", "Fay")] == [
        "Platinum", "Platinum", "Gold", "Gold", "Silver", "Bronze"]


def test_month_over_month(shop):
    got = rows(ranking.month_over_month_revenue(shop))
    assert got[0] == ("2023-01", cash("100.00"), None, None, None)
    assert got[1][:2] == ("2023-02", cash("150.05")) and got[1][4] == cash("50.05")


def test_product_against_category(shop):
    got = by(sales.product_vs_category_average(shop.products, shop.items), "product_id",
             "revenue", "avg_revenue_in_category", "performance")
    assert got[1] == (cash("170.00"), cash("120.00"), "Above Average")
    assert got[5] == (cash("0.00"), None, "Below Average")


def test_cohorts(shop):
    got = by(sales.cohort_conversion(shop.signups, shop.orders), "cohort", "cohort_size",
             "customers_who_ordered", "ordered_month_0", "ordered_month_1", "ordered_month_3",
             "overall_conversion_pct")
    assert got["2023-01"] == (2, 2, 1, 1, 2, cash("100.0"))
    assert got["2023-02"] == (2, 2, 1, 1, 2, cash("100.0"))
    assert got["2023-03"] == (2, 0, 0, 0, 0, cash("0.0"))


def test_spine_keeps_empty_days(spark, shop):
    bounds = spark.createDataFrame([(day("2023-01-30"), day("2023-02-05"))], "first date, last date")
    got = rows(sales.daily_revenue(shop.sales, bounds))
    assert len(got) == 7
    assert got[0] == (day("2023-01-30"), "Monday   ", cash("0.00"), 0)
    assert got[-1] == (day("2023-02-05"), "Sunday   ", cash("80.05"), 2)


def test_spine_passes_hundred_days(spark):
    """A recursive spine would stop at its level limit; a sequence does not."""
    bounds = spark.createDataFrame([(day("2024-01-01"), day("2024-06-30"))], "first date, last date")
    assert sales.date_spine(bounds).count() == 182


def test_customer_status(shop):
    got = by(sales.customer_summary(shop.customers, shop.sales, dt.date(2023, 6, 10)),
             "customer_name", "customer_status", "total_orders", "days_since_last_order")
    assert got["Cid"] == ("Active", 2, 9)
    assert got["Ann"] == ("At Risk", 4, 70)
    assert got["Bob"] == ("Churned", 1, 92)
    assert got["Dan"] == ("Never Ordered", 0, None)  # cancelled orders only
    assert got["Eda"] == ("Never Ordered", 0, None)


def test_established_high_value(shop):
    got = rows(sales.established_high_value(shop, dt.date(2023, 9, 1), 100),
               "customer_name", "value_rank", "days_since_last_order")
    assert sorted(got) == [("Ann", 2, 153), ("Bob", 1, 175), ("Cid", 3, 92)]


def test_popular_payment_keeps_ties(shop):
    got = sorted(rows(sales.popular_payment_per_region(shop), "region", "payment", "orders"))
    assert got == [("North", "upi", 2), ("West", "cod", 3)]


def test_repeat_customers(shop):
    assert rows(sales.repeat_customers(shop, 60), "customer_name", "avg_order_value") == [
        ("Cid", cash("70.00"))]


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    one = spark.createDataFrame([(1,)], "y int")
    holed = spark.createDataFrame([(1,), (None,)], "y int")
    assert rows(not_in(left, "x", one, "y")) == [(2,)]
    assert rows(not_in(left, "x", holed, "y")) == []
    assert not_in(left, "x", one.where("y > 5"), "y").count() == 3


def test_year_range_is_pushed(spark):
    shop = Retail(spark, "/root/testdata/sf0.001")
    pushed = plan(basics.half_open_year(shop)).split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    extracted = plan(basics.extract_year(shop)).split("PushedFilters: [")[1].split("]")[0]
    assert "LessThan" not in extracted


def test_view_filters_and_columns_are_pruned(spark):
    shop = Retail(spark, "/root/testdata/sf0.001")
    text = plan(sales.revenue_by_region(shop))
    schemas = [p.split("\n")[0] for p in text.split("ReadSchema: ")[1:]]
    assert not any("o_orderpriority" in s or "c_name" in s for s in schemas)


def test_name_concat_propagates_null(spark):
    df = spark.createDataFrame([("Ann", "Lee"), ("Ann", None)], "a string, b string")
    assert rows(df.select(S.full_name(F.col("a"), F.col("b")))) == [("Ann Lee",), (None,)]


def test_months_between_months_is_signed(spark):
    df = spark.createDataFrame([(day("2024-01-01"), day("2023-11-01"))], "a date, b date")
    a, b = F.col("a"), F.col("b")
    assert rows(df.select(S.months_between_months(a, b), S.months_between_months(b, a))) == [(2, -2)]


def test_number_text(spark):
    values = [1.0, 10000000.0, -123456789.25, 1e15, 1e17, 0.1, 0.0005, 5e-05, 0.0, 75000.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = ["1.0", "10000000.0", "-123456789.25", "1000000000000000.0", "1.0E17", "0.1", "0.0005",
            "5.0E-5", "0.0", "75000.5"]
    assert [r[0] for r in rows(df.select(S.number_text(F.col("v"))))] == want


def test_percent_change_guards_zero(spark):
    df = spark.sql("SELECT CAST(5 AS DECIMAL(12,2)) a, CAST(0 AS DECIMAL(12,2)) b")
    assert rows(df.select(S.percent_change(F.col("a"), F.col("b"), 2))) == [(None,)]


def test_partitions_are_put_together_to_a_bound_unless_the_session_says(spark):
    from stocktake.session import UNLESS_SET, tune

    (name, size), = UNLESS_SET.items()
    other = spark.newSession()
    other.conf.unset(name)
    assert tune(other).conf.get(name) == size
    other.conf.set(name, "4m")
    assert tune(other).conf.get(name) == "4m"
