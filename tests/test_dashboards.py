import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import fact_frame, rows
from starmill.operators import dimensions as dims
from starmill.operators import sinks
from starmill.operators.ranking import rank_cuts, top_with_ties
from starmill.plans import aggregates as agg
from starmill.plans import dashboards as dash
from starmill.plans.warehouse import Star

FIRST, LAST = date(2022, 7, 1), date(2024, 6, 30)


@pytest.fixture(scope="module")
def sales():
    """(sale_key, customer, product, location, day, net): one customer has a third of the sales, three have none."""
    rnd = random.Random(7)
    span = (LAST - FIRST).days
    return [(i, 1 if i % 3 == 0 else rnd.randint(2, 37), rnd.randint(1, 12), rnd.randint(1, 5),
             FIRST + timedelta(days=rnd.choice([rnd.randint(0, span), rnd.randint(0, 60)])),
             Decimal(rnd.randint(-500, 20000)) / 100) for i in range(900)] + [
        (900, 5, 1, 1, date(2023, 2, 28), Decimal("50.00")), (901, 5, 1, 1, date(2024, 2, 29), Decimal("75.00"))]


@pytest.fixture(scope="module")
def star(spark, sales):
    def frame(n, name, *columns):
        return spark.range(1, n + 1).select(F.col("id").alias(f"{name}_key"), F.concat(F.lit(name[0].upper()), "id").alias(f"{name}_id"), *columns)

    c = frame(40, "customer", F.concat(F.lit("Name "), "id").alias("full_name"), F.lit("Town").alias("city"), F.lit("NY").alias("state"))
    p = frame(12, "product", F.concat(F.lit("P"), F.col("id") % 11).alias("product_name"), F.concat(F.lit("cat"), F.col("id") % 3).alias("category"),
              F.concat(F.lit("sub"), F.col("id") % 2).alias("subcategory"), F.lit("B").alias("brand"))
    loc = frame(5, "location", F.concat(F.lit("Store "), "id").alias("store_name"), F.concat(F.lit("S"), F.col("id") % 2).alias("state"),
                F.when(F.col("id") < 3, "EAST").otherwise("WEST").alias("region"))
    fact = fact_frame(spark, sales).cache()
    return Star(fact=fact, customer=c, product=p, location=loc, date=dims.build_date_dimension(spark, FIRST, LAST))


def totals(sales, key):
    out = {}
    for s in sales:
        out[key(s)] = out.get(key(s), Decimal(0)) + s[5]
    return out


@pytest.mark.parametrize("small", [True, False])
def test_star_queries_do_not_depend_on_the_join_strategy(star, small):
    sized = Star(fact=star.fact, customer=star.customer, product=star.product, location=star.location, date=star.date,
                 rows=dict.fromkeys(("customer", "product", "location", "date"), 10 if small else 10**9))
    for build in (agg.monthly_sales, agg.regional_performance, agg.top_customers, agg.sales_enriched, dash.store_performance):
        assert rows(build(sized)) == rows(build(star)), build.__name__


def test_monthly_summary(star, sales):
    got = agg.monthly_sales(star).agg(F.sum("total_transactions"), F.sum("total_net_sales")).first()
    assert tuple(got) == (len(sales), sum(s[5] for s in sales))
    customers = {(s[4].year, s[4].month): set() for s in sales}
    for s in sales:
        customers[(s[4].year, s[4].month)].add(s[1])
    assert dict(((r.year, r.month), r.unique_customers) for r in star_months(star)) == {k: len(v) for k, v in customers.items()}


def test_incremental_refresh_equals_full_recompute(spark, star, tmp_path):
    path = str(tmp_path / "monthly")
    early = F.col("date_key") < 20230515
    sinks.write_table(agg.monthly_sales(star, star.fact.where(early)), path, partition_by=["year", "month"])
    agg.refresh_monthly_sales(star, star.fact.where(~early), path)
    full = agg.monthly_sales(star)
    assert rows(spark.read.parquet(path), *full.columns) == rows(full)


def star_months(star):
    return star.join(star.fact, "date", ["year", "month"]).groupBy("year", "month").agg(
        F.count_distinct("customer_key").alias("unique_customers")).collect()


def test_customers_without_sales_stay_in_the_summary(star):
    out = {r.customer_id: r for r in agg.customer_summary(star).collect()}
    assert len(out) == 40
    assert (out["C40"].total_purchases, out["C40"].lifetime_value, out["C40"].last_purchase_date) == (0, None, None)


def test_moving_average_skips_days_without_sales(star, sales):
    daily = totals(sales, lambda s: s[4])
    got = {r.date_value: r.sales_ma30 for r in dash.sales_ma30(star).collect()}
    assert daily.keys() < got.keys() and max(got) == max(daily)
    day = min(daily)
    while day <= max(daily):  # also days without sales
        span = [v for d, v in daily.items() if 0 <= (day - d).days < 30]
        assert (day in got) == bool(span)
        assert not span or got[day] == pytest.approx(float(sum(span)) / len(span))
        day += timedelta(days=1)


def test_year_over_year(star, sales):
    monthly = totals(sales, lambda s: (s[4].year, s[4].month))
    for r in dash.yoy_growth(star).collect():
        before = monthly.get((r.year - 1, r.month))
        assert r.previous_sales == before
        expected = 0 if not before else float(monthly[(r.year, r.month)] - before) / float(before)
        assert r.yoy_growth == pytest.approx(expected)
    assert dash.yoy_growth(star, "quarter").count() == 8
    assert dash.yoy_growth(star, "year").count() == 3


def test_leap_day_is_compared_with_28_february(star, sales):
    daily = totals(sales, lambda s: s[4])
    row = dash.yoy_growth(star, "day").where(F.col("date_value") == date(2024, 2, 29)).first()
    assert row.previous_sales == daily[date(2023, 2, 28)]


def segments(values):
    n = len(values)
    above = [sum(w > v for w in values) for v in values]
    return ["VIP" if 10 * a <= n - 1 else "Regular" if 2 * a <= n - 1 else "Occasional" for a in above]


def test_segments(star, sales):
    spent = totals(sales, lambda s: f"C{s[1]}")
    names = [f"C{i}" for i in range(1, 41)]
    expected = dict(zip(names, segments([spent.get(c, Decimal(0)) for c in names])))
    assert dict(rows(dash.customer_segments(star), "customer_id", "segment")) == expected
    summary = {r.segment: r.customers for r in dash.customer_segment_summary(star, agg.customer_summary(star)).collect()}
    assert summary == Counter(expected.values())


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("ranges", [2, 16])
def test_rank_cuts_are_exact_with_many_ties(spark, seed, ranges):
    rnd = random.Random(seed)
    values = [rnd.choice([0, 0, 0, rnd.randint(-50, 50)]) for _ in range(rnd.randint(1, 400))]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    cuts = rank_cuts(df, "v", {"vip": (1, 10), "regular": (1, 2)}, ranges)
    got = ["VIP" if v >= cuts["vip"] else "Regular" if v >= cuts["regular"] else "Occasional" for v in values]
    assert got == segments(values)


def test_top_with_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 8, 8, 8, 7, None])], "i int, v int")
    assert rows(top_with_ties(df, "v", 2), "v") == [(8,), (8,), (8,), (9,)]


def test_top_products_total(star, sales):
    by_name = sorted(totals(sales, lambda s: f"P{s[2] % 11}").values(), reverse=True)
    assert tuple(dash.top10_products_total(star).first()) == (10, sum(by_name[:10]))


def test_hierarchies_add_up(star, sales):
    total = sum(s[5] for s in sales)
    for cube, levels in ((dash.product_matrix_rollup(star), (0, 1, 3, 7)), (dash.calendar_rollup(star), (0, 1, 3, 7))):
        sums = {r.level: r.s for r in cube.groupBy("level").agg(F.sum("total_sales").alias("s")).collect()}
        assert sums == dict.fromkeys(levels, total)
    assert dash.category_waterfall(star).agg(F.max("running_total")).first()[0] == total


def test_frequency_histogram(star, sales):
    per_customer = Counter(s[1] for s in sales)
    expected = Counter(per_customer.get(c, 0) for c in range(1, 41))
    assert dict(rows(dash.purchase_frequency_hist(star))) == expected


def test_slicers(star, sales):
    got = dash.slice_sales(star, start=date(2023, 1, 10), end=date(2023, 12, 5), categories=["cat1"], regions=["EAST"])
    expected = {s[0] for s in sales if date(2023, 1, 10) <= s[4] <= date(2023, 12, 5) and s[2] % 3 == 1 and s[3] < 3}
    assert {r[0] for r in rows(got, "sale_key")} == expected != set()
    recent = dash.slice_sales(star, last_days=30, as_of=date(2022, 8, 15))
    assert {r[0] for r in rows(recent, "sale_key")} == {s[0] for s in sales if date(2022, 7, 17) <= s[4] <= date(2022, 8, 15)}
    fiscal = dash.slice_sales(star, fiscal_year=2023)
    assert fiscal.count() == sum(FIRST <= s[4] <= date(2023, 6, 30) for s in sales)
    with pytest.raises(ValueError):
        dash.slice_sales(star, last_days=3)


def test_last_twelve_months(star):
    out = dash.trend_last_12m(star, date(2024, 1, 20))
    months = [(r.year, r.month) for r in out.collect()]
    assert (months[0], months[-1], len(months)) == ((2023, 2), (2024, 1), 12)


def test_month_over_month_shows_every_month(star):
    out = dash.kpi_mom(star).collect()
    assert len(out) == 24 and out[0].previous_total_sales is None and out[1].previous_total_sales == out[0].total_sales


def test_kpis_of_nothing(star):
    empty = Star(fact=star.fact.limit(0), customer=star.customer, product=star.product, location=star.location, date=star.date)
    row = dash.kpi_summary(empty).first()
    assert (row.total_sales, row.total_transactions, row.discount_rate) == (None, 0, 0.0)


def test_row_level_access(spark, star, sales):
    mapping = spark.createDataFrame([("ann", "L1"), ("ann", "L4"), ("bob", "L2")], "user_name string, location_id string")
    assert dash.store_access(star, mapping, "ann").count() == sum(s[3] in (1, 4) for s in sales)
    assert dash.store_access(star, mapping, "eve").count() == 0
    assert dash.region_access(star, "WEST").count() == sum(s[3] >= 3 for s in sales)


def test_seasonal_factors_leave_the_trend_out(spark):
    def factors(net):
        months = [(2020 + i // 12, i % 12 + 1, Decimal(net(i))) for i in range(48)]
        return {r["month"]: r["seasonal_factor"] for r in dash.factors_of(
            spark.createDataFrame(months, "year int, month int, net decimal(22,2)")).collect()}

    assert factors(lambda i: 100 + 7 * i) == {m: pytest.approx(1.0, abs=1e-9) for m in range(1, 13)}
    season = factors(lambda i: (1000 + 3 * i) * (2 if i % 12 == 11 else 1))
    assert sum(season.values()) == pytest.approx(12) and max(season, key=season.get) == 12
    assert season[12] / season[6] == pytest.approx(2, rel=0.02)
    months = [(2020, m, Decimal(5)) for m in range(1, 13)]
    assert dash.factors_of(spark.createDataFrame(months, "year int, month int, net decimal(22,2)")).count() == 0
