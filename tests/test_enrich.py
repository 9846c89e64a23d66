import datetime as dt

from lakeloom.operators import price_revenue
from lakeloom.spec import LookupSpec

D = dt.datetime
LK = LookupSpec(table="", key="shop_id", price_col="price", sales_col="sales",
                order_col="created")


def test_price_revenue_edge_cases(spark):
    fact = spark.createDataFrame(
        [(1, 2.0, 9.0, 9.0), (2, 3.0, None, None), (None, 4.0, None, None), (3, None, None, None),
         (4, 5.0, None, None)],
        "shop_id long, sales double, price double, revenue double")
    lookup = spark.createDataFrame(
        [(1, 10.0, D(2024, 1, 1)), (1, 20.0, D(2024, 1, 2)), (3, 7.0, D(2024, 1, 1)),
         (4, None, D(2024, 1, 1))],
        "shop_id long, price double, created timestamp_ntz")
    out = price_revenue(fact, lookup, LK)
    assert out.columns == ["shop_id", "sales", "price", "revenue"]
    rows = {r.shop_id: (r.price, r.revenue) for r in out.collect()}
    assert rows[1] == (20.0, 40.0)          # newest price, old columns replaced
    assert rows[2] == (0.0, 0.0)            # unmatched key
    assert rows[None] == (0.0, 0.0)         # NULL key kept
    assert rows[3] == (7.0, None)           # NULL sales -> NULL revenue
    assert rows[4] == (0.0, 0.0)            # matched NULL price -> 0
    assert out.count() == fact.count()


def test_lookup_ties_are_deterministic(spark):
    fact = spark.createDataFrame([(1, 1.0)], "shop_id long, sales double")
    lookup = spark.createDataFrame([(1, float(i), D(2024, 1, 1), i) for i in range(10)],
                                   "shop_id long, price double, created timestamp_ntz, id long")
    spec = LookupSpec("", "shop_id", "price", "sales", "created", ("id",))
    assert price_revenue(fact, lookup.repartition(3), spec).first().price == 9.0
