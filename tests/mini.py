"""Hand-made mini tables for the cases the driver's data cannot show."""

from __future__ import annotations

from basket.sources import schema as S
from basket.sources.tables import Tables, order_items

DEPARTMENTS = [(1, "produce"), (2, "dairy")]
AISLES = [(1, "fresh"), (2, "cold")]
PRODUCTS = [(10, "apple", 1, 1), (20, "milk", 2, 2), (30, "pear", 1, 1)]


def orders_row(order_id, user_id, eval_set="prior", number=1, dow=1, hour=9, days=None):
    return (order_id, user_id, eval_set, number, dow, hour, days)


def make(spark, orders, prior, train=(), products=PRODUCTS, departments=DEPARTMENTS, aisles=AISLES) -> Tables:
    o = spark.createDataFrame(list(orders), S.ORDERS)
    p = spark.createDataFrame(list(prior), S.ORDER_PRODUCTS)
    t = spark.createDataFrame(list(train), S.ORDER_PRODUCTS)
    return Tables(
        orders=o,
        order_items=order_items(p, t),
        products=spark.createDataFrame(list(products), S.PRODUCTS),
        aisles=spark.createDataFrame(list(aisles), S.AISLES),
        departments=spark.createDataFrame(list(departments), S.DEPARTMENTS),
    )


def item(order_id, product_id, reordered=0, pos=1):
    return (order_id, product_id, pos, reordered)
