"""A small hand-made marketplace."""

from datetime import datetime

from stallwise.operators.outliers import flag_outliers
from stallwise.plans.star import build_star
from stallwise.sources.schemas import RAW_COLUMNS


def day(text):
    return None if text is None else datetime.fromisoformat(text)


def frame(spark, entity, rows):
    columns = RAW_COLUMNS[entity]
    texts = ", ".join(f"{c} {'string' if t.startswith('decimal') else t}" for c, t in columns.items())
    df = spark.createDataFrame(rows, texts)
    return df.select(*[df[c].cast(t).alias(c) for c, t in columns.items()])


CUSTOMERS = [
    ("c1", "u1", 1, "x", "SP"),
    ("c2", "u1", 1, "x", "SP"),
    ("c3", "u2", 2, "y", "BA"),
    ("c4", "u3", 3, "z", "ZZ"),
    ("c5", "u4", 3, "z", "AM"),
]
SELLERS = [("s1", "x", "SP"), ("s2", "y", "BA")]
PRODUCTS = [("p1", "beleza", 1.0), ("p2", "casa", 2.0), ("p3", None, 3.0)]
TRANSLATION = [("beleza", "beauty"), ("beleza", "beauty"), ("nada", "nothing")]
# order, customer, status, bought, delivered, promised
ORDERS = [
    ("o1", "c1", "delivered", "2018-01-31 23:59", "2018-02-01 00:01", "2018-02-01 00:01"),
    ("o2", "c2", "delivered", "2018-02-01 10:00", "2018-03-01 10:00", "2018-02-20"),
    ("o3", "c3", "delivered", "2018-03-05 10:00", "2018-03-20 10:00", "2018-03-10"),
    ("o4", "c4", "delivered", "2018-07-01 00:00", None, "2018-07-20"),
    ("o5", "c5", "shipped", "2018-06-30 23:00", None, "2018-07-20"),
    ("o6", "c3", "canceled", "2018-03-06 10:00", None, "2018-03-10"),
]
# order, line, product, seller, price, freight
ITEMS = [
    ("o1", 1, "p1", "s1", "100.00", "10.00"),
    ("o1", 2, "p2", "s1", "50.00", "5.00"),
    ("o2", 1, "p1", "s1", "100.00", "20.00"),
    ("o3", 1, "p3", "s2", "30.00", "3.00"),
    ("o3", 2, "p1", "s1", "20.00", "6.00"),
    ("o4", 1, "p2", "s2", "10.00", "1.00"),
    ("o6", 1, "p2", "s2", "999.00", "9.00"),
    ("o9", 1, "p2", "s2", "1.00", "1.00"),
]
PAYMENTS = [
    ("o1", 1, "credit_card", 1, "100.00"),
    ("o1", 2, "credit_card", 1, "65.00"),
    ("o2", 1, "credit_card", 10, "120.00"),
    ("o3", 1, "boleto", 1, "59.00"),
    ("o4", 1, "credit_card", 1, "11.00"),
    ("o6", 1, "boleto", 1, "1008.00"),
]
# review, order, score, text, created
REVIEWS = [
    ("r2", "o1", 1, "second", "2018-02-02"),
    ("r1", "o1", 2, "first", "2018-02-02"),
    ("r0", "o1", 5, "old", "2018-02-01"),
    ("r3", "o2", 1, "   ", "2018-03-02"),
    ("r4", "o3", 2, "\n", "2018-03-21"),
    ("r5", "o4", 5, None, "2018-03-21"),
]


def entities(spark, orders=ORDERS):
    def times(rows, places):
        return [tuple(day(v) if i in places else v for i, v in enumerate(r)) for r in rows]

    return {
        "customers": frame(spark, "customers", CUSTOMERS),
        "sellers": frame(spark, "sellers", SELLERS),
        "products": frame(spark, "products", PRODUCTS),
        "category_translation": frame(spark, "category_translation", TRANSLATION),
        "orders": frame(spark, "orders", times(orders, (3, 4, 5))),
        "order_items": flag_outliers(frame(spark, "order_items", ITEMS)),
        "payments": frame(spark, "payments", PAYMENTS),
        "reviews": frame(spark, "reviews", times(REVIEWS, (4,))),
    }


def star(spark, **kwargs):
    return build_star(entities(spark, **kwargs))
