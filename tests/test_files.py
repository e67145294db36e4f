import os

import pytest
from pyspark.sql import functions as F

from stallwise.operators import rules
from stallwise.plans import profile, sales
from stallwise.plans.quality import Layers, rule_sets, run_files, tag_entity
from stallwise.session import shared_dir
from stallwise.sources.layers import read_table
from stallwise.sources.raw import BAD_VALUES, MissingSource, load_raw, read_entity

FILES = {
    "customers.csv": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01000,x,SP
c2,u2,02000,y,BA
c2,u9,02000,again,BA
c3,u3,abc,z,AM
""",
    "sellers.csv": "seller_id,seller_city,seller_state\ns1,x,SP\n",
    "products.csv": "product_id,product_category_name,product_weight_g\np1,beleza,10\np2,,NaN\n",
    "category_translation.csv": "product_category_name,product_category_name_english\nbeleza,beauty\n",
    "orders.csv": """order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-01 10:00:00,2018-01-05 10:00:00,2018-01-10 00:00:00
o2,c2,delivered,2018-01-02 10:00:00,2018-01-01 10:00:00,2018-01-10 00:00:00
o3,c3,delivered,2018-01-03 10:00:00,2018-01-05 10:00:00,2018-01-10 00:00:00
o4,c1,canceled,2018-01-03 10:00:00,,2018-01-10 00:00:00
o5,c2,shipped,not a date,,2018-01-10 00:00:00
o6,c2,shipped,2018-02-03 10:00:00,,2018-02-10 00:00:00
""",
    "order_items.csv": """order_id,order_item_id,product_id,seller_id,price,freight_value
o1,1,p1,s1,10.50,1.00
o1,2,p9,s1,20.00,1.00
o2,1,p1,s1,30.00,1.00
o4,1,p1,s1,40.00,1.00
o6,1,p2,s9,50.00,1.00
o6,2,p2,s1,-5,1.00
o6,3,p2,s1,7.00,x
o6,4,p2,s1,8.00,2.00
""",
    "payments.csv": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,boleto,1,11.50
o6,1,boleto,3,10.00
o6,2,credit_card,3,10.00
""",
    "reviews.csv": '''review_id,order_id,review_score,review_comment_message,review_creation_date
r1,o1,1,"came broken,
said ""fine"" on the box",2018-01-06 00:00:00
r2,o6,9,bad score,2018-01-06 00:00:00
r3,o7,2,no order,2018-01-06 00:00:00
''',
}


@pytest.fixture()
def raw_dir(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_quoted_text_keeps_line_break_and_quotes(spark, raw_dir):
    df = read_entity(spark, f"{raw_dir}/reviews.csv", "reviews")
    rows = {r.review_id: r.review_comment_message for r in df.collect()}
    assert len(rows) == 3 and rows["r1"] == 'came broken,\nsaid "fine" on the box'


def test_unparsable_values_fail_their_row_only(spark, raw_dir):
    orders = read_entity(spark, f"{raw_dir}/orders.csv", "orders")
    bad = {r.order_id: [(b.column, b.text) for b in r[BAD_VALUES]] for r in orders.collect() if r[BAD_VALUES]}
    assert bad == {"o5": [("order_purchase_timestamp", "not a date")]}
    reasons = rules.quarantined_rows(tag_entity(orders, rule_sets()["orders"])).collect()
    assert {r.order_id: r.quarantine_reason for r in reasons} == {
        "o2": "delivered not before purchase",
        "o5": "type(order_purchase_timestamp) | not_null(order_purchase_timestamp)",
    }


def test_nan_is_missing(spark, raw_dir):
    products = read_entity(spark, f"{raw_dir}/products.csv", "products")
    assert products.filter("product_id = 'p2'").first().product_weight_g is None


def test_first_row_of_the_file_stays(spark, raw_dir):
    customers = read_entity(spark, f"{raw_dir}/customers.csv", "customers")
    clean = rules.clean_rows(tag_entity(customers, rule_sets()["customers"]))
    assert {r.customer_id: r.customer_city for r in clean.collect()} == {"c1": "x", "c2": "y"}


def test_missing_required_file_stops_and_optional_does_not(spark, raw_dir):
    os.rename(f"{raw_dir}/category_translation.csv", f"{raw_dir}/other.txt")
    assert "category_translation" not in load_raw(spark, raw_dir)
    with pytest.raises(MissingSource):
        load_raw(spark, raw_dir, {"orders": "absent.csv"})


def test_missing_column_is_named(spark, raw_dir):
    with pytest.raises(ValueError, match="seller_id"):
        read_entity(spark, f"{raw_dir}/products.csv", "sellers")


def test_whole_run(spark, raw_dir, tmp_path_factory):
    layers = Layers.under(str(tmp_path_factory.mktemp("run")))
    for _ in range(2):  # every sink replaces
        result, star = run_files(spark, raw_dir, layers)
    checks = {r.check_name: (r.total, r.failed) for r in read_table(spark, layers.work, "dq_report").collect()}
    assert len(checks) == 13
    assert checks["dim_customer (schema)"] == (4, 2)
    assert checks["fact_orders (schema and time order)"] == (6, 2)
    assert checks["fact_items (schema)"] == (8, 2)
    assert checks["fact_payments (schema and installments)"] == (3, 1)
    assert checks["reviews (schema and scale 1-5)"] == (3, 1)
    assert checks["orders_to_customers"] == (4, 1)  # o3: its customer failed on the zip code
    assert checks["items_to_orders"] == (6, 1)  # o2
    assert checks["items_to_products"] == (5, 1)
    assert checks["items_to_sellers"] == (4, 1)
    assert checks["payments_to_orders"] == (2, 0)
    assert checks["reviews_to_orders"] == (2, 1)

    quarantine = read_table(spark, layers.quarantine, "quarantine_order_items")
    assert {(r.order_id, r.order_item_id): r.check_name for r in quarantine.collect()} == {
        ("o6", 2): "fact_items (schema)",
        ("o6", 3): "fact_items (schema)",
        ("o2", 1): "items_to_orders",
        ("o1", 2): "items_to_products",
        ("o6", 1): "items_to_sellers",
    }
    assert quarantine.filter(F.col("quarantine_reason").isNull()).count() == 0
    for entity in result.clean:
        if entity == "category_translation":
            continue
        lost = read_table(spark, layers.quarantine, f"quarantine_{entity}").count() if _has(layers, entity) else 0
        raw = load_raw(spark, raw_dir)[entity].count()
        assert read_table(spark, layers.staging, entity).count() + lost == raw, entity

    audit = {r.rule: r.occurrences for r in read_table(spark, layers.work, "dq_audit").collect()}
    assert audit["products_without_category"] == 1 and audit["price_outliers"] == 0
    assert sorted(r.order_id for r in star.fact_orders.collect()) == ["o1", "o6"]
    assert tuple(profile.integrity(star).first())[:4] == (0, 0, 0, 0)
    assert sales.monthly_series(star).count() == 2


def _has(layers, entity):
    folder = f"{layers.quarantine}/quarantine_{entity}"
    return any(name.startswith("check_name=") for name in os.listdir(folder))


class _Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_shared_dir_follows_the_session():
    assert shared_dir(_Session("/shared/place/", "yarn")) == "/shared/place"
    with pytest.raises(ValueError):
        shared_dir(_Session(None, "yarn"))
    with pytest.raises(ValueError):
        shared_dir(_Session(None, "local-cluster[2,1,1024]"))
    folder = shared_dir(_Session(None, "local[2]"))
    assert os.path.isdir(folder) and shared_dir(_Session(None, "local[*]")) == folder
