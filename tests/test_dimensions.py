"""Slowly changing dimensions, entities and the layered jobs."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import dimensions as D
from tidemark.operators.joins import as_of, as_of_carried
from tidemark.plans import medallion, outlet_sales, warehouse
from tidemark.plans.views import ntz

NAMES = ["product_name", "category", "price"]
RAW = "product_id string, product_name string, category string, price decimal(10,2), updated string"
OLD, NOW = "2024-01-02 00:00:00", "2024-06-01 00:00:00"
FEW = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))

INITIAL = [
    ("P001", "Laptop Pro 15", "Electronics", "1200.00", "2024-01-01 10:00:00"),
    ("P002", "Wireless Mouse", "Accessories", "25.00", "2024-01-01 10:00:00"),
    ("P003", "Office Chair Deluxe", "Furniture", "150.00", "2024-01-01 10:00:00"),
]


def raw(spark, rows):
    loose = spark.createDataFrame(rows, RAW.replace("decimal(10,2)", "string"))
    return loose.select(
        "product_id", "product_name", "category", F.col("price").cast("decimal(10,2)").alias("price"),
        F.col("updated").cast("timestamp_ntz").alias("updated"),
    )


def dimension(spark, rows=INITIAL):
    return D.new_dimension(raw(spark, rows), "dim_key", "product_id", NAMES, "updated", ntz(OLD))


def apply(dim, batch, **options):
    return D.scd2_apply(dim, batch, "dim_key", "product_id", NAMES, "updated", ntz(NOW), **options)


def shown(df):
    text = lambda v: str(v) if isinstance(v, dt.date) else v
    picked = df.orderBy("dim_key").select("dim_key", "product_id", "category", "price", "effective_date", "end_date", "is_current")
    return [tuple(text(float(v)) if i == 3 else text(v) for i, v in enumerate(r)) for r in picked.collect()]


def test_type_1_golden(spark):
    target = raw(spark, INITIAL).drop("updated").withColumn("load_time", ntz(OLD))
    source = raw(
        spark,
        [
            ("P001", "Laptop Pro 15", "Electronics", "1250.00", NOW),
            ("P002", "Ergonomic Wireless Mouse", "Accessories", "25.00", NOW),
            ("P003", "Office Chair Deluxe", "Furniture", "150.00", NOW),
            ("P004", "Gaming Keyboard", "Accessories", "75.00", NOW),
        ],
    )
    merge = lambda t: D.scd1_merge(t, source, "product_id", NAMES, "load_time", ntz(NOW))
    once = merge(target)
    rows = {r.product_id: (r.product_name, float(r.price), str(r.load_time)) for r in once.collect()}
    assert rows == {
        "P001": ("Laptop Pro 15", 1250.0, NOW),
        "P002": ("Ergonomic Wireless Mouse", 25.0, NOW),
        "P003": ("Office Chair Deluxe", 150.0, OLD),
        "P004": ("Gaming Keyboard", 75.0, NOW),
    }
    assert merge(once).exceptAll(once).count() == 0


def test_type_1_nulls(spark):
    target = raw(spark, [("A", None, "x", "1.00", OLD)]).drop("updated").withColumn("load_time", ntz(OLD))
    source = raw(spark, [("A", "named", "x", "1.00", NOW)])
    names = [
        D.scd1_merge(target, source, "product_id", NAMES, "load_time", ntz(NOW), null_safe=safe).first().product_name
        for safe in (False, True)
    ]
    assert names == [None, "named"]


BATCH = [
    ("P001", "Laptop Pro 15", "Electronics", "1250.00", "2024-03-15 11:00:00"),
    ("P002", "Wireless Mouse", "Computer Peripherals", "25.00", "2024-04-01 09:30:00"),
    ("P003", "Office Chair Deluxe", "Furniture", "150.00", "2024-01-01 10:00:00"),
    ("P004", "Gaming Keyboard", "Accessories", "75.00", "2024-05-01 14:00:00"),
]
GOLDEN = [
    (1, "P001", "Electronics", "1200.0", "2024-01-01", "2024-03-14", False),
    (2, "P002", "Accessories", "25.0", "2024-01-01", "2024-03-31", False),
    (3, "P003", "Furniture", "150.0", "2024-01-01", "9999-12-31", True),
    (4, "P001", "Electronics", "1250.0", "2024-03-15", "9999-12-31", True),
    (5, "P002", "Computer Peripherals", "25.0", "2024-04-01", "9999-12-31", True),
    (6, "P004", "Accessories", "75.0", "2024-05-01", "9999-12-31", True),
]


def golden_text(rows):
    return [(*r[:3], float(r[3]), *r[4:]) for r in rows]


@pytest.mark.parametrize("strict", [False, True])
def test_type_2_golden(spark, strict):
    out = apply(dimension(spark), raw(spark, BATCH), strict=strict)
    assert shown(out) == golden_text(GOLDEN)
    touched = {r.dim_key for r in out.filter(F.col("load_time") == ntz(NOW)).collect()}
    assert touched == {1, 2, 4, 5, 6}
    again = apply(out, raw(spark, BATCH))
    assert shown(again) == golden_text(GOLDEN)


def test_type_2_two_rows_per_change_agrees(spark):
    dim, batch = dimension(spark), raw(spark, BATCH)
    twin = D.scd2_two_rows(dim, batch, "dim_key", "product_id", NAMES, "updated", ntz(NOW))
    assert shown(twin) == shown(apply(dim, batch))


def test_type_2_edges(spark):
    dim = dimension(spark)
    change = lambda day: ("P001", "Laptop Pro 15", "Electronics", "1300.00", f"{day} 00:00:00")
    # Same day and late: two current rows, as closing needs a strictly newer date.
    for day in ("2024-01-01", "2023-12-01"):
        out = apply(dim, raw(spark, [change(day)]))
        assert out.filter("product_id = 'P001' AND is_current").count() == 2
        strict = apply(dim, raw(spark, [change(day)]), strict=True)
        assert shown(strict) == shown(dim)
        late = D.late_rows(dim, raw(spark, [change(day)]), "dim_key", "product_id", NAMES, "updated")
        assert late.count() == 1
    # The same key twice on one day: two current rows, or refused in strict mode.
    twice = raw(spark, [change("2024-02-01"), ("P001", "Laptop Pro 16", "Electronics", "1300.00", "2024-02-01 00:00:00")])
    assert apply(dim, twice).filter("product_id = 'P001' AND is_current").count() == 2
    with pytest.raises(D.DuplicateKeys):
        apply(dim, twice, strict=True)
    # Twice on different days: a chain.
    chain = apply(dim, raw(spark, [change("2024-02-01"), ("P001", "Laptop Pro 16", "Electronics", "1.00", "2024-03-01 00:00:00")]))
    rows = [(str(r.effective_date), str(r.end_date)) for r in chain.filter("product_id = 'P001'").orderBy("effective_date").collect()]
    assert rows == [("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "9999-12-31")]
    # Empty batch, empty dimension, NULL change.
    assert shown(apply(dim, raw(spark, []))) == shown(dim)
    assert shown(apply(dim.limit(0), raw(spark, INITIAL))) == shown(dim)
    unnamed = raw(spark, [("P001", None, "Electronics", "1200.00", "2024-02-01 00:00:00")])
    assert apply(dim, unnamed).count() == 3
    assert apply(dim, unnamed, null_safe=True).count() == 4


PRODUCT = st.tuples(st.sampled_from(["P001", "P002", "P003", "P005"]), st.integers(1, 3), st.integers(1, 28))


@FEW
@given(st.lists(PRODUCT, max_size=4, unique_by=lambda p: p[0]), st.lists(PRODUCT, max_size=4, unique_by=lambda p: p[0]))
def test_one_current_row_per_key(spark, first, second):
    dim = dimension(spark)
    for month, batch in ((2, first), (3, second)):
        rows = [(k, "n", "c", f"{p}.00", f"2024-0{month}-{d:02d} 00:00:00") for k, p, d in batch]
        twin = D.scd2_two_rows(dim, raw(spark, rows), "dim_key", "product_id", NAMES, "updated", ntz(NOW))
        dim = apply(dim, raw(spark, rows), strict=True)
        assert shown(twin) == shown(dim)
    per_key = dim.groupBy("product_id").agg(F.count_if("is_current").alias("n")).collect()
    assert {r.n for r in per_key} == {1}
    assert dim.select("dim_key").distinct().count() == dim.count()


def test_types_0_3_4_6(spark):
    target = raw(spark, INITIAL).drop("updated")
    batch = raw(spark, BATCH)
    zero = D.scd0_insert(target, batch, "product_id")
    assert {r.product_id: float(r.price) for r in zero.collect()} == {"P001": 1200.0, "P002": 25.0, "P003": 150.0, "P004": 75.0}
    source = batch.drop("updated")
    three = D.scd3_merge(target, source, "product_id", "price")
    assert {r.product_id: r.previous_price and float(r.previous_price) for r in three.collect()} == {
        "P001": 1200.0, "P002": None, "P003": None, "P004": None
    }
    again = D.scd3_merge(three, source, "product_id", "price").filter("product_id = 'P001'").first()
    assert (float(again.price), float(again.previous_price)) == (1250.0, 1200.0)
    loaded = target.withColumn("load_time", ntz(OLD))
    current, history = D.scd4_split(loaded, batch, "product_id", NAMES, "load_time", ntz(NOW))
    assert (current.count(), sorted(r.product_id for r in history.collect())) == (4, ["P001", "P002"])
    six = D.scd6_view(apply(dimension(spark), batch), "product_id", ["category"])
    assert {(r.dim_key, r.current_category) for r in six.collect()} >= {(2, "Computer Peripherals"), (5, "Computer Peripherals")}


def test_as_of_takes_the_version_of_the_day(spark):
    dim = apply(dimension(spark), raw(spark, BATCH)).select("product_id", "price", "effective_date", "end_date")
    facts = spark.createDataFrame(
        [("P001", "2024-03-14"), ("P001", "2024-03-15"), ("P001", "2023-01-01")], "product_id string, sold string"
    ).withColumn("sold", F.to_date("sold"))
    joined = as_of(facts, dim, "product_id", "sold").orderBy("sold").collect()
    assert [r.price and float(r.price) for r in joined] == [None, 1200.0, 1250.0]


def spans(spark, versions):
    return spark.createDataFrame(versions, "k string, price int, a int, b int").selectExpr(
        "k", "price", "date_add(DATE'2024-01-01', a) effective_date", "date_add(DATE'2024-01-01', b) end_date"
    )


def dated_facts(spark, n):
    return spark.range(n).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 5) END k",
        "CASE WHEN id % 11 <> 0 THEN date_add(DATE'2023-12-20', cast(id * 7919 % 500 AS int)) END sold",
    )


@pytest.mark.parametrize("most", [5, 1_000_000])
def test_carried_versions_are_those_of_the_range_join(spark, most):
    chain = [("hot", i, 2 * i, 2 * i + 1) for i in range(150)] + [("k1", -1, 3, 90), ("k1", -2, 91, 90), ("k1", -3, 120, 400), ("k2", -4, 0, 9000)]
    facts, versions = dated_facts(spark, 900), spans(spark, [*chain, (None, 5, 0, 400), ("k4", 6, None, 400), ("k4", 7, 3, None)])
    expected = as_of(facts, versions, "k", "sold").select("id", "sold", "price", "end_date").collect()
    carried = as_of_carried(facts, versions, "k", "sold", ["id"], most=most)
    assert carried.columns == [*facts.columns, "price", "effective_date", "end_date"]
    assert sorted(map(repr, carried.select("id", "sold", "price", "end_date").collect())) == sorted(map(repr, expected))


def test_carried_versions_overlap_and_tie(spark):
    versions = spans(spark, [("k1", 1, 0, 9000), ("k1", 2, 10, 20), ("k1", 3, 10, 30)])
    facts = spark.createDataFrame([("k1", 5), ("k1", 10), ("k1", 40)], "k string, d int").selectExpr("k", "d", "date_add(DATE'2024-01-01', d) sold")
    carried = as_of_carried(facts, versions, "k", "sold", ["d"])
    assert {r.d: r.price for r in carried.collect()} == {5: 1, 10: 3, 40: None}
    assert as_of_carried(facts.limit(0), versions, "k", "sold", ["d"]).count() == 0
    assert [r.price for r in as_of_carried(facts, versions.limit(0), "k", "sold", ["d"]).collect()] == [None] * 3


def test_carried_versions_of_a_long_chain(spark):
    """A key with 20,000 versions and all facts: no join of facts with versions on the key."""
    versions = spark.range(20_000).selectExpr(
        "'hot' k", "cast(id AS int) price", "timestamp_seconds(id * 3600) effective_date", "timestamp_seconds(id * 3600 + 3599) end_date"
    )
    facts = spark.range(60_000).selectExpr("id", "'hot' k", "timestamp_seconds(id * 1200 + 7) sold")
    carried = as_of_carried(facts, versions, "k", "sold", ["id"], most=1000)
    assert carried.filter("price IS NULL OR price <> id div 3").count() == 0 and carried.count() == 60_000


WIDE = """order_id string, order_date date, customer_id string, customer_name string, customer_email string,
customer_address string, product_id string, product_name string, product_category string, product_price double,
quantity int, total_price double"""


def wide(spark):
    ann, ben = ("C1", "Ann", "ann@x", "Road 1"), ("C2", "Ben", "ben@x", "Road 2")
    pen, ink = ("A", "Pen", "Office", 3.0), ("B", "Ink", "Supplies", 7.0)
    rows = [
        ("O1", dt.date(2024, 1, 10), *ann, *pen, 2, 6.0),
        ("O1", dt.date(2024, 1, 10), *ann, *ink, 1, 99.0),
        ("O2", dt.date(2024, 2, 29), *ben, *pen, 5, 15.0),
    ]
    df = spark.createDataFrame(rows, WIDE)
    return df.withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("product_price", "total_price")})


def test_star_takes_prices_from_the_dimension(spark):
    e = warehouse.normalise(wide(spark))
    assert [f.count() for f in (e.customers, e.products, e.orders, e.order_items)] == [2, 2, 2, 3]
    assert sorted(r.order_item_sk for r in e.order_items.collect()) == [1, 2, 3]
    assert float(e.order_items.agg(F.sum("item_total_price")).first()[0]) == 120.0
    fact = warehouse.sales_fact(e)
    rows = sorted((r.order_sk, r.customer_key, r.product_key, r.date_key, r.quantity, float(r.total_sales_amount)) for r in fact.collect())
    assert rows == [(1, 1, 1, 20240110, 2, 6.0), (1, 1, 2, 20240110, 1, 7.0), (2, 2, 1, 20240229, 5, 15.0)]
    days = warehouse.day_dimension(wide(spark)).orderBy("date_key").collect()
    assert [tuple(r)[2:] for r in days] == [("Wed", "Jan", 1, 2024), ("Thu", "Feb", 1, 2024)]


def test_two_variants_of_a_natural_key_give_two_rows(spark):
    df = wide(spark).withColumn("customer_name", F.when(F.col("product_id") == "B", "Anna").otherwise(F.col("customer_name")))
    assert warehouse.normalise(df, number_items=False).customers.count() == 3


def test_bronze_to_monthly(spark):
    landing = spark.createDataFrame(
        [("1", "p", "c", 2, 1.5, "2024-01-31 23:00:00", "North"), ("2", "p", "c", 1, 0.1, "2024-01-02 00:00:00", "North")],
        "order_id string, product_id string, customer_id string, quantity int, price_per_unit double, order_date string, region string",
    ).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
    bronze = warehouse.bronze_orders(landing, ntz(NOW))
    assert len(bronze.columns) == 8
    assert tuple(warehouse.monthly_sales(bronze).first()) == ("p", "North", "2024-01", 3.1, 3)
    for name in ("t_bronze", "t_monthly"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    counts = []
    for append in (False, False, True):
        warehouse.load_monthly(landing, ntz(NOW), "t_bronze", "t_monthly", append)
        counts.append((spark.table("t_bronze").count(), spark.table("t_monthly").count()))
    assert counts == [(2, 1), (2, 1), (2, 2)]


def test_medallion_writes_three_layers(spark, tmp_path):
    rows = [
        ("phone", (10, 2), "order placed", "email"), ("phone", (1, 1), "add to cart", "referral"),
        ("tv", (5, 1), "order placed", "email"), (None, (1, 1), "view", "email"), ("tv", (None, 1), "view", "email"),
    ]
    source = spark.createDataFrame(rows, "device string, ecommerce struct<price: int, unit: int>, event_name string, traffic_source string")
    kpis = medallion.run(source, str(tmp_path))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    assert silver.count() == 3 and silver.filter("campaign_type IS NULL").count() == 1
    assert [tuple(r) for r in kpis["conversion"].orderBy("device").collect()] == [("phone", 1, 1, 1.0), ("tv", 1, 0, None)]
    exported = next((tmp_path / "gold" / "kpi_sales_by_device.csv").glob("part-*.csv")).read_text()
    assert exported == "tv,5.0\nphone,21.0\n"


def test_outlet_kpis(spark, tmp_path):
    sales = spark.createDataFrame(
        [("S", "T1", 1.1, "G", "Dairy", 0), (None, "T1", 2.2, "G", "Dairy", 0), ("S", "T2", 3.3, "H", None, 0)],
        "outlet_size string, outlet_location_type string, item_outlet_sales double, outlet_type string, item_type string, other int",
    )
    outlet_sales.run(sales, str(tmp_path))
    per_item = spark.read.csv(str(tmp_path / "sales_item_type"), header=True)
    assert {tuple(r) for r in per_item.collect()} == {("Dairy", "3.3", "2"), (None, "3.3", "0")}
    assert spark.read.csv(str(tmp_path / "location_outlet"), header=True).columns == [
        "outlet_location_type", "outlet_size", "Total_Sales", "Item_Sold"
    ]


def test_a_repeated_batch_key_counts_once(spark):
    now = F.lit("2024-01-01").cast("timestamp")
    target = spark.createDataFrame([(1, "a", None)], "k int, v string, at timestamp")
    batch = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "x", 1), (2, "y", 2), (None, "n", 1)], "k int, v string, seq int")
    merged = D.scd1_merge(target, batch, "k", ["v"], "at", now, newest=[F.desc("seq")])
    assert sorted((str(r.k), r.v) for r in merged.collect()) == [("1", "c"), ("2", "y"), ("None", "n")]
    assert sorted((r.k, r.v) for r in D.scd0_insert(target.select("k", "v"), batch.filter("k is not null"), "k", [F.desc("seq")]).collect()) == [(1, "a"), (2, "y")]
    third = D.scd3_merge(target.select("k", "v"), batch.select("k", "v", "seq").filter("k is not null"), "k", "v", [F.desc("seq")])
    assert sorted((r.k, r.v, r.previous_v) for r in third.collect()) == [(1, "c", "a"), (2, "y", None)]
    current, replaced = D.scd4_split(target, batch, "k", ["v"], "at", now, newest=[F.desc("seq")])
    assert current.count() == 3 and replaced.count() == 1


def test_star_refuses_variants_when_asked_and_reads_lines_once(spark):
    df = wide(spark).withColumn("customer_name", F.when(F.col("product_id") == "B", "Anna").otherwise(F.col("customer_name")))
    with pytest.raises(D.DuplicateKeys):
        warehouse.normalise(df, unique=True)
    fact = warehouse.sales_fact(warehouse.normalise(wide(spark), unique=True))
    assert fact.count() == 3
