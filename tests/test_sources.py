"""CSV source: selection by name, null tokens, try_cast, missing columns and
files; warehouse write / read back / insert-ignore append."""

import random
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stardw.schemas import column_order
from stardw.session import scratch_dir
from stardw.sources import key_index
from stardw.sources.csv import CSV_OPTIONS, _fields, csv_files, files_by_header, read_csv_table, read_optional, read_raw_csv
from stardw.sources.quoted import numbered_lines, quoted_records
from stardw.sources.warehouse_io import TABLES, append_ignore, read_table, write_table


def test_columns_by_name_tokens_and_bad_values(spark, tmp_path):
    (tmp_path / "items.csv").write_text(
        "freight_value,extra,price,seller_id,product_id,order_item_id,order_id\n"
        "1.50,x,10.00,s1,p1,1,o1\n"
        "NA,x,abc,None,p2,two,o2\n"
        "n/a,x,,NULL,p3,3,\n")
    df = read_csv_table(spark, str(tmp_path / "items.csv"), "items")
    assert df.columns == ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]
    rows = sorted(df.collect(), key=lambda r: r["product_id"])
    assert tuple(rows[0]) == ("o1", 1, "p1", "s1", Decimal("10.00"), Decimal("1.50"))
    assert tuple(rows[1]) == ("o2", None, "p2", None, None, None)   # unparsable -> NULL, tokens -> NULL
    assert rows[2]["order_id"] is None and rows[2]["order_item_id"] == 3


def test_missing_column_and_file(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,product_weight_g\np1,100\n")
    df = read_csv_table(spark, str(tmp_path / "products.csv"), "products")
    assert df.collect()[0].asDict() == {"product_id": "p1", "product_category_name": None}
    assert read_csv_table(spark, str(tmp_path / "absent.csv"), "reviews") is None
    empty = read_optional(spark, str(tmp_path / "absent.csv"), "reviews")
    assert empty.count() == 0 and [f.dataType.simpleString() for f in empty.schema] == ["string", "int"]


def test_raw_csv_with_renamed_files(spark, tmp_path):
    (tmp_path / "sellers_dataset.csv").write_text("seller_id,seller_city,seller_state\ns1,x,SP\n")
    raw = read_raw_csv(spark, str(tmp_path), files={"sellers": "sellers_dataset.csv"})
    assert raw.sellers.count() == 1 and raw.customers.count() == 0


def test_write_read_and_append_ignore(spark):
    base = scratch_dir(spark, "wio")
    rows = spark.createDataFrame(
        [("o1", 1, 20170101, 5), ("o1", 2, 20170101, 6), ("o2", 1, 20170102, 7)],
        "order_id string, order_item_id smallint, sk_date_purchase int, sk_seller int")
    cols = {c: F.lit(None) for c in ["sk_date_delivered", "sk_date_estimated_delivery", "sk_customer",
                                      "sk_product", "price", "freight_value", "revenue", "gross_profit",
                                      "unit_cost", "delivery_days", "is_on_time", "review_score"]}  # untyped: the sink casts
    fact = rows.withColumns(cols)
    write_table(fact, base, "fact_order_item")
    back = read_table(spark, base, "fact_order_item")
    assert back.columns[:3] == ["order_id", "order_item_id", "sk_date_purchase"] and back.count() == 3
    assert dict(back.dtypes)["sk_customer"] == "bigint" and dict(back.dtypes)["price"] == "decimal(10,2)"
    batch = spark.createDataFrame(
        [("o1", 2, 20170101, 9), ("o3", 1, 20170103, 8), ("o3", 1, 20170103, 1)],
        "order_id string, order_item_id smallint, sk_date_purchase int, sk_seller int").withColumns(cols)
    added = append_ignore(batch, base, "fact_order_item", ["order_id", "order_item_id"], ["sk_seller"])
    assert [(r["order_id"], r["sk_seller"]) for r in added.collect()] == [("o3", 1)]
    final = read_table(spark, base, "fact_order_item")
    assert final.count() == 4
    assert final.where("order_id = 'o1' AND order_item_id = 2").first()["sk_seller"] == 6  # existing row kept
    # the key decides, whatever the other columns say: another date, or none
    moved = spark.createDataFrame([("o1", 1, 20200505, 1), ("o2", 1, None, 1)],
                                  "order_id string, order_item_id smallint, sk_date_purchase int, sk_seller int").withColumns(cols)
    assert append_ignore(moved, base, "fact_order_item", ["order_id", "order_item_id"], ["sk_seller"]).count() == 0
    assert read_table(spark, base, "fact_order_item").count() == 4


def _fact(spark, rows):
    names = ["order_id", "order_item_id", "sk_date_purchase", "sk_seller"]
    df = spark.createDataFrame(rows, "order_id string, order_item_id smallint, sk_date_purchase int, sk_seller int")
    return df.withColumns({c: F.lit(None) for c in column_order("fact_order_item") if c not in names})


def test_an_append_reads_its_own_buckets_only(spark):
    base, keys = scratch_dir(spark, "wio-index"), ["order_id", "order_item_id"]
    path = f"{base}/fact_order_item"
    write_table(_fact(spark, [(f"o{k}", 1, 20170101, k) for k in range(3000)]), base, "fact_order_item")
    assert append_ignore(_fact(spark, [("o7", 1, 1, 1), ("new", 1, 1, 1)]), base, "fact_order_item", keys, ["sk_seller"]).count() == 1
    stored = read_table(spark, base, "fact_order_item")
    index = key_index.open_index(stored, keys, path)
    assert index.count() == 3001 and len(index.inputFiles()) >= 250
    batch = _fact(spark, [("new", 1, 2, 2), ("o8", 1, 2, 2), ("newer", 1, 2, 2)])
    met = key_index.keys_met(index, keys, batch)
    assert 0 < met.count() < 100 and "fact_order_item/" not in met._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in met._jdf.queryExecution().toString() or "PartitionFilters: [bucket" in met._jdf.queryExecution().toString()
    assert [r.order_id for r in append_ignore(batch, base, "fact_order_item", keys, ["sk_seller"]).collect()] == ["newer"]
    # an append that was cut off after the rows were written: the index is built anew
    key_index.begin_append(spark, path)
    _fact(spark, [("lost", 1, 3, 3)]).select(*stored.columns).select(*[F.col(c).cast(t) for c, t in stored.dtypes]).write.mode("append").parquet(path)
    assert append_ignore(_fact(spark, [("lost", 1, 3, 3), ("last", 1, 3, 3)]), base, "fact_order_item", keys, ["sk_seller"]).count() == 1
    assert read_table(spark, base, "fact_order_item").count() == 3004
    # a table written anew has no old keys
    write_table(_fact(spark, [("o1", 1, 1, 1)]), base, "fact_order_item")
    assert append_ignore(_fact(spark, [("o1", 1, 1, 1), ("o2", 1, 1, 1)]), base, "fact_order_item", keys, ["sk_seller"]).count() == 1


def test_append_to_unreadable_table_and_null_key_are_errors(spark):
    base = scratch_dir(spark, "wio-bad")
    spark.createDataFrame([("o1", 1)], "order_id string, order_item_id smallint").write.parquet(f"{base}/fact_order_item")
    row = spark.createDataFrame([("o1", 1, 1)], "order_id string, order_item_id smallint, sk_seller bigint")
    full = row.withColumns({c: F.lit(None) for c in column_order("fact_order_item") if c not in row.columns})
    with pytest.raises(AnalysisException):
        append_ignore(full, base, "fact_order_item", ["order_id", "order_item_id"], ["sk_seller"])
    with pytest.raises(Exception, match="a key column"):
        append_ignore(full.withColumn("order_item_id", F.lit(None).cast("smallint")), scratch_dir(spark, "wio-null"),
                      "fact_order_item", ["order_id", "order_item_id"], ["sk_seller"])


def test_numbers_tokens_and_times_as_the_source_reads_them(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text("order_id,review_score\no1,5.0\no2,4\no3,4.5\n NA ,1\n  ,2\n")
    got = {r["order_id"]: r["review_score"] for r in read_csv_table(spark, str(tmp_path / "reviews.csv"), "reviews").collect()}
    assert got == {"o1": 5, "o2": 4, "o3": None, " NA ": 1, "  ": 2}
    (tmp_path / "orders.csv").write_text(
        "order_id,order_purchase_timestamp\na,9999-12-31 00:00:00\nb,2262-04-11 23:47:16\nc,1600-01-01\n")
    got = {r[0]: r[2] for r in read_csv_table(spark, str(tmp_path / "orders.csv"), "orders").collect()}
    assert got["a"] is None and got["c"] is None and got["b"] is not None


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "sellers.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("seller_id,seller_city,seller_state\ns1,c1,SP\n")
    (folder / "b.csv").write_text("\ufeffseller_state,seller_id,extra,seller_city\nRJ,s2,x,c2\n")
    (folder / "c d%.csv").write_text("seller_city,seller_id\nc3,s3\n")
    (folder / "empty.csv").write_text("")
    (folder / "header.csv").write_text("seller_id,seller_city,seller_state\n")
    rows = {r.seller_id: tuple(r) for r in read_csv_table(spark, str(folder), "sellers").collect()}
    assert rows == {"s1": ("s1", "c1", "SP"), "s2": ("s2", "c2", "RJ"), "s3": ("s3", "c3", None)}


def test_quoted_breaks_are_read_by_many_tasks(spark, tmp_path):
    """Rows equal Spark's own reader with one task a file, whatever the splits."""
    rnd = random.Random(1)

    def field():
        text = "".join(rnd.choices(["a", "b", " ", ",", '"', "\n", "\r\n", "é", "x y", "NA", "\x01"], k=rnd.randrange(12)))
        return '"' + text.replace('"', '""') + '"' if set(text) & set(',"\n\r') or rnd.random() < 0.2 else text
    folder = tmp_path / "reviews.csv"
    folder.mkdir()
    for n, end in enumerate(("\n", "\r\n", "\n")):
        with open(folder / f"p{n}.csv", "w", newline="") as f:
            f.write(f'review_id,"order_id",review_comment,review_score{end}')
            f.writelines(f"{k},o{n}-{k},{field()},{rnd.randint(1, 5)}{end}" for k in range(1500))
    whole = spark.read.options(**CSV_OPTIONS).option("header", True).option("multiLine", True).csv(str(folder))
    want = sorted((r.order_id, int(r.review_score)) for r in whole.collect())
    plain = lambda t: str(t).replace("\r\n", "\n")  # noqa: E731  (Spark's reader turns them in files that end lines so)
    texts = sorted(plain(r.review_comment) for r in whole.collect())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("8k", "1k", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = read_csv_table(spark, str(folder), "reviews")
            assert sorted(map(tuple, got.collect())) == want
            files = csv_files(spark, str(folder))
            lines = numbered_lines(spark, files)
            assert lines.rdd.getNumPartitions() > 8 or size == old
            records = quoted_records(spark, files)
            assert records.groupBy("file").agg(F.max("record").alias("n"), F.count("*").alias("k")).where("n <> 1501 OR k <> 1501").count() == 0
            assert size == "1k" or texts == sorted(plain(r.c2) for (h, fs) in files_by_header(spark, files).items() for r in _fields(spark, h, fs, True).collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_register_catalog_and_query_with_sql(spark):
    from stardw.params import FIXTURE_PARAMS
    from stardw.plans.load import load_warehouse
    from stardw.sources import fixtures as FX
    from stardw.sources.warehouse_io import register_catalog
    from paths import SF_SMALL
    base = scratch_dir(spark, "catalog")
    wh = load_warehouse(FX.fixture_tables(spark, SF_SMALL), FIXTURE_PARAMS, base)
    names = register_catalog(spark, base, database="stardw_test")
    assert len(names) == 7
    by_tier = spark.sql("""
        SELECT s.seller_tier, count(*) AS items, sum(f.revenue) AS revenue
        FROM stardw_test.fact_order_item f JOIN stardw_test.dim_seller s ON f.sk_seller = s.sk_seller
        GROUP BY s.seller_tier""").collect()
    assert sum(r["items"] for r in by_tier) == wh.fact_order_item.count()
    # another warehouse under the same names is really read, and the first one's files stay
    second = scratch_dir(spark, "catalog-2")
    for t in TABLES:
        write_table(read_table(spark, base, t).limit(2), second, t)
    assert register_catalog(spark, second, database="stardw_test") == names
    assert spark.table("stardw_test.fact_order_item").count() == 2
    assert read_table(spark, base, "fact_order_item").count() == wh.fact_order_item.count() > 2
    spark.sql("DROP TABLE stardw_test.dim_date")
    spark.sql("CREATE TABLE stardw_test.dim_date (x INT) USING parquet")
    with pytest.raises(ValueError, match="no external table"):
        register_catalog(spark, base, database="stardw_test")
