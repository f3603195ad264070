import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from helpers import customer, product, raw_table, rows, sale, write_raw
from starmill.operators import sinks
from starmill.operators.ledger import append_new
from starmill.plans.checks import catalog_statistics
from starmill.schemas import CURATED, RAW
from starmill.sources import files, raw


def table(spark, *data):
    return spark.createDataFrame(list(data), "id string, month int, amount int")


def test_replayed_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = table(spark, ("a", 1, 10), ("b", 1, 20)), table(spark, ("b", 1, 20), ("c", 2, 30))
    counts = [append_new(df, path, "id", ["month"])["rows"] for df in (first, second, second)]
    assert counts == [2, 1, 0]
    assert rows(sinks.read_table(spark, path), "id", "month", "amount") == [("a", 1, 10), ("b", 1, 20), ("c", 2, 30)]
    repeated = table(spark, ("d", 1, 1), ("d", 1, 2), ("a", 9, 9), (None, 3, 3), (None, 3, 3))
    assert append_new(repeated, path, "id", ["month"])["rows"] == 3
    assert rows(sinks.read_table(spark, path).where("id = 'd' OR id IS NULL"), "id", "amount") == [("d", 2), (None, 3), (None, 3)]


def test_only_the_given_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(table(spark, ("a", 1, 10), ("b", 2, 20)), path, partition_by=["month"])
    sinks.replace_partitions(table(spark, ("c", 2, 99)), path, ["month"])
    assert rows(sinks.read_table(spark, path), "id", "month", "amount") == [("a", 1, 10), ("c", 2, 99)]


def test_write_reports_counts(spark, tmp_path):
    out = sinks.write_table(table(spark, ("a", 1, 10), (None, 2, 20)), str(tmp_path / "t"), ids=F.count("id"))
    assert out == {"rows": 2, "ids": 1}
    assert sinks.write_table(table(spark, ("a", 1, 1)).where("false"), str(tmp_path / "u"))["rows"] == 0


def test_compaction_keeps_rows_and_sorts_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v"))
    sinks.compact_sorted(df, path, ["k"], files=4)
    back = sinks.read_table(spark, path)
    assert rows(back) == rows(df)
    spans = back.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
    assert len(spans) == 4 and all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))


def test_csv_export_keeps_quotes_and_commas(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = raw_table(spark, "products", [product(1, product_name='17" screen, wide'), product(2, brand=None)])
    sinks.export_csv(df, path)
    assert rows(raw.read_raw(spark, path, "products")) == rows(df)


def test_catalog_table_has_types_comments_and_statistics(spark, tmp_path):
    path = str(tmp_path / "product_dim")
    df = spark.createDataFrame([], CURATED["product_dim"])
    sinks.write_table(df, path)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for _ in range(2):
        sinks.register_table(spark, "shop.product_dim", path, CURATED["product_dim"], "Products")
    sinks.analyze_table(spark, "shop.product_dim")
    described = {r.col_name: (r.data_type, r.comment) for r in spark.sql("DESCRIBE shop.product_dim").collect()}
    assert described["margin"][0] == "decimal(5,2)" and "Percent" in described["margin"][1]
    found = raw.read_catalog(spark, "shop", "product_dim")
    assert found.count() == 0 and found.schema.names == CURATED["product_dim"].names
    assert [tuple(r) for r in catalog_statistics(spark, "shop").collect()] == [("shop", "product_dim", 0)]
    assert files.missing_tables(spark, "shop", ["product_dim", "sales_fact"]) == ["sales_fact"]
    with pytest.raises(Exception):
        raw.read_catalog(spark, "shop", "nothing")


def test_rows_read_are_counted_on_the_way(spark, tmp_path):
    df, seen = raw.count_reads(table(spark, ("a", 1, 10), ("b", 1, 20)))
    sinks.write_table(df.where("id = 'a'"), str(tmp_path / "t"))
    assert seen.get == {"rows": 2}


def write_lines(path, lines):
    os.makedirs(path)
    with open(f"{path}/data.csv", "w") as f:
        f.write("\n".join(lines) + "\n\n\n")


def test_text_files_keep_leading_zeros_and_skip_blank_lines(spark, tmp_path):
    path = str(tmp_path / "customers")
    header = ",".join(RAW["customers"].names)
    write_lines(path, [header, ",".join(customer(1).values())])
    out = raw.read_raw(spark, path, "customers", with_version=True).collect()
    assert len(out) == 1 and out[0].zip_code == "02101" and out[0].source_modified is not None


def test_columns_go_by_name_not_by_position(spark, tmp_path):
    path = str(tmp_path / "products")
    row = {"colour": "red", **product(1)}
    names = sorted(row)
    write_lines(path, [",".join(names), ",".join(row[n] for n in names)])
    assert raw.read_raw(spark, path, "products").first().asDict() == product(1)
    with open(f"{path}/other.csv", "w") as f:
        f.write(",".join(product(2)) + ",colour\n" + ",".join(product(2).values()) + ",blue\n")
    with pytest.raises(Exception):
        raw.read_raw(spark, path, "products").collect()


def test_missing_column_is_an_error(spark, tmp_path):
    path = str(tmp_path / "products")
    write_lines(path, ["product_id,brand", "PROD1,B"])
    with pytest.raises(Exception, match="product_name"):
        raw.read_raw(spark, path, "products")


@pytest.mark.parametrize("bad, passes", [(0, True), (100, True), (101, False)])
def test_error_budget(spark, tmp_path, bad, passes):
    good = [",".join(sale(i).values()) for i in range(50)]
    broken = [",".join(sale(i, quantity="many").values()) for i in range(bad)]
    path, target, quarantine = (str(tmp_path / n) for n in ("in", "out", "bad"))
    write_lines(path, [",".join(RAW["sales"].names), *good, *broken])

    def load():
        return raw.bulk_load(spark, path, "sales", RAW["sales"], target, quarantine, F.current_timestamp())

    if passes:
        assert load() == {"table_name": "sales", "rows_read": 50 + bad, "rows_loaded": 50, "rows_rejected": bad}
        assert spark.read.parquet(target).count() == 50
    else:
        with pytest.raises(raw.LoadError):
            load()
        assert not os.path.exists(target)
        with pytest.raises(raw.LoadError):
            load()
    if bad:  # a repeated load does not repeat its lines
        assert spark.read.parquet(quarantine).where("raw_line LIKE '%many%'").count() == bad


def test_loads_append_or_replace_and_require_columns(spark, tmp_path):
    names, target, quarantine = ",".join(RAW["sales"].names), str(tmp_path / "out"), str(tmp_path / "bad")
    write_lines(str(tmp_path / "one"), [names, ",".join(sale(1).values()), ",".join(sale(2, customer_id="").values())])
    write_lines(str(tmp_path / "two"), [names, ",".join(sale(3, sale_date="05/01/2024").values())])

    def load(part, **options):
        return raw.bulk_load(spark, str(tmp_path / part), "sales", RAW["sales"], target, quarantine, F.current_timestamp(), **options)

    assert load("one")["rows_rejected"] == 1
    assert load("two", append=True, dateFormat="dd/MM/yyyy")["rows_loaded"] == 1
    assert rows(spark.read.parquet(target), "sale_id") == [("SALE1",), ("SALE3",)]
    load("one")
    assert rows(spark.read.parquet(target), "sale_id") == [("SALE1",)]


def test_comments_may_hold_quotes(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(table(spark, ("a", 1, 1)), path)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop2")
    schema = table(spark, ("a", 1, 1)).schema
    schema["id"].metadata = {"comment": "the shop's \\ own"}
    sinks.register_table(spark, "shop2.t", path, schema, "it's a table")
    assert {r.col_name: r.comment for r in spark.sql("DESCRIBE shop2.t").collect()}["id"] == "the shop's \\ own"


def test_schema_drift(spark, tmp_path):
    path = str(tmp_path / "products")
    raw_table(spark, "products", [product(1), product(2, cost="?")]).drop("brand").withColumn("colour", F.lit("red")).write.option(
        "header", True).csv(path)
    found = {r.column_name: r.status for r in raw.schema_drift(spark, path, "products").collect()}
    assert (found["brand"], found["colour"], found["cost"], found["product_name"]) == ("missing", "extra", "type_differs", "match")


def test_folder_report_and_freshness(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_raw(spark, root, [customer(1)], [product(1)], [], [sale(1)], fmt="csv")
    report = {r.folder: r for r in files.folder_report(spark, root, ["customers", "sales", "returns"]).collect()}
    again = files.folder_report(spark, f"file://{root}/", ["customers", "sales", "returns"])
    assert {r.folder: r.passed for r in again.collect()} == {"customers": True, "sales": True, "returns": False}
    assert report["customers"].passed and report["sales"].bytes > 0
    assert (report["returns"].present, report["returns"].passed, report["returns"].bytes) == (False, False, 0)
    nowhere = files.folder_report(spark, str(tmp_path / "nowhere"), ["sales"]).first()
    assert (nowhere.present, nowhere.passed, nowhere.files) == (False, False, 0)
    assert files.file_freshness(spark, str(tmp_path / "nowhere"), F.current_timestamp()).first().status == "NO_DATA"
    soon = F.lit(datetime.now(timezone.utc) + timedelta(hours=1))
    late = F.lit(datetime.now(timezone.utc) + timedelta(hours=30))
    assert files.file_freshness(spark, f"{root}/sales", soon).first().status == "FRESH"
    assert files.file_freshness(spark, f"{root}/sales", late).first().status == "STALE"
    empty = spark.createDataFrame([(None,)], "last_modified timestamp")
    assert tuple(files.freshness_of(empty, soon).select("fresh", "status").first()) == (False, "NO_DATA")
