from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankspark import schemas as S
from bankspark.sources import files, mapping, scratch, tables
from bankspark.sources.literals import literal_table


@pytest.fixture()
def branches_csv(tmp_path):
    path = tmp_path / "branches.csv"
    path.write_text("branch_id,branch_name,state,region\nB001,Main,Johor,Southern\n007,Other,Perak,Northern\n")
    return str(path)


def test_declared_schema_keeps_ids_as_text(spark, branches_csv):
    df = files.read_csv(spark, branches_csv, S.BRANCHES)
    assert df.schema == S.BRANCHES
    assert [r["branch_id"] for r in df.orderBy("branch_id").collect()] == ["007", "B001"]


def test_declared_schema_checks_the_header(spark, branches_csv):
    wrong = T.StructType([T.StructField(n, T.StringType()) for n in ("branch_id", "state", "branch_name", "region")])
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, branches_csv, wrong).collect()


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,amount,day,n\nA1,-1.5,2001-08-31,7\nA2,2,2001-09-01,8\n")
    df = files.read_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "double", "date", "int"]
    assert df.filter("id = 'A1'").first()["day"] == dt.date(2001, 8, 31)


def test_overwrite_replaces_the_schema(spark):
    tables.write_table(spark.range(3), "replaced")
    tables.write_table(spark.range(2).select(F.lit("x").alias("name"), "id"), "replaced")
    assert tables.scan(spark, "replaced").columns == ["name", "id"]
    assert tables.scan(spark, "default.replaced").count() == 2
    assert tables.scan(spark, "spark_catalog.default.replaced").count() == 2


def test_partitioned_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, txn_month string")
    tables.write_table(df, "monthly", str(tmp_path / "monthly"), partition_by=["txn_month"])
    assert sorted(p.name for p in (tmp_path / "monthly").iterdir() if p.is_dir()) == ["txn_month=a", "txn_month=b"]
    assert tables.scan(spark, "monthly").count() == 2


def test_create_or_replace(spark):
    stored = tables.create_or_replace(spark, "made", spark.range(4).filter("id > 1"))
    assert [r[0] for r in stored.orderBy("id").collect()] == [2, 3]


def test_ingest_counts_without_a_second_read(spark, tmp_path, branches_csv):
    given = mapping.GivenTables(spark, "/root/testdata/sf0.001")
    given.transactions.write.option("header", True).csv(str(tmp_path / "transactions.csv"))
    counts = tables.ingest(
        spark, {"branches": branches_csv, "transactions": str(tmp_path / "transactions.csv")},
        S.TABLES, str(tmp_path / "bronze"), "raw_")
    assert {tuple(r) for r in counts.collect()} == {("branches", 2, 0), ("transactions", 6000, 0)}
    assert tables.scan(spark, "raw_transactions").schema == S.TRANSACTIONS
    assert tables.scan(spark, "raw_transactions").count() == 6000


def test_bad_lines_are_counted_and_kept(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,amount,day\nA1,1.50,2024-01-31\nA2,\"1,200.50\",2024-01-31\nA3,1,2024-13-01\nA4,2\nA5,,\n")
    schema = T.StructType.fromDDL("id string, amount double, day date")
    counts = tables.ingest(spark, {"t": str(path)}, {"t": schema}, str(tmp_path / "out"), "bad_")
    assert [tuple(r) for r in counts.collect()] == [("t", 2, 3)]
    assert sorted(r["id"] for r in tables.scan(spark, "bad_t").collect()) == ["A1", "A5"]
    lines = sorted(r[files.REJECTED] for r in tables.scan(spark, "bad_t_rejected").collect())
    assert [line[:2] for line in lines] == ["A2", "A3", "A4"]


def test_stored_folders_can_be_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "_made", [])
    kept = scratch.store(spark.range(3))
    folder = scratch._made[0]
    assert kept.count() == 3
    scratch.clean(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_comments(spark):
    tables.write_table(spark.range(1), "described")
    tables.comment_on(spark, "described", "One row. It's \\ small")
    assert tables.comment_of(spark, "described") == "One row. It's \\ small"


def test_doc_inventory(spark, tmp_path):
    for name in ("a.pdf", "B.PDF", "c.txt"):
        (tmp_path / name).write_bytes(b"12345")
    found = files.doc_inventory(spark, str(tmp_path))
    assert [(r["file_name"], r["bytes"]) for r in found.collect()] == [("B.PDF", 5), ("a.pdf", 5)]
    assert "content" not in found.columns
    assert files.doc_inventory(spark, str(tmp_path), "txt").count() == 1


def test_preview_is_ordered(spark):
    assert [r[0] for r in files.preview(spark.range(100).orderBy(F.rand(1)), 3, "id").collect()] == [0, 1, 2]


def test_literal_table_has_a_known_size(spark):
    df = literal_table(spark, S.PRODUCT_ROWS, S.PRODUCTS)
    assert df.schema == S.PRODUCTS and df.count() == 12
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert literal_table(spark, [], S.PRODUCTS).count() == 0


class ClusterSession:
    """Only what the folder helper asks of a session."""

    class sparkContext:
        master = "yarn"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.shared_folder(spark), scratch.shared_folder(spark)
    assert first.startswith(base) and second.startswith(base) and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(ClusterSession)


def test_mapping_reads_every_row(spark):
    given = mapping.GivenTables(spark, "/root/testdata/sf0.001")
    for table, source in {
        "customers": "customer", "accounts": "orders", "transactions": "lineitem", "branches": "nation",
        "sheets": "part", "catalog": "part",
    }.items():
        assert getattr(given, table).count() == given.raw(source).count()
    assert given.group_members.select("principal").distinct().count() == given.raw("customer").count()


def test_long_keys_keep_their_digits(spark):
    orders = spark.sql(
        "select 123456789012 as o_orderkey, 12345678901 as o_custkey, 'F' as o_orderstatus, 1.0D as o_totalprice, "
        "timestamp '2000-01-01 00:00:00' as o_orderdate")
    row = mapping.map_accounts(orders).first()
    assert (row["account_id"], row["customer_id"]) == ("A123456789012", "C12345678901")
