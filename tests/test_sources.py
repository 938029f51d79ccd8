import datetime as dt
import glob

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from orderloom.plans import build
from orderloom.session import apply_scale_defaults, work_dir
from orderloom.sources import readers, schemas
from orderloom.sources.tables import read_history, read_table, write_table

SHOP = {
    "raw_orders": "id,cust_id,prod_id,order_dt,stat,qty,disc_pct,channel,promo_cd\nO_1001,K1,G1,2024-01-05,comp,2,0.1,web,\nO_1002,K2,G1,2024-01-06,refund,1,,web,\n",
    "raw_customers": "id,first_nm,last_nm,email_addr,cntry_cd,reg_dt,tier,mrktng_opt_in\nK1,ana,lee,a@b.c,us,2024-01-01,gold,1\n",
    "raw_products": "id,prod_nm,ctgry,brnd,lst_price,cst_price,is_active,launch_dt\nG1,Tee,apparel,x,10,4,1,2020-01-01\n",
}


def test_declared_inputs(spark, frame, folder):
    frame("k int, v string", (1, "a"), (2, "b")).write.parquet(f"{folder}/things.parquet")
    assert readers.source(spark, "things", folder).count() == 2
    assert readers.source(spark, "things", folder, "k int").columns == ["k"]
    frame("k int", (1,)).createOrReplaceTempView("declared_things")
    assert readers.source(spark, "declared_things").count() == 1


def test_declared_inputs_are_read_as_they_are(spark, folder):
    spark.range(10).write.parquet(f"{folder}/small.parquet")
    assert "Repartition" not in readers.source(spark, "small", folder)._jdf.queryExecution().toString()


def test_malformed_rows_are_kept_apart(spark, folder):
    with open(f"{folder}/raw.csv", "w") as out:
        out.write('a,b,c\n1,2,3\n4,5\n6,7,8,9\n,"x,y",z\n')
    schema = StructType([StructField(c, StringType()) for c in "bc"])
    good, bad = readers.read_raw(spark, f"{folder}/raw.csv", schema), readers.read_malformed(spark, f"{folder}/raw.csv")
    assert sorted(tuple(r) for r in good.collect()) == [("2", "3"), ("x,y", "z")]
    assert good.count() == 2 and good.select("c").count() == 2
    assert sorted(r.line for r in bad.collect()) == ["4,5", "6,7,8,9"] and bad.count() == 2
    assert bad.first().file.endswith("raw.csv")


def test_line_breaks_inside_quotes(spark, folder):
    with open(f"{folder}/raw.csv", "w") as out:
        out.write('a,b\n1,"two\nlines"\n')
    schema = StructType([StructField(c, StringType()) for c in "ab"])
    assert [tuple(r) for r in readers.read_raw(spark, f"{folder}/raw.csv", schema, multi_line=True).collect()] == [("1", "two\nlines")]
    assert readers.read_malformed(spark, f"{folder}/raw.csv").count() == 1  # without it nothing is lost either


def test_session_settings(spark):
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    apply_scale_defaults(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"  # said so explicitly
    spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
    apply_scale_defaults(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_retail_build_from_files_twice(spark, folder):
    for name, text in SHOP.items():
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write(text)
    raw = build.read_all(spark, folder, schemas.RETAIL_RAW)
    for run in (dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)):
        report = build.build_retail(raw, f"{folder}/out", run, dt.date(2024, 2, 1), period="year")
    assert report.count() == 30
    failed = [(r.dataset, r.check, r.failures) for r in report.filter("not passed").collect()]
    assert failed == [("fct_orders", "relationships_customer_id_dim_customers", 1)]
    assert read_table(spark, f"{folder}/out/fct_orders").count() == 2
    assert read_history(spark, f"{folder}/out/customer_history").count() == 1
    stored = spark.read.parquet(f"{folder}/out/test_failures/fct_orders/relationships_customer_id_dim_customers")
    assert [r.order_id for r in stored.collect()] == ["O_1002"]


@pytest.mark.parametrize("family", [schemas.RETAIL_RAW, schemas.O2C_RAW])
def test_raw_columns_are_text(family):
    assert {f.dataType.simpleString() for schema in family.values() for f in schema} == {"string"}


def test_builds_store_rejected_rows_and_staged_tables(spark, folder):
    texts = SHOP | {
        "raw_customers": SHOP["raw_customers"] + "K9,bo,ray,b@c.d,us,15/02/2023,gold,1\n",
        "raw_orders": SHOP["raw_orders"] + "O_1003,K1,G1,some day,comp,2,0.1,web,\n",
    }
    for name, text in texts.items():
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write(text)
    raw = build.read_all(spark, folder, schemas.RETAIL_RAW)
    for run in (dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)):  # the second load is an increment
        build.build_retail(raw, f"{folder}/out", run, dt.date(2024, 2, 1), period="year")
    rejected = {
        name: [(r[0], r.rejected_columns) for r in spark.read.parquet(f"{folder}/out/rejected/{name}").collect()]
        for name in ("stg_customers", "stg_orders", "stg_products")
    }
    assert rejected == {
        "stg_customers": [("K9", ["registered_date"])], "stg_orders": [("O_1003", ["order_date"])], "stg_products": [],
    }
    assert read_table(spark, f"{folder}/out/stg_customers").count() == 2
    facts = read_table(spark, f"{folder}/out/fct_orders")
    assert sorted((r.order_id, r.order_date is None) for r in facts.collect()) == [("O_1001", False), ("O_1002", False), ("O_1003", True)]


def test_every_raw_line_is_in_a_staged_or_a_rejected_table(spark, folder):
    """Too many fields, too few, no key, unreadable text, both, and good lines."""
    files = dict(SHOP)
    files["raw_orders"] += (
        "O_1003,K1,G1,2024-01-07,comp,1,,web,,too,many\nO_1004,K1\n,K1,G1,2024-01-08,comp,1,,web,\n"
        ",K2,G1,someday,comp,many,,web,\nO_1005,K1,G1,2024-01-09,comp,many,,web,\n"
    )
    files["raw_customers"] += "K2,bo\n,no,key,,us,2024-01-01,gold,1\n"
    for name, lines in files.items():
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write(lines)
    at = f"{folder}/out"
    raw = build.read_all(spark, folder, schemas.RETAIL_RAW, at)
    build.build_retail(raw, at, dt.datetime(2024, 2, 1), dt.date(2024, 2, 1), period="month")
    malformed = {n: sorted(r.line for r in spark.read.parquet(f"{at}/rejected/{n}").collect()) for n in files}
    assert malformed == {
        "raw_orders": ["O_1003,K1,G1,2024-01-07,comp,1,,web,,too,many", "O_1004,K1"], "raw_customers": ["K2,bo"], "raw_products": [],
    }
    rejected = spark.read.parquet(f"{at}/rejected/stg_orders").collect()
    assert sorted((r.id or "", sorted(r.rejected_columns)) for r in rejected) == [
        ("", ["missing_id"]), ("", ["missing_id", "order_date", "quantity"]), ("O_1005", ["quantity"]),
    ]
    for staged, source in (("stg_orders", "raw_orders"), ("stg_customers", "raw_customers"), ("stg_products", "raw_products")):
        without_key = spark.read.parquet(f"{at}/rejected/{staged}").where("id is null").count()
        kept = read_table(spark, f"{at}/{staged}").count()
        assert kept + without_key + len(malformed[source]) == files[source].count("\n") - 1, staged
    # the raw files are read from what was parsed
    assert all("/out/raw/raw_orders/" in name for name in raw["raw_orders"].inputFiles())


def test_stored_tables_are_packed_tightly(spark, folder):
    """What a build writes is much of what it moves: files are compressed with zstd."""
    write_table(spark.range(10), f"{folder}/t")
    files = glob.glob(f"{folder}/t/v_000001/*.parquet")
    assert files and all(f.endswith(".zstd.parquet") for f in files)
