from datetime import date

import pytest
from tests.conftest import rows_by, touch
from pyspark.sql import functions as F

from campaignry.operators import load
from campaignry.session import local_frame, scratch_path


def test_csv_header_order_rules_the_types(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(
        "region,customer_id,annual_income,date_of_birth,acquisition_channel_id\nNorth,5,12.50,1990-02-03,\nSouth,6,,1991-01-01,2\n")
    got = load.read_csv(spark, str(tmp_path / "customers.csv"), "customers")
    assert dict(got.dtypes)["annual_income"] == "decimal(15,2)" and dict(got.dtypes)["customer_id"] == "bigint"
    first, second = got.orderBy("customer_id").collect()
    assert first["date_of_birth"] == date(1990, 2, 3) and first["acquisition_channel_id"] is None and second["acquisition_channel_id"] == 2


def test_bad_csv_value_fails(spark, tmp_path):
    (tmp_path / "c.csv").write_text("customer_id,date_of_birth\nx,1990-02-03\n")
    with pytest.raises(Exception):
        load.read_csv(spark, str(tmp_path / "c.csv"), "customers").collect()


def test_loading_twice_appends(spark, make):
    t = make(campaign_interactions=[touch(i, 1, day=date(2001, 1 + i % 3, 1)) for i in range(1, 8)])
    folder = scratch_path(spark, "twice")
    first = rows_by(load.load_all(t, folder), "table_name")
    again = rows_by(load.load_all(t, folder), "table_name")
    assert first["campaign_interactions"]["rows_loaded"] == 7 and not first["campaign_interactions"]["appended_to_existing"]
    assert again["campaign_interactions"]["rows_after"] == 14 and again["campaign_interactions"]["status"] == "OK"
    assert again["customers"]["appended_to_existing"] and list(first) == load.S.LOAD_ORDER
    month = spark.read.parquet(f"{folder}/campaign_interactions").filter("load_month = '2001-02'")
    assert month.count() == 6 and "PartitionFilters: [isnotnull" in month._jdf.queryExecution().toString()


def test_seed_ignores_known_codes(spark, make):
    t = make()
    known = t.products.withColumn("product_code", F.when(F.col("product_id") == 1, "SA-EASY").otherwise(F.col("product_code")))
    once = load.upsert_seed(known, load.product_seed(spark), "product_code", "product_id")
    assert once.count() == 2 + 9 and load.upsert_seed(once, load.product_seed(spark), "product_code", "product_id").count() == 11
    assert sorted(r["product_id"] for r in once.collect()) == list(range(1, 12))


def test_defaults_and_touch(spark):
    df = local_frame(spark, [(1, None), (2, "Premier")], "customer_id long, customer_segment string")
    got = rows_by(load.with_defaults(df, "customers"), "customer_id")
    assert got[1]["customer_segment"] == "Mass Market" and got[2]["customer_segment"] == "Premier"
    assert got[1]["is_active"] is True and got[1]["is_dnc"] is False and got[1]["created_at"] is not None


def test_gold_views_can_be_queried(spark, star):
    assert load.publish_views(star) == list(load.GOLD)
    row = spark.sql("SELECT count(*) AS n, sum(total_contacts) AS c FROM vw_campaign_performance").first()
    assert row["n"] == 50 and row["c"] == star.campaign_interactions.count()


def test_sink_round_trip(spark, star):
    small = star.campaigns.select("campaign_id", "campaign_code", "start_date")
    for kind in ("csv", "parquet"):
        back = load.sink(small, scratch_path(spark, kind), kind)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, small.collect()))


def test_whole_numbers_with_a_zero_fraction_and_quoted_header(spark, tmp_path):

    from campaignry import schema as S

    fields = [f.name for f in S.SCHEMAS["customer_products"]]
    row = {f.name: {"long": "7", "integer": "7", "short": "7", "date": "2001-01-01", "decimal": "1.50", "string": "Active", "boolean": "true"}[f.dataType.typeName()]
           for f in S.SCHEMAS["customer_products"]}
    path = tmp_path / "customer_products.csv"

    def write(campaign):
        line = [{**row, "campaign_id": campaign}[f] for f in fields]
        path.write_text(",".join(f'"{f}"' for f in fields) + "\n" + ",".join(line) + "\n")

    write("12.0")
    assert load.read_csv(spark, str(path), "customer_products").first()["campaign_id"] == 12
    write("")
    assert load.read_csv(spark, str(path), "customer_products").first()["campaign_id"] is None
    write("12.5")
    with pytest.raises(Exception):
        load.read_csv(spark, str(path), "customer_products").collect()


def test_a_load_reads_its_source_once_to_count_and_once_to_write(spark, star):
    """No third time for a sample of the rows."""
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    rows = star.campaign_interactions
    folder = scratch_path(spark, "once")
    result = load.load_table(rows.mapInArrow(passed, rows.schema), "campaign_interactions", folder)
    assert result[2] == result[3] == rows.count() and seen.value == 2 * rows.count()
    stored = spark.read.parquet(f"{folder}/campaign_interactions").drop("load_month")
    assert sorted(map(str, stored.select(rows.columns).collect())) == sorted(map(str, rows.collect()))
