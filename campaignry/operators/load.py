"""Typed CSV reading, appending loads with reconciliation, seeds, defaults, views and audit columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignry import schema as S
from campaignry.functions import kpi as k
from campaignry.operators import abtest, campaign, channel, revenue, segments, trends
from campaignry.operators.segments import customer_segments
from campaignry.session import local_frame, scratch_path
from campaignry.tables import Tables

# Facts are laid out by month, so that a filter on load_month skips folders.
MONTH_OF = {"campaign_interactions": "interaction_date", "campaign_conversions": "conversion_date",
            "customer_products": "acquisition_date"}


def csv_schema(spark: SparkSession, path: str, table: str) -> T.StructType:
    """The declared types in the order of the file's header; no inference over the data."""
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    known = {f.name: f for f in S.SCHEMAS[table]}
    return T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names])


WHOLE = (T.LongType, T.IntegerType, T.ShortType)


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Typed rows. Whole numbers may carry a zero fraction, as writers of nullable columns leave it; another one fails."""
    schema = csv_schema(spark, path, table)
    wide = T.StructType([T.StructField(f.name, T.DecimalType(24, 4), True) if isinstance(f.dataType, WHOLE) else f for f in schema])
    rows = (
        spark.read.schema(wide).option("header", True).option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST").csv(path)
    )
    whole = lambda f: F.when(F.col(f.name) % 1 == 0, F.col(f.name)).when(
        F.col(f.name).isNotNull(), F.raise_error(F.concat(F.lit(f"{table}.{f.name}: "), F.col(f.name).cast("string"))).cast("decimal(24,4)"))
    return rows.select(*[whole(f).cast(f.dataType).alias(f.name) if isinstance(f.dataType, WHOLE) else F.col(f.name) for f in schema])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def csv_tables(spark: SparkSession, folder: str, as_of) -> Tables:
    """All seven tables from CSV files or folders named after them."""
    return Tables(**{n: read_csv(spark, f"{folder}/{n}.csv", n) for n in S.LOAD_ORDER}, as_of=as_of, folder=folder)


def src_csv_typed(t: Tables) -> DataFrame:
    """Customers written as CSV and read back with the declared types."""
    path = scratch_path(t.spark, "customers-csv")
    write_csv(t.customers, path)
    return read_csv(t.spark, path, "customers")


def src_parquet(t: Tables) -> DataFrame:
    """Two columns of a whole table: the column list reaches the scan."""
    return t.spark.read.parquet(f"{t.folder}/orders.parquet").select("o_orderkey", "o_custkey")


def bronze_audit(t: Tables) -> DataFrame:
    """Raw rows with their load time and source file, summarised per file."""
    raw = t.spark.read.parquet(f"{t.folder}/orders.parquet").select(
        "o_orderkey", F.col("_metadata.file_path").alias("source_path"), F.current_timestamp().alias("load_timestamp"))
    return raw.groupBy(F.element_at(F.split("source_path", "/"), -1).alias("source_file")).agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.count("load_timestamp").alias("rows_stamped"))


def _stored_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return 0
    return spark.read.schema(schema).parquet(path).count()  # a load of no rows leaves no file to infer from


def load_table(df: DataFrame, table: str, folder: str) -> tuple:
    """Appends one table. Source and stored rows are counted apart, so a lost file shows up.

    Facts are dealt by month in one shuffle: the adaptive rebalancing splits a large month and joins small ones, and needs
    no sample of the rows, which would work out the source a second time.
    """
    path, spark = f"{folder}/{table}", df.sparkSession
    before, source = _stored_rows(spark, path, df.schema), df.count()
    if table in MONTH_OF:
        month = F.date_format(F.col(MONTH_OF[table]), "yyyy-MM")
        placed = df.withColumn("load_month", month).hint("rebalance", "load_month")
        placed.write.mode("append").partitionBy("load_month").parquet(path)
    else:
        df.write.mode("append").parquet(path)
    return table, before, source, _stored_rows(spark, path, df.schema)


def load_all(t: Tables, folder: str) -> DataFrame:
    """Appends all tables in dependency order and reports what arrived."""
    rows = [load_table(t[n], n, folder) for n in S.LOAD_ORDER]
    audit = local_frame(t.spark, rows, "table_name string, rows_before long, source_rows long, rows_after long")
    return audit.withColumns({
        "rows_loaded": F.col("rows_after") - F.col("rows_before"),
        "status": F.when(F.col("rows_after") - F.col("rows_before") == F.col("source_rows"), "OK").otherwise("MISMATCH"),
        "appended_to_existing": F.col("rows_before") > 0})


def _loaded(t: Tables) -> tuple[str, DataFrame]:
    """One load per table set, shared by the load reports."""
    if "load" not in t._memo:
        folder = scratch_path(t.spark, "silver")
        t._memo["load"] = (folder, load_all(t, folder))
    return t._memo["load"]


def load_append(t: Tables) -> DataFrame:
    return _loaded(t)[1].select("table_name", "rows_loaded")


def load_reconcile(t: Tables) -> DataFrame:
    return _loaded(t)[1]


def load_totals(t: Tables) -> DataFrame:
    """Stored rows per table and the grand total."""
    folder = _loaded(t)[0]
    counts = reduce(DataFrame.unionByName, [
        t.spark.read.schema(t[n].schema).parquet(f"{folder}/{n}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n")
        for n in S.LOAD_ORDER])
    return counts.rollup("table_name").agg(F.sum("n").alias("row_count")).select(
        F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count")


# The product seed rows (code, name, category, revenue, minimum age).
PRODUCT_SEED = [
    ("CC-CLASSIC", "Classic Credit Card", "Credit Card", "450.00", 18),
    ("CC-PLATINUM", "Platinum Credit Card", "Credit Card", "850.00", 21),
    ("SA-EASY", "Easy Access Savings", "Savings Account", "120.00", 18),
    ("SA-REGULAR", "Regular Saver Account", "Savings Account", "180.00", 18),
    ("FD-12M", "12-Month Fixed Deposit", "Fixed Deposit", "380.00", 18),
    ("FD-24M", "24-Month Fixed Deposit", "Fixed Deposit", "520.00", 18),
    ("PL-PERSONAL", "Personal Loan", "Personal Loan", "1200.00", 18),
    ("PL-CAR", "Car Finance Loan", "Personal Loan", "1800.00", 18),
    ("HL-RESIDENTIAL", "Residential Mortgage", "Home Loan", "4500.00", 18),
    ("HL-BTL", "Buy-to-Let Mortgage", "Home Loan", "6000.00", 21),
]


def product_seed(spark: SparkSession) -> DataFrame:
    raw = local_frame(spark, PRODUCT_SEED, "product_code string, product_name string, product_category string, v string, min_eligibility_age int")
    return raw.withColumn("revenue_value", F.col("v").cast(S.MONEY)).drop("v").withColumn("is_active", F.lit(True))


def upsert_seed(existing: DataFrame, seed: DataFrame, key: str, id_column: str) -> DataFrame:
    """Existing rows plus the seed rows whose business key is new, numbered after the highest id."""
    fresh = seed.join(existing.select(key), key, "left_anti")
    top = k.value_of(existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long")))
    # The window runs over the seed, a short fixed list.
    numbered = fresh.withColumn(id_column, top + F.row_number().over(Window.orderBy(key)))
    return existing.withColumn(id_column, F.col(id_column).cast("long")).unionByName(numbered, allowMissingColumns=True)


def upsert_products(t: Tables) -> DataFrame:
    """Applied twice: the second run adds nothing."""
    once = upsert_seed(t.products, product_seed(t.spark), "product_code", "product_id")
    return upsert_seed(once, product_seed(t.spark), "product_code", "product_id")


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Column defaults and the creation / change times of the write path."""
    known = {f.name: f.dataType for f in S.SCHEMAS[table]}
    cols = {}
    for name, value in S.DEFAULTS[table].items():
        d = F.lit(value).cast(known[name])
        cols[name] = F.coalesce(F.col(name).cast(known[name]), d) if name in df.columns else d
    now = F.current_timestamp()
    cols["created_at"] = F.coalesce("created_at", now) if "created_at" in df.columns else now
    if table in S.TOUCHED_TABLES:
        cols["updated_at"] = F.coalesce("updated_at", now) if "updated_at" in df.columns else now
    return df.withColumns(cols)


def touch(df: DataFrame, changed) -> DataFrame:
    """Sets the change time of the rows an update hits."""
    return df.withColumn("updated_at", F.when(changed, F.current_timestamp()).otherwise(F.col("updated_at")))


def default_columns(t: Tables) -> DataFrame:
    """Customers whose segment, product count or activity is unknown where income, gender or employment is."""
    known = lambda value, by: F.when(F.col(by).isNotNull(), F.col(value)).alias(value)
    arrived = t.customers.select(
        "customer_id", "annual_income", known("customer_segment", "annual_income"),
        known("number_of_products", "gender"), known("is_active", "employment_status"))
    done = touch(with_defaults(arrived, "customers"), F.col("annual_income").isNull())
    return done.select("customer_id", "customer_segment", "number_of_products", "is_active", "is_dnc",
                       F.col("created_at").isNotNull().alias("stamped"), (F.col("updated_at") >= F.col("created_at")).alias("touched"))


GOLD = {
    "vw_campaign_performance": campaign.campaign_performance, "vw_channel_analysis": channel.channel_analysis,
    "vw_customer_segments": customer_segments, "vw_revenue_roi": revenue.revenue_roi,
    "vw_monthly_trends": trends.monthly_trends, "vw_ab_test_results": abtest.ab_test_results,
}


def publish_views(t: Tables) -> list[str]:
    """Registers the six gold views for SQL clients of the session."""
    for name, view in GOLD.items():
        view(t).createOrReplaceTempView(name)
    return list(GOLD)


def gold_views(t: Tables) -> DataFrame:
    names = publish_views(t)
    return t.spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS view_name, count(*) AS row_count FROM {n}" for n in names))


def sink(df: DataFrame, path: str, kind: str = "parquet") -> DataFrame:
    """Writes a result and hands back what was stored."""
    spark = df.sparkSession
    if kind == "csv":
        write_csv(df, path)
        return spark.read.schema(df.schema).option("header", True).csv(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
