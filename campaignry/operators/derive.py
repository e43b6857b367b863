"""Data rules of the campaign process: allocation, audiences, product counts, contact bans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.plans.ordering import running_sums
from campaignry.tables import Tables, if_small

CHUNK = 50_000


def product_count(t: Tables) -> DataFrame:
    """customers.number_of_products refreshed from the active holdings."""
    held = t.customer_products.filter(F.col("status") == "Active").groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return t.customers.select("customer_id").join(held, "customer_id", "left").select(
        "customer_id", k.zero("n").alias("number_of_products"))


def allocate_contacts(t: Tables, total: int | None = None) -> DataFrame:
    """Contacts shared out by contacts_target; the rest goes to the campaign with the largest target."""
    volume = F.lit(total).cast("long") if total is not None else k.value_of(t.campaign_interactions.agg(F.count(F.lit(1))))
    top = k.value_of(t.campaigns.agg(
        F.sum("contacts_target").alias("targets"),
        F.max(F.struct(F.col("contacts_target"), (-F.col("campaign_id")).alias("neg"))).alias("largest")))
    rows = t.campaigns.select("campaign_id", "target_segment", "contacts_target").withColumns(
        {"_total": volume, "_targets": top["targets"], "_largest": -top["largest"]["neg"]}
    ).withColumn("share", F.expr("contacts_target * _total div _targets"))
    given = k.value_of(rows.agg(F.sum("share")))
    rest = F.when(F.col("campaign_id") == F.col("_largest"), F.col("_total") - given).otherwise(0)
    return rows.select("campaign_id", "target_segment", "contacts_target", (F.col("share") + rest).alias("allocated"))


def target_audience(t: Tables, total: int | None = None, seed: int = 42) -> DataFrame:
    """Customers drawn per campaign without replacement from its segment, or from all if too few.

    Eligible customers are put in hash order once per pool over range partitions. A campaign takes
    a run of positions that starts at its own hashed place and wraps around. The runs are cut at
    every CHUNK positions, so the draw joins few pieces of runs with the ordered customers on
    (pool, chunk): the positions a campaign asks for are never written out or sorted.
    """
    able = t.customers.filter(F.col("is_active") & ~F.col("is_dnc"))
    pooled = able.select(
        "customer_id", k.stable_hash(F.lit(seed), "customer_id").alias("h"),
        F.explode(F.array(F.lit("All"), F.col("customer_segment"))).alias("pool"), F.lit(1).cast("long").alias("one"))
    ordered = running_sums(pooled, [F.col("pool"), F.col("h"), F.col("customer_id")], {"pos": "one"})
    # One row per pool: the four segments and All.
    sizes = ordered.groupBy("pool").agg(F.count(F.lit(1)).alias("size"), F.min("pos").alias("first"))
    places = ordered.join(F.broadcast(sizes), "pool").select("pool", (F.col("pos") - F.col("first")).alias("place"), "customer_id")

    every = k.value_of(sizes.filter("pool = 'All'").select("size"))
    wish = allocate_contacts(t, total).withColumn("all_size", every).join(
        F.broadcast(sizes.select(F.col("pool").alias("target_segment"), F.col("size").alias("seg_size"))), "target_segment", "left")
    enough = (F.col("target_segment") != "All") & (F.col("seg_size") >= F.col("allocated"))
    wish = wish.select(
        "campaign_id", F.when(enough, F.col("target_segment")).otherwise("All").alias("pool"),
        F.when(enough, F.col("seg_size")).otherwise(F.col("all_size")).alias("size"), "allocated").withColumns({
        "n": F.least("allocated", "size"), "start": k.stable_hash(F.lit(seed), F.lit("campaign"), "campaign_id") % F.col("size")})
    # One or two runs without a wrap per campaign, then one row per chunk they touch.
    wraps = F.greatest(F.col("start") + F.col("n") - F.col("size"), F.lit(0))
    part = lambda lo, hi: F.struct(lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    runs = wish.filter("n > 0").select("campaign_id", "pool", F.explode(F.array(
        part(F.col("start"), F.col("start") + F.col("n") - wraps), part(F.lit(0), wraps))).alias("run")).filter("run.lo < run.hi")
    pieces = if_small(runs.select("campaign_id", "pool", "run.lo", "run.hi", F.explode(F.sequence(
        F.expr(f"run.lo div {CHUNK}"), F.expr(f"(run.hi - 1) div {CHUNK}"))).alias("chunk")))
    chunked = places.withColumn("chunk", F.expr(f"place div {CHUNK}"))
    return chunked.join(pieces, ["pool", "chunk"]).filter((F.col("place") >= F.col("lo")) & (F.col("place") < F.col("hi"))).select(
        "campaign_id", "pool", "customer_id")


def dnc_refresh(t: Tables) -> DataFrame:
    """Customers who ever opted out become do-not-contact."""
    out = t.campaign_interactions.filter(k.outcome_is("Opted Out")).select("customer_id").distinct().withColumn("out", F.lit(True))
    return t.customers.select("customer_id", "is_dnc").join(out, "customer_id", "left").select(
        "customer_id", F.col("is_dnc").alias("was_dnc"),
        (F.col("is_dnc") | F.coalesce("out", F.lit(False))).alias("is_dnc"))
