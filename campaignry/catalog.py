"""Every named operator as a function of the tables. Money and rates leave as DOUBLE."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaignry.operators import (
    abtest, campaign, channel, clusters, cohorts, derive, explore, features, load, propensity, quality, revenue, rfm,
    segments, trends,
)
from campaignry.session import scratch_path
from campaignry.tables import Tables

Operator = Callable[[Tables], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Plain output types: DECIMAL and FLOAT as DOUBLE, whole numbers as BIGINT."""
    def out(f: T.StructField):
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return F.col(f"`{f.name}`").cast("long").alias(f.name)
        return F.col(f"`{f.name}`")
    return df.select(*[out(f) for f in df.schema])


def _of(op: Operator, *cols: str) -> Operator:
    return lambda t: op(t).select(*cols)


def _views() -> dict[str, Operator]:
    perf, chan, trend, ab = campaign.campaign_performance, channel.channel_analysis, trends.monthly_trends, abtest.ab_test_results
    seg, roi = segments.customer_segments, revenue.revenue_roi
    return {
        "campaign_performance": perf,
        "channel_analysis": chan,
        "customer_segments": seg,
        "revenue_roi": roi,
        "monthly_trends": trend,
        "ab_test_results": ab,
        "outcome_counts": lambda t: campaign.outcome_counts(t.campaign_interactions, "campaign_id"),
        "campaign_revenue": lambda t: campaign.campaign_revenue(t.campaign_conversions),
        "kpi_rates": _of(perf, "campaign_id", "conversion_rate_pct", "response_rate_pct", "optout_rate_pct"),
        "kpi_cpa": _of(perf, "campaign_id", "total_budget", "total_conversions", "cost_per_acquisition"),
        "kpi_roi": _of(perf, "campaign_id", "revenue_attributed", "total_budget", "roi_pct"),
        "kpi_net_revenue": _of(perf, "campaign_id", "net_revenue", "avg_revenue_per_conversion"),
        "flag_cpa": _of(perf, "campaign_id", "cost_per_acquisition", "cpa_status"),
        "flag_roi": _of(perf, "campaign_id", "roi_pct", "roi_status"),
        "benchmark_gap": _of(chan, "channel_id", "conversion_rate_pct", "cost_per_acquisition", "cvr_gap_vs_benchmark",
                             "cpa_gap_vs_benchmark", "cvr_benchmark_status", "cpa_benchmark_status"),
        "channel_reach": lambda t: channel.channel_reach(t.campaign_interactions),
        "efficiency_index": _of(chan, "channel_id", "efficiency_index"),
        "campaign_dates": _of(perf, "campaign_id", "campaign_duration_days", "campaign_year", "campaign_quarter",
                              "campaign_quarter_label", "campaign_month", "campaign_month_label"),
        "conversion_dates": lambda t: revenue.conversion_dates(t.campaign_conversions).select(
            "conversion_id", "conversion_year", "conversion_quarter", "conversion_quarter_label", "conversion_month",
            "conversion_month_label", "conversion_day_of_week", "conversion_day_name"),
        "revenue_variance": _of(roi, "conversion_id", "revenue_variance_vs_standard", "revenue_as_pct_of_budget"),
        "rfm_inputs": segments.rfm_inputs,
        "rfm_combine": segments.rfm_combine,
        "rfm_score_sql": _of(seg, "customer_id", "r_score", "f_score", "m_score", "rfm_score"),
        "rfm_label_sql": _of(seg, "customer_id", "rfm_segment"),
        "rfm_recommend": _of(seg, "customer_id", "targeting_recommendation"),
        "monthly_base": lambda t: trends.monthly_base(t.campaign_interactions),
        "monthly_revenue": lambda t: trends.monthly_revenue(t.campaign_conversions),
        "monthly_budget": lambda t: trends.monthly_budget(t.campaigns),
        "trend_mom": _of(trend, "month_start", "conversions_mom_change", "conversions_mom_pct_change",
                         "revenue_mom_change", "revenue_mom_pct_change", "cvr_mom_pp_change"),
        "trend_yoy": _of(trend, "month_start", "conversions_same_month_ly", "conversions_yoy_pct_change"),
        "trend_cumulative": _of(trend, "month_start", "cumulative_conversions", "cumulative_revenue"),
        "trend_rolling3": _of(trend, "month_start", "conversions_3m_avg", "cvr_3m_avg"),
        "trend_year_rank": _of(trend, "month_start", "year_num", "rank_by_conversions_in_year",
                               "rank_by_revenue_in_year"),
        "ab_counts": lambda t: abtest.ab_counts(t.campaign_interactions),
        "ab_revenue": lambda t: abtest.ab_revenue(t.campaign_conversions),
        "ab_uplift": _of(ab, "campaign_id", "cvr_uplift_pp", "cvr_relative_uplift_pct", "revenue_uplift"),
        "ab_winner": _of(ab, "campaign_id", "winning_variant", "scale_recommendation"),
    }


def _analytics() -> dict[str, Operator]:
    return {
        "top_campaigns_roi": campaign.top_campaigns_roi,
        "rank_in_groups": campaign.rank_in_groups,
        "worst_cpa": campaign.worst_cpa,
        "top_customers": segments.top_customers,
        "segment_percentiles": segments.segment_percentiles,
        "multi_responders": segments.multi_responders,
        "warm_leads": segments.warm_leads,
        "churn_risk": segments.churn_risk,
        "running_revenue": revenue.running_revenue,
        "cvr_trend": trends.cvr_trend,
        "peer_benchmark": campaign.peer_benchmark,
        "funnel_campaign": campaign.funnel_campaign,
        "cohort_conversion": cohorts.cohort_conversion,
        "cohort_revenue": cohorts.cohort_revenue,
        "cohort_penetration": cohorts.cohort_penetration,
        "cohort_assign": cohorts.cohort_assign,
        "derive_conversions": revenue.derive_conversions,
        "conversion_type": revenue.conversion_type,
        "first_touch": revenue.first_touch,
        "kpi_ctr": campaign.kpi_ctr,
        "kpi_targets": campaign.kpi_targets,
        "reach": campaign.reach,
        "churn_kpi": segments.churn_kpi,
        "trend_qoq": trends.trend_qoq,
        "dim_date": trends.dim_date,
    }


def _quality() -> dict[str, Operator]:
    names = [
        "dq_run", "dq_totals", "dq_rowcounts", "dq_nulls", "dq_orphans", "dq_rules", "dq_warn", "row_counts", "dist_segment",
        "dist_cvr_channel", "dist_rev_category", "constraint_check", "profile_schema", "profile_nulls", "dup_rows",
        "dup_keys", "outliers", "validate_enums", "mean_null_pct", "dq_score",
    ]
    return {n: getattr(quality, n) for n in names}


def _explore() -> dict[str, Operator]:
    names = [
        "enrich_lookup", "age_band", "hist", "value_counts", "income_by_segment", "cvr_by_age", "cvr_by_income_quintile",
        "cvr_by_credit_band", "argbest_band", "corr_matrix", "camp_kpi", "cvr_by_type", "roi_by_product", "top10_cvr",
        "channel_cpa", "monthly_cvr", "channel_stats", "argbest_channel", "funnel_rows", "segment_cvr",
        "segment_product_mix", "segment_revenue", "products_held_dist", "category_cvr", "category_rev", "region_stats",
        "rfm_distributions", "exec_summary", "cvr_summary",
    ]
    return {n: getattr(explore, n) for n in names} | {
        "ab_overall": abtest.ab_overall, "ab_campaign_pivot": abtest.ab_campaign_pivot}


def rounded(op: Operator, dp: int = 6) -> Operator:
    """Logarithms and float means differ in the last bits between engines; outputs keep six places."""
    def run(t: Tables) -> DataFrame:
        df = op(t)
        reals = (T.DoubleType, T.FloatType)
        return df.select(*[F.round(f.name, dp).alias(f.name) if isinstance(f.dataType, reals) else f.name for f in df.schema])
    return run


def _customers() -> dict[str, Operator]:
    score = rfm.rfm_score_py
    return {
        "feat_demographic": rounded(features.demographic),
        "feat_recency": features.recency,
        "feat_frequency": rounded(features.frequency),
        "feat_monetary": rounded(features.monetary),
        "feat_product": rounded(features.product),
        "feat_engagement": features.engagement,
        "build_feature_matrix": rounded(features.build_feature_matrix),
        "scale_features": rounded(features.scale_features),
        "rfm_score_py": rounded(score),
        "rfm_label_py": _of(rfm.rfm_labels, "customer_id", "rfm_segment"),
        "rfm_segment_stats": rfm.rfm_segment_stats,
        "rfm_fm_grid": rfm.rfm_fm_grid,
        "rfm_bank_mix": rfm.rfm_bank_mix,
        "rfm_profile": rfm.rfm_profile,
        "rfm_radar": rfm.rfm_radar,
        "rfm_share": rfm.rfm_share,
        "product_count": derive.product_count,
        "allocate_contacts": derive.allocate_contacts,
        "target_audience": derive.target_audience,
        "dnc_refresh": derive.dnc_refresh,
    }


def _load() -> dict[str, Operator]:
    return {
        "src_csv_typed": load.src_csv_typed,
        "src_parquet": load.src_parquet,
        "load_append": load.load_append,
        "load_reconcile": load.load_reconcile,
        "load_totals": load.load_totals,
        "upsert_seed": load.upsert_products,
        "default_columns": load.default_columns,
        "gold_views": load.gold_views,
        "bronze_audit": load.bronze_audit,
        "sink_csv": lambda t: load.sink(
            rfm.rfm_labels(t).select("customer_id", "R", "F", "M", "rfm_score", "rfm_segment"),
            scratch_path(t.spark, "rfm-scores"), "csv"),
    }


def _clusters() -> dict[str, Operator]:
    names = ["kmeans_fit", "pca_project", "pca_loadings", "pca_centroids", "silhouette_points", "cluster_profile",
             "cluster_rfm_crosstab", "cluster_assign", "cluster_summary"]
    return {n: getattr(clusters, n) for n in ["kmeans_scan", *names]}


def filled_medians(t: Tables) -> DataFrame:
    """What imputation fills: gaps and the exact median per numeric column."""
    raw, whole = propensity.raw_dataset(t), propensity.build_ml_dataset(t)
    gaps = raw.select("interaction_id", *[F.col(c).isNull().alias(f"gap_{c}") for c in propensity.NUMERIC])
    both = whole.join(gaps, "interaction_id")
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"gap_{c}").alias("gap"), F.col(c).alias("v"))
                      for c in propensity.NUMERIC])
    return both.select(F.explode(pairs).alias("e")).filter("e.gap").groupBy("e.column_name").agg(
        F.count(F.lit(1)).alias("filled"), F.round(F.max("e.v"), 6).alias("fill_value"))


def _propensity() -> dict[str, Operator]:
    p = propensity
    trained = ["ml_logreg", "ml_rf", "ml_gbt", "ml_metrics", "ml_curves", "ml_confusion", "ml_importance",
               "ml_rank_agreement", "ml_threshold_sweep", "ml_roi_scenarios", "ml_save", "target_list"]
    return {
        "ml_customer_history": p.ml_customer_history,
        "ml_held_categories": lambda t: p.ml_held_categories(t).select(
            "customer_id", F.array_join("held_categories", "|").alias("held_categories")),
        "build_ml_dataset": rounded(p.build_ml_dataset),
        "ml_impute": filled_medians,
        "ml_split": _of(p.ml_split, "interaction_id", "converted", "is_test", "fold"),
        "ml_overview": p.ml_overview,
        "ml_prep": lambda t: p.ml_prep(t).select(
            "interaction_id", "converted", "weight", "fold", F.size("features").alias("n_features"),
            F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum")),
        **{n: getattr(p, n) for n in trained},
    }


def operators() -> dict[str, Operator]:
    return {
        **_views(), **_analytics(), **_quality(), **_explore(), **_customers(), **_load(), **_clusters(), **_propensity(),
    }
