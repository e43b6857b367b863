"""Conversion propensity: data set, stratified split, Spark ML models, metrics, thresholds, ROI."""

from __future__ import annotations

import random
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression, LogisticRegressionModel, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.operators.boosting import BoostedTreesClassifier, BoostedTreesModel, fit_spread, held_scores
from campaignry.operators.forest import forest_scores
from campaignry.operators.search import Candidates, FoldSearch, dealt, with_weights
from campaignry.plans.ordering import SortedRuns, after_keys, running_sums, tile_ends
from campaignry.session import cut_lineage, local_frame, scratch_path
from campaignry.tables import Tables

# The model's input columns.
NUMERIC = ["age", "log_income", "credit_score", "tenure_at_interaction", "number_of_products", "campaign_duration_days",
           "budget_per_contact", "days_into_campaign", "hist_interactions", "hist_cvr", "hist_response_rate"]
CATEGORICAL = ["customer_segment", "employment_status", "channel_name", "campaign_type", "product_category", "interaction_type"]
BINARY = ["ab_variant_B", "ab_test_enabled", "is_existing_holder", "is_target_segment"]
FEATURES = NUMERIC + CATEGORICAL + BINARY
IDS = ["interaction_id", "customer_id", "campaign_id"]


def ml_customer_history(t: Tables) -> DataFrame:
    """Interactions, CVR and response rate per customer over all data, the row's own outcome included.

    The rates leak the label into the features, as in the source design.
    """
    by = t.campaign_interactions.groupBy("customer_id").agg(
        F.count("interaction_id").alias("hist_interactions"), k.n_if(k.outcome_is("Converted")).alias("won"),
        k.n_if(k.responded()).alias("answered"))
    return by.select("customer_id", "hist_interactions", k.over("won", "hist_interactions").alias("hist_cvr"),
                     k.over("answered", "hist_interactions").alias("hist_response_rate"))


def ml_held_categories(t: Tables) -> DataFrame:
    """Active categories per customer: at most one element per product category."""
    pairs = t.customer_products.filter(F.col("status") == "Active").join(t.product_category(), "product_id").select(
        "customer_id", "product_category").distinct()
    return pairs.groupBy("customer_id").agg(F.array_sort(F.collect_set("product_category")).alias("held_categories"))


def raw_dataset(t: Tables) -> DataFrame:
    """Interaction grain with campaign and customer columns, before gaps are filled.

    Everything known per customer is one frame, so the facts are shuffled once. The frame is cut
    first: with a plain exchange on both sides, the adaptive skew join can split a customer who
    holds a large part of the facts.
    """
    campaigns = t.campaign_dim().select(
        "campaign_id", "campaign_type", "product_category", "target_segment", "start_date",
        F.datediff("end_date", "start_date").alias("campaign_duration_days"),
        (F.col("total_budget").cast("double") / F.greatest("contacts_target", F.lit(1))).alias("budget_per_contact"),
        F.col("ab_test_enabled").cast("int").alias("ab_test_enabled"))
    customers = cut_lineage(t.customers.select(
        "customer_id", k.years_between(t.today, "date_of_birth").alias("age"),
        F.log1p(F.col("annual_income").cast("double")).alias("log_income"), "credit_score", "customer_segment",
        "employment_status", "number_of_products", "acquisition_date",
    ).join(ml_customer_history(t), "customer_id", "left").join(ml_held_categories(t), "customer_id", "left"))
    rows = (
        t.campaign_interactions.join(campaigns, "campaign_id", "left")
        .join(t.channel_dim().select("channel_id", "channel_name"), "channel_id", "left")
        .join(customers, "customer_id", "left")
    )
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return rows.withColumns({
        "days_into_campaign": F.greatest(F.datediff("interaction_date", "start_date"), F.lit(0)),
        "tenure_at_interaction": F.greatest(F.datediff("interaction_date", "acquisition_date"), F.lit(0)),
        "is_existing_holder": flag(F.array_contains("held_categories", F.col("product_category"))),
        "ab_variant_B": flag(F.col("ab_variant") == "B"),
        "is_target_segment": flag(F.col("customer_segment") == F.col("target_segment")),
        "converted": flag(k.outcome_is("Converted")),
    }).select(*IDS, *[F.col(c).cast("double").alias(c) for c in NUMERIC], *CATEGORICAL, *BINARY, "converted")


def ml_impute(rows: DataFrame) -> DataFrame:
    """Exact medians for numeric gaps, 'Unknown' for text, 0 for flags. Columns without gaps cost nothing."""
    gaps = rows.agg(*[k.n_if(F.col(c).isNull()).alias(c) for c in NUMERIC]).first()
    holes = [c for c in NUMERIC if gaps[c]]
    if holes:
        pairs = F.array(*[F.struct(F.lit(c).alias("grp"), F.col(c).alias("val")) for c in holes])
        values = rows.select(F.explode(pairs).alias("e")).select("e.grp", "e.val").filter("val IS NOT NULL")
        with SortedRuns(values) as runs:
            rows = rows.fillna({c: float(v[0]) for c, v in runs.percentiles([0.5]).items()})
    return rows.fillna("Unknown", CATEGORICAL).fillna(0, BINARY)


def build_ml_dataset(t: Tables) -> DataFrame:
    if "ml" not in t._memo:
        t._memo["ml"] = ml_impute(cut_lineage(raw_dataset(t)))
    return t._memo["ml"]


def _part(keys: dict):
    """How many cut keys of its own class a row lies behind."""
    out = F.lit(0)
    for g, ks in keys.items():
        out = F.when(F.col("converted") == g, after_keys(F.col("_h"), F.col("interaction_id"), ks, "bigint")).otherwise(out)
    return out


def ml_split(t: Tables, test_share: float = 0.2, seed: int = 42, folds: int = 5) -> DataFrame:
    """Exact per-class split: in each class the first fifth in hash order is the test set.

    The rest of the same order is dealt into equal folds, so one range sort serves both.
    """
    key = ("split", test_share, seed, folds)
    if key not in t._memo:
        rows = build_ml_dataset(t).withColumn("_h", k.stable_hash(F.lit(seed), "interaction_id"))
        hashed = rows.select(F.col("converted").alias("grp"), F.col("_h").alias("val"), "interaction_id")
        with SortedRuns(hashed, tie="interaction_id") as runs:
            want = {}
            for g in runs.runs:
                n = runs.size(g)
                held = int(n * test_share + 0.5)
                want[g] = [held] + [held + e for e in tile_ends(n - held, folds)]
            found = runs.pick({g: [r for r in rs if r > 0] for g, rs in want.items()})
        first = (-1, -1)  # before every hash: an empty part
        part = _part({g: [found.get((g, r), first) for r in rs] for g, rs in want.items()})
        marked = rows.withColumn("_part", part).withColumn("is_test", F.col("_part") == 0)
        t._memo[key] = cut_lineage(
            marked.withColumn("fold", F.when(~F.col("is_test"), F.col("_part") - 1)).drop("_h", "_part"))
    return t._memo[key]


def train_rows(t: Tables, folds: int = 5) -> DataFrame:
    return ml_split(t, folds=folds).filter(~F.col("is_test"))


def test_rows(t: Tables) -> DataFrame:
    return ml_split(t).filter("is_test")


def ml_overview(t: Tables) -> DataFrame:
    """Class balance of both parts and CVR by segment and channel on the training rows."""
    train = train_rows(t)
    cvr = lambda dim, col: train.groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("converted").alias("positives")).select(F.lit(dim).alias("dimension"), "value", "n", "positives")
    parts = ml_split(t).groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("converted").alias("positives")).select(F.lit("part").alias("dimension"), "value", "n", "positives")
    rows = parts.unionByName(cvr("segment", "customer_segment")).unionByName(cvr("channel", "channel_name"))
    return rows.withColumn("positive_pct", k.pct("positives", "n"))


# Preprocessing and models.

def encoded_names(levels: dict[str, list[str]]) -> list[str]:
    return [f"{c}={v}" for c, vs in levels.items() for v in vs[1:]]


def preprocessor(train: DataFrame) -> tuple[Pipeline, list[str]]:
    """Standardised numbers, one-hot codes without the first level (an unseen level is all zeros), flags.

    The levels are the distinct codes of the training rows: a handful per column.
    """
    found = train.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in CATEGORICAL]).first()
    levels = {c: list(found[c]) for c in CATEGORICAL}
    quote = lambda v: v.replace("\\", "\\\\").replace("'", "\\'")
    codes = [f"CASE WHEN `{c}` = '{quote(v)}' THEN 1.0D ELSE 0.0D END AS `x_{c}_{i}`"
             for c, vs in levels.items() for i, v in enumerate(vs[1:], 1)]
    coded = [f"x_{c}_{i}" for c, vs in levels.items() for i in range(1, len(vs))]
    stages = [
        SQLTransformer(statement="SELECT *, " + ", ".join(codes) + " FROM __THIS__"),
        VectorAssembler(inputCols=NUMERIC, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["scaled", *coded, *BINARY], outputCol="features"),
    ]
    return Pipeline(stages=stages), NUMERIC + encoded_names(levels) + BINARY


def ml_prep(t: Tables) -> DataFrame:
    """Training rows as model input: label, balanced weight, positive weight, fold, features."""
    return prepared(t)[1].select("interaction_id", "converted", "weight", "fold", vector_to_array("features").alias("features"))


def prepared(t: Tables, folds: int = 5) -> tuple[PipelineModel, DataFrame, DataFrame, list[str]]:
    key = ("prepared", folds)
    if key not in t._memo:
        train = train_rows(t, folds)
        pipe, names = preprocessor(train)
        model = pipe.fit(train)
        keep = [*IDS, "converted", "features"]
        ready = with_weights(model.transform(train))
        t._memo[key] = (
            model, cut_lineage(ready.select(*keep, "label", "weight", "pos_weight", "fold")),
            cut_lineage(model.transform(test_rows(t)).select(*keep)), names)
    return t._memo[key]


# The search spaces.
LOGREG_GRID = [{"C": c, "penalty": p} for c in (0.001, 0.01, 0.1, 1, 10, 100) for p in ("l1", "l2")]
FOREST_SPACE = {"n_estimators": [100, 200, 300], "max_depth": [5, 10, 15, None], "min_samples_leaf": [1, 5, 10, 20],
                "max_features": ["sqrt", "log2", 0.3]}
BOOST_SPACE = {"n_estimators": [100, 200, 300, 500], "learning_rate": [0.01, 0.05, 0.1, 0.2], "max_depth": [3, 5, 7],
               "subsample": [0.7, 0.8, 1.0], "colsample_bytree": [0.6, 0.8, 1.0], "min_child_weight": [1, 5, 10],
               "gamma": [0, 0.1, 0.3]}


def draws(space: dict, n: int, seed: int = 42) -> list[dict]:
    """n different random settings of a search space."""
    rng, seen = random.Random(seed), []
    while len(seen) < n:
        one = {name: rng.choice(values) for name, values in space.items()}
        if one not in seen:
            seen.append(one)
    return seen


@dataclass
class Search:
    """Which settings are tried; the full search is the default. Folds and final fits read all training rows, scores all test rows."""

    logreg: list[dict] = field(default_factory=lambda: list(LOGREG_GRID))
    forest: list[dict] = field(default_factory=lambda: draws(FOREST_SPACE, 20))
    boost: list[dict] = field(default_factory=lambda: draws(BOOST_SPACE, 25))
    folds: int = 5
    parallelism: int | None = None  # fits side by side; as many as the cluster has cores if not given


@dataclass
class Fitted:
    """The model of the best setting, its mean AUC over the folds, and the setting by the names of the search space."""

    model: object
    cv_auc: float
    setting: dict


SPARK_DEPTH = 30  # Spark grows no deeper trees


def _logreg(g: dict, n: int) -> LogisticRegression:
    """Inverse strength C of n rows is regParam 1 / (C n); the inputs are already scaled."""
    return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=1000, standardization=False,
                              regParam=1.0 / (g["C"] * n), elasticNetParam=1.0 if g["penalty"] == "l1" else 0.0)


def _forest(g: dict, n: int) -> RandomForestClassifier:
    """A forest; the setting without a depth limit grows to Spark's own limit, which the reported setting says."""
    return RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", seed=42, numTrees=g["n_estimators"],
                                  maxDepth=g["max_depth"] or SPARK_DEPTH, minInstancesPerNode=g["min_samples_leaf"],
                                  featureSubsetStrategy=str(g["max_features"]))


def _boost(g: dict, n: int) -> BoostedTreesClassifier:
    """Boosted trees; a fit is one task, or spread over all tasks if it has many rows."""
    return BoostedTreesClassifier(g)


MODELS = {"Logistic Regression": "logistic_regression", "Random Forest": "random_forest", "Boosted Trees": "boosted_trees"}
KINDS = {"Logistic Regression": LogisticRegressionModel, "Random Forest": RandomForestClassificationModel,
         "Boosted Trees": BoostedTreesModel}


def _candidates(name: str, search: Search) -> Candidates:
    settings, build, in_task, weight, spread = {
        "Logistic Regression": (search.logreg, _logreg, None, "weight", None),
        "Random Forest": (search.forest, _forest, forest_scores, "weight", None),
        "Boosted Trees": (search.boost, _boost, held_scores, "pos_weight", fit_spread)}[name]
    return Candidates(MODELS[name] + ("_in_tasks" if in_task else ""), settings, build, in_task, weight, spread)


def _said(setting: dict) -> dict:
    """A setting as it is reported."""
    deep = "max_depth" in setting and setting["max_depth"] is None
    return setting | ({"max_depth": f"none ({SPARK_DEPTH} in Spark)"} if deep else {})


def models(t: Tables, search: Search | None = None, names=tuple(MODELS)) -> dict[str, Fitted]:
    """The fitted models by name; each is fitted once per data set and search, by whichever driver comes first."""
    search = search or t._memo.setdefault("search", Search())
    have = t._memo.setdefault(("models", repr(search)), {})
    wanted = [name for name in names if name not in have]
    if not wanted:
        return have
    folds = FoldSearch(train_rows(t, search.folds), preprocessor, search.folds)
    _, train, _, _ = prepared(t, search.folds)
    n = folds.size
    rows = dealt(train.select("features", "label", "weight", "pos_weight"), n)
    for name in wanted:
        c = _candidates(name, search)
        means = folds.run(c, search.parallelism)
        best = max(range(len(means)), key=lambda i: means[i])
        have[name] = Fitted(folds.final(c, c.settings[best], rows, n, KINDS[name]), means[best], _said(c.settings[best]))
    folds.close()
    rows.unpersist()
    return have


def scored(t: Tables, names=tuple(MODELS)) -> DataFrame:
    """Test rows with the conversion probability of each model."""
    fitted = models(t, names=names)
    _, _, test, _ = prepared(t)
    out = None
    for name in names:
        rows = fitted[name].model.transform(test).select(
            *IDS, "converted", F.lit(name).alias("model"), vector_to_array("probability")[1].alias("score"))
        out = rows if out is None else out.unionByName(rows)
    return out


def all_scored(t: Tables, names=tuple(MODELS)) -> DataFrame:
    """The scores of the named models, each cut once; a query of one model fits no other."""
    search = repr(t._memo.setdefault("search", Search()))
    for name in names:
        if ("scored", name, search) not in t._memo:
            t._memo["scored", name, search] = cut_lineage(scored(t, (name,)))
    return reduce(DataFrame.unionByName, [t._memo["scored", name, search] for name in names])


def _report(t: Tables, name: str) -> DataFrame:
    fit = models(t, names=(name,))[name]
    stats = curve_metrics(score_curve(scored(t, (name,))))
    setting = ", ".join(f"{key}={value}" for key, value in sorted(fit.setting.items()))
    return stats.withColumns({"cv_auc": F.lit(fit.cv_auc).cast("double"), "best_setting": F.lit(setting)})


def ml_logreg(t: Tables) -> DataFrame:
    return _report(t, "Logistic Regression")


def ml_rf(t: Tables) -> DataFrame:
    return _report(t, "Random Forest")


def ml_gbt(t: Tables) -> DataFrame:
    return _report(t, "Boosted Trees")


# Evaluation from scores.

def score_curve(rows: DataFrame) -> DataFrame:
    """Per model and distinct score: positives and negatives at it and at or above it, and the totals.

    The running counts go over range partitions in (model, falling score) order; a model's own
    counts are the global ones minus what the models before it add up to.
    """
    points = rows.groupBy("model", "score").agg(
        F.sum("converted").cast("long").alias("pos"), F.sum(1 - F.col("converted")).cast("long").alias("neg"))
    run = running_sums(points, [F.col("model"), F.desc("score")], {"_tp": "pos", "_fp": "neg"})
    # One row per model.
    sums = run.groupBy("model").agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
                                    F.max("_tp").alias("_tp_end"), F.max("_fp").alias("_fp_end"))
    return run.join(F.broadcast(sums), "model").select(
        "model", "score", "pos", "neg", (F.col("_tp") - F.col("_tp_end") + F.col("positives")).alias("tp"),
        (F.col("_fp") - F.col("_fp_end") + F.col("negatives")).alias("fp"), "positives", "negatives")


def curve_metrics(curve: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 at the threshold; ROC-AUC with half credit for ties; step-sum average precision."""
    d = lambda c: F.col(c).cast("double")
    above = F.col("score") >= threshold
    by = curve.groupBy("model").agg(
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp_t"), F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("fp_t"),
        F.max("positives").alias("p"), F.max("negatives").alias("n"),
        F.sum(d("neg") * (d("tp") - d("pos") / 2)).alias("_area"), F.sum(d("pos") * d("tp") / (d("tp") + d("fp"))).alias("_ap"))
    precision = F.coalesce(k.over("tp_t", F.col("tp_t") + F.col("fp_t")), F.lit(0.0))
    recall = F.coalesce(k.over("tp_t", "p"), F.lit(0.0))
    return by.select(
        "model", F.round(k.over(F.col("tp_t") + F.col("n") - F.col("fp_t"), F.col("p") + F.col("n")), 4).alias("accuracy"),
        F.round(precision, 4).alias("precision"), F.round(recall, 4).alias("recall"),
        F.round(F.coalesce(2 * precision * recall / F.nullif(precision + recall, F.lit(0.0)), F.lit(0.0)), 4).alias("f1"),
        F.round(F.col("_area") / F.nullif(d("p") * d("n"), F.lit(0.0)), 4).alias("roc_auc"),
        F.round(F.col("_ap") / F.nullif(d("p"), F.lit(0.0)), 4).alias("avg_precision"))


def _curve(t: Tables) -> DataFrame:
    key = ("curve", repr(t._memo.setdefault("search", Search())))
    if key not in t._memo:
        t._memo[key] = score_curve(all_scored(t))
    return t._memo[key]


def ml_metrics(t: Tables) -> DataFrame:
    """Test metrics per model; the one of the largest ROC-AUC is marked."""
    best = Window.orderBy(F.desc("roc_auc"), "model")  # one row per model
    return curve_metrics(_curve(t)).withColumn("is_best", F.row_number().over(best) == 1)


def ml_curves(t: Tables) -> DataFrame:
    """ROC and precision-recall points per model and distinct score."""
    return _curve(t).select(
        "model", "score", k.over("fp", "negatives").alias("fpr"), k.over("tp", "positives").alias("tpr"),
        k.over("tp", F.col("tp") + F.col("fp")).alias("precision"), k.over("tp", "positives").alias("recall"))


def ml_confusion(t: Tables, threshold: float = 0.5) -> DataFrame:
    counts = all_scored(t).groupBy("model", "converted", (F.col("score") >= threshold).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", k.share("n", F.sum("n").over(Window.partitionBy("model"))))  # four rows each


def _importance(t: Tables) -> list[tuple]:
    names, rows = prepared(t)[3], []
    for model, found in models(t).items():
        fit = found.model
        weights = abs(fit.coefficients.toArray()) if model == "Logistic Regression" else fit.featureImportances.toArray()
        rows += [(model, names[i], float(w)) for i, w in enumerate(weights)]
    return rows


def _ranked(t: Tables) -> DataFrame:
    frame = local_frame(t.spark, _importance(t), "model string, feature string, importance double")
    order = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")  # one row per feature
    return frame.withColumn("position", F.row_number().over(order))


def ml_importance(t: Tables, top: int = 20) -> DataFrame:
    """Absolute coefficients of the linear model, impurity gain of the trees."""
    return _ranked(t).filter(F.col("position") <= top)


def ml_rank_agreement(t: Tables, top: int = 15) -> DataFrame:
    wide = _ranked(t).groupBy("feature").pivot("model", list(MODELS)).agg(F.max("position")).dropna()
    mean = sum((F.col(f"`{m}`") for m in MODELS), F.lit(0)) / len(MODELS)
    return wide.select("feature", *[F.col(f"`{m}`").alias(f"{s}_rank") for m, s in MODELS.items()], mean.alias("mean_rank")).orderBy(
        "mean_rank", "feature").limit(top)


def threshold_table(rows: DataFrame, steps=range(10, 90)) -> DataFrame:
    """Counts at or above each hundredth. Scores fall into 101 buckets once; the sweep sums the buckets."""
    low = F.floor(F.col("score") * 100)
    at = F.when(F.col("score") >= (low + 1) / 100.0, low + 1).when(F.col("score") < low / 100.0, low - 1).otherwise(low)
    buckets = rows.groupBy("model", at.cast("int").alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("converted").alias("p"))
    names = rows.select("model").distinct().withColumn("b", F.explode(F.array(*[F.lit(s) for s in steps])))
    grid = names.select("model", "b", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("p"), F.lit(True).alias("asked"))
    every = buckets.withColumn("asked", F.lit(False)).unionByName(grid).groupBy("model", "b").agg(
        F.sum("n").alias("n"), F.sum("p").alias("p"), F.max("asked").alias("asked"))
    down = Window.partitionBy("model").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, 0)  # 101 rows each
    whole = Window.partitionBy("model")
    return every.select(
        "model", "b", "asked", F.sum("n").over(down).alias("contacts"), F.sum("p").over(down).alias("captured"),
        F.sum("n").over(whole).alias("rows"), F.sum("p").over(whole).alias("positives")).filter("asked").drop("asked")


def ml_threshold_sweep(t: Tables, model: str = "Boosted Trees") -> DataFrame:
    rows = threshold_table(all_scored(t, (model,)))
    precision = F.coalesce(k.over("captured", "contacts"), F.lit(0.0))
    recall = F.coalesce(k.over("captured", "positives"), F.lit(0.0))
    wrong = (F.col("contacts") - F.col("captured")) + (F.col("positives") - F.col("captured"))
    out = rows.select(
        (F.col("b") / 100).alias("threshold"), "contacts", "captured", precision.alias("precision"), recall.alias("recall"),
        F.coalesce(2 * precision * recall / F.nullif(precision + recall, F.lit(0.0)), F.lit(0.0)).alias("f1"),
        (1 - k.over(wrong, "rows")).alias("accuracy"), k.share("contacts", "rows").alias("contact_pct"),
        k.share("captured", "positives").alias("capture_pct"))
    best = Window.orderBy(F.desc("f1"), "threshold")  # eighty rows
    return out.withColumn("is_best_f1", F.row_number().over(best) == 1)


def ml_roi_scenarios(t: Tables, model: str = "Boosted Trees", cost: float = 15, revenue: float = 800) -> DataFrame:
    """Targeting at six thresholds against contacting everybody."""
    rows = threshold_table(all_scored(t, (model,))).filter(F.col("b").isin(30, 35, 40, 50, 60, 65))
    spend, gain = F.col("contacts") * cost, F.col("captured") * revenue
    return rows.select(
        (F.col("b") / 100).alias("threshold"), "contacts", F.col("captured").alias("converters_caught"),
        F.round(F.coalesce(k.over("captured", "contacts"), F.lit(0.0)), 3).alias("precision"),
        F.round(k.over("captured", "positives"), 3).alias("recall"), spend.alias("campaign_cost"), gain.alias("revenue"),
        F.round(F.coalesce((gain - spend) / F.nullif(spend, F.lit(0.0)) * 100, F.lit(0.0)), 1).alias("roi_pct"),
        F.round((F.col("positives") * revenue - F.col("rows") * cost) / (F.col("rows") * cost) * 100, 1).alias("mass_roi_pct"))


def target_list(t: Tables, model: str = "Boosted Trees", threshold: float = 0.65) -> DataFrame:
    """Scored contacts at or above the targeting threshold."""
    return all_scored(t, (model,)).filter(F.col("score") >= threshold).select(*IDS, "score", "converted")


def save_models(t: Tables, folder: str) -> list[str]:
    """Writes the preprocessing, the fitted models and the metrics below one folder."""
    prepared(t)[0].write().overwrite().save(f"{folder}/preprocessor")
    for name, fit in models(t).items():
        fit.model.write().overwrite().save(f"{folder}/{MODELS[name]}")
    ml_metrics(t).write.mode("overwrite").parquet(f"{folder}/model_metrics")
    ml_roi_scenarios(t).write.mode("overwrite").parquet(f"{folder}/roi_scenarios")
    return [f"{folder}/{n}" for n in ("preprocessor", *MODELS.values(), "model_metrics", "roi_scenarios")]


def ml_save(t: Tables) -> DataFrame:
    """Saves everything, loads the preprocessing and the models again and scores the test rows with what was loaded."""
    folder = scratch_path(t.spark, "models")
    paths = save_models(t, folder)
    ready = PipelineModel.load(paths[0]).transform(test_rows(t))
    counts = {"preprocessor": ready.count()}
    for name, kind in KINDS.items():
        counts[MODELS[name]] = kind.load(f"{folder}/{MODELS[name]}").transform(ready).filter("prediction IN (0, 1)").count()
    every = counts["preprocessor"]
    return local_frame(t.spark, [(p.rsplit("/", 1)[1], counts.get(p.rsplit("/", 1)[1], every)) for p in paths], "artifact string, test_rows long")
