"""Mixing sources to target weights: weighted sampling without replacement by exponential keys, cut at word budgets.

Each document draws the key -ln(u) / w from a keyed hash u and its quality weight w; within a source the smallest
keys come first. A source takes as many complete epochs as its target holds, and of the next epoch the documents in
key order until the rest of the budget is used. Prefix sums over a source run in two levels: sums of key ranges, then
rows inside one range, so no task ever holds a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignry.session import cut_lineage

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class MixPlan:
    weights: tuple[int, ...] = (5, 2, 1)  # of the sources in code point order, repeating
    share_pct: int = 150  # of all words
    max_epochs: int = 2
    seed: int = 17
    ranges: int = 4096  # key ranges per source


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for plain text, falling to 0.1 as a quarter of the characters are symbols."""
    n = F.length(text)
    symbols = n - F.length(F.translate(text, SYMBOLS, ""))
    return F.when(n > 0, F.greatest(F.lit(0.1), 1 - 4 * symbols / n)).otherwise(F.lit(1.0))


def keyed(docs: DataFrame, plan: MixPlan, quality: Column | None = None) -> DataFrame:
    """doc_id, source (src and no_src for null), size, key and key range per document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hexes = F.substring(F.md5(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13)
    u = (F.conv(hexes, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
    key = -F.log(u) / (quality_weight(text) if quality is None else quality)
    rows = docs.select(
        "doc_id", F.col("source").isNull().alias("no_src"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"),
        words(text).alias("size"), key.alias("key"),
    )
    return rows.withColumn("range", F.floor(plan.ranges * (1 - F.exp(-F.col("key")))).cast("int"))


def source_targets(sources: DataFrame, plan: MixPlan) -> DataFrame:
    """Adds w and target to (no_src, src, source_size): budgets by weight, capped, the excess reshared.

    With the sources in order of cap / weight, the capped ones are a prefix, and the first one below its cap fixes the
    level of all later ones. The windows without partition run over one row per source.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in plan.weights]),
                     ((F.row_number().over(Window.orderBy("no_src", "src")) - 1) % len(plan.weights) + 1).cast("int"))
    rows = sources.withColumn("w", w.cast("long")).withColumn("cap", plan.max_epochs * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "no_src", "src")
    all_rows = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "left": plan.share_pct * F.sum("source_size").over(all_rows)
                - 100 * F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "w_left": F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    below = 100 * F.col("cap") * F.col("w_left") > F.col("w") * F.col("left")
    rows = rows.withColumn("level", F.min(F.when(below, F.struct(
        (F.col("cap") / F.col("w")).alias("r"), "no_src", "src", "left", "w_left"))).over(all_rows))
    share = (F.col("w") * F.col("level.left")).cast("double") / (100 * F.col("level.w_left")).cast("double")
    capped = F.col("level").isNull() | (F.struct((F.col("cap") / F.col("w")).alias("r"), "no_src", "src")
                                        < F.struct("level.r", "level.no_src", "level.src"))
    return rows.withColumn("target", F.when(capped, F.col("cap").cast("double")).otherwise(share)).select(
        "no_src", "src", "source_size", "target")


def mix(docs: DataFrame, plan: MixPlan = MixPlan(), quality: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, epochs (times taken), taken (words).

    Nulls: a null source is a source of its own, the last one; a null text has size 0; a null id draws one key for
    all such rows. Equal keys go by id, then size. Rows of one id and size are interchangeable. Sources without
    words have target 0. An empty table gives no rows. Other columns are not read.
    """
    rows = cut_lineage(keyed(docs, plan, quality))
    sums = cut_lineage(rows.groupBy("no_src", "src", "range").agg(F.sum("size").alias("range_size")))
    sources = sums.groupBy("no_src", "src").agg(F.sum("range_size").alias("source_size"))
    targets = source_targets(sources, plan)
    by_range = Window.partitionBy("no_src", "src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.withColumn("range_before", F.coalesce(F.sum("range_size").over(by_range), F.lit(0)))
    ranges = ranges.join(targets, ["no_src", "src"])
    inside = Window.partitionBy("no_src", "src", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(ranges, ["no_src", "src", "range"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - whole * F.col("source_size")
    middle = 2 * (F.col("range_before") + F.col("before")) + F.col("size")
    epochs = whole + F.when((rest > 0) & (middle.cast("double") <= 2 * rest), 1).otherwise(0)
    return placed.select(
        "doc_id", F.when(~F.col("no_src"), F.col("src")).alias("source"), "size", "source_size", "target",
        epochs.alias("epochs"), (epochs * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, plan: MixPlan = MixPlan(), quality: Column | None = None) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns.

    Rows of one id, source and size share one decision, the largest of theirs.
    """
    decided = mix(docs, plan, quality).filter("epochs > 0").groupBy("doc_id", "source", "size").agg(F.max("epochs").alias("epochs"))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), F.col("source").cast("string").alias("src"),
                       words(F.col("text")).alias("words"))
    joined = rows.join(decided, rows["id"].eqNullSafe(decided["doc_id"]) & rows["src"].eqNullSafe(decided["source"])
                       & (rows["words"] == decided["size"]))
    return joined.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("epochs").cast("int")))).select("doc.*")


ORACLE = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, length(coalesce(text, '')) AS n,
           length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS symbols,
           (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM documents),
k AS (SELECT doc_id, source, size, -ln(u) / CASE WHEN n > 0 THEN greatest(0.1::DOUBLE, 1 - (4 * symbols)::DOUBLE / n::DOUBLE) ELSE 1 END AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
      FROM k GROUP BY source),
c AS (SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 3
             - 2 * coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
             row_number() OVER (ORDER BY 2 * source_size / w, source NULLS LAST) AS pos FROM s),
f AS (SELECT min(pos) AS pos FROM c WHERE 2 * cap * w_left > w * rest),
t AS (SELECT c.source, c.source_size, CASE WHEN f.pos IS NULL OR c.pos < f.pos THEN c.cap::DOUBLE
             ELSE (c.w * l.rest)::DOUBLE / (2 * l.w_left)::DOUBLE END AS target
      FROM c CROSS JOIN f LEFT JOIN c l ON l.pos = f.pos),
p AS (SELECT k.doc_id, k.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole,
             coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN target - whole * source_size > 0 AND (2 * before + size)::DOUBLE <= 2 * (target - whole * source_size)
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
