"""Secret scan with multipart linking, in built-in functions only.

Strong findings (assignments, access identifiers, hex runs) stand alone. Weak secrets, that is short values or short
keywords, are reported only if an identifier or an endpoint lies within the same scope: an interval join on scope-wide
bins of the text, then on the exact distance. Texts are read once; what moves is one small row per finding.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campaignry.llm.places import pieces
from campaignry.session import cut_lineage

# The patterns of the findings, the group that holds the value, and its least length.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
WEAK = r"""(?i:(password|passwd|secret|token|api_?key|passphrase|pwd|pin|auth))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=@!-]{6,})"""
IDENTIFIER = r"""(?i:(user(?:_?name)?|login|client_?id|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})"""
ENDPOINT = r"""(?i:(https?|ftps?|postgres(?:ql)?|mysql|mongodb|redis|amqp))://([A-Za-z0-9][A-Za-z0-9._:@/?=&%-]{3,})"""
KINDS = [  # number, name, pattern, group, least length, role
    (1, "assign", ASSIGN, 2, 12, "base"), (2, "access", ACCESS, 0, 18, "base"), (3, "hex", HEX, 0, 16, "base"),
    (4, "linked", WEAK, 2, 6, "weak"), (5, "identifier", IDENTIFIER, 2, 3, "part"), (6, "endpoint", ENDPOINT, 2, 4, "part"),
]


@dataclass(frozen=True)
class Linking:
    scope: int = 400  # characters between the parts of one credential


def findings(docs: DataFrame) -> DataFrame:
    """row, doc_id and per kind the array of its matches; null where a text has none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text"))
    return rows.select("doc_id", "row", *[
        F.when(F.col("text").rlike(pattern), pieces(F.col("text"), F.lit(pattern), group)).alias(name)
        for _, name, pattern, group, _, _ in KINDS])


def spans(found: DataFrame) -> DataFrame:
    """row, kind (number), start, end of every match that is long enough; code points, end exclusive."""
    each = F.concat(*[F.coalesce(F.transform(F.col(name), lambda x, i: F.struct(
        F.lit(k).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["hit"].alias("hit"), (x["value"] >= least).alias("ok"))),
        F.array().cast("array<struct<kind:int,i:int,gap:int,hit:int,ok:boolean>>")) for k, name, _, _, least, _ in KINDS])
    rows = found.select("row", F.explode(each).alias("m")).select("row", "m.*")
    run = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("hit")).over(run))
    return rows.filter("ok").select("row", "kind", (F.col("end") - F.col("hit")).alias("start"), "end")


def linked(found_spans: DataFrame, link: Linking) -> DataFrame:
    """Weak candidates with an identifier or endpoint in their scope, and no strong finding over them."""
    weak = found_spans.filter("kind = 4")
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / link.scope), F.floor(b / link.scope)))
    strong = found_spans.filter("kind <= 3").select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"),
                                                    bins(F.col("start"), F.col("end")).alias("bin"))
    parts = found_spans.filter("kind = 2 OR kind > 4").select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"),
                                                              bins(F.col("start"), F.col("end")).alias("bin"))
    own = weak.withColumn("bin", bins(F.col("start"), F.col("end")))
    covered = own.join(strong, (own["row"] == strong["r"]) & (own["bin"] == strong["bin"]) & (strong["s"] < own["end"])
                       & (strong["e"] > own["start"]), "left_semi").select("row", "start").distinct()
    near = weak.withColumn("bin", bins(F.col("start") - link.scope, F.col("end") + link.scope))
    met = near.join(parts, (near["row"] == parts["r"]) & (near["bin"] == parts["bin"]) & (parts["s"] < near["end"] + link.scope)
                    & (parts["e"] > near["start"] - link.scope), "left_semi")
    return met.select("row", "kind", "start", "end").distinct().join(covered, ["row", "start"], "left_anti").select("row", "kind", "start", "end")


def secret_scan(docs: DataFrame, link: Linking = Linking()) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_linked, base_sha256, spans.

    Nulls: a null text is empty; null ids stay. Repeated rows get equal results. A text without findings has empty
    spans. At one start the kinds go in their order. An empty table gives no rows. Other columns are not read.
    """
    found = cut_lineage(findings(docs))
    all_spans = cut_lineage(spans(found.filter(" OR ".join(f"{name} IS NOT NULL" for _, name, *_ in KINDS))))
    reported = all_spans.filter("kind <= 3").unionAll(linked(all_spans, link))
    names = F.element_at(F.array(*[F.lit(name) for _, name, *_ in KINDS]), F.col("kind"))
    mark = F.concat_ws(":", names, F.col("start").cast("string"), F.col("end").cast("string"))
    # The findings of one text: bounded by its length.
    per_row = reported.withColumn("mark", mark).groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{name}") for k, name, *_ in KINDS[:4]],
        F.sort_array(F.collect_list(F.struct("start", "kind", "mark"))).alias("marks"))
    out = found.select("doc_id", "row").join(per_row, "row", "left")
    marks = F.coalesce("marks", F.array().cast("array<struct<start:bigint,kind:int,mark:string>>"))
    base = F.array_join(F.transform(F.filter(marks, lambda m: m["kind"] <= 3), lambda m: m["mark"]), ",")
    return out.select("doc_id", *[F.coalesce(f"n_{name}", F.lit(0)).cast("long").alias(f"n_{name}") for _, name, *_ in KINDS[:4]],
                      F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform(marks, lambda m: m["mark"]), ",").alias("spans"))


def _sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


ORACLE = f"""
WITH k(kind, name, pat, least) AS (VALUES {', '.join(f"({k}, {_sql(name)}, {_sql(p)}, {least})" for k, name, p, _, least, _ in KINDS)}),
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(f'''
    SELECT row, {k} AS kind, {least} AS least, string_split_regex(text, {_sql(p)}) AS gaps, regexp_extract_all(text, {_sql(p)}) AS hits,
           regexp_extract_all(text, {_sql(p)}, {g}) AS vals FROM d WHERE regexp_matches(text, {_sql(p)})''' for k, _, p, g, least, _ in KINDS)}),
e AS (SELECT row, kind, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, vals FROM m),
f AS (SELECT row, kind, i, length(gaps[i]) + length(hits[i]) AS step, length(hits[i]) AS hit, length(vals[i]) >= least AS ok FROM e),
g AS (SELECT *, sum(step) OVER (PARTITION BY row, kind ORDER BY i) AS "end" FROM f),
s AS (SELECT row, kind, ("end" - hit)::BIGINT AS start, "end"::BIGINT AS "end" FROM g WHERE ok),
r AS (SELECT * FROM s WHERE kind <= 3 UNION ALL
      SELECT * FROM s w WHERE kind = 4
         AND EXISTS (SELECT 1 FROM s p WHERE p.row = w.row AND (p.kind = 2 OR p.kind > 4) AND p.start < w."end" + 400 AND p."end" > w.start - 400)
         AND NOT EXISTS (SELECT 1 FROM s b WHERE b.row = w.row AND b.kind <= 3 AND b.start < w."end" AND b."end" > w.start)),
a AS (SELECT row, count(*) FILTER (r.kind = 1) AS n_assign, count(*) FILTER (r.kind = 2) AS n_access, count(*) FILTER (r.kind = 3) AS n_hex,
             count(*) FILTER (r.kind = 4) AS n_linked,
             string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, r.kind) FILTER (r.kind <= 3) AS base,
             string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, r.kind) AS spans
      FROM r JOIN k ON k.kind = r.kind GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_linked, 0) AS n_linked,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.row = d.row
"""
