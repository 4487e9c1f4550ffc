"""URL filters: hand-written rules first, then a tree of path templates per host.

Everything is DataFrame operations. Per host the path's first ``DEPTH`` segments are read level by level: a
segment stays literal if enough of its parent's pages have it, else it becomes the
wildcard ``*``; deeper segments become one ``**``. Branches below the host whose
templates are spread like the host's (Bhattacharyya coefficient) and whose labelled
share of bad pages does not differ from the host's (two-sided test of proportions) are
merged into one branch, ``~``. A template's purity is its labelled share of bad
pages, smoothed towards the share over all labelled pages with the weight of
``WEIGHT`` pages; templates that reach ``REJECT`` are rejected.

The labelled pages are those that rules decide: blocked is bad, allowed is good. A rule fits its
host and all subdomains if the path starts with the rule's; the longest wins, and its verdict is final.

Null urls and urls without ``://`` have empty host and path, no rule, and are
judged as a host of their own. Repeated rows are pages like any other. Other columns
are not read. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rungwise.llm.common import read_table
from rungwise.session import checkpointed

DEPTH, LEAST_PAGES, LEAST_SHARE = 3, 5, 0.02
ALIKE, Z_SQUARED = 0.9, 3.84
WEIGHT, REJECT = 2.0, 0.9
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as (size, rule, verdict), or null; the later name wins among equals. ``rules`` is short."""
    fitting = [
        F.when(
            ((host == F.lit(h)) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in rules
    ]
    return F.array_max(F.array_compact(F.array(*fitting)))


def templated(pages: DataFrame) -> DataFrame:
    """``pages`` with ``branch`` (first level) and ``below`` (the rest) of each path's template."""
    inner = F.when(F.col("path").startswith("/"), F.split(F.substr("path", F.lit(2)), "/", -1))
    rows = pages.withColumn("parts", F.coalesce(inner, F.array().cast("array<string>"))).withColumn("template", F.lit(""))
    for level in range(DEPTH):
        rows = checkpointed(rows.withColumn("part", F.get("parts", F.lit(level))))
        counts = rows.filter("part is not null").groupBy("host", "template", "part").agg(F.count("*").alias("n"))
        totals = counts.groupBy("host", "template").agg(F.sum("n").alias("total"))
        literal = counts.join(totals, ["host", "template"]).filter(
            (F.col("n") >= LEAST_PAGES) & (F.col("n") >= LEAST_SHARE * F.col("total"))
        ).select("host", "template", "part", F.lit(True).alias("literal"))
        shown = F.when(F.col("literal"), F.col("part")).otherwise(F.lit("*"))
        grown = F.concat("template", F.lit("/"), shown)
        rows = rows.join(literal, ["host", "template", "part"], "left").withColumn(
            "template", F.when(F.col("part").isNull(), F.col("template")).otherwise(grown)
        ).drop("literal", "part")
        if not level:
            rows = rows.withColumn("branch", F.col("template"))
    deeper = F.when(F.size("parts") > DEPTH, F.lit("/**")).otherwise(F.lit(""))
    below = F.concat(F.substr("template", F.length("branch") + 1), deeper)
    return checkpointed(rows.withColumn("below", below).drop("parts", "template"))


def judged(rows: DataFrame) -> DataFrame:
    """``host, branch, below, template, purity`` of every template; labels are in ``bad`` (null: unlabelled)."""
    sums = (F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"))
    leaves = rows.groupBy("host", "branch", "below").agg(*sums)
    totals = (F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    branches = leaves.groupBy("host", "branch").agg(*totals)
    hosts = branches.groupBy("host").agg(*(F.sum(c).alias(f"host_{c}") for c in ("n", "labelled", "bad")))
    spread = leaves.groupBy("host", "below").agg(F.sum("n").alias("host_below"))
    alike = (
        leaves.select("host", "branch", "below", F.col("n").alias("leaf")).join(spread, ["host", "below"])
        .join(branches.select("host", "branch", "n"), ["host", "branch"]).join(hosts.select("host", "host_n"), "host")
        .groupBy("host", "branch")
        .agg(F.sum(F.sqrt(F.col("leaf") / F.col("n") * F.col("host_below") / F.col("host_n"))).alias("alike"))
    )
    rate = F.try_divide("host_bad", "host_labelled")
    gap = F.try_divide("bad", "labelled") - rate  # null without labels: no evidence, not merged
    noise = F.try_divide(Z_SQUARED * rate * (1 - rate), F.col("labelled"))
    same = (F.col("alike") >= ALIKE) & (gap * gap <= noise + 1e-9)
    merged = branches.join(hosts, "host").join(alike, ["host", "branch"]).select(
        "host", "branch", F.when(same, F.lit("/~")).otherwise(F.col("branch")).alias("merged")
    )
    overall = leaves.agg(F.try_divide(F.sum("bad"), F.sum("labelled"))).first()[0] or 0.0
    grouped = leaves.join(merged, ["host", "branch"])
    groups = grouped.groupBy("host", "merged", "below").agg(*totals[1:])
    purity = (F.col("bad") + WEIGHT * overall) / (F.col("labelled") + WEIGHT)
    scored = groups.select("host", "merged", "below", purity.alias("purity"))
    return grouped.select("host", "branch", "below", "merged").join(scored, ["host", "merged", "below"]).select(
        "host", "branch", "below", F.concat("merged", "below").alias("template"), "purity"
    )


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` of every row of ``page_id, url``."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("ruled", ruled(F.col("host"), F.col("path"), rules))
    rows = rows.select("page_id", "host", "path", "ruled.rule", "ruled.verdict").withColumn("bad", F.col("verdict") == "block")
    rows = templated(rows)
    told = rows.join(judged(rows), ["host", "branch", "below"])
    method = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return told.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "template")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"))


def _level_sql(level: int) -> str:
    last, shown = f"l{level}", "CASE WHEN k.part IS NULL THEN '*' ELSE k.part END"
    grown = f"CASE WHEN r.part IS NULL THEN r.template ELSE r.template || '/' || {shown} END"
    branch = f"{grown} AS branch" if not level else "r.branch"
    return f"""
c{level} AS (SELECT host, template, part, count(*) AS n FROM {last} WHERE part IS NOT NULL GROUP BY ALL),
k{level} AS (SELECT host, template, part FROM c{level}
  QUALIFY n >= {LEAST_PAGES} AND n >= {LEAST_SHARE} * sum(n) OVER (PARTITION BY host, template)),
l{level + 1} AS (SELECT r.page_id, r.host, r.path, r.rule, r.verdict, r.bad, r.parts, r.parts[{level + 2}] AS part,
  {grown} AS template, {branch}
  FROM {last} r LEFT JOIN k{level} k ON k.host = r.host AND k.template = r.template AND k.part = r.part)"""


def _rules_sql() -> str:
    cases = sorted(RULES, key=lambda rule: (len(rule[1] + rule[2]), rule[1] + rule[2]), reverse=True)
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in cases]
    rule = " ".join(f"WHEN {fit} THEN '{name}'" for fit, name, _ in fits)
    verdict = " ".join(f"WHEN {fit} THEN '{v}'" for fit, _, v in fits)
    return f"CASE {rule} END AS rule, CASE {verdict} END AS verdict"


OP3_SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts0 AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
split AS (
  SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts0),
ruled AS (SELECT *, {_rules_sql()} FROM split),
l0 AS (
  SELECT *, CASE WHEN starts_with(path, '/') THEN string_split(substr(path, 2), '/') ELSE [] END AS parts,
    parts[1] AS part, '' AS template, '' AS branch, verdict = 'block' AS bad FROM ruled),
{",".join(_level_sql(level) for level in range(DEPTH))},
paged AS (SELECT *, substr(template, length(branch) + 1) || CASE WHEN len(parts) > {DEPTH} THEN '/**' ELSE '' END AS below
  FROM l{DEPTH}),
leaves AS (SELECT host, branch, below, count(*) AS n, count(bad) AS labelled, count(*) FILTER (bad) AS bad FROM paged GROUP BY ALL),
branches AS (SELECT host, branch, sum(n) AS n, sum(labelled) AS labelled, sum(bad) AS bad FROM leaves GROUP BY ALL),
hosts AS (SELECT host, sum(n) AS host_n, sum(labelled) AS host_labelled, sum(bad) AS host_bad FROM branches GROUP BY ALL),
spread AS (SELECT host, below, sum(n) AS host_below FROM leaves GROUP BY ALL),
alike AS (
  SELECT host, branch, sum(sqrt(l.n / b.n * host_below / host_n)) AS alike FROM leaves l JOIN spread USING (host, below)
  JOIN branches b USING (host, branch) JOIN hosts USING (host) GROUP BY ALL),
merged AS (
  SELECT host, branch, CASE WHEN labelled > 0 AND alike >= {ALIKE}
    AND (bad / labelled - host_bad / host_labelled) ** 2
      <= {Z_SQUARED} * (host_bad / host_labelled) * (1 - host_bad / host_labelled) / labelled + 1e-9
    THEN '/~' ELSE branch END AS merged
  FROM branches JOIN hosts USING (host) JOIN alike USING (host, branch)),
scored AS (
  SELECT host, merged, below, (sum(bad) + {WEIGHT} * (SELECT sum(bad) / greatest(sum(labelled), 1) FROM leaves))
    / (sum(labelled) + {WEIGHT}) AS purity
  FROM leaves JOIN merged USING (host, branch) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
  merged || below AS template
FROM paged JOIN merged USING (host, branch) JOIN scored USING (host, merged, below)
"""
