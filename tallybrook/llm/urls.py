"""URL filters: rules by host and path, and a tree of path templates judged by labelled purity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import lower_ascii, rows_held, stored

ALLOW, BLOCK = "allow", "block"
RULES = (
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
)
# Levels that the SQL counterpart spells out; the operator goes on as deep as the paths branch.
DEPTH = 4
# A node's children are variable if there are so many, with fewer pages each than this on average.
CHILDREN, PAGES_PER_CHILD = 12, 3
# Branches merge if their purity lies within so many standard errors of their common one.
ERRORS = 1.96
# Labels that the share above counts as at each level, from all pages down to a template; and the part of the share of all
# labels below which a template's purity is rejected.
SMOOTHING, LEAST_PART = 4, 0.8

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host, A-Z lower-cased, and the path; both empty without one."""
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, URL, 1)), F.regexp_extract(url, URL, 2)


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path begins the url's."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        of, _, start = rule.partition("/")
        fits = ((host == of) | F.endswith(host, F.lit(f".{of}"))) & F.startswith(path, F.lit(f"/{start}"))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def template_tree(paths: DataFrame) -> DataFrame:
    """(host, shape, template) for distinct rows of (host, shape, pages).

    From the root down, a node's children become one wildcard where the data shows that they
    vary: many children, few pages each. A child below a wildcard belongs to it. A level is
    stored before the next; the shapes below a node are among those below its parent, so where
    they are fewer than ``CHILDREN`` nothing deeper can vary, and the shapes are done.
    """
    tree = paths.select("host", "shape", "pages", F.split("shape", "/").alias("parts"))
    done, d = [], 1
    while True:
        tree = tree.withColumns(
            {"above": F.array_join(F.slice("parts", 1, d), "/"), "child": F.get(F.col("parts"), F.lit(d))}
        )
        children = tree.where("child IS NOT NULL").groupBy("host", "above", "child")
        children = children.agg(F.sum("pages").alias("pages"), F.count("*").alias("shapes"))
        nodes = children.groupBy("host", "above").agg(
            F.count("*").alias("n"), F.sum("pages").alias("pages"), F.sum("shapes").alias("shapes")
        )
        varied = (F.col("n") >= CHILDREN) & (F.col("pages") < PAGES_PER_CHILD * F.col("n"))
        nodes = nodes.where(F.col("shapes") >= CHILDREN).select("host", "above", varied.alias("varied"))
        tree = tree.join(nodes, ["host", "above"], "left")
        wild = F.concat(F.slice("parts", 1, d), F.array(F.lit("*")), F.slice("parts", d + 2, 1 << 20))
        parts = F.when(F.col("varied") & F.col("child").isNotNull(), wild).otherwise(F.col("parts"))
        deeper = F.col("varied").isNotNull() & F.col("child").isNotNull()
        level = stored(tree.select("host", "shape", "pages", parts.alias("parts"), deeper.alias("deeper")), "url-levels")
        done.append(level.where("NOT deeper").select("host", "shape", F.array_join("parts", "/").alias("template")))
        tree = level.where("deeper").drop("deeper")
        if tree.isEmpty():
            return reduce(DataFrame.unionAll, done)
        d += 1


def smoothed(good: Column, n: Column, above: Column) -> Column:
    """The share of good labels, drawn towards the share above as by ``SMOOTHING`` labels of it."""
    return (good + F.lit(float(SMOOTHING)) * above) / (n + F.lit(float(SMOOTHING)))


def judged_templates(leaves: DataFrame) -> DataFrame:
    """(host, template, good, bad, purity, rejected) from (host, template, good, bad).

    Templates with labels that hang on one node are compared with all labels below it; those
    within the sampling error are merged and share their counts. Purity is the share of good labels, smoothed
    towards the node's, which is smoothed towards the host's, and that towards the share of all labels, one half
    without any. So a template with few labels or none is judged by those of its neighbours, and one of whose host
    nothing is known is as good as all. It is rejected where its purity is clearly lower than that.
    """
    leaves = leaves.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    leaves = leaves.withColumns({"node": F.regexp_replace("template", "/[^/]*$", ""), "n": F.col("good") + F.col("bad")})
    nodes = leaves.groupBy("host", "node").agg(F.sum("good").alias("all_good"), F.sum("n").alias("all_n"))
    hosts = nodes.groupBy("host").agg(F.sum("all_good").alias("host_good"), F.sum("all_n").alias("host_n"))
    table = hosts.agg(F.coalesce(F.sum("host_good"), F.lit(0)).alias("table_good"), F.coalesce(F.sum("host_n"), F.lit(0)).alias("table_n"))
    table = table.select(smoothed(F.col("table_good"), F.col("table_n"), F.lit(0.5)).alias("table_share"))
    host_share = smoothed(F.col("host_good"), F.col("host_n"), F.col("table_share")).alias("host_share")
    hosts = hosts.join(F.broadcast(table)).select("host", "table_share", host_share)
    nodes = nodes.join(hosts, "host").withColumn("node_share", smoothed(F.col("all_good"), F.col("all_n"), F.col("host_share")))
    leaves = leaves.join(nodes, ["host", "node"])
    n, share = F.col("n").cast("double"), F.col("all_good") / F.col("all_n")
    off = F.col("good") / n - share
    alike = (F.col("n") > 0) & (off * off <= F.lit(ERRORS * ERRORS) * (share * (1 - share)) / n)
    leaves = leaves.withColumn("alike", F.when(F.col("n") > 0, alike).otherwise(False))
    merged = leaves.where("alike").groupBy("host", "node").agg(F.sum("good").alias("m_good"), F.sum("n").alias("m_n"))
    leaves = leaves.join(merged, ["host", "node"], "left")
    good = F.when(F.col("alike"), F.col("m_good")).otherwise(F.col("good"))
    total = F.when(F.col("alike"), F.col("m_n")).otherwise(F.col("n"))
    purity = smoothed(good, total, F.col("node_share"))
    rejected = purity < F.lit(LEAST_PART) * F.col("table_share")
    return leaves.select("host", "template", "good", "bad", purity.alias("purity"), rejected.alias("rejected"))


def with_labels(shapes: DataFrame, labels: DataFrame) -> DataFrame:
    """The shapes of the pages and of the labelled urls, with the labels of both; a labelled url counts as a page of its shape."""
    host, path = host_and_path(F.col("url"))
    good = F.col("good").cast("boolean")
    told = labels.where(good.isNotNull()).select(
        host.alias("host"),
        F.regexp_replace(path, "[0-9]+", "#").alias("shape"),
        F.lit(1).cast("long").alias("pages"),
        good.cast("long").alias("good"),
        (~good).cast("long").alias("bad"),
    )
    sums = [F.sum(c).alias(c) for c in ("pages", "good", "bad")]
    told = told.groupBy("host", "shape").agg(*sums)
    return shapes.select(told.columns).unionByName(told).groupBy("host", "shape").agg(*sums)


def judge_urls(
    pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, labels: DataFrame | None = None
) -> DataFrame:
    """(row, host, path, rule, template, purity, verdict) for every row of ``pages``.

    Pages under a rule get its verdict and are labels of the templates; other pages are
    blocked if their template is rejected, else allowed. ``labels`` (``url``, ``good``) gives the templates more
    labels: judged urls, which need not be among the pages and stand for none; null labels say nothing. ``pages``
    needs ``url``; all columns stay inside ``row``. A null url, or one without ``://``, has an empty host and path and so
    no rule; repeated rows count as often as they occur. Digits become ``#`` before the tree is
    grown, and all counts are summed by host and shape first, so a host with a third of all
    pages is as many rows as it has shapes.
    """
    held = rows_held(pages)
    host, path = host_and_path(F.col("row.url"))
    parted = held.select("row", host.alias("host"), path.alias("path"))
    parted = parted.withColumns(
        {"found": rule_for(F.col("host"), F.col("path"), rules), "shape": F.regexp_replace("path", "[0-9]+", "#")}
    )
    label = F.col("found.verdict")
    shapes = stored(
        parted.groupBy("host", "shape").agg(
            F.count("*").alias("pages"), F.count_if(label == ALLOW).alias("good"), F.count_if(label == BLOCK).alias("bad")
        ),
        "url-shapes",
    )
    if labels is not None:
        shapes = stored(with_labels(shapes, labels), "url-shapes")
    tree = stored(template_tree(shapes.select("host", "shape", "pages")), "url-templates")
    leaves = shapes.join(tree, ["host", "shape"])
    verdicts = judged_templates(leaves.select("host", "template", "good", "bad"))
    by_shape = stored(
        tree.join(verdicts, ["host", "template"]).select("host", "shape", "template", "purity", "rejected"), "url-verdicts"
    )
    own = F.when(F.col("rejected"), BLOCK).otherwise(ALLOW)
    return parted.join(by_shape, ["host", "shape"], "left").select(
        "row",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        "template",
        "purity",
        F.coalesce(label, own).alias("verdict"),
    )


def _depth_sql(d: int) -> str:
    return f"""
kids{d} AS (SELECT *, array_to_string(parts[1:{d}], '/') AS above, parts[{d + 1}] AS child FROM tree{d - 1}),
varied{d} AS (
  SELECT host, above FROM (SELECT host, above, child, SUM(pages) AS pages FROM kids{d} WHERE child IS NOT NULL
                           GROUP BY host, above, child)
  GROUP BY host, above HAVING COUNT(*) >= {CHILDREN} AND SUM(pages) < {PAGES_PER_CHILD} * COUNT(*)),
tree{d} AS (
  SELECT k.host, k.shape, k.pages, k.good, k.bad,
         CASE WHEN v.host IS NOT NULL AND k.child IS NOT NULL
              THEN list_concat(list_concat(k.parts[1:{d}], ['*']), k.parts[{d + 2}:]) ELSE k.parts END AS parts
  FROM kids{d} k LEFT JOIN varied{d} v ON k.host = v.host AND k.above = v.above),"""


URL_SQL = f"""
WITH cut AS (
  SELECT page_id,
         translate(regexp_extract(COALESCE(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(COALESCE(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
ruled AS (
  SELECT *, regexp_replace(path, '[0-9]+', '#', 'g') AS shape,
    CASE WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/')
              THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM cut),
labelled AS (
  SELECT *, CASE WHEN rule IS NULL THEN NULL WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' ELSE 'block' END
            AS label FROM ruled),
tree0 AS (
  SELECT host, shape, COUNT(*) AS pages, COUNT(*) FILTER (label = 'allow') AS good,
         COUNT(*) FILTER (label = 'block') AS bad, string_split(shape, '/') AS parts
  FROM labelled GROUP BY host, shape),{"".join(map(_depth_sql, range(1, DEPTH + 1)))}
shaped AS (SELECT host, shape, good, bad, array_to_string(parts, '/') AS template FROM tree{DEPTH}),
leaves AS (
  SELECT host, template, regexp_replace(template, '/[^/]*$', '') AS node, SUM(good) AS good, SUM(good + bad) AS n
  FROM shaped GROUP BY host, template),
nodes AS (SELECT host, node, SUM(good) AS all_good, SUM(n) AS all_n FROM leaves GROUP BY host, node),
hosts AS (SELECT host, SUM(all_good) AS host_good, SUM(all_n) AS host_n FROM nodes GROUP BY host),
all_labels AS (
  SELECT (COALESCE(SUM(host_good), 0)::DOUBLE + {SMOOTHING}::DOUBLE * 0.5::DOUBLE) / (COALESCE(SUM(host_n), 0)::DOUBLE + {SMOOTHING}::DOUBLE) AS table_share
  FROM hosts),
host_shares AS (
  SELECT host, (host_good::DOUBLE + {SMOOTHING}::DOUBLE * table_share) / (host_n::DOUBLE + {SMOOTHING}::DOUBLE) AS host_share
  FROM hosts, all_labels),
node_shares AS (
  SELECT n.host, node, (all_good::DOUBLE + {SMOOTHING}::DOUBLE * host_share) / (all_n::DOUBLE + {SMOOTHING}::DOUBLE) AS node_share
  FROM nodes n JOIN host_shares h ON n.host = h.host),
compared AS (
  SELECT l.*, CASE WHEN n > 0 THEN
      (good / n::DOUBLE - all_good::DOUBLE / all_n::DOUBLE) * (good / n::DOUBLE - all_good::DOUBLE / all_n::DOUBLE)
      <= {ERRORS * ERRORS}::DOUBLE * ((all_good::DOUBLE / all_n::DOUBLE) * (1 - all_good::DOUBLE / all_n::DOUBLE)) / n::DOUBLE
      ELSE FALSE END AS alike
  FROM leaves l JOIN nodes USING (host, node)),
merged AS (SELECT host, node, SUM(good) AS m_good, SUM(n) AS m_n FROM compared WHERE alike GROUP BY host, node),
judged AS (
  SELECT c.host, c.template,
         ((CASE WHEN alike THEN m_good ELSE good END)::DOUBLE + {SMOOTHING}::DOUBLE * node_share)
         / ((CASE WHEN alike THEN m_n ELSE n END)::DOUBLE + {SMOOTHING}::DOUBLE) AS purity, table_share
  FROM compared c CROSS JOIN all_labels JOIN node_shares s ON c.host = s.host AND c.node = s.node
  LEFT JOIN merged m ON c.host = m.host AND c.node = m.node)
SELECT l.page_id, l.host, l.path, l.rule, s.template, j.purity,
       COALESCE(l.label, CASE WHEN j.purity < {LEAST_PART}::DOUBLE * j.table_share THEN 'block' ELSE 'allow' END) AS verdict
FROM labelled l JOIN shaped s ON l.host = s.host AND l.shape = s.shape
JOIN judged j ON s.host = j.host AND s.template = j.template
"""
