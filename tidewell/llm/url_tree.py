"""URL filters over a path-template tree, in DataFrame operations only.

Explicit rules judge first and label what they judge. The paths of a host then grow a tree, segment by segment:
numbers and long hex strings become wildcards, and siblings whose share of blocked urls does not differ significantly
from the largest one's become one branch `*`. A branch ends where nothing else shares it, with its tail as it is, so
paths of any depth have a template.

A node's purity is its own share of blocked labels, smoothed by what is known without them: the same path prefix over
all hosts, as far as it has labels, and the node above in the host's tree; the top is the host, then the corpus. So a
template without labels is judged by its like on other hosts and by its parents. It is rejected from `MIN_PURITY` on.

Equal path shapes of a host are summed before any other shuffle, so a host with a large part of all pages costs one row
for each of its shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored

# Fixed values: (verdict, host, path) of the production rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
SMOOTHING, MIN_PURITY, MAX_Z = 4.0, 0.8, 2.0
END = "<end>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = "(?s)^(.*?)://([^/?#]*)([^?#]*)"


def parsed(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """`pages` with host, path and shape, the path with its variable parts as wildcards."""
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    host = F.translate(F.regexp_extract(url, _PARTS, 2), _UPPER, _UPPER.lower())
    rows = pages.withColumns({"host": host, "path": F.regexp_extract(url, _PARTS, 3)})
    return rows.withColumn("shape", F.regexp_replace(F.regexp_replace("path", "[0-9a-f]{16,}", "{h}"), "[0-9]+", "{n}"))


def ruled(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null where none fits."""
    text = verdict = None
    for v, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text = F.when(fits, host + path) if text is None else text.when(fits, host + path)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (text, verdict) if text is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def _templates(shapes: DataFrame) -> DataFrame:
    """host, shape, template and purity of shapes (host, shape, n, bad, labelled), in one round for each segment that
    two different shapes share."""
    shapes = stored(shapes, "url-shapes")
    whole = shapes.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).first()
    share = F.lit(((whole.bad or 0) + 1) / ((whole.labelled or 0) + 2))
    segments = F.concat(F.split("shape", "/"), F.array(F.lit(END)))
    every = stored(shapes.groupBy("shape").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).select("bad", "labelled", segments.alias("x"), F.lit(0).cast("long").alias("key")), "url-shapes")
    smooth = lambda bad, labelled, prior: (bad + SMOOTHING * prior) / (labelled + SMOOTHING)
    hosts = shapes.groupBy("host").agg(smooth(F.sum("bad"), F.sum("labelled"), share).alias("up"))
    rows = stored(shapes.join(hosts, "host").select("*", segments.alias("x"), F.lit(0).cast("long").alias("key"), F.lit("").alias("template")), "url-shapes")
    done, level = None, 0
    while not rows.isEmpty():
        s, mean = F.get("x", F.lit(level)), lambda c: F.sum(F.col("n") * F.col(c)) / F.sum("n")
        every = stored(every.filter(F.size("x") > level).withColumn("key", F.xxhash64("key", s)), "url-shapes")
        alike_paths = every.groupBy("key").agg(F.count(F.lit(1)).alias("shapes"), smooth(F.sum("bad"), F.sum("labelled"), share).alias("g"), F.sum("labelled").alias("seen"))
        rows = stored(rows.withColumns({"s": s, "key": F.xxhash64("key", s)}).join(alike_paths, "key"), "url-shapes")
        keys = ["host", "template"]
        children = rows.groupBy(*keys, "s").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"), mean("g").alias("g"), mean("seen").alias("seen"), F.max("up").alias("up"))
        prior = (F.col("seen") * F.col("g") + SMOOTHING * F.col("up")) / (F.col("seen") + SMOOTHING)
        children = children.withColumn("prior", prior).withColumns({"r": smooth(F.col("bad"), F.col("labelled"), F.col("prior")), "m": F.col("labelled") + SMOOTHING})
        children = stored(children, "url-children")
        largest = children.groupBy(*keys).agg(F.max(F.struct("n", "s", "r", "m")).alias("top"))
        pairs = children.join(largest, keys)
        pooled = (F.col("r") * F.col("m") + F.col("top.r") * F.col("top.m")) / (F.col("m") + F.col("top.m"))
        gap = F.col("r") - F.col("top.r")
        alike = gap * gap <= MAX_Z**2 * pooled * (1 - pooled) * (1 / F.col("m") + 1 / F.col("top.m"))
        pairs = stored(pairs.withColumn("alike", alike).drop("top"), "url-siblings")
        several = pairs.filter("alike").groupBy(*keys).agg((F.count(F.lit(1)) > 1).alias("several"))
        name = F.when(F.col("alike") & F.col("several"), "*").otherwise(F.col("s"))
        named = stored(pairs.join(several, keys).withColumn("name", name), "url-names")
        purity = named.groupBy(*keys, "name").agg(smooth(F.sum("bad"), F.sum("labelled"), mean("prior")).alias("purity"))
        purity = stored(named.select(*keys, "s", "name").join(purity, [*keys, "name"]), "url-names")
        rows = rows.drop("up").join(purity, [*keys, "s"]).withColumn("template", F.concat_ws("/", "template", "name"))
        rows = stored(rows.select("host", "shape", "n", "bad", "labelled", "x", "key", "template", "shapes", F.col("purity").alias("up")), "url-shapes")
        alone = rows.groupBy(*keys).agg((F.count(F.lit(1)) == 1).alias("alone"))
        rows = stored(rows.join(alone, keys).withColumn("ends", (F.size("x") == level + 1) | F.col("alone") & (F.col("shapes") == 1)), "url-shapes")
        tail = F.concat_ws("/", "template", F.slice("x", level + 2, F.greatest(F.size("x") - level - 1, F.lit(0))))
        ended = rows.filter("ends").select("host", "shape", tail.alias("template"), F.col("up").alias("purity"))
        done = ended if done is None else done.unionByName(ended)
        rows, level = rows.filter("not ends").drop("alone", "ends", "shapes"), level + 1
    return stored(done, "url-templates") if done is not None else shapes.select("host", "shape", F.lit("").alias("template"), F.lit(0.0).alias("purity"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", learn: Column | None = None) -> DataFrame:
    """Per row of `pages`: page_id, host, path, rule, verdict, by_tree (the tree's verdict), template, purity.

    Null urls, empty urls and urls without `://` have empty host and path and share one template. Repeated rows count
    each; two templates with equal counts are both kept as they are. Paths of any length count whole. `learn` says
    which rows' rules are labels for the tree (default all; null is false). An empty table gives no rows. Other
    columns are not read.
    """
    rule, verdict = ruled(rules)
    learns = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    rows = parsed(pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), learns.alias("learn"))).drop("url").withColumns({"rule": rule, "given": verdict})
    label = F.when(F.col("learn"), F.col("given"))
    shapes = rows.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count_if(label == "block").alias("bad"), F.count(label).alias("labelled"))
    by_tree = F.when(F.col("purity") >= MIN_PURITY, "block").otherwise("allow")
    found = rows.join(_templates(shapes), ["host", "shape"])
    return found.select("page_id", "host", "path", "rule", F.coalesce("given", by_tree).alias("verdict"), by_tree.alias("by_tree"), "template", "purity")


def judge_sql(rules: list[tuple[str, str, str]] = RULES, levels: int = 6) -> str:
    """page_id, host, path, rule, verdict, template by SQL over `pages`, whose paths part within `levels` segments."""
    fits = [(v, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    rule = " ".join(f"WHEN {c} THEN '{t}'" for _, t, c in fits)
    given = " ".join(f"WHEN {c} THEN '{v}'" for v, _, c in fits)
    smooth = lambda bad, labelled, prior: f"(({bad} + {SMOOTHING}::DOUBLE * {prior}) / ({labelled} + {SMOOTHING}::DOUBLE))"
    sql = f"""
    WITH urls AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
    parts AS (SELECT page_id, translate(regexp_extract(url, '{_PARTS}', 2), '{_UPPER}', '{_UPPER.lower()}') AS host, regexp_extract(url, '{_PARTS}', 3) AS path FROM urls),
    judged AS (SELECT page_id, host, path, regexp_replace(regexp_replace(path, '[0-9a-f]{{16,}}', '{{h}}', 'g'), '[0-9]+', '{{n}}', 'g') AS shape, CASE {rule} END AS rule, CASE {given} END AS given FROM parts),
    shapes AS (SELECT host, shape, count(*) AS n, count(*) FILTER (given = 'block') AS bad, count(given) AS labelled, list_append(string_split(shape, '/'), '{END}') AS x FROM judged GROUP BY host, shape),
    whole AS (SELECT (sum(bad) + 1) / (sum(labelled) + 2.0::DOUBLE) AS share FROM shapes),
    every AS (SELECT x, sum(bad) AS bad, sum(labelled) AS labelled FROM shapes GROUP BY x),
    rows0 AS (SELECT s.*, '' AS template, {smooth("sum(bad) OVER (PARTITION BY host)", "sum(labelled) OVER (PARTITION BY host)", "share")} AS up FROM shapes s, whole)"""
    for i in range(levels):
        sql += f""",
    paths{i} AS (SELECT x[:{i + 1}] AS key, count(*) AS shapes, {smooth("sum(bad)", "sum(labelled)", "any_value(share)")} AS g, sum(labelled) AS seen FROM every, whole WHERE len(x) > {i} GROUP BY 1),
    here{i} AS (SELECT r.*, x[{i + 1}] AS s, p.shapes, g, seen FROM rows{i} r JOIN paths{i} p ON r.x[:{i + 1}] = p.key),
    children{i} AS (SELECT host, template, s, sum(n) AS n, sum(bad) AS bad, sum(labelled) AS labelled, sum(n * g) / sum(n) AS g, sum(n * seen)::DOUBLE / sum(n) AS seen, max(up) AS up FROM here{i} GROUP BY ALL),
    priors{i} AS (SELECT *, (seen * g + {SMOOTHING}::DOUBLE * up) / (seen + {SMOOTHING}::DOUBLE) AS prior FROM children{i}),
    ranked{i} AS (SELECT *, {smooth("bad", "labelled", "prior")} AS r, labelled + {SMOOTHING}::DOUBLE AS m, row_number() OVER (PARTITION BY host, template ORDER BY n DESC, s DESC) AS k FROM priors{i}),
    pairs{i} AS (SELECT c.*, t.r AS tr, t.m AS tm, (c.r * c.m + t.r * t.m) / (c.m + t.m) AS pooled FROM ranked{i} c JOIN ranked{i} t ON c.host = t.host AND c.template = t.template AND t.k = 1),
    tested{i} AS (SELECT *, (r - tr) * (r - tr) <= {MAX_Z**2} * pooled * (1 - pooled) * (1 / m + 1 / tm) AS alike FROM pairs{i}),
    named{i} AS (SELECT *, CASE WHEN alike AND count(*) FILTER (alike) OVER (PARTITION BY host, template) > 1 THEN '*' ELSE s END AS name FROM tested{i}),
    pure{i} AS (SELECT host, template, name, {smooth("sum(bad)", "sum(labelled)", "sum(n * prior) / sum(n)")} AS purity FROM named{i} GROUP BY host, template, name),
    next{i} AS (SELECT h.host, h.shape, h.n, h.bad, h.labelled, h.x, CASE WHEN {i} = 0 AND h.template = '' THEN '/' || m.name ELSE h.template || '/' || m.name END AS template, purity AS up, h.shapes
      FROM here{i} h JOIN named{i} m ON h.host = m.host AND h.template = m.template AND h.s = m.s JOIN pure{i} p ON m.host = p.host AND m.template = p.template AND m.name = p.name),
    ends{i} AS (SELECT *, len(x) = {i + 1} OR shapes = 1 AND count(*) OVER (PARTITION BY host, template) = 1 AS ends FROM next{i}),
    rows{i + 1} AS (SELECT host, shape, n, bad, labelled, x, template, up FROM ends{i} WHERE NOT ends),
    done{i} AS (SELECT host, shape, array_to_string(list_prepend(template, x[{i + 2}:]), '/') AS template, up AS purity FROM ends{i} WHERE ends)"""
    union = " UNION ALL ".join(f"SELECT * FROM done{i}" for i in range(levels))
    return sql + f""",
    done AS ({union})
    SELECT page_id, j.host, path, rule, coalesce(given, CASE WHEN purity >= {MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict, template
    FROM judged j JOIN done d ON j.host = d.host AND j.shape = d.shape"""
