"""URL filter: given rules first, then a tree of path templates for each host.

A path is a list of segments; digits and long hexadecimal runs in them become `#`, and
what lies beyond DEPTH segments is one segment. The segments of a host form a tree. Level by
level, a node with more than MOST_CHILDREN different children is wide: its children with
less than 1 / MOST_CHILDREN of its URLs are values of a variable and become `*`; the others
stay. What is left are templates. Templates of one host that differ in their last literal
segment only are siblings; in the order of their share of blocked labels, neighbours whose
shares do not differ by the test of two proportions are merged. The labels are the verdicts
of the rules, or any labelled URLs. A merged template is rejected if it has at least
LEAST_LABELLED labels and its purity, the share of blocked ones smoothed towards that of
the host, itself smoothed towards that of all, reaches REJECT.

All of it is grouping and joining with built-in functions. URLs are counted by host and
shape before anything else, so a host with a third of all rows costs its different shapes.
Nodes that are not wide have at most MOST_CHILDREN children, and so have the lists of
siblings; a wide node is one row, joined to its shapes.

Defined cases: a URL that is NULL or has no `://` has an empty host and an empty path, which
is a host of its own without rules. Without any label nothing is rejected. Repeated URLs
and ids are judged row by row and all count. A rule without a path, or the same rule with two
verdicts, fits as written; of fitting rules of one length the greater in text order wins.
An empty table gives no rows. A column of the input that has the name of one of the result
is kept as `<name>_given`. Very long URLs cost their length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import clear_of, stage

DEPTH = 6
MOST_CHILDREN = 20
LIKENESS_Z = 1.96
PRIOR_WEIGHT = 2.0
LEAST_LABELLED = 5
REJECT = 0.9
ALLOW, BLOCK = "allow", "block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HOST, _PATH = r"^[^/?#]*", r"^[^/?#]*([^?#]*)"
_HEX, _DIGITS = "[0-9a-fA-F-]{16,}", "[0-9]+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (F.coalesce(F.translate(F.regexp_extract(rest, _HOST, 0), _UPPER, _LOWER), F.lit("")),
            F.coalesce(F.regexp_extract(rest, _PATH, 1), F.lit("")))


def path_shape(path: Column) -> Column:
    """The segments of a path with digits and long hexadecimal runs as `#`."""
    segments = F.split(path, "/", -1)
    segments = F.when(path == "", F.array().cast("array<string>")).otherwise(F.slice(segments, 2, F.size(segments)))
    tail = F.array(F.array_join(F.slice(segments, DEPTH, F.size(segments)), "/"))
    segments = F.when(F.size(segments) > DEPTH, F.concat(F.slice(segments, 1, DEPTH - 1), tail)).otherwise(segments)
    return F.transform(segments, lambda s: F.regexp_replace(F.regexp_replace(s, _HEX, "#"), _DIGITS, "#"))


def with_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add `rule` and `rule_verdict` of the longest of `rules` (rule_host, rule_path, rule_verdict) that fits.

    Rules meet the distinct hosts by every suffix of these; a host then carries its rules to its URLs.
    """
    parts = F.split("host", r"\.", -1)
    suffix = F.explode(F.transform(
        F.sequence(F.lit(1), F.size("parts")),
        lambda i: F.array_join(F.slice("parts", i, F.size("parts")), ".")))
    hosts = urls.select("host").where("host <> ''").distinct().withColumn("parts", parts).select(
        "host", suffix.alias("rule_host"))
    # A struct orders by the length of a rule, then by the rule.
    rule = F.concat("rule_host", "rule_path")
    fitting = hosts.join(rules, "rule_host").groupBy("host").agg(F.collect_list(F.struct(
        F.length(rule).alias("length"), rule.alias("rule"), "rule_verdict", "rule_path")).alias("_rules"))
    best = F.array_max(F.filter("_rules", lambda r: F.startswith(F.col("path"), r["rule_path"])))
    return urls.join(fitting, "host", "left").withColumn("_best", best).select(
        *urls.columns, F.col("_best.rule").alias("rule"), F.col("_best.rule_verdict").alias("rule_verdict"))


def templates(shapes: DataFrame) -> DataFrame:
    """Add `template` to `shapes` (host, shape, n, ...): the shape with the variable segments of its tree as `*`.

    `shapes` should be staged; it has a row for each shape of a host, counted by `n`.
    """
    tree = shapes.withColumn("template", F.col("shape"))
    depth = shapes.agg(F.max(F.size("shape"))).first()[0] or 0
    for level in range(1, depth + 1):
        tree = tree.withColumns({
            "_prefix": F.slice("template", 1, level - 1),
            "_segment": F.when(F.size("template") >= level, F.get("template", F.lit(level - 1)))})
        # A path that ends above this level is no child.
        children = stage(tree.where("_segment IS NOT NULL").groupBy("host", "_prefix", "_segment").agg(
            F.sum("n").alias("_n")), "children")
        wide = children.groupBy("host", "_prefix").agg(F.count("*").alias("_kinds"), F.sum("_n").alias("_total")).where(
            F.col("_kinds") > MOST_CHILDREN).drop("_kinds")
        large = children.join(wide, ["host", "_prefix"]).where(F.col("_n") * MOST_CHILDREN >= F.col("_total"))
        kept = wide.join(large.groupBy("host", "_prefix").agg(F.collect_list("_segment").alias("_kept")),
                         ["host", "_prefix"], "left")
        kept = kept.select("host", "_prefix", F.coalesce("_kept", F.array().cast("array<string>")).alias("_kept"))
        variable = F.col("_kept").isNotNull() & F.col("_segment").isNotNull() & ~F.array_contains("_kept", F.col("_segment"))
        general = F.concat("_prefix", F.array(F.lit("*")), F.slice("template", level + 1, DEPTH))
        tree = tree.join(kept, ["host", "_prefix"], "left").withColumn(
            "template", F.when(variable, general).otherwise(F.col("template"))).select(*shapes.columns, "template")
        tree = stage(tree, "tree")
    return tree


def _literal_place(template: Column) -> Column:
    """The place (from 1) of the last segment without `#` and `*`, 0 without any."""
    places = F.transform(template, lambda s, i: F.when(
        (s != "") & ~F.contains(s, F.lit("#")) & ~F.contains(s, F.lit("*")), i + 1).otherwise(0))
    return F.coalesce(F.array_max(places), F.lit(0))


def merged(tree: DataFrame) -> DataFrame:
    """(host, template, merged, labelled, blocked): templates with their name and counts after merging siblings."""
    counted = tree.groupBy("host", "template").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    place = _literal_place(F.col("template"))
    counted = counted.withColumn("_at", place).withColumns({
        "_member": F.when(F.col("_at") > 0, F.get("template", F.col("_at") - 1)).otherwise(""),
        "_family": F.when(F.col("_at") > 0, F.concat(
            F.slice("template", 1, F.greatest(F.col("_at") - 1, F.lit(0))), F.array(F.lit("{}")),
            F.slice("template", F.col("_at") + 1, DEPTH))).otherwise(F.col("template")),
        "_share": F.when(F.col("labelled") > 0, F.col("blocked") / F.col("labelled"))})
    order = Window.partitionBy("host", "_family").orderBy("_share", "_member")
    n, b = F.col("labelled").cast("double"), F.col("blocked").cast("double")
    n0, b0 = F.lag(n).over(order), F.lag(b).over(order)
    pooled = (b + b0) / (n + n0)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.nullif(n, F.lit(0.0)) + 1 / F.nullif(n0, F.lit(0.0))))
    apart = F.when((n > 0) & (n0 > 0), F.abs(b / n - b0 / n0) > LIKENESS_Z * error)
    # Members without labels come first and are alike.
    new = F.when((n == 0) & (n0 == 0), 0).otherwise(F.coalesce(apart, F.lit(True)).cast("int"))
    grouped = counted.withColumn("_new", new).withColumn("_cluster", F.sum("_new").over(order))
    group = Window.partitionBy("host", "_family", "_cluster")
    names = F.array_join(F.sort_array(F.collect_set("_member").over(group)), "|")
    name = F.when(F.col("_at") > 0, F.transform("_family", lambda s: F.when(
        s == "{}", F.when(F.contains(names, F.lit("|")), F.concat(F.lit("{"), names, F.lit("}"))).otherwise(names))
        .otherwise(s))).otherwise(F.col("template"))
    return grouped.select(
        "host", "template", F.concat(F.when(F.size("template") > 0, "/").otherwise(""), F.array_join(name, "/")).alias("merged"),
        F.sum("labelled").over(group).alias("labelled"), F.sum("blocked").over(group).alias("blocked"))


def template_verdicts(urls: DataFrame) -> DataFrame:
    """(host, shape, template, purity, rejected) of every shape of `urls` (host, shape, label).

    `label` is 'block', 'allow' or NULL for a URL without a label.
    """
    shapes = stage(urls.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.count_if(F.col("label") == BLOCK).alias("blocked")),
        "shapes")
    labelled, blocked = shapes.agg(F.sum("labelled"), F.sum("blocked")).first()
    prior = (blocked / labelled) if labelled else 0.0
    tree = templates(shapes)

    def smoothed(share: Column | float) -> Column:
        return (F.col("blocked") + PRIOR_WEIGHT * share) / (F.col("labelled") + PRIOR_WEIGHT)

    hosts = shapes.groupBy("host").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    hosts = hosts.select("host", smoothed(F.lit(prior)).alias("_host_share"))
    judged = merged(tree).join(hosts, "host").withColumn("purity", smoothed(F.col("_host_share"))).select(
        "host", "template", "merged", "purity",
        ((F.col("labelled") >= LEAST_LABELLED) & (F.col("purity") >= REJECT)).alias("rejected"))
    return tree.select("host", "shape", "template").join(judged, ["host", "template"]).select(
        "host", "shape", F.col("merged").alias("template"), "purity", "rejected")


def judge(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add host, path, rule, verdict, template and purity to `urls`; the verdicts of the rules are the labels."""
    host, path = host_and_path(F.col(f"`{url}`"))
    kept = clear_of(urls, "host", "path", "rule", "verdict", "template", "purity").columns
    row = F.struct(*[F.col(f"`{given}`").alias(name) for given, name in zip(urls.columns, kept)])
    parsed = urls.select(row.alias("_row"), host.alias("host"), path.alias("path"))
    parsed = stage(with_rule(parsed.withColumn("shape", path_shape(F.col("path"))), rules), "urls")
    verdicts = template_verdicts(parsed.select("host", "shape", F.col("rule_verdict").alias("label")))
    method = F.when(F.col("rejected"), BLOCK).otherwise(ALLOW)
    return parsed.join(verdicts, ["host", "shape"], "left").select(
        "_row.*", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"), "template", "purity")


# The rules of the registered query.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


def op12_url_filter(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    table = pages.sparkSession.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")
    return judge(pages.select("page_id", "url"), table).drop("url")


def _sql() -> str:
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    ctes = [f"""rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS u
                         FROM pages)""",
            f"""parsed AS (SELECT page_id, translate(regexp_extract(u, '{_HOST}'), '{_UPPER}', '{_LOWER}') AS host,
                                  regexp_extract(u, '{_PATH}', 1) AS path FROM rest)""",
            f"rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules})",
            "numbered AS (SELECT *, row_number() OVER () AS r FROM parsed)",
            """fits AS (SELECT r, rule_host || rule_path AS rule, rule_verdict FROM numbered JOIN rules
                   ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
                   QUALIFY row_number() OVER (PARTITION BY r ORDER BY len(rule_host || rule_path) DESC, rule DESC) = 1)""",
            "cut AS (SELECT *, CASE WHEN path = '' THEN [] ELSE string_split(path, '/')[2:] END AS s FROM numbered)",
            f"""urls AS (SELECT cut.r, page_id, host, path, rule, rule_verdict,
                            [regexp_replace(regexp_replace(x, '{_HEX}', '#', 'g'), '{_DIGITS}', '#', 'g') FOR x IN
                             CASE WHEN len(s) > {DEPTH} THEN list_concat(s[1:{DEPTH - 1}], [array_to_string(s[{DEPTH}:], '/')])
                                  ELSE s END] AS shape
                     FROM cut LEFT JOIN fits ON cut.r = fits.r)""",
            f"""tree0 AS (SELECT host, shape, shape AS template, COUNT(*) AS n, COUNT(rule_verdict) AS labelled,
                             COUNT(*) FILTER (rule_verdict = '{BLOCK}') AS blocked FROM urls GROUP BY 1, 2)"""]
    for level in range(1, DEPTH + 1):
        ctes += [
            f"""children{level} AS (SELECT host, template[1:{level - 1}] AS prefix, template[{level}] AS segment, SUM(n) AS c
                    FROM tree{level - 1} WHERE len(template) >= {level} GROUP BY 1, 2, 3)""",
            f"""wide{level} AS (SELECT host, prefix, SUM(c) AS total FROM children{level} GROUP BY 1, 2
                    HAVING COUNT(*) > {MOST_CHILDREN})""",
            f"""variable{level} AS (SELECT c.host, c.prefix, segment FROM children{level} c JOIN wide{level} w
                    ON c.host = w.host AND c.prefix = w.prefix WHERE c * {MOST_CHILDREN} < total)""",
            f"""tree{level} AS (SELECT t.host, shape, n, labelled, blocked, CASE WHEN v.segment IS NULL THEN template
                    ELSE list_concat(template[1:{level - 1}], ['*'], template[{level + 1}:]) END AS template
                    FROM tree{level - 1} t LEFT JOIN variable{level} v ON t.host = v.host AND len(template) >= {level}
                        AND template[1:{level - 1}] = v.prefix AND template[{level}] = v.segment)"""]
    ctes += [
        f"counted AS (SELECT host, template, SUM(labelled) AS n, SUM(blocked) AS b FROM tree{DEPTH} GROUP BY 1, 2)",
        """placed AS (SELECT *, COALESCE(list_max([CASE WHEN x.s <> '' AND NOT contains(x.s, '#') AND NOT contains(x.s, '*')
                          THEN x.i ELSE 0 END FOR x IN list_transform(template, lambda s, i: {'s': s, 'i': i})]), 0) AS pos
                      FROM counted)""",
        """families AS (SELECT *, CASE WHEN pos > 0 THEN template[pos] ELSE '' END AS member, CASE WHEN pos > 0 THEN
                          list_concat(template[1:pos - 1], ['{}'], template[pos + 1:]) ELSE template END AS family,
                          CASE WHEN n > 0 THEN CAST(b AS DOUBLE) / n END AS rate FROM placed)""",
        """neighbours AS (SELECT *, lag(n) OVER w AS n0, lag(b) OVER w AS b0 FROM families
                          WINDOW w AS (PARTITION BY host, family ORDER BY rate NULLS FIRST, member))""",
        f"""steps AS (SELECT *, CASE WHEN n = 0 AND n0 = 0 THEN 0 WHEN n > 0 AND n0 > 0 THEN
                          CAST(abs(CAST(b AS DOUBLE) / n - CAST(b0 AS DOUBLE) / n0) > {LIKENESS_Z} * sqrt(
                              (CAST(b + b0 AS DOUBLE) / (n + n0)) * (1 - CAST(b + b0 AS DOUBLE) / (n + n0))
                              * (1 / CAST(n AS DOUBLE) + 1 / CAST(n0 AS DOUBLE))) AS INTEGER)
                          ELSE 1 END AS step FROM neighbours)""",
        """clusters AS (SELECT *, SUM(step) OVER (PARTITION BY host, family ORDER BY rate NULLS FIRST, member) AS cluster
                        FROM steps)""",
        """groups AS (SELECT host, family, cluster, SUM(n) AS n, SUM(b) AS b,
                             string_agg(DISTINCT member, '|' ORDER BY member) AS names FROM clusters GROUP BY 1, 2, 3)""",
        "overall AS (SELECT COALESCE(CAST(SUM(b) AS DOUBLE) / NULLIF(SUM(n), 0), 0) AS prior FROM counted)",
        f"""hosts AS (SELECT host, (SUM(b) + {PRIOR_WEIGHT} * prior) / (SUM(n) + {PRIOR_WEIGHT}) AS share
                      FROM counted, overall GROUP BY host, prior)""",
        f"""judged AS (SELECT c.host, c.template, g.n, (g.b + {PRIOR_WEIGHT} * share) / (g.n + {PRIOR_WEIGHT}) AS purity,
                          CASE WHEN len(c.template) > 0 THEN '/' ELSE '' END || COALESCE(array_to_string(CASE WHEN pos > 0 THEN
                              [CASE WHEN x = '{{}}' THEN CASE WHEN contains(names, '|') THEN '{{' || names || '}}' ELSE names END
                                    ELSE x END FOR x IN c.family] ELSE c.template END, '/'), '') AS merged
                       FROM clusters c JOIN groups g ON c.host = g.host AND c.family = g.family AND c.cluster = g.cluster
                       JOIN hosts h ON h.host = c.host)"""]
    return f"""WITH {', '.join(ctes)}
        SELECT page_id, u.host, path, rule, COALESCE(rule_verdict, CASE WHEN j.n >= {LEAST_LABELLED} AND purity >= {REJECT}
                   THEN '{BLOCK}' ELSE '{ALLOW}' END) AS verdict, merged AS template, purity
        FROM urls u JOIN tree{DEPTH} t ON u.host = t.host AND u.shape = t.shape
        JOIN judged j ON j.host = t.host AND j.template = t.template"""


OP12_SQL = _sql()
