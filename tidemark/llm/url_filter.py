"""URL filters with redirect equivalence, DataFrame functions only.

A page's own rule decides first: of the rules that fit its host (or a parent domain) and whose path is a
prefix of its path, the longest wins. URLs tied by redirects (meta refresh), canonical links or given
extra links are aliases of one another: their classes are connected components, and a class with a blocked
member blocks its members that no rule fits. A page with its own allow rule stays allowed.

Edge cases: a null url or one without ``://`` has empty host and path, no rule, and is allowed; urls that differ only in the
case of scheme and host, in dot segments, in a missing root path or in their fragment are one node; links are resolved
against their page (folder, root, host, query-only, fragment-only); of two rules of equal length on one url the
allowing one wins; very long pages are searched whole; repeated rows are one node and each gets its verdict; extra
columns are ignored whatever their names; an empty table gives an empty result.
"""
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checked, materialize
from tidemark.llm.components import components

#: (verdict, host, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"^(?s)(.*?)://([^/?#]*)([^?#]*)"
_CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 2), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 3), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """(rule_host, rule_path, rule_verdict) of a list of rules; a deployment may pass a stored table instead."""
    rows = F.array(*[F.struct(F.lit(h).alias("rule_host"), F.lit(p).alias("rule_path"), F.lit(v).alias("rule_verdict")) for v, h, p in rules])
    return spark.range(1).select(F.inline(rows))


def own_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, host, path, rule, rule_verdict) for distinct urls: each parent domain of the host meets the
    rules by equality, then the path prefix is tested and the longest rule is kept."""
    parts = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rule = F.concat("rule_host", "rule_path")
    best = F.struct(F.length(rule).alias("length"), (F.col("rule_verdict") == "allow").alias("allows"), rule.alias("rule"), F.col("rule_verdict").alias("verdict"))
    fits = (parts.where("host <> ''").select("url", "path", F.explode(parents).alias("rule_host"))
            .join(rules, "rule_host").where(F.startswith("path", "rule_path")).groupBy("url").agg(F.max(best).alias("best")))
    return parts.join(fits, "url", "left").select("url", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def _without_dots(path: Column) -> Column:
    """A path that starts with a slash, its ``.`` and ``..`` segments resolved."""
    steps = F.slice(F.split(path, "/"), 2, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(1)))
    walked = F.aggregate(steps, F.expr("cast(array() AS array<string>)"), lambda so_far, step: F.when(step == ".", so_far)
                         .when(step == "..", F.slice(so_far, 1, F.greatest(F.size(so_far) - 1, F.lit(0)))).otherwise(F.concat(so_far, F.array(step))))
    ends = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.lit("/"), F.array_join(ends, "/"))).otherwise(path)


def resource(url: Column) -> Column:
    """The url as a node: scheme and host in lower case, dots resolved, no fragment. One without ``://`` only loses its fragment."""
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    whole = F.concat(F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER), F.lit("://"), host_of(url), _without_dots(path), F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1))
    return F.when(F.contains(url, F.lit("://")), whole).otherwise(F.regexp_replace(url, r"(?s)#.*$", ""))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(url, target) of the canonical links and meta refreshes in the pages; targets are made absolute."""
    found = F.array_union(F.transform(F.regexp_extract_all(F.col(html_col), F.lit(_CANONICAL), 0), lambda tag: F.regexp_extract(tag, _HREF, 1)),
                          F.transform(F.regexp_extract_all(F.col(html_col), F.lit(_REFRESH), 0), lambda tag: F.regexp_extract(tag, _TARGET, 1)))
    base, link = F.col(url_col), F.replace(F.col("link"), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(base, _URL, 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(base, _URL, 2))
    folder = F.concat(root, F.regexp_extract(F.concat(path_of(base), F.when(path_of(base) == "", "/").otherwise("")), r"(?s)^(.*/)", 1))
    absolute = (F.when(F.rlike(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), link).when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
                .when(F.startswith(link, F.lit("/")), F.concat(root, link)).when(F.startswith(link, F.lit("?")), F.concat(root, path_of(base), link))
                .when(F.startswith(link, F.lit("#")), base).otherwise(F.concat(folder, link)))
    return (pages.where(F.col(html_col).isNotNull() & F.contains(base, F.lit("://")))
            .select(base, F.explode(found).alias("link")).where("link <> ''").select(resource(base).alias("url"), resource(absolute).alias("target"))
            .where("url <> target"))


def url_filter(pages: DataFrame, rules: DataFrame | None = None, links: DataFrame | None = None, id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, host, path, rule, verdict per input row. ``links`` adds (url, target) alias pairs, such as a redirect log."""
    spark = pages.sparkSession
    rules = rule_table(spark) if rules is None else rules
    ties = page_links(pages, url_col, html_col)
    if links is not None:
        ties = ties.unionByName(links.select(resource(F.col("url")).alias("url"), resource(F.col("target")).alias("target")))
    classes = materialize(components(ties, "url", "target"), "aliases")
    blocked = materialize(own_rule(classes.select(F.col("node").alias("url")), rules).where("rule_verdict = 'block'").select(F.col("url").alias("node"))
                          .join(classes, "node").select("root").distinct(), "blocked")
    aliases = materialize(classes.join(blocked, "root", "left_semi").select(F.col("node").alias("alias")), "blocked_aliases")
    base = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), base.alias("url"))
    judged = own_rule(rows.where("url is not null").select("url").distinct(), rules).withColumnRenamed("url", "judged")
    return (rows.join(judged, F.col("url") == F.col("judged"), "left")
            .join(checked(aliases), resource(F.col("url")) == F.col("alias"), "left")
            .select("page_id", "url", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule",
                    F.coalesce("rule_verdict", F.when(F.col("alias").isNotNull(), "block"), F.lit("allow")).alias("verdict")))
