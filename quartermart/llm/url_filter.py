"""Operator 10: URL filter with redirect equivalence.

Rules name a host (and all its subdomains) and a path prefix; the longest rule
that fits decides. URLs tied by redirects (``meta refresh``) or canonical
links are aliases: their connected components are found by a distributed
algorithm, and a URL without a rule takes the decision of its aliases. A
URL's own rule always stands; among aliases an explicit allow goes before a
block; with neither, the URL is allowed.

Defined results: a null url or one without ``://`` has an empty host and path,
no rule, no alias, and is allowed; a null html has no links; repeated rows are
judged alike; an empty table gives an empty result; columns other than those
named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, write_table
from .components import connected_components


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct(name, verdict), else null."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in ordered]
    value = [F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")) for r in ordered]
    return reduce(lambda acc, x: acc.when(*x), list(zip(fits, value))[1:], F.when(fits[0], value[0]))


def links_of(html: Column) -> Column:
    """Targets, as written, of canonical links and of redirects by ``meta refresh``."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)(<(?:link|meta)\s[^<>]*+>)"), F.lit(1))
    canonical = F.filter(tags, lambda t: t.rlike(r"(?i)^<link\s") & t.rlike(r"(?i)\srel\s*=\s*[\"']?canonical[\"'\s/>]"))
    refresh = F.filter(tags, lambda t: t.rlike(r"(?i)^<meta\s") & t.rlike(r"(?i)\shttp-equiv\s*=\s*[\"']?refresh[\"'\s/>]"))
    href = F.transform(canonical, lambda t: F.regexp_extract(t, r"(?i)\shref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    to = F.transform(refresh, lambda t: F.regexp_extract(t, r"(?i)[\s;,]url\s*=\s*'?([^\"'\s>]+)", 1))
    return F.transform(F.filter(F.concat(href, to), lambda u: F.length(u) > 0), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))


def resolve(target: Column, url: Column) -> Column:
    """``target`` as an absolute URL, seen from ``url``."""
    origin = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"^(.*/)?", 0)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .when(target.startswith("?"), F.concat(origin, path_of(url), target))
            .when(target.rlike(r"^(#|[A-Za-z][A-Za-z0-9+.-]*:)"), F.lit(None))
            .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), target)))


def node_of(url: Column) -> Column:
    """What names a resource: host, path and query; null without a host."""
    rest = F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(F.lit("http://"), host_of(url), rest))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, component) for every row of ``pages``.

    ``component`` is the smallest URL among the aliases (null: no alias).
    """
    url = F.col("url")
    edges = write_table(pages.select(url, F.explode(links_of(F.col("html"))).alias("to"))
                        .select(node_of(url).alias("a"), node_of(resolve(F.col("to"), url)).alias("b"))
                        .where("a is not null and b is not null and a <> b").distinct(), "aliases")
    groups = connected_components(edges)
    groups = write_table(groups.withColumn("_verdict", rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]), "alias-groups")
    decided = groups.groupBy("component").agg(F.min("_verdict").alias("_inherited"))  # allow sorts before block
    aliases = groups.join(decided, "component").select(F.col("node").alias("_node"), "component", "_inherited")
    own = rule_of(F.col("host"), F.col("path"), rules)
    return (pages.select("page_id", "url").withColumns({"host": host_of(url), "path": path_of(url), "_node": node_of(url)})
            .join(aliases, "_node", "left").withColumn("_rule", own)
            .select("page_id", "url", "host", "path", F.col("_rule.name").alias("rule"),
                    F.coalesce(F.col("_rule.verdict"), F.col("_inherited"), F.lit("allow")).alias("verdict"), "component"))
