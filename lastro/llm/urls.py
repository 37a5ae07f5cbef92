"""URL filter: rules for hosts and paths, and a tree of path templates for the urls that no rule decides.

The tree of a host has one level for each path segment.  Segments that vary (digits, or many values with few urls
each) become ``*``; sibling branches whose labelled shares of blocked urls are statistically alike become ``+``.
What is left is a template.  Urls that a rule decides are its labels: a template is rejected when its smoothed
share of blocked urls is high, and its other urls go with it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.text import lower_ascii, text_of
from lastro.session import stored


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


@dataclass(frozen=True)
class Settings:
    """``depth``: levels of the tree, deeper segments share one template; ``children`` and ``per_child``: a node
    with that many children and fewer urls each varies; ``z``: shares less apart than this are alike; ``strength``
    and ``prior``: weight and share of the smoothing; ``reject``: smoothed share from which a template is rejected."""

    depth: int = 8
    children: int = 16
    per_child: float = 4.0
    z: float = 1.96
    strength: float = 4.0
    prior: float = 0.2
    reject: float = 0.6


_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(text_of(url), _PARTS, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(text_of(url), _PARTS, 2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Name and verdict of the longest rule that fits; null where none does."""
    found = F.lit(None).cast("struct<name: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _level(tree: DataFrame, level: int, s: Settings) -> DataFrame:
    """The tree with the segment at ``level`` added to each template."""
    tree = tree.withColumn("segment", F.get("segments", F.lit(level)))
    sums = [F.sum(c).alias(c) for c in ("n", "blocked", "labelled")]
    children = tree.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(*sums)
    children = stored(children, "url-children")
    nodes = children.groupBy("host", "template").agg(
        F.count("*").alias("kids"), F.sum("n").alias("all_n"), F.sum("blocked").alias("all_blocked"),
        F.sum("labelled").alias("all_labelled"),
    ).withColumnsRenamed({"host": "node_host", "template": "node"})
    at_node = (F.col("host") == F.col("node_host")) & (F.col("template") == F.col("node"))
    compared = children.join(nodes, at_node)
    share = F.col("all_blocked") / F.col("all_labelled")
    rest = F.col("all_labelled") - F.col("labelled")
    apart = F.abs(F.col("blocked") / F.col("labelled") - (F.col("all_blocked") - F.col("blocked")) / rest)
    alike = (F.col("labelled") > 0) & (rest > 0)
    alike &= F.when(alike, apart <= s.z * F.sqrt(share * (1 - share) * (1 / F.col("labelled") + 1 / rest))).otherwise(False)
    varies = F.col("segment").rlike("[0-9]") | (
        (F.col("kids") >= s.children) & (F.col("all_n") < s.per_child * F.col("kids"))
    )
    token = F.when(varies, F.lit("/*")).when(alike, F.lit("/+")).otherwise(F.concat(F.lit("/="), "segment"))
    named = stored(compared.select(
        F.col("host").alias("c_host"), F.col("template").alias("c_template"), F.col("segment").alias("c_segment"),
        token.alias("token"),
    ), "url-tokens")
    met = (F.col("host") == F.col("c_host")) & (F.col("template") == F.col("c_template")) & (F.col("segment") == F.col("c_segment"))
    grown = tree.join(named, met, "left").withColumn("template", F.concat("template", F.coalesce("token", F.lit(""))))
    return stored(grown.select("host", "path", "segments", "n", "blocked", "labelled", "template"), "url-tree")


def _templates(urls: DataFrame, s: Settings) -> DataFrame:
    """``host, path, n, blocked, labelled`` -> each host and path with its template."""
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    tree = stored(urls.withColumn("segments", segments).withColumn("template", F.lit("")), "url-tree")
    deepest = tree.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(deepest, s.depth)):
        tree = _level(tree, level, s)
    more = F.when(F.size("segments") > s.depth, F.lit("/**")).otherwise(F.lit(""))
    return tree.withColumn("template", F.concat("template", more))


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, settings: Settings = Settings(),
    id_column: str = "page_id", url_column: str = "url",
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (null where none fits), ``verdict`` and ``template``.

    The longest fitting rule decides; otherwise the page's template does, and urls of templates without labels are
    allowed.  A null url, or one without ``://``, has an empty host and path, which no rule fits.  Null ids and
    repeated rows get a row each; an empty table gives no rows.  Other columns are ignored.
    """
    split = pages.select(
        pages[id_column].alias("id"), host_of(pages[url_column]).alias("host"), path_of(pages[url_column]).alias("path")
    )
    ruled = split.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    urls = ruled.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("found.verdict") == "block", 1)).alias("blocked"),
        F.count("found").alias("labelled"),
    )
    templates = stored(_templates(urls, settings), "url-templates")
    purity = (F.sum("blocked") + settings.strength * settings.prior) / (F.sum("labelled") + settings.strength)
    rejected = templates.groupBy("host", "template").agg((purity >= settings.reject).alias("rejected"))
    rejected = rejected.withColumnsRenamed({"host": "t_host", "template": "t_template"})
    known = templates.join(rejected, (F.col("host") == F.col("t_host")) & (F.col("template") == F.col("t_template")))
    known = stored(known.select(
        F.col("host").alias("u_host"), F.col("path").alias("u_path"), "template", "rejected"
    ), "url-verdicts")
    judged = ruled.join(known, (F.col("host") == F.col("u_host")) & (F.col("path") == F.col("u_path")))
    own = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("id").alias(id_column), "host", "path", F.col("found.name").alias("rule"),
        F.coalesce(F.col("found.verdict"), own).alias("verdict"), "template",
    )
