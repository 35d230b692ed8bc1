"""URL filters: path rules, and a tree of path templates per host.

Explicit rules come first: a rule fits its host and all subdomains if the
url's path starts with the rule's path, and the longest fitting rule decides.

Other urls are judged by the tree of path templates of their host.  The
segments of a path are generalised by shape (numbers, long hexadecimal
strings); then, level by level from the root, sibling branches that look alike
(the same children below or too many to tell, the same smoothed share of
blocked pages among the labelled ones) are merged into one wildcard.  A template is rejected if the share of blocked pages among
its labelled ones, smoothed towards one half, is high enough.  Labelled pages
are those the explicit rules decide, unless a label column is given.

Only built-in expressions are used.  Pages are first counted by host and
generalised path, so a host with a third of all pages shrinks inside each
task; the levels work on those counts.

Defined cases: a null url or one without ``://`` has an empty host and path and
is allowed unless a rule says otherwise; repeated rows get equal verdicts;
below the first ``DEPTH`` segments a branch is only followed if it has enough
blocked pages for a template in it to be rejected, else its rest is one
template; an empty table gives an empty result.  Results are one struct column.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import free_name, free_prefix
from tallyframe.llm.decontaminate import lower_az
from tallyframe.operators.joins import checked_broadcast
from tallyframe.session import ensure_checkpoint_dir

DEPTH = 3
MAX_CHILDREN = 16
PRIOR_WEIGHT = 4.0
REJECT_FROM = 0.75
# Fewer blocked pages than this never reach REJECT_FROM, whatever the other pages are.
NEEDED = PRIOR_WEIGHT * (REJECT_FROM - 0.5) / (1.0 - REJECT_FROM)
REST = "**"
TREE = ("host", "shape", "template", "n", "blocked", "labelled", "at")


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query: host, path, verdict.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    return lower_az(F.regexp_extract(after, r"^[^/?#]*", 0)), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def path_shape(path: Column) -> Column:
    """The generalised segments of a path."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike(r"^[0-9a-fA-F-]{16,}$"), F.lit("{hex}")).otherwise(
        F.regexp_replace(s, r"[0-9]+", "{n}")))


def _purity(blocked: Column, labelled: Column) -> Column:
    return (blocked + F.lit(PRIOR_WEIGHT * 0.5)) / (labelled + F.lit(PRIOR_WEIGHT))


def _merge_level(tree: DataFrame, level: Column) -> DataFrame:
    """``tree`` with the segments at one level made wildcards or merged.

    ``tree``: (host, shape, template, n, blocked, labelled, at), where
    ``template`` already is final above this level; rows whose level is null
    are final.
    """
    here, below = F.get("template", level), F.coalesce(F.get("template", level + 1), F.lit(""))
    prefix = F.array_join(F.slice("template", F.lit(1), level), "/")
    nodes = tree.filter(here.isNotNull() & (here != REST)).select(
        "host", prefix.alias("prefix"), here.alias("child"), below.alias("below"), "n", "blocked", "labelled"
    )
    # Children below a node, first made distinct so that the collected list
    # holds shapes, not pages; beyond MAX_CHILDREN they are alike anyhow.
    lists = nodes.groupBy("host", "prefix", "child", "below").agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"))
    many = F.count(F.lit(1)) > MAX_CHILDREN
    branches = lists.groupBy("host", "prefix", "child").agg(
        F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"),
        F.when(many, F.lit("*")).otherwise(F.hex(F.sum(F.xxhash64("below").bitwiseAND(0xFFFFFFFFFFFF)))).alias("children"),
    )
    look = F.concat_ws(
        ":", "children",
        F.when(F.col("labelled") == 0, F.lit("none")).otherwise(F.round(4 * _purity(F.col("blocked"), F.col("labelled"))).cast("string")),
    )
    branches = branches.withColumn("look", look)
    # Branches that look alike form one wildcard, named by its first child, however many they are.
    alike = branches.groupBy("host", "prefix", "look").agg(F.count(F.lit(1)).alias("members"), F.min("child").alias("first"))
    named = branches.select("host", "prefix", "child", "look").join(alike, ["host", "prefix", "look"]).select(
        F.col("host").alias("h"), F.col("prefix").alias("p"), F.col("child").alias("c"),
        F.when(F.col("members") > 1, F.concat(F.lit("*~"), F.col("first"))).otherwise(F.col("child")).alias("name"),
    )
    same = (F.col("host") == F.col("h")) & (prefix == F.col("p")) & (here == F.col("c"))
    joined = tree.join(named, same, "left")
    renamed = F.transform("template", lambda s, i: F.when((i == level) & F.col("name").isNotNull(), F.col("name")).otherwise(s))
    return joined.withColumn("template", renamed).select(*TREE)


def _next_branch(tree: DataFrame) -> DataFrame:
    """``tree`` with ``at`` moved to the next segment in which templates of one prefix differ.

    ``at``: number of leading segments that are final.  It becomes null where
    the whole template is: nothing follows, or all templates below the prefix
    are one, or the prefix has too few blocked pages for any template below it
    to be rejected, so that the rest of it is REST.
    """
    is_open = F.col("at") < F.size("template")
    prefix = F.when(is_open, F.array_join(F.slice("template", F.lit(1), F.col("at")), "/"))
    groups = tree.filter(is_open).groupBy(F.col("host").alias("h"), prefix.alias("p")).agg(
        F.sum("blocked").alias("b"), F.min("template").alias("low"), F.max("template").alias("high"),
    )
    # What the least and the greatest template share at their start, all of them share.
    differ = F.array_position(F.zip_with("low", "high", lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
    groups = groups.select("h", "p", (F.col("b") < NEEDED).alias("rest"), F.when(differ > 0, differ - 1).alias("next"))
    joined = tree.join(groups, (F.col("host") == F.col("h")) & (prefix == F.col("p")), "left")
    cut = F.concat(F.slice("template", F.lit(1), F.col("at")), F.array(F.lit(REST)))
    return joined.withColumn("template", F.when(F.col("rest"), cut).otherwise(F.col("template"))).withColumn(
        "at", F.when(~F.col("rest"), F.col("next"))).select(*TREE)


def template_table(pages: DataFrame, host: str, shape: str, verdict: str) -> DataFrame:
    """``(host, shape, template, rejected, purity, n)`` for every generalised path.

    Checkpointed after each level: a level reads the one before it twice.
    Below DEPTH, a level is the next place where templates of one prefix differ.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    known = F.col(verdict).isNotNull()
    tree = pages.groupBy(F.col(host).alias("host"), F.col(shape).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col(verdict) == "block").cast("bigint")).alias("blocked"),
        F.sum(known.cast("bigint")).alias("labelled"),
    ).withColumn("blocked", F.coalesce("blocked", F.lit(0))).withColumn("template", F.col("shape"))
    tree = tree.withColumn("at", F.lit(DEPTH)).select(*TREE).checkpoint()
    for level in range(DEPTH):
        tree = _merge_level(tree, F.lit(level)).checkpoint()
    while not tree.filter(F.col("at") < F.size("template")).isEmpty():
        tree = _next_branch(tree).checkpoint()
        if not tree.filter(F.col("at").isNotNull()).isEmpty():
            tree = _merge_level(tree, F.col("at")).withColumn("at", F.col("at") + 1).checkpoint()
    totals = tree.groupBy("host", "template").agg(
        F.sum("n").alias("n"), F.sum("blocked").alias("b"), F.sum("labelled").alias("l")
    ).withColumn("purity", _purity(F.col("b"), F.col("l")))
    judged = totals.select("host", "template", "purity", "n", (F.col("purity") >= REJECT_FROM).alias("rejected"))
    return tree.select("host", "shape", "template").join(judged, ["host", "template"])


def with_verdicts(pages: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES, label: str | None = None) -> tuple[DataFrame, str]:
    """``pages`` with a struct ``{host, path, rule, template, purity, verdict}``; returns the frame and the struct's name.

    ``label``: a column with ``block``, ``allow`` or null that the templates
    learn from; by default the verdicts of the rules.
    """
    name, p = free_name(pages, "url_verdict"), free_prefix(pages, "_url_")
    host, path = url_parts(F.col(url))
    rows = pages.withColumns({f"{p}host": host, f"{p}path": path})
    rule, verdict = fitting_rule(F.col(f"{p}host"), F.col(f"{p}path"), rules)
    rows = rows.withColumns({
        f"{p}rule": rule, f"{p}verdict": verdict, f"{p}shape": F.concat_ws("/", path_shape(F.col(f"{p}path"))),
    })
    shapes = rows.withColumn(f"{p}parts", path_shape(F.col(f"{p}path")))
    table = template_table(shapes, f"{p}host", f"{p}parts", label or f"{p}verdict").select(
        F.col("host").alias(f"{p}h"), F.concat_ws("/", "shape").alias(f"{p}s"),
        F.concat(F.lit("/"), F.concat_ws("/", "template")).alias(f"{p}template"),
        F.col("purity").alias(f"{p}purity"), F.col("rejected").alias(f"{p}rejected"),
    ).checkpoint()
    same = (F.col(f"{p}host") == F.col(f"{p}h")) & (F.col(f"{p}shape") == F.col(f"{p}s"))
    joined = rows.join(checked_broadcast(table), same, "left")
    judged = F.when(F.col(f"{p}rejected"), F.lit("block")).otherwise(F.lit("allow"))
    info = F.struct(
        F.col(f"{p}host").alias("host"), F.col(f"{p}path").alias("path"), F.col(f"{p}rule").alias("rule"),
        F.col(f"{p}template").alias("template"), F.col(f"{p}purity").alias("purity"),
        F.coalesce(f"{p}verdict", judged).alias("verdict"),
    )
    return joined.select(*[F.col(f"`{c}`") for c in pages.columns], info.alias(name)), name
