"""URL filters by a tree of path templates.

Each host's paths form a tree of segments. Level by level, the branches of a node are generalised: a branch with fewer than `SUPPORT` pages
is a variable segment and becomes the wildcard, and so does a branch that is statistically like its siblings taken together. Two sides are alike
if none of these shares of their pages differs by more than Hoeffding's bound allows: paths that end here, one or two segments on,
distinct next segments, and, where both have labels, blocked ones among labelled ones. A node with fewer than `SUPPORT` pages is not divided: a tail
wildcard stands for the rest of its paths. So every wildcard comes from counts, not from how a segment is written, and paths may be of any depth.

With `cautious`, what is not known merges nothing: a branch is like its siblings only if both sides have enough pages for the bound to be below `GAP`, and
both or neither have labels; a rare branch whose segment stands at this depth on at least `SUPPORT` hosts is a fixed word (such as a language), not a variable;
and only templates with labels of their own are rejected.

A template (a leaf of the merged tree) is rejected if its share of blocked pages among labelled ones, smoothed towards its host's (itself smoothed
towards one half), is high. Labels come from rules that fix a verdict for hosts and path prefixes; a rule's own verdict always stands. Pages of a
host without any label have no evidence against them and are allowed.

Pages are counted per host and path before anything is dealt out by host, and each level is counted per branch first, so a hot host or a hot page is
few rows; a node with very many branches meets their totals in shares. Each level is one table in the shared folder. What grows with pages or hosts is sorted and merged,
never broadcast: a level's files are many times smaller than its rows, and Spark would go by the files. Defined cases: a null url or one without `://` has empty host and path; repeated
rows get equal verdicts; empty segments do not count; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import count
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import scratch
from millrace.operators.relational import salted_join


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))
SUPPORT, ALPHA, SMOOTHING, REJECT = 5, 0.05, 4.0, 0.7
#: Shares further apart than this must be told apart before branches may be called alike.
GAP = 0.5
ANY, TAIL = "*", "**"


def url_parts(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null where none does."""
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: (-len(r.name), r.name))
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


#: Of a branch: pages, labelled and blocked ones, and paths that end at its segment, one and two segments on.
_COUNTS = ("n", "labelled", "blocked", "end_0", "end_1", "end_2")


def _bound(of: Column, other: Column) -> Column:
    return math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / F.sqrt(of) + 1 / F.sqrt(other))


def _alike(hits: Column, of: Column, other_hits: Column, other: Column) -> Column:
    """Whether two shares are within Hoeffding's bound of each other; a side without rows says nothing."""
    return (of == 0) | (other == 0) | (F.abs(hits / of - other_hits / other) < _bound(of, other))


def _merged(cautious: bool) -> Column:
    """Whether a branch becomes the wildcard, from its own counts and those of all branches of its node (and how many hosts have its segment here)."""
    n, rest = F.col("n"), F.col("all_n") - F.col("n")
    like = [_alike(F.col(c), n, F.col(f"all_{c}") - F.col(c), rest) for c in ("end_0", "end_1", "end_2", "next")]
    like.append(_alike(F.col("blocked"), F.col("labelled"), F.col("all_blocked") - F.col("blocked"), F.col("all_labelled") - F.col("labelled")))
    rare, same = n < SUPPORT, reduce(Column.__and__, like)
    if cautious:
        rare &= F.col("hosts") < SUPPORT
        same &= ~(n < SUPPORT) & (rest > 0) & (_bound(n, rest) < GAP) & ((F.col("labelled") > 0) == (F.col("all_labelled") - F.col("labelled") > 0))
    return (F.col("siblings") > 1) & (rare | same)


def templates(pages: DataFrame, cautious: bool = False) -> DataFrame:
    """(host, path, template, labelled, blocked) from pages of (host, path, labelled, blocked); paths and templates are lists of segments."""
    spark, folder = pages.sparkSession, scratch(pages.sparkSession, "templates")
    paths = pages.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    tree = paths.select("*", F.array().cast("array<string>").alias("template"), F.col("path").alias("rest"), (F.size("path") == 0).alias("done"))
    columns = tree.columns
    for level in count():
        path = f"{folder}/level={level}"
        tree.write.parquet(path)
        at = spark.read.schema(tree.schema).parquet(path).filter("not done").withColumn("branch", F.col("rest")[0])
        if at.isEmpty():
            break
        ends = [F.sum(F.when(F.size("rest") == k + 1, F.col("n")).otherwise(0)).alias(f"end_{k}") for k in range(3)]
        following = at.groupBy("host", "template", "branch", F.try_element_at("rest", F.lit(2)).alias("following")).agg(*(F.sum(c).alias(c) for c in _COUNTS[:3]), *ends)
        branches = following.groupBy("host", "template", "branch").agg(*(F.sum(c).alias(c) for c in _COUNTS), F.count(F.lit(1)).alias("next"))
        nodes = branches.groupBy("host", "template").agg(F.count(F.lit(1)).alias("siblings"), *(F.sum(c).alias(f"all_{c}") for c in (*_COUNTS, "next")))
        # A node of few pages has a tail, cautiously only below its first segment, which may be a fixed word.
        few = (F.col("all_n") < SUPPORT) & (F.col("hosts") < SUPPORT if cautious else F.lit(True))
        name = F.when(few, TAIL).when(_merged(cautious), ANY).otherwise(F.col("branch"))
        if cautious:
            hosts = branches.select("host", "branch").distinct().groupBy("branch").agg(F.count(F.lit(1)).alias("hosts"))
            branches = salted_join(branches, hosts, "branch", "host")
        named = salted_join(branches, nodes, ["host", "template"], "branch").select("host", "template", "branch", name.alias("name"))
        grown = salted_join(at, named, ["host", "template", "branch"], "rest").withColumn("template", F.concat("template", F.array("name")))
        grown = grown.withColumn("rest", F.slice("rest", 2, F.greatest(F.size("rest"), F.lit(1))))
        tree = grown.withColumn("done", (F.col("name") == TAIL) | (F.size("rest") == 0)).select(columns)
    return spark.read.schema(tree.schema).parquet(*(f"{folder}/level={k}" for k in range(level + 1))).filter("done").select("host", "path", "template", "labelled", "blocked")


def rejected(tree: DataFrame, cautious: bool = False) -> DataFrame:
    """(host, template) of the templates whose smoothed share of blocked pages is at least `REJECT`; cautiously, of those with labels."""
    leaves = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    prior = hosts.select("host", ((F.col("b") + SMOOTHING / 2) / (F.col("l") + SMOOTHING)).alias("prior"))
    purity = (F.col("blocked") + SMOOTHING * F.col("prior")) / (F.col("labelled") + SMOOTHING)
    judged = leaves.filter("labelled > 0") if cautious else leaves
    return judged.join(prior.hint("merge"), "host").filter(purity >= REJECT).select("host", "template")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url", cautious: bool = False) -> DataFrame:
    """page_id, host, path, rule, verdict and template of every row of `pages`."""
    host, path = url_parts(F.col(url))
    read = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    read = read.withColumn("fixed", rule_of(F.col("host"), F.col("path"), rules)).withColumn("steps", segments(F.col("path")))
    seen = read.select("host", F.col("steps").alias("path"), F.col("fixed").isNotNull().cast("long").alias("labelled"), F.coalesce((F.col("fixed.verdict") == "block").cast("long"), F.lit(0)).alias("blocked"))
    tree = templates(seen, cautious)
    verdicts = tree.select("host", F.col("path").alias("steps"), "template").join(rejected(tree, cautious).withColumn("bad", F.lit(True)), ["host", "template"], "left")
    out = read.join(verdicts.hint("merge"), ["host", "steps"], "left")
    return out.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce(F.col("fixed.verdict"), F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
    )
