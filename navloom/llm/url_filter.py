"""URL filters by rules and a tree of path templates, in DataFrame operations only.

A rule decides the urls of its host and all subdomains whose path starts with the rule's.
What the rules decide labels the tree that judges the rest. Per host, paths become
templates segment by segment, to their last segment: runs of digits are wildcards, and so
are segments of a branching with many rare values. The other labelled branches of a
branching are put in order of their smoothed share of blocked pages, and neighbours that a
test of two shares does not tell apart are merged. A template is rejected by its share of
blocked pages, smoothed towards that of the same first segment on all hosts, which is
smoothed towards that of all labelled pages.

The tree grows in rounds. In a round every group of paths under one template goes to its
next branching, past the segments that all of them share, so there are as many rounds as
the longest path has branchings; a path alone under its template is done.

All counts are sums over whole tables that combine before they shuffle: pages are first
counted per host and path with digits replaced, and only those counts go into the tree.
The branch a page belongs to is looked up by its full shape; hosts with many pages have
their rows in one key only as far as shapes agree, and adaptive execution splits such keys.
Windows order only branches that are not rare, of which a branching has at most
``max(VALUES, 1 / SHARE)``.

Null urls and urls without ``://`` have an empty host and path, are under no rule, and
form the template of the empty path. Rows may repeat, urls may be of any length; columns
other than the two named ones are not carried along; tables without rows give empty
results. Without any labelled page every page is allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.llm.common import picked, stored

#: Verdict, host and path of each rule.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: A segment is variable if its branching has more values and it has a smaller share.
VALUES, SHARE = 16, 0.05
#: Standard errors within which branches are the same; weight of what is smoothed towards.
APART, WEIGHT = 2.0, 4.0
#: Smoothed share of blocked pages from which a template is rejected.
REJECT = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _by_rules(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    texts, verdicts = [], []
    for verdict, of_host, of_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1])):
        fits = ((host == of_host) | F.endswith(host, F.lit("." + of_host))) & F.startswith(path, F.lit(of_path))
        texts.append(F.when(fits, of_host + of_path))
        verdicts.append(F.when(fits, verdict))
    return F.coalesce(*texts), F.coalesce(*verdicts)


def _advanced(active: DataFrame) -> DataFrame:
    """``rest`` without the segments that all paths of a group share; null where done."""
    ends = active.groupBy("host", "done").agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
    # Of arrays in order, what the first and the last share all share.
    differs = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), False)
    ends = ends.select("host", "done", F.when(differs > 0, differs - 1).cast("int").alias("shared"))
    moved = active.join(ends, ["host", "done"])
    more = F.col("shared").isNotNull() & (F.size("rest") > F.col("shared"))
    return moved.withColumns({
        "done": F.when(more, F.concat("done", F.slice("rest", F.lit(1), "shared"))).otherwise(F.concat("done", "rest")),
        "rest": F.when(more, F.slice("rest", F.col("shared") + 1, F.size("rest"))),
    }).drop("shared")


def _branches(active: DataFrame) -> DataFrame:
    """``host, done, own, new``: the template segment of each first segment of ``rest``."""
    counts = ("n", "labelled", "blocked")
    above = ["host", "done"]
    branch = active.groupBy(*above, F.col("rest")[0].alias("own")).agg(*[F.sum(c).alias(c) for c in counts])
    whole = branch.groupBy(*above).agg(F.count("*").alias("values"), *[F.sum(c).alias(f"all_{c}") for c in counts])
    both = branch.join(whole, above).withColumn(
        "rare", (F.col("values") > VALUES) & (F.col("n") < F.lit(SHARE) * F.col("all_n"))
    )
    told = ~F.col("rare") & (F.col("labelled") > 0)
    pooled = F.col("all_blocked") / F.col("all_labelled")
    smoothed = (F.col("blocked") + WEIGHT * pooled) / (F.col("labelled") + WEIGHT)
    row = Window.partitionBy(*above).orderBy("smoothed", "own")
    l, b = F.col("labelled"), F.col("blocked")
    l0, b0 = F.lag("labelled").over(row), F.lag("blocked").over(row)
    share = (b + b0) / (l + l0)
    apart = F.abs(b / l - b0 / l0) > APART * F.sqrt(share * (1 - share) * (1 / l + 1 / l0))
    runs = both.where(told).withColumn("smoothed", smoothed).withColumn("apart", apart.cast("int"))
    runs = runs.withColumn("run", F.sum(F.coalesce("apart", F.lit(0))).over(row))
    # A segment holds no slash: names of merged branches are no other segment's.
    names = F.array_join(F.array_sort(F.collect_list("own").over(Window.partitionBy(*above, "run"))), "/")
    merged = runs.select(*above, "own", names.alias("new"))
    others = both.where(~told).select(*above, "own", F.when(F.col("rare"), "*").otherwise(F.col("own")).alias("new"))
    return merged.unionByName(others)


def _template(shapes: DataFrame) -> DataFrame:
    """``host, shape, n, labelled, blocked, template``: the template's segments per shape."""
    active = shapes.select("*", F.array().cast("array<string>").alias("done"), F.col("shape").alias("rest"))
    finished = []
    while not active.isEmpty():
        moved = stored(_advanced(active), "url-branches")
        ended = moved.where("rest is null").drop("rest")
        finished.append(ended.withColumnRenamed("done", "template"))
        open_ = moved.where("rest is not null").withColumn("own", F.col("rest")[0])
        grown = open_.join(_branches(open_), ["host", "done", "own"]).withColumns({
            "done": F.concat("done", F.array("new")), "rest": F.slice("rest", F.lit(2), F.size("rest")),
        })
        active = stored(grown.drop("own", "new"), "url-tree")
    empty = shapes.limit(0).withColumn("template", F.col("shape"))
    return reduce(DataFrame.unionByName, finished, empty)


def _shown(template: Column) -> Column:
    """A template as text; merged segments stand in braces."""
    shown = lambda s: F.when(F.contains(s, F.lit("/")), F.concat(F.lit("{"), F.replace(s, F.lit("/"), F.lit("|")), F.lit("}"))).otherwise(s)
    return F.concat_ws("/", F.lit(""), F.transform(template, shown))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row: ``page_id, host, path, rule, verdict, template, rejected_share``."""
    chosen = picked(pages, page_id=id_col, url=url_col)
    host, path = parts(F.col("url"))
    cut = chosen.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = _by_rules(F.col("host"), F.col("path"), rules)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    shape = F.transform(segments, lambda s: F.regexp_replace(s, "[0-9]+", "*"))
    rows = cut.withColumns({"rule": rule, "by_rule": verdict, "shape": shape})
    shapes = rows.groupBy("host", "shape").agg(
        F.count("*").alias("n"),
        F.count("by_rule").alias("labelled"),
        F.count_if(F.col("by_rule") == "block").alias("blocked"),
    )
    shapes = stored(shapes, "url-shapes")
    tree = stored(_template(shapes), "url-templates")
    per_template = tree.groupBy("host", "template").agg(
        *[F.sum(c).alias(f"sum_{c}") for c in ("labelled", "blocked")]
    )
    s1 = F.try_element_at("shape", F.lit(1))
    first = shapes.groupBy(s1.alias("s1")).agg(F.sum("labelled").alias("first_n"), F.sum("blocked").alias("first_b"))
    over = shapes.agg(F.sum("labelled").alias("over_n"), F.sum("blocked").alias("over_b"))
    overall = F.coalesce(F.try_divide("over_b", "over_n"), F.lit(0.0))
    prior = (F.col("first_b") + WEIGHT * overall) / (F.col("first_n") + WEIGHT)
    share = (F.col("sum_blocked") + WEIGHT * F.col("prior")) / (F.col("sum_labelled") + WEIGHT)
    # ``over`` is one row.
    first = first.crossJoin(F.broadcast(over)).select(F.col("s1").alias("f1"), prior.alias("prior"))
    joined = tree.join(per_template, ["host", "template"]).withColumn("s1", s1)
    judged = joined.join(first, F.col("s1").eqNullSafe(F.col("f1"))).select(
        F.col("host").alias("of_host"), F.col("shape").alias("of_shape"),
        _shown(F.col("template")).alias("template"), share.alias("rejected_share"),
    )
    judged = stored(judged, "url-verdicts")
    by_method = F.when(F.col("rejected_share") >= REJECT, "block").otherwise("allow")
    return rows.join(judged, (F.col("host") == F.col("of_host")) & (F.col("shape") == F.col("of_shape"))).select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"),
        "template", "rejected_share",
    )
