"""URL filter: host and path rules first, a path-template tree for what they leave open. DataFrame functions only.

The tree of a host is built level by level. Digits in a segment are a placeholder; where a node has many children, those
with a small share of its paths become one wildcard, and children whose share of blocked pages does not differ from their
parent's are merged. A child whose labels differ stays. The next level is counted below the generalised prefix. Labels are
what the rules say about the pages they cover. Segments that all paths below a node share are passed over in one step, so that
the steps are as many as the places where paths part, not as deep as the paths. A template's share of blocked pages is smoothed towards the share of its
shape, wildcards included, on all hosts, and the template is rejected when that passes one half. Work runs on counts of
distinct (host, path), not on pages, and a hot host is spread over its prefixes and segments.
"""

from pyspark.sql import functions as F

from cartwright.sources.scratch import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (rule, verdict); the part before the first slash is a host with all its subdomains, the rest the start of the path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: A node with more children than this gets a wildcard for those that hold less than one THIN-th of its distinct paths.
MANY, THIN = 16, 4
#: Chi-square bound at 5 % for a child that differs from its parent.
DIFFERENT = 3.84
#: Pages' worth of belief in the prior, for a shape and for a template.
SHAPE_WEIGHT, WEIGHT = 4, 4


def split_url(url):
    """(host, path) columns: host with A-Z lower-cased, both empty without `://`."""
    after = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def _rule_fits(rule):
    host, slash, path = rule.partition("/")
    at_host = (F.col("host") == host) | F.col("host").endswith("." + host)
    return at_host & F.col("path").startswith(slash + path)


def rule_columns(rules=RULES):
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda item: len(item[0])):
        rule = F.when(_rule_fits(text), F.lit(text)).otherwise(rule)
        verdict = F.when(_rule_fits(text), F.lit(says)).otherwise(verdict)
    return rule, verdict


def _tokens(children):
    """Adds to every child of a node (host, above) its token and how many paths the node has."""
    node = ["host", "above"]
    parents = materialize(
        children.groupBy(*node).agg(
            F.count(F.lit(1)).alias("kinds"), F.sum("paths").alias("all_paths"), F.sum("labelled").alias("all_labelled"),
            F.sum("blocked").alias("all_blocked"),
        ),
        "parents",
    )
    labelled, blocked = F.col("labelled").cast("double"), F.col("blocked").cast("double")
    all_labelled, all_blocked = F.col("all_labelled").cast("double"), F.col("all_blocked").cast("double")
    gap = blocked * (all_labelled + 2) - labelled * (all_blocked + 1)
    alike = (gap * gap) <= F.lit(DIFFERENT) * labelled * (all_blocked + 1) * (all_labelled + 1 - all_blocked)
    wild = (F.col("kinds") > MANY) & (THIN * F.col("paths") < F.col("all_paths")) & ((F.col("labelled") == 0) | alike)
    token = (
        F.when(wild, F.lit("*"))
        .when((F.col("kinds") > 1) & (F.col("labelled") > 0) & alike, F.lit("~"))
        .otherwise(F.col("part"))
    )
    return children.join(parents, node).select(*node, "part", token.alias("token"), "all_paths")


def _past_chains(rows):
    """Moves every node down the segments that all its paths share, up to the last before they part or one ends.

    A chain of only children has no siblings to be like, so its segments stay as they are. The shared start of a node's paths is
    that of the least and the greatest of them.
    """
    node = ["host", "above"]
    ends = rows.groupBy(*node).agg(F.min("parts").alias("lo"), F.max("parts").alias("hi"), F.min(F.size("parts")).alias("least"))
    same = F.array_position(F.zip_with("lo", "hi", lambda a, b: a.eqNullSafe(b)), False) - 1
    same = F.when(same < 0, F.size("lo")).otherwise(same)
    shared = F.least(same, F.col("least") - 1).cast("int")
    chains = ends.select(*node, shared.alias("shared"), F.slice("lo", F.lit(1), shared).alias("chain"))
    chain = F.when(F.col("shared") > 0, F.concat(F.lit("/"), F.array_join("chain", "/"))).otherwise(F.lit(""))
    moved = rows.join(materialize(chains.select(*node, "shared", chain.alias("chain")), "chains"), node)
    return moved.withColumns(
        {
            "above": F.concat("above", "chain"), "seen": F.concat("seen", "chain"),
            "parts": F.slice("parts", F.col("shared") + 1, F.size("parts")),
        }
    ).drop("shared", "chain")


def _templates(paths):
    """Adds template and shape to the distinct (host, path), one level of the tree after the other.

    `above` is the generalised prefix, so below a wildcard or a merged node the children of all its members count together, and
    `parts` is what follows it. A path that is alone below its prefix has no siblings any more and keeps the rest as it is, so
    the levels end where the last two paths part.
    """
    parts = F.split(F.regexp_replace("path", "[0-9]+", "<n>"), "/")
    rows = paths.withColumns({"parts": parts, "above": F.lit(""), "seen": F.lit("")})
    done = []
    while True:
        rows = _past_chains(rows).withColumn("part", F.element_at("parts", 1))
        counts = [F.count(F.lit(1)).alias("paths"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
        children = materialize(rows.groupBy("host", "above", "part").agg(*counts), "children")
        rows = rows.join(_tokens(children), ["host", "above", "part"])
        # Every token stands behind a slash; the one before the first segment goes at the end.
        ended = (F.col("all_paths") == 1) | (F.size("parts") == 1)
        after = F.slice("parts", F.lit(2), F.size("parts"))
        rest = F.when(F.size("parts") > 1, F.concat(F.lit("/"), F.array_join(after, "/"))).otherwise(F.lit(""))
        segment = F.when(F.col("token") == "*", F.col("token")).otherwise(F.col("part"))
        rows = materialize(
            rows.select(
                "host", "path", "pages", "labelled", "blocked", after.alias("parts"), ended.alias("ended"), rest.alias("rest"),
                F.concat("above", F.lit("/"), "token").alias("above"), F.concat("seen", F.lit("/"), segment).alias("seen"),
            ),
            "level",
        )
        template, shape = (F.expr(f"substring(concat({name}, rest), 2)") for name in ("above", "seen"))
        done.append(
            rows.filter("ended").select("host", "path", "pages", "labelled", "blocked", template.alias("template"), shape.alias("shape"))
        )
        rows = rows.filter("not ended").drop("ended", "rest")
        if rows.isEmpty():
            break
    together = done[0]
    for more in done[1:]:
        together = together.unionByName(more)
    return materialize(together, "templates")


def template_verdicts(paths):
    """host, path, template, method per distinct (host, path), from their counts of pages, labelled and blocked."""
    shaped = _templates(paths)

    # The prior of a shape on all hosts, in millionths so that sums are exact.
    shapes = materialize(shaped.groupBy("shape").agg(F.sum("labelled").alias("of"), F.sum("blocked").alias("bad")), "shape_counts")
    overall = shapes.agg(F.coalesce(F.sum("of"), F.lit(0)).alias("l"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")).first()
    base = (overall["b"] + 1) * 1_000_000 // (overall["l"] + 2)
    prior = F.floor((F.col("bad") * 1_000_000 + SHAPE_WEIGHT * base) / (F.col("of") + SHAPE_WEIGHT)).cast("bigint")
    shapes = materialize(shapes.select("shape", prior.alias("prior")), "priors")
    judged = shaped.join(shapes, "shape").groupBy("host", "template").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"),
        F.floor(F.sum(F.col("pages") * F.col("prior")) / F.sum("pages")).cast("bigint").alias("prior"),
    )
    bad = F.col("blocked") * 1_000_000 + WEIGHT * F.col("prior") > 500_000 * (F.col("labelled") + WEIGHT)
    judged = materialize(judged.select("host", "template", F.when(bad, "block").otherwise("allow").alias("method")), "judged")
    return shaped.join(judged, ["host", "template"]).select("host", "path", "template", "method")


def judge_urls(pages, rules=RULES):
    """page_id, host, path, rule, verdict, template per row of `pages`.

    Null urls and urls without `://` have an empty host and path; they, like any page without a rule, get the method's
    verdict. Repeated rows are judged alike, one row each. Rules of equal length: the later one in `rules` wins. Other columns are
    not read. An empty table gives no rows.
    """
    host, path = split_url(F.col("url"))
    rule, verdict = rule_columns(rules)
    located = pages.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": rule, "said": verdict})
    located = materialize(located, "located")
    paths = located.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"), F.count("said").alias("labelled"), F.count_if(F.col("said") == "block").alias("blocked")
    )
    verdicts = materialize(template_verdicts(paths), "verdicts")
    joined = located.join(verdicts, ["host", "path"])
    return joined.select("page_id", "host", "path", "rule", F.coalesce("said", "method").alias("verdict"), "template")
