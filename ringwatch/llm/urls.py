"""URL filters: rules by host and path, and block decisions that reach a resource's other addresses."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm.components import components
from ringwatch.session import Scratch, scratch_for

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A to Z lower-cased, and the path; both empty without ``://``."""
    after = url.substr(F.instr(url, "://") + 3, F.length(url))
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = _lower(F.regexp_extract(after, r"^[^/?#]*", 0))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def identity(url: Column) -> Column:
    """What two spellings of one address have in common: scheme and host lower-cased, no fragment; null without ``://``."""
    whole = F.regexp_extract(url, r"^[^#]*", 0)
    head = F.regexp_extract(whole, r"^.*?://[^/?]*", 0)
    return F.when(F.length(head) > 0, F.concat(_lower(head), whole.substr(F.length(head) + 1, F.length(whole))))


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")


def fit_rules(urls: DataFrame, rules: DataFrame, host: str, path: str, out: str) -> DataFrame:
    """``urls`` with the column ``out``: the struct (rule, verdict) of the longest rule that fits, or null.

    ``rules``: ``verdict, host, path``, of any number. Of equally long rules that of the longer host
    counts, and of equal ones allow. A rule's host meets the last labels of a url's host, one join for
    each number of labels among the rules; Spark broadcasts the rules if they are small. Paths of one host's
    rules are looked through per url, the longest first.
    """
    rules = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull())
    labels = F.size(F.split("host", r"\."))
    entry = F.struct(
        (-F.length("path")).alias("shorter"), "path", (F.col("verdict") != ALLOW).alias("blocks"), "verdict"
    )
    grouped = rules.groupBy(F.col("host").alias("_host"), labels.alias("_labels")).agg(
        F.sort_array(F.collect_set(entry)).alias("_paths")
    )
    depths = sorted(r[0] for r in rules.select(labels).distinct().collect())
    taken = [F.col(f"`{c}`") for c in urls.columns]
    best = []
    for depth in depths:
        of_depth = grouped.filter(F.col("_labels") == depth).select(
            F.col("_host").alias(f"_host{depth}"), F.col("_paths").alias(f"_paths{depth}")
        )
        urls = urls.join(of_depth, F.substring_index(F.col(host), ".", -depth) == F.col(f"_host{depth}"), "left")
        fits = F.filter(f"_paths{depth}", lambda p: F.col(path).startswith(p["path"]))
        first = F.get(fits, F.lit(0))
        best.append(F.when(first.isNotNull(), F.struct(
            (F.length(f"_host{depth}") + F.length(first["path"])).alias("size"),
            F.length(f"_host{depth}").alias("host_size"),
            F.concat(F.col(f"_host{depth}"), first["path"]).alias("rule"),
            first["verdict"].alias("verdict"),
        )))
    if not best:
        return urls.select(*taken, F.lit(None).cast("struct<rule:string,verdict:string>").alias(out))
    longest = F.greatest(*best) if len(best) > 1 else best[0]
    found = urls.withColumn("_best", longest)
    return found.select(*taken, F.when(
        F.col("_best").isNotNull(), F.struct(F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("verdict"))
    ).alias(out))


# Links that say that two addresses are one resource


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute, with the character references of urls decoded; empty if there is none."""
    pattern = rf"""(?i)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    for reference, char in (("&quot;|&#34;", '"'), ("&#39;|&#x27;", "'"), ("&amp;|&#38;|&#x26;", "&")):
        value = F.regexp_replace(value, f"(?i){reference}", char)
    return F.trim(F.regexp_replace(value, r"[\x09-\x0D]", " "))


def link_targets(html: Column) -> Column:
    """Targets, as written, of the canonical links and meta refreshes in the head of a page."""
    silent = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
    head = F.regexp_extract(F.regexp_replace(html, silent, " "), r"(?is)^(.*?)(?:</head\b|<body\b|\z)", 1)
    links = F.filter(
        F.regexp_extract_all(head, F.lit(r"(?i)<link\b[^>]*>"), 0),
        lambda tag: F.array_contains(F.split(F.lower(_attribute(tag, "rel")), " +"), "canonical"),
    )
    refreshes = F.filter(
        F.regexp_extract_all(head, F.lit(r"(?i)<meta\b[^>]*>"), 0),
        lambda tag: F.lower(_attribute(tag, "http-equiv")) == "refresh",
    )
    forward = r"""(?i)^[\d.\s]*[;,]?\s*url\s*=\s*["']?([^"']*)"""
    targets = F.concat(
        F.transform(links, lambda tag: _attribute(tag, "href")),
        F.transform(refreshes, lambda tag: F.trim(F.regexp_extract(_attribute(tag, "content"), forward, 1))),
    )
    return F.when(html.rlike("(?i)canonical|refresh"), F.filter(targets, lambda t: t != ""))


def resolved(base: Column, target: Column) -> Column:
    """The absolute address of a link on the page ``base``; null if it leaves the web or ``base`` has no ``://``."""
    origin = F.regexp_extract(base, r"^.*?://[^/?#]*", 0)
    path = F.regexp_extract(base, r"^.*?://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(path, r"^.*/", 0)
    joined = (
        F.when(target.rlike(r"^(?i)https?://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(F.instr(base, "://") == 0, F.lit(None).cast("string"))
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, r"^.*?:", 0), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(origin, path, target))
        .when(target.startswith("#"), base)
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), target))
    )
    return F.when(joined.rlike(r"/\.\.?(?:[/?#]|$)"), _without_dots(joined)).otherwise(joined)


def _without_dots(url: Column) -> Column:
    """The url with the segments ``.`` and ``..`` of its path carried out."""
    origin = F.regexp_extract(url, r"^.*?://[^/?#]*", 0)
    path = F.regexp_extract(url, r"^.*?://[^/?#]*/?([^?#]*)", 1)
    rest = F.regexp_extract(url, r"^[^?#]*(.*)", 1)
    steps = F.split(path, "/")
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda kept, step: F.when(step == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(step == ".", kept).otherwise(F.concat(kept, F.array(step))),
    )
    closing = F.when(F.element_at(steps, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(origin, F.lit("/"), F.array_join(kept, "/"), closing, rest)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``from_url, to_url``: an edge per canonical link and meta refresh of the pages."""
    found = pages.select(
        F.col(f"`{url}`").cast("string").alias("from_url"),
        F.explode(link_targets(F.col(f"`{html}`").cast("string"))).alias("target"),
    )
    return found.select("from_url", resolved(F.col("from_url"), F.col("target")).alias("to_url"))


# Decisions


def blocked_aliases(links: DataFrame, rules: DataFrame, scratch: Scratch) -> DataFrame:
    """``node``: the identities (SHA-256) whose component inherits a block.

    Components are those of ``links`` (``from_url, to_url``), redirects taken both ways. A component with a
    blocked address and none that a rule allows passes the block on; an explicit allow of any of its
    addresses takes precedence.
    """
    pairs = links.select(identity(F.col("from_url")).alias("a_url"), identity(F.col("to_url")).alias("b_url"))
    pairs = pairs.filter("a_url <> b_url").select(
        "a_url", "b_url", F.sha2("a_url", 256).alias("a"), F.sha2("b_url", 256).alias("b")
    )
    pairs = scratch.cut(pairs, "links")
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("a_url").alias("url")),
        F.struct(F.col("b").alias("node"), F.col("b_url").alias("url")),
    )).alias("end")).select("end.*").dropDuplicates(["node"])
    host, path = host_and_path(F.col("url"))
    decided = fit_rules(ends.select("node", host.alias("host"), path.alias("path")), rules, "host", "path", "fit")
    decided = decided.filter("fit IS NOT NULL").select("node", F.col("fit.verdict").alias("verdict"))
    labels = components(pairs.select("a", "b"), scratch)
    verdicts = labels.join(decided, "node").groupBy("label").agg(
        F.bool_or(F.col("verdict") == BLOCK).alias("blocked"), F.bool_or(F.col("verdict") == ALLOW).alias("allowed")
    )
    return labels.join(verdicts.filter("blocked AND NOT allowed").select("label"), "label").select("node")


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] | DataFrame,
    redirects: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    scratch: Scratch | None = None,
) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` of every row of ``pages``.

    ``rules`` is a list or a table ``verdict, host, path``. The longest rule that fits a url decides on it.
    A url that no rule fits is blocked if it is the same resource as a blocked one: redirects (a table
    ``from_url, to_url``, say of a crawl log), and the canonical links and meta refreshes in the pages'
    heads, join addresses into components. In a component any address that a rule allows takes
    precedence over all that rules block. All else is allowed.

    Null urls and those without ``://`` have an empty host and path, fit no rule and have no aliases. A null
    html has no links, and links that leave the web or are empty are none. Repeated rows are answered one by one. Without
    pages there are no rows. Other columns are not read, whatever their names.

    Only addresses with links take part in the components, whose rounds move hashes; the pages meet the
    blocked hashes in one join, in which rows without an address do not share a key.
    """
    scratch = scratch_for(pages, scratch)
    table = rules if isinstance(rules, DataFrame) else rule_table(pages.sparkSession, rules)
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    blocked = blocked_aliases(links, table, scratch)
    given = F.col(f"`{url}`").cast("string")
    host, path = host_and_path(given)
    rows = pages.select(
        F.col(f"`{page_id}`").cast("bigint").alias("page_id"), given.alias("url"), host.alias("host"), path.alias("path"),
        F.coalesce(F.sha2(identity(given), 256), F.xxhash64(F.col(f"`{page_id}`")).cast("string")).alias("node"),
    )
    fitted = fit_rules(rows, table, "host", "path", "fit").join(blocked.withColumn("aliased", F.lit(True)), "node", "left")
    verdict = F.coalesce("fit.verdict", F.when(F.col("aliased"), BLOCK), F.lit(ALLOW))
    return fitted.select("page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"))
