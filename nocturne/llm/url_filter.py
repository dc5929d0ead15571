"""URL filters: host and path rules, carried over redirects and canonical links to aliases.

A page's own rule decides first (the longest that fits). A page that no rule fits takes the verdict
of its alias class: the connected component of its url under redirect (meta refresh) and
canonical-link edges. An explicitly allowed member of the class takes precedence over blocked ones;
one blocked member without an allowed one blocks the class; else the page is allowed.

Links are read as browsers read them: character references decoded, resolved by RFC 3986 against the
page's url or its base element, fragments left out and dot segments removed. Schemes other than http
and https name no page and make no alias.

DataFrame functions only. Edges come from the few pages that carry such a link; components are
found by distributed contraction, so neither links nor classes reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, components

#: The named references of the characters that have a part in urls.
REFERENCES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "num": "#", "quest": "?", "sol": "/", "colon": ":", "period": ".", "equals": "=", "percnt": "%", "plus": "+",
    "comma": ",", "semi": ";", "commat": "@", "lowbar": "_", "excl": "!", "lpar": "(", "rpar": ")", "ast": "*", "dollar": "$", "Tab": "\t", "NewLine": "\n",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null. Ties go to the rule listed first."""
    fits = lambda r: ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
    ordered = sorted(rules, key=lambda r: -len(r.name))
    return F.coalesce(*[F.when(fits(r), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered])


def without_dots(path: Column) -> Column:
    """The path without its "." and ".." segments (RFC 3986, 5.2.4); no segment climbs above the root."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    up = lambda kept: F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda kept, x: F.when(x == ".", kept).when(x == "..", up(kept)).otherwise(F.concat(kept, F.array(x))))
    folder = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")  # a last dot segment names a folder
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), folder)).otherwise(path)


def node_of(url: Column) -> Column:
    """The url without scheme, fragment and dot segments, its host lower-cased: what aliases are told apart by."""
    query = F.coalesce(F.regexp_extract(url, r"://[^/?#]*[^?#]*(\?[^#]*)", 1), F.lit(""))
    path = path_of(url)
    return F.concat(host_of(url), F.when(path == "", F.lit("/")).otherwise(without_dots(path)), query)


def decoded(text: Column) -> Column:
    """Character references decoded once, from left to right; unknown ones stay as they are."""
    def one(x: Column) -> Column:
        hexadecimal = F.lower(F.substring(x, 3, 1)) == "x"
        digits = F.regexp_extract(x, "([0-9a-fA-F]+);?$", 1)
        code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
        usable = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(usable, code).otherwise(0xFFFD).cast("long")), 8, "0")), "UTF-32")
        named = F.element_at(F.create_map(*[F.lit(v) for kv in REFERENCES.items() for v in kv]), F.regexp_extract(x, "^&([A-Za-z]+);$", 1))
        return F.when(x.rlike("^&#"), char).when(x.startswith("&"), F.coalesce(named, x)).otherwise(x)

    pieces = F.regexp_extract_all(text, F.lit("(&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z]+;|[^&]+|&)"), 1)
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def resolved(link: Column, base: Column) -> Column:
    """The absolute http(s) url of a link found in ``base`` (RFC 3986, 5.2), without its fragment; null if it names no page."""
    reference = F.regexp_replace(F.regexp_replace(link, r"^\s+|\s+$|[\t\n\r]", ""), r"(?s)#.*$", "")
    scheme = F.regexp_extract(base, "^([^:/?#]*):", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(base, "://([^/?#]*)", 1))
    folder = F.regexp_extract(path_of(base), "^(.*/)", 1)
    full = (
        F.when(reference == "", F.regexp_replace(base, "#.*$", ""))
        .when(reference.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(reference.rlike("(?i)^https?://[^/?#]"), reference))
        .when(reference.startswith("//"), F.when(reference.rlike("^//[^/?#]"), F.concat(scheme, F.lit(":"), reference)))
        .when(reference.startswith("/"), F.concat(root, reference))
        .when(reference.startswith("?"), F.concat(root, path_of(base), reference))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), reference))
    )
    return F.when(base.contains("://"), full)


def alias_edges(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) url nodes joined by a canonical link or a meta refresh in a page's html.

    Each step is written out: the few linking pages, then their links, so that no pattern runs twice.
    """
    linked = pages.where("url is not null and html is not null").where(F.col("html").rlike("(?i)canonical|refresh")).select("url", F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script\s*>", " ").alias("html"))
    tags = F.regexp_extract_all("html", F.lit(r"(?is)(<(?:link|meta|base)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>)"), 1)
    value = lambda tag, name: F.regexp_replace(F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1), "^[\"']|[\"']$", "")
    bases = F.filter("tags", lambda x: x.rlike(r"(?is)^<base\b.*\shref\s*="))
    found = linked.select("url", tags.alias("tags")).select("url", F.try_element_at(bases, F.lit(1)).alias("base"), F.explode("tags").alias("tag"))
    found = scratch.put(found.where(~F.col("tag").rlike("(?i)^<base")), "link_tags")
    named = found.select("url", F.col("tag").rlike("(?i)^<link").alias("is_link"), value(F.col("base"), "href").alias("base"), *[value(F.col("tag"), n).alias(n.replace("-", "_")) for n in ("rel", "href", "http-equiv", "content")])
    named = scratch.put(named, "link_names")
    target = F.when(F.col("is_link"), F.when(F.col("rel").rlike(r"(?i)(^|\s)canonical(\s|$)"), F.col("href"))).when(F.lower("http_equiv") == "refresh", F.regexp_extract("content", r"(?is)url\s*=\s*['\"]?([^'\"\s]+)", 1))
    links = scratch.put(named.select("url", decoded(F.col("base")).alias("base"), decoded(target).alias("link")).where("link <> ''"), "links")
    placed = scratch.put(links.select("url", "link", F.coalesce(resolved(F.col("base"), F.col("url")), "url").alias("base")), "placed_links")
    full = scratch.put(placed.select("url", resolved(F.col("link"), F.col("base")).alias("to")), "full_links")
    edges = scratch.put(full.select(node_of(F.col("url")).alias("u"), node_of(F.col("to")).alias("v")), "alias_edges")
    scratch.drop("link_tags", "link_names", "links", "placed_links", "full_links")
    return edges.where("u <> v and u not like '/%' and v not like '/%'")


def judge(pages: DataFrame, rules: list[Rule], scratch: Scratch, edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and alias_verdict (null without a decision) of every row of pages.

    A null url, or one without ://, has an empty host and path, fits no rule and has no aliases: it
    is allowed. Repeated rows and repeated page ids stay as they are; null html has no links. More
    columns of pages are ignored. ``edges`` (u, v) as of ``node_of`` may be given in addition.
    """
    found = alias_edges(pages, scratch)
    found = found if edges is None else found.unionByName(edges.select("u", "v"))
    classes = components(found, scratch, "aliases", native=True)
    as_url = F.concat(F.lit("x://"), F.col("node"))
    own = rule_of(host_of(as_url), path_of(as_url), rules)["verdict"]
    decided = (
        classes.withColumn("own", own)
        .groupBy("root")
        .agg(F.max(F.when(F.col("own") == "allow", "allow")).alias("allowed"), F.max(F.when(F.col("own") == "block", "block")).alias("blocked"))
        .select("root", F.coalesce("allowed", "blocked").alias("alias_verdict"))
        .where("alias_verdict is not null")
    )
    aliases = scratch.put(classes.join(decided, "root").select("node", "alias_verdict"), "alias_verdicts")
    scratch.drop("alias_edges", "aliases_0")
    url = F.col("url")
    none = F.concat(F.lit("none "), F.xxhash64("page_id", "url").cast("string"))  # no node is without a slash: rows without one are spread and meet nothing
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.when(url.contains("://"), node_of(url)).otherwise(none).alias("node"))
    judged = judged.withColumn("own", rule_of(F.col("host"), F.col("path"), rules)).join(aliases, "node", "left")
    return judged.select("page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce(F.col("own.verdict"), "alias_verdict", F.lit("allow")).alias("verdict"), "alias_verdict")
