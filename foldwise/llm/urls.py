"""URL filters with redirect equivalence: block decisions reach every alias of a page.

Rules ``host/path`` decide a url directly: a rule fits its host and all subdomains if the url's path
starts with the rule's, and the longest fitting rule wins (by length of the rule, then alphabetically).
Pages are aliases of one another when a redirect or a canonical link joins their urls, directly or
through others.  A page without a rule takes the verdict of its aliases: allow if any alias is allowed by
a rule, else block if any is blocked by one, else allow.

The main path is DataFrame functions only.  Null or malformed urls have empty host and path, no rule and
no alias; html without links gives no edge; repeated pages are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.components import components
from foldwise.llm.tables import keep


def part(url: Column, group: str) -> Column:
    """A piece of ``url`` from its first ``://`` on; empty without one."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://" + group, 1)


def lower_az(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    return lower_az(part(url, r"([^/?#]*)"))


def path(url: Column) -> Column:
    return part(url, r"[^/?#]*([^?#]*)")


def rule_for(host_: Column, path_: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null; ``rules``: (host/path, verdict)."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        h, slash, p = rule.partition("/")
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(slash + p)
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return out if out is not None else F.lit(None).cast("string")


def resolved(link: Column, base: Column) -> Column:
    """A link as an absolute url without fragment: absolute, scheme-relative, host-relative or relative
    to the folder of ``base``."""
    scheme, root, folder = F.substring_index(base, "://", 1), F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1), part(base, r"[^/?#]*([^?#]*/)")
    out = (F.when(link.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
           .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
           .when(link.startswith("/"), F.concat(root, link))
           .when(folder == "", F.concat(root, F.lit("/"), link)).otherwise(F.concat(root, folder, link)))
    return F.when(link != "", out)


def address(url: Column) -> Column:
    """The key under which a url is known: host, path and query, without scheme and fragment."""
    rest = part(url, r"[^/?#]*([^#]*)")
    known = F.concat(host(url), F.when(rest.startswith("/"), "").otherwise("/"), rest)
    return F.when(known != "/", known)


_CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\bcontent\s*=\s*[\"']?\s*[0-9.]*\s*[;,]?\s*url\s*=\s*['\"]?([^\"'\s>]+)"


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): addresses joined by a canonical link or a refresh redirect in the html."""
    text = F.coalesce(F.col(html), F.lit(""))
    found = F.array(*(F.when(F.contains(F.lower(text), F.lit(word)), F.regexp_extract(text, pattern, 1)) for word, pattern in (("canonical", _CANONICAL), ("refresh", _REFRESH))))
    links = keep(pages.select(F.col(url).alias("url"), F.explode(found).alias("link")).where("link <> ''"), "links")
    return links.select(address(F.col("url")).alias("a"), address(resolved(F.col("link"), F.col("url"))).alias("b")).where("a is not null and b is not null and a <> b")


def judge(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, host, path, rule, verdict and alias (the component's smallest address; null for a page
    without links) of every row of ``pages``.  ``redirects``: further edges as urls ``a``, ``b``."""
    verdicts = F.create_map(*(F.lit(x) for r in rules for x in r)) if rules else F.create_map().cast("map<string,string>")
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b")))
    groups = components(links, "a", "b")
    # every address that a link names is judged, also one that no page has; a rule sees the address itself
    named = groups.withColumn("_u", F.concat(F.lit("http://"), F.col("node")))
    ruled = verdicts[rule_for(host(F.col("_u")), path(F.col("_u")), rules)]
    decided = groups.join(named.groupBy("component").agg(F.max((ruled == "allow").cast("int")).alias("allowed"), F.max((ruled == "block").cast("int")).alias("blocked")), "component")
    decided = keep(decided.select(F.col("node").alias("_address"), F.col("component").alias("alias"),
                                  F.when(F.col("allowed") == 1, "allow").when(F.col("blocked") == 1, "block").alias("_passed")), "aliases")
    rows = pages.select(F.col(key), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), address(F.col(url)).alias("_address"))
    rows = rows.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules)).join(decided, "_address", "left")
    return rows.select(key, "host", "path", "rule", F.coalesce(verdicts[F.col("rule")], F.col("_passed"), F.lit("allow")).alias("verdict"), "alias")
