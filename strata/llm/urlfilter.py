"""URL rules with redirect equivalence, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import A_Z, Scratch, a_z, quoted
from strata.llm.components import connected_components

# (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
BLOCK, ALLOW = "block", "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased.
    Path: from there up to ?, # or the end. Null, or no ://: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(F.substring_index(F.substring_index(rest, "#", 1), "?", 1), F.lit(""))
    host = F.substring_index(rest, "/", 1)
    return F.translate(host, A_Z, a_z), F.substring(rest, F.char_length(host) + 1, F.char_length(rest))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none
    does. A rule fits its host and all subdomains if the path starts with the
    rule's. Of rules of one length the first listed wins."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule = verdict = None
    for kind, rule_host, rule_path in ordered:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = rule_host + rule_path
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


# A link to another address of the same page: <link rel=canonical href=...> and
# <meta http-equiv=refresh content="0; url=...">, attributes in any order, canonical
# one of several words of rel, outside comments. A tag ends before the next <, and
# repeats give nothing back where that could not help, so the time a page takes
# grows with its length only.
_CANONICAL_TAG = (
    r"(?is)<link\b(?=[^<>]*\brel\s*+=\s*+(?:\"[^\"<>]*(?<![^\s\"])canonical(?![^\s\"])"
    r"|'[^'<>]*(?<![^\s'])canonical(?![^\s'])|canonical(?![^\s>/])))[^<>]*+>"
)
_REFRESH_TAG = r"(?is)<meta\b(?=[^<>]*\bhttp-equiv\s*+=\s*+[\"']?+\s*+refresh\b)[^<>]*+>"
_HREF = r"(?is)\bhref\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
_CONTENT_URL = r"(?is)\burl\s*+=\s*+['\"]?+\s*+([^'\"\s>]+)"
_BASE_TAG = r"(?is)<base\b(?=[^<>]*\bhref\s*+=)[^<>]*+>"
# One that does not end takes the rest of the page.
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"


_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_SPACE = " \t\n\r\f"


def _href(tag: Column) -> Column:
    return F.concat(*[F.regexp_extract(tag, _HREF, g) for g in (1, 2, 3)])


def _address(raw: Column) -> Column:
    return F.replace(F.btrim(raw, F.lit(_SPACE)), F.lit("&amp;"), F.lit("&"))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def resolved(target: Column, base: Column) -> Column:
    """The absolute address that a link names on a page of address ``base``
    (RFC 3986). Absolute links, and those on a page without an absolute address,
    stay as they are; empty links, and schemes without // (mailto:), are null."""
    relative = _let(target, lambda t: _let(base, lambda b: _relative(t, b)))
    return F.when(target.rlike(_ABSOLUTE), target).when((target != "") & ~target.rlike(_SCHEME), relative)


def _relative(target: Column, base: Column) -> Column:
    root = F.regexp_extract(base, _ABSOLUTE + r"[^/?#]*", 0)
    page = F.substring_index(base, "#", 1)
    place = F.substring_index(page, "?", 1)
    own = F.regexp_extract(target, r"(?s)^[^?#]*", 0)
    rest = F.substring(target, F.char_length(own) + 1, F.char_length(target))
    # The place up to its last slash behind the host.
    folder = F.regexp_extract(place, r"(?s)^[^:]*://[^/]*(.*/)?", 1)
    path = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), own))
    return (
        F.when(root == "", target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), target))
        .when(target.startswith("#"), F.concat(page, target))
        .when(target.startswith("?"), F.concat(place, target))
        .otherwise(F.concat(root, _let(F.split(path, "/"), _without_dots), rest))
    )


def _without_dots(parts: Column) -> Column:
    """A path, cut at its slashes (the first part is empty), without . and .. segments."""
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)),
        F.array().cast("array<string>"),
        lambda done, x: F.when(x == ".", done)
        .when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(x))),
    )
    closing = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, closing), "/"))


def declared_targets(html: Column, url: Column) -> Column:
    """Absolute addresses that a page's canonical links and refresh redirects
    name; others are resolved against its first <base href>, or its url."""
    html = F.when(F.instr(html, "<!--") > 0, F.regexp_replace(html, _COMMENT, "")).otherwise(html)
    links = F.transform(F.regexp_extract_all(html, F.lit(_CANONICAL_TAG), F.lit(0)), _href)
    moves = F.transform(F.regexp_extract_all(html, F.lit(_REFRESH_TAG), F.lit(0)), lambda t: F.regexp_extract(t, _CONTENT_URL, 1))
    declared = _address(_href(F.regexp_extract(html, _BASE_TAG, 0)))
    base = F.coalesce(resolved(declared, url), url)
    # Only what is not absolute looks for a base.
    found = F.transform(F.transform(F.concat(links, moves), _address), lambda u: F.when(u.rlike(_ABSOLUTE), u).otherwise(resolved(u, base)))
    return F.filter(found, lambda u: u.rlike(_ABSOLUTE))


def page_key(url: Column) -> Column:
    """Addresses that always redirect to or show the same page have one key:
    scheme, fragment, the scheme's own port and a closing slash are left out, the
    host is lower-cased. Null for a url without ://."""
    host, path = host_and_path(url)
    plain = F.substring_index(url, "#", 1)
    query = F.when(F.instr(plain, "?") > 0, F.substring(plain, F.instr(plain, "?"), F.char_length(plain))).otherwise("")
    scheme = F.lower(F.substring_index(url, "://", 1))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    return F.when(F.instr(url, "://") > 0, F.concat(host, F.regexp_replace(path, "/+$", ""), query))


def judge(
    pages: DataFrame,
    scratch: Scratch,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rules=RULES,
    carry: list[str] | None = None,
) -> DataFrame:
    """``row`` (the ``carry`` columns of each row of ``pages``, all unless given,
    as a struct, whatever their names), ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``.

    Where a rule fits, its verdict holds. Any other page is judged by its
    class: the pages reached over redirects and canonical links, followed in
    both directions. If a page of the class is explicitly allowed, the class is
    allowed; else if one is blocked, it is blocked; else it is allowed. A null
    url, or one without ://, has an empty host and path and is in no class. A
    link target that is not a row of ``pages`` joins classes and counts with
    its own rule. An empty table gives no rows.

    Links are extracted once; only pages and targets with a link to another key
    take part in the components. Keys of the pages are compared with the keys
    of decided classes in a join that Spark can split, so a host or a class
    with a third of all pages is no hot spot.
    """
    url = quoted(url_col)
    host, path = host_and_path(url)
    rule, decided = rule_of(host, path, rules)
    key = page_key(url)
    linked = pages.select(url.alias("url"), F.coalesce(quoted(html_col), F.lit("")).alias("html"))
    links = linked.select("url", page_key(F.col("url")).alias("a"), F.explode(declared_targets(F.col("html"), F.col("url"))).alias("target"))
    links = scratch.put(links.where("a is not null").select("url", "a", "target", page_key(F.col("target")).alias("b")), "links")
    classes = connected_components(links.select("a", "b"), scratch)
    classes = scratch.put(classes, "classes")

    own_key = page_key(F.col("url"))
    ruled = rule_of(*host_and_path(F.col("url")), rules)[1]
    # Every address that is known: pages, and targets of links.
    known = pages.select(url.alias("url")).union(links.select("target"))
    votes = known.select(own_key.alias("node"), ruled.alias("vote")).where("node is not null and vote is not null").distinct()
    # A key has no links, or its class; of a class, allowing wins over blocking.
    named = votes.join(classes, "node", "left").select(F.coalesce("component", "node").alias("class"), "vote")
    verdicts = scratch.put(named.groupBy("class").agg(F.min("vote").alias("class_verdict")), "verdicts")
    of_key = classes.join(verdicts, F.col("component") == F.col("class")).select("node", "class_verdict")
    alone = verdicts.join(classes, F.col("class") == F.col("node"), "left_anti").select(F.col("class").alias("node"), "class_verdict")
    of_key = scratch.put(of_key.union(alone), "by_key")

    rows = pages.select(
        F.struct(*[quoted(c).alias(c) for c in carry or pages.columns]).alias("row"),
        host.alias("host"), path.alias("path"), rule.alias("rule"), decided.alias("decided"), key.alias("node"),
    )
    # Decided pages, and those without a key, need no class: they match nothing
    # and are spread by a hash of their address.
    open_ = (F.col("decided").isNull() & F.col("node").isNotNull()).alias("open")
    apart = F.pmod(F.xxhash64("host", "path"), F.lit(4096)).cast("string")
    keyed = rows.select("row", "host", "path", "rule", "decided", open_, F.when(open_, F.col("node")).otherwise(apart).alias("node"))
    joined = keyed.join(of_key.withColumn("open", F.lit(True)), ["open", "node"], "left")
    return joined.select("row", "host", "path", "rule", F.coalesce("decided", "class_verdict", F.lit(ALLOW)).alias("verdict"))
