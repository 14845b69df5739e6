"""URL filtering by redirect equivalence, in DataFrame functions only.

Rules judge a URL by host and path.  URLs that redirect to each other or name a
canonical URL are aliases: the connected components over these edges share
decisions.  A page without a rule of its own is blocked if an alias is blocked
by a rule, unless an alias is allowed by one: explicit allows go first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import stored
from .graph import components

# fixed values: (action, host and path)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)<link\b[^>]*\brel\s*=\s*(?:["']?|"[^">]*\s|'[^'>]*\s)canonical\b[^>]*>"""
_META = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
_GOTO = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_part(url, r"^(?s:.*?)://([^/?#]*)"), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, r"^(?s:.*?)://[^/?#]*([^?#]*)")


def _fits(host: Column, path: Column, rule: str) -> Column:
    at = rule.index("/")
    own, start = rule[:at], rule[at:]
    return ((host == own) | host.endswith(f".{own}")) & path.startswith(start)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its action (nulls: none fits)."""
    rule = action = None
    for act, name in sorted(rules, key=lambda r: -len(r[1])):
        fits = _fits(host, path, name)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        action = F.when(fits, act) if action is None else action.when(fits, act)
    return rule, action


def url_key(url: Column) -> Column:
    """What makes two URLs the same place: host, path and query, without scheme and fragment."""
    return F.concat(host_of(url), path_of(url), _part(url, r"^(?s:.*?)://[^/?#]*[^?#]*(\?[^#]*)"))


def _absolute(link: Column, url: Column, host: Column, path: Column) -> Column:
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    folder = F.regexp_extract(path, r"^(?s)(.*/)", 1)
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(F.lit("http://"), host, link))
            .when(link.startswith("#") | (link == ""), F.lit(None))
            .otherwise(F.concat(F.lit("http://"), host, F.when(folder == "", "/").otherwise(folder), link)))


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): keys of each page's URL and of all canonical URLs and refresh targets its HTML names."""
    text = F.col(html)
    found = lambda tag, target: F.transform(F.regexp_extract_all(text, F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, target, 1))
    named = pages.where(F.contains(F.lower(text), F.lit("canonical")) | F.contains(F.lower(text), F.lit("refresh"))).select(
        F.col(url).alias("url"), F.explode(F.concat(found(_LINK, _HREF), found(_META, _GOTO))).alias("link")).where("link != ''")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    target = _absolute(F.col("link"), F.col("url"), host, path)
    return named.where(host != "").select(url_key(F.col("url")).alias("a"), url_key(target).alias("b")).where(
        "a is not null and b is not null and a != b").distinct()


def judge(pages: DataFrame, rules=RULES, edges: DataFrame | None = None, page_id: str = "page_id",
          url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``edges`` (a, b: URL keys) adds redirects known from elsewhere, such as a
    crawl log.  A page with a rule gets its action.  Others get ``block`` if
    their component holds a URL (of a page or only of a link) that a rule blocks
    and none that a rule allows, else ``allow``.  A null URL, or one without
    ``://``, has empty host and path, no rule and no aliases.  Repeated pages
    are judged alike; empty tables give no rows.
    """
    links = link_edges(pages, url, html)
    if edges is not None:
        links = links.union(edges)
    member = components(links)
    key_host = F.regexp_extract("node", r"^([^/?#]*)", 1)
    key_path = F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1)
    _, act = rule_of(key_host, key_path, rules)
    decided = stored(member.withColumn("act", act).groupBy("root").agg(
        F.when(F.bool_or(F.col("act") == "allow"), "allow").when(F.bool_or(F.col("act") == "block"), "block").alias("shared"))
        .where("shared = 'block'").join(member, "root").select(F.col("node").alias("key"), "shared"), "url-blocked")

    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    judged = (pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), url_key(F.col(url)).alias("key"))
              .withColumns({"rule": rule, "action": action}))
    return (judged.join(decided, "key", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("action", "shared", F.lit("allow")).alias("verdict")))


def digest(pages: DataFrame) -> DataFrame:
    """One row per page: the columns of query ``op5_url_filters``."""
    return judge(pages)


SQL = r"""
with recursive p as (select page_id, html,
    case when contains(url, '://') then regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1) else '' end h0,
    case when contains(url, '://') then regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) else '' end path,
    case when contains(url, '://') then regexp_extract(url, '^(?s:.*?)://[^/?#]*[^?#]*(\?[^#]*)', 1) else '' end q from pages),
 k as (select page_id, html, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, path, q from p),
 l as (select host, path, host || path || q a, replace(unnest(list_concat(
    list_transform(regexp_extract_all(html, '(?i)<link\b[^>]*\brel\s*=\s*(?:["'']?|"[^">]*\s|''[^''>]*\s)canonical\b[^>]*>'), lambda x : regexp_extract(x, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(regexp_extract_all(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), lambda x : regexp_extract(x, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)))),
    '&amp;', '&') link from k where host <> '' and html is not null),
 t as (select a, case when regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') then link when link like '//%' then 'http:' || link
    when link like '/%' then 'http://' || host || link when link like '#%' or link = '' then null
    else 'http://' || host || case when path = '' then '/' else regexp_extract(path, '^(?s:(.*/))', 1) end || link end u from l),
 e as (select distinct a, translate(regexp_extract(u, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_extract(u, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) || regexp_extract(u, '^(?s:.*?)://[^/?#]*[^?#]*(\?[^#]*)', 1) b from t where u is not null),
 s as (select a, b from e where a <> b union select b, a from e where a <> b),
 c(a, b) as (select a, a from s union select c.a, s.b from c join s on c.b = s.a),
 r(rule, host, path, act) as (values ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
 n as (select distinct b, regexp_extract(b, '^([^/?#]*)', 1) host, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) path from c),
 na as (select b, arg_max(act, length(rule)) act from n join r on (n.host = r.host or ends_with(n.host, '.' || r.host)) and starts_with(n.path, r.path) group by b),
 shared as (select a, case when bool_or(act = 'allow') then 'allow' when bool_or(act = 'block') then 'block' end act from c left join na using (b) group by a),
 hp as (select distinct host, path from k),
 own as (select hp.host, hp.path, arg_max(rule, length(rule)) rule, arg_max(act, length(rule)) act
    from hp join r on (hp.host = r.host or ends_with(hp.host, '.' || r.host)) and starts_with(hp.path, r.path) group by hp.host, hp.path)
select page_id, k.host host, k.path path, own.rule rule, coalesce(own.act, shared.act, 'allow') verdict
from k left join own on own.host = k.host and own.path = k.path left join shared on shared.a = k.host || k.path || k.q
"""
