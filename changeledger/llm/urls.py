"""URL verdicts: host and path rules, and block decisions carried along redirects; DataFrame functions only.

An edge joins a page's address (host and path) to every address that its canonical links and refresh redirects name:
absolute, without scheme, from the root or relative to the page or its first base, with dot segments resolved and character
references decoded. Tags are read attribute by attribute, quoted values as units; comments, scripts and styles are left out.
Distributed connected components over these edges are the alias classes. A page's own rule decides first, so an
explicit allow stays; a page without a rule is blocked if any address of its class falls under a block rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeledger.llm.common import Scratch, components

#: (host, path prefix, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The named character references that occur in addresses.
NAMED = (("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
#: What holds no tags of the page: comments, and the text of scripts and styles, closed or not.
SILENT = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\b|\z)|<style\b.*?(?:</style\b|\z)"
#: A tag of interest to its end: a quoted value after `=` is one unit, so a `>` inside it ends nothing.
TAG = r"""(?is)<(?:link|meta|base)\b(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+>"""
#: An attribute: its name, and its value in double quotes, single quotes or none.
ATTRIBUTE = r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?"""
TARGET = r"""(?is)^[\s\d.]*[;,]\s*(?:url\s*=)?\s*["']?([^"']+)"""
REFERENCE = r"&#(?:[xX]([0-9a-fA-F]{1,6})|([0-9]{1,7}));?"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [((host_ == h) | host_.endswith("." + h)) & path_.startswith(p) for h, p, _ in ordered]
    return tuple(F.coalesce(*[F.when(f, F.lit(value(r))) for f, r in zip(fits, ordered)]) for value in (lambda r: r[0] + r[1], lambda r: r[2]))


def tags(html: Column) -> Column:
    """The link, meta and base tags of a page in order: (name, attributes), both in lower case but for values.

    attributes is an array of (name, value); a name that repeats counts once, the first.
    """
    def read(tag: Column) -> Column:
        inner = F.regexp_replace(tag, r"(?is)^<(?:link|meta|base)", "")
        part = lambda i: F.regexp_extract_all(inner, F.lit(ATTRIBUTE), F.lit(i))
        joined = lambda a, b: F.concat(a, b)
        value = F.zip_with(F.zip_with(part(2), part(3), joined), part(4), joined)
        return F.struct(F.lower(F.substring(tag, 2, 4)).alias("tag"), F.zip_with(part(1), value, lambda n, v: F.struct(F.lower(n).alias("name"), v.alias("value"))).alias("has"))

    shown = F.regexp_replace(html, SILENT, " ")
    return F.transform(F.regexp_extract_all(shown, F.lit(TAG), F.lit(0)), read)


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value; empty if there is none."""
    return F.coalesce(F.get(F.filter(tag["has"], lambda a: a["name"] == name), F.lit(0))["value"], F.lit(""))


def _decoded(text: Column) -> Column:
    """Character references by number and the NAMED ones as characters."""
    digits = [F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(i)) for i in (1, 2)]

    def char(hexed: Column, decimal: Column) -> Column:
        n = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(decimal).cast("int")
        good = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
        return F.coalesce(F.when(good, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")), F.lit("�"))

    chars = F.zip_with(*digits, char)
    pieces = F.split(text, REFERENCE, -1)
    out = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(chars, i), F.lit("")))), "")
    out = F.when(text.contains("&#"), out).otherwise(text)
    for name, c in NAMED:
        out = F.replace(out, F.lit(name), F.lit(c))
    return out


def _resolved(path_: Column) -> Column:
    """An absolute path without `.` and `..` segments."""
    parts = F.split(path_, "/", -1)
    parts = F.slice(parts, 2, F.size(parts))

    def step(kept: Column, x: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(x == ".", kept).when(x == "..", up).otherwise(F.concat(kept, F.array(x)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    kept = F.when(F.get(parts, F.size(parts) - 1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path_ == "", path_).otherwise(F.concat(F.lit("/"), F.array_join(kept, "/")))


def target_address(to: Column, host_: Column, path_: Column) -> Column:
    """Host and path of the address `to` as named by a page at host_ and path_; empty for other schemes."""
    to = F.trim(F.regexp_replace(to, r"[\x09\x0A\x0D]", ""))
    whole = F.when(to.startswith("//"), F.concat(F.lit("x:"), to)).when(to.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), to)
    bare = F.regexp_extract(to, r"^[^?#]*", 0)
    folder = F.coalesce(F.nullif(F.regexp_extract(path_, r"(?s)^.*/", 0), F.lit("")), F.lit("/"))
    local = F.when(bare == "", path_).when(bare.startswith("/"), _resolved(bare)).otherwise(_resolved(F.concat(folder, bare)))
    other = to.rlike(r"(?i)^[a-z][a-z0-9+.-]*:")
    named = F.when(whole.isNotNull(), F.concat(host(whole), _resolved(path(whole))))
    return named.when(other | (to == ""), F.lit("")).otherwise(F.concat(host_, local))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): a page's address and each address that its canonical links and refresh redirects name."""
    rows = pages.where(F.col("html").rlike("(?i)canonical|refresh")).select("node", "host", "path", tags(F.col("html")).alias("tags"))
    based = F.get(F.filter("tags", lambda t: (t["tag"] == "base") & F.exists(t["has"], lambda a: a["name"] == "href")), F.lit(0))
    base = target_address(_decoded(_attribute(based, "href")), F.col("host"), F.col("path"))
    rows = rows.withColumn("base", F.when(based.isNotNull(), F.nullif(base, F.lit(""))))
    canonical = lambda t: (t["tag"] == "link") & F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical")
    refresh = lambda t: (t["tag"] == "meta") & (F.lower(F.trim(_attribute(t, "http-equiv"))) == "refresh")
    links = F.transform(F.filter("tags", canonical), lambda t: _decoded(_attribute(t, "href")))
    moves = F.transform(F.filter("tags", refresh), lambda t: F.regexp_extract(_decoded(_attribute(t, "content")), TARGET, 1))
    found = rows.select("node", "host", "path", "base", F.explode(F.concat(links, moves)).alias("to"))
    at = [F.coalesce(F.regexp_extract("base", r"(?s)^([^/]*)(.*)$", i), F.col(c)) for i, c in ((1, "host"), (2, "path"))]
    edges = found.select(F.col("node").alias("a"), target_address(F.col("to"), *at).alias("b"))
    return edges.where("a != '' and b != '' and a != b")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages (page_id, url, html; other columns are ignored).

    A null url or one without `://` has empty host and path, no rule and verdict allow. Repeated rows each get a row;
    null html names no alias, and html of any length is read whole; an empty table gives no rows.
    """
    base = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    base = base.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "html")
    base = base.withColumn("node", F.concat("host", "path"))
    scratch = Scratch(pages.sparkSession)
    edges = scratch.save(alias_edges(base).distinct(), "aliases")
    member = components(scratch, edges)
    address = [F.regexp_extract("node", r"(?s)^([^/]*)(.*)$", i) for i in (1, 2)]
    blocked = member.withColumn("v", rule(*address, rules)[1]).where("v = 'block'").select("component").distinct()
    carried = scratch.save(member.join(blocked, "component").select("node").distinct().withColumn("carried", F.lit("block")), "carried")
    scratch.free(edges)
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    ruled = base.drop("html").withColumn("rule", name).withColumn("own", verdict)
    return ruled.join(carried, "node", "left").select("page_id", "host", "path", "rule", F.coalesce("own", "carried", F.lit("allow")).alias("verdict"))
