import duckdb

from changeledger.llm import oracles, urls
from changeledger.llm.queries import op9_urls
from tests.conftest import SF


def own(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    best = max(((len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, None))
    return host, path, best[1], best[2]


def test_small(spark):
    link = lambda u: f'<html><LINK href="{u}" rel="canonical"></html>'
    rows = [
        (1, None, None), (2, "no scheme", ""), (3, "http://A.COM/x?y#z", ""), (4, "http://com", ""), (5, "x://example.com/en/1", ""), (6, "x://www.Example.com/en/1#q", ""),
        (7, "http://a.net/fr/9", ""), (8, "http://b.org/1", link("http://a.net/fr/9?z")), (9, "http://b.org/2", "<meta content='0; url=/1' http-equiv='refresh'>"), (10, "http://b.org/3", link("//b.org/2")),
        (11, "http://z.com/1", link("http://a.net/fr/9")), (12, "http://b.org/4", link("http://c.org/")), (12, "http://b.org/4", link("http://c.org/")), (13, "http://é.net?a/fr/", ""), (None, "http://a.net/es/", "x" * 300000), (14, "http://notcom/", ""),
        (20, "http://c.net/fr/x\ny", link("http://d.org/z")), (21, "http://d.org/z", ""),
        (22, "http://e.org/a/b/c", link("../../z")), (23, "http://e.org/z", link("http://f.net/es/q?1&amp;2")),
        (24, "http://g.org/a/b", link("c.html")), (26, "http://h.org/i", link("?q#f")),
        (25, "http://g.org/a/c.html", "<link rel='canonical' href='x:y'><link rel=canonical href='http://f.net/es/1'>"),
        (27, "http://i.org", "<meta http-equiv=refresh content=\"1;URL='j/./k/..'\">"),
        (28, "http://i.org/j/", '<link rel="nofollow canonical" href="http:&#47;/k.net/fr/&amp;">'),
        (29, "http://l.org/1", "<link rel=alternate href='http://f.net/es/1'>"), (30, "http://m.org/", '<meta http-equiv="refresh" content="30">'),
        (31, "http://n.org/1", link("mailto:x@f.net")),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as node", "3 as own")
    got = urls.judge(df).collect()
    assert len(got) == len(rows)
    aliases = {8, 9, 10, 21, 22, 23, 24, 25, 27, 28}
    for r in got:
        u = next(x[1] for x in rows if x[0] == r.page_id)
        host, path, rule, verdict = own(u)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.page_id in aliases else "allow"))
    assert urls.judge(df.limit(0)).count() == 0
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    want = con.execute(oracles.OP9).fetchall()
    assert sorted(map(str, want)) == sorted(str((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in got)


def test_html_is_read_tag_by_tag(spark):
    """Each page either names http://f.net/es/1 (blocked), or only seems to."""
    to = "http://f.net/es/1"
    yes = [
        f'<link title="a>b" rel="canonical" href="{to}">', f"<link title='>' rel=canonical href={to} >", f'<link data-x="rel=alternate" rel="canonical" href="{to}"/>', f"<LINK HREF='{to}' REL='x CANONICAL'>",
        f'<base href="http://f.net/es/"><link rel=canonical href="1">', f'<base target=_top><base href="//f.net/es/x"><base href="http://c.org/"><link rel=canonical href=1>', f'<base href="/es/"><link rel=canonical href="//f.net/es/1">',
        f"<!-- x --><link rel=canonical href={to}><!-- y", f"<script>a<b</script><link rel=canonical href={to}>", f'<meta content="0; url={to}" http-equiv="Refresh">', f'<base href="http://f.net/es/"><meta http-equiv=refresh content="3;url=1">',
        f'<link rel=canonical title=it\'s href="{to}">', f'<link rel="canonical" href="{to}" rel="alternate">',
    ]
    no = [
        f"<!-- <link rel=canonical href={to}> -->", f"<script>'<link rel=canonical href={to}>'</script>", f"<style><link rel=canonical href={to}>", f"<!-- open <link rel=canonical href={to}>", f'<link title="rel=canonical" rel=alternate href="{to}">',
        f'<p title="<link rel=canonical">x</p><link rel="x-canonical" href="{to}">', '<base href="http://c.org/"><link rel=canonical href="/es/1">', f'<linkx rel=canonical href="{to}">', f'<link rel=alternate rel=canonical href="{to}">',
    ]
    long = "<p a='" + "=" * 200_000 + "'>" + "x" * 200_000
    rows = [(i, f"http://p{i}.org/a", h) for i, h in enumerate(yes + no + [long + yes[0]])]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    wrong = [rows[i][2][:200] for i, v in got.items() if v != ("block" if i < len(yes) or i == len(rows) - 1 else "allow")]
    assert not wrong and len(got) == len(rows), wrong


def test_a_base_moves_the_block(spark):
    """A blocked page with a base elsewhere hands its block to the address that its canonical link names there."""
    rows = [(1, "http://f.net/es/1", '<base href="http://c.org/d/"><link rel=canonical href=z>'), (2, "http://c.org/d/z", ""), (3, "http://f.net/es/z", "")]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "block"}


def test_resolved(spark):
    cases = {"/a/b/../c": "/a/c", "/..": "/", "/a/.": "/a/", "/a/./b": "/a/b", "": "", "/../../x": "/x", "/a//b": "/a//b", "/a/..": "/"}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    assert {r.p: r.q for r in df.select("p", urls._resolved(urls.F.col("p")).alias("q")).collect()} == cases


def test_references(spark):
    cases = {"a&amp;b": "a&b", "&#x2F;&#47;": "//", "&#233;&#x1F600;": "é\U0001f600", "&amp;lt;": "&lt;", "&#0;": "�", "plain": "plain"}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    assert {r.p: r.q for r in df.select("p", urls._decoded(urls.F.col("p")).alias("q")).collect()} == cases


def test_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op9_urls(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = own(pages[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")
