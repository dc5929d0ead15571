import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from nocturne.llm.queries import ORACLE_SQL, RULES, op2_url_filter
from nocturne.llm.url_filter import decoded, judge, node_of, resolved

SCHEMA = "page_id long, url string, html string, host string, rule string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash") for i, (u, h) in enumerate(rows)], SCHEMA)


def verdicts(spark, scratch, rows, **extra):
    return {r.page_id: r for r in judge(pages(spark, rows), RULES, scratch, **extra).collect()}


def same_by_sql(got, rows):
    """The query's SQL over the same pages."""
    db = duckdb.connect()
    db.register("pages", pa.table({"page_id": pa.array(range(len(rows)), pa.int64()), "url": pa.array([u for u, _ in rows], pa.string()), "html": pa.array([h for _, h in rows], pa.string())}))
    expect = {r[0]: r for r in db.sql(ORACLE_SQL["op2_url_filter"]).fetchall()}
    assert {i: (r.page_id, r.host, r.path, r.rule, r.verdict, r.alias_verdict) for i, r in got.items()} == expect


def test_rules_and_parts(spark, scratch):
    rows = [
        ("http://A.example.COM/en/8?x#y", None),
        ("https://example.com/en/71", ""),
        ("https://m.example.net/de/8", ""),
        ("https://example.net/DE/8", ""),
        ("https://notcom/en/1", ""),
        ("https://com/en/", ""),
        ("no scheme.com/en/1", ""),
        (None, None),
        ("x://", ""),
        ("a://b.com?/en/", ""),
        ("a://b.org/es/#f://c.com/en/", ""),
        ("", ""),
    ]
    got = verdicts(spark, scratch, rows)
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("a.example.com", "/en/8", "com/en/", "block")
    assert (got[1].rule, got[1].verdict) == ("example.com/en/7", "allow")
    assert (got[2].rule, got[2].verdict) == ("example.net/de/8", "block")
    assert (got[3].rule, got[3].verdict) == (None, "allow")
    assert got[4].rule is None and got[5].rule == "com/en/"
    for i in (6, 7, 8, 11):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == ("", "", None, "allow")
    assert (got[9].host, got[9].path) == ("b.com", "")
    same_by_sql(got, rows)
    assert got[10].rule == "org/es/"


def canonical(href):
    return f"<head><LINK href='{href}' rel=\"canonical\"></head>"


def test_aliases_take_block_decisions_and_allow_comes_first(spark, scratch):
    rows = [
        ("https://a.example.fr/x", canonical("https://b.example.com/en/1")),  # blocked alias
        ("https://c.example.fr/y", "<meta http-equiv=refresh content='0; url=https://a.example.fr/x'>"),  # two steps away
        ("https://d.example.fr/z", canonical("/other")),
        ("https://e.example.fr/q", canonical("https://example.com/en/7a") + "<meta http-equiv='refresh' content='3;URL=https://z.org/es/1'>"),  # allow beats block
        ("https://d.example.fr/other", "<!-- <link rel=canonical href='https://b.example.com/en/1'> -->"),
        ("https://example.com/en/77", canonical("https://w.org/es/3")),  # own rule decides
        ("HTTP://C.example.fr/y#part", None),
    ]
    got = verdicts(spark, scratch, rows)
    assert [got[i].verdict for i in range(7)] == ["block", "block", "allow", "allow", "allow", "allow", "block"]
    assert got[3].alias_verdict == "allow" and got[4].alias_verdict is None
    same_by_sql(got, rows)


def test_links_are_resolved_as_by_rfc_3986(spark):
    base = "http://a/b/c/d;p?q"
    expect = {  # the examples of section 5.4 of the RFC, without fragments
        "http://g/": "g/", "g": "a/b/c/g", "./g": "a/b/c/g", "g/": "a/b/c/g/", "/g": "a/g", "//g": "g/", "?y": "a/b/c/d;p?y", "g?y": "a/b/c/g?y", "#s": "a/b/c/d;p?q", "g#s": "a/b/c/g", "g?y#s": "a/b/c/g?y",
        ";x": "a/b/c/;x", "g;x": "a/b/c/g;x", "": "a/b/c/d;p?q", ".": "a/b/c/", "./": "a/b/c/", "..": "a/b/", "../": "a/b/", "../g": "a/b/g", "../..": "a/", "../../": "a/", "../../g": "a/g",
        "../../../g": "a/g", "../../../../g": "a/g", "/./g": "a/g", "/../g": "a/g", "g.": "a/b/c/g.", ".g": "a/b/c/.g", "g..": "a/b/c/g..", "..g": "a/b/c/..g", "./../g": "a/b/g", "./g/.": "a/b/c/g/",
        "g/./h": "a/b/c/g/h", "g/../h": "a/b/c/h", "g;x=1/./y": "a/b/c/g;x=1/y", "g;x=1/../y": "a/b/c/y", "g?y/./x": "a/b/c/g?y/./x", "g#s/../x": "a/b/c/g",
        "g:h": None, "mailto:x@y": None, "javascript:void(0)": None, "JavaScript:void(0)": None, "data:,x": None, "http:": None, "http:g": None, "//": None, " \n g\t": "a/b/c/g",
    }
    got = {r.link: r.node for r in spark.createDataFrame([(k, base) for k in expect], "link string, base string").withColumn("to", resolved(F.col("link"), F.col("base"))).select("link", F.when(F.col("to").isNotNull(), node_of(F.col("to"))).alias("node")).collect()}
    assert got == expect


def test_references_are_decoded_once(spark):
    expect = {"a&amp;b": "a&b", "&#38;": "&", "&#x26;": "&", "&#X26": "&", "&#38;amp;": "&amp;", "&amp;#38;": "&#38;", "&sol;x&unknown;&": "/x&unknown;&", "&#233;&#x1F600;": "é😀", "&#0;&#xD800;&#99999999;": "\ufffd" * 3, "plain": "plain"}
    got = {r.t: r.d for r in spark.createDataFrame([(k,) for k in expect], "t string").select("t", decoded(F.col("t")).alias("d")).collect()}
    assert got == expect


def test_strangers_are_no_aliases(spark, scratch):
    blocked = "https://b.example.com/en/1"
    rows = [
        ("https://s.example.fr/x/a", canonical("javascript:void(0)")),
        ("https://s.example.fr/x/b", canonical("javascript:void(0)") + canonical(blocked)),
        ("https://t.example.fr/x/a", canonical("#top")),
        ("https://t.example.fr/x/b", canonical("#top") + canonical(blocked)),
        ("https://u.example.fr/x/y/z", canonical("../../q")),
        ("https://u.example.fr/q", canonical(blocked.replace("/en/", "&#47;en&sol;"))),
        ("https://v.example.fr/1", "<base target=_blank><base href='/deep/down/'>" + canonical("../up")),
        ("https://v.example.fr/deep/up", canonical(blocked)),
        ("https://w.example.fr/1", canonical("https://w.example.fr/a/./b/../c")),
        ("https://w.example.fr/a/c", canonical(blocked)),
        ("https://w.example.fr/x/../a/c", None),
        ("mailto:x", canonical(blocked)),
        ("https://y.example.fr/1", f"<link data-href='{blocked}' rel=canonical href=/2 title='a > b'>"),
    ]
    got = verdicts(spark, scratch, rows)
    assert [got[i].verdict for i in range(13)] == ["allow", "block"] * 2 + ["block"] * 7 + ["allow"] * 2
    same_by_sql(got, rows)


def test_extra_edges_empty_tables_and_repeats(spark, scratch):
    edges = spark.createDataFrame([("a.fr/", "b.com/en/1"), ("a.fr/", "b.com/en/1"), ("c.fr/", "c.fr/")], "u string, v string")
    got = verdicts(spark, scratch, [("http://a.fr", None), ("http://a.fr/", None), ("http://a.fr", None), ("http://c.fr", "")], edges=edges)
    assert [got[i].verdict for i in range(4)] == ["block", "block", "block", "allow"]
    assert judge(pages(spark, []), RULES, scratch).count() == 0
    assert spark.range(1).select(node_of(F.lit("s://H.x?q#f"))).first()[0] == "h.x/?q"


def test_query_matches_plain_python(spark, sf_dir):
    rows = {r.page_id: r for r in op2_url_filter(spark, sf_dir).collect()}
    for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        rest = p.url.split("://", 1)[1] if "://" in p.url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        assert (rows[p.page_id].host, rows[p.page_id].path) == (host, path)
        assert rows[p.page_id].rule == (rule.name if rule else None)
        assert rows[p.page_id].verdict == (rule.verdict if rule else "allow")
