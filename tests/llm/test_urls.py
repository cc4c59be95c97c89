"""URL filter: parsing and rules against plain Python, templates on planted structure."""

import pytest

from wordmill.llm.queries import LLM_QUERIES, URL_RULES
from wordmill.llm.urls import filter_urls, template_tree

URLS = [None, "", "no scheme", "http://a.net/x", "https://A.Example.NET/en/1", "http://example.net/en", "http://example.net/en/", "http://xexample.net/en/1",
        "http://b.example.com/de/4?x=/fr/", "http://example.com/deutsch", "http://org/fr/", "http://c.org/fr/1#/x", "http://c.org/FR/1", "http://d.net", "http://d.net?x",
        "http://ÉX.net/É", "x://y://z.net/a", "http:///path", "http://u.com/" + "seg/" * 4000, "http://e.net.com/x", "http://h.org/fr/%0a\n/x"]


def slow(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for verdict, h, p in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, best


def test_parsing_and_rules(spark, tmp_path):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(3, URLS[3], "h"), (None, URLS[4], None)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, host string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = LLM_QUERIES["op2_url_filter"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    of_id = {i: u for i, u, _ in rows}
    for r in got:
        host, path, best = slow(of_id[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[0])
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")


def test_templates_learn_from_labels(spark):
    urls, bad = [], {}
    for i in range(200):
        urls.append((i, f"http://shop.com/ads/{i}.html"))
        urls.append((1000 + i, f"http://shop.com/article/{i}-some-title-{i}"))
        urls.append((2000 + i, f"http://other.com/u{i}x/page"))
    bad = [(i, 1) for i in range(100)] + [(1000 + i, 0) for i in range(100)] + [(2000 + i, i % 2) for i in range(50)] + [(5, None)][:0]
    out = {r.page_id: r for r in filter_urls(spark.createDataFrame(urls, "page_id bigint, url string"), (),
                                             spark.createDataFrame(bad, "page_id bigint, bad int")).collect()}
    assert {out[i].verdict for i in range(200)} == {"block"} and out[150].template == "/ads/{num}.html"
    assert {out[1000 + i].verdict for i in range(200)} == {"allow"} and out[1150].template == "/article/*"
    assert {out[2000 + i].verdict for i in range(200)} == {"allow"} and out[2150].template == "/*/page"


def test_similar_branches_merge_and_different_ones_do_not(spark):
    rows = [("h", [a, "{num}"], 100, 100, b) for a, b in (("a", 50), ("b", 52), ("c", 100))] + [("h", ["d"], 10, 0, 0), ("h", [], 1, 0, 0)]
    rows += [("k", [a], 50, 50, 10) for a in "xyz"]
    tree = {(r.host, tuple(r["shape"])): r.template for r in template_tree(
        spark.createDataFrame(rows, "host string, shape array<string>, pages bigint, labelled bigint, bad bigint")).collect()}
    assert tree[("h", ("c", "{num}"))] == "/c/{num}" and tree[("h", ("d",))] == "/d" and tree[("h", ())] == ""
    assert {tree[("k", (a,))] for a in "xyz"} == {"/{alike}"}


COUNTS = "host string, shape array<string>, pages bigint, labelled bigint, bad bigint"


def verdicts(spark, rows):
    from wordmill.llm.urls import judge_templates

    out = judge_templates(template_tree(spark.createDataFrame(rows, COUNTS))).collect()
    assert len(out) == len(rows)
    return {(r.host, tuple(r["shape"])): r.rejected for r in out}


def test_rare_branches_keep_their_own_verdict(spark):
    rows = [("h", ["big%d" % i, "x"], 100_000, 100, 0) for i in range(15)]
    rows += [("h", ["spam"], 900, 300, 300), ("h", ["fine"], 900, 300, 0)]
    rows += [("h", ["few%d" % i], 900, 0, 0) for i in range(20)]
    # the only labels are bad ones that a rule gave to one branch, or to a few
    rows += [("one", ["s%d" % i], 500, 0, 0) for i in range(60)] + [("one", ["de"], 300, 300, 300)]
    rows += [("three", ["s%d" % i], 50, 0, 0) for i in range(200)] + [("three", [d], 50, 50, 50) for d in ("de", "at", "ch")]
    out = verdicts(spark, rows)
    assert {k for k, bad in out.items() if bad} == {("h", ("spam",)), ("one", ("de",)), *(("three", (d,)) for d in ("de", "at", "ch"))}


def test_deep_branches_are_judged(spark):
    way = ["d%d" % i for i in range(8)] + ["seg"] * 3000
    rows = [("h", [*way, "spam"], 100, 100, 100), ("h", [*way, "fine"], 100, 100, 0), ("h", way, 10, 0, 0), ("h", [*way, "new", "y"], 10, 0, 0)]
    rows += [("k", [*way, "a"], 100, 100, 0), ("k", [*way, "b"], 100, 10, 0), ("k", way[:8], 5, 0, 0)]
    assert {k for k, bad in verdicts(spark, rows).items() if bad} == {("h", (*way, "spam"))}
    tree = {tuple(r["shape"]): r.template for r in template_tree(spark.createDataFrame(rows, COUNTS)).where("host = 'h'").collect()}
    assert tree[(*way, "spam")] == "/" + "/".join([*way, "spam"]) and tree[tuple(way)].startswith("/" + "/".join(way))


def test_empty(spark):
    assert filter_urls(spark.createDataFrame([], "page_id bigint, url string"), URL_RULES).count() == 0


@pytest.mark.parametrize("level", [1, 6, 9, 14])
def test_unlabelled_templates_are_not_rejected_at_any_depth(spark, level):
    pages = [(i, f"http://h{i % 9}.test/p{i}/", 1) for i in range(200)]
    deep = "/".join(f"d{k}" for k in range(level))
    pages += [(1000 + i, f"http://x.test/{deep}/good/{i}", 0) for i in range(10)] + [(2000 + i, f"http://x.test/{deep}/unknown/{i}", None) for i in range(10)]
    df = spark.createDataFrame([(i, u) for i, u, _ in pages], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, b) for i, _, b in pages if b is not None], "page_id bigint, bad int")
    got = {r.page_id: r.verdict for r in filter_urls(df, [], labels).collect()}
    assert all(got[i] == "allow" for i in got if i >= 1000)
