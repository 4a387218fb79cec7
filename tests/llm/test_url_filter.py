"""URL parts, rules, shrinkage on odd rows. Whole tables are compared with SQL elsewhere."""

from daygrain.llm import url_filter


def test_parts_and_rules(spark):
    rows = [
        (1, "HTTPS://WWW.Example.COM/en/1?x#y", None), (2, "https://a.example.com/en/", None), (3, "https://example.com", None),
        (4, "https://b.net/fr/x", None), (5, "https://b.net/de/x", None), (6, None, None), (7, "no scheme", None),
        (8, "x://h?p://q", None), (9, "x://notexample.com/en/1", None), (10, "x://É.net/es/?", None), (10, "x://É.net/es/?", None),
    ]
    pages = spark.createDataFrame([(*r, "v") for r in rows], "page_id long, url string, good int, rules string")
    got = {r.page_id: r for r in url_filter.judge(pages, url_filter.rule_table(spark)).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert (got[2].rule, got[2].verdict) == ("example.com/en/", "block")
    assert (got[3].path, got[3].rule, got[3].verdict) == ("", None, "allow")
    assert got[4].rule == "net/fr/" and got[5].rule is None
    assert (got[6].host, got[6].path) == ("", "") == (got[7].host, got[7].path)
    assert (got[8].host, got[8].path) == ("h", "")
    assert got[9].rule == "com/" and got[10].host == "É.net"
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark)).collect() == []


def test_bad_hosts_are_blocked_and_unknown_ones_are_not(spark):
    rows = [(k, f"http://bad.x.org/{k}", int(k % 10 == 0)) for k in range(60)]
    rows += [(100 + k, f"http://good{k % 5}.y.org/{k}", int(k % 20 > 0)) for k in range(300)]
    rows += [(500, "http://new.x.org/1", None), (501, "http://new.z.co.uk/", None), (502, "http://one.y.org/", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, good int")
    got = {r.page_id: r for r in url_filter.judge(pages, url_filter.rule_table(spark, url_filter.RULES[:1]), outcome="good").collect()}
    assert {got[k].verdict for k in range(60)} == {"block"}
    assert {got[100 + k].verdict for k in range(300)} == {"allow"} == {got[502].verdict}
    assert got[0].reputation < got[500].reputation < got[501].reputation


def test_domains(spark):
    hosts = {"a.b.co.uk": ("b.co.uk", "co.uk"), "b.org": ("b.org", "org"), "org": ("org", "org"), "x.y.z.org": ("z.org", "org"), "": ("", "")}
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    for r in frame.select("host", url_filter.domain_of(frame.host), url_filter.suffix_of(frame.host)).collect():
        assert (r[1], r[2]) == hosts[r.host]


def test_suffixes_are_a_parameter(spark):
    frame = spark.createDataFrame([("shop.city.kawasaki.jp",)], "host string")
    row = frame.select(url_filter.domain_of(frame.host, ["kawasaki.jp"]), url_filter.suffix_of(frame.host, ["kawasaki.jp"])).first()
    assert tuple(row) == ("city.kawasaki.jp", "kawasaki.jp")


def test_pages_that_show_no_document(spark):
    """A third of the pages has no number and a third shows one document: neither is shuffled by that key."""
    shows = [None if k % 3 == 0 else "7" if k % 3 == 1 else str(k) for k in range(3000)]
    pages = spark.createDataFrame([(k, f"http://a.com/{k}", s) for k, s in enumerate(shows)], "page_id long, url string, at string")
    outcomes = spark.createDataFrame([("7", 1), ("2", 0), ("x", 1)], "shows string, outcome int")
    got = {r.page_id: r.outcome for r in url_filter.with_outcomes(pages, pages.at, outcomes).collect()}
    assert got == {k: {"7": 1, "2": 0}.get(s) for k, s in enumerate(shows)}
