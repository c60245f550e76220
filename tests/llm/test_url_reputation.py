import compare
import llm_frames
import pytest

from txnrisk.llm import queries, sql, url_reputation

ALLOW, BLOCK = "allow", "block"


def pages(spark, urls):
    rows = [(i, u, "<p>", 1, "h", "v") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, n int, host string, verdict string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def judged(spark, urls, label_rows=()):
    outcomes = url_reputation.outcomes_of(labels(spark, list(label_rows)))
    rows = url_reputation.judge(pages(spark, urls), outcomes).collect()
    return {r.page_id: r for r in rows}


def test_hosts_paths_and_rules(spark):
    cases = [
        ("http://a.example.net/en/5?q", "a.example.net", "/en/5", "example.net/en/", ALLOW),
        ("HTTP://A.EXAMPLE.NET/EN/5#x", "a.example.net", "/EN/5", "net/", BLOCK),
        ("http://example.net", "example.net", "", None, ALLOW),
        ("http://net/", "net", "/", "net/", BLOCK),
        ("http://planet/", "planet", "/", None, ALLOW),
        ("http://x.example.com/de/1", "x.example.com", "/de/1", "example.com/de/", BLOCK),
        ("http://x.example.com/den/1", "x.example.com", "/den/1", None, ALLOW),
        ("http://b.org/fr/?a=/b", "b.org", "/fr/", "org/fr/", ALLOW),
        ("http://b.org/fr", "b.org", "/fr", None, ALLOW),
        ("a://b://c/d", "b:", "//c/d", None, ALLOW),
        ("x.net/en/", "", "", None, ALLOW),
        (None, "", "", None, ALLOW),
        ("", "", "", None, ALLOW),
        ("://", "", "", None, ALLOW),
        ("http://É.NET?a/b", "É.net", "", None, ALLOW),
        ("http://h/p\nq?r", "h", "/p\nq", None, ALLOW),
        ("http://h.net:80/", "h.net:80", "/", None, ALLOW),
    ]
    found = judged(spark, [c[0] for c in cases])
    for i, (_, *expected) in enumerate(cases):
        assert [found[i].host, found[i].path, found[i].rule, found[i].verdict] == expected, cases[i]


def test_a_bad_host_is_blocked_and_a_few_bad_pages_block_nothing(spark):
    urls = [f"http://bad.site.com/{i}" for i in range(100)]
    urls += [f"http://good.site.com/{i}.html" for i in range(100, 200)]
    urls += [f"http://new.site.com/{i}/" for i in range(200, 202)] + ["http://unseen.site.com/"]
    rows = [(i, 0, 0) for i in range(95)] + [(i, 1, 0) for i in range(95, 198)] + [(200, 1, 1), (201, None, 1)]
    found = judged(spark, urls, rows)
    by_host = {r.host: r.verdict for r in found.values()}
    assert by_host == {
        "bad.site.com": BLOCK, "good.site.com": ALLOW, "new.site.com": ALLOW, "unseen.site.com": ALLOW,
    }
    assert found[0].n_labelled == 100 and found[200].n_labelled == 2 and found[202].n_labelled == 0


def test_the_hosts_bound_by_hand(spark):
    """Two hosts of one domain: every prior is computed as by hand."""
    counts = [("a.x.com", "x.com", "com", 40, 30), ("b.x.com", "x.com", "com", 60, 6)]
    frame = spark.createDataFrame(counts, "host string, domain string, suffix string, n long, k long")
    found = {r.host: r for r in url_reputation.reputation(frame).collect()}

    def weight(groups):
        noise = [n * p * (1 - p) for n, _, p in groups]
        excess = sum((k - n * p) ** 2 - v for (n, k, p), v in zip(groups, noise, strict=True))
        rho = excess / sum(v * (n - 1) for (n, _, _), v in zip(groups, noise, strict=True))
        return min(1000, max(2, 1 / rho - 1)) if rho > 0 else 1000

    p = 37 / 102
    for _ in range(2):
        w = weight([(100, 36, p)])
        p = (36 + w * p) / (100 + w)
    w = weight([(40, 30, p), (60, 6, p)])
    for host, n, k in (("a.x.com", 40, 30), ("b.x.com", 60, 6)):
        mean = (k + w * p) / (n + w)
        low = mean - 1.645 * (mean * (1 - mean) / (n + w + 1)) ** 0.5
        assert found[host].low == pytest.approx(low, rel=1e-9)


def test_domains_and_suffixes(spark):
    hosts = ["www.a.co.uk", "a.com", "localhost", "u@b.c.de:80", "d.e.", ""]
    frame = spark.createDataFrame([(h,) for h in hosts], "h string")
    rows = frame.select(*url_reputation.domain_and_suffix(frame.h)).collect()
    assert [tuple(r) for r in rows] == [
        ("a.co.uk", "co.uk"), ("a.com", "com"), ("localhost", "localhost"), ("c.de", "de"),
        ("d.e", "e"), ("", ""),
    ]


def test_empty_and_repeated(spark):
    assert judged(spark, []) == {}
    twice = pages(spark, ["http://a/1"]).union(pages(spark, ["http://a/1"]))
    outcomes = url_reputation.outcomes_of(labels(spark, [(1, 1, 0), (1, 0, 0), (None, 0, 0), (2, None, None)]))
    rows = url_reputation.judge(twice, outcomes).collect()
    assert len(rows) == 2 and {r.n_labelled for r in rows} == {2}


def test_no_python_in_the_plan(spark):
    plan = queries.urls(spark, llm_frames.FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_queries_give_their_sqls_rows(spark, name):
    result = queries.queries()[name](spark, llm_frames.FOLDER)
    columns, rows = compare.spark_rows(result)
    assert (columns, rows) == compare.sql_rows(sql.oracle_sql()[name], llm_frames.FOLDER)
