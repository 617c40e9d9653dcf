import math

from pyspark.sql import functions as F

from aeris.llm.catalog import URL_RULES
from aeris.llm.url_filter import host_levels, host_reputation, judge_urls


def test_hosts_paths_and_longest_rule(spark):
    cases = {
        "http://WWW.Example.com/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://a.example.com/fr/": ("a.example.com", "/fr/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "https://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
        "https://xnet/es/1": ("xnet", "/es/1", None, "allow"),
        "https://x.net?/es/": ("x.net", "", None, "allow"),
        "mailto:someone": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "http://É.NET:80/fr/\n/y#": ("É.net:80", "/fr/\n/y", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(cases)], "page_id long, url string, good string")
    none = spark.createDataFrame([], "page_id long, good int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, none, URL_RULES).collect()}
    assert got == dict(enumerate(cases.values()))


def test_levels(spark):
    hosts = ["a.b.example.com", "example.com", "com", "x.shop.co.uk", "u:p@h.net:8080", "dot.org."]
    d, s = host_levels(F.col("h"))
    rows = spark.createDataFrame([(h,) for h in hosts], "h string").select(d.alias("d"), s.alias("s")).collect()
    assert [(r.d, r.s) for r in rows] == [("example.com", "com"), ("example.com", "com"), ("com", "com"), ("shop.co.uk", "co.uk"), ("h.net", "net"), ("dot.org", "org")]


def brute(counts):
    """counts: host -> (good, n), hosts of three labels."""
    def total(key):
        out = {}
        for h, (g, n) in counts.items():
            a, b = out.get(key(h), (0, 0))
            out[key(h)] = (a + g, b + n)
        return out

    prior = None
    for key in (lambda h: h.split(".")[-1], lambda h: h.split(".", 1)[1], lambda h: h):
        groups = total(key)
        if prior is None:
            p0 = (sum(g for g, _ in groups.values()) + 0.5) / (sum(n for _, n in groups.values()) + 1)
            ps = dict.fromkeys(groups, p0)
        else:
            ps = {k: next(prior[p] for p in prior if k == p or k.endswith("." + p)) for k in groups}
        excess = sum((g - n * ps[k]) ** 2 / (ps[k] * (1 - ps[k])) - n for k, (g, n) in groups.items())
        pairs = sum(n * (n - 1) for _, n in groups.values())
        s = min(max(1 / max(excess / pairs, 1e-9) - 1, 2), 1000) if pairs else 1000
        prior = {k: (s * ps[k] + g) / (s + n) for k, (g, n) in groups.items()}
        spread = {k: math.sqrt(prior[k] * (1 - prior[k]) / (s + n + 1)) for k, (_, n) in groups.items()}
    return prior, spread


def test_reputation_and_verdict_against_brute_force(spark):
    counts = {"a.x.com": (40, 50), "b.x.com": (1, 1), "c.y.com": (0, 60), "d.y.com": (0, 2), "e.z.net": (9, 10), "f.z.net": (0, 3)}
    rows = [(h, int(i < g)) for h, (g, n) in counts.items() for i in range(n)] + [("a.x.com", None)]
    mean, sd = brute(counts)
    for r in host_reputation(spark.createDataFrame(rows, "host string, good int")).collect():
        assert (r.good, r.n) == counts[r.host]
        assert math.isclose(r["mean"], mean[r.host], rel_tol=1e-7) and math.isclose(r.sd, sd[r.host], rel_tol=1e-7)
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, (h, _) in enumerate(rows)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, g) for i, (_, g) in enumerate(rows)] + [(None, 0), (10**6, 1)], "page_id long, good int")
    got = {r.host: r.verdict for r in judge_urls(pages, outcomes, []).collect()}
    assert got == {h: "block" if mean[h] + 2 * sd[h] < 0.5 else "allow" for h in counts}
    assert got["c.y.com"] == "block" and got["f.z.net"] == "allow"


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, spark.createDataFrame([], "page_id long, good int"), URL_RULES).count() == 0
