import re

import pytest
from pyspark.sql import functions as F

from lettermon.llm import urls
from lettermon.llm.queries import URL_RULES

PAGES = "page_id long, url string, host string, verdict string, n string"
LABELS = "doc_id long, quality int, toxic int, good string"


def frames(spark, pages, labels):
    return (spark.createDataFrame([(*p, "x", "x", "x") for p in pages], PAGES),
            spark.createDataFrame([(*x, "y") for x in labels], LABELS))


URLS = ["https://A.Example.org/es/1?x#y", "http://example.org", "http://example.org?/en/1", "ftp://sub.site.com/fr/",
        "http://notcom/fr/", "//no.scheme/x", None, "", "x://h://i/j", "http://b.com:80/de/2#q", "http://B.COM/En/",
        "http://example.org/en/12", "http://example.org/en/2", "http://xexample.org/es/1", "http://x.org\n/es/é"]


def brute(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


def test_hosts_paths_and_rules(spark):
    pages, labels = frames(spark, list(enumerate(URLS)), [(i, 1, 0) for i in range(0, 15, 2)])
    got = {r["page_id"]: r for r in urls.filter_urls(pages, labels, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule = brute(url)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (rule.name if rule else None)
        assert got[i]["verdict"] == (rule.verdict if rule else "allow" if got[i]["bound"] >= 0.5 else "block")


def moment_weight(groups):
    groups = [(n, g) for n, g in groups if n]
    total, k = sum(n for n, _ in groups), len(groups)
    if k < 2 or total <= k:
        return urls.PRIOR_UNKNOWN
    p = sum(g for _, g in groups) / total
    between = sum(n * (g / n - p) ** 2 for n, g in groups) / (k - 1)
    within = sum(g * (1 - g / n) for n, g in groups) / (total - k)
    usual = (total - sum(n * n for n, _ in groups) / total) / (k - 1)
    if between + (usual - 1) * within <= 0:
        return urls.PRIOR_UNKNOWN
    rho = (between - within) / (between + (usual - 1) * within)
    return urls.PRIOR_MOST if rho <= 0 else min(max(1 / rho - 1, urls.PRIOR_LEAST), urls.PRIOR_MOST)


def test_shrinkage_against_plain_python(spark):
    counts = {"a.x.com": (40, 38), "b.x.com": (10, 1), "c.y.com": (1, 0), "d.z.org": (7, 7), "e.z.org": (0, 0), "": (3, 1)}
    rows, labels, page = [], [], 0
    for host, (n, good) in counts.items():
        for k in range(max(n, 1)):
            rows.append((page, f"http://{host}/{k}" if host else f"/{k}"))
            if n:
                labels.append((page, int(k < good), 0))
            page += 1
    pages, labels = frames(spark, rows, labels)
    got = {r["host"]: r for r in urls.filter_urls(pages, labels).collect()}

    def top(h, k):
        return ".".join(h.split(".")[-k:])
    domains, suffixes = {}, {}
    for h, (n, g) in counts.items():
        d = domains.setdefault((top(h, 1), top(h, 2)), [0, 0])
        d[0] += n
        d[1] += g
    for (s, _), (n, g) in domains.items():
        x = suffixes.setdefault(s, [0, 0])
        x[0] += n
        x[1] += g
    kh, kd, ks = (moment_weight(x.values()) for x in (counts, domains, suffixes))
    p = sum(g for _, g in counts.values()) / sum(n for n, _ in counts.values())
    for h, (n, g) in counts.items():
        sn, sg = suffixes[top(h, 1)]
        dn, dg = domains[top(h, 1), top(h, 2)]
        p_s = (sg + ks * p) / (sn + ks)
        p_d = (dg + kd * p_s) / (dn + kd)
        m = (g + kh * p_d) / (n + kh)
        bound = max(m - 1.645 * (m * (1 - m) / (n + kh + 1)) ** 0.5, 0)
        assert got[h]["bound"] == pytest.approx(bound, abs=1e-6)
        assert (got[h]["n_labels"], got[h]["n_good"]) == (n, g)


def test_suffix_list(spark):
    row = spark.createDataFrame([("a.b.co.uk:8080",), ("co.uk",), ("x",), ("",)], "host string")
    s, d = urls.domain_levels(F.col("host"), ["co.uk"])
    assert [tuple(r) for r in row.select(s, d).collect()] == [("co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("x", "x"), ("", "")]


def test_nulls_repeats_and_empty_tables(spark):
    pages, labels = frames(spark, [(1, "http://a.com/"), (1, "http://a.com/"), (None, "http://a.com/"), (2, None)],
                           [(1, None, 0), (1, 1, 0), (1, 1, 0), (None, 0, 1)])
    got = urls.filter_urls(pages, labels).collect()
    assert len(got) == 4 and {r["n_labels"] for r in got if r["host"] == "a.com"} == {4}
    none_p, none_l = pages.limit(0), labels.limit(0)
    assert urls.filter_urls(none_p, labels).collect() == []
    assert {r["n_labels"] for r in urls.filter_urls(pages, none_l).collect()} == {0}


def test_public_suffixes_and_addresses(spark):
    hosts = {"a.b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "x.github.io:80": ("github.io", "x.github.io"),
             "deep.x.github.io": ("github.io", "x.github.io"), "xco.uk": ("uk", "xco.uk"), "www.example.com": ("com", "example.com"),
             "10.0.0.1": ("[ip]", "10.0.0.1"), "10.0.0.1:8080": ("[ip]", "10.0.0.1"), "[::1]:443": ("[ip]", "[::1]"),
             "1.2.3": ("3", "2.3"), "localhost": ("localhost", "localhost"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r[0]: (r[1], r[2]) for r in df.select("host", *urls.domain_levels(F.col("host"), urls.PUBLIC_SUFFIXES)).collect()}
    assert got == hosts


def test_suffixes_in_the_sql(spark, tmp_path):
    """Priors of hosts under listed suffixes, and of addresses, are those of the registered query's SQL."""
    import random

    import duckdb

    from lettermon.llm.oracles import ORACLE_SQL
    from lettermon.llm.queries import op2_url_filter
    rng = random.Random(6)
    hosts = ["a.x.co.uk", "b.x.co.uk", "y.co.uk", "u.github.io", "v.github.io", "w.v.github.io", "10.0.0.1", "10.0.0.2:81", "[::1]",
             "s.example.net", "t.example.net", "other.net", "z.de"]
    pages = [(i, f"http://{rng.choice(hosts)}/p{i}", "<p>x") for i in range(400)] + [(400, None, None), (401, "none", "")]
    labels = [(i, int(rng.random() < 0.3 + 0.05 * hosts.index(pages[i][1].split("/")[2])), int(rng.random() < 0.1)) for i in range(0, 400, 2)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = op2_url_filter(spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op2_url_filter']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len({r[-1] for r in want}) > 8
