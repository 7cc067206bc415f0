import re

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dqloom.llm import licenses, url_filter
from dqloom.llm.license_texts import FULL, NOTICES

from .helpers import table


def brute_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
        host, slash, tail = rest.partition("/")
        path = slash + tail
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for action, rule in url_filter.RULES:
        at, slash, tail = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + tail) and (best is None or len(rule) > len(best[1])):
            best = (action, rule)
    return host, path, best


URLS = [
    "http://a.example.com/en/7", "http://A.EXAMPLE.com/en/8", "https://x.net/de/1", "https://example.net/de/8?x", "http://b.example.net/de/81", "http://shop.org/es/", "http://shop.org/es", "http://notcom/en/", "http://com/en/1", "ftp://x.com#/en/",
    None, "", "no scheme.com/en/", "http://", "http://?a", "a://b://c.com/en/", "http://ünï.com/en/é?q#f", "http://x.com/EN/1", "http://y.com\n.org/es/z", "http://spam-casino.example.info/free", "http://x.com/en/" + "a" * 100_000,
]


def test_rules_hosts_and_paths_match_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").withColumns({"host": F.lit(1), "key": F.lit(2), "score": F.lit(3)})
    for r in url_filter.filter_urls(df).collect():
        host, path, best = brute_rule(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        assert r.verdict == best[0] if best else r.verdict == ("block" if r.score > 0.5 else "allow")
    assert url_filter.filter_urls(df.limit(0)).count() == 0 and url_filter.filter_urls(df.union(df)).count() == 2 * len(URLS)


def test_the_regression_generalises():
    rows = url_filter.labelled_urls()
    order = np.random.default_rng(0).permutation(len(rows))
    train, test = [rows[i] for i in order[::2]], [rows[i] for i in order[1::2]]
    weights = url_filter.train(train)
    p = url_filter.block_probability(weights, pa.array([r[0] for r in test]), pa.array([r[1] for r in test]))
    y = np.array([r[2] for r in test])
    assert ((p > 0.5) == y).mean() > 0.9
    whole = url_filter.train(rows)
    seen = url_filter.block_probability(whole, pa.array(["www.cheap-pills.shop", "spam-farm.example.org", "university.example.org", "thatre.example.com"]), pa.array(["/en/1", "/de/2", "/en/3", "/fr/4"]))
    assert (seen > 0.5).tolist() == [True, True, False, False]


def variants(text):
    return ["Copyright (c) 2020 Someone\n\n" + text.upper(), "(C) 1999 X. All rights reserved.\n" + re.sub(r"\s+", "  ", text).replace(",", " ,"), text.replace("sublicense", "sub-license").replace("acknowledgment", "acknowledgement")]


def test_license_texts_in_all_spellings(spark):
    texts, want = [], []
    for name, body in FULL:
        for v in [body, *variants(body)]:
            texts.append(v)
            want.append(name)
    texts += [None, "", "some other text", FULL[0][1] + " extra", "x\nReleased under the MIT Licence.\nLICENSED UNDER CC BY-NC 4.0\nReleased under the MIT License.\n", "ordinary " * 50_000]
    got = [tuple(r) for r in licenses.scan(table(spark, texts)).orderBy("doc_id").select("license_id", "n_license_lines", "line_licenses").collect()]
    n = len(want)
    assert [g[0] for g in got[:n]] == want
    assert [g[0] for g in got[n:]] == [None] * 6 and got[n + 4] == (None, 3, "CC-BY-NC-4.0,MIT") and got[n] == (None, 0, "")


def test_license_scan_matches_sql_and_a_large_known_table(spark, monkeypatch):
    texts = [None, "a\nReleased under the MIT License.", FULL[2][1], "Copyright 2020\n", "", "x\n\n" + NOTICES[3][1]]
    df = table(spark, [*texts, texts[1]], [*range(len(texts)), 1])
    con = duckdb.connect()
    documents = df.toPandas()  # noqa: F841
    want = sorted(con.sql(licenses.scan_sql()).fetchall(), key=str)
    assert sorted(map(tuple, licenses.scan(df).collect()), key=str) == want
    monkeypatch.setattr(licenses, "KNOWN_MOST", 5)
    assert sorted(map(tuple, licenses.scan(df.withColumn("row_", F.lit(1))).collect()), key=str) == want
    assert licenses.scan(df.limit(0)).count() == 0


def test_long_lists_of_rules_and_no_labelled_urls(spark):
    many = tuple(("block", f"host{i}.com/a") for i in range(3000)) + url_filter.RULES
    df = spark.createDataFrame([(1, "http://x.host2999.com/abc"), (2, "http://host1.com/b"), (3, "http://a.example.com/en/7"), (4, "ftp://q.com/x")], "page_id bigint, url string")
    got = {r.page_id: (r.rule, r.verdict, r.score) for r in url_filter.filter_urls(df, many, labelled=[]).collect()}
    assert got == {1: ("host2999.com/a", "block", 0.5), 2: (None, "allow", 0.5), 3: ("example.com/en/7", "allow", 0.5), 4: (None, "allow", 0.5)}


def test_only_lines_of_holders_are_left_out(spark):
    isc = dict(FULL)["ISC"]
    one_line = re.sub(r"\s+", " ", isc)
    wrapped = dict(FULL)["MIT"].replace("The above copyright notice", "The above\ncopyright notice")
    commented = "# Copyright (c) 2024 Some Holder\n#\n" + "".join(f"# {line}\n" for line in isc.split("\n"))
    altered = isc.replace("copyright notice and this permission notice appear in all copies", "copyright terms that differ entirely")
    shout = dict(FULL)["MIT"].replace("\nAUTHORS OR COPYRIGHT HOLDERS", " AUTHORS OR\nCOPYRIGHT HOLDERS")
    texts = [one_line, wrapped, commented, altered, shout, "© 2019 Y\n" + isc, "Copyright [yyyy] [name]\n" + isc, "(c) you must keep this.\n" + isc, "Copyright 2020 X " + "and words " * 40 + "\n" + isc]
    df = table(spark, texts)
    got = [r.license_id for r in licenses.scan(df).orderBy("doc_id").collect()]
    assert got == ["ISC", "MIT", "ISC", None, "MIT", "ISC", "ISC", None, None]
    documents = df.toPandas()  # noqa: F841
    assert sorted(map(str, duckdb.connect().sql(licenses.scan_sql()).fetchall())) == sorted(map(str, map(tuple, licenses.scan(df).collect())))
