"""Operators that run in DataFrame functions alone, and top-k search."""

import numpy as np
import pytest

from tablewright.llm import license_scan, queries, topk, url_filter


@pytest.fixture(scope="module")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, data, duck, name):
    df = queries.QUERIES[name](spark, data)
    rel = duck.sql(queries.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[k] for k in order)) for r in rel.fetchall())


@pytest.mark.parametrize("name", ["op2_url_filter", "op7_license_scan"])
def test_no_python_on_the_executors(spark, data, name):
    plan = queries.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_rules(spark):
    urls = {
        "http://shop.EXAMPLE.com/en/1?x#y": ("shop.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "ftp://a.www.example.com/en/x": ("a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://a.com/": ("a.com", "/", "com/", "allow"),
        "http://acom/": ("acom", "/", None, None),
        "http://com/x": ("com", "/x", "com/", "allow"),
        "http://a.com": ("a.com", "", None, None),
        "http://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
        "http://a.net/es": ("a.net", "/es", None, None),
        "no address": ("", "", None, None),
        "http://a?b://c/d": ("a", "", None, None),
    }
    df = spark.createDataFrame([(k, u, "z") for k, u in enumerate([*urls, None])], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    for k, (host, path, rule, verdict) in enumerate(urls.values()):
        r = got[k]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and verdict in (None, r.verdict)
    assert (got[len(urls)].host, got[len(urls)].rule) == ("", None)
    assert url_filter.judge(df.limit(0)).count() == 0


def test_model_learns(spark):
    rng = np.random.default_rng(5)

    def word(letters):
        return "".join(rng.choice(list(letters), 12))

    rows = [(4 * k + j, f"http://{word('abcde')}.com/{word('abcde')}") for k in range(40) for j in range(4)]
    rows += [(1000 + k, f"http://x.example.com/en/{word('vwxyz')}") for k in range(160)]
    rows += [(2000 + k, f"http://{word('abcde')}.org/{word('abcde')}") for k in range(50)] + [(3000 + k, f"http://{word('vwxyz')}.org/{word('vwxyz')}") for k in range(50)]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert sum(got[2000 + k] == "allow" for k in range(50)) >= 48 and sum(got[3000 + k] == "block" for k in range(50)) >= 48


def test_licenses(spark):
    mit = dict(license_scan.TEXTS)["MIT"]
    wrapped = "# The MIT Licence\n#\n# Copyright (c) 2020 Somebody Else\n# All rights reserved.\n\n" + "\n".join(" ".join(mit.split()[i : i + 9]) for i in range(0, len(mit.split()), 9)).upper().replace('"', "”")
    rows = [(1, wrapped), (2, mit), (3, mit + " x"), (4, None), (5, ""), (6, "words\n  released under the MIT LICENCE\nAll rights reserved.\nmore"), (7, "é" * 100_000), (2, mit)]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, license string")
    got = [(r.doc_id, r.license, r.notices, r.n_notices) for r in license_scan.scan(df).collect()]
    assert sorted(got, key=repr) == sorted([(1, "MIT", "reserved", 1), (2, "MIT", "", 0), (2, "MIT", "", 0), (3, None, "", 0), (4, None, "", 0), (5, None, "", 0), (6, None, "MIT,reserved", 2), (7, None, "", 0)], key=repr)
    assert license_scan.scan(df.limit(0)).count() == 0
    assert license_scan.scan(df, notices=()).where("n_notices > 0").count() == 0


def brute(ids, vectors, queries_, k):
    out = set()
    for q, x in queries_:
        if x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        scored = []
        for i, y in zip(ids, vectors, strict=True):
            if i is None or i == q or y is None or any(c is None or not np.isfinite(c) for c in y):
                continue
            n = min(len(x), len(y))
            scored.append((-sum(int(np.floor(256 * x[j])) * int(np.floor(256 * y[j])) for j in range(n)), i))
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out.add((q, rank, i, -s))
    return out


@pytest.mark.parametrize("kind", ["clusters", "norms", "ties", "big", "few"])
def test_topk(spark, kind):
    rng = np.random.default_rng(7)
    n = 4 if kind == "few" else 1500
    x = rng.normal(size=(n, 6))
    if kind == "clusters":
        x = np.repeat(rng.normal(size=(n // 10, 6)), 10, 0)[:n] + 0.01 * x
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "norms":
        x *= np.exp(rng.normal(size=(n, 1)) * 2)
    if kind == "ties":
        x = np.round(x)
    if kind == "big":
        x *= 1e4
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(n, None), (n + 1, [1.0, None]), (n + 2, [float("nan")] * 6), (n + 3, [float("inf")] + [0.0] * 5), (None, [9.0] * 6), (n + 4, [0.0] * 6), (n + 5, [3.0, 1.0]), (n + 6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as score", "1 as rank", "vec_id as id", "2 as part")
    step = 2 if kind == "few" else 100
    asked = [(k, v) for k, v in rows if k is not None and k % step == 0]
    got = {tuple(r) for r in topk.search(df, df.where(f"vec_id % {step} = 0"), k=5).collect()}
    assert got == brute([k for k, _ in rows], [v for _, v in rows], asked, 5)


def test_topk_of_repeated_queries(spark):
    """Each row of the queries has ranks of its own; rows with its id are left out, repeated candidates count one by one."""
    x = np.random.default_rng(1).normal(size=(60, 4))
    rows = [(k // 2 if k < 20 else k, v.tolist()) for k, v in enumerate(x)] + [(59, x[59].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.search(df, df.where("vec_id < 5 or vec_id = 59")).collect())
    want = []
    for q, v in rows:
        if q < 5 or q == 59:
            scored = sorted((-sum(int(np.floor(256 * a)) * int(np.floor(256 * b)) for a, b in zip(v, w, strict=True)), k) for k, w in rows if k != q)
            want += [(q, rank, k, -s) for rank, (s, k) in enumerate(scored[:5], 1)]
    assert got == sorted(want)


def test_topk_of_large_components(spark):
    """Sums are exact beyond floating point and beyond 64 bits; scores end at the range's ends."""
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**40, 3.0]), (2, [2.0**40, 2.0]), (3, [-(2.0**40), 0.0]), (4, [1e300, 0.0]), (5, [1e-3, 0.0]), (6, [2.0**22, 1.0]), (7, [2.0**22, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    end = 2**63 - 1

    def whole(v):
        return [max(-(2**63), min(end, int(np.floor(256 * c)))) for c in v]

    got = {tuple(r) for r in topk.search(df, df.where("vec_id in (0, 6)"), k=7).collect()}
    want = set()
    for q in (0, 6):
        scored = sorted((-sum(a * b for a, b in zip(whole(rows[q][1]), whole(v), strict=True)), k) for k, v in rows if k != q)
        want |= {(q, rank, k, max(-end - 1, min(end, -s))) for rank, (s, k) in enumerate(scored, 1)}
    assert {(q, k, s) for q, _, k, s in got} == {(q, k, s) for q, _, k, s in want}


def test_topk_verifies_few_products():
    """Of unit vectors in no special direction, coordinate pruning leaves a small part to be verified in full."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4096, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.int64)
    best = topk.Best(np.arange(40), x[:40], 5)
    met = [best.meet(np.arange(k, k + 1024), x[k : k + 1024]) for k in range(0, 4096, 1024)]
    left, verified = (sum(m[i] for m in met[1:]) for i in (0, 1))
    assert left == 40 * 3072 and verified < 0.3 * left
    for q in range(40):
        scores = x @ x[q]
        assert [(s, k) for s, k in best.top[q]] == sorted((-int(scores[k]), k) for k in range(4096) if k != q)[:5]


def test_topk_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(df, df).count() == 0


def test_whole_texts_of_usual_licenses(spark):
    from tablewright.llm.license_texts import WHOLE

    wrapped = {n: "Copyright (c) 2024 Someone\n\n" + t.replace("\n", "\r\n// ") for n, t in WHOLE.items()}
    bsd = dict(license_scan._bsd())
    cut = WHOLE["Apache-2.0"].split("APPENDIX:")[0]
    texts = [*wrapped.items(), *bsd.items(), ("Apache-2.0", cut), ("GPL-2.0", WHOLE["GPL-2.0"].split("How to Apply These Terms")[0]), (None, cut[:-200])]
    got = {r.doc_id: r.license for r in license_scan.scan(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id long, text string")).collect()}
    assert got == {k: n for k, (n, _) in enumerate(texts)}


def test_usual_headers(spark):
    apache = '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.'
    mpl = " * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"
    texts = [(apache, "Apache-2.0"), (mpl, "MPL-2.0"), ("/* SPDX-License-Identifier: GPL-2.0-only */\nint x;", "GPL-2.0-only"), ("<!-- SPDX-License-Identifier: BSD-3-Clause -->", "BSD-3-Clause"), ("an SPDX line", "")]
    got = {r.doc_id: r.notices for r in license_scan.scan(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string")).collect()}
    assert got == {k: n for k, (_, n) in enumerate(texts)}
