"""Near-duplicates, containment, nearest neighbours and url templates."""

import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from contraluz.llm import (benchmark_containment, near_duplicates, one_bit_codes, queries,
                           url_templates)
from contraluz.llm.hashing import Hasher
from tests.compare import compare, duck
from tests.llm.helpers import CLASHING, ODD_ROWS, frame, prose, words

SMALL = "/root/testdata/sf0.001"


def multiset(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else Counter(
        [tuple(w)] if w else [])


def near_classes(rows):
    sets, owner, up = [multiset(t) for _, t in rows], defaultdict(list), {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for n, s in enumerate(sets):
        shared = Counter()
        for k, c in s.items():
            for m in owner[k]:
                shared[m] += min(c, sets[m][k])
            owner[k].append(n)
        for m, both in shared.items():
            if both / (s.total() + sets[m].total() - both) >= 0.8:
                a, b = sorted((top(rows[n][0]), top(rows[m][0])))
                up[b] = a
    return {i: top(i) for i, _ in rows}


def changed(seed, text, n):
    w = text.split(" ")
    for i, new in enumerate(words(seed, n)):
        w[(17 * i + 5 * seed) % len(w)] = new
    return " ".join(w)


def test_near_duplicate_classes(spark):
    base, other = prose(1, 200), prose(2, 300)
    chain = [base]
    for i in range(6):  # each like the one before it, the ends unlike
        chain.append(changed(60 + i, chain[-1], 3))
    rows = [(i, t) for i, t in enumerate(chain)] + [
        (20 + i, changed(i, other, 2)) for i in range(30)] + [(60 + i, other) for i in range(30)
    ] + [(100 + i, prose(100 + i, 50) + " " + prose(5, 30)) for i in range(40)] + [
        (200, "That it."), (201, "That it."), (202, "one two three"), (203, prose(9, 9))]
    rows = [(i * 3 + 1, t) for i, t in rows]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(
        frame(spark, rows, **CLASHING)).collect()}
    assert got == near_classes(rows)


def edited(seed, text, share):
    """The words of a text, about that share of them replaced by words of its own."""
    rnd = random.Random(seed)
    return " ".join(f"{w}{seed}" if rnd.random() < share else w for w in text.split())


def test_large_groups_make_few_pairs(spark, monkeypatch):
    """Members that hardly anything links are compared in tasks, whatever their number."""
    base, rows = prose(71, 150), []
    for i in range(240):
        rows.append((i, edited(i, base, (0.005, 0.02, 0.04, 0.06)[i % 4])))
    formed, verified = [], near_duplicates.verified

    def counted(pairs, *rest):
        formed.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_duplicates, "verified", counted)
    monkeypatch.setattr(near_duplicates, "BLOCK", 50, raising=False)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(frame(spark, rows)).collect()}
    assert got == near_classes(rows)
    assert 1 < len(set(got.values())) < len(rows)
    assert sum(formed) <= 6 * len(rows), formed


def test_components_read_links_once_more_only_between_ends(spark, monkeypatch):
    """A long chain, a star and a loose net; later rounds hold few of their links."""
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(100)] + [(900, i) for i in range(200, 900)] + [
        (rnd.randint(1000, 1300), rnd.randint(1000, 1300)) for _ in range(400)] + [(7, 7)]
    near, sizes, keep = {}, [], near_duplicates.stored

    def counted(df):
        out = keep(df)
        if out.columns == ["a", "b"]:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(near_duplicates, "stored", counted)
    got = {r["node"]: r["label"] for r in near_duplicates.components(
        frame(spark, links, "a long, b long")).collect()}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    del near[7]
    near[7] = {6, 8}
    want = {}
    for n in sorted(near):
        todo = [] if n in want else [n]
        while todo:
            if want.setdefault(m := todo.pop(), n) == n:
                todo += [x for x in near[m] if x not in want]
    assert got == want
    assert sum(sizes) < 2 * sizes[0]


def test_near_duplicates_of_odd_rows(spark):
    got = [(r["doc_id"], r["class_id"]) for r in near_duplicates.classes(
        frame(spark, ODD_ROWS)).collect()]
    assert len(got) == len(ODD_ROWS)
    classes = dict(x for x in got if x[0] is not None)
    assert classes[0] == 0 and classes[1] == 1 and classes[2] == 2
    assert classes[4] == 4 and got.count((None, None)) == 2
    assert near_duplicates.classes(frame(spark, [])).count() == 0


def test_texts_of_one_id_are_classed_apart(spark):
    a, b, c = prose(1, 120), prose(2, 120), prose(3, 120)
    rows = [(9, a), (9, b), (9, c), (12, changed(1, a, 2)), (8, changed(2, b, 2)),
            (15, changed(3, c, 2)), (3, prose(4, 120)), (3, None)]
    got = sorted((r["doc_id"], r["class_id"]) for r in near_duplicates.classes(
        frame(spark, rows)).collect())
    assert got == [(3, 3), (3, 3), (8, 8), (9, 8), (9, 9), (9, 9), (12, 9), (15, 9)]


def test_clean_goes_by_the_text(spark):
    item = " ".join(words(70, 30))
    rows = [(1, prose(1, 40)), (1, item), (None, prose(2, 40)), (None, "so " + item), (2, None)]
    left = benchmark_containment.clean(
        frame(spark, rows), frame(spark, [(1, item)], "item_id long, text string")).collect()
    assert {tuple(r) for r in left} == {rows[0], rows[2], rows[4]} and len(left) == 3


def test_signatures_agree_as_often_as_weighted_sets_do():
    hasher = Hasher()
    a = " ".join(words(1, 300))
    b = changed(3, a, 12)
    c = " ".join(["again"] * 40 + words(4, 40))
    d = " ".join(["again"] * 20 + words(4, 40))
    regions, sizes = near_duplicates.shingles([t.encode() for t in (a, b, c, d)], hasher)
    k = 4000
    rows = near_duplicates.darts(regions, sizes, k)
    for x, y, s, t in ((0, 1, a, b), (2, 3, c, d), (0, 2, a, c)):
        x_, y_ = multiset(s), multiset(t)
        exact = (x_ & y_).total() / (x_ | y_).total()
        assert abs((rows[x] == rows[y]).mean() - exact) < 0.035


def test_containment_matches_its_sql(spark):
    name = "op6_benchmark_containment"
    frame_ = queries.QUERIES[name](spark, SMALL)
    assert compare(frame_, duck(SMALL), queries.SQL[name]) is None
    assert frame_.count() > 0
    plan = frame_._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_containment_of_planted_items(spark):
    item = " ".join(words(70, 30))
    partial = " ".join(words(70, 30)[:27] + words(71, 20))  # 23 of 26 shingles
    half = " ".join(words(70, 30)[:17] + words(72, 20))
    rows = ODD_ROWS + [(50, prose(1, 3000) + " " + item.upper() + " " + prose(2, 900)),
                       (51, partial), (52, half), (52, prose(4, 20)), (53, "That, it")]
    items = [(1, item), (2, None), (3, ""), (4, "that it"), (5, item), (None, item)]
    got = {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_shingles"])
           for r in benchmark_containment.contained(
               frame(spark, rows, **CLASHING),
               frame(spark, items, "item_id long, text string", hash="x")).collect()}
    assert got == {(50, 1): (26, 26), (50, 5): (26, 26), (51, 1): (23, 26), (51, 5): (23, 26),
                   (4, 4): (1, 1), (5, 4): (1, 1), (53, 4): (1, 1)}
    docs = frame(spark, rows, **CLASHING)
    left = benchmark_containment.clean(docs, frame(spark, items, "item_id long, text string"))
    assert left.columns == docs.columns
    assert left.count() == len(rows) - 7  # all rows of the ids 4, 5, 50, 51 and 53
    nothing = frame(spark, [], "item_id long, text string")
    assert benchmark_containment.clean(docs, nothing).count() == len(rows)
    assert benchmark_containment.contained(frame(spark, []), nothing).count() == 0


def test_least_hits_loses_no_item():
    assert benchmark_containment.least_hits(16, 0.8) >= 4
    assert benchmark_containment.least_hits(64, 0.8) > benchmark_containment.least_hits(32, 0.8)


def nearest(ids, vectors, k, each):
    out = {}
    for q in np.flatnonzero(ids % each == 0):
        scores = (vectors * vectors[q]).sum(axis=1)
        order = [x for x in np.lexsort((ids, -scores)) if x != q][:k]
        out[int(ids[q])] = [(int(ids[x]), float(scores[x])) for x in order]
    return out


@pytest.mark.parametrize("sizes", [{}, {"index_block": 150, "query_block": 11}])
def test_neighbours(spark, sizes):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(700, 24)).round(2)
    vectors[100:140] = vectors[99]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [
        (1000, None), (1001, []), (1002, [0.0] * 24), (1003, [float("nan")] * 24),
        (1004, [None] * 24), (1005, [float("inf")] + [0.0] * 23), (None, [1.0] * 24),
        (1020, [1.0, 2.0]), (5, vectors[5].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit("x"))
    got = defaultdict(list)
    for r in one_bit_codes.neighbours(df, F.col("vec_id") % 20 == 0, 20, **sizes).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    expected = nearest(np.arange(700), vectors, 20, 20)
    assert set(got) == set(expected)
    hits = 0
    for q, rows_ in got.items():
        rows_.sort()
        assert [r[0] for r in rows_] == list(range(1, 21))
        hits += len({r[1] for r in rows_} & {v for v, _ in expected[q]})
        for _, v, s in rows_:
            assert s == pytest.approx(float((vectors[v] * vectors[q]).sum()), abs=1e-12)
    assert hits >= 0.99 * 20 * len(expected)


@pytest.mark.parametrize("sizes", [{}, {"index_block": 40, "query_block": 2}])
@pytest.mark.parametrize("step", [0.0, 1e-3])
def test_repeated_ids_take_one_place(spark, sizes, step):
    rng = np.random.default_rng(8)
    ids = np.r_[np.arange(120), np.full(30, 7), np.full(30, 11), np.full(3, 40)]
    vectors = rng.normal(size=(len(ids), 16))
    vectors[[7, 11]] = 3 * vectors[[0, 0]]  # near the top for the query 0
    vectors[120:150] = vectors[7] + step * np.arange(30)[:, None]
    vectors[150:180] = vectors[11] - step * np.arange(30)[:, None]
    vectors[180:] = vectors[40] * (1 + step)  # a query of several rows
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)],
                               "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in one_bit_codes.neighbours(df, F.col("vec_id") % 20 == 0, 20, **sizes).orderBy(
            "query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == {0, 20, 40, 60, 80, 100}
    for q, found in got.items():
        best = {int(i): (vectors[ids == i] @ vectors[ids == q].T).max() for i in set(ids) - {q}}
        expected = sorted(best, key=lambda i: (-best[i], i))[:20]
        assert len(found) == len({v for v, _ in found}) == 20
        assert len({v for v, _ in found} & set(expected)) >= 19
        for v, s in found:
            assert s == pytest.approx(best[v], abs=1e-9)


def test_neighbours_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [-1.0])],
                               "vec_id long, embedding array<double>")
    got = [tuple(r) for r in one_bit_codes.neighbours(df, F.col("vec_id") % 20 == 0, 20)
           .orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -2.0)]
    assert one_bit_codes.neighbours(df.where("vec_id > 99"), F.col("vec_id") % 20 == 0, 5).count() == 0


def test_error_bounds_hold():
    rng = np.random.default_rng(1)
    vectors, asked = rng.normal(size=(3000, 64)), rng.normal(size=(40, 64))
    turn = one_bit_codes.rotation(64)
    estimate, error = one_bit_codes.bounds(*one_bit_codes.codes(vectors, turn), asked @ turn)
    assert (abs(asked @ vectors.T - estimate) <= error).mean() > 0.995


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]


def test_urls_and_rules(spark):
    urls = [None, "", "abc", "HTTP://A.Example.ORG/es/1?q#f", "x://example.org/en/12", "y://é.OrG",
            "z://com/fr/a", "z://badcom/fr/a", "z://b.com/de/#x", "a://b://c/d", "a://h.com/\nk",
            "a://shop.com:80/fr/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(3, urls[3])],
                               "page_id long, url string")
    df = df.withColumn("host", F.lit("mine")).withColumn("purity", F.lit("x"))
    rows = url_templates.judge(df, queries.URL_RULES).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        host, path = parsed(urls[r["page_id"]])
        best = max(((len(a + b), a + b, v) for v, a, b in queries.URL_RULES
                    if (host == a or host.endswith("." + a)) and path.startswith(b)),
                   default=(0, None, None))
        assert (r["host"], r["path"], r["rule"]) == (host, path, best[1])
        assert r["verdict"] == (best[2] or r["verdict"]) and r["verdict"] in ("allow", "block")
    assert url_templates.judge(df.where("page_id > 99"), queries.URL_RULES).count() == 0


def test_template_tree(spark):
    rows = [(f"s://h.com/shop/item{i}/buy/{i}.html", 1) for i in range(40)]  # many rare branches
    rows += [(f"s://h.com/de/{i}", 1) for i in range(30)] + [(f"s://h.com/fr/{i}", 1) for i in range(30)]
    rows += [(f"s://spam.net/de/{i}", 1) for i in range(30)] + [(f"s://h.com/en/{i}", 1) for i in range(9)]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    rules = [("block", "com", "/de/"), ("allow", "com", "/fr/"), ("block", "net", "/de/1")]
    found = {r["url"]: r for r in url_templates.judge(df, rules).collect()}
    assert found["s://h.com/shop/item3/buy/3.html"]["template"] == "/*/*/buy/{number}.html"
    assert found["s://h.com/de/7"]["template"] == "/de/{number}"
    assert found["s://h.com/fr/7"]["template"] == "/fr/{number}"
    assert found["s://h.com/fr/7"]["purity"] < 0.1 < 0.9 < found["s://h.com/de/7"]["purity"]
    assert found["s://spam.net/de/2"]["rule"] is None  # judged by its template
    assert found["s://spam.net/de/2"]["verdict"] == "block"
    assert found["s://h.com/en/3"]["verdict"] == "allow"


def plain_tree(counted):
    """The template tree level by level, row by row: {(host, typed): (template, purity)}."""
    U = url_templates
    w, z = U.WEIGHT, U.Z
    labelled, blocked = (sum(r[i] for r in counted) for i in (3, 4))
    overall, out = (blocked + w * .5) / (labelled + w), {}

    def share(b, n, up):
        return (b + w * up) / (n + w)

    def grow(rows, level, template, purity):
        groups = {}
        for r in rows:
            if len(r[1]) == level:
                out[r[0], r[1]] = (template, purity)
            else:
                groups.setdefault(r[1][level], []).append(r)
        sums = {s: [sum(r[i] for r in g) for i in (2, 3, 4)] for s, g in groups.items()}
        n, lab, blo = (sum(v[i] for v in sums.values()) for i in range(3))
        named = {}
        for s, (m, k, b) in sums.items():
            rare = len(sums) >= U.MANY_CHILDREN and m < U.RARE_SHARE * n
            own = s.startswith("{") or len(sums) == 1
            if not own and k >= (U.FEW if rare else 1):
                p = blo / lab
                own = abs(b / k - p) > z * (p * (1 - p) * (1 / k - 1 / lab)) ** .5
            named.setdefault(s if own else "*", []).extend(groups[s])
        for name, part in named.items():
            grow(part, level + 1, f"{template}/{name}",
                 share(sum(r[4] for r in part), sum(r[3] for r in part), purity))

    for host in {r[0] for r in counted}:
        own = [r for r in counted if r[0] == host]
        grow(own, 0, "", share(sum(r[4] for r in own), sum(r[3] for r in own), overall))
    return out


def test_template_tree_equals_a_plain_one(spark):
    import random
    rng = random.Random(8)
    counted = {}
    for _ in range(1500):
        host = rng.choice(["a.org", "b.com", "b.com"])
        path = tuple(rng.choice(["x", "y", "{number}", *(f"s{i}" for i in range(30))])
                     for _ in range(rng.choice([0, 1, 2, 3, 4])))
        if rng.random() < .2:
            path = ("long",) * 6 + path + ("tail",) * rng.randrange(3)
        n = rng.randrange(1, 30)
        k = rng.choice([0, rng.randrange(n + 1)])
        b = min(k, rng.randrange(n)) if "x" in path else rng.randrange(k + 1) // 4
        counted[host, path] = (host, path, n, k, b)
    counted["a.org", ("deep",) * 1500] = ("a.org", ("deep",) * 1500, 1, 1, 1)
    counted["a.org", ("deep",) * 2000] = ("a.org", ("deep",) * 2000, 2, 0, 0)
    rows = list(counted.values())
    df = spark.createDataFrame([(h, list(p), n, k, b) for h, p, n, k, b in rows],
                               "host string, typed array<string>, n long, labelled long, blocked long")
    found = {(r["host"], tuple(r["typed"])): (r["template"], r["purity"])
             for r in url_templates.template_tree(df).collect()}
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    expected = plain_tree(rows)
    sys.setrecursionlimit(limit)
    assert found.keys() == expected.keys()
    for key, (template, purity) in expected.items():
        assert found[key][0] == template and abs(found[key][1] - purity) < 1e-9


def test_urls_of_any_form_and_length(spark):
    urls = [None, "", "no scheme", "://", "a://b://c/d", "s://H.ORG", "s://é😀/p?q", "S://h/p#f?g",
            "é😀" * 300_000, "é😀" * 8000 + "://Host.com" + "/é😀" * 2000, "x://" + "a.b" * 200_000 + "/p"]
    df = frame(spark, list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"]) for r in df.select(
        "page_id", url_templates.host_of(F.col("url")).alias("host"),
        url_templates.path_of(F.col("url")).alias("path")).collect()}
    for i, url in enumerate(urls):
        head, found, rest = (url or "").partition("://")
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        assert got[i] == ("".join(c.lower() if "A" <= c <= "Z" else c for c in host), path)
    assert url_templates.judge(df, [("allow", "org", "/")]).count() == len(urls)


def test_templates_run_no_python(spark):
    df = frame(spark, [(1, "s://h.com/a/1"), (2, "s://h.com/b/2")], "page_id long, url string")
    rows = url_templates.judge(df, [("block", "h.com", "/a")])
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in ("Python", "Pandas", "InArrow"))
