"""Hard negatives, URL templates and ranked search against SQL and plain Python."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import connect, difference
from tradewind.llm import lexical, negatives, queries, url_templates

NEW = {"op11_hard_negatives": negatives.OP11_SQL, "op12_url_filter": url_templates.OP12_SQL,
       "op13_ranked_search": lexical.OP13_SQL}


@pytest.mark.parametrize("name", sorted(NEW))
def test_query_matches_sql(spark, sf_dir, name):
    sf = "/root/testdata/sf0.01" if name == "op11_hard_negatives" else sf_dir
    assert difference(queries.QUERIES[name](spark, sf), connect(sf), NEW[name]) is None


# ---------------------------------------------------------------- hard negatives

def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        keys = negatives.hilbert_keys(cells, bits)
        path = cells[np.lexsort(keys.T[::-1])]
        assert set(np.abs(np.diff(path, axis=0)).sum(axis=1).tolist()) == {1}


def test_bounds_hold_and_are_reached():
    rng = np.random.default_rng(5)
    anchors, points = rng.integers(-90, 90, (20, 6)), rng.integers(-90, 90, (30, 6))
    least, most = negatives.bounds(anchors, points.min(axis=0)[None], points.max(axis=0)[None])
    scores = anchors @ points.T
    assert (scores >= least).all() and (scores <= most).all()
    corner = np.where(anchors > 0, points.max(axis=0), points.min(axis=0))
    assert np.allclose((anchors * corner).sum(axis=1), most[:, 0], atol=1)


def test_products_are_exact_for_large_components():
    big = np.array([[2 ** 28, -(2 ** 28), 3], [1, 2, 2 ** 27 + 1]])
    assert negatives.products(big, big).tolist() == [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in big] for a in big]


def _mined(rows, every=4, positives=5, wanted=5, scale=256.0):
    """(anchor, positive, rank, negative, scores) by looking at all pairs."""
    seen = []
    for i, label, vector in rows:
        if None in (i, label) or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        point = tuple(math.floor(scale * x) for x in vector)
        if sum(x * x for x in point) < 2 ** 59 and (i, label, point) not in seen:
            seen.append((i, label, point))
    out = []
    for i, label, a in seen:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), j, own) for j, own, b in seen if j != i and len(a) == len(b))
        for minus, j, _ in [s for s in scored if s[2] == label][:positives]:
            window = [s for s in scored if s[2] != label and 80 * -minus <= 100 * -s[0] <= 100 * -minus][:wanted]
            out += [(i, j, rank, other, -minus, -score) for rank, (score, other, _) in enumerate(window, 1)]
    return sorted(out)


def _vectors():
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(6, 5))
    rows = [(i, int(i % 3), [float(x) for x in (centers[i % 6] + 0.3 * rng.normal(size=5))]) for i in range(300)]
    same = rows[8][2]
    rows += [(1000 + i, int(i % 2), same) for i in range(120)]      # one vector very often: ties by id
    rows += [(8, rows[8][1], same), (8, rows[8][1], same)]          # repeated rows
    rows += [(2000, 1, [1e6] * 5), (2001, 2, [1e6] * 5), (2004, 1, [1e300] * 5), (2008, 0, [0.0] * 5)]
    rows += [(3000, 1, [0.5, 0.5]), (3001, 1, [0.5, 0.6]), (3002, 2, [0.5, 0.5]), (3004, 0, [])]
    rows += [(4000, None, same), (4004, 1, None), (None, 1, same), (4008, 1, [1.0, None, 1.0, 1.0, 1.0]),
             (4012, 1, [float("nan")] * 5), (4016, 1, [float("inf")] * 5)]
    return rows


@pytest.mark.parametrize("zone_bytes", [negatives.ZONE_BYTES, 0])
def test_hard_negatives_against_all_pairs(spark, rows, monkeypatch, zone_bytes):
    """Blocks of few rows, and both ways to route anchors."""
    monkeypatch.setattr(negatives, "ZONE_BYTES", zone_bytes)
    monkeypatch.setattr(negatives, "BLOCK", 8)
    given = _vectors()
    # Extra columns with the names the operator uses itself.
    df = spark.createDataFrame(given, "id bigint, label int, vector array<double>").withColumns(
        {name: F.lit("x") for name in ("key", "score", "region", "rank", "dims", "point")})
    got = negatives.hard_negatives(df, F.col("id") % 4 == 0)
    assert rows(got) == _mined(given)


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert negatives.op11_hard_negatives(empty).collect() == []
    alone = spark.createDataFrame([(100, [1.0], 1)], "vec_id bigint, embedding array<float>, label int")
    assert negatives.op11_hard_negatives(alone).collect() == []


def test_zone_maps_leave_out_regions(spark):
    """Four directions far apart: an anchor's windows reach the regions of its own direction only."""
    rng = np.random.default_rng(3)
    rows = [(i, i // 4 % 2, [float(x) for x in np.eye(4)[i % 4] * 2 + 0.01 * rng.normal(size=4)]) for i in range(400)]
    points = negatives.integer_points(spark.createDataFrame(rows, "id bigint, label int, vector array<double>"))
    blocks = negatives.blocks_of(points, 8).cache()
    anchor = points.where("id = 0").select(F.lit(1).cast("bigint").alias("key"), "id", "label", "dims", "point").withColumns(
        {"floors": F.array(F.lit(200_000).cast("bigint")), "tops": F.array(F.lit(300_000).cast("bigint"))})
    routed = negatives._routes(anchor, blocks, same_label=False).count()
    regions = blocks.where("n = 0").count()
    assert regions > 4 and 0 < routed < regions / 2


# ---------------------------------------------------------------- URLs

def _rule(url, rules=url_templates.RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


URLS = [
    "http://a.COM/x", "https://com/", "http://com", "http://example.com/en/1", "http://www.example.com/en/1",
    "http://m.www.example.com/en/1?a=/de/", "http://xexample.com/en/", "http://n.net/es/x#/fr/", "http://n.net/es", "ftp://net/fr/",
    "//n.net/es/", "n.net", "", None, "http://", "http:///es/", "http://ÄB.net/fr/é", "http://a.com:80/x", "http://u@n.net/es/1/2/3/4/5/6/7/8/9",
    "http://x.net?/es/", "a://b://c/es/", "http://n.net/es/\nnew", "http://n.net/" + "long/" * 3000]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, url) for i, url in enumerate(URLS * 2)], "page_id bigint, url string")
    got = {r.page_id: r for r in url_templates.op12_url_filter(df).collect()}
    assert len(got) == 2 * len(URLS)
    for i, url in enumerate(URLS * 2):
        host, path, rule, verdict = _rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (verdict or "allow")


def test_templates_generalise_merge_and_reject(spark):
    spam = [(f"http://shop.net/offer/{'abcdefghijklmnopqrstuvwxyz'[i % 26]}word{'xyzuvw'[i % 6]}/", "block") for i in range(60)]
    fine = [(f"http://shop.net/help/{i}", "allow") for i in range(30)]
    near = [(f"http://shop.net/deal/{i}", "block") for i in range(30)] + [(f"http://shop.net/sale/{i}", "block") for i in range(30)]
    rows = [(url, label) for url, label in spam + fine + near] + [
        ("http://shop.net/offer/unseen/", None), ("http://shop.net/help/new", None), ("http://shop.net/sale/99", None),
        ("http://other.net/offer/q/", None)]
    df = spark.createDataFrame(rows, "url string, label string")
    host, path = url_templates.host_and_path(F.col("url"))
    urls = df.select("url", host.alias("host"), url_templates.path_shape(path).alias("shape"), "label")
    got = {r.url: r for r in urls.join(url_templates.template_verdicts(urls), ["host", "shape"]).collect()}
    unseen = got["http://shop.net/offer/unseen/"]
    assert unseen.template == "/offer/*/" and unseen.rejected
    # Different templates: under /help there is no wide node, and its own labels are all "allow".
    assert not got["http://shop.net/help/new"].rejected and not got["http://shop.net/help/3"].rejected
    assert got["http://shop.net/sale/99"].template == "/{deal|sale}/#" and got["http://shop.net/sale/99"].rejected
    assert not got["http://other.net/offer/q/"].rejected


def test_urls_with_clashing_columns_and_empty(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "rule_host string, rule_path string, rule_verdict string")
    df = spark.createDataFrame([(1, "http://a.net/x", "mine")], "page_id int, url string, host string").withColumn(
        "host_given", F.lit("other"))
    row = url_templates.judge(df, rules).first()
    assert (row.host, row.host_given, row.host_given_given, row.verdict) == ("a.net", "other", "mine", "block")
    assert url_templates.op12_url_filter(df.select("page_id", "url").limit(0)).collect() == []


def test_template_sql_on_wide_and_mixed_hosts(spark, tmp_path):
    """Every branch of the method, against the SQL."""
    urls = [f"http://h{i % 3}.net/{['es', 'fr', 'de', 'en'][i % 4]}/{'s' * (i % 7 + 1)}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}/{i}" for i in range(600)]
    urls += [f"http://h1.net/es{'/q' * (i % 9)}" for i in range(40)] + URLS
    spark.createDataFrame([(i, url) for i, url in enumerate(urls)], "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = url_templates.op12_url_filter(spark.read.parquet(f"{tmp_path}/pages.parquet"))
    assert difference(got, connection, url_templates.OP12_SQL) is None


# ---------------------------------------------------------------- ranked search

_TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _ranked(docs, items, k):
    held = [(i, Counter(_terms(text)), len(_terms(text))) for i, text in docs if _terms(text)]
    total, length = len(held), sum(n for _, _, n in held)
    df = Counter(term for _, counts, _ in held for term in counts)
    out = []
    for item, text in set(items):
        scored = []
        for doc, counts, n in held:
            m = 75 + 25 * n * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
                for t in _terms(text) if counts[t])
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_terms():
    for text in ("", "A-b_c 1,2", "É\x00ÉÀ`x{y}~\x7fz", "日本 İ K", "\x85a\xa0b", "a" * 5000):
        assert [term.decode() for term in lexical.terms_of(text)] == _terms(text)


def _texts():
    rng = np.random.default_rng(2)
    words = np.array([f"w{i}" for i in range(300)])
    shares = 1 / np.arange(1, 301)
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 60), p=shares / shares.sum()))) for i in range(500)]
    docs += [(1000 + i, docs[7][1]) for i in range(150)]                    # ties
    docs += [(9, docs[9][1]), (9, "W1 w1"), (None, docs[9][1]), (None, None), (2000, ""), (2001, None), (2002, " .-\n")]
    docs += [(2003, " ".join(rng.choice(words, 20_000))), (2004, "x" * 100_000 + " w5"), (2005, "İw1 É,w2")]
    items = [(i, docs[i * 7][1]) for i in range(40)] + [
        (0, docs[0][1]), (1, "w1 w1 w1 w299"), (2, "w1"), (3, None), (4, ""), (5, "unknown terms"), (None, "w3"), (6, "É İw1")]
    return docs, items


@pytest.mark.parametrize("k", [1, 20, 5000])
def test_ranking_against_plain_python(spark, monkeypatch, k):
    """Several parts and blocks of items; a small bitmap, so that it lets other terms through."""
    monkeypatch.setattr(lexical, "BITMAP_BITS", 16)
    monkeypatch.setattr(lexical, "ITEM_TERMS", 50)
    docs, items = _texts()
    # Extra columns with names the operator uses itself.
    given = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({name: F.lit(1) for name in ("n", "terms", "part")})
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumns({name: F.lit(1) for name in ("key", "term", "times")})
    got = [tuple(row) for row in lexical.ranked(given, asked, k).collect()]
    # Of documents with one id and score either may come first.
    assert sorted(got, key=str) == sorted(_ranked(docs, items, k), key=str)


def test_ranking_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        assert lexical.op13_ranked_search(d, i).collect() == []


def _tree(leaf):
    docs, items = _texts()
    held = [Counter(_terms(text)) for _, text in docs if _terms(text)]
    words = {term: i for i, term in enumerate(sorted({t for counts in held for t in counts}))}
    offsets = np.concatenate([[0], np.cumsum([len(counts) for counts in held])])
    terms = np.array([words[t] for counts in held for t in sorted(counts)])
    tfs = np.array([counts[t] for counts in held for t in sorted(counts)])
    m = np.array([75 + sum(counts.values()) for counts in held])
    asked = [Counter(words[t] for t in _terms(text) if t in words) for _, text in items]
    asked = [counts for counts in asked if counts]
    return (lexical.FpTree(m, offsets, terms, tfs, leaf), m, offsets, terms, tfs,
            np.concatenate([[0], np.cumsum([len(c) for c in asked])]),
            np.array([t for c in asked for t in sorted(c)]), np.array([c[t] * 10 for c in asked for t in sorted(c)]))


@pytest.mark.parametrize("leaf", [1, 8, 10_000])
def test_tree_holds_every_document_once_and_bounds_hold(leaf):
    tree, m, offsets, terms, tfs, *items = _tree(leaf)
    assert sorted(tree.docs.tolist()) == list(range(len(m)))
    todo, leaves = [tree.root], defaultdict(int)
    while todo:
        node = todo.pop()
        most = dict(zip(node.terms.tolist(), node.most.tolist()))
        inside = slice(tree.offsets[node.start], tree.offsets[node.end])
        assert all(most[t] >= tf for t, tf in zip(tree.paths[inside].tolist(), tree.tfs[inside].tolist()))
        assert node.least_m == tree.m[node.start:node.end].min()
        if node.children:
            assert [c.start for c in node.children] == [node.start, *[c.end for c in node.children[:-1]]]
            assert node.children[-1].end == node.end
        else:
            leaves[node.start] += node.end - node.start
            assert node.end - node.start <= leaf
        todo.extend(node.children)
    assert sum(leaves.values()) == len(m)
    item, doc, score = tree.search(*items, 3)
    for i in range(len(items[0]) - 1):
        own = dict(zip(items[1][items[0][i]:items[0][i + 1]].tolist(), items[2][items[0][i]:items[0][i + 1]].tolist()))
        every = sorted((-sum(own.get(t, 0) * int(lexical.share(np.int64(tf), int(m[d]))) for t, tf in zip(
            terms[offsets[d]:offsets[d + 1]].tolist(), tfs[offsets[d]:offsets[d + 1]].tolist())), d) for d in range(len(m)))
        assert [(s, d) for s, d in zip(score[item == i].tolist(), doc[item == i].tolist())] == [(-s, d) for s, d in every[:3] if s < 0]
