import math
import random
import re
from collections import defaultdict

import pytest

from claimsmith.llm import url_templates as U
from tests.llm.conftest import SF0001


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = []
    for verdict, r in U.RULES:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(r), r, verdict))
    return max(fits)[1:] if fits else (None, None)


def differs(n, g, of_n, of_g):
    r = of_g / max(1, of_n)
    return n > 0 and abs(g / n - r) > U.Z * math.sqrt(r * (1 - r) / n)


def brute(pages, good):
    """page index -> (host, path, rule, verdict) by the documented method, row by row, without closing nodes early."""
    parts = [split(u) for _, u in pages]
    segs = [[s for s in p.split("/") if s] for _, p in parts]
    template = [""] * len(pages)
    shape = lambda s: re.sub("[0-9]+", "*", s)
    depth = max(map(len, segs), default=0)
    for level in range(depth):
        nodes = defaultdict(list)
        for i, ((h, _), s, t) in enumerate(zip(parts, segs, template)):
            if len(s) > level:
                nodes[h, t].append(i)
        for members in nodes.values():
            label = lambda of: (sum(pages[i][0] in good for i in of), sum(good.get(pages[i][0], 0) for i in of))
            own, shaped = defaultdict(list), defaultdict(int)
            for i in members:
                own[segs[i][level]].append(i)
                shaped[shape(segs[i][level])] += 1
            frequent = {x: len(of) for x, of in own.items() if len(of) >= U.MIN_COUNT and not re.fullmatch("[0-9]+", x)}
            stars = {x: c for x, c in shaped.items() if c >= U.MIN_COUNT and "*" in x}
            vary, shapes_vary = (sum(c.values()) ** 2 > U.VARIED * sum(n * n for n in c.values()) for c in (frequent, stars))
            for x, of in own.items():
                if x in frequent and (not vary or differs(*label(of), *label(members))):
                    said = x
                else:
                    said = shape(x) if shape(x) in stars and not shapes_vary else "**"
                for i in of:
                    template[i] += "/" + said
    n, g, hn, hg = (defaultdict(int) for _ in range(4))
    for (h, _), t, (i, _) in zip(parts, template, pages):
        n[h, t] += i in good
        g[h, t] += good.get(i, 0)
        hn[h] += i in good
        hg[h] += good.get(i, 0)
    merged = {k: k for k in n}
    for level in reversed(range(depth)):
        cn, cg, family = defaultdict(int), defaultdict(int), defaultdict(set)
        for k, m in merged.items():
            cn[m] += n[k]
            cg[m] += g[k]
        for h, t in cn:
            s = t.split("/")
            if len(s) > level + 1 and "*" not in s[level + 1] and s[level + 1] != "{}":
                family[h, "/".join(s[:level + 1] + ["{}"] + s[level + 2:])].add((h, t))
        to = {}
        for f, of in family.items():
            pool = sum(cn[m] for m in of), sum(cg[m] for m in of)
            to |= {m: f for m in of if len(of) > 1 and not differs(cn[m], cg[m], *pool)}
        merged = {k: to.get(m, m) for k, m in merged.items()}
    mn, mg = defaultdict(int), defaultdict(int)
    for k in n:
        mn[merged[k]] += n[k]
        mg[merged[k]] += g[k]
    prior = (sum(hg.values()) + 0.5 * U.SMOOTHING) / (sum(hn.values()) + U.SMOOTHING)
    out = []
    for (h, p), t in zip(parts, template):
        host = (hg[h] + U.SMOOTHING * prior) / (hn[h] + U.SMOOTHING)
        purity = (mg[merged[h, t]] + U.SMOOTHING * host) / (mn[merged[h, t]] + U.SMOOTHING)
        r, v = rule(h, p)
        out.append((h, p, r, v or ("block" if purity < U.MIN_PURITY else "allow")))
    return out


@pytest.fixture
def odd_pages():
    urls = [None, "", "no scheme", "http://", "http://A.Example.COM", "https://www.EXAMPLE.com/en/1", "https://example.com/en/1", "x://notexample.com/en/",
            "http://a.net/es/", "http://a.net/es", "http://net/fr/x?y#z", "ftp://h.org?x=/a/b", "http://h.org#/a", "http://h.org/a//b/c/d/e/f/g/h/i",
            "http://x.com/a\nb/é", "a://b://c/d", "://only/p", "http://ÄB.org/x"]
    pages = [(i, u) for i, u in enumerate(urls)]
    pages += [(100 + i, f"http://big.org/spam/{i}.html") for i in range(60)] + [(200 + i, f"http://big.org/good/{i}") for i in range(60)]
    pages += [(300, "http://big.org/good/1"), (300, "http://big.org/good/1"), (None, "http://big.org/spam/7.html")]
    good = {100 + i: int(i % 10 == 0) for i in range(0, 60, 2)} | {200 + i: int(i % 10 != 0) for i in range(0, 60, 2)}
    return pages, good


def test_verdicts_equal_brute_force(spark, odd_pages):
    pages, good = odd_pages
    df = spark.createDataFrame([(i, u, "h", "t", 1) for i, u in pages], "page_id long, url string, host string, template string, good int")
    labels = spark.createDataFrame(list(good.items()), "page_id long, good int")
    got = sorted((r.page_id is None, r.page_id or 0, r.host, r.path, r.rule or "", r.verdict) for r in U.filter_urls(df, labels).collect())
    want = sorted((i is None, i or 0, h, p, r or "", v) for (i, _), (h, p, r, v) in zip(pages, brute(pages, good)))
    assert got == want
    assert {v for i, *_, v in ((g[1], g[5]) for g in got) if 100 <= i < 160} == {"block"}


def test_no_labels_and_empty(spark, odd_pages):
    df = spark.createDataFrame(odd_pages[0], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, good int")
    assert U.filter_urls(df, none).where("rule is null and verdict <> 'allow'").count() == 0
    assert U.filter_urls(df.limit(0), none).count() == 0


def test_query_whole_table(spark):
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()]
    marks = {r.doc_id: int(r.quality == 1 and r.toxic == 0) for r in spark.read.parquet(f"{SF0001}/labels.parquet").collect()}
    good = {}
    for i, u in pages:
        m = re.search("/([0-9]+)", split(u)[1])
        if m and int(m[1]) in marks:
            good[i] = marks[int(m[1])]
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in U.op3_url_filter(spark, SF0001).collect())
    assert got == sorted((i, h, p, r or "", v) for (i, _), (h, p, r, v) in zip(pages, brute(pages, good)))


def test_small_branches_of_a_large_host_are_judged_by_themselves(spark):
    """60 equal directories, one of them bad: none has 2 % of the host's pages."""
    pages = [(100 * d + i, f"http://hot.org/dir{'abcdefghij'[d // 10]}{'abcdefghij'[d % 10]}/p{i}x") for d in range(60) for i in range(40)]
    bad = 17
    df = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i // 100 != bad)) for i, _ in pages if i % 2], "page_id long, good int")
    got = {r.page_id: r.verdict for r in U.filter_urls(df, labels).collect()}
    assert got == {i: "block" if i // 100 == bad else "allow" for i, _ in pages}


def test_branches_that_part_at_depth_are_judged_by_themselves(spark):
    """Good and bad branches part at the ninth segment; a lone deep page has a wildcard a segment."""
    pages = [(i, f"http://deep.org/a/b/c/d/e/f/g/h/{'bad' if i % 3 == 0 else 'good'}/p{i}x") for i in range(120)] + [(999, "http://lone.org" + "/s" * 20)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 120, 2)], "page_id long, good int")
    got = {r.page_id: r for r in U.filter_urls(df, labels).collect()}
    assert {i: r.verdict for i, r in got.items()} == {i: "block" if i < 120 and i % 3 == 0 else "allow" for i, _ in pages}
    assert got[0].template == "/a/b/c/d/e/f/g/h/bad/p*x" and got[999].template == "/**" * 20


def frames(spark, urls, good):
    return (spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"),
            spark.createDataFrame(list(good.items()), "page_id long, good int"))


def test_many_alike_values_are_a_variable(spark):
    """520 slugs of five pages are one wildcard, but for the slugs whose labels are bad."""
    slug = lambda d: "".join("abcdefghij"[int(x)] for x in str(1000 + d))
    urls = [f"http://hot.org/{slug(d)}/view" for d in range(520) for _ in range(5)]
    bad = {40, 41, 300}
    good = {i: int(i // 5 not in bad) for i in range(len(urls))}
    got = {r.page_id: r for r in U.filter_urls(*frames(spark, urls, good)).collect()}
    assert {r.template for i, r in got.items() if i // 5 not in bad} == {"/**/view"}
    assert {r.template for i, r in got.items() if i // 5 in bad} == {f"/{slug(d)}/view" for d in bad}
    want = brute(list(enumerate(urls)), good)
    assert [got[i].verdict for i in range(len(urls))] == [w[3] for w in want]
    assert {i // 5 for i, r in got.items() if r.verdict == "block"} == bad


def test_siblings_are_merged_below_a_shared_literal(spark):
    """/en/blog and /en/news are alike and pooled, /en/spam differs; the level above pools what is alike."""
    kinds = ["blog", "news", "docs", "wiki", "shop", "help", "jobs", "spam"]
    urls = [f"http://h.org/{a}/{b}/{i}" for a in ("en", "fr") for b in kinds for i in range(40)]
    good = {i: int("spam" not in u) for i, u in enumerate(urls) if i % 2}
    pages, labels = frames(spark, urls, good)
    tree, levels = U.template_tree(pages.join(labels, "page_id", "left").select("page_id", U.host_of(pages.url).alias("host"), U.path_of(pages.url).alias("path"), "good"))
    got = {r.template: r.merged for r in U.judged_templates(tree, levels).collect()}
    assert got == {f"/{a}/{b}/*": "/{}/spam/*" if b == "spam" else "/{}/{}/*" for a in ("en", "fr") for b in kinds}
    judged = {r.page_id: r.verdict for r in U.filter_urls(pages, labels).collect()}
    assert judged == {i: "block" if "spam" in u else "allow" for i, u in enumerate(urls)}


def test_pages_that_go_on_alike_need_no_further_level(spark, monkeypatch):
    """Five copies of a thousand segments, and a thin host: one level, not a job a segment."""
    stored = []
    store = U.C.store
    monkeypatch.setattr(U.C, "store", lambda df: stored.append(1) or store(df))
    deep = "/".join(f"s{i}" if i % 3 else str(i) for i in range(1000))
    urls = [f"http://deep.org/{deep}"] * 5 + ["http://thin.org/" + "/".join("abcdefghij")] * 2
    got = {r.page_id: r.template for r in U.filter_urls(*frames(spark, urls, {0: 1})).collect()}
    assert got[0] == "/" + "/".join(f"s{i}" if i % 3 else "*" for i in range(1000)) and got[5] == "/**" * 10
    assert len(stored) <= 4


@pytest.mark.parametrize("seed", range(4))
def test_random_trees_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(60)] + [f"p{i}" for i in range(6)] + ["7", "{}", "a*"]
    urls, weight = [], [1 / (i + 1) ** (0.2 * seed) for i in range(len(words))]
    for _ in range(700):
        urls.append(f"http://h{rng.randrange(3)}.org/" + "/".join(rng.choices(words[:rng.choice([3, 50, len(words)])], k=rng.randrange(4)))
                    if seed else f"http://h.org/{rng.choice(words)}/{rng.choice(words[:2])}")
    rate = {w: rng.random() for w in words}
    good = {i: int(rng.random() < rate.get(u.split("/")[3], 0.5)) for i, u in enumerate(urls) if rng.random() < 0.7}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(*frames(spark, urls, good)).collect()}
    assert [got[i] for i in range(len(urls))] == brute(list(enumerate(urls)), good)
