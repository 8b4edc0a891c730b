import math
import re
from collections import Counter, defaultdict

from gristmill.llm import queries, url_filter

RULES = queries.URL_RULES


def parse(url):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    low = lambda s: re.sub("[A-Z]", lambda c: c[0].lower(), s)
    return (low(m[2]), m[3]) if m else ("", "")


def rule(host, path):
    fits = [(len(t), t, v) for v, t in RULES for h, p in [t.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


ODD = [None, "", "no scheme", "://", "http://A.Example.COM", "HTTP://WWW.EXAMPLE.COM/en/x?y", "http://example.com/en/1", "ftp://xexample.com/en/1", "http://x.net/es/1#a", "http://x.net/es", "a://b://c/d", "http://É.com/", "http://h.org/?q=/en/", "http://example.com?/en/", "http://h.org/a/b/c/d/e/f/9", "http://h.org//x", "http://x\ny.com/z"]


def test_rows(spark, sf):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()] + [(5000 + i, u) for i, u in enumerate(ODD)] * 2
    df = spark.createDataFrame([(*r, "c", 0) for r in rows], "page_id long, url string, rule string, n int")
    got = url_filter.filter_urls(df, RULES).collect()
    want = []
    for i, u in rows:
        h, p = parse(u)
        want.append((i, h, p, *rule(h, p)))
    assert sorted((r.page_id, r.host, r.path, r.rule or "") for r in got) == sorted((w[0], w[1], w[2], w[3] or "") for w in want)
    ruled = {(w[0], w[4]) for w in want if w[3]}
    assert {(r.page_id, r.verdict) for r in got if r.rule} == ruled and all(r.verdict in ("allow", "block") for r in got)
    assert url_filter.filter_urls(df.limit(0), RULES).count() == 0


def test_templates(spark):
    urls = [f"http://a.com/user/name{chr(97 + i % 26)}{chr(97 + i // 26)}x/posts/{i}" for i in range(300)]
    urls += [f"http://a.com/ads/click/{i}" for i in range(50)] + [f"http://b.com/ads/click/{i}" for i in range(40)] + [f"http://c.com/news/{i}" for i in range(40)]
    rules = [("block", "a.com/ads/"), ("allow", "a.com/user/"), ("allow", "c.com/")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.filter_urls(df, rules).collect()
    assert {r.template for r in got if "user" in r.path} == {"a.com/user/*/posts/*"}
    assert {r.verdict for r in got if r.host == "b.com"} == {"block"} and {r.verdict for r in got if r.host == "c.com"} == {"allow"}
    assert {r.rule for r in got if r.host == "b.com"} == {None}


def test_rare_templates_do_not_keep_branches_apart(spark):
    """/en/ and /it/ spread alike but for one odd url; /shop/ is built otherwise."""
    urls = [f"http://h.net/{k}/{kind}/{i}" for k, n in (("en", 60), ("it", 40)) for kind in ("news", "blog") for i in range(n)]
    urls += ["http://h.net/it/odd/thing", *[f"http://h.net/shop/{c}/item/{i}" for c in "abcd" for i in range(25)]]
    got = url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), [("block", "h.net/en/"), ("allow", "h.net/shop/a/")]).collect()
    assert {r.merged for r in got if r.path.startswith("/it/news")} == {"h.net/en/news/*"} == {r.merged for r in got if r.path.startswith("/en/blog")}
    assert {r.verdict for r in got if r.path.startswith("/it/news")} == {"block"}
    assert all(r.merged.startswith("h.net/shop/") and r.verdict == "allow" for r in got if "/shop/" in r.path)


def brute(rows, max_kinds=12, min_share=0.02, min_rows=3, alpha=4.0, z=1.96, effect=0.1, overlap=0.5):
    """(page_id, verdict, template, merged, purity) by plain dictionaries."""
    items, paths = [], Counter()
    for i, u in rows:
        host, path = parse(u)
        paths[host, path] += 1
        items.append((i, host, path, rule(host, path)[1]))
    split = lambda p: tuple(re.sub("^/", "", p).split("/")) if p else ()
    template = {}

    def descend(host, members, g, k):
        """members: paths that share the labels g of their first k segments."""
        if len(members) == 1:
            template[host, members[0]] = g + split(members[0])[k:]
            return
        kids = defaultdict(list)
        for p in members:
            kids[split(p)[k] if len(split(p)) > k else None].append(p)
        count = {s: sum(paths[host, p] for p in ps) for s, ps in kids.items()}
        below = defaultdict(list)
        for s, ps in kids.items():
            if s is None:
                template.update({(host, p): g for p in ps})
            else:
                rare = count[s] < min_share * sum(count.values()) or count[s] < min_rows
                below["*" if len(kids) > max_kinds and rare else s] += ps
        for s, ps in below.items():
            descend(host, ps, (*g, s), k + 1)

    by_host = defaultdict(list)
    for host, p in sorted(paths):
        by_host[host].append(p)
    for host, ps in by_host.items():
        descend(host, ps, (), 0)
    n = Counter()
    for key, c in paths.items():
        n[key[0], template[key]] += c
    m = {leaf: leaf[1] for leaf in n}

    def alike(x, y):
        tx, ty = sum(x.values()), sum(y.values())
        same = x.keys() & y.keys()
        if round(sum(min(x[s] / tx, y[s] / ty) for s in same), 6) < overlap:
            return False
        chi = sum((math.sqrt(ty / tx) * x[s] - math.sqrt(tx / ty) * y[s]) ** 2 / (x[s] + y[s]) for s in x.keys() | y.keys())
        df = len(x.keys() | y.keys()) - 1
        limit = df * (1 - 2 / (9 * df) + z * math.sqrt(2 / (9 * df))) ** 3 if df else 0
        return round(chi, 6) <= limit or round(chi, 6) <= effect**2 * (tx + ty)

    for k in range(max(map(len, m.values())) - 1, -1, -1):
        spread = defaultdict(lambda: defaultdict(Counter))
        for leaf, labels in m.items():
            if len(labels) > k:
                spread[leaf[0], labels[:k]][labels[k]][labels[k + 1 :]] += n[leaf]
        into = {}
        for node, branches in spread.items():
            size = lambda b: (sum(branches[b].values()), b)  # noqa: B023, E731
            larger = {b: [o for o in branches if size(o) > size(b) and alike(branches[o], branches[b])] for b in branches}
            for b in branches:
                leaders = [o for o in larger[b] if not larger[o]]
                if leaders:
                    into[node, b] = max(leaders, key=size)
        for leaf, labels in m.items():
            if len(labels) > k:
                m[leaf] = (*labels[:k], into.get(((leaf[0], labels[:k]), labels[k]), labels[k]), *labels[k + 1 :])
    count = Counter()
    for _, host, path, v in items:
        leaf = host, template[host, path]
        for key in (("own", *leaf), ("group", host, m[leaf]), ("branch", host, m[leaf][:1]), ("same", leaf[1]), ("all",)):
            count[key, "lab"] += v is not None
            count[key, "blk"] += v == "block"
    p = lambda key, prior: (count[key, "blk"] + alpha * prior) / (count[key, "lab"] + alpha)
    out = []
    for i, host, path, v in items:
        g = template[host, path]
        own, group = ("own", host, g), ("group", host, m[host, g])
        lo, bo, lg, bg = count[own, "lab"], count[own, "blk"], count[group, "lab"], count[group, "blk"]
        if lo and abs(bo / lo - bg / lg) > z * math.sqrt(bg / lg * (1 - bg / lg) * (1 / lo + 1 / lg)):
            group = own
        purity = p(own, p(group, p(("branch", host, m[host, g][:1]), p(("same", g), p(("all",), 0.5)))))
        show = lambda t: "/".join((host, *t))  # noqa: B023, E731
        out.append((i, v or ("block" if purity >= 0.5 else "allow"), show(g), show(m[host, g]), round(purity, 9)))
    return sorted(out)


def result(rows):
    return sorted((r.page_id, r.verdict, r.template, r.merged, round(r.purity, 9)) for r in rows)


def test_query_whole(spark, sf):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert result(queries.op2_url_filter(spark, sf).collect()) == brute(rows)


def test_against_brute_force(spark):
    urls = [f"http://a.com/u{chr(97 + i % 26)}{chr(97 + i // 26)}z/p/{i}/x/y" for i in range(120)] + [f"http://a.com/ads/{i}" for i in range(9)] + [f"http://b.com/{s}/en/{i}" for s in ("ads", "q", "r") for i in range(7)]
    urls += ODD + [f"http://example.com/{s}/0123456789abcdef0{i}" for s in ("en", "fr", "dead-beef") for i in range(5)] * 2
    urls += [f"http://d.com/{a}/{b}/{c}/{i}" for a in ("x", "y", "z") for b in ("k", "l") for c, n in (("m", 9), ("n", 3 if a == "z" else 8)) for i in range(n)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert result(url_filter.filter_urls(df, RULES).collect()) == brute(list(enumerate(urls)))


def test_deep_paths(spark):
    """Nine segments that differ at the sixth only: the labelled ones decide their own branch alone."""
    urls = [f"http://d.org/a/b/c/d/e/{s}/g/h/{i}" for s in ("good", "bad", "new") for i in range(30)] + ["http://d.org/" + "/".join("q" * 40)]
    rules = [("block", "d.org/a/b/c/d/e/bad/"), ("allow", "d.org/a/b/c/d/e/good/")]
    df = spark.createDataFrame([*enumerate(urls), (900, "http://e.org/a/b/c/d/e/bad/g/h/1")], "page_id long, url string")
    got = url_filter.filter_urls(df, rules).collect()
    assert {r.template for r in got if "/bad/" in r.path and r.host == "d.org"} == {"d.org/a/b/c/d/e/bad/g/h/*"}
    assert all(r.verdict == ("block" if "/bad/" in r.path else "allow") for r in got if r.rule) and sum(r.rule is not None for r in got) == 60
