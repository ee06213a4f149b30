"""The template tree against one built by recursion over whole hosts; deep paths, merges, branches kept apart, odd tables."""

import math
import random
from collections import defaultdict

from millrace.llm import url_filter as uf

WORDS = ["news", "shop", "help", "blog", "tag", "x1"]


def made_up(seed=3, n=4000):
    rng = random.Random(seed)
    urls: list = []
    for _ in range(n):
        host = rng.choice(["a.com", "a.com", "a.com", "b.example.org", "c.net", f"tiny{rng.randint(0, 200)}.io"])
        section = rng.choice(WORDS)
        tail = {"news": [str(rng.randint(2000, 2003)), str(rng.randint(1, 12)), f"story-{rng.randint(0, 9999)}"], "shop": ["item", str(rng.randint(0, 500))], "blog": [f"p{rng.randint(0, 10**6):x}"], "tag": [rng.choice("abc")]}.get(section, [])
        lang = rng.choice(["en", "fr", "de"])
        urls.append(f"https://{host}/{lang}/{section}/" + "/".join(tail) + rng.choice(["", "/", "?q=1", "#top"]))
    urls += ["http://a.com/" + "/".join(["deep"] * 30 + [str(k)]) for k in range(12)] + ["http://hot.com/same/page"] * 300 + [None, "nothing", "http://", "http://e.com//x///y"] * 2
    return urls


def by_recursion(pages):
    """host -> path -> template, for (host, path) pairs with (n, labelled, blocked)."""
    out = {}

    def like(a, n, b, m):
        return not n or not m or abs(a / n - b / m) < math.sqrt(0.5 * math.log(2 / uf.ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def counts(paths, level):
        total = [sum(pages[p][k] for p in paths) for k in range(3)]
        return [*total, *(sum(pages[p][0] for p in paths if len(p[1]) == level + 1 + k) for k in range(3)), len({p[1][level + 1 : level + 2] for p in paths})]

    def divide(paths, level, template):
        for p in paths:
            if len(p[1]) == level:
                out[p] = template
        paths = [p for p in paths if len(p[1]) > level]
        if not paths:
            return
        if sum(pages[p][0] for p in paths) < uf.SUPPORT:
            for p in paths:
                out[p] = (*template, uf.TAIL)
            return
        branches = defaultdict(list)
        for p in paths:
            branches[p[1][level]].append(p)
        own = {b: counts(ps, level) for b, ps in branches.items()}
        every = [sum(c[k] for c in own.values()) for k in range(7)]
        children = defaultdict(list)
        for b, ps in branches.items():
            c = own[b]
            rest = [x - y for x, y in zip(every, c, strict=True)]
            same = all(like(c[k], c[0], rest[k], rest[0]) for k in (3, 4, 5, 6)) and like(c[2], c[1], rest[2], rest[1])
            children[uf.ANY if len(branches) > 1 and (c[0] < uf.SUPPORT or same) else b] += ps
        for name, ps in children.items():
            divide(ps, level + 1, (*template, name))

    for host in {h for h, _ in pages}:
        divide([p for p in pages if p[0] == host], 0, ())
    return out


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([k for k, c in enumerate(rest) if c in "/?#"], default=len(rest))
    path = rest[end:]
    return rest[:end].lower(), path[: min([k for k, c in enumerate(path) if c in "?#"], default=len(path))]


def test_templates_and_verdicts_by_recursion(spark):
    urls = made_up()
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages, fixed = {}, {}
    for k, url in enumerate(urls):
        host, path = parts_of(url)
        fits = [r for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        fixed[k] = (host, path, rule)
        key = host, tuple(x for x in path.split("/") if x)
        n, labelled, blocked = pages.get(key, (0, 0, 0))
        pages[key] = (n + 1, labelled + (rule is not None), blocked + (rule is not None and rule.verdict == "block"))
    want = by_recursion(pages)
    sums, hosts = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for (host, path), (_, labelled, blocked) in pages.items():
        for s in (sums[host, want[host, path]], hosts[host]):
            s[0] += labelled
            s[1] += blocked
    def verdict(host, template):
        prior = (hosts[host][1] + uf.SMOOTHING / 2) / (hosts[host][0] + uf.SMOOTHING)
        labelled, blocked = sums[host, template]
        return "block" if (blocked + uf.SMOOTHING * prior) / (labelled + uf.SMOOTHING) >= uf.REJECT else "allow"
    got = {r.page_id: r for r in uf.judge(frame).collect()}
    assert len(got) == len(urls)
    for k, (host, path, rule) in fixed.items():
        template = want[host, tuple(x for x in path.split("/") if x)]
        expected = (host, path, rule.name if rule else None, rule.verdict if rule else verdict(host, template), "/" + "/".join(template))
        assert tuple(got[k])[1:] == expected
    seen = {t for t in want.values()}
    assert any(len(t) == 31 for t in seen) and any(uf.ANY in t for t in seen) and any(t and t[-1] == uf.TAIL for t in seen)
    assert {t[1] for h, t in ((h, want[h, p]) for h, p in want) if h == "a.com" and len(t) > 1 and t[0] != "deep"} >= {"news", "shop"}


def test_blocked_branch_stays_apart_and_rejects(spark):
    rules = (uf.Rule("s.com", "/ads/1", "block"), uf.Rule("s.com", "/docs/1", "allow"))
    urls = [f"http://s.com/{x}/{k}" for x in ("ads", "docs") for k in range(100, 300)]
    got = {r.path: r.verdict for r in uf.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert got["/ads/250"] == "block" and got["/docs/250"] == "allow"


def test_odd_pages(spark):
    rows = [(1, None, "x", "h"), (1, None, "x", "h"), (None, "HTTP://A.com/" + "s/" * 200 + "x" * 50_000, "y", None), (2, "", "z", "h"), (3, "no scheme", None, "h"), (4, "https://é.com/ü?x", "w", "h")]
    frame = spark.createDataFrame(rows, "page_id long, url string, host string, template string")
    got = uf.judge(frame).collect()
    assert len(got) == len(rows) and {r.verdict for r in got} == {"allow"} and sorted(r.host for r in got) == ["", "", "", "", "a.com", "é.com"]
    assert uf.judge(frame.limit(0)).count() == 0
