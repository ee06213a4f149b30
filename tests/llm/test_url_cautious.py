"""Cautious templates: pages for which nothing speaks are not blocked, variable segments still are generalised."""

import random

from millrace.llm import url_filter as uf

BLOCK, ALLOW = "block", "allow"


def judged(spark, urls, rules=uf.RULES):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.path: r for r in uf.judge(frame, rules, cautious=True).collect()}


def test_an_unlabelled_branch_does_not_follow_a_blocked_one(spark):
    """40 or 400 pages under /de/ (blocked by rule) and as many under /en/ (no rule) of one host."""
    for n in (40, 400):
        got = judged(spark, [f"http://x{n}.com/{lang}/{k}" for lang in ("de", "en") for k in range(n)])
        assert {r.verdict for p, r in got.items() if p.startswith("/en/")} == {ALLOW} and {r.verdict for p, r in got.items() if p.startswith("/de/")} == {BLOCK}
        assert {r.template for p, r in got.items() if p.startswith("/en/")} == {"/en/*"}


def test_a_common_word_is_no_variable_on_a_small_host(spark):
    """Languages with a page or two a host, but on many hosts."""
    got = judged(spark, [f"http://h{h}.com/{lang}/{h}-{k}" for h in range(30) for lang in ("de", "en", "fr") for k in range(2)])
    assert {(p.split("/")[1], r.verdict) for p, r in got.items()} == {("de", BLOCK), ("en", ALLOW), ("fr", ALLOW)}


def test_labels_generalise_over_variable_segments(spark):
    """One in ten of the pages under /ads/ is labelled; unlabelled ones share its template and its verdict."""
    rng = random.Random(1)
    urls = [f"http://s.com/{part}/{rng.choice('12')}{k:04d}/{rng.randrange(10**6)}" for part in ("ads", "docs") for k in range(300)]
    rules = (uf.Rule("s.com", "/ads/1", BLOCK), uf.Rule("s.com", "/docs/1", ALLOW))
    got = judged(spark, urls, rules)
    assert {(p.split("/")[1], r.verdict) for p, r in got.items()} == {("ads", BLOCK), ("docs", ALLOW)}
    assert {r.template for r in got.values()} <= {"/ads/*/*", "/docs/*/*", "/ads/*/**", "/docs/*/**", "/ads/**", "/docs/**"}


def test_given_pages_without_a_rule_are_allowed(spark):
    """In the given tables no page outside a blocked path is marked for blocking: none is blocked by the method alone."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = uf.judge(pages, cautious=True).collect()
    free = [r for r in rows if r.rule is None]
    blocked = [r for r in free if r.verdict == BLOCK]
    assert len(rows) == pages.count() and all(any(f"/{lang}/" in r.path for lang in ("es", "de")) or r.path.startswith("/en/") and r.host.endswith("example.org") for r in blocked), [tuple(r) for r in blocked[:5]]
