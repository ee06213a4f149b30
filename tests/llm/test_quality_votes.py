"""The estimation of rules' accuracies on simulated votes, and the quality stage on odd tables."""

import numpy as np
import pytest
from millrace.llm import quality_rules

N_RULES = len(quality_rules.RULES)


def simulated(rates, prior, n, seed):
    """Vote patterns of n texts under known rates[class, vote, rule]; (patterns, counts, classes, votes)."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < prior
    votes = np.empty((n, N_RULES), int)
    for c in (0, 1):
        for r in range(N_RULES):
            votes[good == c, r] = rng.choice(3, (good == c).sum(), p=rates[c, :, r])
    packed = np.array([quality_rules._packed(v) for v in votes.tolist()])
    patterns, where, counts = np.unique(packed, return_inverse=True, return_counts=True)
    return patterns, counts.astype(float), good, votes, where


def rates_of(bad_on_bad, bad_on_good, abstain):
    return np.array([[bad_on_bad, [abstain] * N_RULES, [1 - abstain - x for x in bad_on_bad]], [bad_on_good, [abstain] * N_RULES, [1 - abstain - x for x in bad_on_good]]])


def test_planted_accuracies_are_recovered():
    rates = rates_of(np.linspace(0.2, 0.8, N_RULES).tolist(), np.linspace(0.15, 0.005, N_RULES).tolist(), 0.15)
    patterns, counts, good, _, where = simulated(rates, 0.85, 40_000, 1)
    p, prior, found = quality_rules.estimate(patterns, counts)
    assert abs(prior - 0.85) < 0.02 and np.abs(found - rates).max() < 0.04
    assert ((p[where] >= 0.5) == good).mean() > 0.97


@pytest.mark.parametrize("false_alarm", [0.01, 0.05, 0.2])
def test_one_weak_rule_decides_nothing(false_alarm):
    """A rule that often errs on good texts: those with its bad vote alone are kept, where all-must-pass would drop them."""
    rates = rates_of([0.3] + [0.6] * (N_RULES - 1), [false_alarm] + [0.01] * (N_RULES - 1), 0.1)
    patterns, counts, good, votes, where = simulated(rates, 0.9, 20_000, 2)
    p = quality_rules.posterior(patterns, counts)[where]
    alone = (votes[:, 0] == 0) & (votes[:, 1:] != 0).all(axis=1)
    assert alone.sum() > 50 and (p[alone] >= 0.5).all()
    passes = (votes != 0).all(axis=1)
    assert ((p >= 0.5) == good).mean() > (passes == good).mean() + 0.02


def test_classes_keep_their_names_without_good_texts():
    rates = rates_of([0.7] * N_RULES, [0.02] * N_RULES, 0.1)
    for prior in (0.3, 0.6, 0.97):
        patterns, counts, good, _, where = simulated(rates, prior, 5000, 3)
        assert ((quality_rules.posterior(patterns, counts)[where] >= 0.5) == good).mean() > 0.98


def test_kept_follows_posterior_and_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = quality_rules.judge(docs).collect()
    assert all(r.kept == (not r.base_failed and r.p_good >= 0.5) for r in rows)
    clean, bad = ([r.kept for r in rows if labels.get(r.doc_id) == k and not r.base_failed] for k in (1, 0))
    assert np.mean(clean) > 0.98 and np.mean(bad) < 0.05


def test_keep_good_on_odd_tables(spark):
    prose = "The quick brown fox jumps over the lazy dog near a quiet river bank while seven clever birds watch from old trees. "
    rows = [(1, prose + "One.", "a", 1, 1), (1, prose + "One.", "a", 1, 1), (None, prose + "Two.", None, None, 2), (2, None, "b", 2, 3), (3, "", "b", 3, 4), (4, "### $$$ %%% " * 30, "c", 4, 5), (5, (prose.replace(" ", " x") + "\n") * 1, "d", 5, 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, votes string, __quality int, `p.good` int")
    out = quality_rules.keep_good(frame)
    assert out.columns == frame.columns
    kept = [tuple(r) for r in out.collect()]
    assert kept.count(rows[0]) == 2 and rows[2] in kept and not {2, 3, 4} & {r[0] for r in kept}
    verdicts = {(r.doc_id, r.kept) for r in quality_rules.judge(frame).collect()}
    assert {k for k, yes in verdicts if yes} == {r[0] for r in kept}
    assert quality_rules.keep_good(frame.limit(0)).count() == 0 and quality_rules.judge(frame.limit(0)).count() == 0
    long = spark.createDataFrame([(1, prose * 20_000)], "doc_id long, text string")
    assert [r.kept for r in quality_rules.judge(long).collect()] == [False]
