"""Record linkage: comparison levels, frequency counts, parameters by expectation-maximisation, scores, decisions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from millrace.functions.columns import precision_recall
from millrace.operators.relational import connected_components, stack, unique_or_ambiguous
from millrace.sources.shared import settle


def jaro_winkler(a: str, b: str) -> float:
    """Similarity of two texts, 0 to 1: shared characters within half the longer length, transpositions, common prefix of up to 4."""
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    left = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == x:
                free[j] = False
                left.append(x)
                break
    if not left:
        return 0.0
    right = [y for y, unused in zip(b, free, strict=True) if not unused]
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    m = len(left)
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + 0.1 * prefix * (1 - jaro)


#: Pairs of names that are compared side by side.
_NAMES_AT_ONCE = 4096


def _code_points(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of code points for each name, filled up with zeros, and the lengths."""
    wide = np.array(names, dtype=np.str_)
    width = max(1, wide.dtype.itemsize // 4)
    return np.ascontiguousarray(wide).view(np.uint32).reshape(len(names), width), np.array([len(x) for x in names])


def jaro_winkler_all(a: list[str], b: list[str]) -> np.ndarray:
    """`jaro_winkler` of many pairs: each step of the matching is taken for all pairs at once, so steps grow with the longest name, not with the pairs."""
    left, n_left = _code_points(a)
    right, n_right = _code_points(b)
    reach = np.maximum(0, np.maximum(n_left, n_right) // 2 - 1)
    place = np.arange(right.shape[1])
    free = place < n_right[:, None]
    taken = np.zeros(left.shape, bool)
    for i in range(left.shape[1]):
        fits = free & (right == left[:, i : i + 1]) & (np.abs(place - i) <= reach[:, None]) & (i < n_left)[:, None]
        hit = np.flatnonzero(fits.any(1))
        free[hit, fits[hit].argmax(1)] = False
        taken[hit, i] = True
    used = ~free & (place < n_right[:, None])
    m = taken.sum(1)
    # The matched characters of both sides in their order, pair by pair; a pair has as many on either side.
    differ = left[taken] != right[used]
    swaps = np.bincount(np.repeat(np.arange(len(m)), m)[differ], minlength=len(m)) // 2
    some = np.maximum(m, 1)
    jaro = np.where(m > 0, (m / np.maximum(n_left, 1) + m / np.maximum(n_right, 1) + (m - swaps) / some) / 3, 0.0)
    width = min(4, left.shape[1], right.shape[1])
    equal = (left[:, :width] == right[:, :width]) & (np.arange(width) < np.minimum(n_left, n_right)[:, None])
    prefix = np.logical_and.accumulate(equal, axis=1).sum(1)
    return np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)


@pandas_udf(T.DoubleType())
def jaro_winkler_udf(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Null where a side is null. Pairs are taken by length, so that a long name does not widen the rows of short ones; names with a zero character go one by one."""
    for a, b in pairs:
        out = np.full(len(a), np.nan)
        known = np.flatnonzero((a.notna() & b.notna()).to_numpy())
        odd = np.array([chr(0) in a.iat[k] or chr(0) in b.iat[k] for k in known], bool)
        out[known[odd]] = [jaro_winkler(a.iat[k], b.iat[k]) for k in known[odd]]
        plain = known[~odd]
        longest = np.array([max(len(a.iat[k]), len(b.iat[k])) for k in plain])
        plain, longest = plain[np.argsort(longest, kind="stable")], np.sort(longest)
        at = 0
        while at < len(plain):
            # So many that their tables of characters stay small.
            n = max(1, min(_NAMES_AT_ONCE, (1 << 22) // max(1, longest[min(at + _NAMES_AT_ONCE, len(plain)) - 1])))
            part = plain[at : at + n]
            out[part] = jaro_winkler_all([a.iat[k] for k in part], [b.iat[k] for k in part])
            at += n
        yield pd.Series(out)


def similar_names(pairs: DataFrame, a: str, b: str, as_col: str) -> DataFrame:
    """Similarity of each distinct pair of names, worked out once and joined back."""
    scored = pairs.select(a, b).distinct().withColumn(as_col, jaro_winkler_udf(a, b))
    return pairs.join(scored, [a, b], "left")


#: Pairs of distinct names that are compared all with all, and of those the similar ones that each task gets.
_NAME_PAIRS, _SIMILAR_PAIRS = 25_000_000, 1_000_000


def similar_name_table(left: DataFrame, right: DataFrame, column: str, least: float) -> DataFrame | None:
    """(a, b, similarity) of the distinct names of two tables that are at least so similar; None where they are too many to be handed to every task. It grows
    with the names, not with the pairs of people who have them."""
    names = [settle(df.filter(F.col(column).isNotNull()).select(F.col(column).alias(c)).distinct()) for df, c in ((left, "a"), (right, "b"))]
    if names[0].count() * names[1].count() > _NAME_PAIRS:
        return None
    found = settle(names[0].crossJoin(F.broadcast(names[1])).withColumn("similarity", jaro_winkler_udf("a", "b")).filter(F.col("similarity") >= least))
    return found if found.count() <= _SIMILAR_PAIRS else None


class Comparison(NamedTuple):
    """Levels of agreement of one column, best first; a pair takes the first that holds, `-1` where a side is null, else the last + 1."""

    name: str
    null: Column
    levels: tuple[Column, ...]

    def gamma(self) -> Column:
        out = F.lit(len(self.levels))
        for k, level in reversed(list(enumerate(self.levels))):
            out = F.when(level, F.lit(k)).otherwise(out)
        return F.when(self.null, F.lit(-1)).otherwise(out).alias(f"gamma_{self.name}")


def compare(pairs: DataFrame, comparisons: Sequence[Comparison]) -> DataFrame:
    return pairs.select("*", *(c.gamma() for c in comparisons))


def term_frequencies(people: DataFrame, column: str) -> DataFrame:
    counted = people.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.crossJoin(F.broadcast(counted.agg(F.sum("n").alias("total")))).select(column, (F.col("n") / F.col("total")).alias("frequency"))


def gamma_shares(pairs: DataFrame, comparisons: Sequence[Comparison]) -> dict[str, dict[int, float]]:
    """Share of pairs at each level of each comparison (nulls left out): u, if the pairs were drawn at random. One pass counts the patterns of levels."""
    names = [f"gamma_{c.name}" for c in comparisons]
    patterns = pairs.groupBy(*names).count().collect()
    out: dict[str, dict[int, float]] = {}
    for c, g in zip(comparisons, names, strict=True):
        seen = [sum(r["count"] for r in patterns if r[g] == k) for k in range(len(c.levels) + 1)]
        out[c.name] = {k: (n + 1) / (sum(seen) + len(seen)) for k, n in enumerate(seen)}
    return out


def estimate_m(pairs: DataFrame, comparisons: Sequence[Comparison], u: dict[str, dict[int, float]], prior: float, rounds: int = 50) -> tuple[dict[str, dict[int, float]], float]:
    """(m, share of matches) by EM with u held fixed. Spark counts the level patterns; the loop runs over those counts alone."""
    names = [f"gamma_{c.name}" for c in comparisons]
    counted = pairs.groupBy(*names).count().orderBy(*names).toPandas()
    n = counted["count"].to_numpy(float)
    levels = [len(c.levels) + 1 for c in comparisons]
    m = {c.name: {k: (0.9 if k == 0 else 0.1 / (size - 1)) for k in range(size)} for c, size in zip(comparisons, levels, strict=True)}
    at = {c.name: counted[g].to_numpy(int) for c, g in zip(comparisons, names, strict=True)}
    for _ in range(rounds):
        weight = np.full(len(n), math.log(prior / (1 - prior)))
        for c in comparisons:
            weight += np.array([math.log(m[c.name][k] / u[c.name][k]) if k >= 0 else 0.0 for k in at[c.name]])
        match = 1 / (1 + np.exp(-np.clip(weight, -500, 500)))
        new = min(max(float((match * n).sum() / max(n.sum(), 1)), 1e-9), 1 - 1e-9)
        for c, size in zip(comparisons, levels, strict=True):
            share = np.array([(match * n)[at[c.name] == k].sum() for k in range(size)]) + 1e-3
            m[c.name] = dict(enumerate((share / share.sum()).tolist()))
        if abs(new - prior) < 1e-9:
            break
        prior = new
    return m, prior


def prior_from_rules(found: int, left: int, right: int | None = None, recall: float = 0.8) -> float:
    """Share of matches among all pairs, when rules that find `recall` of them find so many. Without `right` the pairs are those within one table."""
    possible = left * right if right is not None else left * (left - 1) / 2
    return min(max(found / recall / max(possible, 1), 1e-12), 0.5)


def random_pairs(left: DataFrame, right: DataFrame, n: int = 2_000_000, seed: int = 42) -> DataFrame:
    """About n pairs drawn at random, the same on every run. Rows are dealt to buckets by a hash of seed and id, of as many as make n pairs meet in those that
    are kept; of large tables only some buckets, with about n rows a side, are kept, and no other row is shuffled."""
    sizes = left.agg(F.count(F.lit(1)).alias("l")).crossJoin(right.agg(F.count(F.lit(1)).alias("r"))).first()
    share = min(1.0, n / max(sizes.l, sizes.r, 1))
    buckets = max(1, int(share * sizes.l * sizes.r / n))
    bucket = lambda k, id_col: F.pmod(F.xxhash64(F.lit(seed + k), id_col), F.lit(buckets))
    dealt = [df.withColumn("__b", bucket(k, id_col)).filter(F.col("__b") < math.ceil(share * buckets)) for k, (df, id_col) in enumerate(((left, "id_l"), (right, "id_r")))]
    return dealt[0].join(dealt[1], "__b").drop("__b")


def train_m(blocks: Sequence[tuple[DataFrame, Sequence[str]]], comparisons: Sequence[Comparison], u: dict[str, dict[int, float]], prior: float) -> dict[str, dict[int, float]]:
    """m by one pass of EM for each training block (its pairs, and the comparisons that its blocking rule fixes and cannot teach); averaged over the passes."""
    taught: dict[str, list[dict[int, float]]] = {c.name: [] for c in comparisons}
    for pairs, fixed in blocks:
        free = [c for c in comparisons if c.name not in fixed]
        m, _ = estimate_m(pairs, free, u, prior)
        for name, levels in m.items():
            taught[name].append(levels)
    return {name: {k: sum(p[k] for p in passes) / len(passes) for k in passes[0]} for name, passes in taught.items() if passes}


class Model(NamedTuple):
    """What linkage has learnt: the share of matches among all pairs, and by comparison and level the shares of matches (m) and of random pairs (u)."""

    prior: float
    m: dict[str, dict[int, float]]
    u: dict[str, dict[int, float]]


def train_model(compared: DataFrame, drawn: DataFrame, comparisons: Sequence[Comparison], blocks: Sequence[tuple[Column, Sequence[str]]], prior: float) -> Model:
    """u from compared pairs that were drawn at random, m from the candidate pairs by EM within each training block (its condition, and the comparisons it fixes)."""
    u = gamma_shares(drawn, comparisons)
    return Model(prior, train_m([(compared.filter(on), fixed) for on, fixed in blocks], comparisons, u, 0.3), u)


def store_model(spark: SparkSession, model: Model, path: str) -> None:
    rows = [(c, k, float(model.m[c][k]), float(model.u[c][k]), model.prior) for c in model.m for k in model.m[c]]
    spark.createDataFrame(rows, "comparison string, level int, m double, u double, prior double").coalesce(1).write.mode("overwrite").parquet(path)


def stored_model(spark: SparkSession, path: str) -> Model:
    rows = spark.read.parquet(path).collect()
    values = {name: {c: {r.level: r[name] for r in rows if r.comparison == c} for c in {r.comparison for r in rows}} for name in ("m", "u")}
    return Model(rows[0].prior, values["m"], values["u"])


def score(pairs: DataFrame, comparisons: Sequence[Comparison], m: dict, u: dict, prior: float, threshold: float = 0.01, frequency: dict[str, Column] | None = None) -> DataFrame:
    """match_weight (log2 odds) and match_probability of pairs that reach the threshold.

    `frequency`: for some comparisons the share of people that have the value agreed on, which stands for u at the first level: rare values say more."""
    weight = F.lit(math.log2(prior / (1 - prior)))
    for c in comparisons:
        # Looked up by level, which is worked out once: a pair below the threshold is dropped where it is made, so its levels stand in the filter itself.
        gamma = F.col(f"gamma_{c.name}")
        step = F.element_at(F.array(F.lit(0.0), *(F.lit(math.log2(m[c.name][k] / u[c.name][k])) for k in range(len(c.levels) + 1))), gamma + 2)
        if frequency and c.name in frequency:
            step = F.when(gamma == 0, F.log2(F.lit(m[c.name][0]) / F.coalesce(frequency[c.name], F.lit(u[c.name][0])))).otherwise(step)
        weight = weight + step
    scored = pairs.withColumn("match_weight", weight).withColumn("match_probability", 1 / (1 + F.pow(F.lit(2.0), -F.col("match_weight"))))
    # Every pair reaches nought: not asked, as each pair would be weighed once more to answer.
    return scored.filter(F.col("match_probability") >= threshold) if threshold > 0 else scored


# --- people of several sources


def harmonise(sources: dict[str, tuple[DataFrame, dict[str, Column]]], nicknames: DataFrame, first: str = "first") -> DataFrame:
    """source and the columns of one person shape, from sources with an expression for each; and `canonical`, the full first name.

    nicknames (a small table): nick, name; a nick of several names stands for the least."""
    people = stack(*(df.select(F.lit(name).alias("source"), *(x.alias(c) for c, x in shape.items())) for name, (df, shape) in sources.items()))
    full = nicknames.groupBy(F.col("nick").alias("__nick")).agg(F.min("name").alias("__name"))
    return people.join(F.broadcast(full), F.col(first) == F.col("__nick"), "left").withColumn("canonical", F.coalesce("__name", first)).drop("__nick", "__name")


def name_levels(a: Column, b: Column, same_person: Column, similarity: Column, name: str, cuts: Sequence[float] = (0.92, 0.88, 0.7)) -> Comparison:
    """First names: equal, one a nickname of the other, then by similarity."""
    return Comparison(name, a.isNull() | b.isNull(), (a == b, same_person, *(similarity >= cut for cut in cuts)))


def date_levels(a: Column, b: Column, name: str) -> Comparison:
    """Dates: equal, one character apart as written, within a month, a year, ten years."""
    days = F.abs(F.datediff(a, b))
    return Comparison(name, a.isNull() | b.isNull(), (a == b, F.levenshtein(a.cast("string"), b.cast("string")) <= 1, days <= 31, days <= 366, days <= 3653))


def deterministic_match(left: DataFrame, right: DataFrame, rules: dict[str, Sequence[str]]) -> DataFrame:
    """id_l, its one candidate id_r (null where rules find several), candidates, and the rules that found any, in order."""
    found = stack(*(
        left.select(F.col("id").alias("id_l"), *on).join(right.select(F.col("id").alias("id_r"), *on), list(on)).select("id_l", "id_r", F.lit(name).alias("rule"))
        for name, on in rules.items()
    ))
    return unique_or_ambiguous(found, "id_l", "id_r").join(found.groupBy("id_l").agg(F.array_sort(F.collect_set("rule")).alias("rules")), "id_l")


def sole_match(left: DataFrame, right: DataFrame, rules: dict[str, Sequence[str]]) -> DataFrame:
    """(id_l, id_r) of those whom all rules together give one candidate. A person meets the least and greatest id of its blocks, so no pairs are made."""
    found = []
    for on in rules.values():
        blocks = right.groupBy(*on).agg(F.min("id").alias("least"), F.max("id").alias("greatest"))
        found.append(left.select(F.col("id").alias("id_l"), *on).join(blocks, list(on)).select("id_l", "least", "greatest"))
    both = stack(*found).groupBy("id_l").agg(F.min("least").alias("id_r"), F.max("greatest").alias("last"))
    return both.filter(F.col("id_r") == F.col("last")).select("id_l", "id_r")


def decide_pairs(scores: DataFrame, auto: float = 0.95, review: float = 0.5) -> DataFrame:
    p = F.col("match_probability")
    return scores.withColumn("decision", F.when(p >= auto, "accept").when(p >= review, "review").otherwise("reject"))


def guarded_sides(left: DataFrame, right: DataFrame, reviews: DataFrame, scores: DataFrame | None = None, auto: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """Both sides of people (id) with what the guards of their pairs need to know of each person, so that it comes along with the pairs and these are not
    joined with it: `reviewed` (some pair of theirs has been reviewed) and, with scores, `rivals` (several pairs of theirs reach `auto`)."""
    out = []
    if scores is not None:
        sides = F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"id_{s}").alias("id")) for s in "lr"))).alias("s")
        counted = scores.filter(F.col("match_probability") >= auto).select(sides).groupBy(F.col("s.side").alias("side"), F.col("s.id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
        strong = settle(counted.filter("n > 1").select("side", "id"))
    for s, people in (("l", left), ("r", right)):
        flags = {"reviewed": reviews.select(F.col(f"id_{s}").alias("__id")).distinct()}
        if scores is not None:
            flags["rivals"] = strong.filter(F.col("side") == s).select(F.col("id").alias("__id"))
        for name, ids in flags.items():
            people = people.join(ids, people.id == ids["__id"], "left").withColumn(name, F.col("__id").isNotNull()).drop("__id")
        out.append(people)
    return out[0], out[1]


def _reviewed(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs that may have been reviewed, as both people have been: few; all others) of pairs that carry `guarded_sides`."""
    may = F.col("reviewed_l") & F.col("reviewed_r")
    return scores.filter(may), scores.filter(~may)


def decide_guarded(scores: DataFrame, reviews: DataFrame, disagrees: Column, auto: float = 0.95, review: float = 0.5) -> DataFrame:
    """decision, reason and decided_by of scored pairs, which carry what `guarded_sides` says of both people.

    Pairs above `auto` are accepted, but for guards that send them to review: the first names disagree, or one side has another pair above `auto`.
    A reviewer's decision (reviews: id_l, id_r, decision) stands before all else. Only pairs of two people who have been reviewed are joined with the reviews."""
    p = F.col("match_probability")
    said = reviews.groupBy("id_l", "id_r").agg(F.max("decision").alias("__said"))
    may, others = _reviewed(scores)
    scores = stack(may.join(said, ["id_l", "id_r"], "left").select(*scores.columns, "__said"), others.withColumn("__said", F.lit(None).cast("string")))
    rivals = F.col("rivals_l") | F.col("rivals_r")
    reason = F.when(F.col("__said").isNotNull(), "reviewed").when(p < review, "low score").when(p < auto, "middling score").when(disagrees, "first name disagrees").when(rivals, "several strong candidates").otherwise("high score")
    decided = scores.withColumn("reason", reason)
    decision = F.coalesce("__said", F.when(F.col("reason") == "low score", "reject").when(F.col("reason") == "high score", "accept").otherwise("review"))
    return decided.withColumn("decision", decision).withColumn("decided_by", F.when(F.col("__said").isNotNull(), "reviewer").otherwise("rules")).drop("__said")


def best_two(scores: DataFrame) -> DataFrame:
    """id, best, p, second and p2 (0 without a second) of the left side's candidates by falling probability, of equal ones by id.

    Candidates are counted by probability, of which pairs of few levels have few, so pairs are put together before they are shuffled; `second` costs a join with
    the pairs where several share the highest probability, but only if it is asked for."""
    tallied = scores.groupBy("id_l", "match_probability").agg(F.count(F.lit(1)).alias("n"), F.min("id_r").alias("least"))
    ranked = tallied.withColumn("nth", F.row_number().over(Window.partitionBy("id_l").orderBy(F.desc("match_probability")))).filter("nth <= 2")
    at = lambda nth, c: F.max(F.when(F.col("nth") == nth, F.col(c)))
    top = ranked.groupBy("id_l").agg(at(1, "least").alias("best"), at(1, "match_probability").alias("p"), at(1, "n").alias("n"), at(2, "least").alias("next"), at(2, "match_probability").alias("next_p"))
    tied = top.filter("n > 1").select("id_l", "best", "p")
    equal = scores.join(tied, "id_l").filter("match_probability = p AND id_r > best").groupBy("id_l").agg(F.min("id_r").alias("equal"))
    p2 = F.when(F.col("n") > 1, F.col("p")).otherwise(F.coalesce("next_p", F.lit(0.0)))
    return top.join(equal, "id_l", "left").select(F.col("id_l").alias("id"), "best", "p", F.coalesce("equal", "next").alias("second"), p2.alias("p2"))


def cross_reference(people: DataFrame, deterministic: DataFrame, scores: DataFrame, reviews: DataFrame, auto: float = 0.95, review: float = 0.5, margin: float = 0.0) -> DataFrame:
    """id, best, second, linked, status and reason of each person.

    people: id. deterministic: id_l, id_r (the one candidate of the rules). scores: id_l, id_r, match_probability, and whether both people have been reviewed, as
    `guarded_sides` says. reviews: id_l, id_r, decision.
    A reviewer's accepted pair is linked; else the rules' candidate or the best scored one above `auto` is proposed, unless it was rejected by a
    reviewer or the runner-up comes within `margin`; a candidate proposed for several people is linked to none of them."""
    rejected = reviews.filter("decision = 'reject'").select("id_l", "id_r").distinct()
    may, others = _reviewed(scores)
    pair = ["id_l", "id_r", "match_probability"]
    top = best_two(stack(may.join(rejected, ["id_l", "id_r"], "left_anti").select(*pair), others.select(*pair)))
    rules = deterministic.join(rejected, ["id_l", "id_r"], "left_anti").filter("id_r IS NOT NULL").groupBy(F.col("id_l").alias("id")).agg(F.min("id_r").alias("by_rule"))
    accepted = reviews.filter("decision = 'accept'").groupBy(F.col("id_l").alias("id")).agg(F.min("id_r").alias("by_review"))
    all_ = people.select("id").join(top, "id", "left").join(rules, "id", "left").join(accepted, "id", "left")
    clear = (F.col("p") >= auto) & (F.col("p") - F.col("p2") > margin)
    proposed = all_.withColumn("proposed", F.coalesce("by_review", "by_rule", F.when(clear, F.col("best"))))
    claims = proposed.filter("proposed IS NOT NULL").groupBy("proposed").agg(F.count(F.lit(1)).alias("claims"))
    found = proposed.join(claims, "proposed", "left")
    reason = (
        F.when(F.col("claims") > 1, "claimed twice").when(F.col("by_review").isNotNull(), "reviewer").when(F.col("by_rule").isNotNull(), "rules").when(clear, "score")
        .when(F.col("p") >= auto, "several strong candidates").when(F.col("p") >= review, "middling score").otherwise("no candidate")
    )
    linked = reason.isin("reviewer", "rules", "score")
    status = F.when(linked, "linked").when(reason == "no candidate", "unlinked").otherwise("review")
    return found.select("id", "best", "second", F.when(linked, F.col("proposed")).alias("linked"), status.alias("status"), reason.alias("reason"))


def review_queue(decided: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairs that wait for a reviewer, with both people's columns (which come along with the pairs) side by side."""
    return decided.filter("decision = 'review'").select("id_l", "id_r", "match_probability", "reason", *(f"{c}_{s}" for s in "lr" for c in columns))


def decision_audit(reviews: DataFrame, decided: DataFrame) -> DataFrame:
    """Each reviewed pair with whether its decision is applied, or stale because the pair is no longer scored. Only pairs of two reviewed people are looked at."""
    now = _reviewed(decided)[0].select("id_l", "id_r", F.col("decision").alias("__now"))
    return reviews.join(now, ["id_l", "id_r"], "left").select(*reviews.columns, F.when(F.col("__now").isNull(), "stale").when(F.col("__now") == F.col("decision"), "applied").otherwise("overridden").alias("state"))


def match_quality(links: DataFrame, truth: DataFrame, scope: DataFrame) -> DataFrame:
    """scope, hits, predicted, actual, precision and recall of links against true links, for all and for each scope of the left side.

    links and truth: id_l, id_r. scope: id_l, scope. Links of a person without a scope count in all alone."""
    both = links.select("id_l", "id_r").distinct().withColumn("p", F.lit(1)).join(truth.select("id_l", "id_r").distinct().withColumn("t", F.lit(1)), ["id_l", "id_r"], "full")
    tagged = both.join(scope.select("id_l", "scope"), "id_l", "left").select("p", "t", F.explode(F.array_distinct(F.array(F.lit("all"), F.coalesce("scope", F.lit("all"))))).alias("scope"))
    counted = tagged.groupBy("scope").agg(F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("hits"), F.count("p").alias("predicted"), F.count("t").alias("actual"))
    precision, recall = precision_recall(F.col("hits"), F.col("predicted"), F.col("actual"))
    return counted.select("scope", "hits", "predicted", "actual", precision.alias("precision"), recall.alias("recall"))


def persons(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """person_id (smallest id of its component) and size for every node."""
    found = connected_components(pairs.select(F.col("id_l").alias("a"), F.col("id_r").alias("b")))
    return nodes.join(found, nodes.id == found.node, "left").select("id", F.coalesce("component", "id").alias("person_id"), F.coalesce("size", F.lit(1)).alias("size"))
