"""Relational shapes as functions from DataFrames to DataFrames: joins, aggregates, windows, set operations."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.shared import settle

# --- joins


def _instant(df: DataFrame, column: str) -> Column:
    """A date, time or number as whole seconds (or units), rounded down."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.unix_seconds(F.col(column).cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.floor(column).cast("long")
    raise TypeError(f"{column} is neither a date, a time nor a number")


#: Widths of the buckets that spans are dealt to grow by this factor; a span goes to those of the width that just holds it.
_WIDER = 8


def spans_at(wanted: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, parts: int = 4) -> DataFrame:
    """(key, at, columns of the spans) of distinct (key, at) pairs `wanted` with each span of the key that holds there; pairs without one do not appear.

    Each span is dealt to the one or two buckets of time, of the width that just holds it, that it touches; each pair looks into one bucket of each width that
    its key's spans have (a dozen at most). So a key with very many spans and instants meets in many buckets, each with few spans that do not hold. A null end
    counts as the latest instant looked for. A bucket's instants are dealt to `parts` tasks, as one long span may hold at most of them."""
    latest = wanted.agg(F.max(_instant(wanted, at)).alias("__latest"))
    first, last = _instant(spans, start), F.coalesce(_instant(spans, end), F.col("__latest"))
    dealt = spans.filter(F.col(key).isNotNull()).crossJoin(F.broadcast(latest)).withColumn("__first", first).withColumn("__last", last).filter("__first <= __last")
    dealt = dealt.withColumn("__level", F.ceil(F.log(float(_WIDER), F.col("__last") - F.col("__first") + 1)).cast("int"))
    wide = F.pow(F.lit(_WIDER), F.col("__level")).cast("long")
    touched = F.sequence(F.floor(F.col("__first") / wide), F.floor(F.col("__last") / wide))
    dealt = dealt.withColumn("__bucket", F.explode(touched)).withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    levels = dealt.groupBy(key).agg(F.collect_set("__level").alias("__levels"))
    looked = wanted.withColumn("__at", _instant(wanted, at)).filter("__at IS NOT NULL").join(levels, key).withColumn("__level", F.explode("__levels"))
    looked = looked.select(key, at, "__level", F.floor(F.col("__at") / F.pow(F.lit(_WIDER), F.col("__level")).cast("long")).alias("__bucket"), F.pmod(F.xxhash64(at), F.lit(parts)).cast("int").alias("__part"))
    met = looked.join(dealt.select(key, "__level", "__bucket", "__part", *(c for c in spans.columns if c != key)), [key, "__level", "__bucket", "__part"])
    return met.filter((F.col(start) <= F.col(at)) & (F.col(end).isNull() | (F.col(end) >= F.col(at)))).select(key, at, *(c for c in spans.columns if c != key))


def interval_join(events: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, reduce_to: str = "all", id_cols: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """Events with the spans of their key that hold on their date (a null end is open). `min` keeps the least `value` of the
    spans per event (null without one), `latest` the span that starts last for each event as `id_cols` name it (of these the least `value`, nulls last), `all`
    every one; events without a span stay, and repeated ones stay repeated but under `latest`.

    Spans are looked up, and reduced, once for each distinct (key, date); events then take what belongs to theirs."""
    others = [c for c in spans.columns if c != key]
    found = spans_at(events.select(key, at).distinct(), spans, key, at, start, end)
    if reduce_to == "min":
        return events.join(found.groupBy(key, at).agg(F.min(value).alias(value)), [key, at], "left").select(*events.columns, value)
    if reduce_to == "all":
        return events.join(found, [key, at], "left").select(*events.columns, *others)
    # The least of these is the span that starts last, and of several the one of the least value.
    moment = F.unix_micros(F.col(start).cast("timestamp")) if not isinstance(spans.schema[start].dataType, T.NumericType) else F.col(start)
    order = F.struct(-moment, F.col(value).isNull(), F.col(value))
    one = found.groupBy(key, at).agg(F.min_by(F.struct(*others), F.struct(F.col(start).isNull(), order)).alias("__span"))
    taken = events.join(one, [key, at], "left").select(*events.columns, *(F.col(f"__span.{c}").alias(c) for c in others))
    rank = F.struct(F.col(start).isNull(), order, *(c for c in events.columns if c not in id_cols and not isinstance(events.schema[c].dataType, T.MapType)))
    rest = [c for c in taken.columns if c not in id_cols]
    return taken.groupBy(*id_cols).agg(F.min_by(F.struct(*rest), rank).alias("__row")).select(*(F.col(c) if c in id_cols else F.col(f"__row.{c}").alias(c) for c in taken.columns))


def versioned_lookup(codes: DataFrame, reference: DataFrame, on: str, at: str, valid_from: str, valid_to: str) -> DataFrame:
    """Codes with the version of the reference that held on their date. Distinct (code, date) pairs are looked up once."""
    wanted = codes.select(on, at).distinct()
    found = interval_join(wanted, reference, on, at, valid_from, valid_to)
    return codes.join(found, [on, at], "left")


#: Rows of a block that meet in one task at most; larger blocks are cut into parts.
TILE_ROWS = 2048

#: Pairs that one task makes, about. Pairs grow faster than the rows they are made of, so the number of tasks is set by them.
TASK_PAIRS = 20_000_000


def _tiled(left: DataFrame, right: DataFrame | None, keys: Sequence[str], tile_rows: int) -> DataFrame:
    """(l, r) of the pairs of structs whose keys agree: each pair of `left` with `right`, or, without it, each pair of `left` with different ids, smaller id first.

    left, right: the keys, and a struct `row` with an `id`. A block of more than `tile_rows` rows on a side is cut into parts by a hash of the id; each pair of
    parts (for a table with itself, each pair once) is a tile of its own, so no task holds a block, however large, and no pair is made twice. The pairs are counted
    first, and blocks or tiles dealt to so many tasks that each makes about `TASK_PAIRS`."""
    one = right is None
    sides = [left] if one else [left, right]
    sides = [df.dropna(subset=list(keys)).filter("row.id IS NOT NULL") for df in sides]
    sizes = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) for df in sides]
    blocks = sizes[0].withColumn("m", F.col("n")) if one else sizes[0].join(sizes[1].withColumnRenamed("n", "m"), list(keys))
    found = blocks.agg(F.max(F.greatest("n", "m")).alias("rows"), F.sum(F.col("n").cast("double") * F.col("m")).alias("pairs")).first()
    tasks = int((found.pairs or 0) / TASK_PAIRS) + 1
    deal = lambda df, *by: df.repartition(tasks, *by) if tasks > 1 else df
    if (found.rows or 0) <= tile_rows:
        met = deal(sides[0].withColumnRenamed("row", "l"), *keys).join(deal(sides[-1].withColumnRenamed("row", "r"), *keys), list(keys))
        return (met.filter("l.id < r.id") if one else met).select("l", "r")
    parts = lambda df, k: df.select(*keys, F.ceil(F.col("n") / tile_rows).cast("int").alias(f"parts_{k}"))
    cut = parts(sizes[0].filter("n > 1"), 0).withColumn("parts_1", F.col("parts_0")) if one else parts(sizes[0], 0).join(parts(sizes[1], 1), list(keys))
    sent = []
    for k, df in enumerate((sides[0], sides[-1])):
        dealt = salted_join(df.withColumn("__id", F.col("row.id")), cut, keys, "__id")
        own = F.pmod(F.xxhash64("__id"), F.col(f"parts_{k}")).cast("int")
        other = F.col(f"parts_{1 - k}") - 1
        # Of a table with itself, part p is the left side of tiles (p, q) with q from p on, and the right side of tiles (q, p) with q up to p.
        meets = (F.sequence(own, other) if k == 0 else F.sequence(F.lit(0), own)) if one else F.sequence(F.lit(0), other)
        mine, theirs = ("i", "j") if k == 0 else ("j", "i")
        sent.append(dealt.withColumn(mine, own).withColumn(theirs, F.explode(meets)).select(*keys, "i", "j", F.col("row").alias("lr"[k])))
    met = deal(sent[0], *keys, "i", "j").join(deal(sent[1], *keys, "i", "j"), [*keys, "i", "j"])
    if not one:
        return met.select("l", "r")
    met = met.filter((F.col("i") < F.col("j")) | (F.col("l.id") < F.col("r.id")))
    swapped = F.col("l.id") > F.col("r.id")
    return met.select(F.when(swapped, F.col("r")).otherwise(F.col("l")).alias("l"), F.when(swapped, F.col("l")).otherwise(F.col("r")).alias("r"))


def pairs_in_group(df: DataFrame, id_col: str, keys: Sequence[str], tile_rows: int = TILE_ROWS) -> DataFrame:
    """Ordered pairs of rows with equal keys; ids are unique."""
    rows = df.select(*keys, F.struct(F.col(id_col).alias("id")).alias("row"))
    return _tiled(rows, None, keys, tile_rows).select(F.col("l.id").alias("id_l"), F.col("r.id").alias("id_r"))


def candidate_pairs(people: DataFrame, id_col: str, rules: Sequence[Sequence[str]], right: DataFrame | None = None, tile_rows: int = TILE_ROWS, carry: Sequence[str] = ()) -> DataFrame:
    """(id_l, id_r, rule): pairs that agree on a rule's columns, under the first rule that finds them; ids are unique.

    The columns named in `carry` come along from both sides (`x_l`, `x_r`), so that pairs are compared where they are made and never shuffled."""
    columns = sorted({c for rule in rules for c in rule})
    # What a rule compares is sent once, though it is carried too.
    sent = {c: c if c in columns else f"carried_{k}" for k, c in enumerate(carry)}
    row = F.struct(F.col(id_col).alias("id"), *columns, *(F.col(c).alias(name) for c, name in sent.items() if c not in columns))
    parts = []
    for k, rule in enumerate(rules):
        found = _tiled(people.select(*rule, row.alias("row")), None if right is None else right.select(*rule, row.alias("row")), rule, tile_rows)
        for earlier in rules[:k]:
            agree = reduce(lambda x, y: x & y, (F.col(f"l.{c}") == F.col(f"r.{c}") for c in earlier))
            found = found.filter(~F.coalesce(agree, F.lit(False)))
        carried = [F.col(f"{s}.{name}").alias(f"{c}_{s}") for c, name in sent.items() for s in "lr"]
        parts.append(found.select(F.col("l.id").alias("id_l"), F.col("r.id").alias("id_r"), F.lit(k).alias("rule"), *carried))
    return stack(*parts)


def agreeing_pairs(pairs: DataFrame, people: DataFrame, id_col: str, rules: Sequence[Sequence[str]], right: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """What `candidate_pairs` gives of the given pairs (id_l, id_r) alone. People meet only the pairs that name them, so no other pair is made."""
    columns = sorted({*carry, *(c for rule in rules for c in rule)})
    sides = [df.select(F.col(id_col).alias(f"id_{s}"), F.struct(*columns).alias(s)) for s, df in (("l", people), ("r", people if right is None else right))]
    met = pairs.select("id_l", "id_r").distinct().join(sides[0], "id_l").join(sides[1], "id_r")
    if right is None:
        met = met.filter("id_l < id_r")
    agree = (reduce(lambda x, y: x & y, (F.col(f"l.{c}") == F.col(f"r.{c}") for c in rule)) for rule in rules)
    first = F.coalesce(*(F.when(both, F.lit(k)) for k, both in enumerate(agree)))
    carried = [F.col(f"{s}.{c}").alias(f"{c}_{s}") for c in carry for s in "lr"]
    return met.withColumn("rule", first).filter("rule IS NOT NULL").select("id_l", "id_r", "rule", *carried)


def blocking_report(people: DataFrame, id_col: str, rules: Sequence[Sequence[str]]) -> DataFrame:
    """rule, marginal and cumulative number of pairs, and all possible pairs, of `candidate_pairs` over one table with unique ids, without making a pair.

    The pairs of a rule that no earlier rule finds are counted by inclusion and exclusion: pairs that agree on a set of columns are n (n - 1) / 2 for each of its
    values, and with each further rule that they must also agree on, the sign changes. All sets are counted in one pass."""
    terms: Counter[tuple[int, tuple[str, ...]]] = Counter()
    for k, rule in enumerate(rules):
        for size in range(k + 1):
            for earlier in combinations(rules[:k], size):
                terms[k, tuple(sorted({*rule, *(c for r in earlier for c in r)}))] += (-1) ** size
    sets = sorted({columns for _, columns in terms})
    every = sorted({c for columns in sets for c in columns})
    known = people.filter(F.col(id_col).isNotNull())
    empty = {c: F.lit(None).cast(known.schema[c].dataType) for c in every}
    keyed = [
        F.when(reduce(lambda x, y: x & y, (F.col(c).isNotNull() for c in columns)), F.struct(F.lit(n).alias("set"), *((F.col(c) if c in columns else empty[c]).alias(c) for c in every)))
        for n, columns in enumerate(sets)
    ]
    counted = known.select(F.explode(F.array_compact(F.array(*keyed))).alias("k")).groupBy("k").agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("n"))
    pairs = counted.groupBy(F.col("k.set").alias("set")).agg(F.sum(F.expr("n * (n - 1) / 2").cast("decimal(38,0)")).alias("pairs"))
    spark = people.sparkSession
    signs = spark.createDataFrame([(k, sets.index(columns), sign) for (k, columns), sign in terms.items()], "rule int, set int, sign int")
    marginal = F.coalesce(F.sum((F.col("pairs") * F.col("sign")).cast("decimal(38,0)")), F.lit(0)).cast("long")
    summed = F.broadcast(signs).join(pairs, "set", "left").groupBy("rule").agg(marginal.alias("marginal"))
    n = people.agg((F.count(F.lit(1)) * (F.count(F.lit(1)) - 1) / 2).cast("long").alias("possible"))
    return summed.select("rule", "marginal", F.sum("marginal").over(Window.orderBy("rule")).alias("cumulative")).crossJoin(F.broadcast(n))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias("__p")), F.col(child_key) == F.col("__p"), "left_anti")


def lookup_roles(df: DataFrame, dim: DataFrame, dim_key: str, roles: dict[str, str]) -> DataFrame:
    """The same dimension joined once for each role: prefix -> key column."""
    for prefix, key in roles.items():
        df = df.join(dim.select(*(F.col(c).alias(f"{prefix}{c}") for c in dim.columns)), F.col(key) == F.col(f"{prefix}{dim_key}"), "left")
    return df


def salted_join(many: DataFrame, one: DataFrame, key: str | Sequence[str], by: str, parts: int = 16) -> DataFrame:
    """Inner join on a key that may be hot in `many`: its rows are dealt to `parts` shares by another column, and the few rows of `one` go to each.

    Neither side is broadcast: Spark takes a side's size from its compressed files and sees nothing of the copies made here, so a side that grows with the input could
    go through the driver."""
    dealt = many.withColumn("__part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int")).hint("merge")
    keys = [key] if isinstance(key, str) else list(key)
    return dealt.join(one.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))), [*keys, "__part"]).drop("__part")


#: Rows of one key beyond which a join deals them to several shares.
HOT_ROWS = 100_000


def hot_join(many: DataFrame, one: DataFrame, key: str, by: str, count: str, hot_rows: int | None = None) -> DataFrame:
    """Inner join of `many` with `one`, one row a key, which says in `count` (dropped) about how many rows of `many` have it. Only keys of more than `hot_rows` are dealt to
    shares by another column, as many as their rows need; these keys, at most one for so many rows, go to every task, and all other rows are sent once."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    shares = F.ceil(F.col(count) / hot_rows).cast("int")
    hot = settle(one.filter(F.col(count) > hot_rows).select(key, shares.alias("__shares")))
    if hot.isEmpty():
        return many.join(one.drop(count), key)
    dealt = many.join(F.broadcast(hot), key, "left").withColumn("__part", F.coalesce(F.pmod(F.xxhash64(by), F.col("__shares")), F.lit(0)).cast("int")).drop("__shares")
    sent = one.withColumn("__part", F.explode(F.sequence(F.lit(0), F.greatest(shares, F.lit(1)) - 1))).drop(count)
    return dealt.join(sent, [key, "__part"]).drop("__part")


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of edges (a, b): the smallest node reachable.

    Alternating star steps: every node's larger neighbours, then its smaller ones, are hung on its smallest neighbour. Each step is
    written to the shared folder, and their number grows with the logarithm of the longest path. A node with very many
    neighbours is found by a pre-aggregated minimum, which is then brought to its edges in shares; all others are sent once."""
    edges = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count_if(F.col("b") > F.col("a")).alias("n")).filter("n > 0")
        up = settle(hot_join(both.filter("b > a"), lowest, "a", "b", "n").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = up.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        down = hot_join(up, least, "a", "b", "n").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = settle(down.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        centres = edges.select(F.col("b").alias("a")).distinct()
        if edges.join(centres, "a", "left_semi").isEmpty() and edges.groupBy("a").count().filter("count > 1").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres.select(F.col("a").alias("node"), F.col("a").alias("component")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component, size) of the nodes of edges (a, b): the smallest node reachable, and how many nodes reach it."""
    named = component_labels(edges)
    sizes = named.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return hot_join(named, sizes.withColumn("n", F.col("size")), "component", "node", "n").select("node", "component", "size")


def reference_closure(focal: DataFrame, edges: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((focal, target) for everything reachable from each focal node, references that lead nowhere)."""
    seen = frontier = settle(focal.select(F.col("id").alias("focal"), F.col("id").alias("target")))
    while True:
        found = frontier.join(edges.select(F.col("source").alias("target"), F.col("target").alias("next")), "target").select("focal", F.col("next").alias("target")).distinct()
        frontier = settle(found.join(seen, ["focal", "target"], "left_anti"))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    known = targets.select(F.col("id").alias("target"))
    return seen.join(known, "target", "left_semi").select("focal", "target"), seen.join(known, "target", "left_anti").select("focal", "target")


# --- places in an order


def in_ranges(df: DataFrame, order: Sequence[str | Column], ranges: int | None = None) -> DataFrame:
    """Rows dealt in order to ranges of like size: `__range` numbers these in order, `__tie` tells apart rows that the order leaves alike, so that
    rows of one key, or equal rows, however many, fill several ranges. Written once, so that all that is worked out from it sees the same bounds."""
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(ranges, *order, "__tie") if ranges else tied.repartitionByRange(*order, "__tie")
    return settle(dealt.withColumn("__range", F.spark_partition_id()))


def placed(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], ranges: int | None = None) -> DataFrame:
    """Rows with `pos`, their place in their group's order from 0 without gaps, and `n`, the rows of the group. Groups may hold most of the rows: they are
    counted by range, and only these counts are summed along a group. Rows that the order leaves alike have places in any order."""
    at = in_ranges(df, [*group, *order], ranges)
    whole = Window.partitionBy(*group)
    counts = at.groupBy(*group, "__range").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = counts.select(*(F.col(g).alias(f"__g{k}") for k, g in enumerate(group)), F.col("__range").alias("__r"), before.alias("__before"), F.sum("__rows").over(whole).alias("n"))
    own = at.withColumn("__own", F.row_number().over(Window.partitionBy(*group, "__range").orderBy(*order, "__tie")))
    alike = reduce(lambda a, b: a & b, (F.col(g).eqNullSafe(F.col(f"__g{k}")) for k, g in enumerate(group)), F.col("__range") == F.col("__r"))
    return own.join(sums, alike).select(*df.columns, (F.col("__before") + F.col("__own") - 1).alias("pos"), "n")


def largest_group(df: DataFrame, key: Sequence[str]) -> int:
    """The number of rows of the largest group."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0] or 0


def ranked_values(df: DataFrame, group: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """(group, value, __from, __to, n): each distinct value with the places from 0 that it takes in its group's order, and the number of values of the group."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("__times"))
    at = in_ranges(counted, [*group, value], ranges)
    whole, inside = Window.partitionBy(*group), Window.partitionBy(*group, "__range").orderBy(value)
    sums = at.groupBy(*group, "__range").agg(F.sum("__times").alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*(F.col(g).alias(f"__g{k}") for k, g in enumerate(group)), F.col("__range").alias("__r"), before.alias("__before"), F.sum("__rows").over(whole).alias("n"))
    alike = reduce(lambda a, b: a & b, (F.col(g).eqNullSafe(F.col(f"__g{k}")) for k, g in enumerate(group)), F.col("__range") == F.col("__r"))
    placed_values = at.withColumn("__upto", F.sum("__times").over(inside.rowsBetween(Window.unboundedPreceding, 0))).join(sums, alike)
    return placed_values.select(*group, value, (F.col("__before") + F.col("__upto") - F.col("__times")).alias("__from"), (F.col("__before") + F.col("__upto") - 1).alias("__to"), "n")


def quantiles(df: DataFrame, group: Sequence[str], value: str, wanted: dict[str, float], ranges: int | None = None) -> DataFrame:
    """(group, a column of each name in `wanted`): exact continuous quantiles (interpolated between neighbouring places) of a group's values, nulls left out.

    Values are counted, put in order in ranges and placed; only the one or two values around each quantile meet in an aggregate, so a group may hold any number
    of different values. Groups without a value do not appear."""
    placed_values = ranked_values(df, group, value, ranges)
    sides = {}
    for name, p in wanted.items():
        rank = F.lit(float(p)) * (F.col("n") - 1)
        for side, at in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            sides[f"{name}_{side}"] = F.when((F.col("__from") <= at) & (at <= F.col("__to")), F.col(value))
    near = placed_values.filter(reduce(lambda a, b: a | b, (c.isNotNull() for c in sides.values())))
    found = near.groupBy(*group).agg(F.first("n").alias("n"), *(F.max(c).cast("double").alias(f"__{name}") for name, c in sides.items()))
    part = {name: F.lit(float(p)) * (F.col("n") - 1) - F.floor(F.lit(float(p)) * (F.col("n") - 1)) for name, p in wanted.items()}
    between = lambda name: F.col(f"__{name}_low") * (1 - part[name]) + F.col(f"__{name}_high") * part[name]
    return found.select(*group, *(F.when(F.col(f"__{name}_low") == F.col(f"__{name}_high"), F.col(f"__{name}_low")).otherwise(between(name)).alias(name) for name in wanted))


# --- aggregates


def unique_or_ambiguous(df: DataFrame, key: str, candidate: str) -> DataFrame:
    """The one candidate of each key, null where there are several; and how many there are."""
    return df.groupBy(key).agg(F.countDistinct(candidate).alias("candidates"), F.when(F.countDistinct(candidate) == 1, F.min(candidate)).alias(candidate))


def claimed_by_many(df: DataFrame, target: str, owner: str) -> DataFrame:
    return df.groupBy(target).agg(F.countDistinct(owner).alias("owners")).filter("owners > 1")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def pivot_metrics(df: DataFrame, key: str, metric: str, value: str, wanted: Sequence[str]) -> DataFrame:
    return df.groupBy(key).pivot(metric, list(wanted)).agg(F.max(value))


def scoped_agg(df: DataFrame, scopes: Column, aggs: Sequence[Column]) -> DataFrame:
    """Aggregates over overlapping groups: a row counts in each scope that it names."""
    return df.withColumn("scope", F.explode(F.array_distinct(scopes))).groupBy("scope").agg(*aggs)


def issue_scorecard(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """check, issues, population: all checks (issue, population) of a table in one pass over it."""
    counted = df.agg(*(f for name, (issue, population) in checks.items() for f in (F.count_if(issue & population).alias(f"{name}__i"), F.count_if(population).alias(f"{name}__p"))))
    rows = F.array(*(F.struct(F.lit(n).alias("check"), F.col(f"{n}__i").alias("issues"), F.col(f"{n}__p").alias("population")) for n in checks))
    return counted.select(F.inline(rows))


# --- windows


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. Each task sends on one row a key, so a key may have any number of rows."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__n = 1").drop("__n")


#: Rows of a group that one task may put in order; larger groups are put in order in ranges.
GROUP_ROWS = 1 << 20


def dedupe_with_count(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key, and how many rows the key has (`versions`). Each task sends on one row and one count a key."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("versions")).select(*(F.col(c).alias(f"__g{k}") for k, c in enumerate(key)), "versions")
    alike = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__g{k}")) for k, c in enumerate(key)))
    return latest_per_key(df, key, order).join(counts, alike).select(*df.columns, "versions")


def gap_seconds(df: DataFrame, key: str, at: str, tie: str, group_rows: int = GROUP_ROWS, ranges: int | None = None) -> DataFrame:
    """Rows with `gap_s`, the seconds since the row before it in its key's order (null for the first).

    Where a key has more than `group_rows` rows, rows are dealt to ranges of the order, and each range's first rows take over the last ones of the range before."""
    if largest_group(df, [key]) <= group_rows:
        before = F.lag(at).over(Window.partitionBy(key).orderBy(at, tie))
        return df.withColumn("gap_s", (F.unix_millis(at) - F.unix_millis(before)) / 1000)
    spread = in_ranges(df, [key, at, tie], ranges)
    # The last row of each key in each range; of ranges that follow one another the key's rows do so too.
    ends = spread.groupBy(key, "__range").agg(F.max_by(F.struct(F.col(at).alias("at")), F.struct(at, tie, "__tie")).alias("__end"))
    carried = ends.select(F.col(key).alias("__k"), F.col("__range").alias("__r"), F.lag("__end").over(Window.partitionBy(key).orderBy("__range")).alias("__carried"))
    own = F.lag(F.struct(F.col(at).alias("at"))).over(Window.partitionBy(key, "__range").orderBy(at, tie, "__tie"))
    both = spread.withColumn("__own", own).join(carried, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__range") == F.col("__r")))
    before = F.coalesce("__own", "__carried").getField("at")
    return both.select(*df.columns, ((F.unix_millis(at) - F.unix_millis(before)) / 1000).alias("gap_s"))


def best_and_second(df: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The row with the highest score of each key (ties by `tie`), beside `second_` columns of the next. Each task sends on two rows a key, so a key may have
    any number of rows."""
    by = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(tie).asc())
    two = df.withColumn("__n", F.row_number().over(by)).filter("__n <= 2")
    next_by = Window.partitionBy(key).orderBy("__n")
    return two.select("*", F.lead(tie).over(next_by).alias(f"second_{tie}"), F.lead(score).over(next_by).alias(f"second_{score}")).filter("__n = 1").drop("__n")


def numbered(df: DataFrame, key: Sequence[str], order: Sequence[Column], number: str = "number", first: str = "is_first", group_rows: int = GROUP_ROWS, ranges: int | None = None) -> DataFrame:
    """Rows with their place in their series, from 1, and whether they are its first. Series of more than `group_rows` rows are numbered in ranges."""
    if largest_group(df, key) <= group_rows:
        n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        return df.withColumn(number, n).withColumn(first, F.col(number) == 1)
    return placed(df, key, order, ranges).select(*df.columns, (F.col("pos") + 1).cast("int").alias(number), (F.col("pos") == 0).alias(first))


def with_latest(df: DataFrame, rows: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each row with some columns of the latest row of its key (null without one); the latest is reduced before it is joined."""
    last = rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__last"))
    return df.join(last, key, "left").select(*df.columns, *(F.col(f"__last.{c}").alias(c) for c in columns))


def decided_join(df: DataFrame, decisions: DataFrame, keys: Sequence[Sequence[str]], decision: str, wanted: str, columns: Sequence[str]) -> DataFrame:
    """Rows with columns of the decision `wanted` that fits one of several keys, an earlier key before a later one; of several decisions the greatest."""
    found = df
    for k, on in enumerate(keys):
        one = decisions.filter(F.col(decision) == wanted).groupBy(*on).agg(F.max(F.struct(*columns)).alias(f"__{k}"))
        found = found.join(one, list(on), "left")
    return found.select(*df.columns, *(F.coalesce(*(F.col(f"__{k}.{c}") for k in range(len(keys)))).alias(c) for c in columns))


# --- sorts, samples, sets


def scopes_first(df: DataFrame, scope: str, *then: str, whole: str = "all") -> DataFrame:
    """Rows in order: the whole before its parts, then by scope and further columns."""
    return df.orderBy((F.col(scope) == whole).desc(), F.asc_nulls_last(scope), *(F.asc_nulls_last(c) for c in then))


def latest_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The latest n rows of a series; as a limited sort, no task holds more than n."""
    return df.orderBy(*(F.desc(c) for c in order)).limit(n)


def only_if(df: DataFrame, wanted: bool) -> DataFrame:
    """The table, or none of its rows where the input is switched off."""
    return df if wanted else df.filter(F.lit(False))


def stable_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """The first n rows by a hash of seed and id: the same rows on every run."""
    return df.orderBy(F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string"))), id_col).limit(n)


def top_counts(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), *keys).limit(n)


def stack(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """only_a, only_b: rows that one bag has more often than the other, in one shuffle."""
    signed = a.withColumn("__s", F.lit(1)).unionByName(b.withColumn("__s", F.lit(-1)))
    rest = signed.groupBy(*a.columns).agg(F.sum("__s").alias("__s"))
    return rest.agg(F.coalesce(F.sum(F.greatest("__s", F.lit(0))), F.lit(0)).alias("only_a"), F.coalesce(F.sum(F.greatest(-F.col("__s"), F.lit(0))), F.lit(0)).alias("only_b"))


def expand_months(df: DataFrame, start: str, end: str, as_col: str) -> DataFrame:
    """One row for each month that a span touches; none where an end lies before its start."""
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    return df.filter(last >= first).withColumn(as_col, F.explode(F.sequence(first, last, F.expr("interval 1 month"))))
