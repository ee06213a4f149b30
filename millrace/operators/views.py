"""Declarative flattening of JSON documents held as VARIANT or as text.

An expression is a function from the focus, an array of VARIANT, to another such array: missing gives none, an array its elements, a scalar itself.
A column takes the one value of its expression and raises an error where there are several, unless it is a collection.

A view is compiled before it runs: its expressions are tried on a focus that only notes which members they take, and each document and each item of a
`for_each` is then read once into a struct of just these members (`from_json` with a pruned schema for text). Members stay VARIANT, as they may be arrays or not.

Numbers: whole ones and decimals are compared and added exactly, as far as 38 digits hold them; floating-point ones as such.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

class Focused:
    """The one item that expressions start from: as VARIANT, and its members by name where it has been read into a struct."""

    def __init__(self, items: Callable[[], Column], member: Callable[[str], Column]):
        self._items, self.member = items, member

    @property
    def items(self) -> Column:
        return self._items()


Focus = Callable[["Column | Focused"], Column]
_KIND = "array<variant>"
_WIDE, _SHORT = "decimal(38,18)", "decimal(18,9)"


def _none() -> Column:
    return F.array().cast(_KIND)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, as the only element of a list."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def single(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_number(v: Column) -> Column:
    return ~_kind(v).isin("STRING", "BOOLEAN", "VOID") & F.try_variant_get(v, "$", "double").isNotNull()


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _exact(*values: Column) -> Column:
    """Whether numbers are whole or decimal, not floating-point."""
    return reduce(operator.and_, (_kind(v).rlike("^(BIGINT|DECIMAL)") for v in values))


def _short(v: Column) -> Column:
    """Whether a number has at most nine digits before and after its point, so that products and quotients of two are exact or rounded at the 18th."""
    scale = F.regexp_extract(_kind(v), r",(\d+)\)", 1)
    whole = F.try_variant_get(v, "$", "decimal(9,0)").isNotNull()
    return whole & ((_kind(v) == "BIGINT") | (scale.try_cast("int") <= 9))


def _pruned(names: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"`{n}`: variant" for n in names) + ">"


def _gone(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def _elements(v: Column, kind: str) -> Column:
    """A member's items, each read as a type: none if it is missing, an array's elements, else itself."""
    return F.when(_gone(v), F.array().cast(f"array<{kind}>")).otherwise(F.coalesce(F.try_variant_get(v, "$", f"array<{kind}>"), F.array(F.try_variant_get(v, "$", kind))))


def _items(v: Column) -> Column:
    return F.when(_gone(v), _none()).otherwise(F.coalesce(F.try_variant_get(v, "$", _KIND), F.array(v)))


def _below(v: Column, names: Sequence[str]) -> Column:
    """The items at the end of a chain of members of a member."""
    if not names:
        return _items(v)
    return F.flatten(F.transform(_elements(v, _pruned(names[:1])), lambda e: _below(e.getField(names[0]), names[1:])))


@dataclass(frozen=True)
class Expr:
    run: Focus
    #: Names of members, where the expression is nothing but a chain of them from the focus.
    chain: tuple[str, ...] | None = None
    #: Names and places, where it is nothing but members and, right after a member, one of its items.
    route: tuple[str | int, ...] | None = None

    def get(self, name: str) -> Expr:
        chain = None if self.chain is None else (*self.chain, name)
        route = None if self.route is None else (*self.route, name)

        def items(c: Column | Focused) -> Column:
            if chain is not None and isinstance(c, Focused):
                return _below(c.member(chain[0]), chain[1:])
            return F.flatten(F.transform(self.run(c), lambda v: bound(F.try_variant_get(v, f"$.{name}", "variant"), _items)))

        return Expr(items, chain, route)

    def path(self, dotted: str) -> Expr:
        out = self
        for name in dotted.split("."):
            out = out.get(name)
        return out

    def index(self, k: int) -> Expr:
        return Expr(lambda c: F.slice(self.run(c), k + 1, 1), route=(*self.route, k) if self.route and isinstance(self.route[-1], str) else None)

    def first(self) -> Expr:
        return self.index(0)

    def last(self) -> Expr:
        return Expr(lambda c: F.when(F.size(self.run(c)) > 0, F.slice(self.run(c), -1, 1)).otherwise(self.run(c)))

    def where(self, name: str, value: str) -> Expr:
        """Items whose member `name` equals a text."""
        return Expr(lambda c: F.filter(self.run(c), lambda v: F.coalesce(F.try_variant_get(v, f"$.{name}", "string") == value, F.lit(False))))

    def filter(self, test: Callable[[Expr], Focus]) -> Expr:
        """Items for which a condition on the item itself holds; an empty condition does not hold."""
        return Expr(lambda c: F.filter(self.run(c), lambda v: F.coalesce(test(this())(F.array(v)), F.lit(False))))

    def compare(self, op: str, other: Expr) -> Focus:
        """`=`, `!=`, `<`, `<=`, `>` or `>=` of the one value of each side: numbers as numbers, all else as text; null where a side is empty."""
        ops: dict[str, Callable[[Column, Column], Column]] = {"=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
        test = ops[op]

        def values(x: Column, y: Column) -> Column:
            decimal = F.when(_exact(x, y), test(_as(x, _WIDE), _as(y, _WIDE)))
            numbers = F.coalesce(decimal, test(_as(x, "double"), _as(y, "double")))
            return F.when(_is_number(x) & _is_number(y), numbers).otherwise(test(x.cast("string"), y.cast("string")))

        return lambda c: bound(single(self.run(c)), lambda x: bound(single(other.run(c)), lambda y: F.when(x.isNotNull() & y.isNotNull(), values(x, y))))

    def arithmetic(self, op: str, other: Expr) -> Expr:
        """`+`, `-`, `*` or `/` of the one value of each side: whole numbers stay whole but for `/`, decimals (and quotients) are decimal, to 18 digits
        behind the point; floating-point only where a side is, or where the digits do not suffice. Nothing where a side is empty or no number."""
        ops: dict[str, Callable[[Column, Column], Column]] = {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply, "/": F.try_divide}
        make = ops[op]

        def values(x: Column, y: Column) -> Column:
            as_ = lambda kind: make(_as(x, kind), _as(y, kind)).cast("variant")
            whole = (_kind(x) == "BIGINT") & (_kind(y) == "BIGINT") & F.lit(op != "/")
            decimal = F.when(_exact(x, y), as_(_WIDE)) if op in "+-" else F.when(_exact(x, y) & _short(x) & _short(y), as_(_SHORT))
            return F.when(_is_number(x) & _is_number(y), F.coalesce(F.when(whole, as_("bigint")), decimal, as_("double")))

        found = lambda c: bound(single(self.run(c)), lambda x: bound(single(other.run(c)), lambda y: F.when(x.isNotNull() & y.isNotNull(), values(x, y))))
        return Expr(lambda c: bound(found(c), lambda v: F.when(v.isNull(), _none()).otherwise(F.array(v))))

    def union(self, other: Expr) -> Expr:
        """The items of both, each value once, where it comes first."""

        def distinct(items: Column) -> Column:
            return bound(F.transform(items, lambda v: F.to_json(v)), lambda texts: F.filter(items, lambda v, k: F.array_position(texts, F.to_json(v)) == k + 1))

        return Expr(lambda c: bound(F.concat(self.run(c), other.run(c)), distinct))

    def repeat(self, *names: str, depth: int = 10) -> Expr:
        """Members of these names, theirs and so on, each before its own, to a depth."""

        def below(v: Column, left: int) -> Column:
            children = F.concat(*(this().get(name).run(F.array(v)) for name in names))
            return children if left == 1 else F.flatten(F.transform(children, lambda x: F.concat(F.array(x), below(x, left - 1))))

        return Expr(lambda c: F.flatten(F.transform(self.run(c), lambda v: below(v, depth))))

    def values_of(self, kind: str) -> Expr:
        """Items whose own value is of a type: text, boolean, integer or decimal."""
        kinds = {"string": ["STRING"], "boolean": ["BOOLEAN"], "integer": ["BIGINT"]}
        return Expr(lambda c: F.filter(self.run(c), lambda v: F.schema_of_variant(v).isin(*kinds[kind]) if kind in kinds else _is_number(v) & ~F.schema_of_variant(v).isin("BIGINT")))

    def extension(self, url: str) -> Expr:
        return self.get("extension").where("url", url)

    def of_type(self, name: str, kind: str) -> Expr:
        """A choice element: member `name` with the type's name behind it."""
        return self.get(name + kind[0].upper() + kind[1:])

    def exists(self) -> Focus:
        return lambda c: F.size(self.run(c)) > 0

    def empty(self) -> Focus:
        return lambda c: F.size(self.run(c)) == 0

    def count(self) -> Focus:
        return lambda c: F.size(self.run(c))

    def texts(self) -> Focus:
        return lambda c: F.transform(self.run(c), lambda v: v.cast("string"))

    def join(self, sep: str) -> Focus:
        return lambda c: F.array_join(self.texts()(c), sep)

    def reference_key(self, kind: str | None = None) -> Focus:
        """The id of a reference; with a type, only of references to it."""
        text = lambda c: single(self.get("reference").texts()(c))
        if not kind:
            return lambda c: F.regexp_replace(text(c), "^.*[/:]", "")
        return lambda c: bound(text(c), lambda t: F.when(t.rlike(f"(^|/){kind}/[^/]+$"), F.regexp_replace(t, "^.*[/:]", "")))

    def resource_key(self) -> Focus:
        return lambda c: single(self.get("id").texts()(c))


def negated(test: Focus) -> Focus:
    return lambda c: ~test(c)


def both(a: Focus, b: Focus) -> Focus:
    return lambda c: a(c) & b(c)


def either(a: Focus, b: Focus) -> Focus:
    return lambda c: a(c) | b(c)


def one_of_two(a: Focus, b: Focus) -> Focus:
    return lambda c: a(c) != b(c)


def constant(value: str | int | float | bool) -> Expr:
    """A literal; a float is the decimal that it is written as."""
    return Expr(lambda c: F.array(F.parse_json(F.lit(repr(value))) if isinstance(value, float) else F.lit(value).cast("variant")))


def this() -> Expr:
    return Expr(lambda c: c.items if isinstance(c, Focused) else c, (), ())


def path(dotted: str) -> Expr:
    return this().path(dotted)


@dataclass(frozen=True)
class Col:
    name: str
    expr: Expr | Focus
    type: str = "string"
    collection: bool = False

    def column(self, focus: Column | Focused) -> Column:
        if not isinstance(self.expr, Expr):
            return self.expr(focus).alias(self.name)
        error = F.raise_error(F.lit(f"{self.name} has several values"))
        if isinstance(focus, Focused) and self.expr.chain is not None and len(self.expr.chain) == 1 and not self.collection:
            # A member of the item itself: in most documents a scalar, which needs no list.
            v = focus.member(self.expr.chain[0])
            several = F.try_variant_get(v, "$", _KIND)
            return F.when(several.isNull(), v.cast(self.type)).when(F.size(several) > 1, error).otherwise(single(several).cast(self.type)).alias(self.name)
        values = self.expr.run(focus)
        if self.collection:
            return F.transform(values, lambda v: v.cast(self.type)).alias(self.name)
        value = bound(values, lambda v: F.when(F.size(v) > 1, error).otherwise(single(v).cast(self.type)))
        straight = self._straight(focus)
        return (value if straight is None else F.coalesce(straight, value)).alias(self.name)

    def _straight(self, focus: Column | Focused) -> Column | None:
        """The value at the end of members and places taken as they stand, without lists: null where a member is an array that no place is taken of, or
        no array though one is, or where the value is missing or may be an array."""
        route = self.expr.route if isinstance(self.expr, Expr) and isinstance(focus, Focused) else None
        if not route or any(isinstance(x, str) and not re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", x) for x in route):
            return None
        v = F.try_variant_get(focus.member(route[0]), "$" + "".join(f".{x}" if isinstance(x, str) else f"[{x}]" for x in route[1:]), self.type)
        return F.when(~v.startswith("["), v) if self.type == "string" else v


@dataclass(frozen=True)
class Select:
    columns: Sequence[Col] = ()
    for_each: Expr | None = None
    or_null: bool = False
    row_index: str | None = None
    select: Sequence[Select] = ()
    union_all: Sequence[Select] = ()


@dataclass(frozen=True)
class View:
    resource: str
    select: Sequence[Select]
    where: Sequence[Focus] = field(default_factory=tuple)


def _names(part: Select) -> list[str]:
    of_branches = _names(part.union_all[0]) if part.union_all else []
    return [c.name for c in part.columns] + ([part.row_index] if part.row_index else []) + [n for s in part.select for n in _names(s)] + of_branches


def _parts(selects: Sequence[Select]) -> list[Select]:
    return [x for s in selects for x in (s, *_parts(s.select), *_parts(s.union_all))]


def validate(view: View) -> None:
    """Raises ValueError for names that repeat or are none, unions of unequal columns, and parts that exclude each other."""
    names = [n for s in view.select for n in _names(s)]
    if len(names) != len(set(names)):
        raise ValueError(f"column names repeat: {names}")
    if bad := [n for n in names if not re.fullmatch("[A-Za-z][A-Za-z0-9_]*", n)]:
        raise ValueError(f"not column names: {bad}")
    for part in _parts(view.select):
        if part.or_null and part.for_each is None:
            raise ValueError("`or_null` without `for_each`")
        if part.row_index and part.for_each is None:
            raise ValueError("`row_index` without `for_each`")
        kinds = [[(c.name, c.type, c.collection) for c in branch.columns] for branch in part.union_all]
        if any(k != kinds[0] for k in kinds):
            raise ValueError("branches of a union differ in their columns")
        if any(branch.select or branch.union_all or branch.row_index or branch.or_null for branch in part.union_all):
            raise ValueError("branches of a union hold columns and `for_each` alone")


def _taken(parts: Sequence[Select], conditions: Sequence[Focus] = ()) -> tuple[list[str], bool]:
    """Which members the parts take of the item that they start from, and whether they use the item itself."""
    names: dict[str, None] = {}
    whole: list[bool] = []

    def member(name: str) -> Column:
        names[name] = None
        return F.lit(None).cast("variant")

    def items() -> Column:
        whole.append(True)
        return _none()

    noting = Focused(items, member)

    def note(select: Select) -> None:
        if select.for_each is not None:
            select.for_each.run(noting)
            return
        for c in select.columns:
            c.column(noting)
        for below in select.select:
            note(below)
        for branch in select.union_all:
            (this() if branch.for_each is None else branch.for_each).run(noting)

    for test in conditions:
        test(noting)
    for part in parts:
        note(part)
    return list(names), bool(whole)


def _inner(part: Select) -> list[Select]:
    """What the items of a `for_each` are the focus of."""
    return [Select(part.columns, select=part.select, union_all=part.union_all)]


def _tagged(items: Column, n: int) -> Column:
    return F.transform(items, lambda v: F.struct(F.lit(n).alias("n"), v.alias("v")))


def flatten_view(df: DataFrame, view: View, keep: Sequence[str] = (), resource: str = "resource") -> DataFrame:
    """Rows of a view over documents of its resource type, VARIANT or JSON text. Nested selects multiply, like a join of their rows; branches of a union add up.

    A document is brought in by a generator, so it is read once, whatever uses it. A test in `where` must be boolean. Text that is no JSON is an error."""
    validate(view)
    names, whole = _taken(view.select, view.where)
    source = F.col(resource)
    read = _pruned([n for n in names if n != "resourceType"] + ["resourceType"])
    text = df.schema[resource].dataType.typeName() == "string"
    # Brought in by generators, so that a document is read once, whatever uses it: its item (VARIANT) and its members.
    if text and not whole:
        out = df.select(*keep, F.lit(None).cast("variant").alias("__0_item"), F.explode(F.array(F.from_json(source, read, {"mode": "FAILFAST"}))).alias("__0"))
    else:
        out = df.select(*keep, F.explode(F.array(F.parse_json(source) if text else source)).alias("__0_item"))
        out = out.select("*", F.explode(F.array(F.try_variant_get("__0_item", "$", read))).alias("__0"))
    out = out.filter(F.try_variant_get("__0.resourceType", "$", "string") == view.resource)

    def focused(name: str) -> Focused:
        return Focused(lambda: F.when(F.col(f"{name}_item").isNull(), _none()).otherwise(F.array(f"{name}_item")), lambda member: F.col(f"{name}.`{member}`"))

    for k, test in enumerate(view.where):
        if out.select(test(focused("__0")).alias("t")).schema["t"].dataType.typeName() != "boolean":
            raise ValueError(f"condition {k} is not boolean")
        out = out.filter(F.coalesce(test(focused("__0")), F.lit(False)))
    done: list[str] = []

    def apply(frame: DataFrame, parts: Sequence[Select], focus: str, depth: int) -> DataFrame:
        for k, part in enumerate(parts):
            inner = focus
            if part.for_each is not None:
                inner, at = f"__{depth}_{k}", f"__at_{depth}_{k}"
                explode = F.posexplode_outer if part.or_null else F.posexplode
                names, whole = _taken(_inner(part))
                members, chain = _pruned(names or ["id"]), part.for_each.chain
                if chain is not None and len(chain) == 1 and not whole:
                    frame = frame.select(*frame.columns, explode(_elements(focused(focus).member(chain[0]), members)).alias(at, inner))
                else:
                    frame = frame.select(*frame.columns, explode(part.for_each.run(focused(focus))).alias(at, f"{inner}_item"))
                    frame = frame.withColumn(inner, F.try_variant_get(f"{inner}_item", "$", members))
                if part.row_index:
                    frame = frame.withColumn(part.row_index, F.coalesce(at, F.lit(0)))
                    done.append(part.row_index)
            for c in part.columns:
                frame = frame.withColumn(c.name, c.column(focused(inner)))
                done.append(c.name)
            frame = apply(frame, part.select, inner, depth * 10 + k + 1)
            if part.union_all:
                # Each branch's items are tagged and taken apart in one pass; where all are items of a member, they are read into structs of what is taken of them.
                name = f"__union_{depth}_{k}"
                names, whole = _taken([Select(b.columns) for b in part.union_all])
                plain = not whole and all(b.for_each is not None and b.for_each.chain is not None and len(b.for_each.chain) == 1 for b in part.union_all)
                if plain:
                    tagged = [_tagged(_elements(focused(inner).member(b.for_each.chain[0]), _pruned(names or ["id"])), n) for n, b in enumerate(part.union_all)]
                else:
                    tagged = [_tagged((this() if b.for_each is None else b.for_each).run(focused(inner)), n) for n, b in enumerate(part.union_all)]
                item = Focused(_none, lambda member, name=name: F.col(f"{name}.v.`{member}`")) if plain else F.array(F.col(f"{name}.v"))
                frame = frame.select(*frame.columns, F.explode(F.concat(*tagged)).alias(name))
                for place, c in enumerate(part.union_all[0].columns):
                    value = F.lit(None)
                    for n, b in enumerate(part.union_all):
                        value = F.when(F.col(f"{name}.n") == n, b.columns[place].column(item)).otherwise(value)
                    frame = frame.withColumn(c.name, value)
                    done.append(c.name)
        return frame

    return apply(out, view.select, "__0", 1).select(*keep, *done)
