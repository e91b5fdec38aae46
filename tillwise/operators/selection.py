"""Exact order statistics by selection: tiles and quantiles of a whole table without sorting it.

Where a tile begins or a quantile lies is one row out of all. A mergeable sketch brackets its
value, one pass counts exactly what lies below and inside the bracket, and only the values inside
are looked at: again with a sketch while they are many, one by one when they are few. All
wanted rows, of all columns, go through the same passes. Among rows that share the value the
key is selected in the same way, so a value that a third of the rows share is no hot group.

Every pass is one aggregation. The driver holds the brackets and, at the end, at most
``FEW`` values of each.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Values of a bracket that are counted one by one.
FEW = 10_000
# Accuracy of the sketch, and how far around the wanted rank a bracket reaches, of all rows in it.
_ACCURACY = 10_000
_REACH = 2.5 / _ACCURACY
_MOST_ROUNDS = 50


@dataclass
class _Wanted:
    """A row by its place in the order of a value, among the rows that meet a condition."""

    value: Column
    condition: Column | None
    place: int
    low: float | None = None  # the bracket, both ends included; None is open
    high: float | None = None
    below: int = 0
    inside: int = 0
    found: tuple[float, int] | None = None  # the value, and the place among the rows that have it

    def inside_bracket(self, low: float | None, high: float | None) -> Column:
        parts = [p for p in (
            self.condition, None if low is None else self.value >= F.lit(low), None if high is None else self.value <= F.lit(high)
        ) if p is not None]
        condition = F.lit(True)
        for part in parts:
            condition = condition & part
        return condition


def _select(df: DataFrame, wanted: list[_Wanted]) -> None:
    """Find every wanted row; ``inside`` has to hold how many rows meet its condition."""
    for _ in range(_MOST_ROUNDS):
        few = [w for w in wanted if w.found is None and w.inside <= FEW]
        if few:
            _count_values(df, few)
        many = [w for w in wanted if w.found is None]
        if not many:
            return
        _narrow(df, many)
    raise RuntimeError("the values cannot be told apart as doubles")


def _narrow(df: DataFrame, wanted: list[_Wanted]) -> None:
    sketches = []
    for w in wanted:
        rank = (w.place - w.below + 0.5) / w.inside
        ends = F.array(F.lit(max(rank - _REACH, 0.0)), F.lit(min(rank + _REACH, 1.0)))
        held = F.when(w.inside_bracket(w.low, w.high), w.value)
        sketches.append(F.percentile_approx(held, ends, _ACCURACY))
    ends = df.agg(*(s.alias(f"_{i}") for i, s in enumerate(sketches))).first()
    counts = []
    for i, w in enumerate(wanted):
        low, high = ends[i]
        counts.append(F.count(F.when(w.inside_bracket(None, None) & (w.value < F.lit(low)), 1)).alias(f"_b{i}"))
        counts.append(F.count(F.when(w.inside_bracket(low, high), 1)).alias(f"_n{i}"))
    counted = df.agg(*counts).first()
    for i, w in enumerate(wanted):
        (low, high), below, inside = ends[i], counted[2 * i], counted[2 * i + 1]
        if w.place < below:  # the sketch was off: the bracket is what lies before it, or behind
            w.high, w.inside = math.nextafter(low, -math.inf), below - w.below
        elif w.place >= below + inside:
            w.low, w.inside = math.nextafter(high, math.inf), w.below + w.inside - below - inside
            w.below = below + inside
        elif low == high:
            w.found = (low, w.place - below)
        else:
            w.low, w.high, w.below, w.inside = low, high, below, inside


def _count_values(df: DataFrame, wanted: list[_Wanted]) -> None:
    met = [
        F.when(w.inside_bracket(w.low, w.high), F.struct(F.lit(i).alias("i"), w.value.alias("value")))
        for i, w in enumerate(wanted)
    ]
    rows = df.select(F.explode(F.array_compact(F.array(*met))).alias("met")).groupBy("met").agg(F.count(F.lit(1)).alias("n"))
    values: dict[int, list[tuple[float, int]]] = {}
    for r in rows.collect():
        values.setdefault(r["met"]["i"], []).append((r["met"]["value"], r["n"]))
    for i, w in enumerate(wanted):
        below = w.below
        for value, n in sorted(values.get(i, [])):
            if w.place < below + n:
                w.found = (value, w.place - below)
                break
            below += n


def _as_double(column: str, descending: bool) -> Column:
    """The order of a numeric column as a double, nulls where Spark sorts them."""
    value = F.col(column).cast("double")
    return F.coalesce(-value if descending else value, F.lit(float("inf") if descending else float("-inf")))


def _starts(n: int, tiles: int) -> list[int]:
    """Where the second and later tiles begin; only those that have rows."""
    small, larger = divmod(n, tiles)
    return [s for k in range(1, tiles) if (s := k * small + min(k, larger)) < n]


def with_ntiles(df: DataFrame, tiles: int, key: str, **orders: str | tuple[str, bool]) -> DataFrame:
    """Add NTILE(tiles) over the whole table for each name in ``orders``: a numeric column, or
    a column and whether it descends. Ties are broken by ``key``, a number without repeats.

    ``df`` is read several times, so it should be a written table; its columns are only compared
    with the few values that are found. The result is a projection.
    """
    n = df.count()
    orders = {name: (o, False) if isinstance(o, str) else o for name, o in orders.items()}
    values = {name: _as_double(*order) for name, order in orders.items()}
    wanted = {name: [_Wanted(value, None, s, inside=n) for s in _starts(n, tiles)] for name, value in values.items()}
    _select(df, [w for own in wanted.values() for w in own])

    # Where a tile begins amid equal values, the key of its first row.
    number = F.col(key).cast("double")
    amid = {}
    for own in wanted.values():
        for w in own:
            value, place = w.found
            if place:
                amid[id(w)] = _Wanted(number, w.value == F.lit(value), place)
    if amid:
        ties = df.agg(*(F.count(F.when(w.condition, 1)) for w in amid.values())).first()
        for w, n_ties in zip(amid.values(), ties, strict=True):
            w.inside = n_ties
        _select(df, list(amid.values()))

    made = {}
    for name, own in wanted.items():
        tile = F.lit(1)
        for w in own:
            value = F.lit(w.found[0])
            after = w.value > value
            begins = F.lit(True) if id(w) not in amid else number >= F.lit(amid[id(w)].found[0])
            tile = tile + (after | ((w.value == value) & begins)).cast("int")
        made[name] = tile
    return df.withColumns(made)


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Linearly interpolated quantiles, all in the same passes: name -> (column, probability).

    Nulls take no part; a column without values has None.
    """
    columns = {column for column, _ in wanted.values()}
    counts = df.agg(*(F.count(c).alias(c) for c in columns)).first().asDict()
    rows: dict[str, tuple[_Wanted, _Wanted, float]] = {}
    for name, (column, probability) in wanted.items():
        if n := counts[column]:
            place = probability * (n - 1)
            value, there = F.col(column).cast("double"), F.col(column).isNotNull()
            low, high = (_Wanted(value, there, at, inside=n) for at in (int(place), min(int(place) + 1, n - 1)))
            rows[name] = (low, high, place - int(place))
    _select(df, [w for low, high, _ in rows.values() for w in (low, high)])

    def between(low: _Wanted, high: _Wanted, part: float) -> float:
        return low.found[0] + (high.found[0] - low.found[0]) * part

    return {name: between(*rows[name]) if name in rows else None for name in wanted}
