"""Exact quantiles of many columns in a few aggregate passes.

Spark's exact ``percentile`` keeps every distinct value of a column in one map
per group, so its memory grows with the data. Here the same order statistics
come from brackets that shrink by rank, not by value:

1. each wanted rank has an open bracket (lo, hi) of values and knows how many
   values lie below it and inside it;
2. a pass of ``percentile_approx`` sketches (bounded state, partial
   aggregation) over the values inside the brackets proposes pivots, and a
   pass of exact counts around the pivots says which side each rank is on, or
   that a pivot is the answer;
3. a bracket with at most ``SMALL`` values is sorted inside the aggregate and
   only the wanted element is returned.

Pivots are values of the data, so every round shrinks each bracket by at least
one distinct value and, by the sketch's accuracy, to about a hundredth of its
rows (a few thousandths in the grouped form), whatever the distribution: there is no cap on rounds, rows are never
multiplied, and the driver holds a few numbers per rank. NaN counts as missing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.cache import passes_over

SMALL = 4096          # values that one sort inside an aggregate may hold
ACCURACY = 10_000     # of the grouped sketch: rank error at most rows / ACCURACY
WIDE_ACCURACY = 500   # of the sketches of many columns, which one task merges from all others
GRID = 200            # pivots of the grouped form
CHUNK = 64            # series per aggregate: bounds the width of a plan


def _value(name: str) -> Column:
    v = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(v), v)


@dataclass
class Bracket:
    """Open interval of values that holds the element of one rank."""

    rank: int
    lo: float | None = None
    hi: float | None = None
    below: int = 0
    inside: int = 0
    found: float | None = None

    def narrow(self, pivot: float, less: int, equal: int) -> None:
        """``less`` values lie below the pivot, ``equal`` on it."""
        if self.found is not None:
            return
        if self.rank < less:
            if self.hi is None or pivot <= self.hi:
                self.hi, self.inside = pivot, less - self.below
        elif self.rank < less + equal:
            self.found = pivot
        elif self.lo is None or pivot >= self.lo:
            top = self.below + self.inside
            self.lo, self.below = pivot, less + equal
            self.inside = top - self.below


def _ranks(n: int, probs: list[float]) -> set[int]:
    return {r for q in probs for r in (math.floor((n - 1) * q), math.ceil((n - 1) * q))}


def _lerp(n: int, probs: list[float], found: dict[int, float]) -> list[float | None]:
    out: list[float | None] = []
    for q in probs:
        if not n:
            out.append(None)
            continue
        h = (n - 1) * q
        lo, hi = found[math.floor(h)], found[math.ceil(h)]
        out.append(lo if hi == lo or h == math.floor(h) else lo + (hi - lo) * (h - math.floor(h)))
    return out


def _inside(v: Column, b: Bracket) -> Column:
    """The value if it lies in the bracket, else NULL."""
    ok = v.isNotNull()
    if b.lo is not None:
        ok = ok & (v > F.lit(b.lo))
    if b.hi is not None:
        ok = ok & (v < F.lit(b.hi))
    return F.when(ok, v)


def _run(df: DataFrame, aggs: list[Column], size: int = 4 * CHUNK) -> list:
    out: list = []
    for i in range(0, len(aggs), size):
        out += list(df.agg(*[a.alias(f"c{j}") for j, a in enumerate(aggs[i:i + size])]).first())
    return out


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    stats: dict | None = None) -> dict[str, list[float | None]]:
    """{column: [quantile for each prob]} with linear interpolation (rank
    h = (n - 1) * q, as pandas, NumPy and DuckDB); None for a column without
    values. ``stats`` may pass {column: (n, min, max)}, which saves a count."""
    with passes_over(df, list(columns)) as part:
        return _exact_quantiles(part, list(columns), probs, stats)


def _exact_quantiles(df, columns, probs, stats):
    if stats is None:
        ns = _run(df, [F.count(_value(x)) for x in columns])
        stats = {x: (n, None, None) for x, n in zip(columns, ns)}
    state = {x: [Bracket(r, inside=stats[x][0]) for r in sorted(_ranks(stats[x][0], probs))]
             for x in columns if stats[x][0]}
    while True:
        todo = [(x, b) for x, bs in state.items() for b in bs if b.found is None]
        if not todo:
            break
        small = [(x, b) for x, b in todo if b.inside <= SMALL]
        large = [(x, b) for x, b in todo if b.inside > SMALL]
        # small brackets: the element itself; large ones: pivots around the rank
        aggs = [F.element_at(F.sort_array(F.collect_list(_inside(_value(x), b))), b.rank - b.below + 1)
                for x, b in small]
        for x, b in large:
            at = (b.rank - b.below + 0.5) / b.inside
            error = 2 / min(ACCURACY, WIDE_ACCURACY)
            probe = [max(0.0, at - error), min(1.0, max(0.0, at)), min(1.0, at + error)]
            aggs.append(F.percentile_approx(_inside(_value(x), b), probe, min(ACCURACY, WIDE_ACCURACY)))
        got = _run(df, aggs, CHUNK)
        for (x, b), v in zip(small, got):
            b.found = v
        pivots = [sorted(set(p)) for p in got[len(small):]]
        counts = [c for (x, b), ps in zip(large, pivots) for p in ps
                  for c in (F.count(F.when(_value(x) < F.lit(p), 1)), F.count(F.when(_value(x) == F.lit(p), 1)))]
        sums = iter(_run(df, counts))
        for (x, b), ps in zip(large, pivots):
            for p in ps:
                b.narrow(p, next(sums), next(sums))
    return {x: _lerp(stats[x][0], probs, {b.rank: b.found for b in state.get(x, [])}) for x in columns}


def exact_quantiles_by(df: DataFrame, group: str, value: str,
                       probs: list[float]) -> dict[str, tuple[int, list[float]]]:
    """{group value: (n, [quantile for each prob])} for one value column.

    The groups are categories (one row each on the driver). Their brackets
    travel as literal maps, so a pass is one grouped aggregate with partial
    aggregation: no join, and rows are never shuffled by group."""
    d = df.select(F.col(f"`{group}`").cast("string").alias("g"), _value(value).alias("v")) \
        .filter(F.col("g").isNotNull() & F.col("v").isNotNull())
    with passes_over(d) as part:
        n_of = {r["g"]: r["n"] for r in part.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
        state = {g: [Bracket(r, inside=n) for r in sorted(_ranks(n, probs))] for g, n in n_of.items()}
        grid = [i / GRID for i in range(GRID + 1)]
        while True:
            todo = {g: [b for b in bs if b.found is None] for g, bs in state.items()}
            todo = {g: bs for g, bs in todo.items() if bs}
            if not todo:
                break
            slots = max(map(len, todo.values()))
            aggs = []
            for i in range(slots):
                mine = {g: bs[i] for g, bs in todo.items() if len(bs) > i}
                v = _inside_by(mine)
                aggs.append(F.sort_array(F.collect_list(F.when(F.col("g").isin(
                    [g for g, b in mine.items() if b.inside <= SMALL]), v))).alias(f"s{i}"))
                aggs.append(F.percentile_approx(F.when(F.col("g").isin(
                    [g for g, b in mine.items() if b.inside > SMALL]), v), grid, ACCURACY).alias(f"p{i}"))
            tests: dict[str, list[tuple[Bracket, list[float]]]] = {}
            for r in part.filter(F.col("g").isin(list(todo))).groupBy("g").agg(*aggs).collect():
                for i, b in enumerate(todo[r["g"]]):
                    if b.inside <= SMALL:
                        b.found = r[f"s{i}"][b.rank - b.below]
                    else:
                        at = (b.rank - b.below + 0.5) / b.inside * GRID
                        near = {r[f"p{i}"][min(GRID, max(0, k))] for k in
                                (math.floor(at) - 1, math.floor(at), math.ceil(at), math.ceil(at) + 1)}
                        tests.setdefault(r["g"], []).append((b, sorted(near)))
            if not tests:
                continue
            flat = {g: [(b, p) for b, ps in bs for p in ps] for g, bs in tests.items()}
            aggs = []
            for j in range(max(map(len, flat.values()))):
                p = _lookup({g: ps[j][1] for g, ps in flat.items() if len(ps) > j})
                aggs += [F.count(F.when(F.col("v") < p, 1)).alias(f"l{j}"), F.count(F.when(F.col("v") == p, 1)).alias(f"e{j}")]
            for r in part.filter(F.col("g").isin(list(flat))).groupBy("g").agg(*aggs).collect():
                for j, (b, p) in enumerate(flat[r["g"]]):
                    b.narrow(p, r[f"l{j}"], r[f"e{j}"])
    return {g: (n, _lerp(n, probs, {b.rank: b.found for b in state[g]})) for g, n in n_of.items()}


def _lookup(values: dict[str, float]) -> Column:
    return F.create_map(*[x for g, v in values.items() for x in (F.lit(g), F.lit(v))])[F.col("g")]


def _inside_by(brackets: dict[str, Bracket]) -> Column:
    low = {g: b.lo for g, b in brackets.items() if b.lo is not None}
    high = {g: b.hi for g, b in brackets.items() if b.hi is not None}
    ok = F.col("g").isin(list(brackets))
    if low:
        bound = _lookup(low)
        ok = ok & (bound.isNull() | (F.col("v") > bound))
    if high:
        bound = _lookup(high)
        ok = ok & (bound.isNull() | (F.col("v") < bound))
    return F.when(ok, F.col("v"))
