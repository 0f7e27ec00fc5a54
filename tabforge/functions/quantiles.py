"""Exact quantiles that never put a column into one task.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. That is fine up
to a checked row count and is used there. Beyond it, an order statistic is found by
narrowing a value bracket: a sketch gives the first bracket, each further pass counts the
rows of the bracket in equal-width bins (pre-aggregated before the shuffle, so a value that
holds a third of the rows costs nothing extra) and keeps the bin with the wanted rank.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schema import known, q_col
from . import buckets as bk

DIRECT_ROWS = 4_000_000  # values of all columns together that one task may hold
COLUMNS_PER_PASS = 12
BINS = 2048
SKETCH_ACCURACY = 10_000


@dataclass
class _Bracket:
    column: str
    low: float
    high: float
    below: int  # rows under ``low``; -1 while unknown
    ranks: list[int]


def exact_quantiles(
    df: DataFrame,
    probabilities: Mapping[str, Sequence[float]],
    *,
    counts: Mapping[str, int] | None = None,
    direct_rows: int = DIRECT_ROWS,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; only the answers reach the driver. NaN counts as missing."""
    columns = [c for c in probabilities if probabilities[c]]
    if not columns:
        return {c: [] for c in probabilities}
    df = df.select(*[known(df, c).alias(c) for c in columns])
    if counts is None:
        row = df.agg(*[F.count(q_col(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
        counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    answers: dict[str, list[float | None]] = {c: [] for c in probabilities}
    if sum(counts[c] for c in columns) <= direct_rows:
        row = df.agg(
            *[F.percentile(q_col(c), [float(p) for p in probabilities[c]]).alias(f"q{i}") for i, c in enumerate(columns)]
        ).first()
        for i, c in enumerate(columns):
            answers[c] = list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probabilities[c])
        return answers

    wanted = {c: sorted({r for p in probabilities[c] for r in _ranks(p, counts[c])}) for c in columns if counts[c]}
    found: dict[str, dict[int, float]] = {}
    names = list(wanted)
    for at in range(0, len(names), COLUMNS_PER_PASS):
        block = {c: wanted[c] for c in names[at : at + COLUMNS_PER_PASS]}
        found.update(order_statistics(df, block, counts))
    for c in columns:
        if not counts[c]:
            answers[c] = [None] * len(probabilities[c])
            continue
        for p in probabilities[c]:
            at = p * (counts[c] - 1)
            lower, upper = found[c][math.floor(at)], found[c][math.ceil(at)]
            answers[c].append(lower + (upper - lower) * (at - math.floor(at)))
    return answers


def _ranks(p: float, n: int) -> set[int]:
    at = p * (n - 1)
    return {math.floor(at), math.ceil(at)}


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int],
    *,
    bins: int = BINS,
) -> dict[str, dict[int, float]]:
    """The values at the given 0-based ranks of the sorted column; missing values and NaN have no rank.

    ``counts`` are the ranked rows. Every pass settles or shrinks every bracket; one that leaves them as they
    were means that the table is not the one that was counted.
    """
    df = df.select(*[known(df, c).alias(c) for c in ranks])
    found: dict[str, dict[int, float]] = {c: {} for c in ranks}
    open_brackets = _first_brackets(df, ranks, counts)
    while open_brackets:
        following = _narrow(df, open_brackets, found, bins)
        if following == open_brackets or any(b.low == math.inf or b.high == -math.inf for b in following):
            raise ArithmeticError("a rank lies beyond the rows: the table changed between passes")
        open_brackets = following
    return found


def _first_brackets(df: DataFrame, ranks, counts) -> list[_Bracket]:
    """Bracket every rank between two sketched quantiles, with room for the sketch's error."""
    slack = 3.0 / SKETCH_ACCURACY
    asks = [(c, r) for c in ranks for r in ranks[c]]
    columns = {c: i for i, c in enumerate(ranks)}
    grid: dict[str, list[float]] = {c: [] for c in ranks}
    for c, r in asks:
        at = r / max(1, counts[c] - 1)
        grid[c] += [max(0.0, at - slack), min(1.0, at + slack)]
    parts = []
    for c, i in columns.items():
        v = q_col(c).cast("double")
        parts += [
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
            F.percentile_approx(v, grid[c], SKETCH_ACCURACY).alias(f"a{i}"),
        ]
    row = df.agg(*parts).first()
    brackets: dict[tuple, _Bracket] = {}
    for c, i in columns.items():
        if counts[c] == 0:
            continue
        for j, r in enumerate(ranks[c]):
            low, high = row[f"a{i}"][2 * j], row[f"a{i}"][2 * j + 1]
            low = row[f"lo{i}"] if grid[c][2 * j] == 0.0 else low
            high = row[f"hi{i}"] if grid[c][2 * j + 1] == 1.0 else high
            brackets.setdefault((c, low, high), _Bracket(c, low, high, -1, [])).ranks.append(r)
    return list(brackets.values())


def _narrow(df: DataFrame, brackets: list[_Bracket], found, bins: int) -> list[_Bracket]:
    """One pass over the table: bin every open bracket, settle or shrink it."""
    entries = []
    for i, b in enumerate(brackets):
        v = q_col(b.column).cast("double")
        # an infinite or tiny span cannot be divided evenly: its two halves still can
        width = (b.high - b.low) / bins
        if b.high == b.low:
            bin_number = F.lit(0)
        elif math.isfinite(width) and width > 0:
            bin_number = F.least(F.floor((v - b.low) / width), F.lit(bins - 1)).cast("int")
        else:
            middle = b.low / 2 + b.high / 2 if math.isfinite(b.low + b.high) else 0.0
            bin_number = F.when(v <= b.low, 0).when(v < middle, 1).when(v < b.high, 2).otherwise(3)
        inside = (v >= b.low) & (v <= b.high)
        # bin -1 counts the rows under the bracket, which is needed once
        label = F.when(inside, bin_number)
        if b.below < 0:
            label = F.when(v < b.low, -1).otherwise(label)
        entries.append(F.struct(F.lit(i).alias("i"), label.alias("bin"), v.alias("v")))
    cells = (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .where(F.col("e.bin").isNotNull())
        .groupBy("e.i", "e.bin")
        .agg(F.count("*").alias("n"), F.min("e.v").alias("low"), F.max("e.v").alias("high"))
        .collect()  # at most (open brackets) x (bins + 1) rows, whatever the table holds
    )
    by_bracket: dict[int, list] = {}
    for cell in cells:
        by_bracket.setdefault(cell["i"], []).append(cell)
    still_open: list[_Bracket] = []
    for i, b in enumerate(brackets):
        mine = sorted(by_bracket.get(i, []), key=lambda cell: cell["bin"])
        seen = b.below if b.below >= 0 else sum(cell["n"] for cell in mine if cell["bin"] < 0)
        todo = sorted(b.ranks)
        missed = [r for r in todo if r < seen]
        if missed:  # the sketch's bracket was too high: reopen below it
            still_open.append(_Bracket(b.column, -math.inf, b.low, -1, missed))
        todo = [r for r in todo if r >= seen]
        for cell in mine:
            if cell["bin"] < 0:
                continue
            here = [r for r in todo if seen <= r < seen + cell["n"]]
            if here and cell["low"] == cell["high"]:
                found[b.column].update({r: cell["low"] for r in here})
            elif here:
                still_open.append(_Bracket(b.column, cell["low"], cell["high"], seen, here))
            seen += cell["n"]
        beyond = [r for r in todo if r >= seen]
        if beyond:  # too low: reopen above it
            still_open.append(_Bracket(b.column, b.high, math.inf, -1, beyond))
    return still_open


def grouped_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    *,
    direct_rows: int = DIRECT_ROWS,
    n_buckets: int | None = None,
) -> DataFrame:
    """Exact quantiles per group: columns ``groups``, ``n`` and the array ``quantiles``.

    Groups may be many and one may hold most rows. Beyond ``direct_rows``, rows are counted
    per (group, value bucket); only buckets holding a wanted rank are looked at again, value
    by value, so no group is ever gathered in one place.
    """
    rows = df.select(*[q_col(g) for g in groups], known(df, value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    if rows.count() <= direct_rows:
        return rows.groupBy(*groups).agg(
            F.count("*").alias("n"),
            F.percentile("_x", [float(p) for p in probabilities]).alias("quantiles"),
        )
    edges = bk.cut_points(rows, [F.col("_x")], n_buckets or bk.default_buckets(df))[0]
    cut = bk.with_bucket(rows, F.col("_x"), edges, "_b")
    per_bucket = cut.groupBy(*groups, "_b").agg(F.count("*").alias("_c"))
    in_order = Window.partitionBy(*groups).orderBy("_b")
    placed = per_bucket.withColumn(
        "_before", F.coalesce(F.sum("_c").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("_n", F.sum("_c").over(Window.partitionBy(*groups)))
    asks = placed.withColumn("_ask", F.explode(_rank_structs(F.col("_n"), probabilities))).where(
        (F.col("_ask.rank") >= F.col("_before")) & (F.col("_ask.rank") < F.col("_before") + F.col("_c"))
    )
    targets = asks.groupBy(*groups, "_b", "_before", "_n").agg(F.collect_list("_ask").alias("_asks"))
    # a value that fills its bucket is one row before it meets the wanted ranks
    counted = cut.groupBy(*groups, "_b", "_x").agg(F.count("*").alias("_c"))
    left, right = counted.alias("l"), targets.alias("r")
    match = F.col("l._b") == F.col("r._b")
    for g in groups:
        match = match & F.col(f"l.`{g}`").eqNullSafe(F.col(f"r.`{g}`"))
    values = left.join(right, match).select(
        *[F.col(f"r.`{g}`").alias(g) for g in groups], F.col("r._b").alias("_b"), "_before", "_n", "_asks", "_x", "_c"
    )
    inside = Window.partitionBy(*groups, "_b").orderBy("_x")
    ranked = values.withColumn(
        "_from", F.col("_before") + F.coalesce(F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    hits = ranked.withColumn("_ask", F.explode("_asks")).where(
        (F.col("_ask.rank") >= F.col("_from")) & (F.col("_ask.rank") < F.col("_from") + F.col("_c"))
    )
    return (
        hits.groupBy(*groups, F.col("_n").alias("n"), F.col("_ask.p").alias("_p"))
        .agg(F.sum(F.col("_x") * F.col("_ask.weight")).alias("_q"))
        .groupBy(*groups, "n")
        .agg(F.array_sort(F.collect_list(F.struct("_p", "_q"))).alias("_all"))
        .select(*[q_col(g) for g in groups], "n", F.col("_all._q").alias("quantiles"))
    )


def _rank_structs(n: Column, probabilities: Sequence[float]) -> Column:
    """Both neighbours of every quantile position, with their interpolation weights."""
    items = []
    for i, p in enumerate(probabilities):
        at = (n - 1) * F.lit(float(p))
        low = F.floor(at)
        share = at - low
        for rank, weight in ((low, 1.0 - share), (low + 1, share)):
            items.append(F.struct(F.lit(i).alias("p"), rank.cast("long").alias("rank"), weight.alias("weight")))
    return F.filter(F.array(*items), lambda s: s["weight"] > 0)
