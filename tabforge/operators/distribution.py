"""Distribution tables: what histograms, box plots, joint and density charts are drawn from."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fitting as fit, numeric as num
from ..functions.ordered import row_numbers
from ..functions.quantiles import exact_quantiles, grouped_quantiles
from ..schema import column_roles, numeric_like, q_col, to_number

FENCE = 1.5
MANY_OUTLIERS_PCT = 5.0
REPEATS = 10
KDE_ROWS = 2_000  # values that a task holds against the whole grid


def bin_number(x: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin of ``x``; the last bin is closed. A span of zero is widened by half on each side."""
    low, high = _spread_out(low, high)
    at = F.floor((x - F.lit(low)) / F.lit((high - low) / bins)).cast("int")
    return F.when(at >= bins, bins - 1).otherwise(at)  # ``least`` would turn NULL into the last bin


def _ranges(df: DataFrame, columns: Sequence[str], extra: Sequence[str] = ()) -> dict[str, dict]:
    stats = fit.column_statistics(df.select(*[q_col(c).cast("double").alias(c) for c in columns]),
                                  {c: ["min", "max", *extra] for c in columns})
    return {c: s for c, s in stats.items() if s["count"]}


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30) -> DataFrame:
    """(column, bin, bin_low, bin_high, n) for non-empty bins of all columns in one counting pass."""
    columns = list(columns or column_roles(df).numeric)
    found = _ranges(df, columns)
    entries, widths = [], []
    for c, s in found.items():
        x = q_col(c).cast("double")
        low, high = _spread_out(s["min"], s["max"])
        step = (high - low) / bins
        entries.append(F.struct(F.lit(c).alias("column"), bin_number(x, low, high, bins).alias("bin")))
        widths.append(F.struct(F.lit(c).alias("column"), F.lit(low).alias("low"), F.lit(step).alias("step")))
    if not entries:
        return df.sparkSession.createDataFrame([], "column string, bin int, bin_low double, bin_high double, n long")
    counts = (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .where(F.col("e.bin").isNotNull())
        .groupBy(F.col("e.column").alias("column"), F.col("e.bin").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    edge = F.element_at(F.filter(F.array(*widths), lambda w: w["column"] == F.col("column")), 1)
    return counts.withColumn("_w", edge).select(
        "column",
        "bin",
        (F.col("_w.low") + F.col("bin") * F.col("_w.step")).alias("bin_low"),
        (F.col("_w.low") + (F.col("bin") + 1) * F.col("_w.step")).alias("bin_high"),
        "n",
    )


def centre_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, mean, median, std): the marks drawn on a histogram."""
    from .profile import numeric_summary

    return numeric_summary(df, columns).select("column", "mean", "median", "std")


def kde(df: DataFrame, column: str, points: int = 200, *, cut: float = 0.0) -> DataFrame:
    """(point, x, density): Gaussian kernel density with Scott's bandwidth on an even grid.

    One scan for all grid points: every Arrow batch adds its values into the sums of the whole grid, and a task
    returns one row per point. Values are counted first where a sketch says that many rows repeat them.
    """
    x = q_col(column).cast("double")
    base = df.agg(
        F.count(x).alias("n"),
        F.min(x).alias("lo"),
        F.max(x).alias("hi"),
        F.stddev_samp(x).alias("sd"),
        F.approx_count_distinct(x).alias("d"),
    ).first()
    n, sd = base["n"], base["sd"]
    if n < 2 or not sd:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    width = sd * n ** (-0.2)
    low, high = base["lo"] - cut * width, base["hi"] + cut * width
    grid = [low + (high - low) * i / (points - 1) for i in range(points)]
    norm = n * width * math.sqrt(2 * math.pi)
    counted = df.select(x.alias("_x"), F.lit(1).alias("_n")).where(F.col("_x").isNotNull())
    if base["d"] * REPEATS <= n:
        counted = counted.groupBy("_x").agg(F.sum("_n").alias("_n"))
    centres = np.array(grid)

    def add_up(batches):
        total = np.zeros(points)
        for batch in batches:
            x, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (0, 1))
            for at in range(0, len(x), KDE_ROWS):
                z = (centres[:, None] - x[None, at : at + KDE_ROWS]) / width
                total += np.exp(z * z * -0.5) @ n[at : at + KDE_ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(points, dtype=np.int32)), pa.array(total)], names=["point", "k"])

    sums = counted.mapInArrow(add_up, "point int, k double").groupBy("point").agg(F.sum("k").alias("k"))
    return sums.select("point", (F.lit(low) + F.col("point") * F.lit((high - low) / (points - 1))).alias("x"), (F.col("k") / norm).alias("density"))


def box_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles, fences, outlier count and share per numeric column, flagged above 5 %."""
    columns = list(columns or column_roles(df).numeric)
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    known = [c for c in columns if quartiles[c][0] is not None]
    if not known:
        raise ValueError("box statistics need at least one column with values")
    parts, rows = [], []
    for i, c in enumerate(known):
        q1, median, q3 = quartiles[c]
        low, high = q1 - FENCE * (q3 - q1), q3 + FENCE * (q3 - q1)
        parts += [F.count(q_col(c)).alias(f"n{i}"), F.count_if((q_col(c) < low) | (q_col(c) > high)).alias(f"o{i}")]
        share = num.percent(F.col(f"o{i}"), F.col(f"n{i}"))
        marks = {"q1": q1, "median": median, "q3": q3, "iqr": q3 - q1, "lower": low, "upper": high}
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                *[F.lit(v).cast("double").alias(k) for k, v in marks.items()],
                F.col(f"n{i}").alias("n"),
                F.col(f"o{i}").alias("n_outliers"),
                share.alias("outlier_pct"),
                (share > MANY_OUTLIERS_PCT).cast("int").alias("many_outliers"),
            )
        )
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def target_analysis(df: DataFrame, target: str, top_n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(distribution marks of the target, its strongest Pearson correlations with sign)."""
    from .correlation import top_target_correlations
    from .profile import numeric_summary

    marks = numeric_summary(df, [target]).join(F.broadcast(box_stats(df, [target]).drop("median")), "column")
    return (
        marks.select("column", "mean", "median", "q1", "q3", "iqr", "std"),
        top_target_correlations(df, target, top_n),
    )


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line through the complete rows."""
    a, b = q_col(x).cast("double"), q_col(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    slope = F.try_divide(F.covar_pop(a, b), F.var_pop(F.when(both, a)))
    r2 = F.try_divide(F.pow(F.covar_pop(a, b), 2.0), F.var_pop(F.when(both, a)) * F.var_pop(F.when(both, b)))
    return df.agg(
        F.count_if(both).alias("n"),
        slope.alias("slope"),
        (F.avg(F.when(both, b)) - slope * F.avg(F.when(both, a))).alias("intercept"),
        r2.alias("r2"),
    )


def box_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Five-number summary of ``value`` per level of ``group``."""
    five = grouped_quantiles(df, [group], value, [0.0, 0.25, 0.5, 0.75, 1.0])
    q = F.col("quantiles")
    return five.select(
        q_col(group), "n", *[q[i].alias(name) for i, name in enumerate(("min", "q1", "median", "q3", "max"))]
    )


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """(row level, column level, n, share within the row level), complete rows only."""
    counts = (
        df.where(q_col(row).isNotNull() & q_col(column).isNotNull())
        .groupBy(q_col(row), q_col(column))
        .agg(F.count("*").alias("n"))
    )
    # the window runs over level pairs, not over rows
    total = F.sum("n").over(Window.partitionBy(q_col(row)))
    return counts.withColumn("share", F.col("n") / total)


def crosstab_wide(df: DataFrame, row: str, column: str, *, max_levels: int = 200) -> DataFrame:
    """The normalised crosstab with one column per level of ``column``."""
    levels, over = fit.sorted_levels(df.select(q_col(column).cast("string").alias(column)), [column], max_levels)
    if over:
        raise ValueError(f"{column!r} has more than {max_levels} levels")
    long = crosstab(df, row, column).withColumn(column, q_col(column).cast("string"))
    return long.groupBy(q_col(row)).pivot(column, levels[column]).agg(F.first("share")).na.fill(0.0, levels[column])


def relationship_with_target(df: DataFrame, feature: str, target: str) -> DataFrame:
    """The table behind the chart that fits the two columns' kinds."""
    kinds = numeric_like(df, [feature, target])
    numbers = df.select(
        *[
            (to_number(q_col(c).cast("string")) if kinds[c] and c not in column_roles(df).numeric else q_col(c)).alias(c)
            for c in (feature, target)
        ]
    )
    if kinds[feature] and kinds[target]:
        return fit_line(numbers, feature, target)
    if kinds[feature]:
        return box_by_group(numbers, target, feature)
    if kinds[target]:
        return box_by_group(numbers, feature, target)
    return crosstab(numbers, feature, target)


def missing_patterns(df: DataFrame) -> DataFrame:
    """How often each combination of missing columns occurs; columns are named in table order."""
    names = F.array_compact(F.array(*[F.when(q_col(c).isNull(), F.lit(c)) for c in df.columns]))
    return df.groupBy(F.concat_ws(",", names).alias("missing_columns")).agg(F.count("*").alias("n"))


def qq_points(df: DataFrame, column: str, key: Sequence[str]) -> DataFrame:
    """(value, theoretical) for every row: ordered values against normal order-statistic medians.

    ``key`` breaks ties, which also spreads a value that repeats very often over many tasks.
    """
    known = df.select(q_col(column).cast("double").alias("value"), *[q_col(k).alias(f"_k{i}") for i, k in enumerate(key)])
    known = known.where(F.col("value").isNotNull())
    numbered = row_numbers(known, ["value", *[f"_k{i}" for i in range(len(key))]], "_at")
    i, n = F.col("_at") + 1.0, known.agg(F.count("*").cast("double")).scalar()
    last = F.pow(F.lit(0.5), 1.0 / n)
    p = F.when(i == n, last).when(i == 1.0, 1.0 - last).otherwise((i - 0.3175) / (n + 0.365))
    placed = numbered.select("value", p.alias("_p"))
    return placed.select("value", num.normal_quantile(F.col("_p")).alias("theoretical"))


def qq_fit(df: DataFrame, column: str, key: Sequence[str]) -> DataFrame:
    """Line through the points of :func:`qq_points`."""
    return fit_line(qq_points(df, column, key), "theoretical", "value")


def joint_bins(df: DataFrame, x: str, y: str, bins: int = 30) -> DataFrame:
    """Two-dimensional histogram (bin_x, bin_y, n) over complete rows."""
    both = df.where(q_col(x).isNotNull() & q_col(y).isNotNull())
    found = _ranges(both, [x, y])
    if not found:
        return df.sparkSession.createDataFrame([], "bin_x int, bin_y int, n long")
    cells = [
        bin_number(q_col(c).cast("double"), found[c]["min"], found[c]["max"], bins).alias(name)
        for c, name in ((x, "bin_x"), (y, "bin_y"))
    ]
    return both.groupBy(*cells).agg(F.count("*").alias("n"))


def hexbin(df: DataFrame, x: str, y: str, grid: int = 30) -> DataFrame:
    """(hex_x, hex_y, n): counts per hexagon, at the hexagon's centre.

    Hexagons are the cells of two interleaved rectangular lattices; a point belongs to the
    nearer of the two candidate centres, vertical distance counting threefold.
    """
    both = df.where(q_col(x).isNotNull() & q_col(y).isNotNull())
    found = _ranges(both, [x, y])
    if not found:
        return df.sparkSession.createDataFrame([], "hex_x double, hex_y double, n long")
    x_low, x_high = _spread_out(found[x]["min"], found[x]["max"])
    y_low, y_high = _spread_out(found[y]["min"], found[y]["max"])
    pad = 1e-9 * (x_high - x_low)
    x_low, x_high = x_low - pad, x_high + pad
    step_x, step_y = (x_high - x_low) / grid, (y_high - y_low) / int(grid / math.sqrt(3))
    u, v = (q_col(x) - x_low) / step_x, (q_col(y) - y_low) / step_y
    corner_u, corner_v = F.rint(u), F.rint(v)
    centre_u, centre_v = F.floor(u) + 0.5, F.floor(v) + 0.5
    to_corner = F.pow(u - corner_u, 2.0) + 3.0 * F.pow(v - corner_v, 2.0)
    to_centre = F.pow(u - centre_u, 2.0) + 3.0 * F.pow(v - centre_v, 2.0)
    at_corner = to_corner < to_centre
    return (
        both.groupBy(
            F.when(at_corner, corner_u).otherwise(centre_u).alias("_u"),
            F.when(at_corner, corner_v).otherwise(centre_v).alias("_v"),
        )
        .agg(F.count("*").alias("n"))
        .select((F.col("_u") * step_x + x_low).alias("hex_x"), (F.col("_v") * step_y + y_low).alias("hex_y"), "n")
    )


def _spread_out(low: float, high: float) -> tuple[float, float]:
    return (low, high) if high > low else (low - 0.5, high + 0.5)
