"""Missing values: per-column rules are fitted once and applied as literals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import fitting as fit
from ..functions.ordered import fill_along
from ..schema import column_roles, q_col

Rule = str | tuple[str, Any]
DROP, FORWARD, BACKWARD = "drop", "ffill", "bfill"
DEFAULT_CONSTANT = {True: 0, False: "Unknown"}


@dataclass
class Imputation:
    """Fitted fill values; columns with an order-dependent or row-dropping rule are listed apart."""

    values: dict[str, Any] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    forward: list[str] = field(default_factory=list)
    backward: list[str] = field(default_factory=list)
    order_by: list[str] = field(default_factory=list)
    as_double: list[str] = field(default_factory=list)  # integer columns filled with a mean or median

    @property
    def stateless(self) -> bool:
        return not (self.forward or self.backward)

    def apply(self, df: DataFrame, *, training: bool = False) -> DataFrame:
        """Fill ``df``; rows are dropped in training only. Ordered fills use the rows of ``df`` itself."""
        if training and self.dropped:
            df = df.na.drop(subset=[c for c in self.dropped if c in df.columns])
        for columns, backward in ((self.forward, False), (self.backward, True)):
            columns = [c for c in columns if c in df.columns]
            if columns:
                df = fill_along(df, columns, self.order_by, backward=backward)
        return df.select(*[_filled(df, c, self.values, c in self.as_double) for c in df.columns])


def _filled(df: DataFrame, name: str, values: Mapping[str, Any], as_double: bool) -> Column:
    if as_double:
        # the type follows from the rule alone, whatever value the training rows gave
        value = values.get(name)
        return F.coalesce(q_col(name).cast("double"), F.lit(None if value is None else float(value)).cast("double")).alias(name)
    if values.get(name) is None:
        return q_col(name)
    return F.coalesce(q_col(name), _fill_literal(values[name], df.schema[name].dataType)).alias(name)


def _fill_literal(value: Any, kind: T.DataType) -> Column:
    # a fractional fill turns an integer column into a double, as a mean of integers must
    if isinstance(kind, T.IntegralType) and isinstance(value, float) and not value.is_integer():
        return F.lit(value)
    return F.lit(value).cast(kind)


def resolve_rules(
    df: DataFrame,
    rules: Mapping[str, Rule] | None = None,
    *,
    numeric: str = "median",
    categorical: str = "mode",
    columns: Sequence[str] | None = None,
) -> dict[str, tuple[str, Any]]:
    """One (strategy, value) per column: its own rule, else the default of its role.

    Anything that cannot work on the column's type falls back to median or mode.
    """
    rules = rules or {}
    roles = column_roles(df)
    resolved = {}
    for c in columns if columns is not None else df.columns:
        is_number = c in roles.numeric
        rule = rules.get(c)
        strategy, value = rule if isinstance(rule, (tuple, list)) else (rule, None)
        strategy = strategy or (numeric if is_number else categorical)
        if strategy in ("mean", "median") and not is_number:
            strategy = "mode"
        elif strategy not in ("mean", "median", "mode", "constant", DROP, FORWARD, BACKWARD):
            strategy = "median" if is_number else "mode"
        if strategy == "constant" and value is None:
            value = DEFAULT_CONSTANT[is_number]
        resolved[c] = (strategy, value)
    return resolved


def fit_imputation(
    df: DataFrame,
    rules: Mapping[str, Rule] | None = None,
    *,
    numeric: str = "median",
    categorical: str = "mode",
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    sequential: bool = True,
) -> Imputation:
    """Fit a fill for every column, missing values in training or not, so scoring needs no statistics.

    ``drop`` rules take rows away: statistics of later columns see only the rows that earlier
    drops left (``sequential``), or the whole table.
    """
    resolved = resolve_rules(df, rules, numeric=numeric, categorical=categorical, columns=columns)
    done = Imputation(order_by=list(order_by))
    batch: dict[str, tuple[str, Any]] = {}
    for c, (strategy, value) in resolved.items():
        if strategy == DROP:
            done.dropped.append(c)
            if sequential:
                _fit_batch(df, batch, done)
                batch, df = {}, df.where(q_col(c).isNotNull())
        elif strategy in (FORWARD, BACKWARD):
            if not order_by:
                raise ValueError(f"{strategy} on {c!r} needs order_by: a distributed table has no row order of its own")
            (done.forward if strategy == FORWARD else done.backward).append(c)
        else:
            batch[c] = (strategy, value)
    _fit_batch(df, batch, done)
    return done


def _fit_batch(df: DataFrame, batch: Mapping[str, tuple[str, Any]], done: Imputation) -> None:
    means = [c for c, (s, _) in batch.items() if s == "mean"]
    medians = [c for c, (s, _) in batch.items() if s == "median"]
    by_mode = [c for c, (s, _) in batch.items() if s == "mode"]
    needs = {c: ["mean"] for c in means}
    stats = fit.column_statistics(df, needs, {c: [0.5] for c in medians})
    for c in (*means, *medians):
        value = stats[c]["mean"] if c in means else stats[c]["quantiles"][0]
        done.values[c] = value
        if isinstance(df.schema[c].dataType, T.IntegralType):
            done.as_double.append(c)
    most_common = fit.modes(df, by_mode) if by_mode else {}
    for c in by_mode:
        done.values[c] = most_common[c] if most_common[c] is not None else batch[c][1]
    done.values.update({c: v for c, (s, v) in batch.items() if s == "constant"})


def handle_missing(
    df: DataFrame,
    strategy: str = "auto",
    *,
    numeric: str = "median",
    categorical: str = "mode",
    fill_value: Any = None,
    rules: Mapping[str, Rule] | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Whole-table front: drop every incomplete row, or fill by role with an optional constant for numbers."""
    if strategy == DROP:
        return df.na.drop()
    rules = dict(rules or {})
    if fill_value is not None:
        for c in column_roles(df).numeric:
            rules.setdefault(c, ("constant", fill_value))
    fitted = fit_imputation(df, rules, numeric=numeric, categorical=categorical, order_by=order_by)
    return fitted.apply(df, training=True)


def fill_from_batch(df: DataFrame, fitted: Imputation, *, numeric: str = "median", categorical: str = "mode") -> DataFrame:
    """Apply, and fill columns the fit never saw from the statistics of the batch itself."""
    known = {*fitted.values, *fitted.dropped, *fitted.forward, *fitted.backward}
    unseen = [c for c in df.columns if c not in known]
    filled = fitted.apply(df)
    if not unseen:
        return filled
    return fit_imputation(df, numeric=numeric, categorical=categorical, columns=unseen).apply(filled)
