"""Categorical encodings: integer codes, float codes, indicator columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fitting as fit
from ..functions.lookups import attach
from ..functions.text import MISSING_LEVEL, lookup
from ..schema import column_roles, q_col

METHODS = ("onehot", "onehot_vector", "label", "ordinal")
LITERAL_LEVELS = 100  # beyond this, codes come from a joined vocabulary table
ONEHOT_LEVELS = 900  # columns that a table can reasonably have; the caller may set another limit
UNSEEN = -1


@dataclass
class ColumnEncoding:
    """Fitted levels of one column in order; ``vocabulary`` replaces ``levels`` when there are many."""

    column: str
    method: str
    levels: list[str] = field(default_factory=list)
    drop_first: bool = False
    vocabulary: DataFrame | None = None
    rows: int = 0
    size: int = 0  # levels of the vocabulary

    @property
    def output_columns(self) -> list[str]:
        if self.method != "onehot":
            return [self.column]  # a vector column stays one column
        return [f"{self.column}_{v}" for v in self.levels[1 if self.drop_first else 0 :]]

    def expressions(self) -> list[Column]:
        text = q_col(self.column).cast("string")
        if self.method == "onehot":
            # an unseen or missing level gives zeros everywhere
            kept = self.levels[1 if self.drop_first else 0 :]
            return [
                F.coalesce((text == F.lit(v)).cast("int"), F.lit(0)).alias(name)
                for v, name in zip(kept, self.output_columns)
            ]
        kind = "long" if self.method == "label" else "double"
        if self.method == "label":
            text = F.coalesce(text, F.lit(MISSING_LEVEL))
        code = lookup(text, {v: i for i, v in enumerate(self.levels)}) if self.levels else F.lit(None).cast("int")
        coded = F.coalesce(code, F.lit(UNSEEN)).cast(kind)
        if self.method == "ordinal":
            coded = F.when(text.isNotNull(), coded)
        return [coded.alias(self.column)]

    def joined(self, df: DataFrame) -> DataFrame:
        """Codes from the vocabulary table: hot levels by broadcast, the rest by a shuffled join."""
        kind = "long" if self.method == "label" else "double"
        table = self.vocabulary.select(
            F.col("value").alias(self.column), F.col("code").alias("_code"), F.col("n").alias("_n")
        )
        text = q_col(self.column).cast("string")
        if self.method == "label":
            text = F.coalesce(text, F.lit(MISSING_LEVEL))
        matched = attach(df.withColumn(self.column, text), table, self.column, rows=self.rows, weight="_n")
        coded = F.coalesce(F.col("_code"), F.lit(UNSEEN)).cast(kind)
        if self.method == "ordinal":
            coded = F.when(q_col(self.column).isNotNull(), coded)
        if self.method == "onehot_vector":
            return self._vectors(matched.select(*[coded.alias(c) if c == self.column else q_col(c) for c in df.columns]))
        return matched.select(*[coded.alias(c) if c == self.column else q_col(c) for c in df.columns])


    def _vectors(self, coded: DataFrame) -> DataFrame:
        """Codes as sparse indicator vectors with a place per level; unseen and missing levels are all zeros."""
        size = self.size - (1 if self.drop_first else 0)
        place = q_col(self.column) - (1 if self.drop_first else 0)
        outside = F.when(place < 0, float(size)).otherwise(place)
        names = [c for c in coded.columns]
        one_row = coded.sparkSession.range(1).select(F.lit(float(size)).alias("_place"))
        encoder = OneHotEncoder(inputCols=["_place"], outputCols=["_vector"], dropLast=True).fit(one_row)
        found = encoder.transform(coded.withColumn("_place", outside.cast("double")))
        return found.select(*[F.col("_vector").alias(c) if c == self.column else q_col(c) for c in names])


def encode_plan(
    df: DataFrame,
    method: str = "onehot",
    *,
    columns: Sequence[str] | None = None,
    rules: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Which categorical column gets which encoding: its own rule, else ``method``."""
    categorical = column_roles(df).categorical
    plan = {c: method for c in (columns if columns is not None else categorical) if c in categorical}
    plan.update({c: m for c, m in (rules or {}).items() if c in categorical})
    unknown = sorted(set(plan.values()) - set(METHODS))
    if unknown:
        raise ValueError(f"unknown encoding {unknown}")
    return plan


def fit_encoding(
    df: DataFrame, plan: Mapping[str, str], *, drop_first: bool = True, max_onehot: int = ONEHOT_LEVELS
) -> list[ColumnEncoding]:
    """Collect sorted levels while they are few; write a vocabulary table where they are many.

    ``max_onehot`` bounds the indicator columns of one column (below 1000); ``onehot_vector`` has no bound, it codes by
    a vocabulary table into one sparse vector column.
    """
    if not plan:
        return []
    text = df.select(
        *[
            (F.coalesce(q_col(c).cast("string"), F.lit(MISSING_LEVEL)) if m == "label" else q_col(c).cast("string")).alias(c)
            for c, m in plan.items()
        ]
    )
    levels: dict[str, list] = {}
    many: list[str] = []
    onehot = [c for c, m in plan.items() if m == "onehot"]
    coded = [c for c, m in plan.items() if m in ("label", "ordinal")]
    many += [c for c, m in plan.items() if m == "onehot_vector"]
    for columns, limit in ((onehot, max_onehot), (coded, LITERAL_LEVELS)):
        if columns:
            found, over = fit.sorted_levels(text, columns, limit)
            levels.update(found)
            many += over
    too_wide = [c for c in many if plan[c] == "onehot"]
    if too_wide:
        raise ValueError(f"one-hot needs more than {max_onehot} columns for {too_wide}; use onehot_vector, label or ordinal codes")
    rows = text.count() if many else 0
    tables = {c: fit.sorted_codes(text, c) for c in many}
    return [
        ColumnEncoding(c, m, [], drop_first and m == "onehot_vector", tables[c], rows, tables[c].count() if m == "onehot_vector" else 0)
        if c in many
        else ColumnEncoding(c, m, levels[c], drop_first and m == "onehot")
        for c, m in plan.items()
    ]


def apply_encoding(df: DataFrame, fitted: Sequence[ColumnEncoding]) -> DataFrame:
    """Replace encoded columns in place; indicator columns go to the end, in fit order.

    Indicators are expressions of the same projection: nothing is matched by row position.
    """
    for e in fitted:
        if e.vocabulary is not None and e.column in df.columns:
            df = e.joined(df)
    literal = {e.column: e for e in fitted if e.vocabulary is None and e.column in df.columns}
    kept = [
        literal[c].expressions()[0] if c in literal else q_col(c)
        for c in df.columns
        if c not in literal or literal[c].method != "onehot"
    ]
    indicators = [x for e in literal.values() if e.method == "onehot" for x in e.expressions()]
    return df.select(*kept, *indicators)
