"""Feature preparation fitted on training rows and applied unchanged to new rows.

A plan is a list of stages. Fitting walks the stages once: each learns its parameters from the
rows the earlier ones produced. What remains is a list of steps that hold plain parameters;
applying them is a chain of narrow projections that Spark collapses.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, encode, features, impute, outliers, scale
from ..schema import align_columns, column_roles
from ..sources.writers import read_json_record, write_json_record

log = logging.getLogger(__name__)

DEFAULT_STAGES = ("constraints", "unify", "datetime", "outliers", "impute", "encode", "scale", "interactions")
# the older one-shot order
ONE_SHOT_STAGES = ("constraints", "impute", "unify", "ratio", "outliers", "scale", "encode")


@dataclass
class Step:
    """A fitted stage: parameters in ``params``, behaviour in :data:`APPLY`."""

    kind: str
    params: dict[str, Any] = field(default_factory=dict)

    def apply(self, df: DataFrame, training: bool = False) -> DataFrame:
        return APPLY[self.kind](df, self.params, training)


def _apply_constraints(df, p, training):
    # new rows are never removed: only bounds apply to them
    actions = ("clip", "drop", "mean") if training else ("clip",)
    return clean.apply_constraints(
        df, p["rules"], mean_action=p["mean_action"], actions=actions, drop_unparsable=training
    )


def _apply_unify(df, p, training):
    columns = [c for c in p["columns"] if c in df.columns]
    return clean.unify_text(df, columns, p["rules"], missing_as_level=p["missing_as_level"])


def _apply_datetime(df, p, training):
    for config in p["configs"]:
        df = features.datetime_parts(df, config["column"], config["parts"], drop_original=config["drop_original"])
    return df


def _apply_ratio(df, p, training):
    options = dict(p) if training else {k: v for k, v in p.items() if k not in ("low", "high", "digits")}
    return features.ratio_feature(df, **options)


def _apply_outliers(df, p, training):
    if not training:
        return df
    return outliers.remove_outliers(
        df, p["rules"], threshold=p["threshold"], simultaneous=p["simultaneous"], key=p["key"], seed=p["seed"]
    )


def _apply_impute(df, p, training):
    return p["fitted"].apply(df, training=training)


def _apply_encode(df, p, training):
    return encode.apply_encoding(df, p["fitted"]).drop(*p["refused"])


def _apply_scale(df, p, training):
    return scale.apply_scaling(df, p["fitted"])


def _apply_interactions(df, p, training):
    return features.interactions(df, [tuple(x) for x in p["pairs"]], p["operations"])


APPLY = {
    "constraints": _apply_constraints,
    "unify": _apply_unify,
    "datetime": _apply_datetime,
    "ratio": _apply_ratio,
    "outliers": _apply_outliers,
    "impute": _apply_impute,
    "encode": _apply_encode,
    "scale": _apply_scale,
    "interactions": _apply_interactions,
}


@dataclass
class FeaturePlan:
    """What to fit, by stage. ``key`` columns identify rows; they pass through untouched."""

    target: str
    key: Sequence[str] = ()
    stages: Sequence[str] = DEFAULT_STAGES
    constraints: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    mean_action: str = "reference"
    unify: bool = True
    text_rules: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    missing_as_level: bool = True
    datetime_features: Sequence[Mapping[str, Any]] = ()
    ratio: Mapping[str, Any] | None = None
    remove_outliers: bool = False
    outlier_method: str = "iqr"
    outlier_threshold: float | None = None
    outlier_rules: Mapping[str, str] | None = None
    outliers_simultaneous: bool = False
    numeric_missing: str = "median"
    categorical_missing: str = "mode"
    missing_rules: Mapping[str, Any] = field(default_factory=dict)
    order_by: Sequence[str] = ()
    encoding: str = "onehot"
    encoder_rules: Mapping[str, str] = field(default_factory=dict)
    drop_first: bool = True
    max_onehot: int = encode.ONEHOT_LEVELS
    scaling: str = "standard"
    scaler_rules: Mapping[str, str] = field(default_factory=dict)
    exclude_scaling: Sequence[str] = ()
    interaction_pairs: Sequence[tuple[str, str]] = ()
    interaction_operations: Sequence[str] = ("multiply",)
    reference_compat: bool = False
    on_error: str = "raise"
    seed: int = 42

    def fit(self, train: DataFrame) -> "FittedPlan":
        return self.fit_transform(train)[0]

    def fit_transform(self, train: DataFrame) -> tuple["FittedPlan", DataFrame]:
        """The fitted plan and the training rows as it left them."""
        if self.target not in train.columns:
            raise ValueError(f"target column {self.target!r} is not in the table")
        unknown = [s for s in self.stages if s not in APPLY]
        if unknown:
            raise ValueError(f"unknown stages {unknown}")
        current, steps = train, []
        for stage in self.stages:
            step = self._fit_stage(stage, current)
            if step is not None:
                steps.append(step)
                current = step.apply(current, training=True)
        return FittedPlan(steps, list(current.columns), self.target, list(self.key), self.reference_compat), current

    def _fit_stage(self, stage: str, df: DataFrame) -> Step | None:
        free = [c for c in df.columns if c not in self.key]
        if stage == "constraints" and self.constraints:
            rules = {c: dict(r) for c, r in self.constraints.items() if isinstance(r, Mapping)}
            return Step(stage, {"rules": rules, "mean_action": self.mean_action})
        if stage == "unify" and self.unify:
            text = [c for c in column_roles(df.select(*free)).categorical]
            return Step(
                stage,
                {"columns": text, "rules": {c: dict(r) for c, r in self.text_rules.items()},
                 "missing_as_level": self.missing_as_level},
            )
        if stage == "datetime" and self.datetime_features:
            configs = [
                {
                    "column": c["column"],
                    "parts": list(c.get("parts", ("hour", "day", "month", "dayofweek"))),
                    "drop_original": bool(c.get("drop_original", False)),
                }
                for c in self.datetime_features
            ]
            return Step(stage, {"configs": configs})
        if stage == "ratio" and self.ratio:
            return Step(stage, dict(self.ratio))
        if stage == "outliers" and (self.remove_outliers or self.outlier_rules):
            numeric = [c for c in column_roles(df.select(*free)).numeric]
            rules = dict(self.outlier_rules or {c: self.outlier_method for c in numeric})
            return Step(
                stage,
                {"rules": rules, "threshold": self.outlier_threshold, "simultaneous": self.outliers_simultaneous,
                 "key": list(self.key), "seed": self.seed},
            )
        if stage == "impute":
            return Step(stage, {"fitted": self._fit_imputation(df, free)})
        if stage == "encode":
            fitted, refused = self._fit_encoding(df, free)
            return Step(stage, {"fitted": fitted, "refused": refused})
        if stage == "scale":
            plan = scale.scale_plan(
                df.select(*free),
                self.scaling,
                exclude=[self.target, *self.exclude_scaling],
                rules=self.scaler_rules,
                skip_binary=True,
            )
            return Step(stage, {"fitted": scale.fit_scaling(df, plan)})
        if stage == "interactions" and self.interaction_pairs:
            return Step(
                stage, {"pairs": [list(p) for p in self.interaction_pairs], "operations": list(self.interaction_operations)}
            )
        return None

    def _fit_imputation(self, df: DataFrame, columns: Sequence[str]) -> impute.Imputation:
        def one(names: Sequence[str]) -> impute.Imputation:
            return impute.fit_imputation(
                df,
                self.missing_rules,
                numeric=self.numeric_missing,
                categorical=self.categorical_missing,
                columns=names,
                order_by=self.order_by,
            )

        parts = self._fit_or_skip(one, columns)
        whole = impute.Imputation(order_by=list(self.order_by))
        for p in parts:
            whole.values.update(p.values)
            whole.dropped += p.dropped
            whole.forward += p.forward
            whole.backward += p.backward
            whole.as_double += p.as_double
        return whole

    def _fit_encoding(self, df: DataFrame, columns: Sequence[str]) -> tuple[list[encode.ColumnEncoding], list[str]]:
        """The encodings, and the columns that could not be encoded: as raw text they are no features and go."""
        plan = encode.encode_plan(df.select(*columns), self.encoding, rules=self.encoder_rules)
        plan.pop(self.target, None)

        def one(names: Sequence[str]) -> list[encode.ColumnEncoding]:
            return encode.fit_encoding(df, {c: plan[c] for c in names}, drop_first=self.drop_first, max_onehot=self.max_onehot)

        fitted = [e for part in self._fit_or_skip(one, list(plan)) for e in part]
        return fitted, [c for c in plan if c not in {e.column for e in fitted}]

    def _fit_or_skip(self, one, columns: Sequence[str]) -> list:
        """Fit all columns together; with ``on_error="skip"`` a failing column is left out and logged."""
        try:
            return [one(list(columns))]
        except Exception:
            if self.on_error != "skip":
                raise
        parts = []
        for c in columns:
            try:
                parts.append(one([c]))
            except Exception as problem:
                log.warning("column %s skipped: %s", c, problem)
        return parts


@dataclass
class FittedPlan:
    """Fitted steps plus the training column list. Only plain parameters, no data."""

    steps: list[Step]
    columns: list[str]
    target: str
    key: list[str] = field(default_factory=list)
    reference_compat: bool = False

    @property
    def features(self) -> list[str]:
        return [c for c in self.columns if c != self.target and c not in self.key]

    def transform(self, df: DataFrame) -> DataFrame:
        """New rows: no row is removed, levels unknown to the fit encode as unseen, columns are aligned.

        The target may be absent. ``reference_compat`` leaves out text and range rules, as the
        behaviour this engine was modelled on does at scoring time.
        """
        self._check()
        had_target = self.target in df.columns
        for step in self.steps:
            if self.reference_compat and step.kind in ("unify", "constraints"):
                continue
            if df.isStreaming and step.kind == "impute" and not step.params["fitted"].stateless:
                raise ValueError("forward and backward fills need the whole table and cannot run on a stream")
            df = step.apply(df)
        wanted = [c for c in self.columns if had_target or c != self.target]
        return align_columns(df, [c for c in wanted if c not in self.key or c in df.columns])

    def _check(self) -> None:
        if not self.columns:
            raise ValueError("the plan has not been fitted")

    # -- persistence: one JSON record, and a Parquet table per large vocabulary ---------------

    def save(self, spark: SparkSession, path: str) -> str:
        record = {
            "columns": self.columns,
            "target": self.target,
            "key": self.key,
            "reference_compat": self.reference_compat,
            "steps": [{"kind": s.kind, "params": _plain(s)} for s in self.steps],
        }
        for s in self.steps:
            if s.kind == "encode":
                for i, e in enumerate(s.params["fitted"]):
                    if e.vocabulary is not None:
                        e.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary/{i}")
        return write_json_record(spark, record, f"{path}/plan")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FittedPlan":
        record = read_json_record(spark, f"{path}/plan")
        steps = [Step(s["kind"], _revived(spark, path, s["kind"], s["params"])) for s in record["steps"]]
        return FittedPlan(steps, record["columns"], record["target"], record["key"], record["reference_compat"])


def _plain(step: Step) -> dict[str, Any]:
    fitted = step.params.get("fitted")
    if fitted is None:
        return step.params
    if step.kind == "impute":
        return {"fitted": asdict(fitted)}
    if step.kind == "scale":
        return {"fitted": [asdict(s) for s in fitted]}
    return {
        "refused": step.params["refused"],
        "fitted": [
            {"column": e.column, "method": e.method, "levels": e.levels, "drop_first": e.drop_first, "rows": e.rows,
             "size": e.size, "has_vocabulary": e.vocabulary is not None}
            for e in fitted
        ]
    }


def _revived(spark: SparkSession, path: str, kind: str, params: dict[str, Any]) -> dict[str, Any]:
    if kind == "impute":
        return {"fitted": impute.Imputation(**params["fitted"])}
    if kind == "scale":
        return {"fitted": [scale.ColumnScale(**s) for s in params["fitted"]]}
    if kind == "encode":
        restored = []
        for i, e in enumerate(params["fitted"]):
            table = spark.read.parquet(f"{path}/vocabulary/{i}") if e.pop("has_vocabulary") else None
            restored.append(encode.ColumnEncoding(vocabulary=table, **e))
        return {"fitted": restored, "refused": params["refused"]}
    return params
