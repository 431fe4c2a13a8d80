"""Metric queries over a semantic model: a dataset, its fields and metrics."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.plans.checks import safe_identifier


@dataclass(frozen=True)
class Field:
    name: str
    expression: str | None = None
    is_time: bool = False
    synonyms: tuple[str, ...] = ()

    @property
    def column(self) -> Column:
        return F.expr(self.expression or self.name).alias(self.name)


@dataclass(frozen=True)
class Metric:
    name: str
    function: str  # sum or count_distinct
    field: str
    synonyms: tuple[str, ...] = ()

    @property
    def column(self) -> Column:
        functions = {"sum": F.sum, "count_distinct": F.count_distinct}
        return functions[self.function](F.col(self.field)).alias(self.name)


@dataclass(frozen=True)
class SemanticModel:
    name: str
    fields: tuple[Field, ...]
    metrics: tuple[Metric, ...]
    primary_key: tuple[str, ...] = ()

    def find(self, name: str) -> Field | Metric:
        """A field or metric by name or synonym, any case."""
        wanted = name.lower()
        for item in (*self.metrics, *self.fields):
            if wanted == item.name.lower() or wanted in [s.lower() for s in item.synonyms]:
                return item
        raise KeyError(f"{name} is not in the model {self.name}")


def classify(model: SemanticModel) -> dict[str, str]:
    """'fact' for fields that metrics compute with, 'dimension' for times, identifiers, flags and the rest."""
    used = {m.field for m in model.metrics}
    out = {}
    for f in model.fields:
        identifier = f.name.endswith("_id") or f.name in model.primary_key
        plain = not (f.is_time or identifier or f.name.startswith("is_"))
        out[f.name] = "fact" if plain and f.name in used else "dimension"
    return out


def field_class(name: Column, is_time: Column, in_key: Column, used: Column) -> Column:
    """The class of a field as ``classify`` gives it, for rows of a table of fields; NULL flags count as false."""
    no = F.lit(False)
    plain = ~(F.coalesce(is_time, no) | F.coalesce(in_key, no) | name.endswith("_id") | name.startswith("is_"))
    return F.when(plain & F.coalesce(used, no), "fact").otherwise("dimension")


def classify_fields(fields: DataFrame, metrics: DataFrame) -> DataFrame:
    """``fields`` (name, is_time, in_key and what else they have) with ``field_class``; metrics name the ``field`` they compute with."""
    used = metrics.select(F.col("field").alias("name")).distinct().withColumn("_used", F.lit(True))
    return fields.join(used, "name", "left").withColumn("field_class", field_class(F.col("name"), F.col("is_time"), F.col("in_key"), F.col("_used"))).drop("_used")


def metric_query(
    df: DataFrame, model: SemanticModel, metrics: Sequence[str], dims: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Metrics grouped by dimensions. Only the fields the question needs are read."""
    chosen = [model.find(m) for m in metrics]
    if any(not isinstance(m, Metric) for m in chosen):
        raise ValueError("a field cannot be queried as a metric")
    groups = [model.find(d) for d in dims]
    facts = [g.name for g in groups if isinstance(g, Metric) or classify(model)[g.name] == "fact"]
    if facts:
        raise ValueError(f"not dimensions: {facts}")
    rows = df if where is None else df.filter(where)
    needed = {f.name: f for f in (*groups, *[model.find(m.field) for m in chosen])}
    projected = rows.select(*[f.column for f in needed.values()])
    return projected.groupBy(*[g.name for g in groups]).agg(*[m.column for m in chosen])


def model_from_dict(raw: dict) -> SemanticModel:
    """Model from the parsed text of a semantic file with one model and one dataset."""
    models = raw.get("semantic_model", [])
    if len(models) != 1 or len(models[0].get("datasets", [])) != 1:
        raise ValueError("expected exactly one semantic model with one dataset")
    data = models[0]["datasets"][0]
    text = lambda item: item["expression"]["dialects"][0]["expression"]
    extras = lambda item: tuple(item.get("ai_context", {}).get("synonyms", []))
    fields = tuple(
        Field(f["name"], text(f), f.get("dimension", {}).get("is_time", False), extras(f)) for f in data.get("fields", [])
    )
    metrics = []
    for m in models[0].get("metrics", []):
        shape = re.fullmatch(r"\s*(SUM|COUNT)\s*\(\s*(DISTINCT\s+)?(?:\w+\.)?(\w+)\s*\)\s*", text(m), re.I)
        if not shape or (shape[1].upper() == "COUNT") != bool(shape[2]):
            raise ValueError(f"unsupported metric expression: {text(m)}")
        function = "count_distinct" if shape[2] else "sum"
        metrics.append(Metric(m["name"], function, safe_identifier(shape[3]), extras(m)))
    return SemanticModel(models[0]["name"], fields, tuple(metrics), tuple(data.get("primary_key", [])))
