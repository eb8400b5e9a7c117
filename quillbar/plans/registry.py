"""Declared tables: names, columns, required or not. Read once on the driver, before any job starts."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Declared type names and the Spark types behind them; any other name means text.
SPARK_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
}


class RegistryError(ValueError):
    """A table that is not declared, or declared incompletely."""


@dataclass(frozen=True)
class FieldRule:
    name: str
    type: str
    required: bool

    @classmethod
    def from_dict(cls, d: dict) -> FieldRule:
        return cls(d["name"], d["field_type"], d.get("mode", "NULLABLE") != "NULLABLE")


@dataclass(frozen=True)
class TableSpec:
    dataset: str
    table: str
    fields: tuple[FieldRule, ...]

    @property
    def full_name(self) -> str:
        return f"{self.dataset}.{self.table}"

    def spark_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, SPARK_TYPES.get(f.type, T.StringType()), not f.required) for f in self.fields])


@dataclass(frozen=True)
class Registry:
    config: dict

    @classmethod
    def from_file(cls, spark: SparkSession, path: str) -> Registry:
        from quillbar.sources.xml import read_small_text

        return cls.from_text(read_small_text(spark, path), yaml_text=path.endswith((".yaml", ".yml")))

    @classmethod
    def from_text(cls, text: str, yaml_text: bool = False) -> Registry:
        if not yaml_text:
            return cls(json.loads(text))
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("a YAML registry needs PyYAML; the same layout works as JSON") from e
        return cls(yaml.safe_load(text))

    def names(self) -> list[str]:
        """The declared tables that are complete."""
        return [n for n, e in self.config.get("tables", {}).items() if e and e.get("table_id") and e.get("dataset_id")]

    @property
    def default(self) -> bool:
        """Whether there is a default table."""
        entry = self.config.get("default") or {}
        return bool(entry.get("table_id") and entry.get("dataset_id"))

    def resolve(self, name: str | None = None) -> TableSpec:
        """The declared table, or the default when no name is given. An undeclared name is an error."""
        entry = (self.config.get("tables", {}).get(name) if name else self.config.get("default")) or {}
        for part in ("table_id", "dataset_id"):
            if not entry.get(part):
                raise RegistryError(f"'{part}' is missing in the configuration for table '{name or 'default'}'")
        return TableSpec(entry["dataset_id"], entry["table_id"], tuple(FieldRule.from_dict(f) for f in entry.get("schema", [])))
