"""Pipeline metadata: what to read, how to clean it, where to keep it and what to hide."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field
from typing import Any

try:
    import yaml
except ImportError:  # JSON, a subset of YAML, is then the only accepted form
    yaml = None

SCD_TYPES = (0, 1, 2, 3, 4, 6)
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass(frozen=True)
class SourceSpec:
    file_type: str
    path: str
    options: Mapping[str, Any] = field(default_factory=dict)
    schema: str | None = None


@dataclass(frozen=True)
class PipelineSpec:
    """One pipeline. The column roles default to an employee file: id, name, department, salary."""

    pipeline_name: str
    source: SourceSpec
    staging_table: str
    target_table: str
    scd_type: int = 2
    key: str = "id"
    name_columns: tuple[str, ...] = ("name",)
    int_defaults: Mapping[str, int] = field(default_factory=lambda: {"salary": 0})
    tracked: tuple[str, ...] = ("name", "department", "salary")
    pii_columns: tuple[str, ...] = ("name",)
    sensitive_columns: tuple[str, ...] = ("salary",)
    dedup_order: tuple[str, ...] = ()
    load: str | None = None
    key_type: str = "int"
    int_type: str = "int"
    hash_salt: str | None = None
    #: Keep the keys of every load of types 2 and 6, so that the order in which days are loaded does not matter.
    late_batches: bool = False
    #: Where source rows without a usable key are kept by day of load; without a table they are only left out.
    rejects_table: str | None = None

    @property
    def merges(self) -> bool:
        """Whether a batch adds to the dimension or replaces it; unless stated, only type 1 is replaced."""
        return self.scd_type != 1 if self.load is None else self.load == "merge"

    @property
    def view_name(self) -> str:
        return f"warehouse.{self.pipeline_name}_vw"

    @staticmethod
    def from_dict(entry: Mapping[str, Any]) -> "PipelineSpec":
        values = dict(entry)
        source = values.pop("source")
        values["source"] = source if isinstance(source, SourceSpec) else SourceSpec(**source)
        for name in ("name_columns", "tracked", "pii_columns", "sensitive_columns", "dedup_order"):
            if name in values:
                values[name] = tuple(values[name] or ())
        return PipelineSpec(**values)

    @staticmethod
    def register(name: str, path: str, scd_type: int = 2, file_type: str = "csv") -> "PipelineSpec":
        """A spec with the table names derived from the pipeline name."""
        return PipelineSpec(name, SourceSpec(file_type, path), f"staging.{name}", f"target.{name}_dim", scd_type)

    def problems(self) -> list[str]:
        found = []
        if not _IDENTIFIER.fullmatch(self.pipeline_name or ""):
            found.append(f"bad pipeline name {self.pipeline_name!r}")
        for table in (self.staging_table, self.target_table, *([self.rejects_table] if self.rejects_table else [])):
            parts = table.split(".")
            if len(parts) != 2 or not all(_IDENTIFIER.fullmatch(p) for p in parts):
                found.append(f"{self.pipeline_name}: table must be database.name, got {table!r}")
        if self.scd_type not in SCD_TYPES:
            found.append(f"{self.pipeline_name}: unsupported SCD type {self.scd_type!r}")
        if self.load not in (None, "merge", "reload"):
            found.append(f"{self.pipeline_name}: load must be merge or reload, got {self.load!r}")
        if self.key_type not in ("int", "bigint", "string") or self.int_type not in ("int", "bigint"):
            found.append(f"{self.pipeline_name}: unsupported key or integer type {self.key_type!r}, {self.int_type!r}")
        if self.key in self.tracked:
            found.append(f"{self.pipeline_name}: the key cannot be tracked")
        return found


def check_specs(specs: Iterable[PipelineSpec]) -> list[PipelineSpec]:
    """All specs, or one error naming everything wrong with them, before any pipeline has started."""
    specs = list(specs)
    found = [p for s in specs for p in s.problems()]
    for attribute in ("pipeline_name", "staging_table", "target_table", "rejects_table"):
        values = [getattr(s, attribute) for s in specs if getattr(s, attribute) is not None]
        found += [f"{attribute} {v!r} is used twice" for v in sorted({v for v in values if values.count(v) > 1})]
    if found:
        raise ValueError("; ".join(found))
    return specs


def add_spec(specs: Iterable[PipelineSpec], new: PipelineSpec) -> list[PipelineSpec]:
    """The list with one more pipeline; a known name is an error."""
    return check_specs([*specs, new])


def parse_specs(text: str) -> list[PipelineSpec]:
    """Specs from YAML (or JSON) text with a top-level ``pipelines`` list."""
    loaded = (yaml.safe_load(text) if yaml is not None else json.loads(text)) or {}
    return check_specs(PipelineSpec.from_dict(e) for e in loaded.get("pipelines") or [])


def load_specs(spark, path: str) -> list[PipelineSpec]:
    """Specs from one small file on any path Spark can read."""
    return parse_specs(spark.read.text(path, wholetext=True).first()[0])


def save_specs(spark, specs: Iterable[PipelineSpec], path: str) -> None:
    """Write the checked specs as one JSON file that :func:`load_specs` reads, in place of what is at ``path``."""
    text = json.dumps({"pipelines": [asdict(s) for s in check_specs(specs)]}, default=dict)
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
