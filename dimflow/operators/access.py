"""Masked projections, secure views, row and column policies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.functions.protect import MASK, hash_column, mask_constant
from dimflow.operators.skew import BROADCAST_BYTES, HOT_ROWS, join_skewed
from dimflow.sources.tables import ensure_database, quoted
from dimflow.spec import PipelineSpec


def mask_by_policy(df: DataFrame, pii: Sequence[str] = (), sensitive: Sequence[str] = (),
                   salt: str | None = None) -> DataFrame:
    """Personal columns become ``<c>_masked``, sensitive ones ``<c>_hash``, the rest stay, all in place."""
    def shown(c: str) -> Column:
        if c in pii:
            return mask_constant().alias(f"{c}_masked")
        return hash_column(F.col(c), salt).alias(f"{c}_hash") if c in sensitive else F.col(c)

    return df.select(*map(shown, df.columns))


def create_secure_view(spark: SparkSession, spec: PipelineSpec) -> str:
    """The masked view over a pipeline's dimension: current rows without technical columns."""
    columns = spark.table(spec.target_table).columns
    technical = {"end_date", "is_current", "hash", *[f"{p}_{c}" for p in ("current", "prev") for c in spec.tracked]}
    shown = []
    for c in columns:
        if c in technical:
            continue
        if c in spec.pii_columns:
            shown.append(f"'{MASK}' AS {quoted(f'{c}_masked')}")
        elif c in spec.sensitive_columns:
            salt = "" if spec.hash_salt is None else spec.hash_salt.replace("\\", "\\\\").replace("'", "\\'")
            shown.append(f"sha2(concat('{salt}', CAST({quoted(c)} AS STRING)), 256) AS {quoted(f'{c}_hash')}")
        else:
            shown.append(quoted(c))
    where = " WHERE is_current" if "is_current" in columns else ""
    ensure_database(spark, spec.view_name)
    spark.sql(f"CREATE OR REPLACE VIEW {spec.view_name} AS SELECT {', '.join(shown)} FROM {spec.target_table}{where}")
    return spec.view_name


def row_policy(df: DataFrame, grants: DataFrame, attribute: str, principal: str, limit: int = HOT_ROWS,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows whose attribute is granted to the principal in a table ``principal, <attribute>``; none without."""
    granted = grants.filter(F.col("principal") == principal).select(attribute).distinct()
    return join_skewed(df, granted, [attribute], "left_semi", limit, broadcast_bytes)


def column_policy(df: DataFrame, role_map: Mapping[str, Mapping[str, str]], role: str) -> DataFrame:
    """Per role and column: clear, masked, hashed or absent. Columns a role does not list are absent."""
    access = role_map.get(role, {})
    shown = []
    for c in df.columns:
        match access.get(c, "absent"):
            case "clear":
                shown.append(F.col(c))
            case "masked":
                shown.append(mask_constant().alias(c))
            case "hashed":
                shown.append(hash_column(F.col(c)).alias(c))
            case "absent":
                pass
            case other:
                raise ValueError(f"unknown access {other!r}")
    return df.select(*shown)
