"""Source file to masked extract, for every registered pipeline, in one application."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from dimflow.operators import scd
from dimflow.operators.access import create_secure_view
from dimflow.operators.cleaning import clean, dedup_latest
from dimflow.operators.splice import sightings, splice, spliced
from dimflow.plans.commits import ConcurrentLoad
from dimflow.plans.dimension_table import current_rows, publish, seen_rows, settle
from dimflow.plans.rejects import store_rejects
from dimflow.sources.readers import read_source
from dimflow.sources.storage import checkpointed
from dimflow.sources.tables import export_csv, overwrite_table
from dimflow.spec import PipelineSpec, check_specs

TRIES = 3


def _day(spark: SparkSession, as_of: str | None) -> str:
    return str(spark.sql("SELECT 1").select(scd.load_date(as_of)).first()[0])


def stage(spark: SparkSession, spec: PipelineSpec, as_of: str | None = None) -> DataFrame:
    """Read, clean, optionally keep the newest row per key, and store as the staging table. Rows without a usable key go to
    the pipeline's table of rejects, if it has one; the source is then read twice."""
    raw = read_source(spark, spec.source)
    rows = clean(raw, spec)
    if spec.rejects_table:
        store_rejects(raw, spec, _day(spark, as_of))
    if spec.dedup_order:
        rows = dedup_latest(rows, [spec.key], spec.dedup_order)
    return overwrite_table(rows, spec.staging_table)


def history_table(spec: PipelineSpec) -> str:
    """Where a type 4 dimension keeps replaced rows."""
    return f"{spec.target_table}_history"


def _require_one_row_per_key(staged: DataFrame, spec: PipelineSpec) -> None:
    repeated = staged.groupBy(spec.key).count().filter("count > 1").select(spec.key).take(1)
    if repeated:
        raise ValueError(f"{spec.pipeline_name}: key {repeated[0][0]!r} is staged more than once; set dedup_order")


def apply_scd(staged: DataFrame, spec: PipelineSpec, as_of: str | None = None, tries: int = TRIES) -> DataFrame:
    """Bring a staged batch into the pipeline's dimension by its SCD type and return the dimension.

    With types 2 and 6 a batch may be of an earlier day than others loaded before; it is then put between their versions.
    If another load is committed meanwhile, the batch is merged again with what that left, up to ``tries`` times in all.
    """
    check_specs([spec])
    if spec.merges:
        _require_one_row_per_key(staged, spec)
    while True:
        tries -= 1
        try:
            return _load(staged, spec, as_of)
        except ConcurrentLoad:
            if tries <= 0:
                raise


def _load(staged: DataFrame, spec: PipelineSpec, as_of: str | None) -> DataFrame:
    spark, table, keys, tracked = staged.sparkSession, spec.target_table, [spec.key], list(spec.tracked)
    base = settle(spark, table)
    first = not spec.merges or "load" not in base
    current = None if first else current_rows(spark, table)
    more = {"base": base}
    if spec.scd_type in (2, 6):
        as_of = _day(spark, as_of)
        more |= {"day": as_of} | ({"seen": sightings(staged, keys, scd.load_date(as_of))} if spec.late_batches else {})
    match spec.scd_type:
        case 0:
            rows = staged if first else scd.scd0(current, staged, keys)
        case 1:
            rows = scd.scd1_reload(staged, tracked) if first else scd.scd1_upsert(current, staged, keys, tracked)
        case 2 | 6 if not first and as_of <= base.get("newest", "9999"):
            rows, more["retired"] = _late(current, staged, spec, as_of)
        case 2:
            rows = (scd.scd2_initial(staged, tracked, as_of) if first
                    else scd.scd2_changes(current, staged, keys, tracked, as_of))
        case 3:
            rows = scd.scd3_initial(staged, tracked) if first else scd.scd3(current, staged, keys, tracked)
        case 4:
            rows = scd.scd1_reload(staged, tracked)
            if not first:
                rows, replaced = scd.scd4(current, staged, keys, tracked, as_of)
                more["replaced"] = history_table(spec), replaced
        case 6:
            rows = (scd.scd6_initial(staged, tracked, as_of) if first
                    else scd.scd6_changes(current, staged, keys, tracked, as_of))
    # a reload replaces what is there in the step that shows it
    publish(rows, table, spec.key, tracked if spec.scd_type == 6 else (), afresh=not spec.merges, **more)
    return spark.table(table)


def _late(current: DataFrame, staged: DataFrame, spec: PipelineSpec, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(current rows and versions that a late load closes, key and start of all it replaces)."""
    spark, keys = staged.sparkSession, [spec.key]
    rows, replaced = splice(spark.table(spec.target_table), scd.with_hash(staged, spec.tracked), keys, list(spec.tracked),
                            scd.load_date(as_of), seen_rows(spark, spec.target_table))
    rows, replaced = checkpointed(rows), checkpointed(replaced)
    return spliced(current, rows, replaced, keys), replaced


def run_pipeline(spark: SparkSession, spec: PipelineSpec, export_dir: str, as_of: str | None = None,
                 single_file: bool = False) -> str:
    """Stage, load, publish the masked view and export it; returns the extract's folder."""
    apply_scd(stage(spark, spec, as_of), spec, as_of)
    view = create_secure_view(spark, spec)
    return export_csv(spark.table(view), f"{export_dir.rstrip('/')}/dashboard_{spec.pipeline_name}.csv", single_file)


def run_pipelines(spark: SparkSession, specs: Iterable[PipelineSpec], export_dir: str, as_of: str | None = None,
                  single_file: bool = False) -> dict[str, str]:
    """All pipelines in order; every spec is checked before the first starts."""
    return {s.pipeline_name: run_pipeline(spark, s, export_dir, as_of, single_file) for s in check_specs(specs)}
