"""Named processing steps.

A configured table names its steps; each is a function ``(df, ctx, **params)``
over the operators. Unknown names and wrong parameters raise before anything
runs (trap T5).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates, text
from tallyloom.operators import aggregate, columns, dedupe, lookup, nested, nulls
from tallyloom.operators.columns import present, ref, with_columns


@dataclass(frozen=True)
class Step:
    name: str
    params: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Context:
    """What steps need beside the table: the run clock and small dimensions as DataFrames."""

    run_ts: datetime
    dims: Mapping[str, DataFrame] = field(default_factory=dict)

    def dim(self, name: str) -> DataFrame:
        if name not in self.dims:
            raise ValueError(f"context has no dimension {name!r}")
        return self.dims[name]


REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def step(*names: str):
    """Register a step under one or more config names."""

    def keep(fn):
        for name in names:
            REGISTRY[name] = fn
        return fn

    return keep


def run_steps(df: DataFrame, steps: Sequence[Step], ctx: Context, on_error: str = "raise", skipped: list | None = None) -> DataFrame:
    """Apply the steps in order.

    ``on_error='skip'`` leaves a step out that is unknown or fails to plan and
    adds (name, message) to ``skipped``.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error is 'raise' or 'skip'")
    for s in steps:
        try:
            if s.name not in REGISTRY:
                raise ValueError(f"unknown step {s.name!r}")
            df = REGISTRY[s.name](df, ctx, **s.params)
        except Exception as e:
            if on_error == "raise":
                raise
            if skipped is not None:
                skipped.append((s.name, str(e)))
    return df


def _cols(columns=None, cols=None) -> list[str]:
    return list(columns or cols or [])


# ------------------------------------------------------------------ columns
@step("rename_columns", "rename_column")
def rename(df, ctx, renaming=None, mapping=None, col_dict=None):
    return columns.rename_columns(df, renaming or mapping or col_dict or {})


@step("google_rename_columns")
def rename_standard(df, ctx):
    from tallyloom.plans.tables import STANDARD_NAMES

    return columns.rename_columns(df, STANDARD_NAMES)


@step("handle_columns")
def shorten(df, ctx):
    return columns.shorten_columns(df)


@step("normalize_column_names")
def snake(df, ctx):
    return columns.snake_columns(df)


@step("rename_placement_id")
def placement_id(df, ctx):
    return columns.rename_columns(df, {"adgroup_id": "id"})


@step("drop_columns")
def drop(df, ctx, columns_=None, cols=None, **kw):
    return columns.drop_columns(df, _cols(kw.get("columns"), cols))


@step("add_load_date")
def load_date(df, ctx):
    return columns.add_load_metadata(df, ctx.run_ts, ["load_date"])


@step("add_row_loaded_date")
def row_loaded_date(df, ctx):
    return columns.add_load_metadata(df, ctx.run_ts, ["row_loaded_date"])


@step("add_last_updated_date")
def last_updated_date(df, ctx):
    return columns.add_load_metadata(df, ctx.run_ts, ["last_updated_date"])


@step("add_ingestion_timestamp")
def ingestion_timestamp(df, ctx):
    return columns.add_load_metadata(df, ctx.run_ts, ["IngestionTimestamp"])


@step("convert_string")
def to_text(df, ctx, columns=None, cols=None):
    from tallyloom.operators import columns as op

    return op.ids_to_text(df, _cols(columns, cols))


@step("fix_id_type")
def id_names_to_text(df, ctx):
    return columns.ids_to_text(df)


@step("convert_int")
def to_int(df, ctx, columns):
    from tallyloom.operators import columns as op

    return op.convert_int(df, columns)


@step("convert_id_types")
def id_types(df, ctx, columns=None):
    from tallyloom.operators import columns as op

    wanted = columns or [c for c in ("AccountId", "CampaignId", "AdId", "CustomerId") if c in df.columns]
    wanted = wanted or present(df, ("account_id", "campaign_id", "ad_id", "customer_id"))
    return op.convert_id_types(df, wanted)


@step("convert_costs")
def costs(df, ctx, columns, null_as_zero=False):
    from tallyloom.operators import columns as op

    return op.convert_costs(df, columns, null_as_zero)


@step("add_campaign_info")
def campaign_info(df, ctx):
    columns.require(df, ["campaign_id", "campaign_name"], "add_campaign_info")
    return df


# -------------------------------------------------------------------- nulls
@step("drop_na_rows", "drop_null_rows", "dropna_value", "dropna")
def no_nulls(df, ctx, columns=None, cols=None, subset=None):
    return nulls.drop_null_rows(df, _cols(columns, cols or subset) or None)


@step("replace_nan_with_zero", "fill_view_ctr_nan", "fill_na")
def fill(df, ctx, columns=None, cols=None, value=0):
    return nulls.fill_missing(df, _cols(columns, cols) or None, value)


@step("nan_conversion", "convert_nat_to_nan")
def nan_null(df, ctx, columns=None, cols=None):
    return nulls.nan_to_null(df, _cols(columns, cols) or None)


@step("delete_nan_string")
def null_words(df, ctx, columns=None):
    return nulls.null_words_to_null(df, columns)


@step("filter_rows")
def filter_rows(df, ctx, condition):
    return df.filter(condition)


# --------------------------------------------------------------------- text
@step("modify_name")
def labels(df, ctx, columns=None, cols=None, profile="pipe"):
    return with_columns(df, _cols(columns, cols), lambda c: text.clean_label(c, profile))


@step("remove_emoji")
def no_emoji(df, ctx, columns, profile="basic"):
    return with_columns(df, columns, lambda c: text.strip_emoji(c, profile))


@step("remove_non_latin")
def latin(df, ctx, columns):
    return with_columns(df, columns, text.keep_latin)


@step("remove_piping")
def no_pipe(df, ctx, columns):
    return with_columns(df, columns, text.swap_pipe)


@step("clean_audience_string")
def audience_labels(df, ctx):
    return with_columns(df, ["display_name"], text.audience_label)


@step("clean_text_columns")
def post_text(df, ctx, columns):
    return with_columns(df, columns, lambda c: F.when(c.isNotNull(), text.clean_post_text(c)))


@step("extract_id_from_urn")
def urn_ids(df, ctx, columns):
    return with_columns(df, columns, text.urn_digits)


@step("response_decoration")
def decoration(df, ctx, field, new_col_name=None):
    """Digits of a URN, of the first item where the field is an array; optionally under a new name."""
    from pyspark.sql import types as T

    if field not in df.columns:
        return df
    col = ref(field)
    if isinstance(df.schema[field].dataType, T.ArrayType):
        col = F.get(col, F.lit(0))
    out = df.withColumn(new_col_name or field, text.urn_digits(col))
    return out.drop(field) if new_col_name else out


@step("modify_urn_li_sponsoredAccount")
def account_urn(df, ctx):
    return with_columns(df, ["account"], text.urn_account)


@step("extract_id_from_resource_name")
def resource_ids(df, ctx, column="resource_name", out="id"):
    return df.withColumn(out, text.resource_id(ref(column)))


@step("extract_custom_conversion_id")
def conversion_id(df, ctx):
    source = ref("action_type") if "action_type" in df.columns else F.lit(None).cast("string")
    return df.withColumn("conversion_id", text.custom_conversion_id(source))


@step("extract_pivot_value")
def pivot_id(df, ctx, pivot_field="pivotValues", urn_type="organization", id_column="demographic_id"):
    return df.withColumn(id_column, text.pivot_value(ref(pivot_field), urn_type)).drop(pivot_field)


# -------------------------------------------------------------------- dates
@step("build_date_field")
def build_date(df, ctx, fields_date=("year", "month", "day"), begin_end=("start", "end"), exclude=True):
    for side in begin_end:
        parts = [f"dateRange_{side}_{f}" for f in fields_date]
        if all(p in df.columns for p in parts):
            df = df.withColumn(f"date_{side}", dates.date_from_parts(*map(ref, parts))).drop(*parts)
    if exclude and "date_start" in df.columns:
        df = df.drop("date_end").withColumnRenamed("date_start", "date")
    return df


@step("convert_unix_timestamp_to_date")
def unix_time(df, ctx, columns, unit="ms"):
    fn = {"ms": dates.millis_to_ts, "s": dates.seconds_to_ts, "any": dates.to_timestamp_any}[unit]
    return with_columns(df, columns, fn)


@step("deal_with_date")
def date_text(df, ctx, columns=None, cols=None, zone="Europe/Rome", style="iso"):
    fn = (lambda c: dates.iso_to_zone(c, zone)) if style == "iso" else dates.day_from_text
    return with_columns(df, _cols(columns, cols), fn)


@step("convert_timestamp_to_date")
def timestamps(df, ctx, columns):
    return with_columns(df, columns, dates.parse_timestamp)


# ------------------------------------------------------------------- nested
@step("extract_nested_actions")
def action_cols(df, ctx, types, action_col="actions", prefix="action_"):
    return nested.action_columns(df, action_col, types, prefix)


@step("extract_nested_action_values")
def action_value_cols(df, ctx, types, col="action_values", prefix="action_value_"):
    return nested.action_columns(df, col, types, prefix)


@step("convert_actions_to_df")
def actions_long(df, ctx, id_column="ad_id", actions_column="actions"):
    return nested.actions_long(df, id_column, actions_column)


@step("parse_targeting_field")
def audiences(df, ctx, targeting_col="targeting"):
    return nested.targeting_audiences(df, targeting_col)


@step("extract_targeting_criteria")
def segments(df, ctx, criteria="targetingCriteria"):
    return nested.targeting_segments(df, criteria)


@step("extract_pixel_rule")
def pixel(df, ctx, rule_column="rule"):
    return nested.pixel_rule(df, rule_column)


@step("extract_creative_type_from_content")
def creative(df, ctx):
    return nested.creative_type(df)


@step("flatten_nested")
def flatten(df, ctx, nested_element=()):
    return nested.flatten_nested(df, nested_element)


@step("flatten_struct")
def flatten_dotted(df, ctx, sep="."):
    return nested.flatten_struct(df, sep)


# ------------------------------------------------------------------ lookups
@step("add_company")
def company(df, ctx, account_column="id"):
    return lookup.add_company(df, ctx.dim("companies"), account_column)


@step("lookup_organization_names")
def organization_names(df, ctx, id_column, name_column):
    return lookup.lookup_names(df, ctx.dim("organizations"), id_column, name_column, "Organization")


@step("lookup_title_names")
def title_names(df, ctx, id_column, name_column):
    return lookup.lookup_names(df, ctx.dim("titles"), id_column, name_column, "Title")


@step("map_seniority_names")
def seniority(df, ctx, code_column="seniority_code", name_column="seniority_name"):
    return df.withColumn(name_column, lookup.seniority_name(ref(code_column)))


# ----------------------------------------------------- dedupe and aggregate
@step("deduplicate", "drop_duplicates")
def dedupe_rows(df, ctx, subset=None, keep="first", order=()):
    return dedupe.deduplicate(df, subset, order, keep)


@step("limit_placement")
def placements(df, ctx, k=25):
    return dedupe.limit_placements(df, k)


@step("keep_highest_level")
def highest_level(df, ctx, id_column="id"):
    return dedupe.keep_highest_level(df, id_column)


@step("aggregate_by_entity", "aggregate_metrics_by_entity")
def by_entity(df, ctx, group_columns=None, metric_columns=None, agg_method="sum", order=()):
    """Summed metrics; click rates and unit costs are recomputed from the sums (trap T4)."""
    keys = group_columns or aggregate.entity_columns(df)
    metrics = list(metric_columns or aggregate.metric_columns(df, keys))
    out = aggregate.entity_rollup(df, keys, metrics, agg_method, order=order)
    if agg_method != "sum":
        return out
    from tallyloom.functions.numbers import ratio

    rules = {"ctr": ("clicks", "impressions", 100), "cpc": ("spend", "clicks", 1), "cpm": ("spend", "impressions", 1000)}
    again = {m: ratio(ref(n), ref(d), s) for m, (n, d, s) in rules.items() if {m, n, d} <= set(out.columns)}
    return out.withColumns(again)


@step("aggregate_by_keys")
def by_keys(df, ctx, group_by=("ad_id", "device"), order=()):
    return aggregate.aggregate_by_keys(df, group_by, order)


@step("aggregate_by_device")
def by_device(df, ctx, order=()):
    return aggregate.aggregate_by_device(df, order)


@step("sort_by")
def sort(df, ctx, columns, ascending=True):
    return aggregate.sort_by(df, columns, ascending)
