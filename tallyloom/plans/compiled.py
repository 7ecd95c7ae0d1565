"""A written config compiled to table definitions that a platform run executes."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.columns import ref
from tallyloom.plans.steps import Context
from tallyloom.plans.tables import TableDef
from tallyloom.sinks.merge import key_repeats
from tallyloom.sinks.spec import LOAD_DATES, detect_keys
from tallyloom.sources.config import parse_config, table_from_config


def load_config(spark: SparkSession, path: str) -> dict[str, Any]:
    """A YAML or JSON config in any store that Spark reads; a folder holds its parts in order of their names."""
    parts = spark.read.text(path, wholetext=True).select("_metadata.file_path", "value").orderBy("file_path").collect()
    return parse_config("\n".join(p["value"] for p in parts))


def compile_tables(config: Mapping[str, Any]) -> dict[str, TableDef]:
    """Every entry under ``tables`` with its steps, mode, keys and dependencies.

    A table names its landing or is one. Without keys in the config they are found from the column
    names when the table is run, and proved on its rows.
    """
    out = {}
    for name, body in config["tables"].items():
        body = body or {}
        steps, load = table_from_config(name, body)
        guess = not load.keys and load.mode != "replace" and not load.alert_only
        out[name] = TableDef(body.get("landing", name), tuple(steps), load, after=tuple(body.get("after", ())), guess_keys=guess)
    return out


# Types whose least and largest value a hash aggregate keeps in place.
_FIXED = (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.TimestampType)


def differing_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that hold different rows.

    Where all other columns are numbers or days, rows of a key are equal if least and largest values are and no null
    stands beside a value: one aggregate by key. Other rows are made distinct first.
    """
    rest = [f for f in rows.schema if f.name not in keys]
    if not all(isinstance(f.dataType, _FIXED) for f in rest):
        nested = [f.name for f in rows.schema if f.dataType.simpleString().startswith("map")]
        return key_repeats(rows.withColumns({c: F.to_json(ref(c)) for c in nested}).distinct(), keys)
    differs = F.lit(False)
    for c in (ref(f.name) for f in rest):
        differs = differs | ~F.min(c).eqNullSafe(F.max(c)) | ~F.count(c).isin(F.lit(0), F.count(F.lit(1)))
    return rows.groupBy(*map(ref, keys)).agg(differs.alias("differs")).filter("differs").drop("differs")


def prove_keys(rows: DataFrame, keys: list[str]) -> None:
    """K7: a guessed key holds one row, apart from rows that are equal but for their load dates."""
    compared = rows.select(*[ref(c) for c in rows.columns if c.lower() not in LOAD_DATES and not c.startswith("__")])
    repeats = differing_keys(compared, keys)
    if first := repeats.select(F.to_json(F.struct(*map(ref, keys))).alias("key")).first():
        raise ValueError(f"guessed key {keys} holds different rows, as {json.loads(first['key'])}")


def keyed(table: TableDef, rows: DataFrame) -> TableDef:
    """``table`` with the key its columns suggest, proved on ``rows``."""
    keys = detect_keys([c for c in rows.columns if not c.startswith("__")])
    prove_keys(rows, keys)
    return replace(table, load=replace(table.load, keys=tuple(keys)), guess_keys=False)


def planned(tables: Mapping[str, TableDef], landings: Mapping[str, DataFrame], ctx: Context) -> list[tuple[str, str, str]]:
    """(table, mode, keys as guessed or given) without running anything: what a config amounts to."""
    out = []
    for name, table in tables.items():
        keys = list(table.load.keys) or (detect_keys(table.transform(landings[table.landing], ctx).columns) if table.guess_keys else [])
        out.append((name, table.load.mode, ",".join(keys)))
    return out
