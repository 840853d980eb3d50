"""Datasets that appear whole or not at all.

Tables are written into a stage beside the target; checks and a caller's last word come first; then the
stage takes the target's place by renaming, and the old target goes only when that has worked.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import json_text
from ..operators.audit import passed


def with_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """The columns of a contract in its order; those that the data lacks are null, with their documentation."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in contract.fields])


def write(tables: dict[str, DataFrame], target: str, *, checks: DataFrame | None = None, partitions: dict[str, list[str]] | None = None, contracts: dict[str, StructType] | None = None, json_arrays: dict[str, list[str]] | None = None, after_install: Callable[[], None] | None = None) -> None:
    """Install ``tables`` as the Parquet dataset ``target`` (a folder of a local or mounted file system).

    Tables named in ``contracts`` get the columns promised there, in their order; array columns in ``json_arrays`` become JSON texts.
    Failed checks, and an error of ``after_install``, leave the target as it was.
    """
    if checks is not None and not passed(checks):
        raise ValueError("checks failed: " + ", ".join(sorted(r.check for r in checks.where("not ok").collect())))
    if os.path.islink(target):
        raise ValueError(f"{target} is a link")
    target = os.path.abspath(target)
    mark = uuid.uuid4().hex[:12]
    stage, old = f"{target}.stage-{mark}", f"{target}.old-{mark}"
    try:
        for name, df in tables.items():
            df = with_contract(df, contracts[name]) if contracts and name in contracts else df
            df = export_json(df, json_arrays[name]) if json_arrays and name in json_arrays else df
            writer = df.write.option("compression", "zstd")
            if keys := (partitions or {}).get(name):
                writer = writer.partitionBy(*keys)
            writer.parquet(f"file://{stage}/{name}")
        _install(stage, target, old, after_install)
    finally:
        shutil.rmtree(stage, ignore_errors=True)


#: Buckets of a stored table; how a table is sorted within them, of these columns those that it has.
BUCKETS = 64
SORTED = ("version_id", "unit", "reading", "position", "witness", "div", "chapter", "label")


def store(tables: dict[str, DataFrame], prefix: str, *, folder: str | None = None, by: str = "version_id", buckets: int = BUCKETS) -> None:
    """Keep ``tables`` as tables ``prefix_name`` of the catalogue, in buckets by version where they have versions, with statistics.

    A question for one version then reads one bucket of each table. With ``spark.sql.requireAllClusterKeysForCoPartition`` off, joins
    by version and more meet bucket by bucket, without a shuffle. Files stand in ``folder``, or else in the warehouse.
    """
    for name, df in tables.items():
        order = [c for c in SORTED if c in df.columns]
        if by in df.columns:
            writer = df.repartition(buckets, by).write.bucketBy(buckets, by).sortBy(*order)
        else:
            writer = df.write
        writer = writer.mode("overwrite").format("parquet").option("compression", "zstd")
        table = f"{prefix}_{name}"
        (writer.option("path", f"{folder}/{name}") if folder else writer).saveAsTable(table)
        df.sparkSession.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(order)}" if order else f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def _install(stage: str, target: str, old: str, after_install: Callable[[], None] | None) -> None:
    had = os.path.exists(target)
    if had:
        os.rename(target, old)
    try:
        os.rename(stage, target)
        if after_install:
            after_install()
    except BaseException:
        # what is there decides what to undo: an interrupt may come between the steps
        if had and os.path.exists(old):
            if os.path.exists(target):
                shutil.rmtree(target)
            os.rename(old, target)
        elif not had and os.path.exists(target):
            shutil.rmtree(target)
        raise
    shutil.rmtree(old, ignore_errors=True)


def overlay(table: DataFrame, base: str, target: str, *, accept_noncommercial: bool) -> None:
    """A table beside a dataset under terms of its own: never inside it, never over something else."""
    if not accept_noncommercial:
        raise ValueError("the source's noncommercial terms must be accepted")
    base_, own = os.path.realpath(base), os.path.realpath(target)
    if own == base_ or own.startswith(base_ + os.sep) or base_.startswith(own + os.sep):
        raise ValueError(f"{target} lies within {base} or holds it")
    table.write.mode("errorifexists").parquet(f"file://{own}")


def report_path(path: str, dataset: str) -> str:
    """``path`` if a report there can't damage the dataset: outside of it, no link, no second name of a file."""
    own, inside = os.path.realpath(path), os.path.realpath(dataset)
    if own == inside or own.startswith(inside + os.sep):
        raise ValueError(f"{path} lies within the dataset")
    if os.path.islink(path) or (os.path.exists(path) and os.stat(path).st_nlink > 1):
        raise ValueError(f"{path} is a link or has a second name")
    return own


def report(checks: DataFrame, counts: DataFrame, path: str, **more: object) -> dict:
    """Write the result of an audit as JSON with sorted keys; returns it."""
    results = {r.check: bool(r.ok) for r in checks.collect()}
    out = {"status": "passed" if results and all(results.values()) else "failed", "failed_checks": sorted(k for k, ok in results.items() if not ok), "checks": results, "counts": {r[0]: r[1] for r in counts.collect()}, **more}
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(out, ensure_ascii=False, indent=2, sort_keys=True) + "\n")
    return out


def dictionary(tables: dict[str, StructType], describe: Callable[[str, str], str] = lambda t, c: "") -> str:
    """The data dictionary as Markdown, from schemas alone."""
    parts = ["# Data dictionary", ""]
    for name in sorted(tables):
        parts += [f"## {name}", "", "| column | type | description |", "| --- | --- | --- |"]
        parts += [f"| {f.name} | {f.dataType.simpleString()} | {f.metadata.get('description') or describe(name, f.name)} |" for f in tables[name].fields]
        parts.append("")
    return "\n".join(parts)


def check_dictionary(path: str, tables: dict[str, StructType]) -> None:
    with open(path, encoding="utf-8") as f:
        if f.read() != dictionary(tables):
            raise ValueError(f"{path} is out of date")


def export_json(df: DataFrame, arrays: Iterable[str]) -> DataFrame:
    """Array columns as JSON texts with ``, `` between, as Python writes them."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def encoded(values):
        return values.map(lambda x: json_text(list(x)), na_action="ignore")

    return df.withColumns({c: encoded(c) for c in arrays})
