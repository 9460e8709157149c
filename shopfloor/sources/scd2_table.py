"""Reading a dimension that a stream keeps in a versioned table: its open
versions in parts by bucket, its closed versions in runs (T4)."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .versions import Manifest, VersionedTable

#: The folder level of every part and run.
BUCKET = "_bucket"

#: Of each version: the build of its key. Of open ones: the key's last sequence number.
BUILD, LAST = "_build", "_last"


def _schema(held: Manifest) -> T.StructType:
    return T.StructType.fromJson(json.loads(held.info["schema"]))


def _open_rows(table: VersionedTable, held: Manifest) -> DataFrame:
    return table.read(sorted(held.parts.values()), _schema(held))


def closed_rows(table: VersionedTable, held: Manifest, folders: list[str]) -> DataFrame:
    """Closed versions in some runs that are of their key's last build."""
    schema, keys = _schema(held), held.info["keys"]
    current = _open_rows(table, held).select(*keys, BUILD)
    return table.read(folders, schema, BUCKET).join(current, [*keys, BUILD], "left_semi").select(schema.fieldNames())


def open_versions(table: VersionedTable) -> DataFrame:
    """V1-V3: the open versions; the history is not read."""
    return _open_rows(table, table.manifest()).drop(BUILD, LAST)


def history(table: VersionedTable) -> DataFrame:
    """H1-H3: all versions."""
    held = table.manifest()
    runs = [folder for folder, _ in held.runs.get("closed", [])]
    parts = [_open_rows(table, held), *([closed_rows(table, held, runs)] if runs else [])]
    return reduce(DataFrame.unionByName, parts).drop(BUILD, LAST)


def history_sql(table: VersionedTable) -> str:
    """H1-H3 as SQL text over the folders that the manifest names now, for views
    that outlive a session's DataFrames."""
    held = table.manifest()
    cols = ", ".join(f"`{n}`" for n in _schema(held).fieldNames() if n not in (BUILD, LAST))
    keys = " AND ".join(f"c.`{k}` = o.`{k}`" for k in [*held.info["keys"], BUILD])
    every_open = " UNION ALL ".join(f"SELECT {cols}, `{BUILD}` FROM parquet.`{table.location(f)}`" for f in sorted(held.parts.values()))
    parts = [f"SELECT {cols} FROM open"]
    for folder, _ in held.runs.get("closed", []):
        parts.append(f"SELECT {cols} FROM parquet.`{table.location(folder)}` c WHERE EXISTS (SELECT 1 FROM open o WHERE {keys})")
    return f"WITH open AS ({every_open}) {' UNION ALL '.join(parts)}"
