"""Tables of parts that are replaced part by part.

A part is a folder of Parquet files below ``generation=<n>``; a manifest names the
generation that is valid for each part.  ``replace`` writes the new parts first
and renames the next manifest into place, so readers see all of them or none, and a
call that was lost on the way leaves files that nobody reads.  One writer at a time.
The manifest has one entry a part: keep their number bounded (buckets, days).
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession

from forecourt.session import drop_scratch, list_names, publish_text, read_text


def current(spark: SparkSession, root: str) -> dict:
    """{"version": n, "parts": {name: generation}}"""
    versions = [int(n) for n in list_names(spark, os.path.join(root, "manifest")) if n.isdigit()]
    if not versions:
        return {"version": 0, "parts": {}}
    return json.loads(read_text(spark, os.path.join(root, "manifest", str(max(versions)))))


def read(spark: SparkSession, root: str, column: str, names: list | None = None) -> DataFrame | None:
    """All parts, or those of ``names``; None if there is none."""
    parts = current(spark, root)["parts"]
    wanted = parts if names is None else {str(n): parts[str(n)] for n in names if str(n) in parts}
    paths = [os.path.join(root, f"generation={g}", f"{column}={n}") for n, g in wanted.items()]
    return spark.read.option("basePath", root).parquet(*paths).drop("generation") if paths else None


def replace(spark: SparkSession, root: str, rows: DataFrame, column: str, names: list) -> dict:
    """Make ``rows`` (with ``column``) the whole of the parts ``names``."""
    before = current(spark, root)
    version = before["version"] + 1
    folder = os.path.join(root, f"generation={version}")
    rows.write.mode("overwrite").partitionBy(column).parquet(folder)
    written = {n.partition("=")[2] for n in list_names(spark, folder) if n.startswith(f"{column}=")}
    parts = {n: g for n, g in before["parts"].items() if n not in set(map(str, names))}
    now = {"version": version, "parts": {**parts, **dict.fromkeys(sorted(written), version)}}
    publish_text(spark, json.dumps(now), os.path.join(root, "manifest", str(version)))
    for old in sorted(set(before["parts"].values())):  # what no reader of the new manifest needs
        for name in list_names(spark, os.path.join(root, f"generation={old}")):
            if "=" in name and now["parts"].get(name.partition("=")[2]) != old:
                drop_scratch(spark, os.path.join(root, f"generation={old}", name))
    drop_scratch(spark, os.path.join(root, "manifest", str(before["version"])))
    return now
