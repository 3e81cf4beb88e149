"""Saved labels, versioned model directories and the run log."""

from __future__ import annotations

import json
import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.sources.tables import literal_rows, read_record, require_path, write_record


def save_labels(spark: SparkSession, labels: list[str], path: str) -> None:
    """``{"classes": [...]}`` in code order."""
    write_record(spark, {"classes": list(labels)}, path)


def load_labels(spark: SparkSession, path: str) -> list[str]:
    return list(read_record(spark, path)["classes"])


def model_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions are the ``v=N`` directories below ``root`` that hold a manifest."""
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(f"{root}/v=*/manifest")
            .select(F.regexp_extract("path", r"/v=(\d+)/manifest/", 1).cast("int").alias("v"))
        )
        return sorted(r.v for r in listing.distinct().collect())
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise


def version_path(spark: SparkSession, root: str, version: str | int = "latest") -> str:
    versions = model_versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"no model version below {root}")
    wanted = versions[-1] if version == "latest" else int(re.sub(r"^v=", "", str(version)))
    if wanted not in versions:
        raise FileNotFoundError(f"version {wanted} not among {versions} below {root}")
    return f"{root}/v={wanted}"


def next_version_path(spark: SparkSession, root: str) -> str:
    versions = model_versions(spark, root)
    return f"{root}/v={(versions[-1] + 1) if versions else 1}"


def signature(inputs: DataFrame, outputs: DataFrame, example_rows: int = 3) -> dict:
    """Input and output schema with a short input example, stored beside a model."""
    example = inputs.limit(example_rows).toPandas()
    return {
        "inputs": inputs.schema.json(),
        "outputs": outputs.schema.json(),
        "example": example.to_json(orient="records", date_format="iso"),
    }


def log_run(spark: SparkSession, path: str, run_id: str, **kinds: dict) -> None:
    """Append (run_id, kind, key, value, ts) rows; values are kept as JSON text.

    One write per call. Calls for the same path come from one thread, since concurrent appends
    to one directory would clear each other's temporary files.
    """
    now = datetime.now(timezone.utc).isoformat()
    names = {"run_id": "string", "kind": "string", "key": "string", "value": "string", "ts": "string"}
    entries = [
        (run_id, kind, str(key), json.dumps(value), now) for kind, values in kinds.items() for key, value in values.items()
    ]
    if entries:
        literal_rows(spark, names, entries).coalesce(1).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    require_path(spark, path)
    return spark.read.parquet(path)
