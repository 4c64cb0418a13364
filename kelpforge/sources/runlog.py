"""Records of a run: metrics of stages across resumes, reports, and digests of model folders."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Suffixes of the files that make up a model, and of those its weights.
MODEL_FILES = (".bin", ".jinja", ".json", ".model", ".safetensors", ".txt")
WEIGHTS = (".bin", ".safetensors")


class StageLog:
    """Metrics of stages as appended rows: a resumed stage adds to what it counted before."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, stage: str, **metrics: float) -> None:
        rows = [(stage, k, float(v)) for k, v in metrics.items()]
        self.spark.createDataFrame(rows, "stage string, metric string, value double").coalesce(1).write.mode("append").parquet(self.path)

    def totals(self) -> DataFrame:
        """(stage, metric, value), summed over all runs; the null stage is the sum of stages."""
        rows = self.spark.read.parquet(self.path)
        return rows.groupingSets([["stage", "metric"], ["metric"]], "stage", "metric").agg(F.sum("value").alias("value"))


def markdown(title: str, tables: Mapping[str, DataFrame], rows: int = 1000) -> str:
    """A report of aggregated tables; one longer than ``rows`` says how many it leaves out."""
    out = [f"# {title}"]
    for name, df in tables.items():
        head = df.limit(rows).collect()
        cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
        lines = ["| " + " | ".join(r) + " |" for r in (df.columns, ["-"] * len(df.columns), *([cell(v) for v in r] for r in head))]
        more = df.count() - len(head) if len(head) == rows else 0
        out += [f"## {name}", "\n".join(lines), *([f"{more} more rows"] if more else [])]
    return "\n\n".join(out) + "\n"


def write_json(path: str | Path, value: Any) -> None:
    """A small value as JSON with sorted keys; readers see the old file or the new one."""
    at = Path(path)
    part = at.with_name(f".{at.name}.part")
    part.write_text(json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2) + "\n", encoding="utf-8")
    part.replace(at)


def model_identity(model: str, revision: str | None = None) -> dict[str, Any]:
    """What binds results to a model: the digests of a folder's files, or a name and a fixed
    revision. An adapter's folder isn't a model, and a folder needs weights."""
    root = Path(model)
    if not root.is_dir():
        if not re.fullmatch("[0-9a-fA-F]{40}", revision or ""):
            raise ValueError("a remote model needs a revision of 40 hex digits")
        return {"model": model, "revision": revision}
    if (root / "adapter_config.json").exists():
        raise ValueError(f"{model} holds an adapter, not a merged model")
    files = [p for p in sorted(root.rglob("*")) if p.is_file() and p.suffix in MODEL_FILES]
    if not any(p.suffix in WEIGHTS for p in files):
        raise ValueError(f"{model} holds no weights")
    return {"path": str(root.resolve()), "files": {str(p.relative_to(root)): _sha256(p) for p in files}}


def adapter_identity(folder: str) -> dict[str, Any]:
    """The digests of an adapter's two files, and its rank."""
    root = Path(folder)
    files = [root / "adapter_config.json", root / "adapter_model.safetensors"]
    if not all(p.is_file() for p in files):
        raise ValueError(f"{folder} isn't an adapter")
    return {"path": str(root.resolve()), "rank": json.loads(files[0].read_text()).get("r"), "files": {p.name: _sha256(p) for p in files}}


def _sha256(path: Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
