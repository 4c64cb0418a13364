"""Sinks and resumable state: output policy, keyed append store, config digests."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, fields
from hashlib import sha256
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpforge.operators.checks import IntegrityError, pending


def digest(value: Any) -> str:
    """SHA-256 of the canonical JSON of a small value."""
    return "sha256:" + sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


@dataclass(frozen=True)
class RunConfig:
    """Settings of a build; unknown names are errors, and the digest binds outputs to them."""

    seed: int = 42
    target: int = 1500
    timeout_seconds: float = 3.0
    memory_mb: int = 512
    io_bytes: int = 65_536
    difficulty: tuple[tuple[str, float], ...] = (("introductory", 0.25), ("interview", 0.45), ("competition", 0.30))

    @classmethod
    def load(cls, values: dict[str, Any]) -> RunConfig:
        if unknown := set(values) - {f.name for f in fields(cls)}:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        out = cls(**values)
        if abs(sum(r for _, r in out.difficulty) - 1) > 1e-6 or out.target <= 0:
            raise ValueError("shares must add up to 1 and the target be positive")
        return out

    @property
    def digest(self) -> str:
        return digest(asdict(self))


def write_table(df: DataFrame, path: str, resume: bool = False, overwrite: bool = False, form: str = "parquet") -> None:
    """Writes a table; a path that holds data needs one of ``resume`` (append) and ``overwrite``."""
    if resume and overwrite:
        raise ValueError("resume and overwrite exclude each other")
    df.write.mode("append" if resume else "overwrite" if overwrite else "errorifexists").format(form).save(path)


class KeyedStore:
    """Payloads by key under one config digest: Parquet, appended once per stage.

    A key that comes again with the same payload changes nothing; with another payload it is
    an error. Another digest sees none of the rows. The committer makes each append atomic, so
    nothing can be torn.
    """

    def __init__(self, spark: SparkSession, path: str, config_digest: str):
        self.spark, self.path, self.digest = spark, path, config_digest

    def rows(self) -> DataFrame:
        """(key, payload) of this digest."""
        schema = "key string, payload string, payload_hash string, run string, config_hash string"
        try:
            found = self.spark.read.schema(schema).parquet(self.path)
            found.schema
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            found = self.spark.createDataFrame([], schema)
        return found.where(F.col("config_hash") == self.digest)

    def todo(self, rows: DataFrame, key: str = "key") -> DataFrame:
        """Rows whose key isn't stored yet."""
        return pending(rows, self.rows().select(F.col("key").alias(key)), key)

    def append(self, rows: DataFrame) -> None:
        """Stores (key, payload)."""
        new = rows.select("key", "payload", F.sha2("payload", 256).alias("payload_hash"))
        both = new.select("key", "payload_hash").unionByName(self.rows().select("key", "payload_hash"))
        clash = both.groupBy("key").agg(F.countDistinct("payload_hash").alias("n")).where("n > 1").limit(3).collect()
        if clash:
            raise IntegrityError(f"keys with another payload: {[r[0] for r in clash]}")
        fresh = self.todo(new.dropDuplicates(["key"])).withColumn("run", F.lit(uuid.uuid4().hex)).withColumn("config_hash", F.lit(self.digest))
        fresh.write.mode("append").partitionBy("config_hash").parquet(self.path)


def sharegpt(prefixes: DataFrame, system: str, tools: str) -> DataFrame:
    """(sample_id, system, tools, conversations) of prefixes (sample_id, history, target)."""
    turn = lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value"))
    return prefixes.select("sample_id", F.lit(system).alias("system"), F.lit(tools).alias("tools"), F.concat(F.transform("history", turn), F.array(F.struct(F.lit("function_call").alias("from"), F.col("target").alias("value")))).alias("conversations"))


def write_splits(df: DataFrame, split: str, root: str, form: str = "json") -> None:
    """One folder per split in a single pass, each row's split being its partition."""
    df.write.mode("errorifexists").partitionBy(split).format(form).save(root)
