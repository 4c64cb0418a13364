"""JSON-lines scans with reject reasons, strict record parsing, and digests of inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpforge.functions.text import ordered_reason, strip


def read_strict(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A JSONL file whose every line must fit the schema."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A file that is one JSON array of objects."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line, record, reason): every non-blank line with its number from 1.

    ``reason``: invalid_json or record_not_object. Numbers need whole files in order: each file
    is split by nothing but its lines, numbered inside the file's own array, so a file is the
    unit of parallelism. Use ``scan_records`` where numbers aren't needed.
    """
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n", -1)).alias("p", "line"))
    return _judge(whole.select("file", (F.col("p") + 1).alias("line_no"), "line"))


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, record, reason) without line numbers; files are split freely."""
    return _judge(spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line")))


def _judge(lines: DataFrame) -> DataFrame:
    v = F.try_parse_json("line")
    kind = F.schema_of_variant(v)
    reason = ordered_reason(("invalid_json", v.isNull()), ("record_not_object", ~F.startswith(kind, F.lit("OBJECT"))))
    return lines.where(strip("line") != "").withColumn("record", v).withColumn("reason", reason)


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def parse_problems(lines: DataFrame) -> DataFrame:
    """Problem records: the fields, and the first ``reason`` to reject (null: accepted).

    ``solutions`` and ``input_output`` are JSON inside a string and are decoded again; an id may
    be a number or a string, under ``id`` or ``problem_id``. The order of the rules decides
    which reason is reported.
    """
    r = F.col("record")
    get = lambda path, t: F.try_variant_get(r, path, t)
    part = lambda path: F.try_variant_get(r, path, "variant")
    ids = F.coalesce(part("$.id"), part("$.problem_id"))
    id_ok = _kind(ids).isin("BIGINT", "STRING")
    sol, io = F.try_parse_json(get("$.solutions", "string")), F.try_parse_json(get("$.input_output", "string"))
    text_or_none = lambda path: _kind(part(path)).isin("STRING", "VOID")
    sols = F.try_variant_get(sol, "$", "array<string>")
    inputs, outputs = F.try_variant_get(io, "$.inputs", "array<variant>"), F.try_variant_get(io, "$.outputs", "array<variant>")
    fn = F.try_variant_get(io, "$.fn_name", "variant")
    blank = lambda c: F.coalesce(strip(c) == "", F.lit(True))
    base = lines.withColumn("_in", inputs).withColumn("_out", outputs)
    reason = F.coalesce(
        F.col("reason"),
        ordered_reason(
            ("missing_id", ~id_ok | blank(F.try_variant_get(ids, "$", "string"))),
            ("empty_question", (_kind(part("$.question")) != "STRING") | blank(get("$.question", "string"))),
            ("invalid_difficulty", ~F.coalesce(get("$.difficulty", "string").isin("introductory", "interview", "competition"), F.lit(False))),
            ("invalid_starter_code", ~text_or_none("$.starter_code")),
            ("invalid_url", ~text_or_none("$.url")),
            ("invalid_solutions_json", (_kind(part("$.solutions")) != "STRING") | sol.isNull()),
            ("invalid_input_output_json", (_kind(part("$.input_output")) != "STRING") | io.isNull()),
            ("invalid_solutions", sols.isNull() | (F.size(sols) == 0) | ~F.startswith(_kind(sol), F.lit("ARRAY<STRING"))),
            ("invalid_input_output", ~F.startswith(_kind(io), F.lit("OBJECT"))),
            ("invalid_tests", F.col("_in").isNull() | F.col("_out").isNull() | (F.size("_in") == 0) | (F.size("_in") != F.size("_out"))),
            ("invalid_fn_name", ~_kind(fn).isin("STRING", "VOID") | F.coalesce(~F.try_variant_get(fn, "$", "string").rlike(r"^[A-Za-z_]\w*$"), F.lit(False))),
        ),
    )
    return base.select(
        *[c for c in lines.columns if c not in ("record", "reason")],
        F.try_variant_get(ids, "$", "string").alias("id"),
        get("$.question", "string").alias("question"),
        get("$.difficulty", "string").alias("difficulty"),
        F.coalesce(get("$.starter_code", "string"), F.lit("")).alias("starter_code"),
        get("$.url", "string").alias("url"),
        get("$.split", "string").alias("split"),
        sols.alias("solutions"),
        F.transform("_in", lambda x: F.to_json(x)).alias("inputs"),
        F.transform("_out", lambda x: F.to_json(x)).alias("outputs"),
        F.try_variant_get(fn, "$", "string").alias("fn_name"),
        reason.alias("reason"),
    )


def public_private(problems: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The public fields and the private ones as two tables: graders alone read the second."""
    mode = F.when(F.col("fn_name").isNotNull(), "call").otherwise("stdin")
    public = problems.select("id", "question", "starter_code", "difficulty", mode.alias("io_mode"), "fn_name")
    return public, problems.select("id", "inputs", "outputs", "solutions")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of every file below a folder."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return f.select(F.col("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def tree_digest(digests: DataFrame) -> DataFrame:
    """One digest over the ordered inventory (one row a file)."""
    rows = F.sort_array(F.collect_list(F.concat_ws("\t", "path", "sha256", F.col("bytes").cast("string"))))
    return digests.agg(F.sha2(F.array_join(rows, "\n"), 256).alias("tree_sha256"))
