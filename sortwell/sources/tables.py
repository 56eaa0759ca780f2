"""Manifests, label maps, registries and split tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortwell.operators.split import SPLITS
from sortwell.session import small_table

MANIFEST_SCHEMA = "image_id string, label int"

METADATA_SCHEMA = (
    "image_id string, source_dataset string, source_label int, canonical_label string, "
    "crop string, country string, region string, collection_type string, "
    "width int, height int, format string, verified boolean"
)


def scan_manifest(spark: SparkSession, path: str, schema: str = MANIFEST_SCHEMA) -> DataFrame:
    """CSV with a header. A missing path, or a value that does not fit, is an error."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    return reader.csv(path)


CORRUPT = "_corrupt"


def read_manifest(spark: SparkSession, path: str, schema: str = MANIFEST_SCHEMA, *, header: bool = True) -> DataFrame:
    """One read of a CSV: the columns of `schema`, and `_file`, `_line` and `_reason` of rows that don't fit.

    These three are null for good rows. The reason names the first column whose text is not of its type,
    or the number of fields. Empty lines are passed over, and with `header` lines that name the columns; a
    header with other names is a row that doesn't fit. A record is one line.
    """
    typed = T.StructType.fromDDL(schema)
    columns = [f.name for f in typed]
    lines = spark.read.text(path).select(F.col("value"), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
    passed_over = ["", ",".join(columns)] if header else [""]
    lines = lines.where(~F.trim("value").isin(*passed_over))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    fields = F.from_csv("value", ", ".join(f"f{i} string" for i in range(len(columns) + 1)))
    parsed = lines.select("value", "file", F.from_csv("value", f"{schema}, {CORRUPT} string", options).alias("r"), fields.alias("t"))
    reason = F.when(F.col(f"t.f{len(columns)}").isNotNull(), F.lit("too many fields"))
    for i, f in enumerate(typed):
        text = F.col(f"t.f{i}")
        wrong = text.isNotNull() & text.try_cast(f.dataType).isNull()
        reason = reason.when(wrong, F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), text))
    bad = F.col(f"r.{CORRUPT}").isNotNull()
    return parsed.select(
        *[F.when(~bad, F.col(f"r.{c}")).alias(c) for c in columns],
        F.when(bad, F.col("file")).alias("_file"), F.when(bad, F.col("value")).alias("_line"),
        F.when(bad, reason.otherwise(F.lit("too few fields"))).alias("_reason"),
    )


def good_rows(read: DataFrame) -> DataFrame:
    """The rows of `read_manifest` that fit the schema."""
    return read.where(F.col("_line").isNull()).drop("_file", "_line", "_reason")


def manifest_rejects(read: DataFrame) -> DataFrame:
    """file, line and reason of the rows that don't; the good ones are not lost with them."""
    return read.where(F.col("_line").isNotNull()).select(
        F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason")
    )


def parse_label_map(df: DataFrame, json_col: str) -> DataFrame:
    """JSON objects with integer-like keys to rows (source_label, name)."""
    entries = F.from_json(F.col(json_col), "map<string,string>")
    return df.select(F.explode(entries).alias("source_label", "name")).withColumn(
        "source_label", F.col("source_label").cast("int")
    )


def load_label_map(spark: SparkSession, path: str) -> DataFrame:
    """One JSON file, in numeric key order; an absent file gives an empty table."""
    if not _exists(spark, path):
        return small_table(spark, [], "source_label int, name string")
    text = spark.read.text(path, wholetext=True)
    return parse_label_map(text, "value").orderBy("source_label")


def _exists(spark: SparkSession, pattern: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hadoop_path))


def _read_config(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        if path.endswith((".yaml", ".yml")):
            import yaml

            return yaml.safe_load(file)
        return json.load(file)


def label_registry_rows(config: dict) -> list[dict]:
    """Nested crop → disease records as flat rows."""
    return [
        {"crop": crop, "label": label, **record}
        for crop, body in (config.get("crops") or {}).items()
        for label, record in (body.get("diseases") or {}).items()
    ]


def label_registry(spark: SparkSession, path: str) -> DataFrame:
    names = ["crop", "label", "display_name", "abbreviation", "category"]
    rows = [tuple(r.get(n) for n in names) for r in label_registry_rows(_read_config(path))]
    return small_table(spark, rows, ", ".join(f"{n} string" for n in names))


REGISTRY_SCHEMA = (
    "dataset_key string, source_dataset string, source_host string, source_url string, "
    "original_owner array<string>, country string, annotation_source string, source_license string, "
    "license_status string, provenance_status string, citation_required boolean"
)


def dataset_registry(spark: SparkSession, path: str) -> DataFrame:
    """One row per dataset: typed columns, null where a field is absent, and the record as JSON in
    `record`, ready for `rules.required_fields`. A single owner becomes a list of one."""
    records = _read_config(path).get("datasets") or {}
    schema = T.StructType.fromDDL(REGISTRY_SCHEMA)

    def typed(key: str, body: dict, field: T.StructField):
        value = key if field.name == "dataset_key" else body.get(field.name)
        if value is None:
            return None
        if isinstance(field.dataType, T.ArrayType):
            return [str(v) for v in (value if isinstance(value, list) else [value])]
        if isinstance(field.dataType, T.BooleanType):
            if not isinstance(value, bool):
                raise ValueError(f"{key}: {field.name} is not true or false")
            return value
        return str(value)

    rows = [
        (*[typed(k, v or {}, f) for f in schema], json.dumps(v, ensure_ascii=False)) for k, v in records.items()
    ]
    return small_table(spark, rows, f"{REGISTRY_SCHEMA}, record string")


def registry_entries(spark: SparkSession, path: str, under: str = "datasets") -> DataFrame:
    """key, record (VARIANT) for each entry of the object `under` in JSON registry files.

    Records keep their own fields and types at any depth; `typed_registry` and `rules.field_types` ask the
    engine for them, and nothing is parsed in the driver.
    """
    files = spark.read.text(path, wholetext=True)
    return registry_rows(files, "value", under)


def registry_rows(df: DataFrame, json_col: str, under: str) -> DataFrame:
    """key, record (VARIANT) for each entry of the object `under` in JSON texts; others give no row."""
    whole = F.try_variant_get(F.try_parse_json(json_col), f"$.{under}", "map<string,variant>")
    return df.select(F.explode(whole).alias("key", "record"))


def typed_registry(entries: DataFrame, fields: dict[str, str]) -> DataFrame:
    """key and one typed column per field (its name may be a path, `a.b`); null where a record lacks the
    field or holds another type that does not fit."""
    return entries.select(
        "key", *[F.try_variant_get("record", f"$.{name}", kind).alias(name.replace(".", "_")) for name, kind in fields.items()]
    )


def registry_schema(entries: DataFrame) -> DataFrame:
    """One row: the schema that all records fit together, as DDL, from one aggregation."""
    return entries.agg(F.schema_of_variant_agg("record").alias("schema"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite `path`; CSV gets a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_splits(df: DataFrame, path: str, *, split: str = "split", fmt: str = "parquet") -> None:
    """One folder per split."""
    writer = df.write.mode("overwrite").partitionBy(split)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def one_split(df: DataFrame, split: str, *, column: str = "split") -> DataFrame:
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}")
    return df.where(F.col(column) == split)


def read_split(
    spark: SparkSession, path: str, split: str, *, fmt: str = "parquet", schema: str | None = None
) -> DataFrame:
    """Rows of one split as `write_splits` wrote it; only its folder is read.

    CSV needs the `schema` of the rows, without the split column; values that don't fit are errors.
    """
    if fmt == "csv":
        if schema is None:
            raise ValueError("a schema is needed to read CSV")
        reader = spark.read.schema(f"{schema}, split string").option("header", True).option("mode", "FAILFAST")
        return one_split(reader.csv(path), split)
    return one_split(spark.read.format(fmt).load(path), split)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan of few partitions enough of them for work that is heavy per row.

    A file is split at row groups only, so a few small files keep most cores idle. An input with at
    least one partition per core is left as it is: nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
