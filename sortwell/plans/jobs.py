"""The curation jobs from end to end: metadata, dataset audit, near-duplicate audit, splits,
training and evaluation batches."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortwell.operators import rules
from sortwell.operators.batches import assign_batches
from sortwell.operators.clusters import near_dup_clusters
from sortwell.operators.duplicates import exact_duplicates, hash_groups
from sortwell.operators.neardup import Blocks, near_dup_leakage, near_dup_summary, near_duplicates, sort_pairs
from sortwell.operators.pixels import ImageOptions, augmentation_plan, image_hash64, preprocess_eval
from sortwell.operators.profile import (
    audit_summary, class_percentages, dimension_stats, format_counts, top_combinations,
)
from sortwell.operators.project import canonicalise, encode_labels, with_provenance
from sortwell.operators.reconcile import attach_file_metadata, extra_files, missing_refs
from sortwell.operators.split import check_splits, stratified_group_split, stratified_split
from sortwell.session import one_row, settled
from sortwell.sources.images import decode_images, image_integrity
from sortwell.sources.tables import (
    METADATA_SCHEMA, dataset_registry, label_registry, one_split, scan_manifest,
)

# Class vocabulary in index order, as the source labels 0 to 4 map to it.
LEAF_CLASSES = [
    "cassava_bacterial_blight",
    "cassava_brown_streak_disease",
    "cassava_green_mottle",
    "cassava_mosaic_disease",
    "healthy",
]

# Provenance of the leaf manifest.
LEAF_PROVENANCE = {
    "source_dataset": "kaggle_cassava_leaf_disease_classification",
    "crop": "cassava",
    "country": "Uganda",
    "region": None,
    "collection_type": "field",
}

# Fields every dataset record must have.
REGISTRY_FIELDS = [
    "source_dataset", "source_host", "source_url", "original_owner", "country",
    "annotation_source", "source_license", "license_status", "provenance_status",
]


@dataclass(frozen=True)
class Curation:
    """What a manifest's labels and origin mean; defaults describe the leaf manifest."""

    classes: list[str] = field(default_factory=lambda: list(LEAF_CLASSES))
    provenance: dict[str, object] = field(default_factory=lambda: dict(LEAF_PROVENANCE))


def build_metadata(manifest: DataFrame, files: DataFrame, curation: Curation = Curation()) -> DataFrame:
    """Canonical 12-column metadata from (image_id, label) and one integrity row per file."""
    headers = files.where("header_ok").select(
        F.col("key").alias("image_id"), "width", "height", "format",
        F.col("header_ok").alias("verified"),
    )
    labelled = canonicalise(
        manifest.withColumnRenamed("label", "source_label"), "source_label",
        dict(enumerate(curation.classes)),
    )
    joined = attach_file_metadata(with_provenance(labelled, curation.provenance), headers, key="image_id")
    names = [part.split()[0] for part in METADATA_SCHEMA.split(", ")]
    return joined.select(*names)


def metadata_rules(metadata: DataFrame, curation: Curation = Curation(), n_rows: int | None = None) -> list[rules.Rule]:
    """The data contract of canonical metadata; `n_rows` adds the expected record count."""
    origin = curation.provenance
    names = [part.split()[0] for part in METADATA_SCHEMA.split(", ")]
    return [
        rules.required_columns(metadata, names),
        rules.not_null("canonical_label"),
        rules.not_null("crop"),
        *([rules.row_count(n_rows)] if n_rows is not None else []),
        rules.single_value("source_dataset", origin["source_dataset"]),
        rules.single_value("crop", origin["crop"]),
        rules.single_value("country", origin["country"], ignore_nulls=True),
        rules.vocabulary("canonical_label", curation.classes),
        rules.vocabulary("source_label", list(range(len(curation.classes)))),
        rules.all_true("verified"),
    ]


def metadata_report(metadata: DataFrame, curation: Curation = Curation(), n_rows: int | None = None) -> DataFrame:
    """All contract results: rules folded into one scan, plus key uniqueness."""
    contract = rules.validation_report(metadata, metadata_rules(metadata, curation, n_rows)).drop("seq")
    return contract.unionByName(rules.unique_key(metadata, "image_id"))


def registry_report(
    spark: SparkSession, dataset_config: str, label_config: str, dataset_key: str,
    curation: Curation = Curation(),
) -> DataFrame:
    """The dataset is registered with all required fields, and the registered labels of the crop
    are the class vocabulary."""
    record = dataset_registry(spark, dataset_config).where(F.col("dataset_key") == dataset_key)
    labels = label_registry(spark, label_config).where(F.col("crop") == curation.provenance["crop"])
    return (
        rules.check(record, rules.row_count(1))
        .unionByName(rules.required_fields(record, "record", REGISTRY_FIELDS))
        .unionByName(rules.check(labels, rules.vocabulary("label", curation.classes)))
    )


def audit_dataset(spark: SparkSession, manifest_path: str, image_dirs: list[str]) -> dict[str, DataFrame]:
    """Every table of the dataset audit. Files are decoded once; all tables read that result."""
    manifest = scan_manifest(spark, manifest_path)
    files = settled(image_integrity(spark, image_dirs))
    by_id = files.withColumnRenamed("key", "image_id")
    readable = by_id.where("decode_ok")
    ids = manifest.select("image_id").distinct()
    existing = by_id.join(ids, "image_id", "left_semi")
    return {
        "missing": missing_refs(manifest, by_id, key="image_id"),
        "extra": extra_files(manifest, by_id, key="image_id"),
        "classes": class_percentages(manifest, "label"),
        "unreadable": by_id.where(~F.col("decode_ok")).select("image_id", "error"),
        "formats": format_counts(by_id, readable=F.col("decode_ok")),
        "dimensions": dimension_stats(readable),
        "top_dimensions": top_combinations(readable),
        "duplicates": exact_duplicates(existing, key="image_id", digest="digest"),
        "summary": audit_summary(
            manifest, by_id, key="image_id", digest="digest", readable=F.col("decode_ok"),
            dimensions=("width", "height"), dimension_files=readable,
        ),
    }


def audit_near_duplicates(
    spark: SparkSession, metadata: DataFrame, image_dirs: list[str], *, max_distance: int = 5,
    bands: str | Blocks = "auto", splits: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Hashes of the listed images and every table made of them. Images are decoded once.

    `splits` (image_id, split) adds the near duplicates that straddle two splits. Candidates call
    for a look at the pictures; nothing is removed here. `clusters` can be handed to `split_metadata`.
    """
    images = decode_images(spark, image_dirs).withColumnRenamed("key", "image_id")
    hashes = settled(
        metadata.select("image_id").join(image_hash64(images, key="image_id"), "image_id", "left")
    )
    named = {"key": "image_id", "hash_col": "hash"}
    how = {**named, "max_distance": max_distance, "bands": bands}
    unhashed = hashes.agg(F.count_if(F.col("hash").isNull()).alias("n_unhashed"))
    found = {
        "hashes": hashes,
        "groups": hash_groups(hashes, **named),
        "pairs": sort_pairs(near_duplicates(hashes, **how)),
        "clusters": near_dup_clusters(hashes, **how),
        "summary": one_row(near_dup_summary(hashes, **how), unhashed),
    }
    if splits is not None:
        found["leakage"] = near_dup_leakage(hashes, splits, **how)
    return found


def split_metadata(
    metadata: DataFrame, ratios: tuple = (70, 15, 15), seed: int = 42, clusters: DataFrame | None = None
) -> DataFrame:
    """Metadata with a checked `split` column, stratified by canonical label.

    With `clusters` (image_id, cluster; from the near-duplicate audit) no cluster is cut, so no near
    duplicates straddle two splits; sizes then deviate by less than one cluster per class and split.
    """
    named = {"key": "image_id", "label": "canonical_label", "ratios": ratios, "seed": seed}
    if clusters is None:
        splits = stratified_split(metadata, **named)
    else:
        of = clusters.select("image_id", F.col("cluster").alias("_cluster"))
        splits = stratified_group_split(metadata.join(of, "image_id", "left"), group="_cluster", **named).drop("_cluster")
    check_splits(splits, key="image_id")
    return splits


def evaluation_batches(
    splits: DataFrame, images: DataFrame, *, split: str, batch_size: int = 32,
    files: DataFrame | None = None, curation: Curation = Curation(),
    options: ImageOptions = ImageOptions(),
) -> DataFrame:
    """image_id, label, vec, position and batch_id of an evaluation split.

    Batches are dealt on keys; the long vectors are made last and never shuffled.
    """
    rows = encode_labels(one_split(splits, split), "canonical_label", curation.classes, out="label")
    rules.enforce(rules.check(rows, rules.label_range("label", len(curation.classes))))
    placed = rows.select("image_id", "label").join(
        assign_batches(rows, key="image_id", batch_size=batch_size), "image_id"
    )
    return preprocess_eval(
        placed, images.withColumnRenamed("key", "image_id"), split=split, key="image_id",
        files=None if files is None else files.select(F.col("key").alias("image_id")), options=options,
    )


def training_batches(
    splits: DataFrame, *, epoch: int = 0, seed: int = 42, batch_size: int = 32,
    curation: Curation = Curation(), options: ImageOptions = ImageOptions(),
) -> DataFrame:
    """image_id, label, position, batch_id and augmentation draws of one training epoch.

    Every epoch has its own order and its own draws, both reproducible.
    """
    rows = encode_labels(one_split(splits, "train"), "canonical_label", curation.classes, out="label")
    rules.enforce(rules.check(rows, rules.label_range("label", len(curation.classes))))
    placed = rows.select("image_id", "label").join(
        assign_batches(
            rows, key="image_id", batch_size=batch_size, shuffle=True, seed=seed, epoch=epoch
        ),
        "image_id",
    )
    return augmentation_plan(placed, key="image_id", seed=seed, epoch=epoch, options=options)


def validate_batches(
    batches: DataFrame, *, expected_rows: int, batch_size: int = 32, curation: Curation = Curation(),
    options: ImageOptions = ImageOptions(),
) -> DataFrame:
    """Report on the output of `evaluation_batches`: size, type, shape, finite values, label range,
    every class covered, and full batches but the last. One scan of the rows and one of the batches.
    """
    classes = range(len(curation.classes))
    of_rows = rules.validation_report(batches, [
        rules.row_count(expected_rows),
        rules.column_type(batches, "vec", "float"),
        rules.column_type(batches, "label", "int"),
        rules.vector_shape("vec", (3, options.size, options.size)),
        rules.finite("vec"),
        rules.label_range("label", len(curation.classes)),
        rules.vocabulary("label", list(classes)),
        rules.not_null("batch_id"),
    ])
    full, rest = divmod(expected_rows, batch_size)
    sizes = batches.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    due = F.when(F.col("batch_id").between(0, full - 1), batch_size).when(F.col("batch_id") == full, rest).otherwise(0)
    of_batches = rules.validation_report(
        sizes.withColumn("full_batches", F.col("n") == due),
        [rules.row_count(full + (rest > 0)), rules.all_true("full_batches")],
    )
    of_batches = of_batches.withColumn("rule", F.when(F.col("seq") == 1, "batch_count").otherwise(F.col("rule")))
    return of_rows.drop("seq").unionByName(of_batches.drop("seq"))
