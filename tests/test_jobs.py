import json

import pytest
from conftest import rows
from images import blobs, png_bytes
from pyspark.sql import functions as F

from sortwell.operators import rules
from sortwell.operators.neardup import near_dup_leakage
from sortwell.plans import jobs
from sortwell.session import settled
from sortwell.sources import images, tables


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("dataset")
    (root / "train_images").mkdir()
    lines = ["image_id,label"]
    for i in range(40):
        picture = blobs(30 + i % 3, 40, seed=i // 2 * 2)  # neighbours are copies or crops
        (root / "train_images" / f"i{i:02d}.jpg").write_bytes(png_bytes(picture))
        lines.append(f"i{i:02d}.jpg,{i % 5}")
    (root / "train.csv").write_text("\n".join(lines) + "\n")
    return root


def test_manifest_to_batches(spark, dataset, tmp_path):
    dirs = [str(dataset / "train_images")]
    manifest = tables.scan_manifest(spark, str(dataset / "train.csv"))
    metadata = jobs.build_metadata(manifest, images.image_integrity(spark, dirs))
    assert metadata.columns == [c.split()[0] for c in tables.METADATA_SCHEMA.split(", ")]
    report = jobs.metadata_report(metadata, n_rows=40)
    assert all(r.passed for r in report.collect()) and report.count() == 11
    tables.write_table(metadata, str(tmp_path / "metadata"))
    metadata = spark.read.parquet(str(tmp_path / "metadata"))

    splits = jobs.split_metadata(metadata)
    tables.write_splits(splits, str(tmp_path / "splits"))
    splits = spark.read.parquet(str(tmp_path / "splits"))
    assert rows(splits.groupBy("split").count()) == [("test", 6), ("train", 28), ("validation", 6)]

    decoded = images.decode_images(spark, dirs)
    files = images.scan_image_files(spark, dirs)
    batch = jobs.evaluation_batches(splits, decoded, split="test", batch_size=4, files=files)
    assert rows(batch.groupBy("batch_id").count()) == [(0, 4), (1, 2)]
    checks = rules.validation_report(
        batch, [rules.vector_shape("vec", (3, 224, 224)), rules.finite("vec"), rules.label_range("label", 5), rules.column_type(batch, "vec", "float")]
    )
    assert all(r.passed for r in checks.collect())
    report = {r.rule: r.passed for r in jobs.validate_batches(batch, expected_rows=6, batch_size=4).collect()}
    failed = {rule for rule, passed in report.items() if not passed}
    missing = batch.select("label").distinct().count() < 5
    assert failed == ({"vocabulary:label"} if missing else set()) and "batch_sizes" not in failed
    short = {r.rule for r in jobs.validate_batches(batch, expected_rows=9, batch_size=4).collect() if not r.passed}
    assert {"row_count", "batch_count"} <= short


def test_report_names_what_failed(spark, dataset):
    manifest = tables.scan_manifest(spark, str(dataset / "train.csv"))
    extra = spark.createDataFrame([("lost.jpg", 1), ("i00.jpg", 0)], tables.MANIFEST_SCHEMA)
    files = images.image_integrity(spark, [str(dataset / "train_images")])
    metadata = jobs.build_metadata(manifest.unionByName(extra), files)
    failed = {r.rule for r in jobs.metadata_report(metadata, n_rows=40).where("not passed").collect()}
    assert failed == {"row_count", "all_true:verified", "unique_key:image_id"}
    with pytest.raises(ValueError, match="all_true:verified"):
        rules.enforce(jobs.metadata_report(metadata))


def test_audit(spark, dataset):
    found = jobs.audit_dataset(spark, str(dataset / "train.csv"), [str(dataset / "absent"), str(dataset / "train_images")])
    summary = found["summary"].first().asDict()
    assert summary["n_records"] == summary["n_files"] == 40
    assert summary["n_missing"] == summary["n_extra"] == summary["n_unreadable"] == 0
    assert summary["n_dimensions"] == 3 == found["top_dimensions"].count()
    assert found["duplicates"].count() == summary["n_duplicate_pairs"]
    assert rows(found["formats"]) == [("PNG", 40)]
    assert found["classes"].agg(F.sum("pct_of_all")).first()[0] == pytest.approx(100)
    assert found["missing"].count() == found["extra"].count() == found["unreadable"].count() == 0


def test_registry_report(spark, tmp_path):
    entry = {"display_name": "D", "abbreviation": "A", "category": "disease"}
    labels, data = tmp_path / "labels.json", tmp_path / "data.json"
    diseases = {name: entry for name in jobs.LEAF_CLASSES}
    labels.write_text(json.dumps({"crops": {"cassava": {"diseases": diseases}}}))
    record = {name: "x" for name in jobs.REGISTRY_FIELDS}
    data.write_text(json.dumps({"datasets": {"leaves": record}}))
    report = lambda key: jobs.registry_report(spark, str(data), str(labels), key)
    assert report("leaves").count() == 11 and report("leaves").where("not passed").count() == 0
    assert [r.rule for r in report("other").where("not passed").collect()] == ["row_count"]
    del record["country"], diseases["healthy"]
    labels.write_text(json.dumps({"crops": {"cassava": {"diseases": diseases}}}))
    data.write_text(json.dumps({"datasets": {"leaves": record}}))
    failed = {r.rule for r in report("leaves").where("not passed").collect()}
    assert failed == {"required_field:country", "vocabulary:label"}


def test_near_duplicate_audit(spark, dataset, tmp_path):
    dirs = [str(dataset / "train_images")]
    manifest = tables.scan_manifest(spark, str(dataset / "train.csv"))
    lost = spark.createDataFrame([("lost.jpg", 1)], tables.MANIFEST_SCHEMA)
    metadata = jobs.build_metadata(manifest.unionByName(lost), images.image_integrity(spark, dirs))
    splits = jobs.split_metadata(metadata)
    found = jobs.audit_near_duplicates(spark, metadata, dirs, splits=splits)
    summary = found["summary"].first()
    assert (summary.n_hashed, summary.n_unhashed) == (40, 1)
    assert found["pairs"].count() > 0 and summary.n_near_pairs >= found["pairs"].count()
    assert found["groups"].count() == summary.n_exact_groups
    assert found["leakage"].where("split_a >= split_b").count() == 0
    whole = jobs.split_metadata(metadata, clusters=found["clusters"])
    assert whole.columns == splits.columns and whole.count() == 41
    assert near_dup_leakage(found["hashes"], whole, key="image_id", hash_col="hash").count() == 0


def test_training_batches(spark, dataset):
    manifest = tables.scan_manifest(spark, str(dataset / "train.csv"))
    files = images.image_integrity(spark, [str(dataset / "train_images")])
    splits = settled(jobs.split_metadata(jobs.build_metadata(manifest, files)))
    first = jobs.training_batches(splits, batch_size=8)
    assert rows(first.groupBy("batch_id").count()) == [(0, 8), (1, 8), (2, 8), (3, 4)]
    assert rules.determinism(first, jobs.training_batches(splits, batch_size=8)).first().passed
    other = jobs.training_batches(splits, batch_size=8, epoch=1)
    assert rules.determinism(first, other, equal=False).first().passed
    with pytest.raises(ValueError, match="label_range"):
        jobs.training_batches(splits, curation=jobs.Curation(classes=["healthy"]))
