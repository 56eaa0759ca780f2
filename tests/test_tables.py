import json

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from sortwell.operators import batches, duplicates, profile, project, reconcile, sampling
from sortwell.session import small_table
from sortwell.sources import tables


# --- sources --------------------------------------------------------------------------------


def test_manifest_scan(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text("image_id,label\na.jpg,1\nb.jpg,\n")
    df = tables.scan_manifest(spark, str(path))
    assert df.dtypes == [("image_id", "string"), ("label", "int")]
    assert rows(df) == [("a.jpg", 1), ("b.jpg", None)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        tables.scan_manifest(spark, str(tmp_path / "none.csv")).count()
    path.write_text("image_id,label\na.jpg,many\n")
    with pytest.raises(Exception):
        tables.scan_manifest(spark, str(path)).collect()


def test_label_map(spark, tmp_path):
    path = tmp_path / "map.json"
    path.write_text(json.dumps({"10": "ten", "9": "nine", "0": "zero"}, indent=1))
    got = [tuple(r) for r in tables.load_label_map(spark, str(path)).collect()]
    assert got == [(0, "zero"), (9, "nine"), (10, "ten")]
    assert tables.load_label_map(spark, str(tmp_path / "none.json")).count() == 0


def test_registries(spark, tmp_path):
    labels = tmp_path / "labels.json"
    record = {"display_name": "Rust", "abbreviation": "R", "category": "disease"}
    labels.write_text(json.dumps({"crops": {"bean": {"diseases": {"rust": record}}}}))
    assert rows(tables.label_registry(spark, str(labels))) == [("bean", "rust", "Rust", "R", "disease")]
    pytest.importorskip("yaml")
    data = tmp_path / "data.yaml"
    data.write_text("datasets:\n  one:\n    source_url: x\n    original_owner:\n      - a\n      - b\n")
    got = tables.dataset_registry(spark, str(data)).first()
    assert (got.source_url, got.original_owner, got.citation_required, got.country) == ("x", ["a", "b"], None, None)
    assert got.dataset_key == "one" and json.loads(got.record) == {"source_url": "x", "original_owner": ["a", "b"]}


def test_split_folders_are_pruned(spark, tmp_path):
    df = small_table(spark, [("a", "train"), ("b", "test"), ("c", "train")], "key string, split string")
    path = str(tmp_path / "splits")
    tables.write_splits(df, path)
    train = tables.read_split(spark, path, "train")
    assert rows(train.select("key")) == [("a",), ("c",)]
    assert "PartitionFilters: [isnotnull(split" in plan_of(train)
    with pytest.raises(ValueError):
        tables.read_split(spark, path, "dev")


def test_csv_splits(spark, tmp_path):
    df = small_table(spark, [("a", 1, "train"), ("b", 2, "test"), ("c", None, "train")], "key string, n int, split string")
    path = str(tmp_path / "splits")
    tables.write_splits(df, path, fmt="csv")
    train = tables.read_split(spark, path, "train", fmt="csv", schema="key string, n int")
    assert rows(train) == [("a", 1, "train"), ("c", None, "train")] and train.schema["n"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        tables.read_split(spark, path, "train", fmt="csv")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_write_overwrites(spark, tmp_path, fmt):
    path = str(tmp_path / "new" / "table")
    tables.write_table(small_table(spark, [("a", 1)], "k string, v int"), path, fmt)
    tables.write_table(small_table(spark, [("b", 2)], "k string, v int"), path, fmt)
    assert rows(spark.read.format(fmt).option("header", True).schema("k string, v int").load(path)) == [("b", 2)]


def test_spread_leaves_large_scans_alone(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert "hashpartitioning(doc_id" in plan_of(tables.spread(docs, "doc_id"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        assert "Exchange" not in plan_of(tables.spread(docs, "doc_id"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "Exchange" not in plan_of(tables.spread(spark.range(0, 10, 1, 200), "id"))


# --- labels ---------------------------------------------------------------------------------


def test_canonicalise_modes(spark):
    df = small_table(spark, [("a", 0), ("b", 7), ("c", None)], "id string, label int")
    names = {0: "zero", 1: "one"}
    with pytest.raises(Exception, match="no canonical label"):
        project.canonicalise(df, "label", names).collect()
    assert rows(project.canonicalise(df, "label", names, on_unknown="null")) == [
        ("a", 0, "zero"), ("b", 7, None), ("c", None, None),
    ]
    assert rows(project.canonicalise(df, "label", names, on_unknown="quarantine")) == [("b", 7), ("c", None)]
    known = project.canonicalise(df.where("id = 'a'"), "label", names)
    assert rows(known) == [("a", 0, "zero")] and "BroadcastHashJoin" in plan_of(known)
    with pytest.raises(ValueError):
        project.canonicalise(df, "label", names, on_unknown="skip")


def test_encode_and_decode_are_inverse(spark):
    vocab = ["c", "a", "b"]
    df = small_table(spark, [("a",), ("b",), ("c",), ("x",)], "name string")
    coded = project.encode_labels(df, "name", vocab)
    assert rows(coded) == [("a", 1), ("b", 2), ("c", 0), ("x", None)]
    back = project.decode_labels(coded, "class_index", vocab)
    assert back.where("not (name <=> class_name)").count() == 1


def test_provenance_null_is_typed(spark):
    df = project.with_provenance(spark.range(1), {"crop": "bean", "region": None, "checked": True})
    assert dict(df.dtypes) == {"id": "bigint", "crop": "string", "region": "string", "checked": "boolean"}


def test_label_display_and_filter(spark):
    df = small_table(spark, [(1, "a"), (2, "b")], "id int, label string")
    registry = [{"label": "a", "display_name": "A", "abbreviation": "x", "category": "c"}]
    assert rows(project.label_display(df, "label", registry)) == [(1, "a", "A", "x", "c"), (2, "b", None, None, None)]
    assert rows(project.filter_class(df, "label", "b")) == [(2, "b")]


# --- reconciliation -------------------------------------------------------------------------


@pytest.fixture
def manifest(spark):
    return small_table(spark, [("a", 0), ("a", 0), ("b", 1), ("lost", 1)], "id string, label int")


@pytest.fixture
def files(spark):
    return small_table(spark, [("a", 10, True), ("b", 20, True), ("extra", 5, True)], "id string, width int, verified boolean")


def test_counts_are_over_distinct_ids(manifest, files):
    assert tuple(reconcile.reconcile_summary(manifest, files, key="id").first()) == (3, 3, 1, 1)
    assert rows(reconcile.missing_refs(manifest, files, key="id")) == [("lost",)]
    assert rows(reconcile.extra_files(manifest, files, key="id")) == [("extra",)]
    assert reconcile.existing_refs(manifest, files, key="id").count() == 3


def test_strict_existence(manifest, files):
    with pytest.raises(FileNotFoundError, match="lost"):
        reconcile.existing_refs(manifest, files, key="id", strict=True)


def test_attach_keeps_every_manifest_row(manifest, files):
    got = reconcile.attach_file_metadata(manifest, files, key="id")
    assert rows(got.where("id = 'lost'")) == [("lost", 1, None, False)]
    assert got.count() == 4


def test_vocabulary_modes(spark):
    df = small_table(spark, [("a",), ("b",), (None,), ("a",)], "v string")
    diff = lambda **kw: rows(reconcile.vocabulary_diff(df, "v", ["a", "c"], **kw))
    assert diff() == [("b", "unexpected"), ("c", "absent"), (None, "unexpected")]
    assert diff(ignore_nulls=True) == [("b", "unexpected"), ("c", "absent")]
    assert diff(mode="subset", ignore_nulls=True) == [("b", "unexpected")]
    assert rows(reconcile.vocabulary_diff(df.where("v = 'a'"), "v", ["a"])) == []
    with pytest.raises(ValueError):
        diff(mode="superset")


# --- profiles and duplicates ----------------------------------------------------------------


def test_percent_denominators(spark):
    df = small_table(spark, [("a",), ("a",), ("b",), (None,)], "v string")
    found = profile.class_percentages(df, "v")
    share = {r.v: r for r in found.collect()}
    assert {k: r.pct_of_labelled for k, r in share.items()} == pytest.approx({"a": 200 / 3, "b": 100 / 3})
    assert {k: (r.n, r.pct_of_all) for k, r in share.items()} == {"a": (2, 50.0), "b": (1, 25.0)}
    plan = plan_of(profile.class_percentages(df, "v"))
    assert plan.count("Exchange ") <= 2 and "Subquery" not in plan and "Join" not in plan
    assert rows(profile.class_counts(df, "v")) == [("a", 2), ("b", 1)]
    weights = {r.v: r.weight for r in profile.class_weights(df, "v").collect()}
    assert weights == pytest.approx({"a": (3 / 4) ** 0.5, "b": (3 / 2) ** 0.5})


def test_profile_and_nulls(spark):
    df = small_table(spark, [("a", None), (None, None)], "v string, w int")
    assert tuple(profile.table_profile(df).first()) == (2, 2, "v,w")
    assert rows(profile.null_counts(df)) == [("v", 1), ("w", 2)]


def test_verified_ratio(spark):
    df = small_table(spark, [(True,), (False,), (None,), (True,)], "ok boolean")
    assert tuple(profile.verified_ratio(df, F.col("ok")).first()) == (2, 4, 0.5, False)
    assert profile.verified_ratio(df.where("ok"), F.col("ok")).first()["all_verified"]


def test_star_relations(spark):
    data = [("c", 1, "x"), ("a", 2, "x"), ("b", 3, "x"), ("d", 4, "y"), ("e", 5, None)]
    df = small_table(spark, data, "id string, row int, digest string")
    assert rows(duplicates.exact_duplicates(df, key="id", digest="digest")) == [("x", "a", "b"), ("x", "a", "c")]
    by_row = duplicates.exact_duplicates(df, key="id", digest="digest", order="row")
    assert rows(by_row) == [("x", "c", "a"), ("x", "c", "b")]


def test_hot_digest_is_split_and_complete(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("digest"))
    got = duplicates.exact_duplicates(df, key="id", digest="digest", hot_rows=100)
    assert got.count() == 999 and got.where("first_key <> 0").count() == 0
    assert got.select("duplicate_key").distinct().count() == 999


def test_groups_and_repeated_keys(spark):
    df = small_table(spark, [("a", 1), ("b", 1), ("c", 2), ("d", None), ("e", None)], "id string, h bigint")
    assert rows(duplicates.hash_groups(df, key="id", hash_col="h")) == [(1, "a", 2)]
    members = duplicates.hash_group_members(df, key="id", hash_col="h")
    assert rows(members.select("h", "id", "n_keys")) == [(1, "a", 2), (1, "b", 2)]
    assert rows(duplicates.duplicate_keys(small_table(spark, [("a",), ("b",), ("a",)], "id string"), "id")) == [("a", 2)]


def test_audit_summary(spark, manifest, files):
    with_digest = files.withColumn("digest", F.lit("same")).withColumn("height", F.lit(1))
    got = profile.audit_summary(
        manifest, with_digest, key="id", digest="digest", readable=F.col("width") > 5, dimensions=("width", "height"),
    ).first()
    assert got.asDict() == {
        "n_records": 4, "n_files": 3, "n_unreadable": 1, "n_missing": 1, "n_extra": 1,
        "n_duplicate_pairs": 2, "n_dimensions": 3,
    }
    assert "NestedLoop" not in plan_of(
        profile.audit_summary(
            manifest, with_digest, key="id", digest="digest", readable=F.col("width") > 5, dimensions=("width", "height")
        )
    )


# --- samples and batches --------------------------------------------------------------------


def test_sample_takes_min_of_n_and_class_size(spark):
    df = small_table(spark, [(i, "a" if i < 3 else "b") for i in range(50)], "id int, label string")
    got = sampling.sample_per_class(df, key="id", label="label", n=8)
    assert rows(got.groupBy("label").count()) == [("a", 3), ("b", 8)]
    assert rows(got) == rows(sampling.sample_per_class(df.repartition(9), key="id", label="label", n=8))
    plan = plan_of(got)
    # Each class is cut to n rows before the shuffle.
    assert plan.index("row_number(), 8, Final") < plan.index("Exchange") < plan.index("row_number(), 8, Partial")
    with pytest.raises(ValueError):
        sampling.sample_per_class(df, key="id", label="label", n=0)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 1000])
@pytest.mark.parametrize("shuffle", [False, True])
def test_batches(spark, n, shuffle):
    df = spark.range(n).select(F.format_string("k%06d", "id").alias("key"))
    got = batches.assign_batches(df, key="key", shuffle=shuffle).collect()
    order = [r.key for r in sorted(got, key=lambda r: r.position)]
    assert sorted(r.position for r in got) == list(range(n))
    assert all(r.batch_id == r.position // 32 for r in got)
    if not shuffle:
        assert order == sorted(order)
    elif n == 1000:
        again = batches.assign_batches(df.repartition(13), key="key", shuffle=True).collect()
        other = batches.assign_batches(df, key="key", shuffle=True, epoch=1).collect()
        assert sorted(got) == sorted(again) and sorted(got) != sorted(other)
        assert order != sorted(order)


def test_batch_summary(spark):
    df = small_table(spark, [(i, "train" if i < 65 else "test") for i in range(97)], "id int, split string")
    assert rows(batches.batch_summary(df, split="split")) == [("test", 32, 1, 32), ("train", 65, 3, 1)]
    with pytest.raises(ValueError):
        batches.batch_summary(df, split="split", batch_size=0)


def test_hot_manifest_keys_are_dealt_out(spark):
    manifest = small_table(spark, [("a", i) for i in range(50)] + [("b", 1), ("x", 2), (None, 3)], "k string, v int")
    files = small_table(spark, [("a", 7, True), ("b", 8, True), ("c", 9, True)], "k string, w int, verified boolean")
    got = rows(reconcile.attach_file_metadata(manifest, files, key="k", hot_rows=4))
    assert got == rows(reconcile.attach_file_metadata(manifest, files, key="k"))
    assert len(got) == 53 and ("x", 2, None, False) in got and (None, 3, None, False) in got
    kept = rows(reconcile.existing_refs(manifest, files, key="k", hot_rows=4))
    assert kept == [("a", i) for i in sorted(range(50), key=str)] + [("b", 1)]
