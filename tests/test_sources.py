"""Manifests with rejects, committed versions, batch shards, packed files and image headers."""

import random
import struct
import zlib

import pytest
from conftest import plan_of, rows
from images import gradient, png_bytes, write_jpeg
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sortwell.operators import batches, rules
from sortwell.plans.queries import picture_files
from sortwell.sources import packed, tables, versions
from sortwell.session import small_table


def test_manifest_keeps_good_rows_and_names_rejects(spark, tmp_path):
    lines = ["image_id,label", "a.jpg,1", "b.jpg,x1", '"c,1.jpg",2', "d.jpg", "e.jpg,3,4", "f.jpg,", ",5", "", "g.jpg,9999999999", "label,image_id"]
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n")
    read = tables.read_manifest(spark, str(tmp_path))
    assert rows(tables.good_rows(read)) == rows(spark.createDataFrame([("a.jpg", 1), ("c,1.jpg", 2), ("f.jpg", None), (None, 5)], "i string, l int"))
    assert {r.line: (r.file, r.reason) for r in tables.manifest_rejects(read).collect()} == {
        "b.jpg,x1": ("m.csv", "label is no int: x1"), "d.jpg": ("m.csv", "too few fields"),
        "e.jpg,3,4": ("m.csv", "too many fields"), "g.jpg,9999999999": ("m.csv", "label is no int: 9999999999"),
        "label,image_id": ("m.csv", "label is no int: image_id"),
    }
    assert tables.good_rows(read).count() == 4 and tables.manifest_rejects(read).count() == 5


def test_versions_count_once_committed(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path)
    one, two = spark.range(10).toDF("a"), spark.range(5, 25).select("id", F.lit("x").alias("p"))
    assert versions.write_version(one, path) == 1
    assert versions.write_version(two, path, partition_by=("p",)) == 2
    # A third one that dies before its commit.
    one.write.parquet(f"{path}/v00000003-dead")
    assert rows(versions.read_version(spark, path, check=True)) == rows(two)
    assert versions.read_version(spark, path).schema.names == ["id", "p"]
    assert rows(versions.read_version(spark, path, 1)) == rows(one)
    assert versions.write_version(one, path, fmt="csv") == 3
    assert rows(versions.read_version(spark, path, check=True)) == rows(one)
    assert [(r.version, r.n_rows) for r in versions.commits(spark, path).orderBy("version").collect()] == [(1, 10), (2, 20), (3, 10)]


def test_second_writer_of_a_version_fails_and_changes_are_found(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.write_version(spark.range(3), path)
    empty = versions.commits(spark, path).where("version < 0")
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commits", lambda *_: empty)
        with pytest.raises(AnalysisException):
            versions.write_version(spark.range(9), path)
    assert versions.read_version(spark, path).count() == 3
    record = versions.latest_commit(spark, path)
    spark.range(1).write.mode("append").parquet(f"{path}/{record.folder}")
    with pytest.raises(ValueError):
        versions.read_version(spark, path, check=True)


@pytest.mark.parametrize("shuffle", [False, True])
def test_batches_lie_whole_in_their_shards(spark, tmp_path, shuffle):
    df = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    path = str(tmp_path / "b")
    batches.write_batches(df, path, key="key", batch_size=8, batches_per_shard=5, shuffle=shuffle)
    files = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    found = files.collect()
    assert sorted(r.position for r in found) == list(range(1000))
    assert all(r.batch_id == r.position // 8 and r.shard == r.batch_id // 5 for r in found)
    assert len({r.file for r in found}) == len({r.shard for r in found}) == 25
    assert all(r.position == 40 * r.shard + r.row for r in found)
    resumed = batches.resume_batches(spark, path, batch_id=63, batches_per_shard=5)
    assert sorted(r.position for r in resumed.collect()) == list(range(504, 1000))
    assert "PartitionFilters: [isnotnull(shard" in plan_of(resumed)
    assert len({r[0] for r in resumed.select("_metadata.file_name").distinct().collect()}) == 13
    with pytest.raises(ValueError):
        batches.write_batches(df, path, key="key", batches_per_shard=0)


def test_shards_have_even_sizes(spark, tmp_path):
    rng = random.Random(3)
    sizes = [rng.choice([0, 10, 300, 5000]) for _ in range(200)]
    files = small_table(spark, [(f"f{i:03d}", n, b"x" * n) for i, n in enumerate(sizes)], "key string, length bigint, content binary").repartition(7)
    packed.pack_files(files, str(tmp_path / "p"), target_bytes=6000)
    found = packed.packed_files(spark, str(tmp_path / "p")).orderBy("key").collect()
    start, want = 0, []
    for n in sizes:
        want.append(start // 6000)
        start += n
    assert [r.shard for r in found] == want and [len(r.content) for r in found] == sizes
    per_shard = {s: sum(n for n, w in zip(sizes, want) if w == s) for s in want}
    assert max(per_shard.values()) < 6000 + 5000
    packed.pack_files(files.where("key is null"), str(tmp_path / "none"))


def test_headers_equal_what_was_written(spark, tmp_path):
    write_jpeg(spark, gradient(20, 30), tmp_path / "x.jpg")
    png, jpeg = png_bytes(gradient(5, 7)), (tmp_path / "x.jpg").read_bytes()
    files = {
        "a": (png, ("PNG", 7, 5, None)), "b": (jpeg, ("JPEG", 30, 20, None)), "c": (png[:-6], ("PNG", 7, 5, "incomplete file")),
        "d": (jpeg[:-2], ("JPEG", 30, 20, "incomplete file")), "e": (b"", (None, None, None, "empty file")),
        "f": (b"GIF89a....", (None, None, None, "unknown format")), "g": (jpeg[:4], ("JPEG", None, None, "no size in its header")),
        "h": (png[:40] + b"?" + png[41:], ("PNG", 7, 5, "incomplete file")), "i": (None, (None, None, None, "empty file")),
        "j": (png[:20], (None, None, None, "unknown format")),
    }
    df = small_table(spark, [(k, c) for k, (c, _) in files.items()], "key string, content binary")
    found = {r.key: (r.format, r.width, r.height, r.error) for r in packed.header_integrity(df).collect()}
    assert found == {k: want for k, (_, want) in files.items()}


def test_pictures_of_embeddings_are_real_files(spark, sf):
    """The PNG files that the queries read unpack to the pixels they were made from."""
    for row in picture_files(spark, sf).where("length = 140").limit(20).collect():
        data = bytes(row.content)
        assert packed.png_header(data) == (8, 8, True)
        size = struct.unpack(">I", data[33:37])[0]
        pixels = zlib.decompress(data[41 : 41 + size])
        assert len(pixels) == 72 and set(pixels[::9]) == {0}


def test_registry_files_keep_types_at_any_depth(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"datasets": {"one": {"name": "x", "owner": ["p", "q"], "terms": {"open": true}},\n "two": {"name": 5, "owner": "p"}}}')
    (tmp_path / "b.json").write_text('{"datasets": {"three": {"name": null, "terms": {"open": "yes"}}}, "other": 1}')
    (tmp_path / "c.json").write_text("not JSON {")
    (tmp_path / "d.json").write_text('{"datasets": [1, 2]}')
    entries = tables.registry_entries(spark, str(tmp_path))
    found = tables.typed_registry(entries, {"name": "string", "owner": "array<string>", "terms.open": "boolean"})
    assert found.columns == ["key", "name", "owner", "terms_open"]
    assert {r.key: (r.name, r.owner, r.terms_open) for r in found.collect()} == {
        "one": ("x", ["p", "q"], True), "two": ("5", None, None), "three": (None, None, True),
    }
    report = rules.field_types(entries, "record", {"name": "STRING", "terms.open": "BOOLEAN", "owner": "ARRAY<STRING>"})
    assert {r.rule: (r.observed, r.passed) for r in report.collect()} == {
        "field_type:name:STRING": ("2", False), "field_type:terms.open:BOOLEAN": ("2", False), "field_type:owner:ARRAY<STRING>": ("2", False),
    }
    assert "owner" in tables.registry_schema(entries).first().schema
