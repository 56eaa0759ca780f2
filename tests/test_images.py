import hashlib

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of, rows
from images import blobs, gradient, png_bytes, write_jpeg
from pyspark.sql import functions as F

from sortwell.functions import hashing
from sortwell.operators import pixels
from sortwell.operators.profile import dimension_stats, format_counts, top_combinations
from sortwell.session import small_table
from sortwell.sources import images


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("leaves")
    (root / "empty_dir").mkdir()
    (root / "nested").mkdir()
    (root / "a.jpg").write_bytes(png_bytes(gradient(20, 30)))  # a PNG named .jpg
    (root / "b.jpg").write_bytes(png_bytes(gradient(20, 30)))
    write_jpeg(spark, blobs(48, 64, 1), root / "c.jpg")
    (root / "broken.jpg").write_bytes(b"\xff\xd8\xff\xe0 not really a picture")
    (root / "text.jpg").write_bytes(b"hello")
    (root / "zero.jpg").write_bytes(b"")
    (root / "a b+c%20.jpg").write_bytes(png_bytes(gradient(20, 30, shift=40)))
    (root / "UPPER.JPG").write_bytes(png_bytes(gradient(4, 4)))
    (root / "nested" / "d.jpg").write_bytes(png_bytes(gradient(4, 4)))
    (root / "grey.jpg").write_bytes(png_bytes(gradient(16, 16)[:, :, 0].copy()))
    return root


def candidates(folder):
    return [str(folder / "absent"), str(folder / "empty_dir"), str(folder)]


def test_first_folder_with_a_match_is_scanned_flat(spark, folder):
    files = images.scan_image_files(spark, candidates(folder))
    keys = {r.key for r in files.select("key").collect()}
    assert keys == {"a.jpg", "b.jpg", "c.jpg", "broken.jpg", "text.jpg", "zero.jpg", "grey.jpg", "a b+c%20.jpg"}


def test_no_folder_with_a_match_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        images.scan_image_files(spark, [str(folder / "empty_dir"), str(folder / "absent")])


def test_content_is_pruned_when_only_names_are_needed(spark, folder):
    plan = plan_of(images.scan_image_files(spark, candidates(folder)).select("key"))
    assert "ReadSchema: struct<path:string>" in plan and "content" not in plan.split("ReadSchema")[1]


def test_integrity(spark, folder):
    found = images.image_integrity(spark, candidates(folder))
    got = {r.key: r for r in found.collect()}
    assert (got["a.jpg"].width, got["a.jpg"].height, got["a.jpg"].format) == (30, 20, "PNG")
    assert (got["c.jpg"].width, got["c.jpg"].height, got["c.jpg"].format) == (64, 48, "JPEG")
    assert got["a.jpg"].decode_ok and got["c.jpg"].header_ok and got["a.jpg"].error is None
    assert got["broken.jpg"].header_ok and not got["broken.jpg"].decode_ok
    assert got["broken.jpg"].width is None and got["broken.jpg"].error == "cannot be decoded"
    assert not got["text.jpg"].header_ok and got["text.jpg"].error == "unknown format"
    assert got["zero.jpg"].error == "empty file"
    assert got["a.jpg"].digest == hashlib.md5((folder / "a.jpg").read_bytes()).hexdigest()


def test_profiles_over_readable_files(spark, folder):
    files = images.image_integrity(spark, candidates(folder))
    readable = files.where("decode_ok")
    assert rows(format_counts(files, readable=F.col("decode_ok"))) == [("JPEG", 1), ("PNG", 4)]
    stats = dimension_stats(readable).first()
    assert (stats.min_width, stats.max_width, stats.mean_height) == (16, 64, 24.8)
    assert tuple(top_combinations(readable, k=1).first()) == (30, 20, 3)


def test_image_hash_properties(spark, tmp_path):
    rng = np.random.default_rng(0)
    for seed in range(4):
        picture = blobs(90, 120, seed)
        (tmp_path / f"p{seed}.jpg").write_bytes(png_bytes(picture))
        (tmp_path / f"copy{seed}.jpg").write_bytes(png_bytes(picture))
        noisy = np.clip(picture.astype(int) + rng.integers(-2, 3, picture.shape), 0, 255)
        (tmp_path / f"noisy{seed}.jpg").write_bytes(png_bytes(noisy.astype(np.uint8)))
    (tmp_path / "bad.jpg").write_bytes(b"nothing")
    decoded = images.decode_images(spark, [str(tmp_path)])
    got = {r.key: r.hash for r in pixels.image_hash64(decoded).collect()}
    assert got["bad.jpg"] is None
    d = lambda a, b: ((got[a] ^ got[b]) & (2**64 - 1)).bit_count()
    for s in range(4):
        assert got[f"p{s}.jpg"] == got[f"copy{s}.jpg"]
        assert d(f"p{s}.jpg", f"noisy{s}.jpg") <= 5
        assert all(d(f"p{s}.jpg", f"p{t}.jpg") > 10 for t in range(4) if t != s)


def test_hash_bits_follow_the_published_recipe():
    picture = blobs(64, 64, 9)
    same = picture[:, :, ::-1].tobytes()
    value, again, other = (int(v) for v in pixels._phash([same, same, blobs(64, 64, 8).tobytes()], 64, 64, 3))
    assert value == again != other
    # The median splits the 64 coefficients in halves.
    assert (value & (2**64 - 1)).bit_count() == 32
    # The DC term is far above the median, and its bit comes first.
    assert value < 0


def test_resampling_weights():
    for n_in, n_out in [(10, 10), (100, 32), (20, 64), (7, 3)]:
        for kernel, reach in [(pixels._triangle, 1), (pixels._lanczos3, 3)]:
            w = pixels._resampling(n_in, n_out, kernel, reach)
            assert w.shape == (n_out, n_in) and np.allclose(w.sum(axis=1), 1)
    assert np.allclose(pixels._resampling(10, 10, pixels._triangle, 1), np.eye(10))
    # A linear ramp stays linear away from the border.
    ramp = pixels._resampling(512, 256, pixels._triangle, 1) @ np.arange(512)
    assert np.allclose(np.diff(ramp)[5:-5], 2)


def test_evaluation_preprocessing(spark, tmp_path):
    flat = np.zeros((300, 400, 3), np.uint8)
    flat[:, :] = (255, 128, 0)
    (tmp_path / "flat.jpg").write_bytes(png_bytes(flat))
    (tmp_path / "tall.jpg").write_bytes(png_bytes(blobs(500, 260, 2)))
    decoded = images.decode_images(spark, [str(tmp_path)])
    manifest = small_table(spark, [("flat.jpg", 1), ("tall.jpg", 0)], "key string, label int")
    got = pixels.preprocess_eval(manifest, decoded, split="test")
    assert got.schema["vec"].dataType.simpleString() == "array<float>"
    vec = np.array(got.where("key = 'flat.jpg'").first().vec).reshape(3, 224, 224)
    for c, v in enumerate((255, 128, 0)):
        expected = (v / 255 - (0.485, 0.456, 0.406)[c]) / (0.229, 0.224, 0.225)[c]
        assert np.allclose(vec[c], expected, atol=1e-6)
    assert len(got.where("key = 'tall.jpg'").first().vec) == 3 * 224 * 224
    assert rows(got.select("key", F.md5(F.col("vec").cast("string")))) == rows(
        got.select("key", F.md5(F.col("vec").cast("string")))
    )


def test_long_manifests_join_crops(spark, tmp_path, monkeypatch):
    for i in range(3):
        (tmp_path / f"{i}.jpg").write_bytes(png_bytes(blobs(260, 300, i)))
    decoded = images.decode_images(spark, [str(tmp_path)])
    manifest = small_table(spark, [("0.jpg", 1), ("2.jpg", 0)], "key string, label int")
    short = pixels.preprocess_eval(manifest, decoded, split="test")
    assert "Exchange hashpartitioning" not in plan_of(short)
    monkeypatch.setattr(pixels, "bounded_copy", lambda df, n: None)
    long = pixels.preprocess_eval(manifest, decoded, split="test")
    assert sorted(short.collect()) == sorted(long.collect())


def test_preprocessing_rejects_bad_input(spark, folder):
    decoded = images.decode_images(spark, candidates(folder))
    manifest = small_table(spark, [("a.jpg", 1)], "key string, label int")
    for split in ("train", "dev"):
        with pytest.raises(ValueError):
            pixels.preprocess_eval(manifest, decoded, split=split)
    missing = small_table(spark, [("none.jpg", 1)], "key string, label int")
    with pytest.raises(FileNotFoundError):
        pixels.preprocess_eval(missing, decoded, split="test")
    broken = small_table(spark, [("broken.jpg", 1)], "key string, label int")
    with pytest.raises(Exception, match="cannot be decoded"):
        pixels.preprocess_eval(broken, decoded, split="test").collect()


def test_augmentation_plan(spark):
    keys = spark.range(2000).withColumnRenamed("id", "key")
    plan = pixels.augmentation_plan(keys, key="key")
    bounds = {
        "crop_scale": (0.8, 1.0), "crop_ratio": (0.9, 1.1), "angle": (-15, 15), "brightness": (0.85, 1.15),
        "contrast": (0.85, 1.15), "saturation": (0.9, 1.1), "hue": (-0.02, 0.02),
    }
    pdf = plan.toPandas()
    for name, (low, high) in bounds.items():
        assert pdf[name].between(low - 1e-12, high + 1e-12).all()
        assert pdf[name].min() < low + 0.02 * (high - low) and pdf[name].max() > high - 0.02 * (high - low)
    assert abs(pdf["horizontal_flip"].mean() - 0.5) < 0.05
    assert abs(pdf["vertical_flip"].mean() - 0.2) < 0.04
    assert rows(plan) == rows(pixels.augmentation_plan(keys.repartition(7), key="key"))
    assert rows(plan) != rows(pixels.augmentation_plan(keys, key="key", epoch=1))


def test_image_hash_feeds_the_duplicate_search(spark, folder):
    from sortwell.operators.neardup import near_duplicates

    decoded = images.decode_images(spark, candidates(folder))
    pairs = near_duplicates(pixels.image_hash64(decoded), key="key", hash_col="hash")
    assert ("a.jpg", "b.jpg", 0) in rows(pairs)
    assert hashing.signed64(2**63) == -(2**63)


def test_pictures_smaller_than_their_crop_are_moved_whole(spark):
    """40 pictures of 8 x 8: crops, of 150,528 bytes each, are made in blocks, behind the join."""
    decoded = spark.range(40).select(
        F.col("id").alias("key"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("n_channels"),
        F.unhex(F.repeat(F.lpad(F.hex(F.col("id")), 2, "0"), 64)).alias("data"),
    )
    cut = pixels._cut_down(pixels._whole(decoded, "key"), pixels.ImageOptions())
    assert {(len(r._image.data), r._image.crop) for r in cut.collect()} == {(64, None)}
    small = pixels.ImageOptions(size=4, resize=5)
    cut = pixels._cut_down(pixels._whole(decoded, "key"), small)
    assert {(r._image.data, len(r._image.crop)) for r in cut.collect()} == {(None, 48)}
    manifest = spark.range(40).select(F.col("id").alias("key"), F.lit("t").alias("width"))
    for options, bound in ((pixels.ImageOptions(), 0), (small, 0), (small, 100)):
        got = pixels.preprocess_eval(manifest, decoded, split="test", files=manifest, options=options, max_broadcast_rows=bound, stats=True)
        found = {r.key: r.stats for r in got.collect()}
        assert sorted(found) == list(range(40)) and {s.n for s in found.values()} == {3 * options.size**2}
        assert all(abs(s.min - (k / 255 - 0.485) / 0.229) < 1e-6 for k, s in found.items())


def test_crops_and_floats_are_made_in_the_same_blocks(spark):
    """No function returns the crops of a whole batch at once (10,000 rows: 1.5 GB)."""
    decoded = spark.range(70, numPartitions=1).select(
        F.col("id").alias("key"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("n_channels"),
        F.unhex(F.repeat(F.lit("7F"), 64)).alias("data"),
    )
    keys = decoded.select("key")
    for bound, steps in ((100, 1), (0, 2)):
        plan = plan_of(pixels.preprocess_eval(keys, decoded, split="test", files=keys, max_broadcast_rows=bound))
        assert "ArrowEvalPython" not in plan and plan.count("MapInArrow") >= steps


def test_small_pictures_are_hashed_in_blocks(monkeypatch):
    """Pictures of 8 x 8 count as the 32 x 32 they are brought to; blocks don't change a hash."""
    height, data = pd.Series([8] * 25), pd.Series([bytes((i * j) % 251 for j in range(64)) for i in range(25)])
    hashed = lambda: list(pixels._phash_udf.func(height, height, pd.Series([1] * 25), data))
    whole, sizes, one = hashed(), [], pixels._phash
    monkeypatch.setattr(pixels, "BLOCK_PIXELS", 10 * 32 * 32)
    monkeypatch.setattr(pixels, "_phash", lambda d, *a: sizes.append(len(d)) or one(d, *a))
    assert hashed() == whole and sizes == [10, 10, 5]
