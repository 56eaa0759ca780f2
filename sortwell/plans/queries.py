"""Registered queries: every operator on the given tables, over all of their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortwell.functions import hashing, vectors
from sortwell.operators import batches, clusters, duplicates, fingerprint, keyfilter, metrics, neardup, pixels, profile, project
from sortwell.operators import reconcile, rules, sampling, split
from sortwell.session import one_row, settled, shared_folder
from sortwell.sources import packed, tables, versions
from sortwell.sources.tables import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Label and source tables the queries use as vocabulary, map and registry.
LANGS = ["de", "en", "es", "fr"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
QUALITY = {0: "low", 1: "high"}
LANG_REGISTRY = [
    {"label": "de", "display_name": "German", "abbreviation": "GER", "category": "germanic"},
    {"label": "en", "display_name": "English", "abbreviation": "ENG", "category": "germanic"},
    {"label": "es", "display_name": "Spanish", "abbreviation": "SPA", "category": "romance"},
    {"label": "fr", "display_name": "French", "abbreviation": "FRE", "category": "romance"},
]
DIGIT_NAMES = [
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine",
]
# Channel constants for the vectors of the embeddings table.
MEAN, STD = list(pixels.ImageOptions.mean), list(pixels.ImageOptions.std)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    df = table(spark, sf, "documents")
    return df.select(*columns) if columns else df


def hashed(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, fp: the text hash of every document."""
    docs = spread(documents(spark, sf, "doc_id", "text"), "doc_id")
    return docs.select("doc_id", hashing.text_hash64("text").alias("fp"))


def split_documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    docs = documents(spark, sf, "doc_id", "lang", *columns)
    return split.stratified_split(docs, key="doc_id", label="lang")


def labelled(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Documents with their labels; nulls where a document has none."""
    docs = documents(spark, sf, *(columns or ("doc_id", "lang", "source", "n_chars")))
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


def order_refs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders as a manifest, the orders that line items name as files."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderpriority")
    return orders, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"))


def r6(value: Column | str) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, 6)


# --- hashes and near duplicates -------------------------------------------------------------


@query
def text_hash64(spark, sf):
    return hashed(spark, sf)


@query
def near_duplicates(spark, sf):
    return neardup.near_duplicates(hashed(spark, sf), key="doc_id", hash_col="fp")


@query
def near_duplicates_crowded(spark, sf):
    """The same with bounds so low that the ways for crowded buckets and hot groups are taken."""
    return neardup.near_duplicates(hashed(spark, sf), key="doc_id", hash_col="fp", bucket_rows=3, hot_rows=2)


@query
def near_dup_clusters(spark, sf):
    return clusters.near_dup_clusters(hashed(spark, sf), key="doc_id", hash_col="fp")


@query
def near_dup_candidates(spark, sf):
    found = neardup.band_buckets(hashed(spark, sf), key="doc_id", hash_col="fp")
    return found.withColumn("n_pairs", F.col("n_pairs").cast("double"))


@query
def near_dup_summary(spark, sf):
    found = neardup.near_dup_summary(hashed(spark, sf), key="doc_id", hash_col="fp")
    return found.withColumn("n_near_pairs", F.col("n_near_pairs").cast("double"))


@query
def near_dup_candidate_pairs(spark, sf):
    groups = settled(neardup.collapse_hashes(hashed(spark, sf), key="doc_id", hash_col="fp"))
    return neardup.candidate_pair_count(groups).withColumn("n_candidates", F.col("n_candidates").cast("double"))


@query
def hash_groups(spark, sf):
    return duplicates.hash_groups(hashed(spark, sf), key="doc_id", hash_col="fp")


@query
def hash_group_members(spark, sf):
    return duplicates.hash_group_members(hashed(spark, sf), key="doc_id", hash_col="fp")


@query
def sort_pairs(spark, sf):
    return neardup.sort_pairs(near_duplicates(spark, sf))


@query
def near_dup_leakage(spark, sf):
    splits = split_documents(spark, sf)
    return neardup.near_dup_leakage(hashed(spark, sf), splits, key="doc_id", hash_col="fp")


@query
def bit_bands(spark, sf):
    bands = hashing.bit_bands("fp").alias("bands")
    return hashed(spark, sf).select("doc_id", bands).select(
        "doc_id", *[F.col("bands")[i].alias(f"band_{i}") for i in range(8)]
    )


@query
def parse_hash64(spark, sf):
    digits = F.substring(hashing.content_digest("text"), 1, 16)
    return documents(spark, sf, "doc_id", "text").select(
        "doc_id", hashing.parse_hash64(digits).alias("hash")
    )


@query
def hamming_distance(spark, sf):
    """Distance between a document and the next one by number."""
    hashes = parse_hash64(spark, sf)
    following = hashes.select((F.col("doc_id") - 1).alias("doc_id"), F.col("hash").alias("next_hash"))
    distance = hashing.hamming64("hash", "next_hash")
    return hashes.join(following, "doc_id").select("doc_id", distance.alias("hash_distance"))


# --- exact duplicates -----------------------------------------------------------------------


@query
def content_digest(spark, sf):
    return documents(spark, sf, "doc_id", "text").select(
        "doc_id", hashing.content_digest("text").alias("digest")
    )


@query
def exact_duplicates(spark, sf):
    return duplicates.exact_duplicates(content_digest(spark, sf), key="doc_id", digest="digest")


@query
def exact_duplicates_hot(spark, sf):
    """The same with every group of more than two dealt into parts."""
    return duplicates.exact_duplicates(content_digest(spark, sf), key="doc_id", digest="digest", hot_rows=2)


@query
def duplicate_keys(spark, sf):
    return duplicates.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


# --- profiles -------------------------------------------------------------------------------


@query
def table_profile(spark, sf):
    return profile.table_profile(labelled(spark, sf, "*"))


@query
def null_counts(spark, sf):
    return profile.null_counts(labelled(spark, sf, "*"))


@query
def class_counts(spark, sf):
    return profile.class_counts(documents(spark, sf), "lang")


@query
def class_percentages(spark, sf):
    """Both denominators side by side."""
    found = profile.class_percentages(labelled(spark, sf, "doc_id"), "quality")
    return found.withColumns({c: r6(c) for c in ("pct_of_labelled", "pct_of_all")})


@query
def class_weights(spark, sf):
    weights = profile.class_weights(documents(spark, sf), "lang")
    return weights.withColumn("weight", r6("weight"))


@query
def format_counts(spark, sf):
    return profile.format_counts(table(spark, sf, "part"), "p_brand")


@query
def dimension_stats(spark, sf):
    stats = profile.dimension_stats(table(spark, sf, "part"), ("p_size", "p_retailprice"))
    return stats.withColumns({c: r6(c) for c in ("mean_p_size", "mean_p_retailprice")})


@query
def distinct_combinations(spark, sf):
    return profile.distinct_combinations(table(spark, sf, "part"), ("p_size", "p_type"))


@query
def top_combinations(spark, sf):
    return profile.top_combinations(table(spark, sf, "part"), ("p_size", "p_type"), 10)


@query
def verified_ratio(spark, sf):
    found = profile.verified_ratio(table(spark, sf, "labels"), F.col("quality") == 1)
    return found.withColumn("ratio", r6("ratio"))


@query
def first_k(spark, sf):
    return profile.first_k(documents(spark, sf, "doc_id", "lang"), ["doc_id"], 10)


@query
def audit_summary(spark, sf):
    files = documents(spark, sf, "doc_id", "text", "lang", "n_chars").select(
        "doc_id", "lang", "n_chars", hashing.content_digest("text").alias("digest")
    )
    return profile.audit_summary(
        table(spark, sf, "labels"), files, key="doc_id", digest="digest",
        readable=F.col("n_chars") > 0, dimensions=("p_size", "p_type"),
        dimension_files=table(spark, sf, "part"),
    )


# --- reconciliation -------------------------------------------------------------------------


@query
def missing_refs(spark, sf):
    return reconcile.missing_refs(*order_refs(spark, sf), key="order_key")


@query
def extra_files(spark, sf):
    return reconcile.extra_files(table(spark, sf, "labels"), documents(spark, sf, "doc_id"), key="doc_id")


@query
def existing_refs(spark, sf):
    return reconcile.existing_refs(*order_refs(spark, sf), key="order_key")


@query
def existing_refs_hot(spark, sf):
    """Line items whose order exists, with keys of more than five rows dealt into parts."""
    orders, lines = order_refs(spark, sf)
    return reconcile.existing_refs(lines, orders, key="order_key", hot_rows=5)


@query
def reconcile_summary(spark, sf):
    return reconcile.reconcile_summary(*order_refs(spark, sf), key="order_key")


@query
def attach_metadata(spark, sf):
    files = table(spark, sf, "labels").withColumn("verified", F.lit(True))
    return reconcile.attach_file_metadata(documents(spark, sf, "doc_id", "lang", "n_chars"), files, key="doc_id")


@query
def vocabulary_diff(spark, sf):
    return reconcile.vocabulary_diff(documents(spark, sf), "lang", ["en", "fr", "de", "it"])


# --- labels ---------------------------------------------------------------------------------


@query
def canonicalise_labels(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return project.canonicalise(labels, "quality", QUALITY)


@query
def with_provenance(spark, sf):
    constants = {"collection": "synthetic_web", "country": "none", "region": None}
    return project.with_provenance(documents(spark, sf, "doc_id", "source"), constants)


@query
def encode_labels(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return project.encode_labels(events, "event_type", EVENT_TYPES)


@query
def decode_labels(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label")
    return project.decode_labels(rows, "label", DIGIT_NAMES)


@query
def label_display(spark, sf):
    return project.label_display(documents(spark, sf, "doc_id", "lang"), "lang", LANG_REGISTRY)


@query
def filter_class(spark, sf):
    return project.filter_class(table(spark, sf, "embeddings").select("vec_id", "label"), "label", 3)


@query
def label_map_entries(spark, sf):
    """The JSON properties of all events, turned into number → name maps and counted by entry."""
    turned = F.regexp_replace("props", r'"k": (\d+)', '"$1": "k"')
    events = table(spark, sf, "events").select(turned.alias("props"))
    return tables.parse_label_map(events, "props").groupBy("source_label", "name").agg(
        F.count(F.lit(1)).alias("n")
    )


# --- manifests and committed tables ----------------------------------------------------------


MANIFEST = "doc_id bigint, quality int"


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of documents as CSV lines in the shared folder, three tenths of them at fault, read back."""
    key = F.col("doc_id").cast("string")
    last = F.pmod("doc_id", F.lit(10))
    line = (
        F.when(last == 3, F.concat(key, F.lit(",high")))
        .when(last == 5, F.concat_ws(",", key, F.col("quality").cast("string"), F.lit("x")))
        .when(last == 7, key)
        .otherwise(F.concat_ws(",", key, F.col("quality").cast("string")))
    )
    path = shared_folder(spark, "manifest")
    table(spark, sf, "labels").select(line.alias("value")).write.text(path)
    return tables.read_manifest(spark, path, MANIFEST, header=False)


@query
def scan_manifest(spark, sf):
    return tables.good_rows(manifest(spark, sf))


@query
def manifest_rejects(spark, sf):
    return tables.manifest_rejects(manifest(spark, sf)).select("line", "reason")


@query
def write_table(spark, sf):
    """All documents but a third as version 1, all as version 2, and version 3 without its commit."""
    docs = documents(spark, sf)
    path = f"{shared_folder(spark, 'versions')}/documents"
    versions.write_version(docs.where(F.pmod("doc_id", F.lit(3)) != 0), path)
    versions.write_version(docs, path, partition_by=("lang",))
    docs.where("lang = 'en'").write.parquet(f"{path}/v00000003-unfinished")
    return versions.read_version(spark, path, check=True)


@query
def table_versions(spark, sf):
    """Rows of each committed version of the same table."""
    docs = documents(spark, sf, "doc_id", "lang")
    path = f"{shared_folder(spark, 'versions')}/documents"
    versions.write_version(docs.where(F.pmod("doc_id", F.lit(3)) != 0), path)
    versions.write_version(docs, path)
    return versions.commits(spark, path).select("version", "n_rows")


def registries(spark: SparkSession, sf: str) -> DataFrame:
    """key, record: registry files of up to 20 suppliers each, as nested records; accounts of one nation are
    texts and suppliers of one nation have no owner."""
    balance = F.col("s_acctbal").cast("double")
    record = F.to_json(F.struct(
        F.col("s_name").alias("source_dataset"),
        F.struct(
            F.when(F.col("s_nationkey") == 7, F.format_string("%.2f", balance)).alias("as_text"),
            F.when(F.col("s_nationkey") != 7, F.col("s_suppkey")).alias("number"),
        ).alias("account"),
        F.when(F.col("s_nationkey") != 3, F.array(F.concat(F.lit("owner of "), F.col("s_name")))).alias("original_owner"),
    ))
    entry = F.concat(F.lit('"'), F.col("s_suppkey").cast("string"), F.lit('": '), record)
    some = F.floor(F.col("s_suppkey") / 20)
    files = table(spark, sf, "supplier").groupBy(some.alias("file")).agg(F.array_join(F.array_sort(F.collect_list(entry)), ", ").alias("entries"))
    text = F.concat(F.lit('{"datasets": {'), F.col("entries"), F.lit("}}"))
    path = shared_folder(spark, "registries")
    files.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return tables.registry_entries(spark, path)


@query
def registry_tables(spark, sf):
    fields = {"source_dataset": "string", "account.number": "bigint", "original_owner": "array<string>"}
    found = tables.typed_registry(registries(spark, sf), fields)
    return found.select(F.col("key").cast("bigint").alias("key"), "source_dataset", "account_number", F.get("original_owner", F.lit(0)).alias("first_owner"))


@query
def rule_field_types_nested(spark, sf):
    types = {"source_dataset": "STRING", "account.number": "BIGINT", "account.as_text": "STRING", "original_owner": "ARRAY<STRING>"}
    return rules.field_types(registries(spark, sf), "record", types)


@query
def rule_field_types(spark, sf):
    """Types of the properties of all events."""
    events = table(spark, sf, "events").select(F.try_parse_json("props").alias("record"))
    return rules.field_types(events, "record", {"k": "BIGINT", "v": "STRING"})


# --- splits, samples, batches ---------------------------------------------------------------


@query
def stratified_split(spark, sf):
    return split_documents(spark, sf)


@query
def stratified_group_split(spark, sf):
    """Documents with all near copies of a text in one split."""
    of = near_dup_clusters(spark, sf).select("doc_id", "cluster")
    docs = documents(spark, sf, "doc_id", "lang").join(of, "doc_id", "left")
    return split.stratified_group_split(docs, key="doc_id", label="lang", group="cluster")


@query
def read_split(spark, sf):
    path = shared_folder(spark, "splits")
    tables.write_splits(split_documents(spark, sf), path)
    return tables.read_split(spark, path, "train").drop("split")


@query
def read_split_csv(spark, sf):
    path = shared_folder(spark, "splits")
    tables.write_splits(split_documents(spark, sf), path, fmt="csv")
    schema = "doc_id bigint, lang string"
    return tables.read_split(spark, path, "train", fmt="csv", schema=schema).drop("split")


@query
def split_overlap(spark, sf):
    """By content digest, so that copies in different splits show."""
    rows = split_documents(spark, sf, "text").select(hashing.content_digest("text").alias("digest"), "split")
    return split.split_overlap(rows, key="digest")


@query
def split_overlap_new_keys(spark, sf):
    """A fifth of the documents as new ones: texts that the splits of the others hold already, found by a
    stored filter of their digests."""
    rows = split_documents(spark, sf, "text").select("doc_id", hashing.content_digest("text").alias("digest"), "split")
    is_new = F.pmod("doc_id", F.lit(5)) == 0
    stored = rows.where(~is_new)
    bits = keyfilter.bits_for(stored.count())
    path = shared_folder(spark, "key-filter")
    keyfilter.key_filter(stored, "digest", bits).write.parquet(path)
    new = rows.where(is_new).select("digest")
    return keyfilter.overlap_of_new_keys(new, stored, spark.read.parquet(path), key="digest", split="split", bits=bits)


@query
def split_coverage(spark, sf):
    return split.split_coverage(split_documents(spark, sf), key="doc_id")


@query
def split_distribution(spark, sf):
    shares = split.split_distribution(split_documents(spark, sf), label="lang")
    return shares.select("lang", *[r6(c).alias(c) for c in shares.columns if c != "lang"])


@query
def class_coverage(spark, sf):
    return split.class_coverage(split_documents(spark, sf), label="lang", vocab=["de", "en", "fr", "it"])


@query
def sample_per_class(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label")
    return sampling.sample_per_class(rows, key="vec_id", label="label", n=8)


@query
def assign_batches(spark, sf):
    """Evaluation order and the order of training epoch 0."""
    docs = documents(spark, sf, "doc_id")
    ordered = batches.assign_batches(docs, key="doc_id", batch_size=32)
    shuffled = batches.assign_batches(docs, key="doc_id", batch_size=32, shuffle=True)
    return ordered.select("doc_id", "position", "batch_id").join(
        shuffled.toDF("doc_id", "train_position", "train_batch_id"), "doc_id"
    )


def batch_files(spark: SparkSession, sf: str) -> str:
    """The training batches of all documents, written in shards of four batches."""
    path = f"{shared_folder(spark, 'batches')}/epoch-0"
    docs = documents(spark, sf, "doc_id", "lang")
    batches.write_batches(docs, path, key="doc_id", batch_size=32, batches_per_shard=4, shuffle=True)
    return path


@query
def write_batches(spark, sf):
    return spark.read.parquet(batch_files(spark, sf))


@query
def resume_batches(spark, sf):
    return batches.resume_batches(spark, batch_files(spark, sf), batch_id=13, batches_per_shard=4)


@query
def batch_summary(spark, sf):
    return batches.batch_summary(split_documents(spark, sf), split="split", batch_size=32)


# --- vectors --------------------------------------------------------------------------------


@query
def vector_stats(spark, sf):
    stats = vectors.vector_stats("embedding").alias("s")
    return table(spark, sf, "embeddings").select("vec_id", stats).select(
        "vec_id", *[r6(F.col(f"s.{c}")).alias(f"{c}_value") for c in ("min", "max", "mean", "std")]
    )


@query
def channel_normalise(spark, sf):
    """Values in whole millionths, joined to one string per vector."""
    scaled = F.transform(
        vectors.channel_normalise("embedding", MEAN, STD),
        lambda x: F.round(x * 1000000).cast("bigint").cast("string"),
    )
    return table(spark, sf, "embeddings").select("vec_id", F.array_join(scaled, ",").alias("vec"))


@query
def augmentation_plan(spark, sf):
    plan = pixels.augmentation_plan(documents(spark, sf, "doc_id"), key="doc_id")
    doubles = [name for name, kind in plan.dtypes if kind == "double"]
    return plan.withColumns({c: r6(c) for c in doubles})


def pictures(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding as a grey picture of 8 x 8 pixels, in the shape of decoded images."""
    pixel = lambda x: F.floor(F.lit(128.0) + F.lit(64.0) * x.cast("double"))
    byte = lambda x: F.lpad(F.hex(F.least(F.greatest(pixel(x), F.lit(0)), F.lit(255))), 2, "0")
    digits = F.array_join(F.transform("embedding", byte), "")
    rows = spread(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id")
    return rows.select(
        "vec_id", F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("n_channels"),
        F.unhex(digits).alias("data"),
    )


def chunk(kind: str, data: Column) -> Column:
    """A PNG chunk in hexadecimal: length, kind, data and their checksum."""
    body = F.concat(F.lit(kind.encode().hex().upper()), data)
    size = F.lpad(F.hex(F.octet_length(data) / 2), 8, "0")
    return F.concat(size, body, F.lpad(F.hex(F.crc32(F.unhex(body))), 8, "0"))


def picture_files(spark: SparkSession, sf: str) -> DataFrame:
    """key, length, content: embeddings as files of four kinds, by number: a grey PNG of 8 x 8 pixels, the
    headers of a JPEG behind a segment of some length, a PNG without its end, and other bytes."""
    pixels_of = F.transform("embedding", lambda x: F.least(F.greatest(F.floor(F.lit(128.0) + F.lit(64.0) * x.cast("double")), F.lit(0)), F.lit(255)))
    rows = table(spark, sf, "embeddings").select("vec_id", pixels_of.alias("p"))
    two = lambda v: F.lpad(F.hex(v), 2, "0")
    # Each of the 8 lines has a byte for its filter before its pixels, 72 bytes in all.
    lines = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.concat(
        F.lit("00"), F.array_join(F.transform(F.slice("p", r * 8 + 1, 8), two), "")))
    ones = F.aggregate("p", F.lit(1).cast("bigint"), lambda total, v: total + v)
    place = lambda i: F.lit(72) - F.lit(9) * F.floor(i / 8) - 1 - i % 8
    weighed = F.aggregate(F.transform("p", lambda v, i: v * place(i)), F.lit(72).cast("bigint"), lambda total, v: total + v)
    check = F.concat(F.lpad(F.hex(weighed % 65521), 4, "0"), F.lpad(F.hex(ones % 65521), 4, "0"))
    stored = F.concat(F.lit("7801014800B7FF"), F.array_join(lines, ""), check)
    head = F.concat(F.lit(packed.PNG_SIGNATURE.hex().upper()), chunk("IHDR", F.lit("00000008000000080800000000")))
    open_png = F.concat(head, chunk("IDAT", stored))
    size = F.concat(F.lpad(F.hex(8 + F.col("vec_id") % 50), 4, "0"), F.lpad(F.hex(16 + F.col("vec_id") % 100), 4, "0"))
    more = (F.col("vec_id") % 7).cast("int")
    segment = F.concat(F.lit("FFE0"), F.lpad(F.hex(2 + more), 4, "0"), F.repeat(F.lit("FF"), more))
    jpeg = F.concat(F.lit("FFD8"), segment, F.lit("FFC0000B08"), size, F.lit("01011100FFD9"))
    kind = F.col("vec_id") % 4
    content = (
        F.when(kind == 0, F.concat(open_png, chunk("IEND", F.lit("")))).when(kind == 1, jpeg).when(kind == 2, open_png)
        .otherwise(F.array_join(F.transform("p", two), ""))
    )
    files = rows.select(F.format_string("%010d.img", "vec_id").alias("key"), F.unhex(content).alias("content"))
    return files.select("key", F.octet_length("content").cast("bigint").alias("length"), "content")


def packed_pictures(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "pictures")
    packed.pack_files(picture_files(spark, sf), path, target_bytes=4096)
    return packed.packed_files(spark, path)


@query
def scan_image_files(spark, sf):
    return packed_pictures(spark, sf).select("key", "length", "shard")


@query
def image_integrity(spark, sf):
    return packed.header_integrity(packed_pictures(spark, sf))


@query
def image_hash64(spark, sf):
    return pixels.image_hash64(pictures(spark, sf), key="vec_id")


def model_inputs(spark: SparkSession, sf: str, **options) -> DataFrame:
    """The 3 x 224 x 224 model input of every picture."""
    rows = table(spark, sf, "embeddings").select("vec_id", "label")
    return pixels.preprocess_eval(
        rows, pictures(spark, sf), split="test", key="vec_id", files=rows.select("vec_id"), **options
    )


def four_stats(inputs: DataFrame, n: Column, stats: str) -> DataFrame:
    return inputs.select(
        "vec_id", "label", n.alias("n"), *[r6(F.col(f"{stats}.{c}")).alias(f"{c}_value") for c in ("min", "max", "mean", "std")]
    )


@query
def preprocess_eval(spark, sf):
    """Statistics of the model inputs, made with them."""
    return four_stats(model_inputs(spark, sf, stats=True), F.col("stats.n"), "stats")


@query
def preprocess_eval_long(spark, sf):
    """The same from the vectors, by the way for manifests above the broadcast bound."""
    inputs = model_inputs(spark, sf, max_broadcast_rows=0).withColumn("s", vectors.vector_stats("vec"))
    return four_stats(inputs, F.size("vec"), "s")


# --- rules ----------------------------------------------------------------------------------


@query
def rule_not_null(spark, sf):
    return rules.check(labelled(spark, sf), rules.not_null("quality"))


@query
def rule_row_count(spark, sf):
    return rules.check(documents(spark, sf), rules.row_count(1000))


@query
def rule_single_value(spark, sf):
    return rules.check(documents(spark, sf), rules.single_value("lang", "en"))


@query
def rule_label_range(spark, sf):
    return rules.check(table(spark, sf, "embeddings"), rules.label_range("label", 10))


@query
def rule_vector_shape(spark, sf):
    return rules.check(table(spark, sf, "embeddings"), rules.vector_shape("embedding", (64,)))


@query
def rule_finite(spark, sf):
    return rules.check(table(spark, sf, "embeddings"), rules.finite("embedding"))


@query
def rule_alignment(spark, sf):
    return rules.alignment(documents(spark, sf), table(spark, sf, "labels"), key="doc_id")


@query
def rule_bijection(spark, sf):
    """The names of embedding labels, as decoded row by row."""
    return rules.bijection(decode_labels(spark, sf), name="class_name", index="label", size=10)


@query
def rule_required_fields(spark, sf):
    return rules.required_fields(table(spark, sf, "events"), "props", ["k", "v"])


@query
def rule_unique_key(spark, sf):
    return rules.unique_key(documents(spark, sf), "doc_id")


@query
def rule_determinism(spark, sf):
    """The split of all documents, computed from two different partitionings."""
    docs = documents(spark, sf, "doc_id", "lang")
    runs = [
        split.stratified_split(docs.repartition(n), key="doc_id", label="lang") for n in (3, 16)
    ]
    return rules.determinism(*runs)


@query
def determinism_diff(spark, sf):
    """Documents whose split changes with the seed of the split, one row each."""
    docs = documents(spark, sf, "doc_id", "lang")
    runs = [split.stratified_split(docs, key="doc_id", label="lang", seed=s) for s in (42, 43)]
    return rules.determinism_diff(*runs, key="doc_id")


@query
def bucket_fingerprints(spark, sf):
    """Rows per bucket, as all rows of line items are dealt to buckets by their hash, and whether the
    fingerprints of two partitionings agree."""
    lines = table(spark, sf, "lineitem")
    a = fingerprint.table_fingerprint(lines).toDF("n_rows", "fingerprint_a")
    # As many partitions as the scan has, which grow with the table; all of a row deals it, so none is hot.
    parts = max(5, lines.rdd.getNumPartitions())
    b = fingerprint.table_fingerprint(lines.repartition(parts, *lines.columns)).toDF("n_again", "fingerprint_b")
    return one_row(a, b).select("n_rows", "n_again", (F.col("fingerprint_a") == F.col("fingerprint_b")).alias("equal"))


@query
def rule_epochs_differ(spark, sf):
    """Augmentation draws of two epochs: the rows that are not in both."""
    docs = documents(spark, sf, "doc_id")
    draws = [
        pixels.augmentation_plan(docs, key="doc_id", epoch=e).select("doc_id", r6("angle").alias("angle"))
        for e in (0, 1)
    ]
    return rules.determinism(*draws, name="epochs_differ", equal=False)


def document_rules(docs: DataFrame) -> list[rules.Rule]:
    return [
        rules.required_columns(docs, ["doc_id", "text", "lang", "source"]),
        rules.column_type(docs, "quality", "int"),
        rules.not_null("lang"),
        rules.not_null("quality"),
        rules.row_count(1000),
        rules.vocabulary("lang", LANGS),
        rules.vocabulary("quality", [0, 1], ignore_nulls=True),
        rules.vocabulary("quality", [0, 1], mode="subset"),
        rules.label_range("toxic", 2),
    ]


@query
def validation_report(spark, sf):
    docs = labelled(spark, sf, "doc_id", "text", "lang", "source", "n_chars")
    return rules.validation_report(docs, document_rules(docs))


@query
def validation_report_merged(spark, sf):
    """The same report from the stored states of four shards, the last of them appended later."""
    docs = labelled(spark, sf, "doc_id", "text", "lang", "source", "n_chars")
    path = shared_folder(spark, "rule-states")
    for shards in ([0, 1, 2], [3]):
        for shard in shards:
            own = docs.where(F.pmod("doc_id", F.lit(4)) == shard)
            rules.rule_states(own, document_rules(docs)).write.mode("append").parquet(path)
    return rules.merged_report(spark.read.parquet(path), document_rules(docs))


# --- metrics --------------------------------------------------------------------------------


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Quality as truth, null for documents without labels. Its prediction is absence of toxicity,
    null for one language and a class of its own for another."""
    guess = F.when(F.col("lang") == "fr", 2).when(F.col("lang") != "de", 1 - F.coalesce("toxic", F.lit(0)))
    return labelled(spark, sf).select(F.col("quality").alias("truth"), guess.alias("prediction"))


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(predictions(spark, sf), truth="truth", pred="prediction", vocab=[0, 1])


@query
def accuracy(spark, sf):
    found = metrics.accuracy(predictions(spark, sf), truth="truth", pred="prediction")
    return found.select(r6("accuracy").alias("accuracy"))


@query
def precision_recall(spark, sf):
    found = metrics.precision_recall(predictions(spark, sf), truth="truth", pred="prediction", vocab=[0, 1])
    return found.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query
def macro_f1(spark, sf):
    found = metrics.macro_f1(predictions(spark, sf), truth="truth", pred="prediction", vocab=[0, 1])
    return found.select(r6("macro_f1").alias("macro_f1"))
