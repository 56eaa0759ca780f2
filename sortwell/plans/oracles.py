"""The registered queries as plain SQL for an independent engine."""

from __future__ import annotations

# Text hash: every distinct token votes on 64 bits; half of the 64 bits of its digest at a time.
FP = r"""
tok AS (
  SELECT DISTINCT doc_id,
    unnest(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' ')) AS t
  FROM documents),
digest AS (
  SELECT doc_id, ('0x' || substr(md5(t), 1, 8))::BIGINT AS hi, ('0x' || substr(md5(t), 9, 8))::BIGINT AS lo
  FROM tok WHERE t <> ''),
vote AS (
  SELECT doc_id, b, count(*) AS n,
    sum(CASE WHEN b >= 32 THEN (hi >> (b - 32)) & 1 ELSE (lo >> b) & 1 END) AS c
  FROM digest, (SELECT range::INTEGER AS b FROM range(64)) GROUP BY doc_id, b),
packed AS (
  SELECT doc_id,
    sum(CASE WHEN 2 * c > n AND b < 63 THEN (1::BIGINT << b)::HUGEINT ELSE 0 END) AS low63,
    max(CASE WHEN 2 * c > n AND b = 63 THEN 1 ELSE 0 END) AS sign
  FROM vote GROUP BY doc_id),
fp AS (
  SELECT d.doc_id,
    CASE WHEN sign = 1 THEN low63 - 9223372036854775808::HUGEINT ELSE low63 END::BIGINT AS fp
  FROM documents d LEFT JOIN packed p ON d.doc_id = p.doc_id),
hashed AS (SELECT doc_id, fp FROM fp WHERE fp IS NOT NULL)"""

GROUPS = """
g AS (SELECT fp, min(doc_id) AS first_key, count(*) AS n_keys FROM hashed GROUP BY fp)"""

PAIRS = """
near AS (
  SELECT a.fp AS fp_a, b.fp AS fp_b, a.first_key AS ka, b.first_key AS kb,
    a.n_keys AS na, b.n_keys AS nb, bit_count(xor(a.fp, b.fp))::INTEGER AS d
  FROM g a JOIN g b ON a.fp < b.fp AND bit_count(xor(a.fp, b.fp)) <= 5)"""

# Clusters: the smallest first key that chains of near pairs reach.
CLUSTERS = """
edge AS (SELECT fp_a AS x, fp_b AS y FROM near UNION ALL SELECT fp_b, fp_a FROM near),
reach AS (SELECT fp AS x, fp AS y FROM g UNION SELECT reach.x, edge.y FROM reach JOIN edge ON reach.y = edge.x),
home AS (
  SELECT reach.x AS fp, min(g.first_key) AS cluster, sum(g.n_keys)::BIGINT AS cluster_size
  FROM reach JOIN g ON g.fp = reach.y GROUP BY reach.x),
linked AS (
  SELECT fp, sum(n) AS n FROM (SELECT fp_a AS fp, nb AS n FROM near UNION ALL SELECT fp_b, na FROM near) GROUP BY fp),
clustered AS (
  SELECT doc_id, cluster, cluster_size, (coalesce(linked.n, 0) + g.n_keys - 1)::BIGINT AS n_links
  FROM hashed JOIN home ON home.fp = hashed.fp JOIN g ON g.fp = hashed.fp LEFT JOIN linked ON linked.fp = hashed.fp)"""

STAR_AND_PAIRS = """
rel AS (
  SELECT first_key AS key_a, doc_id AS key_b, 0::INTEGER AS hash_distance
  FROM fp JOIN g ON fp.fp = g.fp WHERE doc_id <> first_key
  UNION ALL
  SELECT least(ka, kb), greatest(ka, kb), d FROM near)"""

# Stratified 70/15/15 split of documents by lang, whole-number largest remainders.
SP = """
cls AS (SELECT lang, count(*) AS n_c FROM documents GROUP BY lang),
tot AS (SELECT count(*) AS n, (30 * count(*) + 99) // 100 AS tmp FROM documents),
q1 AS (SELECT lang, tmp, (n_c * tmp) // n AS f, (n_c * tmp) % n AS r FROM cls, tot),
q2 AS (
  SELECT lang, tmp, f + CASE WHEN row_number() OVER (ORDER BY r DESC, lang) <= tmp - sum(f) OVER ()
    THEN 1 ELSE 0 END AS kt FROM q1),
q3 AS (
  SELECT lang, kt, (tmp + 1) // 2 AS places, (kt * ((tmp + 1) // 2)) // tmp AS f,
    (kt * ((tmp + 1) // 2)) % tmp AS r FROM q2),
q4 AS (
  SELECT lang, kt, f + CASE WHEN row_number() OVER (ORDER BY r DESC, lang) <= places - sum(f) OVER ()
    THEN 1 ELSE 0 END AS kx FROM q3),
ranked AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rn
  FROM documents),
sp AS (
  SELECT doc_id, ranked.lang,
    CASE WHEN rn <= kx THEN 'test' WHEN rn <= kt THEN 'validation' ELSE 'train' END AS split
  FROM ranked JOIN q4 ON ranked.lang = q4.lang)"""

# The same quotas by majority class of the clusters, met by whole clusters.
GROUP_SP = """
member AS (
  SELECT d.doc_id, d.lang, coalesce('g:' || cluster, 'k:' || d.doc_id) AS grp
  FROM documents d LEFT JOIN clustered c ON c.doc_id = d.doc_id),
per AS (SELECT grp, lang, count(*) AS n FROM member GROUP BY grp, lang),
weighed AS (SELECT grp, first(lang ORDER BY n DESC, lang) AS lang, sum(n)::BIGINT AS w FROM per GROUP BY grp),
cls AS (SELECT lang, sum(w)::BIGINT AS n_c FROM weighed GROUP BY lang),
tot AS (SELECT count(*) AS n, (30 * count(*) + 99) // 100 AS tmp FROM documents),
q1 AS (SELECT lang, tmp, (n_c * tmp) // n AS f, (n_c * tmp) % n AS r FROM cls, tot),
q2 AS (
  SELECT lang, tmp, f + CASE WHEN row_number() OVER (ORDER BY r DESC, lang) <= tmp - sum(f) OVER ()
    THEN 1 ELSE 0 END AS kt FROM q1),
q3 AS (
  SELECT lang, kt, (tmp + 1) // 2 AS places, (kt * ((tmp + 1) // 2)) // tmp AS f,
    (kt * ((tmp + 1) // 2)) % tmp AS r FROM q2),
q4 AS (
  SELECT lang, kt, f + CASE WHEN row_number() OVER (ORDER BY r DESC, lang) <= places - sum(f) OVER ()
    THEN 1 ELSE 0 END AS kx FROM q3),
started AS (
  SELECT grp, kx, kt, sum(w) OVER (PARTITION BY weighed.lang ORDER BY
    w > coalesce(least(CASE WHEN kx > 0 THEN kx END, CASE WHEN kt > kx THEN kt - kx END), 0), md5('42:' || grp), grp) - w AS s
  FROM weighed JOIN q4 ON weighed.lang = q4.lang),
gsp AS (
  SELECT doc_id, lang, cluster, CASE WHEN s < kx THEN 'test' WHEN s < kt THEN 'validation' ELSE 'train' END AS split
  FROM member JOIN started ON started.grp = member.grp LEFT JOIN (SELECT doc_id AS id, cluster FROM clustered) ON id = doc_id)"""

# Files of four kinds, made from embeddings: sizes of their segments added up.
FILES = """SELECT vec_id, vec_id % 4 AS k, printf('%010d.img', vec_id) AS key,
  (CASE vec_id % 4 WHEN 0 THEN 8 + 25 + 95 + 12 WHEN 1 THEN 2 + 4 + vec_id % 7 + 13 + 2 WHEN 2 THEN 8 + 25 + 95 ELSE 64 END)::BIGINT AS length
FROM embeddings"""

# Training batches of 32 in shards of four batches.
BATCHES = """SELECT doc_id, lang, position, position // 32 AS batch_id, (position // 128)::INTEGER AS shard
FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY md5('42:0:' || doc_id), doc_id) - 1 AS position FROM documents)"""

LABELLED = """
lab AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


PICTURES = """
px AS (SELECT vec_id, (i - 1) // 8 AS y, (i - 1) % 8 AS x,
    greatest(0, least(255, floor(128.0::DOUBLE + 64.0::DOUBLE * embedding[i]::DOUBLE))) AS v
  FROM embeddings, (SELECT range AS i FROM range(1, 65)))"""

# The same split again, ranks counted from rows in another order.
SP_AGAIN = """
again AS (
  SELECT doc_id, r.lang,
    CASE WHEN rn <= kx THEN 'test' WHEN rn <= kt THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rn
        FROM (SELECT * FROM documents ORDER BY reverse(doc_id::VARCHAR))) r
  JOIN q4 ON r.lang = q4.lang)"""

# The split with another seed; the quotas are the same.
SP_OTHER = """
other AS (
  SELECT doc_id, CASE WHEN rn <= kx THEN 'test' WHEN rn <= kt THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('43:' || doc_id), doc_id) AS rn
        FROM documents) r
  JOIN q4 ON r.lang = q4.lang)"""

PRED = """
p AS (
  SELECT quality AS truth,
    CASE WHEN lang = 'fr' THEN 2 WHEN lang <> 'de' THEN 1 - coalesce(toxic, 0) END AS prediction
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
v AS (SELECT unnest([0, 1])::INTEGER AS c),
f AS (
  SELECT v.c AS class,
    (SELECT count(*) FROM p WHERE truth = v.c) AS support,
    (SELECT count(*) FROM p WHERE prediction = v.c) AS predicted,
    (SELECT count(*) FROM p WHERE truth = v.c AND prediction = v.c) AS hits
  FROM v)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _band(i: int) -> str:
    return f"((fp >> {56 - 8 * i}) & 255)"


def _uniform(name: str, epoch: int = 0) -> str:
    return f"(('0x' || substr(md5('42:{epoch}:{name}:' || doc_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0)"


def _between(name: str, low: float, high: float, epoch: int = 0) -> str:
    return f"({low!r}::DOUBLE + {_uniform(name, epoch)} * {high - low!r}::DOUBLE)"


def _rule(name: str, expected: str, observed: str, passed: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS rule, '{expected}' AS expected, "
        f"({observed})::VARCHAR AS observed, ({passed}) AS passed FROM {source}"
    )


def _none(name: str, failing: str, source: str) -> str:
    n = f"count(*) FILTER (WHERE {failing})"
    return _rule(name, "0", n, f"{n} = 0", source)


def _vocabulary(name: str, col: str, values: list[str], source: str, nulls: str, absent: bool = True) -> str:
    listed = ", ".join(values)
    outside = f"count(*) FILTER (WHERE coalesce({col} NOT IN ({listed}), {nulls}))"
    missing = f"({len(values)} - count(DISTINCT {col}) FILTER (WHERE {col} IN ({listed})))" if absent else "0"
    expected = "0 rows outside, 0 values absent"
    observed = f"{outside} || ' rows outside, ' || {missing} || ' values absent'"
    return _rule(name, expected, observed, f"{outside} = 0 AND {missing} = 0", source)


ALL_BANDS_PAIR = " OR ".join(
    f"((a.fp >> {s}) & 255) = ((b.fp >> {s}) & 255)" for s in range(56, -8, -8)
)

ORACLES: dict[str, str] = {
    # hashes and near duplicates
    "text_hash64": _with(FP) + "SELECT doc_id, fp FROM fp",
    "near_duplicates": _with(FP, GROUPS, PAIRS, STAR_AND_PAIRS) + "SELECT key_a, key_b, hash_distance FROM rel",
    "sort_pairs": _with(FP, GROUPS, PAIRS, STAR_AND_PAIRS)
    + "SELECT key_a, key_b, hash_distance FROM rel ORDER BY hash_distance, key_a, key_b",
    "near_dup_candidates": _with(FP)
    + "SELECT band, chunk, count(*) AS n_keys, (count(*) * (count(*) - 1) / 2)::DOUBLE AS n_pairs FROM ("
    + " UNION ALL ".join(f"SELECT {i}::INTEGER AS band, {_band(i)} AS chunk FROM hashed" for i in range(8))
    + ") GROUP BY band, chunk",
    "near_dup_summary": _with(FP)
    + "SELECT (SELECT count(*) FROM hashed) AS n_hashed,"
    " (SELECT count(*) FROM fp WHERE fp IS NULL) AS n_unhashed,"
    " (SELECT count(*) FROM (SELECT fp FROM hashed GROUP BY fp HAVING count(*) > 1)) AS n_exact_groups,"
    " (SELECT count(*) FROM hashed a JOIN hashed b ON a.doc_id < b.doc_id"
    " WHERE bit_count(xor(a.fp, b.fp)) <= 5)::DOUBLE AS n_near_pairs",
    "near_dup_candidate_pairs": _with(FP)
    + "SELECT count(*)::DOUBLE AS n_candidates"
    f" FROM hashed a JOIN hashed b ON a.doc_id < b.doc_id WHERE {ALL_BANDS_PAIR}",
    "hash_groups": _with(FP)
    + "SELECT fp, min(doc_id) AS first_key, count(*) AS n_keys FROM hashed GROUP BY fp HAVING count(*) > 1",
    "hash_group_members": _with(FP, GROUPS)
    + "SELECT fp.doc_id, fp.fp, n_keys FROM fp JOIN g ON fp.fp = g.fp WHERE n_keys > 1",
    "near_dup_leakage": _with(
        FP, SP,
        "n AS (SELECT fp.fp, sp.split, min(fp.doc_id) AS k, count(*) AS c"
        " FROM hashed fp JOIN sp ON fp.doc_id = sp.doc_id GROUP BY fp.fp, sp.split)",
    )
    + "SELECT a.split AS split_a, a.k AS key_a, a.c AS n_a, b.split AS split_b, b.k AS key_b, b.c AS n_b,"
    " bit_count(xor(a.fp, b.fp))::INTEGER AS hash_distance"
    " FROM n a JOIN n b ON a.split < b.split AND bit_count(xor(a.fp, b.fp)) <= 5",
    "bit_bands": _with(FP) + "SELECT doc_id, " + ", ".join(f"{_band(i)} AS band_{i}" for i in range(8)) + " FROM fp",
    "parse_hash64": "SELECT doc_id, ((hi - CASE WHEN hi >= 2147483648 THEN 4294967296 ELSE 0 END)"
    " * 4294967296 + lo)::BIGINT AS hash FROM (SELECT doc_id,"
    " ('0x' || substr(md5(text), 1, 8))::BIGINT AS hi, ('0x' || substr(md5(text), 9, 8))::BIGINT AS lo FROM documents)",
    "hamming_distance": "WITH h AS (SELECT doc_id, ((hi - CASE WHEN hi >= 2147483648 THEN 4294967296 ELSE 0 END)"
    " * 4294967296 + lo)::BIGINT AS hash FROM (SELECT doc_id,"
    " ('0x' || substr(md5(text), 1, 8))::BIGINT AS hi, ('0x' || substr(md5(text), 9, 8))::BIGINT AS lo FROM documents))"
    " SELECT a.doc_id, bit_count(xor(a.hash, b.hash))::INTEGER AS hash_distance FROM h a JOIN h b ON b.doc_id = a.doc_id + 1",
    # exact duplicates
    "content_digest": "SELECT doc_id, md5(text) AS digest FROM documents",
    "exact_duplicates": "SELECT digest, first_key, doc_id AS duplicate_key FROM (SELECT doc_id, md5(text) AS digest,"
    " min(doc_id) OVER (PARTITION BY md5(text)) AS first_key FROM documents) WHERE doc_id <> first_key",
    "duplicate_keys": "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
    # profiles
    "table_profile": "SELECT count(*) AS n_rows, 7::INTEGER AS n_columns,"
    " 'doc_id,text,lang,source,n_chars,quality,toxic' AS columns FROM documents LEFT JOIN labels USING (doc_id)",
    "null_counts": "WITH lab AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))"
    + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM lab"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "class_counts": "SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang",
    "class_percentages": _with(LABELLED)
    + "SELECT quality, count(*) AS n,"
    " round(100.0::DOUBLE * count(*) / (SELECT count(quality) FROM lab), 6) AS pct_of_labelled,"
    " round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM lab), 6) AS pct_of_all"
    " FROM lab WHERE quality IS NOT NULL GROUP BY quality",
    "class_weights": "WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)"
    " SELECT lang, n, round(sqrt((SELECT sum(n)::DOUBLE / count(*) FROM c) / n), 6) AS weight FROM c",
    "format_counts": "SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand",
    "dimension_stats": "SELECT min(p_size) AS min_p_size, max(p_size) AS max_p_size, round(avg(p_size), 6) AS mean_p_size,"
    " min(p_retailprice) AS min_p_retailprice, max(p_retailprice) AS max_p_retailprice,"
    " round(avg(p_retailprice), 6) AS mean_p_retailprice FROM part",
    "distinct_combinations": "SELECT count(*) AS n_combinations FROM (SELECT DISTINCT p_size, p_type FROM part"
    " WHERE p_size IS NOT NULL AND p_type IS NOT NULL)",
    "top_combinations": "SELECT p_size, p_type, count(*) AS n FROM part GROUP BY p_size, p_type"
    " ORDER BY n DESC, p_size, p_type LIMIT 10",
    "verified_ratio": "SELECT count(*) FILTER (WHERE quality = 1) AS n_verified, count(*) AS n_rows,"
    " round(count(*) FILTER (WHERE quality = 1)::DOUBLE / count(*), 6) AS ratio,"
    " bool_and(coalesce(quality = 1, false)) AS all_verified FROM labels",
    "first_k": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 10",
    "audit_summary": "SELECT (SELECT count(*) FROM labels) AS n_records, (SELECT count(*) FROM documents) AS n_files,"
    " (SELECT count(*) FROM documents WHERE NOT coalesce(n_chars > 0, false)) AS n_unreadable,"
    " (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS n_missing,"
    " (SELECT count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS n_extra,"
    " (SELECT count(*) - count(DISTINCT md5(text)) FROM labels JOIN documents USING (doc_id)) AS n_duplicate_pairs,"
    " (SELECT count(*) FROM (SELECT DISTINCT p_size, p_type FROM part)) AS n_dimensions",
    # reconciliation
    "missing_refs": "SELECT DISTINCT o_orderkey AS order_key FROM orders"
    " WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "extra_files": "SELECT DISTINCT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "existing_refs": "SELECT o_orderkey AS order_key, o_orderpriority FROM orders"
    " WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "existing_refs_hot": "SELECT l_orderkey AS order_key FROM lineitem"
    " WHERE EXISTS (SELECT 1 FROM orders WHERE l_orderkey = o_orderkey)",
    "reconcile_summary": _with(
        "m AS (SELECT DISTINCT o_orderkey AS k FROM orders)", "f AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)",
        "j AS (SELECT m.k AS m, f.k AS f FROM m FULL JOIN f ON m.k = f.k)",
    )
    + "SELECT count(m) AS n_referenced, count(f) AS n_files, count(*) FILTER (WHERE f IS NULL) AS n_missing,"
    " count(*) FILTER (WHERE m IS NULL) AS n_extra FROM j",
    "attach_metadata": "SELECT d.doc_id, lang, n_chars, quality, toxic, l.doc_id IS NOT NULL AS verified"
    " FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
    "vocabulary_diff": "WITH v AS (SELECT unnest(['en', 'fr', 'de', 'it']) AS value)"
    " SELECT DISTINCT lang AS value, 'unexpected' AS status FROM documents WHERE lang NOT IN (SELECT value FROM v)"
    " UNION ALL SELECT value, 'absent' FROM v WHERE value NOT IN (SELECT lang FROM documents)",
    # labels
    "canonicalise_labels": "SELECT doc_id, quality, CASE quality WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS canonical_label FROM labels",
    "with_provenance": "SELECT doc_id, source, 'synthetic_web' AS collection, 'none' AS country, NULL::VARCHAR AS region FROM documents",
    "encode_labels": "SELECT event_id, event_type, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1"
    " WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END::INTEGER AS class_index FROM events",
    "decode_labels": "SELECT vec_id, label, ['zero', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine'][label + 1]"
    " AS class_name FROM embeddings",
    "label_display": "SELECT doc_id, lang, display_name, abbreviation, category FROM documents LEFT JOIN (VALUES"
    " ('de', 'German', 'GER', 'germanic'), ('en', 'English', 'ENG', 'germanic'), ('es', 'Spanish', 'SPA', 'romance'),"
    " ('fr', 'French', 'FRE', 'romance')) r(label, display_name, abbreviation, category) ON lang = label",
    "filter_class": "SELECT vec_id, label FROM embeddings WHERE label = 3",
    "label_map_entries": "SELECT (props->>'k')::INTEGER AS source_label, 'k' AS name, count(*) AS n FROM events"
    " WHERE (props->>'k') IS NOT NULL GROUP BY 1",
    # splits, samples, batches
    "near_dup_clusters": "WITH RECURSIVE " + ",".join([FP, GROUPS, PAIRS, CLUSTERS])
    + "\nSELECT doc_id, cluster, cluster_size, n_links FROM clustered",
    "stratified_group_split": "WITH RECURSIVE " + ",".join([FP, GROUPS, PAIRS, CLUSTERS, GROUP_SP])
    + "\nSELECT doc_id, lang, cluster, split FROM gsp",
    "stratified_split": _with(SP) + "SELECT doc_id, lang, split FROM sp",
    "read_split": _with(SP) + "SELECT doc_id, lang FROM sp WHERE split = 'train'",
    "split_overlap": _with(
        SP, "k AS (SELECT DISTINCT md5(text) AS h, split FROM sp JOIN documents USING (doc_id))",
        "w AS (SELECT * FROM (VALUES ('train', 'validation'), ('train', 'test'), ('validation', 'test')) w(split_a, split_b))",
    )
    + "SELECT split_a, split_b, (SELECT count(*) FROM k a JOIN k b ON a.h = b.h"
    " WHERE a.split = split_a AND b.split = split_b) AS n_shared FROM w",
    "split_coverage": _with(SP)
    + "SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_keys, count(*) = count(DISTINCT doc_id) AS complete FROM sp",
    "split_distribution": _with(SP, "n AS (SELECT split, count(*)::DOUBLE AS n FROM sp GROUP BY split)")
    + "SELECT lang, "
    + ", ".join(
        f"round(count(*) FILTER (WHERE split = '{s}') / (SELECT n FROM n WHERE split = '{s}'), 6) AS {s}_share"
        for s in ("train", "validation", "test")
    )
    + ", round(count(*)::DOUBLE / (SELECT sum(n) FROM n), 6) AS overall_share FROM sp GROUP BY lang",
    "class_coverage": _with(
        SP, "s AS (SELECT unnest(['train', 'validation', 'test']) AS split)",
        "v AS (SELECT unnest(['de', 'en', 'fr', 'it']) AS label)",
        "n AS (SELECT split, lang, count(*) AS n FROM sp GROUP BY split, lang)",
        "g AS (SELECT split, label FROM s CROSS JOIN v)",
    )
    + "SELECT coalesce(g.split, n.split) AS split, coalesce(g.label, n.lang) AS label, coalesce(n.n, 0) AS n,"
    " n.n IS NOT NULL AS covered, g.split IS NOT NULL AS listed"
    " FROM g FULL JOIN n ON n.split = g.split AND n.lang = g.label",
    "sample_per_class": "SELECT vec_id, label, place::INTEGER AS place FROM (SELECT vec_id, label,"
    " row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) AS place FROM embeddings) WHERE place <= 8",
    "scan_manifest": "SELECT doc_id, quality FROM labels WHERE doc_id % 10 NOT IN (3, 5, 7)",
    "manifest_rejects": "SELECT CASE doc_id % 10 WHEN 3 THEN doc_id || ',high' WHEN 5 THEN doc_id || ',' || quality || ',x'"
    " ELSE doc_id::VARCHAR END AS line, CASE doc_id % 10 WHEN 3 THEN 'quality is no int: high' WHEN 5 THEN 'too many fields'"
    " ELSE 'too few fields' END AS reason FROM labels WHERE doc_id % 10 IN (3, 5, 7)",
    "write_table": "SELECT * FROM documents",
    "table_versions": "SELECT 1::BIGINT AS version, count(*) FILTER (WHERE doc_id % 3 <> 0) AS n_rows FROM documents"
    " UNION ALL SELECT 2, count(*) FROM documents",
    "write_batches": BATCHES,
    "resume_batches": f"SELECT * FROM ({BATCHES}) WHERE batch_id >= 13",
    "scan_image_files": f"SELECT key, length, ((sum(length) OVER (ORDER BY key) - length) // 4096)::INTEGER AS shard FROM ({FILES})",
    "image_integrity": "SELECT key, length, CASE k WHEN 1 THEN 'JPEG' WHEN 3 THEN NULL ELSE 'PNG' END AS format,"
    " (CASE k WHEN 1 THEN 16 + vec_id % 100 WHEN 3 THEN NULL ELSE 8 END)::INTEGER AS width,"
    " (CASE k WHEN 1 THEN 8 + vec_id % 50 WHEN 3 THEN NULL ELSE 8 END)::INTEGER AS height,"
    f" CASE k WHEN 2 THEN 'incomplete file' WHEN 3 THEN 'unknown format' END AS error FROM ({FILES})",
    "registry_tables": "SELECT s_suppkey AS key, s_name AS source_dataset,"
    " CASE WHEN s_nationkey <> 7 THEN s_suppkey END AS account_number,"
    " CASE WHEN s_nationkey <> 3 THEN 'owner of ' || s_name END AS first_owner FROM supplier",
    "rule_field_types_nested": " UNION ALL ".join([
        _none("field_type:source_dataset:STRING", "s_name IS NULL", "supplier"),
        _none("field_type:account.number:BIGINT", "s_nationkey = 7", "supplier"),
        _none("field_type:account.as_text:STRING", "s_nationkey <> 7", "supplier"),
        _none("field_type:original_owner:ARRAY<STRING>", "s_nationkey = 3", "supplier"),
    ]),
    "rule_field_types": " UNION ALL ".join([
        _none("field_type:k:BIGINT", "coalesce(json_type(props, '$.k') NOT IN ('UBIGINT', 'BIGINT'), true)", "events"),
        _none("field_type:v:STRING", "coalesce(json_type(props, '$.v') <> 'VARCHAR', true)", "events"),
    ]),
    "assign_batches": "SELECT doc_id, position, position // 32 AS batch_id, train_position, train_position // 32 AS train_batch_id"
    " FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position,"
    " row_number() OVER (ORDER BY md5('42:0:' || doc_id), doc_id) - 1 AS train_position FROM documents)",
    "batch_summary": _with(SP, "b AS (SELECT split, (row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) // 32 AS b FROM sp)")
    + "SELECT split, count(*) AS n_samples, count(DISTINCT b) AS n_batches,"
    " count(*) FILTER (WHERE b = m) AS last_batch FROM (SELECT *, max(b) OVER (PARTITION BY split) AS m FROM b) GROUP BY split",
    # vectors
    "vector_stats": "SELECT vec_id, round(list_min(e), 6) AS min_value, round(list_max(e), 6) AS max_value,"
    " round(list_avg(e), 6) AS mean_value, round(list_stddev_samp(e), 6) AS std_value"
    " FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)",
    "channel_normalise": "SELECT vec_id, array_to_string([round((e[i] - [0.485::DOUBLE, 0.456, 0.406][((i - 1) * 3) // len(e) + 1])"
    " / [0.229::DOUBLE, 0.224, 0.225][((i - 1) * 3) // len(e) + 1] * 1000000)::BIGINT FOR i IN range(1, len(e) + 1)], ',') AS vec"
    " FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)",
    "augmentation_plan": "SELECT doc_id, "
    f"round({_between('crop_scale', 0.8, 1.0)}, 6) AS crop_scale, "
    f"round(exp(ln(0.9::DOUBLE) + {_uniform('crop_ratio')} * (ln(1.1::DOUBLE) - ln(0.9::DOUBLE))), 6) AS crop_ratio, "
    f"round({_uniform('crop_top')}, 6) AS crop_top, round({_uniform('crop_left')}, 6) AS crop_left, "
    f"{_uniform('horizontal_flip')} < 0.5 AS horizontal_flip, {_uniform('vertical_flip')} < 0.2 AS vertical_flip, "
    f"round({_between('angle', -15.0, 15.0)}, 6) AS angle, round({_between('brightness', 0.85, 1.15)}, 6) AS brightness, "
    f"round({_between('contrast', 0.85, 1.15)}, 6) AS contrast, round({_between('saturation', 0.9, 1.1)}, 6) AS saturation, "
    f"round({_between('hue', -0.02, 0.02)}, 6) AS hue FROM documents",
    # pictures
    "image_hash64": _with(
        PICTURES,
        """w0 AS (SELECT o, i, (i + 0.5::DOUBLE) - (o + 0.5::DOUBLE) / 4 AS d
          FROM (SELECT range AS o FROM range(32)), (SELECT range AS i FROM range(8)))""",
        """w1 AS (SELECT o, i, CASE WHEN d = 0 THEN 1 WHEN abs(d) < 3
          THEN sin(pi() * d) / (pi() * d) * sin(pi() * d / 3) / (pi() * d / 3) ELSE 0 END AS w FROM w0)""",
        "w AS (SELECT o, i, w / sum(w) OVER (PARTITION BY o) AS w FROM w1)",
        "a AS (SELECT vec_id, o AS y, x, sum(w * v) AS v FROM px JOIN w ON w.i = px.y GROUP BY ALL)",
        """small AS (SELECT vec_id, y, o AS x, greatest(0, least(255, round_even(sum(w * v), 0))) AS v
          FROM a JOIN w ON w.i = a.x GROUP BY vec_id, y, o)""",
        """c AS (SELECT k, i, 2 * cos(pi() * k * (2 * i + 1) / 64) AS c
          FROM (SELECT range AS k FROM range(8)), (SELECT range AS i FROM range(32)))""",
        "b AS (SELECT vec_id, k, x, sum(c * v) AS v FROM small JOIN c ON c.i = small.y GROUP BY ALL)",
        "low AS (SELECT vec_id, b.k, c.k AS l, sum(c * v) AS v FROM b JOIN c ON c.i = b.x GROUP BY ALL)",
        "bits AS (SELECT vec_id, 63 - (k * 8 + l) AS bit, v > median(v) OVER (PARTITION BY vec_id) AS is_set FROM low)",
    )
    + """SELECT vec_id, (sum(CASE WHEN is_set AND bit < 63 THEN (1::BIGINT << bit::INTEGER)::HUGEINT ELSE 0 END)
      - max(CASE WHEN is_set AND bit = 63 THEN 9223372036854775808::HUGEINT ELSE 0 END))::BIGINT AS hash
      FROM bits GROUP BY vec_id""",
    "preprocess_eval": _with(
        PICTURES,
        """w AS (SELECT o, i, greatest(0, 1 - abs((i + 0.5::DOUBLE) - (o + 0.5::DOUBLE) / 32)) AS w
          FROM (SELECT range AS o FROM range(16, 240)), (SELECT range AS i FROM range(8)))""",
        "taps AS (SELECT o, list(w / s ORDER BY i) AS w FROM (SELECT *, sum(w) OVER (PARTITION BY o) AS s FROM w) GROUP BY o)",
        "line AS (SELECT vec_id, y, list(v ORDER BY x) AS v FROM px GROUP BY vec_id, y)",
        "pic AS (SELECT vec_id, list(v ORDER BY y) AS v FROM line GROUP BY vec_id)",
        "tall AS (SELECT vec_id, ["
        + ", ".join(" + ".join(f"w[{y}] * v[{y}][{x}]" for y in range(1, 9)) for x in range(1, 9))
        + "] AS v FROM pic, taps)",
        "full_size AS (SELECT vec_id, round_even("
        + " + ".join(f"w[{x}] * v[{x}]" for x in range(1, 9))
        + ", 0) AS p FROM tall, taps)",
        "n AS (SELECT vec_id, p, count(*) AS n FROM full_size GROUP BY vec_id, p)",
        """val AS (SELECT vec_id, n, ((p / 255.0::DOUBLE - m) / s)::FLOAT::DOUBLE AS v FROM n, (VALUES
          (0.485::DOUBLE, 0.229::DOUBLE), (0.456, 0.224), (0.406, 0.225)) ch(m, s))""",
        """mean AS (SELECT vec_id, sum(n) AS n, sum(n * v) / sum(n) AS mean, min(v) AS low, max(v) AS high
          FROM val GROUP BY vec_id)""",
    )
    + """SELECT mean.vec_id, any_value(e.label) AS label, any_value(mean.n)::INTEGER AS n,
      round(any_value(low), 6) AS min_value, round(any_value(high), 6) AS max_value, round(any_value(mean), 6) AS mean_value,
      round(sqrt(sum(val.n * (v - mean) * (v - mean)) / (any_value(mean.n) - 1)), 6) AS std_value
      FROM mean JOIN val ON mean.vec_id = val.vec_id JOIN embeddings e ON e.vec_id = mean.vec_id GROUP BY mean.vec_id""",
    # rules
    "rule_not_null": _with(LABELLED) + _none("not_null:quality", "quality IS NULL", "lab"),
    "rule_row_count": _rule("row_count", "1000", "count(*)", "count(*) = 1000", "documents"),
    "rule_single_value": _vocabulary("single_value:lang", "lang", ["'en'"], "documents", "true"),
    "rule_label_range": _none("label_range:label", "coalesce(label NOT BETWEEN 0 AND 9, true)", "embeddings"),
    "rule_vector_shape": _none("vector_shape:embedding", "coalesce(len(embedding) <> 64, true)", "embeddings"),
    "rule_finite": _none(
        "finite:embedding", "embedding IS NULL OR len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) > 0", "embeddings"
    ),
    "rule_alignment": _none(
        "alignment:doc_id", "a IS NULL OR b IS NULL",
        "(SELECT d.doc_id AS a, l.doc_id AS b FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id)",
    ),
    "rule_bijection": "WITH p AS (SELECT DISTINCT label, ['zero', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine'][label + 1] AS name"
    " FROM embeddings), c AS (SELECT count(DISTINCT name) AS a, count(DISTINCT label) AS b,"
    " (SELECT count(*) FROM (SELECT name FROM p GROUP BY name HAVING count(*) > 1)) +"
    " (SELECT count(*) FROM (SELECT label FROM p GROUP BY label HAVING count(*) > 1)) AS x FROM p) "
    + _rule(
        "bijection:class_name", "10 names, 10 indices, 0 ambiguous",
        "a || ' names, ' || b || ' indices, ' || x || ' ambiguous'", "a = 10 AND b = 10 AND x = 0", "c",
    ),
    "rule_required_fields": " UNION ALL ".join(
        _none(f"required_field:{f}", f"coalesce(NOT list_contains(json_keys(props), '{f}'), true)", "events") for f in ("k", "v")
    ),
    "rule_unique_key": _none("unique_key:doc_id", "n > 1", "(SELECT doc_id, count(*) AS n FROM documents GROUP BY doc_id)"),
    "rule_determinism": _with(
        SP, SP_AGAIN,
        """diff AS (SELECT * FROM (SELECT doc_id, lang, split FROM sp EXCEPT ALL SELECT doc_id, lang, split FROM again)
          UNION ALL SELECT * FROM (SELECT doc_id, lang, split FROM again EXCEPT ALL SELECT doc_id, lang, split FROM sp))""",
    )
    + _rule("determinism", "0", "count(*)", "count(*) = 0", "diff"),
    "determinism_diff": _with(SP, SP_OTHER)
    + "SELECT sp.doc_id, count(*) AS n_first, count(*) AS n_second FROM sp JOIN other USING (doc_id)"
    " WHERE sp.split <> other.split GROUP BY sp.doc_id",
    "bucket_fingerprints": "SELECT count(*) AS n_rows, count(*) AS n_again, true AS equal FROM lineitem",
    "split_overlap_new_keys": _with(
        SP, "k AS (SELECT DISTINCT md5(text) AS h, split, doc_id % 5 = 0 AS new FROM sp JOIN documents USING (doc_id))"
    )
    + "SELECT o.split, count(DISTINCT o.h) AS n_shared FROM k o JOIN k n ON n.h = o.h AND n.new AND NOT o.new GROUP BY o.split",
    "rule_epochs_differ": _with(
        f"a AS (SELECT doc_id, round({_between('angle', -15.0, 15.0)}, 6) AS angle FROM documents)",
        f"b AS (SELECT doc_id, round({_between('angle', -15.0, 15.0, 1)}, 6) AS angle FROM documents)",
        """diff AS (SELECT * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
          UNION ALL SELECT * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""",
    )
    + _rule("epochs_differ", "more than 0", "count(*)", "count(*) > 0", "diff"),
    "validation_report": _with(LABELLED)
    + "SELECT seq::INTEGER AS seq, rule, expected, observed, passed FROM ("
    + " UNION ALL ".join(
        f"SELECT {i + 1} AS seq, * FROM ({sql})"
        for i, sql in enumerate(
            [
                _rule("required_columns", "none missing", "'none missing'", "true", "(SELECT 1)"),
                _rule("column_type:quality", "int", "'int'", "true", "(SELECT 1)"),
                _none("not_null:lang", "lang IS NULL", "lab"),
                _none("not_null:quality", "quality IS NULL", "lab"),
                _rule("row_count", "1000", "count(*)", "count(*) = 1000", "lab"),
                _vocabulary("vocabulary:lang", "lang", ["'de'", "'en'", "'es'", "'fr'"], "lab", "true"),
                _vocabulary("vocabulary:quality", "quality", ["0", "1"], "lab", "false"),
                _vocabulary("vocabulary:quality", "quality", ["0", "1"], "lab", "true", absent=False),
                _none("label_range:toxic", "coalesce(toxic NOT BETWEEN 0 AND 1, true)", "lab"),
            ]
        )
    )
    + ")",
    # metrics
    "confusion_matrix": _with(PRED)
    + "SELECT truth, prediction, sum(n)::BIGINT AS n FROM ("
    "SELECT truth, prediction, 1 AS n FROM p UNION ALL SELECT t.c, q.c, 0 FROM v t, v q) GROUP BY truth, prediction",
    "accuracy": _with(PRED) + "SELECT round(avg(coalesce(truth = prediction, false)::INTEGER::DOUBLE), 6) AS accuracy FROM p",
    "precision_recall": _with(PRED)
    + "SELECT class, support, CASE WHEN predicted > 0 THEN round(hits::DOUBLE / predicted, 6) ELSE 0.0::DOUBLE END AS precision,"
    " CASE WHEN support > 0 THEN round(hits::DOUBLE / support, 6) ELSE 0.0::DOUBLE END AS recall,"
    " CASE WHEN support + predicted > 0 THEN round(2 * hits::DOUBLE / (support + predicted), 6) ELSE 0.0::DOUBLE END AS f1 FROM f",
    "macro_f1": _with(PRED)
    + "SELECT round(avg(CASE WHEN support + predicted > 0 THEN 2 * hits::DOUBLE / (support + predicted) ELSE 0 END), 6) AS macro_f1 FROM f",
}

# The same answers by the ways for crowded buckets and hot groups.
ORACLES["near_duplicates_crowded"] = ORACLES["near_duplicates"]
ORACLES["exact_duplicates_hot"] = ORACLES["exact_duplicates"]
ORACLES["preprocess_eval_long"] = ORACLES["preprocess_eval"]
ORACLES["read_split_csv"] = ORACLES["read_split"]

# The report merged from the states of shards is the report of the whole table.
ORACLES["validation_report_merged"] = ORACLES["validation_report"]
