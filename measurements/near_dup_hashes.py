"""One run of the near-duplicate join on a million synthetic hashes with a crowded bucket.

Prints the time and compares with what was planted: every hundredth hash has a copy with three bits
flipped, and 15,000 hashes share their first 40 bits, which is compared with all pairs in NumPy.
"""

import sys
import time

import numpy as np
from pyspark.sql import functions as F

from sortwell.operators import neardup
from sortwell.session import build_session, settled

ROWS = int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000
CROWDED = 15_000

spark = build_session("near-dup-hashes", "local[8]", spark_sql_shuffle_partitions="32", spark_driver_memory="16g",
                      spark_ui_enabled="false", spark_ui_showConsoleProgress="false")
spark.sparkContext.setLogLevel("ERROR")
plain = spark.range(ROWS).select(F.xxhash64("id").alias("hash"))
flipped = spark.range(0, ROWS, 100).select(F.xxhash64("id").bitwiseXOR(F.lit(0x0100_0001_0000_0010)).alias("hash"))
low = F.xxhash64(F.col("id") + F.lit(ROWS)).bitwiseAND(F.lit((1 << 24) - 1))
crowded = spark.range(CROWDED).select(low.bitwiseOR(F.lit(0x1234_5678_9A00_0000)).alias("hash"))
hashes = settled(plain.union(flipped).union(crowded).distinct())
n = hashes.count()

start = time.perf_counter()
pairs = settled(neardup.near_hash_pairs(hashes))
found = pairs.count()
seconds = time.perf_counter() - start

planted = flipped.select("hash", F.col("hash").bitwiseXOR(F.lit(0x0100_0001_0000_0010)).alias("other"))
ends = planted.select(F.least("hash", "other").alias("hash_a"), F.greatest("hash", "other").alias("hash_b"))
missed = ends.join(pairs, ["hash_a", "hash_b"], "left_anti").count()
prefix = F.lit(0x1234_5678_9A)
inside = pairs.where((F.shiftrightunsigned("hash_a", 24) == prefix) & (F.shiftrightunsigned("hash_b", 24) == prefix)).count()
own = np.array([r.hash for r in crowded.distinct().collect()], dtype=np.int64)
expected = sum(int((np.bitwise_count(own[i + 1 :] ^ own[i]) <= 5).sum()) for i in range(len(own)))
print(f"hashes {n}, scheme {neardup.choose_blocks(n, 5)}, pairs {found}, seconds {seconds:.1f}")
print(f"planted pairs missed {missed}, pairs in the crowded bucket {inside}, by brute force {expected}")
spark.stop()
