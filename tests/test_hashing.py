import hashlib
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sortwell.functions import hashing
from sortwell.session import small_table


def simhash(text):
    """The same vote, token by token and bit by bit."""
    tokens = {t for t in re.split(r"[\W_]+", text.lower()) if t}
    if not tokens:
        return None
    hashes = [int(hashlib.md5(t.encode()).hexdigest()[:16], 16) for t in tokens]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return hashing.signed64(bits)


def test_parse_hash64_covers_the_sign_bit(spark):
    digits = ["0" * 16, "f" * 16, "8" + "0" * 15, "7" + "f" * 15, "0123456789abcdef"]
    df = small_table(spark, [(d,) for d in digits], "d string")
    got = {r.d: r.h for r in df.select("d", hashing.parse_hash64("d").alias("h")).collect()}
    assert got == {d: hashing.signed64(int(d, 16)) for d in digits}


@pytest.mark.parametrize("n", [1, 2, 4, 8, 16, 64])
def test_bit_bands_most_significant_first(spark, n):
    values = [0, -1, 1, -(2**63), 0x0123456789ABCDEF]
    df = small_table(spark, [(v,) for v in values], "h bigint")
    width = 64 // n
    for r in df.select("h", hashing.bit_bands("h", n).alias("b")).collect():
        unsigned = r.h & (2**64 - 1)
        chunks = [unsigned >> (64 - width * (i + 1)) & (2**width - 1) for i in range(n)]
        assert r.b == [hashing.signed64(c) for c in chunks]


def test_bit_bands_rejects_uneven_widths():
    with pytest.raises(ValueError):
        hashing.bit_bands("h", 7)


def test_hamming64(spark):
    pairs = [(0, 0, 0), (0, -1, 64), (-(2**63), 0, 1), (5, 6, 2)]
    df = small_table(spark, pairs, "a bigint, b bigint, d int")
    assert df.where(hashing.hamming64("a", "b") != F.col("d")).count() == 0


def test_text_hash64_equals_plain_vote(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(5000)]
    texts = ["", "   ...", "one", "One one ONE", "Émile, naïve — coöperate 42!"]
    # Around the block size of the counters, and well above it.
    texts += [" ".join(rng.sample(words, n)) for n in (2, 126, 127, 128, 254, 255, 1000, 5000)]
    df = small_table(spark, list(enumerate(texts)), "id int, text string")
    got = {r.id: r.h for r in df.select("id", hashing.text_hash64("text").alias("h")).collect()}
    assert got == {i: simhash(t) for i, t in enumerate(texts)}


def test_text_hash64_uses_the_whole_text(spark):
    base = " ".join(f"w{i}" for i in range(300))
    tail = " ".join(f"x{i}" for i in range(30000))
    df = small_table(spark, [(base + " " + tail,)], "text string")
    assert df.select(hashing.text_hash64("text")).first()[0] == simhash(base + " " + tail)


def test_null_text_has_no_hash(spark):
    df = small_table(spark, [(None,)], "text string")
    assert rows(df.select(hashing.text_hash64("text"))) == [(None,)]


def test_content_digest_of_text_and_bytes(spark):
    df = spark.createDataFrame([("abc", bytearray(b"abc"))], "t string, b binary")
    digest = hashlib.md5(b"abc").hexdigest()
    got = df.select(hashing.content_digest("t"), hashing.content_digest("b")).first()
    assert tuple(got) == (digest, digest)
