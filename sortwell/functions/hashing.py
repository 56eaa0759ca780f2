"""Digests, 64-bit hashes and Hamming arithmetic on signed BIGINT bit patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token hashes are added up in blocks short enough for a count to fit one byte lane.
_LANE_BLOCK = 127
_BYTE_LANES = 0x0101010101010101


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def signed64(value: int) -> int:
    """The signed BIGINT with the same 64 bits."""
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def content_digest(content: Column | str) -> Column:
    """MD5 hex of a STRING or BINARY column."""
    return F.md5(_col(content))


def parse_hash64(hex16: Column | str) -> Column:
    """16 hex digits to BIGINT; digits above 7fff… come out as negative numbers."""
    return F.conv(_col(hex16), 16, -10).cast("bigint")


def bit_bands(hash64: Column | str, n: int = 8) -> Column:
    """Split into `n` chunks of equal width, most significant first."""
    if n < 1 or 64 % n:
        raise ValueError("the number of bands must divide 64")
    width = 64 // n
    mask = F.lit(signed64((1 << width) - 1)).cast("bigint")
    h = _col(hash64)
    return F.array(
        *[F.shiftrightunsigned(h, 64 - width * (i + 1)).bitwiseAND(mask) for i in range(n)]
    )


def hamming64(a: Column | str, b: Column | str) -> Column:
    return F.bit_count(_col(a).bitwiseXOR(_col(b))).cast("int")


def _bind(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`, which may use it many times."""
    return F.transform(F.array(value), body)[0]


def text_tokens(text: Column | str) -> Column:
    """Distinct lower-case runs of letters and digits."""
    words = F.split(F.lower(_col(text)), r"[^\p{L}\p{N}]+")
    return F.array_remove(F.array_distinct(words), "")


def text_hash64(text: Column | str) -> Column:
    """SimHash over the distinct tokens of the whole text: a bit is set when more than half of
    the token hashes have it set. Null for a text without any token, and for a null text.

    Runs inside one row, without explode or shuffle. Eight BIGINT sums per block of tokens carry
    eight byte-wide counters each; the counters of all blocks are then added per bit.
    """

    def lane(hashes: Column, i: Column, block: Column) -> Column:
        part = F.slice(hashes, block * _LANE_BLOCK + 1, F.lit(_LANE_BLOCK))
        return F.aggregate(
            part,
            F.lit(0).cast("bigint"),
            lambda acc, h: acc + F.call_function("shiftrightunsigned", h, i).bitwiseAND(F.lit(_BYTE_LANES)),
        )

    def lanes(hashes: Column) -> Column:
        last = F.floor(F.size(hashes) / _LANE_BLOCK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), F.lit(7)),
            lambda i: F.transform(F.sequence(F.lit(0), last), lambda block: lane(hashes, i, block)),
        )

    def count_of(sums: Column, bit: Column) -> Column:
        byte = bit.bitwiseAND(F.lit(56))  # eight times the byte the bit sits in
        return F.aggregate(
            F.element_at(sums, bit.bitwiseAND(F.lit(7)) + 1),
            F.lit(0).cast("bigint"),
            lambda acc, s: acc
            + F.call_function("shiftrightunsigned", s, byte).bitwiseAND(F.lit(255).cast("bigint")),
        )

    def assemble(hashes: Column) -> Column:
        return _bind(
            lanes(hashes),
            lambda sums: F.aggregate(
                F.sequence(F.lit(0), F.lit(63)),
                F.lit(0).cast("bigint"),
                lambda acc, bit: acc.bitwiseOR(
                    F.when(
                        count_of(sums, bit) * 2 > F.size(hashes),
                        F.call_function("shiftleft", F.lit(1).cast("bigint"), bit),
                    ).otherwise(F.lit(0).cast("bigint"))
                ),
            ),
        )

    hashes = F.transform(text_tokens(text), lambda t: parse_hash64(F.substring(F.md5(t), 1, 16)))
    return _bind(hashes, lambda found: F.when(F.size(found) > 0, assemble(found)))
