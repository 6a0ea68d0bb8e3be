"""Stable hashes as column expressions: length-prefixed SHA-256 of text parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Odd 64-bit constant that spreads a small seed over all bits (golden ratio, fixed value).
SEED_MIXER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def digest_hex(*parts: Column) -> Column:
    """SHA-256 over the parts, each preceded by its length in eight big-endian bytes; null if a part is."""
    framed = [F.concat(F.unhex(F.lpad(F.hex(F.octet_length(p).cast("long")), 16, "0")), p.cast("binary")) for p in parts]
    return F.sha2(F.concat(*framed), 256)


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ that holds UTC."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def event_id(source: Column, record_id: Column, event_type: Column, ts: Column) -> Column:
    """128 bits in hex that name an event, a function of its source record only."""
    return F.substring(digest_hex(source, record_id, event_type, epoch_micros(ts).cast("string")), 1, 32)


def priority(key: Column, seed: int) -> Column:
    """Sampling priority: 64 hash bits of the key xor the spread seed, as a signed long in unsigned order."""
    spread = (seed * SEED_MIXER) & _MASK
    signed = spread - (1 << 64) if spread >= 1 << 63 else spread
    bits = F.conv(F.substring(digest_hex(key), 1, 16), 16, -10).cast("long")
    return bits.bitwiseXOR(F.lit(signed)).bitwiseXOR(F.lit(-(1 << 63)))


def tagged(value: Column) -> Column:
    """A text form in which null differs from the empty string and from any value."""
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), value.cast("string")))


def table_digest(rows: DataFrame) -> tuple[str, int]:
    """(SHA-256 like name of a table's content, number of rows), the same in any order and partitioning.

    The digests of the rows are added up modulo 2^256, so tasks add up their
    own and a row comes to the driver. A row's digest frames each column, null
    apart from any text; repeated rows count as often as they are there.
    """
    row = digest_hex(*[tagged(F.col(c)) for c in rows.columns])
    parts = [F.sum(F.conv(F.substring("__d", 8 * i + 1, 8), 16, 10).cast("decimal(38,0)")).alias(f"p{i}") for i in range(8)]
    got = rows.select(row.alias("__d")).agg(F.count("*").alias("n"), *parts).first()
    total = sum(int(got[f"p{i}"] or 0) << (32 * (7 - i)) for i in range(8))
    return f"{total % (1 << 256):064x}", got["n"]
