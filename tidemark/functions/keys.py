"""Hash keys as expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands for null inside a hashed key, so that null and '' give different keys.
NULL_PART = "_null_"


def _text(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(NULL_PART))


def packed(text: Column | str) -> Column:
    """Text as bytes for a shuffle, md5 digests in half their length; `unpacked` gives the text back."""
    text = F.col(text) if isinstance(text, str) else text
    raw = text.cast("binary")
    # Sixteen bytes are a digest. Other text says in its last byte by how many bytes it was extended.
    return F.when(text.rlike("^[0-9a-f]{32}$") & (F.length(text) == 32), F.unhex(text)).when(
        F.octet_length(text) == 15, F.concat(raw, F.lit(b"\x02\x02"))).otherwise(F.concat(raw, F.lit(b"\x01")))


def unpacked(bytes_: Column | str) -> Column:
    bytes_ = F.col(bytes_) if isinstance(bytes_, str) else bytes_
    size = F.octet_length(bytes_)
    extended = F.when(bytes_.substr(size, F.lit(1)) == F.lit(b"\x02"), 2).otherwise(1)
    return F.when(size == 16, F.lower(F.hex(bytes_))).otherwise(bytes_.substr(F.lit(1), size - extended).cast("string"))


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the parts in the given order; nulls take part."""
    return F.md5(F.concat_ws("-", *[_text(c) for c in columns]))


def hash_key(*columns: Column | str) -> Column:
    """md5 over the parts joined by '|'; null if any part is null."""
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    parts = [columns[0].cast("string")]
    for column in columns[1:]:
        parts += [F.lit("|"), column.cast("string")]
    return F.md5(F.concat(*parts))


def version_key(keys: list[str], updated_at: str) -> Column:
    """Id of one version of an entity: its business key and its change time."""
    stamp = F.date_format(updated_at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return hash_key(*keys, stamp)


def uuid_v5(namespace: uuid.UUID, name: Column | str) -> Column:
    """Name-based UUID (RFC 4122, version 5) without leaving the JVM."""
    name = F.col(name) if isinstance(name, str) else name
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name.cast("string"), "UTF-8")))
    # Variant bits: the two high bits of the 17th hex digit become 10.
    digit = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.substring(F.lit("89ab"), digit % 4 + 1, F.lit(1))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )
