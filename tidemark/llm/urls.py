"""URL rules and a blocklist: a blocked Bloom filter first, an exact join for what it passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

LANES, LANE_BITS = 8, 32
KEYS_PER_BLOCK = 16  # 16 bits a key: about one url in a thousand passes by mistake
BROADCAST_BLOCKS = 1 << 17  # of 256 bits, 4 MB of filter; a larger one is joined by block

# The rules that the query applies, in order (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #; empty for null or without ://."""
    return _ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without a leading www., and path without closing slashes: no scheme, query or fragment.

    Null for a url without a host.
    """
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), r"/+$", "")))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits a host, or a domain above it, and the start of the path; its verdict.

    Of equally long rules the first counts. Null, null if none fits.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        of_host, slash, of_path = text.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + of_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def n_blocks(n_keys: int) -> int:
    """Blocks of a filter for so many keys: a power of two."""
    return 1 << max(0, (n_keys - 1) // KEYS_PER_BLOCK).bit_length()


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column, lane: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(lane // 4), key), (lane % 4) * 5).bitwiseAND(F.lit(LANE_BITS - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1), bits)


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as a table: a row per block that has bits."""
    return listed.groupBy(_block(F.col(key), blocks).alias("_slot")).agg(
        *[F.bit_or(_bits(F.col(key), lane)).alias(f"lane{lane}") for lane in range(LANES)]
    )


def judged_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """`pages` (with a column url) plus host, path, rule and verdict (allow or block).

    A rule decides where one fits. Elsewhere a url is blocked if its canonical
    form is that of a row of `listed` (column url): the Bloom filter, sized by the
    counted list, sorts out most that aren't, and only what it passes goes to an
    exact join by url, which removes its false positives. The filter is broadcast
    up to `broadcast_blocks`; a larger one meets the urls by block in a shuffle.

    Null urls and urls without :// have an empty host and path and are allowed.
    Null or hostless listed urls list nothing; repeated ones count once. Added
    columns replace columns of these names.
    """
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    keys = materialise(listed.select(canonical(F.col("`url`")).alias("_key")).filter("_key IS NOT NULL").distinct(), "listed")
    blocks = n_blocks(keys.count())
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = (
        pages.select(*[F.col(f"`{c}`") for c in names]).withColumns({"host": host_of(F.col("`url`")), "path": path_of(F.col("`url`"))})
        .withColumns({"rule": rule, "verdict": verdict, "_url": canonical(F.col("`url`"))})
    )
    bits = bloom_blocks(keys, "_key", blocks).select("_slot", F.array(*[f"lane{lane}" for lane in range(LANES)]).alias("_lanes"))
    asked = F.when(F.col("verdict").isNull(), _block(F.col("_url"), blocks))
    # Urls that a rule judged, or without a host, ask for no block; they are dealt over numbers that no block has.
    asked = F.coalesce(F.when(F.col("_url").isNotNull(), asked), -1 - F.pmod(F.xxhash64("`url`"), F.lit(1 << 20)))
    tested = rows.withColumn("_block", asked).join(
        F.broadcast(bits) if blocks <= broadcast_blocks else bits.hint("shuffle_hash"), F.col("_block") == F.col("_slot"), "left",
    )
    maybe = F.col("_slot").isNotNull()
    for lane in range(LANES):
        maybe = maybe & (F.col("_lanes")[lane].bitwiseAND(_bits(F.col("_url"), lane)) != 0)
    tested = tested.withColumn("_maybe", F.coalesce(maybe, F.lit(False)))
    out = [*names, "host", "path", "rule"]
    passed = tested.filter("_maybe").join(keys, F.col("_url") == F.col("_key"), "left").select(
        *[F.col(f"`{c}`") for c in out], F.when(F.col("_key").isNotNull(), "block").otherwise("allow").alias("verdict")
    )
    rest = tested.filter("NOT _maybe").select(*[F.col(f"`{c}`") for c in out], F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    return rest.union(passed)
