"""Scalar columns: time buckets, ids, addresses and text. All stay in Spark's own functions but where said."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds in the week that log keys wrap around in.
WEEK_SECONDS = 604_800
SHARDS = 32


def event_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def day_start(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def yyyymmdd(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def bucket_end(ts: Column, n: int, unit: str) -> Column:
    """End of the running n-minute, n-hour or n-day bucket, counted from the day's start (days: from the epoch's)."""
    seconds = {"minute": 60, "hour": 3600, "day": 86_400}[unit] * n
    if unit == "day":
        day = F.unix_seconds(day_start(ts))
        return F.timestamp_seconds(day + seconds)
    start = F.unix_seconds(day_start(ts))
    into = F.unix_seconds(ts) - start
    return F.timestamp_seconds(start + (F.floor(into / seconds) + 1) * seconds)


def tag_item(item_id: Column) -> Column:
    return item_id * 10 + 1


def tag_seller(seller_id: Column) -> Column:
    return seller_id * 10 + 2


def untag(tagged: Column) -> Column:
    """(id, kind): kind 1 is an item, 2 a seller."""
    return F.struct(F.floor(tagged / 10).cast("bigint").alias("id"), (tagged % 10).cast("int").alias("kind"))


def packed_key(hour: Column, key: Column) -> Column:
    """Hour of the day above the 32-bit checksum of a key, in one long."""
    return F.shiftleft(hour.cast("bigint"), 32).bitwiseOR(F.crc32(key.cast("string")))


def ip_to_dotted(ip: Column) -> Column:
    """Dotted form of a 32-bit address whose first part is the lowest byte."""
    return F.concat_ws(".", *[F.shiftright(ip, 8 * k).bitwiseAND(F.lit(255)) for k in range(4)])


def ip_to_long(dotted: Column) -> Column:
    """Number of a dotted address, first part highest; null unless it has four parts from 0 to 255."""
    parts = F.transform(F.split(dotted, r"\.", -1), lambda p: p.try_cast("bigint"))
    good = (F.size(parts) == 4) & F.forall(parts, lambda p: p.isNotNull() & p.between(0, 255))
    return F.when(good, F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, p: a * 256 + p))


def shard_of(key: Column, shards: int = SHARDS) -> Column:
    return (F.crc32(key.cast("string")) % shards).cast("int")


def shard_of_long(key: Column, shards: int = 256) -> Column:
    """Shard by the eight big-endian bytes of a number."""
    return (F.crc32(F.unhex(F.lpad(F.hex(key.cast("bigint")), 16, "0"))) % shards).cast("int")


def week_slot(ms: Column) -> Column:
    return F.pmod(F.floor(ms / 1000), F.lit(WEEK_SECONDS)).cast("int")


def adjust_end(start: int, end: int, week: int = WEEK_SECONDS) -> int:
    """The end of a range of slots, held back to the end of the week that it starts in."""
    return min(end, (start // week + 1) * week)


def query_params(url: Column) -> Column:
    """What follows the first '?' as a map of trimmed names and values; parts without a name and one value are left out
    ('a=' and 'a=b=c'), of repeated names the last stays."""
    query = F.when(F.instr(url, "?") > 0, F.regexp_replace(url, r"^[^?]*\?", "")).otherwise("")
    parts = F.transform(F.split(query, "&", -1), lambda p: F.transform(F.split(F.regexp_replace(p, "=+$", ""), "=", -1), lambda x: F.trim(x)))
    pairs = F.filter(parts, lambda p: F.size(p) == 2)
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: F.get(q, F.lit(0)) == F.get(p, F.lit(0))))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(F.get(p, F.lit(0)).alias("key"), F.get(p, F.lit(1)).alias("value"))))


def clean_text(text: Column) -> Column:
    """Runs of blanks and tabs become one blank; '|' and the field mark \\x05 go."""
    return F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), "[|\\x05]", "")


def _percent_decoded(text: Column, charset: str) -> Column:
    """Percent-decoded by the JVM's own decoder, '+' as a blank; null where it refuses."""
    return F.call_function("try_reflect", F.lit("java.net.URLDecoder"), F.lit("decode"), text, F.lit(charset))


def _from_hex(digits: Column, charset: str) -> Column:
    return _percent_decoded(F.regexp_replace(digits, "(..)", "%$1"), charset)


def unescape(text: Column) -> Column:
    """%XX and %uXXXX as characters; '?' for bad or missing digits. Pairs of surrogates are one character."""
    tokens = F.regexp_extract_all(text, F.lit("(?s)%u.{0,4}|%(?!u).{0,2}|[^%]+"), F.lit(0))

    def utf16(t: Column) -> Column:
        long = F.when(t.rlike("^%u[0-9A-Fa-f]{4}$"), F.substring(t, 3, 4))
        short = F.when(t.rlike("^%[0-9A-Fa-f]{2}$"), F.concat(F.lit("00"), F.substring(t, 2, 2)))
        return F.when(F.startswith(t, F.lit("%")), F.coalesce(long, short, F.lit("003F"))).otherwise(F.hex(F.encode(t, "UTF-16BE")))

    decoded = _from_hex(F.array_join(F.transform(tokens, utf16), ""), "UTF-16BE")
    return F.when(F.contains(text, F.lit("%")), decoded).otherwise(text)


def url_decode_gbk(text: Column) -> Column:
    """Percent-decoded as GBK; the text itself where its bytes are no GBK or nothing is left. A '%' without two digits stays."""
    decoded = _percent_decoded(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"), "GBK")
    good = decoded.isNotNull() & (decoded != "") & ~F.contains(decoded, F.lit("\ufffd"))
    return F.when(text.rlike("[%+]"), F.when(good, decoded).otherwise(text)).otherwise(text)


def gbk_of_base64(text: Column) -> Column:
    """The GBK text that base64 stands for; null where it is none."""
    return _from_hex(F.hex(F.try_to_binary(text, F.lit("base64"))), "GBK")
