"""The mapping language: target fields from prefix-notation expressions, compiled once to columns of one select.

A spec names each field's expression, such as '@bigint @field2 6 10'. A word with '@' is a command that takes the
words after it; any other word is a constant. Commands return a value and a flag that rejects the row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULLS = ("", "\\N", "null")


@dataclass(frozen=True)
class Value:
    column: Column
    bad: Column = field(default_factory=lambda: F.lit(False))


@dataclass(frozen=True)
class Row:
    """Where a mapping reads from: a column with the fields of level one, separators of levels two and three, members."""

    fields: str = "fields"
    level2: str = "\x01"
    level3: str = "\x03"
    member: str = "raw"
    items: tuple[tuple[int, str], ...] = ()  # columns that hold fields already split at level two

    def split_once(self, df: DataFrame, spec: dict[str, str]) -> tuple[DataFrame, Row]:
        """df with a column for each field that the spec reads at level two, so that it is split once for all of them."""
        used = sorted({int(n) for text in spec.values() for n in re.findall(r"@field[23] (\d+)", text)} - {0})
        names = tuple((n, f"__items_{n}") for n in used)
        return df.withColumns({name: _split(F.get(F.col(self.fields), F.lit(n - 1)), self.level2) for n, name in names}), replace(self, items=names)


def _split(text: Column, separator: str) -> Column:
    """A single character that means nothing in a pattern is passed as it is: Java then splits without a pattern."""
    plain = len(separator) == 1 and separator not in "\\.$|()[]{}^?*+"
    return F.split(text, separator if plain else "\\Q" + separator + "\\E", -1)


def _at(items: Column, position: int) -> Value:
    item = F.get(items, F.lit(position - 1)) if position > 0 else F.lit(None).cast("string")
    return Value(item, F.coalesce(F.size(items) < position, F.lit(True)) if position > 0 else F.lit(True))


def _field(row: Row, args: list[Value | str], depth: int) -> Value:
    places = [int(a) for a in args]
    value = _at(F.col(row.fields), places[0])
    held = dict(row.items).get(places[0])
    parts = F.col(held) if held else _split(value.column, row.level2)
    if depth >= 2 and not (depth == 3 and places[1] == 0):
        inner = _at(parts, places[1])
        value = Value(inner.column, value.bad | inner.bad)
    if depth == 3 and places[1] == 0:  # the k-th part of each item of level two
        k = places[2]
        items = F.transform(parts, lambda x: F.get(_split(x, row.level3), F.lit(k - 1)))
        missing = F.exists(items, lambda x: x.isNull())
        value = Value(F.array_join(items, "\x01"), value.bad | F.coalesce(missing, F.lit(True)))
    elif depth == 3:
        inner = _at(_split(value.column, row.level3), places[2])
        value = Value(inner.column, value.bad | inner.bad)
    return value


def _cast(kind: str) -> Callable[[Row, list], Value]:
    def run(row: Row, args: list) -> Value:
        text = args[0].column.cast("string")
        empty = text.isNull() | text.isin(*NULLS)
        number = text.try_cast(kind)  # null for what counts as empty
        return Value(number, args[0].bad | (number.isNull() & ~empty))

    return run


def _mul(row: Row, args: list) -> Value:
    a, b = (x.column.try_cast("bigint") for x in args)
    return Value(a * b, args[0].bad | args[1].bad)


def price_cent(text: Column, legacy: bool = False) -> Column:
    """Cents of a decimal amount; '\\N' is 0. legacy drops fractions of a unit before it multiplies."""
    if legacy:
        cents = text.try_cast("double").cast("bigint") * 100
    else:
        cents = F.round(text.try_cast("decimal(20,6)") * 100, 0).cast("bigint")
    return F.when(text == "\\N", F.lit(0).cast("bigint")).otherwise(cents)


def _price(legacy: bool) -> Callable[[Row, list], Value]:
    def run(row: Row, args: list) -> Value:
        text = args[0].column.cast("string")
        return Value(price_cent(text, legacy), args[0].bad | (text.isNotNull() & price_cent(text, legacy).isNull()))

    return run


def _unescaped(row: Row, args: list) -> Value:
    from .scalars import unescape

    return Value(unescape(args[0].column), args[0].bad)


#: Command -> how many words or values it takes, and what it makes of them. Add to it to extend the language.
COMMANDS: dict[str, tuple[int, Callable[[Row, list], Value]]] = {
    "field": (1, lambda row, a: _field(row, a, 1)),
    "field1": (1, lambda row, a: _field(row, a, 1)),
    "field2": (2, lambda row, a: _field(row, a, 2)),
    "field3": (3, lambda row, a: _field(row, a, 3)),
    "int": (1, _cast("int")),
    "bigint": (1, _cast("bigint")),
    "mul": (2, _mul),
    "price_cent": (1, _price(False)),
    "price_cent_legacy": (1, _price(True)),
    "unescape": (1, _unescaped),
    "member": (1, lambda row, a: Value(F.col(f"{row.member}.{a[0]}").cast("string"))),
}
_PLACES = frozenset(("field", "field1", "field2", "field3", "member"))


def compile_expression(text: str, row: Row = Row()) -> Value:
    words = text.split()

    def take() -> Value:
        word = words.pop(0)
        if not word.startswith("@"):
            return Value(F.lit(word))
        if word[1:] not in COMMANDS:
            raise ValueError(f"unknown command {word} in {text!r}")
        n, run = COMMANDS[word[1:]]
        if word[1:] in _PLACES:
            args = [words.pop(0) for _ in range(n)]
        else:
            args = [take() for _ in range(n)]
        return run(row, args)

    value = take()
    if words:
        raise ValueError(f"too many words in {text!r}")
    return value


def map_fields(df: DataFrame, spec: dict[str, str], row: Row = Row(), keep: tuple[str, ...] = ()) -> DataFrame:
    """df mapped to the fields of spec, and `reject`: the first field whose expression could not be read, or null."""
    df, row = row.split_once(df, spec)
    values = {name: compile_expression(text, row) for name, text in spec.items()}
    reject = F.coalesce(*[F.when(v.bad, F.lit(name)) for name, v in values.items()])
    # Fields are computed below the generator, where Spark takes what they share into methods of its own: within it, the code of
    # a dozen fields is one method, beyond the 8,000 bytes up to which the JVM compiles any. The generator makes one row: a
    # filter on `reject` stays above it, so that Spark does not compute all fields for the filter again.
    df = df.select(*keep, *[v.column.alias(f"__{name}") for name, v in values.items()], reject.alias("__reject"))
    fields = F.struct(*[F.col(f"__{name}").alias(name) for name in (*values, "reject")])
    return df.select(*keep, F.inline(F.array(fields)))


def destined(spec: dict[str, str], dest_type: str) -> dict[str, str]:
    """The spec with another destination, where a feed names its own."""
    return spec | {"dest_type": dest_type}


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col("reject").isNull()).drop("reject"), df.filter(F.col("reject").isNotNull())


# The positions of fields in the change rows of each feed.
ORDER = {
    "log_version": "@int 1", "log_src": "tc_biz_order", "dest_type": "biz_order",
    "order_id": "@field2 6 1", "parent_id": "@field2 6 37", "seller_id": "@field2 6 6", "buyer_id": "@field2 6 5", "auction_id": "@field2 6 7",
    "auction_price": "@bigint @field2 6 10", "adjust_fee": "@bigint @field2 6 38", "discount_fee": "@bigint @field2 6 39", "buy_amount": "@bigint @field2 6 11",
    "gmt_create": "@field2 6 15", "gmt_modified": "@field2 6 16", "pay_time": "@field2 6 32",
    "is_detail": "@int @field2 6 34", "is_main": "@int @field2 6 35", "shop_id": "@field2 6 44", "pay_status": "@int @field2 6 13", "biz_type": "@int @field2 6 12",
}
PAYMENT = {
    "log_version": "@int 1", "log_src": "tc_pay_order", "dest_type": "pay_order",
    "order_id": "@field2 6 1", "seller_id": "@field2 6 4", "buyer_id": "@field2 6 5",
    "gmt_create": "@field2 6 10", "gmt_modified": "@field2 6 11", "pay_time": "@field2 6 9",
    "actual_total_fee": "@bigint @field2 6 13", "pay_status": "@int @field2 6 6", "total_fee": "@bigint @field2 6 2",
}
SETTLEMENT = {
    "log_version": "@int 2", "log_src": "order_0000", "dest_type": "settlement_order",
    "seller_id": "@field2 6 33", "buyer_id": "@field2 6 35", "auction_price": "@price_cent @field2 6 38", "actual_total_fee": "@price_cent @field2 6 14",
    "gmt_create": "@field2 6 8", "gmt_modified": "@field2 6 9", "trade_no": "@field2 6 2", "trade_status": "@field2 6 7", "trade_track_info": "@field2 6 47",
}
CART = {
    "log_version": "@int 3", "log_src": "member_cart", "dest_type": "cart",
    "cart_id": "@bigint @field2 6 1", "sku_id": "@bigint @field2 6 2", "item_id": "@bigint @field2 6 3", "quantity": "@bigint @field2 6 4",
    "user_id": "@bigint @field2 6 5", "status": "@int @field2 6 6", "type": "@int @field2 6 7", "sub_type": "@bigint @field2 6 8",
    "gmt_create": "@field2 6 9", "gmt_modified": "@field2 6 10", "sync_version": "@int @field2 6 13",
}
FAVOURITE = {
    "log_version": "@int 4", "log_src": "collect_info", "dest_type": "collect_info",
    "user_id": "@bigint @field2 5 2", "type": "@int @field2 5 12", "item_id": "@bigint @field2 5 32", "item_invalid": "@field2 5 31",
    "item_category": "@bigint @field2 5 18", "item_owner_id": "@bigint @field2 5 21", "delete_time": "@field2 5 38", "sku_id": "@bigint @field2 5 15",
    "item_title": "@field2 5 19", "gmt_create": "@field2 5 4", "gmt_modified": "@field2 5 8",
}
PAGE_VIEW = {
    "log_version": "@int 2", "log_src": "browse_log", "dest_type": "browse",
    "uid": "@member uid", "url": "@member url", "sid": "@member sid", "mid": "@member cna", "title": "@unescape @member title",
    "refer_url": "@member pre", "agent": "@member useragent",
}
