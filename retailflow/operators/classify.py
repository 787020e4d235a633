"""Page types and traffic sources by ordered rule tables, in the JVM.

A rule table is data. Of the rules that a URL (or URL, referrer and shop) matches, the first in the table's order decides;
`rules.py` fetches the few that can match by host and token. In batches only distinct rows are classified and joined back,
so that a page seen a million times runs its rules once; streams classify each row.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import gbk_of_base64, url_decode_gbk
from . import rules as engine

# Page types, keyword types, source groups and sources.
UNKNOWN, SEARCH, CATEGORY, ALL_ITEMS, ITEM, LABEL, COMMUNITY, HOME = "0", "1", "2", "3", "4", "5", "6", "7"
OTHER_PAGE = HOME  # an earlier name
NO_KEY, SITE_KEY, AD_KEY, SHOP_KEY, ENGINE_KEY, AFFILIATE_KEY, MALL_KEY = "0", "1", "2", "3", "4", "5", "6"
DIRECT_GROUP, AD_GROUP, SELF_GROUP, SITE_GROUP, SOCIAL_GROUP, PARTNER_GROUP, ENGINE_GROUP, OTHER_GROUP = "6", "8", "1", "19", "112", "104", "61", "60"
OWN_SHOP, UNKNOWN_SOURCE = "59", "74"
#: What an advert's empty keyword stands for, by the kind of advert.
EMPTY_AD_KEYS = {"6": "类目搜索", "7": "定向推广"}
#: Where an affiliate's link does not tell what page it was on.
NO_AFFILIATE_PAGE = "other"


@dataclass(frozen=True)
class PageRule:
    """Positions are groups of the pattern; 0 for none. host: the pattern holds only there and on subdomains; token: a word
    that every URL that the pattern matches has between marks. Both only save work."""

    name: str
    pattern: str
    page_type: str
    key: int = 0
    title: int = 0
    low_price: int = 0
    high_price: int = 0
    key_name: str = ""
    title_name: str = ""
    unless: str = ""
    host: str = ""
    token: str = ""

    PATTERNS: ClassVar = ("pattern", "unless")
    POSITIONS: ClassVar = {"key": "pattern", "title": "pattern", "low_price": "pattern", "high_price": "pattern"}


@dataclass(frozen=True)
class SourceRule:
    """use: what the pattern is held against: 'url', 'before' (referrer before its '?') or 'full' (whole referrer).
    An empty pattern matches an empty referrer alone. host and token are those of that text."""

    name: str
    pattern: str
    src_id: str
    group: str
    use: str = "before"
    key: str = ""  # found in the decoded URL for adverts, else in the referrer
    key_group: int = 1
    kind_group: int = 0  # tells what an empty keyword of an advert stands for
    key_type: str = NO_KEY
    keep_referrer: bool = False
    shop: str = ""  # finds a shop id in the referrer; the own shop makes it source 59
    via: str = ""  # finds, in an affiliate's link, the escaped URL that holds the page it was on
    page: str = ""  # finds that page in it
    host: str = ""
    token: str = ""

    PATTERNS: ClassVar = ("pattern", "key", "shop", "via", "page")
    POSITIONS: ClassVar = {"key_group": "key", "kind_group": "key"}


PAGE_FIELDS = ("page_type", "key_info", "title_info", "key", "key_type", "page_rule")
SOURCE_FIELDS = ("src_id", "ref_url", "src_key", "src_key_type", "source_rule")


def _plain(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"\|+", "")


def _search_key(text: Column, r: Column) -> Column:
    """'word||low~high' of an in-shop search; '' without both, or where an escape is left."""
    low, high = (F.trim(engine.group(text, r["pattern"], r[c])) for c in ("low_price", "high_price"))
    price = _plain(F.concat(F.when(r["low_price"] > 0, F.concat(low, F.lit("~"))).when(r["high_price"] > 0, F.lit("~")).otherwise(""), high))
    word = _plain(url_decode_gbk(F.trim(engine.group(text, r["pattern"], r["key"]))))
    good = (F.concat(word, price) != "") & ~F.contains(F.concat(word, price), F.lit("%"))
    return F.when(good, F.regexp_replace(F.regexp_replace(F.concat(word, F.lit("||"), price), r"\s+", " "), "\\x05", "")).otherwise("")


def _category_title(raw: Column) -> Column:
    title = url_decode_gbk(raw)
    return F.when(title.rlike("^[a-zA-Z0-9/+=]+$"), F.coalesce(gbk_of_base64(title), title)).otherwise(title)


def _first_match(df: DataFrame, matching, usable=lambda r: F.lit(True)) -> DataFrame:
    """df with `hit`: of its candidates that match and can be used the one of least number, or null."""
    good = F.filter(F.filter("candidates", matching), usable)
    return df.withColumn("hit", F.array_min(good)).drop("candidates")


def _page_info(df: DataFrame, rules: list[PageRule], item_suffix: str, literal_rules: int | None) -> DataFrame:
    """PAGE_FIELDS for k1 (url) and k2 (title)."""
    text, title = F.col("__text"), F.coalesce("k2", F.lit(""))
    read = df.withColumn("__text", F.replace(F.replace(F.coalesce("k1", F.lit("")), F.lit("=null"), F.lit("=")), F.lit(" "), F.lit("")))
    filed = [engine.filed_under(r.host, r.token) for r in rules]
    found = engine.with_candidates(read, engine.lookup_keys(text), rules, filed, literal_rules)
    matching = lambda r: engine.matches(text, r["pattern"]) & ((r["unless"] == "") | ~engine.matches(text, r["unless"]))
    found = _first_match(found, matching, lambda r: (r["page_type"] != SEARCH) | (_search_key(text, r) != ""))
    hit, name = F.col("hit"), F.substring_index(title, "-", 1)
    part = lambda c: engine.group(text, hit["pattern"], hit[c])
    named = F.when(hit["title_name"] != "", hit["title_name"]).otherwise(name)
    own_title = F.regexp_replace(title, F.lit("\\Q" + item_suffix + "\\E$"), F.lit("")) if item_suffix else title
    first_of = lambda a, b: F.when(a != "", a).otherwise(b)
    is_a = lambda kind: hit["page_type"] == kind
    columns = {
        "page_type": F.coalesce(hit["page_type"], F.lit(UNKNOWN)),
        "key_info": F.when(hit.isNull(), "").when(is_a(CATEGORY) | is_a(ITEM), first_of(part("key"), hit["key_name"])).otherwise(hit["key_name"]),
        "title_info": F.when(hit.isNull(), name).when(is_a(CATEGORY) & (hit["title"] > 0), first_of(_plain(_category_title(part("title"))), named)).when(is_a(ITEM), first_of(own_title, named)).otherwise(named),
        "key": F.when(is_a(SEARCH), _search_key(text, hit)).otherwise(""),
        "key_type": F.when(is_a(SEARCH), SHOP_KEY).otherwise(NO_KEY),
        "page_rule": F.coalesce(hit["name"], F.lit("")),
    }
    return found.withColumns(columns).drop("hit", "__text")


def _source_info(df: DataFrame, rules: list[SourceRule], literal_rules: int | None) -> DataFrame:
    """SOURCE_FIELDS for k1 (url), k2 (referrer) and k3 (shop)."""
    url, ref = F.coalesce("k1", F.lit("")), F.coalesce("k2", F.lit(""))
    before = F.substring_index(ref, "?", 1)
    # a rule about the referrer before its '?' is filed under tokens of the whole one, of which that is a part
    filed = [engine.filed_under(r.host, r.token, "u" if r.use == "url" else "r") for r in rules]
    found = engine.with_candidates(df, F.concat(engine.lookup_keys(url, "u"), engine.lookup_keys(ref, "r")), rules, filed, literal_rules)
    against = lambda r: F.when(r["use"] == "url", url).when(r["use"] == "full", ref).otherwise(before)
    found = _first_match(found, lambda r: F.when(r["pattern"] == "", ref == "").otherwise(engine.matches(against(r), r["pattern"])))
    hit = F.col("hit")
    searched = F.when(hit["group"] == AD_GROUP, url_decode_gbk(url)).otherwise(ref)
    has_key = (hit["key"] != "") & engine.matches(searched, hit["key"])
    word = F.when(has_key, url_decode_gbk(engine.group(searched, hit["key"], hit["key_group"]))).otherwise("")
    kind = F.when(has_key, engine.group(searched, hit["key"], hit["kind_group"])).otherwise("")
    for k, meaning in EMPTY_AD_KEYS.items():
        word = F.when((hit["group"] == AD_GROUP) & (word == "") & (kind == k), meaning).otherwise(word)
    shop = F.when(hit["shop"] != "", engine.group(url_decode_gbk(against(hit)), hit["shop"], F.lit(1))).otherwise("")
    own = (hit["shop"] != "") & engine.matches(url_decode_gbk(against(hit)), hit["shop"]) & (shop == F.coalesce("k3", F.lit("")))
    link = url_decode_gbk(engine.group(ref, hit["via"], F.lit(1)))
    page = url_decode_gbk(engine.group(link, hit["page"], F.lit(1)))
    whole = lambda c: F.regexp_like(c, F.lit(r"(?i)^https?://.+"))
    affiliate = F.when(engine.matches(ref, hit["via"]), F.when(whole(page), page).otherwise(NO_AFFILIATE_PAGE)).otherwise(F.when(whole(ref), ref).otherwise(NO_AFFILIATE_PAGE))
    found = found.withColumns(
        {
            "src_id": F.when(hit.isNull(), UNKNOWN_SOURCE).when(own, OWN_SHOP).otherwise(hit["src_id"]),
            "ref_url": F.when(hit["pattern"] == "", "").when(hit["via"] != "", affiliate).when(hit["keep_referrer"], ref).otherwise(""),
            "src_key": F.coalesce(word, F.lit("")),
            "source_rule": F.coalesce(hit["name"], F.lit("")),
        }
    )
    bare = F.regexp_replace(F.regexp_replace("src_key", r"\s+", " "), "\\x05", "")
    return found.withColumn("src_key_type", F.when(bare != "", F.coalesce(hit["key_type"], F.lit(NO_KEY))).otherwise(NO_KEY)).drop("hit")


def page_classify(df: DataFrame, rules: list[PageRule], url: str = "url", title: str = "title", item_suffix: str = "", literal_rules: int | None = None) -> DataFrame:
    """df with PAGE_FIELDS of each row's url and title; nulls count as empty."""
    engine.checked(rules)
    return _by_distinct(df, [url, title], lambda keys: _page_info(keys, rules, item_suffix, literal_rules), PAGE_FIELDS)


def referrer_classify(df: DataFrame, rules: list[SourceRule], url: str = "url", ref: str = "refer_url", shop: str = "shop_id", literal_rules: int | None = None) -> DataFrame:
    """df with SOURCE_FIELDS of each row's url, referrer and shop; nulls count as empty."""
    engine.checked(rules)
    return _by_distinct(df, [url, ref, shop], lambda keys: _source_info(keys, rules, literal_rules), SOURCE_FIELDS)


def _by_distinct(df: DataFrame, columns: list[str], run, fields: tuple[str, ...]) -> DataFrame:
    names = [f"k{i}" for i in range(1, len(columns) + 1)]
    own = df.drop(*fields)
    keyed = [F.col(c).cast("string").alias(n) for c, n in zip(columns, names, strict=True)]
    if df.isStreaming:  # no join back in a stream: classify each row
        whole = run(own.select(F.struct("*").alias("__row"), *keyed))
        return whole.select("__row.*", *fields)
    found = run(df.select(*keyed).distinct()).select(*names, *fields)
    on = F.lit(True)
    for c, n in zip(columns, names, strict=True):
        on = on & F.col(c).cast("string").eqNullSafe(F.col(n))
    return own.join(found, on, "left").drop(*names)


def rule_hits(df: DataFrame, rules: list, column: str) -> DataFrame:
    """Rows that each rule has decided, 0 for rules without any, and, as rule '', those that none has."""
    counted = df.groupBy(F.col(column).alias("rule")).agg(F.count(F.lit(1)).alias("hits"))
    named = df.sparkSession.createDataFrame([(r.name,) for r in rules] + [("",)], "rule string")
    return named.join(counted, "rule", "left").select("rule", F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"))


def keyword_precedence(df: DataFrame, search_type: str = SEARCH, shop: str = "shop_id", title: str = "title") -> DataFrame:
    """keyword and keyword_type: on search pages a paid source's keyword, or else the page's; on others the source's.

    Rows without shop or title get neither. search_type '3' is how an older version told search pages.
    """
    page, paid = F.col("page_type") == search_type, F.col("src_key_type") == AD_KEY
    use_page = page & ~paid
    there = (F.coalesce(F.col(shop).cast("string"), F.lit("")) != "") & (F.coalesce(F.col(title), F.lit("")) != "")
    pick = lambda a, b: F.when(there, F.when(use_page, F.col(a)).otherwise(F.col(b)))
    return df.withColumns({"keyword": pick("key", "src_key"), "keyword_type": pick("key_type", "src_key_type")})


def _read(spark: SparkSession, path: str, kind: type) -> list:
    rows = [{k: v for k, v in r.asDict().items() if k != "no" and v is not None} for r in spark.read.json(path).orderBy("no").collect()]
    rules = [kind(**{k: int(v) if isinstance(v, int) and not isinstance(v, bool) else v for k, v in row.items()}) for row in rows]
    engine.checked(rules)
    return rules


def read_page_rules(spark: SparkSession, path: str) -> list[PageRule]:
    """A rule table from JSON lines with the fields of PageRule, in the order of `no`."""
    return _read(spark, path, PageRule)


def read_source_rules(spark: SparkSession, path: str) -> list[SourceRule]:
    return _read(spark, path, SourceRule)
