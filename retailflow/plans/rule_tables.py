"""Rule tables of the sample sites, with a URL that each rule is meant for, and the same rules as SQL.

Shops have pages on three platforms; each page form below makes a rule a platform. `{n}` in a sample is a row's number.
Rules of any host come after those of a platform, in the section of their page type.
"""

from __future__ import annotations

from ..operators.classify import (
    AD_GROUP, AD_KEY, AFFILIATE_KEY, ALL_ITEMS, CATEGORY, COMMUNITY, DIRECT_GROUP, EMPTY_AD_KEYS, ENGINE_GROUP, ENGINE_KEY, HOME, ITEM, LABEL, MALL_KEY, NO_AFFILIATE_PAGE, NO_KEY,
    OTHER_GROUP, OWN_SHOP, PARTNER_GROUP, SEARCH, SELF_GROUP, SHOP_KEY, SITE_GROUP, SITE_KEY, SOCIAL_GROUP, UNKNOWN, UNKNOWN_SOURCE, PageRule, SourceRule,
)

PLATFORMS = {"store": "store.example.com", "mall": "mall.example.net", "market": "market.example.org"}

#: Page type -> form name, what follows the host, a sample of it, and what else the rule says.
FORMS: dict[str, list[tuple[str, str, str, dict]]] = {
    SEARCH: [
        ("by_word", r"/search\?q=([^&#]*)&low=(\d*)&high=(\d*)", "/search?q=red+hat&low={n}&high=", {"key": 1, "low_price": 2, "high_price": 3, "token": "search"}),
        ("by_price", r"/search\?low=(\d*)&high=(\d*)&q=([^&#]*)", "/search?low=&high={n}&q=null", {"key": 3, "low_price": 1, "high_price": 2, "token": "search"}),
        ("page", r"/search\.htm\?(?:.*&)?keyword=([^&#]+)", "/search.htm?sort=1&keyword=scarf{n}", {"key": 1, "token": "search"}),
        ("numbered", r"/search-\d+\.htm\?key=([^&#]*)&from=(\d*)&to=(\d*)", "/search-{n}.htm?key=coat&from=1&to=9", {"key": 1, "low_price": 2, "high_price": 3}),
        ("find_priced", r"/find/([^/?#]+)/to-(\d+)", "/find/a%7Cb/to-{n}", {"key": 1, "high_price": 2, "token": "find"}),
        ("find", r"/find/([^/?#]+)$", "/find/belt{n}", {"key": 1, "token": "find"}),
    ],
    CATEGORY: [
        ("named", r"/category-(\d+)\.htm\?name=([^&#]+)", "/category-{n}.htm?name=Red-Shoes{n}", {"key": 1, "title": 2}),
        ("plain", r"/category-(\d+)\.htm", "/category-{n}.htm", {"key": 1}),
        ("coded", r"/\?cid=(\d+)&cname=([^&#]+)", "/?cid={n}&cname=YmFncw==", {"key": 1, "title": 2, "token": "cname"}),
        ("numbered", r"/\?cid=(\d+)", "/?cid={n}&page=2", {"key": 1, "token": "cid"}),
        ("list", r"/list/(\d+)-\w+", "/list/{n}-hats", {"key": 1, "token": "list"}),
        ("brand", r"/brand/(\w+)", "/brand/b{n}", {"key": 1, "key_name": "brand", "token": "brand"}),
        ("in_search", r"/search\.htm\?.*cid=(\d+)", "/search.htm?keyword=%25zz%&cid={n}", {"key": 1, "token": "search"}),
    ],
    ALL_ITEMS: [
        ("all", r"/all\.htm", "/all.htm?page={n}", {"key_name": "all", "token": "all"}),
        ("items", r"/all-items(?:/|$)", "/all-items/{n}", {"key_name": "all", "token": "items"}),
        ("view", r"/\?view=all", "/?view=all&page={n}", {"key_name": "all", "token": "view"}),
        ("shelf", r"/shelf\.htm\?sort=\w+", "/shelf.htm?sort=new&page={n}", {"key_name": "all", "title_name": "shelf", "token": "shelf"}),
        ("new", r"/new-arrivals", "/new-arrivals?{n}", {"key_name": "all", "token": "arrivals"}),
    ],
    ITEM: [
        ("by_id", r"/item\.htm\?id=(\d+)", "/item.htm?id={n}", {"key": 1, "token": "item"}),
        ("path", r"/item/(\d+)", "/item/{n}", {"key": 1, "token": "item"}),
        ("short", r"/i(\d+)\.htm", "/i{n}.htm", {"key": 1}),
        ("product", r"/product-(\d+)", "/product-{n}#top", {"key": 1, "token": "product"}),
        ("detail", r"/detail\?(?:.*&)?item=(\d+)", "/detail?a=1&item={n}", {"key": 1, "token": "detail"}),
        ("deal", r"/deal/(\d+)", "/deal/{n}", {"key": 1, "token": "deal"}),
    ],
    LABEL: [
        ("about", r"/about\.htm", "/about.htm?{n}", {"key_name": "intro", "token": "about"}),
        ("service", r"/service\.htm", "/service.htm?{n}", {"key_name": "service", "token": "service"}),
        ("tag", r"/tag/\w+", "/tag/t{n}", {"key_name": "tag", "token": "tag"}),
        ("guide", r"/guide/", "/guide/{n}", {"key_name": "guide", "title_name": "guide", "token": "guide"}),
    ],
    COMMUNITY: [
        ("club", r"/club/", "/club/{n}", {"key_name": "comm", "token": "club"}),
        ("reviews", r"/reviews/\d+", "/reviews/{n}", {"key_name": "comm", "token": "reviews"}),
        ("forum", r"/forum\?thread=\d+", "/forum?thread={n}", {"key_name": "comm", "token": "forum"}),
    ],
    HOME: [
        ("root", r"/?$", "/", {"key_name": "first", "unless": r"//m\."}),
        ("index", r"/index\.htm", "/index.htm?{n}", {"key_name": "first", "token": "index"}),
        ("returned", r"/\?from=home", "/?from=home&{n}", {"key_name": "first", "token": "from"}),
    ],
}

#: Rules of any host, for the sample pages: after those of the platforms, in the section of their page type.
ANYWHERE = {
    SEARCH: [PageRule("search", r"^https?://[^/]+/search\?(?:.*&)?q=([^&#]*)(?:&low=(\d*))?(?:&high=(\d*))?", SEARCH, key=1, low_price=2, high_price=3, key_name="shop_search", title_name="search", token="search")],
    CATEGORY: [PageRule("paged", r"^https?://[^/]+/(\w{2})/(\d+)\?page=(\d+)", CATEGORY, key=2, unless=r"//m\.", token="page")],
    ALL_ITEMS: [PageRule("list", r"^https?://[^/]+/(\w{2})/(\d+)/$", ALL_ITEMS, key_name="all_items")],
    ITEM: [PageRule("item", r"^https?://[^/]+/\w{2}/(\d+)\.html", ITEM, key=1, token="html")],
    LABEL: [PageRule("label", r"#top$", LABEL, key_name="label", token="top")],
    COMMUNITY: [],
    HOME: [PageRule("home", r"^https?://[^/]+/?$", HOME, key_name="home")],
}


def _page_rules() -> tuple[list[PageRule], list[str]]:
    rules, samples = [], []
    for page_type, forms in FORMS.items():
        for name, path, sample, more in forms:
            for platform, host in PLATFORMS.items():
                words = {"key_name": "dp_search", "title_name": "search"} if page_type == SEARCH else {}
                rules.append(PageRule(f"{platform}_{page_type}_{name}", rf"^https?://[\w-]+\.{host.replace('.', r'\.')}(?::80)?{path}", page_type, **{"host": host} | words | more))
                samples.append(f"http://Shop{{n}}.{host}{sample}")
        rules += ANYWHERE[page_type]
        samples += [{"search": "http://shop.example.com/search?q=word{n}&low=3", "paged": "https://www.a.example.com/en/{n}?page=2", "list": "https://b.example.org/de/{n}/", "item": "http://c.example.net/fr/{n}.html", "label": "http://d.example.com/x{n}#top", "home": "http://e{n}.example.org/"}[r.name] for r in ANYWHERE[page_type]]
    return rules, samples


PAGE_RULES, PAGE_SAMPLES = _page_rules()
#: URLs that no rule is for: another site, a page that an exception leaves out, a search without a word, and nothing.
UNRULED_PAGES = ["ftp://files.example.com/{n}", "http://m.store.example.com", "http://s.mall.example.net/find/%25{n}", ""]


# The numbers of the sources.
_ADS = {"cpm": "13", "fixed": "14", "broadcast": "18", "brand": "12", "chat": "15", "rich": "16", "plus": "80"}
_OWN_PAGES = {"shops": "2", "items": "3", "bought": "5", "cart": "7"}
_CHANNELS = {
    "home": "21", "category": "22", "list": "23", "promo": "24", "auction": "25", "coupon": "27", "gift": "28", "brand": "31", "trial": "32", "style": "34", "digital": "35", "club": "37", "travel": "38", "books": "39",
    "food": "41", "kids": "43", "beauty": "44", "sport": "45", "garden": "46", "cars": "47", "pets": "48", "jewels": "49", "tools": "50", "second": "52", "help": "53", "mail": "54", "maps": "57",
}
_SOCIAL = {"micro": "114", "video": "115", "photo": "116", "friends": "117"}
_PARTNERS = {"compare": "106", "rebate": "110"}
_ENGINES = {"alpha": ("63", "q"), "beta": ("64", "wd"), "gamma": ("65", "query"), "delta": ("66", "p"), "epsilon": ("67", "w"), "zeta": ("68", "key"), "eta": ("69", "s"), "theta": ("70", "search"), "iota": ("71", "term"), "kappa": ("72", "text"), "lambda": ("73", "k"), "omega": ("111", "kw")}


def _source_rules() -> tuple[list[SourceRule], list[tuple[str, str]]]:
    """Rules, and for each a URL and a referrer that it is meant for."""
    page = "http://shop.example.com/{n}"
    both: list[tuple[SourceRule, str, str]] = [(SourceRule("direct", "", "6", DIRECT_GROUP), page, "")]
    other = "http://x.example.com/"
    word = SourceRule("ad_word", r"[?&]ad=word(?:&|$)", "11", AD_GROUP, use="url", key=r"bid=(\d):([^:&]*)", key_group=2, kind_group=1, key_type=AD_KEY, token="word")
    both.append((word, page + "?ad=word&bid=3:hat{n}", other))
    both += [(SourceRule(f"ad_{name}", rf"[?&]ad={name}(?:&|$)", src, AD_GROUP, use="url", token=name), f"{page}?ad={name}", other) for name, src in _ADS.items()]
    affiliate = SourceRule("ad_affiliate", r"[?&]ad=affiliate(?:&|$)", "10", AD_GROUP, use="url", keep_referrer=True, via=r"^https?://click\.example\.net/\?(?:.+&)?tu=(.*?)(?:$|&)", page=r"[?&]ref=(.*?)(?:&|$)", token="affiliate")
    both.append((affiliate, page + "?ad=affiliate", "http://click.example.net/?tu=http%3A%2F%2Fc.example.org%2F%3Fref%3Dhttp%253A%252F%252Fpage{n}.example.com%252F"))
    both.append((SourceRule("ad_arena", r"^https?://[^/]+/arena/", "9", AD_GROUP, token="arena"), page, "http://y.example.com/arena/{n}"))
    both.append((SourceRule("ad_banner", r"^https?://(?:[\w-]+\.)*banner\.example\.net", "17", AD_GROUP, host="banner.example.net"), page, "http://a.banner.example.net/{n}?x=1"))
    both.append((SourceRule("ad_group_buy", r"^https?://deals\.example\.com", "40", AD_GROUP, host="deals.example.com"), page, "https://deals.example.com/{n}"))
    both.append((SourceRule("feed", r"[?&]utm_source=feed", "11", AD_GROUP, use="url", key=r"/(\d+)\?", key_type=AD_KEY, token="feed"), "http://d.example.com/en/{n}?utm_source=feed", other))
    both += [(SourceRule(f"own_{name}", rf"^https?://my\.example\.com/.*\bkind={name}(?:&|$)", src, SELF_GROUP, use="full", host="my.example.com"), page, f"http://my.example.com/?n={{n}}&kind={name}") for name, src in _OWN_PAGES.items()]
    for name, src, kind, host in (("site", "20", SITE_KEY, "find.example.com"), ("affiliate", "33", AFFILIATE_KEY, "aff.example.org"), ("mall", "36", MALL_KEY, "mallfind.example.net")):
        both.append((SourceRule(f"search_{name}", rf"^https?://{host.replace('.', r'\.')}/", src, SITE_GROUP, key=r"[?&]q=([^&]*)", key_type=kind, host=host), page, f"http://{host}/s?q=big+hat{{n}}"))
    both += [(SourceRule(f"channel_{name}", rf"^https?://{name}\.site\.example\.com", src, SITE_GROUP, host=f"{name}.site.example.com"), page, f"http://{name}.site.example.com/{{n}}") for name, src in _CHANNELS.items()]
    both.append((SourceRule("shop", r"^https?://(?:www|m)\.", "30", SITE_GROUP, use="full", shop=r"/(\d+)(?:[/?#.]|$)", keep_referrer=True), page, "http://www.s.example.com/{n}/"))
    both += [(SourceRule(f"social_{name}", rf"^https?://{name}\.social\.example\.net", src, SOCIAL_GROUP, host="social.example.net"), page, f"http://{name}.social.example.net/u{{n}}") for name, src in _SOCIAL.items()]
    both.append((SourceRule("blog", r"^https?://blog\.", "113", SOCIAL_GROUP, keep_referrer=True), page, "http://blog.a.example.com/{n}"))
    both += [(SourceRule(f"partner_{name}", rf"^https?://{name}\.partner\.example\.net", src, PARTNER_GROUP, keep_referrer=name == "rebate", host=f"{name}.partner.example.net"), page, f"http://{name}.partner.example.net/{{n}}") for name, src in _PARTNERS.items()]
    both += [(SourceRule(f"engine_{name}", rf"^https?://(?:[\w-]+\.)?{name}\.seek\.example\.org/", src, ENGINE_GROUP, key=rf"[?&]{param}=([^&]*)", key_type=ENGINE_KEY, host=f"{name}.seek.example.org"), page, f"http://a.{name}.seek.example.org/s?x=1&{param}=cat%20{{n}}") for name, (src, param) in _ENGINES.items()]
    both.append((SourceRule("engine", r"example\.org", "62", ENGINE_GROUP, use="full", key=r"[?&]page=(\d+)", key_type=ENGINE_KEY, token="org"), page, "http://e.example.org/?page={n}"))
    both.append((SourceRule("partner", r"example\.net", "105", PARTNER_GROUP, token="net"), page, "http://p.example.net/{n}"))
    both.append((SourceRule("elsewhere", r"^https?://(?:[\w-]+\.)*elsewhere\.example/", "74", OTHER_GROUP, keep_referrer=True, host="elsewhere.example"), page, "http://a.elsewhere.example/{n}"))
    return [b[0] for b in both], [b[1:] for b in both]


SOURCE_RULES, SOURCE_SAMPLES = _source_rules()
#: Further URLs and referrers: adverts without a word, links of affiliates without a page, a referrer of no rule.
ODD_SOURCES = [
    ("http://shop.example.com/?ad=word&bid=6:", "http://x.example.com/"), ("http://shop.example.com/?ad=word&bid=7:", "http://x.example.com/"), ("http://shop.example.com/?ad=word&bid=8:", "http://x.example.com/"),
    ("http://shop.example.com/?ad=affiliate", "http://click.example.net/?tu=nothing"), ("http://shop.example.com/?ad=affiliate", "http://z.example.com/{n}"), ("http://shop.example.com/?ad=affiliate", "file:{n}"),
    ("http://shop.example.com/", "http://find.example.com/"), ("http://shop.example.com/", "gopher:{n}"),
]


# ---- the same rules as SQL, one after the other


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _case(column: str, values: list[str], other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {no} THEN {v}" for no, v in enumerate(values, 1) if v != other) + f" ELSE {other} END" if any(v != other for v in values) else other


def _match(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {_q('(?i)' + pattern)})"


def _part(text: str, pattern: str, position: int) -> str:
    return f"regexp_extract({text}, {_q('(?i)' + pattern)}, {position})" if position and pattern else "''"


def _unquoted(text: str) -> str:
    """Escapes of the samples: '+' and those of ASCII characters."""
    return f"url_decode(replace({text}, '+', ' '))"


def page_sql(source: str) -> str:
    """source: SQL with n, url and title. Rules are tried one by one."""
    word = [f"replace({_unquoted(f'trim({_part("x", r.pattern, r.key)})')}, '|', '')" if r.page_type == SEARCH else "''" for r in PAGE_RULES]
    price = [f"{f'{_part("x", r.pattern, r.low_price)} || ' if r.low_price else ''}'~' || {_part('x', r.pattern, r.high_price)}" if r.page_type == SEARCH and (r.low_price or r.high_price) else "''" for r in PAGE_RULES]
    tests = []
    for no, (r, w, p) in enumerate(zip(PAGE_RULES, word, price, strict=True), 1):
        test = _match("x", r.pattern) + (f" AND NOT {_match('x', r.unless)}" if r.unless else "")
        tests.append(f"WHEN {test}{f' AND {w} || {p} <> {_q("")} AND NOT contains({w} || {p}, {_q("%")})' if r.page_type == SEARCH else ''} THEN {no}")
    column = lambda values, other="''": _case("no", values, other)
    return f"""WITH s AS ({source}), u AS (SELECT *, replace(replace(coalesce(url, ''), '=null', '='), ' ', '') AS x, split_part(title, '-', 1) AS name FROM s),
    r AS (SELECT *, CASE {' '.join(tests)} ELSE 0 END AS no FROM u),
    c AS (SELECT n, title, name, no, {column([_q(r.name) for r in PAGE_RULES])} AS page_rule, {column([_q(r.page_type) for r in PAGE_RULES], _q(UNKNOWN))} AS page_type,
      {column([_part('x', r.pattern, r.key) if r.page_type in (CATEGORY, ITEM) else "''" for r in PAGE_RULES])} AS found, {column([_q(r.key_name) for r in PAGE_RULES])} AS key_name, {column([_q(r.title_name) for r in PAGE_RULES])} AS title_name,
      {column([_part('x', r.pattern, r.title) if r.page_type == CATEGORY else "''" for r in PAGE_RULES])} AS category, {column(word)} AS word, {column(price)} AS price FROM r)
    SELECT n, page_rule, page_type, CASE WHEN found <> '' THEN found ELSE key_name END AS key_info,
      CASE WHEN page_type = {_q(ITEM)} THEN title WHEN regexp_full_match(category, '[a-zA-Z0-9/+=]+') THEN decode(from_base64(category)) WHEN category <> '' THEN category WHEN title_name <> '' THEN title_name ELSE name END AS title_info,
      CASE WHEN page_type = {_q(SEARCH)} THEN word || '||' || price ELSE '' END AS key, CASE WHEN page_type = {_q(SEARCH)} THEN {_q(SHOP_KEY)} ELSE {_q(NO_KEY)} END AS key_type FROM c"""


def source_sql(source: str) -> str:
    """source: SQL with n, url, ref and shop. Rules are tried one by one."""
    against = lambda r: "url" if r.use == "url" else "ref" if r.use == "full" else "split_part(ref, '?', 1)"
    tests = [f"WHEN {_match(against(r), r.pattern) if r.pattern else f'ref = {_q("")}'} THEN {no}" for no, r in enumerate(SOURCE_RULES, 1)]
    searched = lambda r: _unquoted("url") if r.group == AD_GROUP else "ref"
    column = lambda values, other="''": _case("no", values, other)
    empty = " ".join(f"WHEN word = '' AND kind = {_q(k)} THEN {_q(v)}" for k, v in EMPTY_AD_KEYS.items())
    affiliate = next(r for r in SOURCE_RULES if r.via)
    link = _unquoted(_part("ref", affiliate.via, 1))
    return f"""WITH s AS ({source}), r AS (SELECT *, CASE {' '.join(tests)} ELSE 0 END AS no FROM s),
    c AS (SELECT n, ref, shop, {column([_q(r.name) for r in SOURCE_RULES])} AS source_rule, {column([_q(r.src_id) for r in SOURCE_RULES], _q(UNKNOWN_SOURCE))} AS src, {column([_unquoted(_part(searched(r), r.key, r.key_group)) if r.key else "''" for r in SOURCE_RULES])} AS word,
      {column([_part(searched(r), r.key, r.kind_group) for r in SOURCE_RULES])} AS kind, {column([_q(r.key_type) for r in SOURCE_RULES], _q(NO_KEY))} AS kinds, {column([_part('ref', r.shop, 1) for r in SOURCE_RULES])} AS from_shop,
      {column(['true' if r.keep_referrer else 'false' for r in SOURCE_RULES], 'false')} AS keeps, {column(['true' if r.via else 'false' for r in SOURCE_RULES], 'false')} AS affiliate FROM r),
    k AS (SELECT *, CASE {empty} ELSE word END AS src_key, {_unquoted(_part(link, affiliate.page, 1))} AS page FROM c)
    SELECT n, source_rule, CASE WHEN from_shop <> '' AND from_shop = shop THEN {_q(OWN_SHOP)} ELSE src END AS src_id,
      CASE WHEN affiliate AND {_match('ref', affiliate.via)} THEN CASE WHEN regexp_matches(page, '^https?://.+') THEN page ELSE {_q(NO_AFFILIATE_PAGE)} END
        WHEN affiliate THEN CASE WHEN regexp_matches(ref, '^https?://.+') THEN ref ELSE {_q(NO_AFFILIATE_PAGE)} END WHEN keeps THEN ref ELSE '' END AS ref_url,
      src_key, CASE WHEN src_key <> '' THEN kinds ELSE {_q(NO_KEY)} END AS src_key_type FROM k"""
