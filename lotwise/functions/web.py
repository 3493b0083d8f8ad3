"""Fields of ad pages: what the URL tells, what the HTML holds, and the order in which sources are trusted."""

from __future__ import annotations

import html
from collections import Counter
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spec-list labels of each field, in order of trust, the sentences of page descriptions, words of pages that
# turn robots away, and paths of structured data.
SPEC_LABELS = {
    "mileage_raw": ["Mileage"],
    "fuel_type": ["Fuel"],
    "transmission": ["Transmission"],
    "color": ["Color", "Colour"],
    "body_type": ["Body Type"],
    "engine_capacity_raw": ["Engine Capacity", "Engine Type"],
    "year_raw": ["Registration Year", "Model Year"],
}
DETAIL_PATTERN = r"(?i)(\d+)\s*cc,\s*([A-Za-z][\w\-]*)\s+([\d,]+)\s*KM\s*Driven,\s*([A-Za-z]+)\s*Car"  # engine, colour, mileage, gearbox
PRICE_PATTERN = r"(?i)for\s+PKR\s+([\d,.]+\s*(?:lacs?|lakhs?|crores?|cr)?)"
YEAR_PATTERN = r"\b(19|20)\d{2}\b"
BLOCK_WORDS = ["captcha", "unusual traffic", "access denied", "verify you are human", "temporarily blocked", "rate limit"]
LD_PATHS = {
    "model": "$.model", "year_raw": "$.modelDate", "mileage_raw": "$.mileageFromOdometer", "fuel_type": "$.fuelType",
    "transmission": "$.vehicleTransmission", "engine_capacity_raw": "$.vehicleEngine.engineDisplacement", "color": "$.color",
    "body_type": "$.bodyType", "description": "$.description", "price_raw": "$.offers.price", "price_currency": "$.offers.priceCurrency",
}


def listing_id(url: Column) -> Column:
    """Digits after the last hyphen of the path."""
    return F.nullif(F.regexp_extract(url, r"-([0-9]+)/?(?:[?#].*)?$", 1), F.lit("")).try_cast("long")


def page_number(url: Column) -> Column:
    """The `page` parameter, 1 where there is none or it is no number."""
    return F.coalesce(F.regexp_extract(url, r"[?&]page=([0-9]+)", 1).try_cast("int"), F.lit(1))


def next_page_url(url: Column) -> Column:
    """The same URL with its `page` parameter one higher (added where missing); blank parameters are left out."""
    base, query = F.regexp_extract(url, r"^[^?#]*", 0), F.regexp_extract(url, r"\?([^#]*)", 1)
    mark = F.regexp_extract(url, r"#.*$", 0)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]+=.+"))
    name = lambda p: F.substring_index(p, "=", 1)
    first = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, 1, i), lambda q: name(q) == name(p)))
    page = F.concat(F.lit("page="), (page_number(url) + 1).cast("string"))
    moved = F.transform(first, lambda p: F.when(name(p) == "page", page).otherwise(p))
    return F.concat(base, F.lit("?"), F.array_join(F.when(F.exists(first, lambda p: name(p) == "page"), moved).otherwise(F.concat(first, F.array(page))), "&"), mark)


def was_redirected(url: Column, requested_page: Column) -> Column:
    return page_number(url) != requested_page


def looks_blocked(page: Column, within: int = 800) -> Column:
    head = F.lower(F.substring(F.coalesce(page, F.lit("")), 1, within))
    return head.rlike("|".join(BLOCK_WORDS))


@F.pandas_udf(T.StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(lambda v: html.unescape(v).replace("\xa0", " "), na_action="ignore")


def _entities(c: Column) -> Column:
    """All named and numbered character references. Only texts that have one cross to Python; others cross as nulls."""
    return F.coalesce(_unescape(F.when(c.contains("&"), c)), c)


def ampersands(c: Column) -> Column:
    """The one reference `&amp;` alone; all else stays as it is written."""
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def page_title(page: Column, decode: Callable[[Column], Column] = _entities) -> Column:
    """The title up to its first bar, with its character references read by `decode`: all of them, or `ampersands`."""
    raw = decode(F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1))
    return F.nullif(F.trim(F.substring_index(F.trim(raw), "|", 1)), F.lit(""))


def title_city(title: Column) -> Column:
    """What follows the last "for sale in"."""
    return F.nullif(F.trim(F.regexp_extract(title, r"(?is)^.*for sale in(.*)$", 1)), F.lit(""))


class _Page(HTMLParser):
    """Collects the parts of one page that regular expressions can't cut out."""

    _VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, dict[str, str], list[str]]] = []
        self.inside: Counter[str] = Counter()  # open tags of each kind that matters
        self.ld, self.specs, self.items, self.icons = [], [], [], []
        self.meta = self.hidden = self.comments = None
        self.carousel, self.ribbon, self.heading, self.in_comments = False, False, False, 0

    @staticmethod
    def _kinds(tag: str, a: dict[str, str]) -> list[str]:
        kinds = ["li"] if tag == "li" else []
        if tag == "ul" and "scroll_car_detail" in a.get("id", "").split():
            kinds.append("specs")
        if tag == "ul" and "car-feature-list" in a.get("class", "").split():
            kinds.append("items")
        return [*kinds, "carousel"] if a.get("id") == "myCarousel" else kinds

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        classes = a.get("class", "").split()
        if tag == "meta" and a.get("name") == "description" and self.meta is None:
            self.meta = a.get("content")
        if tag == "input" and a.get("id") == "id" and self.hidden is None:
            self.hidden = a.get("value", "").strip()
        if tag == "img" and "feature-icon" in classes and a.get("alt", "").strip():
            self.icons.append(a["alt"].strip())
        if a.get("id") == "myCarousel":
            self.carousel = True
        if tag == "div" and "featured-ribbon" in classes and self.inside["carousel"]:
            self.ribbon = True
        if tag == "h2" and a.get("id") == "scroll_seller_comments":
            self.heading = True
        if tag == "div" and self.heading and self.comments is None:
            self.comments, self.in_comments = [], len(self.open) + 1
        if tag == "script" and a.get("type") == "application/ld+json":
            self.ld.append("")
        if tag == "li":
            (self.specs if self.inside["specs"] else self.items if self.inside["items"] else []).append([])
        if tag not in self._VOID:
            kinds = self._kinds(tag, a)
            self.inside.update(kinds)
            self.open.append((tag, a, kinds))

    def handle_endtag(self, tag):
        if any(t == tag for t, _, _ in self.open):
            last = None
            while last != tag:
                last, _, kinds = self.open.pop()
                self.inside.subtract(kinds)
        if self.in_comments > len(self.open):
            self.in_comments, self.heading = 0, False

    def handle_data(self, data):
        tag = self.open[-1][0] if self.open else ""
        if tag == "script":
            if self.open[-1][1].get("type") == "application/ld+json" and self.ld:
                self.ld[-1] += data
            return
        if self.inside["li"]:
            for found, inside in ((self.specs, self.inside["specs"]), (self.items, self.inside["items"])):
                if inside and found:
                    found[-1].append(data)
        if self.in_comments and data.strip():
            self.comments.append(data.strip())

    def row(self) -> dict:
        texts = lambda found: [" ".join(x).strip() for x in found]
        return {
            "ld": self.ld,
            "specs": [t for t in texts(self.specs) if t],
            "meta": self.meta,
            "hidden_id": self.hidden,
            "features": self.icons or texts(self.items),
            "comments": " ".join(self.comments or []) or None,
            "is_featured": self.ribbon if self.carousel else None,
        }


_TEXT, _TEXTS = T.StringType(), T.ArrayType(T.StringType())
_PARTS = T.StructType().add("ld", _TEXTS).add("specs", _TEXTS).add("meta", _TEXT).add("hidden_id", _TEXT).add("features", _TEXTS).add("comments", _TEXT).add("is_featured", T.BooleanType())


@F.udf(_PARTS, useArrow=False)
def parse_ad_html(source: str | None) -> dict:
    """Pages cross to Python by a hundred, not in Arrow batches of ten thousand: parsing a page takes far longer than handing it over,
    and a worker holds few of them."""
    page = _Page()
    page.feed(source or "")
    page.close()  # gives out the text at the end of a page that was cut short
    return page.row()


#: So that a filter on a parsed field neither parses every page a second time nor is moved in front of a shuffle.
parse_ad_html = parse_ad_html.asNondeterministic()


def _filled(*sources: Column) -> Column:
    """The first source that is neither null nor empty."""
    return F.coalesce(*[F.nullif(s, F.lit("")) for s in sources])


def extract_items(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Raw items of ad pages, one a row. Structured data is trusted most, then the spec list, the meta description and the
    title. A broken or missing part leaves its fields to the next source."""
    df = pages.withColumn("_p", parse_ad_html(html_col)).withColumn("title", page_title(F.col(html_col)))
    objects = F.flatten(F.transform("_p.ld", lambda raw: _as_objects(raw)))
    wanted = lambda v: F.exists(_types(v), lambda t: t.isin("Product", "Car", "Vehicle"))
    df = df.withColumn("_ld", F.get(F.filter(objects, wanted), F.lit(0)))
    at = lambda path: F.try_variant_get("_ld", path, "string")
    ld = {name: at(path) for name, path in LD_PATHS.items()}
    ld["brand"] = F.coalesce(at("$.brand.name"), F.when(~F.coalesce(at("$.brand").startswith("{"), F.lit(False)), at("$.brand")))
    specs = F.col("_p.specs")
    # The last of equal labels counts; a last label without a value is dropped.
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.expr("size(_p.specs) div 2 - 1"), F.lit(0))), lambda i: F.struct(F.get(specs, 2 * i).alias("k"), F.get(specs, 2 * i + 1).alias("v")))
    df = df.withColumn("_specs", F.filter(pairs, lambda p: p["v"].isNotNull()))
    spec = lambda label: F.try_element_at(F.filter("_specs", lambda p: p["k"] == label), F.lit(-1))["v"]
    meta = F.col("_p.meta")
    from_meta = {
        "engine_capacity_raw": F.regexp_extract(meta, DETAIL_PATTERN, 1),
        "color": F.regexp_extract(meta, DETAIL_PATTERN, 2),
        "mileage_raw": F.regexp_extract(meta, DETAIL_PATTERN, 3),
        "transmission": F.regexp_extract(meta, DETAIL_PATTERN, 4),
        "price_raw": F.regexp_extract(meta, PRICE_PATTERN, 1),
        "description": meta,
    }
    none = F.lit(None).cast("string")
    fields = {}
    for name in ["brand", *LD_PATHS]:
        fields[name] = _filled(ld[name], *[spec(label) for label in SPEC_LABELS.get(name, [])], from_meta.get(name, none))
    df = df.withColumns(fields)
    before = F.trim(F.get(F.split(F.col("title"), r"(?i)\bfor sale in\b"), F.lit(0)))
    words = F.filter(F.split(F.regexp_replace(before, YEAR_PATTERN, ""), r"\s+"), lambda w: w != "")
    guess = {"brand": F.get(words, F.lit(0)), "model": F.array_join(F.slice(words, 2, 1000), " "), "year_raw": F.regexp_extract(before, YEAR_PATTERN, 0)}
    return df.select(
        *[c for c in pages.columns if c not in (url_col, html_col) and c not in ("title", *fields)],
        F.coalesce(listing_id(F.col(url_col)), F.when(F.col("_p.hidden_id").rlike("^[0-9]+$"), F.col("_p.hidden_id").try_cast("long"))).alias("listing_id"),
        F.col(url_col).alias("ad_url"),
        "title",
        title_city(F.col("title")).alias("city"),
        *[_filled(F.col(n), guess[n]).alias(n) if n in guess else F.col(n) for n in fields],
        spec("Registered In").alias("registered_in"),
        spec("Assembly").alias("assembly"),
        F.col("_p.features").alias("features"),
        F.col("_p.comments").alias("seller_comments"),
        F.col("_p.is_featured").alias("is_featured"),
    )


def _as_objects(raw: Column) -> Column:
    """A JSON text as an array of its objects; broken JSON gives none."""
    v = F.try_parse_json(raw)
    many = F.try_variant_get(v, "$", "array<variant>")
    return F.coalesce(many, F.when(v.isNotNull(), F.array(v)), F.expr("cast(array() as array<variant>)"))


def _types(v: Column) -> Column:
    one = F.try_variant_get(v, "$['@type']", "string")
    return F.coalesce(F.try_variant_get(v, "$['@type']", "array<string>"), F.array(one))
