"""Web pages to lines, tables and pairs, and windows over a page's lines; regular expressions only, no document tree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceframe.functions import conform as c
from priceframe.functions import tables as t

col = F.col
# The entities that are decoded, the ampersand last.
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&euro;", "€"), ("&amp;", "&")]


def decode(text: Column) -> Column:
    for mark, plain in _ENTITIES:
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def html_text(html: Column) -> Column:
    """Clean text: no scripts, styles and comments, block tags as line ends, entities decoded."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</?(p|div|li|ul|ol|tr|table|h[1-6]|section|article|nav|header|footer|title)\b[^>]*>", "\n")
    return decode(F.regexp_replace(out, r"<[^>]*>", ""))


def html_lines(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row for each line of a page that has text, numbered from 0, white space collapsed."""
    lines = F.filter(F.transform(F.split(html_text(col(html)), "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    return pages.select(*[x for x in pages.columns if x != html], F.posexplode(lines).alias("line", "text"))


def html_tables(pages: DataFrame, roles: dict[str, str], html: str = "html") -> DataFrame:
    """Rows of the pages' tables, nested ones too, with spans filled (sources/grids.py): header cells get roles by the first
    keyword pattern they match, cells go to their column's role, rows with fewer cells than the header are skipped. table
    numbers a page's tables as they begin."""
    from priceframe.sources.grids import grids

    keys = [x for x in pages.columns if x != html]
    tables = pages.select(*keys, F.explode(grids(col(html))).alias("_t")).select(*keys, col("_t.table").alias("table"), F.get("_t.rows", 0).alias("_head"), F.posexplode("_t.rows").alias("row", "_cells"))
    rows = tables.where("row > 0 and size(_cells) >= size(_head)")
    at = lambda pattern: F.array_position(F.transform("_head", lambda h: h.rlike(f"(?i){pattern}")), True).cast("int") - 1
    return rows.select(*keys, "table", "row", *[F.when(at(p) >= 0, F.get("_cells", at(p))).alias(name) for name, p in roles.items()])


def gpu_price_pairs(texts: DataFrame, text: str, low: float = 0, high: float = 500) -> DataFrame:
    """Distinct (canonical gpu, price) where a price follows a GPU's name within 300 characters, or the name a price within 200;
    case and line ends do not matter, tags (and after a name other prices) end the search."""
    keys = [x for x in texts.columns if x != text]
    money = r"\$([\d.]+)"
    ahead, behind = rf"(?is)({t.MENTIONS_BEFORE_PRICE})[^$<]{{0,300}}{money}", rf"(?is){money}\s*(?:/\s*(?:GPU[- ]?hr|hr|hour))?[^<]{{0,200}}({t.MENTIONS_AFTER_PRICE})"
    pairs = lambda pattern, g, p: F.arrays_zip(F.regexp_extract_all(col(text), F.lit(pattern), g).alias("gpu"), F.regexp_extract_all(col(text), F.lit(pattern), p).alias("price"))
    found = texts.select(*keys, F.explode(F.concat(pairs(ahead, 1, 2), pairs(behind, 2, 1))).alias("_x")).select(*keys, col("_x.gpu").alias("_raw"), c.number(col("_x.price")).alias("price"))
    found = found.where((col("price") > low) & (col("price") <= high)).distinct()
    return found.select(*keys, c.norm_gpu_name(col("_raw")).alias("gpu"), "price").distinct()


def embedded_json(pages: DataFrame, html: str, pattern: str) -> DataFrame:
    """A row for each JSON value that a pattern's group captures in a page, as the variant ``json``; text that is no JSON is skipped."""
    keys = [x for x in pages.columns if x != html]
    blocks = pages.select(*keys, F.explode(F.regexp_extract_all(col(html), F.lit(pattern), 1)).alias("_b"))
    return blocks.select(*keys, F.try_parse_json("_b").alias("json")).where("json is not null")


def _elements(json: Column) -> Column:
    """The elements of an array or the values of an object; null for others."""
    return F.coalesce(F.try_variant_get(json, "$", "array<variant>"), F.map_values(F.try_variant_get(json, "$", "map<string,variant>")))


def search_json(rows: DataFrame, wanted: list[str], depth: int = 6, json: str = "json") -> DataFrame:
    """The objects, at most ``depth`` levels down, that have all the wanted keys. One walk over each value: the frontier holds
    the values of a level, and what it finds is kept as it goes on to their elements."""
    keys = [x for x in rows.columns if x != json]
    needs = F.array(*map(F.lit, wanted))
    none = F.expr("cast(array() as array<variant>)")

    def has(v: Column) -> Column:
        return F.size(F.array_intersect(F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.expr("cast(array() as array<string>)")), needs)) == len(set(wanted))

    def step(at: Column, _: Column) -> Column:
        below = F.flatten(F.transform(at["frontier"], lambda v: F.coalesce(_elements(v), none)))
        return F.struct(below.alias("frontier"), F.concat(at["found"], F.filter(below, has)).alias("found"))

    first = F.array(json)
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.struct(first.alias("frontier"), F.filter(first, has).alias("found")), step, lambda at: at["found"]) if depth > 0 else F.filter(first, has)
    return rows.where(F.col(json).isNotNull()).select(*keys, F.explode(walk).alias(json))


def jsonld_products(pages: DataFrame, html: str = "html") -> DataFrame:
    """Products of the pages' JSON-LD blocks (an object or a list of them): name, price and currency of the first offer, which
    may be an object or a list and its price a number or text; products without a positive price are skipped."""
    keys = [x for x in pages.columns if x != html]
    blocks = embedded_json(pages, html, r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>")
    item = F.coalesce(F.try_variant_get("json", "$", "array<variant>"), F.array("json"))
    items = blocks.select(*keys, F.explode(item).alias("_i"))
    get = lambda path: F.coalesce(F.try_variant_get("_i", f"$.offers{path}", "string"), F.try_variant_get("_i", f"$.offers[0]{path}", "string"))
    out = items.where(F.try_variant_get("_i", "$['@type']", "string") == "Product")
    return out.select(*keys, F.coalesce(F.try_variant_get("_i", "$.name", "string"), F.lit("")).alias("name"), c.number(get(".price")).alias("price"), F.coalesce(get(".priceCurrency"), F.lit("USD")).alias("currency")).where("price > 0")


def section_carry(lines: DataFrame, page: list[str], heading: Column, stop: Column | None = None, line: str = "line", into: str = "section") -> DataFrame:
    """The last heading at or before each line; nothing from the line on where stop first holds. A page's lines are one
    partition of the window, and pages are bounded."""
    upto = Window.partitionBy(*page).orderBy(line).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = lines.withColumn(into, F.last(heading, ignorenulls=True).over(upto))
    return out if stop is None else out.withColumn("_stop", F.max(stop.cast("int")).over(upto)).where("coalesce(_stop, 0) = 0").drop("_stop")


def lookahead(lines: DataFrame, page: list[str], value: Column, k: int, line: str = "line", into: str = "next_value") -> DataFrame:
    """The first value within the next k lines."""
    ahead = Window.partitionBy(*page).orderBy(line).rowsBetween(1, k)
    return lines.withColumn(into, F.first(value, ignorenulls=True).over(ahead))


def adjacent(lines: DataFrame, page: list[str], value: Column, line: str = "line", into: str = "next_value") -> DataFrame:
    """The value of the line right after."""
    return lines.withColumn(into, F.lead(value, 1).over(Window.partitionBy(*page).orderBy(line)))
