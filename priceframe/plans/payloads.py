"""Queries of the payload operators: payloads are built from the given tables and flattened back, pages are the given ones."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from priceframe.functions import conform as c
from priceframe.functions import tables as t
from priceframe.operators import flatten, text
from priceframe.plans.oracles import ORACLE_SQL
from priceframe.plans.queries import QUERIES, Query
from priceframe.sources import adapters
from priceframe.sources.shared import checkpoint_dir

col = F.col


def query(sql: str):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_ID = ", ".join(_IDS)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price FROM lineitem")
def flatten_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload for each order with its items in an array."""
    entry = F.struct("l_linenumber", "l_partkey", col("l_extendedprice").alias("price"))
    payloads = items(spark, sf_dir).groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(entry).alias("items"))).alias("body"))
    return flatten.flatten_items(payloads, "struct<items:array<struct<l_linenumber:int,l_partkey:long,price:double>>>", path="items")


@query(f"SELECT {_ID}, CASE WHEN l_linenumber % 3 = 0 THEN 'global' ELSE unnest(['r1', 'r' || l_suppkey % 5]) END AS region, l_linenumber % 3 <> 0 AS available FROM lineitem WHERE l_linenumber % 3 <> 0 UNION ALL SELECT {_ID}, 'global', false FROM lineitem WHERE l_linenumber % 3 = 0")
def flatten_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = F.when(col("l_linenumber") % 3 != 0, F.array(F.lit("r1"), F.concat(F.lit("r"), (col("l_suppkey") % 5).cast("string")))).otherwise(F.array().cast("array<string>"))
    return flatten.flatten_regions(items(spark, sf_dir).select(*_IDS, regions.alias("regions")))


@query(f"SELECT {_ID}, l_extendedprice AS price, 'global' AS region FROM lineitem UNION ALL SELECT {_ID}, l_quantity, 'east' FROM lineitem WHERE l_quantity <> l_extendedprice")
def regional_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = F.array(F.struct(F.lit("west").alias("region"), col("l_extendedprice").alias("price")), F.struct(F.lit("east").alias("region"), col("l_quantity").alias("price")))
    return flatten.regional_overrides(items(spark, sf_dir).select(*_IDS, col("l_extendedprice").alias("price"), over.alias("over")), "price", "over")


@query(f"SELECT {_ID}, 'on_demand' AS pricing_type, '' AS commitment_period, l_extendedprice AS price FROM lineitem WHERE l_extendedprice > 0 UNION ALL SELECT {_ID}, 'spot', '', l_discount FROM lineitem WHERE l_discount > 0 UNION ALL SELECT {_ID}, 'reserved', '1yr', l_tax FROM lineitem WHERE l_tax > 0")
def unpivot_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.unpivot_prices(items(spark, sf_dir), _IDS, {"l_extendedprice": ("on_demand", ""), "l_discount": ("spot", ""), "l_tax": ("reserved", "1yr")})


@query(f"SELECT {_ID}, CASE WHEN l_tax > 0 THEN l_tax WHEN l_discount > 0 THEN l_discount ELSE l_quantity END AS price, CASE WHEN l_tax > 0 THEN 'tax' WHEN l_discount > 0 THEN 'off' ELSE 'n' END AS model FROM lineitem")
def first_positive_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices in two currencies, of which one is chosen."""
    price = lambda m, v: F.struct(F.lit(m).alias("model"), v.alias("value"))
    local = lambda code, *prices: F.struct(F.lit(code).alias("currencyCode"), F.array(*prices).alias("prices"))
    places = F.array(local("EUR", price("eur", F.lit(9.0))), local("USD", price("x", F.lit(-1.0)), price("tax", col("l_tax")), price("off", col("l_discount")), price("n", col("l_quantity"))))
    return items(spark, sf_dir).select(*_IDS, flatten.first_price_in(places, "USD").alias("p")).select(*_IDS, col("p.value").alias("price"), "p.model")


@query("SELECT l_orderkey, l_suppkey % 3 AS place, NULL::BIGINT AS node, l_partkey, l_quantity FROM lineitem UNION ALL SELECT l_orderkey, NULL, l_suppkey % 2, l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 2 = 0")
def flatten_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with places and, every other one, with nodes; both hold parts."""

    def nested(outer: str, inner: str, key) -> DataFrame:
        one = items(spark, sf_dir).groupBy("l_orderkey", key.alias(inner)).agg(F.collect_list(F.struct("l_partkey", "l_quantity")).alias("parts"))
        return one.groupBy("l_orderkey").agg(F.collect_list(F.struct(inner, "parts")).alias(outer))

    both = nested("places", "place", col("l_suppkey") % 3).join(nested("nodes", "node", col("l_suppkey") % 2).where("l_orderkey % 2 = 0"), "l_orderkey", "left")
    return flatten.flatten_shapes(both, [("places", "parts"), ("nodes", "parts")])


@query(f"""SELECT {_ID}, CASE WHEN l_tax > 0.04 THEN l_tax WHEN l_discount > 0 THEN l_discount ELSE l_quantity END AS price, CASE WHEN l_tax > 0.04 THEN 'weightedAverage' WHEN l_discount > 0 THEN 'avg' ELSE 'med' END AS metric,
  '{{' || CASE WHEN l_tax > 0.04 THEN '"weightedAverage":' || l_tax || ',' ELSE '' END || '"avg":' || l_discount || ',"med":' || l_quantity || '}}' AS summary FROM lineitem""")
def metric_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = flatten.metric_summary({"weightedAverage": F.when(col("l_tax") > 0.04, col("l_tax")), "avg": col("l_discount"), "med": col("l_quantity")})
    return items(spark, sf_dir).select(*_IDS, best.alias("b")).select(*_IDS, "b.*")


@query(f"SELECT {_ID}, CASE WHEN l_linenumber = 1 THEN l_returnflag WHEN l_linenumber = 2 THEN l_linestatus ELSE '' END AS name FROM lineitem")
def alias_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [F.when(col("l_linenumber") == 1, F.concat(F.lit(" "), "l_returnflag")).otherwise(" "), F.when(col("l_linenumber") == 2, col("l_linestatus"))]
    return items(spark, sf_dir).select(*_IDS, flatten.alias_fallback(names).alias("name"))


@query(f"SELECT {_ID}, round(CASE l_linenumber % 4 WHEN 0 THEN l_extendedprice / 730 WHEN 1 THEN l_extendedprice / 100 WHEN 2 THEN l_extendedprice * 3600 / 100 ELSE l_extendedprice END, 6) AS price, round(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity + l_partkey / 1e9 END, 6) AS tier FROM lineitem")
def unit_to_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.element_at(F.array(F.lit("month"), F.lit("cents"), F.lit("cents_second"), F.lit("hour")), col("l_linenumber") % 4 + 1)
    tier = lambda a, b: F.struct(a.alias("units"), b.alias("nanos"))
    tiers = F.when(col("l_linenumber") % 2 == 0, F.array(tier(F.lit(1.0), F.lit(0).cast("long")), tier(col("l_quantity"), col("l_partkey"))))
    return items(spark, sf_dir).select(*_IDS, flatten.unit_to_hourly(col("l_extendedprice"), unit).alias("price"), F.round(flatten.last_tier_price(tiers), 6).alias("tier"))


_LABEL = "CASE l_partkey % 7 WHEN 0 THEN 'Spot A100' WHEN 1 THEN 'A100 80GB' WHEN 2 THEN 'a100' WHEN 3 THEN 'H100 3yr' WHEN 4 THEN 'h100 plain' WHEN 5 THEN '$2.50 per hour' ELSE '€ per month' END"


_TYPES = [("spot|preempt", "spot"), ("reserved|1yr|3yr", "reserved")]
_TERMS = [("3yr", "3yr"), ("1yr", "1yr")]
_MODELS = [("a100.*80", "A100 80GB"), ("a100", "A100"), ("h100", "H100")]


@query(f"""SELECT {_ID}, CASE l_partkey % 7 WHEN 0 THEN 'spot' WHEN 3 THEN 'reserved' ELSE 'on_demand' END AS pricing_type, CASE l_partkey % 7 WHEN 3 THEN '3yr' ELSE '' END AS commitment_period,
  CASE l_partkey % 7 WHEN 0 THEN 'A100' WHEN 1 THEN 'A100 80GB' WHEN 2 THEN 'A100' WHEN 3 THEN 'H100' WHEN 4 THEN 'H100' ELSE '' END AS gpu_name, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber ELSE 1 END AS gpu_count FROM lineitem""")
def classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(col("l_linenumber") % 2 == 0, F.concat(col("l_linenumber").cast("string"), F.lit(" x "), F.expr(_LABEL))).otherwise(F.expr(_LABEL))
    return items(spark, sf_dir).select(*_IDS, flatten.classify_offer(label, _TYPES, _TERMS, _MODELS).alias("c")).select(*_IDS, "c.*")


_SIZES = ["Standard_NC40ads_H100_v5", "Standard_NC80adis_H100_v5 Spot", "Standard_ND96isr_H200_v5", "Standard_NC24ads_A100_v4", "Standard_ND96ams_A100_v4 Low Priority", "Standard_ND96x", "Standard_NC96y 3 Year", "Standard_D4", "nd96as_a100 One Year"]
_PRODUCTS = ["NCads H100 Series", "", "A100 80GB", "a100 series", "NVads A10 v5", "NCas T4", "NV M60 or K80", "v100x", "general"]


def _chain(rules: list[tuple], fields: list[str], value: int) -> str:
    """The first rule that holds as a chain of conditions."""
    test = lambda x, no: f"{'NOT ' if no else ''}contains(lower({fields[int(x[0])]}), '{x[2:]}')"
    whens = " ".join(f"WHEN {' AND '.join([*[test(x, False) for x in r[0]], *[test(x, True) for x in r[1]]])} THEN {r[value]!r}" for r in rules)
    return f"CASE {whens} END"


@query(f"""WITH t AS (SELECT {_ID}, {_SIZES!r}[(l_partkey % 9 + 1)::INT] AS sku, {_PRODUCTS!r}[(l_suppkey % 9 + 1)::INT] AS product FROM lineitem), u AS (SELECT *, string_split(sku, ' ')[1] AS base FROM t)
  SELECT {_ID}, {_chain(t.SIZE_RULES, ["base", "product", "sku"], 2)} AS gpu, {_chain(t.SIZE_RULES, ["base", "product", "sku"], 3)} AS gb, {_chain(t.SIZE_RULES, ["base", "product", "sku"], 4)} AS gpus, {_chain(t.SIZE_RULES, ["base", "product", "sku"], 5)} AS variant,
  {_chain(t.DESCRIPTION_RULES, ["product"], 2)} AS described, coalesce({_chain(t.TERM_RULES, ["sku"], 2)}, 'on_demand') AS pricing_type, {_chain(t.TERM_RULES, ["sku"], 3)} AS term FROM u""")
def classify_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine sizes and products by the vendors' rule tables."""
    pick = lambda key, values: F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))
    rows = items(spark, sf_dir).select(*_IDS, pick(col("l_partkey"), _SIZES).alias("sku"), pick(col("l_suppkey"), _PRODUCTS).alias("product"))
    devices = flatten.rule_table(spark, t.SIZE_RULES, "gpu string, gb int, gpus int, variant string")
    described = flatten.rule_table(spark, t.DESCRIPTION_RULES, "described string, a int, b int, c string")
    terms = flatten.rule_table(spark, t.TERM_RULES, "pricing_type string, term string")
    out = flatten.classify_by_rules(rows, [F.substring_index("sku", " ", 1), col("product"), col("sku")], devices).drop("rule")
    out = flatten.classify_by_rules(out, [col("product")], described).drop("rule", "a", "b", "c")
    out = flatten.classify_by_rules(out, [col("sku")], terms)
    return out.select(*_IDS, "gpu", "gb", "gpus", "variant", "described", F.coalesce("pricing_type", F.lit("on_demand")).alias("pricing_type"), "term")


@query(f"SELECT {_ID}, CASE l_partkey % 7 WHEN 5 THEN 'USD' WHEN 6 THEN 'EUR' ELSE '' END AS currency, CASE l_partkey % 7 WHEN 5 THEN 'hour' WHEN 6 THEN 'month' ELSE '' END AS unit FROM lineitem")
def currency_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir).select(*_IDS, flatten.currency(F.expr(_LABEL)).alias("currency"), flatten.price_unit(F.expr(_LABEL)).alias("unit"))


@query(f"SELECT {_ID}, 'inference' AS pricing_type, 0.0::DOUBLE AS price_per_hour, 'token' AS price_unit, l_tax AS prompt FROM lineitem WHERE l_tax > 0 OR l_discount > 0")
def token_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = flatten.token_offers(items(spark, sf_dir).select(*_IDS, col("l_tax").alias("prompt"), col("l_discount").alias("completion")))
    return out.select(*_IDS, "pricing_type", "price_per_hour", "price_unit", F.get_json_object("raw_extra", "$.prompt").cast("double").alias("prompt"))


@query(f"SELECT {_ID}, CASE WHEN l_linenumber % 3 = 0 THEN l_quantity > 25 WHEN l_linenumber % 3 = 1 THEN l_partkey % 2 = 0 ELSE l_suppkey % 2 = 0 END AS available FROM lineitem")
def availability_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = col("l_linenumber") % 3
    count, stock = F.when(k == 0, col("l_quantity") - 25), F.when(k == 1, F.when(col("l_partkey") % 2 == 0, "In Stock").otherwise("sold out"))
    return items(spark, sf_dir).select(*_IDS, flatten.availability(count, stock, col("l_suppkey") % 2 != 0).alias("available"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'DE' ELSE 'N' || s_nationkey END AS country, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'City ' || s_suppkey END AS city, CASE WHEN s_suppkey % 3 = 0 THEN 'DE' ELSE 'City ' || s_suppkey || ', N' || s_nationkey END AS place FROM supplier")
def location_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places taken apart, and put together again without the state."""
    place = F.when(col("s_suppkey") % 3 == 0, "DE").otherwise(F.concat(F.lit(" City "), col("s_suppkey").cast("string"), F.lit(", State,  N"), col("s_nationkey").cast("string")))
    parts = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", *[v.alias(k) for k, v in flatten.location_parts(place).items()])
    return parts.withColumn("place", flatten.location_text([col("city"), F.lit(" "), col("country")]))


@query("SELECT p_partkey, round(CASE p_partkey % 4 WHEN 0 THEN p_size * 1.0 WHEN 1 THEN p_size * 1024.0 WHEN 2 THEN (p_size * 100) / 1024.0 ELSE (p_size + 4096) / 1024.0 END, 1)::DOUBLE AS gb FROM part")
def size_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = col("p_size").cast("string")
    label = F.element_at(F.array(F.concat(size, F.lit(" GiB")), F.concat(size, F.lit("TB")), F.concat((col("p_size") * 100).cast("string"), F.lit(" MiB")), (col("p_size") + 4096).cast("string")), (col("p_partkey") % 4 + 1).cast("int"))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", flatten.size_gb(label).alias("gb"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'H100' WHEN 1 THEN 'RTX 4090' ELSE 'MI300X' END AS gpu FROM part")
def row_gpu_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.when(col("p_partkey") % 3 == 0, F.array(F.lit("8"), F.lit("RTX 4090"), F.lit(" H100 "))).when(col("p_partkey") % 3 == 1, F.array(F.lit("9"), F.lit("GeForce RTX 4090"), F.lit("12"))).otherwise(F.array(F.lit("CPU"), F.lit("amd mi300x"), F.lit("")))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", flatten.first_gpu_cell(cells, F.lit(2)).alias("gpu"))


@query("SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN 'exact' WHEN contains(lower(p_type), 'steel') THEN 'steel' WHEN contains(lower(p_type), 'p') THEN 'p' ELSE '' END AS class FROM part")
def lookup_with_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", flatten.lookup_with_rules(col("p_brand"), col("p_type"), {"Brand#1": "exact"}, [("steel", "steel"), ("p", "p")]).alias("class"))


@query("SELECT p_partkey, (SELECT arg_max(v, length(p)) FROM (VALUES ('P', 'one'), ('PR', 'two'), ('ST', 'st'), ('S', 's'), ('ECONOMY', 'long')) t(p, v) WHERE starts_with(upper(p_type), p)) AS family FROM part")
def longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame([("P", "one"), ("PR", "two"), ("ST", "st"), ("S", "s"), ("ECONOMY", "long")], "p string, v string")
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.upper("p_type").alias("name"))
    return flatten.longest_prefix(rows, "name", known, "p", "v", "family").select("p_partkey", "family")


@query("SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def spec_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select(col("n_nationkey").alias("s_nationkey"), "n_name")
    return flatten.spec_lookup(spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey"), "s_nationkey", nations).select("s_suppkey", "n_name")


@query("SELECT l_orderkey, l_linenumber::VARCHAR AS number, 'P&' || l_partkey AS part, l_quantity::BIGINT::VARCHAR AS quantity FROM lineitem WHERE l_linenumber % 5 <> 4")
def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page with a table for each order; every fifth line lacks a cell and is skipped."""
    cell = lambda x: F.concat(F.lit("<td class='c'> "), x, F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), cell(col("l_linenumber").cast("string")), cell(F.concat(F.lit("<b>P&amp;"), col("l_partkey").cast("string"), F.lit("</b>"))), F.when(col("l_linenumber") % 5 != 4, cell(col("l_quantity").cast("long").cast("string"))).otherwise(""), F.lit("</tr>"))
    head = F.lit("<html><table><tr><th>Line no</th><th>Part name</th><th>Qty</th></tr>")
    pages = items(spark, sf_dir).groupBy("l_orderkey").agg(F.concat(head, F.concat_ws("", F.collect_list(row)), F.lit("</table></html>")).alias("html"))
    return text.html_tables(pages, {"number": "line", "part": "part", "quantity": "qty"}).drop("table", "row")


@query("""SELECT l_orderkey, 0 AS table, 'N' || l_suppkey % 4 AS provider, 'R' || l_linenumber AS gpu, l_quantity::BIGINT::VARCHAR AS price, CASE WHEN l_linenumber % 2 = 0 THEN 'both' ELSE 'spot' END AS billing FROM lineitem
UNION ALL SELECT l_orderkey, 1, 'inner', l_linenumber::VARCHAR, l_partkey::VARCHAR, NULL FROM lineitem""")
def html_table_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a table whose cells span rows and columns, and one nested in its last cell with a provider for all its rows."""
    cell = lambda x, more="": F.concat(F.lit(f"<td {more}>"), x, F.lit("</td>"))
    number, even = col("l_linenumber").cast("string"), col("l_linenumber") % 2 == 0
    row = F.concat(F.lit("<tr class=\"a>b\">"), cell(F.concat(F.lit("N"), (col("l_suppkey") % 4).cast("string"))), cell(F.concat(F.lit("<b>R"), number, F.lit("</b>"))), cell(col("l_quantity").cast("long").cast("string")), F.when(even, cell(F.lit("both"), "colspan=2")).otherwise(F.lit("<td>spot<td>x")), F.lit("</tr>"))
    small = F.concat(F.lit("<tr>"), F.when(col("_first"), F.concat(F.lit("<td rowspan='"), col("_of").cast("string"), F.lit("'>inner</td>"))).otherwise(""), cell(number), cell(col("l_partkey").cast("string")), F.lit("</tr>"))
    by = Window.partitionBy("l_orderkey")
    own = items(spark, sf_dir).withColumns({"_first": F.row_number().over(by.orderBy("l_linenumber")) == 1, "_of": F.count(F.lit(1)).over(by)})
    pages = own.groupBy("l_orderkey").agg(F.concat_ws("", F.collect_list(row)).alias("rows"), F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", (~col("_first")).alias("later"), small.alias("s")))), lambda x: x["s"])).alias("inner"))
    head = F.lit("<table><tr><th>Provider<th>GPU &amp; model<th>$/GPU/h<th colspan='2'>Billing</tr>")
    html = F.concat(head, "rows", F.lit("<tr><td>short<td><table><tr><th>provider</th><th>gpu</th><th>total/h</th></tr>"), "inner", F.lit("</table></table>"))
    found = text.html_tables(pages.select("l_orderkey", html.alias("html")), {"provider": "provider", "gpu": "gpu(?!/h)", "price": "gpu/h|total/h", "billing": "billing"})
    return found.drop("row")


@query("SELECT p_partkey, 'MI300X' AS gpu, (p_size + 0.5)::DOUBLE AS price FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'RTX 4090', (p_size + 0.5)::DOUBLE FROM part WHERE p_partkey % 2 = 1")
def gpu_price_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.concat(F.lit("$"), col("p_size").cast("string"), F.lit(".5"))
    line = F.when(col("p_partkey") % 2 == 0, F.concat(F.lit("<p>mi300x from\n one place,\n "), price, F.lit("/hr</p><p>NVIDIA H100 at $9999 a year</p>"))).otherwise(F.concat(price, F.lit(" / GPU-hr for\n a RTX  4090</b>")))
    return text.gpu_price_pairs(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", line.alias("text")), "text")


@query("SELECT p_partkey, p_name AS name, (p_size + 0.25)::DOUBLE AS price, CASE WHEN p_partkey % 3 = 1 THEN 'EUR' ELSE 'USD' END AS currency FROM part WHERE p_partkey % 3 <> 0")
def jsonld_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with one offer as an object and its price as text, or in a list of things with a list of offers."""
    offer = F.struct((col("p_size") + 0.25).cast("string").alias("price"), F.lit("EUR").alias("priceCurrency"))
    one = F.to_json(F.struct(F.lit("Product").alias("@type"), col("p_name").alias("name"), offer.alias("offers")))
    thing = F.to_json(F.struct(F.lit("Thing").alias("@type"), col("p_name").alias("name"), offer.alias("offers")))
    many = F.to_json(F.struct(F.lit("Product").alias("@type"), col("p_name").alias("name"), F.array(F.struct((col("p_size") + 0.25).alias("price")), F.struct(F.lit(1.0).alias("price"))).alias("offers")))
    body = F.when(col("p_partkey") % 3 == 0, thing).when(col("p_partkey") % 3 == 1, one).otherwise(F.concat(F.lit("["), thing, F.lit(","), many, F.lit("]")))
    html = F.concat(F.lit("<html><script id='a' type='application/ld+json' defer>"), body, F.lit("</script><script type='application/ld+json'>{broken</script></html>"))
    return text.jsonld_products(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", html.alias("html")))


@query("SELECT p_partkey, p_name AS name, (p_size + 0.25)::DOUBLE AS price FROM part UNION ALL SELECT p_partkey, 'deep', 7.0::DOUBLE FROM part WHERE p_partkey % 2 = 0")
def page_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices somewhere in a page's state object."""
    plan = lambda name, price: F.struct(name.alias("name"), price.alias("price"))
    deep = F.when(col("p_partkey") % 2 == 0, F.struct(F.array(F.struct(plan(F.lit("deep"), F.lit(7.0)).alias("plan"))).alias("plans")))
    state = F.to_json(F.struct(F.struct(F.array(plan(col("p_name"), col("p_size") + 0.25)).alias("list"), deep.alias("more")).alias("props"), F.lit("x").alias("name")))
    html = F.concat(F.lit("<script id='state'>"), state, F.lit("</script>"))
    found = text.embedded_json(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", html.alias("html")), "html", "(?is)<script id='state'>(.*?)</script>")
    get = lambda k, kind: F.try_variant_get("json", f"$.{k}", kind).alias(k)
    return text.search_json(found, ["name", "price"]).select("p_partkey", get("name", "string"), get("price", "double"))


_BULK = """SELECT o_orderkey, CASE l_linenumber % 3 WHEN 0 THEN 'Hrs' WHEN 1 THEN 'Quantity' ELSE 'GB' END AS unit, l_extendedprice AS price, CASE l_suppkey % 4 WHEN 0 THEN 'on_demand' WHEN 1 THEN 'capacity_block' WHEN 2 THEN 'capacity_reservation' ELSE 'other' END AS class,
  CASE l_partkey % 3 WHEN 0 THEN 'p5' WHEN 1 THEN 'p5en' ELSE '' END AS family, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""


@query(f"""WITH b AS ({_BULK}), g AS (SELECT o_orderkey, family, class, round(coalesce(sum(price) FILTER (WHERE unit = 'Hrs'), 0.0), 2) AS price_per_hour, round(coalesce(sum(price) FILTER (WHERE unit = 'Quantity'), 0.0), 2) AS upfront_price, min(l_linenumber) FILTER (WHERE unit <> 'GB') AS vcpus
  FROM b WHERE family <> '' AND unit <> 'GB' GROUP BY o_orderkey, family, class) SELECT 'r' || o_orderkey AS region, family, class AS billing_model, price_per_hour, upfront_price, vcpus::VARCHAR AS vcpus FROM g WHERE price_per_hour > 0 OR upfront_price > 0""")
def bulk_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bulk price file for each order: five lines, a header, and a quoted line for each item."""
    head = '"SKU","Product Family","PriceDescription","Unit","PricePerUnit","Region Code","Instance Type","CapacityStatus","vCPU"'
    pick = lambda key, *values: F.element_at(F.array(*map(F.lit, values)), (key + 1).cast("int"))
    cells = [
        F.lit("k"), F.lit("Compute Instance (bare, metal)"), pick(col("l_suppkey") % 4, "$1 per On Demand p5", "Capacity Block, 1", "x", "plain"), pick(col("l_linenumber") % 3, "Hrs", "Quantity", "GB"), col("l_extendedprice").cast("string"),
        F.concat(F.lit("r"), col("l_orderkey").cast("string")), pick(col("l_partkey") % 3, "p5.48xlarge", "p5en.48xlarge", "m5.large"), pick(col("l_suppkey") % 4, "Used", "Used", "AllocatedCapacityReservation", "Used"), col("l_linenumber").cast("string"),
    ]
    line = F.concat(F.lit('"'), F.concat_ws('","', *cells), F.lit('"'))
    lines = items(spark, sf_dir).select(col("l_orderkey").alias("file"), (col("l_linenumber") + 5).alias("line"), line.alias("text"))
    tops = items(spark, sf_dir).select(col("l_orderkey").alias("file")).distinct().select("file", F.posexplode(F.array(*[F.lit("FormatVersion,v1")] * 5, F.lit(head))).alias("line", "text"))
    out = flatten.bulk_components(flatten.bulk_records(lines.unionByName(tops)), ["p5", "p5en"])
    return out.select(col("Region Code").alias("region"), "family", "billing_model", F.round("price_per_hour", 2).alias("price_per_hour"), F.round("upfront_price", 2).alias("upfront_price"), "vcpus")


_BULK_FILES = """WITH l AS (SELECT l_orderkey, l_linenumber AS n, l_suppkey % 4 AS cls, l_partkey % 4 AS fam, l_suppkey % 3 AS term, l_extendedprice AS price, l_linenumber % 3 AS u, l_quantity > 25 AS told FROM lineitem),
p AS (SELECT l_orderkey, n, price, u, told, CASE fam WHEN 0 THEN 'p5' WHEN 1 THEN 'p5en' WHEN 2 THEN 'g6e' END AS family, CASE fam WHEN 0 THEN 'p5.48xlarge' WHEN 1 THEN 'p5en.48xlarge' WHEN 2 THEN 'g6e.12xlarge' END AS instance_type,
  CASE cls WHEN 0 THEN 'on_demand' WHEN 1 THEN 'capacity_block' WHEN 2 THEN 'capacity_reservation' ELSE 'other' END AS billing, CASE term WHEN 0 THEN 'Reserved' ELSE 'OnDemand' END AS term FROM l WHERE u < 2 AND fam < 3),
g AS (SELECT l_orderkey, family, instance_type, billing, term, arg_min(told, n) AS told, round(coalesce(sum(price) FILTER (WHERE u = 0), 0.0), 6) AS hourly, round(coalesce(sum(price) FILTER (WHERE u = 1), 0.0), 6) AS upfront FROM p GROUP BY ALL),
d AS (SELECT *, CASE family WHEN 'g6e' THEN 4 ELSE 8 END AS known, CASE WHEN told THEN 2 ELSE known END AS devices, term = 'Reserved' OR billing LIKE 'capacity%' AS reserved FROM g WHERE hourly > 0 OR upfront > 0)
SELECT l_orderkey, instance_type, family AS instance_family, CASE family WHEN 'p5' THEN 'H100' WHEN 'p5en' THEN 'H200' ELSE 'L40S' END AS gpu_name, CASE family WHEN 'p5' THEN '80' WHEN 'p5en' THEN '141' ELSE '48' END AS gpu_memory_gb, devices::VARCHAR AS gpu_count, '2048' AS ram_gb,
  CASE WHEN reserved THEN 'reserved' ELSE 'on_demand' END AS pricing_type, CASE WHEN term = 'Reserved' THEN '1yr' WHEN billing = 'capacity_block' THEN billing WHEN reserved THEN 'capacity_reservation' ELSE '' END AS commitment_period,
  round(hourly, 2) AS price_per_hour, round(upfront, 2) AS upfront_price, round(hourly / devices, 6) AS price_per_gpu_hour, billing AS billing_model FROM d"""


@query(_BULK_FILES)
def bulk_price_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk price files from landing to offers: files of some orders each are written, with cells over two lines, 150 columns and
    headers in two orders, and read back in small splits."""
    pick = lambda key, *values: F.element_at(F.array(*map(F.lit, values)), (key + 1).cast("int"))
    cells = {
        "SKU": F.lit("k"), "Product Family": F.lit("Compute Instance (bare, metal)"), "PriceDescription": pick(col("l_suppkey") % 4, '$1 per ""On Demand""\nhour', "Capacity Block,\n1", "x", "plain"), "Unit": pick(col("l_linenumber") % 3, "Hrs", "Quantity", "GB"),
        "PricePerUnit": col("l_extendedprice").cast("string"), "Region Code": F.lit("us-east-1"), "Location": col("l_orderkey").cast("string"), "Instance Type": pick(col("l_partkey") % 4, "p5.48xlarge", "p5en.48xlarge", "g6e.12xlarge", "m5.large"),
        "TermType": pick(col("l_suppkey") % 3, "Reserved", "OnDemand", "OnDemand"), "LeaseContractLength": pick(col("l_suppkey") % 3, "1yr", "", ""), "CapacityStatus": pick(col("l_suppkey") % 4, "Used", "Used", "AllocatedCapacityReservation", "Used"),
        "vCPU": col("l_linenumber").cast("string"), "Memory": F.lit("2,048 GiB"), "GPU": F.when(col("l_quantity") > 25, "2").otherwise("NA"), **{f"Note {k}": F.lit("") for k in range(136)},
    }
    # Lines of one number keep the order of the table's files and rows, so the first of them is the same however the rows are dealt.
    own = items(spark, sf_dir).select("*", col("_metadata.file_path").alias("of"), col("_metadata.row_index").alias("row")).withColumn("file", F.floor(col("l_orderkey") / 4000))
    line = lambda names: F.concat(F.lit('"'), F.concat_ws('","', *[cells[x] for x in names]), F.lit('"'))
    forth, back = list(cells), list(reversed(cells))
    even = col("file") % 2 == 0
    lines = own.select("file", col("l_orderkey").alias("a"), (col("l_linenumber") + 6).alias("b"), "of", "row", F.when(even, line(forth)).otherwise(line(back)).alias("text"))
    tops = F.array(*[F.lit(f'"FormatVersion","v{k}"') for k in range(5)], F.when(even, ",".join(forth)).otherwise(",".join(back)))
    tops = own.select("file").distinct().select("file", F.lit(-1).cast("long").alias("a"), F.posexplode(tops).alias("b", "text"))
    path = f"{checkpoint_dir(spark)}/bulk-{uuid.uuid4().hex}"
    lines.unionByName(tops, allowMissingColumns=True).repartition("file").sortWithinPartitions("file", "a", "b", "of", "row").select("file", "text").write.partitionBy("file").text(path)
    offers = adapters.collect(adapters.bulk_files(spark, path, split_bytes=1 << 20), "bulk_prices")
    money = [F.round(c.number(col(x)), k).alias(x) for x, k in (("price_per_hour", 2), ("upfront_price", 2), ("price_per_gpu_hour", 6))]
    tail = lambda key: c.json_get(col("raw_extra"), key)
    return offers.select(tail("location").cast("long").alias("l_orderkey"), "instance_type", "instance_family", "gpu_name", "gpu_memory_gb", "gpu_count", "ram_gb", "pricing_type", "commitment_period", *money, tail("billing_model").alias("billing_model"))


@query("""SELECT 'shop' AS source, 'gcp' AS provider, 'i' || l_linenumber AS instance_type, 'H100' AS gpu_name, '80' AS gpu_memory_gb, '2' AS gpu_count, 'spot' AS pricing_type, 'US East' AS geo_group, l_quantity::BIGINT::VARCHAR AS price_per_hour,
  regexp_replace(regexp_replace(printf('%.6f', l_quantity / 2), '0+$', ''), '\\.$', '') AS price_per_gpu_hour FROM lineitem WHERE l_partkey % 3 <> 0""")
def collect_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API answers, one for each order, through their adapter to offer rows; items without a GPU are not worth storing."""
    item = F.struct(F.lit("Google Cloud").alias("provider"), F.concat(F.lit("i"), col("l_linenumber").cast("string")).alias("name"), F.when(col("l_partkey") % 3 == 0, "cpu").otherwise("h100-sxm5-80gb").alias("gpu"), F.lit("2").alias("count"), F.lit("us_east-1").alias("region"), F.lit("Preemptible").alias("type"), col("l_quantity").cast("long").cast("string").alias("price"))
    payloads = items(spark, sf_dir).groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("body"))
    offers = adapters.collect(payloads.select(F.lit("shop").alias("source"), F.lit("f").alias("file"), "body"), "json_items")
    return offers.select("source", "provider", "instance_type", "gpu_name", "gpu_memory_gb", "gpu_count", "pricing_type", "geo_group", "price_per_hour", "price_per_gpu_hour")


_LINES = """t AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g'), '(?i)<br\\s*/?>|</?(p|div|li|ul|ol|tr|table|h[1-6]|section|article|nav|header|footer|title)\\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS x FROM pages),
u AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&euro;', '€'), '&amp;', '&') AS x FROM t),
v AS (SELECT page_id, list_filter(list_transform(string_split(x, chr(10)), lambda y: trim(regexp_replace(y, '\\s+', ' ', 'g'))), lambda y: y <> '') AS ls FROM u),
lines AS (SELECT page_id, unnest(range(len(ls)))::INT AS line, unnest(ls) AS text FROM v)"""


@query(f"WITH {_LINES} SELECT page_id, line, text FROM lines")
def html_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.html_lines(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_lines(spark, sf_dir)


@query(f"WITH {_LINES} SELECT page_id, line, last_value(CASE WHEN length(text) < 25 THEN text END IGNORE NULLS) OVER w AS section FROM lines WINDOW w AS (PARTITION BY page_id ORDER BY line ROWS UNBOUNDED PRECEDING) QUALIFY coalesce(max(CASE WHEN text LIKE '%zz%' THEN 1 ELSE 0 END) OVER w, 0) = 0")
def section_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return text.section_carry(lines, ["page_id"], F.when(F.length("text") < 25, col("text")), col("text").contains("zz")).select("page_id", "line", "section")


@query(f"WITH {_LINES} SELECT page_id, line, coalesce(first_value(CASE WHEN length(text) > 200 THEN length(text) END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY line ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), -1)::INT AS next_value FROM lines")
def lookahead_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.lookahead(_lines(spark, sf_dir), ["page_id"], F.when(F.length("text") > 200, F.length("text")), 5).select("page_id", "line", F.coalesce("next_value", F.lit(-1)).alias("next_value"))


@query(f"WITH {_LINES} SELECT page_id, line, coalesce(lead(length(text)) OVER (PARTITION BY page_id ORDER BY line), -1)::INT AS next_value FROM lines")
def adjacent_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.adjacent(_lines(spark, sf_dir), ["page_id"], F.length("text")).select("page_id", "line", F.coalesce("next_value", F.lit(-1)).alias("next_value"))
