"""Payloads to rows: one operator for each dataflow shape; field paths and rules are parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priceframe.functions import conform as c
from priceframe.functions import tables as t

col = F.col


def flatten_items(payloads: DataFrame, schema: str, body: str = "body", path: str | None = None) -> DataFrame:
    """A row for each element of the array at path (or of the body itself), with the other columns."""
    parsed = payloads.withColumn("_body", F.from_json(col(body), schema))
    items = col("_body") if path is None else col(f"_body.{path}")
    return parsed.withColumn("_item", F.explode(items)).select(*[x for x in payloads.columns if x != body], "_item.*")


def flatten_regions(items: DataFrame, regions: str = "regions", default: str = "global", into: str = "region") -> DataFrame:
    """A row for each region; one with the default where there is none, marked unavailable."""
    out = items.withColumn(into, F.explode_outer(F.when(F.size(regions) > 0, col(regions))))
    return out.withColumn("available", col(into).isNotNull()).withColumn(into, F.coalesce(into, F.lit(default))).drop(regions)


def regional_overrides(plans: DataFrame, price: str, overrides: str, into: str = "region") -> DataFrame:
    """The base row under region global, and rows of regions whose price differs. overrides: array<struct<region, price>>."""
    base = plans.withColumn(into, F.lit("global")).drop(overrides)
    other = plans.withColumn("_o", F.explode(overrides)).where(~col("_o.price").eqNullSafe(col(price)))
    other = other.withColumn(into, col("_o.region")).withColumn(price, col("_o.price")).drop("_o", overrides)
    return base.unionByName(other)


def unpivot_prices(rows: DataFrame, keys: list[str], prices: dict[str, tuple[str, str]]) -> DataFrame:
    """A row for each positive price column; prices: column -> (pricing type, commitment)."""
    parts = [F.struct(F.lit(kind).alias("pricing_type"), F.lit(term).alias("commitment_period"), col(x).cast("double").alias("price")) for x, (kind, term) in prices.items()]
    return rows.select(*keys, F.inline(F.array(*parts))).where("price > 0")


def first_positive(values: Column) -> Column:
    return F.get(F.filter(values, lambda x: x > 0), 0)


def first_price_in(localizations: Column, currency: str) -> Column:
    """The first positive price of the first localization in a currency, with its model.
    localizations: array<struct<currencyCode, prices: array<struct<model, value>>>>."""
    own = F.get(F.filter(localizations, lambda x: x["currencyCode"] == currency), 0)
    return F.get(F.filter(own["prices"], lambda p: p["value"] > 0), 0)


def flatten_two_level(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    """A row for each inner element of each outer element (struct with an array field inner)."""
    keys = [x for x in rows.columns if x != outer]
    out = rows.select(*keys, F.inline(outer))
    rest = [x for x in out.columns if x not in keys and x != inner]
    return out.select(*keys, *rest, F.inline(inner))


def flatten_shapes(rows: DataFrame, shapes: list[tuple[str, str]]) -> DataFrame:
    """Inner elements of several payload shapes (outer, inner) in one table; a row has the shapes whose outer array it fills."""
    outers = [outer for outer, _ in shapes]
    parts = [flatten_two_level(rows.drop(*[o for o in outers if o != outer]), outer, inner) for outer, inner in shapes]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def metric_fallback(metrics: list[Column]) -> Column:
    """The first metric above zero."""
    return F.coalesce(*[F.when(m > 0, m) for m in metrics])


def metric_summary(metrics: dict[str, Column]) -> Column:
    """price and name of the first metric above zero (0 and blank if none is), and all that are present, as JSON, in their order."""
    parts = [F.when(m.isNotNull(), F.struct(F.lit(k).alias("key"), F.round(m, 6).alias("value"))) for k, m in metrics.items()]
    given = F.filter(F.array(*parts), lambda x: x.isNotNull())
    best = F.get(F.filter(given, lambda x: x["value"] > 0), 0)
    return F.struct(F.coalesce(best["value"], F.lit(0.0)).alias("price"), F.coalesce(best["key"], F.lit("")).alias("metric"), F.to_json(F.map_from_entries(given)).alias("summary"))


def alias_fallback(names: list[Column]) -> Column:
    """The first of several names of a field that is filled."""
    return F.coalesce(*[c.blank_to_null(c.strip(n)) for n in names], F.lit(""))


def unit_to_hourly(amount: Column, unit: Column) -> Column:
    """USD per hour to six decimals from the month, cents, cents a second or a plain hour."""
    out = F.when(unit == "month", amount / 730).when(unit == "cents", amount / 100).when(unit == "cents_second", amount * 3600 / 100).otherwise(amount)
    return F.round(out, 6)


def last_tier_price(tiers: Column) -> Column:
    """units + nanos / 1e9 of the last tier."""
    last = F.try_element_at(tiers, F.lit(-1))
    return last["units"] + last["nanos"] / F.lit(1e9)


def classify(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The class of the first rule whose pattern occurs."""
    out: Column = F.lit(otherwise)
    for pattern, name in reversed(rules):
        out = F.when(text.rlike(f"(?i){pattern}"), name).otherwise(out)
    return out


def rule_table(spark: SparkSession, rules: list[tuple], values: str) -> DataFrame:
    """Ordered rules as a table: rule (its place), need and lack (field:text), and the columns that values names, from tuples
    (need, lack, *values)."""
    return spark.createDataFrame([(k, list(need), list(lack), *rest) for k, (need, lack, *rest) in enumerate(rules)], f"rule int, need array<string>, lack array<string>, {values}")


def classify_by_rules(rows: DataFrame, fields: list[Column], rules: DataFrame) -> DataFrame:
    """rows with the rule and the values of the first rule that holds; null where none does. A rule (see rule_table) holds if
    every text it needs occurs in its field, by number from 0, and none that it lacks; case does not matter in the fields. Rules
    need at least one text of two characters.

    Each distinct combination of fields is looked at once. A rule is indexed by the rarest pair of characters of what it needs,
    and combinations meet rules by the pairs they hold, so the work grows with likely matches, not with texts times rules."""
    made = [f"_f{k}" for k in range(len(fields))]
    own = rows.withColumns({m: F.lower(F.coalesce(f, F.lit(""))) for m, f in zip(made, fields, strict=True)})
    texts = own.select(F.array(*made).alias("_t")).distinct()
    pairs = lambda text, mark: F.when(F.length(text) > 1, F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: F.concat(mark, F.lit(":"), F.substring(text, i, F.lit(2)))))
    grams = texts.select("_t", F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*[pairs(col("_t")[k], F.lit(str(k))) for k in range(len(fields))]))))).alias("_g"))
    often = grams.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    needed = rules.select("rule", F.explode("need").alias("_x")).select("rule", F.explode(pairs(F.expr("substr(_x, instr(_x, ':') + 1)"), F.expr("substr(_x, 1, instr(_x, ':') - 1)"))).alias("_g"))
    # a pair that no text has rules the rule out
    index = needed.join(often, "_g", "left").groupBy("rule").agg(F.min_by("_g", F.struct(F.coalesce("_n", F.lit(0)), "_g")).alias("_g"))
    inside = lambda x: "instr(_t[cast(substr({0}, 1, instr({0}, ':') - 1) as int)], substr({0}, instr({0}, ':') + 1)) > 0".format(x)
    likely = grams.join(index, "_g").select("_t", "rule").join(rules, "rule").where(f"forall(need, x -> {inside('x')}) and not exists(lack, x -> {inside('x')})")
    values = [x for x in rules.columns if x not in ("need", "lack")]
    first = likely.groupBy("_t").agg(F.min(F.struct(*values)).alias("_v"))
    return own.withColumn("_t", F.array(*made)).join(first, "_t", "left").select(*rows.columns, *[col(f"_v.{v}").alias(v) for v in values])


def classify_offer(text: Column, types: list[tuple[str, str]], terms: list[tuple[str, str]], models: list[tuple[str, str]], count: str = r"(?i)\b(\d+)\s*x\b") -> Column:
    """Pricing type, term, GPU model and count of an offer's free text, each by its own ordered rules; one GPU if no count is told."""
    n = F.regexp_extract(text, count, 1).try_cast("int")
    return F.struct(classify(text, types, "on_demand").alias("pricing_type"), classify(text, terms, "").alias("commitment_period"), classify(text, models, "").alias("gpu_name"), F.coalesce(n, F.lit(1)).alias("gpu_count"))


def token_offers(models: DataFrame, prompt: str = "prompt", completion: str = "completion") -> DataFrame:
    """Per-token offers: no hourly price, unit token, prices in the JSON tail; free models are skipped."""
    paid = models.where((col(prompt) > 0) | (col(completion) > 0))
    tail = F.to_json(F.struct(col(prompt).alias("prompt"), col(completion).alias("completion")))
    return paid.withColumns({"pricing_type": F.lit("inference"), "price_per_hour": F.lit(0.0), "price_unit": F.lit("token"), "raw_extra": tail}).drop(prompt, completion)


def currency(text: Column) -> Column:
    return F.when(text.contains("€"), "EUR").when(text.contains("$"), "USD").otherwise("")


def price_unit(label: Column) -> Column:
    own = F.lower(label)
    return F.when(own.contains("per month"), "month").when(own.contains("per hour"), "hour").otherwise("")


def availability(count: Column, stock: Column, rented: Column) -> Column:
    return F.coalesce(count > 0, F.when(stock != "", F.lower(stock).isin("available", "in stock", "high", "medium", "low")), ~rented, F.lit(False))


def location_parts(place: Column) -> dict[str, Column]:
    """City and country of a comma-separated place."""
    parts = F.transform(F.split(place, ","), c.strip)
    return {"country": F.try_element_at(parts, F.lit(-1)), "city": F.when(F.size(parts) > 1, F.get(parts, 0)).otherwise("")}


def location_text(parts: list[Column]) -> Column:
    """City, state and country, those that are filled, in one text."""
    return F.concat_ws(", ", *[c.blank_to_null(c.strip(p)) for p in parts])


def collapse_repeats(text: Column) -> Column:
    """A label in which a phrase follows itself, with the phrase once."""
    return F.regexp_replace(text, r"\b(\w.*?)(?:\s+\1\b)+", "$1")


def size_gb(text: Column) -> Column:
    """GB from a size with a unit, or from a bare number of MB when it is large; one decimal."""
    n = F.regexp_extract(text, r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    out = F.when(text.rlike(r"(?i)\d\s*T(i?B)?\b"), n * 1024).when(text.rlike(r"(?i)\d\s*M(i?B)?\b") | (~text.rlike("(?i)[a-z]") & (n > 2048)), n / 1024).otherwise(n)
    return F.round(out, 1)


def first_gpu_cell(cells: Column, preferred: Column) -> Column:
    """The first cell, the preferred one first, whose canonical GPU name is neither blank nor a number; that name."""
    named = F.transform(F.concat(F.array(F.get(cells, preferred)), cells), c.norm_gpu_name)
    return F.coalesce(F.get(F.filter(named, lambda x: (x != "") & ~x.rlike(r"^\d+(\.\d+)?$")), 0), F.lit(""))


def lookup_with_rules(key: Column, text: Column, known: dict[str, str], rules: list[tuple[str, str]]) -> Column:
    """An exact match, else the first rule whose words occur."""
    by_rule = reduce(lambda rest, rule: F.when(F.lower(text).contains(rule[0]), rule[1]).otherwise(rest), reversed(rules), F.lit(""))
    return F.coalesce(c.lookup(known, key), by_rule)


def longest_prefix(rows: DataFrame, key: str, prefixes: DataFrame, prefix: str, value: str, into: str) -> DataFrame:
    """The value of the longest prefix of each key, null where none fits. Every distinct key meets the prefixes by equality,
    with each of its own beginnings."""
    keys = rows.select(key).where(F.length(key) > 0).distinct()
    beginnings = keys.withColumn("_n", F.explode(F.sequence(F.lit(1), F.length(key)))).withColumn("_p", F.substring(col(key), F.lit(1), col("_n")))
    best = beginnings.join(prefixes.select(col(prefix).alias("_p"), col(value).alias("_v")), "_p").groupBy(key).agg(F.max_by("_v", "_n").alias(into))
    return rows.join(best, key, "left")


#: Columns of a bulk price file that an offer is made from, by the name they get here.
BULK_COLUMNS = {
    "price": "PricePerUnit", "unit": "Unit", "product_family": "Product Family", "description": "PriceDescription", "effective_date": "EffectiveDate",
    "vcpus": "vCPU", "memory": "Memory", "storage": "Storage", "network": "Network Performance", "gpu": "GPU",
}


def bulk_records(lines: DataFrame, preamble: int = 5) -> DataFrame:
    """Records of bulk price files given as lines (file, line from 0, text): file, at and the columns of t.BULK_KEY and
    BULK_COLUMNS, each line parsed once under its file's header."""
    from priceframe.sources.bulk import parse_line

    parsed = lines.where(col("line") >= preamble).select("file", "line", parse_line(col("text")).alias("_cells"))
    heads = parsed.where(col("line") == preamble).select("file", F.transform("_cells", c.strip).alias("_head"))
    place = lambda name: F.array_position("_head", name).cast("int")
    field = lambda name: F.when(place(name) > 0, F.coalesce(F.get("_cells", place(name) - 1), F.lit("")))
    return parsed.where(col("line") > preamble).join(heads, "file").select("file", col("line").alias("at"), *[field(x).alias(x) for x in [*t.BULK_KEY, *BULK_COLUMNS.values()]])


def bulk_components(records: DataFrame, families: list[str] | None = None) -> DataFrame:
    """Offers summed up from the records of bulk price files (file, at and the files' columns): a record counts if it is a
    compute instance of a family, priced by the hour or upfront and not negative; records are summed over the full key and the
    class of their description, descriptive columns come from the first."""
    from priceframe.operators.stats import rollup_components

    blank = lambda name: F.coalesce(col(f"`{name}`"), F.lit(""))
    out = records.select(F.struct("file", "at").alias("row_seq"), *[blank(k).alias(k) for k in t.BULK_KEY], *[blank(v).alias(k) for k, v in BULK_COLUMNS.items()])
    family: Column = F.lit("")
    for f in sorted(families or t.BULK_FAMILIES, key=len):
        family = F.when(col("Instance Type").startswith(f), f).otherwise(family)
    text, status, billing = F.lower("description"), F.lower("CapacityStatus"), F.lit("other")
    for words, state, name in reversed(t.BULK_CLASSES):
        billing = F.when(text.contains(words) | (status == (state or "\0")), name).otherwise(billing)
    good = out.withColumns({"family": family, "billing_model": billing}).where("family != '' and product_family like '%Compute Instance%' and unit in ('Hrs', 'Quantity')")
    return rollup_components(good, [*t.BULK_KEY, "billing_model"], describe=["row_seq", "family", "effective_date", "vcpus", "memory", "storage", "network", "gpu"])


def bulk_fields(components: DataFrame, provider: str, families: dict[str, tuple[str, float, str]] | None = None, counts: dict[str, int] | None = None) -> DataFrame:
    """Offer fields of bulk_components: the device by family, their number from the file or else by instance type, reserved
    terms and capacity classes as commitments, prices in all and for each device, the rest in the JSON tail."""
    families, counts = families or t.BULK_FAMILIES, counts or t.BULK_COUNTS
    device = lambda k: c.lookup({f: str(v[k]) for f, v in families.items()}, col("family"))
    count = F.coalesce(c.strip(col("gpu")).try_cast("int"), c.lookup({k: str(v) for k, v in counts.items()}, col("Instance Type")).cast("int"), F.lit(0))
    capacity = col("billing_model").isin("capacity_block", "capacity_reservation")
    reserved = (col("TermType") == "Reserved") | capacity
    lease, option = c.blank_to_null(col("LeaseContractLength")), c.blank_to_null(col("PurchaseOption"))
    term = F.when(col("billing_model") == "capacity_block", "capacity_block").otherwise("capacity_reservation")
    each = lambda total: F.round(F.when(col("_n") > 0, col(total) / col("_n")).otherwise(col(total)), 6)
    region = F.coalesce(c.blank_to_null(col("Region Code")), F.regexp_extract("row_seq.file", r"([^/]*?)(\.csv)?(\.gz)?$", 1))
    tail = F.struct(
        col("CapacityStatus").alias("capacity_status"), "billing_model", "effective_date", col("Location").alias("location"),
        F.coalesce(option, F.when(capacity, col("billing_model")), F.lit("")).alias("purchase_option"), col("OfferingClass").alias("offering_class"),
    )
    return components.withColumn("_n", count).select(
        F.lit(provider).alias("source"), F.lit(provider).alias("provider"), col("Instance Type").alias("instance_type"), col("family").alias("instance_family"),
        F.coalesce(device(0), F.lit("Unknown")).alias("gpu_name"), F.coalesce(device(2), F.lit("")).alias("gpu_variant"), F.coalesce(device(1), F.lit("")).alias("gpu_memory_gb"), col("_n").cast("string").alias("gpu_count"),
        "vcpus", c.number_text(c.number(F.replace(F.replace("memory", F.lit(" GiB"), F.lit("")), F.lit(","), F.lit("")))).alias("ram_gb"), col("storage").alias("storage_desc"), col("network").alias("network_desc"),
        region.alias("region"), F.when(reserved, "reserved").otherwise("on_demand").alias("pricing_type"), F.coalesce(lease, F.when(reserved, term), F.lit("")).alias("commitment_period"),
        *[c.number_text(col(x)).alias(x) for x in ("price_per_hour", "upfront_price")], c.number_text(each("price_per_hour")).alias("price_per_gpu_hour"), c.number_text(each("upfront_price")).alias("upfront_price_per_gpu"),
        col("Operating System").alias("os"), col("Tenancy").alias("tenancy"), col("Pre Installed S/W").alias("pre_installed_sw"), F.lit("true").alias("available"), F.to_json(tail).alias("raw_extra"),
    )


def spec_lookup(rows: DataFrame, key: str, specs: DataFrame) -> DataFrame:
    """rows with the columns of specs (one row a key), null where it has none; Spark broadcasts a small enough side itself."""
    return rows.join(specs, key, "left")
