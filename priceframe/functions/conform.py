"""Conforming projections: dirty vendor fields to canonical ones.

Every function takes and returns text columns; null counts as blank, and blank comes back as the empty string.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tables as t

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Text without white space at either end."""
    return F.btrim(text(c), F.lit(" \t\n\x0b\f\r"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def lookup(known: dict, key: Column) -> Column:
    """The value of a small fixed table, null where it has no such key. The table is one parsed literal, which the optimizer
    folds, rather than a column object for each entry."""
    return F.element_at(F.expr(f"map({', '.join(map(_literal, chain(*known.items())))})"), key)


def _literal(x) -> str:
    return f"{x!r}D" if isinstance(x, float) else str(x) if isinstance(x, int) else "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parse_float(c: Column) -> Column:
    """A number, 0.0 where the text is none."""
    own = strip(c)
    return F.when(own.rlike(_NUMBER), own.try_cast("double")).otherwise(F.lit(0.0))


def number(c: Column) -> Column:
    """A number, null where the text is none."""
    own = strip(c)
    return F.when(own.rlike(_NUMBER), own.try_cast("double"))


def format_float(c: Column) -> Column:
    """Six decimals without trailing zeros."""
    shown = F.regexp_replace(F.regexp_replace(F.format_string("%.6f", F.round(c, 6)), "0+$", ""), r"\.$", "")
    return F.when(shown.isin("", "-0"), "0").otherwise(shown)


def number_text(c: Column) -> Column:
    """A number as text, whole ones without a decimal point."""
    whole = F.when(F.abs(c) < 1e15, F.floor(c).cast("string")).otherwise(c.cast("decimal(38,0)").cast("string"))
    return F.when(c == F.floor(c), whole).otherwise(c.cast("string"))


def provider_key(c: Column) -> Column:
    key = F.translate(F.lower(strip(c)), "- ", "__")
    return F.when(key.contains("_"), F.regexp_replace(F.regexp_replace(key, t.SPONSOR, ""), t.SPONSORED, "")).otherwise(key)


def provider_of(key: Column) -> Column:
    return F.coalesce(lookup(t.PROVIDERS, key), key)


def norm_provider(c: Column) -> Column:
    return provider_of(provider_key(c))


def gpu_spaced(key: Column) -> Column:
    """A lower-case name with single spaces for its separators."""
    return strip(F.regexp_replace(F.translate(key, "-_", "  "), r"\s+", " "))


def gpu_by_pattern(c: Column) -> Column:
    """The first pattern that occurs in the raw text."""
    out: Column = F.lit(None).cast("string")
    for pattern, shown in reversed(t.GPU_PATTERNS):
        pattern = f"(?i){pattern}"
        before, _, after = shown.partition("$1")
        value = F.concat(F.lit(before), F.regexp_extract(text(c), pattern, 1), F.lit(after)) if "$1" in shown else F.lit(shown)
        out = F.when(text(c).rlike(pattern), value).otherwise(out)
    return out


def gpu_alias(key: Column, spaced: Column) -> Column:
    """The name under the first of four spellings that is an alias; blank where one names no GPU, null where none is known."""
    none = dict.fromkeys(t.NO_GPU, "")
    compact, stripped = F.regexp_replace(key, r"[^a-z0-9]+", ""), strip(F.regexp_replace(spaced, t.FORM_FACTOR, ""))
    return F.coalesce(lookup({**t.GPU_NAMES, **none, "": ""}, key), lookup({**t.GPU_NAMES, **none}, spaced), lookup(t.GPU_NAMES, compact), lookup(t.GPU_NAMES, stripped))


def norm_gpu_name(c: Column) -> Column:
    """Blank for what names no GPU; else an alias under one of four spellings, a pattern, or the stripped text.

    On tables use the steps of operators/conform.py, which evaluate every spelling once.
    """
    key = F.lower(strip(c))
    return F.coalesce(gpu_alias(key, gpu_spaced(key)), gpu_by_pattern(c), strip(c))


def variant_of(own: Column) -> Column:
    key = F.lower(own)
    return F.coalesce(lookup(t.VARIANTS, F.translate(key, "-_ ", "")), lookup(t.VARIANTS, key), own)


def norm_variant(c: Column) -> Column:
    return variant_of(strip(c))


def pricing_key(c: Column) -> Column:
    return F.translate(F.lower(strip(c)), "- ", "__")


def pricing_of(raw: Column, key: Column) -> Column:
    return F.when(text(raw) == "", "on_demand").otherwise(F.coalesce(lookup(t.PRICING_TYPES, key), text(raw)))


def norm_pricing_type(c: Column) -> Column:
    return pricing_of(c, pricing_key(c))


_SPEC = "struct<Gpus:array<struct<Count:string,MemoryInfo:struct<SizeInMiB:string,SizeInGiB:string>>>,TotalGpuMemoryInMiB:string>"


def memory_spec(own: Column) -> Column:
    """A specification written as JSON or as a Python literal, null for other text."""
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(own, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    return F.from_json(F.when(own.rlike(r"^[{\[]"), plain), _SPEC, {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})


def spec_numbers(spec: Column, count: Column) -> dict[str, Column]:
    """The numbers of a specification by which GB per GPU are found; all null where there is none."""
    first = F.get(spec["Gpus"], 0)
    raw = {"mib": first["MemoryInfo"]["SizeInMiB"], "gib": first["MemoryInfo"]["SizeInGiB"], "total": spec["TotalGpuMemoryInMiB"], "cards": first["Count"], "count": count}
    return {k: F.when(spec.isNotNull(), number(v)) for k, v in raw.items()}


def spec_memory(mib: Column, gib: Column, total: Column, cards: Column, count: Column) -> Column:
    """GB per GPU from the numbers of a specification."""
    given = F.when(count != 0, count).when(cards != 0, cards).otherwise(1.0)
    return F.when(mib > 0, F.round(mib / 1024, 6)).when(gib > 0, F.round(gib, 6)).when(total > 0, F.round(total / F.when(given > 0, given).otherwise(1.0) / 1024, 6))


def model_memory(own: Column, gpu: Column, name: Column, variant: Column) -> Column:
    """GB that the canonical model implies; own is the stripped memory text, name the GPU text as given."""
    compact = F.replace(F.lower(F.when(own != "", own).otherwise(text(name))), F.lit(" "), F.lit(""))
    return (
        F.when((gpu == "H100") & (norm_variant(variant) == "NVL"), 94.0)
        .when((gpu == "A100") & compact.contains("80"), 80.0)
        .when((gpu == "A100") & compact.contains("40"), 40.0)
        .otherwise(lookup({k: float(v) for k, v in t.GPU_MEMORY.items()}, gpu))
    )


def sized_memory(own: Column) -> Column:
    """The number of a size with a unit, null where the text has none."""
    return blank_to_null(F.regexp_extract(own, t.SIZE_WITH_UNIT, 1)).try_cast("double")  # a failing cast costs an exception


def norm_gpu_memory(raw: Column, gpu_name: Column, count: Column, variant: Column) -> Column:
    """GB per GPU as text: a number as it is, a specification, a size with a unit, or what the model implies."""
    own = strip(raw)
    given = spec_memory(**spec_numbers(memory_spec(own), count))
    return text(number_text(F.coalesce(number(raw), given, sized_memory(own), model_memory(own, norm_gpu_name(gpu_name), gpu_name, variant))))


def first_location(raw_extra: Column) -> Column:
    """The first filled element of the tail's locations."""
    place = F.from_json(json_get(raw_extra, "locations"), "array<string>")
    return F.get(F.filter(F.transform(place, strip), lambda x: x != ""), 0)


def region_of(own: Column, land: Column, provider: Column, source: Column, raw_extra: Column) -> Column:
    """The region, else the country, else what the provider implies; all of them stripped or canonical already."""
    wide = provider.isin(t.GLOBAL_PROVIDERS) | source.isin(t.GLOBAL_PROVIDERS)
    return F.when(own != "", own).when(land != "", land).when(provider == "vultr", F.coalesce(first_location(raw_extra), F.lit("global"))).when(wide, "global").otherwise("")


def norm_region(region: Column, provider: Column, country: Column, raw_extra: Column, source: Column) -> Column:
    return region_of(strip(region), F.upper(strip(country)), norm_provider(provider), norm_provider(source), raw_extra)


def geo_key(region: Column) -> Column:
    return F.replace(F.translate(F.lower(strip(region)), "_", "-"), F.lit(" "), F.lit(""))


def group_by_place(own: Column, land: Column) -> Column:
    """The display bucket of a region or country (upper case) that is a known country, null for others."""
    return F.coalesce(lookup(t.COUNTRY_GROUPS, F.upper(own)), lookup(t.COUNTRY_GROUPS, land))


def group_by_prefix(key: Column) -> Column:
    """The display bucket by the first prefix that a region's key has."""
    chain_: Column = F.lit("Unknown")
    for group, prefixes in reversed(t.REGION_GROUPS):
        chain_ = F.when(key.rlike(f"^(?:{'|'.join(prefixes)})"), group).otherwise(chain_)
    return F.when(key == "", "Unknown").otherwise(chain_)


def geo_group(region: Column, country: Column) -> Column:
    return F.coalesce(group_by_place(strip(region), F.upper(strip(country))), group_by_prefix(geo_key(region)))


def per_gpu_price(amount: Column, count: Column) -> Column:
    """amount / count to six decimals as text; the amount itself where the count is not positive, blank where it is blank."""
    own, n = number(amount), parse_float(count)
    return F.when((text(amount) == "") | (n <= 0) | own.isNull(), text(amount)).otherwise(format_float(own / n))


def json_get(raw: Column, key: str) -> Column:
    """A top-level value as text, blank where the text is no object or has no such key. Texts without the key's name, plain or with
    escapes, are not parsed."""
    own = text(raw)
    return strip(F.when(own.contains(key) | own.contains("\\"), F.get_json_object(own, f"$.{key}")))


def json_map(raw: Column) -> Column:
    """The object's members, each value a variant that keeps its type; of equal keys the last. Empty where the text is no object."""
    whole = F.from_json(text(raw), "map<string,variant>")
    entries = F.reverse(F.map_entries(whole))
    last = F.reverse(F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x["key"]), e["key"]) == i + 1))
    keys = F.map_keys(whole)
    once = F.when(F.size(keys) == F.size(F.array_distinct(keys)), whole).otherwise(F.map_from_entries(last))
    return F.coalesce(once, F.expr("cast(map() as map<string,variant>)"))


def json_put(raw: Column, changes: dict[str, Column], drop: list[str] | None = None) -> Column:
    """The object with keys set to texts (where the text is not null) and dropped, other values as they are; the old text if
    nothing is left. Set keys stay in their place, new ones come last."""

    def changed(k: Column, v: Column) -> Column:
        return reduce(lambda rest, c: F.when((k == c[0]) & c[1].isNotNull(), c[1].cast("variant")).otherwise(rest), changes.items(), v)

    old = json_map(raw) if not drop else F.map_filter(json_map(raw), lambda k, v: ~k.isin(drop))
    if not changes:
        return F.when(F.size(old) > 0, F.to_json(old)).otherwise(text(raw))
    new = F.array(*[F.struct(F.lit(k).alias("key"), x.cast("variant").alias("value")) for k, x in changes.items()])
    whole = F.map_concat(F.transform_values(old, changed), F.map_from_entries(F.filter(new, lambda e: e["value"].isNotNull() & ~F.array_contains(F.map_keys(old), e["key"]))))
    return F.when(F.size(whole) > 0, F.to_json(whole)).otherwise(text(raw))


def is_empty(c: Column) -> Column:
    return F.lower(strip(c)).isin(t.EMPTY_WORDS)
