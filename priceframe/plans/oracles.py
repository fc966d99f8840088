"""The registered queries in plain SQL for another engine, written apart from the operators; only the fixed tables are shared."""

from __future__ import annotations

from priceframe.functions import tables as t
from priceframe.plans.bridge import offers_sql
from priceframe.schema import BACKFILL, COLUMNS

CUTOFF = "1995-06-01"


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def case(known: dict, key: str, otherwise: str = "NULL") -> str:
    show = lambda v: quoted(v) if isinstance(v, str) else str(v)
    return f"CASE {key} " + " ".join(f"WHEN {quoted(k)} THEN {show(v)}" for k, v in known.items()) + f" ELSE {otherwise} END"


def inside(values: list[str]) -> str:
    return "(" + ", ".join(map(quoted, values)) + ")"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^\\s+|\\s+$', '', 'g')"


def num(x: str) -> str:
    return f"CASE WHEN regexp_matches({strip(x)}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN CAST({strip(x)} AS DOUBLE) END"


def pf(x: str) -> str:
    return f"coalesce({num(x)}, 0.0)"


def fmt(v: str) -> str:
    return f"regexp_replace(regexp_replace(printf('%.6f', round(CAST({v} AS DOUBLE), 6)), '0+$', ''), '\\.$', '')"


def js(x: str, key: str) -> str:
    return strip(f"json_extract_string({object_(x)}, {quoted('$.' + key)})")


def object_(x: str) -> str:
    return f"CASE WHEN json_valid({x}) THEN {x} ELSE '{{}}' END"


def patched(x: str, **new: str) -> str:
    """The object with absent keys set to SQL texts, and keys dropped whose text is NULL."""
    out = object_(x)
    for k, v in new.items():
        patch = f"json_object({quoted(k)}, {v})" if v == "NULL" else f"CASE WHEN {js(x, k)} = '' THEN json_object({quoted(k)}, {v}) ELSE json('{{}}') END"
        out = f"json_merge_patch({out}, {patch})"
    return f"CAST({out} AS VARCHAR)"


def provider(x: str) -> str:
    key = f"regexp_replace(regexp_replace(translate(lower({strip(x)}), '- ', '__'), '_(our_)?sponsor(ed)?$', ''), '_sponsored$', '')"
    return case(t.PROVIDERS, key, key)


def gpu(x: str) -> str:
    key = f"lower({strip(x)})"
    spaced = strip(f"regexp_replace(translate({key}, '-_', '  '), '\\s+', ' ', 'g')")
    compact = f"regexp_replace({key}, '[^a-z0-9]+', '', 'g')"
    stripped = strip(f"regexp_replace({spaced}, '\\s*(pcie|sxm[0-9]?|nvlink|hgx)\\s*[0-9]*\\s*g?b?$', '')")
    re2 = {"(?!\\d)": "([^0-9]|$)", "(?!s)": "([^s]|$)", "(?!\\d|g)": "([^0-9g]|$)"}
    rules = ""
    for pattern, shown in t.GPU_PATTERNS:
        for a, b in re2.items():
            pattern = pattern.replace(a, b)
        before, mark, after = shown.partition("$1")
        value = f"{quoted(before)} || regexp_extract({x}, {quoted(pattern)}, 1, 'i') || {quoted(after)}" if mark else quoted(shown)
        rules += f" WHEN regexp_matches({x}, {quoted(pattern)}, 'i') THEN {value}"
    return f"""CASE WHEN {key} = '' OR {key} IN {inside(t.NO_GPU)} THEN '' WHEN {key} IN {inside(list(t.GPU_NAMES))} THEN {case(t.GPU_NAMES, key)}
      WHEN {spaced} IN {inside(t.NO_GPU)} THEN '' WHEN {spaced} IN {inside(list(t.GPU_NAMES))} THEN {case(t.GPU_NAMES, spaced)}
      WHEN {compact} IN {inside(list(t.GPU_NAMES))} THEN {case(t.GPU_NAMES, compact)} WHEN {stripped} IN {inside(list(t.GPU_NAMES))} THEN {case(t.GPU_NAMES, stripped)} {rules} ELSE {strip(x)} END"""


def variant(x: str) -> str:
    return f"coalesce({case(t.VARIANTS, f'translate(lower({strip(x)}), {quoted("-_ ")}, {quoted("")})')}, {case(t.VARIANTS, f'lower({strip(x)})')}, {strip(x)})"


def pricing(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN 'on_demand' ELSE {case(t.PRICING_TYPES, f'translate(lower({strip(x)}), {quoted("- ")}, {quoted("__")})', x)} END"


def geo(region: str, country: str) -> str:
    key = f"replace(translate(lower({strip(region)}), '_', '-'), ' ', '')"
    chain = " ".join(f"WHEN regexp_matches({key}, '^({'|'.join(p)})') THEN {quoted(g)}" for g, p in t.REGION_GROUPS)
    return f"coalesce({case(t.COUNTRY_GROUPS, f'upper({strip(region)})')}, {case(t.COUNTRY_GROUPS, f'upper({strip(country)})')}, CASE WHEN {strip(region)} = '' THEN 'Unknown' {chain} ELSE 'Unknown' END)"


def region(reg: str, prov: str, country: str, extra: str, source: str) -> str:
    place = f"(SELECT {strip('p')} FROM (SELECT unnest(CAST(json_extract({object_(extra)}, '$.locations') AS VARCHAR[])) AS p) WHERE {strip('p')} <> '' LIMIT 1)"
    wide = inside(t.GLOBAL_PROVIDERS)
    return f"""CASE WHEN {strip(reg)} <> '' THEN {strip(reg)} WHEN {strip(country)} <> '' THEN upper({strip(country)})
      WHEN {provider(prov)} = 'vultr' THEN CASE WHEN {extra} LIKE '%locations%' THEN coalesce({place}, 'global') ELSE 'global' END
      WHEN {provider(prov)} IN {wide} OR {provider(source)} IN {wide} THEN 'global' ELSE '' END"""


def memory(raw: str, gpu_name: str, count: str, var: str) -> str:
    """gpu_name is canonical here."""
    spec = object_(f"replace({strip(raw)}, '''', '\"')")
    compact = f"replace(lower(CASE WHEN {strip(raw)} <> '' THEN {strip(raw)} ELSE {gpu_name} END), ' ', '')"
    given = f"CASE WHEN coalesce(nullif({num(count)}, 0), 1) > 0 THEN coalesce(nullif({num(count)}, 0), 1) ELSE 1 END"
    value = f"""coalesce({num(raw)},
      CASE WHEN {spec} LIKE '%Gpus%' THEN round(CAST(json_extract_string({spec}, '$.Gpus[0].MemoryInfo.SizeInMiB') AS DOUBLE) / 1024, 6) WHEN {spec} LIKE '%TotalGpu%' THEN round(CAST(json_extract_string({spec}, '$.TotalGpuMemoryInMiB') AS DOUBLE) / ({given}) / 1024, 6) END,
      TRY_CAST(nullif(regexp_extract({strip(raw)}, '([0-9]+(\\.[0-9]+)?)\\s*(Gi?B|GB)\\b', 1, 'i'), '') AS DOUBLE),
      CASE WHEN {gpu_name} = 'H100' AND {variant(var)} = 'NVL' THEN 94.0 WHEN {gpu_name} = 'A100' AND contains({compact}, '80') THEN 80.0 WHEN {gpu_name} = 'A100' AND contains({compact}, '40') THEN 40.0
        ELSE CAST({case(t.GPU_MEMORY, gpu_name)} AS DOUBLE) END)"""
    return f"(SELECT CASE WHEN v IS NULL THEN '' WHEN v = floor(v) THEN CAST(CAST(v AS BIGINT) AS VARCHAR) ELSE CAST(v AS VARCHAR) END FROM (SELECT {value} AS v))"


OFFERS = f"o AS ({offers_sql()})"
_SAME = [x for x in COLUMNS if x not in ("provider", "gpu_name", "gpu_memory_gb", "pricing_type", "gpu_variant", "region", "geo_group")]
CONFORMED = f"""{OFFERS},
c1 AS MATERIALIZED (SELECT *, {provider('provider')} AS p2, {gpu('gpu_name')} AS g2 FROM o),
c2 AS MATERIALIZED (SELECT *, {memory('gpu_memory_gb', 'g2', 'gpu_count', 'gpu_variant')} AS m2, {pricing('pricing_type')} AS t2, {variant('gpu_variant')} AS v2, {region('region', 'p2', 'country', 'raw_extra', 'source')} AS r2 FROM c1),
f AS MATERIALIZED (SELECT row_seq, {', '.join(_SAME)}, p2 AS provider, g2 AS gpu_name, m2 AS gpu_memory_gb, t2 AS pricing_type, v2 AS gpu_variant, r2 AS region, {geo('r2', 'country')} AS geo_group, false AS changed FROM c2)"""
#: What is stored: named devices and per-token offers.
STORED = f"{CONFORMED}, s AS MATERIALIZED (SELECT * FROM f WHERE lower(pricing_type) = 'inference' OR {strip('gpu_name')} <> '')"

_of = lambda name: f"(source = {quoted(name)} OR provider = {quoted(name)})"
_tier = f"coalesce(nullif({js('raw_extra', 'price_metric')}, ''), {js('raw_extra', 'price_tier')})"
_suffix = f"regexp_extract({strip('instance_type')}, '_(min|max|avg|med|weightedAverage)$', 1)"
OUTLIER = f"({_of('akash')} AND gpu_name = 'GTX 1070 Ti' AND {pf('price_per_gpu_hour')} > 20)"
OTHER_TIER = f"({_of('akash')} AND CASE WHEN {_tier} <> '' THEN {_tier} <> 'weightedAverage' ELSE {_suffix} <> '' AND {_suffix} <> 'weightedAverage' END)"
PRICE_AS_COUNT = f"""({_of('coreweave')} AND lower(pricing_type) = 'on_demand' AND {pf('gpu_count')} > 0 AND {pf('price_per_hour')} > 0 AND abs({pf('gpu_count')} - round_even({pf('gpu_count')}, 0)) > 1e-6
  AND abs({pf('gpu_count')} - {pf('price_per_hour')}) <= 1e-6 AND abs({pf('price_per_gpu_hour')} - 1.0) <= 1e-6)"""
KEEP = f"(NOT {OUTLIER} AND NOT {OTHER_TIER} AND NOT {PRICE_AS_COUNT} AND (lower(pricing_type) = 'inference' OR ({strip('gpu_name')} <> '' AND NOT regexp_matches({strip('gpu_name')}, '^[0-9]+(\\.[0-9]+)?$'))))"


def walked(inference: bool = False, rows: str = "s", tag: str = "") -> str:
    """marked{tag}(row_seq, keep, ...) by walking each provider's and date's offers one after the other, as lists of covered keys."""
    key = lambda names: "md5(" + " || chr(1) || ".join(f"lower({strip(n)})" for n in names) + ")"
    only = "= 'inference'" if inference else "<> 'inference'"
    prio = case({k: v for k, v in t.PRIORITIES.items()}, "source", str(t.OTHER_PRIORITY))
    return f"""base{tag} AS MATERIALIZED (SELECT * REPLACE (lower({strip('provider')}) AS provider), {prio} AS prio FROM {rows} WHERE lower(pricing_type) {only} AND {strip('provider')} <> ''),
ordered{tag} AS MATERIALIZED (SELECT *, {key(['snapshot_date', 'provider', 'instance_type', 'pricing_type'])} AS ik, {key(['snapshot_date', 'provider', 'gpu_name', 'gpu_count', 'region', 'pricing_type', 'os'])} AS gk, {strip('gpu_name')} <> '' AS named,
  source = first_value(source) OVER (PARTITION BY provider ORDER BY prio, source) AS is_primary,
  row_number() OVER (PARTITION BY provider, snapshot_date ORDER BY prio, source, row_seq) AS n, row_number() OVER (ORDER BY prio, source, row_seq) AS ord FROM base{tag}),
walk{tag} AS (
  SELECT provider, snapshot_date, 0 AS n, CAST([] AS VARCHAR[]) AS iks, CAST([] AS VARCHAR[]) AS gks, false AS keep FROM (SELECT DISTINCT provider, snapshot_date FROM ordered{tag})
  UNION ALL
  SELECT w.provider, w.snapshot_date, w.n + 1, CASE WHEN k.keep THEN list_append(w.iks, r.ik) ELSE w.iks END, CASE WHEN k.keep AND r.named THEN list_append(w.gks, r.gk) ELSE w.gks END, k.keep
  FROM walk{tag} w JOIN ordered{tag} r ON r.provider = w.provider AND r.snapshot_date = w.snapshot_date AND r.n = w.n + 1,
    LATERAL (SELECT r.is_primary OR NOT (list_contains(w.iks, r.ik) OR (r.named AND list_contains(w.gks, r.gk))) AS keep) k
),
marked{tag} AS MATERIALIZED (SELECT o.*, w.keep FROM ordered{tag} o JOIN walk{tag} w USING (provider, snapshot_date, n))"""


def resolved(inference: bool = False) -> str:
    return f"{STORED}, {walked(inference)}"


def filled(tag: str = "") -> str:
    """filled{tag}: the kept rows of marked{tag}, backfilled from the lost ones."""
    donors = ", ".join(f"arg_min({b}, ord) FILTER (WHERE lower({strip(b)}) NOT IN {inside(t.EMPTY_WORDS)}) AS d_{b}" for b in BACKFILL)
    own = ", ".join(f"CASE WHEN lower({strip('k.' + b)}) NOT IN {inside(t.EMPTY_WORDS)} THEN k.{b} ELSE coalesce(d.d_{b}, k.{b}) END AS {b}" for b in BACKFILL)
    return f"""first_i{tag} AS (SELECT ik, min(ord) AS first_ord FROM marked{tag} WHERE keep GROUP BY ik),
lost{tag} AS (SELECT m.*, coalesce(first_ord < ord, false) AS by_i FROM marked{tag} m LEFT JOIN first_i{tag} USING (ik) WHERE NOT keep),
pairs{tag} AS (SELECT k.row_seq AS kept_seq, l.* FROM lost{tag} l JOIN marked{tag} k ON k.keep AND l.by_i AND k.ik = l.ik UNION ALL SELECT k.row_seq, l.* FROM lost{tag} l JOIN marked{tag} k ON k.keep AND NOT l.by_i AND k.named AND k.gk = l.gk),
given{tag} AS (SELECT kept_seq, {donors} FROM pairs{tag} GROUP BY kept_seq),
filled{tag} AS (SELECT k.* REPLACE ({own}) FROM marked{tag} k LEFT JOIN given{tag} d ON d.kept_seq = k.row_seq WHERE k.keep)"""


def backfilled() -> str:
    return f"{resolved()}, {filled()} SELECT row_seq, source, {', '.join(BACKFILL)} FROM filled"


def _scalar(expr: str, name: str) -> str:
    return f"WITH {OFFERS} SELECT row_seq, {expr} AS {name} FROM o"


_distinct = lambda x: f"count(DISTINCT nullif({strip(x)}, ''))"
_kind = f"CASE WHEN {js('raw_extra', 'billing_model')} = 'capacity_block' OR {js('raw_extra', 'purchase_option')} = 'capacity_block' THEN 'capacity_block' WHEN {js('raw_extra', 'billing_model')} = 'capacity_reservation' OR {js('raw_extra', 'purchase_option')} = 'capacity_reservation' OR {js('raw_extra', 'capacity_status')} IN ('UnusedCapacityReservation', 'AllocatedCapacityReservation') THEN 'capacity_reservation' WHEN {pf('price_per_gpu_hour')} > 0 AND {pf('price_per_gpu_hour')} < {case(t.RESERVED_FLOORS, 'gpu_name')} THEN 'capacity_block' END"
_off = f"upper({strip('available')}) IN {inside(t.CURRENCIES)} AND lower({strip('available_count')}) IN {inside(t.PRICE_UNITS)} AND lower({strip('os')}) IN {inside(t.BOOLEANS)}"


def _step(name: str, hit: str, new: dict[str, str]) -> str:
    """A repair of {rows} as the table ``name``: columns with new values where hit holds, and changed where any differs."""
    value = {k: f"CASE WHEN {hit} THEN {v} ELSE {k} END" for k, v in new.items()}
    differs = " OR ".join(f"({v}) <> {k}" for k, v in value.items())
    brace = lambda x: x.replace("{", "{{").replace("}", "}}")
    return f"{name} AS MATERIALIZED (SELECT * REPLACE (" + brace(", ".join(f"{v} AS {k}" for k, v in value.items()) + f", changed OR {differs} AS changed") + ") FROM {rows})"


def _braced(x: str) -> str:
    return x.replace("{", "{{").replace("}", "}}")


_own = lambda k: f"nullif({js('raw_extra', k)}, '')"
_hit = f"({_of('aws')} AND lower(pricing_type) = 'on_demand' AND ({_kind}) IS NOT NULL)"
_fill = lambda x: f"coalesce({x}, {_kind})"
RESERVED = _step("d3", _hit, {"pricing_type": "'reserved'", "commitment_period": _fill("nullif(commitment_period, '')"), "raw_extra": patched("raw_extra", purchase_option=_fill(_own("purchase_option")), billing_model=_fill(_own("billing_model")))})
_known = f"({_of('azure')} AND instance_type IN {inside(list(t.SKU_SPECS))})"
_specs = _step("d4a", _known, {k: case({sku: v[j] for sku, v in t.SKU_SPECS.items()}, "instance_type") for j, k in enumerate(("gpu_name", "gpu_memory_gb", "gpu_count", "gpu_variant"))})
_marked = f"d4b AS MATERIALIZED (SELECT *, {_of('azure')} AS mine, {_of('azure')} AND pricing_type = 'on_demand' AND {pf('price_per_gpu_hour')} > 500 AS odd, {pf('price_per_hour')} AS was FROM d4a)"
_moved = _step("d4c", "odd", {"pricing_type": "'reserved'", "commitment_period": "coalesce(nullif(commitment_period, ''), 'unknown')", "upfront_price": "coalesce(nullif(upfront_price, ''), price_per_hour)", "upfront_price_per_gpu": "coalesce(nullif(upfront_price_per_gpu, ''), price_per_gpu_hour)", "price_per_hour": "'0'", "price_per_gpu_hour": "'0'"}).format(rows="d4b")
_up = f"mine AND {pf('gpu_count')} > 0 AND pricing_type = 'reserved' AND {pf('upfront_price')} > 0"
_each_up = _step("d4d", _up, {"upfront_price_per_gpu": fmt(pf("upfront_price") + " / " + pf("gpu_count"))}).format(rows="d4c")
_each = _step("d4e", f"mine AND {pf('gpu_count')} > 0 AND NOT ({_up}) AND was > 0", {"price_per_gpu_hour": fmt("was / " + pf("gpu_count"))}).format(rows="d4d")
UPFRONT = f"{_specs}, " + _braced(f"{_marked}, {_moved}, {_each_up}, {_each}, d4 AS (SELECT * EXCLUDE (mine, odd, was) FROM d4e)")
_legacy, _cards = pf(js("raw_extra", "daily_usd")), f"CASE WHEN {pf('gpu_count')} > 0 THEN {pf('gpu_count')} ELSE 1 END"
_source = f"CASE WHEN {_legacy} > 0 THEN {_legacy} ELSE {pf(js('raw_extra', 'source_price_usd'))} END"
_usable = f"{_of('cloreai')} AND ({_source}) > 0 AND ({_legacy} > 0 OR lower({js('raw_extra', 'source_price_unit')}) IN ('hour', 'hr', 'hourly'))"
DAILY = _step("d5a", f"{_usable} AND {pf('price_per_hour')} > 0 AND abs({pf('price_per_hour')} * 24 - ({_source})) <= 1e-4", {"price_per_hour": fmt(f"({_source})")})
DAILY += ", " + _braced(_step("d5b", f"{_usable} AND {pf('price_per_gpu_hour')} > 0 AND abs({pf('price_per_gpu_hour')} * 24 - ({_source}) / ({_cards})) <= 1e-4", {"price_per_gpu_hour": fmt(f"({_source}) / ({_cards})")}).format(rows="d5a"))
DAILY += ", " + _braced(_step("d5", f"{_of('cloreai')} AND {_legacy} > 0", {"raw_extra": patched("raw_extra", source_price_usd=fmt(_legacy), source_price_unit="'hour'", daily_usd="NULL")}).format(rows="d5b"))
TIER = _step("d6a", f"{_of('akash')} AND {js('raw_extra', 'price_tier')} <> ''", {"raw_extra": patched("raw_extra", price_metric=f"coalesce({_own('price_metric')}, {js('raw_extra', 'price_tier')})", price_tier="NULL")})
TIER += ", " + _braced(_step("d6", _of("akash"), {"instance_type": f"regexp_replace({strip('instance_type')}, '_weightedAverage$', '')"}).format(rows="d6a"))
_node = f"regexp_replace({strip('instance_type')}, '\\s+', ' ', 'g')"
_nodes = f"{_of('coreweave')} AND {_node} IN {inside(list(t.NODE_COUNTS))}"
NODES = _step("d7a", _nodes, {"gpu_count": case(t.NODE_COUNTS, _node), "gpu_memory_gb": case(t.NODE_MEMORY, _node)})
NODES += ", " + _braced(_step("d7", f"{_nodes} AND {pf('price_per_hour')} > 0", {"price_per_gpu_hour": fmt(f"{pf('price_per_hour')} / {pf('gpu_count')}")}).format(rows="d7a"))
_share = f"round({num('gpu_memory_gb')} / {case({a: float(b) for a, b in t.FULL_CARD_MEMORY.items()}, 'gpu_name')}, 6)"
_cards_of = f"CASE WHEN {_share} > 0 THEN {_share} ELSE 1.0 END"
_shown = f"CASE WHEN ({_cards_of}) = floor({_cards_of}) THEN CAST(CAST({_cards_of} AS BIGINT) AS VARCHAR) ELSE CAST({_cards_of} AS VARCHAR) END"
FRACTIONS = _step("d8a", f"{_of('vultr')} AND {pf('price_per_hour')} > 0", {"price_per_gpu_hour": fmt(f"{pf('price_per_hour')} / ({_cards_of})")})
FRACTIONS += ", " + _braced(_step("d8", _of("vultr"), {"gpu_count": _shown}).format(rows="d8a"))
_back = {"upfront_price": "currency", "upfront_price_per_gpu": "price_unit", "currency": "available", "price_unit": "available_count", "available": "os", "available_count": "tenancy", "os": "pre_installed_sw", "tenancy": "raw_extra", "pre_installed_sw": "''", "raw_extra": "''"}
_new = {"provider": "p2", "gpu_name": "g2", "gpu_memory_gb": "m2", "region": "r2", "geo_group": geo("r2", "country")}
REPAIRED = f"""{OFFERS}, d1 AS MATERIALIZED (SELECT * REPLACE ({', '.join(f"CASE WHEN {_off} THEN {new} ELSE {old} END AS {old}" for old, new in _back.items())}), {_off} AS shifted FROM o),
n1 AS MATERIALIZED (SELECT *, {provider('provider')} AS p2, {gpu('gpu_name')} AS g2 FROM d1),
n2 AS MATERIALIZED (SELECT *, {memory('gpu_memory_gb', 'g2', 'gpu_count', 'gpu_variant')} AS m2, {region('region', 'p2', 'country', 'raw_extra', 'source')} AS r2 FROM n1),
d2 AS MATERIALIZED (SELECT * EXCLUDE (p2, g2, m2, r2) REPLACE ({', '.join(f'{v} AS {k}' for k, v in _new.items())}), {' OR '.join(f'({v}) <> {k}' for k, v in _new.items())} AS changed FROM n2),
{RESERVED.format(rows='d2')}, {UPFRONT.format(rows='d3')}, {DAILY.format(rows='d4')}, {TIER.format(rows='d5')}, {NODES.format(rows='d6')}, {FRACTIONS.format(rows='d7')}"""
_top = f"coalesce(nullif({strip('gpu_name')}, ''), '(unknown)')"
_fresh = f"SELECT {', '.join(COLUMNS)} FROM s"

ORACLE_SQL: dict[str, str] = {
    "norm_provider": _scalar(provider("provider"), "norm"),
    "norm_gpu_name": _scalar(gpu("gpu_name"), "norm"),
    "norm_gpu_memory": f"WITH {CONFORMED} SELECT row_seq, gpu_memory_gb AS norm FROM f",
    "norm_region": _scalar(region("region", "provider", "country", "raw_extra", "source"), "norm"),
    "norm_pricing_type": _scalar(pricing("pricing_type"), "norm"),
    "norm_variant": _scalar(variant("gpu_variant"), "norm"),
    "geo_group": _scalar(geo("region", "country"), "norm"),
    "conform_offers": f"WITH {CONFORMED} SELECT row_seq, {', '.join(COLUMNS)} FROM f",
    "per_gpu_price": _scalar(f"CASE WHEN {pf('gpu_count')} <= 0 THEN price_per_hour ELSE {fmt(num('price_per_hour') + ' / ' + pf('gpu_count'))} END", "each"),
    "format_price": _scalar(fmt(f"{pf('price_per_hour')} / 7"), "shown"),
    "json_tail_update": _scalar(patched("raw_extra", added="'new'", price_tier="NULL"), "new"),
    "save_filter": f"WITH {CONFORMED} SELECT row_seq FROM f WHERE lower(pricing_type) = 'inference' OR {strip('gpu_name')} <> ''",
    "quality_keep": f"WITH {CONFORMED} SELECT row_seq FROM f WHERE {KEEP}",
    "outlier_bounds": f"WITH {CONFORMED} SELECT row_seq FROM f WHERE {OUTLIER}",
    "canonical_tier": f"WITH {CONFORMED} SELECT row_seq FROM f WHERE {OTHER_TIER}",
    "malformed_price_row": f"WITH {CONFORMED} SELECT row_seq FROM f WHERE {PRICE_AS_COUNT}",
    "split_kind": f"WITH {CONFORMED} SELECT CASE WHEN lower(pricing_type) = 'inference' THEN 'inference' ELSE 'hourly' END AS kind, count(*) AS n_rows FROM f GROUP BY 1",
    "keyword_filter": f"WITH {OFFERS} SELECT row_seq FROM o WHERE regexp_matches(gpu_name || ' ' || instance_type, 'h100|gb200|rtx', 'i')",
    "price_sanity": f"WITH {OFFERS} SELECT row_seq, CAST(price_per_hour AS DOUBLE) AS price FROM o WHERE CAST(price_per_hour AS DOUBLE) > 0 AND CAST(price_per_hour AS DOUBLE) <= 500",
    "repair_shifted_tail": f"WITH {OFFERS} SELECT row_seq, {_off} AS shifted, " + ", ".join(f"CASE WHEN {_off} THEN {new} ELSE {old} END AS {old}" for old, new in (("upfront_price", "currency"), ("upfront_price_per_gpu", "price_unit"), ("currency", "available"), ("price_unit", "available_count"), ("available", "os"), ("available_count", "tenancy"), ("os", "pre_installed_sw"), ("tenancy", "raw_extra"), ("pre_installed_sw", "''"), ("raw_extra", "''"))) + " FROM o",
    "normalise_existing": f"WITH {CONFORMED} SELECT row_seq, f.provider, f.gpu_name, f.gpu_memory_gb, f.region, f.geo_group, (f.provider <> o.provider OR f.gpu_name <> o.gpu_name OR f.gpu_memory_gb <> o.gpu_memory_gb OR f.region <> o.region OR f.geo_group <> o.geo_group) AS changed FROM f JOIN o USING (row_seq)",
    "repair_reserved": f"WITH {CONFORMED}, {RESERVED.format(rows='f')} SELECT row_seq, pricing_type, commitment_period, raw_extra FROM d3",
    "repair_upfront": f"WITH {CONFORMED}, {UPFRONT.format(rows='f')} SELECT row_seq, gpu_name, gpu_count, pricing_type, upfront_price, price_per_hour, upfront_price_per_gpu, price_per_gpu_hour FROM d4",
    "repair_tier": f"WITH {CONFORMED}, {TIER.format(rows='f')} SELECT row_seq, instance_type, raw_extra FROM d6",
    "repair_node_counts": f"WITH {CONFORMED}, {NODES.format(rows='f')} SELECT row_seq, gpu_count, gpu_memory_gb, price_per_gpu_hour FROM d7",
    "repair_fractional": f"WITH {CONFORMED}, {FRACTIONS.format(rows='f')} SELECT row_seq, {pf('gpu_count')} AS gpu_count, price_per_gpu_hour FROM d8",
    "repair_counts": f"WITH {REPAIRED} SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE shifted) AS shifted, count(*) FILTER (WHERE changed) AS changed, count(*) FILTER (WHERE NOT {KEEP}) AS dropped FROM d8 GROUP BY source",
    "dedup_exact": f"WITH {STORED} SELECT DISTINCT {', '.join(COLUMNS)} FROM ({_fresh} UNION ALL {_fresh})",
    "retention_retained": f"WITH {STORED} SELECT row_seq FROM s WHERE snapshot_date >= '{CUTOFF}'",
    "retention_expired": f"WITH {STORED} SELECT row_seq FROM s WHERE snapshot_date < '{CUTOFF}'",
    "prune_metrics": f"WITH {STORED}, u AS ({_fresh} UNION ALL {_fresh}), g AS (SELECT source, snapshot_date, count(*) AS n FROM u GROUP BY {', '.join(COLUMNS)}) SELECT source, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS deduped, count(*) FILTER (WHERE snapshot_date < '{CUTOFF}') AS expired, count(*) FILTER (WHERE snapshot_date >= '{CUTOFF}') AS kept FROM g GROUP BY source",
    "prune_incremental": f"WITH {STORED} SELECT DISTINCT {', '.join(COLUMNS)} FROM s WHERE snapshot_date >= '{CUTOFF}' AND {KEEP}",
    "archive_month_split": f"WITH {STORED} SELECT substr(snapshot_date, 1, 7) AS month, count(*) AS n_rows FROM s WHERE snapshot_date < '{CUTOFF}' GROUP BY 1",
    "merge_archives": f"WITH {STORED} SELECT DISTINCT snapshot_date, source, provider, price_per_hour FROM s",
    "union_sources": f"WITH {STORED} SELECT source, count(*) AS n_rows FROM s GROUP BY source",
    "dedup_keyed_first": f"WITH {STORED} SELECT gpu_name, price_per_hour, row_seq FROM (SELECT *, row_number() OVER (PARTITION BY gpu_name, price_per_hour ORDER BY row_seq) AS k FROM s) WHERE k = 1",
    "rank_sources": f"WITH {STORED} SELECT DISTINCT provider, source, CAST({case(t.PRIORITIES, 'source', str(t.OTHER_PRIORITY))} AS INTEGER) AS rank FROM s WHERE {strip('provider')} <> ''",
    "primary_source": f"WITH {STORED} SELECT DISTINCT provider, first_value(source) OVER (PARTITION BY provider ORDER BY {case(t.PRIORITIES, 'source', str(t.OTHER_PRIORITY))}, source) AS source FROM s WHERE {strip('provider')} <> ''",
    "resolve_offers": f"WITH RECURSIVE {resolved()} SELECT row_seq, source, provider FROM marked WHERE keep",
    "resolve_backfill": f"WITH RECURSIVE {backfilled()}",
    "resolve_inference": f"WITH RECURSIVE {resolved(True)} SELECT row_seq, source, provider FROM marked WHERE keep",
    "resolve_stats": f"WITH RECURSIVE {resolved()} SELECT (SELECT count(*) FROM s WHERE lower(pricing_type) <> 'inference') AS n_in, count(*) FILTER (WHERE keep) AS n_out, (SELECT count(*) FROM s WHERE lower(pricing_type) <> 'inference') - count(*) FILTER (WHERE keep) AS removed, round(((SELECT count(*) FROM s WHERE lower(pricing_type) <> 'inference') - count(*) FILTER (WHERE keep)) / (SELECT count(*) FROM s WHERE lower(pricing_type) <> 'inference') * 100, 4) AS removed_percent, count(DISTINCT provider) AS providers FROM marked",
    "resolve_breakdown": f"WITH RECURSIVE {resolved()}, n AS (SELECT provider, source, count(*) AS n, count(*) FILTER (WHERE keep) AS k FROM marked GROUP BY ALL) SELECT provider, CAST(sum(n) AS BIGINT) AS n_in, CAST(sum(k) AS BIGINT) AS n_out, count(*) AS n_sources, string_agg(source || '=' || n, ',' ORDER BY source) AS by_source, first(source ORDER BY n DESC, source) AS largest FROM n GROUP BY provider HAVING count(*) > 1",
    "source_summary": f"WITH {STORED} SELECT source, count(*) AS n_rows, {_distinct('snapshot_date')} AS dates, min(snapshot_date) AS first_date, max(snapshot_date) AS last_date, {_distinct('provider')} AS providers, {_distinct('gpu_name')} AS gpus, {_distinct('region')} AS regions, string_agg(DISTINCT pricing_type, ',' ORDER BY pricing_type) AS pricing_types FROM s GROUP BY source",
    "top_gpus": f"WITH {STORED} SELECT {_top} AS gpu_name, count(*) AS n_rows FROM s GROUP BY 1 ORDER BY count(*) DESC, min(row_seq) LIMIT 20",
    "top_gpus_by_source": f"WITH {STORED}, g AS (SELECT source, {_top} AS gpu_name, count(*) AS n_rows, min(row_seq) AS a FROM s GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_rows DESC, a) AS place FROM g) SELECT source, gpu_name, n_rows, CAST(place AS INTEGER) AS place FROM r WHERE place <= 20",
    "rows_by_date": f"WITH {STORED} SELECT snapshot_date, count(*) AS n_rows FROM s GROUP BY 1",
    "source_totals": f"WITH {STORED} SELECT CASE WHEN grouping(source) = 1 THEN '(all)' ELSE source END AS source, count(*) AS n_rows FROM s GROUP BY ROLLUP (source)",
    "master_summary": f"WITH RECURSIVE {resolved()} SELECT count(*) AS n_rows, {_distinct('provider')} AS providers, {_distinct('gpu_name')} AS gpus, min(snapshot_date) AS first_date, max(snapshot_date) AS last_date FROM marked WHERE keep",
    "baseline_metrics": f"WITH {STORED} SELECT source, count(*) AS n_rows, min(snapshot_date) AS first_date, max(snapshot_date) AS last_date, date_diff('day', min(CAST(snapshot_date AS DATE)), max(CAST(snapshot_date AS DATE))) AS span_days FROM s GROUP BY source",
    "health_gate": f"WITH {STORED}, h AS (SELECT count(DISTINCT source) AS sources, count(*) AS n_rows, date_diff('day', min(CAST(snapshot_date AS DATE)), max(CAST(snapshot_date AS DATE))) AS span_days FROM s) SELECT *, CASE WHEN sources < 5 THEN 'too few sources' WHEN n_rows < 1000000 THEN 'too few rows' WHEN span_days < 75 THEN 'span too short' ELSE 'ok' END AS status FROM h",
    "rollup_components": "SELECT l_orderkey, l_suppkey % 10 AS bucket, round(coalesce(sum(l_extendedprice) FILTER (WHERE l_linenumber % 3 = 0), 0.0), 6) AS price_per_hour, round(coalesce(sum(l_extendedprice) FILTER (WHERE l_linenumber % 3 = 1), 0.0), 6) AS upfront_price FROM lineitem GROUP BY 1, 2 HAVING coalesce(sum(l_extendedprice) FILTER (WHERE l_linenumber % 3 = 0), 0.0) > 0 OR coalesce(sum(l_extendedprice) FILTER (WHERE l_linenumber % 3 = 1), 0.0) > 0",
    "scan_dates_semi": f"WITH {STORED} SELECT row_seq FROM s WHERE snapshot_date IN (SELECT DISTINCT snapshot_date FROM s WHERE source = 'aws' AND gpu_name = 'H100')",
    "replace_dates": f"WITH {STORED}, d AS (SELECT DISTINCT snapshot_date FROM s WHERE snapshot_date LIKE '1996-0%') SELECT row_seq, 'old' AS mark FROM s WHERE snapshot_date >= '{CUTOFF}' AND snapshot_date NOT IN (SELECT * FROM d) UNION ALL SELECT row_seq, 'new' AS mark FROM s WHERE snapshot_date IN (SELECT * FROM d)",
    "affected_dates": f"WITH {STORED} SELECT DISTINCT snapshot_date FROM s WHERE snapshot_date >= '{CUTOFF}' AND (source = 'akash' OR (source <> 'akash' AND NOT {KEEP}))",
    "repair_daily_hourly": f"""WITH {OFFERS}, k AS (SELECT row_seq, source, provider, '1' AS gpu_count, {fmt(pf('price_per_hour') + ' / 24')} AS low, CASE WHEN right(row_seq, 1) < '5' THEN '{{"source_price_usd":"' || price_per_hour || '","source_price_unit":"hour"}}' ELSE '{{"a":[1,true],"daily_usd":' || price_per_hour || ',"z":{{"k":null}}}}' END AS raw_extra FROM o),
      b AS (SELECT *, low AS price_per_hour, low AS price_per_gpu_hour, false AS changed FROM k), {DAILY.format(rows='b')} SELECT row_seq, price_per_hour, price_per_gpu_hour, raw_extra, changed FROM d5""",
    "master_sorted": f"WITH {STORED} SELECT {', '.join(COLUMNS)} FROM s WHERE lower(pricing_type) <> 'inference'",
    "inference_sorted": f"WITH {STORED} SELECT {', '.join(COLUMNS)} FROM s WHERE lower(pricing_type) = 'inference'",
    "schema_migrate": f"WITH {OFFERS} SELECT row_seq, source, CASE WHEN right(row_seq, 1) IN ('0', '2', '4', '6', '8') THEN '7' ELSE '' END AS upfront_price, raw_extra FROM o",
    "incremental_state": f"""WITH {STORED}, h AS (SELECT DISTINCT {', '.join(COLUMNS)} FROM s WHERE snapshot_date >= '{CUTOFF}' AND {KEEP}), e AS (SELECT DISTINCT {', '.join(COLUMNS)} FROM s WHERE snapshot_date < '{CUTOFF}')
      SELECT 'baseline' AS kind, source, snapshot_date AS part, count(*) AS n_rows FROM h GROUP BY ALL UNION ALL SELECT 'archive', '', substr(snapshot_date, 1, 7), count(*) FROM e GROUP BY ALL
      UNION ALL SELECT DISTINCT CASE WHEN lower(pricing_type) = 'inference' THEN 'inference' ELSE 'master' END, '', snapshot_date, 1 FROM h WHERE {strip('provider')} <> ''""",
    "incremental_finalize": f"""WITH RECURSIVE {STORED}, fresh AS (SELECT * FROM s WHERE source = 'akash' AND snapshot_date LIKE '%-03-01'), kept_old AS (SELECT * FROM s WHERE source <> 'akash'),
      d AS (SELECT snapshot_date FROM fresh WHERE snapshot_date >= '{CUTOFF}' UNION SELECT snapshot_date FROM kept_old WHERE snapshot_date >= '{CUTOFF}' AND NOT {KEEP}),
      part AS (SELECT {', '.join(COLUMNS)}, min(row_seq) AS row_seq FROM (SELECT * FROM fresh UNION ALL SELECT * FROM kept_old) WHERE snapshot_date IN (SELECT * FROM d) AND snapshot_date >= '{CUTOFF}' AND {KEEP} GROUP BY {', '.join(COLUMNS)}),
      {walked(False, 'part', '_h')}, {filled('_h')}, {walked(True, 'part', '_t')}, {filled('_t')}
      SELECT {', '.join(COLUMNS)} FROM filled_h UNION ALL SELECT {', '.join(COLUMNS)} FROM filled_t
      UNION ALL SELECT DISTINCT {', '.join("'published' AS tenancy" if x == 'tenancy' else x for x in COLUMNS)} FROM kept_old WHERE snapshot_date >= '{CUTOFF}' AND snapshot_date NOT IN (SELECT * FROM d)""",
}
