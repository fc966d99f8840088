"""Page tables, rules as tables, search in JSON values."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from priceframe.functions import tables as t
from priceframe.operators import flatten, text
from priceframe.plans import payloads
from priceframe.sources.grids import grids_of


def rows_of(page):
    return [g["rows"] for g in grids_of(page)]


def test_grids_fill_spans():
    page = "<table><tr><th>a</th><th colspan=2>b</th></tr><tr><td rowspan='2'>1</td><td>2</td><td>3</td></tr><tr><td>4</td><td rowspan=5>5</td></tr><tr><td>6<td>7</table>"
    assert rows_of(page) == [[["a", "b", "b"], ["1", "2", "3"], ["1", "4", "5"], ["6", "7", "5"]]]
    assert rows_of("<table><tr><td rowspan=0>x<td>1<tr><td>2<tr><td>3</table>") == [[["x", "1"], ["x", "2"], ["x", "3"]]]
    assert rows_of("<table><tr><td>a<td rowspan=2>b<tr><td>c<td>d</table>") == [[["a", "b"], ["c", "b", "d"]]]


def test_grids_of_nested_and_broken_pages():
    page = "<table><tr><td>out <table><tr><td>in</td></tr></table>er</td><td>x</td></tr></table>"
    assert [(g["table"], g["rows"]) for g in grids_of(page)] == [(0, [["out er", "x"]]), (1, [["in"]])]
    assert rows_of("<TABLE><td>no row<td>&lt;b&gt;&amp;nbsp;<tr><td a='>'>q") == [[["no row", "<b>&nbsp;"], ["q"]]]
    assert rows_of("<table><tr><td>a<br>b<script>if (x < 1) '</td>'</script><!-- <td>no</td> --></td></tr><tr></tr><tr><td> &nbsp; </td></tr></table>") == [[["a b"]]]
    assert rows_of(None) == rows_of("<td>x</td>") == rows_of("<table></table>") == [] and rows_of("<table>" * 500 + "<td>deep") == [[["deep"]]]
    assert len(rows_of("<table><tr><td colspan=99999999>x</table>")[0][0]) == 1000


def test_rules_equal_their_chain(spark):
    draw = random.Random(4)
    words = ["h100", "H200", "nd96", "nc40ads", "a100", "nc24ads", "nc96", "nd96ams", "80", "a10", "v100", "T4", "m60", "k80", "l40", "p4", "80gb", "x", "", "é", "-", "commit1yr", "Spot"]
    label = lambda: None if draw.random() < 0.05 else "_".join(draw.choice(words) for _ in range(draw.randint(0, 4)))
    rows = [(k, label(), label(), label()) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, a string, b string, c string")
    for rules, fields in ((t.SIZE_RULES, 3), (t.DESCRIPTION_RULES, 1)):
        table = flatten.rule_table(spark, rules, "gpu string, gb int, gpus int, variant string")
        got = {r.id: r for r in flatten.classify_by_rules(df, [F.col(x) for x in "abc"[:fields]], table).collect()}
        assert len(got) == 400
        for k, *own in rows:
            has = lambda x: x[2:] in (own[int(x[0])] or "").lower()  # noqa: B023, E731
            want = next((n for n, (need, lack, *_) in enumerate(rules) if all(map(has, need)) and not any(map(has, lack))), None)
            assert got[k].rule == want and (want is None or (got[k].gpu, got[k].gb, got[k].gpus, got[k].variant) == tuple(rules[want][2:]))
    assert flatten.classify_by_rules(df.limit(0), [F.col("a")], table).count() == 0


def test_search_json_at_all_depths(spark):
    body = '{"name":"top","price":1,"list":[{"name":"a","price":2,"more":{"name":"b","price":[3]}},[[{"name":"c","price":null}]],{"name":"no"}],"deep":{"d":{"d":{"d":{"d":{"d":{"name":"six","price":6,"x":{"name":"seven","price":7}}}}}}}}'
    df = spark.createDataFrame([(1, body), (2, "[]"), (3, "5"), (4, None)], "id int, body string").select("id", F.try_parse_json("body").alias("json"))
    names = lambda **k: sorted(r[0] for r in text.search_json(df, ["name", "price"], **k).select(F.try_variant_get("json", "$.name", "string")).collect())
    assert names() == ["a", "b", "c", "six", "top"] and names(depth=0) == ["top"] and names(depth=7) == ["a", "b", "c", "seven", "six", "top"]
    plan = text.search_json(df, ["name"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("Generate") == 1


def test_bulk_price_files_take_the_first_of_equal_lines_in_table_order(spark, tmp_path):
    """Lines of one number differ in the device count; the second file is the larger one, which Spark reads first."""
    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    for name, each, quantity in (("a", 1, 10.0), ("b", 9, 40.0)):
        n = 40 * each
        pq.write_table(pa.table({"l_orderkey": [k % 40 for k in range(n)], "l_partkey": [0] * n, "l_suppkey": [1] * n, "l_linenumber": pa.array([3] * n, pa.int32()), "l_quantity": [quantity] * n, "l_extendedprice": [1000.0 + k for k in range(n)]}), folder / f"{name}.parquet")
    got = payloads.bulk_price_files(spark, str(tmp_path)).select("l_orderkey", "gpu_count").collect()
    assert sorted((r[0], r[1]) for r in got) == [(k, "8") for k in range(40)]
