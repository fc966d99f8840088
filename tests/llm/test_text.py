"""Personal data, decontamination, WARC, classifier and mixing."""

import random

import brute
from conftest import same
from pyspark.sql import functions as F

from priceframe.llm import decontaminate, mixing, pii, quality, warc

CASES = [
    "mail a.b@c.de and a@b, x@@y.z, p@q.r@s.t", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111114111111111111111",
    "+1 (555) 010-9999 and +1 and +12 34 56 78 90 12 34 56 78, ++49 30 123456 +1--2", "1" * 3000, "a@" * 500, "+" * 500, "é+33 1 23 45 67 89 ü@x.y", "", None, "9.9.9.9@h.de",
]


def test_personal_data(spark):
    rows = list(enumerate(CASES)) + [(0, CASES[0])]
    found = pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string")))
    same(found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"), brute.personal_data(rows))
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_redact(spark, docs):
    df = spark.createDataFrame([(1, "call +1 555 010 9999 or a@b.de", "x"), (2, None, "y"), (3, "nothing", "z")], "doc_id long, text string, spans string")
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    assert out[1].text == "call [phone] or [email]" and out[2].text is None and out[3].text == "nothing" and out[1].spans == "x"


def test_trees_select_unmatched_cards(spark):
    """Two valid numbers run together fail the base check and are found by the trees once they have seen enough of both kinds."""
    draw = random.Random(1)

    def number(valid: bool) -> str:
        while True:
            n = "".join(draw.choice("0123456789") for _ in range(16))
            if pii.luhn(n) == valid:
                return n

    rows = [(k, f"text {number(k % 2 == 0)} more") for k in range(600)] + [(1000, f"{number(True)} {number(True)}")]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 1000").first()
    assert [(s.kind, s.start, s.end, s.base) for s in found.spans] == [(2, 0, 16, False), (2, 17, 33, False)]


def test_trees_add_spans_of_a_rare_kind(spark):
    """Many cards crowd out phones in one sample for all kinds; a phone without a plus is found all the same."""
    draw = random.Random(2)
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    cards = [f"text {digits(16)} more" for _ in range(1000)]
    for phones in (12, 120):
        calls = [f"call +{digits(2)} {digits(3)} {digits(3)} {digits(4)} now" for _ in range(phones)]
        rows = list(enumerate([*cards, *calls])) + [(9000, "call 555 010 9999 now")]
        found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), sample=150).where("doc_id = 9000").first()
        assert [(s.kind, s.start, s.end, s.base) for s in found.spans] == [(3, 5, 17, False)]


def test_decontaminate(spark, docs, rows):
    items = [(k, r[1]) for k, r in enumerate(rows[:30:3])] + [(100, "Ab"), (101, None), (102, "..."), (103, rows[0][1]), (103, rows[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.decontaminate([(r[0], r[1]) for r in rows], items)
    same(decontaminate.digest(decontaminate.find(docs, bench, into="hits"), col="hits"), expected)
    same(decontaminate.digest(decontaminate.find(docs, bench, into="hits", slice_bytes=600), col="hits"), expected)
    assert decontaminate.find(docs, bench.limit(0)).where("found.n_hit > 0").count() == 0
    kept = decontaminate.remove_documents(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not e[-1] for e in expected)
    cut = decontaminate.remove_spans(docs, bench)
    assert decontaminate.find(cut, bench, into="hits").where("hits.n_hit > 0 and hits.n_words > 20").count() == 0


def test_warc_round_trip(spark, tmp_path):
    pages = [(k, f"http://x/{k}\r\nX-Evil: 1", "<p>é</p>" * (k % 4)) for k in range(30)] + [(100, None, None), (101, "http://y", "big" * 100_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    warc.write(df, f"file://{tmp_path}/a", min_bytes=9)
    back = warc.read(spark, f"file://{tmp_path}/a")
    same(warc.digest(spark, f"file://{tmp_path}/a"), brute.warc([(p, h) for p, _, h in pages], 9))
    some = back.where("warc_type = 'response' and payload_bytes = 9").select("page_id", "payload").collect()
    assert [(r.page_id, bytes(r.payload).decode()) for r in some] == [(1, "<p>é</p>")]
    assert back.where("warc_type = 'revisit'").where("payload is not null").count() == 0
    assert warc.read(spark, f"file://{tmp_path}/a", payload=False).where("payload is not null").count() == 0
    warc.write(df.limit(0), f"file://{tmp_path}/b")
    assert warc.read(spark, f"file://{tmp_path}/b").count() == 0


def test_warc_all_sizes_repeated_ids_and_clashing_names(spark, tmp_path):
    pages = [(1, "u", "aa", "w"), (2, "u", "aa", "w"), (0, None, "", "w"), (3, "u", None, "w"), (2, "u", "aa", "w"), (4, "u", "é", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, payload string")
    warc.write(df, f"file://{tmp_path}/a")
    same(warc.digest(spark, f"file://{tmp_path}/a"), brute.warc([(r[0], r[2]) for r in pages]))


def test_warc_skips_payloads_by_length(spark, tmp_path):
    import os

    noise = [os.urandom(40_000).hex() for _ in range(6)]
    df = spark.createDataFrame([(k, "u", x) for k, x in enumerate([*noise, noise[0]])], "page_id long, url string, html string").coalesce(1)
    warc.write(df, f"file://{tmp_path}/a")
    plan = warc.read(spark, f"file://{tmp_path}/a").where("warc_type = 'revisit'")
    assert [r.page_id for r in plan.collect()] == [6] and "Filter (" not in plan._jdf.queryExecution().executedPlan().toString()
    (path,) = (tmp_path / "a").glob("*.warc.gz")
    for wanted, payload, most, n in ((lambda r: r["warc_type"] == "revisit", True, 12_000, 1), (lambda r: True, False, 12_000, 7), (lambda r: True, True, 10**6, 7)):
        seen = {}
        with path.open("rb") as f:
            assert len(list(warc._records(f, True, wanted, payload, seen))) == n
        assert seen["inflated"] < most
    whole = path.read_bytes()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "cut.warc.gz").write_bytes(whole[: len(whole) - 9000])
    assert 4 <= warc.read(spark, f"file://{tmp_path}/b").count() < 7
    import gzip

    foreign = b"WARC/1.0\r\nwarc-type: response\r\nX-PAGE-ID: x7\r\nWARC-Target-URI: \xff\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "one.warc.gz").write_bytes(gzip.compress(foreign) + gzip.compress(foreign[:-9]))
    (tmp_path / "c" / "two.warc").write_bytes(foreign * 2)
    rows = warc.read(spark, f"file://{tmp_path}/c").collect()
    assert [(bytes(r.payload), r.page_id, r.target_uri) for r in rows] == [(b"abc", None, "\ufffd")] * 3


def test_warc_pushdown(spark, tmp_path):
    warc.register(spark)
    reader = warc.WarcReader(str(tmp_path), 1, True)
    left = list(reader.pushFilters([warc.EqualTo(("warc_type",), "response"), warc.EqualTo(("payload",), b"")]))
    assert len(left) == 1 and len(reader.filters) == 1


def test_quality(spark):
    draw = random.Random(6)
    good = lambda: " ".join(draw.choice(["the", "of", "reading", "station", "house,", "is."]) for _ in range(draw.randint(20, 90)))
    bad = lambda: " | ".join(draw.choice(["BUY!!", "menu", "login", "$$$"]) for _ in range(draw.randint(5, 60)))
    rows = [(k, good() if k % 3 else bad()) for k in range(500)] + [(900, None), (901, ""), (902, "x" * 300_000), (None, "of")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(400)] + [(900, None), (None, 1)], "doc_id long, quality int")
    out = quality.classify(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and (r.doc_id or 900) < 500]
    assert len(held) > 100 and sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.97 * len(held)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(docs.where("doc_id < 500"), labels)
    assert kept.columns == docs.columns and kept.where("doc_id % 3 = 0").count() < 10


def test_mixing(spark, docs, none):
    big = spark.createDataFrame([(k, "w " * (1 + k % 9), "en", f"src{k % 7}") for k in range(800)], "doc_id long, text string, lang string, source string")
    out = mixing.mix(big, mixing.domain_of(F.col("source")), weights={"domain": {"web": 1, "reference": 1, "forum": 2}}, percent=50, epochs=3)
    total = sum(1 + k % 9 for k in range(800))
    got = out.agg(F.sum("n_tokens")).first()[0]
    assert 0.5 * total - 200 <= got <= 0.5 * total
    assert out.groupBy("row.doc_id", "epoch").count().where("count > 1").count() == 0
    share = {r.domain: r.n for r in out.groupBy("domain").agg(F.sum("n_tokens").alias("n")).collect()}
    assert abs(share["forum"] - 2 * share["web"]) < 0.05 * total
    same(out.select("row.doc_id", "epoch"), [tuple(r) for r in mixing.mix(big.repartition(7), mixing.domain_of(F.col("source")), weights={"domain": {"web": 1, "reference": 1, "forum": 2}}, percent=50, epochs=3).select("row.doc_id", "epoch").collect()])
    assert mixing.mix(docs, F.lit(None), weights={}).count() > 0
    assert mixing.mix(none, F.lit(None), weights={}).count() == 0


def test_mixing_equal_rows_keep_the_budget(spark):
    """Copies of one row around the end of a prefix: as many as fit are taken, and the rows equal those of the SQL."""
    import duckdb

    weights = {"domain": {}, "lang": {}, "source": {}}
    two = spark.createDataFrame([(1, "w " * 10, "en", "src0")] * 2, "doc_id long, text string, lang string, source string")
    taken = mixing.mix(two, F.lit("web"), weights=weights, percent=50, epochs=1)
    assert taken.agg(F.sum("n_tokens")).first()[0] == 10
    draw = random.Random(8)
    rows = []
    for k in range(60):
        row = (k, " ".join("w" for _ in range(draw.choice([0, 1, 3, 40]))), draw.choice(["en", None, ""]), draw.choice(["src0", "src1", None]))
        rows += [row] * draw.choice([1, 1, 7])
    rows += [(None, "a b c", "en", "src0")] * 9 + [(None, None, None, None)] * 3
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, lang string, source string, order string, number int").repartition(3)
    got = mixing.mix(docs, mixing.domain_of(F.col("source")), **mixing.PRODUCTION).select("row.doc_id", "domain", "row.lang", "row.source", "n_tokens", F.col("epoch").cast("int").alias("epoch"))
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    same(got, con.execute(mixing.ORACLE_SQL).fetchall())
