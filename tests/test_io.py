"""Files in and out, and the streaming run."""

import os

import pytest
from pyspark.sql import functions as F

from priceframe.schema import COLUMNS, RAW_SCHEMA
from priceframe.sources import offers as io
from priceframe.sources.store import Commit, Store
from priceframe.streaming import incremental
from test_core import table


def write_csv(path, *rows):
    lines = [",".join(COLUMNS)] + [",".join('"' + r.get(x, "").replace('"', '""') + '"' for x in COLUMNS) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def test_scan_and_archive(spark, tmp_path):
    write_csv(tmp_path / "aws.csv", {"source": "aws", "snapshot_date": "2026-01-01", "raw_extra": '{"k":"a, b"}'})
    write_csv(tmp_path / "_master.csv", {"source": "no"})
    rows = io.scan_sources(spark, str(tmp_path)).collect()
    assert [(r.source, r.raw_extra, r.gpu_name, r.stem) for r in rows] == [("aws", '{"k":"a, b"}', "", "aws")]
    io.write_archives(table(spark, {"snapshot_date": "2025-03-04", "source": "a"}, {"snapshot_date": "bad", "source": "b"}), str(tmp_path / "old"))
    assert sorted(p.name for p in (tmp_path / "old").iterdir() if p.is_dir()) == ["month=2025-03", "month=unknown"]


def published(spark, folder, table, *names):
    store = Store(spark, str(folder))
    return sorted(tuple(str(r[x]) for x in names) for r in store.read(table, RAW_SCHEMA).collect())


def test_streaming_replaces_only_affected_dates(spark, tmp_path):
    landed = tmp_path / "in"
    landed.mkdir()
    args = [str(tmp_path / x) for x in ("in", "store", "check")]
    base = {"provider": "p", "instance_type": "i", "gpu_name": "H100", "pricing_type": "on_demand"}
    write_csv(
        landed / "a.csv",
        {**base, "source": "skypilot", "snapshot_date": "2026-01-02", "price_per_hour": "2"},
        {**base, "source": "skypilot", "snapshot_date": "2026-01-03", "price_per_hour": "2"},
        {**base, "source": "skypilot", "snapshot_date": "2025-11-01", "price_per_hour": "3"},
        {**base, "source": "tokens", "snapshot_date": "2026-01-03", "pricing_type": "inference", "instance_type": "m"},
        {},
    )
    incremental.run(spark, *args, "2025-10-01")
    out = tmp_path / "store"
    assert published(spark, out, "master", "snapshot_date") == [("2025-11-01",), ("2026-01-02",), ("2026-01-03",)]
    assert published(spark, out, "inference", "source") == [("tokens",)]
    first = Store(spark, str(out)).manifest()
    # A late row, a better source for one date, and a later cutoff under which an old date expires.
    write_csv(landed / "b.csv", {**base, "source": "aws", "snapshot_date": "2026-01-03", "price_per_hour": "1"}, {**base, "source": "aws", "snapshot_date": "2020-01-01"})
    incremental.run(spark, *args, "2025-12-01")
    assert published(spark, out, "master", "snapshot_date", "source") == [("2026-01-02", "skypilot"), ("2026-01-03", "aws")]
    second = Store(spark, str(out)).manifest()
    assert second.keys("history") == {"2026-01-02", "2026-01-03"} and second.keys("archive") == {"2020-01", "2025-11"} and second.notes["archived"] == "2"
    # the date that no row came for was neither read nor written again
    assert second.tables["master"]["snapshot_date=2026-01-02"] == first.tables["master"]["snapshot_date=2026-01-02"] == 1
    # readers of the first version still have it
    assert len(Store(spark, str(out)).read("master", RAW_SCHEMA, at=first).collect()) == 3


def rows_in(spark, *rows):
    return table(spark, *rows).coalesce(1).withColumn("row_seq", F.format_string("%05d", F.monotonically_increasing_id()))


BASE = {"provider": "p", "instance_type": "i", "gpu_name": "GTX 1070 Ti", "pricing_type": "on_demand", "source": "akash"}


def test_incremental_applies_new_rules_drops_emptied_dates_and_keeps_file_order(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "store")
    good, bad = {**BASE, "snapshot_date": "2026-01-01", "price_per_gpu_hour": "2"}, {**BASE, "snapshot_date": "2026-01-02", "price_per_gpu_hour": "99"}
    # Rows stored and published before a rule existed.
    with monkeypatch.context() as before:
        before.setattr(incremental.quality, "keep_existing", lambda: F.lit(True))
        incremental.take_in(spark, rows_in(spark, good, bad), 0, out, "2025-01-01")
    assert Store(spark, out).manifest().keys("master") == {"2026-01-01", "2026-01-02"}
    # Of two rows of a lower source with the same key the first in the file stays.
    two = [{**BASE, "source": s, "snapshot_date": "2026-01-03", "instance_type": i, "gpu_name": "", "pricing_type": "Inference", "price_per_hour": p} for s, i, p in (("akash", "a", "1"), ("zzz", "b", "9"), ("zzz", "b", "1"))]
    for _ in range(2):  # a repeated batch changes nothing
        incremental.take_in(spark, rows_in(spark, *two), 1, out, "2025-01-01")
    assert published(spark, out, "master", "snapshot_date", "price_per_gpu_hour") == [("2026-01-01", "2")]
    assert published(spark, out, "inference", "source", "price_per_hour") == [("akash", "1"), ("zzz", "9")]
    assert published(spark, out, "history", "snapshot_date") == [("2026-01-01",), *[("2026-01-03",)] * 3]
    store = Store(spark, out)
    assert store.manifest().version == 2
    counts = {(r.source, r.snapshot_date): (r.n_rows, r.rejected) for r in incremental.baseline(store, store.manifest()).collect()}
    assert counts == {("akash", "2026-01-01"): (1, 0), ("akash", "2026-01-02"): (0, 1), ("akash", "2026-01-03"): (1, 0), ("zzz", "2026-01-03"): (2, 0)}


def test_a_killed_run_leaves_the_version_before_it(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "store")
    both = [{**BASE, "source": "skypilot", "snapshot_date": "2026-01-01", "price_per_hour": "1"}, {**BASE, "source": "skypilot", "snapshot_date": "2026-01-01", "pricing_type": "inference", "instance_type": "m", "price_per_hour": "1"}]
    incremental.take_in(spark, rows_in(spark, *both), 0, out, "2025-01-01")
    before = published(spark, out, "master", *COLUMNS), published(spark, out, "inference", *COLUMNS)
    new = [{**r, "source": "aws", "price_per_hour": "7"} for r in both]
    replace = Commit.replace

    def dies(self, name, *rest, **more):
        if name == "inference":
            raise RuntimeError("killed between the tables")
        return replace(self, name, *rest, **more)

    with monkeypatch.context() as broken:
        broken.setattr(Commit, "replace", dies)
        with pytest.raises(RuntimeError, match="killed"):
            incremental.take_in(spark, rows_in(spark, *new), 1, out, "2025-01-01")
    assert (tmp_path / "store/master/v=2").is_dir()
    assert (published(spark, out, "master", *COLUMNS), published(spark, out, "inference", *COLUMNS)) == before
    incremental.take_in(spark, rows_in(spark, *new), 1, out, "2025-01-01")  # the batch comes again
    assert published(spark, out, "master", "source") == published(spark, out, "inference", "source") == [("aws",)]


def test_commits_conflict_and_vacuum(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    df = spark.createDataFrame([("a", "x/y"), ("b", None), ("c", "z")], "v1 string, k string")
    schema = df.schema
    assert store.read("t", schema).count() == 0 and store.manifest().version == 0
    one, other = store.begin(), store.begin()
    assert one.replace("t", df, "k") == {"x/y", "", "z"}
    other.replace("u", df, "k")
    one.finish(who="one")
    with pytest.raises(FileExistsError):
        other.finish()
    two = store.begin()
    two.replace("t", df.where("v1 = 'a'").withColumn("v1", F.lit("A")), "k", ["x/y", "z"])
    two.finish()
    rows = lambda **k: sorted((r.v1, r.k) for r in store.read("t", schema, **k).collect())
    assert rows() == [("A", "x/y"), ("b", "")] and rows(keys=["x/y"]) == [("A", "x/y")] and rows(at=store.manifest(1)) == [("a", "x/y"), ("b", ""), ("c", "z")]
    store.vacuum(keep=1)
    assert rows() == [("A", "x/y"), ("b", "")] and not (tmp_path / "store/u").joinpath("v=1").exists()
    assert sorted(p.name for p in (tmp_path / "store/t/v=1").iterdir() if "=" in p.name) == ["k=__HIVE_DEFAULT_PARTITION__"]
    gone = store.begin()
    assert gone.replace("t", df.limit(0), "k", ["x/y"]) == set()
    gone.finish()
    assert rows() == [("b", "")] and store.manifest().notes == {"who": "one"}


def test_baseline_refuses_missing_and_shrunken_history(spark, tmp_path):
    out = str(tmp_path / "store")
    rows = [{**BASE, "source": s, "snapshot_date": d, "instance_type": f"i{k}"} for s in ("akash", "aws") for d in ("2026-01-01", "2026-03-30") for k in range(3)]
    more = [{**BASE, "snapshot_date": "2026-03-30", "instance_type": "new"}]
    with pytest.raises(ValueError, match="too few rows"):
        incremental.take_in(spark, rows_in(spark, *rows), 0, out, "2025-01-01", min_sources=2, min_rows=13, min_days=80)
    assert Store(spark, out).manifest().version == 0
    floors = {"min_sources": 2, "min_rows": 12, "min_days": 80}
    incremental.take_in(spark, rows_in(spark, *rows), 0, out, "2025-01-01", **floors)
    store = Store(spark, out)
    good = store.manifest()
    # a file of history is lost: the dates that are read must have the rows they had
    lost = sorted((tmp_path / "store/history/v=1/snapshot_date=2026-03-30").glob("part-*"))[0]
    kept = lost.read_bytes()
    lost.unlink()
    with pytest.raises(ValueError, match="not what its baseline tells"):
        incremental.take_in(spark, rows_in(spark, *more), 1, out, "2025-01-01", **floors)
    lost.write_bytes(kept)
    (lost.parent / f".{lost.name}.crc").unlink(missing_ok=True)
    # the baseline is missing
    bare = store.begin()
    bare.drop("baseline", ["all"])
    bare.finish()
    with pytest.raises(ValueError, match="no baseline"):
        incremental.take_in(spark, rows_in(spark, *more), 1, out, "2025-01-01")
    assert good.keys("history") == store.manifest().keys("history")
    back = store.begin(store.manifest())
    back.tables = dict(good.tables)
    back.finish()
    incremental.take_in(spark, rows_in(spark, *more), 1, out, "2025-01-01", **floors)
    assert sum(r.n_rows for r in incremental.baseline(store, store.manifest()).collect()) == 13


def test_archives_merge_by_month(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    tail = '{"note":"two\nlines, \\"quoted\\""}'
    row = lambda day, k, **more: {**BASE, "snapshot_date": day, "instance_type": f"i{k}", "raw_extra": tail, **more}
    one = store.begin()
    assert io.merge_archives(one, table(spark, row("2025-03-04", 1), row("2025-03-04", 1), row("2025-04-01", 2), row("bad", 3))) == {"2025-03": 1, "2025-04": 1, "unknown": 1}
    one.finish()
    two = store.begin()
    assert io.merge_archives(two, table(spark, row("2025-03-04", 1), row("2025-03-09", 4, os=" x ", tenancy="\\\\"))) == {"2025-03": 2}
    assert io.merge_archives(two, table(spark, row("2025-03-04", 1)).limit(0)) == {}
    two.finish()
    three = store.begin()
    assert io.merge_archives(three, table(spark, row("2025-03-09", 4, os=" x ", tenancy="\\\\"))) == {"2025-03": 2}
    three.finish()
    got = store.read("archive", io.ARCHIVE, kind="csv").collect()
    assert sorted((r.month, r.snapshot_date, r.instance_type) for r in got) == [("2025-03", "2025-03-04", "i1"), ("2025-03", "2025-03-09", "i4"), ("2025-04", "2025-04-01", "i2"), ("unknown", "bad", "i3")]
    assert {r.raw_extra for r in got} == {tail} and store.manifest().tables["archive"]["month=2025-04"] == 1


def test_scan_sources_with_line_ends_and_other_headers(spark, tmp_path):
    write_csv(tmp_path / "aws.csv", *[{"source": "aws", "snapshot_date": f"2026-01-{k % 28 + 1:02d}", "raw_extra": f'{{"k":"a,\n""{k}"}}', "instance_type": str(k)} for k in range(300)])
    (tmp_path / "old.csv").write_text('"provider","source","unknown"\n"p","old","x"\n\n')
    rows = io.scan_sources(spark, str(tmp_path)).collect()
    own = sorted((r.row_seq, int(r.instance_type), r.raw_extra) for r in rows if r.source == "aws")
    assert [x[1] for x in own] == list(range(300)) and own[7][2] == '{"k":"a,\n""7"}'
    assert [(r.provider, r.snapshot_date, r.stem) for r in rows if r.source == "old"] == [("p", "", "old")]
    assert io.scan_sources(spark, str(tmp_path), "2026-01-03").count() == 11


def test_append_and_master_order(spark, tmp_path):
    offers = table(spark, *[{"snapshot_date": f"2026-01-0{1 + k % 3}", "provider": f"p{k % 4}", "gpu_name": "H100" if k else "", "source": "a"} for k in range(12)])
    io.append_offers(offers, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 11
    parts = io.sorted_table(offers, io.MASTER_ORDER).rdd.glom().collect()
    rows = [(r.snapshot_date, r.provider) for part in parts for r in part]
    assert rows == sorted(rows)


def test_a_batch_shuffles_no_whole_rows_and_leaves_only_the_store(spark, tmp_path):
    """Batches of two dates and an expired one: nothing that the batch wrote for itself is left in the checkpoint folder but small tables."""
    rows = [{**BASE, "source": s, "snapshot_date": d, "instance_type": f"i{k}"} for s in ("akash", "aws") for d in ("2026-01-01", "2026-03-30", "2024-01-01") for k in range(3)]
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(shared))
    for number in range(2):
        incremental.take_in(spark, rows_in(spark, *rows), number, str(tmp_path / "store"), "2025-01-01")
    left = {x.partition("-")[0].partition("_")[0] for x in set(os.listdir(shared)) - before if any(f.endswith(".parquet") for f in os.listdir(f"{shared}/{x}"))}
    assert not left & {"new", "every", "slice", "ranked", "placed", "kept", "master", "inference", "expired", "archive"}
    assert len(published(spark, tmp_path / "store", "history", "snapshot_date")) == 12
