"""Bulk price files: splits inside quotes, gzip, headers found behind the preamble, offers."""

import csv
import gzip
import io
import json
import random

from priceframe.sources import adapters, bulk

HEADER = "SKU,OfferTermCode,RateCode,TermType,PriceDescription,EffectiveDate,Unit,PricePerUnit,Product Family,Region Code,Location,Instance Type,LeaseContractLength,PurchaseOption,OfferingClass,Operating System,Tenancy,Pre Installed S/W,vCPU,Memory,Storage,Network Performance,GPU,CapacityStatus".split(",")


def text_of(header, rows, end="\r\n") -> str:
    out = io.StringIO()
    write = csv.writer(out, lineterminator=end)
    for k in range(5):
        write.writerow([f"metadata-{k}", 'with "quotes"\nand a line end' if k == 2 else ""])
    write.writerow(header)
    write.writerows(rows)
    return out.getvalue()


def test_records_of_any_split(spark, tmp_path):
    draw = random.Random(3)
    header = [" k ", "name", *[f"c{k}" for k in range(200)]]
    cell = lambda: "".join(draw.choice(['"', "\n", ",", "é", "abc", " ", "\r\n"]) for _ in range(draw.randint(0, 8)))
    rows = [[str(k), cell(), *[cell() for _ in range(draw.choice([0, 3, 200]))]] for k in range(120)]
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n")):
        (tmp_path / name).write_bytes(text_of(header, rows, end).encode())
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(text_of(header[::-1], [r[::-1] for r in rows if len(r) == 202]).encode()) + gzip.compress(b""))
    (tmp_path / "short.csv").write_text("a\nb\n")
    (tmp_path / "empty.csv").write_text("")
    want = {}
    for name in ("a.csv", "b.csv"):
        want[name] = sorted((r[0], r[1], r[101] if len(r) > 101 else "") for r in rows)
    want["c.csv.gz"] = sorted((r[0], r[1], r[101]) for r in rows if len(r) == 202)
    for size in (2000, 1 << 20):
        got = {}
        for r in bulk.read(spark, str(tmp_path), ["k", "name", "c99", "absent"], split_bytes=size).collect():
            assert r.absent is None
            got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.k, r.name, r.c99))
        assert {k: sorted(v) for k, v in got.items()} == want
    some = bulk.read(spark, str(tmp_path), ["k", "name"], naming=["abc", "é"], split_bytes=9000).collect()
    assert len({(r.file, r.at) for r in some}) == len(some) < 360


def offer(**values) -> list[str]:
    base = {"Product Family": "Compute Instance", "Region Code": "us-east-1", "Location": "US East", "Operating System": "Linux", "Tenancy": "Shared", "Unit": "Hrs", "CapacityStatus": "Used", "TermType": "OnDemand", "EffectiveDate": "2026-04-01"}
    return [{**base, **{k.replace("_", " "): v for k, v in values.items()}}.get(h, "") for h in HEADER]


def test_offers_of_bulk_files(spark, tmp_path):
    rows = [
        offer(Instance_Type="p5.48xlarge", PriceDescription="$5 per On Demand hour", PricePerUnit="55.165", GPU="8", Memory="2,048 GiB"),
        offer(Instance_Type="p5.48xlarge", PriceDescription="$0.125 per Capacity Block", PricePerUnit="0.125", GPU="8"),
        offer(Instance_Type="g5.12xlarge", TermType="Reserved", LeaseContractLength="1yr", PurchaseOption="Partial Upfront", PricePerUnit="1.25", GPU="4"),
        offer(Instance_Type="g5.12xlarge", TermType="Reserved", LeaseContractLength="1yr", PurchaseOption="Partial Upfront", PricePerUnit="5000", Unit="Quantity", GPU="4"),
        offer(Instance_Type="g5.48xlarge", TermType="Reserved", LeaseContractLength="3yr", PricePerUnit="12000", Unit="Quantity", GPU="eight"),
        offer(Instance_Type="dl2q.24xlarge", PricePerUnit="6", Region_Code=""),
        offer(Instance_Type="trn1.32xlarge", PriceDescription="Unused Reservation", PricePerUnit="3.2", OfferingClass="standard"),
        offer(Instance_Type="p5.48xlarge", PricePerUnit="-1", Tenancy="Host"), offer(Instance_Type="p5.48xlarge", PricePerUnit="free", Tenancy="Dedicated"), offer(Instance_Type="m5.large", PricePerUnit="1"),
        offer(Instance_Type="p5.48xlarge", PricePerUnit="1", Unit="GB"), offer(Instance_Type="p4d.24xlarge", PricePerUnit="1", Product_Family="Storage"), offer(Instance_Type="", PricePerUnit="1", PriceDescription="p5.48xlarge"),
    ]
    (tmp_path / "eu-west-1.csv").write_text(text_of(HEADER, rows))
    own = adapters.collect(adapters.bulk_files(spark, str(tmp_path), split_bytes=700), "bulk_prices").collect()
    got = {(r.instance_type, r.commitment_period): r for r in own}
    assert len(own) == len(got) == 6
    show = lambda r: (r.gpu_name, r.gpu_memory_gb, r.gpu_count, r.pricing_type, float(r.price_per_hour), float(r.price_per_gpu_hour), float(r.upfront_price), float(r.upfront_price_per_gpu))
    assert show(got["p5.48xlarge", ""]) == ("H100", "80", "8", "on_demand", 55.165, 6.895625, 0, 0)
    assert show(got["p5.48xlarge", "capacity_block"]) == ("H100", "80", "8", "reserved", 0.125, 0.015625, 0, 0)
    assert show(got["g5.12xlarge", "1yr"]) == ("A10G", "24", "4", "reserved", 1.25, 0.3125, 5000, 1250)
    assert show(got["g5.48xlarge", "3yr"]) == ("A10G", "24", "8", "reserved", 0, 0, 12000, 1500)
    assert show(got["dl2q.24xlarge", ""])[2:6] == ("0", "on_demand", 6, 6) and got["dl2q.24xlarge", ""].region == "eu-west-1"
    assert show(got["trn1.32xlarge", "capacity_reservation"]) == ("Trainium", "32", "16", "reserved", 3.2, 0.2, 0, 0)
    tail = json.loads(got["p5.48xlarge", "capacity_block"].raw_extra)
    assert tail == {"capacity_status": "Used", "billing_model": "capacity_block", "effective_date": "2026-04-01", "location": "US East", "purchase_option": "capacity_block", "offering_class": ""}
    assert got["p5.48xlarge", ""].ram_gb == "2048" and got["p5.48xlarge", ""].available == "true" and got["g5.12xlarge", "1yr"].instance_family == "g5"
