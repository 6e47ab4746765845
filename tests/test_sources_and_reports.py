import bz2
import csv
import datetime
import gzip
import hashlib
import io
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfsight.operators import profile, report
from shelfsight.session import shared_dir, stage
from shelfsight.sources import files, records
from shelfsight.sources.adapters import Tables


def test_csv_encodings_and_missing_tokens(spark, tmp_path):
    (tmp_path / "utf.csv").write_bytes("﻿Name,Note\ncafé,NA\nx,\n".encode())
    (tmp_path / "latin.csv").write_bytes("Name,Note\ncafé,n/a\n".encode("latin-1"))
    assert rows(files.read_csv_resilient(spark, str(tmp_path / "utf.csv"))) == [("café", None), ("x", None)]
    assert files.read_csv_resilient(spark, str(tmp_path / "utf.csv")).columns == ["Name", "Note"]
    assert rows(files.read_csv_resilient(spark, str(tmp_path / "latin.csv"))) == [("café", None)]


def test_ingest_writes_once_and_falls_back(spark, tmp_path):
    (tmp_path / "utf.csv").write_text("Store ID,Qty\na,1\nb,NA\n")
    (tmp_path / "latin.csv").write_bytes("Store ID,Qty\ncafé,1\n".encode("latin-1"))
    out = str(tmp_path / "out")
    assert files.ingest_csv(spark, str(tmp_path / "utf.csv"), out) == (["Store ID", "Qty"], ["outlet_id", "volume_liters"], 2)
    assert rows(spark.read.parquet(out), "outlet_id", "volume_liters", "_src_row") == [("a", "1", 1), ("b", None, 2)]
    files.ingest_csv(spark, str(tmp_path / "latin.csv"), out)
    assert rows(spark.read.parquet(out), "outlet_id") == [("café",)]


def test_ingest_order_is_file_order(spark, tmp_path):
    for f in range(3):
        (tmp_path / f"part-{f}.csv").write_text("v\n" + "".join(f"{f * 1000 + i}\n" for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        df = files.read_csv_resilient(spark, str(tmp_path), with_source=True)
        got = [int(r.v) for r in df.orderBy(*files.INGEST_ORDER).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(got) and len(got) == 1500


def test_records_are_cut_as_a_serial_reader_cuts_them(spark, tmp_path):
    """Random files of small splits, with line breaks, doubled, stray and closing quotes, against the reader of the standard library."""
    r = random.Random(8)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        for round_ in range(2):
            folder, want, surplus = tmp_path / f"r{round_}", [], []
            folder.mkdir()
            for name in ("a", "b", "c"):
                text = "x,y,z\n"
                for _ in range(r.randrange(40)):
                    fields = []
                    for _ in range(r.choice([3, 3, 3, 2, 4])):
                        inner = "".join(r.choice('ab, ""\n"é') for _ in range(r.randrange(12)))
                        plain = re.sub('[,"\n]', "", inner)
                        fields.append(r.choice(['"' + inner.replace('"', '""') + '"', plain, plain, "q" + plain + '"' if plain else ""]))
                    text += ",".join(fields) + r.choice(["\n", "\r\n", "\n\n"])
                encoding = r.choice(["utf-8", "latin-1"])
                (folder / f"{name}.csv").write_bytes(text.encode(encoding))
                for row in list(csv.reader(io.StringIO(text, newline="")))[1:]:
                    if row:
                        (want if len(row) <= 3 else surplus).append(tuple((v or None) for v in [*row, None, None][:3]) if len(row) <= 3 else tuple(row))
            found, more = files.read_csv_with_surplus(spark, str(folder))
            assert [tuple(x) for x in found.orderBy(*files.INGEST_ORDER).select("x", "y", "z").collect()] == want
            got = [tuple(next(csv.reader(io.StringIO(x.record, newline="")))) for x in more.orderBy(*files.INGEST_ORDER).collect()]
            assert got == surplus
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_over_many_splits_and_loud_ends(spark, tmp_path):
    def put(text, name="a.csv"):
        (tmp_path / name).write_bytes(text if isinstance(text, bytes) else text.encode())
        return str(tmp_path / name)

    long = "first\n" + "middle line\n" * 40 + "last"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        path = put(f'k,v\n1,"{long}"\n2,x\n3,"{long}\n"\n4,\n')
        assert rows(files.read_csv_resilient(spark, path)) == [("1", long), ("2", "x"), ("3", long + "\n"), ("4", None)]
        with pytest.raises(ValueError, match="4[23] lines"):
            records.read_records(spark, path, most_lines=20)
        with pytest.raises(Exception, match="never closed"):
            files.read_csv_resilient(spark, put('k,v\n1,"open\n' + "2,x\n" * 50))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    surplus = files.read_csv_resilient(spark, put("k,v\n1,2,3\n4,5\n"))
    with pytest.raises(Exception, match="more fields than the header: 1,2,3"):
        surplus.select("k").collect()
    with pytest.raises(ValueError, match="no header"):
        files.read_csv_resilient(spark, put("\n\n"))
    put("k,v\n1,2\n", "b.csv"), put("v,k\n1,2\n", "c.csv")
    with pytest.raises(ValueError, match="different headers"):
        files.read_csv_resilient(spark, str(tmp_path))
    found = files.read_csv_resilient(spark, put('\ufeff"a\nb",a,,a\n"x""y",\t2, 3,"4"\n'))
    assert found.columns == ["a\nb", "a", "Unnamed: 2", "a.1"] and rows(found) == [('x"y', "\t2", " 3", "4")]


def test_surplus_fields_go_to_the_quarantine(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Store ID,Qty\na,1\nb,2,3,\nc\n")
    out, pen = str(tmp_path / "out"), str(tmp_path / "pen")
    with pytest.raises(ValueError, match="1 records"):
        files.ingest_csv(spark, str(tmp_path / "x.csv"), out)
    assert files.ingest_csv(spark, str(tmp_path / "x.csv"), out, pen, "stores", "r1")[2] == 2
    assert rows(spark.read.parquet(out), "outlet_id", "volume_liters") == [("a", "1"), ("c", None)]
    held = files.read_quarantine(spark, pen)
    assert rows(held, "record", "failure_reason", "_dataset", "_run_id") == [("b,2,3,", "surplus_fields", "stores", "r1")]


def test_canonical_names():
    assert files.canonical_names(["Store ID", " Txn-Date", "Odd Name!"]) == ["outlet_id", "date", "odd_name"]
    with pytest.raises(ValueError):
        files.canonical_names(["qty", "volume"])


def test_optional_tables_and_hashes(spark, tmp_path):
    assert files.read_or_empty(spark, str(tmp_path / "nope"), "a int").count() == 0
    (tmp_path / "x.bin").write_bytes(b"abc")
    h = files.file_hashes(spark, str(tmp_path / "x.bin")).first()
    assert h.sha256 == hashlib.sha256(b"abc").hexdigest() and h.bytes == 3


def test_file_hashes_hold_no_file_as_one_value(spark, tmp_path):
    noise = random.Random(5).randbytes(200_000)
    contents = {
        "noise.bin": noise, "ends.bin": noise + b"\n", "crlf.csv": b"\xef\xbb\xbfa,b\r\n1,2\r\n", "mark.csv": b"\xef\xbb\xbfx", "packed.gz": gzip.compress(noise),
        "packed.csv.bz2": bz2.compress(noise), "bare": noise, "feeds": b"\n" * 70_000, "only_mark": b"\xef\xbb\xbf", "zeros.x": bytes(50_000), "two words.parquet": noise[:70_000],
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.binaryFile.maxLength", "spark.sql.files.maxPartitionBytes")}
    try:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        got = {r.path.split("/")[-1]: (r.bytes, r.sha256) for r in files.file_hashes(spark, str(tmp_path)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}


def test_quarantine_keeps_earlier_runs(spark, frame, tmp_path):
    path = str(tmp_path / "q")
    files.append_quarantine(frame("a int, _dataset string", (1, "x")), path, "r1")
    files.append_quarantine(frame("b int, _dataset string", (2, "y")), path, "r2")
    assert rows(files.read_quarantine(spark, path), "a", "b", "_dataset", "_run_id") == [(None, 2, "y", "r2"), (1, None, "x", "r1")]


def test_stage_uses_the_shared_folder(spark, frame):
    staged = stage(frame("a int", (1,)), "t")
    assert rows(staged) == [(1,)]
    assert shared_dir(spark) in staged.inputFiles()[0]


MASTER = (
    "outlet_id string, province string, distributor_id string, outlet_type string, outlet_size string, months_observed int, "
    "months_constrained int, hist_total_median double, peer_ceiling double, constraint_uplift double, "
    "seasonality_jan_index double, spatial_multiplier double, mult_potential double, Trade_Spend_Allocation_LKR double, "
    "expected_incremental_liters double"
)


@pytest.fixture
def master(frame):
    return frame(
        MASTER,
        ("OUT_1", "Western", "d1", "Grocery", "Small", 4, 1, 50.0, 100.0, 1.2, 1.0, 0.9, 108.0, 15000.0, 3.0),
        ("out_2", "Western", "d2", "Kiosk", None, 0, 0, 0.0, 100.0, 1.0, 1.0, 1.1, 200.0, 0.0, 0.0),
        ("OUT_3", None, None, "Kiosk", None, None, None, None, 100.0, 1.0, None, 1.0, 50.0, None, None),
    )


def test_filters(master):
    def ids(**kw):
        return [r[0] for r in rows(master.where(report.selection(**kw)), "outlet_id")]

    assert ids() == ["OUT_1", "OUT_3", "out_2"]
    assert ids(provinces=["Western"]) == ["OUT_1", "out_2"]
    assert ids(types=["Kiosk"], id_pattern="OUT_[23]") == ["OUT_3", "out_2"]
    assert rows(report.options(master, "distributor_id")) == [("d1",), ("d2",)]


def test_key_figures_and_histogram(master):
    k = report.key_figures(master).first()
    assert (k.outlets, k.median_potential, k.total_potential, k.median_ratio_to_normal) == (3, 108.0, 358.0, 2.16)
    h = report.histogram(master, F.col("mult_potential"))
    assert rows(h) == [(105.0, 110.0, 1), (200.0, 205.0, 1), (50.0, 55.0, 1)]
    assert rows(report.histogram(master.limit(1), F.lit(7.0))) == [(7.0, 8.0, 1)]


def test_tables(master):
    labels = [r["Allocation (LKR)"] for r in report.outlet_table(master).collect()]
    assert labels == ["0 — not selected", "LKR 15,000", "N/A (non-Western)"]
    assert rows(report.by_province(master)) == [("Western", 2, 154.0, 308.0)]
    assert rows(report.guardrail(master), "outlet_id", "guardrail") == [("OUT_1", "none"), ("OUT_3", "none"), ("out_2", "floor")]
    assert rows(report.spatial_direction(master), "direction") == [("discount",), ("lift",), ("neutral",)]
    assert rows(report.funded(master), "outlet_id") == [("OUT_1",)]
    steps = report.waterfall(master.where("outlet_id = 'OUT_1'")).collect()
    assert [round(s.value, 6) for s in steps] == [100.0, 120.0, 120.0, 108.0, 108.0]
    assert steps[1].note == "factor 1.200: 1 of 4 months"


def test_explanation(master):
    text = {r.outlet_id: r.explanation for r in report.explanation(master).collect()}
    assert "held back in 25 % of its months, which counts as a factor of 1.200." in text["OUT_1"]
    assert "A promotion of 15,000 LKR should add 3 l." in text["OUT_1"] and "No promotion is planned." in text["out_2"]
    assert "in unknown is served by" in text["OUT_3"] and "the usual unknown l" in text["OUT_3"]


def test_profiles(frame):
    df = frame("a int, b string, latitude double, longitude double", (1, None, 7.0, 80.0), (None, None, 0.0, 80.0), (3, "x", None, 80.0))
    assert rows(profile.null_fractions(df, top=1)) == [("b", pytest.approx(2 / 3))]
    assert profile.out_of_bounds(df).first()[0] == 2
    assert rows(profile.value_counts(df, "b")) == [(None, 2), ("x", 1)]
    assert rows(profile.dataset_sizes({"t": df})) == [("t", 3, 4)]
    d = profile.describe(df, ["a"], [0.5]).first()
    assert (d.n, d.mean, d.p50, d.max) == (2, 2.0, 2.0, 3.0)
    dates = frame("d string", ("2024-01-05",), ("bad",), ("2023/12/31",))
    assert [str(x)[:10] for x in profile.date_range(dates, "d").first()] == ["2023-12-31", "2024-01-05"]
    months = frame("outlet_id string, volume_total double, volume_total_deflated double", ("a", 1.0, 1.0), ("a", 3.0, 3.0), ("b", 5.0, 5.0))
    assert profile.median_variation(months).first().median_cv_raw == pytest.approx(2**0.5 / 2)


def test_season_labels_join_the_lines_once(spark, frame, tmp_path):
    orders = frame("o_orderkey long, o_orderdate timestamp_ntz", (1, datetime.datetime(1998, 1, 5)), (2, datetime.datetime(1998, 2, 5)), (3, None))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    frame("l_orderkey long, l_suppkey long", (1, 10), (1, 20), (1, 3), (2, 3), (3, 3), (9, 1)).write.parquet(str(tmp_path / "lineitem.parquet"))
    t = Tables(spark, str(tmp_path))
    for df in (t.seasonality, t.seasonality_raw):
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert rows(t.seasonality, "year", "month") == [(None, None), (2022, 1), (2022, 1), (2022, 2)]
    assert [r[2:] for r in rows(t.seasonality_raw, "year", "month", "src_copy")].count((0,)) == 4
