import datetime as dt
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality, series
from tickloom.plans import etl, exploring, training
from tickloom.sources import curated, delimited, fixedwidth, folder, landing, order, sinks


def _quote(symbol="77ZEDX3", day="20190312", opened="880", high="912", low="805", close="899", volume="2600", name="COMPANY"):
    """One record of the default layout, fields at their documented positions."""
    parts = ["01", day, symbol.ljust(14), name.ljust(32)]
    parts += [text.rjust(13, "0") for text in (opened, high, low, "0", "0", close, volume)]
    return "".join(parts).ljust(200)


QUOTE = _quote()


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


SAMPLES = {
    "a;b\n1;2\n": ";",
    "Date,Close\n2024-01-01,10.5\n": ",",
    "plain": ";",
    'a,b,c\n"x;y;z;;",1,2\n': ",",
    "day;close\n1;10,5\n2;11,25\n3;9\n": ";",
    "a,b;c\n1,2\n": ",",
    "\n \n": ";",
}


def test_separator_rule(spark):
    samples = spark.createDataFrame(list(SAMPLES.items()), "sample string, wanted string")
    voted = samples.select("wanted", folder.voted_separator(F.split("sample", "\n")).alias("found")).collect()
    assert [r["found"] for r in voted] == [r["wanted"] for r in voted]
    lines = samples.select("sample", F.explode(F.split("sample", "\n")).alias("line"))
    by_lines = {r["path"]: r["separator"] for r in folder.voted_separators(lines, "sample", "line").collect()}
    assert by_lines == {k: v for k, v in SAMPLES.items() if k.strip()}


def test_many_files_in_many_layouts_are_one_scan(spark, tmp_path):
    wanted = {}
    for i in range(300):
        kind = i % 40
        mark, names = ";,"[kind % 2], ["symbol", "date", f"x{kind // 2 % 5}", "close"]
        names = names[kind // 10 :] + names[: kind // 10]
        value = {"symbol": f"S{i}", "date": "2024-01-02", "close": f"{i}.5", f"x{kind // 2 % 5}": f'"a{mark}b"' if i % 3 else ""}
        rows = [mark.join(names), mark.join(value[n] for n in names)]
        _write(tmp_path / f"part {i:03d}.csv", "\r\n".join(rows) + "\r\n")
        wanted[f"S{i}"] = (f"{i}.5", f"a{mark}b" if i % 3 else None)
    scan = delimited.read_folder(spark, str(tmp_path))
    assert set(scan.table.columns) == {"symbol", "date", "close", *(f"x{k}" for k in range(5)), *order.ORDER}
    rows = scan.table.select("symbol", "close", F.coalesce(*(f"x{k}" for k in range(5))).alias("x"), "date").collect()
    assert {r["symbol"]: (r["close"], r["x"]) for r in rows} == wanted and {r["date"] for r in rows} == {"2024-01-02"}
    plan = scan.table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and plan.count("Union") == 0
    commas = scan.findings.where("check = 'separator'").count()
    assert commas == 150


def test_broken_bytes_and_marks_in_a_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfsymbol;close\nA;1\nB\xff\xfe;2\n")
    (tmp_path / "b.CSV").write_bytes("\n\nSymbol,close,\n".encode() + b"Z\xc3;x,3,4\n" + "Ç,4,5\nSymbol,close,\n".encode())
    scan = delimited.read_folder(spark, str(tmp_path))
    assert scan.table.columns[:3] == ["symbol", "close", "_c2"]
    assert sorted((r[0], r[1], r[2]) for r in scan.table.collect()) == [("A", "1", None), ("B\ufffd\ufffd", "2", None), ("Z\ufffd;x", "3", "4"), ("Ç", "4", "5")]
    found = {os.path.basename(r["symbol"]): (r["observed"], r["message"].split("block ")[1]) for r in scan.findings.where("check = 'broken_bytes'").collect()}
    assert found == {"a.csv": (1, "at byte 0, line 3"), "b.CSV": (1, "at byte 0, line 4")}


def test_fixed_width_records(spark, tmp_path):
    text = "00HEADER 20250731\n" + QUOTE + "\n" + QUOTE[:100] + "\n" + _quote("77ZEDX4", name="AÇÃO É") + "\n"
    path = _write(tmp_path / "sample.txt", text, "latin-1")
    rows = fixedwidth.read_quotes(spark, path).orderBy("symbol").collect()
    assert [r["symbol"] for r in rows] == ["77ZEDX3", "77ZEDX4"]
    for row in rows:
        assert [row[c] for c in ("trade_date", "open", "high", "low", "close", "volume")] == ["2019-03-12", "8.80", "9.12", "8.05", "8.99", "2600"]


def test_bad_fixed_width_fields_are_reported(spark, tmp_path):
    path = _write(tmp_path / "bad.txt", _quote(opened="88x0") + "\n" + _quote(day="20191399") + "\n")
    quotes = fixedwidth.read_quotes(spark, path)
    assert {(r["open"], r["trade_date"]) for r in quotes.collect()} == {(None, "2019-03-12"), ("8.80", None)}
    assert [(r["symbol"], r["observed"]) for r in fixedwidth.unreadable(quotes).collect()] == [("77ZEDX3", 2)]


def test_folder_with_two_layouts_and_text_files(spark, tmp_path):
    _write(tmp_path / "a.csv", "symbol;trade_date;open;high;low;close;volume\nA;202507;1;1;1;1;10\n")
    _write(tmp_path / "b.csv", "trade_date,symbol,close\n2025-07-02,B,2\n")
    _write(tmp_path / "c.txt", QUOTE + "\n", "latin-1")
    _write(tmp_path / "blank.csv", "\n")
    _write(tmp_path / "note.md", "not a price file")
    scan = delimited.read_folder(spark, str(tmp_path))
    rows = {r["symbol"]: r for r in scan.table.collect()}
    assert set(rows) == {"A", "B", "77ZEDX3"} and rows["B"]["close"] == "2" and rows["B"]["open"] is None
    found = {(os.path.basename(r["symbol"]), r["check"]) for r in scan.findings.collect()}
    assert found == {("b.csv", "separator"), ("blank.csv", "skipped_file")}
    from tickloom.functions.dates import padded_date

    days = [r[0] for r in scan.table.where("symbol != '77ZEDX3'").select(F.min(padded_date(F.col("trade_date")))).collect()]
    assert days == [dt.date(2025, 7, 1)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.csv", "b.csv", "blank.csv", "c.txt", "note.md"]


def test_folder_without_price_files(spark, tmp_path):
    _write(tmp_path / "empty.csv", "")
    with pytest.raises(delimited.NoInput):
        delimited.read_folder(spark, str(tmp_path), tolerant=True)


def test_input_order_follows_file_names_not_sizes(spark, tmp_path):
    _write(tmp_path / "a.csv", "Date;Close\n2024-01-01;1\n")
    _write(tmp_path / "b.csv", "Date;Close\n" + "2024-01-02;7\n" * 5000 + "2024-01-01;2\n")
    table = delimited.read_folder(spark, str(tmp_path)).table
    rows = series.treat(table, order.ORDER).orderBy("date").collect()
    assert [r["close"] for r in rows] == [2.0, 7.0]


def test_latest_file(spark, tmp_path):
    for name, at in (("old.csv", 1000), ("new.csv", 2000), ("same.csv", 2000), ("newer.txt", 3000)):
        _write(tmp_path / name, "x")
        os.utime(tmp_path / name, (at, at))
    assert delimited.latest_file(spark, str(tmp_path)).endswith("same.csv")
    with pytest.raises(delimited.NoInput):
        delimited.latest_file(spark, str(tmp_path), ".json")


def test_byte_order_mark_and_lower_names(spark, tmp_path):
    path = _write(tmp_path / "bom.csv", "﻿ Date ;CLOSE\n2024-01-01;1\n")
    assert delimited.read_file(spark, path, lower_names=True).columns[:2] == ["date", "close"]


def test_upload_keeps_raw_lines_and_writes_a_display_copy(spark, tmp_path):
    path = _write(tmp_path / "up.csv", "Date,Close\n2024-01-01,10.5\n02/01/2024,11.25\n")
    made = etl.upload_series(spark, path, "PETR4.SA", str(tmp_path / "land"), str(tmp_path / "out"), "20240101000000")
    assert "separator" in {r["check"] for r in made.findings.collect()}
    shown = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "out/PETR4_SA_tratado_20240101000000.csv"))
    assert sorted(r["date"] for r in shown.collect()) == ["01/01/2024", "02/01/2024"]
    landed = spark.read.parquet(str(tmp_path / "land")).collect()
    assert [bytes(r["content"]) for r in landed] == [b"Date,Close\n2024-01-01,10.5\n02/01/2024,11.25\n"]
    assert {r["source_slug"] for r in landed} == {"PETR4_SA"}


def test_price_series_job_writes_named_files_and_publishes(spark, tmp_path):
    text = "Date;Close\n" + "".join(f"2024-01-{d:02d};{d},5\n" for d in range(1, 11)) + "2020-01-01;1\nbad;1\n"
    path = _write(tmp_path / "in.csv", text)
    job = etl.run_price_series_job(
        spark, path, "my series", str(tmp_path / "treated"), str(tmp_path / "out"), bucket_root=str(tmp_path / "bucket"), single_file=True
    )
    assert job.rows == 10 and job.key == "processed/my_series.parquet" and len(job.warnings) == 2
    lines = (tmp_path / "treated/my_series.csv").read_text().splitlines()
    assert lines[0] == "date;close" and lines[1] == "2024-01-01;1.5" and len(lines) == 11
    assert (tmp_path / "out/my_series.parquet").is_file()
    assert spark.read.parquet(str(tmp_path / "bucket/processed/my_series.parquet")).count() == 10
    assert job.to_frame(spark).collect()[0]["rows"] == 10
    wide = etl.run_price_series_job(spark, path, "dir", str(tmp_path / "t2"), str(tmp_path / "o2"), single_symbol=False, single_file=False)
    assert wide.rows == 10 and (tmp_path / "o2/dir.parquet").is_dir()
    assert {r["check"] for r in spark.read.parquet(str(tmp_path / "o2/dir_findings.parquet")).collect()} == {"dropped_rows", "small_series", "trimmed"}


def test_single_file_replaces_an_earlier_one(spark, tmp_path):
    target = str(tmp_path / "x.csv")
    for n in (2, 5):
        sinks.write_single(spark.range(n), target, "csv")
        assert len((tmp_path / "x.csv").read_text().splitlines()) == n + 1
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["x.csv"]


def test_headers_longer_than_the_sample_are_told_apart(spark, tmp_path):
    wide = ";".join(f"column_{i:04d}" for i in range(500))
    _write(tmp_path / "a.csv", f"symbol;{wide};close\n" + ";".join(["A", *["0"] * 500, "1"]) + "\n")
    _write(tmp_path / "b.csv", f"symbol;{wide};open\n" + ";".join(["B", *["0"] * 500, "2"]) + "\n")
    rows = {r["symbol"]: (r["close"], r["open"]) for r in delimited.read_folder(spark, str(tmp_path)).table.select("symbol", "close", "open").collect()}
    assert rows == {"A": ("1", None), "B": (None, "2")}


def test_stock_job_and_exploration(spark, tmp_path):
    body = "".join(f"{s};2024-01-{d:02d};{d};{d + 1};{d};{d},;{d * 10}\n".replace(",;", ";") for s in ("A", "B") for d in range(1, 9))
    path = _write(tmp_path / "stock.csv", "symbol;trade_date;open;high;low;close;volume\n" + body)
    job = etl.run_stock_job(spark, path, str(tmp_path / "curated"))
    assert job.rows == 16 and (tmp_path / "curated/symbol=A").is_dir()
    table = curated.read_curated(spark, str(tmp_path / "curated"), ordered=True)
    first = table.collect()[0]
    assert (first["symbol"], first["trade_date_fmt"]) == ("A", dt.date(2024, 1, 1))
    etl.run_stock_job(spark, path, str(tmp_path / "buckets"), buckets=4)
    own = curated.of_symbols(curated.read_curated(spark, str(tmp_path / "buckets")), ["B"], 4)
    assert own.count() == 8 and {r["symbol"] for r in own.collect()} == {"B"}
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "symbol_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    made = exploring.explore(spark, str(tmp_path / "curated"), str(tmp_path / "eda"))
    counts = spark.read.option("header", True).csv(made["symbol_counts"]).collect()
    assert [(r["symbol"], r["count"]) for r in counts] == [("A", "8"), ("B", "8")]
    assert spark.read.option("header", True).csv(made["correlations"]).count() == 36


def test_training_on_a_folder(spark, tmp_path):
    (tmp_path / "train").mkdir()
    header = "symbol;trade_date;open;high;low;close;volume\n"
    day = lambda i: (dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat()
    row = lambda s, i: f"{s};{day(i)};{i + 1}.0;{i + 2}.0;{i}.0;{i + 1}.5;{100 + i % 7}\n"
    _write(tmp_path / "train/one.csv", header + "".join(row("BIG", i) for i in range(40)) + "".join(row("SMALL", i) for i in range(9)))
    _write(tmp_path / "train/two.csv", header.replace(";", ",") + "".join(row("BIG", i) for i in range(40, 60)).replace(";", ","))
    test = _write(tmp_path / "test.csv", header + "".join(row("BIG", i) for i in range(60, 75)))
    made = training.run_training(spark, str(tmp_path / "train"), test, str(tmp_path / "out"))
    assert made.symbol == "BIG" and made.best == "linear_regression"
    assert (made.train_rows, made.validation_rows) == (46, 12)
    table = spark.read.option("header", True).csv(str(tmp_path / "out/training_results.csv"))
    assert {r["model"] for r in table.collect()} == {"linear_regression", "random_forest", "gbt"}
    assert made.test.collect()[0]["rmse"] < 1.0
    with pytest.raises(series.SeriesError):
        training.run_training(spark, str(tmp_path / "train"), _write(tmp_path / "none.csv", header), str(tmp_path / "out"))


def test_findings_can_stop_a_job(spark):
    report = spark.createDataFrame([("A", "small_series", "warning", 3, "few")], "symbol string, check string, severity string, observed bigint, message string")
    quality.raise_on(report, ["no_valid_rows"])
    with pytest.raises(series.SeriesError):
        quality.raise_on(report, ["small_series"])


def test_landed_bytes_come_back_equal(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    latin = "Ação;preço\r\nÉ;1,5\r\n".encode("latin-1")
    draw = random.Random(2)
    files = {"in/a b.csv": latin, "in/deep/a b.csv": b"\xef\xbb\xbfx\n\n", "in/z.bin": draw.randbytes(5 << 20) + b"\x00\r", "in/exact.bin": b"x" * 2048}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "in/empty.csv").write_bytes(b"")
    landing.land_raw(spark, str(tmp_path / "in"), str(tmp_path / "land"), "São Paulo", 1024, recursive=True)
    landed = spark.read.parquet(str(tmp_path / "land"))
    assert landed.agg(F.max(F.octet_length("content"))).first()[0] == 1024 and landed.count() == 1 + 1 + 5121 + 2
    assert landing.faults(landed).collect() == []
    back = landing.restored(landed, str(tmp_path / "out")).collect()
    found = {r["path"].split("/in/")[1]: (tmp_path / "out" / r["target"].split("/out/")[1]).read_bytes() for r in back}
    assert found == {name.removeprefix("in/"): content for name, content in files.items()}
    assert {r["sha256"] for r in back} == {hashlib.sha256(x).hexdigest() for x in files.values()}
    damaged = landed.withColumn("content", F.when(F.col("path").endswith("z.bin") & (F.col("number") == 7), F.unhex(F.lit("00"))).otherwise(F.col("content")))
    assert {r["fault"] for r in landing.faults(damaged).collect()} == {"changed piece"}
    assert {r["fault"] for r in landing.faults(landed.where("number != 5120")).collect()} == {"missing piece"}
    assert {r["fault"] for r in landing.faults(landed.union(landed.where("number = 3"))).collect()} == {"repeated piece"}


def test_update_touches_only_its_buckets_and_history_prunes(spark, tmp_path):
    path = str(tmp_path / "curated")
    rows = [(f"T{i}", f"2024-{m:02d}-01", float(m)) for i in range(40) for m in range(1, 13)] + [("T1", None, 0.0)]
    columns = "symbol string, trade_date_fmt string, close double"
    sinks.write_by_symbol(spark.createDataFrame(rows, columns), path, 16)
    files = lambda: {str(p) for p in (tmp_path / "curated").glob("*/*.parquet")}
    before = files()
    new = [("T1", "2024-03-01", 33.0), ("T1", "2024-03-01", 34.0), ("T1", None, 5.0), ("T2", "2025-01-01", 1.0)]
    touched = curated.update(spark.createDataFrame(new, columns), path, 16)
    assert 1 <= len(touched) <= 2
    changed = {p.split("symbol_bucket=")[1].split("/")[0] for p in before ^ files()}
    assert changed == {str(b) for b in touched} and len(before & files()) >= len(before) - 2
    found = sorted((r["symbol"], str(r["trade_date_fmt"]), r["close"]) for r in spark.read.parquet(path).collect())
    kept = [r for r in rows if (r[0], r[1]) not in {("T1", "2024-03-01"), ("T1", None)}]
    assert found == sorted((s, str(d), c) for s, d, c in kept + new)
    own = curated.history(spark, path, [" t1", "T2"], "2024-03-01", "2025-01-01", 16)
    assert own.count() == (9 + 2) + (10 + 1) and own.schema["trade_date_fmt"].dataType.simpleString() == "date"
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "symbol_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(trade_date_fmt,2024-03-01)" in pushed and "In(symbol" in pushed


def test_folders_are_listed_by_a_few_tasks(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"path=f{i}").mkdir()
        (tmp_path / f"path=f{i}" / "a.txt").write_text("symbol;date;close\nA;2024-01-01;1\n")
    before = spark.conf.get(folder._LISTING)
    spark.sparkContext.setJobGroup("listing", "listing")
    assert folder.listed_files(spark, str(tmp_path), "*.txt", True).count() == 60
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    sizes = [tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)]
    assert sizes and max(sizes) <= folder.LISTING_TASKS * spark.sparkContext.defaultParallelism
    assert spark.conf.get(folder._LISTING) == before
