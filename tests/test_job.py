import pytest

from ledgersift.jobs import clean as job
from ledgersift.plans.clean import CUSTOMER_FIRST, SIGMA_FIRST, clean, clean_counted, clean_report
from ledgersift.sources.transactions import read_transactions
from ledgersift.sources.versions import read_current
from ledgersift.workload.tables import tx_raw


@pytest.fixture
def root(tmp_path):
    folder = tmp_path / "input_data"
    folder.mkdir()
    line = "{n},2022-11-0{d} 10:00:00,{c},6,{a},100,1,0,0\n"
    (folder / "2022-11-01.txt").write_text("# head\n" + "".join(line.format(n=n, d=1, c=1, a=5 + n % 3) for n in range(40)))
    (folder / "2022-11-02.txt").write_text(
        line.format(n=100, d=2, c=0, a=6) + line.format(n=101, d=2, c=3, a=-6) + line.format(n=102, d=2, c=3, a=6)
    )
    return tmp_path


def test_one_file_with_default_output(spark, root):
    path = str(root / "input_data" / "2022-11-02.txt")
    found = job.run(spark, path)
    assert (found.rows_in, found.rows_out) == (3, 1)
    assert spark.read.parquet(path + ".parquet").count() == 1
    assert found.lines() == ["rows read: 3", "rows left: 1 (66.67% removed)"]


def test_root_mode(spark, root, caplog):
    caplog.set_level("INFO")
    assert job.main(["--root", str(root), "--steps", "--partition-by", "tx_time_days"]) == 0
    assert spark.read.parquet(str(root / "output_data")).count() == 41
    assert "customer   41 rows" in caplog.text and "rows left: 41" in caplog.text


def test_latest_only(spark, root):
    assert job.main(["--root", str(root), "--files", "latest"]) == 0
    assert [r.transaction_id for r in spark.read.parquet(str(root / "output_data")).collect()] == [102]


def test_empty_input_keeps_the_output(spark, root):
    out = str(root / "out")
    job.run(spark, str(root / "input_data" / "*.txt"), out)
    before = spark.read.parquet(out).count()
    empty = root / "empty.txt"
    empty.write_text("# nothing\n")
    found = job.run(spark, str(empty), out)
    assert not found.written and found.lines() == ["the input is empty, nothing was written"]
    assert spark.read.parquet(out).count() == before
    assert job.main([str(empty), out]) == 0


def test_all_removed_is_written(spark, root):
    bad = root / "bad.txt"
    bad.write_text("1,2022-11-01 10:00:00,1,1,-1,0,0,0,0\n")
    found = job.run(spark, str(bad), str(root / "out"))
    assert (found.rows_in, found.rows_out) == (1, 0)


def test_all_removed_with_partitions(spark, root):
    bad = root / "bad.txt"
    bad.write_text("1,2022-11-01 10:00:00,1,1,-1,0,0,0,0\n")
    assert job.main([str(bad), str(root / "out"), "--partition-by", "tx_time_days"]) == 0


@pytest.mark.parametrize("line", ["1;2022-11-01 10:00:00;1;1;5;0;0;0;0", "1,2022-11-01 10:00:00,1,1,5,0,0,0", "1,2022-11-01 10:00:00,1,1,5,0,0,0,0,9", "1,never,1,1,5,0,0,0,0"])
def test_unreadable_input_keeps_the_output(spark, root, line):
    out = str(root / "out")
    job.run(spark, str(root / "input_data" / "*.txt"), out)
    before = spark.read.parquet(out).count()
    (root / "odd.txt").write_text((line + "\n") * 3)
    assert job.main([str(root / "odd.txt"), out]) == 1
    assert spark.read.parquet(out).count() == before > 0


def test_unreadable_lines_are_counted(spark, root):
    path = root / "some.txt"
    good = "{n},2022-11-01 10:00:00,1,1,5,0,0,0,0\n"
    path.write_text(good.format(n=1) + "2,never,1,1,5,0,0,0,0\n" + "3,2022-11-01 10:00:00,1\n" + good.format(n=4))
    found = job.run(spark, str(path), str(root / "out"))
    assert (found.rows_in, found.rows_out, found.unreadable) == (4, 2, 2)
    assert found.lines()[-1] == "lines with unreadable values: 2"


@pytest.mark.parametrize("steps", [False, True])
def test_the_text_is_read_once(spark, root, monkeypatch, steps):
    """The write is the only job over the text, with and without the steps."""
    written = []
    original = job.write_clean

    def spy(df, *args):
        written.append(df)
        return original(df, *args)

    monkeypatch.setattr(job, "write_clean", spy)
    path = str(root / "input_data" / "*.txt")
    monkeypatch.setattr(job, "total_bytes", lambda *a: 0)
    found = job.run(spark, path, str(root / "out"), "customer-first", steps=steps)
    assert (found.rows_in, found.rows_out) == (43, 41)
    assert len(written) == 1
    # Both sides of the trim read one shuffle: the text is scanned once.
    written[0].collect()
    final = written[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final or "ReusedQueryStage" in final or "ResultQueryStage" in final
    report = clean_report(read_transactions(spark, path), CUSTOMER_FIRST).orderBy("step_no").collect()
    assert report[0].rows_out == found.rows_in and report[-1].rows_out == found.rows_out


def test_step_counts_equal_the_report(spark, sf):
    raw = tx_raw(spark, sf["sf0.01"])
    for order in (CUSTOMER_FIRST, SIGMA_FIRST):
        cleaned, counts = clean_counted(raw, order, full=True)
        cleaned.write.format("noop").mode("overwrite").save()
        assert counts.lines() == [tuple(r) for r in clean_report(raw, order).orderBy("step_no").collect()]
        assert counts.get(order[-1]) == clean(raw, order).count()


def test_rejects_and_versions(spark, root):
    path = root / "some.txt"
    good = "{n},2022-11-01 10:00:00,1,1,5,0,0,0,0\n"
    path.write_text(good.format(n=1) + "2,never,1,1,5,0,0,0,0\n" + "3,2022-11-01 10:00:00,1\n" + good.format(n=4))
    out, rejects = str(root / "out"), str(root / "rejects")
    assert job.main([str(path), out, "--versioned", "--rejects", rejects, "--steps"]) == 0
    assert sorted(r.transaction_id for r in read_current(spark, out).collect()) == [1, 4]
    assert sorted(r.line[0] for r in spark.read.parquet(rejects).collect()) == ["2", "3"]
    path.write_text("2,never,1,1,5,0,0,0,0\n")
    assert job.main([str(path), out, "--versioned", "--rejects", rejects]) == 1
    assert read_current(spark, out).count() == 2


def test_errors_end_with_one(spark, root, caplog):
    assert job.main([str(root / "missing.txt")]) == 1
    assert "cleaning failed" in caplog.text


def test_arguments():
    for argv in ([], ["--root", "x", "in.txt"], ["in.txt", "--order", "other"]):
        with pytest.raises(SystemExit):
            job.parse(argv)
