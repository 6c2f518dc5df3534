from datetime import datetime

import pytest

from ledgersift.session import size_shuffles
from ledgersift.sources.files import list_entries, select_files, total_bytes
from ledgersift.sources.transactions import (
    TRANSACTION_COLUMNS,
    default_output,
    read_transactions,
    rename_positional,
    write_clean,
)

LINE = "{n},2022-11-0{d} 10:00:00,5,6,12.5,100,1,0,0\n"


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    for d in (3, 4, 5):
        (root / f"2022-11-0{d}.txt").write_text("# id | time | ...\n" + LINE.format(n=d, d=d))
    (root / "readme.md").write_text("ignore me\n")
    return str(root)


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


def test_comments_and_types(spark, folder):
    df = read_transactions(spark, f"{folder}/2022-11-04.txt")
    assert df.columns == TRANSACTION_COLUMNS
    assert tuple(df.first()) == (4, datetime(2022, 11, 4, 10), 5, 6, 12.5, 100, 1, 0, 0)
    inferred = read_transactions(spark, f"{folder}/2022-11-04.txt", infer=True)
    assert inferred.columns == TRANSACTION_COLUMNS and tuple(inferred.first()) == tuple(df.first())
    assert read_transactions(spark, f"{folder}/2022-11-04.txt", ntz=True).schema["tx_datetime"].dataType.typeName() == "timestamp_ntz"


def test_glob(spark, folder):
    assert ids(read_transactions(spark, f"{folder}/*.txt")) == [3, 4, 5]


@pytest.mark.parametrize(
    "limit, expected",
    [("latest", [5]), ("all", [3, 4, 5]), ("", [3, 4, 5]), ("2", [3, 4]), (2, [3, 4]), ("9", [3, 4, 5]), (0, [])],
)
def test_select(spark, folder, limit, expected):
    assert ids(read_transactions(spark, select_files(spark, folder, limit))) == expected


@pytest.mark.parametrize("limit", ["newest", "-1", "1.5", "²"])
def test_unknown_limit(spark, folder, limit):
    with pytest.raises(ValueError, match="file limit"):
        select_files(spark, folder, limit)


def test_every_object_without_suffix(spark, folder):
    assert [p.rsplit("/", 1)[1] for p in select_files(spark, folder + "/", 99, suffix=None)][-1] == "readme.md"


def test_nothing_to_select(spark, tmp_path):
    (tmp_path / "note.md").write_text("x")
    assert select_files(spark, str(tmp_path), "latest") == []
    assert read_transactions(spark, []).count() == 0


def test_a_folder_of_parts_is_one_entry(spark, folder):
    spark.createDataFrame([(LINE.format(n=i, d=9).strip(),) for i in (91, 92)], "v string").repartition(2).write.text(
        f"{folder}/2022-11-09.txt"
    )
    assert list_entries(spark, folder).count() == 4
    assert ids(read_transactions(spark, select_files(spark, folder, "latest"))) == [91, 92]


def test_lines_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "x.txt"
    path.write_text(LINE.format(n=1, d=1) + "2,not a time,5,6,x,100,1,0,0\n" + "3,2022-11-01 10:00:00,5\n")
    df = read_transactions(spark, str(path), corrupt_column="_bad").cache()
    rows = {r.transaction_id: r for r in df.collect()}
    assert rows[1]["_bad"] is None and rows[2]["_bad"].startswith("2,not") and rows[2].tx_amount is None
    assert rows[None]["_bad"].startswith("3,2022")
    df.unpersist()
    with pytest.raises(Exception, match="(?i)malformed"):
        read_transactions(spark, str(path), mode="FAILFAST").collect()


def test_wrong_number_of_columns(spark, tmp_path):
    path = tmp_path / "x.txt"
    path.write_text("1,2,3\n")
    for infer in (True, False):
        with pytest.raises(ValueError, match="3 columns"):
            read_transactions(spark, str(path), infer=infer)
    assert rename_positional(spark.createDataFrame([(1, 2)], "a int, b int"), ["x", "y"]).columns == ["x", "y"]


def test_overwrite_and_partitions(spark, tmp_path, folder):
    out = default_output(str(tmp_path / "t"))
    assert out.endswith("t.parquet")
    df = read_transactions(spark, f"{folder}/*.txt")
    write_clean(df, out)
    write_clean(df.filter("transaction_id > 3"), out)
    assert ids(spark.read.parquet(out)) == [4, 5]
    write_clean(df, out, ["tx_time_days", "tx_fraud"])
    back = spark.read.parquet(out)
    assert ids(back) == [3, 4, 5] and set(back.columns) == set(TRANSACTION_COLUMNS)


def test_names_with_spaces(spark, tmp_path):
    for name in ("a b.txt", "c%20d.txt", "e+f.txt"):
        (tmp_path / name).write_text(LINE.format(n=1, d=1))
    found = select_files(spark, str(tmp_path), 9)
    assert [f.rsplit("/", 1)[1] for f in found] == ["a b.txt", "c%20d.txt", "e+f.txt"]
    assert read_transactions(spark, found).count() == 3
    assert read_transactions(spark, select_files(spark, str(tmp_path), "all")).count() == 3


@pytest.mark.parametrize("form", ["{}", "{}/", "file:{}", "file://{}", "file://{}/"])
def test_forms_of_a_root(spark, folder, form):
    root = form.format(folder)
    assert [f.rsplit("/", 1)[1] for f in select_files(spark, root, 2)] == ["2022-11-03.txt", "2022-11-04.txt"]
    assert ids(read_transactions(spark, select_files(spark, root, "all"))) == [3, 4, 5]


READ_ALL_THE_SAME = {
    "1,2022-11-01 10:00:00.123,5,6,12.5,100,1,0,0": datetime(2022, 11, 1, 10, 0, 0, 123000),
    "1,2022-11-01T10:00:00,5,6,12.5,100,1,0,0": datetime(2022, 11, 1, 10),
    "1,2022-11-01,5,6,12.5,100,1,0,0": datetime(2022, 11, 1),
    "1,2022-11-01 10:00:00,5.0,6,12.5,100,1,0,0": datetime(2022, 11, 1, 10),
}


@pytest.mark.parametrize("line", READ_ALL_THE_SAME)
@pytest.mark.parametrize("ntz", [False, True])
def test_values_that_inference_reads(spark, tmp_path, line, ntz):
    (tmp_path / "x.txt").write_text(line + "\n")
    row = read_transactions(spark, str(tmp_path / "x.txt"), ntz=ntz, corrupt_column="_bad").first()
    assert tuple(row) == (1, READ_ALL_THE_SAME[line], 5, 6, 12.5, 100, 1, 0, 0, None)


def test_shuffles_are_sized_by_the_input(spark, folder):
    assert total_bytes(spark, f"{folder}/*.txt") == 3 * (len(LINE.format(n=1, d=1)) + len("# id | time | ...\n"))
    assert total_bytes(spark, []) == 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 1000) == int(before)
        assert size_shuffles(spark, 100, partition_bytes=2) == 50
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
