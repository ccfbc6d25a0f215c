"""CSV parsing, the column contract and ingestion."""

from __future__ import annotations

import pytest
from conftest import HEADER, csv_line, raw_row

from txspark.schema import COLUMNS, RAW_SCHEMA, require_columns
from txspark.sources.ingest import ingest
from txspark.sources.lines import header_of, parse_csv, read_transactions


@pytest.fixture
def parse(spark):
    def run(header, *lines, **options):
        df = spark.createDataFrame([(line,) for line in lines], "value string")
        return parse_csv(df, header, **options).collect()

    return run


def test_types_follow_the_contract(spark, parts_dir):
    df = read_transactions(spark, parts_dir(HEADER + "\n" + csv_line(raw_row())))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RAW_SCHEMA]
    assert df.first().asDict() == raw_row()


@pytest.mark.parametrize("token", ["", "none", "None", "null", "NULL", "N/A", "n/a", "NaN", "nan", '""', '"none"'])
def test_tokens_are_null_in_numbers(parse, token):
    (row,) = parse(["amount", "login_frequency"], f"{token},{token}")
    assert row.amount is None and row.login_frequency is None


@pytest.mark.parametrize("text", ["Nan", " none", "NONE", "12d", "0x10", "1_0", "abc"])
def test_other_text_in_a_number_fails(parse, text):
    with pytest.raises(Exception):
        parse(["login_frequency", "x"], f"{text},1")


@pytest.mark.parametrize("text", [" none", "NONE", "12d", "1.5f", "0x1p3", "abc", "1e"])
def test_other_text_in_a_decimal_fails(parse, text):
    with pytest.raises(Exception, match="invalid number"):
        parse(["amount", "x"], f"{text},1")


@pytest.mark.parametrize(
    "text, value",
    [("1.5", 1.5), (" 1.5\t", 1.5), ("+1", 1.0), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0)]
    + [("inf", float("inf")), ("-Infinity", float("-inf"))],
)
def test_decimal_spellings(parse, text, value):
    assert parse(["amount", "x"], f"{text},1")[0].amount == value


def test_tokens_stay_text_unless_asked(parse):
    header = ["location_region", "sending_address", "anomaly"]
    assert tuple(parse(header, 'none,,""')[0]) == ("none", "", "")
    assert tuple(parse(header, 'none,,""', string_nulls=True)[0]) == (None, None, None)


def test_quotes(parse):
    rows = parse(["a", "b"], '"x, y","say ""hi"""', 'a"b,  padded ')
    assert [tuple(r) for r in rows] == [("x, y", 'say "hi"'), ('a"b', "  padded ")]


@pytest.mark.parametrize("line", ["1", "1,2,3", "   "])
def test_wrong_number_of_fields_fails(parse, line):
    with pytest.raises(Exception):
        parse(["a", "b"], line)


def test_columns_match_by_name_and_extras_survive(spark, parts_dir):
    header = ["extra", *reversed(COLUMNS)]
    row = raw_row()
    line = ",".join(["7", *[str(row[c]) for c in reversed(COLUMNS)]])
    df = read_transactions(spark, parts_dir(",".join(header) + "\n" + line + "\n"))
    assert df.columns == header
    assert df.first().extra == "7" and df.first().amount == row["amount"]


def test_digits_in_a_text_column_stay_text(spark, parts_dir):
    lines = [csv_line(raw_row(location_region="42", sending_address="0x1f"))] * 2
    row = read_transactions(spark, parts_dir("\n".join([HEADER, *lines]))).first()
    assert (row.location_region, row.sending_address) == ("42", "0x1f")


def test_missing_columns_fail_before_any_job(spark, parts_dir, raw):
    folder = parts_dir("col_a,col_b\n1,2\n")
    with pytest.raises(ValueError, match="Missing expected columns"):
        header_of(folder)
    with pytest.raises(ValueError, match="Missing expected columns.*amount"):
        require_columns(raw(raw_row()).drop("amount"))


def test_ingest_metadata(spark, parts_dir, tmp_path):
    data = HEADER + "\n" + "\n".join(csv_line(raw_row(amount=float(i))) for i in range(5)) + "\n"
    folder = parts_dir(data[:170], data[170:301], data[301:])
    target = str(tmp_path / "deep" / "raw")
    meta = ingest(spark, folder, target).first()
    assert (meta.row_count, meta.file_count, meta.bytes_read) == (5, 3, len(data))
    assert meta.columns == COLUMNS
    amounts = spark.read.parquet(target).select("amount").collect()
    assert sorted(r.amount for r in amounts) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_a_failed_parse_leaves_no_success(spark, parts_dir, tmp_path):
    folder = parts_dir(HEADER + "\n" + csv_line(raw_row()) + "\nbroken,line\n")
    with pytest.raises(Exception):
        ingest(spark, folder, str(tmp_path / "raw"))
    assert not (tmp_path / "raw" / "_SUCCESS").exists()
