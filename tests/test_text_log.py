from wearcurve.schema import BRONZE_SCHEMA, RAW_FIELDS
from wearcurve.sources.text_log import parse_lines, read_raw

FULL = "1 2 " + " ".join(str(i / 2) for i in range(24))


def parse(spark, *lines, **options):
    parsed = parse_lines(spark.createDataFrame([(v,) for v in lines], "value string"), **options)
    rows = {(r["unit"], r["cycle"]): r for r in parsed.rows.collect()}
    rejects = {r["value"]: r["reason"] for r in parsed.rejects.collect()}
    return rows, rejects


def test_types_and_names(spark):
    parsed = parse_lines(spark.createDataFrame([(FULL,)], "value string"))
    assert parsed.rows.columns == list(RAW_FIELDS)
    assert [f.dataType for f in parsed.rows.schema] == [f.dataType for f in BRONZE_SCHEMA]
    assert tuple(parsed.rows.first())[:5] == (1, 2, 0.0, 0.5, 1.0)


def test_whitespace_and_blank_lines(spark):
    rows, rejects = parse(spark, "", "   ", "\t", f"  {FULL} \t", FULL.replace("1 2", "3\t  4"))
    assert set(rows) == {(1, 2), (3, 4)} and not rejects
    assert rows[3, 4]["W32"] == 11.5


def test_missing_and_unreadable_readings(spark):
    rows, _ = parse(spark, "1 1 NaN x 2.5 " + "1 " * 21, "2.0 1.0 " + "7 " * 24)
    assert rows[1, 1]["op_setting_1"] is None and rows[1, 1]["op_setting_2"] is None
    assert rows[1, 1]["op_setting_3"] == 2.5 and rows[2, 1]["W32"] == 7.0


def test_short_lines(spark):
    rows, rejects = parse(spark, "1 1 5")
    assert rows[1, 1]["op_setting_1"] == 5.0 and rows[1, 1]["W32"] is None and not rejects
    rows, rejects = parse(spark, "1 1 5", FULL, pad_short=False)
    assert set(rows) == {(1, 2)} and rejects == {"1 1 5": "too few fields"}


def test_rejects(spark):
    long = FULL + " 9"
    rows, rejects = parse(spark, FULL, long, "x 1 2", "NaN 1 2", "1 99999999999 2")
    assert set(rows) == {(1, 2)}
    assert rejects[long] == "too many fields"
    assert all(rejects[v] == "no unit or cycle" for v in ("x 1 2", "NaN 1 2", "1 99999999999 2"))


def test_read_raw(spark, tmp_path):
    (tmp_path / "log.txt").write_text(f"{FULL}\n\n{FULL} 1\n")
    parsed = read_raw(spark, str(tmp_path / "log.txt"))
    assert parsed.rows.count() == 1 and parsed.rejects.count() == 1
