import pytest

from gleaner.sources import sheets


def test_names_of_stacked_headers():
    assert sheets.joined_names([["Zone", None, "Fees", "", "x"], [None, "n", "plain", "extra", None]]) == [
        "Zone", "Zone_n", "Fees_plain", "Fees_extra", "x",
    ]
    assert sheets.joined_names([["", "a", "a"], ["", "", ""]]) == ["column_0", "a", "a_2"]
    assert sheets.joined_names([["a", "b"]]) == ["a", "b"]


def test_sheet_in_several_files(spark, tmp_path):
    lines = ["Area,,Count", ",kind,", "North,x,1", ",,2", ",y,3", "South,,4", ",x,5", ",,6"]
    for part in range(4):  # header and rows lie in files of two lines
        (tmp_path / f"part-{part}.csv").write_text("\n".join(lines[2 * part : 2 * part + 2]) + "\n")
    rows = sheets.read_sheet(spark, str(tmp_path), header_rows=2, index_columns=2)
    assert rows.columns == ["Area", "Area_kind", "Count"]
    assert sorted(map(tuple, rows.collect()), key=lambda r: r[2]) == [
        ("North", "x", "1"), ("North", "x", "2"), ("North", "y", "3"), ("South", None, "4"), ("South", "x", "5"), ("South", "x", "6"),
    ]


def test_a_sheet_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\nc,d\n")
    empty = sheets.read_sheet(spark, str(tmp_path), header_rows=2)
    assert empty.columns == ["a_c", "b_d"] and empty.count() == 0
    with pytest.raises(ValueError):
        sheets.read_sheet(spark, str(tmp_path), header_rows=5)
