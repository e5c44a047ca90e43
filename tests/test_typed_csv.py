import datetime

import pytest

from leadpanel.sources import typed_csv as C


@pytest.fixture
def read(spark, tmp_path):
    def read(text, **more):
        path = tmp_path / "file.csv"
        path.write_text(text)
        return C.read_typed_csv(spark, str(path), **more)

    return read


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


HEADER = "strap,fips,built,area,sold,pool,note\n"
GOOD = [f'{i},0{i}1,{1950 + i},{i}.5,2020-01-{i + 10:02d},{"true" if i % 2 else "FALSE"},"line {i}\nand ""more"", here"\n' for i in range(20)]


def test_types_and_one_error_row_for_each_bad_row(read):
    """Ragged rows, quotes over lines, letters in a number column, a date that is none."""
    bad = ["20,0201,abc,1.5,2020-01-01,true,x\n", "21,0211,1980,1.5,2020-02-31,true,x\n", "22,0221,1980\n", "23,0231,1980,1,2020-01-01,true,x,y,z\n",
           "24,0241,1980,wide,none,maybe,x\n"]
    out = read(HEADER + "".join(GOOD[:10] + bad + GOOD[10:]))
    assert out.types == {"strap": "bigint", "fips": "string", "built": "bigint", "area": "double", "sold": "date", "pool": "boolean", "note": "string"}
    got = rows(out.rows)
    assert len(got) == 20 and (3, "031", 1953, 3.5, datetime.date(2020, 1, 13), True, 'line 3\nand "more", here') in got
    errors = out.errors.collect()
    assert sorted((r["column"] or "", r["value"] or "", r["error"]) for r in errors) == [
        ("", "", "wrong number of cells"), ("", "", "wrong number of cells"), ("area", "wide", "no double"), ("built", "abc", "no bigint"),
        ("sold", "2020-02-31", "no date")]
    assert any(r["record"].startswith("22,0221,1980") for r in errors)


def test_leading_zeros_fractions_and_empty_columns(read):
    out = read("zip,price,sparse,empty,mixed\n" + "".join(f"{'0' if i == 7 else ''}{8000 + i},{i if i % 3 else i + 0.25},{i if i == 4 else ''},,{i if i % 2 else 'x'}\n" for i in range(30)))
    assert out.types == {"zip": "string", "price": "double", "sparse": "bigint", "empty": "string", "mixed": "string"}
    assert out.rows.count() == 30 and out.errors.count() == 0
    got = {r["zip"]: r for r in out.rows.collect()}
    assert got["08007"]["price"] == 7.0 and got["8004"]["sparse"] == 4 and got["8005"]["sparse"] is None and got["8005"]["empty"] is None


def test_whole_numbers_beyond_the_type_are_numbers(read):
    out = read("n\n" + "".join(f"{10**20 + i}\n" for i in range(5)))
    assert out.types == {"n": "double"} and out.errors.count() == 0


def test_files_without_rows(read):
    out = read("a,b\n")
    assert out.types == {"a": "string", "b": "string"} and out.rows.count() == 0 and out.errors.count() == 0


def test_the_validation_report_has_the_errors(spark, read):
    out = read(HEADER + "".join(GOOD + ["x,1,1,1,2020-01-01,true,n\n", "y,1,1,1,2020-01-01,true,n\n", "1\n"]))
    assert rows(C.error_report({"homes": out}, spark)) == [
        ("homes", "1 rows left out: wrong number of cells"), ("homes", "2 rows left out: no bigint in column strap")]
