"""Wide -> long landing edge rows."""
import datetime as dt

from paneltide.operators import landing

LOAD = dt.date(2024, 1, 2)


def test_year_column_discovery():
    cols = ["unit", "1999", "2000", "20x0", "geo\\TIME_PERIOD"]
    assert landing.year_columns(cols, 2000, 2023) == ["2000"]
    assert landing.geo_column(cols) == "geo\\TIME_PERIOD"
    assert landing.geo_column(["a", "b"]) == "geo"


def test_unpivot_coerces_and_drops_bad_cells(spark):
    wide = spark.createDataFrame(
        [("CP_MEUR", " DE ", "1.5", ":", "2.5 p", "", "7"),
         ("CP_MEUR", "EU27_2020", "9", "9", "9", "9", "9")],
        ["unit", "geo\\TIME_PERIOD", "2000", "2001", "2002", "2003", "1999"])
    long = landing.unpivot_wide(wide, 2000, 2023, LOAD)
    assert "1999" in long.columns  # out-of-range year column stays a dimension
    de = [r for r in long.collect() if r["geo\\TIME_PERIOD"] == " DE "]
    assert [(r["year"], r["value"]) for r in de] == [(2000, 1.5)]
    raw = landing.geo_filter(long, spark, "gdp_annual").collect()
    assert [(r["country_code"], r["country_name"], r["year"], r["value"], r["indicator"],
             r["loaded_at"]) for r in raw] == [("DE", "Germany", 2000, 1.5, "B1GQ", LOAD)]


def test_unemployment_defaults(spark):
    wide = spark.createDataFrame([("DE", "3.0")], ["geo", "2010"])
    out = landing.geo_filter(landing.unpivot_wide(wide, 2000, 2023, LOAD), spark,
                             "unemployment_annual").first()
    assert (out["age_group"], out["sex"], out["unit"]) == ("TOTAL", "T", "PC_ACT")


def test_no_year_columns_gives_empty(spark):
    wide = spark.createDataFrame([("DE", "x")], ["geo", "note"])
    assert landing.unpivot_wide(wide, 2000, 2023, LOAD).count() == 0


def test_wide_csv_round_trip(spark, tmp_path):
    path = tmp_path / "wide.tsv"
    path.write_text("unit\tgeo\\TIME_PERIOD\t2000\t2001\nCP_MEUR\tDE\t1.5\t:\n")
    wide = landing.read_wide_csv(spark, str(path), sep="\t")
    assert set(wide.columns) == {"unit", "geo\\TIME_PERIOD", "2000", "2001"}
    raw = landing.geo_filter(landing.unpivot_wide(wide, 2000, 2023, LOAD), spark,
                             "gdp_annual").collect()
    assert [(r["country_code"], r["year"], r["value"]) for r in raw] == [("DE", 2000, 1.5)]


def _landed(spark, folder, **kw):
    rows, rejects = landing.land_folder(spark, str(folder), "gdp_annual", 2000, 2023, LOAD, **kw)
    return (sorted((r["country_code"], r["year"], r["value"]) for r in rows.collect()),
            sorted((r["file"].rsplit("/", 1)[-1], r["country_code"], r["year"], r["cell"]) for r in rejects.collect()))


def test_files_of_other_headers_are_aligned_by_name(spark, tmp_path):
    """Shifted years, other dimensions, another order; names with blanks and pattern signs."""
    (tmp_path / "a b{1}.csv").write_text("geo,2000,2001\nDE,1,2\nFR,:,4 p\n")
    (tmp_path / "b[2].csv").write_text("\ngeo,2001,2002\nDE,20,30\nIT,n/a,\n")
    (tmp_path / "c*.csv").write_text("2003,unit,na_item,geo\n7,CP_MEUR,B1GQ, DE \n8,OTHER,B1GQ,DE\n9,CP_MEUR,B1GQ,XX\n")
    (tmp_path / "d.csv").write_text("geo,2000,2001\nES,5,6\n")
    rows, rejects = _landed(spark, tmp_path)
    assert rows == [("DE", 2000, 1.0), ("DE", 2001, 2.0), ("DE", 2001, 20.0), ("DE", 2002, 30.0), ("DE", 2003, 7.0),
                    ("ES", 2000, 5.0), ("ES", 2001, 6.0)]
    assert [r[1:] for r in rejects] == [("FR", 2001, "4 p"), ("IT", 2001, "n/a")]


def test_folders_without_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert _landed(spark, tmp_path) == ([], [])
    (tmp_path / "header.csv").write_text("geo,2000\n")
    (tmp_path / "nogeo.csv").write_text("note,2000\nx,odd\n")
    (tmp_path / "noyear.csv").write_text("geo,note\nDE,x\n")
    rows, rejects = _landed(spark, tmp_path)
    assert rows == [] and rejects == [("nogeo.csv", None, 2000, "odd")]


def test_files_of_one_header_are_one_scan(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"f{i}.tsv").write_text(f"geo\t{2000 + i % 2}\nDE\t{i}\n")
    assert sorted(len(f) for f in landing.header_groups(spark, str(tmp_path)).values()) == [2, 3]
    assert [v for _, _, v in _landed(spark, tmp_path, sep="\t")[0]] == [0.0, 2.0, 4.0, 1.0, 3.0]
