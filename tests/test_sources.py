"""Readers on landed files."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from conftest import plan_of
from landing import Parcel, fixed_line, sample_parcels, write_cama, write_landing, write_transfers
from pyspark.sql import functions as F

from parcelflow import stages
from parcelflow.queries import formats, landed
from parcelflow.sources import counties, delimited, fixed_width, layouts, tables

D = dt.date


def test_layout_sizes():
    sizes = [
        (layouts.ASSESSMENT, 36, 341), (layouts.PARCEL, 86, 890), (layouts.SALES, 45, 1254), (layouts.LEGAL, 72, 1595),
        (layouts.DWELLING["ohio-butler"], 116, 776), (layouts.DWELLING["ohio-clermont"], 116, 777),
    ]
    for layout, columns, width in sizes:
        assert (len(layout), layouts.total_width(layout)) == (columns, width)
        assert len({f.name.lower() for f in layout}) == columns


@pytest.mark.parametrize(
    "layout, positions",
    [
        (layouts.ASSESSMENT, {"Aprland": (45, 11), "Aprbldg": (56, 11), "Class": (207, 4)}),
        (layouts.PARCEL, {"Class": (305, 4)}),
        (layouts.SALES, {"Own1": (305, 205), "Saledt": (510, 9), "Price": (519, 11), "Saletype": (531, 1), "Saleval": (604, 2)}),
        (layouts.DWELLING["ohio-butler"], {"Stories": (51, 5), "Yrblt": (59, 5), "Sfla": (488, 7)}),
        (layouts.DWELLING["ohio-clermont"], {"Stories": (51, 4), "Yrblt": (59, 5), "Sfla": (489, 7)}),
        (layouts.LEGAL, {"Adrno": (48, 11), "Adrsuf": (65, 8), "Adrstr": (75, 30), "Zip1": (153, 5), "Taxdist": (262, 5)}),
    ],
)
def test_layout_positions(layout, positions):
    assert {f.name: (f.start, f.width) for f in layout if f.name in positions} == positions


def test_fixed_width_file(spark, tmp_path):
    layout = layouts.layout("id 4 name 8 gap 0 n 5", types={"n": "double"})
    lines = ["0001Peña    12.5 ", '"002a\\b"c   nan  ', "  3 x,y\ty    7  ", "0004NA       1,2 "]
    (tmp_path / "f.DAT").write_bytes(("\n".join(lines) + "\n").encode("ISO-8859-1"))
    read = fixed_width.read_fixed_width(spark, str(tmp_path / "f.DAT"), layout)
    assert {tuple(r) for r in read.collect()} == {
        ("0001", "Peña", None, 12.5), ('"002', 'a\\b"c', None, None), ("3", "x,y\ty", None, 7.0), ("0004", None, None, None),
    }


def test_dwelling_and_legal_files(spark, tmp_path):
    for county in ("ohio-butler", "ohio-clermont"):
        folder = tmp_path / county
        folder.mkdir()
        line = fixed_line(layouts.DWELLING[county], Parid="007", Stories="1.5", Style="9", Rectype="4", Yrblt=1950, Sfla=1200)
        (folder / "DWELL.DAT").write_text(line + "\n")
        assert tuple(counties.read_dwellings(spark, str(folder), county).first()) == ("007", 1.5, 1950, 1200.0)
    (tmp_path / "LEGDAT.DAT").write_text(fixed_line(layouts.LEGAL, Parid="007", Adrstr="MAIN", Taxdist="05") + "\n")
    legal = counties.read_legal(spark, str(tmp_path)).first()
    assert (legal["Parid"], legal["Adrstr"], legal["Taxdist"], legal["User25"]) == ("007", "MAIN", "05", None)


def test_cama_county(spark, tmp_path):
    parcels = [Parcel("ohio-butler", 1, 1990, D(2000, 1, 1), "x", [(D(1969, 5, 6), 1000.0), (D(2020, 1, 5), 0.0)]),
               Parcel("ohio-butler", 2, 1990, D(2000, 1, 1), "x", [(D(2021, 2, 3), 5.0)])]
    write_cama(tmp_path, parcels)
    rows = counties.load_county(spark, "ohio-butler", str(tmp_path), D(2022, 1, 1))
    assert rows.columns == [*counties.SALE_COLUMNS, "State", "County"]
    found = sorted(rows.collect(), key=lambda r: (r["Parid"], r["Building Value"]))
    assert {r["Parid"] for r in found} == {p.key for p in parcels}  # the sale without a price is gone
    assert len(found) > len(parcels)  # every assessment of a parcel stands beside its sale
    old = [r for r in found if r["Parid"] == parcels[0].key][-1]
    assert (old["last_sale_date"], old["Year of Sale"], old["Day of Sale"]) == (D(1969, 5, 6), 1969, 6)
    assert (old["Owner Name 1"], old["DeedType"], old["ValidSale"], old["Property Class"]) == ('Peña "Al"', "1", "Y", "510")
    assert (old["Building Value"], old["State"], old["County"]) == (2020.0, "Ohio", "Butler")


def test_unused_fields_are_not_cut(spark, tmp_path):
    (tmp_path / "SALES.DAT").write_text(fixed_line(layouts.SALES, Parid="1", Price=3) + "\n")
    sales = fixed_width.read_fixed_width(spark, str(tmp_path / "SALES.DAT"), layouts.SALES)
    plan = plan_of(sales.select("Parid", "Price")).split("Physical Plan")[1]
    assert plan.count("decode(substring(") == 2 and "Own1" not in plan


def test_lines_of_any_script(spark):
    layout = layouts.layout("a 2 b 3 c 4 d 2", types={"c": "double"})
    lines = ["ab漢字😀 1.5zz", "é", "", "éü ñ 7   ﻿x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, line string").repartition(2)
    cut = {tuple(r) for r in fixed_width.cut_fields(df, "line", layout).collect()}
    assert cut == {("ab", "漢字😀", 1.5, "zz"), ("é", None, None, None), (None,) * 4, ("éü", "ñ", 7.0, "x")}
    latin = fixed_width.cut_fields(df.where("i in (1, 2, 4)"), "line", layout, ["a"], encoding="ISO-8859-1")
    assert latin.columns == ["a"] and {r["a"] for r in latin.collect()} == {"é", None}


@pytest.mark.parametrize("name", list(formats.LAYOUTS))
def test_layouts_agree_with_the_published_positions(name):
    fields, positions = formats.LAYOUTS[name]
    stated = [(n, int(start), int(width)) for n, start, width in (p.split() for p in positions.split(","))]
    assert [(f.name, f.start, f.width) for f in fields] == stated
    assert sum(f.width for f in fields) == layouts.total_width(fields) <= 32 * formats.BLOCKS


def test_a_wrong_width_turns_a_layout_query_red(spark):
    fields = [dataclasses.replace(f, width=f.width + 1) if f.name == "Aprbldg" else f for f in layouts.ASSESSMENT]
    cut = fixed_width.cut_fields(spark.range(3).select(F.col("id").alias("c_custkey")).select(formats._digits().alias("line")), "line", fields)
    right = fixed_width.cut_fields(spark.range(3).select(F.col("id").alias("c_custkey")).select(formats._digits().alias("line")), "line", layouts.ASSESSMENT)
    assert cut.exceptAll(right).count() == 3


def test_transfer_county(spark, tmp_path):
    parcels = [Parcel("ohio-hamilton", 7, 1990, D(2000, 1, 1), "x", [(D(1998, 5, 6), 1000.0), (D(2020, 1, 5), 9.0), (D(2020, 1, 5), 9.0)])]
    write_transfers(tmp_path, parcels)
    rows = counties.read_transfers(spark, str(tmp_path)).collect()
    sold = {(r["Parid"], r["last_sale_date"]): r for r in rows if r["last_sale_date"]}
    assert set(sold) == {(parcels[0].key, d) for d in (D(1996, 5, 6), D(1998, 5, 6), D(2020, 1, 5))}
    assert sold[parcels[0].key, D(1996, 5, 6)]["DeedType"] == "WD"
    assert sold[parcels[0].key, D(2020, 1, 5)]["Land Value"] is None
    unsold = [r for r in rows if r["Parid"] == "never-sold"]
    assert [(r["Livable Sqft"], r["last_sale_price"]) for r in unsold] == [(6.0, None)]
    assert all(r["Livable Sqft"] is None for r in sold.values())  # one floor is unknown


def test_state_and_source_files(spark, tmp_path):
    parcels = sample_parcels(3)
    write_landing(tmp_path, parcels)
    state = counties.load_state(spark, "ohio", str(tmp_path), D(2022, 1, 1))
    assert {r["County"] for r in state.collect()} == {"Butler", "Clermont", "Hamilton"}
    sold = state.select("Parid", "last_sale_date", "last_sale_price").distinct()
    assert sold.count() == len(parcels) + 1  # one more sale on the historic sheet
    light = counties.stacked_sales(spark, "ohio", str(tmp_path), D(2022, 1, 1)).where("last_sale_price > 0")
    assert {tuple(r) for r in light.select(*sold.columns).collect()} == {tuple(r) for r in sold.collect()}
    assessor = counties.read_assessor(spark, str(tmp_path))
    assert {r["PartyOwner1NameFull"] for r in assessor.collect()} == {p.owner for p in parcels}
    values = counties.read_valuations(spark, str(tmp_path)).collect()
    assert len(values) == len(parcels) and {r["LastUpdateDate"] for r in values} == {D(2021, 6, 1)}
    with pytest.raises(ValueError):
        counties.load_county(spark, "nowhere", str(tmp_path), D(2022, 1, 1))


def test_files_are_stacked_by_header_names(spark, tmp_path):
    (tmp_path / "a_X.txt").write_text("id\tn\n1\t2\n")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b_X.txt").write_text("n\textra\tid\n3\tx\t4\n")
    (tmp_path / "c_X.txt").write_text("id\n5\n")
    (tmp_path / "other.txt").write_text("id\tn\n9\t9\n")
    read = delimited.read_with_header(spark, str(tmp_path), {"id": "string", "n": "int", "gone": "date"}, "*X*.txt")
    assert {tuple(r) for r in read.collect()} == {("1", 2, None), ("4", 3, None), ("5", None, None)}
    none = delimited.read_with_header(spark, str(tmp_path), {"id": "string"}, "*nothing*")
    assert none.columns == ["id"] and none.count() == 0


def test_stages(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "stage")
    assert stages.stage(spark, path, build).count() == stages.stage(spark, path, build).count() == 3
    assert len(calls) == 1
    (tmp_path / "stage" / "_SUCCESS").unlink()  # a write that did not finish is done again
    assert stages.stage(spark, path, build).count() == 3 and len(calls) == 2
    stages.write_json(spark.range(2).selectExpr("id", "cast(null as string) as gone"), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).columns == ["gone", "id"]


def test_relational_reader_needs_its_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        tables.read_table(spark, "jdbc:none:x", "prediction", {"driver": "no.such.Driver"}, ("id", 0, 10, 2))


def test_landed_lines_are_compressed_in_short_files_and_come_back_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "LINES_PER_FILE", 100)
    rows = spark.range(0, 250, 1, 1).select(
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("parcel "), (F.col("id") % 50).cast("string"))).alias("Parid"), F.col("id").cast("double").alias("Price")
    )  # keys repeat or are missing
    landed._landed(rows, layouts.SALES, str(tmp_path / "SALES.DAT"))
    files = list((tmp_path / "SALES.DAT").glob("part-*"))
    assert len(files) == 3  # each is read by one task
    assert sum(f.stat().st_size for f in files) * 10 < 250 * layouts.total_width(layouts.SALES)
    read = fixed_width.read_fixed_width(spark, str(tmp_path / "SALES.DAT"), layouts.SALES, columns=["Parid", "Price"])
    assert sorted(map(str, read.collect())) == sorted(map(str, rows.collect()))
