"""Small landed files of every format, written from a list of parcels."""

from __future__ import annotations

import csv
import datetime as dt
from dataclasses import dataclass, field
from pathlib import Path

from parcelflow.sources import counties, layouts


@dataclass
class Parcel:
    county: str
    number: int
    built: int
    assessed: dt.date
    owner: str
    sales: list[tuple[dt.date, float]] = field(default_factory=list)
    value: float = 250_000.0

    @property
    def key(self) -> str:
        prefix = {"ohio-butler": "1", "ohio-clermont": "2", "ohio-hamilton": "3"}[self.county]
        return f"{prefix}{self.number:012d}"


def fixed_line(layout: list[layouts.Field], **values) -> str:
    return "".join(str(values.get(f.name, "")).ljust(f.width)[: f.width] for f in layout)


def write_cama(folder: Path, parcels: list[Parcel]) -> None:
    folder.mkdir(parents=True, exist_ok=True)

    def write(name, lines):
        (folder / name).write_bytes(("\n".join(lines) + "\n").encode("ISO-8859-1"))

    write("PARDAT.DAT", [fixed_line(layouts.PARCEL, Parid=p.key, Class="R") for p in parcels])
    write(
        "ASMT.DAT",
        [
            fixed_line(layouts.ASSESSMENT, Parid=p.key, Taxyr=year, Seq=1, Aprland=50_000, Aprbldg=year, Class="510")
            for p in parcels
            for year in (2019, 2020)
        ],
    )
    write(
        "SALES.DAT",
        [
            fixed_line(
                layouts.SALES, Parid=p.key, Own1='Peña "Al"', Saledt=day.strftime("%d-%b-%y").upper(), Price=int(price),
                Saletype="I", Saleval="Y",
            )
            for p in parcels
            for day, price in p.sales
        ],
    )


def transfer_line(columns, parcel: Parcel, day: dt.date, price: float) -> list:
    k = parcel.key
    values = {
        "Book": str(int(k[:3])), "Plat": str(int(k[3:7])), "Parcel": str(int(k[7:11])), "ParcelID": str(int(k[11:])),
        "Owner Name 1": "SMITH, JO", "Sale Price": price, "Year of Sale": day.year, "Month of Sale": day.month,
        "Day of Sale": day.day, "DeedType": "WD", "ValidSale": "Y", "Building Value": 1, "Land Value": "n/a",
    }
    return [values.get(c, "") for c in columns]


def write_transfers(folder: Path, parcels: list[Parcel]) -> None:
    formats = {"new-format": counties.TRANSFER_COLUMNS_NEW, "old-format": counties.TRANSFER_COLUMNS_OLD}
    for name, columns in formats.items():
        (folder / name).mkdir(parents=True, exist_ok=True)
        with open(folder / name / "transfer_a.csv", "w", newline="") as file:
            rows = csv.writer(file)
            rows.writerow(columns)  # header line among the data
            for p in parcels:
                for day, price in p.sales:
                    if (day.year >= 2007) == (name == "new-format"):
                        rows.writerow(transfer_line(columns, p, day, price))
    with open(folder / "HistoricSalesExport.csv", "w", newline="") as file:
        rows = csv.writer(file)
        rows.writerow([*counties.HISTORIC_TYPES])
        rows.writerow([parcels[0].key, "Old Owner", "1", "Main", "St", "WD deed", "510", "77000", "1996-05-06"])
    with open(folder / "bldginfo.csv", "w", newline="") as file:
        rows = csv.writer(file)
        rows.writerow([*counties.BUILDING_TYPES])
        for p in parcels:
            rows.writerow([p.key, 900, 600, "", 2, p.built])
        rows.writerow(["never-sold", 1, 2, 3, 1, 1950])


def write_source(folder: Path, parcels: list[Parcel]) -> None:
    def write(name: str, columns, lines) -> None:
        (folder / name).mkdir(parents=True, exist_ok=True)
        with open(folder / name / f"{name}.txt", "w", newline="") as file:
            rows = csv.writer(file, delimiter="\t")
            rows.writerow(["Ignored", *columns])
            for line in lines:
                rows.writerow(["x", *[line.get(c, "") for c in columns]])

    def assessor(p: Parcel, updated: str, owner: str) -> dict:
        k = p.key
        return {
            "source_id": f"S{k}", "ParcelNumberRaw": f"{k[:4]}-{k[4:8]}.{k[8:]}", "AssrLastUpdated": updated,
            "AssessorLastSaleDate": p.assessed.isoformat(), "AssessorLastSaleAmount": 90_000, "YearBuilt": p.built,
            "PropertyAddressFull": f"{p.number} o'neil st", "PropertyAddressCity": "HAMILTON",
            "PropertyAddressZIP": "45011", "SitusCounty": p.county.split("-")[1].title(), "SitusStateCode": "OH",
            "NeighborhoodCode": "N1", "PropertyLatitude": 39.4, "PropertyLongitude": -84.5, "CompanyFlag": "",
            "OwnerTypeDescription1": "INDIVIDUAL", "PartyOwner1NameFull": owner,
            "PropertyUseGroup": ("residential", "condo")[p.number % 2], "BathCount": 2, "BathPartialCount": 1,
            "BedroomsCount": 3, "AreaBuilding": 1500 + p.number, "AreaLotSF": 9000, "StoriesCount": 1 + p.number % 2,
            "TaxMarketValueLand": 60_000, "TaxMarketValueImprovements": 140_000, "TaxMarketValueTotal": p.value,
        }

    half = len(parcels) // 2
    write("OH_ASSESSOR_1", counties.ASSESSOR_TYPES, [assessor(p, "2020-01-01", "Someone Before") for p in parcels])
    write(
        "OH_ASSESSOR_2",
        counties.ASSESSOR_TYPES,
        [assessor(p, "2021-01-01", p.owner) for p in (*parcels[half:], *parcels[:half])],
    )
    valuations = [
        {"source_id": f"S{p.key}", "LastUpdateDate": f"202{i}-06-01", "ValuationDate": f"202{i}-05-01",
         "EstimatedValue": 200_000 + 10_000 * i + p.number, "ConfidenceScore": 80}
        for p in parcels for i in (0, 1)
    ]
    write("OH_AVM_1", counties.VALUATION_TYPES, valuations)


def write_landing(folder: Path, parcels: list[Parcel]) -> None:
    for county in ("ohio-butler", "ohio-clermont"):
        write_cama(folder / county, [p for p in parcels if p.county == county])
    write_transfers(folder / "ohio-hamilton", [p for p in parcels if p.county == "ohio-hamilton"])
    write_source(folder / "source", parcels)


def sample_parcels(per_county: int = 40) -> list[Parcel]:
    """Odd parcels sell again around the training year after a long hold, even ones have been held since 2009."""
    result = []
    for county in ("ohio-butler", "ohio-clermont", "ohio-hamilton"):
        for i in range(per_county):
            if i % 2:
                assessed = dt.date(2007, 1 + i % 12, 5)
                sales = [(dt.date(2020 + (i % 24 + 8) // 12, (i % 24 + 8) % 12 + 1, 10), 150_000.0 + 1000 * i)]
            else:
                assessed = dt.date(2001, 1 + i % 12, 9)
                sales = [(dt.date(2009, 1 + i % 12, 20), 120_000.0 + 500 * i)]
            result.append(Parcel(county, i, 1980 + i % 15, assessed, f"Owner Number{i} LLC", sales))
    return result
