"""Small hand-written rows in the shapes of the layers."""

from __future__ import annotations

from datetime import date

from parcelion import schemas

RAW_ROWS = [
    # date, nature, price, postal code, commune, type, surface, rooms
    ("02/01/2020", "Vente", "249000,00", "1230", "ALPHA", "Maison", "100,5", "4"),
    ("02/01/2020", "Vente", "249000,00", "1230", "ALPHA", "Maison", "100,5", "4"),
    ("15/06/2021", "Vente", "123456789,12", "75001", "BETA", "", "", ""),
    ("29/02/2020", "Echange", "", "", "GAMMA", "Appartement", "45", "2"),
    ("31/31/2021", "Vente", "1000,00", "69001", "DELTA", "Local", "x", "4.0"),
]


def raw_text(rows=RAW_ROWS) -> str:
    """File content with all 43 columns."""
    names = list(schemas.MESSAGE_FIELDS.values())
    lines = ["|".join(schemas.RAW_COLUMNS)]
    for row in rows:
        cells = dict(zip(names, row[:2] + row[2:]))
        order = dict(
            zip(
                ["Date mutation", "Nature mutation", "Valeur fonciere", "Code postal", "Commune",
                 "Type local", "Surface reelle bati", "Nombre pieces principales"], row)
        )
        cells.update(order)
        lines.append("|".join(cells.get(name, "") for name in schemas.RAW_COLUMNS))
    return "\n".join(lines) + "\n"


def bronze(spark, rows):
    return spark.createDataFrame(rows, schemas.BRONZE)


def sale(day=date(2021, 5, 1), nature="Vente", price=100_000.0, postal="75001", commune="PARIS",
         kind="Maison", surface=50.0, rooms=2, source="f1"):
    return (day, nature, price, postal, commune, kind, surface, rooms, source)
