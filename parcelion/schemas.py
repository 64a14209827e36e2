"""Schemas of every layer, from raw text to the graph and key-figure tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Header names of the raw files, in file order.
RAW_COLUMNS = [
    "Identifiant de document", "Reference document", "1 Articles CGI", "2 Articles CGI",
    "3 Articles CGI", "4 Articles CGI", "5 Articles CGI", "No disposition", "Date mutation",
    "Nature mutation", "Valeur fonciere", "No voie", "B/T/Q", "Type de voie", "Code voie",
    "Voie", "Code postal", "Commune", "Code departement", "Code commune",
    "Prefixe de section", "Section", "No plan", "No Volume", "1er lot",
    "Surface Carrez du 1er lot", "2eme lot", "Surface Carrez du 2eme lot", "3eme lot",
    "Surface Carrez du 3eme lot", "4eme lot", "Surface Carrez du 4eme lot", "5eme lot",
    "Surface Carrez du 5eme lot", "Nombre de lots", "Code type local", "Type local",
    "Identifiant local", "Surface reelle bati", "Nombre pieces principales",
    "Nature culture", "Nature culture speciale", "Surface terrain",
]

# Raw header name to message field.
MESSAGE_FIELDS = {
    "date_mutation": "Date mutation",
    "nature_mutation": "Nature mutation",
    "valeur_fonciere": "Valeur fonciere",
    "code_postal": "Code postal",
    "commune": "Commune",
    "type_local": "Type local",
    "surface_reelle_bati": "Surface reelle bati",
    "nombre_pieces_principales": "Nombre pieces principales",
}

DEDUP_KEY = ["date_mutation", "code_postal", "valeur_fonciere", "commune", "type_local"]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _D, _I, _L, _DATE = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.DateType()

RAW = _struct(*[(name, _S) for name in RAW_COLUMNS])

MESSAGE = _struct(*[(name, _S) for name in [*MESSAGE_FIELDS, "fichier_source"]])

BRONZE = _struct(
    ("date_mutation", _DATE), ("nature_mutation", _S), ("valeur_fonciere", _D),
    ("code_postal", _S), ("commune", _S), ("type_local", _S), ("surface_reelle_bati", _D),
    ("nombre_pieces_principales", _I), ("fichier_source", _S),
)

BRONZE_DDL = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in BRONZE)

SILVER = T.StructType(
    BRONZE.fields + [T.StructField("part_date", _DATE), T.StructField("id_unique", _S)]
)

COMMUNES = _struct(("id_commune", _I), ("nom_commune", _S))
TYPES_LOCAUX = _struct(("id_type", _I), ("type_local", _S))
NATURES_MUTATION = _struct(("id_nature", _I), ("nature_mutation", _S))
TRANSACTIONS = _struct(
    ("id_transaction", _S), ("id_unique", _S), ("code_postal", _S), ("date_mutation", _DATE),
    ("fichier_source", _S), ("part_date", _DATE), ("valeur_fonciere", _D),
    ("surface_reelle_bati", _D), ("nombre_pieces_principales", _I),
    ("id_commune", _I), ("id_type", _I), ("id_nature", _I),
)

NODE = _struct(("nom", _S))
MUTATION_NODE = _struct(("id", _S), ("date", _S), ("valeur", _D))
EDGES = {
    "a_pour_type": _struct(("nature", _S), ("type", _S)),
    "a_pour_lieu": _struct(("type", _S), ("commune", _S)),
    "a_enregistre": _struct(("commune", _S), ("mutation_id", _S), ("date", _S), ("valeur", _D)),
}

AUDIT = _struct(
    ("batch_id", _L), ("finished_at", T.TimestampType()), ("rows", _L),
    ("refused", _L), ("seconds", _D), ("status", _S), ("error", _S),
)
