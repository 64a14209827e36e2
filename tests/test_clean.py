"""Raw files, messages and cleaning."""

from datetime import date

from pyspark.sql import functions as F

from parcelion.functions import dates, numeric, text
from parcelion.operators import clean
from parcelion.plans.refinement import Layers, load_bronze, load_gold, load_graph, load_key_values, load_silver
from parcelion.schemas import BRONZE
from parcelion.sources import messages, raw, tables

from .data import RAW_ROWS, raw_text


def _one(spark, *columns):
    return spark.range(1).select(*columns).first()


def _files(tmp_path):
    for year in (2020, 2021):
        (tmp_path / f"ventes-{year}.txt").write_text(raw_text(), encoding="utf-8")
    return tmp_path


def test_scan_tags_files_and_takes_a_chosen_list(spark, tmp_path):
    folder = _files(tmp_path)
    every = raw.scan_raw(spark, f"{folder}/*.txt")
    assert len(every.columns) == 44
    assert {r[0]: r[1] for r in every.groupBy("fichier_source").count().collect()} == {
        "ventes-2020": 5, "ventes-2021": 5}
    one = raw.scan_raw(spark, [f"{folder}/ventes-2021.txt"])
    assert [r[0] for r in one.select("fichier_source").distinct().collect()] == ["ventes-2021"]


def test_empty_text_stays_and_empty_numbers_are_null(spark, tmp_path):
    rows = raw.message_fields(raw.scan_raw(spark, f"{_files(tmp_path)}/ventes-2020.txt")).collect()
    blank = next(r for r in rows if r.commune == "BETA")
    assert blank.type_local == "" and blank.surface_reelle_bati is None
    assert blank.nombre_pieces_principales is None
    assert blank.valeur_fonciere == "123456789.12"
    assert next(r for r in rows if r.commune == "GAMMA").code_postal == ""


def test_cleaning_keeps_float_precision_in_a_double(spark, tmp_path):
    df = clean.clean(raw.message_fields(raw.scan_raw(spark, f"{_files(tmp_path)}/ventes-2020.txt")))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in BRONZE]
    rows = {r.commune: r for r in df.collect()}
    assert rows["BETA"].valeur_fonciere == 123456792.0
    assert rows["GAMMA"].valeur_fonciere == 0.0
    # Bad text gives NULL, then 0, and never an error; a bad date stays NULL.
    assert rows["DELTA"].date_mutation is None
    assert rows["DELTA"].surface_reelle_bati == 0.0
    assert rows["DELTA"].nombre_pieces_principales == 0
    assert rows["GAMMA"].date_mutation == date(2020, 2, 29)


def test_each_bad_number_gets_its_default(spark):
    good = ("05/11/2022", "Vente", "1234,5", "33000", "BORDEAUX", "Local", "12,25", "3", "mutations")
    cases = {"valeur_fonciere": None, "surface_reelle_bati": "NaN m2", "nombre_pieces_principales": "3 pieces", "date_mutation": "2022"}
    rows = [good] + [tuple(cases[c] if c == name else v for c, v in zip(BRONZE.fieldNames(), good)) for name in cases]
    text = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BRONZE.fieldNames()))
    text = text.withColumns({c: F.replace(c, F.lit(","), F.lit(".")) for c in ("valeur_fonciere", "surface_reelle_bati")})
    filled = [r.asDict() for r in clean.fill_defaults(clean.typed(text)).collect()]
    whole = filled[0]
    assert (whole["valeur_fonciere"], whole["surface_reelle_bati"], whole["nombre_pieces_principales"]) == (1234.5, 12.25, 3)
    for name, row in zip(cases, filled[1:]):
        changed = {c for c in row if row[c] != whole[c]}
        assert changed == {name} and row[name] in (0, None)


def test_broken_json_is_kept_as_nulls_and_null_payload_goes(spark):
    sent = spark.createDataFrame([('{"commune":"A","nombre_pieces_principales":3}',), ("garbage",), (None,)], "value string")
    parsed = messages.parse_messages(sent).collect()
    assert sorted((r.commune or "", r.nombre_pieces_principales or "") for r in parsed) == [("", ""), ("A", "3")]
    good, bad = messages.split_corrupt(sent)
    assert [r.commune for r in good.collect()] == ["A"]
    assert [r.value for r in bad.collect()] == ["garbage"]


def test_date_repair_counts(spark):
    df = spark.createDataFrame([("1/2/2020",), ("2020-01-01",), (None,), ("31/12/2021",)], "date_mutation string")
    repaired = clean.repair_dates(df)
    assert tuple(clean.repair_counts(repaired).first()) == (2, 2)
    assert date(2020, 2, 1) in [r.date_mutation for r in repaired.collect()]


def test_scalar_helpers(spark):
    row = _one(
        spark,
        numeric.half_even(F.lit(2.5)).alias("a"),
        numeric.half_even(F.lit(0.125), 2).alias("b"),
        text.zero_pad(F.lit("1230"), 5).alias("c"),
        text.zero_pad(F.lit("123456"), 5).alias("d"),
        text.department(F.lit("1230")).alias("e"),
        F.weekday(F.lit("2024-01-01")).alias("f"),
        dates.move_to_year(F.to_date(F.lit("2020-02-29")), 2025).alias("g"),
        text.department(F.lit(None).cast("string")).alias("h"),
    )
    assert tuple(row) == (2.0, 0.12, "01230", "123456", "01", 0, date(2025, 2, 28), None)
    name, count = text.split_label(F.lit("BOURG (EN) (16)"))
    assert tuple(_one(spark, name.alias("n"), count.alias("c"))) == ("BOURG (EN)", 16)


def test_whole_flow_twice_gives_the_same_layers(spark, tmp_path):
    folder = _files(tmp_path)
    layers = Layers(str(tmp_path / "warehouse"))
    sizes = []
    for _ in range(2):
        load_bronze(spark, f"{folder}/*.txt", layers)
        silver = load_silver(spark, layers, 2020, 2022, date(2025, 1, 1))
        star = load_gold(spark, layers)
        graph = load_graph(spark, layers)
        kpis = load_key_values(spark, layers)
        sizes.append((silver.count(), star.transactions.count(), graph.a_enregistre.count(), kpis.count()))
    # ALPHA once, BETA, GAMMA; DELTA has no date. GAMMA is priced 0 and not in the graph.
    assert sizes[0] == sizes[1] == (3, 3, 2, 7)
    assert spark.sql("SELECT sum(nb_ventes) FROM cube_ventes").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM dl_gold_transactions_detaillees").first()[0] == 3


def test_months_are_pruned(spark, tmp_path):
    folder = _files(tmp_path)
    layers = Layers(str(tmp_path / "w"))
    load_bronze(spark, f"{folder}/ventes-2020.txt", layers)
    load_silver(spark, layers, 2020, 2022, date(2025, 1, 1))
    df = tables.read_months(spark, layers.path("silver"), "2020-02-01", "2020-03-01")
    assert [r.commune for r in df.collect()] == ["GAMMA"]
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(annee" in plan and "GreaterThanOrEqual(date_mutation" in plan


def test_rows_of_the_fixture_are_complete():
    assert all(len(r) == 8 for r in RAW_ROWS)
