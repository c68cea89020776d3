import glob
import json

import pytest

from asphalt.checks import queries, views
from asphalt.operators import features, models, quality
from asphalt.plans.prepare import prepare
from asphalt.plans.run import RunConfig, load_config, run
from asphalt.sources.accidents import read_prepared, scan_csv
from asphalt.sources.results import geojson_features

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def csv(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("csv") / "raw")
    views.load_raw(spark, SMALL).write.option("header", True).csv(folder)
    return folder


def test_csv_comes_back_as_written_and_bad_cells_are_null(spark, csv, tmp_path):
    written, read = views.load_raw(spark, SMALL), scan_csv(spark, csv)
    assert read.columns == written.columns and read.count() == written.count()
    assert read.where("Severity is null").count() == written.where("Severity is null").count()
    lines = open(glob.glob(f"{csv}/part-*")[0], encoding="utf-8").read().splitlines()[:2]
    cells = lines[1].split(",")
    cells[2] = "severe"
    bad = tmp_path / "bad.csv"
    bad.write_text("\n".join([lines[0], ",".join(cells)]), encoding="utf-8")
    assert scan_csv(spark, str(bad)).first()["Severity"] is None


def test_prepare_writes_readable_tables(spark, csv, tmp_path):
    folder = str(tmp_path / "out")
    prepare(scan_csv(spark, csv), folder, cap=100)
    sample = read_prepared(spark, folder, "accidents_sample")
    assert sample.groupBy("state").count().agg({"count": "max"}).first()[0] == 100
    zones, years = read_prepared(spark, folder, "zones"), read_prepared(spark, folder, "zones_year")
    assert zones.agg({"n_accidents": "sum"}).first()[0] == years.agg({"n": "sum"}).first()[0]
    hours = read_prepared(spark, folder, "quand_hour")
    rows = read_prepared(spark, folder, "accidents").count()
    assert hours.where("state = 'US'").agg({"n": "sum"}).first()[0] == rows
    plan = zones.where("state = 'S3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in plan
    before = sample.count()
    prepare(scan_csv(spark, csv), folder, cap=5)
    assert read_prepared(spark, folder, "accidents_sample").count() == before


def test_sinks_clean_the_raw_table_once(spark, monkeypatch):
    written = []

    def counted(raw, folder, cap=None, write=queries.prepare):
        written.append(folder)
        write(raw, folder, cap)

    monkeypatch.setattr(queries, "prepare", counted)
    found = {r["sink"]: r["n"] for r in queries.sinks(spark, SMALL).collect()}
    rows = queries.clean_table(spark, SMALL).count()
    assert found["prepared"] == found["summary"] == rows and found["sample"] > 1000
    assert len(written) == 1


def config(csv, folder, **switches):
    return {
        "donnees": {"csv": csv, "territoire": "S3", "perimetre_entrainement": "us"},
        "sorties": {"dossier": folder, "prefixe": "p_"}, "analyses": switches,
        "parametres": {"zones_prioritaires": 20, "min_effectif": 20, "lift_min": 1.1, "actions_distinctes": 1,
                       "periode_ancienne": [1995, 1997], "periode_recente": [1998, 2001]},
        "modele": {"algorithme": "logistic", "hyperparametres": {"C": 1.0}, "split_temporel": {"train_avant": 2000},
                   "effets": {"odds_ratios": False}},
    }


def test_run_follows_its_switches(spark, csv, tmp_path):
    folder = str(tmp_path / "when")
    summary = run(spark, RunConfig.from_mapping(config(csv, folder, quand=True)))
    assert set(summary["analyses"]) == {"quand"}
    assert {p.rsplit("/", 1)[1] for p in glob.glob(folder + "/*")} == {
        "p_accidents", "p_quand_heure.csv", "p_quand_meteo.csv", "p_quand_evenement.csv", "p_resume.json"}


def test_synthesis_brings_in_zones_and_model(spark, csv, tmp_path):
    folder, roads = str(tmp_path / "all"), str(tmp_path / "roads")
    views.load(spark, SMALL, "road_segments").write.parquet(roads)
    raw = config(csv, folder, synthese=True, quoi=True, validation=True, profil=True)
    raw["donnees"]["troncons"] = roads
    path = tmp_path / "run.json"
    path.write_text(json.dumps(raw), encoding="utf-8")
    summary = run(spark, load_config(str(path)))
    assert set(summary["analyses"]) == {"quoi", "synthese", "validation"}
    for name in ("profil_manquants", "profil_couverture", "validation_stabilite", "validation_retrospective", "synthese_ecran"):
        assert spark.read.option("header", True).csv(f"{folder}/p_{name}.csv").count() > 0
    assert spark.read.option("header", True).csv(f"{folder}/p_validation_exposition.csv").count() > 0
    plan = spark.read.option("header", True).option("inferSchema", True).csv(f"{folder}/p_synthese_recommandations.csv")
    assert plan.count() == summary["analyses"]["synthese"]["zones"] <= 20
    quality.require(quality.plan_violations(plan, distinct_actions=1))
    full = spark.read.option("header", True).option("inferSchema", True).csv(f"{folder}/p_zones_prioritaires.csv")
    assert {"type_zone", "street_km", "equip_present"} <= set(full.columns)
    written = json.loads(open(glob.glob(f"{folder}/p_resume.json/part-*")[0], encoding="utf-8").read())
    assert written["analyses"]["quoi"]["pr_auc"] == summary["analyses"]["quoi"]["pr_auc"]
    assert not glob.glob(folder + "/p_ou_*")


def test_run_file_switches_place_history_on(spark, csv, tmp_path, monkeypatch):
    raw = config(csv, str(tmp_path / "with"), quoi=True)
    raw["modele"] |= {"historique_lieu": True, "poids_historique": 10, "effets": {"odds_ratios": False, "g_computation": False}}
    given = RunConfig.from_mapping(raw)
    assert given.model.place_history and given.limits.history_weight == 10.0
    fitted, fit = [], models.fit
    monkeypatch.setattr(models, "fit", lambda rows, choice: fitted.append((rows.columns, choice)) or fit(rows, choice))
    assert run(spark, given)["analyses"]["quoi"]["pr_auc"] > 0
    columns, choice = fitted[0]
    assert set(features.history_columns()) <= set(columns) and choice.place_history


def test_unknown_settings_are_refused(csv, tmp_path):
    raw = config(csv, str(tmp_path), quoi=True)
    raw["parametres"]["seuil"] = 3
    raw["modele"]["effets"]["tout"] = True
    with pytest.raises(ValueError, match="effets.tout, parametres.seuil"):
        RunConfig.from_mapping(raw)


def test_unknown_algorithm_stops_before_reading(csv, tmp_path):
    raw = config(csv, str(tmp_path), quoi=True)
    raw["modele"]["algorithme"] = "svm"
    with pytest.raises(ValueError, match="unknown algorithm"):
        RunConfig.from_mapping(raw)


def test_geojson_is_a_closed_polygon(spark):
    zones = spark.createDataFrame([("8:-14318:5554", 7)], "cell string, charge long")
    feature = json.loads(geojson_features(zones, ["charge"]).first()["value"])
    ring = feature["geometry"]["coordinates"][0]
    assert feature["type"] == "Feature" and ring[0] == ring[-1] and len(ring) == 7
    assert feature["properties"]["charge"] == 7 and 32 < feature["properties"]["centre_lat"] < 34.5
