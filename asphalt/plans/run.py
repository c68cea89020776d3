"""Configurable batch analysis: profile, when, where, validation, what and the synthesis.

    spark-submit -m asphalt.plans.run --config FILE

The file is JSON, or YAML where PyYAML is installed.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asphalt import labels
from asphalt.operators import (
    cleaning, effects, exposure, features, metrics, models, profile, quality, recommend, validation, when, zones,
)
from asphalt.plans.decide import recommended_zones, screen_plan
from asphalt.schema import PREPARED_COLUMNS, ModelChoice, Thresholds
from asphalt.session import job_session, materialise
from asphalt.sources.accidents import read_prepared, road_segments, scan_csv
from asphalt.sources.results import write_csv, write_geojson, write_prepared, write_summary

ANALYSES = ("quand", "ou", "quoi", "synthese", "profil", "validation")
# The sections and keys of a run file.
KEYS = {
    "donnees": {"csv", "territoire", "perimetre_entrainement", "troncons"},
    "sorties": {"dossier", "prefixe"},
    "spark": {"memoire"},
    "analyses": set(ANALYSES),
    "parametres": {
        "seuil_grave", "h3_resolution", "zones_prioritaires", "lift_min", "presence_min", "min_effectif",
        "actions_distinctes", "periode_ancienne", "periode_recente",
    },
    "modele": {
        "algorithme", "lignes_max", "class_weight_balanced", "split_temporel", "hyperparametres", "effets",
        "historique_lieu", "poids_historique",
    },
    "effets": {"odds_ratios", "g_computation", "echantillon_gcomp"},
}
# ``memoire`` and ``echantillon_gcomp`` are known but set nothing: memory belongs to the submission, effects use all rows.


@dataclass(frozen=True)
class RunConfig:
    csv: str
    folder: str
    state: str | None = None
    segments: str | None = None
    prefix: str = ""
    analyses: frozenset[str] = frozenset(ANALYSES)
    limits: Thresholds = field(default_factory=Thresholds)
    model: ModelChoice = field(default_factory=ModelChoice)
    odds_ratios: bool = True
    g_computation: bool = True

    @classmethod
    def from_mapping(cls, raw: Mapping) -> RunConfig:
        """Read the sections of a run file. Key names are fixed values of its format."""
        _refuse_unknown(raw)
        data, out, wanted = raw["donnees"], raw["sorties"], raw.get("analyses", {})
        given, model = raw.get("parametres", {}), raw.get("modele", {})
        chosen = frozenset(name for name in ANALYSES if wanted.get(name))
        names = {
            "severe_from": "seuil_grave", "resolution": "h3_resolution", "top_zones": "zones_prioritaires",
            "lift_min": "lift_min", "presence_min": "presence_min", "min_rows": "min_effectif",
            "distinct_actions": "actions_distinctes",
        }
        limits = {ours: given[theirs] for ours, theirs in names.items() if theirs in given}
        for ours, theirs in {"early": "periode_ancienne", "late": "periode_recente"}.items():
            if theirs in given:
                limits[ours] = tuple(given[theirs])
        if "poids_historique" in model:
            limits["history_weight"] = float(model["poids_historique"])
        if "train_avant" in model.get("split_temporel", {}):
            limits["test_from"] = model["split_temporel"]["train_avant"]
        shown = model.get("effets") or {}
        algorithm = model.get("algorithme", "hist_gradient_boosting")
        params = model.get("hyperparametres") or {}
        models.check_choice(algorithm, params)
        return cls(
            csv=data["csv"], folder=out["dossier"], state=data.get("territoire"),
            segments=data.get("troncons"), prefix=out.get("prefixe", ""),
            analyses=chosen, limits=Thresholds(**limits),
            model=ModelChoice(
                algorithm=algorithm, params=params, balanced=bool(model.get("class_weight_balanced", True)),
                scope=data.get("perimetre_entrainement", "us"), max_rows=model.get("lignes_max"),
                place_history=bool(model.get("historique_lieu", False)),
            ),
            odds_ratios=shown.get("odds_ratios", True), g_computation=shown.get("g_computation", True),
        )

    @property
    def needs_zones(self) -> bool:
        return bool(self.analyses & {"ou", "synthese", "validation"})

    @property
    def needs_model(self) -> bool:
        return bool(self.analyses & {"quoi", "synthese"})


def _refuse_unknown(raw: Mapping) -> None:
    """Name what a run file sets that no part reads."""
    sections = {**{k: v or {} for k, v in raw.items()}, "effets": (raw.get("modele") or {}).get("effets") or {}}
    unknown = [s for s in raw if s not in KEYS or s == "effets"]
    unknown += [f"{s}.{key}" for s, given in sections.items() if s in KEYS for key in given if key not in KEYS[s]]
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")


def load_config(path: str) -> RunConfig:
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if path.endswith(".json"):
        return RunConfig.from_mapping(json.loads(text))
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("install PyYAML or give the configuration as JSON") from error
    return RunConfig.from_mapping(yaml.safe_load(text))


class Run:
    """One run over a clean accident table; every part writes its files."""

    def __init__(self, accidents: DataFrame, config: RunConfig):
        self.accidents, self.config = accidents, config
        self.spark = accidents.sparkSession

    def _csv(self, df: DataFrame, name: str) -> None:
        write_csv(df, self.config.folder, self.config.prefix + name)

    def when(self) -> dict:
        counts = materialise(when.event_counts(self.accidents, "hour", "weather_bucket"))
        hourly = when.shares_of(counts, "hour")
        self._csv(hourly.orderBy("hour"), "quand_heure.csv")
        self._csv(when.shares_of(counts, "weather_bucket").orderBy(F.desc("n")), "quand_meteo.csv")
        self._csv(when.events_of(counts), "quand_evenement.csv")
        peak = when.peak_hour(hourly).first()
        return {"heure_max_grave": peak["peak_hour"], "pct_max": peak["pct_max"]}

    def where(self) -> DataFrame:
        """Zones of the territory, computed once; files only if asked for."""
        limits, config = self.config.limits, self.config
        table = materialise(zones.zone_table(cleaning.territory(self.accidents, config.state), limits.resolution, keys=()))
        if "ou" in config.analyses:
            top = zones.priority_with_share(table, limits.top_zones)
            counts = [c for c in table.columns if c.startswith("n_") and c != "n_accidents"]
            columns = ["rank", "cell", "n_accidents", "avg_severity", "charge", *counts, "charge_share"]
            self._csv(top.select(*columns).orderBy("rank"), "ou_zones_prioritaires.csv")
            write_geojson(top, ["rank", "n_accidents", "charge"], config.folder, config.prefix + "ou_carte.geojsonl", limits.resolution)
            zones.concentration(table).write.mode("overwrite").option("header", True).csv(
                f"{config.folder}/{config.prefix}ou_concentration.csv")
        return table

    def profile(self) -> None:
        """Missing values of the raw file, and volume, severity and flags of the clean table."""
        raw = cleaning.normalise_names(scan_csv(self.spark, self.config.csv))
        self._csv(profile.missing_rate(raw), "profil_manquants.csv")
        self._csv(profile.coverage(self.accidents), "profil_couverture.csv")
        self._csv(profile.severity_distribution(self.accidents), "profil_gravite.csv")
        self._csv(profile.infra_delta(self.accidents), "profil_equipements.csv")

    def validate(self, table: DataFrame) -> dict:
        """Does the ranking hold over time, against exposure and on later years?"""
        limits, config = self.config.limits, self.config
        here = cleaning.territory(self.accidents, config.state)
        burdens = materialise(validation.period_burdens(here, limits.early, limits.late, limits.resolution))
        stable = validation.stability(burdens)
        self._csv(stable, "validation_stabilite.csv")
        self._csv(validation.still_on_top(burdens, limits.top_zones), "validation_maintien.csv")
        years = zones.zone_years(here, limits.resolution, keys=())
        self._csv(validation.backtest(years, limits.top_zones, limits.test_from - 1, limits.test_from), "validation_retrospective.csv")
        if config.segments:
            roads = exposure.road_exposure(road_segments(self.spark, config.segments), limits.resolution)
            moved = exposure.rank_movement(exposure.with_exposure(table, roads))
            moved.select("cell", "rank_charge", "rank_per_km", "movement").write.mode("overwrite").option("header", True).csv(
                f"{config.folder}/{config.prefix}validation_exposition.csv")
        row = stable.first()
        return {"n": row["n"], "rho": _digits(row["rho"], 4), "p_value": _digits(row["p_value"], 6)}

    def what(self) -> tuple[dict, DataFrame | None]:
        """Fit, measure and explain; the last result is the scores per flag pattern, for effects."""
        config = self.config
        train, test = models.split_for(
            self.accidents, config.model, config.limits.test_from, config.state, config.limits.history_weight)
        quality.require(quality.leak_violations(self.accidents, train, test, config.limits.test_from))
        rows = models.training_rows(train, config.model.place_history)
        try:
            n_train = rows.agg(features.row_count(rows)).first()[0] or 0
            model = models.fit(rows, config.model)
            odds = effects.odds_ratios(rows) if config.odds_ratios and "quoi" in config.analyses else None
        finally:
            rows.unpersist()
        scored = metrics.kept_scores(models.scored_rows(model, test))
        quality_row = metrics.evaluate(scored).first()
        found = {
            "algorithme": model.algorithm, "n_train": n_train, "n_test": quality_row["n"],
            "pr_auc": _digits(quality_row["pr_auc"], 4), "roc_auc": _digits(quality_row["roc_auc"], 4),
            "plancher_pr_auc": _digits(quality_row["baseline"], 4), "rappel_grave@0.5": _digits(quality_row["recall"], 3),
        }
        wants_effects = "quoi" in config.analyses and config.g_computation
        patterns = None
        if wants_effects or "synthese" in config.analyses:
            patterns = materialise(effects.score_patterns(model.prepare(test), model.score))
        if "quoi" in config.analyses:
            metrics.pr_curve(scored).write.mode("overwrite").option("header", True).csv(
                f"{config.folder}/{config.prefix}quoi_courbe_pr.csv")
            self._csv(metrics.confusion(scored), "quoi_confusion.csv")
            if config.g_computation:
                adjusted = effects.adjusted_of(patterns)
                self._csv(adjusted.orderBy("delta"), "quoi_effets_ajustes.csv")
                if odds is not None:
                    self._csv(effects.concordance(odds, adjusted).orderBy("element"), "quoi_concordance.csv")
            if odds is not None:
                decimals = [F.bround(c, 4).alias(c) for c in ("odds_ratio", "lo", "hi")]
                self._csv(odds.select("element", *decimals).orderBy("odds_ratio"), "quoi_odds_ratios.csv")
        return found, patterns

    def synthesis(self, table: DataFrame, patterns: DataFrame) -> dict:
        limits = self.config.limits
        conditional = materialise(effects.conditional_of(patterns, limits.min_rows))
        done = materialise(recommended_zones(table, conditional, limits, weight="count", wording=labels.JOB_WORDING))
        quality.require(quality.plan_violations(done, limits.distinct_actions))
        decimals = {c: 3 for c in ("avg_severity", "lift", "impact_graves_evites")}
        plan = recommend.final_plan(done, decimals).drop("equip_present")
        self._csv(plan, "synthese_recommandations.csv")
        here = cleaning.territory(self.accidents, self.config.state)
        self._csv(screen_plan(table, conditional, here, limits), "synthese_ecran.csv")
        if self.config.segments:
            roads = road_segments(self.spark, self.config.segments)
            full = recommended_zones(table, conditional, limits, roads)
            self._csv(recommend.final_plan(full), "zones_prioritaires.csv")
        total = done.agg(F.count("*").alias("zones"), F.sum("impact_graves_evites").alias("impact")).first()
        return {"zones": total["zones"], "impact_total_graves_evites": _digits(total["impact"], 1)}

    def all(self) -> dict:
        """Run what is switched on; the synthesis brings in zones and model by itself."""
        config, found = self.config, {}
        quality.require(quality.clean_violations(self.accidents))
        if "quand" in config.analyses:
            found["quand"] = self.when()
        if "profil" in config.analyses:
            self.profile()
        table = self.where() if config.needs_zones else None
        if "validation" in config.analyses and not table.isEmpty():
            found["validation"] = self.validate(table)
        patterns = None
        if config.needs_model:
            found["quoi"], patterns = self.what()
        if "synthese" in config.analyses and not table.isEmpty():
            found["synthese"] = self.synthesis(table, patterns)
        summary = {"territoire": config.state, "analyses": found}
        write_summary(self.spark, summary, config.folder, config.prefix + "resume.json")
        return summary


def _digits(value: float | None, digits: int) -> float | None:
    return None if value is None else round(float(value), digits)


def run(spark: SparkSession, config: RunConfig) -> dict:
    raw = cleaning.normalise_names(scan_csv(spark, config.csv))
    cleaned = cleaning.clean(raw, config.limits.severe_from).select("start_time", *PREPARED_COLUMNS)
    # Text is parsed once. The written table gives every part its columns and the territory its folder.
    table = config.prefix + "accidents"
    write_prepared(cleaned, config.folder, table, by="state")
    return Run(read_prepared(spark, config.folder, table, cleaned.schema), config).all()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", required=True)
    config = load_config(parser.parse_args().config)
    spark = job_session("road risk")
    print(json.dumps(run(spark, config), ensure_ascii=False, indent=2))
    spark.stop()


if __name__ == "__main__":
    main()
