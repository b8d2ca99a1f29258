"""Jobs: clean, analyse, score risk, train, publish.

Each job takes a session and an output folder, writes Parquet (plus small JSON
records) and returns what it wrote. Row counts of outputs come from the written
files, never from running a plan a second time.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.ml import evaluation, features, inference, training
from netvigil.operators import distributions, hosts, risk, rollup, timeline
from netvigil.operators.clean import observed_clean, observed_funnel
from netvigil.session import at_once, materialize
from netvigil.sinks import tables, versions
from netvigil.sources.documents import table_or_none
from netvigil.sources.flows import read_flows, read_raw_records

PIPELINE_VERSION = "phase10"

# Names of the outputs and of the collections they are published as.
CLEAN, FEATURES = "cleaned_logs.parquet", "features.parquet"
STATISTICS = {
    "attack_distribution.parquet": distributions.attack_distribution,
    "protocol_distribution.parquet": distributions.protocol_distribution,
    "hourly_attack_intensity.parquet": timeline.hourly_attack_intensity,
    "severity_distribution.parquet": distributions.severity_distribution,
}
TIMELINES = {
    "network_timeline_hourly.parquet": timeline.hourly_timeline,
    "network_timeline_daily.parquet": timeline.daily_cadence,
    "attack_surge_windows.parquet": timeline.surge_windows,
}
HOSTS = {
    "top_attacking_ips.parquet": hosts.top_attacking_ips,
    "top_targeted_ips.parquet": hosts.top_targeted_ips,
    "ip_attack_crosstab.parquet": hosts.ip_attack_crosstab,
}
RISK = "ip_risk_scores.parquet"
# Groups of reports that are made from one rollup.
PROFILE, PAIRS = "profile", "pairs"
PUBLISHED = {
    "attack_stats": "attack_distribution.parquet",
    "protocol_stats": "protocol_distribution.parquet",
    "hourly_stats": "hourly_attack_intensity.parquet",
    "severity_stats": "severity_distribution.parquet",
    "ip_threat_frequency": "top_attacking_ips.parquet",
    "top_targeted_ips": "top_targeted_ips.parquet",
    "timeline_stats": "network_timeline_hourly.parquet",
    "ip_reputation": RISK,
}

def run_etl(spark: SparkSession, raw_path: str, out: str) -> DataFrame:
    """Raw CSV to clean flows, feature vectors and label map; returns the cleaning funnel.

    The logs are parsed once: the funnel is observed while the clean flows are written.
    """
    clean, counts = observed_clean(read_raw_records(spark, raw_path))
    flows = tables.write_table(clean, f"{out}/{CLEAN}")
    funnel = observed_funnel(spark, counts)
    run_features(spark, flows, out)
    return funnel


def run_features(spark: SparkSession, flows: DataFrame, out: str) -> PipelineModel:
    model = features.fit_features(flows)
    model.write().overwrite().save(f"{out}/feature_model")
    features.label_map(spark, model).coalesce(1).write.mode("overwrite").json(f"{out}/label_mapping.json")
    tables.write_table(features.feature_table(model, flows), f"{out}/{FEATURES}")
    return model


def write_reports(source: DataFrame, reports: dict, out: str) -> dict[str, DataFrame]:
    write = lambda name: tables.write_table(reports[name](source), f"{out}/{name}")
    return dict(zip(reports, at_once(source.sparkSession, write, reports)))


def run_profile_reports(spark: SparkSession, flows: DataFrame, out: str) -> dict[str, DataFrame]:
    """The seven class, protocol, severity and time reports from one scan of the flows."""
    return write_reports(materialize(rollup.profile_rollup(flows), "profile"), STATISTICS | TIMELINES, out)


def run_host_reports(pairs: DataFrame, out: str) -> dict[str, DataFrame]:
    """The three host reports from a written pair rollup."""
    return write_reports(pairs, HOSTS, out)


def run_risk(pairs: DataFrame, out: str) -> DataFrame:
    """Risk table from a pair rollup (or flows), plus a copy sorted for point lookups."""
    scored = tables.write_table(risk.ip_risk_scores(pairs), f"{out}/{RISK}")
    tables.write_lookup(scored, f"{out}/ip_risk_lookup.parquet")
    return scored


def lookup(spark: SparkSession, out: str, ip: str) -> DataFrame:
    return risk.lookup_ip(spark.read.parquet(f"{out}/ip_risk_lookup.parquet"), ip)


def run_analytics(spark: SparkSession, flows: DataFrame, out: str, serving: bool = False) -> DataFrame:
    """All reports and the run summary; two scans of the flows in total."""
    outputs = run_profile_reports(spark, flows, out)
    pairs = materialize(rollup.pair_rollup(flows), "pairs")
    outputs |= run_host_reports(pairs, out)
    outputs["ip_risk_scores.parquet"] = run_risk(pairs, out)
    for group in (PROFILE, PAIRS):
        record_input(flows, out, group)
    if serving:
        versions.publish({collection: outputs[name] for collection, name in PUBLISHED.items()}, f"{out}/serving")
    summary = tables.run_summary(outputs, flows)
    summary.coalesce(1).write.mode("overwrite").json(f"{out}/attack_stats_summary.json")
    return summary


@dataclass
class TrainingRun:
    """Both classifiers with their outcome counts on the held-out flows."""

    features: PipelineModel
    trained: dict[str, training.Trained]
    outcomes: dict[str, DataFrame]

    @property
    def metrics(self) -> DataFrame:
        return evaluation.model_metrics(self.outcomes, {kind: t.seconds for kind, t in self.trained.items()})

    def best(self) -> str:
        """Name of the classifier with the higher F1."""
        return self.metrics.where("best").first()["model"]

    def scorer(self, kind: str) -> PipelineModel:
        return training.scoring_pipeline(self.features, self.trained[kind])

    def matrix(self, kind: str) -> DataFrame:
        return evaluation.confusion_matrix(self.outcomes[kind], features.class_labels(self.features))

    def report(self, kind: str) -> DataFrame:
        return evaluation.class_report(
            self.outcomes[kind], features.label_map(self.outcomes[kind].sparkSession, self.features))


def train_models(table: DataFrame, feature_model: PipelineModel) -> TrainingRun:
    """Train both classifiers on a feature table and score its held-out part once per model."""
    kinds = (training.DECISION_TREE, training.RANDOM_FOREST)
    trained = {kind: training.train(features.training_part(table), kind) for kind in kinds}
    held_out = features.test_part(table)
    outcomes = {
        kind: materialize(evaluation.outcome_counts(t.model.transform(held_out)), "outcomes")
        for kind, t in trained.items()
    }
    return TrainingRun(feature_model, trained, outcomes)


def run_training(spark: SparkSession, out: str) -> TrainingRun:
    """Train, save the better model, and write metrics, confusion matrix and class report."""
    run = train_models(spark.read.parquet(f"{out}/{FEATURES}"), PipelineModel.load(f"{out}/feature_model"))
    best = run.best()
    training.save_model(run.scorer(best), f"{out}/threat_model")
    written = {"model_metrics": run.metrics, "confusion_matrix": run.matrix(best), "class_report": run.report(best)}
    for name, table in written.items():
        table.coalesce(1).write.mode("overwrite").json(f"{out}/{name}.json")
    return run


def run_evaluation(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """Confusion matrix and class report of the saved model on the held-out flows."""
    model = training.load_model(f"{out}/threat_model")
    held_out = features.held_out_flows(read_flows(spark, f"{out}/{CLEAN}"))
    outcomes = materialize(evaluation.outcome_counts(model.transform(held_out)), "outcomes")
    names, labels = features.class_labels(model), features.label_map(spark, model)
    return evaluation.confusion_matrix(outcomes, names), evaluation.class_report(outcomes, labels)


def input_version(table: DataFrame) -> str:
    """A name for the files that a table is read from; every write gives its files new names."""
    return hashlib.sha256("\n".join(sorted(table.inputFiles())).encode()).hexdigest()


def record_input(flows: DataFrame, out: str, group: str) -> None:
    """Note which clean table a group of reports was made from, after they are written."""
    flows.sparkSession.range(1).select(F.lit(input_version(flows)).alias("input")).coalesce(1).write.mode("overwrite").json(
        f"{out}/inputs/{group}")


def is_stale(flows: DataFrame, out: str, group: str) -> bool:
    """Whether a group of reports was made from other files than the clean table has now."""
    noted = table_or_none(flows.sparkSession, f"{out}/inputs/{group}", "json", "input string")
    row = None if noted is None else noted.first()
    return row is None or row["input"] != input_version(flows)


def missing_outputs(spark: SparkSession, out: str, names) -> list[str]:
    return [name for name in names if table_or_none(spark, f"{out}/{name}") is None]


def ensure_outputs(spark: SparkSession, out: str, force: bool = False) -> None:
    """Rebuild the reports that publishing needs, if any is missing or older than the clean table, or on demand."""
    flows = read_flows(spark, f"{out}/{CLEAN}")
    missing = set(missing_outputs(spark, out, PUBLISHED.values()))
    due = lambda group, names: force or missing & set(names) or is_stale(flows, out, group)
    if due(PROFILE, STATISTICS | TIMELINES):
        run_profile_reports(spark, flows, out)
        record_input(flows, out, PROFILE)
    if due(PAIRS, {*HOSTS, RISK}):
        pairs = materialize(rollup.pair_rollup(flows), "pairs")
        run_host_reports(pairs, out)
        run_risk(pairs, out)
        record_input(flows, out, PAIRS)


def publish(spark: SparkSession, out: str, force: bool = False) -> DataFrame:
    """Refresh all serving tables in one step, then the mirrors; returns the manifest, which is published with them."""
    ensure_outputs(spark, out, force)
    reports = {collection: spark.read.parquet(f"{out}/{name}") for collection, name in PUBLISHED.items()}
    manifest = ("integration_log", lambda refreshed: tables.integration_manifest(refreshed, PIPELINE_VERSION))
    published = versions.publish(reports | model_results(spark, out), f"{out}/serving", manifest)
    at_once(spark, lambda name: tables.json_mirror(published[name], f"{out}/{name}.json"), [n for n in PUBLISHED if n in published])
    return published["integration_log"]


def model_results(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Predictions of all flows and the metrics document, once a model has been trained."""
    metrics = table_or_none(spark, f"{out}/model_metrics.json", "json")
    if metrics is None:
        return {}
    document = evaluation.metrics_document(
        metrics,
        spark.read.json(f"{out}/confusion_matrix.json"),
        spark.read.json(f"{out}/class_report.json"),
    )
    predictions = inference.predict(read_flows(spark, f"{out}/{CLEAN}"), training.load_model(f"{out}/threat_model"))
    return {
        "predictions": tables.stamped(predictions),
        "model_metrics": document,
    }


def run_all(spark: SparkSession, raw_path: str, out: str) -> DataFrame:
    """Everything in order; returns the manifest of the published collections."""
    run_etl(spark, raw_path, out)
    run_analytics(spark, read_flows(spark, f"{out}/{CLEAN}"), out)
    run_training(spark, out)
    return publish(spark, out)
