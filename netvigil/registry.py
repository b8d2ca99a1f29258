"""Named queries over the driver tables.

Every query starts from the whole ``events`` table through the flow adapter
(``table_counts`` reads all tables). Queries are lazy except where the operator
itself is a sink, a stream or a model fit.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.ml import evaluation, features, inference, training, trees
from netvigil.operators import (
    clean, distributions, enrich, entropy, graph, graph_depth, hosts, quality, risk, rollup, sharding, timeline, verdicts,
)
from netvigil.operators import networks as net
from netvigil.plans import jobs
from netvigil.session import at_once, fresh_path, materialize
from netvigil.sinks import tables, versions
from netvigil.sources import documents, flows as flow_source
from netvigil.sources.events import raw_flows_from_events
from netvigil.sources.versions import read_current, read_published
from netvigil.streaming import flows as streams
from netvigil.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
                 "benchmark labels conversations").split()
LOOKUP_IP = "172.16.1.5"
# Rule texts for the query; a site brings its own.
RULES = [(name, f"{name} firewall rule for {{IP}}", f"{name} detection rule for {{IP}}", f"{name} route {{HASH}} for {{IP}}")
         for name in ("PortScan", "DDoS", "BruteForce", "Botnet", "BENIGN")]
PREVIEW = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean flows as a written table, for queries that read them in several branches."""
    return materialize(flows(spark, sf_dir), "clean")


def written_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(rollup.pair_rollup(flows(spark, sf_dir)), "pairs")


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_flows_from_events(table(spark, sf_dir, "events"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_flows(raw_flows(spark, sf_dir))


def on_raw(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(raw_flows(spark, sf_dir))


def on_flows(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(flows(spark, sf_dir))


def on_risk(op: Callable[[DataFrame], DataFrame]) -> Query:
    return on_flows(lambda f: op(risk.ip_risk_scores(f, ordered=False)))


def on_distribution(op: Callable[[DataFrame], DataFrame]) -> Query:
    return on_flows(lambda f: op(distributions.attack_distribution(f)))


def on_geo(op: Callable[[DataFrame], DataFrame]) -> Query:
    return on_risk(lambda r: op(enrich.geo_enriched(r)))


# --- sources -----------------------------------------------------------------

# Networks for the query: nested prefixes from the given tables, some of them named twice. Per table: network, name, key.
NETWORKS = {
    "region": ("""CASE r_regionkey WHEN 0 THEN '10.0.0.0/8' WHEN 1 THEN '172.16.0.0/12' WHEN 2 THEN '172.16.1.4/30'
        WHEN 3 THEN '172.16.1.9/32' ELSE 'none' END""", "r_name", "r_regionkey"),
    "nation": ("concat('10.', n_nationkey % 4, '.', n_nationkey * 8, '.77/21')", "n_name", "100 + n_nationkey"),
    "supplier": ("concat('10.', s_suppkey % 8, '.', s_suppkey * 37 % 256, '.0/24')", "s_name", "1000 + s_suppkey"),
    "customer": ("concat('10.', c_custkey % 8, '.', c_custkey % 256, '.', c_custkey % 8 * 32, '/27')", "c_name", "100000 + c_custkey"),
}


def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A network table derived from the given rows."""
    parts = [table(spark, sf_dir, name).selectExpr(
        f"{network} AS network", f"{label} AS country", f"substr({label}, 1, 3) AS country_code", f"concat('City of ', {label}) AS city",
        f"CAST({key} AS DOUBLE) / 4 AS latitude", f"CAST({key} AS DOUBLE) / 8 AS longitude", f"concat('AS', {key}) AS asn")
        for name, (network, label, key) in NETWORKS.items()]
    return reduce(DataFrame.unionByName, parts)


def geo_by_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.geo_by_network(risk.ip_risk_scores(flows(spark, sf_dir), ordered=False), networks(spark, sf_dir))


def window_links(flow_table: DataFrame) -> DataFrame:
    """Attack links per hour: every hour has a graph of its own."""
    hour = F.window("timestamp", "1 hour")["start"].alias("window_start")
    return hosts.attack_flows(flow_table).select(hour, "source_ip", "destination_ip")


def raw_flow_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "raw-csv")
    flow_source.write_raw_flows(raw_flows(spark, sf_dir), path)
    scanned = flow_source.read_raw_flows(spark, path)
    return scanned.withColumn("source_ip", F.nullif("source_ip", F.lit("")))


def document_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "documents")
    documents.load_documents(raw_flows(spark, sf_dir), path)
    return documents.read_documents(spark, path)


def document_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of which one is started twice: per record the copies that are left."""
    path, raw = fresh_path(spark, "documents"), raw_flows(spark, sf_dir)
    for load in ("first", "second", "first"):
        documents.load_documents(raw, path, load)
    return documents.read_documents(spark, path).groupBy("timestamp", "destination_ip", "flow_duration", "total_bytes").agg(
        F.count(F.lit(1)).alias("copies"))


# Lines that the query cuts short or adds fields to, by event.
DAMAGED = "CASE WHEN event_id % 61 = 0 THEN 'short' WHEN event_id % 67 = 0 THEN 'long' END"


def damaged_csv(spark: SparkSession, sf_dir: str) -> str:
    """Raw logs as CSV in which some lines have seven and some twelve fields."""
    path = fresh_path(spark, "damaged-csv")
    names = flow_source.RAW_SCHEMA.names
    events = table(spark, sf_dir, "events")
    lines = raw_flows_from_events(events, keep=f"{DAMAGED} AS damage")
    line = F.when(F.col("damage") == "short", F.concat_ws(",", *names[:7])).when(
        F.col("damage") == "long", F.concat_ws(",", *names, F.lit("x"), F.lit("y"))).otherwise(F.concat_ws(",", *names))
    header = F.when(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0, F.lit(",".join(names) + "\n")).otherwise("")
    lines.select(F.concat(header, line).alias("line")).write.text(path)
    return path


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = flow_source.read_raw_records(spark, damaged_csv(spark, sf_dir))
    return flow_source.rejected_rows(records).groupBy("reason", "line").agg(F.count(F.lit(1)).alias("records"))


def etl_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel observed while clean flows are written from damaged CSV."""
    flow_table, counts = clean.observed_clean(flow_source.read_raw_records(spark, damaged_csv(spark, sf_dir)))
    tables.write_table(flow_table, fresh_path(spark, "clean"))
    return clean.observed_funnel(spark, counts)


def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = flow_source.inline_rows(
        spark, [(1, "TCP", "BENIGN"), (2, "UDP", "DDoS"), (3, "ICMP", "PortScan")],
        "event_id long, protocol string, attack_type string",
    )
    counted = flows(spark, sf_dir).groupBy("protocol", "attack_type").agg(F.count(F.lit(1)).alias("flows"))
    return listed.join(counted, ["protocol", "attack_type"], "left").select(
        "event_id", "protocol", "attack_type", F.coalesce("flows", F.lit(0)).alias("flows")
    )


def serving_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving table does not exist here, so the reader falls back to the mirror."""
    report = distributions.attack_distribution(flows(spark, sf_dir))
    root = fresh_path(spark, "serving-read")
    tables.json_mirror(report, f"{root}/attack_stats.json")
    return documents.read_serving(
        spark, f"{root}/serving/attack_stats", f"{root}/attack_stats.json", report.schema
    )


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = {"raw_flows": raw_flows(spark, sf_dir), "flows": flows(spark, sf_dir)}
    given = {name: table(spark, sf_dir, name) for name in DRIVER_TABLES}
    return flow_source.table_counts(derived | given)


# --- sinks -------------------------------------------------------------------

def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.write_table(flows(spark, sf_dir), fresh_path(spark, "roundtrip"))


def publish_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh a serving table, then try an empty refresh, which must change nothing."""
    path = f"{fresh_path(spark, 'serving')}/attack_stats"
    report = materialize(distributions.attack_distribution(flows(spark, sf_dir)), "attack_distribution")
    tables.refresh_serving(report, path)
    tables.refresh_serving(report.where("total_flows < 0"), path)
    return read_published(spark, path)


def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables refreshed together and one again: rows and version of what readers then see, after old folders are gone."""
    root, clean_table = fresh_path(spark, "serving"), written_flows(spark, sf_dir)
    attacks, benign = hosts.attack_flows(clean_table), clean_table.where("attack_type = 'BENIGN'")
    versions.publish({"attacks": benign, "benign": benign}, root)
    versions.publish({"attacks": attacks}, root)
    versions.publish({"attacks": attacks.limit(0)}, root)
    versions.remove_old(spark, root, keep=1)
    version = versions.current(spark, root)[0]
    seen = [read_current(spark, root, name).groupBy("attack_type").agg(F.count(F.lit(1)).alias("flows")).select(
        F.lit(name).alias("name"), F.lit(version).cast("long").alias("version"), "attack_type", "flows") for name in ("attacks", "benign")]
    return reduce(DataFrame.unionByName, seen)


def written_run(spark: SparkSession, sf_dir: str, serving: bool = False) -> tuple[str, DataFrame]:
    """Clean flows and all reports in a new folder; returns it with the run summary."""
    out = fresh_path(spark, "run")
    clean_table = tables.write_table(flows(spark, sf_dir), f"{out}/{jobs.CLEAN}")
    return out, jobs.run_analytics(spark, clean_table, out, serving)


def json_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = written_run(spark, sf_dir)

    def mirror(collection: str) -> DataFrame:
        report = spark.read.parquet(f"{out}/{jobs.PUBLISHED[collection]}")
        tables.json_mirror(report, f"{out}/{collection}.json")
        return tables.read_mirror(spark, f"{out}/{collection}.json", report)

    return tables.rows_per_output(dict(zip(jobs.PUBLISHED, at_once(spark, mirror, jobs.PUBLISHED))))


def json_mirror_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with timestamps and nulls, mirrored as JSON and read back."""
    report = flows(spark, sf_dir).withColumn("protocol", F.nullif("protocol", F.lit("UDP")))
    path = fresh_path(spark, "mirror")
    tables.json_mirror(report, path)
    return tables.read_mirror(spark, path, report)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_run(spark, sf_dir)[1]


def integration_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job chain on raw CSV: clean, analyse, train, publish."""
    raw_path = fresh_path(spark, "raw-csv")
    flow_source.write_raw_flows(raw_flows(spark, sf_dir), raw_path)
    return jobs.run_all(spark, raw_path, fresh_path(spark, "full-run"))


def sharded_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "shards")
    sharding.write_sharded(flows(spark, sf_dir), path, shards=4)
    return spark.read.parquet(path).groupBy("shard").agg(
        F.count(F.lit(1)).alias("documents"), F.count_distinct("source_ip").alias("sources")
    )


def bucketed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows per source from a table bucketed by source, which takes no shuffle."""
    path = fresh_path(spark, "bucketed")
    stored = sharding.write_bucketed(flows(spark, sf_dir), f"flows_{path.rpartition('-')[2]}", path)
    return stored.groupBy("source_ip").agg(F.count(F.lit(1)).alias("flows"), F.sum("packet_count").alias("packets"))


def salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows joined with the risk of their source, both from tables bucketed by source and salt, which takes no shuffle."""
    clean_table, buckets, salts = written_flows(spark, sf_dir), 16, 8
    hot = sharding.hot_sources(clean_table, buckets)
    paths = [fresh_path(spark, name) for name in ("salted", "risk")]
    names = [f"{name}_{path.rpartition('-')[2]}" for name, path in zip(("salted", "risk"), paths)]
    salted = sharding.write_salted(clean_table, hot, names[0], paths[0], buckets, salts)
    side = sharding.write_salted_side(risk.ip_risk_scores(clean_table, ordered=False), hot, names[1], paths[1], buckets, salts)
    return salted.join(side, ["source_ip", "salt"]).groupBy("risk_level", "attack_type").agg(
        F.count(F.lit(1)).alias("flows"), F.sum("packet_count").alias("packets"), F.sum("risk_score").alias("scores"))


def reputation_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = risk.reputation_export(risk.ip_risk_scores(flows(spark, sf_dir), ordered=False))
    return tables.write_table(export, fresh_path(spark, "ip_reputation")).drop("updated_at")


# --- joins over several derived tables ---------------------------------------

def critical_sources(flow_table: DataFrame) -> DataFrame:
    """Blacklist of the queries: every source in the critical tier."""
    return risk.ip_risk_scores(flow_table, ordered=False).where("risk_level = 'Critical'").select("source_ip")


def blacklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean_table = written_flows(spark, sf_dir)
    return hosts.exclude_listed(clean_table, materialize(critical_sources(clean_table), "blacklist"))


def mitre_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = flows(spark, sf_dir).groupBy("source_ip", "attack_type").agg(F.count(F.lit(1)).alias("flows"))
    return enrich.with_technique(pairs)


def attackers_with_modal_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = written_pairs(spark, sf_dir)
    scored = risk.ip_risk_scores(pairs, ordered=False).select("source_ip", "attack_count")
    return hosts.with_modal_type(scored, hosts.modal_attack_type(pairs))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean_table = written_flows(spark, sf_dir)
    return quality.quality_report(
        clean_table, risk.ip_risk_scores(clean_table, ordered=False), timeline.hourly_timeline(clean_table)
    )


def on_links(op: Callable[[DataFrame], DataFrame]) -> Query:
    return on_flows(lambda f: op(graph.host_links(f)))


def on_written_links(op: Callable[[DataFrame], DataFrame]) -> Query:
    return on_links(lambda links: op(materialize(links, "links")))


def graph_edges_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = written_pairs(spark, sf_dir)
    return graph.label_edges(graph.graph_edges(pairs), graph.graph_degree(graph.host_links(pairs)))


# --- models ------------------------------------------------------------------

# Clean flows and trained models of one set of event files, made once per application and
# shared by the queries below.
_trained: dict[tuple[str, str], tuple[DataFrame, jobs.TrainingRun]] = {}


def models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, jobs.TrainingRun]:
    key = (spark.sparkContext.applicationId, jobs.input_version(table(spark, sf_dir, "events")))
    if key not in _trained:
        clean_table = written_flows(spark, sf_dir)
        fitted = features.fit_features(clean_table)
        # Only what training reads: addresses, times and raw vectors are most of a feature table.
        feature_table = materialize(features.feature_table(fitted, clean_table).select("label", "features", features.BUCKET), "features")
        _trained[key] = clean_table, jobs.train_models(feature_table, fitted)
    return _trained[key]


def on_models(op: Callable[[jobs.TrainingRun], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(models(spark, sf_dir)[1])


def indexed_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean_table = written_flows(spark, sf_dir)
    return features.fit_features(clean_table).transform(clean_table).select(
        "timestamp", "source_ip", "destination_ip", "protocol", "severity", "attack_type",
        "protocol_index", "severity_index", "label",
    )


def feature_entries(vector: str, digits: int | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        clean_table = written_flows(spark, sf_dir)
        table_ = features.feature_table(features.fit_features(clean_table), clean_table)
        entries = features.vector_columns(table_, vector)
        if digits is not None:
            entries = [F.round(e, digits).alias(n) for e, n in zip(entries, features.FEATURES)]
        carried = table_.select(*features.CARRIED, "label", *entries, features.vector_size(vector).alias("vector_size"))
        return carried if digits is None else carried.drop("vector_size")
    return query


def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label map, written as JSON and read back."""
    path = fresh_path(spark, "label_mapping")
    features.label_map(spark, features.fit_features(flows(spark, sf_dir))).coalesce(1).write.json(path)
    return spark.read.schema("label int, attack_type string").json(path)


def metrics_of(kind: str) -> Query:
    return on_models(lambda run: evaluation.overall_metrics(run.outcomes[kind]))


def metrics_document(run: jobs.TrainingRun) -> DataFrame:
    best = run.best()
    return evaluation.metrics_document(run.metrics, run.matrix(best), run.report(best))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows on which a saved and reloaded model disagrees with the one in memory (none)."""
    clean_table, run = models(spark, sf_dir)
    scorer, path = run.scorer(training.RANDOM_FOREST), fresh_path(spark, "model")
    training.save_model(scorer, path)
    expected = scorer.transform(features.held_out_flows(clean_table)).select(
        *clean_table.columns, F.col("prediction").alias("expected")
    )
    return training.load_model(path).transform(expected).agg(
        F.count(F.lit(1)).alias("compared"),
        F.count_if(F.col("prediction") != F.col("expected")).alias("differing"),
    )


def predictions(spark: SparkSession, sf_dir: str, limit: int | None = None) -> DataFrame:
    clean_table, run = models(spark, sf_dir)
    return inference.predict(clean_table, run.scorer(training.RANDOM_FOREST), limit)


def prediction_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preview of the command line: the first flows by time."""
    return predictions(spark, sf_dir, PREVIEW)


def predictions_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prediction log after two runs of which one is repeated, per flow."""
    path = fresh_path(spark, "predictions")
    for run in ("first", "second", "first"):
        tables.append_predictions(predictions(spark, sf_dir), path, run)
    return spark.read.parquet(path).groupBy("timestamp", "source_ip", "destination_ip", "actual_attack").agg(
        F.count(F.lit(1)).alias("records"), F.count("analyzed_at").alias("stamped"))


def checked(predicted: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per actual class the number of predictions, and how many break a rule that every prediction obeys."""
    names = features.class_labels(models(spark, sf_dir)[1].features)
    sure = F.col("confidence")
    severity = F.expr("""CASE WHEN predicted_attack = 'BENIGN' THEN 'Low' WHEN predicted_attack = 'PortScan' THEN IF(confidence > 75, 'Medium', 'Low')
        WHEN predicted_attack IN ('Botnet', 'BruteForce') THEN IF(confidence > 70, 'High', 'Medium')
        ELSE IF(confidence > 80, 'Critical', 'High') END""")
    return predicted.groupBy("actual_attack").agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count_if(~(sure.between(0, 100) & (sure >= 100 / len(names) - 0.01))).alias("odd_confidence"),
        F.count_if(F.col("severity") != severity).alias("odd_severity"),
        F.count_if(~F.col("predicted_attack").isin(names)).alias("unknown_names"))


def prediction_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(predictions(spark, sf_dir), spark, sf_dir)


def stream_prediction_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(stream_predictions(spark, sf_dir), spark, sf_dir)


def forest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per actual class and model: flows scored, and those on which the model and its table of nodes disagree (none)."""
    clean_table, run = models(spark, sf_dir)
    judged = [trees.disagreements(run.scorer(kind).transform(clean_table), run.trained[kind].model, "attack_type").withColumn(
        "model", F.lit(kind)) for kind in (training.DECISION_TREE, training.RANDOM_FOREST)]
    return reduce(DataFrame.unionByName, judged)


def rule_outcomes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Outcome counts of the threshold classifier, with the label map and the class names."""
    clean_table = written_flows(spark, sf_dir)
    model = features.fit_features(clean_table)
    labels = features.label_map(spark, model)
    judged = verdicts.rule_classifier(clean_table)
    actual = labels.select("label", F.col("attack_type").alias("actual_attack"))
    predicted = labels.select(F.col("label").alias("prediction"), F.col("attack_type").alias("predicted_attack"))
    return (evaluation.outcome_counts(judged.join(actual, "actual_attack").join(predicted, "predicted_attack", "left")), labels,
            features.class_labels(model))


def rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.overall_metrics(rule_outcomes(spark, sf_dir)[0])


def rule_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes, _, names = rule_outcomes(spark, sf_dir)
    return evaluation.confusion_matrix(outcomes, names)


def rule_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes, labels, _ = rule_outcomes(spark, sf_dir)
    return evaluation.class_report(outcomes, labels)


def rule_metrics_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics document of the threshold classifier, read back section by section (without its stamp)."""
    outcomes, labels, names = rule_outcomes(spark, sf_dir)
    outcomes = materialize(outcomes, "outcomes")
    document = evaluation.metrics_document(
        evaluation.overall_metrics(outcomes), evaluation.confusion_matrix(outcomes, names), evaluation.class_report(outcomes, labels))
    text, rate = F.lit(None).cast("string"), F.lit(None).cast("double")
    sections = {
        "models": ("test_rows:bigint,accuracy:double", (text, text, F.col("test_rows"), F.col("accuracy"))),
        "confusion_matrix": ("actual:string,predicted:string,n:bigint", (F.col("actual"), F.col("predicted"), F.col("n"), rate)),
        "per_class_metrics": ("attack_type:string,support:bigint,f1_score:double",
                              (F.col("attack_type"), text, F.col("support"), F.col("f1_score"))),
    }
    rows = []
    for name, (fields, values) in sections.items():
        entries = document.select(F.inline(F.from_json(name, f"array<struct<{fields}>>")))
        columns = [value.alias(alias) for value, alias in zip(values, ("actual", "predicted", "n", "rate"))]
        rows.append(entries.select(F.lit(name).alias("section"), *columns))
    return reduce(DataFrame.unionByName, rows)


def rule_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold classifier compared with the rule that every flow is benign."""
    rules, labels, _ = rule_outcomes(spark, sf_dir)
    benign = labels.where("attack_type = 'BENIGN'").select(F.col("label").alias("prediction"))
    clean_table = flows(spark, sf_dir).join(F.broadcast(labels.withColumnRenamed("label", "actual")), "attack_type")
    constant = benign.first()["prediction"]
    baseline = evaluation.outcome_counts(clean_table.select(F.col("actual").alias("label"), F.lit(constant).alias("prediction")))
    return evaluation.model_metrics({"threshold rules": rules, "all benign": baseline}, {"threshold rules": 0.0, "all benign": 0.0})


# --- streams -----------------------------------------------------------------

def streamed_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream of cleaned flows."""
    schema = table(spark, sf_dir, "events").schema
    # Written as a glob, the path may name one file as well as a folder of part files.
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(f"{sf_dir}/{{events.parquet}}")
    return streams.clean_stream(raw_flows_from_events(events))


def written_blacklist(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "blacklist")
    critical_sources(flows(spark, sf_dir)).write.parquet(path)
    return path


def stream_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = fresh_path(spark, "allowed"), fresh_path(spark, "stream-state")
    streams.run_allowed(streamed_flows(spark, sf_dir), written_blacklist(spark, sf_dir), path, checkpoint)
    return spark.read.parquet(path).drop("batch")


def incident_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = fresh_path(spark, "incidents"), fresh_path(spark, "stream-state")
    streams.run_incident_audit(
        streamed_flows(spark, sf_dir), written_blacklist(spark, sf_dir), path, checkpoint
    )
    return spark.read.parquet(path).drop("batch")


def stream_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = fresh_path(spark, "scored"), fresh_path(spark, "stream-state")
    scored = streams.score_stream(streamed_flows(spark, sf_dir), models(spark, sf_dir)[1].scorer(training.RANDOM_FOREST))
    streams.run_to_table(scored, path, checkpoint)
    return spark.read.parquet(path)


def stream_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = fresh_path(spark, "entropy"), fresh_path(spark, "stream-state")
    streams.run_entropy_counts(streamed_flows(spark, sf_dir), path, checkpoint)
    return streams.read_entropy(spark, path)


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows published as they close and amended by late rows, in three runs of one stream.

    First all flows but those of every tenth event, then these, of which most
    are late, then a heartbeat that closes the last windows.
    """
    landing, beats, path, checkpoint = (fresh_path(spark, name) for name in ("landing", "beats", "windows", "stream-state"))
    parts = raw_flows_from_events(table(spark, sf_dir, "events"), keep="event_id % 10 = 0 AS tenth")
    spark.createDataFrame([], windows.HEARTBEAT_SCHEMA).write.parquet(beats)
    for tenth in (False, True, None):
        if tenth is None:
            windows.send_heartbeat(spark, beats, "2100-01-01 00:00:00")
        else:
            parts.where(F.col("tenth") == tenth).drop("tenth").write.mode("append").parquet(landing)
        raw = spark.readStream.schema(flow_source.RAW_SCHEMA).parquet(landing)
        windows.run_window_counts(streams.clean_stream(raw), path, checkpoint, heartbeats=windows.heartbeat_stream(spark, beats))
    return windows.read_window_entropy(spark, path)


def queries() -> dict[str, Query]:
    return {
        # sources
        "raw_flow_scan": raw_flow_scan,
        "document_load": document_load,
        "document_reload": document_reload,
        "rejected_rows": rejected_rows,
        "inline_rows": inline_rows,
        "serving_read": serving_read,
        "table_counts": table_counts,
        "distributed_sum": lambda spark, d: flow_source.sum_probe(table(spark, d, "events"), "event_id"),
        # cleaning
        "typed_flows": on_raw(clean.typed_flows),
        "valid_flows": on_raw(lambda r: clean.valid_flows(clean.typed_flows(r))),
        "temporal_features": on_raw(lambda r: clean.with_time_parts(clean.valid_flows(clean.typed_flows(r)))),
        "clean_flows": flows,
        "clean_funnel": on_raw(clean.clean_funnel),
        "etl_funnel": etl_funnel,
        # distributions
        "attack_distribution": on_distribution(lambda d: d),
        "protocol_distribution": on_flows(distributions.protocol_distribution),
        "severity_distribution": on_flows(distributions.severity_distribution),
        "severity_ranked": on_flows(lambda f: distributions.severity_ranked(distributions.severity_distribution(f))),
        "attack_overview_table": on_distribution(distributions.attack_overview),
        "bandwidth_rank": on_distribution(distributions.bandwidth_rank),
        "kpi_overview": on_flows(distributions.kpi_overview),
        "distinct_vectors": on_flows(lambda f: distributions.distinct_values(f, "attack_type")),
        # timelines
        "hourly_attack_intensity": on_flows(timeline.hourly_attack_intensity),
        "hourly_timeline": on_flows(timeline.hourly_timeline),
        "daily_cadence": on_flows(timeline.daily_cadence),
        "surge_windows": on_flows(timeline.surge_windows),
        # hosts
        "attack_flows": on_flows(hosts.attack_flows),
        "top_attacking_ips": on_flows(hosts.top_attacking_ips),
        "top_attack_type": on_flows(hosts.modal_attack_type),
        "attackers_with_modal_type": attackers_with_modal_type,
        "top_targeted_ips": on_flows(hosts.top_targeted_ips),
        "crosstab": on_flows(hosts.ip_attack_crosstab),
        "crosstab_columns": on_flows(lambda f: hosts.crosstab_columns(hosts.ip_attack_crosstab(f))),
        "blacklist_filter": blacklist_filter,
        # risk
        "ip_risk_scores": on_flows(risk.ip_risk_scores),
        "ip_risk_signals": on_flows(risk.ip_risk_signals),
        "ip_lookup": on_risk(lambda r: risk.lookup_ip(r, LOOKUP_IP)),
        "top_risk_actors": on_risk(lambda r: risk.top_risk_actors(r, 100)),
        "risk_bounds": on_risk(risk.risk_bounds),
        "reputation_export": reputation_export,
        # enrichment
        "mitre_enriched": mitre_enriched,
        "geo_enriched": on_geo(lambda g: g),
        "geo_filtered": on_geo(lambda g: enrich.geo_filtered(g, "DDoS", "Critical")),
        "geo_by_network": geo_by_network,
        "network_country_top": lambda spark, d: enrich.volume_by(geo_by_network(spark, d), "country"),
        "geo_overview_table": on_geo(enrich.geo_overview),
        "country_top": on_geo(lambda g: enrich.volume_by(g, "country")),
        "asn_top": on_geo(lambda g: enrich.volume_by(g, "asn")),
        "mitigation_rules": on_flows(
            lambda f: enrich.mitigation_rules(f.select("source_ip", "attack_type").distinct(), RULES)),
        # verdicts
        "rule_classifier": on_flows(verdicts.rule_classifier),
        "severity_rule": on_flows(verdicts.source_severity),
        # graph
        "graph_edges": on_flows(graph.graph_edges),
        "graph_degree": on_links(graph.graph_degree),
        "graph_pivots": on_links(lambda k: graph.graph_pivots(graph.graph_degree(k))),
        "graph_summary": on_links(graph.graph_summary),
        "graph_levels": on_links(graph_depth.graph_levels),
        "graph_depth": on_flows(lambda f: graph_depth.graph_depth(window_links(f), ["window_start"])),
        "graph_edges_labeled": graph_edges_labeled,
        "lateral_hops": on_written_links(lambda k: graph.lateral_hops(k, graph.graph_degree(k))),
        "lateral_paths": on_written_links(lambda k: graph.lateral_paths(k, [LOOKUP_IP])),
        # entropy
        "packet_entropy": on_flows(entropy.packet_entropy),
        "entropy_flags": on_flows(lambda f: entropy.entropy_flags(entropy.packet_entropy(f))),
        "entropy_drift": on_flows(entropy.entropy_drift),
        # quality and storage
        "quality_report": quality_report,
        "partition_balance": on_flows(sharding.partition_balance),
        "sharded_write": sharded_write,
        "bucketed_sources": bucketed_sources,
        "salted_join": salted_join,
        "parquet_roundtrip": parquet_roundtrip,
        "publish_refresh": publish_refresh,
        "publish_versions": publish_versions,
        "json_mirror": json_mirror,
        "json_mirror_rows": json_mirror_rows,
        "run_summary": run_summary,
        "integration_manifest": integration_manifest,
        # features and models
        "indexed_flows": indexed_flows,
        "feature_vectors": feature_entries("raw_features", None),
        "scaled_features": feature_entries("features", 6),
        "label_map": label_map,
        "split_counts": on_flows(features.split_counts),
        "dt_metrics": metrics_of(training.DECISION_TREE),
        "rf_metrics": metrics_of(training.RANDOM_FOREST),
        "model_metrics": on_models(lambda run: run.metrics),
        "confusion_matrix": on_models(lambda run: run.matrix(training.RANDOM_FOREST)),
        "class_report": on_models(lambda run: run.report(training.RANDOM_FOREST)),
        "class_support": on_models(
            lambda run: run.report(training.RANDOM_FOREST).select("attack_type", "support")),
        "model_metrics_doc": on_models(metrics_document),
        "model_roundtrip": model_roundtrip,
        "predictions": predictions,
        "prediction_sample": prediction_sample,
        "prediction_sample_flows": lambda spark, d: prediction_sample(spark, d).select(
            "timestamp", "source_ip", "destination_ip", "actual_attack"),
        "predictions_append": predictions_append,
        "prediction_checks": prediction_checks,
        "forest_checks": forest_checks,
        "rule_metrics": rule_metrics,
        "rule_metrics_doc": rule_metrics_doc,
        "rule_comparison": rule_comparison,
        "rule_confusion_matrix": rule_confusion_matrix,
        "rule_class_report": rule_class_report,
        # streams
        "stream_blacklist": stream_blacklist,
        "incident_audit": incident_audit,
        "stream_predictions": stream_predictions,
        "stream_prediction_checks": stream_prediction_checks,
        "stream_entropy": stream_entropy,
        "stream_windows": stream_windows,
    }
