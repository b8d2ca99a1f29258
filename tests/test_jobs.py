"""The job chain, models and scoring on synthetic flows."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from netvigil.ml import evaluation, features, inference, training
from netvigil.operators import quality
from netvigil.plans import jobs
from netvigil.session import fresh_path
from netvigil.sources import flows as flow_source
from netvigil.sources.synthetic import generate_range
from netvigil.sources.versions import read_current


@pytest.fixture(scope="module")
def run(spark):
    """One full run over 6000 generated flows."""
    raw, out = fresh_path(spark, "raw"), fresh_path(spark, "out")
    flow_source.write_raw_flows(generate_range(spark, 6000), raw)
    return {"out": out, "raw": raw, "manifest": jobs.run_all(spark, raw, out)}


@pytest.fixture(scope="module")
def flows(spark, run):
    return spark.read.parquet(f"{run['out']}/{jobs.CLEAN}")


def test_manifest(run, flows):
    documents = {r["collection"]: r["documents"] for r in run["manifest"].collect()}
    assert set(documents) == set(jobs.PUBLISHED) | {"predictions", "model_metrics", "TOTAL"}
    assert documents["predictions"] == flows.count() and documents["model_metrics"] == 1
    assert documents["TOTAL"] == sum(n for name, n in documents.items() if name != "TOTAL")


def test_outputs_and_invariants(spark, run, flows):
    read = lambda name: spark.read.parquet(f"{run['out']}/{name}")
    for name in {*jobs.STATISTICS, *jobs.TIMELINES, *jobs.HOSTS, jobs.RISK, jobs.FEATURES}:
        assert read(name).count() > 0, name
    assert read("hourly_attack_intensity.parquet").count() <= 24
    assert read("network_timeline_daily.parquet").count() <= 7
    assert read("attack_surge_windows.parquet").count() <= 4
    report = quality.quality_report(flows, read(jobs.RISK), read("network_timeline_hourly.parquet"))
    assert report.where("NOT passed").count() == 0
    some = read(jobs.RISK).first()
    assert jobs.lookup(spark, run["out"], some["source_ip"]).first() == some


def test_only_missing_outputs_are_rebuilt(spark, run):
    out, name = fresh_path(spark, "partial"), "top_targeted_ips.parquet"
    spark.read.parquet(f"{run['out']}/{jobs.CLEAN}").write.parquet(f"{out}/{jobs.CLEAN}")
    assert set(jobs.missing_outputs(spark, out, jobs.PUBLISHED.values())) == set(jobs.PUBLISHED.values())
    manifest = jobs.publish(spark, out)  # no model was trained in this folder
    assert {r["collection"] for r in manifest.collect()} == set(jobs.PUBLISHED) | {"TOTAL"}
    assert jobs.missing_outputs(spark, out, [name]) == []
    assert spark.read.parquet(f"{out}/{name}").count() == spark.read.parquet(f"{run['out']}/{name}").count()


def test_reports_older_than_the_clean_table_are_rebuilt(spark, run):
    out, clean = fresh_path(spark, "stale"), f"{run['out']}/{jobs.CLEAN}"
    total = lambda: spark.read.parquet(f"{out}/protocol_distribution.parquet").agg(F.sum("total_flows")).first()[0]
    spark.read.parquet(clean).write.parquet(f"{out}/{jobs.CLEAN}")
    jobs.ensure_outputs(spark, out)
    built, before = spark.read.parquet(f"{out}/{jobs.RISK}").inputFiles(), total()
    jobs.ensure_outputs(spark, out)
    assert spark.read.parquet(f"{out}/{jobs.RISK}").inputFiles() == built  # up to date
    spark.read.parquet(clean).where("attack_type <> 'BENIGN'").write.mode("overwrite").parquet(f"{out}/{jobs.CLEAN}")
    jobs.ensure_outputs(spark, out)
    assert spark.read.parquet(f"{out}/{jobs.RISK}").inputFiles() != built and total() < before


def test_feature_table(spark, run, flows):
    table = spark.read.parquet(f"{run['out']}/{jobs.FEATURES}")
    assert table.select(features.vector_size("features")).distinct().first()[0] == len(features.FEATURES)
    train, test = features.training_part(table).count(), features.test_part(table).count()
    assert train + test == table.count() == flows.count()
    assert 0.77 < train / (train + test) < 0.83
    labels = {r["label"]: r["attack_type"] for r in spark.read.json(f"{run['out']}/label_mapping.json").collect()}
    counts = {r["attack_type"]: r["n"] for r in flows.groupBy("attack_type").agg(F.count("*").alias("n")).collect()}
    assert [labels[i] for i in sorted(labels)] == sorted(counts, key=lambda c: (-counts[c], c))


def test_classifiers_reach_the_published_quality(spark, run):
    metrics = {r["model"]: r for r in spark.read.json(f"{run['out']}/model_metrics.json").collect()}
    assert metrics["random_forest"]["accuracy"] >= 0.95
    assert metrics["decision_tree"]["accuracy"] >= 0.90
    assert sum(r["best"] for r in metrics.values()) == 1


def test_metrics_equal_the_library_evaluator(spark, run, flows):
    model = training.load_model(f"{run['out']}/threat_model")
    # Corrupt some labels so that no metric is trivially one.
    scored = model.transform(flows.where("hour IS NOT NULL")).withColumn(
        "label", F.when(F.col("packet_count") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(5))).otherwise(F.col("label")))
    ours = evaluation.overall_metrics(evaluation.outcome_counts(scored)).first()
    for column, metric in (("accuracy", "accuracy"), ("f1_score", "f1"), ("precision", "weightedPrecision"),
                           ("recall", "weightedRecall")):
        library = MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(scored)
        assert ours[column] == pytest.approx(library, abs=1e-4), column


def test_evaluation_of_the_saved_model(spark, run, flows):
    matrix, report = jobs.run_evaluation(spark, run["out"])
    cells, held_out = matrix.collect(), features.held_out_flows(flows)
    assert len(cells) == 25 and sum(r["n"] for r in cells) == held_out.count()
    for row in report.collect():
        hits = sum(r["n"] for r in cells if r["actual"] == r["predicted"] == row["attack_type"])
        assert row["support"] == sum(r["n"] for r in cells if r["actual"] == row["attack_type"])
        assert row["recall"] == pytest.approx(hits / row["support"], abs=1e-4)


def test_undefined_ratios_are_zero(spark):
    outcomes = spark.createDataFrame([(0, 1, 5)], "label int, prediction int, n long")
    labels = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "label int, attack_type string")
    rows = {r["attack_type"]: r[2:] for r in evaluation.class_report(outcomes, labels).collect()}
    assert rows == {"a": (0.0, 0.0, 0.0), "b": (0.0, 0.0, 0.0), "c": (0.0, 0.0, 0.0)}


def test_predictions(spark, run, flows):
    model = training.load_model(f"{run['out']}/threat_model")
    everything = inference.predict(flows, model)
    assert everything.count() == flows.count()
    assert everything.where("confidence < 0 OR confidence > 100 OR severity IS NULL").count() == 0
    sample = inference.predict(flows, model, 10).collect()
    order = flows.orderBy("timestamp", "source_ip", "destination_ip").limit(10).collect()
    assert [(r["source_ip"], r["destination_ip"]) for r in sample] == [(r["source_ip"], r["destination_ip"]) for r in order]


def test_unknown_label_and_missing_time(spark):
    frame = spark.createDataFrame([(5.0,), (0.0,)], "p double").select(inference.class_name(F.col("p"), ["a"]).alias("n"))
    assert [r["n"] for r in frame.collect()] == ["Unknown_5", "a"]


def test_unseen_class_gets_the_extra_label(spark, run, make_flows):
    model = training.load_model(f"{run['out']}/threat_model")
    scored = model.transform(make_flows(dict(attack_type="Worm"), dict(hour=None)))
    assert [r["label"] for r in scored.collect()] == [5.0]  # the row without an hour has no vector


def test_metrics_document(spark, run):
    document = read_current(spark, f"{run['out']}/serving", "model_metrics").first()
    assert '"model":"random_forest"' in document["models"] and '"actual":"DDoS"' in document["confusion_matrix"]
    assert '"recall"' in document["per_class_metrics"] and document["integrated_at"] is not None


def test_models_of_the_queries_write_only_what_training_reads(spark, monkeypatch):
    from netvigil import registry

    written = {}

    def noted(df, name, write=registry.materialize):
        written[name] = df.columns
        return write(df, name)

    monkeypatch.setattr(registry, "materialize", noted)
    monkeypatch.setattr(registry, "_trained", {})
    assert registry.queries()["model_metrics_doc"](spark, "/root/testdata/sf0.001").count() == 1
    assert written["features"] == ["label", "features", "split_bucket"]
