import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from pulsetrail.operators import evaluation, sampling


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(2000).select("id", (F.col("id") % 20 == 0).cast("int").alias("label"))


def test_samples_do_not_depend_on_the_layout(labelled, rows):
    one = sampling.downsample_negatives(labelled, "id", "label", 3)
    two = sampling.downsample_negatives(labelled.repartition(13), "id", "label", 3)
    assert rows(one) == rows(two)
    assert one.where("label = 1").count() == 100
    assert 250 < one.where("label = 0").count() < 350


def test_downsampling_without_a_class(labelled):
    negatives, positives = labelled.where("label = 0"), labelled.where("label = 1")
    assert sampling.downsample_negatives(negatives, "id", "label", 20).count() == 0
    assert sampling.downsample_negatives(positives, "id", "label", 20).count() == 100


def test_stages_use_independent_hashes(labelled):
    sampled = sampling.two_stage_sample(labelled, "id", "label", 0.5, 5)
    positives = sampled.where("label = 1").count()
    negatives = sampled.where("label = 0").count()
    assert 35 <= positives <= 65 and 3.5 < negatives / positives < 6.5


def test_split_is_disjoint_and_complete(labelled, rows):
    parts = sampling.hash_split(labelled, "id", [0.7, 0.3])
    assert rows(parts[0].unionByName(parts[1])) == rows(labelled)
    assert 0.65 < parts[0].count() / 2000 < 0.75


def test_strata_rates(labelled):
    rates = {(1,): 1.0, (0,): 0.1}
    sampled = sampling.sample_strata(labelled, "id", ["label"], rates)
    assert sampled.where("label = 1").count() == 100
    assert 140 < sampled.where("label = 0").count() < 240


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (0, 0.5)], "label int, probability double")
    assert evaluation.auc(df).first()[0] == pytest.approx(4 / 6)


def test_auc_equals_the_evaluator(spark, labelled):
    df = labelled.select("label", (sampling.hash_fraction("id") + F.col("label") * 0.2).alias("probability"))
    judge = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0)
    assert evaluation.auc(df).first()[0] == pytest.approx(judge.evaluate(df), abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.9)], "label int, probability double")
    assert evaluation.auc(df).first()[0] is None


def test_confusion_without_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "label int, prediction double")
    report = evaluation.confusion(df, "t").first().asDict()
    assert list(report) == list(evaluation.REPORT)
    assert (report["precise"], report["recall"], report["accuarcy"]) == (None, 0.0, 0.5)


def test_confusion_of_no_rows(spark):
    df = spark.createDataFrame([], "label int, prediction double")
    report = evaluation.confusion(df, "t", plain=True).first()
    assert (report["predict_cnt"], report["accuarcy"], report["real_cnt"]) == (0, None, 0)


def test_sweep_equals_single_reports(spark, labelled):
    df = labelled.select("label", sampling.hash_fraction("id").alias("probability"))
    sweep = {r["type"]: tuple(r)[1:] for r in evaluation.threshold_sweep(df, [0.7, 0.9]).collect()}
    for bar in (0.7, 0.9):
        hard = df.withColumn("prediction", (F.col("probability") >= bar).cast("double"))
        single = evaluation.confusion(hard, "x", plain=True).first()
        assert sweep[f"{bar:.2f}"] == tuple(single)[1:]
