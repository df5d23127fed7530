"""Complete jobs on feature tables derived from the customers and orders of the test data."""

import pytest
from pyspark.sql import functions as F

from pulsetrail.functions.dates import day
from pulsetrail.operators.pipelines import Learner
from pulsetrail.plans import (
    churn,
    click,
    exposure,
    feature_sets as sets,
    identity,
    material,
    profile,
    recommendation,
    risk,
)
from pulsetrail.sources.tables import scan_day, write_partitions

DT = "20240130"
DAY = "2024-01-30"
SMALL = Learner("gbt", {"maxDepth": 2, "maxIter": 2})


def number(key, name, span=20):
    return F.pmod(F.xxhash64(F.col(key), F.lit(name)), F.lit(span)).cast("double")


def wide(df, key, features, extra=None):
    """Give ``df`` all columns of a feature set, from hashes of its key."""
    categories = [*features.categorical, *features.formula]
    columns = {c: F.concat(F.lit("v"), number(key, c, 3).cast("int").cast("string")) for c in categories}
    columns |= {c: number(key, c) for c in features.numeric}
    return df.withColumns({**columns, **(extra or {})})


def over_days(df, days):
    return df.withColumn("dt", F.explode(F.array(*[F.lit(d) for d in days])))


@pytest.fixture(scope="module")
def users(spark, folder):
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    return customers.select(F.col("c_custkey").cast("string").alias("hdid"))


def check_scores(df, keys):
    assert df.count() > 0
    assert set(df.columns) >= {*keys, "prediction", "probability", "dt"}
    odd = df.where("probability < 0 or probability > 1 or prediction <> cast(probability > 0.5 as double)")
    assert odd.isEmpty()


@pytest.fixture(scope="module")
def factors(spark, folder, tmp_path_factory):
    """A trained recommender and its index tables."""
    base = str(tmp_path_factory.mktemp("factors"))
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    score = lines.groupBy(
        F.col("l_suppkey").cast("string").alias("hdid"), F.col("l_partkey").cast("string").alias("docid")
    ).agg(F.sum("l_quantity").cast("float").alias("score"))
    write_partitions(score.withColumn("dt", F.lit(DAY)), f"{base}/score", ["dt"])
    paths = [f"{base}/{n}" for n in ("score", "users", "items", "models")]
    model, error = recommendation.train_recommender(spark, *paths, DT)
    return paths, model, error


def test_recommender(spark, factors):
    (score, users_path, items_path, models), model, error = factors
    assert error.first()["rmse"] > 0
    index = scan_day(spark, items_path, DAY)
    assert index.columns == ["docid", "index", "dt"]
    assert index.agg(F.max("index") - F.count("*")).first()[0] == -1
    pairs = scan_day(spark, score, DAY).select("hdid", "docid").limit(50)
    pairs = pairs.unionByName(spark.createDataFrame([("nobody", "0")], "hdid string, docid string"))
    scored = recommendation.score_candidates(spark, pairs, users_path, items_path, models, DT)
    assert scored.count() == 50
    assert scored.where("isnan(prediction) or prediction is null").isEmpty()


@pytest.fixture(scope="module")
def clicks(spark, users, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clicks") / "table")
    days = [day(DT, n) for n in (*sets.CLICK_SNAPSHOTS, sets.CLICK_TEST_OFFSET)]
    rows = over_days(users.withColumn("doc_id", F.col("hdid")), days)
    extra = {
        "label": (number("hdid", "label", 3) == 0).cast("int"),
        "r_label": (number("hdid", "r", 2) == 0).cast("int"),
        "title_length": F.when(F.col("hdid") != "7", number("hdid", "title")),
    }
    write_partitions(wide(rows, "hdid", sets.CLICK, extra), path, ["dt"])
    return path


def test_click_job(spark, clicks, tmp_path):
    base = str(tmp_path)
    trained = click.train_click(spark, clicks, f"{base}/models", DT, learner=SMALL)
    reports = {r["type"]: r for r in trained.reports.collect()}
    assert set(reports) == {"trained", "test"}
    assert reports["test"]["predict_cnt"] == 149  # one row lacks its title length
    assert {0 <= r["auc"] <= 1 for r in trained.aucs.collect()} == {True}
    scored = click.score_click(spark, clicks, f"{base}/models", f"{base}/scores", DT)
    check_scores(scored, ["hdid", "docid"])
    assert scored.count() == 149


def test_click_job_with_item_factors(spark, clicks, factors, tmp_path):
    (_, _, items_path, models), _, _ = factors
    vectors = recommendation.load_items(spark, items_path, models, DT)
    base = str(tmp_path)
    click.train_click(spark, clicks, f"{base}/models", DT, vectors=vectors, learner=SMALL)
    scored = click.score_click(spark, clicks, f"{base}/models", f"{base}/scores", DT, vectors=vectors)
    check_scores(scored, ["hdid", "docid"])


def test_retention_job_reports_on_its_own_label(spark, clicks, factors):
    (_, _, items_path, models), _, _ = factors
    vectors = recommendation.load_items(spark, items_path, models, DT)
    test_day = day(DT, sets.CLICK_TEST_OFFSET)
    trained = click.train_retention(spark, clicks, DT, test_day, vectors, learner=SMALL)
    report = trained.reports.where("type = 'test'").first()
    assert report["real_loss_cnt"] == scan_day(spark, clicks, test_day).where(
        "r_label = 1 and title_length is not null"
    ).count()


def test_churn_job(spark, users, tmp_path):
    base = str(tmp_path)
    days = [day(DT, n) for n in (*sets.CHURN_SNAPSHOTS, sets.CHURN_TEST_OFFSET)]
    extra = {"label": (number("hdid", "label", 3) == 0).cast("int")}
    write_partitions(wide(over_days(users, days), "hdid", sets.CHURN, extra), f"{base}/t", ["dt"])
    trained = churn.train_churn(spark, f"{base}/t", f"{base}/m", f"{base}/tested", DT, learner=SMALL)
    assert trained.reports.count() == 2
    tested = scan_day(spark, f"{base}/tested", DAY)
    assert tested.columns == ["hdid", "prediction", "label", "probability", "dt"]
    scored = churn.score_churn(spark, f"{base}/t", f"{base}/m", f"{base}/s", day(DT, 30), lag=30)
    check_scores(scored, ["hdid"])
    assert scored.count() == 150


def test_risk_jobs(spark, users, tmp_path):
    base = str(tmp_path)
    accounts = users.withColumnRenamed("hdid", "uid")
    accounts = accounts.unionByName(spark.createDataFrame([("guest",)], "uid string"))
    derived = {*sets.RISK_RATIOS, "max_ip_cnts", "avg_ip_cnts", "stdev_ip_cnts"}
    columns = [c for c in sets.RISK.numeric if c not in derived]
    extra = {c: number("uid", c) for c in (*columns, "max_ip_cnt", "avg_ip_cnt", "stdev_ip_cnt")}
    extra |= {
        "dt": F.lit(DAY),
        "label": (number("uid", "label", 4) == 0).cast("int"),
        "statuscode_list": F.when(number("uid", "s", 2) == 0, "a,b").otherwise(""),
        "appid_list": F.lit("x,y,z"),
        "has_idnumber": number("uid", "has", 2).cast("int").cast("string"),
        "is_nick_modify": number("uid", "nick", 2).cast("int"),
        "regtime": F.lit("2023-01-30 10:00:00"),
    }
    table = accounts.withColumns(extra)
    training = table.withColumn("is_nick_modifys", F.col("is_nick_modify").cast("string"))
    write_partitions(training, f"{base}/labelled", ["dt"])
    write_partitions(table.drop("reg_day", "label"), f"{base}/t", ["dt"])
    paid = accounts.where("uid < '3'").withColumnRenamed("uid", "userid").withColumn("dt", F.lit(DT))
    write_partitions(paid, f"{base}/orders", ["dt"])

    trained, sweep = risk.train_risk(spark, f"{base}/labelled", f"{base}/m", f"{base}/all", DT, learner=SMALL)
    assert [r["type"] for r in sweep.orderBy("type").collect()] == ["0.70", "0.80", "0.90"]
    assert "real_cnt" in trained.reports.columns
    assert scan_day(spark, f"{base}/all", DAY).count() == 149  # neither 0 nor the guest is an id
    scored = risk.score_risk(spark, f"{base}/t", f"{base}/orders", f"{base}/m", f"{base}/s", DT, DT)
    check_scores(scored, ["uid"])
    assert scored.count() == paid.where("userid not in ('guest', '0')").count()


def test_exposure_jobs(spark, users, tmp_path):
    base = str(tmp_path)
    days = ["2024-01-28", "2024-01-29", DAY]
    raw = {
        "label": (number("hdid", "label", 3) == 0).cast("int"),
        "age": F.when(number("hdid", "age", 2) == 0, "20-30"),
        "applist": F.when(number("hdid", "apps", 2) == 0, "a|b|c"),
        "is_exposure_v2": number("hdid", "seen", 2).cast("int").cast("string"),
        "last_active_dt": F.when(F.col("hdid") == "3", DAY).otherwise("2024-01-20"),
    }
    table = wide(over_days(users, days), "hdid", sets.EXPOSURE, raw).drop("age_filled", "applists")
    write_partitions(table, f"{base}/t", ["dt"])
    lists = dict.fromkeys(sets.EXPOSURE_EVENT_LISTS, F.lit("e1|e2"))
    events = over_days(users.where("hdid < '5'"), days).withColumns(lists)
    write_partitions(events, f"{base}/e", ["dt"])

    rates = {(1, 1): 1.0, (0, 1): 1.0, (1, 0): 0.9, (0, 0): 0.9}
    trained, audit = exposure.train_exposure(
        spark, f"{base}/t", f"{base}/e", f"{base}/m", DT, days[0], days[1], DAY, learner=SMALL, rates=rates
    )
    assert audit.count() == 4
    assert audit.agg(F.sum("cnt")).first()[0] < 150  # one row per user, one user is active
    scored = exposure.score_exposure(spark, f"{base}/t", f"{base}/e", f"{base}/m", f"{base}/s", DT, DT)
    check_scores(scored, ["hdid", "is_exposure_v2", "dtype"])
    assert {tuple(r) for r in scored.groupBy("dtype", "is_exposure_v2").count().collect()} == {
        ("0", "0", 150),
        ("1", "1", 150),
    }


def test_profile_jobs(spark, folder, tmp_path):
    from pulsetrail.catalog.encoding import profiles

    rows = profiles(spark, folder).withColumns(
        {
            "hdid": F.col("c_custkey").cast("string"),
            "talk_dr": F.col("c_acctbal") / 50,
            "sing_dr": F.col("c_acctbal") / 10,
        }
    )
    for features in (sets.PROFILE, sets.PROFILE_FORMULA):
        trained = profile.train_profile(rows, features=features, learner=SMALL, negatives=3)
        assert trained.aucs.where("auc > 0.5").count() == 2
    relations = profile.profile_relations(rows)
    assert relations.count() == 12 and relations.where("pValue < 0 or pValue > 1").isEmpty()
    assert len(profile.strongest_fields(rows).first()["selected"].toArray()) == 1
    results = profile.train_sparse_profile(spark, rows, str(tmp_path / "svm"))
    hard = results["auc"].first()["auc"]
    assert results["weights"].count() == 23 and 0.5 < hard <= 1
    assert results["accuracy"].first()["accuracy"] > 0.5
    assert results["precision"].count() == 2


def test_embeddings_job(spark, folder, tmp_path):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    taken = lines.select(
        F.col("l_suppkey").alias("hdid"),
        F.col("l_partkey").cast("string").alias("doc_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt"),
    )
    vectors = recommendation.train_embeddings(taken, str(tmp_path), DT)
    assert vectors.count() == taken.select("doc_id").distinct().count()
    assert len(vectors.first()["vector"].toArray()) == 5
    assert spark.read.text(str(tmp_path / f"embedding_text_{DAY}")).count() == vectors.count()


def test_material_job(spark, users, tmp_path):
    extra = {
        "mate_id": F.concat(F.lit("m"), number("hdid", "m", 12).cast("int").cast("string")),
        "is_low_cost_retain": number("hdid", "low", 2).cast("int"),
        "is_profit_retain": F.lit(None).cast("int"),
        "sys": F.lit(None).cast("int"),
        "sjp": F.when(F.col("hdid") < "5", "PhoneA").otherwise("rare"),
    }
    table = wide(users, "hdid", sets.MATERIAL, extra)
    ranks = spark.createDataFrame([("phonea", 1), ("rare", 31)], "sjp string, rank int")
    live = users.where("hdid < '2'").withColumn("live_cnt", F.lit(4))
    apps = users.where("hdid < '3'").withColumn("applist", F.lit("a|b"))
    rows = material.material_rows(table, ranks, live, apps)
    assert rows.count() == table.count()
    assert {r[0] for r in rows.select("sjp").distinct().collect()} == {"phonea", "other"}
    assert {r[0] for r in rows.select("live_cnt").distinct().collect()} == {4, 1}
    assert rows.where("applists is null or sys <> 2 or is_profit_retain <> 2").isEmpty()

    retained = table.where("mate_id in ('m1', 'm2', 'm3')")
    sinks = {name: str(tmp_path / name) for name in ("means", "pairs", "target")}
    results = material.similar_materials(rows, table, retained, ["m1", "m2"], DAY, tables=sinks)
    assert results["means"].count() == 12
    pairs = results["pairs"].collect()
    assert {r["idB"] for r in pairs} <= {"m1", "m2"}
    assert not {r["idA"] for r in pairs} & {"m1", "m2", "m3"}
    assert results["target"].columns == ["idA", "dist"]
    assert scan_day(spark, sinks["means"], DAY).count() == 12


def test_identity_job(spark, rows, tmp_path):
    phones = [("1", "p1"), ("2", "p1"), ("3", "p2"), ("9", None)]
    cards = [("3", "c1"), ("4", "c1"), ("5", "1")]
    base = str(tmp_path)
    for name, links, column in (("phones", phones, "mobile"), ("cards", cards, "idnum")):
        df = spark.createDataFrame(links, f"uid string, {column} string")
        write_partitions(df.withColumn("dt", F.lit(DAY)), f"{base}/{name}", ["dt"])
    found = identity.write_risk_groups(spark, f"{base}/phones", f"{base}/cards", f"{base}/groups", DT)
    groups = {}
    for r in found.collect():
        groups.setdefault(r["categoryid"], set()).add((r["types"], r["vertices"]))
    assert sorted(map(sorted, groups.values())) == [
        [("idnum", "1"), ("uid", "5")],
        [("idnum", "c1"), ("mobile", "p2"), ("uid", "3"), ("uid", "4")],
        [("mobile", "p1"), ("uid", "1"), ("uid", "2")],
        [("uid", "9")],
    ]
