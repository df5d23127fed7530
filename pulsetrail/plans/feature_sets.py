"""Which columns each job reads, and how its learner is set up. All entries are fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from pulsetrail.operators.pipelines import Features, Learner, TextColumn


def windows(names: Sequence[str], days: Sequence[int], joint: str = "_d") -> list[str]:
    """Trailing-window columns: every name with every number of days."""
    return [f"{name}{joint}{n}" for name in names for n in days]


MONTH = (1, 3, 7, 14, 30)

USER_CATEGORIES = [
    "sex", "bd_consum", "bd_marriage", "bd_subconsum", "sys",
    "start_period_d7", "start_period_d14", "start_period_d30", "city_level", "sjp",
]

CLICK = Features(
    categorical=[*USER_CATEGORIES, "tag_type"],
    numeric=[
        *windows(
            [
                "start_cnt", "active_days", "total_watch_dr", "avg_watch_dr", "consume_cnt",
                "exposure_cnt", "click_cnt", "push_click_cnt", "push_click_day",
            ],
            MONTH,
        ),
        "title_length", "content_length",
        *windows(["show", "click"], (*MONTH, 90), "_"),
        *windows(["wilson_ctr"], MONTH, "_"),
    ],
    pca=60,
    unknown_category="keep",
    null_numbers="skip",
)
CLICK_LEARNER = Learner("gbt", {"maxDepth": 6, "maxIter": 20})

CLICK_VECTOR = Features(
    categorical=CLICK.categorical,
    numeric=CLICK.numeric,
    vectors=["item_vec"],
    pca=70,
    null_numbers="skip",
)
RETENTION = Features(
    categorical=CLICK.categorical,
    numeric=CLICK.numeric,
    vectors=["item_vec"],
    pca=70,
    label="r_label",
)
RETENTION_LEARNER = Learner("gbt", {"maxIter": 20})

CHURN = Features(
    categorical=USER_CATEGORIES,
    numeric=[
        *windows(
            [
                "start_cnt", "active_days", "total_watch_dr", "avg_watch_dr", "search_cnt",
                "consume_cnt", "channel_msg_cnt", "consume_money", "cancel_cnt", "subscribe_cnt",
                "exposure_cnt", "click_cnt", "push_click_cnt", "push_click_day",
            ],
            MONTH,
        ),
        "live_cnt",
    ],
    pca=50,
)
CHURN_LEARNER = Learner("gbt", {"maxIter": 20})

RISK = Features(
    numeric=[
        "avg_chid_times_90", "avg_method_times_90", "buyer_pay_ratio", "cnt_90", "day_90", "sid_90",
        "sid_all_90", "avg_sid_cnt_90", "avg_sid_90", "sub_cnt", "cont_d_90", "cont_all_90",
        "avg_cont_90", "gift_cnt_90", "sum_90", "stddev_90", "avg_90", "alldt_90", "amount_90",
        "avg_amount_90", "stddev_amount_90", "chid_90", "paymethod_90", "userip_90", "max_cnt_90",
        "avg_cnt_90", "no_active_90", "no_active_pay_90", "max_cnt", "avg_cnt", "avg_delta_time",
        "avg_all_90", "stddev_all_90", "max_device_cnt", "avg_device_cnt", "stdev_device_cnt",
        "max_ip_cnts", "avg_ip_cnts", "stdev_ip_cnts", "appid_cnt", "buyerid_cnt", "hdid_cnt",
        "apporderid_cnt", "reg_day", "fail_rate",
    ],
    formula=["is_nick_modifys", "has_idnumber"],
    text=[TextColumn("statuscode_list", ",", 10), TextColumn("appid_list", ",", 10)],
    null_numbers="skip",
)
RISK_LEARNER = Learner("gbt", {"maxIter": 20})
RISK_THRESHOLDS = (0.7, 0.8, 0.9)
RISK_RATIOS = {
    "avg_chid_times_90": ("chid_90", "alldt_90"),
    "avg_method_times_90": ("paymethod_90", "alldt_90"),
    "buyer_pay_ratio": ("buyerid_cnt", "alldt_90"),
}

EXPOSURE_EVENT_LISTS = ["event_act_list_d4_d7", "event_act_list_d8_d14", "event_act_list_d15_d30"]
EXPOSURE = Features(
    numeric=windows(
        ["start_cnt", "active_days", "total_watch_dr", "consume_cnt", "push_click_cnt"], (7, 14, 30)
    ),
    formula=[
        "sex", "age_filled", "city_level", "sjp", "sys", "bd_consum", "bd_marriage", "bd_subconsum",
        "bd_age",
    ],
    text=[TextColumn("applists", r"\|", 10)],
    flags=["is_exposure_v2"],
    pca=20,
)
EXPOSURE_LEARNER = Learner("gbt", {"maxDepth": 3, "maxIter": 20})

MATERIAL_CATEGORIES = [
    "sex", "age", "ip_city_level", "bd_consum", "bd_marriage", "bd_subconsum", "sjp",
]
MATERIAL = Features(
    numeric=windows(["start_cnt", "active_days", "total_watch_dr", "consume_cnt"], (1, 3, 7)),
    formula=MATERIAL_CATEGORIES,
    text=[TextColumn("applists", r"\|", 10)],
    label="is_low_cost_retain",
)
MATERIAL_DEFAULTS = {
    "is_low_cost_retain": 2,
    "is_profit_retain": 2,
    "sex": "other",
    "age": "other",
    "ip_city_level": "other",
    "bd_consum": "other",
    "bd_marriage": "other",
    "bd_subconsum": "other",
    "sys": 2,
}

PROFILE_FIELDS = [
    "bd_sex", "bd_age", "bd_consume", "bd_marriage", "bd_high_value", "bd_low_value", "bd_sing",
    "bd_dance", "bd_talk", "bd_outdoor", "bd_game", "bd_sport",
]
PROFILE = Features(categorical=PROFILE_FIELDS)
PROFILE_FORMULA = Features(formula=PROFILE_FIELDS, formula_nulls="error")
PROFILE_TREES = Learner("gbt")
PROFILE_LONG_TREES = Learner("gbt", {"maxDepth": 3, "maxIter": 100, "stepSize": 1.0})
PROFILE_LOGISTIC = Learner("logistic")
# no intercept and no penalty, as the L-BFGS trainer of the RDD library has it
PROFILE_PLAIN_LOGISTIC = Learner("logistic", {"fitIntercept": False, "regParam": 0.0})
TALK_BAR = 137
SING_BAR = 300

# learners that can stand in for the trees; the first layer is the width of the feature vector
ELASTIC_NET = Learner("logistic", {"regParam": 0.3, "elasticNetParam": 0.8})
PERCEPTRON_HIDDEN = (280, 140)


def perceptron(width: int) -> Learner:
    return Learner(
        "perceptron", {"layers": [width, *PERCEPTRON_HIDDEN, 2], "blockSize": 128, "maxIter": 50}
    )


# day offsets
CLICK_SNAPSHOTS = (-27, -20, -13, -6, 0)
CHURN_SNAPSHOTS = (0, -2, -6, -8)
CLICK_TEST_OFFSET = -10
CHURN_TEST_OFFSET = 30
CHURN_MODEL_LAG = 46
