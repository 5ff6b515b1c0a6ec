"""Folds, recursion, jobs, sources and sinks on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import calendar as cal
from seriesloom.operators import cleaning as cl
from seriesloom.operators import explain as ex
from seriesloom.operators import folds as fd
from seriesloom.operators import forecast as fc
from seriesloom.operators import reshape as rs
from seriesloom.operators.panel import Panel
from seriesloom.plans import config, jobs
from seriesloom.plans import models as md
from seriesloom.sources import readers, sinks

FRIDAY = dt.date(2022, 1, 7)


def weekly(spark, series):
    rows = [(s, FRIDAY + dt.timedelta(weeks=i), float(v), float(3 * v + 1)) for s, vs in series.items() for i, v in enumerate(vs)]
    return Panel(spark.createDataFrame(rows, "series string, date date, y double, x double"), ["series"], ["date"])


def bounds(df):
    return [(r["fold"], r["train_end"], r["test_start"], r["test_end"]) for r in df.orderBy("series", "fold").collect()]


@pytest.mark.parametrize(
    ("n", "start", "want"),
    [
        # The second test ends on the last row's date plus one step: reach >= last, so it is the last fold.
        (20, 8, [(1, 8, 8, 14), (2, 12, 12, 18), (3, 16, 16, 20)]),
        (17, 8, [(1, 8, 8, 14), (2, 12, 12, 17)]),
        (18, 8, [(1, 8, 8, 14), (2, 12, 12, 18)]),
        (19, 8, [(1, 8, 8, 14), (2, 12, 12, 18)]),
        (10, 8, [(1, 8, 8, 10)]),
    ],
)
def test_expanding_folds(spark, n, start, want):
    p = weekly(spark, {"a": range(n)})
    assert bounds(fd.expanding_folds(p, "date", str(FRIDAY + dt.timedelta(weeks=start)), 6, 4)) == want


def test_missing_start_date_is_listed(spark):
    p = weekly(spark, {"a": range(10), "b": range(3)})
    day = str(FRIDAY + dt.timedelta(weeks=5))
    assert [r["series"] for r in fd.missing_start(p, "date", day).collect()] == ["b"]
    assert {r["series"] for r in fd.expanding_folds(p, "date", day).collect()} == {"a"}


def test_other_folds(spark):
    p = weekly(spark, {"a": range(30)})
    assert bounds(fd.tail_split(p, "date", 6)) == [(0, 24, 24, 30)]
    assert bounds(fd.end_anchored_folds(p, "date", 2, 5)) == [(0, 20, 20, 25), (1, 25, 25, 30)]
    assert bounds(fd.growing_folds(p, "date", 12, 4, 6)) == [(0, 12, 12, 18), (1, 16, 16, 22), (2, 20, 20, 26)]
    rows = fd.test_rows(p, fd.tail_split(p, "date", 3))
    assert sorted(r["y"] for r in rows.collect()) == [27, 28, 29]
    assert fd.row_from_end(p, 2).first()["y"] == 28


FS = config.FeatureSet(
    target="y", lags=(1, 3), averages=(2,), sums=(3,), lag_ratios=((1, 2),), sum_ratios=((2, 4),), average_ratios=((2, 4),), bands=(3,), strength=(4,),
    trailing_max=True,
)


def test_refreshed_features_equal_window_features(spark):
    values = [5, 7, 6, 9, 8, 12, 10, 15, 11, 18, 13, 20]
    p = weekly(spark, {"a": values})
    want = config.build(p, FS, fill=None).df.orderBy("date").collect()
    head = p.with_df(p.df.filter(F.col("date") < F.lit(FRIDAY + dt.timedelta(weeks=8))))
    state = fc.series_state(head, "y", FS.memory()).withColumn("path", F.array(*[F.lit(float(v)) for v in values[8:]]))
    got = fc.recursive_forecast(state, FS, lambda f: f["truth"], 4, exogenous={"truth": "path"}, keep_features=True).orderBy("step").collect()
    for g, w in zip(got, want[8:]):
        for name in config.output_names(FS):
            assert g[name] == pytest.approx(w[name]), name


def test_recursion_feeds_predictions_back(spark):
    p = weekly(spark, {"a": [1, 2, 3], "b": [10, 10, 10]})
    fs = config.FeatureSet(target="y", lags=(1, 2))
    rows = fc.recursive_forecast(fc.series_state(p, "y", 2), fs, fc.linear_predictor({"y_lag_1": 1.0, "y_lag_2": 1.0}), 5).orderBy("series", "step").collect()
    assert [r["prediction"] for r in rows] == [5, 8, 13, 21, 34, 20, 30, 50, 80, 130]


def test_model_recursion_equals_expression_recursion(spark):
    p = weekly(spark, {"a": [3, 4, 6, 5, 7, 9, 8, 10, 12, 11], "b": [1, 3, 2, 5, 4, 6, 8, 7, 9, 10]})
    fs = config.FeatureSet(target="y", lags=(1, 2))
    names = config.output_names(fs)
    model = md.fit(md.ModelSpec("linear"), config.build(p, fs, fill=None).df, names, "y")
    state = fc.series_state(p, "y", 2)
    by_model = fc.recursive_model_forecast(state, fs, model.predict, 7).orderBy("series", "step").collect()
    core = model.model.stages[-1]
    by_hand = fc.recursive_forecast(state, fs, fc.linear_predictor(model.coefficients(), core.intercept), 7).orderBy("series", "step").collect()
    assert [r["prediction"] for r in by_model] == pytest.approx([r["prediction"] for r in by_hand])


def test_missing_feature_gives_null_not_a_lost_row(spark):
    p = weekly(spark, {"a": [3, 4, 6, 5, 7], "new": [2]})
    fs = config.FeatureSet(target="y", lags=(1, 3))
    model = md.fit(md.ModelSpec("tree", {"maxDepth": 2}), config.build(p, fs, fill=None).df, config.output_names(fs), "y")
    got = fc.recursive_model_forecast(fc.series_state(p, "y", 3), fs, model.predict, 2).collect()
    assert sorted((r["series"], r["step"], r["prediction"] is None) for r in got) == [("a", 1, False), ("a", 2, False), ("new", 1, True), ("new", 2, True)]


def test_walk_forward_reports_every_point(spark):
    p = weekly(spark, {"a": [10 + i % 4 + 0.1 * i for i in range(40)], "b": [5 + (i % 4) * 2 for i in range(40)]})
    fs = config.FeatureSet(target="y", lags=(1, 4), exog_lags={"x": (4,)})
    folds = fd.end_anchored_folds(p, "date", 2, 4)
    report, importances = jobs.walk_forward(p, fs, [md.ModelSpec("ridge"), md.ModelSpec("tree", {"maxDepth": 4})], folds, [0, 1], 4)
    rows = report.collect()
    assert len(rows) == 2 * 2 * 2 * 4 and all(r["forecast"] is not None for r in rows)
    assert importances.count() == 2 * 2 * 3
    assert jobs.select_model(report).first()["best_model"] in ("ridge", "tree")


def test_other_columns_are_forecast_once_per_fold(spark, monkeypatch):
    p = weekly(spark, {"a": [(i * i * 7 + 3 * i) % 23 + 0.1 * i for i in range(40)], "b": [(i * i * 5 + i) % 19 for i in range(40)]})
    # Nothing is a combination of the rest, so the fits do not hang on last digits.
    p = p.with_df(p.df.withColumn("x", (F.crc32(F.concat("series", F.col("date").cast("string"))) % 100).cast("double")))
    fs = config.FeatureSet(target="y", lags=(1,), exog_lags={"x": (1,)})
    folds = fd.end_anchored_folds(p, "date", 2, 2)
    alone = {(r["series"], r["step"]): r["forecast"] for r in jobs.stepwise_prediction(p, fs, md.ModelSpec("linear"), folds, 1, 2)[0].collect()}
    made, plain = [], jobs.exogenous_paths
    monkeypatch.setattr(jobs, "exogenous_paths", lambda *a, **kw: made.append(1) or plain(*a, **kw))
    rows = jobs.walk_forward(p, fs, [md.ModelSpec("ridge"), md.ModelSpec("linear")], folds, [0, 1], 2)[0].collect()
    assert len(made) == 2
    assert {(r["series"], r["step"]): r["forecast"] for r in rows if r["model_type"] == "linear" and r["window"] == 1} == pytest.approx(alone)


def test_training_saves_and_loads(spark):
    p = weekly(spark, {"a": [10 + i % 4 for i in range(60)]})
    fs = config.FeatureSet(target="y", lags=(1, 4))
    folder = sinks.scratch_folder(spark)
    best, table = jobs.train_and_choose(p, fs, [md.ModelSpec("ridge"), md.ModelSpec("tree", {"maxDepth": 5})], 28, folder)
    assert table.count() == 2 and best.spec.label == "tree"
    again = md.load(best.spec, best.features, f"{folder}/tree")
    rows = jobs.inference(p, fs, [again], 4, "2023-03-01").orderBy("step").collect()
    assert [r["forecast"] for r in rows] == pytest.approx([10, 11, 12, 13])
    assert rows[0]["date"] == FRIDAY + dt.timedelta(weeks=60)


def test_searches(spark):
    p = weekly(spark, {"a": [10 + i % 4 for i in range(40)]})
    fs = config.FeatureSet(target="y", lags=(1, 4))
    table, best = jobs.grid_search(p, fs, "ridge", 2, 4)
    assert table.count() == 8 and best.count() == 1
    trials = jobs.random_search(p, fs, "tree", 2, 4).collect()
    assert len({r["params"] for r in trials}) == 2


def test_calendar_rules_disagree_on_weekends(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, d),) for d in (1, 2, 3, 4)], "d date")
    got = df.select(cal.week_ending("d", "FRI").alias("a"), cal.friday_of_week("d").alias("b")).collect()
    assert [r["a"].day for r in got] == [1, 8, 8, 8] and [r["b"].day for r in got] == [1, 1, 1, 8]
    months = spark.createDataFrame([(dt.date(2024, 1, 15),), (dt.date(2024, 1, 16),), (dt.date(2024, 12, 31),)], "d date")
    assert [r[0] for r in months.select(cal.nearest_month_start("d")).collect()] == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2025, 1, 1)]
    assert cal.working_horizon_days(10) == 8 and cal.working_horizon_days(7) == 5


def test_align_keeps_empty_weeks_and_first_values(spark):
    rows = [("a", dt.date(2024, 3, 4), None, 1.0), ("a", dt.date(2024, 3, 5), 7.0, 2.0), ("a", dt.date(2024, 3, 20), 9.0, None)]
    got = cal.align_to_weekday(spark.createDataFrame(rows, "series string, date date, p double, q double"), ["series"], "date", ["p", "q"]).orderBy("date").collect()
    assert [(r["date"].day, r["p"], r["q"]) for r in got] == [(8, 7.0, 1.0), (15, None, None), (22, 9.0, None)]
    assert got[0]["original_date"] == dt.date(2024, 3, 4) and got[1]["original_date"] is None


def test_infer_step(spark):
    p = weekly(spark, {"w": range(5)})
    r = cal.infer_step(p, "date").first()
    assert (r["step_days"], r["regular"], r["frequency"]) == (7, True, "W")


def test_named_features_ignore_other_names(spark):
    p = weekly(spark, {"a": [1, 2, 3, 4]})
    got = config.from_names(p, "y", ["Y_LAG_1", "Y_MA_2", "MONTH"], fill=None).df.orderBy("date").collect()
    assert [r["Y_LAG_1"] for r in got] == [None, 1, 2, 3] and [r["Y_MA_2"] for r in got] == [None, None, 1.5, 2.5]


def test_names_outliers_and_champion(spark):
    assert cl.clean_name("Price (US$T)/ton  X") == "price_ususdtton_x"
    df = spark.createDataFrame([("a", float(i)) for i in range(101)], "series string, v double")
    assert cl.flag_outliers(df, ["series"], "v", (0.05, 0.95)).filter("is_outlier").count() == 10
    a = spark.createDataFrame([("old", 0.2)], "m string, e double")
    b = spark.createDataFrame([("new", 0.1)], "m string, e double")
    assert rs.champion_or_challenger(a, b, "e", "m").first()["chosen"] == "new"
    assert rs.champion_or_challenger(b, a, "e", "m").first()["chosen"] == "new"


def test_sinks(spark):
    folder = sinks.scratch_folder(spark)
    schema = {"series": "string", "v": "double", "run_date": "date"}
    one = spark.createDataFrame([("a", 1.0, dt.date(2024, 1, 1), "junk")], "series string, v double, run_date date, extra string")
    two = spark.createDataFrame([("b", dt.date(2024, 1, 2))], "series string, run_date date")
    sinks.append_facts(one, f"{folder}/f", schema)
    sinks.append_facts(two, f"{folder}/f", schema)
    rows = {r["series"]: r["v"] for r in spark.read.parquet(f"{folder}/f").collect()}
    assert rows == {"a": 1.0, "b": None}
    sinks.export_csv(one.repartition(3), f"{folder}/c", single_file=True)
    many = spark.range(10)
    sinks.export_csv(many.repartition(3), f"{folder}/m")
    assert spark.read.option("header", True).csv(f"{folder}/m").count() == 10
    (params,) = readers.read_params(spark, write_json(folder), "max_depth int, learning_rate double").collect()
    assert params["max_depth"] == 3


def write_json(folder):
    path = folder.removeprefix("file:") + "-params.json"
    with open(path, "w") as f:
        f.write('{"max_depth": 3, "learning_rate": 0.1}')
    return path


def test_series_name_from_path(spark):
    folder = sinks.scratch_folder(spark)
    sinks.write_dataset(spark.createDataFrame([("2024-01-01 10:00:00", 1.0)], "stamp string, close double"), folder, "x", "csv")
    df = spark.read.schema("stamp timestamp_ntz, close double").option("header", True).csv(f"{folder}/x")
    out = readers.stack_histories(df, "stamp", readers.series_from_path(r"/(x)/[^/]+$"))
    r = out.first()
    assert (r["TICKER"], r["DATE"], r["CLOSE"]) == ("x", dt.date(2024, 1, 1), 1.0) and "STAMP" not in out.columns


def test_draws_repeat(spark):
    p = weekly(spark, {"a": [1, 2, 3, 4, 5]})
    future = cal.future_weeks(p.df, ["series"], "date", 2)
    go = lambda: ex.simulated_inputs(p.df, future, ["series", "date"], ["series"], ["x"], 1500)
    a, b = (sorted((r["step"], r["draw"], r["x"]) for r in go().collect()) for _ in range(2))
    assert a == b and len(a) == 3000
    got = go().agg(F.avg("x"), F.stddev_samp("x")).first()
    want = p.df.agg(F.avg("x"), F.stddev_samp("x")).first()
    assert got[0] == pytest.approx(want[0], abs=0.5) and got[1] == pytest.approx(want[1], rel=0.1)
