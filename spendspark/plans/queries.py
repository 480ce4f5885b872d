"""Every query by name: ``(spark, sf_dir) -> DataFrame`` over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendspark.functions import calendar, labels, numeric
from spendspark.functions.parsing import parse_amount, parse_date
from spendspark.operators import anomaly, clean, monthly, peers, weekly
from spendspark.operators.order_stats import exact_percentile
from spendspark.operators.split import hashed_split, ordered_split
from spendspark.plans import scoring, training
from spendspark.schemas import ANOMALY_FEATURES, CATEGORY_TARGET
from spendspark.session import materialise, scratch_path
from spendspark.sources import artifacts, synthetic, transactions
from spendspark.sources.adapters import tx_events, tx_lineitem, tx_orders
from spendspark.streaming import anomaly as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Registers a query; its days come out as ISO text, which every client shows alike."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        days = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
        return df.withColumns({name: F.col(name).cast("string") for name in days})

    QUERIES[fn.__name__] = run
    return run


def spread(array: str, prefix: str, n: int = weekly.WINDOW_SIZE) -> list[Column]:
    """The elements of an array as columns of their own."""
    return [F.col(array)[i].alias(f"{prefix}{i + 1}") for i in range(n)]


# ---- sources and cleaning ------------------------------------------------------------------


def _amount_texts() -> Column:
    """Sixteen ways an amount may be written, one per row by its key."""
    exact = F.col("l_extendedprice").cast("decimal(18,2)")
    text, whole = exact.cast("string"), F.floor(exact).cast("string")
    variants = [
        text,
        F.concat(F.lit(" "), text, F.lit(" ")),
        F.concat(F.lit("+"), text),
        F.concat(whole, F.lit(".")),
        F.concat(whole, F.lit("e1")),
        F.concat(whole, F.lit(",000")),
        F.concat(whole, F.lit("_000")),
        F.concat(F.lit("0x"), whole),
        F.concat(text, F.lit("d")),
        F.concat(text, F.lit("f")),
        F.lit("NaN"),
        F.lit(""),
        F.lit(None).cast("string"),
        F.concat(F.lit("abc"), whole),
        F.lit("inf"),
        F.concat(F.lit("-"), text),
    ]
    number = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(variants))).cast("int")
    return F.element_at(F.array(*variants), number + 1)


@query
def amount_coercion(spark, sf_dir):
    """B2 on amounts written in valid and invalid ways."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return items.withColumn("amount_text", _amount_texts()).select(
        "l_orderkey",
        "l_linenumber",
        "amount_text",
        parse_amount(F.col("amount_text")).cast("double").alias("amount"),
    )


@query
def date_parsing(spark, sf_dir):
    """B1 on dates written in several ways, and on missing ones."""
    ordered = F.col("o_orderdate")
    variants = F.array(
        F.date_format(ordered, "yyyy-MM-dd"),
        F.date_format(ordered, "yyyy-M-d"),
        F.date_format(ordered, "yyyy-MM-dd HH:mm:ss"),
        F.concat(F.lit(" "), F.date_format(ordered, "yyyy-MM-dd"), F.lit(" ")),
        F.date_format(ordered, "yyyy-MM-dd'T'23:59:59"),
        F.lit(""),
        F.lit("NaT"),
        F.lit(None).cast("string"),
    )
    text = F.element_at(variants, F.pmod(F.col("o_orderkey"), F.lit(8)).cast("int") + 1)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.withColumn("date_text", text).select(
        "o_orderkey", "date_text", parse_date(F.col("date_text")).alias("date")
    )


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw records: some without a user or date, notes with quotes and commas."""
    key = F.col("transaction_id")
    return tx_orders(spark, sf_dir).select(
        "transaction_id",
        F.when(F.pmod(key, F.lit(50)) != 0, F.col("user_id")).alias("user_id"),
        "category_id",
        "amount",
        F.when(F.pmod(key, F.lit(75)) != 0, F.col("date")).alias("date"),
        F.concat(F.lit('ăn "sáng", '), F.col("category_id").cast("string")).alias("note"),
    )


def _money_as_double(tx: DataFrame) -> DataFrame:
    return tx.withColumn("amount", F.col("amount").cast("double"))


@query
def csv_without_header(spark, sf_dir):
    """Written as headerless CSV, read back and normalised."""
    path = scratch_path(spark, "csv")
    _order_records(spark, sf_dir).write.option("escape", '"').csv(path)
    return _money_as_double(clean.normalise(transactions.read_csv(spark, path)))


@query
def csv_with_header(spark, sf_dir):
    """A1: columns in another order and the older name of the date column."""
    path = scratch_path(spark, "csv-header")
    records = _order_records(spark, sf_dir).withColumnRenamed("date", "transaction_date")
    columns = ["note", "transaction_date", "amount", "category_id", "user_id", "transaction_id"]
    records.select(columns).write.option("escape", '"').option("header", True).csv(path)
    return _money_as_double(clean.normalise(transactions.read_csv(spark, path)))


@query
def json_records(spark, sf_dir):
    """A3: landed JSON records."""
    path = scratch_path(spark, "json")
    _order_records(spark, sf_dir).write.json(path)
    return _money_as_double(clean.normalise(transactions.read_json(spark, path)))


@query
def json_records_alias(spark, sf_dir):
    """A3: records that name their day ``transaction_date``, half of them both ways."""
    path = scratch_path(spark, "json-alias")
    records = _order_records(spark, sf_dir).withColumn("transaction_date", F.col("date"))
    even = F.pmod(F.col("transaction_id"), F.lit(2)) == 0
    records.withColumn("date", F.when(even, F.col("date"))).write.json(path)
    return _money_as_double(clean.normalise(transactions.read_json(spark, path)))


@query
def ingest_rejects(spark, sf_dir):
    """Broken lines, amounts out of range, missing days and missing keys, counted by reason."""
    path = scratch_path(spark, "json-broken")
    key = F.col("transaction_id")
    records = _order_records(spark, sf_dir).withColumns(
        {
            "amount": F.when(F.pmod(key, F.lit(41)) == 0, F.lit("1e30")).otherwise(F.col("amount").cast("string")),
            "category_id": F.when(F.pmod(key, F.lit(100)) != 0, F.col("category_id")),
        }
    )
    line = F.when(F.pmod(key, F.lit(30)) == 0, F.lit('{"transaction_id": ')).otherwise(F.to_json(F.struct(*records.columns)))
    records.select(line.alias("value")).write.text(path)
    judged = clean.judged(transactions.read_json(spark, path))
    return judged.groupBy(F.coalesce("error", F.lit("usable")).alias("outcome")).agg(F.count("*").alias("n"))


@query
def date_format(spark, sf_dir):
    """B1 with a format of its own, B2 with six decimals."""
    path = scratch_path(spark, "csv-days")
    records = _order_records(spark, sf_dir).withColumns(
        {
            "date": F.date_format("date", "dd.MM.yyyy"),
            "amount": F.concat(F.col("amount").cast("decimal(18,2)").cast("string"), F.lit("0125")),
        }
    )
    records.write.option("escape", '"').csv(path)
    return _money_as_double(clean.normalise(transactions.read_csv(spark, path), "dd.MM.yyyy")).drop("note")


def _orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which some have no user and others no category."""
    key = F.col("transaction_id")
    return tx_orders(spark, sf_dir).withColumns(
        {
            "user_id": F.when(F.pmod(key, F.lit(11)) != 0, F.col("user_id")),
            "category_id": F.when(F.pmod(key, F.lit(7)) != 0, F.col("category_id")),
        }
    )


@query
def weekly_spend_missing_keys(spark, sf_dir):
    """A transaction without a category counts in its user's week."""
    return weekly.weekly_spend(_orders_with_gaps(spark, sf_dir))


@query
def monthly_features_missing_keys(spark, sf_dir):
    """A transaction without a category counts in its user's monthly total."""
    return monthly.monthly_features(_orders_with_gaps(spark, sf_dir))


@query
def category_average_missing_keys(spark, sf_dir):
    """A transaction without a user counts in its category's average."""
    return anomaly.category_average(_orders_with_gaps(spark, sf_dir))


@query
def snapshot_after_empty_batch(spark, sf_dir):
    """A4: an empty batch leaves the published snapshot in place."""
    root = scratch_path(spark, "snapshots")
    orders = tx_orders(spark, sf_dir)
    transactions.publish_snapshot(orders, root)
    transactions.publish_snapshot(orders.where(F.lit(False)), root)
    return _money_as_double(transactions.read_snapshot(spark, root))


@query
def distinct_users(spark, sf_dir):
    """D6."""
    return clean.distinct_users(tx_lineitem(spark, sf_dir))


@query
def calendar_parts(spark, sf_dir):
    """B3, B4, B5 and the week edge of D1."""
    day = F.col("date")
    return tx_lineitem(spark, sf_dir).select(
        "transaction_id",
        "user_id",
        "date",
        calendar.day_of_week(day).alias("day_of_week"),
        calendar.day_of_month(day).alias("day_of_month"),
        calendar.month_start(day).alias("year_month"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        calendar.week_end(day).alias("week_end"),
    )


# ---- weekly --------------------------------------------------------------------------------


def _weekly(tx: DataFrame) -> DataFrame:
    return weekly.weekly_spend(tx)


@query
def weekly_spend(spark, sf_dir):
    """D1."""
    return _weekly(tx_orders(spark, sf_dir))


@query
def weekly_spend_gap_filled(spark, sf_dir):
    """D1, C3 on sparse series."""
    return weekly.weekly_series(tx_orders(spark, sf_dir))


@query
def weekly_spend_gap_filled_events(spark, sf_dir):
    """D1, C3 on data with times of day."""
    return weekly.weekly_series(tx_events(spark, sf_dir))


@query
def user_p95_scale(spark, sf_dir):
    """D5."""
    return weekly.user_scale(_weekly(tx_orders(spark, sf_dir)))


@query
def weekly_normalised(spark, sf_dir):
    """E6, B7."""
    series = weekly.normalised_series(_weekly(tx_orders(spark, sf_dir)))
    return series.select("user_id", "week_end", "spend", "scale", "scaled")


def _flat_sequences(seqs: DataFrame) -> DataFrame:
    return seqs.select("user_id", "target_week", *spread("x", "x"), "y", "scale")


@query
def weekly_sequences(spark, sf_dir):
    """E5, B10 around the boundary of 4 and 5 weeks."""
    return _flat_sequences(weekly.sequences(_weekly(tx_events(spark, sf_dir))))


@query
def weekly_sequences_lineitem(spark, sf_dir):
    """E5, B10 on dense series."""
    return _flat_sequences(weekly.sequences(_weekly(tx_lineitem(spark, sf_dir))))


@query
def weekly_sequences_active(spark, sf_dir):
    """E5, B10, B11 on sparse series, where most sequences are inactive."""
    return _flat_sequences(weekly.active_sequences(_weekly(tx_orders(spark, sf_dir))))


@query
def weekly_sequences_active_lineitem(spark, sf_dir):
    """E5, B10, B11 on dense series."""
    return _flat_sequences(weekly.active_sequences(_weekly(tx_lineitem(spark, sf_dir))))


@query
def stored_sequences(spark, sf_dir):
    """Sequences written with their window size and read back."""
    path = scratch_path(spark, "sequences")
    training.sequences_job(tx_events(spark, sf_dir), path)
    seqs, window = artifacts.read_sequences(spark, path)
    return _flat_sequences(seqs).withColumn("window_size", F.lit(window))


@query
def sequence_split(spark, sf_dir):
    """G1: the first 80 % in (user, week) order."""
    seqs = materialise(weekly.active_sequences(_weekly(tx_lineitem(spark, sf_dir))), "sequences")
    return ordered_split(seqs).select("user_id", "target_week", "y", "is_train")


@query
def weekly_scoring_frame(spark, sf_dir):
    """E8, F3, F4."""
    frame = scoring.weekly_inputs(weekly.latest_weeks(_weekly(tx_events(spark, sf_dir))))
    weeks = F.col("weekly_spending")
    return frame.select(
        "user_id",
        "last_week",
        *spread("weekly_spending", "w"),
        *spread("x", "x"),
        "peak",
        F.element_at(weeks, -1).alias("latest"),
        numeric.array_sum(weeks).alias("total"),
        numeric.array_mean(weeks).alias("mean"),
    )


@query
def trend_label_weekly(spark, sf_dir):
    """F4, B13, B14, B15, B19 for the mean of the four weeks as given forecast."""
    frame = weekly.latest_weeks(_weekly(tx_lineitem(spark, sf_dir)))
    naive = frame.withColumn("forecast", numeric.array_mean(F.col("weekly_spending")))
    results = scoring.weekly_results(naive, "forecast", "user_id")
    return results.select(
        "user_id", "predicted_spending", *spread("input_weeks", "w"), "trend", "change_percent"
    )


@query
def scoring_input_rejects(spark, sf_dir):
    """Whole weekly histories as requests; those without exactly 4 weeks are rejected."""
    requests = weekly.spending_lists(_weekly(tx_events(spark, sf_dir)))
    _, rejected = scoring.accepted_and_rejected(requests, scoring.weekly_request_error())
    return rejected.select("user_id", F.size("weekly_spending").alias("n_weeks"), "error")


@query
def requests_with_gaps(spark, sf_dir):
    """Requests of which every second has a missing element or field, by kind."""
    tx = tx_events(spark, sf_dir)
    odd = F.pmod(F.col("user_id"), F.lit(2)) == 1
    hole = F.lit(None).cast("double")
    weeks = weekly.latest_weeks(_weekly(tx)).withColumn(
        "weekly_spending",
        F.transform("weekly_spending", lambda v, i: F.when(odd & (i == F.pmod(F.col("user_id"), F.lit(4))), hole).otherwise(v)),
    )
    _, bad_weeks = scoring.accepted_and_rejected(weeks, scoring.weekly_request_error())
    users = weeks.select(
        "user_id", F.lit(1).alias("category_id"), F.array(F.lit(1.0), F.when(~odd, 2.0)).alias("monthly_averages"),
        F.when(F.pmod(F.col("user_id"), F.lit(6)) != 2, 3.0).alias("user_current_spending"),
    )
    _, bad_trends = scoring.analyse_trend(users, "user_id")
    gaps = tx.withColumn("date", F.when(~odd, F.col("date"))).withColumn(
        "amount", F.when(F.pmod(F.col("transaction_id"), F.lit(5)) != 0, F.col("amount"))
    )
    features = anomaly.anomaly_features(gaps, _averages(tx))
    missing = scoring.missing_input_error([c for c in ANOMALY_FEATURES if c != "amount_vs_category_avg"])
    _, bad_tx = scoring.accepted_and_rejected(features, missing)
    kinds = {"weekly": bad_weeks, "trend": bad_trends, "transaction": bad_tx}
    counts = [df.groupBy(F.lit(kind).alias("kind"), "error").agg(F.count("*").alias("n")) for kind, df in kinds.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# ---- monthly -------------------------------------------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.monthly_features(tx_lineitem(spark, sf_dir))


@query
def monthly_category_spend(spark, sf_dir):
    """D2."""
    return monthly.as_money_totals(monthly.monthly_category(tx_lineitem(spark, sf_dir)))


@query
def monthly_user_total(spark, sf_dir):
    """D3."""
    return monthly.user_month_total(monthly.monthly_spending(tx_lineitem(spark, sf_dir)))


@query
def category_ratio(spark, sf_dir):
    """C1, B6."""
    shares = monthly.with_ratio(monthly.monthly_category(tx_lineitem(spark, sf_dir)))
    return shares.select(
        "user_id", "category_id", "year_month", "monthly_spending", "total_all_categories", "category_ratio"
    )


@query
def monthly_lags(spark, sf_dir):
    """E1."""
    return _features(spark, sf_dir).select(
        "user_id", "category_id", "year_month", "prev_month_spending", "prev_month_count", "prev_month_ratio"
    )


@query
def rolling_3m_prior(spark, sf_dir):
    """E2."""
    return _features(spark, sf_dir).select("user_id", "category_id", "year_month", "avg_monthly_spending_3m")


@query
def spending_trend(spark, sf_dir):
    """E4, B6, B7."""
    return _features(spark, sf_dir).select("user_id", "category_id", "year_month", "spending_trend")


@query
def monthly_target(spark, sf_dir):
    """E3."""
    return _features(spark, sf_dir).select("user_id", "category_id", "year_month", CATEGORY_TARGET)


@query
def monthly_training_features(spark, sf_dir):
    """The whole monthly path with B8."""
    return monthly.training_rows(_features(spark, sf_dir))


@query
def monthly_training_features_orders(spark, sf_dir):
    """The same on sparse series, where the previous active month is often not the calendar one."""
    return monthly.training_rows(monthly.monthly_features(tx_orders(spark, sf_dir)))


@query
def monthly_scoring_frame(spark, sf_dir):
    """E7."""
    return monthly.scoring_rows(_features(spark, sf_dir))


@query
def trend_label_category(spark, sf_dir):
    """B13, B14, B15, B19 for the three-month mean as given forecast."""
    rows = monthly.training_rows(_features(spark, sf_dir))
    naive = rows.withColumn("forecast", F.col("avg_monthly_spending_3m"))
    return scoring.category_results(naive, "forecast", "user_id", "year_month")


@query
def naive_forecast_error(spark, sf_dir):
    """D8 of the three-month mean as forecast."""
    rows = monthly.training_rows(_features(spark, sf_dir))
    errors = training.regression_error(rows, CATEGORY_TARGET, "avg_monthly_spending_3m")
    return errors.select(F.bround("rmse", 4).alias("rmse"), F.bround("mae", 4).alias("mae"))


@query
def sample_counts(spark, sf_dir):
    """Transactions, monthly training rows and active sequences."""
    tx = tx_lineitem(spark, sf_dir)
    features = materialise(monthly.monthly_features(tx), "monthly-features")
    counts = [
        # Every transaction is in one of the monthly rows.
        features.agg(F.lit("transactions").alias("stage"), F.sum("transaction_count").alias("n")),
        *[
            df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("n"))
            for name, df in {
                "monthly_rows": monthly.training_rows(features), "sequences": weekly.active_sequences(_weekly(tx))
            }.items()
        ],
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def hashed_split_sides(spark, sf_dir):
    """Which monthly training rows are held out."""
    rows = monthly.training_rows(_features(spark, sf_dir))
    split = hashed_split(rows, ["user_id", "category_id", "year_month"])
    return split.select("user_id", "category_id", "year_month", "is_train")


# ---- peers ---------------------------------------------------------------------------------


@query
def population_trend(spark, sf_dir):
    """Latest month against the mean of all user-months of a category."""
    compared = peers.with_population_mean(monthly.monthly_category(tx_lineitem(spark, sf_dir)))
    return scoring.deviation_results(compared, "user_id")


@query
def population_trend_arrays(spark, sf_dir):
    """H2 and B20 on requests with arrays: the latest month against the user's earlier ones."""
    months = monthly.monthly_category(tx_orders(spark, sf_dir)).groupBy("user_id", "category_id").agg(
        F.array_sort(
            F.collect_list(F.struct("year_month", F.col("spending").cast("double").alias("spending")))
        ).alias("months")
    )
    spendings = F.transform("months", lambda m: m["spending"])
    requests = months.select(
        "user_id",
        "category_id",
        F.slice(spendings, 1, F.size("months") - 1).alias("monthly_averages"),
        F.element_at(spendings, -1).alias("user_current_spending"),
    )
    results, rejected = scoring.analyse_trend(requests, "user_id")
    return results.withColumn("error", F.lit(None).cast("string")).unionByName(
        rejected.select("user_id", "category_id", "error"), allowMissingColumns=True
    )


# ---- anomalies -----------------------------------------------------------------------------


def _averages(tx: DataFrame) -> DataFrame:
    return materialise(anomaly.category_average(tx), "category-averages")


def _anomaly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = tx_orders(spark, sf_dir)
    return anomaly.anomaly_features(tx, _averages(tx))


@query
def category_average(spark, sf_dir):
    """D4."""
    return anomaly.category_average(tx_orders(spark, sf_dir))


@query
def anomaly_features(spark, sf_dir):
    """B3, B4, C2, B6."""
    return _anomaly_features(spark, sf_dir).select("transaction_id", *ANOMALY_FEATURES)


@query
def anomaly_message(spark, sf_dir):
    """B18 with a given flag: more than twice the category's mean."""
    rows = _anomaly_features(spark, sf_dir)
    ratio = F.col("amount_vs_category_avg")
    return rows.select(
        "transaction_id",
        (ratio > 2).alias("is_anomaly"),
        labels.anomaly_message(ratio > 2, F.col("amount"), ratio).alias("message"),
    )


@query
def anomaly_share(spark, sf_dir):
    """D7 with the same given flag."""
    flagged = _anomaly_features(spark, sf_dir).select((F.col("amount_vs_category_avg") > 2).alias("is_anomaly"))
    return training.anomaly_counts(flagged)


@query
def ratio_threshold(spark, sf_dir):
    """The exact 5 % threshold of G7, taken over the amount ratios."""
    ratios = materialise(_anomaly_features(spark, sf_dir).select("amount_vs_category_avg"), "ratios")
    threshold = exact_percentile(ratios, "amount_vs_category_avg", 0.05)
    below = F.count_if(F.col("amount_vs_category_avg") < threshold)
    return ratios.agg(F.bround(F.lit(threshold), 9).alias("threshold"), below.alias("n_below"))


@query
def iforest_flags(spark, sf_dir):
    """Every order scored by a forest fitted on all of them, from the stored scores."""
    model = training.fit_anomaly(tx_orders(spark, sf_dir))
    return training.training_results(model).select("transaction_id", "is_anomaly", "anomaly_score", "message")


@query
def iforest_detection(spark, sf_dir):
    """G6, G7, G8 on A11: how many of the injected outliers a forest flags, and how many of the others."""
    tx = materialise(synthetic.outlier_transactions(_customers(spark, sf_dir)), "outliers")
    model = training.fit_anomaly(tx, carried=("is_injected",))
    flagged = training.training_results(model, "is_injected")
    return flagged.groupBy("is_injected").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anomaly").alias("n_flagged"))


@query
def iforest_share(spark, sf_dir):
    """How many of the orders a forest was fitted on it calls anomalies, and their share."""
    return training.anomaly_counts(training.training_flags(training.fit_anomaly(tx_orders(spark, sf_dir))))


@query
def iforest_stream(spark, sf_dir):
    """H5: a file stream that stops when all files are read gives each row what the batch gives it.

    Every seventh order is of a category that the model has not seen, and every fifth has no day.
    """
    key = F.col("transaction_id")
    known = tx_orders(spark, sf_dir)
    folder = scratch_path(spark, "stream-in")
    known.withColumns(
        {
            "category_id": F.when(F.pmod(key, F.lit(7)) == 0, F.lit(99)).otherwise(F.col("category_id")),
            "date": F.when(F.pmod(key, F.lit(5)) != 0, F.col("date")),
        }
    ).write.parquet(folder)
    tx = spark.read.parquet(folder)
    model = training.fit_anomaly(known)
    scored = stream.score_stream(stream.read_stream(spark, folder, tx.schema), model)
    out = scratch_path(spark, "stream-out")
    stream.write_scored(scored, out, once=True).awaitTermination()
    passed, turned_away = stream.read_scored(spark, out)
    results, _ = scoring.check_transactions(tx, model.averages, model.forest)
    values = ["is_anomaly", "anomaly_score", "message"]
    batch = results.select("transaction_id", F.struct(*values).alias("batch"))
    streamed = passed.select("transaction_id", F.struct(*values).alias("stream"))
    compared = streamed.join(batch, "transaction_id", "full").select(
        "transaction_id", F.col("batch").eqNullSafe(F.col("stream")).alias("as_batch"), F.lit(None).cast("string").alias("error")
    )
    return compared.unionByName(turned_away.select("transaction_id", F.lit(None).cast("boolean").alias("as_batch"), "error"))


# ---- forecasts -----------------------------------------------------------------------------


def _stored_training_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All monthly features, stored once, and the training rows among them."""
    features = materialise(_features(spark, sf_dir), "monthly-features")
    return features, monthly.training_rows(features)


def _label_agrees() -> Column:
    """Whether a trend label fits the rounded change beside it."""
    change = F.col("change_percent")
    return (
        F.when(F.col("trend") == "increasing", change >= 10)
        .when(F.col("trend") == "decreasing", change <= -10)
        .otherwise(F.abs(change) <= 10)
    )


def _quality(spark: SparkSession, fitted: training.Fitted, naive: DataFrame) -> DataFrame:
    """What is certain about a fit: sizes, evaluations, and that it beats the naive forecast on the same rows."""
    plain = naive.first()
    shares = [value for name, value in fitted.metrics.items() if name.startswith("fi_")]
    facts = {
        **fitted.counts,
        "n_evaluations": len(fitted.evaluations),
        "importances": round(sum(shares), 6),
        "better_rmse": fitted.metrics["rmse"] < plain["rmse"],
        "better_mae": fitted.metrics["mae"] < plain["mae"],
    }
    return spark.createDataFrame([(name, float(value)) for name, value in facts.items()], "fact string, value double")


@query
def gbt_category_quality(spark, sf_dir):
    """The fit with all its rounds against repeating the last month, on the held-out rows."""
    _, rows = _stored_training_rows(spark, sf_dir)
    fitted = training.fit_category(rows)
    held_out = hashed_split(rows, ["user_id", "category_id", "year_month"]).where(~F.col("is_train"))
    return _quality(spark, fitted, training.regression_error(held_out, CATEGORY_TARGET, "monthly_spending"))


@query
def category_forecast(spark, sf_dir):
    """A stored and reloaded model on the latest month of every user and category."""
    features, rows = _stored_training_rows(spark, sf_dir)
    path = scratch_path(spark, "category-model")
    fitted = training.fit_category(rows)
    artifacts.save_model(fitted.model, CATEGORY_TARGET, path)
    model, _, _ = artifacts.load_model(spark, path)
    results, rejected = scoring.predict_category(monthly.scoring_rows(features), model, "user_id", "year_month")
    keys = ["user_id", "category_id", "year_month"]
    return results.select(
        *keys, "current_spending", (F.col("predicted_spending") >= 0).alias("in_range"), _label_agrees().alias("label_agrees"),
        F.lit(None).cast("string").alias("error"),
    ).unionByName(rejected.select(*keys, "error"), allowMissingColumns=True)


def _stored_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(weekly.active_sequences(_weekly(tx_lineitem(spark, sf_dir))), "sequences")


@query
def gbt_weekly_quality(spark, sf_dir):
    """The fit against repeating the last week, on the held-out rows."""
    seqs = _stored_sequences(spark, sf_dir)
    fitted = training.fit_weekly(seqs)
    held_out = ordered_split(seqs).where(~F.col("is_train")).withColumn("last", F.element_at("x", -1))
    return _quality(spark, fitted, training.regression_error(held_out, "y", "last"))


@query
def weekly_forecast(spark, sf_dir):
    """H4: the next week of every user with at least four."""
    tx = tx_lineitem(spark, sf_dir)
    fitted = training.fit_weekly(_stored_sequences(spark, sf_dir))
    results, rejected = scoring.predict_weekly(
        weekly.latest_weeks(_weekly(tx)), fitted.model, training.LAGS, "user_id"
    )
    return results.select(
        "user_id", *spread("input_weeks", "w"), (F.col("predicted_spending") >= 0).alias("in_range"),
        _label_agrees().alias("label_agrees"), F.lit(None).cast("string").alias("error"),
    ).unionByName(rejected.select("user_id", "error"), allowMissingColumns=True)


@query
def weekly_linear_forecast(spark, sf_dir):
    """The next week of every user by least squares on the four lags, in numbers."""
    tx = tx_lineitem(spark, sf_dir)
    model = training.fit_weekly_linear(_stored_sequences(spark, sf_dir))
    results, rejected = scoring.predict_weekly_linear(weekly.latest_weeks(_weekly(tx)), model, "user_id")
    return results.select(
        "user_id", "predicted_spending", *spread("input_weeks", "w"), "trend", "change_percent",
        F.lit(None).cast("string").alias("error"),
    ).unionByName(rejected.select("user_id", "error"), allowMissingColumns=True)


@query
def weekly_linear_quality(spark, sf_dir):
    """Weights and held-out errors of the linear forecast, to six places."""
    seqs = _stored_sequences(spark, sf_dir)
    model = training.fit_weekly_linear(seqs)
    held_out = ordered_split(seqs).where(~F.col("is_train"))
    predicted = held_out.withColumn("prediction", model.predict([F.col("x")[i] for i in range(weekly.WINDOW_SIZE)]))
    errors = training.regression_error(predicted, "y", "prediction")
    weights = [F.lit(w).alias(f"weight{i + 1}") for i, w in enumerate(model.weights)]
    values = errors.select("rmse", "mae", F.lit(model.constant).alias("constant"), *weights)
    return values.select(*[F.bround(name, 6).alias(name) for name in values.columns])


@query
def run_log(spark, sf_dir):
    """The parameters and counts a category job leaves behind, and which metrics."""
    model_path, log_path = scratch_path(spark, "job-model"), scratch_path(spark, "runs")
    training.category_job(tx_orders(spark, sf_dir), model_path, log_path)
    runs = artifacts.read_runs(spark, log_path)
    value = F.col("value")
    fixed = (F.col("kind") == "param") | F.startswith("key", F.lit("n_"))
    finite = F.abs(value.try_cast("double")) < F.lit(float("inf"))
    return runs.select("kind", "key", F.when(fixed, value).when(finite, "finite").alias("value"))


# ---- synthetic data ------------------------------------------------------------------------


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"))


def _per_user(tx: DataFrame, *more: Column) -> DataFrame:
    return tx.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").cast("double").alias("total"),
        F.min("amount").cast("double").alias("smallest"),
        F.max("amount").cast("double").alias("largest"),
        F.sum(F.col("category_id") * F.dayofmonth("date")).alias("category_days"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        *more,
    )


@query
def synthetic_tiny(spark, sf_dir):
    """A9 with every customer as a user, summed per user."""
    return _per_user(synthetic.tiny_transactions(_customers(spark, sf_dir)))


@query
def synthetic_seasonal(spark, sf_dir):
    """A10 with every customer as a user, summed per user."""
    return _per_user(synthetic.seasonal_transactions(_customers(spark, sf_dir)))


@query
def synthetic_outliers(spark, sf_dir):
    """A11 with every customer as a user, summed per user."""
    tx = synthetic.outlier_transactions(_customers(spark, sf_dir))
    return _per_user(tx, F.count_if("is_injected").alias("n_injected"))
