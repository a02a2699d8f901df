"""Reports over the wide table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def _saves() -> Column:
    return F.sum(F.when(F.col("cancel_confirmed") == "N", 1).otherwise(0))


def _rate_of_baked(days: int, churn: bool = False) -> Column:
    kept = F.col(f"retained_{days}d")
    value = (1 - kept) if churn else kept
    return F.round(F.avg(F.when(F.col(f"baked_{days}d") == 1, value)) * 100, 2)


def retention_metrics(
    gold: DataFrame, product: str | None = None, year: str | None = None, month: str | None = None
) -> DataFrame:
    """Save and retention rates by product and month; the filters prune partitions."""
    for name, value in (("product", product), ("initiation_year", year), ("initiation_month", month)):
        if value is not None:
            gold = gold.filter(F.col(name) == value)
    return (
        gold.groupBy("product", "initiation_year", "initiation_month")
        .agg(
            F.count(F.lit(1)).alias("total_initiations"),
            _saves().alias("saves"),
            C.percent(_saves(), F.count(F.lit(1))).alias("save_rate_pct"),
            _rate_of_baked(31).alias("retention_31d_pct"),
            _rate_of_baked(92).alias("retention_92d_pct"),
        )
        .orderBy("product", "initiation_year", "initiation_month")
    )


def ipd_effectiveness(engagement: DataFrame, gold: DataFrame) -> DataFrame:
    """View, click and save funnel per offer class."""
    outcome = gold.select(
        "company_id",
        "initiation_rank",
        F.col("cancel_flow_start_timestamp").alias("initiation_timestamp"),
        "cancel_confirmed",
    )
    joined = engagement.select(
        "company_id", "initiation_rank", "initiation_timestamp", "ipd_type", "viewed_ipd", "clicked_ipd"
    ).join(outcome, ["company_id", "initiation_rank", "initiation_timestamp"])
    return (
        joined.groupBy("ipd_type")
        .agg(
            F.count_distinct("company_id").alias("companies_shown"),
            F.sum("viewed_ipd").alias("views"),
            F.sum("clicked_ipd").alias("clicks"),
            C.percent(F.sum("clicked_ipd"), F.sum("viewed_ipd")).alias("ctr_pct"),
            _saves().alias("saves"),
            C.percent(_saves(), F.count(F.lit(1))).alias("save_rate_pct"),
        )
        .orderBy(F.col("saves").desc(), "ipd_type")
    )


def tenure_churn(gold: DataFrame) -> DataFrame:
    """Churn by tenure cohort, product and billing frequency, among baked episodes."""
    cohort = C.tenure_bucket("tenure_at_cancel_initiation", C.TENURE_LABELS)
    return (
        gold.filter(F.col("baked_31d") == 1)
        .groupBy(cohort.alias("tenure_cohort"), "product", "billing_frequency")
        .agg(
            F.count(F.lit(1)).alias("initiations"),
            _rate_of_baked(31, churn=True).alias("churn_rate_31d_pct"),
            _rate_of_baked(92, churn=True).alias("churn_rate_92d_pct"),
        )
        .orderBy(F.col("churn_rate_31d_pct").desc(), "tenure_cohort", "product", "billing_frequency")
    )


def company_history(gold: DataFrame) -> DataFrame:
    """Per company: attempts, last outcome, saves, retention and a tier from the churned share."""
    latest = F.struct("cancel_flow_start_timestamp", "initiation_rank")
    kept = F.avg(F.when(F.col("baked_31d") == 1, F.col("retained_31d")))
    return (
        gold.groupBy("company_id")
        .agg(
            F.count(F.lit(1)).alias("n_initiations"),
            F.max("initiation_date").alias("last_initiation_date"),
            F.max_by("save_attribution", latest).alias("last_save_attribution"),
            _saves().alias("total_saves"),
            F.round(kept, 4).alias("retention_rate_31d"),
        )
        .withColumn("risk_tier", C.risk_tier(F.lit(1.0) - F.col("retention_rate_31d")))
    )


def table_health(
    tables: dict[str, tuple[DataFrame, str]], as_of: Column, limit_hours: float = 8.0
) -> DataFrame:
    """Rows, latest time and lag per table; ``tables`` maps a name to a frame and its time column."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.max(F.col(ts).cast("timestamp")).alias("max_time"),
        )
        for name, (df, ts) in tables.items()
    ]
    health = parts[0]
    for part in parts[1:]:
        health = health.unionByName(part)
    lag = (F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds("max_time")) / 3600.0
    return health.withColumn("lag_hours", F.round(lag, 4)).withColumn(
        "status", F.when(F.col("lag_hours") <= limit_hours, "HEALTHY").otherwise("STALE")
    )


def experiment_outcomes(gold: DataFrame, assignments: DataFrame) -> DataFrame:
    """Episodes on or after a company's first assignment, by experiment, treatment and outcome.

    Episodes are counted per company, day and outcome before they meet the assignments, of which
    a company has one per experiment.
    """
    first = assignments.groupBy("company_id", "experiment_id").agg(
        F.min("treatment_name").alias("treatment_name"),
        F.min("first_assignment_date").alias("assigned"),
    )
    daily = gold.groupBy("company_id", "initiation_date", "save_attribution").agg(
        F.count(F.lit(1)).alias("n"), _saves().alias("saved")
    )
    return (
        daily.join(first, "company_id")
        .filter(F.col("initiation_date") >= F.col("assigned"))
        .groupBy("experiment_id", "treatment_name", "save_attribution")
        .agg(F.sum("n").alias("initiations"), F.sum("saved").alias("saves"))
    )


# What a chi-square of so many degrees of freedom exceeds by chance in one of 1000 cases.
CHI_SQUARE_1_IN_1000 = (10.828, 13.816, 16.266, 18.467, 20.515, 22.458, 24.322, 26.124, 27.877, 29.588)
Z_95 = 1.959964
# How likely a Poisson number of mean 1 is at most 0, 1, 2, ...
POISSON_1 = (0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406, 0.999917)


def _exposed(gold: DataFrame, assignments: DataFrame) -> DataFrame:
    """Per experiment, treatment and company: episodes since the first assignment, and how many were saved."""
    first = assignments.groupBy("company_id", "experiment_id").agg(
        F.min("treatment_name").alias("treatment_name"), F.min("first_assignment_date").alias("assigned")
    )
    daily = gold.groupBy("company_id", "initiation_date").agg(F.count(F.lit(1)).alias("n"), _saves().alias("saved"))
    return (
        daily.join(first, "company_id")
        .filter(F.col("initiation_date") >= F.col("assigned"))
        .groupBy("experiment_id", "treatment_name", "company_id")
        .agg(F.sum("n").alias("n"), F.sum("saved").alias("saved"))
    )


def sample_ratio(assignments: DataFrame) -> DataFrame:
    """Companies per treatment against equal shares: chi-square by experiment, and whether it tells of a fault.

    The split is suspect if chance alone gives such a chi-square in less than one of 1000 cases.
    """
    arms = assignments.groupBy("experiment_id", "treatment_name").agg(F.countDistinct("company_id").alias("companies"))
    sums = arms.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("arms"),
        F.sum("companies").alias("companies"),
        F.sum(F.col("companies") * F.col("companies")).alias("squares"),
    )
    chi = F.col("arms") * F.col("squares") / F.col("companies") - F.col("companies")
    critical = F.get(F.array(*map(F.lit, CHI_SQUARE_1_IN_1000)), (F.col("arms") - 2).cast("int"))
    return sums.select(
        "experiment_id", "arms", "companies", F.round(chi, 6).alias("chi_square"),
        F.coalesce(chi > critical, F.lit(False)).alias("suspect"),
    )


def experiment_effects(gold: DataFrame, assignments: DataFrame, control: str = "control") -> DataFrame:
    """Save rate of every treatment against its experiment's ``control``: difference, 95 % interval, z.

    Two-proportion statistics over episodes, the interval without and z with a common rate. Episodes of one company are not
    independent: ``bootstrap_effects`` allows for that.
    """
    arms = _exposed(gold, assignments).groupBy("experiment_id", "treatment_name").agg(
        F.sum("n").alias("n"), F.sum("saved").alias("saved")
    )
    base = arms.filter(F.col("treatment_name") == control).select(
        "experiment_id", F.col("n").alias("n0"), F.col("saved").alias("saved0")
    )
    rate, rate0 = F.col("saved") / F.col("n"), F.col("saved0") / F.col("n0")
    both = (F.col("saved") + F.col("saved0")) / (F.col("n") + F.col("n0"))
    error = F.sqrt(rate * (1 - rate) / F.col("n") + rate0 * (1 - rate0) / F.col("n0"))
    pooled = F.sqrt(both * (1 - both) * (1 / F.col("n") + 1 / F.col("n0")))
    return arms.filter(F.col("treatment_name") != control).join(base, "experiment_id").select(
        "experiment_id",
        "treatment_name",
        "n",
        "saved",
        F.round(rate, 6).alias("save_rate"),
        F.round(rate - rate0, 6).alias("difference"),
        F.round(rate - rate0 - Z_95 * error, 6).alias("low"),
        F.round(rate - rate0 + Z_95 * error, 6).alias("high"),
        F.round(F.try_divide(rate - rate0, pooled), 6).alias("z"),
    )


def bootstrap_effects(
    gold: DataFrame, assignments: DataFrame, control: str = "control", replicates: int = 100
) -> DataFrame:
    """The difference in save rate in Poisson bootstrap samples of companies: mean and 95 % interval.

    A company counts in replicate b as often as a hash of its id and b says, by the Poisson law of mean 1: no second pass,
    no state, and equal results wherever its rows lie. Rows are reduced to companies first, and replicates are summed
    before anything is shuffled.
    """
    drawn = F.md5(F.concat_ws(":", F.col("company_id").cast("string"), F.col("b").cast("string")))
    u = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") / float(1 << 32)
    times = sum(F.when(u >= p, 1).otherwise(0) for p in POISSON_1)
    weighted = _exposed(gold, assignments).withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    sums = weighted.withColumn("w", times).groupBy("experiment_id", "treatment_name", "b").agg(
        F.sum(F.col("w") * F.col("n")).alias("n"), F.sum(F.col("w") * F.col("saved")).alias("saved")
    )
    rated = sums.withColumn("rate", F.try_divide("saved", "n"))
    base = rated.filter(F.col("treatment_name") == control).select("experiment_id", "b", F.col("rate").alias("rate0"))
    pairs = rated.filter(F.col("treatment_name") != control).join(base, ["experiment_id", "b"])
    difference = F.col("rate") - F.col("rate0")
    return pairs.groupBy("experiment_id", "treatment_name").agg(
        F.count(difference).alias("replicates"),
        F.round(F.avg(difference), 6).alias("mean_difference"),
        F.round(F.percentile(difference, F.lit(0.025)), 6).alias("low"),
        F.round(F.percentile(difference, F.lit(0.975)), 6).alias("high"),
    )
