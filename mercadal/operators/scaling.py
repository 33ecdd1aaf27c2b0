"""Speed-up reports over a run log (job, p, seconds) and serial-fraction fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercadal.operators.ranking import exact_quantiles

FIT_STEPS = 24


def scaling_report(run_log: DataFrame) -> DataFrame:
    """Median seconds, speed-up against p = 1 and efficiency per job and p.

    Jobs without a p = 1 measurement have no speed-up. After the medians there
    is one row per job and worker count.
    """
    medians = exact_quantiles(run_log, "seconds", {"median_seconds": 0.5}, by=["job", "p"])
    base = medians.where("p = 1").select("job", F.col("median_seconds").alias("_t1"))
    speedup = F.col("_t1") / F.nullif(F.col("median_seconds"), F.lit(0.0))
    return (
        medians.join(base, "job", "left")
        .withColumn("speedup", speedup)
        .withColumn("efficiency", F.col("speedup") / F.col("p"))
        .select("job", "p", "median_seconds", "speedup", "efficiency")
    )


def predicted_speedup(p: Column, f: Column) -> Column:
    """Speed-up on ``p`` workers when the share ``f`` of the work is serial."""
    return F.lit(1.0) / (f + (F.lit(1.0) - f) / p)


def _sum_over(points: Column, term) -> Column:
    return F.aggregate(points, F.lit(0.0), lambda acc, pt: acc + term(pt["p"], pt["s"]))


def _clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def amdahl_fit(run_log: DataFrame, exclude_p1: bool = True) -> DataFrame:
    """Least-squares serial fraction, fit quality and verdict per job.

    Starts from the closed-form fit on 1/S and takes a fixed number of clamped
    Gauss-Newton steps on S. The points of a job are one per worker count.
    """
    return fit_serial_fraction(scaling_report(run_log), exclude_p1)


def fit_serial_fraction(report: DataFrame, exclude_p1: bool = True) -> DataFrame:
    points = report.where(F.col("speedup").isNotNull())
    if exclude_p1:
        points = points.where("p <> 1")
    point = F.struct(F.col("p").cast("double").alias("p"), F.col("speedup").alias("s"))
    jobs = points.groupBy("job").agg(F.sort_array(F.collect_list(point)).alias("pts"))

    one = F.lit(1.0)
    upper = _sum_over(F.col("pts"), lambda p, s: (one / s - one / p) * (one - one / p))
    lower = _sum_over(F.col("pts"), lambda p, s: (one - one / p) * (one - one / p))
    jobs = jobs.withColumn("start_fraction", _clamp(upper / F.nullif(lower, F.lit(0.0))))

    def step(f: Column, _i: Column) -> Column:
        def slope(p: Column) -> Column:
            model = predicted_speedup(p, f)
            return -model * model * (one - one / p)

        top = _sum_over(F.col("pts"), lambda p, s: slope(p) * (s - predicted_speedup(p, f)))
        bottom = _sum_over(F.col("pts"), lambda p, s: slope(p) * slope(p))
        move = F.coalesce(top / F.nullif(bottom, F.lit(0.0)), F.lit(0.0))
        return _clamp(f + move)

    fitted = jobs.withColumn(
        "serial_fraction",
        F.aggregate(F.sequence(F.lit(1), F.lit(FIT_STEPS)), F.col("start_fraction"), step),
    )
    f = F.col("serial_fraction")
    mean = _sum_over(F.col("pts"), lambda p, s: s) / F.size("pts")
    fitted = fitted.withColumn("_mean", mean)
    around = _sum_over(F.col("pts"), lambda p, s: (s - F.col("_mean")) * (s - F.col("_mean")))
    left = _sum_over(
        F.col("pts"), lambda p, s: (s - predicted_speedup(p, f)) * (s - predicted_speedup(p, f))
    )
    fitted = fitted.withColumn("_total", around).withColumn("_rest", left)
    quality = F.when(F.col("_total") > 0, one - F.col("_rest") / F.col("_total")).otherwise(one)
    return fitted.withColumn("r2", quality).select(
        "job", F.size("pts").alias("points"), "start_fraction", "serial_fraction", "r2"
    )


def scaling_verdict(fit: DataFrame, cpus: int) -> DataFrame:
    """Bands of the serial fraction, speed-up limit and prediction at ``cpus``."""
    f = F.col("serial_fraction")
    band = (
        F.when(f < 0.05, "highly parallel")
        .when(f < 0.20, "moderate serial share")
        .when(f.isNotNull(), "serial share dominates")
    )
    limit = F.when(f > 0, F.lit(1.0) / f).otherwise(F.when(f == 0, F.lit(float("inf"))))
    return (
        fit.withColumn("verdict", band)
        .withColumn("max_speedup", limit)
        .withColumn("predicted_speedup", predicted_speedup(F.lit(float(cpus)), f))
    )
