"""Mixing sources to target weights by entropy balancing.

Every source gets a target of tokens. Among all document rates between 0 and 2 whose token totals meet the targets, the
one closest to "each document once" in relative entropy tilts documents exponentially: a document of ``size`` tokens in
source ``s`` is wanted ``min(2, exp(theta_s * size / mean_s))`` times. The multipliers ``theta`` solve the convex dual,
one equation for each source, by Newton steps. A step is one grouped sum over a histogram of (source, size), which is
what the equations depend on; sums are exact decimals, so reruns and other partitionings agree to the last bit.

Rates become whole copies by a hash of the doc_id. For each source and octave of sizes, from the largest documents to
the smallest, a cut on the hash is chosen that comes nearest to the tokens wanted there, and what is missing or too
much is carried to the next octave, so a source ends within about one small document of its target.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, free_names, text_or_empty, written

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
BINS = 4096
TOLERANCE, MOST_STEPS = 1e-9, 200
UNIT = 65536.0


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``sid``, the 0-based place of each source by code point, null last.

    A distributed sort, then each partition's offset; the offsets are as many as the sort's partitions.
    """
    ordered = sources.orderBy(F.col("source").asc_nulls_last()).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    ordered, _ = written(ordered, "sources")
    first = ordered.groupBy("part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = first.select("part", F.col("first"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return ordered.join(offsets, "part").select(*sources.columns, (F.col("row") - F.col("first") + F.col("offset")).alias("sid"))


def fill_level(sources: DataFrame) -> float:
    """The level L for which targets of ``min(2 * size, L * weight)`` add up to the share of all sizes."""
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = SHARE * (total or 0) / (weights or 1)
    while True:
        over = F.col("source_size") * MOST < F.col("weight") * F.lit(level)
        full, left = sources.agg(F.sum(F.when(over, F.col("source_size") * MOST).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        following = (SHARE * (total or 0) - (full or 0)) / left if left else level
        if following <= level:
            return level
        level = following


def rate(size: Column, theta: Column, mean: Column, full: Column) -> Column:
    """How often a document is wanted."""
    return F.when(size == 0, 1.0).when(full, float(MOST)).otherwise(F.least(F.lit(float(MOST)), F.exp(theta * size / mean)))


def exact_sum(x: Column) -> Column:
    """A sum that does not depend on the order of rows, to 1/65536."""
    return F.sum(F.round(x * UNIT).cast("decimal(38,0)")).cast("double") / UNIT


def solve(histogram: DataFrame, sources: DataFrame) -> tuple[DataFrame, str]:
    """``sources`` with ``theta``: Newton steps, halving the bracket where a step would leave it."""
    spark = sources.sparkSession
    stats = histogram.where("size > 0").groupBy("sid").agg(F.min("size").alias("least"), F.sum("n").alias("docs"))
    up = F.col("target") > F.col("source_size")
    mean = F.col("source_size") / F.col("docs")
    start = sources.join(stats, "sid", "left").select(
        "source", "sid", "source_size", "target", (F.col("target") >= MOST * F.col("source_size")).alias("full"), F.coalesce(mean, F.lit(1.0)).alias("mean"),
        F.lit(0.0).alias("theta"), F.when(up, 0.0).otherwise(float("-inf")).alias("low"),
        F.when(up, F.coalesce(math.log(MOST) * mean / F.col("least"), F.lit(0.0))).otherwise(0.0).alias("high"), F.lit(1.0).alias("error"),
    )
    state, path = written(start, "dual")
    for _ in range(MOST_STEPS):
        wanted = rate(F.col("size"), F.col("theta"), F.col("mean"), F.col("full"))
        tilt = F.col("theta") * F.col("size") / F.col("mean")
        slope = F.when(tilt < math.log(MOST), F.exp(tilt) * F.col("size") * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = histogram.where("size > 0").join(state.select("sid", "theta", "mean", "full"), "sid").groupBy("sid").agg(
            exact_sum(F.col("n") * F.col("size") * wanted).alias("got"), exact_sum(F.col("n") * slope).alias("slope")
        )
        gap = F.coalesce(F.col("got"), F.lit(0.0)) - F.col("target")
        low, high = F.when(gap < 0, F.col("theta")).otherwise(F.col("low")), F.when(gap > 0, F.col("theta")).otherwise(F.col("high"))
        newton = F.col("theta") - F.when(F.col("slope") > 0, gap / F.col("slope")).otherwise(float("inf"))
        inside = (newton >= low) & (newton <= high)
        following = F.when(inside, newton).when(low == float("-inf"), 2 * F.col("theta") - 1.0).otherwise((low + high) / 2)
        done = F.col("full") | (F.abs(gap) <= TOLERANCE * F.col("target") + 1.0 / 64)
        later = state.join(sums, "sid", "left").select(
            "source", "sid", "source_size", "target", "full", "mean", F.when(done, F.col("theta")).otherwise(following).alias("theta"),
            low.alias("low"), high.alias("high"), F.when(done, 0.0).otherwise(F.abs(gap) / F.col("target")).alias("error"),
        )
        earlier = path
        state, path = written(later, "dual")
        discard(spark, earlier)
        if (state.agg(F.max("error")).first()[0] or 0.0) == 0.0:
            break
    return state, path


class Mix(NamedTuple):
    """What is decided about each source, and the sizes of all rows."""

    sources: DataFrame
    rows: DataFrame


def octave(size: Column) -> Column:
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("int")


def draw() -> Column:
    """A number from 0 to 1 that depends on the doc_id alone."""
    return F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(1 << 40)) / float(1 << 40)


def flip_bin(wanted: Column) -> Column:
    """Documents take one copy more than the whole part of their rate from low bins to high ones."""
    return F.floor((draw() - (wanted - F.floor(wanted)) + 1) * (BINS // 2)).cast("int")


def choose_cuts(pdf: pd.DataFrame) -> pd.DataFrame:
    """The cut of each octave of one source; at most 64 octaves of ``BINS`` bins come in."""
    carry, cuts = 0.0, [0] * 64
    for o in sorted(pdf["octave"].unique(), reverse=True):
        own = pdf[pdf["octave"] == o].sort_values("bin")
        want = own["wanted"].sum() + carry
        below = np.append(0, own["mass"].cumsum().to_numpy())
        at = int(np.abs(below - want).argmin())
        carry = want - below[at]
        bins = own["bin"].to_numpy()
        cuts[o] = int(bins[at]) if at < len(bins) else BINS
    return pd.DataFrame({"sid": [pdf["sid"].iloc[0]], "cuts": [cuts]})


def plan_mix(docs: DataFrame) -> Mix:
    """Targets, multipliers and rounding cuts for all sources. Reads the texts once."""
    rows, _ = written(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    sizes = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(F.col("sid"), F.lit(len(WEIGHTS))) + 1).cast("int")).cast("long")
    sources, _ = written(numbered(totals).select("source", "sid", "source_size", weight.alias("weight")), "weights")
    target = F.least(F.col("source_size") * float(MOST), F.col("weight") * F.lit(fill_level(sources)))
    sources = sources.select("source", "sid", "source_size", target.alias("target"))
    histogram, histogram_path = written(
        sizes.withColumnRenamed("source", "of").join(sources, F.col("of").eqNullSafe(F.col("source"))).select("sid", "size", "n"), "histogram"
    )
    solved, _ = solve(histogram, sources)
    discard(docs.sparkSession, histogram_path)
    keyed = rows.where("size > 0").join(solved, rows["source"].eqNullSafe(solved["source"])).select("doc_id", "size", "sid", "theta", "mean", "full")
    wanted = rate(F.col("size"), F.col("theta"), F.col("mean"), F.col("full"))
    bins = keyed.where(wanted < MOST).groupBy("sid", octave(F.col("size")).alias("octave"), flip_bin(wanted).alias("bin")).agg(
        F.sum("size").cast("double").alias("mass"), exact_sum(F.col("size") * (wanted - F.floor(wanted))).alias("wanted")
    )
    cuts = bins.groupBy("sid").applyInPandas(choose_cuts, "sid long, cuts array<int>")
    decided, _ = written(solved.join(cuts, "sid", "left").drop("low", "high", "error"), "mix")
    return Mix(decided, rows)


def copies(size: Column, wanted: Column, cuts: Column) -> Column:
    more = F.when(flip_bin(wanted) < F.coalesce(F.get(cuts, octave(size)), F.lit(0)), 1).otherwise(0)
    return F.when(wanted >= MOST, MOST).otherwise(F.floor(wanted) + more).cast("int")


def decide(rows: DataFrame, mix: Mix, source: str, size: str, out: tuple[str, str, str, str]) -> DataFrame:
    """``rows`` with source_size, target, rate and copies under the names ``out``.

    Rows meet their source's one row: broadcast when it is known to be small, else a join whose hot sources AQE splits.
    """
    names = ["source", "sid", "source_size", "target", "full", "mean", "theta", "cuts"]
    own = dict(zip(names, free_names(rows, *[f"mix_{n}" for n in names])))
    sources = mix.sources.select(*[F.col(n).alias(own[n]) for n in names])
    wanted = rate(F.col(size), F.col(own["theta"]), F.col(own["mean"]), F.col(own["full"]))
    joined = rows.join(sources, F.col(source).eqNullSafe(F.col(own["source"])))
    return joined.select(
        *[F.col(f"`{c}`") for c in rows.columns], F.col(own["source_size"]).alias(out[0]), F.col(own["target"]).alias(out[1]),
        wanted.alias(out[2]), copies(F.col(size), wanted, F.col(own["cuts"])).alias(out[3]),
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, source_size, target, rate, copies, taken)``, a row for each row of ``docs``.

    Sizes count words; null and empty texts have size 0 and one copy. A null source is a source of its own, the last.
    Rows that share a doc_id share their draw. No table: no rows. Other columns are not read.
    """
    mix = plan_mix(docs.select("doc_id", "source", "text"))
    decided = decide(mix.rows, mix, "source", "size", ("source_size", "target", "rate", "copies"))
    return decided.withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it, with the columns it came with."""
    mix = plan_mix(docs.select("doc_id", "source", "text"))
    size, *out = free_names(docs, "mix_size", "mix_source_size", "mix_target", "mix_rate", "mix_copies")
    decided = decide(docs.select("*", word_count().alias(size)), mix, "source", size, tuple(out))
    times = F.explode(F.array_repeat(F.lit(0), F.col(out[3])))
    return decided.select(*[F.col(f"`{c}`") for c in docs.columns], times.alias(size)).drop(size)
