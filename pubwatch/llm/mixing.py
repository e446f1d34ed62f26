"""Mixing sources to target weights by Pareto order sampling.

Only DataFrame functions. Each source gets a target in words. A document's expected copies are
its source's target over its size, tilted by an optional weight; whole copies are certain, and the
fraction is an inclusion probability. Documents are ranked by random odds over inclusion odds, and
the sample takes them in that order up to the words that are left.

The order is never laid out in one task: ranks fall into fixed buckets, sums per bucket give each
source the one bucket where its sample ends, and only the documents of that bucket are ranked. Equal
rows share a rank; they are counted first, so a bucket that holds very many of them is short.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubwatch.llm.common import materialise
from pubwatch.operators.ranking import number_rows

BUCKETS = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixParams:
    """``share`` of all sizes is dealt out; no target is above ``cap`` times its source's size."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    cap: int = 2
    seed: str = "mix-1"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, params: MixParams) -> DataFrame:
    """source, source_size, target: shares by weight, capped, the excess dealt out anew.

    Sources take the weights in code point order, NULL last. Every round is one sum over the
    table of sources; a source that is capped stays so, as the others' shares only grow.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = number_rows(sums, [F.asc_nulls_last("source")], "mix-sources")
    place = (F.col("row_no") - 1) % len(params.weights)
    weight = F.element_at(F.array(*map(F.lit, params.weights)), (place + 1).cast("int"))
    table = materialise(numbered.select("source", "source_size", weight.alias("w")), "mix-weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    rest, weights, capped_before = params.share * total, None, -1
    while True:
        if weights is None:
            capped = F.lit(False)
        elif weights == 0:
            capped = F.lit(True)
        else:
            share = F.lit(float(rest)) * F.col("w") / F.lit(float(weights))
            capped = share >= params.cap * F.col("source_size")
        # eager: one row of sums per round
        row = table.agg(
            F.coalesce(F.sum(F.when(capped, 1)), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~capped, F.col("w"))), F.lit(0)).alias("weights"),
        ).first()
        if row["n"] == capped_before:
            break
        capped_before, weights = row["n"], row["weights"]
        rest = params.share * total - params.cap * row["held"]
    full = params.cap * F.col("source_size").cast("double")
    fair = F.lit(float(rest)) * F.col("w") / F.lit(float(weights or 1))
    return table.select(
        "source", "source_size", F.when(capped, full).otherwise(fair).alias("target")
    )


def _ranked(rows: DataFrame, stats: DataFrame, params: MixParams) -> DataFrame:
    """Add whole copies, random odds over inclusion odds, and the bucket of that rank."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    tilt = F.when(F.col("weighed") > 0, F.col("w") * F.col("source_size") / F.col("weighed"))
    hexed = F.substring(F.md5(F.concat(F.col("sid"), F.lit("|" + params.seed))), 1, 13)
    uniform = (F.conv(hexed, 16, 10).cast("double") + 0.5) / float(1 << 52)
    odds = F.col("u") / (1 - F.col("u"))
    part = F.col("inclusion")
    rank = F.when(part > 0, odds / (part / (1 - part))).otherwise(float("inf"))
    bucket = F.floor(F.col("q") / (1 + F.col("q")) * BUCKETS)
    return (
        rows.join(stats, rows["source"].eqNullSafe(stats["s"]))
        .withColumn("expected", F.least(ratio * F.coalesce(tilt, F.lit(1.0)), F.lit(float(params.cap))))
        .withColumn("whole", F.floor("expected"))
        .withColumn("inclusion", F.col("expected") - F.col("whole"))
        .withColumn("u", uniform)
        .withColumn("q", rank)
        .withColumn("bucket", F.when(F.col("q") == float("inf"), BUCKETS).otherwise(bucket))
    )


def mix(
    docs: DataFrame,
    params: MixParams = MixParams(),
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    weight: Column | None = None,
    salt: Column | None = None,
) -> DataFrame:
    """row (a struct of the input row), size, source_size, target, copies.

    The random number of a row comes from its id and ``salt``, by default a digest of its text.

    ``size`` is the words of column ``text`` unless given; ``weight`` (whole numbers >= 0) makes the
    copies of a source's documents unequal. Copies are 0 to ``cap``; the words taken from a source
    miss its target by at most half a document, wherever its documents can fill it.

    * A NULL source is a source of its own, last in order; a NULL text has size 0.
    * Documents of size 0 may be taken, but add no words. A NULL id is drawn like the empty id.
    * Rows that repeat an id are drawn one by one, each by its own text; equal rows are drawn together.
    * What has no chance, as its expected copies are whole or its weight is 0, gets no further copy.
    * Texts are counted whole, however long.
    * Rows with a column ``text`` are read again for the result; others are written once, with their sizes.
    * An empty table gives an empty result; clashing column names stay inside ``row``.
    """
    size = word_count(F.col("text")) if size is None else size
    if salt is None:
        salt = F.md5(F.coalesce(F.col("text"), F.lit(""))) if "text" in docs.columns else F.lit("")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(source_col).alias("source"),
        size.alias("size"),
        F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), salt).alias("sid"),
        F.col(id_col).alias("id"),
        (F.lit(1) if weight is None else weight).cast("long").alias("w"),
    )
    if "text" in docs.columns:
        narrow = materialise(rows.drop("row"), "mix-sizes")
    else:  # rows without their texts are short, so they are kept: what they are derived from is read once
        rows = materialise(rows, "mix-sizes")
        narrow = rows.drop("row")
    targets = source_targets(narrow, params)
    weighed = narrow.groupBy(F.col("source").alias("s")).agg(
        F.sum(F.col("w") * F.col("size")).alias("weighed")
    )
    stats = weighed.join(targets, weighed["s"].eqNullSafe(targets["source"])).drop("source")
    ranked = _ranked(narrow, stats, params)
    may = (F.col("whole") < params.cap) & (F.col("bucket") < BUCKETS)
    open_size = F.when(may, F.col("size")).otherwise(0)
    sums = ranked.groupBy("s", "bucket").agg(
        F.sum(open_size).alias("words"), F.sum(F.col("whole") * F.col("size")).alias("whole_words")
    )
    upto = Window.partitionBy("s").orderBy("bucket")
    all_of = Window.partitionBy("s")
    stops = (
        sums.withColumn("upto", F.sum("words").over(upto))
        .withColumn("certain", F.sum("whole_words").over(all_of))
        .groupBy("s", "certain")
        .agg(F.collect_list(F.struct("bucket", "upto", "words")).alias("steps"))
    )
    joined = stats.join(stops.withColumnRenamed("s", "s2"), stats["s"].eqNullSafe(F.col("s2")))
    left = F.col("target") - F.col("certain")
    past = F.filter("steps", lambda x: x["upto"] > left)
    first = F.array_min(past)
    plan = materialise(
        joined.select(
            "s", "source_size", "target", "weighed", left.alias("left"),
            first["bucket"].alias("stop"), (first["upto"] - first["words"]).alias("before"),
        ),
        "mix-plan",
    )
    drawn = _ranked(rows, plan, params)
    at_stop = F.coalesce(F.col("bucket") == F.col("stop"), F.lit(False)) & may
    early = F.coalesce(F.col("bucket") < F.col("stop"), F.lit(True)) & may
    out = ["row", "size", "source_size", "target"]
    sure = drawn.where(~at_stop).select(*out, (F.col("whole") + early.cast("long")).alias("copies"))
    # equal rows count as one that stands there n times
    same = ["s", "q", "id", "size", "sid"]
    edge = drawn.where(at_stop).withColumn("content", F.sha2(F.to_json("row"), 256))
    kept = ["row", "source_size", "target", "before", "left", "whole"]
    edge = edge.groupBy(*same, "content").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in kept])
    order = Window.partitionBy("s").orderBy("q", F.asc_nulls_first("id"), "size", "sid", "content")
    words = F.sum(F.col("n") * F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    edge = edge.withColumn("earlier", F.col("before") + F.coalesce(words, F.lit(0)))
    edge = edge.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    fits = 2 * (F.col("earlier") + F.col("i") * F.col("size")) + F.col("size") <= 2 * F.col("left")
    edge = edge.select(*out, (F.col("whole") + fits.cast("long")).alias("copies"))
    return sure.unionByName(edge)


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """The input rows of a mix, each as often as it was drawn."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.select("row", copies.alias("_copy")).select("row.*")
