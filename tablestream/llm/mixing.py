"""Mixing sources to target weights by entropy balancing.

Every document gets a rate w = min(limit, exp(lambda * z)), z its size over the mean size of its
source: of all rates below the limit whose sizes add up to the source's target, those that are least
far from 1 in entropy. One lambda for each source solves the convex dual. Newton steps, kept within
a bracket, run on counts by source and size, so a step reads one row for each size that occurs;
their state is a table with one row for each source. Rates become copies by systematic rounding
along one order of all documents, with a running sum that no task holds whole.

Cases: a null source is a source of its own, ordered last; null and blank texts have size 0, rate 1
and take nothing; sources without any words have target 0; an empty table stays empty. Repeated rows
are documents of their own. Columns of the input named like new ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import numbered, plain_plans, running, stored
from tablestream.session import cut_lineage

NEW = ("size", "source_size", "target", "rate", "copies")
WEIGHTS = (5, 2, 1)
LIMIT = 3
STEPS = 40
#: Relative distance of a source's expected size from its target at which the steps end.
EXACT = 1e-7
#: Rates are rounded in whole parts of this size, so that running sums are exact.
PARTS = 1 << 24


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``source``, ``source_size``, ``target`` of each source from rows of source and size.

    Sources by code point, null last, get the weights in turn. Sharing by weight, stopping sources
    at ``limit`` times their size and sharing the excess again ends where every source gets the
    lesser of its limit and one common level times its weight; that level is found in the order of
    the ratio of limit to weight, with running sums.
    """
    by_source = cut_lineage(
        sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    )
    total = by_source.agg(F.sum("source_size")).first()[0] or 0
    ranked, _ = numbered(by_source, [F.col("source").asc_nulls_last()], "place")
    turn = F.array(*[F.lit(w).cast("long") for w in weights])
    shared = ranked.withColumn("weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")))
    shared = shared.withColumn("most", F.col("source_size") * limit)
    ratio = F.col("most") / F.col("weight")
    ordered = running(shared, [ratio, F.col("place")], "most", "most_before")
    ordered = cut_lineage(running(ordered, [ratio, F.col("place")], "weight", "weight_before"))
    all_weight = ordered.agg(F.sum("weight")).first()[0] or 1
    # With the sources before it at their limits, the level that the others could have.
    level = (F.lit(total) - F.col("most_before")) / (F.lit(all_weight) - F.col("weight_before"))
    found = ordered.filter(level <= ratio).agg(F.min(F.struct(ratio.alias("r"), F.col("place"), level.alias("level"))))
    first = found.first()[0]
    common = F.lit(first["level"] if first else 0.0)
    return ordered.select(
        "source", "source_size",
        F.least(F.col("most").cast("double"), common * F.col("weight")).alias("target"),
    )


def _rate(scale: Column, z: Column, limit: int) -> Column:
    return F.least(F.lit(float(limit)), F.exp(F.least(scale * z, F.lit(50.0))))


def tilts(counts: DataFrame, goals: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``source``, ``scale``, ``mean``: what makes the rates of each source meet its target.

    ``counts``: source, size, n. Sources at their limit get rate ``limit`` for every document.
    """
    mean = F.col("source_size") / F.col("documents")
    filled = counts.filter("size > 0")
    documents = filled.groupBy("source").agg(F.sum("n").alias("documents"))
    joined = goals.join(documents, goals["source"].eqNullSafe(documents["source"])).drop(documents["source"])
    # Targets in mean sizes; the rates at 0 add up to the number of documents.
    state = stored(
        joined.select(
            "source", mean.alias("mean"), (F.col("target") / mean).alias("goal"),
            (F.col("target") >= F.col("source_size") * limit).alias("full"),
            F.lit(0.0).alias("scale"), F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"), F.lit(False).alias("done"),
        )
    )
    filled = stored(filled.select(F.col("source").alias("of"), "size", "n"))
    for _ in range(STEPS):
        z, scale = F.col("size") / F.col("mean"), F.col("scale")
        rate = _rate(scale, z, limit)
        sums = (
            filled.join(state.filter("NOT full AND NOT done"), F.col("of").eqNullSafe(F.col("source")))
            .groupBy("of")
            .agg(
                F.sum(F.col("n") * z * rate).alias("value"),
                F.sum(F.when(rate < limit, F.col("n") * z * z * rate).otherwise(0.0)).alias("slope"),
            )
        )
        now = state.join(sums, F.col("of").eqNullSafe(F.col("source")), "left")
        over = F.col("value") > F.col("goal")
        low = F.when(~over, scale).otherwise(F.col("low"))
        high = F.when(over, scale).otherwise(F.col("high"))
        # Newton, or half of the bracket, or twice as far where there is no bracket yet.
        newton = scale + (F.col("goal") - F.col("value")) / F.col("slope")
        inside = (newton > F.coalesce(low, F.lit(-1e300))) & (newton < F.coalesce(high, F.lit(1e300)))
        wide = F.when(high.isNull(), F.abs(low) * 2 + 1).when(low.isNull(), -F.abs(high) * 2 - 1).otherwise(
            (low + high) / 2
        )
        step = F.when((F.col("slope") > 0) & inside & (F.abs(newton - scale) < 4), newton).otherwise(wide)
        met = F.abs(F.col("value") - F.col("goal")) <= EXACT * F.col("goal")
        open_ = F.col("value").isNotNull()
        state = stored(
            now.select(
                "source", "mean", "goal", "full",
                F.when(open_ & ~met, step).otherwise(scale).alias("scale"),
                F.when(open_, low).otherwise(F.col("low")).alias("low"),
                F.when(open_, high).otherwise(F.col("high")).alias("high"),
                (F.col("done") | (open_ & met)).alias("done"),
            )
        )
        if state.filter("NOT full AND NOT done").isEmpty():
            break
    else:
        raise RuntimeError(f"targets were not met in {STEPS} steps")
    # Twelve digits: the sums above may differ in their last ones from run to run.
    digits = F.floor(F.log10(F.greatest(F.abs("scale"), F.lit(1e-12))))
    unit = F.pow(F.lit(10.0), 11 - digits)
    return state.select("source", "mean", (F.round(F.col("scale") * unit) / unit).alias("scale"), "full")


def mix(
    docs: DataFrame, size: Column, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` to rows of doc_id and
    source. The number of sources is that of a dimension; their tables are joined, never gathered."""
    with plain_plans(docs.sparkSession):
        return _mix(docs, size, weights, limit)


def _mix(docs: DataFrame, size: Column, weights: tuple[int, ...], limit: int) -> DataFrame:
    kept = [c for c in docs.columns if c not in NEW]
    whole = F.struct(*kept).alias("__row")
    narrow = cut_lineage(docs.select(whole, "doc_id", "source", size.cast("long").alias("size")))
    goals = targets(narrow, weights, limit)
    counts = narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    found = tilts(counts, goals, limit)
    plan = goals.join(found, goals["source"].eqNullSafe(found["source"]), "left").drop(found["source"])
    plan = cut_lineage(plan.withColumnRenamed("source", "of"))
    rated = narrow.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("full"), float(limit)).otherwise(
        _rate(F.col("scale"), F.col("size") / F.col("mean"), limit)
    )
    rated = rated.withColumn("rate", rate).withColumn("_parts", F.round(F.col("rate") * PARTS).cast("long"))
    # Large documents first: what rounding one adds or takes the smaller ones after it make good.
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id")]
    placed = running(rated, order, "_parts", "_parts_before")
    copies = F.expr(f"(_parts_before + _parts) div {PARTS} - _parts_before div {PARTS}")
    rounded = placed.withColumn("copies", F.least(copies, F.lit(limit)).cast("int"))
    return _settled(rounded, limit).select(*[F.col("__row")[c].alias(c) for c in kept], *NEW)


def _settled(rounded: DataFrame, limit: int) -> DataFrame:
    """What rounding leaves of a source's target, at most about its largest document, goes to its
    smallest documents: one copy more or less of each until the next would overshoot."""
    rounded = cut_lineage(rounded)
    left = rounded.groupBy(F.col("source").alias("of")).agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("_left")
    )
    same = F.col("source").eqNullSafe(F.col("of"))
    given = rounded.join(cut_lineage(left), same).drop("of")
    more, less = F.col("_left") > 0, F.col("_left") < 0
    able = (F.col("size") > 0) & ((more & (F.col("copies") < limit)) | (less & (F.col("copies") > 0)))
    given = given.withColumn("_unit", F.when(able, F.col("size")).otherwise(0))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")]
    placed = cut_lineage(running(given, order, "_unit", "_earlier"))
    starts = cut_lineage(placed.groupBy(F.col("source").alias("of")).agg(F.min("_earlier").alias("_start")))
    through = F.col("_earlier") - F.col("_start") + F.col("_unit")
    moved = (F.col("_unit") > 0) & (through <= F.abs("_left"))
    change = F.when(moved & more, 1).when(moved & less, -1).otherwise(0)
    settled = placed.join(starts, same).withColumn("copies", (F.col("copies") + change).cast("int"))
    return settled.drop("of", "_left", "_unit", "_earlier", "_start")
