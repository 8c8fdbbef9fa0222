"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.workspace import stored

#: Rates are summed as whole multiples of 2^-30, so that sums do not depend on their order.
ONE = 1 << 30
#: A source is solved when its words differ from the target by this share at most.
TOLERANCE = 1e-9
#: Newton steps at most; bisection alone halves the interval at each.
STEPS = 80

WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size: the number of words of every text (NULL: 0), and a hash of the row."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        docs[source_col].cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(docs[id_col].cast("long"), text).alias("row_hash"),
    )


def source_targets(cells: DataFrame, pattern: list[float], limit: float) -> DataFrame:
    """source, source_size, target: all words shared by weight, no source above ``limit`` times its size.

    Sources in the order of their code points, NULL last, take the weights of ``pattern`` in
    turn. What a target would have above its limit is shared among the others by weight,
    until none is above. ``cells`` has one row or more for each source: source, size, n.
    """
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1  # one row for each source
    weight = F.element_at(F.array(*map(F.lit, map(float, pattern))), (turn % len(pattern) + 1).cast("int"))
    sources = stored(sizes.withColumn("weight", weight), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    # the level: words for each unit of weight. It only rises, and sources above their limit stay so.
    level = 0.0
    full = F.col("weight") * F.lit(level) > limit * F.col("source_size")
    while True:
        ends = sources.agg(
            F.sum(F.when(full, F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not ends[1]:
            break
        new = (total - limit * ends[0]) / ends[1]
        if new <= level:
            break
        level = new
        full = F.col("weight") * F.lit(level) > limit * F.col("source_size")
    target = F.least(F.col("weight") * F.lit(level), limit * F.col("source_size"))
    return sources.select("source", "source_size", target.alias("target"))


def rate(tilt: Column, x: Column, limit: float) -> Column:
    """exp(tilt x), at most ``limit``: the solution's rate of a document of relative size x."""
    return F.exp(F.least(tilt * x, F.lit(math.log(limit))))


def _units(value: Column) -> Column:
    return F.round(value * ONE).cast("long").cast("decimal(19,0)")


def tilts(cells: DataFrame, targets: DataFrame, limit: float) -> DataFrame:
    """source, scale, tilt: the dual solution of entropy balancing, one multiplier a source.

    The rates nearest to 1 in relative entropy that give each source its target words, with no
    rate above ``limit``, are ``exp(tilt * size / scale)``, cut at the limit. The multipliers
    solve a convex dual by Newton steps; each step is one aggregation over ``cells`` for its
    gradient and curvature. A step that leaves the interval known to hold the solution is
    replaced by its middle. Sources with nothing to take have tilt -infinity; those at their limit +infinity.
    """
    inf = float("inf")
    words = cells.filter("size > 0").groupBy("source").agg(F.sum("n").alias("docs"))
    start = targets.join(words, targets.source.eqNullSafe(words.source), "left").select(
        targets.source,
        "target",
        (F.col("source_size") / F.col("docs")).alias("scale"),
        F.when((F.col("target") <= 0) | F.col("docs").isNull(), -inf)
        .when(F.col("target") >= limit * F.col("source_size") * (1 - 1e-12), inf)
        .otherwise(F.log(F.col("target") / F.col("source_size")))
        .alias("tilt"),
        F.lit(-inf).alias("low"),
        F.lit(inf).alias("high"),
        F.lit(False).alias("done"),
    )
    start = start.withColumn("done", F.abs("tilt") == inf)
    state = stored(start, "tilts")
    for _ in range(STEPS):
        if state.filter("not done").isEmpty():
            break
        c, s = cells.alias("c"), state.filter("not done").alias("s")
        x = F.col("c.size") / F.col("s.scale")
        r = rate(F.col("s.tilt"), x, limit)
        tokens = (F.col("c.size") * F.col("c.n")).cast("decimal(18,0)")
        free = F.when(F.col("s.tilt") * x < math.log(limit), x * r).otherwise(0.0)
        sums = (
            c.join(s, F.col("c.source").eqNullSafe(F.col("s.source")))
            .groupBy(F.col("s.source").alias("of"))
            .agg(F.sum(_units(r) * tokens).alias("words"), F.sum(_units(free) * tokens).alias("slope"))
        )
        now = state.join(sums, state.source.eqNullSafe(sums.of), "left")
        gap = F.col("words").cast("double") / ONE - F.col("target")
        low = F.when(gap < 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.least("high", "tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - gap / (F.col("slope").cast("double") / ONE)
        middle = (
            F.when(low == -inf, high - F.abs(high) - 1).when(high == inf, low + F.abs(low) + 1).otherwise((low + high) / 2)
        )
        good = (F.col("slope") > 0) & (step > low) & (step < high)
        near = F.abs(gap) <= TOLERANCE * F.col("target")
        ended = F.coalesce(near | (high - low <= 1e-15 * F.abs("tilt")), F.col("done"))
        state = stored(
            now.select(
                state.source, "target", "scale",
                F.when(ended, F.col("tilt")).when(good, step).otherwise(middle).alias("tilt"),
                low.alias("low"), high.alias("high"), ended.alias("done"),
            ),
            "tilts",
        )
    return state.select("source", "scale", "tilt")


def _rounded(cells: DataFrame, solved: DataFrame, targets: DataFrame, limit: float) -> DataFrame:
    """source, size, n, rate, copies: whole copies of the documents of each size of a source.

    Expected copies are added up from the longest documents to the shortest, and the sum is
    rounded at each size; so no size is off by a whole copy, and short documents make up for
    long ones. Then single sizes are changed, the best one of each source at a time, as long
    as the source's words come nearer to its target.
    """
    at = cells.join(solved, cells.source.eqNullSafe(solved.source)).select(
        cells.source, "size", "n",
        F.when(F.col("tilt") == float("inf"), limit)
        .when(F.col("size") == 0, 0.0)
        .when(F.col("tilt") == -float("inf"), 0.0)
        .otherwise(rate(F.col("tilt"), F.col("size") / F.col("scale"), limit))
        .alias("rate"),
    )
    most = F.floor(F.col("n") * limit)
    # one row for each size of a source
    longest = Window.partitionBy("source").orderBy(F.desc("size"))
    run = F.sum(_units(F.col("rate")) * F.col("n").cast("decimal(18,0)")).over(longest)
    summed = at.withColumn("_sum", F.floor((run + ONE // 2) / ONE).cast("long"))
    copies = F.col("_sum") - F.coalesce(F.lag("_sum").over(longest), F.lit(0))
    now = stored(
        summed.withColumn("copies", F.greatest(F.lit(0), F.least(copies, most)).cast("long")).drop("_sum"), "copies"
    )
    while True:
        taken = now.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        short = targets.join(taken, targets.source.eqNullSafe(taken.source)).select(
            targets.source.alias("of"), (F.round("target").cast("long") - F.col("taken")).alias("gap")
        )
        with_gap = now.join(short.filter("gap <> 0"), F.col("source").eqNullSafe(F.col("of"))).filter("size > 0")
        wanted = F.round(F.col("gap") / F.col("size")).cast("long")
        change = F.greatest(-F.col("copies"), F.least(wanted, F.floor(F.col("n") * limit) - F.col("copies")))
        left = F.abs(F.col("gap") - change * F.col("size"))
        best = with_gap.select("of", F.abs("gap").alias("gap"), F.struct(left.alias("left"), F.abs(change).alias("much"), "size", change.alias("change")).alias("move"))
        moves = stored(
            best.filter(F.col("move.left") < F.col("gap")).groupBy("of").agg(F.min("move").alias("move")), "moves"
        )
        if moves.isEmpty():
            return now
        same = now.source.eqNullSafe(moves.of) & (now["size"] == F.col("move.size"))
        now = stored(
            now.join(moves, same, "left").select(
                now.source, now["size"], "n", "rate", (F.col("copies") + F.coalesce("move.change", F.lit(0))).alias("copies")
            ),
            "copies",
        )


def mix(
    docs: DataFrame,
    pattern: list[float] = (5, 2, 1),
    limit: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken of every document.

    Targets are those of ``source_targets``; rates those of ``tilts``: documents of a source
    that must shrink are kept the rarer the longer they are, and longer ones are repeated
    first where it must grow, as far from 1 as the target needs and no further. The copies of
    a size are dealt out evenly over its documents, the odd ones in the order of a hash of id
    and text, so the same input gives the same mix. ``taken`` is copies times size.

    NULL and empty texts have size 0 and no copies; NULL sources are a source, the last one.
    Repeated rows are documents each; NULL ids too. Without documents there are no rows. Texts
    are only counted, never split. The tables of sizes have one row for each source and size.
    """
    rows = stored(sized(docs, id_col, text_col, source_col), "sizes")
    cells = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    targets = stored(source_targets(cells, list(pattern), float(limit)), "targets")
    planned = _rounded(cells, tilts(cells, targets, float(limit)), targets, float(limit))

    # the documents of a size, dealt by hash, so that a hot size is ranked in parts
    parts = max(1, math.isqrt(rows.count()))
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source")
    dealt = rows.withColumn("_source", named).withColumn("_part", F.pmod(F.col("row_hash"), F.lit(parts)))
    group = ["_source", "size", "_part"]
    before = Window.partitionBy("_source", "size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*group).agg(F.count("*").alias("_rows"))
    starts = starts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    quota = starts.join(planned.withColumn("_source", named).drop("source"), ["_source", "size"])
    quota = quota.join(targets.withColumn("_source", named).drop("source"), "_source").drop("_rows")
    place = F.col("_before") + F.row_number().over(Window.partitionBy(*group).orderBy("row_hash", "doc_id")) - 1
    copies = F.floor(F.col("copies") / F.col("n")) + (place < F.col("copies") % F.col("n")).cast("long")
    return dealt.join(quota, group).select(
        "doc_id", "source", "size", "source_size", "target", "rate",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )
