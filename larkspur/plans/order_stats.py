"""Exact medians and exact per-group quotas that hold up under a hot group.

The obvious forms - `median()` and `row_number() over (partition by group)` -
bring a whole group into one task. Here there is one way for every size: a
mergeable sketch proposes a bracket of values, an aggregate counts exactly what
lies below and inside it, a bracket that misses is widened, one that holds too
many rows is cut into bins of which the right ones stay, and only then are the
values inside ranked - at most BRACKET_ROWS of a group, or one repeated value.
Sketches may differ between runs; the results cannot, because everything that is
returned is derived from exact counts.

Per-group facts (one row per group) are written to shared storage as soon as
they are known. The planner then knows their true size: a small table is
broadcast and the rows are never shuffled by a hot key, a large one still gets a
skew-split join. Plans stay flat as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.plans.shared import attach, cut

ACCURACY = 10_000
# A bracket is ranked once no group has more rows than this in it.
BRACKET_ROWS = 100_000
BINS = 4096


def _finite(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.select(*keys, v.alias("_v")).where(v.isNotNull() & ~F.isnan(v))


def _group_window(keys: list[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _measured(rows: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """`bounds` plus exact counts below, inside and above the bracket, and the ends of all three."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    below, inside, above = v < lo, (v >= lo) & (v <= hi), v > hi
    counts = attach(rows, bounds.select(*keys, "_lo", "_hi"), keys).groupBy(*keys).agg(
        F.count_if(below).alias("_below"), F.count_if(inside).alias("_inside"),
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        F.min(F.when(inside, v)).alias("_first_v"), F.max(F.when(inside, v)).alias("_last_v"))
    if not keys:  # a scalar per column: one row, or none without values
        return counts.where("n > 0").select(
            "*", *[bounds.select(c).scalar().alias(c) for c in bounds.columns])
    return attach(counts, bounds, keys)


def _brackets(rows: DataFrame, keys: list[str], bounds: DataFrame, first: Column, last: Column,
              bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """(keys, n, min, max, _below, _lo, _hi, carried, _a, _b): brackets that hold the ranks _a to _b.

    `bounds` is (keys, _lo, _hi, carried...); `first` and `last` are the wanted
    ranks, from 1, as expressions over n and the carried columns.
    """
    carried = [c for c in bounds.columns if c not in (*keys, "_lo", "_hi")]
    while True:
        found = cut(_measured(rows, bounds, keys).withColumns({"_a": first, "_b": last}))
        # ranks that no row has (a quota of nothing, or of more than there is) ask for no bracket
        asks = (F.col("_b") >= 1) & (F.col("_a") <= F.col("n"))
        low = asks & (F.col("_a") <= F.col("_below"))
        high = asks & (F.col("_b") > F.col("_below") + F.col("_inside"))
        crowded = asks & (F.col("_inside") > bracket_rows) & (F.col("_first_v") < F.col("_last_v"))
        state = found.agg(F.count_if(low | high).alias("missed"), F.count_if(crowded).alias("crowded")).collect()[0]
        if not state["missed"] and not state["crowded"]:
            return found
        if state["missed"]:
            bounds = found.select(
                *keys, F.when(low, F.col("min")).otherwise(F.col("_lo")).alias("_lo"),
                F.when(high, F.col("max")).otherwise(F.col("_hi")).alias("_hi"), *carried)
        else:
            bounds = _narrowed(rows, found, keys, carried)
        bounds = cut(bounds)


def _narrowed(rows: DataFrame, found: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """Bounds cut down to the bins, of BINS over each bracket, that hold the wanted ranks."""
    facts = found.select(*keys, "_first_v", "_last_v", "_below", "_a", "_b")
    width = F.greatest(F.col("_last_v") - F.col("_first_v"), F.lit(5e-324))
    bin_ = F.least(F.floor((F.col("_v") - F.col("_first_v")) / width * BINS), F.lit(BINS)).cast("int")
    bins = (attach(rows, facts, keys)
            .where((F.col("_v") >= F.col("_first_v")) & (F.col("_v") <= F.col("_last_v")))
            .groupBy(*keys, bin_.alias("_bin")).agg(
                F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max")))
    upto = F.sum("_n").over(_group_window(keys).orderBy("_bin")) + F.col("_below")
    ranked = attach(bins, facts, keys).withColumn("_upto", upto)
    holds = (F.col("_upto") >= F.col("_a")) & (F.col("_upto") - F.col("_n") < F.col("_b"))
    right = ranked.where(holds).groupBy(*keys).agg(F.min("_min").alias("_new_lo"), F.max("_max").alias("_new_hi"))
    if not keys:
        right = right.where("_new_lo IS NOT NULL")
    joined = attach(found, cut(right), keys, "left")
    return joined.select(*keys, F.coalesce("_new_lo", "_lo").alias("_lo"),
                         F.coalesce("_new_hi", "_hi").alias("_hi"), *carried)


def _ranked_values(rows: DataFrame, found: DataFrame, keys: list[str], *carry: str) -> DataFrame:
    """(keys, carry, _a, _b, _v, _n, _upto): values inside the brackets with the rows up to each."""
    facts = found.select(*keys, "_lo", "_hi", "_below", "_a", "_b", *carry)
    values = (attach(rows, facts, keys).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))
    upto = F.sum("_n").over(_group_window(keys).orderBy("_v")) + F.col("_below")
    return attach(values, facts, keys).withColumn("_upto", upto)


def group_medians(df: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """(keys, n, median) over the non-null, non-NaN values; mean of the middle two."""
    return group_stats(df, keys, value).select(*keys, "n", F.col("median").alias(out))


def group_stats(df: DataFrame, keys: list[str], value: str, bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """(keys, n, min, median, max) over the non-null, non-NaN values."""
    rows = _finite(df, keys, value)
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("_v", [0.499, 0.501], ACCURACY).alias("_p"))
    bounds = sketch.select(*keys, F.col("_p")[0].alias("_lo"), F.col("_p")[1].alias("_hi"))
    found = _brackets(rows, keys, bounds, F.expr("(n + 1) div 2"), F.expr("n div 2 + 1"), bracket_rows)
    ranked = _ranked_values(rows, found, keys, "n", "min", "max")

    def at(rank: str) -> Column:
        hit = (F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_n") < F.col(rank))
        return F.max(F.when(hit, F.col("_v")))

    stats = ranked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("n", "min", "max")],
                                      ((at("_a") + at("_b")) / 2).alias("median"))
    if not keys:
        stats = stats.where(F.col("n").isNotNull())
    return stats.select(*keys, "n", "min", "median", "max")


def stats_within(bins: DataFrame, between: Callable[[DataFrame], DataFrame], keys: list[str],
                 bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """(keys, n, min, median, max) from exact counts by bin, and from the values of the middle bins alone.

    bins: (keys, bin, n, lo, hi), a written table: counts and ends of bins in the
    order of values. `between` gets (keys, lo, hi) and returns (keys, _v), all
    values from lo to hi of these groups. A group whose middle bins hold one
    value each asks for none.
    """
    total = bins.groupBy(*keys).agg(F.sum("n").alias("_total"), F.min("lo").alias("_least"), F.max("hi").alias("_most"))
    total = cut(total.where("_total > 0"))
    upto = bins.withColumn("_upto", F.sum("n").over(_group_window(keys).orderBy("bin")))
    a, b = F.expr("(_total + 1) div 2"), F.expr("_total div 2 + 1")
    near = attach(upto, total, keys).where((F.col("_upto") >= a) & (F.col("_upto") - F.col("n") < b))
    facts = near.groupBy(*keys).agg(
        F.max("_total").alias("_total"), F.max("_least").alias("_least"), F.max("_most").alias("_most"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min(F.col("_upto") - F.col("n")).alias("_base"),
        F.min_by("lo", "bin").alias("_first"), F.max_by("hi", "bin").alias("_last"),
        F.max(F.col("lo") < F.col("hi")).alias("_open"))
    facts = cut(facts.where("_total IS NOT NULL"))
    plain = facts.where("NOT _open").select(
        *keys, F.col("_total").alias("n"), F.col("_least").alias("min"),
        # one bin holds both middle ranks, or each of two bins holds one
        ((F.col("_first") + F.col("_last")) / 2).alias("median"), F.col("_most").alias("max"))
    open_ = cut(facts.where("_open").select(*keys, "_total", "_least", "_most", "_base", F.col("lo").alias("_lo"), F.col("hi").alias("_hi")))
    if open_.isEmpty():
        return plain
    rows = cut(between(open_.select(*keys, F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))))
    found = _brackets(rows, keys, open_, a - F.col("_base"), b - F.col("_base"), bracket_rows)
    ranked = _ranked_values(rows, found, keys, "_total", "_least", "_most")

    def at(rank: str) -> Column:
        hit = (F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_n") < F.col(rank))
        return F.max(F.when(hit, F.col("_v")))

    inner = ranked.groupBy(*keys).agg(F.max("_total").alias("n"), F.max("_least").alias("min"),
                                      ((at("_a") + at("_b")) / 2).alias("median"), F.max("_most").alias("max"))
    return plain.unionByName(inner.where("n IS NOT NULL"))


_DIGITS = 4


def hashed_cuts(df: DataFrame, keys: list[str], quotas: DataFrame, quota: str, uid: str) -> DataFrame:
    """(keys, _cut): the last (md5(uid), uid) that a group's quota takes, in that order.

    Groups that fit whole get a cut above everything, groups that take nothing
    none. Two rounds of counting hash prefixes leave the rows of one prefix, a
    16^-8 part of a group, to be ranked. What is known of the groups is written
    before every join, so that rows are not shuffled by a hot group to learn it.
    """
    h = F.md5(F.col(uid).cast("string"))
    rows = df.select(*keys, h.alias("_h"), F.col(uid).cast("string").alias("_u"))
    facts = quotas.select(*keys, F.col(quota).cast("bigint").alias("_room"), F.lit("").alias("_head")).where("_room > 0")
    facts, whole = cut(facts), None
    for step in (1, 2):
        prefix = F.substring("_h", 1, step * _DIGITS)
        counts = (attach(rows, facts, keys).where(F.col("_h").startswith(F.col("_head")))
                  .groupBy(*keys, "_room", prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n")))
        counts = counts.withColumn("_upto", F.sum("_n").over(_group_window(keys).orderBy("_p")))
        edge = F.min(F.when(F.col("_upto") >= F.col("_room"), F.struct(
            "_p", (F.col("_room") - F.col("_upto") + F.col("_n")).alias("room")))).alias("_e")
        edges = cut(counts.groupBy(*keys).agg(edge))
        if step == 1:
            whole = edges.where("_e IS NULL").select(*keys, F.struct(F.lit("~").alias("_h"), F.lit("").alias("_u")).alias("_cut"))
        facts = edges.where("_e IS NOT NULL").select(*keys, F.col("_e.room").alias("_room"), F.col("_e._p").alias("_head"))
        facts = cut(facts)
    at_edge = attach(rows, facts, keys).where(F.col("_h").startswith(F.col("_head")))
    rank = F.row_number().over(_group_window(keys).orderBy("_h", "_u"))
    last = at_edge.withColumn("_rn", rank).where("_rn = _room").select(*keys, F.struct("_h", "_u").alias("_cut"))
    return whole.unionByName(last)


def mark_hashed(df: DataFrame, keys: list[str], quotas: DataFrame, quota: str, uid: str, out: str = "taken") -> DataFrame:
    """Flag the first `quota` rows of every group in md5(uid) order; uids are distinct within a group.

    Groups without a quota take nothing. Every row is decided by comparing it
    with its group's cut.
    """
    cuts = cut(hashed_cuts(df, keys, quotas, quota, uid))
    own = F.struct(F.md5(F.col(uid).cast("string")).alias("_h"), F.col(uid).cast("string").alias("_u"))
    marked = attach(df, cuts, keys, "left")
    return marked.withColumn(out, F.coalesce(own <= F.col("_cut"), F.lit(False))).select(*df.columns, out)


def take_hashed(df: DataFrame, keys: list[str], quotas: DataFrame, quota: str, uid: str) -> DataFrame:
    """Exactly min(quota, size) rows of every group, chosen by md5(uid)."""
    return mark_hashed(df, keys, quotas, quota, uid, "_taken").where("_taken").drop("_taken")


def quota_cutoffs(df: DataFrame, keys: list[str], quotas: DataFrame, quota: str, score: str,
                  grid: int = 200, bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """(keys, cutoff, need, ties): the exact score at which each quota fills.

    Rows above `cutoff` all fit; `need` of the `ties` rows equal to it do. The
    cutoff is the least score where the whole group fits, infinite for a quota
    of nothing.
    """
    rows = _finite(df, keys, score)
    shares = ", ".join(f"{i / grid}D" for i in range(grid + 1))
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_total"),
        F.expr(f"percentile_approx(_v, array({shares}), {ACCURACY})").alias("_cuts"))
    wanted = quotas.select(*keys, F.col(quota).cast("bigint").alias("_q"))
    sketch = attach(sketch, wanted, keys).withColumn("_q", F.least("_q", "_total"))
    # The quota-th largest is the (total - quota + 1)-th smallest.
    share = (F.col("_total") - F.col("_q") + 1) / F.col("_total") * grid
    lo = F.get("_cuts", F.greatest(F.floor(share) - 1, F.lit(0)).cast("int"))
    hi = F.get("_cuts", F.least(F.ceil(share) + 1, F.lit(grid)).cast("int"))
    bounds = sketch.select(*keys, "_q", lo.alias("_lo"), hi.alias("_hi"))
    rank = F.col("n") - F.col("_q") + 1
    found = _brackets(rows, keys, bounds, rank, rank, bracket_rows)
    ranked = _ranked_values(rows, found.where("_q > 0"), keys, "_q", "n")
    hit = (F.col("_upto") >= F.col("_a")) & (F.col("_upto") - F.col("_n") < F.col("_a"))
    at = ranked.where(hit).select(
        *keys, F.col("_v").alias("cutoff"),
        (F.col("_upto") - F.col("_a") + 1).alias("need"), F.col("_n").alias("ties"))
    nothing = found.where("_q <= 0").select(
        *keys, F.lit(float("inf")).alias("cutoff"), F.lit(0).cast("bigint").alias("need"), F.lit(0).cast("bigint").alias("ties"))
    return at.unionByName(nothing)


def take_top(df: DataFrame, keys: list[str], quotas: DataFrame, quota: str, score: str, uid: str,
             bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """The `quota` highest-scored rows of every group; ties in md5(uid) order.

    Rows without a usable score are never taken.
    """
    df = df.where(F.col(score).isNotNull() & ~F.isnan(score))
    s = F.col(score)
    cutoffs = cut(quota_cutoffs(df, keys, quotas, quota, score, bracket_rows=bracket_rows))
    short = cutoffs.where(F.col("need") < F.col("ties"))
    tied = attach(df, short, keys).where(s == F.col("cutoff"))
    ties = hashed_cuts(tied.select(*df.columns), keys, short, "need", uid)
    facts = attach(cutoffs, ties, keys, "left")
    own = F.struct(F.md5(F.col(uid).cast("string")).alias("_h"), F.col(uid).cast("string").alias("_u"))
    fits = (s > F.col("cutoff")) | ((s == F.col("cutoff")) & ((F.col("need") >= F.col("ties")) | (own <= F.col("_cut"))))
    return attach(df, cut(facts), keys).where(fits).select(*df.columns)


def previous_value(df: DataFrame, key: str, order: list[str], value: str,
                   bucket: Column, out: str) -> DataFrame:
    """`lag(value) over (partition by key order by order)` without a hot task.

    The key is split into order-preserving `bucket`s, each its own window. The
    first row of a bucket takes the last value of the bucket before it, found
    on the (key, bucket) summary. Null values are carried like any other.
    """
    rows = df.withColumn("_bucket", bucket)
    local = Window.partitionBy(key, "_bucket").orderBy(*order)
    tails = rows.groupBy(key, "_bucket").agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_tail"))
    carried = tails.withColumn("_carry", F.lag("_tail").over(
        Window.partitionBy(key).orderBy("_bucket"))).drop("_tail")
    # a struct tells a predecessor without a value from no predecessor in this bucket
    lagged = rows.withColumn("_own", F.lag(F.struct(F.col(value).alias("v"))).over(local))
    joined = attach(lagged, carried, [key, "_bucket"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_own"), F.col("_carry"))["v"]).drop("_bucket", "_carry", "_own")
