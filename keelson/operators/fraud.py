"""Per-user transaction rules as window expressions.

* ``profile``      W1/W2: count, sum, mean and sample deviation of the user's
                   previous ``depth`` valid amounts (ordered by time, then id).
* ``flag_outliers`` W3: amount > ratio x mean and > floor, with at least
                   ``min_n`` previous amounts; or the k-sigma rule.
* ``velocity``     W4: the user's valid events in ``[t - span, t]``, self
                   included, later events with the same time excluded.
* ``fraud_score``  W5/P14: +40 if velocity > 5, +50 if amount > 4000.

Skew. ``Window.partitionBy(user)`` sends all of one user's rows to one task;
with a user holding a third of the data that task is the job. One partial
aggregate therefore finds the users with over ``max_group_rows`` rows (one
number, the largest count, reaches the driver). All others keep the plain form
of one window partition per user; the rows of large users are numbered across
tasks (:mod:`keelson.operators.ranks`), whatever their times, and evaluated by
number:

* ``velocity`` is a difference of two numbers. Each event also asks how many
  events lie before its span; questions and events are numbered together. With
  ``e`` events before this one, its question is at place ``p`` = events before
  the span + ``e`` (questions lie in the order of their events), so the
  velocity is ``2 e + 1 - p``. Two rows an event, no copies, no window.
* ``profile``: chunks of exactly ``max_group_rows`` numbers. A ROWS frame of
  ``depth`` may reach arbitrarily far back, so each chunk's last ``depth``
  amounts are gathered per chunk (bounded), the history entering a chunk is
  assembled from just the previous chunks that hold its last ``depth``
  positions (a RANGE frame over the small per-chunk table), and joined back on
  ``(user, chunk)`` -- the side the rows are already partitioned by.

``chunk=None`` forces the plain form, a width such as ``"1 day"`` chunks of
equal time. All forms give the same rows and values: null users form a group of
their own, and rows with a null time come first in a profile's history and have
no velocity.

Every frame is a running total (or the difference of two), so the cost is
linear in the rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.spans import span_us
from keelson.operators.ranks import numbered
from keelson.session import scratch_dir

_AMT = "decimal(10,2)"
_SUM = "decimal(20,2)"
_SQ = "decimal(30,4)"


def _dec(x) -> Column:
    """An exact decimal literal (a float literal would turn the comparison
    into a double comparison, which can flip at equality)."""
    return F.lit(Decimal(str(x)))


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _floor_div(c: Column, n: int) -> Column:
    """Exact integer floor division (also for times before 1970)."""
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("bigint")


def _chunk_of(ts: str, chunk_us: int) -> Column:
    return _floor_div(_micros(ts), chunk_us)


def _stats(n: Column, s: Column, sq: Column) -> list[Column]:
    """prior_n, prior_sum, prior_avg, prior_stdev from count, sum, sum of squares."""
    mean = F.when(n > 0, s / n)
    var = F.when(n > 1, (sq - s * s / n) / (n - 1))
    stdev = F.sqrt(F.greatest(var.cast("double"), F.lit(0.0)))
    return [n.cast("int").alias("prior_n"), F.when(n > 0, s).cast(_SUM).alias("prior_sum"),
            mean.cast("double").alias("prior_avg"), stdev.alias("prior_stdev")]


_BEFORE = -(1 << 62)


def by_size(df: DataFrame, user: str, max_group_rows: int) -> tuple[DataFrame, DataFrame] | None:
    """The rows of users with over ``max_group_rows`` rows, and all others.
    None when every user fits in one task."""
    sizes = df.groupBy(F.col(user).alias("_user")).agg(F.count(F.lit(1)).alias("_rows"))
    top = sizes.agg(F.max("_rows")).first()[0]
    if top is None or top <= max_group_rows:
        return None
    spark = df.sparkSession
    sizes.filter(F.col("_rows") > max_group_rows).write.parquet(path := scratch_dir(spark, "large-users"))
    large = spark.read.parquet(path)
    same = df[user].eqNullSafe(large["_user"])
    return df.join(large, same, "left_semi"), df.join(large, same, "left_anti")


def _prefix_stats(part: list[str], ts: str, id_col: str, depth: int) -> list[Column]:
    """Count, sum and sum of squares of each valid row's previous ``depth``
    valid amounts inside one window partition, in O(1) per row.

    Rows are ordered with invalid amounts first, so valid rows form one run.
    Running totals up to a row are incremental; the frame is the running
    total before this row minus the running total ``depth`` valid rows
    earlier (``lag``); a sliding ROWS frame would re-aggregate ``depth`` rows
    per row instead."""
    w = Window.partitionBy(*part).orderBy("_v", ts, id_col)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    a = F.col("_a")
    cn = F.count(a).over(run)
    cs = F.sum(a).over(run)
    cq = F.sum(a * a).over(run)
    zero = F.lit(0)
    n = F.least(cn - 1, F.lit(depth))
    s = (cs - a) - F.coalesce(F.lag(cs, depth + 1).over(w), zero)
    q = (cq - a * a) - F.coalesce(F.lag(cq, depth + 1).over(w), zero)
    valid = F.col("_v")
    return [F.when(valid, n).otherwise(0).alias("_ln"),
            F.when(valid, s).cast(_SUM).alias("_ls"),
            F.when(valid, q).cast(_SQ).alias("_lq"),
            cn.alias("_pos"), F.count(a).over(Window.partitionBy(*part)).alias("_cnt")]


def profile(df: DataFrame, user: str, ts: str, id_col: str, amount: str,
            depth: int = 50, chunk: str | None = "auto",
            amount_type: str = _AMT, max_group_rows: int = 2_000_000) -> DataFrame:
    """Statistics of the previous ``depth`` valid amounts per user.

    Adds ``prior_n, prior_sum, prior_avg, prior_stdev``. Rows whose amount is
    null are not part of any history and get ``prior_n = 0``. Sums are exact
    decimals; the mean and deviation are doubles for display.

    ``chunk``: a width such as ``"1 day"``, ``None`` for one window partition
    per user, or ``"auto"``: per user, but chunks of ``max_group_rows`` rows for
    users with more.
    """
    a = F.col(amount).cast(amount_type)
    base = df.withColumn("_a", a).withColumn("_v", F.col("_a").isNotNull())
    if chunk is None:
        # reference form: one window partition per user
        out = base.select("*", *_prefix_stats([user], ts, id_col, depth))
        n, s, sq = F.col("_ln"), F.coalesce(F.col("_ls"), F.lit(0)), F.coalesce(F.col("_lq"), F.lit(0))
        out = out.select(*[F.col(c) for c in df.columns], *_stats(n, s, sq))
        return out

    if chunk == "auto":
        sized = by_size(base, user, max_group_rows)
        if sized is None:
            return profile(df, user, ts, id_col, amount, depth, None, amount_type)
        large, rest = sized
        plain = profile(rest.select(*df.columns), user, ts, id_col, amount, depth, None, amount_type)
        base = numbered(large, user, [ts, id_col], "_c").withColumn("_c", _floor_div(F.col("_c"), max_group_rows))
    else:
        plain = None
        base = base.withColumn("_c", F.when(F.col(ts).isNull(), F.lit(_BEFORE)).otherwise(_chunk_of(ts, span_us(chunk))))
    loc = base.select("*", *_prefix_stats([user, "_c"], ts, id_col, depth))
    # per chunk: its last `depth` valid amounts, in order (this branch reads
    # and shuffles the narrow (user, time, id, amount) rows a second time)
    tails = (loc.filter(F.col("_v") & (F.col("_cnt") - F.col("_pos") < depth))
             .groupBy(user, "_c")
             .agg(F.transform(F.sort_array(F.collect_list(F.struct(
                 F.col(ts).alias("t"), F.col(id_col).alias("i"), F.col("_a").alias("a")))),
                 lambda x: x["a"]).alias("_tail")))
    # Number the tail amounts of a user 1, 2, ... in chunk order (`_end` is
    # the position of a chunk's last one). The history entering chunk c is
    # positions (start_c - depth, start_c], start_c = end of the previous
    # chunk: exactly the chunks whose end lies in [start_c - depth + 1,
    # start_c]. A RANGE frame over positions collects just those (usually
    # one or two for a busy user) instead of the previous `depth` chunks.
    run = Window.partitionBy(user).orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
    tails = tails.withColumn("_end", F.sum(F.size("_tail")).over(run))
    # each chunk gives two rows: its tail at its end position, and a query
    # row at its start position (one generator, so `tails` is computed once)
    none_arr = F.lit(None).cast(f"array<{amount_type}>")
    marks = F.array(
        F.struct(F.col("_end").alias("k"), F.lit(None).cast("bigint").alias("c"),
                 F.col("_tail").alias("a")),
        F.struct((F.col("_end") - F.size("_tail")).alias("k"), F.col("_c").alias("c"),
                 none_arr.alias("a")))
    both = tails.select(user, F.inline(marks)).withColumnsRenamed(
        {"k": "_key", "c": "_c", "a": "_tail"})
    wq = Window.partitionBy(user).orderBy("_key").rangeBetween(-(depth - 1), 0)
    hist = (both.select(user, "_c", F.flatten(F.collect_list("_tail").over(wq)).alias("_h"))
            .filter(F.col("_c").isNotNull()))
    last = F.when(F.size("_h") > depth, F.slice("_h", -depth, depth)).otherwise(F.col("_h"))
    hist = hist.select(user, "_c", last.alias("_h"))
    hist = hist.select(F.col(user).alias("_hu"), F.col("_c").alias("_hc"), "_h")
    joined = loc.join(hist, loc[user].eqNullSafe(hist["_hu"]) & (loc["_c"] == hist["_hc"]), "left")
    need = F.lit(depth) - F.col("_ln")
    hsize = F.coalesce(F.size("_h"), F.lit(0))
    take = F.least(need, hsize)
    halo = F.when((take > 0) & F.col("_v"), F.slice("_h", -take, take)) \
        .otherwise(F.array().cast(f"array<{amount_type}>"))
    hs = F.aggregate(halo, F.lit(0).cast(_SUM), lambda acc, x: (acc + x).cast(_SUM))
    hq = F.aggregate(halo, F.lit(0).cast(_SQ), lambda acc, x: (acc + x * x).cast(_SQ))
    n = F.col("_ln") + F.size(halo)
    s = F.coalesce(F.col("_ls"), F.lit(0)).cast(_SUM) + hs
    sq = F.coalesce(F.col("_lq"), F.lit(0)).cast(_SQ) + hq
    out = joined.select(*[F.col(c) for c in df.columns], *_stats(n, s, sq))
    return out if plain is None else out.unionByName(plain)


def flag_outliers(df: DataFrame, amount: str, rule: str = "ratio", ratio: float = 3.0,
                  floor: float = 500.0, min_n: int = 3, k: float = 3.0,
                  amount_type: str = _AMT, alias: str = "is_outlier") -> DataFrame:
    """W3 on the output of :func:`profile`.

    ``ratio``: amount > ratio x mean and amount > floor, compared exactly as
    ``amount * n > ratio * sum``. ``sigma``: amount > mean + k x stdev and
    amount > floor. Both need ``prior_n >= min_n``; null amounts never flag.
    """
    a = F.col(amount).cast(amount_type)
    enough = F.col("prior_n") >= min_n
    if rule == "ratio":
        big = a * F.col("prior_n") > _dec(ratio) * F.col("prior_sum")
    elif rule == "sigma":
        big = a.cast("double") > F.col("prior_avg") + F.lit(float(k)) * F.col("prior_stdev")
    else:
        raise ValueError("rule is 'ratio' or 'sigma'")
    flag = enough & big & (a > _dec(floor))
    return df.withColumn(alias, F.coalesce(flag, F.lit(False)))


def velocity(df: DataFrame, user: str, ts: str, id_col: str, span: str = "60 seconds",
             amount: str | None = None, chunk: str | None = "auto",
             alias: str = "velocity", amount_type: str = _AMT,
             max_group_rows: int = 2_000_000) -> DataFrame:
    """Per row, the user's events with time in ``[t - span, t]`` (lower
    bound inclusive), counting same-time events only up to this id.

    Rows with a null time, or a null ``amount`` when one is given, are not
    events of the history and get a null velocity. ``chunk`` as in
    :func:`profile` (a chunk of time is never narrower than ``span``).
    """
    su = span_us(span)
    valid = F.col(ts).isNotNull()
    if amount is not None:
        valid = valid & F.col(amount).cast(amount_type).isNotNull()
    base = df.withColumn("_t", F.when(valid, _micros(ts)))
    events = base.filter(F.col("_t").isNotNull())
    sized = by_size(events, user, max_group_rows) if chunk == "auto" else None
    if sized is not None:
        out = _velocity_by_rank(sized[0], user, id_col, su, alias).unionByName(
            _velocity_by_window(sized[1], user, id_col, su, None, alias))
    else:
        width = None if chunk in (None, "auto") else max(su, span_us(chunk))
        out = _velocity_by_window(events, user, id_col, su, width, alias)
    # rows that are no events stay in the output, and need no task of their own
    rest = base.filter(F.col("_t").isNull()).withColumn(alias, F.lit(None).cast("bigint"))
    return out.unionByName(rest).drop("_t")


def velocity_marks(events: DataFrame, user: str, id_col: str, span: int) -> DataFrame:
    """Two rows an event: the event itself (``_kind`` 0, at its time) and its
    question (``_kind`` 1, just before its span, with all columns); ``_e`` is
    the event's number among its user's."""
    ranked = numbered(events, user, ["_t", id_col], "_e")
    asked = ranked.withColumns({"_when": F.col("_t") - F.lit(span + 1), "_kind": F.lit(1)})
    told = ranked.select(user, F.col("_t").alias("_when"), F.lit(0).alias("_kind"), "_e")
    return asked.unionByName(told, allowMissingColumns=True)


def _velocity_by_rank(events: DataFrame, user: str, id_col: str, span: int, alias: str) -> DataFrame:
    placed = numbered(velocity_marks(events, user, id_col, span), user, ["_when", "_kind", "_e"], "_p")
    return (placed.filter(F.col("_kind") == 1).withColumn(alias, 2 * F.col("_e") + 1 - F.col("_p"))
            .select(*events.columns, alias))


def _velocity_by_window(events: DataFrame, user: str, id_col: str, span: int, width: int | None,
                        alias: str) -> DataFrame:
    """One window partition per user, or per user and ``width`` of time; rows
    within ``span`` before a chunk are copied into it (once, as no chunk is
    narrower than the span) and dropped after."""
    src, part = events, [user]
    if width is not None:
        chunks = F.array_distinct(F.array(_floor_div(F.col("_t"), width), _floor_div(F.col("_t") + F.lit(span), width)))
        src, part = events.withColumn("_pc", F.explode(chunks)), [user, "_pc"]
    # events up to this one in (time, id) order, less those before the span:
    # both are running totals, so a row costs the same whatever the span holds
    upto = Window.partitionBy(*part).orderBy("_t", id_col).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*part).orderBy("_t").rangeBetween(Window.unboundedPreceding, -(span + 1))
    out = src.withColumn("_upto", F.count(F.lit(1)).over(upto))
    out = out.withColumn(alias, F.col("_upto") - F.count(F.lit(1)).over(before))
    if width is not None:
        out = out.filter(F.col("_pc") == _floor_div(F.col("_t"), width))
    return out.select(*events.columns, alias)


def fraud_score(df: DataFrame, amount: str, velocity_col: str = "velocity",
                max_velocity: int = 5, max_amount: float = 4000.0,
                velocity_points: int = 40, amount_points: int = 50,
                threshold: int = 70, amount_type: str = _AMT) -> DataFrame:
    """Heuristic score and the alert flag ``score > threshold``.

    A row with an undecodable (null) amount scores 0, as it is skipped.
    """
    a = F.col(amount).cast(amount_type)
    score = (F.when(F.col(velocity_col) > max_velocity, velocity_points).otherwise(0)
             + F.when(a > _dec(max_amount), amount_points).otherwise(0))
    score = F.when(a.isNull(), 0).otherwise(score)
    return df.withColumn("score", score.cast("int")) \
        .withColumn("alert", F.col("score") > threshold)
