"""URL filters by link-graph propagation (operator 1).

Listed rules judge the urls they fit. They also seed the host graph: a host is
trusted by its share of all allowed pages and blocked by its share of all
blocked pages. Trust follows the links from host to host (personalised
PageRank), distrust runs against them, from a host to those that link to it;
both take one join and one aggregation a step. A host with more distrust than
``THRESHOLD`` times its trust has its remaining urls blocked.

Masses are whole numbers (``UNIT`` in all) and each link's share is rounded
down, so sums do not depend on order. Mass that reaches a host without links
ends there. ``converge``, which the registered query uses, hands on only what
arrived in the step before, until no whole unit moves: a share of ``DAMPING``
of it is left after each step, so that is after about 200 steps at most, and
after the longest path where links form no circle. ``propagate`` takes a stated
number of steps from the undamped seeds. The SQL has the converged form.

Defined cases: a null url or one without ``://`` has empty host and path, fits
no rule, takes no part in the graph and is allowed; repeated pages are judged
alike and count as often as they occur; links within a host are ignored; null
html has no links; without seeds or links every mass stays where it starts;
other columns of the pages do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keelson.session import scratch_dir

#: verdict, host, path
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
STEPS = 8
FOLD = 16
DAMPING = 0.85
THRESHOLD = 1.0
UNIT = 10**15
#: Absolute links and those without a scheme; group 1 is the host.
LINK = r"""(?:href|src|HREF|SRC)\s*=\s*["']?\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct (rule, verdict), or null. Rules
    are a list in the plan; of equally long ones a blocking rule comes first."""
    found = []
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found.append(F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found)


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, pages): how many pages of a host link to another host."""
    host = url_parts(F.col(url_col))[0]
    targets = F.array_distinct(F.transform(F.regexp_extract_all(html_col, F.lit(LINK), F.lit(1)),
                                           lambda x: F.translate(x, _UPPER, _LOWER)))
    return (pages.select(host.alias("src"), F.explode(targets).alias("dst")).where("src <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("pages")))


def _arcs(links: DataFrame) -> DataFrame:
    """(kind, host, next, part): the share of a host's mass that each arc takes, written once."""
    arcs = links.selectExpr("stack(2, 'trust', src, dst, 'distrust', dst, src) as (kind, host, next)", "pages")
    whole = arcs.groupBy("kind", "host").agg(F.sum("pages").alias("all"))
    arcs = arcs.join(whole, ["kind", "host"]).select("kind", "host", "next", (F.col("pages") / F.col("all")).alias("part"))
    return _written(arcs, "arcs")


def _saved(table: DataFrame, name: str) -> str:
    table.write.parquet(path := scratch_dir(table.sparkSession, name))
    return path


def _written(table: DataFrame, name: str) -> DataFrame:
    return table.sparkSession.read.parquet(_saved(table, name))


def _moved(now: DataFrame, arcs: DataFrame, damping: float) -> DataFrame:
    return now.join(arcs, ["kind", "host"]).select(
        "kind", F.col("next").alias("host"), F.floor(F.col("mass") * F.lit(damping) * F.col("part")).cast("long").alias("mass"))


def _damped(seeds: DataFrame, damping: float) -> DataFrame:
    return seeds.select("kind", "host", F.floor(F.col("start") * F.lit(1 - damping)).cast("long").alias("mass"))


def propagate(seeds: DataFrame, links: DataFrame, steps: int = STEPS, damping: float = DAMPING) -> DataFrame:
    """(kind, host, mass) after ``steps``, kind ``trust`` or ``distrust``.

    ``seeds`` has (kind, host, start); ``links`` (src, dst, pages)."""
    arcs, seeds = _arcs(links), _written(seeds, "seeds")
    start = _damped(seeds, damping)
    now = seeds.select("kind", "host", F.col("start").alias("mass"))
    if arcs.isEmpty():
        steps = min(steps, 1)
    for k in range(steps):
        now = _moved(now, arcs, damping).unionByName(start).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if k % 4 == 3 and k + 1 < steps:  # cut the lineage
            now = _written(now, "masses")
    return now


def converge(seeds: DataFrame, links: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(kind, host, mass) when no whole unit moves any more; otherwise as ``propagate``.

    One table a step, of the hosts that mass still reaches; they are summed
    once at the end, and every ``FOLD`` steps into one table, after which the
    ones summed are deleted."""
    spark, arcs = seeds.sparkSession, _arcs(links)
    moved = [_saved(_damped(seeds, damping), "moved")]
    if arcs.isEmpty():
        return spark.read.parquet(*moved)
    while not (fresh := spark.read.parquet(moved[-1])).isEmpty():
        if len(moved) > FOLD:
            done, moved = moved[:-1], moved[-1:]
            moved.insert(0, _saved(_summed(spark.read.parquet(*done)), "masses"))
            for path in done:
                _delete(spark, path)
        moved.append(_saved(_summed(_moved(fresh, arcs, damping)).where("mass > 0"), "moved"))
    return _summed(spark.read.parquet(*moved))


def _summed(masses: DataFrame) -> DataFrame:
    return masses.groupBy("kind", "host").agg(F.sum("mass").alias("mass"))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def judge(pages: DataFrame, rules=RULES, url_col: str = "url", html_col: str = "html", steps: int | None = STEPS,
          damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """Every page as struct ``page`` with ``host``, ``path``, ``rule``,
    ``verdict`` (allow or block), and its host's ``trust`` and ``distrust``,
    after ``steps`` or, with None, converged."""
    host, path = url_parts(F.col(url_col))
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = pages.select(host.alias("host"), path.alias("path")).withColumn("fit", fit)
    kinds = F.when(F.col("fit.verdict") == "allow", "trust").otherwise("distrust")
    counts = ruled.where("fit is not null").groupBy(kinds.alias("kind"), "host").agg(F.count(F.lit(1)).alias("n"))
    totals = F.broadcast(counts.groupBy("kind").agg(F.sum("n").alias("total")))  # two rows
    seeds = counts.join(totals, "kind").select(
        "kind", "host", F.floor(F.lit(float(UNIT)) * F.col("n") / F.col("total")).cast("long").alias("start"))
    links = host_links(pages, url_col, html_col)
    mass = converge(seeds, links, damping) if steps is None else propagate(seeds, links, steps, damping)
    hosts = mass.groupBy("host").agg(
        *(F.sum(F.when(F.col("kind") == k, F.col("mass")).otherwise(0)).alias(k) for k in ("trust", "distrust")))
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns if c != html_col)).alias("page"),
                        host.alias("host"), path.alias("path")).withColumn("fit", fit)
    found = rows.join(hosts, "host", "left").withColumns(
        {k: F.coalesce(k, F.lit(0)) for k in ("trust", "distrust")})
    guess = F.when(F.col("distrust") > F.lit(float(threshold)) * F.col("trust"), "block").otherwise("allow")
    return found.select("page", "host", "path", F.col("fit.rule").alias("rule"),
                        F.coalesce("fit.verdict", guess).alias("verdict"), "trust", "distrust")
