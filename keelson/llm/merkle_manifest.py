"""A Merkle manifest of a dataset: leaves, subroots, one root, and each row's proof.

A row's leaf is the digest of its fields. The leaves of a group ascend by key;
every eight consecutive nodes become their digest until one node remains, the
group's subroot; the subroots, ordered by group, give the root likewise.

Concatenated levels. Nodes are numbered in order without gathering a group (a
range-partitioned table, counted per part and offset), and dealt to aligned
blocks of 8^3. A block keeps each of its levels as one hex string: a parent is
the digest of a fixed-width substring, a node's siblings are the substrings
that flank it. Block tops are numbered already (a block's number is its place)
and recurse as the nodes of the next round, 512 times fewer. Proofs come down
the same way: a block joins the path of its top by (group, block) and hands it
to its members, so no join has a key of more than one block.

Defined results. A null field counts as ``-``, and null groups and keys come
first. Rows of one key are ordered by leaf (wholly equal rows are
interchangeable). Texts of any length are digested whole, one at a time. An
empty table gives no rows. Only the named columns are read, so others may have
any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keelson.session import scratch_dir

FAN = 8
#: Levels that a block keeps, hence 512 nodes a block.
LEVELS = 3
BLOCK = FAN ** LEVELS
_HEX = 64
_IN_PART = (1 << 33) - 1


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    df.write.parquet(path := scratch_dir(spark, name))
    return spark.read.parquet(path)


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``place`` (from 0 within ``grp``, ascending by ``order``)
    and ``size`` (nodes of the group).

    Nodes are written before they are dealt by range, so that the row number
    that parts equal rows is the same in every attempt of a task."""
    rows = _written(nodes, "merkle-nodes").withColumn("_row", F.monotonically_increasing_id())
    keys = ["grp", *order, "_row"]
    dealt = _written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .select(*nodes.columns, F.spark_partition_id().alias("_part"),
                             F.monotonically_increasing_id().bitwiseAND(_IN_PART).alias("_at")), "merkle-order")
    whole = Window.partitionBy("_grp")
    parts = (dealt.groupBy(F.col("grp").alias("_grp"), F.col("_part").alias("_p"))
             .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
             .select("_grp", "_p", "_first", F.sum("_n").over(whole).alias("size"),
                     (F.sum("_n").over(whole.orderBy("_p")) - F.col("_n")).alias("_before")))
    same = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("_part") == F.col("_p"))
    return dealt.join(parts, same).select(
        *nodes.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("place"), "size")


def _parents(level: str) -> Column:
    """The level above a level's hex string."""
    runs = F.ceil(F.length(level) / (FAN * _HEX)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(
        F.substr(F.col(level), i * (FAN * _HEX) + 1, F.lit(FAN * _HEX)), 256)), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of ``nodes`` (grp, place, size, digest, item): their items in
    order, the strings of their levels (null above the group's last), their top."""
    member = F.struct("place", "digest", "item")
    out = (nodes.groupBy("grp", "size", F.floor(F.col("place") / BLOCK).alias("block"))
           .agg(F.sort_array(F.collect_list(member)).alias("_members"))
           .select("grp", "size", "block", F.transform("_members", lambda m: m["item"]).alias("items"),
                   F.array_join(F.transform("_members", lambda m: m["digest"]), "").alias("level0")))
    for k in range(LEVELS):
        out = out.withColumn(f"level{k + 1}", F.when(F.col("size") > FAN ** k, _parents(f"level{k}")))
    return out.withColumn("top", F.coalesce(*(f"level{k}" for k in range(LEVELS, -1, -1))))


def _steps(at: Column) -> Column:
    """The sibling segments of the block's node ``at``, level by level."""
    steps = []
    for k in range(LEVELS):
        level, i = F.col(f"level{k}"), F.floor(at / FAN ** k).cast("int")
        nth = F.pmod(i, F.lit(FAN))
        steps.append(F.when(F.col(f"level{k + 1}").isNotNull(), F.struct(
            F.substr(level, (i - nth) * _HEX + 1, nth * _HEX).alias("left"),
            F.substr(level, (i + 1) * _HEX + 1, (FAN - 1 - nth) * _HEX).alias("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _grow(nodes: DataFrame) -> list[DataFrame]:
    """The rounds of blocks from the nodes up to one block a group."""
    rounds = []
    while True:
        rounds.append(_written(_blocks(nodes), "merkle-blocks"))
        more = rounds[-1].filter(F.col("size") > BLOCK)
        if more.isEmpty():
            return rounds
        nodes = more.select("grp", F.col("block").alias("place"), F.ceil(F.col("size") / BLOCK).alias("size"),
                            F.col("top").alias("digest"), F.lit(None).cast("string").alias("item"))


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """The last node of every group."""
    done = [r.filter(F.col("size") <= BLOCK).select("grp", "top") for r in rounds]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Every node of the first round with the path to the root, given each
    group's ``above`` (grp, path, and more columns that are handed down)."""
    handed = [c for c in above.columns if c not in ("grp", "path")]
    ends = above.withColumnsRenamed({"grp": "_g", "path": "_above"})
    inner = None
    for blocks in reversed(rounds):
        known = (blocks.filter(F.col("size") <= BLOCK).join(ends, F.col("grp").eqNullSafe(F.col("_g"))))
        if inner is not None:
            upper = inner.select(F.col("grp").alias("_g"), F.col("place").alias("_b"), F.col("path").alias("_above"),
                                 *handed)
            here = F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))
            known = known.unionByName(blocks.filter(F.col("size") > BLOCK).join(upper, here).drop("_b"))
        one = known.select("*", F.posexplode("items").alias("_at", "item"))
        inner = one.select("grp", (F.col("block") * BLOCK + F.col("_at")).alias("place"), "item",
                           F.substr(F.col("level0"), F.col("_at") * _HEX + 1, F.lit(_HEX)).alias("digest"),
                           F.concat(_steps(F.col("_at")), F.col("_above")).alias("path"), *handed)
    return inner


def manifest(docs: DataFrame, key: str, group: str, fields: list[str], seen: Column | None = None) -> DataFrame:
    """One row per document: ``key``, ``group``, ``leaf``, ``subroot``, ``root``
    and ``path``, the (left, right) sibling segments from the leaf to the root.

    ``seen`` is a leaf computed from another copy of the row, null where it
    needs no check; it comes back as ``seen`` beside the manifest, to be folded."""
    own = leaf([F.col(c) for c in fields])
    kept = F.struct(F.col(key).alias("key"), (F.lit(None) if seen is None else seen).cast("string").alias("seen"))
    leaves = numbered(docs.select(F.col(group).alias("grp"), F.col(key).alias("_key"), own.alias("digest"),
                                  kept.alias("item")), ["_key", "digest"])
    rounds = _grow(leaves.drop("_key"))
    subroots = _tops(rounds).select(F.lit(0).alias("grp"), F.struct(F.col("grp").alias("g")).alias("item"),
                                    F.col("top").alias("digest"), F.col("grp").alias("_key"))
    upper = _grow(numbered(subroots, ["_key"]).drop("_key"))
    nothing = F.filter(F.array(F.struct(F.lit("").alias("left"), F.lit("").alias("right"))), lambda s: F.lit(False))
    root = _tops(upper).select("grp", F.col("top").alias("root"), nothing.alias("path"))
    paths = _descend(upper, root).select(F.col("item.g").alias("grp"), "path", F.col("digest").alias("subroot"), "root")
    return _descend(rounds, paths).select(F.col("item.key").alias(key), F.col("grp").alias(group),
                                          F.col("digest").alias("leaf"), "subroot", "root", "path",
                                          F.col("item.seen").alias("seen"))
