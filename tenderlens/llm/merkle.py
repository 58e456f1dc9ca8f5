"""A Merkle tree over a table, a proof for every row, and its check.

Rows become leaves, ordered in trees of a fixed arity: one tree per group, and one over the
groups' roots.  A proof lists the sibling digests on the way up.  Proofs come from pointer
jumping: every node holds the siblings towards an ancestor, and joining the nodes with
themselves adds the ancestor's own siblings and doubles the distance, until the root is reached.

Up to eight leaves of one parent share all siblings but the lowest, so they jump as one row, and texts
never travel: a row is a digest from the first scan on.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlens.llm.common import drop_stored, stored

ARITY = 8
TOP = -1  # the number of the tree over the groups' roots
_BROADCAST_BYTES = 8 << 20
_SALTS = 16
_SEGMENT = "array<struct<before:binary,after:binary>>"


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hexadecimal(value: Column) -> Column:
    """Bytes as lower-case hexadecimal text."""
    return F.lower(F.hex(value))


def leaf(*columns: Column) -> Column:
    """Digest of a row: each value as its length in UTF-8 bytes, ``:`` and its text; NULL as ``-``."""

    def framed(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*[framed(c) for c in columns]))


def _node(tree: Column, level: Column, at: Column) -> Column:
    return F.struct(tree.cast("bigint").alias("tree"), level.cast("int").alias("level"), at.cast("bigint").alias("at"))


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """A stored table's rows with ``place``, their number in the given order from 0; stored.

    The order is cut into ranges, whose sizes are added up, one row per range; inside a
    range a window numbers the rows.  Rows that agree in all of ``order`` are cut by their place
    in the files, so that many of them do not make one large range.
    """
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    placed = stored(
        rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *order, "tie")
        .withColumn("range", F.spark_partition_id())
    )
    sizes = placed.groupBy("range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("range")) - F.col("n")
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order, "tie")) - 1
    numbered = placed.withColumn("inside", inside).join(F.broadcast(sizes.select("range", before.alias("before"))), "range")
    found = stored(numbered.select(*rows.columns, (F.col("before") + F.col("inside")).alias("place")))
    drop_stored(placed)
    return found


def _small(table: DataFrame, row_bytes: int) -> bool:
    """Whether a stored table may be sent to every task: counted, and at most 8 MB."""
    return table.count() * row_bytes <= _BROADCAST_BYTES


def _with_group(rows: DataFrame, groups: DataFrame, on: Sequence[str], row_bytes: int) -> DataFrame:
    """``rows`` with the columns of their group.

    Where the groups are too many to be sent to all tasks, each is copied 16 times and the rows spread
    over the copies, since one group may hold most rows.
    """
    if _small(groups, row_bytes):
        return rows.join(F.broadcast(groups), list(on))
    copies = groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("copy"))
    spread = rows.withColumn("copy", F.pmod(F.xxhash64(*rows.columns), F.lit(_SALTS)).cast("int"))
    return spread.join(copies, [*on, "copy"]).drop("copy")


def _runs(nodes: DataFrame, *carried: str) -> DataFrame:
    """Runs of eight neighbours of ``(tree, size, at, node)``, with the digest of each as ``node``.

    A tree of one node alone has no run above it: it stays that node.
    """
    runs = nodes.groupBy("tree", "size", F.expr(f"at div {ARITY}").alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("at", "node", *carried))).alias("members"))
    joined = digest(F.array_join(F.transform("members.node", hexadecimal), ""))
    return runs.withColumn("node", F.when(F.col("size") == 1, F.col("members")[0]["node"]).otherwise(joined))


def _siblings(member: Column, members: Column) -> Column:
    """The digests of a run before and after one of its members, each side as one string of bytes."""

    def side(keep) -> Column:
        digests = F.transform(F.filter(members, keep), lambda m: m["node"])
        return F.aggregate(digests, F.lit(b""), lambda all_, d: F.concat(all_, d))

    return F.struct(side(lambda m: m["at"] < member["at"]).alias("before"),
                    side(lambda m: m["at"] > member["at"]).alias("after"))


def _above(runs: DataFrame, level: int) -> Column:
    """The node above a run: in the group's tree, or where that ends, the group's place below the top."""
    ends = (F.col("tree") != TOP) & (F.col("size") <= ARITY)
    return F.when(ends, _node(F.lit(TOP), F.lit(0), F.col("tree"))).otherwise(
        _node(F.col("tree"), F.lit(level), F.col("run")))


def _climb(nodes: DataFrame, level: int) -> tuple[list[DataFrame], DataFrame]:
    """The links ``(id, up, segment)`` of all levels from ``level`` up, and the roots ``(tree, node)``."""
    links, roots = [], nodes.where("size = 1").select("tree", "node")
    while nodes.agg(F.max("size")).first()[0] not in (None, 1):
        runs = stored(_runs(nodes.where("size > 1")))
        member = runs.select("tree", "members", _above(runs, level + 1).alias("up"), F.explode("members").alias("m"))
        links.append(member.select(
            _node(F.col("tree"), F.lit(level), F.col("m.at")).alias("id"), "up",
            F.array(_siblings(F.col("m"), F.col("members"))).cast(_SEGMENT).alias("segment")))
        nodes = runs.select("tree", F.ceil(F.col("size") / ARITY).alias("size"), F.col("run").alias("at"), "node")
        roots = roots.unionByName(nodes.where("size = 1").select("tree", "node"))
        level += 1
    return links, roots


def _jumped(links: DataFrame, height: int) -> DataFrame:
    """Links that lead to the root, from links to the next node; ``height`` is the longest way.

    After round r a link spans 2**r levels, unless the root is nearer.  Only nodes that high
    can be at the end of another's link.  A node at the end of very many links is one of few, which
    are counted and sent to all tasks; where they are many, none of them ends many links.
    """
    span = 1
    while span < height:
        high = links.where((F.col("id.tree") == TOP) | (F.col("id.level") > span))
        ends = high.select(F.col("id").alias("up"), F.struct(F.col("up"), "segment").alias("next"))
        ends = F.broadcast(ends) if _small(high, 200 + 32 * ARITY * span) else ends
        jumped = stored(links.join(ends, "up", "left").select(
            "id", F.coalesce("next.up", "up").alias("up"),
            F.when(F.col("next").isNull(), F.col("segment")).otherwise(F.concat("segment", "next.segment")).alias("segment"),
        ))
        drop_stored(links)
        links, span = jumped, span * 2
    return links


def proofs(
    rows: DataFrame, leaf_digest: Column, group: str = "lang", id_column: str = "doc_id",
    presented: Column | None = None,
) -> DataFrame:
    """``(id, leaf, presented, subroot, root, proof)`` for every row.

    Rows are ordered by id in each group, NULL first, then by digest; rows that agree in both are interchangeable.
    Groups are ordered by their name as bytes, NULL first.  While a level has more than one node, every eight
    neighbours become one of the next.  ``proof`` holds, for every level on the way, the digests before and after
    the own one; both are empty where a node has no neighbour.  A tree of one leaf is that leaf and adds no
    level.  ``presented`` is carried along, for example the digest of the row as someone else has it.  No rows give no rows.
    """
    leaves = stored(rows.select(
        F.col(id_column).alias("id"), F.col(group).cast("string").alias("group"), leaf_digest.alias("node"),
        (F.lit(None).cast("binary") if presented is None else presented).alias("presented"),
    ))
    leaves = _ranked(leaves, ["group", "id", "node"])
    key = [F.col("group").isNull().alias("no_name"), F.coalesce("group", F.lit("")).alias("name")]
    groups = stored(leaves.groupBy(*key).agg(F.min("place").alias("first"), F.count("*").alias("size")))
    groups = _ranked(groups, ["first"]).withColumnRenamed("place", "tree")
    in_trees = _with_group(leaves.select("*", *key), groups, ["no_name", "name"], 256)
    carriers = stored(_runs(
        in_trees.withColumn("at", F.col("place") - F.col("first")), "id", "presented"))

    first = carriers.select("tree", F.ceil(F.col("size") / ARITY).alias("size"), F.col("run").alias("at"), "node")
    links, subroots = _climb(first, 1)
    subroots = stored(subroots)
    count = subroots.count()
    tops = subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(count).cast("bigint").alias("size"),
                           F.col("tree").alias("at"), "node")
    top_links, roots = _climb(tops, 0)
    root = roots.select(F.first("node").alias("root")).scalar()

    carried = carriers.withColumn("id", _above(carriers, 1))
    if links or top_links:
        every = stored(reduce(DataFrame.unionByName, [*links, *top_links]))
        found = _jumped(every, len(links) + len(top_links))
        carried = carried.join(found.select("id", "segment"), "id", "left")
    else:
        carried = carried.withColumn("segment", F.lit(None).cast(_SEGMENT))
    carried = _with_group(
        carried.withColumn("segment", F.coalesce("segment", F.array().cast(_SEGMENT))),
        subroots.withColumnRenamed("node", "subroot"), ["tree"], 64)
    member = carried.select("tree", "size", "members", "segment", "subroot", F.explode("members").alias("m"))
    lowest = F.when(F.col("size") > 1, F.array(_siblings(F.col("m"), F.col("members")))).otherwise(F.array().cast(_SEGMENT))
    return member.select(
        F.col("m.id").alias("id"), F.col("m.node").alias("leaf"), F.col("m.presented").alias("presented"),
        "subroot", root.alias("root"), F.concat(lowest.cast(_SEGMENT), "segment").alias("proof"),
    )


def folded(leaf_digest: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of a proof lead to."""
    return F.aggregate(proof, leaf_digest, lambda own, level: digest(
        F.concat(hexadecimal(level["before"]), hexadecimal(own), hexadecimal(level["after"]))))


def proof_digest(proof: Column) -> Column:
    """Digest over all siblings of a proof, from the leaf to the root and from left to right."""
    return digest(F.array_join(F.transform(
        proof, lambda level: F.concat(hexadecimal(level["before"]), hexadecimal(level["after"]))), ""))
