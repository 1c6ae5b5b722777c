"""Merkle manifest of a table: a root for each group of rows and one for all, with a proof for each row.

Every row is a leaf. The leaves of a group stand in ``order``; every ``fanout`` consecutive nodes (the last run may be
shorter) become one node until one is left, the group's subroot. The subroots, in order of their groups, become the root
in the same way.

Slot pivot: a node's place in its group tells its parent (place div fanout) and its slot (place mod fanout). Conditional
aggregates spread the children of each parent over slot columns; the columns put together and hashed are the parent, and
the columns without a child's own are that child's siblings. Several levels go into one pivot, as long as it has at most
``SLOTS`` columns, so a tree over n leaves takes log n / log SLOTS shuffles on its way up, each over a ``SLOTS``-th of the
rows before, and as many joins on its way down, where each block hands its own proof to its children.

Places come from a range sort written once (partition, place inside it, totals of the partitions), never from one window
over a group; blocks are keyed by group and place, so a group with a third of all rows is spread like any other.

Defined cases: a null field is ``-``, others are their bytes' count, ``:`` and value; null groups and null orders come
first; rows with equal order stand by their leaf, equal rows are leaves of their own; a lone leaf is its subroot, a lone
subroot the root, and its proof the hash of nothing; an empty table has an empty manifest; a text of any length is hashed
whole in its row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SLOTS = 16
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf_of(fields: dict[str, Column]) -> Column:
    """Hash of the given values; nulls are told from texts."""
    texts = [v.cast("string") for v in fields.values()]
    return digest(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda h, x: digest(x["before"], h, x["after"]))


def proof_text(path: Column) -> Column:
    """All siblings, from the leaf's level up, each level from left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), "")


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, ord, node, ...) with ``place`` in the group by (ord, node) and ``n``, the group's size."""
    keys = [F.asc_nulls_first(c) for c in ("grp", "ord", "node", "tie")]
    rows = saved(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-nodes")
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = saved(rows.drop("tie").withColumns({"pid": F.spark_partition_id(), "mid": F.monotonically_increasing_id()}), "merkle-placed")
    per = rows.groupBy("grp", "pid").agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("here"))
    group = Window.partitionBy("grp")                     # a row for each partition that the group touches
    per = per.select("grp", "pid", "first", F.sum("here").over(group).alias("n"),
                     F.coalesce(F.sum("here").over(group.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    rows = rows.join(per, ["grp", "pid"])
    return rows.withColumn("place", F.col("mid") - F.col("first") + F.col("off")).drop("pid", "mid", "first", "off")


def _levels(fanout: int) -> int:
    d = 1
    while fanout ** (d + 1) <= SLOTS:
        d += 1
    return d


def _pivot(nodes: DataFrame, fanout: int, extra: list[str]) -> DataFrame:
    """grp, place of the block, n, and slot columns c0.. (node and ``extra`` of each child)."""
    width = fanout ** _levels(fanout)
    child = f"struct({', '.join(['node', *extra])})"
    block = nodes.selectExpr("grp", f"place div {width} AS place", f"place % {width} AS slot", "n", f"{child} AS child")
    return block.groupBy("grp", "place").agg(F.max("n").alias("n"), *[F.expr(f"max(CASE WHEN slot = {s} THEN child END) AS c{s}") for s in range(width)])


def _inner(blocks: DataFrame, fanout: int) -> DataFrame:
    """``blocks`` with the nodes of the levels above the slots: h{level}_{i}, and n{level}, the group's nodes there."""
    depth = _levels(fanout)
    out = blocks.selectExpr("*", "n AS n0", *[f"c{s}.node AS h0_{s}" for s in range(fanout ** depth)])
    for j in range(depth):
        runs = [[f"h{j}_{i * fanout + s}" for s in range(fanout)] for i in range(fanout ** (depth - j - 1))]
        out = out.selectExpr("*", f"(n{j} + {fanout - 1}) div {fanout} AS n{j + 1}", *[
            f"CASE WHEN {r[0]} IS NULL OR n{j} <= 1 THEN {r[0]} ELSE sha2(concat_ws('', {', '.join(r)}), 256) END AS h{j + 1}_{i}"
            for i, r in enumerate(runs)])
    return out


def _siblings(slot: int, fanout: int) -> str:
    """Siblings of a slot, level by level as long as the group has more than one node."""
    steps = []
    for j in range(_levels(fanout)):
        own = slot // fanout ** j
        first = own - own % fanout
        before, after = ("concat_ws(" + ", ".join(["''", *[f"h{j}_{i}" for i in side]]) + ")" for side in (range(first, own), range(own + 1, first + fanout)))
        steps.append(f"CASE WHEN n{j} > 1 THEN struct({before} AS before, {after} AS after) END")
    return f"array_compact(array({', '.join(steps)}))"


def climb(rows: DataFrame, fanout: int, extra: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """From rows (grp, ord, node, ``extra``): the blocks of each pivot, lowest first, and the top node of each group."""
    nodes = _placed(rows)
    most = nodes.agg(F.max("n")).first()[0] or 0
    depth = _levels(fanout)
    stages = []
    while not stages or most > 1:
        blocks = saved(_pivot(nodes, fanout, [] if stages else extra), "merkle-blocks")
        stages.append(blocks)
        nodes = _inner(blocks, fanout).select("grp", "place", F.col(f"n{depth}").alias("n"), F.col(f"h{depth}_0").alias("node"))
        most = -(-most // fanout ** depth)
    return stages, nodes.select("grp", "node")


def descend(stages: list[DataFrame], above: DataFrame, fanout: int, extra: list[str], kept: list[str]) -> DataFrame:
    """Rows (grp, node, ``extra``) with their whole ``path``; ``above``: grp, path and ``kept`` of each group's top."""
    width = fanout ** _levels(fanout)
    down = above.withColumn("place", F.lit(0).cast("long"))
    for k in reversed(range(len(stages))):
        block = stages[k].join(down, ["grp", "place"])
        child = ", ".join(f"struct(place * {width} + {s} AS place, c{s} AS child, {_siblings(s, fanout)} AS own)" for s in range(width))
        every = _inner(block, fanout).selectExpr("grp", "path", *kept, f"explode(array({child})) AS x").where("x.child IS NOT NULL")
        down = every.selectExpr("grp", "x.place", "concat(x.own, path) AS path", *kept,
                                *([] if k else ["x.child.node", *[f"x.child.{c} AS {c}" for c in extra]]))
    return down.drop("place")


def manifest(leaves: DataFrame, group: str, order: str, extra: tuple[str, ...] = (), fanout: int = 2) -> DataFrame:
    """``leaves`` has ``group``, ``order``, ``leaf`` and ``extra``. One row for each: ``order``, ``extra``, leaf, subroot,
    root and path (siblings before and after, from the leaf's level to the root's)."""
    text = F.col(f"`{group}`").cast("string")
    names = [f"e{i}" for i in range(len(extra))]
    rows = leaves.select(F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text)).alias("grp"), F.col(f"`{order}`").alias("ord"),
                         F.col("leaf").alias("node"), *[F.col(f"`{c}`").alias(n) for c, n in zip(extra, names)])
    carried = ["ord", *names]
    stages, tops = climb(rows, fanout, carried)
    tops = saved(tops, "merkle-subroots")
    upper, root = climb(tops.select(F.lit("").alias("grp"), F.col("grp").alias("ord"), "node"), fanout, ["ord"])
    top = root.select("grp", F.col("node").alias("root"), F.array().cast(PATH).alias("path"))
    groups = descend(upper, top, fanout, ["ord"], ["root"]).select(F.col("ord").alias("grp"), "path", F.col("node").alias("subroot"), "root")
    out = descend(stages, saved(groups, "merkle-groups"), fanout, carried, ["subroot", "root"])
    return out.select(F.col("ord").alias(order), *[F.col(n).alias(c) for n, c in zip(names, extra)], F.col("node").alias("leaf"), "subroot", "root", "path")


def tampered_manifest(docs: DataFrame, every: int = 7) -> DataFrame:
    """The manifest of ``docs``, and what its proofs say where ``every`` divides the id's crc32 and n_chars is one more."""
    d = docs.select(*[F.col(f"`{c}`") for c in FIELDS])
    fields = {c: F.col(c) for c in FIELDS}
    hit = (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(every)) == 0) & F.col("n_chars").isNotNull()
    changed = leaf_of({**fields, "n_chars": F.col("n_chars").cast("decimal(20,0)") + 1})
    leaves = d.select("doc_id", "lang", leaf_of(fields).alias("leaf"), F.when(hit, changed).alias("changed"))
    out = manifest(leaves, "lang", "doc_id", ("changed",))
    out = out.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
