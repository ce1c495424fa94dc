"""Merkle manifest of a dataset: one tree per group of rows, one tree over their roots, climbed by a recursive query.

Every row is a leaf. The leaves of a group stand in the order of their ids; runs of ``FANOUT`` neighbours become
one node, level by level, until one is left; these subroots, in the order of their groups, grow a last tree in
the same way. Each level is written as a table of node rows: the digests of the children and the place of the
node. The place of the parent follows from it, and that of a subroot's parent from the rank of its group.

To check leaves, a Spark recursive query ascends from every leaf along these links, folds the leaf's digest with its
siblings at each node, and appends the siblings to its proof. The leaves of one run share all siblings from their first
parent on, so they travel in one row with one list of siblings and a folded digest each.

The nodes near the top meet very many leaves, but there are at most ``TOP_NODES`` of them: they are
broadcast in a second query. Below, every node meets few leaves, and the join is by key.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edmart.llm.shared import stored
from edmart.operators.joins import lookup_join

FANOUT = 8
TOP_NODES = 8192
DIGEST = 64  # hex digits
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "*"  # the tree over the subroots; other trees are named "" (no group) or "+" and the group


def sealed(text: Column) -> Column:
    """The 32 bytes of the sha256 of a text."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def digits(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_text(*values: Column) -> Column:
    """The values of a row one after the other: ``-`` for NULL, else number of bytes, ``:``, value."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(tree, doc_id, leaf, changed): the digest of each row, and that with the text ``tampered`` instead (or NULL)."""
    values = [F.col(c) for c in FIELDS]
    other = [tampered if c == "text" else F.col(c) for c in FIELDS]
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(
        F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col("lang"))).alias("tree"),
        "doc_id",
        sealed(leaf_text(*values)).alias("leaf"),
        F.when(marked, sealed(leaf_text(*other))).alias("changed"),
    )


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, their place in the order of their tree from 0 on, and ``n``, the size of the tree.

    Rows are sorted in ranges and numbered inside each; only one count per range and tree meets the others.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()), name)
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    counts = ranged.groupBy("tree", "part").agg(F.count("*").alias("own"), F.min("at").alias("low"))
    tree = Window.partitionBy("tree")
    before = F.sum("own").over(tree.orderBy("part")) - F.col("own")
    counts = counts.select("tree", "part", (before - F.col("low")).alias("shift"), F.sum("own").over(tree).alias("n"))
    joined = lookup_join(ranged, stored(counts, f"{name}-counts"), ["tree", "part"])
    return joined.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def slots(n: Column, level: int = 1) -> Column:
    """How many nodes ``n`` leaves make at a level."""
    for _ in range(level):
        n = F.floor((n + FANOUT - 1) / FANOUT)
    return n.cast("long")


def grouped(children: DataFrame, level: int) -> DataFrame:
    """The nodes of ``level`` over ``children`` (tree, pos, n, digest) that are not the last of their tree."""
    own = F.array_sort(F.collect_list(F.struct((F.col("pos") % FANOUT).alias("slot"), "digest")))
    nodes = children.filter("n > 1").groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("pos"))
    nodes = nodes.agg(own.alias("own"), slots(F.max("n")).alias("n"))
    line = F.array_join(F.transform("own", lambda c: digits(c["digest"])), "")
    nodes = nodes.select("tree", F.lit(level).alias("level"), "pos", "n", line.alias("line"))
    return nodes.withColumn("digest", sealed(F.col("line")))


def levels(children: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """One stored table of nodes per level, the lowest first; the largest tree has ``largest`` leaves."""
    out: list[DataFrame] = []
    while largest > 1:
        out.append(stored(grouped(out[-1] if out else children, len(out) + 1), f"{name}-level-{len(out) + 1}"))
        largest = -(-largest // FANOUT)
    return out


class Manifest(NamedTuple):
    """``runs``: the leaves of each lowest node (a lone leaf by itself); ``nodes``: all node rows with parent links.

    ``up_low`` says whether the parent is a node met by few leaves; ``low`` the same of the node itself.
    """

    runs: DataFrame
    nodes: DataFrame | None


UP = ("up_tree", "up_level", "up_pos", "up_slot", "up_low")


def linked(nodes: DataFrame, tops: DataFrame, many_subroots: bool, low_next: bool, low_top: bool) -> DataFrame:
    """Nodes of one level with the place of their parent, NULL for the root."""
    inner = nodes.filter("n > 1").select(
        "*",
        F.col("tree").alias("up_tree"),
        (F.col("level") + 1).alias("up_level"),
        F.floor(F.col("pos") / FANOUT).alias("up_pos"),
        (F.col("pos") % FANOUT).cast("int").alias("up_slot"),
        F.lit(low_next).alias("up_low"),
    )
    last = nodes.filter("n = 1")
    if many_subroots:
        last = lookup_join(last, tops, "tree").withColumn("up_low", F.lit(low_top))
    else:
        kinds = {f.name: f.dataType for f in inner.schema.fields}
        last = last.withColumns({c: F.lit(None).cast(kinds[c]) for c in UP[:-1]} | {"up_low": F.lit(False)})
    return inner.unionByName(last)


def build(docs: DataFrame, tampered: Column) -> Manifest | None:
    """The manifest of ``docs``; None for an empty table."""
    rows = placed(stored(leaves(docs, tampered), "merkle-leaves"), ["doc_id", "leaf"], "merkle-order")
    member = F.struct((F.col("pos") % FANOUT).alias("slot"), "doc_id", "leaf", "changed")
    runs = rows.groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("pos")).agg(
        F.array_sort(F.collect_list(member)).alias("members"), F.max("n").alias("size")
    )
    line = F.array_join(F.transform("members", lambda m: digits(m["leaf"])), "")
    lone = F.col("size") == 1
    runs = runs.select(
        "tree",
        "pos",
        "members",
        "size",
        line.alias("line"),
        F.when(lone, 0).otherwise(1).alias("level"),
        F.when(lone, F.lit(1)).otherwise(slots(F.col("size"))).cast("long").alias("n"),
        F.when(lone, F.col("members")[0]["leaf"]).otherwise(sealed(line)).alias("digest"),
    )
    runs = stored(runs, "merkle-runs")
    largest = runs.agg(F.max("size").alias("n")).first()["n"]
    if largest is None:
        return None

    first = runs.filter("level = 1").select("tree", "level", "pos", "n", "line", "digest")
    more = levels(first, -(-largest // FANOUT), "merkle-nodes")
    tables = ([first] if largest > 1 else []) + [t.withColumn("level", F.col("level") + 1) for t in more]

    subroots = runs.filter("level = 0").select("tree", "digest")
    for t in tables:
        subroots = subroots.unionByName(t.filter("n = 1").select("tree", "digest"))
    top = placed(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest"), ["of"], "merkle-subroots")
    n_top = top.agg(F.max("n").alias("n")).first()["n"]
    tops = top.select(
        F.col("of").alias("tree"),
        F.lit(TOP).alias("up_tree"),
        F.lit(1).alias("up_level"),
        F.floor(F.col("pos") / FANOUT).alias("up_pos"),
        (F.col("pos") % FANOUT).cast("int").alias("up_slot"),
    )
    over = levels(top, n_top, "merkle-top")

    # the nodes of a level and all above: beyond TOP_NODES they are joined by key
    sizes = [t.count() for t in (*tables, *over)]
    low = [sum(sizes[k:]) > TOP_NODES for k in range(len(sizes))] + [False]
    low_top = low[len(tables)]
    end = {"many_subroots": n_top > 1, "low_top": low_top}
    parts = []
    for k, t in enumerate(tables):
        parts.append(linked(t, tops, low_next=low[k + 1], **end).withColumn("low", F.lit(low[k])))
    for k, t in enumerate(over, len(tables)):
        parts.append(linked(t, tops, False, low[k + 1], False).withColumn("low", F.lit(low[k])))
    nodes = None
    for p in parts:
        nodes = p if nodes is None else nodes.unionByName(p)
    starts = linked(runs, tops, low_next=low[1] if tables else False, **end)
    return Manifest(stored(starts, "merkle-starts"), None if nodes is None else stored(nodes, "merkle-links"))


# One step: the node of the parent link gives the siblings left and right of the slot.
CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT * FROM {{start}}
  UNION ALL
  SELECT {{hint}}
    c.tree, c.pos,
    transform(c.folds, f -> unhex(sha2(concat(
      substring(m.line, 1, {DIGEST} * c.up_slot), lower(hex(f)), substring(m.line, {DIGEST} * c.up_slot + {DIGEST + 1})
    ), 256))),
    concat(c.siblings, unhex(concat(
      substring(m.line, 1, {DIGEST} * c.up_slot), substring(m.line, {DIGEST} * c.up_slot + {DIGEST + 1})
    ))),
    coalesce(c.subroot, CASE WHEN m.n = 1 THEN m.digest END),
    m.digest,
    m.up_tree, m.up_level, m.up_pos, m.up_slot, m.up_low
  FROM climb c JOIN {{nodes}} m ON c.up_tree = m.tree AND c.up_level = m.level AND c.up_pos = m.pos
  WHERE {{going}}
)
SELECT * FROM climb WHERE NOT ({{going}})
"""


@contextmanager
def unlimited_rows(spark: SparkSession):
    """Recursive queries stop at a number of rows that is meant for runaway recursion; the climb ends at the root."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def climbed(manifest: Manifest) -> DataFrame:
    """Every run at the root: (tree, pos, folds, siblings, subroot, root), stored."""
    spark = manifest.runs.sparkSession
    fold = F.transform(
        "members",
        lambda m: F.when(F.col("level") == 0, F.coalesce(m["changed"], m["leaf"])).otherwise(
            sealed(
                F.concat(
                    F.substring("line", F.lit(1), DIGEST * m["slot"]),
                    digits(F.coalesce(m["changed"], m["leaf"])),
                    F.substring("line", DIGEST * m["slot"] + DIGEST + 1, F.length("line")),
                )
            )
        ),
    )
    rows = manifest.runs.select(
        "tree",
        "pos",
        fold.alias("folds"),
        F.lit(b"").alias("siblings"),
        F.when(F.col("n") == 1, F.col("digest")).alias("subroot"),
        F.col("digest").alias("root"),
        *UP,
    )
    if manifest.nodes is None:
        return rows
    steps = (("low", "{c}up_low", ""), ("NOT low", "{c}up_tree IS NOT NULL", "/*+ BROADCAST(m) */"))
    for part, going, hint in steps:
        nodes = manifest.nodes.filter(part)
        if part == "low" and nodes.isEmpty():
            continue
        query = CLIMB.replace("{hint}", hint)
        query = query.replace("WHERE {going}\n", f"WHERE {going.format(c='c.')}\n").replace("{going}", going.format(c=""))
        with unlimited_rows(spark):
            rows = stored(spark.sql(query, start=rows, nodes=nodes), "merkle-climb")
    return rows


def verify(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Every row of ``docs`` (doc_id, source, lang, n_chars, text) with its leaf, proof and the root it leads to.

    Returns doc_id, leaf, subroot, root, proof_sha256 (all of the untampered table), folded_root and verified. A third of
    the rows, by the crc32 of the id, are climbed with the text ``tampered`` (by default the text with A-Z
    lowered), all others with their own. NULLs in any column are values of their own; the rows without a language have the
    first tree. Rows without an id come first in their tree and are never tampered with. Rows of one id stand
    in the order of their leaves; equal rows are leaves of their own, and only their proofs differ. An empty
    table has no rows. Other columns are not read.
    """
    tampered = lower_ascii(F.col("text")) if tampered is None else tampered
    manifest = build(docs, tampered)
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    if manifest is None:
        none = [F.lit(None).cast("string").alias(c) for c in names]
        return docs.select("doc_id", *none, F.lit(None).cast("boolean").alias("verified")).limit(0)
    known = manifest.runs.select("tree", "pos", "members", "line")
    rows = known.join(climbed(manifest).drop(*UP), ["tree", "pos"])
    rows = rows.select("*", F.posexplode("members").alias("at", "m"))
    own = F.concat(
        F.substring("line", F.lit(1), DIGEST * F.col("at")),
        F.substring("line", DIGEST * F.col("at") + DIGEST + 1, F.length("line")),
    )
    fold = F.get("folds", F.col("at"))
    return rows.select(
        F.col("m.doc_id").alias("doc_id"),
        digits(F.col("m.leaf")).alias("leaf"),
        digits(F.col("subroot")).alias("subroot"),
        digits(F.col("root")).alias("root"),
        F.sha2(F.concat(own, digits(F.col("siblings"))).cast("binary"), 256).alias("proof_sha256"),
        digits(fold).alias("folded_root"),
        (fold == F.col("root")).alias("verified"),
    )
