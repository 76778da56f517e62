"""Merkle manifest of a dataset: leaves, group trees under one root, and a proof for every leaf.

Every group of rows has a tree of its own whose subroot is a leaf of the tree of groups. Runs of `ARITY` consecutive nodes
become one node, the last run may be shorter. Proofs come from pointer jumping: a node first knows the siblings on its way to its
parent; a self-join appends what its ancestor knows and doubles the distance, until every leaf knows the way to the root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.llm.ordering import numbered
from sundial.llm.shared import discard, saved

ARITY = 3
#: Ancestors are broadcast if all that a jump can reach take fewer bytes, by the sizes of the trees.
BROADCAST_BYTES = 32_000_000
HEX = 64
TOP = -1


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*values), 256)


def field(value: Column) -> Column:
    """A value that cannot run into the next one: byte count, colon, value; null is a dash."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def folded(start: Column, path: Column) -> Column:
    """The digest that a leaf and the siblings on its way lead to."""

    def up(own: Column, step: Column) -> Column:
        others, cut = _hex(step["others"]), step["slot"] * HEX
        return digest(F.substring(others, F.lit(1), cut), own, F.substring(others, cut + 1, F.lit(HEX * ARITY)))

    return F.aggregate(path, start, up)


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf up and left to right."""
    return F.sha2(F.aggregate(path, F.lit(""), lambda text, step: F.concat(text, _hex(step["others"]))), 256)


def _height(nodes: int) -> int:
    height = 0
    while nodes > 1:
        nodes, height = -(-nodes // ARITY), height + 1
    return height


@dataclass
class Manifest:
    """`root` (null without rows) and one row per leaf: `row` (the kept columns), leaf, given, path, subroot.

    `path` lists for every level the place of the node in its run (slot) and the raw digests of the others there.
    """

    root: str | None
    proofs: DataFrame


def _runs(nodes: DataFrame) -> DataFrame:
    """Runs of siblings: a row per parent with its children in order; written, as both the tree and the proofs read it."""
    child = F.struct((F.col("at") % ARITY).cast("int").alias("slot"), "digest", "tree", "level", F.col("at").alias("own"), "row", "given", "sub")
    n = F.ceil(F.col("n") / ARITY).alias("n")
    up = F.expr(f"at DIV {ARITY}").alias("up")
    return saved(nodes.groupBy("top", F.when(F.col("top"), TOP).otherwise(F.col("tree")).alias("under"), "step", up, n).agg(
        F.sort_array(F.collect_list(child)).alias("children")), "runs")


def _parents(runs: DataFrame) -> DataFrame:
    """The parents as nodes one step further up."""
    texts = F.transform("children", lambda c: _hex(c["digest"]))
    return runs.select("top", F.col("under").alias("tree"), (F.col("step") + 1).alias("level"), (F.col("step") + 1).alias("step"), F.col("up").alias("at"), "n",
                       F.unhex(F.sha2(F.array_join(texts, ""), 256)).alias("digest"), F.lit(None).cast(runs.schema["children"].dataType.elementType["row"].dataType).alias("row"),
                       F.lit(None).cast("binary").alias("given"), F.lit(None).cast("binary").alias("sub"))


def _edges(runs: DataFrame, last: bool) -> DataFrame:
    """Every child with its parent and the way there; the parent is null where it is the root."""
    child = F.explode("children").alias("c")
    rows = runs.select("top", "under", "step", "up", "n", "children", child)
    others = F.expr("aggregate(filter(children, x -> x.slot <> c.slot), CAST('' AS BINARY), (a, x) -> concat(a, x.digest))")
    at_root = (F.col("n") == 1) & F.lit(last)
    parent = [F.when(~at_root, c).alias(f"to_{name}") for name, c in (("tree", F.col("under").cast("long")), ("level", F.col("step") + 1), ("at", F.col("up")))]
    return rows.select("top", F.col("c.tree").alias("tree"), F.col("c.level").alias("level"), F.col("c.own").alias("at"), *parent,
                       F.array(F.struct(F.col("c.slot").alias("slot"), others.alias("others"))).alias("path"), F.col("c.digest").alias("digest"), F.col("c.row").alias("row"),
                       F.col("c.given").alias("given"), F.col("c.sub").alias("sub"))


def _climb(nodes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """Runs of all levels, and the nodes that are alone on their level."""
    runs, alone = [], nodes.where("n = 1")
    for _ in range(height):
        runs.append(_runs(nodes.where("n > 1")))
        nodes = _parents(runs[-1])
        alone = alone.unionByName(nodes.where("n = 1"))
    return runs, alone


KEY = ["tree", "level", "at"]


def _jumped(edges: DataFrame, distance: int, last: bool, broadcast: bool) -> DataFrame:
    """One doubling. Kept are the nodes that later jumps start from or land on; in the last round the leaves."""
    useful = F.col("row").isNotNull() if last else F.col("top") | (F.col("level") % (2 * distance) == 0)
    kept = edges.where(useful)
    there = edges.where(F.col("top") | (F.col("level") >= distance)).select(
        *[F.col(k).alias(f"there_{k}") for k in KEY], *[F.col(f"to_{k}").alias(f"next_{k}") for k in KEY], F.col("path").alias("further"), F.col("sub").alias("there_sub"))
    if broadcast:
        there = F.broadcast(there)
    same = [F.col(f"to_{k}") == F.col(f"there_{k}") for k in KEY]
    moved = kept.where("to_tree IS NOT NULL").join(there, same).select(
        "top", *KEY, *[F.col(f"next_{k}").alias(f"to_{k}") for k in KEY], F.concat("path", "further").alias("path"), "digest", "row", "given",
        F.coalesce("sub", "there_sub").alias("sub"))
    return saved(moved.unionByName(kept.where("to_tree IS NULL")), "jumped")


def manifest(docs: DataFrame, group: str, order: str, own: Column, given: Column | None = None, keep: list[str] | None = None) -> Manifest:
    """Digests and proofs of all rows of a table.

    `own` is the leaf digest (hex). `given` is another one to be held against the root, null where there is none. Groups are
    ordered by their text with null first, leaves of a group by `order` with null first, then by digest, so repeated rows are leaves
    of their own and exchangeable. Other columns than `keep` (default: `order`; no maps) are not read and kept ones come back in a
    struct, so no name can clash. A null or empty text is whatever `own` makes of it. An empty table has no root and no rows.

    All digests stay on executors; the driver sees the root and three counts. A run has at most three rows. In a jump over distance d
    at most 3^d rows meet at one ancestor, or the ancestors are few enough to be broadcast.
    """
    keep = keep or [order]
    given = F.unhex(given) if given is not None else F.lit(None).cast("binary")
    rows = docs.select(F.col(group).alias("__group"), F.col(order).alias("__order"), F.unhex(own).alias("digest"), given.alias("given"), F.struct(*keep).alias("row"))
    placed = saved(numbered(rows, "__group", [F.col("__order").asc_nulls_first(), F.col("digest")],
                            per_group=lambda groups: numbered(groups.select(F.col("__g").alias("__source")), None, [F.col("__source").asc_nulls_first()])
                            .select(F.col("__source").alias("__g"), F.col("__at").alias("__tree"))), "placed")
    most, total, groups = placed.agg(F.max("__n"), F.count("*"), F.max("__tree") + 1).first()
    if not total:
        none = placed.select("row", F.lit("").alias("leaf"), F.lit("").alias("given"), F.array(F.struct(F.lit(0).alias("slot"), F.lit(b"").alias("others"))).alias("path"), F.lit("").alias("subroot"))
        return Manifest(None, none)
    nothing = F.lit(None).cast("binary")
    leaves = placed.select(F.lit(False).alias("top"), F.col("__tree").alias("tree"), F.lit(0).alias("level"), F.lit(0).alias("step"), F.col("__at").alias("at"),
                           F.col("__n").alias("n"), "digest", "row", "given", nothing.alias("sub"))
    runs, subroots = _climb(leaves, _height(most))
    # a subroot keeps its own name (tree, level) as a child of the tree of groups
    upper = saved(subroots.select(F.lit(True).alias("top"), "tree", "level", F.lit(0).alias("step"), F.col("tree").alias("at"), F.lit(groups).cast("long").alias("n"), "digest", "row", "given",
                                  F.col("digest").alias("sub")), "subroots")
    upper_runs, roots = _climb(upper, _height(groups))
    top = roots.select("digest").first()[0]
    edges = [_edges(r, groups == 1) for r in runs] + [_upper_edges(r) for r in upper_runs]
    path_type = "array<struct<slot:int,others:binary>>"
    if not edges:  # one row in all
        lone = upper.select("row", "digest", "given", F.array().cast(path_type).alias("path"), F.col("digest").alias("sub"))
    else:
        lone = edges[0]
        for e in edges[1:]:
            lone = lone.unionByName(e)
        longest, distance, before = _height(most) + _height(groups), 1, None
        if longest == 1:
            lone = lone.where("row IS NOT NULL")
        while distance < longest:
            reached = 2 * total // ARITY ** distance + 2 * groups
            fits = reached * (distance * (HEX + 24) + 100) < BROADCAST_BYTES
            after = _jumped(lone, distance, 2 * distance >= longest, fits)
            if before is not None:
                discard(before)
            lone, before, distance = after, after, 2 * distance
    proofs = lone.select("row", _hex(F.col("digest")).alias("leaf"), _hex(F.col("given")).alias("given"), "path",
                         _hex(F.coalesce("sub", F.lit(bytes(top)))).alias("subroot"))
    return Manifest(bytes(top).hex(), proofs)


def _upper_edges(runs: DataFrame) -> DataFrame:
    """Edges of the tree of groups; a subroot is named as the end of its own tree."""
    first = _edges(runs, True)
    return first.withColumn("at", F.when(F.col("tree") == TOP, F.col("at")).otherwise(F.lit(0).cast("long")))


def verified(found: Manifest) -> DataFrame:
    """Kept columns with leaf, subroot, root, proof_sha256, folded_root (from the given leaf, else the own one) and verified."""
    proofs = found.proofs.withColumn("__folded", folded(F.coalesce("given", "leaf"), F.col("path")))
    root = F.lit(found.root).cast("string")
    return proofs.select("row.*", "leaf", "subroot", root.alias("root"), siblings_digest(F.col("path")).alias("proof_sha256"),
                         F.col("__folded").alias("folded_root"), (F.col("__folded") == root).alias("verified"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered(doc_id: str = "doc_id") -> Column:
    """The rows whose text is altered before verification; never one without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 2 == 0, F.lit(False))


def report(documents: DataFrame) -> DataFrame:
    """The manifest of documents by source, and proofs of texts that have lost their line ends where `tampered` says so."""
    columns = [F.col(c) for c in FIELDS]
    altered = leaf(*columns[:-1], F.translate("text", "\n", ""))
    return verified(manifest(documents, "source", "doc_id", leaf(*columns), F.when(tampered(), altered)))
