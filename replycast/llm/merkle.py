"""Merkle manifest of a data set, and versions of it that share all but the changed nodes.

A row is a leaf: the SHA-256 of its fields. The leaves of a source ascend by id, and every `FANOUT` nodes in
a row become one until one is left, the source's subroot; the subroots, by source, likewise give the root.

A null source is a source of its own and comes first; a null id comes before the others; a null field is
told from an empty one. Rows with the same id follow each other by their leaves, and repeated rows are
leaves of their own. Very long texts count whole and never leave the JVM. An empty table gives an empty
result. Other columns may have any names.

Trees are built bottom up in aligned blocks of `FANOUT` ** `LEVELS` nodes, each one group of one task: a
block becomes one node of the next round, so every round has a 4,096th of the nodes of the one before, and
a hot source has as many blocks as it needs. Then the nodes beside each block's ancestors go down the
rounds to the leaves. A changed leaf makes a version: new copies of its ancestors inside its block, then of
those above it, on the digests that came down; all other nodes are those of the first version, and
versions do not see each other.
"""

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from .common import saved, travels
from .ordering import placed

travels(__name__)

FANOUT = 16
#: Levels of a block.
LEVELS = 3
BLOCK = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: What stands beside a node on the way up: the digests left and right of it in its run.
STEPS = "steps array<struct<left string, right string>>"


def node(digests):
    """Digest of a run of nodes, given as one text or several."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def leaf(columns):
    """Digest of a row's fields: `-` for a null, else the number of bytes, a colon and the value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        field = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(field, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def levels_of(block, digests):
    """Nodes of a block, level by level, up to its one node.

    A tree of one block ends where one node is left. Any other block is full or has one before it, and ends
    at `LEVELS`, where its node has others beside it.
    """
    levels = [digests]
    while len(levels) <= LEVELS and (block > 0 or len(levels[-1]) > 1):
        last = levels[-1]
        levels.append([node(last[i : i + FANOUT]) for i in range(0, len(last), FANOUT)])
    return levels


def steps_of(levels, place):
    """What stands beside a leaf and its ancestors, inside the block."""
    steps = []
    for nodes in levels[:-1]:
        run = place - place % FANOUT
        steps.append(
            {"left": "".join(nodes[run:place]), "right": "".join(nodes[place + 1 : run + FANOUT])}
        )
        place //= FANOUT
    return steps


def copied(changed, steps):
    """A version's copies of a leaf's ancestors, upwards, made of the changed leaf and shared nodes."""
    copies = []
    for step in steps:
        changed = node((step["left"], changed, step["right"]))
        copies.append(changed)
    return copies


def _digests(table):
    return table.sort_by("position")["digest"].to_pylist()


def _in_blocks(rows):
    return rows.withColumn("block", F.floor(F.col("position") / BLOCK)).groupBy("tree", "block")


def _raised(rows):
    """One node for each block of `rows` (tree, position, digest): the rows of the next round."""

    def raise_block(key, table):
        top = levels_of(key[1].as_py(), _digests(table))[-1][0]
        return pa.table({"tree": [key[0].as_py()], "position": [key[1].as_py()], "digest": [top]})

    return saved(_in_blocks(rows).applyInArrow(raise_block, "tree string, position long, digest string"))


def _rounds(rows):
    """Rows of each round up to the one that has one node for each tree."""
    rounds = [rows]
    while True:
        rounds.append(_raised(rounds[-1].select("tree", "position", "digest")))
        if rounds[-1].filter("position > 0").isEmpty():
            return rounds


def _with_steps(rows, above):
    """Of each row (tree, position, digest) what stands beside its ancestors; `above` has that of the blocks."""

    def step_down(key, table, top):
        levels = levels_of(key[1].as_py(), _digests(table))
        upper = top["steps"][0].as_py()
        table = table.sort_by("position").select(["tree", "position"])
        steps = [steps_of(levels, i) + upper for i in range(table.num_rows)]
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return table.append_column("steps", pa.array(steps, kind))

    blocks = above.withColumnRenamed("position", "block").groupBy("tree", "block")
    schema = f"tree string, position long, {STEPS}"
    return _in_blocks(rows.select("tree", "position", "digest")).cogroup(blocks).applyInArrow(step_down, schema)


def _down(rounds, above):
    """Steps of the blocks of the first round."""
    for rows in reversed(rounds[1:-1]):
        above = saved(_with_steps(rows, above))
    return above


def tree_of(source):
    """Name of a source's tree; that of a null comes first, the others in the order of their bytes."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def manifest(docs, fields=FIELDS, id_col="doc_id", source_col="source", changed=None):
    """One row for each row of `docs`: its place in the trees and, if it is changed, its version.

    `changed` is a condition and a dictionary with new values of fields, as columns of `docs`.
    Returns `doc_id`, `source`, `position` in the source, `leaf`, `subroot`, `root`, `proof` (the digests
    beside the leaf and its ancestors, upwards, from left to right, 64 characters each), `copies` (the nodes
    that the row's version copies, upwards; null if nothing changed) and `folded_root`: the root that the
    changed leaf, or else the leaf itself, gives with those digests.
    """
    condition, values = changed or (F.lit(False), {})
    new = [values.get(f, F.col(f)) for f in fields]
    leaves = docs.select(
        F.col(id_col).alias("doc_id"),
        tree_of(F.col(source_col)).alias("tree"),
        leaf([F.col(f) for f in fields]).alias("digest"),
        F.when(condition, leaf(new)).alias("changed"),
    )
    leaves = placed(saved(leaves), [F.col("doc_id").asc_nulls_first(), "digest"], ["tree"], name="position")
    sources = _rounds(saved(leaves))
    subroots = sources[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    tops = _rounds(saved(placed(subroots, ["of"], ["tree"], name="position")))

    root = tops[-1].select("tree", "position", F.array().cast(STEPS[6:]).alias("steps"))
    beside = _with_steps(tops[0], _down(tops, root))
    subroots = tops[0].join(beside, ["tree", "position"]).select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("position"), "steps"
    )
    root_digest = tops[-1].select("digest").first()
    root_digest = root_digest and root_digest[0]

    def finish(key, table, top):
        if not top.num_rows:
            raise ValueError(f"block without a way up: {key}")
        table = table.sort_by("position")
        levels = levels_of(key[1].as_py(), table["digest"].to_pylist())
        upper, n_upper = top["steps"][0].as_py(), top["depth"][0].as_py()
        proofs, copies, folded = [], [], []
        for place, (old, new) in enumerate(zip(levels[0], table["changed"].to_pylist())):
            steps = steps_of(levels, place) + upper
            proofs.append("".join(side for step in steps for side in (step["left"], step["right"])))
            way = copied(new or old, steps)
            folded.append(way[-1] if way else new or old)
            copies.append(None if new is None else way)
        # the source's own node: where its tree ends, before the steps among the subroots
        subroot = copied(levels[-1][0], upper[:n_upper])[-1:] or [levels[-1][0]]
        return pa.table(
            {
                "doc_id": table["doc_id"].cast(pa.int64()),
                "tree": table["tree"],
                "position": table["position"],
                "leaf": table["digest"],
                "subroot": pa.array(subroot * table.num_rows, pa.string()),
                "proof": pa.array(proofs, pa.string()),
                "copies": pa.array(copies, pa.list_(pa.string())),
                "folded_root": pa.array(folded, pa.string()),
            }
        )

    # steps of a block's node, and how many of them lie inside its source
    in_top = subroots.select("tree", F.size("steps").alias("n_top"))
    blocks = _down(sources, subroots).join(in_top, "tree")
    blocks = blocks.withColumn("depth", F.size("steps") - F.col("n_top"))
    blocks = blocks.select("tree", F.col("position").alias("block"), "steps", "depth")
    schema = (
        "doc_id long, tree string, position long, leaf string, subroot string, proof string,"
        " copies array<string>, folded_root string"
    )
    finished = _in_blocks(sources[0]).cogroup(blocks.groupBy("tree", "block")).applyInArrow(finish, schema)
    return finished.select(
        "doc_id",
        F.when(F.col("tree") != "", F.substr("tree", F.lit(2))).alias("source"),
        "position",
        "leaf",
        "subroot",
        F.lit(root_digest).cast("string").alias("root"),
        "proof",
        "copies",
        "folded_root",
    )


def lower_cased(text_col="text", id_col="doc_id", of=5):
    """`changed` for `manifest`: the text's A-Z in lower case, where `of` divides the CRC-32 of the id."""
    chosen = F.crc32(F.col(id_col).cast("string")) % of == 0
    return chosen, {text_col: F.translate(text_col, UPPER, LOWER)}
