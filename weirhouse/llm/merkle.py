"""Merkle manifest of a dataset: a hash tree per group of rows, and one over the groups.

A leaf is the hash of a row's fields; every ``arity`` consecutive nodes become one of the next
level, and a node left over alone is hashed too.  Groups' trees hang under one root in the order
of the groups.  Each aligned block of ``arity ** DEPTH`` nodes is one row that keeps every level of its part
of the tree as one hex text (in a binary column, where a substring costs no scan): parents are
hashes of fixed-width substrings, and a node's siblings on a level are the substrings that flank
it.  Blocks' tops are the nodes of the next round, until each group has one block; proofs are put
together on the way back, block rows joined with the proofs of their tops.

Digests are text: lowercase hex sha256 over inputs written one after the other.  A field is ``-``
where null, else its length in UTF-8 bytes, a colon, and its text.

Within a group leaves ascend by ``doc_id``, null ids first, ties by leaf; equal rows are leaves
each.  The null group comes first, then groups by UTF-8 bytes; an empty text is a value like others.  A
lone leaf is its group's root, a lone group's root is the whole one's, then the proof is empty.
Texts of any length are hashed in one expression and not carried further.  An empty table gives
no rows.  Only the named columns are looked at, so others may have any name.

Skew: leaves are dealt by ranges (``ranked.positions``) and blocks by number, so no task holds a
group; all steps are DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirhouse.llm.common import write_once
from weirhouse.llm.ranked import positions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
DEPTH = 8
WIDTH = 64  # characters of a digest


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[str] = FIELDS, **other: Column) -> Column:
    """A row's leaf; ``other`` gives values in place of columns."""
    return F.sha2(F.concat(*[field(other.get(f, F.col(f"`{f}`"))) for f in fields]), 256)


def _parents(level: Column, arity: int) -> Column:
    run = F.lit(WIDTH * arity)
    hashed = F.transform(F.sequence(F.lit(1), F.length(level), run), lambda at: F.sha2(F.substring(level, at, run), 256))
    return F.array_join(hashed, "").cast("binary")


def _levels(first: Column, whole: Column, arity: int, depth: int) -> Column:
    """All levels of a block: up to one node where it is the whole group, else ``depth`` more."""

    def add(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, -1)
        done = whole & (F.length(top) <= WIDTH)
        return F.when(done, levels).otherwise(F.concat(levels, F.array(_parents(top, arity))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(first), add)


def _blocks(nodes: DataFrame, arity: int, depth: int) -> DataFrame:
    """(grp, block, total, members, levels) of (grp, pos, total, node, ...)."""
    size = arity**depth
    kept = [c for c in nodes.columns if c not in ("grp", "total", "pos")]
    placed = nodes.withColumn("block", F.floor(F.col("pos") / size))
    grouped = placed.groupBy("grp", "block", "total").agg(F.sort_array(F.collect_list(F.struct("pos", *kept))).alias("members"))
    first = F.array_join(F.transform("members", lambda m: m["node"]), "").cast("binary")
    levels = _levels(F.col("first"), F.col("total") <= size, arity, depth)
    return grouped.withColumn("first", first).select("grp", "block", "total", "members", levels.alias("levels"))


def grow(nodes: DataFrame, arity: int = ARITY, depth: int = DEPTH) -> list[DataFrame]:
    """Rounds of blocks, written to the shared folder, until each group has one."""
    rounds = [write_once(_blocks(nodes, arity, depth), "merkle-blocks")]
    while not rounds[-1].where("block > 0").isEmpty():
        total = F.ceil(F.col("total") / arity**depth)
        tops = rounds[-1].select("grp", F.col("block").alias("pos"), total.alias("total"), _top().alias("node"))
        rounds.append(write_once(_blocks(tops, arity, depth), "merkle-blocks"))
    return rounds


def _top() -> Column:
    return F.element_at("levels", -1).cast("string")


def _flanks(pos: Column, arity: int, depth: int) -> Column:
    """What stands left and right of a node's ancestors in their runs, level by level."""
    powers, width = F.array(*[F.lit(arity**j) for j in range(depth + 1)]), F.lit(WIDTH)

    def of_level(level: Column, j: Column) -> Column:
        at = F.floor(F.pmod(pos, F.lit(arity**depth)) / F.element_at(powers, j + 1)).cast("int")
        left = at % arity
        return F.struct(
            F.substring(level, (at - left) * width + 1, left * width).alias("left"),
            F.substring(level, (at + 1) * width + 1, (arity - 1 - left) * width).alias("right"),
        )

    return F.transform(F.slice("levels", F.lit(1), F.size("levels") - 1), of_level)


def prove(rounds: Sequence[DataFrame], tops: DataFrame, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """Each node of the first round with its proof, from (grp, proof, ...) of the groups' roots."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for n, blocks in reversed(list(enumerate(rounds))):
        carried = [c for c in above.columns if c not in ("grp", "block", "proof")]
        names = [f.name for f in blocks.schema["members"].dataType.elementType.fields]
        proof = lambda m: F.concat(_flanks(m["pos"], arity, depth), F.col("proof"))
        proved = F.transform("members", lambda m: F.struct(*[m[c].alias(c) for c in names], proof(m).alias("proof")))
        joined = blocks.join(above, ["grp", "block"]).select("grp", *carried, proved.alias("members"))
        above = joined.select("grp", *carried, F.inline("members"))
        if n:
            above = above.drop("node").withColumnRenamed("pos", "block")
    return above


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    step = lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256).cast("binary")
    return F.aggregate(proof, start.cast("binary"), step).cast("string")


def proof_digest(proof: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    texts = F.transform(proof, lambda s: F.concat(s["left"], s["right"]).cast("string"))
    return F.sha2(F.array_join(texts, ""), 256)


def manifest(
    docs: DataFrame,
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    carry: Mapping[str, Column] | None = None,
    arity: int = ARITY,
    depth: int = DEPTH,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof) of every row, and the columns ``carry`` makes of it.

    ``proof`` holds, from the leaf up, the siblings left and right of each ancestor as hex text;
    ``fold`` leads from the leaf over it to ``root``.  ``depth`` only sets how much one row holds."""
    grp = F.coalesce(F.concat(F.lit("v"), F.col(f"`{group}`").cast("string")), F.lit(""))
    more = {f"carried_{k}": v for k, v in (carry or {}).items()}
    leaves = docs.select(grp.alias("grp"), F.col("doc_id"), leaf(fields).alias("node"), *[v.alias(k) for k, v in more.items()])
    rounds = grow(positions(leaves, ["grp"], [F.col("doc_id").asc_nulls_first(), F.col("node")], "merkle-leaves"), arity, depth)
    subroots = rounds[-1].select(F.col("grp").alias("key"), _top().alias("node"))
    upper = grow(positions(subroots.withColumn("grp", F.lit("")), ["grp"], [F.col("key")], "merkle-groups"), arity, depth)
    nothing = F.array().cast("array<struct<left:binary,right:binary>>")
    root = upper[-1].select("grp", nothing.alias("proof"), _top().alias("root"))
    tops = prove(upper, root, arity, depth).select(F.col("key").alias("grp"), F.col("node").alias("subroot"), "root", "proof")
    rows = prove(rounds, tops, arity, depth)
    return rows.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", "proof", *[F.col(k).alias(k.removeprefix("carried_")) for k in more])
