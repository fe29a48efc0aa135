"""Operator 12: a Merkle manifest of ``documents``, with proofs and a tamper test.

A row's leaf is the SHA-256 of its fields, each written as ``-`` (null) or
byte count, ``:``, value. Per source the leaves ascend by doc_id; runs of
``ARITY`` consecutive nodes are hashed to one until one is left, the subroot;
the subroots, by source, are hashed to the root in the same way.

Levels are strings: nodes are dealt into aligned blocks of ``ARITY ** LEVELS``
places, and a block keeps each of its levels as one string of 64 hex digits a
node. SQL substrings of one run's width are hashed to the parents, and the
substrings on either side of a node are its siblings. The blocks' roots are
the nodes of the next tier, which is cut into blocks likewise, until every
source has one node; the paths of the upper tiers are joined down to the
blocks by (source, block). A block holds ``ARITY ** LEVELS`` rows whatever the
size of its source.

Places come from one range-partitioned sort by source and doc_id: a row's
partition and line there are written with its leaf, and the counts per
(partition, source) give every source's offset, so that no source meets in one
task. All tiers are written tables in the shared folder.

Defined cases: rows without doc_id come first in their source and are never
tampered with; rows of one doc_id go by their leaf, so that repeated rows take
consecutive places, each with its own proof; null texts and empty texts make
different leaves; a null source is a source of its own and comes first; an
empty table has an empty result; the proof of a lone row hashes the empty
string. Columns other than doc_id, source, lang, n_chars and text are never
read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slotwise.llm.common import let, written

ARITY = 3
LEVELS = 5  #: levels of one block: 243 places, strings of 15,552 digits
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LINE_BITS = 33  #: of monotonically_increasing_id: the line within a partition


def leaf(*values: Column) -> Column:
    """SHA-256 of the fields, each with its length."""
    def field(v):
        text = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)), 256)


def node(level: Column, i: Column | int, n: Column | int) -> Column:
    """``n`` nodes of a level from the ``i``-th on (from 0); fewer at its end, none beyond."""
    return F.substring(level, F.lit(i) * HEX + 1, F.greatest(F.lit(n), F.lit(0)) * HEX)


def parents(level: Column) -> Column:
    """The next level: every run of ``ARITY`` nodes hashed, a short last run too."""
    last = F.floor((F.length(level) / HEX - 1) / ARITY).cast("int")
    hashed = F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(node(level, i * ARITY, ARITY), 256))
    return F.array_join(hashed, "")


def levels(leaves: Column, depth: Column) -> Column:
    """The block's levels, leaves first; ``depth`` of them are hashed."""
    upper = lambda got, _: F.concat(got, F.array(parents(F.element_at(got, -1))))
    return F.when(depth <= 0, F.array(leaves)).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), F.array(leaves), upper))


def siblings(lv: Column, place: Column) -> Column:
    """Per level the other nodes of the run, left and right of the node at ``place``."""
    def beside(level, k):
        at = F.floor(place / F.pow(F.lit(ARITY), k)).cast("int")
        in_run = at % ARITY
        return F.struct(node(level, at - in_run, in_run).alias("l"), node(level, at + 1, ARITY - 1 - in_run).alias("r"))

    hashed = F.slice(lv, F.lit(1), F.size(lv) - 1)
    return F.transform(hashed, beside)


def fold(start: Column, path: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(s["l"], acc, s["r"]), 256))


def segments(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), "")


PATH = "array<struct<l:string,r:string>>"


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (tree, ...) with each one's ``place`` in its tree under ``order``, and the tree's size ``n``.

    The sorted rows are written with their partition and line; the offsets are
    sums over partitions, one row per partition that a tree touches.
    """
    line = F.monotonically_increasing_id().alias("line")
    tie = nodes.withColumn("tie", F.monotonically_increasing_id())  # spreads repeated rows over partitions
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order, "tie")]
    table = written(tie.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie").select("*", line), "placed")
    part = F.shiftrightunsigned("line", LINE_BITS)
    starts = table.groupBy(F.col("tree").alias("of"), part.alias("part")).agg(F.min("line").alias("first"), F.count("*").alias("rows"))
    tree = W.partitionBy("of")
    starts = starts.select("of", "part", "first", (F.sum("rows").over(tree.orderBy("part")) - F.col("rows")).alias("before"), F.sum("rows").over(tree).alias("n"))
    place = (F.col("before") + F.col("line") - F.col("first")).alias("place")
    met = table.join(starts, F.col("tree").eqNullSafe(F.col("of")) & (part == F.col("part")))
    return met.select(*nodes.columns, place, "n")


def _blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """tree, block, n (blocks of the tree), lv, rows (place in the block and the ``carried`` columns) from placed nodes."""
    width = ARITY**LEVELS
    row = F.struct((F.col("place") % width).cast("int").alias("at"), "hash", *carried)
    block = F.floor(F.col("place") / width).alias("block")
    grouped = nodes.groupBy("tree", block).agg(F.sort_array(F.collect_list(row)).alias("rows"), F.first("n").alias("n"))
    # A tree of one block is hashed until one node is left, a larger one to the block's top.
    depth = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        depth = F.when(F.col("n") <= ARITY**k, F.lit(k)).otherwise(depth)
    lv = levels(F.array_join(F.col("rows")["hash"], ""), F.col("depth"))
    return written(
        grouped.withColumn("depth", depth).select("tree", "block", F.ceil(F.col("n") / width).alias("n"), lv.alias("lv"), "rows"), "blocks")


def _paths_below(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """tree, block, path and what else ``above`` holds per tree: a tier's nodes, the blocks of the tier below, with their way up."""
    width = ARITY**LEVELS
    kept = [c for c in above.columns if c not in ("tree", "block", "path")]
    each = F.transform("rows", lambda r: F.struct(
        (F.col("block") * width + r["at"]).alias("block"), F.concat(siblings(F.col("lv"), r["at"]), F.col("path")).alias("path")))
    return _joined(blocks, above).select("tree", *kept, F.inline(each))


def _joined(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with the path of their root and what else ``above`` holds."""
    above = above.withColumnsRenamed({"tree": "of", "block": "node"})
    return blocks.join(above, F.col("tree").eqNullSafe(F.col("of")) & (F.col("block") == F.col("node"))).drop("of", "node")


def _tiers(nodes: DataFrame, carried: list[str]) -> list[DataFrame]:
    """Block tables of all tiers over placed ``nodes`` (tree, place, n, hash, carried columns), lowest first."""
    tiers = [_blocks(nodes, carried)]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > 1:
        top = F.element_at("lv", -1)
        tiers.append(_blocks(tiers[-1].select("tree", F.col("block").alias("place"), "n", top.alias("hash")), []))
    return tiers


def _walk(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The paths of the lowest tier's block roots, from those of the trees' roots."""
    for tier in reversed(tiers[1:]):
        above = _paths_below(tier, above)
    return above


def manifest(docs: DataFrame, tampered_text: Column, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, proof_sha256, folded_root and verified per row.

    Where ``tampered`` holds, ``folded_root`` starts from the leaf of the row with ``tampered_text``;
    ``proof`` lists the siblings as (left, right) hex strings, leaf level first.
    """
    spark = docs.sparkSession
    fields = [F.col(f"`{c}`") for c in FIELDS]
    other = F.when(tampered & ~tampered_text.eqNullSafe(fields[-1]), leaf(*fields[:-1], tampered_text))
    rows = docs.select(F.col("source").alias("tree"), F.col("doc_id").alias("id"), leaf(*fields).alias("hash"), other.alias("other"))
    tiers = _tiers(_placed(rows, ["id", "hash"]), ["id", "other"])

    subroots = tiers[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("source"), F.element_at("lv", -1).alias("hash"))
    top = _tiers(_placed(subroots, ["source"]), ["source"])
    found = top[-1].select(F.element_at("lv", -1)).first()
    if found is None:
        return spark.createDataFrame([], f"doc_id {rows.schema['id'].dataType.simpleString()}, leaf string, subroot string, root string, "
                                         f"proof {PATH}, proof_sha256 string, folded_root string, verified boolean")
    above = _walk(top, top[-1].select("tree", "block", F.expr(f"CAST(array() AS {PATH})").alias("path")))
    of_source = F.transform("rows", lambda r: F.struct(
        r["source"].alias("tree"), F.lit(0).cast("long").alias("block"), r["hash"].alias("subroot"),
        F.concat(siblings(F.col("lv"), r["at"]), F.col("path")).alias("path")))
    per_source = written(_joined(top[0], above).select(F.inline(of_source)), "subroots")

    whole = _joined(tiers[0], _walk(tiers, per_source)).withColumn("text", segments(F.col("path")))

    def row(r):
        return let(siblings(F.col("lv"), r["at"]), lambda own: let(F.concat(own, F.col("path")), lambda path: F.struct(
            r["id"].alias("doc_id"), r["hash"].alias("leaf"), path.alias("proof"),
            F.sha2(F.concat(segments(own), F.col("text")), 256).alias("proof_sha256"),
            fold(F.coalesce(r["other"], r["hash"]), path).alias("folded_root"))))

    out = whole.select("subroot", F.lit(found[0]).alias("root"), F.inline(F.transform("rows", row)))
    return out.select("doc_id", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
