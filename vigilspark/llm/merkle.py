"""Merkle manifest of a dataset: leaves placed by bitmap ranks, trees reduced through keyed slot arrays.

A group's doc_ids are a bitmap, kept as its words of 64 bits that are not empty, with a directory that counts what lies before
each word. An id's place among its group's leaves is its rank: the directory's count and the bits below it in its word, so
leaves are never sorted. The place is the leaf's key in the tree: leaves of one block of places meet in an array with a slot
for each, which is reduced by many levels at once, and the blocks' nodes are the leaves of the next round. On the way down
every slot learns its siblings.

A path is a sequence of levels, from the leaf up: a byte that says whether the sibling is left, right or missing, and the
sibling's digest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, running

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Bits of a bitmap word, as a power of two, and levels that one block reduces: it has 2 ** LEVELS slots.
WORD_BITS, LEVELS = 6, 10
NONE, LEFT, RIGHT = b"\0", b"\1", b"\2"
DIGEST = 32


def _joined(left: bytes, right: bytes | None = None) -> bytes:
    return sha256((left if right is None else left + right).hex().encode()).digest()


def encoded(value: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]), 256))


# Ranks


def directory(leaves: DataFrame) -> DataFrame:
    """The bitmaps: ``word``, its ``bits`` and rows ``n``, by ``group``, with ``before``, the leaves of the group in earlier
    words, the group's number ``gid`` (null first) and its leaves ``size``.

    Null ids are a word of their own, the first. Words are combined before the shuffle, so a group of any size costs a row
    of its word and task at most.
    """
    bit = F.expr("shiftleft(1L, cast(id & 63 AS int))")
    words = leaves.groupBy("group", F.shiftright("id", WORD_BITS).alias("word")).agg(
        F.bit_or(bit).alias("bits"), F.count("*").alias("n"))
    order = [F.col("group").isNotNull(), F.col("group"), F.col("word").isNotNull(), F.col("word")]
    counted = kept(running(words, order, "n", "at"), "merkle-words")
    groups = counted.groupBy("group").agg(F.min("at").alias("base"), F.sum("n").alias("size"))
    known = running(groups.withColumn("_one", F.lit(1).cast("long")), order[:2], "_one", "gid").drop("_one")
    known = known.withColumnRenamed("group", "_group")
    joined = counted.join(known, counted["group"].eqNullSafe(known["_group"]))
    return kept(joined.select("group", "word", "bits", "n", (F.col("at") - F.col("base")).alias("before"), "gid", "size"),
                "merkle-directory")


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (columns group, id, leaf, row and others) with ``gid``, ``size`` and ``index``, the leaf's place in its
    group by id. Null ids come first, and equal ids follow by leaf; equal leaves are interchangeable.

    A word in which every id occurs once answers with its bits alone. Rows of other words, and those without an id, are
    dealt out by ranges and counted there, so an id of any number of rows is spread over tasks.
    """
    words = directory(leaves).withColumnsRenamed({"group": "_group", "word": "_word"})
    rows = leaves.withColumn("word", F.shiftright("id", WORD_BITS))
    joined = rows.join(words, rows["group"].eqNullSafe(words["_group"]) & rows["word"].eqNullSafe(words["_word"]))
    single = F.coalesce(F.col("n") == F.bit_count("bits"), F.lit(False))
    names = [c for c in leaves.columns if c != "row"]
    below = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, cast(id & 63 AS int))")))
    plain = joined.where(single).select(*names, "gid", "size", (F.col("before") + below).alias("index"))
    if words.where(~single).isEmpty():
        return plain
    repeated = joined.where(~single).select(*leaves.columns, "word", "gid", "size", "before", F.lit(1).cast("long").alias("_one"))
    order = ["gid", F.col("word").isNotNull(), "word", "id", "leaf", "row"]
    numbered = kept(running(repeated, [F.col(c) if isinstance(c, str) else c for c in order], "_one", "_at"), "merkle-repeats")
    first = numbered.groupBy("gid", "word").agg(F.min("_at").alias("_first")).withColumnsRenamed({"gid": "_gid", "word": "_word"})
    found = numbered.join(first, (numbered["gid"] == first["_gid"]) & numbered["word"].eqNullSafe(first["_word"]))
    return plain.unionByName(found.select(*names, "gid", "size", (F.col("before") + F.col("_at") - F.col("_first")).alias("index")))


# Trees


def _levels(nodes: list[bytes], size: int, height: int) -> list[list[bytes]]:
    """A block's nodes and what they are reduced to, level by level, in a tree with ``size`` nodes at the block's level."""
    levels = [nodes]
    while len(levels) <= height and size > 1:
        now = levels[-1]
        levels.append([_joined(*now[i : i + 2]) for i in range(0, len(now), 2)])
        size = -(-size // 2)
    return levels


def _paths(levels: list[list[bytes]], above: bytes) -> list[bytes]:
    """Of each node of the lowest level, the path to the root, given that of the highest one."""
    paths = [above]
    for now in levels[-2::-1]:
        paths = [(NONE if i ^ 1 >= len(now) else (LEFT if i & 1 else RIGHT) + now[i ^ 1]) + paths[i >> 1] for i in range(len(now))]
    return paths


def steps(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """The levels of a path: side and sibling."""
    at = 0
    while at < len(path):
        side = path[at : at + 1]
        end = at + 1 if side == NONE else at + 1 + DIGEST
        yield side, path[at + 1 : end]
        at = end


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    node = leaf
    for side, other in steps(path):
        node = _joined(node) if side == NONE else _joined(other, node) if side == LEFT else _joined(node, other)
    return node


def proof(path: bytes) -> bytes:
    """Digest of all siblings of a path, from the leaf up."""
    return sha256("".join([other.hex() for _, other in steps(path)]).encode()).digest()


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """Row number of each block, where its slots' values lie among all of the batch, and its nodes by slot."""
    slots = batch.column("slots")
    ends = slots.offsets.to_pylist()
    values = slots.values
    place, node = values.field("slot").to_pylist(), values.field("node").to_pylist()
    for k in range(batch.num_rows):
        at = [0] * (ends[k + 1] - ends[k])
        for j in range(ends[k], ends[k + 1]):
            at[place[j]] = j
        yield k, at, [node[j] for j in at]


def _reduced(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column("size").to_pylist()
            tops = [_levels(nodes, size[k], height)[-1][0] for k, _, nodes in _blocks(b)]
            left = [-(-n >> height) if n > 1 else n for n in size]
            yield pa.RecordBatch.from_arrays(
                [b.column("gid"), b.column("block"), pa.array(left, pa.int64()), pa.array(tops, pa.binary())],
                names=["gid", "index", "size", "node"])

    return run


def grown(nodes: DataFrame, extra: Sequence[str] = (), height: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all rounds, lowest first, and the roots (gid, node) of the trees over ``nodes`` (gid, index, size,
    node). Slots of the lowest round carry the ``extra`` columns of their nodes."""
    rounds = []
    while True:
        slot = F.col("index").bitwiseAND(F.lit((1 << height) - 1)).cast("int").alias("slot")
        grouped = nodes.groupBy("gid", F.shiftright("index", height).alias("block")).agg(
            F.first("size").alias("size"), F.collect_list(F.struct(slot, "node", *([] if rounds else extra))).alias("slots"))
        rounds.append(kept(grouped, "merkle-blocks"))
        nodes = kept(rounds[-1].mapInArrow(_reduced(height), "gid long, index long, size long, node binary"), "merkle-nodes")
        if (nodes.agg(F.max("size")).first()[0] or 0) <= 1:
            return rounds, nodes.select("gid", "node")


def _descend(carried: Sequence[str], height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, above = b.column("size").to_pylist(), b.column("path").to_pylist()
            index, path, row = [], [], []
            first = b.column("block").to_pylist()
            for k, _, nodes in _blocks(b):
                own = _paths(_levels(nodes, size[k], height), above[k])
                path += own
                index += range(first[k] << height, (first[k] << height) + len(own))
                row += [k] * len(own)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("gid").take(take), pa.array(index, pa.int64()), pa.array(path, pa.binary()),
                 *[b.column(c).take(take) for c in carried]], names=["gid", "index", "path", *carried])

    return run


def descended(rounds: list[DataFrame], roots: DataFrame, height: int = LEVELS) -> DataFrame:
    """The lowest blocks with the path of their node. ``roots`` has gid, path and columns that are carried along."""
    carried = [c for c in roots.columns if c not in ("gid", "path")]
    types = "".join(f", {c} binary" for c in carried)
    above = roots.withColumn("index", F.lit(0).cast("long"))
    for k in range(len(rounds) - 1, -1, -1):
        blocks = rounds[k].join(above.withColumnRenamed("index", "block"), ["gid", "block"])
        if k == 0:
            return blocks
        above = kept(blocks.mapInArrow(_descend(carried, height), f"gid long, index long, path binary{types}"), "merkle-paths")


def _proved(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, above, subroot, root = (b.column(c).to_pylist() for c in ("size", "path", "subroot", "root"))
            values = b.column("slots").values
            key, other = values.field("id"), values.field("other").to_pylist()
            taken, out = [], []
            for k, at, nodes in _blocks(b):
                for j, leaf, path in zip(at, nodes, _paths(_levels(nodes, size[k], height), above[k]), strict=True):
                    end = folded(leaf if other[j] is None else other[j], path)
                    taken.append(j)
                    out.append((leaf.hex(), subroot[k].hex(), root[k].hex(), proof(path).hex(), end.hex(), end == root[k], path))
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.string()] * 5 + [pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [key.take(pa.array(taken, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "path"])

    return run


def manifest(docs: DataFrame, *, key: str = "doc_id", group: str = "lang", columns: Sequence[str] = COLUMNS,
             changed: dict[str, Column] | None = None, height: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``leaf``, ``subroot`` of its group, ``root``, ``proof_sha256``, ``folded_root``,
    ``verified`` and ``path``. All but the path are hexadecimal text or, for the id, what the key is.

    A leaf is the digest of the row's encoded ``columns``. ``changed`` gives columns other values for the check alone: what
    the root is recomputed from is then the leaf of the changed row. Null is a group like others, the first; null ids come
    first in their group, and rows that repeat an id follow one another by leaf. An empty table gives no rows.
    """
    changed = changed or {}
    leaf = digest([F.col(c) for c in columns])
    other = digest([changed.get(c, F.col(c)) for c in columns]) if changed else F.lit(None).cast("binary")
    differs = F.lit(False)
    for c, value in changed.items():
        differs = differs | ~value.eqNullSafe(F.col(c))
    leaves = kept(docs.select(
        F.col(group).alias("group"), F.col(key).cast("long").alias("id"), leaf.alias("leaf"),
        F.when(differs, other).alias("other"), F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    nodes = ranked(leaves).withColumnRenamed("leaf", "node")
    rounds, subroots = grown(nodes, ["id", "other"], height)
    size = subroots.count()
    over = subroots.select(F.lit(0).cast("long").alias("gid"), F.col("gid").alias("index"), F.lit(size).cast("long").alias("size"),
                           "node")
    top, root = grown(over, height=height)
    start = root.select("gid", F.lit(b"").alias("path"), F.col("node").alias("root"))
    reached = kept(descended(top, start, height).mapInArrow(
        _descend(["root"], height), "gid long, index long, path binary, root binary"),
                   "merkle-paths")
    begun = reached.join(subroots.withColumnRenamed("gid", "index"), "index").select(
        F.col("index").alias("gid"), "path", F.col("node").alias("subroot"), "root")
    return descended(rounds, begun, height).mapInArrow(
        _proved(height), "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
        "path binary")


def op13_merkle(spark, docs: DataFrame, height: int = LEVELS) -> DataFrame:
    """The manifest by language, checked against rows of which those with a crc32 of the id that 7 divides count one character
    more; null ids and null counts stay as they are."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(tampered, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    found = manifest(docs.select(*COLUMNS), changed={"n_chars": more}, height=height)
    return found.withColumnRenamed("id", "doc_id").drop("path")
