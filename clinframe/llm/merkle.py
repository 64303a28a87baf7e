"""Merkle dataset manifest: 16-ary trees by source, grown by aligned appends that carry witnesses."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

FAN = 16
#: Levels of a block: a task appends FAN ** HEIGHT nodes at most to one tree.
HEIGHT = 2
BLOCK = FAN ** HEIGHT
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WITNESS = "array<struct<before:string,after:string>>"
WITNESS_ARROW = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


class Appender:
    """Streaming append to a tree: per level the open run of subtrees, each with the range of leaves it holds.

    A run of FAN nodes, or the last one, is completed: each of its subtrees
    hands its siblings, before and after it, to the witnesses of its leaves,
    and their digest is appended one level up.
    """

    def __init__(self, witnesses: bool = True):
        self.open: list[list] = [[]]
        self.leaves, self.witness = 0, [] if witnesses else None

    def append(self, node: str) -> None:
        if self.witness is not None:
            self.witness.append([])
        self.leaves += 1
        self._add(0, node, self.leaves - 1, self.leaves)

    def _add(self, level: int, node: str, lo: int, hi: int) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, lo, hi))
        if len(self.open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        names = [name for name, _, _ in run]
        for i, (_, lo, hi) in enumerate(run if self.witness is not None else ()):
            siblings = {"before": "".join(names[:i]), "after": "".join(names[i + 1:])}
            for leaf in range(lo, hi):
                self.witness[leaf].append(siblings)
        self._add(level + 1, digest(names), run[0][1], run[-1][2])

    def close(self, height: int | None = None) -> str:
        """Complete the open runs up to ``height`` (a block of a larger tree), or until one node remains: its digest."""
        level = 0
        while level != height:
            run = self.open[level]
            if height is None and len(run) == 1 and not any(self.open[level + 1:]):
                break
            if run:
                self._complete(level)
            level += 1
        return self.open[level][0][0]


def _blocks(it):
    """Sorted rows -> (key, block, rows) of each block, across batches."""
    at, held = None, []
    for batch in it:
        for row in batch.to_pylist():
            here = (row["key"], row["block"])
            if here != at and held:
                yield *at, held
                held = []
            at = here
            held.append(row)
    if held:
        yield *at, held


def _roots(it):
    """Blocks -> their roots, nodes of the next layer; ``closed`` where the block is a whole tree."""
    schema = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("node", pa.string()), ("closed", pa.bool_())])
    for key, block, rows in _blocks(it):
        tree, n = Appender(witnesses=False), rows[0]["n"]
        for row in rows:
            tree.append(row["node"])
        yield pa.RecordBatch.from_pylist([{"key": key, "pos": block, "n": -(-n // BLOCK), "node": tree.close(HEIGHT if n > BLOCK else None),
                                           "closed": n <= BLOCK}], schema=schema)


def _witnesses(it):
    """Blocks, each led by the witness of its root -> every node's witness up to the last root."""
    schema = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("id", pa.int64()), ("name", pa.string()), ("node", pa.string()),
                        ("changed", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("witness", WITNESS_ARROW)])
    for key, _, (above, *rows) in _blocks(it):
        tree = Appender()
        for row in rows:
            tree.append(row["node"])
        tree.close(HEIGHT if rows[0]["n"] > BLOCK else None)
        yield pa.RecordBatch.from_pylist(
            [{**{c: row[c] for c in ("key", "pos", "id", "name", "node", "changed")}, "subroot": above["subroot"], "root": above["root"],
              "witness": w + above["witness"]} for row, w in zip(rows, tree.witness)], schema=schema)


NODES = "key string, id long, name string, node string, changed string"


def _numbered(it):
    """Sorted nodes of a range partition, with its number and their positions by key within it."""
    part, key, at = TaskContext.get().partitionId(), None, -1
    for batch in it:
        local = []
        for k in batch.column(0).to_pylist():
            at, key = at + 1 if k == key else 0, k
            local.append(at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(local), pa.int32()), pa.array(local, pa.int64())],
                                         names=[*batch.schema.names, "part", "local"])


def positions(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (NODES) with ``pos``, their place among the nodes of their key by ``order`` (nulls first), and ``n`` of the key.

    Range-sorted by key and order, with the row's number against ties, so a
    large key is dealt to many tasks; numbered in each task, then moved by the
    counts of the key in the tasks before.
    """
    cols = ["key", "id", "name", "node", "changed"]
    by = [F.col(c).asc_nulls_first() for c in ("key", *order, "tie")]
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(tasks, *by)
              .sortWithinPartitions(*by).select(*cols))
    local = cut(ranged.mapInArrow(_numbered, f"{NODES}, part int, local long"), "numbered")
    counts = local.groupBy("key", "part").agg(F.count("*").alias("count"))
    w = Window.partitionBy("key").orderBy("part")
    counts = counts.select(F.col("key").alias("k"), F.col("part").alias("p"),
                           F.coalesce(F.sum("count").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                           F.sum("count").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"))
    return (local.join(counts, F.col("key").eqNullSafe(F.col("k")) & (F.col("part") == F.col("p")))
            .select(*cols, (F.col("before") + F.col("local")).alias("pos"), "n"))


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "block").sortWithinPartitions("key", "block", "pos")


def _grow(nodes: DataFrame):
    """Layers of block roots over positioned nodes: [(nodes of the layer, (key, node) of the trees that close in it)].

    Each layer appends FAN ** HEIGHT nodes a block; the roots of the blocks of an
    unfinished tree are the nodes appended in the next layer.
    """
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    layers = []
    while True:
        rows = _by_block(nodes.select("key", block, "pos", "node", "n"))
        roots = cut(rows.mapInArrow(_roots, "key string, pos long, n long, node string, closed boolean"), "roots")
        layers.append((nodes, roots.filter("closed").select("key", "node")))
        nodes = roots.filter("not closed").select(
            "key", F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("name"), "node",
            F.lit(None).cast("string").alias("changed"), "pos", "n")
        if not nodes.take(1):
            return layers


def _extend(layers, tops: DataFrame) -> DataFrame:
    """Witnesses of the lowest layer's nodes: from the trees' own (``tops``: key, subroot, root, witness) down the layers."""
    cols = ["key", "block", "pos", "id", "name", "node", "changed", "n", "subroot", "root", "witness"]
    above = None
    for nodes, closed in reversed(layers):
        null = lambda c, kind: F.lit(None).cast(kind).alias(c)
        led = tops.join(closed.select(F.col("key").alias("k")), F.col("key").eqNullSafe(F.col("k"))).select(
            "key", F.lit(0).cast("long").alias("block"), "subroot", "root", "witness")
        if above is not None:
            led = led.unionByName(above.select("key", F.col("pos").alias("block"), "subroot", "root", "witness"))
        led = led.select("key", "block", F.lit(-1).cast("long").alias("pos"), null("id", "long"), null("name", "string"),
                         null("node", "string"), null("changed", "string"), null("n", "long"), "subroot", "root", "witness")
        rows = nodes.select("key", F.floor(F.col("pos") / BLOCK).alias("block"), "pos", "id", "name", "node", "changed", "n",
                            null("subroot", "string"), null("root", "string"), null("witness", WITNESS))
        above = _by_block(led.unionByName(rows).select(*cols)).mapInArrow(
            _witnesses, f"key string, pos long, id long, name string, node string, changed string, subroot string, root string, witness {WITNESS}")
    return above


def leaf_of(columns: list[str], changed: dict | None = None):
    """Digest of ``columns``: ``-`` for null, else byte count, colon and value of each."""
    fields = []
    for c in columns:
        value = F.col(c)
        if changed and c in changed:
            value = F.when(changed[c][0], changed[c][1]).otherwise(value)
        text = value.cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


def manifest(rows: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source",
             changed: dict | None = None) -> DataFrame:
    """Merkle manifest of ``rows``: one row each with its witness.

    Columns: key (the group), pos (place in it), id, node (the leaf), changed,
    subroot, root, witness (array of the digests before and after, level by
    level up to the root).  A leaf is the digest of ``columns``.  Per group the
    leaves ascend by id; 16 consecutive nodes, or the last fewer, become one
    until one remains; the groups' roots, null first, likewise.

    ``changed``: column -> (condition, value) where rows shall be tried with
    other values; their leaves come as column ``changed`` for :func:`folded`.

    Blocks of 256 positions are appended in a task each (:class:`Appender`);
    block roots are appended in the next layer, and its witnesses extend those
    of the block.  A large group is so dealt to many tasks, and a layer holds a
    256th of the nodes of the one below.

    Null values have their own mark, empty texts are ``0:``.  Rows without an
    id come first; equal ids are ordered by leaf, and equal rows have equal
    leaves at places of their own.  An empty table gives no rows.  Columns not
    named don't count.
    """
    leaves = rows.select(F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("key"), leaf_of(columns).alias("node"),
                         leaf_of(columns, changed or {}).alias("changed"))
    leaves = cut(leaves.select("key", "id", F.lit(None).cast("string").alias("name"), "node", "changed"), "leaves")
    nodes = cut(positions(leaves, ["id", "node"]), "positions")
    layers = _grow(nodes)
    closed = None
    for _, done in layers:
        closed = done if closed is None else closed.unionByName(done)
    groups = closed.select(F.lit("").alias("key"), F.lit(None).cast("long").alias("id"), F.col("key").alias("name"), "node",
                           F.lit(None).cast("string").alias("changed"))
    upper = _grow(cut(positions(groups, ["name"]), "groups"))
    own = None
    for _, done in upper:
        own = done if own is None else own.unionByName(done)
    own = own.select("key", F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"), F.array().cast(WITNESS).alias("witness"))
    tops = cut(_extend(upper, own).select(F.col("name").alias("key"), F.col("node").alias("subroot"), "root", "witness"), "tops")
    return _extend(layers, tops).drop("name")


def proof():
    """Digest of all siblings of a witness, level by level, left to right."""
    return F.sha2(F.array_join(F.transform("witness", lambda w: F.concat(w["before"], w["after"])), ""), 256)


def folded(leaf):
    """The root that a leaf and its witness lead to."""
    return F.aggregate("witness", leaf, lambda acc, w: F.sha2(F.concat(w["before"], acc, w["after"]), 256))


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def verified_manifest(docs: DataFrame, tampered_rest: int = 5) -> DataFrame:
    """Manifest of documents, checked against texts whose capitals were lower-cased where
    ``tampered_rest`` divides crc32(doc_id as text): doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows without an id are never tampered with, nor are null texts.
    """
    hit = F.crc32(F.col("doc_id").cast("long").cast("string")) % tampered_rest == 0
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    out = manifest(docs, COLUMNS, changed={"text": (hit, F.translate("text", CAPITALS, SMALL))})
    back = folded(F.col("changed"))
    return (out.select(F.col("id").alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root", proof().alias("proof_sha256"), back.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
