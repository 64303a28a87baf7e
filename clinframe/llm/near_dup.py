"""MinHash near-dedup (SuperMinHash): signatures, banding, exact verification, union-find groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, cut, drop_cut, hasher, mix, shingles, small_batches, text_key

HUBS = 16
#: Nodes of a block when an open bucket is compared whole.
BLOCK = 1024
SKETCH = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("n_shingles", pa.int64()),
                    ("node", pa.binary()), ("parts", pa.binary()), ("bands", pa.list_(pa.int64()))])


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures of several sets of 64-bit elements: (len(sets), m) uint64.

    Each element draws a random permutation of the m components, one position
    per round; in round j it offers ``j + r`` (r a fresh fraction) at its j-th
    position, and a component keeps the least offer.  Ranks along one
    permutation are correlated, hence the lower variance than independent hash
    functions.  Early stop: once every component of a set is below j, no later
    round can lower it.  Values are fixed point (round << 48 | fraction), so
    equality is exact.  Very large sets go through in slices of elements.
    """
    sig = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [s.size for s in sets])
    elems = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    flat = sig.reshape(-1)
    for lo in range(0, elems.size, 1 << 14):
        e, own = elems[lo:lo + (1 << 14)], owner[lo:lo + (1 << 14)]
        perm = None
        for j in range(m):
            floor = np.uint64(j << 48)
            first, last = own[0], own[-1] + 1
            open_ = np.zeros(len(sets), bool)
            open_[first:last] = sig[first:last].max(axis=1) >= floor
            live = open_[own]
            if not live.all():
                if not live.any():
                    break
                e, own = e[live], own[live]
                perm = perm[live] if perm is not None else None
            x = mix(e, j + 1)
            k = j + (((x >> np.uint64(32)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
            if perm is None:
                perm = np.tile(np.arange(m, dtype=np.uint16), (e.size, 1))
            row = np.arange(e.size)
            pos = perm[row, k].astype(np.int64)
            perm[row, k] = perm[:, j]
            np.minimum.at(flat, own * m + pos, floor | (mix(x, 991) >> np.uint64(16)))
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` signature components: (n, bands) int64."""
    s = sig[:, : bands * rows].reshape(sig.shape[0], bands, rows)
    h = np.broadcast_to(np.arange(bands, dtype=np.uint64), s.shape[:2])
    for r in range(rows):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + s[:, :, r])
    return h.view(np.int64)


def _sketch(k: int, bands: int, rows: int):
    def run(it):
        for batch in it:
            ids, tkeys, texts = (batch.column(i) for i in range(3))
            sets = [shingles(w, k) for w in hasher().many(texts.to_pylist())]
            keys = band_keys(superminhash(sets, bands * rows), bands, rows)
            nodes = [None if s.size == 0 else
                     np.array([np.add.reduce(mix(s, 5)), np.add.reduce(mix(s, 6))], np.uint64).tobytes() for s in sets]
            parts = [np.minimum(np.bincount((mix(s, 9) >> np.uint64(56)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids, tkeys, pa.array([s.size for s in sets], pa.int64()), pa.array(nodes, pa.binary()), pa.array(parts, pa.binary()),
                 pa.array([None if n is None else r for n, r in zip(nodes, keys)], SKETCH.field("bands").type)],
                schema=SKETCH)
    return run


def _possible(similarity_pct: int):
    """(node, comp, size, parts, hubs) -> (a, b) of the pairs that may be similar.

    ``parts`` counts a set's elements by 256 hash parts, so the sum of the
    differences is a lower bound of the symmetric difference of two sets, and
    100*i >= pct*u is the same as (100+pct) * difference <= (100-pct) * sizes.
    No pair that passes the full test is lost.
    """
    def run(it):
        for batch in it:
            found = set()  # a node's buckets come together and share hubs
            for node, comp, size, parts, hubs in zip(*(batch.column(i).to_pylist() for i in range(5))):
                mine = np.frombuffer(parts, np.uint8).astype(np.int16)
                for h in hubs:
                    if h["comp"] != comp:
                        apart = int(np.abs(mine - np.frombuffer(h["parts"], np.uint8)).sum())
                        if (100 + similarity_pct) * apart <= (100 - similarity_pct) * (size + h["size"]):
                            found.add((min(node, h["node"]), max(node, h["node"])))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], names=["a", "b"])
    return run


def _block(column):
    """A list column's element of one row -> nodes, components, sizes and parts as arrays."""
    f = column.values
    node, comp, size, parts = (f.field(i) for i in range(4))
    return (node, np.unique(np.array(comp.to_pylist(), object), return_inverse=True)[1], comp, size.to_numpy(zero_copy_only=False),
            np.frombuffer(b"".join(parts.to_pylist()), np.uint8).reshape(-1, 256).astype(np.int16))


def _whole(similarity_pct: int):
    """(own, other) blocks of a bucket, other null for own against itself -> (a, b) of all pairs that may be similar.

    Every pair of different components is tested by the bound of :func:`_possible`.
    """
    def pairs(own, other):
        node, _, comp, size, parts = own
        if other is None:  # the largest component comes last: its nodes have no partner after them
            number = own[1]
            order = np.lexsort((number, np.bincount(number)[number]))
            number, size, parts = number[order], size[order], parts[order]
            node = node.take(pa.array(order))
            onode, onumber, osize, oparts = node, number, size, parts
        else:
            onode, _, ocomp, osize, oparts = other
            number = np.unique(np.array(comp.to_pylist() + ocomp.to_pylist(), object), return_inverse=True)[1]
            number, onumber = number[: size.size], number[size.size:]
        for i in range(size.size):
            lo = i + 1 if other is None else 0
            small, large = np.minimum(osize[lo:], size[i]), np.maximum(osize[lo:], size[i])
            j = lo + np.flatnonzero((onumber[lo:] != number[i]) & (100 * small >= similarity_pct * large))
            if not j.size:
                if other is None and number[i] == number[-1]:
                    break
                continue
            apart = np.abs(oparts[j] - parts[i]).sum(axis=1)
            j = j[(100 + similarity_pct) * apart <= (100 - similarity_pct) * (osize[j] + size[i])]
            if j.size:
                yield pa.RecordBatch.from_arrays([node.take(pa.array(np.full(j.size, i))), onode.take(pa.array(j))], names=["a", "b"])

    def run(it):
        for batch in it:
            for r in range(batch.num_rows):
                own, other = batch.column(0)[r], batch.column(1)[r]
                yield from pairs(_block(own), _block(other) if other.is_valid else None)
    return run


def _verify(k: int, similarity_pct: int):
    """Pairs with both texts -> (a, b) of the pairs whose full shingle sets are similar enough."""
    def run(it):
        sets: dict = {}
        for batch in it:
            a, b, ta, tb = (batch.column(i).to_pylist() for i in range(4))
            todo = {n: t for n, t in [*zip(a, ta), *zip(b, tb)] if n not in sets}
            if sum(s.size for s in sets.values()) > 2_000_000:
                sets.clear()
                todo = dict([*zip(a, ta), *zip(b, tb)])
            for n, w in zip(todo, hasher().many(list(todo.values()))):
                sets[n] = shingles(w, k)
            ok = []
            for x, y in zip(a, b):
                sx, sy = sets[x], sets[y]
                both = np.intersect1d(sx, sy, assume_unique=True).size
                ok.append(100 * both >= similarity_pct * (sx.size + sy.size - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    return run


def near_duplicates(docs: DataFrame, k: int = 4, bands: int = 32, rows: int = 6, similarity_pct: int = 80,
                    quiet_rounds: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate groups of ``docs``: one row per input row.

    Columns: doc_id, tkey (hash of the text), n_shingles, component_id, kept.

    1. Sketch every text (SuperMinHash of its distinct ``k``-word shingles,
       ``bands`` keys of ``rows`` components).  Texts with the same shingle set
       are one *node*, so groups of exact copies never meet again as rows.
       At similarity 0.8 a pair shares a band with probability 1 - 6e-5.
    2. Nodes that share a band key form a bucket; buckets of the same nodes
       count once.  Rounds against hubs unite most of a bucket cheaply: round
       one tests each node against its smallest hub.  Each later round takes
       the buckets that still span several components and tests every node
       outside a bucket's largest component against HUBS distinct random nodes of
       the bucket, unless counts by hash part already show that they are too
       different; hubs of the largest component have then met all others and
       retire, and a bucket of at most HUBS nodes is settled.  The rounds end after ``quiet_rounds`` rounds without a new
       link, or when no bucket is open.
    3. Buckets still open are compared whole: every node outside the largest
       component against every node of another component, by blocks of about
       BLOCK nodes inside the tasks, through exact bounds (sizes, counts by
       hash part).  Pairs within the bounds are checked a few per pair of
       components at a time, until each is checked or connected.  So each pair
       of each bucket is tested or connected, whatever ``quiet_rounds`` is;
       the tests grow with the product of a bucket's open and all nodes.
    4. A link counts when the full shingle sets agree (100*i >= pct*union).
    5. Union-find over the links (:func:`common.components`).

    Words: runs without ASCII white space, A-Z lower-cased; fewer than ``k``
    words form one shingle.  Null, empty or blank texts have no shingles, are
    linked with nothing and are their own component.  Repeated rows are copies
    of one document.  A null id never names a component unless all its members
    have null ids; ``kept`` is then false.  Extra columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("tkey"),
                      F.col(text_col).alias("text"))
    sketch = cut(src.mapInArrow(_sketch(k, bands, rows), "doc_id long, tkey long, n_shingles long, node binary, parts binary, bands array<long>"),
                 "sketch")
    nodes = cut(sketch.filter("node is not null").groupBy("node")
                .agg(F.min("doc_id").alias("min_doc"), F.min(F.struct("doc_id", "tkey")).alias("rep"),
                     F.first("n_shingles").alias("size"), F.first("parts").alias("parts"), F.first("bands").alias("bands")), "nodes")

    keyed = nodes.select(F.explode("bands").alias("bkey"), "node")
    shared = cut(keyed.groupBy("bkey").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"),
                                           *[F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in (0, 1)])
                 .filter("lo <> hi").groupBy("lo", "hi", "n", "x0", "x1").agg(F.min("bkey").alias("bkey"))
                 .select("bkey", F.col("lo").alias("hub")), "shared")
    # one row per node from here on, with its buckets (at most ``bands``) as an array
    held = keyed.join(shared, "bkey").groupBy("node").agg(F.collect_list(F.struct("bkey", "hub")).alias("buckets"))
    members = cut(held.join(nodes.select("node", "size", "parts", "rep"), "node"), "members")

    reps = members.select("node", F.col("rep.doc_id").alias("rid"), F.col("rep.tkey").alias("rkey"))
    texts = cut(src.join(reps, F.col("doc_id").eqNullSafe(F.col("rid")) & (F.col("tkey") == F.col("rkey")))
                .groupBy("node").agg(F.first("text").alias("text")), "texts")

    def confirmed(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
        pairs = cut(pairs, "candidates")  # its size is known to the joins
        both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
                .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
                .select("a", "b", "ta", "tb"))
        links = cut(both.mapInArrow(_verify(k, similarity_pct), "a binary, b binary"), name)
        drop_cut(pairs)
        return links

    def united(comps: DataFrame, links: DataFrame) -> DataFrame:
        """``comps`` after ``links``: the components of the contracted graph, which is small in later rounds."""
        named = (links.join(comps.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a")
                 .join(comps.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b").select("ca", "cb").distinct())
        merged = components(named, "ca", "cb").select(F.col("node").alias("comp"), F.col("comp").alias("into"))
        return cut(comps.join(merged, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp")), "comps")

    def opened(left: DataFrame, comps: DataFrame) -> DataFrame:
        """Nodes of ``left`` (node, bkeys) that are in open buckets: node, comp and, of each such bucket, its
        key, its largest component with that one's size, and its own size."""
        state = cut(left.join(comps, "node").select("node", "comp", "bkeys"), "state")
        rows = state.select(F.explode("bkeys").alias("bkey"), "node", "comp")
        main = (rows.groupBy("bkey", "comp").agg(F.count("*").alias("n")).groupBy("bkey")
                .agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("comps")).filter("comps > 1")
                .select("bkey", F.col("top.comp").alias("main"), F.col("top.n").alias("n_main"), "n"))
        main = cut(main, "main")
        out = cut(rows.join(main, "bkey").groupBy("node", "comp")
                  .agg(F.collect_list(F.struct("bkey", "main", "n_main", "n")).alias("open")), "open")
        drop_cut(state)
        drop_cut(main)
        return out

    def compared(left: DataFrame, comps: DataFrame) -> DataFrame:
        """``comps`` after all pairs of the buckets in ``left``."""
        inside = opened(left, comps)
        if not inside.take(1):
            return comps
        nth = F.xxhash64("node", F.lit("block"))

        # own blocks from 0 on; the largest component of a bucket of several blocks below 0
        def number(o):
            return (F.when(o["n"] <= BLOCK, F.lit(0))
                    .when(F.col("comp") == o["main"], -1 - F.pmod(nth, F.ceil(o["n_main"] / BLOCK)))
                    .otherwise(F.pmod(nth, F.ceil((o["n"] - o["n_main"]) / BLOCK))).cast("int"))
        dealt = inside.select("node", "comp", F.transform("open", lambda o: F.struct(o["bkey"].alias("bkey"), number(o).alias("block"))).alias("at"))
        blocks = cut(dealt.join(members.select("node", "size", "parts"), "node").select(F.inline("at"), "node", "comp", "size", "parts")
                     .groupBy("bkey", "block").agg(F.collect_list(F.struct("node", "comp", "size", "parts")).alias("held")), "blocks")
        names = blocks.select("bkey", "block")
        both = (names.filter("block >= 0").withColumnRenamed("block", "i")
                .join(names.withColumnRenamed("block", "j"), "bkey").filter("j < 0 or j >= i"))
        both = (both.join(blocks.select("bkey", F.col("block").alias("i"), F.col("held").alias("own")), ["bkey", "i"])
                .join(blocks.select("bkey", F.col("block").alias("j"), F.col("held").alias("other")), ["bkey", "j"])
                .select("own", F.when(F.col("i") != F.col("j"), F.col("other")).alias("other")))
        small_batches(spark, 32)
        pairs = cut(both.mapInArrow(_whole(similarity_pct), "a binary, b binary")
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "possible")
        small_batches(spark)
        drop_cut(blocks)
        share = HUBS
        while True:
            before = pairs
            pairs = cut(pairs.join(comps.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a")
                        .join(comps.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b").filter("ca <> cb")
                        .select("a", "b", F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")), "possible")
            drop_cut(before)
            if not pairs.take(1):
                return comps
            nth = F.row_number().over(Window.partitionBy("ca", "cb").orderBy(F.xxhash64("a", "b"), "a", "b"))
            now = cut(pairs.withColumn("nth", nth).filter(F.col("nth") <= share).select("a", "b"), "now")
            found = confirmed(now, texts, "links")
            if found.take(1):
                comps = united(comps, found)
            rest = cut(pairs.select("a", "b").join(now, ["a", "b"], "left_anti"), "possible")
            drop_cut(pairs)
            pairs = rest
            share *= HUBS

    first = members.select(F.col("node").alias("a"), F.array_min(F.filter(F.col("buckets.hub"), lambda h: h != F.col("node"))).alias("b")).filter("b is not null")
    comps = united(members.select("node", F.col("node").alias("comp")), confirmed(first, texts, "links"))
    left, salt, quiet = members.select("node", F.col("buckets.bkey").alias("bkeys")), 0, 0
    while quiet_rounds is None or quiet < quiet_rounds:
        open_ = opened(left, comps)
        if not open_.take(1):
            left = None
            break
        if not salt:  # what the later rounds may need, without the nodes that are settled
            whole = texts
            texts = cut(texts.join(open_.select("node"), "node", "left_semi"), "texts")
            drop_cut(whole)
        rows = open_.select(F.inline("open"), "node", "comp")
        drawn = F.row_number().over(Window.partitionBy("bkey").orderBy(F.xxhash64("bkey", "node", F.lit(salt)), "node"))
        drawn = rows.withColumn("drawn", drawn).filter(F.col("drawn") <= HUBS)
        drawn = cut(drawn.groupBy("node", "comp").agg(F.collect_list("bkey").alias("hub_of")), "drawn")
        payload = members.select("node", "size", "parts")
        hubs = (drawn.join(payload, "node").select(F.explode("hub_of").alias("bkey"), "node", "comp", "size", "parts")
                .groupBy("bkey").agg(F.collect_list(F.struct("node", "comp", "size", "parts")).alias("hubs")))  # HUBS at most
        outside = open_.select("node", "comp", F.filter("open", lambda o: o["main"] != F.col("comp"))["bkey"].alias("bkeys")).filter(F.size("bkeys") > 0)
        pairs = (outside.join(payload, "node").select(F.explode("bkeys").alias("bkey"), "node", "comp", "size", "parts")
                 .join(hubs, "bkey").select("node", "comp", "size", "parts", "hubs")
                 .mapInArrow(_possible(similarity_pct), "a binary, b binary").distinct())
        found = confirmed(pairs, texts, "links")
        new = bool(found.take(1))
        quiet = 0 if new else quiet + 1
        if new:
            comps = united(comps, found)
        # hubs of the main component have met every node outside it; where all nodes were hubs, all pairs are settled
        still = lambda o: (o["n"] > HUBS) & ~((o["main"] == F.col("comp")) & F.coalesce(F.array_contains("hub_of", o["bkey"]), F.lit(False)))
        after = open_.join(drawn.select("node", "hub_of"), "node", "left").select("node", F.filter("open", still)["bkey"].alias("bkeys"))
        left = cut(after.filter(F.size("bkeys") > 0), "left")
        drop_cut(open_)
        drop_cut(drawn)
        salt += 1
    if left is not None:
        comps = compared(left, comps)

    labels = (nodes.join(comps, "node", "left").select("node", "min_doc", F.coalesce("comp", "node").alias("comp")))
    low = labels.groupBy("comp").agg(F.min("min_doc").alias("component_id"))
    labels = cut(labels.join(low, "comp").select("node", "component_id"), "labels")
    return (sketch.join(labels, "node", "left")
            .select("doc_id", "tkey", "n_shingles",
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one of smallest id.

    Repeated rows of the kept document collapse into one.  In a group without
    any id each different text stays once; all columns are kept.
    """
    marks = near_duplicates(docs, **options)
    keep = marks.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "tkey").agg(F.lit(1).alias("one"))
    keep = keep.select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key"))
    keyed = docs.withColumn("__tkey", text_key())
    out = keyed.join(keep, keyed["doc_id"].eqNullSafe(keep["__id"]) & (keyed["__tkey"] == keep["__key"]))
    return out.dropDuplicates(["__id", "__key"]).select(*[keyed[c] for c in docs.columns])
