"""Prefix trie of conversations, built as a z-fast trie.

A conversation is a string of turns. Its compacted trie has a node for the
root, for every end of a conversation and wherever conversations part; a node
is known by its depth and the hash of the turns down to it (its extent). In a
z-fast trie each node is also entered, under the hash of its prefix of
two-fattest depth in (parent's depth, own depth], into a table of handles, and
a fat binary search over depths finds a conversation's exit node in about log2
(turns) look-ups.

Spark inserts in batches. All distinct conversations start in the root's group.
In each round every group inserts its ``batch`` members of smallest hash into
a small trie of its own (bounded, one task), and the group's other members, in
slices of bounded size beside a copy of that trie, locate their exit node by
fat binary search. One that ends on the trie adds a node there; the others
split the exit edge where they part and go on as groups of those that share the
next turn too. Groups shrink by about the batch size a round.

What is left is one row per compacted node. Counts and sums go up the trie as
aggregates over (conversation, compacted nodes on its way), and edges are then
expanded to a row for each depth.

Prefix hashes are 128 bits: the XOR of 64-bit hashes of (depth, turn), twice, so
they are prefix sums that chunks of a conversation compute apart. A
conversation beyond ``CHUNK`` turns is several units, each a string of its
own under the node where it begins; such a node is one more compacted node.

Defined cases: rows with null conv_id belong to no conversation; turns are
ordered by (turn, md5 of role and text), null turn first; rows that repeat are
turns that repeat; null role and text are empty; a conversation may be rebuilt
without a turn and then ends at the root; no conversation, no node (an empty
table gives an empty one); other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import written
from leakscope.operators.ordering import with_position_in_group

STRIDE, HEADS = 5, 9
CHUNK = 1024   # turns of one unit
BATCH = 256    # conversations that a group inserts in one round
SLICE = 4096   # conversations that search beside one copy of a trie
IDS = 4096     # conv_ids in one piece of a node's list

Key = tuple[int, int]


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the highest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class ZFastTrie:
    """Compacted trie over strings given by their prefix hashes:
    ``hashes[d - 1]`` is the hash of the first d letters."""

    def __init__(self):
        self.depth, self.parent, self.text = [0], [-1], [()]  # text: prefix hashes of one string through the node
        self.handles: dict[tuple[int, Key], int] = {}
        self.children: list[dict[Key, int]] = [{}]  # by the hash one letter down

    def _enter(self, node: int) -> None:
        f = two_fattest(self.depth[self.parent[node]], self.depth[node])
        self.handles[f, self.text[node][f - 1]] = node

    def exit(self, s) -> tuple[int, int]:
        """(node, depth) where ``s`` leaves the trie: the deepest node that
        lies on ``s``, or the node whose edge it leaves, and how far they agree."""
        a, b, best = 0, len(s), 0
        while a < b:
            f = two_fattest(a, b)
            node = self.handles.get((f, s[f - 1]))
            if node is None:
                b = f - 1
                continue
            d = self.depth[node]
            if d <= len(s) and self.text[node][d - 1] == s[d - 1]:
                best, a = node, d
            else:
                return node, self._agree(node, f, s)
        if best_child := self.children[best].get(s[a]) if a < len(s) else None:
            return best_child, self._agree(best_child, a + 1, s)
        return best, a

    def _agree(self, node: int, low: int, s) -> int:
        """Letters that ``s`` shares with the node's extent, at least ``low``."""
        t, high = self.text[node], min(len(s), self.depth[node])
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if t[mid - 1] == s[mid - 1] else (low, mid - 1)
        return low

    def _node(self, parent: int, depth: int, text) -> int:
        self.depth.append(depth)
        self.parent.append(parent)
        self.text.append(text)
        self.children.append({})
        node = len(self.depth) - 1
        self.children[parent][text[self.depth[parent]]] = node
        self._enter(node)
        return node

    def insert(self, s) -> None:
        node, depth = self.exit(s)
        if depth < self.depth[node]:  # split the edge
            top = self.parent[node]
            old = two_fattest(self.depth[top], self.depth[node])
            del self.handles[old, self.text[node][old - 1]]
            mid = self._node(top, depth, self.text[node])
            self.parent[node] = mid
            self.children[mid][self.text[node][depth]] = node
            self._enter(node)
            node = mid
        if depth < len(s):
            self._node(node, len(s), s)

    def nodes(self) -> list[tuple[int, Key]]:
        """(depth, hash) of every node but the root."""
        return [(d, t[d - 1]) for d, t in zip(self.depth[1:], self.text[1:])]


def _whole(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, i, digest, n_bytes): 1-based place and md5 of every turn."""
    role, text = _whole(F.col("role")), _whole(F.col("text"))
    x = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    return with_position_in_group(x, "conv_id", "turn", "digest", name="i").drop("turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, digest, n_bytes) of the rebuilt conversations, and
    (conv_id) of all of them, those without a turn included)."""
    own = written(digests(turns), "turns")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    base = F.col("conv_id") - F.col("conv_id") % STRIDE
    sizes = own.groupBy("conv_id").agg(F.max("i").alias("n"))
    convs = written(sizes.select("conv_id", base.alias("base"), head.alias("h"))
                    .join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
                    .select("conv_id", "base", F.col("h").cast("long").alias("h"),
                            F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")), "conversations")
    rest = (own.where(F.col("i") > head).join(convs.select("conv_id", "h", "taken"), "conv_id")
            .select("conv_id", (F.col("i") - F.col("h") + F.col("taken")).alias("depth"), "digest", "n_bytes"))
    heads = own.where((F.col("i") < HEADS) & (F.col("conv_id") % STRIDE == 0)).withColumnRenamed("conv_id", "base")
    first = (heads.join(convs.select("conv_id", "base", "h"), "base").where("i <= h")
             .select("conv_id", F.col("i").alias("depth"), "digest", "n_bytes"))
    return first.unionByName(rest), convs.select("conv_id")


def units(rows: DataFrame) -> DataFrame:
    """One row per (conversation, chunk of turns): start depth and hash (x1,
    x2), and per turn the 64-bit terms and cumulative bytes."""
    turn = F.struct("depth", F.xxhash64(F.lit(1), "depth", "digest").alias("t1"),
                    F.xxhash64(F.lit(2), "digest", "depth").alias("t2"), "n_bytes")
    chunk = F.floor((F.col("depth") - 1) / CHUNK)
    each = (rows.select("conv_id", chunk.alias("chunk"), turn.alias("t")).groupBy("conv_id", "chunk")
            .agg(F.array_sort(F.collect_list("t")).alias("t"), F.bit_xor("t.t1").alias("all1"),
                 F.bit_xor("t.t2").alias("all2"), F.sum("t.n_bytes").alias("all_bytes")))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return each.select("conv_id", "chunk", "t",
                       F.coalesce(F.bit_xor("all1").over(before), zero).alias("x1"),
                       F.coalesce(F.bit_xor("all2").over(before), zero).alias("x2"),
                       F.coalesce(F.sum("all_bytes").over(before), zero).alias("b"))


def _fields(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _rows(rows, schema: str, size: int = 2048):
    """Tuples as record batches of ``size`` rows."""
    kinds = [pa.list_(pa.int64()) if "array" in f else pa.int64() for f in schema.split(", ")]

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], _fields(schema))
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


UNIT = ("conv_id long, start long, g1 long, g2 long, n long, e1 long, e2 long, "
        "x1 array<long>, x2 array<long>, n_bytes array<long>, upto array<long>")


def hashed(each: DataFrame) -> DataFrame:
    """Units with prefix hashes (x1, x2), bytes of their turns and bytes up to
    each; (g1, g2): hash where the unit begins, at depth ``start``; (e1, e2):
    where it ends, at depth start + n."""
    def run(batches):
        def units_of(b):
            ids, chunks, g1, g2, so_far = (b.column(k).to_pylist() for k in ("conv_id", "chunk", "x1", "x2", "b"))
            for i in range(b.num_rows):
                t = b.column("t")[i].values
                t1, t2, own = (t.field(k).to_numpy() for k in ("t1", "t2", "n_bytes"))
                x1, x2 = (np.bitwise_xor.accumulate(np.concatenate((np.array([g], np.int64), v)))[1:]
                          for g, v in ((g1[i], t1), (g2[i], t2)))
                yield (ids[i], chunks[i] * CHUNK, g1[i], g2[i], len(own), int(x1[-1]), int(x2[-1]), x1, x2, own,
                       so_far[i] + np.cumsum(own))
        return _rows((u for b in batches for u in units_of(b)), UNIT, 256)
    return each.mapInArrow(run, UNIT)


#: A node (conv_id null: depth, x1, x2) or a string that goes on below (start, g1, g2).
FOUND = "start long, g1 long, g2 long, conv_id long, x1 array<long>, x2 array<long>"


def _grouped(batches):
    """((start, g1, g2, slice), [(kind, conv_id, string)]) of sorted rows."""
    last, rows = None, []
    for b in batches:
        x1, x2 = b.column("x1"), b.column("x2")
        names = ("start", "g1", "g2", "slice", "kind", "conv_id")
        for i, (*key, kind, conv) in enumerate(zip(*(b.column(k).to_pylist() for k in names))):
            if key != last and rows:
                yield last, rows
                rows = []
            last = key
            rows.append((kind, conv, list(zip(x1[i].as_py(), x2[i].as_py()))))
    if rows:
        yield last, rows


def _insert_and_locate(batches):
    """Per slice of a group: the batch (kind 0) makes a trie, and the others
    (kind 1) locate their exit node in it."""
    def found():
        for (start, g1, g2, piece), rows in _grouped(batches):
            trie = ZFastTrie()
            for kind, _, s in rows:
                if kind == 0:
                    trie.insert(s)
            nodes = set(trie.nodes()) if piece == 0 else set()
            at_top = start % CHUNK == 0 or len(trie.children[0]) > 1
            for kind, conv, s in rows:
                if kind == 0:
                    continue
                d = trie.exit(s)[1]
                at_top |= d == 0
                if d:
                    nodes.add((d, s[d - 1]))
                if d + 1 == len(s):
                    nodes.add((d + 1, s[d]))
                elif d < len(s):
                    yield (start + d + 1, *s[d], conv, [x for x, _ in s[d + 1:]], [x for _, x in s[d + 1:]])
            if at_top:
                yield start, g1, g2, None, None, None
            for d, x in nodes:
                yield start + d, *x, None, None, None
    return _rows(found(), FOUND)


GROUP = ["start", "g1", "g2"]


def compacted(strings: DataFrame, batch: int = BATCH, slice_rows: int = SLICE) -> DataFrame:
    """(depth, x1, x2) of every node of the compacted trie of ``strings``
    (start, g1, g2, conv_id, x1, x2)."""
    spark, nodes, turn = strings.sparkSession, None, 0
    going = strings.select(*_fields(FOUND))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        counts = going.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_n")).select(
            *[F.col(k).alias(f"_{k}") for k in GROUP], "_n")
        dealt = going.join(counts, [F.col(k) == F.col(f"_{k}") for k in GROUP])
        draw = F.pmod(F.xxhash64(F.lit(turn), "conv_id", "start"), F.lit(1 << 40))
        pieces = F.ceil(F.col("_n") / slice_rows)
        chosen = draw * F.col("_n").cast("double") < F.lit(float(batch << 40))
        own = F.when(F.col("kind") == 0, F.sequence(F.lit(0).cast("long"), pieces - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("conv_id", F.lit(turn)), pieces)))
        cols = [*GROUP, "slice", "kind", "conv_id", "x1", "x2"]
        rows = (dealt.withColumn("kind", F.when(chosen, 0).otherwise(1)).withColumn("slice", F.explode(own)).select(*cols)
                .repartition(n_parts, *GROUP, "slice").sortWithinPartitions(*GROUP, "slice", "kind"))
        found = written(rows.mapInArrow(_insert_and_locate, FOUND), "trie-round")
        new = found.where("conv_id IS NULL").select(F.col("start").alias("depth"), F.col("g1").alias("x1"), F.col("g2").alias("x2"))
        nodes = new if nodes is None else nodes.unionByName(new)
        going, turn = found.where("conv_id IS NOT NULL"), turn + 1
        if going.isEmpty():
            return written(nodes.distinct(), "trie-nodes")


def members(convs: DataFrame, each: DataFrame) -> DataFrame:
    """(conv_id, depth, x1, x2): where every rebuilt conversation ends."""
    last = each.groupBy("conv_id").agg(F.max(F.struct(
        (F.col("start") + F.col("n")).alias("depth"), F.col("e1").alias("x1"), F.col("e2").alias("x2"))).alias("e"))
    zero = F.lit(0).cast("long")
    return convs.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col(f"e.{k}"), zero).alias(k) for k in ("depth", "x1", "x2")])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256): the ids are joined in pieces of bounded
    size, and one task streams a node's pieces through its hash."""
    key = ["depth", "x1", "x2"]
    pieces = (ends.groupBy(*key, F.floor(F.col("conv_id") / IDS).alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
              .repartition(*key).sortWithinPartitions(*key, "piece"))

    def run(batches):
        last, h = None, None

        def one():
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in last), pa.array([h.hexdigest()])],
                                              [*key, "ends_sha256"])
        done = []
        for b in batches:
            for *k, ids in zip(*(b.column(c).to_pylist() for c in (*key, "ids"))):
                if k != last:
                    if last is not None:
                        done.append((*last, h.hexdigest()))
                    last, h = k, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*done))[:3]),
                                                  pa.array([d[3] for d in done])], [*key, "ends_sha256"])
                done = []
        if last is not None:
            yield one()
    return pieces.mapInArrow(run, "depth long, x1 long, x2 long, ends_sha256 string")


def report(turns: DataFrame, batch: int = BATCH, slice_rows: int = SLICE) -> DataFrame:
    """The columns of op13, one row per node of the uncompacted trie."""
    key, zero = ["depth", "x1", "x2"], F.lit(0).cast("long")
    rows, convs = rebuilt(turns)
    each = written(hashed(units(rows)), "trie-units")
    ends = written(members(convs, each), "trie-ends")
    reps = written(ends.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("m")), "trie-strings")
    own = written(each.join(reps.select("conv_id", "m", F.col("depth").alias("whole")), "conv_id"), "trie-own")
    nodes = compacted(own.dropDuplicates(["start", "n", "e1", "e2"]), batch, slice_rows)

    turn = F.posexplode(F.arrays_zip("x1", "x2", "n_bytes", "upto")).alias("p", "t")
    by_turn = own.select("conv_id", "m", "whole", "start", turn).select(
        "conv_id", "m", "whole", (F.col("start") + F.col("p") + 1).alias("depth"), "t.x1", "t.x2", "t.n_bytes", "t.upto")
    top = reps.select("conv_id", "m", F.col("depth").alias("whole"), zero.alias("depth"), zero.alias("x1"), zero.alias("x2"),
                      zero.alias("n_bytes"), zero.alias("upto"))
    path = written(by_turn.join(nodes, key).select(top.columns).unionByName(top), "trie-path")
    # written, so that the join to it shuffles both sides and adaptive execution can split the root's rows
    passing = written(path.groupBy(*key).agg(F.min("conv_id").alias("owner"), F.sum("m").alias("n_convs")), "trie-passing")

    way = Window.partitionBy("conv_id").orderBy("depth")
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, -1)
    owned = F.col("owner") == F.col("conv_id")
    is_leaf = (F.col("depth") == F.col("whole")) & (F.col("n_convs") == F.col("m"))
    up = F.coalesce(F.lag("upto").over(way), zero)
    on_path = (path.join(passing, key)
               .withColumn("up_depth", F.lag("depth").over(way)).withColumn("up_owner", F.lag("owner").over(way))
               .withColumn("child", F.coalesce(F.lead(owned).over(way), F.lit(False)).cast("long"))
               .withColumn("edge", F.when(owned, (F.col("n_convs") - 1) * (F.col("upto") - up)).otherwise(zero))
               .withColumn("leaf", F.max(is_leaf.cast("long")).over(Window.partitionBy("conv_id")))
               .withColumn("under", F.coalesce(F.sum("edge").over(below), zero)))
    stats = on_path.groupBy(*key).agg(
        F.min("owner").alias("conv_id"), F.min("n_convs").alias("n_convs"), F.sum("child").alias("n_children"),
        F.sum("leaf").alias("n_leaves"), F.sum("under").alias("under"),
        F.max(F.when(owned, F.struct("up_depth", "up_owner", "upto"))).alias("o"))
    full = written(stats.join(ends_digests(ends), key, "left"), "trie-stats")

    no_ids = F.lit(hashlib.sha256().hexdigest())
    is_root = F.col("depth") == 0
    depths = F.when(is_root, F.array(zero)).otherwise(F.sequence(F.col("o.up_depth") + 1, F.col("depth")))
    edges = full.select("conv_id", F.col("depth").alias("down"), "n_convs", "n_children", "n_leaves", "under", "o",
                        "ends_sha256", F.explode(F.when(is_root, F.array(zero)).otherwise(depths)).alias("depth"))
    at = F.col("depth") == F.col("down")
    bytes_at = by_turn.select("conv_id", "depth", (F.col("upto") - F.col("n_bytes")).alias("above"))
    return edges.join(bytes_at, ["conv_id", "depth"], "left").select(
        "conv_id", "depth",
        F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == F.col("o.up_depth") + 1, F.col("o.up_owner"))
        .otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(at, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"), "n_leaves",
        (F.col("under") + (F.col("n_convs") - 1) * (F.col("o.upto") - F.coalesce("above", zero))).alias("saved_tokens"),
        F.when(at, F.coalesce("ends_sha256", no_ids)).otherwise(no_ids).alias("ends_sha256"))
