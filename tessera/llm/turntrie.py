"""Prefix trie of conversations in double arrays, one per shard of the sorted conversations.

Turns are told apart by 128 bits over role and text. A conversation is the string of its turns, cut into blocks
of ``LEVEL`` turns; a block hangs below its root, the node where the block before it ends. Blocks sorted by
(level, root, turns, conversation) are dealt to range partitions, and a task takes some hundred thousand turns at a
time: a prefix shard, whatever share of all conversations one first turn or one copied conversation has. Turns get
dense ids in the shard, the arrays BASE and CHECK are packed over them, and a walk of all conversations
through the arrays gives the nodes: the children of state s are the slots BASE[s] + id whose CHECK is s.

Sorted, the members of a node are neighbours, so only nodes on the way to a shard's first or last conversation can be
shared with other shards ("upper" nodes, roots included). Their counts are merged by key over all shards;
every other node is complete in its shard. What an upper node adds to its subtree's sums (its own part once, and what
hangs below it in each shard) is dealt to its ancestors, which are upper nodes too. Sums of deeper
levels enter at the node where they are rooted, from the deepest level up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.turns import content_key, numbered, streamed_sha256
from tessera.llm.workspace import Workspace

LEVEL = 256  # turns a block
SHARD = 200_000  # turns a trie
ROOT = bytes(16)


class DoubleArray:
    """BASE and CHECK over symbols 1..n; state 1 is the start. A slot t belongs to s if CHECK[t] = s."""

    def __init__(self, size: int):
        size += 64
        self.base, self.check, self.used = np.zeros(size, np.int64), np.zeros(size, np.int64), bytearray(size)
        self.used[0] = self.used[1] = 1
        self.low, self.high = 2, 1

    def _room(self, top: int) -> None:
        if top >= len(self.used):
            more = top + len(self.used)
            self.used.extend(bytes(more))
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.zeros(more, np.int64)))

    def add(self, state: int, symbols: list[int]) -> None:
        """Children of ``state``: the first base at which all their slots are free, or behind all slots after 64 tries."""
        least, most, used = min(symbols), max(symbols), self.used
        at = max(self.low, least + 1)
        for _ in range(64):
            at = used.find(0, at)
            if at < 0:
                break
            self._room(at - least + most)
            used = self.used
            if not any(used[at - least + x] for x in symbols):
                break
            at += 1
        else:
            at = -1
        if at < 0:
            at = max(self.high + 1, least + 1)
            self._room(at - least + most)
        base = at - least
        self.base[state] = base
        for x in symbols:
            self.used[base + x] = 1
            self.check[base + x] = state
        self.high = max(self.high, base + most)
        if self.used[self.low]:
            self.low = max(self.used.find(0, self.low), 0) or len(self.used)
            self._room(self.low)

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The state behind each (state, symbol); 0 where there is none."""
        to = self.base[states] + symbols
        to[(to >= len(self.check)) | (self.base[states] == 0)] = 0
        return np.where(self.check[to] == states, to, 0)


def pack(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> DoubleArray:
    """The double array of sorted strings: string i is symbols[starts[i] : starts[i] + sizes[i]]."""
    trie = DoubleArray(2 * len(symbols) + 2)
    rows, states = np.arange(len(sizes)), np.ones(len(sizes), np.int64)
    for depth in range(int(sizes.max(initial=0))):
        on = sizes[rows] > depth
        rows, states = rows[on], states[on]
        sym = symbols[starts[rows] + depth]
        new = np.concatenate(([True], states[1:] != states[:-1]))
        child = np.flatnonzero(new | np.concatenate(([True], sym[1:] != sym[:-1])))
        owner, ids = states[child], sym[child].tolist()
        cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        for a, b, s in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)], owner[cuts].tolist(), strict=True):
            trie.add(s, ids[a:b])
        states = trie.step(states, sym)
    return trie


NODES = ("level long, key binary, parent binary, depth long, conv long, parent_conv long, n_convs long, size long, upper boolean, "
         "goes_on boolean, n_children long, n_leaves long, saved long, ends string, ends_from long, ends_text string, ancestors array<binary>")


def shard_nodes(level, root, path, sizes, conv, goes_on, block: int) -> list[tuple]:
    """Nodes of one shard: sorted blocks (lists; ``path`` 16 bytes a turn, ``sizes`` code points of each turn)."""
    n = len(conv)
    length = np.array([len(p) // 16 for p in path], np.int64)
    turns = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), int(length.sum()), [None, pa.py_buffer(b"".join(path))]).dictionary_encode()
    codes = turns.indices.to_numpy().astype(np.int64) + 1
    contents = [ROOT, *turns.dictionary.to_pylist()]
    roots = {}
    root_id = np.array([roots.setdefault(r, len(contents) + len(roots)) for r in root], np.int64)
    at = np.cumsum(length) - length
    symbols = np.insert(codes, at, root_id)
    points = np.insert(np.array([x for s in sizes for x in s], np.int64), at, 0)
    starts = at + np.arange(n)
    trie = pack(symbols, starts, length + 1)
    conv, goes_on, level = np.array(conv, np.int64), np.array(goes_on, bool), np.array(level, np.int64)
    # the walk: a node is a run of neighbouring rows in one state
    rows, states = np.arange(n), np.ones(n, np.int64)
    layers, index, keys = [], np.zeros(len(trie.check), np.int64), []
    for depth in range(int(length.max(initial=0)) + 1):
        on = length[rows] >= depth
        rows, states = rows[on], states[on]
        sym = symbols[starts[rows] + depth]
        states = trie.step(states, sym)
        lo = np.flatnonzero(np.concatenate(([True], states[1:] != states[:-1])))
        hi = np.concatenate((lo[1:], [len(rows)]))
        first, last, state = rows[lo], rows[hi - 1], states[lo]
        parent = index[trie.check[state]] if depth else np.full(len(lo), -1)
        index[state] = len(keys) + np.arange(len(lo))
        for f, p, s in zip(first.tolist(), parent.tolist(), sym[lo].tolist(), strict=True):
            if depth == 0:
                keys.append(root[f])
            elif depth == block:  # the root of the blocks below: from root and block as a whole
                keys.append(hashlib.md5(root[f] + hashlib.md5(path[f][: 16 * block]).digest()).digest())
            else:
                keys.append(hashlib.md5(keys[p] + contents[s]).digest())
        ended = (length[rows] == depth) & ~goes_on[rows]
        layers.append((parent, first, np.minimum.reduceat(conv[rows], lo), hi - lo, points[starts[first] + depth],
                       (first == 0) | (last == n - 1) | (depth == 0), np.logical_or.reduceat((length[rows] == depth) & goes_on[rows], lo),
                       np.add.reduceat(ended, lo), np.full(len(lo), depth)))
    parent, first, low, members, size, upper, more, n_ends, depth = map(np.concatenate, zip(*layers, strict=True))
    total = len(parent)
    # from the bottom: what hangs below a node in this shard, but for upper nodes' own parts
    n_children = np.bincount(parent[(parent >= 0) & ~upper], minlength=total)
    every_child = np.bincount(parent[parent >= 0], minlength=total)
    leaves = np.where(upper | more | (every_child > 0), 0, 1)
    saved = np.where(upper, 0, (members - 1) * size)
    bounds = np.cumsum([len(x[0]) for x in layers])
    for d in range(len(layers) - 1, 0, -1):
        own = np.arange(bounds[d - 1], bounds[d])
        own = own[~upper[own]]
        np.add.at(leaves, parent[own], leaves[own])
        np.add.at(saved, parent[own], saved[own])
    out = []
    for i in range(total):
        d, p, f, up = int(depth[i]), int(parent[i]), int(first[i]), bool(upper[i])
        sha = ends_from = text = above = None
        if n_ends[i]:
            # rows that end here come first among its members, in the order of their ids, but for those that go on
            same = conv[f:f + int(members[i])][(length[f:f + int(members[i])] == d) & ~goes_on[f:f + int(members[i])]]
            text = ",".join(map(str, same.tolist()))
            ends_from = int(same[0])
            if not up:
                sha, text, ends_from = hashlib.sha256(text.encode()).hexdigest(), None, None
        if up or more[i]:
            above, q = [], i
            while q >= 0:
                above.append(keys[q])
                q = int(parent[q])
        out.append((int(level[f]), keys[i], keys[p] if d else None, int(level[f]) * block + d, int(low[i]),
                    int(low[p]) if d and not upper[p] else None, int(members[i]), int(size[i]), up, bool(more[i]), int(n_children[i]),
                    int(leaves[i]), int(saved[i]), sha, ends_from, text, above))
    return out


def trie_nodes(blocks: DataFrame, block: int, shard: int) -> DataFrame:
    """Nodes of all shards of (level, root, path, sizes, conv_id, goes_on)."""
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(),
             pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.binary())]
    names = [c.split()[0] for c in NODES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0

        def emit():
            rows = shard_nodes(*zip(*held, strict=True), block)
            for k in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 20_000], strict=True), types, strict=True)], names=names)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(row)
                turns += len(row[2]) // 16 + 1
                if turns >= shard:
                    yield from emit()
                    held, turns = [], 0
        if held:
            yield from emit()

    keys = ["level", "root", "path", "conv_id"]
    return (blocks.select("level", "root", "path", "sizes", "conv_id", "goes_on").repartitionByRange(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, NODES))


def rebuilt_turns(conversations: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, total) and (turns: conv_id, at, content, size) after the rebuilding.

    A conversation c is the first h turns of c - c % 100 and its own turns after its first h, h = crc32(c) % 6. Turns go by
    ``turn`` (null first), those of one turn by role, the text's first 64 characters and its MD5.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.substring(text, 1, 64).alias("head"), content_key(role, text).alias("content"), F.length(text).alias("size"))
    own = numbered(rows, "conv_id", ["turn", "role", "head", "content"], ws, "own")
    own = ws.put(own.select("conv_id", "pos", "content", "size"), "own")
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    heads = ws.put(own.filter("conv_id % 100 = 0 and pos < 5").withColumnRenamed("conv_id", "base"), "heads")
    lengths = heads.groupBy("base").agg(F.count("*").alias("in_base"))
    convs = (sizes.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % 6).withColumn("base", F.expr("conv_id - conv_id % 100"))
             .join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("in_base", F.lit(0))))
             .select("conv_id", "h", "base", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")))
    convs = ws.put(convs, "conversations")
    first = convs.join(heads, "base").filter("pos < h").select("conv_id", F.col("pos").alias("at"), "content", "size")
    rest = own.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("at"), "content", "size")
    return convs.select("conv_id", "total"), ws.put(first.unionByName(rest), "turns")


def in_blocks(convs: DataFrame, turns: DataFrame, ws: Workspace, block: int) -> DataFrame:
    """(level, root, path, sizes, conv_id, goes_on): conversations cut into blocks, those without a turn as one empty block."""
    rows = turns.withColumn("level", F.expr(f"at div {block}")).groupBy("conv_id", "level").agg(
        F.array_sort(F.collect_list(F.struct("at", "content", "size"))).alias("t"))
    rows = rows.select("conv_id", "level", F.unhex(F.array_join(F.transform("t", lambda r: F.hex(r["content"])), "")).alias("path"),
                       F.transform("t", lambda r: r["size"]).alias("sizes"))
    empty = convs.filter("total = 0").select("conv_id", F.lit(0).cast("long").alias("level"), F.lit(b"").alias("path"),
                                             F.array().cast("array<int>").alias("sizes"))
    rows = ws.put(rows.unionByName(empty).join(convs, "conv_id").withColumn("goes_on", F.col("total") > (F.col("level") + 1) * block), "blocks")
    start = F.lit(ROOT)
    chain = (rows.filter(f"total > {block}").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("level", F.unhex(F.md5("path")).alias("d")))).alias("ds"))
             .select(F.col("conv_id").alias("c"), F.posexplode(F.aggregate("ds", F.array(start), lambda a, x: F.concat(a, F.array(F.unhex(F.md5(F.concat(F.element_at(a, -1), x["d"]))))))).alias("l", "root")))
    chain = ws.put(chain, "roots")
    return (rows.join(chain, (F.col("conv_id") == F.col("c")) & (F.col("level") == F.col("l")), "left")
            .withColumn("root", F.coalesce("root", start)).drop("c", "l", "total"))


def merged_levels(nodes: DataFrame, ws: Workspace, top: int) -> DataFrame:
    """Whole counts of all nodes: (level, key, parent, depth, conv, parent_conv, n_convs, n_children, n_leaves, saved, ends)."""
    upper = nodes.filter("upper").groupBy("level", "key").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv").alias("conv"), F.sum("n_convs").alias("n_convs"),
        F.max("size").alias("size"), F.bool_or("goes_on").alias("goes_on"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    upper = ws.put(upper, "upper")
    shared = upper.filter("parent is not null").groupBy("level", F.col("parent").alias("key")).agg(F.count("*").alias("more_children"))
    upper = ws.put(upper.join(shared, ["level", "key"], "left").withColumn("n_children", F.col("n_children") + F.coalesce("more_children", F.lit(0))).drop("more_children"), "upper-children")
    above = ws.put(nodes.filter("ancestors is not null").select("level", "key", F.explode("ancestors").alias("to")).distinct(), "ancestors")
    lone = nodes.filter("not upper")
    parts, below = [], None
    columns = ["level", "key", "parent", "depth", "conv", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    for k in range(top, -1, -1):
        up, at = upper.filter(F.col("level") == k), f"level = {k}"
        inner = F.col("parent").isNotNull()  # the root of a level has no part of its own
        own = up.select("key", (F.col("n_leaves") + F.when(inner & (F.col("n_children") == 0) & ~F.col("goes_on"), 1).otherwise(0)).alias("l"),
                        (F.col("saved") + F.when(inner, (F.col("n_convs") - 1) * F.col("size")).otherwise(0)).alias("s"))
        if k == 0:  # a trie of no turns at all: the root is its own leaf
            own = own.join(up.select("key", F.when(~inner & (F.col("n_children") == 0), 1).otherwise(0).alias("bare")), "key").select("key", (F.col("l") + F.col("bare")).alias("l"), "s")
        late = own if below is None else own.unionByName(below.select("key", F.col("n_leaves").alias("l"), F.col("saved").alias("s")))
        late = ws.put(late, f"late-{k}")
        sums = late.join(above.filter(at).select("key", "to"), "key").groupBy(F.col("to").alias("key")).agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
        sums = ws.put(sums, f"sums-{k}")
        whole = up.drop("n_leaves", "saved").join(sums.select("key", F.col("l").alias("n_leaves"), F.col("s").alias("saved")), "key") \
            .withColumns({"parent_conv": F.lit(None).cast("long"), "ends": F.lit(None).cast("string")})
        alone = lone.filter(at)
        if below is not None:  # only nodes of levels that go on can have more below them
            hung = below.select("key", F.col("n_children").alias("c"))
            whole = whole.join(hung, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("c", F.lit(0))).drop("c")
            alone = alone.join(sums, "key", "left").join(hung, "key", "left").withColumns(
                {"n_leaves": F.col("n_leaves") + F.coalesce("l", F.lit(0)), "saved": F.col("saved") + F.coalesce("s", F.lit(0)),
                 "n_children": F.col("n_children") + F.coalesce("c", F.lit(0))})
        if k:
            below = ws.put(whole.filter("parent is null").select("key", "n_children", "n_leaves", "saved"), f"below-{k}")
            whole = whole.filter("parent is not null")
        parts += [whole.select(columns), alone.select(columns)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def conversation_trie(conversations: DataFrame, ws: Workspace, block: int = LEVEL, shard: int = SHARD) -> DataFrame:
    """A row per distinct prefix of the rebuilt conversations: (conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256).

    Null role or text is empty; rows with a null conv_id take no part; repeated rows are turns of their own. An empty
    table gives no row (there is no smallest member).
    """
    convs, turns = rebuilt_turns(conversations, ws)
    blocks = ws.put(in_blocks(convs, turns, ws, block), "rooted")
    top = blocks.agg(F.max("level")).first()[0] or 0
    nodes = ws.put(trie_nodes(blocks, block, shard), "nodes")
    merged = ws.put(merged_levels(nodes, ws, top), "merged")
    shas = streamed_sha256(nodes.filter("ends_text is not null").select("key", "ends_from", "ends_text"), "key", ["ends_from"], "ends_text", ",")
    named = ws.put(nodes.filter("upper and parent is not null or goes_on or level = 0 and parent is null")
                   .groupBy(F.col("key").alias("parent")).agg(F.min("conv").alias("known")), "named")
    out = merged.join(named, "parent", "left").join(shas, "key", "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.coalesce("parent_conv", "known").alias("parent_conv_id"), "n_convs", "n_children",
                      "n_leaves", F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends", "sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
