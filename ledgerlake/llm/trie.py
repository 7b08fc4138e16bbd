"""The prefix trie of conversations, as balanced parentheses per shard.

1. Turns get places in their conversation, and each conversation is rebuilt from the head of its base conversation and the
   rest of its own turns. A prefix is known by two running XORs of 64-bit hashes of (place, turn): running totals are
   made per sorted part and joined by one row per part, so a conversation with a third of all turns is many tasks.
2. Equal prefixes are one node. Nodes with the same smallest member and as many members lie on one path without a branch or
   an end between them: they are one chain.
3. Each distinct rebuilt conversation is the list of its chains. Sorted lists are cut into shards; a shard writes its chains
   as balanced parentheses. Range minima of the excess find the closing parenthesis of a chain and so delimit its
   subtree; ranks count the leaf pairs in it, and cumulative arrays its savings.
4. Chains on a shard's first list may also be in the shard before (a shared spine): what the shards found for one chain is
   added up, and a chain's own weight counts in the shard that opens it first.

Turns are compared by the MD5 of role length, role and text. Turns of one conversation with equal numbers are ordered by that
digest; a missing number comes first. Rows without a conversation belong to none. A null role or text is an empty one. Further
columns are not read. A table without conversations has no nodes. A list of chains is short even in a long
conversation: each of its chains needs another conversation that is as long up to there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored
from ledgerlake.operators.ranking import global_row_number

EMPTY = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "k1", "k2"]
CHAIN = ["conv_id", "n_convs"]
#: Conversations share the head of the conversation that starts their group of so many; heads have fewer turns than this.
GROUP, HEADS = 5, 9


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``c, depth, digest, size`` of every rebuilt turn, and ``c, turns`` of every conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"),
        "turn",
        F.unhex(F.md5(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    numbered = global_row_number(turns, ["c", F.col("turn").asc_nulls_first(), "digest"], "seq")
    counts = numbered.groupBy("c").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("own"))
    base = F.col("c") - F.col("c") % GROUP
    heads = F.crc32(F.col("c").cast("string").cast("binary")) % HEADS
    with_base = counts.select("c", "first", "own", base.alias("base"), heads.alias("h"))
    had = counts.select(F.col("c").alias("base"), F.col("own").alias("of_base"))
    convs = stored(with_base.join(had, "base", "left").withColumn("shared", F.least("h", F.coalesce("of_base", F.lit(0)))), "trie-convs")
    placed = numbered.join(convs.select("c", "first", "h", "shared"), "c").withColumn("place", F.col("seq") - F.col("first") + 1)
    own = placed.where("place > h").select("c", (F.col("shared") + F.col("place") - F.col("h")).alias("depth"), "digest", "size")
    head = placed.where(f"c % {GROUP} = 0 and place < {HEADS}").select(F.col("c").alias("base"), F.col("place").alias("depth"), "digest", "size")
    lent = convs.select("c", "base", "h").join(head, "base").where("depth <= h").select("c", "depth", "digest", "size")
    lengths = convs.select("c", (F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"))
    return own.unionByName(lent), lengths


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """``c, depth, k1, k2, size, bytes, turns``: the key of each conversation's prefixes and the bytes in them, root included."""
    hashed = turns.select(
        "c", "depth", "size", F.xxhash64("depth", "digest").alias("x1"), F.xxhash64("digest", F.lit("second"), "depth").alias("x2")
    )

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        x1 = x2 = size = np.int64(0)
        for batch in batches:
            if not batch.num_rows:
                continue
            c, depth, sizes, a, b = (batch.column(k).to_numpy() for k in range(5))
            r1, r2 = np.bitwise_xor.accumulate(a) ^ x1, np.bitwise_xor.accumulate(b) ^ x2
            total = np.cumsum(sizes) + size
            x1, x2, size = r1[-1], r2[-1], total[-1]
            columns = [c, depth, sizes, a, b, r1, r2, total, np.full(len(c), part, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["c", "depth", "size", "x1", "x2", "r1", "r2", "total", "part"])

    in_order = hashed.repartitionByRange("c", "depth").sortWithinPartitions("c", "depth")
    schema = "c long, depth long, size long, x1 long, x2 long, r1 long, r2 long, total long, part long"
    parts = stored(in_order.mapInArrow(running, schema), "trie-running")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("part").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("size").alias("size"))
    offsets = sums.select(
        "part",
        *[F.coalesce(f(c).over(before), F.lit(0)).alias(n) for f, c, n in ((F.bit_xor, "x1", "o1"), (F.bit_xor, "x2", "o2"), (F.sum, "size", "o"))],
    )
    # One row per written part, however many turns there are: safe to broadcast.
    whole = parts.join(F.broadcast(offsets), "part").select(
        "c", "depth", "size", "x1", "x2", F.expr("r1 ^ o1").alias("r1"), F.expr("r2 ^ o2").alias("r2"), (F.col("total") + F.col("o")).alias("total")
    )
    starts = whole.where("depth = 1").select("c", F.expr("r1 ^ x1").alias("s1"), F.expr("r2 ^ x2").alias("s2"), (F.col("total") - F.col("size")).alias("s"))
    keyed = whole.join(starts.join(lengths, "c"), "c").select(
        "c", "depth", F.expr("r1 ^ s1").alias("k1"), F.expr("r2 ^ s2").alias("k2"), "size", (F.col("total") - F.col("s")).alias("bytes"), "turns"
    )
    zero = F.lit(0).cast("long")
    roots = lengths.select("c", *[zero.alias(n) for n in ("depth", "k1", "k2", "size", "bytes")], "turns")
    return keyed.unionByName(roots)


class Parentheses:
    """Balanced parentheses (1 opens, 0 closes) with minima of the excess over blocks, in a tree."""

    def __init__(self, bits: np.ndarray, block: int = 256):
        self.excess, self.block = np.cumsum(np.where(bits, 1, -1)), block
        blocks = -(-len(bits) // block)
        self.leaves = 1 << max(0, (blocks - 1).bit_length())
        self.least = np.full(2 * self.leaves, np.iinfo(np.int64).max)
        padded = np.full(blocks * block, np.iinfo(np.int64).max)
        padded[: len(bits)] = self.excess
        self.least[self.leaves : self.leaves + blocks] = padded.reshape(blocks, block).min(1)
        for k in range(self.leaves - 1, 0, -1):
            self.least[k] = min(self.least[2 * k], self.least[2 * k + 1])

    def findclose(self, at: int) -> int:
        """Place of the parenthesis that closes the one opened at ``at``: the first later place of less excess."""
        wanted, block = self.excess[at], self.block
        end = (at // block + 1) * block
        here = np.flatnonzero(self.excess[at + 1 : end] < wanted)
        if len(here):
            return at + 1 + int(here[0])
        node = self.leaves + at // block
        while node % 2 or self.least[node + 1] >= wanted:  # up, until a block range to the right goes low enough
            node //= 2
        node += 1
        while node < self.leaves:
            node = 2 * node if self.least[2 * node] < wanted else 2 * node + 1
        start = (node - self.leaves) * block
        return start + int(np.flatnonzero(self.excess[start : start + block] < wanted)[0])


def encode(paths: Iterator[list[dict]]) -> dict:
    """Sorted lists of chains as balanced parentheses with the chains in order of opening."""
    bits, opened, nodes, parents, stack, last, first_path = [], [], [], [], [], [], None
    for path in paths:
        same = 0
        while same < min(len(path), len(last)) and path[same] == last[same]:
            same += 1
        bits += [0] * (len(stack) - same)
        del stack[same:]
        for chain in path[same:]:
            parents.append(stack[-1] if stack else -1)
            stack.append(len(nodes))
            opened.append(len(bits))
            bits.append(1)
            nodes.append(chain)
        last = path
        first_path = path if first_path is None else first_path
    bits += [0] * len(stack)
    return {"bits": np.array(bits, bool), "opened": np.array(opened, np.int64), "nodes": nodes, "parents": np.array(parents, np.int64), "first": first_path, "last": last}


def subtree_totals(trie: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each chain: leaves in its subtree, savings strictly below it, children."""
    bits, opened, nodes = trie["bits"], trie["opened"], trie["nodes"]
    tree = Parentheses(bits)
    pairs = np.zeros(len(bits) + 1, np.int64)
    is_leaf = np.zeros(len(bits), bool)
    is_leaf[opened] = [n["leaf"] for n in nodes]
    pairs[1:] = np.cumsum(bits & ~np.append(bits[1:], True) & is_leaf)  # "()" of chains that end here for good
    ranks = np.concatenate([[0], np.cumsum(bits)])
    savings = np.concatenate([[0], np.cumsum([(n["n_convs"] - 1) * n["edge"] for n in nodes])])
    closed = np.array([tree.findclose(int(p)) for p in opened], np.int64)
    leaves = pairs[closed] - pairs[opened]
    below = savings[ranks[closed]] - savings[ranks[opened] + 1]
    children = np.bincount(trie["parents"][trie["parents"] >= 0], minlength=len(nodes))
    return leaves, below, children


_TOTALS = pa.schema([
    ("part", pa.int64()), ("place", pa.int32()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("parent", pa.int64()), ("leaves", pa.int64()),
    ("below", pa.int64()), ("children", pa.int64()), ("own", pa.int64()), ("first", pa.list_(pa.string())), ("last", pa.list_(pa.string())),
])
_TOTALS_DDL = (
    "part long, place int, conv_id long, n_convs long, parent long, leaves long, below long, children long, own long, "
    "first array<string>, last array<string>"
)


def _shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    trie = encode(p.as_py() for batch in batches for p in batch.column(0))
    if not trie["nodes"]:
        return
    leaves, below, children = subtree_totals(trie)
    nodes, first = trie["nodes"], len(trie["first"])  # the first list's chains are the first ones opened
    own = [(n["n_convs"] - 1) * n["edge"] for n in nodes[:first]]
    rows = []
    for k, node in enumerate(nodes):
        spine = k < first
        up = trie["parents"][k]
        rows.append({
            "part": part, "place": k if spine else None, "conv_id": node["conv_id"], "n_convs": node["n_convs"],
            "parent": nodes[up]["conv_id"] if up >= 0 else None, "leaves": int(leaves[k]),
            "below": int(below[k]) - (sum(own[k + 1 :]) if spine else 0), "children": int(children[k]) - (1 if k + 1 < first else 0),
            "own": own[k] if spine else None,
        })
    name = lambda path: [f"{n['conv_id']}:{n['n_convs']}" for n in path]
    rows.append({"part": part, "first": name(trie["first"]), "last": name(trie["last"])})
    for a in range(0, len(rows), 1 << 15):
        yield pa.RecordBatch.from_pylist(rows[a : a + (1 << 15)], _TOTALS)


def chain_totals(paths: DataFrame) -> DataFrame:
    """``conv_id, n_convs, parent, leaves, below, children`` of every chain, from the sorted lists of all."""
    shards = stored(paths.select("path").repartitionByRange("path").sortWithinPartitions("path").mapInArrow(_shard_rows, _TOTALS_DDL), "trie-shards")
    # One row per shard: how much of its first list the shard before has open at its end.
    edges = shards.where("first is not null").select("part", "first", F.lag("last").over(Window.orderBy("part")).alias("before"))
    differs = F.zip_with("first", "before", lambda a, b: ~F.coalesce(a == b, F.lit(False)))
    met = F.when(F.col("before").isNull(), 0).otherwise(F.array_position(differs, True) - 1)
    spines = shards.where("place is not null").join(F.broadcast(edges.select("part", met.alias("met"))), "part")
    later = Window.partitionBy("part").orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)
    opened = F.when(F.col("place") >= F.col("met"), F.col("own")).otherwise(0)
    more = spines.select(
        *CHAIN,
        F.coalesce(F.sum(opened).over(later), F.lit(0)).alias("below"),
        F.coalesce(F.lag((F.col("place") >= F.col("met")).cast("long")).over(Window.partitionBy("part").orderBy(F.desc("place"))), F.lit(0)).alias("children"),
    )
    found = shards.where("conv_id is not null").select(*CHAIN, "parent", "leaves", "below", "children")
    both = found.unionByName(more, allowMissingColumns=True)
    return both.groupBy(*CHAIN).agg(F.max("parent").alias("parent"), *[F.sum(c).alias(c) for c in ("leaves", "below", "children")])


def member_digests(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256``: of the ids in each group, in order and joined by commas.

    Sorted parts finish the groups that lie inside them. A group that crosses a border sends its joined ids in pieces,
    and the pieces are hashed as they come, so no group is held.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, key = TaskContext.get().partitionId(), 0, None
        held: list[int] = []
        in_pieces = True  # the first group may have begun in the part before
        rows: list[dict] = []

        def joined() -> str:
            return ",".join(map(str, held))

        def piece() -> None:
            nonlocal number
            if held:
                rows.append({**dict(zip(KEY, key, strict=True)), "part": part, "number": number, "piece": joined()})
                number += 1
                held.clear()

        for batch in batches:
            for *at, c in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if at != key:
                    if key is not None:
                        if in_pieces:
                            piece()
                        else:
                            rows.append({**dict(zip(KEY, key, strict=True)), "sha": hashlib.sha256(joined().encode()).hexdigest()})
                            held.clear()
                        in_pieces = False
                    key = at
                held.append(c)
                if len(held) >= 1 << 16:
                    piece()
                    in_pieces = True
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows.clear()
        piece()  # the last group may go on in the part after
        yield pa.RecordBatch.from_pylist(rows, schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, rows = None, None, []
        for batch in batches:
            for *at, piece in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 5)), strict=True):
                if at != key:
                    if key is not None:
                        rows.append({**dict(zip(KEY, key, strict=True)), "ends_sha256": digest.hexdigest()})
                    key, digest = at, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
        if key is not None:
            rows.append({**dict(zip(KEY, key, strict=True)), "ends_sha256": digest.hexdigest()})
        yield pa.RecordBatch.from_pylist(rows, done)

    keys = [("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())]
    schema = pa.schema([*keys, ("part", pa.int64()), ("number", pa.int64()), ("piece", pa.string()), ("sha", pa.string())])
    done = pa.schema([*keys, ("ends_sha256", pa.string())])
    ddl = "depth long, k1 long, k2 long"
    in_order = ends.select(*KEY, "c").repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c")
    found = stored(in_order.mapInArrow(parts, f"{ddl}, part long, number long, piece string, sha string"), "trie-ends")
    crossing = found.where("sha is null").drop("sha").repartition(*KEY).sortWithinPartitions(*KEY, "part", "number")
    whole = found.where("sha is not null").select(*KEY, F.col("sha").alias("ends_sha256"))
    return whole.unionByName(crossing.mapInArrow(join, f"{ddl}, ends_sha256 string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    turns, lengths = rebuilt_turns(conversations)
    rows = stored(prefixes(turns, lengths), "trie-prefixes")
    ended = F.col("depth") == F.col("turns")
    nodes = stored(
        rows.groupBy(*KEY).agg(
            F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("size").alias("size"), F.min("bytes").alias("bytes"),
            F.count_if(ended).alias("ends"), F.min(F.when(ended, F.col("c"))).alias("ending"),
        ),
        "trie-nodes",
    )
    last = F.max(F.struct("depth", "k1", "k2", "bytes", "ends", "ending")).alias("last")
    chains = stored(nodes.groupBy(*CHAIN).agg(F.min("depth").alias("top"), F.sum("size").alias("edge"), last).select(*CHAIN, "top", "edge", "last.*"), "trie-chains")
    distinct = chains.where("ends > 0").select(F.col("ending").alias("c"))
    leaf = (F.col("ends") == F.col("n_convs")).alias("leaf")
    on_path = rows.select("c", *KEY).join(distinct, "c", "left_semi").join(chains.select(*KEY, *CHAIN, "edge", leaf), KEY)
    paths = on_path.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("depth", *CHAIN, "edge", "leaf"))).alias("path"))
    totals = chains.select(*CHAIN, "top", F.col("depth").alias("bottom"), F.col("bytes").alias("to_bottom")).join(chain_totals(paths), CHAIN)
    digests = member_digests(rows.where(ended))
    parent = F.when(F.col("depth") == F.col("top"), F.col("parent")).otherwise(F.col("conv_id"))
    saved = F.col("below") + (F.col("n_convs") - 1) * (F.col("to_bottom") - F.col("bytes") + F.col("size"))
    return (
        nodes.join(totals, CHAIN)
        .join(digests, KEY, "left")
        .select(
            "conv_id", "depth", F.when(F.col("depth") > 0, parent).alias("parent_conv_id"), "n_convs",
            F.when(F.col("depth") == F.col("bottom"), F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
            F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )
