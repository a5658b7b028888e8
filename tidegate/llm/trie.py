"""Prefix trie of conversations by fixed-length block hashing.

A turn is a digest of its role and text, a prefix the sum of its turns' hashes with their
positions, 128 bits wide. Conversations meet by the prefixes at the ends of blocks of
several turns first. Where all conversations that enter a block leave it by the same
prefix, the block is one unit, a path of nodes with the same members; only where siblings
diverge are the turns inside the block told apart.

Sums over subtrees need no walk over the trie. A node is owned by its smallest member, and
a conversation that owns a node owns all deeper nodes on its way. So each conversation
hangs on the trie at one depth, and what a node needs of its subtree (children, leaves,
tokens shared) are sums over its members of one number each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import with_group_sequence
from ..operators.skew import heavy_keys, salted_left_join
from .shared import staged

#: Ids that are joined to one piece of a node's list before it is hashed.
LIST_PIECE = 1 << 16
ROOT = bytes(16)


def numbered(conversations: DataFrame) -> DataFrame:
    """`conv_id, pos, chars, digest`: the turns in order, counted from 1 in each conversation.

    Ordered by `turn`, null first; turns of one number by length and digest, so the order
    is the same in every run. Null role and text are empty. Rows without a `conv_id`
    belong to no conversation. Texts stay where they lie; other columns are not read.
    """
    c = lambda name: conversations[f"`{name}`"]
    role, text = F.coalesce(c("role"), F.lit("")), F.coalesce(c("text"), F.lit(""))
    body = F.concat_ws("", F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        c("conv_id").cast("long").alias("conv_id"),
        c("turn").alias("turn"),
        F.char_length(text).cast("long").alias("chars"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
    ).where("conv_id IS NOT NULL")
    order = [F.col("turn").asc_nulls_first(), F.col("chars"), F.col("digest")]
    return with_group_sequence(rows, "conv_id", order, "pos").drop("turn")


def with_shared_heads(turns: DataFrame, family: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of their family's head.

    Conversation c takes its first h turns from conversation c - c % `family` (all, if
    that one is shorter; none, if it is absent) and goes on with its own turns after its
    first h; h is the CRC-32 of its decimal id modulo `most` + 1. Returns the turns
    (as `numbered`, with the conversation's length `n_turns`) and all `conv_id, n_turns`,
    also of conversations without turns.
    """
    sizes = staged(turns.groupBy("conv_id").agg(F.count("*").alias("own")), "conversations")
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("own").alias("of_head"))
    plan = sizes.select(
        "*",
        (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % family).alias("head"),
    ).join(heads, "head", "left")
    taken = F.least("h", F.coalesce("of_head", F.lit(0)))
    rest = F.greatest(F.col("own") - F.col("h"), F.lit(0))
    plan = staged(plan.withColumn("taken", taken).withColumn("n_turns", taken + rest), "rebuilt")

    shift = plan.select("conv_id", "h", "taken", "n_turns")
    own = salted_left_join(turns, shift, "conv_id", heavy_keys(turns, "conv_id"), F.col("pos"))
    pos = (F.col("pos") - F.col("h") + F.col("taken")).alias("pos")
    own = own.where("pos > h").select("conv_id", pos, "chars", "digest", "n_turns")
    first = turns.where((F.col("pos") <= most) & (F.col("conv_id") % family == 0))
    first = first.withColumnRenamed("conv_id", "head").join(
        plan.where("taken > 0").select("conv_id", "head", "taken", "n_turns"), "head"
    )
    first = first.where("pos <= taken").select("conv_id", F.col("pos").cast("long"), "chars", "digest", "n_turns")
    return own.unionByName(first), plan.select("conv_id", "n_turns")


def _running(conv: np.ndarray, values: np.ndarray, before: tuple | None) -> np.ndarray:
    """Sums along each run of equal ids, modulo 2^64; `before` is the last (id, sum)."""
    total = np.cumsum(values)
    first = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1))
    runs = np.diff(first, append=len(conv))
    start = total[first] - values[first]
    if before is not None and conv[0] == before[0]:
        start[0] -= before[1]
    return total - np.repeat(start, runs)


def _binary(a: np.ndarray, b: np.ndarray) -> pa.Array:
    body = np.stack([a, b], 1).tobytes()
    offsets = np.arange(0, 16 * len(a) + 1, 16, dtype=np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(a), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body)]
    )


def with_prefixes(turns: DataFrame) -> DataFrame:
    """Add to each turn the prefix up to it (`key`), the one before it (`parent`), and the
    characters before it (`ahead`).

    The turns lie in ranges of (conversation, position), so that one of any length is cut;
    sums run within a range, and one line per range tells what the range before held of
    the conversation that goes on.
    """
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lanes = turns.select(
        "conv_id", F.col("pos").cast("long"), "n_turns", "chars",
        F.xxhash64("pos", "digest").alias("a"), F.xxhash64("digest", "pos").alias("b"),
    )
    names = ["conv_id", "pos", "n_turns", "chars", "a", "b"]
    sums = ["sum_a", "sum_b", "sum_chars"]

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, tuple] = {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            conv, out = own[0], []
            for name, values in zip(sums, (own[4], own[5], own[3])):
                out.append(_running(conv, values, last.get(name)))
                last[name] = (conv[-1], out[-1][-1])
            arrays = [pa.array(x) for x in (*own, *out, np.full(len(conv), part, np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *sums, "part"])

    schema = ", ".join(f"{n} long" for n in [*names, *sums, "part"])
    ranged = lanes.repartitionByRange(parts, "conv_id", "pos").sortWithinPartitions("conv_id", "pos")
    local = staged(ranged.mapInArrow(along, schema), "ranges")
    state = F.struct("conv_id", "pos", *sums)
    edges = local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(state).alias("last"))
    carried, open_conv, held = {}, None, np.zeros(3, np.int64)
    for part, first, last in sorted(edges.collect(), key=lambda r: r[0]):
        mine = np.array(last[2:], np.int64)
        if first == open_conv:
            carried[part] = (first, held)
        if last[0] == first == open_conv:
            held = held + mine
        else:
            held = mine
        open_conv = last[0]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = dict(zip(batch.schema.names, (c.to_numpy(zero_copy_only=False) for c in batch.columns)))
            a, b, chars = (x[n].copy() for n in sums)
            for part in np.unique(x["part"]).tolist():
                if part in carried:
                    conv, held = carried[part]
                    goes_on = (x["part"] == part) & (x["conv_id"] == conv)
                    a[goes_on] += held[0]
                    b[goes_on] += held[1]
                    chars[goes_on] += held[2]
            plain = [x["conv_id"], x["pos"], x["n_turns"], x["chars"], chars - x["chars"], a]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, plain), _binary(a, b), _binary(a - x["a"], b - x["b"])],
                ["conv_id", "pos", "n_turns", "chars", "ahead", "lane", "key", "parent"],
            )

    return local.mapInArrow(
        finish,
        "conv_id long, pos long, n_turns long, chars long, ahead long, lane long, key binary, parent binary",
    )


def units(turns: DataFrame, block: int = 4) -> DataFrame:
    """Paths of the trie that conversations follow: whole blocks, or turns where siblings diverge.

    One row per conversation and unit: `conv_id, n_turns, key` (prefix at its end),
    `parent` (prefix before it), `first, last` (positions), `ahead` (characters before it),
    `lens` (characters of its turns).
    """
    turn = F.struct("pos", "chars", "ahead", "lane", "key", "parent")
    blocks = staged(
        with_prefixes(turns)
        .groupBy("conv_id", F.floor((F.col("pos") - 1) / F.lit(block)).alias("block"))
        .agg(F.max("n_turns").alias("n_turns"), F.sort_array(F.collect_list(turn)).alias("turns"))
        .withColumn("start", F.col("turns")[0]["parent"])
        .withColumn("end", F.element_at("turns", -1)),
        "blocks",
    )
    # Equal prefixes have equal lengths and equal halves, so whole numbers tell them apart.
    ends = {"pos": F.col("end.pos"), "lane": F.col("end.lane"), "other": F.xxhash64("end.key")}
    differ = F.lit(False)
    for value in ends.values():
        differ = differ | (F.min(value) != F.max(value))
    diverge = staged(blocks.groupBy("start").agg(differ.alias("diverges")), "diverging")
    spread = F.xxhash64("conv_id", "block")
    marked = salted_left_join(blocks, diverge, "start", heavy_keys(blocks, "start"), spread)
    one = ["conv_id", "n_turns"]
    whole = marked.where("NOT diverges").select(
        *one,
        F.col("end.key").alias("key"),
        F.col("start").alias("parent"),
        F.col("turns")[0]["pos"].alias("first"),
        F.col("end.pos").alias("last"),
        F.col("turns")[0]["ahead"].alias("ahead"),
        F.col("turns.chars").alias("lens"),
    )
    apart = marked.where("diverges").select(*one, F.explode("turns").alias("t"))
    apart = apart.select(
        *one,
        "t.key",
        "t.parent",
        F.col("t.pos").alias("first"),
        F.col("t.pos").alias("last"),
        "t.ahead",
        F.array("t.chars").alias("lens"),
    )
    return whole.unionByName(apart)


def _list_hashes(members: DataFrame) -> DataFrame:
    """`key, ends_sha256` for rows `key, conv_id`: the hash of each key's ids, ascending.

    A hash runs over its text from end to end, so ids are sorted and joined to long pieces
    in ranges first, and one task per key reads the few pieces as they come.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        out: list[tuple] = []
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (k != key or len(ids) >= LIST_PIECE):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            yield _rows(out)
            out = []
        if ids:
            yield _rows([(key, ids[0], ",".join(map(str, ids)))])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [(), (), ()]
        kinds = [pa.binary(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "first", "ids"]
        )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            keys, digests = [], []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if running is not None and k == key:
                    running.update(b",")
                else:
                    if running is not None:
                        keys.append(key)
                        digests.append(running.hexdigest())
                    key, running = k, hashlib.sha256()
                running.update(ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"]
            )
        if running is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"]
            )

    ranged = members.select("key", "conv_id").repartitionByRange(parts, "key", "conv_id")
    ranged = ranged.sortWithinPartitions("key", "conv_id")
    pieces = ranged.mapInArrow(join, "key binary, first long, ids string")
    together = pieces.repartition(parts, "key").sortWithinPartitions("key", "first")
    return together.mapInArrow(hashed, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame, block: int = 4) -> DataFrame:
    """All nodes of the trie over `turns` (`conv_id, pos, chars, digest, n_turns`).

    `members` lists every conversation once (`conv_id, n_turns`), also those without turns.
    One row per distinct prefix, the empty one included: `conv_id` (smallest member),
    `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves` (childless nodes in the
    subtree), `saved_tokens` (over the subtree, members but one times the characters of the
    node's last turn) and `ends_sha256` (SHA-256 of the members that end there, ascending).

    Equal conversations end in one node; ties, nulls and repeated rows are settled by
    `numbered`. A conversation of any length, and a prefix shared by any number of
    conversations, are spread over the tasks. Without members there is no node.
    """
    at = staged(units(turns, block), "units")
    ends_here = (F.col("last") == F.col("n_turns")).cast("long")
    owners = at.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("first").alias("first"),
        F.min("ahead").alias("ahead"),
        (F.sum(ends_here) == F.count("*")).alias("leaf"),
    )
    owners = owners.groupBy("conv_id").agg(
        F.min("first").alias("owns_from"), F.min("ahead").alias("shared"), F.max("leaf").alias("leaf")
    )
    own_chars = F.aggregate("lens", F.lit(0).cast("long"), lambda s, x: s + x)
    ends = at.where("last = n_turns").select("conv_id", "key", (F.col("ahead") + own_chars).alias("total"))
    ends = members.join(ends, "conv_id", "left").withColumn("key", F.coalesce("key", F.lit(ROOT)))
    ends = staged(ends, "ends")
    facts = staged(
        ends.join(owners, "conv_id", "left").select(
            "conv_id",
            F.coalesce("owns_from", F.lit(0)).alias("owns_from"),  # 0: all its nodes have smaller members
            F.coalesce("shared", "total", F.lit(0)).alias("shared"),
            F.coalesce("leaf", F.lit(False)).cast("long").alias("leaf"),
        ),
        "members",
    )
    joined = salted_left_join(at, facts, "conv_id", heavy_keys(at, "conv_id"), F.xxhash64("key"))
    branches = (F.col("owns_from") == F.col("last") + 1).cast("long")
    owner = F.struct("conv_id", "shared", "n_turns", "owns_from", "lens", "parent")
    nodes = staged(
        joined.groupBy("key")
        .agg(
            F.min(owner).alias("owner"),
            F.count("*").alias("n_convs"),
            F.sum("shared").alias("shared"),
            F.sum("leaf").alias("n_leaves"),
            F.sum(branches).alias("branches"),
            F.min("first").alias("first"),
            F.min("last").alias("last"),
            F.min("ahead").alias("ahead"),
        )
        .withColumn("parent", F.col("owner.parent")),
        "nodes",
    )
    tops = nodes.where("first = 1").count()
    least = members.agg(F.min("conv_id")).first()[0]

    # The owner of a node owns its parent too, unless it hangs on the trie right there.
    hangs = (F.col("owner.owns_from") == F.col("first")) & (F.col("first") > 1)
    lookup = nodes.select(F.col("key").alias("parent"), F.col("owner.conv_id").alias("above"))
    below = nodes.where(hangs)
    below = salted_left_join(below, lookup, "parent", heavy_keys(below, "parent"), F.xxhash64("key"))
    above = F.when(F.col("first") == 1, F.lit(least)).otherwise(F.col("owner.conv_id"))
    known = nodes.where(~hangs).withColumn("above", above).unionByName(below)

    step = known.select("*", F.posexplode("owner.lens").alias("step", "_"))
    before = F.aggregate(F.slice("owner.lens", F.lit(1), F.col("step")), F.lit(0).cast("long"), lambda s, x: s + x)
    at_end = F.col("step") == F.size("owner.lens") - 1
    goes_on = (F.col("owner.n_turns") > F.col("last")).cast("long")
    saved = (
        F.col("shared") - F.col("owner.shared") - (F.col("n_convs") - 1) * (F.col("ahead") + before)
    )
    rows = step.select(
        F.col("owner.conv_id").alias("conv_id"),
        (F.col("first") + F.col("step")).alias("depth"),
        F.when(F.col("step") > 0, F.col("owner.conv_id")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs",
        F.when(at_end, F.col("branches") + goes_on).otherwise(F.lit(1)).alias("n_children"),
        "n_leaves",
        saved.alias("saved_tokens"),
        F.when(at_end, F.col("key")).alias("key"),
    )
    root = facts.agg(
        F.min("conv_id").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.lit(tops).cast("long").alias("n_children"),
        (F.sum("leaf") if tops else F.lit(1)).cast("long").alias("n_leaves"),
        F.sum("shared").alias("saved_tokens"),
        F.lit(ROOT).alias("key"),
    ).where("conv_id IS NOT NULL")
    hashes = _list_hashes(ends)
    none = hashlib.sha256().hexdigest()
    longs = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    # Inner nodes of a unit end no conversation; they need not meet the hashes.
    ending = rows.where("key IS NOT NULL").unionByName(root).join(hashes, "key", "left")
    inner = rows.where("key IS NULL").withColumn("ends_sha256", F.lit(None).cast("string"))
    return (
        ending.unionByName(inner)
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
        .select(*[F.col(c).cast("long").alias(c) for c in longs], "ends_sha256")
    )
