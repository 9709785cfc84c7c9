"""Prefix trie of conversations from vertical bitmaps.

A shard of conversations is indexed by (position, turn): a bitset over the shard's conversations, in order of their ids. A walk in
depth starts with all of them; the set of a node, intersected with the posting of its first member's next turn, is a child, and what is
left gives the other children. The number of bits is the number of members, the lowest bit the smallest member, and the intersection with
the conversations of that length the list of those that end there.

Nodes of different shards are one node if their paths have one hash (128 bits), so shards only meet as rows that are added up. Sums over
subtrees need neither iteration nor a row per pair of ancestor and descendant: each node belongs to its smallest member, whose nodes are
the end of that conversation's path. A conversation adds what its own nodes sum up to, once, to each earlier node of its path. That is at
most one row per turn.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm.common import salted_lookup
from stratalake.sources.scratch import stage

#: A shard is full with so many conversations or turns. A conversation stays whole.
SHARD_CONVERSATIONS, SHARD_TURNS = 4096, 200_000

_ROOT = bytes(16)
_FOUND = "key binary, parent binary, depth int, size long, members long, conv_id long, ended binary, path binary"
_FOUND_ARROW = pa.schema(
    [
        ("key", pa.binary()),
        ("parent", pa.binary()),
        ("depth", pa.int32()),
        ("size", pa.int64()),
        ("members", pa.int64()),
        ("conv_id", pa.int64()),
        ("ended", pa.binary()),
        ("path", pa.binary()),
    ]
)


def describe_turns(
    turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """``conv_id``, ``place`` (from 0, by turn, null first; ties by ``digest``), ``digest`` (16 bytes that stand for role and text)
    and ``size`` (bytes of the text) of each turn. A null role or text is empty. Rows without a conversation id are left out: they belong
    to no conversation. Repeated rows are turns of their own; other columns are ignored.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(" "), role, text)
    rows = turns.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("conv_id"),
        F.col(turn_column).alias("turn"),
        F.unhex(F.md5(told.cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "digest", "size")


def share_heads(described: DataFrame, group: int = 5, lengths: int = 9) -> DataFrame:
    """Conversations that start alike: the first ``h`` turns of each become those of the first conversation of its group.

    The group of ``c`` starts with ``c - c % group``, and ``h`` is the CRC-32 of the decimal ``c`` modulo ``lengths``. All turns of that
    conversation are taken if it has fewer, none if it does not exist. Returns rows as :func:`describe_turns` does, with places that may have
    gaps, and for each conversation one row with a null digest and a null place, so that one without turns is not lost.
    Pass the turns stored, as they are read three times.
    """
    c = F.col("conv_id")
    taken = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(lengths))
    first = c - c % group
    members = described.filter("place = 0").select("conv_id", first.alias("first"), taken.alias("taken"))
    heads = described.filter((c == first) & (F.col("place") < lengths - 1)).withColumnRenamed("conv_id", "first")
    headed = members.join(heads, "first").filter("place < taken").select("conv_id", "place", "digest", "size")
    own = described.filter(F.col("place") >= taken).withColumn("place", F.col("place") + lengths)
    bare = members.select(
        "conv_id", F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size")
    )
    return headed.unionByName(own).unionByName(bare)


class Shard:
    """The bitmaps of some conversations, which are added by ascending id."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.paths: list[list[bytes]] = []
        self.sizes: dict[bytes, int] = {}
        self.turns = 0

    def add(self, conv_id: int, digest: bytes | None, size: int) -> None:
        if not self.ids or self.ids[-1] != conv_id:
            self.ids.append(conv_id)
            self.paths.append([])
        if digest is not None:
            self.paths[-1].append(digest)
            self.sizes[digest] = size
            self.turns += 1

    def full(self) -> bool:
        return len(self.ids) >= SHARD_CONVERSATIONS or self.turns >= SHARD_TURNS

    def nodes(self) -> Iterator[tuple]:
        """Rows of the found schema: one per node, and one per conversation that is the smallest of a node, with its path."""
        if not self.ids:
            return
        postings: dict[tuple[int, bytes], int] = {}
        ends: dict[int, int] = {}
        for i, path in enumerate(self.paths):
            bit = 1 << i
            for place, turn in enumerate(path):
                postings[place, turn] = postings.get((place, turn), 0) | bit
            ends[len(path)] = ends.get(len(path), 0) | bit

        yield self._path(0)
        waiting = [(_ROOT, None, 0, 0, (1 << len(self.ids)) - 1)]
        while waiting:
            key, parent, depth, size, members = waiting.pop()
            lowest = _lowest(members)
            ended = members & ends.get(depth, 0)
            yield key, parent, depth, size, members.bit_count(), self.ids[lowest], self._packed(ended), None
            left = members ^ ended
            while left:
                first = _lowest(left)
                turn = self.paths[first][depth]
                child = left & postings[depth, turn]
                left ^= child
                waiting.append((_next(key, turn), key, depth + 1, self.sizes[turn], child))
                if first != lowest:
                    yield self._path(first)

    def _packed(self, members: int) -> bytes | None:
        if not members:
            return None
        bits = np.frombuffer(members.to_bytes(len(self.ids) // 8 + 1, "little"), np.uint8)
        return np.array(self.ids, "<i8")[np.flatnonzero(np.unpackbits(bits, bitorder="little"))].tobytes()

    def _path(self, i: int) -> tuple:
        keys = [_ROOT]
        for turn in self.paths[i]:
            keys.append(_next(keys[-1], turn))
        return None, None, None, None, None, self.ids[i], None, b"".join(keys)


def _lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def _next(key: bytes, turn: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key + turn)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, out = Shard(), []

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal out
        for row in shard.nodes():
            out.append(row)
            if len(out) >= 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)
            out = []

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "digest", "size"))
        for conv_id, digest, size in zip(*columns, strict=True):
            if shard.full() and shard.ids[-1] != conv_id:
                yield from flush()
                shard = Shard()
            shard.add(conv_id, digest, size)
    yield from flush()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND_ARROW)], schema=_FOUND_ARROW)


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each key, in decimal and joined by commas, from packed lists that come in order; holds one list at a time."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    now, state, done = None, None, []
    for batch in batches:
        for key, ended in zip(batch.column("key").to_pylist(), batch.column("ended").to_pylist(), strict=True):
            said = ",".join(map(str, np.frombuffer(ended, "<i8").tolist()))
            if key == now:
                state.update(b"," + said.encode())
            else:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256(said.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], schema=schema)
            done = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], schema=schema)


def prefix_trie(described: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns, from :func:`describe_turns` or :func:`share_heads`.

    ``key`` (hash of the path), ``parent_key``, ``depth``, ``size`` (bytes of the last text), ``conv_id`` (smallest member), ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes below or at it), ``saved_tokens`` (sum, over it and all below, of the
    members but one times the size) and ``ends_sha256`` (of the decimal ids, ascending and joined by commas, of the members that end there).

    No conversations give no nodes, not even a root. Equal conversations share all nodes. A shard holds whole conversations, of each turn 16
    bytes, whatever the texts' length; turns of one conversation lie in one task, those of any number of equal ones do not. Lists of ends stay packed
    by shard until their digest, which the nature of the digest leaves to one task per node; that task reads one packed list at a time.
    """
    rows = stage(described.select("conv_id", "place", "digest", "size"), "turns")
    sorted_rows = rows.repartitionByRange("conv_id").sortWithinPartitions("conv_id", F.col("place").asc_nulls_first())
    found = stage(sorted_rows.mapInArrow(_index, _FOUND), "shard_nodes")

    merged = (
        found.filter("key is not null")
        .groupBy("key", "parent", "depth", "size")
        .agg(F.sum("members").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    )
    merged = stage(merged, "nodes")
    children = merged.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    own_sum = (F.col("n_convs") - 1) * F.col("size")
    nodes = merged.join(children, "key", "left").select(
        *merged.columns,
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        own_sum.alias("saved"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
    )
    nodes = stage(nodes, "nodes_with_children")

    # The nodes of a conversation, from its end on.
    upwards = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    along = nodes.select("key", F.sum("saved").over(upwards).alias("saved_tokens"), F.sum("leaf").over(upwards).alias("n_leaves"))
    branches = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("above"), F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves")
    )
    passed = (
        found.filter("path is not null")
        .select("conv_id", "path")
        .join(branches.filter("above > 0"), "conv_id")
        .select(F.explode(F.transform(F.sequence(F.lit(0), F.col("above") - 1), _key_at)).alias("key"), "saved_tokens", "n_leaves")
    )
    sums = along.unionByName(passed).groupBy("key").agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))

    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    with_parent = salted_lookup(nodes.filter("parent is not null").select("key", "parent"), parents, "parent", ["key"])
    lists = found.filter("ended is not null").select("key", "conv_id", "ended")
    digests = lists.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ended")
    digests = digests.mapInArrow(_list_digests, "key binary, ends_sha256 string")
    return (
        nodes.join(sums, "key")
        .join(with_parent.select("key", "parent_conv_id"), "key", "left")
        .join(digests, "key", "left")
        .select(
            "key",
            F.col("parent").alias("parent_key"),
            F.col("depth").cast("long").alias("depth"),
            "size",
            "conv_id",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def _key_at(place: Column) -> Column:
    return F.substring(F.col("path"), place * 16 + 1, F.lit(16))
