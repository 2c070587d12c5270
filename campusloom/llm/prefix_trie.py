"""Prefix trie of conversations as a burst trie.

A turn's id is the digest of its role and text. Equal conversations are one suffix, so the trie holds each
sequence of ids once, with its number of members. All suffixes start in one container under the
root. While a container holds more than `limit` suffixes, it bursts: the ids that all of them share
become a chain of trie heads, and each next turn id gets a container of its own. Counts find the
large containers, the smallest and the largest suffix their shared ids, so a round goes down to
the next branching however deep it lies. The remaining containers are dealt to tasks, sorted by
Spark and swept once: a stack holds the open nodes, and a node is written when the next suffix leaves it.
Heads then add up what their containers found, from the last round back to the root.

Conversations are built in order of turn (null first; equal turns by role, then by digest). A null role
or text counts as empty. Rows with a null conv_id belong to no conversation and are left out. Repeated
rows are turns of their own. Conversations without turns are members of the root. Other columns are
ignored; no rows give no rows. One conversation is one row of 24 bytes a turn, sweeps hold one path,
and the ids of a node's members are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.basics import bound
from ..operators.blocks import looked_up
from .shared import cut

_ID = 24  # bytes of a turn id: 16 of the digest, 8 of the text's length in code points
_NOTHING = hashlib.sha256(b"").hexdigest()
_CHUNK = 4096
_NODE = "pk binary, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_id(role: Column, text: Column) -> Column:
    """The digest of role and text, then the number of code points of the text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    return F.concat(digest, F.unhex(F.lpad(F.hex(F.length(text).cast("long")), 16, "0")))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, ids) of turns (conv_id, turn, role, text)."""
    slim = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), turn_id(F.col("role"), F.col("text")).alias("id")
    )
    grouped = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "id"))).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda t: t["id"]).alias("ids"))


def rebuilt(convs: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversation c starts with the first h turns of c - c % every, then its own after its first h; h = crc32(c) % most."""
    heads = convs.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("ids", 1, most - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = convs.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % every, "_h": h})
    none = F.array().cast("array<binary>")
    first = F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h"))
    rest = F.when(F.size("ids") > F.col("_h"), F.expr("slice(ids, _h + 1, greatest(size(ids) - _h, 0))")).otherwise(none)
    return own.join(heads, "_base", "left").select("conv_id", F.concat(first, rest).alias("ids"))


def members_hash(members: DataFrame) -> DataFrame:
    """(key, sha): of members (key, conv_id) the SHA-256 of their ids in ascending order, joined by commas.

    Ids of a stretch of numbers are joined first, in tasks of their own; then each key's strings go
    through the hash one after the other.
    """
    joined = members.groupBy("key", F.floor(F.col("conv_id") / _CHUNK).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        keys: list[bytes] = []
        shas: list[str] = []
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k == key:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    keys.append(key)
                    shas.append(state.hexdigest())
                key, state = k, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], ["key", "sha"])
            keys, shas = [], []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "sha"])

    return joined.repartition("key").sortWithinPartitions("key", "part").select("key", "ids").mapInArrow(run, "key binary, sha string")


def suffixes(convs: DataFrame) -> DataFrame:
    """(key, ids, n, conv, ends) of conversations (conv_id, ids): each sequence once, with its members."""
    keyed = cut(convs.withColumn("key", F.unhex(F.md5(F.array_join(F.transform("ids", F.hex), "")))), "conversations")
    classes = keyed.groupBy("key", "ids").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
    return classes.join(members_hash(keyed.select("key", "conv_id")).withColumnRenamed("sha", "ends"), "key")


def _shared(a: Column, b: Column) -> Column:
    """How many elements two arrays start with in common."""
    both = F.least(F.size(a), F.size(b))
    first = F.array_min(F.filter(F.sequence(F.lit(0), both - 1), lambda i: F.get(a, i) != F.get(b, i)))
    return F.when(both > 0, F.coalesce(first, both)).otherwise(0)


def _burst(rows: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Heads of the large containers, and their suffixes one container further down (null where a suffix ends)."""
    live = looked_up(rows, ["c"], large, "key", "inner")
    heads = live.groupBy("c").agg(
        F.sum("n").alias("n_convs"), F.min("conv").alias("conv_id"), F.min("ids").alias("low"), F.max("ids").alias("high"), F.min("d").alias("d"), F.min("parent").alias("parent"), F.min("pk").alias("pk")
    )
    heads = cut(heads.withColumn("e", _shared(F.col("low"), F.col("high"))).drop("high"), "heads")
    place = heads.select("c", "e", F.col("conv_id").alias("_parent"))
    down = looked_up(live.drop("d", "parent", "pk"), ["c"], place, "key")
    next_ = F.get("ids", F.col("e"))
    child = F.when(next_.isNotNull(), F.unhex(F.md5(F.concat(F.col("c"), next_))))
    return heads, down.select("key", "ids", "n", "conv", "ends", child.alias("c"), (F.col("e") + 1).alias("d"), F.col("_parent").alias("parent"), F.col("c").alias("pk"))


def _length(id_: bytes) -> int:
    return int.from_bytes(id_[16:], "big")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted suffixes, container by container. An open node: depth, text length, smallest member, members, ends, written children, leaves, saved, rows of children."""
    names = [f.split()[0] for f in _NODE.split(", ")]
    out: list[tuple] = []
    path: list[list] = []
    container = pk = parent = None
    before: list[bytes] = []

    def close(down_to: int) -> None:
        while path and path[-1][0] > down_to:
            depth, length, conv, n, ends, children, leaves, saved, waiting = path.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * length
            out.extend((None, c[0], c[1], conv, *c[2:]) for c in waiting)
            row = (conv, depth, n, children, leaves, saved, ends)
            if path:
                up = path[-1]
                up[2], up[3], up[5], up[6], up[7] = min(up[2], conv), up[3] + n, up[5] + 1, up[6] + leaves, up[7] + saved
                up[8].append(row)
            else:
                out.append((pk, conv, depth, parent, *row[2:]))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(names)
        types = [pa.binary(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string()]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        out.clear()
        return made

    for rows in batches:
        for row in rows.to_pylist():
            ids, top = row["ids"], row["d"]
            if row["c"] != container:
                close(-1)
                container, pk, parent, before = row["c"], row["pk"], row["parent"], ids[:top]
                path.append([top, _length(ids[top - 1]) if top else 0, row["conv"], 0, _NOTHING, 0, 0, 0, []])
            same = top
            for a, b in zip(before[top:], ids[top:]):
                if a != b:
                    break
                same += 1
            close(same)
            path.extend([k + 1, _length(ids[k]), row["conv"], 0, _NOTHING, 0, 0, 0, []] for k in range(same, len(ids)))
            last = path[-1]
            last[2], last[3], last[4] = min(last[2], row["conv"]), last[3] + row["n"], row["ends"]
            before = ids
        if len(out) > 10_000:
            yield batch()
    close(-1)
    yield batch()


def _head_nodes(heads: DataFrame, ends: DataFrame, tops: DataFrame, n_children: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the chains of heads, and the heads' own top nodes in short (pk, n_leaves, saved_tokens)."""
    sums = tops.groupBy(F.col("pk").alias("c")).agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    own = heads.join(sums, "c", "left").join(n_children, "c", "left").join(ends, "c", "left")
    sizes = F.concat(F.array(F.lit(0).cast("long")), F.transform("low", lambda i: F.conv(F.hex(F.substring(i, 17, 8)), 16, 10).cast("long")))
    chain = F.slice(sizes, F.col("d") + 1, F.col("e") - F.col("d") + 1)
    own = own.select("c", "pk", "conv_id", "parent", "d", "e", "n_convs", F.coalesce("children", F.lit(0)).alias("children"), F.coalesce("leaves", F.lit(1)).cast("long").alias("leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved"), "sha", chain.alias("sizes"))
    added = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, s: a + s) * (F.col("n_convs") - 1)
    top = own.select("pk", F.col("leaves").alias("n_leaves"), (F.col("saved") + added).alias("saved_tokens"))
    # Longest first: what a node saves is its own size and those below it.
    summed = F.aggregate(
        F.reverse("sizes"), F.array().cast("array<long>"), lambda a, s: bound(F.coalesce(F.try_element_at(a, F.lit(1)), F.lit(0)) + s, lambda t: F.concat(F.array(t), a))
    )
    each = own.select("*", F.posexplode(summed).alias("place", "below"))
    last = F.col("d") + F.col("place") == F.col("e")
    nodes = each.select(
        "conv_id", (F.col("d") + F.col("place")).alias("depth"), F.when(F.col("place") == 0, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("saved") + F.col("below") * (F.col("n_convs") - 1)).alias("saved_tokens"), F.when(last & F.col("sha").isNotNull(), F.col("sha")).otherwise(F.lit(_NOTHING)).alias("ends_sha256"),
    )
    return nodes, top


def prefix_trie(convs: DataFrame, limit: int = 4096) -> DataFrame:
    """Nodes of the trie of conversations (conv_id, ids): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    none = F.lit(None)
    rows = suffixes(convs).withColumns({"c": F.lit(b""), "d": F.lit(0), "parent": none.cast("long"), "pk": none.cast("binary")})
    rows = cut(rows, "suffixes")
    rest: list[DataFrame] = []
    rounds: list[tuple[DataFrame, DataFrame, DataFrame]] = []
    while True:
        large = cut(rows.groupBy("c").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select("c"), "large")
        if large.isEmpty():
            rest.append(rows)
            break
        marked = looked_up(rows, ["c"], large.withColumn("_large", F.lit(True)), "key")
        rest.append(marked.filter(F.col("_large").isNull()).drop("_large"))
        heads, down = _burst(rows, large)
        down = cut(down, "suffixes")
        ends = down.filter(F.col("c").isNull()).select(F.col("pk").alias("c"), F.col("ends").alias("sha"))
        rows = down.filter(F.col("c").isNotNull())
        rounds.append((heads, ends, rows.select("pk", "c").distinct().groupBy(F.col("pk").alias("c")).agg(F.count(F.lit(1)).alias("children"))))
    held = rest[0]
    for more in rest[1:]:
        held = held.unionByName(more)
    dealt = held.repartition("c").sortWithinPartitions("c", "ids").select("c", "ids", "d", "pk", "parent", "conv", "n", "ends")
    swept = cut(dealt.mapInArrow(_sweep, _NODE), "nodes")
    tops = swept.filter(F.col("pk").isNotNull()).select("pk", "n_leaves", "saved_tokens")
    nodes = swept.drop("pk")
    for heads, ends, n_children in reversed(rounds):
        found, top = _head_nodes(heads, ends, tops, n_children)
        nodes, tops = nodes.unionByName(found), tops.unionByName(top)
    return nodes


def conversation_trie(turns: DataFrame, limit: int = 4096) -> DataFrame:
    """The trie of the rebuilt conversations of turns (conv_id, turn, role, text)."""
    return prefix_trie(rebuilt(conversations(turns)), limit)
