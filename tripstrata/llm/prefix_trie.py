"""The prefixes that conversations share, from a compacted trie that is searched by depth.

A conversation is a string of turns. Its prefixes are known by 128-bit digests, each made of the one before and the
next turn, so equal digests mean equal prefixes and a prefix of any length is compared at once.

1. *Nodes.* A node of the compacted trie stands where conversations part or end. It holds the digests along the edge
   from its parent, and is found by its *handle*: the digest at the depth in that edge which the most powers of two
   divide (the two-fattest one).
2. *Search.* A conversation halves the range of depths by two-fattest steps; a handle found moves the lower end to
   that node, one not found moves the upper end. After about log2(turns) joins of all conversations of a batch with
   the handles it knows the edge in which it leaves the trie.
3. *Batches.* Conversations enter in batches by a hash of their ids, each ``GROWTH`` times the trie so far. Those that
   leave the trie by one new turn are compared among themselves, sorted, in one place; as an eighth of all came before
   at random, such groups stay small whatever the data (a group of g is passed over with a chance of (8/9)^g;
   equal conversations count once). Edges that were left midway are cut there.
4. *Sums.* Each distinct end passes its counts and sizes up to the nodes on its path, added up before any exchange;
   then edges are expanded to their single turns.

Rows are ordered by turn (NULL first), ties by role and then by digest. NULL roles and texts are empty; rows without a
``conv_id`` belong to no conversation and are left out. Further columns are ignored; no rows give no nodes. The digests of
one conversation (24 bytes a turn), not its texts, have to fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripstrata.llm.components import no_rows, written
from tripstrata.llm.runs import by_key, whole_groups

FIRST_BATCH, GROWTH = 4096, 8
_SCALE = 1 << 40
WIDTH = 16
ROOT = bytes(WIDTH)
_PATH = "conv_id long, path binary, sizes array<long>"
_NODE = "key binary, parent binary, low int, depth int, edge binary, sizes array<long>"
_EMPTY = hashlib.sha256(b"").hexdigest()


def _in_order(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turn_key, size)``: turns counted from 0, and digests instead of texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    said = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256).alias("turn_key"),
        F.octet_length(text).cast("long").alias("size"),
        role.alias("role"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "turn_key")
    placed = said.withColumn("place", F.row_number().over(order) - 1)
    return placed.select("conv_id", "place", F.unhex("turn_key").alias("turn_key"), "size")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``(conv_id, path, sizes)``: conversations that begin with turns of the first of their five ids.

    Of conversation c these are the first ``crc32(c) % 9`` turns of ``c - c % 5``; its own turns follow from
    that place on. ``path`` holds the prefix digests.
    """
    turns = written(_in_order(conversations), "turns")
    borrowed = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("borrowed")
    ids = turns.select("conv_id").distinct().select(
        "conv_id", borrowed, (F.col("conv_id") - F.col("conv_id") % 5).alias("base")
    )
    first = turns.where("place < 8").select(
        F.col("conv_id").alias("base"), "place", "turn_key", "size"
    )
    begun = ids.join(first, "base").where("place < borrowed")
    own = turns.withColumn("borrowed", borrowed).where("place >= borrowed")
    columns = ["conv_id", "part", "place", "turn_key", "size"]
    both = begun.withColumn("part", F.lit(0)).select(*columns).unionByName(
        own.withColumn("part", F.lit(1)).select(*columns)
    )
    turn = F.struct("part", "place", "turn_key", "size")
    told = both.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    every = ids.select("conv_id").join(told, "conv_id", "left")
    keys = F.coalesce(F.transform("turns", lambda x: x["turn_key"]), F.array().cast("array<binary>"))
    sizes = F.coalesce(F.transform("turns", lambda x: x["size"]), F.array().cast("array<long>"))
    return every.select("conv_id", keys.alias("keys"), sizes.alias("sizes")).mapInArrow(_path_rows, _PATH)


def _path_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = []
        for keys in batch.column("keys").to_pylist():
            at, path = ROOT, []
            for key in keys:
                at = hashlib.blake2b(at + key, digest_size=WIDTH).digest()
                path.append(at)
            paths.append(b"".join(path))
        yield pa.RecordBatch.from_pydict(
            {
                "conv_id": batch.column("conv_id"),
                "path": pa.array(paths, pa.binary()),
                "sizes": batch.column("sizes"),
            }
        )


def _at(path: str, depth: Column) -> Column:
    """The prefix digest at a depth; that of the root at 0."""
    here = F.substring(F.col(path), ((depth - 1) * WIDTH + 1).cast("int"), F.lit(WIDTH))
    return F.when(depth > 0, here).otherwise(F.lit(ROOT))


def _fattest(low: Column, high: Column) -> Column:
    """The depth in ``(low, high]`` that the highest power of two divides."""
    apart = low.cast("long").bitwiseXOR(high.cast("long"))
    unit = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(apart, F.lit(1))))).cast("long")
    return (high - high % unit).cast("int")


def _handles(trie: DataFrame) -> DataFrame:
    """Where each node but the root is found, by its handle and by the first turn of its edge."""
    within = _fattest(F.col("low"), F.col("depth")) - F.col("low")
    return trie.where("depth > 0").select(
        _at("edge", within).alias("handle"),
        _at("edge", F.lit(1)).alias("name"),
        F.col("key").alias("found"),
        F.col("depth").alias("found_depth"),
    )


def _located(batch: DataFrame, trie: DataFrame, longest: int) -> DataFrame:
    """Where each conversation leaves the trie: ``(path, sizes, n, low, name)``.

    ``low`` is the deepest node that the conversation passes; ``name`` finds the edge below in which it may go on.
    """
    handles = written(_handles(trie), "handles")
    state = batch.select("path", "sizes", F.size("sizes").alias("n")).withColumns(
        {
            "low": F.lit(0),
            "high": F.col("n"),
            "name": F.lit(None).cast("binary"),
        }
    )
    probes = handles.select("handle", "found", "found_depth", F.col("name").alias("found_name"))
    for _ in range(max(longest, 1).bit_length()):
        step = _fattest(F.col("low"), F.col("high"))
        open_ = (F.col("low") < F.col("high")) & F.col("name").isNull()
        state = state.withColumn("step", F.when(open_, step))
        state = state.withColumn("probe", F.when(open_, _at("path", F.col("step"))))
        joined = state.join(probes, state.probe == probes.handle, "left")
        passed = (F.col("found_depth") <= F.col("n")) & (
            _at("path", F.col("found_depth")) == F.col("found")
        )
        hit = F.col("found").isNotNull()
        state = joined.select(
            "path",
            "sizes",
            "n",
            F.when(open_ & hit & passed, F.col("found_depth")).otherwise(F.col("low")).alias("low"),
            F.when(open_ & ~hit, F.col("step") - 1).otherwise(F.col("high")).alias("high"),
            F.when(open_ & hit & ~passed, F.col("found_name")).otherwise(F.col("name")).alias("name"),
        )
    below = F.when(F.col("low") < F.col("n"), _at("path", F.col("low") + 1))
    return state.select("path", "sizes", "n", "low", F.coalesce("name", below).alias("name"))


def _leave_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The depth at which each conversation leaves its edge, and the digest of its first new turn."""
    for batch in batches:
        left, fresh = [], []
        columns = ("path", "n", "low", "edge", "edge_low")
        for path, n, low, edge, edge_low in zip(
            *(batch.column(c).to_pylist() for c in columns), strict=True
        ):
            at = low
            if edge is not None:
                at = edge_low + common(path[edge_low * WIDTH :], edge)
            left.append(at)
            fresh.append(path[at * WIDTH : (at + 1) * WIDTH] if at < n else None)
        out = {"path": batch.column("path"), "sizes": batch.column("sizes"), "node": batch.column("node")}
        yield pa.RecordBatch.from_pydict(
            out | {"at": pa.array(left, pa.int32()), "fresh": pa.array(fresh, pa.binary())}
        )


def common(a: bytes, b: bytes) -> int:
    """How many digests two strings of prefixes share; where one is equal, so are all before it."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        if a[(mid - 1) * WIDTH : mid * WIDTH] == b[(mid - 1) * WIDTH : mid * WIDTH]:
            low = mid
        else:
            high = mid - 1
    return low


def branches(strings: list[tuple[bytes, list[int]]], root: int) -> list[tuple[bytes, list[int], int, int]]:
    """Nodes ``(path, sizes, low, depth)`` of the compacted trie of sorted strings below depth ``root``."""
    out = []
    depths = [root]

    def close(path: bytes, sizes: list[int], shared: int) -> None:
        while depths[-1] > shared:
            depth = depths.pop()
            low = max(depths[-1], shared)
            out.append((path, sizes, low, depth))
            if depths[-1] < shared:
                depths.append(shared)

    before: tuple[bytes, list[int]] | None = None
    for path, sizes in strings:
        if before is not None:
            close(*before, max(root, common(before[0], path)))
        if len(path) // WIDTH > depths[-1]:
            depths.append(len(path) // WIDTH)
        before = (path, sizes)
    if before is not None:
        close(*before, root)
    return out


def _branch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """New nodes below the places where conversations left the trie, a group for each new turn."""
    for table, bounds in whole_groups(batches, "fresh"):
        path, sizes, at = (table.column(c).to_pylist() for c in ("path", "sizes", "at"))
        rows = []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            distinct = {path[k]: sizes[k] for k in range(lo, hi)}
            for p, s, low, depth in branches(sorted(distinct.items()), at[lo]):
                parent = p[(low - 1) * WIDTH : low * WIDTH] if low else ROOT
                edge = p[low * WIDTH : depth * WIDTH]
                rows.append((edge[-WIDTH:], parent, low, depth, edge, s[low:depth]))
        yield _nodes_batch(rows)


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of nodes whose edges are cut at the depths ``cuts``."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            ends = sorted({*row["cuts"], row["depth"]})
            low, parent = row["low"], row["parent"]
            for end in ends:
                part = slice((low - row["low"]) * WIDTH, (end - row["low"]) * WIDTH)
                edge = row["edge"][part]
                sizes = row["sizes"][low - row["low"] : end - row["low"]]
                rows.append((edge[-WIDTH:], parent, low, end, edge, sizes))
                low, parent = end, edge[-WIDTH:]
        yield _nodes_batch(rows)


def _nodes_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
    names = ("key", "parent", "low", "depth", "edge", "sizes")
    return pa.RecordBatch.from_pydict(
        {n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)}
    )


def _inserted(batch: DataFrame, trie: DataFrame, longest: int) -> DataFrame:
    """The trie after a batch."""
    located = _located(batch, trie, longest)
    edges = trie.where("depth > 0").select(
        _at("edge", F.lit(1)).alias("edge_name"),
        F.col("key").alias("node"),
        F.col("low").alias("edge_low"),
        "edge",
    )
    joined = located.join(edges, located.name == edges.edge_name, "left")
    left = written(
        joined.select("path", "sizes", "n", "low", "node", "edge_low", "edge").mapInArrow(
            _leave_rows, "path binary, sizes array<long>, node binary, at int, fresh binary"
        ),
        "leaving",
    )
    new = by_key(left.where("fresh IS NOT NULL"), "fresh").mapInArrow(_branch_rows, _NODE)
    cuts = left.where("node IS NOT NULL").groupBy("node").agg(F.collect_set("at").alias("cuts"))
    cuts = written(cuts, "cuts")
    whole = trie.join(cuts, trie.key == cuts.node, "left_anti")
    pieces = trie.join(cuts, trie.key == cuts.node).drop("node").mapInArrow(_cut_rows, _NODE)
    return written(whole.unionByName(pieces).unionByName(new), "trie")


def build(convs: DataFrame, first: int) -> DataFrame:
    """The compacted trie of ``convs(conv_id, path, sizes)``, which have to be stored."""
    spark = convs.sparkSession
    total, longest = convs.agg(F.count(F.lit(1)), F.max(F.size("sizes"))).first()
    root = spark.range(1).select(
        F.lit(ROOT).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).alias("low"),
        F.lit(0).alias("depth"),
        F.lit(b"").alias("edge"),
        F.array().cast("array<long>").alias("sizes"),
    )
    trie, done, upto = written(root, "trie"), 0, first
    place = F.pmod(F.xxhash64("conv_id"), F.expr(f"{_SCALE}L"))
    while total and done < _SCALE:
        stop = min(_SCALE, max(done + 1, _SCALE * upto // total))
        trie = _inserted(convs.where((place >= done) & (place < stop)), trie, longest)
        done, upto = stop, upto * (GROWTH + 1)
    return trie


def _upward(ends: DataFrame, keys: DataFrame, sums: dict[str, Column], at: Column) -> DataFrame:
    """Sums over all ends below each node of ``keys``; ``at`` gives each end's values by depth."""
    spread = ends.select(
        "*", F.explode(F.sequence(F.lit(0), F.size("sizes"))).alias("d")
    ).select(_at("path", F.col("d")).alias("key"), at.alias("x"))
    added = spread.groupBy("key").agg(*(c.alias(n) for n, c in sums.items()))
    return added.join(keys, "key", "left_semi")


def shared_prefixes(conversations: DataFrame, first_batch: int = FIRST_BATCH) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations; see the module.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes of texts that members repeat, over the subtree) and ``ends_sha256``.
    """
    convs = written(rebuilt(conversations), "convs")
    if convs.isEmpty():
        return no_rows(
            conversations.sparkSession,
            "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
            "n_leaves long, saved_tokens long, ends_sha256 string",
        )
    return _described(convs, build(convs, first_batch))


def _described(convs: DataFrame, trie: DataFrame) -> DataFrame:
    convs = convs.withColumn("end", _at("path", F.size("sizes")))
    children = written(
        trie.where("depth > 0").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")), "children"
    )
    ends = convs.groupBy("end").agg(
        F.count(F.lit(1)).alias("own"),
        F.min("conv_id").alias("first"),
        F.first("path").alias("path"),
        F.first("sizes").alias("sizes"),
    )
    inner = children.select(F.col("parent").alias("end"), F.lit(0).alias("leaf"))
    ends = ends.join(inner, "end", "left").withColumn("leaf", F.coalesce("leaf", F.lit(1)))
    ends = written(_with_sums(ends), "ends")
    keys = trie.select("key")
    # All bytes from a node's last turn on, each as often as it is said.
    said = F.struct(
        "own", "first", "leaf", (F.col("own") * _from(F.col("d"))).alias("said")
    )
    counted = written(
        _upward(
            ends,
            keys,
            {
                "n_convs": F.sum("x.own"),
                "first": F.min("x.first"),
                "n_leaves": F.sum("x.leaf").cast("long"),
                "said": F.sum("x.said"),
            },
            said,
        ),
        "counted",
    )
    # Of the ends below a node the one with the smallest id stands for the node's own turns.
    known = trie.join(counted, "key")
    owned = known.groupBy("first").agg(F.min("low").alias("owned"))
    once = F.struct(_from(F.greatest(F.col("d"), F.col("owned") + 1)).alias("once"))
    distinct = _upward(ends.join(owned, "first"), keys, {"once": F.sum("x.once")}, once)
    above = counted.select(F.col("key").alias("parent"), F.col("first").alias("parent_first"))
    full = (
        known.join(distinct, "key")
        .join(children.withColumnRenamed("parent", "key"), "key", "left")
        .join(above, "parent", "left")
        .join(_end_digests(convs), "key", "left")
    )
    return _expanded(full)


def _with_sums(ends: DataFrame) -> DataFrame:
    """Bytes of the turns after each depth, from 0 to the last."""
    back = F.aggregate(
        F.reverse("sizes"),
        F.array(F.lit(0).cast("long")),
        lambda a, x: F.concat(F.array(a[0] + x), a),
    )
    return ends.withColumn("after", back)


def _from(depth: Column) -> Column:
    """Text bytes of an end's turns from the one at ``depth`` on; the root has no text."""
    at = F.greatest(depth, F.lit(1))
    return F.when(at <= F.size("sizes"), F.element_at("after", at.cast("int"))).otherwise(
        F.lit(0).cast("long")
    )


def _end_digests(convs: DataFrame) -> DataFrame:
    """The digest of the ids that end at each node, in their order, read as a stream."""
    rows = convs.select(F.col("end").alias("key"), "conv_id")
    ordered = rows.repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(_digest_rows, "key binary, ends_sha256 string")


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None

    def row():
        return pa.RecordBatch.from_pydict(
            {"key": pa.array(keys, pa.binary()), "ends_sha256": pa.array(digests, pa.string())}
        )

    for batch in batches:
        keys, digests = [], []
        for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = k, hashlib.sha256(str(conv).encode())
            else:
                state.update(b",%d" % conv)
        yield row()
    if state is not None:
        keys, digests = [key], [state.hexdigest()]
        yield row()


def _expanded(nodes: DataFrame) -> DataFrame:
    """A row for each turn of each edge; a turn within an edge has the members of the node below it."""
    places = F.when(F.col("depth") > 0, F.sequence(F.col("low") + 1, F.col("depth"))).otherwise(
        F.array(F.lit(0))
    )
    each = nodes.withColumn("d", F.explode(places))
    last = F.col("d") == F.col("depth")
    # Bytes of the edge's turns from this one to the last but one, which ``saved`` does not hold.
    rest = F.slice("sizes", F.col("d") - F.col("low"), F.col("depth") - F.col("d"))
    rest = F.when(last, F.lit(0).cast("long")).otherwise(
        F.aggregate(rest, F.lit(0).cast("long"), lambda a, b: a + b)
    )
    above = F.when(F.col("d") > F.col("low") + 1, F.col("first")).otherwise(F.col("parent_first"))
    return each.select(
        F.col("first").alias("conv_id"),
        F.col("d").cast("long").alias("depth"),
        above.alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.coalesce("n_children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("said") - F.col("once") + (F.col("n_convs") - 1) * rest).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(_EMPTY))).otherwise(_EMPTY).alias("ends_sha256"),
    )
