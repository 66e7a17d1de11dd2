"""Groups of similar sets, found from keys that similar sets share.

The course that operators on whole sets have in common; what differs are their signatures and keys.

1. Equal sets, told by a 128-bit digest, are one node, whatever the number of rows.
2. *Stars.* Sets with a common key are compared with the first of them, in tiles of bounded size. What their
   signatures allow is decided on whole sets. Links make components.
3. *Crosses.* Where a key still has sets of several components, those outside its largest one are compared
   with all sets of the key of other components, block by block, by signatures. The pairs that these allow
   tie sets into trees; the sets of a tree are a family, and each family's whole sets are compared once,
   again those outside its largest component with all others.

No key and no family is cut for its size, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripstrata.llm import words as W
from tripstrata.llm.buckets import BucketFilter
from tripstrata.llm.components import components, written
from tripstrata.llm.runs import by_key, whole_groups
from tripstrata.llm.shingles import shingles

U64 = np.uint64
TILE = 256
BLOCK_SETS, BLOCK_ELEMENTS = 2048, 1_000_000

# ``alike(marks, sizes, percent)`` prepares a tile; what it returns picks those of ``js`` that may link with ``i``.
Pick = Callable[[int, np.ndarray], np.ndarray]
Alike = Callable[[pa.ChunkedArray, np.ndarray, int], Pick]


def digests(sets: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two 64-bit halves of each set's digest."""
    ends = np.cumsum(n)
    whole = b"".join(
        hashlib.blake2b(sets[e - k : e].tobytes(), digest_size=16).digest()
        for e, k in zip(ends.tolist(), n.tolist(), strict=True)
    )
    return np.frombuffer(whole, np.int64).reshape(-1, 2)


def fresh(seen: set, sid: np.ndarray, sid_b: np.ndarray) -> np.ndarray:
    """Which of the sets were not met before in this task."""
    new = np.zeros(len(sid), bool)
    for k, pair in enumerate(zip(sid.tolist(), sid_b.tolist(), strict=True)):
        if pair not in seen:
            seen.add(pair)
            new[k] = True
    return new


def _wanted_marks(wanted: BucketFilter):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            batch = batch.filter(pa.array(wanted.passes(batch.column("sid").to_numpy())))
            new = fresh(seen, batch.column("sid").to_numpy(), batch.column("sid_b").to_numpy())
            yield batch.filter(pa.array(new))

    return rows


def _wanted_sets(width: int, ids: BucketFilter, sids: BucketFilter, unnamed: bool):
    """Whole sets of the documents that stand for a set, computed from their texts; each once in a task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for piece in W.pieces(batches, budget=1 << 20):
            doc_id = piece.column("doc_id").cast(pa.int64())
            named = doc_id.is_valid().to_numpy(zero_copy_only=False)
            ok = ids.passes(doc_id.fill_null(0).to_numpy(zero_copy_only=False))
            piece = piece.filter(pa.array(np.where(named, ok, unnamed)))
            if not piece.num_rows:
                continue
            sets, n = shingles(piece.column("text"), width)
            sid = digests(sets, n)
            use = sids.passes(np.ascontiguousarray(sid[:, 0])) & (n > 0)
            use[use] = fresh(seen, sid[use, 0], sid[use, 1])
            ends = np.cumsum(n)
            at = np.flatnonzero(use)
            yield pa.RecordBatch.from_pydict(
                {
                    "sid": pa.array(sid[at, 0]),
                    "sid_b": pa.array(sid[at, 1]),
                    "elements": pa.array([sets[ends[k] - n[k] : ends[k]].tobytes() for k in at], pa.binary()),
                }
            )

    return rows


def near_sizes(size: np.ndarray, i: int, js: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``js`` whose size allows a link with ``i``."""
    small, large = np.minimum(size[js], size[i]), np.maximum(size[js], size[i])
    return js[100 * small >= percent * large]


class _Forest:
    """Union-find over the places of a tile."""

    def __init__(self, group: np.ndarray):
        """Places of one group are together from the start."""
        _, first, inverse = np.unique(group, return_index=True, return_inverse=True)
        self.group = first[inverse]

    def join(self, i: int, j: int) -> None:
        self.group[self.group == self.group[j]] = self.group[i]


def _tile(table: pa.Table) -> tuple[np.ndarray, ...]:
    left = table.column("is_left").to_numpy(zero_copy_only=False).astype(bool)
    return (
        table.column("node").to_numpy(),
        table.column("comp").to_numpy(),
        np.flatnonzero(left),
        np.flatnonzero(~left),
        table.column("n_shingles").to_numpy(),
    )


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*out, strict=True) if out else ((), ())
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _prune_rows(percent: int, alike: Alike):
    """Pairs of a tile ``(node, partner)`` that tie all sets with a possible partner into trees."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, "tile"):
            out: list[tuple[int, int]] = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                part = table.slice(lo, hi - lo)
                node, comp, lefts, rights, size = _tile(part)
                pick = alike(part.column("marks"), size, percent)
                forest = _Forest(node)
                for i in lefts:
                    js = rights[(comp[rights] != comp[i]) & (forest.group[rights] != forest.group[i])]
                    for j in pick(i, js) if len(js) else js:
                        if forest.group[i] != forest.group[j]:
                            forest.join(i, j)
                            out.append((node[i], node[j]))
            yield _pairs(out)

    return rows


def _link_rows(percent: int, alike: Alike):
    """Links of a tile between sets that are not connected yet, decided on whole sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, "tile"):
            out: list[tuple[int, int]] = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                part = table.slice(lo, hi - lo)
                node, comp, lefts, rights, size = _tile(part)
                pick = alike(part.column("marks"), size, percent)
                sets = [np.frombuffer(x, U64) for x in part.column("elements").to_pylist()]
                forest = _Forest(comp)
                for i in lefts:
                    js = rights[forest.group[rights] != forest.group[i]]
                    js = pick(i, js) if len(js) else js
                    for j in _linked(sets, i, js, percent):
                        if forest.group[i] != forest.group[j]:
                            forest.join(i, j)
                            out.append((node[i], node[j]))
            yield _pairs(out)

    return rows


def _linked(sets: list[np.ndarray], i: int, js: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``js`` that are similar enough to ``i``, by exact intersections."""
    if not len(js):
        return js
    size = np.array([len(sets[j]) for j in js])
    others = np.concatenate([sets[j] for j in js])
    at = np.searchsorted(sets[i], others)
    at[at == len(sets[i])] = 0
    common = np.add.reduceat((sets[i][at] == others).astype(np.int64), np.cumsum(size) - size)
    return js[100 * common >= percent * (size + len(sets[i]) - common)]


class Grouping:
    """The course over one table; a subclass says what signatures and keys are.

    ``signed`` has a row ``(doc_id, n_shingles, sid, sid_b, marks)`` for each document, ``keys`` gives
    ``(key, sid)`` and ``alike`` compares signatures. ``mark_elements`` bounds the elements of a block of
    signatures, for those that grow with their set.
    """

    alike: Alike
    signed: DataFrame
    mark_elements = 0

    def __init__(self, docs: DataFrame, text: str, width: int, percent: int):
        self.docs = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
        )
        self.width, self.percent = width, percent

    def keys(self, wanted: BucketFilter | None = None) -> DataFrame:
        """(key, sid) of every set; with ``wanted`` only of the keys in it."""
        raise NotImplementedError

    def rows(self) -> DataFrame:
        """Every row of ``signed`` with the ``name`` of its group, NULL if it stands alone."""
        self.nodes = written(_nodes(self.signed), "nodes")
        members = self.members()
        marks = self.marks(members)
        star = written(members.where("sid <> low").select("low", "sid").distinct(), "star")
        trees = self.possible(_star_tiles(star, self.nodes), marks)
        links = self.links(_pair_tiles(trees, self.nodes), marks)
        comps = components(links)
        crowded = _crowded(members, self.nodes, comps)
        if not crowded.isEmpty():
            trees = self.possible(_cross_tiles(_sized(crowded, "key", self.mark_elements)), marks)
            family = components(trees).withColumnRenamed("component", "unit")
            placed = family.join(self.nodes.select("node", "n_shingles"), "node")
            placed = written(_with_comp(placed, comps), "families")
            tiles = _cross_tiles(_sized(placed, "unit", BLOCK_ELEMENTS))
            comps = components(links.unionByName(self.links(tiles, marks)))
        return _labelled(self.signed, self.nodes, comps)

    def members(self) -> DataFrame:
        """(key, low, sid) of the keys that several sets have; ``low`` is the first of them."""
        shared = written(
            self.keys()
            .groupBy("key")
            .agg(F.min("sid").alias("low"), F.max("sid").alias("high"))
            .where("low < high")
            .select("key", "low"),
            "shared",
        )
        found = self.keys(BucketFilter(shared, F.col("key"))).distinct().join(shared, "key")
        return written(found.select("key", "low", "sid"), "members")

    def marks(self, sids: DataFrame) -> DataFrame:
        """The signatures of the sets named in ``sids``, each once."""
        wanted = BucketFilter(sids, F.col("sid"))
        rows = self.signed.where("n_shingles > 0").select("sid", "sid_b", "marks")
        found = rows.mapInArrow(_wanted_marks(wanted), "sid long, sid_b long, marks binary")
        return written(found.dropDuplicates(["sid", "sid_b"]), "marks")

    def possible(self, tiles: DataFrame, marks: DataFrame) -> DataFrame:
        """Trees of pairs ``(a, b)`` of ``tiles(tile, node, comp, is_left)`` whose signatures allow a link."""
        full = tiles.join(self.nodes, "node").join(marks, ["sid", "sid_b"])
        full = full.select("tile", "node", "comp", "is_left", "n_shingles", "marks")
        prune = _prune_rows(self.percent, type(self).alike)
        return written(by_key(full, "tile").mapInArrow(prune, "a long, b long"), "possible")

    def links(self, tiles: DataFrame, marks: DataFrame) -> DataFrame:
        """Links found between the left and the right sets of each tile."""
        placed = written(tiles.join(self.nodes, "node"), "tiles")
        chosen = placed.select("node", "sid", "least").distinct()
        unnamed = not chosen.where("least IS NULL").isEmpty()
        fetched = self.docs.mapInArrow(
            _wanted_sets(
                self.width,
                BucketFilter(chosen.where("least IS NOT NULL"), F.col("least")),
                BucketFilter(chosen, F.col("sid")),
                unnamed,
            ),
            "sid long, sid_b long, elements binary",
        )
        sets = fetched.dropDuplicates(["sid", "sid_b"]) if unnamed else fetched
        full = placed.join(marks, ["sid", "sid_b"]).join(sets, ["sid", "sid_b"])
        full = full.select("tile", "node", "comp", "is_left", "n_shingles", "marks", "elements")
        compare = _link_rows(self.percent, type(self).alike)
        return written(by_key(full, "tile").mapInArrow(compare, "a long, b long"), "links")


def _nodes(signed: DataFrame) -> DataFrame:
    """A node for each distinct set: its number, digest, size, smallest ``doc_id`` and number of rows.

    The number is the first half of the digest. Should two sets share it, the later one gets another.
    """
    sets = (
        signed.where("n_shingles > 0")
        .groupBy("sid", "sid_b")
        .agg(
            F.min("doc_id").alias("least"),
            F.count(F.lit(1)).alias("n_rows"),
            F.max("n_shingles").alias("n_shingles"),
        )
    )
    place = F.row_number().over(Window.partitionBy("sid").orderBy("sid_b"))
    node = F.when(F.col("place") == 1, F.col("sid")).otherwise(F.xxhash64("sid", "sid_b"))
    return sets.withColumn("place", place).withColumn("node", node).drop("place")


def _star_tiles(star: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each set beside the first one with the same key, in tiles of bounded size."""
    parts = star.groupBy("low").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts"))
    parts = written(parts, "parts")
    part = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
    right = star.join(parts, "low").select("low", part.alias("part"), "sid", F.lit(False).alias("is_left"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    left = parts.select("low", every, F.col("low").alias("sid"), F.lit(True).alias("is_left"))
    sided = right.unionByName(left).join(nodes.select("sid", "node"), "sid")
    return sided.select(
        F.xxhash64("low", "part").alias("tile"), "node", F.col("node").alias("comp"), "is_left"
    )


def _pair_tiles(trees: DataFrame, nodes: DataFrame) -> DataFrame:
    """Possible pairs around their left set, in tiles of a bounded number of sets and of elements."""
    sized = trees.join(nodes.select(F.col("node").alias("b"), "n_shingles"), "b")
    most = F.greatest(F.count(F.lit(1)) / TILE, F.sum("n_shingles") / BLOCK_ELEMENTS)
    parts = written(sized.groupBy("a").agg(F.ceil(most).cast("int").alias("parts")), "parts")
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    right = trees.join(parts, "a").select(
        "a", part.alias("part"), F.col("b").alias("node"), F.lit(False).alias("is_left")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    left = parts.select("a", every, F.col("a").alias("node"), F.lit(True).alias("is_left"))
    both = right.unionByName(left).distinct()
    return both.select(
        F.xxhash64("a", "part").alias("tile"), "node", F.col("node").alias("comp"), "is_left"
    )


def _with_comp(rows: DataFrame, comps: DataFrame) -> DataFrame:
    known = rows.join(comps.withColumnRenamed("component", "known"), "node", "left")
    return known.withColumn("comp", F.coalesce("known", "node")).drop("known")


def _crowded(members: DataFrame, nodes: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of the keys that still hold sets of several components; of keys with equal members one."""
    placed = members.select("key", "sid").join(nodes.select("sid", "node", "n_shingles"), "sid")
    placed = _with_comp(placed.drop("sid"), comps)
    mixed = (
        placed.groupBy("key")
        .agg(
            F.min("comp").alias("x"),
            F.max("comp").alias("y"),
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("print_a"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("print_b"),
        )
        .where("x < y")
        .groupBy("n", "print_a", "print_b")
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    return written(placed.join(mixed, "key"), "crowded")


def _sized(rows: DataFrame, unit: str, elements: int) -> DataFrame:
    """Each row of ``rows(unit, node, n_shingles, comp)`` with its unit's blocks on either side.

    Blocks hold a bounded number of sets, and of elements where ``elements`` is given. Left are the sets
    outside the unit's largest component.
    """
    of_comp = rows.groupBy(unit, "comp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("mass")
    )

    def blocks(n: Column, mass: Column) -> Column:
        most = n / BLOCK_SETS
        return F.ceil(F.greatest(most, mass / elements) if elements else most).cast("int")

    sizes = of_comp.groupBy(unit).agg(
        F.max(F.struct("n", "comp", "mass")).alias("main"),
        F.sum("n").alias("n"),
        F.sum("mass").alias("mass"),
    )
    sizes = sizes.select(
        unit,
        F.col("main.comp").alias("main"),
        blocks(F.col("n") - F.col("main.n"), F.col("mass") - F.col("main.mass")).alias("lefts"),
        blocks(F.col("n"), F.col("mass")).alias("rights"),
    ).where("lefts > 0")
    return written(rows.join(sizes, unit).withColumnRenamed(unit, "unit"), "sized")


def _cross_tiles(rows: DataFrame) -> DataFrame:
    """The sets outside a unit's largest component beside all sets of the unit, block by block."""
    sides = F.when(F.col("comp") != F.col("main"), F.array(F.lit(True), F.lit(False)))
    sided = rows.withColumn("is_left", F.explode(F.coalesce(sides, F.array(F.lit(False)))))
    mine = F.when(F.col("is_left"), F.col("lefts")).otherwise(F.col("rights"))
    others = F.when(F.col("is_left"), F.col("rights")).otherwise(F.col("lefts"))
    sided = sided.withColumn("block", F.pmod(F.xxhash64("node"), mine).cast("int"))
    paired = sided.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    left = F.when(F.col("is_left"), F.col("block")).otherwise(F.col("other"))
    right = F.when(F.col("is_left"), F.col("other")).otherwise(F.col("block"))
    return paired.select(F.xxhash64("unit", left, right).alias("tile"), "node", "comp", "is_left")


def _labelled(signed: DataFrame, nodes: DataFrame, comps: DataFrame) -> DataFrame:
    """Each row with the smallest ``doc_id`` of its component, which may hold sets without any."""
    placed = nodes.join(comps, "node", "left").withColumn("root", F.coalesce("component", "node"))
    least = placed.groupBy("root").agg(
        F.min("least").alias("name"), F.sum("n_rows").alias("all_rows")
    )
    label = written(
        placed.join(least.where("all_rows > 1"), "root").select("sid", "sid_b", "name"), "labels"
    )
    return signed.select("doc_id", "n_shingles", "sid", "sid_b").join(label, ["sid", "sid_b"], "left")
