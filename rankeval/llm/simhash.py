"""SimHash near-duplicates: BK-trees over sharded fingerprints, then connected components.

1. Every whole text gets a 64-bit SimHash of its hashed word shingles (Arrow batches, numpy counts).
2. Equal fingerprints are folded into one before anything is compared (partial aggregation), so exact
   copies cost nothing further.
3. The 64 bits are cut into ``radius + 1`` bands.  Two fingerprints at most ``radius`` bits apart agree
   on at least one whole band, so shard (band, value) pairs meet every link: no link is lost.  A shard with
   more than ``TREE`` fingerprints is split into several trees, and every query of the shard goes to each
   of its trees; a tree is bounded, so it is what travels to the queries (all trees together grow with the
   corpus and are never broadcast whole or collected).
4. In a task a BK-tree is built per shard tree (children keyed by Hamming distance to the parent) and
   searched for all queries at once; an edge is followed only if its key is within ``radius`` of the
   query's distance to the parent.  Links found in a buffer are reduced to a spanning forest, so a group of k
   near copies emits at most k rows, not k * k.
5. Large-star / small-star rounds on the links, cut by tables in the shared folder, give components.

Defined cases: null and wordless texts have fingerprint zero and link like any other; null doc_ids are
carried, and a component of only null ids has a null component_id; repeated rows are rows of their own in the query,
while the stage keeps one row of each component: that of the least doc_id (null ids last), and of several with it the one
whose columns have the least hash; very long texts are hashed whole; an empty table gives an empty result; extra columns are
ignored by the query and carried by the stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, join_counted, materialise, struct_of, table

SHINGLE, RADIUS, SEED = 4, 4, 42
TREE = 8192
FRONTIER = 1 << 21


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash (unsigned) of one text; shingles count with repeats, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        spans = zip(starts[at: at + (1 << 16)].tolist(), ends[at: at + (1 << 16)].tolist())
        h = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (ones * 2 > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, columns to carry): fp is the fingerprint's 64 bits as a signed long."""
    names = ["doc_id", "fp", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), *batch.columns[2:]], names)

    types = [(c, "bigint" if c == "fp" else docs.schema[c].dataType.simpleString()) for c in names]
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), *carry).mapInArrow(run, struct_of(*types))


class Forest:
    """BK-trees of several groups in flat arrays, built level by level.

    ``fps`` (uint64) are distinct inside a group; ``group`` is non-decreasing.  The first member of a group is
    its root.  Children of a node lie together, ascending by key (distance to the parent).
    """

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        self.fps = fps
        n = len(fps)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.empty(0, np.int64)
        self.roots, self.root_group = first, group[first]
        self.lo, self.hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
        node = np.repeat(first, np.diff(np.r_[first, n]))  # where each unplaced member stands now
        rest = np.setdiff1d(np.arange(n), first, assume_unique=True)
        node, child, key, size = node[rest], [], [], 0
        while len(rest):
            d = np.bitwise_count(fps[rest] ^ fps[node]).astype(np.int64)
            order = np.lexsort((rest, d, node))
            rest, node, d = rest[order], node[order], d[order]
            new = np.r_[True, (node[1:] != node[:-1]) | (d[1:] != d[:-1])]
            made, parent = rest[new], node[new]
            child.append(made)
            key.append(d[new])
            ends = np.flatnonzero(np.r_[parent[1:] != parent[:-1], True])
            begins = np.r_[0, ends[:-1] + 1]
            self.lo[parent[ends]], self.hi[parent[ends]] = size + begins, size + ends + 1
            size += len(made)
            node = np.repeat(made, np.diff(np.r_[np.flatnonzero(new), len(rest)]))[~new]
            rest = rest[~new]
        self.child = np.concatenate(child) if child else np.empty(0, np.int64)
        self.key = np.concatenate(key) if key else np.empty(0, np.int64)

    def search(self, queries: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, member index) arrays of all pairs within ``radius`` bits, in pieces."""
        root = np.searchsorted(self.root_group, group)
        q = np.flatnonzero((root < len(self.roots)) & (self.root_group[np.minimum(root, len(self.roots) - 1)] == group)) \
            if len(self.roots) else np.empty(0, np.int64)
        stack = [(q, self.roots[root[q]])] if len(q) else []
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER // 64:  # a bounded part now, the rest later: memory does not grow with the queries
                stack.append((q[FRONTIER // 64:], node[FRONTIER // 64:]))
                q, node = q[: FRONTIER // 64], node[: FRONTIER // 64]
            d = np.bitwise_count(queries[q] ^ self.fps[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            count = self.hi[node] - self.lo[node]
            some = count > 0
            q, node, d, count = q[some], node[some], d[some], count[some]
            if not len(q):
                continue
            owner = np.repeat(np.arange(len(q)), count)
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + self.lo[node][owner]
            follow = np.abs(self.key[at] - d[owner]) <= radius
            if follow.any():
                stack.append((q[owner[follow]], self.child[at[follow]]))


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the classes of a[i] and b[i]; label[i] <= i always points towards the class's least index."""
    while True:
        ra, rb = label[a], label[b]
        open_ = ra != rb
        if not open_.any():
            return
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _search_partition(radius: int):
    """Rows (shard, tree, role, fp), sorted: members (role 0) of a tree come before its queries (role 1)."""

    def flush(key: np.ndarray, role: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        member = role == 0
        forest, mkey = Forest(fp[member], key[member]), fp[member]
        values, where = np.unique(fp, return_inverse=True)
        label = np.arange(len(values))
        query, member_at, query_at = fp[~member], where[member], where[~member]
        for q, m in forest.search(query, key[~member], radius):
            _join_labels(label, query_at[q], member_at[m])
        linked = np.flatnonzero(label != np.arange(len(values)))
        if not len(linked):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(values[linked].view(np.int64)), pa.array(values[label[linked]].view(np.int64))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def joined():
            return [np.concatenate(x) for x in zip(*held)]

        for batch in batches:
            if not batch.num_rows:
                continue
            shard, tree, role, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            held.append((shard.astype(np.int64) << 32 | tree.astype(np.int64), role, fp.view(np.uint64)))
            rows += batch.num_rows
            if rows < 1 << 17:
                continue
            key, role, fp = joined()
            last = key == key[-1]
            open_members = role[-1] == 0
            ready = ~last if open_members else np.ones(len(key), bool)
            if ready.any() and (out := flush(key[ready], role[ready], fp[ready])) is not None:
                yield out
            keep = last if open_members else last & (role == 0)  # at most one tree's members
            held = [(key[keep], role[keep], fp[keep])]
            rows = int(keep.sum()) if open_members else 0
        if held:
            key, role, fp = joined()
            if len(key) and (out := flush(key, role, fp)) is not None:
                yield out

    return run


def links(fps: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that keep all components of the radius graph."""
    bands, start = [], 0
    for i in range(radius + 1):
        width = 64 // (radius + 1) + (i < 64 % (radius + 1))
        bands.append((start, width))
        start += width
    shards = F.array(*[(F.lit(i).cast("long") * F.lit(1 << 22).cast("long") +
                        F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << min(width, 22)) - 1).cast("long")))
                       for i, (at, width) in enumerate(bands)])
    routed = fps.select("fp", F.explode(shards).alias("shard"))
    # at most 2**width rows per band, whatever the corpus
    sizes = routed.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1").select(
        "shard", F.ceil(F.col("n") / tree).cast("int").alias("trees"))
    routed = routed.join(sizes, "shard")
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    # every query goes to each tree of its shard; a member also goes, first, to its own tree
    roles = F.concat(
        F.array(F.struct(own.alias("tree"), F.lit(0).alias("role"))),
        F.transform(F.sequence(F.lit(0), F.col("trees") - 1), lambda t: F.struct(t.alias("tree"), F.lit(1).alias("role"))))
    rows = routed.select("shard", F.inline(roles), "fp").select("shard", "tree", "role", "fp")
    spark = fps.sparkSession
    rows = rows.repartition("shard", "tree").sortWithinPartitions("shard", "tree", "role")
    found = rows.mapInArrow(_search_partition(radius), "u long, v long")
    return materialise(found.distinct(), "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node of the component; nodes without an edge are absent.

    Alternating large-star and small-star rounds (Kiveris et al.); the least neighbour of a hub is found by a
    partial aggregation, and each round ends in a table in the shared folder.
    """
    edges = materialise(edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        edges = materialise(small.filter("u != v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark is not None and tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(now)


def _components(prints: DataFrame, first: Column, radius: int) -> tuple[DataFrame, DataFrame]:
    """Written tables: (fp, n, root) of the distinct fingerprints with their numbers of rows, and (root, m, best) of the
    components, m fingerprints each and the least ``first`` of their rows."""
    distinct = prints.groupBy("fp").agg(F.min(first).alias("first"), F.count("*").alias("n"))
    roots = components(links(distinct.select("fp"), radius))
    placed = materialise(distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", "n", F.coalesce("root", "fp").alias("root")), "placed")
    best = placed.groupBy("root").agg(F.min("first").alias("best"), F.count("*").alias("m"))
    return placed.drop("first"), materialise(best, "components")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (least doc_id of its component)."""
    prints = materialise(fingerprints(docs, shingle, seed), "fingerprints")
    placed, best = _components(prints, F.col("doc_id"), radius)
    classes = join_counted(placed, best, "root", "m").select("fp", "n", F.col("best").alias("component_id"))
    return join_counted(prints, materialise(classes, "classes"), "fp", "n").select("doc_id", "fp", "component_id")


def op7_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each near-duplicate component one row stays, that of the least doc_id.

    Rows are told apart by two hashes of all their columns, never by doc_id alone: unlike rows that share an id, or have
    none, stand for themselves, and rows alike in every column are one.
    """
    h1, h2 = fresh(docs, "h1"), fresh(docs, "h2")
    columns = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    marked = docs.withColumns({h1: F.xxhash64(*columns), h2: F.xxhash64(F.lit(1), *columns)})
    prints = materialise(fingerprints(marked, carry=(h1, h2)), "fingerprints")
    _, best = _components(prints, F.struct(F.col("doc_id").isNull(), "doc_id", h1, h2), RADIUS)
    stay = best.select(F.col(f"best.{h1}").alias(h1), F.col(f"best.{h2}").alias(h2))
    return marked.join(stay, [h1, h2], "left_semi").dropDuplicates([h1, h2]).select(*[f"`{c}`" for c in docs.columns])
