"""N-gram Jaccard join with a count-vector R-tree.

A document's set is its distinct word shingles; two documents link when their sets' Jaccard similarity reaches `num`/`den`.
Hash values deal a set's shingles into groups; the group counts are a point, and two sets cannot share more than the sum of the smaller
coordinates of their points. Points are indexed in an R-tree whose nodes bound that sum, and surviving pairs are verified on the sets.

1. Equal sets are one class, found by a grouped hash; only classes go on, so thousands of copies cost one. Sets are named by that hash
   throughout, ids come back at the end: ids may repeat or be null.
2. Sets that link share one of the first (n - ceil(t * n) + 1) shingles in any common order. The order here is rarest first by counters of fixed size,
   so what very many documents share is no key unless a document hardly has anything else. These keys only partition the work: they bring sets to
   buckets. Candidates in a bucket come from one R-tree over the points of its sets, joined with itself from the root down: a pair of nodes is left
   where their sizes, their summed coordinate minima or their keys cannot meet, or where all below them is one component already.
3. Coarse components of the candidates bring together the sets that must be verified; one of more than TILE sets or TILE_SHINGLES
   shingles is dealt into pairs of tiles. Inside, a pair that the tree doesn't exclude is verified unless it is already in one component: no link
   that joins different components is lost, and no group is expanded into all its pairs.

Edge cases: null or wordless texts have the empty set, link with nothing and form their own component; a text with fewer words than a shingle is one
shingle; repeated ids are documents of their own; rows with a null id link as all others and take their component's smallest id (null if it
has none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, chunks, components, cut, distinct_pairs, map_batches, mix, partitions, small_batches, text_shingles

COUNTERS = 1 << 18
LEAF, FANOUT, GROUPS = 16, 16, 32
#: What one verified tile holds at most, in sets and in shingles (8 bytes each).
TILE, TILE_SHINGLES = 4096, 1 << 21
BUCKET_TEXT = 16 << 20
LARGE = 1 << 30
#: Node or item pairs in one numpy step.
STEP = 1 << 18


@dataclass(frozen=True)
class Rule:
    """Shingle width and the similarity num/den from which sets link."""

    width: int = 4
    num: int = 85
    den: int = 100

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """How many shingles in order must hold one that any linked set has too."""
        return n - -(-self.num * n // self.den) + 1

    def enough(self, overlap, na, nb):
        """Whether so large an overlap links sets of these sizes: overlap / (na + nb - overlap) >= num / den."""
        return (self.num + self.den) * overlap >= self.num * (na + nb)


def sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts in one array, ordered within each, the n+1 bounds, and an id of every set."""
    value, doc = text_shingles(column, width, lower=True)
    doc, value = distinct_pairs(doc, value)
    bounds = np.searchsorted(doc, np.arange(len(column) + 1))
    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(value ^ U64(0x5BD1E995)))])
    return value, bounds, mix(total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)


def dims(n: np.ndarray) -> np.ndarray:
    """Groups for a set of n shingles: a power of two near n / 16, from 32 to 1024."""
    return 1 << np.clip(np.ceil(np.log2(np.maximum(n, 1) / 16)), 5, 10).astype(np.int64)


def point(values: np.ndarray, d: int) -> np.ndarray:
    """Group counts; groups are the low bits of the hash, so halves of a point add up to the point with half as many groups."""
    return np.bincount((values & U64(d - 1)).astype(np.int64), minlength=d)


def fold(p: np.ndarray, d: int) -> np.ndarray:
    """Points (rows) with fewer groups."""
    return p.reshape(len(p), -1, d).sum(axis=1) if p.shape[1] > d else p


class Tree:
    """A packed R-tree over points; node maxima bound the overlap with anything below.

    With keys the items are ordered by them first, and only items of one key are pairs.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, keys: np.ndarray | None = None):
        self.points, self.sizes, self.keys = points, sizes, keys
        self.order = self._pack()
        self.levels = []
        low, high, top = sizes[self.order], sizes[self.order], points[self.order]
        first = last = np.zeros(len(low), U64) if keys is None else keys[self.order]
        width = LEAF
        while len(low) > 1 or not self.levels and len(low):
            at = np.arange(0, len(low), width)
            low, high, top = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(top, at, axis=0)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
            self.levels.append((width, low, high, top, first, last))
            width = FANOUT
        self.levels.reverse()

    def _pack(self) -> np.ndarray:
        """Sort-tile order: by key, by size into slabs, then inside each by the widest-spread coordinates."""
        if len(self.sizes) < 2:
            return np.arange(len(self.sizes))
        spread = np.argsort(-self.points.var(axis=0), kind="stable")[:2]
        slab = np.log2(np.maximum(self.sizes, 1) * 16).astype(np.int64)
        sort = (self.points[:, spread[-1]], self.points[:, spread[0]], self.sizes if self.keys is None else slab)
        return np.lexsort(sort if self.keys is None else (*sort, self.keys))

    def near(self, q: np.ndarray, n: int, rule: Rule) -> np.ndarray:
        """Items that may link with a set of size n and point q."""
        nodes = np.zeros(1, np.int64)
        for level, (width, low, high, top, _, _) in enumerate(self.levels):
            if level:
                nodes = nodes[nodes < len(low)]
            fits = (low[nodes] * rule.num <= n * rule.den) & (high[nodes] * rule.den >= n * rule.num)
            nodes = nodes[fits]
            nodes = nodes[rule.enough(np.minimum(top[nodes], q).sum(axis=1), n, low[nodes])]
            nodes = (nodes[:, None] * width + np.arange(width)).ravel()
        items = self.order[nodes[nodes < len(self.order)]]
        return items[rule.enough(np.minimum(self.points[items], q).sum(axis=1), n, self.sizes[items])]

    def _meet(self, level: int, a: np.ndarray, b: np.ndarray, rule: Rule) -> np.ndarray:
        """Which pairs of nodes (a <= b) may have a pair of items below them."""
        _, low, high, top, first, last = self.levels[level]
        may = (a == b) | (last[a] == first[b])
        may &= (low[a] * rule.num <= high[b] * rule.den) & (high[a] * rule.den >= low[b] * rule.num)
        may &= (low[b] * rule.num <= high[a] * rule.den) & (high[b] * rule.den >= low[a] * rule.num)
        at = np.flatnonzero(may & (a != b))
        may[at] = rule.enough(np.minimum(top[a[at]], top[b[at]]).sum(axis=1), low[a[at]], low[b[at]])
        return may

    def pairs(self, rule: Rule, owner: np.ndarray, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of owners whose items may link, leaf by leaf first. `label` is read anew before every step: pairs of one label are left out."""
        if not self.levels:
            return
        sizes, points, own = self.sizes[self.order], self.points[self.order], owner[self.order]
        keys = None if self.keys is None else self.keys[self.order]
        at = np.arange(0, len(own), LEAF)

        def items(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            i, j = ((x[:, None] * LEAF + np.arange(LEAF)) for x in (a, b))
            i, j = np.broadcast_to(i[:, :, None], (len(a), LEAF, LEAF)).ravel(), np.broadcast_to(j[:, None, :], (len(a), LEAF, LEAF)).ravel()
            keep = (i < j) & (j < len(own))
            i, j = i[keep], j[keep]
            keep = label[own[i]] != label[own[j]]
            if keys is not None:
                keep &= keys[i] == keys[j]
            keep &= (sizes[i] * rule.den >= sizes[j] * rule.num) & (sizes[j] * rule.den >= sizes[i] * rule.num)
            i, j = i[keep], j[keep]
            keep = rule.enough(np.minimum(points[i], points[j]).sum(axis=1), sizes[i], sizes[j]) if len(i) else np.zeros(0, bool)
            return own[i[keep]], own[j[keep]]

        rows = STEP // (LEAF * LEAF)
        for s in range(0, len(at), rows):
            same = np.arange(s, min(s + rows, len(at)))
            yield items(same, same)
        def wholes() -> list[np.ndarray]:
            """For every node of each level the label that all its items have, -1 where they differ."""
            low = high = label[own]
            found = []
            for width, *_ in reversed(self.levels):
                ends = np.arange(0, len(low), width)
                low, high = np.minimum.reduceat(low, ends), np.maximum.reduceat(high, ends)
                found.append(np.where(low == high, low, -1))
            return found[::-1]

        stack = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        whole, spent = wholes(), 0
        while stack:
            level, a, b = stack.pop()
            if spent > len(own):  # components only grow: labels read earlier leave out less, never more
                whole, spent = wholes(), 0
            spent += min(len(a), rows) * points.shape[1]
            if len(a) > rows:
                stack.append((level, a[rows:], b[rows:]))
                a, b = a[:rows], b[:rows]
            apart = (whole[level][a] < 0) | (whole[level][a] != whole[level][b])
            a, b = a[apart], b[apart]
            may = self._meet(level, a, b, rule)
            a, b = a[may], b[may]
            if level == len(self.levels) - 1:
                a, b = a[a != b], b[a != b]
                if len(a):
                    yield items(a, b)
            elif len(a):
                below = len(self.levels[level + 1][1])
                width = self.levels[level][0]
                x, y = ((n[:, None] * width + np.arange(width)) for n in (a, b))
                x, y = np.broadcast_to(x[:, :, None], (len(a), width, width)).ravel(), np.broadcast_to(y[:, None, :], (len(a), width, width)).ravel()
                keep = (x <= y) & (y < below)
                stack.append((level + 1, x[keep], y[keep]))


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of all pairs (a, b), in place; a component's label is its smallest member."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        differ = low != high
        if not differ.any():
            return
        up = np.arange(len(label))
        np.minimum.at(up, high[differ], low[differ])
        while (up[up] != up).any():
            up = up[up]
        label[:] = up[label]


def _rarity(docs: DataFrame, rule: Rule) -> np.ndarray:
    """The order of magnitude of how often each of COUNTERS groups of shingles occurs, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                value, _ = text_shingles(part.column("text"), rule.width, lower=True)
                total += np.bincount((value >> U64(46)).astype(np.int64), minlength=COUNTERS)
        slot = np.flatnonzero(total)
        for i in range(0, len(slot), 1 << 16):
            own = slot[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(total[own])], ["slot", "n"])

    sums = docs.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(COUNTERS, np.int64)
    total[np.asarray(sums["slot"])] = np.asarray(sums["n"])
    return np.log2(total + 1).astype(np.uint8)


def _keys(column: pa.Array, rule: Rule, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, set id) of the prefixes of a batch's distinct sets, rarest shingles first."""
    value, bounds, sid = sets(column, rule.width)
    n = np.diff(bounds)
    chosen = np.zeros(len(n), bool)
    chosen[np.unique(sid, return_index=True)[1]] = True
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((value, rarity[(value >> U64(46)).astype(np.int64)], doc))
    rank = np.arange(len(value)) - np.repeat(bounds[:-1], n)
    take = (rank < rule.prefix(n)[doc]) & chosen[doc]
    return value[order][take], sid[doc[take]]


def _edges_in(keys: np.ndarray, who: np.ndarray, points: list[np.ndarray], n: np.ndarray, rule: Rule) -> np.ndarray:
    """For every set its coarse component within one bucket: sets that share a key and whose points may link, found by the tree's join with itself."""
    label = np.arange(len(n))
    order = np.lexsort((who, keys))
    keys, who = keys[order], who[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (who[1:] != who[:-1])
    keys, who = keys[fresh], who[fresh]
    coarse = np.stack([np.minimum(fold(p[None, :], GROUPS)[0], LARGE) for p in points]).astype(np.int32) if points else np.zeros((0, GROUPS), np.int32)
    d = np.array([len(p) for p in points])
    for a, b in Tree(coarse[who], n[who], keys).pairs(rule, who, label):
        pair = np.unique(np.minimum(a, b).astype(np.uint64) << U64(32) | np.maximum(a, b).astype(np.uint64))
        a, b = (pair >> U64(32)).astype(np.int64), (pair & U64(0xFFFFFFFF)).astype(np.int64)
        least = np.minimum(d[a], d[b])
        for width in np.unique(least):
            x, y = a[least == width], b[least == width]
            if width > GROUPS:  # larger sets have finer points
                own, place = np.unique(np.concatenate([x, y]), return_inverse=True)
                flat = np.stack([fold(points[k][None, :], width)[0] for k in own.tolist()])
                u, v = place[: len(x)], place[len(x) :]
                part = max(1, (1 << 22) // int(width))
                ok = np.concatenate([rule.enough(np.minimum(flat[u[i : i + part]], flat[v[i : i + part]]).sum(axis=1), n[x[i : i + part]], n[y[i : i + part]]) for i in range(0, len(x), part)])
                x, y = x[ok], y[ok]
            merge(label, x, y)
    return label


def linked(values: list[np.ndarray], rule: Rule) -> np.ndarray:
    """For every set the number of the first set of its component, by verified links alone.

    Sets are taken by size. One is marked in a table of the tile's distinct shingles and all the tree's candidates that come later and are
    not in its component yet are counted against it in one step, so a set costs the shingles of its open candidates.
    """
    n = np.array([len(v) for v in values])
    label, open_ = np.arange(len(values)), np.ones(len(values), bool)
    tree = Tree(np.stack([point(v, int(dims(n.max(keepdims=True))[0])) for v in values]), n)
    distinct, code = np.unique(np.concatenate(values), return_inverse=True)
    code, starts = code.astype(np.int32), np.cumsum(n) - n
    marked = np.zeros(len(distinct), bool)
    for i in np.argsort(n, kind="stable").tolist():
        open_[i] = False
        near = tree.near(tree.points[i], int(n[i]), rule)
        near = near[open_[near] & (label[near] != label[i])]
        if not len(near):
            continue
        own = code[starts[i] : starts[i] + n[i]]
        marked[own] = True
        first = np.cumsum(n[near]) - n[near]
        at = np.repeat(starts[near] - first, n[near]) + np.arange(int(n[near].sum()))
        both = np.add.reduceat(marked[code[at]].astype(np.int64), first)
        marked[own] = False
        hit = near[rule.enough(both, n[i], n[near])]
        if len(hit):
            joined = np.unique(np.append(label[hit], label[i]))
            label[np.isin(label, joined)] = joined[0]
    return label


@dataclass
class Groups:
    """What is left to verify: documents with their sets' ids, classes of equal sets, and sets by coarse component and pair of tiles."""

    documents: DataFrame
    classes: DataFrame
    dealt: DataFrame
    split: bool


def groups(docs: DataFrame, rule: Rule) -> Groups:
    """Steps 1 and 2, and the sets of each coarse component brought together."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(spark), -(-total // BUCKET_TEXT))
    rarity = spark.sparkContext.broadcast(_rarity(docs, rule))

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, bounds, sid = sets(batch.column("text"), rule.width)
        n = np.diff(bounds)
        points = [np.minimum(point(value[a:b], d), 255).astype(np.uint8).tobytes() for a, b, d in zip(bounds[:-1].tolist(), bounds[1:].tolist(), dims(n).tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(sid), pa.array(n), pa.array(points, pa.binary())], ["doc_id", "th", "sid", "n", "point"])

    slim = cut(map_batches(docs, describe, "doc_id long, th long, sid long, n long, point binary"))
    # a set's text is that of one row: its smallest id (null last) and of equal ones the smallest hash
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "n")).alias("first")
    classes = slim.filter("n > 0").groupBy("sid").agg(first).select("sid", F.col("first.doc_id").alias("class_id"), F.col("first.th").alias("th"), F.col("first.n").alias("n"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                key, sid = _keys(part.column("text"), rule, rarity.value)
                bucket = (mix(key) % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, codes, sid = bucket[order], key[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:], sid[order]
                edges = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
                ends = [*edges[1:], len(bucket)]
                if edges:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[edges].astype(np.int32)), pa.array([codes[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()), pa.array([sid[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary())],
                        ["bucket", "keys", "sids"],
                    )

    def find_shared(table: pa.Table) -> pa.Table:
        """(key, sid) of keys that several sets have."""
        codes = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint8).reshape(-1, 6)
        raw = np.zeros((len(codes), 8), np.uint8)
        raw[:, :6] = codes
        key, sid = raw.view("<u8").ravel(), np.frombuffer(b"".join(table.column("sids").to_pylist()), np.int64)
        order = np.lexsort((sid, key))
        key, sid = key[order], sid[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
        key, sid = key[fresh], sid[fresh]
        several = np.zeros(len(key), bool)
        several[1:] = key[1:] == key[:-1]
        several[:-1] |= several[1:]
        return pa.table({"key": pa.array(key[several].astype(np.int64)), "sid": pa.array(sid[several])})

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sid, first, same = np.unique(np.asarray(table["sid"]), return_index=True, return_inverse=True)
        n, raw = np.asarray(table["n"])[first], table["point"].take(pa.array(first)).to_pylist()
        points = [np.frombuffer(x, np.uint8) for x in raw]
        # a count that filled its byte may be any larger number
        full = [np.where(x == 255, LARGE, x.astype(np.int64)) if k >= 255 else x.astype(np.int32) for x, k in zip(points, n.tolist(), strict=True)]
        root = _edges_in(np.asarray(table["key"]).astype(np.uint64), same, full, n, rule)
        tied = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(sid[tied]), "b": pa.array(sid[root[tied]])})

    shared = docs.mapInArrow(send, "bucket int, keys binary, sids binary").groupBy("bucket").applyInArrow(find_shared, "key long, sid long")
    points = slim.filter("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.first("point").alias("point"))
    met = shared.join(points.hint("merge"), "sid").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    edges = met.groupBy("bucket").applyInArrow(meet, "a long, b long")
    coarse = components(edges.distinct())
    members = cut(coarse.withColumnRenamed("node", "sid").join(classes, "sid"))
    per_group = members.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_SHINGLES)).cast("int").alias("tiles"))
    placed = members.join(per_group, "component").select("component", "class_id", "sid", "th", "tiles")
    split = placed.filter("tiles > 1").limit(1).count() > 0
    # texts always meet their places by a shuffle: what moves then follows the input, and no side has to be small
    meets = (docs["th"] == placed["th"]) & docs["doc_id"].eqNullSafe(placed["class_id"])
    texts = docs.join(placed.hint("merge"), meets).select(docs["th"], "component", "class_id", "sid", "tiles", "text").dropDuplicates(["th", "class_id", "sid"])

    def spell(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, bounds, sid = sets(batch.column("text"), rule.width)
        right = sid == np.asarray(batch.column("sid"))
        kept = [batch.column(c) for c in ("component", "class_id", "sid", "tiles")]
        made = pa.RecordBatch.from_arrays([*kept, pa.array([value[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["component", "class_id", "sid", "tiles", "shingles"])
        return made.filter(pa.array(right))

    spelled = map_batches(texts, spell, "component long, class_id long, sid long, tiles int, shingles binary")
    tile = F.pmod(F.xxhash64("sid"), F.col("tiles")).cast("int")
    dealt = spelled.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("component", "class_id", "sid", "shingles", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    return Groups(slim, classes, dealt, split)


def _rows(table: pa.Table) -> list[dict]:
    """The group's sets, by class id (null last) and set id."""
    return sorted(table.select(["sid", "class_id", "shingles"]).to_pylist(), key=lambda r: (r["class_id"] is None, r["class_id"], r["sid"]))


def join(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (smallest id with an equal set) of every document."""
    grouped = groups(docs, rule)
    slim, classes = grouped.documents, grouped.classes

    def verify(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        root = linked([np.frombuffer(r["shingles"], U64) for r in rows], rule)
        return pa.table({"a": pa.array([r["sid"] for r in rows], pa.int64()), "b": pa.array([rows[k]["sid"] for k in root.tolist()], pa.int64())})

    verified = grouped.dealt.groupBy("component", "low", "high").applyInArrow(verify, "a long, b long")
    if grouped.split:
        found = components(verified).select(F.col("node").alias("sid"), F.col("component").alias("root"))
    else:
        found = cut(verified.select(F.col("a").alias("sid"), F.col("b").alias("root")))  # read twice below
    # sets are joined by their own ids; the smallest document id of each component is looked up at the end
    within = found.join(classes.select("sid", "class_id"), "sid")
    lowest = within.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = classes.select("sid", "class_id").join(within.join(lowest, "root").select("sid", "component_id"), "sid", "left")
    full = slim.join(named.withColumnRenamed("sid", "named_sid"), (slim["sid"] == F.col("named_sid")) & (slim["n"] > 0), "left")
    return full.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "class_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"))


def links(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Every link between different sets: the smallest ids a < b of two classes and how many shingles they share.

    Copies are not expanded: `join` gives each document's class. Among near copies the links themselves grow with the square of a group; only
    who needs them all should ask for them.
    """
    grouped = groups(docs, rule)

    def verify(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        values = [np.frombuffer(r["shingles"], U64) for r in rows]
        n = np.array([len(v) for v in values])
        owner = np.repeat(np.arange(len(values)), n)
        flat = np.concatenate(values)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        out = []
        for i, own in enumerate(values):
            low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
            at = np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange(int((high - low).sum()))
            both = np.bincount(owner[at], minlength=len(values))
            hit = np.flatnonzero(rule.enough(both, n[i], n) & (both > 0))
            out += [(rows[i]["class_id"], rows[j]["class_id"], int(both[j])) for j in hit[hit > i].tolist()]
        a, b, c = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "shared": pa.array(c, pa.int64())})

    return grouped.dealt.groupBy("component", "low", "high").applyInArrow(verify, "a long, b long, shared long").distinct()
