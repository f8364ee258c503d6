"""Exact top-k by inner product with M-trees searched best-first.

The inner product becomes a metric by one more coordinate: with M the largest
squared norm, v' = (v, sqrt(M - |v|^2)) and q' = (q, 0) have |q' - v'|^2 =
|q|^2 + M - 2 <q, v>.  Equal vectors are one entry that carries its smallest ids.
Entries are dealt to regions by their nearest pivot and, within a region, to blocks
by their distance to it; each block is an M-tree of paged nodes with covering radii
and distances to the parent.

A query first searches the block in which it lies itself as a vector.  What it found
there bounds what others may add: by the triangle inequality with the pivots and
the blocks' ranges of distances, it is sent only to blocks that may hold better
ones.  There a tree's nodes are visited best-first, and what the stored distances
exclude is neither visited nor computed.  Scores are exact integers; bounds carry a
margin for rounding.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

#: Entries of a block, about, entries of a tree's node, queries of a batch, batches that share one copy of a tree.
BLOCK, PAGE, BATCH, TOGETHER = 2048, 64, 512, 64
#: Pivots at most of each length of vectors; they and their regions' radii are all that is broadcast.
PIVOTS = 512
#: Parts that the copies of a vector are dealt to before their ids are gathered.
SALTS = 16
#: The score of vectors whose inner product needs over 64 bits.
LARGEST = 2**63 - 1


def with_norm(x: np.ndarray, top: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))[:, None]], 1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0))


def build(uid: np.ndarray, x: np.ndarray, top: float) -> dict:
    """A tree as arrays.  Node k has the centre point[k], the covering radius, the distance to its parent's centre, and children or entries."""
    order = np.argsort(uid)
    uid, x = uid[order], x[order]
    point = with_norm(x, top)
    nodes: list[dict] = []

    def split(members: np.ndarray, parent: int | None) -> int:
        centre = int(members[((point[members] - point[members].mean(0)) ** 2).sum(1).argmin()])
        own = distances(point[members], point[centre : centre + 1])[:, 0]
        away = 0.0 if parent is None else float(np.sqrt(((point[centre] - point[parent]) ** 2).sum()))
        node = {"centre": centre, "radius": float(own.max()), "away": away}
        k = len(nodes)
        nodes.append(node)
        if len(members) <= PAGE:
            node |= {"entries": members, "reach": own}
            return k
        fan = min(PAGE, -(-len(members) // PAGE))
        # far points in turn as routing objects, then each entry to the nearest of them that has room
        routes, near = [], np.full(len(members), np.inf)
        far = int(own.argmax())
        for _ in range(fan):
            routes.append(far)
            near = np.minimum(near, distances(point[members], point[members[far]][None])[:, 0])
            far = int(near.argmax())
        gaps = distances(point[members], point[members[routes]])
        room = -(-len(members) // fan) * 5 // 4 + 1
        taken, goes = np.zeros(fan, int), np.full(len(members), -1)
        for flat in np.argsort(gaps, axis=None, kind="stable"):
            i, r = divmod(int(flat), fan)
            if goes[i] < 0 and taken[r] < room:
                goes[i] = r
                taken[r] += 1
        node["children"] = [split(members[goes == r], centre) for r in range(fan) if taken[r]]
        return k

    split(np.arange(len(uid)), None)
    return {"uid": uid, "x": x, "nodes": nodes}


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integers in 64 bits; those beyond are LARGEST or -LARGEST."""
    out = q @ x.T
    wide = np.abs(q.astype(np.float64)) @ np.abs(x.astype(np.float64)).T >= 2.0**62
    for i, j in zip(*np.nonzero(wide), strict=True):
        whole = sum(a * b for a, b in zip(q[i].tolist(), x[j].tolist(), strict=True))
        out[i, j] = max(-LARGEST, min(LARGEST, whole))
    return out


class Search:
    """The best k entries so far of a batch of queries."""

    def __init__(self, uid: np.ndarray, q: np.ndarray, k: int, top: float, floor: np.ndarray | None = None):
        self.uid, self.k, self.top = uid, k, top
        self.exact = float(np.abs(q).max(initial=0)) * max(np.sqrt(top), 1.0) * np.sqrt(max(1, q.shape[1])) < 2**52
        self.q = q.astype(np.float64 if self.exact else np.int64)
        self.query = np.concatenate([q.astype(np.float64), np.zeros((len(q), 1))], 1)
        self.square = (self.query**2).sum(1)
        self.margin = 1e-6 * (1 + np.sqrt(self.square.max(initial=0) + top))
        self.none = -np.inf if self.exact else np.iinfo(np.int64).min
        self.score = np.full((len(q), k), self.none, self.q.dtype)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max)
        self.floor = np.full(len(q), -np.inf) if floor is None else floor

    def limit(self, rows: np.ndarray) -> np.ndarray:
        """The distance beyond which no entry is among the best k of these queries."""
        worst = np.maximum(np.where(self.score[rows, -1] == self.none, -np.inf, self.score[rows, -1]), self.floor[rows])
        with np.errstate(invalid="ignore"):
            return np.where(np.isinf(worst), np.inf, np.sqrt(np.maximum(self.square[rows] + self.top - 2 * worst, 0))) + self.margin

    def floors(self) -> np.ndarray:
        """A score that k entries reach, for each query; none where fewer were found."""
        return np.where(self.score[:, -1] == self.none, -np.inf, self.score[:, -1].astype(np.float64))

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, entry and score of what was found; nothing below the floor it began with."""
        hit = (self.found < np.iinfo(np.int64).max) & (self.score.astype(np.float64) >= self.floor[:, None])
        owner = np.broadcast_to(self.uid[:, None], hit.shape)[hit]
        return owner, self.found[hit], self.score[hit].astype(np.int64)

    def scores(self, rows: np.ndarray | slice, x: np.ndarray) -> np.ndarray:
        return self.q[rows] @ x.T if self.exact else products(self.q[rows], x)

    def put(self, rows: np.ndarray, score: np.ndarray, uid: np.ndarray) -> None:
        better = (score >= self.score[rows, -1:]).any(1)
        rows, score = rows[better], score[better]
        if not len(rows):
            return
        s = np.concatenate([self.score[rows], score], 1)
        u = np.concatenate([self.found[rows], np.broadcast_to(uid, score.shape)], 1)
        # ~s, as -s has no room for the smallest integer, which marks empty places
        best = np.lexsort((u, -s if self.exact else ~s), axis=1)[:, : self.k]
        self.score[rows], self.found[rows] = np.take_along_axis(s, best, 1), np.take_along_axis(u, best, 1)

    def tree(self, tree: dict) -> None:
        nodes, point = tree["nodes"], with_norm(tree["x"], self.top)
        x = tree["x"].astype(self.q.dtype)
        rows = np.arange(len(self.uid))
        gap = distances(self.query, point[nodes[0]["centre"]][None])[:, 0]
        heap = [(float((gap - nodes[0]["radius"]).min(initial=0)), 0, rows, gap)]
        while heap:
            _, k, rows, gap = heapq.heappop(heap)
            node, limit = nodes[k], self.limit(rows)
            live = gap - node["radius"] <= limit
            rows, gap, limit = rows[live], gap[live], limit[live]
            if not len(rows):
                continue
            if "entries" in node:
                may = np.abs(gap[:, None] - node["reach"][None]) <= limit[:, None]
                some, of = may.any(1), may.any(0)
                at = node["entries"][of]
                self.put(rows[some], self.scores(rows[some], x[at]), tree["uid"][at])
                continue
            for c in node["children"]:
                child = nodes[c]
                near = np.abs(gap - child["away"]) - child["radius"] <= limit
                if near.any():
                    own = distances(self.query[rows[near]], point[child["centre"]][None])[:, 0]
                    low = own - child["radius"]
                    keep = low <= limit[near]
                    if keep.any():
                        heapq.heappush(heap, (float(low[keep].min()), c, rows[near][keep], own[keep]))


def matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0), np.int64)


def entries(vectors: DataFrame, id_col: str, vector: str, k: int) -> DataFrame:
    """uid, ids, x, norm: a row per different vector with its k + 1 smallest ids, of which uid is the first."""
    salted = vectors.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
    order = F.dense_rank().over(Window.partitionBy(vector, "_salt").orderBy(id_col))
    few = salted.withColumn("_r", order).filter(F.col("_r") <= k + 1).groupBy(vector, "_salt").agg(F.collect_set(id_col).alias("ids"))
    ids = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    whole = few.groupBy(vector).agg(ids.alias("ids")).withColumnRenamed(vector, "x")
    norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v)
    return whole.select(F.get("ids", F.lit(0)).alias("uid"), "ids", "x", norm.alias("norm"), F.size("x").alias("dim"))


def quantised(df: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """Rows with an id whose vector has no null or non-finite component: id, x (floor(scale * component))."""
    fine = F.col(id_col).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda v: F.coalesce(F.abs(v.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(v))
    return df.filter(fine).select(F.col(id_col).cast("long").alias("id"), F.transform(vector, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("long")).alias("x"))


def home_and_trees(blocks: DataFrame, k: int, tops: dict[int, float]) -> DataFrame:
    """For each block a row of its tree and range of distances, and rows of what its own queries found in it."""

    def plant(table: pa.Table) -> pa.Table:
        uid, x, away = table.column("uid").to_numpy(), matrix(table.column("x").combine_chunks()), table.column("away").to_numpy()
        top = tops[x.shape[1]]
        tree = build(uid, x, top)
        pivot, share = (table.column(c)[0].as_py() for c in ("pivot", "share"))
        found = [(pivot, share, float(away.min()), float(away.max()), pickle.dumps(tree), None)]
        own = np.flatnonzero(table.column("asks").to_numpy())
        for at in range(0, len(own), BATCH):
            search = Search(uid[own[at : at + BATCH]], x[own[at : at + BATCH]], k + 1, top)
            search.tree(tree)
            found.append((pivot, share, None, None, None, pickle.dumps((search.uid, x[own[at : at + BATCH]], search.floors(), search.hits()))))
        types = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("pivot", "share", "low", "high", "tree", "asked"), zip(*found, strict=True), types, strict=True)})

    return blocks.groupBy("pivot", "share").applyInArrow(plant, "pivot int, share int, low double, high double, tree binary, asked binary")


def top_k(df: DataFrame, k: int, every: int, id_col: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """The k highest scores of each query, a row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Candidates are all rows but those with the query's id; ties go to the smaller
    vec_id; with fewer candidates, all are returned.  Null vectors, those with null
    or non-finite components, and rows without id take no part.  Repeated rows count
    once.  Only vectors of as many components as the query's are compared.  Other
    columns don't matter.  An empty table gives no rows.  A score of the result that
    needs over 64 bits is an error, as in SQL.
    """
    spark = df.sparkSession
    rows = quantised(df, id_col, vector, scale)
    unique = save(entries(rows, "id", "x", k), "entries")
    shapes = {r["dim"]: (r["n"], float(r["top"])) for r in unique.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("top")).collect()}
    ask = rows.filter(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "x").join(unique.select("uid", "x"), "x").select("query_id", "uid").distinct()
    hits = _searched(unique, ask.select("uid").distinct(), k, shapes) if shapes else spark.createDataFrame([], "quid long, uid long, score long")
    best = Window.partitionBy("quid").orderBy(F.desc("score"), "uid")
    hits = hits.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1).drop("_r")
    whole = hits.join(unique.select("uid", "ids"), "uid").select("quid", "score", F.explode("ids").alias("vec_id"))
    near = Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id")
    whole = whole.withColumn("_r", F.row_number().over(near)).filter(F.col("_r") <= k + 1).drop("_r")
    own = Window.partitionBy("query_id", "quid").orderBy(F.desc("score"), "vec_id")
    out = ask.withColumnRenamed("uid", "quid").join(whole, "quid").filter(F.col("vec_id") != F.col("query_id")).withColumn("rank", F.row_number().over(own))
    whole = F.when(F.abs("score") == LARGEST, F.raise_error(F.lit("a score needs over 64 bits"))).otherwise(F.col("score"))
    return out.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", whole.cast("long").alias("score"))


def _searched(unique: DataFrame, asked: DataFrame, k: int, shapes: dict[int, tuple[int, float]]) -> DataFrame:
    """quid, uid and score of the k + 1 best entries of each query, and of others; ``shapes``: number and largest squared norm by length of vectors."""
    spark = unique.sparkSession
    tops = {d: t for d, (_, t) in shapes.items()}
    counts = {d: max(1, min(PIVOTS, -(-n // BLOCK))) for d, (n, _) in sorted(shapes.items())}
    # pivots are numbered over all lengths
    first = dict(zip(counts, np.cumsum([0, *counts.values()]).tolist(), strict=False))
    many = [d for d, c in counts.items() if c > 1]
    seeds: dict[int, list] = {}
    if many:
        order = Window.partitionBy("dim").orderBy(F.xxhash64("uid"), "uid")
        few = unique.filter(F.col("dim").isin(many)).select("dim", "uid", "x").withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= PIVOTS)
        for r in few.orderBy("dim", "_r").collect():
            seeds.setdefault(r["dim"], []).append(r["x"])
    pivots = spark.sparkContext.broadcast({d: with_norm(np.array(x[: counts[d]], np.int64), tops[d]) for d, x in seeds.items()})

    def deal(batches):
        for b in batches:
            dims, rows = b.column("dim").to_numpy(), b.column("x")
            pivot, away = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                if d in pivots.value:
                    gap = distances(with_norm(matrix(rows.take(pa.array(at))), tops[d]), pivots.value[d])
                    pivot[at], away[at] = gap.argmin(1), gap.min(1)
                pivot[at] += first[d]
            yield pa.RecordBatch.from_arrays([b.column("uid"), rows, b.column("asks"), pa.array(pivot), pa.array(away)], ["uid", "x", "asks", "pivot", "away"])

    marked = unique.select("uid", "x", "dim").join(asked.withColumn("asks", F.lit(True)), "uid", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    dealt = save(marked.select("uid", "x", "dim", "asks").mapInArrow(deal, "uid long, x array<long>, asks boolean, pivot int, away double"), "dealt")
    # a region's blocks are rings about its pivot: neighbouring steps of distance share a block, a crowded step has several
    regions = dealt.groupBy("pivot").agg(F.count("*").alias("n"), F.min("away").alias("near"), F.max("away").alias("far"))
    reach = spark.sparkContext.broadcast({r["pivot"]: (r["near"], r["far"]) for r in regions.collect()})
    regions = regions.withColumn("steps", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("width", (F.col("far") - F.col("near")) / F.col("steps")).drop("n", "far")
    step = F.when(F.col("width") > 0, F.least(F.floor((F.col("away") - F.col("near")) / F.col("width")), F.col("steps") - 1)).otherwise(0).cast("int")
    stepped = dealt.join(F.broadcast(regions), "pivot").withColumn("step", step).select("uid", "x", "asks", "pivot", "away", "step")
    sizes = stepped.groupBy("pivot", "step").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("pivot").orderBy("step")) - F.col("n")
    rings = sizes.select("pivot", "step", F.floor(before / BLOCK).alias("ring"), F.ceil(F.col("n") / BLOCK).cast("int").alias("many"))
    share = F.when(F.col("many") > 1, F.hash("step", F.pmod(F.xxhash64("uid"), F.col("many")))).otherwise(F.hash(F.lit("ring"), "ring"))
    planted = save(home_and_trees(stepped.join(rings, ["pivot", "step"]).select("uid", "x", "asks", "pivot", "away", share.alias("share")), k, tops), "planted")
    batches_of, trees_of = (planted.filter(F.col(c).isNotNull()) for c in ("asked", "tree"))

    def routes(batches):
        """For each batch of queries, the regions that its bounds don't exclude, with the distances to the pivot in question."""
        names, types = ["pivot", "home", "home_share", "from", "to", "data"], [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.binary()]
        for b in batches:
            for home, home_share, asked_ in zip(*(b.column(c) for c in ("pivot", "share", "asked")), strict=True):
                uid, q, floor, _ = pickle.loads(asked_.as_buffer())
                d = q.shape[1]
                if d not in pivots.value:
                    continue
                limit = limits(q, floor, tops[d])
                gap = distances(np.concatenate([q.astype(np.float64), np.zeros((len(q), 1))], 1), pivots.value[d])
                for p in range(gap.shape[1]):
                    low, high = reach.value.get(first[d] + p, (np.inf, -np.inf))
                    live = (gap[:, p] - limit <= high) & (gap[:, p] + limit >= low)
                    if live.any():
                        g, m = gap[live, p], limit[live]
                        row = (first[d] + p, home.as_py(), home_share.as_py(), float((g - m).min()), float((g + m).max()), pickle.dumps((uid[live], q[live], floor[live], g, m)))
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

    # slices of the batches, so that a region isn't one task
    slice_ = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("slice")
    routed = batches_of.select("pivot", "share", "asked").mapInArrow(routes, "pivot int, home int, home_share int, from double, to double, data binary").withColumn("slice", F.pmod(F.xxhash64("home", "home_share"), F.lit(SALTS)).cast("int"))
    met = routed.join(trees_of.select("pivot", "share", "low", "high", slice_), ["pivot", "slice"]).filter((F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from")) & ((F.col("pivot") != F.col("home")) | (F.col("share") != F.col("home_share"))))
    met = save(met.select("pivot", "share", "low", "high", F.xxhash64("home", "home_share", "data").alias("batch"), "data"), "routed")
    copies = met.groupBy("pivot", "share").agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("parts"))
    asks = met.join(copies, ["pivot", "share"]).select("pivot", "share", F.pmod("batch", "parts").cast("int").alias("part"), F.lit(1).alias("kind"), "low", "high", "data")
    trees = trees_of.join(copies, ["pivot", "share"]).select("pivot", "share", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "low", "high", F.col("tree").alias("data"))
    work = trees.union(asks).repartition("pivot", "share", "part").sortWithinPartitions("pivot", "share", "part", "kind")

    def search(batches):
        at, tree = None, None
        for b in batches:
            for i in range(b.num_rows):
                pivot, share, part, kind, low, high = (b.column(c)[i].as_py() for c in ("pivot", "share", "part", "kind", "low", "high"))
                data = pickle.loads(b.column("data")[i].as_buffer())
                if kind == 0:
                    at, tree = (pivot, share, part), data
                elif at == (pivot, share, part):
                    uid, q, floor, gap, limit = data
                    live = (gap - limit <= high) & (gap + limit >= low)
                    state = Search(uid[live], q[live], k + 1, tops[q.shape[1]], floor[live])
                    state.tree(tree)
                    yield hit_rows(*state.hits())

    def at_home(batches):
        for b in batches:
            for data in b.column("asked"):
                yield hit_rows(*pickle.loads(data.as_buffer())[3])

    schema = "quid long, uid long, score long"
    return batches_of.select("asked").mapInArrow(at_home, schema).union(work.mapInArrow(search, schema))


def hit_rows(quid: np.ndarray, uid: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(quid, pa.int64()), pa.array(uid, pa.int64()), pa.array(score, pa.int64())], ["quid", "uid", "score"])


def limits(q: np.ndarray, floor: np.ndarray, top: float) -> np.ndarray:
    """The distance within which each query's best entries lie, given a score that enough entries reach."""
    square = (q.astype(np.float64) ** 2).sum(1)
    known = np.isfinite(floor)
    reached = np.sqrt(np.maximum(square + top - 2 * np.where(known, floor, 0), 0))
    return np.where(known, reached, np.inf) + 1e-6 * (1 + np.sqrt(square + top))
