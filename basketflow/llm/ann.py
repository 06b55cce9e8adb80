"""Nearest neighbours by inner product with balanced posting lists.

Centroids are fitted by k-means on a bounded sample of the vectors (``SAMPLE`` rows, by hash of the
id) and joined to their nearest neighbours in a small graph. Every vector is stored in the list of
its nearest centroid and, where it lies near a border, in those of other centroids whose distance
is within ``REPLICATE`` of the nearest (up to ``COPIES``); it finds them by walking the centroid graph
from fixed entry points with a beam of ``BEAM``. A query reads its nearest lists. How many is
measured on the table itself: ``PROBES`` of the queries are compared with all rows, and the lists read are as
many as give these probes a recall of ``RECALL``, up to all lists. Lists are cut into blocks of
bounded size by hash, so a list with a third of all rows is many tasks. Inside a block, all queries of the list meet its
vectors in matrix products of bounded size; blocks return their best ``k`` per query and those
are merged by rank. Lists are read in rounds, each ``WIDER`` times as far as the one before, and from the
second round on blocks return only what reaches the query's ``k``-th best so far: what is merged grows with
the logarithm of the lists and not with the lists, and nothing of the result is lost.

Inner product is turned into distance by one more coordinate: sqrt(M^2 - |x|^2) for a stored vector,
with M the largest norm, and 0 for a query, which is scaled to M. The squared distance is then 2M^2
less the inner product times a constant of the query, so long vectors are found too. Scores are inner products of the original vectors in double
precision.

Defined cases: vectors that are null, of another length than most, all zero, or hold null or
non-finite components take no part; null ids take no part; repeated rows of one id count once, and of
several vectors of one id the smallest; ties go to the smaller id; a query with fewer than ``k`` candidates
in the lists it reads reads all of them, so it gets ``k`` rows unless the table has fewer; an empty table
gives no rows; extra columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import texts as tx

SAMPLE = 20_000          # rows the centroids are fitted on, about, and
SAMPLE_COMPONENTS = 4_000_000    # their components together
ROUNDS = 8
LIST_ROWS = 400          # rows of a list, about
MAX_LISTS = 4096         # centroids at most; lists grow beyond that and are cut into blocks
NEIGHBOURS = 16          # edges of a centroid in the graph
BEAM = 64
REPLICATE = 1.15         # squared-distance ratio up to which a vector is copied to further lists
COPIES = 4
PROBES = 256             # queries compared with all rows to see how many lists must be read
RECALL = 0.99            # of the probes; the other queries differ from them by chance
WIDER = 4                # a round reads so many times the lists read before it
BLOCK = 4096             # rows of a block, about
TILE = 512               # queries multiplied at a time


@dataclass
class Index:
    """Centroids in the lengthened space, their graph, and the largest norm."""

    centroids: np.ndarray
    edges: np.ndarray
    largest: float

    def lengthen(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.largest ** 2 - (x ** 2).sum(axis=1), 0))
        return np.hstack([x, rest[:, None]])

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first walk over the graph for many points at once: ids and squared distances.

        All points advance together; each opens its nearest unopened centroid until its beam has
        none left.
        """
        n, size = len(x), len(self.centroids)
        beam = min(beam, size)
        entry = np.unique(np.linspace(0, size - 1, min(size, 16)).astype(int))
        found = np.full((n, beam), -1)
        far = np.full((n, beam), np.inf)
        opened = np.zeros((n, size), bool)
        seen = np.zeros((n, size), bool)

        def meet(rows, candidates):
            fresh = ~seen[rows[:, None], candidates]
            # An id may stand twice in a row of candidates only through padding with itself.
            seen[rows[:, None], candidates] = True
            d = ((x[rows][:, None, :] - self.centroids[candidates]) ** 2).sum(axis=2)
            d = np.where(fresh, d, np.inf)
            ids = np.hstack([found[rows], candidates])
            dist = np.hstack([far[rows], d])
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            found[rows] = np.take_along_axis(ids, order, 1)
            far[rows] = np.take_along_axis(dist, order, 1)

        meet(np.arange(n), np.tile(entry, (n, 1)))
        alive = np.arange(n)
        while len(alive):
            ids = np.maximum(found[alive], 0)
            open_ = ~opened[alive[:, None], ids] & np.isfinite(far[alive])
            go = open_.any(axis=1)
            alive, ids, open_ = alive[go], ids[go], open_[go]
            if not len(alive):
                break
            nearest = ids[np.arange(len(alive)), open_.argmax(axis=1)]
            opened[alive, nearest] = True
            meet(alive, self.edges[nearest])
        return found, far


    def nearest_first(self, q: np.ndarray) -> np.ndarray:
        """All lists in the order in which queries read them: one row of list numbers a query."""
        scaled = q * (self.largest / np.sqrt((q ** 2).sum(axis=1)))[:, None]
        # The further coordinate of a query is 0; its own norm adds the same to every distance.
        far = (self.centroids ** 2).sum(axis=1) - 2 * scaled @ self.centroids[:, :-1].T
        return np.argsort(far, axis=1, kind="stable")


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """id and components as doubles, without vectors that take no part."""
    rows = vectors.select(F.col(key).cast("long").alias("id"),
                          F.col(column).cast("array<double>").alias("v"))
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) \
        & F.exists("v", lambda c: c != 0)
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & good)


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(False).reshape(len(column), -1)


def fit(rows: DataFrame, n: int, dimensions: int, largest: float) -> Index:
    """Centroids from at most about SAMPLE rows, and their neighbour graph."""
    wanted = min(SAMPLE, SAMPLE_COMPONENTS // dimensions)
    share = int(min(1.0, wanted / n) * (1 << 30)) + 1
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(share)
    sample = rows.filter(draw).select("id", "v").dropDuplicates(["v"]).toArrow().sort_by("id")
    x = _matrix(sample.column("v")) if sample.num_rows else np.ones((1, dimensions))
    index = Index(np.empty((0, dimensions + 1)), np.empty((0, 1), int), largest)
    x = index.lengthen(x)
    k = int(min(max(1, n // LIST_ROWS), MAX_LISTS, max(1, len(x) // 4)))
    centre = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        owner = np.concatenate([np.argmin(
            (centre ** 2).sum(axis=1) - 2 * part @ centre.T, axis=1)
            for part in np.array_split(x, len(x) // 2048 + 1)])
        size = np.bincount(owner, minlength=k)
        sums = np.zeros_like(centre)
        np.add.at(sums, owner, x)
        centre = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centre)
    gap = (centre ** 2).sum(axis=1) - 2 * centre @ centre.T
    edges = np.argsort(gap, axis=1)[:, :NEIGHBOURS + 1]
    # A ring keeps the graph in one piece whatever the neighbours are.
    ring = np.stack([np.roll(np.arange(k), 1), np.roll(np.arange(k), -1)], axis=1)
    return Index(centre, np.hstack([edges, ring]), largest)


def _choose(index: Index, x: np.ndarray, ratio: float, most: int):
    """(row, list) of the lists a vector goes to: within ratio of the nearest."""
    rows, lists = [], []
    for low in range(0, len(x), TILE):
        ids, far = index.search(index.lengthen(x[low:low + TILE]), BEAM)
        ids, far = ids[:, :most], far[:, :most]
        keep = (far <= ratio * far[:, :1] + 1e-12) & np.isfinite(far)
        r, c = np.nonzero(keep)
        rows.append(r + low)
        lists.append(ids[r, c])
    return np.concatenate(rows), np.concatenate(lists)


def _assign(shared, ratio: float, most: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, lists = _choose(shared.value, _matrix(batch.column(1)), ratio, most)
            take = pa.array(rows)
            yield pa.record_batch({"id": batch.column(0).take(take),
                                   "v": batch.column(1).take(take),
                                   "list": lists.astype(np.int64)})
    return run


def _ask(shared, start: int, end: int):
    """Queries (id, v, bound), once for each list they read: of their order those from start to end."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1)) if batch.num_rows else np.empty((0, 1))
            for low in range(0, len(x), TILE):
                order = shared.value.nearest_first(x[low:low + TILE])[:, start:end]
                take = pa.array(np.repeat(np.arange(low, low + len(order)), order.shape[1]))
                yield pa.record_batch({"id": batch.column(0).take(take),
                                       "v": batch.column(1).take(take),
                                       "bound": batch.column(2).take(take),
                                       "list": order.ravel().astype(np.int64)})
    return run


def _probe(shared, k: int):
    """The k best of a partition for every probe: (query_id, vec_id, score)."""
    def run(batches):
        q_ids, q = shared.value
        score, ids = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            more = q @ _matrix(batch.column(1)).T
            more[q_ids[:, None] == own] = -np.inf
            score = np.hstack([score, more])
            ids = np.hstack([ids, np.broadcast_to(own, more.shape)])
            pick = np.argpartition(-score, k - 1, axis=1)[:, :k]
            score, ids = np.take_along_axis(score, pick, 1), np.take_along_axis(ids, pick, 1)
        r, c = np.nonzero(np.isfinite(score))
        yield pa.record_batch({"query_id": q_ids[r], "vec_id": ids[r, c], "score": score[r, c]})
    return run


def lists_to_read(rows: DataFrame, stored: DataFrame, index: Index, every: int, k: int) -> int:
    """How many of its nearest lists a query must read, measured on PROBES queries.

    Their k best of all rows are found exactly, and looked up in the lists that hold them.
    """
    spark = rows.sparkSession
    most = max(16, min(PROBES, SAMPLE_COMPONENTS // (k * (index.centroids.shape[1] - 1))))
    probes = (rows.filter(F.col("id") % every == 0)
              .orderBy(F.xxhash64("id"), "id").limit(most).select("id", "v").toArrow())
    if not probes.num_rows:
        return 1
    q_ids, q = probes.column("id").to_numpy(), _matrix(probes.column("v"))
    found = rows.select("id", "v").mapInArrow(_probe(spark.sparkContext.broadcast((q_ids, q)), k),
                                              "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = tx.stored(found.withColumn("rank", F.row_number().over(best))
                      .filter(F.col("rank") <= k).select("query_id", "vec_id"), "probes")
    # At most PROBES * k rows, each in COPIES lists at most.
    at = stored.select(F.col("id").alias("vec_id"), "list").join(F.broadcast(found), "vec_id") \
        .toArrow()
    if not at.num_rows:
        return 1
    turn = np.argsort(index.nearest_first(q), axis=1)            # list -> its place in the order
    by_id = np.argsort(q_ids)
    probe = by_id[np.searchsorted(q_ids[by_id], at.column("query_id").to_numpy())]
    place = turn[probe, at.column("list").to_numpy()]
    pairs = np.stack([probe, at.column("vec_id").to_numpy()])
    _, pair = np.unique(pairs, axis=1, return_inverse=True)
    first = np.full(pair.max() + 1, len(index.centroids))
    np.minimum.at(first, pair.ravel(), place)
    first.sort()
    return int(first[math.ceil(RECALL * len(first)) - 1]) + 1


def _distinct(ids: np.ndarray, x: np.ndarray, k: int):
    """Distinct vectors of a block, each with its smallest ids (k + 1 of them at most)."""
    order = np.unique(ids, return_index=True)[1]
    ids, x = ids[order], np.ascontiguousarray(x[order]) + 0.0       # -0.0 becomes 0.0
    raw = x.view(np.dtype((np.void, x.shape[1] * 8))).ravel()
    _, sample, back = np.unique(raw, return_index=True, return_inverse=True)
    by_vector = np.argsort(back, kind="stable")                     # ids stay ascending
    first = np.searchsorted(back[by_vector], np.arange(len(sample)))
    place = np.arange(len(ids)) - first[back[by_vector]]
    holders = np.full((len(sample), k + 1), -1)
    few = place <= k
    holders[back[by_vector][few], place[few]] = ids[by_vector][few]
    return x[sample], holders


def _best(q_ids: np.ndarray, q: np.ndarray, x: np.ndarray, holders: np.ndarray, k: int,
          bound: np.ndarray):
    """k best candidates per query that reach its bound: (query, id, score), equal scores to the
    smaller id.

    A matrix product picks the vectors; their scores are then summed in one fixed order, so that
    equal vectors score alike wherever they are stored.
    """
    rough = q @ x.T
    top = min(k + 8, len(x))
    pick = np.argpartition(-rough, top - 1, axis=1)[:, :top]
    exact = (q[:, None, :] * x[pick]).sum(axis=2)
    score = np.repeat(exact, k + 1, axis=1)
    ids = holders[pick].reshape(len(q), -1)
    score = np.where((ids < 0) | (ids == q_ids[:, None]), -np.inf, score)
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    query = np.repeat(q_ids, order.shape[1])
    ids = np.take_along_axis(ids, order, 1).ravel()
    score = np.take_along_axis(score, order, 1).ravel()
    keep = np.isfinite(score) & (score >= np.repeat(bound, len(score) // len(q_ids)))
    return query[keep], ids[keep], score[keep]


def _meet(k: int):
    def run(key, queries, vectors):
        out = []
        if queries.num_rows and vectors.num_rows:
            x, holders = _distinct(vectors.column("id").to_numpy(), _matrix(vectors.column("v")), k)
            q_ids, q = queries.column("id").to_numpy(), _matrix(queries.column("v"))
            bound = queries.column("bound").to_numpy()
            for low in range(0, len(q), TILE):
                out.append(_best(q_ids[low:low + TILE], q[low:low + TILE], x, holders, k,
                                 bound[low:low + TILE]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()),
                         "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})
    return run


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    # Of several vectors of one id the smallest counts, the same in every run.
    rows = tx.stored(usable(vectors).groupBy("id").agg(F.min("v").alias("v")), "vectors")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == common.d)
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    facts = rows.agg(F.count("*").alias("n"), F.sqrt(F.max(norm)).alias("largest")).first()
    index = fit(rows, facts.n, common.d, facts.largest)
    shared = spark.sparkContext.broadcast(index)         # MAX_LISTS centroids at most
    stored = tx.stored(rows.mapInArrow(_assign(shared, REPLICATE, COPIES),
                                       "id long, v array<double>, list long"), "postings")
    lists = lists_to_read(rows, stored, index, every, k)
    queries = rows.filter(F.col("id") % every == 0)
    found = _searched(queries, stored, shared, lists, k)
    # Lists of small isolated groups may hold too few candidates: such queries read all lists.
    got = found.groupBy("query_id").agg(F.count("*").alias("got"))
    short = tx.stored(
        queries.join(got, F.col("id") == F.col("query_id"), "left")
        .filter(F.coalesce("got", F.lit(0)) < min(k, facts.n - 1)).select("id", "v"), "short")
    if not short.isEmpty():
        more = _searched(short, stored, shared, len(index.centroids), k)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti") \
            .unionByName(more)
    return found


def _searched(queries: DataFrame, stored: DataFrame, shared, lists: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of the given number of lists, round by round."""
    sizes = tx.stored(stored.groupBy("list").agg(
        F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")), "sizes")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found, start = None, 0
    while start < lists:
        end = min(lists, max(1, WIDER * start))
        if found is None:
            bounded = queries.select("id", "v", F.lit(-math.inf).alias("bound"))
        else:
            reached = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
            bounded = queries.join(reached, F.col("id") == F.col("query_id"), "left").select(
                "id", "v", F.coalesce("bound", F.lit(-math.inf)).alias("bound"))
        more = _round(bounded, stored, sizes, shared, start, end, k)
        if found is not None:
            more = found.select("query_id", "vec_id", "score").unionByName(more)
        found = tx.stored(
            more.dropDuplicates(["query_id", "vec_id"])
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"), "found")
        start = end
    return found


def _round(queries: DataFrame, stored: DataFrame, sizes: DataFrame, shared, start: int, end: int,
           k: int) -> DataFrame:
    """(query_id, vec_id, score) out of the lists from start to end of each query's order."""
    asked = tx.stored(
        queries.mapInArrow(_ask(shared, start, end),
                           "id long, v array<double>, bound double, list long"), "asked")
    # Both sides of a list are dealt in blocks by hash, and every two blocks meet.
    turns = asked.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("turns"))
    cut = tx.stored(sizes.join(turns, "list"), "lists")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        rest = [c for c in side.columns if c != "list"]
        return side.join(cut, "list").select(
            "list", F.pmod(F.xxhash64("id"), F.col(own)).alias(own[:-1]),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[:-1]), *rest)

    cell = ["list", "block", "turn"]
    return (dealt(asked, "turns", "blocks").groupBy(*cell)
            .cogroup(dealt(stored, "blocks", "turns").groupBy(*cell))
            .applyInArrow(_meet(k), "query_id long, vec_id long, score double"))
