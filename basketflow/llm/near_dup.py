"""Near-duplicate documents: HyperMinHash sketches, banding, exact confirmation, components.

A document is the set of its distinct five-word shingles (A-Z lower-cased); with fewer words the
whole sequence is one shingle. A sketch has one 16-bit register for each of 128 hash ranges: the
leading zeros of the smallest hash in the range (6 bits) and the 10 bits that follow. Exact copies
fold into one class first. Four registers make a band; classes that share a band meet in a bucket.
Their Jaccard similarity is estimated from equal registers, corrected for chance collisions. A
class without a partner that could reach the threshold (4.5 standard deviations of slack) goes no
further.

A bucket of n classes is never expanded into its pairs. Every class names one hub, the most typical
class of the bucket it resembles most; classes connected through hubs form a cluster. Inside
a cluster all intersections are counted exactly on full shingle sets, in cells of bounded size that
together hold every pair, and a cell returns one link per class, not its pairs. Where a bucket holds
classes of different clusters, those that could reach one another are named
(a row a class and bucket, no pairs), equal groups from several buckets fold into one, and each
group is counted exactly in the same cells. After that every pair that shares a bucket has been
decided on full sets.

Defined cases: documents without words (null, empty, blanks) have 0 shingles and stay alone; rows
with a null doc_id take no part and are kept with a null component; rows that repeat a doc_id
and text share one class, so all of them carry the verdict of that document; rows that repeat a
doc_id with other texts are judged text by text; of equal documents the smallest doc_id stays; very
long texts are a chunk of their own; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx

SHINGLE = 5
REGISTERS = 128
BAND = 4
MANTISSA = 10
CELL = 2048           # classes of a bucket or cluster compared in one piece
CELL_SHINGLES = 1 << 20    # shingles of a cluster in one piece, about
RARE = 16             # holders up to which a shingle's pairs are counted one by one
SLACK = 4.5           # standard deviations granted to the estimate
AT_ONCE = 16          # rows estimated against a cell at a time, which bounds memory

_BUCKET_BITS = 7
_LIMITS = np.arange(1, REGISTERS, dtype=np.uint64) << np.uint64(64 - _BUCKET_BITS)
# Two different minima share the leading zeros about once in three, then all mantissa bits.
_COLLISION = 2.0 ** -MANTISSA / 3


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    lower = tx.ASCII_LOWER[data]
    starts, ends, first = tx.words(lower, offsets)
    hashes = tx.span_hash(tx.prefix_hash(lower), starts, ends)
    windows = tx.window_hash(hashes, SHINGLE)
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(windows[a:b - SHINGLE + 1]))
        elif b > a:
            out.append(tx.mix(tx.window_hash(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per set; 0 marks an empty range."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    for i, own in enumerate(sets):
        if not len(own):
            continue
        at = np.concatenate([[0], np.searchsorted(own, _LIMITS)])
        full = np.flatnonzero(np.diff(at, append=len(own)))
        rest = own[at[full]] << np.uint64(_BUCKET_BITS)
        zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
        tail = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
        out[i, full] = ((zeros + 1).astype(np.uint64) << np.uint64(MANTISSA)) | tail
    return out


def estimate(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated Jaccard similarity of register rows (broadcasting), and registers in use."""
    used = ((left != 0) | (right != 0)).sum(axis=-1)
    same = ((left == right) & (left != 0)).sum(axis=-1)
    rate = same / np.maximum(used, 1)
    return np.clip((rate - _COLLISION) / (1 - _COLLISION), 0, 1), used


def could_reach(j: np.ndarray, used: np.ndarray, percent: int) -> np.ndarray:
    t = percent / 100
    return (used < 32) | (j + SLACK * np.sqrt(t * (1 - t) / np.maximum(used, 1)) >= t)


def _sketch(batches):
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for low, high, data, offsets in tx.text_chunks(batch):
            sets = shingle_sets(data, offsets)
            keys = [(np.add.reduce(tx.mix(s)), np.add.reduce(tx.mix(s ^ np.uint64(0x5BD1E995))))
                    for s in sets]
            yield pa.record_batch({
                "doc_id": ids.slice(low, high - low),
                "n_shingles": np.array([len(s) for s in sets], np.int64),
                "node": np.array([k[0] for k in keys], np.uint64).view(np.int64),
                "check": np.array([k[1] for k in keys], np.uint64).view(np.int64),
                "regs": pa.array([r.tobytes() for r in registers(sets)], pa.binary())})


def _regs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _bands(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        packed = _regs(batch.column(1)).view(np.uint64)       # four registers in each word
        salt = tx.mix(np.arange(1, packed.shape[1] + 1, dtype=np.uint64))
        row, band = np.nonzero(packed)
        yield pa.record_batch({
            "key": tx.mix(packed[row, band] + salt[band]).view(np.int64),
            "node": batch.column(0).to_numpy()[row]})


def _groups(batches, key: str):
    """Runs of equal keys in sorted input, also across batches, as tables."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        keys = table.column(key).to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        bounds = np.concatenate([[0], cuts])
        for a, b in zip(bounds, bounds[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(bounds[-1]) if len(keys) else None
    if rest is not None and rest.num_rows:
        yield rest


def _typical(regs: np.ndarray) -> np.ndarray:
    """For each class of a bucket, how many registers hold the bucket's most frequent value."""
    score = np.zeros(len(regs), np.int64)
    for column in regs.T:
        value, back, count = np.unique(column, return_inverse=True, return_counts=True)
        count[value == 0] = 0
        score += back == np.argmax(count)
    return score


def _possible(regs, size, part, percent: int):
    """Estimates of some rows against all, and which pairs could reach the threshold."""
    j, used = estimate(regs[part][:, None, :], regs[None, :, :])
    na, nb = size[part][:, None], size[None, :]
    good = could_reach(j, used, percent) \
        & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
    return j, good


def _propose(percent: int):
    """Per cell of a bucket: (class, hub, estimate) of the classes with a possible partner."""
    def run(batches):
        for table in _groups(batches, "cell"):
            if table.num_rows < 2:
                continue
            node, size = table.column("node").to_numpy(), table.column("n").to_numpy()
            regs = _regs(table.column("regs").combine_chunks())
            found = np.zeros(len(node), bool)
            for low in range(0, len(node), AT_ONCE):
                part = np.arange(low, min(low + AT_ONCE, len(node)))
                _, good = _possible(regs, size, part, percent)
                good[np.arange(len(part)), part] = False
                found[part] = good.any(axis=1)
            own = np.flatnonzero(found)
            if not len(own):
                continue
            score = _typical(regs[own]) if len(own) > 2 else -own
            hub = own[np.lexsort((node[own], -score))[0]]
            j, _ = estimate(regs[own], regs[hub])
            yield pa.record_batch({"a": node[own], "b": np.full(len(own), node[hub]), "j": j})
    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all pairwise intersections.

    Shingles with few holders are counted pair by pair, the others as products of 0/1 matrices.
    """
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    count = np.diff(np.append(first, len(flat)))
    common = np.zeros((m, m), np.int64)
    for c in range(2, RARE + 1):
        at = first[count == c]
        if len(at):
            holders = owner[at[:, None] + np.arange(c)]
            for x in range(c):
                for y in range(x + 1, c):
                    np.add.at(common, (holders[:, x], holders[:, y]), 1)
    common += common.T
    often = np.flatnonzero(count > RARE)
    for low in range(0, len(often), 2048):
        part = often[low:low + 2048]
        size = count[part]
        at = np.repeat(first[part] - np.cumsum(size) + size, size) + np.arange(size.sum())
        block = np.zeros((m, len(part)), np.float32)
        block[owner[at], np.repeat(np.arange(len(part)), size)] = 1
        common += np.rint(block @ block.T).astype(np.int64)
    np.fill_diagonal(common, [len(s) for s in sets])
    return common


def _exact_cell(percent: int):
    """Per cell of a cluster: links that connect what is connected in it."""
    def run(batches):
        for table in _groups(batches, "cell"):
            if table.num_rows < 2:
                continue
            node = table.column("node").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
            size = np.array([len(x) for x in sets])
            common = intersections(sets)
            linked = 100 * common >= percent * (size[:, None] + size[None, :] - common)
            label = np.arange(len(node))
            while True:
                best = np.where(linked, label[None, :], len(node)).min(axis=1)
                best = best[best]
                if (best == label).all():
                    break
                label = best
            far = np.flatnonzero(label != np.arange(len(node)))
            yield pa.record_batch({"a": node[far], "b": node[label[far]]})
    return run


def _reachable(percent: int):
    """Per cell of a bucket: its classes that could reach a class of another cluster, as a group
    named by its members."""
    def run(batches):
        for table in _groups(batches, "cell"):
            node, cluster = table.column("node").to_numpy(), table.column("cluster").to_numpy()
            home, pair = table.column("home").to_numpy(), table.column("pair").to_numpy()
            if len(node) < 2 or (cluster == cluster[0]).all():
                continue
            size = table.column("n").to_numpy()
            regs = _regs(table.column("regs").combine_chunks())
            found = np.zeros(len(node), bool)
            for low in range(0, len(node), AT_ONCE):
                part = np.arange(low, min(low + AT_ONCE, len(node)))
                _, good = _possible(regs, size, part, percent)
                good &= cluster[part][:, None] != cluster[None, :]
                if pair[0]:     # a cell of two blocks: pairs inside a block have their own cell
                    good &= home[part][:, None] != home[None, :]
                found[part] = good.any(axis=1)
            own = node[found]
            if len(own):
                name = np.add.reduce(tx.mix(own.view(np.uint64))).view(np.int64)
                yield pa.record_batch({"group": np.full(len(own), name), "node": own})
    return run


def _full_sets(batches):
    for batch in batches:
        wanted = batch.column(batch.schema.get_field_index("node")).to_numpy()
        for low, high, data, offsets in tx.text_chunks(batch):
            sets = shingle_sets(data, offsets)
            node = np.array([np.add.reduce(tx.mix(s)) for s in sets], np.uint64).view(np.int64)
            own = np.flatnonzero(node == wanted[low:high])
            yield pa.record_batch({
                "node": node[own],
                "set": pa.array([sets[i].tobytes() for i in own], pa.binary())})


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, by repeated contraction.

    Each round every node moves to the neighbour (or itself) with the smallest hash under the
    round's seed, so paths shrink by a constant share; the moves are then followed in order.
    """
    moves = []
    edges = tx.stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    while not edges.isEmpty():
        seed = F.lit(len(moves))
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")) \
            .union(edges.select("b", "a"))
        best = both.groupBy("node").agg(F.min(F.struct(
            F.xxhash64("to", seed).alias("h"), F.col("to").alias("to"))).alias("best"))
        own = F.struct(F.xxhash64("node", seed).alias("h"), F.col("node").alias("to"))
        move = tx.stored(best.select("node", F.least("best", own)["to"].alias("to")), "moves")
        moves.append(move)
        edges = tx.stored(
            edges.join(move.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(move.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .filter("a <> b").distinct(), "edges")
    result = nodes.withColumn("root", F.col("node"))
    for move in moves:
        result = result.join(move.select(F.col("node").alias("root"), "to"), "root", "left") \
            .select("node", F.coalesce("to", "root").alias("root"))
    return tx.stored(result, "components")


def _full(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set) of some classes, from the text of one holder each.

    Always a merge join: the texts are shuffled once at any size, the sets never more than needed.
    """
    holders = classes.join(nodes, "node", "left_semi").select("node", F.col("rep").alias("doc_id"))
    texts = docs.join(holders.hint("merge"), "doc_id").select("node", "text")
    return tx.stored(tx.mapped(texts, _full_sets, "node long, set binary").dropDuplicates(["node"]),
                     "sets")


def _cells(rows: DataFrame, key: str, blocks) -> DataFrame:
    """Deal the rows of each key in blocks; every two blocks of a key meet in one cell."""
    return (rows.withColumn("blocks", blocks)
            .withColumn("home", F.pmod(F.xxhash64("node"), F.col("blocks")))
            .withColumn("mate", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("cell", F.xxhash64(key, F.least("home", "mate"), F.greatest("home", "mate")))
            .withColumn("pair", F.col("home") != F.col("mate")))


def _by_cell(rows: DataFrame) -> DataFrame:
    return rows.repartition("cell").sortWithinPartitions("cell", "node")


def _bucket_blocks():
    return F.ceil(F.col("size") / CELL).cast("long")


def link(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Two documents are linked when 100 * intersection >= percent * union of their shingle sets.
    """
    with tx.temporary(docs.sparkSession):
        return _verdicts(docs, percent).drop("node")


def _verdicts(docs: DataFrame, percent: int) -> DataFrame:
    docs = tx.need(docs, "doc_id", "text")
    sketches = tx.stored(tx.mapped(
        docs, _sketch, "doc_id long, n_shingles long, node long, check long, regs binary"),
        "sketches", keep=True)
    classes = tx.stored(
        sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                             F.first("regs").alias("regs")), "classes")
    bands = tx.mapped(classes.select("node", "regs"), _bands, "key long, node long")
    shared = tx.stored(bands.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"),
                       "buckets")
    buckets = tx.stored(bands.join(shared, "key"), "members")

    facts = classes.select("node", "n", "regs")
    dealt = _by_cell(_cells(buckets, "key", _bucket_blocks()).select("cell", "node")
                     .join(facts, "node")).select("cell", "node", "n", "regs")
    hubs = tx.stored(
        tx.mapped(dealt, _propose(percent), "a long, b long, j double")
        .groupBy("a").agg(F.max(F.struct("j", "b")).alias("best"))
        .select("a", F.col("best.b").alias("b")), "hubs")
    clusters = tx.stored(_clusters(hubs), "clusters")
    near = tx.stored(clusters.join(facts, "node"), "near")     # classes with a possible partner
    sets = _full(docs, classes, clusters.select("node"))
    edges = tx.stored(_inside(near, sets, percent), "links")

    groups = tx.stored(_open_groups(buckets, near, percent), "groups")
    edges = edges.union(_inside(groups, sets, percent))
    labels = _labels(classes, edges)

    labelled = classes.select("node", "rep").join(labels, "node")
    smallest = labelled.groupBy("comp").agg(F.min("rep").alias("component_id"))
    verdicts = tx.stored(labelled.join(smallest, "comp").select("node", "component_id"),
                         "verdicts", keep=True)
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    return (sketches.select("doc_id", "n_shingles", "node")
            .join(verdicts, "node", "left")
            .select("doc_id", "node", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(),
                           F.coalesce(alone, "component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                           F.lit(True))))


def _clusters(hubs: DataFrame) -> DataFrame:
    """(node, cluster) of every class with a possible partner."""
    roots = components(hubs)
    return hubs.select(F.col("a").alias("node")).join(roots, "node", "left") \
        .select("node", F.coalesce("root", "node").alias("cluster"))


def _inside(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect what is connected inside each cluster, from exact intersections."""
    clusters = near.select("node", "cluster", "n")
    weight = clusters.groupBy("cluster").agg(
        F.count("*").alias("members"), F.sum("n").alias("shingles")).filter("members > 1")
    rows = clusters.join(tx.stored(weight, "cluster-sizes"), "cluster")
    blocks = F.ceil(F.greatest(F.col("members") / CELL,
                               F.col("shingles") / CELL_SHINGLES)).cast("long")
    dealt = _by_cell(_cells(rows, "cluster", blocks).select("cell", "node").join(sets, "node"))
    return tx.mapped(dealt.select("cell", "node", "set"), _exact_cell(percent), "a long, b long") \
        .distinct()


def _labels(classes: DataFrame, edges: DataFrame) -> DataFrame:
    return classes.select("node").join(components(edges), "node", "left") \
        .select("node", F.coalesce("root", "node").alias("comp"))


def _open_groups(buckets: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """(node, cluster, n): groups of classes that share a bucket, lie in different clusters and could
    be linked. A group that several buckets name is there once.
    """
    member = buckets.join(near.select("node", "cluster"), "node")
    mixed = member.groupBy("key").agg(
        F.min("cluster").alias("low"), F.max("cluster").alias("high")) \
        .filter("low <> high").select("key")
    member = member.join(tx.stored(mixed, "mixed"), "key", "left_semi")
    rows = _cells(member, "key", _bucket_blocks()).select("cell", "pair", "home", "node", "cluster") \
        .join(near.select("node", "n", "regs"), "node")
    dealt = _by_cell(rows.select("cell", "pair", "home", "node", "cluster", "n", "regs"))
    found = tx.mapped(dealt, _reachable(percent), "group long, node long").distinct()
    return found.join(near.select("node", "n"), "node").select("node", F.col("group").alias("cluster"), "n")


def _nodes(name: str):
    """Fill a column with the hash of each row's shingle set."""
    def run(batches):
        for batch in batches:
            found = []
            for _, _, data, offsets in tx.text_chunks(batch):
                found += [np.add.reduce(tx.mix(x)) for x in shingle_sets(data, offsets)]
            column = pa.array(np.array(found, np.uint64).view(np.int64))
            place = batch.schema.get_field_index(name)
            yield pa.RecordBatch.from_arrays(
                [column if i == place else c for i, c in enumerate(batch.columns)],
                names=batch.schema.names)
    return run


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One document of each group: the rows of ``docs`` whose verdict is ``kept``.

    Where one doc_id stands at several texts, of which some are kept and some are not, the verdict
    goes by text too: such rows are told apart by their shingle set, which is made again for them only.
    """
    with tx.temporary(docs.sparkSession):
        verdicts = tx.stored(_verdicts(docs, percent).groupBy("doc_id", "node").agg(
            F.bool_or("kept").alias("kept")), "kept", keep=True)
    by_id = tx.stored(verdicts.groupBy("doc_id").agg(
        F.bool_or("kept").alias("some"), F.bool_and("kept").alias("whole"))
        .filter("NOT whole AND doc_id IS NOT NULL"), "dropped")
    left = docs.join(by_id.filter("NOT some").select("doc_id"), "doc_id", "left_anti") \
        .select(*docs.columns)
    mixed = by_id.filter("some").select("doc_id")
    if mixed.isEmpty():
        return left
    name = "node"
    while name in docs.columns:
        name += "_"
    named = left.join(mixed, "doc_id", "left_semi").select(*docs.columns) \
        .withColumn(name, F.lit(None).cast("long"))
    gone = verdicts.filter("NOT kept").select("doc_id", F.col("node").alias(name))
    told = named.mapInArrow(_nodes(name), named.schema).join(gone, ["doc_id", name], "left_anti")
    return left.join(mixed, "doc_id", "left_anti").select(*docs.columns) \
        .unionByName(told.select(*docs.columns))
