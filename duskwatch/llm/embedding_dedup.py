"""Near duplicates among embeddings of one label, by NN-descent.

Equal vectors are one node. A neighbour graph starts from runs of vectors that random hyperplanes
put next to each other, and is refined round by round: the neighbours of a node, and those that
have it as neighbour, are compared with each other, until a round brings no new link. The number of
runs grows with the table, so that a pair at the threshold meets in one however rare links are.
A node whose whole list lies above the threshold is saturated. Such nodes also keep a list of nodes
of other components, refined alike, until no more components join; within a component their links
are counted block by block. An audit holds all links of some nodes, found among all vectors,
against the result; a poor one adds runs of other hyperplanes, and the last poor one raises.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.scratch import discard, stage
from duskwatch.llm.shipping import map_batches, whole_groups
from duskwatch.operators.components import connected_components

NEIGHBOURS = 10
TREES, BITS, RUN = 4, 16, 64
#: Sets of hyperplanes whose runs are shuffled at once.
AT_ONCE = 2
#: Share of pairs at the threshold that may fail to meet in a run.
MISSED = 0.01
#: Nodes of a cell of the audit, and cells that are looked up among all vectors at once.
AUDITED, CELLS = 256, 16
#: Links the audit must have seen, if the table has as many.
AUDIT_LINKS = 200
AUDITS = 6
RECALL = 0.98
#: Members of a component that are compared side by side.
BLOCK = 512
ROUNDS = 30
#: Below the threshold by this much, single-precision products are checked again in double.
MARGIN = 1e-4


def _vectors(rows: DataFrame) -> DataFrame:
    """``(vec_id, label, name, vec)``: vectors that can link, with a name for equal ones of a label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if label is None or not v.is_valid or v.values.null_count or not len(v.values):
                    continue
                x = np.asarray(v.values, np.float64)
                largest = np.abs(x).max()
                if not np.isfinite(largest) or largest == 0:
                    continue
                y = x / largest  # so that no square overflows or vanishes
                data = (y / np.linalg.norm(y)).tobytes()
                out.append((i, label, hashlib.blake2b(f"{label}/".encode() + x.tobytes(), digest_size=16).digest(), data))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()),
                 pa.array([r[2] for r in out], pa.binary()), pa.array([r[3] for r in out], pa.binary())],
                ["vec_id", "label", "name", "vec"])

    return map_batches(rows, run, "vec_id long, label string, name binary, vec binary")


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1).astype(kind)


def seed_work(size: int, threshold: float) -> tuple[int, int]:
    """Sets of hyperplanes, and planes of a set, by which nodes of so many vectors meet.

    A run holds nodes with about ``log2(size / RUN)`` equal signs. A plane parts two vectors with
    probability angle / pi, so a pair at the threshold misses all runs with probability ``MISSED``.
    """
    equal = max(0.0, math.log2(max(size, 1) / RUN)) + 1
    meet = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** equal
    trees = math.ceil(math.log(MISSED) / math.log1p(-min(meet, 1 - MISSED)))
    return max(TREES, trees), min(62, max(BITS, math.ceil(equal)))


def _seeds(nodes: DataFrame, seed: int, size: int, threshold: float, apart: bool = False) -> DataFrame:
    """Staged fresh lists ``(v, u, sim, fresh, rank)`` from runs of nodes in the order of random hyperplanes.

    With ``apart`` only nodes of different ``group`` are neighbours, and a run holds one node per
    code and group; every other set of planes uses fewer of them.
    """
    trees, bits = seed_work(size, threshold)
    found = None
    for first in range(0, trees, AT_ONCE):
        runs = _runs(nodes, seed, range(first, min(trees, first + AT_ONCE)), bits, apart).withColumn("fresh", F.lit(True))
        old = found
        found = stage(_nearest(old.drop("rank").unionByName(runs) if old else runs), "seeds")
        if old:
            discard(old)
    return found


def _runs(nodes: DataFrame, seed: int, trees: range, bits: int, apart: bool) -> DataFrame:
    """Edges ``(v, u, sim)`` from runs of nodes in the order of some sets of random hyperplanes."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree in trees if batch.num_rows else ():
                codes = np.zeros(batch.num_rows, np.int64)
                sizes = np.array([len(x.as_buffer()) // 8 for x in batch.column(2)])
                short = np.empty(batch.num_rows, object)
                for dim in np.unique(sizes):
                    at = np.flatnonzero(sizes == dim)
                    planes = np.random.default_rng([seed, tree, dim]).standard_normal((dim, bits))
                    x = _matrix(batch.column(2).take(pa.array(at)))
                    codes[at] = (x @ planes > 0) @ (1 << np.arange(bits))
                    short[at] = [row.tobytes() for row in x.astype(np.float32)]
                if apart:
                    codes >>= bits * (tree % 4) // 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, tree), pa.int32()), batch.column(1), pa.array(sizes), pa.array(codes),
                     batch.column(0), pa.array(short, pa.binary()), batch.column(3)],
                    ["tree", "label", "dim", "code", "id", "vec", "group"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dim, tree = (batch.column(i).to_pylist() for i in (1, 2, 0))
            ids, group = np.asarray(batch.column(4)), np.asarray(batch.column(6))
            start, out = 0, []
            while start < len(ids):
                end = start + 1
                while end < len(ids) and end - start < RUN and (tree[end], label[end], dim[end]) == (tree[start], label[start], dim[start]):
                    end += 1
                x = np.frombuffer(b"".join(batch.column(5).slice(start, end - start).to_pylist()), np.float32).reshape(end - start, -1)
                sims = x @ x.T
                own = group[start:end]
                sims[own[:, None] == own] = -2
                k = min(NEIGHBOURS, end - start - 1)
                if k:
                    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                    near = np.take_along_axis(sims, best, 1).ravel()
                    real = near > -2
                    out.append((np.repeat(ids[start:end], k)[real], ids[start + best].ravel()[real], near[real]))
                start = end
            if out:
                yield _edges(*(np.concatenate(c) for c in zip(*out, strict=True)))

    schema = "tree int, label string, dim long, code long, id long, vec binary, group long"
    placed = map_batches(nodes.select("id", "label", "vec", "group"), place, schema)
    if apart:
        placed = placed.groupBy("tree", "label", "dim", "code", "group").agg(F.min(F.struct("id", "vec")).alias("m")).select(
            "tree", "label", "dim", "code", "m.id", "m.vec", "group")
    # The range takes the id in, so a label or a cluster of one code spreads over partitions.
    order = ["tree", "label", "dim", "code", "id"]
    return map_batches(placed.repartitionByRange(*order).sortWithinPartitions(*order), compare, "v long, u long, sim float")


def _edges(v: np.ndarray, u: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v), pa.array(u), pa.array(sim.astype(np.float32))], ["v", "u", "sim"])


def _nearest(edges: DataFrame) -> DataFrame:
    """The ``NEIGHBOURS`` most similar of each node; an edge of an earlier round is not ``fresh``."""
    distinct = edges.groupBy("v", "u").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("v").orderBy(F.col("sim").desc(), "u"))
    return distinct.withColumn("rank", rank).where(F.col("rank") <= NEIGHBOURS)


def _refine(graph: DataFrame, nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """Edges ``(v, u, sim)`` between groups, better than those of ``lists``, among the neighbours, forward and backward, of every node."""
    backward = graph.select(F.col("u").alias("at"), F.col("v").alias("member"), "fresh", "sim")
    near = F.row_number().over(Window.partitionBy("at").orderBy(F.col("sim").desc(), "member"))
    backward = backward.withColumn("r", near).where(F.col("r") <= NEIGHBOURS).select("at", "member", "fresh")
    members = graph.select(F.col("v").alias("at"), F.col("u").alias("member"), "fresh").union(backward).groupBy(
        "at", "member").agg(F.max("fresh").alias("fresh"))
    least = lists.groupBy("v").agg(F.min("sim").alias("least"), F.count("*").alias("k"))
    least = least.select(F.col("v").alias("member"), F.when(F.col("k") < NEIGHBOURS, F.lit(-2.0)).otherwise(F.col("least")).cast("float").alias("least"))
    vectors = nodes.select(F.col("id").alias("member"), "vec", "group").join(least, "member", "left")
    rows = members.join(vectors, "member").select("at", "member", "fresh", F.coalesce("least", F.lit(-2.0).cast("float")).alias("least"), "vec", "group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, 1):
            at, member = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            fresh, least, group = batch.column(2).to_numpy(zero_copy_only=False), np.asarray(batch.column(3)), np.asarray(batch.column(5))
            head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            size = np.diff(np.append(head, len(at)))
            out = []
            for n in np.unique(size[size > 1]):
                starts = head[size == n]
                for i in range(0, len(starts), 2048):
                    rows = starts[i:i + 2048, None] + np.arange(n)
                    x = _matrix(batch.column(4).take(pa.array(rows.ravel())), np.float32)
                    x = x.reshape(len(rows), n, -1)
                    sims = x @ x.transpose(0, 2, 1)
                    new = fresh[rows]
                    new = new[:, :, None] | new[:, None, :]
                    good = new & (sims > least[rows][:, :, None]) & (group[rows][:, :, None] != group[rows][:, None, :])
                    g, a, b = np.nonzero(good)
                    out.append((member[rows[g, a]], member[rows[g, b]], sims[g, a, b]))
            if out:
                v, u, sim = (np.concatenate(c) for c in zip(*out, strict=True))
                _, once = np.unique(np.stack([v, u]), axis=1, return_index=True) if len(v) < 1 << 16 else (None, slice(None))
                yield _edges(v[once], u[once], sim[once])

    return map_batches(rows.repartition("at").sortWithinPartitions("at"), run, "v long, u long, sim float")


def _exact(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(u, v)``, the lesser node first, whose cosine in double precision reaches the threshold."""
    vec = nodes.select("id", "vec")
    both = pairs.join(vec.toDF("u", "x"), "u").join(vec.toDF("v", "y"), "v").select("u", "v", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sims = [float(np.frombuffer(x.as_buffer()) @ np.frombuffer(y.as_buffer())) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            good = pa.array(np.array(sims) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], ["u", "v"])

    return map_batches(both, run, "u long, v long")


def _audit(nodes: DataFrame, size: int, placed: DataFrame, whole: DataFrame, links: DataFrame, threshold: float) -> float:
    """Share of all links of audited nodes that the result holds.

    A node in one of the components ``whole`` holds its links there, any other those in ``links``.
    Nodes are audited until they have ``AUDIT_LINKS`` links, or else all of them.
    """
    both = links.select("u", "v").union(links.select("v", "u")).toDF("id", "other")
    degree = both.groupBy("id").agg(F.count("*").alias("degree"))
    inside = placed.join(whole, "component", "left_semi").select(F.col("node").alias("id"), "component")
    cells = max(1, math.ceil(size / AUDITED))
    table = stage(nodes.join(inside, "id", "left").select(
        "id", "label", "vec", "component", F.pmod(F.xxhash64("id"), F.lit(cells)).alias("cell")), "audit")
    wanted = have = start = 0
    step = 1
    while start < cells and wanted < AUDIT_LINKS:
        sample = table.where((F.col("cell") >= start) & (F.col("cell") < start + step))
        true = _true_links(table, sample.drop("cell").collect(), threshold)
        for r in true.join(degree, "id", "left").select("n", F.when(
                F.col("inside"), F.col("m")).otherwise(F.least("n", F.coalesce("degree", F.lit(0)))).alias("have")).collect():
            wanted, have = wanted + r["n"], have + r["have"]
        start, step = start + step, min(2 * step, CELLS)
    discard(table)
    # Without a link all nodes were looked up.
    return have / wanted if wanted else 1.0


def _true_links(table: DataFrame, sample: list, threshold: float) -> DataFrame:
    """``(id, inside, n, m)``: links of the sample among all vectors, and how many of them in the node's component."""
    groups: dict[tuple[str, int], list] = {}
    for r in sample:
        groups.setdefault((r["label"], len(r["vec"]) // 8), []).append(r)
    queries = {k: (np.array([r["id"] for r in own]), np.stack([np.frombuffer(bytes(r["vec"])) for r in own]),
                   np.array([r["component"] is not None for r in own]), np.array([r["component"] or 0 for r in own]))
               for k, own in groups.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = {k: np.zeros(len(q[0]), np.int64) for k, q in queries.items()}
        m = {k: np.zeros(len(q[0]), np.int64) for k, q in queries.items()}
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                keys = [(label, len(x.as_buffer()) // 8) for label, x in zip(batch.column(1).to_pylist(), batch.column(2), strict=True)]
                for key in set(keys) & set(queries):
                    rows = pa.array([i for i, k in enumerate(keys) if k == key])
                    ids, x, inside, component = queries[key]
                    own = batch.column(3).take(rows)
                    near = x @ _matrix(batch.column(2).take(rows)).T >= threshold
                    near &= ids[:, None] != np.asarray(batch.column(0).take(rows))
                    n[key] += near.sum(1)
                    same = inside[:, None] & np.asarray(own.is_valid()) & (component[:, None] == np.asarray(own.fill_null(0)))
                    m[key] += (near & same).sum(1)
        for key, (ids, _, inside, _) in queries.items():
            at = np.flatnonzero(n[key])
            yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (ids, inside, n[key], m[key])], ["id", "inside", "n", "m"])

    counts = map_batches(table.select("id", "label", "vec", "component"), run, "id long, inside boolean, n long, m long")
    return counts.groupBy("id", "inside").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def neighbour_graph(nodes: DataFrame, size: int, threshold: float, seed: int = 0, graph: DataFrame | None = None) -> DataFrame:
    """Edges ``(v, u, sim)`` of the refined graph over ``nodes(id, label, vec, group)``, from an earlier graph if given."""
    seeds = _seeds(nodes, seed, size, threshold)
    return _refined(_merged(graph, seeds) if graph else seeds, nodes, threshold)


def _merged(old: DataFrame, found: DataFrame) -> DataFrame:
    return stage(_nearest(old.select("v", "u", "sim", F.lit(False).alias("fresh")).union(
        found.select("v", "u", "sim", F.lit(True)))), "graph")


def _refined(lists: DataFrame, nodes: DataFrame, threshold: float, around: DataFrame | None = None) -> DataFrame:
    """Lists refined until a round brings no new link; ``around`` has edges that only lead to neighbours."""
    links = -1
    for _ in range(ROUNDS):
        counts = lists.agg(
            F.count(F.when(F.col("sim") >= threshold, True)).alias("links"), F.count(F.when(F.col("fresh"), True)).alias("fresh")).first()
        if counts["links"] == links or not counts["fresh"]:
            break
        links = counts["links"]
        graph = lists.select("v", "u", "sim", "fresh")
        if around:
            graph = graph.union(around.select("v", "u", "sim", F.lit(False)))
        old = lists
        lists = _merged(old, _refine(graph, nodes, old))
        discard(old)
    return lists


def _linked(edges: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    close = edges.where(F.col("sim") >= threshold - MARGIN).select(F.least("v", "u").alias("u"), F.greatest("v", "u").alias("v"))
    return _exact(close.distinct(), nodes, threshold)


def _saturated(graph: DataFrame, threshold: float) -> DataFrame:
    """``(id)`` of the nodes whose whole list lies above the threshold."""
    return graph.where(F.col("sim") >= threshold - MARGIN).groupBy(F.col("v").alias("id")).agg(
        F.count("*").alias("k")).where(F.col("k") >= NEIGHBOURS).select("id")


def _bridged(
    graph: DataFrame, nodes: DataFrame, size: int, links: DataFrame, threshold: float, seed: int,
) -> tuple[DataFrame, DataFrame]:
    """Links and components, with links between saturated nodes until no more components join.

    The list of a saturated node may miss links to other components. A node of another list shows its own.
    """
    full = stage(_saturated(graph, threshold), "full")
    placed = stage(connected_components(links), "placed")
    while True:
        own = nodes.join(full, "id").join(placed, F.col("id") == F.col("node"), "left").select(
            "id", "label", "vec", F.coalesce("component", "id").alias("group"))
        own = stage(own, "saturated")
        several = own.groupBy("label").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("label")
        open_ = stage(own.join(several, "label", "left_semi"), "saturated")
        discard(own)
        if open_.isEmpty():
            discard(open_)
            break
        ids = open_.select("id")
        around = graph.join(ids.toDF("v"), "v", "left_semi").join(ids.toDF("u"), "u", "left_semi").select("v", "u", "sim")
        around = stage(around, "around")
        foreign = _refined(_seeds(open_, seed, size, threshold, apart=True), open_, threshold, around)
        new = stage(_linked(foreign, open_, threshold), "bridges")
        discard(around, foreign, open_)
        if new.isEmpty():
            discard(new)
            break
        links = stage(links.union(new).distinct(), "links")
        placed = stage(connected_components(links), "placed")
    return links, placed


def _links_in_components(members: DataFrame, threshold: float) -> DataFrame:
    """``(id, n)``: direct links of ``members(id, copies, component, vec)`` within components, by blocks.

    A component is cut into blocks of about ``BLOCK`` members, and every pair of blocks is a group.
    """
    blocks = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    left = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("component", "block", "other").alias("g"), "component", "block", "other", F.lit(0).alias("side"), "id", "copies", "vec")
    right = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("component", "other", "block").alias("g"), "component", F.col("other").alias("block"), F.col("block").alias("other"),
        F.lit(1).alias("side"), "id", "copies", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, 1):
            keys = list(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3)), strict=True))
            side, ids, copies = (np.asarray(batch.column(i)) for i in (4, 5, 6))
            start = 0
            while start < len(keys):
                end = start + 1
                while end < len(keys) and keys[end] == keys[start]:
                    end += 1
                x = _matrix(batch.column(7).slice(start, end - start))
                a, b = side[start:end] == 0, side[start:end] == 1
                near = x[a] @ x[b].T >= threshold
                near &= ids[start:end][a][:, None] != ids[start:end][b]
                yield pa.RecordBatch.from_arrays([pa.array(ids[start:end][a]), pa.array(near @ copies[start:end][b])], ["id", "n"])
                start = end

    order = ["g", "component", "block", "other"]
    rows = left.union(right).repartition("g").sortWithinPartitions(*order)
    return map_batches(rows, run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _found(nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Components ``(node, component)`` and numbers of links ``(id, n)`` that an audit has passed."""
    size = nodes.count()
    graph = earlier = None
    for turn in range(AUDITS):
        graph = neighbour_graph(nodes, size, threshold, turn, graph)
        links = _linked(graph, nodes, threshold)
        links = stage(links.union(earlier).distinct() if earlier else links, "links")
        links, placed = _bridged(graph, nodes, size, links, threshold, turn)
        earlier = links
        whole = placed.join(_saturated(graph, threshold), F.col("node") == F.col("id"), "left_semi").select("component").distinct()
        whole = stage(whole, "whole")
        share = _audit(nodes, size, placed, whole, links, threshold)
        if share >= RECALL:
            break
    else:
        raise RuntimeError(f"only {share:.4f} of the audited links were found, {RECALL} are wanted")
    members = nodes.join(placed, F.col("id") == F.col("node")).join(whole, "component", "left_semi").select("id", "copies", "component", "vec")
    both = links.select("u", "v").union(links.select("v", "u")).toDF("id", "other")
    few = both.join(nodes.select(F.col("id").alias("other"), "copies"), "other").groupBy("id").agg(F.sum("copies").alias("n"))
    counted = stage(_links_in_components(members, threshold), "counted")
    return placed, few.join(counted, "id", "full").select("id", F.coalesce(counted["n"], few["n"]).alias("n"))


def near_duplicates(
    rows: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``rows``.

    Vectors link when their labels are equal and not null and their cosine in double precision is
    at least ``threshold``. Links not known to be found at ``RECALL`` or more raise. A null, empty or zero vector, one with null or non-finite components,
    one with a null label or null id links with nothing; vectors of different lengths never link.
    Equal vectors always link. ``component_id`` is the least id reachable over found links; ties
    cannot occur. Repeated rows link as any equal vectors. Other columns are ignored.
    """
    rows = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("embedding"))
    vectors = stage(_vectors(rows.where("vec_id is not null")), "vectors")
    names = stage(vectors.groupBy("name").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "names")
    nodes = stage(vectors.join(names, "name").where("vec_id = id").dropDuplicates(["id", "name"]).select(
        "id", "label", "vec", "copies", F.col("id").alias("group")), "nodes")
    placed, n_links = _found(nodes, threshold)
    of_node = names.join(n_links, "id", "left").join(placed, F.col("id") == F.col("node"), "left").select(
        "name", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("least"))
    of_row = vectors.select("vec_id", "name").join(of_node, "name").groupBy("vec_id").agg(
        F.max("links").alias("links"), F.min("least").alias("least"))
    return rows.select("vec_id").join(of_row, "vec_id", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
