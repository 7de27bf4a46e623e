"""Near duplicates among embeddings by hierarchical navigable small-world graphs.

Vectors are compared only within a label (and a length). Equal vectors are one node. The nodes of a label are dealt by hash to
shards of about ``SHARD``; a task builds the graph of a shard. Every node is then searched in every shard of its label, block by
block. A beam that holds nothing but links is widened until it holds something else, so the number of links has no
cap. In each block a part of the queries is also compared with the whole shard: while the searches find less than ``RECALL`` of
these links, all beams of the block are widened, at last to the whole shard. Pairs found are verified by cosine in double
precision. From a task leave the number of links of each node and one link to the first node of its local component, which are
united over all tasks.

Graphs are built and searched for many vectors at once: each step moves all beams of a batch.

Edge cases: vectors without id or label, null, empty or zero vectors and those with null or non-finite components link with nothing
and are kept; vectors of unlike lengths are never linked; equal vectors are linked with each other; repeated rows are vectors of their own; an
empty table gives no rows; ties of the cosine are links alike; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.components import connected
from starmill.llm.texts import keep
from starmill.operators.spread import spread_join

LINK = 0.93
SHARD = 8192
DEGREE, BEAM, BATCH, EXPAND = 12, 64, 256, 4
RECALL, AUDIT = 0.995, 16  # every 16th query is audited
SLACK = 1e-5  # searches are in single precision


@dataclass
class Graph:
    """Unit vectors, and for each level the neighbours of each node (-1: none)."""

    unit: np.ndarray
    links: list[np.ndarray]
    entry: int


def beam_search(graph: Graph, level: int, queries: np.ndarray, start: np.ndarray, width: int):
    """The ``width`` nodes nearest to each query that are met from ``start`` (-1: none), the nearest first: ids, cosines."""
    n, links, unit = len(graph.unit), graph.links[level], graph.unit
    size = len(queries)
    width = min(width, n)
    seen = np.zeros((size, n + 1), bool)
    stamp = np.zeros((size, n + 1), np.int32)
    ids = np.full((size, width), n, np.int64)
    near = np.full((size, width), -2.0, np.float32)
    done = np.ones((size, width), bool)

    def meet(rows: np.ndarray, found: np.ndarray) -> None:
        found = np.where(found < 0, n, found)
        column = np.arange(found.shape[1], dtype=np.int32)[None, :]
        stamp[rows[:, None], found] = column  # of a node met twice in a step one place counts
        new = (found < n) & ~seen[rows[:, None], found] & (stamp[rows[:, None], found] == column)
        seen[rows[:, None], found] = True
        value = np.einsum("ad,akd->ak", queries[rows], unit[np.minimum(found, n - 1)], optimize=True)
        all_near = np.concatenate((near[rows], np.where(new, value, -2.0).astype(np.float32)), axis=1)
        all_ids = np.concatenate((ids[rows], np.where(new, found, n)), axis=1)
        all_done = np.concatenate((done[rows], ~new), axis=1)
        best = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        near[rows] = np.take_along_axis(all_near, best, 1)
        ids[rows] = np.take_along_axis(all_ids, best, 1)
        done[rows] = np.take_along_axis(all_done, best, 1)

    rows = np.arange(size)
    meet(rows, start)
    expand = min(EXPAND, width)
    while len(rows):
        open_near = np.where(done[rows], -3.0, near[rows])
        places = np.argpartition(-open_near, expand - 1, axis=1)[:, :expand]
        usable = np.take_along_axis(open_near, places, 1) > -2.5
        live = usable.any(axis=1)
        rows, places, usable = rows[live], places[live], usable[live]
        if not len(rows):
            break
        nodes = np.take_along_axis(ids[rows], places, 1)
        done[rows[:, None], places] = True
        found = links[np.where(usable, nodes, 0)]
        meet(rows, np.where(usable[:, :, None], found, -1).reshape(len(rows), -1))
    order = np.argsort(-near, axis=1, kind="stable")
    near = np.take_along_axis(near, order, 1)
    ids = np.take_along_axis(ids, order, 1)
    return np.where(near > -1.5, ids, -1), near


def spread_out(unit: np.ndarray, ids: np.ndarray, near: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's candidates (-1: none) up to ``degree``: first those nearer to the node than to any chosen before."""
    order = np.argsort(-np.where(ids < 0, -9.0, near), axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    valid = ids >= 0
    vectors = unit[np.maximum(ids, 0)]
    between = np.matmul(vectors, vectors.transpose(0, 2, 1))
    chosen = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        covered = ((between[:, c, :] > near[:, c, None]) & chosen).any(axis=1)
        chosen[:, c] = valid[:, c] & ~covered & (chosen.sum(axis=1) < degree)
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])[None, :]
    first = np.argsort(rank, axis=1)[:, :degree]
    out = np.full((len(ids), degree), -1, np.int64)
    out[:, :first.shape[1]] = np.take_along_axis(np.where(valid, ids, -1), first, 1)
    return out


def connect(graph: Graph, level: int, nodes: np.ndarray, ids: np.ndarray, near: np.ndarray) -> None:
    """Link ``nodes`` with the best of their candidates, both ways."""
    links = graph.links[level]
    degree = links.shape[1]
    links[nodes] = own = spread_out(graph.unit, ids, near, degree)
    back = np.repeat(nodes, own.shape[1])
    to = own.reshape(-1)
    back, to = back[to >= 0], to[to >= 0]
    if not len(to):
        return
    value = np.einsum("ed,ed->e", graph.unit[back], graph.unit[to])
    order = np.lexsort((-value, to))
    back, to = back[order], to[order]
    targets, first, count = np.unique(to, return_index=True, return_counts=True)
    extra = int(count.max())
    more = np.full((len(targets), extra), -1, np.int64)
    more[np.repeat(np.arange(len(targets)), count), np.arange(len(to)) - np.repeat(first, count)] = back
    for start in range(0, len(targets), BATCH):
        part = slice(start, start + BATCH)
        known = links[targets[part]]
        fresh = more[part][:, :4 * degree]
        fresh = np.where((fresh[:, :, None] == known[:, None, :]).any(axis=2), -1, fresh)
        every = np.concatenate((known, fresh), axis=1)
        close = np.einsum("ad,akd->ak", graph.unit[targets[part]], graph.unit[np.maximum(every, 0)], optimize=True)
        links[targets[part]] = spread_out(graph.unit, every, close, degree)


def build(vectors: np.ndarray, seed: int = 7) -> Graph:
    """The graph of the rows of ``vectors``, none of them zero."""
    values = vectors.astype(np.float64)
    unit = (values / np.linalg.norm(values, axis=1, keepdims=True)).astype(np.float32)
    n = len(unit)
    draw = np.random.Generator(np.random.PCG64(seed))
    top = np.minimum((-np.log(1 - draw.random(n)) / np.log(DEGREE)).astype(int), 6)
    order = np.argsort(-top, kind="stable")  # upper levels first: every later node finds them
    graph = Graph(unit, [np.full((n, 2 * DEGREE if level == 0 else DEGREE), -1, np.int64)
                         for level in range(int(top.max()) + 1)], int(order[0]))
    done = 0
    while done < n:
        nodes = order[done:done + max(1, min(BATCH, done))]
        start = np.full((len(nodes), 1), graph.entry)
        for level in range(len(graph.links) - 1, -1, -1):
            inside = top[nodes] >= level
            if not done:
                continue
            ids, near = beam_search(graph, level, unit[nodes], start, BEAM if inside.any() else 1)
            start = ids[:, :max(1, BEAM // 4)]
            if inside.any():
                mine = nodes[inside]
                peers = unit[mine] @ unit[mine].T
                np.fill_diagonal(peers, -2)
                width = min(len(mine), DEGREE)
                best = np.argpartition(-peers, width - 1, axis=1)[:, :width]
                peer_near = np.take_along_axis(peers, best, 1)
                peer_ids = np.where(peer_near > -1.5, mine[best], -1)
                connect(graph, level, mine, np.concatenate((ids[inside], peer_ids), axis=1),
                        np.concatenate((near[inside], peer_near), axis=1))
        done += len(nodes)
    return graph


def search(graph: Graph, queries: np.ndarray, width: int):
    """The ``width`` nearest nodes of each query: ids (-1: none) and cosines."""
    start = np.full((len(queries), 1), graph.entry)
    for level in range(len(graph.links) - 1, 0, -1):
        start, _ = beam_search(graph, level, queries, start, 8)
    return beam_search(graph, 0, queries, start, width)


def linked(graph: Graph, queries: np.ndarray, least: float, width: int):
    """(query, node) of cosine about ``least`` or more; beams full of links are widened.

    A beam whose nodes have as many neighbours as there are nodes is no longer a short cut: such queries are compared with all.
    """
    pairs = []
    for first in range(0, len(queries), BATCH):
        rows, wide = np.arange(first, min(first + BATCH, len(queries))), width
        while len(rows):
            if wide * 2 * DEGREE >= len(graph.unit) and wide > width:
                at, node = every_pair(graph, queries[rows], least)
                pairs.append((rows[at], node))
                break
            ids, near = search(graph, queries[rows], wide)
            good = (near >= least) & (ids >= 0)
            full = good.all(axis=1) & (ids.shape[1] < len(graph.unit))
            at, place = np.nonzero(good & ~full[:, None])
            pairs.append((rows[at], ids[at, place]))
            rows, wide = rows[full], 2 * wide
    return tuple(np.concatenate(x) for x in zip(*pairs))


def audited(graph: Graph, queries: np.ndarray, least: float, width: int = BEAM):
    """As ``linked``, with beams as wide as the audit asks; also the audit's recall."""
    n = len(graph.unit)
    checked = np.arange(0, len(queries), AUDIT)
    true = sum(int((queries[checked[i:i + BATCH]] @ graph.unit.T >= least).sum()) for i in range(0, len(checked), BATCH))
    while True:
        query, node = linked(graph, queries, least, width)
        found = int((query % AUDIT == 0).sum())
        if found >= RECALL * true:
            return query, node, found / max(1, true)
        if width >= n:
            return *every_pair(graph, queries, least), 1.0
        width *= 2


def every_pair(graph: Graph, queries: np.ndarray, least: float):
    """The same by comparing all, for shards in which no beam is wide enough."""
    parts = [np.nonzero(queries[i:i + BATCH] @ graph.unit.T >= least) for i in range(0, len(queries), BATCH)]
    return (np.concatenate([x + i * BATCH for i, (x, _) in enumerate(parts)]), np.concatenate([y for _, y in parts]))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.einsum("ed,ed->e", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def smallest_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` places the smallest one reachable by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(vectors: DataFrame, least: float = LINK, shard: int = SHARD, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for each row of ``vectors``."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<float>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    usable = rows.filter("vec_id is not null and label is not null and vector is not null").filter(
        finite & F.exists("vector", lambda x: x != 0))
    nodes = usable.groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = keep(nodes.withColumn("size", F.size("vector")), "hnsw-nodes")

    group = ["label", "size"]
    shards = nodes.groupBy(*group).agg(F.ceil(F.count("*") / F.lit(shard)).cast("int").alias("shards"))
    dealt = spread_join(nodes, shards, group, "left", ["node"]).withColumn(
        "shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    # small tables, long work: as many tasks as groups, which small partitions must not be merged into
    groups, searches = shards.agg(F.coalesce(F.sum("shards"), F.lit(0)), F.coalesce(F.sum(F.col("shards") ** 2), F.lit(0))).first()
    builders, finders = 2 * int(groups) + 1, 2 * int(searches) + 1
    label_type = nodes.schema["label"].dataType.simpleString()
    keys = [*group, "shard"]

    def make(rows):
        rows = rows.sort_values("node", ignore_index=True)
        values = np.stack(rows["vector"].to_numpy()).astype(np.float32)
        graph = build(values)
        blob = pack(node=rows["node"].to_numpy(), copies=rows["copies"].to_numpy(), values=values, entry=np.array(graph.entry),
                    **{f"links{k}": x.astype(np.int32) for k, x in enumerate(graph.links)})
        return pd.DataFrame({**{c: rows[c].head(1) for c in [*keys, "shards"]}, "graph": [blob]})

    graphs = keep(dealt.repartition(builders, *keys).groupBy(*keys).applyInPandas(
        make, f"label {label_type}, size int, shard int, shards int, graph binary"), "hnsw-graphs")

    def find(queries, graphs):
        if not len(queries) or not len(graphs):
            return pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
        with np.load(io.BytesIO(graphs["graph"].iloc[0])) as held:
            arrays = {k: held[k] for k in held.files}
        values = arrays["values"]
        norms = np.linalg.norm(values.astype(np.float64), axis=1, keepdims=True)
        graph = Graph((values / norms).astype(np.float32), [arrays[f"links{k}"].astype(np.int64) for k in range(
            sum(k.startswith("links") for k in arrays))], int(arrays["entry"]))
        own = np.stack(queries["vector"].to_numpy()).astype(np.float32)
        unit = (own / np.linalg.norm(own.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)
        query, node, _ = audited(graph, unit, least - SLACK)
        ids = queries["node"].to_numpy()
        other = ids[query] != arrays["node"][node]
        query, node = query[other], node[other]
        true = np.concatenate([cosine(own[query[i:i + 65536]], values[node[i:i + 65536]]) >= least
                               for i in range(0, len(query), 65536)] or [np.empty(0, bool)])
        query, node = query[true], node[true]
        links = np.bincount(query, weights=arrays["copies"][node], minlength=len(ids)).astype(np.int64)
        every, place = np.unique(np.concatenate((ids, arrays["node"])), return_inverse=True)
        root = smallest_roots(place[query], place[len(ids) + node], len(every))
        tied = np.flatnonzero(root != np.arange(len(every)))
        return pd.DataFrame({"node": np.concatenate((ids, every[tied])), "root": np.concatenate((ids, every[root[tied]])),
                             "links": np.concatenate((links, np.zeros(len(tied), np.int64)))})[["node", "links", "root"]]

    every_shard = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("shards")).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    every_block = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    places = [*keys, "block"]
    queries = every_shard.select(*places, "node", "vector").repartition(finders, *places)
    indexes = every_block.select(*places, "graph").repartition(finders, *places)
    found = queries.groupBy(*places).cogroup(indexes.groupBy(*places)).applyInPandas(find, "node long, links long, root long")
    found = keep(found, "hnsw-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected(found.filter("node <> root"), "node", "root")
    known = nodes.join(links, "node").join(parts, "node", "left").select(
        "label", "vector", "copies", "links", F.coalesce("component", "node").alias("component"))
    out = spread_join(usable, known, ["label", "vector"], "left", ["vec_id"])
    out = out.select("vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component")
    alone = rows.filter(F.coalesce(~(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
                                     & finite & F.exists("vector", lambda x: x != 0)), F.lit(True)))
    out = out.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component")))
    return out.select("vec_id", "n_links", F.col("component").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"))
