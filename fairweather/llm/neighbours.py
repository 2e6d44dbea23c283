"""Near-duplicate embeddings by hierarchical navigable small-world graphs.

Vectors of a label are dealt over shards, and every shard is indexed by a graph
of its own. Every vector is searched in every shard of its label. Beams widen
until queries that are known to have near neighbours find what comparing with
the whole shard finds; what is found is verified by the cosine in double precision. Links are
reduced to a spanning forest where they are found, and forests are united.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweather.llm.components import connected_components
from fairweather.session import Scratch

# About so many vectors are indexed, and so many searched, in one task.
SHARD, QUERIES = 8192, 65_536
# Neighbours kept per node, beam while building, first beam of a search, queries audited.
DEGREE, BUILD_BEAM, BEAM, AUDITED = 12, 32, 24, 64
# Share of the audited links that beams have to find.
RECALL = 0.99
# Single precision may be off by so much; what lies closer is verified in double.
SLACK = 1e-5


class Graph:
    """A hierarchical navigable small-world graph over unit vectors, built and searched in batches."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        draw = np.random.default_rng(n)
        levels = np.floor(-np.log(1 - draw.random(n)) / np.log(DEGREE)).astype(int)
        order = draw.permutation(n)
        if n:
            levels[order[0]] = levels.max()  # the first node is in every layer: searches start there
        self.start = order[0] if n else 0
        self.layers = [np.full((n, DEGREE * (1 if level else 2)), -1, np.int32) for level in range(levels.max(initial=0) + 1)]
        done = 1
        while done < n:
            batch = order[done : done + min(1024, max(16, done))]
            self._insert(batch, levels)
            done += len(batch)

    def _similar(self, ids: np.ndarray, others: np.ndarray) -> np.ndarray:
        return np.einsum("td,tkd->tk", self.vectors[ids], self.vectors[others])

    def _insert(self, batch: np.ndarray, levels: np.ndarray) -> None:
        queries = self.vectors[batch]
        entries = np.full((len(batch), 1), self.start)
        mates = queries @ queries.T
        np.fill_diagonal(mates, -np.inf)
        for level in range(len(self.layers) - 1, -1, -1):
            found, sims = self._beam(level, queries, entries, BUILD_BEAM)
            entries = np.where(np.isfinite(sims[:, :4]), found[:, :4], self.start)
            here = levels[batch] >= level
            if not here.any():
                continue
            # nodes of one batch do not see each other in the graph yet
            near = np.where(here[None, :], mates, -np.inf)[here]
            best = np.argpartition(-near, min(DEGREE, near.shape[1] - 1), axis=1)[:, :DEGREE]
            own = np.where(np.isfinite(np.take_along_axis(near, best, 1)), batch[best], -1)
            candidates = np.concatenate([np.where(np.isfinite(sims[here]), found[here], -1), own], axis=1)
            nodes = batch[here]
            chosen = self._choose(nodes, candidates, DEGREE)
            self.layers[level][nodes, :DEGREE] = chosen
            self._link_back(level, nodes, chosen)

    def _choose(self, nodes: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
        """Diverse neighbours: nearer to the node than to one chosen before; then the nearest rest."""
        chosen = np.full((len(nodes), most), -1, np.int32)
        for s in range(0, len(nodes), 256):
            ids, given = nodes[s : s + 256], candidates[s : s + 256]
            sims = np.where(given >= 0, self._similar(ids, given), -np.inf)
            sims[given == ids[:, None]] = -np.inf
            order = np.argsort(-sims, axis=1, kind="stable")
            given, sims = np.take_along_axis(given, order, 1), np.take_along_axis(sims, order, 1)
            repeated = np.zeros(given.shape, bool)
            for k in range(1, given.shape[1]):
                repeated[:, k] = (given[:, :k] == given[:, k : k + 1]).any(axis=1)
            valid = np.isfinite(sims) & ~repeated
            points = self.vectors[given]
            between = points @ points.transpose(0, 2, 1)
            taken = np.zeros(given.shape, bool)
            for k in range(given.shape[1]):
                closest = np.where(taken, between[:, k], -np.inf).max(axis=1)
                taken[:, k] = valid[:, k] & (sims[:, k] > closest) & (taken.sum(axis=1) < most)
            rank = np.where(taken, 0, np.where(valid, 1, 2))
            first = np.argsort(rank, axis=1, kind="stable")[:, :most]
            kept = np.where(np.take_along_axis(rank, first, 1) < 2, np.take_along_axis(given, first, 1), -1)
            chosen[s : s + 256, : kept.shape[1]] = kept
        return chosen

    def _link_back(self, level: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
        layer = self.layers[level]
        target, source = chosen.ravel(), np.repeat(nodes, chosen.shape[1])
        target, source = target[target >= 0], source[target >= 0]
        order = np.lexsort((-np.einsum("nd,nd->n", self.vectors[target], self.vectors[source]), target))
        target, source = target[order], source[order]
        distinct, first, counts = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, counts)
        fresh = np.full((len(distinct), 2 * DEGREE), -1, np.int64)
        use = place < fresh.shape[1]
        fresh[np.repeat(np.arange(len(distinct)), counts)[use], place[use]] = source[use]
        layer[distinct] = self._choose(distinct, np.concatenate([layer[distinct], fresh], axis=1), layer.shape[1])

    def _beam(self, level: int, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best nodes that a beam finds for each query, best first."""
        layer, n = self.layers[level], len(self.vectors)
        rows = np.arange(len(queries))[:, None]
        visited = np.zeros((len(queries), n), bool)
        repeated = np.zeros(entries.shape, bool)
        for k in range(1, entries.shape[1]):
            repeated[:, k] = (entries[:, :k] == entries[:, k : k + 1]).any(axis=1)
        visited[rows, entries] = True
        ids = np.full((len(queries), width), self.start, np.int64)
        sims = np.full((len(queries), width), -np.inf, np.float32)
        fresh = np.zeros((len(queries), width), bool)

        def merge(at: np.ndarray, new: np.ndarray, new_sims: np.ndarray) -> None:
            all_ids = np.concatenate([ids[at], new], axis=1)
            all_sims = np.concatenate([sims[at], new_sims], axis=1)
            all_fresh = np.concatenate([fresh[at], np.isfinite(new_sims)], axis=1)
            best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[at], sims[at] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
            fresh[at] = np.take_along_axis(all_fresh, best, 1)

        entry_sims = np.einsum("td,tkd->tk", queries, self.vectors[entries])
        merge(np.arange(len(queries)), entries, np.where(repeated, -np.inf, entry_sims))
        at_once = min(4, width)
        while (at := np.flatnonzero(fresh.any(axis=1))).size:
            open_sims = np.where(fresh[at], sims[at], -np.inf)
            top = np.argpartition(-open_sims, at_once - 1, axis=1)[:, :at_once]
            usable = np.isfinite(np.take_along_axis(open_sims, top, 1))
            spread = np.take_along_axis(ids[at], top, 1)
            fresh[at[:, None], top] = False
            new = np.where(usable[:, :, None], layer[spread], -1).reshape(len(at), -1).astype(np.int64)
            new.sort(axis=1)
            known = (new < 0) | visited[at[:, None], new]
            known[:, 1:] |= new[:, 1:] == new[:, :-1]
            visited[at[:, None], np.where(known, self.start, new)] = True
            new_sims = np.einsum("td,tkd->tk", queries[at], self.vectors[new])
            merge(at, new, np.where(known, -np.inf, new_sims))
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        width = min(width, len(self.vectors))
        entries = np.full((len(queries), 1), self.start)
        for level in range(len(self.layers) - 1, 0, -1):
            found, sims = self._beam(level, queries, entries, min(8, len(self.vectors)))
            entries = np.where(np.isfinite(sims[:, :4]), found[:, :4], self.start)
        return self._beam(0, queries, entries, width)

    def within(self, queries: np.ndarray, least: float, width: int) -> list[np.ndarray]:
        """Nodes with at least this similarity, per query.

        What a beam of this width finds, and all that is reached from it along
        links between such nodes: a large group need not fit in the beam.
        """
        ids, sims = self.search(queries, width)
        n = len(self.vectors)
        query, place = np.nonzero(sims >= least)
        node = ids[query, place]
        reached = np.zeros(len(queries) * n, bool)
        seen = np.zeros(len(queries) * n, bool)
        reached[query * n + node] = seen[query * n + node] = True
        waiting = [(query, node)]
        while waiting:
            query, node = waiting.pop()
            if len(query) > 20_000:
                waiting.append((query[20_000:], node[20_000:]))
                query, node = query[:20_000], node[:20_000]
            near = self.layers[0][node]
            pairs = (np.broadcast_to(query[:, None], near.shape) * n + near)[near >= 0]
            pairs = np.unique(pairs[~seen[pairs]])
            seen[pairs] = True
            query, node = pairs // n, pairs % n
            close = np.einsum("pd,pd->p", queries[query], self.vectors[node]) >= least
            if close.any():
                reached[pairs[close]] = True
                waiting.append((query[close], node[close]))
        return [np.flatnonzero(row) for row in reached.reshape(len(queries), n)]


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@dataclass
class Audit:
    """What comparing some queries with a whole shard showed: true links, and those the beams found."""

    true: int = 0
    found: int = 0
    width: int = BEAM

    @property
    def recall(self) -> float:
        return self.found / self.true if self.true else 1.0


def probes(index: np.ndarray, queries: np.ndarray, graph: Graph, threshold: float) -> np.ndarray:
    """Queries that have links to find: an audit of queries without any would show nothing.

    Half are vectors of the index, turned so that their own cosine is between the
    threshold and one; half are those of some queries that a first search found
    the nearest neighbours for.
    """
    draw = np.random.default_rng(len(queries))
    chosen = index[draw.integers(0, len(index), AUDITED // 2)]
    noise = draw.normal(size=chosen.shape)
    noise -= np.einsum("nd,nd->n", noise, chosen)[:, None] * chosen
    lengths = np.linalg.norm(noise, axis=1, keepdims=True)
    cosine = draw.uniform(min(1.0, threshold + 0.001), 1.0, (len(chosen), 1))
    turned = cosine * chosen + np.sqrt(1 - cosine**2) * noise / np.where(lengths > 0, lengths, 1)
    some = queries[draw.permutation(len(queries))[: 8 * AUDITED]]
    _, sims = graph.search(some.astype(np.float32), BEAM)
    nearest = some[np.argsort(-sims[:, 0], kind="stable")[: AUDITED // 2]]
    return unit(np.concatenate([turned, nearest]))


def links_to_shard(
    index: np.ndarray, queries: np.ndarray, threshold: float, audit: Audit | None = None
) -> Iterator[tuple[int, np.ndarray]]:
    """``(query, linked rows of index)`` for every query, of vectors in double precision.

    The beams widen until the links of the probes are found, ``RECALL`` of them at
    least. ``audit`` takes up what was measured.
    """
    audit = audit if audit is not None else Audit()
    index, queries = unit(index), unit(queries)
    graph, single = Graph(index), queries.astype(np.float32)
    audited = probes(index, queries, graph, threshold).astype(np.float32)
    true = audited @ graph.vectors.T >= threshold
    audit.true, audit.width = int(true.sum()), BEAM
    while True:
        found = graph.within(audited, threshold - SLACK, audit.width)
        audit.found = sum(int(t[f].sum()) for t, f in zip(true, found, strict=True))
        if audit.recall >= RECALL or audit.width >= len(index):
            break
        audit.width *= 2
    for start in range(0, len(queries), 512):
        part = slice(start, start + 512)
        for k, near in enumerate(graph.within(single[part], threshold - SLACK, audit.width)):
            yield start + k, near[index[near] @ queries[start + k] >= threshold]


def _read(embeddings: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``(vec, label, digest, raw)``; a vector that cannot link has no digest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            digests, raws = [], []
            for values in batch.column(2).to_pylist():
                raw = None
                if values and None not in values:
                    given = np.array(values, "<f8")
                    scale = np.abs(given).max()
                    if np.isfinite(scale) and scale > 0:
                        raw = (given + 0.0).tobytes()
                raws.append(raw)
                digests.append(None if raw is None else xxh3_128_digest(raw))
            columns = [*batch.columns[:2], pa.array(digests, pa.binary()), pa.array(raws, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec", "label", "digest", "raw"])

    kinds = [embeddings.schema[c].dataType.simpleString() for c in (key, label)]
    chosen = embeddings.select(key, label, F.col(vector).cast("array<double>").alias("values"))
    return chosen.mapInArrow(read, f"vec {kinds[0]}, label {kinds[1]}, digest binary, raw binary")


def near_duplicates(
    embeddings: DataFrame,
    scratch: Scratch,
    *,
    threshold: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``(key, n_links, component_id, kept, audit_recall)`` for every vector.

    Vectors link within a label, at a cosine of ``threshold`` or more. A null
    label or vector, a zero vector, and one with null or non-finite components
    links with nothing; neither do vectors of different lengths. Copies are
    searched once and counted each. The component is the least key reachable by
    links; ``kept`` tells whether it is the row's own key. ``audit_recall`` is the
    share of the links of audited queries, over all shards of the label, that the
    search found; null for a label without vectors that can link.
    """
    rows = scratch.materialize(_read(embeddings, key, vector, label), "vectors")
    size = F.octet_length("raw").alias("size")
    distinct = scratch.materialize(
        rows.where("digest IS NOT NULL AND label IS NOT NULL")
        .groupBy("label", size, "digest")
        .agg(F.first("raw").alias("raw"), F.count(F.lit(1)).alias("copies"), F.min("vec").alias("vec"))
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct-vectors",
    )
    spaces = distinct.groupBy("label", "size").agg(F.count(F.lit(1)).alias("vectors"))
    placed = distinct.join(spaces, ["label", "size"]).withColumns(
        {"shards": F.ceil(F.col("vectors") / SHARD).cast("int"), "blocks": F.ceil(F.col("vectors") / QUERIES).cast("int")}
    )
    shard = F.pmod(F.xxhash64("node", F.lit(1)), F.col("shards")).cast("int").alias("shard")
    block = F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int").alias("block")

    def all_below(count: str, name: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(name)

    indexed = placed.select("label", "size", shard, all_below("blocks", "block"), "node", "copies", "raw", F.lit(True).alias("indexed"))
    asked = placed.select("label", "size", all_below("shards", "shard"), block, "node", "copies", "raw", F.lit(False).alias("indexed"))

    def search(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        vectors = np.frombuffer(b"".join(group.column("raw").to_pylist()), "<f8").reshape(group.num_rows, -1)
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares stay finite
        nodes, copies = (group.column(c).to_numpy() for c in ("node", "copies"))
        in_index = group.column("indexed").to_numpy(zero_copy_only=False)
        mine, theirs = np.flatnonzero(in_index), np.flatnonzero(~in_index)
        one, other, counts = [], [], []
        root: dict[int, int] = {}
        audit = Audit()

        def find(n: int) -> int:
            while root.get(n, n) != n:
                root[n] = n = root.get(root[n], root[n])
            return n

        if len(mine) and len(theirs):
            for k, near in links_to_shard(vectors[mine], vectors[theirs], threshold, audit):
                node, linked = int(nodes[theirs[k]]), mine[near]
                linked = linked[nodes[linked] != node]
                if not len(linked):
                    continue
                one.append(node)
                other.append(None)
                counts.append(int(copies[linked].sum()))
                for found in nodes[linked].tolist():
                    a, b = find(node), find(found)
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        one.append(node)
                        other.append(found)
                        counts.append(0)
        # the audit in a row of its own
        links = {"a": [*one, None], "b": [*other, None], "links": [*counts, None]}
        nothing = [None] * len(one)
        links |= {"audited": [*nothing, audit.true], "recalled": [*nothing, audit.found]}
        columns = {name: pa.array(values, pa.int64()) for name, values in links.items()}
        label = group.column("label")[0].as_py()
        return pa.table({"label": pa.array([label] * (len(one) + 1), group.schema.field("label").type), **columns})

    together = indexed.unionByName(asked).groupBy("label", "size", "shard", "block")
    label_kind = rows.schema["label"].dataType.simpleString()
    schema = f"label {label_kind}, a bigint, b bigint, links bigint, audited bigint, recalled bigint"
    found = scratch.materialize(together.applyInArrow(search, schema), "found-links")
    audits = found.groupBy("label").agg(F.sum("audited").alias("audited"), F.sum("recalled").alias("recalled"))
    recall = audits.select("label", F.when(F.col("audited") > 0, F.col("recalled") / F.col("audited")).alias("audit_recall"))
    n_links = found.where("a IS NOT NULL AND b IS NULL").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")
    groups = connected_components(found.where("b IS NOT NULL").select("a", "b"), scratch)
    grouped = distinct.select("label", "size", "digest", "node", "copies", "vec").join(groups, "node", "left")
    grouped = scratch.materialize(grouped.withColumn("component", F.coalesce("component", "node")), "grouped-vectors")
    least = grouped.groupBy("component").agg(F.min("vec").alias("least"))
    answers = (
        grouped.join(least, "component")
        .join(n_links, "node", "left")
        .select("label", "digest", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    component = F.coalesce("least", "vec")
    return rows.join(answers, ["label", "digest"], "left").join(recall, "label", "left").select(
        F.col("vec").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec").eqNullSafe(component).alias("kept"),
        "audit_recall",
    )
