"""Embedding near-dedup with navigable small-world graphs (operator 10).

Equal vectors are one node. The nodes of a label are dealt over shards of bounded size; each shard builds a
hierarchical navigable small-world graph, and every node of the label queries every shard. Beams are widened until an
audit against brute force finds nearly all links; where links are too rare to audit, brute force answers all. Links are verified by cosine in double precision and united to
components. Within a component links are then counted exactly, block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.llm.components import components
from shelfrisk.llm.vectors import matrix, usable
from shelfrisk.session import materialise

SHARD_ROWS = 32_768  # nodes of one graph
QUERY_ROWS = 65_536  # queries that one copy of a graph answers
BLOCK_ROWS = 1024  # nodes compared at once when links are counted
LINKS = 12  # of a node on the upper layers; twice as many on the lowest
BEAM = 48
WIDEST = 384  # beyond this beam, brute force is cheaper
AUDIT = 64  # queries of a block, at least, that are also answered by brute force
SEEN = 200  # audited queries with links that recall is measured on
RECALL = 0.99
EXPAND = 4  # candidates whose neighbours are looked at in one step


class Graph:
    """Navigable small-world layers over unit vectors, filled in batches."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        self.vectors = vectors.astype(np.float32)
        n = len(vectors)
        rng = np.random.default_rng(seed)
        self.height = np.minimum((-np.log(rng.random(n)) / np.log(LINKS)).astype(int), 8)
        self.layers = [np.full((n, 2 * LINKS if level == 0 else LINKS), -1, dtype=np.int32) for level in range(self.height.max(initial=0) + 1)]
        done = 0
        while done < n:
            size = min(n - done, max(64, min(done, 1024)))
            self._insert(np.arange(done, done + size), done)
            done += size

    def _insert(self, fresh: np.ndarray, done: int) -> None:
        entry = self._entry(done)
        mine = self.vectors[fresh]
        among = mine @ mine.T
        np.fill_diagonal(among, -2)
        for level in range(len(self.layers) - 1, -1, -1):
            if done:
                found, _ = self._layer(mine, entry, level, BEAM if (self.height[fresh] >= level).any() else 4)
                entry = found[:, :4]
            in_layer = np.flatnonzero(self.height[fresh] >= level)
            if not len(in_layer):
                continue
            width = min(2 * LINKS, len(in_layer))
            close = among[np.ix_(in_layer, in_layer)]
            near = np.argpartition(-close, width - 1, axis=1)[:, :width] if width < len(in_layer) else np.tile(np.arange(width), (len(in_layer), 1))
            near = fresh[in_layer][near]
            near = np.where(near == fresh[in_layer][:, None], -1, near)
            options = np.concatenate([found[in_layer], near], axis=1) if done else near
            chosen = self._choose(fresh[in_layer], options, self.layers[level].shape[1])
            self.layers[level][fresh[in_layer]] = chosen
            self._link_back(level, np.repeat(fresh[in_layer], chosen.shape[1]), chosen.ravel())

    def _link_back(self, level: int, source: np.ndarray, target: np.ndarray) -> None:
        """The other direction of new links; full nodes choose anew."""
        links, use = self.layers[level], target >= 0
        source, target = source[use], target[use]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, start, count = np.unique(target, return_index=True, return_counts=True)
        width = links.shape[1]
        for at in range(0, len(nodes), 2048):
            part, first, n = nodes[at:at + 2048], start[at:at + 2048], count[at:at + 2048]
            most = int(n.max())
            extra = np.full((len(part), most), -1, dtype=np.int64)
            column = np.arange(most)
            filled = column < n[:, None]
            extra[filled] = source[(first[:, None] + column)[filled]]
            if most > 4 * width:  # keep the closest; the rest still point here
                sims = np.where(extra >= 0, np.einsum("ijk,ik->ij", self.vectors[extra], self.vectors[part]), -2)
                extra = np.take_along_axis(extra, np.argsort(-sims, axis=1)[:, :4 * width], axis=1)
            links[part] = self._choose(part, np.concatenate([links[part], extra], axis=1), width)

    def _choose(self, nodes: np.ndarray, options: np.ndarray, width: int) -> np.ndarray:
        """Up to `width` options per node: those closer to it than to any chosen before, then the closest others."""
        out = np.full((len(nodes), width), -1, dtype=np.int32)
        for at in range(0, len(nodes), 256):
            part, own = options[at:at + 256], self.vectors[nodes[at:at + 256]]
            part = np.sort(part, axis=1)
            part[:, 1:][part[:, 1:] == part[:, :-1]] = -1
            part[part == nodes[at:at + 256, None]] = -1
            there = self.vectors[part]
            sims = np.where(part >= 0, np.einsum("ijk,ik->ij", there, own), -2)
            order = np.argsort(-sims, axis=1)
            part, sims = np.take_along_axis(part, order, axis=1), np.take_along_axis(sims, order, axis=1)
            there = self.vectors[part]
            mutual = np.einsum("ijk,ilk->ijl", there, there)
            taken = np.zeros(part.shape, dtype=bool)
            blocked = part < 0
            for j in range(part.shape[1]):
                pick = ~blocked[:, j] & (taken.sum(1) < width)
                taken[:, j] = pick
                blocked |= pick[:, None] & (mutual[:, j] > sims) & ~taken
            # Fill up in order of closeness.
            rank = np.argsort(~taken * 2 + (part < 0) * 4, axis=1, kind="stable")[:, :width]
            row = np.take_along_axis(part, rank, axis=1)
            out[at:at + 256, :row.shape[1]] = row
        return out

    def _entry(self, done: int) -> np.ndarray:
        return np.array([int(self.height[:done].argmax())]) if done else np.zeros(0, dtype=int)

    def _layer(self, queries: np.ndarray, entry: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of a beam search from `entry`, best first; -1 where the beam is not full."""
        links, n = self.layers[level], len(self.vectors)
        ids, sims = np.full((len(queries), beam), -1, dtype=np.int64), np.full((len(queries), beam), -2, dtype=np.float32)
        for at in range(0, len(queries), 512):
            q = queries[at:at + 512]
            start = entry[at:at + 512] if entry.ndim == 2 else np.tile(entry, (len(q), 1))
            seen = np.zeros((len(q), n + 1), dtype=bool)
            seen[:, n] = True  # the place of -1
            rows = np.arange(len(q))
            own, score = ids[at:at + 512], sims[at:at + 512]
            open_ = np.zeros((len(q), beam), dtype=bool)
            new, who = start, rows
            while True:
                new = np.where(seen[who[:, None], new], -1, new)
                # The same neighbour may come from two candidates.
                order = np.sort(new, axis=1)
                order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
                new = order
                seen[who[:, None], new] = True
                value = np.where(new >= 0, np.einsum("ijk,ik->ij", self.vectors[new], q[who]), -2)
                all_ids, all_sims = np.concatenate([own[who], new], axis=1), np.concatenate([score[who], value], axis=1)
                all_open = np.concatenate([open_[who], new >= 0], axis=1)
                best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
                own[who], score[who] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
                open_[who] = np.take_along_axis(all_open, best, 1) & (own[who] >= 0)
                who = np.flatnonzero(open_.any(1))
                if not len(who):
                    break
                pick = np.argsort(~open_[who], axis=1, kind="stable")[:, :EXPAND]
                real = np.take_along_axis(open_[who], pick, 1)
                nodes = np.where(real, np.take_along_axis(own[who], pick, 1), -1)
                open_[who[:, None], pick] = False
                new = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(who), -1).astype(np.int64)
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        queries, entry = queries.astype(np.float32), self._entry(len(self.vectors))
        for level in range(len(self.layers) - 1, 0, -1):
            entry = self._layer(queries, entry, level, 4)[0]
        return self._layer(queries, entry, 0, min(beam, len(self.vectors)))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number for each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def merged(group: np.ndarray, rows: int, row: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of nodes, each named by its smallest, after `rows` queries have linked to nodes: query row[i] to node hit[i].
    With them as few links as say the same: node a[i] to b[i], where numbers from len(group) on are queries."""
    n = len(group)
    pair = np.unique(row.astype(np.int64) * n + group[hit])
    query, node = np.unique(pair // n), np.unique(pair % n)
    label = roots(n + rows, pair // n + n, pair % n)
    a = np.append(node[label[node] != node], query + n)
    return label[group], a, label[a]


def shard_links(ids: np.ndarray, vectors: np.ndarray, queries, threshold: float):
    """Links (a, b) that join the nodes of a shard and (ids, unit vectors) of query blocks as all true links do.

    A query whose beam is full of links may have more; it is answered by brute force. Of the others, some of every
    block are audited, until SEEN with few links have been met or the block is exhausted, which makes it exact. The recall of
    the last SEEN, a mean over queries, must reach RECALL, or the beam is widened. All links that brute force meets count.
    """
    graph, beam, n = Graph(vectors), BEAM, len(ids)
    group = np.arange(n)  # nodes joined by the links of earlier blocks
    few, many = [], []  # recall of queries audited at this beam: with up to BEAM links, with more
    for query_ids, q in queries:
        m, own = len(q), _same(query_ids, ids)
        named = np.append(ids, query_ids)
        rest = np.random.default_rng(m).permutation(m)
        while True:
            found, sims = graph.search(q, min(beam, WIDEST))
            row, column = np.nonzero((found >= 0) & (sims >= threshold - 1e-3))
            hit = found[row, column]
            real = np.einsum("ij,ij->i", q[row], vectors[hit]) >= threshold
            row, hit = row[real], hit[real]
            other = query_ids[row] != ids[hit]
            full = np.bincount(row, minlength=m) >= found.shape[1]
            row, hit, here = row[other], hit[other], np.flatnonzero(own >= 0)
            place = np.full(m, -1)  # a node that the query is joined to
            place[row], place[here] = hit, own[here]
            sure, a, b = merged(group, m, np.append(row, here), np.append(hit, own[here]))
            links = [(named[a], named[b])]

            def compared(some):
                """Links of some queries by brute force; they are kept."""
                nonlocal sure
                who, what = np.nonzero((q[some] @ vectors.T >= threshold) & (query_ids[some][:, None] != ids))
                mine = np.flatnonzero(own[some] >= 0)
                sure, a, b = merged(sure, len(some), np.append(who, mine), np.append(what, own[some][mine]))
                name = np.append(ids, query_ids[some])
                links.append((name[a], name[b]))
                return who, what

            hot = np.flatnonzero(full)
            for at in range(0, len(hot), AUDIT):
                compared(hot[at:at + AUDIT])
            reached, draw, drawn = sure, rest[~full[rest]], 0
            while drawn < len(draw) and (not drawn or beam > WIDEST or len(few) < SEEN):
                some = draw[drawn:drawn + AUDIT]
                drawn += len(some)
                who, what = compared(some)
                held = (place[some[who]] >= 0) & (reached[place[some[who]]] == reached[what])
                count = np.bincount(who, minlength=len(some))
                recall = np.bincount(who, held, minlength=len(some)) / np.maximum(count, 1)
                few += recall[(count > 0) & (count <= BEAM)].tolist()
                many += recall[count > BEAM].tolist()
            if drawn == len(draw) or all(np.mean(r[-SEEN:]) >= RECALL for r in (few, many) if r):
                break
            beam *= 2
            few, many = [], []
        group = sure
        a, b = (np.concatenate(side) for side in zip(*links))
        if (a != b).any():
            yield a[a != b], b[a != b]


def _same(query_ids: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Number of the node that is the query itself, -1 if none is."""
    order = np.argsort(ids)
    node = order[np.minimum(np.searchsorted(ids[order], query_ids), len(ids) - 1)]
    return np.where(ids[node] == query_ids, node, -1)


def near_duplicates(table: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Rows link if their labels are equal and not NULL and the cosine of their embeddings, in double precision, is at
    least `threshold`. Vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing;
    vectors of different lengths are compared as if the shorter one ended in zeros. component_id is the smallest
    vec_id that links reach. Repeated rows link like any others, also rows with one vec_id and several vectors or labels; a row without vec_id links with nothing and is
    not kept. Links between different vectors are found by approximate search: what an audit
    of each task leaves open may be missed. Other columns are ignored.
    """
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding")
    fit = whole & F.exists("embedding", lambda v: v != 0)
    flagged = rows.withColumn("fit", F.coalesce(fit, F.lit(False))).withColumn("mark", F.when(F.col("fit"), F.xxhash64("label", "embedding")))
    # A node is a different vector of a label; its number is stored, as one vec_id may have several vectors and labels.
    nodes = flagged.filter("fit").groupBy("label", "mark", "embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()))
    width = nodes.agg(F.max(F.size("embedding"))).first()[0] or 1

    sizes = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.select("label", F.ceil(F.col("rows") / SHARD_ROWS).cast("int").alias("shards"), F.ceil(F.col("rows") / QUERY_ROWS).cast("int").alias("salts"))
    placed = nodes.join(sizes, "label").withColumn("h", F.xxhash64("mark", F.lit(1)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    index = placed.select("label", F.pmod("h", "shards").cast("int").alias("shard"), every("salts").alias("salt"), F.lit(0).alias("asks"), "node", "embedding", "h")
    asks = placed.select("label", every("shards").alias("shard"), F.pmod(F.shiftright("h", 20), "salts").cast("int").alias("salt"), F.lit(1).alias("asks"), "node", "embedding", "h")

    def unit(column):
        x = matrix(column, width)
        x = x / np.abs(x).max(1, keepdims=True)  # squares of very small or large components stay in range
        return x / np.sqrt((x**2).sum(1, keepdims=True))

    def parts(batches):
        """(key, asks, ids, unit vectors) runs of rows that arrive sorted."""
        for batch in batches:
            if not batch.num_rows:
                continue
            key = list(zip(*(batch.column(c).to_pylist() for c in ("label", "shard", "salt", "asks"))))
            cut = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
            ids, x = batch.column("node").to_numpy(), unit(batch.column("embedding"))
            for a, b in zip(cut, cut[1:]):
                yield key[a][:3], key[a][3], ids[a:b], x[a:b]

    def link(batches):
        import itertools
        held = {}
        for key, group in itertools.groupby(parts(batches), key=lambda p: p[0]):
            built = []

            def queries():
                for _, asking, ids, x in group:
                    if asking:
                        for at in range(0, len(ids), 2048):
                            yield ids[at:at + 2048], x[at:at + 2048]

            first = None
            for part in group:
                if part[1]:
                    first = part
                    break
                built.append(part)
            if not built or first is None:
                continue
            ids, x = np.concatenate([p[2] for p in built]), np.concatenate([p[3] for p in built])
            group = itertools.chain([first], group)
            for a, b in shard_links(ids, x, queries(), threshold):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    found = (index.unionByName(asks).repartition("label", "shard", "salt").sortWithinPartitions("label", "shard", "salt", "asks", "h")
             .mapInArrow(link, "a long, b long"))
    classes = materialise(components(found).withColumnRenamed("id", "node"))

    # Exact counts inside components: blocks of nodes against blocks of nodes.
    members = nodes.join(classes, "node")
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    members = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), "blocks"))
    blocks = materialise(members.groupBy("component", "block", "blocks").agg(F.collect_list(F.struct("node", "copies", "embedding")).alias("members")))
    left = blocks.select("component", F.col("block").alias("i"), F.col("members").alias("left"))
    right = blocks.select("component", F.col("block").alias("j"), F.col("members").alias("right"))

    def count(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                (a, n_a, x), (b, n_b, y) = ((m.field("node").to_numpy(), m.field("copies").to_numpy(), unit(m.field("embedding")))
                                            for m in (one.column(c).flatten() for c in ("left", "right")))
                near = (x @ y.T >= threshold) & (a[:, None] != b)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(near.astype(np.int64) @ n_b)], names=["node", "others"])

    others = (left.join(right, "component").select("left", "right").mapInArrow(count, "node long, others long")
              .groupBy("node").agg(F.sum("others").alias("others")))
    smallest = nodes.select("node", "least").join(classes, "node").groupBy("component").agg(F.min("least").alias("smallest"))
    smallest = classes.join(smallest, "component").select("node", "smallest")
    named = (nodes.join(others, "node", "left").join(smallest, "node", "left")
             .select(F.col("mark").alias("own_mark"), F.col("label").alias("own_label"), F.col("embedding").alias("own"),
                     (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("smallest", "least").alias("component")))
    return (flagged.join(named, (F.col("mark") == F.col("own_mark")) & (F.col("label") == F.col("own_label")) & (F.col("embedding") == F.col("own")), "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
