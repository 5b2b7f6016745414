"""Near duplicates among vectors by NN-descent."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plotwise.llm.components import components
from plotwise.llm.spark import stored

THRESHOLD = 0.93
NEIGHBOURS = 12
TABLES = 10  # random orderings that seed the graph
CELL = 48  # members that one local join compares, more or less
ROUNDS = 6  # of refinement at the most between two audits
SETTLED = 0.002  # share of edges that a round must still improve
AUDIT = 400  # query vectors of a recall audit, drawn by hash; four times as many until
LEAST_LINKS = 200  # so many true links are seen, all vectors were asked, or
MOST_QUERIES = 6400  # the next draw would be larger than this
RECALL = 0.98
BLOCK = 512
MAX_LISTS = 5  # enlargements of the lists after audits


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, cell (label and length), unit vector of all rows that can link with anything."""
    whole = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    ).filter("id is not null and label is not null and v is not null and size(v) > 0")
    whole = whole.filter(
        "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)"
    )
    one = whole.groupBy("id").agg(F.max(F.struct("label", "v")).alias("row"))
    scaled = one.select("id", "row.label", "row.v").withColumn(
        "v", F.expr("transform(v, x -> x / array_max(transform(v, y -> abs(y))))")
    )
    return scaled.select(
        "id",
        F.concat_ws(":", F.size("v").cast("string"), "label").alias("cell"),
        F.expr("transform(v, x -> x / sqrt(aggregate(v, 0D, (s, y) -> s + y * y)))").alias("v"),
    )


def _signs(tables: int, bits: int, seed: int):
    """Signs of random projections: for each table a number whose leading bits are a bucket."""

    def read(batches):
        planes = {}
        for batch in batches:
            for vid, cell, v in zip(*(batch.column(c).to_pylist() for c in ("id", "cell", "v"))):
                n = len(v)
                if n not in planes:
                    planes[n] = np.random.default_rng([seed, n]).normal(size=(tables * bits, n))
                signs = (planes[n] @ np.asarray(v) > 0).reshape(tables, bits)
                codes = (signs * (1 << np.arange(bits))[::-1]).sum(1)
                yield pa.RecordBatch.from_pydict(
                    {"id": [vid], "cell": [cell], "codes": [codes.tolist()]},
                    pa.schema([("id", pa.int64()), ("cell", pa.string()), ("codes", pa.list_(pa.int64()))]),
                )

    return read


def _batched(read, rows: int = 4096):
    """One batch of many small ones."""

    def run(batches):
        kept, n = [], 0
        for batch in read(batches):
            kept.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                kept, n = [], 0
        if kept:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()

    return run


def _local_join(neighbours: int, floor: float = -2.0):
    """Within each group (rows come sorted by it) every member's nearest others.

    Only pairs that may matter leave: the `neighbours` best of each member, both ways.
    """

    def joined(ids, vectors):
        ids = np.asarray(ids)
        ids, at = np.unique(ids, return_index=True)
        n = len(ids)
        if n < 2:
            return None
        m = np.asarray([vectors[i] for i in at])
        sims = m @ m.T
        np.fill_diagonal(sims, -np.inf)
        k = min(neighbours, n - 1)
        best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        a = np.repeat(np.arange(n), k)
        b = best.ravel()
        s = sims[a, b]
        return ids[a], ids[b], s

    def read(batches):
        group, ids, vectors = None, [], []
        for batch in batches:
            g, i, v = batch.column("g").to_pylist(), batch.column("id").to_pylist(), batch.column("v")
            flat = v.flatten().to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.cumsum(v.value_lengths().to_numpy(zero_copy_only=False))])
            for r in range(len(g)):
                if g[r] != group:
                    if len(ids) > 1 and (found := joined(ids, vectors)):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b", "sim"])
                    group, ids, vectors = g[r], [], []
                ids.append(i[r])
                vectors.append(flat[cuts[r] : cuts[r + 1]])
        if len(ids) > 1 and (found := joined(ids, vectors)):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b", "sim"])

    return _batched(read)


EDGES = "a long, b long, sim double"


def _joined_in(groups: DataFrame, vectors: DataFrame, neighbours: int) -> DataFrame:
    """Edges found by comparing the members of each group(g, id)."""
    with_vectors = groups.join(vectors.select("id", "v"), "id").select("g", "id", "v")
    return with_vectors.repartition("g").sortWithinPartitions("g", "id").mapInArrow(_local_join(neighbours), EDGES)


def _nearest(edges: DataFrame, neighbours: int) -> DataFrame:
    """The best edges of each node; an edge found twice counts once."""
    both = edges.union(edges.select("b", "a", "sim")).groupBy("a", "b").agg(F.max("sim").alias("sim"))
    order = Window.partitionBy("a").orderBy(F.col("sim").desc(), "b")
    return both.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= neighbours).drop("place")


def _in_cells(members: DataFrame, size: int) -> DataFrame:
    """Groups(g, id) of members(key, id), a large one dealt by hash into several of about `size`."""
    counts = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / size))
    return members.join(counts, "key").select(
        F.xxhash64("key", F.pmod(F.xxhash64("id", "key"), parts)).alias("g"), "id"
    )


def _seeded(vectors: DataFrame, neighbours: int, seed: int) -> DataFrame:
    """First edges: neighbours in buckets of random projections.

    A bucket's number of bits grows with the logarithm of its label's size, so buckets hold
    about as many members whatever the label.
    """
    bits = 30
    sizes = vectors.groupBy("cell").agg(F.count("*").alias("n"))
    codes = vectors.mapInArrow(_batched(_signs(TABLES, bits, seed)), "id long, cell string, codes array<long>")
    used = F.least(F.lit(bits), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / CELL)))).cast("int")
    members = (
        codes.join(sizes.withColumn("used", used), "cell")
        .select("id", "cell", "used", F.posexplode("codes").alias("t", "code"))
        .select(
            F.xxhash64("cell", "t", F.expr(f"shiftright(code, {bits} - used)")).alias("key"),
            "id",
        )
    )
    return _nearest(_joined_in(_in_cells(members, 2 * CELL), vectors, neighbours), neighbours)


def _refined(graph: DataFrame, vectors: DataFrame, neighbours: int) -> tuple[DataFrame, float]:
    """One round: every node's neighbours, both ways, are compared with one another."""
    around = graph.select(F.col("a").alias("key"), F.col("b").alias("id")).union(
        graph.select(F.col("b").alias("key"), F.col("a").alias("id"))
    ).distinct()
    found = _joined_in(_in_cells(around, 4 * neighbours), vectors, neighbours)
    new = stored(_nearest(graph.union(found), neighbours), "embeddings-graph")
    total = new.count()
    fresh = new.join(graph.select("a", "b"), ["a", "b"], "left_anti").count()
    return new, fresh / max(total, 1)


def descend(vectors: DataFrame, neighbours: int = NEIGHBOURS, seed: int = 1) -> DataFrame:
    """NN-descent: seeded lists, refined until a round improves next to nothing."""
    graph = stored(_seeded(vectors, neighbours, seed), "embeddings-graph")
    for _ in range(ROUNDS):
        graph, improved = _refined(graph, vectors, neighbours)
        if improved < SETTLED:
            break
    return graph


def _against(queries: list, threshold: float):
    """Rows at or above the threshold with any of the query vectors of their cell."""

    def read(batches):
        by_cell = {}
        for vid, cell, v in queries:
            by_cell.setdefault(cell, []).append((vid, v))
        by_cell = {c: (np.array([i for i, _ in x]), np.array([v for _, v in x])) for c, x in by_cell.items()}
        for batch in batches:
            rows = batch.to_pylist()
            cells = {}
            for row in rows:
                cells.setdefault(row["cell"], []).append(row)
            for cell, own in cells.items():
                if cell in by_cell:
                    ids, known = by_cell[cell]
                    sims = np.array([r["v"] for r in own]) @ known.T
                    x, y = np.nonzero(sims >= threshold)
                    mine = np.array([r["id"] for r in own])[x]
                    keep = mine != ids[y]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[y][keep]), pa.array(mine[keep])], ["a", "b"])

    return read


def audit(found: DataFrame, vectors: DataFrame, threshold: float, queries: int = AUDIT) -> float | None:
    """Recall of query vectors' true links, a link being found when both ends share a component.

    Queries are drawn until they show enough links to judge by. None if none of them had any
    and others were not asked: then nothing is known. Each query counts once, however many
    links it has. The lower of two means is given: over queries, and over the components
    found, so that a large one does not outvote the others.
    """
    while True:
        drawn = vectors.orderBy(F.xxhash64("id"), "id").limit(queries).collect()
        asked = [(r["id"], r["cell"], list(r["v"])) for r in drawn]
        truth = stored(vectors.mapInArrow(_against(asked, threshold), "a long, b long"), "embeddings-audit")
        seen, every = truth.count(), len(drawn) < queries
        if seen >= LEAST_LINKS or every or 4 * queries > MOST_QUERIES:
            break
        queries *= 4
    if not seen:
        return 1.0 if every else None
    left = found.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    right = found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    of_query = (
        truth.join(left, "a", "left")
        .join(right, "b", "left")
        .withColumn("ca", F.coalesce("ca", "a"))
        .withColumn("cb", F.coalesce("cb", "b"))
        .groupBy("a", "ca")
        .agg(F.avg((F.col("ca") == F.col("cb")).cast("double")).alias("recall"))
    )
    of_component = of_query.groupBy("ca").agg(F.avg("recall").alias("recall"), F.sum("recall").alias("s"), F.count("*").alias("n"))
    row = of_component.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.avg("recall").alias("m")).first()
    return min(row["s"] / row["n"], row["m"])


def _dealt(members: DataFrame, key: str) -> DataFrame:
    """Members(key, id, ...) in every pair (i, j) of blocks of their key, with the side they are on; 2 is both."""
    sizes = members.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return (
        members.join(sizes, key)
        .withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .withColumn(
            "side", F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
        )
        .drop("blocks", "own", "other")
    )


def _grouped(keys: list, made, schema: pa.Schema):
    """`made` of the rows of each group; rows come sorted by its keys."""

    def read(batches):
        group, rows = None, []

        def out():
            columns = made(rows)
            return [pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)] if columns else []

        for batch in batches:
            for row in batch.to_pylist():
                own = tuple(row[k] for k in keys)
                if own != group and rows:
                    yield from out()
                    rows = []
                group = own
                rows.append(row)
        if rows:
            yield from out()

    return _batched(read)


def _centre(rows):
    """Direction of a part's vectors, and the largest angle between it and any of them."""
    m = np.array([r["v"] for r in rows])
    middle = m.sum(0)
    length = np.sqrt(middle @ middle)
    middle = middle / length if length > 1e-9 else m[0]
    reach = np.arccos(np.clip(m @ middle, -1, 1)).max()
    return [[r[k]] for r, k in ((rows[0], "part"), (rows[0], "cell"), (rows[0], "component"))] + [[middle.tolist()], [float(reach)]]


def _parts_in_reach(threshold: float):
    """Pairs of parts of different components that may hold a link, by the angles between centres."""
    limit = np.arccos(np.clip(threshold, -1, 1)) + 1e-6

    def made(rows):
        side, own = np.array([r["side"] for r in rows]), np.array([r["component"] for r in rows])
        part, reach, m = np.array([r["id"] for r in rows]), np.array([r["reach"] for r in rows]), np.array([r["v"] for r in rows])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        angles = np.arccos(np.clip(m[left] @ m[right].T, -1, 1))
        x, y = np.nonzero(angles - reach[left][:, None] - reach[right][None] <= limit)
        p, q = left[x], right[y]
        keep = (own[p] != own[q]) & ((side[p] != 2) | (part[p] < part[q]))
        return [part[p[keep]], part[q[keep]]]

    return made


def _best_link(threshold: float):
    """The best pair between two parts, if it is a link: one makes their components one."""

    def made(rows):
        side, ids, m = np.array([r["side"] for r in rows]), np.array([r["id"] for r in rows]), np.array([r["v"] for r in rows])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        sims = m[left] @ m[right].T
        at = int(sims.argmax())
        x, y = divmod(at, len(right))
        return [[ids[left[x]]], [ids[right[y]]]] if sims[x, y] >= threshold else None

    return made


def links_between(nodes: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """Links(a, b) that join the components of nodes(id, cell, v): exact, none is left out that would.

    Components are dealt into parts of about a block. Two parts of different components
    are compared in full unless the angle between their centres, less both reaches, is
    beyond the threshold's; one link leaves for each pair of parts.
    """
    with_component = nodes.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    sizes = with_component.groupBy("cell", "component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    members = with_component.join(sizes, ["cell", "component"])
    members = stored(
        members.withColumn("part", F.xxhash64("component", F.pmod(F.xxhash64("id"), "parts"))).drop("parts"), "embeddings-parts"
    )
    kinds = [("part", pa.int64()), ("cell", pa.string()), ("component", pa.int64()), ("v", pa.list_(pa.float64())), ("reach", pa.float64())]
    centres = stored(
        members.repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(
            _grouped(["part"], _centre, pa.schema(kinds)),
            "part long, cell string, component long, v array<double>, reach double",
        ),
        "embeddings-centres",
    ).withColumnRenamed("part", "id")
    pairs = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    near = stored(
        _dealt(centres, "cell")
        .repartition("cell", "i", "j")
        .sortWithinPartitions("cell", "i", "j")
        .mapInArrow(_grouped(["cell", "i", "j"], _parts_in_reach(threshold), pairs), "a long, b long"),
        "embeddings-near-parts",
    )
    sides = near.select("a", "b", F.col("a").alias("part"), F.lit(0).alias("side")).union(
        near.select("a", "b", F.col("b").alias("part"), F.lit(1).alias("side"))
    )
    return (
        sides.join(members.select("part", "id", "v"), "part")
        .repartition("a", "b")
        .sortWithinPartitions("a", "b")
        .mapInArrow(_grouped(["a", "b"], _best_link(threshold), pairs), "a long, b long")
    )


def _linked(threshold: float):
    """Pairs at or above the threshold between two blocks: how many rows each one's are, no pair."""

    def made(rows):
        side, ids, weights = (np.array([r[k] for r in rows]) for k in ("side", "id", "weight"))
        m = np.array([r["v"] for r in rows])
        left = np.flatnonzero(side != 1)
        right = left if (side == 2).all() else np.flatnonzero(side == 1)
        hits = m[left] @ m[right].T >= threshold
        if right is left:
            np.fill_diagonal(hits, False)
            return [ids[left], hits @ weights[left]]
        return [np.concatenate([ids[left], ids[right]]), np.concatenate([hits @ weights[right], hits.T @ weights[left]])]

    return made


def link_counts(found: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """id and n_links of all members of the components found, compared in blocks; a node counts with its weight.

    Blocks bound what a task holds, and counts leave a task, not pairs.
    """
    members = found.withColumnRenamed("node", "id")
    counts = (
        _dealt(members, "component")
        .join(nodes.select("id", "v", "weight"), "id")
        .repartition("component", "i", "j")
        .sortWithinPartitions("component", "i", "j")
        .mapInArrow(
            _grouped(["component", "i", "j"], _linked(threshold), pa.schema([("id", pa.int64()), ("n", pa.int64())])),
            "id long, n long",
        )
    )
    return counts.groupBy("id").agg(F.sum("n").alias("n_links"))


def _joined_by(links: DataFrame, more: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links and components after further links, which may be none."""
    more = stored(more, "embeddings-more")
    if more.isEmpty():
        return links, found
    links = stored(links.union(more), "embeddings-links")
    return links, components(links)


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors with equal labels (not null) and equal lengths are linked at a cosine of at
    least `threshold`, in double precision; component_id is the smallest id reachable.

    1. Equal vectors of a label are one node with a weight. Lists of neighbours are seeded in
       buckets of random projections and refined by NN-descent: the neighbours of each
       node, both ways, are compared with one another until a round changes little. Large
       neighbourhoods are dealt into several groups.
    2. Edges at the threshold make components. Nodes whose list is full of links (the last
       place reaches the threshold) may miss some: they are compared with one another
       across components, exactly and in blocks, which is a list as long as it has to be.
    3. Query vectors, drawn by hash until they show enough links (6,400 at the most), are
       compared with all rows; below the wanted recall the lists are doubled, seeded anew and
       refined again, with what was found kept. If the last lists find too little, or no query
       had a link, all nodes are compared as in 2.
    4. Members of a component are compared in blocks, so that links count in full; only
       counts leave a task.

    Vectors that are null, empty, zero or hold null or non-finite components, and those with
    null id or label, link with nothing: n_links 0, component_id their own id. Rows repeating
    an id are one vector for links (the largest by label, then components). Other columns
    are ignored. An empty table gives an empty result.
    """
    usable = stored(
        usable_vectors(vectors, id_col, vector_col, label_col).withColumn("h", F.xxhash64("cell", "v")), "embeddings-vectors"
    )
    same = ["h", "cell", "v"]
    nodes = usable.groupBy(*same).agg(F.min("id").alias("node"), F.count("*").alias("weight"))
    nodes = stored(nodes, "embeddings-nodes")
    node_of = usable.join(nodes, same).select(F.col("id").alias("vec_id"), "node", "weight")
    ready = nodes.select(F.col("node").alias("id"), "cell", "v", "weight")
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    links, size, whole = None, neighbours, False
    for turn in range(MAX_LISTS):
        graph = descend(ready, size, seed=turn + 1)
        near = graph.filter(F.col("sim") >= threshold)
        both = near.select("a", "b").union(near.select("b", "a"))
        links = stored((both if links is None else both.union(links)).distinct(), "embeddings-links")
        found = components(links)
        full = near.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n")).filter(F.col("n") >= size).select("id")
        full = stored(ready.join(full, "id"), "embeddings-full")
        links, found = _joined_by(links, links_between(full, found, threshold), found)
        recall = audit(found, ready, threshold)
        whole = recall is not None and recall >= RECALL
        if whole or recall is None:
            break
        size *= 2
    if not whole:
        links, found = _joined_by(links, links_between(ready, found, threshold), found)
    counts = link_counts(found, ready, threshold)
    of_node = (
        node_of.join(found, "node", "left")
        .join(counts.withColumnRenamed("id", "node"), "node", "left")
        .select(
            "vec_id",
            (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    return (
        ids.join(of_node, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
