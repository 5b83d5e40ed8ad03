"""Embedding near-dedup as an exact metric range join.

Vectors are scaled to length 1, so a cosine of at least c is a distance of at
most r = sqrt(2 - 2c).  Within a label, pivot vectors are drawn; every vector
is at home in the cell of its nearest pivot.  By the triangle inequality a
vector x can have links into another cell j only if

    d(x, p_j) <= r + radius(j)   and   d(x, p_j) - d(x, p_home) <= 2 r

(radius: the largest distance of a home vector), and by the half-space
between two pivots only if x lies within r of it.  It is replicated to those
cells, and each cell compares its home vectors with all that came, on its
own.  A pair is counted once for each of its ends, in the home cell of the
other, so no pair is emitted: a cell returns a count per vector and the links
that connect it.  If d(x, p_j) + radius(j) <= r the whole cell is linked and
needs no comparison.  Both sides of a cell are dealt to chunks by their real
sizes, and a task compares one home chunk with one visitor chunk; a label
without pivots is one cell, at home and visiting with all its vectors.

Equal vectors (same label, same components) are one class with a count, so
copies are compared once.

Cases: NULL labels, NULL or empty vectors, vectors with a NULL or non-finite
component and zero vectors link with nothing; vectors of different length in
one label never link; NULL vec_ids take part in counts but name no component;
repeated rows are vectors of their own; an empty table gives an empty result;
only ``vec_id``, ``label`` and ``embedding`` are read, whatever other columns
there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfold.llm.common import components
from clickfold.session import write_table

# Layout parameters; none of them changes a result.
CELL = 512              # home vectors aimed at per cell
HOME_CELLS = 2          # home vectors aimed at per chunk, in cells
VISITOR_CELLS = 8       # visitors aimed at per chunk, in cells
MAX_PIVOTS = 2048       # pivots of a label; in all there is about one for CELL classes
SLACK = 1e-9            # rounding allowed for when cells are ruled out or in
BLOCK_ROWS = 256
PACK_ROWS = 20_000


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(1))[:, None]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return x @ y.T


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members`` (vec_id, digest or NULL) and ``classes`` (digest, label,
    dim, v, count, first) of usable vectors."""
    v = F.col("embedding")
    usable = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                         & (F.abs(x.cast("double")) < float("inf")))
              & F.exists(v, lambda x: x != 0))
    doubles = F.transform(v, lambda x: x.cast("double") + F.lit(0.0))
    key = F.sha2(F.concat_ws(",", F.col("label").cast("string"),
                             F.transform(doubles, lambda x: x.cast("string"))), 256)
    members = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, F.col("label")).alias("label"),
        F.when(usable, doubles).alias("v"), F.when(usable, key).alias("digest"))
    classes = members.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"),
        F.any_value("label").cast("string").alias("label"), F.any_value("v").alias("v"))
    return members.select("vec_id", "digest"), classes.withColumn("dim", F.size("v"))


def _pivots(classes: DataFrame) -> dict[tuple, np.ndarray]:
    """Pivots per (label, dim) with more than one cell's worth of classes: one
    for CELL classes, at most about MAX_PIVOTS a label."""
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.least(F.ceil(F.col("n") / CELL), F.lit(MAX_PIVOTS))
    sizes = sizes.where(F.col("n") > CELL).withColumn("k", wanted)
    # About k of n classes, by the hash of the vector.
    h = F.pmod(F.xxhash64("digest"), F.lit(1 << 30))
    rows = (classes.join(sizes, ["label", "dim"]).where(h < F.col("k") / F.col("n") * (1 << 30))
            .select("label", "dim", "digest", "v").orderBy("digest").toArrow().combine_chunks())
    return {key: u for batch in rows.to_batches() for key, _, u in _by_group(batch)}


def _distances(u: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (u @ p.T)))


def _by_group(batch):
    """Rows of a batch by (label, dim): positions and unit vectors."""
    labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_pylist()
    groups: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(labels, dims)):
        groups.setdefault(key, []).append(i)
    vectors = batch.column("v")
    for key, at in groups.items():
        yield key, at, _unit(vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1))


def _homes(classes: DataFrame, pivots) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for batch in batches:
            home = np.zeros(batch.num_rows, np.int64)
            dist = np.zeros(batch.num_rows)
            for key, at, u in _by_group(batch):
                if key in shared.value:
                    d = _distances(u, shared.value[key])
                    home[at], dist[at] = d.argmin(1), d.min(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(dist)],
                [*batch.schema.names, "home", "dist"])

    schema = type(classes.schema)(list(classes.schema.fields)).add("home", "long").add("dist", "double")
    return classes.mapInArrow(run, schema)


def _dealt(homes: DataFrame, pivots, cells: dict, radius: float) -> DataFrame:
    """Every class once per cell into which it may have links: ``(label, dim,
    cell)``, ``own`` if it is at home there; and, as cell -1, the cells that
    it is linked with as a whole."""
    sc = homes.sparkSession.sparkContext
    shared = sc.broadcast((pivots, cells))
    out = ("id long, copies long, label string, dim int, v array<double>, cell long, own boolean, "
           "whole array<long>, sure long")

    def run(batches):
        pivot, cell = shared.value
        for batch in batches:
            homes_ = batch.column("home").to_numpy()
            for key, at, u in _by_group(batch):
                at = np.array(at)
                if key not in pivot:
                    yield from pack(batch, at, np.zeros(len(at), np.int64), np.ones(len(at), bool))
                    continue
                p, c = pivot[key], cell[key]
                for s in range(0, len(at), BLOCK_ROWS):
                    rows, x = at[s:s + BLOCK_ROWS], u[s:s + BLOCK_ROWS]
                    home, k = homes_[rows], np.arange(len(rows))
                    d = _distances(x, p)
                    mine = d[k, home][:, None]
                    gap = _distances(p[home], p)
                    half = (d * d - mine * mine) / np.maximum(2 * gap, 1e-12)
                    near = ((d <= radius + c["radius"] + SLACK) & (d - mine <= 2 * radius + SLACK)
                            & ((half <= radius + SLACK) | (gap < 1e-6)) & (c["n"] > 0))
                    whole = (d + c["radius"] <= radius - SLACK) & (c["n"] > 0)
                    near[k, home] = True
                    whole[k, home] = False
                    who, to = np.nonzero(near & ~whole)
                    yield from pack(batch, rows[who], to, to == home[who])
                    some = np.flatnonzero(whole.any(1))
                    yield from pack(batch, rows[some], np.full(len(some), -1), np.zeros(len(some), bool),
                                    [c["first"][whole[i]].tolist() for i in some],
                                    [int(c["copies"][whole[i]].sum()) for i in some])

    def pack(batch, rows, cell, own, whole=None, sure=None):
        for s in range(0, len(rows), PACK_ROWS):
            e = s + PACK_ROWS
            at = pa.array(rows[s:e])
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(at) for c in ("id", "copies", "label", "dim")],
                 pa.nulls(n, pa.list_(pa.float64())) if whole else batch.column("v").take(at),
                 pa.array(cell[s:e], pa.int64()), pa.array(own[s:e]),
                 pa.array(whole[s:e] if whole else [None] * n, pa.list_(pa.int64())),
                 pa.array(sure[s:e] if sure else [0] * n, pa.int64())],
                [x.split()[0] for x in out.split(", ")])

    return homes.mapInArrow(run, out)


def _chunk_pairs(dealt: DataFrame) -> DataFrame:
    """The classes of each cell once per pair of a home chunk and a visitor
    chunk in which they take part: ``visits``, ``own`` or both.  A pair of a
    visitor and a home class meets in exactly one pair of chunks."""
    cut = dealt.where("cell >= 0").select("label", "dim", "cell", "id", "copies", "v", "own")
    key = ["label", "dim", "cell"]
    sizes = cut.groupBy(*key).agg(
        F.ceil(F.count_if("own") / F.lit(HOME_CELLS * CELL)).cast("long").alias("_h"),
        F.ceil(F.count(F.lit(1)) / F.lit(VISITOR_CELLS * CELL)).cast("long").alias("_w"))
    cut = cut.join(write_table(sizes, name="sizes"), key).withColumns({
        "_i": F.pmod(F.xxhash64("id"), F.col("_h")), "_j": F.pmod(F.xxhash64("id", F.lit(1)), F.col("_w"))})

    def pair(home, visitor, visits, own):
        return F.struct(home.alias("home_chunk"), visitor.alias("visitor_chunk"),
                        visits.alias("visits"), own.alias("own"))

    zero = F.lit(0).cast("long")
    visiting = F.transform(F.sequence(zero, F.col("_h") - 1), lambda c: pair(
        c, F.col("_j"), F.lit(True), F.col("own") & (c == F.col("_i"))))
    at_home = F.transform(F.filter(F.sequence(zero, F.col("_w") - 1), lambda c: F.col("own") & (c != F.col("_j"))),
                          lambda c: pair(F.col("_i"), c, F.lit(False), F.lit(True)))
    return cut.select(*key, "id", "copies", "v", F.explode(F.concat(visiting, at_home)).alias("_p")).select(
        *key, "_p.*", "id", "copies", "v")


def _join_chunk(least: float):
    def run(key, table):
        """Links of each visitor with the home classes of the chunk."""
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        table = table.take(order)
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        own, visitors = (np.flatnonzero(table[c].to_numpy(zero_copy_only=False)) for c in ("own", "visits"))
        flat = table["v"].combine_chunks()
        u = _unit(flat.values.to_numpy().reshape(len(ids), -1))
        counts = np.zeros(len(ids), np.int64)
        up = np.arange(len(ids))

        def root(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for at in range(0, len(visitors), BLOCK_ROWS):
            rows = visitors[at:at + BLOCK_ROWS]
            hit = cosines(u[rows], u[own]) >= least
            hit[rows[:, None] == own[None, :]] = False
            counts[rows] = hit @ copies[own]
            for i, js in zip(rows[hit.any(1)], hit[hit.any(1)]):
                for j in np.unique(up[own[js]]):
                    x, y = root(int(i)), root(int(j))
                    if x != y:
                        up[max(x, y)] = min(x, y)
        to = np.array([ids[root(i)] for i in range(len(ids))], np.int64)
        some = (counts > 0) | (to != ids)
        return pa.table({"id": ids[some], "n": counts[some], "to": to[some]})

    return run


def dedup(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id,
    label, embedding``; links are within a label, at a cosine >= ``least``."""
    radius = float(np.sqrt(max(0.0, 2.0 - 2.0 * least)))
    members, classes = classes_of(vectors)
    members = write_table(members, name="members")
    # Classes are joined by the hash of the vector, a stable 63-bit number.
    classes = write_table(classes.withColumn(
        "id", F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")), name="classes")
    pivots = _pivots(classes)
    homes = write_table(_homes(classes, pivots), name="homes")
    cells = _cells(homes, pivots)
    dealt = write_table(_dealt(homes, pivots, cells, radius), name="dealt")
    found = write_table(_chunk_pairs(dealt).groupBy("label", "dim", "cell", "home_chunk", "visitor_chunk")
                        .applyInArrow(_join_chunk(least), "id long, n long, to long"), name="found")
    sure = dealt.where("cell = -1")
    counts = (found.select("id", "n").unionByName(sure.select("id", F.col("sure").alias("n")))
              .groupBy("id").agg(F.sum("n").alias("n")))
    edges = found.where("id != to").select(F.col("id").alias("a"), F.col("to").alias("b")).unionByName(
        sure.select(F.col("id").alias("a"), F.explode("whole").alias("b")))
    comp = write_table(components(edges), name="components")
    # Names: the smallest vec_id of a component, by its classes.
    named = classes.select("digest", "id", "copies", "first").join(
        comp.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    named = write_table(named.join(write_table(counts, name="counts"), "id", "left"), name="named")
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    per_class = write_table(named.join(write_table(names, name="names"), "component").select(
        "digest", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        name="per_class")
    out = members.join(per_class, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _cells(homes: DataFrame, pivots) -> dict:
    """Per (label, dim) and cell: home classes, their vectors, radius and the
    id of one class (as many rows as there are pivots)."""
    empty = {k: dict(n=np.zeros(len(p), np.int64), copies=np.zeros(len(p), np.int64),
                     radius=np.zeros(len(p)), first=np.zeros(len(p), np.int64)) for k, p in pivots.items()}
    if not pivots:
        return empty
    rows = homes.groupBy("label", "dim", "home").agg(
        F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"), F.max("dist").alias("radius"),
        F.min_by("id", F.struct("dist", "id")).alias("first"))
    for r in rows.join(_keys(homes.sparkSession, pivots), ["label", "dim"]).collect():
        c = empty[(r["label"], r["dim"])]
        for name in ("n", "copies", "radius", "first"):
            c[name][r["home"]] = r[name]
    return empty


def _keys(spark, pivots) -> DataFrame:
    return spark.createDataFrame(list(pivots), "label string, dim int")
