"""Near-duplicate vectors by an exact metric range join.

Vectors of the same label link when their cosine is at least ``cosine``; on unit vectors that is a distance of at most
``eps = sqrt(2 - 2 * cosine)``. Pivots, a bounded sample chosen by a hash, cut space into the cells of the nearest pivot. A
vector also goes to the cell of pivot j if a neighbour of it could live there: by the triangle inequality only if its distance
to j is at most that to its own pivot plus 2 * eps, and, sharper, only if it is within eps of the plane between the two
pivots. So each home cell holds all neighbours of its own vectors, and cells join independently and count each link once.

Equal vectors are one class before the join. Home vectors and candidates of a cell are both cut into blocks of about
``part_rows``, and every pair of blocks is a part of its own, so no task holds a cell, however dense. Inside a part only counts
and a spanning set of links leave, never all pairs. A dense cell of n vectors has (n / part_rows)**2 parts: counting each
vector's links compares them all. Pivots are drawn for every length of which there are many vectors.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components, or whose label is null, links with
nothing; vectors of different length never link; a null id links with nothing, its component is null and it is kept; repeated
rows are equal vectors and link with each other, so each counts the others, and each of them is reported; columns other than
the three named are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .components import components

_CELLS = T.ArrayType(T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("home", T.BooleanType())]))
_CELLS_ARROW = pa.list_(pa.struct([("cell", pa.int32()), ("home", pa.bool_())]))


@F.arrow_udf(T.BinaryType())
def unit(vectors: pa.Array) -> pa.Array:
    """Vectors of length one as doubles; null for those that cannot link."""
    out = []
    for v in vectors.to_pylist():
        x = np.array(v, float) if v and None not in v else np.zeros(1)
        top = np.abs(x).max()
        if not np.isfinite(top) or top == 0:
            out.append(None)
            continue
        x = x / top
        out.append((x / np.linalg.norm(x)).tobytes())
    return pa.array(out, pa.binary())


def _join_part(table: pa.Table, cosine: float) -> pa.Table:
    """Within one part: the links of its queries, and (node, smallest node reached inside the part)."""
    cid, weight = table.column("cid").to_numpy(), table.column("m").to_numpy()
    query, candidate = (table.column(c).to_numpy(zero_copy_only=False) for c in ("query", "candidate"))
    x = np.frombuffer(b"".join(table.column("unit").to_pylist()), float).reshape(len(cid), -1)
    nodes, at = np.unique(cid, return_inverse=True)
    label = np.arange(len(nodes))
    asked, others = np.flatnonzero(query), np.flatnonzero(candidate)
    links = np.zeros(len(asked), np.int64)
    for start in range(0, len(asked), 256):
        own = asked[start : start + 256]
        near = x[own] @ x[others].T >= cosine
        near[cid[own][:, None] == cid[others][None]] = False
        links[start : start + 256] = near @ weight[others]
        for k in np.flatnonzero(near.any(axis=1)).tolist():
            seen = np.unique(label[np.append(at[others[near[k]]], at[own[k]])])
            if len(seen) > 1:
                label[np.isin(label, seen[1:])] = seen[0]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    none = np.zeros(len(moved), np.int64)
    return pa.table({"cid": np.concatenate([cid[asked], nodes[moved]]), "links": np.concatenate([links, none]), "root": np.concatenate([cid[asked], nodes[label[moved]]])})


def cluster(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98, cell_rows: int = 1000, max_pivots: int = 1024, part_rows: int = 2000) -> DataFrame:
    """One row per vector: id_col, n_links, component_id, kept."""
    spark = vectors.sparkSession
    tk.ensure_checkpoint_dir(spark)
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    own = own.select("id", "label", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), F.size("v").alias("dim"), unit("v").alias("unit")).checkpoint()
    usable = own.where("unit is not null and label is not null and id is not null")
    same = ["label", "dim", "h1", "h2"]
    classes = usable.groupBy(*same).agg(F.min("id").alias("cid"), F.count(F.lit(1)).alias("m"))
    points = usable.join(classes, same).where("id = cid").dropDuplicates(["cid", *same]).select("cid", "m", "label", "dim", "unit", "h1").checkpoint()

    # Lengths of more than cell_rows vectors get pivots, the commonest 64 of them; the others' cells are small or cut into parts.
    lengths = points.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("label").alias("labels")).where(F.col("n") > cell_rows)
    lengths = lengths.orderBy(F.desc("n"), "dim").limit(64).collect()
    total = max(1, sum(r["n"] for r in lengths))
    wanted = {r["dim"]: max(4, min(max_pivots * r["n"] // total, -(-r["n"] // (max(1, r["labels"]) * cell_rows)))) for r in lengths}
    share = F.lit(0)
    for r in lengths:
        share = F.when(F.col("dim") == r["dim"], F.lit(int(min(1.0, 2 * wanted[r["dim"]] / r["n"] + 16 / r["n"]) * (1 << 30)))).otherwise(share)
    chosen = points.where(F.pmod("h1", F.lit(1 << 30)) < share).select("dim", "unit", "h1", "cid").orderBy("h1", "cid").limit(4 * (max_pivots + 64 * 16)).collect()
    pivots = {d: np.array([np.frombuffer(r["unit"], float) for r in chosen if r["dim"] == d][:n]) for d, n in wanted.items()}
    pivots = {d: (p, np.maximum(np.linalg.norm(p[:, None] - p[None], axis=2), 1e-12)) for d, p in pivots.items() if len(p)}
    eps = float(np.sqrt(2 - 2 * cosine)) + 1e-9

    @F.arrow_udf(_CELLS)
    def cells(units: pa.Array) -> pa.Array:
        out = []
        for raw in units.to_pylist():
            x = np.frombuffer(raw, float)
            if len(x) not in pivots:
                out.append([{"cell": -1, "home": True}])
                continue
            points_, apart = pivots[len(x)]
            far = np.linalg.norm(points_ - x, axis=1)
            home = int(np.argmin(far))
            near = (far <= far[home] + 2 * eps) & ((far**2 - far[home] ** 2) / (2 * apart[home]) <= eps)
            out.append([{"cell": k, "home": k == home} for k in np.flatnonzero(near).tolist()])
        return pa.array(out, _CELLS_ARROW)

    placed = points.withColumn("at", F.explode(cells("unit"))).select("cid", "m", "label", "dim", "unit", F.col("at.cell").alias("cell"), F.col("at.home").alias("home"))
    cell = ["label", "dim", "cell"]
    blocks = lambda n: F.ceil(n / F.lit(part_rows)).cast("int")
    sizes = placed.groupBy(*cell).agg(blocks(F.count(F.when(F.col("home"), 1))).alias("qs"), blocks(F.count(F.lit(1))).alias("cs")).where("qs > 0")
    sized = placed.join(sizes, cell)
    whole = F.col("qs") * F.col("cs") == 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = [*cell, "q", "c", "cid", "m", "unit", "query", "candidate"]
    candidates = sized.withColumns({"c": F.pmod(F.xxhash64("cid"), F.col("cs")).cast("int"), "query": whole & F.col("home"), "candidate": F.lit(True)}).withColumn("q", every("qs"))
    queries = sized.where(F.col("home") & ~whole).withColumns({"q": F.pmod(F.xxhash64("cid"), F.col("qs")).cast("int"), "query": F.lit(True), "candidate": F.lit(False)}).withColumn("c", every("cs"))
    parts = candidates.select(*rows).unionByName(queries.select(*rows))
    joined = parts.groupBy(*cell, "q", "c").applyInArrow(lambda t: _join_part(t, cosine), "cid long, links long, root long").checkpoint()
    roots = components(joined.where("cid != root").select("cid", "root"), "cid", "root")
    links = joined.groupBy("cid").agg(F.sum("links").alias("links"))

    known = usable.select("id", *same).join(classes, same).join(links, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    known = known.select("id", *same, (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "cid").alias("component_id")).distinct()
    component = F.coalesce("component_id", "id")
    out = own.select("id", *same).join(known, ["id", *same], "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
