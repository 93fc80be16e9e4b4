"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products.

1. Usable vectors (label and id present, all components finite, not zero) are
   normalised in double precision; equal (label, vector) rows collapse to one
   weighted representative, so copies are never compared with each other.
2. Spherical k-means is fitted on a bounded sample: at most ``SAMPLE`` vectors
   chosen by hash, ``sqrt(n) / 2`` centroids, ``MAX_CELLS`` at most.  Every
   vector is then assigned to its nearest centroid, its home cell.
3. The cells are put in a row, near ones beside each other, and a label with
   more than ``SUPER`` vectors cuts that row into groups of about so many; other
   labels are one group.  A vector is sent to the group of its home cell, and
   once to each other group with a cell that a partner could call home.  A
   partner at the threshold angle can lie beyond the plane between home c and
   other cell d only if ``x.(c - d) <= margin * |c - d|`` with
   ``margin = sin(angle)``.  The default ``guard=1.0`` takes the whole margin
   (``SLACK`` above it for rounding), so the search is exact for any data; a
   smaller guard takes a part of it and may miss links.  So a vector is copied
   at most once per ``SUPER`` vectors of its label, not once a cell, as it was
   read (no unit vectors, no lists of cells are stored).
4. Within a group, tiles of residents by cell meet the rows that may have a
   partner in one of the tile's cells.  Single precision with its error bound
   decides the clear cases, double precision the others.  A partner has one
   home, so every link is counted once.  Groups return link counts and a star
   for each component, never pairs; a group that is too big for a task is cut
   into blocks by hash.
5. Star edges give the components; the smallest id of each is kept.

Null label, vector or component, NaN or infinity, zero vectors: no links,
kept.  Null ids: one row each, kept null-id rows with no links and a null
component.  Repeated ids: one row each, counted as separate vectors.  Vectors
of different lengths are never compared.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import common as C

THRESHOLD = 0.93
SAMPLE, MAX_CELLS, ROUNDS = 65_536, 4_096, 8
BLOCK = 2_048  # rows of a tile
SUPER = 65_536  # residents of a group, for 64 components
ROWS = 1_024  # rows that are held against all centroids at a time
GUARD, SLACK = 1.0, 1e-7


def unit(v: pd.Series) -> np.ndarray:
    return unit_rows(np.vstack([np.asarray(a, np.float64) for a in v]))


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # Scaled first, so that huge or tiny components neither overflow nor vanish.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """k unit centroids of unit rows; an empty cell takes the row worst served."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        s = x @ c.T
        home, best = s.argmax(axis=1), s.max(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        size = np.sqrt((total * total).sum(axis=1))
        worst = iter(np.argsort(best, kind="stable"))
        for j in np.flatnonzero(size < 1e-12):
            total[j], size[j] = x[next(worst)], 1.0
        c = total / size[:, None]
    return c


def may_visit(x: np.ndarray, c: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell of each row, (row, cell) true where the row visits the cell, its home included)."""
    s = x @ c.T
    home = s.argmax(axis=1)
    gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (c[home] @ c.T)))
    near = s[np.arange(len(x)), home][:, None] - s <= margin * gap + SLACK
    near[np.arange(len(x)), home] = True
    return home, near


def probes(x: np.ndarray, c: np.ndarray, margin: float) -> list[np.ndarray]:
    """Cells of each row, the home cell first."""
    return [np.concatenate([[h], np.flatnonzero(r)[np.flatnonzero(r) != h]]) for h, r in zip(*may_visit(x, c, margin))]


def in_a_row(c: np.ndarray) -> np.ndarray:
    """Rank of each centroid when they are halved along their main direction again and again."""
    todo, out = [np.arange(len(c))], []
    while todo:
        part = todo.pop()
        if len(part) <= 2:
            out.extend(part.tolist())
            continue
        own = c[part] - c[part].mean(axis=0)
        part = part[np.argsort(own @ np.linalg.svd(own, full_matrices=False)[2][0], kind="stable")]
        todo += [part[len(part) // 2:], part[:len(part) // 2]]
    rank = np.empty(len(c), np.int64)
    rank[out] = np.arange(len(c))
    return rank


def join_up(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """``label`` (smallest row of each row's component) after rows a and b were linked, in place."""
    pairs = np.stack([label[a], label[b]], axis=1)
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    if not len(pairs):
        return
    names, at = np.unique(pairs, return_inverse=True)
    parent = list(range(len(names)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for i, j in at.reshape(-1, 2).tolist():
        i, j = root(i), root(j)
        parent[max(i, j)] = min(i, j)
    now = np.arange(len(label))
    now[names] = names[[root(k) for k in range(len(names))]]
    label[:] = now[label]


def matrix(lists, dim: int) -> np.ndarray:
    """An Arrow column of lists of equal length as rows."""
    return pc.list_flatten(lists).to_numpy(zero_copy_only=False).reshape(-1, dim)


GUEST, RESIDENT, BOTH = 0, 1, 2  # kinds of rows: visitors only, residents only, residents that visit each other


def _block(cells, threshold: float, margin: float):
    def run(group: pa.Table) -> pa.Table:
        dim = group["dim"][0].as_py()
        kind, home = group["kind"].to_numpy(), group["home"].to_numpy()
        # Residents first, by home cell.
        order = np.lexsort((home, kind == GUEST))
        home, node, copies = home[order], group["id"].to_numpy()[order], group["copies"].to_numpy()[order]
        raw = matrix(group["x"].combine_chunks(), dim)[order]
        n, r, sym = len(order), int((kind != GUEST).sum()), bool((kind == BOTH).any())
        u = np.empty((n, dim), np.float32)
        for lo in range(0, n, BLOCK):
            u[lo:lo + BLOCK] = unit_rows(raw[lo:lo + BLOCK])
        eps = (dim + 8) * 2.0 ** -23  # twice the error of a product in single precision
        c = cells.value.get(dim)
        c32 = None if c is None else c.astype(np.float32)
        own = None if c is None else np.concatenate([np.einsum("ij,ij->i", u[lo:lo + BLOCK], c32[home[lo:lo + BLOCK]]) for lo in range(0, n, BLOCK)])
        links, label = np.zeros(n, np.int64), np.arange(n)
        for lo in range(0, r, BLOCK):
            hi = min(lo + BLOCK, r)
            held = np.unique(home[lo:hi])
            for at in range(lo if sym else r, n, 2 * BLOCK):
                rows = np.arange(at, min(at + 2 * BLOCK, n))
                if c is not None and len(held) < len(c):
                    gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (c @ c[held].T)))[home[rows]]
                    away = own[rows][:, None] - u[rows] @ c32[held].T
                    rows = rows[((away <= margin * gap + SLACK + 4 * eps) | (home[rows][:, None] == held)).any(axis=1)]
                s = u[rows] @ u[lo:hi].T
                i, j = np.divmod(np.flatnonzero(s >= threshold - eps), hi - lo)
                a, b, value = rows[i], lo + j, s[i, j]
                keep = (a > b) & (node[a] != node[b])
                a, b, value = a[keep], b[keep], value[keep]
                open_ = np.flatnonzero(value < threshold + eps)
                fails = np.zeros(len(a), bool)
                for k in range(0, len(open_), BLOCK):
                    some = open_[k:k + BLOCK]
                    fails[some] = np.einsum("ij,ij->i", unit_rows(raw[a[some]]), unit_rows(raw[b[some]])) < threshold
                a, b = a[~fails], b[~fails]
                if not len(a):
                    continue
                np.add.at(links, a, copies[b])
                back = a < r
                np.add.at(links, b[back], copies[a[back]])
                join_up(label, a, b)
        some, tied = np.flatnonzero(links), np.flatnonzero(label != np.arange(n))
        return pa.table({"u": np.concatenate([node[some], node[tied]]), "v": np.concatenate([np.full(len(some), -1), node[label[tied]]]),
                         "links": np.concatenate([links[some], np.zeros(len(tied), np.int64)])})
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, guard: float = GUARD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row."""
    spark = vectors.sparkSession
    # Floats stay floats: what is shuffled and stored is as wide as the input.
    wide = vectors.schema[vector_col].dataType.simpleString() != "array<float>"
    x = F.col(f"`{vector_col}`").cast("array<double>") if wide else F.col(f"`{vector_col}`")
    base = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x"), F.col(f"`{label_col}`").alias("label"))
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
              & ~F.coalesce(F.exists("x", bad), F.lit(False)) & F.coalesce(F.exists("x", lambda e: e != 0), F.lit(False)))
    # -0.0 and 0.0 are one value; the key is exact, label and dimension included.
    values = F.transform(F.col("x").cast("array<double>"), lambda e: (e + 0.0).cast("string"))
    base = base.withColumn("same", F.when(usable, F.unhex(F.sha2(F.concat_ws("|", F.col("label").cast("string"), values), 256))))
    rows = C.store(base.select("vec_id", "same"))
    # Copies combine before the shuffle, so a vector is moved once here, however many copies it has.
    reps = C.store(base.where("same is not null").groupBy("same")
                   .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("x").alias("x"))
                   .withColumn("node", F.xxhash64("same").bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))))
    firsts = reps.select("same", "id", "copies")
    n = reps.count()
    if n:
        links, label = _linked(spark, reps, n, threshold, guard)
    else:
        links = spark.createDataFrame([], "same binary, partners long")
        label = spark.createDataFrame([], "same binary, component long")
    per = (firsts.select("same", F.col("id").alias("first"), "copies").join(links, "same", "left").join(label, "same", "left")
           .select(F.col("same").alias("_same"), (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                   F.coalesce("component", "first").alias("component_id")))
    out = rows.join(C.dealt_anew(per, "_same"), F.col("same") == F.col("_same"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def fit_cells(reps: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Centroids by vector length, from a sample of at most about ``SAMPLE`` rows chosen by hash."""
    part = min(1.0, SAMPLE / n)
    chosen = reps.where(F.pmod(F.xxhash64("same", F.lit(1)), F.lit(1 << 20)) < int(part * (1 << 20)) + 1).select("x")
    found = chosen.limit(SAMPLE).toPandas()["x"]
    by: dict[int, list] = {}
    for v in found:
        by.setdefault(len(v), []).append(v)
    k = min(MAX_CELLS, max(1, math.ceil(math.sqrt(n) / 2)))
    return {d: spherical_kmeans(unit(pd.Series(v)), max(1, min(k, len(v) // 4))) for d, v in by.items()}


def _room():
    """Residents of a group."""
    return F.greatest(F.lit(BLOCK), F.floor(F.lit(SUPER * 64) / F.col("dim")))


def placed_in_groups(reps: DataFrame, n: int, cells, margin: float) -> DataFrame:
    """The representatives with home cell and kind, once for each group (``cell``) that they are sent to.

    ``cells``: broadcast centroids by length."""
    order = reps.sparkSession.sparkContext.broadcast({d: in_a_row(c) for d, c in cells.value.items()})

    def assign(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for dim in pc.unique(table["dim"]).to_pylist():
                part = table.filter(pc.equal(table["dim"], dim))
                for at in range(0, part.num_rows, ROWS):
                    yield from placed_rows(part.slice(at, ROWS), dim)

    def placed_rows(part, dim):
        n, c, groups = part.num_rows, cells.value.get(dim), part["groups"].to_numpy()
        home, row, cell, kind = np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int64), np.full(n, BOTH)
        if c is not None:
            home, near = may_visit(unit_rows(matrix(part["x"].combine_chunks(), dim)), c, margin)
            line = np.argsort(order.value[dim])  # cells in a row
            row, cell, kind = [], [], []
            for g in np.unique(groups):
                mine = np.flatnonzero(groups == g)
                place = order.value[dim] * g // len(c)  # group of each cell
                held, first = np.unique(place[line], return_index=True)
                i, j = np.nonzero(np.logical_or.reduceat(near[mine][:, line], first, axis=1))
                row.append(mine[i])
                cell.append(held[j])
                kind.append(np.where(held[j] == place[home[mine[i]]], BOTH, GUEST))
            row, cell, kind = np.concatenate(row), np.concatenate(cell), np.concatenate(kind)
        ints = lambda a: pa.array(a.astype(np.int32))
        out = part.select(["id", "copies", "label", "dim", "x"]).take(pa.array(row))
        for name, col in (("home", ints(home[row])), ("cell", ints(cell)), ("kind", ints(kind))):
            out = out.append_column(name, col)
        yield from out.to_batches()

    room = _room()
    kinds = {f.name: f.dataType.simpleString() for f in reps.schema.fields}
    own = reps.select(F.col("node").alias("id"), "copies", "label", F.size("x").alias("dim"), "x")
    if n > BLOCK:
        # One row for each SUPER vectors at most.
        big = own.groupBy("label", "dim").agg(F.count("*").alias("_n")).where(F.col("_n") > room)
        own = own.join(F.broadcast(big.withColumn("groups", F.ceil(F.col("_n") / room).cast("long")).drop("_n")), ["label", "dim"], "left")
        own = own.withColumn("groups", F.coalesce("groups", F.lit(1)))
    else:
        own = own.withColumn("groups", F.lit(1).cast("long"))
    schema = f"id long, copies long, label {kinds['label']}, dim int, x {kinds['x']}, home int, cell int, kind int"
    return own.select("id", "copies", "label", "dim", "x", "groups").mapInArrow(assign, schema)


def _linked(spark: SparkSession, reps: DataFrame, n: int, threshold: float, guard: float) -> tuple[DataFrame, DataFrame]:
    """(same, partners) and (same, component) of the representatives."""
    cells = spark.sparkContext.broadcast(fit_cells(reps, n))  # at most MAX_CELLS centroids a length
    margin = guard * math.sqrt(1.0 - threshold * threshold)

    placed = placed_in_groups(reps, n, cells, margin)
    key, room = ["label", "dim", "cell"], _room()
    if n > BLOCK:
        size = placed.groupBy(*key).agg(F.count_if(F.col("kind") == BOTH).alias("h"), F.count("*").alias("v"))
        over = C.store(size.where((F.col("h") > 2 * room) | (F.col("v") > 4 * room))
                       .select(*key, F.ceil(F.col("h") / (2 * room)).cast("int").alias("nh"), F.ceil(F.col("v") / (2 * room)).cast("int").alias("nv")))
        placed = placed.join(F.broadcast(over), key, "left")
    else:
        placed = placed.withColumns({"nh": F.lit(None).cast("int"), "nv": F.lit(None).cast("int")})
    # In a group that is cut, a resident meets the visitors as a row of its own.
    cut = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    block = lambda k, bh, bv: F.struct(F.lit(k).alias("as"), bh.alias("bh"), bv.alias("bv"))
    visits = F.transform(every("nh"), lambda b: block(GUEST, b, cut("nv")))
    hosts = F.transform(every("nv"), lambda b: block(RESIDENT, cut("nh"), b))
    one = F.array(F.struct(F.col("kind").alias("as"), F.lit(0).alias("bh"), F.lit(0).alias("bv")))
    to = F.when(F.col("nh").isNull(), one).when(F.col("kind") == BOTH, F.concat(hosts, visits)).otherwise(visits)
    pieces = (placed.select(*key, "id", "copies", "x", "home", F.explode(to).alias("_to"))
              .select(*key, "id", "copies", "x", "home", F.col("_to.as").alias("kind"), "_to.bh", "_to.bv"))
    found = C.store(pieces.groupBy(*key, "bh", "bv").applyInArrow(_block(cells, threshold, margin), "u long, v long, links long"))
    names = reps.select("node", "same", F.col("id").alias("first"))
    partners = found.where("links > 0").groupBy("u").agg(F.sum("links").alias("partners"))
    links = names.join(partners, F.col("node") == F.col("u")).select("same", "partners")
    edges = found.where("links = 0").select("u", "v")
    group = (C.connected_components(edges).withColumnRenamed("id", "node").join(names, "node")
             .select("same", "first", "component"))
    low = group.groupBy("component").agg(F.min("first").alias("low"))
    return links, group.join(low, "component").select("same", F.col("low").alias("component"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "embeddings"))
