"""Near-duplicate vectors by lattice hashing.

In each of TABLES tables a vector is projected to eight random directions and decoded to the
nearest point of the E8 lattice. It is stored in that cell, and looks for others in it and
in the PROBES neighbouring cells (of the 240 around it) that are nearest to its projection.
Vectors that meet are compared by cosine in double precision.

With the default cells, a pair of cosine 0.93 meets in one table with probability 0.76, so
five tables miss about one such pair in 1,000, and closer pairs more seldom.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import connected_components, to_batch
from tenura.llm.vectors import by_length, is_whole
from tenura.operators.skew import join_small
from tenura.sources.shared import materialize

TABLES = 6
PROBES = 6
# Projections are scaled by this before decoding: larger is finer cells.
SCALE = 0.7
# Vectors of one cell that are compared in one place; more are split.
CELL_ROWS = 512
SEED = 20


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = [
        [a if k == i else b if k == j else 0 for k in range(8)]
        for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)
    ]
    halves = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(pairs + [list(h) for h in halves], np.float64)


MINIMAL = _minimal_vectors()


def _nearest_even(y: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum."""
    point = np.rint(y)
    off = y - point
    odd = np.flatnonzero(point.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_point(y: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: the nearer one of the even points and their shift by 1/2."""
    a, b = _nearest_even(y), _nearest_even(y - 0.5) + 0.5
    nearer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


class LatticeHash:
    """Cells of vectors of one length."""

    def __init__(self, length: int, tables: int, probes: int, scale: float):
        random = np.random.default_rng([SEED, length])
        self.directions = random.normal(size=(tables, length, 8)) * scale
        self.probes = probes
        self.mix = random.integers(1, 1 << 62, size=(tables, 8), dtype=np.int64) * 2 + 1

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """[vector, table, 1 + probes] cell numbers; the vector's own cell comes first."""
        out = []
        for directions, mix in zip(self.directions, self.mix):
            y = unit @ directions
            home = nearest_point(y)
            around = home[:, None, :] + MINIMAL
            distance = ((y[:, None, :] - around) ** 2).sum(axis=2)
            near = np.argpartition(distance, self.probes, axis=1)[:, : self.probes]
            found = np.concatenate([home[:, None], np.take_along_axis(around, near[:, :, None], 1)], 1)
            out.append((np.rint(found * 2).astype(np.int64) * mix).sum(axis=2))
        return np.stack(out, axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class _Hashes(dict):
    def __init__(self, *settings):
        super().__init__()
        self.settings = settings

    def __missing__(self, length: int) -> LatticeHash:
        value = self[length] = LatticeHash(length, *self.settings)
        return value


def _post(classes: DataFrame, settings: tuple) -> DataFrame:
    """Each class in its cell of each table (probe 0) and as a probe of cells (probe 1)."""
    names = ["cell", "probe", "hop", "id", "rep", "size", "label", "vector"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, types)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes(*settings)
        for batch in batches:
            ids, reps, sizes, labels = (np.asarray(batch.column(i)) for i in range(4))
            for rows, x in by_length(batch.column(4)):
                for at in range(0, len(rows), 1000):
                    own, part = rows[at : at + 1000], x[at : at + 1000]
                    cells = hashes[x.shape[1]].cells(_unit(part))
                    n, tables, hops = cells.shape
                    salt = labels[own] * 0x5851F42D4C957F2D + x.shape[1]
                    cells = cells * 0x2545F4914F6CDD1D + salt[:, None, None]
                    cells += np.arange(tables)[None, :, None] * 0x632BE59BD9B4E019
                    data = [v.tobytes() for v in part]
                    stored = np.concatenate([cells[:, :, :1], cells], axis=2).reshape(n, -1)
                    kinds = np.tile(np.r_[0, np.ones(hops)], tables).astype(np.int32)
                    tag = np.repeat(np.arange(tables), 1 + hops).astype(np.int32)
                    wide = stored.shape[1]
                    yield to_batch(schema, [
                        stored.ravel(), np.tile(kinds, n), np.tile(tag, n), np.repeat(ids[own], wide),
                        np.repeat(reps[own], wide), np.repeat(sizes[own], wide),
                        np.repeat(labels[own], wide), [d for d in data for _ in range(wide)],
                    ])

    return classes.select("id", "rep", "size", "label", "vector").mapInArrow(
        run, "cell long, probe int, hop int, id long, rep long, size long, label long, vector binary"
    )


def _meet(posted: DataFrame, settings: tuple, threshold: float) -> DataFrame:
    """Links found in the cells: rows (id, n) of links counted, and (rep_a, rep_b) joining links.

    A pair may meet more than once; it counts in the first table in which it does, which is
    worked out from both vectors. Of the links of a cell only a spanning forest is returned.
    """
    names = ["id", "n", "a", "b"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def first_meeting(cx: np.ndarray, cy: np.ndarray, table: np.ndarray, swapped: np.ndarray):
        """Whether cells cx (probing) and cy (stored) did not meet before this table and turn."""
        forward = (cx == cy[:, :, :1]).any(axis=2)  # x probes the cell of y
        backward = (cy == cx[:, :, :1]).any(axis=2)
        met = forward | backward
        before = np.arange(met.shape[1]) < table[:, None]
        rows = np.arange(len(table))
        return ~((met & before).any(axis=1) | (swapped & backward[rows, table]))

    remembered: dict[int, np.ndarray] = {}

    def cells_of(hashes: LatticeHash, ids: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Cells of vectors; the same ones meet in many places."""
        if len(remembered) > 20_000:
            remembered.clear()
        new = {i: k for k, i in enumerate(ids.tolist()) if i not in remembered}
        if new:
            remembered.update(zip(new, hashes.cells(units[list(new.values())])))
        return np.stack([remembered[i] for i in ids.tolist()])

    def match(hashes, stored: dict, probing: dict) -> Iterator[pa.RecordBatch]:
        unit_s, unit_p = stored["unit"], probing["unit"]
        close = unit_p.astype(np.float32) @ unit_s.astype(np.float32).T >= threshold - 1e-3
        p, s = np.nonzero(close)
        keep = (stored["id"][s] != probing["id"][p]) & (stored["label"][s] == probing["label"][p])
        p, s = p[keep], s[keep]
        counted: dict[int, int] = {}
        parent: dict[int, int] = {}
        edges = []

        def root(v):
            while parent.setdefault(v, v) != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        for at in range(0, len(p), 20_000):
            i, j = p[at : at + 20_000], s[at : at + 20_000]
            cosine = (unit_p[i] * unit_s[j]).sum(axis=1)
            real = cosine >= threshold
            i, j = i[real], j[real]
            for b in range(0, len(i), 1000):
                u, v = i[b : b + 1000], j[b : b + 1000]
                swapped = probing["id"][u] > stored["id"][v]
                met = cells_of(hashes, probing["id"][u], unit_p[u]), cells_of(hashes, stored["id"][v], unit_s[v])
                new = first_meeting(*met, probing["hop"][u], swapped)
                for x, y in zip(u[new].tolist(), v[new].tolist()):
                    for mine, other in (((probing, x), (stored, y)), ((stored, y), (probing, x))):
                        own = int(mine[0]["id"][mine[1]])
                        counted[own] = counted.get(own, 0) + int(other[0]["size"][other[1]])
                    a, c = int(probing["rep"][x]), int(stored["rep"][y])
                    ra, rc = root(a), root(c)
                    if ra != rc:
                        parent[max(ra, rc)] = min(ra, rc)
                        edges.append((a, c))
        if counted:
            n, e = len(counted), len(edges)
            yield to_batch(schema, [
                [*counted, *[None] * e], [*counted.values(), *[None] * e],
                [None] * n + [a for a, _ in edges], [None] * n + [b for _, b in edges],
            ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes(*settings)
        current, stored = None, []
        for batch in batches:
            column = {f: np.asarray(batch.column(i)) for i, f in enumerate(
                ["cell", "part", "probe", "hop", "id", "rep", "size", "label"])}
            data = batch.column(8)
            change = np.zeros(batch.num_rows, bool)
            for name in ("cell", "part", "probe"):
                change[1:] |= column[name][1:] != column[name][:-1]
            starts = np.flatnonzero(change).tolist()
            for begin, end in zip([0, *starts], [*starts, batch.num_rows]):
                if begin == end:
                    continue
                key = (int(column["cell"][begin]), int(column["part"][begin]))
                if key != current:
                    current, stored = key, []
                is_probe = column["probe"][begin]
                if is_probe and not stored:
                    continue
                rows = {f: column[f][begin:end] for f in ("hop", "id", "rep", "size", "label")}
                raw = [v.as_py() for v in data.slice(begin, end - begin)]
                rows["unit"] = [np.frombuffer(v) for v in raw]
                if not is_probe:
                    stored.append(rows)
                    continue
                lone = len(stored) == 1 and len(stored[0]["id"]) == 1
                if lone and (rows["id"] == stored[0]["id"][0]).all():
                    continue
                together = {f: np.concatenate([r[f] for r in stored]) for f in ("hop", "id", "rep", "size", "label")}
                together["unit"] = [v for r in stored for v in r["unit"]]
                lengths = {len(v) for v in together["unit"]} & {len(v) for v in rows["unit"]}
                for length in lengths:
                    left, right = (_of_length(r, length) for r in (together, rows))
                    for at in range(0, len(right["id"]), 4096):
                        part = {f: v[at : at + 4096] for f, v in right.items()}
                        yield from match(hashes[length], left, part)

    ordered = posted.repartition("cell", "part").sortWithinPartitions("cell", "part", "probe")
    return ordered.select(
        "cell", "part", "probe", "hop", "id", "rep", "size", "label", "vector"
    ).mapInArrow(run, "id long, n long, a long, b long")


def _of_length(rows: dict, length: int) -> dict:
    own = [i for i, v in enumerate(rows["unit"]) if len(v) == length]
    out = {f: rows[f][own] for f in ("hop", "id", "rep", "size", "label")}
    return out | {"unit": _unit(np.array([rows["unit"][i] for i in own]))}


def near_duplicate_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for each vector.

    Vectors of one label are linked if their cosine is at least ``threshold``. A null
    label, and a vector that is null, empty, zero or holds null or non-finite components,
    link with nothing; so do vectors of different lengths and rows with a null id (whose
    component is null). Equal vectors of one label are one class: they are linked with each
    other, repeated rows included, and searched once. Links are those the lattice cells
    find; none is below the threshold.
    """
    settings = (tables, probes, scale)
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.col(label).cast("long").alias("label"),
    )
    nonzero = F.exists("vector", lambda x: x != 0)
    valid = is_whole(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("valid", valid & F.coalesce(nonzero, F.lit(False)))
    # Classes by hash; 0.0 and -0.0 are one number.
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    tagged = rows.where("valid").withColumn("vector", plain).withColumn("id", F.xxhash64("label", "vector"))
    classes = tagged.groupBy("id").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"),
        F.first("label").alias("label"), F.first("vector").alias("vector"),
    )
    classes = materialize(classes, "lattice-classes")
    posted = materialize(_post(classes, settings), "lattice-cells")

    stored = posted.where("probe = 0").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    crowded = stored.where(F.col("n") > cell_rows).select(
        "cell", F.ceil(F.col("n") / cell_rows).cast("int").alias("parts")
    )
    posted = join_small(posted, crowded, ["cell"], "left")
    parts = F.coalesce("parts", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("id", F.lit(5)), parts).cast("int"))
    every = F.sequence(F.lit(0), parts - 1)
    posted = posted.withColumn("part", F.explode(F.when(F.col("probe") == 0, own).otherwise(every)))
    met = materialize(_meet(posted.drop("parts"), settings, threshold), "lattice-links")

    counts = met.where("id is not null").groupBy("id").agg(F.sum("n").alias("n"))
    links = met.where("a is not null").select("a", "b")
    nodes = classes.select(F.col("rep").alias("node")).distinct()
    components = connected_components(nodes, links, "lattice")
    placed = classes.select("id", "rep", "size").join(counts, "id", "left").join(
        components.withColumnRenamed("node", "rep"), "rep"
    ).select("id", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component")
    found = tagged.select("vec_id", "id").join(placed, "id").select(
        "vec_id", "n_links", F.col("component").alias("component_id")
    )
    rest = rows.where(~F.col("valid")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found.unionByName(rest).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
