"""What lies beside what on a grid: neighbours, vertices, Voronoi cells, and a digest of a grid's rows.

Neighbours are found by equi-joins: triangles meet over the vertices that they
share, cells of rings over the azimuth buckets that both cover, and the cells of
points over the voxels around their centres.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.functions.columns import TWO_PI
from leafray.operators import grids

RINGS, TRIANGLES, POINTS = ("equal_area", "equal_angle", "equirectangular"), ("geodesic", "htm"), ("fibonacci", "healpix")
#: Angles and coordinates that are this close are one.
CLOSE = 1e-9
#: The modulus (a prime) and the base of the digest.
MODULUS, BASE = 2**127 - 1, 0x9E3779B97F4A7C15F39CC0605CEDC835 % (2**127 - 1)


def _units(x: Column) -> Column:
    return F.round(x / CLOSE).cast("long")


def _turn_units(phi: Column) -> Column:
    """An azimuth as a whole number of units; a full turn is 0."""
    return F.pmod(_units(phi), F.lit(round(TWO_PI / CLOSE)))


def _ring_neighbors(grid: DataFrame) -> DataFrame:
    width = F.pmod(F.col("phi_max") - F.col("phi_min"), F.lit(TWO_PI))
    c = grid.select(
        "cell_id",
        F.pmod("phi_min", F.lit(TWO_PI)).alias("begin"),
        F.when(width < CLOSE, TWO_PI).otherwise(width).alias("width"),
        _units(F.col("theta_min")).alias("inner"),
        _units(F.col("theta_max")).alias("outer"),
    )
    other = lambda d: d.select(*[F.col(x).alias(f"{x}_o") for x in d.columns])
    # in a ring, a cell begins where another ends, give or take a unit
    full = F.lit(round(TWO_PI / CLOSE))
    end = _turn_units(F.col("begin") + F.col("width"))
    ends = c.withColumn("end", F.explode(F.array(*[F.pmod(end + d, full) for d in (-1, 0, 1)])))
    begins = other(c.withColumn("start", _turn_units(F.col("begin"))))
    same = ends.join(begins, (F.col("inner") == F.col("inner_o")) & (F.col("end") == F.col("start_o"))).select("cell_id", F.col("cell_id_o").alias("neighbor_id"))
    # where rings touch, both sides list the azimuth buckets that they cover; there are as many as the outer ring has cells
    sizes = c.groupBy(F.col("inner").alias("edge")).agg(F.count(F.lit(1)).alias("buckets"))

    def spread(cells: DataFrame, edge: str) -> DataFrame:
        placed = cells.withColumn("edge", F.col(edge)).join(sizes, "edge")
        step = F.lit(TWO_PI) / F.col("buckets")
        first, last = F.floor((F.col("begin") + CLOSE) / step), F.floor((F.col("begin") + F.col("width") - CLOSE) / step)
        return placed.withColumn("bucket", F.explode(F.sequence(first, last))).withColumn("bucket", F.pmod("bucket", "buckets"))

    inside, outside = spread(c, "outer").drop("buckets"), other(spread(c, "inner").drop("buckets"))
    met = inside.join(outside, (F.col("edge") == F.col("edge_o")) & (F.col("bucket") == F.col("bucket_o")))
    # they share more than a point if one begins well inside the other
    ahead = lambda a, b: F.pmod(b - a + CLOSE, F.lit(TWO_PI)) - CLOSE
    overlap = (ahead(F.col("begin"), F.col("begin_o")) < F.col("width") - CLOSE) | (ahead(F.col("begin_o"), F.col("begin")) < F.col("width_o") - CLOSE)
    across = met.where(overlap).select("cell_id", F.col("cell_id_o").alias("neighbor_id"))
    return same.unionByName(across)


def _triangle_neighbors(grid: DataFrame) -> DataFrame:
    key = F.transform("vertices", lambda v: F.concat_ws(",", _units(v.x), _units(v.y), _units(v.z)))
    at = grid.select("cell_id", F.explode(key).alias("vertex"))
    met = at.join(at.withColumnRenamed("cell_id", "neighbor_id"), "vertex").where("cell_id <> neighbor_id")
    return met.groupBy("cell_id", "neighbor_id").agg(F.count(F.lit(1)).alias("shared")).where("shared > 1").drop("shared")


def neighbors(grid: DataFrame, kind: str = "equal_area") -> DataFrame:
    """cell_id, neighbor_id: the cells that share more than a point of their border, each pair both ways."""
    if kind in TRIANGLES:
        found = _triangle_neighbors(grid)
    elif kind in RINGS:
        found = _ring_neighbors(grid)
    else:
        found = voronoi(grid).select("cell_id", F.explode("neighbors").alias("neighbor_id"))
    both = found.union(found.select("neighbor_id", "cell_id").toDF("cell_id", "neighbor_id"))
    return both.where("cell_id <> neighbor_id").distinct()


def _clipped(centre: np.ndarray, others: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Corners (unit vectors, in order) of the part of the upper half sphere that is nearer to ``centre`` than to ``others``, and the id beyond each side.

    On the plane that touches the sphere in the centre, every bisector and the
    horizon are straight lines, so a square is cut by one half-plane after another.
    A side on the horizon has id -1, on the square -2.
    """
    east = np.cross([0.0, 1.0, 0.0] if abs(centre[2]) > 0.9 else [0.0, 0.0, 1.0], centre)
    east /= np.linalg.norm(east)
    axes = np.stack([east, np.cross(centre, east)])
    far = 50.0
    corners, sides = np.array([(-far, -far), (far, -far), (far, far), (-far, far)]), [-2] * 4
    normals = np.concatenate([[[0.0, 0.0, 1.0]], centre - others])
    for normal, beyond in zip(normals, [-1, *ids.tolist()], strict=True):
        inside = normal @ centre + corners @ (axes @ normal)
        if (inside >= 0).all():
            continue
        cut, kept = [], []
        for i in range(len(corners)):
            j = (i + 1) % len(corners)
            if inside[i] >= 0:
                cut.append(corners[i])
                kept.append(sides[i])
            if (inside[i] >= 0) != (inside[j] >= 0):
                cut.append(corners[i] + (corners[j] - corners[i]) * (inside[i] / (inside[i] - inside[j])))
                # leaving the half-plane, the new side begins; coming back, the old one goes on
                kept.append(beyond if inside[i] >= 0 else sides[i])
        corners, sides = np.array(cut), kept
    points = centre + corners @ axes
    return points / np.linalg.norm(points, axis=1, keepdims=True), sides


def spherical_area(centre: np.ndarray, corners: np.ndarray) -> float:
    """Steradians of a convex polygon around ``centre``, as triangles from there."""
    a, b = corners, np.roll(corners, -1, axis=0)
    triple = np.einsum("j,ij->i", centre, np.cross(a, b))
    return float(2 * np.arctan2(triple, 1 + a @ centre + b @ centre + np.einsum("ij,ij->i", a, b)).sum())


_VORONOI = "cell_id long, solid_angle double, phi_min double, phi_max double, theta_min double, theta_max double, vertices array<struct<x:double,y:double,z:double>>, neighbors array<long>, proven boolean"


def _voronoi(batches: Iterator[pa.RecordBatch], reach: float, everything: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            centre = np.array([row["x"], row["y"], row["z"]])
            near = sorted(((o["x"], o["y"], o["z"]), o["id"]) for o in row["near"] if o["id"] != row["cell_id"])
            points, ids = np.array([p for p, _ in near]).reshape(-1, 3), np.array([i for _, i in near], np.int64)
            order = np.argsort(((points - centre) ** 2).sum(1), kind="stable")
            corners, sides = _clipped(centre, points[order], ids[order])
            # a centre further away than twice the farthest corner can't cut the cell
            widest = float(np.sqrt(((corners - centre) ** 2).sum(1)).max())
            length = np.sqrt(((corners - np.roll(corners, -1, axis=0)) ** 2).sum(1))
            theta, phi = _thetas(corners), np.arctan2(corners[:, 1], corners[:, 0]) % TWO_PI
            around = np.sort(phi)
            gaps = np.diff(np.append(around, around[0] + TWO_PI))
            zenith = gaps.max() < math.pi and spherical_area(centre, corners) > 0 and _holds_zenith(corners)
            k = int(gaps.argmax())
            low, high = (0.0, TWO_PI) if zenith else (around[(k + 1) % len(around)], around[k])
            out.append(
                {
                    "cell_id": row["cell_id"],
                    "solid_angle": spherical_area(centre, corners),
                    "phi_min": low,
                    "phi_max": high,
                    "theta_min": 0.0 if zenith else float(theta.min()),
                    "theta_max": float(theta.max()),
                    "vertices": [{"x": x, "y": y, "z": z} for x, y, z in corners.tolist()],
                    "neighbors": sorted({s for s, n in zip(sides, length.tolist(), strict=True) if s >= 0 and n > CLOSE}),
                    "proven": -2 not in sides and (everything or 2 * widest <= reach),
                }
            )
        kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
        corner = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())]))
        yield pa.RecordBatch.from_pylist(out, pa.schema([(n, kinds.get(k, corner)) for n, k in (f.split(" ") for f in _VORONOI.split(", "))]))


def _thetas(corners: np.ndarray) -> np.ndarray:
    """Zenith angles of the corners, and of the highest and lowest points of those sides that have one between their ends."""
    a, b = corners, np.roll(corners, -1, axis=0)
    normal = np.cross(a, b)
    size = np.linalg.norm(normal, axis=1)
    a, b, normal = a[size > 1e-12], b[size > 1e-12], normal[size > 1e-12] / size[size > 1e-12, None]
    top = np.array([0.0, 0.0, 1.0]) - normal[:, 2:] * normal
    between = lambda h: (np.einsum("ij,ij->i", np.cross(a, h), normal) > 0) & (np.einsum("ij,ij->i", np.cross(h, b), normal) > 0)
    height = np.linalg.norm(top, axis=1)
    z = np.concatenate([corners[:, 2], height[between(top)], -height[between(-top)]])
    return np.arccos(np.clip(z, -1, 1))


def _holds_zenith(corners: np.ndarray) -> bool:
    """Whether the zenith lies on the inner side of every side."""
    return bool((np.cross(corners, np.roll(corners, -1, axis=0))[:, 2] > 0).all())


def voronoi(grid: DataFrame, reach: float | None = None) -> DataFrame:
    """The part of the half sphere that is nearest to each centre: cell_id, solid_angle, bounds, vertices, neighbors.

    A cell's centre meets the centres of the voxels around it, of edge
    ``reach``, and is cut by their bisectors. Where a corner lies so far away
    that a centre beyond those voxels could cut it too, the cell is done again
    with twice the reach. A cell around the north azimuth has phi_min > phi_max.
    A grid of so few cells that one reaches 89 degrees is an error.
    """
    n = grid.count()
    reach = reach or 5 * math.sqrt(TWO_PI / max(1, n))
    axes = ("x", "y", "z")
    points = grid.select("cell_id", *[c.alias(a) for a, c in zip(axes, grids.unit_vector(F.col("phi"), F.col("theta")), strict=True)])
    done, todo = None, points
    while True:
        everything = reach >= 2
        voxel = lambda d: F.array(*[F.floor(F.col(a) / reach) + k for a, k in zip(axes, d, strict=True)])  # noqa: E731, B023
        around = F.explode(F.array(*[voxel((i, j, k)) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
        lists = points.select(around.alias("voxel"), F.struct(F.col("cell_id").alias("id"), *axes).alias("o")).groupBy("voxel").agg(F.collect_list("o").alias("near"))
        met = todo.withColumn("voxel", voxel((0, 0, 0))).join(lists, "voxel").drop("voxel")
        if everything:
            met = todo.crossJoin(points.agg(F.collect_list(F.struct(F.col("cell_id").alias("id"), *axes)).alias("near")))
        found = met.mapInArrow(lambda b, r=reach, e=everything: _voronoi(b, r, e), _VORONOI)
        if everything:
            if not found.where("not proven").isEmpty():
                raise ValueError("the grid is too coarse: a cell reaches 89 degrees from its centre")
            return (done.unionByName(found) if done is not None else found).drop("proven")
        good = found.where("proven")
        done = good if done is None else done.unionByName(good)
        todo = todo.join(found.where("not proven").select("cell_id"), "cell_id", "left_semi")
        if todo.isEmpty():
            return done.drop("proven")
        reach *= 2


def vertices(grid: DataFrame, kind: str = "equal_area") -> DataFrame:
    """cell_id, place, x, y, z: the corners of each cell in order. A cell with all azimuths has no corners."""
    if kind in TRIANGLES:
        each = grid.select("cell_id", F.posexplode("vertices").alias("place", "v"))
        return each.select("cell_id", "place", "v.x", "v.y", "v.z")
    if kind in POINTS:
        each = voronoi(grid).select("cell_id", F.posexplode("vertices").alias("place", "v"))
        return each.select("cell_id", "place", "v.x", "v.y", "v.z")
    whole = F.pmod(F.col("phi_max") - F.col("phi_min") + CLOSE, F.lit(TWO_PI)) < 2 * CLOSE
    corners = [("phi_min", "theta_min"), ("phi_max", "theta_min"), ("phi_max", "theta_max"), ("phi_min", "theta_max")]
    points = F.array(*[F.struct(*[c.alias(a) for a, c in zip("xyz", grids.unit_vector(F.col(p), F.col(t)), strict=True)]) for p, t in corners])
    return grid.where(~whole).select("cell_id", F.posexplode(points).alias("place", "v")).select("cell_id", "place", "v.x", "v.y", "v.z")


# --- digest and integrity --------------------------------------------------


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, value, first = 0, 0, None
    for batch in batches:
        for key, print_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            first = key if first is None else first
            value = (value * BASE + int(print_[:32], 16)) % MODULUS
            n += 1
    yield pa.RecordBatch.from_pylist([{"first": first, "n": n, "value": f"{value:032x}"}] if n else [], pa.schema([("first", pa.int64()), ("n", pa.int64()), ("value", pa.string())]))


def combined(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    """Count and value of the rows of ``a`` followed by those of ``b``."""
    return a[0] + b[0], (a[1] * pow(BASE, b[0], MODULUS) + b[1]) % MODULUS


def digest(rows: DataFrame, key: str = "cell_id") -> str:
    """Count and digest of ``rows`` in order of the whole-numbered, unique ``key``.

    A polynomial in the rows' own prints: every key range gives its value by
    itself, and the ranges' values combine to that of the whole, so the digest
    doesn't depend on how rows are dealt. One short row per range reaches the driver.
    """
    names = sorted(c for c in rows.columns if c != key)
    # the text of a double has all its bits
    shown = [F.coalesce(F.to_json(F.struct(F.col(c).alias("v"))), F.lit("null")) for c in names]
    prints = rows.select(F.col(key).cast("long").alias("key"), F.sha2(F.concat_ws("\n", F.col(key).cast("string"), *shown), 256).alias("print"))
    parts = prints.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_ranges, "first long, n long, value string")
    total = (0, 0)
    for x in sorted(parts.collect(), key=lambda x: x.first):
        total = combined(total, (x.n, int(x.value, 16)))
    return f"{total[0]}:{total[1]:032x}"


def integrity(grid: DataFrame, beside: DataFrame, angles: DataFrame) -> DataFrame:
    """One row of booleans, a column per rule: ids dense and unique, angles and bounds in range, solid angles positive and not more than the half sphere, neighbours known, mutual and of every cell."""
    cells = grid.agg(
        (F.count(F.lit(1)) == F.count_distinct("cell_id")).alias("unique_ids"),
        ((F.min("cell_id") == 0) & (F.max("cell_id") == F.count(F.lit(1)) - 1)).alias("dense_ids"),
        F.bool_and(F.col("phi").between(0, TWO_PI) & F.col("theta").between(0, math.pi / 2 + CLOSE)).alias("angles"),
        F.bool_and(F.coalesce((F.col("theta_min") <= F.col("theta")) & (F.col("theta") <= F.col("theta_max")), F.lit(True))).alias("bounds"),
    )
    areas = angles.agg(F.bool_and(F.col("weight") > 0).alias("positive_areas"), (F.sum("weight") <= TWO_PI + 1e-6).alias("areas_fit"))
    back = beside.select(F.col("neighbor_id").alias("cell_id"), F.col("cell_id").alias("neighbor_id"))
    one_way = beside.join(back, ["cell_id", "neighbor_id"], "left_anti").agg((F.count(F.lit(1)) == 0).alias("mutual_neighbors"))
    unknown = beside.join(grid.select(F.col("cell_id").alias("neighbor_id")), "neighbor_id", "left_anti").agg((F.count(F.lit(1)) == 0).alias("known_neighbors"))
    alone = grid.join(beside, "cell_id", "left_anti").agg((F.count(F.lit(1)) == 0).alias("no_cell_alone"))
    # one row each
    for other in (areas, one_way, unknown, alone):
        cells = cells.crossJoin(other)
    return cells


# --- stored grids ----------------------------------------------------------


@dataclass
class StoredGrid:
    """A grid with its tables, as ``load_grid`` finds them."""

    kind: str
    cells: DataFrame
    neighbors: DataFrame
    vertices: DataFrame
    digest: str

    def query_points(self, points: DataFrame, reach: float) -> DataFrame:
        """``points`` (phi, theta) with the cell of the nearest centre."""
        return grids.assign_cells(points, self.cells, reach)

    def cell_neighbors(self, cell_id: int) -> DataFrame:
        return self.neighbors.where(F.col("cell_id") == cell_id).select("neighbor_id")

    def cell_vertices(self, cell_id: int) -> DataFrame:
        return self.vertices.where(F.col("cell_id") == cell_id).select("place", "x", "y", "z")

    def cell_boundaries(self, cell_id: int) -> DataFrame:
        return self.cells.where(F.col("cell_id") == cell_id).select("phi_min", "phi_max", "theta_min", "theta_max")


def write_grid(spark: SparkSession, grid: DataFrame, kind: str, path: str) -> str:
    """Cells, neighbours and vertices of a grid below ``path``, with its digest, which is returned. Fibonacci cells get the bounds of their Voronoi cells."""
    if kind == "fibonacci":
        shape = voronoi(grid).select("cell_id", "solid_angle", "phi_min", "phi_max", "theta_min", "theta_max")
        grid = grid.drop("phi_min", "phi_max", "theta_min", "theta_max").join(shape, "cell_id")
    grid.write.mode("overwrite").parquet(f"{path}/cells")
    cells = spark.read.parquet(f"{path}/cells")
    neighbors(cells, kind).write.mode("overwrite").parquet(f"{path}/neighbors")
    vertices(cells, kind).write.mode("overwrite").parquet(f"{path}/vertices")
    found = digest(cells)
    spark.createDataFrame([(kind, found)], "kind string, digest string").write.mode("overwrite").parquet(f"{path}/about")
    return found


def load_grid(spark: SparkSession, path: str, check: bool = True) -> StoredGrid:
    """The grid below ``path``; with ``check``, an error if its cells no longer have the digest that was written."""
    about = spark.read.parquet(f"{path}/about").first()
    cells, beside, corners = (spark.read.parquet(f"{path}/{t}") for t in ("cells", "neighbors", "vertices"))
    if check and digest(cells) != about.digest:
        raise ValueError(f"the cells of {path} have changed since they were written")
    return StoredGrid(about.kind, cells, beside, corners, about.digest)
