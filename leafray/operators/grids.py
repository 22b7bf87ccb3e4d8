"""Hemisphere grids and the join of observations to their nearest cell.

Angles are radians: theta from zenith, phi from north. Ring grids come from
Spark ranges; pixel and triangle grids of a few thousand cells are computed
with numpy. A grid's size depends on its resolution only.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.functions.columns import TWO_PI

#: Cells of a grid whose lists of near centres (about 1 kB a cell) may be broadcast.
BROADCAST_CELLS = 20_000

HALF_PI = math.pi / 2
COLUMNS = ["cell_id", "phi", "theta", "phi_min", "phi_max", "theta_min", "theta_max"]


def _rings(spark: SparkSession, inner: list[float], outer: list[float], counts: list[int], cap: float | None, cap_min: float = 0.0) -> DataFrame:
    """Cells of rings, numbered outwards after an optional zenith cell."""
    first, rows = (0 if cap is None else 1), []
    for a, b, n in zip(inner, outer, counts, strict=True):
        rows.append((first, a, b, n))
        first += n
    ring = spark.createDataFrame(rows, "first long, theta_min double, theta_max double, n int")
    span = F.lit(TWO_PI) / F.col("n")
    cells = ring.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    cells = cells.select(
        (F.col("first") + F.col("j")).alias("cell_id"),
        ((F.col("j") + 0.5) * span).alias("phi"),
        ((F.col("theta_min") + F.col("theta_max")) / 2).alias("theta"),
        (F.col("j") * span).alias("phi_min"),
        F.when(F.col("j") == F.col("n") - 1, F.lit(TWO_PI)).otherwise((F.col("j") + 1) * span).alias("phi_max"),
        "theta_min",
        "theta_max",
    )
    if cap is None:
        return cells
    zenith = spark.createDataFrame([(0, 0.0, 0.0, 0.0, TWO_PI, cap_min, cap)], cells.schema)
    return zenith.unionByName(cells)


def _edges(resolution: float, cutoff: float) -> list[float]:
    return np.arange(resolution / 2, HALF_PI - cutoff, resolution).tolist()


def equal_area(spark: SparkSession, degrees: float = 2.0, cutoff_degrees: float = 0.0) -> DataFrame:
    """Rings of cells about as large as the zenith cap; ring counts round halves to even."""
    r, cut = math.radians(degrees), math.radians(cutoff_degrees)
    e = _edges(r, cut)
    kept = [(a, b) for a, b in zip(e, e[1:]) if b > cut]
    counts = [max(1, round((math.cos(a) - math.cos(b)) / (1 - math.cos(r / 2)))) for a, b in kept]
    cap = r / 2 if cut < r / 2 else None
    return _rings(spark, [a for a, _ in kept], [b for _, b in kept], counts, cap, max(0.0, cut))


def equal_angle(spark: SparkSession, degrees: float = 2.0, cutoff_degrees: float = 0.0) -> DataFrame:
    """Rings with the same number of cells each, after a zenith cap."""
    r = math.radians(degrees)
    e = _edges(r, math.radians(cutoff_degrees))
    return _rings(spark, e[:-1], e[1:], [int(TWO_PI / r)] * (len(e) - 1), r / 2)


def equirectangular(spark: SparkSession, degrees: float = 2.0, cutoff_degrees: float = 0.0) -> DataFrame:
    """A rectangle of theta and phi steps. Whole steps only: no row below the horizon arises from rounding."""
    r, cut = math.radians(degrees), math.radians(cutoff_degrees)
    bands, steps = math.ceil((HALF_PI - cut) / r - 1e-9), math.ceil(TWO_PI / r - 1e-9)
    cells = spark.range(bands * steps).select(F.col("id").alias("cell_id"), F.floor(F.col("id") / steps).alias("i"), (F.col("id") % steps).alias("j"))
    return cells.select(
        "cell_id",
        ((F.col("j") + 0.5) * r).alias("phi"),
        (cut + (F.col("i") + 0.5) * r).alias("theta"),
        (F.col("j") * r).alias("phi_min"),
        F.least(F.lit(TWO_PI), (F.col("j") + 1) * r).alias("phi_max"),
        (cut + F.col("i") * r).alias("theta_min"),
        (cut + (F.col("i") + 1) * r).alias("theta_max"),
    )


def fibonacci(spark: SparkSession, points: int = 1000, cutoff_degrees: float = 0.0) -> DataFrame:
    """Golden-spiral points of a whole sphere of twice as many, kept above the cutoff; cells have no bounds."""
    n, golden = 2 * points, math.pi * (3 - math.sqrt(5))
    z = 1 - 2 * (F.col("id") + 0.5) / n
    p = spark.range(n).select("id", F.acos(z).alias("theta"), F.pmod(F.col("id") * golden, F.lit(TWO_PI)).alias("phi"))
    p = p.where(F.col("theta") <= HALF_PI - math.radians(cutoff_degrees))  # z falls with id, so ids stay dense
    none = F.lit(None).cast("double")
    return p.select(F.col("id").alias("cell_id"), "phi", "theta", *[none.alias(c) for c in COLUMNS[3:]])


def healpix(spark: SparkSession, degrees: float = 2.0, cutoff_degrees: float = 0.0) -> DataFrame:
    """Pixel centres in ring order of the equal-area pixelisation of Gorski et al. (2005), with bounds of one resolution.

    cell_id numbers the kept pixels densely; healpix_ipix is the pixel.
    """
    side = 2 ** max(0, round(math.log2(math.sqrt(3 / math.pi) * 60 / degrees)))
    pixels = np.arange(12 * side * side)
    cap = 2 * side * (side - 1)
    z, phi = np.empty(len(pixels)), np.empty(len(pixels))
    p = pixels[:cap]
    i = np.floor((1 + np.sqrt(1 + 2 * p)) / 2).astype(int)
    j = p + 1 - 2 * i * (i - 1)
    z[:cap], phi[:cap] = 1 - i**2 / (3 * side**2), (j - 0.5) * math.pi / (2 * i)
    belt = pixels[cap : len(pixels) - cap] - cap
    i, j = belt // (4 * side) + side, belt % (4 * side) + 1
    z[cap : len(pixels) - cap] = (2 * side - i) * 2 / (3 * side)
    phi[cap : len(pixels) - cap] = (j - ((i - side + 1) % 2) / 2) * math.pi / (2 * side)
    theta = np.arccos(np.clip(z[: len(pixels) - cap], -1, 1))
    kept = np.flatnonzero(theta <= HALF_PI - math.radians(cutoff_degrees) + 1e-12)
    half = math.sqrt(math.pi / (3 * side * side)) / 2
    rows = [
        (k, float(phi[q]), float(theta[q]), max(0.0, float(phi[q]) - half), min(TWO_PI, float(phi[q]) + half), max(0.0, float(theta[q]) - half), min(HALF_PI, float(theta[q]) + half), int(q), side)
        for k, q in enumerate(kept)
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'long' if c == 'cell_id' else 'double'}" for c in COLUMNS) + ", healpix_ipix long, healpix_nside int")


def _split(faces: np.ndarray) -> np.ndarray:
    """Each spherical triangle as four: three corners and the middle, in this order."""
    a, b, c = faces[:, 0], faces[:, 1], faces[:, 2]
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    ab, bc, ca = unit(a + b), unit(b + c), unit(c + a)
    return np.stack([np.stack(t, 1) for t in ((a, ab, ca), (b, bc, ab), (c, ca, bc), (ab, bc, ca))], 1)


def _triangles(spark: SparkSession, faces: np.ndarray, ids: list[int], level: int) -> DataFrame:
    rows = []
    for k, (f, name) in enumerate(zip(faces, ids, strict=True)):
        m = f.mean(axis=0)
        m /= np.linalg.norm(m)
        theta, phi = np.arccos(np.clip(f[:, 2], -1, 1)), np.arctan2(f[:, 0], f[:, 1]) % TWO_PI
        if phi.max() - phi.min() > math.pi:
            phi = np.where(phi < math.pi, phi + TWO_PI, phi)
        rows.append((k, float(np.arctan2(m[0], m[1]) % TWO_PI), float(np.arccos(m[2])), float(phi.min()), float(phi.max()), float(theta.min()), float(theta.max()), int(name), level, [tuple(map(float, v)) for v in f]))
    kinds = ", ".join(f"{c} {'long' if c == 'cell_id' else 'double'}" for c in COLUMNS)
    return spark.createDataFrame(rows, kinds + ", face_id long, level int, vertices array<struct<x:double,y:double,z:double>>")


def geodesic(spark: SparkSession, degrees: float = 5.0, cutoff_degrees: float = 0.0) -> DataFrame:
    """A subdivided icosahedron: faces with any vertex above the cutoff."""
    level = max(0, math.ceil(math.log2(63.4 / (2 * degrees))))
    g = (1 + math.sqrt(5)) / 2
    v = np.array([(s * 1.0, t * g, 0.0) for s in (-1, 1) for t in (-1, 1)] + [(0.0, s * 1.0, t * g) for s in (-1, 1) for t in (-1, 1)] + [(t * g, 0.0, s * 1.0) for s in (-1, 1) for t in (-1, 1)])
    near = [(a, b, c) for a in range(12) for b in range(a) for c in range(b) if all(abs(np.linalg.norm(v[p] - v[q]) - 2) < 1e-9 for p, q in ((a, b), (b, c), (a, c)))]
    faces = np.array([[v[i] / np.linalg.norm(v[i]) for i in f] for f in near])
    for _ in range(level):
        faces = _split(faces).reshape(-1, 3, 3)
    kept = (np.arccos(np.clip(faces[:, :, 2], -1, 1)) <= HALF_PI - math.radians(cutoff_degrees) + 1e-12).any(axis=1)
    return _triangles(spark, faces[kept], np.flatnonzero(kept).tolist(), level)


def htm(spark: SparkSession, degrees: float = 5.0, cutoff_degrees: float = 0.0) -> DataFrame:
    """A subdivided octahedron with hierarchical ids: a child's id is ten times its parent's plus its place; a face goes only if all of it lies below."""
    level = min(15, max(0, math.ceil(math.log2(90 / (2 * degrees)))))
    x, y, z = np.eye(3)
    faces = np.array([(a, b, s * z) for s in (1, -1) for a, b in ((x, y), (y, -x), (-x, -y), (-y, x))])
    ids = list(range(1, 9))
    for _ in range(level):
        faces = _split(faces).reshape(-1, 3, 3)
        ids = [10 * i + k for i in ids for k in range(4)]
    kept = (np.arccos(np.clip(faces[:, :, 2], -1, 1)) <= HALF_PI - math.radians(cutoff_degrees) + 1e-12).any(axis=1)
    return _triangles(spark, faces[kept], [i for i, k in zip(ids, kept, strict=True) if k], level)


BUILDERS = {"equal_area": equal_area, "equal_angle": equal_angle, "equirectangular": equirectangular, "fibonacci": fibonacci, "healpix": healpix, "geodesic": geodesic, "htm": htm}


def create(spark: SparkSession, kind: str = "equal_area", rotation_degrees: float = 0.0, **how) -> DataFrame:
    """A grid by name, turned about the zenith."""
    if kind not in BUILDERS:
        raise ValueError(f"unknown grid {kind!r}; known: {', '.join(sorted(BUILDERS))}")
    grid = BUILDERS[kind](spark, **how)
    if rotation_degrees:
        turn = math.radians(rotation_degrees)
        grid = grid.withColumns({c: F.pmod(F.col(c) + turn, F.lit(TWO_PI)) for c in ("phi", "phi_min", "phi_max")})
    return grid


def solid_angle(kind: str, cells: int | None = None) -> Column:
    """Steradians of a cell: of its bounds, of its triangle, or an equal share of the hemisphere."""
    if kind in ("geodesic", "htm"):
        v = [F.col("vertices")[i] for i in range(3)]
        dot = lambda a, b: a.x * b.x + a.y * b.y + a.z * b.z
        triple = v[0].x * (v[1].y * v[2].z - v[1].z * v[2].y) + v[0].y * (v[1].z * v[2].x - v[1].x * v[2].z) + v[0].z * (v[1].x * v[2].y - v[1].y * v[2].x)
        return 2 * F.atan2(F.abs(triple), 1 + dot(v[0], v[1]) + dot(v[1], v[2]) + dot(v[0], v[2]))
    if kind in ("healpix", "fibonacci"):
        return F.lit(TWO_PI) / F.lit(cells)
    return (F.col("phi_max") - F.col("phi_min")) * (F.cos("theta_min") - F.cos("theta_max"))


def unit_vector(phi: Column, theta: Column) -> list[Column]:
    return [F.sin(theta) * F.cos(phi), F.sin(theta) * F.sin(phi), F.cos(theta)]


def assign_cells(obs: DataFrame, grid: DataFrame, reach: float, name: str = "cell_id") -> DataFrame:
    """``obs`` with the id of the cell whose centre is nearest on the unit sphere; ties go to the smaller id.

    Unit vectors fall into voxels of edge ``reach`` (radians), which must be no
    smaller than the distance from any observed direction to its nearest
    centre. Each voxel lists the centres in it and in all that touch it, so an
    equi-join on the voxel brings every possible nearest centre to the row,
    which takes the nearest of the list. Of a grid of no more than
    BROADCAST_CELLS cells the lists are broadcast, and observations are not
    shuffled. Rows with missing angles, or with no centre within reach, have a
    null cell.
    """
    axes = ("x_", "y_", "z_")
    to_axes = dict(zip(axes, unit_vector(F.col("phi"), F.col("theta")), strict=True))
    centre = grid.select(F.col("cell_id").alias("near_"), *[c.alias(a) for a, c in to_axes.items()])
    around = [F.array(*[F.floor(F.col(a) / reach) + d for a, d in zip(axes, (i, j, k), strict=True)]) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
    lists = centre.select(F.explode(F.array(*around)).alias("voxel_"), F.struct("near_", *axes).alias("c_")).groupBy("voxel_").agg(F.collect_list("c_").alias("near_"))
    if grid.count() <= BROADCAST_CELLS:
        lists = F.broadcast(lists)
    known = obs.drop(name).withColumns(to_axes).withColumn("voxel_", F.array(*[F.floor(F.col(a) / reach) for a in axes]))
    far = lambda c: F.round(sum(((F.col(a) - c[a]) ** 2 for a in axes), F.lit(0.0)), 12)
    nearest = F.array_min(F.transform("near_", lambda c: F.struct(far(c).alias("d"), c["near_"].alias("cell"))))
    return known.join(lists, "voxel_", "left").withColumn(name, nearest["cell"]).drop("voxel_", "near_", *axes)
