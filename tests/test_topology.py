"""Neighbours, Voronoi cells and digests of grids against plain geometry."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafray.operators import grids, topology, weights

SIZES = {"equal_area": {"degrees": 12.0}, "equal_angle": {"degrees": 15.0}, "equirectangular": {"degrees": 15.0}, "geodesic": {"degrees": 20.0}, "htm": {"degrees": 20.0}, "fibonacci": {"points": 150}}


def shape(spark, kind, **more):
    grid = grids.create(spark, kind, **SIZES[kind], **more)
    return grid, {(x.cell_id, x.neighbor_id) for x in topology.neighbors(grid, kind).collect()}


def ring_pairs(cells):
    """All pairs of cells whose borders share more than a point."""
    turn, out = 2 * math.pi, set()
    covers = lambda c, phi: (phi - c.phi_min) % turn < ((c.phi_max - c.phi_min) % turn or turn)
    for a in cells:
        for b in cells:
            if a.cell_id == b.cell_id:
                continue
            apart = lambda x, y: min((x - y) % turn, (y - x) % turn)
            if abs(a.theta_min - b.theta_min) < 1e-9:
                touch = apart(a.phi_max, b.phi_min) < 1e-9 or apart(a.phi_min, b.phi_max) < 1e-9
            elif abs(a.theta_max - b.theta_min) < 1e-9 or abs(b.theta_max - a.theta_min) < 1e-9:
                touch = covers(a, b.phi_min + 1e-7) or covers(b, a.phi_min + 1e-7)
            else:
                touch = False
            if touch:
                out.add((a.cell_id, b.cell_id))
    return out


@pytest.mark.parametrize(("kind", "turn"), [("equal_area", 0.0), ("equal_area", 33.0), ("equal_angle", 0.0), ("equirectangular", 0.0)])
def test_neighbors_of_rings(spark, kind, turn):
    grid, found = shape(spark, kind, rotation_degrees=turn)
    assert found == ring_pairs(grid.collect())


@pytest.mark.parametrize("kind", ["geodesic", "htm"])
def test_neighbors_of_triangles(spark, kind):
    grid, found = shape(spark, kind)
    corners = {x.cell_id: np.array([tuple(v) for v in x.vertices]) for x in grid.collect()}
    same = lambda a, b: sum(np.abs(p - q).max() < 1e-9 for p in a for q in b)
    assert found == {(a, b) for a in corners for b in corners if a != b and same(corners[a], corners[b]) == 2}


@pytest.mark.parametrize("kind", sorted(SIZES))
def test_integrity(spark, kind):
    grid, _ = shape(spark, kind)
    rules = topology.integrity(grid, topology.neighbors(grid, kind), weights.area(grid, kind)).first().asDict()
    # triangles on the horizon reach below it, and so do centres of some
    assert [k for k, v in rules.items() if not v] == (["angles", "areas_fit"] if kind in topology.TRIANGLES else [])
    broken = topology.integrity(grid.where("cell_id <> 3"), topology.neighbors(grid, kind).where("cell_id > 1"), weights.area(grid, kind).withColumn("weight", -F.col("weight"))).first()
    assert not any((broken.dense_ids, broken.mutual_neighbors, broken.known_neighbors, broken.no_cell_alone, broken.positive_areas))


@pytest.mark.parametrize("points", [4, 30, 1500])
def test_voronoi_cells_fill_the_half_sphere(spark, points):
    cells = topology.voronoi(grids.fibonacci(spark, points)).collect()
    assert len(cells) == points and abs(sum(x.solid_angle for x in cells) - 2 * math.pi) < 1e-9
    beside = {x.cell_id: set(x.neighbors) for x in cells}
    assert all(a in beside[b] for a, bs in beside.items() for b in bs) and all(beside.values())


def test_too_coarse(spark):
    with pytest.raises(ValueError):
        topology.voronoi(grids.fibonacci(spark, 1))


def test_voronoi_cells_by_sampling(spark):
    """A direction lies in the bounds of the cell of its nearest centre, and the shares of many directions are the solid angles."""
    grid = grids.fibonacci(spark, 60)
    centres = np.array([(math.sin(x.theta) * math.cos(x.phi), math.sin(x.theta) * math.sin(x.phi), math.cos(x.theta)) for x in grid.orderBy("cell_id").collect()])
    cells = {x.cell_id: x for x in topology.voronoi(grid, reach=0.2).collect()}
    r = np.random.default_rng(1)
    v = r.normal(size=(200_000, 3))
    v[:, 2] = np.abs(v[:, 2])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    nearest = (v @ centres.T).argmax(1)
    share = np.bincount(nearest, minlength=60) / len(v) * 2 * math.pi
    assert all(abs(cells[i].solid_angle - share[i]) < 0.01 for i in range(60))
    for direction, i in zip(v[:500], nearest[:500]):
        c, theta, phi = cells[i], math.acos(direction[2]), math.atan2(direction[1], direction[0]) % (2 * math.pi)
        assert theta <= c.theta_max + 0.02 and theta >= c.theta_min - 0.02
        assert (phi - c.phi_min + 0.02) % (2 * math.pi) <= ((c.phi_max - c.phi_min) % (2 * math.pi) or 2 * math.pi) + 0.04


def test_digest_does_not_depend_on_partitions(spark):
    grid = grids.equal_area(spark, 12.0)
    want = topology.digest(grid)
    whole, n = 0, 0
    assert want.split(":")[0] == str(grid.count())
    for parts in (1, 3, 17):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert topology.digest(grid.repartition(5).orderBy(F.rand(parts))) == want
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    change = F.when(F.col("cell_id") == 7, F.col("phi") + 1e-15).otherwise(F.col("phi"))
    assert topology.digest(grid.withColumn("phi", change)) != want
    swapped = grid.withColumn("cell_id", F.when(F.col("cell_id") == 7, 8).when(F.col("cell_id") == 8, 7).otherwise(F.col("cell_id")))
    assert topology.digest(swapped) != want
    a, b, c = ((3, 11), (2, 7), (4, 5))
    assert topology.combined(topology.combined(a, b), c) == topology.combined(a, topology.combined(b, c))


def test_stored_grid(spark, tmp_path):
    path = str(tmp_path / "grid")
    topology.write_grid(spark, grids.fibonacci(spark, 80), "fibonacci", path)
    g = topology.load_grid(spark, path)
    assert g.kind == "fibonacci" and abs(g.cells.agg(F.sum("solid_angle")).first()[0] - 2 * math.pi) < 1e-9
    assert g.cells.where("phi_min is null").count() == 0
    near = {x.neighbor_id for x in g.cell_neighbors(5).collect()}
    assert near and all(g.cell_neighbors(i).where("neighbor_id = 5").count() == 1 for i in near)
    assert g.cell_vertices(5).count() >= 3 and g.cell_boundaries(5).count() == 1
    assert g.query_points(g.cells.select("phi", "theta", F.col("cell_id").alias("own")), 0.5).where("own <> cell_id").count() == 0
    g.cells.limit(79).write.mode("overwrite").parquet(f"{path}/more")
    spark.read.parquet(f"{path}/more").write.mode("overwrite").parquet(f"{path}/cells")
    with pytest.raises(ValueError):
        topology.load_grid(spark, path)
