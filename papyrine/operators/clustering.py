"""Dimension reduction and density clusters."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.operators.ranking import total_order_index
from papyrine.operators.sizing import broadcast_if_small, fits
from papyrine.session import stage, store

DRIVER_EDGES = 200_000
"""Edges of which the driver finds the components at once; of more, fewer are made in rounds."""

LOOK = 64
"""Points of a cell that are looked at one by one where its box does not decide; a cell of more is cut into smaller ones."""


def reduce_dimensions(df: DataFrame, vector: str, dimensions: int, prefix: str = "pc") -> DataFrame:
    """Principal components ``pc1`` .. as columns: a linear stand-in for manifold methods."""
    prepared = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    model = PCA(k=dimensions, inputCol="_v", outputCol="_pc").fit(prepared)
    reduced = model.transform(prepared).withColumn("_pc", vector_to_array("_pc"))
    columns = {f"{prefix}{i + 1}": F.col("_pc")[i] for i in range(dimensions)}
    return reduced.withColumns(columns).drop("_v", "_pc", vector)


def _components_at_once(edges: pa.Table) -> pa.Table:
    """``node, label`` of the nodes that are not the smallest of their component."""
    up: dict = {}

    def root(a):
        top = a
        while top in up:
            top = up[top]
        while a != top:
            up[a], a = top, up[a]
        return top

    for a, b in zip(*(edges[c].to_pylist() for c in ("src", "dst")), strict=True):
        low, high = sorted((root(a), root(b)))
        if low != high:
            up[high] = low
    nodes, kind = list(up), edges.schema.field("src").type
    return pa.table({"node": pa.array(nodes, kind), "label": pa.array([root(a) for a in nodes], kind)})


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, label``: the smallest node of each component. ``edges`` (src, dst) hold both directions; pass a staged frame.

    Up to ``DRIVER_EDGES`` edges, measured, are joined on the driver, with two jobs. Of more, a round points every node to its
    smallest neighbour, if that is smaller, follows the pointers to their end, and goes on with the edges between these ends:
    half of the nodes that have edges at most.
    """
    once = edges.filter("src < dst")
    if fits(once, DRIVER_EDGES):
        found = edges.sparkSession.createDataFrame(_components_at_once(once.select("src", "dst").toArrow()))
        return nodes.select("node").join(found, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    if not max_rounds:
        raise RuntimeError("components not settled after all rounds")
    around = edges.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("_near"))
    # Of a checkpoint the planner keeps the estimated size, the product of what was joined: its digits would double with
    # every step until planning takes minutes. Of files it knows the size.
    labels = store(nodes.join(around, "node", "left").select("node", F.least("node", "_near").alias("label")), "labels")
    while True:
        hop = labels.select(F.col("node").alias("_at"), F.col("label").alias("_next"))
        moved = (F.col("_next") != F.col("label")).alias("_moved")
        met = store(labels.join(hop, F.col("label") == F.col("_at")).select("node", F.col("_next").alias("label"), moved), "labels")
        labels = met.select("node", "label")
        if met.filter("_moved").isEmpty():
            break
    ends = edges.select("src", "dst")
    for end in ends.columns:
        of_end = labels.select(F.col("node").alias(end), F.col("label").alias("_end"))
        ends = ends.join(of_end, end).drop(end).withColumnRenamed("_end", end)
    ends = store(ends.filter("src != dst").distinct(), "edges")
    rest = connected_components(labels.select(F.col("label").alias("node")).distinct(), ends, max_rounds - 1)
    rest = rest.select(F.col("node").alias("_at"), F.col("label").alias("_next"))
    return labels.join(rest, F.col("label") == F.col("_at")).select("node", F.col("_next").alias("label"))


def _apart(axes: int, lo, hi, other_lo, other_hi) -> list[Column]:
    # One expression per axis: functions of whole arrays would not be compiled.
    return [F.greatest(lo[i] - other_hi[i], other_lo[i] - hi[i]) for i in range(axes)]


def _gap(axes: int, lo, hi, other_lo, other_hi) -> Column:
    """Squared distance of two boxes at their nearest."""
    sides = [F.greatest(x, F.lit(0.0)) for x in _apart(axes, lo, hi, other_lo, other_hi)]
    return sum((x * x for x in sides), F.lit(0.0))


def _reach(axes: int, lo, hi, other_lo, other_hi) -> Column:
    """Squared distance of two boxes at their farthest."""
    return sum((x * x for x in _apart(axes, hi, lo, other_hi, other_lo)), F.lit(0.0))


class _Boxes:
    """Points (x: array of coordinates, n: rows that lie there, low: smallest id) in cells that are cut level by level.

    A cell is known by its integer coordinates, and carries the box around its points, their number ``m`` and their rows
    ``n``. A cell is cut into up to 64 of the next level (32 in five dimensions).
    """

    def __init__(self, points: DataFrame, side: float, axes: int) -> None:
        self.points, self.side, self.axes, self.levels = points, side, axes, {}
        self.step = max(1, 6 // axes)

    @staticmethod
    def cell(x: Column, side: float) -> Column:
        return F.transform(x, lambda v: F.floor(v / side))

    def at(self, k: int, x: str = "x") -> Column:
        """The cell of level ``k`` that holds the point."""
        return self.cell(F.col(x), self.side / 2 ** (k * self.step))

    def level(self, k: int) -> DataFrame:
        """up (cell of the level before), cell, lo, hi, n, m."""
        if k not in self.levels:
            self.levels[k] = stage(self._made(k))
        return self.levels[k]

    def numbered(self) -> DataFrame:
        """The first level and no, numbers in the order of the cells."""
        return stage(self._made(0).orderBy("cell").withColumn("no", F.monotonically_increasing_id()))

    def _made(self, k: int) -> DataFrame:
        up, own = self.at(max(k - 1, 0)).alias("up"), self.at(k).alias("cell")
        lo, hi = (F.array(*[f(F.col("x")[i]) for i in range(self.axes)]) for f in (F.min, F.max))
        made = self.points.select(up, own, "x", "n").groupBy("up", "cell")
        return made.agg(lo.alias("lo"), hi.alias("hi"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("m"))


def _around(cell: Column, axes: int) -> Column:
    """The cell and those that touch it."""
    # Step number i in base three, digit by digit.
    digit = lambda i, j: F.floor(i / F.pow(F.lit(3.0), j)) % 3
    steps = F.sequence(F.lit(0), F.lit(3**axes - 1))
    return F.transform(steps, lambda i: F.transform(cell, lambda v, j: v + digit(i, j) - 1))


def _blocks(cells: DataFrame, axes: int, side: float, held: tuple[str, ...], *more: Column) -> DataFrame:
    """block, lo, hi, cells, more: the box around the ``cells`` of each block, and ``held`` of each of them.

    A cell is in the block of its lowest corner. Blocks are little wider than cells, so they hold few.
    """
    lo, hi = (F.array(*[f(F.col(c)[i]) for i in range(axes)]) for f, c in ((F.min, "lo"), (F.max, "hi")))
    made = cells.groupBy(_Boxes.cell(F.col("lo"), side).alias("block"))
    return broadcast_if_small(stage(made.agg(lo.alias("lo"), hi.alias("hi"), F.collect_list(F.struct(*held)).alias("cells"), *more)))


def _surely_cores(lone: DataFrame, boxes: _Boxes, min_points: int) -> DataFrame:
    """own: halves of cells that hold a point of ``lone`` and, together with the halves that touch them, ``min_points`` rows.

    Along no axis are two points of these farther apart than the side of a cell. It tells most cores without the search.
    """
    half = _Boxes.cell(F.col("x"), boxes.side / 2)
    halves = stage(boxes.points.groupBy(half.alias("cell")).agg(F.sum("n").alias("n")))
    asked = lone.select(half.alias("own")).distinct().select("own", F.explode(_around(F.col("own"), boxes.axes)).alias("cell"))
    held = asked.join(broadcast_if_small(halves), "cell").groupBy("own").agg(F.sum("n").alias("n"))
    return held.filter(F.col("n") >= min_points).select("own")


def _near_cells(queries: DataFrame, boxes: _Boxes, eps: float) -> list[DataFrame]:
    """Of each level x, cell, n, within: the cells that hold a point within ``eps`` of the point x, or may do so.

    All points of a cell that is ``within`` are near x; of the others, which have up to ``LOOK`` points, some may be. Cells of
    more points that the sphere around x cuts are replaced by those of the next level. Nothing is paired but points with
    cells, and of these only those in blocks within reach.
    """
    far, axes = eps * eps, boxes.axes
    # A cell is looked for by its lowest corner, which is up to a side below its points.
    block = eps + boxes.side
    own, box = [F.col("x"), F.col("x")], [F.col("lo"), F.col("hi")]
    blocks = _blocks(boxes.level(0), axes, block, ("cell", "lo", "hi", "n", "m"))
    asked = queries.select("x", F.explode(_around(_Boxes.cell(F.col("x"), block), axes)).alias("block")).join(blocks, "block")
    asked = asked.filter(_gap(axes, *own, *box) <= far)
    open_, near = asked.select("x", F.explode("cells").alias("c")).select("x", "c.*"), []
    while True:
        found = open_.filter(_gap(axes, *own, *box) <= far).withColumn("within", _reach(axes, *own, *box) <= far)
        found = stage(found.select("x", "cell", "n", "within", (~F.col("within") & (F.col("m") > LOOK)).alias("many")))
        near.append(found.filter("not many").drop("many"))
        rest = found.filter("many").select("x", F.col("cell").alias("up"))
        if rest.isEmpty():
            return near
        open_ = rest.join(boxes.level(len(near)), "up")


def _near_points(near: list[DataFrame], boxes: _Boxes, points: DataFrame, eps: float) -> DataFrame:
    """The rows of ``near`` joined with those ``points`` (y, others) of their cells that are within ``eps`` of x, and d, their squared distance."""
    apart, met = _gap(boxes.axes, F.col("x"), F.col("x"), F.col("y"), F.col("y")), None
    for k, cells in enumerate(near):
        some = cells.join(points.withColumn("cell", boxes.at(k, "y")), "cell").withColumn("d", apart)
        some = some.filter(F.col("d") <= eps * eps)
        met = some if met is None else met.unionByName(some)
    return met


def _touching_cells(boxes: _Boxes, cells: DataFrame) -> DataFrame:
    """src, dst, both ways: numbers of first-level ``cells`` of which halves touch, so that their points are within ``eps``.

    Halves that touch share a cell of the grid, or of the grid moved by half a side along some axes. The cells that share
    one are linked to the first of them.
    """
    digit = lambda i, j: F.floor(i / F.pow(F.lit(2.0), j)) % 2
    shifts = F.sequence(F.lit(0), F.lit(2**boxes.axes - 1))
    shared = F.transform(shifts, lambda i: F.struct(i.alias("i"), F.transform(F.col("half"), lambda v, j: F.floor((v + digit(i, j)) / 2)).alias("at")))
    held = boxes.points.select(boxes.at(0).alias("cell"), _Boxes.cell(F.col("x"), boxes.side / 2).alias("half")).distinct()
    held = held.join(cells.select("cell", "no"), "cell").select("no", F.explode(shared).alias("shared"))
    # As many cells share one as it has halves.
    sharing = held.groupBy("shared").agg(F.sort_array(F.collect_set("no")).alias("nos")).filter("size(nos) > 1")
    pairs = sharing.select(F.col("nos")[0].alias("src"), F.explode(F.expr("slice(nos, 2, size(nos))")).alias("dst")).distinct()
    return _both_ways(pairs)


def _both_ways(pairs: DataFrame) -> DataFrame:
    ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return stage(pairs.select(F.explode(ends).alias("e")).select("e.*"))


def _linked_labels(boxes: _Boxes, wide: DataFrame, eps: float) -> DataFrame:
    """src, dst: pairs of labels of first-level cells of which two points are within ``eps`` of each other, src < dst.

    ``wide``: the cells and their labels. Cells of one label are never paired, nor looked at where a whole block has that
    label. Pairs that boxes do not decide are decided point by point where neither cell has over ``LOOK`` points, else cut.
    """
    far, axes, block = eps * eps, boxes.axes, eps + boxes.side
    names = ("no", "cell", "lo", "hi", "m", "label")
    blocks = _blocks(wide, axes, block, names, F.min("label").alias("least"), F.max("label").alias("most"))
    left = wide.select(*[F.col(c).alias(f"{c}_a") for c in names], F.explode(_around(_Boxes.cell(F.col("lo"), block), axes)).alias("block"))
    other = (F.col("least") != F.col("label_a")) | (F.col("most") != F.col("label_a"))
    near = left.join(blocks, "block").filter(other).filter(_gap(axes, F.col("lo_a"), F.col("hi_a"), F.col("lo"), F.col("hi")) <= far)
    paired = near.select(*[f"{c}_a" for c in names], F.explode("cells").alias("c"))
    paired = paired.select(*[f"{c}_a" for c in names], *[F.col(f"c.{c}").alias(f"{c}_b") for c in names])
    paired = paired.filter("no_a < no_b and label_a != label_b")
    pair, sides = [F.least("label_a", "label_b").alias("src"), F.greatest("label_a", "label_b").alias("dst")], ("cell", "lo", "hi", "m")
    open_, links, k = paired.select(*pair, *[f"{c}_{s}" for s in "ab" for c in sides]), None, 0
    while True:
        box = [F.col(c) for c in ("lo_a", "hi_a", "lo_b", "hi_b")]
        found = stage(open_.filter(_gap(axes, *box) <= far).withColumn("within", _reach(axes, *box) <= far))
        done = found.filter("within").select("src", "dst").distinct()
        rest = found.filter("not within").join(done, ["src", "dst"], "left_anti")
        point = boxes.points.select(F.col("x").alias("x_a"), boxes.at(k).alias("cell_a"))
        looked = rest.filter((F.col("m_a") <= LOOK) & (F.col("m_b") <= LOOK)).join(point, "cell_a")
        looked = looked.filter(_gap(axes, F.col("x_a"), F.col("x_a"), F.col("lo_b"), F.col("hi_b")) <= far)
        looked = looked.join(point.withColumnsRenamed({"x_a": "x_b", "cell_a": "cell_b"}), "cell_b")
        met = looked.filter(_gap(axes, *[F.col(c) for c in ("x_a", "x_a", "x_b", "x_b")]) <= far).select("src", "dst")
        done = stage(done.unionByName(met).distinct())
        links = done if links is None else links.unionByName(done)
        rest = found.filter(~F.col("within") & ((F.col("m_a") > LOOK) | (F.col("m_b") > LOOK)))
        if rest.isEmpty():
            return links
        k += 1
        rest = rest.join(done, ["src", "dst"], "left_anti").select("src", "dst", "cell_a", "cell_b")
        for s in "ab":
            own = boxes.level(k).select(F.col("up").alias(f"cell_{s}"), *[F.col(c).alias(f"new_{c}") for c in sides])
            rest = rest.join(own, f"cell_{s}").drop(f"cell_{s}")
            rest = rest.withColumnsRenamed({f"new_{c}": f"{c}_{s}" for c in sides})
        open_ = rest


def density_clusters(
    df: DataFrame, id_col: str, coordinates: list[str], eps: float, min_size: int = 15, min_points: int = 5
) -> DataFrame:
    """``id, cluster``: 0-based by descending size (then smallest core id), -1 for noise.

    A point with at least ``min_points`` rows within ``eps``, its own included, is a core. Cores within ``eps`` of each other
    are in one cluster; another point belongs to the cluster of its nearest core within ``eps`` (of equally near ones that
    with the smallest id), else it is noise, as are clusters of fewer than ``min_size`` rows and rows with a null or NaN
    coordinate.

    Equal points are one point with a count. Cells are so small that all their points are within ``eps``: the points of a cell
    with ``min_points`` rows are cores without a look at others, and cores of one cell are in one cluster. Halves of cells that
    touch are within ``eps`` too: they tell most other cores, and link most cells. All else is decided between points and
    cells, or cells of clusters not linked yet, by the boxes around their points; where boxes do not decide, the few points of
    a cell are looked at, and a cell of more than a few is cut. So a cell may hold any share of the rows.
    """
    axes = len(coordinates)
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in coordinates]
    placed = df.select(id_col, F.array(*[v + F.lit(0.0) for v in values]).alias("x"))
    placed = placed.withColumn("x", F.when(~F.exists("x", lambda v: v.isNull()), F.col("x")))
    points = placed.filter("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("low"))
    # A little below eps / sqrt(axes): rounding must not part two points of a cell.
    boxes = _Boxes(stage(points), eps / math.sqrt(axes) * (1 - 1e-9), axes)
    crowded = boxes.level(0).select("cell", (F.col("n") >= min_points).alias("crowded"))
    known = boxes.points.withColumn("cell", boxes.at(0)).join(crowded, "cell")
    sure = _surely_cores(known.filter("not crowded"), boxes, min_points).withColumn("sure", F.lit(True))
    known = known.withColumn("own", _Boxes.cell(F.col("x"), boxes.side / 2)).join(sure, "own", "left")
    known = stage(known.select("x", "n", "low", "cell", (F.col("crowded") | F.coalesce("sure", F.lit(False))).alias("sure")))
    near = _near_cells(known.filter("not sure"), boxes, eps)
    rows = [c.filter("within").select("x", "n") for c in near]
    enough = lambda n: n.groupBy("x").agg(F.sum("n").alias("around")).filter(F.col("around") >= min_points).select("x")
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more)
    asked = [c.filter("not within").drop("n").join(enough(whole), "x", "left_anti") for c in near]
    some = _near_points(asked, boxes, boxes.points.select(F.col("x").alias("y"), "n"), eps)
    counted = enough(whole.unionByName(some.select("x", "n"))).withColumn("counted", F.lit(True))
    known = known.join(counted, "x", "left")
    known = stage(known.select("x", "n", "low", "cell", (F.col("sure") | F.coalesce("counted", F.lit(False))).alias("core")))
    cores, edge = known.filter("core"), known.filter("not core").select("x", F.col("n").alias("rows"))
    core_boxes = _Boxes(cores.select("x", "n", "low"), boxes.side, axes)
    cells = core_boxes.numbered()
    near_labels = connected_components(cells.select(F.col("no").alias("node")), _touching_cells(core_boxes, cells))
    wide = stage(cells.join(near_labels, F.col("no") == F.col("node")).select("no", "cell", "lo", "hi", "m", "label"))
    links = _both_ways(_linked_labels(core_boxes, wide, eps).distinct())
    joined = stage(connected_components(wide.select(F.col("label").alias("node")).distinct(), links))
    # Most cells have one label: broadcasts leave them where they are.
    joined = broadcast_if_small(joined.select(F.col("node").alias("of"), "label"))
    labels = wide.select("cell", F.col("label").alias("of")).join(joined, "of").select("cell", "label")
    labelled = stage(cores.join(labels, "cell").select("x", "n", "low", "label"))
    # A point that is no core has fewer than min_points rows within eps: that many cores at most.
    reached = [c.select("x", "cell").join(edge, "x") for c in near]
    reached = _near_points(reached, boxes, labelled.select(F.col("x").alias("y"), "low", "label"), eps)
    nearest = reached.groupBy("x").agg(F.min("rows").alias("n"), F.min(F.struct("d", "low", "label")).alias("best"))
    no_core = F.lit(None).cast(labelled.schema["low"].dataType).alias("low")
    member = stage(labelled.unionByName(nearest.select("x", "n", no_core, "best.label")))
    sized = member.groupBy("label").agg(F.sum("n").alias("size"), F.min("low").alias("low"))
    large = stage(sized.filter(F.col("size") >= min_size))
    numbered = total_order_index(large, [F.desc("size"), F.asc("low")], "cluster").select("label", "cluster")
    numbered = F.broadcast(numbered) if fits(large) else numbered
    of_point = stage(member.join(numbered, "label").select("x", "cluster"))
    return placed.join(broadcast_if_small(of_point), "x", "left").select(id_col, F.coalesce("cluster", F.lit(-1)).alias("cluster"))
