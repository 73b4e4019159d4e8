"""Exact k nearest neighbours without all pairs.

The training rows are sorted along a space-filling curve over up to three of
their axes (one axis: plainly by value) and cut into blocks of ``ROWS``
consecutive rows, whatever their density; a block is described by its bounding
box, and boxes of ``FAN`` consecutive blocks by a common one, level by level.  A
query finds its own place on the curve in the same sort and looks at that block
and its two neighbours first: the k-th distance found there bounds the search.
Only queries whose ball reaches further go down the levels, to the boxes that
the ball touches, and compare with those blocks' rows.

The result is exact for Euclidean distance (ties by the training key).  Boxes
cover all dimensions, the curve only orders the rows.  The rows compared per
query depend on k, the dimension and the block size, not on the table's size,
as long as the data's own dimension is small; in many dimensions the balls
touch most boxes and the search degrades towards a scan, never beyond it.

Skew: equal training vectors are reduced to the k smallest keys each (more can
never be among the k nearest), equal queries are searched once, blocks hold
equally many rows, and all joins are equi-joins on a block or box, which AQE may
split.  Rows with a null, NaN or infinite component are no neighbours and have none.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faro.operators.ranking import materialize

ROWS = 128          # rows of a block
FAN = 32            # boxes under one box of the next level; the top level has at most as many
AXES = 3            # axes of the curve
SLABS = 512         # ranges an axis is cut into, at its quantiles
SPELT = 8           # dimensions up to which distances are one expression a dimension
SLACK = 1 + 1e-9    # rounding of a box distance against a row distance


def _spread(c: Column, axes: int) -> Column:
    """The nine bits of a range's number moved ``axes`` places apart (a curve's code interleaves them)."""
    bits = [F.shiftleft(F.shiftright(c, k).bitwiseAND(F.lit(1)), k * axes) for k in range(9)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _whole(vec: str) -> Column:
    return F.col(vec).isNotNull() & F.forall(F.col(vec), lambda x: x.isNotNull() & (F.abs(x) < float("inf")))


def _sum(terms: Column | list[Column]) -> Column:
    return reduce(lambda s, t: s + t, terms) if isinstance(terms, list) else F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)


def _sq(a: Column, b: Column, dims: int) -> Column:
    """Squared Euclidean distance, summed in the order of the dimensions (spelt out while the generated code stays short)."""
    if dims <= SPELT:
        return _sum([(a[i] - b[i]) * (a[i] - b[i]) for i in range(dims)])
    return _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def _box_sq(q: Column, lo: Column, hi: Column, dims: int) -> Column:
    """Squared distance of a point from a box (0 inside)."""
    if dims <= SPELT:
        gap = [F.greatest(lo[i] - q[i], q[i] - hi[i], F.lit(0.0)) for i in range(dims)]
        return _sum([g * g for g in gap])
    gaps = F.zip_with(F.zip_with(lo, q, lambda x, y: x - y), F.zip_with(q, hi, lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return _sum(F.transform(gaps, lambda g: g * g))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of every query in (_qv, _n, _t, _d): numbered by distance, then key."""
    w = Window.partitionBy("_qv").orderBy("_d", "_n")
    return found.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)


class Index:
    """Training rows in blocks along the curve, with the levels of boxes over them, and the queries' own blocks."""

    def __init__(self, queries: DataFrame, train: DataFrame, k: int):
        t = train.withColumn("_nv", F.col("_nv").cast("array<double>")).filter(_whole("_nv"))
        first = t.select(F.size("_nv").alias("d")).first()
        self.k, self.size, self.dims = k, max(ROWS, k), first["d"] if first else 0
        if not self.dims:
            return
        q = queries.select(F.col("_qv").cast("array<double>").alias("_qv")).filter(_whole("_qv") & (F.size("_qv") == self.dims)).distinct()
        w = Window.partitionBy("_nv").orderBy("_n")
        t = t.filter(F.size("_nv") == self.dims).withColumn("_c", F.row_number().over(w)).filter(F.col("_c") <= k)
        self._place(materialize(t.select(F.col("_nv").alias("_v"), F.lit(0).alias("_ask"), "_n", "_t").unionByName(
            q.select(F.col("_qv").alias("_v"), F.lit(1).alias("_ask")), allowMissingColumns=True)))
        self._boxes()

    def _place(self, both: DataFrame) -> None:
        """Sort rows and queries together along the curve; a block number for both."""
        known = both.filter("_ask = 0")
        spread = known.agg(*[F.stddev_pop(F.col("_v")[i]) for i in range(self.dims)]).first()
        axes = sorted(range(self.dims), key=lambda i: (-(spread[i] or 0.0), i))[:AXES]
        code = F.lit(0).cast("long")
        both = both.withColumns({f"_x{i}": F.col("_v")[i] for i in axes})
        if len(axes) > 1:
            probs = [j / SLABS for j in range(1, SLABS)]
            cuts = known.agg(*[F.percentile_approx(F.col("_v")[i], probs, 10 * SLABS) for i in axes]).first()     # SLABS numbers an axis
            splits = [[-float("inf"), *sorted({x for x in c if abs(x) != float("inf")}), float("inf")] for c in cuts]
            both = Bucketizer(splitsArray=splits, inputCols=[f"_x{i}" for i in axes], outputCols=[f"_b{i}" for i in axes]).transform(both)
            for j, i in enumerate(axes):
                code = code.bitwiseOR(F.shiftleft(_spread(F.col(f"_b{i}").cast("long"), len(axes)), j))
        order = [f"_x{i}" for i in axes]
        both = both.select("_v", "_ask", "_n", "_t", code.alias("_code"), *order).orderBy("_code", *order, "_ask", "_n")
        placed = materialize(both.select("_v", "_ask", "_n", "_t", F.monotonically_increasing_id().alias("_place")))
        placed = placed.withColumn("_range", F.shiftright("_place", 33))          # the sort range: the place's high bits
        row = 1 - F.col("_ask")
        counts = sorted((r["_range"], r["rows"]) for r in placed.groupBy("_range").agg(F.sum(row).alias("rows")).collect())    # one a sort range
        self.n = sum(c for _, c in counts)
        offsets = both.sparkSession.createDataFrame(list(zip([r for r, _ in counts], accumulate([c for _, c in counts], initial=0))), "_range long, _off long")
        before = F.sum(row).over(Window.partitionBy("_range").orderBy("_place"))
        block = F.floor((F.greatest(F.col("_before") + F.col("_off"), F.lit(1)) - 1) / self.size)
        ranked = placed.withColumn("_before", before).join(F.broadcast(offsets), "_range").select("_v", "_ask", "_n", "_t", block.alias("block"))
        ranked = materialize(ranked)
        self.rows = ranked.filter("_ask = 0").select(F.col("_v").alias("_nv"), "_n", "_t", "block")
        self.asked = ranked.filter("_ask = 1").select(F.col("_v").alias("_qv"), "block")

    def _boxes(self) -> None:
        """Levels of boxes from the blocks up, until at most ``FAN`` are left."""
        def covered(df: DataFrame, by: Column, lo: Column, hi: Column) -> DataFrame:
            got = df.groupBy(by.alias("box")).agg(*[F.min(lo[i]).alias(f"l{i}") for i in range(self.dims)], *[F.max(hi[i]).alias(f"h{i}") for i in range(self.dims)])
            return got.select("box", F.array(*[f"l{i}" for i in range(self.dims)]).alias("lo"), F.array(*[f"h{i}" for i in range(self.dims)]).alias("hi"))

        level = materialize(covered(self.rows, F.col("block"), F.col("_nv"), F.col("_nv")))
        self.levels, count = [level], -(-self.n // self.size)
        while count > FAN:
            level = materialize(covered(level, F.floor(F.col("box") / FAN), F.col("lo"), F.col("hi")))
            count = -(-count // FAN)
            self.levels.append(level)

    def near(self) -> DataFrame:
        """The k nearest rows within a query's own block and the ones beside it."""
        own = self.asked.select("_qv", F.explode(F.sequence(F.col("block") - 1, F.col("block") + 1)).alias("block"))
        found = own.join(self.rows, "block").select("_qv", "_n", "_t", F.sqrt(_sq(F.col("_qv"), F.col("_nv"), self.dims)).alias("_d"))
        return materialize(_best(found, self.k))

    def pairs(self, near: DataFrame) -> DataFrame:
        """(_qv, _reach, block): the further blocks that a query's ball touches."""
        reach = near.groupBy("_qv").agg(F.count(F.lit(1)).alias("_have"), F.max("_d").alias("_far"))
        ask = self.asked.join(reach, "_qv", "left").select("_qv", F.col("block").alias("_own"),
                                                           F.when(F.col("_have") >= self.k, F.col("_far")).otherwise(F.lit(float("inf"))).alias("_reach"))
        touched = lambda lo, hi: _box_sq(F.col("_qv"), lo, hi, self.dims) <= F.pow(F.col("_reach") * SLACK, 2)
        top = [(r["box"], list(r["lo"]), list(r["hi"])) for r in self.levels[-1].orderBy("box").collect()]      # at most FAN boxes
        boxes = F.array(*[F.struct(F.lit(b).cast("long").alias("box"), F.array(*map(F.lit, lo)).alias("lo"), F.array(*map(F.lit, hi)).alias("hi")) for b, lo, hi in top])
        at = ask.select("_qv", "_own", "_reach", F.explode(boxes).alias("b")).filter(touched(F.col("b.lo"), F.col("b.hi"))).select("_qv", "_own", "_reach", F.col("b.box").alias("box"))
        for level in reversed(self.levels[:-1]):
            below = level.withColumn("_up", F.floor(F.col("box") / FAN))
            at = at.withColumnRenamed("box", "_up").join(below, "_up").filter(touched(F.col("lo"), F.col("hi"))).select("_qv", "_own", "_reach", "box")
        return at.filter(F.abs(F.col("box") - F.col("_own")) > 1).select("_qv", "_reach", F.col("box").alias("block"))

    def search(self) -> DataFrame:
        near = self.near()
        more = self.pairs(near).join(self.rows, "block").select("_qv", "_reach", "_n", "_t", F.sqrt(_sq(F.col("_qv"), F.col("_nv"), self.dims)).alias("_d"))
        more = more.filter(F.col("_d") <= F.col("_reach"))
        return _best(near.drop("_r").unionByName(more.drop("_reach")), self.k)


def nearest(queries: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of ``train`` (_n key, _nv vector, _t value) for every query (_q key, _qv vector).

    Rows (_q, _n, _t, _d distance, _r rank from 1); fewer than k where the
    table has fewer.  Vectors of another length than the training rows' have no
    neighbours.
    """
    index = Index(queries, train, k)
    ids = queries.select("_q", F.col("_qv").cast("array<double>").alias("_qv"))
    if not index.dims:
        return ids.join(train.select("_n", "_t"), F.lit(False)).select("_q", "_n", "_t", F.lit(0.0).alias("_d"), F.lit(1).alias("_r"))
    return ids.join(index.search(), "_qv").select("_q", "_n", "_t", "_d", "_r")
