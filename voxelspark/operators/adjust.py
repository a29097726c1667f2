"""Positions of many tiles from a table of edges: weighted least squares by conjugate gradients, whose state is a table.

``registration.solve_offsets`` gives each time point to one task, which suits the thousands of tiles of a plate; here a time
point's graph may be of any size. An iteration is one pass over the edges and one over the tiles, and its tables are
written to the checkpoint folder. All time points and axes go through the same passes, each with its own step lengths.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registration import outliers, residuals

AXES = "zyx"


def written(df: DataFrame) -> DataFrame:
    """The table, written to the folder that spark.checkpoint.dir names and read again, which outlives lost executors. Where it is
    unset a local session gets a folder of its own; a cluster is refused."""
    spark: SparkSession = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="voxelspark-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/adjust-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _by_axis(make) -> list[Column]:
    return [make(a) for a in AXES]


def _normal(edges: DataFrame, state: DataFrame) -> DataFrame:
    """(t, p, q_...): the normal matrix of edges(t, i, j, w) times the vector d_... of state(t, p, anchor, d_...)."""
    ends = [state.select("t", F.col("p").alias(n), *_by_axis(lambda a, n=n: F.col(f"d_{a}").alias(f"{n}_{a}"))) for n in "ij"]
    pull = edges.join(ends[0], ["t", "i"]).join(ends[1], ["t", "j"])
    pull = pull.select("t", "i", "j", *_by_axis(lambda a: (F.col("w") * (F.col(f"j_{a}") - F.col(f"i_{a}"))).alias(f"f_{a}")))
    sides = [pull.select("t", F.col(n).alias("p"), *_by_axis(lambda a, s=s: (s * F.col(f"f_{a}")).alias(f"f_{a}"))) for n, s in (("j", 1.0), ("i", -1.0))]
    sums = sides[0].unionByName(sides[1]).groupBy("t", "p").agg(*_by_axis(lambda a: F.sum(f"f_{a}").alias(f"s_{a}")))
    whole = state.join(sums, ["t", "p"], "left")
    return whole.select(*state.columns, *_by_axis(lambda a: (F.coalesce(f"s_{a}", F.lit(0.0)) + F.col("anchor") * F.col(f"d_{a}")).alias(f"q_{a}")))


def least_squares(edges: DataFrame, tiles: DataFrame, tolerance: float = 1e-12, rounds: int = 10_000) -> DataFrame:
    """(t, p, dz, dy, dx) of every row of tiles(t, p): the offsets that fit edges(t, i, j, dz, dy, dx, score) best, each edge
    weighted by its score, with the first tile of a time point held at 0 and the least ones where tiles hang on no anchor. It
    ends once every residual is ``tolerance`` of the first one; RuntimeError after ``rounds``."""
    ids = tiles.select("t", "p").distinct()
    first = ids.groupBy("t").agg(F.min("p").alias("p")).withColumn("anchor", F.lit(1.0))
    known = edges.join(ids.withColumnRenamed("p", "i"), ["t", "i"], "left_semi").join(ids.withColumnRenamed("p", "j"), ["t", "j"], "left_semi")
    links = written(known.select("t", "i", "j", F.col("score").cast("double").alias("w"), *_by_axis(lambda a: F.col(f"d{a}").cast("double").alias(f"d{a}"))))
    sides = [links.select("t", F.col(n).alias("p"), *_by_axis(lambda a, s=s: (s * F.col("w") * F.col(f"d{a}")).alias(f"r_{a}"))) for n, s in (("j", 1.0), ("i", -1.0))]
    right = sides[0].unionByName(sides[1]).groupBy("t", "p").agg(*_by_axis(lambda a: F.sum(f"r_{a}").alias(f"r_{a}")))
    zero = F.lit(0.0)
    own = ids.join(first, ["t", "p"], "left").join(right, ["t", "p"], "left")
    own = written(own.select("t", "p", F.coalesce("anchor", zero).alias("anchor"), *_by_axis(lambda a: zero.alias(f"x_{a}")), *_by_axis(lambda a: F.coalesce(f"r_{a}", zero).alias(f"r_{a}")), *_by_axis(lambda a: zero.alias(f"d_{a}")), *_by_axis(lambda a: zero.alias(f"old_{a}")), *_by_axis(lambda a: F.lit(None).cast("double").alias(f"first_{a}"))))
    for _ in range(rounds):
        # a row a time point: the squared residuals, and those of the round before and of the first one
        size = own.groupBy("t").agg(*_by_axis(lambda a: F.sum(F.col(f"r_{a}") * F.col(f"r_{a}")).alias(f"new_{a}")), *_by_axis(lambda a: F.first(f"old_{a}").alias(f"was_{a}")), *_by_axis(lambda a: F.first(f"first_{a}").alias(f"one_{a}")))
        left = [F.col(f"new_{a}") > tolerance * tolerance * F.coalesce(f"one_{a}", zero) for a in AXES]
        if not size.where(left[0] | left[1] | left[2]).limit(1).count():
            return own.select("t", "p", *_by_axis(lambda a: F.col(f"x_{a}").alias(f"d{a}")))
        by = lambda a: F.when(F.col(f"was_{a}") > 0, F.col(f"new_{a}") / F.col(f"was_{a}")).otherwise(zero)
        state = own.drop(*(f"{k}_{a}" for k in ("old", "first") for a in AXES)).join(size, "t")
        state = state.select("t", "p", "anchor", *(f"{k}_{a}" for k in ("x", "r", "new") for a in AXES), *_by_axis(lambda a: F.coalesce(f"one_{a}", f"new_{a}").alias(f"first_{a}")), *_by_axis(lambda a: (F.col(f"r_{a}") + by(a) * F.col(f"d_{a}")).alias(f"d_{a}")))
        moved = _normal(links.select("t", "i", "j", "w"), state)
        along = moved.groupBy("t").agg(*_by_axis(lambda a: F.sum(F.col(f"d_{a}") * F.col(f"q_{a}")).alias(f"dq_{a}")))
        go = lambda a: (F.col(f"dq_{a}") > 0) & (F.col(f"new_{a}") > tolerance * tolerance * F.col(f"first_{a}"))
        step = lambda a: F.when(go(a), F.col(f"new_{a}") / F.col(f"dq_{a}")).otherwise(zero)
        new = moved.join(along, "t").select("t", "p", "anchor", *_by_axis(lambda a: (F.col(f"x_{a}") + step(a) * F.col(f"d_{a}")).alias(f"x_{a}")), *_by_axis(lambda a: (F.col(f"r_{a}") - step(a) * F.col(f"q_{a}")).alias(f"r_{a}")), *_by_axis(lambda a: F.col(f"d_{a}")), *_by_axis(lambda a: F.col(f"new_{a}").alias(f"old_{a}")), *_by_axis(lambda a: F.col(f"first_{a}")))
        own = written(new)
    raise RuntimeError(f"no solution after {rounds} rounds")


def solve_offsets(edges: DataFrame, tiles: DataFrame, method: str = "TWO_ROUND_ITERATIVE", rel: float = 0.5, least: float = 1.5) -> DataFrame:
    """``registration.solve_offsets`` for graphs of any size: solve, leave out the edges that fit badly, and solve again, once or
    until none does. A time point of which every edge fits badly stays as it is."""
    if method not in ("ONE_ROUND", "TWO_ROUND", "TWO_ROUND_ITERATIVE"):
        raise ValueError("unknown method")
    kept = edges
    while True:
        found = written(least_squares(kept, tiles))
        if method == "ONE_ROUND":
            return found
        bad = outliers(residuals(kept, found), rel, least)
        sizes = kept.groupBy("t").count().join(bad.groupBy("t").agg(F.count(F.lit(1)).alias("bad")), "t").where("bad < count")
        bad = written(bad.join(sizes.select("t"), "t", "left_semi").select("t", "i", "j"))
        if not bad.limit(1).count():
            return found
        kept = written(kept.join(bad, ["t", "i", "j"], "left_anti"))
        if method == "TWO_ROUND":
            method = "ONE_ROUND"
