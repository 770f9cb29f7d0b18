"""Connected components of an edge list, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import drop_path, stash_path


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, by: str | None = None) -> DataFrame:
    """(node, component): every node of the edges with the smallest node it is connected to.

    ``by`` names a column of numbers that tells apart graphs which are solved together, in
    the rounds of one; the result then has that column first.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): each round points
    neighbours at the smallest node near them, so long chains shrink by a constant factor
    and no node's neighbourhood is collected anywhere. Each round is written to the shared
    folder; the loop ends when a round changes no edge. Null ends and self-loops are
    ignored, repeated edges count once; no edges give no rows.
    """
    spark = edges.sparkSession
    g = [by] if by else []
    schema = "".join(f"{c} {edges.schema[c].dataType.simpleString()}, " for c in g) + "u long, v long"
    flip = lambda u, v: (*g, F.col(v).alias("u"), F.col(u).alias("v"))

    def put(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = stash_path(spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(schema).parquet(path), path

    now, path = put(
        edges.select(*g, F.greatest(src, dst).cast("long").alias("u"), F.least(src, dst).cast("long").alias("v"))
        .where(f"{src} is not null and {dst} is not null and u <> v")
        .distinct(),
        "cc",
    )
    n = now.count()
    mark = None
    for _ in range(max_rounds):
        if not n:
            break
        both = now.unionAll(now.select(*flip("u", "v")))
        low = both.groupBy(*g, "u").agg(F.min("v").alias("m")).select(*g, "u", F.least("u", "m").alias("m"))
        large = both.join(low, [*g, "u"]).where("v > u").select(*g, F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_low = large.groupBy(*g, "u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(small_low, [*g, "u"]).select(*g, F.explode(ends).alias("e")).select(*g, "e.u", "e.v").where("u <> v").distinct()
        new, new_path = put(small, "cc")
        drop_path(spark, path)
        now, path = new, new_path
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*g, "u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark, n = seen, seen[0]
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = now.groupBy(*g, "u").agg(F.min("v").alias("component")).select(*g, F.col("u").alias("node"), "component")
    return nodes.unionByName(nodes.select(*g, F.col("component").alias("node"), "component").distinct())
