"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.skew import lookup_join
from martloom.session import settle


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first()
    return row[0], row[1]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)``: every node of the links with the smallest node it can reach.

    Alternates two rounds until nothing changes: each node hangs its larger neighbours on its
    smallest neighbour (large star), then its smaller ones (small star). A node's neighbours are
    never gathered; minima are combined before the shuffle, and the join back is salted, so a
    centre with very many links is spread. Each round is written to the shared folder, which
    cuts the lineage. NULL ends and self links are ignored; no links give an empty table.
    """
    edges = settle(
        links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))
        .where("node IS NOT NULL AND root IS NOT NULL AND node <> root")
        .where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .distinct()
    )
    seen = _mark(edges)
    while seen[0]:
        both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(
            edges.select(F.col("root").alias("u"), F.col("node").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            lookup_join(both, least, ["u"], "inner")
            .where("v > u")
            .select(F.col("v").alias("node"), F.col("m").alias("root"))
            .distinct()
        )
        least = large.groupBy("node").agg(F.min("root").alias("m"))
        small = (
            lookup_join(large, least, ["node"], "inner")
            .where("root <> m")
            .select(F.col("root").alias("node"), F.col("m").alias("root"))
            .unionByName(least.select("node", F.col("m").alias("root")))
            .where("node <> root")
            .distinct()
        )
        edges = settle(small)
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("root").alias("node"), "root").distinct()
    return edges.groupBy("node").agg(F.min("root").alias("root")).unionByName(roots)
