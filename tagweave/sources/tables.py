"""A database of entities over star-schema tables: rows are entities, categories are tags, foreign keys are relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.plans.compile import Bindings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entities(rows: DataFrame, kind: str, key: str, labels: list[Column] = (), amount: Column | None = None) -> DataFrame:
    """One entity a row: name ``kind:key``, tags of the kind and of the given labels, an amount, and the kind again as ``class``."""
    tags = F.array(F.lit(f"sem:{kind}"), *[F.concat(F.lit("sem:"), c) for c in labels])
    value = amount.cast("double") if amount is not None else F.lit(0.0)
    return rows.select(F.concat(F.lit(f"{kind}:"), F.col(key).cast("string")).alias("name"), F.array_compact(tags).alias("tags"), value.alias("amount"), F.lit(kind).alias("class"))


def links(rows: DataFrame, kind: str, child: str, key: str, parent: str, to: str) -> DataFrame:
    name = lambda k, c: F.concat(F.lit(f"{k}:"), F.col(c).cast("string"))
    return rows.where(F.col(to).isNotNull()).select(name(child, key).alias("src"), name(parent, to).alias("dst"), F.lit(kind).alias("kind"))


def database(spark: SparkSession, sf_dir: str) -> Bindings:
    """Regions, nations, customers, suppliers and orders. An order is supported by its customer, which touches its nation,
    which is coplanar with its region; suppliers touch their nations."""
    t = {n: table(spark, sf_dir, n) for n in ("region", "nation", "customer", "supplier", "orders")}
    objects = entities(t["region"], "region", "r_regionkey")
    objects = objects.union(entities(t["nation"], "nation", "n_nationkey"))
    objects = objects.union(entities(t["customer"], "customer", "c_custkey", [F.col("c_mktsegment")], F.col("c_acctbal")))
    objects = objects.union(entities(t["supplier"], "supplier", "s_suppkey", [], F.col("s_acctbal")))
    status, priority = F.concat(F.lit("status-"), F.col("o_orderstatus")), F.col("o_orderpriority")
    objects = objects.union(entities(t["orders"], "order", "o_orderkey", [status, priority], F.col("o_totalprice")))
    edges = links(t["nation"], "coplanar", "nation", "n_nationkey", "region", "n_regionkey")
    edges = edges.union(links(t["customer"], "touching", "customer", "c_custkey", "nation", "c_nationkey"))
    edges = edges.union(links(t["supplier"], "touching", "supplier", "s_suppkey", "nation", "s_nationkey"))
    edges = edges.union(links(t["orders"], "supported_by", "order", "o_orderkey", "customer", "o_custkey"))
    return Bindings(objects, edges, frozenset(["region", "nation", "customer", "supplier", "order"]), single_edges=True)
