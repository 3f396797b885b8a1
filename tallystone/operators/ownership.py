"""Ownership graphs: effective fractions along all paths, and the graph's invariants.

Graphs are walked a level at a time, each level one job; edges to accounts, which own nothing, are met once.
"""

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PART = "decimal(30,24)"


def _kept(rows: DataFrame) -> DataFrame:
    """A level's rows in the checkpoint folder, which all executors share."""
    spark = rows.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(found or f"file://{tempfile.mkdtemp(prefix='tallystone-')}")
    return rows.checkpoint()


def effective(edges: DataFrame, roots: str = "C", leaves: str = "A") -> DataFrame:
    """(account, client, ownership_pct): products along paths of any length, summed over paths. Edges: owner_id, owned_id, pct.

    Paths grow by an edge a round, from the owners on top to accounts, until none is open; a graph with a cycle is refused.
    """
    if not on_cycles(edges).isEmpty():
        raise ValueError("the ownership graph has a cycle")
    inner, last = edges.where(~F.col("owned_id").startswith(leaves)), edges.where(F.col("owned_id").startswith(leaves))
    own = edges.where(F.col("owner_id").startswith(roots)).select(F.col("owner_id").alias("client"), F.col("owner_id").alias("node")).distinct()
    open_ = every = _kept(own.withColumn("part", F.lit(1).cast(PART)))
    while not open_.isEmpty():
        open_ = _kept(_step(open_, inner).groupBy("client", "node").agg(F.sum("part").cast(PART).alias("part")))
        every = every.unionByName(open_)
    return _step(every, last).groupBy(F.col("node").alias("account"), "client").agg(F.sum("part").cast("decimal(9,6)").alias("ownership_pct"))


def _step(paths: DataFrame, edges: DataFrame) -> DataFrame:
    grown = paths.join(edges, F.col("node") == F.col("owner_id"))
    return grown.select("client", F.col("owned_id").alias("node"), (F.col("part") * F.col("pct")).cast(PART).alias("part"))


def on_cycles(edges: DataFrame) -> DataFrame:
    """(node): those that own themselves, directly or through others."""
    left = _kept(edges.select("owner_id", "owned_id").distinct())
    n = None
    while n != (n := left.count()):  # edges from a node without owners, or to one that owns nothing, are on no cycle
        owners, owned = left.select(F.col("owner_id").alias("owned_id")).distinct(), left.select(F.col("owned_id").alias("owner_id")).distinct()
        left = _kept(left.join(owners, "owned_id", "left_semi").join(owned, "owner_id", "left_semi").select("owner_id", "owned_id"))
    reach, n = left, None
    while n != (n := reach.count()):
        further = reach.withColumnRenamed("owned_id", "via").join(left.withColumnRenamed("owner_id", "via"), "via").select("owner_id", "owned_id")
        reach = _kept(reach.unionByName(further).distinct())
    return reach.where("owner_id = owned_id").select(F.col("owner_id").alias("node"))


def problems(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(problem, node): fractions outside (0, 1], nodes whose incoming fractions don't sum up to 1, nodes on a cycle.

    nodes: node, kind (client, entity, account), the known ones; with them also owners that are no known client or entity,
    owned nodes that are no known entity or account, and accounts that nobody owns.
    """
    named = lambda rows, problem, node: rows.select(F.lit(problem).alias("problem"), F.col(node).alias("node"))
    found = named(edges.where(~((F.col("pct") > 0) & (F.col("pct") <= 1))), "fraction", "owned_id")
    found = found.unionByName(named(edges.groupBy("owned_id").agg(F.sum("pct").alias("total")).where("total <> 1"), "incomplete", "owned_id"))
    found = found.unionByName(named(on_cycles(edges), "cycle", "node"))
    if nodes is None:
        return found
    owners, owned = edges.select(F.col("owner_id").alias("node")).distinct(), edges.select(F.col("owned_id").alias("node")).distinct()
    found = found.unionByName(named(owners.join(nodes.where("kind IN ('client', 'entity')"), "node", "left_anti"), "unknown owner", "node"))
    found = found.unionByName(named(owned.join(nodes.where("kind IN ('entity', 'account')"), "node", "left_anti"), "unknown owned", "node"))
    return found.unionByName(named(nodes.where("kind = 'account'").join(owned, "node", "left_anti"), "unowned", "node"))


def shared(owners: DataFrame) -> DataFrame:
    n = F.count("*").over(Window.partitionBy("account_id"))
    return owners.select("account_id", "client_id", "ownership_pct", n.alias("owner_count"), (n > 1).alias("is_shared"))


def co_owners(owners: DataFrame) -> DataFrame:
    """(account_id, client_id, others): each owner's partners in an account, one after another by id."""
    every = F.array_sort(F.collect_list("client_id").over(Window.partitionBy("account_id")))
    others = F.filter(every, lambda x: x != F.col("client_id"))
    return owners.select("account_id", "client_id", F.array_join(F.transform(others, lambda x: x.cast("string")), ",").alias("others")).where("others <> ''")
