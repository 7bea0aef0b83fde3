"""Roots of chains of parent tickets, by pointer jumping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.session import settle


def roots(tickets: DataFrame, child: str = "Numero", parent: str = "Incidente_Pai") -> DataFrame:
    """(child, root, depth) of every ticket that names a parent.

    Each round every ticket jumps to the ancestor that its ancestor has reached, so chains of
    any length end after about log2(length) rounds of one join over two ids and a number. A
    parent that is no ticket itself is a root. Tickets whose chain runs into a circle have no
    end: root and depth are null. Of several parents of one ticket the least counts; rows
    without a number or parent are left out.
    """
    links = (
        tickets.where(F.col(child).isNotNull() & F.col(parent).isNotNull())
        .groupBy(F.col(child).alias("child")).agg(F.min(parent).alias("to"))
    )
    state = settle(links.select("child", "to", F.lit(1).cast("bigint").alias("depth"), F.lit(False).alias("ended")))
    longest = state.count()
    reach = 1
    while reach <= 2 * longest and not state.where("not ended").isEmpty():
        open_ = state.where("not ended")
        # Only ancestors that are children themselves can be jumped over.
        next_ = state.select(F.col("child").alias("to"), F.col("to").alias("_to"), F.col("depth").alias("_depth"))
        jumped = open_.join(next_, "to", "left").select(
            "child", F.coalesce("_to", "to").alias("to"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), F.col("_to").isNull().alias("ended"),
        )
        state = settle(state.where("ended").unionByName(jumped))
        reach *= 2
    return state.select(
        F.col("child").alias(child),
        F.when(F.col("ended"), F.col("to")).alias("root"), F.when(F.col("ended"), F.col("depth")).alias("depth"),
    )


def descendants(tickets: DataFrame, child: str = "Numero", parent: str = "Incidente_Pai",
                work: str = "Exige_Intervencao") -> DataFrame:
    """(root, depth, tickets, with_work): tickets below each root by their distance to it; the
    null root has those whose chain is a circle."""
    found = roots(tickets, child, parent)
    return found.join(tickets.select(child, work), child).groupBy("root", "depth").agg(
        F.count("*").alias("tickets"), F.sum(work).alias("with_work")
    )
