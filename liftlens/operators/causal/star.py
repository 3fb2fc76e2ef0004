"""The causal estimators on a second domain: the order star schema.

Treatment: the order is urgent (``o_orderpriority = '1-URGENT'``).
Outcome: the order has at least one returned line (``l_returnflag = 'R'``).
Confounders: customer market segment, customer region, order status.

Plan: returned order keys come from a filtered, two-column lineitem scan
(the predicate reaches Parquet) with a distinct (partial aggregation); orders
are flagged by a left join on the order key, then pre-aggregated to
(customer, status, treatment, outcome) counts *before* the customer join, so a
customer holding a third of all orders contributes a dozen rows to that join.
Spark picks the joins with the dimensions by their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.operators.causal.cells import build_cells

# Fixed values of this domain.
URGENT = "1-URGENT"
RETURNED = "R"
ORDER_CONFOUNDERS = ("c_mktsegment", "n_regionkey", "o_orderstatus")


def order_groups(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                 lineitem: DataFrame) -> DataFrame:
    """(confounders, treatment, outcome, m): counts of orders per combination."""
    returned = (lineitem.where(F.col("l_returnflag") == RETURNED)
                .select(F.col("l_orderkey").alias("_rk")).distinct())
    flagged = (orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                             (F.col("o_orderpriority") == URGENT).cast("int").alias("treatment"))
               .join(returned, F.col("o_orderkey") == F.col("_rk"), "left")
               .select("o_custkey", "o_orderstatus", "treatment",
                       F.col("_rk").isNotNull().cast("int").alias("outcome")))
    per_customer = flagged.groupBy("o_custkey", "o_orderstatus", "treatment", "outcome").agg(
        F.count(F.lit(1)).alias("m"))
    cust = customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    nat = nation.select("n_nationkey", F.col("n_regionkey").cast("string").alias("n_regionkey"))
    return (per_customer.join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(*ORDER_CONFOUNDERS, "treatment", "outcome", "m"))


def order_cells(orders: DataFrame, customer: DataFrame, nation: DataFrame, lineitem: DataFrame) -> DataFrame:
    return build_cells(order_groups(orders, customer, nation, lineitem), ORDER_CONFOUNDERS, weight="m")
