"""Customer segments by recency, frequency and spend, scored in five equal tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tradewinds.functions import first_match, mean, share_pct
from tradewinds.operators.materialise import materialise
from tradewinds.operators.ordered import with_ntiles
from tradewinds.plans.revenue import revenue_orders


def rfm_base(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Last purchase, orders and spend per person, from paid orders.

    Orders are added up per customer key before the join, so a customer with very many orders is
    one row by then.
    """
    paid = revenue_orders(fact).filter("payment_amount > 0 and purchased_at is not null")
    per_key = paid.groupBy("customer_key").agg(
        F.max("purchased_at").alias("last_purchase"),
        F.count("order_id").alias("orders"),
        F.sum("payment_amount").alias("spend"),
    )
    person = customers.select("customer_key", "customer_unique_id")
    return per_key.join(person, "customer_key").groupBy("customer_unique_id").agg(
        F.max("last_purchase").alias("last_purchase"),
        F.sum("orders").alias("frequency"),
        F.sum("spend").cast("decimal(18,2)").alias("monetary"),
    )


def with_recency(people: DataFrame) -> DataFrame:
    """Calendar days since the last purchase, counted from the latest purchase of all."""
    latest = people.agg(F.max("last_purchase")).scalar()
    return people.withColumn("recency_days", F.date_diff(latest, "last_purchase"))


def segment(r: str = "r_score", f: str = "f_score", m: str = "m_score"):
    """Label of the first rule that matches. 'At Risk' can never match: 'Loyal Customers' comes
    first and asks for less."""
    r, f, m = F.col(r), F.col(f), F.col(m)
    return first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((f >= 3) & (m >= 3), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "Recent Customers"),
            ((r >= 3) & (f >= 2) & (m >= 2), "Potential Loyalists"),
            ((r <= 2) & (f >= 3) & (m >= 3), "At Risk"),
            ((r <= 2) & (f >= 4), "Cannot Lose Them"),
            (r.between(2, 3) & (f <= 2), "Needs Attention"),
            ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
        ],
        otherwise="Other",
    )


def rfm(fact: DataFrame, customers: DataFrame, *, buckets: int = 5) -> DataFrame:
    people = with_recency(materialise(rfm_base(fact, customers)))
    scored = with_ntiles(
        people,
        buckets,
        {"r_score": -F.col("recency_days"), "f_score": F.col("frequency"), "m_score": F.col("monetary")},
        tie_break="customer_unique_id",
    )
    cell = F.concat(*[F.col(c).cast("string") for c in ["r_score", "f_score", "m_score"]])
    return scored.select(
        "customer_unique_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
        cell.alias("rfm_cell"),
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_total"),
        segment().alias("segment_name"),
    ).orderBy(F.col("rfm_total").desc(), F.col("monetary").desc(), F.col("customer_unique_id").asc())


def rfm_summary(scored: DataFrame) -> DataFrame:
    """Size, means and share of customers per segment."""
    segments = scored.groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean("recency_days", 1).alias("avg_recency_days"),
        mean("frequency", 2).alias("avg_frequency"),
        mean("monetary", 2).alias("avg_monetary"),
        F.sum("monetary").alias("total_monetary"),
    )
    everyone = F.sum("customer_count").over(Window.partitionBy())  # one row per segment
    shared = segments.withColumn("pct_of_customers", share_pct(F.col("customer_count"), everyone))
    return shared.orderBy(F.col("total_monetary").desc(), F.col("segment_name").asc())
