"""Orders and payments: record parsing, topic routing, status, carry-forward.

The batch form of the unpaid-order reminder: payments are judged against
their order and reduced to one row per orderid; the decision per order is a
CASE over that row.  The continuous form is :mod:`logloom.streaming.unpaid`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom import schemas
from logloom.functions import columns as C
from logloom.functions.parse import csv_fields

# ---------------------------------------------------------------------------
# Topic names of the order bus.
# ---------------------------------------------------------------------------
ORDER_TOPICS = ["produceOrderInfo", "order2"]       # new orders, carried-forward orders
PAYMENT_TOPICS = ["producerOrderids", "pay2"]       # new payments, carried-forward payments
CARRIED_ORDER_MARKER = "nothing"
REMIND_AFTER = "5 minutes"
# ---------------------------------------------------------------------------

STATUS_PAID = "paid"
STATUS_PAID_LATE = "paid_late"
STATUS_REMIND = "remind"
STATUS_PENDING = "pending"
STATUS_ORPHAN = "orphan"
STATUS_UNTIMED = "untimed"            # an order without a readable time
STATUS_PAID_UNTIMED = "paid_untimed"  # paid, but no payment has a readable time


def route_topics(bus: DataFrame, topics: list[str]) -> DataFrame:
    """Rows of the given topics (the topic-membership predicate)."""
    return bus.where(F.col("topic").isin(topics))


def order_record_parse(df: DataFrame, value_col: str = "value") -> DataFrame:
    """CSV order record -> userId, orderid, addressId, ordertime, goodsamount,
    carriage, discountamount, amount (strings, as on the wire)."""
    return df.select(*csv_fields(value_col, schemas.ORDER_RECORD))


def payment_record_parse(df: DataFrame, value_col: str = "value") -> DataFrame:
    """CSV payment record -> orderid, payment, paymenttime, bonus, paymenttype."""
    return df.select(*csv_fields(value_col, schemas.PAYMENT_RECORD))


def delivery_record_parse(df: DataFrame, value_col: str = "value") -> DataFrame:
    """CSV delivery record -> userId, addressId, address, linkman, phonenum."""
    return df.select(*csv_fields(value_col, schemas.DELIVERY_RECORD))


def _ts(col: str) -> Column:
    return C.log_time(col, "yyyy-MM-dd HH:mm:ss")


def orders_from_bus(bus: DataFrame) -> DataFrame:
    """orderid, userid, ordertime (string), order_ts (TIMESTAMP_NTZ)."""
    o = order_record_parse(route_topics(bus, ORDER_TOPICS))
    return o.select("orderid", F.col("userId").alias("userid"), "ordertime",
                    _ts("ordertime").alias("order_ts"))


def payments_from_bus(bus: DataFrame) -> DataFrame:
    """orderid, payment, paymenttime (string), pay_ts (TIMESTAMP_NTZ)."""
    p = payment_record_parse(route_topics(bus, PAYMENT_TOPICS))
    return p.select("orderid", "payment", "paymenttime", _ts("paymenttime").alias("pay_ts"))


def orders_payments_full_outer(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders full-outer-joined with payments on orderid (one row per pair).

    Written as ``orders LEFT JOIN payments`` plus ``payments LEFT ANTI JOIN
    orders`` -- the same rows as a FULL OUTER JOIN -- because AQE can split
    a skewed (hot ``orderid``) partition on the left side of both of these
    joins but not of a full outer join.  Both joins shuffle the same two
    inputs by orderid, so the exchanges are planned once and reused.
    """
    o = orders.select(F.col("orderid").alias("o_id"), "userid", "ordertime", "order_ts")
    p = payments.select(F.col("orderid").alias("p_id"), "payment", "paymenttime", "pay_ts")
    matched = o.join(p, o["o_id"] == p["p_id"], "left")
    orphans = p.join(o, p["p_id"] == o["o_id"], "left_anti")
    cols = ["userid", "ordertime", "order_ts", "payment", "paymenttime", "pay_ts"]
    left = matched.select(F.col("o_id").alias("orderid"), F.lit(True).alias("has_order"),
                          F.col("p_id").isNotNull().alias("has_payment"), *cols)
    right = orphans.select(F.col("p_id").alias("orderid"), F.lit(False).alias("has_order"),
                           F.lit(True).alias("has_payment"),
                           F.lit(None).cast("string").alias("userid"),
                           F.lit(None).cast("string").alias("ordertime"),
                           F.lit(None).cast("timestamp_ntz").alias("order_ts"),
                           "payment", "paymenttime", "pay_ts")
    return left.unionByName(right.select(*left.columns))


#: Rows of one key beyond which it is salted, and rows of a salted part.
HOT_ROWS = 100_000


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS, share: float = 0.01,
             seed: int = 7) -> dict[str, int]:
    """Keys that hold about ``hot_rows`` rows or more, and in how many parts to
    split each, found by a sample of ``share`` of the rows.  What reaches the
    driver is a row per hot key, at most rows / hot_rows of them."""
    least = max(2, hot_rows * share / 2)
    found = rows.where(F.col(key).isNotNull()).sample(share, seed=seed).groupBy(key).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return {r[key]: -(-int(r.n / share) // hot_rows) + 1 for r in found.collect()}


def orders_payments_salted(orders: DataFrame, payments: DataFrame, hot: dict[str, int] | None = None,
                           hot_rows: int = HOT_ROWS) -> DataFrame:
    """``orders_payments_full_outer`` with the hot order ids split on both sides.

    A hot id's payments are dealt over ``p`` parts by a hash of the payment, its
    order records over the cells of ``p`` rows: each order stands once in every
    part of the payments, so a part pairs all orders with its share.  Which side
    of a hot id is the larger does not matter, as orders are dealt too: part
    ``(i, j)`` holds order share ``i`` and payment share ``j``.  An order is
    unmatched when its id has no payment at all and the other way round; this
    is settled once, from the distinct ids of each side, instead of in every
    part.  The rows are those of the full outer join.
    """
    if hot is None:
        hot = hot_keys(orders, "orderid", hot_rows)
        for k, n in hot_keys(payments, "orderid", hot_rows).items():
            hot[k] = max(hot.get(k, 1), n)
    o = orders.select(F.col("orderid").alias("o_id"), "userid", "ordertime", "order_ts")
    p = payments.select(F.col("orderid").alias("p_id"), "payment", "paymenttime", "pay_ts")
    parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kn in hot.items() for x in kn]), F.col("_id")),
                       F.lit(1)) if hot else F.lit(1)

    def dealt(rows: DataFrame, key: str, own: str, other: str, *cols: str) -> DataFrame:
        """A row stands in its own share of the cells, once for each share of
        the other side."""
        share = F.pmod(F.xxhash64(*cols, F.monotonically_increasing_id()), F.col("_parts"))
        rows = rows.withColumn("_id", F.col(key)).withColumn("_parts", parts).withColumn(own, share.cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_id", "_parts")
    od = dealt(o, "o_id", "_i", "_j", "o_id", "ordertime")
    pd = dealt(p, "p_id", "_pj", "_pi", "p_id", "payment", "paymenttime")
    cols = ["userid", "ordertime", "order_ts", "payment", "paymenttime", "pay_ts"]
    pairs = od.join(pd, (F.col("o_id") == F.col("p_id")) & (F.col("_i") == F.col("_pi"))
                    & (F.col("_j") == F.col("_pj"))).select(
        F.col("o_id").alias("orderid"), F.lit(True).alias("has_order"), F.lit(True).alias("has_payment"), *cols)

    def alone(rows: DataFrame, key: str, ids: DataFrame, is_order: bool) -> DataFrame:
        left = rows.join(ids.distinct(), F.col(key) == F.col("_known"), "left_anti")
        return left.select(
            F.col(key).alias("orderid"), F.lit(is_order).alias("has_order"), F.lit(not is_order).alias("has_payment"),
            *[F.col(c) if c in rows.columns else F.lit(None).cast(
                "timestamp_ntz" if c.endswith("_ts") else "string").alias(c) for c in cols])
    return (pairs.unionByName(alone(o, "o_id", p.select(F.col("p_id").alias("_known")), True))
            .unionByName(alone(p, "p_id", o.select(F.col("o_id").alias("_known")), False)))


def order_payment_status(orders: DataFrame, payments: DataFrame, as_of: str,
                         pay_within: str | None = REMIND_AFTER,
                         early_slack: str = "10 minutes") -> DataFrame:
    """Status of every order and payment known at ``as_of``: one row per orderid.

    * a payment within [order - early_slack, order + pay_within] -> ``paid``
    * timed payments, all outside that window                   -> ``paid_late``
    * payments, none with a readable time                       -> ``paid_untimed``
    * no payment, order older than pay_within at as_of           -> ``remind``
    * no payment, order not older than that                      -> ``pending``
    * the order has no readable time                             -> ``untimed``
    * payments without an order                                  -> ``orphan``

    ``pay_within=None`` is the reference's per-batch rule: any payment
    settles the order, timed or not.  "Older than" is strict: exactly five
    minutes is still pending.  Orders and payments timed after ``as_of`` are
    not known yet; without a time they are known.  Of repeated order records
    the earliest counts; the payment shown is the earliest in the window, else
    the earliest timed one, else the least.  Output: orderid, userid,
    ordertime, payment, paymenttime, status.

    Plan: orders are reduced to one row per orderid, so the join gives one
    row per payment, never orders x payments; it is the payments' side that
    AQE splits for a hot orderid, and the reduction after it is partial.
    """
    cut = F.lit(as_of).cast("timestamp_ntz")
    known = (orders.where(F.col("order_ts").isNull() | (F.col("order_ts") <= cut))
             .groupBy("orderid").agg(F.min(F.struct(
                 F.col("order_ts").isNull().alias("untimed"), "order_ts", "userid", "ordertime"))
                 .alias("o")))
    p = payments.where(F.col("pay_ts").isNull() | (F.col("pay_ts") <= cut)).select(
        F.col("orderid").alias("p_id"), "payment", "paymenttime", "pay_ts")
    if pay_within is None:
        in_window = F.lit(True)
    else:
        lo = F.col("o.order_ts") - F.expr(f"INTERVAL {early_slack}")
        hi = F.col("o.order_ts") + F.expr(f"INTERVAL {pay_within}")
        in_window = F.coalesce((F.col("pay_ts") >= lo) & (F.col("pay_ts") <= hi), F.lit(False))
    judged = (p.join(known, p["p_id"] == known["orderid"], "left")
              .groupBy("p_id").agg(
                  F.max(in_window & F.col("o").isNotNull()).alias("settled"),
                  F.max(F.col("pay_ts").isNotNull()).alias("timed"),
                  F.min(F.struct((~in_window).alias("out"), F.col("pay_ts").isNull().alias("untimed"),
                                 "pay_ts", "payment", "paymenttime")).alias("p")))
    within = F.expr(f"INTERVAL {pay_within or REMIND_AFTER}")
    paid = F.col("p").isNotNull()
    status = (F.when(F.col("settled"), STATUS_PAID)
              .when(F.col("o.order_ts").isNull(), STATUS_UNTIMED)
              .when(paid & F.col("timed"), STATUS_PAID_LATE)
              .when(paid, STATUS_PAID_UNTIMED)
              .when(F.col("o.order_ts") + within < cut, STATUS_REMIND)
              .otherwise(STATUS_PENDING))
    of_orders = known.join(judged, known["orderid"] == judged["p_id"], "left").select(
        "orderid", "o.userid", "o.ordertime", "p.payment", "p.paymenttime", status.alias("status"))
    orphans = judged.join(known, judged["p_id"] == known["orderid"], "left_anti").select(
        F.col("p_id").alias("orderid"), F.lit(None).cast("string").alias("userid"),
        F.lit(None).cast("string").alias("ordertime"), "p.payment", "p.paymenttime",
        F.lit(STATUS_ORPHAN).alias("status"))
    return of_orders.unionByName(orphans)


def carry_forward(status: DataFrame) -> DataFrame:
    """Records to re-publish for the next batch: pending orders go back to
    ``order2`` as ``userId,orderid,nothing,ordertime``; orphan payments to
    ``pay2`` as ``orderid,payment,paymenttime`` -- the leading fields of a
    payment record, so the carried record parses like a fresh one.
    Output: topic, key, value."""
    orders = status.where(F.col("status") == STATUS_PENDING).select(
        F.lit(ORDER_TOPICS[1]).alias("topic"), F.col("orderid").alias("key"),
        F.concat_ws(",", "userid", "orderid", F.lit(CARRIED_ORDER_MARKER),
                    "ordertime").alias("value"))
    pays = status.where(F.col("status") == STATUS_ORPHAN).select(
        F.lit(PAYMENT_TOPICS[1]).alias("topic"), F.col("orderid").alias("key"),
        F.concat_ws(",", "orderid", "payment", "paymenttime").alias("value"))
    return orders.unionByName(pays)


def order_amounts(orders: DataFrame) -> DataFrame:
    """Recompute carriage and amount from a parsed order record.

    Output: orderid, goodsamount, carriage, discountamount, amount (doubles).
    """
    g = F.col("goodsamount").try_cast("double")
    d = F.col("discountamount").try_cast("double")
    return orders.select("orderid", g.alias("goodsamount"), C.carriage(g).alias("carriage"),
                         d.alias("discountamount"), C.order_amount(g, d).alias("amount"))
