"""Schemas of the tables the engine writes and reads back."""

from pyspark.sql import types as T

_S = T.StringType()
_I = T.IntegerType()


def _struct(names, typ=_S):
    return T.StructType([T.StructField(n, typ) for n in names])


# ETL stage 1 output; (year, month, day) are zero-padded partition strings
LOGINFO = _struct(["ip", "district", "sessionid", "datetime", "daystr", "url", "status",
                   "sentBytes", "referal", "userAgent", "year", "month", "day"])

# ETL stage 2 output; (year, month, day) are integers
LOGINFO2 = T.StructType(
    [T.StructField(n, _S) for n in ["ip", "district", "sessionid", "datetime", "daystr",
                                    "columnName", "refererHost", "deviceType"]]
    + [T.StructField(n, _I) for n in ["year", "month", "day"]])

PV_MART = T.StructType(
    [T.StructField("timeid", _S)]
    + [T.StructField(n, _I) for n in ["districtid", "refererhostid", "devicetypeid", "columnid"]]
    + [T.StructField("pv", T.LongType(), False)])

_IDS = [T.StructField(n, _I) for n in ["districtid", "refererhostid", "devicetypeid", "columnid"]]
_DAY = T.StructField("day", _S)
# written marts, partitioned by day
MARTS = {
    "pv_day": T.StructType([T.StructField("timeid", _S), *_IDS, T.StructField("pv", T.LongType()), _DAY]),
    "pv_hour": T.StructType([T.StructField("timeid", _S), *_IDS, T.StructField("pv", T.LongType()), _DAY]),
    "uv_day": T.StructType([T.StructField("timeid", _S), T.StructField("sessionid", _S), *_IDS,
                            T.StructField("uv", T.LongType()), _DAY]),
    "ip_day": T.StructType([T.StructField("timeid", _S), T.StructField("ip", _S), *_IDS, _DAY]),
}

# the first request of a session's minute, and the last request of a session
SESSION_MINUTES = T.StructType([
    T.StructField("sessionid", _S), T.StructField("ts", T.LongType()),
    T.StructField("f", T.StructType([T.StructField("daystr", _S), *_IDS, T.StructField("timeid", _S)]))])
LAST_REQUESTS = T.StructType([T.StructField("sessionid", _S), T.StructField("ts", T.LongType())])

ORDER_RECORD = ["userId", "orderid", "addressId", "ordertime", "goodsamount", "carriage",
                "discountamount", "amount"]
PAYMENT_RECORD = ["orderid", "payment", "paymenttime", "bonus", "paymenttype"]
DELIVERY_RECORD = ["userId", "addressId", "address", "linkman", "phonenum"]
