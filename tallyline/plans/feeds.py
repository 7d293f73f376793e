"""Record feeds over the benchmark tables, in Spark and as SQL for the oracle.

Only whole numbers, text and dates go into a record: engines print those alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _record(*fields: Column) -> Column:
    return F.concat_ws(",", *fields).alias("raw")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _day(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _record(
                _text("c_custkey"),
                F.col("c_name"),
                F.concat("c_mktsegment", F.lit(" "), "n_name"),
                F.col("r_name"),
            )
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _record(_text("o_orderkey"), F.col("o_orderpriority"), _day("o_orderdate"), F.col("o_orderstatus"))
    )


def lineitems(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *keep,
        _record(
            _text("l_orderkey"), F.concat("l_returnflag", "l_linestatus"), _day("l_shipdate"), _text("l_linenumber")
        ),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as they are: many lines, any number of commas."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))


# The topic each kind of event is sent to; one of them nobody subscribes to.
EVENT_TOPICS = {"view": "source", "click": "id", "purchase": "name", "signup": "continent", "error": "audit"}


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic messages (topic, partition, offset, value)."""
    topic = F.coalesce(*[F.when(F.col("event_type") == kind, F.lit(name)) for kind, name in EVENT_TOPICS.items()])
    return table(spark, sf_dir, "events").select(
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        _record(
            _text("event_id"), F.col("event_type"), F.col("props"), F.concat(F.lit("user "), _text("user_id"))
        ).alias("value"),
    )


CUSTOMERS_SQL = """
    select concat_ws(',', cast(c_custkey as varchar), c_name, concat(c_mktsegment, ' ', n_name), r_name) as raw
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

ORDERS_SQL = """
    select concat_ws(',', cast(o_orderkey as varchar), o_orderpriority,
                     cast(cast(o_orderdate as date) as varchar), o_orderstatus) as raw
    from orders"""

LINEITEMS_SQL = """
    select l_linenumber, concat_ws(',', cast(l_orderkey as varchar), concat(l_returnflag, l_linestatus),
                     cast(cast(l_shipdate as date) as varchar), cast(l_linenumber as varchar)) as raw
    from lineitem"""

MESSAGES_SQL = f"""
    select case event_type {' '.join(f"when '{k}' then '{t}'" for k, t in EVENT_TOPICS.items())} end as topic,
           0 as "partition", event_id as "offset",
           concat_ws(',', cast(event_id as varchar), event_type, props,
                     concat('user ', cast(user_id as varchar))) as value
    from events"""

LINES_SQL = """
    select doc_id, rtrim(line, chr(13) || chr(10)) as raw
    from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)"""
