"""Named queries over the supplied tables, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import configure
from tidemark.sources import tables

# The three interaction views in the SQL dialect of the checking engine.
VIEWS_SQL = """with recursive
ev as (
  select event_id as tie, user_id,
         cast(json_extract_string(props, '$.k') as bigint) as item_id,
         least(10::double, greatest(1::double, ceil(value / 10))) / 2 as rating,
         cast(floor(epoch(ts)) as bigint) as ts
  from events),
ln as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         o_custkey as user_id, l_partkey as item_id,
         ceil(l_quantity / 5) / 2 as rating, cast(epoch(l_shipdate) as bigint) as ts
  from lineitem join orders on l_orderkey = o_orderkey),
it as (
  select p_partkey as item_id, p_name || ' (' || (1950 + p_size) || ')' as title, p_type as genres
  from part)
"""


class Tables:
    """The supplied tables as interactions; nothing is read before it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return tables.event_interactions(self.spark, self.sf_dir)

    @cached_property
    def lines(self) -> DataFrame:
        return tables.line_interactions(self.spark, self.sf_dir)

    @cached_property
    def items(self) -> DataFrame:
        return tables.part_items(self.spark, self.sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over ``Tables``; ``sql`` continues the WITH list or is a SELECT."""

    def wrap(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = VIEWS_SQL + sql
        return build

    return wrap


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types both engines print alike: long, double to six places, text."""
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws(",", F.transform(c, lambda x: x.cast("string")))
        columns.append(c.alias(f.name))
    return df.select(*columns)
