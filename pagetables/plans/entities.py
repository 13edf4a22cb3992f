"""Keyed entity tables: scan, lookup, search, change, constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables import schemas
from pagetables.functions.text import to_int
from pagetables.operators import keyed
from pagetables.operators.numbering import dense_index
from pagetables.plans.registry import plan
from pagetables.session import fresh_path
from pagetables.sources.tables import create_if_absent, table

ENTITY_SQL = "select c_custkey as id, c_name as name, c_nationkey as age, c_mktsegment as major from customer"
SUPPLIER_ROWS_SQL = "select s_name as name, s_nationkey as age, 'SUPPLIER' as major, s_suppkey from supplier"


def entities(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as the entity table."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("age"),
        F.col("c_mktsegment").alias("major"),
    )


def new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as rows to append; ``s_suppkey`` gives their order."""
    return table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("age"),
        F.lit("SUPPLIER").alias("major"),
        "s_suppkey",
    )


@plan(ENTITY_SQL)
def table_create_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "entity")
    name = "entity_" + path.rsplit("-", 1)[1]
    create_if_absent(spark, name, schemas.ENTITY, path)
    entities(spark, folder).select(*schemas.ENTITY.names).write.insertInto(name)
    other = T.StructType([T.StructField("id", T.StringType())])
    create_if_absent(spark, name, other, path)
    # The catalog entry goes; the rows stay where they were written.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schemas.ENTITY).parquet(path)


@plan(ENTITY_SQL)
def scan_project(spark: SparkSession, folder: str) -> DataFrame:
    return entities(spark, folder)


@plan("""
select s_suppkey as id, s_name as name, row_number() over (order by s_suppkey) as place
from supplier
""")
def sorted_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return dense_index(rows, [F.col("id")], "place")


@plan("select o_orderkey, o_custkey, o_orderpriority from orders where o_orderkey = 1000")
def lookup_by_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return keyed.lookup(orders, "o_orderkey", 1000)


@plan("""
select o_orderkey, o_custkey, o_orderpriority from orders
where exists (select 1 from lineitem
              where l_orderkey = o_orderkey and l_returnflag = 'R' and l_quantity = 50)
""")
def lookup_batch(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    wanted = table(spark, folder, "lineitem").filter("l_returnflag = 'R' and l_quantity = 50")
    return keyed.lookup_batch(orders, wanted.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@plan("""
select c_custkey from customer
where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')
""")
def missing_keys(spark: SparkSession, folder: str) -> DataFrame:
    requested = table(spark, folder, "customer")
    urgent = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'")
    return keyed.missing_keys(requested, urgent.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@plan("""
select p_partkey as id, p_name as name from part
where translate(p_name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') like '%r_d%'
""")
def substring_search(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )
    return keyed.search(parts, "name", "R_D")


@plan("""
select (select max(c_custkey) from customer)
       + row_number() over (order by s_acctbal desc, s_suppkey) as id,
       s_name as name, s_suppkey
from supplier
""")
def assign_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "supplier")
    mark = keyed.high_water(entities(spark, folder))
    order = [F.col("s_acctbal").desc(), F.col("s_suppkey").asc()]
    numbered = keyed.assign_ids(rows, order, mark)
    return numbered.select("id", F.col("s_name").alias("name"), "s_suppkey")


@plan(f"""
{ENTITY_SQL}
union all
select (select max(c_custkey) from customer) + row_number() over (order by s_suppkey), name, age, major
from ({SUPPLIER_ROWS_SQL})
""")
def append_rows(spark: SparkSession, folder: str) -> DataFrame:
    old = entities(spark, folder)
    held = keyed.KeyedTable(spark, fresh_path(spark, "entities"), schemas.ENTITY)
    first = held.commit(old)
    return held.commit(keyed.append(first, held.new_rows(new_rows(spark, folder), [F.col("s_suppkey")])))


@plan(f"""
select * from ({ENTITY_SQL}) where id < (select max(c_custkey) from customer)
union all
select (select max(c_custkey) from customer) + row_number() over (order by s_suppkey), name, age, major
from ({SUPPLIER_ROWS_SQL})
""")
def append_after_delete(spark: SparkSession, folder: str) -> DataFrame:
    """The top id is deleted and committed; who opens the table next goes on above it."""
    root = fresh_path(spark, "entities")
    held = keyed.KeyedTable(spark, root, schemas.ENTITY)
    first = held.commit(entities(spark, folder))
    top = held.mark().withColumnRenamed("high_water", "id")
    held.commit(keyed.delete_by_key(first, top, "id"))
    again = keyed.KeyedTable(spark, root, schemas.ENTITY)
    return again.commit(
        keyed.append(again.rows(), again.new_rows(new_rows(spark, folder), [F.col("s_suppkey")]))
    )


UPDATE_SQL = """
select c_custkey as id,
       case when o.o_custkey is not null then 'order ' || o.o_orderkey else c_name end as name,
       case when o.o_custkey is not null then cast(floor(o.o_totalprice) as integer) else c_nationkey end as age,
       case when o.o_custkey is not null then nullif(o.o_orderstatus, 'P') else c_mktsegment end as major
from customer left join (
  select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as newest
  from orders where o_orderpriority = '1-URGENT'
) o on o.o_custkey = c_custkey and o.newest = 1
"""


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    """New values for customers from their newest urgent order; some are null."""
    urgent = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'")
    changes = urgent.select(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("order "), "o_orderkey").alias("name"),
        F.floor("o_totalprice").cast("int").alias("age"),
        F.nullif("o_orderstatus", F.lit("P")).alias("major"),
        "o_orderdate",
        "o_orderkey",
    )
    return keyed.latest(changes, "id", ["o_orderdate", "o_orderkey"])


@plan(UPDATE_SQL)
def update_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.update_by_key(entities(spark, folder), order_changes(spark, folder), "id")


@plan("""
select distinct l_suppkey as id from lineitem where l_quantity = 1
  and l_suppkey not in (select c_custkey from customer where c_mktsegment = 'MACHINERY')
""")
def update_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Changes whose key the table does not hold: reported, nothing changed."""
    asked = table(spark, folder, "lineitem").filter("l_quantity = 1").select(
        F.col("l_suppkey").alias("id")
    )
    held = entities(spark, folder).filter("major = 'MACHINERY'")
    return keyed.missing_keys(asked, held, "id")


@plan(f"""
select * from ({ENTITY_SQL})
where id not in (select o_custkey from orders where o_orderstatus = 'P' and o_orderpriority = '1-URGENT')
""")
def delete_by_key(spark: SparkSession, folder: str) -> DataFrame:
    gone = table(spark, folder, "orders").filter(
        "o_orderstatus = 'P' and o_orderpriority = '1-URGENT'"
    )
    return keyed.delete_by_key(
        entities(spark, folder), gone.select(F.col("o_custkey").alias("id")), "id"
    )


@plan("""
with newest as (
  select o_custkey, 'order ' || o_orderkey as name, cast(floor(o_totalprice) as integer) as age,
         nullif(o_orderstatus, 'P') as major,
         row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n
  from orders where o_orderpriority = '1-URGENT')
select s_suppkey as id, s_name as name, s_nationkey as age, 'SUPPLIER' as major from supplier
where s_suppkey not in (select o_custkey from newest)
union all select o_custkey, name, age, major from newest where n = 1
""")
def upsert_by_key(spark: SparkSession, folder: str) -> DataFrame:
    held = new_rows(spark, folder).select(F.col("s_suppkey").alias("id"), "name", "age", "major")
    return keyed.upsert(held, order_changes(spark, folder).select(*held.columns), ["id"])


@plan("""
select (select max(s_suppkey) from supplier) + row_number() over (order by s_suppkey) as id, s_name as name
from supplier
""")
def truncate_keep_sequence(spark: SparkSession, folder: str) -> DataFrame:
    held = new_rows(spark, folder).select(F.col("s_suppkey").alias("id"), "name", "age", "major")
    mark = keyed.high_water(held)
    emptied = keyed.truncate(held)
    again = keyed.assign_ids(new_rows(spark, folder), [F.col("s_suppkey")], mark)
    return keyed.append(emptied, again.select(*held.columns)).select("id", "name")


@plan("""
select o_orderkey,
  case when o_orderpriority = '4-NOT SPECIFIED' then 'name is null'
       when o_orderstatus = 'P' then 'age is null' end as reason
from orders
""")
def not_null_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("name"),
        F.nullif("o_orderstatus", F.lit("P")).alias("age"),
    )
    return keyed.check_required(rows, ["name", "age"]).select("o_orderkey", "reason")


@plan("""
select doc_id, row_number() over (partition by text order by doc_id) = 1 as kept from documents
""")
def unique_violations(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return keyed.mark_unique(documents, ["text"], "doc_id", columns=["doc_id"])


@plan("""
select l_orderkey, l_linenumber, count(*) as copies from lineitem
group by l_orderkey, l_linenumber having count(*) > 1
""")
def composite_key_violations(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@plan("""
select o_orderkey, try_cast(left(o_orderpriority, 1) as integer) as level,
       try_cast(o_orderpriority as integer) as whole
from orders
""")
def int_coercion(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    prefix = F.concat(F.lit(" "), F.split_part("o_orderpriority", F.lit("-"), F.lit(1)), F.lit("\t"))
    return orders.select(
        "o_orderkey", to_int(prefix).alias("level"), to_int(F.col("o_orderpriority")).alias("whole")
    )
