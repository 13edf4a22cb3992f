"""Keyed tables: golden rows, ids, constraints, properties."""

import pytest
from pyspark.sql import functions as F

from pagetables import schemas
from pagetables.operators import keyed
from pagetables.operators.numbering import dense_index, rank_in_group
from pagetables.session import fresh_path, shared_dir
from pagetables.sources import sinks
from pagetables.sources.tables import create_if_absent

# The first rows of the entity table.
PEOPLE = [
    ("Nguyen Van An", 20, "IT"), ("Tran Thi Binh", 21, "AI"), ("Le Van Cuong", 20, "SE"),
    ("Pham Thi Dung", 22, "DS"), ("Hoang Van Em", 21, "IT"),
]


@pytest.fixture
def people(spark):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(PEOPLE)], "n int, name string, age int, major string")
    nobody = spark.createDataFrame([], schemas.ENTITY)
    return keyed.assign_ids(rows, [F.col("n")], keyed.high_water(nobody)).drop("n")


def test_first_ids(people):
    assert [tuple(r) for r in people.orderBy("id").collect()] == [(i, *p) for i, p in enumerate(PEOPLE, 1)]


@pytest.mark.parametrize(
    ("needle", "ids"), [("an", [1, 2, 3, 5]), ("VAN", [1, 3, 5]), ("", [1, 2, 3, 4, 5]), ("_", [1, 2, 3, 4, 5])]
)
def test_search(people, needle, ids):
    assert [r.id for r in keyed.search(people, "name", needle).orderBy("id").collect()] == ids


def test_ids_survive_truncate(spark, people):
    mark = keyed.high_water(people)
    emptied = keyed.truncate(people)
    assert emptied.count() == 0
    one = spark.createDataFrame([("New", 30, "IT")], "name string, age int, major string")
    again = keyed.append(emptied, keyed.assign_ids(one, [F.col("name")], mark))
    assert [r.id for r in again.collect()] == [6]
    later = keyed.assign_ids(one, [F.col("name")], keyed.high_water(again, mark.withColumnRenamed("high_water", "id")))
    assert [r.id for r in later.collect()] == [7]


def test_update_writes_every_column(spark, people):
    changes = spark.createDataFrame([(2, "B", None, "X"), (9, "none", 1, "Y")], schemas.ENTITY)
    updated = {r.id: tuple(r)[1:] for r in keyed.update_by_key(people, changes, "id").collect()}
    assert updated[2] == ("B", None, "X")
    assert updated[1] == PEOPLE[0] and len(updated) == 5
    assert [r.id for r in keyed.missing_keys(changes, people, "id").collect()] == [9]


def test_lookup_delete_upsert(spark, people):
    keys = spark.createDataFrame([(2,), (4,), (4,), (8,)], "id bigint")
    assert keyed.lookup(people, "id", 3).first().name == "Le Van Cuong"
    assert keyed.lookup(people, "id", 99).count() == 0
    assert sorted(r.id for r in keyed.lookup_batch(people, keys, "id").collect()) == [2, 4]
    assert sorted(r.id for r in keyed.delete_by_key(people, keys, "id").collect()) == [1, 3, 5]
    changes = spark.createDataFrame([(4, "D", 1, "X"), (8, "H", 2, "Y")], schemas.ENTITY)
    once = keyed.upsert(people, changes, ["id"])
    twice = keyed.upsert(once, changes, ["id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == 6


def test_table_keeps_its_versions_and_its_mark(spark, people):
    root = fresh_path(spark, "people")
    held = keyed.KeyedTable(spark, root, schemas.ENTITY)
    assert (held.version(), held.rows().count(), held.mark().first()[0]) == (0, 0, 0)
    held.commit(people)
    held.commit(held.rows().filter("id < 5"))
    again = keyed.KeyedTable(spark, root, schemas.ENTITY)
    one = spark.createDataFrame([("New", 30, "IT")], "name string, age int, major string")
    grown = again.commit(keyed.append(again.rows(), again.new_rows(one, [F.col("name")])))
    assert sorted(r.id for r in grown.collect()) == [1, 2, 3, 4, 6]
    again.commit(keyed.truncate(grown))
    assert [r.id for r in again.new_rows(one, [F.col("name")]).collect()] == [7]
    assert again.rows(1).count() == 5
    # A commit that broke off before its mark is not there.
    people.write.parquet(f"{root}/rows/version=5")
    assert (again.version(), again.rows().count()) == (4, 0)
    assert again.commit(people).count() == 5


def test_create_if_absent_keeps_the_first_schema(spark):
    path = fresh_path(spark, "t")
    create_if_absent(spark, "entity_once", schemas.ENTITY, path)
    again = create_if_absent(spark, "entity_once", schemas.URLS, path)
    assert again.columns == schemas.ENTITY.names


def test_required(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "a", 1)], "id int, name string, age int")
    found = {r.id: r.reason for r in keyed.check_required(df, ["name", "age"]).collect()}
    assert found == {1: "name is null", 2: "age is null", 3: None}


def test_unique_first_wins_and_nulls_repeat(spark):
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None), (6, "a")]
    df = spark.createDataFrame(rows, "id int, url string")
    kept, rejected = keyed.split_unique(df, ["url"], "id")
    assert sorted(r.id for r in kept.collect()) == [1, 2, 4, 5]
    assert sorted(r.id for r in rejected.collect()) == [3, 6]
    again, none = keyed.split_unique(kept, ["url"], "id")
    assert (again.count(), none.count()) == (4, 0)


def test_duplicate_and_null_keys(spark):
    rows = [("t", 1, "u"), ("t", 1, "u"), ("t", 2, "u"), (None, 1, "u")]
    df = spark.createDataFrame(rows, "cong_cu string, lan int, url string")
    found = {(r.cong_cu, r.lan): r.copies for r in keyed.duplicate_keys(df, schemas.RESULT_KEY).collect()}
    assert found == {("t", 1): 2, (None, 1): 1}


def test_latest_keeps_nulls_of_the_newest(spark):
    rows = [(1, 1, "old"), (1, 2, None), (2, 5, "x")]
    df = spark.createDataFrame(rows, "k int, at int, v string")
    assert sorted(map(tuple, keyed.latest(df, "k", ["at"]).collect())) == [(1, 2, None), (2, 5, "x")]


# ------------------------------------------------------------ numbering

def hot(spark, n=4000):
    """A third of the rows under one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(n).select(key.alias("g"), (F.col("id") * 7919 % n).alias("v"))


def test_dense_index(spark):
    rows = dense_index(hot(spark), [F.col("v").desc()], "i").collect()
    assert [r.i for r in sorted(rows, key=lambda r: -r.v)] == list(range(1, 4001))


def test_rank_in_hot_group_across_blocks(spark):
    numbered = dense_index(hot(spark), [F.col("v")], "i")
    facts = spark.createDataFrame([("hot", 1)], "g string, fact int")
    ranked = rank_in_group(numbered, "g", "i", "r", group_facts=facts, block_rows=64).collect()
    seen = {}
    for row in sorted(ranked, key=lambda r: r.i):
        seen[row.g] = seen.get(row.g, 0) + 1
        assert row.r == seen[row.g]
        assert row.fact == (1 if row.g == "hot" else None)
    assert len(ranked) == 4000


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


# ------------------------------------------------------------ sinks

def test_csv_mark_and_multiline(spark):
    path = fresh_path(spark, "csv")
    rows = [(1, 'a "q"\nb, c'), (2, "đ\\n"), (3, None), (4, "  x ")]
    df = spark.createDataFrame(rows, "id int, t string")
    sinks.write_csv(df.coalesce(1), path)
    raw = spark.read.format("binaryFile").load(path).first().content
    assert bytes(raw).startswith(b"\xef\xbb\xbfid,t")
    back = sinks.read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_json_keeps_text_raw(spark):
    path = fresh_path(spark, "json")
    df = spark.createDataFrame([(1, "Hộp")], "id int, t string")
    sinks.write_json(df, path)
    assert spark.read.text(path).first()[0] == '{"id":1,"t":"Hộp"}'


def test_columns_fixed_and_united(spark):
    a = spark.createDataFrame([(1, "x")], "id int, extra string")
    b = spark.createDataFrame([(2, 3.0)], "id int, price double")
    assert sinks.union_columns(a, b).columns == ["id", "extra", "price"]
    fixed = sinks.fixed_columns(a, schemas.URLS)
    assert fixed.columns == ["id", "url", "danh_muc"]
    assert tuple(fixed.first()) == (1, None, None)
