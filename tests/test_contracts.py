"""Malformed CSV lines, enforced relationships, mergeable distinct counts."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators import fingerprint, sketches
from mercato.operators.joins import contains_other_value, declared_join, require_unique
from mercato.plans.lakehouse import Lakehouse
from mercato.sources import ingest
from tests import fixtures as X

AB = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def write(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)
    return folder


RAGGED = 'b,extra,a\nx,1,1\ny,2,2,3\nz\n"q,r",4,4\n\nw,5,\nbad,6,six\n'


def test_ragged_lines_raise_in_strict_mode(spark, tmpdir_path):
    path = write(f"{tmpdir_path}/t.csv", "p.csv", RAGGED)
    for some in (["a"], ["a", "b"]):                        # however few columns are read
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            ingest.read_csv_text(spark, path, some).collect()
    clean = write(f"{tmpdir_path}/u.csv", "p.csv", 'b,extra,a\nx,1,1\n"q,r",4,4\nw,5,\n')
    good, rejects = ingest.typed(ingest.read_csv_text(spark, clean, ["a", "b"]), AB)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "x"), (4, "q,r"), (None, "w")] and rejects is None


def test_ragged_lines_are_kept_and_counted_in_lenient_mode(spark, tmpdir_path):
    path = write(f"{tmpdir_path}/t.csv", "p.csv", RAGGED)
    good, rejects = ingest.typed(ingest.read_csv_text(spark, path, ["a", "b"], strict=False), AB, strict=False)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "x"), (4, "q,r"), (None, "w")]
    assert sorted(map(tuple, rejects.collect()), key=str) == [
        ("six", "bad", ["a"], None), (None, None, [], "y,2,2,3"), (None, None, [], "z")]
    assert good.count() == 3 and rejects.count() == 3       # counting alone sees them too


def test_headers_are_held_to(spark, tmpdir_path):
    path = write(f"{tmpdir_path}/t.csv", "p1.csv", "a,b\n1,x\n")
    write(path, "p2.csv", "b,a\ny,2\n")                      # another order in another file
    with pytest.raises(Exception, match="header does not conform"):
        ingest.read_csv_text(spark, path, ["a", "b"]).collect()
    with pytest.raises(ValueError, match="no column c"):
        ingest.read_csv_text(spark, path, ["a", "c"])


def test_lenient_load_stores_and_counts_malformed_lines(spark, tmpdir_path):
    from mercato.schemas import BRONZE
    rows = {"clientes": "cus_1,Ana,SP,Brasil,2024-01-01 00:00:00\ncus_2,Bia,SP\n", "produtos": "prd_1,n,c,m,1.5,2024-01-01 00:00:00\n",
            "vendas": "sal_1,2024-01-01 00:00:00,cus_1,prd_1,ecommerce,2,1.5\nsal_2,2024-01-01 00:00:00,cus_1,prd_1,ecommerce,2,1.5,9\nsal_3,never,c,p,e,1,1\n",
            "preco_competidores": "prd_1,A,1.0,2024-01-01 00:00:00\n"}
    for t, lines in rows.items():
        write(f"{tmpdir_path}/{t}.csv", "p.csv", ",".join(BRONZE[t].names) + "\n" + lines)
    counts = ingest.ingest_csv(spark, tmpdir_path, database="bronze_ragged", strict=False)
    assert (counts["clientes"], counts["clientes_rejects"], counts["vendas"], counts["vendas_rejects"], counts["produtos_rejects"]) == (1, 1, 1, 2, 0)
    assert {r.rejected_line for r in spark.table("bronze_ragged.vendas_rejects").collect()} == {None, "sal_2,2024-01-01 00:00:00,cus_1,prd_1,ecommerce,2,1.5,9"}


# --- declared relationships ------------------------------------------------------

def test_declared_join_fails_on_a_repeated_key(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    right = spark.createDataFrame([(1, "one"), (3, "three"), (None, "a"), (None, "b")], "k int, w string")
    got = declared_join(left, right, "k", "left -> right")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "x", "one"), (2, "y", None), (None, "z", None)]
    twice = right.union(spark.createDataFrame([(3, "again")], "k int, w string"))   # a key that no left row has
    for how in ("left", "inner"):
        with pytest.raises(Exception, match=r"left -> right: repeated key \(3\)"):
            declared_join(left, twice, "k", "left -> right", how).write.format("noop").mode("overwrite").save()


def test_uniqueness_rides_on_the_grouping_of_the_dimension(spark):
    dim = spark.range(1000).select((F.col("id") % 100).alias("k"), "id").groupBy("k").agg(F.max("id").alias("v"))
    plan = require_unique(dim, ["k"], "d")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 1


def test_star_join_fails_on_a_repeated_dimension_key(spark):
    bronze = {"clientes": X.customers(spark, X.CUSTOMERS), "produtos": X.products(spark, X.PRODUCTS),
              "vendas": X.sales(spark, X.SALES), "preco_competidores": X.prices(spark, X.PRICES)}
    lh = Lakehouse.from_tables(spark, bronze)
    lh.__dict__["catalog"] = lh.catalog.unionByName(lh.catalog.where("id_produto = 'prd_1'"))
    with pytest.raises(Exception, match="vendas -> produtos: repeated key"):
        lh.sales_detail.count()


# --- mergeable distinct counts ----------------------------------------------------

def test_merged_sketches_estimate_the_union(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(20), rng.choice("xy"), rng.randrange(60_000)) for _ in range(120_000)] + [(0, "x", None)] * 10
    df = spark.createDataFrame(rows, "day int, channel string, buyer int")
    cells = sketches.sketch_cells(df, ["day", "channel"], "buyer")
    assert cells.count() == 40
    for by in (["day"], ["channel"], []):
        got = {tuple(r[c] for c in by): r.n for r in sketches.merge_cells(cells, by).select(*by, sketches.estimate().alias("n")).collect()}
        exact = {}
        for d, c, b in rows:
            exact.setdefault(tuple({"day": d, "channel": c}[x] for x in by), set()).update([] if b is None else [b])
        assert got.keys() == exact.keys()
        assert all(abs(got[k] - len(v)) <= 4 * 1.04 / 2 ** (sketches.LG_K / 2) * len(v) for k, v in exact.items())


def test_sketches_merge_in_any_order(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("c"), (F.col("id") % 1000).alias("v"))
    cells = sketches.sketch_cells(df, ["c"], "v")
    halves = sketches.merge_cells(sketches.merge_cells(cells.withColumn("h", F.col("c") % 2), ["h"]), [])
    assert halves.select(sketches.estimate()).first()[0] == sketches.merge_cells(cells, []).select(sketches.estimate()).first()[0]


# --- fingerprints ------------------------------------------------------------------

def test_fingerprints_do_not_depend_on_order_or_dealing(spark):
    df = spark.range(500).select((F.col("id") % 5).alias("g"), "id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"))
    one = sorted(map(tuple, fingerprint.fingerprints(df.repartition(7), ["g"], ["id", "v"]).collect()))
    assert one == sorted(map(tuple, fingerprint.fingerprints(df.orderBy(F.desc("id")).coalesce(1), ["g"], ["id", "v"]).collect()))
    swapped = spark.createDataFrame([(1, None, 2), (1, 2, None)], "g int, a int, b int")
    prints = [tuple(r) for i in ("a", "b") for r in fingerprint.fingerprints(swapped.where(f"{i} IS NULL"), ["g"], ["a", "b"]).collect()]
    assert prints[0] != prints[1]          # a NULL's place counts


def test_differing_keys_are_named_and_only_their_groups_are_read_again(spark, tmpdir_path):
    rows = [(d, k, f"v{k}") for d in [1, 2, 3, 4, None] for k in range(20)]
    other = [r for r in rows if r != (2, 5, "v5")]                      # one is missing
    other = [(d, k, "changed" if (d, k) == (3, 7) else v) for d, k, v in other] + [(None, 9, "v9"), (5, 1, "new"), (4, 3, None)]
    schema = "day int, k int, v string"
    spark.createDataFrame(rows, schema).write.partitionBy("day").parquet(f"{tmpdir_path}/l")
    left, right = spark.read.parquet(f"{tmpdir_path}/l").select("day", "k", "v"), spark.createDataFrame(other, schema)
    groups = {r.day: (r.difference, r.left_rows, r.right_rows) for r in fingerprint.differing_groups(left, right, ["day"], ["k", "v"]).collect()}
    assert groups == {2: ("different", 20, 19), 3: ("different", 20, 20), None: ("different", 20, 21), 4: ("different", 20, 21), 5: ("only right", 0, 1)}
    keys = {(r.day, r.k): (r.difference, r.left_rows, r.right_rows) for r in fingerprint.differing_keys(left, right, ["day"], ["k"], ["k", "v"]).collect()}
    assert keys == {(2, 5): ("only left", 1, 0), (3, 7): ("different", 1, 1), (None, 9): ("different", 1, 2), (5, 1): ("only right", 0, 1), (4, 3): ("different", 1, 2)}
    assert fingerprint.differing_keys(left, left, ["day"], ["k"], ["k", "v"]).count() == 0


# --- q-gram semi join ----------------------------------------------------------------

def test_rarest_gram_join_equals_nested_loop_on_random_names(spark):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abÀé%_ ") for _ in range(n))
    brands = [word(rng.choice([0, 1, 2, 3, 4, 6])) for _ in range(25)] + [None, "zzzz", "AbA", "aba"]
    data = [(i, rng.choice([None, "", "a", word(rng.randint(0, 14))]), rng.choice(brands)) for i in range(600)]
    df = spark.createDataFrame(data, "id int, name string, brand string")
    got = {r.id for r in contains_other_value(df, ["id"], "name", "brand", df, "brand").collect()}
    held = {b for _, _, b in data if b is not None}
    assert got == {i for i, n, b in data if n is not None and b is not None and any(v != b and v.lower() in n.lower() for v in held)}
    plan = contains_other_value(df, ["id"], "name", "brand", df, "brand")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
