from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from veilmark import detect, joins, latest, mask, nested, report
from veilmark.operators import textmatch


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_by_prunes_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    rows = latest.latest_by(df, ["k"], [F.col("id").desc()])
    plan = plan_of(rows)
    assert plan.count("WindowGroupLimit") == 2
    assert {r.k: r.id for r in rows.collect()} == {k: max(i for i in range(100) if i % 7 == k) for k in range(7)}


def test_latest_by_filters_before_ranking_and_keeps_rn(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("b", 1, False)], "k string, v int, ok boolean")
    rows = latest.latest_by(df, ["k"], [F.col("v").desc()], where=F.col("ok"), keep_rn=True).collect()
    assert [(r.k, r.v, r.rn) for r in rows] == [("a", 1, 1)]


def test_missing_update_time_counts_as_floor(spark):
    df = spark.createDataFrame(
        [("a", 1, None, "x"), ("a", 1, "2020-01-01", "y")], "_id string, __v int, updatedAt string, tag string"
    ).withColumns({"updatedAt": F.col("updatedAt").cast("timestamp"), "time_archived": F.lit(None).cast("timestamp")})
    assert latest.latest_by(df, ["_id"], latest.version_order()).first().tag == "y"


def test_partition_count_keeps_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1), (None, 2)], "k string, v int")
    rows = sorted((str(r.k), r.n) for r in latest.partition_count(df, ["k"], "v").collect())
    assert rows == [("None", 2), ("None", 2), ("a", 1), ("a", 1)]


def test_unnest_left_keeps_parents(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None), (4, [9])], "id int, a array<int>")
    inner = nested.unnest(df, "a").select("id", "item").collect()
    left = nested.unnest(df, "a", "left", lambda e: e < 5).select("id", "item").collect()
    assert sorted(map(tuple, inner)) == [(1, 1), (1, 2), (4, 9)]
    assert sorted(map(tuple, left), key=str) == sorted([(1, 1), (1, 2), (2, None), (3, None), (4, None)], key=str)


def test_empty_arrays_replace_nulls(spark):
    df = spark.createDataFrame([(None,), ([1],)], "a array<int>")
    assert [r.a for r in nested.empty_for_null(df).collect()] == [[], [1]]
    grown = df.select(nested.largest(F.array(F.lit(1)), F.col("a")).alias("x")).collect()
    assert [r.x for r in grown] == [[1], [1]]
    assert [r.x for r in df.select(nested.map_array(F.col("a"), lambda e: e * 2).alias("x")).collect()] == [[], [2]]


def test_star_except_rejects_unknown_columns(spark):
    with pytest.raises(ValueError):
        nested.star_except(spark.range(1), "nope")


@pytest.mark.parametrize("share", [None, 0.1])
def test_lookup_join_survives_hot_and_missing_keys(spark, share):
    rng = random.Random(1)
    keys = ["hot"] * 400 + [None] * 400 + [f"k{rng.randrange(50)}" for _ in range(200)]
    left = spark.createDataFrame(list(enumerate(keys)), "id int, k string").repartition(5)
    lookup = spark.createDataFrame([("hot", 1), (None, 5)] + [(f"k{i}", i) for i in range(0, 50, 2)], "key string, v int")
    joined = joins.lookup_join(left, lookup, [(F.col("k"), "key")], hot_share=share, salts=8)
    want = {"hot": 1, **{f"k{i}": i for i in range(0, 50, 2)}}
    got = {r.id: r.v for r in joined.collect()}
    assert joined.columns == ["id", "k", "v"]
    assert got == {i: want.get(k) for i, k in enumerate(keys)}


def test_missing_keys_spread_over_partitions(spark):
    left = spark.range(4000).select("id", F.lit(None).cast("string").alias("k"))
    lookup = spark.createDataFrame([("a", 1)], "key string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.lookup_join(left, lookup, [(F.col("k"), "key")])
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and min(r["count"] for r in sizes) > 700


def test_union_keys_without_frames_is_empty_and_typed(spark):
    empty = joins.union_keys([], [], "k", spark)
    assert empty.columns == ["k"] and empty.count() == 0


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed,share", [(1, None), (2, 0.05), (3, None)])
def test_components_equal_union_find(spark, seed, share):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(200 + i, 201 + i) for i in range(30)]
    df = spark.createDataFrame(edges, "src int, dst int")
    got = {r.node: r.component for r in detect.components(df, hot_share=share).collect()}
    assert got == brute_components(edges)


@pytest.mark.parametrize("seed,share", [(1, None), (2, 0.05)])
def test_extended_components_equal_a_full_run(spark, seed, share):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(7, 7), (300, 300)]
    old, new = edges[:25], edges[25:]
    stored = detect.components(spark.createDataFrame(old, "src int, dst int"))
    added = spark.createDataFrame([*new, (None, 3), (4, None), new[0]], "src int, dst int")
    got = [tuple(r) for r in detect.extend_components(stored, added, share).collect()]
    assert len(got) == len(dict(got)) and dict(got) == brute_components(edges)
    same = detect.extend_components(stored, added.limit(0))
    assert {tuple(r) for r in same.collect()} == set(brute_components(old).items())
    whole = detect.extend_components(stored.limit(0), added)
    assert {tuple(r) for r in whole.collect()} == set(brute_components(new).items())


def test_extending_takes_the_rounds_of_the_new_edges(spark, monkeypatch):
    rounds, stars = [], detect._stars
    monkeypatch.setattr(detect, "_stars", lambda *args: rounds.append(1) or stars(*args))
    chain = [(i, i + 1) for i in range(400)]
    halves = spark.createDataFrame([e for e in chain if e[0] != 200], "src int, dst int")
    stored = detect.components(halves).checkpoint()
    full = len(rounds)
    rounds.clear()
    got = detect.extend_components(stored, spark.createDataFrame([(200, 201)], "src int, dst int"))
    assert {r.component for r in got.collect()} == {0} and got.count() == 401
    # Two stars a round, and the one round that finds nothing to do.
    assert len(rounds) <= 4 < full


def test_reachable_reports_unknown_seeds(spark):
    parts = spark.createDataFrame([("a", "a"), ("b", "a"), ("z", "z")], "node string, component string")
    seeds = spark.createDataFrame([("t.B", 1)], "column_name string, ordinal int")
    assert sorted(r.column_name for r in detect.reachable(parts, seeds).collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="nope"):
        detect.reachable(parts, spark.createDataFrame([("nope", 1)], "column_name string, ordinal int"))


def test_containment(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))) for _ in range(30)]
    n = spark.createDataFrame([(x,) for x in names] + [(None,)], "name string")
    w = spark.createDataFrame([(x,) for x in words] + [("",)], "word string")
    want = {(a, b) for a in names for b in words if b in a}
    pairs = textmatch.containment(n, w)
    assert {tuple(r) for r in pairs.collect()} == want
    assert textmatch.containment(n, w.limit(0)).count() == 0
    assert textmatch.containment(n.limit(0), w).count() == 0
    # Many shards and blocks give the same pairs, each once.
    split = textmatch.containment(n, w, shard_words=4, block_names=30)
    assert sorted(map(tuple, split.collect())) == sorted(want)
    wide = spark.createDataFrame([("Größe \U0001f600x",), ("",)], "name string")
    hits = textmatch.containment(wide, spark.createDataFrame([("öß",), ("\U0001f600",), ("X",)], "word string"))
    assert {r.word for r in hits.collect()} == {"öß", "\U0001f600"}
    # The only rows made are copies of names per shard and of words per block.
    plan = plan_of(textmatch.containment(n, w))
    assert plan.count("Generate") == 2 and "substring" not in plan
    assert "NestedLoop" not in plan_of(pairs) and "Cartesian" not in plan_of(pairs)


def test_lineage_last_alias_and_last_dependency_win(spark):
    models = spark.createDataFrame(
        [
            ("m", "model", "select a as x, b AS x,\n c\nfrom t", ["u1", "u2"]),
            ("n", "model", "SELECT * FROM m", ["m"]),
            ("e", "model", None, ["m"]),
            ("u1", "source", None, []),
        ],
        "model string, resource_type string, sql string, depends_on array<string>",
    )
    columns = spark.createDataFrame(
        [("u1", "b", "S"), ("u2", "b", "T"), ("u1", "c", "I"), ("m", "x", "S"), ("n", "x", "S"), ("q_r", "z", "B")],
        "model string, column_name string, data_type string",
    )
    got = {(r.model, r.target_column): (r.source_model, r.source_column, r.data_type) for r in detect.lineage_edges(models, columns).collect()}
    assert got == {
        ("m", "x"): ("u2", "b", "T"),
        ("m", "c"): ("u1", "c", "I"),
        ("n", "x"): ("m", "x", "S"),
        ("u1", "b"): ("u1", "b", "S"),
        ("u1", "c"): ("u1", "c", "I"),
        ("q_r", "z"): ("q_r", "z", "B"),
    }


def test_exclusion_rules(spark):
    rows = [
        ("num_calls", "STRING"),
        ("is_hashed_x", "STRING"),
        ("is_pep", "BOOL"),
        ("active", "BOOL"),
        ("seen_at", "TIMESTAMP"),
        ("email", "STRING"),
        ("unknown", None),
        ("box", "STRUCT<flag BOOL, x STRING>"),
        ("bag", "ARRAY<STRUCT<x STRING, y INT64>>"),
        ("listed", "STRING"),
    ]
    columns = spark.createDataFrame(rows, "column_name string, data_type string")
    types = spark.createDataFrame([("flag", "bool"), ("x", "STRING")], "key string, data_type string")
    listed = spark.createDataFrame([("listed",)], "column_name string")
    kept = {r.column_name for r in detect.exclude(columns, types, listed).collect()}
    assert kept == {"is_pep", "email", "unknown", "bag"}


def test_tag_tree_first_claim_and_mapped_extras(spark):
    groups = spark.createDataFrame(
        [("ssn", 1, "ssn"), ("ssn", 1, "customer_ssn"), ("name", 2, "customer_ssn"), ("name", 2, "first_name")],
        "seed string, ordinal int, column_name string",
    )
    types = spark.createDataFrame([("ssn", "INT64")], "key string, data_type string")
    mapping = spark.createDataFrame([("name", 0, "person")], "canonical string, ordinal int, alias string")
    rows = detect.tag_tree(groups, types, mapping).collect()
    assert {(r.parent, r.child) for r in rows} == {("customer_ssn", "ssn"), ("first_name", "person")}
    rule = {r.child: r.child_masking_rule for r in rows}
    assert rule == {"ssn": "ALWAYS_NULL", "person": "DEFAULT_MASKING_VALUE"}


def test_masking_defaults_and_refusal(spark):
    df = spark.createDataFrame([(1, "a", 2.5, True)], "n int, s string, d double, b boolean")
    row = mask.apply(df, {"n": "ALWAYS_NULL", "s": "DEFAULT_MASKING_VALUE", "b": "DEFAULT_MASKING_VALUE"}).first()
    assert tuple(row) == (None, "", 2.5, False)
    with pytest.raises(ValueError):
        mask.apply(df, {"n": "SHA256"})


def test_snapshot_diff_labels(spark):
    before = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    after = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    rows = {r.k: (r.before, r.after, r.comparison) for r in report.snapshot_diff(before, after, ["k"]).collect()}
    assert rows == {1: ("a", "N/A", "Changed"), 2: (None, None, "No Change"), 3: ("N/A", "c", "Changed")}


def test_lone_parents_are_no_group_of_names(spark, small):
    from workload import q_catalog

    names = q_catalog.distinct_names(spark, small).collect()
    assert {r.seed for r in names} <= {f"s{i}" for i in range(8)}
    lone = q_catalog.tree_groups(spark, small).filter("seed LIKE 't%'")
    assert lone.count() > 0


@pytest.mark.parametrize("hot_rows", [100_000, 40])
def test_rows_of_hot_partitions_are_dealt_over_tasks(spark, hot_rows):
    from pyspark.sql import functions as F

    # Three keys, one NULL, hold everything; equal rows are among them.
    key = F.when(F.col("id") % 3 != 0, F.concat(F.lit("k"), (F.col("id") % 3).cast("string")))
    df = spark.range(600).select(key.alias("k"), (F.col("id") % 60).alias("v"), F.when(F.col("id") % 5 > 0, 1).alias("c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counted = latest.partition_count(df, ["k"], "c", hot_rows=hot_rows)
        rows = counted.withColumn("task", F.spark_partition_id()).collect()
        listed = latest.collect_over(df, ["k"], "v", hot_rows=hot_rows).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(rows) == len(listed) == 600 and {r.n for r in rows} == {160}
    assert all(r["values"] == [v for v in range(60) if v % 3 == r.v % 3] for r in listed)
    tasks = {k: len({r.task for r in rows if r.k == k}) for k in (None, "k1", "k2")}
    assert all((n == 1) if hot_rows > 600 else (n > 1) for n in tasks.values())


def test_a_star_round_reads_edges_in_one_direction(spark):
    edges = spark.createDataFrame([(3, 1), (5, 3), (9, 5), (9, 1), (7, 6)], "src int, dst int")
    large, small = detect._stars(edges, True, None), detect._stars(edges, False, None)
    assert "Union" not in plan_of(large)
    assert sorted(map(tuple, large.collect())) == [(3, 1), (5, 1), (7, 6), (9, 1), (9, 3)]
    assert sorted(map(tuple, small.collect())) == [(3, 1), (5, 1), (5, 3), (7, 6), (9, 1)]


def test_containment_deals_words_by_their_heads(spark):
    rng = random.Random(9)
    names = sorted({"".join(rng.choice("abcé\n") for _ in range(rng.randrange(1, 15))) for _ in range(300)})
    words = sorted({x[rng.randrange(3) : rng.randrange(4, 12)] for x in names} - {""}) + ["abca" + str(i) for i in range(40)]
    names += [w + "x" for w in words[-5:]]
    n, w = (spark.createDataFrame([(x,) for x in set(xs)], f"{c} string") for xs, c in ((names, "name"), (words, "word")))
    want = sorted((a, b) for a in set(names) for b in set(words) if b in a)
    # Heads split into parts, shards into blocks; each pair comes once.
    for sizes in ((50_000, 200_000), (6, 20), (30, 7)):
        assert sorted(map(tuple, textmatch.containment(n, w, *sizes).collect())) == want
    # A hundred times as many shards: a name visits no more of them than it has runs, besides that of short words.
    many = spark.range(2000).select(F.concat(F.col("id").cast("string"), F.lit("-tail")).alias("word"))
    visits, copies = textmatch._dealt(n, many, 20, 200_000)
    assert visits.count() <= sum(1 + max(len(x) - 3, 0) for x in set(names)) and copies.count() == 2000
