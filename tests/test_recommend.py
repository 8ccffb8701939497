import random
from collections import Counter
from datetime import datetime
from itertools import combinations

import pytest
from conftest import plan, tuples
from pyspark.sql import functions as F

from rushcart.functions import pairs as pairs_module, products as products_module
from rushcart.functions.pairs import meet
from rushcart.functions.products import largest_products
from rushcart.functions.similar import tail_members
from rushcart.operators import recommend
from rushcart.sources.folders import stored


def shop(seed=1):
    """Small baskets, three huge ones, and one item in nearly every basket."""
    rng = random.Random(seed)
    rows = []
    for order in range(60):
        for item in {0, *rng.sample(range(1, 40), rng.randint(1, 5))} - ({0} if order % 9 == 0 else set()):
            rows.append((order, order % 7, item, rng.randint(1, 3)))
            if rng.random() < 0.2:
                rows.append((order, order % 7, item, 1))
    for order, size in ((100, 40), (101, 35), (102, 30)):
        rows += [(order, 50 + order, item, 2) for item in rng.sample(range(45), size)]
    return rows


def baskets(rows):
    out = {}
    for order, _, item, _ in rows:
        out.setdefault(order, set()).add(item)
    return out


@pytest.mark.parametrize("wide", [1_000, 20, 32, 3])
@pytest.mark.parametrize("least", [1, 2, 3, 4, 9])
def test_pairs_are_whole_whatever_the_basket_size(lines, least, wide):
    rows = shop()
    sets = baskets(rows)
    single = Counter(i for s in sets.values() for i in s)
    pairs = Counter(p for s in sets.values() for p in combinations(sorted(s), 2))
    want = [
        (a, b, n, n / len(sets), n / single[a], n * len(sets) / (single[a] * single[b]))
        for (a, b), n in pairs.items()
        if n >= least
    ]
    got = recommend.item_pairs(lines(rows), least, wide=wide)
    assert tuples(got, "a", "b", "orders", "support", "confidence", "lift") == sorted(want, key=repr)


@pytest.mark.parametrize("wide", [1_000, 12, 2])
@pytest.mark.parametrize("least", [1, 2, 3])
def test_similarity_is_whole_whatever_the_history(lines, least, wide):
    rows = shop(2)
    weight = Counter()
    for _, user, item, quantity in rows:
        weight[user, item] += quantity
    by_user, norm = {}, Counter()
    for (user, item), w in weight.items():
        by_user.setdefault(user, {})[item] = w
        norm[item] += w * w
    users, dot = Counter(), Counter()
    for items in by_user.values():
        for a, b in combinations(sorted(items), 2):
            users[a, b] += 1
            dot[a, b] += items[a] * items[b]
    want = [
        (a, b, n, dot[a, b] / (norm[a] ** 0.5 * norm[b] ** 0.5))
        for (a, b), n in users.items()
        if n >= least
    ]
    got = recommend.item_similarity(recommend.interactions(lines(rows)), least, wide=wide)
    got = tuples(got, "a", "b", "users", "cosine")
    want = sorted(want, key=repr)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(abs(x[3] - y[3]) < 1e-12 for x, y in zip(got, want))


def test_item_sets_of_two_are_the_pairs(lines):
    data = lines(shop())
    sets, rules = recommend.item_sets(data, 4 / 63, 0.1)
    got = {tuple(r["items"]): r["orders"] for r in sets.collect()}
    want = {(r["a"], r["b"]): r["orders"] for r in recommend.item_pairs(data, 4).collect()}
    assert {k: v for k, v in got.items() if len(k) == 2} == want
    assert any(len(k) > 2 for k in got)
    known = {(r["a"], r["b"]): r["confidence"] for r in recommend.item_pairs(data, 4).collect()}
    for r in rules.where("size(antecedent) = 1").collect():
        pair = (r["antecedent"][0], r["consequent"][0])
        assert pair not in known or abs(known[pair] - r["confidence"]) < 1e-12


def test_recommendations_skip_what_a_user_has(spark, lines):
    inter = recommend.interactions(lines([(1, 1, 10, 1), (1, 1, 11, 1), (2, 2, 10, 1)]))
    sim = spark.createDataFrame([(10, 11, 2.0), (10, 12, 2.0), (10, 13, 3.0), (9, 10, 2.0)], "a long, b long, s double")
    got = recommend.recommend(inter, sim, 2, "s")
    assert tuples(got, "user", "item", "rank", "score") == [
        (1, 13, 1, 3.0),
        (1, 9, 2, 2.0),
        (2, 13, 1, 3.0),
        (2, 9, 2, 2.0),
    ]


def test_als_gives_every_user_n_distinct_items_and_repeats_itself(lines):
    inter = recommend.interactions(lines(shop()))
    runs = [recommend.recommend_als(inter.repartition(1), 5, rank=4) for _ in range(2)]
    first, second = (tuples(r, "user", "item", "rank") for r in runs)
    assert first == second
    assert Counter(u for u, _, _ in first) == {u: 5 for u in {r[1] for r in shop()}}
    assert len({(u, i) for u, i, _ in first}) == len(first)


def test_time_split_keeps_every_line_once(lines):
    data = lines(shop())
    train, test = recommend.split_by_time(data, datetime(2024, 2, 1))
    assert train.count() + test.count() == data.count()
    assert train.agg({"ordered_at": "max"}).first()[0] < datetime(2024, 2, 1)
    assert test.agg({"ordered_at": "min"}).first()[0] == datetime(2024, 2, 1)


def test_metrics_by_hand(spark):
    truth = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, 10)], "user long, item long")
    recs = spark.createDataFrame(
        [(1, 10, 1), (1, 99, 2), (1, 11, 3), (2, 99, 1), (3, 10, 1)], "user long, item long, rank int"
    )
    got = recommend.rank_metrics(recs, truth, 3).first()
    ideal = 1 + 1 / 1.584962500721156
    assert (got["users"], got["hit_rate"]) == (2, 0.5)
    assert abs(got["precision"] - (2 / 3) / 2) < 1e-8
    assert abs(got["recall"] - 0.5) < 1e-12
    assert abs(got["ndcg"] - (1.5 / ideal) / 2) < 1e-8


def test_popular_items_respect_the_date_range(lines):
    data = lines([(1, 1, 10, 1), (1, 1, 10, 5), (2, 1, 11, 1), (3, 1, 10, 1)])
    got = recommend.popular_items(data, 5, start=datetime(2024, 1, 2), end=datetime(2024, 1, 4))
    assert tuples(got, "item", "orders") == [(10, 1), (11, 1)]


def test_no_cross_join_and_no_single_partition_for_pairs(lines):
    for wide in (1_000, 3):
        text = plan(recommend.item_pairs(lines(shop()), 2, wide=wide))
        assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("wide", [1_000, 12, 2])
@pytest.mark.parametrize("cosine", [0.05, 0.4, 0.7, 1.0])
@pytest.mark.parametrize("least", [1, 3])
def test_similar_pairs_are_those_of_the_whole_similarity(lines, least, cosine, wide):
    always_together = [(900 + i, 300 + i, item, 2) for i in range(3) for item in (500, 501)]
    inter = recommend.interactions(lines(shop(2) + always_together))
    columns = ("a", "b", "users", "cosine")
    whole = recommend.item_similarity(inter, least).where(F.col("cosine") >= cosine)
    assert whole.count() > 0
    assert tuples(recommend.item_similarity(inter, least, cosine, wide=wide), *columns) == tuples(whole, *columns)


def test_similarity_of_odd_items(spark):
    """Items of length 0 have no cosine; nor has anything where there is nothing."""
    schema = "user long, item long, weight double"
    rows = [(1, 1, 0.0), (2, 1, 0.0), (1, 2, 1.0), (2, 2, 1.0), (1, 3, 2.0), (2, 3, 2.0)]
    assert tuples(recommend.item_similarity(spark.createDataFrame(rows, schema), 1, 0.5), "a", "b", "users") == [(2, 3, 2)]
    assert recommend.item_similarity(spark.createDataFrame([], schema), 1, 0.5).count() == 0
    with pytest.raises(ValueError, match="cosine"):
        recommend.item_similarity(spark.createDataFrame(rows, schema), 1, 0.0)


def test_fewer_rows_are_paired_the_higher_the_cosine(spark):
    """A user who had everything, and many who had little: rows that meet, against all of them."""
    rng = random.Random(4)
    rows = {(0, item) for item in range(400)} | {(1 + rng.randrange(900), rng.randrange(400)) for _ in range(6000)}
    members = stored(spark.createDataFrame([(u, i, 1.0) for u, i in sorted(rows)], "grp long, item long, w double"), "members")
    items = members.groupBy("item").agg(F.count("*").alias("n"), F.sum(F.col("w") * F.col("w")).alias("q"))

    def met(rows):
        return rows.groupBy("grp").agg((F.count("*") * (F.count("*") - 1) / 2).alias("n")).agg(F.sum("n")).first()[0]

    def tails(cosine):
        marked, _ = tail_members(members, items, cosine)
        return met(marked.where(F.col("class") >= F.col("tail")))

    assert met(members) > tails(0.3) > tails(0.6) > tails(0.9)
    assert tails(0.3) < 0.25 * met(members)  # the user with everything is in every head


def products(users, items, had, n):
    out = []
    for user, u in users:
        scores = sorted((-sum(a * b for a, b in zip(u, v)), item) for item, v in items if (user, item) not in had)
        out += [(user, item, -s, rank) for rank, (s, item) in enumerate(scores[:n], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, chunk", [(4_096, 20_000), (7, 5), (1, 1_000)])
def test_largest_products_are_exact(spark, block, chunk):
    rng = random.Random(6)
    vector = lambda size: [float(rng.randrange(-4, 5) * size) for _ in range(3)]
    users = [(u, vector(rng.choice([0, 1, 100]))) for u in range(30)]
    items = [(i, vector(rng.choice([0.25, 1, 64]))) for i in range(60)]
    had = {(u, i) for u in range(30) for i in range(60) if rng.random() < 0.2} | {(3, i) for i in range(60)} | {(4, i) for i in range(2, 60)}
    frames = [spark.createDataFrame(rows, f"{name} long, features array<float>") for rows, name in ((users, "user"), (items, "item"))]
    owned = spark.createDataFrame(sorted(had) + [(1, 9_999)], "user long, item long")
    got = largest_products(*frames, owned, 5, block=block, chunk=chunk)
    assert tuples(got, "user", "item", "score", "rank") == [(u, i, float(s) + 0.0, r) for u, i, s, r in products(users, items, had, 5)]


def test_long_items_settle_most_users(spark, monkeypatch):
    """Items fall off in length, so hardly any user meets more than the first blocks."""
    met = []

    def watched(df, name):
        out = stored(df, name)
        met.extend([out] * (name == "met"))
        return out

    monkeypatch.setattr(products_module, "stored", watched)
    rng = random.Random(7)
    users = spark.createDataFrame([(u, [rng.gauss(0, 1) for _ in range(4)]) for u in range(200)], "user long, features array<float>")
    items = spark.createDataFrame([(i, [rng.gauss(0, 1) * 0.9**i for _ in range(4)]) for i in range(400)], "item long, features array<float>")
    largest_products(users, items, spark.createDataFrame([], "user long, item long"), 3, block=25).count()
    assert sum(df.count() for df in met) <= 3 * 200  # of 16 blocks each


def test_joins_are_dealt_by_the_rows_they_give(spark, lines, monkeypatch):
    """Not by the bytes they read: 60 users with 20 items each are one small file, but 190 pairs each."""
    from rushcart.functions import pairs
    from rushcart.sources import folders

    rows = [(u, u, (u + 3 * i) % 40, 1 + i % 3) for u in range(60) for i in range(20)]
    inter = recommend.interactions(lines(rows))
    plain = sorted(map(tuple, recommend.item_similarity(inter, 2).collect()))
    offers = sorted(map(tuple, recommend.recommend(inter, recommend.item_similarity(inter, 2), 3, "cosine").collect()))
    given = []
    monkeypatch.setattr(folders, "TASK_ROWS", 100)
    monkeypatch.setattr(pairs, "stored", lambda df, name, tasks=1: given.append((name, tasks)) or folders.stored(df, name, tasks=tasks))
    monkeypatch.setattr(recommend, "stored", lambda df, name, tasks=1: given.append((name, tasks)) or folders.stored(df, name, tasks=tasks))
    for wide in (1_000, 7):
        found = recommend.item_similarity(inter, 2, wide=wide)
        assert sorted(map(tuple, found.collect())) == plain
        assert dict(given)["pairs"] >= (114 if wide == 1_000 else 1)
    assert sorted(map(tuple, recommend.recommend(inter, found, 3, "cosine").collect())) == offers
    assert dict(given)["offers"] > 114


def test_stored_deals_its_shuffles_to_so_many_tasks(spark):
    from rushcart.sources.folders import stored

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spread = stored(spark.range(5000).groupBy(F.expr("id % 1000").alias("k")).count(), "spread", tasks=30)
    files = {r[0] for r in spread.selectExpr("input_file_name()").distinct().collect()}
    assert len(files) == 30 and spread.count() == 1000
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_tails_that_hold_most_pairs_are_not_looked_up(lines, monkeypatch):
    """A low threshold rules little out: then all pairs are built once, which gives the same rows."""
    from rushcart.functions import similar
    from rushcart.sources import folders

    rng = random.Random(4)
    inter = recommend.interactions(lines([(u, u, rng.randrange(30), 1 + u % 3) for u in range(40) for _ in range(9)]))
    names = []
    monkeypatch.setattr(similar, "stored", lambda df, name, tasks=1: names.append(name) or folders.stored(df, name, tasks=tasks))
    low = sorted(map(tuple, recommend.item_similarity(inter, 2, 0.1).collect()))
    assert low and "met" not in names
    monkeypatch.setattr(similar, "TAIL_COST", 0)
    assert sorted(map(tuple, recommend.item_similarity(inter, 2, 0.1).collect())) == low
    assert "met" in names


def test_als_computes_its_interactions_once(lines, monkeypatch):
    from rushcart.sources import folders

    names = []
    monkeypatch.setattr(recommend, "stored", lambda df, name, tasks=1: names.append(name) or folders.stored(df, name, tasks=tasks))
    inter = recommend.interactions(lines([(u, u, (u + i) % 5, 1) for u in range(6) for i in range(2)]))
    assert recommend.recommend_als(inter, 2, rank=2, max_iter=1).count() == 12
    assert names == ["interactions"]


def test_the_first_block_stays_small_however_many_items_there_are(spark, monkeypatch):
    """All users meet the first block, so it must not grow with the items; later ones do, and stay few."""
    blocks = []

    def watched(df, name):
        out = stored(df, name)
        blocks.extend([out] * (name == "item-blocks"))
        return out

    monkeypatch.setattr(products_module, "stored", watched)
    monkeypatch.setattr(products_module, "BLOCKS", 4)
    users = [(u, [1.0, u % 3 - 1.0]) for u in range(20)]
    items = [(i, [float(i % 7), float(i % 5 - 2)]) for i in range(400)]
    frames = [spark.createDataFrame(rows, f"{name} long, features array<float>") for rows, name in ((users, "user"), (items, "item"))]
    got = largest_products(*frames, spark.createDataFrame([], "user long, item long"), 3, block=10)
    assert tuples(got, "user", "item", "score", "rank") == products(users, items, set(), 3)
    sizes = [r["count"] for r in blocks[0].groupBy("block").count().orderBy("block").collect()]
    assert sizes[:4] == [10, 20, 40, 80] and sum(sizes) == 400 and len(sizes) <= 7


def test_stretches_of_a_block_are_exact(spark):
    """One block of several stretches, with ties across them and users who had the longest items."""
    rng = random.Random(8)
    vector = lambda size: [float(rng.randrange(-3, 4) * size) for _ in range(3)]
    users = [(u, vector(u % 4)) for u in range(25)]
    items = [(i, vector(rng.choice([1, 2, 3]))) for i in range(1_400)]
    had = {(u, i) for u in range(25) for i in range(1_400) if rng.random() < 0.1 * (u % 3)}
    frames = [spark.createDataFrame(rows, f"{name} long, features array<float>") for rows, name in ((users, "user"), (items, "item"))]
    owned = spark.createDataFrame(sorted(had), "user long, item long")
    for n in (4, 70):
        got = largest_products(*frames, owned.unionByName(owned), n)
        assert tuples(got, "user", "item", "score", "rank") == [(u, i, float(s) + 0.0, r) for u, i, s, r in products(users, items, had, n)]


def met_by_hand(rows):
    groups, n, dot = {}, Counter(), Counter()
    for grp, item, w in rows:
        groups.setdefault(grp, {})[item] = w
    for items in groups.values():
        for a, b in combinations(sorted(items), 2):
            n[a, b] += 1
            dot[a, b] += items[a] * items[b]
    return sorted(((a, b, n[a, b], float(dot[a, b])) for a, b in n), key=repr)


@pytest.mark.parametrize("weight, first", [(1.0, 0), (300.0, -5), (1.0, 2**15 - 4), (-1.0, -(2**16) - 3), (70_000.0, 2**23 - 4), (1.0, 2**31 - 3), (-0.5, 2**40), (2.0**40, 0)])
def test_pairs_are_built_where_they_are_added_up(spark, weight, first):
    """Lists of items travel, in types as small as the values allow; pairs do not."""
    rows = [(g, first + i, weight * (1 + (g + i) % 3)) for g in range(12) for i in range(20) if (g * i) % 4 != 1]
    members = spark.createDataFrame(rows, "grp long, item long, w double")
    met = meet(members, members, ["grp"], F.lit(1), 6)
    assert "Exchange" not in plan(met).split("Generate")[0]
    assert tuples(met, "a", "b", "n", "dot") == met_by_hand(rows)
    assert met.schema["b"].dataType == members.schema["item"].dataType


def test_pairs_of_a_hot_item_are_dealt_to_several_tasks(spark, monkeypatch):
    from rushcart.sources import folders

    rows = [(g, i, 1.0) for g in range(40) for i in {0, *(1 + (g * k) % 30 for k in range(6))}]
    members = spark.createDataFrame(rows, "grp long, item long, w double")
    monkeypatch.setattr(folders, "TASK_ROWS", 50)
    hot = {r["a"]: r["_slices"] for r in pairs_module._hot_items(members, ["grp"]).collect()}
    assert hot[0] >= 4 and min(hot.values()) > 1
    met = meet(members, members, ["grp"], F.lit(1), 16)
    assert tuples(met, "a", "b", "n", "dot") == met_by_hand(rows)
    parts = met.where("a = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_null_items_and_groups_meet_nothing(spark):
    rows = [(1, 5, 2.0), (1, 6, None), (1, None, 1.0), (None, 5, 1.0), (None, 6, 1.0), (2, 5, 3.0), (2, 6, 4.0)]
    members = spark.createDataFrame(rows, "grp long, item long, w double")
    assert tuples(meet(members, members, ["grp"], F.lit(1), 2), "a", "b", "n", "dot") == [(5, 6, 2, 12.0)]
