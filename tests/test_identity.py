"""Identity resolution and the coarser grains of the user dimension."""

import random

import pytest
from pyspark.sql import functions as F

from sediment.operators import identity
from sediment.plans import silver

IDS = "user_id long, user_login string, user_email string"


def roots(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {x: find(x) for x in root if find(x) != x}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "cycle", "none"])
def test_contraction_finds_the_components(spark, kind):
    rng = random.Random(3)
    n = 200
    pairs = {"chain": [(i, i + 1) for i in range(n)], "star": [(77, i) for i in range(n)],
             "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(120)],
             "cycle": [(i, (i * 7 + 3) % 40) for i in range(40)], "none": []}[kind]
    if kind == "chain":
        rng.shuffle(pairs)
    got = identity.contract(spark.createDataFrame(pairs, "u long, v long"))
    assert {r["u"]: r["root"] for r in got.collect()} == roots(p for p in pairs if p[0] != p[1])


def test_people(spark):
    rows = [(5, "Ann", "a@x.org"), (5, "ann2", None), (7, None, " A@X.org "), (9, "ann2", ""), (11, "bob", "  "),
            (12, "carl", None), (None, "bob", "a@x.org"), (13, "", ""), (14, " ", " ")]
    got = identity.people(spark.createDataFrame(rows, IDS)).collect()
    assert {tuple(r) for r in got} == {(7, 5), (9, 5)}


def test_values_of_many_ids_link_nobody(spark):
    rows = [(i, f"u{i}", "noreply@x.org") for i in range(6)] + [(100, "u3", None)]
    df = spark.createDataFrame(rows, IDS)
    assert {tuple(r) for r in identity.people(df, max_ids=5).collect()} == {(100, 3)}
    assert {r["person_id"] for r in identity.people(df, max_ids=6).collect()} == {0}
    hot = identity.shared_values(df).where("ids > 5").collect()
    assert [(r["kind"], r["value"], r["ids"], r["lowest"]) for r in hot] == [("user_email", "noreply@x.org", 6, 0)]


def test_a_hot_value_is_cut_below_the_exchange(spark):
    pairs = spark.createDataFrame([(i, "user_email", "noreply@x.org") for i in range(1000)],
                                  "id long, kind string, value string")
    found = identity._to_lowest(pairs, 20)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    order = ["Final" if "Final" in x else "Partial" if "Partial" in x else "Exchange" for x in limits]
    at = order.index("Final")
    assert order[at:at + 3] == ["Final", "Exchange", "Partial"], limits


def test_a_third_of_all_rows_on_one_value(spark):
    """The hot address is left out before anything is joined on it."""
    ids = spark.range(30_000).select(F.col("id").alias("user_id"), F.concat(F.lit("u"), F.col("id") % 10_000).alias(
        "user_login"), F.when(F.col("id") % 3 == 0, F.lit("noreply@x.org")).alias("user_email"))
    got = identity.people(ids)
    assert got.count() == 20_000
    assert got.where("person_id != user_id % 10000").isEmpty()
    assert identity.links(ids).groupBy("v").count().agg(F.max("count")).first()[0] <= identity.MAX_IDS


def frames(spark):
    repo = "owner_id long, owner_login string, owner_type string, owner_url string"
    both = ", ".join(f"{p}_id long, {p}_login string, {p}_type string, {p}_html_url string, {p}_email string, "
                     f"{p}_name string" for p in ("author", "committer"))
    issue = ", ".join(f"{p}_id long, {p}_login string, {p}_type string, {p}_html_url string" for p in ("user", "assignee"))
    repos = [(3, "ann", None, "u3"), (None, "nobody", "User", None)]
    commits = [(1, "ann-old", "User", "u1", "ann@x.org", " ", 9, "zed", "Bot", "u9", None, None),
               (2, "ann", "User", "u2", "ANN@x.org", "Ann", 9, "zed", "Bot", "u9", "", "Zed")]
    issues = [(1, "ann-old", "User", "u1", 3, "ann", None, "u3")]
    return (spark.createDataFrame(repos, repo), spark.createDataFrame(commits, both),
            spark.createDataFrame(issues, issue))


def test_grains_of_the_user_dimension(spark):
    made = {g: silver.dim_users(*frames(spark), grain=g).collect() for g in ("identity", "user", "person")}
    assert [len(made[g]) for g in ("identity", "user", "person")] == [6, 4, 2]
    ann, zed = sorted(made["person"], key=lambda r: r["user_id"])
    assert (ann["user_id"], ann["user_login"], ann["user_email"], ann["user_name"]) == (1, "ann-old", "ANN@x.org", "Ann")
    assert ann["user_roles"] == ["assignee", "author", "issue_user", "owner"] and ann["role_count"] == 4
    assert (ann["identity_count"], ann["id_count"]) == (4, 3)
    assert (zed["user_id"], zed["user_type"], zed["user_name"], zed["user_email"]) == (9, "Bot", "Zed", "No email available")
    with pytest.raises(ValueError):
        silver.dim_users(*frames(spark), grain="login")
