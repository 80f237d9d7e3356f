"""Masks, filters, tag policies and access on literal rows."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import governance as g


@pytest.fixture
def stores(spark):
    data = [(5, "East"), (10, "East"), (13, "East"), (11, "North"), (24, "North"), (1, "West"), (2, "South"), (3, "West")]
    return spark.createDataFrame(data, "store_id int, region string")


def test_mapping_rows(spark, stores):
    me = g.Principal("Me@X.example")
    mapping = spark.createDataFrame([("me@x.example", "east"), ("you@x.example", "West")], "user_email string, allowed string")
    seen = g.rows_by_mapping(stores, mapping, "user_email", "allowed", "region", me)
    assert sorted(r["store_id"] for r in seen.collect()) == [5, 10, 13]
    more = mapping.unionAll(spark.createDataFrame([("me@x.example", "North")], mapping.schema))
    seen = g.rows_by_mapping(stores, more, "user_email", "allowed", "region", me)
    assert sorted(r["store_id"] for r in seen.collect()) == [5, 10, 11, 13, 24]


@pytest.fixture
def employees(spark):
    data = [(1, "Ada", "111-22-3333", "CC1", "B1"), (2, None, "222-33-4444", "CC2", "B2")]
    return spark.createDataFrame(data, "emp_id int, employee_name string, ssn string, cost_center string, salary_band string")


TAGS = tuple(
    g.Tag("emp", c, k, v)
    for c, d, s in [
        ("employee_name", "HR", "internal"), ("ssn", "HR", "confidential"),
        ("cost_center", "finance", "internal"), ("salary_band", "finance", "confidential"),
    ]
    for k, v in (("domain", d), ("sensitivity", s))
)


def policies():
    out = []
    for domain, owner in (("HR", "hr_grp"), ("finance", "finance_grp")):
        for level, mask in (("internal", g.first_letter), ("confidential", g.full_mask)):
            out.append(g.Policy(f"{level}_{domain}", "mask", mask, {"domain": domain, "sensitivity": level}, but=(owner,)))
    return out


@pytest.mark.parametrize("groups, want", [
    (("hr_grp",), (1, "Ada", "111-22-3333", "C****", "****")),
    (("finance_grp",), (1, "A****", "****", "CC1", "B1")),
    ((), (1, "A****", "****", "C****", "****")),
    (("hr_grp", "finance_grp"), (1, "Ada", "111-22-3333", "CC1", "B1")),
])
def test_personas(employees, groups, want):
    seen = g.abac_apply(employees, "emp", TAGS, policies(), g.Principal("u", frozenset(groups)))
    assert rows(seen)[0] == want


def test_other_tables_are_untouched(employees):
    assert g.abac_apply(employees, "other", TAGS, policies(), g.Principal("u")) is employees


def test_conflicts(employees):
    twice = [*policies(), g.Policy("extra", "mask", g.full_mask, {"domain": "HR"})]
    with pytest.raises(g.PolicyConflict):
        g.abac_apply(employees, "emp", TAGS, twice, g.Principal("u"))
    filters = [g.Policy(f"f{i}", "filter", lambda c: c.isNotNull(), {"domain": "HR", "sensitivity": "internal"}) for i in range(2)]
    with pytest.raises(g.PolicyConflict):
        g.abac_apply(employees, "emp", TAGS, filters, g.Principal("u"))


def test_row_filter_sees_real_values(employees):
    both = [
        *policies(),
        g.Policy("only", "filter", lambda c: c == "111-22-3333", {"sensitivity": "confidential", "domain": "HR"}, to=("u",)),
    ]
    assert rows(g.abac_apply(employees, "emp", TAGS, both, g.Principal("u"))) == [(1, "A****", "****", "C****", "****")]


def test_type_aware_mask(spark):
    df = spark.sql("SELECT 5 AS i, 2.5D AS d, DATE '2024-01-01' AS t, 'x' AS s, CAST(1.5 AS DECIMAL(5,2)) AS n")
    r = g.mask_by_type(df, ["i", "d", "t", "s", "n"]).first()
    assert (r["i"], r["d"], str(r["t"]), r["s"], float(r["n"])) == (0, 0.0, "1970-01-01", None, 0.0)


def test_coarse_mask(spark):
    df = spark.createDataFrame([(145400.0,)], "x double")
    assert [df.select(g.coarse(F.col("x"), r)).first()[0] for r in ("hr", "manager", "viewer")] == [145400.0, 145000.0, 0.0]


@pytest.fixture
def access(spark):
    tree = spark.createDataFrame([(t, a) for t in ("t1", "t2") for a in (t, "schema", "catalog")], "object string, ancestor string")
    members = spark.createDataFrame([("ann", "ann"), ("ann", "team"), ("bob", "bob")], "user string, principal string")
    grants = spark.createDataFrame(
        [("team", "USE CATALOG", "catalog"), ("team", "USE SCHEMA", "schema"), ("ann", "SELECT", "t1"), ("team", "SELECT", "schema"),
         ("bob", "SELECT", "t1"), ("bob", "USE SCHEMA", "catalog")],
        "principal string, privilege string, object string",
    )
    return grants, tree, members


NEEDS = {"USE CATALOG": [], "USE SCHEMA": [], "SELECT": ["ALL PRIVILEGES"]}


def test_access_needs_the_whole_chain(access):
    grants, tree, members = access
    assert rows(g.effective_access(grants, tree, members, NEEDS)) == [("ann", "t1"), ("ann", "t2")]


def test_revoke_removes_one_level(access):
    grants, tree, members = access
    left = g.revoke(grants, "ann", "SELECT", "t1")
    assert rows(g.effective_access(left, tree, members, NEEDS)) == [("ann", "t1"), ("ann", "t2")]
    left = g.revoke(left, "team", "SELECT", "schema")
    assert rows(g.effective_access(left, tree, members, NEEDS)) == []


def test_all_privileges_imply(access, spark):
    grants, tree, members = access
    more = grants.unionAll(spark.createDataFrame([("bob", "USE CATALOG", "catalog"), ("bob", "ALL PRIVILEGES", "t2")], grants.schema))
    got = rows(g.effective_access(more, tree, members, NEEDS))
    assert ("bob", "t1") in got and ("bob", "t2") in got


def test_conflict_report(spark):
    df = spark.createDataFrame([(1.0, "ab"), (2.5, "AB"), (None, None)], "price double, word string")
    tags = [g.Tag("t", "price", "k", "p"), g.Tag("t", "word", "k", "w")]
    masks = [
        g.Policy("floor", "mask", F.floor, {"k": "p"}), g.Policy("half", "mask", lambda c: F.when(c > 2, 2.0).otherwise(c), {"k": "p"}),
        g.Policy("zero", "mask", lambda c: F.lit(0.0), {"k": "p"}), g.Policy("up", "mask", F.upper, {"k": "w"}),
    ]
    found = g.resolve("t", df.columns, tags, masks, g.Principal("u"))
    assert rows(g.conflict_report(df, found)) == [("price", "floor", "half", 0), ("price", "floor", "zero", 3), ("price", "half", "zero", 3)]
    assert g.conflict_report(df, found[-1:]).collect() == []


def test_a_tag_on_every_column_meets_few_policies(spark):
    """Each policy is looked up by its rarest tag; the result is that of counting all matches."""
    tags = [("t", f"c{i}", "all", "x") for i in range(200)] + [("t", f"c{i}", "mod", str(i % 20)) for i in range(200)]
    tags += [("t", "c7", "one", "y"), ("t", "c7", "one", "y"), ("t", "c9", "one", "z")]
    column_tags = spark.createDataFrame(tags, "table string, column string, tag string, value string")
    wanted = [(f"p{i}", "all", "x") for i in range(30)] + [(f"p{i}", "mod", str(i)) for i in range(30)]
    wanted += [("p7", "one", "y"), ("p9", "one", "y"), ("lone", "all", "x"), ("none", "all", "x"), ("none", "absent", "?"), ("lone", "all", "x")]
    policy_tags = spark.createDataFrame(wanted, "policy string, tag string, value string")
    have = {}
    for t, c, k, v in tags:
        have.setdefault((t, c), set()).add((k, v))
    need = {}
    for p, k, v in wanted:
        need.setdefault(p, set()).add((k, v))
    want = sorted((p, t, c) for p, n in need.items() for (t, c), h in have.items() if n <= h)
    assert rows(g.policy_hits(column_tags, policy_tags)) == want
    candidates = g.policy_candidates(column_tags, policy_tags)
    assert {r["policy"] for r in candidates.filter("tag = 'all'").collect()} == {"lone"}
    assert candidates.count() == 200 + 18 * 10 + 1 + 1


def test_profiled_tags(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("m"), F.when(F.col("id") > 5, 1).alias("g"))
    got = {(r["column"], r["tag"]): r["value"] for r in g.profile_tags(df, "t").collect()}
    assert got[("id", "values")] == "many" and got[("m", "values")] == "few" and got[("g", "gaps")] == "some" and got[("m", "gaps")] == "none"
    columns = g.schema_inventory(spark, {"t": df, "u": df.select("id")})
    found = g.tag_inventory(columns, g.profile_tags(df, "t"))
    assert found.filter("table = 'u'").collect()[0]["tag"] is None and found.count() == 7


def test_all_privileges_do_not_manage(access, spark):
    grants, tree, members = access
    more = grants.unionAll(spark.createDataFrame([("bob", "ALL PRIVILEGES", "catalog"), ("ann", "MANAGE", "t2"), ("team", "MODIFY", "t1")], grants.schema))
    got = set(rows(g.access_levels(more, tree, members)))
    assert {level for user, _, level in got if user == "bob"} == {"browse", "read", "edit"}
    assert ("ann", "t2", "manage") in got and ("ann", "t1", "edit") in got and ("ann", "t2", "edit") not in got


def test_an_owner_is_out_of_some_policies_only(tables):
    from tidemark.plans import policies as p

    found = g.resolve("orders", tables.orders.columns, p.ORDER_TAGS, p._order_policies(), p.TREASURER)
    assert [(policy.name, column) for policy, column in found] == [("buyer_bucket", "o_custkey")]
    seen = p.abac_apply_owner(tables)
    assert seen.count() == tables.orders.count() and seen.filter("o_custkey NOT BETWEEN -15 AND 0").count() == 0
    assert seen.drop("o_custkey").exceptAll(tables.orders.drop("o_custkey")).count() == 0


def test_access_equals_brute_force(spark):
    """Grants of users and groups on objects and parents in all combinations, members and parents listed twice."""
    import random

    rnd = random.Random(5)
    users, groups = [f"u{i}" for i in range(9)], ["g1", "g2", "g3"]
    parents = {f"t{i}": [f"s{i % 3}", f"c{i % 2}"] for i in range(8)} | {"s0": ["c0"], "lone": []}
    tree = [(o, a) for o, up in parents.items() for a in (o, *up)] * 2
    members = [(u, p) for u in users for p in (u, *rnd.sample(groups, rnd.randrange(3)))] * 2
    members = [m for m in members if m != ("u8", "u8")] + [("u7", "u6")]  # one user is not its own principal, one is another's too
    places = sorted({a for _, a in tree})
    privileges = ["BROWSE", "USE CATALOG", "USE SCHEMA", "SELECT", "MODIFY", "MANAGE", "ALL PRIVILEGES", "OTHER"]
    grants = [(rnd.choice(users + groups), rnd.choice(privileges), rnd.choice(places)) for _ in range(150)]
    held = {(u, o, p) for w, p, a in grants for u, x in members if x == w for o, b in tree if b == a}
    want = set()
    for level, needed in g.LEVELS.items():
        for u in users:
            for o in parents:
                if all((u, o, n) in held or (n != "MANAGE" and (u, o, "ALL PRIVILEGES") in held) for n in needed):
                    want.add((u, o, level))
    frames = (
        spark.createDataFrame(grants, "principal string, privilege string, object string"),
        spark.createDataFrame(tree, "object string, ancestor string"), spark.createDataFrame(members, "user string, principal string"),
    )
    got = rows(g.access_levels(*frames))
    assert len(got) == len(set(got)) and set(got) == want
    read = {n: ["ALL PRIVILEGES"] for n in g.LEVELS["read"]}
    assert rows(g.effective_access(*frames, read)) == sorted((u, o) for u, o, level in want if level == "read")


def test_wide_grants_are_not_spread(spark):
    """Everything for a group of 3,000 on a catalog of 3,000 is settled between one team and one class."""
    members = spark.range(3000).selectExpr("concat('u', id) AS user", "explode(array(concat('u', id), 'all')) AS principal")
    tree = spark.range(3000).selectExpr("concat('t', id) AS object", "explode(array(concat('t', id), 'cat')) AS ancestor")
    grants = spark.createDataFrame([("all", "USE CATALOG", "cat"), ("all", "SELECT", "cat")], "principal string, privilege string, object string")
    got = g.effective_access(grants, tree, members, {"USE CATALOG": [], "SELECT": []})
    assert "Exchange hashpartitioning(user" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 9_000_000


def _bytes(paths, wanted):
    import os

    return sum(os.path.getsize(f"{top}/{x}") for path in paths for top, _, names in os.walk(path) for x in names if wanted(x))


def test_grants_that_tell_nothing_take_no_disk_for_long(spark):
    """150,000 grants on objects whose parents nobody may use: neither their table nor their shuffle files stay."""
    import time
    from urllib.parse import urlparse

    from tidemark.session import scratch_folder

    dirs = [d.getAbsolutePath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return _bytes(dirs, lambda x: x.startswith("shuffle_") and x.endswith(".data"))

    members = spark.range(3000).selectExpr("concat('u', id) AS user", "explode(array(concat('u', id), 'all')) AS principal")
    tree = spark.range(3000).selectExpr("concat('t', id) AS object", "explode(array(concat('t', id), 's' || id % 7)) AS ancestor")
    grants = spark.range(150_000).selectExpr("concat('u', id % 3000) AS principal", "'SELECT' AS privilege", "concat('t', id * 7919 % 2999) AS object")
    grants = grants.unionAll(spark.createDataFrame([("u1", "USE SCHEMA", "s1"), ("u2", "USE SCHEMA", "s2")], grants.schema))
    before = shuffled()
    with scratch_folder(spark, "test") as path:
        got = g.effective_access(grants, tree, members, {"USE SCHEMA": [], "SELECT": []})
    for _ in range(50):  # files are deleted behind the scenes
        if shuffled() - before < 300_000:
            break
        time.sleep(0.1)
    assert shuffled() - before < 300_000
    assert _bytes([urlparse(path).path], lambda x: x.endswith(".parquet")) < 300_000
    place = F.expr("int(substr(object, 2)) % 7")
    want = grants.filter("privilege = 'SELECT'").filter(((F.col("principal") == "u1") & (place == 1)) | ((F.col("principal") == "u2") & (place == 2)))
    assert rows(got) == rows(want.select("principal", "object").distinct())


def test_files_of_the_result_are_small(spark, folder):
    """2,000 users see the 2,000 objects of one of 25 schemas each: 4 million rows of repeated values."""
    from urllib.parse import urlparse

    members = spark.range(2000).selectExpr("concat('u', id) AS user", "explode(array(concat('u', id), 'all')) AS principal")
    tree = spark.range(50_000).selectExpr("concat('t', id) AS object", "explode(array(concat('t', id), 's' || id % 25)) AS ancestor")
    grants = spark.range(2000).selectExpr("concat('u', id) AS principal", "'SELECT' AS privilege", "concat('s', pmod(xxhash64(id), 25)) AS object")
    g.effective_access(grants, tree, members, {"SELECT": []}).write.parquet(folder)
    assert spark.read.parquet(folder).distinct().count() == 4_000_000
    assert _bytes([urlparse(folder).path], lambda x: x.endswith(".parquet")) < 4_000_000


def test_one_list_at_a_time(access, spark):
    """Spark holds all that a row becomes in one run of generated code: no list of objects is spread there together with another list."""
    grants, tree, members = access
    more = grants.unionAll(spark.createDataFrame([("team", "BROWSE", "catalog"), ("bob", "ALL PRIVILEGES", "schema")], grants.schema))

    def below(node):
        for i in range(node.children().size()):
            child = node.children().apply(i)
            if child.nodeName() not in ("Union", "Repartition", "RepartitionByExpression"):
                yield child
                yield from below(child)

    def every(node):
        yield node
        for i in range(node.children().size()):
            yield from every(node.children().apply(i))

    df = g.access_levels(more, tree, members)
    lists = [n for n in every(df._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Generate"]
    together = [(a.simpleString(200), b.simpleString(200)) for a in lists for b in below(a) if b.nodeName() == "Generate"]
    assert any("_objects" in n.simpleString(200) for n in lists)
    assert not [p for p in together if "explode(_objects" in p[0] + p[1]]
