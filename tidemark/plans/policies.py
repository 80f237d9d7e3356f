"""Masks, row filters, tag policies and access over the star-schema tables."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import governance as g
from .registry import query

ANALYST = g.Principal("Customer#000000007", frozenset({"ASIA_readers", "analysts", "building_grp"}))


@query("mask_by_group", "SELECT c_custkey, c_name, '***' AS c_mktsegment FROM customer")
def mask_by_group(t):
    return t.customer.select(
        "c_custkey", g.mask_for_group("c_name", ANALYST, "analysts").alias("c_name"),
        g.mask_for_group("c_mktsegment", ANALYST, "admins").alias("c_mktsegment"),
    )


PLACED = """placed AS (SELECT c.*, r_name FROM customer c JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""


def placed(t):
    where = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return t.customer.join(where, F.col("c_nationkey") == F.col("n_nationkey")).drop("n_nationkey")


@query("mask_by_row_group", f"""
    WITH {PLACED} SELECT c_custkey, r_name, CASE WHEN r_name = 'ASIA' THEN c_name ELSE '***' END AS c_name FROM placed""")
def mask_by_row_group(t):
    return placed(t).select("c_custkey", "r_name", g.mask_by_row_group("c_name", ANALYST, "r_name", "_readers").alias("c_name"))


@query("mask_partial", """
    SELECT c_custkey, left(c_mktsegment, 1) || '****' AS segment, '***-**-' || right(c_name, 4) AS name FROM customer""")
def mask_partial(t):
    return t.customer.select(
        "c_custkey", g.first_letter(F.col("c_mktsegment")).alias("segment"), g.last_digits(F.col("c_name")).alias("name")
    )


@query("mask_coarse", """
    SELECT c_custkey, c_acctbal AS as_hr, round(c_acctbal / 1000) * 1000 AS as_manager, 0.0::DOUBLE AS as_viewer FROM customer""")
def mask_coarse(t):
    balance = F.col("c_acctbal")
    return t.customer.select("c_custkey", *[g.coarse(balance, r).alias(f"as_{r}") for r in ("hr", "manager", "viewer")])


@query("mask_by_type", """
    SELECT o_orderkey, CAST(0 AS BIGINT) AS o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, 0.0::DOUBLE AS o_totalprice, DATE '1970-01-01' AS day
    FROM orders""")
def mask_by_type(t):
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    return g.mask_by_type(df, ["o_custkey", "o_orderstatus", "o_totalprice", "day"])


@query("row_filter_mapping", """
    SELECT s_suppkey, s_name, s_nationkey FROM supplier
    WHERE s_nationkey IN (SELECT c_nationkey FROM customer WHERE lower(c_name) = lower('CUSTOMER#000000007'))""")
def row_filter_mapping(t):
    me = g.Principal("CUSTOMER#000000007")
    mapping = t.customer.select("c_name", F.col("c_nationkey").cast("string").alias("nation"))
    kept = g.rows_by_mapping(t.supplier.withColumn("n", F.col("s_nationkey").cast("string")), mapping, "c_name", "nation", "n", me)
    return kept.select("s_suppkey", "s_name", "s_nationkey")


@query("row_filter_expr", f"""
    WITH {PLACED} SELECT c_custkey, r_name FROM placed WHERE NOT (r_name ILIKE '%EUROPE%')""")
def row_filter_expr(t):
    return g.rows_by_rule(placed(t), "NOT (r_name ILIKE '%EUROPE%')").select("c_custkey", "r_name")


@query("dynamic_view", f"""
    WITH {PLACED} SELECT c_custkey, r_name, '***' AS c_name, c_acctbal FROM placed WHERE r_name = 'ASIA'""")
def dynamic_view(t):
    df = placed(t).select("c_custkey", "r_name", "c_name", "c_acctbal")

    def rows(p):
        return F.lit(True) if p.member("admins") else F.col("r_name").isin([x.removesuffix("_readers") for x in p.groups])

    masks = {
        "c_name": lambda c, p: g.mask_for_group(c, p, "admins"),
        "c_acctbal": lambda c, p: c if p.member("analysts") else F.lit(0.0),
    }
    return g.dynamic_view(df, ANALYST, rows, masks)


#: Who may see what of the orders: prices by band, buyers by bucket, priorities by rank, and days of one half-year.
ORDER_TAGS = (
    g.Tag("orders", "o_totalprice", "measure", "money"), g.Tag("orders", "o_custkey", "link", "buyer"),
    g.Tag("orders", "o_orderpriority", "rank", "urgency"), g.Tag("orders", "o_orderdate", "grain", "day"),
    g.Tag("orders", "o_orderdate", "measure", "time"), g.Tag("orders", None, "stage", "booked"),
)
CLERK = g.Principal("clerk-12", frozenset({"desk"}))
#: Out of most policies, but not of the one that hides buyers.
TREASURER = g.Principal("treasurer-1", frozenset({"desk", "treasury"}))


def _order_policies():
    return (
        g.Policy("price_band", "mask", lambda c: F.floor(c / 25000) * 25000, {"measure": "money"}, but=("treasury",)),
        g.Policy("buyer_bucket", "mask", lambda c: -F.pmod(c, F.lit(16)), {"link": "buyer"}, but=("collections",)),
        g.Policy("rank_only", "mask", lambda c: F.substring(c, 1, 1), {"rank": "urgency"}, to=("desk", "lobby"), but=("treasury",)),
        g.Policy("settled_first_half", "filter", lambda day, status: (F.month(day) <= 6) & (status != "P"),
                 {"grain": "day", "measure": "time"}, but=("treasury",), when={"stage": "booked"}, using=("o_orderstatus",)),
        g.Policy("archive_only", "filter", lambda day: F.year(day) < 1900, {"grain": "day"}, when={"stage": "archived"}),
    )


@query("abac_apply", """
    SELECT o_orderkey, -(o_custkey % 16) AS o_custkey, o_orderstatus, floor(o_totalprice / 25000) * 25000 AS o_totalprice, o_orderdate,
           left(o_orderpriority, 1) AS o_orderpriority
    FROM orders WHERE month(o_orderdate) <= 6 AND o_orderstatus <> 'P'""")
def abac_apply(t):
    return g.abac_apply(t.orders, "orders", ORDER_TAGS, _order_policies(), CLERK)


@query("abac_apply_owner", """
    SELECT o_orderkey, -(o_custkey % 16) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def abac_apply_owner(t):
    return g.abac_apply(t.orders, "orders", ORDER_TAGS, _order_policies(), TREASURER)


@query("abac_conflicts", """
    SELECT 'o_totalprice' AS "column", 'cap' AS first, 'price_band' AS second, true AS refused,
        count(*) FILTER (least(o_totalprice, 90000) IS DISTINCT FROM floor(o_totalprice / 25000) * 25000) AS differing FROM orders
    UNION ALL SELECT 'o_orderpriority', 'rank_only', 'shout', true,
        count(*) FILTER (left(o_orderpriority, 1) IS DISTINCT FROM upper(o_orderpriority)) FROM orders""")
def abac_conflicts(t):
    """The masks that meet on one column, how many rows they would show differently, and whether the table was refused."""
    more = (
        g.Policy("cap", "mask", lambda c: F.least(c, F.lit(90000.0)), {"measure": "money"}),
        g.Policy("shout", "mask", F.upper, {"rank": "urgency"}),
    )
    policies = (*_order_policies(), *more)
    try:
        g.abac_apply(t.orders, "orders", ORDER_TAGS, policies, CLERK)
        refused = False
    except g.PolicyConflict:
        refused = True
    found = g.resolve("orders", t.orders.columns, ORDER_TAGS, policies, CLERK)
    return g.conflict_report(t.orders, found).withColumn("refused", F.lit(refused))


@query("effective_policies", """
    WITH ct AS (SELECT 'part_' || p_partkey AS "table", p_name AS "column", 'brand' AS tag, p_brand AS value FROM part
                UNION ALL SELECT 'part_' || p_partkey, p_name, 'type', p_type FROM part),
         pt AS (SELECT DISTINCT 'mask_' || p_brand AS policy, 'brand' AS tag, p_brand AS value FROM part
                UNION ALL SELECT DISTINCT 'mask_' || p_brand, 'type', 'ECONOMY' FROM part),
         sc AS (SELECT 'mask_' || p_brand AS policy, 'size_' || p_size AS principal, bool_or(p_retailprice > 1300) AS ex
                FROM part GROUP BY ALL)
    SELECT h.policy, "table", "column", principal FROM (
      SELECT policy, "table", "column", count(DISTINCT tag) AS hits FROM ct JOIN pt USING (tag, value) GROUP BY ALL) h
    JOIN sc ON sc.policy = h.policy WHERE hits = 2 AND NOT ex""")
def effective_policies(t):
    part = t.part
    table = F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("table")
    column = F.col("p_name").alias("column")
    tags = part.select(table, column, F.lit("brand").alias("tag"), F.col("p_brand").alias("value")).unionAll(
        part.select(table, column, F.lit("type").alias("tag"), F.col("p_type").alias("value"))
    )
    policy = F.concat(F.lit("mask_"), "p_brand").alias("policy")
    needed = part.select(policy, F.lit("brand").alias("tag"), F.col("p_brand").alias("value")).unionAll(
        part.select(policy, F.lit("type").alias("tag"), F.lit("ECONOMY").alias("value"))
    ).distinct()
    who = F.concat(F.lit("size_"), F.col("p_size").cast("string")).alias("principal")
    scopes = part.select(policy, who, (F.col("p_retailprice") > 1300).alias("excepted"))
    return g.effective_policies(tags, needed, scopes)


def access_frames(t):
    """Region = catalog, nation = schema, supplier = table; customers are users, market segments are groups."""
    catalog = F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))
    schema = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    table = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    user = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    tree = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        table.alias("object"), F.explode(F.array(table, schema, catalog)).alias("ancestor")
    )
    members = t.customer.select(user.alias("user"), F.explode(F.array(user, F.col("c_mktsegment"))).alias("principal"))
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    grants = (
        homes.filter("c_acctbal > 9000").select(F.col("c_mktsegment").alias("principal"), F.lit("USE CATALOG").alias("privilege"), catalog.alias("object"))
        .unionAll(homes.select(user, F.lit("USE SCHEMA"), schema))
        .unionAll(homes.filter("c_acctbal > 5000").select(user, F.lit("ALL PRIVILEGES"), schema))
    )
    bought = t.lineitem.select("l_orderkey", "l_suppkey").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    # Keys are made distinct as numbers; no other grant has this privilege.
    direct = bought.select("o_custkey", "l_suppkey").distinct().select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")), F.lit("SELECT"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    )
    return grants.distinct().unionAll(direct), tree, members


@query("effective_access", """
    WITH home AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
      gr AS (SELECT DISTINCT c_mktsegment AS principal, 'UC' AS need, 'r' || n_regionkey AS obj FROM home WHERE c_acctbal > 9000
        UNION SELECT 'c' || c_custkey, 'US', 'n' || n_nationkey FROM home
        UNION SELECT 'c' || c_custkey, unnest(['UC', 'US', 'SE']), 'n' || n_nationkey FROM home WHERE c_acctbal > 5000
        UNION SELECT 'c' || o_custkey, 'SE', 's' || l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
      tree AS (SELECT 's' || s_suppkey AS obj, unnest(['s' || s_suppkey, 'n' || n_nationkey, 'r' || n_regionkey]) AS anc
               FROM supplier JOIN nation ON s_nationkey = n_nationkey),
      mem AS (SELECT 'c' || c_custkey AS usr, unnest(['c' || c_custkey, c_mktsegment]) AS principal FROM customer)
    SELECT usr AS "user", tree.obj AS "object" FROM gr JOIN tree ON gr.obj = anc JOIN mem USING (principal)
    GROUP BY ALL HAVING count(DISTINCT need) = 3""")
def effective_access(t):
    grants, tree, members = access_frames(t)
    needs = {"USE CATALOG": ["ALL PRIVILEGES"], "USE SCHEMA": ["ALL PRIVILEGES"], "SELECT": ["ALL PRIVILEGES"]}
    return g.effective_access(grants, tree, members, needs)


@query("access_levels", """
    WITH home AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
      gr AS (SELECT DISTINCT c_mktsegment AS principal, 'USE CATALOG' AS privilege, 'r' || n_regionkey AS obj FROM home WHERE c_acctbal > 9000
        UNION SELECT 'c' || c_custkey, 'USE SCHEMA', 'n' || n_nationkey FROM home
        UNION SELECT 'c' || c_custkey, 'ALL PRIVILEGES', 'n' || n_nationkey FROM home WHERE c_acctbal > 5000
        UNION SELECT 'c' || o_custkey, 'SELECT', 's' || l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION SELECT 'c' || c_custkey, 'MODIFY', 'r' || n_regionkey FROM home WHERE c_acctbal BETWEEN 0 AND 3000
        UNION SELECT c_mktsegment, 'BROWSE', 'n' || n_nationkey FROM home WHERE c_acctbal < 0
        UNION SELECT 'c' || c_custkey, 'MANAGE', 'n' || n_nationkey FROM home WHERE c_acctbal > 9500),
      tree AS (SELECT 's' || s_suppkey AS obj, unnest(['s' || s_suppkey, 'n' || n_nationkey, 'r' || n_regionkey]) AS anc
               FROM supplier JOIN nation ON s_nationkey = n_nationkey),
      mem AS (SELECT 'c' || c_custkey AS usr, unnest(['c' || c_custkey, c_mktsegment]) AS principal FROM customer),
      lv(level, need, n) AS (VALUES ('browse', 'BROWSE', 1), ('read', 'USE CATALOG', 3), ('read', 'USE SCHEMA', 3), ('read', 'SELECT', 3),
        ('edit', 'USE CATALOG', 4), ('edit', 'USE SCHEMA', 4), ('edit', 'SELECT', 4), ('edit', 'MODIFY', 4), ('manage', 'MANAGE', 1)),
      held AS (SELECT DISTINCT usr, tree.obj AS obj, privilege FROM gr JOIN tree ON gr.obj = anc JOIN mem USING (principal))
    SELECT usr AS "user", obj AS "object", level FROM held
    JOIN lv ON privilege = need OR (privilege = 'ALL PRIVILEGES' AND need <> 'MANAGE')
    GROUP BY usr, obj, level, n HAVING count(DISTINCT need) = n""")
def access_levels(t):
    grants, tree, members = access_frames(t)
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    user = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    schema, catalog = (F.concat(F.lit(p), F.col(c).cast("string")) for p, c in (("n", "n_nationkey"), ("r", "n_regionkey")))
    more = (
        homes.filter("c_acctbal BETWEEN 0 AND 3000").select(user, F.lit("MODIFY"), catalog)
        .unionAll(homes.filter("c_acctbal < 0").select("c_mktsegment", F.lit("BROWSE"), schema))
        .unionAll(homes.filter("c_acctbal > 9500").select(user, F.lit("MANAGE"), schema))
    )
    return g.access_levels(grants.unionAll(more.distinct()), tree, members)


PROFILED = {
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "labels": ("doc_id", "quality", "toxic"),
}

_TAGGED = " UNION ALL ".join(
    f"""SELECT '{table}' AS "table", '{c}' AS "column", 'values' AS tag,
        CASE WHEN count(DISTINCT {c}) <= 30 THEN 'few' ELSE 'many' END AS value FROM {table}
        UNION ALL SELECT '{table}', '{c}', 'gaps', CASE WHEN count({c}) < count(*) THEN 'some' ELSE 'none' END FROM {table}"""
    for table, columns in PROFILED.items() for c in columns
)


@query("tag_inventory", f"""
    WITH tags AS ({_TAGGED}), held AS (SELECT * FROM tags WHERE tag <> 'values' OR value = 'few'),
    columns AS (SELECT DISTINCT "table", "column" FROM tags)
    SELECT c."table", c."column", tag, value FROM columns c LEFT JOIN held h ON c."table" = h."table" AND c."column" = h."column"
    """)
def tag_inventory(t):
    """Tags earned by the values of four tables, joined with all their columns."""
    tags = reduce(DataFrame.unionAll, [g.profile_tags(getattr(t, name), name) for name in PROFILED])
    columns = g.schema_inventory(t.spark, {name: getattr(t, name) for name in PROFILED})
    return g.tag_inventory(columns, tags.filter("tag <> 'values' OR value = 'few'"))


INVENTORY = {
    **{name: PROFILED[name] for name in ("customer", "supplier")},
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
}

_FILLED = " UNION ALL ".join(
    f"""SELECT '{table}' AS "table", '{c}' AS "column", count({c}) AS n_filled FROM {table}""" for table, columns in INVENTORY.items() for c in columns
)


@query("schema_inventory", f"""
    WITH filled AS ({_FILLED})
    SELECT "table", CAST(ordinal_position AS INT) AS position, "column",
        CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS type, is_nullable = 'YES' AS nullable, n_filled
    FROM filled JOIN information_schema.columns ON table_name = "table" AND column_name = "column" """)
def schema_inventory(t):
    columns = g.schema_inventory(t.spark, {name: getattr(t, name) for name in INVENTORY})
    filled = []
    for name in INVENTORY:
        df = getattr(t, name)
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        filled.append(counts.unpivot([], df.columns, "column", "n_filled").withColumn("table", F.lit(name)))
    return columns.join(reduce(DataFrame.unionByName, filled), ["table", "column"])
