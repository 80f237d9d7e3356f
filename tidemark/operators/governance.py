"""Column masks, row filters, tag policies and effective access as DataFrame rules."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize, scratch_folder, settings
from ..sources.swap import remove
from .sizes import broadcast_if_small


@dataclass(frozen=True)
class Principal:
    """Who is asking: a user name and the groups the user belongs to."""

    user: str
    groups: frozenset[str] = frozenset()

    def member(self, group: str) -> bool:
        return group in self.groups


# --- masks -----------------------------------------------------------------


def mask_for_group(column: str | Column, principal: Principal, group: str, constant="***") -> Column:
    """The value for members of the group, a constant for others."""
    col = F.col(column) if isinstance(column, str) else column
    return col if principal.member(group) else F.lit(constant)


def mask_by_row_group(column: str, principal: Principal, key: str, suffix: str, constant="***") -> Column:
    """Like ``mask_for_group``, but the group is named by another column plus a suffix."""
    allowed = sorted(g[: len(g) - len(suffix)] for g in principal.groups if g.endswith(suffix))
    return F.when(F.col(key).isin(allowed), F.col(column)).otherwise(F.lit(constant))


def first_letter(col: Column) -> Column:
    return F.concat(F.left(col, F.lit(1)), F.lit("****"))


def last_digits(col: Column, n: int = 4, fill: str = "***-**-") -> Column:
    return F.concat(F.lit(fill), F.right(col, F.lit(n)))


def constant(text: str) -> Callable[[Column], Column]:
    """A mask that ignores the value; NULL stays NULL only if the caller wants it, so it does not."""
    return lambda col: F.lit(text)


full_mask = constant("****")


def coarse(col: Column, role: str, exact: Sequence[str] = ("admin", "hr"), rounded: Sequence[str] = ("manager",), step: int = 1000) -> Column:
    """Exact, rounded to ``step`` or 0, by role; always numeric."""
    if role in exact:
        return col
    if role in rounded:
        return F.round(col / step) * step
    return F.lit(0.0)


def mask_by_type(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blank values that fit each column's own type: 0, 0.0, 1970-01-01, otherwise NULL."""

    def blank(f: T.StructField) -> Column:
        kind = f.dataType
        if isinstance(kind, (T.IntegralType, T.DecimalType)):
            return F.lit(0).cast(kind)
        if isinstance(kind, T.FractionalType):
            return F.lit(0.0).cast(kind)
        if isinstance(kind, T.DateType):
            return F.lit("1970-01-01").cast(kind)
        return F.lit(None).cast(kind)

    return df.select(*[blank(f).alias(f.name) if f.name in columns else F.col(f.name) for f in df.schema.fields])


# --- row filters -------------------------------------------------------------


def rows_by_mapping(df: DataFrame, mapping: DataFrame, user_col: str, value_col: str, column: str, principal: Principal) -> DataFrame:
    """Rows whose value the mapping table allows for the caller, compared without case."""
    allowed = (
        mapping.filter(F.lower(user_col) == principal.user.lower())
        .select(F.lower(value_col).alias("_allowed"))
        .distinct()
    )
    return df.join(allowed, F.lower(column) == F.col("_allowed"), "left_semi")


def rows_by_rule(df: DataFrame, rule: str) -> DataFrame:
    """Keep rows for which the rule is TRUE."""
    return df.filter(F.expr(rule))


def dynamic_view(df: DataFrame, principal: Principal, row_rule: Callable[[Principal], Column], masks: Mapping[str, Callable[[Column, Principal], Column]]) -> DataFrame:
    """Row rule first, on real values, then the column rules."""
    kept = df.filter(row_rule(principal))
    return kept.select(*[masks[c](F.col(c), principal).alias(c) if c in masks else F.col(c) for c in df.columns])


# --- tag policies ------------------------------------------------------------


@dataclass(frozen=True)
class Tag:
    table: str
    column: str | None  # None tags the table itself
    key: str
    value: str


@dataclass(frozen=True)
class Policy:
    """A mask or row filter that applies where all of ``match`` tags are set.

    ``apply`` takes the matched column (and the columns of ``using``, by name)
    and returns the masked value, or TRUE to keep the row. ``to`` and
    ``but`` name users or groups; ``to`` of ``everyone`` means everyone.
    ``when`` restricts the policy to tables with these tags.
    """

    name: str
    kind: str  # "mask" or "filter"
    apply: Callable[..., Column] = field(compare=False)
    match: Mapping[str, str] = field(default_factory=dict, compare=False)
    to: tuple[str, ...] = ("everyone",)
    but: tuple[str, ...] = ()
    when: Mapping[str, str] = field(default_factory=dict, compare=False)
    using: tuple[str, ...] = ()


class PolicyConflict(ValueError):
    pass


def _names(principal: Principal) -> set[str]:
    return {principal.user, "everyone", *principal.groups}


def _tagged(tags: Sequence[Tag], table: str, column: str | None, wanted: Mapping[str, str]) -> bool:
    have = {(t.key, t.value) for t in tags if t.table == table and t.column == column}
    return all(pair in have for pair in wanted.items())


def resolve(table: str, columns: Sequence[str], tags: Sequence[Tag], policies: Sequence[Policy], principal: Principal) -> list[tuple[Policy, str]]:
    """Policies in force for a caller on a table, with the column each one matched."""
    found = []
    for p in policies:
        names = _names(principal)
        if not names & set(p.to) or names & set(p.but) or not _tagged(tags, table, None, p.when):
            continue
        found += [(p, c) for c in columns if _tagged(tags, table, c, p.match)]
    return found


def check_conflicts(found: Sequence[tuple[Policy, str]]) -> None:
    filters = [p.name for p, _ in found if p.kind == "filter"]
    if len(filters) > 1:
        raise PolicyConflict(f"several row filters: {filters}")
    masks = Counter(c for p, c in found if p.kind == "mask")
    twice = sorted(c for c, n in masks.items() if n > 1)
    if twice:
        raise PolicyConflict(f"several masks on {twice}")


def conflict_report(df: DataFrame, found: Sequence[tuple[Policy, str]]) -> DataFrame:
    """Every two masks on one column, with the rows they would show differently; all pairs in one scan."""
    by_column: dict[str, list[Policy]] = {}
    for p, column in found:
        if p.kind == "mask":
            by_column.setdefault(column, []).append(p)
    pairs = [
        (column, a, b) for column, held in sorted(by_column.items()) for a, b in combinations(sorted(held, key=lambda p: p.name), 2)
    ]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string, first string, second string, differing long")

    def shown(p: Policy, column: str) -> Column:
        return p.apply(F.col(column), *[F.col(c) for c in p.using]).cast(df.schema[column].dataType)

    counted = df.agg(*[F.count_if(~shown(a, c).eqNullSafe(shown(b, c))).alias(f"_{i}") for i, (c, a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(a.name).alias("first"), F.lit(b.name).alias("second"), F.col(f"_{i}").alias("differing"))
        for i, (c, a, b) in enumerate(pairs)
    ]
    return counted.select(F.explode(F.array(*entries)).alias("c")).select("c.*")


def abac_apply(df: DataFrame, table: str, tags: Sequence[Tag], policies: Sequence[Policy], principal: Principal) -> DataFrame:
    """What the caller sees: rows filtered on real values, then masked columns. No match = unchanged."""
    found = resolve(table, df.columns, tags, policies, principal)
    check_conflicts(found)
    masks = {}
    for p, column in found:
        extra = [F.col(c) for c in p.using]
        if p.kind == "filter":
            df = df.filter(p.apply(F.col(column), *extra))
        else:
            masks[column] = p.apply(F.col(column), *extra)
    if not masks:
        return df
    return df.select(
        *[masks[f.name].cast(f.dataType).alias(f.name) if f.name in masks else F.col(f.name) for f in df.schema.fields]
    )


def profile_tags(df: DataFrame, table: str, few: int = 30) -> DataFrame:
    """Tags of every column that its values earn, as rows: how many distinct ones there are, and whether some are NULL."""
    parts = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(df.columns):
        parts += [F.approx_count_distinct(c, 0.02).alias(f"_d{i}"), F.count(c).alias(f"_f{i}")]
    row = df.agg(*parts)
    entries = []
    for i, c in enumerate(df.columns):
        size = F.when(F.col(f"_d{i}") <= few, "few").otherwise("many")
        gaps = F.when(F.col(f"_f{i}") < F.col("_n"), "some").otherwise("none")
        for tag, value in (("values", size), ("gaps", gaps)):
            entries.append(F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.lit(tag).alias("tag"), value.alias("value")))
    return row.select(F.explode(F.array(*entries)).alias("t")).select("t.*")


def tag_inventory(columns: DataFrame, tags: DataFrame) -> DataFrame:
    """Every column with each of its tags; columns without one keep a row without a tag."""
    return columns.select("table", "column").join(tags.select("table", "column", "tag", "value"), ["table", "column"], "left")


def schema_inventory(spark, frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each table."""
    rows = [
        (name, i + 1, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in frames.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "table string, position int, column string, type string, nullable boolean")


# --- policies and grants kept as tables --------------------------------------


def policy_candidates(column_tags: DataFrame, policy_tags: DataFrame) -> DataFrame:
    """Columns that carry the rarest tag of a policy: ``policy, table, column, tag, value``.

    A tag that is on every column meets only the policies that have no rarer one.
    """
    wanted = policy_tags.select("policy", "tag", "value").distinct()
    found = column_tags.groupBy("tag", "value").agg(F.count(F.lit(1)).alias("_n"))
    # A tag no column has comes first: such a policy meets nothing.
    counted = wanted.join(found, ["tag", "value"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    rarest = counted.groupBy("policy").agg(F.min(F.struct("_n", "tag", "value")).alias("r"))
    rarest = rarest.filter("r._n > 0").select("policy", "r.tag", "r.value")
    return column_tags.select("table", "column", "tag", "value").distinct().join(rarest, ["tag", "value"])


def policy_hits(column_tags: DataFrame, policy_tags: DataFrame) -> DataFrame:
    """Columns that carry all tags of a policy: ``policy, table, column``."""
    candidates = policy_candidates(column_tags, policy_tags)
    wanted = policy_tags.select("policy", "tag", "value").distinct()
    needed = wanted.groupBy("policy").agg((F.count(F.lit(1)) - 1).alias("_more"))
    rest = (
        candidates.withColumnRenamed("tag", "_tag").withColumnRenamed("value", "_value")
        .join(wanted, "policy")
        .filter(~(F.col("tag").eqNullSafe(F.col("_tag")) & F.col("value").eqNullSafe(F.col("_value"))))
        .join(column_tags.select("table", "column", "tag", "value").distinct(), ["table", "column", "tag", "value"], "left_semi")
        .groupBy("policy", "table", "column").agg(F.count(F.lit(1)).alias("_held"))
    )
    met = candidates.select("policy", "table", "column").join(needed, "policy").join(rest, ["policy", "table", "column"], "left")
    return met.filter(F.coalesce("_held", F.lit(0)) == F.col("_more")).select("policy", "table", "column")


def policy_scope(scopes: DataFrame) -> DataFrame:
    """Principals a policy is for: ``policy, principal``; one exception takes a principal out."""
    who = scopes.groupBy("policy", "principal").agg(F.max("excepted").alias("_out"))
    return who.filter("NOT _out").select("policy", "principal")


def effective_policies(column_tags: DataFrame, policy_tags: DataFrame, scopes: DataFrame) -> DataFrame:
    """Which policy resolves for which column and principal.

    ``column_tags(table, column, tag, value)``, ``policy_tags(policy, tag,
    value)`` (all must match), ``scopes(policy, principal, excepted)``. The two
    sides stay apart in ``policy_hits`` and ``policy_scope``; this is their join.
    """
    return policy_hits(column_tags, policy_tags).join(policy_scope(scopes), "policy")


def _mask_of(wanted: Sequence[tuple[int, Sequence[str]]], privilege: str) -> int:
    """Bits of the needs that a privilege meets."""
    return sum(1 << bit for bit, by in wanted if privilege in by)


def access_by_class(grants: DataFrame, hierarchy: DataFrame, members: DataFrame, levels: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """``(user, object, level)`` for every level all of whose needed privileges a user holds on an object.

    ``grants(principal, privilege, object)``; ``hierarchy(object, ancestor)``
    lists for every object itself and its parents; ``members(user, principal)``
    lists for every user the user and its groups. ``levels`` maps a level to
    its needs, each with the privileges that imply it.

    Users with the same groups form a team, objects with the same parents a
    class. Needs met are bits, kept where grants put them: between teams and
    classes, users and classes, teams and objects, users and objects. A wide
    grant such as a catalog for everyone is a few rows that way. Each level of
    a pair is told by the widest of the four that settles it, so that only
    rows of the result are ever spread over users and objects, each once.

    Grants of a user on an object, mostly the bulk, are stored once and
    shuffled once, by user; those that tell no level go in that same stage.
    """
    spark = grants.sparkSession
    bits: dict[tuple[str, tuple[str, ...]], int] = {}
    asked = {}
    for level, needs in levels.items():
        asked[level] = sum(1 << bits.setdefault((need, tuple(sorted({need, *by}))), len(bits)) for need, by in needs.items())
    if len(bits) > 63 or len(levels) > 63:
        raise ValueError("more than 63 different needs or levels")
    wanted = [(bit, by) for (_, by), bit in bits.items()]
    names = sorted({p for _, by in wanted for p in by})
    if not names or not all(asked.values()):
        raise ValueError("a level without needs")

    def met(*masks: str) -> Column:
        """Bits of the levels that the masks together meet."""
        held = reduce(Column.bitwiseOR, [F.coalesce(F.col(m), F.lit(0).cast("long")) for m in masks])
        return reduce(Column.bitwiseOR, [F.when(held.bitwiseAND(F.lit(n)) == n, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, n in enumerate(asked.values())])

    def without(some: Column, others: Column) -> Column:
        return some.bitwiseAND(F.bitwise_not(others))

    def stored(df: DataFrame, name: str) -> DataFrame:
        """As a table; its shuffle files go at once, and a join on several columns keeps rows where the first of them put them."""
        with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.requireAllClusterKeysForCoPartition": "false"}):
            return materialize(df, name)

    def kinds(pairs: DataFrame, one: str, other: str, kind: str) -> tuple[DataFrame, DataFrame]:
        """Members of ``one`` with their kind and whether they list themselves, and what the kinds list besides; a kind goes by its smallest member."""
        sets = pairs.filter(F.col(one).isNotNull()).groupBy(one).agg(
            F.array_sort(F.collect_set(F.when(F.col(one) != F.col(other), F.col(other)))).alias("_set"),
            F.coalesce(F.max(F.col(one) == F.col(other)), F.lit(False)).alias("_self"),
        )
        sets = stored(sets, "sets")
        found = stored(sets.groupBy("_set").agg(F.min(one).alias(kind)), "kinds")
        every = stored(sets.join(found, "_set").select(one, kind, "_self"), "members")
        return every, found.select(kind, F.explode("_set").alias(other))

    def some(df: DataFrame, told: Column) -> DataFrame:
        return df.withColumn("told", told).filter("told <> 0")

    def by_level(df: DataFrame) -> DataFrame:
        """A row for each level told."""
        if len(levels) == 1:
            return df.withColumn("level", F.lit(next(iter(levels)))).drop("told")
        told = [F.when(F.col("told").bitwiseAND(F.lit(1 << i)) != 0, F.lit(level)) for i, level in enumerate(levels)]
        return df.withColumn("level", F.explode(F.array_compact(F.array(*told)))).drop("told")

    # Members of a class or team in lists of bounded length: a row with a list stands for many results. Lengths are multiples of 8
    # but for a rest, as the numbers files hold for values are packed by eights: a list written again then gives the same bytes.
    def lists(df: DataFrame, kind: str, one: str, length: int) -> DataFrame:
        slot = F.pmod(F.xxhash64(one), F.greatest(F.lit(1), (F.col("_n") / length).cast("long")))
        sized = df.join(df.groupBy(kind).agg(F.count(F.lit(1)).alias("_n")), kind)
        whole = sized.groupBy(kind, slot.alias("_slot")).agg(F.collect_list(one).alias("_all")).withColumn("_even", F.expr("int(size(_all) div 8 * 8)"))
        parts = [F.struct((F.col("_slot") * 2 + i).alias(f"_{kind}_slot"), F.slice("_all", F.col("_even") * i + 1, n).alias(f"_{one}s")) for i, n in ((0, F.col("_even")), (1, F.lit(7)))]
        return stored(whole.select(kind, F.inline(F.array(*parts))).filter(F.size(f"_{one}s") > 0), "lists")

    mask = reduce(lambda c, p: c.when(F.col("privilege") == p, F.lit(_mask_of(wanted, p)).cast("long")), names, F.when(F.lit(False), F.lit(0).cast("long")))
    with scratch_folder(spark, "access") as passing:
        held = stored(grants.filter(F.col("privilege").isin(names)).select("principal", F.col("object").alias("ancestor"), mask.alias("m")), "grants")
        users, teams = kinds(members, "user", "principal", "team")
        objects, classes = kinds(hierarchy, "object", "ancestor", "class")
        own_users, own_objects = users.filter("_self").select("user", "team"), objects.filter("_self").select("object", "class")

        # Grants of groups and on parents, to look up apart from the bulk.
        groups, parents = (broadcast_if_small(df.select(c).distinct().withColumn(f"_{c}", F.lit(True))) for df, c in ((teams, "principal"), (classes, "ancestor")))
        wide = stored(held.join(groups, "principal", "left").join(parents, "ancestor", "left").filter("_principal OR _ancestor"), "wide")
        to_groups, on_parents = wide.filter("_principal"), wide.filter("_ancestor").join(broadcast_if_small(classes), "ancestor")

    def laid(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return stored(df.groupBy(*keys).agg(F.bit_or("m").alias(name)), name)

    tc = laid(on_parents.filter("_principal").join(broadcast_if_small(teams), "principal"), ["team", "class"], "tc")
    uc = laid(on_parents.join(own_users.withColumnRenamed("user", "principal"), "principal").withColumnRenamed("principal", "user"), ["user", "team", "class"], "uc")
    to = to_groups.withColumnRenamed("ancestor", "object").join(own_objects, "object").join(broadcast_if_small(teams), "principal")
    to = laid(to, ["team", "object", "class"], "to")

    # What users hold on objects themselves: only where it could tell a level together with anything the team holds on objects.
    most = broadcast_if_small(to.groupBy("team").agg(F.bit_or("to").alias("_most")))
    near = held.select(F.col("principal").alias("user"), F.col("ancestor").alias("object"), "m").repartition("user")
    near = near.groupBy("user", "object").agg(F.bit_or("m").alias("uo")).join(own_users, "user").join(broadcast_if_small(own_objects), "object")
    near = near.join(uc, ["user", "team", "class"], "left").join(broadcast_if_small(tc), ["team", "class"], "left").join(most, "team", "left")
    near = stored(near.filter(without(met("uo", "uc", "tc", "_most"), met("uc", "tc")) != 0).drop("_most"), "near")

    object_lists, user_lists = lists(objects, "class", "object", 1000), lists(users, "team", "user", 100)
    remove(spark, passing)

    # Few rows become many below, so they are dealt to all tasks first. Spark holds all that a row becomes within one run of generated
    # code: a row meets one list there, and lists of users are through a union or shuffle before they meet those of objects.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tc_small, to_small = broadcast_if_small(tc), broadcast_if_small(to)
    object_slots, user_slots = (broadcast_if_small(df.drop(c)) for df, c in ((object_lists, "_objects"), (user_lists, "_users")))
    all_of = broadcast_if_small(by_level(some(tc, met("tc")).drop("tc")).join(object_slots, "class"))
    all_of = user_lists.repartition(tasks).join(all_of, "team").select(F.explode("_users").alias("user"), "class", "_class_slot", "level")
    below = some(uc.join(tc_small, ["team", "class"], "left"), without(met("uc", "tc"), met("tc"))).select("user", "class", "told")
    # Rows of one list follow each other, in one task or a few, so that files of the result repeat few values and stay small.
    below = by_level(below).join(object_slots, "class").repartitionByRange(tasks, F.col("class"), F.expr("_class_slot div 2"), F.col("user"))
    below = below.sortWithinPartitions("class", "_class_slot", "level")
    in_class = all_of.unionByName(below).join(broadcast_if_small(object_lists), ["class", "_class_slot"])
    in_class = in_class.select("user", F.explode("_objects").alias("object"), "level")
    single = some(to.join(tc_small, ["team", "class"], "left"), without(met("to", "tc"), met("tc"))).withColumnRenamed("told", "_t")
    single = single.join(user_slots, "team").repartition(tasks).join(broadcast_if_small(user_lists), ["team", "_team_slot"])
    single = single.select(F.explode("_users").alias("user"), "object", "team", "class", "tc", "_t").join(uc, ["user", "team", "class"], "left")
    single = some(single, without(F.col("_t"), met("uc", "tc"))).select("user", "object", "told")
    both = to.join(uc, ["team", "class"]).join(tc_small, ["team", "class"], "left")
    both = some(both, without(met("to", "uc", "tc"), met("to", "tc").bitwiseOR(met("uc", "tc")))).select("user", "object", "told")
    apart = near.join(to_small, ["team", "object", "class"], "left")
    apart = some(apart, without(met("uo", "to", "uc", "tc"), met("to", "uc", "tc"))).select("user", "object", "told")
    return reduce(DataFrame.unionByName, [in_class, *(by_level(df) for df in (single, both, apart))])


def effective_access(grants: DataFrame, hierarchy: DataFrame, members: DataFrame, needs: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(user, object)`` pairs for which every needed privilege is held.

    Frames as in ``access_by_class``. ``needs`` maps a privilege to the
    privileges that imply it.
    """
    return access_by_class(grants, hierarchy, members, {"all": needs}).select("user", "object")


#: Levels of access and the privileges each needs; all privileges together imply every one but the right to manage.
LEVELS = {
    "browse": ("BROWSE",),
    "read": ("USE CATALOG", "USE SCHEMA", "SELECT"),
    "edit": ("USE CATALOG", "USE SCHEMA", "SELECT", "MODIFY"),
    "manage": ("MANAGE",),
}


def access_levels(
    grants: DataFrame, hierarchy: DataFrame, members: DataFrame, levels: Mapping[str, Sequence[str]] = LEVELS, all_but: Sequence[str] = ("MANAGE",)
) -> DataFrame:
    """``(user, object, level)`` for every level of which a user holds all privileges on an object.

    Frames as in ``access_by_class``. ``ALL PRIVILEGES`` implies each privilege
    that is not in ``all_but``. All levels are found in one go.
    """
    wanted = {level: {n: [] if n in all_but else ["ALL PRIVILEGES"] for n in needed} for level, needed in levels.items()}
    return access_by_class(grants, hierarchy, members, wanted)


def revoke(grants: DataFrame, principal: str, privilege: str, obj: str) -> DataFrame:
    """Grants without one entry; the same privilege granted on a parent stays."""
    gone = (F.col("principal") == principal) & (F.col("privilege") == privilege) & (F.col("object") == obj)
    return grants.filter(~F.coalesce(gone, F.lit(False)))
