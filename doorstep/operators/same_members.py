"""Which groups of two groupings hold exactly the same members."""

from pyspark.sql import functions as F

from ..sources.stage import materialise
from .skew import fits_broadcast

_SIGNATURE = ["_size", "_h1", "_h2"]


def same_members(rows, first, second, member, within):
    """Pairs (``first``, ``second``) whose member multisets are equal, per ``within``.

    Equal to comparing the two sorted member lists, without building one.  ``rows`` are
    read once: how often each member is in each group of either grouping is stored, and
    so is a group's sum, its number of distinct members and two independent 64-bit hashes
    over (member, how often).  Groups with the same sums form a class; an equi-join of the
    two groupings by class gives the pairs.

    The classes are then confirmed by exact counts: all groups of a class are the same
    if each (member, how often) of the class is in every one of them.  That takes one
    row per group and member, however many pairs there are.  Should hashes have met by
    chance, which one count tells, the groups of just that class are compared member by
    member.

    A null member makes its groups the same as no other; groups without a name are
    left out.
    """
    within = list(within)
    keys = [*within, *_SIGNATURE]
    members = materialise(_members(rows, first, second, member, within), "members")
    sums = materialise(_sums(members, within), "member-sums")
    pairs = _join(_side(sums, 0, "_f"), _side(sums, 1, "_s"), keys)
    found = [*within, "_f", "_s"]

    # Only classes with a group on either side matter.
    classes = sums.groupBy(*keys).agg(
        F.count_if(F.col("_side") == 0).alias("_firsts"), F.count_if(F.col("_side") == 1).alias("_seconds")
    ).where("_firsts > 0 AND _seconds > 0")
    classes = classes.select(*keys, (F.col("_firsts") + F.col("_seconds")).alias("_groups"))
    group = [*within, "_side", "_name"]
    chosen = _join(sums, classes, keys)
    tally = (
        _looked_up(members, chosen, group).groupBy(*keys, "_groups", "_member", "_n")
        .agg(F.count(F.lit(1)).alias("_held"))
    )
    # Hashes that met: none, but for chance.
    mixed = materialise(tally.where("_held <> _groups").select(*keys).distinct(), "mixed")
    if not mixed.isEmpty():
        confirmed = _join(pairs, mixed, keys, "left_anti").select(*found)
        suspects = _looked_up(members, _join(sums, mixed, keys), group)
        pairs = confirmed.unionByName(_compared(suspects, within))
    return pairs.select(*found).withColumnsRenamed({"_f": first, "_s": second})


def _compared(suspects, within):
    """The pairs of groups that are equal member by member."""
    met = _join(
        _side(suspects, 0, "_f"), _side(suspects, 1, "_s").drop("_h1", "_h2"),
        [*within, "_member", "_n", "_size"],
    )
    # groups of one size that met in all of it are equal
    met = met.groupBy(*within, "_f", "_s", "_size").agg(F.count(F.lit(1)).alias("_met"))
    return met.where(F.col("_met") == F.col("_size")).select(*within, "_f", "_s")


def _members(rows, first, second, member, within):
    """How often each member is in each group of either grouping."""
    # names of two types are compared as text
    kinds = {rows.schema[c].dataType.simpleString() for c in (first, second)}
    kind = kinds.pop() if len(kinds) == 1 else "string"
    names = F.array(*[
        F.struct(F.lit(i).alias("_side"), F.col(c).cast(kind).alias("_name"))
        for i, c in enumerate((first, second))
    ])
    return (
        rows.select(*within, F.inline(names), F.col(member).alias("_member"))
        .where(F.col("_name").isNotNull())
        .groupBy(*within, "_side", "_name", "_member")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _sums(members, within):
    """One row per group without a missing member: its size and hashes."""
    return (
        members.groupBy(*within, "_side", "_name")
        .agg(
            F.count(F.lit(1)).alias("_size"),
            F.bit_xor(F.xxhash64("_member", "_n")).alias("_h1"),
            F.bit_xor(F.xxhash64(F.lit("again"), "_n", "_member")).alias("_h2"),
            F.bool_or(F.col("_member").isNull()).alias("_missing"),
        )
        .where(~F.col("_missing"))
        .drop("_missing")
    )


def _side(df, side, name):
    return df.where(F.col("_side") == side).drop("_side").withColumnRenamed("_name", name)


def _looked_up(members, groups, keys):
    """Members with the columns of their group: a large group stays spread if groups are few."""
    if fits_broadcast(groups):
        groups = F.broadcast(groups)
    return _join(members, groups, keys)


def _join(left, right, keys, how="inner"):
    """Equi-join on columns of the same names, a null equal to a null."""
    theirs = right.withColumnsRenamed({k: f"_r{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r{k}"))
    return left.join(theirs, condition, how).drop(*[f"_r{k}" for k in keys])


def same_member_lists(rows, first, second, member, within):
    """The same question by comparing whole sorted lists; for checking small inputs."""
    within = list(within)

    def lists(group, name):
        return (
            rows.groupBy(*within, group)
            .agg(
                F.array_sort(F.collect_list(member)).alias(name),
                F.count_if(F.col(member).isNull()).alias(f"{name}_nulls"),
            )
            .where((F.col(f"{name}_nulls") == 0) & F.col(group).isNotNull())
            .drop(f"{name}_nulls")
        )

    return (
        lists(first, "_a")
        .join(lists(second, "_b"), within)
        .where(F.col("_a") == F.col("_b"))
        .select(*within, first, second)
    )
