"""Role union and role aggregation (the user dimension's core).

Each source table is scanned once: commits give authors *and* committers, issues give issue
users *and* assignees, through ``inline(array(struct, struct))`` instead of one scan per role.
The per-branch ``DISTINCT`` of the original formulation is dropped: it is redundant before the
grouping, and each one would cost an exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

USER_COLS = ("user_id", "user_login", "user_type", "user_html_url", "user_role",
             "user_email", "user_name")
GRAIN = ("user_id", "user_login", "user_type", "user_html_url", "user_email", "user_name")

# Role labels and the source columns of each role, in the union's order.
# (role, id, login, type, url, email, name); None = typed NULL.
OWNER_ROLE = [("owner", "owner_id", "owner_login", "owner_type", "owner_url", None, None)]
COMMIT_ROLES = [
    ("author", "author_id", "author_login", "author_type", "author_html_url",
     "author_email", "author_name"),
    ("committer", "committer_id", "committer_login", "committer_type", "committer_html_url",
     "committer_email", "committer_name"),
]
ISSUE_ROLES = [
    ("issue_user", "user_id", "user_login", "user_type", "user_html_url", None, None),
    ("assignee", "assignee_id", "assignee_login", "assignee_type", "assignee_html_url",
     None, None),
]


#: All role labels in ascending order.
ROLES = sorted(s[0] for s in OWNER_ROLE + COMMIT_ROLES + ISSUE_ROLES)


def _role_struct(spec: tuple) -> F.Column:
    role, *cols = spec
    names = [c for c in USER_COLS if c != "user_role"]
    parts = []
    for out, src in zip(names, cols):
        col = F.lit(None).cast("string") if src is None else F.col(src)
        if out == "user_id":
            col = col.cast("bigint")
        elif src is not None:
            col = col.cast("string")
        parts.append(col.alias(out))
    parts.insert(4, F.lit(role).alias("user_role"))
    return F.struct(*parts)


def roles_of(df: DataFrame, specs: Sequence[tuple], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (record, role) whose user id is present, from a single scan of ``df``."""
    if len(specs) == 1:
        out = df.select(*keep, _role_struct(specs[0]).alias("u")).select(*keep, "u.*")
    else:
        out = df.select(*keep, F.inline(F.array(*[_role_struct(s) for s in specs])))
    return out.where(F.col("user_id").isNotNull())


def role_union(repos: DataFrame, commits: DataFrame, issues: DataFrame) -> DataFrame:
    """Bag union of owners, commit authors/committers, issue users/assignees."""
    return (roles_of(repos, OWNER_ROLE)
            .unionByName(roles_of(commits, COMMIT_ROLES))
            .unionByName(roles_of(issues, ISSUE_ROLES)))


def role_aggregate(users: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """Group on the identity grain; roles as a sorted distinct array and their count.

    The roles are a handful of fixed labels, so a group's set is a bit mask folded by
    ``bit_or`` in a code-generated hash aggregate, map side first: an identity holding a third
    of all rows leaves each task with one integer.
    """
    return with_roles(role_masks(users, grain))


def role_masks(users: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """One row per ``grain`` with its roles as the mergeable bit mask ``_mask``."""
    mask = F.lit(0)
    for bit, role in enumerate(ROLES):
        mask = F.when(F.col("user_role") == role, F.lit(1 << bit)).otherwise(mask)
    return users.groupBy(*grain).agg(F.bit_or(mask).alias("_mask"))


def with_roles(masked: DataFrame) -> DataFrame:
    """``_mask`` as the sorted array ``user_roles`` and their ``role_count``."""
    present = F.array_compact(F.array(*[
        F.when(F.col("_mask").bitwiseAND(F.lit(1 << bit)) != 0, F.lit(role))
        for bit, role in enumerate(ROLES)]))
    return (masked.withColumn("user_roles", present)
            .withColumn("role_count", F.bit_count("_mask").cast("bigint"))
            .drop("_mask"))
