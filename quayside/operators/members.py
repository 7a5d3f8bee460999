"""Changes between two user snapshots, and the portal rows that follow from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.conditions import is_true
from quayside.functions.dates import day_label, ntz
from quayside.plans.settle import settle

# Change kinds, and the action each is logged under.
NEW = "NEW"
ACTIVATED = "ACTIVATED"
TRANSFERRED = "TRANSFERRED"
LEFT = "LEFT"
ACTIONS = {NEW: "NEW", ACTIVATED: "NEW", TRANSFERRED: "TRANSFER", LEFT: "DELETE"}

# Group codes of the portal, and the role group of a department.
BASE_GROUP = "9001"
COMMON_GROUP = "T"
ROLE_GROUPS = {
    "9002": ("1", "3", "4", "5", "6", "7", "8", "9", "26", "27", "39", "40"),
    "9003": ("38",),
    "9004": ("12",),
    "9005": ("10",),
}
DATA_SUFFIX = ",data"
PRODUCT = "dashboard"
SYSTEM = "SYSTEM"
LANGUAGE = "ko"

# Kinds of grant rows: one group, or every data group except the named and the common one.
ONE_GROUP = "GROUP"
OTHER_DATA = "OTHER_DATA_GROUPS"


def user_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """What changed per user since the previous snapshot.

    ``NEW``: in use and unknown before. ``ACTIVATED``: in use, before marked as not in use; a
    missing mark before is no change. ``TRANSFERRED``: in use in both, in another department.
    ``LEFT``: in use before, no row in use now. All four come from one join, because only
    current rows in use matter.
    """
    cur = current.where(F.col("BI_USE_YN") == "Y").alias("c")
    prev = previous.alias("p")
    both = cur.join(prev, F.col("c.USER_ID") == F.col("p.USER_ID"), "full")
    change = (
        F.when(F.col("p.USER_ID").isNull(), F.lit(NEW))
        .when(F.col("c.USER_ID").isNull(), F.when(F.col("p.BI_USE_YN") == "Y", F.lit(LEFT)))
        .when(F.col("p.BI_USE_YN") == "N", F.lit(ACTIVATED))
        .when((F.col("p.BI_USE_YN") == "Y") & (F.col("c.PART_CODE") != F.col("p.PART_CODE")), F.lit(TRANSFERRED))
    )
    return both.select(
        F.coalesce("c.USER_ID", "p.USER_ID").alias("USER_ID"),
        F.coalesce("c.USER_NM", "p.USER_NM").alias("USER_NM"),
        change.alias("CHANGE"),
        F.col("c.PART_CODE").alias("PART_CODE"),
        F.col("p.PART_CODE").alias("OLD_PART_CODE"),
    ).where(F.col("CHANGE").isNotNull() & F.col("USER_ID").isNotNull())


def role_group(department: Column) -> Column:
    """The role group of a department; NULL where it has none."""
    expression = None
    for group, departments in ROLE_GROUPS.items():
        branch = department.isin(*departments)
        expression = F.when(branch, F.lit(group)) if expression is None else expression.when(branch, F.lit(group))
    return expression


def data_groups(groups: DataFrame) -> DataFrame:
    return groups.where(F.col("group_desc").endswith(DATA_SUFFIX)).select("group_code")


def _joined(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("CHANGE").isin(NEW, ACTIVATED))


def permission_grants(changes: DataFrame, run_ts: datetime) -> DataFrame:
    """Group grants for changed users.

    A new or activated user gets the base group, the role group and the data group of the own
    department, every other data group, and the common group. A transferred user gets the role
    group of the new department only.

    Every other data group is one ``OTHER_DATA`` row that names the own department, so the result
    grows with the users alone, and a group made later is included; ``grants_of_user`` and
    ``group_sizes`` read it so. A user without department has no such row.
    """
    grant = lambda rule, code: F.struct(F.lit(rule).alias("rule"), code.alias("GROUP_CODE"))
    none = F.array().cast("array<struct<rule:string,GROUP_CODE:string>>")
    role, department = role_group(F.col("PART_CODE")), F.col("PART_CODE")
    roles = F.when(role.isNotNull(), F.array(grant(ONE_GROUP, role))).otherwise(none)
    others = F.when(department.isNotNull(), F.array(grant(OTHER_DATA, department))).otherwise(none)
    fixed = F.array(*[grant(ONE_GROUP, code) for code in (F.lit(BASE_GROUP), F.lit(COMMON_GROUP), department)])
    rows = F.when(F.col("CHANGE").isin(NEW, ACTIVATED), F.concat(fixed, roles, others)).when(
        F.col("CHANGE") == TRANSFERRED, roles
    )
    return changes.select(F.explode(rows).alias("_grant"), F.col("USER_ID").alias("usr_id")).select(
        "_grant.GROUP_CODE", "_grant.rule", "usr_id", F.lit(SYSTEM).alias("creator"), ntz(run_ts).alias("created")
    )


def _open_data_groups(groups: DataFrame) -> DataFrame:
    """The groups an ``OTHER_DATA`` row stands for, each once, but for the one it names."""
    return data_groups(groups).where(F.col("group_code") != COMMON_GROUP).select(F.col("group_code").alias("GROUP_CODE")).distinct()


def grants_of_user(grants: DataFrame, groups: DataFrame, user: str) -> DataFrame:
    """GROUP_CODE: every group one user holds, rule rows written out. At most the rows of ``groups`` and of the user."""
    own = grants.where(F.col("usr_id") == user)
    named = own.where(F.col("rule") == ONE_GROUP).select("GROUP_CODE")
    excepted = own.where(F.col("rule") == OTHER_DATA).select(F.max("GROUP_CODE")).scalar()  # none without a rule row
    return named.unionByName(_open_data_groups(groups).where(F.col("GROUP_CODE") != excepted)).distinct()


def group_sizes(grants: DataFrame, groups: DataFrame) -> DataFrame:
    """GROUP_CODE, holders: how many grants each held group has, rule rows counted for all they stand for.

    Grants are grouped by code once; a data group has all rule rows but those that name it. No
    grant is written out.
    """
    is_rule = F.col("rule") == OTHER_DATA
    counted = settle(
        grants.groupBy("GROUP_CODE").agg(F.count_if(~is_rule).alias("_named"), F.count_if(is_rule).alias("_excepted")),
        "grants-of-group",
    )
    rules = F.coalesce(counted.select(F.sum("_excepted")).scalar(), F.lit(0))
    met = counted.join(_open_data_groups(groups).withColumn("_open", F.lit(True)), ["GROUP_CODE"], "full")
    by_rule = F.when(F.col("_open"), rules - F.coalesce("_excepted", F.lit(0))).otherwise(F.lit(0))
    holders = (F.coalesce("_named", F.lit(0)) + by_rule).cast("bigint")
    return met.select("GROUP_CODE", holders.alias("holders")).where(F.col("holders") > 0)


def portal_users(changes: DataFrame, run_ts: datetime) -> DataFrame:
    """The portal's user master rows for new and activated users."""
    now = ntz(run_ts)
    return _joined(changes).select(
        F.col("USER_ID").alias("usr_id"),
        F.col("USER_NM").alias("usr_nm"),
        F.lit(None).cast("string").alias("reserved_1"),
        day_label(now).alias("joined_day"),
        F.lit(0).alias("failures"),
        F.lit(LANGUAGE).alias("language"),
        F.col("PART_CODE").alias("usr_desc"),
        F.lit(None).cast("string").alias("reserved_2"),
        now.alias("password_time"),
        F.lit("Y").alias("in_use"),
        F.lit(SYSTEM).alias("creator"),
        now.alias("created"),
        F.lit(SYSTEM).alias("changer"),
        now.alias("changed"),
    )


def product_grants(changes: DataFrame, run_ts: datetime) -> DataFrame:
    """The portal's product rows for new and activated users."""
    return _joined(changes).select(
        F.lit(PRODUCT).alias("product"),
        F.col("USER_ID").alias("usr_id"),
        F.lit(SYSTEM).alias("creator"),
        ntz(run_ts).alias("created"),
    )


def _per_user(changes: DataFrame, **columns: Column) -> DataFrame:
    """One row per changed user, settled: the portal tables are joined with a list of known size."""
    found = changes.groupBy(F.col("USER_ID").alias("usr_id"))
    return settle(found.agg(*[c.alias(n) for n, c in columns.items()]), "changed-users")


def _loses_all() -> Column:
    return F.bool_or(F.col("CHANGE").isin(NEW, ACTIVATED, LEFT))


def revoke_rows(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Portal rows (users, products or grants) without those of new, activated and left users."""
    users = _per_user(changes, _all=_loses_all())
    return rows.join(users.where("_all").select("usr_id"), ["usr_id"], "left_anti").select(*rows.columns)


def permission_revokes(grants: DataFrame, changes: DataFrame, groups: DataFrame) -> DataFrame:
    """The grants that remain after all revokes.

    New, activated and left users lose all grants. A transferred user keeps the base group and
    the data groups, also those held by rule. ``groups`` may repeat a code. The grants are read once.
    """
    users = _per_user(changes, _all=_loses_all(), _moved=F.bool_or(F.col("CHANGE") == TRANSFERRED))
    data = data_groups(groups).select(F.col("group_code").alias("GROUP_CODE"), F.lit(True).alias("_data")).distinct()
    by_transfer = F.col("_moved") & (F.col("GROUP_CODE") != BASE_GROUP) & F.col("_data").isNull()
    if "rule" in grants.columns:
        by_transfer &= F.col("rule") != OTHER_DATA
    return (
        grants.join(users, ["usr_id"], "left")
        .join(data, ["GROUP_CODE"], "left")
        .where(~is_true(F.col("_all") | by_transfer))
        .select(*grants.columns)
    )


def apply_transfer(users: DataFrame, changes: DataFrame) -> DataFrame:
    """The user master with the new department of transferred users."""
    moved = _per_user(changes.where(F.col("CHANGE") == TRANSFERRED), _department=F.max("PART_CODE"))
    updated = users.join(moved, ["usr_id"], "left").withColumn("usr_desc", F.coalesce("_department", "usr_desc"))
    return updated.select(*users.columns)


def audit_log(changes: DataFrame, run_ts: datetime) -> DataFrame:
    """One audit row per change."""
    action = None
    for kind, label in ACTIONS.items():
        branch = F.col("CHANGE") == kind
        action = F.when(branch, F.lit(label)) if action is None else action.when(branch, F.lit(label))
    return changes.select(F.col("USER_ID").alias("usr_id"), action.alias("action"), ntz(run_ts).alias("action_time"))
