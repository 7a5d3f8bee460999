from helpers import TS, frame, values

from quayside.operators import members

USERS = "USER_ID string, USER_CODE string, USER_NM string, PART_CODE string, BI_USE_YN string"
GROUPS = [("1", "1,data"), ("2", "2,data"), ("T", "T,data"), ("9001", "all"), ("9002", "sales")]


def user(name, mark="Y", department="1", code="c"):
    return (name, code, name, department, mark)


def changes(spark, current, previous):
    return members.user_changes(frame(spark, USERS, *current), frame(spark, USERS, *previous))


def kinds(spark, current, previous):
    return dict(values(changes(spark, current, previous), "USER_ID", "CHANGE"))


def groups(spark):
    return frame(spark, "group_code string, group_desc string", *GROUPS)


def test_changes(spark):
    current = [user("new"), user("new, unused", "N"), user("back"), user("unknown before", "Y"), user("moved", department="2"),
               user("same"), user("switched off", "N"), user("moved and off", "N", "2")]
    previous = [user("back", "N"), user("unknown before", None), user("moved"), user("same"), user("switched off"),
                user("moved and off"), user("gone"), user("gone, unused", "N"), user("gone, unknown", None)]
    assert kinds(spark, current, previous) == {
        "new": "NEW", "back": "ACTIVATED", "moved": "TRANSFERRED",
        "switched off": "LEFT", "moved and off": "LEFT", "gone": "LEFT",
    }


def test_known_user_without_code_is_not_new(spark):
    assert kinds(spark, [user("a")], [user("a", code=None)]) == {}


def test_missing_department_is_no_transfer(spark):
    assert kinds(spark, [user("a", department=None)], [user("a")]) == {}


def test_second_row_in_use_is_not_left(spark):
    assert kinds(spark, [user("a", "N"), user("a")], [user("a")]) == {}


def granted(spark, current, previous):
    return members.permission_grants(changes(spark, current, previous), TS)


def test_grants(spark):
    grants = granted(spark, [user("n"), user("t", department="2"), user("x", department="99")], [user("t"), user("x", "N", "99")])
    rows = values(grants, "usr_id", "rule", "GROUP_CODE", "creator")
    assert rows == sorted(
        [("n", "GROUP", g, "SYSTEM") for g in ("9001", "9002", "1", "T")]
        + [("n", "OTHER_DATA_GROUPS", "1", "SYSTEM"), ("x", "OTHER_DATA_GROUPS", "99", "SYSTEM")]
        + [("x", "GROUP", g, "SYSTEM") for g in ("9001", "99", "T")]
    )
    # Department 2 has no role group, so the transfer grants nothing.
    held = lambda name: values(members.grants_of_user(grants, groups(spark), name))
    assert held("n") == [(g,) for g in sorted(("9001", "9002", "1", "2", "T"))]
    assert held("x") == [(g,) for g in sorted(("9001", "99", "1", "2", "T"))]
    assert held("t") == []
    sizes = {"9001": 2, "9002": 1, "1": 2, "2": 2, "99": 1, "T": 2}
    twice = groups(spark).unionByName(groups(spark))
    assert dict(values(members.group_sizes(grants, twice))) == sizes


def test_transfer_grants_the_role_only(spark):
    assert values(granted(spark, [user("t", department="38")], [user("t")]), "GROUP_CODE") == [("9003",)]


def test_user_without_department(spark):
    grants = granted(spark, [user("n", department=None)], [user("other")])
    assert values(grants, "usr_id", "GROUP_CODE") == [("n", None), ("n", "9001"), ("n", "T")]
    assert values(members.group_sizes(grants, groups(spark))) == [(None, 1), ("9001", 1), ("T", 1)]


def test_sizes_without_grants(spark):
    none = granted(spark, [user("a")], [user("a")])
    assert values(members.group_sizes(none, groups(spark))) == []


def test_transfer_keeps_rules(spark):
    found = changes(spark, [user("t", department="2")], [user("t")])
    grants = frame(spark, "GROUP_CODE string, rule string, usr_id string", ("7", "OTHER_DATA_GROUPS", "t"), ("9002", "GROUP", "t"))
    assert values(members.permission_revokes(grants, found, groups(spark)), "GROUP_CODE") == [("7",)]


def test_revokes(spark):
    found = changes(spark, [user("t", department="2"), user("s")], [user("t"), user("s"), user("gone")])
    rows = [(g, u) for u in ("t", "s", "gone") for g in ("9001", "9002", "1", None)]
    grants = frame(spark, "GROUP_CODE string, usr_id string", *rows)
    with_missing = frame(spark, "group_code string, group_desc string", *GROUPS, (None, "none,data"))
    kept = values(members.permission_revokes(grants, found, with_missing), "usr_id", "GROUP_CODE")
    assert kept == [("s", None), ("s", "1"), ("s", "9001"), ("s", "9002"), ("t", None), ("t", "1"), ("t", "9001")]


def test_user_rows(spark):
    found = changes(spark, [user("n"), user("t", department="2")], [user("t"), user("gone")])
    master = frame(spark, "usr_id string, usr_desc string", ("t", "1"), ("gone", "1"), ("n", "stale"), ("other", "7"))
    assert values(members.revoke_rows(master, found), "usr_id") == [("other",), ("t",)]
    assert dict(values(members.apply_transfer(master, found))) == {"t": "2", "gone": "1", "n": "stale", "other": "7"}
    assert values(members.portal_users(found, TS), "usr_id", "joined_day", "language", "usr_desc") == [("n", "2024-01-10", "ko", "1")]
    assert values(members.product_grants(found, TS), "product", "usr_id") == [("dashboard", "n")]
    assert values(members.audit_log(found, TS), "usr_id", "action") == [("gone", "DELETE"), ("n", "NEW"), ("t", "TRANSFER")]


def test_kept_and_granted_have_no_duplicates(spark, folder):
    from quayside.queries import all_queries

    state = all_queries()["permission_state"](spark, folder)
    assert state.count() == state.distinct().count()
