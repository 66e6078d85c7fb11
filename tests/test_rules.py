"""Constraint audits and delete actions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from depotstar.layouts import read_layout
from depotstar.operators import constraints as c
from depotstar.operators import retail_rules as r
from depotstar.schemas import conform


def test_declarations_are_complete():
    fks = r.foreign_keys()
    assert Counter(fk.on_delete for fk in fks) == {"RESTRICT": 18, "CASCADE": 7, "SET NULL": 4}
    assert len(r.LAYOUTS) == 18
    assert sum(len(v) for v in r.CHECKS.values()) == 27
    assert sum(len(v) for v in r.DOMAINS.values()) == 13
    keys = [k for v in r.UNIQUE.values() for k in v]
    assert Counter(len(k) for k in keys) == {1: 10, 2: 2, 3: 1}
    for table, checks in r.CHECKS.items():
        columns = {f.name for f in r.layout(table)}
        for test in checks.values():
            assert set(test.split()) & columns
    # Two columns of one table may refer to the same parent.
    assert {fk.column for fk in fks if fk.child == "STOCK_TRANSFER"} == {"from_store_id", "to_store_id", "user_id"}
    assert not [fk for fk in fks if fk.column == "entity_id"]


def test_defaults_fill_absent_columns(spark):
    df = spark.createDataFrame([(1, "+1", "A")], "customer_id int, phone_number string, full_name string")
    row = conform(df, r.layout("CUSTOMER"), r.defaults("CUSTOMER", F.lit("2024-01-01"))).first()
    assert (row.membership_tier, row.total_points, row.email) == ("Silver", 0, None)
    assert str(row.registered_at) == "2024-01-01 00:00:00"
    counted = sum(len(r.defaults(t, None)) for t in r.LAYOUTS)
    assert counted == 44


@pytest.mark.parametrize(
    "rule, kind, value",
    [("a", "NOT NULL", (None, "ok", "x", 1, 2)), ("b <= 3", "LENGTH", (1, "long", "x", 1, 2)),
     ("s", "DOMAIN", (1, "ok", "z", 1, 2)), ("order", "CHECK", (1, "ok", "x", 3, 2))],
)
def test_each_row_rule_finds_its_violation(spark, rule, kind, value):
    rules = c.TableRules(not_null=["a"], lengths={"b": 3}, domains={"s": ["x", "it's"]}, checks={"order": "lo < hi"})
    good = [(1, "ok", "x", 1, 2), (2, None, None, None, 2), (3, "abc", "it's", 1, None)]
    df = spark.createDataFrame([*good, value], "a int, b string, s string, lo int, hi int")
    found = {(x.rule, x.kind): x.violations for x in c.audit_rows("t", df, rules).collect()}
    assert found.pop((rule, kind)) == 1
    assert set(found.values()) == {0}


def test_unique_exempts_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (None, "a"), (None, "a")], "k int, v string")
    assert c.audit_unique("t", df, ["k", "v"]).first().violations == 2
    assert c.audit_unique("t", df.limit(0), ["k"]).first().violations == 0


def test_foreign_key_counts_orphans(spark):
    tables = {
        "child": spark.createDataFrame([(1,), (5,), (5,), (None,)], "p int"),
        "parent": spark.createDataFrame([(1,), (2,)], "id int"),
    }
    fk = c.ForeignKey("child", "p", "parent", "id")
    row = c.audit_foreign_key(fk, tables).first()
    assert (row.rule, row.violations) == ("p -> parent.id", 2)
    orphans = c.orphan_keys(tables["child"], "p", tables["parent"], "id")
    assert [tuple(x) for x in orphans.collect()] == [(5, 2)]


@pytest.fixture
def shop(spark):
    def make(columns, data):
        return spark.createDataFrame(data, read_layout(columns))

    return {
        "PROMOTION": make("promotion_id INT", [(1,), (2,)]),
        "PRODUCT": make("product_id INT", [(7,), (8,)]),
        "PROMOTION_PRODUCT": make("promotion_product_id INT, promotion_id INT, product_id INT", [(1, 1, 7), (2, 2, 7), (3, 1, 8)]),
        "TRANSACTION": make("transaction_id INT, customer_id INT, promotion_id INT", [(10, 5, 1), (11, None, 2), (12, 5, None)]),
        "TRANSACTION_ITEM": make("transaction_item_id INT, transaction_id INT", [(1, 10), (2, 11)]),
        "RETURN_ITEM": make("return_item_id INT, return_id INT, transaction_item_id INT", [(1, 1, 2)]),
    }


def delete(shop, parent, key, ids):
    keys = shop[parent].where(F.col(key).isin(ids)).select(key)
    result = c.delete_parents(shop, r.foreign_keys(), r.primary_keys(), parent, keys)
    report = {(x.table_name, x.action): x.affected for x in result.report.collect()}
    return result.tables, report


def test_cascade_and_set_null(shop, rows):
    after, report = delete(shop, "PROMOTION", "promotion_id", [1])
    assert report == {("PROMOTION_PRODUCT", "CASCADE"): 2, ("TRANSACTION", "SET NULL"): 1}
    assert rows(after["PROMOTION"]) == [(2,)]
    assert rows(after["PROMOTION_PRODUCT"]) == [(2, 2, 7)]
    assert rows(after["TRANSACTION"]) == [(10, 5, None), (11, None, 2), (12, 5, None)]


def test_cascade_reaches_a_restrict(shop):
    after, report = delete(shop, "TRANSACTION", "transaction_id", [11])
    assert report == {("TRANSACTION_ITEM", "CASCADE"): 1, ("RETURN_ITEM", "RESTRICT"): 1}
    _, report = delete(shop, "TRANSACTION", "transaction_id", [10])
    assert report == {("TRANSACTION_ITEM", "CASCADE"): 1, ("RETURN_ITEM", "RESTRICT"): 0}


def test_delete_without_children(shop):
    after, report = delete(shop, "RETURN_ITEM", "return_item_id", [1])
    assert report == {} and after["RETURN_ITEM"].count() == 0


def test_whole_audit_runs_over_partial_tables(spark):
    customers = spark.createDataFrame(
        [(1, "+1", "A", "Silver", 0), (2, "+1", "B", "Bronze", -1)],
        "customer_id int, phone_number string, full_name string, membership_tier string, total_points int",
    )
    points = spark.createDataFrame(
        [(1, 9, None, 1, 0, 1, "Earn")],
        "point_id int, customer_id int, transaction_id int, points_earned int, points_used int, points_balance int, transaction_type string",
    )
    found = c.audit({"CUSTOMER": customers, "LOYALTY_POINT": points}, r.rules(), r.foreign_keys())
    bad = {(x.table_name, x.rule) for x in found.where("violations > 0").collect()}
    assert bad == {
        ("CUSTOMER", "phone_number"), ("CUSTOMER", "membership_tier"), ("CUSTOMER", "chk_total_points"),
        ("LOYALTY_POINT", "customer_id -> CUSTOMER.customer_id"),
    }


def test_rules_on_missing_columns_are_told(spark, rows):
    rules = c.TableRules(
        not_null=["a", "gone"], lengths={"gone": 3}, domains={"b": ["x"], "gone": ["y"]},
        checks={"both": "a < gone", "one": "a > 1 AND b != 'gone'"}, unique=[["a"], ["a", "gone"]],
    )
    t = spark.createDataFrame([(1, "x"), (1, "z"), (None, None)], "a int, b string")
    keys = [c.ForeignKey("t", "gone", "t", "a"), c.ForeignKey("t", "a", "nowhere", "id")]
    found = {(r.rule, r.kind): r.violations for r in c.audit({"t": t}, {"t": rules}, keys).collect()}
    assert found == {
        ("a", "NOT NULL"): 1, ("gone", "NOT NULL"): None, ("gone <= 3", "LENGTH"): None,
        ("b", "DOMAIN"): 1, ("gone", "DOMAIN"): None, ("both", "CHECK"): None, ("one", "CHECK"): 2,
        ("a", "UNIQUE"): 1, ("a, gone", "UNIQUE"): None,
        ("gone -> t.a", "FOREIGN KEY"): None, ("a -> nowhere.id", "FOREIGN KEY"): None,
    }


def test_cascades_run_through_cycles(spark, rows):
    # 1 -> 2 -> 3 -> 1 refer to each other in a ring; 4 refers to the ring, 5 to itself, 6 to 5.
    t = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, 2), (5, 5), (6, 5), (7, None)], "id int, other int")
    u = spark.createDataFrame([(10, 4), (11, 5), (12, 7)], "uid int, t_id int")
    keys = [c.ForeignKey("t", "other", "t", "id", "CASCADE"), c.ForeignKey("u", "t_id", "t", "id", "SET NULL")]
    tables = {"t": t, "u": u}

    def after(ids):
        result = c.delete_parents(tables, keys, {"t": "id", "u": "uid"}, "t", t.where(F.col("id").isin(ids)).select("id"))
        return rows(result.tables["t"].select("id")), rows(result.tables["u"]), {x.rule: x.affected for x in result.report.collect()}

    assert after([1]) == (
        [(5,), (6,), (7,)], [(10, None), (11, 5), (12, 7)], {"other -> t.id": 4, "t_id -> t.id": 1},
    )
    assert after([5]) == (
        [(1,), (2,), (3,), (4,), (7,)], [(10, 4), (11, None), (12, 7)], {"other -> t.id": 2, "t_id -> t.id": 1},
    )
    assert after([])[2] == {"other -> t.id": 0, "t_id -> t.id": 0}


def test_kept_audits_say_what_full_audits_say(spark, tmp_path, monkeypatch):
    from depotstar.operators import kept_audit as k

    r = random.Random(6)
    fk = [c.ForeignKey("child", "p", "parent", "id"), c.ForeignKey("child", "boss", "child", "cid")]
    unique = {"parent": [["id"]], "child": [["cid"], ["p", "code"]]}
    layouts = {"parent": "id int, x int", "child": "cid int, p int, code string, boss int"}
    now = {"parent": [], "child": []}

    def some(table):
        if table == "parent":
            return (r.choice([None, *range(6)]), r.randrange(9))
        return (r.randrange(12), r.choice([None, *range(8)]), r.choice(["a", "b", None]), r.choice([None, *range(14)]))

    def frame(table, data):
        return spark.createDataFrame(data, layouts[table])

    audit = k.KeptAudit(spark, str(tmp_path / "audit"), unique, fk)
    for turn in range(4):
        changes = {}
        for table in ("parent", "child"):
            if turn == 2 and table == "child":
                continue
            went = r.sample(now[table], len(now[table]) // 3)
            came = [some(table) for _ in range(8)]
            for row in went:
                now[table].remove(row)
            now[table] += came
            changes[table] = k.Change(frame(table, came), frame(table, went) if went else None)
        if turn == 1:  # lost once on the way
            with monkeypatch.context() as m, pytest.raises(RuntimeError):
                m.setattr(k.tables, "finish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
                audit.apply(changes)
        got = {(x.table_name, x.rule): x.violations for x in audit.apply(changes).collect()}
        whole = {t: frame(t, rows) for t, rows in now.items()}
        rules = {t: c.TableRules(unique=keys) for t, keys in unique.items()}
        full = {(x.table_name, x.rule): x.violations for x in c.audit(whole, rules, fk).collect()}
        assert got == full
    assert {x.violations for x in k.KeptAudit(spark, str(tmp_path / "none"), unique, fk).violations().collect()} == {0}
    assert audit.apply({}).count() == 5
