import random

import pytest

from docloom.llm.canonical import BKTree, Resolver, distance, level, listed, resolved, swaps

ENTRIES = [("1", "Véxdell Payments LLC", "FCSN|FCSN Holdings"), ("2", "Quophex Health Ltd.", None), ("3", "Quophex Optics S.A.", None), ("4", "The Marzan Risk and Audit B.V.", None), ("5", None, None), (None, "Lost Corp", None)]


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_distance_and_tree_against_brute_force():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(0, 12))) for _ in range(300)]
    tree = BKTree(iter(dict.fromkeys(w for w in words if w)))
    for a in words[:60]:
        assert all(distance(a, b) == plain(a, b) for b in words[:80])
        for radius in (0, 1, 2, 4):
            want = {(plain(a, b), b) for b in words if b and plain(a, b) <= radius} if a else set()
            assert set(tree.within(a, radius)) == want
    assert swaps("abcd", "abdc", 1) and not swaps("abcd", "badc", 1) and swaps("abcd", "badc", 2)


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("Véxdell Payments LLC", "1"), ("VEXDELL PAYMENTS", "1"), ("vexdell_payments", "1"), ("VéxdellPayments", "1"), ("Payments Véxdell", "1"), ("V3xdell Payments, L.L.C.", "1"), ("Véxdell Paymenst LLC", "1"),
        ("Vxédell Paymets", "1"), ("Véxdell Pay", "1"), ("Véxdell", "1"), ("fcsn", "1"), ("FCSN Holdings", "1"), ("Véxdell Payments (EMEA)", "1"), ("Véxdell Payments - North", "1"), ("Véxdell Payments / reseller", "1"),
        ("Quophex", ""), ("Quophex Ltd.", "2"), ("Quophex S.A.", "3"), ("Quophex Media", ""), ("Quophex Opt", "3"), ("Marzan Risk & Audit", "4"), ("Marzan Risk and Audit, The", "4"), ("TheMarzanRiskandAudit", "4"),
        ("multiple vendors", ""), ("?", ""), ("TBD", ""), ("Lost Corp", ""), ("x" * 100_000, ""),
    ],
)
def test_resolve(value, want):
    assert Resolver(ENTRIES).resolve(value) == want


def test_shards_give_the_same(monkeypatch):
    rng = random.Random(2)
    entries = [(str(k), "".join(rng.choice("abcdefgh") for _ in range(10)) + " Systems Ltd.", None) for k in range(200)]
    asked = [e[1][:3] + e[1][4:] for e in entries]
    whole = [Resolver(entries).resolve(a) for a in asked]
    monkeypatch.setattr("docloom.llm.canonical.SHARD_ENTRIES", 16)
    assert [Resolver(entries).resolve(a) for a in asked] == whole


def test_level():
    assert level(" The Acme & Söns (new), Limited ") == (["acme", "and", "sons"], "ltd")
    assert level("") == ([], "")


def test_rows(spark):
    entries = listed(spark.createDataFrame(ENTRIES, "id string, name string, al string"), "id", "name", "al")
    df = spark.createDataFrame([("r", "vexdell payments", "N/A"), ("r", "vexdell payments", "N/A"), (None, None, "Acme"), ("s", "", " null ")], "id string, field string, account_id string")
    for bound in (64_000_000, -1):
        got = sorted((r.field, r.id or "", r.account_id) for r in resolved(df, "id", {"field": entries, "account_id": entries.limit(0)}, bound).collect())
        assert got == [("account_id", "", ""), ("field", "r", "1"), ("field", "r", "1")]
        assert resolved(df.limit(0), "id", {"field": entries}, bound).count() == 0


def test_lists_beyond_a_broadcast_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    stem = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9)))
    entries = [(str(k), f"{stem()} {rng.choice(['Systems', 'Media', 'Bank'])} {rng.choice(['Ltd', 'Inc', 'AG'])}", rng.choice([None, stem()])) for k in range(150)]
    asked = []
    for _, name, alias in entries:
        at = rng.randrange(1, len(name) - 1)
        asked += [name, name[:at] + name[at + 1 :], name[:at] + name[at + 1] + name[at] + name[at + 2 :], name.split()[0], name[: at + 3], alias or "none such", " ".join(reversed(name.split()[:2]))]
    want = {v: Resolver(entries).resolve(v) for v in asked}
    monkeypatch.setattr("docloom.llm.canonical.SHARD_ENTRIES", 20)
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(asked)], "id string, v string")
    got = {r.value: r.account_id for r in resolved(df, "id", {"v": listed(spark.createDataFrame(entries, "id string, name string, al string"), "id", "name", "al")}, 0).collect()}
    assert got == {v: w for v, w in want.items() if v in got} and len(got) >= len(set(asked)) - 1
    assert len(set(want.values())) > 100 and "" in want.values()


def test_swaps_in_short_names_and_stems():
    made = Resolver([("1", "Marlow", None), ("2", "Zentrix Systems Corp", None)])
    assert [made.resolve(v) for v in ("Malrow", "Zenrtix", "Mlraow")] == ["1", "2", ""]


def test_beginning_of_many_names():
    made = Resolver([(str(k), f"Northern Light {w} {f}", None) for k, (w, f) in enumerate([("Alpha", "Inc"), ("Beta", "Inc"), ("Gamma", "Inc"), ("Zeta", "GmbH")])])
    assert [made.resolve(v) for v in ("Northern Light GmbH", "Northern Light Inc", "Northern Light")] == ["3", "", ""]
