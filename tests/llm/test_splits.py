from __future__ import annotations

import random
from itertools import combinations

import pytest

from clipsieve.llm import splits
from clipsieve.llm.splits import allocate, connected, min_cost_flow


def groups(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    found = {}
    for x in parent:
        found.setdefault(find(x), set()).add(x)
    return list(found.values())


@pytest.mark.parametrize("kind", ["random", "path", "star"])
def test_connected(spark, kind):
    pick = random.Random(3)
    names = [f"n{i:03}" for i in range(120)]
    pick.shuffle(names)
    edges = {"random": [tuple(pick.sample(names, 2)) for _ in range(70)], "path": list(zip(names, names[1:], strict=False)), "star": [(names[0], x) for x in names[1:]]}[kind]
    found = {}
    for r in connected(spark.createDataFrame(edges, "a string, b string")).collect():
        found.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups(edges))) and all(k == min(v) for k, v in found.items())


def brute(items, quotas):
    """Least cost of whole units by trying all assignments."""
    units = [cost for size, cost in items for _ in range(size)]

    def best(i, left):
        if i == len(units):
            return 0.0
        return min((units[i][b] + best(i + 1, [q - (b == c) for c, q in enumerate(left)]) for b in range(len(left)) if left[b]), default=float("inf"))

    return best(0, quotas)


@pytest.mark.parametrize("seed", range(25))
def test_min_cost_flow_is_least(seed):
    pick = random.Random(seed)
    items = [(pick.randint(1, 3), [pick.random() for _ in range(3)]) for _ in range(4)]
    total = sum(s for s, _ in items)
    a = pick.randint(0, total)
    b = pick.randint(0, total - a)
    quotas = [a, b, total - a - b]
    flow = min_cost_flow(items, quotas)
    assert [sum(f) for f in flow] == [s for s, _ in items]
    assert [sum(f[k] for f in flow) for k in range(3)] == quotas
    assert sum(x * c for f, (_, cost) in zip(flow, items, strict=True) for x, c in zip(f, cost, strict=True)) == pytest.approx(brute(items, quotas))


def test_allocate_keeps_proportions():
    bundles = [(5000, 0, 1), (300, 1, 3), (40, 0, 20), (7, 2, 100), (1, 1, 9000), (1, 3, 1)]
    made = allocate(bundles, splits.PROPORTIONS)
    total = sum(s * n for s, _, n in bundles)
    for k, p in enumerate(splits.PROPORTIONS.values()):
        assert abs(sum(s * made[s, label][k] for s, label, _ in bundles) / total - p) < 0.01
    assert all(sum(made[s, label]) == n for s, label, n in bundles) and made[5000, 0] == [1, 0, 0]
    assert allocate([], splits.PROPORTIONS) == {}


ROWS = [
    {"client_id": " K1", "sentence": "Нэг үг"},
    {"client_id": "k1\t", "sentence": "Хоёр"},
    {"client_id": "k2", "sentence": "Xоёр"},  # the same in the consistent form
    {"client_id": "k3", "sentence": "Гурав"},
    {"client_id": None, "sentence": "Гурав"},  # nobody, but the same sentence
    {"client_id": "k4", "sentence": "!!!"},
    {"client_id": "k5", "sentence": "!!!"},  # no letters: joins nobody
    {"client_id": None, "sentence": None},
    {"client_id": "  ", "sentence": ""},
    {"client_id": "k6", "sentence": "Хоёр"},
    {"client_id": "k6", "sentence": "Хоёр"},
    {"client_id": "k7", "sentence": "нэг үг"},  # another letter case is another sentence
]


def test_found(spark, common_voice):
    found = sorted(tuple(r) for r in splits.p1_found(spark, common_voice(*ROWS)).collect())
    assert found == [("k1", "k2"), ("k1", "k6"), ("k2", "k6")]


def test_split_keeps_related_rows(spark, common_voice):
    rows = [*ROWS, *({"client_id": f"s{i % 60}", "sentence": f"үг {i % 150}", "gender": "male" if i % 2 else None} for i in range(400))]
    found = {r.row_id: r.new_split for r in splits.p1_split(spark, common_voice(*rows)).collect()}
    assert set(found) == set(range(len(rows)))
    for key in (lambda r: (r.get("client_id") or "").strip().lower(), lambda r: (r["sentence"] or "").replace("X", "Х")):
        for i, j in combinations(range(len(rows)), 2):
            a = key(rows[i])
            if a and a != "!!!" and a == key(rows[j]):
                assert found[i] == found[j]


def test_split_shares(spark, common_voice):
    """Splits and, in each, all labels have their proportions, also labels that aren't the most frequent of a speaker."""
    genders = ["male", "MALE ", "female", None, "x", "y", "z"]
    rows = [{"client_id": f"s{i % 300}" if i % 3 else None, "sentence": f"үг {i}", "gender": genders[(i // 300 + i) % 7 if i % 2 else 0]} for i in range(2000)]
    d = common_voice(*rows)
    found = splits.p1_report(spark, d).collect()
    assert {r.new_split: r.share for r in found} == pytest.approx({"train": 0.8, "dev": 0.1, "test": 0.1}, abs=0.01)
    every = {}
    for r in found:
        every[r.label] = every.get(r.label, 0) + r.n_rows
    assert sum(every.values()) == 2000 and len(every) <= splits.LABELS and every["male"] > 1000
    for r in found:
        assert r.label_share == pytest.approx(every[r.label] / 2000, abs=0.05)
    assert tuple(splits.p1_check(spark, d).first()) == (2000, 0, 0, 0)


def test_bundles(spark):
    """Small components by rows of each label, others by size class and tenths, the largest by themselves."""
    rows = [("a", "m")] * 2 + [("a", "f")] + [("b", "m")] * 2 + [("b", "f")] + [("c", "m")] * 3
    rows += [("d", "m")] * 50 + [("d", "f")] * 51 + [("e", "m")] * 51 + [("e", "f")] * 51 + [("f", "m")] * 101
    df = spark.createDataFrame(rows, "component string, label string")
    of = {r.component: (r.size, r.bundle) for r in splits.profiled(df, 10_000_000).collect()}
    assert of["a"] == of["b"] == (3, "3/f:1,m:2") and of["c"][1] == "3/m:3" and of["d"][1] == of["e"][1] != of["f"][1]
    assert splits.profiled(df, len(rows)).filter("bundle like '=%'").count() == 3


def test_members(spark, common_voice):
    assert sorted(tuple(r) for r in splits.p1_members(spark, common_voice(*ROWS)).collect()) == [("k1", "k1"), ("k2", "k1"), ("k6", "k1")]


def test_one_speaker_of_everything(spark, common_voice):
    """A component larger than its quota stays whole."""
    rows = [{"client_id": "k", "sentence": f"үг {i}"} for i in range(50)] + [{"client_id": f"k{i}", "sentence": None} for i in range(5)]
    found = splits.p1_split(spark, common_voice(*rows)).filter("row_id < 50").select("new_split").distinct().collect()
    assert [r.new_split for r in found] == ["train"]


def test_empty(spark, common_voice):
    d = common_voice()
    assert splits.p1_found(spark, d).count() == 0 and splits.p1_split(spark, d).count() == 0
