import numpy as np
import pytest

from replyloom import session
from replyloom.llm import mixing


def wanted(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, s))
    total, goal, open_ones = share * sum(sizes.values()), {}, list(names)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    while True:
        left = total - sum(goal.values())
        over = [s for s in open_ones if left * weight[s] / sum(weight[o] for o in open_ones) > cap * sizes[s]]
        if not over:
            break
        for s in over:
            goal[s] = cap * sizes[s]
            open_ones.remove(s)
    left = total - sum(goal.values())
    return goal | {s: left * weight[s] / sum(weight[o] for o in open_ones) for s in open_ones}


def texts(seed):
    r = np.random.default_rng(seed)
    names = ["b", "a", None, "é", "z", "Z"]
    return [(i, "w " * int(r.lognormal(4, 1.2)), names[min(5, int(r.exponential(1.5)))]) for i in range(400)]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_copies(spark, documents, seed):
    rows = texts(seed) + [(900, None, "a"), (901, " \n", None), (902, "x y", "b"), (902, "x y", "b"), (None, "q", "z")]
    found = mixing.mix(documents(rows)).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    goal, taken = wanted(sizes), {}
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in taken.items():
        assert abs(t - goal[s]) <= max(3, 0.01 * goal[s])
    again = mixing.mix(documents(rows).repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_rates_follow_the_tilt(spark):
    """The tilts solve the dual: rates min(cap, exp(tilt * size)) meet the targets."""
    sizes = spark.createDataFrame([("a", 10, 50), ("a", 100, 20), ("a", 900, 3), ("b", 5, 10)], "source string, size long, n long")
    goals = spark.createDataFrame([("a", 5200, 8000.0), ("b", 50, 20.0)], "source string, source_size long, target double")
    tilt = {r.source: r.tilt for r in mixing.tilts(sizes, goals, 2).collect()}
    total = {"a": 0.0, "b": 0.0}
    for r in sizes.collect():
        total[r.source] += r.n * r["size"] * min(2, np.exp(tilt[r.source] * r["size"]))
    assert total["a"] == pytest.approx(8000) and total["b"] == pytest.approx(20)


def test_one_size_for_all_and_nothing(spark, documents):
    found = mixing.mix(documents([(i, "same three words", "s") for i in range(500)])).collect()
    assert abs(sum(r.taken for r in found) - 1.5 * 1500) <= 3
    assert mixing.mix(documents([])).count() == 0
    assert [r.taken for r in mixing.mix(documents([None, ""])).collect()] == [0, 0]


def test_few_files_between_steps(spark, documents, monkeypatch, tmp_path):
    """Every file costs a local executor a command, whatever the number of shuffle partitions."""
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert mixing.mix(documents(texts(1)).coalesce(2)).count() == 400
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {}
    for path in (tmp_path / "replyloom").glob("*/part-*"):
        label = path.parent.name.rpartition("-")[0]
        files.setdefault(label, {}).setdefault(path.parent, []).append(path)
    # Six sources at most, and the first partition has a file even if it is empty.
    assert files and max(len(f) for folders in files.values() for f in folders.values()) <= 7
