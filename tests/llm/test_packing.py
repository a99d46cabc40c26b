import random
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from quillforge.llm import packing


@given(st.lists(st.integers(1, 30), max_size=9), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_best_fill_is_best(sizes, room):
    counts = [(n, sizes.count(n)) for n in sorted(set(sizes), reverse=True)]
    got = packing.best_fill(counts, room)
    best = max(sum(c) for k in range(len(sizes) + 1) for c in combinations(sizes, k) if sum(c) <= room)
    assert sum(n * k for n, k in got) == best and all(k <= sizes.count(n) for n, k in got)


@given(st.lists(st.integers(1, 100), max_size=80))
@settings(max_examples=100, deadline=None)
def test_no_container_overflows(sizes):
    out = packing.pack(sizes, 100)
    used = {}
    for n, b in zip(sizes, out):
        used[b] = used.get(b, 0) + n
    assert len(out) == len(sizes) and all(v <= 100 for v in used.values()) and sorted(used) == list(range(len(used)))


def test_windows(spark):
    rng = random.Random(1)
    items = [(i, rng.randint(1, 3000)) for i in range(5000)] + [(9001, None), (9002, 0), (9003, 50_000), (7, 300), (7, 300)]
    df = spark.createDataFrame([(i, n, "x", 1) for i, n in items], "doc_id bigint, n_tokens int, container_id string, piece int").select("doc_id", "n_tokens", "container_id")
    got = packing.containers(df, window=1000).collect()
    whole, used = {}, {}
    for r in got:
        whole.setdefault(r.doc_id, []).append(r)
        if r.container_id is not None:
            used[r.container_id] = used.get(r.container_id, 0) + r.n_tokens
    assert max(used.values()) <= 2048
    total = sum(n or 0 for _, n in items)
    assert sum(used.values()) == total and len(used) <= 1.02 * total / 2048
    # Only items over the capacity are cut, into full containers and one rest.
    assert all(len(whole[i]) == max(1, -(-n // 2048)) for i, n in items[:5000] if i != 7)
    assert [r.n_tokens for r in sorted(whole[9003], key=lambda r: r.piece)] == [2048] * 24 + [50_000 - 24 * 2048]
    assert whole[9001][0].container_id is None and whole[9002][0].container_id is None
    assert len([r for r in whole[7] if r.n_tokens == 300]) >= 2


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, n_tokens bigint")
    assert packing.containers(none).count() == 0
    assert packing.fill_report(packing.containers(none)).first().containers == 0
