import heapq
import random
import zlib

import pytest

from quotewell.llm import sharding
from tests.llm.samples import docs_of, odd_texts, prose


def test_best_fit_decreasing_like_a_plain_search():
    rng = random.Random(5)
    for _ in range(30):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(0, 50))]
        capacity = rng.randint(60, 90)
        bins = []
        for size in sorted(sizes, reverse=True):
            fitting = [b for b in range(len(bins)) if bins[b] >= size]
            if fitting:
                best = min(fitting, key=lambda b: (bins[b], b))
                bins[best] -= size
            else:
                bins.append(capacity - size)
        classes = {s: sizes.count(s) for s in sizes}
        quotas = sharding.best_fit_decreasing(list(classes.items()), capacity)
        assert max((b for _, b, _ in quotas), default=-1) + 1 == len(bins)
        for size, n in classes.items():
            assert sum(k for s, _, k in quotas if s == size) == n


def test_tree_finds_the_tightest():
    tree, plain = sharding.CapacityTree(leaf=2), []
    rng = random.Random(1)
    for k in range(300):
        size = rng.randint(1, 99)
        tree.add(size, k)
        plain.append((size, k))
        if k % 3 == 2:
            want = min((x for x in plain if x[0] >= 40), default=None)
            assert tree.take_tightest(40) == want
            if want:
                plain.remove(want)


def test_shards(spark):
    rows = odd_texts() + [(100 + k, prose(k, 20 + k)) for k in range(200)] + [(500, "same")] * 40
    out = sharding.shard_digest(sharding.shard(docs_of(spark, rows), shards=4)).toPandas()
    assert len(out) == len(rows) and set(out["shard"]) <= set(range(4)) and set(out["law"]) == {"bytes"}
    for _, slots in out.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))
    texts = {zlib.crc32((t or "").encode()) for _, t in rows}
    assert set(out.text_crc32) == texts
    for crc, part in out.groupby("text_crc32"):
        if crc != zlib.crc32(b""):  # null and empty are two groups
            assert part["shard"].nunique() == 1
    assert sorted(out["size"]) == sorted(len((t or "").encode()) + 8 for _, t in rows)


def test_no_rows(spark):
    assert sharding.shard(docs_of(spark, [])).count() == 0


def loads_of(quotas, shards):
    loads = [0] * shards
    for size, number, count in quotas:
        loads[number] += size * count
    return loads


def test_levelled_like_one_group_at_a_time():
    rng = random.Random(8)
    for _ in range(200):
        shards, classes = rng.randint(1, 9), {rng.randint(1, 50): rng.choice([1, 2, 7, 100]) for _ in range(rng.randint(0, 9))}
        heap = [(0, b) for b in range(shards)]
        for size in sorted((s for s, n in classes.items() for _ in range(n)), reverse=True):
            load, number = heapq.heappop(heap)
            heapq.heappush(heap, (load + size, number))
        assert sorted(loads_of(sharding.levelled(list(classes.items()), shards), shards)) == sorted(load for load, _ in heap)


@pytest.mark.parametrize("hot", [0, 6, 17, 50])
def test_a_hot_group_leaves_the_other_shards_even(hot):
    """``hot`` percent of the bytes in one group, the rest in groups of many sizes."""
    rng = random.Random(hot)
    sizes = [rng.randint(10, 2000) for _ in range(5000)]
    classes = {s: sizes.count(s) for s in set(sizes)}
    large = sum(sizes) * hot // (100 - hot)
    loads = loads_of(sharding.nearest_equal([*classes.items(), (large, 1)] if hot else [*classes.items()], 24), 24)
    assert sum(loads) == sum(sizes) + large
    rest = sorted(loads)[: 24 - (hot > 4)]
    assert max(rest) - min(rest) <= 0.01 * max(rest)
    assert not hot or max(loads) == large


def test_few_equal_groups_fill_all_shards():
    assert sorted(loads_of(sharding.nearest_equal([(100, 25)], 24), 24)) == [100] * 23 + [200]
    assert sorted(loads_of(sharding.nearest_equal([(100, 24)], 24), 24)) == [100] * 24
    assert sharding.nearest_equal([], 24) == []


def test_as_near_as_all_ways_of_dealing_out():
    """Few groups: the largest shard against the best of all assignments; within what best fit decreasing guarantees."""
    import itertools

    rng = random.Random(2)
    for _ in range(40):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 7))]
        best = min(max(sum(s for s, b in zip(sizes, way) if b == k) for k in range(3)) for way in itertools.product(range(3), repeat=len(sizes)))
        found = max(loads_of(sharding.nearest_equal([(s, sizes.count(s)) for s in set(sizes)], 3), 3))
        assert best <= found <= best * 11 / 9 + 1
