from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
import xxhash

from tierline.llm import queries, ring


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def expected(rows, shards):
    """Place the documents one by one around the ring."""
    keyed = []
    for key, text in rows:
        raw = (text or "").encode()
        keyed.append((signed(xxhash.xxh64_intdigest(raw, 42)), key is not None, key, len(raw) + 8, zlib.crc32(raw)))
    keyed.sort(key=lambda k: (k[0], k[1], k[2] or 0, k[3]))
    placed = ring.walk([k[0] for k in keyed], ring.ring_points(shards), shards)
    return [(k[2], k[3], k[4], *p) for k, p in zip(keyed, placed, strict=True)]


def test_query(spark, sf, documents):
    got = queries.QUERIES["op6_ring_sharding"](spark, sf).collect()
    want = expected([(r.doc_id, r.text) for r in documents.collect()], 24)
    assert sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == sorted(want)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and {r.law for r in got} == {"rows"}


@pytest.mark.parametrize("shards", [1, 5])
def test_hot_key_and_odd_rows(spark, make_docs, odd_rows, shards):
    rows = odd_rows + [(100 + i, "one hot text") for i in range(40)]
    got = [tuple(r) for r in ring.shard_texts(make_docs(rows), shards).collect()]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=order) == sorted(expected(rows, shards), key=order)
    for shard in range(shards):
        slots = sorted(r[4] for r in got if r[3] == shard)
        assert slots == list(range(len(slots)))


def test_pieces_equal_walk():
    rng = random.Random(3)
    for _ in range(200):
        shards = rng.randint(1, 6)
        points = sorted((rng.randint(-50, 50), rng.randrange(shards)) for _ in range(rng.randint(1, 12)))
        points += [(60 + s, s) for s in range(shards)]  # every shard has a point
        positions = sorted(rng.randint(-70, 80) for _ in range(rng.randint(0, 60)))
        counts = [0] * (len(points) + 1)
        for p in positions:
            counts[ring.bisect_left([q for q, _ in points], p)] += 1
        flat = []
        pieces = ring.bounded_pieces(counts, points, shards)
        ends = [p[0] for p in pieces[1:]] + [len(positions)] * bool(pieces)
        for (first, shard, slot), end in zip(pieces, ends, strict=True):
            flat += [(shard, slot + i) for i in range(end - first)]
        assert flat == ring.walk(positions, points, shards)


def test_empty(make_docs):
    assert ring.shard_texts(make_docs([]), 24).count() == 0


def test_few_keys_move_when_a_shard_is_added():
    rng = random.Random(9)
    positions = sorted(rng.randint(-(1 << 63), (1 << 63) - 1) for _ in range(20000))
    before = ring.walk(positions, ring.ring_points(24), 24)
    after = ring.walk(positions, ring.ring_points(25), 25)
    moved = sum(a[0] != b[0] for a, b in zip(before, after, strict=True))
    assert moved < 0.1 * len(positions)  # 6.3 %; a modulus would move 96 %
