from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tierline.llm import components, queries, simhash


def plain_fingerprint(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(prints, keys, radius=3):
    """Least key reachable, by brute force over all pairs."""
    near = np.bitwise_count(np.array(prints, dtype=np.uint64)[:, None] ^ np.array(prints, dtype=np.uint64)) <= radius
    label = list(keys)
    while True:
        after = [min((label[j] for j in np.flatnonzero(row)), key=lambda k: (k is None, k)) for row in near]
        if after == label:
            return label
        label = after


def test_bk_forest_finds_every_neighbour():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    points = base[rng.integers(0, 4, 1500)]
    for _ in range(4):
        points = points ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    points = np.unique(points)
    buckets = rng.integers(0, 3, len(points))
    forest = simhash.BkForest(points, buckets)
    got = set()
    for q, n in forest.search(points, buckets, 3):
        got |= set(zip(q.tolist(), n.tolist(), strict=True))
    near = (np.bitwise_count(points[:, None] ^ points) <= 3) & (buckets[:, None] == buckets)
    assert got == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


@pytest.mark.parametrize("nodes", [4096, 8])
def test_query(spark, sf, documents, monkeypatch, nodes):
    """Also with tiny trees, so that buckets are cut into chunks."""
    monkeypatch.setattr(simhash, "TREE_NODES", nodes)
    got = {r.doc_id: r for r in queries.QUERIES["op2_simhash"](spark, sf).collect()}
    rows = documents.orderBy("doc_id").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    for row, value, least in zip(rows, prints, classes(prints, [r.doc_id for r in rows]), strict=True):
        assert (got[row.doc_id].fingerprint, got[row.doc_id].component_id) == (f"{value:016x}", least)


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_any_number_of_blocks_finds_every_link(spark, blocks):
    rng = np.random.default_rng(blocks)
    points = rng.integers(0, 1 << 63, 60, dtype=np.uint64)[rng.integers(0, 60, 600)]
    for _ in range(3):
        points = points ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64))
    points = np.unique(points)
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    found = components.connected_components(simhash.links(frame, 3, blocks)).collect()
    label = {r.node: r.root for r in found}
    want = classes(points.tolist(), points.view(np.int64).tolist())
    assert [label.get(p, p) for p in points.view(np.int64).tolist()] == want


def test_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000 + i, 5000) for i in range(50)], "a long, b long")
    found = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert found == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(50)} | {5000: 1000}


def test_odd_rows(make_docs, odd_rows):
    found = simhash.near_duplicates(make_docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    texts = dict((k, t) for k, t in odd_rows)
    prints = [plain_fingerprint(t) for _, t in odd_rows]
    label = dict(zip(odd_rows, classes(prints, [k for k, _ in odd_rows]), strict=True))
    for r in found:
        assert r.fingerprint & (1 << 64) - 1 == plain_fingerprint(texts[r.doc_id])
        assert r.component_id == label[(r.doc_id, texts[r.doc_id])]
    kept = simhash.keep_one_per_group(make_docs(odd_rows))
    assert kept.columns == make_docs([]).columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted({v for v in label.values() if v is not None})
    assert kept.filter("doc_id is null").count() == 1
    assert simhash.near_duplicates(make_docs([])).count() == 0 and simhash.keep_one_per_group(make_docs([])).count() == 0


def test_copies_leave_one(make_docs):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    text = " ".join(rng.choice(words) for _ in range(300))
    copies = (text.split(" ")[:i] + ["changed"] + text.split(" ")[i + 1 :] for i in range(300))
    linked = lambda t: (plain_fingerprint(t) ^ plain_fingerprint(text)).bit_count() <= 3
    near = next(c for c in copies if linked(" ".join(c)))
    other = " ".join(rng.choice(words) for _ in range(300))
    docs = make_docs([(5, text), (3, text), (9, " ".join(near)), (4, other)])
    assert sorted(r.doc_id for r in simhash.keep_one_per_group(docs).collect()) == [3, 4]


def test_rows_of_one_key_are_judged_by_their_groups(make_docs):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    a, b, c, d, e = (" ".join(rng.choice(words) for _ in range(200)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (None, c), (1, c), (1, d), (2, d), (2, e), (3, e), (4, a)]
    kept = simhash.keep_one_per_group(make_docs(rows)).collect()
    # the least key of each group, whatever the key stands for elsewhere
    assert sorted(((r.doc_id or 0), r.text) for r in kept) == sorted([(4, a), (0, b), (1, c), (1, d), (2, e)])
    many = make_docs([(None, f"{a} {i}") for i in range(3)] + [(None, " ".join(rng.choice(words) for _ in range(50))) for _ in range(20)])
    assert simhash.keep_one_per_group(many).count() == 21
