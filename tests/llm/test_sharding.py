import hashlib
from collections import Counter

import pytest

from tabwright.llm import sharding


def brute(shards, slots):
    """Each shard's whole permutation, then turns."""
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    order = {s: [(number(f"{s}/offset") % slots + j * (number(f"{s}/stride") % (slots - 1) + 1)) % slots for j in range(slots)] for s in sorted(shards)}
    assert all(sorted(o) == list(range(slots)) for o in order.values())
    taken = {}
    while len(taken) < slots:
        for s, o in order.items():
            free = next((x for x in o if x not in taken), None)
            if free is not None:
                taken[free] = s
    return [taken[i] for i in range(slots)]


def test_table_against_brute_force():
    names = ["b", "a", "delta", "c"]
    assert [names[i] for i in sharding.lookup_table(names, 101)] == brute(names, 101)
    sizes = Counter(sharding.lookup_table(names, 101)).values()
    assert max(sizes) - min(sizes) <= 1


def test_removing_a_shard_moves_little():
    names = [f"s{i}" for i in range(16)]
    before = [names[i] for i in sharding.lookup_table(names, 4099)]
    rest = names[:5] + names[6:]
    after = [rest[i] for i in sharding.lookup_table(rest, 4099)]
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != "s5")
    assert moved < 0.1 * 4099


def test_bad_tables():
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)


def test_place_corner_cases(spark, docs_of):
    df = docs_of([(i, None) for i in range(300)] + [(None, "x"), (None, "y"), (7, "again")]).selectExpr("*", "'old' AS shard", "1 AS slot", "2 AS __x")
    got = sharding.place(df, "doc_id", ["a", "b", "c"], 101).collect()
    assert len(got) == 303 and got[0].asDict().keys() >= {"doc_id", "text", "slot", "shard", "__x"}
    table = brute(["a", "b", "c"], 101)
    for r in got:
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (slot, table[slot])
    assert sharding.place(df.limit(0), "doc_id", ["a"], 7).collect() == []


def test_write_shards(spark, docs_of):
    from tabwright.llm.common import shared_folder

    path = shared_folder(spark, "shards")
    sharding.write_shards(sharding.place(docs_of([(i, "t") for i in range(50)]), "doc_id", ["a", "b"], 101), path, 2)
    assert spark.read.parquet(path).count() == 50
