"""The conversation trie against plain prefixes: long and repeated conversations, lenders, nulls, and many shards."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from hourvault.llm import conversation_trie as ct

SCHEMA = "conv_id bigint, turn bigint, role string, text string, a string, depth int, id string, _at int"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        lender = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        rebuilt = own.get(lender, [])[:h] + own[c][h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
        ends[tuple(rebuilt)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[x] for x in children[p])
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def made():
    r = random.Random(3)
    texts = ["", "a", "b", "Längeres ünd \U0001f600", "x" * 30_000]
    rows = []
    for c in [*range(0, 60), *range(95, 330, 3), 1007, 1107, -5, -200, -203]:
        if c % 100 == 0 and c >= 300:
            continue
        for k in range(r.randrange(1, 9)):
            rows.append((c, k, r.choice(["user", "assistant", None]), r.choice(texts)))
    # A long conversation, and two that share most of it; many copies of one; ties and repeated rows; null turns and ids.
    long = [(k, "user", f"turn {k}") for k in range(700)]
    rows += [(500, *t) for t in long] + [(501, *t) for t in long[:650]] + [(517, *t) for t in [*long[:300], (300, "user", "else"), *long[301:]]]
    rows += [(2000 + k, j, "user", f"copy {j}") for k in range(400) for j in range(3)]
    rows += [(700, 1, "user", "tie"), (700, 1, "user", "eit"), (700, None, "user", "null"), (700, None, None, None)] * 3
    return rows + [(None, 1, "user", "no id"), (None, None, None, None)]


ROWS = made()


@pytest.mark.parametrize("shard_nodes, queue_rows, stretch", [(ct.SHARD_NODES, ct.QUEUE_ROWS, ct.STRETCH), (40, 5, 50)])
def test_against_brute_force(spark, shard_nodes, queue_rows, stretch, monkeypatch):
    monkeypatch.setattr(ct, "STRETCH", stretch)
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in ROWS], SCHEMA).repartition(5)
    found = ct.conversation_trie(df, shard_nodes=shard_nodes, queue_rows=queue_rows)
    assert found.columns == ct.RESULT
    assert sorted(map(tuple, found.collect())) == brute(ROWS)


def test_lists_that_tasks_share(spark, monkeypatch):
    monkeypatch.setattr(ct, "LIST_IDS", 7)
    rows = [(1, 2, 3, k) for k in range(500)] + [(k, k, 1, -k) for k in range(50)]
    rows += [(9, 9, 9, k) for k in (-8, -7, -1, 0, 1, 6, 7)]
    got = ct.end_hashes(spark.createDataFrame(rows, "a bigint, b bigint, depth bigint, conv_id bigint").repartition(4)).collect()
    assert len(got) == 52
    assert {g.ends_sha256 for g in got if g.a == 9 and g.b == 9 and g.depth == 9} == {hashlib.sha256(b"-8,-7,-1,0,1,6,7").hexdigest()}
    assert {g.ends_sha256 for g in got if g.a == 1 and g.b == 2} == {hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest()}


def test_queue_spills_and_adds_up():
    queue, r, want = ct.SpillingQueue(10), random.Random(1), defaultdict(lambda: [0, 0])
    for _ in range(500):
        key = r.randrange(-5, 5), r.randrange(8)
        queue.push((*key, 1, 2))
        want[key][0] += 1
        want[key][1] += 2
    assert len(queue.heads) > 3
    for key in sorted(want):
        assert queue.first() == key and queue.pop_all(*key) == tuple(want[key])
    assert queue.first() is None


def test_small_tables(spark):
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in ROWS], SCHEMA)
    assert ct.conversation_trie(df.limit(0)).collect() == []
    assert ct.conversation_trie(df.filter("conv_id IS NULL")).collect() == []
    # Without its lender, a conversation of fewer turns than its head is turnless and ends at the root.
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(alone, 1, "user", "x")]
    got = ct.conversation_trie(spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)).collect()
    assert sorted(map(tuple, got)) == brute(rows) and len(got) == 1
