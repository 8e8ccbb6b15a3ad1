"""Trie of conversations against plain dictionaries, with containers of all sizes, and odd rows."""

import hashlib
import random
import re
import zlib

import pytest

from seriesmill.llm.prefix_trie import prefix_trie, sequences, with_shared_heads

SCHEMA = "conv_id long, turn long, role string, text string, seq int, head string, n_convs long, words string"


def turn_id(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()[:32], len(re.findall(r"[^\x20\x09-\x0D]+", text))


def rebuilt_by_force(rows):
    own = {}
    for r in rows:
        if r[0] is not None:
            own.setdefault(r[0], []).append(((r[1] is not None, r[1] or 0), turn_id(r[2], r[3])))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + seq[h:]
    return out


def by_force(found):
    members = {}
    for c, seq in found.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children, leaves, saved = ({k: 0 for k in members} for _ in range(3))
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, ids in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(ids) - 1) * k[-1][1] if k else 0
    ends = {}
    for c, seq in found.items():
        ends.setdefault(tuple(seq), []).append(c)
    return sorted(
        (
            (min(ids), len(k), min(members[k[:-1]]) if k else None, len(ids), children[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest())
            for k, ids in members.items()
        ),
        key=repr,
    )


def conversations(seed, n):
    rng = random.Random(seed)
    text = ["", None, "one", "two words", "three  more\twords", "é\x0bü"]
    rows = []
    for c in rng.sample(range(-30, 6 * n), n):
        kind = rng.random()
        if kind < 0.3:  # copies
            turns = [("user", "hot start"), ("assistant", "same answer"), ("user", "bye bye")]
        elif kind < 0.6:  # a long way in common
            turns = [("user", "hot start")] + [("assistant", f"step {k}") for k in range(rng.choice([9, 10, 11]))] + [("user", rng.choice("ab"))]
        else:
            turns = [(rng.choice(["user", None, "system"]), rng.choice(text)) for _ in range(rng.randint(1, 6))]
        order = rng.choice([list(range(len(turns))), [None, *range(1, len(turns))], [7 * k - 9 for k in range(len(turns))]])
        rows += [(c, t, *x, 3, "h", 2, "w") for t, x in zip(order, turns, strict=True)]
    return rows


@pytest.mark.parametrize("most", [1, 40, 100_000])
def test_trie_by_force(spark, most):
    rows = conversations(most, 300)
    rows += rows[:7] + [(None, 1, "user", "nobody", 0, "", 0, "")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = with_shared_heads(sequences(table)).cache()
    want = rebuilt_by_force(rows)
    assert {r.conv_id: [(bytes(t.turn).hex(), t.words) for t in r.seq] for r in found.collect()} == want
    assert any(not seq for seq in want.values())
    assert sorted(map(tuple, prefix_trie(found, most).collect()), key=repr) == by_force(want)


def test_one_conversation_no_conversation_and_turnless_ones(spark):
    assert prefix_trie(with_shared_heads(sequences(spark.createDataFrame([], SCHEMA)))).collect() == []
    for rows in ([(20, 0, "user", "a b", 0, "", 0, "")], [(c, 0, None, None, 0, "", 0, "") for c in range(41, 60)]):
        found = with_shared_heads(sequences(spark.createDataFrame(rows, SCHEMA)))
        assert sorted(map(tuple, prefix_trie(found).collect()), key=repr) == by_force(rebuilt_by_force(rows))
