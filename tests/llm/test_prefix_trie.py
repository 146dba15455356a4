"""Tries of rebuilt conversations against plain Python; the decomposition in tasks and in rounds."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from fieldmart.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, node long, size string, depth int"


def plain(rows):
    """Every node by a plain dictionary of beginnings."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    length = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = own.get(c - c % 5, [])[:h] + ts[h:]
        length[c] = len(seq)
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved, out = {}, {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[c] for c in children[k]) or 1
        saved[k] = sum(saved[c] for c in children[k]) + ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0)
        ends = ",".join(str(c) for c in sorted(members[k]) if length[c] == len(k))
        out[min(members[k]), len(k)] = (min(members[k[:-1]]) if k else None, len(members[k]), len(children[k]), leaves[k], saved[k],
                                        hashlib.sha256(ends.encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def talk(rng, convs, words, turns):
    rows = []
    for c in convs:
        for t in range(rng.randint(1, turns)):
            rows.append((c, rng.choice([t, t, None, 3]), rng.choice(["user", "user", None]), rng.choice(words), c, "x", 1))
    return rows


@pytest.fixture(scope="module")
def chats(spark):
    """Few texts, so that beginnings are shared; ties and nulls of turns; one long conversation; a chain; repeated rows."""
    rng = random.Random(11)
    rows = talk(rng, range(1, 160), ["a", "é", None, "bcd"], 6) + talk(rng, range(500, 560), ["a"], 9)
    rows += [(1000, t, "user", f"w{t % 7}", 0, "x", 1) for t in range(700)] + [(1001, t, "user", f"w{t % 7}", 0, "x", 1) for t in range(650)]
    rows += [(None, 1, "user", "lost", 0, "x", 1)] + rows[:20] * 2
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(6)


@pytest.mark.parametrize("component_rows", [50_000, 40, 3])
def test_trie_equals_brute_force(chats, component_rows):
    rows, df = chats
    assert found(T.prefix_trie(*T.rebuilt(df), component_rows=component_rows)) == plain(rows)


def test_names_carry_over_blocks(chats, monkeypatch):
    rows, df = chats
    turns, lengths = T.rebuilt(df)
    wide = {(r.conv_id, r.depth): (r.name_a, r.name_b) for r in T.named_beginnings(turns).collect()}
    assert wide == {(r.conv_id, r.depth): (r.name_a, r.name_b) for r in T.named_beginnings(turns, block_turns=16).collect()}
    monkeypatch.setattr(T, "PIECE_BYTES", 8)
    assert found(T.prefix_trie(turns, lengths)) == plain(rows)


@pytest.mark.parametrize("shape", ["path", "star", "broom", "random"])
def test_decomposition_in_a_task(shape):
    rng = random.Random(shape)
    n = 500
    parent = {"path": [i - 1 for i in range(n)], "star": [-1] + [0] * (n - 1), "broom": [i - 1 if i < 250 else 249 for i in range(n)],
              "random": [-1] + [rng.randrange(i) for i in range(1, n)]}[shape]
    weights = [rng.randint(0, 9) for _ in range(n)]
    expected = list(weights)
    for v in range(n - 1, 0, -1):
        expected[parent[v]] += expected[v]
    assert T.centroid_sums(parent, weights, [1] * n)[0] == expected


def test_only_short_and_turnless_conversations(spark):
    """Conversations whose own turns all go: members of the root or of a family's start."""
    rows = [(c, t, "u", "x") for c in range(40) if c % 5 for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = found(T.prefix_trie(*T.rebuilt(df)))
    assert got == plain(rows) and got[1, 0][1] == 32


def test_empty_table(spark, chats):
    assert T.prefix_trie(*T.rebuilt(chats[1].limit(0))).count() == 0
