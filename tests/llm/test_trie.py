import hashlib
import random
import zlib
from collections import Counter

import pytest

from tidegate.llm.trie import Node, Part, insert, prefix_trie, regrown, sequences, walk

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string"


def turn_key(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def rebuilt_of(rows):
    own = {}
    for conv, turn, role, text, _ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, turn_key((role or "", text or "")), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    return out


def brute_force(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = Counter(way[:-1] for way in members if way)
    out = []
    for way, own in members.items():
        below = [w for w in members if w[: len(way)] == way]
        ends = sorted(c for c in own if convs[c] == way)
        out.append(
            (
                min(own),
                len(way),
                min(members[way[:-1]]) if way else None,
                len(own),
                children[way],
                sum(not children[w] for w in below),
                sum((len(members[w]) - 1) * len(w[-1][1].encode()) for w in below if w),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def conversations(n, seed=2, most=12):
    rng = random.Random(seed)
    texts = [None, "", "hello", "Zoë", "a longer text of a turn", "x"]
    roles = [None, "", "user", "assistant"]
    rows = [(c, rng.choice([None, *range(most)]), rng.choice(roles[2:] if rng.random() < 0.8 else roles), rng.choice(texts), "clash") for c in range(n) for _ in range(rng.randint(1, most))]
    return rows + [(None, 1, "user", "left out", None)]


def result(spark, frame, **options):
    return sorted(map(tuple, prefix_trie(frame, **options).collect()), key=str)


@pytest.mark.parametrize("part_turns", [40, 1 << 14])
def test_equals_brute_force(spark, part_turns):
    rows = conversations(60)
    got = result(spark, regrown(sequences(spark.createDataFrame(rows, SCHEMA))), part_turns=part_turns)
    assert got == brute_force(rebuilt_of(rows))


def test_one_begin_in_most_conversations_and_many_copies(spark):
    rows = [(c, t, "user", f"same {t}", None) for c in range(300) for t in range(3)]
    rows += [(c, 3, "user", f"own {c}", None) for c in range(0, 300, 4)] + [(1000, t, "user", "long", None) for t in range(500)]
    convs = {}
    for c, t, role, text, _ in rows:
        convs.setdefault(c, []).append((role, text))
    got = result(spark, sequences(spark.createDataFrame(rows, SCHEMA)), part_turns=100)
    assert got == brute_force({c: tuple(turns) for c, turns in convs.items()})


def test_many_ids_end_at_one_node(spark):
    ids = [7, 5000, 12, 4096, 4095, 100_000, -3, 8192]
    frame = spark.createDataFrame([(c, 0, "user", "t", None) for c in ids], SCHEMA)
    (end,) = [r for r in prefix_trie(sequences(frame), part_turns=2).collect() if r.depth == 1]
    assert end.ends_sha256 == hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert (end.conv_id, end.n_convs, end.saved_tokens) == (-3, 8, 7)


def test_empty_table_and_turnless_conversations(spark):
    assert result(spark, sequences(spark.createDataFrame([], SCHEMA))) == []
    rows = [(c, 0, "user", "t", None) for c in range(1, 5)]  # no base, so some are left without turns
    convs = rebuilt_of(rows)
    assert () in convs.values()
    assert result(spark, regrown(sequences(spark.createDataFrame(rows, SCHEMA)))) == brute_force(convs)


def test_layouts_grow_and_hold_their_children_in_order():
    rng = random.Random(4)
    for n in (3, 4, 5, 16, 17, 48, 49, 256):
        node, children = Node(b""), {}
        for byte in rng.sample(range(256), n):
            children[byte] = Node(bytes([byte]))
            node.put(byte, children[byte])
        assert node.room == next(room for room in (4, 16, 48, 256) if n <= room)
        assert [b for b, _ in node.children()] == sorted(children)
        assert all(node.child(b) is children.get(b) for b in range(256))
        again = Node(b"again")
        node.put(byte, again)
        assert node.child(byte) is again and node.count == n


def test_only_whole_turns_are_nodes_and_paths_are_compressed():
    rng = random.Random(6)
    turns = [bytes(rng.choice(b"ab") for _ in range(4)) for _ in range(12)]  # ids that share bytes
    keys = [b"".join(rng.choice(turns) for _ in range(rng.randint(0, 6))) for _ in range(200)]
    root = Node(b"")
    for number, key in enumerate(keys):
        insert(root, key, number)
    want = {key[:d] for key in keys for d in range(0, len(key) + 1, 4)}
    ways, ends = [b""], {}
    for number, parent, turn, node in walk(root, 4):
        if number:
            assert len(turn) == 4 and parent < number
            ways.append(ways[parent] + turn)
        for k in node.ends if node else ():
            ends[k] = ways[number]
    assert len(ways) == len(want) and set(ways) == want
    assert [ends[k] for k in range(len(keys))] == keys
    lone = Node(b"")
    insert(lone, b"x" * 400, 0)
    assert lone.count == 1 and next(iter(lone.children()))[1].prefix == b"x" * 400


def test_a_very_long_conversation():
    ids = [hashlib.sha256(str(i).encode()).digest()[:16] for i in range(100_000)]
    part = Part([b"".join(ids), b"".join(ids[:5000])], {i: 1 for i in ids})
    assert len(part) == 100_001 and part.depth[-1] == 100_000
