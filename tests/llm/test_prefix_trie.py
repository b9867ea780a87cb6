import hashlib
import random
import zlib

from newsloom.llm import prefix_trie, registry
from tests.llm.cases import ODD_TEXTS, save

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def remainder(c):
    return abs(c) % 5 * (1 if c >= 0 else -1)


def brute(rows):
    """rows of (conv_id, turn, role, text); turns of a conversation have different numbers"""
    given = {}
    for c, turn, role, text in rows:
        if c is not None:
            given.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [t[2:] for t in sorted(turns)] for c, turns in given.items()}
    built = {}
    for c, turns in given.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = given.get(c - remainder(c), [])[:h] + turns[h:]
    members = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members.setdefault(tuple(built[c][:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[b] for b in below)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(node))
        out.append((
            convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children.get(node, [])), leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def run(spark, folder):
    return sorted((tuple(r) for r in registry.op11_prefix_trie(spark, str(folder)).collect()), key=str)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, SF) == brute(rows)


def odd_conversations(seed):
    rng = random.Random(seed)
    texts, rows = ["a", "b", "", None, "é long one"], []
    for c in [*range(-12, 40), 10**12, 10**12 + 1, 95, 97]:
        n = rng.choice([1, 1, 2, 3, 5, 8, 9, 17, 33])
        turns = rng.sample(range(-5, 100), n)
        rows += [(c, t, rng.choice(["user", None, ""]), rng.choice(texts)) for t in turns]
    rows += [(60 + i, t, "user", "same") for i in range(30) for t in range(20)]  # copies
    rows += [(200, t, "user" if t % 2 else None, ODD_TEXTS[t % len(ODD_TEXTS)]) for t in range(130)]  # a long one
    rows += [(201, t, "user" if t % 2 else None, ODD_TEXTS[t % len(ODD_TEXTS)]) for t in range(128)]
    rows += [(300 + i, None if t == 0 else t, "user", "x") for i in range(8) for t in range(64)]
    rows += [(None, 1, "user", "no conversation"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def test_odd_conversations(spark, tmp_path):
    rows = odd_conversations(1)
    extra = [(*r, "clash", b"x", 1) for r in rows]
    save(spark.createDataFrame(extra, SCHEMA + ", conv string, node binary, n long"), tmp_path, "conversations")
    expected = brute(rows)
    assert run(spark, tmp_path) == expected
    assert max(r[1] for r in expected) == 130 and any(r[3] > 20 for r in expected)


def test_names_lead_to_the_parents(spark):
    found = prefix_trie.trie(spark.createDataFrame(odd_conversations(2), SCHEMA)).collect()
    nodes = {bytes(r.node): r for r in found}
    assert len(nodes) == len(found)
    for r in found:
        if r.depth:
            parent = nodes[bytes(r.parent)]
            assert (parent.conv_id, parent.depth) == (r.parent_conv_id, r.depth - 1) and parent.n_convs >= r.n_convs


def test_one_conversation_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(7, t, "user", f"t{t % 50}") for t in range(3000)] + [(c, 1, "user", "t1") for c in range(8, 40)]
        found = prefix_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA)).where("conv = 7").collect()
        assert sorted(r.place for r in found) == list(range(1, 3001))
        got = sorted((tuple(r) for r in prefix_trie.trie_report(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
        assert got == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_ties_repeats_and_conversations_without_turns(spark):
    turns = [(5, 1, "user", "a"), (5, 1, "user", "a"), (5, 1, "bot", "b")]
    found = prefix_trie.trie_report(spark.createDataFrame(turns, SCHEMA)).collect()
    again = prefix_trie.trie_report(spark.createDataFrame(turns[::-1], SCHEMA)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)
    assert max(r.depth for r in found) <= 3
    lone = [(c, 0, "user", "only") for c in (11, 12, 13, 14, 16, 17)]  # without 10 and 15 most of these have no turn
    got = sorted((tuple(r) for r in prefix_trie.trie_report(spark.createDataFrame(lone, SCHEMA)).collect()), key=str)
    assert got == brute(lone)
    assert prefix_trie.trie_report(spark.createDataFrame([], SCHEMA)).collect() == []
