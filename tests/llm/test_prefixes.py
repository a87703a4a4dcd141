"""Conversation prefix trie against plain dictionaries and DuckDB."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from rulecheck.llm import prefix_trie

SF = "/root/testdata/sf0.001"
KIND = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, tie), role, text))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        first = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(first, [])[:h] + own[c][h:])
    members: dict[tuple, list[int]] = {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    children: dict[tuple, int] = {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if whole[c] == p)))
        above = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), above, len(m), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows, kind=KIND, extra=()):
    df = spark.createDataFrame([(*r, *extra) for r in rows], kind).repartition(3)
    return sorted(map(tuple, prefix_trie.trie(prefix_trie.rebuilt(df)).collect()), key=str)


def test_query_matches_sql(spark):
    found = prefix_trie.op11_prefixes(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    wanted = con.sql(prefix_trie.OP11_SQL)
    assert found.columns == wanted.columns
    rows = con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted.fetchall(), key=str) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_copies_prefixes_ties_and_nulls(spark, seed):
    dice = random.Random(seed)
    rows = []
    for c in [*range(-4, 60), *range(100, 130), 250, 9_000_000_000]:
        turns = dice.choice([1, 2, 3, 4, 7])
        rows += [(c, t, dice.choice(["user", "user", None]), dice.choice(["a", "é🙂", "", None])) for t in range(turns)]
    rows += [(7, None, "user", "null first"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (None, 0, "user", "nobody")]
    rows += [(c, t, "user", "same") for c in range(300, 360) for t in range(6)]
    assert nodes(spark, rows, KIND + ", depth int, node string", (3, "clash")) == brute(rows)


def test_one_conversation_holds_most_rows(spark):
    rows = [(0, t, "user", str(t % 7)) for t in range(9_000)] + [(c, t, "user", str(t % 7)) for c in (1, 2, 3) for t in range(5)]
    rows += [(4, t, "user", str(t % 7)) for t in range(5_000)]
    turns = prefix_trie.followed(prefix_trie.turns_of(spark.createDataFrame(rows, KIND)), ["turn", "key"], "turns")
    assert [r[0] for r in turns.where("c = 0").orderBy("depth").select("depth").collect()] == list(range(1, 9_001))
    found = nodes(spark, rows)
    # heads are prefixes of the long one (its own families' turns repeat), so every node lies on its path
    depths = sorted(r[1] for r in found)
    assert depths == list(range(9_001)) and all(r[5] == 1 for r in found)
    by_depth = {r[1]: r for r in found}
    assert by_depth[0][3] == 5 and by_depth[5_000][3] == 2 and by_depth[5_001][3] == 1
    assert by_depth[0][6] == 4 * 5 + 4_995 and by_depth[9_000][6] == 0
    dealt = turns.sparkSession.conf.get("spark.sql.shuffle.partitions")
    assert int(dealt) > 1


def test_empty_table_has_no_nodes(spark):
    assert nodes(spark, [], KIND) == []
    assert nodes(spark, [(None, 1, "user", "x")]) == []
