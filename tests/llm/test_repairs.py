"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from conftest import SF_DIR

from millrace.llm import repairs
from millrace.llm.queries import QUERIES

_SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, plan int"


def plain_repair(rows):
    """Counts, cost, audit and hash of one conversation's rows (turn, role, text), in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, got, out = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", got):
            break
        if (i, got) in done or not re.fullmatch(r"s?(ua)*u?", got):
            continue
        done.add((i, got))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", i, got + role[0], (*out, (role, ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, got, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] else 0
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, got + (role[:1] or "?"), (*out, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, got + new[0], (*out, (new, text))))
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }


def plain_damage(rows):
    """Rows (conv, turn, role, text) by conversation, after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        mine += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def check(got, rows):
    expected = {conv: plain_repair(mine) for conv, mine in plain_damage(rows).items()}
    assert len(got) == len(expected)
    for r in got:
        assert {k: v for k, v in r.asDict().items() if k != "conv_id"} == expected[r.conv_id]


def test_query_equals_the_search_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(QUERIES["op11_conversation_repair"](spark, SF_DIR).collect(), rows)


@pytest.fixture(scope="module")
def odd_rows():
    draw = random.Random(5)
    rows = [
        (c, draw.choice([None, 0, 1, 1, 2, 3, 3, 5, 9]), draw.choice(["user", "assistant", "system", "tool", "", None, "u"]), draw.choice([None, "", "A.", "B", "C!", " \t", "D? "]))
        for c in range(300) for _ in range(draw.randrange(1, 8))
    ]
    return rows + [(None, 1, "user", "x" * 100_000), (None, None, "assistant", "ok."), *[(7, 1, "user", "A.")] * 3]


def test_random_conversations_with_ties_nulls_and_clashing_columns(spark, odd_rows):
    rows = spark.createDataFrame([(*r, "x", 3) for r in odd_rows], _SCHEMA)
    check(repairs.repair_digests(repairs.damaged(rows)).collect(), odd_rows)


def test_repaired_turns_follow_the_grammar(spark, odd_rows):
    turns = repairs.damaged(spark.createDataFrame([(*r, "x", 3) for r in odd_rows], _SCHEMA))
    by: dict = {}
    for r in sorted(repairs.repaired_turns(turns).collect(), key=lambda r: r.n):
        by.setdefault(r.conv_id, []).append(r)
    for conv, mine in plain_damage(odd_rows).items():
        out = by.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in out)) and [r.n for r in out] == list(range(len(out)))
        text = "\n".join(f"{r.role}:{r.text}" for r in out)
        assert hashlib.sha256(text.encode()).hexdigest() == plain_repair(mine)["repaired_sha256"]


def test_empty_table_and_a_long_conversation(spark):
    empty = spark.createDataFrame([], _SCHEMA)
    assert repairs.repair_digests(repairs.damaged(empty)).count() == 0 and repairs.repaired_turns(empty).count() == 0
    long = spark.range(30_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id, '.') AS text")
    row = repairs.repair_digests(long).first()
    assert (row.cost, row.audit, row.illegal) == (0, "K" * 30_000, 0)


def test_equal_endings_are_one_node():
    endings = repairs.Endings()
    assert endings.solve("auau") == (0, "KKKK")
    held = list(endings.path)
    assert endings.solve("auas")[0] > 0 and all(a is b for a, b in zip(endings.path, held[:4]))
