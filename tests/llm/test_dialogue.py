"""Conversation repair against an exhaustive search."""

import hashlib
import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from farelens.llm import dialogue
from farelens.llm.queries import damaged_conversations, op13_conversation_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def _faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def _inserts():
    return ["", "u", "a", "ua", "au"]


def _exhaustive(rows):
    """Least (cost, audit, lines) over every edit of every row with up to two inserts in every gap."""
    roles = {"u": "user", "a": "assistant"}
    paths = {("", 0, ())}  # letters, cost, written (initial, line)
    faults = _faults(rows)
    for (_, role, text), fault in zip(rows, faults):
        new = set()
        for letters, cost, lines in paths:
            for put in _inserts():
                own = letters + "I" * len(put)
                c = cost + 3 * len(put)
                written = lines + tuple((i, f"{roles[i]}:") for i in put)
                new.add((own + "D", c + 4, written))
                if fault in ("blank", "duplicate"):
                    continue
                c += 3 if fault == "truncated" else 0
                new.add((own + "K", c, written + ((role[:1] or "?", f"{role}:{text}"),)))
                for i, r in roles.items():
                    new.add((own + "R", c + 3, written + ((i, f"{r}:{text}"),)))
        # a prefix that no continuation can mend goes
        paths = {p for p in new if re.match(r"(s?(ua)*u?)?\Z", "".join(i for i, _ in p[2]))}
    done = []
    for letters, cost, lines in paths:
        for put in _inserts():
            full = lines + tuple((i, f"{roles[i]}:") for i in put)
            if GRAMMAR.match("".join(i for i, _ in full)):
                done.append((cost + 3 * len(put), letters + "I" * len(put), "\n".join(x for _, x in full)))
    return min(done)


def _want(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = _faults(rows)
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, text = _exhaustive(rows)
    n = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *n, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_cheapest_edits_match_an_exhaustive_search(spark):
    rng = random.Random(7)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why? ", "Ünd so. \n"]
    held = {}
    for conv in range(150):
        n = rng.randint(1, 5)
        held[conv] = [(rng.choice([None, 0, 1, 2, 3, 7]), rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(texts)) for _ in range(n)]
    for conv, roles in enumerate(product(["system", "user", "assistant"], repeat=4), 1000):
        held[conv] = [(i, r, f"{i}.") for i, r in enumerate(roles)]
    held[None] = [(1, "user", "Null conversation."), (1, "user", "Null conversation."), (None, "assistant", "x")]
    rows = [(c, *r) for c, own in held.items() for r in own]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"own {c}") for c in ("fault", "at", "edit", "repeated", "cost", "illegal")})
    got = dialogue.digests(dialogue.edits(df.repartition(3)))
    assert _rows(got) == sorted((_want(c, own) for c, own in held.items()), key=repr)


def test_edit_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", "cut"), (1, 3, None, None), (1, 4, "user", "End.")]
    got = [tuple(r) for r in dialogue.edits(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert [r[2] for r in got] == list("KIKDDKI") or sum(r[3] for r in got) == _want(1, [(t, r or " ", x or " ") for _, t, r, x in rows])[6]
    assert [r[1] for r in got] == list(range(len(got)))
    assert [r[4] for r in got if r[2] != "I"] == [None, None, "truncated", "blank", None]
    written = "".join(r[7][0] for r in got if r[7] is not None)
    assert GRAMMAR.match(written)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert dialogue.edits(df).count() == 0
    assert dialogue.digests(dialogue.edits(df)).count() == 0


@pytest.mark.parametrize("roles", ["ua", "sua", "uaa", "uaaau"])
def test_memory_stays_bounded(roles):
    """A long conversation is settled as it is read: the tree holds a few rows."""
    search, settled, most = dialogue.Search(), 0, 0
    names = {"s": "system", "u": "user", "a": "assistant"}
    n = 20_000
    for i in range(n):
        r = roles[i % len(roles)]
        settled += sum(e[2] is not None for e in search.step((i, None, False), r, names[r], f"{i}.", None))
        most = max(most, i + 1 - settled)
    settled += sum(e[2] is not None for e in search.finish())
    assert settled == n and most < 64


def test_open_ends_take_linear_time():
    """User rows alone: which to rerole depends on their number, so all of them wait."""
    search, out = dialogue.Search(), []
    for i in range(60_001):
        out += search.step((i, None, False), "u", "user", f"{i}.", None)
    out += search.finish()
    assert "".join(e[0] for e in out[:2]) in ("KI", "KR", "DK") and sum(e[1] for e in out) == 3 * 30_000 + 3


def test_long_text_and_hot_conversation(spark):
    long = "x" * 300_000 + "."
    rows = [(5, i, "user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(4000)] + [(6, 0, "user", long), (6, 1, "assistant", long)]
    rows += [(7 + i, 0, "user", "Hi.") for i in range(500)]
    got = {r.conv_id: r for r in dialogue.digests(dialogue.edits(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got[5].audit == "K" * 4000 and got[5].cost == 0 and got[6].audit == "KK"
    assert got[6].repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()
    assert got[8].audit == "D" * (got[8].cost == 4) or got[8].audit == "KI"


def test_damage(spark):
    rows = [(c, t, "assistant", "A b. C?") for c in range(40) for t in (0, 1, None)] + [(None, None, None, None)]
    got = damaged_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    import zlib

    want = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x, r = " " if x is None else x, " " if r is None else r
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        want += [(c, t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_query_returns_every_conversation(spark, tmp_path):
    import zlib

    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows = [(c, 0, "user", "Hi.") for c in gone] + [(None, None, "user", "Hi.")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {*gone, None}
    empty = hashlib.sha256(b"").hexdigest()
    assert all(tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", empty) for c in gone)
