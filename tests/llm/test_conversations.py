import hashlib
import random
import re
import zlib

import pytest

from cohortlab.llm import conversations as C
from cohortlab.llm.queries import op13_repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\v\f\r"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv, role, text = (" " if x is None else x for x in (conv, role, text))
        fault = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def plain_report(rows):
    """The contract step by step: rows of one conversation, in order."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.rstrip(SPACES)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else
                      "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # best[state]: cost, audit and lines of the rest, from the last row backwards
    def closed(best):
        while True:
            old = dict(best)
            for q in best:
                for r, name in (("u", "user"), ("a", "assistant")):
                    if (q, r) in STEP and best[STEP[q, r]] is not None:
                        cost, audit, lines = best[STEP[q, r]]
                        new = (cost + 3, "I" + audit, [f"{name}:"] + lines)
                        best[q] = new if best[q] is None else min(best[q], new, key=lambda x: x[:2])
            if best == old:
                return best
    best = closed({"": (0, "", []), "s": None, "u": None, "a": (0, "", [])})
    for (_, _, role, text), fault in reversed(list(zip(rows, faults))):
        now = {}
        for q in best:
            ways = []
            if best[q] is not None:
                ways.append((best[q][0] + 4, "D" + best[q][1], best[q][2]))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                for name, letter, cost in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    to = STEP.get((q, name[:1]))
                    if to and best[to] is not None:
                        c, audit, lines = best[to]
                        ways.append((c + cost + extra, letter + audit, [f"{name}:{text}"] + lines))
            now[q] = min(ways, key=lambda x: x[:2]) if ways else None
        best = closed(now)
    cost, audit, lines = best[""]
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def plain(rows):
    """Reports of all conversations; `rows` in no order."""
    ids = {" " if r[0] is None else r[0] for r in rows}
    damaged = plain_damage(rows)
    out = {}
    for conv in ids:
        own = [r for r in damaged if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        out[None if conv == " " else conv] = plain_report(own)[0]
    return out


def collected(df):
    cols = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out = {}
    for r in df.collect():
        assert r["conv_id"] not in out
        out[r["conv_id"]] = tuple(r[c] for c in cols)
    return out


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
                              if rng.random() < .4 else [["user", "assistant"][turn % 2]])
            text = rng.choice(["Yes.", "No", "What?", " \n", "", None, f"{turn}.", f"so {turn}", "end! ", "é"])
            if rng.random() < .9:
                rows.append((conv, turn if rng.random() < .95 else None, role, text))
    return rows


def test_against_the_contract_step_by_step(spark):
    rows = random_rows(1, 150, 14) + [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(C.digests(C.damage(df), ids=df)) == plain(rows)


def test_long_conversations_are_joined_from_chunks(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 5)
    monkeypatch.setattr(C, "FAN", 2)
    rows = random_rows(2, 6, 300)
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(C.digests(C.damage(df), ids=df)) == plain(rows)


def test_given_tables(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(op13_repair(spark, path)) == plain(rows)


@pytest.mark.parametrize("seed", range(40))
def test_search_takes_the_least_audit_of_the_cheapest(seed):
    rng = random.Random(seed)
    symbols = "".join(rng.choice("suax") + rng.choice("-!#") for _ in range(rng.randint(0, 9)))
    # every path, by brute force
    best = None
    rows = [symbols[i:i + 2] for i in range(0, len(symbols), 2)]

    def walk(i, q, cost, audit, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and q in C.ENDS:
            best = min(best or (cost, audit), (cost, audit))
        if i < len(rows):
            for a, b, step, letter in C.row_edges(rows[i]):
                if a == q:
                    walk(i + 1, b, cost + step, audit + letter, 0)
        if inserted < 3:
            for a, b, step, letter in C.INSERTIONS:
                if a == q:
                    walk(i, b, cost + step, audit + letter, inserted + 1)
    walk(0, C.START, 0, "", 0)
    assert C._whole(symbols) == best


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "a?"), (1, 2, "user", "b?"), (1, 3, "assistant", "c."), (2, 0, "tool", " ")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", place string")
    got = sorted(tuple(r) for r in C.repair(df).collect())
    assert got == [(1, 0, "K", 0, "system", "s."), (1, 1, "K", 1, "user", "a?"), (1, 2, "I", None, "assistant", ""),
                   (1, 3, "K", 2, "user", "b?"), (1, 4, "K", 3, "assistant", "c.")]
    report = {r["conv_id"]: r for r in C.reports(df).collect()}
    assert report[1]["audit"] == "KKIKK" and report[1]["cost"] == 3 and report[1]["illegal"] == 1
    assert report[2]["audit"] == "D" and report[2]["blank"] == 1


def test_empty_table_repeated_rows_and_very_long_text(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.digests(C.damage(empty), ids=empty).count() == 0 and C.repair(empty).count() == 0
    rows = [(7, 1, "user", "hello " * 200_000 + "?")] * 3 + [(7, 2, "assistant", "x.")] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(C.digests(C.damage(df), ids=df)) == plain(rows)
