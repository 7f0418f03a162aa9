"""Conversation repair: cells against an exhaustive search, tables against a plain walk over each conversation."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import pytest

import check
from pitpanel.llm import chatrepair, queries
from pitpanel.llm.sql import SQL

SPACES = " \t\n\x0b\x0c\r"


def cheapest_by_search(symbols):
    """(cost, audit) in order of (cost, audit): the first that reads as a sound conversation is the answer."""
    heap, seen = [(0, "", "", 0)], set()
    while heap:
        cost, audit, roles, at = heapq.heappop(heap)
        if at == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        if not any(re.fullmatch("(s?(ua)+)?", roles + more) for more in ("", "a", "ua", "u")) and roles not in ("s",):
            continue
        state = (at, "" if not roles else "s" if roles == "s" else roles[-1], cost, audit)
        if state in seen:
            continue
        seen.add(state)
        for letter in "ua":
            heapq.heappush(heap, (cost + 2, audit + "I", roles + letter, at))
        if at < len(symbols):
            symbol = symbols[at]
            heapq.heappush(heap, (cost + 3, audit + "D", roles, at + 1))
            if symbol != "-":
                more = symbol.isupper()
                if symbol.lower() in "sua":
                    heapq.heappush(heap, (cost + more, audit + "K", roles + symbol.lower(), at + 1))
                for letter in "ua":
                    heapq.heappush(heap, (cost + 2 + more, audit + "R", roles + letter, at + 1))


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_cells_equal_exhaustive_search(length):
    for symbols in itertools.product("suaxSUA-", repeat=length):
        assert chatrepair.parse("".join(symbols)) == cheapest_by_search("".join(symbols)), symbols


def test_longer_intervals_and_every_cut():
    dice = random.Random(3)
    for _ in range(25):
        symbols = "".join(dice.choices("sua-UAx", k=dice.randint(4, 8)))
        assert chatrepair.parse(symbols) == cheapest_by_search(symbols), symbols
    for _ in range(20):
        symbols = "".join(dice.choices("sua-UAx", k=60))
        want = chatrepair.parse(symbols)
        cut = dice.randint(1, 59)
        assert chatrepair.cheapest(chatrepair.joined(chatrepair.interval(symbols[:cut]), chatrepair.interval(symbols[cut:]))) == want


def plain(rows):
    """The contract row by row, for the rows of one conversation after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    blank = duplicate = truncated = 0
    seen, symbols = set(), ""
    for _, role, text in rows:
        bare = text.strip(SPACES)
        letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not bare:
            blank, symbols = blank + 1, symbols + "-"
        elif (role, text) in seen:
            duplicate, symbols = duplicate + 1, symbols + "-"
        elif bare[-1] not in ".!?":
            truncated, symbols = truncated + 1, symbols + letter.upper()
        else:
            symbols += letter
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = chatrepair.parse(symbols)
    lines, roles, left = [], "", list(rows)
    for edit in audit:
        expected = "assistant" if roles[-1:] == "u" else "user"
        if edit == "I":
            lines.append(f"{expected}:")
        else:
            _, role, text = left.pop(0)
            if edit == "D":
                continue
            lines.append(f"{role if edit == 'K' else expected}:{text}")
        roles += lines[-1][0]
    assert not left and re.fullmatch("(s?(ua)+)?", roles)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def damaged(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv, turn, role, text


def expected(rows):
    out = {conv: [] for conv, *_ in rows}
    for conv, *rest in damaged(rows):
        out[conv].append(tuple(rest))
    return {conv: plain(found) for conv, found in out.items()}


def reported(spark, df):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    out = chatrepair.report(df, chatrepair.damage(df)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: tuple(r)[1:] for r in out}


SCHEMA = "conv_id long, turn long, role string, text string, c string, audit string, digest string"


def test_odd_rows(spark):
    texts = ["Fine.", "No end", " \t\n", "", None, "Ends! \x0b", "…", "Fine.", "é?"]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "User"]
    dice = random.Random(7)
    rows = [(dice.choice([1, 2, 3, 4, 5, 6, None]), dice.choice([None, 0, 1, 2, 3, 9, 12]), dice.choice(roles), dice.choice(texts)) for _ in range(400)]
    rows += [(50, None, "user", "a."), (60, 7, "system", "only."), (2**60 + 1, 0, "user", "x" * 300_000)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    assert reported(spark, df) == expected(rows)
    assert chatrepair.report(df.limit(0), chatrepair.damage(df.limit(0))).count() == 0


def test_one_long_conversation_is_split(spark, monkeypatch):
    monkeypatch.setattr(chatrepair, "INTERVAL", 16)
    dice = random.Random(1)
    rows = [(1, k, dice.choice(["user", "assistant", "system"]), dice.choice(["Yes.", "no", f"w{k}.", f"w{k}"])) for k in range(1500)]
    rows += [(1, 5, "user", "copy.")] * 700 + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    assert reported(spark, df) == expected(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c"), (2, 0, "system", "s.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chatrepair.parsed(df)
    assert {r["c"]: (r["cost"], r["audit"]) for r in found.collect()} == {"=1": (3, "KIKK"), "=2": (3, "D")}
    out = sorted(tuple(r) for r in chatrepair.repaired(df, found).collect())
    assert out == [("=1", 0, "user", "a.", "K"), ("=1", 1, "assistant", "", "I"), ("=1", 2, "user", "b.", "K"), ("=1", 3, "assistant", "c", "K")]


def test_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    df = queries.op11_conversation_repair(spark, small)
    res = con.execute(SQL["op11_conversation_repair"])
    names = [d[0] for d in res.description]
    got = check.canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == check.canonical(names, res.fetchall())


def test_query_against_the_plain_walk(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r["conv_id"]: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, small).collect()} == expected(rows)
