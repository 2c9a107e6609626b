"""Conversation repair against a search over all edits."""

import functools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tallyloom.llm import conversations as cv
from tallyloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        own = out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        if kind:
            own += [(turn, role, text)] * (2 if kind == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    return out


def search(rows, faults):
    """The cheapest edits, of equal ones the least letters, over every way to edit; and the repaired rows."""

    def fits(initials):
        return re.fullmatch("(s?(ua)*u?)?", initials) is not None

    @functools.lru_cache(None)
    def best(i, last, started, inserted):
        options = []
        if i == len(rows) and (not started or last == "a"):
            options.append((0, "", ()))

        def go(letter, cost, j, row, new=False):
            if row is None:
                if (found := best(j, last, started, 0)) is not None:
                    options.append((cost + found[0], letter + found[1], found[2]))
                return
            initial = row[0][:1]
            before = {"": "", "s": "s", "u": "u", "a": "ua"}[last]
            if initial in ("s", "u", "a") and fits(before + initial) and not (initial == "s" and started):
                if (found := best(j, initial, True, inserted + 1 if new else 0)) is not None:
                    options.append((cost + found[0], letter + found[1], (row, *found[2])))

        if inserted < 4:
            for role in ("user", "assistant"):
                go("I", 2, i, (role, ""), True)
        if i < len(rows):
            go("D", 3, i + 1, None)
            if faults[i] not in ("blank", "duplicate"):
                cut = faults[i] == "truncated"
                go("K", cut, i + 1, rows[i][1:])
                for role in ("user", "assistant"):
                    go("R", 2 + cut, i + 1, (role, rows[i][2]))
        return min(options, key=lambda o: o[:2], default=None)

    return best(0, "", False, 0)


def expected(table):
    out = Counter()
    for conv, rows in damaged(table).items():
        seen, faults = set(), []
        for _, role, text in rows:
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, left = search(rows, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out[conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest] += 1
    return out


def check(df, rows):
    got = Counter(map(tuple, df.collect()))
    want = expected(rows)
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def test_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    check(QUERIES["op11_conversation_repair"](spark, folder), rows)


def strange(seed, convs=60):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User", ",", "|", "usher"]
    texts = ["Hello.", "Why?", "no end", "", " \t", None, "Done!\n ", "x.\u0085", "é", "Yes. No"]
    rows = []
    for conv in [None, *range(convs)]:
        for i in range(rnd.choice([1, 2, 3, 5, 9])):
            turn = rnd.choice([i, i, i, i + 3, None, 0])
            rows += [(conv, turn, rnd.choice(roles), rnd.choice(texts))] * rnd.choice([1, 1, 1, 2, 3])
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 30])
def test_strange_rows_and_pieces(spark, partitions):
    """Many range partitions cut most conversations into pieces."""
    rows = strange(partitions)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("conv", "n", "piece", "h", "place", "first"):
        df = df.withColumn(name, df["turn"])
    df = df.toDF(*df.columns[:-1], "TEXT")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        check(cv.repair(df), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_one_long_conversation(spark):
    """A conversation with runs of equal symbols and one row that repeats very often."""
    rows = [(7, i, "user" if i % 3 else "assistant", f"Row {i}." if i % 5 else f"row {i}") for i in range(100)]
    rows += [(7, 200, "user", "Again.")] * 100
    check(cv.repair(spark.createDataFrame(rows, SCHEMA)), rows)


def test_empty_table_and_dropped_conversations(spark):
    assert cv.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = cv.repair(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_powers_are_repeated_products():
    for symbol in range(len(cv.SYMBOLS)):
        out = (0, cv._ONE)
        for n in range(1, 40):
            out = cv.times(out, cv.binary_power(symbol, 0))
            assert cv.run_matrix(symbol, n) == out
