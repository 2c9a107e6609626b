"""Personal data against plain patterns, and the bootstrapping on planted contexts."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import personal_data as pd
from tallyloom.llm.queries import QUERIES

from .conftest import PROSE, frame

# The base patterns, as they are defined.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

LONG = ["1", "1 ", "a", "a@", "+1 ", "1.", "a.b@c.d_", "+1-2-3-4-5-6-7-8-9 ", "1:", "(at)", "+", "-", " "]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [(kind, m.start(), m.end()) for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(kind, m[0])]


def check(df, texts, added=False):
    rows = df.collect()
    want = Counter()
    for key, text in texts:
        spans = base(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[key, *(sum(s[0] == k for s in spans) for k in PLAIN), hashlib.sha256(listed.encode()).hexdigest(), listed] += 1
    if not added:
        assert Counter(map(tuple, rows)) == want
    assert Counter(tuple(r)[:6] for r in rows) == Counter({k[:6]: 0 for k in want}) + Counter(k[:6] for k in want.elements())
    return rows


def test_whole_table(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check(QUERIES["op13_personal_data"](spark, folder), texts, added=True)


def test_awkward_rows(spark, awkward, empty):
    check(pd.personal_data(awkward), [(r.doc_id, r[1]) for r in awkward.collect()])
    assert pd.personal_data(empty).count() == 0


def test_base_patterns_on_random_strings(spark):
    """Short strings over the characters that the patterns tell apart, and long ones."""
    rnd = random.Random(2)
    pieces = ["a", "b@c.de", "@", ".", "1", "25", "255", "256", "001", "+", "+1 ", "-", " ", "(", ")", "_", "é", "\U0001f600", "x.y@z-1.co", "4111 1111 1111 1111", "10.0.0.1", "4111-1111-1111-1112", "%", "\n", "٣"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.choice([3, 8, 20]))) for _ in range(1500)]
    texts += [piece * 700 for piece in LONG]
    check(pd.personal_data(frame(spark, texts)), list(enumerate(texts)), added=True)


def test_long_texts_take_linear_time(spark):
    """Plain patterns would take hours for some of these."""
    df = frame(spark, [piece * 40_000 for piece in LONG]).selectExpr("cast(doc_id AS string) AS h", "text AS t")
    counts = {LONG[int(r.h)]: r.n for r in pd.mentions(df).filter("valid").groupBy("h").agg(F.count("*").alias("n")).collect()}
    assert counts == {"1.": 10_000, "a.b@c.d_": 40_000, "+1-2-3-4-5-6-7-8-9 ": 40_000}


def test_unseen_identifiers_in_learned_contexts(spark):
    rnd = random.Random(5)
    words = "mill river village wheel autumn bridge meadow harvest lantern orchard".split()

    def filler():
        return " ".join(rnd.choice(words) + rnd.choice("abcdefgh") for _ in range(6))

    seen = [f"{filler()} please call me at +1 555 01{i:02d} 77{i:02d} after lunch {filler()}" for i in range(12)]
    seen += [f"{filler()} write to user{i}@mail.example for details {filler()}" for i in range(12)]
    unseen = f"{filler()} please call me at 555 0199 7712 after lunch {filler()}"
    masked = f"{filler()} write to jo.doe (at) mail.example for details {filler()}"
    again = f"{filler()} number 555-0199-7712 {filler()}"
    plain = [f"{filler()} {1_000_000 + i * 7919} {filler()}" for i in range(40)]
    clean = [f"{filler()} order 555 0199 77{i} {filler()}" for i in range(10, 12)]
    texts = [*seen, unseen, masked, again, *plain, *clean]
    rows = {r.doc_id: r for r in check(pd.personal_data(frame(spark, texts)), list(enumerate(texts)), added=True)}

    def found(text):
        return [text[int(a) : int(b)] for _, a, b in (s.split(":") for s in rows[texts.index(text)].spans.split(",") if s)]

    assert found(unseen) == ["555 0199 7712"] and rows[texts.index(unseen)].spans.startswith("phone:")
    assert found(masked) == ["jo.doe (at) mail.example"]
    assert found(again) == ["555-0199-7712"], "the same number elsewhere"
    assert not any(found(t) for t in [*plain, *clean])
    assert all(len(found(t)) == 1 for t in seen), "added spans touch no base span"


def test_plan_has_no_python(spark, folder):
    plan = QUERIES["op13_personal_data"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("text", [PROSE * 5, "", None])
def test_texts_without_identifiers(spark, text):
    check(pd.personal_data(frame(spark, [text] * 3)), [(i, text) for i in range(3)])
