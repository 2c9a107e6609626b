"""License scan and quality rules against plain Python, and their plans."""

import re
from collections import Counter

import pytest

from tallyloom.llm import license_scan as ls
from tallyloom.llm import quality_rules as qr
from tallyloom.llm.queries import QUERIES

from .conftest import PROSE, frame


def base(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in ls.PHRASES:
        own = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def check_scan(df, texts):
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect())
    assert got == Counter((k, *base(t)) for k, t in texts)


def check_rules(df, texts):
    rows = df.collect()
    assert Counter(tuple(r)[:6] for r in rows) == Counter((k, *statistics(t)) for k, t in texts)
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_whole_table(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check_scan(QUERIES["op9_license_scans"](spark, folder), texts)
    check_rules(QUERIES["op10_quality_rules"](spark, folder), texts)


def test_awkward_rows(spark, awkward, empty):
    texts = [(r.doc_id, r[1]) for r in awkward.collect()]
    check_scan(ls.license_scan(awkward), texts)
    check_rules(qr.quality_rules(awkward), texts)
    assert ls.license_scan(empty).count() == qr.quality_rules(empty).count() == 0


def test_phrase_places(spark):
    texts = ["cc by cc by cc by", "CC-BY 4.0", "ccby cc  by", "all rights reserved. All Rights Reserved", "the general public license", "x cc\nby", "cc bye", "", "cc", "ü cc by é cc", "all all rights reserved"]
    check_scan(ls.license_scan(frame(spark, texts * 2)), list(enumerate(texts * 2)))


def test_labels_of_the_method(spark):
    apache = "Licensed under the Apache License, Version 2.0"
    mit = "Permission is hereby granted, free of charge, to any person getting a copy of this software"
    texts = [PROSE + apache, PROSE + mit + ", all rights reserved", PROSE * 4, "licensed under the", "This work is licensed under the new GNU General Public License, version 3."]
    got = [(r.base_labels, r.labels, r.score) for r in ls.license_scan(frame(spark, texts)).orderBy("doc_id").collect()]
    assert [g[:2] for g in got] == [("", "apache"), ("reserved", "mit,reserved"), ("", ""), ("", ""), ("gpl", "gpl")]
    assert got[0][2] == 1.0 and got[2][2] == 0.0 and 0 < got[3][2] < ls.SHARE


def test_rules_find_junk_and_keep_prose(spark, folder):
    """Against labels that the operator never sees."""
    large = folder.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{large}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_quality_rules"](spark, large).collect() if r.doc_id in labels and not r.base_failed]
    right = [r.kept == (labels[r.doc_id] == 1) for r in rows]
    assert sum(right) >= 0.98 * len(right)


def test_accuracies_come_back():
    """Votes drawn from known accuracies give them back."""
    import random

    draw = random.Random(5)
    right = [(0.9, 0.8), (0.95, 0.7), (0.85, 0.9), (0.8, 0.85), (0.9, 0.9)]
    counts = Counter()
    for _ in range(40_000):
        good = draw.random() < 0.75
        votes = tuple(0 if draw.random() < 0.2 else (1 if (draw.random() < (g if good else 1 - b)) else -1) for g, b in right)
        counts[votes] += 1
    prior, found = qr.fit(sorted(counts.items()))
    assert abs(prior - 0.75) < 0.02
    assert all(abs(a - b) < 0.04 for own, known in zip(found, right, strict=True) for a, b in zip(own, known, strict=True))


@pytest.mark.parametrize("name", ["op9_license_scans", "op10_quality_rules"])
def test_plans_stay_in_the_jvm(spark, folder, name, monkeypatch):
    plans = []
    monkeypatch.setattr(qr, "stored", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), df)[1])
    plans.append(QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        assert not re.search("Python|Pandas|InArrow|CartesianProduct|BroadcastNestedLoop", plan)
