"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tallyloom.llm import resampling as rs
from tallyloom.llm.queries import QUERIES

from .conftest import PROSE, frame


def features(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return [zlib.crc32(w) % 10_000 for w in re.findall(rb"[0-9a-z\x80-\xff]+", lower)]


def expected(docs, target):
    docs = [(k, features(t)) for k, t in docs]
    s, t = Counter(x for _, d in docs for x in d), Counter(x for d in target for x in features(d))
    a, b = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[i] + 1) * a / ((s[i] + 1) * b))) for i in range(10_000)]
    out = []
    for key, own in docs:
        weight = sum(gain[x] for x in own)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    long_enough = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, row in enumerate(long_enough[: len(long_enough) * 10 // 100]):
        row[4] = i + 1
    return Counter(map(tuple, out))


def check(df, docs, target):
    assert Counter(map(tuple, df.collect())) == expected(docs, target)


def test_whole_table(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    check(QUERIES["op12_importance_resampling"](spark, folder), docs, target)


def test_awkward_rows(spark, awkward, empty):
    """Twenty times the rows, so that some of equal rows are drawn and others are not."""
    many = awkward
    for _ in range(4):
        many = many.union(many)
    target = spark.createDataFrame([(1, "a quiet village"), (2, None), (None, "")], "item_id long, text string")
    check(rs.resample(awkward, target), [(r.doc_id, r[1]) for r in awkward.collect()], ["a quiet village"])
    check(rs.resample(many, target), [(r.doc_id, r[1]) for r in many.collect()], ["a quiet village"])
    assert rs.resample(empty, target).count() == 0
    texts = [(i, f"{PROSE} {i}") for i in range(40)]
    check(rs.resample(frame(spark, [t for _, t in texts]), target.limit(0)), texts, [])


def test_words_of_any_length_are_hashed():
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcxyz019éß日") for _ in range(n)) for n in [1, 2, 3, 31, 32, 33, 500, 20_000, 7] * 3]
    owner, bucket = rs.text_buckets([" ".join(words), "", "A-Z, ÀÉ", "..."])
    assert bucket[owner == 0].tolist() == [zlib.crc32(w.encode()) % 10_000 for w in words]
    assert bucket[owner == 2].tolist() == [zlib.crc32(w.encode()) % 10_000 for w in ("a", "z", "ÀÉ")]


def test_bit_sliced_weights_are_exact():
    rnd = np.random.default_rng(3)
    gains = rnd.integers(-30_000, 30_000, 10_000)
    texts = [" ".join(map(str, rnd.zipf(1.3, size=n) % 5_000)) for n in (0, 1, 20, 3_000, 100_000)]
    n, weight = rs.weights_of(texts, (rs.bit_planes(np.maximum(gains, 0)), rs.bit_planes(np.maximum(-gains, 0))))
    assert n.tolist() == [0, 1, 20, 3_000, 100_000]
    assert weight.tolist() == [int(sum(gains[x] for x in features(t))) for t in texts]
    zero = rs.bit_planes(np.zeros(10_000, np.int64))
    assert rs.weights_of(texts, (zero, zero))[1].tolist() == [0] * 5


def test_target_words_gain_most(spark):
    """Documents that speak like the target are drawn first."""
    rnd = random.Random(1)
    plain = [" ".join(rnd.choice(PROSE.split()) for _ in range(60)) for _ in range(180)]
    like = ["integral matrix theorem proof lemma " * 12] * 20
    got = rs.resample(frame(spark, plain + like), spark.createDataFrame([(1, "theorem lemma proof of the matrix integral " * 30)], "item_id long, text string"))
    assert {r.doc_id for r in got.filter("rank IS NOT NULL").collect()} == set(range(180, 200))
