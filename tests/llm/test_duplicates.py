"""Jaccard classes and repeated spans against brute force, at small and at production limits."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloom.llm import jaccard_join as jj
from tallyloom.llm import links
from tallyloom.llm import phrases
from tallyloom.llm import span_dedup as sd
from tallyloom.llm.phrases import SPAN, parse
from tallyloom.llm.queries import QUERIES

from .conftest import frame

DIGEST = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def classes(texts):
    """(class, links) of each (key, text), every pair compared that shares a shingle."""
    sets = [jj.shingles(t).tolist() for _, t in texts]
    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for x in own:
            holders[x].append(i)
    up, count = list(range(len(texts))), Counter()

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, own in enumerate(sets):
        for j, common in Counter(j for x in own for j in holders[x] if j > i).items():
            if common / (len(own) + len(sets[j]) - common) >= 0.8 - 1e-12:
                count[i] += 1
                count[j] += 1
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(texts):
        least[find(i)] = min(least.get(find(i), key), key)
    return [(key, least[find(i)], count[i]) for i, (key, _) in enumerate(texts)]


def digests(texts):
    """The digest rows of (key, text) with distinct keys, every span looked at."""
    seen, out = set(), []
    for key, text in sorted(texts):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - SPAN + 1):
            if data[i : i + SPAN] in seen:
                gone[i : i + SPAN] = b"\x01" * SPAN
            seen.add(data[i : i + SPAN])
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def mutated(draw, text, times):
    words = text.split()
    for _ in range(times):
        words[draw.randrange(len(words))] = f"new{draw.random()}"
    return " ".join(words)


def corpus(seed, families=12, copies=25):
    """Families of copies with none to many edits, a large family of near copies, and strangers that share a line."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefghij", k=draw.randint(2, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    line, out = text(25), []
    for _ in range(families):
        root = text(draw.randint(8, 160))
        out += [mutated(draw, root, draw.choice((0, 0, 1, 2, 3, 5, 9))) for _ in range(copies)]
    root = text(180)
    out += [mutated(draw, root, draw.randint(1, 4)) for _ in range(150)]
    out += [f"{text(30)}\n{line}\n{text(30)}" for _ in range(100)]
    out += ["hi", "hi", "Hi!", "one two three four", "one two three four five", "", " "] + ["na " * 90, "ab" * 300]
    draw.shuffle(out)
    return out


def rows_of(df, names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("limit", [jj.LIMIT, 6])
def test_classes(spark, monkeypatch, limit):
    monkeypatch.setattr(jj, "LIMIT", limit)
    texts = list(enumerate(corpus(limit)))
    assert rows_of(jj.jaccard_classes(frame(spark, [t for _, t in texts])), ["doc_id", "class_id", "n_links"]) == sorted(classes(texts))


def test_classes_of_the_whole_table(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows_of(QUERIES["op7_jaccard_join"](spark, folder), ["doc_id", "class_id", "n_links"]) == sorted(classes(texts))


def test_block_keys_bring_all_pairs_together_once(spark):
    rows = spark.range(1000).selectExpr("id", "1L AS g", "1000 AS n")
    dealt = links.in_blocks(rows, "g", "n", block=100).collect()
    by_key = defaultdict(list)
    for r in dealt:
        by_key[r.task_key].append(r)
    met = Counter()
    for own in by_key.values():
        ids = [[r.id for r in own if r.side == s] for s in (0, 1)]
        pairs = [(a, b) for i, a in enumerate(ids[0]) for b in ids[0][:i]] if own[0].alone else [(a, b) for a in ids[0] for b in ids[1]]
        met.update((max(p), min(p)) for p in pairs)
    assert len(met) == 1000 * 999 // 2 and set(met.values()) == {1}
    assert max(map(len, by_key.values())) < 400


def test_components(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 300)] + [(draw.randrange(400, 500), draw.randrange(400, 500)) for _ in range(60)] + [(7, 7)]
    forest = links.Forest(500)
    for u, v in edges:
        forest.join(u, [v])
    wanted = {i: r for i, r in enumerate(forest.roots()) if any(i in e and e[0] != e[1] for e in edges)}
    got = links.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.id: r.root for r in got} == wanted and len(got) == len(wanted)
    assert links.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.fixture(params=[1, 40])
def partitions(spark, request):
    """Adaptive execution is off, so that range partitions stay as many as are asked for."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_one_trigger_with_most_phrases(spark, partitions):
    """A passage in hundreds of texts, each time between other words: equal suffixes reach over range partitions."""
    draw = random.Random(partitions)

    def noise(n):
        return "".join(draw.choice("abcdefghij klmnop") for _ in range(n))

    passages = [noise(112), noise(101), noise(130)]
    texts = [noise(draw.randrange(5, 60)) + passages[i % 7 % 3] + noise(draw.randrange(5, 60)) for i in range(400)]
    texts += [noise(40) + passages[0][:70] + noise(60) + passages[0][40:] for _ in range(40)]
    texts = list(enumerate(texts))
    assert rows_of(sd.span_digest(frame(spark, [t for _, t in texts])), DIGEST) == digests(texts)


def test_triggers_do_not_depend_on_neighbours(monkeypatch):
    texts = [t.encode() for t in corpus(5)]
    whole = phrases.parse(texts)
    monkeypatch.setattr(phrases, "_PIECE", 130)
    pieces = phrases.parse(texts)
    assert all((getattr(whole, c) == getattr(pieces, c)).all() for c in ("text", "start", "spans", "trigger", "content"))


@pytest.mark.parametrize("seed", [2_000, 2])
def test_spans(spark, seed):
    texts = list(enumerate(corpus(seed) + ["ü" * 120 + "z", "ü" * 120, "x" * 99, "x" * 100, "x" * 101, "\x00" * 250, "a\x00" * 200]))
    assert rows_of(sd.span_digest(frame(spark, [t for _, t in texts])), DIGEST) == digests(texts)


def test_spans_of_the_whole_table(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    df = QUERIES["op2_suffix_array_dedup"](spark, folder)
    assert df.columns == DIGEST
    assert rows_of(df, DIGEST) == digests(texts)


def test_parse_gives_every_span_one_phrase_and_equal_spans_one_trigger():
    texts = [t.encode() for t in corpus(9, families=3)]
    own = parse(texts)
    assert own.spans.max() <= SPAN
    triggers, count = defaultdict(set), 0
    for text, start, spans, trigger in zip(own.text, own.start, own.spans, own.trigger, strict=True):
        phrase = [texts[text][s : s + SPAN] for s in range(start, start + spans)]
        assert len(set(phrase)) == len(phrase)
        count += spans
        for s in phrase:
            assert len(s) == SPAN
            triggers[s].add(trigger)
    assert count == sum(max(0, len(t) - SPAN + 1) for t in texts)
    assert all(len(t) == 1 for t in triggers.values())


def test_kept_text_keeps_whole_characters():
    data = "aüb日".encode()
    out = np.zeros(len(data), bool)
    out[[0, 1, 4, 5, 6]] = True
    assert sd.kept_text(data, out) == "üb"
    assert sd.kept_text(b"", np.zeros(0, bool)) == ""


def test_awkward_rows(spark, awkward, empty):
    rows = [(r.doc_id, r[1]) for r in awkward.collect()]
    got = sd.span_digest(awkward).collect()
    assert sorted((r.doc_id or 0, r.n_bytes) for r in got) == sorted((k or 0, len((t or "").encode())) for k, t in rows)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r.n_removed)
    assert by[5][0] == by[5][1] > 0
    assert by[6] == [len(rows[6][1].encode())]
    assert by[7] == [4999]
    linked = {(r.doc_id, r.class_id, r.n_links) for r in jj.jaccard_classes(awkward).collect()}
    assert {(5, 5, 2), (6, 5, 2), (1, 1, 0), (2, 2, 0), (None, None, 0)} <= linked
    assert jj.jaccard_classes(empty).count() == sd.span_digest(empty).count() == 0


def test_rows_that_share_a_key_but_not_their_text(spark):
    texts = corpus(4, families=4, copies=6)[:60]
    df = frame(spark, texts).selectExpr("doc_id % 40 AS doc_id", "text", "lang", "source", "n_chars")
    assert sd.span_digest(df).count() == jj.jaccard_classes(df).count() == 60
    assert jj.one_of_each_class(df).count() <= 60
