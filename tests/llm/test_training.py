"""Classifier, decontamination, packing and the pipeline against labels, planted cases and brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallyloom.llm import decontamination as dc
from tallyloom.llm import packing as pk
from tallyloom.llm import quality_classifier as qc
from tallyloom.llm.queries import QUERIES, WORD_BPE

from .conftest import PROSE, frame
from .test_duplicates import classes, digests

LIBRARY = Tokenizer.from_file(WORD_BPE)


def auc(scores, good):
    rank = np.argsort(np.argsort(scores))
    n = good.sum()
    return (rank[good].sum() - n * (n - 1) / 2) / (n * (len(good) - n))


def test_held_out_quality(spark, folder):
    large = folder.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{large}/labels.parquet").collect()}
    df = QUERIES["op1_quality_classifier"](spark, large)
    assert df.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = df.collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    good = np.array([labels[r.doc_id] == 1 for r in held])
    assert auc(np.array([r.score for r in held]), good) > 0.97
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_held_out_labels_and_negatives_are_not_read(spark, folder):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    fewer = labels.filter((F.col("quality") == 1) & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    scores = [{r.doc_id: r.score for r in qc.quality_scores(docs, own).collect()} for own in (labels, turned, fewer)]
    for own in scores[1:]:
        assert max(abs(scores[0][k] - own[k]) for k in own) < 1e-6


def test_prior_and_non_negative_risk():
    draw = np.random.RandomState(1)
    positives, unlabelled = draw.normal(1, 1, 4000), np.r_[draw.normal(1, 1, 7000), draw.normal(-3, 1, 3000)]
    inputs = lambda v: np.c_[np.ones(len(v)), np.clip(v[:, None] - np.arange(-4, 4), 0, 1)]
    moments = [qc._moments(inputs(v)).reshape(9, 9) for v in (positives, unlabelled)]
    model = qc.PositiveUnlabelled(*moments)
    tally = qc._histogram(model.ratio())
    assert abs(qc.estimate_prior(tally(inputs(positives)), tally(inputs(unlabelled))) - 0.7) < 0.05
    w = model.fit(0.7)
    guess = inputs(unlabelled) @ w >= 0
    assert np.mean(guess == (np.arange(10_000) < 7000)) > 0.95
    plain = model.solve @ (2 * 0.7 * model.a_p[0] - model.a_u[0])
    risk = lambda own: sum(max(0, r) if i else r for i, r in enumerate(model.parts(own, 0.7)))
    assert risk(w) <= risk(plain) + 1e-12


def test_expansion_is_linear_between_knots():
    raw = np.zeros((3, qc.RAW), np.float32)
    raw[:, 0] = (0.0, 0.25, 99)
    wide = qc.expand(raw)
    assert wide.shape == (3, qc.WIDTH)
    knots = np.array(qc.KNOTS["log_words"])
    assert np.allclose(wide[:, 1 : 1 + len(knots)] @ knots, (0, 0.25, 10))


def edited(draw, words, share):
    out = []
    for w in words:
        luck = draw.random()
        out += [] if luck < share / 3 else [f"zz{draw.random()}"] if luck < 2 * share / 3 else [w, "extra"] if luck < share else [w]
    return out


def test_planted_leaks(spark, folder, monkeypatch):
    draw = random.Random(2)
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    items = [(r.item_id, dc.words_of(r.text)) for r in benchmark.collect()]
    noise = lambda n: " ".join(f"w{draw.randrange(4000)}" for _ in range(n))
    texts, wanted = [], []
    for share in (0, 0.1, 0.2):
        for key, words in items:
            wanted.append((len(texts), key))
            texts.append(f"{noise(60)} {' '.join(edited(draw, words, share))}. {noise(50)}")
    clean = [noise(100) for _ in range(50)] + [" ".join(items[0][1][:3]) + noise(80), "", None, "of the"]
    df = frame(spark, texts + clean)
    got = {(r.doc_id, r.item_id): r for r in dc.find_leaks(df, benchmark).collect()}
    assert set(wanted[:80]) <= set(got) and len(set(wanted) - set(got)) <= 1
    assert {k for k, _ in got} <= set(range(len(texts)))
    for (doc, item), r in got.items():
        if doc < 40:
            assert r.score == 1.0 and dc.words_of(texts[doc])[r.first_word : r.last_word + 1] == dict(items)[item]
    monkeypatch.setattr(dc, "BLOCK_WORDS", 100)
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(df, benchmark).collect()} == set(got)
    assert {r.doc_id for r in dc.drop_leaks(df, benchmark).collect()} == set(range(len(texts) + len(clean))) - {k for k, _ in got}


def align_cells(item, text):
    best, grid = 0.0, np.zeros((len(item) + 1, len(text) + 1))
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            same = dc.MATCH if item[i - 1] == text[j - 1] else dc.MISMATCH
            grid[i, j] = max(0, grid[i - 1, j - 1] + same, grid[i - 1, j] + dc.GAP, grid[i, j - 1] + dc.GAP)
            best = max(best, grid[i, j])
    return best


def test_alignment_cell_by_cell():
    draw = np.random.RandomState(4)
    for _ in range(200):
        item, text = draw.randint(0, 4, draw.randint(1, 12)), draw.randint(0, 4, draw.randint(0, 25))
        assert dc.align(item, text)[0] == align_cells(item, text)


def test_copies_without_three_words_in_a_row(spark, folder):
    """Every 3rd, 4th or 5th word changed, left out or put in, with and without a whole copy elsewhere."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    items = [(r.item_id, dc.words_of(r.text)) for r in benchmark.collect()]
    texts, wanted = [], set()
    for every in (3, 4, 5):
        for key, words in items:
            changed = [f"q{i}" if i % every == every - 1 else w for i, w in enumerate(words)]
            wider = [x for i, w in enumerate(words) for x in ([w, f"q{i}"] if i % every else [w])]
            for own in (changed, wider):
                if align_cells(np.array(words), np.array(own)) >= dc.LEAST * len(words):
                    wanted.add((len(texts), key))
                texts.append(f"{PROSE} {' '.join(own)} {PROSE}")
    assert len(wanted) > 4 * len(items)
    for more in ([], [" ".join(words) for _, words in items]):
        got = {(r.doc_id, r.item_id) for r in dc.find_leaks(frame(spark, texts + more), benchmark).collect()}
        assert wanted <= got


def test_no_alignment_is_missed():
    """All pairs of random items and texts of few words, against the alignment of every text as a whole."""
    draw = np.random.RandomState(7)
    found = 0
    for vocabulary in (3, 8, 30):
        rows = [(i, [str(w) for w in draw.randint(0, vocabulary, n)]) for i, n in enumerate([1, 3, 3, 4, 5, 6, 7, 9, 12, 14, 20])]
        items = dc.Items(rows)
        for _ in range(60):
            words = [str(w) for w in draw.randint(0, vocabulary + 2, draw.randint(0, 40))]
            own = rows[draw.randint(len(rows))][1]
            own = [x for w in own for x in ([], [w], [w], [w], ["x"], [w, "x"], [w, "x"], ["x", w])[draw.randint(8)]]
            ids = items.read(" ".join(words + own + words[::-1]))
            wanted = {i for i, item in enumerate(items.ids) if align_cells(item, ids) >= dc.LEAST * len(item)}
            assert {hit[0] for hit in dc.passages(items, ids)} == wanted
            found += len(wanted)
    assert found > 500


def test_passages_of_long_items():
    draw = np.random.RandomState(9)
    item = [f"w{x}" for x in draw.randint(0, 3000, 400)]
    items = dc.Items([(7, item), (8, ["other"] * 3)])
    noise = [f"n{i}" for i in range(200)]
    for first in (0, 17, 100, 201, 250):
        (hit,) = dc.passages(items, items.read(" ".join(noise + item[first : first + 150] + noise)))
        assert hit[:4] == (0, 150 / 400, 200, 349)
    for first in range(371):
        (hit,) = dc.passages(items, items.read(" ".join(noise + item[first : first + 30] + noise)))
        assert hit[2:4] == (200, 229)
        assert not [*dc.passages(items, items.read(" ".join(noise + item[first : first + 14] + noise)))]
    (hit,) = dc.passages(items, items.read(" ".join(noise + item + noise)))
    assert hit[:4] == (0, 1.0, 200, 599)


def test_no_alignment_of_a_long_item_is_missed(monkeypatch):
    """As above for items of several parts, against whole alignments and those of every stretch."""
    monkeypatch.setattr(dc, "RUN", 8)
    draw = np.random.RandomState(11)
    found = [0, 0]
    for _ in range(250):
        vocabulary = (6, 30)[draw.randint(2)]
        words = [str(w) for w in draw.randint(0, vocabulary, draw.randint(9, 30))]
        items = dc.Items([(1, words)])
        own = words[draw.randint(len(words)) :] if draw.randint(2) else words
        own = [x for w in own for x in ([], [w], [w], [w], ["x"], [w, "x"], [w, "x"], ["x", w])[draw.randint(8)]]
        ids = items.read(" ".join(own + words[::-1]))
        whole = align_cells(items.ids[0], ids) >= dc.LEAST * len(words)
        wanted = whole or any(align_cells(items.ids[0][a : a + n], ids) >= dc.LEAST * n for a, n in dc.stretches(len(words)) if n == dc.RUN)
        assert bool([*dc.passages(items, ids)]) == wanted
        found[int(wanted)] += 1
    assert min(found) > 15


def test_one_block_of_the_benchmark_at_a_time(spark, folder, monkeypatch, awkward):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    whole = sorted(map(tuple, dc.find_leaks(docs, benchmark).collect()))
    kept = sorted(r.doc_id for r in dc.drop_leaks(docs, benchmark).collect())
    monkeypatch.setattr(dc, "BLOCK_WORDS", 250)
    assert sum(1 for _ in dc._blocks(benchmark, "item_id", "text")) > 2
    found, left = dc.find_leaks(docs, benchmark), dc.drop_leaks(docs, benchmark)
    for df in (found, left):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, found.collect())) == whole and sorted(r.doc_id for r in left.collect()) == kept
    assert dc.drop_leaks(awkward, benchmark).columns == awkward.columns and dc.drop_leaks(awkward, benchmark).count() == awkward.count()


def test_leaks_of_the_whole_table(spark, folder):
    """Every document that holds an item word for word, and no other."""
    items = {r.item_id: f" {' '.join(dc.words_of(r.text))} " for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    texts = {r.doc_id: f" {' '.join(dc.words_of(r.text))} " for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op3_benchmark_decontamination"](spark, folder).collect()
    exact = {(d, i) for d, t in texts.items() for i, p in items.items() if p in t}
    assert exact and exact == {(r.doc_id, r.item_id) for r in rows if r.score == 1}


def check_pieces(rows, texts, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    wanted = defaultdict(list)
    for key, text in texts:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        wanted[key] += [(i // capacity, i, len(ids[i : i + capacity]), zlib.crc32(ids[i : i + capacity].tobytes())) for i in range(0, len(ids), capacity)]
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in wanted.items()}
    return len(by_sequence), -(-sum(n for own in wanted.values() for _, _, n, _ in own) // capacity)


def test_packing_the_whole_table(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    sequences, least = check_pieces(QUERIES["op5_best_fit_packing"](spark, folder).collect(), texts, 2048)
    assert sequences <= least + 1


def test_packing_in_many_rounds(spark, folder, monkeypatch):
    monkeypatch.setattr(pk, "ITEMS", 40)
    monkeypatch.setattr(pk, "HELD", 100)
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    sequences, least = check_pieces(pk.pack_documents(df, WORD_BPE, 300).collect(), texts, 300)
    assert sequences <= 1.03 * least


@pytest.mark.parametrize("room", [1, 5, 8])
def test_short_pieces_fill_nearly_full_bins(spark, room):
    rows = spark.sparkContext.parallelize([(i, 0, 0, 30 if i < 20 else room, 0) for i in range(22)], 22)
    packed = pk.pack(spark.createDataFrame(rows, "doc_id long, piece long, start long, length long, ids_crc32 long"), 30 + room).collect()
    assert len(packed) == 22 and len({r.sequence_id for r in packed}) == 20


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, made = pk.best_fit(np.array([6, 7, 3, 4, 10, 1]), 10)
    assert made == 4 and bins[0] == bins[3] and bins[1] == bins[2] and offsets[3] == 6
    draw = random.Random(1)
    for _ in range(50):
        sizes = np.array([draw.randint(1, 50) for _ in range(draw.randint(1, 80))])
        bins, offsets, made = pk.best_fit(sizes, 50)
        room = [50] * made
        for i in np.argsort(-sizes, kind="stable"):
            fits = [room[b] for b in set(bins[: len(sizes)].tolist()) if room[b] >= sizes[i] and room[b] < 50]
            assert room[bins[i]] == (min(fits) if fits else 50) and offsets[i] == 50 - room[bins[i]]
            room[bins[i]] -= sizes[i]


def test_awkward_rows(spark, awkward, empty, folder):
    benchmark, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("benchmark", "labels"))
    rows = [(r.doc_id, r[1]) for r in awkward.collect()]
    check_pieces(pk.pack_documents(awkward, WORD_BPE).collect(), rows, 2048)
    odd = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (5, None, 1), (5, 1, 1), (5, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    for own in (labels, odd, odd.limit(0)):
        scored = qc.quality_scores(awkward, own).collect()
        assert len(scored) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in scored)
    assert dc.find_leaks(awkward, benchmark).count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "zebra"), (4, "goes on"), (5, PROSE), (5, PROSE)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(awkward, odd).collect()} == {(4, 4), (5, 5), (6, 5)}
    assert dc.find_leaks(awkward, odd.limit(0)).count() == 0
    assert qc.quality_scores(empty, labels).count() == dc.find_leaks(empty, benchmark).count() == pk.pack_documents(empty, WORD_BPE).count() == 0


@pytest.mark.parametrize("which", ["awkward", "empty"])
def test_stages_take_awkward_tables(spark, folder, which, request):
    docs = request.getfixturevalue(which)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 0


def test_stages_one_by_one(spark, folder):
    """What each stage keeps of its own input, against brute force or the operator's own rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    labels, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    stage = dict(corpus_pipeline.STAGES)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    ids = lambda df: {r.doc_id for r in df.collect()}
    assert ids(stage["quality"](spark, docs, folder)) == {r.doc_id for r in qc.quality_scores(docs, labels).collect() if r.predicted == 1}
    assert ids(stage["near_duplicates"](spark, docs, folder)) == {c for _, c, _ in classes(texts)}
    assert ids(stage["decontamination"](spark, docs, folder)) == {k for k, _ in texts} - {r.doc_id for r in dc.find_leaks(docs, benchmark).collect()}
    left = {r.doc_id: r for r in stage["repeats"](spark, docs, folder).collect()}
    for key, size, removed, _, _ in digests(texts):
        if key in left:
            assert size - removed <= len(left[key].text.encode()) <= size - removed + 6 * removed
            assert left[key].n_chars == len(left[key].text)
        else:
            assert removed == size > 0


def test_pipeline_runs_all_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.offset for r in rows} and len({r.doc_id for r in rows}) > 100
