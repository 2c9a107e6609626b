"""Importance resampling towards a target distribution, with bit-sliced sums of bucket gains."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import by_batch, pick, slices, stored
from tallyloom.operators.plates import global_rank
from tallyloom.operators.selection import first_rows

BUCKETS = 10_000
SEED = 2024
#: Documents below this many words take no part in the draw, and the share drawn of the others.
MIN_WORDS, PERCENT = 20, 10
#: Words up to this many bytes are hashed side by side, longer ones one by one.
LONG_WORD = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _crc_table()


def word_hashes(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of each word of a byte array, byte by byte for all words at once."""
    out = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    live = np.flatnonzero(size <= LONG_WORD)
    for i in range(LONG_WORD):
        live = live[size[live] > i]
        if not len(live):
            break
        out[live] = _CRC[(out[live] ^ raw[begin[live] + i]) & 0xFF] ^ (out[live] >> 8)
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = zlib.crc32(raw[begin[i] : begin[i] + size[i]].tobytes())
    return out


def text_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The text and the bucket of every word of some texts, in order."""
    data = [t.encode() for t in texts]
    raw = _LOWER[np.frombuffer(b"\x00".join(data) + b"\x00", np.uint8)]
    edge = np.flatnonzero(np.diff(_IS_WORD[raw], prepend=False))
    begin, end = edge[::2], edge[1::2]
    ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1)
    return np.searchsorted(ends, begin, "right"), word_hashes(raw, begin, end - begin) % BUCKETS


def _counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    total = np.zeros(BUCKETS, np.int64)
    for _, texts in slices(batch.column(0)):
        total += np.bincount(text_buckets(texts)[1], minlength=BUCKETS)
    found = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["bucket", "n"])


def bucket_counts(docs: DataFrame, text: str) -> list[int]:
    """Features of all texts by bucket: a sum per task and bucket is shuffled, ``BUCKETS`` numbers come to the driver."""
    counts = pick(docs, text).mapInArrow(by_batch(_counts), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * BUCKETS
    for bucket, n in counts.collect():
        out[bucket] = n
    return out


def bucket_gains(source: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 * log-ratio) of the smoothed shares of target and source, bucket by bucket."""
    all_source, all_target = float(sum(source) + BUCKETS), float(sum(target) + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target))) for s, t in zip(source, target, strict=True)], np.int64)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """One bit array per binary digit of non-negative numbers (the last axis is packed into 64-bit words)."""
    n = int(values.max(initial=0)).bit_length()
    bits = np.stack([(values >> k) & 1 for k in range(n)]) if n else np.zeros((0, *values.shape), np.int64)
    packed = np.packbits(bits.astype(bool), axis=-1)
    packed = np.concatenate([packed, np.zeros((*packed.shape[:-1], -packed.shape[-1] % 8), np.uint8)], axis=-1)
    return packed.view(np.uint64)


def weights_of(texts: list[str], gains: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Features and weight of each text.

    A text's bucket counts become planes of ``BUCKETS`` bits, one per binary digit. Each is ANDed with
    the planes of the positive and of the negative gains; the set bits, times the power of two that
    both digits stand for, add up to the exact weight. Only texts with a count that has a digit have that plane.
    """
    owner, bucket = text_buckets(texts)
    features = np.bincount(owner, minlength=len(texts))
    cell, count = np.unique(owner * BUCKETS + bucket, return_counts=True)
    weight = np.zeros(len(texts), np.int64)
    for digit in range(int(count.max(initial=0)).bit_length()):
        held = cell[(count >> digit) & 1 == 1]
        rows, place = np.unique(held // BUCKETS, return_inverse=True)
        bits = np.zeros((len(rows), BUCKETS), bool)
        bits[place, held % BUCKETS] = True
        packed = np.packbits(bits, axis=1)
        plane = np.concatenate([packed, np.zeros((len(rows), -packed.shape[1] % 8), np.uint8)], axis=1).view(np.uint64)
        for sign, planes in zip((1, -1), gains, strict=True):
            for power, gain in enumerate(planes):
                set_bits = np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
                weight[rows] += sign * (set_bits << (digit + power))
    return features, weight


def _noise(key: Column) -> Column:
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Features, weight, score and rank of every document; a rank says that it is drawn.

    Two passes over the texts. The first counts features by bucket, for ``docs`` and ``target``, which
    gives a gain per bucket (:func:`bucket_gains`); the second sums the gains of each text
    (:func:`weights_of`). The score adds a Gumbel number made from the key. Of the documents with
    ``min_words`` words, ``percent`` in a hundred with the highest scores are drawn: the last one is
    found by counts of the scores, and only the drawn are sorted.

    Null and empty texts have no features and weight 0. Rows with one key have one random number; equal
    rows are drawn in any order. A null key counts as an empty one and comes last among ties. An empty
    ``docs`` gives no rows; with an empty ``target`` all gains come from smoothing alone.
    """
    gains = bucket_gains(bucket_counts(docs, text), bucket_counts(target, text))
    planes = bit_planes(np.maximum(gains, 0)), bit_planes(np.maximum(-gains, 0))
    rows = pick(docs, key, text)
    kind = dict(rows.dtypes)[key]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        features, weight = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for _, texts in slices(batch.column(1)):
            for out, own in zip((features, weight), weights_of(texts, planes), strict=True):
                out.append(own)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(features)), pa.array(np.concatenate(weight))], names=[key, "n_features", "weight"])

    scored = rows.mapInArrow(by_batch(make), f"{key} {kind}, n_features long, weight long")
    # equal rows are told apart by a number that the written table keeps
    scored = stored(scored.withColumn("score", F.col("weight") + _noise(F.col(key))).withColumn("row", F.monotonically_increasing_id()))
    long_enough = scored.filter(F.col("n_features") >= min_words)
    down = [-F.col("score"), F.col(key).isNull(), F.col(key), F.col("row")]
    drawn = first_rows(long_enough, percent * long_enough.count() // 100, down)
    ranks = global_rank(drawn.select("score", key, "row"), [F.desc("score"), F.asc_nulls_last(key), "row"], "rank").select("row", "rank")
    return scored.join(ranks, "row", "left").select(key, "n_features", "weight", "score", "rank")
