"""N-gram Jaccard self-join of documents by chosen paths."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import by_batch, pick, stored
from tallyloom.llm.links import Forest, by_key, components, groups, in_blocks, union

SHINGLE = 5
LEAST = 0.8
#: Independent runs; a pair is missed only if every run parts it.
RUNS = 6
#: Tokens that are sampled to split a node below the first level, and levels at most.
SPLITS, DEPTH = 3, 3
#: Sets up to which a node is compared by brute force rather than split.
LIMIT = 128
#: A node of which one token at the next place holds so large a share is a group of like sets.
ALIKE = 0.5
#: Hash functions of a set: all give a byte of its sketch, the first ``TOKENS`` also choose paths.
HASHES, TOKENS = 192, RUNS + RUNS * SPLITS
#: Least share of equal sketch bytes of a candidate; ``LEAST`` lies four deviations above.
CANDIDATE = 0.67

_WORD = re.compile(r"\w+")
_MIX = np.random.RandomState(7).randint(1, 2**63 - 1, (2, HASHES), np.int64).astype(np.uint64) | np.uint64(1)
_PLACE = np.random.RandomState(11).randint(1, 2**63 - 1, SHINGLE, np.int64).astype(np.uint64) | np.uint64(1)


@functools.lru_cache(maxsize=100_000)
def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes.

    Words are runs of letters, digits and underscores in lower case. A text of one to four words is
    one shingle by itself; a text without words has none.
    """
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_word_hash, words), np.uint64, len(words))
    n = min(SHINGLE, len(ids))
    total = np.full(len(ids) - n + 1, n, np.uint64)
    for j in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + ids[j : len(ids) - n + 1 + j] * _PLACE[j]
        total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(total ^ (total >> np.uint64(29)))


def min_hashes(own: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 4096):
        part = (own[at : at + 4096, None] ^ _MIX[0]) * _MIX[1]
        np.minimum(out, part.min(0), out=out)
    return out


def set_hash(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def _profiles(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, sets, tokens, sketches = [], [], [], []
    for key, text in zip(batch.column(0), batch.column(1), strict=True):
        own = shingles(text.as_py())
        ids.append(key.as_py())
        sets.append(set_hash(own) if len(own) else None)
        least = min_hashes(own)
        tokens.append(least[:TOKENS].view(np.int64) if len(own) else None)
        sketches.append((least >> np.uint64(20)).astype(np.uint8).tobytes() if len(own) else None)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), batch.column(2), pa.array(sets, pa.binary()), pa.array(tokens, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
        names=["id", "text_hash", "set", "tokens", "sketch"],
    )


def _similar_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A star on the smallest id for the sets of a node that hang together by their sketches."""
    for rows in groups(batches):
        if rows.num_rows < 2:
            continue
        ids, side, alone = (rows[c].to_numpy() for c in ("id", "side", "alone"))
        marks = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(-1, HASHES)
        forest, within = Forest(len(ids)), bool(alone[0])
        for i in range(len(ids) - 1):
            if within or side[i] == 0:
                near = (marks[i + 1 :] == marks[i]).mean(1) >= CANDIDATE if within else (marks == marks[i]).mean(1) * side >= CANDIDATE
                forest.join(i, (np.flatnonzero(near) + (i + 1 if within else 0)).tolist())
        roots = np.array(forest.roots())
        hung = np.flatnonzero(roots != np.arange(len(ids)))
        if len(hung):
            yield pa.RecordBatch.from_arrays([pa.array(ids[hung]), pa.array(ids[roots[hung]])], names=["u", "v"])


def _chosen_paths(sets: DataFrame) -> DataFrame:
    """(node, id, n) of all nodes that are compared by brute force."""
    roots = sets.select("id", F.posexplode(F.slice("tokens", 1, RUNS)).alias("run", "token"))
    nodes = roots.select("id", "run", F.xxhash64("run", "token").alias("node"))
    done = []
    for depth in range(1, DEPTH + 1):
        nodes = stored(nodes)
        sizes = nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        sized = stored(nodes.join(sizes, "node"))
        if depth == DEPTH:
            done.append(sized)
            break
        done.append(sized.filter(F.col("n") <= LIMIT))
        large = stored(sized.filter(F.col("n") > LIMIT).join(sets.select("id", "tokens"), "id"))
        place = lambda s: F.lit(RUNS) + F.pmod(F.col("run") * SPLITS + s + (depth - 1) * 7, F.lit(RUNS * SPLITS))  # noqa: B023, E731
        shares = large.groupBy("node", F.get("tokens", place(F.lit(0))).alias("token")).agg(F.count("*").alias("own"))
        alike = shares.groupBy("node").agg((F.max("own") / F.sum("own")).alias("share")).filter(F.col("share") >= ALIKE).select("node")
        # splitting like sets parts few of them: they are compared as they are, in blocks
        done.append(large.join(alike, "node", "left_semi").select(*sized.columns))
        large = large.join(alike, "node", "left_anti")
        large = large.select("id", "run", "node", "tokens", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1))).alias("s"))
        nodes = large.select("id", "run", F.xxhash64("node", place(F.col("s")), F.get("tokens", place(F.col("s")))).alias("node"))
    return union(done).select("node", "id", "n")


def _shingle_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts become their shingles; a row whose text isn't that of its set goes."""
    keep, found = [], []
    for i, (text, want) in enumerate(zip(batch.column("text"), batch.column("set"), strict=True)):
        own = shingles(text.as_py())
        if len(own) and set_hash(own) == want.as_py():
            keep.append(i)
            found.append(own.tobytes())
    rest = [batch.column(c).take(pa.array(keep, pa.int64())) for c in ("id", "copies", "root", "n")]
    return pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.binary())], names=["id", "copies", "root", "n", "shingles"])


def _exact_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each set to others of its task, and the smallest id it hangs on, by exact Jaccard similarity.

    The common shingles of one set with all others come from lists of the sets that have a shingle;
    shingles of one set alone are left out of them.
    """
    for rows in groups(batches):
        ids = rows["id"].to_numpy()
        if len(ids) < 2:
            continue
        first = np.r_[True, np.diff(ids) != 0]  # repeated rows of one document
        rows = rows.filter(pa.array(first))
        ids, copies, side, alone = (rows[c].to_numpy() for c in ("id", "copies", "side", "alone"))
        own = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
        sizes, n, within = np.array([len(x) for x in own]), len(ids), bool(alone[0])
        flat, owner = np.concatenate(own), np.repeat(np.arange(n), sizes)
        order = np.argsort(flat, kind="stable")
        fresh = np.r_[True, np.diff(flat[order]) != 0]
        number = np.cumsum(fresh) - 1
        begin = np.r_[np.flatnonzero(fresh), len(flat)]
        place = np.empty(len(flat), np.int64)
        place[order] = number
        holders, ends, forest = owner[order], np.cumsum(sizes), Forest(n)
        links = np.zeros(n, np.int64)
        for i in range(n):
            if not within and side[i]:
                continue
            mine = place[ends[i] - sizes[i] : ends[i]]
            mine = mine[begin[mine + 1] - begin[mine] > 1]
            if not len(mine):
                continue
            widths = begin[mine + 1] - begin[mine]
            shifts = np.cumsum(widths) - widths
            spots = np.arange(widths.sum()) - np.repeat(shifts, widths) + np.repeat(begin[mine], widths)
            common = np.bincount(holders[spots], minlength=n)
            linked = common >= LEAST * (sizes + sizes[i] - common) - 1e-9
            linked[: i + 1] &= not within
            if not within:
                linked &= side == 1
            others = np.flatnonzero(linked)
            links[i] += copies[others].sum()
            links[others] += copies[i]
            forest.join(i, others.tolist())
        found = np.flatnonzero(links)
        if len(found):
            roots = np.array(forest.roots())
            yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(links[found]), pa.array(ids[roots[found]])], names=["id", "links", "hangs_on"])


def jaccard_classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Class and number of links of every document, by Jaccard similarity of word shingles.

    Two documents are linked if the similarity of their sets of five-word shingles is ``LEAST`` or
    more; ``class_id`` is the smallest key of those that links connect, ``n_links`` counts all
    other documents linked with it, copies included.

    Documents with equal sets are one set from the start and are never paired. The others follow
    chosen paths: in each of ``RUNS`` runs a set goes to the node of its token under a random order, nodes over
    ``LIMIT`` are split again by further sampled tokens, and small nodes are compared by sketch, as are nodes of
    sets so alike that a split would part few of them. A pair at
    the threshold misses a run with a chance of about a fifth and all six with less than 0.0002.
    What hangs together by sketches is then compared exactly, every two sets of a group, in blocks
    where a group is large. Pairs are counted where they are found and never written.

    Texts without words link to nothing; texts of one to four words are one shingle. Repeated rows
    count as copies. A row with a null key has no class and no links. An empty table gives no rows.
    """
    rows = pick(docs, key, text).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    profiles = stored(rows.select("id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(by_batch(_profiles), "id long, text_hash long, set binary, tokens array<long>, sketch binary"))
    known = profiles.filter("id IS NOT NULL AND set IS NOT NULL")
    classes = known.groupBy("set").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes)
    # a key that repeats with other texts may stand for several sets; sets have numbers of their own
    sets = known.join(classes.select(F.col("set").alias("s2"), "rep"), (F.col("set") == F.col("s2")) & (F.col("id") == F.col("rep")))
    sets = stored(sets.select(F.xxhash64("set").alias("id"), "tokens", "sketch").dropDuplicates(["id"]))
    nodes = _chosen_paths(sets)
    compared = in_blocks(nodes.join(sets.select("id", "sketch"), "id"), "node", "n", block=2 * LIMIT)
    compared = by_key(compared.select("task_key", "id", "sketch", "side", "alone"))
    near = components(compared.mapInArrow(_similar_sketches, "u long, v long"))
    near = stored(near.join(near.groupBy("root").agg(F.count("*").alias("n")), "root"))
    members = classes.withColumn("id", F.xxhash64("set")).join(near, "id")
    texts = rows.withColumnRenamed("id", "rep").join(members, "rep").select("id", "copies", "root", "n", "set", "text")
    texts = texts.mapInArrow(by_batch(_shingle_rows), "id long, copies long, root long, n long, shingles binary")
    blocks = in_blocks(texts, "root", "n", block=256).select("task_key", "id", "copies", "shingles", "side", "alone")
    found = stored(by_key(blocks).mapInArrow(_exact_links, "id long, links long, hangs_on long"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("u"), F.col("hangs_on").alias("v")))
    linked = classes.withColumn("id", F.xxhash64("set")).join(links, "id", "left").join(joined, "id", "left")
    linked = linked.select("set", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("root"))
    linked = stored(linked)
    names = linked.groupBy("root").agg(F.min("rep").alias("class_id"))
    linked = linked.join(names, "root").select(F.col("set").alias("s2"), "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    out = profiles.select("id", "text_hash", F.when(F.col("id").isNotNull(), F.col("set")).alias("set")).join(stored(linked), F.col("set") == F.col("s2"), "left")
    return out.select(F.col("id").alias(key), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "text_hash")


def one_of_each_class(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all columns, that have the smallest key of their class.

    Equal rows of one key are one document. Rows of one key with different texts are told apart;
    where such texts are linked with each other, all that have the smallest key stay.
    """
    classes = jaccard_classes(docs, key=key, text=text)
    lost = classes.filter(F.col(key) != F.col("class_id")).select(F.col(key).alias("_key"), "text_hash").distinct()
    names = docs.columns
    place = names.index(key)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own, words = f"c{place}", f"c{names.index(text)}"
    plain = plain.withColumn("_hash", F.xxhash64(words))
    kept = plain.join(stored(lost), (F.col(own) == F.col("_key")) & (F.col("_hash") == F.col("text_hash")), "left_anti")
    return kept.dropDuplicates([own, "_hash"]).drop("_hash").toDF(*names)
