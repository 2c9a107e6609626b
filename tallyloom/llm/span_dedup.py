"""Removal of long repeated strings by prefix-free parsing and a suffix array of the dictionary."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import by_batch, forget, pick, slices, stored
from tallyloom.llm.phrases import SPAN, Parse, contents, first_in_text, parse, trigger_offsets

#: Spans of a phrase are dealt into classes by how far into the span the trigger stands: so many offsets each.
OFFSETS = 22

_PHRASE = "doc long, start long, spans int, trigger long, content long"
_CLASS = "core long, doc long, start long, content long, first int, n int, offset int, bytes binary"
_SUFFIX = "core long, side int, rest binary, doc long, start long, content long, first int"
_BORDER = f"part int, kind int, {_SUFFIX}"


def _parses(column: pa.Array) -> Iterator[tuple[int, list[bytes], Parse]]:
    for first, texts in slices(column):
        data = [t.encode() for t in texts]
        yield first, data, parse(data)


def _phrases(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Phrases of every text, each once: those that repeat inside a text are its own affair."""
    parts = []
    docs = batch.column(0).to_numpy(zero_copy_only=False)
    for first, _, own in _parses(batch.column(1)):
        keep = first_in_text(own)
        parts.append([x[keep] for x in (docs[first + own.text], own.start, own.spans, own.trigger, own.content)])
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    kinds = (np.int64, np.int64, np.int32, np.int64, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)], names=["doc", "start", "spans", "trigger", "content"])


def _triggers(batch: pa.RecordBatch) -> pa.RecordBatch:
    found, counts = np.unique(_phrases(batch).column("trigger").to_numpy(), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts.astype(np.int64))], names=["trigger", "n"])


def _classes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The classes of spans of the phrases wanted of each text; a text that isn't the one they come from has none.

    All spans of one class hold the same bytes around the trigger, ``SPAN - OFFSETS + 1`` of them: equal spans
    of different phrases have the same ``core``. ``offset`` is the first span's place in its class, ``bytes``
    what its spans hold to the left and to the right of the core.
    """
    out: list[list] = [[] for _ in range(8)]
    for key, text, wanted in zip(*(batch.column(i) for i in range(3)), strict=True):
        data, items = text.as_py().encode(), wanted.values
        start, spans, trigger, content = (items.field(n).to_numpy(zero_copy_only=False) for n in ("start", "spans", "trigger", "content"))
        fits = np.flatnonzero(start + spans + SPAN - 1 <= len(data))
        fits = fits[contents(data, start[fits], spans[fits]) == content[fits]] if len(fits) else fits
        if not len(fits):
            continue
        start, spans, trigger, content = start[fits], spans[fits], trigger[fits], content[fits]
        # the trigger stands at this offset of the first span, at one less of the next, and so on
        for at, n, own, what, most in zip(start.tolist(), spans.tolist(), trigger.tolist(), content.tolist(), trigger_offsets(data, start, trigger).tolist(), strict=True):
            place = at + most
            for kind in range((most - n + 1) // OFFSETS, most // OFFSETS + 1):
                high = min(most, kind * OFFSETS + OFFSETS - 1)
                low = max(most - n + 1, kind * OFFSETS)
                begin, end = place - kind * OFFSETS, place - kind * OFFSETS + SPAN - OFFSETS + 1
                out[0].append(xxhash.xxh3_64_intdigest(data[begin:end], own & (2**64 - 1) ^ kind) - 2**63)
                out[1].append(key.as_py())
                out[2].append(at)
                out[3].append(what)
                out[4].append(most - high)
                out[5].append(high - low + 1)
                out[6].append(high - kind * OFFSETS)
                out[7].append(data[place - high : begin] + data[end : place - low + SPAN])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[f.split()[0] for f in _CLASS.split(", ")])


def _suffixes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Every span of some classes: its core, its offset, and the bytes that the core leaves out."""
    columns = {n: batch.column(i) for i, n in enumerate(("core", "doc", "start", "content", "first", "n", "offset", "bytes"))}
    n, offset, first = (columns[c].to_numpy() for c in ("n", "offset", "first"))
    who = np.repeat(np.arange(batch.num_rows), n)
    step = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
    begins = np.cumsum([0, *(len(b.as_py()) for b in columns["bytes"])])[:-1]
    data = np.frombuffer(b"".join(columns["bytes"].to_pylist()), np.uint8)
    # a span has as many bytes to the left of the core as its offset says, and the next ones to the right
    left = offset[who] - step
    place = begins[who][:, None] + step[:, None] + np.arange(OFFSETS - 1)
    rest = pa.Array.from_buffers(pa.binary(OFFSETS - 1), len(who), [None, pa.py_buffer(data[place].tobytes())]).cast(pa.binary())
    taken = [columns[c].take(pa.array(who)) for c in ("core", "doc", "start", "content")]
    return pa.RecordBatch.from_arrays(
        [taken[0], pa.array(left.astype(np.int32)), rest, *taken[1:], pa.array((first[who] + step).astype(np.int32))],
        names=[f.split()[0] for f in _SUFFIX.split(", ")],
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks every suffix of a sorted partition that equals the one before; the first one as unknown.

    Each batch carries the last suffix of the one before. The first row of a partition, and the last
    one, come out as borders, by which the partitions are compared.
    """
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        core, offset = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        raw = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, OFFSETS - 1)
        same = (np.diff(core) == 0) & (np.diff(offset) == 0) & (raw[1:] == raw[:-1]).all(axis=1)
        head = (core[0], offset[0], raw[0].tobytes())
        again = np.r_[last == head, same]
        kind = np.where(again, 1, 0)
        if last is None:
            kind[0] = 2
        places = np.flatnonzero(kind)
        rows = batch.take(pa.array(places))
        last = (core[-1], offset[-1], raw[-1].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(places), part), pa.int32()), pa.array(kind[places], pa.int32()), *rows.columns], names=[f.split()[0] for f in _BORDER.split(", ")]
        )
    if last is not None:
        end = [part, 3, *(x.item() if hasattr(x, "item") else x for x in last), None, None, None, None]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(end, kinds, strict=True)], names=[f.split()[0] for f in _BORDER.split(", ")])


def _sorted_marks(suffixes: DataFrame) -> DataFrame:
    """(doc, start, content, first, n) of every suffix that stands earlier too.

    The suffixes are sorted by a range partitioning over their bytes and places, so equal ones may
    reach over any number of partitions: the first of all is the earliest, every other one is marked. A partition's first
    row is judged by the last row of the partition before it, from a table of two rows a partition.
    """
    order = ["core", "side", "rest", "doc", "at"]
    rows = stored(suffixes.withColumn("at", F.col("start") + F.col("first")))
    columns = [f.split()[0] for f in _SUFFIX.split(", ")]
    judged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns).mapInArrow(_neighbours, _BORDER)
    judged = stored(judged)
    forget(rows)
    borders = judged.filter("kind >= 2")
    before = Window.partitionBy(F.lit(0)).orderBy("part", "kind")
    same = [F.lag(c).over(before) == F.col(c) for c in ("core", "side", "rest")]
    heads = borders.withColumn("again", same[0] & same[1] & same[2]).filter("kind = 2 AND again")
    marks = judged.filter("kind = 1").select("doc", "start", "content", "first", F.lit(1).alias("n"))
    return marks.unionByName(heads.select("doc", "start", "content", "first", F.lit(1).alias("n")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Runs of ``n`` spans, from the ``first`` of the phrase ``content`` at ``start`` of ``doc``, that stand earlier too.

    Takes rows of ``doc`` and ``text``. A phrase that repeats inside one text is reported at its first
    place only; whoever reads the text sees the other places itself.

    Texts are parsed into phrases. The distinct phrases are the dictionary, their occurrences the
    parse; an occurrence after the first of its phrase is marked as a whole. Spans of different
    phrases can only be equal if the phrases share their trigger, so phrases whose trigger is their
    own are done. The spans of the others are dealt into classes by where the trigger stands in them:
    equal spans lie in classes with an equal core of ``SPAN - OFFSETS + 1`` bytes. Of equal classes
    all but the earliest are marked; classes whose core is their own are done. What is left is sorted by suffix
    to the depth of a span (:func:`_sorted_marks`). Every trigger goes the same way, however many phrases it has.
    """
    docs = docs.filter("doc IS NOT NULL")
    counts = docs.mapInArrow(by_batch(_triggers), "trigger long, n long").groupBy("trigger").agg(F.sum("n").alias("n"))
    shared = stored(counts.filter("n > 1").select("trigger"))
    parsed = stored(docs.mapInArrow(by_batch(_phrases), _PHRASE).join(shared, "trigger", "left_semi"))
    place = F.struct("doc", "start")
    dictionary = stored(parsed.groupBy("trigger", "content").agg(F.min(place).alias("at"), F.first("spans").alias("spans"), F.count("*").alias("n")))
    where = dictionary.filter("n > 1").select("trigger", "content", "at.doc", "at.start")
    once = dictionary.filter("n = 1").select("trigger", "content", "at.doc", "at.start")
    later = parsed.join(where.unionByName(once), ["doc", "start", "trigger", "content"], "left_anti")
    marks = [stored(later.select("doc", "start", "content", F.lit(0).alias("first"), F.col("spans").alias("n")))]
    forget(shared, parsed)

    kinds = dictionary.groupBy("trigger").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    unclear = dictionary.join(kinds.select("trigger"), "trigger").select("at.doc", F.struct("at.start", "spans", "trigger", "content").alias("p"))
    wanted = unclear.groupBy("doc").agg(F.collect_list("p").alias("wanted"))
    found = docs.join(wanted, "doc").select("doc", "text", "wanted")
    found = stored(found.mapInArrow(by_batch(_classes), _CLASS))
    forget(dictionary)
    at = F.struct("doc", (F.col("start") + F.col("first")).alias("at"), "start", "content", "first", "n")
    equal = stored(found.groupBy("core", "offset", "bytes").agg(F.min(at).alias("e")))
    known = equal.select("e.doc", "e.start", "e.content", "e.first")
    marks.append(stored(found.select("doc", "start", "content", "first", "n").join(known, ["doc", "start", "content", "first"], "left_anti")))
    forget(found)
    cores = equal.groupBy("core").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("core")
    open_classes = equal.join(cores, "core", "left_semi").select("core", "e.doc", "e.start", "e.content", "e.first", "e.n", "offset", "bytes")
    marks.append(_sorted_marks(open_classes.mapInArrow(by_batch(_suffixes), _SUFFIX)))
    return marks[0].unionByName(marks[1]).unionByName(marks[2])


def _removed(data: bytes, own: Parse, fresh: np.ndarray, marks: pa.StructArray | None) -> np.ndarray:
    """Which bytes of one text go. ``own`` and ``fresh`` are the text's part of the parse."""
    change = np.zeros(len(data) + 1, np.int64)
    again = np.flatnonzero(~fresh)
    np.add.at(change, own.start[again], 1)
    np.add.at(change, own.start[again] + own.spans[again] + SPAN - 1, -1)
    if marks is not None and len(marks):
        start, content, first, n = (marks.field(c).to_numpy() for c in ("start", "content", "first", "n"))
        at = np.minimum(np.searchsorted(own.start, start), max(0, len(own.start) - 1))
        good = (own.start[at] == start) & (own.content[at] == content) if len(own.start) else np.zeros(len(start), bool)
        begin = (start + first)[good]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + n[good] + SPAN - 1, -1)
    return np.cumsum(change[:-1]) > 0


def _each_text(batch: pa.RecordBatch, text: int, marks: int) -> Iterator[tuple[bytes, np.ndarray]]:
    lists = batch.column(marks)
    for first, data, own in _parses(batch.column(text)):
        fresh = first_in_text(own)
        cuts = np.searchsorted(own.text, np.arange(len(data) + 1))
        for i, raw in enumerate(data):
            part = slice(cuts[i], cuts[i + 1])
            here = Parse(*(x[part] for x in (own.text, own.start, own.spans, own.trigger, own.content)))
            value = lists[first + i]
            yield raw, _removed(raw, here, fresh[part], value.values if value.is_valid else None)


def _with_marks(rows: DataFrame, key: str, text: str) -> DataFrame:
    spans = repeated_spans(pick(rows, key, text).select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    marks = spans.groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("start", "content", "first", "n")).alias("_marks"))
    return rows.join(marks, F.col(key) == F.col("_doc"), "left").drop("_doc")


def remove_repeats(docs: DataFrame, make: Callable[[pa.RecordBatch, list[tuple[bytes, np.ndarray]]], list[pa.Array]], form: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``make`` of every batch of rows and its (bytes, which of them go)."""
    rows = _with_marks(docs, key, text)
    place, last = docs.columns.index(text), len(docs.columns)
    names = [f.split()[0] for f in form.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(make(batch, list(_each_text(batch, place, last))), names=names)

    return rows.mapInArrow(by_batch(run), form)


def span_digest(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes, removed bytes, removed runs and the SHA-256 of the rest of every whole text.

    A byte goes if a string of ``SPAN`` bytes over it stands earlier too: in a document with a
    smaller key, or in the same one at an earlier start; overlaps count. Strings are judged on the input.

    Null counts as empty text. Rows with one key are one document: at equal starts neither is
    earlier, so equal rows get equal results. A row with a null key is compared with itself alone.
    Texts under ``SPAN`` bytes keep all. An empty table gives no rows.
    """
    rows = pick(docs, key, text)

    def make(batch: pa.RecordBatch, texts: list[tuple[bytes, np.ndarray]]) -> list[pa.Array]:
        size, gone, runs, rest = [], [], [], []
        for data, out in texts:
            size.append(len(data))
            gone.append(int(out.sum()))
            runs.append(int(np.count_nonzero(np.diff(np.r_[0, out.astype(np.int8)]) == 1)))
            rest.append(hashlib.sha256(np.frombuffer(data, np.uint8)[~out].tobytes()).hexdigest())
        return [batch.column(0), *(pa.array(x, pa.int64()) for x in (size, gone, runs)), pa.array(rest, pa.string())]

    return remove_repeats(rows, make, f"{key} {dict(rows.dtypes)[key]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string", key=key, text=text)


def without_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents, with all columns, without the bytes that :func:`span_digest` removes.

    A character of which a byte stays, stays. ``length`` becomes the number of characters left. A
    text that loses all goes with its row; one that was empty before stays.
    """
    place, size = docs.columns.index(text), docs.columns.index(length)
    fields = docs.schema.fields

    def make(batch: pa.RecordBatch, texts: list[tuple[bytes, np.ndarray]]) -> list[pa.Array]:
        left = [kept_text(*t) for t in texts]
        stays = pa.array([bool(new) or not old[0] for new, old in zip(left, texts, strict=True)], pa.bool_())
        columns = list(batch.columns[: len(fields)])
        columns[size] = pa.array([len(t) for t in left], columns[size].type)
        columns[place] = pa.array(left, pa.string())
        return [c.filter(stays) for c in columns]

    rows = docs.toDF(*[f"c{i}" for i in range(len(fields))])
    form = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(fields))
    return remove_repeats(rows, make, form, key=f"c{docs.columns.index(key)}", text=f"c{place}").toDF(*docs.columns)


def kept_text(data: bytes, out: np.ndarray) -> str:
    """The text without its removed bytes; a character of which a byte stays stays whole."""
    raw = np.frombuffer(data, np.uint8)
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    if not len(heads):
        return ""
    stays = np.add.reduceat((~out).astype(np.int64), heads) > 0
    return raw[np.repeat(stays, np.diff(np.r_[heads, len(raw)]))].tobytes().decode()
