"""Best-fit packing of token sequences in rounds: local bins, then trees of underfull bins."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import by_batch, forget, pick, slices, stored
from tallyloom.llm.token_counts import Splitter

#: Items that one best-fit run holds; a partition with more is packed run by run.
ITEMS = 200_000
#: Shuffles of open bins at most. Only with more than ``ITEMS`` open bins can there be a second one; each
#: brings other bins together, and after the first few hardly any two of them fit into one.
ROUNDS = 12
#: Pre-tokens whose ids a worker remembers; beyond it the store starts afresh.
HELD = 600_000
END_ID = 0

_MEMBER = "struct<doc_id: {key}, piece: int, start: bigint, length: bigint, ids_crc32: bigint, offset: bigint>"


class Ids:
    """Token ids of texts, by the tokenizers library.

    Each pre-token has a number; its ids lie in one array from its begin on. The texts of a run are looked up
    in one pass over their pre-tokens, new ones go to the library's model, and all ids come from one gather.
    """

    def __init__(self, path: str):
        self.splitter = Splitter(path)
        self.special = {t.content: i for i, t in self.splitter.library.get_added_tokens_decoder().items()}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.chars = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.forget()

    def forget(self) -> None:
        """Only number 0 is known: what ends every text."""
        self.known: dict[str, int] = {}
        self.ids, self.begins = np.array([END_ID], np.uint32), np.array([0, 1], np.int64)

    def _learn(self, parts: list[str]) -> None:
        """The ids of ``parts``, which are in normal form and one pre-token each, behind those known."""
        tokenize, special, chars = self.splitter.library.model.tokenize, self.special, self.chars
        new = [[special[p]] if p in special else [t.id for t in tokenize(p.encode().decode("latin-1").translate(chars))] for p in parts]
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(new), np.uint32, int(sizes.sum()))])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes)])

    def of_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by the end id, and where each text's ids begin."""
        parts = [self.splitter.parts(text) for text in texts]
        if len(self.known) > HELD:
            self.forget()
        known, flat = self.known, list(chain.from_iterable(parts))
        found = np.fromiter(map(known.get, flat, repeat(0)), np.int64, len(flat))
        missing = np.flatnonzero(found == 0).tolist()
        if missing:
            new = list(dict.fromkeys(flat[i] for i in missing))
            known.update(zip(new, range(len(known) + 1, len(known) + len(new) + 1), strict=True))
            self._learn(new)
            found[missing] = [known[flat[i]] for i in missing]
        counts = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        numbers = np.zeros(len(found) + len(parts), np.int64)
        words = np.ones(len(numbers), bool)
        words[np.cumsum(counts) - 1] = False
        numbers[words] = found
        sizes = np.diff(self.begins)[numbers]
        ends = np.cumsum(sizes)
        ids = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[numbers] - ends + sizes, sizes)]
        return ids, np.concatenate([[0], ends[np.cumsum(counts) - 1]]) if len(texts) else np.zeros(1, np.int64)


@functools.lru_cache(maxsize=2)
def _ids(path: str) -> Ids:
    return Ids(path)


def cut(docs: DataFrame, vocabulary: str, capacity: int, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of every document: its ids and the end id, cut every ``capacity`` ids."""
    rows = pick(docs, key, text)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        who, piece, start, length, crc = [], [], [], [], []
        for first, texts in slices(batch.column(1)):
            ids, begins = _ids(vocabulary).of_texts(texts)
            data, begins = memoryview(ids.astype("<u4").tobytes()), begins.tolist()
            for i, (begin, end) in enumerate(pairwise(begins), first):
                for at in range(begin, end, capacity):
                    own = min(capacity, end - at)
                    who.append(i)
                    piece.append((at - begin) // capacity)
                    start.append(at - begin)
                    length.append(own)
                    crc.append(zlib.crc32(data[4 * at : 4 * (at + own)]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(who, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
            names=[key, "piece", "start", "length", "ids_crc32"],
        )

    return rows.mapInArrow(by_batch(make), f"{key} {dict(rows.dtypes)[key]}, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins, by best-fit decreasing.

    Bins are kept by the room they have left; the smallest room that fits is the lowest set bit of a
    mask of the rooms that occur. Ties go by position, so equal input gives equal bins.
    """
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, made = 0, 0
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, own = capacity, made
            made += 1
        bins[i], offsets[i] = own, capacity - room
        room -= size
        if room:
            by_room[room].append(own)
            mask |= 1 << room
    return bins, offsets, made


def _pack(level: int, capacity: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs runs of up to ``ITEMS`` items, each a size and its members, into bins of the same form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        context = TaskContext.get()
        number = (level << 56) + ((context.partitionId() if context else 0) << 32)

        def packed(number: int) -> tuple[pa.RecordBatch, int]:
            table = pa.Table.from_batches(held, schema).combine_chunks()
            sizes = table["fill"].to_numpy()
            bins, offsets, made = best_fit(sizes, capacity)
            order = np.lexsort((offsets, bins))
            members = table["members"].combine_chunks()
            members = (members.chunk(0) if isinstance(members, pa.ChunkedArray) else members).take(pa.array(order))
            widths = np.diff(members.offsets.to_numpy())
            flat = members.flatten()
            moved = flat.field("offset").to_numpy() + np.repeat(offsets[order], widths)
            fields = [flat.field(i) for i in range(flat.type.num_fields - 1)] + [pa.array(moved, pa.int64())]
            flat = pa.StructArray.from_arrays(fields, fields=list(flat.type))
            ends = np.concatenate([[0], np.cumsum(np.bincount(bins[order], np.ones(len(order)) * widths, made).astype(np.int64))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), flat).cast(schema.field("members").type)
            fill = np.bincount(bins, sizes, made).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(number + np.arange(made), pa.int64()), pa.array(fill), lists], schema=schema), made

        for batch in batches:
            for at in range(0, batch.num_rows, ITEMS):
                part = batch.slice(at, ITEMS)
                if count + part.num_rows > ITEMS:
                    out, made = packed(number)
                    yield out
                    number, held, count = number + made, [], 0
                held.append(pa.RecordBatch.from_arrays(part.columns, schema=schema))
                count += part.num_rows
        if count:
            yield packed(number)[0]

    return run


def pack(pieces: DataFrame, capacity: int, *, key: str = "doc_id") -> DataFrame:
    """Places pieces of up to ``capacity`` tokens into sequences; adds ``sequence_id`` and ``offset``.

    The first round packs every partition of the stored pieces for itself. Bins with less room than the
    emptiest bin fills can't be joined with any and are done; the others travel on as items with their members, into as many
    partitions as runs of ``ITEMS`` are needed, until one run has held all or a round joins none, ``ROUNDS``
    times at most. Nothing but open bins is ever shuffled and a task holds ``ITEMS`` items. Each round's bins are
    written, so a lost executor finds the same bins again; once the next ones stand, only the done are kept.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = dict(pieces.dtypes)[key]
    form = f"sequence_id bigint, fill bigint, members array<{_MEMBER.format(key=kind)}>"
    member = F.struct(F.col(key).alias("doc_id"), "piece", "start", "length", "ids_crc32", F.lit(0).cast("bigint").alias("offset"))
    items = pieces.select(F.lit(0).cast("bigint").alias("sequence_id"), F.col("length").alias("fill"), F.array(member).alias("members"))
    schema = to_arrow_schema(pieces.sparkSession.createDataFrame([], form).schema)
    level, done, before, last, travelled = 0, [], None, False, None
    while True:
        bins = stored(items.mapInArrow(_pack(level, capacity, schema), form))
        if travelled is not None:
            forget(travelled)
        made, least = bins.agg(F.count("*"), F.min("fill")).first()
        open_bins = bins.filter(F.col("fill") <= capacity - (least or 0))
        n = 0 if last or made == before or level == ROUNDS else open_bins.count()
        if n <= 1:
            done.append(bins)
            break
        done.append(stored(bins.filter(F.col("fill") > capacity - least)))
        parts = -(-n // ITEMS)
        items, before, last, level, travelled = open_bins.repartition(parts, "sequence_id"), n, parts == 1, level + 1, bins
    whole = functools.reduce(DataFrame.unionByName, done)
    return whole.select("sequence_id", F.explode("members").alias("m")).select(
        F.col("m.doc_id").alias(key), "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset"
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token sequences of ``capacity`` at most from every document's whole text.

    A document is its ids followed by id 0; only one longer than ``capacity`` is cut. Null and empty
    texts are the one id 0. Every row is packed, repeated ones too; an empty table gives no rows.
    One row per piece, with the checksum of its ids and its place.
    """
    return pack(stored(cut(docs, vocabulary, capacity, key=key, text=text)), capacity, key=key)
