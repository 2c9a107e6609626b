"""Prefix-free parsing of byte strings into phrases at rolling-hash triggers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Length of the strings whose repeats are looked for, and of the trigger strings.
SPAN, TRIGGER = 100, 16
_BYTES = np.random.RandomState(3).randint(1, 2**63 - 1, 256, np.int64).astype(np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_PLACE, _PIECE = np.uint64(24), 1 << 23


@dataclass
class Parse:
    """Phrases of a run of texts: text, first span's start in it, spans, trigger, content."""

    text: np.ndarray
    start: np.ndarray
    spans: np.ndarray
    trigger: np.ndarray
    content: np.ndarray


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """The hash of each ``width`` (a power of two) bytes, by doubling."""
    out, factor, n = values, _BASE, 1
    while n < width:
        out = out[:-n] * factor + out[n:]
        factor, n = factor * factor, 2 * n
    out = out ^ (out >> np.uint64(32))
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    out, n = values, 1
    while 2 * n <= width:
        out = np.minimum(out[:-n], out[n:])
        n *= 2
    rest = width - n
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def trigger_places(hashes: np.ndarray) -> np.ndarray:
    """The place of each span's trigger: the least hash without its last ``_PLACE`` bits, the first of equals.

    Long inputs go piece by piece, so that a place always fits into those bits and the choice
    depends on the span's bytes alone.
    """
    width, out = SPAN - TRIGGER + 1, []
    for at in range(0, len(hashes) - width + 1, _PIECE):
        own = hashes[at : at + _PIECE + width - 1]
        least = sliding_min((own >> _PLACE << _PLACE) | np.arange(len(own), dtype=np.uint64), width)
        out.append((least & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64) + at)
    return np.concatenate(out)


def parse(texts: list[bytes]) -> Parse:
    """Cuts texts into phrases such that equal spans always lie in phrases with equal triggers.

    The trigger of a span (``SPAN`` bytes) is the ``TRIGGER`` bytes in it with the least hash, the
    first of equals: its own bytes alone decide it. Neighbouring spans with the same trigger place
    are a phrase; its content reaches from the first byte of its first span to the last byte of its
    last one. So phrases overlap by ``SPAN - 1`` bytes, every span lies in one phrase, no phrase holds a
    span twice, and a phrase has at most ``SPAN - TRIGGER + 1`` spans. Texts shorter than a span have none.
    """
    with np.errstate(over="ignore"):
        data = b"".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.cumsum(sizes) - sizes
        none = np.empty(0, np.int64)
        if len(data) < SPAN:
            return Parse(none, none, none, none, none)
        values = _BYTES[np.frombuffer(data, np.uint8)]
        hashes = rolling(values, TRIGGER)
        place = trigger_places(hashes)
        owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - SPAN + 1, 0))
        at = np.arange(len(owner)) - np.repeat(np.cumsum(np.maximum(sizes - SPAN + 1, 0)) - np.maximum(sizes - SPAN + 1, 0), np.maximum(sizes - SPAN + 1, 0)) + begins[owner]
        place = place[at]
        fresh = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(owner) != 0)]) if len(at) else none
        spans = np.diff(np.r_[fresh, len(at)])
        begin, text, place = at[fresh], owner[fresh], place[fresh]
        return Parse(text, begin - begins[text], spans, hashes[place].view(np.int64), _contents(values, begin, spans))


def _contents(values: np.ndarray, begin: np.ndarray, spans: np.ndarray) -> np.ndarray:
    sums = np.r_[np.uint64(0), np.cumsum(values * _powers(_BASE, len(values)))]
    out = (sums[begin + spans + SPAN - 1] - sums[begin]) * _powers(_BACK, len(values))[begin]
    out = (out ^ (out >> np.uint64(32))) * _MIX + spans.astype(np.uint64)
    return (out ^ (out >> np.uint64(31))).view(np.int64)


def contents(data: bytes, begin: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """The content hash of phrases that begin at given bytes."""
    with np.errstate(over="ignore"):
        return _contents(_BYTES[np.frombuffer(data, np.uint8)], begin, spans)


def trigger_offsets(data: bytes, begin: np.ndarray, trigger: np.ndarray) -> np.ndarray:
    """How far into each phrase its trigger stands."""
    with np.errstate(over="ignore"):
        hashes = rolling(_BYTES[np.frombuffer(data, np.uint8)], TRIGGER).view(np.int64)
    near = begin[:, None] + np.arange(SPAN - TRIGGER + 1)
    return np.argmax(hashes[near] == trigger[:, None], axis=1)


def first_in_text(own: Parse) -> np.ndarray:
    """Whether no equal phrase stands before in the same text."""
    order = np.lexsort((own.start, own.content, own.trigger, own.text))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(own.text[order]) != 0) | (np.diff(own.trigger[order]) != 0) | (np.diff(own.content[order]) != 0)
    out = np.empty(len(order), bool)
    out[order] = fresh
    return out
