"""URL rules held in a cascade of Bloom filters that is exact over the corpus's own keys."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import by_batch, pick

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains and all paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @staticmethod
    def parse(text: str, verdict: str) -> Rule:
        host, _, path = text.partition("/")
        return Rule(host, "/" + path, verdict)

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass
class Bloom:
    bits: bytearray
    hashes: int
    seed: int

    @staticmethod
    def of(keys: Iterable[str], rate: float, seed: int) -> Bloom:
        keys = list(keys)
        size = max(64, math.ceil(len(keys) * -math.log(rate) / math.log(2) ** 2))
        made = Bloom(bytearray(-(-size // 8)), max(1, round(-math.log2(rate))), seed)
        for key in keys:
            for place in made.places(key):
                made.bits[place >> 3] |= 1 << (place & 7)
        return made

    def places(self, key: str) -> list[int]:
        value = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"), seed=self.seed)
        first, step, size = value >> 64, value & (2**64 - 1) | 1, 8 * len(self.bits)
        return [(first + i * step) % size for i in range(self.hashes)]

    def __contains__(self, key: str) -> bool:
        return all(self.bits[p >> 3] >> (p & 7) & 1 for p in self.places(key))


@dataclass
class Cascade:
    """Filters that alternately hold listed keys and the others that the level before lets through.

    The first level that rejects a key decides: a level of listed keys says "not listed", a level of
    false positives says "listed". Exact for every key of the universe it was made over.
    """

    levels: list[Bloom] = field(default_factory=list)

    def __contains__(self, key: str) -> bool:
        for i, level in enumerate(self.levels):
            if key not in level:
                return i % 2 == 1
        return len(self.levels) % 2 == 1


def build_cascade(listed: set[str], universe: DataFrame) -> Cascade:
    """A cascade for ``listed`` that is exact over ``universe``, a table of one column of keys.

    ``listed`` is a rule list that the caller holds. The first filter's error rate is set from the
    size of the universe so that about 0.7 times as many other keys pass as are listed; should chance let
    more than twice as many through (and more than 64), a lower rate is used. So what reaches the driver, and the cascade
    itself, is bounded by the list and not by the corpus. All keys of the universe are tested.
    """
    if not listed:
        return Cascade()
    column = universe.columns[0]
    n = universe.count()
    rate = min(0.5, math.sqrt(0.5) * len(listed) / max(n, 1))
    while True:
        first = Bloom.of(listed, rate, 1)

        def passes(batch: pa.RecordBatch, first: Bloom = first) -> pa.RecordBatch:
            keep = [k for k in batch.column(0).to_pylist() if k is not None and k in first and k not in listed]
            return pa.RecordBatch.from_arrays([pa.array(keep, pa.string())], names=["key"])

        bound = max(64, 2 * len(listed))
        others = {r.key for r in universe.select(column).mapInArrow(by_batch(passes), "key string").limit(bound + 1).collect()}
        if len(others) <= bound:
            break
        rate /= 4
    levels, inside, outside = [first], others, set(listed)
    while inside:  # the set that the last level lets through wrongly is what the next one holds
        levels.append(Bloom.of(inside, 0.5, len(levels) + 1))
        inside, outside = {k for k in outside if k in levels[-1]}, inside
    return Cascade(levels)


def host_and_path(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both are empty for null or where no ``://`` stands."""
    after = F.expr(f"CASE WHEN instr(`{url}`, '://') > 0 THEN substring(`{url}`, instr(`{url}`, '://') + 3) ELSE '' END")
    return (
        urls.withColumn("_after", F.coalesce(after, F.lit("")))
        .withColumn("_host", F.regexp_extract("_after", "^([^/?#]*)", 1))
        .withColumn("path", F.regexp_extract(F.expr("substring(_after, length(_host) + 1)"), "^([^?#]*)", 1))
        .withColumn("host", F.translate("_host", UPPER, LOWER))
        .drop("_after", "_host")
    )


def _suffixes(host: str) -> list[str]:
    found = [host]
    while "." in host:
        host = host.partition(".")[2]
        found.append(host)
    return found


def candidate_keys(host: str, path: str, lengths: Iterable[int]) -> list[tuple[str, str]]:
    """Each host and path that a rule with a path of one of ``lengths`` could have to fit, longest first."""
    starts = {path[:n] for n in lengths if n <= len(path)}
    found = {(h, p) for h in _suffixes(host) for p in starts}
    return sorted(found, key=lambda k: (-len(k[0]) - len(k[1]), -len(k[0]), k))


def judge_urls(pages: DataFrame, rules: list[Rule], *, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """Host, path, the longest fitting rule and the verdict of every row's url.

    A rule fits its host and all subdomains where the path begins with the rule's. The keys that a
    rule would need to have to fit some url of the table are the universe; a cascade per verdict is
    built over all of them, so membership is exact and no url is joined with a list. A url that no
    rule fits gets ``default``: it is on neither list.

    Null urls and urls without ``://`` have an empty host and path and fit no rule. Every row gives
    one row; an empty table gives none. Two rules with one key and different verdicts are an error.
    """
    verdicts: dict[str, str] = {}
    for rule in rules:
        if verdicts.setdefault(rule.key, rule.verdict) != rule.verdict:
            raise ValueError(f"{rule.key} has two verdicts")
    lengths = sorted({len(rule.path) for rule in rules})
    rows = host_and_path(pick(pages, key, url), url).select(key, "host", "path")

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = {h + p for host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for h, p in candidate_keys(host, path, lengths)}
        return pa.RecordBatch.from_arrays([pa.array(sorted(own), pa.string())], names=["key"])

    universe = rows.select("host", F.col("path")).mapInArrow(by_batch(keys), "key string").distinct()
    cascades = {v: build_cascade({k for k, own in verdicts.items() if own == v}, universe) for v in sorted(set(verdicts.values()))}

    def decide(host: str, path: str) -> tuple[str | None, str]:
        for h, p in candidate_keys(host, path, lengths):
            for verdict, cascade in cascades.items():
                if h + p in cascade:
                    return h + p, verdict
        return None, default

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [decide(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())],
            names=[key, "host", "path", "rule", "verdict"],
        )

    kind = dict(rows.dtypes)[key]
    return rows.mapInArrow(by_batch(make), f"{key} {kind}, host string, path string, rule string, verdict string")
