"""Personal data found by patterns, and more of it by contexts that are learned from what was found.

Identifiers that the base patterns find are seeds. The words around every mention of something that
looks like an identifier are lexical patterns. Patterns and identifiers form a graph: a pattern is
trusted for a kind if most identifiers that it stands around are known to be of that kind, and an
identifier is accepted if trusted patterns vouch for it. Accepted ones are known in the next round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import pick, stored

KINDS = ("email", "ip", "card", "phone")

# Patterns of the base kinds. They match what the plain ones match, but never try a run of
# characters from its middle and never step back, so a text of any length takes linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Shapes that are nothing by themselves but may turn out to be an identifier of some kind.
LOOSE = {
    "number": r"(?<![0-9A-Za-z+])[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+",
    "masked": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)++",
    "hex": r"(?:\G|(?<![0-9A-Fa-f:]))[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}+",
}
#: Kinds that a shape may turn out to be; a failed match of a base kind may be of that kind.
MAY_BE = {"email": ("email",), "ip": ("ip",), "card": ("card",), "phone": ("phone",), "number": ("card", "phone"), "masked": ("email",), "hex": ("ip",)}

#: Rounds at most; it ends sooner when one finds nothing new.
ROUNDS = 3
#: A pattern is trusted for a kind that so many of its identifiers, and so large a share of all, are of.
SUPPORT, TRUST = 3, 0.5
#: An identifier is accepted at this chance that one of its patterns is right.
ACCEPT = 0.6
#: Characters before and after a mention that its patterns are taken from.
BEFORE, AFTER = 60, 30

_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _needed(text: Column, shape: str) -> Column:
    """A cheap test that every text with a match passes."""
    if shape == "email":
        return F.contains(text, F.lit("@"))
    if shape == "phone":
        return F.contains(text, F.lit("+"))
    if shape == "masked":
        return text.rlike(r"[(\[](?:at|AT)[)\]]")
    if shape == "hex":
        return text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]*:")
    return text.rlike("[0-9]")


def _matches(text: Column, pattern: str) -> Column:
    """Matches in order, each with the length of what stands between it and the one before, and its surroundings."""
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.slice(gaps, 2, 1 << 30).alias("next"))
    return F.transform(
        zipped,
        lambda x: F.struct(
            F.length(x["gap"]).alias("gap"),
            x["found"].alias("found"),
            F.lower(F.right(x["gap"], F.lit(BEFORE))).alias("before"),
            F.lower(F.left(F.coalesce(x["next"], F.lit("")), F.lit(AFTER))).alias("after"),
        ),
    )


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(shape: Column, found: Column, digits: Column) -> Column:
    size = F.length(digits)
    return (
        F.when(shape == "email", F.lit(True))
        .when(shape == "ip", found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(shape == "card", F.when(size.between(13, 19), _luhn(digits)).otherwise(F.lit(False)))
        .when(shape == "phone", size.between(9, 15))
        .otherwise(F.lit(False))
    )


def _contexts(before: Column, after: Column) -> Column:
    """The lexical patterns of a mention: the two words before it, and the words on both sides."""
    left, right = F.regexp_extract_all(before, F.lit(r"\p{L}+"), F.lit(0)), F.regexp_extract_all(after, F.lit(r"\p{L}+"), F.lit(0))
    two = F.when(F.size(left) > 1, F.concat(F.lit("<< "), F.array_join(F.slice(left, -2, 2), " ")))
    both = F.when((F.size(left) > 0) & (F.size(right) > 0), F.concat(F.element_at(left, -1), F.lit(" <> "), F.get(right, F.lit(0))))
    return F.array_compact(F.array(two, both))


def mentions(texts: DataFrame) -> DataFrame:
    """Everything that looks like an identifier in texts ``t`` named ``h``: shape, span, value, patterns, and whether it is valid.

    Equal texts are one. Places are running sums of the lengths of matches and of what lies between.
    What is not valid but overlaps a valid mention is part of it, and left out.
    """
    shapes = F.array_compact(F.array(*[F.when(_needed(F.col("t"), shape), F.lit(shape)) for shape in BASE | LOOSE]))
    matches = F.lit(None)
    for shape, pattern in (BASE | LOOSE).items():  # one shape at a time, which bounds what a long text takes
        matches = F.when(F.col("shape") == shape, _matches(F.col("t"), pattern)).otherwise(matches)
    rows = texts.select("h", "t", F.explode(shapes).alias("shape")).select("h", "shape", F.posexplode(matches).alias("i", "r"))
    rows = rows.select("h", "shape", "i", "r.*").filter("found IS NOT NULL").distinct().repartition("h")
    one = Window.partitionBy("h", "shape").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("stop", F.sum(F.col("gap") + F.length("found")).over(one)).withColumn("begin", F.col("stop") - F.length("found"))
    rows = rows.withColumn("digits", F.regexp_replace("found", "[^0-9]", ""))
    number = F.col("shape").isin("card", "phone", "number")
    value = F.when(number, F.col("digits")).otherwise(F.lower("found"))
    plain = F.regexp_replace(F.regexp_replace(value, r"\x20?[(\[]at[)\]]\x20?", "@"), r"\x20?[(\[]dot[)\]]\x20?", ".")
    rows = rows.withColumn("valid", _valid(F.col("shape"), F.col("found"), F.col("digits")))
    order = Window.partitionBy("h").orderBy("begin", F.desc("valid"), F.desc("stop"))
    done = F.max(F.when(F.col("valid"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(F.col("valid"), F.col("begin"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumns({"done": F.coalesce(done, F.lit(0)), "ahead": F.coalesce(ahead, F.col("stop"))})
    return rows.filter("valid OR (done <= begin AND ahead >= stop)").select(
        "h", "shape", "begin", "stop", "valid",
        F.when(F.col("shape") == "masked", plain).otherwise(value).alias("value"),
        _contexts(F.col("before"), F.col("after")).alias("contexts"),
    )


def _may_be() -> Column:
    out = F.lit(None)
    for shape, kinds in MAY_BE.items():
        out = F.when(F.col("shape") == shape, F.array(*map(F.lit, kinds))).otherwise(out)
    return out


def _rank(kind: str) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), F.col(kind))


def trusted_patterns(links: DataFrame) -> DataFrame:
    """(context, kind, trust) of the patterns that are trusted, by how many of their identifiers are known to be of a kind.

    ``links`` has a row per context, identifier and known kind; ``once`` is true in one of an identifier's rows.
    """
    own = links.groupBy("context").agg(F.count_if(F.col("once")).alias("all"), *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS])
    rows = own.select("context", "all", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in KINDS])).alias("x"))
    trust = F.col("x.n") / F.col("all")
    return rows.filter((F.col("x.n") >= SUPPORT) & (trust >= TRUST)).select("context", "x.kind", F.least(trust, F.lit(0.999)).alias("trust"))


def bootstrap(found: DataFrame) -> DataFrame:
    """(value, kind, round) of all known identifiers: seeds, and what trusted patterns vouch for.

    Each round joins the (context, value) edges with what is known and shuffles partial counts of
    them; only the number of new identifiers comes to the driver.
    """
    known = stored(found.filter("valid").select("value", F.col("shape").alias("kind"), F.lit(0).alias("round")).distinct())
    may_be = found.filter("NOT valid").select("value", F.explode(_may_be()).alias("kind")).distinct()
    unclear = stored(may_be.join(known, ["value", "kind"], "left_anti"))
    edges = stored(found.select(F.explode("contexts").alias("context"), "value").distinct())
    for step in range(1, ROUNDS + 1):
        kinds = known.groupBy("value").agg(F.min(_rank("kind")).alias("least"))
        current = known.join(kinds, "value").select("value", "kind", (_rank("kind") == F.col("least")).alias("once"))
        links = edges.join(current, "value", "left").withColumn("once", F.coalesce("once", F.lit(True)))
        vouched = edges.join(trusted_patterns(links), "context").groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("chance"))
        vouched = vouched.filter(F.col("chance") >= ACCEPT).join(unclear, ["value", "kind"], "left_semi").join(known, ["value", "kind"], "left_anti")
        fresh = stored(vouched.select("value", "kind", F.lit(step).alias("round")))
        if not fresh.count():
            break
        known = known.unionByName(fresh)
    return known


def spans_of(found: DataFrame, known: DataFrame) -> DataFrame:
    """(h, kind, begin, stop, base): the base spans, and the mentions of accepted identifiers.

    Of added spans that overlap, the one that begins first stays, then the longer one, then the kind listed first.
    """
    base = found.filter("valid").select("h", F.col("shape").alias("kind"), "begin", "stop", F.lit(True).alias("base"))
    loose = found.filter("NOT valid").select("h", "begin", "stop", "value", F.explode(_may_be()).alias("kind"))
    added = loose.join(known.select("value", "kind"), ["value", "kind"]).select("h", "kind", "begin", "stop", F.lit(False).alias("base"))
    rows = base.unionByName(added.distinct())
    order = Window.partitionBy("h").orderBy("begin", F.desc("stop"), _rank("kind"))
    last = F.max(F.when(~F.col("base"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("last", F.coalesce(last, F.lit(0)))
    return rows.filter("base OR last <= begin").select("h", "kind", "begin", "stop", "base")


def _listed(spans: Column) -> Column:
    text = F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), s["rank"] - 1), s["begin"], s["stop"]))
    return F.array_join(text, ",")


def personal_data(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and places of personal data in every whole text: base spans by pattern, and added ones.

    Base spans are the valid matches of the base patterns. They seed :func:`bootstrap`, and mentions
    of what it accepts are added where they touch no base span. Places are code points, ends exclusive.
    Only mentions are shuffled, never texts; equal texts share their mentions, and a text without a digit
    or an @ meets no join. Patterns that stand in very many texts are counted by partial sums.

    Null and empty texts have no spans: zeros, empty lists and the hash of an empty text. Every row
    gives a row, repeated ones and null keys too. An empty table gives no rows.
    """
    rows = pick(docs, key, text).select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    may_hold = F.col("t").rlike("[0-9@]") | _needed(F.col("t"), "masked") | _needed(F.col("t"), "hex")
    rows = rows.select("k", "t", F.when(may_hold, F.sha2("t", 256)).alias("h"))
    found = stored(mentions(rows.filter("h IS NOT NULL")))
    spans = spans_of(found, bootstrap(found))
    place = F.struct(_rank("kind").alias("rank"), "begin", "stop")
    own = spans.groupBy("h").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(F.col("base"), place)).alias("own"), F.collect_list(place).alias("every"),
    ).select("h", *[f"n_{k}" for k in KINDS], _listed(F.col("own")).alias("own"), _listed(F.col("every")).alias("every"))
    joined = rows.filter("h IS NOT NULL").select("k", "h").join(own, "h", "left").drop("h")
    none = rows.filter("h IS NULL").select("k", *[F.lit(None).cast("long").alias(f"n_{k}") for k in KINDS], *[F.lit(None).cast("string").alias(c) for c in ("own", "every")])
    return joined.unionByName(none).select(
        F.col("k").alias(key),
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("own", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("every", F.lit("")).alias("spans"),
    )
