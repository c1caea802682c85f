"""Homomorphic multiset hashes of documents: wide vectors hashed from paragraphs, summed modulo powers of two.

A text is the multiset of its paragraphs (what line feeds part; an empty text has one empty paragraph). Each paragraph hashes
to a vector of sums: sixteen lanes of 32 bits from its sha512, the number of its units, and 128 lanes that count, for each
bit of two 64-bit hashes, the units that have it set. Units are the paragraph itself and every three words in a row in it
(words are parted by spaces). A document's fingerprint is the sum of its paragraphs' vectors, each lane modulo 2**32, so

- it does not depend on the order of paragraphs; equal multisets have equal fingerprints, others differ but for collisions
  of 512 bits (of sums, which someone who may choose paragraphs freely can look for: no seal against forgery);
- ``plus`` and ``minus`` insert and delete paragraphs without the rest of the text;
- ``likeness`` estimates from two fingerprints alone which share of their units they have in common: twice the number of
  common units over that of both, by the mean square of the signed lanes; the standard error is 0.09 for texts that have
  nothing in common and falls to none for equal ones.

All of it is built-in functions: one shuffle, by ranges of doc_id, of which the aggregations then make use. Ranges are cut at
quantiles of (doc_id, hash of text), so that repeated doc_ids may be many; rows equal in both are one beside the other.

Nulls: a null text is empty, a null doc_id comes before all others. Repeated rows each give a row. A text is held whole, with
the words of one of its paragraphs, by one task. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: 32-bit lanes of a paragraph's sha512.
EXACT = 16
#: 64-bit hashes of a unit; each bit has a lane, two lanes stand in one sum.
HASHES = 2
MASK = (1 << 32) - 1
PAIR = (1 << 32) + 1
#: Sums of a fingerprint: exact lanes, number of units, pairs of counting lanes.
SUMS = EXACT + 1 + 32 * HASHES
#: Ranges of doc_id: so many for each shuffle partition, and at most.
RANGES, MOST_RANGES = 4, 1 << 17


def _sums(unit: Column, first: Column, paragraph_hash: Column) -> list[Column]:
    """The aggregates of one vector; ``unit`` is an array of hashes, ``first`` marks the unit that stands for the paragraph."""
    exact = [F.sum(F.when(first, F.conv(F.substring(paragraph_hash, 8 * i + 1, 8), 16, 10).cast("long")).otherwise(F.lit(0).cast("long"))) for i in range(EXACT)]
    pairs = [F.sum(F.shiftright(unit[k], j).bitwiseAND(F.lit(PAIR))) for k in range(HASHES) for j in range(32)]
    return [*exact, F.count("*"), *pairs]


def vectors(parts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``lanes``, the sum of the vectors of all paragraphs of ``text`` by key; null texts have none."""
    rows = parts.filter(F.col(text).isNotNull()).select(*keys, F.explode(F.split(text, "\n")).alias("_p"))
    rows = rows.select(*keys, "_p", F.sha2("_p", 512).alias("_d"), F.split("_p", " ").alias("_w"))
    rows = rows.select(*keys, "_p", "_d", "_w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("_w") - 2, F.lit(0)))).alias("_i"))
    three = [F.get("_w", F.col("_i") + j) for j in (-1, 0, 1)]
    hashes = [F.when(F.col("_i") == 0, F.xxhash64(F.lit(k), "_p")).otherwise(F.xxhash64(F.lit(k + HASHES), *three)).alias(f"_h{k}") for k in range(HASHES)]
    rows = rows.select(*keys, "_d", (F.col("_i") == 0).alias("_first"), *hashes)
    sums = [c.alias(f"_s{i}") for i, c in enumerate(_sums([F.col(f"_h{k}") for k in range(HASHES)], F.col("_first"), F.col("_d")))]
    lanes = [F.col(f"_s{i}").bitwiseAND(F.lit(MASK)) if i <= EXACT else F.col(f"_s{i}") for i in range(SUMS)]
    return rows.groupBy(*keys).agg(*sums).select(*keys, F.array(*lanes).alias("lanes"))


def _lanewise(a: Column, b: Column, sign: int) -> Column:
    """Each of the two 32-bit lanes of a pair of sums added or subtracted modulo 2**32."""
    low = lambda x: x.bitwiseAND(F.lit(MASK))
    high = lambda x: F.shiftrightunsigned(x, 32)
    return F.zip_with(a, b, lambda x, y: low(low(x) + sign * low(y)).bitwiseOR(F.shiftleft(low(high(x) + sign * high(y)), 32)))


def plus(a: Column, b: Column) -> Column:
    """Lanes after paragraphs with the lanes ``b`` were inserted."""
    return _lanewise(a, b, 1)


def minus(a: Column, b: Column) -> Column:
    """Lanes after paragraphs with the lanes ``b`` were deleted."""
    return _lanewise(a, b, -1)


def written(lanes: Column) -> Column:
    """Lanes as hex text of 16 digits for each sum."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def read(fingerprint: Column) -> Column:
    """Lanes of a written fingerprint."""
    half = lambda at: F.conv(F.substring(fingerprint, at, F.lit(8)), 16, 10).cast("long")
    return F.transform(F.sequence(F.lit(0), F.lit(SUMS - 1)), lambda i: F.shiftleft(half(16 * i + 1), 32).bitwiseOR(half(16 * i + 9)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common units, 0 to 1; 1 where the fingerprints are equal."""
    signed = lambda lanes: F.flatten(F.transform(F.slice(lanes, EXACT + 2, 32 * HASHES), lambda x: F.array(
        2 * x.bitwiseAND(F.lit(MASK)) - lanes[EXACT], 2 * F.shiftrightunsigned(x, 32) - lanes[EXACT])))
    squares = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    x, y = signed(a), signed(b)
    apart, both = squares(F.zip_with(x, y, lambda v, w: v - w)), squares(x) + squares(y)
    return F.when(a == b, 1.0).when(both == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - apart / both))


def fingerprints(docs: DataFrame, column: str = "text") -> DataFrame:
    """All columns of ``docs`` that are no ``fingerprint``, with the fingerprint of ``column``. Repeated rows must differ in some column or come out as one."""
    keys = [c for c in docs.columns if c != "fingerprint"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keys]).alias("_row"), F.coalesce(F.col(f"`{column}`"), F.lit("")).alias("_text"))
    return vectors(rows, ["_row"], "_text").select("_row.*", written(F.col("lanes")).alias("fingerprint"))


def _ranges(keyed: DataFrame) -> tuple[Column, Column, Column, int]:
    """Range of a row as a column, whether the row begins it, and the number of ranges: cut at quantiles of (id, hash).

    What comes to the driver is one key a range, ``MOST_RANGES`` at most.
    """
    spark = keyed.sparkSession
    most = min(MOST_RANGES, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    firsts = keyed.select("id", "h").repartitionByRange(most, "id", "h").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("id", "h")).alias("k"))
    keys = sorted((r["k"]["id"], r["k"]["h"]) for r in firsts.collect()) or [(0, 0)]
    listed = lambda i: F.split(F.lit(",".join(str(k[i]) for k in keys)), ",").cast("array<bigint>")
    ids, hs = listed(0), listed(1)

    def step(at: Column, more: Column) -> Column:
        there = at + more
        return F.when((F.get(ids, there) < F.col("id")) | ((F.get(ids, there) == F.col("id")) & (F.get(hs, there) <= F.col("h"))), there).otherwise(at)

    jumps = [1 << i for i in reversed(range(max(1, len(keys).bit_length())))]
    place = F.aggregate(F.array(*map(F.lit, jumps)), F.lit(0), step)
    return place, ids, hs, len(keys)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, the text of the next document by doc_id (``next``; the last one's is the first), and where it stands: range, ``at`` in it.

    The first row of a range is also sent to the range before, as its ``guest``, whose own ``next`` is null.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("h"))
    place, ids, hs, n = _ranges(keyed)
    rows = keyed.withColumn("r", place)
    begins = (F.get(ids, F.col("r")) == F.col("id")) & (F.get(hs, F.col("r")) == F.col("h"))
    own, before = F.struct(F.col("r").alias("range"), F.lit(False).alias("guest")), F.struct(((F.col("r") + (n - 1)) % n).alias("range"), F.lit(True).alias("guest"))
    rows = rows.select("doc_id", "text", "id", "h", F.explode(F.when(begins, F.array(own, before)).otherwise(F.array(own))).alias("to")).select("doc_id", "text", "id", "h", "to.*")
    order = W.partitionBy("range").orderBy("guest", F.col("doc_id").isNotNull(), "id", "h")
    return rows.select("range", F.row_number().over(order).alias("at"), "guest", "doc_id", "text", F.when(~F.col("guest"), F.lead("text").over(order)).alias("next"))


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: see the module's text.

    The edited text ends in the first floor(n_chars / 2) characters of the next document in place of as many of its own. Its
    fingerprint is that of the text, less the paragraphs from the cut on, plus those that come in their place.
    """
    n, cut = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    rows = with_next(docs).select("*", n.alias("n_chars"), F.substring("text", F.lit(1), n - cut).alias("kept"), F.substring("text", n - cut + 1, cut).alias("tail"), F.substring("next", F.lit(1), cut).alias("head"))
    rows = rows.select("range", "at", "guest", "doc_id", "n_chars", "kept", "tail", "head", F.substring_index("kept", "\n", -1).alias("broken"), F.sha2(F.concat("kept", "head"), 256).alias("edited_sha256"))
    whole = F.char_length("kept") - F.char_length("broken")
    part = lambda kind, text: F.struct(F.lit(kind).alias("part"), text.alias("body"))
    parts = F.array(part(0, F.when(whole > 0, F.substring("kept", F.lit(1), whole - 1))), part(1, F.concat("broken", "tail")), part(2, F.concat("broken", "head")))
    keys = ["range", "at", "guest", "doc_id", "n_chars", "edited_sha256"]
    sums = vectors(rows.select(*keys, F.explode(parts).alias("x")).select(*keys, "x.*"), [*keys, "part"], "body")
    none = F.array_repeat(F.lit(0).cast("long"), SUMS)
    by = sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("part", "lanes"))).alias("m"))
    of = lambda k: F.coalesce(F.col("m")[k], none)
    by = by.select(*keys, plus(of(0), of(1)).alias("own"), of(1).alias("out"), of(2).alias("into"))
    by = by.select(*keys, "own", plus(minus(F.col("own"), F.col("out")), F.col("into")).alias("other"))
    by = by.select("*", F.lead("own").over(W.partitionBy("range").orderBy("at")).alias("following")).filter(~F.col("guest"))
    return by.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", written(F.col("own")).alias("fingerprint"), written(F.col("other")).alias("edited_fingerprint"),
                     likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"))
