"""Exact Jaccard self-join of 5-word shingle sets by adaptive multi-match prefixes.

Documents with one shingle set are a class, and only classes are joined. Shingles have one global order: by an estimate of
how many documents have them (a count sketch sized by the texts, summed over all documents), rare ones first, then by hash.
Two sets of n and m shingles link only if they share at least T = ceil(80 (n + m) / 180); then for every l the first l
shingles they share stand so early in both that T - l of their own are left behind each. So a posting carries how many
shingles are left behind it, and two postings meet only if both have T - l left, with l the smaller of the two classes' own.
Each class takes the l, of any size, at which its estimated cost, postings looked up and candidates to verify, is least,
and a longer prefix with it; a pair is verified only if it shares l shingles in that way.

No link is lost and no group is expanded into all its pairs. First come ``ROUNDS`` rounds in which each class is verified
against one pivot only, of the buckets (classes sharing a prefix shingle) the one it shares most of; what links is joined
into components, and shingles whose classes are in one component are done. Then all candidate pairs of classes in
different components are verified. Copies of one text with few changes meet in the rounds; those with too many to link
have their common shingles so late that they do not meet. Buckets of very common shingles are salted by the same estimate.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, discard, join_checked, passes, raw, settle
from .components import components
from .hashing import mix, shingles

PERCENT = 80
#: Cells of the count sketch: a power of two by the bytes of all texts, within these exponents; parts that it is summed in.
LEAST_CELLS, MOST_CELLS, BLOCKS = 16, 22, 64
BYTES_PER_CELL = 32
#: Postings that verifying one candidate is worth.
VERIFY = 10
#: Classes that one bucket should have at most; commoner shingles are salted.
BUCKET = 4000
ROUNDS = 3
#: Classes that one task verifies against one pivot; the pivot's text goes to each such task.
PER_PIVOT = 1000


def need(n: np.ndarray | int, percent: int = PERCENT):
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-n * percent // 100)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
    """Batches with each text's sorted distinct shingle hashes and its class: a hash of the set."""
    for batch, texts in passes(batches, "text", 1 << 18):
        hashes, bounds = shingles(*raw(texts))
        sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        with np.errstate(over="ignore"):
            cls = mix(np.array([mix(s).sum() + np.uint64(len(s)) for s in sets], dtype=np.uint64)).view(np.int64)
        yield batch, sets, cls


def _cells(s: np.ndarray, cells: int) -> np.ndarray:
    return (s & np.uint64(cells - 1)).astype(np.int64)


def _pack_block(counts: np.ndarray) -> bytes:
    """Counts of a block of cells: places and counts of those that are not 0, or all of them."""
    at = np.flatnonzero(counts)
    if 3 * len(at) < 2 * len(counts):
        return b"s" + zlib.compress(np.diff(at, prepend=0).astype("<u4").tobytes() + counts[at].astype("<i8").tobytes(), 1)
    return b"d" + zlib.compress(counts.astype("<i8").tobytes(), 1)


def _add_block(total: np.ndarray, blob: bytes) -> None:
    plain = zlib.decompress(blob[1:])
    if blob[:1] == b"s":
        n = len(plain) // 12
        total[np.cumsum(np.frombuffer(plain, dtype="<u4", count=n))] += np.frombuffer(plain, dtype="<i8", offset=4 * n)
    else:
        total += np.frombuffer(plain, dtype="<i8")


def _describe(cells: int):
    """Each row's class and number of shingles, then a task's part of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "cls", "n", "block", "counts"]
        total, some = np.zeros(cells, dtype=np.int32), False
        for batch, sets, cls in _sets(batches):
            np.add.at(total, _cells(np.concatenate(sets), cells), 1)
            some = True
            n = len(sets)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(cls), pa.array([len(s) for s in sets], pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        parts = [(k, _pack_block(p)) for k, p in enumerate(total.reshape(BLOCKS, -1)) if p.any()] if some else []
        if parts:
            n = len(parts)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array([k for k, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())], names)

    return run


def _sum_blocks(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(column(batch, "block").to_pylist(), column(batch, "counts"), strict=True):
                _add_block(sums.setdefault(block, np.zeros(cells // BLOCKS, dtype=np.int64)), counts.as_py())
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([_pack_block(s) for s in sums.values()], pa.binary())], ["block", "counts"])

    return run


def _rarity(told: DataFrame, cells: int) -> np.ndarray:
    """For each cell eight times the logarithm of its count above the usual one, as a byte: as large as the sketch has cells, whatever the input."""
    blocks = told.filter("block is not null").select("block", "counts").repartition(BLOCKS, "block").mapInArrow(_sum_blocks(cells), "block int, counts binary").toArrow()
    counts = np.zeros(cells, dtype=np.int64)
    for block, part in zip(blocks["block"].to_pylist(), blocks["counts"].to_pylist(), strict=True):
        _add_block(counts.reshape(BLOCKS, -1)[block], part)
    usual = int(np.median(counts))
    return np.minimum(np.round(8 * np.log2(np.maximum(counts - usual, 1))), 255).astype(np.uint8)


def _prefix(s: np.ndarray, rarity: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """Shingles of the chosen prefix, how many are left behind each, l, and how many other documents are thought to have each."""
    n = len(s)
    own = rarity[_cells(s, len(rarity))]
    order = np.lexsort((s, own))
    others = np.exp2(own[order] / 8.0) - 1
    seen = np.cumsum(others)
    # sets of this size meet within n - T + l shingles, those of the least size within n - need + l
    l = np.arange(1, need(n, percent) + 1)  # noqa: E741
    same = n + (-2 * percent * n) // (100 + percent) + l
    looked_up = seen[np.minimum(same, n) - 1]
    best = int(np.argmin(l + looked_up + VERIFY * looked_up / l))
    taken = order[: n - need(n, percent) + 1 + best]
    return s[taken], n - 1 - np.arange(len(taken)), best + 1, others[: len(taken)]


def _postings(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, seen = shared.value, set()
        for batch, sets, classes in _sets(batches):
            out: list[tuple[np.ndarray, ...]] = []
            for doc, s, cls in zip(column(batch, "doc_id").to_pylist(), sets, classes.tolist(), strict=True):
                if not len(s) or cls in seen:
                    continue
                seen.add(cls)
                token, left, l, others = _prefix(s, rarity, percent)  # noqa: E741
                splits = (1 + others // BUCKET).astype(np.uint64)
                salt = mix(np.array([cls]).view(np.uint64))[0] % splits
                k = len(token)
                out.append((token.view(np.int64), np.where(splits > 1, 1 + salt, 0).astype(np.int32), np.full(k, cls), np.full(k, doc), np.full(k, len(s), np.int32), left.astype(np.int32), np.full(k, l, np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["token", "salt", "cls", "doc", "n", "left", "l"])

    return run


def _reach(percent: int) -> Column:
    """``percent`` times the size of the largest set that a posting may meet."""
    return (F.col("left").cast("long") + F.col("l")) * (100 + percent) - F.col("n") * F.lit(percent)


def _meet(a: tuple[str, str, str], b: tuple[str, str, str], percent: int) -> Column:
    """Whether two postings, each (n, left, l), may be among the first l shared shingles of a linked pair."""
    both = F.col(a[0]).cast("long") + F.col(b[0])
    return (F.least(a[1], b[1]).cast("long") + F.least(a[2], b[2])) * (100 + percent) >= both * percent


def _verifier(percent: int):
    """Pairs that link. Rows come sorted by pivot, its own text (no ``a``) before those to compare; its class is checked, as a doc_id may have several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, np.zeros(0, dtype=np.uint64)
        for batch, sets, classes in _sets(batches):
            keep = []
            for i, (a, b, s, cls) in enumerate(zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist(), sets, classes.tolist(), strict=True)):
                if a is None:
                    if cls == b:
                        pivot, own = b, s
                elif a == cls and b == pivot:
                    common = len(np.intersect1d(s, own, assume_unique=True))
                    if 100 * common >= percent * (len(s) + len(own) - common):
                        keep.append(i)
            if keep:
                yield batch.take(pa.array(keep)).select(["a", "b", "ca", "cb"])

    return run


def _verified(documents: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b, their documents da, db, and components ca, cb) those that link, settled: a, b, ca, cb.

    The text of a goes to the task of its b. A b with many partners is dealt over several tasks, its text to each.
    """
    pairs = settle(pairs, "pairs")
    parts = pairs.groupBy("b").agg(F.min("db").alias("db"), F.floor(F.count("*") / PER_PIVOT).cast("int").alias("more"))
    pivots = settle(parts, "pivots")
    one = join_checked(pairs, pivots.filter("more > 0").select("b", "more"), ["b"], how="left").withColumn("part", F.pmod(F.xxhash64("a"), F.coalesce("more", F.lit(0)) + 1).cast("int"))
    wanted = one.select(F.col("da").alias("doc_id"), "a", "b", "part", "ca", "cb")
    null = F.lit(None).cast("long")
    wanted = settle(wanted.unionByName(pivots.select(F.col("db").alias("doc_id"), null.alias("a"), "b", F.explode(F.sequence(F.lit(0), F.col("more"))).alias("part"), null.alias("ca"), null.alias("cb"))), "wanted")
    texts = join_checked(documents, wanted, ["doc_id"])
    dealt = texts.select("a", "b", "part", "ca", "cb", "text").repartition("b", "part").sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
    links = settle(dealt.mapInArrow(_verifier(percent), "a long, b long, ca long, cb long"), "links")
    discard(pairs, pivots, wanted)
    return links


def _open_postings(documents: DataFrame, rarity: np.ndarray, percent: int) -> DataFrame:
    """Postings that some other class's may meet, once a shingle and class, settled; ``component`` is the class at first."""
    shared = documents.sparkSession.sparkContext.broadcast(rarity)
    postings = documents.filter("doc_id is not null").mapInArrow(_postings(shared, percent), "token long, salt int, cls long, doc long, n int, left int, l int")
    same = Window.partitionBy("token", "salt")
    wide = _reach(percent) >= F.col("n") * F.lit(percent)  # may meet sets of its own size or more; of two that meet the smaller one is so
    told = postings.repartition("token", "salt").select(
        "*", F.min("cls").over(same).alias("low"), F.max("cls").over(same).alias("high"), wide.alias("wide"),
        F.min(F.when(wide, F.col("n"))).over(same).alias("least"), F.max(F.when(wide, _reach(percent))).over(same).alias("most"),
    )
    partner = F.col("wide") | (F.col("least") * F.lit(percent) <= _reach(percent)) & (F.col("n") * F.lit(percent) <= F.col("most"))
    kept = told.filter((F.col("salt") > 0) | (F.col("low") != F.col("high")) & partner).dropDuplicates(["token", "salt", "cls"])
    return settle(kept.select("token", "salt", "cls", "doc", "n", "left", "l", F.col("cls").alias("component")), "open")


def _pivot_pairs(open_: DataFrame, k: int, percent: int) -> DataFrame:
    """For every class the pivot that it shares most buckets with (a, b, their documents and components).

    A bucket's pivot is the class with the fewest rarer shingles, so the one most like all others; after the first round
    that of the component with the least hash.
    """
    rank = F.struct((F.col("left") - F.col("n")).alias("rarer"), F.xxhash64("cls").alias("h"), F.col("cls")) if k == 0 else F.struct(F.xxhash64("component", F.lit(k)).alias("h"), F.col("component"), (F.col("left") - F.col("n")).alias("rarer"), F.col("cls"))
    pivots = open_.groupBy("token", "salt").agg(F.max(F.struct(rank.alias("rank"), *[F.col(c).alias(f"{c}_b") for c in ("cls", "doc", "component", "n", "left", "l")])).alias("p")).select("token", "salt", "p.*").drop("rank")
    met = open_.join(pivots, ["token", "salt"]).filter(F.col("component") != F.col("component_b")).filter(_meet(("n", "left", "l"), ("n_b", "left_b", "l_b"), percent))
    counted = met.groupBy("cls", "cls_b").agg(F.count("*").alias("shared"), F.min("doc").alias("da"), F.min("doc_b").alias("db"), F.min("component").alias("ca"), F.min("component_b").alias("cb"))
    best = counted.groupBy(F.col("cls").alias("a")).agg(F.max_by(F.struct(F.col("cls_b").alias("b"), "da", "db", "ca", "cb"), F.struct("shared", "cls_b")).alias("to"))
    return best.select("a", "to.*")


def _merged(links: DataFrame, k: int) -> DataFrame:
    """component, into: the component that each is merged into by the links of a round.

    Of the links of a component one is followed, and four in a row. What this leaves apart is only compared again later:
    the components of the result come from all links at the end.
    """
    to = settle(links.groupBy(F.col("ca").alias("component")).agg(F.max_by("cb", F.struct(F.xxhash64("cb", F.lit(k)), "cb")).alias("into")), "merged")
    for _ in range(2):
        to = to.join(to.select(F.col("component").alias("into"), F.col("into").alias("further")), "into", "left").select("component", F.coalesce("further", "into").alias("into"))
    return settle(to, "merged")


def _contested(open_: DataFrame, links: DataFrame, k: int) -> DataFrame:
    """Postings of the shingles whose classes are in more than one component, with the components of now."""
    into = _merged(links, k)
    labelled = settle(join_checked(open_, into, ["component"], how="left").withColumn("component", F.coalesce("into", "component")).drop("into"), "labelled")
    mixed = settle(labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("token"), "contested")
    out = settle(join_checked(labelled, mixed, ["token"]), "open")
    discard(open_, into, labelled, mixed)
    return out


def _candidates(open_: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that share l shingles early enough, and enough behind them.

    Components meet first, one row a shingle each, if their sizes allow it; only then are their classes paired, so classes
    of one component never are.
    """
    once = settle(open_.groupBy("token", "component").agg(F.min("n").alias("n"), F.max(_reach(percent)).alias("reach")), "component-shingles")
    side = lambda x: once.withColumnsRenamed({c: f"{c}_{x}" for c in ("component", "n", "reach")})
    met = side("a").join(side("b"), "token").filter("component_a < component_b").filter((F.col("reach_a") >= F.col("n_b") * F.lit(percent)) & (F.col("reach_b") >= F.col("n_a") * F.lit(percent))).select("token", "component_a", "component_b")
    for x in "ab":
        met = met.join(open_.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("component", "cls", "doc", "n", "left", "l")]), ["token", f"component_{x}"])
    near = met.filter(_meet(("n_a", "left_a", "l_a"), ("n_b", "left_b", "l_b"), percent))
    pairs = near.groupBy(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).agg(
        F.count("*").alias("shared"), F.min(F.least("l_a", "l_b")).alias("l"), F.min(F.least("left_a", "left_b")).alias("rest"), F.max(F.col("n_a") + F.col("n_b")).alias("both"),
        F.min("doc_a").alias("da"), F.min("doc_b").alias("db"), F.min("component_a").alias("ca"), F.min("component_b").alias("cb"),
    )
    return pairs.filter("shared >= l").filter((F.col("shared") + F.col("rest")) * (100 + percent) >= F.col("both") * percent).drop("shared", "l", "rest", "both")


def links_and_classes(documents: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Links between classes (a, b), enough of them to join all that link, and all rows with their class: doc_id, cls, n."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = int(documents.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0])
    cells = 1 << min(max((size // BYTES_PER_CELL).bit_length(), LEAST_CELLS), MOST_CELLS)
    told = settle(documents.mapInArrow(_describe(cells), "doc_id long, cls long, n int, block int, counts binary"), "sets-told")
    members = told.filter("block is null").select("doc_id", "cls", "n")

    open_ = _open_postings(documents, _rarity(told, cells), percent)
    links = None
    for k in range(ROUNDS):
        new = _verified(documents, _pivot_pairs(open_, k, percent), percent)
        links = new if links is None else links.unionByName(new)
        open_ = _contested(open_, new, k)
    links = links.unionByName(_verified(documents, _candidates(open_, percent), percent)).select("a", "b")
    discard(open_)
    return links, members


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    Null or empty texts have no shingles and are their own component; so are texts that link with none. Equal sets are one
    class, however many rows and ties there are. Rows with one doc_id are one document: what links one links the other. A
    row without a doc_id belongs to its class's component but links nothing and never names a component; alone it has a
    null one. Texts of any length are taken whole; only doc_id and text are read. An empty table gives an empty one.
    """
    links, members = links_and_classes(documents, percent)
    filled = members.filter("n > 0")
    several = settle(filled.filter("doc_id is not null").groupBy("doc_id").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low <> high").select("doc_id", "low"), "several-texts")
    own = join_checked(filled, several, ["doc_id"]).select(F.col("cls").alias("a"), F.col("low").alias("b"))
    found = components(links.unionByName(own))
    classes = filled.groupBy("cls").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    labelled = settle(classes.join(found.withColumnRenamed("node", "cls"), "cls", "left").filter("copies > 1 or component is not null").withColumn("component", F.coalesce("component", "cls")), "labelled")
    named = labelled.select("cls", "component").join(labelled.groupBy("component").agg(F.min("first").alias("component_id")), "component")
    rows = join_checked(members, settle(named.select("cls", "component_id"), "components"), ["cls"], how="left")
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("doc_id")).alias("component_id"))
