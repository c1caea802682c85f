"""Merkle manifest of a table: a tree of digests for each language, a tree over their roots, and proofs by a recursive query.

Every row is a leaf: the sha256 of its doc_id, source, lang, n_chars and text, each as ``-`` where null, else as byte count,
``:`` and value. Leaves of one language ascend by doc_id (null ones first; rows that share one by leaf digest); every eight
consecutive nodes become the sha256 of their digests' hex text until one is left, the subroot (of a lone leaf: itself).
Subroots in order of lang (null first, by bytes) give the root in the same way.

The levels are stored as run rows: up to eight siblings, and the run and place where their parent stands. A recursive query
climbs these links, appends the siblings of each level and folds the hash that it started with. The two lowest levels are
blocks of 64 leaves, folded where they are; all links above a block are common to its leaves, so one row climbs for the 64 of
them, with a hash for each.

Runs above the blocks are one for some 450 leaves. As long as they fit a broadcast, as measured, a level shuffles climbing rows
only once, when Spark deals out what a step of a recursion gives; beyond that both sides of the join are shuffled too. Runs near a root are then met by all rows beneath them; such a run is
there once for some 64 of these rows, so that no key of a join is hot, whatever the size of a language. Ranks come from a range
partitioning and the counts of its partitions, never from one ordered task.

Nulls in any column have their mark; null and empty texts differ. Texts of any length are hashed whole. Rows that are equal
in all five columns are leaves of their own beside each other, with one proof each. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fits_broadcast, join_checked, settle

#: Children of a node.
FAN = 8
#: Leaves of a block: the runs of the two lowest levels that one row climbs for, and the level of its own run.
BLOCK, BLOCK_LEVEL = FAN * FAN, 2
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Rows of a climb that meet one copy of a run, about.
ROWS_A_COPY = 64
#: The tree of subroots; those of languages are "-" (null) or "=" and the language, which sorts as asked for.
TOP = ""


def digest_text(*inputs: Column) -> Column:
    """Lower-case hex sha256 of texts one after another."""
    return F.sha2(F.concat(*inputs), 256)


def leaf(changed: dict[str, Column] | None = None) -> Column:
    """Digest of a row, hex text; ``changed`` replaces columns."""
    values = [(changed or {}).get(c, F.col(c)).cast("string") for c in FIELDS]
    return digest_text(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def tampered() -> Column:
    """Whether a row counts as tampered with: 3 divides the crc32 of its decimal doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def lowered() -> Column:
    return F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _raw(hex_text: Column) -> Column:
    return F.unhex(hex_text)


def _folded(children: Column) -> Column:
    """Digest of a run: sha256 of the hex text of its children's digests."""
    return _raw(F.sha2(F.lower(F.hex(children)).cast("binary"), 256))


def _ranked(rows: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``rows`` with place and number of rows in their tree: by range partitions and the counts of these."""
    ranges = rows.repartitionByRange("tree", *by).sortWithinPartitions("tree", *by).withColumn("_at", F.monotonically_increasing_id())
    ranges = settle(ranges, f"{name}-ranges").withColumn("_part", F.shiftright("_at", 33))
    parts = ranges.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # a row for each partition and language that meet: as many as partitions and languages together
    sums = "SUM(_rows) OVER (PARTITION BY tree ORDER BY _part) - _rows AS _before", "SUM(_rows) OVER (PARTITION BY tree) AS n"
    parts = settle(parts.selectExpr("tree", "_part", "_first", *sums), f"{name}-parts")
    return join_checked(ranges, parts, ["tree", "_part"]).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def _runs(nodes: DataFrame, level: int, name: str, extra: list[str] = []) -> DataFrame:  # noqa: B006
    """Every eight nodes (tree, idx, n, digest) as a run with their parent's digest; n becomes the number of parents of the tree."""
    members = F.sort_array(F.collect_list(F.struct((F.col("idx") % FAN).alias("pos"), "digest", *extra)))
    runs = nodes.groupBy("tree", F.expr(f"idx DIV {FAN}").alias("idx"), F.ceil(F.col("n") / FAN).alias("n"), (F.col("n") == 1).alias("alone")).agg(members.alias("members"))
    runs = runs.withColumn("level", F.lit(level)).withColumn("children", _joined_digests(F.col("members.digest")))
    runs = runs.withColumn("digest", F.when(F.col("alone"), F.col("children")).otherwise(_folded(F.col("children"))))
    return settle(runs if extra else runs.drop("members"), f"{name}-level{level}")


def _around(run: Column, pos: Column) -> tuple[Column, Column]:
    """Siblings of the digest at ``pos`` of a run: those before it, those behind it."""
    return F.substring(run, F.lit(1), (32 * pos).cast("int")), F.substring(run, (32 * pos + 33).cast("int"), F.octet_length(run))


def _run_of(leaves: Column, pos: Column) -> Column:
    """The bottom run of the leaf at ``pos`` of a block."""
    return F.substring(leaves, (32 * FAN * F.floor(pos / FAN) + 1).cast("int"), F.lit(32 * FAN))


def _refolded(alone: Column, run: Column, pos: Column, own: Column) -> Column:
    """Digest of a run whose member at ``pos`` is ``own``; a node alone in its tree is passed on."""
    left, right = _around(run, pos)
    return F.when(alone, own).otherwise(_folded(F.concat(left, own, right)))


def _joined_digests(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda a, x: F.concat(a, x))


def _blocks(ranked: DataFrame, name: str) -> DataFrame:
    """Every 64 leaves as a run of level 2: their ids, digests (one after another) and starts of a fold, the digests of their bottom runs (``children``) and its own."""
    members = F.sort_array(F.collect_list(F.struct((F.col("idx") % BLOCK).alias("pos"), "digest", "doc_id", "other")))
    rows = ranked.groupBy("tree", F.expr(f"idx DIV {BLOCK}").alias("idx"), "n").agg(members.alias("members"))
    rows = rows.select("tree", "idx", F.ceil(F.col("n") / BLOCK).alias("n"), (F.col("n") == 1).alias("lone_leaf"), (F.col("n") <= FAN).alias("alone"),
                       F.col("members.doc_id").alias("ids"), _joined_digests(F.col("members.digest")).alias("leaves"), F.col("members.other").alias("others"))
    firsts = F.sequence(F.lit(0), F.size("ids") - 1, F.lit(FAN))
    digests = F.transform(firsts, lambda first: F.when(F.col("lone_leaf"), F.col("leaves")).otherwise(_folded(_run_of(F.col("leaves"), first))))
    rows = rows.withColumn("level", F.lit(BLOCK_LEVEL)).withColumn("children", _joined_digests(digests))
    return settle(rows.withColumn("digest", F.when(F.col("alone"), F.col("children")).otherwise(_folded(F.col("children")))), f"{name}-blocks")


def _levels(bottom: DataFrame, level: int, name: str) -> list[DataFrame]:
    """Runs level by level, from those of ``level`` on, until each tree has one parent."""
    out = [bottom]
    while not (rest := out[-1].filter("n > 1")).isEmpty():
        out.append(_runs(rest.select("tree", "idx", "n", "digest"), level + len(out), name))
    return out


def _together(levels: list[DataFrame]) -> DataFrame:
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out


def _linked(runs: DataFrame, subroots: DataFrame | None, copies: Column) -> DataFrame:
    """Runs with the run above in which their parent stands (null at the root), the place there, and how many copies that has."""
    up = F.col("n") > 1
    own = runs.withColumn("up_tree", F.when(up, F.col("tree"))).withColumn("up_level", F.when(up, F.col("level") + 1)).withColumn("up_idx", F.when(up, F.expr(f"idx DIV {FAN}"))).withColumn("up_pos", F.when(up, F.col("idx") % FAN))
    own = own.withColumn("up_copies", F.when(up, copies))
    if subroots is None:
        return own
    rest = own.filter("n = 1").drop("up_tree", "up_level", "up_idx", "up_pos", "up_copies")
    return own.filter("n > 1").unionByName(join_checked(rest, subroots, ["tree"]))


def _climb(anchor: DataFrame, runs: DataFrame, small: bool) -> DataFrame:
    """Rows (tree, idx) with the folded hashes and siblings that a recursive query has gathered on the way to the root; ``small`` runs are broadcast, others there in copies.

    Spark bounds the rows of recursive queries by a setting, which is lifted while this one is written.
    """
    spark, tag = anchor.sparkSession, uuid.uuid4().hex
    anchor.createOrReplaceTempView(f"anchor_{tag}")
    runs.createOrReplaceTempView(f"runs_{tag}")
    hint, copy = ("/*+ BROADCAST(r) */", "") if small else ("", "AND pmod(c.own, c.up_copies) = r.copy")
    before, after = "substring(r.children, 1, 32 * c.up_pos)", "substring(r.children, 32 * c.up_pos + 33)"
    query = f"""
        WITH RECURSIVE climb(tree, idx, own, up_tree, up_level, up_idx, up_pos, up_copies, folded, proof) AS (
          SELECT tree, idx, own, up_tree, up_level, up_idx, up_pos, up_copies, folded, proof FROM anchor_{tag}
          UNION ALL
          SELECT {hint} c.tree, c.idx, c.own, r.up_tree, r.up_level, r.up_idx, r.up_pos, r.up_copies,
                 transform(c.folded, f -> unhex(sha2(cast(lower(hex(concat({before}, f, {after}))) AS binary), 256))), concat(c.proof, {before}, {after})
          FROM climb c JOIN runs_{tag} r
            ON c.up_tree = r.tree AND c.up_level = r.level AND c.up_idx = r.idx {copy})
        SELECT tree, idx, folded, proof FROM climb WHERE up_tree IS NULL"""
    limit = "spark.sql.cteRecursionRowLimit"
    was = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")
        return settle(spark.sql(query), "merkle-climb")
    finally:
        spark.conf.set(limit, was)
        spark.catalog.dropTempView(f"anchor_{tag}")
        spark.catalog.dropTempView(f"runs_{tag}")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, and what tampering leaves of them: folded_root, verified. See the module's text."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("tree")
    leaves = settle(docs.select(tree, "doc_id", _raw(leaf()).alias("digest"), F.when(tampered(), _raw(leaf({"text": lowered()}))).alias("other")), "merkle-leaves")
    ranked = _ranked(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest")], "merkle")
    blocks = _blocks(ranked, "merkle")
    trees = _levels(blocks, BLOCK_LEVEL, "merkle")
    subroots = settle(_together([x.filter("n = 1").select("tree", "digest") for x in trees]), "merkle-subroots")
    tops = _levels(_runs(_ranked(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest"), [F.col("of")], "merkle-top"), 1, "merkle-top", ["of"]), 1, "merkle-top")
    root = tops[-1].first()

    # a run of level k has 8 ** (k - 2) blocks beneath it
    copies_of = lambda level: F.expr(f"CAST(greatest(1, pow({FAN}, {level} - {BLOCK_LEVEL}) / {ROWS_A_COPY}) AS bigint)")
    of_top, of_tree = F.lit(max(1, blocks.count() // ROWS_A_COPY)).cast("bigint"), copies_of("level + 1")
    place = tops[0].select(F.col("idx").alias("up_idx"), F.explode("members").alias("m")).select(
        F.col("m.of").alias("tree"), F.lit(TOP).alias("up_tree"), F.lit(1).alias("up_level"), "up_idx", F.col("m.pos").alias("up_pos"), of_top.alias("up_copies"))
    if root is not None and root["alone"]:  # one language: its subroot is the root
        place = place.select("tree", *[F.lit(None).cast(t).alias(c) for c, t in place.dtypes[1:]])
    place = settle(place, "merkle-places")
    columns = ["tree", "level", "idx", "children", "up_tree", "up_level", "up_idx", "up_pos", "up_copies"]
    runs = _linked(_together([x.drop("members") for x in tops]), None, of_top).select(*columns, of_top.alias("copies"))
    if trees[1:]:
        runs = runs.unionByName(_linked(_together(trees[1:]), place, of_tree).select(*columns, copies_of("level").alias("copies")))
    runs = settle(runs, "merkle-runs")
    small = fits_broadcast(runs)
    if not small:
        runs = settle(runs.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)"))), "merkle-copies")

    leaf_at = lambda pos: F.substring(F.col("leaves"), (32 * pos + 1).cast("int"), F.lit(32))

    def fold(other: Column, pos: Column) -> Column:
        run = _refolded(F.col("lone_leaf"), _run_of(F.col("leaves"), pos), pos % FAN, F.coalesce(other, leaf_at(pos)))
        return _refolded(F.col("alone"), F.col("children"), F.floor(pos / FAN), run)

    anchor = _linked(blocks, place, of_tree).select(
        "tree", "idx", F.xxhash64("tree", "idx").alias("own"), "up_tree", "up_level", "up_idx", "up_pos", "up_copies", F.transform("others", fold).alias("folded"), F.lit(b"").alias("proof"))
    climbed = _climb(anchor, runs, small)

    rows = climbed.join(blocks.select("tree", "idx", "ids", "leaves", "children"), ["tree", "idx"])
    rows = join_checked(rows, subroots.withColumnRenamed("digest", "subroot"), ["tree"])
    rows = rows.select("subroot", "proof", "leaves", "children", F.posexplode(F.arrays_zip("ids", "folded")).alias("pos", "m"))
    pos = F.col("pos")
    siblings = F.concat(*_around(_run_of(F.col("leaves"), pos), pos % FAN), *_around(F.col("children"), F.floor(pos / FAN)), F.col("proof"))
    text = lambda x: F.lower(F.hex(x))
    top = F.lit(bytes(root["digest"]).hex() if root is not None else "")
    out = settle(rows.select(F.col("m.ids").alias("doc_id"), text(leaf_at(pos)).alias("leaf"), text(F.col("subroot")).alias("subroot"), top.alias("root"),
                             F.sha2(text(siblings).cast("binary"), 256).alias("proof_sha256"), text(F.col("m.folded")).alias("folded_root")), "merkle-proofs")
    discard(leaves, climbed, runs, blocks)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
