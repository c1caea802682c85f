"""Queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import place

    return place(_read(spark, sf_dir, "documents").select("doc_id"), "doc_id", [f"shard-{i:04d}" for i in range(512)]).select("doc_id", "slot", "shard")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import remove_repeats

    return remove_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_media_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import features, store_texts

    return features(store_texts(_read(spark, sf_dir, "documents")))


def op4_trie_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary file has no scores: pieces have those of Zipf and Mandelbrot's law over their rank."""
    import public_tokenizers

    from .token_counts import count_tokens

    return count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"))


def op6_radix_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    return remove_repeats(_read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score

    return score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(_read(spark, sf_dir, "pages"))


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import hits

    return hits(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import edited

    return edited(_read(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import manifest

    return manifest(_read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations

    return collocations(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_shard_lookup, op2_line_dedup, op3_media_sniff, op4_trie_tokens, op5_jaccard_join, op6_radix_suffix, op7_toxicity, op8_warc_salvage, op9_decontam, op10_pack, op11_fingerprint, op12_merkle, op13_collocations)
}

_OP5 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
keyed AS (SELECT doc_id, hash(s) AS h FROM shingles),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM keyed a JOIN keyed b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id
GROUP BY d.doc_id, s.n
"""

_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_CRC32 = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ord({0}[i])::BIGINT)), lambda crc, byte:
    list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"""
_OP12 = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_LEAF.format("text")} AS leaf,
               CASE WHEN xor({_CRC32.format("CAST(doc_id AS VARCHAR)")}, 4294967295) % 3 = 0
                    THEN {_LEAF.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
        FROM documents)),
trees AS (
  SELECT lang, 0 AS level, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM trees WHERE n > 1 GROUP BY lang, level, idx // 8, n),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM trees WHERE n = 1),
tops AS (
  SELECT 0 AS level, idx, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 8, n),
runs AS (
  SELECT '=' || coalesce('=' || lang, '') AS tree, level, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM trees WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT 'top', level, idx // 8, list(h ORDER BY idx) FROM tops WHERE n > 1 GROUP BY ALL),
links AS (SELECT t.lang, t.level AS last, s.idx, s.subroot FROM trees t JOIN subroots s ON t.n = 1 AND t.lang IS NOT DISTINCT FROM s.lang),
climb AS (
  SELECT l.doc_id, l.leaf, k.subroot, CASE WHEN k.last = 0 THEN 'top' ELSE '=' || coalesce('=' || l.lang, '') END AS tree, k.last, k.idx AS place, 0 AS level,
         CASE WHEN k.last = 0 THEN k.idx ELSE l.idx END AS idx, coalesce(l.tampered, l.leaf) AS folded, '' AS proof, l.idx AS leaf_idx, l.lang
  FROM leaves l JOIN links k ON k.lang IS NOT DISTINCT FROM l.lang
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, CASE WHEN c.tree <> 'top' AND c.level + 1 = c.last THEN 'top' ELSE c.tree END, c.last, c.place,
         CASE WHEN c.tree <> 'top' AND c.level + 1 = c.last THEN 0 ELSE c.level + 1 END, CASE WHEN c.tree <> 'top' AND c.level + 1 = c.last THEN c.place ELSE c.idx // 8 END,
         sha256(array_to_string(r.hs[: c.idx % 8], '') || c.folded || array_to_string(r.hs[c.idx % 8 + 2 :], '')),
         c.proof || array_to_string(r.hs[: c.idx % 8], '') || array_to_string(r.hs[c.idx % 8 + 2 :], ''), c.leaf_idx, c.lang
  FROM climb c JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.idx // 8),
root AS (SELECT h AS root FROM tops WHERE n = 1),
done AS (SELECT *, row_number() OVER (PARTITION BY lang, leaf_idx ORDER BY length(proof) DESC, tree = 'top' DESC, level DESC) AS last_step FROM climb)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM done, root WHERE last_step = 1
"""

_OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS ws FROM words, range(1, 6) AS x(k) WHERE len(w) >= k),
freq AS (SELECT lang, k, ws, count(*)::HUGEINT AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::HUGEINT AS n FROM freq WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM freq WHERE a >= 100),
cuts AS (
  SELECT o.lang, o.ws, o.a, t.n, l.a AS l, r.a AS r, l.k AS cut, (1000 * o.a * t.n) // (l.a * r.a) AS score
  FROM often o JOIN totals t ON t.lang = o.lang
  JOIN often l ON l.lang = o.lang AND l.k < o.k AND l.ws = o.ws[: l.k]
  JOIN often r ON r.lang = o.lang AND r.k = o.k - l.k AND r.ws = o.ws[l.k + 1 :]
  WHERE o.k >= 2),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT DISTINCT o.lang, o.ws[i.i : i.i + j.j - 1] AS ws, o.a FROM often o, range(1, 5) AS i(i), range(2, 5) AS j(j) WHERE j.j < o.k AND i.i + j.j - 1 <= o.k),
kept AS (SELECT b.* FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_parts p WHERE p.lang = b.lang AND p.ws = b.ws AND 100 * p.a >= 100 * b.a)),
ranked AS (SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, n, score FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {"op5_jaccard_join": _OP5, "op12_merkle": _OP12, "op13_collocations": _OP13}
