"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    alignment, exact, imatch, langid, license, lm, merkle, minhash, mixing, pieces, simhash, substrings, toxicity,
)
from tidemark.llm.common import Query, remainder, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


@query(
    "op10_exact_dedup",
    r"""WITH t AS (SELECT doc_id,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
      FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
      doc_id = min(doc_id) OVER w AS kept, text_sha256
    FROM t WINDOW w AS (PARTITION BY text_sha256)""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


# Water filling in closed form: sources in order of limit / weight are full as long as
# the rest, shared by weight, would put them above their limit.
@query(
    "op5_source_mixing",
    r"""WITH docs AS (SELECT doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        substring(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS h FROM documents),
    per AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
    ranked AS (SELECT source, source_size, 2 * source_size AS lim,
        [3, 1, 2][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight
      FROM per),
    placed AS (SELECT *, row_number() OVER (ORDER BY lim / weight, weight) AS place FROM ranked),
    filled AS (SELECT *, 1.5 * (sum(lim) OVER ()) / 2
          - coalesce(sum(lim) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (ORDER BY place DESC) AS open_weight
      FROM placed),
    opened AS (SELECT min(place) AS first_open, min_by(rest, place)::DOUBLE AS rest,
        min_by(open_weight, place) AS open_weight
      FROM filled WHERE rest * weight <= lim * open_weight),
    targets AS (SELECT source, source_size, CASE WHEN place < first_open THEN lim::DOUBLE
          ELSE o.rest * weight / o.open_weight END AS target
      FROM placed, opened o),
    quotas AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM targets),
    summed AS (SELECT d.*, q.source_size, q.target,
        CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS whole,
        CASE WHEN source_size > 0 THEN quota % source_size ELSE 0 END AS need,
        sum(size) OVER (PARTITION BY d.source ORDER BY h) AS up_to,
        sum(size) OVER (PARTITION BY d.source, h) AS tied
      FROM docs d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source)
    SELECT doc_id, size, source_size, target,
      (size * (whole + CASE WHEN 2 * up_to - tied < 2 * need THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM summed""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


@query("op2_imatch_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op1_substring_dedup",
    r"""WITH listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
      FROM documents),
    words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM listed),
    windows AS (SELECT *, CASE WHEN count(*) OVER f = 20 THEN string_agg(word, ' ') OVER f END AS win
      FROM words
      WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
    judged AS (SELECT *,
        win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS later
      FROM windows),
    covered AS (SELECT *, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM judged),
    kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
        string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS rest
      FROM covered GROUP BY doc_id)
    SELECT l.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
      sha256(coalesce(rest, '')) AS kept_sha256
    FROM listed l LEFT JOIN kept k ON l.doc_id = k.doc_id""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents"))


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


@query("op7_lm_scores")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


# crc32 bit by bit: a byte enters with the first of its eight shifts. Steps of a proof are
# the side of the sibling and its digest; a node without one is hashed alone.
@query(
    "op12_merkle_manifest",
    r"""WITH RECURSIVE crc AS (SELECT *, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
        flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1)))) AS crc FROM documents),
    parts AS (SELECT *, n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END AS claimed FROM crc),
    leaves AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree,
        sha256(concat(
          coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
          coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
          coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
        sha256(concat(
          coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
          coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(claimed::VARCHAR) || ':' || claimed, '-'),
          coalesce(strlen(text) || ':' || text, '-'))) AS claim
      FROM parts),
    placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS p
      FROM leaves),
    levels AS (
      SELECT tree, 0 AS level, list(leaf ORDER BY p) AS nodes FROM placed GROUP BY tree
      UNION ALL
      SELECT tree, level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
          lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
      FROM levels WHERE len(nodes) > 1),
    subroots AS (SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS q
      FROM levels WHERE len(nodes) = 1),
    tops AS (
      SELECT 0 AS level, list(subroot ORDER BY q) AS nodes FROM subroots HAVING count(*) > 0
      UNION ALL
      SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
          lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
      FROM tops WHERE len(nodes) > 1),
    steps AS (
      SELECT tree, p, level AS nth, CASE WHEN (p >> level) % 2 = 1 THEN 'L' || nodes[p >> level]
          ELSE 'R' || coalesce(nodes[(p >> level) + 2], '') END AS step
      FROM placed JOIN levels USING (tree) WHERE len(nodes) > 1
      UNION ALL
      SELECT tree, p, 1000 + level, CASE WHEN (q >> level) % 2 = 1 THEN 'L' || nodes[q >> level]
          ELSE 'R' || coalesce(nodes[(q >> level) + 2], '') END
      FROM placed JOIN subroots USING (tree), tops WHERE len(nodes) > 1),
    proofs AS (SELECT tree, p, list(step ORDER BY nth) AS steps,
        string_agg(substring(step, 2), '' ORDER BY nth) AS siblings FROM steps GROUP BY tree, p),
    folded AS (SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
        sha256(coalesce(siblings, '')) AS proof_sha256,
        list_reduce(list_prepend(claim, coalesce(steps, [])), lambda a, s: sha256(
          CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
      FROM placed JOIN subroots USING (tree) LEFT JOIN proofs USING (tree, p))
    SELECT *, folded_root = root AS verified FROM folded""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = merkle.leaf_digest(*[F.col(name) for name in fields])
    altered = merkle.leaf_digest(*[F.col(name) + 1 if name == "n_chars" else F.col(name) for name in fields])
    claim = F.when(remainder("doc_id", 7) == 0, altered).otherwise(leaf)
    return merkle.checked(merkle.manifest(docs, leaf, claim=claim)).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


# Linked pairs from the inverted shingles; the component is a walk over links from each text.
@query(
    "op13_minhash_near_dedup",
    r"""WITH RECURSIVE listed AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws FROM documents),
    sets AS (SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 2),
          lambda i: array_to_string(ws[i : i + 3], ' ')))) END AS s FROM listed),
    texts AS (SELECT row_number() OVER () AS t, s, len(s) AS n, min(doc_id) AS least FROM sets
      WHERE len(s) > 0 GROUP BY s),
    inverted AS (SELECT t, n, unnest(s) AS shingle FROM texts),
    links AS (SELECT a.t AS u, b.t AS v FROM inverted a JOIN inverted b ON a.shingle = b.shingle AND a.t <> b.t
      GROUP BY a.t, b.t, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    walk AS (SELECT t AS u, t AS v FROM texts UNION SELECT w.u, l.v FROM walk w JOIN links l ON w.v = l.u),
    found AS (SELECT u, min(least) AS component_id FROM walk JOIN texts ON v = t GROUP BY u)
    SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, CASE WHEN len(sets.s) = 0 THEN doc_id ELSE component_id END AS component_id,
      CASE WHEN len(sets.s) = 0 THEN doc_id ELSE component_id END IS NOT DISTINCT FROM doc_id AS kept
    FROM sets LEFT JOIN texts ON sets.s = texts.s LEFT JOIN found ON t = u""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"))


@query("op11_cross_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))
