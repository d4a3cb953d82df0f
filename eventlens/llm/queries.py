"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm.chat_format import digest, fold_events, render
from eventlens.llm.collocations import collocations
from eventlens.llm.common import table
from eventlens.llm.exact_dedup import exact_duplicates
from eventlens.llm.language_id import languages
from eventlens.llm.license_scan import scan_licenses
from eventlens.llm.merkle import verification
from eventlens.llm.mixing import mix_sources
from eventlens.llm.near_dedup import near_duplicates
from eventlens.llm.packing import pack_documents
from eventlens.llm.quality_classifier import quality
from eventlens.llm.quality_rules import repetition_report
from eventlens.llm.substring_dedup import remove_repeats
from eventlens.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}
LLM_CHECKS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its function."""

    def register(fn: Query) -> Query:
        LLM_QUERIES[fn.__name__] = fn
        if sql is not None:
            LLM_CHECKS[fn.__name__] = sql
        return fn

    return register


OP6_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query(OP6_SQL)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates among all documents."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


_LENGTHS = range(5, 11)
_SPACE = "[\\x20\\x09-\\x0D]"


def _covered(n: int) -> str:
    """Characters and words of each document inside windows of n words that occur twice or more."""
    return f"""
windows{n} AS (
  SELECT doc_id, i, word, passage IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, passage) > 1 AS again
  FROM (SELECT doc_id, i, word, {" || ' ' || ".join(["word", *(f"w{k}" for k in range(1, n))])} AS passage FROM places)
), covered{n} AS (
  SELECT doc_id, coalesce(sum(length(word)) FILTER (inside), 0) AS chars, count(*) FILTER (inside) AS words
  FROM (SELECT doc_id, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside
        FROM windows{n}) GROUP BY doc_id
)"""


OP7_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), places AS (
  SELECT *, {", ".join(f"lead(word, {k}) OVER doc AS w{k}" for k in range(1, 10))}
  FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs)
  WINDOW doc AS (PARTITION BY doc_id ORDER BY i)
), {", ".join(map(_covered, _LENGTHS))}, lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS nth
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)
), again AS (
  SELECT doc_id, count(*) AS n, CAST(sum(length(regexp_replace(line, '{_SPACE}', '', 'g'))) AS BIGINT) AS chars
  FROM lines WHERE nth > 1 AND regexp_replace(line, '{_SPACE}', '', 'g') <> '' GROUP BY doc_id
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(again.n, 0) AS n_dup_lines,
    coalesce(covered8.words, 0) AS n_repeat_words, coalesce(again.chars, 0) AS dup_line_chars,
    {", ".join(f"CAST(coalesce(covered{n}.chars, 0) AS BIGINT) AS dup_chars_{n}" for n in _LENGTHS)}
  FROM docs LEFT JOIN again USING (doc_id) {" ".join(f"LEFT JOIN covered{n} USING (doc_id)" for n in _LENGTHS)}
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND dup_line_chars <= 0.20::DOUBLE * word_chars
    AND {" AND ".join(f"dup_chars_{n} <= {(20 - n) / 100:.2f}::DOUBLE * word_chars" for n in _LENGTHS)} AS kept
FROM measured
"""


@query(OP7_SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdict of all documents."""
    return repetition_report(table(spark, sf_dir, "documents"))


_ESCAPED = "replace(replace(replace(coalesce({0}, ''), '\\', '\\s'), '<s>', '\\ls>'), '</s>', '\\l/s>')"

OP8_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t.turn, t.role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(8 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) AS BIGINT)
         AS formatted_chars
FROM turns
GROUP BY conv_id
"""


@query(OP8_SQL)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds control strings, rendered and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("seq"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, seq long, role string, text string"
    )
    return digest(render(fold_events(rows.unionByName(extra))))


@query()
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and detections of all documents."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents tokenised and packed into sequences of 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))


@query()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    return mix_sources(table(spark, sf_dir, "documents")).drop("tag")


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels that are not held out."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels that are not held out."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS r, doc_id, {_WORDS.format(_LOWERED)} AS w FROM documents
), shingles AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM docs
), sizes AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), common AS (
  SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.r < y.r GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT r, r AS other FROM docs
  UNION
  SELECT reached.r, edges.b FROM reached JOIN edges ON edges.a = reached.other
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id, d.doc_id = min(o.doc_id) AS kept
FROM docs d JOIN reached ON reached.r = d.r JOIN docs o ON o.r = reached.other LEFT JOIN sizes ON sizes.r = d.r
GROUP BY d.r, d.doc_id
"""


@query(OP9_SQL)
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def _passages(n: int) -> str:
    """The passages of n words that start at each word of ``w``; NULL where there are fewer."""
    return f"list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i + {n - 1} <= len(w) THEN array_to_string(w[i : i + {n - 1}], ' ') END)"


OP3_SQL = f"""
WITH docs AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), places AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, unnest({_passages(50)}) AS passage FROM docs
), firsts AS (
  SELECT passage, min(doc_id) AS first FROM places WHERE passage IS NOT NULL GROUP BY passage
), starts AS (
  SELECT p.doc_id, p.i, p.word, coalesce(f.first < p.doc_id, false) AS repeated
  FROM places p LEFT JOIN firsts f ON f.passage = p.passage
), covered AS (
  SELECT doc_id, i, word, bool_or(repeated) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM starts
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
  FROM covered GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


@query(OP3_SQL)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that smaller documents have too."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def _sized(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    fields = " || ".join(_sized(c) for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({fields})"


# The CRC-32 of a number's digits, bit by bit; only its lowest bit is needed.
_CRC_BITS = "list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)"
_DIGITS = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS UBIGINT))"
_CRC = f"xor(list_reduce(list_concat([4294967295::UBIGINT], {_DIGITS}), lambda crc, b: {_CRC_BITS}), 4294967295::UBIGINT)"

OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce(source, '') AS name, source IS NOT NULL AS named, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS tampered
  FROM documents
), ordered AS (
  SELECT *, dense_rank() OVER (ORDER BY named, name) - 1 AS tree,
         row_number() OVER (PARTITION BY named, name ORDER BY doc_id, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY named, name) AS n
  FROM leaves
), placed AS (
  SELECT *, row_number() OVER (ORDER BY tree, place) AS id FROM ordered
), nodes AS (
  SELECT tree, 0 AS level, place, n, leaf AS node FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY tree, level, n, place // 3
), trunk AS (
  SELECT 0 AS level, tree AS place, count(*) OVER () AS n, node FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY place))
  FROM trunk WHERE n > 1 GROUP BY level, n, place // 3
), every AS (
  SELECT tree, level, place, n, node FROM nodes
  UNION ALL
  SELECT -1, level, place, n, node FROM trunk
), steps AS (
  SELECT a.tree, a.level, a.place,
         coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
         coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
  FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.place // 3 = b.place // 3
  WHERE a.n > 1 GROUP BY ALL
), walk AS (
  SELECT id, tree AS own, tree, 0 AS level, place, '' AS proof, tampered AS node FROM placed
  UNION ALL
  SELECT w.id, w.own, CASE WHEN s.tree IS NULL THEN -1 ELSE w.tree END,
         CASE WHEN s.tree IS NULL THEN 0 ELSE w.level + 1 END,
         CASE WHEN s.tree IS NULL THEN w.own ELSE w.place // 3 END,
         w.proof || coalesce(s.before || s.after, ''),
         CASE WHEN s.tree IS NULL THEN w.node ELSE sha256(s.before || w.node || s.after) END
  FROM walk w LEFT JOIN steps s ON w.tree = s.tree AND w.level = s.level AND w.place = s.place
  WHERE w.tree >= 0 OR s.tree IS NOT NULL
), ends AS (
  SELECT id, arg_max(proof, level) AS proof, arg_max(node, level) AS node FROM walk WHERE tree = -1 GROUP BY id
)
SELECT p.doc_id, p.leaf, sub.node AS subroot, top.node AS root, sha256(e.proof) AS proof_sha256,
       e.node AS folded_root, e.node = top.node AS verified
FROM placed p
JOIN ends e USING (id)
JOIN (SELECT tree, node FROM nodes WHERE n = 1) sub USING (tree)
CROSS JOIN (SELECT node FROM trunk WHERE n = 1) top
"""


@query(OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, checked against tampered leaves."""
    return verification(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP12_SQL = f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                            '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents)
), grams AS (
  SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM pieces CROSS JOIN (SELECT unnest(range(1, 6)) AS size))
  GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS words FROM grams WHERE size > 1 AND f >= 100
), kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates d
    WHERE d.lang = c.lang AND d.size > c.size AND 100 * d.a >= 100 * c.a
      AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, n,
         (1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept) c
  JOIN grams l ON l.lang = c.lang AND l.size = k AND l.phrase = array_to_string(c.words[1 : k], ' ')
  JOIN grams r ON r.lang = c.lang AND r.size = c.size - k AND r.phrase = array_to_string(c.words[k + 1 :], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best
QUALIFY rank <= 2000
"""


@query(OP12_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language in all documents."""
    return collocations(table(spark, sf_dir, "documents"))


@query()
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those that are not held out."""
    return languages(table(spark, sf_dir, "documents"))
