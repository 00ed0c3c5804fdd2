"""One registered query for each operator, with its SQL twin where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORD = r"[^\x20\x09-\x0D]+"
FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def documents(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/documents.parquet")


@query("op1_sharding")
def op1(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.sharding import shard_documents

    return shard_documents(documents(spark, root))


@query("op2_secret_scan")
def op2(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.secretscan import labelled_by_form, scan

    return scan(documents(spark, root), labelled_by_form)


@query("op3_binary_records")
def op3(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.records import record_digests

    return record_digests(documents(spark, root))


@query("op4_token_counts")
def op4(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.viterbi import token_counts

    return token_counts(documents(spark, root))


JACCARD_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all({FOLD.format("text")}, '{WORD}'), []) AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), reached AS (
  SELECT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""


@query("op5_ngram_jaccard_join", JACCARD_SQL)
def op5(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.jaccard import jaccard_components

    return jaccard_components(documents(spark, root))


LINES_SQL = rf"""
WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
lines AS MATERIALIZED (
  SELECT doc_id, i - 1 AS line, regexp_extract_all({FOLD.format("l[i]")}, '{WORD}') AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM cut)
), keyed AS MATERIALIZED (SELECT *, len(w) AS n, array_to_string(w, ' ') AS s FROM lines WHERE len(w) >= 5),
first AS MATERIALIZED (
  SELECT s, any_value(w) AS w, any_value(n) AS n, min((doc_id, line)) AS here FROM keyed GROUP BY s
), variants AS MATERIALIZED (
  SELECT here, i AS place, array_to_string(list_concat(w[1 : i - 1], w[i + 1 : n]), ' ') AS v
  FROM (SELECT here, w, n, unnest(range(1, n + 1)) AS i FROM first WHERE n >= 10)
  UNION ALL SELECT here, 0, s FROM first WHERE n >= 10
), met AS MATERIALIZED (SELECT v FROM variants GROUP BY v HAVING count(DISTINCT here) > 1),
held AS MATERIALIZED (SELECT * FROM variants SEMI JOIN met USING (v)),
pairs AS (
  SELECT b.here AS here, a.here AS kept FROM held a JOIN held b USING (v)
  WHERE a.here < b.here AND (a.place = b.place OR (a.place = 0) <> (b.place = 0))
), near AS (SELECT here, min(kept) AS kept FROM pairs GROUP BY here),
gone AS (
  SELECT k.doc_id, k.line, k.n, (k.doc_id, k.line) = f.here AS near
  FROM keyed k JOIN first f USING (s) LEFT JOIN near p ON p.here = f.here
  WHERE (k.doc_id, k.line) > coalesce(p.kept, f.here)
), dropped AS (
  SELECT doc_id, list(line) AS gone, count(*) FILTER (NOT near) AS n_equal, count(*) FILTER (near) AS n_near
  FROM gone GROUP BY doc_id
)
SELECT d.doc_id,
  coalesce(len(list_filter(string_split(d.text, chr(10)), lambda x: regexp_matches(x, '{WORD}'))), 0) AS n_lines,
  coalesce(g.n_equal, 0) AS n_equal, coalesce(g.n_near, 0) AS n_near,
  md5(CASE WHEN g.gone IS NULL THEN d.text ELSE array_to_string(
    list_transform(list_filter(range(1, len(c.l) + 1), lambda i: NOT list_contains(g.gone, i - 1)), lambda i: c.l[i]), chr(10)) END) AS text_md5
FROM documents d LEFT JOIN cut c USING (doc_id) LEFT JOIN dropped g USING (doc_id)
"""


@query("op6_language_id")
def op6(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.langid import identify

    return identify(documents(spark, root))


@query("op7_benchmark_decontamination")
def op7(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.tiling import contaminated_documents

    return contaminated_documents(documents(spark, root), spark.read.parquet(f"{root}/benchmark.parquet"))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.bestfit import pack_documents

    return pack_documents(documents(spark, root))


@query("op9_line_dedup", LINES_SQL)
def op9(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.linededup import line_dedup

    return line_dedup(documents(spark, root).select("doc_id", "text")).select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_equal").alias("n_equal"),
        F.col("_near").alias("n_near"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
    )


QUALITY_SQL = rf"""
WITH base AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS host, text, coalesce(regexp_extract_all(text, '{WORD}'), []) AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8)
), again AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM windows) WHERE c > 1
  ) GROUP BY doc_id
), cut AS MATERIALIZED (
  SELECT doc_id, host, text, l FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS l FROM base)
  WHERE regexp_matches(l, '{WORD}')
), doubles AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM cut GROUP BY doc_id),
held AS MATERIALIZED (
  SELECT doc_id, host, text, regexp_extract_all({FOLD.format("l")}, '{WORD}') AS lw FROM cut
), lines AS MATERIALIZED (SELECT doc_id, host, text, array_to_string(lw, ' ') AS line, len(lw) AS n FROM held),
limits AS (SELECT host, greatest(20.0, cbrt(count(DISTINCT text))) AS most FROM base WHERE text IS NOT NULL GROUP BY host),
often AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS c FROM lines GROUP BY host, line) JOIN limits USING (host)
  WHERE c > most
), lost AS (SELECT doc_id, sum(n) AS n FROM lines SEMI JOIN often USING (host, line) GROUP BY doc_id),
counts AS (
  SELECT b.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0) AS n_symbols,
    coalesce(d.n, 0) AS n_dup_lines, coalesce(a.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS lost
  FROM base b LEFT JOIN doubles d USING (doc_id) LEFT JOIN again a USING (doc_id) LEFT JOIN lost l USING (doc_id)
), verdict AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (lost = 0 OR (n_words - lost >= 10 AND n_words - lost >= 0.3 * n_words)) AS kept,
  lost::BIGINT AS lost_words
FROM verdict
"""


@query("op10_quality_rules", QUALITY_SQL)
def op10(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.quality import quality_rules

    return quality_rules(documents(spark, root)).drop("host", "tid", "frequent")


MIDDLE_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents
), numbers AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
    n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 AS plain,
    ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 AS spm
  FROM drawn
), cut AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
  SELECT *, '<P>' || substr(t, 1, a) AS p, '<M>' || substr(t, a + 1, b - a) AS m, '<S>' || substr(t, b + 1, n - b) AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN NOT plain THEN a END AS prefix_chars, CASE WHEN NOT plain THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN s || p || m ELSE p || s || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


@query("op11_fill_in_middle", MIDDLE_SQL)
def op11(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.middle import digests

    return digests(documents(spark, root))


# crc32 bit by bit, as there is no such function; a turn is a struct of role and text.
TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
), own AS MATERIALIZED (
  SELECT conv_id, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, md5(concat(strlen(r), ':', r, t))) AS w,
    xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT), lambda a, b:
      list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[], lambda u, v: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END, xor(a, b)),
      4294967295), 4294967295) % 9 AS h
  FROM turns GROUP BY conv_id
), rebuilt AS MATERIALIZED (
  SELECT o.conv_id, list_concat(coalesce(b.w, [])[1 : o.h], o.w[o.h + 1 : len(o.w)]) AS w
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), steps AS (
  SELECT conv_id, d, w[1 : d] AS p, w[1 : d - 1] AS up, len(w) = d AS ends, CASE WHEN d > 0 THEN strlen(w[d].t) ELSE 0 END AS bytes
  FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM rebuilt)
), nodes AS MATERIALIZED (
  SELECT p, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM steps GROUP BY p, d
), children AS (SELECT up AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY up),
sums AS (
  SELECT q AS p, sum(saved) AS saved, sum(leaf) AS leaves FROM (
    SELECT n.p[1 : unnest(range(0, n.d + 1))] AS q, saved, (c.n IS NULL)::BIGINT AS leaf FROM nodes n LEFT JOIN children c USING (p)
  ) GROUP BY q
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.leaves::BIGINT AS n_leaves,
  s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (p) LEFT JOIN children c USING (p) LEFT JOIN nodes u ON n.d > 0 AND u.p = n.up AND u.d = n.d - 1
"""


@query("op12_conversation_trie", TRIE_SQL)
def op12(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.ztrie import conversation_trie

    return conversation_trie(spark.read.parquet(f"{root}/conversations.parquet"))


@query("op13_byte_bpe")
def op13(spark: SparkSession, root: str) -> DataFrame:
    from rollweave.llm.bytebpe import round_trip_digests

    return round_trip_digests(documents(spark, root))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
