"""The opN_* queries over the driver tables, with DuckDB SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstat.llm import (conversations, covering, decontam, html_extract, langid, license, line_dedup, mixing, near_dup,
                           passages, spelling, topk, toxicity)
from fieldstat.llm.tables import read


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best matches of every hundredth vector among all vectors."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return license.scan(docs).drop("text")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages that documents share, and exact copies."""
    return passages.repeated_passages(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_dup.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; rows with ``held_out`` are never learnt from."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    apart = toxicity.held_out(F.col("doc_id"), 3, 1)
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").where(~apart)
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model, out="score")
    return scored.select("doc_id", apart.alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of document and benchmark item with a verified overlap."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.overlaps(docs, read(spark, sf_dir, "benchmark")).drop("k1", "k2")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows with ``held_out`` are never learnt from."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    apart = toxicity.held_out(F.col("doc_id"), 4, 2)
    model = langid.train(docs.where(~apart))
    return langid.predict(docs.select("doc_id", "text", apart.alias("held_out")), model).drop("text")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before dropping, lines dropped and a digest of what is kept, per document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling groups of the words of all documents, some of which the contract misspells."""
    return spelling.spelling_variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return covering.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after the contract's damage."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.repair(conversations.damage(rows), rows)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to query, in order of the operators."""
    return {f.__name__: f for f in (op1_main_text, op2_top_k, op3_license_scan, op4_source_mix, op5_repeated_passages,
                                   op6_near_duplicates, op7_toxicity, op8_decontaminate, op9_language, op10_line_dedup,
                                   op11_spelling_variants, op12_simhash_components, op13_conversation_repair)}


_LINE_KEY = ("translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
             "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

OP10_SQL = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos FROM split
), keyed AS (
  SELECT doc_id, pos, line, {_LINE_KEY} AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


def _windows_sql(id_col: str, table: str) -> str:
    """Every window of SPAN words of a table, once per mask, with the words the mask looks at."""
    keys = " UNION ALL ".join(
        f"SELECT *, {i} AS mask, concat_ws(' ', {', '.join(f'x[{j + 1}]' for j, m in enumerate(mask) if m == '1')}) AS key FROM {table}_w"
        for i, mask in enumerate(decontam.MASKS))
    return f"""
{table}_t AS (SELECT {id_col}, {_WORDS} AS w FROM {table} WHERE {id_col} IS NOT NULL),
{table}_w AS (SELECT {id_col}, pos, w[pos + 1:pos + {decontam.SPAN}] AS x
              FROM (SELECT {id_col}, w, unnest(range(0, len(w) - {decontam.SPAN - 1})) AS pos FROM {table}_t)),
{table}_k AS ({keys})"""


# Items of SPAN words and more; the driver's tables have no shorter ones.
OP8_SQL = f"""
WITH {_windows_sql('doc_id', 'documents')}, {_windows_sql('item_id', 'benchmark')},
hits AS (
  SELECT d.doc_id, b.item_id, d.pos,
         list_sum(list_transform(range(1, {decontam.SPAN + 1}), lambda j: CAST(d.x[j] = b.x[j] AS INTEGER))) / {decontam.SPAN}.0 AS identity
  FROM documents_k d JOIN benchmark_k b ON d.mask = b.mask AND d.key = b.key
)
SELECT doc_id, item_id, min(pos) AS first_word, max(pos) + {decontam.SPAN - 1} AS last_word, count(*) AS n_hits, max(identity) AS identity
FROM hits WHERE identity >= {decontam.IDENTITY} GROUP BY doc_id, item_id
"""

OP2_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {topk.K}
"""


# CRC-32 of the bytes of a string, by the table of its polynomial.
_CRC_TABLE = ("list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), "
              "lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")


def _crc_sql(table: str, text: str) -> str:
    """An expression for the CRC-32 of the UTF-8 of ``text``, with the table in the column ``table``."""
    byte = f"list_transform(range(strlen({text})), lambda k: CAST('0x' || substr(hex(encode({text})), CAST(2 * k + 1 AS INTEGER), 2) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(4294967295, {byte}), "
            f"lambda c, b: xor(c >> 8, {table}[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295)")


OP11_SQL = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
), keyed AS (SELECT id || ':' || run AS line, run, count(*) AS k FROM runs WHERE length(run) >= {spelling.MIN_CHARS} GROUP BY ALL
), hashed AS (SELECT run, k, {_crc_sql('t', 'line')} AS h FROM keyed, crc
), words AS (
  SELECT CASE WHEN h % {spelling.MISSPELL} = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                || substr(run, CAST(h % length(run) + 2 AS INTEGER)) ELSE run END AS word, k FROM hashed
), vocab AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM words WHERE length(word) >= {spelling.MIN_CHARS}
  GROUP BY word HAVING sum(k) >= {spelling.MIN_COUNT}
), less AS (
  SELECT word, i, substr(word, 1, CAST(i AS INTEGER)) || substr(word, CAST(i + 2 AS INTEGER)) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM vocab)
), pairs AS (
  SELECT a.word, b.word AS near FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT v.word, d.word FROM less d JOIN vocab v ON v.word = d.rest
  UNION SELECT d.word, v.word FROM less d JOIN vocab v ON v.word = d.rest
), best AS (
  SELECT p.word, count(*) AS n_near, min({{'less': -v.n, 'near': p.near}}) AS b FROM pairs p JOIN vocab v ON v.word = p.near GROUP BY p.word
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b['less'] >= {spelling.RATIO} * v.n THEN b['near'] END AS form,
         CASE WHEN -b['less'] >= {spelling.RATIO} * v.n THEN -b['less'] END AS form_n
  FROM vocab v LEFT JOIN best ON best.word = v.word
), walk AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON f.word = w.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN walk w ON w.word = f.word JOIN formed e ON e.word = w.root AND e.form IS NULL
"""

_BEST = "STRUCT(c BIGINT, a VARCHAR, l VARCHAR)"


def _then(x: str, cost: str, edit: str, line: str = "''", when: str = "true") -> str:
    """The best edits ``x`` and one more edit, null where it cannot be."""
    return f"CASE WHEN {x} IS NOT NULL AND {when} THEN {{'c': {x}.c + {cost}, 'a': {x}.a || '{edit}', 'l': {x}.l || {line}}} END"


def _least(*options: str) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"


def _put_in(source: str) -> str:
    """Rows put in behind z0 to z3: x0 to x3."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    return f"""SELECT conv_id, pos, z0 AS x0, z1 AS x1, u AS x2, {_least('z3', _then('u', '2', 'I', assistant))} AS x3 FROM (
      SELECT *, {_least('z2', *[_then(z, '2', 'I', user) for z in ('z0', 'z1', 'z3')])} AS u FROM ({source}))"""


_NOTHING = f"""SELECT conv_id, CAST(0 AS BIGINT) AS pos, CAST({{'c': 0, 'a': '', 'l': ''}} AS {_BEST}) AS z0,
  CAST(NULL AS {_BEST}) AS z1, CAST(NULL AS {_BEST}) AS z2, CAST(NULL AS {_BEST}) AS z3 FROM ids"""
_FREE = ("x0", "x1", "x3")
_USER = [_then(x, "more", "K", "own", "may AND i = 'u'") for x in _FREE] + [
    _then(x, "2 + more", "R", "chr(10) || 'user' || given", "may") for x in _FREE]
_ROW = f"""SELECT b.conv_id, r.pos, {_then('x0', '3', 'D')} AS z0,
  {_least(_then('x1', '3', 'D'), _then('x0', 'more', 'K', 'own', "may AND i = 's'"))} AS z1,
  {_least(_then('x2', '3', 'D'), *_USER)} AS z2,
  {_least(_then('x3', '3', 'D'), _then('x2', 'more', 'K', 'own', "may AND i = 'a'"),
          _then('x2', '2 + more', 'R', "chr(10) || 'assistant' || given", 'may'))} AS z3
  FROM best b JOIN lines r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.pos = b.pos + 1"""

# Forward over the rows: for each state the cheapest, then ASCII-least edits that lead to it.
OP13_SQL = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t), ids AS (SELECT DISTINCT conv_id FROM conversations
), keys AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS line FROM conversations
), hits AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc_sql('t', 'line')} % 20 AS h FROM keys, crc
), hurt AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hits, range(2) AS twice(r) WHERE h <> 0 AND (r = 0 OR h = 3)
), lined AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM hurt
), seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM lined
), faulty AS (
  SELECT conv_id, turn, role, text, pos, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS j,
         CASE WHEN said = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM seen
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE j IS NOT NULL AND j || i NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id
), lines AS (
  SELECT conv_id, pos, i, chr(10) || role || ':' || text AS own, ':' || text AS given, fault NOT IN ('blank', 'duplicate') AS may,
         CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS more FROM faulty
), best AS ({_put_in(_NOTHING)} UNION ALL {_put_in(_ROW)})
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.c AS cost, e.a AS audit, sha256(substr(e.l, 2)) AS repaired_sha256
FROM ids d LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
JOIN (SELECT conv_id, pos, {_least('x0', 'x3')} AS e FROM best) b
  ON b.conv_id IS NOT DISTINCT FROM d.conv_id AND b.pos = coalesce(c.n, 0)
"""


def llm_oracles() -> dict[str, str]:
    """Name to DuckDB SQL."""
    return {"op11_spelling_variants": OP11_SQL, "op13_conversation_repair": OP13_SQL,
            "op2_top_k": OP2_SQL, "op8_decontaminate": OP8_SQL, "op10_line_dedup": OP10_SQL}
