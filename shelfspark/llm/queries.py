"""Named queries of the corpus operators: thin, over whole tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import (
    decontaminate, embed_dedup, html_extract, huffman, language_id, licenses, ngram_join, packing, pii, prefix_trie,
    quality, spelling, token_counts,
)
from shelfspark.llm.common import table
from shelfspark.llm.tokens import vocabulary_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark, sf):
    """Windows of ``benchmark`` in ``documents``."""
    return decontaminate.contamination_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op2_html_extract(spark, sf):
    """Main text of ``pages``."""
    found = html_extract.main_texts(table(spark, sf, "pages"), html_extract.fit_tree_model())
    return found.select("page_id", "url", "text", "n_chars")


@query
def op3_quality(spark, sf):
    """A quality score for each of ``documents``, learned from ``labels``."""
    docs = table(spark, sf, "documents")
    scored = quality.quality_scores(docs, quality.fit_quality(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query
def op4_token_counts(spark, sf):
    """Ids of each of ``documents``, counted in flat files."""
    return token_counts.document_counts(
        table(spark, sf, "documents"), vocabulary_path("byte_bpe_50k.json"), end_id=50256
    )


@query
def op5_packing(spark, sf):
    """``documents`` in sequences of at most 4096 ids."""
    docs = table(spark, sf, "documents")
    return packing.pack_documents(docs, vocabulary_path("word_bpe_49k.json"), with_ids=False).drop("ids")


@query
def op6_ngram_join(spark, sf):
    """Groups of ``documents`` joined by word 5-grams."""
    return ngram_join.similar_groups(table(spark, sf, "documents"))


def document_files(docs: DataFrame) -> DataFrame:
    """``documents`` as files: a directory for source, language and a number; each fortieth speaks for a language."""
    spoken = F.concat_ws("/", "source", "lang", F.concat(F.lit("LICENSE."), F.col("doc_id").cast("string")))
    place = F.concat_ws("/", "source", "lang", (F.col("doc_id") % 40).cast("string"), F.col("doc_id").cast("string"))
    return docs.select("doc_id", "text", F.when(F.col("doc_id") % 40 == 0, spoken).otherwise(place).alias("path"))


@query
def op7_license_scan(spark, sf):
    """Licences of ``documents``, their own or inherited."""
    return licenses.scan_licenses(document_files(table(spark, sf, "documents"))).drop("path")


@query
def op8_token_binary(spark, sf):
    """``documents`` through Huffman-coded files and back."""
    return huffman.round_trip(table(spark, sf, "documents"), vocabulary_path("byte_bpe_50k.json"))


@query
def op9_embedding_dedup(spark, sf):
    """Links and components of ``embeddings`` at a cosine of 0.95."""
    return embed_dedup.near_duplicates(table(spark, sf, "embeddings"))


@query
def op10_pii(spark, sf):
    """``documents`` with surrogates for personal data and secrets."""
    done = pii.replace_entities(table(spark, sf, "documents"))
    return done.select("doc_id", "text", "n_entities", "kinds")


@query
def op11_spelling_variants(spark, sf):
    """Words of ``documents`` with their near words, forms and roots."""
    return spelling.spelling_variants(table(spark, sf, "documents"))


@query
def op12_language_id(spark, sf):
    """The language of each of ``documents``, learned from those that are not held out."""
    docs = table(spark, sf, "documents")
    found = language_id.identify_languages(docs, language_id.fit_languages(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query
def op13_prefix_trie(spark, sf):
    """The trie of rebuilt ``conversations`` with its subtree totals."""
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_OP1_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op1_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_OP1_WORDS} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_OP1_WORDS} AS ws FROM benchmark),
p AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(list_slice(ws, i, i + least(len(ws), 10) - 1), ' ') AS w
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
),
dw AS (
  SELECT doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS w
  FROM (
    SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
    FROM d, (SELECT DISTINCT n FROM p) WHERE len(ws) >= n
  )
),
m AS (SELECT doc_id, i, n, item FROM dw JOIN p USING (n, w)),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id
),
held AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""

# The reflected CRC-32 of 0xEDB88320, byte by byte: SQL has no function for it
_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t
)"""


def _crc32(text: str) -> str:
    """Checksum of a text of code points below U+0800, where the CTE ``crc`` is joined."""
    points = f"list_transform(string_split({text}, ''), lambda x: CAST(unicode(x) AS BIGINT))"
    coded = "CASE WHEN x < 128 THEN [x] ELSE [192 | (x >> 6), 128 | (x & 63)] END"
    octets = f"flatten(list_transform({points}, lambda x: {coded}))"
    step = "lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), {step}), 4294967295)"


ORACLES["op11_spelling_variants"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents
),
each AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
checked AS (SELECT run, n, {_crc32("concat(CAST(doc_id AS VARCHAR), ':', run)")} AS h FROM each, crc),
slipped AS (
  SELECT n, CASE WHEN h % 97 = 0
    THEN concat(left(run, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word
  FROM checked
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM places),
near AS (
  SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM holes x JOIN holes y USING (i, a, b) WHERE x.word <> y.word
  UNION
  SELECT x.word, x.n, y.word, y.n FROM holes x JOIN words y ON y.word = concat(x.a, x.b)
  UNION
  SELECT y.word, y.n, x.word, x.n FROM holes x JOIN words y ON y.word = concat(x.a, x.b)
),
best AS (
  SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k
  FROM near
),
forms AS (
  SELECT w.word, w.n, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
    CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n, coalesce(n_near, 0) AS n_near
  FROM words w LEFT JOIN (SELECT * FROM best WHERE k = 1) b USING (word)
),
walk AS (
  SELECT word, coalesce(form, word) AS at FROM forms
  UNION
  SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk r USING (word) JOIN forms last ON last.word = r.at WHERE last.form IS NULL
"""

ORACLES["op13_prefix_trie"] = f"""
WITH {_CRC_TABLE},
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL
),
convs AS (SELECT c, c - c % 100 AS base, {_crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT c FROM turns), crc),
rebuilt AS (
  SELECT v.c, 0 AS part, t.k, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base WHERE t.k <= v.h
  UNION ALL
  SELECT v.c, 1, t.k, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c WHERE t.k > v.h
),
numbered AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, k) AS d,
    sha256(concat(CAST(length(role) AS VARCHAR), ':', role, text)) AS said, length(text) AS chars
  FROM rebuilt
),
paths AS (
  SELECT c, 0 AS d, 0 AS chars, '' AS path, CAST(NULL AS VARCHAR) AS above FROM convs
  UNION ALL
  SELECT c, d, chars, path, substr(path, 1, length(path) - 64)
  FROM (SELECT c, d, chars, string_agg(said, '') OVER (PARTITION BY c ORDER BY d) AS path FROM numbered)
),
lengths AS (SELECT c, max(d) AS last FROM paths GROUP BY c),
nodes AS (
  SELECT path, any_value(above) AS above, any_value(d) AS d, any_value(chars) AS chars, min(c) AS c, count(*) AS n,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = last), '')) AS ends
  FROM paths JOIN lengths USING (c) GROUP BY path
),
kids AS (SELECT above AS path, count(*) AS children FROM nodes WHERE above IS NOT NULL GROUP BY above),
full_nodes AS (SELECT n.*, coalesce(children, 0) AS children FROM nodes n LEFT JOIN kids USING (path)),
up AS (
  SELECT substr(path, 1, CAST(64 * k AS BIGINT)) AS path, (children = 0) AS leaf, (n - 1) * chars AS saved
  FROM (SELECT path, children, n, chars, unnest(range(0, d + 1)) AS k FROM full_nodes)
),
sums AS (
  SELECT path, CAST(count(*) FILTER (WHERE leaf) AS BIGINT) AS leaves, CAST(sum(saved) AS BIGINT) AS saved
  FROM up GROUP BY path
)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, p.c AS parent_conv_id, n.n AS n_convs, n.children AS n_children,
  s.leaves AS n_leaves, s.saved AS saved_tokens, n.ends AS ends_sha256
FROM full_nodes n JOIN sums s USING (path) LEFT JOIN full_nodes p ON p.path = n.above
"""
