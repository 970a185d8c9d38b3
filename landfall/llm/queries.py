"""The operators as queries over the benchmark tables, and their meaning in SQL where SQL has one."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm import (
    audit, codebooks, contamination, order_minhash, packing, quality, repair, repeats, simhash, templates, toxicity, warc, wrappers,
)
from landfall.llm.tables import table
from landfall.sources import shared_folder

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    """The tokenizer's file; its package is outside this repository."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.main_texts(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.filter(quality.remainder(F.col("doc_id"), 4) != 2)
    return quality.score_quality(docs, known.select("doc_id", F.col("quality").alias("y")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = quality.remainder(F.col("doc_id"), 4) == 2
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(quality.remainder(F.col("doc_id"), 5) != 0)
    scores = toxicity.score_toxicity(table(spark, sf_dir, "documents"), labels.select("doc_id", F.col("toxic").alias("y")))
    held_out = quality.remainder(F.col("doc_id"), 5) == 0
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


WORDS_SQL = """
  SELECT {key}, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f\\x0B]+'), lambda x: x <> '') AS w FROM {table} WHERE text IS NOT NULL
"""

SHINGLES_SQL = "unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s"

OP5_SQL = f"""
  WITH items AS (SELECT item_id, w, least(len(w), 5) AS k FROM ({WORDS_SQL.format(key="item_id", table="benchmark")}) WHERE len(w) > 0),
       b AS (SELECT DISTINCT item_id, k, {SHINGLES_SQL} FROM items),
       d AS (SELECT DISTINCT doc_id, k, {SHINGLES_SQL}
             FROM ({WORDS_SQL.format(key="doc_id", table="documents")}), (SELECT DISTINCT k FROM items) WHERE len(w) >= k),
       n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
  SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*) / n_shingles AS containment
  FROM b JOIN d USING (k, s) JOIN n USING (item_id)
  GROUP BY doc_id, item_id, n_shingles HAVING count(*) * 5 >= n_shingles * 4
"""


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = templates.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "text", "n_lines", "n_dropped")


OP6_SQL = """
  WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
  pieces AS (SELECT doc_id, unnest(lines) AS raw, generate_subscripts(lines, 1) AS line_no FROM raw),
  even AS (SELECT doc_id, line_no, trim(regexp_replace(raw, '[ \\t\\r\\f\\x0B]+', ' ', 'g')) AS even FROM pieces),
  masked AS (
    SELECT doc_id, line_no, string_split(
             CASE WHEN len(string_split(even, ' ')) >= 5 THEN regexp_replace(even, '[^ 0-9]*[0-9][^ ]*', '<*>', 'g') ELSE even END, ' ') AS w
    FROM even WHERE even <> ''),
  line AS (SELECT doc_id, line_no, w, {'n': len(w), 'w': w[1:3]} AS leaf FROM masked),
  counts AS (SELECT leaf, w, count(DISTINCT doc_id) AS documents, min(doc_id) AS first FROM line GROUP BY leaf, w),
  placed AS (SELECT leaf, w, documents, first, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM counts),
  agreed AS (SELECT leaf, p, word FROM placed GROUP BY ALL HAVING sum(documents) >= 3),
  shaped AS (
    SELECT leaf, w, documents, first, avg(CASE WHEN a.word IS NULL THEN 0 ELSE 1 END) AS stay,
           string_agg(CASE WHEN a.word IS NULL THEN '<*>' ELSE a.word END, ' ' ORDER BY p) AS template
    FROM placed LEFT JOIN agreed a USING (leaf, p, word) GROUP BY leaf, w, documents, first),
  found AS (
    SELECT leaf, template, min(first) AS first FROM shaped WHERE stay >= 0.8 GROUP BY ALL HAVING sum(documents) >= 3),
  dropped AS (
    SELECT line.doc_id, line_no FROM line JOIN shaped USING (leaf, w) JOIN found f USING (leaf, template)
    WHERE stay >= 0.8 AND line.doc_id <> f.first
    UNION
    SELECT doc_id, line_no FROM line JOIN counts USING (leaf, w) WHERE len(w) >= 20 AND documents > 1 AND doc_id <> first)
  SELECT doc_id, CAST(any_value(n) AS INTEGER) AS n_lines, CAST(count(d.line_no) AS INTEGER) AS n_dropped,
         coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (d.line_no IS NULL), '') AS text
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM pieces) LEFT JOIN dropped d USING (doc_id, line_no)
  GROUP BY doc_id
"""


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-shards")
    repair.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return repair.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.order_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        order_minhash.as_text("print").alias("fingerprint"),
        order_minhash.as_text("edited_print").alias("edited_fingerprint"),
        order_minhash.likeness("print", "edited_print").alias("near_edited"),
        order_minhash.likeness("print", "next_print").alias("near_next"),
    )


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = codebooks.compress(table(spark, sf_dir, "embeddings"))
    found = codebooks.with_label_error(codes)
    return found.select("vec_id", "code", "error", "label_error", F.lit(codebooks.books_sha256(books)).alias("codebooks_sha256"))


def _op11_sql() -> str:
    """The rounds written one after the other."""
    nearest = """
  a{k} AS MATERIALIZED (
    SELECT vec_id, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS near
    FROM (SELECT vec_id, p, x, e, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i]))) AS d
          FROM parts JOIN c{k} USING (p))
    GROUP BY vec_id, p),"""
    moved = """
  m{k} AS (
    SELECT p, e, list(v ORDER BY i) AS y
    FROM (SELECT p, e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS v
          FROM (SELECT p, near.e AS e, x, unnest(range(1, len(x) + 1)) AS i FROM a{j}) GROUP BY p, e, i)
    GROUP BY p, e),
  c{k} AS MATERIALIZED (SELECT p, e, coalesce(m{k}.y, c{j}.y) AS y FROM c{j} LEFT JOIN m{k} USING (p, e)),"""
    rounds = "".join(nearest.format(k=k) + moved.format(k=k + 1, j=k) for k in range(codebooks.ROUNDS))
    return f"""
  WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
  parts AS MATERIALIZED (
    SELECT vec_id, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, range(0, 8) r(p)),
  c0 AS MATERIALIZED (
    SELECT p, e, x AS y FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 16) USING (vec_id)),
  {rounds}{nearest.format(k=codebooks.ROUNDS)}
  coded AS (
    SELECT vec_id, string_agg(printf('%02x', near.e), '' ORDER BY p) AS code, CAST(sum(near.d) AS BIGINT) AS error
    FROM a{codebooks.ROUNDS} GROUP BY vec_id)
  SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
         (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM c{codebooks.ROUNDS}) AS codebooks_sha256
  FROM coded JOIN kept USING (vec_id)
"""


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = """
  WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
  g AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
  v AS (SELECT page_id, html, h, first, list_transform(range(0, 8), lambda i: CAST('0x' || substr(h, 5 * i + 1, 5) AS INTEGER)) AS v FROM p JOIN g USING (h))
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
  FROM v
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
  WITH own AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r\f\x0B]+'), lambda x: x <> '') AS w
    FROM documents),
  known AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
  firsts AS (SELECT coalesce(text, '') AS text, min(doc_id) AS first FROM documents GROUP BY 1),
  bits AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
            'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
            'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc_id > first, first IS NOT NULL)} AS f
    FROM own JOIN firsts USING (text) LEFT JOIN known USING (doc_id)),
  failed AS (
    SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END) AS fails,
           count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM bits GROUP BY ALL),
  letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
  orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
  steps AS (
    SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS l, string_split(left(filter_order, step - 1), '') AS before
    FROM orders, range(1, 6) r(step)),
  counts AS (
    SELECT part, filter_order, step, l,
           coalesce(sum(n) FILTER (NOT list_has_any(fails, before) AND NOT list_contains(fails, l)), 0) AS kept,
           coalesce(sum(n) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, l)), 0) AS removed,
           coalesce(sum(n) FILTER (list_has_any(fails, before) AND list_contains(fails, l)), 0) AS redundant,
           coalesce(sum(n) FILTER (fails = [l]), 0) AS unique_fails,
           coalesce(sum(good) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, l)), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, l)), 0) AS toxic_lost
    FROM failed, steps GROUP BY ALL)
  SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
         CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
         CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
  FROM counts
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_main_text, op2_packing, op3_quality, op4_toxicity, op5_contamination,
        op6_line_templates, op7_token_shards, op8_simhash, op9_order_minhash, op10_repeats,
        op11_codebooks, op12_warc, op13_filter_audit,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op5_contamination": OP5_SQL, "op6_line_templates": OP6_SQL, "op11_codebooks": _op11_sql(), "op12_warc": OP12_SQL, "op13_filter_audit": OP13_SQL,
}
