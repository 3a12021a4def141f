"""One query per operator over its whole table, and its SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import (
    decontamination,
    divergence,
    line_dedup,
    merkle,
    minhash,
    mixing,
    substring_dedup,
    suffix_dedup,
    topk_search,
    toxicity,
    url_filter,
    vantage_trees,
    warc,
)
from stratalake.llm.common import ORACLE, QUERIES, ascii_lower, query, table  # noqa: F401

UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      {UPPER_LOWER}) AS key
  FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE f.key IS NULL), ''))
         AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY doc_id
"""


@query("op1_line_dedup", OP1_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_frequent_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


RULES = [
    url_filter.rule("block", "net/"),
    url_filter.rule("allow", "example.net/en/"),
    url_filter.rule("block", "example.com/de/"),
    url_filter.rule("allow", "org/fr/"),
]


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


#: Relative shares of characters; sources that are not listed share the weight of one of them.
WEIGHTS = {"src0": 4.0, **{f"src{i}": 1.0 for i in range(1, 20)}}

OP6_SQL = """
WITH weights AS (
  SELECT 'src' || i AS grp, CASE WHEN i = 0 THEN 4.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM range(0, 20) t(i)
  UNION ALL SELECT 'others', 1.0::DOUBLE
), docs AS (
  SELECT *, CASE WHEN source IN (SELECT grp FROM weights WHERE grp <> 'others') THEN source
                 ELSE 'others' END AS grp
  FROM documents
), sizes AS (
  SELECT grp, sum(coalesce(length(text), 0)) AS chars FROM docs GROUP BY grp
), rates AS (
  SELECT grp, weight / (SELECT sum(weight) FROM sizes JOIN weights USING (grp) WHERE chars > 0)
              * (SELECT sum(chars) FROM sizes)::DOUBLE / chars AS rate
  FROM sizes JOIN weights USING (grp) WHERE chars > 0
), parted AS (
  SELECT grp, greatest(1, ceil(rate / 256.0::DOUBLE))::BIGINT AS parts, rate / parts AS mean FROM rates
), cdf AS (
  SELECT grp, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1)))
                   OVER (PARTITION BY grp ORDER BY k) AS p
  FROM (SELECT *, unnest(range(0, ceil(mean + 12 * sqrt(mean) + 30)::BIGINT + 1)) AS k FROM parted)
), steps AS (
  SELECT grp, count(*) AS step FROM cdf GROUP BY grp
), named AS (
  SELECT d.*, coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) AS name,
         unnest(range(1, parts + 1)) AS part
  FROM docs d JOIN parted USING (grp)
), drawn AS (
  SELECT *, ('0x' || substr(md5('mix|' || CASE WHEN part > 1 THEN 'part ' || part || '|' ELSE '' END
             || name), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM named
), counted AS (
  SELECT d.*, step, (SELECT count(*) FROM cdf c WHERE c.grp = d.grp AND u >= p) AS copies
  FROM drawn d JOIN steps USING (grp)
)
SELECT doc_id, source, text, copy, md5('mix|order|' || name || '|' || copy) AS shuffle_key
FROM (SELECT *, (part - 1) * step + unnest(range(1, copies + 1)) AS copy FROM counted)
"""


@query("op6_mix_sources", OP6_SQL)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs, WEIGHTS, other_weight=1.0)


OP7_SQL = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT item, w, least(len(w), 10) AS n,
               unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM item_words WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, lengths WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, n, i, item FROM places JOIN windows USING (n, win)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items,
         sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256
  FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op7_decontamination", OP7_SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark").select("item_id", "text"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP2_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v),
           lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op2_topk_search", OP2_SQL)
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_search.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20, factor=64)


OP8_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
), coded AS (
  SELECT *, list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(h, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER + 1,
      1) for i in range(0, 32)], 'string_agg', '') AS payload_digest
  FROM p
), firsts AS (
  SELECT payload_digest, payload_bytes, min(page_id) AS first FROM coded GROUP BY ALL
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM coded JOIN firsts USING (payload_digest, payload_bytes)
"""


@query("op8_warc", OP8_SQL)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    kind = dict(pages.dtypes)["page_id"]

    def page(name: str):
        return F.regexp_extract(name, "<urn:page:(.*)>", 1)

    return warc.round_trip(pages, min_revisit_bytes=0).select(
        F.when(page("record_id") != "", page("record_id")).cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").cast(kind).alias("refers_to"),
    )


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op5_minhash")
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs).select("doc_id", "class_id", "keep")


OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), repeated AS (
  SELECT doc_id, i FROM windows JOIN (SELECT win FROM windows GROUP BY win HAVING count(*) > 1)
    USING (win)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM repeated
), placed AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words WHERE len(w) > 0
), kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p.place) AS text
  FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query("op10_substring_dedup", OP10_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeated_words(docs, window=35).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeated_bytes(docs, length=400).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), used AS (
  SELECT row, lang, source, translate(unnest(terms), UPPER_LOWER) AS term FROM docs
), kept AS (
  SELECT lang, term FROM used GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), sizes AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM used JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p
  FROM totals g JOIN kept k ON g.lang = k.lang JOIN sizes s ON s.lang = g.lang
       LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), overall AS (
  SELECT c.lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (any_value(total) + 2 * any_value(v)) AS q
  FROM counts c JOIN sizes s ON s.lang = c.lang
       JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) t ON t.lang = c.lang
  GROUP BY c.lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p))
                   FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
), favoured AS (
  SELECT s.lang, source, s.term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM shares s JOIN overall o ON s.lang = o.lang AND s.term = o.term WHERE n > 0 AND p > q
), rows AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value FROM favoured
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
""".replace("UPPER_LOWER", UPPER_LOWER)


@query("op11_source_divergence", OP11_SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "source", "text")
    return divergence.audit_sources(docs, min_docs=10, top_terms=10)


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    parts = [f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields]
    return f"sha256({' || '.join(parts)})"


OP12_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce(':' || lang, '-') AS grp, {_leaf_sql("text")} AS leaf,
         {_leaf_sql(f"translate(text, {UPPER_LOWER})")} AS lowered,
         list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1),
                       lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)),
           4294967295::BIGINT) AS crc
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY grp) AS n
  FROM leaves
), nodes(grp, lvl, idx, n, h) AS (
  SELECT grp, 0, idx, n, leaf FROM placed
  UNION ALL
  SELECT grp, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY grp, lvl, idx // 8, n
), subroots AS (
  SELECT grp, lvl AS top, h, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), upper(lvl, idx, n, h) AS (
  SELECT 0, idx, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM upper WHERE n > 1 GROUP BY lvl, idx // 8, n
), fold(grp, place, lvl, idx, n, x, proof) AS (
  SELECT grp, idx, 0, idx, n, CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN lowered ELSE leaf END, ''
  FROM placed
  UNION ALL
  SELECT f.grp, f.place, f.lvl + 1, f.idx // 8, (f.n + 7) // 8,
         sha256(string_agg(CASE WHEN n.idx = f.idx THEN f.x ELSE n.h END, '' ORDER BY n.idx)),
         f.proof || coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (WHERE n.idx <> f.idx), '')
  FROM fold f JOIN nodes n ON n.grp = f.grp AND n.lvl = f.lvl AND n.idx // 8 = f.idx // 8
  WHERE f.n > 1 GROUP BY f.grp, f.place, f.lvl, f.idx, f.n, f.x, f.proof
), rising(grp, place, lvl, idx, n, x, proof) AS (
  SELECT f.grp, f.place, 0, s.idx, s.n, f.x, f.proof
  FROM fold f JOIN subroots s ON s.grp = f.grp AND s.top = f.lvl WHERE f.n = 1
  UNION ALL
  SELECT f.grp, f.place, f.lvl + 1, f.idx // 8, (f.n + 7) // 8,
         sha256(string_agg(CASE WHEN n.idx = f.idx THEN f.x ELSE n.h END, '' ORDER BY n.idx)),
         f.proof || coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (WHERE n.idx <> f.idx), '')
  FROM rising f JOIN upper n ON n.lvl = f.lvl AND n.idx // 8 = f.idx // 8
  WHERE f.n > 1 GROUP BY f.grp, f.place, f.lvl, f.idx, f.n, f.x, f.proof
)
SELECT p.doc_id, p.leaf, s.h AS subroot, u.h AS root, sha256(r.proof) AS proof_sha256,
       r.x AS folded_root, r.x = u.h AS verified
FROM placed p JOIN rising r ON r.grp = p.grp AND r.place = p.idx AND r.n = 1
     JOIN subroots s ON s.grp = p.grp JOIN (SELECT h FROM upper WHERE n = 1) u ON true
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents").select(columns)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    rows = merkle.manifest(docs, columns, fanout=8, suspects={"text": text})
    folded_root = merkle.folded(F.col("suspect"), F.col("path"))
    return rows.select(
        F.col("id").alias("doc_id"),
        merkle.as_text(F.col("leaf")).alias("leaf"),
        merkle.as_text(F.col("subroot")).alias("subroot"),
        merkle.as_text(F.col("root")).alias("root"),
        merkle.proof_hash(F.col("path")).alias("proof_sha256"),
        folded_root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


OP13_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])),
                          lambda s, x: s + x)) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op13_vantage_search", OP13_SQL)
def op13_vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vantage_trees.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10, factor=1.0)
