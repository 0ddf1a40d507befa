"""The queries of the training-data operators with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cadastra.llm import decontaminate, minhash, negatives, packing, passages, quality, ratio, sharding, spelling, tiff, toxicity, urls, warc
from cadastra.llm.common import read, tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as WARC records and read back, with their place in the merged index, by URL key, time and id."""
    found = warc.in_order(warc.archived(read(spark, folder, "pages")))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", "urlkey", "position")


def op2_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Three-word shingles, 85 %: 28 bands of 5 rows miss such a link with a probability under 1e-7."""
    return minhash.near_duplicates(read(spark, folder, "documents"), n=3, percent=85, bands=28, rows=5)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of held-out rows are left out before anything is learned."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    held = lambda: F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    model = toxicity.fit(docs, read(spark, folder, "labels").where(~held()))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Two regions of two racks of two shards; the ninth shard is a third region."""
    tree = sharding.balanced(8)
    return sharding.sharded(read(spark, folder, "documents"), tree, sharding.grown(tree, 8))


def op5_tiff(spark: SparkSession, folder: str) -> DataFrame:
    """Texts stored as TIFF, read back page by page; the feature sums up the pages."""
    return tiff.features(tiff.store_texts(read(spark, folder, "documents")))


def op6_compact_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of at least fifty words; documents without one have no row."""
    return passages.repeated(read(spark, folder, "documents"), n=5, words=50, percent=80)


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of ten words of the benchmark, looked up in whole documents."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, read(spark, folder, "benchmark"), n=10, clean=False)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Trusted are the documents that ``labels`` calls good."""
    docs = read(spark, folder, "documents").select("doc_id", "lang", "text")
    model = quality.fit(docs, read(spark, folder, "labels").where("quality = 1"))
    return quality.score(docs, model).drop("text")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens, each document ended by id 0."""
    return packing.pack(read(spark, folder, "documents"), tokenizer=tokenizer_file(), capacity=1024, end_id=0, with_ids=False)


#: (verdict, host, path)
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Every page by the rules, or by the template that its path belongs to."""
    return urls.filtered(read(spark, folder, "pages"), URL_RULES)


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of six letters and more that occur five times and more, with the words one edit away that they stand for."""
    return spelling.variants(read(spark, folder, "documents"), least_length=6, least_count=5, times=5)


def op12_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Trusted are the documents that ``labels`` calls good."""
    return ratio.judged(read(spark, folder, "documents"), read(spark, folder, "labels").where("quality = 1")).drop("least")


def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Five negatives for each of five positives of every hundredth vector."""
    return negatives.hard_negatives(read(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    return {"op1_warc": op1_warc, "op2_minhash": op2_minhash, "op3_toxicity": op3_toxicity, "op4_hash_tree": op4_hash_tree, "op5_tiff": op5_tiff, "op6_compact_windows": op6_compact_windows, "op7_decontaminate": op7_decontaminate, "op8_quality": op8_quality, "op9_packing": op9_packing, "op10_urls": op10_urls, "op11_spelling": op11_spelling, "op12_ratio": op12_ratio, "op13_negatives": op13_negatives, "pipeline": corpus_pipeline.run}


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(url, '') AS u, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
             w AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d) END AS best FROM p)
        SELECT *, row_number() OVER (ORDER BY urlkey, page_id % 1073741824, page_id) - 1 AS position FROM (
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
               CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN best <> page_id THEN best END AS refers_to,
               CASE WHEN NOT regexp_matches(u, '(?s)^[^:/?#]*://') THEN lower(u)
                    ELSE array_to_string(list_reverse(string_split(regexp_replace(regexp_replace(lower(regexp_extract(u, '(?s)^[^:/?#]*://([^/?#]*)', 1)), '(?s)^.*@', ''), '^www[0-9]*\\.', ''), '.')), ',') || ')' ||
                         CASE WHEN regexp_extract(u, '(?s)^[^:/?#]*://[^/?#]*([^#]*)', 1) = '' THEN '/' ELSE lower(regexp_extract(u, '(?s)^[^:/?#]*://[^/?#]*([^#]*)', 1)) END END AS urlkey
        FROM w)""",
    "op2_minhash": f"""
        WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^ \\x09-\\x0D]+') AS w FROM documents),
        sets AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 2], ' ') END AS s
                 FROM words, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
        common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reached JOIN both_ways ON b = x),
        roots AS (SELECT a, min(b) AS root FROM reached GROUP BY 1)
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, root AS component_id, root = doc_id AS kept
        FROM documents JOIN roots ON a = doc_id LEFT JOIN sizes USING (doc_id)""",
    "op7_decontaminate": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
        items AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, w[i : i + least(len(w), 10) - 1] AS win
                  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
        lengths AS (SELECT DISTINCT m FROM items),
        windows AS (SELECT doc_id, i, m, w[i : i + m - 1] AS win FROM d, lengths, unnest(range(1, len(w) - m + 2)) AS t(i)),
        hits AS (SELECT doc_id, i, m, item_id FROM windows JOIN items USING (m, win)),
        marked AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hits, unnest(range(i, i + m)) AS t(k) GROUP BY 1),
        named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names FROM hits GROUP BY 1)
        SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_spelling": """
        WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
        runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
        counted AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY 1, 2),
        bytes AS (SELECT run, n, list_transform(range(strlen(named)), lambda i: CAST('0x' || substr(hex(encode(named)), CAST(2 * i + 1 AS INT), 2) AS BIGINT)) AS b FROM counted),
        hashed AS (SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM bytes, bits),
        cut AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
        shorter AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
        pairs AS (SELECT DISTINCT a.word AS a, b.word AS b FROM shorter a JOIN shorter b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
                  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.s = w.word UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.s = w.word),
        near AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, encode(b)) AS best, max(n) AS best_n FROM pairs JOIN words ON word = b GROUP BY 1),
        forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM words LEFT JOIN near USING (word)),
        steps AS (SELECT word, word AS root FROM forms UNION ALL SELECT steps.word, f.form FROM steps JOIN forms f ON f.word = steps.root WHERE f.form IS NOT NULL),
        ends AS (SELECT steps.word, steps.root FROM steps JOIN forms f ON f.word = steps.root WHERE f.form IS NULL)
        SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN ends USING (word)""",
    "op13_negatives": """
        WITH v AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), true))) = 0),
        scores AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
        ranked AS (SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INT) AS rank, other AS negative_id, positive_score, score AS negative_score
                   FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
        SELECT * FROM ranked WHERE rank <= 5""",
}


def oracle_sql() -> dict[str, str]:
    """For the queries that SQL can express; the others are tested against brute force in tests/llm."""
    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
