"""The registered opN queries: thin digests of the operators' results over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import (
    decontaminate,
    hard_negatives,
    licenses,
    lines,
    mixing,
    neighbours,
    quality,
    ranked,
    shards,
    simhash,
    toxicity,
    transducer,
    warc,
)
from rankloom.llm.registry import query, table
from rankloom.session import scratch_path

#: Lower-casing of A-Z and the words of the contracts, for DuckDB.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
    b AS (SELECT item_id, {WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
    iw AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS n,
        array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
    dw AS (
      SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
    hits AS (SELECT r, i, n, item_id FROM dw JOIN iw USING (n, win)),
    covered AS (SELECT r, count(*) AS n_hit FROM (
      SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
    named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (
      SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
    """
)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, items, unnamed=True)
    names = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    words = F.col("base_places.word")
    base, more = F.col("base_places.label"), F.col("notices.label")
    # A base phrase alone is a weak sign; an aligned notice counts by its matched share.
    notice = F.coalesce(F.array_max("notices.share"), F.lit(0.0))
    weak = F.when(F.size("base_places") > 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, more))), ",").alias("labels"),
        F.greatest(notice, weak).alias("score"),
    )


@query()
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), "component_id")


TOKENIZER = "piece_bpe_32k.model"
CONTEXT = 4096


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = transducer.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return found.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


@query(
    """
    WITH n AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    good AS (
      SELECT r FROM (SELECT r, unnest(e) AS x FROM n) GROUP BY r
      HAVING bool_and(coalesce(isfinite(x), false)) AND bool_or(x <> 0)),
    v AS (SELECT vec_id, e FROM n JOIN good USING (r) WHERE vec_id IS NOT NULL),
    pairs AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
      FROM pairs)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """
)
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query(
    """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
    kept AS (
      SELECT digest, max(page_id) AS kept FROM p WHERE size >= 1000 GROUP BY digest HAVING count(*) > 1)
    SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
      CASE WHEN kept IS NULL OR page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> kept THEN kept END AS refers_to
    FROM p LEFT JOIN kept USING (digest)
    """
)
def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.with_revisits(table(spark, sf_dir, "pages"))
    path = warc.write_warc(rows, scratch_path(spark, "warc"))
    return warc.payload_summary(warc.read_warc(spark, path))


@query(
    f"""
    WITH p AS (
      SELECT row_number() OVER () AS r, page_id,
        nullif(lower(regexp_extract(url, '{lines.HOST}', 1)), '') AS host,
        regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
          '{lines.UNSEEN}', chr(10), 'g'), '{lines.INLINE}', '', 'g'), '{lines.TAG}', chr(10), 'g') AS body
      FROM pages),
    split AS (SELECT r, unnest(string_split_regex(body, '{lines.BREAK}')) AS raw,
        unnest(range(len(string_split_regex(body, '{lines.BREAK}')))) AS i FROM p),
    l AS (SELECT r, host, i, trim(raw, ' ' || chr(9)) AS line FROM split JOIN p USING (r)
        WHERE trim(raw, ' ' || chr(9)) <> ''),
    totals AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
    common AS (
      SELECT host, line FROM (SELECT host, line, count(DISTINCT r) AS holding FROM l GROUP BY ALL)
      JOIN totals USING (host) WHERE holding >= {lines.LEAST} AND holding > {lines.RATIO} * pages),
    kept AS (
      SELECT l.r, count(*) AS n_lines, count(c.line) AS n_dropped,
        string_agg(l.line, chr(10) ORDER BY i) FILTER (c.line IS NULL) AS text
      FROM l LEFT JOIN common c ON l.host = c.host AND l.line = c.line GROUP BY l.r)
    SELECT page_id, host, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
      coalesce(text, '') AS text
    FROM p LEFT JOIN kept USING (r)
    """
)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = lines.drop_boilerplate(pages, lines.host(F.col("url")), lines.html_text(F.col("html")))
    return found.select("page_id", "host", "n_lines", "n_dropped", F.col("kept_text").alias("text"))


#: Token weights of the language domains; documents in ``labels`` lend their language tags.
LANGUAGES = {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11}


def language_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents."""
    named = labels.select("doc_id").where("doc_id IS NOT NULL").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(named, "doc_id", "left_semi")


@query()
def op2_mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = mixing.rates(docs, language_labels(docs, table(spark, sf_dir, "labels")), LANGUAGES)
    shares = [F.round(F.col("p")[i], 9).alias(f"p_{d}") for i, d in enumerate(LANGUAGES)]
    return found.select("doc_id", "n_tokens", "copies", *shares, F.round("rate", 9).alias("rate"))


@query()
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.round("weak", 6).alias("weak"), F.round("score", 6).alias("score"), "keep")


RANKS = "byte_bpe_50k.tiktoken"


def training_shards(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the shards of ``docs`` to the shared folder and return their index."""
    import public_tokenizers

    index, _ = shards.write_shards(docs, scratch_path(spark, "training"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return index


@query()
def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_shards(spark, table(spark, sf_dir, "documents"))


@query(
    f"""
    WITH t AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
    d AS (SELECT r, doc_id, w, len(w) AS n FROM t WHERE len(w) > 0),
    c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM d),
    q AS (SELECT DISTINCT item_id, unnest({WORDS.format("coalesce(text, '')")}) AS term FROM benchmark),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY r, term),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, c GROUP BY term),
    impact AS (
      SELECT r, doc_id, term, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words))) AS s
      FROM tf JOIN w USING (term) JOIN d USING (r), c),
    scored AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(s) AS BIGINT) AS score
      FROM impact JOIN q USING (term) GROUP BY item_id, r),
    ranked AS (SELECT item_id, doc_id, score,
        CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """
)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


@query()
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query(
    """
    WITH n AS (
      SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        CAST(embedding AS DOUBLE[]) AS e
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
    bad AS (SELECT DISTINCT r FROM (SELECT r, unnest(e) AS x FROM n) WHERE NOT coalesce(isfinite(x), false)),
    v AS (SELECT r, vec_id, label, list_transform(e, lambda x: floor(256 * x)) AS e FROM n WHERE r NOT IN (SELECT r FROM bad)),
    s AS (
      SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
        CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.e) = len(c.e)),
    p AS (
      SELECT anchor_id, id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place
      FROM s WHERE same QUALIFY place <= 5),
    ranked AS (
      SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
        CAST(row_number() OVER (PARTITION BY anchor_id, place ORDER BY score DESC, id) AS INTEGER) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, shifted)
