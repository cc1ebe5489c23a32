"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsmith.llm import (decontaminate, fingerprints, hard_negatives, language_id, license_scan, mixing, simhash_dedup,
                           suffix_dedup, token_alignment, token_binary, token_counts, toxicity, url_filters)
from gridsmith.llm.common import LOWER, UPPER, small_batches
from gridsmith.session import shared_dir
from gridsmith.sources.tables import read_table

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"))
    rules = spark.createDataFrame(list(RULES), "rule string, verdict string")
    return url_filters.url_filter(read_table(spark, sf_dir, "pages", ["page_id", "url"]), labels, rules)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]).withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    model = language_id.train(docs.where(~F.coalesce("held_out", F.lit(False))))
    return language_id.predict(docs, model, language_id.Params(), "doc_id", "held_out")


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return rows.select("doc_id", simhash_dedup.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


#: Edits of a document of n code points: 20 go at n / 4, its first 30 come in at n / 2, 10 at 3 n / 4 are replaced.
EDIT_COLUMN = """array(named_struct('start', n div 4, 'length', 20, 'insert', ''),
                       named_struct('start', n div 2, 'length', 0, 'insert', substr(text, 1, 30)),
                       named_struct('start', 3 * n div 4, 'length', 10, 'insert', 'Edited, 2nd time'))"""


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    trees = token_counts.build_trees(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), vocabulary, "doc_id")
    trees = trees.withColumn("n", F.char_length(F.coalesce("text", F.lit("")))).withColumn("edits", F.expr(EDIT_COLUMN)).drop("n")
    return token_counts.apply_edits(trees, vocabulary, "edits", "doc_id").select(
        "doc_id", "n_tokens", "n_tokens_edited", "n_segments", "n_encoded")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_matches(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                      read_table(spark, sf_dir, "benchmark"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.drawn(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source", "lang"]))
    return rows.select("doc_id", "source", "lang", "mix.topic", "mix.n_tokens", F.round("mix.raked", 9).alias("raked_weight"),
                       F.round("mix.weight", 9).alias("probability"), (F.col("mix.copies") > 0).alias("kept"))


TOKENIZER, END_ID, VOCABULARY = "word_bpe_49k.json", 2, 49_408


def op8_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token_ids")
    token_binary.write_ids(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), path,
                           public_tokenizers.path(TOKENIZER), END_ID, token_binary.bits_for(VOCABULARY))
    return token_binary.read_documents(spark, path)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    names = lambda c: F.concat_ws(",", F.sort_array(F.array_distinct(c)))
    base, more = F.col("phrase_hits"), F.col("template_hits")
    labels = names(F.concat(base["label"], more["label"]))
    return rows.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                       F.array_min(base["first"]).alias("first_word"), F.array_max(base["first"]).alias("last_word"),
                       names(base["label"]).alias("base_labels"), labels.alias("labels"),
                       F.when(labels != "", 1.0).otherwise(0.0).alias("score"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]))
    return toxicity.score(docs, model).withColumnRenamed("rejected", "toxic")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_alignment.align(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                 public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        hard_negatives.scaled("embedding", 256).alias("vec"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def bounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(small_batches(spark), sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: bounded(f) for f in (
    op1_url_filters, op2_language_id, op3_simhash_dedup, op4_token_counts, op5_benchmark_decontamination,
    op6_document_fingerprints, op7_source_mixing, op8_token_binary, op9_license_scan, op10_toxicity,
    op11_suffix_dedup, op12_token_alignment, op13_hard_negatives)}

URL_PARTS_SQL = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', {})"


def shrunk_sql(name: str, rows: str, p: url_filters.Params) -> str:
    """CTEs ``name``: ``rows`` (n, k, prior and more) with the posterior mean and sd under the estimated strength."""
    return f"""
    {name}_rows AS ({rows}),
    {name}_sums AS (SELECT sum(pow(k / n - prior, 2)) AS s, sum(prior * (1 - prior) / n) AS v, sum(prior * (1 - prior) * (1 - 1 / n)) AS w
                    FROM {name}_rows WHERE n > 0),
    {name}_m AS (SELECT CASE WHEN s IS NULL OR coalesce(w, 0) = 0 OR (s - v) / w <= 0 THEN {p.max_strength}
                        ELSE least({p.max_strength}, greatest({p.min_strength}, w / (s - v) - 1)) END AS m FROM {name}_sums),
    {name}_ab AS (SELECT r.*, k + m * prior AS a, n - k + m * (1 - prior) AS b FROM {name}_rows r, {name}_m),
    {name} AS (SELECT *, a / (a + b) AS mean, sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS sd FROM {name}_ab)"""


def op1_sql(p: url_filters.Params = url_filters.Params()) -> str:
    two = f"regexp_matches(host, '{url_filters.TWO_LABELS}')"
    rules = ", ".join(f"('{r}', '{r.split('/')[0]}', '{r[r.index('/'):]}', '{v}')" for r, v in RULES)
    last = lambda n: f"array_to_string(string_split(host, '.')[-{n}:], '.')"
    return f"""
    WITH outcome AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
                     FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
    page AS (SELECT page_id, translate({URL_PARTS_SQL.format(1)}, '{UPPER}', '{LOWER}') AS host, {URL_PARTS_SQL.format(2)} AS path
             FROM pages),
    counted AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k FROM page LEFT JOIN outcome USING (page_id) GROUP BY 1),
    host AS (SELECT *, CASE WHEN {two} THEN {last(2)} ELSE {last(1)} END AS suffix,
                    CASE WHEN {two} THEN {last(3)} ELSE {last(2)} END AS domain FROM counted),
    overall AS (SELECT (coalesce(sum(k), 0) + {p.prior_rate}) / (coalesce(sum(n), 0) + 1.0) AS prior FROM host),
    {shrunk_sql("suffixes", "SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT prior FROM overall) AS prior FROM host GROUP BY 1", p)},
    {shrunk_sql("domains", "SELECT d.*, s.mean AS prior FROM (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM host GROUP BY 1, 2) d JOIN suffixes s USING (suffix)", p)},
    {shrunk_sql("hosts", "SELECT h.*, d.mean AS prior FROM host h JOIN domains d USING (suffix, domain)", p)},
    rule(rule, top, below, verdict) AS (VALUES {rules}),
    best AS (SELECT x.host, x.path, max({{'n': length(rule), 'v': verdict, 'r': rule}}) AS best
             FROM (SELECT DISTINCT host, path FROM page) x
             JOIN rule ON (x.host = top OR ends_with(x.host, '.' || top)) AND starts_with(x.path, below) GROUP BY 1, 2)
    SELECT page_id, host, path, best.r AS rule,
           coalesce(best.v, CASE WHEN mean - {p.z} * sd >= {p.block_from} THEN 'block' ELSE 'allow' END) AS verdict,
           n::BIGINT AS n_labelled, k::BIGINT AS n_bad, round(mean, 6) AS bad_rate, round(mean - {p.z} * sd, 6) AS bad_rate_bound
    FROM page JOIN hosts USING (host) LEFT JOIN best USING (host, path)"""


def op13_sql(p: hard_negatives.Params = hard_negatives.Params()) -> str:
    return f"""
    WITH valid AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pair AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
             FROM valid a JOIN valid r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
    positive AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pair WHERE same
                 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {p.positives}),
    ranked AS (SELECT anchor_id, positive_id,
                      (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
                      other_id AS negative_id, positive_score, score AS negative_score
               FROM positive JOIN pair USING (anchor_id)
               WHERE NOT same AND {p.low} * positive_score <= 100 * score AND 100 * score <= {p.high} * positive_score)
    SELECT * FROM ranked WHERE rank <= {p.negatives}"""


#: SQL has no XXH64, tokenizer, automaton or learned model: the other operators are held against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {"op1_url_filters": op1_sql(), "op13_hard_negatives": op13_sql()}
