"""Registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_pipeline import ORACLE_SQL, run
from postlens.llm.crf_language import identify_languages, train_field, training_pieces
from postlens.llm.decontaminate import find_contamination
from postlens.llm.exact_dedup import exact_duplicates
from postlens.llm.filter_audit import audit_filters, document_failures
from postlens.llm.frames import utf8
from postlens.llm.hilbert_shards import shard_by_curve
from postlens.llm.mixing import mix_sources, source_rates
from postlens.llm.near_dedup import near_duplicates
from postlens.llm.periodic_runs import periodic_runs
from postlens.llm.secret_scan import BASE_RULES, scan_secrets, span_text
from postlens.llm.substring_dedup import remove_repeats
from postlens.llm.suffix_lm import score_documents, train
from postlens.llm.token_shards import materialise_order
from postlens.llm.warc_zip import archive_pages, read_records, row_id

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query(
    "op1_decontaminate",
    rf"""
    WITH items AS (
        SELECT CAST(item_id AS VARCHAR) AS item,
               regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark WHERE item_id IS NOT NULL),
    windows AS (
        SELECT DISTINCT item, 10 AS n, array_to_string(w[p:p + 9], ' ') AS passage
        FROM (SELECT item, w, unnest(range(1, len(w) - 8)) AS p FROM items WHERE len(w) >= 10)
        UNION
        SELECT DISTINCT item, len(w), array_to_string(w, ' ') FROM items WHERE len(w) BETWEEN 1 AND 9),
    docs AS (
        SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    places AS (
        SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS passage
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
              FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    hits AS (SELECT doc_id, p, n, item FROM places JOIN windows USING (n, passage)),
    covered AS (
        SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
    found AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, _read(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@_query("op2_crf_language")
def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"))
    field = train_field(training_pieces(docs.filter("NOT held_out"), "lang", "text"))
    return identify_languages(docs, field, carry=["doc_id", "held_out"])


@_query(
    "op3_substring_dedup",
    r"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS passage
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM docs WHERE len(w) >= 35)),
    twice AS (SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS q FROM windows SEMI JOIN twice USING (passage)),
    lost AS (SELECT doc_id, list(q) AS qs FROM gone GROUP BY doc_id),
    left_over AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS kept
        FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM docs)
        ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(len(qs), 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM docs LEFT JOIN lost USING (doc_id) LEFT JOIN left_over USING (doc_id)
    """,
)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = remove_repeats(docs, carry=["doc_id"], digest=True)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


@_query("op4_hilbert_shards")
def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_curve(_read(spark, sf_dir, "documents"), carry=["doc_id"])


@_query(
    "op5_near_dedup",
    rf"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 4], ' ')) AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM docs WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
        FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id < y.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM docs
        UNION
        SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
    smallest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM smallest LEFT JOIN sizes USING (doc_id)
    """,
)
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents").select("doc_id", "text"), carry=())


@_query("op6_token_shards")
def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise_order(_read(spark, sf_dir, "documents").select("doc_id", "text"))


@_query(
    "op7_exact_dedup",
    r"""
    WITH base AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents)
    SELECT doc_id, text_sha256,
           first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) = 1 AS kept
    FROM base
    """,
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_read(spark, sf_dir, "documents").select("doc_id", "text"), carry=())


@_query(
    "op8_mix_sources",
    """
    WITH sizes AS (SELECT source, count(*) AS documents FROM documents GROUP BY source),
    rates AS (
        SELECT source, pow(documents, 0.7) * sum(documents) OVER () / sum(pow(documents, 0.7)) OVER () / documents AS rate
        FROM sizes),
    draws AS (
        SELECT d.*, rate,
               CAST('0x' || substr(md5('20240607|' || doc_id || '|1'), 1, 13) AS BIGINT) / pow(2, 52) AS u
        FROM documents d JOIN rates USING (source)),
    steps AS (
        SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS total
        FROM (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM rates, range(0, 200) r(k))),
    counts AS (
        SELECT doc_id, count(total) AS n FROM draws LEFT JOIN steps ON steps.source = draws.source AND total <= u
        GROUP BY doc_id)
    SELECT doc_id, text, lang, d.source, n_chars, unnest(range(1, n + 1)) AS replica
    FROM documents d JOIN counts USING (doc_id)
    """,
)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return mix_sources(docs, source_rates(docs)).select(*docs.columns, F.col("replica").cast("bigint").alias("replica"))


@_query("op9_suffix_tree_lm")
def op9_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"))
    trained = train(docs.filter("NOT held_out").select(utf8(F.col("text")).alias("text")))
    return score_documents(docs, trained, carry=["doc_id", "held_out"])


def _count_of(kind: str) -> Column:
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind))


@_query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["rank"] < len(BASE_RULES))
    counts = [_count_of(rule.kind).cast("bigint").alias(f"n_{rule.kind}") for rule in BASE_RULES]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans")
    )


@_query(
    "op11_filter_audit",
    r"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    first AS (SELECT text, min(doc_id) AS least FROM docs GROUP BY text),
    marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
    failures AS (
        SELECT part,
               CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
               || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
               || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
               || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
               || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS mask,
               coalesce(quality = 1, FALSE) AS good, coalesce(toxic = 1, FALSE) AS toxic
        FROM docs JOIN first USING (text) LEFT JOIN marks USING (doc_id)),
    counted AS (
        SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
        FROM failures GROUP BY part, mask),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
    orders AS (
        SELECT letter AS filter_order FROM letters
        UNION ALL
        SELECT filter_order || letter FROM orders, letters WHERE NOT contains(filter_order, letter)),
    places AS (
        SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
        FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders WHERE length(filter_order) = 5)),
    audited AS (
        SELECT part, filter_order, step, f, mask, n, good, toxic, contains(mask, f) AS fails,
               translate(mask, before, '') <> mask AS gone
        FROM counted, places),
    steps AS (
        SELECT part, filter_order, step, f,
               coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS kept,
               coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS removed,
               coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS redundant,
               coalesce(sum(n) FILTER (WHERE mask = f), 0) AS unique_fails,
               coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS good_lost,
               coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS toxic_lost
        FROM audited GROUP BY part, filter_order, step, f)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
    FROM steps
    """,
)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit_filters(document_failures(docs, _read(spark, sf_dir, "labels")), "part", marks=("good", "toxic"))


def _planted_periods(text: Column, number: Column) -> Column:
    """Text of which, for one id in ten, the words from the a-th on repeat the next p ones, as op12's contract has it."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words, n = F.split(trimmed, "[ \t-\r]+"), F.size(F.split(trimmed, "[ \t-\r]+"))
    g = F.floor(number / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycles = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, 1, a), F.slice(cycles, 1, n - a)), " ")
    return F.when((number % 10 == 0) & (trimmed != ""), planted).otherwise(text)


@_query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic_runs(docs, _planted_periods(F.col("text"), number), carry=["doc_id"], digest=True)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("b"), lines.alias("lines"), "collapsed").select(
        "doc_id",
        "n_runs",
        (-F.col("b.s")).alias("start"),
        F.col("b.length").alias("length"),
        (-F.col("b.p")).alias("period"),
        F.floor(1000 * F.col("b.length") / -F.col("b.p")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )


@_query(
    "op13_warc_zip",
    """
    WITH records AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM records)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
    FROM firsts
    """,
)
def op13_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_records(archive_pages(_read(spark, sf_dir, "pages")), payloads=False)
    return records.select(
        row_id(F.col("record_id")).cast("bigint").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        row_id(F.col("refers_to")).cast("bigint").alias("refers_to"),
    )


QUERIES["pipeline"] = run
if ORACLE_SQL is not None:
    ORACLES["pipeline"] = ORACLE_SQL
