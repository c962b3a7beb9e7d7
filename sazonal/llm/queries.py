"""The corpus operators as queries on the given tables, beside the same in SQL where it can
say it."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import (
    bin_completion, class_ngram, exact_dedup, forest_search, html_extract, license_scan,
    lsh_forest, mixture_packing, neighbour_quality, phrase_trie, pivotal_mix, prefix_refinement,
    url_filter,
)
from .common import fold_of, ship, table

QUERIES: dict = {}
SQL: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(sql: str | None = None):
    def register(function):
        @functools.wraps(function)
        def run(spark, sf_dir):
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql:
            SQL[function.__name__] = sql
        return run

    return register


@query()
def op1_class_ngram(spark, sf_dir) -> DataFrame:
    return class_ngram.score(table(spark, sf_dir, "documents"))


@query()
def op2_forest_search(spark, sf_dir) -> DataFrame:
    found = forest_search.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query()
def op3_bin_completion(spark, sf_dir) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return bin_completion.pack(table(spark, sf_dir, "documents"), path).drop("row_id")


@query()
def op4_neighbour_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = neighbour_quality.training_rows(table(spark, sf_dir, "labels"))
    model = neighbour_quality.fit_quality(docs, labels)
    scored = neighbour_quality.score_quality(docs, model, columns=["doc_id"])
    doc_id = F.col("row.doc_id")
    return scored.select(
        doc_id.alias("doc_id"), (fold_of(doc_id, 3) == 1).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op5_pivotal_mix(spark, sf_dir) -> DataFrame:
    mixed = pivotal_mix.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


@query("""
    WITH texts AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS norm
        FROM documents),
    groups AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY norm)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM texts JOIN groups USING (norm)""")
def op6_exact_dedup(spark, sf_dir) -> DataFrame:
    rows = exact_dedup.deduplicate(table(spark, sf_dir, "documents")).rows
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query(r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS MATERIALIZED (
        SELECT doc_id, list_distinct(CASE
            WHEN len(w) = 0 THEN []::VARCHAR[]
            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        END) AS s FROM words),
    shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
    links AS MATERIALIZED (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM sets
        UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
    SELECT doc_id, CAST(any_value(len(s)) AS BIGINT) AS n_shingles, min(other) AS component_id,
           doc_id = min(other) AS kept
    FROM sets JOIN reach USING (doc_id) GROUP BY doc_id""")
def op7_lsh_forest(spark, sf_dir) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query()
def op8_url_filter(spark, sf_dir) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query()
def op9_html_extract(spark, sf_dir) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    templates = ", ".join(
        f"({at}, {_quoted(name)}, {_quoted(text)})"
        for at, (name, text) in enumerate(license_scan.TEMPLATES)
    )
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = "unnest(regexp_extract_all(" + lower + ", '[a-z0-9]+'))"

    def best(name: str, units: str, least: float) -> str:
        return f"""
    {name}_counts AS (SELECT doc_id, part, term, count(*) AS n FROM {units} GROUP BY ALL),
    {name}_norms AS (
        SELECT doc_id, part, sqrt(sum((n * coalesce(w, (SELECT other FROM others))) ** 2)) AS norm
        FROM {name}_counts LEFT JOIN weights USING (term) GROUP BY ALL),
    {name}_dots AS (
        SELECT doc_id, part, license, sum(n * w * share) AS dot
        FROM {name}_counts JOIN weights USING (term) JOIN shares USING (term) GROUP BY doc_id, part, template, license),
    {name} AS (
        SELECT doc_id, arg_min(license, (-cosine, license)) AS license, max(cosine) AS cosine FROM (
            SELECT doc_id, license, round(dot / norm, 6) AS cosine
            FROM {name}_dots JOIN {name}_norms USING (doc_id, part))
        WHERE cosine >= {least} GROUP BY doc_id)"""

    return f"""
    WITH templates(template, license, body) AS (VALUES {templates}),
    bags AS (
        SELECT template, license, term, count(*) AS n
        FROM (SELECT template, license, {terms.format("body")} AS term FROM templates) GROUP BY ALL),
    others AS (SELECT 1 + ln(1 + count(*)) AS other FROM templates),
    weights AS (
        SELECT term, 1 + ln((1 + (SELECT count(*) FROM templates)) / (1 + count(*))) AS w
        FROM bags GROUP BY term),
    shares AS (
        SELECT template, license, term,
               n * w / sqrt(sum((n * w) ** 2) OVER (PARTITION BY template)) AS share
        FROM bags JOIN weights USING (term)),
    files AS (
        SELECT doc_id, source || '/' || lang || '/' || (doc_id // 50) || '/' AS leaf,
               source || '/' || lang || '/' || (doc_id // 50) || '/' || doc_id || '.txt' AS path,
               coalesce(text, '') AS text FROM documents),
    lines AS (
        SELECT doc_id, part, {terms.format("content")} AS term FROM (
            SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS part,
                   unnest(string_split(text, chr(10))) AS content FROM files)),
    whole_terms AS (SELECT doc_id, 0 AS part, {terms.format("text")} AS term FROM files),
    {best("header", "lines", license_scan.HEADER)},
    {best("whole", "whole_terms", license_scan.FILE)},
    holders AS (
        SELECT leaf AS directory, arg_min(license, (-cosine, license)) AS license, max(cosine) AS cosine
        FROM whole JOIN files USING (doc_id) WHERE leaf IS NOT NULL GROUP BY leaf),
    nearest AS (
        SELECT doc_id, arg_max(directory, length(directory)) AS directory,
               arg_max(license, length(directory)) AS license, arg_max(cosine, length(directory)) AS cosine
        FROM files JOIN holders ON starts_with(files.path, holders.directory) GROUP BY doc_id)
    SELECT f.doc_id, f.path, coalesce(h.license, w.license, n.license) AS license,
           coalesce(h.cosine, w.cosine, n.cosine) AS cosine,
           CASE WHEN h.license IS NOT NULL THEN 'header' WHEN w.license IS NOT NULL THEN 'file'
                WHEN n.license IS NOT NULL THEN 'directory' END AS via,
           CASE WHEN h.license IS NULL AND w.license IS NULL THEN n.directory END AS origin
    FROM files f LEFT JOIN header h USING (doc_id) LEFT JOIN whole w USING (doc_id)
    LEFT JOIN nearest n USING (doc_id)"""


@query(_license_sql())
def op10_license_scan(spark, sf_dir) -> DataFrame:
    """Documents as files of a tree: source, language and fifty ids to a folder."""
    doc_id = F.col("doc_id")
    folder = F.floor(doc_id / 50).cast("long").cast("string")
    path = F.concat_ws(
        "/", "source", "lang", folder, F.concat(doc_id.cast("string"), F.lit(".txt"))
    )
    given = F.col("source").isNotNull() & F.col("lang").isNotNull() & doc_id.isNotNull()
    return license_scan.scan_licenses(
        table(spark, sf_dir, "documents"), doc_id, F.when(given, path), F.col("text")
    ).withColumnRenamed("id", "doc_id")


@query()
def op11_mixture_packing(spark, sf_dir) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return mixture_packing.pack_mixture(table(spark, sf_dir, "documents"), path).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset", "source",
    )


@query(r"""
    WITH texts AS MATERIALIZED (
        SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
        FROM documents),
    words AS (
        SELECT row, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') AS term FROM texts),
    counted AS MATERIALIZED (
        SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs FROM words GROUP BY ALL),
    kept AS MATERIALIZED (
        SELECT lang, term, sum(n)::HUGEINT AS n FROM counted GROUP BY ALL HAVING sum(docs) >= 10),
    groups AS (SELECT DISTINCT lang, source FROM texts),
    sizes AS (
        SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total
        FROM groups g LEFT JOIN (SELECT counted.* FROM counted JOIN kept USING (lang, term)) c
            USING (lang, source) GROUP BY ALL),
    langs AS (SELECT lang, count(*)::HUGEINT AS kept, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
    shares AS MATERIALIZED (
        SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
               1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.total + 2 * l.kept) AS p
        FROM sizes s JOIN langs l USING (lang) JOIN kept k USING (lang)
        LEFT JOIN counted c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item,
               sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL),
    all_pairs AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
    overused AS (
        SELECT s.lang, s.source, s.term AS item, ((s.p - q) * (s.p - q)) // (s.p + q) AS value
        FROM shares s JOIN (
            SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.kept) AS q
            FROM kept k JOIN langs l USING (lang)) o USING (lang, term)
        WHERE s.n > 0 AND s.p > q),
    both_parts AS (SELECT *, 'pair' AS part FROM all_pairs UNION ALL SELECT *, 'term' AS part FROM overused)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
        FROM both_parts)
    WHERE part = 'pair' OR rank <= 10""")
def op12_prefix_refinement(spark, sf_dir) -> DataFrame:
    return prefix_refinement.divergence(table(spark, sf_dir, "documents"))


@query(r"""
    WITH texts AS MATERIALIZED (
        SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    pieces AS MATERIALIZED (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM texts),
    totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
    grams AS (
        SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i
        FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m),
    counts AS MATERIALIZED (
        SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*)::HUGEINT AS f
        FROM grams GROUP BY ALL HAVING count(*) >= 100),
    split AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE m > 1),
    cuts AS (
        SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first,
               array_to_string(w[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, m)) AS k FROM split)),
    scored AS (
        SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, (1000 * c.a * n) // (x.f * y.f) AS score,
               row_number() OVER (PARTITION BY c.lang, c.phrase
                                  ORDER BY (1000 * c.a * n) // (x.f * y.f), k) AS cut
        FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first
        JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang),
    inner_parts AS (
        SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(f) AS longer
        FROM (SELECT *, unnest(range(1, m - size + 2)) AS i
              FROM (SELECT *, unnest(range(2, m)) AS size FROM split)) GROUP BY ALL),
    kept AS (
        SELECT s.* FROM scored s LEFT JOIN inner_parts i USING (lang, phrase)
        WHERE cut = 1 AND (i.longer IS NULL OR 100 * i.longer < 100 * s.a))
    SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
           score::BIGINT AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
          FROM kept) WHERE rank <= 2000""")
def op13_phrase_trie(spark, sf_dir) -> DataFrame:
    return phrase_trie.collocations(table(spark, sf_dir, "documents"))
