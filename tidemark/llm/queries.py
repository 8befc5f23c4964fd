"""The queries of this subpackage over the given tables, with SQL where SQL can tell."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import centroids, line_crf, nbsvm, queries_sql, whitening
from tidemark.llm.decontaminate import contaminated, find_passages, item_digest
from tidemark.llm.interleave import SEED, SHARDS, shard_rows
from tidemark.llm.license_scan import scan_licences
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixture import mix
from tidemark.llm.separator_scan import scan_token_files, write_token_files
from tidemark.llm.sketch_join import Similarity, near_duplicates
from tidemark.llm.tree_bpe import round_trip_digests
from tidemark.llm.url_rules import MIN_CONFIDENCE, MIN_COUNT, filter_urls
from tidemark.sources.files import scratch_path

#: For texts in several languages; the id after its last one is free and ends documents.
MULTI_VOCABULARY, SEPARATOR = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), 50_256
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_crf(spark, sf_dir):
    """Counts and verdicts of every document; the field is trained on labelled documents
    outside the held-out fold."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = line_crf.train(documents, labels.filter(nbsvm.fold("doc_id") != 0))
    judged = line_crf.judge(documents, model)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "content_share",
    )


def op2_sketch_join(spark, sf_dir):
    """Groups of near copies: four-word shingles, Jaccard similarity of 85 in 100."""
    found = near_duplicates(_table(spark, sf_dir, "documents"), Similarity(4, 85, 100))
    return found.drop("text_hash", "component_text")


def op3_line_dedup(spark, sf_dir):
    """Every document without the lines that stand earlier: up to two edits from 48 characters
    on, one from 32, and equal ones of any length, blank ones aside."""
    return dedup_lines(_table(spark, sf_dir, "documents"), short_lines=True)


def op4_url_rules(spark, sf_dir):
    """Verdicts on every page's URL."""
    found = filter_urls(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op5_interleave(spark, sf_dir):
    """Every document's shard and place in it."""
    return shard_rows(_table(spark, sf_dir, "documents"))


def op6_nbsvm(spark, sf_dir):
    """Scores of every document, learnt from labelled documents outside the held-out fold."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = nbsvm.train(documents, labels.filter(nbsvm.fold("doc_id") != 0))
    scored = nbsvm.score(documents, model)
    held_out = (nbsvm.fold("doc_id") == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op7_separator_scan(spark, sf_dir):
    """Tokens of every document, counted in flat files that all documents were written to."""
    path = scratch_path(spark, "token_files")
    documents = _table(spark, sf_dir, "documents")
    write_token_files(documents, path, MULTI_VOCABULARY, public_tokenizers.PATTERN, SEPARATOR)
    found = scan_token_files(spark, path, SEPARATOR)
    return found.select(F.col("id").alias("doc_id"), "n_tokens")


def op8_tree_bpe(spark, sf_dir):
    """Tokens of every document by the tree of joins, decoded again."""
    return round_trip_digests(
        _table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN
    )


def op9_decontaminate(spark, sf_dir):
    """Benchmark passages in every document."""
    found = find_passages(
        _table(spark, sf_dir, "documents"),
        _table(spark, sf_dir, "benchmark"),
        keep=["doc_id"],
        spans=False,
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        item_digest().alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def op10_license_scan(spark, sf_dir):
    """Licence phrases and texts in every document."""
    return scan_licences(_table(spark, sf_dir, "documents")).drop("spans")


def op11_qdwh_whitening(spark, sf_dir):
    """Every vector whitened: one row per vector and component."""
    vectors = _table(spark, sf_dir, "embeddings")
    model = whitening.fit_whitening(vectors)
    return whitening.described(whitening.whiten(vectors, model, keep=["vec_id"]), model)


def op12_centroids(spark, sf_dir):
    """The cluster of every vector after five rounds."""
    assigned, clusters = centroids.cluster(_table(spark, sf_dir, "embeddings"))
    found = centroids.described(assigned, clusters)
    return found.withColumnRenamed("id", "vec_id").drop("row")


def op13_pivotal_mix(spark, sf_dir):
    """How many words of every document the mix of sources takes."""
    mixed = mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def queries():
    import corpus_pipeline  # imports this subpackage in turn

    return {
        "pipeline": corpus_pipeline.run,
        "op1_line_crf": op1_line_crf,
        "op2_sketch_join": op2_sketch_join,
        "op3_line_dedup": op3_line_dedup,
        "op4_url_rules": op4_url_rules,
        "op5_interleave": op5_interleave,
        "op6_nbsvm": op6_nbsvm,
        "op7_separator_scan": op7_separator_scan,
        "op8_tree_bpe": op8_tree_bpe,
        "op9_decontaminate": op9_decontaminate,
        "op10_license_scan": op10_license_scan,
        "op11_qdwh_whitening": op11_qdwh_whitening,
        "op12_centroids": op12_centroids,
        "op13_pivotal_mix": op13_pivotal_mix,
    }


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWER_WORDS = "coalesce(" + _WORDS.format(_LOWER.format("text")) + ", [])"

_DECONTAMINATE = f"""
    WITH item AS (SELECT item_id, {_LOWER_WORDS} AS w FROM benchmark),
    sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM item WHERE len(w) > 0),
    windows AS (
        SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
        FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS i FROM sized)),
    doc AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
    placed AS (
        SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
        FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
              FROM doc, (SELECT DISTINCT k FROM sized))),
    hits AS (SELECT doc_id, i, k, item_id FROM placed JOIN windows USING (k, gram)),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY 1),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_INTERLEAVE = f"""
    WITH bits AS (
        SELECT i, list_reduce(
            range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i) AS v FROM range(256) r(i)),
    crc_table AS (SELECT list(CAST(v AS BIGINT) ORDER BY i) AS t FROM bits),
    rows_of AS (
        SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
               list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                              lambda h: CAST('0x' || h AS BIGINT)) AS bytes,
               coalesce('=' || source, '') AS source
        FROM documents),
    checked AS (
        SELECT doc_id, size, source,
               xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]),
                               CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS crc
        FROM rows_of, crc_table),
    summed AS (
        SELECT *, md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || size || '|' || crc)
                  AS key
        FROM checked),
    ranked AS (
        SELECT *, CAST(2 * row_number() OVER (
                   PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size, crc) - 1 AS DOUBLE)
               / CAST(2 * count(*) OVER (PARTITION BY source) AS DOUBLE) AS share
        FROM summed),
    placed AS (
        SELECT *, row_number() OVER (
                   ORDER BY share, source, key, doc_id NULLS FIRST, size, crc) - 1 AS place,
               count(*) OVER () AS n
        FROM ranked)
    SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'rows' AS law,
           CAST(place * {SHARDS} // n AS INTEGER) AS shard,
           CAST(place - (place * {SHARDS} // n * n + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot,
           CAST(NULL AS INTEGER) AS grown_shard
    FROM placed
"""

_SKETCH_JOIN = rf"""
    WITH RECURSIVE doc AS (
        SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format('text')},
            '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    shingle AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
        FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i
              FROM doc WHERE len(w) > 0)),
    sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    link AS (
        SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
        WHERE 100 * c >= 85 * (x.n + y.n - c)),
    edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
    reach AS (
        SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
    least AS (SELECT a AS doc_id, min(b) AS other FROM reach GROUP BY 1)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id
    FROM doc LEFT JOIN sized USING (doc_id) LEFT JOIN least USING (doc_id)
"""

_LINE_DEDUP = r"""
    WITH alphabet AS (
        SELECT c, row_number() OVER (ORDER BY c) AS k FROM (
            SELECT DISTINCT unnest(regexp_extract_all(text, '[^\x00-\x7F]')) AS c
            FROM documents)),
    codes AS (
        SELECT coalesce(string_agg(c, '' ORDER BY k), '') AS src,
               coalesce(string_agg(
                   chr(CAST(CASE WHEN k > 26 THEN error('too many characters')
                            WHEN k > 8 THEN k + 5 ELSE k END AS INTEGER)),
                   '' ORDER BY k), '') AS dst
        FROM alphabet),
    split AS (
        SELECT doc_id, text, unnest(range(len(s))) AS place, unnest(s) AS line
        FROM (SELECT doc_id, text, string_split(text, chr(10)) AS s FROM documents)),
    compared AS (SELECT * FROM split WHERE regexp_matches(line, '[^\x09-\x0D ]')),
    first_of AS (
        SELECT line, translate(line, any_value(src), any_value(dst)) AS coded,
               min({'d': doc_id, 'p': place}) AS f, length(line) AS n
        FROM compared, codes GROUP BY line),
    gone AS (
        SELECT DISTINCT a.line FROM first_of a JOIN first_of b
        ON b.n BETWEEN a.n - 2 AND a.n + 2 AND b.f < a.f
        WHERE a.n >= 32 AND b.n >= 32 AND levenshtein(a.coded, b.coded)
              <= CASE WHEN least(a.n, b.n) >= 48 THEN 2 ELSE 1 END),
    stays AS (SELECT f.d AS doc_id, f.p AS place FROM first_of ANTI JOIN gone USING (line)),
    marked AS (
        SELECT split.*, regexp_matches(line, '[^\x09-\x0D ]') AS is_compared,
               stays.place IS NOT NULL AS kept
        FROM split LEFT JOIN stays ON stays.doc_id = split.doc_id AND stays.place = split.place),
    judged AS (
        SELECT doc_id, count(*) FILTER (is_compared) AS n_lines,
               count(*) FILTER (is_compared AND NOT kept) AS n_removed,
               string_agg(line, chr(10) ORDER BY place) FILTER (NOT is_compared OR kept)
                   AS left_over
        FROM marked GROUP BY doc_id)
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
           CASE WHEN text IS NOT NULL THEN coalesce(left_over, '') END AS text
    FROM documents LEFT JOIN judged USING (doc_id)
"""

_URL_RULES = rf"""
    WITH parsed AS (
        SELECT page_id, url, coalesce(strpos(url, '://'), 0) AS k,
               CASE WHEN coalesce(strpos(url, '://'), 0) > 0
                    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    split AS (
        SELECT page_id, url, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM parsed),
    listed AS (
        SELECT *, string_split(host, '.') AS names, {_LOWER.format("path")} AS low,
               list_filter(string_split({_LOWER.format("path")}, '/'), lambda x: x != '') AS segs,
               regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query
        FROM split),
    bared AS (
        SELECT *, regexp_replace(host,
            '^(?:(?:www[0-9]*|m|mobile|amp|wap|blog)\.)+([^.]+\.)', '\1') AS bare FROM listed),
    described AS (
        SELECT page_id, host, path, CASE WHEN host = '' THEN [] ELSE list_filter([
                   'scheme=' || {_LOWER.format("split_part(url, '://', 1)")},
                   'tld=' || names[-1],
                   'site=' || CASE WHEN len(names) > 1
                                   THEN array_to_string(names[-2:], '.') ELSE '' END,
                   'sub=' || CASE WHEN len(names) > 2
                                  THEN array_to_string(names[:-3], '.') ELSE '' END,
                   'host=' || CASE WHEN len(string_split(bare, '.')) > 2 THEN bare ELSE '' END,
                   'first=' || coalesce(segs[1], ''),
                   'extension=' || regexp_extract(low, '\.([a-z0-9]{{1,8}})$', 1),
                   'depth=' || len(segs),
                   'keys=' || array_to_string(list_sort(list_distinct(list_transform(
                       string_split(query, '&'), lambda x: split_part(x, '=', 1)))), ','),
                   'fragment=' || CASE WHEN contains(url, '#') THEN 'yes' ELSE '' END],
                   lambda x: NOT ends_with(x, '=')) END AS tokens
        FROM bared),
    stated AS (
        SELECT *, CASE
            WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com'))
                 AND starts_with(path, '/en/') THEN 'www.example.com/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
                 AND starts_with(path, '/en/') THEN 'example.com/en/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/')
                 THEN 'net/es/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/')
                 THEN 'net/fr/'
            WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
            END AS rule
        FROM described),
    judged AS (
        SELECT doc_id, bool_or(coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1) AS bad
        FROM labels GROUP BY 1),
    labelled AS (SELECT tokens, bad FROM stated JOIN judged ON doc_id = page_id),
    labelled_parts AS (
        SELECT bad, list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS part
        FROM (SELECT *, unnest(range(1, 1 << len(tokens))) AS mask FROM labelled)),
    mined AS (
        SELECT part FROM labelled_parts GROUP BY part
        HAVING count(*) FILTER (bad) >= {MIN_COUNT}
           AND count(*) FILTER (bad) >= {MIN_CONFIDENCE} * count(*)),
    sets AS (SELECT DISTINCT tokens FROM stated WHERE rule IS NULL),
    met AS (
        SELECT DISTINCT tokens
        FROM (SELECT tokens, list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS part
              FROM (SELECT tokens, unnest(range(1, 1 << len(tokens))) AS mask FROM sets))
        SEMI JOIN mined USING (part))
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
                WHEN rule IS NOT NULL OR met.tokens IS NOT NULL THEN 'block'
                ELSE 'allow' END AS verdict
    FROM stated LEFT JOIN met ON met.tokens = stated.tokens AND rule IS NULL
"""


def oracle_sql():
    import corpus_pipeline

    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return whole | {
        "op2_sketch_join": _SKETCH_JOIN,
        "op3_line_dedup": _LINE_DEDUP,
        "op4_url_rules": _URL_RULES,
        "op5_interleave": _INTERLEAVE,
        "op9_decontaminate": _DECONTAMINATE,
        "op12_centroids": queries_sql.clustering(),
        "op13_pivotal_mix": queries_sql.mixing(),
    }
