"""The registered queries of the operators, over whole tables, with the SQL they are checked against where
SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bpe, centroids, decontamination, fim, html, languages, licenses, pii, quality, simhash, substrings, urls, warc
from orderloom.llm.shipping import shared_path, stored
from orderloom.session import apply_scale_defaults

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(apply_scale_defaults(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


# --- 1: substring dedup ----------------------------------------------------------------------------------------------
SUBSTRING_SQL = r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
    windows AS (
        SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) i FROM words)),
    firsts AS (SELECT win, min(doc_id) first FROM windows GROUP BY win),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 50)) p
        FROM windows JOIN firsts USING (win) WHERE first < doc_id),
    gone_by_doc AS (SELECT doc_id, count(*) n, list(p) ps FROM gone GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n, 0) AS BIGINT) n_removed,
        sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(ps, k)) END, ' ')) kept_sha256
    FROM words LEFT JOIN gone_by_doc USING (doc_id)"""


@register("op1_substring_dedup", SUBSTRING_SQL)
def substring_dedup(spark, d):
    found = substrings.dedupe(table(spark, d, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


# --- 2: benchmark decontamination ------------------------------------------------------------------------------------
DECONTAMINATION_SQL = rf"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
        FROM documents),
    item_words AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
        FROM benchmark),
    item_windows AS (
        SELECT DISTINCT item_id, least(10, len(w)) size,
            unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2),
                                  lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) win
        FROM item_words WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT size FROM item_windows),
    doc_windows AS (
        SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) i, w FROM words, sizes WHERE len(w) >= size),
    hits AS (
        SELECT d.doc_id, d.i, d.size, t.item_id
        FROM (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') win FROM doc_windows) d
        JOIN item_windows t USING (size, win)),
    hit_words AS (
        SELECT doc_id, count(DISTINCT p) n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) p FROM hits) GROUP BY doc_id),
    hit_items AS (
        SELECT doc_id, count(*) n_items, string_agg(id, ',' ORDER BY id) ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) id FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit,
        CAST(coalesce(n_items, 0) AS BIGINT) n_items, sha256(coalesce(ids, '')) items_sha256,
        coalesce(n_hit, 0) > 0 contaminated
    FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


@register("op2_benchmark_decontamination", DECONTAMINATION_SQL)
def benchmark_decontamination(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    marked = decontamination.mark(docs, table(spark, d, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


# --- 3: BPE encoding and decoding ------------------------------------------------------------------------------------
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@register("op3_bpe")
def bpe_round_trip(spark, d):
    tokens = bpe.encode(table(spark, d, "documents").select("doc_id", "text"), TOKENIZER)
    decoded = bpe.decode(tokens.select("doc_id", "n_tokens", "ids"), TOKENIZER)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


# --- 4: HTML extraction ----------------------------------------------------------------------------------------------
@register("op4_html")
def html_extraction(spark, d):
    return html.extract(table(spark, d, "pages").select("page_id", "url", "html"))


# --- 5: license scans ------------------------------------------------------------------------------------------------
def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    pattern, named = licenses.matcher()
    known = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for s, i in licenses.SENTENCES.items())
    rules = ", ".join(f"({_quoted(ids)}, {_quoted(name)})" for ids, name in named.items())
    text = "coalesce(text, '')"
    for wrap in licenses.WRAPS:
        text = f"regexp_replace({text}, {_quoted(wrap)}, " + r"'\1 \2', 'g')"
    return rf"""
    WITH known(sentence, id) AS (VALUES {known}),
    rules(ids, name) AS (VALUES {rules}),
    parts AS (
        SELECT doc_id, string_split_regex(translate({text}, {CAPITALS}), {_quoted(licenses.ENDS)}) parts FROM documents),
    numbered AS (SELECT doc_id, unnest(parts) part, unnest(range(len(parts))) k FROM parts),
    hits AS (
        SELECT doc_id, k, id
        FROM numbered JOIN known ON trim(regexp_replace(part, '[^a-z0-9]+', ' ', 'g'), ' ') = sentence),
    by_doc AS (
        SELECT doc_id, count(*) n, string_agg(id, ',' ORDER BY k) ids, string_agg(id || ' ', '' ORDER BY k) spaced
        FROM hits GROUP BY doc_id),
    matched AS (
        SELECT doc_id, unnest(m) ids, unnest(range(len(m))) k
        FROM (SELECT doc_id, regexp_extract_all(spaced, {_quoted(pattern.pattern.replace(chr(92) + '-', '-').replace(chr(92) + ' ', ' '))}) m FROM by_doc)),
    named AS (
        SELECT doc_id, string_agg(name, ',' ORDER BY k) licenses FROM matched JOIN rules USING (ids) GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) n_sentences, coalesce(ids, '') sentence_ids,
        coalesce(licenses, '') licenses
    FROM documents LEFT JOIN by_doc USING (doc_id) LEFT JOIN named USING (doc_id)"""


@register("op5_license_scans", _license_sql())
def license_scans(spark, d):
    found = licenses.scan(table(spark, d, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.concat_ws(",", "sentence_ids").alias("sentence_ids"),
        F.concat_ws(",", "licenses").alias("licenses"),
    )


# --- 6: personal data ------------------------------------------------------------------------------------------------
def _is(kind):
    return lambda span: span["kind"] == kind


def _listed(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


@register("op6_pii")
def personal_data(spark, d):
    found = pii.find(table(spark, d, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(F.size(F.filter("base", _is(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


# --- 7: quality rules ------------------------------------------------------------------------------------------------
QUALITY_SQL = r"""
    WITH words AS (
        SELECT doc_id, coalesce(text, '') text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w
        FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) i FROM words)),
    repeated AS (
        SELECT doc_id, unnest(range(i, i + 3)) p
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) c FROM windows) WHERE c > 1),
    repeats AS (SELECT doc_id, count(DISTINCT p) n FROM repeated GROUP BY doc_id),
    lines AS (
        SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) line FROM words)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    dup_lines AS (SELECT doc_id, count(*) - count(DISTINCT line) n FROM lines GROUP BY doc_id),
    measured AS (
        SELECT doc_id, len(w) n_words, CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT) chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) n_symbols,
            length(regexp_replace(text, '[^!]', '', 'g')) exclaimed,
            len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) shouted,
            len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) spoken,
            coalesce(dup_lines.n, 0) n_dup_lines, coalesce(repeats.n, 0) n_repeat_words
        FROM words LEFT JOIN repeats USING (doc_id) LEFT JOIN dup_lines USING (doc_id)),
    based AS (
        SELECT *, coalesce(chars, 0) word_chars, n_words < 50 OR 100 * n_repeat_words > 50 * n_words base_failed
        FROM measured)
    SELECT doc_id, CAST(n_words AS BIGINT) n_words, CAST(word_chars AS BIGINT) word_chars,
        CAST(n_symbols AS BIGINT) n_symbols, CAST(n_dup_lines AS BIGINT) n_dup_lines,
        CAST(n_repeat_words AS BIGINT) n_repeat_words, base_failed,
        NOT base_failed AND n_symbols <= 0.1 * n_words AND word_chars BETWEEN 2 * n_words AND 30 * n_words
            AND spoken >= 0.7 * n_words AND shouted <= 0.5 * n_words AND exclaimed <= 0.3 * n_words kept
    FROM based"""


@register("op7_quality_rules", QUALITY_SQL)
def quality_rules(spark, d):
    judged = quality.judge(table(spark, d, "documents").select("doc_id", "text"), measures=quality.BASE)
    return judged.select(
        "doc_id",
        *quality.BASE,
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
    )


# --- 8: URL filters --------------------------------------------------------------------------------------------------
URL_RULES = (
    urls.Rule("block", "net"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)


@register("op8_url_filters")
def url_filters(spark, d):
    return urls.judge(table(spark, d, "pages"), URL_RULES)


# --- 9: SimHash near duplicates --------------------------------------------------------------------------------------
@register("op9_simhash")
def simhash_groups(spark, d):
    found = simhash.groups(table(spark, d, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


# --- 10: WARC --------------------------------------------------------------------------------------------------------
WARC_SQL = """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) payload_bytes, sha256(payload) payload_digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) first FROM d)
    SELECT page_id, CAST(payload_bytes AS BIGINT) payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END record_type,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END refers_to
    FROM f"""


@register("op10_warc", WARC_SQL)
def warc_round_trip(spark, d):
    path = shared_path(spark, "archives")
    warc.write_captures(table(spark, d, "pages"), path)
    read = warc.read_records(spark, path)  # the bodies of responses are measured there and not needed beyond
    body = F.when(F.col("type") == "metadata", F.col("payload"))
    unused = {c: F.lit(None).cast(read.schema[c].dataType) for c in ("http_head", "headers")}
    records = stored(read.withColumns({"payload": body, **unused}), "records")
    found = warc.captures(records).select("record_id", "response", F.struct("metadata.payload").alias("metadata"))
    found = warc.resolve_revisits(stored(found, "captures"))
    revisit = F.col("response.type") == "revisit"
    original = F.when(revisit, F.col("original"))
    return found.select(
        warc.page_id_of(found).cast("long").alias("page_id"),
        F.coalesce(original["payload_bytes"], F.col("response.payload_bytes")).alias("payload_bytes"),
        F.coalesce(original["payload_digest"], F.col("response.payload_digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        original["page_id"].cast("long").alias("refers_to"),
    )


# --- 11: fill-in-middle ----------------------------------------------------------------------------------------------
FIM_SQL = """
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') w,
            sha256('1:' || doc_id) h
        FROM documents),
    drawn AS (
        SELECT *, len(w) n, CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (len(w) + 1) a,
            CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (len(w) + 1) b,
            CAST('0x' || substr(h, 17, 8) AS UBIGINT) % 100 third, CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 fourth
        FROM cut),
    parts AS (
        SELECT doc_id, text, n,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR third >= 90
                THEN 'plain' WHEN fourth < 20 THEN 'spm' ELSE 'psm' END form,
            array_to_string(w[1:least(a, b)], '') p, array_to_string(w[least(a, b) + 1:greatest(a, b)], '') m,
            array_to_string(w[greatest(a, b) + 1:], '') s
        FROM drawn)
    SELECT doc_id, CAST(n AS BIGINT) n, form,
        CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END prefix_chars,
        CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
               ELSE '<S>' || s || '<P>' || p || '<M>' || m END) output_sha256,
        sha256(text) restored_sha256
    FROM parts"""


@register("op11_fill_in_middle", FIM_SQL)
def fill_in_middle(spark, d):
    made = fim.transform(table(spark, d, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored().cast("binary"), 256).alias("restored_sha256"),
    )


# --- 12: language identification -------------------------------------------------------------------------------------
@register("op12_language_id")
def language_id(spark, d):
    docs = table(spark, d, "documents")
    model = languages.train(docs.where(F.col("doc_id").isNotNull() & ~languages.held_out()))
    found = languages.predict(docs.select("doc_id", "text", languages.held_out().alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


# --- 13: centroid clustering -----------------------------------------------------------------------------------------
def _centroid_sql(k: int = 8, rounds: int = 10) -> str:
    steps = [
        """kept AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) v
        FROM embeddings
        WHERE len(embedding) = 64
            AND list_sum(list_transform(embedding, lambda x: CASE WHEN isfinite(CAST(x AS DOUBLE)) THEN 1 ELSE 0 END)) = 64)""",
        f"""c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 c, v FROM kept
        ORDER BY sha256('3:' || vec_id), v LIMIT {k})""",
    ]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
        SELECT vec_id, kept.v v, arg_min(c, (d, c)) c, min(d) d
        FROM (SELECT vec_id, kept.v v, rid, c,
                CAST(list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - c{t}.v[i]) * (kept.v[i] - c{t}.v[i]))) AS BIGINT) d
            FROM (SELECT *, row_number() OVER () rid FROM kept) kept, c{t}) kept
        GROUP BY rid, vec_id, kept.v)""")
        if t < rounds:
            steps.append(f"""m{t} AS (
        SELECT c, list(m ORDER BY i) v
        FROM (SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) m
            FROM (SELECT c, unnest(v) x, unnest(range(64)) i FROM a{t}) GROUP BY c, i) GROUP BY c),
    c{t + 1} AS MATERIALIZED (SELECT c, coalesce(m{t}.v, c{t}.v) v FROM c{t} LEFT JOIN m{t} USING (c))""")
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, CAST(c AS INTEGER) "cluster", d distance,
        CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) cluster_inertia, CAST(sum(d) OVER () AS BIGINT) inertia,
        sha256(array_to_string(c{rounds}.v, ',')) centroid_sha256
    FROM a{rounds} JOIN c{rounds} USING (c)"""


@register("op13_centroids", _centroid_sql())
def centroid_clustering(spark, d):
    found = centroids.cluster(table(spark, d, "embeddings"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]

    def of_cluster(values, kind):
        return F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster") + 1)

    return found.members.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        of_cluster(found.inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(found.inertia)).cast("long").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )
