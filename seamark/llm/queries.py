"""One registered query an operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.llm import ann, bpe, lines, lm, middle, neardup, packing, phrases, quality, rollup, secrets, urls, warc
from seamark.llm.common import fresh_dir, read, written
from seamark.llm.registry import query

WORDS = r"[^\x20\x09-\x0D]+"


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.quality(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(read(spark, sf_dir, "documents"))


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query(
    "op4_token_rollups",
    r"""
    WITH counted AS (
        SELECT doc_id, source, lang, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[0-9]+', '0', 'g') AS masked FROM documents
    ),
    placed AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM counted),
    kept AS (SELECT source, lang, masked FROM placed WHERE doc_id = first OR doc_id IS NULL),
    versions AS (
        SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(masked, '[^\x20\x09-\x0D]+')) AS n FROM kept
        UNION ALL SELECT source, lang, 'bytes-1', strlen(masked) FROM kept
    )
    SELECT source, lang, version, count(*) AS n_docs, sum(n)::BIGINT AS n_tokens FROM versions GROUP BY ALL
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches derived from the documents: all come; later copies of a text leave; the
    others are counted anew with numbers masked. The second is replayed after a compaction."""
    text = F.coalesce("text", F.lit(""))
    masked = F.regexp_replace(text, "[0-9]+", "0")
    words = lambda t: F.regexp_count(t, F.lit(WORDS))
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.sha2(text, 256).alias("digest"),
        words(text).alias("words"), F.octet_length(text).alias("bytes"), words(masked).alias("words_masked"), F.octet_length(masked).alias("bytes_masked"),
    )
    docs = written(docs, "token-counts")
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("first"))
    marked = docs.join(first, "digest")
    came = {"words-1": (F.col("words"), None), "bytes-1": (F.col("bytes"), None)}
    anew = {"words-1": (F.col("words_masked"), F.col("words")), "bytes-1": (F.col("bytes_masked"), F.col("bytes"))}
    copies = rollup.by_version(marked.filter("doc_id > first"), "delete", came)
    store = rollup.Rollup(spark, fresh_dir(spark, "rollup"))
    store.commit("day-1", rollup.by_version(docs, "insert", came))
    store.commit("day-2", copies)
    store.compact()
    store.commit("day-2", copies)
    store.commit("day-3", rollup.by_version(marked.filter("doc_id = first OR doc_id IS NULL"), "revise", anew))
    return store.totals()


@query("op5_vector_search")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


@query(
    "op6_line_dedup",
    r"""
    WITH l AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents
    ),
    k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    r AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    d AS (SELECT doc_id, i, line, r.key IS NOT NULL AND doc_id <> keep AS gone FROM k LEFT JOIN r USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM d GROUP BY doc_id
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_lm_scoring")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read(spark, sf_dir, "documents"))


@query(
    "op9_ngram_jaccard_join",
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (
        SELECT DISTINCT doc_id, shingle FROM (
            SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w
        )
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    k AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE shared / (x.n + y.n - shared) >= 8e-1),
    g AS (SELECT a, b FROM k UNION SELECT g.a, k.b FROM g JOIN k ON g.b = k.a),
    m AS (SELECT a, min(b) AS least FROM g GROUP BY 1),
    t AS (SELECT a, count(*) AS links FROM k GROUP BY 1)
    SELECT doc_id, least(doc_id, coalesce(m.least, doc_id)) AS class_id, coalesce(links, 0) AS n_links
    FROM documents LEFT JOIN m ON m.a = doc_id LEFT JOIN t ON t.a = doc_id
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.similar(read(spark, sf_dir, "documents"))


@query(
    "op10_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p),
    r AS (SELECT *, strlen(html) >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM f)
    SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
        CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
    FROM r
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), root)
    return warc.read(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op11_phrase_collocations",
    r"""
    WITH p AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
    ),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
    g AS (
        SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
        FROM w, (SELECT unnest(range(1, 6)) AS size) WHERE len(ws) >= size
    ),
    f AS (SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
    t AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
    c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
    k AS (SELECT lang, phrase, size, a, ws, unnest(range(1, size)) AS k FROM c),
    s AS (
        SELECT k.lang, k.phrase, k.size, k.a, k.k, x.a AS l, y.a AS r, t.n, (1000::HUGEINT * k.a * t.n) // (x.a::HUGEINT * y.a) AS score
        FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(ws[1:k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(ws[k + 1:], ' ') JOIN t ON t.lang = k.lang
    ),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    i AS (SELECT lang, a, size, ws, unnest(range(2, size)) AS z FROM c WHERE size > 2),
    h AS (SELECT lang, phrase, max(a) AS wide FROM (SELECT lang, a, unnest(list_transform(range(1, size - z + 2), lambda j: array_to_string(ws[j:j + z - 1], ' '))) AS phrase FROM i) GROUP BY ALL),
    o AS (
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, l, r, n, score
        FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE wide IS NULL OR 100 * wide < 100 * b.a
    )
    SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM o WHERE rank <= 2000
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


# The rules by which the pages are judged.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


@query(
    "op12_url_filter",
    r"""
    WITH RECURSIVE s AS (
        SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)', 2), '') AS path, regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)', 3) AS q FROM pages
    ),
    p AS (SELECT page_id, host, path, CASE WHEN host <> '' THEN host || path || q END AS a FROM s),
    e AS (
        SELECT DISTINCT a, regexp_replace(regexp_replace(split_part(a, '?', 1), '^(www|m)\.([^/]*\.)', '\2'), '/$', '')
            || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS b
        FROM (SELECT a, list_filter(string_split(CASE WHEN contains(a, '?') THEN substr(a, strpos(a, '?') + 1) ELSE '' END, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)=')) AS kept FROM p WHERE a IS NOT NULL)
    ),
    r AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS t (verdict, name, place)),
    n AS (SELECT a, split_part(split_part(a, '?', 1), '/', 1) AS host, regexp_extract(split_part(a, '?', 1), '(?s)^[^/]*(.*)$', 1) AS path FROM (SELECT a FROM p WHERE a IS NOT NULL UNION SELECT b FROM e)),
    v AS (SELECT a, max_by(verdict, length(name || place)) AS verdict, max_by(name || place, length(name || place)) AS rule FROM n JOIN r ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, place) GROUP BY a),
    k AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
    g AS (SELECT a, a AS b FROM n UNION SELECT g.a, k.b FROM g JOIN k ON g.b = k.a),
    c AS (SELECT g.a, bool_or(v.verdict = 'block') AND NOT bool_or(v.verdict = 'allow') AS tainted FROM g JOIN v ON v.a = g.b GROUP BY 1)
    SELECT page_id, host, path, rule, CASE WHEN v.verdict IS NOT NULL THEN v.verdict WHEN tainted THEN 'block' ELSE 'allow' END AS verdict
    FROM p LEFT JOIN v USING (a) LEFT JOIN c USING (a)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op13_fill_in_middle",
    r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
    ),
    c AS (SELECT *, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
    f AS (
        SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
            array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
            array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
            array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') AS s
        FROM c
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
    FROM f
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = middle.restore(middle.transform(read(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
