"""One registered query per operator of this subpackage, over its whole table with production parameters."""

from cartwright.llm import (
    byte_bpe,
    chat_format,
    collocations,
    divergence_audit,
    exact_dedup,
    importance,
    language,
    near_dedup,
    packing,
    secret_scan,
    token_counts,
    topk_search,
    url_filter,
)
from cartwright.llm.encoding import default_path

BPE_JSON = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_50k.tiktoken"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark, sf_dir):
    talks = chat_format.with_probe(table(spark, sf_dir, "conversations"))
    return chat_format.format_conversations(talks, default_path(BPE_JSON)).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op3_topk_search(spark, sf_dir):
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op4_quality(spark, sf_dir):
    return importance.sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_byte_bpe(spark, sf_dir):
    from public_tokenizers import PATTERN

    return byte_bpe.digest_documents(table(spark, sf_dir, "documents"), default_path(BPE_RANKS), PATTERN)


def op6_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), default_path(BPE_JSON))


def op8_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), default_path(BPE_JSON))


def op9_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs, words=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op10_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op12_divergence_audit(spark, sf_dir):
    return divergence_audit.audit(table(spark, sf_dir, "documents"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_chat_format, op2_exact_dedup, op3_topk_search, op4_quality, op5_byte_bpe, op6_language, op7_packing,
        op8_token_counts, op9_near_dedup, op10_url_filter, op11_secret_scan, op12_divergence_audit,
        op13_collocations,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CHAT = r"""
WITH probe AS (
    SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
    AS t(conv_id, turn, role, text)
),
turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM probe
),
escaped AS (
    SELECT *, length('### : </turn>') + 1
        + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g'))
        + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) AS formatted
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

_EXACT = f"""
WITH hashed AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256 FROM documents
),
grouped AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM hashed JOIN grouped USING (text_sha256)
"""

_TOP = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

_NEAR = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''
    ) AS w FROM documents
),
shingled AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM worded
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM shingled),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c
    FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (n + m - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS node, a AS seen FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a),
least AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
    doc_id = coalesce(component, doc_id) AS kept
FROM shingled LEFT JOIN least ON doc_id = node
"""

_URLS = f"""
WITH RECURSIVE cut AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
located AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
    FROM located
),
said AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS said FROM ruled),
paths AS (
    SELECT host, path, count(*) AS pages, count(said) AS labelled, count(*) FILTER (said = 'block') AS blocked
    FROM said GROUP BY host, path
),
walk AS (
    SELECT host, path, pages, labelled, blocked, string_split(regexp_replace(path, '[0-9]+', '<n>', 'g'), '/') AS parts, 1 AS level,
        '' AS above, '' AS seen, false AS ended FROM paths
    UNION ALL
    SELECT host, path, pages, labelled, blocked, parts, level + 1, above || '/' || token,
        seen || '/' || CASE WHEN token = '*' THEN token ELSE part END, all_paths = 1 OR len(parts) = level
    FROM (
        SELECT *, CASE
            WHEN kinds > {url_filter.MANY} AND {url_filter.THIN} * kin < all_paths AND (of = 0 OR alike) THEN '*'
            WHEN kinds > 1 AND of > 0 AND alike THEN '~'
            ELSE part END AS token
        FROM (
            SELECT *, (bad * (l + 2) - of * (b + 1)) * (bad * (l + 2) - of * (b + 1))
                <= CAST({url_filter.DIFFERENT} AS DOUBLE) * of * (b + 1) * (l + 1 - b) AS alike
            FROM (
                SELECT *, count(*) OVER child AS kin, CAST(sum(labelled) OVER child AS DOUBLE) AS of,
                    CAST(sum(blocked) OVER child AS DOUBLE) AS bad, count(DISTINCT part) OVER node AS kinds,
                    count(*) OVER node AS all_paths, CAST(sum(labelled) OVER node AS DOUBLE) AS l,
                    CAST(sum(blocked) OVER node AS DOUBLE) AS b
                FROM (SELECT *, parts[level] AS part FROM walk WHERE NOT ended)
                WINDOW child AS (PARTITION BY host, level, above, part), node AS (PARTITION BY host, level, above)
            )
        )
    )
),
shaped AS (
    SELECT host, path, pages, labelled, blocked, substr(above || rest, 2) AS template, substr(seen || rest, 2) AS shape
    FROM (SELECT *, CASE WHEN len(parts) >= level THEN '/' || array_to_string(parts[level:], '/') ELSE '' END AS rest FROM walk WHERE ended)
),
base AS (SELECT (coalesce(sum(blocked), 0) + 1) * 1000000 // (coalesce(sum(labelled), 0) + 2) AS base FROM paths),
priors AS (
    SELECT shape, CAST(floor((sum(blocked) * 1000000 + {url_filter.SHAPE_WEIGHT} * any_value(base))
        / (sum(labelled) + {url_filter.SHAPE_WEIGHT})) AS BIGINT) AS prior
    FROM shaped, base GROUP BY shape
),
judged AS (
    SELECT host, template, sum(blocked) * 1000000 + {url_filter.WEIGHT} * CAST(floor(sum(pages * prior) / sum(pages)) AS BIGINT)
        > 500000 * (sum(labelled) + {url_filter.WEIGHT}) AS bad
    FROM shaped JOIN priors USING (shape) GROUP BY host, template
)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM said JOIN (SELECT host, path, template FROM shaped) USING (host, path) JOIN judged USING (host, template)
"""

_AUDIT = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
    FROM documents
),
words AS (
    SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), '{_UPPER}', '{_LOWER}')
        AS term
    FROM docs
),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
sizes AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang),
used AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
counted AS (SELECT lang, source, CAST(sum(c) AS HUGEINT) AS n FROM used GROUP BY lang, source),
groups AS (
    SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counted USING (lang, source) LEFT JOIN sizes USING (lang)
),
grid AS (
    SELECT lang, source, term, coalesce(c, 0) AS c, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 1)) // (n + v) AS p
    FROM groups JOIN kept USING (lang) LEFT JOIN used USING (lang, source, term)
),
whole AS (
    SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(c) + 1)) // (any_value(n) + any_value(v)) AS q
    FROM used JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM groups GROUP BY lang) USING (lang) GROUP BY lang, term
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
    FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
),
listed AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM grid JOIN whole USING (lang, term)
    WHERE c > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM listed QUALIFY part = 'pair' OR rank <= {divergence_audit.TOP_TERMS}
"""

_PHRASES = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
suffixes AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM starts),
ones AS (SELECT lang, w1, count(*) AS f FROM suffixes GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY lang),
twos AS (SELECT lang, w1, w2, count(*) AS a FROM suffixes WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
threes AS (SELECT lang, w1, w2, w3, count(*) AS a FROM suffixes WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
inside AS (
    SELECT lang, w1, w2, max(a) AS top
    FROM (SELECT lang, w1, w2, a FROM threes UNION ALL SELECT lang, w2, w3, a FROM threes) GROUP BY lang, w1, w2
),
cuts AS (
    SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, 1 AS k, a, x.f AS l, y.f AS r FROM twos t
    JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w2
    LEFT JOIN inside i ON i.lang = t.lang AND i.w1 = t.w1 AND i.w2 = t.w2 WHERE top IS NULL OR 100 * top < 50 * a
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 1, t.a, x.f, y.a FROM threes t
    JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.a, x.a, y.f FROM threes t
    JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w3
),
scored AS (
    SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r), k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored JOIN sizes USING (lang) QUALIFY rank <= {collocations.FIRST}
"""

SQL = {"op1_chat_format": _CHAT, "op2_exact_dedup": _EXACT, "op3_topk_search": _TOP, "op9_near_dedup": _NEAR, "op10_url_filter": _URLS, "op12_divergence_audit": _AUDIT, "op13_collocations": _PHRASES}
