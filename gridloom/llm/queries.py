"""One query for each operator of this folder, over whole tables, with SQL where
SQL can express it."""

from __future__ import annotations

from gridloom.llm import (
    alignment,
    contamination,
    jaccard,
    langid,
    licenses,
    neighbours,
    packing,
    recompression,
    surrogates,
    topk,
    toxicity,
    urls,
    whitening,
)
from gridloom.llm.common import table

# The rules of the URL query.
URL_RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]


def op1_language(spark, sf_dir):
    return langid.language_report(table(spark, sf_dir, "documents"))


def op2_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_jaccard(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op4_repeats(spark, sf_dir):
    return recompression.repeat_report(table(spark, sf_dir, "documents"))


def surrogate_key(spark) -> bytes:
    """The secret of the deployment; the fallback serves tests only."""
    return spark.conf.get("spark.gridloom.surrogate.key", "not a secret").encode()


def op5_surrogates(spark, sf_dir):
    return surrogates.private_report(table(spark, sf_dir, "documents"), surrogate_key(spark))


def op6_contamination(spark, sf_dir):
    return contamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op7_embeddings(spark, sf_dir):
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_licenses(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op9_urls(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op11_topk(spark, sf_dir):
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark, sf_dir):
    return alignment.alignment_report(table(spark, sf_dir, "documents"))


def op13_whitening(spark, sf_dir):
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _seed_sql(source: str, key: str) -> str:
    masks = [
        f"SELECT {key}, w, {m} AS mask, p AS pos, "
        + "concat_ws(' ', "
        + ", ".join(f"w[p + {k + 1}]" for k, bit in enumerate(mask) if bit == "1")
        + f") AS seed FROM {source}, unnest(range(len(w))) AS t(p) WHERE p + {len(mask)} <= len(w)"
        for m, mask in enumerate(contamination.MASKS)
    ]
    short = min(map(len, contamination.MASKS))
    masks.append(
        f"SELECT {key}, w, -1 AS mask, 0 AS pos, array_to_string(w, ' ') AS seed "
        f"FROM {source} WHERE len(w) BETWEEN 1 AND {short - 1}"
    )
    return " UNION ALL ".join(masks)


_WORDS = "regexp_extract_all(" + _FOLD.format("coalesce(text, '')") + ", '[^\\x20\\x09-\\x0D]+')"

CONTAMINATION_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
doc_seeds AS ({_seed_sql("docs", "doc_id")}),
cut AS (
    SELECT item_id, mask, seed, pos, w, least({contamination.WINDOW}, len(w)) AS n
    FROM ({_seed_sql("items", "item_id")})
),
item_seeds AS (
    SELECT item_id, mask, seed, w, n, pos,
        greatest(0, least(pos - (n - 4) // 2, len(w) - n)) AS lo
    FROM cut
),
met AS (
    SELECT d.doc_id, i.item_id, d.pos - (i.pos - i.lo) AS start, i.n AS compared,
        len(list_filter(range(i.n), lambda k:
            d.pos - (i.pos - i.lo) + k >= 0
            AND coalesce(d.w[d.pos - (i.pos - i.lo) + k + 1] = i.w[i.lo + k + 1], false))) AS matched
    FROM doc_seeds d JOIN item_seeds i USING (mask, seed)
),
best AS (
    SELECT *, row_number() OVER (
        PARTITION BY doc_id, item_id ORDER BY matched / compared DESC, start, matched DESC
    ) AS place
    FROM met WHERE 100 * matched >= {round(contamination.SHARE * 100)} * compared
)
SELECT doc_id, item_id, matched, compared, greatest(0, start) AS first_word FROM best WHERE place = 1
"""

_PHRASES = list(licenses.PHRASES.items())


def _place_sql(phrase: str) -> str:
    same = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(phrase.split(" ")))
    return f"list_filter(range(len(w) - {len(phrase.split(' ')) - 1}), lambda i: {same})"


_LICENSE_WORDS = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"

LICENSE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
scanned AS (
    SELECT row, doc_id, len(w) AS n_words, {", ".join(
        f"{_place_sql(p)} AS at{k}" for k, (p, _) in enumerate(_PHRASES))}
    FROM (SELECT row, doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")},
        {_LICENSE_WORDS}) AS w FROM docs)
),
base AS (
    SELECT row, doc_id, n_words, {" || ".join(f"at{k}" for k in range(len(_PHRASES)))} AS places,
        list_filter([{", ".join(f"CASE WHEN len(at{k}) > 0 THEN '{label}' END"
            for k, (_, label) in enumerate(_PHRASES))}], lambda x: x IS NOT NULL) AS base
    FROM scanned
),
blocks AS (
    SELECT row, list_distinct(regexp_extract_all({_FOLD.format("line")}, {_LICENSE_WORDS})) AS t
    FROM docs, unnest(string_split(text, chr(10))) AS l(line)
),
templates AS (
    SELECT label, list_distinct(string_split(words, ' ')) AS t
    FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in licenses.TEMPLATES)}) AS v(label, words)
),
pairs AS (
    SELECT row, label, len(list_intersect(b.t, s.t)) AS shared, len(s.t) AS n
    FROM blocks b JOIN templates s ON list_has_any(b.t, s.t)
),
found AS (
    SELECT row, list(DISTINCT label) AS labels, max(shared / n) AS most
    FROM pairs WHERE shared >= ceil({licenses.THRESHOLD} * n) GROUP BY row
)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word,
    list_max(places) AS last_word, array_to_string(list_sort(base), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(base || coalesce(labels, []))), ',') AS labels,
    CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(most, 0.0) END AS score
FROM base LEFT JOIN found USING (row)
"""

_AFTER = (
    "CASE WHEN contains(coalesce(url, ''), '://') THEN url[strpos(url, '://') + 3:] ELSE '' END"
)

URL_SQL = f"""
WITH rules(rule, action) AS (VALUES {", ".join(f"('{r}', '{a}')" for r, a in URL_RULES)}),
parts AS (
    SELECT row_number() OVER () AS row, page_id,
        {_FOLD.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, {_AFTER} AS rest FROM pages)
),
fits AS (
    SELECT row, rule, action,
        row_number() OVER (PARTITION BY row ORDER BY length(rule) DESC) AS place
    FROM parts JOIN rules
        ON ends_with('.' || host, '.' || split_part(rule, '/', 1))
        AND starts_with(path, rule[strpos(rule, '/'):])
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (row)
"""

TOPK_SQL = f"""
WITH x AS (
    SELECT row_number() OVER () AS row, vec_id,
        list_transform(embedding, lambda c: floor({topk.SCALE} * c::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scored AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(
        range(1, least(len(q.x), len(c.x)) + 1), lambda k: q.x[k] * c.x[k])), 0)::BIGINT AS score
    FROM x q JOIN x c ON q.row <> c.row
    WHERE q.vec_id % {topk.EVERY} = 0
),
placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= {topk.K}
"""

# name: (query, SQL or None)
QUERIES = {
    "op1_language": (op1_language, None),
    "op2_packing": (op2_packing, None),
    "op3_jaccard": (op3_jaccard, None),
    "op4_repeats": (op4_repeats, None),
    "op5_surrogates": (op5_surrogates, None),
    "op6_contamination": (op6_contamination, CONTAMINATION_SQL),
    "op7_embeddings": (op7_embeddings, None),
    "op8_licenses": (op8_licenses, LICENSE_SQL),
    "op9_urls": (op9_urls, URL_SQL),
    "op10_toxicity": (op10_toxicity, None),
    "op11_topk": (op11_topk, TOPK_SQL),
    "op12_alignment": (op12_alignment, None),
    "op13_whitening": (op13_whitening, None),
}


def queries() -> dict:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}
