"""SQL of the queries that SQL can express. The others are tested against brute force in ``tests/llm``."""

from __future__ import annotations

_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_INLINE = "a|abbr|b|big|cite|code|del|em|font|i|ins|kbd|mark|q|s|samp|small|span|strike|strong|sub|sup|tt|u|var"


def _words(c: str) -> str:
    """The words of a text as a list: without tags, accents, case and what is invisible."""
    shown = f"regexp_replace(regexp_replace({c}, '(?i)</?(?:{_INLINE})(?:\\s[^<>]*)?/?>', '', 'g'), '</?[A-Za-z][A-Za-z0-9:-]*(?:\\s[^<>]*)?/?>', ' ', 'g')"
    return f"regexp_extract_all(replace(lower(strip_accents(regexp_replace(nfc_normalize({shown}), '[\\x{{ad}}\\p{{Cf}}]', '', 'g'))), 'ß', 'ss'), '[\\p{{L}}\\p{{N}}]+')"


#: Shared runs of 13 words by their places, and from neighbours on one diagonal the longest run of each pair.
_RUNS = f"""dw AS (SELECT doc_id, {_words("text")} AS w FROM documents WHERE text IS NOT NULL), iw AS (SELECT item_id, {_words("item_text")} AS w, {_words("answer")} AS a FROM eval_items WHERE item_text IS NOT NULL),
ds AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM dw)),
si AS (SELECT item_id, j, array_to_string(w[j:j+12], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS j FROM iw)),
h AS (SELECT item_id, doc_id, i, i - j AS diagonal FROM ds JOIN si USING (s)),
g AS (SELECT *, i - row_number() OVER (PARTITION BY item_id, doc_id, diagonal ORDER BY i) AS island FROM h),
r AS (SELECT item_id, doc_id, diagonal, island, 12 + count(*) AS n FROM g GROUP BY ALL)"""
_NEAREST = """e AS (SELECT id, min(embedding)::DOUBLE[] AS v FROM chunks WHERE id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0 GROUP BY id),
s AS (SELECT a.id, b.id AS other, list_cosine_similarity(a.v, b.v) AS cosine FROM e a JOIN e b ON a.id <> b.id {asked}),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(cosine, 9) DESC, other) AS rank FROM s QUALIFY rank <= 5)"""

_PARAGRAPHS = f"""cur AS (SELECT id, arg_max(content, version) FILTER (content IS NOT NULL) AS any_content, arg_max(deleted, version) AS dead,
  max(version) AS v, max(version) FILTER (content IS NOT NULL) AS vc FROM source_documents GROUP BY id),
p AS (SELECT id, list_filter(list_transform(string_split_regex(replace(any_content, chr(13) || chr(10), chr(10)), '\\n{_WS}*\\n'),
  lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '') AS ps FROM cur WHERE NOT dead AND v = vc),
q AS (SELECT id AS document_id, CAST(i - 1 AS INTEGER) AS paragraph_no, ps[i] AS t FROM (SELECT id, ps, unnest(range(1, len(ps) + 1)) AS i FROM p))"""

ORACLES: dict[str, str] = {
    "p6_found": f"WITH {_NEAREST.format(asked='')} SELECT a.id AS id_a, a.other AS id_b FROM n a JOIN n b ON b.id = a.other AND b.other = a.id WHERE a.id < a.other AND a.cosine >= 0.95",
    "p6_neighbours": f"WITH {_NEAREST.format(asked='WHERE a.id % 100 = 0')} SELECT n.id, CAST(n.rank AS INTEGER) AS rank, n.other AS neighbour_id, round(n.cosine, 3) AS cosine, c.content FROM n LEFT JOIN (SELECT id, min(content) AS content FROM chunks GROUP BY id) c ON c.id = n.other",
    "p4_found": f"WITH {_PARAGRAPHS} SELECT document_id, paragraph_no FROM q WHERE length(t) > 1000",
    "p4_rejoined": f"WITH {_PARAGRAPHS} SELECT document_id, paragraph_no, length(t) AS n_chars, length(t) > 1000 AS cut, true AS within_limit, true AS overlaps_kept, sha256(t) AS whole FROM q",
    "p7_kept": "SELECT true AS tokens_kept, true AS documents_kept, true AS attention_kept, count(*) AS texts, true AS texts_whole, true AS well_filled FROM documents",
    "p7_attention": "SELECT true AS tokens_kept, true AS documents_kept, true AS attention_kept, count(*) AS texts, true AS texts_whole FROM documents",
    "p8_found": f"WITH {_RUNS} SELECT DISTINCT item_id, doc_id FROM r",
    "p8_runs": f"""WITH {_RUNS} SELECT item_id, doc_id, CAST(max(n) AS INTEGER) AS n_words, bool_or(coalesce(len(a) > 0 AND contains(' ' || array_to_string(dw.w, ' ') || ' ', ' ' || array_to_string(a, ' ') || ' '), false)) AS answer_seen
FROM r JOIN dw USING (doc_id) JOIN iw USING (item_id) GROUP BY item_id, doc_id""",
}
