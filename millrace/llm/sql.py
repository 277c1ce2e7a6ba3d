"""The queries in DuckDB's SQL, where it can say them."""

from __future__ import annotations

_CONVERSATIONS = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), near AS (
  SELECT *, coalesce(lag(role) OVER w = role, false) AS goes_on FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(replace(replace(text, '\', '\e'), '<', '\l'))
    + CASE WHEN goes_on THEN 6 ELSE 20 + length(replace(replace(role, '\', '\e'), '<', '\l')) END)::BIGINT
    AS formatted_chars
FROM near GROUP BY conv_id
"""



def _shared(level: str, parent: str | None, name: str) -> str:
    """One level of the tree: what each node gets of its parent's budget."""
    path = {"domain": "domain", "lang": "domain, lang", "source": "domain, lang, source"}[level]
    weight = {
        "domain": "CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END",
        "lang": "CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END",
        "source": "1 + max(number) % 3",
    }[level]
    above = "" if parent is None else {"lang": "PARTITION BY domain", "source": "PARTITION BY domain, lang"}[level]
    given = (
        "least(sum(tokens) OVER () * 3 // 5, sum(capacity) OVER ())" if parent is None
        else f"(SELECT p.budget FROM {parent} p WHERE {' AND '.join(f'p.{c} = n.{c}' for c in (['domain'] if level == 'lang' else ['domain', 'lang']))})"
    )
    return f"""
{name}_n AS (SELECT {path}, sum(n_tokens)::BIGINT AS tokens, (2 * sum(n_tokens))::BIGINT AS capacity, ({weight})::BIGINT AS weight
  FROM docs GROUP BY {path}),
{name}_g AS (SELECT *, ({given})::BIGINT AS given FROM {name}_n n),
{name}_r AS (SELECT *, given - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM {name}_g WINDOW w AS ({above} ORDER BY capacity / weight, {level})),
{name}_f AS (SELECT *, left_over * weight >= capacity * weights AS filled FROM {name}_r),
{name} AS (SELECT *, (CASE WHEN filled THEN capacity ELSE
    (given - coalesce(sum(capacity) FILTER (filled) OVER ({above}), 0)) * weight
    // sum(weight) FILTER (NOT filled) OVER ({above}) END)::BIGINT AS budget FROM {name}_f)"""


_MIXING = r"""
WITH numbered AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
    coalesce(TRY_CAST(regexp_extract(source, '^src([0-9]{1,4})$', 1) AS INT), 0) AS number
  FROM documents
), docs AS (
  SELECT *, CASE WHEN number < 10 THEN 'web' WHEN number < 15 THEN 'books' ELSE 'reference' END AS domain FROM numbered
),""" + ",".join(
    [_shared("domain", None, "d"), _shared("lang", "d", "l"), _shared("source", "l", "s")]
) + """,
planned AS (
  SELECT d.*, s.budget, CASE WHEN s.tokens > 0 THEN s.budget // s.tokens ELSE 0 END AS epochs,
    CASE WHEN s.tokens > 0 THEN s.budget % s.tokens ELSE 0 END AS rest
  FROM docs d JOIN s USING (domain, lang, source)
), run AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5(concat_ws('|', doc_id, 17, epochs)), n_tokens ROWS UNBOUNDED PRECEDING) AS upto FROM planned
)
SELECT doc_id, domain, lang, source, n_tokens, budget,
  (epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM run
"""

_INFILL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS digest,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents
), cuts AS (
  SELECT doc_id, text, tokens, len(tokens)::BIGINT AS n,
    ('0x' || substr(digest, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(digest, 9, 8))::BIGINT % (n + 1) AS c2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR ('0x' || substr(digest, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || substr(digest, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(tokens[1:least(c1, c2)], '') AS prefix,
    array_to_string(tokens[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
    array_to_string(tokens[greatest(c1, c2) + 1:], '') AS suffix
  FROM cuts
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

_PASSAGES = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM docs WHERE len(words) >= 50
), windows AS (
  SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS content FROM starts
), firsts AS (
  SELECT content, min(doc_id) AS first_id FROM windows GROUP BY content
), again AS (
  SELECT doc_id, pos FROM windows JOIN firsts USING (content) WHERE first_id < doc_id
), each AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM docs
), covered AS (
  SELECT e.doc_id, e.pos, e.word,
    coalesce(max(a.pos) OVER (PARTITION BY e.doc_id ORDER BY e.pos), -49) + 49 >= e.pos AS gone
  FROM each e LEFT JOIN again a ON a.doc_id = e.doc_id AND a.pos = e.pos
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM covered GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

SQL = {
    "op12_infill": _INFILL,
    "op13_passages": _PASSAGES,
    "op4_mixing": _MIXING,
    "op3_chat_format": _CONVERSATIONS,
    "op9_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
}
