"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from seriesloom.llm import divergence, mixing, quality, warc
from seriesloom.llm.substring_dedup import WINDOW

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), reach AS (
  SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
), comp AS (SELECT a, min(b) AS m FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(comp.m, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(comp.m, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN comp ON comp.a = vec_id
"""

OP5 = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), q AS (
  SELECT *, CASE WHEN n >= {warc.MIN_REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY body) ELSE page_id END AS last FROM p
)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM q
"""

OP6 = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(role, '') AS r, coalesce(text, '') AS x, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', 'user', '</s>[INST] ok [/INST]', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', 'assistant', '</s>[INST] ok [/INST]', '</s>[INST] ok [/INST]'
), w AS (
  SELECT *, replace(replace(x, '\', '\\'), '<|', '<\|') AS ex,
    replace(replace(replace(r, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS er
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS whole,
    coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, text NULLS FIRST) FILTER (WHERE r = 'assistant'), '') AS loss,
    sum(length('<|im_start|>') + length(er) + 1 + length(ex) + length('<|im_end|>') + 1) AS n
  FROM w GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM g
"""

OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
w AS (SELECT doc_id, ws, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM d),
g AS (
  SELECT doc_id, i, word,
    CASE WHEN i + {WINDOW - 1} <= len(ws) THEN md5(array_to_string(ws[i : i + {WINDOW - 1}], ' ')) END AS gram
  FROM w
), c AS (
  SELECT doc_id, i, word,
    CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY gram) > 1 THEN 1 ELSE 0 END AS twice
  FROM g
), m AS (
  SELECT doc_id, i, word,
    max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM c
), s AS (
  SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS kept
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON s.doc_id = d.doc_id
"""

_times = [at for at, _ in mixing.SCHEDULE]


def _half(i: int) -> float:
    return (_times[i + 1] - _times[i]) / 2


def _factor(i: int) -> str:
    factors = mixing.SCHEDULE[i][1]
    return f"CAST([{', '.join(map(str, factors))}][rk % {len(factors)} + 1] AS DOUBLE)"


OP8 = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM d GROUP BY source
), w AS (
  SELECT *, CAST([{', '.join(map(str, mixing.WEIGHTS))}][rk % {len(mixing.WEIGHTS)} + 1] AS DOUBLE) AS w,
    source_size * {mixing.MAX_REPEAT} AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * {mixing.SHARE} AS budget
  FROM s
), l AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), f AS (
  SELECT *, first(CASE WHEN cap > level * w THEN level END IGNORE NULLS) OVER (
    ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final
  FROM l
), t AS (SELECT source, source_size, rk, CASE WHEN final IS NULL THEN cap ELSE least(cap, final * w) END AS target FROM f),
p AS (
  SELECT d.*, t.source_size, t.target, t.rk,
    sum(size) OVER (PARTITION BY d.source ORDER BY ord, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      - size / 2.0 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
u AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE CASE WHEN middle < target THEN 1 ELSE 0 END
    + CASE WHEN middle + source_size < target THEN 1 ELSE 0 END END AS uses,
    {_factor(0)} AS f0, {_factor(1)} AS f1, {_factor(2)} AS f2
  FROM p
), a AS (SELECT *, (f0 + f1) * {_half(0)} AS first_area, (f1 + f2) * {_half(1)} AS second_area FROM u),
h AS (SELECT *, middle / target * (first_area + second_area) AS want FROM a WHERE uses > 0),
due AS (
  SELECT doc_id, size, CASE WHEN want <= first_area
    THEN {_times[0]} + 2.0 * want / (f0 + sqrt(greatest(f0 * f0 + 2.0 * ((f1 - f0) / {2 * _half(0)}) * want, 0.0)))
    ELSE {_times[1]} + 2.0 * (want - first_area) / (f1 + sqrt(greatest(f1 * f1 + 2.0 * ((f2 - f1) / {2 * _half(1)}) * (want - first_area), 0.0)))
    END AS due
  FROM h
)
SELECT u.doc_id, u.size, source_size, target, CAST(u.size * uses AS BIGINT) AS taken, CAST(uses AS BIGINT) AS uses,
  CASE WHEN due IS NOT NULL THEN round(least(greatest(due, 0.0), 1.0), 6) END AS first_position
FROM u LEFT JOIN due ON due.doc_id = u.doc_id
"""


def _op9() -> str:
    lengths = (3, *quality.MAX_COVERAGE)
    unions = " UNION ALL ".join(
        f"SELECT doc_id, i, word, {n} AS k, CASE WHEN i + {n - 1} <= len(ws) THEN array_to_string(ws[i : i + {n - 1}], ' ') END AS gram FROM w"
        for n in lengths
    )
    limits = " AND ".join(
        f"coalesce(max(chars) FILTER (WHERE k = {n}), 0) / greatest(max(word_chars), 1) <= {most}" for n, most in quality.MAX_COVERAGE.items()
    )
    covered = " ".join(
        f"WHEN k = {n} THEN max(twice) OVER (PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in lengths
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
w AS (SELECT doc_id, ws, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM d),
g AS ({unions}),
c AS (
  SELECT *, CASE WHEN gram IS NULL THEN 0 WHEN k = 3 AND count(*) OVER (PARTITION BY doc_id, k, gram) > 1 THEN 1
    WHEN k > 3 AND row_number() OVER (PARTITION BY doc_id, k, gram ORDER BY i) > 1 THEN 1 ELSE 0 END AS twice FROM g),
m AS (SELECT doc_id, k, word, CASE {covered} END AS inside FROM c),
r AS (SELECT doc_id, k, sum(inside) AS words, sum(inside * length(word)) AS chars, sum(length(word)) AS word_chars FROM m GROUP BY doc_id, k),
v AS (
  SELECT doc_id, max(word_chars) AS word_chars, max(words) FILTER (WHERE k = 3) AS n_repeat_words, {limits} AS fine FROM r GROUP BY doc_id
), x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
y AS (SELECT doc_id, line, count(*) AS n FROM x WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line),
z AS (
  SELECT doc_id, sum(n - 1) AS dup, sum((n - 1) * strlen(line)) AS dup_bytes, sum(n) AS n_lines, sum(n * strlen(line)) AS bytes
  FROM y GROUP BY doc_id
), f AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(fine, true) AND coalesce((dup / n_lines <= {quality.MAX_LINE_SHARE} OR dup < {quality.MIN_DUP_LINES}) AND dup_bytes / bytes <= {quality.MAX_LINE_CHARS}, true) AS fine
  FROM d LEFT JOIN v ON v.doc_id = d.doc_id LEFT JOIN z ON z.doc_id = d.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  fine AND NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words) AS kept
FROM f
"""

_P = "1 + (1000000000 * (CAST({0} AS HUGEINT) + {prior})) // ({1} + {prior} * CAST(v AS HUGEINT))"


def _op11() -> str:
    p = lambda count, n: _P.format(count, n, prior=divergence.PRIOR)
    folded = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({folded.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), w AS (SELECT id, lang, source, unnest(ts) AS term FROM d), c AS (
  SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term
), kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {divergence.MIN_DOCS}),
k AS (SELECT c.* FROM c JOIN kept USING (lang, term)), g AS (SELECT DISTINCT lang, source FROM d),
size AS (SELECT lang, source, sum(n) AS n FROM k GROUP BY lang, source),
l AS (SELECT lang, (SELECT count(*) FROM kept WHERE kept.lang = x.lang) AS v FROM (SELECT DISTINCT lang FROM g) x),
whole AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS all_n FROM k GROUP BY lang, term),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(k.n, 0) AS n, {p("coalesce(k.n, 0)", "coalesce(size.n, 0)")} AS p
  FROM g JOIN l ON l.lang = g.lang JOIN kept ON kept.lang = g.lang
  LEFT JOIN k ON k.lang = g.lang AND k.source = g.source AND k.term = kept.term
  LEFT JOIN size ON size.lang = g.lang AND size.source = g.source
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY a.lang, a.source, b.source
), q AS (SELECT whole.lang, term, {p("n", "all_n")} AS q FROM whole JOIN l ON l.lang = whole.lang), mark AS (
  SELECT p.lang, p.source, p.term AS item, p - q AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term
  WHERE p.n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM mark
  QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= {divergence.TOP}
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked
"""


#: crc32 of the ASCII digits of a number: one step a bit, under the reflected polynomial.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, (x & 1) * 3988292384))))"""


def _field(column: str) -> str:
    return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_LEVELS = """
  SELECT tree, k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), max((n + 1) // 2)
  FROM {0} WHERE n > 1 GROUP BY tree, k, i // 2"""

#: Levels of all trees, then of the one over their roots; each leaf's siblings; the tampered leaf folded up again.
OP13 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('v' || lang, '') AS tree, {_leaf('n_chars')} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC32.format('doc_id')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} END AS tampered
  FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM d
), nodes AS (
  SELECT tree, 0 AS k, pos AS i, leaf AS h, n FROM r UNION ALL {_LEVELS.format('nodes')}
), tops AS (SELECT tree, h, k FROM nodes WHERE n = 1), t AS (
  SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM tops
), upper AS (
  SELECT tree, 0 AS k, pos AS i, h, n FROM t UNION ALL {_LEVELS.format('upper')}
), root AS (SELECT h AS root FROM upper WHERE n = 1), steps AS (
  SELECT r.tree, r.pos, a.k, xor(r.pos >> a.k, 1) AS sibling FROM r
  JOIN (SELECT DISTINCT tree, k FROM nodes WHERE n > 1) a ON a.tree = r.tree
), low AS (
  SELECT s.tree, s.pos, list(struct_pack(h := x.h, up := (s.pos >> s.k) % 2 = 1) ORDER BY s.k) AS p
  FROM steps s LEFT JOIN nodes x ON x.tree = s.tree AND x.k = s.k AND x.i = s.sibling GROUP BY s.tree, s.pos
), high AS (
  SELECT t.name, list(struct_pack(h := x.h, up := (t.pos >> a.k) % 2 = 1) ORDER BY a.k) AS p
  FROM t JOIN (SELECT DISTINCT k FROM upper WHERE n > 1) a ON true
  LEFT JOIN upper x ON x.k = a.k AND x.i = xor(t.pos >> a.k, 1) GROUP BY t.name
), whole AS (
  SELECT r.doc_id, r.leaf, t.h AS subroot, root, coalesce(tampered, leaf) AS start,
    list_concat(coalesce(low.p, []), coalesce(high.p, [])) AS p
  FROM r JOIN t ON t.name = r.tree CROSS JOIN root
  LEFT JOIN low ON low.tree = r.tree AND low.pos = r.pos LEFT JOIN high ON high.name = r.tree
), f AS (
  SELECT *, (list_reduce(list_concat([struct_pack(h := start, up := false)], p), lambda a, x: struct_pack(
    h := sha256(CASE WHEN x.up THEN coalesce(x.h, '') || a.h ELSE a.h || coalesce(x.h, '') END), up := false))).h AS folded
  FROM whole
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: coalesce(x.h, '')), '')) AS proof_sha256,
  folded AS folded_root, folded = root AS verified
FROM f
"""


ORACLES = {
    "op1_embedding_dedup": OP1,
    "op5_warc": OP5,
    "op6_chat_format": OP6,
    "op7_substring_dedup": OP7,
    "op8_mixing": OP8,
    "op9_quality_rules": _op9(),
    "op11_source_divergence": _op11(),
    "op13_merkle_manifest": OP13,
}
