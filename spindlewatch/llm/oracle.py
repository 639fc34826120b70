"""SQL twins for DuckDB of those queries that SQL can express on whole tables."""

from __future__ import annotations

from spindlewatch.llm.common import ORACLE
from spindlewatch.llm.mixing import POWERS, ROUNDS, SEED, TOKEN_SHARE

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

ORACLE["op2_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE["op4_warc_normaliser"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM p
), bits AS (
  SELECT *, list_reduce(list_transform(range(1, 41), lambda i:
      right(to_binary(strpos('0123456789abcdef', substr(digest, i, 1)) + 15), 4)), lambda a, b: a || b) AS b FROM f
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       list_reduce(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(1, 6), lambda j:
           CASE WHEN substr(b, CAST(5 * i + j AS BIGINT), 1) = '1' THEN CAST(power(2, 5 - j) AS BIGINT) ELSE 0 END)) AS BIGINT), 1)),
         lambda a, c: a || c) AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM bits
"""

ORACLE["op5_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
      THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)
), reach AS (
  SELECT a AS x, b AS y FROM links UNION SELECT x, b FROM reach JOIN links ON y = a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(r.low, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(r.low, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) r ON r.x = w.doc_id
"""

ORACLE["op9_phrase_dedup"] = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(ws) - 18)) AS p FROM w
), windows AS (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 19], ' ')) AS g FROM starts JOIN w USING (doc_id)
), later AS (
  SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM later
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def _mixing(powers: dict[str, float], rounds: int, share: float, seed: str) -> str:
    def part(kept: str) -> str:
        return f"length(translate(text, '{kept}', '')) / CAST(greatest(length(text), 1) AS DOUBLE)"

    steps = []
    last = "targets"
    for i in range(rounds):
        for name in powers:
            step = f"r{i}_{name}"
            steps.append(
                f"{step} AS (SELECT * REPLACE (CASE WHEN weight > 0 THEN weight * t_{name} / sum(weight) OVER (PARTITION BY {name})"
                f" ELSE 0 END AS weight) FROM {last})"
            )
            last = step
    margins = ", ".join(f"sum(CAST(tokens AS DOUBLE)) OVER (PARTITION BY {n}) AS m_{n}" for n in powers)
    firsts = ", ".join(
        f"CASE WHEN row_number() OVER (PARTITION BY {n} ORDER BY source_cell, lang_cell, topic_cell) = 1 AND m_{n} > 0"
        f" THEN power(m_{n}, {p}) ELSE 0 END AS f_{n}"
        for n, p in powers.items()
    )
    targets = ", ".join(
        f"CASE WHEN m_{n} > 0 THEN power(m_{n}, {p}) * sum(CAST(tokens AS DOUBLE)) OVER () / sum(f_{n}) OVER () ELSE 0 END AS t_{n}"
        for n, p in powers.items()
    )
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS source_cell, coalesce(lang, '') AS lang_cell,
         CASE WHEN text IS NULL OR length(text) = 0 THEN 'empty'
              WHEN {part('|')} < 0.98 THEN 'table'
              WHEN {part('#$%&*{}<>=;@')} < 0.95 THEN 'symbols'
              WHEN {part(UPPER)} < 0.7 THEN 'shouting'
              WHEN {part(chr(10))} < 0.98 THEN 'lines' ELSE 'prose' END AS topic_cell,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS n_tokens
  FROM documents
), cells AS (
  SELECT source_cell, lang_cell, topic_cell, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM docs GROUP BY ALL
), margins AS (SELECT *, CAST(tokens AS DOUBLE) AS weight, {margins} FROM cells
), firsts AS (SELECT *, {firsts} FROM margins
), targets AS (SELECT *, {targets} FROM firsts
), {', '.join(steps)}, ordered AS (
  SELECT *, CASE WHEN tokens > 0 THEN weight / tokens END AS ratio FROM {last}
), known AS (
  SELECT *, coalesce(sum(tokens) OVER before, 0) AS t_before, coalesce(sum(weight) OVER before, 0) AS w_before,
         sum(tokens) OVER () AS all_tokens, sum(weight) OVER () AS all_weight
  FROM ordered
  WINDOW before AS (ORDER BY ratio DESC NULLS LAST, source_cell, lang_cell, topic_cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), scaled AS (
  SELECT *, CASE WHEN all_weight - w_before > 0 THEN ({share} * all_tokens - t_before) / (all_weight - w_before) END AS scale FROM known
), chances AS (
  SELECT source_cell, lang_cell, topic_cell, round(CASE WHEN tokens > 0 THEN coalesce(least(1.0, greatest(0.0,
           ratio * max(CASE WHEN scale * ratio <= 1 THEN scale END) OVER ())), 1.0) ELSE 1.0 END, 6) AS probability
  FROM scaled
)
SELECT doc_id, source_cell, lang_cell, topic_cell, n_tokens, CAST(probability AS DOUBLE) AS probability,
       CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{seed}'), 1, 8) AS BIGINT) / 4294967296.0 < probability AS kept
FROM docs JOIN chances USING (source_cell, lang_cell, topic_cell)
"""


ORACLE["op1_source_mixing"] = _mixing(POWERS, ROUNDS, TOKEN_SHARE, SEED)


def _crc32(octets: str) -> str:
    """Checksum of a list of octets, bit by bit."""
    step = "xor(x // 2, CASE WHEN x % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END)"
    octet = f"list_reduce(list_prepend(xor(c, o), CAST(range(8) AS BIGINT[])), lambda x, i: {step})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST({octets} AS BIGINT[])), lambda c, o: {octet}), CAST(4294967295 AS BIGINT))"


def _octets(text: str) -> str:
    """Octets of a text whose characters lie below U+0800."""
    return (
        f"flatten(list_transform(range(1, length({text}) + 1), lambda k: CASE WHEN unicode(substr({text}, k, 1)) < 128 "
        f"THEN [unicode(substr({text}, k, 1))] "
        f"ELSE [192 + unicode(substr({text}, k, 1)) // 64, 128 + unicode(substr({text}, k, 1)) % 64] END))"
    )


def _framed(text: str) -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)


def _beside(nodes: str, group: str) -> str:
    frame = f"OVER (PARTITION BY {group}lvl, pos // 3 ORDER BY pos ROWS BETWEEN"
    return f"""
  SELECT *, coalesce(string_agg(node, '') {frame} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') {frame} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {nodes} WHERE n > 1"""


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256({_framed("text")}) AS leaf,
         CASE WHEN {_crc32(_octets("CAST(doc_id AS VARCHAR)"))} % 2 = 0
              THEN sha256({_framed("replace(text, chr(10), '')")}) ELSE sha256({_framed("text")}) END AS shown
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d
), up AS (
  SELECT source, 0 AS lvl, pos, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
  FROM up WHERE n > 1 GROUP BY source, lvl, pos // 3, n
), sources AS (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM up WHERE n = 1
), over_sources AS (
  SELECT 0 AS lvl, place AS pos, subroot AS node, count(*) OVER () AS n FROM sources
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
  FROM over_sources WHERE n > 1 GROUP BY lvl, pos // 3, n
), low AS ({_beside("up", "source, ")}
), high AS ({_beside("over_sources", "")}
), steps AS (
  SELECT l.source, l.pos, s.lvl AS step, s.before, s.after
  FROM leaves l JOIN low s ON l.source IS NOT DISTINCT FROM s.source AND s.pos = l.pos // CAST(power(3, s.lvl) AS BIGINT)
  UNION ALL
  SELECT l.source, l.pos, 1000 + h.lvl, h.before, h.after
  FROM leaves l JOIN sources s ON l.source IS NOT DISTINCT FROM s.source
  JOIN high h ON h.pos = s.place // CAST(power(3, h.lvl) AS BIGINT)
), paths AS (
  SELECT source, pos, list(before || '|' || after ORDER BY step) AS sides, string_agg(before || after, '' ORDER BY step) AS beside
  FROM steps GROUP BY source, pos
), done AS (
  SELECT l.doc_id, l.leaf, s.subroot, (SELECT node FROM over_sources WHERE n = 1) AS root,
         sha256(coalesce(p.beside, '')) AS proof_sha256,
         list_reduce(list_prepend(l.shown, coalesce(p.sides, [])),
           lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
  FROM leaves l JOIN sources s ON l.source IS NOT DISTINCT FROM s.source
  LEFT JOIN paths p ON l.source IS NOT DISTINCT FROM p.source AND l.pos = p.pos
)
SELECT *, folded_root = root AS verified FROM done
"""

_DROPPED = "CAST(h % length(w) AS BIGINT)"

ORACLE["op13_spelling_variants"] = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{6,}}')), '{UPPER}', '{LOWER}') AS w
  FROM documents
), counted AS (
  SELECT doc_id, w, count(*) AS n, CAST(doc_id AS VARCHAR) || ':' || w AS named FROM runs GROUP BY doc_id, w
), hashed AS (
  SELECT w, n, {_crc32(_octets("named"))} AS h FROM counted WHERE named IS NOT NULL
  UNION ALL SELECT w, n, 1 FROM counted WHERE named IS NULL
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(w, 1, {_DROPPED}) || substr(w, {_DROPPED} + 2) ELSE w END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words
), cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places
), shorter AS (
  SELECT DISTINCT c.word AS a, w.word AS b FROM cuts c JOIN words w ON c.rest = w.word
), near AS (
  SELECT a, b FROM shorter UNION SELECT b, a FROM shorter
  UNION SELECT x.word, y.word FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
), best AS (
  SELECT a, b, w.n AS b_n, count(*) OVER (PARTITION BY a) AS n_near,
         row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS r FROM near JOIN words w ON w.word = b
), forms AS (
  SELECT w.word, w.n, coalesce(f.n_near, 0) AS n_near, CASE WHEN f.b_n >= 5 * w.n THEN f.b END AS form,
         CASE WHEN f.b_n >= 5 * w.n THEN f.b_n END AS form_n
  FROM words w LEFT JOIN best f ON f.a = w.word AND f.r = 1
), ways AS (
  SELECT word, form AS last_form, 1 AS step FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT ways.word, forms.form, step + 1 FROM ways JOIN forms ON forms.word = ways.last_form WHERE forms.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(last_form, step) AS root FROM ways GROUP BY word
)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n FROM forms f LEFT JOIN ends e USING (word)
"""
