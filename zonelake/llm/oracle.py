"""DuckDB statements of the operators that SQL can express."""

from __future__ import annotations

from zonelake.llm.licenses import HINT, RULES, SENTENCES
from zonelake.llm.repetition import DUP, LIMITS, TOP

WORDS = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def repetition() -> str:
    """Windows as joined words; a word is covered if a marked window starts at
    it or at one of the n - 1 words before it."""
    parts = [f"""
docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos, len(ws) AS n_words
      FROM (SELECT rid, regexp_extract_all(text, '{WORDS}') AS ws FROM docs)),
lines AS (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS no
          FROM (SELECT rid, string_split(text, chr(10)) AS ls FROM docs)),
full_lines AS (SELECT rid, no > min(no) OVER (PARTITION BY rid, line) AS again,
                      length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars
               FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
by_lines AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (again) AS n_dup_lines,
                    coalesce(sum(chars) FILTER (again), 0) AS dup_line_chars FROM full_lines GROUP BY rid),
by_words AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY rid)"""]
    measures = []
    for n in range(2, max(DUP) + 1):
        gram = "word" + "".join(f" || ' ' || lead(word, {k}) OVER p" for k in range(1, n))
        parts.append(f"""
g{n} AS (SELECT rid, pos, {gram} AS gram FROM w WINDOW p AS (PARTITION BY rid ORDER BY pos))""")
        parts.append(f"""
c{n} AS (SELECT rid, pos, gram, count(*) OVER (PARTITION BY rid, gram) AS n,
                min(pos) OVER (PARTITION BY rid, gram) AS first FROM g{n} WHERE gram IS NOT NULL)""")
        marks = []
        if n in TOP:
            parts.append(f"""
t{n} AS (SELECT DISTINCT ON (rid) rid, gram FROM c{n} WHERE n > 1
         ORDER BY rid, n DESC, length(gram) DESC, first)""")
            marks.append((f"top_{n}", f"SELECT rid, pos FROM c{n} JOIN t{n} USING (rid, gram)", "length(word)"))
        if n in DUP:
            marks.append((f"dup_{n}", f"SELECT rid, pos FROM c{n} WHERE pos > first", "length(word)"))
        if n == 3:
            marks.append(("n_repeat_words", "SELECT rid, pos FROM c3 WHERE n > 1", "1"))
        for name, marked, value in marks:
            measures.append(name)
            parts.append(f"""
m_{name} AS (SELECT rid, sum(value) AS {name} FROM (
    SELECT w.rid, {value} AS value, max(m.pos IS NOT NULL) OVER (
        PARTITION BY w.rid ORDER BY w.pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS hit
    FROM w LEFT JOIN ({marked}) m ON w.rid = m.rid AND w.pos = m.pos) WHERE hit GROUP BY rid)""")
    limits = " AND ".join(f"100 * coalesce({k}, 0) <= {v} * coalesce({'n_lines' if k == 'n_dup_lines' else 'word_chars'}, 0)"
                          for k, v in LIMITS.items())
    joins = "".join(f" LEFT JOIN m_{m} USING (rid)" for m in measures)
    return f"""
WITH {",".join(parts)},
base AS (SELECT *, coalesce(n_words, 0) < 50
                   OR 100 * coalesce(n_repeat_words, 0) > 50 * coalesce(n_words, 0) AS base_failed
         FROM docs LEFT JOIN by_words USING (rid) LEFT JOIN by_lines USING (rid){joins})
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
       coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
       base_failed, NOT base_failed AND {limits} AS kept
FROM base"""


PHRASES = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        {ASCII_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
listed AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws)) AS n FROM listed GROUP BY lang),
starts AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM listed),
grams AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m
          FROM starts, (VALUES (1), (2), (3), (4), (5)) AS sizes(m) WHERE i + m - 1 <= len(ws)),
f AS MATERIALIZED (SELECT lang, phrase, m, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, phrase, m, a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2),
cuts AS (SELECT c.*, k, array_to_string(ws[1:k], ' ') AS lw, array_to_string(ws[k + 1:m], ' ') AS rw
         FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM cand) c),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, t.n,
                  (1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = lw
                JOIN f y ON y.lang = c.lang AND y.phrase = rw JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(ws[i:i + m2 - 1], ' ') AS phrase, max(a) AS outer_a
           FROM (SELECT *, unnest(generate_series(1, m - m2 + 1)) AS i
                 FROM (SELECT *, unnest(generate_series(2, m - 1)) AS m2 FROM cand WHERE m > 2))
           GROUP BY ALL),
placed AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
           FROM best b LEFT JOIN inside USING (lang, phrase) WHERE outer_a IS NULL OR outer_a < a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM placed WHERE rank <= 2000"""


NEGATIVES = """
WITH good AS MATERIALIZED (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT * FROM good WHERE id % 50 = 0),
pairs AS MATERIALIZED (
    SELECT a.id AS anchor_id, a.label = b.label AS same, b.id,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS s
    FROM anchors a JOIN good b ON b.id <> a.id),
pos AS (SELECT anchor_id, id AS positive_id, s AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= 5),
neg AS (SELECT p.*, n.id AS negative_id, n.s AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.s DESC, n.id) AS rank
        FROM pos p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 50 * positive_score <= 100 * n.s AND 100 * n.s <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 3"""


def statements() -> dict[str, str]:
    return {"op5_licenses": licenses(), "op11_repetition": repetition(), "op12_phrases": PHRASES, "op13_hard_negatives": NEGATIVES}


def licenses() -> str:
    """Sentences cut, looked up and put in order with joins; then one step a
    rule over a string with a character for each sentence found."""
    space = r"[ \t\n\x0B\f\r]"
    letter = {x: chr(0x100 + k) for k, x in enumerate(SENTENCES)}
    known = ", ".join(f"('{x}', '{letter[x]}', '{text}')" for x, text in SENTENCES.items())
    parts = [f"""
known(id, letter, sentence) AS (VALUES {known}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents WHERE text IS NOT NULL),
cut AS (SELECT rid, string_split(regexp_replace(regexp_replace(text, '([.!?:;]){space}+', '\\1' || chr(1), 'g'),
                                                '\\n{space}*\\n', chr(1), 'g'), chr(1)) AS pieces FROM docs),
pieces AS (SELECT rid, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS place FROM cut),
forms AS (SELECT rid, place, form, min(line) AS line FROM (
    SELECT rid, place, 0 AS line, regexp_replace(piece, '{space}+', ' ', 'g') AS form FROM pieces
    UNION ALL
    SELECT rid, place, generate_subscripts(ls, 1), unnest(ls)
    FROM (SELECT rid, place, string_split(piece, chr(10)) AS ls FROM pieces)) GROUP BY ALL),
found AS (SELECT rid, string_agg(letter, '' ORDER BY place, line, id) AS s0
          FROM forms JOIN known ON sentence = trim(regexp_replace(lower(form), '[^a-z0-9]+', ' ', 'g'))
          WHERE regexp_matches(form, '{HINT}') GROUP BY rid)"""]
    last, rows = "found", []
    for k, (name, sequence) in enumerate(RULES):
        pattern = f"([^{letter[sequence[0]]}]*)".join(letter[x] for x in sequence)
        kept = "".join(f"\\{i + 1}" for i in range(len(sequence) - 1))
        parts.append(f"""
r{k} AS (SELECT rid, len(regexp_extract_all(s{k}, '{pattern}')) AS n, regexp_replace(s{k}, '{pattern}', '{kept}', 'g') AS s{k + 1}
         FROM {last})""")
        last = f"r{k}"
        rows.append(f"SELECT rid, '{name}' AS license, '{'+'.join(sequence)}' AS rule, n FROM r{k} WHERE n > 0")
    return ("WITH " + ",".join(parts) + " SELECT doc_id, license, rule, CAST(n AS BIGINT) AS n_matches FROM ("
            + " UNION ALL ".join(rows) + ") JOIN docs USING (rid)")
