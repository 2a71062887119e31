"""DuckDB counterparts of the registered queries that SQL can express."""

from crawltable.llm.repetition import BASE_NGRAM, SYMBOLS, Rules

WORD = r"[^\x20\x09-\x0D]"


def quality(rules: Rules = Rules()) -> str:
    """Counts by windows over the words of each text, n-grams compared as texts."""
    lengths = sorted(rules.ngrams)
    every = sorted({BASE_NGRAM, *lengths})
    grams = ", ".join(
        f"CASE WHEN i + {n - 1} <= len(ws) THEN array_to_string(ws[i:i + {n - 1}], ' ') END AS g{n}"
        for n in every
    )
    twice = ", ".join(
        f"CASE WHEN g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1 "
        f"THEN 1 ELSE 0 END AS d{n}"
        for n in every
    )
    covered = ", ".join(
        f"max(d{n}) OVER (PARTITION BY doc_id ORDER BY i "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}"
        for n in every
    )
    chars = ", ".join(f"sum(c{n} * size)::BIGINT" for n in lengths)
    limits = " OR ".join(
        f"100 * dup_ngram_chars[{k + 1}] > {rules.ngrams[n]} * word_chars" for k, n in enumerate(lengths)
    )
    zeros = ", ".join("0" for _ in lengths)
    return f"""
      WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
      words AS (SELECT doc_id, regexp_extract_all(text, '{WORD}+') AS ws FROM docs),
      placed AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
      grams AS (SELECT doc_id, i, length(ws[i]) AS size, {grams} FROM placed),
      twice AS (SELECT doc_id, i, size, {twice} FROM grams),
      covered AS (SELECT doc_id, size, {covered} FROM twice),
      counted AS (SELECT doc_id, count(*) AS n_words, sum(size)::BIGINT AS word_chars,
                         sum(c{BASE_NGRAM})::BIGINT AS n_repeat_words, [{chars}] AS dup_ngram_chars
                  FROM covered GROUP BY doc_id),
      lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
      again AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines,
                       sum((n - 1) * length(line))::BIGINT AS dup_line_chars
                FROM (SELECT doc_id, line, count(*) AS n FROM lines
                      WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id, line) GROUP BY doc_id),
      measured AS (
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
               length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(dup_line_chars, 0) AS dup_line_chars,
               coalesce(dup_ngram_chars, [{zeros}]::BIGINT[]) AS dup_ngram_chars
        FROM docs d LEFT JOIN counted c ON d.doc_id = c.doc_id LEFT JOIN again a ON d.doc_id = a.doc_id),
      base AS (SELECT *, n_words < {rules.min_words}
                         OR 100 * n_repeat_words > {rules.max_repeat_words} * n_words AS base_failed
               FROM measured)
      SELECT *, NOT base_failed AND NOT (
               100 * dup_line_chars > {rules.max_dup_line_chars} * word_chars
               OR 100 * n_symbols > {rules.max_symbols} * n_words OR {limits}) AS kept
      FROM base"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ranked() -> str:
    return f"""
      WITH words AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS ws
                     FROM documents),
      docs AS (SELECT doc_id, ws, len(ws) AS n FROM words WHERE len(ws) > 0),
      total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS size FROM docs),
      held AS (SELECT doc_id, n, term, count(*) AS tf
               FROM (SELECT doc_id, n, unnest(ws) AS term FROM docs) GROUP BY ALL),
      asked AS (SELECT item_id, term, count(*) AS times
                FROM (SELECT item_id, unnest(regexp_extract_all(
                        translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark) GROUP BY ALL),
      weights AS (SELECT term, docs, size,
                         floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
                  FROM held, total WHERE term IN (SELECT term FROM asked) GROUP BY term, docs, size),
      parts AS (SELECT doc_id, term,
                       w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // size))) AS part
                FROM held JOIN weights USING (term)),
      scores AS (SELECT item_id, doc_id, sum(times * part)::BIGINT AS score
                 FROM asked JOIN parts USING (term) GROUP BY ALL),
      ranked AS (SELECT item_id, doc_id, score, row_number() OVER (
                          PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
                 FROM scores WHERE score > 0)
      SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


def negatives() -> str:
    return """
      WITH given AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
               list_dot_product(a.v, r.v)::BIGINT AS score
        FROM given a JOIN given r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
      positives AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
      found AS (
        SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
         AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
      SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
      FROM found WHERE rank <= 3"""
