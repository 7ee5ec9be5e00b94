"""SQL that must give the rows of the queries it is named after."""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words_of(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


NEAR_DEDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, {words_of(LOWERED)} AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) >= 2
        THEN list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) ELSE ws END) AS g FROM w),
n AS (SELECT doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.b) AS component_id, min(r.b) = n.doc_id AS kept
FROM n JOIN reach r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

LINE_DEDUP = """
WITH lines AS (SELECT page, source, unnest(string_split(text, chr(10))) AS line FROM (SELECT *, row_number() OVER () AS page FROM documents)),
site AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
often AS (SELECT source, line FROM lines JOIN site USING (source) WHERE regexp_matches(line, '[^ \\x09-\\x0D]')
          GROUP BY source, line, total HAVING count(DISTINCT page) >= 3 AND 100 * count(DISTINCT page) > 7 * total),
site_lines AS (SELECT source, list(line) AS lines FROM often GROUP BY source)
SELECT d.doc_id, d.source,
       CASE WHEN s.lines IS NULL OR d.text IS NULL THEN d.text
            ELSE array_to_string(list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(s.lines, x)), chr(10)) END AS text,
       CASE WHEN s.lines IS NULL OR d.text IS NULL THEN 0
            ELSE len(list_filter(string_split(d.text, chr(10)), lambda x: list_contains(s.lines, x))) END AS lines_dropped
FROM documents d LEFT JOIN site_lines s USING (source)
"""

WARC = """
WITH payload AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT payload_digest, min(page_id) AS page_id FROM payload WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.page_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.page_id <> p.page_id THEN f.page_id END AS refers_to
FROM payload p LEFT JOIN first f USING (payload_digest)
"""

# Words between white space and ASCII punctuation; an item's windows around the shingles it shares with a text.
SPLIT = "'[\\x09-\\x0D\\x20-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E]+'"
LEAKS = f"""
WITH texts AS (SELECT doc_id, list_filter(regexp_split_to_array({LOWERED}, {SPLIT}), lambda x: x <> '') AS ws FROM documents),
items AS (SELECT *, len(ws) AS n, least(5, len(ws)) AS size
          FROM (SELECT item_id, list_filter(regexp_split_to_array({LOWERED}, {SPLIT}), lambda x: x <> '') AS ws FROM benchmark)
          WHERE len(ws) > 0),
item_grams AS (SELECT item_id, size, g, count(*) AS c
               FROM (SELECT item_id, size, array_to_string(ws[k + 1 : k + size], ' ') AS g FROM items, unnest(range(n - size + 1)) AS r(k)) GROUP BY ALL),
sizes AS (SELECT DISTINCT size FROM items),
grams AS (SELECT doc_id, size, k AS pos, array_to_string(ws[k + 1 : k + size], ' ') AS g
          FROM texts, sizes, unnest(range(greatest(len(ws) - size + 1, 0))) AS r(k)),
anchors AS (SELECT doc_id, item_id, size, pos FROM grams JOIN item_grams USING (size, g)),
spans AS (SELECT a.*, len(t.ws) - a.size + 1 AS m, i.n - i.size + 1 AS total, least(i.n - i.size + 1, len(t.ws) - a.size + 1) AS spread
          FROM anchors a JOIN texts t USING (doc_id) JOIN items i USING (item_id)),
starts AS (SELECT DISTINCT doc_id, item_id, size, spread, total, least(greatest(pos - k, 0), m - spread) AS start
           FROM spans, unnest(range(spread)) AS r(k)),
counted AS (SELECT s.doc_id, s.item_id, s.size, spread, total, start, g.g, count(*) AS wc
            FROM starts s JOIN grams g ON g.doc_id = s.doc_id AND g.size = s.size AND g.pos BETWEEN s.start AND s.start + s.spread - 1 GROUP BY ALL),
compared AS (SELECT doc_id, item_id, size, spread, total, start, sum(least(wc, coalesce(c, 0))) AS least
             FROM counted LEFT JOIN item_grams USING (item_id, size, g) GROUP BY ALL),
ranked AS (SELECT *, least::DOUBLE / (spread + total - least)::DOUBLE AS similarity,
                  row_number() OVER (PARTITION BY doc_id, item_id ORDER BY least::DOUBLE / (spread + total - least)::DOUBLE DESC, start) AS place
           FROM compared WHERE 100 * least >= 80 * (spread + total - least))
SELECT doc_id, item_id, similarity, start AS first_word, spread + size - 1 AS n_words FROM ranked WHERE place = 1
"""

def _cut_out(source: str, columns: str, size: int) -> str:
    """Every run of `size` words of the lists `ws` of a relation."""
    phrase = " || ' ' || ".join(f"ws[k + {i}]" for i in range(size))
    return f"SELECT {columns}, {phrase} AS phrase FROM (SELECT {columns}, ws, unnest(range(1, len(ws) - {size - 2})) AS k FROM {source} WHERE len(ws) >= {size})"


GRAMS = " UNION ALL ".join(f"SELECT lang, {size} AS size, phrase, count(*) AS f FROM ({_cut_out('pieces', 'lang', size)}) GROUP BY ALL" for size in (1, 2, 3, 4))
INSIDE = " UNION ALL ".join(_cut_out(f"(SELECT * FROM candidates WHERE size > {size})", "lang, a", size) for size in (2, 3))
COLLOCATIONS = f"""
WITH pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws
                FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS ({GRAMS}),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM grams WHERE size > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, a, k, array_to_string(ws[1 : k], ' ') AS one, array_to_string(ws[k + 1 :], ' ') AS other
         FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) + y.f) AS score
           FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.one JOIN grams y ON y.lang = c.lang AND y.phrase = c.other),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(a) AS most FROM ({INSIDE}) GROUP BY ALL),
ranked AS (SELECT s.lang, s.phrase, a, l, r, score, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
           FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
           WHERE most IS NULL OR CAST(100 AS HUGEINT) * most < CAST(80 AS HUGEINT) * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op2_benchmark_decontamination": LEAKS,
    "op3_minhash_near_dedup": NEAR_DEDUP,
    "op9_line_dedup": LINE_DEDUP,
    "op10_warc": WARC,
    "op11_collocations": COLLOCATIONS,
}
