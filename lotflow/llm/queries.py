"""The queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from lotflow.llm.decontaminate import op7_decontamination
from lotflow.llm.html_text import op5_html_text
from lotflow.llm.langid import op10_language_id
from lotflow.llm.licenses import op8_licenses, templates
from lotflow.llm.manifest import LOWER, UPPER, op13_manifest
from lotflow.llm.neardup import op4_near_duplicates
from lotflow.llm.packing import op3_packing
from lotflow.llm.pii import op9_pii
from lotflow.llm.ranking import op11_ranked_search
from lotflow.llm.repeats import op12_suffix_dedup
from lotflow.llm.secrets import op1_secrets
from lotflow.llm.token_counts import op2_token_counts
from lotflow.llm.vectors import op6_embedding_links

QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_token_counts": op2_token_counts,
    "op3_packing": op3_packing,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_html_text": op5_html_text,
    "op6_embedding_links": op6_embedding_links,
    "op7_decontamination": op7_decontamination,
    "op8_licenses": op8_licenses,
    "op9_pii": op9_pii,
    "op10_language_id": op10_language_id,
    "op11_ranked_search": op11_ranked_search,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_manifest": op13_manifest,
}

OP7 = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT rid, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM docs),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
         FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM wins),
places AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
           FROM (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT rid, p.n, i, item_id FROM places p JOIN wins USING (n, win)),
covered AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""

OP4 = r"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS rid, doc_id,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT rid, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
             FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
common AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid <> b.rid GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT rid AS a, rid AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT reach.a AS rid, min(doc_id) AS component_id FROM reach JOIN docs ON docs.rid = reach.b GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs LEFT JOIN sizes USING (rid) JOIN least USING (rid)
"""

OP6 = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS x FROM embeddings),
good AS (SELECT * FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
links AS (SELECT a.rid AS a, b.rid AS b FROM good a JOIN good b ON len(a.x) = len(b.x) AND a.rid <> b.rid AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach AS (SELECT rid AS a, rid AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT reach.a AS rid, min(vec_id) AS component_id FROM reach JOIN v ON v.rid = reach.b GROUP BY 1),
counts AS (SELECT a AS rid, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN counts USING (rid) JOIN least USING (rid)
"""

_ROWS = ", ".join(str(tuple(v.replace("\n", " ") if isinstance(v, str) else v for v in row)) for row in templates())
OP8 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, concat_ws('/', source, doc_id // 1000, doc_id // 100, doc_id) AS path,
       concat_ws('/', source, doc_id // 1000, doc_id // 100) AS folder, coalesce(text, '') AS text FROM documents),
n AS (SELECT count(*) AS n FROM docs),
freq AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT rid, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS word FROM docs) WHERE word <> '' GROUP BY 1),
given_rows AS (SELECT * FROM (VALUES {_ROWS}) t(id, license, slot, level, statement, must, within)),
needs AS (SELECT id, license, slot, level, within, list_filter(string_split(must, ' '), lambda w: w <> '') AS must FROM given_rows),
tw AS (SELECT id, word, count(*) AS tf FROM (SELECT id, unnest(string_split_regex(lower(statement), '[^a-z0-9]+')) AS word FROM given_rows) WHERE word <> '' GROUP BY 1, 2),
tv AS (SELECT id, word, tf * (ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0) AS w FROM tw LEFT JOIN freq USING (word), n),
tn AS (SELECT id, sqrt(sum(w * w)) AS norm FROM tv GROUP BY 1),
cuts AS (SELECT rid, 0 AS level, string_split_regex(text, '[.!?][ \t\r\n]+|\n') AS s FROM docs
         UNION ALL SELECT rid, 1, string_split_regex(text, '[.!?][ \t\r\n]+|\n[^A-Za-z0-9]*\n') FROM docs UNION ALL SELECT rid, 2, [text] FROM docs),
segs AS (SELECT rid, level, generate_subscripts(s, 1) AS line, unnest(s) AS seg FROM cuts),
sw AS (SELECT rid, level, line, length(seg) AS chars, word, count(*) AS tf FROM (SELECT rid, level, line, seg, unnest(string_split_regex(lower(seg), '[^a-z0-9]+')) AS word FROM segs) WHERE word <> '' GROUP BY ALL),
sv AS (SELECT rid, level, line, chars, word, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w FROM sw JOIN freq USING (word), n),
sn AS (SELECT rid, level, line, sqrt(sum(w * w)) AS norm FROM sv GROUP BY 1, 2, 3),
dots AS (SELECT rid, x.level, line, chars, id, sum(x.w * tv.w) AS dot, count(*) FILTER (list_contains(must, word)) AS held
         FROM sv x JOIN tv USING (word) JOIN needs USING (id) WHERE x.level = needs.level GROUP BY 1, 2, 3, 4, 5),
scored AS (SELECT rid, d.level, line, chars, license, slot, within, round(dot / sn.norm / tn.norm, 6) AS score
           FROM dots d JOIN sn USING (rid, level, line) JOIN tn USING (id) JOIN needs USING (id) WHERE held = len(must)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid, level, line, slot ORDER BY score DESC, license, within) AS r FROM scored WHERE score >= 0.7) WHERE r = 1),
sized AS (SELECT rid, max(chars) AS chars FROM (SELECT rid, level, sum(chars) AS chars FROM (SELECT DISTINCT rid, level, line, chars FROM best) GROUP BY 1, 2) GROUP BY 1),
named AS (SELECT rid, license, max(score) AS score, bool_or(within = '') AS alone, max(within) AS within FROM best GROUP BY 1, 2),
meant AS (SELECT * FROM named a WHERE alone OR NOT EXISTS (SELECT 1 FROM named b WHERE b.rid = a.rid AND b.license = a.within)),
own AS (SELECT rid, array_to_string(list_sort(list(license)), ',') AS licenses, max(score) AS score, chars, arg_min(license, (-score, license)) AS license FROM meant JOIN sized USING (rid) GROUP BY rid, chars),
files AS (SELECT folder, path, license, o.score FROM docs JOIN own o USING (rid) WHERE 4 * chars >= length(text)),
given AS (SELECT folder AS above, license AS given, path AS from_path FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY score DESC, path) AS r FROM files) WHERE r = 1),
above AS (SELECT folder, depth, array_to_string(parts[1:depth], '/') AS above FROM (SELECT folder, string_split(folder, '/') AS parts, unnest(range(0, len(string_split(folder, '/')) + 1)) AS depth FROM (SELECT DISTINCT folder FROM docs))),
nearest AS (SELECT * FROM (SELECT folder, given, from_path, row_number() OVER (PARTITION BY folder ORDER BY depth DESC) AS r FROM above JOIN given USING (above)) WHERE r = 1)
SELECT doc_id, path, coalesce(licenses, '') AS licenses, coalesce(score, 0.0)::DOUBLE AS score, coalesce(license, given) AS license,
       CASE WHEN licenses IS NOT NULL THEN 'own' WHEN given IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN licenses IS NULL THEN from_path END AS from_path
FROM docs LEFT JOIN own USING (rid) LEFT JOIN nearest USING (folder)
"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
stats AS (SELECT count(*) FILTER (len(w) > 0) AS docs, coalesce(sum(len(w)), 0)::BIGINT AS words FROM docs),
items AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark),
asked AS (SELECT q, term, count(*) AS repeats FROM (SELECT q, unnest(w) AS term FROM items) GROUP BY 1, 2),
held AS (SELECT rid, n, term, count(*) AS tf FROM (SELECT rid, len(w) AS n, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2, 3),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, stats GROUP BY term, docs),
scores AS (SELECT q, rid, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))))::BIGINT AS score
           FROM asked JOIN weights USING (term) JOIN held USING (term), stats GROUP BY 1, 2),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores JOIN docs USING (rid) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (q) WHERE rank <= 10
"""

OP12 = """
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (SELECT rid, begin, substr(h, 2 * begin + 1, 1398) AS part FROM (SELECT rid, h, unnest(range(0, len(h) // 2 - 199, 500)) AS begin FROM docs WHERE len(h) >= 400)),
wins AS (SELECT rid, begin + j AS i, md5(substr(part, 2 * j + 1, 400)) AS k FROM (SELECT rid, begin, part, unnest(range(0, len(part) // 2 - 199)) AS j FROM parts)),
starts AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM wins WHERE k IN (SELECT k FROM wins GROUP BY k HAVING count(*) > 1)),
runs AS (SELECT rid, i, count(*) FILTER (before IS NULL OR i > before + 200) OVER (PARTITION BY rid ORDER BY i) AS run FROM starts),
spans AS (SELECT rid, min(i) AS a, max(i) + 200 AS z FROM runs GROUP BY rid, run),
rest AS (SELECT rid, a, z, lead(a) OVER (PARTITION BY rid ORDER BY a) AS next FROM (SELECT rid, a, z FROM spans UNION ALL SELECT rid, -1, 0 FROM docs)),
kept AS (SELECT rid, string_agg(substr(h, 2 * z + 1, 2 * (coalesce(next, len(h) // 2) - z)), '' ORDER BY a) AS kept, sum(z - a) FILTER (a >= 0) AS n_removed, count(*) - 1 AS n_spans
         FROM rest JOIN docs USING (rid) GROUP BY rid)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM docs JOIN kept USING (rid)
"""

OP13 = f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS rid, doc_id, lang, text, translate(text, '{UPPER}', '{LOWER}') AS low,
       concat({", ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars"))}) AS head,
       list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda crc, byte:
           list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc FROM documents),
leaves AS (SELECT rid, doc_id, coalesce('1' || lang, '0') AS g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS other FROM texts),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM leaves),
trees AS (SELECT g, 0 AS level, idx, n, leaf AS node FROM placed
          UNION ALL SELECT g, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY idx)) FROM trees WHERE n > 1 GROUP BY g, level, idx // 8, n),
subroots AS (SELECT g, node AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS place, count(*) OVER () AS n FROM trees WHERE n = 1),
roots AS (SELECT 0 AS level, place AS idx, n, subroot AS node FROM subroots
          UNION ALL SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY idx)) FROM roots WHERE n > 1 GROUP BY level, idx // 8, n),
every AS (SELECT g, level, idx, node FROM trees WHERE n > 1 UNION ALL SELECT NULL, 100 + level, idx, node FROM roots WHERE n > 1),
beside AS (SELECT g, level, idx, coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM every WINDOW run AS (PARTITION BY g, level, idx // 8 ORDER BY idx)),
path AS (SELECT rid, l, r, row_number() OVER (PARTITION BY rid ORDER BY level) AS step FROM (
         SELECT rid, level, l, r FROM placed JOIN beside b ON b.g = placed.g AND b.idx = placed.idx // (8 ** level)::BIGINT
         UNION ALL SELECT rid, level, l, r FROM placed JOIN subroots USING (g) JOIN beside b ON b.g IS NULL AND b.idx = place // (8 ** (level - 100))::BIGINT)),
folds AS (SELECT rid, 0::BIGINT AS step, other AS node FROM placed
          UNION ALL SELECT f.rid, f.step + 1, sha256(l || node || r) FROM folds f JOIN path p ON p.rid = f.rid AND p.step = f.step + 1),
folded AS (SELECT rid, arg_max(node, step) AS folded_root FROM folds GROUP BY 1),
proofs AS (SELECT rid, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM path GROUP BY 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (g) JOIN folded USING (rid) LEFT JOIN proofs USING (rid), (SELECT node AS root FROM roots WHERE n = 1)
"""

ORACLES: dict[str, str] = {"op4_near_duplicates": OP4, "op6_embedding_links": OP6, "op7_decontamination": OP7, "op8_licenses": OP8, "op11_ranked_search": OP11, "op12_suffix_dedup": OP12, "op13_manifest": OP13}
