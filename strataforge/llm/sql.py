"""SQL twins, for DuckDB, of the queries that SQL can express on the whole tables."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = f"regexp_extract_all({_LOWER.format('coalesce(text, $$$$)')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_PLAIN_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"

# near: from the places of each window's rarest word, all its words within 15 (or its size and 5) words, as often as it has them
OP1 = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + 9], ' ') AS phrase, w[i : i + 9] AS words FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
found AS (SELECT doc_id, i, s.size, item_id FROM places CROSS JOIN (SELECT DISTINCT size FROM win) s JOIN win ON win.size = s.size AND win.phrase = array_to_string(w[i : i + s.size - 1], ' ') WHERE i + s.size - 1 <= len(w)),
hit AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id),
common AS (SELECT w[i] AS word, count(*) AS n FROM places GROUP BY w[i]),
lead AS (SELECT phrase, words, size, arg_min(word, coalesce(n, 0)) AS word FROM (SELECT DISTINCT phrase, words, size, unnest(words) AS word FROM win) LEFT JOIN common USING (word) GROUP BY phrase, words, size),
around AS (SELECT doc_id, phrase, words, size, w, i FROM places JOIN lead ON lead.word = w[i] WHERE list_has_all(w[greatest(i - size - 4, 1) : i + size + 4], words)),
near AS (SELECT DISTINCT doc_id, phrase FROM (SELECT doc_id, phrase, words, w[greatest(s, 1) : s + size + 4] AS part FROM (SELECT *, unnest(range(i - size - 4, i + 1)) AS s FROM around))
  WHERE len(list_filter(words, lambda x: len(list_filter(part, lambda y: y = x)) < len(list_filter(words, lambda y: y = x)))) = 0),
near_items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM near JOIN win USING (phrase)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(items.listed, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated,
  coalesce(near_items.n, 0) AS n_near_items, sha256(coalesce(near_items.listed, '')) AS near_items_sha256
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id LEFT JOIN near_items ON near_items.doc_id = d.doc_id
"""

# two lines of 24 characters or more that are one edit apart share their first or their last 12 characters
OP3 = r"""
WITH l AS (SELECT doc_id, i, raw, trim(raw, E' \t\r\x0b\x0c') AS line FROM (SELECT doc_id, unnest(string_split(text, E'\n')) AS raw, unnest(range(len(string_split(text, E'\n')))) AS i FROM documents WHERE text IS NOT NULL)),
first AS (SELECT line, min(ROW(doc_id, i)) AS pos FROM l WHERE length(line) > 0 GROUP BY line),
long_ AS (SELECT * FROM first WHERE length(line) >= 24),
pairs AS (SELECT a.line, b.pos FROM long_ a JOIN long_ b ON left(a.line, 12) = left(b.line, 12) WHERE b.pos < a.pos AND abs(length(a.line) - length(b.line)) < 2 AND levenshtein(a.line, b.line) < 2
  UNION ALL SELECT a.line, b.pos FROM long_ a JOIN long_ b ON right(a.line, 12) = right(b.line, 12) WHERE b.pos < a.pos AND abs(length(a.line) - length(b.line)) < 2 AND levenshtein(a.line, b.line) < 2),
least_at AS (SELECT line, min(pos) AS pos FROM (SELECT line, pos FROM first UNION ALL SELECT line, pos FROM pairs) GROUP BY line),
kept AS (SELECT l.doc_id, i, raw, least_at.pos IS NULL OR ROW(l.doc_id, l.i) <= least_at.pos AS keep FROM l LEFT JOIN least_at ON least_at.line = l.line),
out AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT keep) AS n_dropped, coalesce(string_agg(raw, E'\n' ORDER BY i) FILTER (WHERE keep), '') AS t FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(t, '')) AS text_sha256, CAST(length(coalesce(t, '')) AS BIGINT) AS n_chars FROM documents d LEFT JOIN out ON out.doc_id = d.doc_id
"""

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_PLAIN_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS phrase FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, phrase FROM win GROUP BY doc_id, phrase HAVING count(*) > 1),
rep AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, p FROM (SELECT win.doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice ON twice.doc_id = win.doc_id AND twice.phrase = win.phrase)) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, E'\\n')) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
same AS (SELECT doc_id, count(*) FILTER (WHERE w[i] = w[i + 1]) AS n FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d) GROUP BY doc_id),
c AS (SELECT d.doc_id, text, CAST(len(w) AS BIGINT) AS n, CAST(length(array_to_string(w, '')) AS BIGINT) AS chars, CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS symbols,
    coalesce(lines.n, 0) AS dup, coalesce(rep.n, 0) AS rep, len(string_split(text, E'\\n')) AS all_lines, 100 * CASE WHEN len(w) <= 5000 THEN len(list_distinct(w)) ELSE list_sum(list_transform(range(0, (len(w) - 1) // 5000 + 1), lambda i: len(list_distinct(w[least(i * 5000, len(w) - 5000) + 1 : least(i * 5000, len(w) - 5000) + 5000])))) END
      < 20 * CASE WHEN len(w) <= 5000 THEN len(w) ELSE 5000 * ((len(w) - 1) // 5000 + 1) END AS few, coalesce(same.n, 0) AS same,
    length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ', '')) AS upper, length(text) - length(translate(text, '!?', '')) AS marks, length(text) - length(translate(text, '0123456789', '')) AS digits
  FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id LEFT JOIN lines ON lines.doc_id = d.doc_id LEFT JOIN same ON same.doc_id = d.doc_id),
f AS (SELECT *, n < 20 OR 100 * rep > 30 * n AS failed FROM c)
SELECT doc_id, n AS n_words, chars AS word_chars, symbols AS n_symbols, dup AS n_dup_lines, rep AS n_repeat_words, failed AS base_failed,
  NOT (failed OR 100 * symbols > 10 * n OR 2 * dup > all_lines OR chars > 14 * n OR chars < 2 * n OR 100 * upper > 30 * chars OR 100 * marks > 10 * n OR 100 * digits > 25 * chars
    OR (n >= 50 AND few) OR (n >= 20 AND 100 * same > 15 * n)) AS kept FROM f
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_PLAIN_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least_of.b AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) least_of ON least_of.a = d.doc_id
"""

def _spans(name: str, source: str, column: str, pattern: str, keys: str = "doc_id") -> str:
    """Common table `name` (keys, start, value): matches of a pattern, placed by running sums of the lengths of the matches and of what split leaves between them."""
    return f"""{name} AS (SELECT {keys}, value, CAST(sum(length(gap)) OVER (PARTITION BY {keys} ORDER BY i) + sum(length(value)) OVER (PARTITION BY {keys} ORDER BY i) - length(value) AS BIGINT) AS start
  FROM (SELECT {keys}, i, gaps[i] AS gap, hits[i] AS value FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT {keys}, string_split_regex({column}, '{pattern}') AS gaps, regexp_extract_all({column}, '{pattern}') AS hits FROM {source} WHERE regexp_matches({column}, '{pattern}')))))"""


def _listed(columns: str, order: str) -> str:
    return f"coalesce(string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY {order}){columns}, '')"


# a quote in a SQL string is written twice
_ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"

# entropy of a window of 20 characters: c log2 c of each count, in millionths, summed; the limits are those of the classes
OP10 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_spans("assign_", "d", "text", _ASSIGN)},
{_spans("access_", "d", "text", "AKIA[A-Z0-9]{14,}")},
{_spans("hex_", "d", "text", "[0-9a-f]{16,}")},
{_spans("any_hex", "d", "text", "[0-9A-Fa-f]{20,}")},
{_spans("any_36", "d", "text", "[0-9a-z]{20,}|[0-9A-Z]{20,}")},
{_spans("any_64", "d", "text", "[A-Za-z0-9+/_=-]{20,}")},
base AS (SELECT doc_id, 0 AS k, 'assign' AS kind, start, start + length(value) AS stop FROM assign_ WHERE length(regexp_extract(value, '{_ASSIGN}', 1)) >= 12
  UNION ALL SELECT doc_id, 1, 'access', start, start + length(value) FROM access_ UNION ALL SELECT doc_id, 2, 'hex', start, start + length(value) FROM hex_),
runs AS (SELECT * FROM (SELECT *, 3.0 AS least, '[0-9].*[A-Fa-f]|[A-Fa-f].*[0-9]' AS needs FROM any_hex UNION ALL SELECT *, 3.5, '[0-9].*[A-Za-z]|[A-Za-z].*[0-9]' FROM any_36
    UNION ALL SELECT *, 3.9, '(?:[0-9][A-Za-z]|[A-Za-z][0-9]).*(?:[0-9][A-Za-z]|[A-Za-z][0-9])' FROM any_64)
  WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND NOT regexp_matches(value, '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$')),
win AS (SELECT doc_id, start, value, least, needs, pos, substring(value, pos, 20) AS w FROM (SELECT *, unnest(range(1, length(value) - 18)) AS pos FROM runs)),
chars AS (SELECT doc_id, start, least, needs, value, pos, w, ch, count(*) AS c FROM (SELECT *, unnest(string_split(w, '')) AS ch FROM win) GROUP BY ALL),
random_ AS (SELECT DISTINCT doc_id, start, start + length(value) AS stop FROM (SELECT doc_id, start, least, needs, value, pos, w, sum(CAST(round(1000000 * c * log2(c)) AS BIGINT)) AS s FROM chars GROUP BY ALL)
  WHERE s <= floor(20 * (log2(20) - least) * 1000000) AND regexp_matches(w, needs) AND NOT regexp_matches(w, '(?i)example|sample|placeholder|dummy|xxxx|0000000')),
added AS (SELECT doc_id, 3 AS k, 'entropy' AS kind, start, stop FROM random_ r
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.start <= r.start AND b.stop >= r.stop)
    AND NOT EXISTS (SELECT 1 FROM random_ o WHERE o.doc_id = r.doc_id AND o.start <= r.start AND o.stop >= r.stop AND o.stop - o.start > r.stop - r.start)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM added),
out AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS a, count(*) FILTER (WHERE k = 1) AS b, count(*) FILTER (WHERE k = 2) AS c, count(*) FILTER (WHERE k = 3) AS e,
  {_listed(" FILTER (WHERE k < 3)", "start, k")} AS base_list, {_listed("", "start, k, stop")} AS list FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base_list, '')) AS base_sha256, coalesce(list, '') AS spans, coalesce(e, 0) AS n_entropy
FROM d LEFT JOIN out ON out.doc_id = d.doc_id
"""

_DIGITS = "regexp_replace({}, '[^0-9]', '', 'g')"
_LUHN = "list_sum(list_transform(range(1, length(n) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse(n)[i] AS INT) WHEN CAST(reverse(n)[i] AS INT) > 4 THEN 2 * CAST(reverse(n)[i] AS INT) - 9 ELSE 2 * CAST(reverse(n)[i] AS INT) END)) % 10 = 0"

OP8 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS h FROM documents),
{_spans("email_", "d", "text", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+")},
{_spans("ip_", "d", "text", "[0-9]+(?:[.][0-9]+){3}")},
{_spans("card_", "d", "text", "[0-9](?:[ -]?[0-9])+")},
{_spans("phone_", "d", "text", "[+][0-9][ ().0-9-]+[0-9]")},
found AS (SELECT doc_id, 0 AS k, 'email' AS kind, start, value, lower(value) AS entity FROM email_
  UNION ALL SELECT doc_id, 1, 'ip', start, value, value FROM ip_ WHERE len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(ltrim(p, '0') AS BIGINT), 0) > 255)) = 0
  UNION ALL SELECT doc_id, 2, 'card', start, value, n FROM (SELECT *, {_DIGITS.format("value")} AS n FROM card_) WHERE length(n) BETWEEN 13 AND 19 AND {_LUHN}
  UNION ALL SELECT doc_id, 3, 'phone', start, value, n FROM (SELECT *, {_DIGITS.format("value")} AS n FROM phone_) WHERE length(n) BETWEEN 9 AND 15),
entity AS (SELECT DISTINCT h, k || ':' || entity AS entity FROM found f JOIN d ON d.doc_id = f.doc_id),
{_spans("word", "d", "text", "\\p{L}+")},
apart AS (SELECT word.doc_id, h, lower(value) AS term, start, start + length(value) AS stop FROM word JOIN d ON d.doc_id = word.doc_id
  WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.doc_id = word.doc_id AND f.start <= word.start + length(word.value) AND f.start + length(f.value) >= word.start)),
n AS (SELECT count(DISTINCT h) AS n FROM d),
holds AS (SELECT entity, count(*) AS n_e FROM entity GROUP BY entity),
held AS (SELECT h, unnest(list_distinct(regexp_extract_all(lower(text), '\\p{{L}}+'))) AS term FROM (SELECT DISTINCT h, text FROM d)),
pair AS (SELECT entity, term, count(*) AS n_te FROM held JOIN entity USING (h) GROUP BY entity, term HAVING count(*) >= 3),
words AS (SELECT term, count(*) AS n_t FROM held WHERE term IN (SELECT term FROM pair) GROUP BY term),
told AS (SELECT DISTINCT pair.term FROM pair JOIN words ON words.term = pair.term JOIN holds ON holds.entity = pair.entity CROSS JOIN n
  WHERE n.n > n_e AND log2(n_te * CAST(n.n AS DOUBLE) / (n_t * n_e)) >= 0.9 * log2(CAST(n.n AS DOUBLE) / n_e)),
every AS (SELECT doc_id, k, kind, start, start + length(value) AS stop FROM found
  UNION ALL SELECT doc_id, 4, 'term', start, stop FROM apart WHERE term IN (SELECT term FROM told)),
out AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS e, count(*) FILTER (WHERE k = 1) AS i, count(*) FILTER (WHERE k = 2) AS c, count(*) FILTER (WHERE k = 3) AS p, count(*) FILTER (WHERE k = 4) AS t,
  {_listed(" FILTER (WHERE k < 4)", "k, start")} AS base_list, {_listed("", "k, start")} AS list FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(e, 0) AS n_email, coalesce(i, 0) AS n_ip, coalesce(c, 0) AS n_card, coalesce(p, 0) AS n_phone, sha256(coalesce(base_list, '')) AS base_sha256, coalesce(list, '') AS spans, coalesce(t, 0) AS n_term
FROM d LEFT JOIN out ON out.doc_id = d.doc_id
"""

OP11 = rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
gram AS (SELECT lang, s, unnest(list_transform(range(1, len(w) - s + 2), lambda i: array_to_string(w[i : i + s - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3]) AS s)),
f AS (SELECT lang, s, phrase, count(*) AS f, string_split(phrase, ' ') AS p FROM gram GROUP BY lang, s, phrase),
size AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE s = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE s > 1 AND f >= 10),
inner_ AS (SELECT lang, unnest([array_to_string(p[1:2], ' '), array_to_string(p[2:3], ' ')]) AS phrase, f FROM cand WHERE s = 3),
most AS (SELECT lang, phrase, max(f) AS f FROM inner_ GROUP BY lang, phrase),
kept AS (SELECT cand.* FROM cand LEFT JOIN most ON most.lang = cand.lang AND most.phrase = cand.phrase WHERE most.f IS NULL OR 100 * most.f < 50 * cand.f),
cuts AS (SELECT lang, s, phrase, f, k, array_to_string(p[1:k], ' ') AS a, array_to_string(p[k + 1:], ' ') AS b FROM kept, (SELECT unnest([1, 2]) AS k) WHERE k < s),
scored AS (SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, k, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.a AND x.s = k JOIN f y ON y.lang = c.lang AND y.phrase = c.b AND y.s = c.s - k),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best JOIN size ON size.lang = best.lang QUALIFY row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

OP12 = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, i, md5(hex(b[i + 1 : i + 100])) AS w FROM (SELECT doc_id, b, unnest(range(octet_length(b) - 99)) AS i FROM d)),
gone AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
run AS (SELECT doc_id, i, i > 100 + lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) AS new FROM gone),
cut AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM (SELECT doc_id, i, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS r FROM run) GROUP BY doc_id, r),
edge AS (SELECT doc_id, list(lo ORDER BY lo) AS los, list(hi ORDER BY lo) AS his, sum(hi - lo) AS removed FROM cut GROUP BY doc_id),
kept AS (SELECT d.doc_id, b, removed, len(los) AS n_spans, CASE WHEN los IS NULL THEN hex(b) ELSE array_to_string(list_transform(range(1, len(los) + 2),
  lambda k: hex(b[CASE WHEN k = 1 THEN 1 ELSE his[k - 1] + 1 END : CASE WHEN k > len(los) THEN octet_length(b) ELSE los[k] END])), '') END AS left_ FROM d LEFT JOIN edge ON edge.doc_id = d.doc_id)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(left_)) AS kept_sha256 FROM kept
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
first AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
w AS (SELECT d.doc_id, part, d.text, first, regexp_extract_all(d.text, '[^\x20\x09-\x0D]+') AS w FROM d JOIN first ON first.text = d.text),
m AS (SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN first < doc_id THEN 16 ELSE 0 END AS mask FROM w),
cell AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic FROM m LEFT JOIN labels ON labels.doc_id = m.doc_id GROUP BY part, mask),
f AS (SELECT unnest([0, 1, 2, 3, 4]) AS k),
orders AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS ks FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps AS (SELECT array_to_string(list_transform(ks, lambda k: chr(65 + k)), '') AS filter_order, step, 1 << ks[step] AS bit, list_sum(list_transform(ks[: step - 1], lambda k: 1 << k))::BIGINT AS seen FROM (SELECT ks, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
out AS (SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (WHERE mask & (bit | coalesce(seen, 0)) = 0), 0) AS kept, coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & coalesce(seen, 0) = 0), 0) AS removed,
  coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & coalesce(seen, 0) > 0), 0) AS redundant, coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
  coalesce(sum(good) FILTER (WHERE mask & bit > 0 AND mask & coalesce(seen, 0) = 0), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & coalesce(seen, 0) = 0), 0) AS toxic_lost
  FROM cell, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM out
"""

SQL = {"op1_decontaminate": OP1, "op3_line_dedup": OP3, "op4_quality_rules": OP4, "op8_pii": OP8, "op9_jaccard_join": OP9, "op10_secret_scan": OP10, "op11_collocations": OP11, "op12_suffix_dedup": OP12, "op13_filter_audit": OP13}
