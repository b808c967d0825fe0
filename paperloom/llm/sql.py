"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from paperloom.llm import licences, line_chunks, quality_rules, sharding

WORDS = "string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+')"

MIX = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
r AS (SELECT *, source_size * 3 AS cap, (source_size * 3) / w AS ratio FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), w * coalesce((SELECT level FROM l WHERE level <= ratio ORDER BY ratio, level LIMIT 1), 0.0)) AS target FROM l),
p AS (
  SELECT d.*, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CAST(floor(target) AS BIGINT) AS goal, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS rounds FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(rounds * size + greatest(0, least(goal - rounds * source_size - before, size)) AS BIGINT) AS taken FROM q
"""

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
i AS (SELECT k, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5),
five AS (SELECT k, i, words[i:i + 4] AS x FROM i),
again AS (SELECT k, i FROM five QUALIFY count(*) OVER (PARTITION BY k, x) > 1),
inside AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest(range(i, i + 5)) AS j FROM again) GROUP BY k),
long AS (
  SELECT DISTINCT k FROM (SELECT k, i, words[i:i + {quality_rules.LONGEST}] AS x FROM i WHERE i + {quality_rules.LONGEST} <= len(words))
  QUALIFY count(*) OVER (PARTITION BY k, x) > 1),
line AS (
  SELECT k, CAST(sum(n - 1) AS BIGINT) AS n FROM (
    SELECT k, x, count(*) AS n FROM (SELECT k, unnest(string_split(text, chr(10))) AS x FROM d)
    WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY k, x) GROUP BY k),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(line.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(inside.n, 0) AS BIGINT) AS n_repeat_words, long.k IS NOT NULL AS long
  FROM w LEFT JOIN inside USING (k) LEFT JOIN line USING (k) LEFT JOIN long USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT long AS kept
FROM m
"""


def _licences() -> str:
    """The same index as relations: words with places, document frequencies, votes, comparison."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    templates = ", ".join(f"({i}, '{t.label}', {quoted(t.text.split())}, {quoted(t.key.split())})" for i, t in enumerate(licences.TEMPLATES))
    base = ", ".join(f"('{label}', {quoted(p.split())})" for p, label in licences.BASE)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
t(t, label, words, phrase) AS (VALUES {templates}),
b(label, words) AS (VALUES {base}),
v AS (SELECT DISTINCT word FROM (SELECT unnest(words) AS word FROM t UNION ALL SELECT unnest(words) FROM b)),
p AS (SELECT k, unnest(words) AS word, unnest(range(len(words))) AS p FROM d),
o AS (SELECT k, word, p FROM p JOIN v USING (word)),
f AS (SELECT word, count(DISTINCT k) AS df FROM o GROUP BY word),
r AS (SELECT v.word, row_number() OVER (ORDER BY coalesce(df, 0), v.word) AS rank FROM v LEFT JOIN f USING (word)),
tw AS (SELECT t, unnest(words) AS word, unnest(range(len(words))) AS q FROM t),
post AS (SELECT t, word FROM (SELECT DISTINCT t, word FROM tw) JOIN r USING (word) QUALIFY row_number() OVER (PARTITION BY t ORDER BY rank) <= {licences.POSTINGS}),
vote AS (
  SELECT o.k, tw.t, o.p - tw.q AS place, count(DISTINCT o.word) AS n
  FROM o JOIN post USING (word) JOIN tw ON tw.t = post.t AND tw.word = o.word GROUP BY ALL),
hit AS (
  SELECT vote.k, vote.t, t.label, place,
         (SELECT count(*) FROM tw JOIN o ON o.k = vote.k AND o.word = tw.word AND o.p = place + tw.q WHERE tw.t = vote.t) / CAST(len(t.words) AS DOUBLE) AS share
  FROM vote JOIN t USING (t) JOIN d USING (k)
  WHERE n >= {licences.AGREE} AND place + (list_position([array_to_string(t.words[i:i + len(t.phrase) - 1], ' ') FOR i IN range(1, len(t.words) + 1)], array_to_string(t.phrase, ' ')) - 1) >= 0
    AND d.words[place + list_position([array_to_string(t.words[i:i + len(t.phrase) - 1], ' ') FOR i IN range(1, len(t.words) + 1)], array_to_string(t.phrase, ' ')):
                place + list_position([array_to_string(t.words[i:i + len(t.phrase) - 1], ' ') FOR i IN range(1, len(t.words) + 1)], array_to_string(t.phrase, ' ')) + len(t.phrase) - 1] = t.phrase),
good AS (SELECT * FROM hit WHERE share >= {licences.SHARE}),
bh AS (
  SELECT o.k, b.label, o.p FROM o JOIN b ON o.word = b.words[1] JOIN d ON d.k = o.k WHERE d.words[o.p + 1:o.p + len(b.words)] = b.words),
bs AS (SELECT k, count(*) AS n, min(p) AS a, max(p) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM bh GROUP BY k),
al AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT k, label FROM bh UNION SELECT k, label FROM good) GROUP BY k),
sc AS (SELECT k, max(share) AS share FROM good GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(a AS BIGINT) AS first_word, CAST(z AS BIGINT) AS last_word,
       coalesce(bs.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0) END AS score
FROM d LEFT JOIN bs USING (k) LEFT JOIN al USING (k) LEFT JOIN sc USING (k)
"""


LICENCES = _licences()


def _crc32() -> str:
    """CRC-32 of each distinct text, a byte at a time over the usual table."""
    rows = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        rows.append(value)
    return str(rows)


def _place(node: sharding.Node) -> str:
    if node.shard is not None:
        return str(node.shard)
    if len(node.children) == 1:
        return _place(node.children[0])
    straws = [f"ln((CAST('0x' || substr(md5(key || ':{c.name}'), 1, 12) AS BIGINT) + 1)::DOUBLE / {float(1 << 48)}::DOUBLE) / {float(c.weight)}::DOUBLE" for c in node.children]
    best = f"list_position([{', '.join(straws)}], list_max([{', '.join(straws)}]))"
    return f"CASE {best} " + " ".join(f"WHEN {i + 1} THEN {_place(c)}" for i, c in enumerate(node.children)) + " END"


SHARDS = f"""
WITH d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key, coalesce(text, '') AS text FROM documents),
h AS (SELECT text, hex(encode(text)) AS bytes FROM (SELECT DISTINCT text FROM d)),
c AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295::BIGINT, [CAST('0x' || substr(bytes, 2 * i - 1, 2) AS BIGINT) FOR i IN range(1, len(bytes) // 2 + 1)]),
         lambda crc, byte: xor(crc >> 8, ({_crc32()}::BIGINT[])[(xor(crc, byte) & 255) + 1])), 4294967295::BIGINT) AS crc FROM h),
p AS (
  SELECT doc_id, key, strlen(text) + 1 AS size, crc, {_place(sharding.layout(16))} AS shard, {_place(sharding.layout(17))} AS grown_shard
  FROM d JOIN c USING (text))
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY md5('slot:' || key), doc_id, crc) - 1 AS BIGINT) AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM p
"""


JACCARD = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT k, x FROM (
    SELECT k, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w] ELSE [w[i:i + 2] FOR i IN range(1, len(w) - 1)] END) AS x FROM d)),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
p AS (SELECT a.k AS a, b.k AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.k <> b.k GROUP BY a.k, b.k),
l AS (SELECT a, b FROM p JOIN n x ON a = x.k JOIN n y ON b = y.k WHERE 100 * c >= 90 * (x.n + y.n - c)),
r(k, o) AS (SELECT k, k FROM d UNION SELECT r.k, l.b FROM r JOIN l ON r.o = l.a),
m AS (SELECT r.k, min(d.doc_id) AS least FROM r JOIN d ON r.o = d.k GROUP BY r.k)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.least AS component_id
FROM d JOIN m USING (k) LEFT JOIN n USING (k)
"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, text, CASE WHEN text <> '' THEN string_split(text, chr(10)) ELSE [] END AS lines FROM documents),
l AS (SELECT k, doc_id, lines, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d),
t AS (
  SELECT k, doc_id, lines, i, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words, lead(i) OVER (PARTITION BY k ORDER BY i) AS j
  FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
w AS (
  SELECT k, doc_id, i, j, array_to_string(lines[i:j], chr(10)) AS body FROM t WHERE j IS NOT NULL
  UNION ALL
  SELECT k, doc_id, i, i, lines[i] FROM t WHERE words >= {line_chunks.LONG_WORDS}),
f AS (
  SELECT k, i, j, (doc_id, i) IS DISTINCT FROM first_value((doc_id, i)) OVER (PARTITION BY body ORDER BY doc_id NULLS LAST, i) AS later FROM w),
g AS (SELECT k, list(DISTINCT x) AS gone FROM (SELECT k, unnest(range(i, j + 1)) AS x FROM f WHERE later) GROUP BY k)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed_lines,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string([lines[i] FOR i IN range(1, len(lines) + 1) IF NOT list_contains(gone, i)], chr(10)) END AS text
FROM d LEFT JOIN g USING (k)
"""


DECONTAMINATION = """
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
q AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS many, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT k, many, unnest(range(1, len(w) - many + 2)) AS i FROM d, (SELECT DISTINCT many FROM q) WHERE len(w) >= many),
o AS (SELECT s.k, s.i, s.many, q.item_id FROM s JOIN d USING (k) JOIN q ON q.many = s.many AND q.x = array_to_string(d.w[s.i:s.i + s.many - 1], ' ')),
h AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT DISTINCT k, unnest(range(i, i + many)) AS j FROM o) GROUP BY k),
t AS (SELECT k, count(*) AS n, string_agg(item_id, ',' ORDER BY encode(item_id)) AS ids FROM (SELECT DISTINCT k, item_id FROM o) GROUP BY k)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (k) LEFT JOIN t USING (k)
"""


def _manifest() -> str:
    """The same trees level by level: nodes of all levels, siblings by their places, roots folded a level at a time."""
    fields = lambda n: " || ".join(
        f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')" for x in ("doc_id", "source", "lang", n, "text"))
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, sha256({fields('n_chars')}) AS leaf, sha256({fields('(n_chars + 1)')}) AS other, n_chars,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda crc, byte: xor(crc >> 8, ({_crc32()}::BIGINT[])[(xor(crc, byte) & 255) + 1])), 4294967295::BIGINT) AS crc
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS g FROM d),
nodes AS (
  SELECT g, 0 AS level, i, n, leaf AS h FROM p
  UNION ALL
  SELECT g, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY g, level, i // 2, n),
tops AS (SELECT g, level AS height, h FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, g AS i, (SELECT count(*) FROM tops) AS n, h FROM tops
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY level, i // 2, n),
root AS (SELECT level AS height, h FROM upper WHERE n = 1),
steps AS (
  SELECT p.g, p.i, nodes.level AS step, nodes.i < (p.i >> nodes.level) AS before, nodes.h
  FROM p JOIN tops USING (g) JOIN nodes ON nodes.g = p.g AND nodes.level < tops.height AND nodes.i = xor(p.i >> nodes.level, 1)
  UNION ALL
  SELECT p.g, p.i, tops.height + upper.level, upper.i < (p.g >> upper.level), upper.h
  FROM p JOIN tops USING (g) JOIN upper ON upper.level < (SELECT height FROM root) AND upper.i = xor(p.g >> upper.level, 1)),
proofs AS (SELECT g, i, string_agg(h, '' ORDER BY step) AS proof FROM steps GROUP BY g, i),
folds AS (
  SELECT g, i, 0 AS step, height + (SELECT height FROM root) AS last, CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN other ELSE leaf END AS h
  FROM p JOIN tops USING (g)
  UNION ALL
  SELECT f.g, f.i, f.step + 1, f.last, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.before THEN s.h || f.h ELSE f.h || s.h END)
  FROM folds f LEFT JOIN steps s ON s.g = f.g AND s.i = f.i AND s.step = f.step WHERE f.step < f.last)
SELECT p.doc_id, p.leaf, tops.h AS subroot, root.h AS root, sha256(coalesce(proofs.proof, '')) AS proof_sha256, folds.h AS folded_root, folds.h = root.h AS verified
FROM p JOIN tops USING (g) CROSS JOIN root LEFT JOIN proofs ON proofs.g = p.g AND proofs.i = p.i JOIN folds ON folds.g = p.g AND folds.i = p.i AND folds.step = folds.last
"""


MANIFEST = _manifest()
