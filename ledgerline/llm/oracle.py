"""SQL checks for DuckDB of the operators whose result SQL can express."""

from __future__ import annotations

from ledgerline.llm.sharding import ROUNDS

SEARCH = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""

ARCHIVE = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS least FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> least THEN least END AS refers_to
FROM p LEFT JOIN f ON f.d = p.d"""


def _crc_step(value: str) -> str:
    """CRC-32 over the lower four bits of a value: the rest, and the polynomial's remainder of these bits."""
    table = list(range(16))
    for _ in range(4):
        table = [x >> 1 ^ (0xEDB88320 if x & 1 else 0) for x in table]
    return f"xor(({value}) >> 4, [{', '.join(map(str, table))}][(({value}) & 15) + 1])"


def shards(count: int, seed: int) -> str:
    """The permutation as a recursion: one round a step, until a walk of all rounds ends on a row number."""
    draw = f"CAST('0x' || substr(md5('{seed}:' || (t % {ROUNDS}) || ':' || {{}}), 1, 15) AS BIGINT)"
    crc = _crc_step(_crc_step("xor(c, b)"))
    return f"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
sums AS (
  SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size,
    xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(h, '..'), lambda x: CAST('0x' || x AS BIGINT)),
      lambda c, b: {crc}, CAST(4294967295 AS BIGINT))) AS text_crc32
  FROM texts),
sides AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT count(*) AS n, greatest(1, CAST(floor(sqrt(count(*))) AS BIGINT)) AS a FROM documents)),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS i FROM sums),
walk AS (
  SELECT i, i // b AS l, i % b AS r, 0 AS t, n, a, b FROM numbered, sides
  UNION ALL
  SELECT i, CASE WHEN t % 2 = 0 THEN (l + {draw.format('r')}) % a ELSE l END,
    CASE WHEN t % 2 = 1 THEN (r + {draw.format('l')}) % b ELSE r END, t + 1, n, a, b
  FROM walk WHERE t = 0 OR t % {ROUNDS} > 0 OR l * b + r >= n),
ends AS (SELECT i, l * b + r AS x FROM walk WHERE t > 0 AND t % {ROUNDS} = 0 AND l * b + r < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {count} AS INTEGER) AS shard, x // {count} AS slot,
  CAST(NULL AS INTEGER) AS grown_shard FROM numbered JOIN ends USING (i)"""


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes."""
    crc = _crc_step(_crc_step("xor(c, b)"))
    return f"""xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT)),
      lambda c, b: {crc}, CAST(4294967295 AS BIGINT)))"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE = f"""
WITH RECURSIVE plain AS MATERIALIZED (
  SELECT doc_id, source, {_LEAF.format('text')} AS leaf,
    CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_LEAF.format(_LOWER)} END AS changed
  FROM documents),
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('s' || source, '') AS s, leaf, coalesce(changed, leaf) AS own, row_number() OVER () AS r,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM plain),
low AS (
  SELECT s, 0 AS l, i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT s, l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM low WHERE n > 1 GROUP BY s, l, i // 16, n),
tops AS MATERIALIZED (
  SELECT s, h AS subroot, row_number() OVER (ORDER BY encode(s)) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS l, i, subroot AS h, n FROM tops
  UNION ALL
  SELECT l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM high WHERE n > 1 GROUP BY l, i // 16, n),
runs AS MATERIALIZED (
  SELECT s, l, i // 16 AS j, n, list(h ORDER BY i) AS hs FROM low GROUP BY s, l, i // 16, n
  UNION ALL
  SELECT NULL, l, i // 16, n, list(h ORDER BY i) FROM high GROUP BY l, i // 16, n),
fold_low AS (
  SELECT r, s, 0 AS l, i, n, own AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT r, f.s, f.l + 1, i // 16, (f.n + 15) // 16,
    sha256(array_to_string(hs[:i % 16], '') || h || array_to_string(hs[i % 16 + 2:], '')),
    proof || array_to_string(hs[:i % 16], '') || array_to_string(hs[i % 16 + 2:], '')
  FROM fold_low f JOIN runs u ON u.s = f.s AND u.l = f.l AND u.j = i // 16 WHERE f.n > 1),
fold_high AS (
  SELECT r, 0 AS l, t.i, t.n, h, proof FROM fold_low f JOIN tops t USING (s) WHERE f.n = 1
  UNION ALL
  SELECT r, f.l + 1, i // 16, (f.n + 15) // 16,
    sha256(array_to_string(hs[:i % 16], '') || h || array_to_string(hs[i % 16 + 2:], '')),
    proof || array_to_string(hs[:i % 16], '') || array_to_string(hs[i % 16 + 2:], '')
  FROM fold_high f JOIN runs u ON u.s IS NULL AND u.l = f.l AND u.j = i // 16 WHERE f.n > 1)
SELECT doc_id, leaf, subroot, root.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM leaves JOIN tops USING (s) JOIN (SELECT * FROM fold_high WHERE n = 1) f USING (r), (SELECT h FROM high WHERE n = 1) root"""

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counts AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run),
drawn AS (SELECT *, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM counts),
spoilt AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM drawn),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoilt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS MATERIALIZED (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) AS t(i)),
pairs AS (
  SELECT a.word, b.word AS other FROM holes a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word FROM holes a JOIN words b ON a.rest = b.word
  UNION
  SELECT a.word, b.word FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
near AS (
  SELECT p.word, count(*) AS n_near, arg_min(p.other, {{'n': -o.n, 'w': encode(p.other)}}) AS best, max(o.n) AS best_n
  FROM pairs p JOIN words o ON o.word = p.other GROUP BY p.word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
    CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)),
walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT walk.word, f.form FROM walk JOIN formed f ON f.word = walk.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk ON walk.word = f.word JOIN formed e ON e.word = walk.at WHERE e.form IS NULL"""
