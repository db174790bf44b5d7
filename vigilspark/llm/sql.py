"""SQL for DuckDB that states what the operators of this subpackage return, where SQL can."""

from __future__ import annotations

# The table of crc32 for bytes, made by its rule (reflected polynomial 3988292384).
_CRC_TABLE = """SELECT list_transform(range(256), lambda v: list_reduce([v] || range(8),
  lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))) AS t"""


def _crc32(text: str) -> str:
    """crc32 of a text in UTF-8, given the column ``t`` of the table."""
    byte = f"CAST(('0x' || substr(hex(encode({text})), 2 * i + 1, 2)) AS BIGINT)"
    return (f"xor(4294967295, list_reduce([4294967295] || list_transform(range(strlen({text})), lambda i: {byte}), "
            "lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])))")


SPELLING = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
low AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32("concat(CAST(doc_id AS VARCHAR), ':', run)")} AS h FROM low, crc),
lossy AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM lossy WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT x.word AS word, y.word AS other FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, w.word FROM cut x JOIN words w ON w.word = x.rest
  UNION SELECT w.word, x.word FROM cut x JOIN words w ON w.word = x.rest),
best AS (
  SELECT near.word, other, words.n AS m, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN words ON words.word = near.other
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY words.n DESC, other) = 1),
formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * words.n THEN other END AS form,
    CASE WHEN m >= 10 * words.n THEN m END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word),
walk AS (
  SELECT word, word AS at_word, form AS next_word FROM formed
  UNION ALL
  SELECT walk.word, walk.next_word, formed.form FROM walk JOIN formed ON formed.word = walk.next_word)
SELECT formed.word, form, at_word AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM formed JOIN walk ON walk.word = formed.word AND walk.next_word IS NULL"""

# Sources are capped in order of their size by weight; as long as capping the next one is right, it raises the level (words for
# a weight of 1) of the others, and later it lowers it, so the level is the highest.
MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS h
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w FROM sums),
steps AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
    coalesce(sum(source_size) OVER up, 0) AS capped, coalesce(sum(w) OVER up, 0) AS capped_w
  FROM weighed
  WINDOW up AS (ORDER BY 2 * source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT source, source_size, w, (CAST(1.5 AS DOUBLE) * CAST(total AS DOUBLE) - CAST(2 * capped AS DOUBLE)) / CAST(all_w - capped_w AS DOUBLE) AS level
  FROM steps),
found AS (
  SELECT max(level) AS level FROM levels),
aims AS (
  SELECT source, source_size, least(found.level * w, CAST(2 * source_size AS DOUBLE)) AS target FROM weighed, found),
needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM aims),
reach AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS need,
    sum(size) OVER (PARTITION BY sized.source ORDER BY h) AS up_to
  FROM sized JOIN needs ON sized.source IS NOT DISTINCT FROM needs.source)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN up_to < need OR (up_to - size < need AND 2 * (need - (up_to - size)) > size) THEN 1 ELSE 0 END) AS taken
FROM reach"""


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE concat(strlen(CAST({column} AS VARCHAR)), ':', {column}) END"


def _leaf(n_chars: str) -> str:
    return f"sha256(concat({', '.join(_field(c) for c in ('doc_id', 'source', 'lang'))}, {_field(n_chars)}, {_field('text')}))"


def _tree(name: str, leaves: str) -> str:
    """Levels of the trees over ``leaves`` (grp, idx, h): the tree's number of nodes ``n`` at the level ``lvl``."""
    return f"""{name} AS (
  SELECT grp, 0 AS lvl, idx, h, count(*) OVER (PARTITION BY grp) AS n FROM {leaves}
  UNION ALL
  SELECT grp, lvl + 1, idx // 2, CASE WHEN next IS NULL THEN sha256(h) ELSE sha256(h || next) END, (n + 1) // 2
  FROM (SELECT *, lead(h) OVER (PARTITION BY grp ORDER BY idx) AS next FROM {name} WHERE n > 1) WHERE idx % 2 = 0)"""


def _siblings(tree: str, leaves: str) -> str:
    """Siblings of every leaf by level; '-' where the run has no other."""
    return f"""
  SELECT l.grp, l.idx, p.lvl, CASE WHEN s.h IS NULL THEN '-' WHEN s.idx % 2 = 0 THEN 'L' || s.h ELSE 'R' || s.h END AS sib
  FROM {leaves} l JOIN {tree} p ON p.grp IS NOT DISTINCT FROM l.grp AND p.idx = l.idx // CAST(2 ** p.lvl AS BIGINT) AND p.n > 1
  LEFT JOIN {tree} s ON s.grp IS NOT DISTINCT FROM l.grp AND s.lvl = p.lvl AND s.idx = xor(p.idx, 1)"""


MERKLE = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
docs AS (
  SELECT *, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS more FROM documents, crc),
leaves AS (
  SELECT doc_id, lang AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, {_leaf("n_chars")} AS h,
    {_leaf("more")} AS other
  FROM docs),
{_tree("tree", "leaves")},
subs AS (
  SELECT grp AS lang, 0 AS grp, row_number() OVER (ORDER BY grp IS NOT NULL, grp) - 1 AS idx, h FROM tree WHERE n = 1),
{_tree("top", "subs")},
low AS ({_siblings("tree", "leaves")}),
high AS ({_siblings("top", "subs")}),
paths AS (
  SELECT l.doc_id, l.h, l.other, s.h AS subroot,
    list_concat(coalesce((SELECT list(sib ORDER BY lvl) FROM low WHERE low.grp IS NOT DISTINCT FROM l.grp AND low.idx = l.idx), []),
                coalesce((SELECT list(sib ORDER BY lvl) FROM high WHERE high.idx = s.idx), [])) AS sibs
  FROM leaves l JOIN subs s ON s.lang IS NOT DISTINCT FROM l.grp),
ends AS (
  SELECT *, list_reduce([other] || sibs, lambda a, s: CASE WHEN s = '-' THEN sha256(a) WHEN s[1] = 'L' THEN sha256(s[2:] || a)
      ELSE sha256(a || s[2:]) END) AS folded_root
  FROM paths)
SELECT doc_id, ends.h AS leaf, subroot, top.h AS root,
  sha256(array_to_string(list_transform(list_filter(sibs, lambda s: s <> '-'), lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = top.h AS verified
FROM ends, top WHERE top.n = 1"""
