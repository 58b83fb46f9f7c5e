"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {_BLANKS}) <> '') AS l
  FROM documents),
grams AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
named AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM grams),
again AS (SELECT doc_id, i FROM named QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, lower(regexp_replace(trim(x, {_BLANKS}), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT doc_id, source, unnest(l) AS x FROM d)),
often AS (
  SELECT source, line FROM lines JOIN (SELECT source, count(*) AS total FROM documents GROUP BY source) USING (source)
  GROUP BY source, line, total HAVING count(DISTINCT doc_id) >= 10 AND count(DISTINCT doc_id) > total * 0.1),
removed AS (
  SELECT doc_id, count(*) AS n_lines, sum(len(string_split(line, ' '))) AS n_words
  FROM lines JOIN often USING (source, line) GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(l) AS n_lines, coalesce(r.n_lines, 0) AS n_removed_lines, coalesce(r.n_words, 0) AS n_removed_words
  FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN removed r ON r.doc_id = d.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_removed_words <= n_words * 0.5 AS kept,
  n_lines::BIGINT AS n_lines, n_removed_lines::BIGINT AS n_removed_lines, n_removed_words::BIGINT AS n_removed_words
FROM counted
"""

OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""

OP7 = f"""
WITH l AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
seen AS (
  SELECT source, line, count(*) AS n
  FROM (SELECT source, unnest(list_distinct(list_transform(lines, lambda x: trim(x, {_BLANKS})))) AS line FROM l)
  WHERE line <> '' GROUP BY source, line),
hosts AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (
  SELECT source, list(line) AS boilerplate FROM seen JOIN hosts USING (source)
  WHERE pages >= 10 AND n > pages * 0.1 GROUP BY source),
kept AS (
  SELECT doc_id, text, lines,
    list_filter(lines, lambda x: NOT list_contains(coalesce(boilerplate, []), trim(x, {_BLANKS})) OR trim(x, {_BLANKS}) = '') AS k
  FROM l LEFT JOIN bad USING (source))
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(k, chr(10)), '') END AS text,
  coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(k), 0)::BIGINT AS n_dropped
FROM kept
"""

OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
half AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)
"""

OP11 = (
    OP8.replace("i:i + 4]", "i:i + 3]").replace("len(w) - 3, 2", "len(w) - 2, 2").replace(">= 75 *", ">= 80 *")
    .replace("AS n_shingles, component_id", "AS n_shingles, component_id, doc_id = component_id AS kept")
)


def _crc_table() -> str:
    """The 256 remainders of the reflected CRC-32 polynomial, as a list."""
    out = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(str(x))
    return "[" + ", ".join(out) + "]"


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; the CTE ``crc`` holds the table."""
    octets = f"list_transform(range(0, strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {step}), 4294967295::BIGINT)"


OP12 = rf"""
WITH RECURSIVE crc AS (SELECT {_crc_table()}::BIGINT[] AS t),
run AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  GROUP BY 1, 2),
named AS (SELECT doc_id || ':' || run AS s, run, n FROM run),
hashed AS (SELECT run, n, {crc32_sql('s')} AS h FROM named, crc),
word AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM hashed),
v AS (SELECT word, sum(n)::BIGINT AS n FROM word WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)),
near AS (
  SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM cut x JOIN v y ON x.a || x.b = y.word
  UNION SELECT y.word, y.n, x.word, x.n FROM cut x JOIN v y ON x.a || x.b = y.word),
best AS (
  SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
told AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
    CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word),
walk AS (
  SELECT word, word AS root FROM told
  UNION ALL SELECT walk.word, told.form FROM walk JOIN told ON told.word = walk.root WHERE told.form IS NOT NULL)
SELECT t.word, t.n, t.n_near, t.form, t.form_n, w.root
FROM told t JOIN walk w ON w.word = t.word JOIN told e ON e.word = w.root AND e.form IS NULL
"""

_FIELDS = ("doc_id::VARCHAR", "source", "lang", "{n_chars}::VARCHAR", "text")


def _row_sha(n_chars: str) -> str:
    said = [f.format(n_chars=n_chars) for f in _FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in said) + ")"


def _levels(rows: str, group: str, name: str, levels: int) -> list[str]:
    """CTEs ``{name}0`` to ``{name}{levels}``: the nodes ``{group}, p, h, m`` (m: of that level) of the trees over ``rows``."""
    out = [f"{name}0 AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY {group}) AS m FROM ({rows}))"]
    for k in range(levels):
        out.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY {group}) AS m FROM (SELECT {group}, p // 2 AS p,"
            f" CASE WHEN any_value(m) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h"
            f" FROM {name}{k} GROUP BY {group}, p // 2))"
        )
    return out


def merkle_sql(levels: int = 20, root_levels: int = 6) -> str:
    """SQL of the manifest, for trees of up to ``levels`` levels."""
    fold = []
    for tree, height, at, group in (("t", levels, "p", "g"), ("r", root_levels, "g", "z")):
        for k in range(height):
            place, step = f"(f.{at} // {1 << k})", len(fold)
            # a tree of one node is done; a node without a sibling is hashed alone
            fold.append(
                f"f{step + 1} AS (SELECT f.* REPLACE (f.proof || coalesce(s.h, '') AS proof,"
                f" CASE WHEN own.m = 1 THEN f.now WHEN s.h IS NULL THEN sha256(f.now)"
                f" WHEN {place} % 2 = 0 THEN sha256(f.now || s.h) ELSE sha256(s.h || f.now) END AS now)"
                f" FROM f{step} f JOIN {tree}{k} own ON own.{group} = f.{group} AND own.p = {place}"
                f" LEFT JOIN {tree}{k} s ON s.{group} = f.{group} AND s.p = xor({place}, 1))"
            )
    trees = [
        *_levels("SELECT g, p, leaf AS h FROM o", "g", "t", levels),
        *_levels(f"SELECT 0 AS z, g AS p, h FROM t{levels}", "z", "r", root_levels),
        "f0 AS (SELECT doc_id, z, g, p, leaf, now, '' AS proof FROM o)",
        *fold,
    ]
    return f"""
WITH crc AS (SELECT {_crc_table()}::BIGINT[] AS t),
d AS (SELECT *, doc_id::VARCHAR AS s FROM documents),
e AS (SELECT *, CASE WHEN {crc32_sql('s')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS n_now FROM d, crc),
l AS (
  SELECT doc_id, 0 AS z, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {_row_sha('n_chars')} AS leaf, {_row_sha('n_now')} AS now FROM e),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS p FROM l),
""" + ",\n".join(trees) + f"""
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = top.h AS verified
FROM f{len(fold)} f JOIN t{levels} sub ON sub.g = f.g JOIN r{root_levels} top ON top.z = f.z
"""


OP13 = merkle_sql()

LLM_ORACLE: dict[str, str] = {
    "op2_quality_rules": OP2,
    "op5_exact_top_k": OP5,
    "op7_line_dedup": OP7,
    "op8_ngram_jaccard": OP8,
    "op11_minhash_dedup": OP11,
    "op12_spelling_variants": OP12,
    "op13_merkle_manifest": OP13,
}
