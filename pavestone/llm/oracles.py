"""DuckDB SQL of the operators on words, by plain joins and windows over all words: for tables of a few MB."""

from __future__ import annotations

from .quality import LINE_LIMIT, MIN_WORDS, NGRAM_LIMITS, REPEAT_LIMIT, REPEAT_WINDOW

SPACE = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: w: (doc_id, i, word, n) of all words, white space aside.
WORDS = f"""
l AS (SELECT doc_id, regexp_extract_all(text, '{SPACE}') AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word, len(ws) AS n FROM l)"""

OP7 = f"""
WITH {WORDS},
k AS (SELECT doc_id, i, array_to_string(list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING), ' ') AS key, i + 19 <= n AS whole FROM w),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1 AS later FROM k WHERE whole),
c AS (SELECT w.doc_id, w.i, w.word, coalesce(max(CASE WHEN later THEN 1 ELSE 0 END) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
  FROM w LEFT JOIN f ON f.doc_id = w.doc_id AND f.i = w.i),
g AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents d LEFT JOIN g USING (doc_id)
"""


def _ngrams(n: int) -> str:
    """The word characters and words of a text inside n-grams found twice or more in it."""
    return f"""
k{n} AS (SELECT doc_id, i, array_to_string(list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING), ' ') AS key, i + {n - 1} <= n AS whole FROM w),
r{n} AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, key) > 1 AS again FROM k{n} WHERE whole),
c{n} AS (SELECT w.doc_id, w.word, coalesce(max(CASE WHEN again THEN 1 ELSE 0 END) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 0) = 1 AS inside
  FROM w LEFT JOIN r{n} r ON r.doc_id = w.doc_id AND r.i = w.i),
g{n} AS (SELECT doc_id, count(*) FILTER (inside) AS words_{n}, coalesce(sum(length(word)) FILTER (inside), 0)::BIGINT AS dup_chars_{n} FROM c{n} GROUP BY doc_id)"""


OP10 = f"""
WITH {WORDS},{",".join(_ngrams(n) for n in NGRAM_LIMITS)},
base AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM w GROUP BY doc_id),
li AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
ld AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again FROM li WHERE regexp_matches(line, '{SPACE}')),
lg AS (SELECT doc_id, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) FILTER (again), 0)::BIGINT AS dup_line_chars FROM ld GROUP BY doc_id),
a AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
  coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(words_{REPEAT_WINDOW}, 0) AS n_repeat_words,
  coalesce(dup_line_chars, 0) AS dup_line_chars, {", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n in NGRAM_LIMITS)}
  FROM documents d LEFT JOIN base USING (doc_id) LEFT JOIN lg USING (doc_id) {" ".join(f"LEFT JOIN g{n} USING (doc_id)" for n in NGRAM_LIMITS)}),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_LIMIT} * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= {LINE_LIMIT} * word_chars {" ".join(f"AND 100 * dup_chars_{n} <= {most} * word_chars" for n, most in NGRAM_LIMITS.items())} AS kept FROM b
"""

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = f"""
WITH l AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ALNUM}') AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word, len(ws) AS n FROM l),
bl AS (SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ALNUM}') AS ws FROM benchmark),
bp AS (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM bl WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 9], ' ') AS key, least(len(ws), 10) AS size FROM bp),
s AS (SELECT DISTINCT size FROM bw),
k AS (SELECT doc_id, i, size, array_to_string((list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING))[1:size], ' ') AS key, n FROM w, s),
h AS (SELECT DISTINCT k.doc_id, k.i, k.size, item_id FROM k JOIN bw ON bw.key = k.key AND bw.size = k.size WHERE k.i + k.size - 1 <= n),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM h),
hit AS (SELECT doc_id, count(*) AS n_hit FROM p GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP3 = f"""
WITH RECURSIVE l AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{SPACE}') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM l WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS MATERIALIZED (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r(d, m) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.y, r.m FROM r JOIN e ON e.x = r.d),
k AS (SELECT d, min(m) AS m FROM r GROUP BY d)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.m, d.doc_id) AS component_id FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k ON k.d = d.doc_id
"""


def _crc_table() -> list[int]:
    out = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return out


def _crc32(s: str) -> str:
    """The unsigned CRC-32 of a string's UTF-8 bytes."""
    byte = f"CAST('0x' || substr(hex({s}), 2 * CAST(i AS BIGINT) + 1, 2) AS BIGINT)"
    return f"xor(list_reduce(list_transform(range(strlen({s})), lambda i: {byte}), lambda acc, b: xor((CAST({_crc_table()} AS BIGINT[]))[CAST(xor(acc, b) & 255 AS BIGINT) + 1], acc >> 8), 4294967295::BIGINT), 4294967295::BIGINT)"


#: Levels of the trees and above them: trees of up to 8**8 leaves, and up to 8**4 trees.
LOW, TOP = 8, 4
_FIELD = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _levels(name: str, n: int) -> str:
    """name0 (tree, idx, d, n) to name<n>, and the siblings of each node of a level."""
    up = lambda k: f"{name}{k + 1} AS (SELECT tree, idx // 8 AS idx, CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY idx)) END AS d, (n + 7) // 8 AS n FROM {name}{k} GROUP BY tree, idx // 8, n)"
    by = lambda k: f"""{name}s{k} AS (SELECT a.tree, a.idx, a.n, coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l, coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
      FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.idx // 8 = b.idx // 8 GROUP BY a.tree, a.idx, a.n)"""  # noqa: E731
    return ",\n".join(f"{up(k)},\n{by(k)}" for k in range(n))


def _folds() -> str:
    steps = [(f"a_s{k}", "o.tree = s.tree AND o.rank // {p} = s.idx".format(p=8**k)) for k in range(LOW)] + [(f"b_s{k}", f"s.idx = o.tree // {8**k}") for k in range(TOP)]
    out = ["o0 AS (SELECT doc_id, tree, rank, leaf, altered AS f, '' AS proof FROM leaves)"]
    for k, (table, on) in enumerate(steps):
        out.append(f"o{k + 1} AS (SELECT o.doc_id, o.tree, o.rank, o.leaf, CASE WHEN s.n > 1 THEN sha256(s.l || o.f || s.r) ELSE o.f END AS f, o.proof || s.l || s.r AS proof FROM o{k} o JOIN {table} s ON {on})")
    return ",\n".join(out)


OP12 = f"""
WITH leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n,
  sha256({" || ".join(_FIELD(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
  CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({" || ".join(_FIELD(c) for c in ("doc_id", "source", "lang", "n_chars", f"translate(text, '{UPPER}', '{LOWER}')"))})
    ELSE sha256({" || ".join(_FIELD(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) END AS altered FROM documents),
a_0 AS (SELECT tree, rank AS idx, leaf AS d, n FROM leaves),
{_levels("a_", LOW)},
b_0 AS (SELECT 0 AS tree, tree AS idx, d, count(*) OVER () AS n FROM a_{LOW}),
{_levels("b_", TOP)},
{_folds()}
SELECT o.doc_id, o.leaf, a.d AS subroot, b.d AS root, sha256(o.proof) AS proof_sha256, o.f AS folded_root, o.f = b.d AS verified
FROM o{LOW + TOP} o JOIN a_{LOW} a ON a.tree = o.tree CROSS JOIN b_{TOP} b
"""


def _features(table: str, key: str) -> str:
    """Per row of a table its words, and (key, g) for all runs of 1 to 3 words."""
    return f"""
{table}_l AS (SELECT {key}, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ALNUM}') AS ws FROM {table}),
{table}_w AS (SELECT {key}, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS a FROM {table}_l),
{table}_n AS (SELECT {key}, a, lead(a, 1) OVER x AS b, lead(a, 2) OVER x AS c FROM {table}_w WINDOW x AS (PARTITION BY {key} ORDER BY i)),
{table}_f AS MATERIALIZED (SELECT {key}, a AS g FROM {table}_n UNION ALL SELECT {key}, a || ' ' || b FROM {table}_n WHERE b IS NOT NULL UNION ALL SELECT {key}, a || ' ' || b || ' ' || c FROM {table}_n WHERE c IS NOT NULL)"""


OP13 = f"""
WITH {_features("documents", "doc_id")},{_features("benchmark", "item_id")},
g AS MATERIALIZED (SELECT g, {_crc32("g")} % 10000 AS bucket FROM (SELECT g FROM documents_f UNION SELECT g FROM benchmark_f)),
s AS (SELECT bucket, count(*) AS s FROM documents_f JOIN g USING (g) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM benchmark_f JOIN g USING (g) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM documents_f) AS s, (SELECT count(*) FROM benchmark_f) AS t),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (n.s + 10000) / ((coalesce(s.s, 0) + 1)::DOUBLE * (n.t + 10000)))) AS BIGINT) AS gain FROM s FULL JOIN t USING (bucket) CROSS JOIN n),
w AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM documents_f JOIN g USING (g) JOIN gain USING (bucket) GROUP BY doc_id),
h AS (SELECT doc_id, coalesce(len(ws), 0) AS n_words, CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) AS h FROM documents_l),
x AS (SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM h LEFT JOIN w USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS rank, count(*) FILTER (n_words >= 20) OVER () AS able FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND rank <= 5 * able // 100 THEN rank END AS rank FROM r
"""
