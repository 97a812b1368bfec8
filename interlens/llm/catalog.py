"""Registered queries of the training-data operators and their SQL.

Each query applies its operator with production parameters to a whole table and
keeps the contract's columns; the operators return more (texts, spans, scores).
"""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import load

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


def _op(module: str):
    return import_module(f"{__package__}.{module}")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20),
f AS (SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(w[p:p + 19], ' ') ORDER BY doc_id, p) AS rn FROM p),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM f WHERE rn > 1),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM d),
k AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY q) AS kept
      FROM x ANTI JOIN g USING (doc_id, q) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@_query("op10_substring_dedup", OP10_SQL)
def op10(spark, sf_dir) -> DataFrame:
    return _op("substring_dedup").substring_dedup(load(spark, sf_dir, "documents")).drop("kept_text")


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS g FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * i >= 90 * (nx.n + ny.n - i)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.node = e.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(node) AS component_id,
       (SELECT count(*) FROM e WHERE e.a = r.doc_id) AS n_links
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@_query("op9_jaccard_join", OP9_SQL)
def op9(spark, sf_dir) -> DataFrame:
    return _op("jaccard_join").jaccard_join(load(spark, sf_dir, "documents"), shingle=3, percent=90)


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 4], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS p FROM b WHERE len(w) >= 5)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS n_common FROM ds JOIN bs USING (g) GROUP BY doc_id, item_id),
short AS (SELECT item_id, len(w) AS k, array_to_string(w, ' ') AS g FROM b WHERE len(w) BETWEEN 1 AND 4),
runs AS (SELECT DISTINCT doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS g
         FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM short) WHERE len(w) >= k))
SELECT doc_id, item_id, n_shingles, n_common, n_common / n_shingles AS containment
FROM c JOIN n USING (item_id) WHERE 100 * n_common >= 80 * n_shingles
UNION ALL SELECT doc_id, item_id, 1, 1, 1.0 FROM runs JOIN short USING (k, g)
"""


@_query("op1_decontaminate", OP1_SQL)
def op1(spark, sf_dir) -> DataFrame:
    return _op("decontaminate").find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def byte_bpe() -> dict:
    """Where the public byte-level tokeniser lies on this machine."""
    import public_tokenizers as p
    return {"tokenizer": p.path("byte_bpe_50k.json"), "ranks": p.path("byte_bpe_50k.tiktoken"), "pattern": p.PATTERN}


@_query("op2_pack")
def op2(spark, sf_dir) -> DataFrame:
    return _op("packing").pack(load(spark, sf_dir, "documents"), **byte_bpe())


def op3_sql() -> str:
    from . import quality_rules as q
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(q.STOP_WORDS))
    def bad(rules):
        parts = []
        for r in rules:
            value = r.value if r.per is None else f"({r.value}) * 1.0 / nullif({r.per}, 0)"
            if r.low is not None:
                parts.append(f"coalesce({value} < {r.low}, false)")
            if r.high is not None:
                parts.append(f"coalesce({value} > {r.high}, false)")
        return " OR ".join(parts)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)),
r AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS q FROM r WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines,
             count(*) FILTER (rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…') AS n_ellipsis_lines,
             count(*) FILTER (ltrim(x, ' ')[1] IN ('-', '*', '•')) AS n_bullet_lines
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
             CAST(len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines, coalesce(n_bullet_lines, 0) AS n_bullet_lines,
             coalesce(c.n, 0) AS n_repeat_words
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {bad(q.BASE)} AS base_failed, NOT ({bad((*q.BASE, *q.RULES))}) AS kept
FROM m
"""


@_query("op3_quality_rules", op3_sql())
def op3(spark, sf_dir) -> DataFrame:
    return _op("quality_rules").quality_rules(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query("op4_licences")
def op4(spark, sf_dir) -> DataFrame:
    return _op("licences").scan(load(spark, sf_dir, "documents"), windows=True)


@_query("op5_warc")
def op5(spark, sf_dir) -> DataFrame:
    from .common import scratch_path
    w, path = _op("warc"), scratch_path(spark, "warc")
    w.write_archive(load(spark, sf_dir, "pages"), path)
    return w.parse_records(w.read_records(spark, path))


ORACLE["op5_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS original FROM pages)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       translate({" || ".join(f"to_base(CAST('0x' || substr(x, {1 + 5 * i}, 5) AS BIGINT), 32, 4)" for i in range(8))},
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM p
"""


@_query("op6_quality_model")
def op6(spark, sf_dir) -> DataFrame:
    return _op("quality_model").classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@_query("op7_toxicity")
def op7(spark, sf_dir) -> DataFrame:
    return _op("toxicity").score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


@_query("op8_personal")
def op8(spark, sf_dir) -> DataFrame:
    return _op("personal").find(load(spark, sf_dir, "documents"))


def _level_sql(below: str, name: str, group: str) -> str:
    """One level of a Merkle forest over (group, idx, h, n = nodes of the tree)."""
    return (f"{name} AS MATERIALIZED (SELECT {group}, idx // 2 AS idx, CASE WHEN any_value(n) = 1 THEN min(h) "
            f"ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h, (any_value(n) + 1) // 2 AS n "
            f"FROM {below} GROUP BY {group}, idx // 2)")


def op12_sql(levels: int = 24) -> str:
    def field(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(n_chars):
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"

    doc = [_level_sql(f"a{i}", f"a{i + 1}", "lang") for i in range(levels)]
    top = [_level_sql(f"b{i}", f"b{i + 1}", "one") for i in range(levels)]
    near = " UNION ALL ".join(f"SELECT {i} AS l, lang, idx, h, n FROM a{i} WHERE n > 1" for i in range(levels))
    far = " UNION ALL ".join(f"SELECT {i} AS l, idx, h, n FROM b{i} WHERE n > 1" for i in range(levels))
    step = "CASE WHEN s.h IS NULL THEN 'A' WHEN m.idx % 2 = 1 THEN 'L' || s.h ELSE 'R' || s.h END"
    fold = ("list_reduce(list_prepend({start}, coalesce({steps}, [])), lambda a, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || a) "
            "WHEN 'R' THEN sha256(a || s[2:]) ELSE sha256(a) END)")
    return f"""
WITH RECURSIVE bit AS (SELECT i AS b, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS tab FROM bit WHERE k = 8),
crc AS (SELECT doc_id, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
          list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
          lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)]))) AS crc
        FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), tab),
d AS MATERIALIZED (SELECT doc_id, lang, row_number() OVER () AS k, {leaf('n_chars')} AS leaf,
             CASE WHEN crc % 7 = 0 THEN {leaf('(n_chars + 1)')} ELSE {leaf('n_chars')} END AS found
      FROM documents LEFT JOIN crc USING (doc_id)),
a0 AS MATERIALIZED (SELECT k, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, leaf AS h,
              count(*) OVER (PARTITION BY lang) AS n FROM d),
{", ".join(doc)},
b0 AS MATERIALIZED (SELECT 1 AS one, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, h, count(*) OVER () AS n FROM a{levels}),
{", ".join(top)},
near AS ({near}), far AS ({far}),
ns AS (SELECT k, list({step} ORDER BY m.l) AS steps FROM (SELECT a0.k, a0.lang, m.l, m.idx FROM a0
         JOIN near m ON m.lang IS NOT DISTINCT FROM a0.lang AND m.idx = a0.idx >> m.l) m
       LEFT JOIN near s ON s.l = m.l AND s.lang IS NOT DISTINCT FROM m.lang AND s.idx = xor(m.idx, 1) GROUP BY k),
fs AS (SELECT m.lang, list({step} ORDER BY m.l) AS steps FROM (SELECT b0.lang, m.l, m.idx FROM b0
         JOIN far m ON m.idx = b0.idx >> m.l) m LEFT JOIN far s ON s.l = m.l AND s.idx = xor(m.idx, 1) GROUP BY m.lang),
w AS (SELECT d.doc_id, d.leaf, d.found, b0.h AS subroot, (SELECT h FROM b{levels}) AS root,
             list_concat(coalesce(ns.steps, []), coalesce(fs.steps, [])) AS steps
      FROM d JOIN b0 ON b0.lang IS NOT DISTINCT FROM d.lang LEFT JOIN ns USING (k)
           LEFT JOIN fs ON fs.lang IS NOT DISTINCT FROM d.lang)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
       {fold.format(start='found', steps='steps')} AS folded_root,
       {fold.format(start='found', steps='steps')} = root AS verified
FROM w
"""


@_query("op12_merkle", op12_sql())
def op12(spark, sf_dir) -> DataFrame:
    return _op("merkle").audit(load(spark, sf_dir, "documents"))


@_query("op13_simhash")
def op13(spark, sf_dir) -> DataFrame:
    return _op("simhash").near_duplicates(load(spark, sf_dir, "documents"))


def op11_sql(rounds: int = 4) -> str:
    """The same search by all distances, one chain of steps a round."""
    def near(t):
        return (f"n{t} AS MATERIALIZED (SELECT k, part, min({{'d': d, 'entry': entry}}) AS m FROM (SELECT k, part, entry, "
                f"CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d "
                f"FROM p JOIN c{t} USING (part)) GROUP BY k, part)")

    def book(t):
        return (f"s{t} AS (SELECT part, m.entry AS entry, q, sum(x[q]) AS s, count(*) AS n FROM n{t} JOIN p USING (k, part), "
                f"(SELECT unnest(range(1, w + 1)) AS q FROM size) GROUP BY part, m.entry, q), "
                f"c{t + 1} AS MATERIALIZED (SELECT part, entry, coalesce(g, c) AS c FROM c{t} LEFT JOIN (SELECT part, entry, "
                f"list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY q) AS g FROM s{t} GROUP BY part, entry) USING (part, entry))")

    steps = ", ".join(f"{near(t)}, {book(t)}" for t in range(rounds))
    return f"""
WITH e AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS k,
         list_transform(embedding, lambda x: CAST(floor(1024.0 * x) AS BIGINT)) AS v FROM embeddings
       WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT any_value(len(v)) // 4 AS w FROM e),
p AS MATERIALIZED (SELECT k, part, v[part * w + 1:(part + 1) * w] AS x FROM e, size, range(4) r(part)),
c0 AS MATERIALIZED (SELECT part, k - 1 AS entry, x AS c FROM p WHERE k <= 256),
{steps}, {near(rounds)},
f AS (SELECT k, string_agg(printf('%02x', m.entry), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error
      FROM n{rounds} GROUP BY k)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM e JOIN f USING (k)
"""


@_query("op11_vector_codes", op11_sql())
def op11(spark, sf_dir) -> DataFrame:
    return _op("vector_codes").compress(load(spark, sf_dir, "embeddings"))
