"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_REACH = """
reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
"""

OP1 = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), usable AS (
  SELECT * FROM vectors WHERE label IS NOT NULL AND e IS NOT NULL
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93
), {_REACH}
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links,
  least(vec_id, coalesce(c, vec_id)) AS component_id, least(vec_id, coalesce(c, vec_id)) = vec_id AS kept
FROM vectors LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = vec_id
"""

_HASH = "CAST('0x' || substr(md5({}), 1, 13) AS BIGINT)"
_KEY = "coalesce(CAST(doc_id AS VARCHAR), 'null')"
_BID = "-1.0 / ln((" + _HASH.format("k || ':' || CAST(s AS VARCHAR)") + " + 0.5) / 4503599627370496.0)"

_CODES = """codes AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""
#: CRC-32 of a blob, with the table t of the CTE above.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(regexp_extract_all(hex({}), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""

OP3 = f"""
WITH {_CODES}, docs AS (
  SELECT doc_id, {_KEY} AS k, encode(coalesce(text, '')) AS body FROM documents
), sized AS (
  SELECT doc_id, k, octet_length(body) + 1 AS size,
    {_CRC.format("body")} AS text_crc32,
    list_transform(range(8), lambda s: {_BID}) AS bids,
    list_transform([8], lambda s: {_BID})[1] AS further,
    {_HASH.format("k || ':slot'")} % 1024 AS part
  FROM docs, codes
), placed AS (
  SELECT *, CAST(list_position(bids, list_max(bids)) - 1 AS INTEGER) AS shard FROM sized
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY part, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  CASE WHEN further > list_max(bids) THEN 8 ELSE shard END AS grown_shard
FROM placed
"""


def _level(depth: int) -> str:
    """CTE of one level of the tree: budgets of its nodes from those of their parents."""
    names = ["domain", "lang", "source"][:depth]
    node, parent = ", ".join(names), ", ".join(names[:-1])
    part = f"PARTITION BY {parent}" if parent else ""
    path = " || '/' || ".join(names)
    above = f"JOIN level{depth - 1} USING ({parent})" if parent else "CROSS JOIN (SELECT CAST(floor(sum(tokens) * 0.75) AS BIGINT) AS budget FROM leaves)"
    fill = f"ORDER BY room / weight, {names[-1]}"
    return f"""
nodes{depth} AS (
  SELECT {node}, CAST(sum(tokens * 2) AS BIGINT) AS room, max(budget) AS whole,
    CASE {path} WHEN 'd0' THEN 2.0 WHEN 'd0/en' THEN 2.0 WHEN 'd1/en' THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM leaves {above} GROUP BY {node}
), filled{depth} AS (
  SELECT *, (whole - coalesce(sum(room) OVER ({part} {fill} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
    >= room * sum(weight) OVER ({part} {fill} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS full_up
  FROM nodes{depth}
), level{depth} AS (
  SELECT {node}, CAST(CASE WHEN full_up THEN room ELSE
    floor((whole - sum(CASE WHEN full_up THEN room ELSE 0 END) OVER ({part})) * weight
      / sum(CASE WHEN full_up THEN 0.0 ELSE weight END::DOUBLE) OVER ({part})) END AS BIGINT) AS budget
  FROM filled{depth}
)"""


OP5 = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
    CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'other'
      ELSE 'd' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) // 10 AS VARCHAR) END AS domain,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM docs GROUP BY ALL
), {_level(1)}, {_level(2)}, {_level(3)},
planned AS (
  SELECT domain, lang, source, budget, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
    budget - CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END * tokens AS rest
  FROM level3 JOIN leaves USING (domain, lang, source)
), ranked AS (
  SELECT *, {_HASH.format("'7:' || CAST(epochs AS VARCHAR) || ':' || " + _KEY)} AS rank FROM docs JOIN planned USING (domain, lang, source)
), placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY rank, doc_id, tokens ROWS UNBOUNDED PRECEDING) - tokens AS before FROM ranked
)
SELECT doc_id, domain, lang, source, tokens, budget AS leaf_budget,
  CAST(epochs + CASE WHEN 2 * before + tokens <= 2 * rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM placed
"""

OP8 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) ELSE
    list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
), sized AS (
  SELECT doc_id, s, len(s) AS n FROM sets
), grams AS (
  SELECT doc_id, n, unnest(s) AS g FROM sized
), half AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), link AS (
  SELECT a, b FROM half UNION ALL SELECT b, a FROM half
), {_REACH}
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id
FROM sized LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = doc_id
"""

def _estimate(name: str, rows: str, by: str, factor: str) -> str:
    """CTEs that turn rows (cell, x0 to x4) into mean and factors of the covariance, as {name}."""
    floors = (0.1, 0.03, 0.3, 0.35, 0.35)
    pairs = [(i, j) for i in range(5) for j in range(i + 1)]
    sums = [f"CAST(sum(x{i}) AS DOUBLE) AS t{i}" for i in range(5)] + [f"CAST(sum(x{i} * x{j}) AS DOUBLE) AS t{i}{j}" for i, j in pairs]
    cov = [
        f"(t{i}{j} - m{i} * t{j}) / greatest(n - 1, 1)::DOUBLE * {factor}e0" + (f" + {(floors[i] * 1024) ** 2!r}::DOUBLE" if i == j else "") + f" AS c{i}{j}"
        for i, j in pairs
    ]
    steps, last = [], f"{name}_c"
    for j in range(5):
        d = f"c{j}{j}" + "".join(f" - l{j}{k} * l{j}{k} * d{k}" for k in range(j))
        steps.append(f"{name}_d{j} AS (SELECT *, greatest({d}, 1e0) AS d{j} FROM {last})")
        below = [f"(c{i}{j}" + "".join(f" - l{i}{k} * l{j}{k} * d{k}" for k in range(j)) + f") / d{j} AS l{i}{j}" for i in range(j + 1, 5)]
        last = f"{name}_d{j}"
        if below:
            steps.append(f"{name}_l{j} AS (SELECT *, {', '.join(below)} FROM {last})")
            last = f"{name}_l{j}"
    return f"""
{name}_t AS (SELECT {by}, count(*) AS n, {", ".join(sums)} FROM {rows} GROUP BY {by}),
{name}_m AS (SELECT *, {", ".join(f"t{i} / n AS m{i}" for i in range(5))} FROM {name}_t),
{name}_c AS (SELECT *, {", ".join(cov)} FROM {name}_m),
{", ".join(steps)},
{name} AS MATERIALIZED (SELECT * EXCLUDE (n), d0 * d1 * d2 * d3 * d4 AS det FROM {last})"""


def _distance(name: str, rows: str) -> str:
    """CTE {name}: rows joined with estimates, with the squared distance."""
    steps, last = [], rows
    for i in range(5):
        y = f"CAST(x{i} AS DOUBLE) - m{i}" + "".join(f" - l{i}{j} * y{j}" for j in range(i))
        steps.append(f"{name}_y{i} AS (SELECT *, {y} AS y{i} FROM {last})")
        last = f"{name}_y{i}"
    total = "0e0 + " + " + ".join(f"y{i} * y{i} / d{i}" for i in range(5))
    return ", ".join(steps) + f", {name} AS (SELECT *, {total} AS square FROM {last})"


def _core(name: str, classed: str) -> str:
    """The estimate from the classes up to the one in which three quarters of a cell are complete."""
    return f"""
{name}_upto AS (
  SELECT lk, sk, start, max(class) AS most FROM (
    SELECT *, sum(n) OVER (PARTITION BY lk, sk, start) AS whole,
      coalesce(sum(n) OVER (PARTITION BY lk, sk, start ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM (SELECT lk, sk, start, class, count(*) AS n FROM {classed} GROUP BY ALL)
  ) WHERE before < whole * 0.75 GROUP BY ALL
), {name}_rows AS (
  SELECT c.* FROM {classed} c JOIN {name}_upto u USING (lk, sk, start) WHERE class <= most
), {_estimate(name, f"{name}_rows", "lk, sk, start", "1.41")}"""


def _step(at: int) -> str:
    return f"""
joined{at} AS (SELECT * FROM vectors JOIN core{at - 1} USING (lk, sk)),
{_distance(f"far{at}", f"joined{at}")},
classed{at} AS (SELECT lk, sk, x0, x1, x2, x3, x4, start, least(floor(sqrt(square) * 32), 2047) AS class FROM far{at}),
{_core(f"core{at}", f"classed{at}")}"""


_Z = [f"abs(x{i} - m{i}) / s{i}" for i in range(5)]
_MIDDLE = "list_sort(list({0}))[(count(*) + 1) // 2]"

OP11 = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '-') AS lk, coalesce('=' || source, '-') AS own, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT id, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT id, w, unnest(range(1, len(w) - 6)) AS i FROM docs)
), twice AS (
  SELECT id, i FROM windows QUALIFY count(*) OVER (PARTITION BY id, s) > 1
), covered AS (
  SELECT id, CAST(sum(least(8, coalesce(further - i, 8))) AS BIGINT) AS n FROM (SELECT id, i, lead(i) OVER (PARTITION BY id ORDER BY i) AS further FROM twice) GROUP BY id
), stats AS (
  SELECT id, doc_id, lk, own, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines FROM docs LEFT JOIN covered USING (id)
), based AS MATERIALIZED (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats
), sources AS (
  SELECT lk, own, n, CASE WHEN n >= 30 THEN own ELSE '*' END AS sk FROM (SELECT lk, own, count(*) AS n FROM based WHERE NOT base_failed GROUP BY ALL)
), cells AS (
  SELECT lk, own, sk FROM sources QUALIFY sum(n) OVER (PARTITION BY lk, sk) >= 30
), vectors AS MATERIALIZED (
  SELECT id, lk, sk, {", ".join(f"CAST(floor(ln({v}) * 1024 + 0.5e0) AS BIGINT) AS x{i}" for i, v in enumerate((
    "n_words", "word_chars / n_words", "1 + 100 * n_symbols / n_words", "1 + 10 * n_dup_lines / n_lines", "1 + 10 * n_repeat_words / n_words")))}
  FROM based JOIN cells USING (lk, own) WHERE NOT base_failed
), middle AS (
  SELECT lk, sk, {", ".join(f"{_MIDDLE.format(f'x{i}')} AS m{i}" for i in range(5))} FROM vectors GROUP BY lk, sk
), centres AS (
  SELECT lk, sk, {", ".join(f"any_value(m{i}) AS m{i}" for i in range(5))},
    {", ".join(f"greatest({_MIDDLE.format(f'abs(x{i} - m{i})')} * 1.4826e0, {f * 1024!r}::DOUBLE) AS s{i}" for i, f in enumerate((0.1, 0.03, 0.3, 0.35, 0.35)))}
  FROM vectors JOIN middle USING (lk, sk) GROUP BY lk, sk
), norms AS (
  SELECT v.*, sqrt({" + ".join(f"{z} * ({z})" for z in _Z)}) AS n0, greatest({", ".join(_Z)}) AS n1, {" + ".join(_Z)} AS n2
  FROM vectors v JOIN centres USING (lk, sk)
), classed0 AS (
  SELECT lk, sk, x0, x1, x2, x3, x4, start, least(floor([n0, n1, n2][start + 1] * 32), 2047) AS class FROM norms CROSS JOIN (SELECT unnest([0, 1, 2]) AS start)
), {_core("core0", "classed0")}, {",".join(_step(at) for at in range(1, 5))}, best AS (
  SELECT * EXCLUDE (start) FROM core4 QUALIFY row_number() OVER (PARTITION BY lk, sk ORDER BY det, start) = 1
), best_joined AS (SELECT * FROM vectors JOIN best USING (lk, sk)), {_distance("nearness", "best_joined")}, near AS (
  SELECT lk, sk, x0, x1, x2, x3, x4 FROM nearness WHERE square <= 12.83e0
), {_estimate("final", "near", "lk, sk", "1.0")}, final_joined AS (
  SELECT * FROM vectors JOIN final USING (lk, sk)
), {_distance("judged", "final_joined")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(square <= 50, true) AS kept
FROM based LEFT JOIN (SELECT id, square FROM judged) USING (id)
"""


def _tree_level(name: str, at: int) -> str:
    """CTEs of one more level: runs of three, their parents, and the paths up to there."""
    return f"""
{name}_run{at} AS MATERIALIZED (
  SELECT g, p // 3 AS p, list(d ORDER BY p) AS ds, max(c) AS c FROM {name}_node{at} GROUP BY g, p // 3
), {name}_node{at + 1} AS MATERIALIZED (
  SELECT g, p, CASE WHEN c > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, count(*) OVER (PARTITION BY g) AS c FROM {name}_run{at}
), {name}_path{at + 1} AS MATERIALIZED (
  SELECT id, g, x.p // 3 AS p, proof || array_to_string(list_concat(ds[1:x.p % 3], ds[x.p % 3 + 2:]), '') AS proof,
    CASE WHEN c > 1 THEN sha256(array_to_string(ds[1:x.p % 3], '') || fold || array_to_string(ds[x.p % 3 + 2:], '')) ELSE fold END AS fold
  FROM {name}_path{at} x JOIN {name}_run{at} y USING (g) WHERE x.p // 3 = y.p
)"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


#: Levels that the SQL climbs: up to 3^11 rows of a source and 3^5 sources.
_LEVELS, _TOP = 11, 5

OP12 = f"""
WITH {_CODES}, docs AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g,
    sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC.format("encode(CAST(doc_id AS VARCHAR))")} % 2 = 0
      THEN sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")))}) END AS other
  FROM documents, codes
), leaf_node0 AS MATERIALIZED (
  SELECT id, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, other NULLS FIRST) - 1 AS p, leaf AS d, other, count(*) OVER (PARTITION BY g) AS c FROM docs
), leaf_path0 AS MATERIALIZED (
  SELECT id, g, p, '' AS proof, coalesce(other, d) AS fold FROM leaf_node0
), {",".join(_tree_level("leaf", at) for at in range(_LEVELS))}, source AS MATERIALIZED (
  SELECT g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS p FROM leaf_node{_LEVELS}
), top_node0 AS MATERIALIZED (
  SELECT '' AS g, p, subroot AS d, count(*) OVER () AS c FROM source
), top_path0 AS MATERIALIZED (
  SELECT id, '' AS g, source.p, proof, fold FROM leaf_path{_LEVELS} JOIN source USING (g)
), {",".join(_tree_level("top", at) for at in range(_TOP))}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = d AS verified
FROM docs JOIN source USING (g) JOIN top_path{_TOP} USING (id) CROSS JOIN (SELECT d FROM top_node{_TOP})
"""

OP13 = rf"""
WITH RECURSIVE {_CODES}, runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), hashed AS (
  SELECT run, {_CRC.format("encode(k || ':' || run)")} AS h FROM (SELECT * FROM runs WHERE len(run) >= 7), codes
), words AS MATERIALIZED (
  SELECT CASE WHEN h % 31 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, count(*) AS n FROM hashed GROUP BY 1
  HAVING count(*) >= 2 AND len(word) >= 7
), without AS MATERIALIZED (
  SELECT word, n, len(word) AS size, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT *, unnest(range(1, len(word) + 1)) AS i FROM words)
), half AS (
  SELECT x.word AS a, y.word AS b FROM without x JOIN without y ON x.rest = y.rest AND x.i = y.i AND x.size = y.size AND x.word < y.word
  UNION SELECT x.word, y.word FROM without x JOIN words y ON x.rest = y.word
), near AS (
  SELECT a AS word, b AS other FROM half UNION ALL SELECT b, a FROM half
), best AS (
  SELECT near.word, count(*) AS n_near, max(n) AS best_n, arg_min(other, (-n, other)) AS best FROM near JOIN words ON words.word = other GROUP BY near.word
), formed AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain(word, last) AS (
  SELECT word, word FROM formed UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = last WHERE form IS NOT NULL
)
SELECT word, form, last AS root, n, n_near, form_n
FROM formed JOIN (SELECT chain.word, last FROM chain JOIN formed f ON f.word = last WHERE f.form IS NULL) USING (word)
"""

ORACLE = {
    "op1_pq_dedup": OP1,
    "op3_rendezvous": OP3,
    "op5_mixing": OP5,
    "op8_ngram_join": OP8,
    "op11_outliers": OP11,
    "op12_manifest": OP12,
    "op13_spelling": OP13,
}
