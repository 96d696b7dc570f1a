"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force."""

from .rules import ALPHA, FIGURES, MIN_GROUP, SPREADS, ZERO

SPACE = r"\x20\x09-\x0D"
SQL: dict[str, str] = {}

# ---- revisits ----------------------------------------------------------------------------------------------

SQL["op3_revisits"] = r"""
WITH cut AS (
  SELECT page_id AS p, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u
  FROM pages),
parts AS (
  SELECT p, html,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^.*@', ''), ':(80|443)$', ''),
      '\.$', ''), '^www[0-9]*\.', '') AS host,
    regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/(index\.(html?|php))?$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\?(.*)$', 1), '&'),
      lambda q: q <> '' AND NOT regexp_matches(q, '(?i)^(utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(=|$)'))), '&') AS query
  FROM cut),
pages_ AS (
  SELECT p, html, md5(html) AS tag, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical,
    strftime(make_timestamp(p * 60 * 1000000), '%Y-%m-%dT%H:%M:%S') AS date FROM parts),
based AS (
  SELECT v.*, (SELECT max({'t': r.p, 'r': r.p * 2}).r FROM pages_ r WHERE r.canonical = v.canonical AND r.p < v.p + 1000) // 2 AS base
  FROM pages_ v),
judged AS (
  SELECT v.p, v.canonical, v.date, r.p AS base, r.tag AS base_tag, r.date AS base_date, r.html AS base_html,
    CASE WHEN v.p % 3 = 0 THEN v.tag = r.tag WHEN v.p % 3 = 1 THEN v.date = r.date END AS agree
  FROM based v JOIN pages_ r ON r.p = v.base)
SELECT p * 2 AS record_id, 'response' AS kind, canonical, 'response' AS status, p * 2 AS source_id, '"' || tag || '"' AS etag,
  date AS last_modified, CAST(strlen(html) AS VARCHAR) AS content_length, 'miss' AS x_cache, tag AS payload_md5
FROM pages_
UNION ALL
SELECT p * 2 + 1, 'revisit', canonical, CASE WHEN agree THEN 'resolved' WHEN NOT agree THEN 'mismatch' ELSE 'unverified' END,
  CASE WHEN coalesce(agree, true) THEN base * 2 END,
  CASE WHEN coalesce(agree, true) THEN '"' || base_tag || '"' WHEN p % 3 = 0 THEN 'W/"' || (SELECT tag FROM pages_ q WHERE q.p = judged.p) || '"' END,
  CASE WHEN p % 3 = 1 THEN date WHEN coalesce(agree, true) THEN base_date END,
  CASE WHEN coalesce(agree, true) THEN CAST(strlen(base_html) AS VARCHAR) ELSE '0' END, 'hit',
  CASE WHEN coalesce(agree, true) THEN base_tag END
FROM judged"""

# ---- quality rules -----------------------------------------------------------------------------------------

_GAMMA = f"((1 + {ALPHA}::DOUBLE) / (1 - {ALPHA}::DOUBLE))"


def _fences(name: str, by: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""
{name}_q AS (
  SELECT {keys}figure, max(total) AS docs, min(CASE WHEN upto >= 0.5 * total THEN bucket END) AS b50,
         min(CASE WHEN upto >= 0.75 * total THEN bucket END) AS b75
  FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}figure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys}figure) AS total
        FROM (SELECT {keys}figure, bucket, count(*) AS n FROM buckets GROUP BY ALL)) GROUP BY ALL),
{name} AS (
  SELECT {keys}max(docs) AS docs, {", ".join(f"max(CASE WHEN figure = '{f}' THEN low + {SPREADS} * (high - low) + {s}::DOUBLE END) AS {f}" for f, s in FIGURES.items())}
  FROM (SELECT *, CASE WHEN b50 = -1000000 THEN 0 ELSE 2 * pow({_GAMMA}, b50) / ({_GAMMA} + 1) END AS low,
               CASE WHEN b75 = -1000000 THEN 0 ELSE 2 * pow({_GAMMA}, b75) / ({_GAMMA} + 1) END AS high FROM {name}_q) {"GROUP BY " + by if by else ""})"""


_limit = lambda f: f"CASE WHEN o.docs >= {MIN_GROUP} THEN o.{f} WHEN l.docs >= {MIN_GROUP} THEN l.{f} ELSE e.{f} END"
SQL["op4_rules"] = rf"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS lines FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i + 4]) AS times
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
covered AS (
  SELECT doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS w FROM windows WHERE times > 1) GROUP BY 1),
base AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered c USING (doc_id)),
figures AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_symbols::DOUBLE / greatest(word_chars, 1) AS symbol_share,
         n_repeat_words::DOUBLE / greatest(n_words, 1) AS repeat_share, n_dup_lines::DOUBLE / greatest(n_lines, 1) AS repeated_line_share,
         word_chars::DOUBLE / greatest(n_words, 1) AS mean_word FROM base),
buckets AS (
  SELECT lang, source, figure, CASE WHEN value <= {ZERO} THEN -1000000 ELSE CAST(ceil(ln(value) / ln({_GAMMA})) AS INTEGER) END AS bucket
  FROM (UNPIVOT (SELECT lang, source, {", ".join(FIGURES)} FROM figures) ON {", ".join(FIGURES)} INTO NAME figure VALUE value)),
{_fences("own", "lang, source")}, {_fences("spoken", "lang")}, {_fences("overall", "")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"f.{x} <= {_limit(x)}" for x in FIGURES)} AS kept
FROM figures f JOIN own o ON f.lang IS NOT DISTINCT FROM o.lang AND f.source IS NOT DISTINCT FROM o.source
JOIN spoken l ON f.lang IS NOT DISTINCT FROM l.lang, overall e"""


# ---- Merkle manifest ---------------------------------------------------------------------------------------

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = lambda x: f"translate({x}, '{_UPPER}', '{_UPPER.lower()}')"
_FIELD = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
_LEAF = lambda text: "sha256(" + " || ".join(map(_FIELD, ("doc_id", "source", "lang", "n_chars", text))) + ")"
#: CRC-32 of a decimal number: the usual reflected division, byte by byte, bit by bit.
_CRC = lambda x: (
    f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
    "lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: 0::BIGINT)), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))))"
)
#: Levels that the SQL has of each tree: up to 16^6 rows a source and as many sources.
_DEPTH = 6


def _tree(name: str, leaves: str) -> str:
    """Levels of trees over ``leaves`` (tree, pos, total, hash, path node): ``name_k`` and their roots ``name_top``."""
    out = [f"{name}_0 AS ({leaves})"]
    for k in range(1, _DEPTH + 1):
        out.append(f"""{name}_{k} AS (
  SELECT tree, pos // 16 AS pos, max((total + 15) // 16) AS total, sha256(string_agg(hash, '' ORDER BY pos)) AS hash
  FROM {name}_{k - 1} WHERE total > 1 GROUP BY tree, pos // 16)""")
    tops = " UNION ALL ".join(f"SELECT tree, hash, {k} AS level FROM {name}_{k} WHERE total = 1" for k in range(_DEPTH + 1))
    return ",\n".join([*out, f"{name}_top AS ({tops})"])


def _climb(name: str, first: str) -> str:
    """``name_fold_k``: rows of ``first`` (key, tree, spot, folded, proof) after k levels of the tree, own place replaced by ``folded``."""
    out = [f"{name}_fold_0 AS ({first})"]
    for k in range(_DEPTH):
        out.append(f"""{name}_fold_{k + 1} AS (
  SELECT key, any_value(tree) AS tree, any_value(spot) // 16 AS spot,
         CASE WHEN count(pos) = 0 THEN any_value(folded) ELSE sha256(string_agg(CASE WHEN pos = spot THEN folded ELSE hash END, '' ORDER BY pos)) END AS folded,
         any_value(proof) || coalesce(string_agg(CASE WHEN pos <> spot THEN hash END, '' ORDER BY pos), '') AS proof
  FROM (SELECT f.*, n.pos, n.hash FROM {name}_fold_{k} f
        LEFT JOIN {name}_{k} n ON n.tree = f.tree AND n.total > 1 AND n.pos // 16 = f.spot // 16) GROUP BY key)""")
    return ",\n".join(out)


SQL["op11_merkle"] = f"""
WITH leaf_rows AS (
  SELECT *, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS tree, {_LEAF("text")} AS leaf,
         CASE WHEN ({_CRC("doc_id")}) % 5 = 0 THEN {_LEAF(_LOWERED("text"))} END AS altered FROM documents),
placed AS (
  SELECT doc_id, tree, leaf, altered, row_number() OVER () AS key,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS total
  FROM leaf_rows),
{_tree("r", "SELECT tree, pos, total, leaf AS hash FROM placed")},
{_tree("s", "SELECT 0 AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS total, hash, tree AS name FROM r_top")},
{_climb("r", "SELECT key, tree, pos AS spot, coalesce(altered, leaf) AS folded, '' AS proof FROM placed")},
{_climb("s", f"SELECT key, 0 AS tree, s_0.pos AS spot, folded, proof FROM r_fold_{_DEPTH} f JOIN s_0 ON s_0.name = f.tree")}
SELECT p.doc_id, p.leaf, t.hash AS subroot, s_top.hash AS root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root,
       f.folded = s_top.hash AS verified
FROM placed p JOIN r_top t ON t.tree = p.tree JOIN s_fold_{_DEPTH} f ON f.key = p.key, s_top"""

# ---- hard negatives ----------------------------------------------------------------------------------------

SQL["op12_hard_negatives"] = """
WITH ints AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM ints a JOIN ints r ON a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scores WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND n.label <> n.anchor_label
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10"""

# ---- exact duplicates --------------------------------------------------------------------------------------

SQL["op13_exact_dedup"] = f"""
WITH lowered AS (SELECT doc_id, coalesce({_LOWERED("text")}, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM lowered"""
