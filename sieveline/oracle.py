"""The same queries in DuckDB's SQL."""

from __future__ import annotations

from sieveline.plans.noise import DEFAULT_COUNTS, FOREIGN, JUNK, SUFFIXES

SEED = 42
_WORD = r"[\p{L}\p{N}_]+"
_SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_PUNCTUATION = r""".,!?;:'"()\[\]{}\-\x{2013}\x{2014}/%$&@#*+=<>~`|\\"""
_SCRIPTS = {"zh": r"\x{4e00}-\x{9fff}", "ja": r"\x{3040}-\x{30ff}", "ko": r"\x{ac00}-\x{d7af}", "ru": r"\x{0400}-\x{04ff}", "ar": r"\x{0600}-\x{06ff}", "en": "A-Za-z"}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _stripped(text: str) -> str:
    return f"regexp_replace(coalesce({text}, ''), '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"


def _words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{_WORD}')"


def _key(seed: int, row: str = "row_idx") -> str:
    return f"(((({row} % 2147483648) * 2654435761 + {seed}) % 4294967291 + 4294967291) % 4294967291)"


def _rate(part: str, whole: str) -> str:
    return f"(CASE WHEN ({whole}) = 0 THEN 0.0::DOUBLE ELSE ({part})::DOUBLE / ({whole}) END)"


def _prf(tp: str, fp: str, fn: str) -> str:
    p, r = _rate(tp, f"({tp}) + ({fp})"), _rate(tp, f"({tp}) + ({fn})")
    f = f"(CASE WHEN {p} + {r} = 0 THEN 0.0::DOUBLE ELSE 2 * {p} * {r} / ({p} + {r}) END)"
    return f"round_even({p}, 4) AS precision, round_even({r}, 4) AS recall, round_even({f}, 4) AS f1"


# ---------------------------------------------------------------- shared parts

#: measured(..., n_chars, rep, junk) from rows(..., text)
_MEASURED = f"""
stripped AS (SELECT *, {_stripped('text')} AS t FROM rows),
worded AS (SELECT *, {_words('t')} AS w FROM stripped),
measured AS (
  SELECT * EXCLUDE (w), length(t) AS n_chars,
    CASE WHEN len(w) <= 5 THEN 0.0::DOUBLE
      ELSE (len(w) - 4 - len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))))::DOUBLE / (len(w) - 4) END AS rep,
    CASE WHEN length(t) = 0 THEN 1.0::DOUBLE ELSE length(regexp_replace(t, {_quoted(r'[\p{L}\p{N}_' + _SPACE + r'\x{4e00}-\x{9fff}' + _PUNCTUATION + ']')}, '', 'g'))::DOUBLE / length(t) END AS junk
  FROM worded)"""

_QUALITY = """CASE WHEN n_chars < 10 THEN 'text_quality_filter:too_short' WHEN n_chars > 4000 THEN 'text_quality_filter:too_long'
  WHEN rep > CAST(0.30 AS DOUBLE) THEN 'text_quality_filter:repetitive' WHEN junk > CAST(0.15 AS DOUBLE) THEN 'text_quality_filter:junk_chars' END"""

_counts = ", ".join(f"length(regexp_replace(t, '[^{c}]', '', 'g')) AS {k}" for k, c in _SCRIPTS.items())
_most = "greatest(zh, ja, ko, ru, ar, en)"
#: languages(..., lang, conf) from a relation with t
_LANGUAGES = f"""
counted AS (SELECT *, {_counts} FROM {{source}}),
languages AS (SELECT *, CASE WHEN zh + ja + ko + ru + ar + en = 0 THEN NULL {' '.join(f'WHEN {k} = {_most} THEN {_quoted(k)}' for k in _SCRIPTS)} END AS lang,
  CASE WHEN zh + ja + ko + ru + ar + en = 0 THEN 0.0::DOUBLE ELSE {_most}::DOUBLE / (zh + ja + ko + ru + ar + en) END AS conf FROM counted)"""
_LANGUAGE_REASON = "CASE WHEN t = '' THEN 'lang_id_filter:empty' WHEN lang IS NULL OR lang <> 'en' THEN 'lang_id_filter:wrong_lang' WHEN conf < 0.5 THEN 'lang_id_filter:low_confidence' END"

_cumulative, _low = [], "0"
for _name, _n in DEFAULT_COUNTS.items():
    _cumulative.append((_name, _low))
    _low = f"{_low} + greatest(1, {_n} * (SELECT count(*) FROM documents) // 20000)"
_TOTAL = _low
_classes = " ".join(f"WHEN rk >= {low} THEN {_quoted(name)}" for name, low in reversed(_cumulative))
_places = " ".join(f"WHEN rk >= {low} THEN rk - ({low})" for name, low in reversed(_cumulative))

#: src(row_idx, id, image_path, text, class, place)
_SOURCES = f"""
clean AS (SELECT doc_id AS row_idx, CAST(doc_id AS VARCHAR) AS id, 'img/' || doc_id || '.jpg' AS image_path, coalesce(text, '') AS text FROM documents),
ranked AS (SELECT *, row_number() OVER (ORDER BY {_key(SEED)}, row_idx) - 1 AS rk FROM clean),
src AS (SELECT *, CASE {_classes} END AS class, CASE {_places} END AS place FROM ranked WHERE rk < {_TOTAL})"""

_RING = """ring AS (SELECT a.row_idx, a.id || '__mismatch' AS id, b.image_path, a.text, a.image_path AS original_image FROM src a
  JOIN src b ON b.class = 'mismatch' AND b.place = (a.place + 1) % (SELECT count(*) FROM src WHERE class = 'mismatch') WHERE a.class = 'mismatch')"""
_COPIES = "copies AS (SELECT row_idx, id || '__dupexact' AS id, image_path, text, id AS duplicate_source FROM src WHERE class = 'duplicate_exact')"


def _pick(salt: int, n: int) -> str:
    return f"((k // {salt}) % {n})"


_GIBBERISH = f"""
keyed AS (SELECT *, {_key(SEED + 1)} AS k, length(text) AS n, regexp_split_to_array(trim(text), '\\s+') AS ws FROM src WHERE class = 'gibberish'),
broken AS (SELECT row_idx, id || '__gibberish' AS id, image_path, CASE {_pick(1, 3)}
  WHEN 0 THEN substring(text, 1, greatest(3, CAST(floor(n * ({_pick(7, 7)} + 2) / 100) AS BIGINT)))
  WHEN 1 THEN trim(CASE WHEN len(ws) < 6 THEN repeat(text || ' ', 12) ELSE repeat(array_to_string(ws[1:({_pick(11, 3)} + 4)], ' ') || ' ', {_pick(13, 16)} + 10) END)
  ELSE substring(text, 1, CAST(floor(n / 5) AS BIGINT)) || ' ' || array_to_string(list_transform(range(1, {_pick(17, 141)} + 61), lambda i: substring({_quoted(JUNK)}, CAST((k + i * i * 31 + i * 7) % {len(JUNK)} + 1 AS BIGINT), 1)), '')
  END AS text FROM keyed)"""
_FOREIGN = f"strange AS (SELECT row_idx, id || '__lang' AS id, image_path, ([{', '.join(map(_quoted, FOREIGN))}])[{_key(SEED + 2)} % {len(FOREIGN)} + 1] AS text FROM src WHERE class = 'wrong_lang')"

#: rows(row_idx, id, image_path, text, noise_type, duplicate_source)
_MIXED = f"""
{_SOURCES}, {_RING}, {_COPIES}, {_GIBBERISH}, {_FOREIGN},
parts AS (
  SELECT row_idx, id, image_path, text, NULL AS noise_type, NULL AS duplicate_source, 0 AS part FROM clean
  UNION ALL SELECT row_idx, id, image_path, text, 'mismatch', NULL, 1 FROM ring
  UNION ALL SELECT row_idx, id, image_path, text, 'duplicate_exact', duplicate_source, 2 FROM copies
  UNION ALL SELECT row_idx, id, image_path, text, 'gibberish', NULL, 3 FROM broken
  UNION ALL SELECT row_idx, id, image_path, text, 'wrong_lang', NULL, 4 FROM strange),
rows AS (SELECT row_number() OVER (ORDER BY ({_key(SEED + 3)} + part::BIGINT * 1566083941) % 4294967291, row_idx, part) - 1 AS row_idx, id, image_path, text, noise_type, duplicate_source FROM parts)"""

#: annotated(row_idx, id, keep, drop_reason, drop_stage, op, noise_type, is_noise, duplicate_source and scores)
_ANNOTATED = f"""
{_MIXED}, {_MEASURED}, quality AS (SELECT *, {_QUALITY} AS r0 FROM measured), {_LANGUAGES.replace('{source}', 'quality')},
judged AS (SELECT *, CASE WHEN r0 IS NULL THEN {_LANGUAGE_REASON} END AS r1 FROM languages),
annotated AS (SELECT row_idx, id, r0 IS NULL AND r1 IS NULL AS keep, coalesce(r0, r1) AS drop_reason,
  CASE WHEN r0 IS NOT NULL THEN 0 WHEN r1 IS NOT NULL THEN 1 END::BIGINT AS drop_stage, coalesce(split_part(coalesce(r0, r1), ':', 1), 'kept') AS op,
  noise_type, noise_type IS NOT NULL AS is_noise, duplicate_source, n_chars::DOUBLE AS n_chars, round_even(rep, 4) AS rep_ratio, round_even(junk, 4) AS junk_ratio,
  CASE WHEN r0 IS NULL AND t <> '' THEN round_even(conf, 4) END AS lang_conf FROM judged)"""


def _with(parts: str, query: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' * recursive}{parts.strip()}\n{query}"


_DOC_ROWS = "rows AS (SELECT doc_id, text FROM documents)"


def _distribution(quantiles: dict[str, str], rows: str) -> str:
    return f"""sorted AS (SELECT key, list(value ORDER BY value) AS s, count(*) AS n, min(value) AS lo, max(value) AS hi, avg(value) AS mean FROM ({rows}) WHERE value IS NOT NULL GROUP BY key),
quantiled AS (SELECT key, n, lo, hi, mean, {', '.join(f's[CAST({q} AS BIGINT) + 1] AS {k}' for k, q in quantiles.items())} FROM sorted)"""


_FLOOR = {k: f"least(n - 1, floor({p}::DOUBLE * n))" for k, p in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))}
_ROUND = {k: f"round_even({p}::DOUBLE * (n - 1), 0)" for k, p in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))}

# ---------------------------------------------------------------- sweep

_STEPS = 20
_SWEEP = f"""{_ANNOTATED},
labelled AS (SELECT n_chars AS v, coalesce(noise_type = 'gibberish', false) AS y FROM annotated WHERE NOT is_noise OR noise_type = 'gibberish'),
listed AS (SELECT list(v ORDER BY v) AS s, count(*) AS n FROM labelled),
candidates AS (SELECT DISTINCT unnest(list_append(list_transform(range(0, {_STEPS + 1}), lambda i: s[CAST(least(n - 1, floor(i / {_STEPS}::DOUBLE * n)) AS BIGINT) + 1]), s[n] + abs(s[n]) * 0.01::DOUBLE + 1e-6::DOUBLE)) AS t FROM listed),
tried AS (SELECT t, count(*) FILTER (v < t AND y) AS tp, count(*) FILTER (v < t AND NOT y) AS fp, count(*) FILTER (v >= t AND y) AS fn FROM candidates, labelled GROUP BY t),
swept AS (SELECT round_even(t, 4) AS threshold, tp, fp, fn, {_prf('tp', 'fp', 'fn')} FROM tried)"""

# ---------------------------------------------------------------- vectors and hashes

_WEIGHT = "[" + ", ".join(f"{((i * 37) % 11 - 5) / 4}::DOUBLE" for i in range(64)) + "]"
_VECTORS = "vecs AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
_UNIT = "vecs AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v, sqrt(list_dot_product(list_transform(embedding, lambda x: x::DOUBLE), list_transform(embedding, lambda x: x::DOUBLE))) AS l FROM embeddings)"
_SIMILAR = f"{_UNIT}, pairs AS (SELECT a.vec_id AS i, b.vec_id AS j, list_dot_product(a.v, b.v) / (a.l * b.l) AS sim FROM vecs a JOIN vecs b ON a.vec_id < b.vec_id WHERE list_dot_product(a.v, b.v) / (a.l * b.l) >= 0.4)"


def _semantic(edges: str) -> str:
    return f"""{_SIMILAR}, {edges},
links AS (SELECT i AS a, j AS b FROM edges UNION SELECT j, i FROM edges),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS vec_id, least(a, min(b)) AS root FROM reach GROUP BY a),
placed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM vecs)
SELECT v.vec_id, NOT coalesce(r.root < v.vec_id, false) AS keep, CASE WHEN r.root < v.vec_id THEN 'semantic_dedup:semantic_duplicate' END AS drop_reason,
  CASE WHEN r.root < v.vec_id THEN CAST(r.root AS VARCHAR) END AS duplicate_of, CASE WHEN r.root < v.vec_id THEN p.place::DOUBLE END AS dedup_cluster
FROM vecs v LEFT JOIN roots r USING (vec_id) LEFT JOIN placed p ON p.vec_id = r.root"""


_TOKENS = f"toks AS (SELECT doc_id, list_distinct({_words('coalesce(text, chr(32))')}) AS w FROM documents)"


def _jaccard(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END)"


def _bit(expr: str) -> str:
    """1 << n as a signed 64-bit number."""
    return f"(CASE WHEN {expr} = 63 THEN (-9223372036854775807 - 1)::BIGINT ELSE (1::BIGINT << CAST({expr} AS INTEGER)) END)"


_HASHES = f"""
bits AS (SELECT vec_id, bit_or(CASE WHEN x > 0 THEN {_bit('i')} ELSE 0::BIGINT END) AS h FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS i FROM embeddings) GROUP BY vec_id),
hashes AS (
  SELECT vec_id * 3 AS row_idx, h FROM bits
  UNION ALL SELECT vec_id * 3 + 1, xor(h, {_bit('(vec_id * 7 + 1) % 64')}) FROM bits
  UNION ALL SELECT vec_id * 3 + 2, xor(xor(xor(h, {_bit('(vec_id * 7 + 1) % 64')}), {_bit('(vec_id * 5 + 3) % 64')}), {_bit('(vec_id * 5 + 19) % 64')}) FROM bits),
banded AS (SELECT row_idx, h, unnest([0, 1, 2, 3])::BIGINT AS band, unnest([h & 65535, (h >> 16) & 65535, (h >> 32) & 65535, (h >> 48) & 65535]) AS value FROM hashes)"""
_NEAR = f"""{_HASHES},
near AS (SELECT a.row_idx AS i, b.row_idx AS j, min(a.band) AS band FROM banded a JOIN banded b ON a.band = b.band AND a.value = b.value AND a.row_idx < b.row_idx WHERE bit_count(xor(a.h, b.h)) <= 3 GROUP BY ALL)"""
_WALK = """,
numbered AS (SELECT row_idx, row_number() OVER (ORDER BY row_idx) AS rn FROM hashes),
befores AS (SELECT n.rn, n.row_idx, coalesce(e.i, []::BIGINT[]) AS before FROM numbered n LEFT JOIN (SELECT j, list(i) AS i FROM near GROUP BY j) e ON e.j = n.row_idx),
walk AS (
  SELECT 0::BIGINT AS rn, []::BIGINT[] AS gone
  UNION ALL SELECT b.rn, CASE WHEN len(list_filter(b.before, lambda x: NOT list_contains(w.gone, x))) > 0 THEN list_append(w.gone, b.row_idx) ELSE w.gone END FROM walk w JOIN befores b ON b.rn = w.rn + 1),
final AS (SELECT unnest(gone) AS row_idx FROM (SELECT gone FROM walk ORDER BY rn DESC LIMIT 1))
SELECT f.row_idx, arg_min(e.i, e.band * 1000000000000 + e.i) AS duplicate_of_idx FROM final f JOIN near e ON e.j = f.row_idx WHERE e.i NOT IN (SELECT row_idx FROM final) GROUP BY f.row_idx"""
_FIRST = _NEAR + _WALK
_toks = "list_transform(range(10), lambda i: 'w' || ((row_idx // 3 + i) % 50))"
_FIRST_WORDED = f"""{_HASHES},
worded AS (SELECT row_idx, CASE WHEN row_idx % 3 = 2 AND row_idx // 3 % 2 = 0 THEN list_append({_toks}[2:], 'other') WHEN row_idx % 3 = 1 AND row_idx // 3 % 3 = 0 THEN list_append({_toks}, 'more') ELSE {_toks} END AS toks FROM hashes),
alike AS (SELECT a.row_idx AS i, b.row_idx AS j, min(a.band) AS band FROM banded a JOIN banded b ON a.band = b.band AND a.value = b.value AND a.row_idx < b.row_idx WHERE bit_count(xor(a.h, b.h)) <= 3 GROUP BY ALL),
near AS (SELECT i, j, band FROM alike JOIN worded a ON a.row_idx = i JOIN worded b ON b.row_idx = j WHERE len(list_intersect(a.toks, b.toks)) / len(list_distinct(list_concat(a.toks, b.toks))) >= 0.9)""" + _WALK

# ---------------------------------------------------------------- pictures

_value = lambda x, y: f"((s_suppkey * 31 + ({x}) * ({x}) * 7 + ({y}) * 13 + ({x}) * ({y}) * (s_suppkey % 5)) % 256)"
_LAPLACIAN = f"{_value('x - 1', 'y')} + {_value('x + 1', 'y')} + {_value('x', 'y - 1')} + {_value('x', 'y + 1')} - 4 * {_value('x', 'y')}"
_BLUR = f"SELECT s_suppkey, var_pop({_LAPLACIAN}) AS v FROM supplier, range(1, 11) a(x), range(1, 11) b(y) GROUP BY s_suppkey"

# ---------------------------------------------------------------- chats

_role = "CASE role WHEN 'user' THEN 'user' WHEN 'human' THEN 'user' WHEN 'assistant' THEN 'assistant' WHEN 'gpt' THEN 'assistant' END"
_CHATS = f"""
turns AS (SELECT conv_id, turn, role, {_role} AS r, {_stripped('text')} AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations),
tested AS (SELECT conv_id, count(*) AS n, bool_and(coalesce(r = CASE WHEN k % 2 = 0 THEN 'user' ELSE 'assistant' END, false) AND c <> '') AS regular,
  sum((length(c) - length(replace(c, '<image>', ''))) // 7) AS tokens, bool_or(k = 0 AND contains(c, '<image>')) AS first FROM turns GROUP BY conv_id),
good AS (SELECT conv_id, n, tokens FROM tested WHERE n >= 2 AND regular AND (tokens = 0 OR tokens = 1 AND first))"""


def sql() -> dict[str, str]:
    kept = "CASE WHEN r IS NULL THEN 'kept' ELSE r END"
    groups = f"{_ANNOTATED}, c AS (SELECT row_idx, id, noise_type FROM annotated ORDER BY {_key(7)}, row_idx LIMIT (SELECT count(*) FROM annotated WHERE keep)), grouped AS (SELECT 'a_dirty' AS grp, row_idx, id, noise_type FROM annotated UNION ALL SELECT 'b_cleaned', row_idx, id, noise_type FROM annotated WHERE keep UNION ALL SELECT 'c_random', row_idx, id, noise_type FROM c)"
    short, long_ = "least(w, h)", "greatest(w, h)"
    area = "(p_size * floor(p_retailprice / 10) + p_size * floor(p_retailprice / 10) / 2)::DOUBLE / (100 * 150)"
    models = {"base": 0, "a_dirty": 1, "b_cleaned": 2, "c_random": 3}
    return {
        "text_quality_filter": _with(f"{_DOC_ROWS}, {_MEASURED}, judged AS (SELECT *, {_QUALITY} AS r FROM measured)", "SELECT doc_id, r IS NULL AS keep, r AS drop_reason, n_chars::DOUBLE AS n_chars, round_even(rep, 4) AS rep_ratio, round_even(junk, 4) AS junk_ratio FROM judged"),
        "text_quality_summary": _with(f"{_DOC_ROWS}, {_MEASURED}, judged AS (SELECT *, {_QUALITY} AS r FROM measured)", f"SELECT {kept} AS reason, count(*) AS n FROM judged GROUP BY ALL"),
        "text_ratios": _with(f"{_DOC_ROWS}, {_MEASURED}", "SELECT doc_id, n_chars, rep AS repeated_ngram_ratio, junk AS junk_char_ratio FROM measured"),
        "script_counts": _with(f"{_MIXED}, stripped AS (SELECT *, {_stripped('text')} AS t FROM rows), {_LANGUAGES.replace('{source}', 'stripped')}", "SELECT id, zh, ja, ko, ru, ar, en FROM languages"),
        "lang_id_filter": _with(f"{_MIXED}, stripped AS (SELECT *, {_stripped('text')} AS t FROM rows), {_LANGUAGES.replace('{source}', 'stripped')}", f"SELECT id, {_LANGUAGE_REASON} IS NULL AS keep, {_LANGUAGE_REASON} AS drop_reason, CASE WHEN t <> '' THEN round_even(conf, 4) END AS lang_conf, CASE WHEN t <> '' THEN lang END AS lang FROM languages"),
        "token_jaccard": _with(_TOKENS, f"SELECT a.doc_id, {_jaccard('a.w', 'b.w')} AS jaccard FROM toks a JOIN toks b ON b.doc_id = a.doc_id + 1"),
        "pipeline_annotated": _with(_ANNOTATED, "SELECT row_idx, id, keep, drop_reason, drop_stage, n_chars, rep_ratio, junk_ratio, lang_conf FROM annotated"),
        "pipeline_op_report": _with(f"{_ANNOTATED}, ops AS (SELECT unnest([0, 1])::BIGINT AS stage_no, unnest(['text_quality_filter', 'lang_id_filter']) AS op), steps AS (SELECT stage_no, op, (SELECT count(*) FROM annotated WHERE keep OR drop_stage >= stage_no) AS n_in, (SELECT count(*) FROM annotated WHERE drop_stage = stage_no) AS n_dropped FROM ops)", f"SELECT stage_no, op, n_in, n_dropped, n_in - n_dropped AS n_out, round_even({_rate('n_dropped', 'n_in')}, 4) AS drop_rate FROM steps"),
        "pipeline_totals": _with(_ANNOTATED, "SELECT count(*) AS n_input, count(*) FILTER (keep) AS n_output, round_even(1 - count(*) FILTER (keep)::DOUBLE / count(*), 4) AS overall_drop_rate FROM annotated"),
        "drop_reason_histogram": _with(_ANNOTATED, "SELECT drop_stage, drop_reason, count(*) AS n FROM annotated WHERE NOT keep GROUP BY ALL"),
        "drops_by_noise": _with(_ANNOTATED, "SELECT drop_stage, coalesce(noise_type, 'clean') AS noise_type, count(*) AS n FROM annotated WHERE NOT keep GROUP BY ALL"),
        "score_distribution": _with(f"{_ANNOTATED}, {_distribution(_FLOOR, 'UNPIVOT (SELECT n_chars, rep_ratio, junk_ratio, lang_conf FROM annotated) ON n_chars, rep_ratio, junk_ratio, lang_conf INTO NAME key VALUE value')}", "SELECT key, n, round_even(lo, 4) AS min, round_even(p10, 4) AS p10, round_even(p50, 4) AS p50, round_even(p90, 4) AS p90, round_even(hi, 4) AS max, round_even(mean, 4) AS mean FROM quantiled"),
        "latency_quantiles": _with(_distribution(_ROUND, "SELECT event_type AS key, value FROM events"), "SELECT key, n, p50, p90, p99 FROM quantiled"),
        "inject_mismatch_ring": _with(f"{_SOURCES}, {_RING}", "SELECT id, image_path, original_image FROM ring"),
        "inject_duplicates": _with(f"{_SOURCES}, {_COPIES}", "SELECT id, text, duplicate_source FROM copies"),
        "inject_gibberish": _with(f"{_SOURCES}, {_GIBBERISH}", "SELECT id, text FROM broken"),
        "inject_wrong_lang": _with(f"{_SOURCES}, {_FOREIGN}", "SELECT id, text FROM strange"),
        "inject_order": _with(_MIXED, "SELECT row_idx, id FROM rows"),
        "noise_composition": _with(_MIXED, "SELECT coalesce(noise_type, 'clean') AS noise_type, count(*) AS n FROM rows GROUP BY ALL"),
        "eval_overall": _with(f"{_ANNOTATED}, sums AS (SELECT count(*) AS n_samples, count(*) FILTER (is_noise) AS n_noise, count(*) FILTER (NOT keep) AS n_dropped, count(*) FILTER (NOT keep AND is_noise) AS tp, count(*) FILTER (NOT keep AND NOT is_noise) AS fp, count(*) FILTER (keep AND is_noise) AS fn FROM annotated)", f"SELECT *, {_prf('tp', 'fp', 'fn')} FROM sums"),
        "eval_per_operator": _with(_ANNOTATED, f"SELECT op, count(*) AS dropped, count(*) FILTER (is_noise) AS true_noise, count(*) FILTER (NOT is_noise) AS false_positives, round_even({_rate('count(*) FILTER (is_noise)', 'count(*)')}, 4) AS precision, round_even({_rate('count(*) FILTER (is_noise)', '(SELECT count(*) FROM annotated WHERE is_noise)')}, 4) AS share_of_all_noise FROM annotated WHERE NOT keep GROUP BY op"),
        "eval_operator_noise_types": _with(_ANNOTATED, "SELECT op, noise_type, count(*) AS n FROM annotated WHERE NOT keep AND is_noise GROUP BY ALL"),
        "eval_per_noise_type": _with(_ANNOTATED, f"SELECT noise_type, count(*) AS total, count(*) FILTER (NOT keep) AS caught, round_even({_rate('count(*) FILTER (NOT keep)', 'count(*)')}, 4) AS recall FROM annotated WHERE noise_type IS NOT NULL GROUP BY noise_type"),
        "eval_caught_by": _with(_ANNOTATED, "SELECT noise_type, op, count(*) AS n FROM annotated WHERE noise_type IS NOT NULL AND NOT keep GROUP BY ALL"),
        "eval_dedup_groups": _with(f"{_ANNOTATED}, members AS (SELECT DISTINCT source, unnest([source, id]) AS id FROM (SELECT duplicate_source AS source, id FROM annotated WHERE duplicate_source IN (SELECT id FROM annotated))), lefts AS (SELECT source, count(*) FILTER (keep) AS l FROM members JOIN annotated USING (id) GROUP BY source), sums AS (SELECT count(*) AS n_groups, count(*) FILTER (l = 1) AS collapsed_to_one, count(*) FILTER (l > 1) AS under_deduplicated, count(*) FILTER (l = 0) AS over_deleted FROM lefts)", f"SELECT *, round_even({_rate('collapsed_to_one', 'n_groups')}, 4) AS collapse_rate FROM sums"),
        "threshold_sweep": _with(_SWEEP, "SELECT * FROM swept"),
        "best_threshold": _with(_SWEEP, "SELECT * FROM swept ORDER BY f1 DESC, threshold LIMIT 1"),
        "clip_score_filter": _with(f"{_VECTORS}, scored AS (SELECT a.vec_id, list_dot_product(a.v, b.v) AS s FROM vecs a JOIN vecs b ON b.vec_id = (a.vec_id + 1) % (SELECT count(*) FROM vecs))", "SELECT vec_id, s >= 0.05 AS keep, CASE WHEN s < 0.05 THEN 'clip_score_filter:below_min' END AS drop_reason, round(s, 6) AS clip_score FROM scored"),
        "aesthetic_score_filter": _with(f"{_VECTORS}, scored AS (SELECT vec_id, list_dot_product(v, {_WEIGHT}) + 5.0 AS s FROM vecs)", "SELECT vec_id, s >= 4.5 AS keep, CASE WHEN s < 4.5 THEN 'aesthetic_score_filter:below_min' END AS drop_reason, round(s, 6) AS aesthetic FROM scored"),
        "cosine_pairs": _with(_SIMILAR, "SELECT i, j, round(sim, 6) AS sim FROM pairs"),
        "semantic_dedup": _with(_semantic("edges AS (SELECT i, j FROM pairs)"), "", True),
        "semantic_dedup_text_aware": _with(_semantic(f"{_TOKENS}, worded AS (SELECT e.vec_id, coalesce(t.w, []::VARCHAR[]) AS w FROM vecs e LEFT JOIN toks t ON t.doc_id = e.vec_id), edges AS (SELECT i, j FROM pairs JOIN worded a ON a.vec_id = i JOIN worded b ON b.vec_id = j WHERE {_jaccard('a.w', 'b.w')} >= CAST(0.02 AS DOUBLE))"), "", True),
        "band_candidates": _with(_HASHES, "SELECT band, value, count(*) AS n FROM banded GROUP BY ALL HAVING count(*) > 1"),
        "hamming_pairs": _with(_NEAR, "SELECT i, j, band FROM near"),
        "phash_dedup": _with(_FIRST, "", True),
        "phash_dedup_text_aware": _with(_FIRST_WORDED, "", True),
        "serving_stats": "WITH r AS (SELECT user_id % 4 AS concurrency, event_id % 7 <> 0 AS ok, event_id::DOUBLE AS begun, (event_id + 2)::DOUBLE AS ended, value, event_id % 100 AS tok FROM events), "
        "w AS (SELECT concurrency, max(ended) - min(begun) AS wall, count(*) FILTER (NOT ok) AS failed FROM r GROUP BY 1), "
        "g AS (SELECT concurrency, count(*) AS ok, sum(tok) AS tok, list_sort(list(value))[CAST(round_even(0.5 * (count(*) - 1), 0) AS BIGINT) + 1] AS ttft_p50, list_sort(list(value))[CAST(round_even(0.9 * (count(*) - 1), 0) AS BIGINT) + 1] AS ttft_p90, list_sort(list(value))[CAST(round_even(0.99 * (count(*) - 1), 0) AS BIGINT) + 1] AS ttft_p99, median(value / 8) AS m FROM r WHERE ok GROUP BY 1) "
        "SELECT concurrency, ok, failed, wall, round(ok / wall, 6) AS req_per_s, round(tok / wall, 6) AS out_tok_per_s, ttft_p50, ttft_p90, ttft_p99, round(m, 6) AS tpot_p50, round(tok / ok, 6) AS mean_out_tokens FROM w JOIN g USING (concurrency)",
        "blur_filter": f"SELECT s_suppkey, v >= 20000 AS keep, CASE WHEN v < 20000 THEN 'image_blur_filter:below_min' END AS drop_reason, round(v, 3) AS blur_var FROM ({_BLUR})",
        "image_headers": "SELECT p_partkey, p_size * 40 AS width, CAST(floor(p_retailprice) AS BIGINT) AS height FROM part",
        "extract_text": _with(_CHATS, "SELECT conv_id, coalesce(string_agg(c, chr(10) ORDER BY turn) FILTER (r = 'assistant' AND c <> ''), '') AS text FROM turns GROUP BY conv_id"),
        "to_sharegpt": _with(f"{_CHATS}, made AS (SELECT conv_id, string_agg(r || ': ' || CASE WHEN k = 0 AND tokens = 0 THEN '<image>' || chr(10) || c ELSE c END, chr(10) || '--' || chr(10) ORDER BY k) AS messages, any_value(n) AS n_messages FROM turns JOIN good USING (conv_id) GROUP BY conv_id)", "SELECT c.conv_id, messages, CASE WHEN n_messages IS NOT NULL THEN '/data/shared.jpg' END AS image, n_messages FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN made USING (conv_id)"),
        "sft_groups": _with(groups, "SELECT grp, row_idx, id FROM grouped"),
        "sft_manifest": _with(groups, "SELECT grp, coalesce(noise_type, 'clean') AS noise_type, count(*) AS n, greatest(1, CAST(floor(count(*) * 3.0 / 16) AS BIGINT)) AS steps FROM grouped GROUP BY grp, coalesce(noise_type, 'clean')"),
        "size_matched_sample": f"SELECT doc_id FROM documents ORDER BY {_key(SEED, 'doc_id')}, doc_id LIMIT (SELECT count(*) // 3 FROM documents)",
        "resolution_gate": _with("sized AS (SELECT p_partkey, p_size * 40 AS w, CAST(floor(p_retailprice) AS INTEGER) AS h FROM part)", f"SELECT p_partkey, CASE WHEN {short} < 224 THEN 'too_small' WHEN {long_} > 1600 THEN 'too_large' WHEN {long_}::DOUBLE / {short} > 3.0 THEN 'bad_aspect' END AS code, {short}::BIGINT AS min_side, {long_}::DOUBLE / {short} AS aspect_ratio FROM sized"),
        "ocr_density": f"SELECT p_partkey, round(least(1.0::DOUBLE, {area}), 6) AS text_area_ratio, CASE WHEN least(1.0::DOUBLE, {area}) > 0.25 THEN 'ocr_density_filter:above_max' END AS drop_reason FROM part",
        "distinct_image_refs": "SELECT 'u/' || user_id || '.jpg' AS image_path, min(event_id) AS row_idx FROM events GROUP BY user_id",
        "delta_table": _with(f"cells AS (SELECT c_mktsegment AS dataset, c_custkey % 4 AS m, CAST(floor(count(*) FILTER (c_acctbal > 0) * 100 / count(*)) AS BIGINT) AS score FROM customer GROUP BY ALL), wide AS (SELECT dataset, {', '.join(f'max(score) FILTER (m = {i}) AS {k}' for k, i in models.items())} FROM cells GROUP BY dataset)", "SELECT *, b_cleaned - c_random AS b_minus_c, b_cleaned - a_dirty AS b_minus_a FROM wide"),
    }


__all__ = ["SEED", "SUFFIXES", "sql"]
