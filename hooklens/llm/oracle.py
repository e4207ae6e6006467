"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_RESTS = r"\|im_start\|>|\|im_end\|>|\|nl\|>|\|endoftext\|>|/?s>|/?INST\]|/?<?SYS>"

_OP8 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_replace(text, '([<\\[])(\\\\*)({_RESTS})', '\\1\\\\\\2\\3', 'g') AS escaped FROM turns
)
SELECT conv_id,
  count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>' || role || chr(10) || escaped || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""



#: kind, pattern, group, least characters; the base kinds as their contract words them.
_KINDS = (
    ("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=\\ \t\r\n:,-]*?-----END [A-Z ]{0,40}PRIVATE KEY-----"
     r"|(?:(?:\\[nr]|[ \t\r\n])+[A-Za-z0-9+/]{16,}=*)*(?:(?:\\[nr]|[ \t\r\n])+[A-Za-z0-9+/]+=+)?)", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("hub", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("basic", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]+:[^\s/:@]+@", 0, 1),
)


def _op9() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    parts = []
    for number, (kind, pattern, group, least) in enumerate(_KINDS):
        p = quoted(pattern)
        parts.append(f"""
  SELECT doc_id, {number} AS k, '{kind}' AS kind, start, start + length(m[i]) AS stop FROM (
    SELECT *, (list_sum(list_transform(g[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start FROM (
      SELECT doc_id, unnest(range(1, len(m) + 1)) AS i, m, g, c FROM (
        SELECT doc_id, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {group}) AS c,
          string_split_regex(t, {p}) AS g FROM texts))) WHERE length(c[i]) >= {least}""")
    joined = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k)"
    counts = ", ".join(f"count(*) FILTER (k = {n})::BIGINT AS n_{k[0]}" for n, k in enumerate(_KINDS[:3]))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(parts)}),
found AS (SELECT doc_id, {counts}, {joined} FILTER (k < 3) AS base, {joined} AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{k[0]}, 0) AS n_{k[0]}" for k in _KINDS[:3])},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (doc_id)
"""


def _op10() -> str:
    from hooklens.llm.quality import STOP_WORDS

    stops = ", ".join("'" + v + "'" for w in dict.fromkeys(STOP_WORDS) for v in (w, w.capitalize()))
    lines_like = lambda p: f"len(list_filter(lines, lambda x: regexp_matches(x, '{p}')))"
    rules = (
        ("few_words", "n_words < 10"),
        ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
        ("short_words", "n_words > 0 AND word_chars < 2 * n_words"),
        ("long_words", "n_words > 0 AND word_chars > 25 * n_words"),
        ("symbols", "n_words > 0 AND 4 * n_symbols > n_words"),
        ("duplicate_lines", "n_words >= 20 AND n_dup_lines / n_lines::DOUBLE > 0.6"),
        ("stop_words", "n_words >= 80 AND n_stop / n_words::DOUBLE < 0.01"),
        ("bullets", "n_words >= 20 AND n_bullets / n_lines::DOUBLE > 0.9"),
        ("ellipses", "n_words >= 20 AND n_ellipses / n_lines::DOUBLE > 0.5"),
        ("shouting", "n_words > 0 AND 2 * n_shouts > n_words"),
    )
    failed = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in rules)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS words,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM texts),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w FROM (
  SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY doc_id),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines) AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(words, lambda x: list_contains([{stops}], x))) AS n_stop,
  {lines_like("^[[:space:]]*(?:[-*•]|[0-9]+[.)])[[:space:]]")} AS n_bullets,
  {lines_like("(?:[.][.][.]|…)[[:space:]]*$")} AS n_ellipses,
  len(regexp_extract_all(t, '!!')) AS n_shouts FROM split LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, list_filter([{failed}], lambda x: x IS NOT NULL) AS names FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  list_has_any(names, ['few_words', 'repeated_windows']) AS base_failed, len(names) = 0 AS kept,
  array_to_string(names, ',') AS failed_rules
FROM judged
"""


_ALPHABET = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), {}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_ALPHABET)

_OP12 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
held AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs),
tfs AS (SELECT r, doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
total AS (SELECT count(*) FILTER (len(terms) > 0) AS nn, sum(len(terms))::BIGINT AS ll FROM docs),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, total GROUP BY term),
asked AS (SELECT i, item_id, term, count(*) AS times FROM (
  SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scores AS (SELECT i, item_id, r, doc_id,
  sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nn) // ll))))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term), total GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0) WHERE rank <= 10
"""


def _tree(name: str, levels: int) -> str:
    """Tables `{name}_0..levels` of nodes (g, slot, d), and `{name}_path` (g, slot, l0, r0, m0, ...) of the lowest."""
    parts = []
    for i in range(levels):
        parts.append(f"""{name}_c{i} AS (SELECT *, count(*) OVER (PARTITION BY g) > 1 AS m FROM {name}_{i}),
{name}_s{i} AS (SELECT a.g, a.slot, a.m, coalesce(string_agg(b.d, '' ORDER BY b.slot) FILTER (b.slot < a.slot), '') AS l,
  coalesce(string_agg(b.d, '' ORDER BY b.slot) FILTER (b.slot > a.slot), '') AS r
  FROM {name}_c{i} a JOIN {name}_c{i} b ON a.g = b.g AND a.slot // 16 = b.slot // 16 GROUP BY ALL),
{name}_{i + 1} AS (SELECT g, slot // 16 AS slot,
  CASE WHEN bool_or(m) THEN sha256(string_agg(d, '' ORDER BY slot)) ELSE min(d) END AS d FROM {name}_c{i} GROUP BY 1, 2)""")
    columns = ", ".join(f"s{i}.l AS l{i}, s{i}.r AS r{i}, s{i}.m AS m{i}" for i in range(levels))
    joins = " ".join(f"JOIN {name}_s{i} s{i} ON s{i}.g = n.g AND s{i}.slot = n.slot // {16**i}" for i in range(levels))
    parts.append(f"{name}_path AS (SELECT n.g, n.slot, {columns} FROM {name}_0 n {joins})")
    return ",\n".join(parts)


def _op13(levels: int = 5, top: int = 3) -> str:
    """Enough for 16^levels rows of a source and 16^top sources."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = f"translate(text, {_ALPHABET})"
    # the check sum bit by bit: a character enters with the first of its eight steps
    crc = (
        "xor(4294967295, list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
        "lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])), "
        "lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)), 4294967295::BIGINT))"
    )
    folds, prior = [], "c"
    for k, (name, i) in enumerate([("t", i) for i in range(levels)] + [("u", i) for i in range(top)]):
        folds.append(f"w{k + 1} AS (SELECT *, CASE WHEN {name}m{i} THEN sha256({name}l{i} || {prior} || {name}r{i}) ELSE {prior} END AS f{k + 1} FROM w{k})")
        prior = f"f{k + 1}"
    path = lambda name, count: ", ".join(
        f"{name}.{c}{i} AS {name}{c}{i}" for i in range(count) for c in "lrm"
    )
    proof = " || ".join(f"{name}l{i} || {name}r{i}" for name, count in (("t", levels), ("u", top)) for i in range(count))
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce('s' || source, '') AS g,
  sha256({head} || {field('text')}) AS d,
  CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {field(low)}) END AS other FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d, row) - 1 AS slot FROM texts),
t_0 AS (SELECT g, slot, d FROM placed),
{_tree("t", levels)},
u_0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS slot, d, g AS source_g FROM t_{levels}),
{_tree("u", top)},
w0 AS (SELECT p.doc_id, p.d, coalesce(p.other, p.d) AS c, u_0.d AS subroot, (SELECT d FROM u_{top}) AS root,
  {path("t", levels)}, {path("u", top)}
  FROM placed p JOIN t_path t ON t.g = p.g AND t.slot = p.slot
  JOIN u_0 ON u_0.source_g = p.g JOIN u_path u ON u.slot = u_0.slot),
{", ".join(folds)}
SELECT doc_id, d AS leaf, subroot, root, sha256({proof}) AS proof_sha256, {prior} AS folded_root, {prior} = root AS verified
FROM w{len(folds)}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_chat_log": _OP8, "op9_secret_ledger": _op9(), "op10_quality_rules": _op10(),
        "op12_automaton_search": _OP12, "op13_merkle_manifest": _op13(),
    }
