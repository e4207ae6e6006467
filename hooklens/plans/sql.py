"""Oracle SQL fragments: the derived views and the shared expressions, for DuckDB."""

from __future__ import annotations

from collections.abc import Sequence

from hooklens import lists
from hooklens.functions.text import WHITE, WHITE_CHARS
from hooklens.functions.urls import PATTERNS
from hooklens.plans.views import AUTH_JSON, BAD_JSON, EXPERIMENT_NAMES, GAINS, NONE_JSON


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def listing(values: Sequence[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def draw(key: str, salt: str, digits: int = 8) -> str:
    return f"(('0x' || substr(md5('42:{salt}:' || {key}), 1, {digits}))::BIGINT)"


def permille(key: str, salt: str) -> str:
    return f"({draw(key, salt)} % 1000)"


def pick(values: Sequence[str], key: str, salt: str) -> str:
    return f"list_extract({listing(values)}, ({draw(key, salt)} % {len(values)} + 1)::INT)"


def strip(expr: str) -> str:
    return f"trim({expr}, {q(WHITE_CHARS)})"


def find_all(text: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({text}, {q(pattern)}, {group})"


def find(text: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract({text}, {q(pattern)}, {group})"


def swap(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(by)}, 'g')"


def any_of(values: Sequence[str], test: str) -> str:
    """Does `test` (over v) hold for some listed value."""
    return f"(len(list_filter({listing(values)}, lambda v: {test})) > 0)"


def some(array: str, test: str) -> str:
    return f"(len(list_filter({array}, lambda x: {test})) > 0)"


def ratio(part: str, whole: str) -> str:
    return f"coalesce(({part})::DOUBLE / nullif({whole}, 0), 0.0)"


TEXT = strip("coalesce(subject, '') || ' ' || coalesce(body, '')")
LOOSE, RULE, STRICT = PATTERNS["loose"], PATTERNS["rule"], PATTERNS["strict"]
SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"


def raw_host(url: str) -> str:
    return f"lower({find(url, '^(?:https?://)?([^/]*)', 1)})"


def netloc(url: str) -> str:
    return f"lower({find(url, SCHEME + '([^/?#]*)', 1)})"


def with_scheme(url: str) -> str:
    return f"(CASE WHEN contains({url}, '://') THEN {url} ELSE 'http://' || {url} END)"


def hostname(url: str) -> str:
    pattern = SCHEME + r"(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#@]*)"
    return f"lower(translate({find(url, pattern, 1)}, '[]', ''))"


def path(url: str) -> str:
    return swap(find(url, SCHEME + "[^/?#]*([^?#]*)", 1), ";[^/]*$", "")


def last_label(host: str) -> str:
    return find(host, r"\.([^.]*)$", 1)


def non_ascii(text: str) -> str:
    return f"regexp_matches({text}, {q('[^' + chr(92) + 'x00-' + chr(92) + 'x7F]')})"


# --- views ------------------------------------------------------------------------------


def _synth(key: str = "id") -> tuple[str, str]:
    phishing = "coalesce(label = 'phishing', false)"

    def rate(salt: str, ham: int, phish: int) -> str:
        return f"{permille(key, salt)} < (CASE WHEN {phishing} THEN {phish} ELSE {ham} END)"

    host = find("url", "^(?:https?://)?([^/]*)", 1)
    domain = f"coalesce({find(host, '([^.]*[.][^.]*)$', 1)}, '')"
    sender = pick(lists.LEGIT_DOMAINS, key, "from")

    def reply(salt: str, phish: int) -> str:
        return (
            f"(CASE WHEN {phishing} AND {domain} <> '' THEN {domain} "
            f"WHEN {rate(salt, 50, phish)} THEN {pick(lists.ATTACKER_DOMAINS, key, salt + '_domain')} "
            f"ELSE {sender} END)"
        )

    spf = (
        f"(CASE WHEN {phishing} AND {permille(key, 'spf')} < 600 THEN 'fail' "
        f"WHEN {phishing} AND {permille(key, 'spf_none')} < 300 THEN 'none' "
        f"WHEN NOT {phishing} AND {permille(key, 'spf')} < 100 THEN 'none' ELSE 'pass' END)"
    )
    dkim = f"(CASE WHEN {rate('dkim', 50, 500)} THEN 'fail' ELSE 'pass' END)"
    dmarc = (
        f"(CASE WHEN {rate('dmarc', 50, 500)} THEN 'fail' "
        f"WHEN {phishing} AND {permille(key, 'dmarc_none')} < 300 THEN 'none' ELSE 'pass' END)"
    )
    nl = "chr(10)"
    headers = (
        f"'From: alerts@' || {sender} || {nl} || 'Reply-To: support@' || {reply('reply', 600)} || {nl} "
        f"|| 'Return-Path: bounce@' || {reply('return', 500)} || {nl} "
        f"|| 'Authentication-Results: spf=' || {spf} || ' dkim=' || {dkim} || ' dmarc=' || {dmarc} || {nl}"
    )
    mismatch = f"{permille(key, 'mis')} < (CASE WHEN label = 'phishing' THEN 700 ELSE 100 END)"
    html = (
        "coalesce('<html><body><p>Notification:</p><a href=\"' || url || '\">' || "
        f"(CASE WHEN {mismatch} THEN {pick(lists.GENERIC_LINK_TEXTS, key, 'opt')} "
        f"ELSE 'Click here to visit ' || {host} END) || '</a></body></html>', '')"
    )
    return headers, html


HEADERS_SQL, HTML_SQL = _synth()
_U, _K = permille("d.doc_id", "url"), "d.doc_id::VARCHAR"
MESSAGES = f"""
m0 AS (
  SELECT d.doc_id AS id,
    CASE l.toxic WHEN 1 THEN 'phishing' WHEN 0 THEN 'ham' END AS label,
    split_part(d.text, chr(10), 1) AS subject,
    d.text || CASE
      WHEN {_U} < 200 THEN ''
      WHEN {_U} < 300 THEN ' https://bit.ly/' || {_K}
      WHEN {_U} < 400 THEN ' https://l.facebook.com/l.php?u=http://x' || {_K} || '.com'
      WHEN {_U} < 500 THEN ' http://login.' || d.source || '.tk/verify//x'
      WHEN {_U} < 600 THEN ' http://user@pay' || {_K} || '.com:8080/a'
      WHEN {_U} < 700 THEN ' http://exämple' || {_K} || '.com/'
      WHEN {_U} < 800 THEN ' http://a.' || d.source || '.zip/1 http://a.' || d.source || '.zip/2)'
      WHEN {_U} < 900 THEN ' HTTP://Shop.Example.com/q?a=1 HTTP://Shop.Example.com/q?a=1'
      ELSE ' ' || p.url END AS body,
    strftime(TIMESTAMP '2024-01-01' + to_minutes(d.doc_id), '%Y-%m-%d %H:%M:%S') AS date,
    d.source AS source
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN pages p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages)
),
m1 AS (SELECT *, nullif({find('body', LOOSE)}, '') AS url FROM m0),
messages AS (
  SELECT id, label, subject, body, date, source,
    CASE WHEN {permille('id', 'nohdr')} >= 100 THEN {HEADERS_SQL} END AS headers_raw,
    {HTML_SQL} AS html,
    CASE WHEN {permille('id', 'json')} < 400 THEN {q(AUTH_JSON)}
      WHEN {permille('id', 'json')} < 600 THEN {q(NONE_JSON)}
      WHEN {permille('id', 'json')} < 700 THEN {q(BAD_JSON)} END AS headers_json
  FROM m1
)"""


def score(salt: str, gain: float) -> str:
    return (
        f"round(0.6::DOUBLE * ({permille('id', salt)} / 1000.0::DOUBLE) "
        f"+ {gain}::DOUBLE * y_true, 3)"
    )


SCORES = f"""
s0 AS (
  SELECT doc_id AS id, (toxic = 1)::INT AS y_true FROM labels
  WHERE toxic IS NOT NULL AND doc_id IN (SELECT doc_id FROM documents)
),
scores AS (SELECT id, y_true, {score('score', 0.35)} AS score FROM s0)"""

SPLIT = """
ranked AS (
  SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:split:' || id), id) AS place,
    count(*) OVER (PARTITION BY label) AS n
  FROM messages WHERE label IS NOT NULL
),
split AS (
  SELECT id, label, CASE WHEN place <= floor(0.2::DOUBLE * n + 0.5) THEN 'test' ELSE 'train' END AS split
  FROM ranked
)"""

SPLIT_SIZES = """
sizes AS (SELECT count(*) FILTER (y_true = 0) AS ham, count(*) FILTER (y_true = 1) AS phishing,
  floor(0.2::DOUBLE * count(*) FILTER (y_true = 0) + 0.5::DOUBLE)::BIGINT AS test_ham,
  floor(0.2::DOUBLE * count(*) FILTER (y_true = 1) + 0.5::DOUBLE)::BIGINT AS test_phishing FROM s0)"""

EXPERIMENTS = (
    SCORES
    + ",\nexperiments AS (\n"
    + "\nUNION ALL ".join(
        f"SELECT '{e}' AS experiment, id, y_true, {score('score' + e, g)} AS score FROM s0"
        for e, g in zip(EXPERIMENT_NAMES, GAINS)
    )
    + ")"
)

RAW_MAIL = (
    MESSAGES
    + """,
raw_mail AS (
  SELECT id AS "Message ID", CASE WHEN id % 7 <> 0 THEN subject END AS "Subject", body AS "Message",
    CASE WHEN label = 'ham' THEN 'ham' ELSE 'spam' END AS "Spam/Ham",
    CASE WHEN id % 11 <> 0 THEN substr(date, 1, 10) END AS "Date"
  FROM messages WHERE label IS NOT NULL
)"""
)


def select(body: str, *views: str) -> str:
    return "WITH " + ",\n".join(v.strip() for v in views) + "\n" + body.strip()


def points(source: str, by: str = "") -> str:
    """Rated curve points over a view of `y_true, score` (optionally per group)."""
    keys, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    return f"""
g AS (SELECT {keys}score AS threshold, sum(y_true)::BIGINT AS pos, (count(*) - sum(y_true))::BIGINT AS neg
      FROM {source} GROUP BY ALL),
c AS (SELECT *, (sum(pos) OVER w)::BIGINT AS tp, (sum(neg) OVER w)::BIGINT AS fp,
        (sum(pos) OVER t)::BIGINT AS n_pos, (sum(neg) OVER t)::BIGINT AS n_neg
      FROM g WINDOW w AS ({part} ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING), t AS ({part})),
pts0 AS (SELECT *, tp::DOUBLE / (tp + fp) AS precision, coalesce(tp::DOUBLE / nullif(n_pos, 0), 1.0) AS recall,
        coalesce(fp::DOUBLE / nullif(n_neg, 0), 0.0) AS fpr, coalesce(tp::DOUBLE / nullif(n_pos, 0), 0.0) AS tpr
      FROM c),
pts1 AS (SELECT *, lag(precision, 1, 1.0) OVER w AS precision_up, lag(recall, 1, 0.0) OVER w AS recall_up,
        lag(fpr, 1, 0.0) OVER w AS fpr_up, lag(tpr, 1, 0.0) OVER w AS tpr_up
      FROM pts0 WINDOW w AS ({part} ORDER BY threshold DESC)),
pts AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1,
        coalesce(2 * precision_up * recall_up / nullif(precision_up + recall_up, 0), 0.0) AS f1_up
      FROM pts1)"""
