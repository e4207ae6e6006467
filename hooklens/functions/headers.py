"""Mail header expressions: address domains, authentication results, header JSON."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hooklens import lists
from hooklens.functions.text import blank, contains_any, strip

# The header block: field lines and continuation lines up to the first other line.
# The possessive loop keeps the match iterative on blocks with very many lines.
BLOCK = r"\A(?:(?:From |[\x21-\x39\x3B-\x7E]*:|[ \t])[^\n]*(?:\n|\z))*+"


def unfolded(raw: Column) -> Column:
    """Header block with continuation lines joined to their field."""
    return F.regexp_replace(F.regexp_extract(blank(raw), BLOCK, 0), r"\r?\n([ \t])", "$1")


def field_values(block: Column, name: str) -> Column:
    return F.regexp_extract_all(block, F.lit(rf"(?imd)^{name}:[ \t]*([^\r\n]*)"), F.lit(1))


def address_domains(block: Column, name: str) -> Column:
    """Lower-case domains of all addresses of a field, in order.

    Quoted names and comments go first, `Name <address>` shrinks to the address, then
    the part after the last at sign of each comma-separated entry is taken.
    """
    listed = F.lower(F.array_join(field_values(block, name), ","))
    bare = F.regexp_replace(listed, r"\"[^\"]*\"|\([^()]*\)", "")
    addresses = F.regexp_replace(bare, r"[^,<]*<([^<>]*)>[^,]*", "$1")
    return F.regexp_extract_all(addresses, F.lit(r"@([^@,;<>\s]*)[;\s]*(?:,|$)"), F.lit(1))


def auth_results(block: Column) -> Column:
    """Lower-case value of the first Authentication-Results field, empty when absent."""
    pattern = r"(?imd)^authentication-results:[ \t]*([^\r\n]*)"
    return F.lower(F.regexp_extract(block, pattern, 1))


def auth_flags(auth: Column) -> dict[str, Column]:
    return {
        "auth_spf_fail": F.contains(auth, F.lit("spf=fail")),
        "auth_dkim_fail": F.contains(auth, F.lit("dkim=fail")),
        "auth_dmarc_fail": F.contains(auth, F.lit("dmarc=fail")),
        "auth_any_none": contains_any(auth, ("spf=none", "dkim=none", "dmarc=none")),
    }


def domains_differ(left: Column, right: Column) -> Column:
    """Both domain lists are non-empty and differ as sets."""
    as_set = lambda c: F.array_sort(F.array_distinct(c))
    return (F.size(left) > 0) & (F.size(right) > 0) & (as_set(left) != as_set(right))


def raw_headers_missing(raw: Column) -> Column:
    """No SPF, DKIM or DMARC result in raw header text."""
    return ~contains_any(F.lower(blank(raw)), ("spf=", "dkim=", "dmarc="))


def _json_keys(json: Column) -> Column:
    """Lower-case keys of a JSON object; null for anything else."""
    text = F.lower(json)
    return F.when(strip(text).startswith("{"), F.json_object_keys(text))


def json_headers_missing(json: Column) -> Column:
    """No authentication key in header JSON; invalid JSON counts as missing."""
    wanted = F.array(*[F.lit(k) for k in lists.AUTH_KEYS])
    return ~F.coalesce(F.arrays_overlap(_json_keys(json), wanted), F.lit(False))


def json_auth_ok(json: Column) -> Column:
    """Valid header JSON that names all three mechanisms and a pass."""
    text = F.lower(json)
    named = F.lit(True)
    for word in ("spf", "dkim", "dmarc", "pass"):
        named = named & F.contains(text, F.lit(word))
    return F.coalesce(_json_keys(json).isNotNull() & named, F.lit(False))
