"""Anchor expressions over HTML."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

from hooklens.functions.text import bind, blank, strip
from hooklens.functions.urls import hostname, with_scheme

NOT_CONTENT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
#: Inside of a tag. A quote opens a value only after an equals sign; in a value `>` ends nothing. Possessive, so
#: that the matcher loops instead of recursing, however many attributes a tag has.
_INSIDE = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+"""
_OPENING = rf"(?is)<a(?=[\s>/]){_INSIDE}>"
# An anchor ends at its closing tag, at the next anchor, or at the end of the document.
ANCHOR = rf"{_OPENING}.*?(?=</a\s*>|<a[\s>/]|\z)"
#: A tag within a text: a `<` that no letter, slash, `!` or `?` follows is a character.
TAG = rf"(?s)</?[A-Za-z]{_INSIDE}>|</?[!?]?[A-Za-z!?][^>]*\z|<[!?][^>]*>"
#: Name and value of an attribute.
_ATTRIBUTE = r"""(?s)([^\s"'>/=]+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?"""

#: Names of two or more characters that stand without a semicolon as well, longest first for the matcher.
_BARE = sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
#: All names with their characters in one string: \x01 name \x02 characters \x01 name ...
_NAMES = "\x01" + "\x01".join(f"{k[:-1]}\x02{v}" for k, v in html5.items() if k.endswith(";")) + "\x01"
_REFERENCE = r"(?s)\A(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;|" + "|".join(_BARE) + ")"
#: The characters that the numbers 0x80 to 0x9F stand for; the gaps stand for themselves.
WINDOWS_1252 = (
    "\u20ac\x81\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\x8d\u017d\x8f"
    "\x90\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\x9d\u017e\u0178"
)


def _character(digits: Column, base: int, longest: int) -> Column:
    """The character of a number of any length; U+FFFD for zero, surrogates and numbers beyond the last one."""
    plain = F.ltrim(digits, F.lit("0"))
    code = F.when(F.length(plain) > longest, F.lit(0)).otherwise(
        F.coalesce(F.conv(F.nullif(plain, F.lit("")), base, 10).cast("int"), F.lit(0))
    )

    def of(code: Column) -> Column:
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        point = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.when(code.between(0x80, 0x9F), F.substring(F.lit(WINDOWS_1252), code - 0x7F, F.lit(1))).otherwise(point)

    return bind(code, of)


def _decode(text: Column, names: Column | None = None, attribute: bool = False) -> Column:
    """Character references, decimal, hexadecimal and named, as the characters they stand for.

    The text is cut at ampersands; what no reference begins keeps its ampersand. A name without semicolon is the
    longest one that fits; in an attribute it is none if a letter, a digit or an equals sign follows. No-break
    spaces become blanks. `names` is the list of names.
    """
    names = F.lit(_NAMES) if names is None else names

    def named(name: Column) -> Column:
        key = F.concat(F.lit("\x01"), F.rtrim(name, F.lit(";")), F.lit("\x02"))
        return bind(F.instr(names, key), lambda at: F.when(
            at > 0, F.substring_index(F.substring(names, at + F.length(key), F.lit(3)), "\x01", 1)
        ))

    def decoded(part: Column, name: Column) -> Column:
        rest = F.substring(part, F.length(name) + 1, F.length(part))
        digits = F.rtrim(F.ltrim(name, F.lit("#xX")), F.lit(";"))
        found = (
            F.when(name.rlike(r"\A#[xX]"), _character(digits, 16, 6))
            .when(name.startswith("#"), _character(digits, 10, 7))
            .otherwise(named(name))
        )
        # a name with a semicolon that is no reference may begin with one that needs none
        bare = F.regexp_extract(part, _BARE_START, 1)
        instead = F.when(bare != "", F.concat(named(bare), F.substring(part, F.length(bare) + 1, F.length(part))))
        if attribute:
            follows = F.substring(part, F.length(bare) + 1, F.lit(1)).rlike("[A-Za-z0-9=]")
            instead = F.when(~follows, instead)
            goes_on = ~name.endswith(";") & ~name.startswith("#") & rest.rlike(r"\A[A-Za-z0-9=]")
            found = F.when(~goes_on, found)
        kept = F.concat(F.lit("&"), part)
        return F.when(name == "", kept).otherwise(F.coalesce(F.concat(found, rest), instead, kept))

    def piece(part: Column, i: Column) -> Column:
        return F.when(i == 0, part).otherwise(
            bind(F.regexp_extract(part, _REFERENCE, 1), lambda name: decoded(part, name))
        )

    joined = F.array_join(F.transform(F.split(text, "&", -1), piece), "")
    whole = F.when(F.contains(text, F.lit("&")), joined).otherwise(text)
    return F.replace(whole, F.lit("\u00a0"), F.lit(" "))


_BARE_START = r"(?s)\A(" + "|".join(_BARE) + ")"


def anchors(html: Column) -> Column:
    """Array of anchor fragments, each from its opening tag to the end of its text."""
    content = F.when(html.rlike(r"(?i)<a[\s>/]"), F.regexp_replace(html, NOT_CONTENT, ""))
    return F.regexp_extract_all(blank(content), F.lit(ANCHOR), F.lit(0))


def anchor_href(fragment: Column, names: Column | None = None) -> Column:
    """Target of an anchor: the first attribute of that name."""
    inside = F.substring(F.regexp_extract(fragment, _OPENING, 0), F.lit(3), F.length(fragment))
    each = lambda group: F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(group))
    place = F.array_position(F.transform(each(1), F.lower), F.lit("href"))
    value = bind(F.get(each(2), place.cast("int") - 1), lambda v: F.when(
        v.startswith('"'), F.trim(v, F.lit('"'))
    ).when(v.startswith("'"), F.trim(v, F.lit("'"))).otherwise(blank(v)))
    return F.lower(strip(_decode(value, names, attribute=True)))


def anchor_text(fragment: Column, names: Column | None = None) -> Column:
    inner = F.regexp_replace(F.regexp_replace(fragment, rf"\A{_OPENING}", ""), TAG, "")
    return F.lower(strip(_decode(inner, names)))


def link_host(href: Column) -> Column:
    """Host of a link target; empty for no target and for mail addresses."""
    skip = (href == "") | href.startswith("mailto:")
    return F.when(skip, F.lit("")).otherwise(hostname(with_scheme(href)))


def link_mismatch(text: Column, host: Column) -> Column:
    return (host != "") & (text != "") & ~F.contains(text, host)


def anchor_mismatch(html: Column) -> Column:
    """Some link shows a text that does not name the host it leads to."""

    def wrong(fragment: Column, names: Column) -> Column:
        return bind(link_host(anchor_href(fragment, names)), lambda host: F.when(
            host == "", F.lit(False)).otherwise(link_mismatch(anchor_text(fragment, names), host)))

    # the names are one constant, however often a link needs them
    return bind(F.lit(_NAMES), lambda names: F.exists(anchors(html), lambda a: wrong(a, names)))
