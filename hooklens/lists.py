"""The word, domain and phrase lists the rules, flags and generators use.

They have to equal the published rule set for results to agree, so they are plain data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

# --- rule set -------------------------------------------------------------------------
SUSPECT_TLDS = ("tk", "ml", "cf", "gq", "zip", "mov")
RULE_SHORTENERS = ("bit.ly", "tinyurl.com", "t.co", "goo.gl", "ow.ly")
RULE_REDIRECTORS = ("l.facebook.com", "urldefense.proofpoint.com", "safelinks.protection.outlook.com")
RULE_MARKERS = ("você", "voce", "cpf", "boleto", "pix", "celular", "fatura")

# --- robustness flags, suffix profile --------------------------------------------------
SUFFIX_SHORTENERS = (
    "bit.ly", "tinyurl.com", "goo.gl", "ow.ly", "t.co", "is.gd", "buff.ly", "cutt.ly",
    "rebrand.ly", "lnkd.in", "s.id",
)
SUFFIX_REDIRECTORS = (
    "l.facebook.com", "l.instagram.com", "nav.smartscreen.microsoft.com",
    "urldefense.proofpoint.com", "secure-web.cisco.com",
)
SUFFIX_MARKERS = (
    "você", "fatura", "boleto", "cadastre-se", "celular", "cpf", "pix", "favorecido",
    "transferência", "cartão de crédito",
)

# --- robustness flags, prefix profile --------------------------------------------------
PREFIX_SHORTENERS = (
    "bit.ly", "tinyurl.com", "goo.gl", "ow.ly", "t.co", "is.gd", "buff.ly", "cutt.ly",
    "lnkd.in", "rb.gy",
)
PREFIX_REDIRECTORS = (
    "l.facebook.com", "l.instagram.com", "urldefense.proofpoint.com",
    "safelinks.protection.outlook.com", "click.mail", "click.email",
)
PREFIX_MARKERS = (
    "você", "voce", "cpf", "boleto", "pix", "celular", "fatura", "segunda via",
    "atualizar cadastro",
)

# --- header JSON keys that count as evaluable authentication ---------------------------
AUTH_KEYS = ("spf", "dkim", "dmarc", "authentication-results")

# --- synthetic modalities ---------------------------------------------------------------
LEGIT_DOMAINS = ("enron.com", "corp.com", "internal.net")
ATTACKER_DOMAINS = ("evil.com", "phish.com", "secure-update.com")
GENERIC_LINK_TEXTS = (
    "Click here to access bank.com", "Secure portal login", "Update your account at bank.com",
)

# --- robustness variants ----------------------------------------------------------------
VARIANT_MODES = ("FN_redirect", "FN_semurl", "FP_news", "FP_ptbr", "FP_headerok")
REDIRECT_PREFIX = "https://l.facebook.com/l.php?u="
REPLY_REQUEST = " Responda confirmando seus dados."
NEWSLETTER_HEADLINES = (
    "Oferta exclusiva termina hoje", "Cupom válido até às 23:59",
    "Últimas unidades com 30% OFF", "Assine e receba vantagens",
)
NEWSLETTER_FOOTER = " Cancelar subscrição | Gerir preferências"
MARKER_PHRASES = (
    "Você precisa atualizar seu cadastro", "fatura em atraso", "boleto disponível",
    "celular cadastrado", "CPF requerido", "pix com desconto", "cartão de crédito bloqueado",
)
URGENT_SUBJECT = "Ação necessária: "
URGENT_FOOTER = " Atualize sua senha imediatamente."
NEUTRAL_FOOTER = " Obrigado."
AUTHENTICATED_HEADERS = (
    '{"spf": "pass", "dkim": "pass", "dmarc": "pass", '
    '"authentication-results": "spf=pass dkim=pass dmarc=pass"}'
)
UNAUTHENTICATED_HEADERS = '{"authentication-results": "none"}'

# --- fixed column names of raw mail tables, the first one present is taken -----------------
SUBJECT_NAMES = ("subject", "Subject", "SUBJECT")
BODY_NAMES = ("body", "Body", "text", "Text", "Message", "message", "email", "Email")
DATE_NAMES = ("date", "Date", "DATE")

# --- rules in evaluation order, and which of them accuse ---------------------------------
RULES = (
    "has_at", "tld_suspect", "confusable", "shortened_url", "redirector_url", "ptbr_likely",
    "no_url", "anchor_href_mismatch", "from_reply_mismatch", "auth_spf_fail", "auth_dkim_fail",
    "auth_dmarc_fail", "from_return_mismatch",
)
NEUTRAL_RULES = ("ptbr_likely", "no_url")
ACCUSATORY_RULES = tuple(r for r in RULES if r not in NEUTRAL_RULES)

# --- robustness scenarios: display name and flag -----------------------------------------
SCENARIOS = (
    ("Homógrafos Unicode", "unicode_homoglyph"),
    ("URLs encurtadas", "shortened_url"),
    ("Redireções em cadeia", "redirector_url"),
    ("PT-BR vs PT-PT", "ptbr_likely"),
    ("Mensagens sem URL", "no_url"),
    ("Headers ausentes", "headers_missing"),
)

# --- error types: missing signal and suggested mitigation --------------------------------
ERROR_NOTES = (
    ("FP_newsletter", "Regras newsletter/allowlist", "Allowlist e ajuste de limiar"),
    ("FP_ptbr", "Lexical PT-PT", "Normalização PT-BR; reforçar sinais de URL"),
    ("FP_header_ok", "Headers/auth", "Usar SPF/DKIM/DMARC na decisão e coerência From/Reply-To"),
    ("FN_compromised_domain", "Domínio comprometido/reputação",
     "Feed de domínios comprometidos; âncora≠href"),
    ("FN_redirect_chain", "URL/redirect", "Detetar QR/redirect e impor análise de destino"),
    ("FN_sem_url", "URL/redirect", "Detetar QR/redirect e impor análise de destino"),
)
NEAR_MISS_URL_SIGNAL = "URL/redirect"
NEAR_MISS_HEADER_SIGNAL = "Headers/auth"
NEAR_MISS_OTHER_SIGNAL = "Lexical/contexto"
NEAR_MISS_FN_MITIGATION = "Apertar análise de URL/QR/redirect; revisão humana de zona cinzenta"
NEAR_MISS_FP_MITIGATION = "Allowlist e ponderação de cabeçalhos; ajuste fino de limiar"

# --- writing systems told apart when looking for mixed-script hosts: all that the JVM names ---
SCRIPTS = (
    "Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Syriac", "Thaana",
    "Devanagari", "Bengali", "Gurmukhi", "Gujarati", "Oriya", "Tamil", "Telugu", "Kannada",
    "Malayalam", "Sinhala", "Thai", "Lao", "Tibetan", "Myanmar", "Georgian", "Hangul", "Ethiopic",
    "Cherokee", "Canadian_Aboriginal", "Ogham", "Runic", "Khmer", "Mongolian", "Hiragana",
    "Katakana", "Bopomofo", "Han", "Yi", "Old_Italic", "Gothic", "Deseret", "Tagalog", "Hanunoo",
    "Buhid", "Tagbanwa", "Limbu", "Tai_Le", "Linear_B", "Ugaritic", "Shavian", "Osmanya",
    "Cypriot", "Braille", "Buginese", "Coptic", "New_Tai_Lue", "Glagolitic", "Tifinagh",
    "Syloti_Nagri", "Old_Persian", "Kharoshthi", "Balinese", "Cuneiform", "Phoenician",
    "Phags_Pa", "Nko", "Sundanese", "Batak", "Lepcha", "Ol_Chiki", "Vai", "Saurashtra",
    "Kayah_Li", "Rejang", "Lycian", "Carian", "Lydian", "Cham", "Tai_Tham", "Tai_Viet", "Avestan",
    "Egyptian_Hieroglyphs", "Samaritan", "Mandaic", "Lisu", "Bamum", "Javanese", "Meetei_Mayek",
    "Imperial_Aramaic", "Old_South_Arabian", "Inscriptional_Parthian", "Inscriptional_Pahlavi",
    "Old_Turkic", "Brahmi", "Kaithi", "Meroitic_Hieroglyphs", "Meroitic_Cursive", "Sora_Sompeng",
    "Chakma", "Sharada", "Takri", "Miao", "Caucasian_Albanian", "Bassa_Vah", "Duployan",
    "Elbasan", "Grantha", "Pahawh_Hmong", "Khojki", "Linear_A", "Mahajani", "Manichaean",
    "Mende_Kikakui", "Modi", "Mro", "Old_North_Arabian", "Nabataean", "Palmyrene", "Pau_Cin_Hau",
    "Old_Permic", "Psalter_Pahlavi", "Siddham", "Khudawadi", "Tirhuta", "Warang_Citi", "Ahom",
    "Anatolian_Hieroglyphs", "Hatran", "Multani", "Old_Hungarian", "Signwriting", "Adlam",
    "Bhaiksuki", "Marchen", "Newa", "Osage", "Tangut", "Masaram_Gondi", "Nushu", "Soyombo",
    "Zanabazar_Square", "Hanifi_Rohingya", "Old_Sogdian", "Sogdian", "Dogra", "Gunjala_Gondi",
    "Makasar", "Medefaidrin", "Elymaic", "Nandinagari", "Nyiakeng_Puachue_Hmong", "Wancho",
    "Yezidi", "Chorasmian", "Dives_Akuru", "Khitan_Small_Script",
)


@dataclass(frozen=True)
class RuleLists:
    """Lists a rule run uses; an empty list switches its rule off."""

    suspect_tlds: tuple[str, ...] = SUSPECT_TLDS
    shorteners: tuple[str, ...] = RULE_SHORTENERS
    redirectors: tuple[str, ...] = RULE_REDIRECTORS
    markers: tuple[str, ...] = RULE_MARKERS
    return_mismatch: bool = False

    @classmethod
    def from_mapping(cls, config: dict) -> RuleLists:
        """Build from a parsed rule configuration (suspect TLDs may carry a leading dot)."""
        return cls(
            suspect_tlds=tuple(t.lstrip(".") for t in config.get("suspect_tlds", SUSPECT_TLDS)),
            shorteners=tuple(config.get("shorteners", ())),
            redirectors=tuple(config.get("redirectors", ())),
            markers=tuple(config.get("ptbr_markers", ())),
        )

    @classmethod
    def from_table(cls, entries: DataFrame) -> RuleLists:
        """Build from a configuration table `list, entry`, whose lists have the names of the
        configuration. The lists become part of the plan, so this reads the table at once; it is
        for configurations, whose entries people write. Lists that grow with the data are joined
        (`match_hosts`)."""
        rows = entries.groupBy("list").agg(F.sort_array(F.collect_set("entry")).alias("entries")).collect()
        return cls.from_mapping({r["list"]: r["entries"] for r in rows})
