"""Expressions over crawled page and card fields."""

from pyspark.sql import Column, functions as F

from .text import BLANK, contains_any, fold_blanks, strip_blank

# Texts that tell why a page shows no listings, lower case.
BLOCK_MARKERS = (
    "attention required", "sorry, you have been blocked", "cloudflare ray id",
    "error 1020", "cf-error",
)
CHALLENGE_MARKERS = (
    "verify you are human", "checking your browser", "just a moment",
    "performing security verification", "turnstile", "captcha",
)
LOGIN_MARKERS = ("dang-nhap", "/login")
WORK_TYPES = ("At office", "Remote", "Hybrid", "At Office")


def shown_text(title: Column, body: Column) -> Column:
    """What the outcome rules search: title and body in lower case."""
    return F.lower(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))))


def outcome_of_text(status: Column, url: Column, text: Column, cards: Column, links: Column) -> Column:
    """As ``page_outcome``, over a column of ``shown_text``, which every rule reads."""
    return (
        F.when(cards > 0, "jobs_visible")
        .when(contains_any(text, BLOCK_MARKERS), "cloudflare_block")
        .when(status == 429, "rate_limited")
        .when(status == 403, "access_denied")
        .when(contains_any(text, CHALLENGE_MARKERS), "anti_bot_challenge")
        .when(contains_any(F.lower(F.coalesce(url, F.lit(""))), LOGIN_MARKERS), "login_redirect")
        .when(links > 0, "selector_drift")
        .otherwise("empty_unknown")
    )


def page_outcome(
    status: Column, url: Column, title: Column, body: Column, cards: Column, links: Column
) -> Column:
    """Why a page did or did not show listings; the first rule that holds wins."""
    return outcome_of_text(status, url, shown_text(title, body), cards, links)


def parse_outcome(records: Column, cards: Column, outcome: Column) -> Column:
    """NULL when records were parsed, else the failure class of the page."""
    return F.when(records > 0, F.lit(None)).when(cards > 0, "parser_drift").otherwise(outcome)


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)


def body_text(html: Column) -> Column:
    """Visible text: scripts, styles, comments and tags dropped, blanks folded."""
    hidden = r"(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->|<head\b.*?</head>|<[^>]+>"
    return strip_blank(F.regexp_replace(F.regexp_replace(html, hidden, " "), f"{BLANK}+", " "))


def pattern_count(html: Column, pattern: str) -> Column:
    """How many times a pattern (a card's or a link's opening tag) occurs."""
    return F.regexp_count(html, F.lit(pattern))


def canonical_url(url: Column, host: str | None = None) -> Column:
    """Everything from ``?`` on dropped; a relative url gets ``host`` in front."""
    if host is not None:
        url = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(host), url))
    return F.regexp_replace(url, r"\?[^\n]*", "")


def known_work_type(text: Column) -> Column:
    text = strip_blank(text)
    return F.when(text.isin(*WORK_TYPES), text).otherwise("")


def salary_placeholder(
    text: Column, missing: str = "Negotiable", hidden_prompt: str | None = "sign in", collapse: bool = False
) -> Column:
    """``missing`` for no salary; a text with the sign-in prompt (case ignored)
    reads 'Login to view'. ``collapse`` folds inner blanks to one space."""
    return salary_label(fold_blanks(text) if collapse else strip_blank(text), missing, hidden_prompt)


def salary_label(shown: Column, missing: str = "Negotiable", hidden_prompt: str | None = "sign in") -> Column:
    """As ``salary_placeholder``, over a stripped text (NULL for no salary)."""
    label = F.when(shown.isNull(), missing)
    if hidden_prompt is not None:
        label = label.when(F.lower(shown).contains(hidden_prompt), "Login to view")
    return label.otherwise(shown)
