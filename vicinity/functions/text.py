"""Text columns: clean-up, lenient numbers, composed texts, display, requests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Results only agree if these stay as they are.
SCORE_THRESHOLD = 40
SCORE_WORDS = {  # score column -> word, in the order the phrase lists them
    "hoppy": "hoppy",
    "bitter": "bitter",
    "malty": "malty",
    "sweet": "sweet",
    "sour": "sour",
    "fruits": "fruity",
    "spices": "spiced",
    "salty": "salty",
    "alcohol": "strong",
    "body": "full-bodied",
    "astringency": "astringent",
}
PROMPT_LIMIT = 4000
TOP_MIN, TOP_MAX, TOP_DEFAULT = 1, 50, 5
TRUNCATE_WIDTH = 60
WHITE_SPACE = (  # all characters Unicode counts as white space, and the separators U+001C..1F
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
KEG_NAME = r"(?iU)(?:\d[\s\x1c-\x1f]*/[\s\x1c-\x1f]*\d|[½¼⅙])[\s\x1c-\x1f]*(?:barrel|keg)"
KEG_TEXT = "Kegs are intended for Kegerator use"
BLANK_REQUEST = "Please enter a prompt or command (:help for help)."
LONG_REQUEST = "Prompt too long (%d chars, max 4000)."
LIKE_USAGE = "Usage: :like <beer id>"
TOP_USAGE = "Usage: :top <n>  (1-50)"
TOP_RANGE = "N must be between 1 and 50."
UNKNOWN_REQUEST = "Unknown command %s.  Type :help for help."
SIMPLE_COMMANDS = {
    "explain": [":explain"],
    "help": [":help"],
    "clear": [":cls", ":clear"],
    "quit": [":quit", ":exit", ":q"],
}
# ---------------------------------------------------------------------------

# What a number may look like; a cast alone would take "8d" and "12f" as well.
NUMBER = r"(?i)[+-]?(?:(?:\d+(?:_\d+)*)(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+(?:_\d+)*)?|[+-]?(?:inf|infinity|nan)"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean(text: Column) -> Column:
    """NULL to '', byte-order marks off the front, white space off both ends."""
    return strip(F.ltrim(F.coalesce(text, F.lit("")), F.lit("\ufeff")))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def default_if_blank(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(default))


def to_number(text: Column) -> Column:
    """``'8%'`` and ``'$1,234.5'`` to double; anything unreadable to NULL."""
    bare = F.regexp_replace(clean(text), r"%+$", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"^\$+", ""), ",", "")
    return _number(bare)


def to_whole(text: Column) -> Column:
    """Whole part of a number text, toward zero; anything unreadable to NULL."""
    return _number(clean(text)).try_cast("int")


def _number(text: Column) -> Column:
    bare = strip(text)
    return F.when(bare.rlike(f"^(?:{NUMBER})$"), F.replace(bare, F.lit("_"), F.lit("")).try_cast("double"))


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def is_keg(name: Column, description: Column) -> Column:
    """Shop articles that repeat an item in a keg."""
    in_text = F.coalesce(description, F.lit("")).contains(KEG_TEXT)
    return F.coalesce(name, F.lit("")).rlike(KEG_NAME) | in_text


def _part(text: Column, before: str = "", after: str = "") -> Column:
    return F.concat(F.lit(before), F.nullif(strip(text), F.lit("")), F.lit(after))


def fold_description(description, notes, pairing, country) -> Column:
    """One prose text out of four optional ones."""
    return F.concat_ws(
        " ",
        _part(description),
        _part(notes, "Tasting notes: ", "."),
        _part(pairing, "Pairs well with: ", "."),
        _part(country, "Brewed in ", "."),
    )


def score_phrase(scores: Mapping[str, Column]) -> Column:
    """Words of all scores at or above the threshold; NULL if there are none."""
    words = F.concat_ws(
        ", ",
        *[
            F.when(scores[key] >= SCORE_THRESHOLD, F.lit(word))
            for key, word in SCORE_WORDS.items()
            if key in scores
        ],
    )
    return F.concat(F.lit("Taste: "), F.nullif(words, F.lit("")), F.lit("."))


def compose_info(name, style, description, scores: Mapping[str, Column] | None = None) -> Column:
    """The text a row is embedded by; parts that are missing leave no trace."""
    parts = [_part(name), _part(style, "Style: ", "."), _part(description)]
    if scores:
        parts.append(score_phrase(scores))
    return F.concat_ws(" ", *parts)


def truncate(text: Column, width: int = TRUNCATE_WIDTH) -> Column:
    line = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    cut = F.concat(F.substring(line, 1, width - 1), F.lit("…"))
    return F.when(F.char_length(line) <= width, line).otherwise(cut)


def search_link(name: Column, base: str = "https://untappd.com/search?q=") -> Column:
    """Link with a form-encoded argument: blank as ``+``, ``*`` encoded, ``~`` not."""
    encoded = F.replace(F.url_encode(name), F.lit("*"), F.lit("%2A"))
    return F.concat(F.lit(base), F.replace(encoded, F.lit("%7E"), F.lit("~")))


def result_line(rank: Column, name: Column, style: Column, dist: Column, row_id: Column) -> Column:
    empty = F.lit("")
    return F.format_string(
        "%3d. %s  (%s)  d=%.3f  [id=%d]",
        rank,
        F.coalesce(name, empty),
        F.coalesce(style, empty),
        dist,
        row_id,
    )


def _request(kind: str, **given: str) -> str:
    fields = {"prompt": "STRING", "like_id": "BIGINT", "top": "INT", "error": "STRING"}
    rest = [f"CAST({given.get(name, 'NULL')} AS {kind_}) AS {name}" for name, kind_ in fields.items()]
    return f"struct('{kind}' AS kind, {', '.join(rest)})"


def _refusal(message: str, *values: str) -> str:
    return _request("error", error=f"format_string({', '.join([repr(message), *values])})")


def classify_request(column: str) -> Column:
    """What the request line in a column asks for, as a struct with one field set.

    ``kind`` is search, like, top, explain, help, clear, quit or error; ids have
    one to nine digits. One-element ``transform`` calls name the trimmed text and
    the command, so both are worked out once, however many rules and later
    filters look at them.
    """
    simple = "\n".join(
        f"WHEN c.name IN ({', '.join(map(repr, names))}) THEN {_request(kind)}"
        for kind, names in SIMPLE_COMMANDS.items()
    )
    rules = f"""CASE
      WHEN c.name = ':like' AND c.arg RLIKE '^[0-9]{{1,9}}$' THEN {_request("like", like_id="c.arg")}
      WHEN c.name = ':like' THEN {_refusal(LIKE_USAGE)}
      WHEN c.name = ':top' AND c.arg RLIKE '^-?[0-9]{{1,9}}$' THEN
        IF(CAST(c.arg AS INT) BETWEEN {TOP_MIN} AND {TOP_MAX}, {_request("top", top="c.arg")}, {_refusal(TOP_RANGE)})
      WHEN c.name = ':top' THEN {_refusal(TOP_USAGE)}
      {simple}
      ELSE {_refusal(UNKNOWN_REQUEST, "c.name")} END"""
    command = rf"""transform(transform(array(split(t, r'(?U)\s+')),
      w -> struct(lower(w[0]) AS name, IF(size(w) = 2, w[1], NULL) AS arg)), c -> {rules})[0]"""
    return F.expr(f"""transform(array(btrim(coalesce({column}, ''), '{WHITE_SPACE}')), t -> CASE
      WHEN startswith(t, ':') THEN {command}
      WHEN t = '' THEN {_refusal(BLANK_REQUEST)}
      WHEN char_length(t) > {PROMPT_LIMIT} THEN {_refusal(LONG_REQUEST, "char_length(t)")}
      ELSE {_request("search", prompt="t")} END)[0]""")
