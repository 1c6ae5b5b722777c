"""Text cleaning as native Column expressions (no Python on the hot path).

Chain of the reference, in its order: HTML -> word tokeniser -> strip/lower/punctuation/
non-ASCII -> URL pieces -> stop words -> stem -> lemma. The word tokeniser comes before the
punctuation goes, so marks between words part them (``hello,world`` is two words). Stemming and
lemmas are vocabulary jobs (see ``operators.features``): each distinct token
is handled once and joined back, instead of once per occurrence.

Every regex here is valid in both Java and RE2 (no back-references or
look-around), so the DuckDB oracle can run the same patterns.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's behaviour) -------------------
# Python's string.punctuation: the 32 ASCII marks deleted by normalisation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# NLTK's English stop-word list (179 words), in its published order.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don don't should should've "
    "now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn "
    "hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# Character references: named (the standard table, names with their semicolon), decimal and hexadecimal.
REFERENCE = r"&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
AMPERSAND = r"&(?:amp|AMP|#0*38|#[xX]0*26);"
NAMED = json.dumps({k: v for k, v in sorted(html.entities.html5.items()) if k.endswith(";")})

# The word tokeniser's splits, in its order; marks themselves are deleted later. ``\\1`` stands for a group, ``\\0`` for the match.
SPLITS = [
    (r"""`+|''|"|[;@#$%&?!\[\](){}<>]|--|\.{2,}""", r" \0 "),           # marks that always stand alone
    (r"([:,])([^0-9])", r" \1 \2"),                                    # but 1,000 and 10:30 stay whole
    (r"([:,])$", r" \1 "),
    (r"""([^.])(\.)([\])}>"']*)(\s|$)""", r"\1 \2 \3 \4"),            # a sentence's last period
    (r"'([a-ce-lo-ru-zA-CE-LO-RU-Z0-9_])\b", r"' \1"),                 # an opening quote before a single letter
    (r"([^' ])('[sSmMdD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T|')(\s|$)", r"\1 \2\3"),
]
CONTRACTIONS = [(r"(?i)\b(can)(not)\b", r"\1 \2"), (r"(?i)\b(d)('ye)\b", r"\1 \2"), (r"(?i)\b(gim)(me)\b", r"\1 \2"),
                (r"(?i)\b(gon)(na)\b", r"\1 \2"), (r"(?i)\b(got)(ta)\b", r"\1 \2"), (r"(?i)\b(lem)(me)\b", r"\1 \2"),
                (r"(?i)\b(more)('n)\b", r"\1 \2"), (r"(?i)\b(wan)(na)\s", r"\1 \2 "), (r"(?i) ('t)(is)\b", r" \1 \2"), (r"(?i) ('t)(was)\b", r" \1 \2")]
CONTRACTED = r"(?i)cannot|d'ye|gimme|gonna|gotta|lemme|more'n|wanna|'tis|'twas"

# Patterns removed from HTML, in order: comments, script and style bodies, tags.
HTML_BLOCKS = [
    r"(?s)<!--.*?-->",
    r"(?is)<script[^>]*>.*?</script\s*>",
    r"(?is)<style[^>]*>.*?</style\s*>",
    r"<[a-zA-Z/!?][^>]*>",                       # a bare < is text
]

# the same 32 marks as a regex class (ranges 0x21-0x2F, 0x3A-0x40, 0x5B-0x60, 0x7B-0x7E);
# one regex pass is cheaper than translate's per-character map lookup
PUNCTUATION_CLASS = r"[!-/:-@\[-`{-~]"
URL_PIECE = r"http\S+"
NON_ASCII = r"[^\x00-\x7F]"
TOKEN = r"[a-z0-9]+"
# -----------------------------------------------------------------------------


def html_to_text(c: Column | str, tag_sep: str = "") -> Column:
    """Visible text of an HTML fragment. ``tag_sep=''`` joins text as the reference does."""
    c = F.col(c) if isinstance(c, str) else c
    # each pass copies the string: run the tag passes only on text holding '<'
    # and the entity passes only on text holding '&'
    tags = c
    for p in HTML_BLOCKS:
        tags = F.regexp_replace(tags, F.lit(p), F.lit(tag_sep))
    c = F.when(F.instr(c, "<") > 0, tags).otherwise(c)
    return F.when(F.instr(c, "&") > 0, decode_references(c)).otherwise(c)


def decode_references(c: Column) -> Column:
    """Character references decoded once; those for ``&`` go last, so that ``&amp;copy;`` becomes ``&copy;``. A name
    that isn't in the table, or a number that is no character, stays."""
    names = F.from_json(F.lit(NAMED), "map<string,string>")

    def value(ref: Column) -> Column:
        name = F.substring(ref, 2, F.length(ref) - 1)
        digits = F.substring(ref, 3, F.length(ref) - 3)
        hexed = F.lower(F.substring(digits, 1, 1)) == "x"
        number = F.when(hexed, F.conv(F.substring(digits, 2, F.length(digits)), 16, 10)).otherwise(digits).cast("long")
        char = F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF),
                      F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        return F.coalesce(F.when(F.substring(ref, 2, 1) == "#", char).otherwise(F.try_element_at(names, name)), ref)
    refs = F.filter(F.array_distinct(F.regexp_extract_all(c, F.lit(REFERENCE), 0)), lambda r: ~r.rlike("^" + AMPERSAND + "$"))
    c = F.aggregate(refs, c, lambda acc, r: F.replace(acc, r, value(r)))
    return F.regexp_replace(c, F.lit(AMPERSAND), F.lit("&"))


# The same splits for a chain that deletes the marks afterwards, where a mark needs only a blank in its place: marks that
# stand alone, and ``,`` or ``:`` that no digit follows, go in one pass (of two in a row the second stays, as in the rules).
# A sentence's last period counts only where a quote may come before it: elsewhere its deletion joins nothing.
MARKS = r"""[`";@#$%&?!\[\](){}<>]|''|--|\.{2,}|[:,]([:,])|[:,](?![0-9])"""


def bound(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it (a Column written out twice is two
    expressions, and nested conditions on nested replacements would grow without bound)."""
    return F.element_at(F.transform(F.array(value), f), 1)


def split_words(c: Column | str) -> Column:
    """Blanks where the word tokeniser splits (marks, quotes, contractions), for texts whose marks are deleted next."""
    c = F.col(c) if isinstance(c, str) else c

    def apply(x: Column, rules) -> Column:
        for pattern, to in rules:
            x = F.regexp_replace(x, F.lit(pattern), F.lit(to.replace("\\", "$")))
        return x

    def contracted(low: Column) -> Column:                 # plain searches first: few texts have any of them
        some = F.lit(False)
        for word in CONTRACTED.removeprefix("(?i)").split("|"):
            some = some | F.contains(low, F.lit(word))
        return some
    c = F.regexp_replace(F.concat(F.lit(" "), c, F.lit(" ")), F.lit(MARKS), F.lit(" $1"))
    c = bound(c, lambda x: F.when(F.instr(x, "'") > 0, apply(x, SPLITS[3:])).otherwise(x))
    return bound(c, lambda x: F.when(bound(F.lower(x), contracted), apply(x, CONTRACTIONS)).otherwise(x))


def normalize_text(c: Column | str) -> Column:
    """Trim, lower, delete the 32 punctuation marks, non-ASCII -> space."""
    c = F.col(c) if isinstance(c, str) else c
    c = F.regexp_replace(F.lower(F.trim(c)), F.lit(PUNCTUATION_CLASS), F.lit(""))
    return F.regexp_replace(c, F.lit(NON_ASCII), F.lit(" "))


def strip_urls(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, F.lit(URL_PIECE), F.lit(""))


def word_tokens(c: Column | str) -> Column:
    """Words of normalised text: maximal runs of ASCII letters and digits."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(c, F.lit(TOKEN), 0)


def remove_stopwords(tokens: Column) -> Column:
    """Drop stop words from a token array, keeping order and duplicates
    (``array_except`` would de-duplicate). ``isin`` over the literal list is
    turned into a hash-set lookup by the optimizer (InSet)."""
    return F.filter(tokens, lambda t: ~t.isin(STOP_WORDS))


def clean_tokens(c: Column | str, url_first: bool = False, tag_sep: str = "") -> Column:
    """HTML -> word splits -> normalise -> URL pieces -> tokens -> stop words, as one expression.

    ``url_first=False`` keeps the reference order: the splits part ``https`` from
    ``://x.y/z`` and the marks are gone, so only ``https`` itself goes, and ``xyz`` stays.
    """
    t = html_to_text(c, tag_sep)
    if url_first:
        t = normalize_text(split_words(strip_urls(t)))
    else:
        t = strip_urls(normalize_text(split_words(t)))
    return remove_stopwords(word_tokens(t))


def clean_text(c: Column | str, url_first: bool = False, tag_sep: str = "") -> Column:
    """Cleaned text as one string (tokens joined by a space); null input -> ''."""
    return F.coalesce(F.array_join(clean_tokens(c, url_first, tag_sep), " "), F.lit(""))
