"""Text functions as column expressions: all run in the JVM, inside code generation where Spark has it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Word characters: letters, digits and underscore, without combining marks; blanks: all white space.
WORD = r"[\p{L}\p{N}_]"
BLANK = r"[\s\p{Z}]"

# Mark names and what they append to a word.
PUNCT_MARKS = {
    "O": "",
    "PERIOD": ".",
    "COMMA": ",",
    "QUESTION": "?",
    "TIRE": "—",
    "DVOETOCHIE": ":",
    "VOSKL": "!",
    "PERIODCOMMA": ";",
    "DEFIS": "-",
    "MNOGOTOCHIE": "...",
    "QUESTIONVOSKL": "?!",
}
PUNCT_CASES = ("LOWER", "UPPER", "UPPER_TOTAL")


def strip(text: Column) -> Column:
    """Without white space of any kind at either end (trim() knows spaces only)."""
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+$", "")


def collapse(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, rf"{BLANK}+", " "))  # only spaces are left


def is_missing(text: Column) -> Column:
    """Null or blank."""
    return text.isNull() | (strip(text) == "")


def normalize_text(text: Column) -> Column:
    """Lower case, only word characters and single spaces."""
    return collapse(F.regexp_replace(F.lower(text), rf"(?:(?!{WORD})\S)", ""))


def normalize_transcript(text: Column) -> Column:
    """Lower case with single spaces; null is empty."""
    return collapse(F.lower(F.coalesce(text, F.lit(""))))


def consensus_key(text: Column) -> Column:
    """Lower case, stripped; white space inside is kept."""
    return strip(F.lower(text))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(f"{WORD}+"), 0)).cast("long")


def char_count(text: Column) -> Column:
    return F.char_length(strip(text)).cast("long")


def tokens(text: Column) -> Column:
    """Words between white space, lower case."""
    t = collapse(F.lower(text))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def capitalize(word: Column) -> Column:
    """First letter upper, all others lower (initcap() would raise each word)."""
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 1 << 30)))


def punct_decode(word: Column, label: Column) -> Column:
    """The word in the label's case with its mark; null for an unknown label.

    A label is a case and a mark. The dash stands apart from a word in capitals, not from one in lower case.
    """
    marks = F.create_map(*[F.lit(x) for kv in PUNCT_MARKS.items() for x in kv])
    case = F.regexp_extract(label, rf"^({'|'.join(sorted(PUNCT_CASES, key=len, reverse=True))})_", 1)
    name = F.substr(label, F.length(case) + 2, F.lit(1 << 30))
    mark = F.try_element_at(marks, name)
    cased = F.when(case == "LOWER", word).when(case == "UPPER", capitalize(word)).when(case == "UPPER_TOTAL", F.upper(word))
    return F.concat(cased, F.when((name == "TIRE") & (case != "LOWER"), F.lit(" ")).otherwise(F.lit("")), mark)


def punct_join(words: Column, labels: Column) -> Column:
    """A whole labelled sentence; unknown labels leave their word out."""
    pairs = F.zip_with(words, labels, lambda w, x: punct_decode(w, x))
    return strip(F.array_join(pairs, " "))


def slug(text: Column, limit: int | None = 160, empty: str = "page") -> Column:
    """A file-name part: runs of other characters are one underscore."""
    s = F.regexp_replace(F.regexp_replace(text, "^https?://", ""), "[^A-Za-z0-9._-]+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    if limit is not None:
        s = F.substring(s, 1, limit)
    return F.when(s == "", F.lit(empty)).otherwise(s)


def truthy(value: Column, extra: bool = True) -> Column:
    """Text that means yes."""
    return F.coalesce(F.lower(strip(value.cast("string"))).isin("1", "true", "yes", *(("y", "on") if extra else ())), F.lit(False))


def page_title(html: Column) -> Column:
    """The text of <title>, single-spaced; empty when there is none."""
    return collapse(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1))


def tsv_line(start: Column, end: Column, word: Column) -> Column:
    return F.format_string("%.3f\t%.3f\t%s", start, end, word)
