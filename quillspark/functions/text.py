"""String and date functions on columns; Java's regular expressions, Python's idea of white space."""

from __future__ import annotations

import unicodedata
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .portions import in_portions

#: The code points that Python's str.isspace accepts.
WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WS_NOT_NEWLINE = WS.replace(r"\n", "")

# Letters that mark Vietnamese text.
VIETNAMESE = "àáảãạăắằẳẵặâấầẩẫậđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵ"

LONG_DATE = rf"(?iu)ngày{WS}+([0-9]{{1,2}}){WS}+tháng{WS}+([0-9]{{1,2}}){WS}+năm{WS}+([0-9]{{4}})"
SHORT_DATE = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\z"


def locate(part: Column, text: Column, start: Column) -> Column:
    """The place (from 1) of ``part`` at or after ``start``, 0 if there is none."""
    return F.call_function("locate", part, text, start)


def let(value: Column, body) -> Column:
    """body(value) with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_ws(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"^{WS}+|{WS}+\z", "")


def word_list(text: Column) -> Column:
    """The words between white space, as str.split() gives them."""
    return F.filter(F.split(text, rf"{WS}+", -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(word_list(text))


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Unicode composition (Spark has no function for it); Arrow batches, unchanged texts pass through."""
    return texts.map(lambda t: t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


def tidy(text: Column) -> Column:
    """Runs of white space but line ends become one space, zero-width characters go, at most one empty line."""
    text = F.regexp_replace(text, rf"{WS_NOT_NEWLINE}+", " ")
    text = F.regexp_replace(text, r"[\x{200B}-\x{200D}\x{FEFF}]", "")
    return strip_ws(F.regexp_replace(text, r"\n{3,}", "\n\n"))


#: Runs of white space but line ends that are not one space already.
LOOSE = rf"{WS_NOT_NEWLINE.replace(r'\x1F ', r'\x1F')}{WS_NOT_NEWLINE}*| {WS_NOT_NEWLINE}+"


def clean_texts(texts: pa.Array) -> pa.Array:
    """``tidy`` of composed texts, many at once."""
    if not pc.all(pc.string_is_ascii(texts)).as_py():
        texts = pa.array([t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())
    for pattern, by in ((LOOSE, " "), (r"[\x{200B}-\x{200D}\x{FEFF}]", ""), (r"\n{3,}", "\n\n"), (rf"^{WS}+", ""), (rf"{WS}+\z", "")):
        texts = pc.replace_substring_regex(texts, pattern=pattern, replacement=by)
    return texts


def clean_text(text: Column) -> Column:
    """Composed and tidied text."""
    return in_portions(clean_texts, T.StringType())(text)


def segments(text: Column) -> Column:
    """The lines that are not blank, stripped."""
    return F.filter(F.transform(F.split(text, "\n", -1), strip_ws), lambda s: s != "")


def capital(word: Column) -> Column:
    """First character in upper case (of a letter that becomes two, only the first of them), the rest in lower."""
    first = F.upper(F.substring(word, 1, 1))
    return F.concat(F.substring(first, 1, 1), F.lower(F.substr(first, F.lit(2))), F.lower(F.substr(word, F.lit(2))))


def title_case(text: Column) -> Column:
    """Every run of letters with its first letter in upper and the rest in lower case."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, capital), "")


def normalize_name(name: Column) -> Column:
    """A stripped name, title-cased if it is all upper or all lower case."""
    return let(strip_ws(name), lambda n: F.when((n == F.upper(n)) | (n == F.lower(n)), title_case(n)).otherwise(n))


def capitalize_words(text: Column) -> Column:
    """White space collapsed, each word with only its first character in upper case."""
    return F.array_join(F.transform(word_list(text), capital), " ")


def normalize_date(text: Column) -> Column:
    """dd/mm/yyyy of the forms known, else the stripped text; days and months are not checked."""

    def padded(t: Column, pattern: str) -> Column:
        day, month, year = (F.regexp_extract(t, pattern, i) for i in (1, 2, 3))
        return F.concat(F.lpad(day, 2, "0"), F.lit("/"), F.lpad(month, 2, "0"), F.lit("/"), year)

    return let(strip_ws(text), lambda t: F.when(t.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"), t).when(t.rlike(LONG_DATE), padded(t, LONG_DATE)).when(t.rlike(SHORT_DATE), padded(t, SHORT_DATE)).otherwise(t))


def is_vietnamese(text: Column) -> Column:
    return text.rlike(f"[{VIETNAMESE}{VIETNAMESE.upper()}]")


def _accents() -> tuple[str, str]:
    """Letters of the Latin blocks that decompose into an ASCII letter and marks."""
    pairs = [(chr(c), d[0]) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)) if len(d := unicodedata.normalize("NFD", chr(c))) > 1 and d[0].isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()


UNACCENTED = str.maketrans(ACCENTED, PLAIN)


def _keyword_code(point: int) -> int:
    """What a code point becomes in ``keyword_form``: a letter or digit, a blank, or nothing (0)."""
    kept = [c for c in chr(point).lower().translate(UNACCENTED) if unicodedata.category(c) != "Mn"]
    return 0 if not kept else ord(kept[0]) if len(kept) == 1 and kept[0].isascii() and kept[0].isalnum() else 32


#: Of the code points that texts mostly consist of; others are looked at when they come.
KEYWORD_CODES = np.array([_keyword_code(p) for p in range(0x2000)], np.uint8)


def keyword_forms(texts: pa.Array) -> pa.Array:
    """``keyword_form`` of many texts at once, a table look-up for every code point."""
    filled = pc.fill_null(texts, "").cast(pa.string())
    _, offsets, data = filled.buffers()
    ends = np.frombuffer(offsets, np.int32, len(filled) + 1, filled.offset * 4) if len(filled) else np.zeros(1, np.int32)
    points = np.frombuffer(data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes().decode().encode("utf-32-le") if ends[-1] > ends[0] else b"", np.uint32)
    code = KEYWORD_CODES[np.minimum(points, len(KEYWORD_CODES) - 1)]
    rare = np.flatnonzero(points >= len(KEYWORD_CODES))
    if len(rare):
        known, at = np.unique(points[rare], return_inverse=True)
        code[rare] = np.array([_keyword_code(p) for p in known.tolist()], np.uint8)[at]
    row = np.repeat(np.arange(len(filled), dtype=np.int32), np.asarray(pc.utf8_length(filled)))
    some = np.flatnonzero(code)
    code, row = code[some], row[some]
    blank, first = code == 32, np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    after = first.copy()
    after[1:] |= blank[:-1]
    some = np.flatnonzero(~(blank & after))  # one blank of a run, none at the beginning
    code, row = code[some], row[some]
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    some = np.flatnonzero((code != 32) | ~last)
    upto = np.concatenate(([0], np.cumsum(np.bincount(row[some], minlength=len(filled))))).astype(np.int32)
    out = pa.StringArray.from_buffers(len(filled), pa.py_buffer(upto), pa.py_buffer(np.ascontiguousarray(code[some])))
    return pc.if_else(texts.is_valid(), out, None)


def keyword_form(text: Column) -> Column:
    """Lower case without accents, every other run of characters than a-z and 0-9 one space."""
    return in_portions(keyword_forms, T.StringType())(text)


def keyword_form_of(text: str) -> str:
    """The same for one Python string, as rules need it on the driver."""
    kept = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn")
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in kept).split())


def display_name(doc_type: Column) -> Column:
    return title_case(F.replace(doc_type, F.lit("_"), F.lit(" ")))


def model_repo_id(owner: str, doc_type: Column, model: str = "phobert") -> Column:
    return F.concat(F.lit(f"{owner}/{model}-"), doc_type, F.lit("-ner"))


def doc_type_of_repo(repo_id: Column, model: str = "phobert") -> Column:
    """The document type in a repository name, null if the name is another's."""
    found = F.regexp_extract(repo_id, rf"(?:^|/){model}-(.*)-ner\z", 1)
    return F.when(found != "", found)


def is_hub_id(path: str) -> bool:
    """Two parts and no such path here."""
    import os

    return not os.path.exists(path) and len(path.strip("/").split("/")) == 2


def uniform(seed: int | str, *parts: Column | str) -> Column:
    """A number in [0, 1) from the MD5 of seed and parts: the same wherever a row is computed."""
    key = F.concat_ws("|", F.lit(str(seed)), *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def pick(values: list | tuple, u: Column) -> Column:
    """The value at place floor(u * n)."""
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(u * len(values)) + 1).cast("int"))


def integer(u: Column, low: int, high: int) -> Column:
    return (F.lit(low) + F.floor(u * (high - low + 1))).cast("int")


def digits(seed: int | str, key: Column, slot: str, n: int) -> Column:
    """n decimal digits, one draw each."""
    return reduce(F.concat, [integer(uniform(seed, key, f"{slot}{i}"), 0, 9).cast("string") for i in range(n)])
